"""Session settings and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", name: str = "tallymart", **conf: str) -> SparkSession:
    """A session for tests and the benchmark; clusters bring their own."""
    width = os.cpu_count() if cpus == "*" else int(cpus)
    settings = {
        "spark.sql.shuffle.partitions": str(width),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "12g",
        "spark.sql.adaptive.enabled": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, read from ``spark.checkpoint.dir``.

    Only a local master may go without the setting: it then gets one temporary folder of its own.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        if not context.getCheckpointDir():
            context.setCheckpointDir(configured)
        return configured
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tallymart-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def write_through(df: DataFrame, label: str = "stage", path: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at replicated files.

    Needed where a row carries a value (a position, a random draw) that must not change when a lost
    executor's work is repeated. The shuffle files of the write go when it is done: nothing reads them again. Whoever gives
    a ``path`` of ``scratch_path`` can ``discard`` the rows later.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(FILE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove what ``write_through`` wrote to ``path``: a round of an iteration that later rounds have replaced."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
