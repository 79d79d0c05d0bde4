"""Merkle manifest of a dataset: leaf places by rank in bitmaps, levels from keyed slot arrays.

Every group (language) keeps its ids in bitmaps of 2^15 ids, cut to the bytes in use. A directory sums their popcounts
in steps of 16 bits of the id. The rank of an id in its group is the directory's total before its bitmap plus the bits
before its own: no leaf is sorted. Multiplicities are bit-sliced: plane k holds the ids whose number of rows has bit k,
and counts 2^k. Rank r is slot r % 8 of node r / 8 one level up; a node is the hash of its slot array.

Defined results: a null id precedes all others of its group, a null group all other groups. Rows of one id stand by leaf
hash; rows with the same id and leaf are interchangeable, and each has its own place. An empty table gives an empty
manifest. Texts are hashed whole where they are read; only hashes travel. Of the columns only those named are read, so
others, whatever their names, do no harm. Ids must be integers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.operators.ordering import number_rows
from tallymart.operators.skew import salted_join
from tallymart.session import write_through

RUN_BITS = 3  # eight children a node
BUCKET_BITS = 15
DIGIT_BITS = 16
#: The bucket of the null id, before all buckets of 64-bit ids.
NULL_BUCKET = -(1 << 48) - 1


def field(value: Column) -> Column:
    """What of a column goes into a leaf: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def proof_hash(steps: Column) -> Column:
    """Hash of the siblings on the way to the root, level by level, left to right."""
    others = F.transform(steps, lambda s: F.filter(s["run"], lambda _, i: i != s["slot"]))
    return F.sha2(F.array_join(F.flatten(others), ""), 256)


def folded(steps: Column, leaf: Column) -> Column:
    """The root that follows from a leaf and its siblings."""

    def up(node: Column, step: Column) -> Column:
        return _node(F.transform(step["run"], lambda x, i: F.when(i == step["slot"], node).otherwise(x)))

    return F.aggregate(steps, leaf, up)


def manifest(docs: DataFrame, id: str, group: str, leaf: Column, **carry: Column) -> DataFrame:
    """A row for each of ``docs``: ``id, leaf``, the columns of ``carry``, ``subroot`` (of the group), ``root`` and
    ``steps``: from the leaf's run up to the root's, an array of (``slot`` of the own node, ``run`` of nodes).

    ``carry`` holds functions of the columns that the leaf covers.
    """
    if docs.schema[id].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise ValueError(f"column {id} must hold integers")
    named = F.concat(F.lit("="), F.col(group).cast("string"))
    rows = docs.select(
        F.coalesce(named, F.lit("-")).alias("_group"), F.col(id).cast("long").alias("_id"), leaf.alias("leaf"), *(c.alias(f"_{n}") for n, c in carry.items())
    )
    extra = [F.any_value(f"_{n}").alias(f"_{n}") for n in carry]
    leaves = write_through(rows.groupBy("_group", "_id", "leaf").agg(F.count(F.lit(1)).alias("m"), *extra), "leaves")
    placed = write_through(_placed(leaves), "placed")
    runs, tops = _levels(placed.select("_group", "r", F.col("leaf").alias("node"), "n"))
    subroots = write_through(tops, "subroots")
    ordered = number_rows(subroots, [F.col("_group")]).select(F.lit("").alias("_all"), (F.col("row_no") - 1).alias("r"), "_group", "node")
    langs = write_through(ordered.withColumn("n", F.lit(subroots.count()).cast("long")), "groups")
    upper, root = _levels(langs.select(F.col("_all").alias("_group"), "r", "node", "n"))
    no_steps = F.array().cast("array<struct<slot:bigint,run:array<string>>>")
    top = root.select("_group", F.col("node").alias("root"), no_steps.alias("steps"))
    members = langs.select(F.col("_all").alias("_group"), "r", "n", F.col("_group").alias("name"), F.col("node").alias("subroot"))
    starts = _with_steps(members, upper, top).select(F.col("name").alias("_group"), "subroot", "root", "steps")
    whole = _with_steps(placed, runs, starts)
    return whole.select(F.col("_id").alias("id"), "leaf", *(F.col(f"_{n}").alias(n) for n in carry), "subroot", "root", "steps")


# ---- places ----------------------------------------------------------------------------------

ID = ["_group", "bucket", "bit"]


def _placed(leaves: DataFrame) -> DataFrame:
    """A row for each leaf with its place ``r`` (from 0) among the ``n`` leaves of its group."""
    bucket = F.coalesce(F.shiftright("_id", BUCKET_BITS), F.lit(NULL_BUCKET))
    bit = F.coalesce(F.col("_id").bitwiseAND((1 << BUCKET_BITS) - 1), F.lit(0).cast("long"))
    keyed = leaves.withColumns({"bucket": bucket, "bit": bit})
    ids = keyed.groupBy(*ID).agg(F.sum("m").alias("m"), F.count(F.lit(1)).alias("kinds"))
    directory = write_through(_directory(ids), "directory")
    sizes = directory.groupBy("_group").agg(F.sum("size").alias("n"))
    starts = _starts(directory.select("_group", F.col("bucket").alias("key"), F.col("size").alias("total")))
    table = directory.join(starts.withColumnRenamed("key", "bucket"), ["_group", "bucket"]).join(sizes, "_group")
    place = F.aggregate("planes", F.col("before"), lambda total, p: total + _rank(p) * _power(p["plane"]))
    found = salted_join(keyed, table, ["_group", "bucket"]).select(*keyed.columns, "n", place.alias("place"))
    ties = _ties(keyed.join(ids.filter("kinds > 1").select(*ID), ID, "leftsemi"))
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("copy")
    each = found.join(ties, [*ID, "leaf"], "left").select(*leaves.columns, "n", "place", "tie", copy)
    return each.withColumn("r", F.col("place") + F.coalesce("tie", F.lit(0)) + F.col("copy")).drop("place", "tie", "copy", "m")


def _directory(ids: DataFrame) -> DataFrame:
    """The bitmaps of every bucket: ``planes``, an array of (plane, first byte, bytes), and ``size``, their ranks."""
    plane = F.explode(F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: F.getbit("m", k) == 1)).alias("plane")
    planes = ids.select(*ID, plane).groupBy("_group", "bucket", "plane")
    maps = planes.agg(F.bitmap_construct_agg("bit").alias("bits"), F.min("bit").alias("low"), F.max("bit").alias("high"))
    first = F.shiftright("low", 3).cast("int")
    used = F.substring(F.col("bits"), first + 1, F.shiftright("high", 3).cast("int") - first + 1)
    kept = maps.select("_group", "bucket", F.struct("plane", first.alias("first"), used.alias("bits")).alias("p"))
    size = F.sum(F.bitmap_count("p.bits") * _power(F.col("p.plane")))
    return kept.groupBy("_group", "bucket").agg(F.collect_list("p").alias("planes"), size.alias("size"))


def _power(exponent: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), exponent)


def _rank(plane: Column) -> Column:
    """Number of bits of a plane before ``bit``."""
    byte = F.shiftright("bit", 3).cast("int") - plane["first"]
    own = F.conv(F.hex(F.substring(plane["bits"], byte + 1, F.lit(1))), 16, 10).cast("int")
    below = _power(F.col("bit").bitwiseAND(7).cast("int")) - 1
    inside = F.bitmap_count(F.substring(plane["bits"], F.lit(1), byte)) + F.bit_count(F.coalesce(own, F.lit(0)).cast("long").bitwiseAND(below))
    # before its first byte a plane has no bits; behind its last one it has all
    return F.when(byte < 0, 0).otherwise(inside).cast("long")


def _starts(totals: DataFrame) -> DataFrame:
    """``before``: the total of all smaller keys of the group. No window has over 2^16 rows: keys are summed by their
    upper digits first, and a total starts from that of the digits above."""
    levels = [totals]
    for _ in range(3):  # at most three keys are left
        upper = F.shiftright("key", DIGIT_BITS).alias("key")
        levels.append(levels[-1].groupBy("_group", upper).agg(F.sum("total").alias("total")))
    found = None
    for level in reversed(levels):
        parted = level.withColumn("upper", F.lit(0) if found is None else F.shiftright("key", DIGIT_BITS))
        window = Window.partitionBy("_group", "upper").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
        summed = parted.withColumn("before", F.coalesce(F.sum("total").over(window), F.lit(0)))
        if found is not None:
            above = found.select("_group", F.col("key").alias("upper"), F.col("before").alias("start"))
            summed = summed.join(above, ["_group", "upper"]).withColumn("before", F.col("before") + F.col("start"))
        found = summed.select("_group", "key", "before")
    return found


def _ties(leaves: DataFrame) -> DataFrame:
    """Place of a leaf hash among those of its id: by its first 16 bits, then among those alike in them."""
    keyed = leaves.withColumn("head", F.substring("leaf", 1, 4))
    heads = keyed.groupBy(*ID, "head").agg(F.sum("m").alias("total"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("total").over(before.partitionBy(*ID).orderBy("head")), F.lit(0))
    inner = F.coalesce(F.sum("m").over(before.partitionBy(*ID, "head").orderBy("leaf")), F.lit(0))
    inside = keyed.select(*ID, "head", "leaf", inner.alias("inner"))
    return inside.join(heads.select(*ID, "head", start.alias("start")), [*ID, "head"]).select(
        *ID, "leaf", (F.col("start") + F.col("inner")).alias("tie")
    )


# ---- levels ----------------------------------------------------------------------------------


def _node(run: Column) -> Column:
    return F.sha2(F.array_join(run, ""), 256)


def _levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The runs of every level above ``nodes`` (``_group, r, node``, ``n`` nodes in the group) and the groups' tops."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    runs, tops = [], nodes.filter("n = 1").select("_group", "node")
    while most > 1:
        slots = F.array_sort(F.collect_list(F.struct(F.col("r").bitwiseAND((1 << RUN_BITS) - 1).alias("slot"), "node")))
        run = (
            nodes.filter("n > 1")
            .groupBy("_group", F.shiftright("r", RUN_BITS).alias("r"))
            .agg(F.transform(slots, lambda s: s["node"]).alias("run"), F.first("n").alias("n"))
            .withColumn("n", F.shiftright(F.col("n") + (1 << RUN_BITS) - 1, RUN_BITS))
        )
        runs.append(write_through(run, "runs"))
        nodes = runs[-1].select("_group", "r", _node(F.col("run")).alias("node"), "n")
        tops = tops.unionByName(nodes.filter("n = 1").select("_group", "node"))
        most = (most + (1 << RUN_BITS) - 1) >> RUN_BITS
    return runs, tops


def _with_steps(leaves: DataFrame, runs: list[DataFrame], starts: DataFrame) -> DataFrame:
    """``leaves`` (``_group, r, n``) with what ``starts`` has for their group, its ``steps`` led on down to the leaf."""
    above = None
    for nodes in [*reversed(runs), leaves]:
        here = nodes.filter("n = 1").join(starts, "_group")
        if above is not None:
            slot = F.col("r").bitwiseAND((1 << RUN_BITS) - 1).alias("slot")
            step = F.array(F.struct(slot, F.col("upper_run").alias("run")))
            upper = above.withColumnsRenamed({"r": "upper", "run": "upper_run"}).drop("n")
            lower = nodes.filter("n > 1").withColumn("upper", F.shiftright("r", RUN_BITS)).join(upper, ["_group", "upper"])
            here = here.unionByName(lower.withColumn("steps", F.concat(step, "steps")).drop("upper", "upper_run"))
        above = here
    return above
