"""Classifier evaluation on (label 0/1, score) rows, and logistic regression."""

from __future__ import annotations

from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.functions.scalar import divide
from tallymart.operators.ordering import number_rows, running_totals
from tallymart.operators.relational import histogram


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    def cell(truth: int, guess: int) -> Column:
        return F.count_if((F.col(label) == truth) & (F.col(predicted) == guess))

    return df.agg(cell(1, 1).alias("tp"), cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"))


def class_metrics(matrix: DataFrame) -> DataFrame:
    """Rates from the four cells; a rate without cases is null."""
    tp, tn, fp, fn = (F.col(c) for c in ("tp", "tn", "fp", "fn"))
    total = tp + tn + fp + fn
    return matrix.select(
        divide(tp + tn, total).alias("accuracy"),
        divide(fp + fn, total).alias("error"),
        divide(tp, tp + fn).alias("recall"),
        divide(tn, tn + fp).alias("specificity"),
        divide(fp, tn + fp).alias("false_positive_rate"),
        divide(tp, tp + fp).alias("precision"),
    )


def score_counts(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score: all the curve needs of the rows."""
    return df.groupBy(F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.sum((1 - F.col(label)).cast("long")).alias("neg")
    )


def roc_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, fpr, tpr) from the highest score down, after a first point (0, 0) without threshold."""
    counts = score_counts(df, label, score)
    running = running_totals(counts, [F.desc("score")], tp="pos", fp="neg")
    totals = counts.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    points = running.withColumn("_t", totals).select(
        F.col("score").alias("threshold"),
        F.try_divide("fp", "_t.n").alias("fpr"),
        F.try_divide("tp", "_t.p").alias("tpr"),
    )
    start = df.sparkSession.range(1).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return start.unionByName(points)


def threshold_eval(curve: DataFrame, threshold: float) -> DataFrame:
    """Sensitivity and specificity of the last curve point strictly above the threshold."""
    above = curve.filter(F.col("threshold").isNull() | (F.col("threshold") > threshold))
    last = F.max_by(F.struct("tpr", "fpr"), F.struct("tpr", "fpr")).alias("_p")
    return above.agg(last).select(
        F.lit(float(threshold)).alias("threshold"),
        F.col("_p.tpr").alias("sensitivity"),
        (1 - F.col("_p.fpr")).alias("specificity"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area by the rank sum of the positives, ties at their average rank."""
    counts = score_counts(df, label, score).withColumn("_c", F.col("pos") + F.col("neg"))
    ranked = running_totals(counts, [F.col("score")], _upto="_c")
    rank = F.col("_upto") - (F.col("_c") - 1) / 2
    sums = ranked.agg(
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
        F.sum(F.col("pos") * rank).alias("ranks"),
    )
    p = F.col("positives").cast("double")
    return sums.select(
        "positives", "negatives", divide(F.col("ranks") - p * (p + 1) / 2, p * F.col("negatives")).alias("auc")
    )


def prob_histogram(df: DataFrame, score: str = "score", bins: int = 8) -> DataFrame:
    return histogram(df, score, bins)


# ---- logistic regression ---------------------------------------------------------------------


def _features(df: DataFrame, predictors: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=predictors, outputCol="features", handleInvalid="skip").transform(df)


def logistic_fit(df: DataFrame, label: str, predictors: list[str], reg: float = 0.0) -> LogisticRegressionModel:
    model = LogisticRegression(labelCol=label, regParam=reg, elasticNetParam=0.0, maxIter=50)
    return model.fit(_features(df.select(label, *predictors), predictors))


def logistic_scores(
    df: DataFrame, model: LogisticRegressionModel, predictors: list[str], threshold: float = 0.5
) -> DataFrame:
    """Probability of class 1 and predicted class beside every row."""
    scored = model.transform(_features(df, predictors))
    probability = vector_to_array("probability")[1]
    return scored.withColumn("score", probability).select(
        *df.columns, "score", (F.col("score") > threshold).cast("int").alias("predicted")
    )


def stratified_folds(df: DataFrame, label: str, order: list[str], k: int, name: str = "fold") -> DataFrame:
    """k folds, contiguous within each class and of equal size up to one row."""
    before = Window.orderBy(label).rowsBetween(Window.unboundedPreceding, -1)  # one row per class
    starts = (
        df.groupBy(label)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    )
    numbered = number_rows(df, [F.col(label), *(F.col(c) for c in order)], "_no")
    at = F.col("_no") - 1 - F.col("_before")
    fold = F.floor(at * k / F.col("_size")) + 1
    return (
        numbered.join(F.broadcast(starts), label)  # two classes
        .withColumn(name, fold.cast("int"))
        .drop("_no", "_size", "_before")
    )


def cv_auc(
    df: DataFrame,
    label: str,
    predictors: list[str],
    order: list[str],
    k: int = 10,
    reg: float = 0.0,
    parallelism: int = 1,
) -> DataFrame:
    """Mean and spread of the area under the curve over k stratified folds: one row.

    ``parallelism``: folds fitted at a time; each holds its training rows in memory or on disk.
    """
    columns = [label, *predictors, *(c for c in order if c not in predictors)]
    folds = stratified_folds(df.select(*columns), label, order, k)
    learner = LogisticRegression(labelCol=label, regParam=reg, elasticNetParam=0.0, maxIter=50)
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=0)
    # plain columns take a fraction of the memory of vectors
    kept = folds.select(label, *predictors, "fold").persist(StorageLevel.MEMORY_AND_DISK)

    def area(fold: int) -> float:
        train = _features(kept.filter(F.col("fold") != fold), predictors).select("features", label)
        test = _features(kept.filter(F.col("fold") == fold), predictors).select("features", label)
        return evaluator.evaluate(learner.fit(train).transform(test))

    try:
        filled = _features(kept, predictors).select("fold").distinct().count()
        if filled < k or k < 2:
            raise ValueError(f"{k} folds asked for, {filled} have rows")
        with ThreadPool(min(parallelism, k)) as pool:
            areas = pool.map(inheritable_thread_target(df.sparkSession)(area), range(1, k + 1))
    finally:
        kept.unpersist()
    return df.sparkSession.createDataFrame(
        [(k, float(np.mean(areas)), float(np.std(areas)))], "folds int, mean_auc double, sd_auc double"
    )
