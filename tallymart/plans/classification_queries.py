"""Classifier evaluation over the scored view; the logistic models use the line items."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import classify
from tallymart.plans.registry import query
from tallymart.sources import tables

SCORED = "sd AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, l_discount AS score FROM lineitem)"
MATRIX = f"""{SCORED}, pd AS (SELECT label, CAST(score > 0.05 AS INTEGER) AS predicted FROM sd),
  cm AS (SELECT count(*) FILTER (label = 1 AND predicted = 1) AS tp, count(*) FILTER (label = 0 AND predicted = 0) AS tn,
    count(*) FILTER (label = 0 AND predicted = 1) AS fp, count(*) FILTER (label = 1 AND predicted = 0) AS fn FROM pd)"""
CURVE = f"""{SCORED}, g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM sd GROUP BY 1),
  rc AS (SELECT score AS threshold, sum(neg) OVER (ORDER BY score DESC) / sum(neg) OVER () AS fpr,
      sum(pos) OVER (ORDER BY score DESC) / sum(pos) OVER () AS tpr FROM g
    UNION ALL SELECT NULL, 0, 0)"""

PREDICTORS = ["l_quantity", "l_discount", "l_tax"]
LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _predicted(spark, folder):
    return tables.scored(spark, folder).withColumn("predicted", (F.col("score") > 0.05).cast("int"))


def _lines(spark, folder):
    lines = tables.table(spark, folder, "lineitem")
    return lines.select(*LINE_ORDER, *PREDICTORS, (F.col("l_returnflag") == "R").cast("int").alias("label"))


@query("logistic_fit")
def logistic_fit(spark, folder):
    lines = _lines(spark, folder)
    train = lines.filter(F.pmod("l_orderkey", F.lit(4)) != 0)
    model = classify.logistic_fit(train, "label", PREDICTORS)
    return classify.logistic_scores(lines.filter(F.pmod("l_orderkey", F.lit(4)) == 0), model, PREDICTORS)


@query("confusion_matrix", f"WITH {MATRIX} SELECT * FROM cm")
def confusion_matrix(spark, folder):
    return classify.confusion_matrix(_predicted(spark, folder), "label", "predicted")


@query(
    "class_metrics",
    f"""WITH {MATRIX} SELECT round((tp + tn) / (tp + tn + fp + fn), 9) AS accuracy, round((fp + fn) / (tp + tn + fp + fn), 9) AS error,
      round(tp / (tp + fn), 9) AS recall, round(tn / (tn + fp), 9) AS specificity, round(fp / (tn + fp), 9) AS false_positive_rate,
      round(tp / (tp + fp), 9) AS precision FROM cm""",
)
def class_metrics(spark, folder):
    rates = classify.class_metrics(classify.confusion_matrix(_predicted(spark, folder), "label", "predicted"))
    return rates.select(*(F.round(c, 9).alias(c) for c in rates.columns))


@query(
    "prob_histogram",
    f"""WITH {SCORED}, m AS (SELECT min(score) AS lo, max(score) AS hi FROM sd),
      b AS (SELECT least(floor((score - lo) * 8 / (hi - lo)), 7) AS bin FROM sd, m)
    SELECT CAST(r.bin AS INTEGER) AS bin, round(lo + r.bin * ((hi - lo) / 8), 9) AS bin_start, count(b.bin) AS n
    FROM range(8) r(bin) LEFT JOIN b ON b.bin = r.bin, m GROUP BY r.bin, lo, hi""",
)
def prob_histogram(spark, folder):
    return classify.prob_histogram(tables.scored(spark, folder)).withColumn("bin_start", F.round("bin_start", 9))


@query("roc_curve", f"WITH {CURVE} SELECT threshold, round(fpr, 9) AS fpr, round(tpr, 9) AS tpr FROM rc")
def roc_curve(spark, folder):
    curve = classify.roc_curve(tables.scored(spark, folder))
    return curve.select("threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


@query(
    "threshold_eval",
    f"""WITH {CURVE}, lp AS (SELECT * FROM rc WHERE threshold IS NULL OR threshold > 0.05 ORDER BY tpr DESC, fpr DESC LIMIT 1)
    SELECT CAST(0.05 AS DOUBLE) AS threshold, round(tpr, 9) AS sensitivity, round(1 - fpr, 9) AS specificity FROM lp""",
)
def threshold_eval(spark, folder):
    point = classify.threshold_eval(classify.roc_curve(tables.scored(spark, folder)), 0.05)
    return point.select(
        "threshold", F.round("sensitivity", 9).alias("sensitivity"), F.round("specificity", 9).alias("specificity")
    )


@query(
    "roc_auc",
    f"""WITH {SCORED}, r AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS rk FROM sd),
      s AS (SELECT sum(label) AS p, sum(1 - label) AS n, sum(CASE WHEN label = 1 THEN rk END) AS ranks FROM r)
    SELECT CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives, round((ranks - p * (p + 1) / 2) / (p * n), 9) AS auc FROM s""",
)
def roc_auc(spark, folder):
    return classify.roc_auc(tables.scored(spark, folder)).withColumn("auc", F.round("auc", 9))


@query("cv_auc")
def cv_auc(spark, folder):
    return classify.cv_auc(_lines(spark, folder), "label", PREDICTORS, LINE_ORDER, k=10)
