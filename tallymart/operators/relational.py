"""Projections, joins, aggregates, windows and set operations whose meaning differs from the plain
Spark call of the same name."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.operators.ordering import number_rows, running_totals
from tallymart.operators.skew import HOT_ROWS, attach_totals, one_row, salted_join


# ---- expressions -----------------------------------------------------------------------------


def recode(column: str, mapping: dict) -> Column:
    """Replace listed values, keep the others."""
    out = F.col(column)
    for old, new in mapping.items():
        out = F.when(F.col(column) == old, F.lit(new)).otherwise(out)
    return out


def lookup(column: str, mapping: dict) -> Column:
    """Value per key from a literal dictionary; a missing key gives null."""
    pairs = [F.lit(v) for item in mapping.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), F.col(column))


def multi_hot(df: DataFrame, column: str, levels: list[str], sep: str = " ", prefix: str = "") -> DataFrame:
    """One 0/1 column per level of a separated multi-value column; the level list is explicit."""
    parts = F.split(column, sep if len(sep) > 1 else f"[{sep}]")
    return df.select("*", *(F.array_contains(parts, level).cast("int").alias(prefix + level) for level in levels))


def one_hot(df: DataFrame, column: str, levels: list, prefix: str, drop_first: bool = True) -> DataFrame:
    kept = levels[1:] if drop_first else levels
    return df.select("*", *((F.col(column) == level).cast("int").alias(f"{prefix}_{level}") for level in kept))


def random_category(df: DataFrame, cuts: list[float], labels: list[str], seed: int, name: str = "category") -> DataFrame:
    """Seeded random label: the i-th label below the i-th cut, the last one above all cuts."""
    drawn = df.withColumn("_draw", F.rand(seed))
    label = F.lit(labels[-1])
    for cut, text in reversed(list(zip(cuts, labels))):
        label = F.when(F.col("_draw") < cut, text).otherwise(label)
    return drawn.withColumn(name, label).drop("_draw")


# ---- aggregates ------------------------------------------------------------------------------


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column as rows (column_name, nulls, any_null)."""
    counts = df.select(*(F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns))
    return counts.unpivot([], df.columns, "column_name", "nulls").withColumn("any_null", F.col("nulls") > 0)


def exact_quantiles(df: DataFrame, column: str, fractions: dict[str, float], group: list[str] | None = None) -> DataFrame:
    """Linear-interpolated quantiles without holding a group in memory.

    Values are counted, the (group, value) histogram gets running counts over its total order, and
    only the two histogram rows around each wanted position are kept.
    """
    group = group or []
    histogram = df.filter(F.col(column).isNotNull()).groupBy(*group, F.col(column).alias("_v")).agg(
        F.count(F.lit(1)).alias("_c")
    )
    order = [F.col(c) for c in [*group, "_v"]]
    counted = running_totals(histogram, order, _upto="_c")
    spans = counted.groupBy(*group).agg(
        F.sum("_c").alias("_size"),
        F.min(F.col("_upto") - F.col("_c")).alias("_before"),
        F.count(F.lit(1)).alias("_values"),
    )
    if group:
        placed = salted_join(counted, spans, group, count="_values")
    else:
        placed = counted.withColumn("_span", one_row(spans)).select("*", "_span.*")
    hi = F.col("_upto") - F.col("_before")
    lo = hi - F.col("_c") + 1
    picks = []
    for name, fraction in fractions.items():
        at = (F.col("_size") - 1) * F.lit(float(fraction)) + 1
        below, above = F.floor(at), F.ceil(at)
        low = F.max(F.when((lo <= below) & (below <= hi), F.col("_v")))
        high = F.max(F.when((lo <= above) & (above <= hi), F.col("_v")))
        share = F.max(at - below)
        picks.append((low + (high - low) * share).alias(name))
    return placed.groupBy(*group).agg(*picks)


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def _moments(columns: dict[str, Column]) -> list[Column]:
    """count, mean, standard deviation, minimum and maximum of every column, a struct each."""
    return [
        F.struct(
            F.lit(name).alias("column_name"), F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max"),
        ).alias(f"_m{i}")
        for i, (name, v) in enumerate(columns.items())
    ]


def narrowed_quantiles(
    df: DataFrame, columns: list[str], fractions: dict[str, float], accuracy: int = 10_000
) -> DataFrame:
    """Exact linear-interpolated quantiles of several columns in three scans: one row per column.

    The first scan sketches each column and gives a band of values around every quantile, about 6 / ``accuracy`` of the
    rows wide. The second counts what lies below and inside each band, which proves that the band holds the wanted
    positions; where it does not, the band becomes the whole column. Only values inside a band, already counted by
    value, are put in order. ``accuracy`` changes the width of the bands, not the result. The counting scan also gives
    the moments of each column: ``n``, ``mean``, ``std``, ``min``, ``max``.
    """
    of = {c: F.col(c).cast("double") for c in columns}
    slack = 3 / accuracy
    edges = [e for f in fractions.values() for e in (max(f - slack, 0.0), min(f + slack, 1.0))]
    sketch = df.agg(*(F.percentile_approx(v, edges, accuracy).alias(f"_{i}") for i, v in enumerate(of.values()))).first()
    bands = {}
    for i, c in enumerate(columns):
        for j, name in enumerate(fractions):
            if sketch[i] is not None:
                bands[c, name] = (sketch[i][2 * j], sketch[i][2 * j + 1])
    spans = {key: (of[key[0]] < low, of[key[0]].between(low, high)) for key, (low, high) in bands.items()}
    counted = df.agg(
        *_moments(of),
        *(F.count_if(condition) for span in spans.values() for condition in span),
    ).first()
    told = [tuple(row) for row in counted[: len(columns)]]  # one row for each column
    sizes = {row[0]: row[1] for row in told}
    places, kept = [], []
    for i, (c, name) in enumerate(spans):
        below, inside = counted[len(columns) + 2 * i : len(columns) + 2 * i + 2]
        at = (sizes[c] - 1) * float(fractions[name]) + 1
        low, high = math.floor(at), math.ceil(at)
        held = spans[c, name][1]
        if not below < low <= high <= below + inside:
            below, held = 0, of[c].isNotNull()
        places.append((i, c, name, low - below, high - below, at - low))
        kept.append(F.when(held, F.struct(F.lit(i).alias("_band"), of[c].alias("_v"))))
    plan = df.sparkSession.createDataFrame(
        places, "_band int, column_name string, name string, low long, high long, share double"
    )
    moments = df.sparkSession.createDataFrame(
        told, "column_name string, n long, mean double, std double, min double, max double"
    )
    if not kept:
        return moments.select("*", *(F.lit(None).cast("double").alias(name) for name in fractions))
    inside = df.select(F.explode(F.array_compact(F.array(*kept))).alias("_k")).select("_k.*")
    histogram = inside.groupBy("_band", "_v").agg(F.count(F.lit(1)).alias("_c"))
    ordered = running_totals(histogram, [F.col("_band"), F.col("_v")], _upto="_c")
    totals = ordered.groupBy("_band").agg(F.min(F.col("_upto") - F.col("_c")).alias("_before"))  # one row a band
    placed = ordered.join(F.broadcast(totals), "_band").join(F.broadcast(plan), "_band")
    hi = F.col("_upto") - F.col("_before")
    lo = hi - F.col("_c") + 1
    found = placed.groupBy("column_name", "name", "share").agg(
        F.max(F.when(F.col("low").between(lo, hi), F.col("_v"))).alias("a"),
        F.max(F.when(F.col("high").between(lo, hi), F.col("_v"))).alias("b"),
    )
    value = F.col("a") + (F.col("b") - F.col("a")) * F.col("share")
    wide = found.groupBy("column_name").agg(*(F.max(F.when(F.col("name") == n, value)).alias(n) for n in fractions))
    return moments.join(F.broadcast(wide), "column_name", "left")


def describe(df: DataFrame, columns: list[str], group: list[str] | None = None) -> DataFrame:
    """count, mean, standard deviation, minimum, exact quartiles, maximum: one row per column (and group).

    Quartiles of whole columns come from narrowed bands, those of groups from a histogram of each group.
    """
    if not group:
        return narrowed_quantiles(df, columns, QUARTILES)
    keys = [*group, "column_name"]
    structs = _moments({c: F.col(c).cast("double") for c in columns})
    moments = df.groupBy(*group).agg(*structs).select(*group, F.inline(F.array(*(f"_m{i}" for i in range(len(structs))))))
    long = df.select(*group, *(F.col(c).cast("double").alias(c) for c in columns)).unpivot(
        group, columns, "column_name", "_value"
    )
    return moments.join(exact_quantiles(long, "_value", QUARTILES, keys), keys, "left")


def moments(df: DataFrame, column: str) -> DataFrame:
    """Population skewness and kurtosis (3 for a normal), by centred power sums.

    The mean comes from a first pass, so large offsets do not cancel.
    """
    value = F.col(column).cast("double")
    centred = df.filter(value.isNotNull()).select(
        (value - df.agg(F.avg(column)).scalar()).alias("d")
    )
    sums = centred.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.pow("d", F.lit(2))).alias("m2"),
        F.avg(F.pow("d", F.lit(3))).alias("m3"),
        F.avg(F.pow("d", F.lit(4))).alias("m4"),
    )
    return sums.select(
        "n",
        F.try_divide("m3", F.pow("m2", F.lit(1.5))).alias("skewness"),
        F.try_divide("m4", F.col("m2") * F.col("m2")).alias("kurtosis"),
    )


def error_scores(df: DataFrame, truth: str, prediction: str, group: list[str] | None = None) -> DataFrame:
    """Row count, mean squared error and its root."""
    miss = F.col(truth) - F.col(prediction)
    return (
        df.groupBy(*(group or []))
        .agg(F.count(miss).alias("n"), F.avg(miss * miss).alias("mse"))
        .withColumn("rmse", F.sqrt("mse"))
    )


def category_share(df: DataFrame, category: str) -> DataFrame:
    counts = df.groupBy(category).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("percent", F.col("n") * 100 / total)


def dedupe_first(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """First row of every key in ``order``: an aggregate, so it is combined before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*key).agg(best).select(*key, *(F.col("_row")[c].alias(c) for c in rest))


def sparsity(df: DataFrame, user: str, item: str) -> DataFrame:
    """Share of empty cells of the user x item matrix, to three places."""
    sizes = df.agg(
        F.count_distinct(user).alias("users"),
        F.count_distinct(item).alias("items"),
        F.count_distinct(user, item).alias("cells"),
    )
    share = 1 - F.col("cells") / (F.col("users") * F.col("items"))
    return sizes.withColumn("sparsity", F.round(share, 3))


def pivot_mean(df: DataFrame, index: str, column: str, value: str, levels: list) -> DataFrame:
    """Mean of ``value`` per index and level, 0 where there is none. The levels are listed, so no
    extra pass looks for them and the width is bounded."""
    wide = df.groupBy(index).pivot(column, levels).agg(F.avg(value))
    return wide.na.fill(0.0)


# ---- codes, folds, splits --------------------------------------------------------------------


def dense_codes(df: DataFrame, key: str, name: str = "code") -> DataFrame:
    """Zero-based rank of every distinct key in ascending order; null keys are left out first."""
    keys = df.select(key).filter(F.col(key).isNotNull()).distinct()
    return number_rows(keys, [F.col(key)], "_no").select(key, (F.col("_no") - 1).alias(name))


def contiguous_folds(df: DataFrame, order: list[Column], k: int, name: str = "fold") -> DataFrame:
    """k blocks of consecutive rows; the first ``rows % k`` blocks are one row longer."""
    numbered = number_rows(df, order, "_no")
    total = df.agg(F.count(F.lit(1))).scalar()
    small = F.floor(total / k)
    extra = total % k
    head = extra * (small + 1)
    at = F.col("_no") - 1
    fold = F.when(at < head, F.floor(at / (small + 1))).otherwise(F.floor((at - head) / F.greatest(small, F.lit(1))) + extra)
    return numbered.withColumn(name, (fold + 1).cast("int")).drop("_no")


def user_first_n(
    df: DataFrame, user: str, order: list[Column], start: int, stop: int, cap: int | None = None
) -> DataFrame:
    """Rows ``start``..``stop`` of every user in ``order``, at most ``cap`` over all users.

    The upper bound reaches the shuffle as a window group limit.
    """
    window = Window.partitionBy(user).orderBy(*order)
    test = df.withColumn("user_row", F.row_number().over(window)).filter(
        (F.col("user_row") <= stop) & (F.col("user_row") >= start)
    )
    return test.orderBy(*order).limit(cap) if cap else test


def complement(all_rows: DataFrame, part: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``all_rows`` whose key is not in ``part``."""
    return all_rows.join(part.select(*keys), keys, "left_anti")


def modulus_split(df: DataFrame, key: Column, parts: int, test_parts: int) -> tuple[DataFrame, DataFrame]:
    """Repeatable split on an integer key: (train, test)."""
    is_test = F.pmod(key, F.lit(parts)) < test_parts
    return df.filter(~is_test), df.filter(is_test)


def seeded_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    return df.randomSplit(weights, seed)


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum belongs to the last bin; empty bins are kept."""
    value = F.col(column).cast("double")
    limits = one_row(df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")))
    placed = df.filter(value.isNotNull()).withColumn("_lim", limits)
    lo, hi = F.col("_lim")["lo"], F.col("_lim")["hi"]
    raw = F.when(hi > lo, F.floor((value - lo) * bins / (hi - lo))).otherwise(F.lit(0))
    slot = F.least(raw, F.lit(bins - 1)).cast("int")
    counts = placed.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (F.col("_lim")["hi"] - F.col("_lim")["lo"]) / bins
    return (
        frame.join(counts, "bin", "left")
        .withColumn("_lim", limits)
        .select(
            "bin",
            (F.col("_lim")["lo"] + F.col("bin") * width).alias("bin_start"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def stack(df: DataFrame, columns: list[str], keep: list[str] | None = None, name: str = "kind", value: str = "value") -> DataFrame:
    """Stack measures into (kind, value) rows."""
    return df.unpivot(keep or [], columns, name, value)


def attach_group_count(df: DataFrame, keys: list[str], name: str = "counter", hot_rows: int = HOT_ROWS) -> DataFrame:
    return attach_totals(df, keys, hot_rows, **{name: F.count(F.lit(1))})


def tie_ranks(df: DataFrame, column: str, **sums: Column) -> DataFrame:
    """Distinct values with their row count and average rank, and any further aggregates per value.

    Equal values share one row, so the ranks cost one running count over the distinct values.
    """
    counts = df.groupBy(column).agg(
        F.count(F.lit(1)).alias("ties"), *(total.alias(name) for name, total in sums.items())
    )
    ranked = running_totals(counts, [F.col(column)], _upto="ties")
    return ranked.withColumn("avg_rank", F.col("_upto") - (F.col("ties") - 1) / 2).drop("_upto")
