"""Collaborative filtering on (user_id, item_id, rating) triples with unique pairs.

Missing ratings stay missing: nothing builds a dense matrix. Wherever the dense formula sums over
all users or items, the sum is split into a part over co-rated pairs and a closed form of row totals.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.functions import scalar
from tallymart.functions.scalar import pearson
from tallymart.operators import pair_blocks
from tallymart.operators.ordering import top_per_group
from tallymart.operators.pairs import (
    BLOCK_ROWS,
    cell_products,
    group_pairs,
    listed_sums,
    pair_sums,
    power_sums,
    target_pairs,
    target_rows,
    target_shares,
    target_sums,
)
from tallymart.operators.relational import error_scores
from tallymart.operators.skew import HOT_ROWS, attach_totals, salted_join
from tallymart.session import write_through

USER, ITEM, RATING = "user_id", "item_id", "rating"


def most_active(ratings: DataFrame, key: str = USER, n: int = 1) -> DataFrame:
    """The ``n`` keys with most rows: a target list for the one-user reports."""
    counts = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.desc("_n"), key).limit(n).select(key)


# ---- distances and similarities --------------------------------------------------------------


def co_items(ratings: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Item pairs with the number of users who rated both."""
    return pair_sums(ratings, USER, ITEM, RATING, block_rows).select(
        F.col("a").alias("item_a"), F.col("b").alias("item_b"), F.col("n").alias("users")
    )


def co_users(ratings: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """User pairs with the number of items both rated."""
    return pair_sums(ratings, ITEM, USER, RATING, block_rows).select(
        F.col("a").alias("user_a"), F.col("b").alias("user_b"), F.col("n").alias("items")
    )


def manhattan_pairs(ratings: DataFrame) -> DataFrame:
    """Distance of every two users over the items both rated."""
    return pair_sums(ratings, ITEM, USER).select(
        F.col("a").alias("user_a"), F.col("b").alias("user_b"), F.col("sad").alias("distance")
    )


def manhattan_users(ratings: DataFrame, targets: DataFrame, require_overlap: bool = False) -> DataFrame:
    """Distance from the target users to every other user, nearest first by (distance, user).

    Without a common item the distance is 0, i.e. such users come first, unless ``require_overlap``.
    """
    measured = target_sums(ratings, targets, ITEM, USER).select(
        "target", F.col("other").alias(USER), F.col("sad").alias("distance")
    )
    if require_overlap:
        return measured
    wanted = targets.select(F.col(targets.columns[0]).alias("target")).distinct()
    listed = wanted.agg(F.collect_set("target")).scalar()
    everyone = ratings.select(USER).distinct().withColumn("target", F.explode(listed))
    return (
        everyone.filter(F.col("target") != F.col(USER))
        .join(measured, ["target", USER], "left")
        .select("target", USER, F.coalesce("distance", F.lit(0.0)).alias("distance"))
    )


def _pearson_of_sums() -> Column:
    return pearson(F.col("vx"), F.col("vy"), F.col("vxy"))


def pearson_users(ratings: DataFrame, targets: DataFrame | None = None, both: bool = False) -> DataFrame:
    """Correlation of users over co-rated items; 0 without variance. Pairs without overlap, whose
    value is 0 as well, are not listed. With ``targets``: (target, user_id) rows of those users only. With ``both``
    every pair from either side."""
    if targets is not None:
        return target_sums(ratings, targets, ITEM, USER).select(
            "target", F.col("other").alias(USER), "n", _pearson_of_sums().alias("similarity")
        )
    return pair_sums(ratings, ITEM, USER, both=both).select(
        F.col("a").alias("user_a"), F.col("b").alias("user_b"), "n", _pearson_of_sums().alias("similarity")
    )


def _unit(ratings: DataFrame, key: str) -> DataFrame:
    """Ratings scaled so that each key's vector has length 1."""
    squares = {"_len": F.sqrt(F.sum(F.col(RATING) * F.col(RATING)))}
    return attach_totals(ratings, [key], **squares).withColumn("unit", scalar.divide(F.col(RATING), F.col("_len"), 0.0)).drop("_len")


def _cosine_by_blocks(ratings: DataFrame, group: str, member: str, **settings) -> DataFrame:
    """Cosine of members a < b of a common group, by pairs of blocks: their lengths are worked out in the block."""

    def prepare(side: dict) -> dict:
        squares = np.bincount(side["place"], side["v"].astype(float) ** 2, len(side["members"]))
        return {**side, "len": np.sqrt(squares)}

    def sums(x: dict, y: dict, i: np.ndarray, j: np.ndarray, starts: np.ndarray) -> dict:
        product = np.add.reduceat(x["v"][i].astype(float) * y["v"][j], starts)
        lengths = x["len"][x["place"][i[starts]]] * y["len"][y["place"][j[starts]]]
        return {"similarity": np.divide(product, lengths, out=np.zeros(len(starts)), where=lengths != 0)}

    return pair_blocks.pair_rows(ratings, group, member, RATING, prepare, sums, "similarity double", **settings)


def cosine_users(ratings: DataFrame) -> DataFrame:
    """Cosine of users with missing ratings as 0; pairs without overlap have 0 and are not listed."""
    if pair_blocks.fits(ratings, ITEM, USER, RATING):
        return _cosine_by_blocks(ratings, ITEM, USER).withColumnsRenamed({"a": "user_a", "b": "user_b"})
    return pair_sums(_unit(ratings, USER), ITEM, USER, "unit").select(
        F.col("a").alias("user_a"), F.col("b").alias("user_b"), F.col("sxy").alias("similarity")
    )


def cosine_items(ratings: DataFrame, both: bool = False) -> DataFrame:
    """Cosine of co-rated items a < b; with ``both`` every pair from either side."""
    if not both and pair_blocks.fits(ratings, USER, ITEM, RATING):
        return _cosine_by_blocks(ratings, USER, ITEM).withColumnsRenamed({"a": "item_a", "b": "item_b"})
    return pair_sums(_unit(ratings, ITEM), USER, ITEM, "unit", both=both).select(
        F.col("a").alias("item_a"), F.col("b").alias("item_b"), F.col("sxy").alias("similarity")
    )


def item_neighbours(ratings: DataFrame, n: int, places: int | None = None) -> DataFrame:
    """The ``n`` most similar items of every item (cosine, then item id). An item with fewer
    overlapping items has fewer neighbours.

    All partners of an item are in its own tasks, which pass on ``n`` of them."""
    score = F.round("similarity", places) if places is not None else F.col("similarity")
    pairs = cosine_items(ratings, both=True).select(F.col("item_a").alias(ITEM), F.col("item_b").alias("neighbour"), score.alias("similarity"))
    return top_per_group(pairs, [ITEM], [F.desc("similarity"), F.asc("neighbour")], n)


# ---- item correlation over all users ---------------------------------------------------------


def item_spread(ratings: DataFrame) -> DataFrame:
    """Per item: number of raters, total and N-fold standard deviation over all users, missing ratings counted as 0.
    Items without variance are left out: their correlation is undefined.

    The squares are summed about the raters' mean; the users without a rating add a term of that mean, so ratings far
    from zero lose no digits.
    """
    users = ratings.agg(F.count_distinct(USER)).scalar()
    sums = ratings.groupBy(ITEM).agg(
        F.count(RATING).alias("raters"), F.sum(RATING).alias("total"), F.avg(RATING).alias("mean"), F.var_pop(RATING).alias("var")
    )
    raters = F.col("raters")
    variance = users * raters * F.col("var") + raters * (users - raters) * F.col("mean") * F.col("mean")
    return sums.select(ITEM, "raters", "total", F.sqrt(variance).alias("spread")).filter("spread > 0")


def _item_covariance(users: Column, x: Column, y: Column) -> Column:
    """N * N-fold covariance over all users of a co-rated pair (columns n, sx, sy, vxy over the shared users), from the
    items' totals ``x`` and ``y`` (structs raters, total).

    The users fall into four groups: rated both, one, the other, none. Each adds its own co-moment and that of its
    means about the means over all users.
    """
    n, mean_x, mean_y = F.col("n"), x["total"] / users, y["total"] / users
    only_x, only_y = x["raters"] - n, y["raters"] - n
    neither = users - n - only_x - only_y
    rest_x = F.when(only_x > 0, x["total"] - F.col("sx") - only_x * mean_x).otherwise(0.0)
    rest_y = F.when(only_y > 0, y["total"] - F.col("sy") - only_y * mean_y).otherwise(0.0)
    both = n * F.col("vxy") + n * (F.col("sx") / n - mean_x) * (F.col("sy") / n - mean_y)
    return users * (both - rest_x * mean_y - rest_y * mean_x + neither * mean_x * mean_y)


def _within_one(value: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value))


def item_correlation(ratings: DataFrame) -> DataFrame:
    """Correlation of items over all users for every co-rated pair.

    A pair nobody rated together has ``-total_a * total_b / (spread_a * spread_b)``, which follows
    from ``item_spread``; those pairs are not listed.
    """
    if pair_blocks.fits(ratings, USER, ITEM, RATING):
        return _item_correlation_by_blocks(ratings)
    users = ratings.agg(F.count_distinct(USER)).scalar()
    scaled = salted_join(ratings, item_spread(ratings), [ITEM])
    totals = ["raters", "total", "spread"]
    x, y = F.col(f"x_{RATING}"), F.col(f"y_{RATING}")
    pairs = group_pairs(scaled, USER, ITEM, [RATING, *totals]).groupBy("a", "part", "b").agg(
        F.count(F.lit(1)).alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.covar_pop(x, y).alias("vxy"),
        *(F.min(f"{side}_{c}").alias(f"{side}_{c}") for side in "xy" for c in totals),
    )
    of_x, of_y = (F.struct(*(F.col(f"{side}_{c}").alias(c) for c in totals)) for side in "xy")
    value = _item_covariance(users, of_x, of_y) / (F.col("x_spread") * F.col("y_spread"))
    return pairs.select(
        F.col("a").alias("item_a"), F.col("b").alias("item_b"), F.col("n").alias("users"), _within_one(value).alias("correlation")
    )


def _item_correlation_by_blocks(ratings: DataFrame, **settings) -> DataFrame:
    """The same for ratings without nulls, by pairs of blocks of items: the totals of an item are worked out in its block."""
    users = float(ratings.agg(F.count_distinct(USER)).first()[0])

    def prepare(side: dict) -> dict:
        place, v, n = side["place"], side["v"].astype(float), len(side["members"])
        raters = np.bincount(place, minlength=n).astype(float)
        total = np.bincount(place, v, n)
        mean = total / raters
        var = np.bincount(place, (v - mean[place]) ** 2, n) / raters
        spread = np.sqrt(users * raters * var + raters * (users - raters) * mean * mean)
        return pair_blocks.keep({**side, "raters": raters, "total": total, "spread": spread}, spread > 0)

    def sums(x: dict, y: dict, i: np.ndarray, j: np.ndarray, starts: np.ndarray) -> dict:
        counts = pair_blocks.runs(starts, len(i))
        n = counts.astype(float)
        (sx, dx), (sy, dy) = (_about_the_mean(side["v"][at].astype(float), starts, counts) for side, at in ((x, i), (y, j)))
        a, b = x["place"][i[starts]], y["place"][j[starts]]
        mean_x, mean_y = x["total"][a] / users, y["total"][b] / users
        only_x, only_y = x["raters"][a] - n, y["raters"][b] - n
        neither = users - n - only_x - only_y
        rest_x = np.where(only_x > 0, x["total"][a] - sx - only_x * mean_x, 0.0)
        rest_y = np.where(only_y > 0, y["total"][b] - sy - only_y * mean_y, 0.0)
        both = np.add.reduceat(dx * dy, starts) + n * (sx / n - mean_x) * (sy / n - mean_y)
        covariance = users * (both - rest_x * mean_y - rest_y * mean_x + neither * mean_x * mean_y)
        return {"users": counts, "correlation": np.clip(covariance / (x["spread"][a] * y["spread"][b]), -1.0, 1.0)}

    pairs = pair_blocks.pair_rows(ratings, USER, ITEM, RATING, prepare, sums, "users long, correlation double", **settings)
    return pairs.withColumnsRenamed({"a": "item_a", "b": "item_b"})


def _about_the_mean(values: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the values of each pair, and the values about their mean."""
    total = np.add.reduceat(values, starts)
    return total, values - np.repeat(total / counts, counts)


def similar_items_band(ratings: DataFrame, low: float = 0.4, high: float = 1.0) -> DataFrame:
    """Item pairs with low < correlation < high. Pairs nobody rated together are negative, so the
    listed pairs are complete for every ``low`` >= 0."""
    if low < 0:
        raise ValueError("the band starts at 0 or above")
    value = F.col("correlation")
    return item_correlation(ratings).filter((value > low) & (value < high))


def correlation_rows(ratings: DataFrame, targets: DataFrame) -> DataFrame:
    """The whole correlation row of every target item: (target, item_id, users, correlation), all other items that vary.

    Missing ratings count as 0, so an item that shares no user with the target has the closed form of the totals; only
    the raters of the targets are joined. A target without ratings or without variance has no row.
    """
    users = ratings.agg(F.count_distinct(USER)).scalar()
    items = item_spread(ratings)
    wanted = targets.select(F.col(targets.columns[0]).alias(ITEM)).distinct()
    totals = F.struct("raters", "total", "spread")
    given = items.join(wanted, ITEM, "left_semi").select(F.col(ITEM).alias("target"), totals.alias("own"))
    shared = (
        target_shares(ratings, targets, USER, ITEM, RATING)
        .groupBy("target", F.col("other").alias(ITEM))
        .agg(*power_sums(F.col("x"), F.col("y")))
    )
    own, other = F.col("own"), F.col("_other")
    covariance = F.when(F.col("n") > 0, _item_covariance(users, own, other)).otherwise(-own["total"] * other["total"])
    return (
        target_rows(items.select(ITEM, totals.alias("_other")), given)
        .select(ITEM, "_other", "_t.*")
        .filter(F.col(ITEM) != F.col("target"))
        .join(shared, ["target", ITEM], "left")
        .select(
            "target", ITEM, F.coalesce("n", F.lit(0)).alias("users"),
            _within_one(covariance / (own["spread"] * other["spread"])).alias("correlation"),
        )
    )


def correlation_band(ratings: DataFrame, targets: DataFrame, low: float = 0.4, high: float = 1.0) -> DataFrame:
    """The part of the targets' correlation rows with low < correlation < high, highest first."""
    value = F.col("correlation")
    return correlation_rows(ratings, targets).filter((value > low) & (value < high)).orderBy("target", value.desc(), ITEM)


def neighbours_of(ratings: DataFrame, targets: DataFrame, n: int, places: int = 9) -> DataFrame:
    """The ``n`` items most similar to each target item by cosine, ties by id. Items that share no user with the target
    have cosine 0: they follow the others in the order of their ids, as far as the list is not full."""
    lengths = ratings.groupBy(ITEM).agg(F.sqrt(F.sum(F.col(RATING) * F.col(RATING))).alias("len"))
    wanted = targets.select(F.col(targets.columns[0]).alias(ITEM)).distinct()
    given = lengths.join(wanted, ITEM, "left_semi").select(F.col(ITEM).alias("target"), F.col("len").alias("own_len"))
    shared = (
        target_shares(ratings, targets, USER, ITEM, RATING)
        .groupBy("target", F.col("other").alias(ITEM))
        .agg(F.sum(F.col("x") * F.col("y")).alias("product"))
    )
    value = scalar.divide(F.coalesce("product", F.lit(0.0)), F.col("len") * F.col("own_len"), 0.0)
    rows = target_rows(lengths, given).select(ITEM, "len", "_t.*").filter(F.col(ITEM) != F.col("target"))
    scored = rows.join(shared, ["target", ITEM], "left").select(
        "target", F.col(ITEM).alias("neighbour"), F.round(value, places).alias("similarity")
    )
    return top_per_group(scored, ["target"], [F.desc("similarity"), F.asc("neighbour")], n)


def merge_titles(ratings: DataFrame, names: DataFrame) -> DataFrame:
    """Ratings by title: items of one title (of ``names``: item_id, title) become one, the smallest id; a user who rated
    several of them has the mean. Items without a title stay as they are."""
    merged = names.filter(F.col("title").isNotNull()).groupBy("title").agg(F.min(ITEM).alias("merged"))
    codes = names.join(merged, "title").select(ITEM, "merged")
    placed = ratings.join(codes, ITEM, "left").withColumn(ITEM, F.coalesce("merged", ITEM))
    return placed.groupBy(USER, ITEM).agg(F.avg(RATING).alias(RATING))


def last_rating(rows: DataFrame, order: list[str]) -> DataFrame:
    """One rating for each (user, item): that of the last row by ``order``, nulls first."""
    last = F.max_by(RATING, F.struct(*order))
    return rows.groupBy(USER, ITEM).agg(last.alias(RATING))


def own_preferences(ratings: DataFrame, flags: DataFrame, targets: DataFrame) -> DataFrame:
    """Mean rating of each target user by genre: (target, genre, preference); ``flags`` holds (item_id, genre)."""
    rated = _own(ratings, targets).join(flags, ITEM)
    return rated.groupBy("target", "genre").agg(F.avg(RATING).alias("preference"))


def own_content_scores(ratings: DataFrame, flags: DataFrame, targets: DataFrame, n: int, places: int = 9) -> DataFrame:
    """The ``n`` unseen items of each target user with the highest sum of that user's genre preferences."""
    scores = (
        own_preferences(ratings, flags, targets)
        .join(flags, "genre")
        .groupBy("target", ITEM)
        .agg(F.round(F.sum("preference"), places).alias("score"))
        .join(_own(ratings, targets).select("target", ITEM), ["target", ITEM], "left_anti")
    )
    return top_per_group(scores, ["target"], [F.desc("score"), F.asc(ITEM)], n)


def _own(ratings: DataFrame, targets: DataFrame) -> DataFrame:
    wanted = targets.select(F.col(targets.columns[0]).alias(USER)).distinct()
    return ratings.join(wanted, USER, "left_semi").withColumnRenamed(USER, "target")


def item_corr_scores(ratings: DataFrame, targets: DataFrame) -> DataFrame:
    """Sum of each item's correlations to the target's items, own items left out.

    Linear in the ratings: the co-rated part is summed over the users who share items with the
    target, the rest is a product of totals.
    """
    users = ratings.agg(F.count_distinct(USER)).scalar()
    items = item_spread(ratings)
    own = _own(ratings, targets).join(items, ITEM).select("target", ITEM, "total", "spread")
    rest = own.groupBy("target").agg(F.sum(F.col("total") / F.col("spread")).alias("rest"))
    # weight of every user: how much of the target's items that user rated
    weights = (
        own.join(ratings.select(F.col(USER).alias("other"), ITEM, RATING), ITEM)
        .groupBy("target", "other")
        .agg(F.sum(F.col(RATING) / F.col("spread")).alias("weight"))
    )
    shared = (
        ratings.withColumnRenamed(USER, "other")
        .join(weights, "other")
        .groupBy("target", ITEM)
        .agg((users * F.sum(F.col(RATING) * F.col("weight"))).alias("shared"))
    )
    pairs = items.withColumn("_t", F.explode(rest.agg(F.collect_list(F.struct("target", "rest"))).scalar()))
    candidates = pairs.select(ITEM, "total", "spread", F.col("_t.target").alias("target"), F.col("_t.rest").alias("rest"))
    score = (F.coalesce("shared", F.lit(0.0)) - F.col("total") * F.col("rest")) / F.col("spread")
    return (
        candidates.join(own.select("target", ITEM), ["target", ITEM], "left_anti")
        .join(shared, ["target", ITEM], "left")
        .select("target", ITEM, score.alias("score"))
    )


def item_corr_recs(ratings: DataFrame, targets: DataFrame, n: int = 20, places: int = 9) -> DataFrame:
    scores = item_corr_scores(ratings, targets).withColumn("score", F.round("score", places))
    return top_per_group(scores, ["target"], [F.desc("score"), F.asc(ITEM)], n)


# ---- recommendations from neighbours ---------------------------------------------------------


def knn_recs(
    ratings: DataFrame, k: int, n: int, targets: DataFrame | None = None, places: int = 9
) -> DataFrame:
    """Items of the k most similar users (Pearson, then user id), weighted by similarity share.

    Sorted before it is cut. Users whose chosen similarities sum to 0 get no rows.
    """
    rounded = F.round("similarity", places).alias("similarity")
    if targets is None:
        directed = pearson_users(ratings, both=True).select(F.col("user_a").alias("target"), F.col("user_b").alias(USER), rounded)
        own = ratings.select(F.col(USER).alias("target"), ITEM)
    else:
        directed = pearson_users(ratings, targets).select("target", USER, rounded)
        own = _own(ratings, targets).select("target", ITEM)
    nearest = top_per_group(directed, ["target"], [F.desc("similarity"), F.asc(USER)], k)
    totals = nearest.groupBy("target").agg(F.sum("similarity").alias("whole")).filter(F.col("whole") != 0)
    weighted = nearest.join(totals, "target").select(
        "target", USER, (F.col("similarity") / F.col("whole")).alias("weight")
    )
    scores = (
        weighted.join(ratings, USER)
        .groupBy("target", ITEM)
        .agg(F.round(F.sum(F.col(RATING) * F.col("weight")), places).alias("score"))
        .join(own, ["target", ITEM], "left_anti")
    )
    return top_per_group(scores, ["target"], [F.desc("score"), F.asc(ITEM)], n)


def nearest_recs(ratings: DataFrame, targets: DataFrame, require_overlap: bool = False) -> DataFrame:
    """Unseen items of the single nearest user by Manhattan distance, best rated first."""
    distances = manhattan_users(ratings, targets, require_overlap)
    nearest = distances.groupBy("target").agg(F.min_by(USER, F.struct("distance", USER)).alias(USER))
    return (
        nearest.join(ratings, USER)
        .select("target", F.col(USER).alias("neighbour"), ITEM, RATING)
        .join(_own(ratings, targets).select("target", ITEM), ["target", ITEM], "left_anti")
    )


def slope_one_deviations(ratings: DataFrame) -> DataFrame:
    """Mean rating difference a - b and its user count for co-rated items a < b (b - a is its negative)."""
    if pair_blocks.fits(ratings, USER, ITEM, RATING):

        def sums(x: dict, y: dict, i: np.ndarray, j: np.ndarray, starts: np.ndarray) -> dict:
            counts = pair_blocks.runs(starts, len(i))
            lead = np.add.reduceat(x["v"][i].astype(float), starts) - np.add.reduceat(y["v"][j].astype(float), starts)
            a, b = pair_blocks.pair_members(x, y, i, j, starts)
            return {"deviation": np.where(a < b, lead, -lead) / counts, "users": counts}

        pairs = pair_blocks.pair_rows(ratings, USER, ITEM, RATING, lambda side: side, sums, "deviation double, users long")
        return pairs.withColumnsRenamed({"a": "item_a", "b": "item_b"})
    return pair_sums(ratings, USER, ITEM).select(
        F.col("a").alias("item_a"),
        F.col("b").alias("item_b"),
        ((F.col("sx") - F.col("sy")) / F.col("n")).alias("deviation"),
        F.col("n").alias("users"),
    )


def slope_one_recs(ratings: DataFrame, targets: DataFrame, n: int = 50, places: int = 9) -> DataFrame:
    """Slope One scores of unseen items: sum((dev + own) * freq) / sum(freq).

    For given users the item-pair table is not needed. A user v who shares m items with the target
    adds ``m * rating_v(i) + sum(own - rating_v)`` to the numerator of every item i rated by v.
    """
    shared = (
        target_pairs(ratings, targets, ITEM, USER)
        .groupBy("target", "other")
        .agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("x") - F.col("y")).alias("lead"))
    )
    scores = (
        shared.join(ratings.withColumnRenamed(USER, "other"), "other")
        .groupBy("target", ITEM)
        .agg(F.sum(F.col("m") * F.col(RATING) + F.col("lead")).alias("top"), F.sum("m").alias("freq"))
        .join(_own(ratings, targets).select("target", ITEM), ["target", ITEM], "left_anti")
        .select("target", ITEM, "freq", F.round(F.col("top") / F.col("freq"), places).alias("score"))
    )
    return top_per_group(scores, ["target"], [F.desc("score"), F.asc(ITEM)], n)


def weighted_history(ratings: DataFrame, neighbours: DataFrame) -> DataFrame:
    """Per user and item: sum(rating * similarity) / sum(similarity) over the item's neighbours, for
    users who rated at least one of them. Unrated neighbours count 0 on top and fully below."""
    neighbours = write_through(neighbours, "near")
    whole = neighbours.groupBy(ITEM).agg(F.sum("similarity").alias("whole"))
    near = neighbours.select(ITEM, F.col("neighbour").alias("_j"), "similarity")
    sums = listed_sums(near, ITEM, "_j", "similarity", ratings.withColumnRenamed(ITEM, "_j"), USER, RATING)
    return sums.join(whole.filter(F.col("whole") != 0), ITEM).select(
        USER, ITEM, (F.col("top") / F.col("whole")).alias("score")
    )


def content_scores(items: DataFrame, preferences: DataFrame, attributes: str = "genres") -> DataFrame:
    """Sum of the user's preference over each item's attributes, matched by name."""
    flags = items.select("*", F.explode(F.array_distinct(attributes)).alias("genre"))
    keep = [c for c in items.columns if c != attributes]
    return flags.join(preferences, "genre").groupBy(*keep).agg(F.sum("preference").alias("score"))


def user_top_items(
    ratings: DataFrame, names: DataFrame, users: DataFrame, n: int
) -> DataFrame:
    """Best rated items of every user with title (item id where there is none) and user label."""
    top = top_per_group(ratings, [USER], [F.desc(RATING), F.asc(ITEM)], n)
    return (
        top.join(names, ITEM, "left")
        .join(users, USER, "left")
        .select(USER, "user_label", ITEM, F.coalesce("title", F.col(ITEM).cast("string")).alias("title"), RATING, "rank")
    )


# ---- memory-based prediction with distance weights -------------------------------------------


def user_based_cf(
    train: DataFrame,
    cells: DataFrame,
    n_users: int | Column,
    n_items: int | Column,
    weights: str = "distance",
    block_rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Mean-centred prediction for the requested (user_id, item_id) cells.

    Means are over all items with missing as 0. ``weights='distance'`` weighs a user by 1 - cosine,
    ``'similarity'`` by the cosine. A user without training rows is at distance 0 from itself.
    """
    squares = F.sum(F.col(RATING) * F.col(RATING))
    lengths = attach_totals(train, [USER], _len=F.sqrt(squares), mean=F.sum(RATING) / n_items)
    rows = write_through(
        lengths.select(
            USER,
            ITEM,
            RATING,
            "mean",
            scalar.divide(F.col(RATING), F.col("_len"), 0.0).alias("unit"),
        ),
        "user-cf",
    )
    item_side = rows.groupBy(ITEM).agg(
        F.count(F.lit(1)).alias("_raters"),
        F.sum("unit").alias("reach"),
        F.sum(F.col("unit") * F.col("mean")).alias("reach_mean"),
        F.sum(RATING).alias("column_total"),
    )
    user_side = (
        salted_join(rows, item_side, [ITEM], count="_raters")
        .groupBy(USER)
        .agg(
            F.sum(F.col("unit") * F.col("reach")).alias("s_total"),
            F.sum(F.col("unit") * F.col("reach_mean")).alias("s_mean"),
            F.max("mean").alias("mean"),
        )
    )
    mean_total = user_side.agg(F.sum("mean")).scalar()
    # sum over the raters v of item i of r(v, i) * cosine(u, v); the length of v is divided out with r(v, i), as plain
    # ratings take less room in the longer lists
    product = cell_products(cells, rows, USER, ITEM, "unit", RATING, "unit", block_rows, hot_rows)
    placed = (
        cells.join(user_side, USER, "left")
        .join(item_side.select(ITEM, "column_total"), ITEM, "left")
        .join(product, [USER, ITEM], "left")
    )

    def known(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0.0))

    near = known("product") - known("s_mean")
    if weights == "similarity":
        top, bottom = near, F.coalesce("s_total", F.lit(1.0))
    else:
        top = (known("column_total") - mean_total) - near
        bottom = n_users - F.coalesce("s_total", F.lit(1.0))
    return placed.select(
        *cells.columns, (known("mean") + F.when(bottom != 0, top / bottom).otherwise(0.0)).alias("prediction")
    )


def item_based_cf(
    train: DataFrame,
    cells: DataFrame,
    n_items: int | Column,
    weights: str = "distance",
    block_rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Weighted mean of the user's row over all items with weights 1 - cosine (or the cosine)."""
    unit = write_through(_unit(train, ITEM), "item-cf")
    user_side = unit.groupBy(USER).agg(
        F.count(F.lit(1)).alias("_items"), F.sum(RATING).alias("row_total"), F.sum("unit").alias("reach")
    )
    item_side = (
        salted_join(unit, user_side, [USER], count="_items")
        .groupBy(ITEM)
        .agg(F.sum(F.col("unit") * F.col("reach")).alias("s_total"))
    )
    # sum over the user's items j of r(u, j) * cosine(j, i), taken through the raters of item i; the length of j
    # is divided out on the side of u
    product = cell_products(cells, unit, USER, ITEM, "unit", RATING, "unit", block_rows, hot_rows)
    placed = (
        cells.join(user_side.select(USER, "row_total"), USER, "left").join(item_side, ITEM, "left").join(product, [USER, ITEM], "left")
    )
    near = F.coalesce("product", F.lit(0.0))
    if weights == "similarity":
        top, bottom = near, F.coalesce("s_total", F.lit(1.0))
    else:
        top = F.coalesce("row_total", F.lit(0.0)) - near
        bottom = n_items - F.coalesce("s_total", F.lit(1.0))
    return placed.select(*cells.columns, F.when(bottom != 0, top / bottom).otherwise(0.0).alias("prediction"))


def cf_rmse(predicted: DataFrame, truth: str = RATING) -> DataFrame:
    """Error over the held-out cells only."""
    return error_scores(predicted, truth, "prediction")
