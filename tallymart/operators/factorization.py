"""Matrix factorisation on (user_id, item_id, rating) rows: MLlib's block ALS and a distributed truncated SVD."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators import subspace
from tallymart.operators.half_steps import HalfSteps, whole_id
from tallymart.operators.inner_product import largest_products
from tallymart.operators.ordering import top_per_group
from tallymart.operators.relational import dense_codes, error_scores
from tallymart.operators.skew import attach_totals, one_row, salted_join
from tallymart.session import shared_folder, write_through

USER, ITEM, RATING = "user_id", "item_id", "rating"

# The customary training settings.
IMPLICIT = {"rank": 16, "maxIter": 10, "regParam": 0.1, "alpha": 80.0, "seed": 49247}
EXPLICIT = {"rank": 5, "maxIter": 10, "regParam": 0.1, "seed": 1234}

# Every iteration sends a user to each item block that rates them and an item to each user block, so the shuffle grows
# with both numbers. The seeded start is drawn by user block, hence their number is fixed; that of the item blocks leaves
# the start alone.
USER_BLOCKS, ITEM_BLOCKS = 10, 4


def fit_als(ratings: DataFrame, implicit: bool, merge_repeats: bool = False, **settings) -> ALSModel:
    """Block ALS. Repeated (user, item) rows are separate observations, as in plain ALS; with
    ``merge_repeats`` they become one (summed for implicit, averaged for explicit feedback), which
    also takes their load off the shuffle.

    The numbers of blocks do not follow the cluster: neither the result nor the shuffle of an iteration depends on
    its cores. ``settings`` may give other ones. The lineage of long runs is cut in the shared folder every
    ``checkpointInterval`` iterations, which also frees the shuffle files before.
    """
    shared_folder(ratings.sparkSession)
    options = {
        **(IMPLICIT if implicit else EXPLICIT),
        "numUserBlocks": USER_BLOCKS,
        "numItemBlocks": ITEM_BLOCKS,
        "checkpointInterval": 10,
        **settings,
    }
    if merge_repeats:
        weight = F.sum(RATING) if implicit else F.avg(RATING)
        cells = ratings.groupBy(USER, ITEM).agg(weight.cast("float").alias(RATING))
    else:
        cells = ratings.select(USER, ITEM, F.col(RATING).cast("float"))
    cells = cells.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return ALS(
            userCol=USER,
            itemCol=ITEM,
            ratingCol=RATING,
            implicitPrefs=implicit,
            coldStartStrategy="drop",
            **options,
        ).fit(cells)
    finally:
        cells.unpersist()


def _best(left: DataFrame, right: DataFrame, k: int, key: str, other: str, only: DataFrame | None = None) -> DataFrame:
    if only is not None:
        left = left.join(only.select(F.col(key).alias("id")).distinct(), "id", "left_semi")
    return largest_products(left, right, k).withColumnsRenamed({"query": key, "row": other})


def recs_for_all_users(model: ALSModel, k: int) -> DataFrame:
    """The k items with the highest score of every user; the search is exact and compares no user with all items
    unless the factors' lengths leave no other way."""
    return _best(model.userFactors, model.itemFactors, k, USER, ITEM)


def recs_for_users(model: ALSModel, users: DataFrame, k: int) -> DataFrame:
    return _best(model.userFactors, model.itemFactors, k, USER, ITEM, users)


def users_for_items(model: ALSModel, items: DataFrame, k: int) -> DataFrame:
    return _best(model.itemFactors, model.userFactors, k, ITEM, USER, items)


def decode_recs(recs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Replace codes by the original keys: code tables hold (cust_id, user_id) and (product_id, item_id)."""
    return recs.join(users, USER).join(items, ITEM).select("cust_id", "product_id", "rank", "score")


def predict(model: ALSModel, cells: DataFrame) -> DataFrame:
    """Scores of the given cells; cells with an unknown user or item drop out."""
    return model.transform(cells).withColumn("prediction", F.col("prediction").cast("double"))


def factor_table(model: ALSModel) -> DataFrame:
    """All factors in long form: (side, id, position, value)."""
    def side(name: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(name).alias("side"), "id", F.posexplode("features").alias("position", "value"))

    return side("user", model.userFactors).unionByName(side("item", model.itemFactors))


def rmse_train_test(model: ALSModel, train: DataFrame, test: DataFrame, distinct: bool = False) -> DataFrame:
    """Error on both parts. Repeated interactions count repeatedly unless ``distinct``."""
    rows = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    if distinct:
        rows = rows.distinct()
    return error_scores(predict(model, rows), RATING, "prediction", ["part"])


def rmse_all_and_distinct(model: ALSModel, train: DataFrame, test: DataFrame) -> DataFrame:
    """Both forms of ``rmse_train_test`` (``rows_used``: all, distinct); different rows are scored once, with their number."""
    rows = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    scored = predict(model, rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_times")))
    miss = F.col(RATING) - F.col("prediction")
    sums = scored.filter(miss.isNotNull()).groupBy("part").agg(
        F.sum("_times").alias("_all"),
        F.sum(F.col("_times") * miss * miss).alias("_all_squares"),
        F.count(F.lit(1)).alias("_distinct"),
        F.sum(miss * miss).alias("_distinct_squares"),
    )
    kinds = F.explode(F.array(*(
        F.struct(F.col(f"_{kind}").alias("n"), (F.col(f"_{kind}_squares") / F.col(f"_{kind}")).alias("mse"), F.lit(kind).alias("rows_used"))
        for kind in ("all", "distinct")
    )))
    return sums.select("part", kinds.alias("_k")).select("part", "_k.n", "_k.mse", F.sqrt("_k.mse").alias("rmse"), "_k.rows_used")


def learning_curve(train: DataFrame, test: DataFrame, epochs: list[int], **settings) -> DataFrame:
    """Train and test error after every epoch up to the last of ``epochs``.

    One run passes through all of them: MLlib draws the seeded start (it depends on the users and their blocks only, so
    one row of each is enough for it), and every epoch adds two half steps. The result is that of a fit for each epoch.
    """
    options = {"rank": 20, "regParam": 0.1, "seed": 1234, "checkpointInterval": 2, **settings}
    ids = [whole_id(USER).alias("user"), whole_id(ITEM).alias("item")]
    given = F.col(RATING).cast("double").alias("rating")
    wrong = F.raise_error(F.lit("ALS needs ratings that are numbers")).cast("double")
    fitted = F.when(F.col(RATING).isNull() | F.isnan(F.col(RATING).cast("float")), wrong).otherwise(F.col(RATING).cast("double")).alias("rating")
    rows = train.select(*ids, fitted, F.lit("train").alias("part")).unionByName(
        test.filter(F.col(RATING).isNotNull()).select(*ids, given, F.lit("test").alias("part"))
    )
    rows = write_through(rows, "curve")
    once = rows.filter("part = 'train'").groupBy(F.col("user").alias(USER)).agg(F.min("item").alias(ITEM), F.lit(1.0).alias(RATING))
    start = write_through(fit_als(once, implicit=False, maxIter=0, **options).userFactors, "start")
    steps = HalfSteps(rows, options["rank"], options["regParam"])
    out = None
    for epoch, errors in enumerate(steps.epochs(start, max(epochs)), 1):
        row = errors.withColumn("epoch", F.lit(epoch))
        out = row if out is None else out.unionByName(row)
    return out.select("epoch", "part", "n", "rmse")


def actual_vs_predicted(model: ALSModel, ratings: DataFrame, users: DataFrame, n: int = 5) -> DataFrame:
    """First rated items of the given users with actual and predicted rating."""
    rows = ratings.join(users.select(USER), USER, "left_semi")
    first = top_per_group(rows, [USER], [F.asc(ITEM)], n)
    return predict(model, first).select(USER, ITEM, F.col(RATING).alias("actual"), "prediction")


# ---- truncated SVD ---------------------------------------------------------------------------


class Factors:
    """Rank-k factors of a sparse matrix: left (row, code, u), right (column, code, v) and the singular values."""

    def __init__(self, left: DataFrame, right: DataFrame, values: list[float]):
        self.left, self.right, self.values = left, right, values


def svd(cells: DataFrame, row: str, column: str, value: str, k: int, **settings) -> Factors:
    """Truncated SVD by block subspace iteration (``settings``: steps, tolerance, seed). (row, column) must be unique.

    Both factors stay tables; the driver sees matrices of about k x k only.
    """
    rows = write_through(dense_codes(cells, row, "_i"), "codes")
    columns = write_through(dense_codes(cells, column, "_j"), "codes")
    coded = salted_join(salted_join(cells, rows, [row]), columns, [column])
    entries = coded.select(F.col("_i").alias("i"), F.col("_j").alias("j"), F.col(value).cast("double").alias("value"))
    left, right, values = subspace.factorise(entries, rows.count(), columns.count(), k, **settings)
    left = rows.join(left.withColumnsRenamed({"code": "_i", "vector": "u"}), "_i").select(row, "u")
    right = columns.join(right.withColumnsRenamed({"code": "_j", "vector": "v"}), "_j").select(column, "v")
    return Factors(write_through(left, "svd-left"), write_through(right, "svd-right"), values)


def _dot(left, right, weights: list[float] | None = None):
    both = F.zip_with(left, right, lambda a, b: a * b)
    if weights is not None:
        both = F.zip_with(both, F.array(*(F.lit(w) for w in weights)), lambda a, w: a * w)
    return F.aggregate(both, F.lit(0.0), lambda total, x: total + x)


def reconstruct(factors: Factors, cells: DataFrame, row: str, column: str, name: str = "prediction") -> DataFrame:
    """Low-rank value of the given cells."""
    return (
        cells.join(factors.left, row)
        .join(factors.right, column)
        .withColumn(name, _dot(F.col("u"), F.col("v"), factors.values))
        .drop("u", "v")
    )


def centred(ratings: DataFrame, row: str, min_values: int) -> DataFrame:
    """Rows with at least ``min_values`` ratings, less their mean (kept as ``row_mean``)."""
    sized = attach_totals(ratings, [row], row_mean=F.avg(RATING), _count=F.count(F.lit(1)))
    return sized.filter(F.col("_count") >= min_values).withColumn("value", F.col(RATING) - F.col("row_mean")).drop("_count")


def normalised_rows(factors: Factors, row: str) -> DataFrame:
    """Left factors scaled by the singular values, each row of length 1."""
    weighted = F.zip_with("u", F.array(*(F.lit(s) for s in factors.values)), lambda a, s: a * s)
    lengths = factors.left.select(row, weighted.alias("w")).withColumn("len", F.sqrt(_dot(F.col("w"), F.col("w"))))
    return lengths.filter(F.col("len") > 0).select(row, F.transform("w", lambda x: x / F.col("len")).alias("w"))


def latent_similar(factors: Factors, row: str, target: DataFrame, k: int) -> DataFrame:
    """Rows most similar to the one given row by the cosine of their factors."""
    rows = normalised_rows(factors, row)
    wanted = one_row(rows.join(target.select(row), row, "left_semi").limit(1))
    scored = rows.withColumn("_t", wanted).filter(F.col(row) != F.col("_t")[row])
    return scored.select(
        F.col("_t")[row].alias("target"), row, _dot(F.col("w"), F.col("_t")["w"]).alias("similarity")
    ).orderBy(F.desc("similarity"), row).limit(k)


def latent_pairs(factors: Factors, row: str, pairs: DataFrame) -> DataFrame:
    """Cosine of the factors of two given rows: ``pairs`` (a, b) with ``similarity``; null if either has no length."""
    rows = normalised_rows(factors, row)
    first, second = (rows.select(F.col(row).alias(side), F.col("w").alias(f"_{side}")) for side in "ab")
    both = pairs.select("a", "b").join(first, "a", "left").join(second, "b", "left")
    return both.select("a", "b", F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), _dot(F.col("_a"), F.col("_b"))).alias("similarity"))


def svd_predict(
    factors: Factors, means: DataFrame, cells: DataFrame, row: str, column: str, low: float = 0.0, high: float = 5.0
) -> DataFrame:
    """Predicted rating: low-rank value plus the row's mean, clipped to the rating range."""
    placed = reconstruct(factors, cells, row, column, "_raw").join(means.select(row, "row_mean"), row)
    return placed.withColumn(
        "prediction", F.least(F.greatest(F.col("_raw") + F.col("row_mean"), F.lit(low)), F.lit(high))
    ).drop("_raw", "row_mean")


def svd_recommend(
    factors: Factors, means: DataFrame, seen: DataFrame, target: DataFrame, by: str, of: str, k: int
) -> DataFrame:
    """Top k of ``of`` for the one given ``by`` (items for a user, or users for an item) among unseen
    cells, by unclipped prediction. One factor vector meets the other side's table: linear."""
    by_left = by in factors.left.columns
    own, other = (factors.left, factors.right) if by_left else (factors.right, factors.left)
    own_vec, other_vec = ("u", "v") if by_left else ("v", "u")
    row = by if by_left else of
    wanted = one_row(own.join(target.select(by), by, "left_semi").limit(1))
    scored = other.withColumn("_t", wanted).select(
        F.col("_t")[by].alias(by), of, _dot(F.col(other_vec), F.col("_t")[own_vec], factors.values).alias("_raw")
    )
    unseen = scored.join(seen.select(by, of), [by, of], "left_anti").join(means.select(row, "row_mean"), row)
    return unseen.select(by, of, (F.col("_raw") + F.col("row_mean")).alias("prediction")).orderBy(
        F.desc("prediction"), of
    ).limit(k)
