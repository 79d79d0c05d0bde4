"""Matrix factorisation queries. Their values come from iterative solvers, so they have no SQL twin
except where one can be stated."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import factorization as mf
from tallymart.operators import retail
from tallymart.operators.neighbours import most_active
from tallymart.operators.relational import dense_codes, modulus_split, seeded_split
from tallymart.plans.registry import RATINGS, query
from tallymart.session import scratch_path, write_through
from tallymart.sources import readers, sinks, tables


def _ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings are used several times by every model: written once."""
    return write_through(tables.ratings(spark, folder), "ratings")


def _activity(spark: SparkSession, folder: str) -> DataFrame:
    """Heavy customers' purchases of heavy products as implicit feedback."""
    chosen = retail.training_set(tables.transactions(spark, folder).drop("revenue", "ts"))
    return write_through(chosen, "training")


def _coded(chosen: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    users = dense_codes(chosen, "cust_id", "user_id").withColumn("user_id", F.col("user_id").cast("int"))
    items = dense_codes(chosen, "product_id", "item_id").withColumn("item_id", F.col("item_id").cast("int"))
    coded = chosen.join(users, "cust_id").join(items, "product_id").select("user_id", "item_id", "rating")
    return coded, users, items


def _implicit(spark, folder):
    coded, users, items = _coded(_activity(spark, folder))
    return mf.fit_als(coded, implicit=True), users, items


def _split(spark, folder):
    ratings = _ratings(spark, folder)
    train, test = modulus_split(ratings, F.col("user_id") * 31 + F.col("item_id"), 10, 3)
    return ratings, train, test


@query("als_implicit")
def als_implicit(spark, folder):
    model, users, _ = _implicit(spark, folder)
    return model.userFactors.join(users, F.col("id") == F.col("user_id")).select("cust_id", "features")


@query("als_explicit")
def als_explicit(spark, folder):
    ratings, train, test = _split(spark, folder)
    return mf.predict(mf.fit_als(train, implicit=False), test)


@query("als_explicit_events")
def als_explicit_events(spark, folder):
    rows = tables.activity(spark, folder)
    chosen = retail.training_set(rows, retail.negative_feedback()).select("cust_id", "product_id", "rating")
    coded, users, items = _coded(write_through(chosen, "training"))
    model = mf.fit_als(coded, implicit=False, rank=16, regParam=0.1, seed=49247)
    return mf.decode_recs(mf.recs_for_all_users(model, 10), users, items)


@query("recs_for_all_users")
def recs_for_all_users(spark, folder):
    model, _, _ = _implicit(spark, folder)
    return mf.recs_for_all_users(model, 10)


@query("decoded_recs")
def decoded_recs(spark, folder):
    model, users, items = _implicit(spark, folder)
    return mf.decode_recs(mf.recs_for_all_users(model, 10), users, items)


@query("recs_sink")
def recs_sink(spark, folder):
    model, users, items = _implicit(spark, folder)
    path = scratch_path(spark, "recommendations")
    sinks.write_recommendations(mf.decode_recs(mf.recs_for_all_users(model, 10), users, items), path)
    return readers.read_delimited(spark, path, "cust_id long, product_id long, rank int, score double")


@query("recs_for_user")
def recs_for_user(spark, folder):
    ratings = _ratings(spark, folder)
    model = mf.fit_als(ratings, implicit=False)
    return mf.recs_for_users(model, most_active(ratings), 10)


@query("users_for_item")
def users_for_item(spark, folder):
    ratings = _ratings(spark, folder)
    model = mf.fit_als(ratings, implicit=False)
    return mf.users_for_items(model, most_active(ratings, "item_id"), 10)


@query("als_predict")
def als_predict(spark, folder):
    ratings = _ratings(spark, folder)
    return mf.predict(mf.fit_als(ratings, implicit=False), ratings)


@query("als_factors")
def als_factors(spark, folder):
    return mf.factor_table(mf.fit_als(_ratings(spark, folder), implicit=False))


@query("truth_pred_join")
def truth_pred_join(spark, folder):
    ratings, train, test = _split(spark, folder)
    scored = mf.predict(mf.fit_als(train, implicit=False), test.drop("rating"))
    return test.join(scored, ["user_id", "item_id"])


@query("als_rmse_train_test")
def als_rmse_train_test(spark, folder):
    train, test = seeded_split(_ratings(spark, folder), [0.7, 0.3], seed=1234)
    train, test = write_through(train, "train"), write_through(test, "test")
    model = mf.fit_als(train, implicit=False)
    return mf.rmse_train_test(model, train, test)


@query("als_rmse_distinct")
def als_rmse_distinct(spark, folder):
    """Repeated interactions, with and without ``distinct``."""
    coded, _, _ = _coded(_activity(spark, folder))
    coded = coded.withColumn("rating", F.col("rating").cast("double"))
    train, test = modulus_split(coded, F.col("user_id") * 31 + F.col("item_id"), 10, 3)
    model = mf.fit_als(train, implicit=True, rank=5, seed=1234)
    return mf.rmse_all_and_distinct(model, train, test)


@query("svd_lowrank")
def svd_lowrank(spark, folder):
    """Error of the rank-20 reconstruction on the training and the held-out cells."""
    _, train, test = _split(spark, folder)
    factors = mf.svd(train, "user_id", "item_id", "rating", 20)
    rows = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return mf.error_scores(mf.reconstruct(factors, rows, "user_id", "item_id"), "rating", "prediction", ["part"])


def _latent(spark, folder):
    """Items as rows: at least 10 ratings each, mean-centred, rank 100."""
    ratings = _ratings(spark, folder)
    cells = write_through(mf.centred(ratings, "item_id", 10), "centred")
    factors = mf.svd(cells, "item_id", "user_id", "value", 100)
    means = cells.groupBy("item_id").agg(F.max("row_mean").alias("row_mean"))
    return ratings, factors, means


@query("svd_latent_similarity")
def svd_latent_similarity(spark, folder):
    ratings, factors, _ = _latent(spark, folder)
    return mf.latent_similar(factors, "item_id", most_active(ratings, "item_id"), 10)


@query("svd_pair_similarity")
def svd_pair_similarity(spark, folder):
    """Similarity of the most rated item to the next four."""
    ratings, factors, _ = _latent(spark, folder)
    most = write_through(most_active(ratings, "item_id", 5), "most")
    first = most_active(ratings, "item_id").select(F.max("item_id")).scalar()
    pairs = most.select(first.alias("a"), F.col("item_id").alias("b")).filter("a <> b")
    return mf.latent_pairs(factors, "item_id", pairs)


@query("svd_predict_recommend")
def svd_predict_recommend(spark, folder):
    """Items for the most active user and users for the most rated item."""
    ratings, factors, means = _latent(spark, folder)
    items = mf.svd_recommend(factors, means, ratings, most_active(ratings), "user_id", "item_id", 10)
    users = mf.svd_recommend(factors, means, ratings, most_active(ratings, "item_id"), "item_id", "user_id", 10)
    return items.withColumn("list", F.lit("items")).unionByName(users.withColumn("list", F.lit("users")))


@query("svd_predict")
def svd_predict(spark, folder):
    """Clipped prediction beside the stored value of every rated cell."""
    ratings, factors, means = _latent(spark, folder)
    return mf.svd_predict(factors, means, ratings, "item_id", "user_id")


@query(
    "svd_centred_cells",
    f"""WITH {RATINGS}, m AS (SELECT item_id, avg(rating) AS row_mean FROM ratings GROUP BY 1 HAVING count(*) >= 10)
    SELECT user_id, item_id, rating, round(row_mean, 9) AS row_mean, round(rating - row_mean, 9) AS value FROM ratings JOIN m USING (item_id)""",
)
def svd_centred_cells(spark, folder):
    cells = mf.centred(tables.ratings(spark, folder), "item_id", 10)
    return cells.select(
        "user_id", "item_id", "rating", F.round("row_mean", 9).alias("row_mean"), F.round("value", 9).alias("value")
    )


@query("mf_learning_curve")
def mf_learning_curve(spark, folder):
    _, train, test = _split(spark, folder)
    return mf.learning_curve(train, test, [1, 2, 3, 5, 8])


@query("actual_vs_predicted")
def actual_vs_predicted(spark, folder):
    ratings = _ratings(spark, folder)
    model = mf.fit_als(ratings, implicit=False)
    return mf.actual_vs_predicted(model, ratings, most_active(ratings), 5)
