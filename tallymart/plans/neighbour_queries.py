"""Collaborative filtering over the ratings view. One-user reports take the most active user, which
Spark finds in the table; they still score the whole table for that user."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.operators import neighbours as cf
from tallymart.operators.ordering import top_per_group
from tallymart.operators.relational import modulus_split
from tallymart.plans.registry import RATINGS, query
from tallymart.session import write_through
from tallymart.sources import tables


def _ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The view is an aggregate over a join and is read several times below: written once."""
    return write_through(tables.ratings(spark, folder), "ratings")


TARGET = """tg AS (SELECT user_id AS target FROM ratings GROUP BY 1 ORDER BY count(*) DESC, user_id LIMIT 1)"""
UU = """uu AS (SELECT p.user_id AS user_a, q.user_id AS user_b, count(*) AS n, sum(p.rating) AS sx, sum(q.rating) AS sy,
    sum(p.rating * p.rating) AS sxx, sum(q.rating * q.rating) AS syy, sum(p.rating * q.rating) AS sxy,
    sum(abs(p.rating - q.rating)) AS sad
  FROM ratings p JOIN ratings q ON p.item_id = q.item_id AND p.user_id < q.user_id GROUP BY 1, 2)"""
II = """ii AS (SELECT p.item_id AS item_a, q.item_id AS item_b, count(*) AS n, sum(p.rating) AS sx, sum(q.rating) AS sy,
    sum(p.rating * q.rating) AS sxy
  FROM ratings p JOIN ratings q ON p.user_id = q.user_id AND p.item_id < q.item_id GROUP BY 1, 2)"""
PEARSON = """CASE WHEN n * sxx - sx * sx > 0 AND n * syy - sy * sy > 0
    THEN (n * sxy - sx * sy) / (sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy)) ELSE 0.0 END"""
ULEN = "ul AS (SELECT user_id, sqrt(sum(rating * rating)) AS len FROM ratings GROUP BY 1)"
ILEN = "il AS (SELECT item_id, sqrt(sum(rating * rating)) AS len FROM ratings GROUP BY 1)"


@query("self_join_coitems", f"WITH {RATINGS}, {II} SELECT item_a, item_b, n AS users FROM ii")
def self_join_coitems(spark, folder):
    return cf.co_items(_ratings(spark, folder))


@query("self_join_cousers", f"WITH {RATINGS}, {UU} SELECT user_a, user_b, n AS items FROM uu")
def self_join_cousers(spark, folder):
    return cf.co_users(_ratings(spark, folder))


@query("manhattan_users", f"WITH {RATINGS}, {UU} SELECT user_a, user_b, sad AS distance FROM uu")
def manhattan_users(spark, folder):
    return cf.manhattan_pairs(_ratings(spark, folder))


MANHATTAN = f"""{TARGET}, md AS (SELECT tg.target, o.user_id, coalesce(sum(abs(p.rating - q.rating)), 0.0) AS distance
  FROM tg JOIN (SELECT DISTINCT user_id FROM ratings) o ON o.user_id <> tg.target
    LEFT JOIN ratings q ON q.user_id = o.user_id AND q.item_id IN (SELECT item_id FROM ratings WHERE user_id = (SELECT target FROM tg))
    LEFT JOIN ratings p ON p.user_id = tg.target AND p.item_id = q.item_id GROUP BY 1, 2)"""


@query("manhattan_nearest", f"WITH {RATINGS}, {MANHATTAN} SELECT target, user_id, distance FROM md ORDER BY distance, user_id")
def manhattan_nearest(spark, folder):
    ratings = _ratings(spark, folder)
    return cf.manhattan_users(ratings, cf.most_active(ratings)).orderBy("distance", "user_id")


@query("pearson_users", f"WITH {RATINGS}, {UU} SELECT user_a, user_b, n, round({PEARSON}, 9) AS similarity FROM uu")
def pearson_users(spark, folder):
    return cf.pearson_users(_ratings(spark, folder)).withColumn("similarity", F.round("similarity", 9))


@query(
    "cosine_users",
    f"""WITH {RATINGS}, {UU}, {ULEN} SELECT user_a, user_b, round(sxy / (p.len * q.len), 9) AS similarity
    FROM uu JOIN ul p ON p.user_id = user_a JOIN ul q ON q.user_id = user_b""",
)
def cosine_users(spark, folder):
    return cf.cosine_users(_ratings(spark, folder)).withColumn("similarity", F.round("similarity", 9))


COSINE_ITEMS = f"""{II}, {ILEN}, ci AS (SELECT item_a, item_b, round(sxy / (p.len * q.len), 9) AS similarity
    FROM ii JOIN il p ON p.item_id = item_a JOIN il q ON q.item_id = item_b),
  bi AS (SELECT item_a AS item_id, item_b AS neighbour, similarity FROM ci UNION ALL SELECT item_b, item_a, similarity FROM ci),
  nb AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY similarity DESC, neighbour) AS rank FROM bi) z
    WHERE rank <= 10)"""


@query("cosine_items", f"WITH {RATINGS}, {COSINE_ITEMS} SELECT item_id, neighbour, similarity, rank FROM nb")
def cosine_items(spark, folder):
    return cf.item_neighbours(_ratings(spark, folder), 10, places=9)


SPREAD = """nu AS (SELECT count(DISTINCT user_id) AS users FROM ratings),
  sp AS (SELECT item_id, sum(rating) AS total, sqrt(any_value(users) * sum(rating * rating) - sum(rating) * sum(rating)) AS spread
    FROM ratings, nu GROUP BY 1)"""
CORRELATION = f"""{II}, {SPREAD}, co AS (SELECT item_a, item_b, n AS users,
    (nu.users * sxy - p.total * q.total) / (p.spread * q.spread) AS correlation
  FROM ii JOIN sp p ON p.item_id = item_a JOIN sp q ON q.item_id = item_b, nu)"""


@query(
    "item_correlation",
    f"WITH {RATINGS}, {CORRELATION} SELECT item_a, item_b, users, round(correlation, 9) AS correlation FROM co",
)
def item_correlation(spark, folder):
    return cf.item_correlation(_ratings(spark, folder)).withColumn("correlation", F.round("correlation", 9))


@query(
    "similar_items_band",
    f"""WITH {RATINGS}, {CORRELATION} SELECT item_a, item_b, users, round(correlation, 9) AS correlation FROM co
    WHERE correlation > 0.1 AND correlation < 1""",
)
def similar_items_band(spark, folder):
    band = cf.similar_items_band(_ratings(spark, folder), low=0.1)
    return band.withColumn("correlation", F.round("correlation", 9))


ITEM_TARGETS = """it AS (SELECT item_id AS target FROM ratings GROUP BY 1 ORDER BY count(*) DESC, item_id LIMIT 3)"""
CORRELATION_ROWS = f"""{ITEM_TARGETS}, {SPREAD}, cr AS (SELECT q.item_id AS target, p.item_id, count(*) AS n, sum(p.rating * q.rating) AS sxy
    FROM ratings q JOIN ratings p ON p.user_id = q.user_id AND p.item_id <> q.item_id WHERE q.item_id IN (SELECT target FROM it) GROUP BY 1, 2),
  rw AS (SELECT it.target, p.item_id, coalesce(n, 0) AS users,
      (nu.users * coalesce(sxy, 0) - p.total * q.total) / (p.spread * q.spread) AS correlation
    FROM it JOIN sp q ON q.item_id = it.target JOIN sp p ON p.item_id <> it.target
      LEFT JOIN cr ON cr.target = it.target AND cr.item_id = p.item_id, nu WHERE p.spread > 0 AND q.spread > 0)"""


@query(
    "item_correlation_of",
    f"WITH {RATINGS}, {CORRELATION_ROWS} SELECT target, item_id, users, round(correlation, 9) AS correlation FROM rw",
)
def item_correlation_of(spark, folder):
    """The whole correlation rows of the three most rated items."""
    ratings = _ratings(spark, folder)
    rows = cf.correlation_rows(ratings, cf.most_active(ratings, "item_id", 3))
    return rows.withColumn("correlation", F.round("correlation", 9))


@query(
    "similar_items_of",
    f"""WITH {RATINGS}, {CORRELATION_ROWS} SELECT target, item_id, users, round(correlation, 9) AS correlation FROM rw
    WHERE correlation > 0.02 AND correlation < 1""",
)
def similar_items_of(spark, folder):
    ratings = _ratings(spark, folder)
    band = cf.correlation_band(ratings, cf.most_active(ratings, "item_id", 3), low=0.02)
    return band.withColumn("correlation", F.round("correlation", 9))


@query(
    "item_neighbours_of",
    f"""WITH {RATINGS}, {ITEM_TARGETS}, {ILEN}, cr AS (SELECT q.item_id AS target, p.item_id, sum(p.rating * q.rating) AS sxy
      FROM ratings q JOIN ratings p ON p.user_id = q.user_id AND p.item_id <> q.item_id WHERE q.item_id IN (SELECT target FROM it) GROUP BY 1, 2),
    rw AS (SELECT it.target, p.item_id AS neighbour, round(coalesce(sxy, 0) / (p.len * q.len), 9) AS similarity
      FROM it JOIN il q ON q.item_id = it.target JOIN il p ON p.item_id <> it.target
        LEFT JOIN cr ON cr.target = it.target AND cr.item_id = p.item_id)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY similarity DESC, neighbour) AS rank FROM rw) z WHERE rank <= 50""",
)
def item_neighbours_of(spark, folder):
    ratings = _ratings(spark, folder)
    return cf.neighbours_of(ratings, cf.most_active(ratings, "item_id", 3), 50)


MERGED = """mt AS (SELECT *, min(p_partkey) OVER (PARTITION BY p_name) AS merged FROM part),
  mr AS (SELECT user_id, coalesce(merged, item_id) AS item_id, avg(rating) AS rating
    FROM ratings LEFT JOIN mt ON p_partkey = item_id GROUP BY 1, 2)"""


@query(
    "item_correlation_merged_titles",
    f"WITH {RATINGS}, {MERGED}, {CORRELATION_ROWS.replace('ratings', 'mr')} SELECT target, item_id, users, round(correlation, 8) AS correlation FROM rw",
)
def item_correlation_merged_titles(spark, folder):
    """Parts of one name are one title."""
    ratings = write_through(cf.merge_titles(_ratings(spark, folder), tables.item_names(spark, folder)), "merged")
    rows = cf.correlation_rows(ratings, cf.most_active(ratings, "item_id", 3))
    return rows.withColumn("correlation", F.round("correlation", 8))


@query(
    "last_rating",
    """WITH raw AS (SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(CAST(l_quantity AS INTEGER) % 5 + 1 AS DOUBLE) AS rating,
      row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC) AS back
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) SELECT user_id, item_id, rating FROM raw WHERE back = 1""",
)
def last_rating(spark, folder):
    """The rating of the last purchase of each (user, item), by time and row."""
    lines = tables.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    orders = tables.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    rating = (F.col("l_quantity").cast("int") % 5 + 1).cast("double").alias("rating")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"), rating, "o_orderdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"
    )
    return cf.last_rating(rows, ["o_orderdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"])


@query(
    "content_score_own",
    f"""WITH {RATINGS}, {TARGET}, ge AS (SELECT DISTINCT p_partkey AS item_id, unnest(string_split(p_name, ' ')) AS genre FROM part),
      ow AS (SELECT item_id, rating FROM ratings, tg WHERE user_id = target),
      pf AS (SELECT genre, avg(rating) AS preference FROM ow JOIN ge USING (item_id) GROUP BY 1),
      sc AS (SELECT item_id, round(sum(preference), 9) AS score FROM ge JOIN pf USING (genre)
        WHERE item_id NOT IN (SELECT item_id FROM ow) GROUP BY 1)
    SELECT target, item_id, score, row_number() OVER (ORDER BY score DESC, item_id) AS rank FROM sc, tg ORDER BY rank LIMIT 20""",
)
def content_score_own(spark, folder):
    """Unseen items for the most active user by that user's own genre preferences."""
    ratings = _ratings(spark, folder)
    names = tables.item_names(spark, folder)
    flags = names.select("item_id", F.explode(F.array_distinct(F.split("title", " "))).alias("genre"))
    return cf.own_content_scores(ratings, flags, cf.most_active(ratings), 20)


@query(
    "item_corr_recs",
    f"""WITH {RATINGS}, {TARGET}, {SPREAD}, ow AS (SELECT item_id FROM ratings, tg WHERE user_id = target),
      dt AS (SELECT i.item_id, j.item_id AS own_id, coalesce(sum(p.rating * q.rating), 0) AS sxy
        FROM sp i JOIN ow j ON true LEFT JOIN ratings q ON q.item_id = j.item_id
          LEFT JOIN ratings p ON p.item_id = i.item_id AND p.user_id = q.user_id GROUP BY 1, 2),
      sc AS (SELECT dt.item_id, round(sum((users * sxy - p.total * q.total) / (p.spread * q.spread)), 9) AS score
        FROM dt JOIN sp p ON p.item_id = dt.item_id JOIN sp q ON q.item_id = own_id, nu
        WHERE dt.item_id NOT IN (SELECT item_id FROM ow) GROUP BY 1)
    SELECT target, item_id, score, row_number() OVER (ORDER BY score DESC, item_id) AS rank FROM sc, tg ORDER BY rank LIMIT 20""",
)
def item_corr_recs(spark, folder):
    ratings = _ratings(spark, folder)
    return cf.item_corr_recs(ratings, cf.most_active(ratings), 20)


@query(
    "knn_recs",
    f"""WITH {RATINGS}, {UU}, pe AS (SELECT user_a, user_b, round({PEARSON}, 9) AS similarity FROM uu),
      di AS (SELECT user_a AS target, user_b AS user_id, similarity FROM pe UNION ALL SELECT user_b, user_a, similarity FROM pe),
      kn AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY similarity DESC, user_id) AS rn FROM di) z WHERE rn <= 3),
      tt AS (SELECT target, sum(similarity) AS whole FROM kn GROUP BY 1 HAVING sum(similarity) <> 0),
      sc AS (SELECT kn.target, r.item_id, round(sum(r.rating * kn.similarity / whole), 9) AS score
        FROM kn JOIN tt ON tt.target = kn.target JOIN ratings r ON r.user_id = kn.user_id
        WHERE NOT EXISTS (SELECT 1 FROM ratings o WHERE o.user_id = kn.target AND o.item_id = r.item_id) GROUP BY 1, 2)
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY score DESC, item_id) AS rank FROM sc) z WHERE rank <= 10""",
)
def knn_recs(spark, folder):
    return cf.knn_recs(_ratings(spark, folder), k=3, n=10)


@query(
    "nearest_recs",
    f"""WITH {RATINGS}, {MANHATTAN}, ne AS (SELECT target, user_id FROM md ORDER BY distance, user_id LIMIT 1)
    SELECT target, ne.user_id AS neighbour, item_id, rating FROM ne JOIN ratings r ON r.user_id = ne.user_id
    WHERE item_id NOT IN (SELECT item_id FROM ratings, tg WHERE user_id = tg.target)""",
)
def nearest_recs(spark, folder):
    ratings = _ratings(spark, folder)
    return cf.nearest_recs(ratings, cf.most_active(ratings)).orderBy(F.desc("rating"), "item_id")


SPLIT = """te AS (SELECT * FROM ratings WHERE (user_id * 31 + item_id) % 4 = 0),
  tr AS (SELECT * FROM ratings WHERE (user_id * 31 + item_id) % 4 <> 0),
  sz AS (SELECT count(DISTINCT user_id) AS nu, count(DISTINCT item_id) AS ni FROM ratings)"""
USER_CF = f"""{SPLIT}, me AS (SELECT user_id, sum(rating) / any_value(ni) AS mean, sqrt(sum(rating * rating)) AS len FROM tr, sz GROUP BY 1),
  us AS (SELECT p.user_id AS u, q.user_id AS v, sum(p.rating * q.rating) / any_value(a.len * b.len) AS s
    FROM tr p JOIN tr q ON p.item_id = q.item_id JOIN me a ON a.user_id = p.user_id JOIN me b ON b.user_id = q.user_id GROUP BY 1, 2),
  ut AS (SELECT u, sum(s) AS s_total, sum(s * mean) AS s_mean FROM us JOIN me ON me.user_id = v GROUP BY 1),
  ct AS (SELECT item_id, sum(rating) AS column_total FROM tr GROUP BY 1),
  pr AS (SELECT te.user_id, te.item_id, sum(s * tr.rating) AS near FROM te JOIN tr ON tr.item_id = te.item_id
    JOIN us ON us.u = te.user_id AND us.v = tr.user_id GROUP BY 1, 2),
  ux AS (SELECT te.user_id, te.item_id, te.rating, coalesce(mean, 0) +
      (coalesce(column_total, 0) - (SELECT sum(mean) FROM me) - coalesce(near, 0) + coalesce(s_mean, 0)) / (nu - coalesce(s_total, 1)) AS prediction
    FROM te LEFT JOIN me ON me.user_id = te.user_id LEFT JOIN ut ON ut.u = te.user_id LEFT JOIN ct ON ct.item_id = te.item_id
      LEFT JOIN pr ON pr.user_id = te.user_id AND pr.item_id = te.item_id, sz)"""
ITEM_CF = f"""{SPLIT}, le AS (SELECT item_id, sqrt(sum(rating * rating)) AS len FROM tr GROUP BY 1),
  si AS (SELECT p.item_id AS i, q.item_id AS j, sum(p.rating * q.rating) / any_value(a.len * b.len) AS s
    FROM tr p JOIN tr q ON p.user_id = q.user_id JOIN le a ON a.item_id = p.item_id JOIN le b ON b.item_id = q.item_id GROUP BY 1, 2),
  it AS (SELECT i, sum(s) AS s_total FROM si GROUP BY 1),
  rt AS (SELECT user_id, sum(rating) AS row_total FROM tr GROUP BY 1),
  pr AS (SELECT te.user_id, te.item_id, sum(s * tr.rating) AS near FROM te JOIN tr ON tr.user_id = te.user_id
    JOIN si ON si.i = te.item_id AND si.j = tr.item_id GROUP BY 1, 2),
  ix AS (SELECT te.user_id, te.item_id, te.rating, (coalesce(row_total, 0) - coalesce(near, 0)) / (ni - coalesce(s_total, 1)) AS prediction
    FROM te LEFT JOIN rt ON rt.user_id = te.user_id LEFT JOIN it ON it.i = te.item_id
      LEFT JOIN pr ON pr.user_id = te.user_id AND pr.item_id = te.item_id, sz)"""


def _split(spark: SparkSession, folder: str):
    ratings = _ratings(spark, folder)
    train, test = modulus_split(ratings, F.col("user_id") * 31 + F.col("item_id"), 4, 1)
    users = ratings.agg(F.count_distinct("user_id")).scalar()
    items = ratings.agg(F.count_distinct("item_id")).scalar()
    return train, test, users, items


def _user_based(spark, folder) -> DataFrame:
    train, test, users, items = _split(spark, folder)
    return cf.user_based_cf(train, test, users, items)


def _item_based(spark, folder) -> DataFrame:
    train, test, _, items = _split(spark, folder)
    return cf.item_based_cf(train, test, items)


@query("user_based_cf", f"WITH {RATINGS}, {USER_CF} SELECT user_id, item_id, rating, round(prediction, 8) AS prediction FROM ux")
def user_based_cf(spark, folder):
    return _user_based(spark, folder).withColumn("prediction", F.round("prediction", 8))


@query("item_based_cf", f"WITH {RATINGS}, {ITEM_CF} SELECT user_id, item_id, rating, round(prediction, 8) AS prediction FROM ix")
def item_based_cf(spark, folder):
    return _item_based(spark, folder).withColumn("prediction", F.round("prediction", 8))


@query(
    "user_based_cf_similarity",
    f"""WITH {RATINGS}, {USER_CF} SELECT te.user_id, te.item_id, te.rating,
      round(coalesce(mean, 0) + CASE WHEN coalesce(s_total, 1) <> 0 THEN (coalesce(near, 0) - coalesce(s_mean, 0)) / coalesce(s_total, 1) ELSE 0 END, 8) AS prediction
    FROM te LEFT JOIN me ON me.user_id = te.user_id LEFT JOIN ut ON ut.u = te.user_id LEFT JOIN pr ON pr.user_id = te.user_id AND pr.item_id = te.item_id""",
)
def user_based_cf_similarity(spark, folder):
    train, test, users, items = _split(spark, folder)
    found = cf.user_based_cf(train, test, users, items, weights="similarity")
    return found.withColumn("prediction", F.round("prediction", 8))


@query(
    "item_based_cf_similarity",
    f"""WITH {RATINGS}, {ITEM_CF} SELECT te.user_id, te.item_id, te.rating,
      round(CASE WHEN coalesce(s_total, 1) <> 0 THEN coalesce(near, 0) / coalesce(s_total, 1) ELSE 0 END, 8) AS prediction
    FROM te LEFT JOIN it ON it.i = te.item_id LEFT JOIN pr ON pr.user_id = te.user_id AND pr.item_id = te.item_id""",
)
def item_based_cf_similarity(spark, folder):
    train, test, _, items = _split(spark, folder)
    return cf.item_based_cf(train, test, items, weights="similarity").withColumn("prediction", F.round("prediction", 8))


@query(
    "cf_rmse",
    f"""SELECT 'user' AS method, n, mse, rmse FROM (WITH {RATINGS}, {USER_CF} SELECT count(*) AS n, round(avg(power(rating - prediction, 2)), 8) AS mse,
      round(sqrt(avg(power(rating - prediction, 2))), 8) AS rmse FROM ux) a
    UNION ALL SELECT 'item', n, mse, rmse FROM (WITH {RATINGS}, {ITEM_CF} SELECT count(*) AS n, round(avg(power(rating - prediction, 2)), 8) AS mse,
      round(sqrt(avg(power(rating - prediction, 2))), 8) AS rmse FROM ix) b""",
)
def cf_rmse(spark, folder):
    by_user = cf.cf_rmse(_user_based(spark, folder)).withColumn("method", F.lit("user"))
    by_item = cf.cf_rmse(_item_based(spark, folder)).withColumn("method", F.lit("item"))
    return by_user.unionByName(by_item).select(
        "method", "n", F.round("mse", 8).alias("mse"), F.round("rmse", 8).alias("rmse")
    )


@query(
    "slope_one_dev",
    f"WITH {RATINGS}, {II} SELECT item_a, item_b, round((sx - sy) / n, 9) AS deviation, n AS users FROM ii",
)
def slope_one_dev(spark, folder):
    return cf.slope_one_deviations(_ratings(spark, folder)).withColumn("deviation", F.round("deviation", 9))


@query(
    "slope_one_recs",
    f"""WITH {RATINGS}, {TARGET}, ow AS (SELECT item_id, rating FROM ratings, tg WHERE user_id = target),
      dv AS (SELECT p.item_id, q.item_id AS own_id, avg(p.rating - q.rating) AS dev, count(*) AS freq
        FROM ratings q JOIN ratings p ON p.user_id = q.user_id AND p.item_id <> q.item_id
        WHERE q.item_id IN (SELECT item_id FROM ow) GROUP BY 1, 2),
      sc AS (SELECT dv.item_id, CAST(sum(freq) AS BIGINT) AS freq, round(sum((dev + rating) * freq) / sum(freq), 9) AS score
        FROM dv JOIN ow ON ow.item_id = own_id WHERE dv.item_id NOT IN (SELECT item_id FROM ow) GROUP BY 1)
    SELECT target, item_id, freq, score, row_number() OVER (ORDER BY score DESC, item_id) AS rank FROM sc, tg ORDER BY rank LIMIT 50""",
)
def slope_one_recs(spark, folder):
    ratings = _ratings(spark, folder)
    return cf.slope_one_recs(ratings, cf.most_active(ratings), 50)


@query(
    "content_score",
    f"""WITH {RATINGS}, ge AS (SELECT DISTINCT p_partkey AS item_id, p_name AS title, unnest(string_split(p_name, ' ')) AS genre FROM part),
      pf AS (SELECT genre, avg(rating) AS preference FROM ratings JOIN ge USING (item_id) GROUP BY 1)
    SELECT item_id, title, round(sum(preference), 9) AS score FROM ge JOIN pf USING (genre) GROUP BY 1, 2
    ORDER BY score DESC, item_id LIMIT 20""",
)
def content_score(spark, folder):
    items = tables.item_names(spark, folder).withColumn("genres", F.split("title", " "))
    flags = items.select("item_id", F.explode(F.array_distinct("genres")).alias("genre"))
    preferences = (
        _ratings(spark, folder).join(flags, "item_id").groupBy("genre").agg(F.avg("rating").alias("preference"))
    )
    scores = cf.content_scores(items, preferences).withColumn("score", F.round("score", 9))
    return scores.orderBy(F.desc("score"), "item_id").limit(20)


@query(
    "weighted_history_score",
    f"""WITH {RATINGS}, {COSINE_ITEMS}, wh AS (SELECT item_id, sum(similarity) AS whole FROM nb GROUP BY 1)
    SELECT user_id, nb.item_id, round(sum(rating * similarity) / any_value(whole), 9) AS score
    FROM nb JOIN wh ON wh.item_id = nb.item_id JOIN ratings r ON r.item_id = nb.neighbour GROUP BY 1, 2""",
)
def weighted_history_score(spark, folder):
    ratings = _ratings(spark, folder)
    near = cf.item_neighbours(ratings, 10, places=9)
    return cf.weighted_history(ratings, near).withColumn("score", F.round("score", 9))


@query(
    "user_top_items",
    f"""WITH {RATINGS}, r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, item_id) AS rank FROM ratings)
    SELECT user_id, c_name AS user_label, item_id, p_name AS title, rating, rank
    FROM r JOIN customer ON c_custkey = user_id JOIN part ON p_partkey = item_id WHERE rank <= 3""",
)
def user_top_items(spark, folder):
    names = tables.item_names(spark, folder)
    users = tables.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_label")
    )
    return cf.user_top_items(_ratings(spark, folder), names, users, 3)
