"""Rules of the retail reports on hand-worked rows."""

from pyspark.sql import functions as F

from tallymart.operators import retail


def log(spark, rows):
    return spark.createDataFrame(rows, "cust_id int, product_id int, ts string").withColumn("ts", F.to_timestamp("ts"))


def test_equal_activity_keeps_nobody(spark):
    rows = log(spark, [(c, 1, "2024-01-01") for c in range(5)])
    assert retail.heavy_keys(rows, "cust_id").count() == 0


def test_heavy_keys_are_strictly_above_the_threshold(spark):
    # counts 1..10, one customer each: the share passes 90 % at count 1
    rows = log(spark, [(c, 1, "2024-01-01") for c in range(1, 11) for _ in range(c)])
    assert sorted(r.cust_id for r in retail.heavy_keys(rows, "cust_id").collect()) == list(range(2, 11))


def test_interval_rules(spark):
    rows = log(spark, [(1, 1, "2024-01-01 00:00:00"), (1, 1, "2024-01-04 12:00:00"), (1, 1, "2024-01-06 18:00:00")])
    # span 5.75 days: (5 - 1) / 2 = 2; exact: 4.75 / 2 = 2.375 -> 2
    assert retail.pair_intervals(rows).first().repurchase_days == 2
    assert retail.pair_intervals(rows, False).first().repurchase_days == 2
    same_day = log(spark, [(1, 1, "2024-01-01 00:00:00"), (1, 1, "2024-01-01 05:00:00")])
    assert retail.pair_intervals(same_day).first().repurchase_days == -1
    assert retail.pair_intervals(same_day, False).first().repurchase_days == -1


def test_due_judges_each_purchase_and_latest_the_pair(spark):
    rows = log(spark, [(1, 1, "2024-01-01"), (1, 1, "2024-01-12"), (1, 2, "2024-01-12")])
    # interval (11 - 1) / 1 = 10
    labels = {(str(r.purchase_date), r.recommendation) for r in retail.repurchase_due(rows, "2024-01-20").collect()}
    assert labels == {("2024-01-01", "Recommend"), ("2024-01-12", "Do_not_recommend")}
    latest = retail.repurchase_due(rows, "2024-01-20", latest_only=True).collect()
    assert [r.recommendation for r in latest] == ["Do_not_recommend"]


def test_average_weighs_rows_or_pairs(spark):
    rows = log(spark, [(1, 1, "2024-01-01"), (1, 1, "2024-01-12"), (2, 1, "2024-01-01"), (2, 1, "2024-01-03"), (2, 1, "2024-01-06")])
    # intervals: 10 (2 rows) and (5 - 1) / 2 = 2 (3 rows)
    assert retail.average_repurchase_time(rows).first().average_repurchase_time == (10 * 2 + 2 * 3) / 2
    assert retail.average_repurchase_time(rows, weighting="pair").first().average_repurchase_time == 6


def test_single_visit_customers_have_no_affinity(spark):
    rows = log(spark, [(1, 1, "2024-01-01"), (2, 1, "2024-01-01"), (2, 2, "2024-01-01")])
    assert {(r.cust_id, r.affinity_round) for r in retail.affinity(rows).collect()} == {(2, 50.0)}


def test_empty_band_sends_the_next_class_to_the_last(spark):
    # cumulative shares: 100 -> 30 %, 50 -> 60 %, so bands A, B, C are empty
    table = spark.createDataFrame([(c, 1, 100.0) for c in range(3)] + [(c, 1, 50.0) for c in range(3, 10)], "cust_id int, product_id int, affinity_round double")
    cuts = retail.affinity_cutpoints(retail.affinity_distribution(table)).first()
    assert (cuts.cut_a, cuts.cut_b, cuts.cut_c, cuts.cut_d, cuts.cut_e) == (None, None, None, 100.0, 50.0)
    assert {r.recommendation_class for r in retail.affinity_class(table).collect()} == {"Class_E"}


def test_hot_pairs_do_not_change_the_report(spark):
    rows = log(spark, [(c % 4, c % 3, f"2024-01-{c % 28 + 1:02d}") for c in range(200)])
    plain = sorted(map(tuple, retail.favourites(rows, "2024-02-01").collect()))
    split = sorted(map(tuple, retail.favourites(rows, "2024-02-01", hot_rows=5).collect()))
    assert plain == split and len(plain) == 200
