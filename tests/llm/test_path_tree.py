"""The template tree branches and merges at every level, and takes labels and whole paths into account."""

from pyspark.sql import functions as F

from tallymart.llm.path_templates import judge, templates


def _templates(spark, paths):
    rows = [("h", p, label) for p, label in paths]
    found = templates(spark.createDataFrame(rows, "host string, path string, label boolean"), blocked=F.col("label"))
    return {r.path: r.template for r in found.collect()}


def test_rare_children_merge_below_the_first_level(spark):
    slugs = [f"/blog/{a}{b}/comments" for a in "abcde" for b in "vwxyz"]
    got = _templates(spark, [(p, None) for p in slugs + ["/blog/ab", "/shop/all/items"] * 10])
    assert len({got[p] for p in slugs}) == 1 and got[slugs[0]] == "/blog/{*/w}/comments"
    assert got["/blog/ab"] == "/blog/ab" and got["/shop/all/items"] == "/shop/all/items"


def test_rare_children_of_other_depth_stay_apart(spark):
    got = _templates(spark, [("/x/aa", None), ("/x/bb", None), ("/x/cc/dd", None), ("/x/ee/ff", None)])
    assert got["/x/aa"] == got["/x/bb"] != got["/x/cc/dd"] == got["/x/ee/ff"]


def test_labels_keep_a_rare_branch(spark):
    plain = [(f"/x/{a}{b}", False) for a in "abcdefghij" for b in "klmnopqrst" for _ in range(2)]
    got = _templates(spark, plain + [("/x/bad", True)] * 5)
    assert got["/x/bad"] == "/x/bad" and len({got[p] for p, _ in plain}) == 1


def test_all_segments_of_a_long_path_count(spark):
    deep = ["/".join([""] + ["a"] * 70 + [end] + ["z"] * 10) for end in ("b", "c")]
    got = _templates(spark, [(p, None) for p in deep for _ in range(5)])
    assert got[deep[0]] != got[deep[1]]


def test_no_rows_and_empty_paths(spark):
    assert judge(spark.createDataFrame([], "page_id long, url string")).count() == 0
    rows = judge(spark.createDataFrame([(1, None), (2, "http://a.org"), (3, "http://a.org/")], "page_id long, url string")).collect()
    assert {(r.id, r.host, r.path, r.template) for r in rows} == {(1, "", "", ""), (2, "a.org", "", ""), (3, "a.org", "/", "")}
