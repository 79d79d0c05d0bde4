"""URL filter by rules and by a path-template tree, in DataFrame expressions only.

Of the path of a url every segment becomes a token. A segment that is a number, an id or a slug with digits is variable
and becomes a wildcard that keeps its shape. The tree of a host is generalised from the root down, level by level: the
children of a node that are seen rarely are merged into one wildcard branch when they look alike, i.e. the same number
and kinds of segments follow, and when their labels do not set them apart from their rare siblings; the levels below
are counted over what has been merged. The templates of a host are the paths of that tree. A template is judged by its labelled urls: the share of blocked
ones, smoothed towards that of its host, which is smoothed towards that of its domain and of all urls.

Labelled urls are those that a rule decides, so the tree carries the rules' verdicts on to like urls of the
same host.

Defined results: null and urls without ``://`` have an empty host and path, and are judged like any other
host; equal rows are judged alike; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.session import write_through

#: Levels of the tree; where a path has more segments, all from the last level on count as one.
LEVELS = 16

# fixed values: (host suffix, path prefix, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII letters in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest rule (host and path together) that fits, as a struct; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for suffix, prefix, verdict in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == suffix) | host.endswith("." + suffix)) & path.startswith(prefix)
        named = F.struct(F.lit(suffix + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, named).otherwise(found)
    return found


def segments_of(path: Column) -> Column:
    """Segments with variable ones as wildcards that keep their shape."""

    def generalised(segment: Column) -> Column:
        return (
            F.when(segment.rlike(r"^[0-9]+$"), F.lit("{n}"))
            .when(segment.rlike(r"^[0-9]+\.[a-z]{2,5}$"), F.concat(F.lit("{n}."), F.regexp_extract(segment, r"([a-z]+)$", 1)))
            .when(segment.rlike(r"^[0-9a-fA-F-]{16,}$"), F.lit("{id}"))
            .when(segment.rlike(r"[0-9]"), F.lit("{s}"))
            .otherwise(segment)
        )

    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), generalised)


def templates(urls: DataFrame, rare_share: float = 0.05, rare_rows: int = 3, blocked: Column | None = None) -> DataFrame:
    """Add ``template`` to rows with ``host`` and ``path``. ``blocked``: the label of a row (true, false or null).

    A child is rare with under ``rare_share`` of its node's urls, or fewer than ``rare_rows`` urls. Rare children keep a branch of
    their own only if their share of blocked labels is over two standard deviations from that of the node's rare children. The
    tree is built over the different paths of a host, one round for each level in use.
    """
    segments = segments_of(F.col("path"))
    deep = F.concat(F.slice(segments, 1, LEVELS - 1), F.array(F.array_join(F.slice(segments, LEVELS, F.greatest(F.size(segments), F.lit(1))), "/")))
    rows = urls.withColumn("_segments", F.when(F.size(segments) > LEVELS, deep).otherwise(segments))
    label = F.lit(None).cast("boolean") if blocked is None else blocked
    paths = rows.groupBy("host", "_segments").agg(
        F.count(F.lit(1)).alias("_n"), F.count(F.when(label, 1)).alias("_b"), F.count(label).alias("_k")
    )
    paths = write_through(paths.withColumn("_node", F.lit("")), "paths")
    sums = [F.sum(c).alias(c) for c in ("_n", "_b", "_k")]
    for level in range(1, (paths.agg(F.max(F.size("_segments"))).first()[0] or 0) + 1):
        # only paths that go on have a child here
        onward = paths.filter(F.size("_segments") >= level).withColumn("_child", F.col("_segments")[level - 1])
        nodes = paths.groupBy("host", "_node").agg(F.sum("_n").alias("_all"))
        counted = onward.groupBy("host", "_node", "_child").agg(*sums).join(nodes, ["host", "_node"])
        rare = counted.filter((F.col("_n") < F.col("_all") * rare_share) | (F.col("_n") < rare_rows))
        pooled = rare.groupBy("host", "_node").agg((F.sum("_b") / F.greatest(F.sum("_k"), F.lit(1))).alias("_p"))
        away = F.abs(F.col("_b") - F.col("_k") * F.col("_p")) > 2 * F.sqrt(F.col("_k") * F.col("_p") * (1 - F.col("_p")))
        apart = (F.col("_k") >= rare_rows) & away
        merged = rare.join(pooled, ["host", "_node"]).filter(~apart).select("host", "_node", "_child", F.lit(True).alias("_merged"))
        kinds = F.transform(F.slice("_segments", level + 1, LEVELS), lambda s: F.when(s.startswith("{"), s).otherwise(F.lit("w")))
        placed = paths.withColumn("_child", F.get("_segments", F.lit(level - 1))).join(merged, ["host", "_node", "_child"], "left")
        name = F.when(F.col("_merged"), F.concat(F.lit("{*"), F.array_join(F.concat(F.array(F.lit("")), kinds), "/"), F.lit("}")))
        name = F.concat("_node", F.lit("/"), F.coalesce(name, "_child"))
        paths = write_through(placed.withColumn("_node", F.coalesce(name, "_node")).drop("_child", "_merged"), "paths")
    return rows.join(paths.select("host", "_segments", F.col("_node").alias("template")), ["host", "_segments"]).drop("_segments")


def judge(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple = RULES,
    weight: float = 4.0,
    threshold: float = 0.5,
) -> DataFrame:
    """One row per url: ``id``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``impurity``.

    ``weight``: how many labelled urls the level above counts for. Blocked is a url with a smoothed share of
    blocked labels above ``threshold``.
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    found = rows.withColumn("_found", rule_of(F.col("host"), F.col("path"), rules))
    rows = templates(found, blocked=F.col("_found.verdict") == "block")
    rows = rows.withColumn("_domain", F.substring_index("host", ".", -2))
    blocked = F.count(F.when(F.col("_found.verdict") == "block", 1)).alias("_blocked")
    known = F.count("_found").alias("_known")
    by_template = rows.groupBy("_domain", "host", "template").agg(blocked, known)
    totals = [F.sum("_blocked").alias("b"), F.sum("_known").alias("k")]
    everything = by_template.agg(F.struct(*totals).alias("t")).select(
        F.coalesce(F.try_divide("t.b", "t.k"), F.lit(0.0)).alias("share")
    )
    top = everything.scalar()
    domains = by_template.groupBy("_domain").agg(*totals).select(
        "_domain", ((F.col("b") + weight * top) / (F.col("k") + weight)).alias("_d")
    )
    hosts = (
        by_template.groupBy("_domain", "host")
        .agg(*totals)
        .join(domains, "_domain")
        .select("host", ((F.col("b") + weight * F.col("_d")) / (F.col("k") + weight)).alias("_h"))
    )
    judged = by_template.join(hosts, "host").select(
        "host", "template", ((F.col("_blocked") + weight * F.col("_h")) / (F.col("_known") + weight)).alias("impurity")
    )
    out = rows.join(judged, ["host", "template"])
    verdict = F.when(F.col("impurity") > threshold, "block").otherwise("allow")
    return out.select(
        "id",
        "host",
        "path",
        F.col("_found.rule").alias("rule"),
        F.coalesce("_found.verdict", verdict).alias("verdict"),
        "template",
        "impurity",
    )
