"""Graph clustering over the nation links and agreement of labelings over the embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.operators import graph
from tallymart.plans.registry import query
from tallymart.sources import tables

LINKS = """lk AS (SELECT least(c_nationkey, s_nationkey) AS src, greatest(c_nationkey, s_nationkey) AS dst, count(*) AS w
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN supplier ON l_suppkey = s_suppkey WHERE c_nationkey <> s_nationkey GROUP BY 1, 2),
  ed AS (SELECT * FROM lk WHERE w > (SELECT avg(w) FROM lk))"""
LABELS = "cl AS (SELECT vec_id, label AS a, CAST(vec_id % 10 AS INTEGER) AS b FROM embeddings)"
SCORES = f"""{LABELS}, ce AS (SELECT a, b, count(*) AS n FROM cl GROUP BY 1, 2),
  ra AS (SELECT a, sum(n) AS n FROM ce GROUP BY 1), rb AS (SELECT b, sum(n) AS n FROM ce GROUP BY 1),
  tt AS (SELECT sum(n) AS n FROM ce),
  mi AS (SELECT sum(ce.n / tt.n * ln(tt.n * ce.n / (ra.n * rb.n))) AS mi FROM ce JOIN ra ON ra.a = ce.a JOIN rb ON rb.b = ce.b, tt),
  ha AS (SELECT -sum(ra.n / tt.n * ln(ra.n / tt.n)) AS h, sum(ra.n * (ra.n - 1) / 2) AS c FROM ra, tt),
  hb AS (SELECT -sum(rb.n / tt.n * ln(rb.n / tt.n)) AS h, sum(rb.n * (rb.n - 1) / 2) AS c FROM rb, tt),
  cc AS (SELECT sum(ce.n * (ce.n - 1) / 2) AS c FROM ce),
  ex AS (SELECT ha.c * hb.c / (tt.n * (tt.n - 1) / 2) AS e, (ha.c + hb.c) / 2 AS m FROM ha, hb, tt),
  fi AS (SELECT CAST(tt.n AS BIGINT) AS n, mi / sqrt(ha.h * hb.h) AS nmi, (cc.c - e) / (m - e) AS ari FROM tt, mi, ha, hb, cc, ex)"""


def _links(spark, folder) -> DataFrame:
    """Nation links stronger than the mean link."""
    links = tables.nation_links(spark, folder)
    return links.filter(F.col("w") > links.agg(F.avg("w")).scalar())


@query(
    "adjacency",
    f"""WITH {LINKS} SELECT src, dst FROM ed UNION SELECT dst, src FROM ed
    UNION SELECT src, src FROM ed UNION SELECT dst, dst FROM ed""",
)
def adjacency(spark, folder):
    return graph.adjacency(_links(spark, folder))


@query("kmeans")
def kmeans(spark, folder):
    return graph.kmeans_clusters(_links(spark, folder))


@query("spectral_pic")
def spectral_pic(spark, folder):
    return graph.spectral_clusters(_links(spark, folder))


def _agreement(spark, folder, *columns: str) -> DataFrame:
    scores = graph.agreement(tables.clusters(spark, folder), "a", "b")
    return scores.select("n", *(F.round(c, 9).alias(c) for c in columns))


@query("nmi", f"WITH {SCORES} SELECT n, round(nmi, 9) AS nmi FROM fi")
def nmi(spark, folder):
    return _agreement(spark, folder, "nmi")


@query("ari", f"WITH {SCORES} SELECT n, round(ari, 9) AS ari FROM fi")
def ari(spark, folder):
    return _agreement(spark, folder, "ari")


@query("cluster_score", f"WITH {SCORES} SELECT n, round(nmi, 9) AS nmi, round(ari, 9) AS ari, round((nmi + ari) / 2, 9) AS score FROM fi")
def cluster_score(spark, folder):
    return _agreement(spark, folder, "nmi", "ari", "score")


@query("cluster_score_methods")
def cluster_score_methods(spark, folder):
    """Both graph clusterings scored against the region of each nation."""
    nation = tables.table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("long").alias("node"), F.col("n_regionkey").alias("truth")
    )
    links = _links(spark, folder)
    scored = None
    for name, clusters in (("kmeans", graph.kmeans_clusters(links)), ("spectral", graph.spectral_clusters(links))):
        joined = clusters.withColumn("node", F.col("node").cast("long")).join(nation, "node")
        row = graph.agreement(joined, "truth", "cluster").withColumn("method", F.lit(name))
        scored = row if scored is None else scored.unionByName(row)
    return scored
