"""Graph clustering and the comparison of labelings. Edges are (src, dst, w) with src != dst, each
undirected edge once."""

from __future__ import annotations

from pyspark.ml.clustering import PowerIterationClustering
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.operators.skew import one_row, salted_join
from tallymart.session import write_through


def adjacency(edges: DataFrame) -> DataFrame:
    """Non-zero cells (src, dst) of the symmetric 0/1 matrix with ones on the diagonal."""
    cells = F.array(
        F.struct(F.col("src").alias("src"), F.col("dst").alias("dst")),
        F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")),
        F.struct(F.col("src").alias("src"), F.col("src").alias("dst")),
        F.struct(F.col("dst").alias("src"), F.col("dst").alias("dst")),
    )
    return edges.select(F.explode(cells).alias("c")).select("c.*").distinct()


def _nearest(cells: DataFrame, centres: DataFrame, degree: DataFrame, k: int) -> DataFrame:
    """(node, cluster, gap): the centre nearest to every matrix row and the squared distance to it.

    ``centres`` has one row for each matrix column that some centre fills: (dst, weights), an array over the centres.
    |x - c|^2 = |x|^2 - 2 x.c + |c|^2, and x.c is a sum over the row's edges, so nothing dense is built. Ties go to the
    smaller cluster.
    """
    length = one_row(centres.agg(*(F.sum(F.col("weights")[i] * F.col("weights")[i]).alias(f"c{i}") for i in range(k))))
    # the matrix is symmetric: a node stands in as many rows as it has neighbours
    sized = centres.join(degree.select(F.col("node").alias("dst"), F.col("ones").alias("_rows")), "dst")
    met = salted_join(cells, sized, ["dst"], count="_rows")
    dots = met.groupBy(F.col("src").alias("node")).agg(*(F.sum(F.col("weights")[i]).alias(f"x{i}") for i in range(k)))
    placed = degree.join(dots, "node", "left").withColumn("_length", length)
    gaps = [
        F.struct(
            F.greatest(F.col("ones") - 2 * F.coalesce(f"x{i}", F.lit(0.0)) + F.col("_length")[f"c{i}"], F.lit(0.0)).alias("gap"),
            F.lit(i).alias("cluster"),
        )
        for i in range(k)
    ]
    best = F.least(*gaps) if k > 1 else gaps[0]
    return placed.select("node", "ones", best.alias("b")).select("node", "ones", "b.cluster", "b.gap")


def _weights(cells: DataFrame, assigned: DataFrame, k: int) -> DataFrame:
    """Centres as the mean matrix row of each cluster: sums over the edges, divided by the sizes."""
    sizes = one_row(assigned.agg(*(F.greatest(F.count_if(F.col("cluster") == i), F.lit(1)).alias(f"n{i}") for i in range(k))))
    rows = assigned.select(F.col("node").alias("src"), "cluster", "ones")
    sums = salted_join(cells, rows, ["src"], count="ones").groupBy("dst").agg(
        F.array(*(F.count_if(F.col("cluster") == i) for i in range(k))).alias("sums")
    )
    weights = F.array(*(F.col("sums")[i] / F.col("_n")[f"n{i}"] for i in range(k)))
    return sums.withColumn("_n", sizes).select("dst", weights.alias("weights"))


def kmeans_clusters(edges: DataFrame, k: int = 2, rounds: int = 40) -> DataFrame:
    """(node, cluster): k-means over the rows of ``adjacency``, which stay an edge list.

    The first centre is the node with most neighbours, each further one the node farthest from those before (ties: the
    smaller node), so the result does not change between runs. A round costs two joins over the edges and stops when no
    node moves, or after ``rounds``. With fewer distinct rows than ``k`` some clusters stay empty. The driver holds
    the k nodes of the start; what grows with the graph is written to the shared folder.
    """
    cells = write_through(adjacency(edges), "cells")
    degree = write_through(cells.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("ones")), "degree")
    first = degree.agg(F.max_by("node", F.struct("ones", -F.col("node")))).first()[0]
    if first is None:
        return degree.select("node", F.lit(0).alias("cluster"))
    seeds = [first]
    while True:
        taken = cells.filter(F.col("src").isin(seeds))  # the rows of at most k nodes
        flags = F.array(*(F.max((F.col("src") == s).cast("double")) for s in seeds))
        start = _nearest(cells, taken.groupBy("dst").agg(flags.alias("weights")), degree, len(seeds))
        if len(seeds) == k:
            break
        far = start.filter("gap > 0").agg(F.max_by("node", F.struct("gap", -F.col("node")))).first()[0]
        if far is None:  # every row equals a centre
            break
        seeds.append(far)
    k = len(seeds)
    assigned = write_through(start, "assigned")
    for _ in range(rounds):
        moved = write_through(_nearest(cells, _weights(cells, assigned, k), degree, k), "assigned")
        old = assigned.select("node", F.col("cluster").alias("before"))
        still = moved.join(old, "node").filter("cluster <> before").isEmpty()
        assigned = moved
        if still:
            break
    return assigned.select("node", "cluster")


def spectral_clusters(edges: DataFrame, k: int = 2, iterations: int = 20) -> DataFrame:
    """Power iteration clustering of the weighted edge list.

    The start vector is random (seeded by partition): degrees cannot tell apart clusters of equal shape.
    """
    model = PowerIterationClustering(k=k, maxIter=iterations, weightCol="w", initMode="random")
    clusters = model.assignClusters(
        edges.select(F.col("src").cast("long"), F.col("dst").cast("long"), F.col("w").cast("double"))
    )
    return clusters.select(F.col("id").alias("node"), "cluster")


# ---- agreement of two labelings --------------------------------------------------------------


def _plogp(count: Column, total: Column) -> Column:
    return F.sum(-count / total * F.log(count / total))


def _choose2(count: Column) -> Column:
    c = count.cast("double")
    return F.sum(c * (c - 1) / 2)


def agreement(df: DataFrame, a: str, b: str, mean: str = "geometric") -> DataFrame:
    """Normalised mutual information, adjusted Rand index and their mean.

    Everything follows from the sizes of the clusters of ``a``, of ``b`` and of their overlaps: three
    small group-bys, no join. Degenerate labelings score 1 when both are the same partition, else 0.
    """
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    total = cells.agg(F.sum("n")).scalar()

    def part(sizes: DataFrame, name: str) -> DataFrame:
        return sizes.agg(
            F.struct(
                _plogp(F.col("n"), total).alias("h"), _choose2(F.col("n")).alias("c"), F.count(F.lit(1)).alias("k")
            ).alias(name)
        )

    sums = {
        "x": part(cells, "x").scalar(),
        "r": part(cells.groupBy("a").agg(F.sum("n").alias("n")), "r").scalar(),
        "s": part(cells.groupBy("b").agg(F.sum("n").alias("n")), "s").scalar(),
    }
    row = cells.agg(F.sum("n").alias("n")).select("n", *(column.alias(name) for name, column in sums.items()))
    ha, hb, hab = F.col("r.h"), F.col("s.h"), F.col("x.h")
    same = (F.col("x.k") == F.col("r.k")) & (F.col("x.k") == F.col("s.k"))
    degenerate = F.when(same, F.lit(1.0)).otherwise(F.lit(0.0))
    shared = F.greatest(ha + hb - hab, F.lit(0.0))
    scale = F.sqrt(ha * hb) if mean == "geometric" else (ha + hb) / 2
    nmi = F.when((ha > 0) & (hb > 0), shared / scale).otherwise(degenerate)
    n = F.col("n").cast("double")
    expected = F.col("r.c") * F.col("s.c") / (n * (n - 1) / 2)
    most = (F.col("r.c") + F.col("s.c")) / 2
    ari = F.when(most != expected, (F.col("x.c") - expected) / (most - expected)).otherwise(degenerate)
    return row.select("n", nmi.alias("nmi"), ari.alias("ari")).withColumn("score", (F.col("nmi") + F.col("ari")) / 2)
