"""Sums over pairs of members that share a group: items rated by one user, users of one item.

Two shapes:

``pair_sums``     every unordered pair. The pairs are the wanted result, so the work cannot be less
                  than the result; what must not happen is that one task builds all pairs of a large
                  group, or that every pair travels as a row. A group is kept as lists of at most
                  ``block_rows`` members. Every member gets the lists of its groups, packed, in the task that
                  owns it (a member with very many partners: in several, by partner), and pairs exist only
                  there: they are built, added up and not shuffled.
``group_pairs``   the pairs themselves with their group, both members' values beside them; ``both`` gives each pair
                  from either side, so that all partners of a member meet in its own tasks.
``target_sums``   pairs of given members (one user's neighbours) with everybody else: linear in the
                  rows, no all-pairs step.
``target_rows``   every row beside every target, for results that name all of them: the targets travel
                  in blocks and meet the rows by block number.
``met_lists``     rows that own something in a group beside the lists of that group; ``cell_products`` builds on it:
                  for stated (row, column) cells, entries of a product of three sparse matrices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from tallymart.operators.skew import HOT_ROWS, attach_totals, salted_join
from tallymart.session import write_through

BLOCK_ROWS = 4096
#: Pairs that a task holds at a time, about.
PAIRS_AT_ONCE = 500_000
TARGET_BLOCK = 1024


def power_sums(x: Column, y: Column) -> list[Column]:
    """Count, sums, sum of absolute differences and the central moments of a pair of columns. The moments are kept about the
    running mean and merged, so values far from zero lose nothing; Spark leaves out what a query does not read."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(x).alias("sx"),
        F.sum(y).alias("sy"),
        F.sum(x * x).alias("sxx"),
        F.sum(y * y).alias("syy"),
        F.sum(x * y).alias("sxy"),
        F.sum(F.abs(x - y)).alias("sad"),
        F.var_pop(x).alias("vx"),
        F.var_pop(y).alias("vy"),
        F.covar_pop(x, y).alias("vxy"),
    ]


def group_lists(
    rows: DataFrame,
    group: str,
    member: str,
    values: list[str],
    block_rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
    nulls: bool = False,
) -> DataFrame:
    """The members of every group in lists of about ``block_rows``, ordered by member: ``_g``, ``_block`` of ``_blocks``,
    ``_size`` (rows of the group), ``_ms`` and a list for each of ``values``. Written once; rows without group or member
    meet nothing and are left out (with ``nulls`` the null member is one like any other). Long ids become int where all of them fit; users cast them back."""
    kept = rows.select(F.col(group).alias("_g"), F.col(member).alias("_m"), *values)
    kept = write_through(kept.filter("_g IS NOT NULL" if nulls else "_g IS NOT NULL AND _m IS NOT NULL"), "members")
    if dict(kept.dtypes)["_m"] == "bigint":
        # ids travel many times: those that fit into four bytes take no more
        low, high = kept.agg(F.min("_m"), F.max("_m")).first()
        if low is not None and -(2**31) <= low and high < 2**31:
            kept = kept.withColumn("_m", F.col("_m").cast("int"))
    sized = attach_totals(kept, ["_g"], hot_rows, _size=F.count(F.lit(1))).withColumn(
        "_blocks", F.ceil(F.col("_size") / block_rows).cast("int")
    )
    block = F.pmod(F.xxhash64("_m"), F.col("_blocks")).cast("int").alias("_block")
    listed = sized.groupBy("_g", block, "_blocks", "_size").agg(
        F.array_sort(F.collect_list(F.struct("_m", *values))).alias("_rows")
    )
    return write_through(
        listed.select("_g", "_block", "_blocks", "_size", F.col("_rows._m").alias("_ms"), *(F.col(f"_rows.{v}").alias(v) for v in values)),
        "lists",
    )


def met_lists(own: DataFrame, lists: DataFrame) -> DataFrame:
    """Every list of ``own`` (columns ``_g``, ``_block``, ``_ms`` and others) beside every list of its group in ``lists``. Two
    large groups meet block by block, each pair of blocks in a place of its own."""
    mine, others = (x.groupBy("_g").agg(F.max("_blocks").alias(n)) for x, n in ((own, "_no"), (lists, "_nl")))
    counts = mine.join(others, "_g")

    def places(side: DataFrame, here: str, there: str, other: str) -> DataFrame:
        named = side.withColumnRenamed("_block", here).join(counts.select("_g", other), "_g")
        return named.withColumn(there, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).drop(other, "_blocks", "_size")

    return places(own, "_p", "_q", "_nl").join(places(lists, "_q", "_p", "_no"), ["_g", "_p", "_q"]).drop("_p", "_q")


def _parts_of(loads: DataFrame, at_once: int) -> tuple[DataFrame, int]:
    """Members with more than ``at_once`` partners (``_a``, ``_load``, several rows a member) and the number of tasks for
    each; the number of tasks in all. The list has at most (all pairs / ``at_once``) members."""
    sums = write_through(loads.groupBy("_a").agg(F.sum("_load").cast("long").alias("_load")), "loads")
    whole = sums.agg(F.sum("_load")).first()[0] or 0
    hot = sums.filter(F.col("_load") > at_once).select("_a", F.ceil(F.col("_load") / at_once).cast("int").alias("_parts"))
    return hot, max(loads.sparkSession.sparkContext.defaultParallelism, -(-whole // at_once))


def _placed(rows: DataFrame, hot: DataFrame, tasks: int, lists: list[str]) -> DataFrame:
    """Rows (``_a``, ``_bs`` and further lists beside it) in the task that owns ``_a``. The partners of a hot member are dealt
    to its tasks (``_share``) by a hash."""
    parts = F.coalesce("_parts", F.lit(1))
    shared = rows.join(F.broadcast(hot), "_a", "left").withColumn("_share", F.explode(F.sequence(F.lit(0), parts - 1)))
    zipped = F.arrays_zip("_bs", *lists)
    dealt = F.when(parts > 1, F.filter(zipped, lambda z: F.pmod(F.xxhash64(z["_bs"]), parts) == F.col("_share")))
    named = {c: F.when(parts > 1, F.col("_dealt")[c]).otherwise(F.col(c)) for c in ("_bs", *lists)}
    shared = shared.withColumn("_dealt", dealt).withColumns(named).drop("_dealt", "_parts")
    return shared.filter(F.size("_bs") > 0).repartition(tasks, "_a", "_share")


def _partners(placed: DataFrame, lists: list[str], kind: DataType) -> DataFrame:
    """One row for each partner ``_b`` (of type ``kind``), with its value of every list."""
    kept = [c for c in placed.columns if c not in ("_bs", *lists)]
    rows = placed.select("*", F.posexplode("_bs").alias("_at", "_b"))
    return rows.select(*kept, F.col("_b").cast(kind).alias("_b"), *(F.col(c)[F.col("_at")].alias(c) for c in lists))


def group_pairs(
    ratings: DataFrame,
    group: str,
    member: str,
    values: list[str],
    block_rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
    both: bool = False,
    at_once: int = PAIRS_AT_ONCE,
) -> DataFrame:
    """(group, a, part, b, x_<value>, y_<value>) for members a < b of one group, with ``both`` for a <> b.

    The rows are partitioned by (a, part) and all rows of one (a, b) have the same part: sums by (a, part, b) need no
    further shuffle.
    """
    lists = group_lists(ratings, group, member, values, block_rows, hot_rows)
    kind = ratings.schema[member].dataType
    share = F.lit(1.0) if both else F.lit(0.5)
    hot, tasks = _parts_of(lists.select(F.explode("_ms").alias("_a"), (F.col("_size") * share).alias("_load")).withColumn("_a", F.col("_a").cast(kind)), at_once)
    mine = {v: f"x_{v}" for v in values}
    theirs = {v: f"y_{v}" for v in values}
    at = F.col("_at")

    def met(pairs: DataFrame, first: Column) -> DataFrame:
        """The members of ``_ms`` one by one, beside the other list from position ``first`` on."""
        rows = pairs.select("*", F.posexplode("_ms").alias("_at", "_a"))
        rest = [F.slice(c, first, F.size("_bs")).alias(c) for c in ("_bs", *theirs.values())]
        return rows.select("_g", F.col("_a").cast(kind).alias("_a"), *(F.col(v)[at].alias(mine[v]) for v in values), *rest)

    within = lists.select("_g", "_ms", *values, F.col("_ms").alias("_bs"), *(F.col(v).alias(theirs[v]) for v in values))
    large = lists.filter("_blocks > 1").withColumn("_to", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))).filter("_to <> _block")
    other = lists.filter("_blocks > 1").select(
        "_g", F.col("_block").alias("_to"), F.col("_ms").alias("_bs"), *(F.col(v).alias(theirs[v]) for v in values)
    )
    across = large.select("_g", "_to", "_ms", *values).join(other, ["_g", "_to"]).drop("_to")
    rows = met(within, F.lit(1) if both else at + 2).unionByName(met(across, F.lit(1)))
    pairs = _partners(_placed(rows, hot, tasks, list(theirs.values())), list(theirs.values()), kind)
    pairs = pairs.filter(F.col("_a") != F.col("_b") if both else F.col("_a") < F.col("_b"))
    return pairs.withColumnsRenamed({"_g": "group", "_a": "a", "_share": "part", "_b": "b"})


def member_pairs(
    ratings: DataFrame,
    group: str,
    member: str,
    value: str = "rating",
    block_rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """(group, a, b, x, y) for members a < b of the same group; (group, member) must be unique."""
    pairs = group_pairs(ratings, group, member, [value], block_rows, hot_rows)
    return pairs.select("group", "a", "b", F.col(f"x_{value}").alias("x"), F.col(f"y_{value}").alias("y"))


def pair_sums(
    ratings: DataFrame,
    group: str,
    member: str,
    value: str = "rating",
    block_rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
    both: bool = False,
    at_once: int = PAIRS_AT_ONCE,
) -> DataFrame:
    """Sums and central moments (``power_sums``) per pair a < b (``both``: a <> b) over their shared groups."""
    pairs = group_pairs(ratings, group, member, [value], block_rows, hot_rows, both, at_once)
    sums = pairs.groupBy("a", "part", "b").agg(*power_sums(F.col(f"x_{value}"), F.col(f"y_{value}")))
    return sums.drop("part")


def mirror(pairs: DataFrame, swap: list[tuple[str, str]] = (), negate: list[str] = ()) -> DataFrame:
    """Both directions of symmetric pair results; ``swap`` exchanges columns, ``negate`` flips signs."""
    exchange = {"a": "b", "b": "a"}
    for first, second in swap:
        exchange[first], exchange[second] = second, first
    forward = [F.col(c) for c in pairs.columns]
    backward = [-F.col(c) if c in negate else F.col(exchange.get(c, c)) for c in pairs.columns]
    return pairs.select(F.stack(F.lit(2), *forward, *backward).alias(*pairs.columns))


def target_pairs(
    ratings: DataFrame, targets: DataFrame, group: str, member: str, value: str = "rating"
) -> DataFrame:
    """(target, other, group, x, y): shared groups of each target member with every other member."""
    wanted = (
        ratings.join(targets.select(F.col(targets.columns[0]).alias(member)).distinct(), member, "left_semi")
        .select(group, F.col(member).alias("target"), F.col(value).alias("x"))
    )
    everyone = ratings.select(group, F.col(member).alias("other"), F.col(value).alias("y"))
    return wanted.join(everyone, group).filter(F.col("target") != F.col("other"))


def target_sums(
    ratings: DataFrame, targets: DataFrame, group: str, member: str, value: str = "rating"
) -> DataFrame:
    return (
        target_pairs(ratings, targets, group, member, value)
        .groupBy("target", "other")
        .agg(*power_sums(F.col("x"), F.col("y")))
    )


def target_shares(
    rows: DataFrame, targets: DataFrame, group: str, member: str, value: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """(target, other, x, y) like ``target_pairs``; a group with very many rows is spread over tasks. The targets of a
    group travel as one list, which the target list bounds."""
    wanted = targets.select(F.col(targets.columns[0]).alias(member)).distinct()
    lists = (
        rows.join(wanted, member, "left_semi")
        .groupBy(group)
        .agg(F.collect_list(F.struct(F.col(member).alias("target"), F.col(value).alias("x"))).alias("_targets"))
    )
    met = salted_join(rows.select(group, F.col(member).alias("other"), F.col(value).alias("y")), lists, [group], hot_rows=hot_rows)
    pairs = met.select("other", "y", F.explode("_targets").alias("_t"))
    return pairs.select("_t.target", "other", "_t.x", "y").filter(F.col("target") != F.col("other"))


def target_rows(rows: DataFrame, targets: DataFrame, block_targets: int = TARGET_BLOCK) -> DataFrame:
    """Every row of ``rows`` with every row of ``targets`` (as struct ``_t``): the stated targets against all rows."""
    blocks = F.greatest(F.lit(1), F.ceil(targets.count() / F.lit(block_targets))).cast("int")
    keyed = targets.select(F.pmod(F.xxhash64(*targets.columns), blocks).cast("int").alias("_block"), F.struct(*targets.columns).alias("_t"))
    lists = keyed.groupBy("_block").agg(F.collect_list("_t").alias("_ts"))
    spread = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return spread.join(lists, "_block").withColumn("_t", F.explode("_ts")).drop("_block", "_ts")


def cell_products(
    cells: DataFrame,
    rows: DataFrame,
    row: str,
    column: str,
    own: str,
    shared: str,
    outer: str,
    block_rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
    at_once: int = PAIRS_AT_ONCE,
) -> DataFrame:
    """Per cell (u, i) of ``cells``: ``product``, the sum over v and j of own(u, j) * shared(v, j) * outer(v, i).

    ``rows`` holds (row, column) once each with the three values. A cell goes through the rows v of its own column i; they
    meet the sums of own * shared over the columns that u and v have in common. Only rows that have a cell get such sums,
    and no pair of columns is ever built: a row with half of all entries costs its entries times the rows that share them.
    The row lists of a column travel packed to the tasks that own u, and both the sums and the products are worked out
    there; only partial sums of cells are shuffled. Repeated cells count once; a cell without a partner has no row. Columns
    with very many rows are cut into blocks, rows u with very many partners are dealt to several tasks.
    """
    wanted = cells.select(F.col(row).alias("_u"), F.col(column).alias("_i")).filter("_u IS NOT NULL AND _i IS NOT NULL").distinct()
    wanted = write_through(wanted, "cells")
    entries = rows.select(F.col(row).alias("_v"), F.col(column).alias("_j"), F.col(own).alias("_x"), F.col(shared).alias("_y"), F.col(outer).alias("_z"))
    asked = entries.join(wanted.select(F.col("_u").alias("_v")).distinct(), "_v", "left_semi")
    lists = group_lists(entries, "_j", "_v", ["_y", "_z"], block_rows, hot_rows).withColumnRenamed("_ms", "_bs")
    sizes = lists.groupBy("_g").agg(F.max("_size").alias("_load"))
    given = [group_lists(asked, "_j", "_v", ["_x"], block_rows, hot_rows), group_lists(wanted, "_i", "_u", [], block_rows, hot_rows)]
    kind = rows.schema[row].dataType
    owner = F.col("_a").cast(kind).alias("_a")
    loads = [side.select("_g", F.explode("_ms").alias("_a")).join(sizes, "_g").select(owner, "_load") for side in given]
    hot, tasks = _parts_of(loads[0].unionByName(loads[1]), at_once)
    alike = met_lists(given[0], lists.drop("_z")).select("_bs", "_y", "_x", F.posexplode("_ms").alias("_at", "_a"))
    alike = alike.select(owner, F.col("_x")[F.col("_at")].alias("_x"), "_bs", "_y")
    alike = _partners(_placed(alike, hot, tasks, ["_y"]), ["_y"], kind)
    alike = alike.groupBy("_a", "_share", "_b").agg(F.sum(F.col("_x") * F.col("_y")).alias("_s"))
    raters = met_lists(given[1], lists.drop("_y")).select("_g", "_bs", "_z", F.explode("_ms").alias("_a"))
    raters = _partners(_placed(raters.withColumn("_a", owner), hot, tasks, ["_z"]), ["_z"], kind)
    return (
        raters.join(alike.hint("merge"), ["_a", "_share", "_b"])
        .groupBy(F.col("_a").alias(row), F.col("_g").alias(column))
        .agg(F.sum(F.col("_s") * F.col("_z")).alias("product"))
    )


def listed_sums(
    own: DataFrame,
    key: str,
    group: str,
    weight: str,
    rows: DataFrame,
    member: str,
    value: str,
    block_rows: int = BLOCK_ROWS,
    hot_rows: int = HOT_ROWS,
    at_once: int = PAIRS_AT_ONCE,
) -> DataFrame:
    """(key, member, top): the sum over ``own`` (key, group, weight) and ``rows`` (group, member, value) of weight * value, over
    their common groups. The members of a group travel packed to the tasks that own the key."""
    lists = group_lists(rows, group, member, [value], block_rows, hot_rows, nulls=True).withColumnsRenamed({"_ms": "_bs", value: "_y"})
    given = group_lists(own.select(group, key, F.col(weight).alias("_x")), group, key, ["_x"], block_rows, hot_rows)
    sizes = lists.groupBy("_g").agg(F.max("_size").alias("_load"))
    owner = F.col("_a").cast(own.schema[key].dataType).alias("_a")
    hot, tasks = _parts_of(given.select("_g", F.explode("_ms").alias("_a")).join(sizes, "_g").select(owner, "_load"), at_once)
    met = met_lists(given, lists).select("_bs", "_y", "_x", F.posexplode("_ms").alias("_at", "_a"))
    met = met.select(owner, F.col("_x")[F.col("_at")].alias("_x"), "_bs", "_y")
    sums = _partners(_placed(met, hot, tasks, ["_y"]), ["_y"], rows.schema[member].dataType).groupBy("_a", "_share", "_b").agg(F.sum(F.col("_x") * F.col("_y")).alias("top"))
    return sums.select(F.col("_a").alias(key), F.col("_b").alias(member), "top")
