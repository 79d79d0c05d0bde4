"""Prefix trie of conversations by truncation peeling.

A conversation is the chain of its prefixes, each named by a hash of the one before it and the turn. Equal conversations
are merged first. Then, from the greatest depth down, the conversations that end at a depth are merged with the nodes
that survive there; the merged nodes are finished (members, leaves, saved bytes), their last turn is stripped, and they
are grouped again one turn higher up. Deep nodes are peeled inside tasks: the conversations of a task share a prefix as
long as it takes for no prefix to hold over GROUP different conversations. From there on every level is one grouping
over the whole cluster, with partial sums before the shuffle, so a common first turn loads no single task.

Defined results: null role or text counts as empty; a null turn comes first, turns of equal number stand by hash; a turn
that occurs twice counts twice. Rows without a conversation id belong to no conversation. An empty table has no node,
not even the root. A very long text is hashed where it is read; a conversation is held by one task at a time (24 bytes a
turn). Columns other than the four named are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.operators.skew import salted_join
from tallymart.session import write_through

#: Different conversations below one prefix that a task may hold.
GROUP = 100_000
#: Fewer are not spread over tasks.
SMALL = 64
#: Conversations with close ids whose ids are joined to one text before the ids of a node are hashed.
CHUNK_BITS = 6
ROOT = b""
CHAIN = "conv_id long, keys array<binary>, sizes array<long>"
LIVE = "key binary, keys array<binary>, sizes array<long>, conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string"
NODE = "key binary, depth long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string"
COUNTS = ["n_convs", "n_children", "n_leaves", "saved"]


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, place`` (from 1), ``digest`` and ``size`` (UTF-8 bytes of the text) of every turn."""
    who, what = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what), 256))
    plain = rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), digest.alias("digest"), F.octet_length(what).cast("long").alias("size")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "digest")
    return plain.select("conv_id", F.row_number().over(order).alias("place"), "digest", "size")


def chains(turn_rows: DataFrame, convs: DataFrame) -> DataFrame:
    """A row for each of ``convs``: the names and last text sizes of its prefixes, shortest first. ``turn_rows`` is
    ordered by ``place`` within ``conv_id``."""
    marks = convs.select("conv_id").withColumn("place", F.lit(0))
    dealt = turn_rows.unionByName(marks, allowMissingColumns=True).repartition("conv_id")
    return dealt.sortWithinPartitions("conv_id", "place").mapInArrow(_chained, CHAIN)


def trie(sequences: DataFrame) -> DataFrame:
    """A row for each node: ``depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved, ends`` (hash of the
    ids that end there)."""
    sequences = write_through(sequences, "chains")
    if sequences.isEmpty():
        return sequences.sparkSession.createDataFrame([], NODE).drop("key")
    end = F.when(F.size("keys") > 0, F.element_at("keys", -1)).otherwise(F.lit(ROOT))
    ended = sequences.withColumn("key", end)
    merged = ended.groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.any_value("keys").alias("keys"), F.any_value("sizes").alias("sizes")
    )
    zero = F.lit(0).cast("long")
    fresh = merged.join(_ends(ended), "key").select(
        "key", "keys", "sizes", "conv_id", "n_convs", zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved"), "ends"
    )
    fresh = write_through(fresh, "sequences")
    floor = _floor(fresh)
    deep = fresh.filter(F.size("keys") >= floor).withColumn("anchor", F.element_at("keys", floor))
    peeled = write_through(
        deep.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(_peeler(floor), f"alive boolean, {NODE}, keys array<binary>, sizes array<long>"), "peeled"
    )
    found = [peeled.filter("NOT alive").drop("alive", "keys", "sizes", "key")]
    alive = peeled.filter("alive").select("key", "keys", "sizes", "conv_id", *COUNTS, "ends")
    for depth in range(floor, 0, -1):
        upper = write_through(_stripped(alive, fresh.filter(F.size("keys") == depth - 1), depth - 1), "level")
        found.append(_with_parents(alive, upper, depth))
        alive = upper
    found.append(alive.select(zero.alias("depth"), "conv_id", F.lit(None).cast("long").alias("parent_conv_id"), *COUNTS, "ends"))
    out = found[0]
    for level in found[1:]:
        out = out.unionByName(level)
    return out


def _stripped(alive: DataFrame, ended: DataFrame, depth: int) -> DataFrame:
    """The nodes at ``depth``: those one turn deeper without their last turn, and the conversations that end here."""
    key = F.element_at("keys", depth) if depth else F.lit(ROOT)
    shorter = alive.select(
        key.alias("key"), F.slice("keys", 1, depth).alias("keys"), F.slice("sizes", 1, depth).alias("sizes"), "conv_id", "n_convs",
        F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved", F.lit(None).cast("string").alias("ends"),
    )
    nodes = shorter.unionByName(ended).groupBy("key").agg(
        F.any_value("keys").alias("keys"), F.any_value("sizes").alias("sizes"), F.min("conv_id").alias("conv_id"),
        *(F.sum(c).alias(c) for c in COUNTS), F.coalesce(F.max("ends"), F.lit(hashlib.sha256().hexdigest())).alias("ends"),
    )
    size = F.element_at("sizes", depth) if depth else F.lit(0)
    leaves = F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long")
    return nodes.withColumns({"n_leaves": leaves, "saved": F.col("saved") + (F.col("n_convs") - 1) * size})


def _with_parents(nodes: DataFrame, upper: DataFrame, depth: int) -> DataFrame:
    kept = ["conv_id", *COUNTS, "ends"]
    if depth == 1:
        top = upper.select(F.min("conv_id")).scalar()
        named = nodes.withColumn("parent_conv_id", top)
    else:
        parents = upper.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
        below = nodes.select(*kept, F.element_at("keys", depth - 1).alias("parent"))
        named = salted_join(below, parents.join(upper.select(F.col("key").alias("parent"), "n_children"), "parent").withColumnRenamed("n_children", "_rows"), ["parent"], count="_rows")
    return named.select(F.lit(depth).cast("long").alias("depth"), "conv_id", "parent_conv_id", *COUNTS, "ends")


def _floor(fresh: DataFrame) -> int:
    """The least depth, 1 at least, below whose prefixes no more than GROUP different conversations stand; on small
    tables no more than a small part of all."""
    total = fresh.count()
    most = min(GROUP, max(SMALL, total // 256))
    low = 0
    while True:
        span = F.sequence(F.lit(low + 1), F.least(F.size("keys"), F.lit(low + 16)))
        long = fresh.filter(F.size("keys") > low).select(F.explode(span).alias("depth"), "keys")
        held = long.groupBy("depth", F.get("keys", F.col("depth") - 1).alias("key")).count().groupBy("depth").agg(F.max("count").alias("most"))
        by_depth = {r["depth"]: r["most"] for r in held.collect()}
        for depth in range(low + 1, low + 17):
            if by_depth.get(depth, 0) <= most:
                return depth
        low += 16


# ---- in tasks --------------------------------------------------------------------------------


def _chained(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, keys, sizes = [], [], []
    key = ROOT
    for batch in batches:
        for conv, place, digest, size in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "digest", "size"))):
            if not place:
                if len(names) >= 1000:
                    yield _chain_batch(names, keys, sizes)
                    names, keys, sizes = [], [], []
                names.append(conv)
                keys.append([])
                sizes.append([])
                key = ROOT
                continue
            key = hashlib.sha256(key + digest).digest()[:16]
            keys[-1].append(key)
            sizes[-1].append(size)
    if names:
        yield _chain_batch(names, keys, sizes)


def _chain_batch(names: list[int], keys: list[list[bytes]], sizes: list[list[int]]) -> pa.RecordBatch:
    columns = [pa.array(names, pa.int64()), pa.array(keys, pa.list_(pa.binary())), pa.array(sizes, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, ["conv_id", "keys", "sizes"])


class _Node:
    __slots__ = ("chain", "conv", "ends", "kids", "leaves", "n", "saved")

    def __init__(self, chain: tuple[list[bytes], list[int]]):
        self.chain, self.conv, self.ends = chain, None, None
        self.n = self.leaves = self.saved = 0
        self.kids: list[_Node] = []

    def add(self, conv: int, n: int) -> None:
        self.conv = conv if self.conv is None else min(self.conv, conv)
        self.n += n


def _peeled(rows: list[dict], floor: int) -> Iterator[tuple]:
    """Nodes of conversations that share a prefix of ``floor`` turns; the node of that prefix comes last, alive."""
    nothing = hashlib.sha256().hexdigest()
    by_depth: dict[int, list[dict]] = {}
    for row in rows:
        by_depth.setdefault(len(row["keys"]), []).append(row)
    live: dict[bytes, _Node] = {}
    for depth in range(max(by_depth), floor - 1, -1):
        merged: dict[bytes, _Node] = {}
        for node in live.values():
            key = node.chain[0][depth - 1]
            upper = merged.get(key) or merged.setdefault(key, _Node(node.chain))
            upper.add(node.conv, node.n)
            upper.leaves += node.leaves
            upper.saved += node.saved
            upper.kids.append(node)
        for row in by_depth.get(depth, ()):
            key = row["key"]
            node = merged.get(key) or merged.setdefault(key, _Node((row["keys"], row["sizes"])))
            node.add(row["conv_id"], row["n_convs"])
            node.ends = row["ends"]
        for node in merged.values():
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.chain[1][depth - 1]
            for kid in node.kids:
                yield False, None, depth + 1, kid.conv, node.conv, kid.n, len(kid.kids), kid.leaves, kid.saved, kid.ends or nothing, None, None
                kid.kids = ()
        live = merged
    for key, node in live.items():
        keys, sizes = node.chain
        yield True, key, floor, node.conv, None, node.n, len(node.kids), node.leaves, node.saved, node.ends or nothing, keys[:floor], sizes[:floor]


def _peeler(floor: int):
    kinds = [pa.bool_(), pa.binary(), *[pa.int64()] * 7, pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64())]
    names = "alive key depth conv_id parent_conv_id n_convs n_children n_leaves saved ends keys sizes".split()

    def groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[dict]]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["anchor"] != held[0]["anchor"]:
                    yield held
                    held = []
                held.append(row)
        if held:
            yield held

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for held in groups(batches):
            for node in _peeled(held, floor):
                out.append(node)
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return run


def _ends(ended: DataFrame) -> DataFrame:
    """Hash of the ids that end at a key, in order: close ids are joined to a text first, the texts are hashed one
    after another, so no task holds the ids of a common conversation."""
    ids = F.transform(F.array_sort(F.collect_list("conv_id")), lambda x: x.cast("string"))
    chunks = ended.groupBy("key", F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.array_join(ids, ",").alias("ids"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, total = None, None
        for batch in batches:
            keys, ends = [], []
            for now, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
                if now != key:
                    if key is not None:
                        keys.append(key)
                        ends.append(total.hexdigest())
                    key, total = now, hashlib.sha256(ids.encode())
                else:
                    total.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(ends, pa.string())], ["key", "ends"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([total.hexdigest()])], ["key", "ends"])

    return chunks.repartition("key").sortWithinPartitions("key", "chunk").mapInArrow(run, "key binary, ends string")
