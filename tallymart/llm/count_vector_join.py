"""Near-duplicate classes by the Jaccard similarity of word n-grams, over count-vector R-trees.

The n-grams of a document are hashed into ``dims`` groups; the group sizes are its point. For two documents the sum over
groups of the smaller count bounds the number of shared n-grams from above, so a pair whose bound is
too small for the threshold cannot link.

A single tree over a large corpus would visit most leaves (the points are close to each other in every
coordinate), so the points are dealt out first, without losing a pair: at similarity t, two sets of sizes a and b differ in
at most d = (1-t)/(1+t)*(a+b) n-grams. Split into c > d cells by hash, they have at least c-d equal cells. Every
document therefore goes to one bucket per cell, keyed by the cell's content. With a fifth more cells than d
nearly every set has fewer than c-d empty ones; one of the equal cells is then filled, and the empty cells, which
would bring unrelated documents together, need no bucket.

Per bucket with several different sets:

1. every set is compared with the smallest member of the buckets it shares most often, and the links
   found are contracted to components;
2. buckets that still hold several components get an R-tree of their points; pairs of different components that pass the
   bound join sets to families. Of these pairs only as many are kept as join the family, fewer than it has
   members, however many there are. Two sets that link and are not in one component yet are in one family;
3. the texts of a family meet, each travelling once, or once for every block of a large family. An R-tree finds its pairs of
   different components that pass the bound; they are verified, and what links is merged at once.

A pair inside one component needs no check, as it cannot change the classes. Hence a group of near copies
costs about one comparison a member, and nothing is capped: what the first step leaves is searched by the others in full.
Verification intersects the n-gram sets of the two whole texts.

Sets are told apart by 64-bit hashes of n-grams and of whole sets.

Defined results: null, empty and all-space texts have an empty set and link with nothing; fewer words
than ``size`` make one n-gram; equal rows share a class; a null id never names a class.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.components import components
from tallymart.llm.rows import ROW_KEY, WordHashes, as_bytes, mixed, ngram_hashes, with_row_key, without_row_key
from tallymart.session import write_through

BAND = Fraction(7, 5)  # sizes of a band differ by less than this factor
BLOCK = 2048  # members of a bucket that one search task holds on either side
KIN = 512  # members of a family that one search task holds on either side
LEAF = 16
FEW = 8  # pairs of a set below which their n-grams are compared pair by pair
LOT = 20_000  # members of small buckets that one search task holds
TEXTS = 1_000  # members of small families that one search task holds
CROWD = 64  # pairs for each member up to which all of them are held
SPARE = 5  # one cell more for so many in which a link may differ


def shingles(data: bytes, size: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct n-gram hashes of a text; ASCII letters count as lower case."""
    words = data.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(ngram_hashes(hashes.of(words), min(size, len(words))))


def set_hash(grams: np.ndarray) -> int:
    return np.uint64(xxhash.xxh3_64_intdigest(grams.tobytes())).astype(np.int64).item()


class Sizes:
    """What the threshold says about set sizes."""

    def __init__(self, percent: int):
        self.t = Fraction(percent, 100)
        self.starts = [1]

    def overlap(self, a, b):
        """Smallest number of shared n-grams that reaches the threshold: 100 o >= p (a + b - o)."""
        p = self.t * 100
        return -(-(p.numerator * (a + b)) // (100 * p.denominator + p.numerator))

    def bands(self, size: int) -> list[tuple[int, int, int]]:
        """(band, number of cells, most cells in which a link differs) under which a set of ``size`` is dealt out. A
        pair always shares the band of its larger set."""
        while self.starts[-1] <= 2 * size:
            self.starts.append(max(self.starts[-1] + 1, floor(self.starts[-1] * BAND)))
        own = next(i for i in range(len(self.starts) - 1) if self.starts[i + 1] > size)
        found = []
        for band in range(own, len(self.starts) - 1):
            if band > own and self.starts[band] * self.t > size:
                break
            largest = self.starts[band + 1] - 1
            apart = floor((1 - self.t) / (1 + self.t) * 2 * largest)
            found.append((band, apart + 1 + apart // SPARE, apart))
        return found


def cell_keys(grams: np.ndarray, sizes: Sizes) -> np.ndarray:
    """One key for every cell of every band: a hash of band, cell and the cell's n-grams (their sum, mixed). Empty cells
    have none where they are fewer than the cells that a link has in common, as one of those is then filled."""
    out = []
    for band, cells, apart in sizes.bands(len(grams)):
        place = ((mixed(grams ^ np.uint64(band + 1)) >> np.uint64(33)) % np.uint64(cells)).astype(np.int64)
        sums = np.zeros(cells, np.uint64)
        np.add.at(sums, place, mixed(grams + np.uint64(0x51ED27)))
        tag = np.arange(cells, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(band)
        keys = mixed(mixed(sums + mixed(tag)) + tag)
        filled = np.bincount(place, minlength=cells) > 0
        out.append(keys[filled] if cells - filled.sum() < cells - apart else keys)
    return np.concatenate(out)


def count_vector(grams: np.ndarray, dims: int) -> bytes:
    """Group sizes as little-endian 32-bit counts."""
    groups = (mixed(grams + np.uint64(0xA5A5)) >> np.uint64(40)) % np.uint64(dims)
    return np.bincount(groups.astype(np.int64), minlength=dims).astype("<u4").tobytes()


class PointTree:
    """A packed R-tree of the points of ``members``: sorted by size and packed into leaves; the box of a leaf is its
    largest count per coordinate and its range of sizes."""

    def __init__(self, points: np.ndarray, size: np.ndarray, members: np.ndarray, sizes: Sizes):
        self.points, self.size, self.sizes = points, size, sizes
        self.order = members[np.argsort(size[members], kind="stable")]
        self.starts = np.arange(0, len(self.order), LEAF)
        self.top = np.maximum.reduceat(points[self.order], self.starts, axis=0)
        self.least, self.most = size[self.order][self.starts], np.maximum.reduceat(size[self.order], self.starts)

    def near(self, at: int, *apart: np.ndarray) -> np.ndarray:
        """The members whose bound with the set ``at`` allows the threshold and whose number in each of ``apart`` (class,
        family) is another one than that of ``at``."""
        n, points, t = int(self.size[at]), self.points, self.sizes.t
        low, high = t.numerator, t.denominator
        visit = (self.least * low <= n * high) & (self.most * high >= n * low)
        visit &= np.minimum(self.top, points[at]).sum(1, dtype=np.int64) >= self.sizes.overlap(n, self.least)
        near = self.order[np.repeat(visit, LEAF)[: len(self.order)]]
        for numbers in apart:
            near = near[numbers[near] != numbers[at]]
        return near[np.minimum(points[near], points[at]).sum(1, dtype=np.int64) >= self.sizes.overlap(n, self.size[near])]


class SharedCounts:
    """How many n-grams a set shares with each of the others."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.size = sets, np.array([len(grams) for grams in sets])
        self.owner = None

    def _index(self):
        grams, codes, counts = np.unique(np.concatenate(self.sets), return_inverse=True, return_counts=True)
        self.owner = np.repeat(np.arange(len(self.sets)), self.size)[np.argsort(codes, kind="stable")]
        self.counts, self.first = counts, np.cumsum(counts) - counts
        self.codes = np.split(codes, np.cumsum(self.size)[:-1])

    def of(self, at: int, others: np.ndarray) -> np.ndarray:
        if len(others) < FEW:
            return np.array([len(np.intersect1d(self.sets[at], self.sets[i], assume_unique=True)) for i in others], np.int64)
        if self.owner is None:
            self._index()
        codes = self.codes[at]
        counts = self.counts[codes]
        place = np.repeat(self.first[codes] - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        return np.bincount(self.owner[place], minlength=len(self.sets))[others]


def linked_pairs(
    left: np.ndarray, right: np.ndarray, classes: np.ndarray, sets: list[np.ndarray], dims: int, sizes: Sizes
) -> np.ndarray:
    """Links between different classes of the sets numbered ``left`` and ``right``, enough of them to join all classes
    that any link joins; found by an R-tree of the count vectors of ``right``.

    A set is compared with the near ones that are in another class at that time. ``classes`` is merged along the way.
    """
    points = np.array([np.frombuffer(count_vector(grams, dims), "<u4") for grams in sets], np.int64)
    shared = SharedCounts(sets)
    tree, links = PointTree(points, shared.size, right, sizes), [np.empty((0, 2), np.int64)]
    for at in left:
        near = tree.near(at, classes)
        near = near[shared.of(at, near) >= sizes.overlap(int(shared.size[at]), shared.size[near])]
        links.append(joined(np.stack([np.full(len(near), at), near], axis=1), classes))
    return np.concatenate(links)


def near_pairs(
    left: np.ndarray,
    right: np.ndarray,
    classes: np.ndarray,
    points: np.ndarray,
    size: np.ndarray,
    sizes: Sizes,
    family: np.ndarray | None = None,
) -> np.ndarray | None:
    """All pairs of different classes between ``left`` and ``right`` whose bound allows the threshold, as two columns;
    None if there are more than ``CROWD`` for each member. With ``family``, which is merged along the way, only as many of
    them as join all families that any of them joins."""
    tree, found, held = PointTree(points, size, right, sizes), [np.empty((0, 2), np.int64)], 0
    for at in left:
        near = tree.near(at, classes) if family is None else tree.near(at, classes, family)
        pairs = np.stack([np.full(len(near), at), near], axis=1)
        found.append(pairs if family is None else joined(pairs, family))
        held += len(found[-1])
        if family is None and held > CROWD * (len(left) + len(right)):
            return None
    return np.concatenate(found)


def joined(pairs: np.ndarray, family: np.ndarray) -> np.ndarray:
    """Those of the pairs that join two families at their turn; ``family`` is merged along the way."""
    found = []
    for a, b in pairs:
        if family[a] != family[b]:
            family[family == family[b]] = family[a]
            found.append((a, b))
    return np.array(found, np.int64).reshape(-1, 2)


def leaf_pairs(
    buckets: list[np.ndarray],
    classes: np.ndarray,
    points: np.ndarray,
    size: np.ndarray,
    sizes: Sizes,
    names: np.ndarray | None = None,
) -> np.ndarray:
    """What ``near_pairs`` finds in buckets that fit into one leaf each, all of them at a time. ``names``: equal for rows
    of the same set."""
    found = [np.empty((0, 2), np.int64)]
    for count in {len(bucket) for bucket in buckets}:
        held = np.stack([bucket for bucket in buckets if len(bucket) == count])
        one, other = np.triu_indices(count, 1)
        found.append(np.stack([held[:, one].ravel(), held[:, other].ravel()], axis=1))
    pairs = np.concatenate(found)
    a, b = pairs[:, 0], pairs[:, 1]
    if names is not None:  # a pair that shares several buckets is judged once
        rank = np.unique(names, return_inverse=True)[1]
        both = np.minimum(rank[a], rank[b]) * len(names) + np.maximum(rank[a], rank[b])
        pairs = pairs[np.unique(both, return_index=True)[1]]
        a, b = pairs[:, 0], pairs[:, 1]
    low, high = sizes.t.numerator, sizes.t.denominator
    pairs = pairs[
        (classes[a] != classes[b])
        & (np.minimum(size[a], size[b]) * high >= np.maximum(size[a], size[b]) * low)
    ]
    kept = [np.empty((0, 2), np.int64)]
    for at in range(0, len(pairs), 16_384):
        block = pairs[at : at + 16_384]
        a, b = block[:, 0], block[:, 1]
        bound = np.minimum(points[a], points[b]).sum(1, dtype=np.int64)
        kept.append(block[bound >= sizes.overlap(size[a], size[b])])
    return np.concatenate(kept)


def _describe(docs: DataFrame, size: int) -> DataFrame:
    """Row key, id, set size, hash of the set."""
    id_kind = docs.schema["id"].dataType.simpleString()
    schema = f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, id {id_kind}, n_shingles long, node long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingles(value.as_py(), size, hashes) for value in batch.column(3)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:3],
                    pa.array([len(grams) for grams in sets], pa.int64()),
                    pa.array([set_hash(grams) for grams in sets], pa.int64()),
                ],
                names=[*ROW_KEY, "id", "n_shingles", "node"],
            )

    return docs.select(*ROW_KEY, "id", "data").mapInArrow(run, schema)


def _keys(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Bucket keys of every set, combined before the shuffle: for each key of a batch one head, and the
    other sets of the batch that have the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, sizes = WordHashes(), Sizes(percent)
        for batch in batches:
            nodes, keys, lengths = [], [], []
            for value in batch.column(0):
                grams = shingles(value.as_py(), size, hashes)
                if len(grams):
                    nodes.append(set_hash(grams))
                    keys.append(cell_keys(grams, sizes))
                    lengths.append(len(keys[-1]))
            if not nodes:
                continue
            node = np.repeat(np.array(nodes, np.int64), lengths)
            key = np.concatenate(keys).astype(np.int64)
            order = np.lexsort((node, key))
            node, key = node[order], key[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
            node, key = node[new], key[new]
            head = np.ones(len(key), bool)
            head[1:] = key[1:] != key[:-1]
            at = np.flatnonzero(head)
            offsets = np.concatenate([at - np.arange(len(at)), [len(key) - len(at)]]).astype(np.int32)
            others = pa.ListArray.from_arrays(pa.array(offsets), pa.array(node[~head]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[at]), pa.array(node[at]), others], names=["key", "head", "others"]
            )

    return docs.select("data").mapInArrow(run, "key long, head long, others array<long>")


def _shared_buckets(keys: DataFrame) -> DataFrame:
    """``key``, ``node`` for every bucket that holds several sets."""
    bucket = Window.partitionBy("key")
    held = keys.withColumn("low", F.min("head").over(bucket)).withColumn("high", F.max("head").over(bucket))
    held = held.filter("low < high OR size(others) > 0")
    return held.select("key", F.explode(F.concat(F.array("head"), "others")).alias("node")).distinct()


def _verified(pairs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """Those of the pairs (``high``, ``low``) whose n-gram sets reach the threshold."""

    @F.arrow_udf("boolean")
    def linked(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        hashes = WordHashes()
        last, grams = None, None
        for left, right in batches:
            out = []
            for a, b in zip(left, right):
                b = b.as_py()
                if b != last:
                    last, grams = b, shingles(b, size, hashes)
                other = shingles(a.as_py(), size, hashes)
                shared = len(np.intersect1d(other, grams, assume_unique=True))
                out.append(100 * shared >= percent * (len(other) + len(grams) - shared))
            yield pa.array(out, pa.bool_())

    first = sets.select(F.col("node").alias("high"), F.col("data").alias("high_data"))
    second = sets.select(F.col("node").alias("low"), F.col("data").alias("low_data"))
    joined = pairs.join(first, "high").join(second, "low")
    return joined.select("high", "low", linked("high_data", "low_data").alias("ok")).filter("ok").select("high", "low")


def _points(sets: DataFrame, size: int, dims: int) -> DataFrame:
    """Size and count vector of every set; the counts' lowest bytes come first, then the next, as most are zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            held = [shingles(value.as_py(), size, hashes) for value in batch.column(1)]
            points = [np.frombuffer(count_vector(grams, dims), "u1").reshape(dims, 4).T.tobytes() for grams in held]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(grams) for grams in held], pa.int64()), pa.array(points, pa.binary())],
                names=["node", "n", "point"],
            )

    return sets.select("node", "data").mapInArrow(run, "node long, n long, point binary")


def _in_blocks(groups: DataFrame, key: str, lot: Column, block: int) -> DataFrame:
    """Members of groups (``key``, ``node``, ``members``) dealt out to search tasks: groups of one block by ``lot``, each of
    the others ``alone``, in pairs of its blocks ``x`` and ``y``; ``own`` is the member's block."""
    small, blocks = F.col("members") <= block, F.ceil(F.col("members") / block).cast("int")
    dealt = groups.withColumn("lot", F.when(small, lot)).withColumn("alone", F.when(~small, F.col(key)))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other")).drop("other")


def _open_buckets(shared: DataFrame, classes: DataFrame) -> DataFrame:
    """``key``, ``node``, ``class``, ``members`` and ``least`` (its smallest class) of the buckets that hold several components. Of
    buckets with the same members there is one."""
    placed = shared.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component")
    # two numbers a bucket travel for all buckets, whole rows only for those that hold several components
    span = placed.groupBy("key").agg(F.min("class").alias("least"), F.max("class").alias("b"))
    span = write_through(span.filter("least < b").select("key", "least"), "open")
    members = write_through(placed.join(span, "key"), "members")
    held = (F.count(F.lit(1)), F.sum(F.xxhash64("node").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("node", F.lit(1))))
    open_ = (
        members.groupBy("key")
        .agg(*(column.alias(name) for column, name in zip(held, ("members", "total", "folded"))))
        .groupBy("members", "total", "folded")
        .agg(F.min("key").alias("key"))
        .select("key", "members")
    )
    return write_through(members.join(open_, "key"), "searched")


def _families(members: DataFrame, sets: DataFrame, size: int, dims: int, percent: int) -> DataFrame:
    """Pairs (``high``, ``low``) of sets whose bound allows the threshold, enough of them to join all that such pairs of
    different components of a bucket join. The search moves points, not texts.

    Small buckets with the same smallest class are searched by one task, if they are not too many for it: they are those that
    have most sets in common, and a pair that shares many buckets is then met and written once."""
    points = write_through(_points(sets.join(members.select("node").distinct(), "node", "left_semi"), size, dims), "points")
    load = members.filter(F.col("members") <= BLOCK).groupBy("least").agg(F.count(F.lit(1)).alias("load"))
    lots = max(1, -(-members.count() // LOT))
    parts = F.ceil(F.col("load") / LOT)
    lot = F.when(parts > 1, F.xxhash64("least", F.pmod(F.xxhash64("key"), parts))).otherwise(F.pmod(F.xxhash64("least"), F.lit(lots)))
    dealt = _in_blocks(members.join(load, "least", "left"), "key", lot, BLOCK)

    def near(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        node, first, row = np.unique(table.column("node").to_numpy(), return_index=True, return_inverse=True)
        own, classes, count = (table.column(name).to_numpy()[first] for name in ("own", "class", "n"))
        flat = np.frombuffer(b"".join(table.column("point").take(pa.array(first)).to_pylist()), "u1").reshape(len(node), 4, dims)
        points = flat[:, 0]
        if flat[:, 1:].any():
            points = np.ascontiguousarray(flat.transpose(0, 2, 1)).view("<u4")[:, :, 0]
        key, sizes, family = table.column("key").to_numpy(), Sizes(percent), np.arange(len(node))
        order = np.argsort(key, kind="stable")
        buckets = np.split(row[order], np.flatnonzero(np.diff(key[order])) + 1)
        few = [held for held in buckets if len(held) <= LEAF and x == y]
        found = [joined(leaf_pairs(few, classes, points, count, sizes, np.arange(len(node))), family)]
        for held in buckets:
            if len(held) > LEAF or x < y:
                left, right = (held, held) if x == y else (held[own[held] == x], held[own[held] != x])
                if not len(left) or not len(right) or (family[held] == family[held[0]]).all():
                    continue
                found.append(near_pairs(left, right, classes, points, count, sizes, family))
        a, b = node[np.concatenate(found)].T
        return pa.table({"high": np.maximum(a, b), "low": np.minimum(a, b)})

    names = ["key", "x", "y", "own", "node", "class", "lot", "alone"]
    pointed = dealt.select(names).join(points, "node").groupBy("lot", "alone", "x", "y")
    return pointed.applyInArrow(near, "high long, low long")


def _crossing(shared: DataFrame, classes: DataFrame, sets: DataFrame, size: int, dims: int, percent: int) -> DataFrame:
    """What the first step left: links (``high``, ``low``) between different components, enough of them to join all
    components that any link joins."""
    members = _open_buckets(shared, classes)
    families = write_through(components(_families(members, sets, size, dims, percent)), "families")
    kin = families.unionByName(families.select(F.col("component").alias("node"), "component").distinct())
    kin = kin.withColumnRenamed("component", "family")
    count = families.groupBy("component").agg((F.count(F.lit(1)) + 1).alias("members"))
    kin = kin.join(count.withColumnRenamed("component", "family"), "family")
    kin = kin.join(classes, "node", "left").withColumn("class", F.coalesce("component", "node")).drop("component")
    kin = write_through(kin, "kin")
    lots = max(1, -(-kin.count() // TEXTS))
    dealt = _in_blocks(kin, "family", F.pmod(F.xxhash64("family"), F.lit(lots)), KIN)

    def search(table: pa.Table) -> pa.Table:
        hashes, sizes = WordHashes(), Sizes(percent)
        node, family, own, classes = (table.column(name).to_numpy() for name in ("node", "family", "own", "class"))
        grams = [shingles(value.as_py(), size, hashes) for value in table.column("data")]
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        order, links = np.argsort(family, kind="stable"), [np.empty((0, 2), np.int64)]
        for held in np.split(order, np.flatnonzero(np.diff(family[order])) + 1):
            every = np.arange(len(held))
            left, right = (every, every) if x == y else (np.flatnonzero(own[held] == x), np.flatnonzero(own[held] != x))
            if len(left) and len(right):
                found = linked_pairs(left, right, classes[held].copy(), [grams[at] for at in held], dims, sizes)
                links.append(held[found])
        a, b = node[np.concatenate(links)].T
        return pa.table({"high": np.maximum(a, b), "low": np.minimum(a, b)})

    names = ["family", "x", "y", "own", "node", "class", "lot", "alone"]
    texts = dealt.select(names).join(sets, "node").groupBy("lot", "alone", "x", "y")
    return texts.applyInArrow(search, "high long, low long")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    dims: int = 128,
) -> DataFrame:
    """One row per document: row key, ``id``, ``n_shingles`` and ``component_id``, the smallest id it
    reaches over links of at least ``percent`` percent Jaccard similarity."""
    keyed = with_row_key(docs).select(*ROW_KEY, id_col, text_col)
    docs = keyed.select(*ROW_KEY, F.col(id_col).alias("id"), as_bytes(text_col).alias("data"))
    rows = write_through(_describe(docs, size), "sets")
    shared = write_through(_shared_buckets(_keys(docs, size, percent)), "buckets")
    filled = rows.filter("n_shingles > 0")
    one = F.min(F.struct(*ROW_KEY)).alias("row")
    involved = shared.select("node").distinct()
    chosen = filled.join(involved, "node", "left_semi").groupBy("node").agg(one)
    sets = docs.join(chosen.select("node", "row.*"), ROW_KEY).select("node", "data")
    sets = write_through(sets, "texts")

    bucket = Window.partitionBy("key")
    star = shared.withColumn("low", F.min("node").over(bucket)).filter("node <> low").groupBy("node", "low").count()
    star = star.groupBy("node").agg(F.max_by("low", F.struct("count", "low")).alias("low"))
    star = write_through(star.withColumnRenamed("node", "high"), "star")
    classes = components(_verified(star, sets, size, percent))
    rest = _crossing(shared, classes, sets, size, dims, percent)
    found = classes.select(F.col("node").alias("high"), F.col("component").alias("low"))
    classes = components(found.unionByName(rest))

    names = filled.groupBy("node").agg(F.min("id").alias("least"))
    named = names.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = named.join(smallest, "component").select("node", "component_id")
    both = filled.join(ids, "node", "left").unionByName(
        rows.filter("n_shingles = 0").withColumn("component_id", F.col("id"))
    )
    return both.select(*ROW_KEY, "id", "n_shingles", "component_id")


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80
) -> DataFrame:
    """One document of each class stays, the one with the smallest id; documents without words stay as they are."""
    keyed = with_row_key(docs)
    found = near_duplicates(keyed, id_col, text_col, size, percent).filter("n_shingles > 0")
    best = F.struct(F.col("id").isNull(), "id", *ROW_KEY)
    first = found.filter("component_id IS NOT NULL").groupBy("component_id").agg(F.min(best).alias("best"))
    judged = found.join(first, "component_id")
    same = [F.col(f"best.{name}") == F.col(name) for name in ROW_KEY]
    gone = judged.filter(~(same[0] & same[1])).select(*ROW_KEY)
    return without_row_key(keyed.join(gone, ROW_KEY, "left_anti")).select(*(f"`{c}`" for c in docs.columns))
