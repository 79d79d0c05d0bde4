"""Substring duplicates by FM-indexes over shards of the corpus.

A window is ``size`` consecutive words of one document; a document loses every word that lies in a window whose
word sequence also starts in a document with a smaller id.

Which shard a window belongs to depends on its words alone: on the smallest hash of the runs of ``seed`` words
in it. So equal windows meet in one shard, and neighbouring windows mostly stay together as one
segment. Seeds that occur in one document only cannot lie in a shared window, hence only segments
around shared seeds are indexed.

1. Seeds of every document, with the smallest and largest id they occur in (combined before the shuffle).
2. Segments around shared seeds, each under a hash of its words; the words themselves travel once for each different
   segment of a task. Equal segments are one row with their smallest id.
3. Every shard builds the Burrows-Wheeler transform of its segments as a wavelet matrix over word ranks and streams the
   segments against it: a backward search of ``size`` steps at every place (all places at a time) gives the matching
   statistics up to the threshold; the smallest id over the interval found is that of the window.
4. The windows' smallest ids go back to the documents that hold the segment.

A seed of very many different segments is cut into single windows, which are dealt out by all their words.

Defined results: null and empty texts have no words and lose none; a document with a null id neither removes nor loses words;
rows with equal ids do not remove each other's words; documents with fewer words than a window stay whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.llm.rows import ROW_KEY, as_bytes, mixed, ngram_hashes, slices, with_row_key, word_codes
from tallymart.session import write_through

HOT = 2000  # documents with one seed above which its segments are cut into windows
SEEN = 1_000_000  # segments that a task remembers to have written the words of
_STEP = np.uint64(0xD6E8FEB86659FD93)


def window_seeds(hashes: np.ndarray, size: int, seed: int) -> np.ndarray:
    """For every window the smallest hash of its runs of ``seed`` words."""
    runs = ngram_hashes(hashes, seed)
    count = len(hashes) - size + 1
    if count <= 0:
        return runs[:0]
    least = runs[:count].copy()
    for step in range(1, size - seed + 1):
        np.minimum(least, runs[step : step + count], out=least)
    return least


class WaveletMatrix:
    """Rank of a symbol in a prefix of a sequence of numbers under ``2 ** levels``."""

    def __init__(self, values: np.ndarray, levels: int):
        self.levels, self.ones, self.zeros = levels, [], []
        symbols = np.arange(1 << levels)
        self.begin = np.zeros(1 << levels, np.int32)  # where the symbol's run starts below the last level
        for level in reversed(range(levels)):
            bit = (values >> level) & 1
            ones = np.concatenate([[0], np.cumsum(bit, dtype=np.int32)]).astype(np.int32)
            zeros = np.int32(len(values) - int(ones[-1]))
            before = ones[self.begin]
            self.begin = np.where((symbols >> level) & 1, zeros + before, self.begin - before)
            self.ones.append(ones)
            self.zeros.append(zeros)
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each symbol occurs before ``low`` and before ``high``."""
        for step, level in enumerate(reversed(range(self.levels))):
            ones, zeros = self.ones[step], self.zeros[step]
            bit = ((symbols >> level) & 1).astype(bool)
            l, h = ones[low], ones[high]
            low = np.where(bit, zeros + l, low - l)
            high = np.where(bit, zeros + h, high - h)
        begin = self.begin[symbols]
        return low - begin, high - begin


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols or more, by doubling."""
    rank = text.astype(np.int64)
    done = 1
    order = np.argsort(rank, kind="stable") if depth == 1 else rank
    while done < depth:
        after = np.zeros(len(rank), np.int64)
        after[: len(rank) - done] = rank[done:] + 1
        pair = rank * (int(after.max()) + 1) + after
        order = np.argsort(pair)
        ranked = pair[order]
        rank = np.empty(len(pair), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        done *= 2
    return order


def smallest_owners(segments: list[np.ndarray], owners: np.ndarray, size: int) -> list[np.ndarray]:
    """For every window of every segment the smallest owner of a segment that contains it."""
    lengths = np.array([len(s) for s in segments])
    return np.split(owners_of_windows(np.concatenate(segments), lengths, owners, size), np.cumsum(lengths - size + 1)[:-1])


def owners_of_windows(codes: np.ndarray, lengths: np.ndarray, owners: np.ndarray, size: int) -> np.ndarray:
    """The same for segments and results one after the other."""
    words, ranks = np.unique(codes, return_inverse=True)
    text = np.zeros(lengths.sum() + len(lengths), np.int64)  # 0 ends a segment
    starts = np.cumsum(lengths + 1) - lengths - 1
    inside = np.ones(len(text), bool)
    inside[starts + lengths] = False
    text[inside] = ranks + 1
    owner = np.repeat(owners, lengths + 1)
    order = suffix_order(text, size)
    levels = max(1, int(len(words)).bit_length())
    matrix = WaveletMatrix(text[order - 1], levels)
    before = np.searchsorted(np.sort(text), np.arange(len(words) + 2))
    places = _runs(starts, lengths - size + 1)
    before = before.astype(np.int32)
    least, open_ = owner[places], np.arange(len(places))
    last = text[places + size - 1]
    low, high = before[last], before[last + 1]
    for step in reversed(range(size - 1)):
        more = high - low > 1  # what occurs once occurs at its own place only
        open_, low, high = open_[more], low[more], high[more]
        symbols = text[places[open_] + step]
        under, upto = matrix.rank(symbols, low, high)
        low, high = before[symbols] + under, before[symbols] + upto
    if len(open_):  # windows of one length have equal or disjoint intervals
        first, one, which = np.unique(low, return_index=True, return_inverse=True)
        edges = np.stack([first, high[one]], axis=1).ravel()
        owned = np.append(owner[order], owner.max())
        least[open_] = np.minimum.reduceat(owned, edges)[::2][which]
    return least


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``start``, ``start + 1``, ... of every run, one after the other."""
    return np.repeat(starts - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())


def _windows(counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Among the words of texts with ``counts`` words: where each text starts; the text and the place of every window."""
    starts, held = np.cumsum(counts) - counts, np.maximum(counts - size + 1, 0)
    return starts, np.repeat(np.arange(len(counts)), held), _runs(starts, held)


def _new(*columns: np.ndarray) -> np.ndarray:
    """Where a row differs from the one before."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.logical_or.reduce([column[1:] != column[:-1] for column in columns])
    return new


def _seeds(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """The distinct seeds of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 3):
            codes, counts, *_ = word_codes(batch.column(3))
            _, row, place = _windows(counts, size)
            own = window_seeds(codes, size, seed)[place]
            first = _new(row, own)
            row, own = row[first], own[first]
            order = np.lexsort((own, row))
            row, own = row[order], own[order]
            first = _new(row, own)
            rows = pa.array(row[first])
            arrays = [*(batch.column(i).take(rows) for i in range(3)), pa.array(own[first].astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*ROW_KEY, "id", "seed"])

    return docs.mapInArrow(run, f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, id long, seed long")


def _segments(docs: DataFrame, size: int, seed: int) -> DataFrame:
    """Runs of windows with one shared seed, with a hash of their words and, at their first place in a task, the words;
    of a hot seed every window by itself, under a hash of all its words."""
    schema = f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, id long, start int, seed long, segment long, words binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple] = set()
        for batch in slices(batches, 3):
            codes, counts, opens, closes, text = word_codes(batch.column(3))
            starts, row, place = _windows(counts, size)
            text = text.tobytes()
            own = window_seeds(codes, size, seed)[place].astype(np.int64)
            marks = batch.column(4).flatten()  # a seed has the same mark in every document
            shared, one = np.unique(marks.field("seed").to_numpy(), return_index=True)
            hot = marks.field("hot").to_numpy(zero_copy_only=False)[one]
            first = np.flatnonzero(_new(row, own))
            count = np.diff(np.append(first, len(own)))
            at = np.searchsorted(shared, own[first])
            at[at == len(shared)] = 0
            known = shared[at] == own[first] if len(shared) else np.zeros(len(first), bool)
            first, count, at = first[known], count[known], at[known]
            cut = hot[at] if len(at) else np.zeros(0, bool)
            whole = ngram_hashes(codes, size)
            alone = _runs(first[cut], count[cut])
            name = np.concatenate([own[first[~cut]], whole[place[alone]].astype(np.int64)])
            first, count = np.concatenate([first[~cut], alone]), np.concatenate([count[~cut], np.ones(len(alone), np.int64)])
            order = np.argsort(first)
            first, count, name = first[order], count[order], name[order]
            step = _runs(np.zeros(len(first), np.int64), count).astype(np.uint64)
            parts = mixed(whole[place[_runs(first, count)]] + mixed((step + np.uint64(1)) * _STEP))
            ends = np.cumsum(count)
            segment = mixed(np.add.reduceat(parts, ends - count) if len(count) else parts).astype(np.int64)
            data: list[bytes | None] = []
            begin = place[first]
            spans = opens[begin].tolist(), closes[begin + count + size - 2].tolist()
            for both, a, b in zip(zip(name.tolist(), segment.tolist()), *spans):
                if both in seen:
                    data.append(None)
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(both)
                data.append(text[a:b])
            rows = pa.array(row[first])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i).take(rows) for i in range(3)),
                    pa.array((begin - starts[row[first]]).astype(np.int32)), pa.array(name), pa.array(segment),
                    pa.array(data, pa.binary()),
                ],
                names=[*ROW_KEY, "id", "start", "seed", "segment", "words"],
            )

    return docs.mapInArrow(run, schema)


def _order(rows: pa.Table) -> np.ndarray:
    return np.lexsort((rows.column("segment").to_numpy(), rows.column("seed").to_numpy()))


def repeated_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 13,
    seed: int = 7,
    shard_rows: int = 20_000,
) -> DataFrame:
    """One row per document: row key, ``id``, ``n_words``, ``n_removed``, ``kept`` (the words left, joined by spaces, as
    UTF-8) and ``kept_sha256``. ``shard_rows``: about how many different segments one index holds."""
    keyed = with_row_key(docs).select(*ROW_KEY, id_col, text_col)
    docs = keyed.select(*ROW_KEY, F.col(id_col).cast("long").alias("id"), as_bytes(text_col).alias("data"))
    seeds = write_through(_seeds(docs.filter("id IS NOT NULL"), size, seed), "seeds")
    shared = seeds.groupBy("seed").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count(F.lit(1)).alias("n"))
    shared = write_through(shared.filter("a < b").select("seed", (F.col("n") > HOT).alias("hot")), "shared")
    marks = seeds.drop("id").join(shared, "seed").groupBy(*ROW_KEY)
    marks = write_through(marks.agg(F.collect_list(F.struct("seed", "hot")).alias("marks")), "marks")
    marked = docs.join(marks, ROW_KEY).select(*ROW_KEY, "id", "data", "marks")
    held = write_through(_segments(marked, size, seed), "segments")
    texts = held.filter("words IS NOT NULL").select("seed", "segment", "words")
    shards = max(1, -(-texts.count() // shard_rows))
    shard = F.pmod(F.xxhash64("seed"), F.lit(shards)).cast("long").alias("shard")
    owners = held.groupBy("seed", "segment").agg(F.min("id").alias("owner")).select(shard, "*")

    def index(owned: pa.Table, written: pa.Table) -> pa.Table:
        owned = owned.take(_order(owned))
        order = _order(written)
        names = [written.column(name).to_numpy()[order] for name in ("seed", "segment")]
        words = written.column("words").take(order[_new(*names)])  # those of every owned segment, in its order
        codes, lengths, *_ = word_codes(words.combine_chunks())
        least = owners_of_windows(codes, lengths, owned.column("owner").to_numpy(), size)
        edges = np.concatenate([[0], np.cumsum(lengths - size + 1)]).astype(np.int32)
        return owned.select(["seed", "segment"]).append_column("least", pa.ListArray.from_arrays(edges, pa.array(least)))

    both = owners.groupBy("shard").cogroup(texts.select(shard, "*").groupBy("shard"))
    found = write_through(both.applyInArrow(index, "seed long, segment long, least array<long>"), "found")
    hits = held.drop("words").join(found, ["seed", "segment"]).select(
        *ROW_KEY, F.filter(F.transform("least", lambda x, i: F.when(x < F.col("id"), F.col("start") + i)), F.isnotnull).alias("hit")
    )
    hits = hits.filter("size(hit) > 0").groupBy(*ROW_KEY).agg(F.flatten(F.collect_list("hit")).alias("hits"))
    hits = write_through(hits, "hits")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, gone, kept = [], [], []
            for value, starts in zip(batch.column(3), batch.column(4)):
                words = value.as_py().split()
                edges = np.zeros(len(words) + 1, np.int64)
                at = np.array(starts.as_py() or [], np.int64)
                np.add.at(edges, at, 1)
                np.add.at(edges, at + size, -1)
                stays = np.cumsum(edges[:-1]) == 0
                counts.append(len(words))
                gone.append(int(len(words) - stays.sum()))
                kept.append(b" ".join(words if not len(at) else [w for w, s in zip(words, stays) if s]))
            digests = [hashlib.sha256(data).hexdigest() for data in kept]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts), pa.array(gone), pa.array(kept, pa.binary()), pa.array(digests)],
                names=[*ROW_KEY, "id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    schema = f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, id long, n_words long, n_removed long, kept binary, kept_sha256 string"
    both = docs.join(hits, ROW_KEY, "left").select(*ROW_KEY, "id", "data", "hits")
    return both.mapInArrow(cut, schema)
