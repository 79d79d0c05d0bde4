"""Best-fit packing of tokenised documents into sequences under several capacities.

Documents are encoded, closed with an end id and, only where longer than a sequence, cut from the end
into full pieces; the first piece takes the rest. Pieces are dealt into groups of about
``group_rows``; inside a group they are placed largest first. A bin's residual is a vector (tokens, documents,
attention cost = sum of squared lengths); of the bins that can take the piece in every coordinate the
one with the smallest weighted residual norm, or the largest weighted dot-product of piece and
residual, gets it. Groups are packed on their own: each can leave one bin part-filled, one in thousands.

Defined results: null text counts as empty and gives one piece that holds the end id only; equal rows
are packed each for itself; a piece too costly for an empty bin in some coordinate raises an error.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.session import write_through

# Cutting before a space that a non-space follows never cuts a token of the byte-level pattern.
CUT = re.compile(r" (?=\S)")
SPACE = "\u0120"  # how byte-level vocabularies write a space
PIECES = "piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Capacity:
    """What one sequence may hold, and how coordinates weigh in the choice of a bin."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    weights: tuple[float, float, float] = (1.0, 0.001, 0.001)
    rule: str = "norm"


class Encoder:
    """Ids of a text as little-endian bytes. A part after a space is looked up in a cache that keeps its
    short parts, which are the frequent ones, when it holds ``most`` parts."""

    def __init__(self, path: str, most: int = 800_000):
        # Spark runs a worker on every core already; a second pool of threads costs more than it gives
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.most, self.known = Tokenizer.from_file(path), most, {}
        words = self.tokenizer.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(words.values(), default=-1) + 1, bool)  # ids of tokens that begin with a space
        self.spaced[[i for word, i in words.items() if word.startswith((SPACE, " "))]] = True
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4").tobytes() for one in found]

    def _parts(self, parts: list[str]) -> list[bytes]:
        """Ids of every part after a space. They are encoded as one text and told apart by the tokens that begin with a
        space; where that does not give one for each part, or an added token is near, each part is encoded by itself."""
        text = " " + " ".join(parts)
        if not any(token in text for token in self.added):
            ids = np.array(self._one(text), np.int64)
            starts = np.flatnonzero(self.spaced[ids])
            if len(starts) == len(parts) and starts[0] == 0:
                data, edges = ids.astype("<u4").tobytes(), (4 * starts).tolist()
                return [data[a:b] for a, b in zip(edges, [*edges[1:], len(data)])]
        return self._ids([" " + part for part in parts])

    def _one(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encode(self, texts: list[str]) -> list[bytes]:
        known = self.known
        if len(known) > self.most:
            self.known = known = {part: ids for part, ids in known.items() if len(part) <= 6}
        cut = [text.split(" ") for text in texts]
        later = [parts[1:] for parts in cut]
        new = list(set().union(*later).difference(known))
        odd = {part for part in new if not part or part[0].isspace()}
        if odd:  # a space before white space is no place to cut
            cut = [CUT.split(text) if odd.intersection(parts[1:]) else parts for text, parts in zip(texts, cut)]
            later = [parts[1:] for parts in cut]
            new = list(set().union(*later).difference(known))
        for at in range(0, len(new), 1_000):
            block = new[at : at + 1_000]
            known.update(zip(block, self._parts(block)))
        firsts = self._ids([parts[0] for parts in cut])
        return [first + b"".join(map(known.__getitem__, parts)) for first, parts in zip(firsts, later)]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each worker process, so that later tasks find its cache filled."""
    return Encoder(path)


def pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokens: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: the id, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``."""
    kind = docs.schema[id_col].dataType.simpleString()
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded = encoder(tokenizer)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows: list[tuple] = []
                for row, data in enumerate(coded.encode(batch.column(1).to_pylist())):
                    data += end
                    total = len(data) // 4
                    edges = [0, *range(total % tokens or tokens, total + 1, tokens)]
                    for piece, (start, stop) in enumerate(zip(edges, edges[1:])):
                        part = data[4 * start : 4 * stop]
                        rows.append((row, piece, start, stop - start, zlib.crc32(part), part))
                columns = list(zip(*rows))
                arrays = [
                    batch.column(0).take(pa.array(columns[0], pa.int64())),
                    pa.array(columns[1], pa.int32()),
                    *(pa.array(column, pa.int64()) for column in columns[2:5]),
                ]
                if with_ids:
                    arrays.append(pa.array([np.frombuffer(part, "<u4").astype(np.int32) for part in columns[5]]))
                names = ["id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return source.mapInArrow(cut, f"id {kind}, {PIECES}" + ", ids array<int>" * with_ids)


def best_fit(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every piece, for one group."""
    full = np.array([capacity.tokens, capacity.documents, capacity.attention], np.float64)
    weights = np.array(capacity.weights, np.float64)
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rest = np.empty((3, len(lengths) + 1))
    name = np.empty(len(lengths) + 1, np.int64)
    n_open = n_bins = 0
    smallest = int(lengths.min(initial=capacity.tokens))
    for count, at in enumerate(order):
        size = float(lengths[at])
        need = np.array([size, 1.0, size * size])
        if (need > full).any():
            raise ValueError(f"a piece of {size:.0f} tokens is larger than a sequence")
        if count % 512 == 0:  # bins that no later piece fits into are closed
            live = (rest[0, :n_open] >= smallest) & (rest[1, :n_open] >= 1)
            rest[:, : live.sum()] = rest[:, :n_open][:, live]
            name[: live.sum()] = name[:n_open][live]
            n_open = int(live.sum())
        view = rest[:, :n_open]
        fits = np.flatnonzero((view[0] >= size) & (view[1] >= 1) & (view[2] >= need[2]))
        if not len(fits):
            slot = n_open
            rest[:, slot] = full
            name[slot] = n_bins
            n_open, n_bins = n_open + 1, n_bins + 1
        else:
            seen = view[:, fits]
            if capacity.rule == "dot":
                score = -(weights * need / full / full) @ seen
            else:
                score = weights @ ((seen - need[:, None]) / full[:, None]) ** 2
            slot = int(fits[np.argmin(score)])
        bins[at] = name[slot]
        offsets[at] = capacity.tokens - rest[0, slot]
        rest[:, slot] -= need
        if rest[0, slot] < smallest or rest[1, slot] < 1:  # closed: the last open bin takes its place
            n_open -= 1
            rest[:, slot], name[slot] = rest[:, n_open], name[n_open]
    return bins, offsets


def pack(parts: DataFrame, capacity: Capacity = Capacity(), group_rows: int = 10_000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows that have a ``length`` up to ``capacity.tokens``."""
    fixed = write_through(parts, "pieces")
    groups = max(1, -(-fixed.count() // group_rows))
    place_of, key = fixed.metadataColumn("_metadata"), "_group"
    while key in parts.columns:  # the caller may have a column of that name
        key += "_"
    dealt = fixed.select("*", F.pmod(F.xxhash64(place_of["file_path"], place_of["row_index"]), F.lit(groups)).cast("long").alias(key))
    names = parts.columns

    def place(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy().astype(np.int64)
        bins, offsets = best_fit(lengths, capacity)
        group = table.column(key)[0].as_py()
        out = table.select(names)
        out = out.append_column("sequence_id", pa.array((group << 32) + bins, pa.int64()))
        return out.append_column("offset", pa.array(offsets, pa.int64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return dealt.groupBy(key).applyInArrow(place, f"{schema}, sequence_id long, offset long")
