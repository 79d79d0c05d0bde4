"""What the operators of this package share: row keys, words, word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.session import write_through

ROW_KEY = ["_row_file", "_row_index"]


_OWN = {"row_key": True}


def with_row_key(df: DataFrame) -> DataFrame:
    """Add a key that tells rows apart even where they are equal: file and position in it.

    Both survive a repeated task. Only what ``as_scan`` takes as it is has one row for each place in a file; every
    other frame is written to the shared folder first. A frame that this function gave its key keeps it. The caller's
    columns of the key's names step aside (``without_row_key`` gives them their names back).
    """
    if all(name in df.columns and df.schema[name].metadata.get("row_key") for name in ROW_KEY):
        return df
    scan = as_scan(df)
    place = scan.metadataColumn("_metadata")
    keyed = scan.select(
        *(F.col(f"`{c}`").alias(_aside(c) if c in ROW_KEY else c) for c in scan.columns),
        F.xxhash64(place["file_path"]).alias(ROW_KEY[0], metadata=_OWN),
        place["row_index"].alias(ROW_KEY[1], metadata=_OWN),
    )
    return keyed


def _aside(name: str) -> str:
    return f"{name}_of_caller"


def without_row_key(keyed: DataFrame) -> DataFrame:
    """The frame as the caller gave it."""
    return keyed.drop(*ROW_KEY).withColumnsRenamed({_aside(name): name for name in ROW_KEY})


def as_scan(df: DataFrame) -> DataFrame:
    """``df`` itself if it only reads files, chooses columns and filters, so that every reading deals its rows out
    alike; else what it holds, written to the shared folder."""
    open_nodes, plain = [df._jdf.queryExecution().analyzed()], True
    while open_nodes and plain:
        node = open_nodes.pop()
        plain = node.nodeName() in ("LogicalRelation", "Project", "Filter", "SubqueryAlias", "View") and node.deterministic()
        open_nodes += [node.children().apply(i) for i in range(node.children().size())]
    return df if plain and df.inputFiles() else write_through(df, "rows")


def as_bytes(text: str | Column) -> Column:
    """UTF-8 of a text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


class WordHashes(dict):
    """64-bit hash of a word, remembered for up to ``most`` words."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * _MIX
    return values ^ (values >> np.uint64(29))


def ngram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes, in order; empty if there are fewer."""
    count = len(hashes) - size + 1
    if count <= 0:
        return hashes[:0]
    out = hashes[:count].copy()
    for step in range(1, size):
        out = mixed(out) * _ODD + hashes[step : step + count]
    return mixed(out)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.frombuffer(bytes(range(256)).lower(), "u1")
LONG = 256  # bytes of a word above which it is hashed by itself
_PLACES = mixed(mixed(np.arange(1, 256 * LONG + 1, dtype=np.uint64) * _ODD) + _ODD)  # a number for each byte at each place
_PART = 1 << 16  # words that are hashed at a time


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows whose texts in ``column`` have about ``most`` bytes, or one row."""
    for batch in batches:
        edges, _ = joined_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(edges, edges[at] + most)))
            yield batch.slice(at, stop - at)
            at = stop


def joined_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Where every text begins, and the last ends, in the bytes of all."""
    texts = texts.cast(pa.large_binary())
    if not len(texts):
        return np.zeros(1, np.int64), np.empty(0, "u1")
    _, edges, data = texts.buffers()
    edges = np.frombuffer(edges, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, "u1") if data is not None and data.size else np.empty(0, "u1")
    return edges - edges[0], data[edges[0] : edges[-1]]


def word_codes(texts: pa.Array, lower: bool = False) -> tuple[np.ndarray, ...]:
    """64-bit hashes of the words of all texts, one after the other; how many each text has; where each word begins and
    ends in the bytes of all texts; these bytes. ``lower``: ASCII letters count as lower case."""
    edges, data = joined_bytes(texts)
    if lower:
        data = _LOWER[data]
    word = np.concatenate([[False], ~_SPACE[data], [False]])
    inner = edges[1:-1]  # a text ends a word
    starts, ends = word[1:-1] & ~word[:-2], word[1:-1] & ~word[2:]
    inner = inner[(inner > 0) & (inner < len(data))]
    starts[inner] = word[1:-1][inner]
    ends[inner - 1] = word[1:-1][inner - 1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    counts = np.diff(np.searchsorted(begin, edges))
    return span_codes(data, begin, end), counts, begin, end, data


def span_codes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans, none of them empty, of ``data``."""
    codes = np.empty(len(begin), np.uint64)
    for at in range(0, len(begin), _PART):
        codes[at : at + _PART] = _codes(data, begin[at : at + _PART], end[at : at + _PART])
    return codes


def _codes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    lengths = np.minimum(end - begin, LONG)
    first = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(first, lengths)
    found = np.add.reduceat(_PLACES[place * 256 + data[np.repeat(begin, lengths) + place]], first)
    for at in np.flatnonzero(end - begin > LONG):
        found[at] = xxhash.xxh3_64_intdigest(data[begin[at] : end[at]].tobytes())
    return mixed(mixed(found) * _ODD)
