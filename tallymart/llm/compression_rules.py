"""Quality rules: word and line counts, and zstandard compression bands.

The ratio (compressed bytes over bytes) of a whole document and of every fixed chunk of it must lie in
the band for its length. Below the band a text repeats itself, above it the text is
close to random. Short texts have wide bands, because the frame header weighs more there.

Defined results: null and empty texts have no words, all counts are 0 and they fail the base rule.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.rows import as_bytes

WHITESPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean,"
    " ratio double, bad_chunks long, n_chunks long, in_band boolean, kept boolean"
)


@dataclass(frozen=True)
class Bands:
    """Limits of the compression ratio by length, and how chunks are judged.

    ``limits``: (bytes from, lowest ratio, highest ratio), ascending. ``chunk``: bytes of a chunk; a rest of
    under half a chunk is judged with the one before it. ``bad_share``: a text fails if more than this share of its chunks is
    out of band.
    """

    limits: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 3.0),
        (128, 0.30, 1.10),
        (256, 0.25, 0.90),
        (512, 0.22, 0.80),
        (1024, 0.18, 0.72),
        (4096, 0.15, 0.66),
        (16384, 0.12, 0.62),
        (65536, 0.10, 0.60),
    )
    chunk: int = 4096
    bad_share: float = 0.5
    level: int = 3

    def holds(self, size: int, ratio: float) -> bool:
        low, high = next((a, b) for start, a, b in reversed(self.limits) if size >= start)
        return low <= ratio <= high


def repeated_words(words: list[bytes], size: int = 5) -> int:
    """Words inside a window of ``size`` words that is found twice or more in the list."""
    count = len(words) - size + 1
    if count < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    kinds = len(numbers)
    codes = ids[:count].copy()
    for step in range(1, size):
        if kinds > 2**62 // max(1, len(numbers)):  # number the codes densely before they leave 64 bits
            codes = np.unique(codes, return_inverse=True)[1]
            kinds = int(codes.max()) + 1
        codes = codes * len(numbers) + ids[step : step + count]
        kinds *= len(numbers)
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(count, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def judged(data: bytes, bands: Bands, press: zstandard.ZstdCompressor) -> tuple:
    """The fields of ``RESULT`` for one text."""
    words = data.split()
    n = len(words)
    points = len(data) - np.count_nonzero((np.frombuffer(data, np.uint8) & 0xC0) == 0x80)
    word_chars = int(points - (len(data) - len(data.translate(None, WHITESPACE))))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip(WHITESPACE)]
    repeats = repeated_words(words)
    failed = n < 10 or 100 * repeats > 20 * n
    ratio, bad, parts = None, 0, 0
    fits = bool(data)
    if data:
        ratio = len(press.compress(data)) / len(data)
        parts = max(1, (len(data) + bands.chunk // 2) // bands.chunk)
        for part in range(parts):
            piece = data[part * bands.chunk : len(data) if part + 1 == parts else (part + 1) * bands.chunk]
            bad += not bands.holds(len(piece), len(press.compress(piece)) / len(piece))
        fits = bands.holds(len(data), ratio) and bad <= bands.bad_share * parts
    return (
        n, word_chars, symbols, len(lines) - len(set(lines)), repeats, failed,
        ratio, bad, parts, fits, fits and not failed,
    )


def quality(text: str | Column, bands: Bands = Bands()) -> Column:
    """A struct of counts, compression figures and verdict for every text."""

    @F.arrow_udf(RESULT)
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        press = zstandard.ZstdCompressor(level=bands.level)
        names = [field.split()[0] for field in RESULT.split(", ")]
        kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        types = [kinds[field.split()[1]] for field in RESULT.split(", ")]
        for batch in batches:
            rows = [judged(value.as_py(), bands, press) for value in batch]
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.StructArray.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, types)], names
            )

    return judge.asNondeterministic()(as_bytes(text))


def keep_good(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """The rows whose text passes, with all their columns."""
    marked = docs.select(F.struct("*").alias("row"), quality(text_col, bands).alias("verdict"))
    return marked.filter("verdict.kept").select("row.*")
