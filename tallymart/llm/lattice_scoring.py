"""Language-model scores as the likelihood of a subword lattice.

The words of a text, ASCII letters in lower case, and one end are its tokens. The existing vocabulary gives
every piece a log score; a forward recursion in log space over all segmentations of a word (with a mark in
front) returns its marginal probability. No piece crosses a word, so the probability of a document is the
product over its words. Beside the pieces, a word of the training texts is an edge of its own:

    P(word) = (1 - m) * count / N + m * sum over segmentations of the product of piece probabilities

with m, the mass of words never seen, as the share of the words seen once (Good-Turing).

Counts come from all training texts; the lattice probability is worked out once for every different word. Frequent words (at most ``frequent``, each of at most 64 bytes) go to
every task; all other words of a document are joined with the counts, so nothing that grows is broadcast.

Defined results: null counts as empty; an empty text has the end as its only token; equal rows are scored each for itself;
without training texts every base probability is 1 / (0 + 1) and only the lattice counts.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.pieces import MARK_BYTES, Edges, read_vocabulary
from tallymart.llm.rows import ROW_KEY, as_bytes, with_row_key
from tallymart.session import write_through

END = b"\n"  # no word can contain it
LONGEST = 64


class Lattice:
    """Natural log of the marginal probability of a word; the cache keeps its short words when it holds ``most``."""

    def __init__(self, edges: Edges, most: int = 400_000):
        self.edges, self.most, self.known = edges, most, {}

    def __call__(self, word: bytes) -> float:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > self.most:
                self.known = {w: p for w, p in self.known.items() if len(w) <= 6}
            found = self.known[word] = self.forward(MARK_BYTES + word)
        return found

    def forward(self, data: bytes) -> float:
        """log alpha(end), where alpha(j) = sum over edges (i, j) of alpha(i) * p(edge)."""
        coming: list[list[float]] = [[] for _ in range(len(data) + 1)]
        coming[0].append(0.0)
        for start in range(len(data)):
            terms = coming[start]
            if not terms:
                continue
            alpha = _log_sum(terms)
            coming[start] = []
            for end, _, score in self.edges.at(data, start):
                coming[end].append(alpha + score)
        return _log_sum(coming[-1])


def _log_sum(terms: list[float]) -> float:
    top = max(terms)
    return top if len(terms) == 1 else top + math.log(sum([math.exp(t - top) for t in terms]))


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    """One for each worker process."""
    return Lattice(Edges(read_vocabulary(path)))


def token_counts(texts: DataFrame, flush: int = 1_000_000) -> DataFrame:
    """``word``, ``count`` over the rows of ``data`` with ``learned``; words of other rows only have the count 0.
    Combined in every task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(counts: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
            )

        counts: Counter = Counter()
        for batch in batches:
            for value, learned in zip(batch.column(0), batch.column(1).to_pylist()):
                tokens = value.as_py().lower().split()
                counts.update(tokens if learned else dict.fromkeys(tokens, 0))
                counts[END] += bool(learned)
            if len(counts) >= flush:
                yield out(counts)
                counts = Counter()
        yield out(counts)

    counted = texts.select("data", "learned").mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("count"))


def with_marginals(words: DataFrame, model: str) -> DataFrame:
    """``word``, ``count``, ``marginal``: the log10 of the lattice probability, worked out once for every different word."""
    ten = math.log(10)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marginal_of = lattice(model)
        for batch in batches:
            found = [0.0 if w == END else marginal_of.forward(MARK_BYTES + w) / ten for w in batch.column(0).to_pylist()]
            yield batch.append_column("marginal", pa.array(found, pa.float64()))

    return words.mapInArrow(run, "word binary, count long, marginal double")


def _frequent(words: DataFrame, most: int) -> dict[bytes, tuple[int, float]]:
    """Count and marginal of the most frequent words, as many whole count classes as fit in ``most`` rows."""
    short = words.filter((F.length("word") <= LONGEST) & (F.col("count") > 0))
    classes = short.groupBy(F.floor(F.log2("count") * 8).alias("class")).count().orderBy(F.desc("class")).collect()
    total, least = 0, None
    for row in classes:
        total += row["count"]
        if total > most:
            break
        least = row["class"]
    if least is None:
        return {}
    table = short.filter(F.floor(F.log2("count") * 8) >= least).toArrow()
    values = zip(table.column("count").to_pylist(), table.column("marginal").to_pylist())
    return dict(zip(table.column("word").to_pylist(), values))


def lattice_scores(
    docs: DataFrame,
    learned: Column,
    model: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = 200_000,
) -> DataFrame:
    """One row per document: row key, ``id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score`` and ``subword_score`` (the pieces alone), all log10. ``learned``: which rows to learn from."""
    keyed = with_row_key(docs)
    data = as_bytes(text_col).alias("data")
    counts = token_counts(docs.select(data, learned.alias("learned")))
    words = write_through(with_marginals(counts, model), "counts")
    total, kinds, once = words.agg(
        F.coalesce(F.sum("count"), F.lit(0)),
        F.count(F.when(F.col("count") > 0, 1)),
        F.count(F.when(F.col("count") == 1, 1)),
    ).first()
    base = math.log10(total + kinds + 1)
    unseen = min(0.5, (once + 1) / (total + 1)) if total else 1.0
    top = _frequent(words, frequent)
    log_unseen = math.log10(unseen)

    def token(count: int, marginal: float) -> float:
        """log10 probability of a token by its training count and the log10 of its lattice probability."""
        seen = math.log10((1 - unseen) * count / total)
        low, high = sorted((seen, log_unseen + marginal))
        return high + math.log10(1 + 10 ** (low - high))

    id_kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"{ROW_KEY[0]} long, {ROW_KEY[1]} long, id {id_kind}, n_tokens long, known long, plain double, full double,"
        " sub double, rest array<struct<word:binary,n:int>>"
    )
    rest_type = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))
    ended = top.get(END, (0, 0.0))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[bytes, tuple[float, float]] = {}
        for batch in batches:
            columns: list[list] = [[] for _ in range(6)]
            for value in batch.column(3):
                tokens = value.as_py().lower().split()
                known, plain, sub, rest = 1 if ended else 0, math.log10(ended + 1), 0.0, []
                full = math.log10((1 - unseen) * ended / total) if ended else log_unseen
                for word, n in Counter(tokens).items():
                    value = kept.get(word)
                    if value is None:
                        if word not in top:
                            rest.append({"word": word, "n": n})
                            continue
                        count, marginal = top[word]
                        value = kept[word] = (math.log10(count + 1), token(count, marginal), marginal)
                    known += n
                    plain += n * value[0]
                    full += n * value[1]
                    sub += n * value[2]
                for column, x in zip(columns, (len(tokens) + 1, known, plain, full, sub, rest)):
                    column.append(x)
            kinds_ = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), rest_type)
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds_)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], *arrays],
                names=[*ROW_KEY, "id", "n_tokens", "known", "plain", "full", "sub", "rest"],
            )

    rows = keyed.select(*ROW_KEY, F.col(id_col).alias("id"), data).mapInArrow(run, schema)
    rows = write_through(rows, "scores")
    rest = rows.select(*ROW_KEY, F.inline("rest")).join(words, "word", "left")
    count, n = F.coalesce("count", F.lit(0)), F.col("n")
    lattice_part = F.lit(log_unseen) + F.col("marginal")
    seen = F.log10(F.lit(1 - unseen) * count / F.lit(max(total, 1)))
    high, low = F.greatest(seen, lattice_part), F.least(seen, lattice_part)
    both = F.when(count == 0, lattice_part).otherwise(high + F.log10(1 + F.pow(F.lit(10.0), low - high)))
    more = rest.groupBy(*ROW_KEY).agg(
        F.sum(F.when(count > 0, n).otherwise(0)).alias("more_known"),
        F.sum(n * F.log10(count + 1.0)).alias("more_plain"),
        F.sum(n * both).alias("more_full"),
        F.sum(n * F.col("marginal")).alias("more_sub"),
    )
    out = rows.drop("rest").join(more, ROW_KEY, "left")
    zero = F.lit(0)
    return out.select(
        *ROW_KEY,
        "id",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", zero)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("plain") + F.coalesce("more_plain", zero) - F.col("n_tokens") * base).alias("base_score"),
        (F.col("full") + F.coalesce("more_full", zero)).alias("score"),
        (F.col("sub") + F.coalesce("more_sub", zero)).alias("subword_score"),
    )
