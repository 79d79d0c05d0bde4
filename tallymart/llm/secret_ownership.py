"""Secret scan with corpus-wide ownership frequency, in DataFrame expressions only.

Every kind of candidate is a pattern. Candidate values are hashed and counted over the whole corpus: in how many
repositories (documents) and with how many owners (sources) they occur. A value that many owners
share is a copied example; a value that belongs to few is a live-looking credential. The strict kinds
are reported in either case, the loose kinds only while they look live.

Defined results: null text counts as empty; equal rows count as several documents; a null owner is an owner of its own;
an empty table gives no rows. Positions count code points, the end is exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymart.llm.rows import ROW_KEY, with_row_key, without_row_key
from tallymart.session import write_through


@dataclass(frozen=True)
class Kind:
    """``value``: the group that holds the secret. ``least``: its fewest characters. ``hints``: a text without
    any of these (in lower case) has no match. ``classes``: patterns that the value must contain."""

    name: str
    pattern: str
    value: int = 0
    least: int = 1
    hints: tuple[str, ...] = ()
    classes: tuple[str, ...] = ()


# fixed values: the patterns of the strict kinds
STRICT = (
    Kind(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        value=2,
        least=6,
        hints=("passw", "secret", "token", "apikey", "api_key"),
    ),
    Kind("access", r"AKIA[A-Z0-9]+", least=20, hints=("akia",)),
    Kind("hex", r"[0-9a-f]{24,}"),
)
# reported while they look live
LOOSE = (
    Kind("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=("eyj",)),
    Kind("prefixed", r"(?:gh[pousr]_|xox[abprs]-|[rs]k_live_)[A-Za-z0-9-]{16,}", hints=("gh", "xox", "k_live_")),
    Kind("bearer", r"[Bb]earer\x20+([A-Za-z0-9+/_.=-]{16,})", value=1, hints=("bearer",)),
    Kind("mixed", r"[A-Za-z0-9+/_-]{32,}={0,2}", classes=("[a-z]", "[A-Z]", "[0-9]")),
)
SPAN = "array<struct<start:int,rank:int,stop:int,kind:string,value:string>>"


def spans_of(text: Column, kind: Kind, rank: int) -> Column:
    """All matches of one kind, leftmost and without overlap, that pass its limits."""
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    gaps = F.slice(F.split(text, kind.pattern, -1), 1, F.size(matches))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("found"))

    def step(state: Column, pair: Column) -> Column:
        match = pair["match"]
        begin = state["at"] + F.length(pair["gap"])
        end = begin + F.length(match)
        value = F.regexp_extract(match, kind.pattern, kind.value)
        span = F.struct(
            begin.alias("start"), F.lit(rank).alias("rank"), end.alias("stop"), F.lit(kind.name).alias("kind"),
            value.alias("value"),
        )
        fits = F.length(value) >= kind.least
        for needed in kind.classes:
            fits = fits & value.rlike(needed)
        found = F.when(fits, F.concat(state["found"], F.array(span))).otherwise(state["found"])
        return F.struct(end.alias("at"), found.cast(SPAN).alias("found"))

    pairs = F.zip_with(gaps, matches, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
    found = F.aggregate(pairs, start, step, lambda state: state["found"])
    lower = F.lower(text)
    maybe = F.lit(not kind.hints)
    for hint in kind.hints:
        maybe = maybe | F.contains(lower, F.lit(hint))
    if not kind.hints:
        maybe = text.rlike(kind.pattern)
    return F.when(maybe, found).otherwise(F.array().cast(SPAN))


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    copied_owners: int = 3,
    copied_documents: int = 4,
) -> DataFrame:
    """One row per document: row key, ``id`` and ``spans`` sorted by start and kind, each with ``kind``, ``start``,
    ``stop``, ``strict``, ``documents``, ``owners`` and ``live``.

    A value is a copied example if at least ``copied_owners`` owners and ``copied_documents`` documents have it.
    """
    keyed = with_row_key(docs).select(*ROW_KEY, id_col, text_col, owner_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = [spans_of(text, kind, rank) for rank, kind in enumerate(STRICT + LOOSE)]
    rows = keyed.select(
        *ROW_KEY, F.col(id_col).alias("id"), F.col(owner_col).alias("owner"), F.array_sort(F.concat(*parts)).alias("all")
    )
    rows = write_through(rows, "candidates")
    named = rows.filter("size(all) > 0")
    hashes = F.transform("all.value", lambda value: F.sha2(value, 256))
    used = named.select("owner", F.explode(F.array_distinct(hashes)).alias("hash"))
    by_owner = used.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("documents"))
    counts = by_owner.groupBy("hash").agg(F.sum("documents").alias("documents"), F.count(F.lit(1)).alias("owners"))
    each = named.select(*ROW_KEY, F.explode("all").alias("span")).withColumn("hash", F.sha2("span.value", 256))
    copied = (F.col("owners") >= copied_owners) & (F.col("documents") >= copied_documents)
    strict = F.col("span.rank") < len(STRICT)
    told = each.join(counts, "hash").filter(strict | ~copied)
    span = F.struct(
        "span.start", "span.rank", "span.stop", "span.kind", strict.alias("strict"), "documents", "owners",
        (~copied).alias("live"),
    )
    spans = told.groupBy(*ROW_KEY).agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return rows.select(*ROW_KEY, "id").join(spans, ROW_KEY, "left")


def joined(spans: Column) -> Column:
    """kind:start:stop, joined by commas; empty without spans."""
    words = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"]))
    return F.coalesce(F.array_join(words, ","), F.lit(""))


def redacted(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    mark: str = "[SECRET]",
) -> DataFrame:
    """``docs`` with every live-looking span replaced by ``mark``; copied examples and all other text stay."""
    keyed = with_row_key(docs)
    found = "_spans"
    while found in keyed.columns:  # the caller may have a column of that name
        found += "_"
    live = scan(keyed, id_col, text_col, owner_col).select(
        *ROW_KEY, F.filter("spans", lambda s: s["live"]).alias(found)
    )
    live = live.filter(F.size(found) > 0)
    text = F.col(text_col)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, span["start"] - state["at"])
        fresh = span["start"] >= state["at"]
        out = F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], span["stop"]).alias("at"), out.alias("out"))

    cut = F.aggregate(
        found, start, step, lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text)))
    )
    both = keyed.join(live, ROW_KEY, "left")
    changed = both.withColumn(text_col, F.when(F.col(found).isNull(), text).otherwise(cut))
    return without_row_key(changed).select(*(f"`{c}`" for c in docs.columns))
