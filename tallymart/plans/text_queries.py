"""Word statistics and polarity over the documents table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallymart.operators import text
from tallymart.operators.relational import category_share
from tallymart.plans.registry import query
from tallymart.session import scratch_path
from tallymart.sources import sinks, tables

TOKENS = r"""tk AS (SELECT doc_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS w FROM documents),
  lw AS (SELECT doc_id, lower(w) AS token FROM tk)"""
STOPS = ", ".join(f"'{w}'" for w in text.STOP_WORDS)
KEPT = f"{TOKENS}, kp AS (SELECT * FROM lw WHERE token NOT IN ({STOPS})), fr AS (SELECT token, count(*) AS n FROM kp GROUP BY 1)"

# The test prose is invented, so its lexicon weighs some of its frequent words.
PROSE_LEXICON = {
    "that": 1.5, "with": 1.0, "from": 0.5, "que": 1.0, "und": 0.8, "des": 0.6,
    "was": -1.5, "at": -1.0, "this": -0.5, "la": -0.7, "der": -0.9, "es": -0.4,
}
LEXICON_ROWS = ", ".join(f"('{w}', CAST({s} AS DOUBLE))" for w, s in PROSE_LEXICON.items())
POLARITY = f"""{TOKENS}, lx(token, weight) AS (VALUES {LEXICON_ROWS}),
  hi AS (SELECT doc_id, sum(weight) AS s FROM lw JOIN lx USING (token) GROUP BY 1),
  sc AS (SELECT doc_id, lang, coalesce(s, 0) / sqrt(coalesce(s, 0) * coalesce(s, 0) + 15) AS score FROM documents LEFT JOIN hi USING (doc_id)),
  po AS (SELECT *, CASE WHEN score > 0.2 THEN 'positive' WHEN score < -0.2 THEN 'negative' ELSE 'neutral' END AS label FROM sc)"""


def _tokens(spark, folder):
    return text.tokenize(tables.documents(spark, folder))


@query(
    "tokenize",
    r"""WITH t AS (SELECT doc_id, regexp_extract_all(text, '[\p{L}\p{N}_]+') AS ws FROM documents)
    SELECT doc_id, CAST(unnest(range(len(ws))) AS INTEGER) AS position, lower(unnest(ws)) AS token FROM t""",
)
def tokenize(spark, folder):
    return _tokens(spark, folder)


@query(
    "stopword_filter",
    f"WITH {TOKENS} SELECT doc_id, count(*) AS kept, count(DISTINCT token) AS distinct_kept FROM lw WHERE token NOT IN ({STOPS}) GROUP BY 1",
)
def stopword_filter(spark, folder):
    kept = text.stopword_filter(_tokens(spark, folder))
    return kept.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("kept"), F.count_distinct("token").alias("distinct_kept")
    )


@query("word_freq", f"WITH {KEPT} SELECT token, n FROM fr")
def word_freq(spark, folder):
    return text.word_freq(text.stopword_filter(_tokens(spark, folder)))


@query("most_common_words", f"WITH {KEPT} SELECT token, n FROM fr ORDER BY n DESC, token LIMIT 8")
def most_common_words(spark, folder):
    return text.most_common(text.stopword_filter(_tokens(spark, folder)), 8)


def _loglog_sql(size: int) -> str:
    return f"""WITH {KEPT}, rk AS (SELECT n, row_number() OVER (ORDER BY n DESC, token) - 1 AS pos FROM fr),
      gr AS (SELECT CAST(floor(pos / {size}) AS BIGINT) AS group_no, sum(n) AS total FROM rk GROUP BY 1 HAVING count(*) = {size})
    SELECT group_no, round(ln(group_no + 1), 9) AS log_rank, round(ln(total), 9) AS log_total FROM gr"""


def _loglog(spark, folder, size: int):
    curve = text.rank_frequency_loglog(text.word_freq(text.stopword_filter(_tokens(spark, folder))), size)
    return curve.select("group_no", F.round("log_rank", 9).alias("log_rank"), F.round("log_total", 9).alias("log_total"))


@query("rank_frequency_loglog", _loglog_sql(4))
def rank_frequency_loglog(spark, folder):
    return _loglog(spark, folder, 4)


@query("rank_frequency_loglog_by_three", _loglog_sql(3))
def rank_frequency_loglog_by_three(spark, folder):
    return _loglog(spark, folder, 3)


@query("polarity_label", f"WITH {POLARITY} SELECT doc_id, label, round(score, 9) AS score FROM po WHERE label <> 'neutral'")
def polarity_label(spark, folder):
    docs = tables.documents(spark, folder)
    labelled = text.polarity_label(docs, text.lexicon_table(docs, PROSE_LEXICON))
    return labelled.select("doc_id", "label", F.round("score", 9).alias("score"))


@query(
    "polarity_share",
    f"WITH {POLARITY} SELECT label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 9) AS percent FROM po GROUP BY 1",
)
def polarity_share(spark, folder):
    docs = tables.documents(spark, folder)
    labelled = text.polarity(docs, text.lexicon_table(docs, PROSE_LEXICON))
    return category_share(labelled, "label").withColumn("percent", F.round("percent", 9))


@query(
    "polarity_text_sink",
    rf"""WITH {POLARITY} SELECT label, regexp_replace(text, '[\r\n]+', ' ', 'g') AS value
    FROM po JOIN documents USING (doc_id) WHERE label <> 'neutral'""",
)
def polarity_text_sink(spark, folder):
    """Positive and negative documents in one text file set each, read back."""
    docs = tables.documents(spark, folder)
    path = scratch_path(spark, "polarity")
    sinks.write_labelled_text(text.polarity_label(docs, text.lexicon_table(docs, PROSE_LEXICON)), path)
    return spark.read.text(path).select("label", "value")
