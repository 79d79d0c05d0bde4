"""Text statistics over whole documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymart.functions.scalar import words
from tallymart.operators.ordering import number_rows

# Our stop words.
STOP_WORDS = [
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it", "its",
    "of", "on", "or", "that", "the", "this", "to", "was", "were", "will", "with",
]

# Our polarity lexicon.
LEXICON = {
    "bad": -2.5, "best": 3.2, "crisis": -3.1, "dead": -3.3, "fail": -2.5, "fear": -2.2, "good": 1.9,
    "great": 3.1, "happy": 2.7, "hope": 1.9, "kill": -3.7, "lose": -1.6, "love": 3.2, "peace": 2.5,
    "win": 2.8, "war": -2.9, "worst": -3.1,
}

# Label cuts and the damping of the score.
POSITIVE_ABOVE, NEGATIVE_BELOW, DAMPING = 0.2, -0.2, 15.0


def tokenize(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, position, token): every word of every document, lower-cased, in order.

    Tokens are lower-cased after they are split off: lower-casing may lengthen a text.
    """
    split = docs.select(key, F.posexplode(words(text)).alias("position", "token"))
    return split.withColumn("token", F.lower("token"))


def stopword_filter(tokens: DataFrame, stop_words: list[str] | None = None) -> DataFrame:
    """Drop stop words. The list is a literal set inside the filter: nothing is joined."""
    return tokens.filter(~F.col("token").isin(stop_words if stop_words is not None else STOP_WORDS))


def word_freq(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def most_common(tokens: DataFrame, n: int) -> DataFrame:
    return word_freq(tokens).orderBy(F.desc("n"), "token").limit(n)


def rank_frequency_loglog(frequencies: DataFrame, size: int) -> DataFrame:
    """Frequencies from the highest down, summed in groups of ``size``: log of the group number and
    log of its sum. An incomplete last group is dropped."""
    ranked = number_rows(frequencies, [F.desc("n"), F.asc("token")], "_no")
    groups = ranked.groupBy(F.floor((F.col("_no") - 1) / size).alias("group_no")).agg(
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("_members")
    )
    return groups.filter(F.col("_members") == size).select(
        "group_no", F.log(F.col("group_no") + 1).alias("log_rank"), F.log("total").alias("log_total")
    )


def lexicon_table(docs: DataFrame, lexicon: dict[str, float] | None = None) -> DataFrame:
    rows = [(word, float(score)) for word, score in (lexicon or LEXICON).items()]
    return docs.sparkSession.createDataFrame(rows, "token string, weight double")


def polarity(docs: DataFrame, lexicon: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Damped lexicon score of each document and its label; documents between the cuts are neutral.

    Lexicon hits are summed before they meet the documents again, one row per document. The lexicon
    carries no hint: Spark broadcasts it when its measured size allows.
    """
    hits = tokenize(docs, key, text).join(lexicon, "token").groupBy(key).agg(F.sum("weight").alias("_s"))
    s = F.coalesce("_s", F.lit(0.0))
    label = (
        F.when(F.col("score") > POSITIVE_ABOVE, "positive")
        .when(F.col("score") < NEGATIVE_BELOW, "negative")
        .otherwise("neutral")
    )
    return (
        docs.join(hits, key, "left")
        .withColumn("score", s / F.sqrt(s * s + DAMPING))
        .withColumn("label", label)
        .drop("_s")
    )


def polarity_label(docs: DataFrame, lexicon: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents with a positive or negative label; neutral ones are dropped."""
    return polarity(docs, lexicon, key, text).filter(F.col("label") != "neutral")
