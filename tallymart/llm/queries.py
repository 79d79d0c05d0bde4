"""The registered queries of this package, one for each operator, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymart.llm import (
    char_language,
    compression_rules,
    count_vector_join,
    exact_dedup,
    fm_substring,
    lattice_scoring,
    merkle_manifest,
    oracles,
    path_templates,
    prefix_trie,
    secret_ownership,
    unigram_codec,
    vector_packing,
    word_table_bpe,
)
from tallymart.session import write_through

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def vector_pack(spark: SparkSession, folder: str) -> DataFrame:
    cut = vector_packing.pieces(_documents(spark, folder), TOKENIZER)
    return vector_packing.pack(cut).withColumnRenamed("id", "doc_id")


def heavy_hitter_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = exact_dedup.duplicate_groups(_documents(spark, folder))
    return groups.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("digest").alias("text_sha256")
    )


HEAVY_HITTER_DEDUP = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  row_number() OVER w = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id NULLS LAST)"""


def compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    return docs.select("doc_id", compression_rules.quality("text").alias("q")).select("doc_id", "q.*")


def count_vector_classes(spark: SparkSession, folder: str) -> DataFrame:
    found = count_vector_join.near_duplicates(_documents(spark, folder), size=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_ownership.scan(_documents(spark, folder))
    spans = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))
    base = F.filter(spans, lambda s: s["strict"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        F.col("id").alias("doc_id"),
        *(count(kind.name) for kind in secret_ownership.STRICT),
        F.sha2(secret_ownership.joined(base), 256).alias("base_sha256"),
        secret_ownership.joined(spans).alias("spans"),
        F.size(F.filter(spans, lambda s: s["live"])).cast("long").alias("n_live"),
    )


def _remainder(divisor: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def char_ngram_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    held_out = F.coalesce(_remainder(5) == 0, F.lit(True))
    model = char_language.fit(docs.filter(~held_out), "doc_id", "text", "lang")
    found = docs.select("doc_id", held_out.alias("held_out"), char_language.language("text", model).alias("found"))
    return found.select("doc_id", "held_out", "found.*")


def lattice_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.coalesce(_remainder(7) == 2, F.lit(True))
    docs = _documents(spark, folder)
    found = lattice_scoring.lattice_scores(docs, ~held_out, PIECES).withColumnRenamed("id", "doc_id")
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "subword_score"
    )


def unigram_encoding(spark: SparkSession, folder: str) -> DataFrame:
    """The ids of every text, how many of them are single bytes, and whether they decode to the text."""
    docs = _documents(spark, folder)
    coded = docs.select("doc_id", "text", unigram_codec.recode("text", PIECES).alias("both"))
    coded = coded.select("doc_id", "text", "both.ids", F.col("both.text").alias("back"))
    same = F.col("back") == F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" "))
    n_bytes = unigram_codec.byte_pieces("ids", PIECES).alias("n_bytes")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), n_bytes, same.alias("round_trip"), "ids")


def path_verdicts(spark: SparkSession, folder: str) -> DataFrame:
    found = path_templates.judge(spark.read.parquet(f"{folder}/pages.parquet"))
    return found.withColumnRenamed("id", "page_id")


def fm_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = fm_substring.repeated_words(_documents(spark, folder))
    return found.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def bpe_word_table(spark: SparkSession, folder: str) -> DataFrame:
    found = word_table_bpe.recode(_documents(spark, folder), TOKENIZER)
    return found.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def manifest_rows(docs: DataFrame) -> DataFrame:
    """Leaves, roots and proofs of ``docs``; where 3 divides the hash of the id, the proof meets a changed text."""

    def leaf(text: Column) -> Column:
        return merkle_manifest.leaf_hash(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    tampered = F.when(_remainder(3) == 0, leaf(F.translate("text", upper, lower))).otherwise(leaf(F.col("text")))
    found = merkle_manifest.manifest(docs, "doc_id", "lang", leaf(F.col("text")), tampered=tampered)
    folded = found.withColumn("folded_root", merkle_manifest.folded(F.col("steps"), F.col("tampered")))
    proof = merkle_manifest.proof_hash(F.col("steps")).alias("proof_sha256")
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return folded.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof, "folded_root", verified)


def bitmap_rank_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest_rows(_documents(spark, folder))


def trie_rows(rows: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations: a few turns of the first of five, then the conversation's own."""
    turns = write_through(prefix_trie.turns(rows), "turns")
    conv = F.col("conv_id")
    taken = (F.crc32(conv.cast("string").cast("binary")) % 9).cast("int")
    convs = turns.select("conv_id").distinct().select("conv_id", (conv - conv % 5).alias("base"), taken.alias("taken"))
    first = turns.filter("place <= 8").withColumnRenamed("conv_id", "base")
    begun = convs.join(first, "base").filter("place <= taken").select("conv_id", "place", "digest", "size")
    own = turns.filter(F.col("place") > taken).withColumn("place", F.col("place") + 8)
    found = prefix_trie.trie(prefix_trie.chains(begun.unionByName(own), convs))
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )


def truncation_trie(spark: SparkSession, folder: str) -> DataFrame:
    return trie_rows(spark.read.parquet(f"{folder}/conversations.parquet"))


QUERIES = {
    "op1_lattice_likelihood": lattice_likelihood,
    "op2_unigram_codec": unigram_encoding,
    "op3_count_vector_join": count_vector_classes,
    "op4_vector_packing": vector_pack,
    "op5_secret_ownership": secret_scan,
    "op6_path_templates": path_verdicts,
    "op7_heavy_hitter_dedup": heavy_hitter_dedup,
    "op8_compression_bands": compression_bands,
    "op9_fm_substring": fm_substrings,
    "op10_char_language": char_ngram_language,
    "op11_word_table_bpe": bpe_word_table,
    "op12_bitmap_rank_merkle": bitmap_rank_manifest,
    "op13_truncation_trie": truncation_trie,
}
ORACLES = {
    "op7_heavy_hitter_dedup": HEAVY_HITTER_DEDUP,
    "op12_bitmap_rank_merkle": oracles.MANIFEST,
    "op13_truncation_trie": oracles.TRIE,
}
