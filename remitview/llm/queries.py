"""The registered queries of the training-data operators, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitview.llm import conversation_repair, license_digests, line_dedup, mcd_outliers, merkle_manifest, packing, quality_rules, sentencepiece_viterbi, simhash_trie, suffix_dedup, vector_packing, voronoi_topk, zstd_language
from remitview.llm.common import id_text_crc, table


def _held_out(parts: int, part: int):
    return F.coalesce(F.pmod(id_text_crc("doc_id"), F.lit(parts)) == part, F.lit(False))


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that may teach: those not held out."""
    return labels.where(~_held_out(3, 1))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document; labels of the held-out third don't teach."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality_rules.fit(docs, training_labels(labels))
    rows = docs.select("doc_id", "text", _held_out(3, 1).alias("held_out"))
    return quality_rules.score(rows, model).select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers of every document that duplicate a line kept elsewhere."""
    found = line_dedup.duplicate_lines(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.size("lines").alias("n_lines"), "lines")


def op3_voronoi_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten best inner products of every hundredth vector against all others."""
    return voronoi_topk.top_k(table(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0, k=10)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of 50 words or more found elsewhere too: the word positions
    covered where it was seen before (``later``) and where this is its first place (``first``)."""
    found = suffix_dedup.repeats(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), (F.size("later") > 0).alias("cut"), "later", "first")


def op5_sentencepiece_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and checksum of every document's ids, and whether they decode to the text."""
    return sentencepiece_viterbi.round_trip(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document over fingerprints of 3-word shingles within 2 bits."""
    found = simhash_trie.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, budget=2)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_mcd_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document against its language and source."""
    return mcd_outliers.outliers(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def base_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that op8 judges by, which SQL can express, without its verdict."""
    found = mcd_outliers.base_statistics(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", mcd_outliers.base_failed().alias("base_failed"))


def op9_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence that each document is, and the licences whose notices are lines of it."""
    found = license_digests.scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "digest", "license_id", F.array_join("notices", ",").alias("notices"))


def op10_zstd_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; the held-out quarter doesn't teach."""
    docs = table(spark, sf_dir, "documents")
    known = zstd_language.learn(docs.where(~_held_out(4, 2)))
    found = zstd_language.predict(docs.select("doc_id", "text"), known)
    found = found.withColumnRenamed("id", "doc_id")
    return found.select("doc_id", _held_out(4, 2).alias("held_out"), "lang_pred", "score", "margin", "accepted")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, least-cost repair and digest of every conversation, damaged by its rows' crc32."""
    return conversation_repair.damaged_and_repaired(table(spark, sf_dir, "conversations"))


def op12_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    return vector_packing.pack(table(spark, sf_dir, "documents"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and roots of every document, and whether it still verifies once every third text
    (by its id's crc32) is lower-cased."""
    return merkle_manifest.manifest(table(spark, sf_dir, "documents"), merkle_manifest.damaged_every_third())


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_line_dedup, op3_voronoi_topk, op4_suffix_dedup, op5_sentencepiece_viterbi, op6_simhash_trie, op7_sum_of_squares_packing, op8_mcd_outliers, op9_license_digests, op10_zstd_language, op11_conversation_repair, op12_vector_packing, op13_merkle_manifest)} | {"documents_base_counts": base_counts}
ORACLES: dict[str, str] = {"op3_voronoi_topk": voronoi_topk.oracle_sql(), "documents_base_counts": mcd_outliers.base_sql(), "op9_license_digests": license_digests.oracle_sql(), "op11_conversation_repair": conversation_repair.oracle_sql(), "op13_merkle_manifest": merkle_manifest.oracle_sql()}
