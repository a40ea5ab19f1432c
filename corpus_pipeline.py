"""Corpus pipeline: quality classifier, near-dedup, repeated-string removal, benchmark decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``docs``. A document is a ``doc_id`` with a text, so rows with a NULL or repeated ``doc_id``
are kept apart by their text; rows equal in both share their fate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import bpe, decontaminate, quality, simhash, suffixes
from terrace.llm.common import freeing, stage, table, unused
from terrace.llm.queries import quality_model, tokenizer

# Shingle widths and hash seeds of the fingerprints that link near-duplicates: each one misses near copies by chance, and the
# seeds make their chances nearly independent.
SHINGLES = ((5, 42), (2, 42), (2, 43), (2, 44))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects; NULL and empty texts are scored like any other."""
    (score,) = unused(docs, "_score")
    scored = quality.with_scores(docs, quality_model(spark, sf_dir), score=score)
    return scored.where(F.col(score) >= quality.THRESHOLD).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, that of the smallest ``doc_id``, of each group whose SimHashes over word shingles link."""
    return simhash.without_near_duplicates(docs, SHINGLES)


def remove_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut strings of 100 bytes that also start earlier; a character that loses some of its bytes goes as a whole."""
    cut = suffixes.kept_text(suffixes.remove_repeats(docs))
    shorter = F.col("_n_removed") > 0
    kept = cut.withColumn("text", F.when(shorter, F.col("_kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(shorter, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return kept.select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents in which a window of a benchmark item occurs; other texts of their ``doc_id`` stay."""
    told_apart = docs.select(F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("document"), "text")
    found = decontaminate.contamination(told_apart, table(spark, sf_dir, "benchmark"), key="document").where("contaminated").select("document")
    same = docs["doc_id"].eqNullSafe(found["document.doc_id"]) & (F.xxhash64(docs["text"]) == found["document.hash"])
    return docs.join(found, same, "left_anti")


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each text's token ids."""
    ranks, pattern = tokenizer()
    return bpe.with_digests(docs, ranks, pattern)


STAGES = [
    ("quality classifier", classify_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", remove_repeated_strings),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", encode_bytes),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder before the next one reads it.

    What a stage staged on its way, and the corpus that the stage before it left, are deleted when it is written.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (_, apply) in enumerate(STAGES):
        with freeing(spark) as paths:
            docs = stage(apply(spark, docs, sf_dir), f"pipeline-{i}")
            kept = paths.pop()  # the last one written
            if before is not None:
                paths.append(before)
            before = kept
    return docs
