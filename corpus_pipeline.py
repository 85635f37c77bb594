"""The corpus pipeline: ``documents`` through quality rules, near-dedup, redaction, mixing and packing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import mixing, packing, pii, quality, superminhash
from cohortlens.llm.util import bounded_batches, table
from cohortlens.session import scratch_folder


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy rejects go; the rest stay as they are. A null text is rejected (no words); an empty table stays empty."""
    led = quality.ledger(docs, to="__ledger")
    return led.where(quality.passes("__ledger.fail_bits", "v2")).select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles at 80 %) stays; rows with a null id all stay."""
    return superminhash.keep_one(docs, shingle=5)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; n_chars follows the text. No document goes, also not one with a null text."""
    found = pii.find(docs, pii.fit(spark), to="__pii")
    out = found.withColumn("text", pii.redact(F.col("text"), F.col("__pii")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size("__pii") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix in training order: a document stands in it as often as it is taken; one without words is in no mix. A null source is a source."""
    plain = docs.withColumnsRenamed({c: f"__own_{c}" for c in docs.columns if c in (*mixing.ADDED, "position")})
    return mixing.curriculum(mixing.mix(plain)).select(*[F.col(p).alias(c) for p, c in zip(plain.columns, docs.columns, strict=True)])


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The slots of all pieces: doc_id, piece, start, length, ids_crc32, sequence_id, offset. A null text is the end id alone."""
    return packing.pack(packing.pieces(docs, with_ids=False))


STAGES = [("quality_rules", quality_stage), ("near_dedup", near_dedup_stage), ("pii", pii_stage), ("mixing", mixing_stage), ("packing", packing_stage)]
#: The tokenizer and the fitted models have no exact SQL; tests/llm/test_llm_pipeline.py holds run() against a brute force of all stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage over all that its predecessor kept, each written as Parquet and read again. Columns of other names than
    those of documents are carried along; working columns have names of their own, so none can clash."""
    bounded_batches(spark)
    docs = table(spark, sf_dir, "documents")
    base = f"{scratch_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
