"""One registered query per operator: the thin form that each query's contract asks for."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm import ann, fim, lexical, mixing, oracles, packing, pii, pivots, quality, superminhash, tokens, urls, warc, wrapper
from cohortlens.llm.util import bounded_batches, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: The other queries (checksums, tokenizers, fitted models, hash orders, parsers) are held against brute force in tests/llm.
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def text_query(fn):
    """A query that hands whole texts to Python."""
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        bounded_batches(spark)
        return fn(spark, sf_dir)

    return query(run)


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (base and added)."""
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"), pii.fit(spark)).drop("text")
    base = F.filter("pii", lambda x: x["base"])
    kinds = F.transform("base", lambda x: x["k"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(pii.BASE)]
    return found.withColumn("base", base).select("doc_id", *counts, F.sha2(pii.as_string(F.col("base")), 256).alias("base_sha256"),
                                                 pii.as_string(F.col("pii")).alias("spans"))


@text_query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), with_ids=False))


@text_query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit."""
    return tokens.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score. Queries: the rows whose vec_id is divisible by 100, against all rows."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.search(rows, rows.where("vec_id % 100 = 0"))


@query
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict. Outcomes: the labels of the document with the page's number."""
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return urls.judge(table(spark, sf_dir, "pages").select("page_id", "url"), outcomes).select("page_id", "host", "path", "rule", "verdict")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken: the documents in training order, by the first of their positions."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    placed = mixing.curriculum(mixing.mix(docs, keep_text=False), documents=True)
    # a document is taken as often as it has positions
    return placed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.size("positions")).cast("long").alias("taken"))


@query
def curriculum_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, source, size, position: the mix of op6 in training order, a row for each time that a document is taken."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.curriculum(mixing.mix(docs, keep_text=False)).select("doc_id", "source", "size", "position")


@text_query
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    found = superminhash.groups(table(spark, sf_dir, "documents"), shingle=4)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                        (F.col("id").isNull() | (F.col("id") == F.col("component_id"))).alias("kept"))


@query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to: pages as ARC archives, converted to WARC and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@text_query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text, n_chars."""
    return wrapper.extract(table(spark, sf_dir, "pages"))


@text_query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, fail_bits."""
    led = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    bits = "ledger.fail_bits"
    return led.select("doc_id", *[f"ledger.{m}" for m in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                      (~quality.passes(bits, "base")).alias("base_failed"), quality.passes(bits, "v2").alias("kept"), F.col(bits))


@text_query
def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """item_id, rank, doc_id, score: the ten best of all documents for each benchmark item."""
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score. Queries: the rows whose vec_id is divisible by 100, against all rows."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return pivots.search(rows, rows.where("vec_id % 100 = 0"))


@text_query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256 (of the text rebuilt from output and form)."""
    made = fim.transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    output = F.col("fim.output")
    return made.select("doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", F.sha2(output, 256).alias("output_sha256"),
                       F.sha2(fim.restore(output, F.col("fim.form")), 256).alias("restored_sha256"))


@text_query
def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """rule, n_failed, n_only: of the current policy's rules, the documents that each rejects, and those that no other does."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))
