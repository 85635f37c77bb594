"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

WHITE = b" \t\n\x0b\x0c\r"  # the white space of [^\x20\x09-\x0D]+, which is also what bytes.split() splits on


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession, most: int = 4 << 20) -> None:
    """Arrow batches of texts are bounded by bytes too, unless the session has a bound of its own."""
    if BATCH_BYTES not in dict(spark.sparkContext.getConf().getAll()):
        spark.conf.set(BATCH_BYTES, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def blocks(texts, most_bytes: int) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, UTF-8 texts) in blocks of about ``most_bytes``; a null text is empty.

    A text is never cut: a longer one makes a block of its own."""
    first, size, block = 0, 0, []
    for i, t in enumerate(texts):
        b = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        if block and size + len(b) > most_bytes:
            yield first, block
            first, size, block = i, 0, []
        block.append(b)
        size += len(b)
    if block:
        yield first, block
