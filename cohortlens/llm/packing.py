"""Best-fit packing planned on the length histogram.

Documents become pieces of at most ``max_len`` tokens. Best-fit decreasing runs over the *counts*
of lengths (at most ``max_len`` numbers, whatever the corpus size) and gives plan rows: a run of
ranks within a length, and the sequences and offsets that these ranks take. Pieces then take
their slots by joining the plan on length and rank. The plan's size depends on ``max_len`` alone.

Defined results: a null or empty text is one piece that holds the end id alone; a text over
``max_len`` is cut into ``max_len`` pieces, its first piece taking the remainder; ties and repeated
rows get slots of their own (ranks are over rows, not ids); an empty table gives no rows.
Only the id and text columns are used, so that other columns cannot clash.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.tokens import default_tokenizer, encoder
from cohortlens.session import materialize

MAX_LEN = 2048
RANK_ROWS = 100_000  # rows in a bucket of the ranks within a length
PIECE = "doc_id {}, piece int, start long, length long, ids_crc32 long, ids array<long>"


def pieces(df: DataFrame, id_col: str = "doc_id", text: str = "text", tokenizer: str | None = None,
           max_len: int = MAX_LEN, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and (unless turned off) its ids."""
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(path)
        for batch in batches:
            rows = []
            for doc, t in zip(batch["id"], batch["text"], strict=True):
                ids = np.append(enc.ids(t) if isinstance(t, str) else np.zeros(0, np.uint32), end_id).astype("<u4")
                edges = [0, *range(len(ids) % max_len or max_len, len(ids) + 1, max_len)]
                for k, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), ids[a:b].tolist() if with_ids else None))
                if len(rows) >= 4096:
                    yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])
                    rows = []
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"])

    got = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    out = got.mapInPandas(cut, PIECE.format(got.schema["id"].dataType.simpleString()))
    return out if with_ids else out.drop("ids")


def plan(counts: dict[int, int], max_len: int = MAX_LEN) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: (length, first rank, ranks, pieces per sequence, first sequence, offset).

    Equal sequences are kept as runs, by room left; the run with the least room that fits is filled first."""
    rows, runs, room, made = [], {}, [], 0

    def put(left: int, first: int, n: int) -> None:
        if left and n:
            if left not in runs:
                runs[left] = []
                insort(room, left)
            runs[left].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            i = bisect_left(room, length)
            if i < len(room):
                space = room[i]
                first, n = runs[space].pop()
                if not runs[space]:
                    del runs[space]
                    room.pop(i)
            else:
                space, first = max_len, made
                n = -(-left // (max_len // length))
                made += n
            per = space // length
            full = min(n, left // per)
            if full:
                rows.append((length, rank, full * per, per, first, max_len - space))
                put(space - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if full < n and left:
                if left < per:
                    rows.append((length, rank, left, left, first + full, max_len - space))
                    put(space - left * length, first + full, 1)
                    rank, left, full = rank + left, 0, full + 1
            put(space, first + full, n - full)
    return rows


def pack(cut: DataFrame, max_len: int = MAX_LEN) -> DataFrame:
    """Pieces with sequence_id and offset. ``cut`` is written once, as the histogram and the slots both read it."""
    spark = cut.sparkSession
    rows = materialize(cut.withColumn("__row", F.monotonically_increasing_id()), "pieces")
    counts = {r["length"]: r["count"] for r in rows.groupBy("length").count().collect()}  # at most max_len rows
    slots = spark.createDataFrame(plan(counts, max_len), "length long, first_rank long, n_ranks long, per long, first_seq long, first_offset long")
    buckets = max(1, -(-sum(counts.values()) // RANK_ROWS))
    keyed = rows.withColumn("__bucket", F.pmod(F.xxhash64("__row"), F.lit(buckets)))
    per_bucket = keyed.groupBy("length", "__bucket").agg(F.count("*").alias("__n"))
    before = per_bucket.select("length", "__bucket", (F.sum("__n").over(Window.partitionBy("length").orderBy("__bucket")) - F.col("__n")).alias("__before"))
    ranked = keyed.withColumn("__rank", F.row_number().over(Window.partitionBy("length", "__bucket").orderBy("__row")) - 1)
    ranked = ranked.join(before, ["length", "__bucket"]).withColumn("__rank", F.col("__rank") + F.col("__before"))
    at = F.col("__rank") - F.col("first_rank")
    fits = (ranked["length"] == slots["length"]) & at.between(0, F.col("n_ranks") - 1)
    return ranked.join(F.broadcast(slots), fits).select(
        *[rows[c] for c in rows.columns if c != "__row"],
        (F.col("first_seq") + F.floor(at / F.col("per"))).cast("long").alias("sequence_id"),
        (F.col("first_offset") + (at % F.col("per")) * rows["length"]).cast("long").alias("offset"))
