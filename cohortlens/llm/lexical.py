"""Ranked lexical search over a term-partitioned index through which item bundles are piped.

* Index: documents are cut into shards of at most ``SHARD_BYTES`` of text and ``SHARD_ROWS`` rows as they are read; a row
  (shard, term) holds the postings as blobs, and a row without a term holds the shard's ids and lengths. Only the items' terms are kept.
* Term owners: each term belongs to one of ``OWNERS`` owners by its share of documents, rarest first, so that hot terms
  meet accumulators that earlier owners have thinned.
* Pipeline: the items of a block travel as one bundle row per (item, shard), with a sparse accumulator of documents. Stage s cogroups
  the bundles with the postings of owner s on (block, shard), adds the integer contributions and passes the bundles on. The
  last owner selects each shard's best, of which a final ranking takes the best of all.
* A document leaves a bundle (and a new one is not let in) only if its sum and all that the item's later terms can add stay below
  the shard's k-th sum so far. That many documents end above it, so results are exact.

A group holds one shard's postings of one owner and at most ``BLOCK_ITEMS`` accumulators of ``SHARD_ROWS`` numbers, whatever the
corpus, a term's frequency or the number of copies. The items' vocabulary is broadcast up to ``BROADCAST_TERMS`` (counted first); above
that the same joins shuffle.

Defined results: null texts have no terms; documents with a null id count in N, L and df and are not ranked; rows with equal
ids are documents of their own; items with equal ids are one item with all their terms, those with a null id are left out; equal
scores go by id; items without a match and empty tables give no rows. Only the named columns are used, so no name can clash.
Exact while 90 * n * N stays within 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.llm.util import blocks
from cohortlens.session import materialize

K = 10
SHARD_BYTES, SHARD_ROWS = 4 << 20, 4096
BLOCK_ITEMS = 256
BROADCAST_TERMS = 1 << 18
#: An owner has the terms that fewer than one document in so many holds; the last one has the rest.
OWNER_SHARES = (256, 32, 4)
OWNERS = len(OWNER_SHARES) + 1
MOST = 1_000_000  # a contribution is below MOST * w
#: Every byte but ASCII letters, digits and those of other characters becomes a space; A-Z become a-z.
FOLD = bytes(32 if b < 128 and not chr(b).isalnum() else b + 32 if 65 <= b <= 90 else b for b in range(256))
INDEX = "shard long, term string, n long, total long, docs binary, counts binary"
BUNDLE = "block int, shard long, item long, rest long, docs binary, sums binary"


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def postings(texts: list[bytes], valid: np.ndarray) -> tuple[list[str], np.ndarray, list[bytes], list[bytes], np.ndarray]:
    """(terms, their numbers of documents, documents as <u2, occurrences as <u4; each document's length) of a shard.
    Documents that are not ``valid`` count and have no postings."""
    per_doc = [words(t) for t in texts]
    n = np.array([len(w) for w in per_doc], dtype=np.int64)
    codes, names = pd.factorize(np.array([w for own in per_doc for w in own], dtype=object))
    pair, tf = np.unique(codes.astype(np.int64) * len(texts) + np.repeat(np.arange(len(texts)), n), return_counts=True)
    term, doc = np.divmod(pair, max(1, len(texts)))
    df = np.bincount(term, minlength=len(names))
    ok = valid[doc]
    edges = np.searchsorted(term[ok], np.arange(len(names) + 1))
    docs, counts = doc[ok].astype("<u2").tobytes(), tf[ok].astype("<u4").tobytes()
    cuts = list(zip(edges.tolist(), edges[1:].tolist(), strict=False))
    return [w.decode() for w in names], df, [docs[2 * a:2 * b] for a, b in cuts], [counts[4 * a:4 * b] for a, b in cuts], n


def _index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for first, block in blocks(batch["text"], SHARD_BYTES):
            for i in range(0, len(block), SHARD_ROWS):
                texts = block[i:i + SHARD_ROWS]
                at = slice(first + i, first + i + len(texts))
                terms, df, docs, counts, n = postings(texts, batch["valid"].to_numpy()[at])
                yield pd.DataFrame({"shard": number, "term": [None, *terms], "n": [int((n > 0).sum()), *df], "total": [int(n.sum()), *[0] * len(df)],
                                    "docs": [batch["id"].to_numpy(dtype="<i8")[at].tobytes(), *docs], "counts": [n.astype("<u4").tobytes(), *counts]})
                number += 1


def _terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for first, texts in blocks(batch["text"], SHARD_BYTES):
            rows = [(i, w.decode()) for i, t in zip(batch["id"].iloc[first:first + len(texts)], texts, strict=True) for w in set(words(t))]
            yield pd.DataFrame(rows, columns=["item", "term"])


def _owner(k: int, n_docs: int, n_terms: int, last: bool):
    """A stage's function, for cogroup."""
    return lambda key, own, bundles: _add(key, own, bundles, k, n_docs, n_terms, last)


def _add(key: tuple, own: pd.DataFrame, bundles: pd.DataFrame, k: int, n_docs: int, n_terms: int, last: bool) -> pd.DataFrame:
    """One owner's stage over one shard and one block of items: the bundles after it, or the best documents if it is the last."""
    head = own["term"].isna()
    ids, n = np.frombuffer(own["docs"][head].iloc[0], "<i8"), np.frombuffer(own["counts"][head].iloc[0], "<u4").astype(np.int64)
    m8 = 8 * (10 + 90 * n * n_docs // max(1, n_terms))
    sums: dict[int, np.ndarray] = {}
    rest: dict[int, int] = {}
    for item, left, docs, got in zip(bundles["item"], bundles["rest"], bundles["docs"], bundles["sums"], strict=True):
        sums[item], rest[item] = np.zeros(len(n), dtype=np.int64), left
        sums[item][np.frombuffer(docs, "<u2")] = np.frombuffer(got, "<i8")
    rows = own[~head]
    for w, items, rests, docs, counts in zip(rows["w"], rows["items"], rows["rests"], rows["docs"], rows["counts"], strict=True):
        at, tf = np.frombuffer(docs, "<u2"), np.frombuffer(counts, "<u4").astype(np.int64)
        gain = int(w) * ((1_000_000_000 * tf) // (1000 * tf + m8[at]))
        for item, left in zip(items.tolist(), rests.tolist(), strict=True):
            if item not in sums:
                sums[item] = np.zeros(len(n), dtype=np.int64)
            sums[item][at] += gain
            rest[item] = left
    out = []
    for item, total in sums.items():
        at = np.flatnonzero(total)
        if last:
            at = at[np.lexsort((ids[at], -total[at]))[:k]]
            out += [(item, int(ids[i]), int(total[i])) for i in at]
            continue
        if len(at) > k:
            least = np.partition(total[at], len(at) - k)[len(at) - k]
            at = at[total[at] + rest[item] >= least]
        if len(at):
            out.append((key[0], key[1], item, rest[item], at.astype("<u2").tobytes(), total[at].astype("<i8").tobytes()))
    return pd.DataFrame(out, columns=["item", "doc_id", "score"] if last else [c.split()[0] for c in BUNDLE.split(", ")])


def _spread(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast up to the documented bound."""
    return F.broadcast(df) if rows <= BROADCAST_TERMS else df


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", item_col: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` best documents with a score above 0."""
    asked = items.select(F.col(item_col).cast("long").alias("id"), F.col(text).alias("text")).where("id is not null")
    asked = materialize(asked.mapInPandas(_terms, "item long, term string").distinct(), "lexical-items")
    vocabulary = asked.select("term").distinct().withColumn("asked", F.lit(True))
    size = vocabulary.count()
    n_blocks = max(1, -(-asked.select("item").distinct().count() // BLOCK_ITEMS))
    ident = F.col(id_col).cast("long")
    whole = docs.select(F.coalesce(ident, F.lit(0)).alias("id"), ident.isNotNull().alias("valid"), F.col(text).alias("text")).mapInPandas(_index, INDEX)
    index = materialize(whole.join(_spread(vocabulary, size), "term", "left").where("asked or term is null").drop("asked"), "lexical-index")
    heads = index.where("term is null")
    n_docs, n_terms = heads.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    weights = materialize(_weights(asked, index, n_docs, n_blocks), "lexical-weights")

    def owned(stage: int) -> DataFrame:
        entries = index.where("term is not null").join(_spread(weights.where(F.col("owner") == stage), size * n_blocks), "term")
        none = F.lit(None)
        all_heads = heads.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)))).withColumns(
            {"w": none.cast("long"), "items": none.cast("array<long>"), "rests": none.cast("array<long>")})
        cols = ["block", "shard", "term", "w", "items", "rests", "docs", "counts"]
        return entries.select(cols).unionByName(all_heads.select(cols))

    bundles = docs.sparkSession.createDataFrame([], BUNDLE)
    for stage in range(OWNERS):
        last = stage == OWNERS - 1
        bundles = owned(stage).groupBy("block", "shard").cogroup(bundles.groupBy("block", "shard")).applyInPandas(
            _owner(k, n_docs, n_terms, last), "item long, doc_id long, score long" if last else BUNDLE)
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    return bundles.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("item").alias("item_id"), "rank", "doc_id", "score")


def weight(n_docs: int, df: Column) -> Column:
    return F.floor(1000 * F.log(F.lit(float(2 * n_docs + 2)) / (2 * df + 1).cast("double"))).cast("long")


def _weights(asked: DataFrame, index: DataFrame, n_docs: int, n_blocks: int) -> DataFrame:
    """(term, owner, block, w, items, rests): the items of a block that hold a term, each with the most that the terms
    of later owners can still add to a document's sum."""
    df = index.where("term is not null").groupBy("term").agg(F.sum("n").alias("df"))
    owner = F.lit(OWNERS - 1)
    for i, share in reversed(list(enumerate(OWNER_SHARES))):
        owner = F.when(F.col("df") * share < n_docs, i).otherwise(owner)
    pairs = asked.join(df, "term").withColumn("w", weight(n_docs, F.col("df"))).withColumn("owner", owner)
    later = [F.coalesce(F.sum(F.when(F.col("owner") > s, F.col("w"))), F.lit(0)) * MOST for s in range(OWNERS)]
    rest = pairs.groupBy("item").agg(F.array(*later).alias("rest"))
    block = F.pmod(F.xxhash64("item"), F.lit(n_blocks)).cast("int")
    pairs = pairs.join(rest, "item").withColumn("block", block).withColumn("rest", F.element_at("rest", F.col("owner") + 1))
    both = F.sort_array(F.collect_list(F.struct("item", "rest")))
    return pairs.groupBy("term", "owner", "block", "w").agg(both.alias("of")).select(
        "term", "owner", "block", "w", F.col("of.item").alias("items"), F.col("of.rest").alias("rests"))
