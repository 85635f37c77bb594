"""Token counts of whole texts; huge documents by overlap resynchronisation.

A document longer than ``huge`` characters is cut into overlapping chunks, so that one text never
occupies one task for long. Every chunk is encoded on its own, with offsets. Two neighbouring
chunks are spliced at a *proven stable* common boundary: a place in their overlap where

* the characters around it (non-space then white space, or letter next to digit) end a pre-token
  of the byte-level pattern whatever stands further left or right, and lie outside any special
  token (special tokens hold neither white space nor digits), and
* both encodings have a token boundary.

Where a seam has no such place, its document is cut again with wider overlaps, up to one chunk.

Defined results: a null text is empty (0 bytes, 0 tokens); repeated rows are counted one by one
(chunks are keyed by row, not by id); an empty table gives no rows; other columns are kept, and a
column named like a result is replaced. ``.model`` files and ``.json`` files that are not plain
byte-level BPE have no proven boundary here; their texts are encoded whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.session import materialize

HUGE_CHARS = 1 << 16  # longer documents are cut into chunks
CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 9
SEAM_PLACES = 8  # stable places that a chunk tells of each of its ends
#: Places that end a pre-token in any context. Fixed value: follows from the byte-level pattern.
STABLE = regex.compile(r"(?<=\S)(?=\s)|(?<=\p{L})(?=\p{N})|(?<=\p{N})(?=\p{L})")
#: The pattern that splits text before byte-level merges. Fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Token ids of a text as the library for the file gives them (no added special tokens).

    A byte-level BPE ``.json`` runs in tiktoken's core over the vocabulary of that very file, whose ids
    are in merge order (checked when it is read): the same ids as the tokenizers library, several times faster.
    The core's pattern matcher has a bounded stack, which a very long run of white space exceeds; such a text goes
    to the tokenizers library itself.
    """

    def __init__(self, path: str):
        self.stable = False  # whether STABLE is proven for it
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.ids = lambda text: np.asarray(model.encode(text, num_threads=1), dtype=np.uint32)
            return
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if self._byte_level(spec):
            import tiktoken

            ranks, special = self._ranks(spec)
            core = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.stable = not any(regex.search(r"[\s\p{N}]", s) for s in special)
            self.ids = lambda text: self._or_library(core, path, text)
            size = max([*ranks.values(), *special.values()]) + 1
            self.n_bytes = np.zeros(size, dtype=np.int64)
            for word, i in ranks.items():
                self.n_bytes[i] = len(word)
            for word, i in special.items():
                self.n_bytes[i] = len(word.encode())
        else:
            tok = library(path)
            self.ids = lambda text: np.asarray(tok.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    @staticmethod
    def _or_library(core, path: str, text: str) -> np.ndarray:
        try:
            return core.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # the matcher's stack
            return np.asarray(library(path).encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    @staticmethod
    def _byte_level(spec: dict) -> bool:
        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        added = all(t["special"] and not (t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]) for t in spec["added_tokens"])
        if not (model["type"] == "BPE" and plain and added and not spec.get("normalizer") and pre.get("type") == "ByteLevel"
                and pre.get("use_regex", True) and not pre.get("add_prefix_space")):
            return False
        at = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" ")), -1) for m in model["merges"]]
        return all(a < b for a, b in zip(at, at[1:], strict=False))

    @staticmethod
    def _ranks(spec: dict) -> tuple[dict[bytes, int], dict[str, int]]:
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        char = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        return {bytes(char[c] for c in w): i for w, i in spec["model"]["vocab"].items() if w not in special}, special


@lru_cache(maxsize=4)
def library(path: str):
    """The tokenizers library's own tokenizer, without truncation and padding; one per Python worker."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path)


def stable_places(text: str, first: int, last: int) -> list[tuple[int, int]]:
    """(character, byte) offsets of the first stable places strictly inside text[first:last]."""
    out, at, byte = [], 0, 0
    for m in STABLE.finditer(text, first, last):
        if first < m.start() < last:
            byte += len(text[at:m.start()].encode("utf-8", "surrogatepass"))
            at = m.start()
            out.append((at, byte))
            if len(out) == SEAM_PLACES:
                break
    return out


def encode_chunk(enc: Encoder, text: str, head: int, tail: int) -> tuple[int, list, list]:
    """Tokens of a chunk and, as (character in the chunk, tokens before it), stable token boundaries in its first
    ``head`` characters and from character ``tail`` on."""
    ids = enc.ids(text)
    ends = np.cumsum(enc.n_bytes[ids])

    def seam(first: int, last: int) -> list[tuple[int, int]]:
        got = []
        for at, byte in stable_places(text, first, last):
            k = int(np.searchsorted(ends, byte))
            if k < len(ends) and ends[k] == byte:
                got.append((at, k + 1))
        return got

    return len(ids), seam(0, head) if head else [], seam(tail, len(text)) if tail < len(text) else []


def _chunks(step: int, overlap: int):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, text in zip(batch["__key"], batch["__text"], strict=True):
                n = max(1, -(-len(text) // step))
                for first in range(0, n, 64):
                    ks = range(first, min(n, first + 64))
                    yield pd.DataFrame({"__key": key, "chunk": ks, "last": [k == n - 1 for k in ks],
                                        "part": [text[k * step:(k + 1) * step + overlap] if k < n - 1 else text[k * step:] for k in ks]})
    return cut


SEAM = T.ArrayType(T.StructType([T.StructField("at", T.LongType()), T.StructField("rank", T.LongType())]))
CHUNK = T.StructType([T.StructField("n", T.LongType()), T.StructField("head", SEAM), T.StructField("tail", SEAM)])


def _encode_udf(path: str, step: int, overlap: int):
    @F.pandas_udf(CHUNK)
    def encode(part: pd.Series, chunk: pd.Series, last: pd.Series) -> pd.DataFrame:
        enc, rows = encoder(path), []
        for text, k, end in zip(part, chunk, last, strict=True):
            n, head, tail = encode_chunk(enc, text, overlap if k else 0, len(text) if end else step)
            rows.append((n, [{"at": a + k * step, "rank": r} for a, r in head], [{"at": a + k * step, "rank": r} for a, r in tail]))
        return pd.DataFrame(rows, columns=["n", "head", "tail"])
    return encode


def _splice(chunks: DataFrame) -> DataFrame:
    """(__key, n_tokens): the chunks' tokens less what both sides of each seam have twice; null where a seam has no
    common place."""
    side = lambda c, seam: chunks.select("__key", seam.alias("seam"), "n", F.explode(c).alias("p")).select(
        "__key", "seam", F.col("p.at").alias("at"), "n", F.col("p.rank").alias("rank"))
    left = side("tail", F.col("chunk")).withColumnsRenamed({"n": "n_left", "rank": "left"})
    right = side("head", F.col("chunk") - 1).drop("n").withColumnRenamed("rank", "right")
    seams = (left.join(right, ["__key", "seam", "at"]).groupBy("__key", "seam")
             .agg(F.min_by(F.col("n_left") - F.col("left") + F.col("right"), "at").alias("twice"))
             .groupBy("__key").agg(F.count("seam").alias("n_seams"), F.sum("twice").alias("twice")))
    whole = chunks.groupBy("__key").agg(F.sum("n").alias("n"), (F.count("n") - 1).alias("n_wanted"))
    return whole.join(seams, "__key", "left").select("__key", F.when(
        F.coalesce("n_seams", F.lit(0)) == F.col("n_wanted"), F.col("n") - F.coalesce("twice", F.lit(0))).alias("n_tokens"))


def _count_huge(huge: DataFrame, path: str, step: int, overlap: int) -> DataFrame:
    """(__key, n_tokens) of (__key, __text) by chunks; rounds with wider overlaps for what does not align."""
    done, pending, parts = [], huge, huge.sparkSession.sparkContext.defaultParallelism
    while True:
        cut = pending.mapInPandas(_chunks(step, overlap), "__key long, chunk long, last boolean, part string")
        spread = cut.repartition(max(parts, int(huge.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "__key", "chunk")
        got = spread.select("__key", "chunk", _encode_udf(path, step, overlap)("part", "chunk", "last").alias("c"))
        chunks = materialize(got.select("__key", "chunk", "c.n", "c.head", "c.tail"), "token-chunks")
        counts = materialize(_splice(chunks), "token-counts")
        done.append(counts.where("n_tokens is not null"))
        failed = counts.where("n_tokens is null")
        if failed.isEmpty():
            break
        pending = huge.join(failed.select("__key"), "__key", "left_semi")
        overlap *= 8
        step = max(step, 2 * overlap)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def count_tokens(df: DataFrame, text: str = "text", tokenizer: str | None = None, limit: int = 1024,
                 huge: int = HUGE_CHARS, step: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> DataFrame:
    """``df`` without ``text``, with n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit)."""
    path = tokenizer or default_tokenizer()
    chunked = encoder(path).stable

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for batch in batches:
            yield pd.Series([len(enc.ids(t)) if isinstance(t, str) else 0 for t in batch], dtype="int64")

    whole = F.coalesce(F.col(text), F.lit(""))
    is_huge = F.char_length(whole) > huge if chunked else F.lit(False)
    keep = [c for c in df.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    # One scan of the texts: counts of most documents, and the texts of the huge ones for their own jobs.
    first = materialize(df.select(*keep, F.octet_length(whole).cast("long").alias("n_bytes"), count(F.when(~is_huge, whole)).alias("__n"),
                                  F.when(is_huge, whole).alias("__text"), F.monotonically_increasing_id().alias("__key")), "token-first")
    out = first.select(*keep, "n_bytes", "__n", "__key", F.col("__text").isNotNull().alias("__huge"))
    huge_rows = first.where("__text is not null").select("__key", "__text")
    out = out.where("not __huge").select(*keep, "n_bytes", F.col("__n").alias("n_tokens"))
    if chunked and not huge_rows.isEmpty():
        totals = _count_huge(huge_rows, path, step, overlap)
        of_huge = first.where("__text is not null").select(*keep, "n_bytes", "__key")
        out = out.unionByName(of_huge.join(totals, "__key").select(*keep, "n_bytes", "n_tokens"))
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
