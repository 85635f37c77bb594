"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document: the ledger holds the measurements and one ``fail_bits``
integer (bit i set: rule i failed). A policy is a named, versioned mask over those bits, so that
changing a policy, comparing versions or ablating a rule never reads the texts again.

Defined results: a null text counts as empty (no words, so it fails ``few_words``); a document
with no words has no ratio failures; repeated rows are judged one by one; an empty table gives an
empty ledger. Other columns, whatever their names, stay as they are; the ledger is one struct column.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.util import WHITE, blocks

WINDOW = 8  # words in a window for n_repeat_words
BLOCK_BYTES = 1 << 20  # text handled at once in a task
SYMBOLS, UPPER = b"#*$%&|<>", bytes(range(65, 91))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_bang")
LEDGER_TYPE = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])

#: Rule name -> failure test over the measurements; the position is the bit, so only append.
RULES = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "100 * n_symbols > 10 * word_chars",
    "upper_case": "100 * n_upper > 40 * word_chars",
    "exclamations": "100 * n_bang > 50 * n_words",
    "repeated_lines": "n_lines >= 4 and 100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
}
BIT = {name: 1 << i for i, name in enumerate(RULES)}
BASE = ("few_words", "repeated_windows")
#: Version -> the rules that reject a document.
POLICIES = {"base": BASE, "v1": (*BASE, "symbols", "upper_case"), "v2": tuple(RULES)}


def mask(rules) -> int:
    return sum(BIT[r] for r in rules)


def repeated_window_words(codes: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word, whether it is in an 8-word window that its document holds twice or more.

    ``codes``: word numbers of all documents in a row, ``doc``: their document, ``ends``: for each
    word, the end of its document. Windows get numbers by doubling (1, 2, 4, 8 words), which is exact.
    """
    n = len(codes)
    hit = np.zeros(n, dtype=bool)
    if n < WINDOW:
        return hit
    code, width = codes.astype(np.int64), 1
    while width < WINDOW:
        code = pd.factorize(code[:-width] * (int(code.max()) + 1) + code[width:])[0].astype(np.int64)
        width *= 2
    at = np.flatnonzero(ends[: len(code)] - np.arange(len(code)) >= WINDOW)
    key = pd.factorize(doc[at].astype(np.int64) * (int(code.max()) + 1) + code[at])[0]
    at = at[np.bincount(key)[key] > 1] if len(at) else at
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return np.cumsum(edge)[:n] > 0


def measure_block(texts: list[bytes], chars: list[int]) -> np.ndarray:
    """One row of MEASURES per text."""
    out = np.zeros((len(texts), len(MEASURES)), dtype=np.int64)
    words: list[bytes] = []
    for i, (t, cp) in enumerate(zip(texts, chars, strict=True)):
        own = t.split()
        words += own
        lines = [x for x in t.split(b"\n") if x.strip(WHITE)]
        out[i] = (len(own), cp - (len(t) - sum(map(len, own))), len(t) - len(t.translate(None, SYMBOLS)), len(lines),
                  len(lines) - len(set(lines)), 0, len(t) - len(t.translate(None, UPPER)), t.count(b"!"))
    if words:
        n = out[:, 0]
        doc = np.repeat(np.arange(len(texts)), n)
        codes = pd.factorize(np.array(words, dtype=object))[0]
        hit = repeated_window_words(codes, np.cumsum(n)[doc], doc)
        out[:, 5] = np.bincount(doc[hit], minlength=len(texts))
    return out


@F.pandas_udf(LEDGER_TYPE)
def _measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        chars = [len(t) if isinstance(t, str) else 0 for t in batch]
        parts = [measure_block(b, chars[i:i + len(b)]) for i, b in blocks(batch, BLOCK_BYTES)]
        yield pd.DataFrame(np.concatenate(parts) if parts else np.zeros((0, len(MEASURES)), np.int64), columns=MEASURES)


def fail_bits(row: str = "") -> Column:
    """The failure bits from measurement columns (or fields of struct column ``row``)."""
    def test(rule: str) -> Column:
        for m in MEASURES:
            rule = rule.replace(m, f"{row}.{m}") if row else rule
        return F.expr(rule)
    bits = F.lit(0).cast("long")
    for name, rule in RULES.items():
        bits = bits.bitwiseOR(F.when(test(rule), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(df: DataFrame, text: str = "text", to: str = "ledger") -> DataFrame:
    """``df`` with struct column ``to``: the measurements and ``fail_bits``. One pass over the texts, no shuffle."""
    tmp = f"__{to}_measures"
    out = df.withColumn(tmp, _measure(F.col(text)))
    fields = [F.col(f"{tmp}.{m}").alias(m) for m in MEASURES]
    return out.withColumn(to, F.struct(*fields, fail_bits(tmp).alias("fail_bits"))).drop(tmp)


def passes(bits, policy: str = "v2") -> Column:
    """Whether the failure bits have none of the policy's rules."""
    return F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ablations(led: DataFrame, policy: str = "v2", bits: str = "ledger.fail_bits") -> DataFrame:
    """For each rule of a policy: n_failed, and n_only, the documents that would come back without it.

    Documents are first counted by failure bits (at most 2^rules rows), so the corpus is read once."""
    by = led.groupBy(F.col(bits).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")).alias("bits")).count()
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).cast("long").alias("bit")) for r in POLICIES[policy]])).alias("r")
    has = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (by.select("bits", "count", rules).groupBy(F.col("r.rule").alias("rule"))
            .agg(F.sum(F.when(has, F.col("count")).otherwise(0)).alias("n_failed"),
                 F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("count")).otherwise(0)).alias("n_only")))
