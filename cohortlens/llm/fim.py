"""Fill-in-the-middle: documents cut into prefix, middle and suffix and put together in another order.

Repeated-capture matching: one ``fullmatch`` of ``(unit)*`` by the regex library keeps every repetition of
the group, so that ``ends(1)`` tells the number of units and, by plain indexing, both cut offsets; no
loop walks the text. A unit matches at every place of any text in one way only (``UNITS``: code points,
words with their white space, lines), so the match never backtracks. A kept repetition takes about 180 bytes while it
is matched, so a text over ``WINDOW`` code points is matched in runs of that many units, each from the last one's end.

The draws are the first four 8-digit groups of sha256("seed:id") and need no random state, so that reruns and
lost executors give the same rows. Which documents stay plain, the cuts and the order follow from
them: ``plain`` for an empty text, one that holds a sentinel, or by chance; else ``spm`` or ``psm``.

Defined results: a null text is empty; a null id is drawn as an empty id; rows with equal ids have equal
draws and are each rewritten on their own; an empty table gives no rows. All columns stay; a struct column of the name ``to`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The sentinels.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
PLAIN_FROM, SPM_BELOW = 90, 20  # of 100
#: What the cuts fall between.
UNITS = {"char": r"(.)", "word": r"(\s*+\S++\s*+|\s++)", "line": r"([^\n]*+\n|[^\n]++)"}
WINDOW = 1 << 19  # units matched at once
FIM = T.StructType([T.StructField("output", T.StringType()), T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
                    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType())])


def ends(text: str, unit: str) -> list[int] | np.ndarray:
    """The end of every unit."""
    if len(text) <= WINDOW:
        return regex.fullmatch(f"{unit}*", text, regex.DOTALL).ends(1)
    runs, at, run = [], 0, regex.compile(f"{unit}{{0,{WINDOW}}}+", regex.DOTALL)
    while at < len(text):
        runs.append(np.array(run.match(text, at).ends(1), dtype=np.int64))
        at = int(runs[-1][-1])
    return np.concatenate(runs)


def cut(text: str, unit: str, draws: tuple[int, int, int, int]) -> tuple[str, int, str, int | None, int | None]:
    """(output, units, form, prefix code points, middle code points) of one text."""
    at = ends(text, unit)
    n = len(at)
    h1, h2, h3, h4 = draws
    if not text or h3 % 100 >= PLAIN_FROM or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return text, n, "plain", None, None
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = int(at[first - 1]) if first else 0, int(at[second - 1]) if second else 0
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < SPM_BELOW:
        return f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}", n, "spm", a, b - a
    return f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}", n, "psm", a, b - a


def draws(ident: Column, seed: int = SEED) -> list[Column]:
    """The four numbers of an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(df: DataFrame, id_col: str = "doc_id", text: str = "text", unit: str = "char", seed: int = SEED, to: str = "fim") -> DataFrame:
    """``df`` with struct column ``to``: output, n (units), form, prefix_chars and middle_chars (code points; null if plain)."""
    one = UNITS[unit]

    @F.pandas_udf(FIM)
    def rewrite(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts, *numbers in batches:
            rows = [cut(t, one, h) for t, *h in zip(texts, *numbers, strict=True)]
            out = pd.DataFrame(rows, columns=FIM.names)
            yield out.astype({"n": "int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return df.withColumn(to, rewrite(F.coalesce(F.col(text), F.lit("")), *draws(F.col(id_col), seed)))


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made of. Texts with a sentinel stay plain, so the first of each sentinel is ours."""
    def part(after: str, before: str | None) -> Column:
        rest = F.substring_index(output, after, -1)
        return F.substring_index(rest, before, 1) if before else rest
    middle = part(MIDDLE, None)
    return (F.when(form == "psm", F.concat(part(PREFIX, SUFFIX), middle, part(SUFFIX, MIDDLE)))
            .when(form == "spm", F.concat(part(PREFIX, MIDDLE), middle, part(SUFFIX, PREFIX))).otherwise(output))
