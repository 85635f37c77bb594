"""Cleaning and row operators: CL1-CL5, CL8-CL16.

Global guards (\"does any feature hold Inf?\") and fences are scalar subqueries: evaluated once
by Spark, no driver round trip and no single-partition window.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.operators.quantile import exact_quantiles

INF = float("inf")


def _missing(c: str):
    col = F.col(c)
    return col.isNull() | F.isnan(col.cast("double"))


def _is_inf(c: str):
    col = F.col(c).cast("double")
    return (col == F.lit(INF)) | (col == F.lit(-INF))  # by equality: NaN > Inf is true in Spark


def null_report(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """CL1: null/NaN count per feature, long form (feature, null_count) — one aggregate pass."""
    wide = df.agg(*[F.sum(_missing(f).cast("long")).alias(f"n{i}") for i, f in enumerate(features)])
    pairs = ", ".join(f"'{f}', n{i}" for i, f in enumerate(features))
    return wide.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, null_count)").select(
        "feature", F.coalesce(F.col("null_count"), F.lit(0)).cast("long").alias("null_count"))


def drop_missing(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """CL2: drop rows with a null/NaN feature; nulls elsewhere are kept."""
    return df.na.drop(subset=list(features))


def inf_rows(df: DataFrame, features: Sequence[str]):
    """CL3 (as a Column): a row has +/-Inf in some feature."""
    out = F.lit(False)
    for f in features:
        out = out | F.coalesce(_is_inf(f), F.lit(False))
    return out


def inf_report(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """CL3: number of rows with +/-Inf in any feature."""
    return df.agg(F.count_if(inf_rows(df, features)).cast("long").alias("inf_rows"))


def drop_inf(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """CL4: only when some feature holds +/-Inf, every floating column's +/-Inf becomes null,
    then rows with a null feature are dropped. The guard is one scalar subquery."""
    has_inf = df.select(F.max(inf_rows(df, features).cast("int"))).scalar() == F.lit(1)
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [F.when(has_inf & _is_inf(c), F.lit(None).cast(df.schema[c].dataType)).otherwise(F.col(c)).alias(c)
            if c in floating else F.col(c) for c in df.columns]
    return df.select(*cols).na.drop(subset=list(features))


def outlier_report(df: DataFrame, features: Sequence[str], multiplier: float = 3.0, approx: bool = False,
                   accuracy: int = 100000) -> DataFrame:
    """CL5: per feature Q1, Q3 (linear interpolation), fences and the count strictly outside.
    Rows are only counted, never removed. The exact quartiles come from ``exact_quantiles``
    (bounded memory per task, d result rows); ``approx=True`` uses ``percentile_approx``."""
    if approx:
        fences = df.agg(*[x for i, f in enumerate(features) for x in (
            F.percentile_approx(F.col(f).cast("double"), [0.25, 0.75], accuracy).alias(f"q_{i}"),)]).first()
        qv = {f: fences[f"q_{i}"] for i, f in enumerate(features)}
    else:
        qv = {r["feature"]: r["q"] for r in exact_quantiles(df, features, [0.25, 0.75]).collect()}  # d rows
    q1 = [F.lit(qv.get(f, [None, None])[0]).cast("double") for f in features]
    q3 = [F.lit(qv.get(f, [None, None])[1]).cast("double") for f in features]
    m = F.lit(float(multiplier))
    wide = df.agg(*[x for i, f in enumerate(features) for x in (
        F.count_if((F.col(f).cast("double") < q1[i] - m * (q3[i] - q1[i]))
                   | (F.col(f).cast("double") > q3[i] + m * (q3[i] - q1[i]))).cast("long").alias(f"n_{i}"),
        q1[i].alias(f"q1_{i}"), q3[i].alias(f"q3_{i}"))])
    pairs = ", ".join(f"'{f}', q1_{i}, q3_{i}, n_{i}" for i, f in enumerate(features))
    long = wide.selectExpr(f"stack({len(features)}, {pairs}) AS (feature, q1, q3, n_outliers)")
    return long.select("feature", "q1", "q3", (F.col("q1") - m * (F.col("q3") - F.col("q1"))).alias("lower_fence"),
                       (F.col("q3") + m * (F.col("q3") - F.col("q1"))).alias("upper_fence"), "n_outliers")


def clip(col: str, lo: float, hi: float):
    """CL9: limit to [lo, hi]; null and NaN stay missing (greatest/least alone would skip the null and take NaN as largest)."""
    c = F.col(col)
    return F.when(c.isNull() | F.isnan(c.cast("double")), c).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), c)))


def truncate_int(col: str):
    """CL10: truncate toward zero."""
    return F.col(col).cast("int")


def preview(df: DataFrame, id_col: str, n: int = 10) -> DataFrame:
    """CL13: first n rows in id order (distributed top-n)."""
    return df.orderBy(id_col).limit(n)


def sample_rows(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """CL14: n rows without replacement, deterministic: top-n by a seeded hash of the id
    (TakeOrdered keeps only n rows per task; nothing else leaves the executors)."""
    return df.orderBy(F.xxhash64(F.col(id_col), F.lit(seed)), id_col).limit(n)


def dense_index(df: DataFrame, order: Sequence, name: str = "row_index", start: int = 0, partitions: int | None = None) -> DataFrame:
    """Distributed 0.. (or start..) numbering in ``order`` — no single-partition window.

    Range-partition + sort within partitions, write to the checkpoint folder (pins the ids and
    survives executor loss), count rows per partition, then add the partition's offset (one row per
    partition, ``partitions`` at most, joined back) to the position inside it (monotonically_increasing_id's low 33 bits).
    """
    from cohortlens.session import materialize
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                         .withColumn("_mid", F.monotonically_increasing_id()), "index")
    # one row per partition: their running sum is a window over that many rows, joined back
    part = F.shiftright("_mid", 33)
    counts = ranged.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_p")) - F.col("_n") + F.lit(start)
    offsets = counts.select("_p", before.alias("_before"))
    pos = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(offsets), part == offsets["_p"]).withColumn(name, (F.col("_before") + pos).cast("long")).drop("_mid", "_p", "_before")


INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def on_long_ids(fn):
    """Decorator for an operator (df, id_col, ...) -> frame with id_col that works on integer ids: ids of any
    other type are numbered in their order (so the smallest stays the smallest) and put back in the result."""
    @functools.wraps(fn)
    def run(df: DataFrame, id_col: str, *args, **kwargs):
        if df.schema[id_col].dataType.simpleString() in INTEGRAL:
            return fn(df, id_col, *args, **kwargs)
        ids = dense_index(df.select(id_col), [id_col], name="_rid")
        out = fn(df.join(ids, id_col).drop(id_col), "_rid", *args, **kwargs)
        return out.join(ids, "_rid").select(id_col, *[c for c in out.columns if c != "_rid"])
    return run


def shuffle_reid(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """CL15: permute rows by a seeded hash and give them new ids 1..n."""
    keyed = df.withColumn("_h", F.xxhash64(F.col(id_col), F.lit(seed)))
    return dense_index(keyed, [F.col("_h"), F.col(id_col)], name="new_id", start=1).drop("_h")
