"""CL6 / CL7: population standardisation and the feature vector."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scaler_stats(df: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std of each feature: one aggregate job, one row to the driver."""
    aggs = []
    for f in features:
        aggs += [F.avg(F.col(f).cast("double")).alias(f"m_{f}"), F.stddev_pop(F.col(f).cast("double")).alias(f"s_{f}")]
    row = df.agg(*aggs).first()
    return {f: (row[f"m_{f}"], row[f"s_{f}"]) for f in features}


def scaled_columns(features: Sequence[str], stats: dict[str, tuple[float, float]], prefix: str = "z_") -> list[Column]:
    """(x - mean) / std_pop; a constant column (std 0) scales to 0 (the library rule)."""
    out = []
    for f in features:
        mean, std = stats[f]
        if std is None or std == 0.0 or mean is None:
            out.append(F.lit(0.0).alias(prefix + f))
        else:
            out.append(((F.col(f).cast("double") - F.lit(mean)) / F.lit(std)).alias(prefix + f))
    return out


def scale_features(df: DataFrame, features: Sequence[str], keep: Sequence[str] = (), prefix: str = "z_") -> tuple[DataFrame, list[str]]:
    """CL6: returns (frame with ``keep`` columns + scaled features, scaled column names)."""
    stats = scaler_stats(df, features)
    cols = scaled_columns(features, stats, prefix)
    return df.select(*[F.col(k) for k in keep], *cols), [prefix + f for f in features]


def feature_vector(df: DataFrame, features: Sequence[str], name: str = "features") -> DataFrame:
    """CL7: the features, in order, as one array<double> column."""
    return df.withColumn(name, F.array(*[F.col(f).cast("double") for f in features]))


def scaled_sql(source: str, id_col: str, features: Sequence[str], prefix: str = "z_") -> str:
    """SQL twin: ``source`` is a relation name or a parenthesised query."""
    stats = ", ".join(f"AVG({f}) AS m_{i}, STDDEV_POP({f}) AS s_{i}" for i, f in enumerate(features))
    cols = ", ".join(
        f"CASE WHEN st.s_{i} = 0 OR st.s_{i} IS NULL THEN 0.0 ELSE (src.{f} - st.m_{i}) / st.s_{i} END AS {prefix}{f}"
        for i, f in enumerate(features))
    return f"(SELECT src.{id_col}, {cols} FROM {source} src, (SELECT {stats} FROM {source} x) st)"
