"""Tables behind the figures (CH1-CH3; CH4-CH7 are the sweep, comparison, shares and
correlation tables). Drawing is not part of the engine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.rules import cluster_name
from cohortlens.operators.clean import sample_rows


def scatter_series(df: DataFrame, pairs: Sequence[tuple[str, str]], colour: str | None = None) -> DataFrame:
    """CH1: long-form (pair, x, y[, colour]) for every feature pair."""
    parts = []
    for x, y in pairs:
        cols = [F.lit(f"{x} vs {y}").alias("pair"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")]
        if colour:
            cols.append(F.col(colour).cast("double").alias("colour"))
        parts.append(df.select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def cluster_scatter(labelled: DataFrame, pairs: Sequence[tuple[str, str]], cluster: str = "cluster") -> DataFrame:
    """CH2: (pair, x, y, cluster name, rows in that cluster). Sizes come from a partial aggregate
    (k rows) joined back instead of a window
    partitioned by cluster, which would put a cluster holding a third of the rows in one task."""
    sizes = labelled.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_in_cluster"))
    base = labelled.join(sizes, cluster).withColumn("cluster_name", cluster_name(F.col(cluster)))
    parts = [base.select(F.lit(f"{x} vs {y}").alias("pair"), F.col(x).cast("double").alias("x"),
                         F.col(y).cast("double").alias("y"), "cluster_name", "n_in_cluster") for x, y in pairs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scatter3d(labelled: DataFrame, id_col: str, cols: Sequence[str], n: int = 1000, seed: int = 42,
              cluster: str = "cluster") -> DataFrame:
    """CH3: at most n rows for the 3-D view (seeded hash sample) and a flag telling whether it is a sample."""
    total = labelled.select(F.count(F.lit(1))).scalar()
    s = sample_rows(labelled, id_col, n, seed)
    return s.select(id_col, *cols, cluster, (total > F.lit(n)).alias("sampled"))
