"""Distance expressions over feature columns (native expressions, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sq_dist(cols: Sequence[Column], center: Sequence[float]) -> Column:
    """Squared Euclidean distance of the row's features to a literal center."""
    terms = [(c - F.lit(float(v))) * (c - F.lit(float(v))) for c, v in zip(cols, center)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def nearest(cols: Sequence[Column], centers: Sequence[Sequence[float]]) -> tuple[Column, Column]:
    """(index of the nearest center, its squared distance); ties go to the lowest index."""
    best = F.array_min(F.array(*[F.struct(sq_dist(cols, c).alias("d"), F.lit(j).alias("j")) for j, c in enumerate(centers)]))
    return best["j"], best["d"]

