"""Vector expressions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_norm(vec: Column) -> Column:
    return F.sqrt(
        F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    )


def l2_normalize(vec: Column) -> Column:
    """Unit-length vector; a zero vector is returned as it is."""
    norm = l2_norm(vec)
    return F.when(norm > 0, F.transform(vec, lambda x: x.cast("double") / norm)).otherwise(
        F.transform(vec, lambda x: x.cast("double"))
    )
