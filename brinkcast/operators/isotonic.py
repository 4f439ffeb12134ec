"""Isotonic regression over any number of rows: pooled within ranges, then across them.

Pooling adjacent violators gives the same fit in whichever order neighbours are
pooled.  So rows are pooled into one per distinct score, cut into ranges of the
score, and pooled within each range; ranges are then joined some at a time, and only
the blocks that are left travel.  Nothing is collected.

The last task holds the blocks of the fit itself.  Their number is bounded: the
blocks of n labels 0 and 1 are the edges of a convex lattice chain in an n by n square,
which has at most some 3 * n ** (2/3) edges (a million windows: 30,000).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinkcast.functions.scores import clip
from brinkcast.operators.ordered import _carried, ranged, stored

_BLOCK = "part int, lo double, hi double, s double, w double"


def _whole(values: pd.Series) -> list:
    """Whole numbers as integers, whose products are exact at any size."""
    return [int(v) if float(v).is_integer() else v for v in values.tolist()]


def _pool(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pool rows that come in order of (part, lo); only open blocks are held."""
    part, blocks = None, []

    def done() -> pd.DataFrame:
        lo, hi, s, w = zip(*blocks)
        return pd.DataFrame({"part": part, "lo": lo, "hi": hi, "s": [float(x) for x in s], "w": [float(x) for x in w]})

    for batch in batches:
        rows = zip(batch["part"].tolist(), batch["lo"].tolist(), batch["hi"].tolist(), _whole(batch["s"]), _whole(batch["w"]))
        for p, lo, hi, s, w in rows:
            if p != part:
                if blocks:
                    yield done()
                part, blocks = p, []
            while blocks and blocks[-1][2] * w >= s * blocks[-1][3]:
                left = blocks.pop()
                lo, s, w = left[0], left[2] + s, left[3] + w
            blocks.append((lo, hi, s, w))
    if blocks:
        yield done()


def isotonic_blocks(
    df: DataFrame, prob: str = "prob", label: str = "label", parts: int | None = None, fan_in: int = 16
) -> DataFrame:
    """The monotone fit of ``label`` on ``prob`` as blocks of equal value, stored.

    A block covers scores from ``lo`` to ``hi``; ``next_lo`` and ``next_value`` are those
    of the block after it.  Rows without score or label, or with NaN, are left out;
    without rows there are no blocks.
    """
    x, y = F.col(prob).cast("double"), F.col(label).cast("double")
    clean = df.where(x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y))
    pooled = clean.groupBy((x + F.lit(0.0)).alias("x")).agg(F.sum(y).alias("s"), F.count("*").cast("double").alias("w"))
    rows = ranged(pooled, [F.col("x").asc()], parts)
    left = rows.agg(F.max("_part")).first()[0]
    blocks = rows.select(F.col("_part").alias("part"), F.col("x").alias("lo"), F.col("x").alias("hi"), "s", "w")
    blocks = blocks.sortWithinPartitions("part", "lo").mapInPandas(_pool, _BLOCK)
    while left:  # number of the last range: 0 is the only one
        left //= fan_in
        joined = blocks.withColumn("part", F.floor(F.col("part") / fan_in).cast("int"))
        blocks = joined.repartition("part").sortWithinPartitions("part", "lo").mapInPandas(_pool, _BLOCK)
    fit = blocks.select("part", "lo", "hi", (F.col("s") / F.col("w")).alias("value"))
    after = W.partitionBy("part").orderBy("lo")
    return stored(
        fit.select(
            "lo", "hi", "value",
            F.lead("lo").over(after).alias("next_lo"), F.lead("value").over(after).alias("next_value"),
        )
    )


def isotonic_values(blocks: DataFrame, scores: DataFrame, x: str, parts: int | None = None) -> DataFrame:
    """The fit at each distinct score: ``x`` and ``fitted``.

    Between blocks the fit is a straight line, outside of them the end value; NULL for
    scores that are NULL or NaN, and without blocks.
    """
    block = F.struct("lo", "hi", "value", "next_lo", "next_value")
    asked = scores.select(F.col(x).cast("double").alias("x")).where("x is not null and not isnan(x)").distinct()
    marks = blocks.select(F.col("lo").alias("x"), F.lit(0).alias("asked"), block.alias("b"))
    rows = asked.select("x", F.lit(1).alias("asked"), F.lit(None).cast(marks.schema["b"].dataType).alias("b"))
    rows = ranged(marks.unionByName(rows), [F.col("x").asc(), F.col("asked").asc()], parts)
    upto = W.partitionBy("_part").orderBy("x", "asked").rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumn("here", F.last("b", ignorenulls=True).over(upto)).where("asked = 1")
    ends = rows.groupBy("_part").agg(F.max("b").alias("b"))  # one row a range
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select("_part", F.last("b", ignorenulls=True).over(before).alias("carried"))
    first = blocks.agg(F.min(F.struct("lo", "value")).alias("f")).select(F.col("f.value").alias("first"))
    b = F.coalesce("here", "carried")
    slope = (b["next_value"] - b["value"]) / (b["next_lo"] - b["hi"])
    inside = F.when((F.col("x") <= b["hi"]) | b["next_lo"].isNull(), b["value"]).otherwise(
        b["value"] + slope * (F.col("x") - b["hi"])
    )
    return _carried(local, carried, ["_part"]).select(
        F.col("x").alias(x), F.coalesce(inside, first.scalar()).alias("fitted")
    )


def with_isotonic(blocks: DataFrame, df: DataFrame, prob: str = "prob", name: str = "calibrated") -> DataFrame:
    """``df`` with the fit at ``prob``, within 0 and 1.

    Looked up once a distinct score, so a score that a third of all rows share costs
    one look-up; rows then meet their score in a join that adaptive execution splits.
    """
    values = isotonic_values(blocks, df, prob).select(F.col(prob).alias("_x"), F.col("fitted").alias("_fitted"))
    out = df.join(values, F.col(prob).cast("double") == F.col("_x"), "left")
    return out.withColumn(name, F.when(F.col("_fitted").isNotNull(), clip(F.col("_fitted"), 0.0, 1.0))).drop("_x", "_fitted")
