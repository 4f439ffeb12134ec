"""Machine/human agreement.  All figures come from the small table of level pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinkcast.functions.text import preview_text
from brinkcast.schemas import LEVELS

# Limits of the go / no-go decision.
KAPPA_MIN = 0.70
KAPPA_HIGH_MIN = 0.50
MAE_MAX = 0.60
BIAS_MAX = 0.30
HIGH_LEVEL = 4


def level_cells(pairs: DataFrame, by: list[str] | None = None, a: str = "llm_level", b: str = "human_level") -> DataFrame:
    """Count of each (a, b) pair per group; everything below works on this."""
    return pairs.groupBy(*(by or []), F.col(a).alias("a"), F.col(b).alias("b")).agg(
        F.count("*").alias("n")
    )


def agreement_of_cells(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Kappa, MAE and bias per group from cell counts, in one flow.

    Cells where a level is missing count as ``n_skipped`` only.  Kappa is
    unweighted, and 0 when undefined (no pair, or one class).
    """
    by = by or []
    zero = F.lit(0).cast("long")
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    n, gap = F.col("n"), (F.col("a") - F.col("b")).cast("long")

    def side(level: str, **sums: Column) -> Column:
        names = ("na", "nb", "same", "gap", "abs_gap", "skipped")
        return F.struct(
            F.col(level).cast("int").alias("level"),
            *[F.coalesce(sums.get(k, zero), zero).cast("long").alias(k) for k in names],
        )

    sides = F.array(
        side(
            "a",
            na=F.when(both, n),
            same=F.when(both & (F.col("a") == F.col("b")), n),
            gap=gap * n,
            abs_gap=F.abs(gap) * n,
            skipped=F.when(~both, n),
        ),
        side("b", nb=F.when(both, n)),
    )
    margins = (
        cells.select(*by, F.explode(sides).alias("side")).select(*by, "side.*").groupBy(*by, "level")
        .agg(*[F.sum(c).alias(c) for c in ("na", "nb", "same", "gap", "abs_gap", "skipped")])
    )
    out = margins.groupBy(*by).agg(
        *[F.sum(c).cast("double").alias(c) for c in ("na", "same", "gap", "abs_gap", "skipped")],
        F.sum(F.col("na").cast("double") * F.col("nb").cast("double")).alias("cross"),
    )
    total = F.col("na")
    po, pe = F.col("same") / total, F.col("cross") / (total * total)
    some = total > 0

    def known(x: Column) -> Column:
        return F.coalesce(F.when(some, x), F.lit(0.0))

    return out.select(
        *by,
        F.coalesce(total, F.lit(0.0)).cast("long").alias("n"),
        F.coalesce("skipped", F.lit(0.0)).cast("long").alias("n_skipped"),
        known(F.when(pe < 1.0, (po - pe) / (F.lit(1.0) - pe))).alias("kappa"),
        known(F.col("abs_gap") / total).alias("mae"),
        known(F.col("gap") / total).alias("bias"),
    )


def cohens_kappa(pairs: DataFrame, by: list[str] | None = None, a: str = "llm_level", b: str = "human_level") -> DataFrame:
    """Unweighted kappa per group: ``n``, ``kappa``."""
    return agreement_of_cells(level_cells(pairs, by, a, b), by).select(*(by or []), "n", "kappa")


def ordinal_mae(pairs: DataFrame, by: list[str] | None = None, a: str = "llm_level", b: str = "human_level") -> DataFrame:
    """Mean absolute level difference, 0 without pairs."""
    gap = F.abs(F.col(a) - F.col(b)).cast("double")
    return pairs.groupBy(*(by or [])).agg(F.coalesce(F.avg(gap), F.lit(0.0)).alias("mae"))


def signed_bias(pairs: DataFrame, by: list[str] | None = None, a: str = "llm_level", b: str = "human_level") -> DataFrame:
    """Mean of machine minus human, 0 without pairs."""
    gap = (F.col(a) - F.col(b)).cast("double")
    return pairs.groupBy(*(by or [])).agg(F.coalesce(F.avg(gap), F.lit(0.0)).alias("bias"))


def confusion_matrix(pairs: DataFrame, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """Machine levels down, human levels across, zero cells kept, totals in a
    ``total`` column and a row named ``total``."""
    inside = pairs.where(F.col("llm_level").isin(*levels) & F.col("human_level").isin(*levels))
    counts = inside.rollup("llm_level").agg(
        F.grouping("llm_level").alias("is_total"),
        *[F.count_if(F.col("human_level") == x).alias(f"human_{x}") for x in levels],
        F.count("*").alias("total"),
    )
    counts = counts.select(
        F.when(F.col("is_total") == 1, F.lit("total")).otherwise(F.col("llm_level").cast("string")).alias("llm_level"),
        *[f"human_{x}" for x in levels],
        "total",
    )
    names = F.array(*[F.lit(str(x)) for x in levels], F.lit("total"))
    spine = pairs.sparkSession.range(1).select(F.explode(names).alias("llm_level"))
    return spine.join(counts, "llm_level", "left").select(
        "llm_level",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in [*[f"human_{x}" for x in levels], "total"]],
    )


def level_diagnostics(pairs: DataFrame, level: int = 4, levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """How often either side gives the level, and what the machine said where the
    human gave it and the machine did not: one ``missed_as_*`` column per level."""
    miss = (F.col("human_level") == level) & (F.col("llm_level") != level)
    return pairs.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("human_level") == level).alias("n_human"),
        F.count_if(F.col("llm_level") == level).alias("n_machine"),
        F.count_if(miss).alias("n_missed"),
        *[F.count_if(miss & (F.col("llm_level") == x)).alias(f"missed_as_{x}") for x in levels if x != level],
    )


def validation_report(pairs: DataFrame) -> DataFrame:
    """One row: counts, agreement figures, failures and the decision."""
    scopes = F.explode(
        F.when(F.col("b") >= HIGH_LEVEL, F.array(F.lit("all"), F.lit("high"))).otherwise(F.array(F.lit("all")))
    )
    scoped = level_cells(pairs).withColumn("scope", scopes)
    figures = agreement_of_cells(scoped, ["scope"])

    def of(scope: str, column: str, default) -> Column:
        return F.coalesce(F.max(F.when(F.col("scope") == scope, F.col(column))), F.lit(default))

    n = F.col("n_paired")
    enough = F.col("n_high_levels") >= 2
    row = figures.agg(
        of("all", "n", 0).alias("n_paired"),
        of("high", "n", 0).alias("n_high_levels"),
        of("all", "kappa", 0.0).alias("kappa_global"),
        of("high", "kappa", 0.0).alias("kappa_high_levels"),
        of("all", "mae", 0.0).alias("mae_ordinal"),
        of("all", "bias", 0.0).alias("signed_bias"),
    ).withColumn("kappa_high_levels", F.when(enough, F.col("kappa_high_levels")).otherwise(0.0))
    checks = F.array_compact(
        F.array(
            F.when(F.col("kappa_global") < KAPPA_MIN, F.lit(f"kappa_global<{KAPPA_MIN}")),
            F.when(enough & (F.col("kappa_high_levels") < KAPPA_HIGH_MIN), F.lit(f"kappa_levels_4_6<{KAPPA_HIGH_MIN}")),
            F.when(F.col("mae_ordinal") >= MAE_MAX, F.lit(f"mae_ordinal>={MAE_MAX}")),
            F.when(F.abs("signed_bias") >= BIAS_MAX, F.lit(f"abs_bias>={BIAS_MAX}")),
        )
    )
    row = row.withColumn("failures", F.when(n == 0, F.array(F.lit("empty_dataset"))).otherwise(checks))
    failed = F.size("failures")
    decision = (
        F.when(n == 0, "no_go").when(failed == 0, "go").when(failed >= 3, "no_go").otherwise("partial")
    )
    return row.withColumn("decision", decision)


def audit_summary(labels: DataFrame) -> DataFrame:
    """Audit rows (levels as read, maybe missing): n, skipped, kappa, MAE, bias in one row."""
    read = labels.select(
        F.col("llm_level").try_cast("int").alias("llm_level"),
        F.col("human_level").try_cast("int").alias("human_level"),
    )
    return agreement_of_cells(level_cells(read)).select("n", "n_skipped", "kappa", "mae", "bias")


def mismatches(pairs: DataFrame, texts: DataFrame | None = None, case: int = 4, width: int = 140) -> DataFrame:
    """Pairs with different levels, widest gap first, with a one-line text preview."""
    rows = pairs.where("llm_level <> human_level")
    if texts is not None:
        rows = rows.join(texts.select("item_id", "clean_text"), "item_id", "left")
    return rows.select(
        "item_id",
        "llm_level",
        "human_level",
        F.abs(F.col("llm_level") - F.col("human_level")).alias("gap"),
        ((F.col("llm_level") == case) | (F.col("human_level") == case)).alias(f"level_{case}_case"),
        preview_text(F.col("clean_text"), width).alias("preview"),
    ).orderBy(F.desc("gap"), "item_id")
