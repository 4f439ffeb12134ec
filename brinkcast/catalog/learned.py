"""Queries that train a model; checked by rows and in the tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from brinkcast.catalog.core import case, panes_of, r9, r9sql, spine_of, windows_of
from brinkcast.catalog.scoring import scored_of
from brinkcast.functions.keys import FEATURE_COLUMNS
from brinkcast.operators import models as MD
from brinkcast.operators import windows as WN


def _rows(spark, d):
    """Features and outcome of each window."""
    panes = panes_of(spark, d)
    feats = WN.features_from_panes(panes, spine_of(spark, d)).withColumnRenamed("h", "window_start")
    out = WN.outcomes_from_panes(panes, windows_of(spark, d))
    return out.join(feats, "window_start").checkpoint()


# The fit at the i-th score is the largest, over starts j <= i, of the least mean of
# rows j to k over ends k >= i.
@case(
    "m03_isotonic",
    f"""select {r9sql('prob', 'calibrated')} from chosen join (
          select x, least(1.0, greatest(0.0, max(low))) as calibrated from (
            select b.x, min((b.cs - a.cs + a.s) / (b.cw - a.cw + a.w)) over (partition by a.x order by b.x desc) as low
            from sums a join sums b on b.x >= a.x) group by x) on prob = x""",
    chosen="select prob, label from scored where target = 'c2_4' and model_version = 'trailing-mix-1'",
    sums="""select x, s, w, sum(s) over (order by x) as cs, sum(w) over (order by x) as cw
        from (select prob as x, sum(label)::double as s, count(*)::double as w from chosen group by 1)""",
)
def _(spark, d):
    rows = scored_of(spark, d).where("target = 'c2_4' and model_version = 'trailing-mix-1'").checkpoint()
    model = MD.fit_isotonic(rows)
    return r9(MD.apply_isotonic(model, rows).select("prob", "calibrated"), "prob", "calibrated")


def _trained(rows):
    return MD.train_threshold(rows, list(FEATURE_COLUMNS), 4, seed=1)


@case("m05_train_threshold")
def _(spark, d):
    model = _trained(_rows(spark, d))
    names = sorted(model.report)
    return spark.range(1).select(*[F.lit(float(model.report[n])).alias(n) for n in names])


@case("m06_score_model")
def _(spark, d):
    rows = _rows(spark, d)
    return MD.model_prediction_rows(_trained(rows), rows, "boosted-4", "trailing-5").drop("payload")
