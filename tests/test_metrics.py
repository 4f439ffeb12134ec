"""Forecast scores against hand values and a plain-Python reading of the definitions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinkcast.functions.scores import bin_edges
from brinkcast.operators import drift as D
from brinkcast.operators import metrics as M
from brinkcast.operators.ordered import exact_quantiles, previous_value, running_totals, time_rank

ROWS = "g string, prob double, label int"


def frame(spark, pairs, g="a"):
    return spark.createDataFrame([(g, float(p), int(y)) for p, y in pairs], ROWS)


def ap_by_hand(pairs):
    total = sum(y for _, y in pairs)
    if total in (0, len(pairs)):
        return 0.0
    out = tp = n = 0
    for s in sorted({p for p, _ in pairs}, reverse=True):
        here = [y for p, y in pairs if p == s]
        tp, n = tp + sum(here), n + len(here)
        out += sum(here) / total * tp / n
    return out


def test_ece_hand_value(spark):
    df = frame(spark, [(0.1, 0), (0.2, 0), (0.9, 1), (0.8, 1)])
    assert M.expected_calibration_error(df, bins=2).first()["ece"] == pytest.approx(0.15)


def test_ece_bin_borders(spark):
    # The borders are i * 0.1: 0.3, 0.6 and 0.7 lie just below theirs.
    df = frame(spark, [(0.3, 1), (0.6, 1), (0.7, 1), (1.0, 1), (0.0, 0)])
    bins = {r["confidence"]: r["bin"] for r in M.reliability_table(df).collect()}
    assert bins == {0.3: 2, 0.6: 5, 0.7: 6, 1.0: 9, 0.0: 0}
    assert bin_edges(10)[3] == 0.30000000000000004


def test_ece_counts_scores_outside_the_range(spark):
    row = M.expected_calibration_error(frame(spark, [(1.5, 1), (0.5, 0)])).first()
    assert (row["n"], row["ece"]) == (2, 0.25)
    assert M.expected_calibration_error(frame(spark, [])).first()["ece"] == 0.0


def test_average_precision(spark):
    df = frame(spark, [(0, 0), (0.1, 0), (0.9, 1), (1, 1)])
    assert M.average_precision(df).first()["auc_pr"] == 1.0
    assert M.average_precision(frame(spark, [(0.2, 1), (0.3, 1)])).first()["auc_pr"] == 0.0
    assert M.average_precision(frame(spark, [])).first()["auc_pr"] == 0.0


@pytest.mark.parametrize("parts", [None, 1, 3, 16])
def test_average_precision_is_the_same_for_any_ranges(spark, parts):
    rnd = random.Random(3)
    pairs = [(round(rnd.random() ** 3, 2), int(rnd.random() < 0.3)) for _ in range(400)]
    other = [(p, 1 - y) for p, y in pairs]
    df = frame(spark, pairs).union(frame(spark, other, "b"))
    got = {r["g"]: r["auc_pr"] for r in M.average_precision(df, ["g"], parts=parts).collect()}
    assert got["a"] == pytest.approx(ap_by_hand(pairs))
    assert got["b"] == pytest.approx(ap_by_hand(other))


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_running_totals_rank_and_previous_across_ranges(spark, parts):
    rows = [("a", float(i), 1 + i % 3) for i in range(60)] + [("b", 0.5 + i / 1000, 2) for i in range(40)] + [(None, 3.0, 5), (None, 4.0, 1), ("c", None, 9)]
    df = spark.createDataFrame(rows, "g string, x double, n int").repartition(3)
    got = {(r["g"], r["x"]): (r["cum_n"], r["total_n"]) for r in running_totals(df, ["g"], "x", ["n"], parts=parts).collect()}
    want = {(g, x): (sum(m for h, y, m in rows if h == g and y is not None and y <= x), sum(m for h, _, m in rows if h == g)) for g, x, _ in rows if x is not None}
    assert got == want
    down = running_totals(df, ["g"], "x", ["n"], descending=True, parts=parts).where("g = 'b'").orderBy("x").first()
    assert (down["cum_n"], down["total_n"]) == (80, 80)
    ranked = time_rank(df, "x", ["g", "n"], parts=parts).orderBy("rank").collect()
    assert [r["rank"] for r in ranked] == list(range(1, 103)) and {r["n_total"] for r in ranked} == {102}
    before = previous_value(df, "x", ["g", "n"], "n", "prev", parts=parts).join(df.sparkSession.createDataFrame([(r["g"], r["x"], r["rank"]) for r in ranked], "h string, y double, rank long"), [F.col("g").eqNullSafe(F.col("h")), F.col("x") == F.col("y")])
    assert [r["prev"] for r in before.orderBy("rank").collect()] == [None, *[r["n"] for r in ranked[:-1]]]
    empty = df.limit(0)
    assert running_totals(empty, ["g"], "x", ["n"], parts=parts).count() == 0 and time_rank(empty, "x", ["g"], parts=parts).count() == 0


def test_pr_curve_points(spark):
    df = frame(spark, [(0.1, 0), (0.4, 0), (0.35, 1), (0.8, 1)])
    got = sorted((r["threshold"] if r["threshold"] is not None else 9, r["precision"], r["recall"]) for r in M.pr_curve(df).collect())
    assert got == [(0.1, 0.5, 1.0), (0.35, pytest.approx(2 / 3), 1.0), (0.4, 0.5, 0.5), (0.8, 1.0, 0.5), (9, 1.0, 0.0)]


def test_brier(spark):
    assert M.brier_score(frame(spark, [(0.5, 1), (1.0, 0)])).first()["brier"] == 0.625


SCORED = "score_set string, target string, prob double, label int"


def scored(spark, rows):
    return spark.createDataFrame([("m", *r) for r in rows], SCORED)


def test_target_metrics_rules(spark):
    rows = [("c1", 1.0, 1), ("c1", 2.0, 2), ("c1", 3.0, 4), ("c2_3", 0.2, 1), ("c2_3", 0.4, 1)]
    rows += [("c3", 0.1, 0), ("c3", 0.9, 1)]
    got = {r["target"]: r for r in M.target_metrics(scored(spark, rows), ["score_set"]).collect()}
    assert got["c1"]["mae"] == pytest.approx(1 / 3) and got["c1"]["base_rate"] == pytest.approx(7 / 3)
    assert got["c1"]["auc_pr"] is None and got["c1"]["ece"] is None
    assert got["c2_3"]["auc_pr"] is None and got["c2_3"]["ece"] is None and got["c2_3"]["base_rate"] == 1.0
    assert got["c3"]["auc_pr"] == 1.0 and got["c3"]["base_rate"] == 0.5 and got["c3"]["mae"] is None
    assert got["c3"]["ece"] == pytest.approx(0.1)


def test_ranking_metrics(spark):
    rnd = random.Random(5)
    pairs = [(round(rnd.random(), 1), int(rnd.random() < 0.4)) for _ in range(120)]
    row = M.ranking_metrics(frame(spark, pairs)).first()
    pos = [p for p, y in pairs if y]
    neg = [p for p, y in pairs if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert row["auc_roc"] == pytest.approx(auc)
    best = max(
        2 * sum(y for p, y in pairs if p >= t) / (sum(p >= t for p, _ in pairs) + len(pos)) for t in {p for p, _ in pairs}
    )
    assert row["best_f1"] == pytest.approx(best)


def test_spearman_with_ties(spark):
    x, y = [1, 2, 2, 3, 5], [2, 1, 4, 4, 9]
    df = spark.createDataFrame(list(zip(map(float, x), map(float, y))), "x double, y double")
    ranks = lambda v: [sum(b < a for b in v) + (sum(b == a for b in v) + 1) / 2 for a in v]
    assert M.spearman(df, "x", "y").first()["rho"] == pytest.approx(np.corrcoef(ranks(x), ranks(y))[0, 1])


def psi_by_hand(e, a, bins=10):
    q = np.quantile(e, np.linspace(0, 1, bins + 1))
    q[0], q[-1] = -np.inf, np.inf
    ec, ac = np.histogram(e, q)[0], np.histogram(a, q)[0]
    ep, ap = (ec + 1) / (ec.sum() + bins), (ac + 1) / (ac.sum() + bins)
    return float(np.sum((ap - ep) * np.log(ap / ep)))


@pytest.mark.parametrize(
    "e, a",
    [
        ([float(i % 37) for i in range(300)], [float(i % 11) for i in range(200)]),
        ([5.0] * 40, [5.0] * 10 + [1.0] * 5 + [9.0] * 5),  # a constant column repeats its border
        ([0.5, 1.5], [2.0]),
    ],
)
def test_psi(spark, e, a):
    E = spark.createDataFrame([(v,) for v in e], "v double")
    A = spark.createDataFrame([(v,) for v in a], "v double")
    assert D.psi(E, A, "v").first()["psi"] == pytest.approx(psi_by_hand(e, a))


def test_psi_empty_side_is_zero(spark):
    one = spark.createDataFrame([(1.0,)], "v double")
    assert D.psi(one, one.limit(0), "v").first()["psi"] == 0.0
    assert D.psi(one.limit(0), one, "v").first()["psi"] == 0.0


def test_exact_quantiles(spark):
    rnd = random.Random(1)
    data = {"a": [rnd.gauss(0, 1) for _ in range(333)], "b": [float(i % 3) for i in range(50)], "c": [7.0]}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs], "g string, v double")
    qs = [0.1, 0.25, 0.5, 0.9]
    for r in exact_quantiles(df, "v", qs, ["g"]).collect():
        assert r["quantiles"] == pytest.approx(list(np.quantile(data[r["g"]], qs)))


def test_running_totals_over_ranges(spark):
    df = spark.createDataFrame([("a", float(i), 1) for i in range(20)] + [("b", 3.0, 5)], "g string, x double, n long")
    out = running_totals(df, ["g"], "x", ["n"], parts=4)
    got = {(r["g"], r["x"]): (r["cum_n"], r["total_n"]) for r in out.collect()}
    assert got[("b", 3.0)] == (5, 5)
    assert all(got[("a", float(i))] == (i + 1, 20) for i in range(20))


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1.0, 3.0, 4.0)], "v double")
    got = [r["n"] for r in M.histogram(df, "v", [0.0, 1.0, 2.0, 3.0]).orderBy("bin").collect()]
    assert got == [1, 1, 1]
    assert math.isclose(M.histogram(df, "v", [0.0, 3.0]).first()["hi"], 3.0)
