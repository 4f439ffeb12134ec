"""Split, baselines, score sets and the report."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from brinkcast.operators import baselines as B
from brinkcast.operators.predictions import align_predictions, due_windows, latest_predictions, prediction_rows
from brinkcast.plans import backtest as BT

T0 = datetime(2026, 1, 1)
WINDOWS = (
    "window_start timestamp_ntz, window_end timestamp_ntz, v_max int, n_posts long, had_jump boolean, "
    "v_recent double, eco_mean_6h double, eco_n_6h long"
)
PREDS = (
    "made_at timestamp_ntz, window_start timestamp_ntz, window_end timestamp_ntz, model_version string, c1_value double, "
    "c2_3_prob double, c2_4_prob double, c2_5_prob double, c2_6_prob double, c3_prob double, c4_prob double, feature_hash string"
)


def w(hour, v_max=0, n=0, jump=False, recent=0.0, eco=0.0, eco_n=0):
    s = T0 + timedelta(hours=hour)
    return (s, s + timedelta(hours=2), v_max, n, jump, recent, eco, eco_n)


def pred(hour, model="m", c1=1.0, probs=(0.5,) * 6):
    s = T0 + timedelta(hours=hour)
    return (s, s, s + timedelta(hours=2), model, c1, *probs, "f" * 64)


def windows(spark, rows):
    return spark.createDataFrame(rows, WINDOWS)


def split(spark, rows, until):
    return BT.split_windows(windows(spark, rows), until)


def test_marginal_rates(spark):
    df = windows(spark, [w(0, 0, 1), w(2, 4, 2, True), w(4, 5, 0), w(6, 3, 1, True)])
    r = B.marginal_rates(df).first()
    assert tuple(r) == (0.75, 0.5, 0.25, 0.0, 0.5, 0.75)
    assert tuple(B.marginal_rates(df.limit(0)).first()) == (0.0,) * 6


def test_split_point_and_split(spark):
    one = windows(spark, [w(0)])
    assert B.default_split_point(one).first()[0] == T0 + timedelta(hours=2)
    five = windows(spark, [w(h) for h in (8, 0, 4, 2, 6)])
    assert B.default_split_point(five).first()[0] == T0 + timedelta(hours=4)
    got = [r["is_test"] for r in BT.split_windows(five, None).orderBy("window_start").collect()]
    assert got == [False, False, True, True, True]


def baseline(spark, rows, until):
    out = B.baseline_probs(split(spark, rows, until)).orderBy("window_start").collect()
    return {(r["score_set"], r["window_start"]): r for r in out}


def test_first_window_of_all_takes_the_rate(spark):
    got = baseline(spark, [w(0, 5), w(2, 2)], T0)
    first, second = got[("B3", T0)], got[("B3", T0 + timedelta(hours=2))]
    assert (first["c2_5_prob"], second["c2_5_prob"], second["c2_6_prob"]) == (0.0, 1.0, 0.0)


def test_previous_window_may_be_a_training_window(spark):
    got = baseline(spark, [w(0, 6), w(2, 0)], T0 + timedelta(hours=2))
    assert got[("B3", T0 + timedelta(hours=2))]["c2_6_prob"] == 1.0


def test_steps_of_b2_and_b4(spark):
    got = baseline(spark, [w(0), w(2, recent=4.5, eco=3.7)], T0 + timedelta(hours=2))
    t = T0 + timedelta(hours=2)
    assert (got[("B2", t)]["c2_4_prob"], got[("B2", t)]["c2_5_prob"]) == (1.0, 0.0)
    assert (got[("B4", t)]["c2_3_prob"], got[("B4", t)]["c2_4_prob"]) == (1.0, 0.0)
    assert got[("B2", t)]["c3_prob"] is None and got[("B1", t)]["c3_prob"] == 0.0


def test_previous_value_across_empty_days(spark):
    df = windows(spark, [w(0, 1), w(1, 2), w(80, 3), w(200, 4)])
    got = [r["prev_v_max"] for r in B.previous_v_max(df).orderBy("window_start").collect()]
    assert got == [None, 1, 2, 3]
    # Only windows that had ended by the start.
    got = [r["prev_v_max"] for r in B.previous_v_max(df, min_gap=True).orderBy("window_start").collect()]
    assert got == [None, None, 2, 3]


def test_score_sets(spark):
    rows = [w(0, 0, 1), w(2, 4, 2, True), w(4, 5, 1, True), w(6, 0, 0), w(8, -1, 0)]
    df = split(spark, rows, T0 + timedelta(hours=4))
    preds = spark.createDataFrame(
        [pred(4, c1=4.0, probs=(0.9, 0.8, 0.7, 0.2, 0.9, None)), pred(6, c1=1.0, probs=(0.1,) * 6), pred(8, c1=0.5, probs=(0.2,) * 6),
         pred(100), pred(100, "never")], PREDS,
    )
    got = {(r["score_set"], r["target"]): r for r in BT.score_sets(df, preds).collect()}
    assert len(got) == 4 * 6 + 2 * 7
    m = got[("m", "c2_5")]
    assert (m["n_test"], m["n"], m["auc_pr"], m["base_rate"]) == (3, 3, 1.0, pytest.approx(1 / 3))
    # A window without a labelled post counts as level 0.
    assert got[("m", "c1")]["mae"] == pytest.approx((1.0 + 1.0 + 0.5) / 3)
    assert got[("m", "c2_6")]["auc_pr"] is None and got[("m", "c2_6")]["base_rate"] == 0.0
    # A missing probability counts as 0, a missing target as absent.
    assert got[("m", "c4")]["n"] == 3
    b2 = got[("B2", "c3")]
    assert (b2["n"], b2["n_test"], b2["base_rate"], b2["auc_pr"]) == (0, 3, 0.0, None)
    assert (got[("never", "c1")]["n"], got[("never", "c1")]["base_rate"], got[("never", "c2_3")]["base_rate"]) == (0, None, 0.0)


POSTS = "published_at timestamp_ntz, item_id string, is_primary boolean, valence_level int"


def test_report(spark):
    outcomes = windows(spark, [w(h, h % 5, 1, h % 3 == 0, 1.0) for h in range(0, 20, 2)]).drop("eco_mean_6h", "eco_n_6h")
    posts = spark.createDataFrame([(T0 + timedelta(hours=h), f"i{h}", False, 3) for h in range(20)], POSTS)
    preds = spark.createDataFrame([pred(h) for h in range(0, 20, 2)], PREDS)
    report = BT.backtest_report(outcomes, preds, posts, T0, T0 + timedelta(hours=20))
    head = report.header.first()
    assert (head["n_windows_total"], head["n_windows_train"], head["n_windows_test"]) == (10, 5, 5)
    assert head["train_until"] == T0 + timedelta(hours=10) and head["notes"] == []
    assert head["ecosystem_posts_test"] == 5 * 6
    nested = report.nested().first()
    assert [s["score_set"] for s in nested["score_sets"]] == ["B1", "B2", "B3", "B4", "m"]


def test_report_notes(spark):
    outcomes = windows(spark, [w(0), w(2)]).drop("eco_mean_6h", "eco_n_6h")
    posts = spark.createDataFrame([], POSTS)
    preds = spark.createDataFrame([], PREDS)
    none = BT.backtest_report(outcomes, preds, posts, T0 - timedelta(days=9), T0 - timedelta(days=8))
    assert none.header.first()["notes"] == ["no_outcomes_in_period"] and none.metrics.count() == 0
    late = BT.backtest_report(outcomes, preds, posts, T0, T0 + timedelta(hours=9), T0 + timedelta(hours=9))
    assert late.header.first()["notes"] == ["empty_test_set", "no_ecosystem_data_b4_degenerate"]
    early = BT.backtest_report(outcomes, preds, posts, T0, T0 + timedelta(hours=9), T0)
    assert early.header.first()["notes"] == ["empty_train_set_b1_zero", "no_ecosystem_data_b4_degenerate"]


FEATURES = (
    "h timestamp_ntz, eco_mean_6h double, eco_n_6h long, primary_mean_24h double, primary_n_24h long, primary_posts_6h long"
)


def test_prediction_rows(spark, rows):
    data = [(T0, 4.0, 10, 3.5, 5, 3), (T0 + timedelta(minutes=15), 2.0, 1, 1.0, 1, 0)]
    df = spark.createDataFrame(data, FEATURES)
    out = prediction_rows(df).orderBy("window_start").collect()
    for r in out:
        assert all(0 < r[c] < 1 for c in ("c2_3_prob", "c2_4_prob", "c2_5_prob", "c2_6_prob", "c3_prob", "c4_prob"))
        assert 0 <= r["c1_value"] <= 6
    assert out[0]["c1_value"] == pytest.approx(0.55 * 4 + 0.45 * 3.5)
    assert out[1]["c4_prob"] == pytest.approx(0.02)
    again = prediction_rows(df)
    assert rows(again, "feature_hash") == rows(prediction_rows(df), "feature_hash")
    assert out[0]["feature_hash"] != out[1]["feature_hash"] and len(out[0]["feature_hash"]) == 64


def test_due_windows(spark):
    preds = spark.createDataFrame([pred(0), pred(0, "n"), pred(1), pred(2), pred(5)], PREDS)
    done = windows(spark, [w(1)])
    due = due_windows(preds, done, T0 + timedelta(hours=4))
    assert [r["window_start"] for r in due.collect()] == [T0]  # ends strictly before now, once
    assert due_windows(preds, done, T0 + timedelta(hours=5), limit=2, dedupe=False).count() == 2
    assert due_windows(preds, done, T0 + timedelta(hours=9)).count() == 3


def test_latest_and_aligned(spark):
    preds = spark.createDataFrame([pred(h, probs=(0.12345,) * 5 + (None,)) for h in range(50)], PREDS)
    out = latest_predictions(preds).collect()
    assert len(out) == 40 and out[0]["made_at"] == T0 + timedelta(hours=49)
    assert (out[0]["c2_4_prob"], out[0]["c4_prob"], len(out[0]["feature_hash"])) == (0.123, 0.0, 16)
    aligned = align_predictions(windows(spark, [w(3), w(70)]), preds)
    assert aligned.count() == 1 and aligned.select(F.max("c4_prob")).first()[0] == 0.0
