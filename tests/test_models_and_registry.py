"""Trained models on planted data; the registry as a whole."""

import inspect
import random
from datetime import datetime, timedelta

import pytest

import __spark_entry__ as entry
from brinkcast.catalog import learned
from brinkcast.operators import models as MD
from brinkcast.operators.baselines import chrono_holdout
from brinkcast.operators.metrics import average_precision

T0 = datetime(2026, 1, 1)


def test_isotonic_is_monotone_pooled_and_clipped(spark):
    df = spark.createDataFrame([(0.2, 0), (0.4, 1), (0.4, 0), (0.6, 0), (0.8, 1)], "prob double, label int")
    model = MD.fit_isotonic(df)
    probe = spark.createDataFrame([(p / 10,) for p in range(-2, 13)], "prob double")
    got = [r["calibrated"] for r in MD.apply_isotonic(model, probe).orderBy("prob").collect()]
    assert got == sorted(got) and got[0] == 0.0 and got[-1] == 1.0
    assert MD.apply_isotonic(model, df.where("prob = 0.4")).first()["calibrated"] == pytest.approx(1 / 3)


def test_holdout_is_the_last_fifth(spark):
    df = spark.createDataFrame([(T0 + timedelta(hours=7 * i), i) for i in range(11)], "window_start timestamp_ntz, i int")
    got = chrono_holdout(df, "window_start", ["i"])
    assert sorted(r["i"] for r in got.where("is_holdout").collect()) == [8, 9, 10]


def test_threshold_model_learns_and_reloads(spark, tmp_path, rows):
    rnd = random.Random(0)
    data = []
    for i in range(600):
        x, noise = rnd.random(), rnd.random()
        level = 5 if x > 0.6 and noise > 0.2 else 1
        s = T0 + timedelta(hours=2 * i)
        data.append((s, s + timedelta(hours=2), x, noise, level))
    df = spark.createDataFrame(data, "window_start timestamp_ntz, window_end timestamp_ntz, a double, b double, v_max int")
    for share in (None, 0.5):
        model = MD.train_threshold(df, ["a", "b"], 4, trees=8, depth=3, calibration_share=share)
        assert model.report["val_average_precision"] > 0.8 > 0.4
        assert model.report["n"] == (120 if share is None else 60)
    model.save(str(tmp_path / "m"))
    again = MD.load_threshold_model(str(tmp_path / "m"), 4, ["a", "b"])
    one, two = MD.score_model(model, df), MD.score_model(again, df)
    assert rows(one, "window_start", "c2_4_prob") == rows(two, "window_start", "c2_4_prob")
    scored = one.selectExpr("c2_4_prob as prob", "cast(v_max >= 4 as int) as label")
    assert average_precision(scored).first()["auc_pr"] > 0.8


INVENTORY = (
    "s01 s02 s03 s04 s05 s06 s07 s08 s09 s10 s11 w01 w02 w03 w04 w05 w06 w07 w08 p01 p02 p03 p04 p05 p06 p07 p08 p09 p10 "
    "p11 p12 p13 p14 p15 p16 p17 p18 p19 p20 j01 j02 j03 j04 j05 j06 j07 j08 j09 v01 a01 a02 a03 a04 a05 a06 a07 a08 a09 "
    "a10 a11 a12 a13 a14 a15 a16 a17 a18 a19 a20 a21 a22 a23 a24 a25 a26 f01 f02 f03 f04 f06 f07 t01 t02 t03 m01 m03 m04 "
    "m05 m06 r01 r02 r03 r04 r05 u01 u02 x01 x02 x03 x04 x05 x06 x07 x08 x09 x10 x11 x12 x13 x14"
).split()


def test_every_operator_is_registered():
    names = entry.queries()
    have = {n.split("_")[0] for n in names}
    assert set(INVENTORY) <= have
    assert set(entry.oracle_sql()) <= set(names)


def test_entry_returns_outcomes(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "v_max", "n_posts", "v_recent", "had_jump"]
    # every quarter of an hour of the whole days around all posts
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    days = events.selectExpr("datediff(max(ts), min(ts)) + 1").first()[0]
    assert df.count() == 96 * days + 1


def test_registered_training_uses_the_default_trees(monkeypatch):
    default = inspect.signature(MD.train_threshold).parameters["trees"].default
    monkeypatch.setattr(MD, "train_threshold", lambda *a, trees=default, **b: trees)
    assert learned._trained(None) == 400
