"""The distributed monotone fit against pooling by hand; models that can be stored and scored."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinkcast.operators import isotonic as I
from brinkcast.operators import models as MD
from brinkcast.operators.metrics import average_precision
from brinkcast.sources.tables import TABLES, TableStore

T0 = datetime(2026, 1, 1)


def by_hand(data):
    """Points (score, fitted) at both ends of every block."""
    cells = defaultdict(lambda: [0, 0])
    for p, y in data:
        if p is not None and y is not None and p == p:
            cells[p][0] += y
            cells[p][1] += 1
    blocks = []
    for p in sorted(cells):
        s, w, lo = *cells[p], p
        while blocks and blocks[-1][2] * w >= s * blocks[-1][3]:
            left = blocks.pop()
            lo, s, w = left[0], left[2] + s, left[3] + w
        blocks.append((lo, p, s, w))
    return [(x, s / w) for lo, hi, s, w in blocks for x in (lo, hi)]


def planted(seed):
    rnd = random.Random(seed)
    data = []
    for _ in range(900):
        p = 0.5 if rnd.random() < 0.33 else round(rnd.random(), rnd.choice((1, 3)))  # a third share one score
        # rises, then falls: blocks reach across many ranges
        chance = p if seed % 2 else 1 - abs(p - 0.4)
        data.append((p, int(rnd.random() < chance)))
    return data + [(None, 1), (0.3, None), (float("nan"), 1)]


@pytest.mark.parametrize("seed, parts, fan_in", [(1, 7, 2), (2, 7, 2), (3, 1, 16), (4, 5, 3), (5, None, 16)])
def test_fit_does_not_depend_on_ranges(spark, seed, parts, fan_in):
    data = planted(seed)
    df = spark.createDataFrame(data, "prob double, label int").repartition(3)
    blocks = I.isotonic_blocks(df, parts=parts, fan_in=fan_in)
    points = by_hand(data)
    got = blocks.orderBy("lo").collect()
    assert [x for r in got for x in ((r["lo"], r["value"]), (r["hi"], r["value"]))] == points
    probe = [(x / 97,) for x in range(-10, 110)] + [(p,) for p, _ in points]
    out = I.with_isotonic(blocks, spark.createDataFrame(probe, "prob double")).collect()
    xs, ys = zip(*points)
    assert len(out) == len(probe)
    for r in out:
        assert r["calibrated"] == pytest.approx(float(np.interp(r["prob"], xs, ys)), abs=1e-12)


def test_decreasing_labels_become_one_block(spark):
    df = spark.range(0, 1000).select((F.col("id") / 1000).alias("prob"), (F.col("id") < 300).cast("int").alias("label"))
    assert [tuple(r)[:3] for r in I.isotonic_blocks(df, parts=8, fan_in=2).collect()] == [(0.0, 0.999, 0.3)]


def test_empty_fit_and_missing_scores(spark):
    none = spark.createDataFrame([], "prob double, label int")
    blocks = I.isotonic_blocks(none)
    assert blocks.count() == 0
    df = spark.createDataFrame([(0.5, 1, "kept"), (None, 0, "kept"), (float("nan"), 0, "kept")], "prob double, label int, lo string")
    assert [r["calibrated"] for r in I.with_isotonic(blocks, df).collect()] == [None] * 3
    fit = I.isotonic_blocks(df)
    out = I.with_isotonic(fit, df)
    assert out.columns == ["prob", "label", "lo", "calibrated"]  # a column named as one of the fit's stays
    assert sorted((r["calibrated"] is None, r["calibrated"], r["lo"]) for r in out.where("label = 1").collect()) == [(False, 1.0, "kept")]
    assert out.where("calibrated is null").count() == 2


def test_model_rows_are_stored_reloaded_and_scored(spark, tmp_path, rows):
    rnd = random.Random(3)
    data = []
    for i in range(400):
        x, s = rnd.random(), T0 + timedelta(hours=2 * i)
        data.append((s, s + timedelta(hours=2), x, rnd.random(), 5 if x > 0.6 else 1))
    schema = "window_start timestamp, window_end timestamp, a double, b double, v_max int"
    df = spark.createDataFrame(data, schema)
    model = MD.train_threshold(df, ["a", "b"], 4, trees=4, depth=2)
    model.save(str(tmp_path / "m"))
    again = MD.load_threshold_model(str(tmp_path / "m"))
    assert (again.k, again.features, again.report) == (4, ["a", "b"], model.report)
    with pytest.raises(ValueError, match="level 4"):
        MD.load_threshold_model(str(tmp_path / "m"), 5)
    out = MD.model_prediction_rows(again, df, "boosted-4", "two-1")
    assert out.columns == spark.createDataFrame([], TABLES["predictions"]).columns
    store = TableStore(spark, str(tmp_path / "store"))
    assert store.append("predictions", out) == 400
    back = store.read("predictions")
    assert back.where("c2_3_prob is not null or c1_value is not null or length(feature_hash) <> 64").count() == 0
    scored = back.join(df, ["window_start", "window_end"]).selectExpr("c2_4_prob as prob", "cast(v_max >= 4 as int) as label")
    assert average_precision(scored).first()["auc_pr"] > 0.9
    assert '"probs":{"c2_4_prob":' in back.first()["payload"] and '"a":' in back.first()["payload"]
