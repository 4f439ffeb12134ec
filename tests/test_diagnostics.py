"""Promotion gate: every condition can stop a candidate."""

import random
from datetime import datetime, timedelta

from brinkcast.operators import diagnostics as X

T0 = datetime(2026, 1, 1)
ROWS = "score_set string, window_start timestamp_ntz, target string, prob double, label int"


def _scored(spark, miscalibrated=False, worse_c4=False):
    rnd = random.Random(3)
    data, pairs = [], []
    for i in range(400):
        t, y = T0 + timedelta(hours=2 * i), int(rnd.random() < 0.3)
        sharp = (0.95 if y else 0.05) if not miscalibrated else (0.6 if y else 0.4)
        blunt = 0.3 + 0.2 * rnd.random()
        for target in ("c2_3", "c2_4", "c3", "c4"):
            new = blunt - 0.29 if worse_c4 and target == "c4" else sharp
            data += [("new", t, target, new, y), ("old", t, target, blunt, y)]
        data += [("new", t, "c1", y * 3.0, y * 3), ("old", t, "c1", 1.0, y * 3)]
        pairs.append((t, sharp, blunt, y))
    gain = X.bootstrap_gain(spark.createDataFrame(pairs, "window_start timestamp_ntz, prob double, rival double, label int"), 50)
    return spark.createDataFrame(data, ROWS), gain


def test_better_model_is_promoted(spark):
    scored, gain = _scored(spark)
    row = X.promotion_gate(scored, "new", "old", gain).first()
    assert row["promote"] and row["n_not_worse"] == 4 and row["p_no_gain"] == 0.0
    back = X.promotion_gate(scored, "old", "new", gain).first()
    assert not back["promote"] and back["n_not_worse"] < 3


def test_bad_calibration_or_one_large_loss_stops_it(spark):
    scored, gain = _scored(spark, miscalibrated=True)
    row = X.promotion_gate(scored, "new", "old", gain).first()
    assert row["worst_ece"] > 0.1 and not row["promote"]
    scored, gain = _scored(spark, worse_c4=True)
    row = X.promotion_gate(scored, "new", "old", gain, max_ece=1.0).first()
    assert row["n_not_worse"] == 3 and row["worst_gain"] < -0.05 and not row["promote"]
