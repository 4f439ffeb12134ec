"""Lookbacks, outcomes and labels: boundaries, empty windows, no leak."""

import math
import random
from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brinkcast.functions.times import grid_spine, window_spine
from brinkcast.operators import windows as WN

H = datetime(2026, 1, 2, 12)
SCHEMA = "published_at timestamp_ntz, item_id string, is_primary boolean, valence_level int"
US = timedelta(microseconds=1)


def post(t, level, primary=False, item="i"):
    return (t, item, primary, level)


def feature_row(spark, posts, h=H):
    df = spark.createDataFrame(posts, SCHEMA)
    return WN.features_at(df, grid_spine(spark, h, h)).first()


def test_lookback_is_open_left_closed_right(spark):
    row = feature_row(
        spark,
        [
            post(H, 6), post(H - timedelta(hours=6), 1), post(H - timedelta(hours=6) + US, 2), post(H + US, 5),
            post(H, 3, True), post(H - timedelta(hours=24), 0, True), post(H - timedelta(hours=24) + US, 1, True),
        ],
    )
    assert (row["eco_mean_6h"], row["eco_n_6h"]) == (4.0, 2)
    assert (row["primary_mean_24h"], row["primary_n_24h"]) == (2.0, 2)
    assert row["primary_posts_6h"] == 1


def test_unlabelled_posts_count_as_posts_only(spark):
    row = feature_row(spark, [post(H, None, True), post(H, None), post(H, 2, True, None)])
    assert (row["primary_n_24h"], row["primary_posts_6h"], row["eco_n_6h"]) == (1, 2, 0)
    assert row["eco_mean_6h"] == 0.0


def test_posts_after_h_change_nothing(spark, rows):
    early = [post(H - timedelta(minutes=m), m % 7, m % 2 == 0) for m in range(0, 1500, 37)]
    late = [post(H + timedelta(minutes=m, seconds=1), 6, m % 2 == 0) for m in range(0, 600, 20)]
    spine = grid_spine(spark, H - timedelta(hours=5), H)
    a = WN.features_at(spark.createDataFrame(early, SCHEMA), spine)
    b = WN.features_at(spark.createDataFrame(early + late, SCHEMA), spine)
    assert rows(a) == rows(b)


def outcomes(spark, posts, start=H, hours=2):
    df = spark.createDataFrame(posts, SCHEMA)
    windows = window_spine(spark, start, start, hours)
    return WN.window_outcomes(df, windows).first()


def test_outcome_window_is_closed_left_open_right(spark):
    end = H + timedelta(hours=2)
    row = outcomes(
        spark,
        [post(H, 2, True), post(end - US, 4, True), post(end, 6, True), post(H - US, 1, True), post(H + US, 6, False)],
    )
    # The mean before the start includes the post at the very start.
    assert (row["n_posts"], row["v_max"], row["v_recent"], row["had_jump"]) == (2, 4, 1.5, True)


def test_empty_and_unlabelled_windows(spark):
    row = outcomes(spark, [post(H + timedelta(hours=1), None, True)])
    assert (row["n_posts"], row["v_max"], row["had_jump"]) == (1, -1, False)
    row = outcomes(spark, [post(H - timedelta(hours=1), 3, True)])
    assert (row["n_posts"], row["v_max"], row["v_recent"], row["had_jump"]) == (0, -1, 3.0, False)


def test_jump_needs_two_levels_above_recent(spark):
    before = post(H - timedelta(hours=1), 2, True)
    assert outcomes(spark, [before, post(H + US, 4, True)])["had_jump"]
    assert not outcomes(spark, [before, post(H + US, 3, True)])["had_jump"]
    assert outcomes(spark, [post(H + US, 2, True)])["had_jump"]  # no history counts as 0


def test_raw_post_without_item_is_no_outcome_post(spark):
    row = outcomes(spark, [post(H + US, None, True, None), post(H + US, 1, True)])
    assert row["n_posts"] == 1


def test_windows_of_different_lengths(spark, rows):
    df = spark.createDataFrame([post(H + timedelta(hours=3), 5, True)], SCHEMA)
    both = window_spine(spark, H, H, 2).unionByName(window_spine(spark, H, H, 4))
    assert rows(WN.window_outcomes(df, both), "v_max") == [(-1,), (5,)]


def test_tumbling_labels(spark, rows):
    t0 = datetime(2026, 1, 1)
    posts = spark.createDataFrame(
        [(t0 + timedelta(minutes=10), 2), (t0 + timedelta(hours=2, minutes=10), 4)],
        "published_at timestamp_ntz, valence int",
    )
    out = WN.tumbling_labels(posts, t0, t0 + timedelta(hours=4))
    assert rows(out, "n_posts", "v_max", "v_recent") == [(1, 2, 0.0), (1, 4, 2.0)]
    # The last window must end by the end; no posts, no windows.
    assert WN.tumbling_labels(posts, t0, t0 + timedelta(hours=3)).count() == 1
    assert WN.tumbling_labels(posts.limit(0), t0, t0 + timedelta(hours=4)).count() == 0


def test_tumbling_recent_excludes_the_start(spark):
    t0 = datetime(2026, 1, 1, 0, 7)
    posts = spark.createDataFrame([(t0, 6), (t0 - US, 2)], "published_at timestamp_ntz, valence int")
    row = WN.tumbling_labels(posts, t0, t0 + timedelta(hours=2)).first()
    assert (row["v_max"], row["v_recent"], row["n_posts"]) == (6, 2.0, 1)


def test_tumbling_mean_leaves_out_posts_without_a_level(spark):
    t0 = datetime(2026, 1, 1, 12)
    posts = spark.createDataFrame([(t0 - US, 4), (t0 - 2 * US, None), (t0, None)], "published_at timestamp_ntz, valence int")
    row = WN.tumbling_labels(posts, t0, t0 + timedelta(hours=2)).first()
    assert (row["v_max"], row["v_recent"], row["n_posts"]) == (-1, 4.0, 1)


T = st.integers(0, 4000).map(lambda s: datetime(2026, 1, 1) + timedelta(seconds=37 * s))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    values=st.lists(st.tuples(T, st.integers(0, 6)), min_size=1, max_size=30),
    cutoffs=st.lists(T, min_size=1, max_size=8),
    hours=st.integers(1, 48),
)
def test_rolling_mean_uses_only_its_interval(spark, values, cutoffs, hours):
    df = spark.createDataFrame(values, "published_at timestamp_ntz, valence_level int")
    at = spark.createDataFrame([(c,) for c in cutoffs], "cutoff timestamp_ntz")
    got = {r["cutoff"]: (r["rolling_mean"], r["n"]) for r in WN.rolling_mean(df, at, hours).collect()}
    for c in cutoffs:
        inside = [v for t, v in values if c - timedelta(hours=hours) < t <= c]
        want = sum(inside) / len(inside) if inside else 0.0
        assert abs(got[c][0] - want) < 1e-12 and got[c][1] == len(inside)


def test_rolling_mean_of_doubles_keeps_no_trace_of_values_outside(spark):
    at = datetime(2026, 1, 5, 12)
    values = [(at - timedelta(hours=6), 1e17), (at - timedelta(hours=6, microseconds=1), math.inf), (at - timedelta(hours=1), 0.5), (at + timedelta(microseconds=1), math.nan)]
    values += [(at - timedelta(hours=19), 1e-3), (at - timedelta(days=40), -1e300)]
    df = spark.createDataFrame(values, "published_at timestamp_ntz, valence_level double")
    cut = spark.createDataFrame([(at,), (at - timedelta(hours=14),), (at + timedelta(days=90),), (None,)], "cutoff timestamp_ntz")
    got = {r["cutoff"]: (r["rolling_mean"], r["n"]) for r in WN.rolling_mean(df, cut, 6).collect()}
    assert got == {at: (0.5, 1), at - timedelta(hours=14): (1e-3, 1), at + timedelta(days=90): (0.0, 0)}


@pytest.mark.parametrize("hours", [1e-9, 0.4 / 3600, 1.5 / 3600, 0.37, 5, 26.3, 24 * 80])
def test_rolling_mean_of_any_width(spark, hours):
    rnd = random.Random(int(hours * 1000))
    width = timedelta(microseconds=int(hours * 3600 * 10**6))
    times = [datetime(2026, 1, 1) + rnd.random() * 3 * width for _ in range(60)]
    times += [times[0] + width, times[1] - width, times[2] + width + timedelta(microseconds=1)] + [times[3]] * 30
    values = [(t, rnd.choice([0.1, 2.5, 7.0])) for t in times]
    df = spark.createDataFrame(values, "published_at timestamp_ntz, valence_level double")
    got = WN.rolling_mean(df, df.select(F.col("published_at").alias("cutoff")), hours).collect()
    assert len(got) == len(set(times))
    for r in got:
        inside = [v for t, v in values if r["cutoff"] - width < t <= r["cutoff"]]
        assert r["n"] == len(inside) and r["rolling_mean"] == pytest.approx(sum(inside) / len(inside) if inside else 0.0)


def test_ecosystem_at_equals_panes_on_the_grid(spark, rows):
    posts = [post(H - timedelta(minutes=7 * m), m % 7, m % 3 == 0) for m in range(120)]
    df = spark.createDataFrame(posts, SCHEMA)
    windows = window_spine(spark, H - timedelta(hours=8), H)
    exact = WN.ecosystem_at(windows, df)
    panes = WN.ecosystem_from_panes(windows, WN.valence_panes(df))
    assert rows(exact) == rows(panes)


def test_spine_bounds(spark):
    spine = grid_spine(spark, datetime(2026, 1, 1, 0, 1), datetime(2026, 1, 1, 1))
    first, last, n = spine.agg(F.min("h"), F.max("h"), F.count("*")).first()
    assert (first, last, n) == (datetime(2026, 1, 1, 0, 15), datetime(2026, 1, 1, 1), 4)
    assert grid_spine(spark, H, H - timedelta(hours=1)).count() == 0
