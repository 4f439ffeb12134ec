"""Append-only writes, label cache, and operators under a key that holds a third of
all rows, against brute force."""

import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinkcast.operators import annotations as A
from brinkcast.operators import labeling as L
from brinkcast.operators import metrics as M
from brinkcast.operators import windows as WN
from brinkcast.operators import writes as W

T0 = datetime(2026, 1, 1)
RAW = "raw_item_id long, source_id long, external_id string, published_at timestamp_ntz, raw_content string, author string"
ANN = (
    "item_id long, annotator string, labeler_version string, valence_level int, confidence double, target_type string, "
    "target_name string, annotated_at timestamp_ntz"
)


def raw(i, source=1, ext=None, hour=0, text="t"):
    return (i, source, ext or f"e{i}", T0 + timedelta(hours=hour), text, None)


def ann(item, level, hour, version="v1", who="llm", conf=0.9):
    return (item, who, version, level, conf, "none", None, T0 + timedelta(hours=hour))


def test_new_raw_items_first_in_batch_wins(spark, rows):
    old = spark.createDataFrame([raw(1), raw(1)], RAW)
    batch = spark.createDataFrame([raw(11, ext="e1"), raw(2, hour=5, text="late"), raw(3, ext="e2", text="first"), raw(4, 2, "e1")], RAW)
    new = W.new_raw_items(old, batch)
    assert rows(new, "raw_item_id", "raw_content") == [(3, "first"), (4, "t")]
    assert W.new_raw_items(old.unionByName(new), batch).count() == 0


def test_sources_keep_their_row(spark, rows):
    old = spark.createDataFrame([("1", "a", "old")], "source_id string, name string, url string")
    batch = spark.createDataFrame([("9", "a", "new"), ("2", "b", "x"), ("3", "b", "y")], old.schema)
    out = W.get_or_create_sources(old, batch)
    assert rows(out, "name", "url") == [("a", "old"), ("b", "x")]
    assert rows(W.get_or_create_sources(out, batch), "name", "url") == rows(out, "name", "url")


def test_ingest_summary_totals(spark, rows):
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    out = W.ingest_summary(names, names.where("name = 'a'").union(names.where("name = 'a'")), names.limit(0), names.where("name = 'b'"))
    assert rows(out) == [("a", 0, 2, 0, 0), ("b", 0, 0, 0, 1), (None, 1, 2, 0, 1)]


def test_latest_annotation_ties(spark, rows):
    data = [
        ann(1, 2, 1), ann(1, 5, 1, None, "human"),  # a person wins a tie of time
        ann(2, 1, 1, "v1"), ann(2, 3, 1, "v2"),  # then the later version
        ann(3, 4, 2), ann(3, 0, 1, None, "human"),  # time goes first
    ]
    df = spark.createDataFrame(data, ANN)
    assert rows(A.latest_annotation(df), "item_id", "valence_level") == [(1, 5), (2, 3), (3, 4)]
    assert rows(A.latest_annotation(df, "human"), "item_id", "valence_level") == [(1, 5), (3, 0)]
    assert rows(A.paired_annotations(df)) == [(1, 2, 5), (3, 4, 0)]
    with pytest.raises(ValueError):
        A.latest_annotation(df, "robot")


def test_candidates_leave_out_labelled_and_gold(spark, rows):
    df = spark.createDataFrame([ann(1, 2, 1), ann(1, 3, 2, "v2"), ann(2, 1, 1), ann(2, 1, 1, None, "human"), ann(3, 1, 1), ann(4, 1, 0, None, "human")], ANN)
    gold = spark.createDataFrame([(3,)], "item_id long")
    assert rows(A.sampling_candidates(df, gold), "item_id", "llm_level") == [(1, 3)]


def test_posts_without_item_or_label_stay(spark, rows):
    sources = spark.createDataFrame([(1, "s", {"primary": "true"}), (2, "t", {})], "source_id long, name string, metadata map<string,string>")
    raws = spark.createDataFrame([raw(1), raw(2), raw(3, 2)], RAW)
    items = spark.createDataFrame([(10, 1, "x"), (30, 3, "y")], "item_id long, raw_item_id long, clean_text string")
    labels = spark.createDataFrame([ann(30, 2, 1)], ANN)
    out = A.items_with_latest(raws, items, sources, labels)
    assert rows(out, "raw_item_id", "item_id", "is_primary", "valence_level") == [(1, 10, True, None), (2, None, True, None), (3, 30, False, 2)]
    assert rows(A.items_with_latest(raws, items, sources, labels, True), "raw_item_id") == [(1,), (2,)]
    assert rows(A.primary_posts(items, raws, sources), "item_id") == [(10,)]


def test_rejected_labels(spark):
    data = [(3, "none", 0.5), (7, "none", 0.5), (3, "alien", 0.5), (3, "none", 1.5), (None, "none", 0.5), (3, None, 0.5)]
    good, bad = A.valid_annotations(spark.createDataFrame(data, "level int, target_type string, confidence double"))
    assert (good.count(), bad.count()) == (1, 5)


def test_merge_human_labels(spark, rows):
    sample = spark.createDataFrame([(1, "x"), (2, "y")], "item_id long, clean_text string")
    labels = spark.createDataFrame([(2, 4, None)], "item_id long, human_level int, human_notes string")
    assert rows(A.merge_human_labels(sample, labels)) == [(1, "x", None, ""), (2, "y", 4, "")]


CACHE = "label_key string, level int, target_type string, target_name string, rationale string, confidence double"


def test_label_batch_runs_once_per_text_and_fills_the_cache(spark, rows):
    def labeler(text):
        if text == "boom":
            raise RuntimeError("no")
        return {"level": len(text), "target_type": "none", "target_name": None, "rationale": "r", "confidence": 1.0}

    df = spark.createDataFrame([(1, "abc"), (2, "abc"), (3, "boom"), (4, "far too long"), (5, "")], "item_id long, clean_text string")
    cache = spark.createDataFrame([], CACHE)
    out, new = L.label_batch(df, labeler, cache, "m", "v")
    assert rows(out, "item_id", "level", "status") == [(1, 3, "ok"), (2, 3, "ok"), (3, None, "failed"), (4, 12, "invalid")]
    assert new.count() == 1
    again, more = L.label_batch(df.where("item_id < 3"), lambda t: 1 / 0, new, "m", "v")
    assert rows(again, "item_id", "status") == [(1, "ok"), (2, "ok")] and more.count() == 0
    other, _ = L.label_batch(df.where("item_id = 1"), lambda t: 1 / 0, new, "m", "v2")
    assert rows(other, "status") == [("failed",)]  # another version is another key


def test_ablation_by_metadata_and_by_name(spark):
    df = spark.range(1).select(
        L.in_family(F.lit(1), "hour", "temporal"), L.in_family(F.lit(2), "caps", "lexical"), F.lit(3).alias("other")
    )
    assert L.ablate_features(df, temporal=False).columns == ["caps", "other"]
    assert L.ablate_features(df, lexical=False, families={"lexical": ["other"]}).columns == ["hour"]


# -- one key holds a third of the rows ---------------------------------------


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(11)
    n = 6000
    items = [7 if i % 3 == 0 else rnd.randrange(500) for i in range(n)]
    data = [
        (items[i], rnd.choice(["llm", "llm", "human"]), rnd.choice(["v1", "v2", None]), rnd.randrange(7), 0.5, "none", None,
         T0 + timedelta(seconds=0 if i % 3 == 0 else rnd.randrange(90000), microseconds=rnd.randrange(3) * (i % 2)))
        for i in range(n)
    ]
    return data, spark.createDataFrame(data, ANN).repartition(8).checkpoint()


def rank_key(r):
    return (r[7], r[2] is None, r[2] or "", r[1], r[3])


def test_latest_under_skew(skewed, rows):
    data, df = skewed
    best = {}
    for r in data:
        if r[0] not in best or rank_key(r) > rank_key(best[r[0]]):
            best[r[0]] = r
    assert rows(A.latest_annotation(df), "item_id", "valence_level") == sorted(((k, r[3]) for k, r in best.items()), key=repr)


def test_pairs_under_skew(skewed, rows):
    data, df = skewed
    best = defaultdict(dict)
    for r in data:
        kind = "m" if r[1] == "llm" else "h"
        if kind not in best[r[0]] or rank_key(r) > rank_key(best[r[0]][kind]):
            best[r[0]][kind] = r
    want = [(k, v["m"][3], v["h"][3]) for k, v in best.items() if len(v) == 2]
    assert rows(A.paired_annotations(df)) == sorted(want, key=repr)


def test_insert_absent_under_skew(spark, rows):
    rnd = random.Random(2)
    batch = [raw(i, 1, "hot" if i % 3 == 0 else f"e{rnd.randrange(900)}", i % 7, f"t{i}") for i in range(3000)]
    old = [raw(i, 1, f"e{i}") for i in range(0, 900, 2)] + [raw(i, 1, "e1") for i in range(500)]
    got = W.new_raw_items(spark.createDataFrame(old, RAW), spark.createDataFrame(batch, RAW).repartition(8))
    known = {r[2] for r in old}
    first = {}
    for r in batch:
        if r[2] not in known and (r[2] not in first or (r[3], r[0]) < (first[r[2]][3], first[r[2]][0])):
            first[r[2]] = r
    assert rows(got, "external_id", "raw_item_id") == sorted(((k, r[0]) for k, r in first.items()), key=repr)


def test_lookback_with_many_posts_at_one_instant(spark):
    rnd = random.Random(4)
    posts = [(T0 + timedelta(hours=10), f"i{i}", False, rnd.randrange(7)) for i in range(2000)]
    posts += [(T0 + timedelta(seconds=rnd.randrange(86400)), f"j{i}", i % 4 == 0, rnd.randrange(7)) for i in range(4000)]
    df = spark.createDataFrame(posts, "published_at timestamp_ntz, item_id string, is_primary boolean, valence_level int")
    at = [T0 + timedelta(hours=10), T0 + timedelta(hours=16), T0 + timedelta(hours=16, microseconds=-1), T0 + timedelta(hours=12, seconds=5)]
    windows = spark.createDataFrame([(t, t) for t in at], "window_start timestamp_ntz, window_end timestamp_ntz")
    for r in WN.ecosystem_at(windows, df).collect():
        inside = [p[3] for p in posts if not p[2] and r["window_start"] - timedelta(hours=6) < p[0] <= r["window_start"]]
        assert r["eco_n_6h"] == len(inside) and r["eco_mean_6h"] == pytest.approx(np.mean(inside) if inside else 0.0)


def test_average_precision_with_one_hot_score(spark):
    rnd = random.Random(9)
    pairs = [(0.25 if i % 3 == 0 else round(rnd.random(), 4), int(rnd.random() < 0.2)) for i in range(6000)]
    df = spark.createDataFrame(pairs, "prob double, label int").repartition(8)
    counts = Counter(p for p, _ in pairs)
    pos = Counter(p for p, y in pairs if y)
    total, tp, n, want = sum(pos.values()), 0, 0, 0.0
    for s in sorted(counts, reverse=True):
        tp, n = tp + pos[s], n + counts[s]
        want += pos[s] / total * tp / n
    assert M.average_precision(df).first()["auc_pr"] == pytest.approx(want)
