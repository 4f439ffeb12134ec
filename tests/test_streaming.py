"""Streams equal their batch forms; late rows and re-runs change nothing."""

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from brinkcast.functions.times import grid_spine, window_spine
from brinkcast.operators.windows import features_at, window_outcomes
from brinkcast.operators.writes import new_raw_items
from brinkcast.plans.cycle import run_tick
from brinkcast.schemas import FEED_PAYLOAD, RAW_ITEMS
from brinkcast.sources.tables import TableStore
from brinkcast.streaming.ingest import stream_ingest, stream_ticks
from brinkcast.streaming.panes import close_until, stream_both

T0 = datetime(2026, 1, 1)
POSTS = "published_at timestamp, item_id string, is_primary boolean, valence_level int"


def _post(minutes, level, primary, n=0, seconds=0):
    return (T0 + timedelta(minutes=minutes, seconds=seconds), f"i{minutes}-{n}-{seconds}", primary, level)


def _write(spark, path, name, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{path}/{name}")


def _posts_stream(spark, folder):
    return spark.readStream.schema(POSTS).parquet(f"{folder}/*")


FIRST = [
    _post(0, 3, True), _post(15, 2, False), _post(20, None, True), _post(59, 6, False, seconds=59),
    _post(75, 5, True), _post(130, 1, False), _post(240, 4, True), _post(241, None, False),
]
SECOND = [_post(300, 2, True), _post(420, 6, True), _post(600, 1, False)]
LATE = [_post(80, 6, True, n=9)]


def test_stream_features_and_outcomes_equal_batch_and_ignore_late_posts(spark, tmp_path, rows):
    src, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "store"))
    for name, data in (("a", FIRST), ("b", SECOND)):
        _write(spark, src, name, data, POSTS)
        stream_both(_posts_stream(spark, src), store, str(tmp_path / "cp")).awaitTermination()
    posts = spark.createDataFrame(FIRST + SECOND, POSTS)
    got = store.read("outcomes").select("window_start", "window_end", "v_max", "n_posts", "had_jump")
    keys = got.select("window_start", "window_end")
    assert got.count() > 10 and got.count() == keys.distinct().count()
    want = window_outcomes(posts, keys).select(*got.columns)
    assert rows(got) == rows(want)
    first, last = got.agg(F.min("window_start"), F.max("window_start")).first()
    spine = window_spine(spark, first, last)
    assert spine.count() == got.count()  # no closed window is missing

    preds = store.read("predictions")
    feats = features_at(posts, preds.select(F.col("window_start").alias("h")))
    want = feats.select("h", "eco_n_6h", "primary_n_24h", "primary_posts_6h")
    stored = preds.select(
        F.col("window_start").alias("h"),
        *[F.get_json_object("payload", f"$.features.{c}").cast("long").alias(c) for c in want.columns[1:]],
    )
    assert stored.count() > 10 and rows(stored) == rows(want)

    # A post that comes after its pane has closed changes nothing.
    before = rows(store.read("outcomes"), "window_start", "v_max", "n_posts")
    _write(spark, src, "c", LATE, POSTS)
    query = stream_both(_posts_stream(spark, src), store, str(tmp_path / "cp"))
    query.awaitTermination()
    after = rows(store.read("outcomes"), "window_start", "v_max", "n_posts")
    assert after == before
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped >= 1


def test_quiet_stretches_and_ends_close_by_event_time(spark, tmp_path, rows):
    src, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "store"))
    data = [_post(0, 3, True), _post(31, 5, True), _post(60 * 9 + 7, 1, False)]
    _write(spark, src, "a", data, POSTS)
    stream_both(_posts_stream(spark, src), store, str(tmp_path / "cp"), delay="20 minutes").awaitTermination()
    done = store.read("outcomes").select("window_start", "window_end", "v_max", "n_posts", "had_jump")
    # the watermark is 8:47, so panes up to 8:30 have closed: windows start from 0:00 to 6:45
    assert max(rows(done, "window_start"))[0] == T0 + timedelta(hours=6, minutes=45) and done.count() == 28
    assert rows(done) == rows(window_outcomes(spark.createDataFrame(data, POSTS), done.select("window_start", "window_end")).select(*done.columns))
    times = sorted(rows(store.read("predictions"), "window_start"))
    assert (times[0][0], times[-1][0], len(times)) == (T0, T0 + timedelta(hours=8, minutes=30), 35)
    assert rows(store.read("progress")) == [(int((T0 + timedelta(hours=8, minutes=45)).replace(tzinfo=timezone.utc).timestamp()) * 10**6,)]
    # nobody posts any more
    assert close_until(store, T0 + timedelta(hours=12)) == (13, 13)
    assert close_until(store, T0 + timedelta(hours=12)) == (0, 0)
    assert max(rows(store.read("outcomes"), "window_start"))[0] == T0 + timedelta(hours=10)


def _raw(i, source="s1", hour=0):
    t = T0 + timedelta(hours=hour)
    return (f"r{i}-{hour}", source, f"e{i}", t, t, None, f"text {i}", [], {})


def test_stream_ingest_equals_batch(spark, tmp_path, rows):
    src, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "store"))
    parts = [[_raw(1), _raw(2), _raw(1, hour=1)], [_raw(2, hour=2), _raw(3, hour=2), _raw(3, "s2", hour=2)]]
    for i, part in enumerate(parts):
        _write(spark, src, f"f{i}", part, RAW_ITEMS)
        stream = spark.readStream.schema(RAW_ITEMS).parquet(f"{src}/*")
        stream_ingest(stream, store, str(tmp_path / "cp")).awaitTermination()
    got = rows(store.read("raw_items"), "source_id", "external_id")
    every = spark.createDataFrame(parts[0] + parts[1], RAW_ITEMS)
    assert got == rows(new_raw_items(every.limit(0), every), "source_id", "external_id")
    assert len(got) == 4


PHRASES = {6: ["attack"], 3: ["lied"], 1: ["disagree"]}


def _payload(n, source, text, minutes):
    t = T0 + timedelta(minutes=minutes)
    return (source, f"{source}-{n}", t, None, text, [], {"link": "x"})


def test_tick_is_idempotent(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "store"))
    batch = spark.createDataFrame(
        [
            _payload(1, "own", "<p>They lied</p>", 10),
            _payload(1, "own", "<p>They lied</p>", 10),
            _payload(2, "own", "attack now", 40),
            _payload(1, "feed", "I disagree", 20),
            _payload(2, "feed", "", 30),
        ],
        FEED_PAYLOAD,
    )
    now = T0 + timedelta(minutes=50)
    out = run_tick(store, batch, now, PHRASES, primary=("own",))
    assert out == {"new_raw": 4, "new_items": 4, "annotations": 3, "predictions": 3, "outcomes": 0}
    again = run_tick(store, batch, now, PHRASES, primary=("own",))
    assert set(again.values()) == {0}
    pred = store.read("predictions").orderBy("window_start").collect()[-1]
    assert '"primary_posts_6h":2' in pred["payload"] and pred["c4_prob"] > 0.02
    later = run_tick(store, batch.limit(0), T0 + timedelta(hours=3), PHRASES, primary=("own",))
    assert later["outcomes"] == 3 and later["predictions"] == 9
    done = store.read("outcomes").orderBy("window_start").collect()[-1]
    assert (done["v_max"], done["n_posts"], done["had_jump"]) == (-1, 0, False)


def test_stream_ticks(spark, tmp_path):
    src, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "store"))
    schema = FEED_PAYLOAD + ", captured_at timestamp"
    data = [(*_payload(1, "own", "They lied", 10), T0 + timedelta(minutes=20))]
    _write(spark, src, "a", data, schema)
    for _ in range(2):
        stream = spark.readStream.schema(schema).parquet(f"{src}/*")
        stream_ticks(stream, store, str(tmp_path / "cp"), PHRASES, ("own",)).awaitTermination()
    assert store.read("raw_items").count() == 1
    assert store.read("annotations").first()["valence_level"] == 3
    assert store.read("predictions").count() == 1
