"""The key index against a set of keys, through batches that fail half-way."""

import random
from datetime import datetime, timedelta

import pytest

from brinkcast.schemas import RAW_ITEMS
from brinkcast.sources.keyindex import KeyIndex
from brinkcast.sources.tables import RAW_KEY, TableStore

T0 = datetime(2026, 1, 1)
ORDER = ["published_at", "raw_item_id"]


def row(n, source="s1", hour=0, text=None):
    t = T0 + timedelta(hours=hour)
    return (f"r{n}-{hour}-{text}", source, None if n is None else f"e{n}", t, t, None, text or f"text {n}", [], {})


def test_batches_add_each_key_once(spark, tmp_path, rows):
    rnd = random.Random(5)
    store = TableStore(spark, str(tmp_path / "s"))
    index = KeyIndex(store, "raw_items", RAW_KEY, 8)
    known = {}
    for batch in range(4):
        # a third of all rows is one post, again and again
        data = [row(1 if rnd.random() < 0.33 else rnd.randrange(60), rnd.choice(("s1", "s2")), rnd.randrange(50)) for _ in range(60)]
        new = {}
        for r in sorted(data, key=lambda r: (r[3], r[0])):
            if r[1:3] not in known:
                new.setdefault(r[1:3], r[0])
        n = index.append_new(spark.createDataFrame(data, RAW_ITEMS), ORDER)
        assert n == len(new)
        known |= new
    assert rows(store.read("raw_items"), "source_id", "external_id", "raw_item_id") == sorted((*k, v) for k, v in known.items())
    assert index.append_new(spark.createDataFrame(data, RAW_ITEMS), ORDER) == 0
    assert index.append_new(spark.createDataFrame([], RAW_ITEMS), ORDER) == 0
    # built anew, it says the same
    assert index.build() == 2
    every = spark.createDataFrame([row(n, s) for n in range(60) for s in ("s1", "s2")], RAW_ITEMS)
    assert rows(index.among(every)) == sorted(known)
    assert index.append_new(every, ORDER) == 120 - len(known)


def test_a_batch_reads_its_own_buckets_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "s"))
    index = KeyIndex(store, "raw_items", RAW_KEY, 16)
    index.append_new(spark.createDataFrame([row(n) for n in range(200)], RAW_ITEMS), ORDER)
    one = index.among(spark.createDataFrame([row(7)], RAW_ITEMS))
    files = {f.split("bucket=")[1].split("/")[0] for f in one.inputFiles()}
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "raw_content" not in plan
    read = spark.read.parquet(index.root + "/build=1")
    buckets = {r["bucket"] for r in one.join(read, RAW_KEY).select("bucket").distinct().collect()}
    assert len(buckets) == 1 and len(files) >= 1 and 0 < one.count() < 40
    assert index.among(spark.createDataFrame([], RAW_ITEMS)).count() == 0


@pytest.mark.parametrize("step", ["append", "_add"])
def test_a_failed_batch_is_neither_lost_nor_repeated(spark, tmp_path, rows, monkeypatch, step):
    store = TableStore(spark, str(tmp_path / "s"))
    index = KeyIndex(store, "raw_items", RAW_KEY, 4)
    index.append_new(spark.createDataFrame([row(1)], RAW_ITEMS), ORDER)
    batch = spark.createDataFrame([row(1, hour=3), row(2, hour=30), row(3, hour=60)], RAW_ITEMS)

    def fail(*_, **__):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(store if step == "append" else index, step, fail)
        with pytest.raises(RuntimeError):
            index.append_new(batch, ORDER)
    assert store.read("raw_items").count() == (1 if step == "append" else 3)
    again = KeyIndex(store, "raw_items", RAW_KEY, 4)  # another process
    assert again.append_new(batch, ORDER) == (2 if step == "append" else 0)
    assert rows(store.read("raw_items"), "external_id") == [("e1",), ("e2",), ("e3",)]
    assert rows(again.among(batch), "external_id") == [("e1",), ("e2",), ("e3",)]


def test_a_table_from_before_the_index(spark, tmp_path, rows):
    store = TableStore(spark, str(tmp_path / "s"))
    store.append("raw_items", spark.createDataFrame([row(1), row(2)], RAW_ITEMS))
    index = KeyIndex(store, "raw_items", RAW_KEY, 4)
    assert index.append_new(spark.createDataFrame([row(2, hour=5), row(3), row(None, text="x"), row(None, text="y")], RAW_ITEMS), ORDER) == 2
    # without a key a row is compared with nothing
    assert index.append_new(spark.createDataFrame([row(3), row(None, text="z")], RAW_ITEMS), ORDER) == 1
    assert rows(store.read("raw_items"), "raw_content") == [("text 1",), ("text 2",), ("text 3",), ("x",), ("z",)]


def test_a_batch_is_kept_in_columns_beside_the_index_until_the_next(spark, tmp_path, monkeypatch):
    from brinkcast.sources import keyindex

    store = TableStore(spark, str(tmp_path / "s"))
    index = KeyIndex(store, "raw_items", RAW_KEY, 4)
    noted = []
    monkeypatch.setattr(index, "_note", lambda rows: noted.append(rows) or KeyIndex._note(index, rows))
    assert index.append_new(spark.createDataFrame([row(n) for n in range(20)], RAW_ITEMS), ORDER) == 20
    assert f"{index.root}/batch" in noted[-2].inputFiles()[0]  # nothing is known: not stored a second time
    assert index.append_new(spark.createDataFrame([row(n) for n in range(15, 30)], RAW_ITEMS), ORDER) == 10
    assert f"{index.root}/fresh" in noted[-2].inputFiles()[0]

    def never(*_):
        raise AssertionError("the batch holds each key once")

    monkeypatch.setattr(keyindex, "first_per_key", never)
    assert index.append_new(spark.createDataFrame([row(n) for n in range(25, 35)], RAW_ITEMS), None) == 5
    assert spark.read.parquet(f"{index.root}/batch").count() == 10
    assert store.read("raw_items").select(*RAW_KEY).distinct().count() == store.read("raw_items").count() == 35
