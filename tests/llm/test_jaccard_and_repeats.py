import hashlib
import inspect
import re
from collections import defaultdict

import numpy as np
import pytest

from brinkcast.llm.arrow import bounded_batches
from brinkcast.llm.components import connected_components
from brinkcast.llm.jaccard_join import InvertedIndex, _candidates, jaccard_components
from brinkcast.llm.sketch import _packed, _unpacked, merged_sketch, sketch_bits
from brinkcast.llm.substring_dedup import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, k=5):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def components_by_hand(rows, percent=75):
    sets = {i: shingle_set(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("block", [1 << 16, 300])
def test_components_equal_brute_force(spark, documents, corpus, block):
    want = components_by_hand([(i, t) for i, t, *_ in corpus])
    got = jaccard_components(documents, block_shingles=block).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(corpus)


def test_components_with_small_sketch_null_ids_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(3, text, "a"), (3, text, "a"), (None, text, "b"), (1, text + " end", "c"), (9, None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_components(df, most_bits=16).collect()), key=repr)
    assert got == [(1, 1), (3, 1), (3, 1), (9, 9), (None, 1)] or got == [(1, 1), (3, 1), (3, 1), (9, 9), (None, None)]
    assert jaccard_components(df.limit(0)).count() == 0


def test_rows_without_id_have_no_component(spark):
    df = spark.createDataFrame([(3, "a b c d e f"), (None, "a b c d e f"), (None, None), (4, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in jaccard_components(df).collect()), key=repr)
    assert got == [(3, 3), (4, 4), (None, None), (None, None)]


@pytest.mark.parametrize("percent", [30, 75, 100])
def test_merge_of_lists_passes_over_what_is_taken_out(percent):
    for seed in range(25):
        rnd = np.random.default_rng(seed)
        base = rnd.integers(0, 60, rnd.integers(1, 60)).astype(np.uint64)
        sets = [np.unique(np.concatenate([rnd.choice(base, rnd.integers(1, 60)), rnd.integers(0, 500, n).astype(np.uint64)])) for n in rnd.integers(0, 12, 30)]
        index = InvertedIndex(list(range(30)), sets)
        for i, s in enumerate(index.sets):
            among = rnd.random(30) < 0.7
            linked = [100 * len(np.intersect1d(s, t)) >= percent * len(np.union1d(s, t)) for t in index.sets]
            assert index.partners(s, percent, among.copy()).tolist() == [j for j in range(30) if among[j] and linked[j]]
            found = []
            for j in index.linked(s, percent, among):  # every other one is no longer asked for
                found.append(j)
                among[j + 1 : j + 2] = False
            assert all(linked[j] for j in found) and all(b - a > 1 for a, b in zip(found, found[1:]))


def test_batches_are_bounded_but_a_lower_setting_stays(spark):
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(setting)
    try:
        for low in ("1000000", "900k", "2m"):
            spark.conf.set(setting, low)
            bounded_batches(spark)
            assert spark.conf.get(setting) == low
        spark.conf.set(setting, "8mb")
        bounded_batches(spark)
        assert spark.conf.get(setting) == "4000000"
    finally:
        spark.conf.set(setting, before)


def test_inverted_index_finds_what_comparison_finds():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 300, 80).astype(np.uint64)
    sets = [np.unique(np.concatenate([rnd.choice(base, 60), rnd.integers(0, 5000, n).astype(np.uint64)])) for n in rnd.integers(0, 25, 60)]
    index = InvertedIndex(list(range(60)), sets)
    for i, s in enumerate(index.sets):
        want = [j for j, t in enumerate(index.sets) if 100 * len(np.intersect1d(s, t)) >= 60 * len(np.union1d(s, t))]
        assert index.partners(s, 60, np.ones(60, bool)).tolist() == want, i


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(60)}


@pytest.mark.parametrize("counts", [False, True])
def test_sketch_never_underestimates(spark, counts):
    def hashes(batches):
        for batch in batches:
            yield np.array(batch.column(0).to_pylist(), np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    df = spark.createDataFrame([(i % 700,) for i in range(1000)], "x long").repartition(3)
    sketch = merged_sketch(df, hashes, 16, depth=2, counts=counts)
    x = np.arange(700, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    seen = sketch.estimates(x) > 1 if counts else sketch.repeated(x)
    assert seen[:300].all() and seen[300:].mean() < 0.2


def test_sketch_comes_to_the_driver_in_parts(spark):
    def hashes(batches):
        for batch in batches:
            for i in batch.column(0).to_pylist():
                yield np.random.default_rng(i).integers(0, 1 << 63, 1_000_000, np.uint64) * np.uint64(2)

    df = spark.range(8).select("id").repartition(4)
    limits = spark.sparkContext._jsc.sc().conf()
    most = limits.get("spark.driver.maxResultSize", "1g")
    limits.set("spark.driver.maxResultSize", "3m")  # of the results of a job, the table has 8 MB
    try:
        sketch = merged_sketch(df, hashes, 23, counts=True)
    finally:
        limits.set("spark.driver.maxResultSize", most)
    table = sketch.table.value
    assert table.nbytes == 1 << 23 and table.sum(dtype=np.int64) == 8_000_000
    x = next(hashes([df.where("id = 3").toArrow()]))
    assert (sketch.estimates(x) > 0).all()
    sketch.drop()


@pytest.mark.parametrize("counts", [False, True])
def test_sketch_in_pieces_answers_as_a_whole(spark, counts):
    def hashes(batches):
        for batch in batches:
            yield np.array(batch.column(0).to_pylist(), np.uint64) * np.uint64(0x9E3779B97F4A7C15)

    df = spark.createDataFrame([(i % 7000,) for i in range(10000)], "x long").repartition(3)
    x = np.arange(9000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    whole = merged_sketch(df, hashes, 18, depth=2, counts=counts)
    cut = merged_sketch(df, hashes, 18, depth=2, counts=counts, whole=1 << 15)
    assert len(whole.pieces) == 1 and len(cut.pieces) == (64 if counts else 8)
    look = lambda sketch: (sketch.estimates if counts else sketch.repeated)(x)
    assert look(whole).any() and (look(cut) == look(whole)).all() and (look(cut) == look(whole)).all()
    assert not any("_value" in vars(piece) for piece in cut.pieces)  # one is held at a time
    cut.drop()


def test_cells_are_packed_whatever_their_distances():
    for gap in (0, 1, 255, 3839, 3840, 65534, 65535, 65536, 4_000_000):
        for n in (1, 2, 501):
            cells = np.cumsum(np.full(n, gap, np.uint64)) + np.uint64(3)
            assert (_unpacked(_packed(cells)) == cells).all()
    far = np.sort(np.random.default_rng(2).integers(0, 1 << 22, 1000, np.uint64))
    assert (_unpacked(_packed(far)) == far).all() and len(_packed(far)) <= 4 + 2 * len(far)


def test_sketch_of_shingles_follows_the_input_beyond_what_a_task_holds(spark):
    shingles = 1_500_000_000  # of 6 GB of documents
    most = inspect.signature(jaccard_components).parameters["most_bits"].default
    assert 1 << sketch_bits(shingles, 1.2, most) > 1.2 * shingles

    texts = [" ".join(f"w{i}x{j}" for j in range(1000)) for i in range(150)]
    texts += [texts[0] + " end", texts[1] + " end"]
    df = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "doc_id long, text binary").repartition(3)
    few = _candidates(df, 150_000, 5, 75, most, whole_bits=14)  # alone, what a task holds would let all sets through
    assert sorted(r.doc_id for r in few.collect()) == [0, 1, 150, 151]


@pytest.mark.parametrize("block", [1 << 16, 300])
def test_components_with_sketches_in_pieces_equal_brute_force(spark, documents, corpus, block):
    want = components_by_hand([(i, t) for i, t, *_ in corpus])
    got = jaccard_components(documents, block_shingles=block, whole_bits=12).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(corpus)


def kept_by_hand(rows, k):
    first, out = {}, {}
    for i, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for s in range(len(words) - k + 1):
            if first.setdefault(tuple(words[s : s + k]), (i, s)) != (i, s):
                gone[s : s + k] = [True] * k
        kept = " ".join(w for w, g in zip(words, gone) if not g)
        out[i] = (len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("k, bits", [(20, 28), (4, 16)])
def test_repeats_equal_brute_force(spark, documents, corpus, k, bits):
    got = remove_repeats(documents, k=k, most_bits=bits).collect()
    have = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in got}
    assert have == kept_by_hand([(i, t) for i, t, *_ in corpus], k)


def test_repeats_without_ids_or_rows(spark):
    df = spark.createDataFrame([(None, "a b c d", 1), (2, "a b c d", 2)], "doc_id long, text string, n_words int")
    got = {r.doc_id: (r.n_removed, r.kept) for r in remove_repeats(df, k=3).collect()}
    assert got == {None: (4, ""), 2: (0, "a b c d")}
    assert remove_repeats(df.limit(0)).count() == 0


@pytest.mark.parametrize("most_touched", [500_000, 0])
def test_repeats_of_rows_that_share_an_id_or_have_none(spark, most_touched):
    passage = "a b c d"
    rows = [(None, f"{passage} u1 u2 u3 u4 {passage}"), (None, "v1 v2 v3 v4 v5 v6 v7 v8 v9 v10 v11 v12"), (7, f"w1 w2 {passage}"), (7, "x1 x2 x3 x4 x5 x6")]
    rows += [(8, "y1 y2 y3"), (8, "y1 y2 y3"), (2**63 - 1, "z1 z2 z3"), (None, "q1 q2 q3 q4"), (None, "q1 q2 q3 q5")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = sorted(((r.doc_id, r.n_words, r.kept) for r in remove_repeats(df, k=3, most_touched=most_touched).collect()), key=repr)
    want = [(None, 12, "u1 u2 u3 u4"), (None, 12, rows[1][1]), (7, 6, rows[2][1]), (7, 6, rows[3][1]), (8, 3, "y1 y2 y3"), (8, 3, "")]
    want += [(2**63 - 1, 3, "z1 z2 z3"), (None, 4, "q1 q2 q3 q4"), (None, 4, "q5")]
    assert got == sorted(want, key=repr)
