import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinkcast.llm.gnat import Gnat, squared_distances
from brinkcast.llm.licenses import BASE, NOTICES, scan_licenses, template, templates
from brinkcast.llm.ranked_search import Asked, Segment, rank_documents
from brinkcast.llm.vector_codes import compress, encode, grid_vectors, train


@pytest.mark.parametrize("degree, leaf", [(2, 1), (4, 3), (16, 16)])
def test_tree_finds_the_lowest_nearest_entry(degree, leaf):
    rnd = np.random.default_rng(3)
    entries = rnd.integers(-4, 5, (200, 3))  # many equal entries and equal distances
    entries[50:120] = entries[7]
    queries = rnd.integers(-5, 6, (400, 3))
    got, distance = Gnat(entries, degree, leaf).nearest(queries)
    far = squared_distances(queries.astype(float), entries.astype(float))
    assert got.tolist() == far.argmin(axis=1).tolist()
    assert distance.tolist() == far.min(axis=1).tolist()


def test_tree_spares_distances_and_refuses_what_is_not_exact():
    rnd = np.random.default_rng(1)
    entries = np.concatenate([c + rnd.integers(-20, 20, (16, 8)) for c in rnd.integers(-5000, 5000, (16, 8))])
    tree = Gnat(entries)
    tree.nearest(entries + 1)
    assert tree.measured < len(entries) ** 2 / 3
    with pytest.raises(ValueError):
        tree.nearest(entries + 2**40)
    assert Gnat(entries[:1]).nearest(entries[:0])[0].tolist() == []


def codes_by_hand(rows, parts, entries, rounds):
    rows = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    v = np.floor(1024 * np.array([r[1] for r in rows])).astype(int)
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))[:entries]
    codes, error, book = [], 0, []
    for part in np.array_split(v, parts, axis=1):
        entry = part[order].copy()
        for r in range(rounds + 1):
            d = ((part[:, None, :] - entry[None]) ** 2).sum(axis=2)
            near = d.argmin(axis=1)
            if r < rounds:
                for e in set(near.tolist()):
                    entry[e] = part[near == e].sum(axis=0) // (near == e).sum()
        codes.append(near)
        error = error + d.min(axis=1)
        book.append(entry)
    return [(r[0], r[2], "".join(f"{c[i]:02x}" for c in codes), int(error[i])) for i, r in enumerate(rows)], book


@pytest.mark.parametrize("dims, n, entries", [(8, 90, 16), (6, 5, 16)])
def test_codes_equal_brute_force(spark, dims, n, entries):
    rnd = np.random.default_rng(n)
    rows = [(int(i), rnd.normal(size=dims).round(2).tolist(), int(i % 3) or None) for i in rnd.permutation(n)]
    rows += [(n + i, rows[0][1], 2) for i in range(n // 2)]  # a third of all rows are equal
    rows += [(1000, None, 1), (1001, [None] * dims, 1), (1002, [math.nan] * dims, 1), (1003, [math.inf] + [0.0] * (dims - 1), 1), (None, [0.5] * dims, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("code", F.lit(1)).repartition(5)
    want, book = codes_by_hand(rows, 4, entries, 4)
    got = compress(df, parts=4, entries=entries, rounds=4).collect()
    assert sorted(((r.vec_id, r.label, r.code, r.error) for r in got), key=repr) == sorted(want, key=repr)
    sums = Counter()
    for _, label, _, error in want:
        sums[label] += error
    assert all(r.label_error == sums[r.label] for r in got)
    books = train(grid_vectors(df), 4, entries, 4)
    assert all((a == b).all() for a, b in zip(books.parts, book)) and {r.codebooks_sha256 for r in got} == {books.sha256()}
    coded = encode(grid_vectors(df), books).where("vec_id = 0").first()
    digits = np.array([[int(coded.code[i : i + 2], 16) for i in range(0, 8, 2)]])
    vector = np.floor(1024 * np.array(next(r[1] for r in rows if r[0] == 0)))
    assert ((books.decoded(digits)[0] - vector) ** 2).sum() == coded.error


def test_codes_of_nothing_and_of_odd_lengths(spark):
    schema = "vec_id long, embedding array<float>, label string"
    assert compress(spark.createDataFrame([], schema)).count() == 0
    odd = compress(spark.createDataFrame([(1, [1.0, 2.0, 3.0], "a"), (2, [1.0, 2.0, 4.0], None), (3, [1.0], "a"), (4, [], "a")], schema))
    assert sorted((r.vec_id, r.code, r.error) for r in odd.collect()) == [(1, "00000000", 0), (2, "00000100", 0)]


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def ranks_by_hand(docs, items, k):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [b for b in bags if b[1]]
    n, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for i, b in bags:
            m = 10 + (90 * sum(b.values()) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 8 * m)) for t in set(terms(text)) if t in b)
            scores.append((s, i))
        best = sorted((s for s in scores if s[0] > 0), key=lambda s: (-s[0], s[1] is None, s[1]))[:k]
        out += [(item, r + 1, i, s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("asked", [8192, 60])
def test_ranks_equal_brute_force(spark, corpus, asked):
    rnd = random.Random(2)
    docs = [(r[0], r[1]) for r in corpus]
    words = sorted({w for _, t in docs for w in terms(t)})
    items = [(i, " ".join(rnd.sample(words, rnd.randint(1, 30)) + rnd.sample((docs[20 + i][1] or "").split(), 3)) + "!") for i in range(25)]
    items += [(90, None), (91, ""), (92, "?"), (93, "unheard"), (94, "É x É ß")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit(1)).repartition(6)
    ask = spark.createDataFrame([*items, (None, "zz")], "item_id long, text string").withColumn("doc_id", F.lit("a"))
    got = rank_documents(df, ask, 10, asked=asked)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == ranks_by_hand(docs, items, 10)


def test_ranks_of_nothing_and_of_repeated_rows(spark):
    schema = "doc_id long, text string"
    none, ask = spark.createDataFrame([], schema), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert rank_documents(none, ask).count() == 0
    docs = spark.createDataFrame([(5, "a c"), (5, "a c"), (None, "a c"), (2, "d"), (3, None), (4, "d e f")], schema)
    assert rank_documents(docs, none.withColumnRenamed("doc_id", "item_id")).count() == 0
    assert [(r.rank, r.doc_id) for r in rank_documents(docs, ask, 3).orderBy("rank").collect()] == [(1, 5), (2, 5), (3, None)]


def test_blocks_are_skipped_only_below_the_best():
    rnd = np.random.default_rng(8)
    impacts = np.zeros((1200, 40), np.int64)
    for group in range(30):  # groups of similar documents
        held = rnd.choice(40, 8, replace=False)
        impacts[group * 40 : group * 40 + 40, held] = rnd.integers(1, 5, 8) * 1000 + rnd.integers(0, 50, (40, 8))
    items = [np.sort(rnd.choice(40, 6, replace=False)) for _ in range(20)]
    asked = Asked(items, 40)
    segment = Segment(impacts, asked)
    for item, place in zip(items, asked.place):
        docs, scores = segment.search(item, place, 10, 1)
        best = np.sort(impacts[:, item].sum(axis=1))[::-1][:10]
        assert np.sort(scores)[::-1][:10].tolist() == best.tolist()
        assert set(np.flatnonzero(impacts[:, item].sum(axis=1) > best[-1])) <= set(docs.tolist())
    assert segment.scored < 20 * 1200 / 2


def notices_by_hand(text, known):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for t in known:
        want = [w.decode() for w in t.words]
        for at in range(1 - len(want), len(words)):
            same = [0 <= at + j < len(words) and words[at + j] == w for j, w in enumerate(want)]
            if sum(same) >= t.needed and all(all(same[a:b]) for a, b in t.phrases):
                found.append((t.base, t.label, at, sum(same) / len(want)))
    starts = [at for base, _, at, _ in found if base]
    return (
        len(words), len(starts), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({f[1] for f in found if f[0]})), ",".join(sorted({f[1] for f in found})), max((f[3] for f in found), default=0.0),
    )


def test_licenses_equal_brute_force(spark, corpus):
    rnd = random.Random(11)
    notices = [t.replace("[", "").replace("]", "") for _, t in (*BASE, *NOTICES)]
    texts = [t for _, t, *_ in corpus[:40]] + ["", None]
    for i in range(250):
        words = " ".join(rnd.sample(notices, rnd.randint(1, 3))).split()
        for _ in range(rnd.randint(0, 5)):
            at = rnd.randrange(len(words))
            words[at : at + rnd.choice([0, 1, 1])] = [rnd.choice(["the", "version", "zz", "Ümlaut", "license"])]
        cut = rnd.choice([0, 0, 1, 3])
        texts.append(rnd.choice([" ", ", ", "\n * "]).join(w.upper() if rnd.random() < 0.2 else w for w in words[cut:]) + " and more" * (i % 3))
    texts += ["under the MIT license " * 40] * 90  # a third of all rows
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("labels", F.lit(7)).withColumn("share", F.lit(1)).repartition(5)
    got = {r.doc_id: r for r in scan_licenses(df).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == notices_by_hand(text, templates()), text
        assert r.text == text and r.share == 1


def test_key_phrases_decide(spark):
    known = [template("a", "one two [three four] five six seven", 0.6)]
    texts = ["one two three four five", "zero two three four five six", "one two three x five six seven", "three four five six", "two three four"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.labels for r in scan_licenses(df, known).orderBy("doc_id").collect()] == ["a", "a", "", "", ""]
    assert scan_licenses(df.limit(0)).count() == 0
