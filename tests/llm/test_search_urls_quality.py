import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from brinkcast.llm.mtree import Best, build_pages, scaled, search, top_inner_products
from brinkcast.llm.quality import bucket, bucket_top, judged, limits, measured, quality_filter, sketches
from brinkcast.llm.url_filter import build_cascade, filter_urls, listed_keys, thin_hosts


def vectors_of(n, dims=6, seed=0):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, dims))
    x[n // 2 :] = x[rnd.integers(0, 5, n - n // 2)] + rnd.normal(scale=0.01, size=(n - n // 2, dims))
    x[-n // 3 :] = x[-1]  # one vector held by a third of the rows
    return x


@pytest.mark.parametrize("roots, block", [(1, 4096), (8, 40)])
def test_topk_equals_brute_force(spark, roots, block):
    x = vectors_of(400)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    v = df.select("vec_id", scaled("embedding").alias("v"))
    got = {}
    for r in top_inner_products(v, v.where("vec_id % 20 = 0"), 20, roots, block).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    whole = np.floor(64 * x).astype(int)
    for i in range(0, 400, 20):
        s = whole @ whole[i]
        order = [j for j in np.lexsort((np.arange(400), -s)) if j != i][:20]
        assert sorted(got.pop(i)) == [(n + 1, j, s[j]) for n, j in enumerate(order)]
    assert not got


def test_topk_leaves_out_what_is_no_vector(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (5, [1.0]), (6, [0.5, -0.01]), (6, [0.5, -0.01]), (None, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1))
    v = df.select("vec_id", scaled("embedding").alias("v"), "rank")
    got = [tuple(r) for r in top_inner_products(v, v, 20).orderBy("query_id").collect()]
    assert got == [(0, 1, 6, 64 * 32), (6, 1, 0, 64 * 32)]
    assert top_inner_products(v.limit(0), v.limit(0), 20).count() == 0


def test_bounds_spare_computations():
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(10, 8)) * 100
    x = np.floor(np.concatenate([c + rnd.normal(size=(200, 8)) for c in centres]))
    most = float((x * x).sum(axis=1).max())
    pages = build_pages(x, [[i] for i in range(len(x))], x[0], most)
    touched = Counter()

    class Seen(dict):
        def __getitem__(self, key):
            if key == "vectors":
                touched[self.number] += 1
            return super().__getitem__(key)

    watched = []
    for i, p in enumerate(pages):
        watched.append(Seen(p))
        watched[-1].number = i
    best = Best(5, -float("inf"), 0)
    search(watched, x[7], x[0], most, best)
    want = np.lexsort((np.arange(len(x)), -(x @ x[7])))[:5]
    assert [i for _, i in best.rows] == want.tolist()
    assert len(touched) < len(pages) / 2


URLS = [
    (1, "http://Example.ORG/es/x?q=/en/1"), (2, "https://a.example.org/en/12"), (3, "http://b.org/zz#/es/"), (4, "http://x.com/fr/de/"),
    (5, "http://x.com/de/"), (6, "http://notorg/"), (7, "http://thin.net/a"), (8, "http://sub.thin.net"), (9, None), (10, "no scheme"),
    (11, "http://org"), (12, "ftp://ORG/É://y"), (12, "ftp://ORG/É://y"), (None, "http://com/fr/"), (13, "http://" + "a." * 3000 + "com/fr/" + "p" * 5000),
]
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def test_rules_and_lists(spark):
    pages = spark.createDataFrame(URLS, "page_id long, url string").withColumn("RULE", F.lit("x"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    listed = spark.createDataFrame([("thin.net",), ("absent.net",)], "host string")
    got = {r.page_id: (r.host[:20], r.rule, r.verdict) for r in filter_urls(pages, rules, listed).collect()}
    assert got == {
        1: ("example.org", "example.org/es/", "block"), 2: ("a.example.org", "example.org/en/1", "block"), 3: ("b.org", "org/", "allow"),
        4: ("x.com", "com/fr/", "allow"), 5: ("x.com", "com/de/", "block"), 6: ("notorg", None, "allow"), 7: ("thin.net", None, "block"),
        8: ("sub.thin.net", None, "block"), 9: ("", None, "allow"), 10: ("", None, "allow"), 11: ("org", None, "allow"),
        12: ("org", "org/", "allow"), None: ("com", "com/fr/", "allow"), 13: ("a." * 10, "com/fr/", "allow"),
    }
    assert filter_urls(pages.limit(0), rules, listed.limit(0)).count() == 0


def test_cascade_is_exact_for_every_key(spark):
    universe = spark.range(3000).selectExpr("concat('k', id) as key")
    listed = spark.range(0, 3600, 9).selectExpr("concat('k', id) as key")
    cascade = build_cascade(listed, universe)
    assert len(cascade.levels) > 2
    held = {r.key for r in universe.where(cascade.holds(F.col("key"))).collect()}
    assert held == {f"k{i}" for i in range(0, 3000, 9)}
    assert universe.where(build_cascade(listed.limit(0), universe).holds(F.col("key"))).count() == 0


def test_long_lists_are_joined_with_the_same_result(spark):
    pages = spark.createDataFrame([(i, f"h{i % 7}.net", "/p") for i in range(30)], "page_id long, host string, path string")
    listed = spark.createDataFrame([("h1.net", ""), ("net", "/p"), ("h3.net", "/p")], "host string, path string")
    one = listed_keys(pages, listed, "page_id").collect()
    two = listed_keys(pages, listed, "page_id", most_listed=1).collect()
    assert sorted(one) == sorted(two) and any(len(r.hits) == 2 for r in one)


def test_long_lists_judge_rows_one_by_one(spark):
    rows = [(None, "h1.net", "/p"), (5, "h1.net", "/p"), (5, "clean.org", "/p"), (None, "clean.org", "")]
    pages = spark.createDataFrame(rows, "page_id long, host string, path string")
    listed = spark.createDataFrame([("h1.net", ""), ("h2.net", ""), ("h3.net", "")], "host string, path string")
    got = listed_keys(pages, listed, "page_id", most_listed=1).collect()
    assert sorted(((r.page_id, r.host, [h.key for h in r.hits]) for r in got), key=repr) == sorted(
        [(i, h, ["h1.net"] if h == "h1.net" else []) for i, h, _ in rows], key=repr
    )


def test_cascade_in_parts_is_exact(spark):
    universe = spark.range(3000).selectExpr("concat('k', id) as key")
    listed = spark.range(0, 3600, 9).selectExpr("concat('k', id) as key")
    cascade = build_cascade(listed, universe, most_keys=60)
    assert len(cascade.levels[0].parts) == 6
    held = {r.key for r in universe.where(cascade.holds(F.col("key"))).collect()}
    assert held == {f"k{i}" for i in range(0, 3000, 9)}


def test_thin_hosts(spark):
    rows = [(1, "http://a/", "x" * 100), (2, "http://b/", "x" * 10), (3, "http://b/", None), (4, None, "x" * 5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert [r.host for r in thin_hosts(df).collect()] == ["b"]


def measures_by_hand(text):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(runs)
    covered = {j for i, r in enumerate(runs) if count[r] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(spark, documents, corpus):
    extra = [(900, "a b c d e f a b c d e f\na\n\na\n \t\n \t", None, "s", 1), (901, "#*<>| x y é$", "en", None, 1), (902, "q " * 9, "en", None, 1)]
    df = documents.union(spark.createDataFrame(extra, documents.schema)).withColumn("KEPT", F.lit(1))
    got = {r.doc_id: r for r in quality_filter(df).collect()}
    for i, text, *_ in [*corpus, *extra]:
        r, want = got[i], measures_by_hand(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.kept and r.base_failed)
    assert quality_filter(df.limit(0)).count() == 0


def test_thresholds_follow_language_and_source(spark):
    rnd = random.Random(1)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(5))
    rows = []
    for i in range(400):
        lang, source = ("xx", "code") if i % 2 else ("yy", "prose")
        marks = rnd.randint(8, 14) if source == "code" else rnd.randint(0, 1)
        if i in (10, 12):
            marks = 12  # usual in code, odd in prose
        rows.append((i, " ".join(word() + ("#" if j < marks else "") for j in range(40)), lang, source))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in quality_filter(df, enough=50).collect()}
    assert {i for i, kept in got.items() if not kept} == {10, 12}


def test_sketches_merge_and_bound_quantiles(spark):
    values = spark.range(0, 5000).select("id", bucket(F.col("id")).alias("b")).withColumn("top", bucket_top(F.col("b")))
    wrong = values.where("top < id or (top - id) * 16 > id").count()
    assert wrong == 0
    rows = measured(spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)), "a", "s")] * 3, "doc_id int, text string, lang string, source string"))
    halves = sketches(rows).union(sketches(rows))
    assert limits(halves).select("level", "lang", "share", "top").distinct().count() == limits(sketches(rows)).count()
    assert judged(rows, limits(sketches(rows))).where("kept").count() == 3
