import random
import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry
import corpus_pipeline
from brinkcast.llm.packing import PieceIds
from brinkcast.llm.queries import tokenizer_file

from .conftest import DOCUMENTS, sentence
from .test_jaccard_and_repeats import components_by_hand

ROOT = Path(__file__).resolve().parents[2]


def test_all_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert sorted({int(n[2:].split("_")[0]) for n in names if n != "pipeline"}) == list(range(1, 14)) and "pipeline" in names
    assert {"op2_url_filters", "op8_warc", "op11_vector_codes", "op12_ranked_search", "op13_license_scans"} <= set(entry.oracle_sql())


def test_entry_imports_without_the_corpus_operators():
    code = (
        "import sys\n"
        "sys.modules['brinkcast.llm'] = None\n"
        "sys.modules['corpus_pipeline'] = None\n"
        "import __spark_entry__ as e\n"
        "assert not [n for n in e.queries() if n.startswith('op')] and len(e.queries()) > 100\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_stages_by_hand(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(i, sentence(rnd, 40), "en" if i % 2 else "fr", "s") for i in range(40)]
    rows = [(i, t + " nasty vile" if i % 4 == 0 else t, lang, s) for i, t, lang, s in rows]
    rows += [(50, rows[3][1] + " more", "en", "s"), (51, rows[3][1].upper(), "fr", None), (52, "123 456", "en", "s"), (53, None, None, None)]
    rows += [(54, rows[5][1] + " password=b7db7aa4a5fcc78305", "en", "s")]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(0, 40) if i % 3]
    where = str(tmp_path)
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], DOCUMENTS)
    docs.write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    kept = {}
    now = spark.read.parquet(f"{where}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = f"{where}/{name}"
        stage(spark, now, where).write.parquet(out)
        now = spark.read.parquet(out)
        kept[name] = now
        if name != "packing":
            assert now.schema.names == docs.schema.names
    text = {r.doc_id: r.text for r in kept["language"].collect()}
    assert set(text) == {r[0] for r in rows} - {52, 53}
    groups = components_by_hand(text.items())
    assert {r.doc_id for r in kept["near_duplicates"].collect()} == {i for i, (_, c) in groups.items() if i == c}
    clean = {r.doc_id: (r.text, r.n_chars) for r in kept["secrets"].collect()}
    for i, t in text.items():
        if i in clean:
            t = t.replace("password=b7db7aa4a5fcc78305", "[SECRET]")
            assert clean[i] == (t, len(t))
    mixed = [r.doc_id for r in kept["mixture"].collect()]
    assert not any(i % 4 == 0 for i in mixed if i < 40) and {i for i in clean if i >= 40 or i % 4} <= set(mixed)
    ids = PieceIds(tokenizer_file())
    for r in kept["packing"].collect():
        assert r.ids == (ids.encoded(clean[r.doc_id][0]) + bytes(4))[4 * r.start : 4 * (r.start + r.length)]


def test_stages_keep_columns_of_any_name_and_take_empty_tables(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(i, sentence(rnd, 30), "en", "s", 0, f"x{i}", i, [i], float(i)) for i in range(20)] + [(None, sentence(rnd, 30), None, "s", 0, "y", 1, None, 0.5)]
    rows += [(3, rows[3][1], "en", "s", 0, "again", 2, [7], 1.5)]
    schema = f"{DOCUMENTS}, spans string, tokens int, posterior array<int>, score double"
    docs = spark.createDataFrame(rows, schema).selectExpr("*", "1 as rate", "'c' as _copy", "2 as _row", "'d' as lang_pred", "'e' as n", "3 as component_id", "4 as base")
    where = str(tmp_path)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{where}/labels.parquet")
    want = {r.spans: r for r in docs.drop("text").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, docs, where)
        assert now.schema.names == docs.schema.names and now.dtypes == docs.dtypes, name
        got = now.drop("text").collect()
        assert len(got) == (21 if name == "near_duplicates" else 22), name
        for r in got:
            assert r.asDict() | {"n_chars": 0} == want[r.spans].asDict(), name
        assert stage(spark, docs.limit(0), where).count() == 0
    assert corpus_pipeline.packing(spark, docs.limit(0), where).count() == 0


def test_language_stage_rejects_by_cosine(spark):
    rnd = random.Random(4)
    rows = [(i, sentence(rnd, 60, "abcdefgh" if i % 2 else "mnopqrst"), "a" if i % 2 else "m", "s", 0) for i in range(60)]
    rows += [(100, sentence(rnd, 60, "uvwxyz"), None, "s", 0), (101, "αβγ δεζ " * 20, None, "s", 0), (102, sentence(rnd, 60), None, "s", 0)]
    kept = {r.doc_id for r in corpus_pipeline.language(spark, spark.createDataFrame(rows, DOCUMENTS), "").collect()}
    assert kept == {r[0] for r in rows} - {100, 101}
