"""Agreement figures and the go / no-go decision."""

import pytest

from brinkcast.operators import agreement as G

PAIRS = "item_id long, llm_level int, human_level int"


def pairs(spark, levels):
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(levels)], PAIRS)


def report(spark, levels):
    return G.validation_report(pairs(spark, levels)).first()


def test_empty_is_no_go(spark):
    r = report(spark, [])
    assert (r["n_paired"], r["decision"], r["failures"]) == (0, "no_go", ["empty_dataset"])


def test_perfect_is_go(spark):
    r = report(spark, [(i % 7, i % 7) for i in range(35)])
    assert (r["decision"], r["failures"], r["kappa_global"], r["kappa_high_levels"]) == ("go", [], 1.0, 1.0)


def test_disagreement_is_no_go(spark):
    r = report(spark, [(0, 6), (6, 0)] * 20)
    assert r["decision"] == "no_go" and "mae_ordinal>=0.6" in r["failures"] and "kappa_global<0.7" in r["failures"]


def test_bias_sign_and_partial(spark):
    r = report(spark, [(4, 3)] * 10)
    assert r["signed_bias"] == 1.0 and r["kappa_global"] == 0.0 and r["n_high_levels"] == 0
    assert "abs_bias>=0.3" in r["failures"] and not any(f.startswith("kappa_levels") for f in r["failures"])
    r = report(spark, [(0, 0), (1, 1), (2, 2), (3, 2)])
    assert r["decision"] == "partial" and r["failures"] == ["kappa_global<0.7"]


def test_one_high_pair_is_not_judged(spark):
    r = report(spark, [(0, 0), (1, 1), (2, 2), (3, 5)] + [(i % 3, i % 3) for i in range(30)])
    assert r["n_high_levels"] == 1 and r["kappa_high_levels"] == 0.0
    assert not any(f.startswith("kappa_levels") for f in r["failures"])


def test_kappa_hand_value_and_one_class(spark):
    levels = [(0, 0)] * 20 + [(0, 1)] * 5 + [(1, 0)] * 10 + [(1, 1)] * 15
    assert G.cohens_kappa(pairs(spark, levels)).first()["kappa"] == pytest.approx(0.4)
    assert G.cohens_kappa(pairs(spark, [(2, 2)] * 4)).first()["kappa"] == 0.0
    assert G.cohens_kappa(pairs(spark, [])).first()["kappa"] == 0.0


def test_confusion_matrix_keeps_zero_cells(spark):
    got = {r["llm_level"]: r for r in G.confusion_matrix(pairs(spark, [(0, 0), (0, 4), (6, 4)])).collect()}
    assert len(got) == 8
    assert (got["0"]["human_0"], got["0"]["human_4"], got["0"]["total"]) == (1, 1, 2)
    assert got["3"]["total"] == 0 and got["total"]["human_4"] == 2 and got["total"]["total"] == 3


def test_level_diagnostics(spark):
    r = G.level_diagnostics(pairs(spark, [(4, 4), (3, 4), (3, 4), (0, 4), (4, 1)])).first()
    assert (r["n_human"], r["n_machine"], r["n_missed"], r["missed_as_3"], r["missed_as_0"]) == (4, 2, 3, 2, 1)


def test_audit_summary_skips_unread_levels(spark):
    rows = spark.createDataFrame([("1", "1"), ("2", None), ("x", "2"), ("3", "1")], "llm_level string, human_level string")
    r = G.audit_summary(rows).first()
    assert (r["n"], r["n_skipped"], r["mae"], r["bias"]) == (2, 2, 1.0, 1.0)
    empty = G.audit_summary(rows.limit(0)).first()
    assert (empty["n"], empty["kappa"], empty["mae"]) == (0, 0.0, 0.0)


def test_mismatches_order_and_preview(spark):
    rows = pairs(spark, [(1, 1), (0, 6), (4, 3), (2, 1)])
    texts = spark.createDataFrame([(i, "a\n" + "x" * 200) for i in range(4)], "item_id long, clean_text string")
    got = G.mismatches(rows, texts).collect()
    assert [(r["item_id"], r["gap"], r["level_4_case"]) for r in got] == [(1, 6, False), (2, 1, True), (3, 1, False)]
    assert len(got[0]["preview"]) == 140 and got[0]["preview"].startswith("a x") and got[0]["preview"].endswith("...")
