"""Queries over agreement, forecast scores, drift and the backtest."""

from __future__ import annotations

from pyspark.sql import functions as F

from brinkcast.catalog.bridge import given, table
from brinkcast.catalog.core import (
    case,
    panes_of,
    period_of,
    posts_of,
    predictions_from,
    r9,
    r9sql,
    windows_of,
)
from brinkcast.functions.scores import PROB_COLUMNS
from brinkcast.operators import agreement as G
from brinkcast.operators import annotations as A
from brinkcast.operators import baselines as B
from brinkcast.operators import drift as D
from brinkcast.operators import metrics as M
from brinkcast.operators import predictions as P
from brinkcast.operators import windows as WN
from brinkcast.operators.ordered import exact_quantiles, stored
from brinkcast.plans import backtest as BT
from brinkcast.sources.files import skipped_labels


def pairs_of(spark, d):
    return A.paired_annotations(table(spark, d, "annotations"))


def raters_of(spark, d):
    """Second pair of raters: quality against absence of toxicity."""
    return given(spark, d, "labels").select(
        F.col("doc_id").alias("item_id"), F.col("quality").alias("llm_level"), (1 - F.col("toxic")).alias("human_level")
    )


_RATERS = "select doc_id as item_id, quality as llm_level, 1 - toxic as human_level from labels"


def _kappa_sql(source: str) -> str:
    return f"""select count(*) as n, round(coalesce((po - pe) / nullif(1 - pe, 0), 0.0), 9) + 0e0 as kappa from (
        select count(*) as total, avg((llm_level = human_level)::int::double) as po from {source}), (
        select sum(na::double * nb) / power((select count(*) from {source}), 2) as pe from (
          select llm_level as k, count(*) as na from {source} group by 1) join (
          select human_level as k, count(*) as nb from {source} group by 1) using (k)), {source}
        group by po, pe"""


@case("a10_cohens_kappa", _kappa_sql("pairs"))
def _(spark, d):
    return r9(G.cohens_kappa(pairs_of(spark, d)), "kappa")


@case("a10_cohens_kappa_raters", _kappa_sql("raters"), raters=_RATERS)
def _(spark, d):
    return r9(G.cohens_kappa(raters_of(spark, d)), "kappa")


@case("a11_ordinal_mae", "select round(avg(abs(llm_level - human_level)::double), 9) as mae from pairs")
def _(spark, d):
    return r9(G.ordinal_mae(pairs_of(spark, d)), "mae")


@case("a12_signed_bias", "select round(avg((llm_level - human_level)::double), 9) + 0e0 as bias from pairs")
def _(spark, d):
    return r9(G.signed_bias(pairs_of(spark, d)), "bias")


_CELLS = ", ".join(f"count(*) filter (human_level = {k}) as human_{k}" for k in range(7))


@case(
    "a13_confusion_matrix",
    f"""select l.k::varchar as llm_level, {_CELLS}, count(human_level) as total
        from (select unnest(range(0, 7)) as k) l left join pairs on llm_level = l.k group by l.k
        union all select 'total', {_CELLS}, count(*) from pairs""",
)
def _(spark, d):
    return G.confusion_matrix(pairs_of(spark, d))


_MISSED = ", ".join(
    f"count(*) filter (human_level = 4 and llm_level = {k}) as missed_as_{k}" for k in range(7) if k != 4
)


@case(
    "a14_level_diagnostics",
    f"""select count(*) as n, count(*) filter (human_level = 4) as n_human, count(*) filter (llm_level = 4) as n_machine,
          count(*) filter (human_level = 4 and llm_level <> 4) as n_missed, {_MISSED} from pairs""",
)
def _(spark, d):
    return G.level_diagnostics(pairs_of(spark, d))


def _kappa_of(where: str) -> str:
    return f"""(select coalesce((po - pe) / nullif(1 - pe, 0), 0.0) from (
        select avg((llm_level = human_level)::int::double) as po from pairs where {where}), (
        select sum(na::double * nb) / power((select count(*) from pairs where {where}), 2) as pe from (
          select llm_level as k, count(*) as na from pairs where {where} group by 1) join (
          select human_level as k, count(*) as nb from pairs where {where} group by 1) using (k)))"""


@case(
    "a23_validation_report",
    """select n_paired, n_high_levels, round(kappa_global, 9) as kappa_global, round(kappa_high_levels, 9) as kappa_high_levels,
         round(mae_ordinal, 9) as mae_ordinal, round(signed_bias, 9) + 0e0 as signed_bias,
         case when n_failed = 0 then 'go' when n_failed >= 3 then 'no_go' else 'partial' end as decision, failures
       from (select *, (kappa_global < 0.7)::int + (n_high_levels >= 2 and kappa_high_levels < 0.5)::int
               + (mae_ordinal >= 0.6)::int + (abs(signed_bias) >= 0.3)::int as n_failed,
             concat_ws(',', case when kappa_global < 0.7 then 'kappa_global<0.7' end,
               case when n_high_levels >= 2 and kappa_high_levels < 0.5 then 'kappa_levels_4_6<0.5' end,
               case when mae_ordinal >= 0.6 then 'mae_ordinal>=0.6' end,
               case when abs(signed_bias) >= 0.3 then 'abs_bias>=0.3' end) as failures from figures)""",
    figures=f"""select count(*) as n_paired, count(*) filter (human_level >= 4) as n_high_levels,
         {_kappa_of('true')} as kappa_global, {_kappa_of('human_level >= 4')} as kappa_high_levels,
         avg(abs(llm_level - human_level)::double) as mae_ordinal, avg((llm_level - human_level)::double) as signed_bias
       from pairs""",
)
def _(spark, d):
    row = G.validation_report(pairs_of(spark, d)).withColumn("failures", F.concat_ws(",", "failures"))
    return r9(row, "kappa_global", "kappa_high_levels", "mae_ordinal", "signed_bias")


_AUDIT = """select item_id, annotations.valence_level as llm_level, h.valence_level as human_level
    from latest_machine as annotations left join latest_human h using (item_id)"""


def _audit_rows(spark, d):
    ann = table(spark, d, "annotations")
    machine = A.latest_annotation(ann, "machine").select("item_id", F.col("valence_level").alias("llm_level"))
    human = A.latest_annotation(ann, "human").select("item_id", F.col("valence_level").alias("human_level"))
    return machine.join(human, "item_id", "left")


@case(
    "a26_audit_summary",
    f"""select (select count(*) from pairs) as n, (select count(*) from latest_machine) - (select count(*) from pairs) as n_skipped,
          round({_kappa_of('true')}, 9) as kappa, (select round(avg(abs(llm_level - human_level)::double), 9) from pairs) as mae,
          (select round(avg((llm_level - human_level)::double), 9) + 0e0 from pairs) as bias""",
)
def _(spark, d):
    return r9(G.audit_summary(_audit_rows(spark, d)), "kappa", "mae", "bias")


@case(
    "s08_skipped_labels",
    """select (select count(*) from pairs) as n, (select count(*) from latest_machine) - (select count(*) from pairs) as n_skipped""",
)
def _(spark, d):
    return skipped_labels(_audit_rows(spark, d))


@case(
    "t02_mismatches",
    """select item_id, llm_level, human_level, abs(llm_level - human_level) as gap,
         llm_level = 4 or human_level = 4 as level_4_case,
         case when length(clean_text) > 140 then substring(clean_text, 1, 137) || '...' else clean_text end as preview
       from pairs join items using (item_id) where llm_level <> human_level""",
)
def _(spark, d):
    return G.mismatches(pairs_of(spark, d), table(spark, d, "items"))


# -- forecast scores ---------------------------------------------------------


def scored_of(spark, d):
    """Long frame of both models' forecasts with labels, binary targets."""
    panes = panes_of(spark, d)
    windows = WN.outcomes_from_panes(panes, windows_of(spark, d))
    rows = P.align_predictions(windows, predictions_from(panes, spark, d))
    long = BT._long(rows.withColumnRenamed("model_version", "score_set"))
    return long.where("target <> 'c1'").withColumnRenamed("score_set", "model_version")


BY = ["model_version", "target"]


@case(
    "a15_expected_calibration_error",
    """select model_version, target, sum(n)::bigint as n, round(sum(n * abs(acc - conf)) / sum(n), 9) as ece from (
         select model_version, target, bin, count(*) as n, avg(label::double) as acc, avg(prob) as conf from binned
         group by 1, 2, 3) group by 1, 2""",
    binned="""select model_version, target, prob, label, (prob >= 0.1e0)::int + (prob >= 0.2e0)::int + (prob >= 0.1e0 * 3)::int
         + (prob >= 0.4e0)::int + (prob >= 0.5e0)::int + (prob >= 0.1e0 * 6)::int + (prob >= 0.1e0 * 7)::int
         + (prob >= 0.8e0)::int + (prob >= 0.9e0)::int as bin from scored""",
)
def _(spark, d):
    return r9(M.expected_calibration_error(scored_of(spark, d), BY), "ece")


@case(
    "x03_reliability_table",
    """select model_version, target, bin, count(*) as n, round(avg(prob), 9) as confidence, round(avg(label::double), 9) as accuracy
       from binned group by 1, 2, 3""",
    binned="""select model_version, target, prob, label, (prob >= 0.1e0)::int + (prob >= 0.2e0)::int + (prob >= 0.1e0 * 3)::int
         + (prob >= 0.4e0)::int + (prob >= 0.5e0)::int + (prob >= 0.1e0 * 6)::int + (prob >= 0.1e0 * 7)::int
         + (prob >= 0.8e0)::int + (prob >= 0.9e0)::int as bin from scored""",
)
def _(spark, d):
    return r9(M.reliability_table(scored_of(spark, d), BY), "confidence", "accuracy")


CUMULATIVE = """select model_version, target, prob, pos, n, sum(pos) over (partition by model_version, target) as total_pos,
         sum(n) over (partition by model_version, target) as total_n,
         sum(pos) over (partition by model_version, target order by prob desc) as cum_pos,
         sum(n) over (partition by model_version, target order by prob desc) as cum_n
       from (select model_version, target, prob, sum(label)::bigint as pos, count(*) as n from scored group by 1, 2, 3)"""


@case(
    "a16_average_precision",
    """select model_version, target, sum(n)::bigint as n, round(coalesce(sum(case when total_pos > 0 and total_pos < total_n
         then pos::double / total_pos * cum_pos / cum_n end), 0.0), 9) as auc_pr from cumulative group by 1, 2""",
    cumulative=CUMULATIVE,
)
def _(spark, d):
    return r9(M.average_precision(scored_of(spark, d), BY), "auc_pr")


@case(
    "a17_pr_curve",
    """select model_version, target, round(prob, 9) as threshold, round(cum_pos::double / cum_n, 9) as precision,
         round(case when total_pos > 0 then cum_pos::double / total_pos else 1.0 end, 9) as recall from cumulative
       union all select distinct model_version, target, null, 1.0, 0.0 from scored""",
    cumulative=CUMULATIVE,
)
def _(spark, d):
    return r9(M.pr_curve(scored_of(spark, d), BY), "threshold", "precision", "recall")


@case(
    "f04_cumulative_counts",
    """select model_version, target, round(prob, 9) as score, pos, n, total_pos::bigint as total_pos, total_n::bigint as total_n,
         cum_pos::bigint as cum_pos, cum_n::bigint as cum_n from cumulative""",
    cumulative=CUMULATIVE,
)
def _(spark, d):
    return r9(M._ranked(scored_of(spark, d), BY, "prob", "label", None), "score")


@case(
    "a18_brier_score",
    "select model_version, target, count(*) as n, round(avg((prob - label) * (prob - label)), 9) as brier from scored group by 1, 2",
)
def _(spark, d):
    return r9(M.brier_score(scored_of(spark, d), BY), "brier")


def split_of(spark, d):
    """Scored windows of the whole grid, split in the middle."""
    panes = panes_of(spark, d)
    windows = WN.ecosystem_from_panes(WN.outcomes_from_panes(panes, windows_of(spark, d)), panes)
    return BT.split_windows(stored(windows), None), panes


FIGURES = ("auc_pr", "ece", "mae", "base_rate")


@case("a19_target_metrics", f"select score_set, target, n, {r9sql(*FIGURES)} from test_metrics where n > 0")
def _(spark, d):
    windows, panes = split_of(spark, d)
    models = P.align_predictions(windows.where("is_test"), predictions_from(panes, spark, d))
    long = BT._long(B.baseline_probs(windows)).unionByName(
        BT._long(models.withColumnRenamed("model_version", "score_set"))
    )
    return r9(M.target_metrics(long, ["score_set"]), *FIGURES)


@case("a20_score_sets", f"select score_set, n_test, target, n, {r9sql(*FIGURES)} from test_metrics")
def _(spark, d):
    windows, panes = split_of(spark, d)
    return r9(BT.score_sets(windows, predictions_from(panes, spark, d)), *FIGURES)


def outcomes_of(spark, d):
    """Stored outcomes of every grid window."""
    return stored(WN.window_outcomes(posts_of(spark, d, True), windows_of(spark, d)))


def report_of(spark, d):
    """The backtest over stored outcomes and forecasts, ecosystem context from posts."""
    panes = panes_of(spark, d)
    outcomes = WN.outcomes_from_panes(panes, windows_of(spark, d))
    return BT.backtest_report(
        outcomes, predictions_from(panes, spark, d), None, *period_of(spark, d), panes=panes
    )


@case("a24_backtest_report", f"select score_set, n_test, target, n, {r9sql(*FIGURES)} from test_metrics")
def _(spark, d):
    return r9(report_of(spark, d).metrics, *FIGURES)


@case(
    "a24_backtest_header",
    """select (select min(h) from spine) as period_start, (select max(h) + interval 2 hours from spine) as period_end, max(train_until) as train_until,
         count(*) as n_windows_total, count(*) filter (not is_test) as n_windows_train,
         count(*) filter (is_test) as n_windows_test, (sum(eco_n_6h) filter (is_test))::bigint as ecosystem_posts_test,
         concat_ws(',', case when count(*) filter (is_test) = 0 then 'empty_test_set' end,
           case when count(*) filter (not is_test) = 0 then 'empty_train_set_b1_zero' end,
           case when sum(eco_n_6h) filter (is_test) = 0 then 'no_ecosystem_data_b4_degenerate' end) as notes
       from splitted""",
)
def _(spark, d):
    return report_of(spark, d).header.withColumn("notes", F.concat_ws(",", "notes"))


_RATES = ("rate_3", "rate_4", "rate_5", "rate_6", "jump_rate", "posts_rate")


@case("a09_marginal_rates", f"select {r9sql(*_RATES)} from rates")
def _(spark, d):
    windows, _panes = split_of(spark, d)
    return r9(B.marginal_rates(windows.where("not is_test")), *_RATES)


@case("f02_previous_v_max", "select window_start, window_end, v_max, prev_v_max from numbered")
def _(spark, d):
    out = outcomes_of(spark, d)
    return B.previous_v_max(out.select("window_start", "window_end", "v_max"))


@case(
    "f02_previous_v_max_min_gap",
    """select o.window_start, o.window_end, o.v_max, p.v_max as prev_v_max from outcomes o
       left join outcomes p on p.window_end = o.window_start""",
)
def _(spark, d):
    out = outcomes_of(spark, d)
    return B.previous_v_max(out.select("window_start", "window_end", "v_max"), min_gap=True)


@case("f03_default_split_point", "select max(train_until) as train_until from splitted")
def _(spark, d):
    return B.default_split_point(outcomes_of(spark, d))


@case("f06_chronological_split", "select window_start, window_end, train_until, is_test from splitted")
def _(spark, d):
    windows = outcomes_of(spark, d)
    return BT.split_windows(windows, None).select("window_start", "window_end", "train_until", "is_test")


_BASE = ("c2_3_prob", "c2_4_prob", "c2_5_prob", "c2_6_prob", "c3_prob", "c4_prob")


@case("f07_baseline_probs", f"select window_start, score_set, {r9sql(*_BASE)} from base")
def _(spark, d):
    windows, _panes = split_of(spark, d)
    return r9(B.baseline_probs(windows).select("window_start", "score_set", *_BASE), *_BASE)


@case(
    "m04_chrono_holdout",
    """select window_start, row_number() over (order by window_start, window_end) > count(*) over () - ceil(count(*) over () * 0.2e0)
         as is_holdout from outcomes""",
)
def _(spark, d):
    out = outcomes_of(spark, d)
    return B.chrono_holdout(out, "window_start", ["window_end"]).select("window_start", "is_holdout")


@case(
    "j07_align_predictions",
    f"""select window_start, model_version, v_max, {', '.join(f'round(coalesce({c}, 0.0), 9) as {c}' for c in PROB_COLUMNS)}
        from outcomes join predictions using (window_start, window_end)""",
)
def _(spark, d):
    panes = panes_of(spark, d)
    rows = P.align_predictions(WN.outcomes_from_panes(panes, windows_of(spark, d)), predictions_from(panes, spark, d))
    return r9(rows.select("window_start", "model_version", "v_max", *PROB_COLUMNS), *PROB_COLUMNS)


@case("t03_outcomes_in_order", "select window_start, window_end, v_max, n_posts, had_jump from outcomes")
def _(spark, d):
    out = outcomes_of(spark, d)
    return P.outcomes_in_order(out, *period_of(spark, d)).drop("v_recent")


# -- drift -------------------------------------------------------------------

_HALF = "timestamp '2024-01-16'"


def _halves(spark, d):
    ev = given(spark, d, "events").select("event_type", "ts", "value")
    first = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    return ev.where(first), ev.where(~first)


_QS = "[" + ", ".join(f"{i} * 0.1e0" for i in range(1, 10)) + "]"


def _psi_sql(by: str) -> str:
    group = f"{by}, " if by else ""
    using = f"using ({by})" if by else "on true"
    index = " + ".join(f"(value >= q[{i}])::int" for i in range(1, 10))
    return f"""select {group}max(ne) as n_expected, max(na) as n_actual,
          round(sum((pa - pe) * ln(pa / pe)), 9) + 0e0 as psi from (
        select {group}b, ne, na, (coalesce(e, 0) + 1)::double / (ne + 10) as pe, (coalesce(a, 0) + 1)::double / (na + 10) as pa
        from (select {group}count(*) filter (ts < {_HALF}) as ne, count(*) filter (ts >= {_HALF}) as na
              from events {'group by ' + by if by else ''}) n
        join (select unnest(range(0, 10)) as b) bins on true
        left join (select {group}{index} as b, count(*) filter (ts < {_HALF}) as e, count(*) filter (ts >= {_HALF}) as a
              from events join (select {group}quantile_cont(value, {_QS}) as q from events where ts < {_HALF}
                {'group by ' + by if by else ''}) q {using} group by {group}b) c using ({group}b))
        {'group by ' + by if by else ''}"""


@case("a21_psi", _psi_sql(""))
def _(spark, d):
    return r9(D.psi(*_halves(spark, d), "value"), "psi")


@case("a21_psi_by_type", _psi_sql("event_type"))
def _(spark, d):
    return r9(D.psi(*_halves(spark, d), "value", ["event_type"]), "psi")


@case(
    "a21_exact_quantiles",
    f"""select event_type, i::int as pos, round(q[i + 1], 9) as edge, n from (
          select event_type, quantile_cont(value, {_QS}) as q, count(*) as n, unnest(range(0, 9)) as i from events group by 1)""",
)
def _(spark, d):
    q = exact_quantiles(given(spark, d, "events"), "value", [i * 0.1 for i in range(1, 10)], ["event_type"], "q")
    return r9(q.select("event_type", F.posexplode("q").alias("pos", "edge"), "n"), "edge")


_EDGES = [0.0, 10.0, 20.0, 40.0, 80.0, 160.0, 320.0, 1000.0]


@case(
    "a22_histogram",
    """select t.event_type, b.bin::int as bin, b.lo, b.hi, count(e.value) as n from (select distinct event_type from events) t
       join (select i as bin, ([0.0, 10.0, 20.0, 40.0, 80.0, 160.0, 320.0, 1000.0]::double[])[i + 1] as lo,
               ([0.0, 10.0, 20.0, 40.0, 80.0, 160.0, 320.0, 1000.0]::double[])[i + 2] as hi
             from (select unnest(range(0, 7)) as i)) b on true
       left join events e on e.event_type = t.event_type and e.value >= b.lo and (e.value < b.hi or (b.bin = 6 and e.value = b.hi))
       group by 1, 2, 3, 4""",
)
def _(spark, d):
    return M.histogram(given(spark, d, "events"), "value", _EDGES, ["event_type"])
