"""Queries over the figures and feature families the specification adds."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from brinkcast.catalog.bridge import given, table
from brinkcast.catalog.core import case, panes_of, posts_of, predictions_from, r9, r9sql, spine_of, windows_of
from brinkcast.catalog.scoring import BY, CUMULATIVE, scored_of, split_of
from brinkcast.functions import text
from brinkcast.functions.scores import PROB_COLUMNS
from brinkcast.functions.times import grid_spine, time_literal
from brinkcast.operators import aliases
from brinkcast.operators import baselines as B
from brinkcast.operators import diagnostics as X
from brinkcast.operators import drift as D
from brinkcast.operators import families as FM
from brinkcast.operators import metrics as M
from brinkcast.operators import predictions as P
from brinkcast.operators import windows as WN
from brinkcast.operators.annotations import items_with_latest
from brinkcast.operators.ordered import stored
from brinkcast.plans import backtest as BT


@case(
    "x01_ranking_metrics",
    """select model_version, target, sum(n)::bigint as n,
         round(sum(pos * (neg - ((cum_n - n) - (cum_pos - pos)) - (n - pos) + (n - pos) / 2e0) / total_pos / neg), 9) as auc_roc,
         round(max(2e0 * cum_pos / (cum_n + total_pos)), 9) as best_f1,
         round(coalesce(max(case when cum_pos::double / cum_n >= 0.8e0 then cum_pos::double / total_pos end), 0), 9) as recall_at_precision
       from (select *, total_n - total_pos as neg from cumulative) group by 1, 2""",
    cumulative=CUMULATIVE,
)
def _(spark, d):
    out = M.ranking_metrics(scored_of(spark, d), BY).drop("best_threshold")
    return r9(out, "auc_roc", "best_f1", "recall_at_precision")


@case(
    "x01_spearman",
    """select event_type, count(*) as n, round(corr(rx, ry), 9) as rho from (
         select event_type, avg(px) over (partition by event_type, value) as rx, avg(py) over (partition by event_type, user_id) as ry
         from (select event_type, value, user_id, row_number() over (partition by event_type order by value) as px,
                 row_number() over (partition by event_type order by user_id) as py from events)) group by 1""",
)
def _(spark, d):
    return r9(M.spearman(given(spark, d, "events"), "value", "user_id", ["event_type"]), "rho")


def _hits(panes, spark, d):
    windows = WN.outcomes_from_panes(panes, windows_of(spark, d)).where("had_jump")
    preds = predictions_from(panes, spark, d).select("made_at", "window_start", "window_end", "model_version", "c3_prob")
    return windows.join(preds, ["window_start", "window_end"]).where("c3_prob >= 0.2").select(
        "made_at", "window_start", "window_end", "model_version", "v_recent"
    )


@case(
    "x02_mean_lead_time",
    """select model_version, count(*) as n_hits, round(avg(lead), 9) as mean_lead_minutes from (
         select model_version, window_start, date_diff('microsecond', window_start, min(published_at)) / 60e6 as lead
         from outcomes join predictions using (window_start, window_end)
         join (select * from posts where is_primary) p on published_at >= window_start and published_at < window_end
         where had_jump and c3_prob >= 0.2e0 and valence_level >= v_recent + 2 group by 1, 2) group by 1""",
)
def _(spark, d):
    out = X.mean_lead_time(_hits(panes_of(spark, d), spark, d), posts_of(spark, d, True), ["model_version"])
    return r9(out, "mean_lead_minutes")


_STRATA = """select w.window_start,
      case when exists (select 1 from big where ts > w.window_start - interval 6 hours and ts <= w.window_start) then 'event' else 'normal' end as regime,
      exists (select 1 from rulings where ts > w.window_start - interval 48 hours and ts <= w.window_start + interval 48 hours) as decision,
      hour(timezone('America/New_York', timezone('UTC', w.window_start))) between 6 and 8
        and isodow(timezone('America/New_York', timezone('UTC', w.window_start))) <= 5 as morning,
      exists (select 1 from seen where first_seen > w.window_start - interval 720 hours and first_seen <= w.window_start) as emerging
    from windows w"""
_STRATA_VIEWS = {
    "big": "select ts from events where value >= 200",
    "rulings": "select ts from events where value >= 300",
    "seen": "select props, min(ts) as first_seen from events group by 1",
    "tagged": _STRATA,
}


def _tagged(spark, d, windows):
    ev = given(spark, d, "events")
    topics = ev.select(F.col("props").alias("topic"), F.col("ts").alias("published_at"))
    return X.evaluation_strata(windows, ev.where("value >= 200"), ev.where("value >= 300"), topics)


@case(
    "x04_evaluation_strata",
    """select window_start, concat_ws(',', regime, case when morning then 'morning' end, case when decision then 'decision' end,
         case when emerging then 'emerging' else 'evergreen' end) as strata from tagged""",
    **_STRATA_VIEWS,
)
def _(spark, d):
    out = _tagged(spark, d, windows_of(spark, d))
    return out.select("window_start", F.concat_ws(",", "strata").alias("strata"))


@case(
    "x04_metrics_by_stratum",
    """select model_version, target, stratum, count(*) as n, round(avg(label::double), 9) as base_rate from (
         select model_version, t.target, t.label, stratum from (
           select p.model_version, window_start, unnest([
            {'target': 'c2_3', 'label': (v_max >= 3)::int}, {'target': 'c2_4', 'label': (v_max >= 4)::int},
            {'target': 'c2_5', 'label': (v_max >= 5)::int}, {'target': 'c2_6', 'label': (v_max >= 6)::int},
            {'target': 'c3', 'label': had_jump::int}, {'target': 'c4', 'label': (n_posts > 0)::int}]) as t
           from outcomes join predictions p using (window_start, window_end))
         join (select window_start, unnest(string_split(concat_ws(',', regime, case when morning then 'morning' end,
             case when decision then 'decision' end, case when emerging then 'emerging' else 'evergreen' end), ',')) as stratum
           from tagged) using (window_start)) group by 1, 2, 3""",
    **_STRATA_VIEWS,
)
def _(spark, d):
    panes = panes_of(spark, d)
    windows = _tagged(spark, d, WN.outcomes_from_panes(panes, windows_of(spark, d)))
    rows = P.align_predictions(windows, predictions_from(panes, spark, d))
    long = _long_with(rows, ["model_version", "strata"])
    out = X.metrics_by_stratum(long.where("target <> 'c1'"), ["model_version"])
    return r9(out.select("model_version", "target", "stratum", "n", "base_rate"), "base_rate")


def _long_with(rows, keep):
    """Long form of aligned forecasts that keeps further columns."""
    packed = rows.withColumn("score_set", F.struct(*keep))
    return BT._long(packed).select("score_set.*", "target", "prob", "label")


def _test_long(spark, d):
    """Aligned forecasts of the test windows, long, with the window."""
    windows, panes = split_of(spark, d)
    rows = P.align_predictions(windows.where("is_test"), predictions_from(panes, spark, d))
    return _long_with(rows.withColumnRenamed("model_version", "score_set"), ["score_set", "window_start", "window_end"])


@case(
    "x05_confident_errors",
    """select model_version as score_set, window_start, target, round(prob, 9) as prob, label from (
         select p.model_version, window_start, unnest(['c2_3', 'c2_4', 'c2_5', 'c2_6', 'c3', 'c4']) as target,
           unnest([c2_3_prob, c2_4_prob, c2_5_prob, c2_6_prob, c3_prob, coalesce(c4_prob, 0.0)]) as prob,
           unnest([(v_max >= 3)::int, (v_max >= 4)::int, (v_max >= 5)::int, (v_max >= 6)::int, had_jump::int, (n_posts > 0)::int]) as label
         from splitted join predictions p using (window_start, window_end) where is_test)
       where prob >= 0.8e0 and label = 0 order by prob desc, window_start, model_version, target limit 20""",
)
def _(spark, d):
    out = X.confident_errors(_test_long(spark, d).where("target <> 'c1'"))
    return r9(out.drop("window_end"), "prob")


@case(
    "x05_surprises",
    """select window_start, model_version, v_max, round(v_max - c1_value, 9) as gap from splitted
       join predictions using (window_start, window_end) where is_test and v_max - c1_value >= 2
       order by v_max - c1_value desc, window_start, model_version limit 20""",
)
def _(spark, d):
    windows, panes = split_of(spark, d)
    rows = P.align_predictions(windows.where("is_test"), predictions_from(panes, spark, d))
    return r9(X.surprises(rows).select("window_start", "model_version", "v_max", "gap"), "gap")


_STEPS = " + ".join(f"(u >= {s!r}::double)::int" for s in X.POISSON_STEPS)


def _gain_of(spark, d):
    windows, panes = split_of(spark, d)
    mine = P.align_predictions(windows.where("is_test"), predictions_from(panes, spark, d)).where(
        "model_version = 'trailing-mix-1'"
    )
    rival = B.baseline_probs(windows).where("score_set = 'B4'").select("window_start", F.col("c2_4_prob").alias("rival"))
    pairs = mine.select("window_start", F.col("c2_4_prob").alias("prob"), (F.col("v_max") >= 4).cast("int").alias("label"))
    return X.bootstrap_gain(pairs.join(rival, "window_start"))


@case(
    "x06_bootstrap_gain",
    f"""select round(max(gain) filter (r = 0), 9) as mean_gain, round(avg((gain <= 0)::int::double) filter (r > 0), 9) as p_no_gain
        from (select r, sum(w * gain) / sum(w) as gain from (
          select r, gain, case when r = 0 then 1 else {_STEPS} end as w from (
            select r, gain, ('0x' || substring(md5(strftime(window_start, '%Y-%m-%d %H:%M:%S') || ':' || r), 1, 8))::bigint / 4294967296e0 as u
            from gains, (select unnest(range(0, 201)) as r))) group by r)""",
    gains="""select window_start, power(b.c2_4_prob - (s.v_max >= 4)::int, 2) - power(p.c2_4_prob - (s.v_max >= 4)::int, 2) as gain
        from splitted s join predictions p using (window_start) join base b using (window_start)
        where p.model_version = 'trailing-mix-1' and b.score_set = 'B4' and s.is_test""",
)
def _(spark, d):
    return r9(_gain_of(spark, d), "mean_gain", "p_no_gain")


@case("x06_promotion_gate")
def _(spark, d):
    return X.promotion_gate(_test_long(spark, d), "trailing-mix-1", "tenths-001", _gain_of(spark, d))


_SPAN_SQL = ", ".join(
    f"""count(y) filter (t > -{s}) as n_{s}h, round(coalesce(avg(y) filter (t > -{s}), 0.0), 7) as mean_{s}h,
        coalesce(max(y) filter (t > -{s}), -1)::int as max_{s}h,
        round(coalesce(stddev_pop(y) filter (t > -{s}), 0.0), 7) as std_{s}h"""
    for s in (1, 6, 24)
)
_STATS = [f"{m}_{s}h" for s in (1, 6, 24) for m in ("mean", "std")]


@case(
    "x07_level_statistics",
    f"""select h, {_SPAN_SQL}, round(case when count(y) filter (t > -6) > 1 then regr_slope(y, t) filter (t > -6) end, 6) as slope_6h,
          round(case when count(y) filter (t > -6) > 1 then regr_slope(y, t) filter (t > -6) - regr_slope(y, t) end, 6) as acceleration
        from (select h, valence_level::double as y, date_diff('microsecond', h, published_at) / 3600e6 as t
              from spine left join (select * from posts where valence_level is not null) p
                on published_at > h - interval 24 hours and published_at <= h) group by h""",
)
def _(spark, d):
    out = FM.level_statistics(posts_of(spark, d), spine_of(spark, d))
    out = out.withColumns({c: F.round(c, 7) for c in _STATS})
    return out.withColumns({c: F.round(c, 6) for c in ("slope_6h", "acceleration")})


@case(
    "x07_calendar_features",
    """select h, hour(h)::int as hour, isodow(h)::int as weekday, round(date_diff('microsecond', max(published_at), h) / 60e6, 9) as minutes_since_post
       from spine left join (select * from posts where is_primary) p on published_at <= h group by h""",
)
def _(spark, d):
    return r9(FM.calendar_features(spine_of(spark, d), posts_of(spark, d, True)), "minutes_since_post")


_WORDS = ["the", "und", "que", "with"]


@case(
    "x07_text_markers",
    """select doc_id, round(case when letters > 0 then caps::double / letters else 0 end, 9) as caps,
         round(case when length(text) > 0 then marks::double / length(text) else 0 end, 9) as marks,
         round(case when t.clean = '' then 0 else len(list_filter(string_split(lower(t.clean), ' '), lambda w: w in ('the', 'und', 'que', 'with')))::double
           / len(string_split(t.clean, ' ')) end, 9) as intensity
       from (select doc_id, text, len(regexp_extract_all(text, '\\p{L}')) as letters, len(regexp_extract_all(text, '\\p{Lu}')) as caps,
               len(regexp_extract_all(text, '[!?]')) as marks,
               trim(regexp_replace(text, '[\\x09-\\x0d\\x1c-\\x20\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')) as clean
             from documents) t""",
)
def _(spark, d):
    body = F.col("text")
    rows = given(spark, d, "documents").select(
        "doc_id",
        text.caps_ratio(body).alias("caps"),
        text.punctuation_density(body).alias("marks"),
        text.intensifier_density(text.normalize_text(body), _WORDS).alias("intensity"),
    )
    return r9(rows, "caps", "marks", "intensity")


_ALIASES = {"alpha": ["1", "one"], "beta": ["2"], "gamma": ["33", "44"], "delta": ["7"]}
_HITS = "list_filter([" + ", ".join(
    "case when " + " or ".join(f"contains(lower(clean_text), '{a}')" for a in _ALIASES[e]) + f" then '{e}' end"
    for e in sorted(_ALIASES)
) + "], lambda x: x is not null)"
_MENTIONS = {"naming": f"select published_at, {_HITS} as entities from items join raw_items using (raw_item_id)"}


def _naming(spark, d):
    posts = table(spark, d, "items").join(table(spark, d, "raw_items").select("raw_item_id", "published_at"), "raw_item_id")
    return posts.select("published_at", text.entity_hits(F.col("clean_text"), _ALIASES).alias("entities"))


@case(
    "x08_entity_counts",
    """select h, entity, count(*) filter (published_at > h - interval 6 hours) as n_6h, count(*) as n_24h
       from spine join (select published_at, unnest(entities) as entity from naming) m
         on published_at > h - interval 24 hours and published_at <= h group by h, entity""",
    **_MENTIONS,
)
def _(spark, d):
    return FM.entity_counts(_naming(spark, d), spine_of(spark, d))


@case(
    "x08_entity_pairs",
    """select h, entity_a, entity_b, count(*) filter (published_at > h - interval 6 hours) as n_6h, count(*) as n_24h
       from spine join (select a.published_at, a.e as entity_a, b.e as entity_b
             from (select rowid_ as r, published_at, unnest(entities) as e from numbered_naming) a
             join (select rowid_ as r, unnest(entities) as e from numbered_naming) b on a.r = b.r and a.e < b.e) m
         on published_at > h - interval 24 hours and published_at <= h group by h, entity_a, entity_b""",
    **_MENTIONS,
    numbered_naming="select row_number() over () as rowid_, * from naming",
)
def _(spark, d):
    return FM.entity_pairs(_naming(spark, d), spine_of(spark, d))


_TOKENS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}]+')"


@case(
    "x08_alias_mentions",
    """select entity, count(*)::bigint as mentions, count(distinct doc_id) as posts from alias_hits h
       where not exists (select 1 from alias_hits o where o.doc_id = h.doc_id and o.n > h.n
         and o.start <= h.start and o.start + o.n >= h.start + h.n) group by entity""",
    named_words=f"select item_id as entity, unnest([w[1:2], w[1:4]]) as words from (select item_id, {_TOKENS} as w from benchmark)",
    named="select distinct entity, len(words)::int as n, array_to_string(words, ' ') as gram from named_words where len(words) > 0",
    doc_words=f"select doc_id, {_TOKENS} as w from documents",
    doc_grams="""select doc_id, n, start::int as start, array_to_string(w[start:start + n - 1], ' ') as gram from (
        select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as start from doc_words, (select distinct n from named) l)""",
    alias_hits="select doc_id, start, n, entity from doc_grams join named using (n, gram)",
)
def _(spark, d):
    """Passages by their first two or four words: the alias table comes out of ``benchmark``."""
    words = aliases.tokens(F.col("text"))
    listed = given(spark, d, "benchmark").select(
        F.col("item_id").alias("entity"),
        F.explode(F.array(*[F.array_join(F.slice(words, 1, n), " ") for n in (2, 4)])).alias("alias"),
    )
    return aliases.alias_mentions(given(spark, d, "documents"), listed, "doc_id", "text")


_ROLL = {
    "day_scored": """select model_version, t.target, t.prob, t.label, window_end::date as day from (
        select p.model_version, window_end, unnest([
          {'target': 'c2_4', 'prob': coalesce(c2_4_prob, 0.0), 'label': (v_max >= 4)::int},
          {'target': 'c2_5', 'prob': coalesce(c2_5_prob, 0.0), 'label': (v_max >= 5)::int},
          {'target': 'c4', 'prob': coalesce(c4_prob, 0.0), 'label': (n_posts > 0)::int}]) as t
        from outcomes join predictions p using (window_start, window_end))""",
    "day_spans": "select unnest([7, 30]) as span",
    "day_rows": """select s.model_version, s.target, e.day, span, prob, label from (select distinct day from day_scored) e
        join day_spans on true join day_scored s on s.day > e.day - span and s.day <= e.day""",
    "day_ap": """select model_version, target, day, span, sum(n)::bigint as n, sum(pos)::bigint as pos,
          sum(pos::double / nullif(total, 0) * cp / cn) as ap from (
        select *, sum(pos) over (partition by model_version, target, day, span) as total,
          sum(pos) over (partition by model_version, target, day, span order by prob desc) as cp,
          sum(n) over (partition by model_version, target, day, span order by prob desc) as cn
        from (select model_version, target, day, span, prob, count(*) as n, sum(label) as pos from day_rows group by all)) group by all""",
    "day_ece": """select model_version, target, day, span, sum(n * abs(acc - conf)) / sum(n) as ece from (
        select model_version, target, day, span, count(*) as n, avg(label::double) as acc, avg(prob) as conf from (
          select *, (prob >= 0.1e0)::int + (prob >= 0.2e0)::int + (prob >= 0.1e0 * 3)::int + (prob >= 0.4e0)::int
            + (prob >= 0.5e0)::int + (prob >= 0.1e0 * 6)::int + (prob >= 0.1e0 * 7)::int + (prob >= 0.8e0)::int + (prob >= 0.9e0)::int as bin
          from day_rows) group by model_version, target, day, span, bin) group by all""",
    "day_brier": "select model_version, target, day, span, avg((prob - label) * (prob - label)) as brier from day_rows group by all",
    "rolled": """select model_version, target, day,
          max(n) filter (span = 7) as n_7d, max(n) filter (span = 30) as n_30d,
          max(case when pos > 0 and pos < n then ece end) filter (span = 7) as ece_7d, max(case when pos > 0 and pos < n then ece end) filter (span = 30) as ece_30d,
          max(case when pos > 0 and pos < n then ap end) filter (span = 7) as auc_pr_7d, max(case when pos > 0 and pos < n then ap end) filter (span = 30) as auc_pr_30d,
          max(brier) filter (span = 7) as brier_7d, max(brier) filter (span = 30) as brier_30d
        from day_ap join day_ece using (model_version, target, day, span) join day_brier using (model_version, target, day, span)
        group by all""",
}
_ROLLED = [f"{m}_{s}d" for m in ("ece", "auc_pr", "brier") for s in (7, 30)]


def _rolling(spark, d):
    panes = panes_of(spark, d)
    rows = P.align_predictions(WN.outcomes_from_panes(panes, windows_of(spark, d)), predictions_from(panes, spark, d))
    long = _long_with(rows, ["model_version", "window_end"]).where("target in ('c2_4', 'c2_5', 'c4')")
    return X.rolling_metrics(long, ["model_version"])


@case("x09_rolling_metrics", f"select model_version, target, day, n_7d, n_30d, {r9sql(*_ROLLED)} from rolled", **_ROLL)
def _(spark, d):
    return r9(_rolling(spark, d), *_ROLLED)


@case(
    "x09_drift_alerts",
    """select model_version, target, day,
         coalesce(ece_7d > 0.15e0 and lag(coalesce(ece_7d > 0.15e0, false)) over w and lag(day) over w = day - 1, false) as ece_alert,
         coalesce(auc_pr_7d < 0.85e0 * auc_pr_30d, false) as auc_pr_alert, coalesce(brier_7d > 1.25e0 * brier_30d, false) as brier_alert
       from rolled window w as (partition by model_version, target order by day)""",
    **_ROLL,
)
def _(spark, d):
    return X.drift_alerts(_rolling(spark, d), ["model_version"])


_QS = "[" + ", ".join(f"{i} * 0.1e0" for i in range(1, 10)) + "]"


@case(
    "x10_feature_psi",
    """select feature, max(ne) as n_expected, max(na) as n_actual, round(sum((pa - pe) * ln(pa / pe)), 9) + 0e0 as psi from (
         select feature, b, ne, na, (coalesce(e, 0) + 1)::double / (ne + 10) as pe, (coalesce(a, 0) + 1)::double / (na + 10) as pa
         from (select feature, count(*) filter (early) as ne, count(*) filter (not early) as na from melted group by 1) n
         join (select unnest(range(0, 10)) as b) bins on true
         left join (select feature, """
    + " + ".join(f"(value >= q[{i}])::int" for i in range(1, 10))
    + f""" as b, count(*) filter (early) as e, count(*) filter (not early) as a
               from melted join (select feature, quantile_cont(value, {_QS}) as q from melted where early group by 1) using (feature)
               group by feature, b) c using (feature, b)) group by feature""",
    melted="""select h < timestamp '2024-01-16' as early, unnest(['eco_mean_6h', 'eco_n_6h', 'primary_mean_24h', 'primary_n_24h',
           'primary_posts_6h']) as feature,
         unnest([eco_mean_6h, eco_n_6h::double, primary_mean_24h, primary_n_24h::double, primary_posts_6h::double]) as value
       from features""",
)
def _(spark, d):
    feats = WN.features_from_panes(panes_of(spark, d), spine_of(spark, d))
    early = F.col("h") < time_literal("2024-01-16")
    names = ["eco_mean_6h", "eco_n_6h", "primary_mean_24h", "primary_n_24h", "primary_posts_6h"]
    return r9(D.feature_psi(feats.where(early), feats.where(~early), names), "psi")


_SHARES = [f"share_{k}" for k in range(7)]


@case(
    "x10_label_drift",
    "select month, n, " + ", ".join(f"round(n_{k}::double / n, 9) as share_{k}" for k in range(7)) + """,
       round(""" + " + ".join(
        f"((n_{k} + 1)::double / (n + 7) - (h_{k} + 1)::double / (h + 7)) * ln(((n_{k} + 1)::double / (n + 7)) / ((h_{k} + 1)::double / (h + 7)))" for k in range(7)
    ) + """, 9) as psi from (select *, sum(n) over w as h, """ + ", ".join(f"sum(n_{k}) over w as h_{k}" for k in range(7)) + """
       from (select date_trunc('month', o_orderdate)::date as month, count(*) as n, """
    + ", ".join(f"count(*) filter (lvl = {k}) as n_{k}" for k in range(7))
    + """ from (select o_orderdate, least(6, floor(o_totalprice / 60000))::int as lvl from orders) group by 1)
       window w as (order by month rows between unbounded preceding and 1 preceding))""",
)
def _(spark, d):
    rows = given(spark, d, "orders").select(
        "o_orderdate", F.least(F.lit(6), F.floor(F.col("o_totalprice") / 60000)).cast("int").alias("lvl")
    )
    return r9(D.label_drift(rows, "o_orderdate", "lvl"), *_SHARES, "psi")


@case(
    "x11_month_split",
    """select o_orderkey, split from (select o_orderkey, case
         when o_orderdate >= timestamp '1998-08-01' - interval 24 months and o_orderdate < timestamp '1998-08-01' - interval 6 months then 'train'
         when o_orderdate >= timestamp '1998-08-01' - interval 6 months and o_orderdate < timestamp '1998-08-01' - interval 2 months then 'validation'
         when o_orderdate >= timestamp '1998-08-01' - interval 2 months and o_orderdate < timestamp '1998-08-01' then 'test' end as split
       from orders) where split is not null""",
)
def _(spark, d):
    rows = given(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("window_start"))
    return B.month_split(rows, time_literal("1998-08-01")).select("o_orderkey", "split")


@case(
    "x12_decayed_mean",
    """select h, round(case when sum(w) > 0 then sum(w * y) / sum(w) else 0 end, 8) as decayed_mean from (
         select h, valence_level as y, power(0.5e0, date_diff('microsecond', published_at, h) / 3600e6 / 2) as w
         from spine left join (select * from posts where not is_primary and valence_level is not null) p
           on published_at > h - interval 6 hours and published_at <= h) group by h""",
)
def _(spark, d):
    out = FM.decayed_mean(posts_of(spark, d).where("not is_primary"), spine_of(spark, d))
    return out.select("h", F.round("decayed_mean", 8).alias("decayed_mean"))


_GAPS = """select published_at, date_diff('microsecond', lag(published_at) over (order by published_at), published_at) as gap_us,
      date_diff('microsecond', lag(published_at) over (order by published_at), published_at) / 60e6 as gap_minutes
    from (select distinct published_at from posts where is_primary)"""


@case("x13_post_gaps", "select published_at, round(gap_minutes, 9) as gap_minutes from gaps", gaps=_GAPS)
def _(spark, d):
    return r9(FM.post_gaps(posts_of(spark, d, True)).drop("gap_us"), "gap_minutes")


@case(
    "x13_hazard_rows",
    """select h, round(date_diff('microsecond', (select max(published_at) from gaps where published_at <= h), h) / 60e6, 9) as minutes_since_post,
         round(coalesce(sum(gap_us)::double / count(gap_us) / 60e6, 0.0), 7) as mean_gap_24h, count(gap_us) as n_gaps_24h,
         (exists (select 1 from gaps where published_at >= h and published_at < h + interval 2 hours))::int as label
       from spine left join (select * from gaps where gap_us is not null) g on published_at > h - interval 24 hours and published_at <= h group by h""",
    gaps=_GAPS,
)
def _(spark, d):
    out = r9(FM.hazard_rows(posts_of(spark, d, True), spine_of(spark, d)), "minutes_since_post")
    return out.withColumn("mean_gap_24h", F.round("mean_gap_24h", 7))


def _as_of(spark, d, h: str):
    t = lambda n: table(spark, d, n)
    return FM.features_as_of(t("raw_items"), t("items"), t("sources"), t("annotations"), h, grid_spine(spark, h, h))


@case(
    "x14_features_as_of",
    """select timestamp '2024-01-20 12:00:00' as h,
         round(coalesce(avg(lvl::double) filter (not is_primary and published_at > timestamp '2024-01-20 06:00:00'), 0.0), 9) as eco_mean_6h,
         count(lvl) filter (not is_primary and published_at > timestamp '2024-01-20 06:00:00') as eco_n_6h,
         round(coalesce(avg(lvl::double) filter (is_primary), 0.0), 9) as primary_mean_24h,
         count(lvl) filter (is_primary) as primary_n_24h,
         count(*) filter (is_primary and published_at > timestamp '2024-01-20 06:00:00') as primary_posts_6h
       from (select r.published_at, f.is_primary, a.valence_level as lvl from raw_items r join flagged f using (source_id)
             left join known a on a.item_id = r.raw_item_id
             where r.captured_at <= timestamp '2024-01-20 12:00:00' and r.published_at > timestamp '2024-01-19 12:00:00'
               and r.published_at <= timestamp '2024-01-20 12:00:00')""",
    known="""select item_id, valence_level from (select *, row_number() over (partition by item_id order by annotated_at desc,
           labeler_version desc nulls first, annotator desc, valence_level desc) as rn
         from annotations where annotated_at <= timestamp '2024-01-20 12:00:00') where rn = 1""",
)
def _(spark, d):
    return r9(_as_of(spark, d, "2024-01-20 12:00:00"), "eco_mean_6h", "primary_mean_24h")


def _moment(spark, d):
    """Noon, ten days before the last post."""
    last = given(spark, d, "events").agg(F.date_format(F.max("ts"), "yyyy-MM-dd")).first()[0]
    return datetime.fromisoformat(last) - timedelta(days=9, hours=12)


def _then_and_now(spark, d):
    """Features of the day before a moment, as stored from tables that held only what was
    known then; the full tables, with later captures and labels; the moment; the day."""
    h = _moment(spark, d)
    day = grid_spine(spark, h - timedelta(days=1), h)
    raw, items, sources, ann = (table(spark, d, n) for n in ("raw_items", "items", "sources", "annotations"))
    at = time_literal(h)
    raw_then = stored(raw.where(F.col("captured_at") <= at))
    ann_then = stored(ann.where(F.col("annotated_at") <= at))
    once = stored(WN.features_at(items_with_latest(raw_then, items, sources, ann_then), day))
    return once, (raw, items, sources, ann), h, day


@case("x14_not_reproduced", "select h, 'stored' as side from features where false")
def _(spark, d):
    """Rows captured or labelled after the moment change nothing of what is recomputed as of it."""
    once, full, h, day = _then_and_now(spark, d)
    return FM.not_reproduced(once, FM.features_as_of(*full, h, day)).select("h", "side")


_STATE = ["eco_mean_6h", "eco_n_6h", "primary_mean_24h", "primary_n_24h", "primary_posts_6h"]


@case(
    "x14_leak_found",
    f"""select side, h, round(eco_mean_6h, 9) as eco_mean_6h, eco_n_6h, round(primary_mean_24h, 9) as primary_mean_24h, primary_n_24h, primary_posts_6h
        from ((select 'stored' as side, h, {", ".join(_STATE)} from state where side = 'stored'
               and (h, {", ".join(_STATE)}) not in (select (h, {", ".join(_STATE)}) from state where side = 'again'))
        union all (select 'again' as side, h, {", ".join(_STATE)} from state where side = 'again'
               and (h, {", ".join(_STATE)}) not in (select (h, {", ".join(_STATE)}) from state where side = 'stored')))""",
    moment="select date_trunc('day', max(ts)) - interval 9 days - interval 12 hours as h0 from events",
    known_then="""select item_id, valence_level from (select *, row_number() over (partition by item_id order by annotated_at desc,
           labeler_version desc nulls first, annotator desc, valence_level desc) as rn
         from annotations, moment where annotated_at <= h0) where rn = 1""",
    both_sides="""select 'stored' as side, r.published_at, f.is_primary, a.valence_level as lvl from moment, raw_items r join flagged f using (source_id)
           left join known_then a on a.item_id = r.raw_item_id where r.captured_at <= h0
         union all select 'again', r.published_at, f.is_primary, a.valence_level from raw_items r join flagged f using (source_id)
           left join latest a on a.item_id = r.raw_item_id""",
    state="""select side, h, coalesce(avg(lvl::double) filter (not is_primary and published_at > h - interval 6 hours), 0.0) as eco_mean_6h,
           count(lvl) filter (not is_primary and published_at > h - interval 6 hours) as eco_n_6h,
           coalesce(avg(lvl::double) filter (is_primary), 0.0) as primary_mean_24h, count(lvl) filter (is_primary) as primary_n_24h,
           count(published_at) filter (is_primary and published_at > h - interval 6 hours) as primary_posts_6h
         from (select unnest(generate_series(h0 - interval 24 hours, h0, interval 15 minutes)) as h from moment)
         cross join (select unnest(['stored', 'again']) as side)
         left join both_sides using (side) where published_at > h - interval 24 hours and published_at <= h group by side, h""",
)
def _(spark, d):
    """What a recomputation that looks at all rows gets wrong: the leak must show."""
    once, full, _, day = _then_and_now(spark, d)
    leaky = WN.features_at(items_with_latest(*full), day)
    return r9(FM.not_reproduced(once, leaky).select("side", "h", *_STATE), "eco_mean_6h", "primary_mean_24h")
