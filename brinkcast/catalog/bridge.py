"""The data model derived from the given tables, in SQL that Spark and DuckDB share.

Events play the posts: the number in ``props`` is the feed, ``value`` gives the
level.  Nothing is left out: every event is a post, and which posts carry which
labels follows from their type and value.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from brinkcast.session import pin_utc

FEED = "cast(regexp_extract(props, '[0-9]+', 0) as bigint)"
TARGET = (
    "case event_type when 'view' then 'none' when 'click' then 'person' "
    "when 'purchase' then 'institution' when 'signup' then 'media' else 'group' end"
)

# Views both engines run as they are.
SHARED: dict[str, str] = {
    "sources": f"""
        select distinct {FEED} as source_id, concat('feed_', regexp_extract(props, '[0-9]+', 0)) as name,
               case when {FEED} < 5 then '{{"primary":"true"}}' else '{{}}' end as metadata
        from events""",
    "raw_items": f"""
        select event_id as raw_item_id, {FEED} as source_id,
               concat('e', cast(event_id as string)) as external_id, ts as published_at,
               ts + interval 1 hour as captured_at, event_type as author, props as raw_content
        from events""",
    "items": """
        select event_id as item_id, event_id as raw_item_id, props as clean_text from events""",
    "annotations": f"""
        select event_id as item_id, 'llm' as annotator, 'v1.0' as labeler_version,
               cast(least(6, floor(value / 25)) as int) as valence_level,
               round(value - floor(value), 2) as confidence, {TARGET} as target_type,
               cast(null as string) as target_name, ts + interval 1 hour as annotated_at
        from events where event_type <> 'view' or value >= 25
        union all
        select event_id, 'llm', 'v1.2', cast(least(6, floor(value / 20)) as int),
               round(value - floor(value), 2), {TARGET}, cast(null as string),
               case when event_type = 'signup' then ts + interval 1 hour else ts + interval 1 day end
        from events where event_type in ('purchase', 'signup')
        union all
        select event_id, 'human_1', cast(null as string), cast(least(6, floor((value + 8) / 25)) as int),
               cast(null as double), {TARGET}, cast(null as string),
               case when event_type = 'purchase' then ts + interval 1 day else ts + interval 2 days end
        from events where event_type = 'error' or (event_type = 'purchase' and value >= 60)
        union all
        select event_id, 'human_2', cast(null as string), cast(least(6, floor(value / 30)) as int),
               cast(null as double), {TARGET}, cast(null as string), ts + interval 3 days
        from events where event_type = 'error' and value >= 100""",
    "gold": """
        select event_id as item_id, cast(least(6, floor(value / 25)) as int) as valence_level,
               'gold_v1' as gold_version
        from events where event_type = 'click' and value >= 100""",
    # Two loads that overlap by two days; failed fetches came twice in the second.
    "raw_existing": """
        select * from raw_items where published_at < cast('2024-01-20 00:00:00' as timestamp)""",
    "raw_incoming": """
        select * from raw_items where published_at >= cast('2024-01-18 00:00:00' as timestamp)
        union all
        select raw_item_id, source_id, external_id, published_at, captured_at + interval 1 hour, author,
               raw_content
        from raw_items
        where author = 'error' and published_at >= cast('2024-01-18 00:00:00' as timestamp)""",
}

# Views written out for DuckDB only; on the Spark side the library computes them.
DUCKDB: dict[str, str] = {
    "latest": """
        select * exclude (rn) from (
          select *, row_number() over (partition by item_id order by annotated_at desc,
                 labeler_version desc nulls first, annotator desc, valence_level desc) as rn
          from annotations) where rn = 1""",
    "latest_machine": """
        select * exclude (rn) from (
          select *, row_number() over (partition by item_id order by annotated_at desc,
                 labeler_version desc nulls first, annotator desc, valence_level desc) as rn
          from annotations where annotator like 'llm%') where rn = 1""",
    "latest_human": """
        select * exclude (rn) from (
          select *, row_number() over (partition by item_id order by annotated_at desc,
                 labeler_version desc nulls first, annotator desc, valence_level desc) as rn
          from annotations where annotator not like 'llm%') where rn = 1""",
    "flagged": """
        select source_id, name, coalesce(json_extract_string(metadata, '$.primary'), 'false') = 'true'
               as is_primary
        from sources""",
    "posts": """
        select r.raw_item_id, i.item_id, r.source_id, r.published_at, s.is_primary, l.valence_level
        from raw_items r join flagged s using (source_id) left join items i using (raw_item_id)
        left join latest l using (item_id)""",
    "spine": """
        select unnest(generate_series(lo::timestamp, hi::timestamp, interval 15 minutes)) as h
        from (select date_trunc('day', min(published_at)) as lo,
                     date_trunc('day', max(published_at)) + interval 1 day as hi from raw_items)""",
    "windows": "select h as window_start, h + interval 2 hours as window_end from spine",
    "features": """
        select h,
          coalesce(avg(valence_level::double) filter (not is_primary and published_at > h - interval 6 hours), 0.0) as eco_mean_6h,
          count(valence_level) filter (not is_primary and published_at > h - interval 6 hours) as eco_n_6h,
          coalesce(avg(valence_level::double) filter (is_primary), 0.0) as primary_mean_24h,
          count(valence_level) filter (is_primary) as primary_n_24h,
          count(raw_item_id) filter (is_primary and published_at > h - interval 6 hours) as primary_posts_6h
        from spine left join posts on published_at > h - interval 24 hours and published_at <= h
        group by h""",
    "recent": """
        select window_start, coalesce(avg(valence_level::double), 0.0) as v_recent
        from windows left join (select * from posts where is_primary) p
          on published_at > window_start - interval 24 hours and published_at <= window_start
        group by window_start""",
    "inside": """
        select window_start, window_end, coalesce(max(valence_level), -1)::int as v_max, count(item_id) as n_posts
        from windows left join (select * from posts where is_primary) p
          on published_at >= window_start and published_at < window_end
        group by window_start, window_end""",
    "outcomes": """
        select window_start, window_end, v_max, n_posts, v_recent,
               n_posts > 0 and v_max >= 0 and v_max >= v_recent + 2 as had_jump
        from inside join recent using (window_start)""",
    "probs": """
        select *,
          least(6.0, greatest(0.0, 0.55e0 * eco_mean_6h + 0.45e0 * primary_mean_24h))::double as c1_value,
          least(0.99e0, greatest(0.01e0, 1 / (1 + exp(-(1.1e0 * (eco_mean_6h - 2.25e0) + 0.35e0 * (primary_mean_24h - 1.75e0)))))) as c2_3_prob,
          least(0.99e0, greatest(0.01e0, 1 / (1 + exp(-(1.1e0 * (eco_mean_6h - 3.25e0) + 0.35e0 * (primary_mean_24h - 2.75e0)))))) as c2_4_prob,
          least(0.99e0, greatest(0.01e0, 1 / (1 + exp(-(1.1e0 * (eco_mean_6h - 4.25e0) + 0.35e0 * (primary_mean_24h - 3.75e0)))))) as c2_5_prob,
          least(0.99e0, greatest(0.01e0, 1 / (1 + exp(-(1.1e0 * (eco_mean_6h - 5.25e0) + 0.35e0 * (primary_mean_24h - 4.75e0)))))) as c2_6_prob,
          least(0.99e0, greatest(0.01e0, 1 / (1 + exp(-((eco_mean_6h - primary_mean_24h) - 1.25e0 + 0.1e0 * (primary_posts_6h - 2)))))) as c3_prob,
          least(0.95e0, greatest(0.02e0, 1 - exp(-2e0 * greatest(primary_posts_6h / 6e0, 0.01e0)))) as c4_prob
        from features""",
    # Two models: the simple predictor, stored at nine decimals (``exp`` differs in
    # the last bit between engines, and equal scores must be equal on both), and
    # one whose scores are cut to tenths (ties, bin borders) without c4.
    "predictions": """
        select h as made_at, h as window_start, h + interval 2 hours as window_end,
               'trailing-mix-1' as model_version, round(c1_value, 9) as c1_value, round(c2_3_prob, 9) as c2_3_prob,
               round(c2_4_prob, 9) as c2_4_prob, round(c2_5_prob, 9) as c2_5_prob, round(c2_6_prob, 9) as c2_6_prob,
               round(c3_prob, 9) as c3_prob, round(c4_prob, 9) as c4_prob, feature_hash
        from hashed
        union all
        select h, h, h + interval 2 hours, 'tenths-001', floor(c1_value), floor(c2_3_prob * 10) / 10,
               floor(c2_4_prob * 10) / 10, floor(c2_5_prob * 10) / 10, floor(c2_6_prob * 10) / 10,
               floor(c3_prob * 10) / 10, cast(null as double), feature_hash
        from hashed""",
    "hashed": """
        select *, sha256(concat_ws('|', strftime(h, '%Y-%m-%d %H:%M:%S'), eco_mean_6h::decimal(18,6)::varchar,
               eco_n_6h::decimal(18,6)::varchar, primary_mean_24h::decimal(18,6)::varchar,
               primary_n_24h::decimal(18,6)::varchar, primary_posts_6h::decimal(18,6)::varchar)) as feature_hash
        from probs""",
    "pairs": """
        select m.item_id, m.valence_level as llm_level, h.valence_level as human_level
        from latest_machine m join latest_human h using (item_id)""",
    "candidates": """
        select item_id, valence_level as llm_level, confidence as llm_confidence, target_type as llm_target_type,
               target_name as llm_target_name
        from latest_machine m
        where not exists (select 1 from annotations a where a.item_id = m.item_id and a.annotator not like 'llm%')
          and not exists (select 1 from gold g where g.item_id = m.item_id)""",
    # Long form of forecasts with their label, all targets but c1.
    "scored": """
        select model_version, t.target, t.prob, t.label from (
          select p.model_version, unnest([
            {'target': 'c2_3', 'prob': coalesce(c2_3_prob, 0.0), 'label': (v_max >= 3)::int},
            {'target': 'c2_4', 'prob': coalesce(c2_4_prob, 0.0), 'label': (v_max >= 4)::int},
            {'target': 'c2_5', 'prob': coalesce(c2_5_prob, 0.0), 'label': (v_max >= 5)::int},
            {'target': 'c2_6', 'prob': coalesce(c2_6_prob, 0.0), 'label': (v_max >= 6)::int},
            {'target': 'c3', 'prob': coalesce(c3_prob, 0.0), 'label': had_jump::int},
            {'target': 'c4', 'prob': coalesce(c4_prob, 0.0), 'label': (n_posts > 0)::int}]) as t
          from outcomes join predictions p using (window_start, window_end))""",
    "eco": """
        select window_start, coalesce(avg(valence_level::double), 0.0) as eco_mean_6h, count(valence_level) as eco_n_6h
        from windows left join (select * from posts where not is_primary) p
          on published_at > window_start - interval 6 hours and published_at <= window_start
        group by window_start""",
    "numbered": """
        select o.*, eco_mean_6h, eco_n_6h, row_number() over (order by window_start, window_end) as rn,
               count(*) over () as n_total, lag(v_max) over (order by window_start, window_end) as prev_v_max
        from outcomes o join eco using (window_start)""",
    "splitted": """
        select *, (select max(window_end) from numbered where rn = greatest(n_total // 2, 1)) as train_until,
               window_end > (select max(window_end) from numbered where rn = greatest(n_total // 2, 1)) as is_test
        from numbered""",
    "rates": """
        select avg((v_max >= 3)::int::double) as rate_3, avg((v_max >= 4)::int::double) as rate_4,
               avg((v_max >= 5)::int::double) as rate_5, avg((v_max >= 6)::int::double) as rate_6,
               avg(had_jump::int::double) as jump_rate, avg((n_posts > 0)::int::double) as posts_rate
        from splitted where not is_test""",
    "base": """
        select window_start, window_end, v_max, n_posts, had_jump, 'B1' as score_set, rate_3 as c2_3_prob,
               rate_4 as c2_4_prob, rate_5 as c2_5_prob, rate_6 as c2_6_prob, jump_rate as c3_prob, posts_rate as c4_prob
        from splitted, rates where is_test
        union all
        select window_start, window_end, v_max, n_posts, had_jump, 'B2', (v_recent >= 3)::int::double,
               (v_recent >= 4)::int::double, (v_recent >= 5)::int::double, (v_recent >= 6)::int::double, null, null
        from splitted where is_test
        union all
        select window_start, window_end, v_max, n_posts, had_jump, 'B3', coalesce((prev_v_max >= 3)::int::double, rate_3),
               coalesce((prev_v_max >= 4)::int::double, rate_4), coalesce((prev_v_max >= 5)::int::double, rate_5),
               coalesce((prev_v_max >= 6)::int::double, rate_6), null, null
        from splitted, rates where is_test
        union all
        select window_start, window_end, v_max, n_posts, had_jump, 'B4', (eco_mean_6h >= 3)::int::double,
               (eco_mean_6h >= 4)::int::double, (eco_mean_6h >= 5)::int::double, (eco_mean_6h >= 6)::int::double, null, null
        from splitted where is_test""",
    "test_long": """
        select score_set, t.target, t.prob, t.label from (
          select score_set, unnest([
            {'target': 'c2_3', 'prob': c2_3_prob, 'label': (v_max >= 3)::int},
            {'target': 'c2_4', 'prob': c2_4_prob, 'label': (v_max >= 4)::int},
            {'target': 'c2_5', 'prob': c2_5_prob, 'label': (v_max >= 5)::int},
            {'target': 'c2_6', 'prob': c2_6_prob, 'label': (v_max >= 6)::int},
            {'target': 'c3', 'prob': c3_prob, 'label': had_jump::int},
            {'target': 'c4', 'prob': c4_prob, 'label': (n_posts > 0)::int}]) as t
          from base) where t.prob is not null
        union all
        select p.model_version, t.target, t.prob, t.label from (
          select p.model_version, unnest([
            {'target': 'c2_3', 'prob': coalesce(c2_3_prob, 0.0), 'label': (v_max >= 3)::int},
            {'target': 'c2_4', 'prob': coalesce(c2_4_prob, 0.0), 'label': (v_max >= 4)::int},
            {'target': 'c2_5', 'prob': coalesce(c2_5_prob, 0.0), 'label': (v_max >= 5)::int},
            {'target': 'c2_6', 'prob': coalesce(c2_6_prob, 0.0), 'label': (v_max >= 6)::int},
            {'target': 'c3', 'prob': coalesce(c3_prob, 0.0), 'label': had_jump::int},
            {'target': 'c4', 'prob': coalesce(c4_prob, 0.0), 'label': (n_posts > 0)::int},
            {'target': 'c1', 'prob': coalesce(c1_value, 0.0), 'label': greatest(v_max, 0)}]) as t
          from splitted s join predictions p using (window_start, window_end) where s.is_test) p""",
    "test_scores": """
        select score_set, target, prob, count(*) as n, sum(label) as pos from test_long
        where target <> 'c1' group by 1, 2, 3""",
    "test_ap": """
        select score_set, target, sum(pos::double / nullif(total_pos, 0) * cum_pos / cum_n) as ap from (
          select *, sum(pos) over (partition by score_set, target) as total_pos,
            sum(pos) over (partition by score_set, target order by prob desc) as cum_pos,
            sum(n) over (partition by score_set, target order by prob desc) as cum_n
          from test_scores) group by 1, 2""",
    "test_ece": """
        select score_set, target, sum(n * abs(acc - conf)) / sum(n) as ece from (
          select score_set, target, bin, count(*) as n, avg(label::double) as acc, avg(prob) as conf from (
            select score_set, target, prob, label, (prob >= 0.1e0)::int + (prob >= 0.2e0)::int + (prob >= 0.1e0 * 3)::int
              + (prob >= 0.4e0)::int + (prob >= 0.5e0)::int + (prob >= 0.1e0 * 6)::int + (prob >= 0.1e0 * 7)::int
              + (prob >= 0.8e0)::int + (prob >= 0.9e0)::int as bin
            from test_long where target <> 'c1') group by 1, 2, 3) group by 1, 2""",
    "test_metrics": """
        select g.score_set, coalesce(t.n_test, 0) as n_test, g.target, coalesce(m.n, 0) as n,
          case when m.mixed then a.ap end as auc_pr, case when m.mixed then e.ece end as ece, m.mae,
          coalesce(m.base_rate, case when g.target <> 'c1' then 0.0 end) as base_rate
        from (select s.score_set, t.target from
                (select unnest(['B1', 'B2', 'B3', 'B4']) as score_set, false as is_model
                 union all select distinct model_version, true from predictions) s
              join (select unnest(['c2_3', 'c2_4', 'c2_5', 'c2_6', 'c3', 'c4', 'c1']) as target) t
                on s.is_model or t.target <> 'c1') g
        left join (select score_set, target, count(*) as n, avg(label::double) as base_rate,
                     case when target = 'c1' then avg(abs(prob - label)) end as mae,
                     target <> 'c1' and sum(label) > 0 and sum(label) < count(*) as mixed
                   from test_long group by 1, 2) m using (score_set, target)
        left join (select score_set, count(*) as n_test from test_long where target = 'c2_3' group by 1) t using (score_set)
        left join test_ap a using (score_set, target) left join test_ece e using (score_set, target)""",
}

ALL = {**SHARED, **DUCKDB}


def _needs(text: str, seen: dict[str, None], defs: dict[str, str], own: str = "") -> None:
    for name in defs:
        if name not in seen and name != own and re.search(rf"\b{name}\b", text):
            _needs(defs[name], seen, defs, name)
            seen[name] = None


def sql(body: str, defs: dict[str, str] | None = None, **extra: str) -> str:
    """``body`` with the views it mentions in front, in order of dependence."""
    defs = {**(ALL if defs is None else defs), **extra}
    seen: dict[str, None] = {}
    _needs(body, seen, defs)
    if not seen:
        return body
    return "with " + ",\n".join(f"{name} as ({defs[name]})" for name in seen) + "\n" + body


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return pin_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data model, derived from the events."""
    pin_utc(spark)
    events = f"select * from parquet.`{sf_dir}/events.parquet`"
    return spark.sql(sql(f"select * from {name}", SHARED, events=events))
