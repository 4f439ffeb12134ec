"""Queries over labels, windows, features and outcomes."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from html.entities import name2codepoint

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinkcast.catalog.bridge import given, sql, table
from brinkcast.functions import keys, scores, text, times, vectors
from brinkcast.operators import annotations as A
from brinkcast.operators import predictions as P
from brinkcast.operators import windows as WN
from brinkcast.operators.ordered import stored

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    query: Query
    sql: str | None = None


CASES: dict[str, Case] = {}


def case(name: str, body: str | None = None, **extra: str):
    """Register a query with the SQL it must equal."""

    def add(fn: Query) -> Query:
        CASES[name] = Case(fn, None if body is None else sql(body, **extra))
        return fn

    return add


def r9(df: DataFrame, *columns: str) -> DataFrame:
    """Round to nine digits: sums of doubles differ in the last bits by order."""
    return df.withColumns({c: F.round(c, 9) + F.lit(0.0) for c in columns})


def r9sql(*columns: str) -> str:
    return ", ".join(f"round({c}, 9) + 0e0 as {c}" for c in columns)


def posts_of(spark: SparkSession, d: str, primary_only: bool = False) -> DataFrame:
    t = lambda n: table(spark, d, n)
    return A.items_with_latest(t("raw_items"), t("items"), t("sources"), t("annotations"), primary_only)


def span_of(spark: SparkSession, d: str) -> tuple[str, str]:
    """First and last grid point: whole days around all posts."""
    days = F.date_trunc("day", F.min("ts")), F.date_trunc("day", F.max("ts")) + F.make_dt_interval(F.lit(1))
    row = given(spark, d, "events").agg(*[F.date_format(x, "yyyy-MM-dd HH:mm:ss") for x in days]).first()
    return row[0], row[1]


def period_of(spark: SparkSession, d: str) -> tuple[str, datetime]:
    """A period that holds every window."""
    first, last = span_of(spark, d)
    return first, datetime.fromisoformat(last) + timedelta(hours=2)


def spine_of(spark: SparkSession, d: str) -> DataFrame:
    return times.grid_spine(spark, *span_of(spark, d))


def windows_of(spark: SparkSession, d: str) -> DataFrame:
    return times.window_spine(spark, *span_of(spark, d))


def panes_of(spark: SparkSession, d: str) -> DataFrame:
    """The pane table, stored once: forecasts and outcomes are both read off it."""
    return stored(WN.valence_panes(posts_of(spark, d)))


def predictions_from(panes: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """Forecasts of the simple predictor, at nine decimals, and of one that only
    gives tenths."""
    rows = P.prediction_rows(WN.features_from_panes(panes, spine_of(spark, d)))
    tenth = lambda c: (F.floor(F.col(c) * 10) / 10).alias(c)
    cols = [
        F.lit("tenths-001").alias("model_version"),
        F.floor("c1_value").cast("double").alias("c1_value"),
        *[tenth(c) for c in scores.PROB_COLUMNS if c != "c4_prob"],
        F.lit(None).cast("double").alias("c4_prob"),
    ]
    keep = ["made_at", "window_start", "window_end", "feature_hash"]
    nines = [F.round(c, 9).alias(c) for c in ("c1_value", *scores.PROB_COLUMNS)]
    rows = stored(rows.select(*keep, "model_version", "c1_value", *scores.PROB_COLUMNS))
    return rows.select(*keep, "model_version", *nines).unionByName(rows.select(*keep, *cols))


# -- labels ------------------------------------------------------------------

LATEST = ["item_id", "annotator", "labeler_version", "valence_level", "confidence", "annotated_at"]


@case("a01_latest_annotation", f"select {', '.join(LATEST)} from latest")
def _(spark, d):
    return A.latest_annotation(table(spark, d, "annotations")).select(*LATEST)


@case("a01_latest_machine_annotation", f"select {', '.join(LATEST)} from latest_machine")
def _(spark, d):
    return A.latest_annotation(table(spark, d, "annotations"), "machine").select(*LATEST)


@case("a01_latest_human_annotation", f"select {', '.join(LATEST)} from latest_human")
def _(spark, d):
    return A.latest_annotation(table(spark, d, "annotations"), "human").select(*LATEST)


@case(
    "j01_enriched_items",
    """select item_id, source_id, published_at, is_primary, annotator, l.valence_level
       from posts join latest l using (item_id)""",
)
def _(spark, d):
    t = lambda n: table(spark, d, n)
    return A.enriched_items(t("annotations"), t("items"), t("raw_items"), t("sources"))


@case("j02_items_with_latest", "select raw_item_id, item_id, source_id, published_at, is_primary, valence_level from posts")
def _(spark, d):
    return posts_of(spark, d)


@case("j04_paired_annotations", "select item_id, llm_level, human_level from pairs")
def _(spark, d):
    return A.paired_annotations(table(spark, d, "annotations"))


@case(
    "j06_sampling_candidates",
    """select item_id, llm_level, llm_confidence, llm_target_type, llm_target_name, clean_text
       from candidates join items using (item_id)""",
)
def _(spark, d):
    t = lambda n: table(spark, d, n)
    return A.sampling_candidates(t("annotations"), t("gold"), t("items"))


@case(
    "v01_primary_posts",
    """select item_id, raw_item_id, clean_text, source_id, published_at, author
       from items join raw_items using (raw_item_id) join flagged using (source_id) where is_primary""",
)
def _(spark, d):
    t = lambda n: table(spark, d, n)
    return A.primary_posts(t("items"), t("raw_items"), t("sources"))


@case("p05_is_primary", "select source_id, name, is_primary from flagged")
def _(spark, d):
    return A.with_primary(table(spark, d, "sources")).select("source_id", "name", "is_primary")


_RAW_LABELS = """select item_id, floor(value / 25)::int as level, value / 100 as confidence, target_type from (
    select event_id as item_id, value, case event_type when 'view' then 'none' when 'click' then 'person'
      when 'purchase' then 'institution' when 'signup' then 'media' else 'crowd' end as target_type from events)"""


def _raw_labels(spark, d):
    kind = F.create_map(*[F.lit(x) for x in ("view", "none", "click", "person", "purchase", "institution", "signup", "media")])
    return given(spark, d, "events").select(
        F.col("event_id").alias("item_id"),
        F.floor(F.col("value") / 25).cast("int").alias("level"),
        (F.col("value") / 100).alias("confidence"),
        F.coalesce(F.try_element_at(kind, F.col("event_type")), F.lit("crowd")).alias("target_type"),
    )


_VALID = """level between 0 and 6 and confidence between 0 and 1
    and target_type in ('person', 'institution', 'group', 'media', 'self_referential', 'none')"""


@case("p13_valid_annotations", f"select * from raw_labels where {_VALID}", raw_labels=_RAW_LABELS)
def _(spark, d):
    return A.valid_annotations(_raw_labels(spark, d))[0]


@case("p13_rejected_annotations", f"select * from raw_labels where not ({_VALID})", raw_labels=_RAW_LABELS)
def _(spark, d):
    return A.valid_annotations(_raw_labels(spark, d))[1]


@case(
    "w07_pending_annotation",
    """select item_id, clean_text from items i where not exists (
         select 1 from annotations a where a.item_id = i.item_id and a.labeler_version = 'v1.2')""",
)
def _(spark, d):
    t = lambda n: table(spark, d, n)
    return A.pending_annotation(t("items"), t("annotations"), "v1.2")


# -- windows and features ----------------------------------------------------

_MEANS = ("eco_mean_6h", "primary_mean_24h")


@case("a02_ecosystem_stats", f"select h, {r9sql('eco_mean_6h')}, eco_n_6h from features")
def _(spark, d):
    return r9(WN.ecosystem_stats(posts_of(spark, d), spine_of(spark, d)), "eco_mean_6h")


@case("a03_primary_stats", f"select h, {r9sql('primary_mean_24h')}, primary_n_24h from features")
def _(spark, d):
    return r9(WN.primary_stats(posts_of(spark, d, True), spine_of(spark, d)), "primary_mean_24h")


@case("a04_primary_post_count", "select h, primary_posts_6h from features")
def _(spark, d):
    return WN.primary_post_count(posts_of(spark, d, True), spine_of(spark, d))


@case("a05_window_outcomes", f"select window_start, window_end, v_max, n_posts, {r9sql('v_recent')}, had_jump from outcomes")
def _(spark, d):
    return r9(WN.window_outcomes(posts_of(spark, d, True), windows_of(spark, d)), "v_recent")


@case("a06_features_at", f"select h, {r9sql(*_MEANS)}, eco_n_6h, primary_n_24h, primary_posts_6h from features")
def _(spark, d):
    return r9(WN.features_at(posts_of(spark, d), spine_of(spark, d)), *_MEANS)


@case(
    "a07_rolling_mean",
    """select cutoff, round(coalesce(avg(valence_level::double), 0.0), 9) as rolling_mean, count(valence_level) as n
       from (select distinct published_at as cutoff from raw_items) c
       left join posts p on p.published_at > cutoff - interval 3 hours and p.published_at <= cutoff
       group by cutoff""",
)
def _(spark, d):
    posts = posts_of(spark, d)
    cutoffs = table(spark, d, "raw_items").select(F.col("published_at").alias("cutoff"))
    return r9(WN.rolling_mean(posts, cutoffs, 3), "rolling_mean")


@case(
    "a07_rolling_mean_values",
    """select cutoff, round(coalesce(avg(value), 0.0), 5) as rolling_mean, count(value) as n
       from (select distinct ts as cutoff from events) c
       left join (select ts, case when event_type = 'error' then value * 1e3 else value * pi() end as value from events) e
         on e.ts > cutoff - interval 5 hours and e.ts <= cutoff
       group by cutoff""",
)
def _(spark, d):
    events = given(spark, d, "events")
    level = F.when(F.col("event_type") == "error", F.col("value") * 1e3).otherwise(F.col("value") * math.pi)
    out = WN.rolling_mean(events.select("ts", level.alias("value")), events.select(F.col("ts").alias("cutoff")), 5, ts="ts", value="value")
    return out.withColumn("rolling_mean", F.round("rolling_mean", 5))


@case(
    "j03_ecosystem_at",
    f"select window_start, window_end, {r9sql('eco_mean_6h')}, eco_n_6h from windows join eco using (window_start)",
)
def _(spark, d):
    return r9(WN.ecosystem_at(windows_of(spark, d), posts_of(spark, d)), "eco_mean_6h")


@case(
    "a08_tumbling_labels",
    """select w.ws as window_start, w.ws + interval 2 hours as window_end,
         coalesce(max(valence_level) filter (published_at >= w.ws), -1)::int as v_max,
         round(coalesce(avg(valence_level::double) filter (published_at < w.ws), 0.0), 9) as v_recent,
         count(valence_level) filter (published_at >= w.ws) as n_posts
       from (select unnest(generate_series(min(h) + interval 450 seconds, max(h) - interval 2 hours,
               interval 2 hours)) as ws from spine) w
       left join (select * from posts where is_primary and valence_level is not null) p
         on published_at >= w.ws - interval 24 hours and published_at < w.ws + interval 2 hours
       group by w.ws""",
)
def _(spark, d):
    posts = posts_of(spark, d, True).where("valence_level is not null").withColumnRenamed("valence_level", "valence")
    first, last = span_of(spark, d)
    return r9(WN.tumbling_labels(posts, datetime.fromisoformat(first) + timedelta(seconds=450), last), "v_recent")


# -- scalar functions --------------------------------------------------------


@case(
    "p06_floor_to_grid",
    """select event_id, time_bucket(interval 15 minutes, ts) as grid, time_bucket(interval 60 minutes, ts) as hour_grid
       from events""",
)
def _(spark, d):
    ts = F.col("ts")
    return given(spark, d, "events").select(
        "event_id", times.floor_to_grid(ts).alias("grid"), times.floor_to_grid(ts, 60).alias("hour_grid")
    )


@case(
    "p07_prediction_window",
    """select event_id, time_bucket(interval 15 minutes, ts) as window_start,
         time_bucket(interval 15 minutes, ts) + interval 2 hours as window_end from events""",
)
def _(spark, d):
    start, end = times.prediction_window(F.col("ts"))
    return given(spark, d, "events").select("event_id", start.alias("window_start"), end.alias("window_end"))


@case("p08_sigmoid", "select event_id, round(1 / (1 + exp(-(value - 50) / 20)), 9) as s from events")
def _(spark, d):
    x = (F.col("value") - 50) / 20
    return given(spark, d, "events").select("event_id", F.round(scores.sigmoid(x), 9).alias("s"))


_PROBS = ("c1_value", *scores.PROB_COLUMNS)


@case("p09_features_to_probs", f"select h, {r9sql(*_PROBS)} from probs")
def _(spark, d):
    feats = WN.features_at(posts_of(spark, d), spine_of(spark, d))
    return r9(scores.features_to_probs(feats).select("h", *_PROBS), *_PROBS)


@case("p10_feature_hash", "select h, feature_hash from hashed")
def _(spark, d):
    feats = WN.features_at(posts_of(spark, d), spine_of(spark, d))
    return feats.select("h", keys.feature_hash(F.col("h")).alias("feature_hash"))


@case(
    "p11_prediction_payload",
    f"select h as window_start, {r9sql('eco_mean_6h', 'primary_mean_24h', *_PROBS)}, eco_n_6h, primary_posts_6h from probs",
)
def _(spark, d):
    """The payload, read back."""
    rows = P.prediction_rows(WN.features_at(posts_of(spark, d), spine_of(spark, d)))
    probs = ", ".join(f"{c} double" for c in _PROBS)
    shape = (
        "features struct<eco_mean_6h double, primary_mean_24h double, eco_n_6h long, primary_posts_6h long>, "
        f"probs struct<{probs}>"
    )
    back = rows.select("window_start", F.from_json("payload", shape).alias("p"))
    return r9(back.select("window_start", "p.features.*", "p.probs.*"), "eco_mean_6h", "primary_mean_24h", *_PROBS)


@case(
    "p12_window_targets",
    """select window_start, (v_max >= 3)::int as c2_3, (v_max >= 4)::int as c2_4, (v_max >= 5)::int as c2_5,
         (v_max >= 6)::int as c2_6, had_jump::int as c3, (n_posts > 0)::int as c4, greatest(v_max, 0)::int as c1
       from outcomes""",
)
def _(spark, d):
    out = WN.window_outcomes(posts_of(spark, d, True), windows_of(spark, d))
    return out.select("window_start", *[c.alias(n) for n, c in scores.window_targets().items()])


@case("p14_label_cache_key", "select doc_id, sha256('v1.2' || 'ladder' || text) as label_key from documents")
def _(spark, d):
    return given(spark, d, "documents").select(
        "doc_id", keys.label_cache_key(F.col("text"), "ladder", "v1.2").alias("label_key")
    )


@case(
    "p15_outcome_context",
    """select event_id, coalesce(try_cast(json_extract_string(props, '$.v_recent') as double), 0.0) as no_context,
         coalesce(try_cast(json_extract_string('{"v_recent":' || value || '}', '$.v_recent') as double), 0.0) as v_recent
       from events""",
)
def _(spark, d):
    stored = keys.observed_json(F.col("value"))
    return given(spark, d, "events").select(
        "event_id",
        keys.outcome_context(F.col("props")).alias("no_context"),
        keys.outcome_context(stored).alias("v_recent"),
    )


@case(
    "p16_step_baselines",
    """select window_start, (v_recent >= 3)::int::double as b2_3, (v_recent >= 4)::int::double as b2_4,
         coalesce((prev_v_max >= 3)::int::double, 0.0) as b3_3, (eco_mean_6h >= 2)::int::double as b4_2,
         (eco_mean_6h >= 3)::int::double as b4_3
       from numbered""",
)
def _(spark, d):
    from brinkcast.operators.baselines import previous_v_max

    panes = panes_of(spark, d)
    rows = WN.ecosystem_from_panes(WN.outcomes_from_panes(panes, windows_of(spark, d)), panes)
    rows = previous_v_max(stored(rows))
    step = scores.step_baseline
    return rows.select(
        "window_start",
        step(F.col("v_recent"), 3).alias("b2_3"),
        step(F.col("v_recent"), 4).alias("b2_4"),
        step(F.col("prev_v_max"), 3).alias("b3_3"),
        step(F.col("eco_mean_6h"), 2).alias("b4_2"),
        step(F.col("eco_mean_6h"), 3).alias("b4_3"),
    )


@case(
    "p19_month_bounds",
    """select o_orderkey, date_trunc('month', o_orderdate)::date as first_day, last_day(o_orderdate) as last_day from orders""",
)
def _(spark, d):
    first, last = times.month_bounds(F.col("o_orderdate").cast("date"))
    return given(spark, d, "orders").select("o_orderkey", first.alias("first_day"), last.alias("last_day"))


# -- text --------------------------------------------------------------------

_WS = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_STRIP = (
    r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), "
    r"'(?is)<script[^>]*>.*?</script\s*>', '', 'g'), '(?is)<style[^>]*>.*?</style\s*>', '', 'g'), '<[^>]*>', chr(10), 'g')"
)
# Every name of a Latin-1 character with or without semicolon, one replacement each,
# longer names first, the ampersand last.
for _e, _c in sorted(name2codepoint.items(), key=lambda x: (x[0] == "amp", -len(x[0]))):
    if _c < 256:
        _STRIP = f"regexp_replace({_STRIP}, '&{_e};?', chr({_c}), 'g')"


@case("p01_strip_html", f"select page_id, {_STRIP} as body from pages")
def _(spark, d):
    return given(spark, d, "pages").select("page_id", text.strip_html(F.col("html")).alias("body"))


@case(
    "p02_normalize_html",
    f"select page_id, trim(regexp_replace(body, '{_WS}+', ' ', 'g')) as clean_text from stripped",
    stripped=f"select page_id, {_STRIP} as body from pages",
)
def _(spark, d):
    return given(spark, d, "pages").select("page_id", text.normalize_text(F.col("html"), True).alias("clean_text"))


@case(
    "p02_normalize_text",
    f"select doc_id, trim(regexp_replace(text, '{_WS}+', ' ', 'g')) as clean_text from documents",
)
def _(spark, d):
    return given(spark, d, "documents").select("doc_id", text.normalize_text(F.col("text")).alias("clean_text"))


@case(
    "p03_token_count",
    """select doc_id, (case when clean_text = '' then 0 else len(string_split(clean_text, ' ')) end)::int as tokens
       from cleaned""",
    cleaned=f"select doc_id, trim(regexp_replace(text, '{_WS}+', ' ', 'g')) as clean_text from documents",
)
def _(spark, d):
    clean = text.normalize_text(F.col("text"))
    return given(spark, d, "documents").select("doc_id", text.token_count(clean).alias("tokens"))


@case("p04_excerpt", "select doc_id, substring(text, 1, 4000) as excerpt from documents where text <> ''")
def _(spark, d):
    return given(spark, d, "documents").where("text <> ''").select("doc_id", text.excerpt(F.col("text")).alias("excerpt"))


@case(
    "p20_preview_text",
    """select doc_id, case when length(text) > 140 then substring(replace(text, chr(10), ' '), 1, 137) || '...'
         else replace(text, chr(10), ' ') end as preview from documents""",
)
def _(spark, d):
    return given(spark, d, "documents").select("doc_id", text.preview_text(F.col("text")).alias("preview"))


_PARAS = f"""select doc_id, row_number() over (partition by doc_id order by i) as i, p from (
    select doc_id, i, regexp_replace(parts[i], '^{_WS}+|{_WS}+$', '', 'g') as p from (
      select doc_id, string_split(text, chr(10)) as parts, unnest(range(1, len(string_split(text, chr(10))) + 1)) as i
      from documents)) where p <> ''"""


@case(
    "p17_segment_documents",
    """select doc_id, (chunk - 1)::int as chunk_no, string_agg(p, chr(10) || chr(10) order by i) as chunk
       from (select doc_id, i, p, sum(fresh) over (partition by doc_id order by i) as chunk from packed) group by doc_id, chunk""",
    paras=_PARAS,
    packed="""select * from (with recursive walk as (
        select doc_id, i, p, 1 as fresh, length(p) + 2 as size from paras where i = 1
        union all
        select n.doc_id, n.i, n.p, case when w.size + length(n.p) > 1200 then 1 else 0 end,
          case when w.size + length(n.p) > 1200 then length(n.p) else w.size + length(n.p) + 2 end
        from walk w join paras n on n.doc_id = w.doc_id and n.i = w.i + 1)
      select doc_id, i, p, fresh from walk)""",
)
def _(spark, d):
    return text.segment_documents(given(spark, d, "documents"), "doc_id", "text", "\n", 1200)


PHRASES = {6: ["that the", "einer"], 5: ["shend", "leaux"], 4: ["ations", "schen"], 3: ["with", "avec"], 2: ["are", "und"], 1: ["the", "que"]}
_LADDER = "case " + " ".join(
    "when " + " or ".join(f"contains(lower(text), '{p}')" for p in ps) + f" then {k}" for k, ps in PHRASES.items()
) + " else 0 end"


@case("u01_ladder_level", f"select doc_id, ({_LADDER})::int as level from documents")
def _(spark, d):
    return given(spark, d, "documents").select("doc_id", text.ladder_level(F.col("text"), PHRASES).alias("level"))


@case(
    "u02_l2_normalize",
    """select vec_id, i - 1 as pos, round(embedding[i]::double / norm, 7) + 0e0 as x from (
         select vec_id, embedding, norm, unnest(range(1, len(embedding) + 1)) as i from (
           select vec_id, embedding, sqrt(list_sum(list_transform(embedding, lambda x: x::double * x::double))) as norm
           from embeddings))""",
)
def _(spark, d):
    unit = vectors.l2_normalize(F.col("embedding"))
    rows = given(spark, d, "embeddings").select("vec_id", F.posexplode(unit).alias("pos", "x"))
    return rows.select("vec_id", F.col("pos").cast("long").alias("pos"), (F.round("x", 7) + F.lit(0.0)).alias("x"))
