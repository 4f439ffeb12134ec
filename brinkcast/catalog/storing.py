"""Queries over writes, forecasts as rows, sampling, labelling and landed files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brinkcast.catalog.bridge import given, table
from brinkcast.catalog.core import (
    PHRASES,
    _LADDER,
    case,
    panes_of,
    predictions_from,
    r9,
    r9sql,
    windows_of,
)
from brinkcast.catalog.scoring import report_of
from brinkcast.functions.text import ladder_level
from brinkcast.functions.times import time_literal
from brinkcast.operators import annotations as A
from brinkcast.operators import labeling as L
from brinkcast.operators import predictions as P
from brinkcast.operators import sampling as S
from brinkcast.operators import windows as WN
from brinkcast.operators import writes as W
from brinkcast.session import ensure_checkpoint_dir
from brinkcast.sources import feeds, files
from brinkcast.sources.keyindex import KeyIndex
from brinkcast.sources.months import backfill_months
from brinkcast.sources.tables import RAW_KEY, TableStore


def scratch(spark, name: str) -> str:
    """A fresh folder beside the checkpoints."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# -- writes ------------------------------------------------------------------


@case(
    "w01_get_or_create_sources",
    """select source_id, name, case when source_id in (select source_id from raw_items where published_at < timestamp '2024-01-01 06:00:00')
         then metadata else '{"primary":"maybe"}' end as metadata from sources""",
)
def _(spark, d):
    """Feeds seen in the first six hours are known; then all of them come, with
    changed metadata."""
    src = table(spark, d, "sources")
    seen = table(spark, d, "raw_items").where(F.col("published_at") < time_literal("2024-01-01 06:00:00"))
    known = src.join(seen.select("source_id").distinct(), "source_id", "left_semi")
    batch = src.withColumn("metadata", F.lit('{"primary":"maybe"}'))
    return W.get_or_create_sources(known, batch)


_NEW_RAW = """select * exclude (rn) from (select *, row_number() over (partition by source_id, external_id
      order by captured_at, raw_item_id) as rn from raw_incoming) i
    where rn = 1 and not exists (select 1 from raw_existing e where e.source_id = i.source_id and e.external_id = i.external_id)"""


def new_raw_of(spark, d):
    return W.new_raw_items(
        table(spark, d, "raw_existing"), table(spark, d, "raw_incoming"), ["captured_at", "raw_item_id"]
    )


@case("w02_new_raw_items", _NEW_RAW)
def _(spark, d):
    return new_raw_of(spark, d)


@case(
    "w02_key_index",
    """select raw_item_id::varchar as raw_item_id, source_id::varchar as source_id, external_id, captured_at from new_raw""",
    new_raw=_NEW_RAW,
)
def _(spark, d):
    """The same through a store: both loads come as batches, the second one twice."""
    store = TableStore(spark, scratch(spark, "keys"))
    index = KeyIndex(store, "raw_items", RAW_KEY)
    before = table(spark, d, "raw_existing")
    for batch in (before, table(spark, d, "raw_incoming"), table(spark, d, "raw_incoming")):
        index.append_new(batch, ["captured_at", "raw_item_id"])
    known = before.select(F.col("raw_item_id").cast("string").alias("raw_item_id"))
    return store.read("raw_items").join(known, "raw_item_id", "left_anti").select(
        "raw_item_id", "source_id", "external_id", F.col("captured_at").cast("timestamp_ntz").alias("captured_at")
    )


@case(
    "w03_upsert_items",
    """select item_id, raw_item_id, clean_text from items join new_raw using (raw_item_id)""",
    new_raw=_NEW_RAW,
)
def _(spark, d):
    items = table(spark, d, "items")
    before = items.join(table(spark, d, "raw_existing").select("raw_item_id"), "raw_item_id", "left_semi")
    return W.upsert_items(before, items).select("item_id", "raw_item_id", "clean_text")


@case(
    "w04_append_annotations",
    f"""select item_id, annotator, labeler_version, valence_level, confidence, annotated_at from annotations
        union all
        select doc_id, 'llm', 'ladder-1', ({_LADDER})::int, 1.0, timestamp '2024-02-01' from documents""",
)
def _(spark, d):
    cols = ["item_id", "annotator", "labeler_version", "valence_level", "confidence", "annotated_at"]
    labels = given(spark, d, "documents").select(
        F.col("doc_id").alias("item_id"), ladder_level(F.col("text"), PHRASES).alias("level"), F.lit(1.0).alias("confidence")
    )
    ann = table(spark, d, "annotations").select(*cols)
    return W.append_annotations(ann, labels, "llm", "ladder-1", time_literal("2024-02-01")).select(*cols)


_KEY = ["window_start", "window_end", "model_version"]


@case(
    "w05_new_predictions",
    """select window_start, window_end, model_version from predictions
       where window_start >= timestamp '2024-01-15' or model_version = 'tenths-001'""",
)
def _(spark, d):
    preds = predictions_from(panes_of(spark, d), spark, d)
    early = F.col("window_start") < time_literal("2024-01-15")
    stored = preds.where(early & (F.col("model_version") != "tenths-001"))
    return W.new_predictions(stored, preds.unionByName(preds.where(~early))).select(*_KEY)


@case(
    "w06_new_outcomes",
    "select window_start, window_end, v_max, n_posts, had_jump from outcomes where window_start >= timestamp '2024-01-15'",
)
def _(spark, d):
    out = WN.outcomes_from_panes(panes_of(spark, d), windows_of(spark, d)).drop("v_recent")
    stored = out.where(F.col("window_start") < time_literal("2024-01-15"))
    return W.new_outcomes(stored, out.unionByName(out))


@case(
    "w08_ingest_summary",
    """select case when grouping(name) = 0 then name end as name, grouping(name)::int as is_total, sum(r)::bigint as new_raw,
         sum(a)::bigint as annotations, sum(e)::bigint as fetch_error
       from (select name, 0 as r, 0 as a, 0 as e from sources
             union all select name, 1, 0, 0 from new_raw join sources using (source_id)
             union all select name, 0, 1, 0 from new_raw join sources using (source_id)
               join annotations on item_id = raw_item_id
             union all select name, 0, 0, 1 from flagged where is_primary)
       group by rollup (name)""",
    new_raw=_NEW_RAW,
)
def _(spark, d):
    src = A.with_primary(table(spark, d, "sources")).select("source_id", "name", "is_primary")
    raw = new_raw_of(spark, d).select("raw_item_id", "source_id").join(src, "source_id")
    ann = table(spark, d, "annotations").select(F.col("item_id").alias("raw_item_id"))
    return W.ingest_summary(src, raw, raw.join(ann, "raw_item_id"), src.where("is_primary"))


# -- forecasts as rows -------------------------------------------------------


@case(
    "t01_latest_predictions",
    """select made_at, window_start, window_end, model_version, round(coalesce(c2_4_prob, 0.0), 3) as c2_4_prob,
         round(coalesce(c2_5_prob, 0.0), 3) as c2_5_prob, round(coalesce(c4_prob, 0.0), 3) as c4_prob,
         substring(coalesce(feature_hash, ''), 1, 16) as feature_hash
       from predictions order by made_at desc, window_start desc, model_version limit 40""",
)
def _(spark, d):
    return P.latest_predictions(predictions_from(panes_of(spark, d), spark, d))


_DUE = """select distinct window_start, window_end from predictions p
    where window_end < timestamp '2024-01-25 10:00:00' and not exists (
      select 1 from outcomes o where o.window_start = p.window_start and o.window_end = p.window_end
        and o.window_start < timestamp '2024-01-20')"""


def _due(spark, d, limit):
    panes = panes_of(spark, d)
    stored = WN.outcomes_from_panes(panes, windows_of(spark, d)).where(F.col("window_start") < time_literal("2024-01-20"))
    return P.due_windows(predictions_from(panes, spark, d), stored, "2024-01-25 10:00:00", limit)


@case("j05_due_windows", _DUE)
def _(spark, d):
    return _due(spark, d, None)


@case("j05_due_windows_first_50", f"select * from ({_DUE}) order by window_end, window_start limit 50")
def _(spark, d):
    return _due(spark, d, 50)


# -- sampling ----------------------------------------------------------------



def _sample_views(quotas: dict[str, int]) -> dict[str, str]:
    level_quota = "case " + " ".join(f"when llm_level = {k} then {quotas[f'level_{k}']}" for k in range(7)) + " end"
    return {
        "keyed": "select *, md5('7:' || item_id::varchar) as k from candidates",
        "by_level": "select *, row_number() over (partition by llm_level order by k, item_id) as rn from keyed",
        "level_part": f"select *, 'level_' || llm_level as stratum from by_level where llm_level between 0 and 6 and rn <= {level_quota}",
        "rest": "select * from keyed where item_id not in (select item_id from level_part)",
        "low_part": f"""select *, 'low_confidence' as stratum from rest where coalesce(llm_confidence, 0.0) < 0.6e0
            order by k, item_id limit {quotas['low_confidence']}""",
        "boundary_part": f"""select *, 'boundary' as stratum from rest where llm_confidence between 0.6e0 and 0.75e0
            and item_id not in (select item_id from low_part) order by k, item_id limit {quotas['boundary']}""",
        "sampled": """select item_id, llm_level, llm_confidence, stratum from level_part
            union all select item_id, llm_level, llm_confidence, stratum from low_part
            union all select item_id, llm_level, llm_confidence, stratum from boundary_part""",
    }


_SAMPLE = _sample_views(S.QUOTAS)


def candidates_of(spark, d):
    return A.sampling_candidates(table(spark, d, "annotations"), table(spark, d, "gold"))


def sample_of(spark, d):
    return S.stratified_sample(candidates_of(spark, d), seed=7)


@case("m01_stratified_sample", "select item_id, llm_level, llm_confidence, stratum, clean_text from sampled join items using (item_id)", **_SAMPLE)
def _(spark, d):
    cols = ["item_id", "llm_level", "llm_confidence", "stratum"]
    return S.attach_texts(sample_of(spark, d).select(*cols), table(spark, d, "items"))


@case(
    "m01_stratified_sample_of_500",
    "select item_id, llm_level, llm_confidence, stratum from sampled",
    **_sample_views(S.scaled_quotas(500)),
)
def _(spark, d):
    out = S.stratified_sample(candidates_of(spark, d), 500, seed=7)
    return out.select("item_id", "llm_level", "llm_confidence", "stratum")


@case("a25_stratum_counts", "select stratum, count(*) as n from sampled group by 1", **_SAMPLE)
def _(spark, d):
    return S.stratum_counts(sample_of(spark, d))


@case(
    "f01_rank_in_stratum",
    "select item_id, llm_level, rn::int as rank_in_stratum from by_level where rn <= 100",
    **_SAMPLE,
)
def _(spark, d):
    return S.rank_in_stratum(candidates_of(spark, d), ["llm_level"], 7, 100).select(
        "item_id", "llm_level", "rank_in_stratum"
    )


@case(
    "j08_merge_human_labels",
    """select m.item_id, m.valence_level as llm_level, h.valence_level as human_level, coalesce(h.annotator, '') as human_notes
       from latest_machine m left join latest_human h using (item_id)""",
)
def _(spark, d):
    ann = table(spark, d, "annotations")
    sample = A.latest_annotation(ann, "machine").select(
        "item_id", F.col("valence_level").alias("llm_level"), F.lit(None).cast("int").alias("human_level")
    )
    labels = A.latest_annotation(ann, "human").select(
        "item_id", F.col("valence_level").alias("human_level"), F.col("annotator").alias("human_notes")
    )
    return A.merge_human_labels(sample, labels)


# -- labelling ---------------------------------------------------------------

_KEYED = f"""select doc_id, lang, text, sha256('v1ladder' || text) as label_key, ({_LADDER})::int as level
    from documents where text <> ''"""


def _docs(spark, d):
    return given(spark, d, "documents").select("doc_id", "lang", F.col("text").alias("clean_text"))


def _cache(spark, d):
    """Labels of the English documents, kept from an earlier run."""
    docs = given(spark, d, "documents").where("lang = 'en' and text <> ''")
    from brinkcast.functions.keys import label_cache_key

    return docs.select(
        label_cache_key(F.col("text"), "ladder", "v1").alias("label_key"),
        F.lit(5).alias("level"),
        F.lit("none").alias("target_type"),
        F.lit(None).cast("string").alias("target_name"),
        F.lit("kept").alias("rationale"),
        F.lit(0.5).alias("confidence"),
    )  # copies of a text give their key more than once


@case(
    "j09_join_label_cache",
    """select doc_id, 5 as level from keyed_docs where label_key in (select label_key from keyed_docs where lang = 'en')""",
    keyed_docs=_KEYED,
)
def _(spark, d):
    rows = _docs(spark, d).where("clean_text <> ''")
    hits, _misses = W.join_label_cache(rows, _cache(spark, d), "ladder", "v1")
    return hits.select("doc_id", "level")


@case(
    "j09_label_cache_misses",
    """select distinct label_key from keyed_docs where label_key not in (select label_key from keyed_docs where lang = 'en')""",
    keyed_docs=_KEYED,
)
def _(spark, d):
    rows = _docs(spark, d).where("clean_text <> ''")
    return W.join_label_cache(rows, _cache(spark, d), "ladder", "v1")[1].select("label_key")


def length_labeler(text: str) -> dict:
    """Stand-in for a labeler: the level follows the length; very short texts fail,
    very long ones get a level off the scale."""
    if len(text) < 40:
        raise ValueError("too short")
    return {
        "level": len(text) // 500,
        "target_type": "none",
        "target_name": None,
        "rationale": "length",
        "confidence": 0.9,
    }


@case(
    "u01_label_batch",
    """select doc_id, case when c then 5 when length(s) < 40 then null else (length(s) // 500)::int end as level,
         case when c then 'ok' when length(s) < 40 then 'failed' when length(s) // 500 > 6 then 'invalid' else 'ok' end as status
       from (select doc_id, text as s,
               label_key in (select label_key from keyed_docs where lang = 'en') as c from keyed_docs)""",
    keyed_docs=_KEYED,
)
def _(spark, d):
    labelled, _new = L.label_batch(_docs(spark, d), length_labeler, _cache(spark, d), "ladder", "v1")
    return labelled.select("doc_id", "level", "status")


def letter_encoder(texts: list[str]) -> list[list[float]]:
    """Stand-in for an encoder: counts of a few letters."""
    return [[float(t.count(c)) for c in "aeiou"] for t in texts]


@case(
    "u02_embed_batch",
    "select doc_id, pos, (case when norm > 0 then x / norm else 0 end)::float::double as x from (select doc_id, unnest(range(0, 5)) as pos, unnest(v) as x, norm from vecs)",
    counted="select doc_id, " + ", ".join(f"(length(text) - length(replace(text, '{c}', '')))::double as {c}" for c in "aeiou") + " from documents",
    vecs="select doc_id, [a, e, i, o, u] as v, sqrt(a*a + e*e + i*i + o*o + u*u) as norm from counted",
)
def _(spark, d):
    out = L.embed_batch(_docs(spark, d), letter_encoder).select("doc_id", F.posexplode("embedding").alias("pos", "x"))
    return out.select("doc_id", F.col("pos").cast("long").alias("pos"), F.col("x").cast("double").alias("x"))


@case("p18_ablate_features", "select h, primary_posts_6h from features")
def _(spark, d):
    feats = WN.features_from_panes(panes_of(spark, d), windows_of(spark, d).select(F.col("window_start").alias("h")))
    families = {
        "temporal": ["eco_mean_6h", "primary_mean_24h"],
        "lexical": ["eco_n_6h", "primary_n_24h"],
        "topics": ["primary_posts_6h"],
    }
    return L.ablate_features(feats, temporal=False, lexical=False, families=families)


# -- landed files ------------------------------------------------------------


@case(
    "s02_with_published_at",
    "select event_id, case when event_type = 'view' then timestamp '2024-03-01' else date_trunc('second', ts) end as published_at from events",
)
def _(spark, d):
    kinds = F.col("event_type")
    rfc = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss")
    raw = (
        F.when(kinds == "view", F.lit("not a date"))
        .when(kinds == "click", F.concat(rfc, F.lit(" GMT")))
        .when(kinds == "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(kinds == "signup", F.concat(F.date_format(F.col("ts") + F.expr("interval 5 hours"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0500")))
        .otherwise(rfc)
    )
    rows = given(spark, d, "events").select("event_id", raw.alias("published_raw"))
    out = feeds.with_published_at(rows, time_literal("2024-03-01"))
    return out.select("event_id", F.col("published_at").cast("timestamp_ntz").alias("published_at"))


@case(
    "s03_with_external_id",
    """select event_id, case when event_type = 'view' then props when event_type = 'click' then user_id::varchar
         else strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' end as external_id from events""",
)
def _(spark, d):
    kind = F.col("event_type")
    rows = given(spark, d, "events").select(
        "event_id",
        F.when(kind == "view", F.col("props")).when(kind == "click", F.lit("")).alias("entry_id"),
        F.when(kind == "click", F.col("user_id").cast("string")).otherwise("").alias("link"),
        F.col("ts").cast("timestamp").alias("published_at"),
    )
    return feeds.with_external_id(rows).select("event_id", "external_id")


@case(
    "s04_with_raw_content",
    """select event_id, case when event_type in ('view', 'error') then props when event_type = 'click' then event_type else '' end
         as raw_content from events""",
)
def _(spark, d):
    kind = F.col("event_type")
    rows = given(spark, d, "events").select(
        "event_id",
        F.when(kind.isin("view", "error"), F.col("props")).when(kind == "click", F.lit("")).alias("content"),
        F.when(kind.isin("click", "error"), kind).alias("summary"),
    )
    return feeds.with_raw_content(rows).select("event_id", "raw_content")


@case("s05_since_filter", "select raw_item_id, published_at from raw_items where published_at > timestamp '2024-01-10 12:00:00'")
def _(spark, d):
    return feeds.since_filter(table(spark, d, "raw_items").select("raw_item_id", "published_at"), "2024-01-10 12:00:00")


@case(
    "s07_backfill_months",
    """select case when grouping(m) = 0 then m end as month_start, grouping(m)::int as is_total, count(*) as months,
         sum(p)::bigint as payloads_seen, sum(n)::bigint as new_raw from (
         select m::date as m, (select count(*) from raw_incoming where date_trunc('month', published_at) = m) as p,
           (select count(*) from new_raw where date_trunc('month', published_at) = m) as n
         from (select unnest(generate_series(timestamp '2023-11-01', timestamp '2024-02-01', interval 1 month)) as m))
       group by rollup (m)""",
    new_raw=_NEW_RAW,
)
def _(spark, d):
    return backfill_months(table(spark, d, "raw_incoming"), new_raw_of(spark, d), "2023-11-15", "2024-02-29")


@case("s11_duplicate_names", "select role as name, count(*) as n from conversations group by 1 having count(*) > 1")
def _(spark, d):
    return feeds.duplicate_names(given(spark, d, "conversations").select(F.col("role").alias("name")))


@case("s01_read_feed_items", "select event_id::varchar as external_id, date_trunc('second', ts) as published_at, event_type as author, props as raw_content, 'f' as source from events")
def _(spark, d):
    path = scratch(spark, "feed")
    rfc = F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0000"))
    given(spark, d, "events").select(
        F.col("event_id").cast("string").alias("guid"),
        F.concat(F.lit("http://example.org/"), F.col("event_id")).alias("link"),
        rfc.alias("pubDate"),
        F.col("event_type").alias("author"),
        F.col("props").alias("description"),
    ).write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    rows = feeds.read_feed_items(spark, path, "f", "2024-03-01")
    return rows.select(
        "external_id", F.col("published_at").cast("timestamp_ntz").alias("published_at"), "author", "raw_content", "source"
    )


@case("s06_read_transcripts", "select string_agg(text, chr(10) order by turn) as text from conversations group by conv_id")
def _(spark, d):
    path = scratch(spark, "captions")
    talks = given(spark, d, "conversations").groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), "\n").alias("text")
    )
    # One folder, so one file, per conversation.
    talks.repartition(8).write.partitionBy("conv_id").option("lineSep", "\x00").text(path)
    rows = files.read_transcripts(spark, f"{path}/conv_id=*")
    return rows.select(F.rtrim("text", F.lit("\x00")).alias("text"))


@case(
    "s09_write_sample_jsonl",
    "select item_id, llm_level, llm_confidence, stratum, clean_text, null::int as human_level from sampled join items using (item_id)",
    **_SAMPLE,
)
def _(spark, d):
    path = scratch(spark, "sample")
    files.write_sample_jsonl(S.attach_texts(sample_of(spark, d), table(spark, d, "items")), path)
    back = files.read_audit_labels(spark, path)
    return back.select("item_id", "llm_level", "llm_confidence", "stratum", "clean_text", "human_level")


_FIGURES = ("auc_pr", "ece", "mae", "base_rate")


@case("s10_write_report_json", f"select score_set, n_test, target, n, {r9sql(*_FIGURES)} from test_metrics")
def _(spark, d):
    """The report, written and read back."""
    path = scratch(spark, "report")
    report = report_of(spark, d).nested()
    files.write_report_json(report, path)
    back = spark.read.schema(report.schema).json(path)
    sets = back.select(F.explode("score_sets").alias("s")).select("s.*")
    rows = sets.select("score_set", "n_test", F.explode("metrics").alias("m")).select("score_set", "n_test", "m.*")
    return r9(rows, *_FIGURES)
