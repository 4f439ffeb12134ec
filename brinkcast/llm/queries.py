"""Registered corpus queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinkcast.llm.jaccard_join import jaccard_components
from brinkcast.llm.language_id import held_out, identify, learn_profiles
from brinkcast.llm.licenses import scan_licenses, templates
from brinkcast.llm.mixing import DOMAINS, TARGETS, fit_domains, fit_rates, labelled_domains, with_posteriors, with_rates
from brinkcast.llm.mtree import scaled, top_inner_products
from brinkcast.llm.packing import pack, token_pieces
from brinkcast.llm.quality import quality_filter
from brinkcast.llm.ranked_search import rank_documents
from brinkcast.llm.secrets import KINDS, listed, thresholds, with_evidence, with_spans
from brinkcast.llm.storage import stored
from brinkcast.llm.substring_dedup import remove_repeats
from brinkcast.llm.url_filter import filter_urls, thin_hosts
from brinkcast.llm.vector_codes import compress
from brinkcast.llm.warc import archive_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", scaled("embedding").alias("v"))
    return top_inner_products(vectors, vectors.where("vec_id % 20 = 0"), k=20)


#: Rules of the query: host, path, verdict.
URL_RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = spark.sql("select * from values " + ", ".join(map(str, URL_RULES)) + " as rules(host, path, verdict)")
    judged = filter_urls(pages.select("page_id", "url"), rules, thin_hosts(pages))
    return judged.select("page_id", "host", "path", "rule", "verdict")


OP2_SQL = f"""
with parsed as (
  select page_id, coalesce(html, '') as html,
    case when contains(url, '://') then translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
    case when contains(url, '://') then regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's') else '' end as path
  from pages
), rules(h, p, v) as (values {", ".join(map(str, URL_RULES))}),
fit as (
  select page_id, h || p as rule, v,
    row_number() over (partition by page_id order by length(h || p) desc, length(h) desc) as r
  from parsed join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
), thin as (
  select host from parsed where host <> '' group by host
  having cast(sum(length(html)) as double) / count(*) * 2 < (select cast(sum(length(html)) as double) / count(*) from parsed)
), listed as (
  select distinct page_id from parsed p join thin t on p.host = t.host or ends_with(p.host, '.' || t.host)
)
select p.page_id, p.host, p.path, f.rule,
  coalesce(f.v, case when l.page_id is not null then 'block' else 'allow' end) as verdict
from parsed p left join fit f on f.page_id = p.page_id and f.r = 1 left join listed l on l.page_id = p.page_id
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs.where(~held_out() & F.col("doc_id").isNotNull()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), profiles).drop("text")


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"), tokenizer_file())
    return pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_filter(docs).drop("lang", "source")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"))


OP8_SQL = """
with p as (
  select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), q as (select *, max(page_id) over (partition by payload_digest) as largest from p)
select page_id, payload_bytes, payload_digest,
  case when payload_bytes >= 1000 and page_id <> largest then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 1000 and page_id <> largest then largest end as refers_to
from q
"""


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    evidence = stored(with_evidence(docs).drop("text"), "evidence")
    found = with_spans(evidence, thresholds(evidence))
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


def op10_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_domains(docs, labelled_domains(table(spark, sf_dir, "labels")))
    rows = stored(with_posteriors(docs, model).drop("text"), "posteriors")
    rated = with_rates(rows, fit_rates(rows, TARGETS))
    shares = [F.col("posterior")[i].alias(f"p_{d}") for i, d in enumerate(DOMAINS)]
    return rated.select("doc_id", "tokens", *shares, "rate")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4)
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _op11_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    grid = "list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint))"
    bad = "len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x)))"
    square = "cast(list_dot_product(cast({v} as double[]), cast({w} as double[])) as bigint)"
    steps = [
        f"kept as materialized (select vec_id, label, {grid} as v from embeddings where embedding is not null and {bad} = 0)",
        f"cut as (select vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] as v from kept, range({parts}) t(p))",
        f"part as materialized (select vec_id, cast(p as int) as p, v, {square.format(v='v', w='v')} as s from cut)",
        f"""b0 as materialized (select p, row_number() over (partition by p order by vec_id) - 1 as e, v, s from part
  where vec_id in (select vec_id from kept order by vec_id limit {entries}))""",
    ]
    for r in range(rounds + 1):
        near = f"min((a.s + b.s - 2 * {square.format(v='a.v', w='b.v')}) * {entries} + b.e)"
        steps.append(f"a{r} as materialized (select a.vec_id, a.p, any_value(a.v) as v, {near} as k from part a join b{r} b on a.p = b.p group by a.vec_id, a.p)")
        if r < rounds:
            steps += [
                f"m{r} as (select p, k % {entries} as e, i, floor(cast(sum(v[i]) as double) / count(*)) as x from a{r}, range(1, 1 + len(v)) t(i) group by all)",
                f"n{r} as (select p, e, list(cast(x as bigint) order by i) as v from m{r} group by p, e)",
                f"""b{r + 1} as materialized (select p, e, w as v, {square.format(v='w', w='w')} as s
  from (select b.p, b.e, coalesce(n.v, b.v) as w from b{r} b left join n{r} n on b.p = n.p and b.e = n.e))""",
            ]
    last = f"a{rounds}"
    return f"""with {", ".join(steps)},
book as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) as codebooks_sha256 from b{rounds}),
coded as (select vec_id, string_agg(printf('%02x', k % {entries}), '' order by p) as code, cast(sum(k // {entries}) as bigint) as error
  from {last} group by vec_id)
select c.vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded c join kept using (vec_id), book"""


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
OP12_SQL = f"""
with held as (select doc_id, unnest(regexp_extract_all({_LOWER.format('text')}, '{_TERM}')) as term from documents),
tfs as materialized (select doc_id, term, count(*) as tf from held group by all),
lengths as (select doc_id, cast(sum(tf) as bigint) as n from tfs group by doc_id),
corpus as (select count(*) as docs, cast(sum(n) as bigint) as terms from lengths),
dfs as (select term, count(*) as df from tfs group by term),
asked as (select distinct item_id, unnest(regexp_extract_all({_LOWER.format('text')}, '{_TERM}')) as term from benchmark),
scored as (
  select item_id, doc_id, cast(sum(cast(floor(1000 * ln(cast(2 * docs + 2 as double) / (2 * df + 1))) as bigint)
    * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) as bigint) as score
  from asked join tfs using (term) join dfs using (term) join lengths using (doc_id), corpus
  group by item_id, doc_id
), ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank, doc_id, score
  from scored where score > 0
)
select * from ranked where rank <= 10
"""


def op13_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licenses(docs).drop("text", "notices")


def _op13_sql() -> str:
    rows = []
    for i, t in enumerate(templates()):
        key = {p for a, b in t.phrases for p in range(a, b)}
        rows += [(i, t.label, p, w.decode(), p in key, len(t.words), t.needed, len(key), t.base) for p, w in enumerate(t.words)]
    values = ", ".join(str(r) for r in rows)
    return f"""
with split as (
  select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
), word as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) - 1 as pos from split),
template(t, label, q, word, key, m, needed, keys, base) as (values {values}),
found as (
  select doc_id, any_value(label) as label, pos - q as start, cast(count(*) as double) / any_value(m) as share, any_value(base) as base
  from word join template using (word) group by doc_id, t, pos - q
  having count(*) >= any_value(needed) and count(*) filter (key) = any_value(keys)
)
select s.doc_id, cast(len(any_value(s.words)) as bigint) as n_words, count(*) filter (base) as n_base,
  cast(min(start) filter (base) as bigint) as first_word, cast(max(start) filter (base) as bigint) as last_word,
  coalesce(string_agg(distinct label, ',' order by label) filter (base), '') as base_labels,
  coalesce(string_agg(distinct label, ',' order by label) filter (label is not null), '') as labels,
  coalesce(max(share), 0) as score
from split s left join found f on s.doc_id = f.doc_id group by s.doc_id
"""


QUERIES = {
    "op1_exact_topk": op1_exact_topk,
    "op2_url_filters": op2_url_filters,
    "op3_language_id": op3_language_id,
    "op4_ngram_jaccard_join": op4_ngram_jaccard_join,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_quality_rules": op7_quality_rules,
    "op8_warc": op8_warc,
    "op9_secret_scans": op9_secret_scans,
    "op10_mixing_sources": op10_mixing_sources,
    "op11_vector_codes": op11_vector_codes,
    "op12_ranked_search": op12_ranked_search,
    "op13_license_scans": op13_license_scans,
}
SQL: dict[str, str] = {
    "op2_url_filters": OP2_SQL,
    "op8_warc": OP8_SQL,
    "op11_vector_codes": _op11_sql(),
    "op12_ranked_search": OP12_SQL,
    "op13_license_scans": _op13_sql(),
}
