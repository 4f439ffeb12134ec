"""Text cleaning, feeds, files, months."""

import html
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from brinkcast.functions import text as TX
from brinkcast.functions import times as TM
from brinkcast.functions.text import segments
from brinkcast.operators.aliases import alias_matches, alias_mentions
from brinkcast.sources import feeds, files
from brinkcast.sources.months import backfill_months, month_spine


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("<p>Hello</p>", "Hello"),
        ("a<br/>b", "a b"),
        ("<!-- <b>no</b> --><i>yes</i>", "yes"),
        ("<script>var a='<p>';</script>x<style>\np{}</style >y", "xy"),
        ("1 &lt; 2 &amp;&amp; 3 &gt; 2 &quot;q&quot; &#39;s&#39;&nbsp;!", "1 < 2 && 3 > 2 \"q\" 's' !"),
        ("&amp;lt;", "&lt;"),
        (None, ""),
    ],
)
def test_html(spark, raw, want):
    assert one(spark, raw, lambda c: TX.normalize_text(c, is_html=True)) == want


@pytest.mark.parametrize(
    "raw, want, n",
    [("a  b", "a b", 2), ("  a \n\tb\x1cc　 ", "a b c", 3), ("   ", "", 0), ("", "", 0)],
)
def test_white_space(spark, raw, want, n):
    assert one(spark, raw, TX.normalize_text) == want
    assert one(spark, raw, lambda c: TX.token_count(TX.normalize_text(c))) == n


def pack(text, max_chars, sep="\n\n"):
    """Plain reading of the packing rule."""
    out, buf, size = [], [], 0
    for p in (q.strip() for q in text.split(sep)):
        if not p:
            continue
        if buf and size + len(p) > max_chars:
            out.append("\n\n".join(buf))
            buf, size = [p], len(p)
        else:
            buf.append(p)
            size += len(p) + 2
    return out + (["\n\n".join(buf)] if buf else [])


@pytest.mark.parametrize(
    "text", ["", "   \n\n \n\n", "abc", "abc\n\ndef\n\n\n\n ghi \n\n" + "x" * 50 + "\n\ny", "\n\n".join("w" * (i % 13) for i in range(60)), "é \n\n ü"]
)
@pytest.mark.parametrize("max_chars", [1, 10, 12, 1200])
def test_segments(spark, text, max_chars):
    df = spark.createDataFrame([(1, text)], "id int, text string")
    got = [r["chunk"] for r in TX.segment_documents(df, "id", "text", max_chars=max_chars).orderBy("chunk_no").collect()]
    assert got == pack(text, max_chars)


def test_ladder_reads_from_the_top(spark):
    phrases = {6: ["attack"], 3: ["Liar"], 1: ["wrong"]}
    got = [one(spark, t, lambda c: TX.ladder_level(c, phrases)) for t in ("a LIAR, attack!", "you liar wrong", "Wrong", "ok")]
    assert got == [6, 3, 1, 0]


def test_preview_and_excerpt(spark):
    assert one(spark, "a\nb", TX.preview_text) == "a b"
    long = one(spark, "z" * 141, TX.preview_text)
    assert len(long) == 140 and long.endswith("z...")
    assert one(spark, "z" * 140, TX.preview_text) == "z" * 140
    assert len(one(spark, "z" * 5000, TX.excerpt)) == 4000


FEED = """<?xml version="1.0"?><rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"
 xmlns:content="http://purl.org/rss/1.0/modules/content/"><channel><title>t</title>
<item><guid isPermaLink="false">g1</guid><link>http://x/1</link><pubDate>Fri, 02 Jan 2026 03:04:05 +0200</pubDate>
 <dc:creator>Ann</dc:creator><description>short</description><content:encoded><![CDATA[<p>full</p>]]></content:encoded></item>
<item><link>http://x/2</link><pubDate>Sat, 03 Jan 2026 00:00:00 GMT</pubDate><description>only summary</description></item>
<item><pubDate>soon</pubDate></item></channel></rss>"""


def test_feed_items(spark, tmp_path):
    (tmp_path / "f.xml").write_text(FEED, encoding="utf-8")
    df = feeds.read_feed_items(spark, str(tmp_path), "src", "2026-02-01")
    us = F.unix_micros("published_at").alias("us")
    got = {r["external_id"]: r for r in df.select("*", us).collect()}
    assert set(got) == {"g1", "http://x/2", "2026-02-01T00:00:00+00:00"}
    assert got["g1"]["raw_content"] == "<p>full</p>" and got["g1"]["author"] == "Ann"
    assert got["g1"]["us"] == TM.epoch_micros(datetime(2026, 1, 2, 1, 4, 5))
    assert got["http://x/2"]["raw_content"] == "only summary" and got["http://x/2"]["media_urls"] == []
    assert got["http://x/2"]["raw_metadata"] == {"link": "http://x/2"}
    assert got["2026-02-01T00:00:00+00:00"]["raw_content"] == ""
    later = feeds.read_feed_items(spark, str(tmp_path), "src", "2026-02-01", since="2026-01-03")
    assert later.count() == 1  # strictly after


@pytest.mark.parametrize(
    "raw, want",
    [
        ("Mon, 5 Jan 2026 10:00:00 -0500", datetime(2026, 1, 5, 15)),
        ("Mon, 05 Jan 2026 10:00:00", datetime(2026, 1, 5, 10)),
        ("2026-01-05T10:00:00+01:00", datetime(2026, 1, 5, 9)),
        ("05 Jan 2026 10:00 UT", datetime(2026, 1, 5, 10)),
        ("", datetime(2026, 3, 1)),
        (None, datetime(2026, 3, 1)),
    ],
)
def test_feed_times(spark, raw, want):
    got = one(spark, raw, lambda c: F.unix_micros(TM.parse_feed_time(c, TM.time_literal("2026-03-01"))))
    assert got == TM.epoch_micros(want)


def test_sources_are_unique(spark):
    rows = [("a", "http://a", "A"), ("b", "http://b", "B")]
    df = feeds.source_dimension(spark, rows)
    assert df.count() == 2 and feeds.duplicate_names(df).count() == 0
    with pytest.raises(ValueError, match="not unique: a"):
        feeds.source_dimension(spark, rows + [("a", "x", "y")])


def test_transcripts_replace_bad_bytes(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"one\n\ntwo \xff\xfe end")
    row = files.read_transcripts(spark, str(tmp_path)).first()
    assert row["text"].startswith("one\n\ntwo �") and row["text"].endswith(" end")


def test_audit_labels(spark, tmp_path):
    lines = ['{"item_id":1,"llm_level":3,"human_level":"4"}', '{"item_id":2,"llm_level":3,"human_level":null}', '{"item_id":3,"llm_level":"x","human_level":1}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    rows = files.read_audit_labels(spark, str(tmp_path))
    assert [tuple(r) for r in files.usable_labels(rows).select("item_id", "llm_level", "human_level").collect()] == [(1, 3, 4)]
    assert tuple(files.skipped_labels(rows).first()) == (1, 2)


@pytest.mark.parametrize(
    "since, until, want",
    [
        ("2026-03-05", "2026-03-20", [(date(2026, 3, 1), date(2026, 3, 31))]),
        ("2024-02-10", "2024-02-11", [(date(2024, 2, 1), date(2024, 2, 29))]),
        ("2026-03-01", "2026-02-01", []),
    ],
)
def test_months(spark, rows, since, until, want):
    assert rows(month_spine(spark, since, until)) == want


def test_months_over_new_year(spark):
    df = spark.createDataFrame([(datetime(2025, 12, 31, 23),), (datetime(2026, 2, 1),), (datetime(2026, 9, 1),)], "published_at timestamp")
    got = backfill_months(df, df.limit(0), "2025-11-30", "2026-02-01").orderBy("is_total", "month_start").collect()
    assert [r["payloads_seen"] for r in got] == [0, 1, 0, 1, 2]
    assert (got[-1]["months"], got[-1]["month_start"], got[-1]["new_raw"]) == (4, None, 0)


def test_grid_floor_keeps_type(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1, 10, 44, 59, 999999),)], "t timestamp_ntz")
    start, end = TM.prediction_window(F.col("t"))
    out = df.select(start.alias("s"), end.alias("e"))
    assert out.schema["s"].dataType.simpleString() == "timestamp_ntz"
    assert tuple(out.first()) == (datetime(2026, 1, 1, 10, 30), datetime(2026, 1, 1, 12, 30))


def test_references_are_decoded_like_the_standard_library(spark):
    import html

    texts = ["&copy; &#8217; &eacute;&#x1F600; &amp;lt; &nope; & &#0; &#xD800; &#150; &#1114112; a&b; &NotEqualTilde;", "&", "", "&amp;" * 50]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(TX.decode_references(F.col("t"))).collect()]
    assert got == [html.unescape(t) for t in texts]


def test_feed_times_with_zone_names_and_short_years(spark):
    from brinkcast.functions.times import parse_feed_time, time_literal

    raws = ["Tue, 03 Feb 2026 10:00:00 EST", "03 Feb 26 10:00 PDT", "3 Feb 70 10:00:00 GMT", "x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(raws)], "i int, t string")
    at = parse_feed_time(F.col("t"), time_literal("2024-03-01", "timestamp")).cast("string")
    got = [r[0] for r in df.orderBy("i").select(at).collect()]
    assert got == ["2026-02-03 15:00:00", "2026-02-03 17:00:00", "1970-02-03 10:00:00", "2024-03-01 00:00:00"]


def test_atom_entries(spark, tmp_path):
    from brinkcast.sources.feeds import read_feed_items

    (tmp_path / "a.xml").write_text(
        """<feed xmlns="http://www.w3.org/2005/Atom"><title>f</title>
        <entry><id>u1</id><link rel="self" href="http://s"/><link href="http://l"/><updated>2026-02-03T10:00:00Z</updated>
        <author><name>Ann</name></author><content type="html">body</content></entry>
        <entry><link href="http://only"/><published>2026-02-03T11:00:00+01:00</published><summary>short</summary></entry></feed>"""
    )
    rows = read_feed_items(spark, str(tmp_path), "f", "2024-03-01").orderBy("external_id").collect()
    assert [(r.external_id, r.author, r.raw_content, str(r.raw_metadata["link"])) for r in rows] == [
        ("http://only", None, "short", "http://only"),
        ("u1", "Ann", "body", "http://l"),
    ]


def _chunks_by_hand(text, sep, budget):
    done, held, size = [], [], 0
    for p in [p.strip() for p in text.split(sep)]:
        if p and held and size + len(p) > budget:
            done, held, size = [*done, "\n\n".join(held)], [p], len(p)
        elif p:
            held, size = [*held, p], size + len(p) + 2
    return done + (["\n\n".join(held)] if held else [])


def test_segments_equal_packing_by_hand_also_for_a_long_text(spark):
    texts = ["", "a", " \n\n \n\n", "x" * 50 + "\n\n" + "y" * 50 + "\n\nz", "\n\n".join("w" * (i % 17) for i in range(60)), "word word\n\n" * 100_000]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "id int, t string")
    for budget in (1, 20, 1200):
        rows = df if budget == 1200 else df.where("id <> 5")  # as many chunks as paragraphs take long
        got = {r.id: r.s for r in rows.select("id", segments(F.col("t"), "\n\n", budget).alias("s")).collect()}
        want = {i: _chunks_by_hand(t, "\n\n", budget) for i, t in enumerate(texts)} | {6: None}
        assert got == {i: want[i] for i in got} and len(got) == rows.count()


def test_aliases_are_whole_words_and_the_longest_wins(spark):
    rows = [(1, "Money, one New York Times; new york"), (2, None), (3, ""), (None, "one"), (4, "one One")]
    posts = spark.createDataFrame(rows, "id long, clean_text string")
    listed = [("city", "New York"), ("paper", "new york times"), ("times", "Times"), ("1", "one"), ("uno", "ONE"), ("1", "One"), ("x", None), ("y", "?")]
    aliases = spark.createDataFrame(listed, "entity string, alias string")
    got = sorted(tuple(r) for r in alias_matches(posts, aliases, "id").collect())
    assert got == [(1, "1", 2, 1), (1, "city", 6, 2), (1, "paper", 3, 3), (1, "uno", 2, 1), (4, "1", 1, 1), (4, "1", 2, 1), (4, "uno", 1, 1), (4, "uno", 2, 1)]
    assert sorted(tuple(r) for r in alias_mentions(posts, aliases, "id").where("entity = '1'").collect()) == [("1", 3, 2)]
    assert alias_matches(posts, aliases.limit(0), "id").count() == 0
    assert alias_matches(posts.limit(0), aliases, "id").count() == 0


def test_references_without_semicolon(spark):
    texts = ["&copy 2024", "&notit;", "&notin; &notin x", "&#169 &#xA9x &#169", "a&ampb;&amp;lt;", "&unknown; & &x &;", "&#999999999;", "AT&T &ltp&gt", "&frac12 &frac34;", "x?a=1&copy=2", None]
    got = [r.t for r in spark.createDataFrame([(t,) for t in texts], "t string").select(TX.decode_references(F.col("t")).alias("t")).collect()]
    keep = {"&#999999999;"}  # numbers that long stay
    assert got == [t if t is None or t in keep else html.unescape(t) for t in texts]
