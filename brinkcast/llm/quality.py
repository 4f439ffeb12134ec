"""Quality rules with thresholds that adapt to language and source.

Per text: words, characters in words, symbols, repeated lines, words in 5-word
windows that occur twice or more, all in one pass of column expressions; a text
never leaves its row.

Shares of these (per thousand) are summarised by mergeable quantile sketches: each
share falls into a bucket of bounded relative width, a group's sketch is the count
of its buckets, and sketches merge by adding counts, so they are the same whatever
the partitioning.  The limit of a group (language, source) and share is an outlier
fence, ``upper quartile + spread * (upper quartile - lower quartile)``, and at
least ``slack`` above the upper quartile.  Groups with less than ``enough`` texts
take the limits of their language, languages with less those of all texts.  The
limits are joined to the texts; a text above one of them is not kept.  Texts that
fail the base rules teach no limits.

Null texts have no words.  Null languages and sources are groups of their own.
Repeated rows are judged one by one.  Columns of the input named as those added
are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinkcast.llm.storage import stored

SPACE = "[\\\\x20\\\\x09-\\\\x0D]+"
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Shares per thousand: symbols to characters, repeated lines to words, words in
#: repeated windows to words, characters to words (tenths), each with its slack.
SHARES = {
    "symbols": ("1000 * n_symbols div greatest(word_chars, 1)", 20),
    "lines": ("1000 * n_dup_lines div greatest(n_words, 1)", 25),
    "repeats": ("1000 * n_repeat_words div greatest(n_words, 1)", 150),
    "length": ("10 * word_chars div greatest(n_words, 1)", 30),
}
#: Values up to this are buckets of their own; above, a power of two has half as many.
EXACT = 32


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``MEASURES`` and ``base_failed``."""
    taken = {*MEASURES, "base_failed"}
    names = [c for c in docs.columns if c.lower() not in taken]
    t = f"coalesce(`{text}`, '')"
    df = docs.select(
        *names,
        F.expr(f"filter(split({t}, '{SPACE}'), w -> w <> '')").alias("_words"),
        F.expr(f"filter(split({t}, '\\n', -1), l -> l rlike '[^\\\\x20\\\\x09-\\\\x0D]')").alias("_lines"),
        F.expr(f"cast(char_length({t}) - char_length(translate({t}, '{SYMBOLS}', '')) as long)").alias("n_symbols"),
    )
    # starts of 5-word windows that are not alone, in order of their hash, then of their place
    windows = "transform(sequence(1, size(_words) - 4), i -> struct(xxhash64(slice(_words, i, 5)) as h, i as i))"
    df = df.withColumn("_windows", F.expr(f"if(size(_words) < 5, cast(array() as array<struct<h:bigint,i:int>>), sort_array({windows}))"))
    twice = "filter(_windows, (w, j) -> (j > 0 and _windows[j - 1].h = w.h) or (j + 1 < size(_windows) and _windows[j + 1].h = w.h))"
    df = df.withColumn("_starts", F.expr(f"sort_array(transform({twice}, w -> w.i))"))
    covered = "aggregate(_starts, named_struct('n', 0L, 'to', 0), (a, i) -> named_struct('n', a.n + i + 5 - greatest(a.to, i), 'to', i + 5), a -> a.n)"
    df = df.select(
        *names,
        F.expr("cast(size(_words) as long)").alias("n_words"),
        F.expr("cast(aggregate(_words, 0, (n, w) -> n + char_length(w)) as long)").alias("word_chars"),
        "n_symbols",
        F.expr("cast(size(_lines) - size(array_distinct(_lines)) as long)").alias("n_dup_lines"),
        F.expr(covered).alias("n_repeat_words"),
    )
    return df.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))


def bucket(value: Column) -> Column:
    """Number of the bucket of a whole number, 0 or more: exact up to ``EXACT``,
    above it within a sixteenth."""
    doublings = F.greatest(F.length(F.bin(value)) - F.length(F.bin(F.lit(EXACT - 1))), F.lit(0))
    return doublings * (EXACT // 2) + F.floor(value / F.pow(F.lit(2.0), doublings)).cast("long")


def bucket_top(number: Column) -> Column:
    """Largest value of a bucket."""
    half = EXACT // 2
    doublings = F.greatest(F.floor(number / half) - 1, F.lit(0))
    return (((number - doublings * half + 1) * F.pow(F.lit(2.0), doublings)) - 1).cast("long")


def sketches(rows: DataFrame) -> DataFrame:
    """(lang, source, share, bucket, n) of the texts that pass the base rules."""
    pairs = [F.struct(F.lit(name).alias("share"), bucket(F.expr(sql)).alias("bucket")) for name, (sql, _) in SHARES.items()]
    each = rows.where("not base_failed").select("lang", "source", F.explode(F.array(*pairs)).alias("s"))
    return each.groupBy("lang", "source", "s.share", "s.bucket").agg(F.count("*").alias("n"))


def limits(counts: DataFrame, spread: float = 3.0) -> DataFrame:
    """(level, lang, source, share, n, top) of every group, language and of all texts.

    The three levels are merged from one table of bucket counts; ``level`` is 0 for
    groups, 1 for languages, 2 for all.
    """
    merged = counts.groupBy("share", "bucket").agg(F.sum("n").alias("n")).select(
        F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"), "share", "bucket", "n"
    )
    by_lang = counts.groupBy("lang", "share", "bucket").agg(F.sum("n").alias("n")).select(
        F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source"), "share", "bucket", "n"
    )
    by_group = counts.select(F.lit(0).alias("level"), "lang", "source", "share", "bucket", "n")
    group = Window.partitionBy("level", "lang", "source", "share")  # a few hundred buckets at most
    run = by_group.union(by_lang).union(merged).withColumn("m", F.sum("n").over(group)).withColumn("upto", F.sum("n").over(group.orderBy("bucket")))
    quartile = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("m") * q, bucket_top(F.col("bucket"))))
    found = run.groupBy("level", "lang", "source", "share").agg(F.max("m").alias("n"), quartile(1).alias("low"), quartile(3).alias("high"))
    slack = F.create_map(*[F.lit(x) for name, (_, s) in SHARES.items() for x in (name, s)])[F.col("share")]
    return found.select("level", "lang", "source", "share", "n", (F.col("high") + F.greatest(spread * (F.col("high") - F.col("low")), slack)).alias("top"))


def judged(rows: DataFrame, tops: DataFrame, enough: int = 100) -> DataFrame:
    """``rows`` with ``kept``: neither failed nor above a limit."""
    names = [c for c in rows.columns if c.lower() != "kept"]
    wide = tops.groupBy("level", "lang", "source").agg(
        *[F.max(F.when(F.col("share") == s, F.col("top"))).alias(f"_{s}") for s in SHARES], F.max("n").alias("_n")
    )
    picked = rows.select(*names)
    for level, keys in ((0, ("lang", "source")), (1, ("lang",))):
        part = wide.where((F.col("level") == level) & (F.col("_n") >= enough))
        part = part.select(*[F.col(k).alias(f"_k{k}") for k in keys], *[F.col(f"_{s}").alias(f"_{s}{level}") for s in SHARES])
        match = [F.col(k).eqNullSafe(F.col(f"_k{k}")) for k in keys]
        picked = picked.join(part, match, "left").drop(*[f"_k{k}" for k in keys])
    whole = wide.where("level = 2").first()  # the limits of all texts: one row, or none
    within = [
        F.expr(f"{sql} <= coalesce(_{s}0, _{s}1, {whole[f'_{s}'] if whole else 0})") for s, (sql, _) in SHARES.items()
    ]
    ok = ~F.col("base_failed")
    for w in within:
        ok = ok & w
    return picked.select(*names, ok.alias("kept"))


def quality_filter(docs: DataFrame, text: str = "text", spread: float = 3.0, enough: int = 100) -> DataFrame:
    """``docs`` (with ``lang`` and ``source``) measured and judged; texts are read
    once, the measures are written to the shared folder."""
    names = [c for c in docs.columns if c != text]
    rows = stored(measured(docs, text).drop(text), "measures") if names else docs
    return judged(rows, limits(sketches(rows), spread), enough)
