"""Entities named in texts, by a table of aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: No alias has as many words.
MOST_WORDS = 1 << 16


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _grams(words: Column, lengths: list[int]) -> Column:
    """All runs of so many words, with the place (from 1) of their first word."""

    def of(n: int) -> Column:
        last = F.size(words) - n + 1
        run = lambda at: F.struct(at.alias("start"), F.lit(n).alias("n"), F.array_join(F.slice(words, at, n), " ").alias("gram"))
        return F.when(last > 0, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), run)).otherwise(F.array())

    return F.concat(*[of(n) for n in lengths])


def alias_matches(posts: DataFrame, aliases: DataFrame, key: str, text: str = "clean_text") -> DataFrame:
    """(``key``, entity, start, n) of every place where an alias stands as whole words.

    ``aliases`` has columns entity and alias.  Where one match lies within a longer one
    only the longer counts; matches that merely overlap all count, as do all entities
    that share an alias.  Null and wordless texts and aliases match nothing, rows without
    key are left out.  The work is words times distinct alias lengths; only these
    lengths come to the driver.
    """
    named = (
        aliases.select("entity", tokens(F.col("alias")).alias("words"))
        .where(F.size("words").between(1, MOST_WORDS - 1))
        .select("entity", F.size("words").alias("n"), F.array_join("words", " ").alias("gram"))
        .distinct()
    )
    lengths = sorted(r.n for r in named.select("n").distinct().collect())
    # the words are a lambda's variable, so they are cut once for all runs
    runs = F.transform(F.array(tokens(F.col(text))), lambda words: _grams(words, lengths))[0] if lengths else F.array().cast("array<struct<start:int,n:int,gram:string>>")
    found = (
        posts.where(F.col(key).isNotNull())
        .select(F.col(key), F.explode(runs).alias("run"))
        .select(key, "run.*")
        .join(named, ["n", "gram"])
        .drop("gram")
    )
    # earlier in this order are the matches that start before, or with it and are longer
    place = F.col("start").cast("long") * MOST_WORDS - F.col("n")
    before = W.partitionBy(key).orderBy(place).rangeBetween(W.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    covered = F.max(end).over(before)
    return found.withColumn("_covered", covered).where(F.col("_covered").isNull() | (F.col("_covered") < end)).select(key, "entity", "start", "n")


def alias_mentions(posts: DataFrame, aliases: DataFrame, key: str, text: str = "clean_text") -> DataFrame:
    """(entity, mentions, posts): places and posts that name each entity found."""
    each = alias_matches(posts, aliases, key, text).groupBy("entity", key).agg(F.count("*").alias("n"))
    return each.groupBy("entity").agg(F.sum("n").alias("mentions"), F.count("*").alias("posts"))
