"""Filtering of urls by rules and lists that are held in Bloom filter cascades.

A url's *keys* are ends of its host at label borders, each followed by starts of
its path.  Only label counts and path lengths that occur in a list are built, so a
url has few keys however long it is.  Membership of keys in a list is decided by a
cascade: the first level is a Bloom filter of the listed keys, the second one of
the keys of the corpus that pass the first without being listed, the third one of
the listed keys that pass the second, and so on until none pass.  As levels cover
all keys of the corpus, the answer is exact for each of them, without a join.

With n listed keys among u, level one lets through about ``n / u`` of the others
and later levels half, so a cascade has some ``1.5 n (log2(u / n) + 5)`` bits
whatever the number of urls.  A bit takes a byte of a table that every task holds.
Lists above ``most_listed`` keys have their tables cut in parts, one for each
``most_listed`` keys, of which a key reads the one that its place lies in.

Null urls, and those without ``://``, have an empty host and path and no keys in
any list.  Repeated rows are judged one by one.  Columns of the input named as
those added are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHOLE = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``."""
    names = [c for c in pages.columns if c.lower() not in ("host", "path")]
    part = lambda i: F.coalesce(F.regexp_extract(F.col(url), WHOLE, i), F.lit(""))
    return pages.select(*names, F.translate(part(1), UPPER, LOWER).alias("host"), part(2).alias("path"))


@dataclass(frozen=True)
class Shape:
    """Label counts of hosts and lengths of paths that occur in a list."""

    labels: tuple[int, ...]
    lengths: tuple[int, ...]

    def keys(self) -> Column:
        """All keys of a row with ``host`` and ``path``: (length, host length, key)."""
        built = []
        for n in self.labels:
            end = F.substring_index("host", ".", -n)
            for m in self.lengths:
                key = F.concat(end, F.left("path", F.lit(m)))
                built.append(F.struct(F.char_length(key).alias("length"), F.char_length(end).alias("host_length"), key.alias("key")))
        return F.array_distinct(F.array(*built)) if built else F.expr("cast(array() as array<struct<length:int,host_length:int,key:string>>)")


def shape_of(listed: DataFrame) -> Shape:
    """Shape of a list (host, path)."""
    row = listed.agg(
        F.collect_set(F.size(F.split("host", "\\.", -1))).alias("labels"), F.collect_set(F.char_length("path")).alias("lengths")
    ).first()
    return Shape(tuple(sorted(row.labels)), tuple(sorted(row.lengths)))


@dataclass(frozen=True)
class Level:
    parts: tuple[bytes, ...]  # a byte for each bit, so that a test is a plain comparison; all but the last of one length
    size: int
    hashes: int
    seed: int

    def passes(self, key: Column) -> Column:
        """True for all keys of the level, and for some others."""
        tables, long, ok = [F.lit(p) for p in self.parts], len(self.parts[0]), None
        table = tables[0] if len(tables) == 1 else F.array(*tables)
        for i in range(self.hashes):
            place = _place(key, self.seed, i, self.size)
            if len(tables) == 1:
                byte = F.substring(table, place + 1, F.lit(1))
            else:
                byte = F.substring(F.get(table, F.floor(place / long).cast("int")), F.pmod(place, F.lit(long)) + 1, F.lit(1))
            bit = byte == F.lit(b"\x01")
            ok = bit if ok is None else ok & bit
        return ok


def _place(key: Column, seed: int, i: int, size: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(i)), F.lit(size)).cast("int")


def _level(keys: DataFrame, n: int, rate: float, seed: int, most_keys: int) -> Level:
    """Bloom filter of ``n`` keys that lets through ``rate`` of others, cut in a part
    for each ``most_keys``."""
    size = max(64, math.ceil(n * math.log(1 / rate) / math.log(2) ** 2))
    hashes = max(1, round(size / n * math.log(2)))
    place = F.explode(F.array(*[_place(F.col("key"), seed, i, size) for i in range(hashes)])).alias("place")
    words = keys.select(place).groupBy(F.floor(F.col("place") / 64).alias("word"))
    bits = words.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("place", F.lit(64)).cast("int"))).alias("bits"))
    table = np.zeros(-(-size // 64) * 64, np.uint8)
    for row in bits.toLocalIterator():  # size / 64 rows
        word = np.array([row.bits], "<i8").view(np.uint8)
        table[row.word * 64 : row.word * 64 + 64] = np.unpackbits(word, bitorder="little")
    long = -(-size // max(1, math.ceil(n / most_keys)))
    return Level(tuple(table[i : min(size, i + long)].tobytes() for i in range(0, size, long)), size, hashes, seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """True exactly for the listed ones of the keys it was built over."""
        verdict = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            verdict = F.when(self.levels[i].passes(key), verdict).otherwise(F.lit(i % 2 == 1))
        return verdict


def build_cascade(listed: DataFrame, universe: DataFrame, most_keys: int = 200_000) -> Cascade:
    """Cascade of ``listed`` over ``universe``, both distinct (key)."""
    inside = universe.join(listed, "key", "left_semi").cache()  # as small as the list
    outside = universe.join(listed, "key", "left_anti")
    n, others = inside.count(), outside.count()
    levels: list[Level] = []
    left, right = inside, outside  # whom the next level encodes, whom it may mistake
    rate = min(0.5, max(n, 1) / max(others, 1) * math.sqrt(0.5))
    while n:
        level = _level(left, n, rate, len(levels), most_keys)
        levels.append(level)
        left, right = right.where(level.passes(F.col("key"))), left
        n, rate = left.count(), 0.5
    inside.unpersist()
    return Cascade(tuple(levels))


def listed_keys(pages: DataFrame, listed: DataFrame, row_id: str, most_listed: int = 200_000) -> DataFrame:
    """``pages`` (with ``host`` and ``path``) and ``hits``: its keys that are in
    ``listed`` (host, path), the longest first (ties: the longer host).  Rows are
    judged one by one, whatever their ``row_id``."""
    names = [c for c in pages.columns if c.lower() != "hits"]
    listed = listed.where("host <> ''").select("host", "path").distinct()
    keyed = pages.select(*names, shape_of(listed).keys().alias("hits"))
    keys = listed.select(F.concat("host", "path").alias("key")).distinct()
    universe = keyed.select(F.explode("hits").alias("k")).select("k.key").distinct()
    holds = build_cascade(keys, universe, most_listed).holds
    hits = F.filter("hits", lambda k: holds(k["key"]))
    return keyed.select(*names, F.sort_array(hits, asc=False).alias("hits"))


def filter_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, row_id: str = "page_id", url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` (host, path, verdict) fit a host and its subdomains where the path
    starts with theirs; the longest decides.  Where none fits, urls of the blocked
    hosts ``listed`` (host) and of their subdomains are blocked.
    """
    names = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    df = parsed(pages, url)
    for verdict in ("allow", "block"):
        df = listed_keys(df, rules.where(F.col("verdict") == verdict), row_id).withColumnRenamed("hits", f"_{verdict}")
    df = listed_keys(df, listed.select("host", F.lit("").alias("path")), row_id)
    allow, block = F.get("_allow", F.lit(0)), F.get("_block", F.lit(0))
    allows = block.isNull() | (allow > block)
    fits = F.coalesce(allow, block)["key"].isNotNull()
    by_list = F.when(F.size("hits") > 0, "block").otherwise("allow")
    return df.select(
        *names,
        "host",
        "path",
        F.when(fits, F.when(allow.isNotNull() & allows, allow["key"]).otherwise(block["key"])).alias("rule"),
        F.when(~fits, by_list).when(allow.isNotNull() & allows, "allow").otherwise("block").alias("verdict"),
    )


def thin_hosts(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host) of hosts whose pages have on average less than half the characters
    that pages have on average."""
    sized = parsed(pages, url).select("host", F.char_length(F.coalesce(F.col(html), F.lit(""))).alias("n"))
    per = sized.groupBy("host").agg(F.sum("n").alias("chars"), F.count("*").alias("pages"))
    row = per.agg(F.sum("chars").alias("chars"), F.sum("pages").alias("pages")).first()
    mean = row.chars / row.pages if row.pages else 0.0
    return per.where((F.col("chars") / F.col("pages") * 2 < mean) & (F.col("host") != "")).select("host")
