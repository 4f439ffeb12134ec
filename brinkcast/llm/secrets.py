"""Secrets in texts: fixed patterns, and strings that pass as random.

Patterns (``assign``, ``access``, ``hex``) give the base spans.  Beyond these,
every run of 20 or more characters of the base64 alphabets is a candidate:

* its *encoding* is the smallest alphabet that holds all its characters;
* it must not be rejected as random by a battery of three tests: chi-squared
  uniformity over that alphabet, runs above and below the middle of the alphabet,
  and lag-1 serial correlation (level ``alpha``, shared by the three);
* it must be rejected as ordinary text: text draws some letters more often, which
  adds ``excess * length`` to its expected chi-squared, so the p-value is the lower
  tail of the non-central distribution.  Short strings have little power and so
  large p-values.  Within each encoding and class of length (powers of two) the
  false discovery rate of these rejections is held at ``rate`` by the
  step-up rule, over counts of p-values in bins of a twentieth of a decade.

What remains and overlaps no base span becomes a span ``random``.  All of it is
column expressions; to the driver comes one threshold for each encoding and class.
Null texts are empty.  Rows are judged one by one; columns of the input named as
those added are replaced.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"

#: Alphabets from small to large: name, pattern, symbols in order, excess of the
#: squared letter frequencies of ordinary text over even ones (symbols times their
#: sum, less one).
ENCODINGS = (
    ("decimal", "[0-9]+", "0123456789", 0.2),
    ("hex", "[0-9a-f]+", "0123456789abcdef", 1.0),
    ("hex_upper", "[0-9A-F]+", "0123456789ABCDEF", 1.0),
    ("lower", "[a-z]+", "abcdefghijklmnopqrstuvwxyz", 0.7),
    ("base32", "[A-Z2-7]+", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.1),
    ("alnum_lower", "[0-9a-z]+", "0123456789abcdefghijklmnopqrstuvwxyz", 1.4),
    ("base64", ".+", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-", 3.2),
)
BINS, LAST_BIN = 20, 400


def _spans(text: str, pattern: str, ok: str) -> str:
    """SQL for the spans (start, end, match) of qualifying matches, in code points.

    The pieces between matches and the matches themselves add up to positions;
    ``ok`` judges a match ``m.m``, with group 2 (of ``ASSIGN``) in ``m.g``.
    """
    p = pattern.replace("\\", "\\\\").replace("'", "\\'")
    group = f"regexp_extract_all({text}, '{p}', 2)" if "m.g" in ok else f"regexp_extract_all({text}, '{p}', 0)"
    matches = f"zip_with(regexp_extract_all({text}, '{p}', 0), {group}, (m, g) -> struct(m, g))"
    return (
        f"if({text} rlike '{p}', aggregate("
        f"zip_with({matches}, split({text}, '{p}', -1), (m, gap) -> struct(m.m as m, m.g as g, char_length(gap) as gap)), "
        f"named_struct('at', 0, 'spans', cast(array() as array<struct<start:int,end:int,match:string>>)), "
        f"(acc, m) -> named_struct('at', acc.at + coalesce(m.gap + char_length(m.m), 0), 'spans', "
        f"if({ok}, concat(acc.spans, array(named_struct('start', acc.at + m.gap, 'end', acc.at + m.gap + char_length(m.m), 'match', m.m))), acc.spans)), "
        f"acc -> acc.spans), cast(array() as array<struct<start:int,end:int,match:string>>))"
    )


def _normal_tail(z: str) -> str:
    """SQL for the lower tail of the normal distribution at ``z`` (any sign),
    by the rational approximation 26.2.17 of Abramowitz and Stegun."""
    t = f"(1 / (1 + 0.2316419 * abs({z})))"
    upper = (
        f"(exp(-({z}) * ({z}) / 2) * 0.3989422804 * {t} * (0.319381530 + {t} * (-0.356563782 + {t} * "
        f"(1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429)))))"
    )
    return f"if({z} < 0, {upper}, 1 - {upper})"


def _pick(column: str, i: int) -> str:
    return f"array({', '.join(repr(e[i]) if isinstance(e[i], str) else str(e[i]) for e in ENCODINGS)})[{column}]"


def _mapped(array: str, carried: str, **added: str) -> str:
    """SQL for an array of structs ``c``: the ``carried`` fields and those ``added``."""
    fields = [f"c.{name} as {name}" for name in carried.split()] + [f"{sql} as {name}" for name, sql in added.items()]
    return f"transform({array}, c -> struct({', '.join(fields)}))"


def _tested(candidates: str) -> str:
    """SQL for the candidates with encoding, length and the results of the tests."""
    number = " ".join(f"when c.match rlike '^{e[1]}$' then {i}" for i, e in enumerate(ENCODINGS))
    step = _mapped(candidates, "start end match", n="char_length(c.match)", enc=f"case {number} end")
    step = _mapped(step, "start end match n enc", symbols=_pick("c.enc", 2), excess=f"cast({_pick('c.enc', 3)} as double)")
    half = "char_length(c.symbols) div 2"
    step = _mapped(
        step,
        "start end n enc excess",
        k="cast(char_length(c.symbols) as double)",
        squares="aggregate(array_distinct(split(c.match, '')), 0D, (s, x) -> s + power(c.n - char_length(replace(c.match, x, '')), 2))",
        bits=f"translate(c.match, c.symbols, concat(repeat('0', {half}), repeat('1', char_length(c.symbols) - {half})))",
        v="transform(split(c.match, ''), x -> cast(locate(x, c.symbols) as double))",
    )
    step = _mapped(
        step,
        "start end n enc excess k v",
        chi="c.squares * c.k / c.n - c.n",
        ones="cast(char_length(replace(c.bits, '0', '')) as double)",
        runs="1D + (2 * c.n - char_length(replace(c.bits, '01', '')) - char_length(replace(c.bits, '10', ''))) / 2",
        mean="aggregate(c.v, 0D, (s, x) -> s + x) / c.n",
    )
    step = _mapped(
        step,
        "start end n enc excess k chi runs",
        pairs="2 * c.ones * (c.n - c.ones)",
        spread="aggregate(c.v, 0D, (s, x) -> s + (x - c.mean) * (x - c.mean))",
        lagged="aggregate(zip_with(slice(c.v, 1, c.n - 1), slice(c.v, 2, c.n - 1), (a, b) -> (a - c.mean) * (b - c.mean)), 0D, (s, x) -> s + x)",
    )
    return _mapped(
        step,
        "start end n enc",
        z_chi="(c.chi - (c.k - 1)) / sqrt(2 * (c.k - 1) * (1 - 1 / c.n))",
        z_runs="if(c.pairs <= c.n, 99D, (c.runs - c.pairs / c.n - 1) / sqrt(c.pairs * (c.pairs - c.n) / (c.n * c.n * (c.n - 1D))))",
        z_serial="if(c.spread = 0, 99D, (c.lagged / c.spread + 1D / c.n) * sqrt(c.n))",
        z_text="(c.chi - (c.k - 1) - c.n * c.excess) / sqrt(2 * (c.k - 1 + 2 * c.n * c.excess))",
    )


def with_evidence(docs: DataFrame, text: str = "text", alpha: float = 0.003) -> DataFrame:
    """``docs`` with base spans and tested candidates (columns ``_base``, ``_tested``)."""
    t = f"coalesce(`{text}`, '')"
    kinds = (
        (0, ASSIGN, "char_length(m.g) >= 6"),
        (1, ACCESS, "m.m is not null"),
        (2, HEX, "m.m is not null"),
    )
    base = ", ".join(
        f"transform({_spans(t, p, ok)}, s -> struct(s.start as start, {k} as kind, s.end as end))" for k, p, ok in kinds
    )
    names = [c for c in docs.columns if c.lower() not in ("_base", "_tested", "_found")]
    found = docs.select(
        *names,
        F.expr(f"sort_array(concat({base}))").alias("_base"),
        F.expr(_spans(t, CANDIDATE, "m.m is not null")).alias("_found"),
    )
    free = found.withColumn("_found", F.expr("filter(_found, c -> not exists(_base, b -> b.start < c.end and c.start < b.end))"))
    cut = abs_z(alpha / 3)
    p = _normal_tail("c.z_text")
    judged = _mapped(
        _tested("_found"),
        "start end enc",
        size="cast(floor(log2(c.n)) as int)",
        random=f"c.z_chi < {cut[0]} and abs(c.z_runs) < {cut[1]} and abs(c.z_serial) < {cut[1]}",
        bin=f"cast(least(floor(-log10(greatest({p}, 1e-30)) * {BINS}), {LAST_BIN}) as int)",
    )
    return free.withColumn("_tested", F.expr(judged)).drop("_found")


def abs_z(level: float) -> tuple[float, float]:
    """Normal quantiles of a one-sided and a two-sided test at ``level``."""
    return NormalDist().inv_cdf(1 - level), NormalDist().inv_cdf(1 - level / 2)


def thresholds(evidence: DataFrame, rate: float = 0.05) -> dict[tuple[int, int], int]:
    """Smallest bin that may be rejected, per encoding and class of length.

    Step-up rule: with m tests, p-values up to P are rejected for the largest P with
    ``P * m <= rate * (number of p-values up to P)``.
    """
    one = evidence.select(F.explode("_tested").alias("c")).groupBy("c.enc", "c.size", "c.bin").agg(F.count("*").alias("n"))
    stratum = Window.partitionBy("enc", "size")  # at most 401 bins
    seen = one.withColumn("m", F.sum("n").over(stratum)).withColumn("below", F.sum("n").over(stratum.orderBy(F.desc("bin"))))
    fits = seen.where(F.pow(F.lit(10.0), -F.col("bin") / BINS) * F.col("m") <= rate * F.col("below"))
    return {(r.enc, r.size): r.bin for r in fits.groupBy("enc", "size").agg(F.min("bin").alias("bin")).collect()}


def with_spans(evidence: DataFrame, least: dict[tuple[int, int], int]) -> DataFrame:
    """``base`` and ``spans``: sorted arrays of (start, kind, end), kinds by number in ``KINDS``."""
    if least:
        cases = " ".join(f"when c.enc = {e} and c.size = {s} then c.bin >= {b}" for (e, s), b in sorted(least.items()))
        random = f"filter(_tested, c -> c.random and case {cases} else false end)"
        added = F.expr(f"sort_array(concat(_base, transform({random}, c -> struct(c.start as start, 3 as kind, c.end as end))))")
    else:
        added = F.col("_base")
    names = [c for c in evidence.columns if c.lower() not in ("base", "spans", "_base", "_tested")]
    return evidence.select(*names, F.col("_base").alias("base"), added.alias("spans"))


def find_secrets(docs: DataFrame, text: str = "text", rate: float = 0.05) -> DataFrame:
    """``docs`` with ``base`` and ``spans``; texts are scanned twice."""
    evidence = with_evidence(docs, text)
    return with_spans(evidence, thresholds(evidence, rate))


def listed(spans: str) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    kinds = f"array({', '.join(repr(k) for k in KINDS)})"
    return F.expr(f"array_join(transform({spans}, s -> concat_ws(':', {kinds}[s.kind], s.start, s.end)), ',')")


def redacted(text: str, spans: str, mark: str = "[SECRET]") -> Column:
    """The text with every span, or run of overlapping spans, replaced."""
    return F.expr(
        f"if(size({spans}) = 0, `{text}`, aggregate({spans}, named_struct('at', 0, 'out', ''), "
        f"(acc, s) -> named_struct('at', greatest(acc.at, s.end), 'out', "
        f"if(s.start >= acc.at, concat(acc.out, substring(`{text}`, acc.at + 1, s.start - acc.at), '{mark}'), acc.out)), "
        f"acc -> concat(acc.out, substring(`{text}`, acc.at + 1))))"
    )
