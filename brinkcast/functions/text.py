"""Text cleaning as JVM-side expressions."""

from __future__ import annotations

from collections.abc import Iterable
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The code points Python's ``str`` treats as white space, the blank
# itself set apart.
_OTHER = r"\x09-\x0d\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WHITESPACE = f"[ {_OTHER}]"
# A run that is not a single blank already, so most of a text is left untouched;
# the look-ahead passes over printable ASCII quickly.
UNEVEN = f"(?![!-~])(?:[{_OTHER}]{WHITESPACE}*| {WHITESPACE}+)"

# Names that pages may also write without a semicolon, longest first.
_BARE = "|".join(sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name)))
# A character reference by number or by name.
REFERENCE = (
    r"&(#[0-9]{1,8}(?![0-9]);?|#[xX][0-9a-fA-F]{1,7}(?![0-9a-fA-F]);?|[A-Za-z][A-Za-z0-9]*;|(?:" + _BARE + "))"
)
# Names that make up most references of pages; they are looked up first.
_COMMON = ("amp", "lt", "gt", "quot", "apos", "nbsp", "copy", "mdash", "ndash", "rsquo", "lsquo", "hellip")
# What numbers 128 to 159 stand for in pages (windows-1252); the
# five that it leaves open stay as they are.
WINDOWS = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"


def _character(code: Column) -> Column:
    """The character with a code point; what cannot be one becomes U+FFFD."""
    unfit = (code == 0) | (code > 0x10FFFF) | code.between(0xD800, 0xDFFF)
    any_code = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    windows = F.substring(F.lit(WINDOWS), (code - 127).cast("int"), F.lit(1))
    return F.when(unfit, "\ufffd").when(code.between(128, 159), windows).otherwise(any_code)


def decode_references(text: Column) -> Column:
    """Character references of HTML, by number or by any of its names, become
    characters; unknown names stay.  Numbers and the names of old need no semicolon:
    the longest such name that a text goes on with counts.  Each reference is read
    once, so ``&amp;lt;`` gives ``&lt;``."""

    def table(listed: Iterable[str]) -> Column:
        entries = "\x02".join(f"{name}\x01{html5[name + ';']}" for name in listed)
        return F.str_to_map(F.lit(entries), F.lit("\x02"), F.lit("\x01"))

    common, names = table(_COMMON), table(name[:-1] for name in html5 if name.endswith(";"))

    def named(name: Column) -> Column:
        return F.coalesce(F.try_element_at(common, name), F.try_element_at(names, name))

    def decoded(ref: Column) -> Column:
        name = F.rtrim(ref, F.lit(";"))
        hexadecimal = F.conv(F.substring(name, 3, 8), 16, 10).cast("long")
        code = F.when(name.rlike("^#[xX]"), hexadecimal).otherwise(F.substring(name, 2, 9).try_cast("long"))
        bare = F.regexp_extract(ref, f"^({_BARE})", 1)  # of a longer, unknown name
        opened = F.when(bare != "", F.concat(named(bare), F.right(ref, F.length(ref) - F.length(bare))))
        return F.when(ref.startswith("#"), _character(code)).otherwise(
            F.coalesce(named(name), opened, F.concat(F.lit("&"), ref))
        )

    pieces = F.zip_with(
        F.split(text, REFERENCE, -1),
        F.regexp_extract_all(text, F.lit(REFERENCE), 1),
        lambda before, ref: F.concat(before, F.when(ref.isNull(), "").otherwise(decoded(ref))),
    )
    return F.when(text.contains("&"), F.array_join(pieces, "")).otherwise(text)


def strip_html(html: Column) -> Column:
    """Text nodes of a page, one per line; script, style and comments are dropped."""
    text = F.coalesce(html, F.lit(""))
    for pattern in (
        r"(?s)<!--.*?-->",
        r"(?is)<script[^>]*>.*?</script\s*>",
        r"(?is)<style[^>]*>.*?</style\s*>",
    ):
        text = F.regexp_replace(text, pattern, "")
    text = F.regexp_replace(text, r"<[^>]*>", "\n")
    return decode_references(text)


def normalize_text(text: Column, is_html: bool = False) -> Column:
    """Runs of Unicode white space become one blank, ends trimmed."""
    if is_html:
        text = strip_html(text)
    return F.trim(F.regexp_replace(text, UNEVEN, " "))


def token_count(clean: Column) -> Column:
    """Number of blank-separated tokens of a normalized text.

    No branches: Spark then evaluates the text once for all three uses.
    """
    blanks = F.length(clean) - F.length(F.replace(clean, F.lit(" "), F.lit("")))
    return (blanks + (clean != "").cast("int")).cast("int")


def excerpt(text: Column, n: int = 4000) -> Column:
    """The leading characters a labeler gets to see."""
    return F.substring(text, 1, n)


def preview_text(text: Column, n: int = 140) -> Column:
    """One line for a report: longer texts end in three dots."""
    flat = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))
    return F.when(F.length(flat) > n, F.concat(F.substring(flat, 1, n - 3), F.lit("..."))).otherwise(flat)


def strip(text: Column) -> Column:
    """Both ends freed of Unicode white space."""
    return F.regexp_replace(text, f"^{WHITESPACE}+|{WHITESPACE}+$", "")


def segments(text: Column, sep: str = "\n\n", max_chars: int = 1200) -> Column:
    """Array of chunks: paragraphs packed greedily up to a character budget.

    The budget counts two characters per join; a paragraph above the budget
    stays whole; blank paragraphs are dropped.
    """
    pieces = F.split(text, _literal_regex(sep), -1)
    paragraphs = F.filter(F.transform(pieces, strip), lambda p: p != "")
    # A lambda's variable holds what would be computed again at each use.  The fold
    # carries numbers only; text is copied once, when its chunk is put together.
    return F.transform(F.array(paragraphs), lambda held: _joined(held, _borders(held, max_chars)))[0]


def _borders(paragraphs: Column, max_chars: int) -> Column:
    """Number (from 1) of the first paragraph of each chunk, then of one past the last."""
    state = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(1).alias("at"), F.lit(0).alias("size"))

    def take(acc: Column, p: Column) -> Column:
        begins = (acc["at"] == 1) | (acc["size"] + F.length(p) > max_chars)
        return F.struct(
            F.when(begins, F.array_append(acc["starts"], acc["at"])).otherwise(acc["starts"]).alias("starts"),
            (acc["at"] + 1).alias("at"),
            F.when(begins & (acc["at"] > 1), F.length(p)).otherwise(acc["size"] + F.length(p) + 2).alias("size"),
        )

    return F.aggregate(paragraphs, state, take, lambda acc: F.array_append(acc["starts"], acc["at"]))


def _joined(paragraphs: Column, borders: Column) -> Column:
    """Paragraphs from each border up to the next, as one text."""

    def chunks(ends: Column) -> Column:
        starts = F.slice(ends, 1, F.size(ends) - 1)
        return F.transform(
            starts, lambda start, i: F.array_join(F.slice(paragraphs, start, F.element_at(ends, i + 2) - start), "\n\n")
        )

    return F.transform(F.array(borders), chunks)[0]


def segment_documents(
    df: DataFrame, key: str, text: str = "text", sep: str = "\n\n", max_chars: int = 1200
) -> DataFrame:
    """One row per chunk: ``key``, ``chunk_no`` (from 0) and ``chunk``."""
    return df.select(
        key, F.posexplode(segments(F.col(text), sep, max_chars)).alias("chunk_no", "chunk")
    )


def ladder_level(text: Column, phrases: dict[int, list[str]]) -> Column:
    """Level of the first rung that matches, read from the highest level down.

    ``phrases`` maps a level to literal lower-case phrases; no match gives 0.
    """
    low = F.lower(text)
    rungs = [F.lit(0)]
    for level in sorted(phrases):
        hit = F.lit(False)
        for phrase in phrases[level]:
            hit = F.contains(low, F.lit(phrase.lower())) | hit
        rungs.append(F.when(hit, level).otherwise(0))
    # The first match from the top is the largest level that matches.  Without
    # branches the text is lowered once.
    return F.greatest(F.lit(0), *rungs).cast("int")


def _share(part: Column, whole: Column) -> Column:
    """Ratio, 0 where there is nothing to divide by; each side evaluated once."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _matched(text: Column, pattern: str) -> Column:
    """Number of characters inside matches of the pattern."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def caps_ratio(text: Column) -> Column:
    """Share of capital letters among all letters; 0 without letters."""
    return _share(_matched(text, r"\p{Lu}+"), _matched(text, r"\p{L}+"))


def punctuation_density(text: Column) -> Column:
    """Exclamation and question marks per character; 0 for an empty text."""
    marks = F.length(text) - F.length(F.translate(text, "!?", ""))
    return _share(marks, F.length(text))


def intensifier_density(clean: Column, words: list[str]) -> Column:
    """Share of tokens of a normalized text that are on the caller's word list."""
    listed = "|".join(_literal_regex(w.lower()) for w in words)
    hits = F.regexp_count(F.lower(clean), F.lit(f"(?<![^ ])(?:{listed})(?![^ ])"))
    return _share(hits, token_count(clean))


def entity_hits(text: Column, aliases: dict[str, list[str]]) -> Column:
    """Sorted canonical names whose alias occurs in the text, each once.

    ``aliases`` is the caller's short dictionary of watched entities.
    """
    low = F.lower(text)
    found = []
    for name in sorted(aliases):
        hit = F.lit(False)
        for alias in aliases[name]:
            hit = hit | F.contains(low, F.lit(alias.lower()))
        found.append(F.when(hit, F.lit(name)))
    return F.array_compact(F.array(*found))


def _literal_regex(sep: str) -> str:
    return "\\Q" + sep.replace("\\E", "\\E\\\\E\\Q") + "\\E"
