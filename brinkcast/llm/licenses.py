"""Licence notices in texts, by a positional index of rare words.

Words are runs of letters and digits, A-Z lower-cased.  A template is a run of words
with a label, a share of its words that must stand in place, and key phrases that must
all occur.  Base templates are phrases that must occur whole.

How rare a licence word is, is counted over all documents.  A notice that keeps the
share ``s`` of a template's ``m`` words keeps at least one of any ``m - ceil(s * m) + 1``
of its positions, so only the template's positions of highest IDF, that many, are
indexed: word to (template, position).  Every indexed word of a text, with its
position, names an offset at which the template may begin; the other words of the
template are then compared at that offset, and each key phrase is looked for whole in
the place it has in the template.  Nothing that brute force over all offsets would
accept is lost.

The score of a text is the largest share of words in place among accepted notices
(1 for a base phrase), 0 without one.  Null texts are empty.  Rows are judged one by one;
columns of the input are not changed, those named as added ones are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brinkcast.llm.arrow import chunks, with_columns_schema

#: Bytes of text that are cut into words at a time.
BYTES = 8_000_000

# Words of public licence notices, with key phrases between brackets.
BASE = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)
NOTICES = (
    ("agpl-3", "licensed under the [gnu affero general public license] version [3]"),
    ("apache-2", "licensed under the [apache license] version [2 0] the license you may not use this file except in compliance with the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following [conditions are met]"),
    ("bsd-2", "licensed under the [bsd 2 clause] license"),
    ("bsd-3", "licensed under the [bsd 3 clause] license"),
    ("bsd-3", "neither the name of the copyright holder nor the names of its contributors may be used to [endorse or promote products]"),
    ("cc-by", "licensed under a [creative commons attribution] 4 0 international license"),
    ("cc-by-nc", "licensed under a [creative commons attribution noncommercial] 4 0 international license"),
    ("cc-by-sa", "licensed under a [creative commons attribution sharealike] 4 0 international license"),
    ("cc0", "to the extent possible under law the author has [waived all copyright] and related or neighboring rights to this work"),
    ("gpl-2", "licensed under the [gnu general public license] version [2]"),
    ("gpl-3", "licensed under the [gnu general public license] version [3]"),
    ("gpl", "it under the terms of the [gnu general public license] as published by the [free software foundation]"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose [with or without fee] is hereby granted"),
    ("lgpl", "it under the terms of the [gnu lesser general public license] as published by the [free software foundation]"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mpl-2", "this source code form is subject to the terms of the [mozilla public license] v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the [public domain]"),
)

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


@dataclass(frozen=True)
class Template:
    """Words of a notice; ``phrases`` are (start, end) of the key phrases in it."""

    label: str
    words: tuple[bytes, ...]
    phrases: tuple[tuple[int, int], ...]
    share: float
    base: bool = False

    @property
    def needed(self) -> int:
        """Words that must stand in place."""
        return max(1, math.ceil(self.share * len(self.words) - 1e-9))


def template(label: str, notice: str, share: float, base: bool = False) -> Template:
    """A template of a notice whose key phrases stand between brackets."""
    words, phrases, start = [], [], 0
    for word in notice.split():
        if word.startswith("["):
            start = len(words)
        words.append(word.strip("[]").encode())
        if word.endswith("]"):
            phrases.append((start, len(words)))
    return Template(label, tuple(words), tuple(phrases), share, base)


def templates(base=BASE, notices=NOTICES, share: float = 0.8) -> list[Template]:
    return [template(label, text, 1.0, True) for label, text in base] + [template(label, text, share) for label, text in notices]


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def _numbered(batch_texts: list[str | None], number: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all texts' words (-1: no licence word), and where each text begins."""
    found = []
    for text in batch_texts:
        words = words_of(text or "")
        found.append(np.fromiter(map(number.get, words, repeat(-1)), np.int32, len(words)))
    return np.concatenate([np.empty(0, np.int32), *found]), np.cumsum([0, *map(len, found)])


def _pieces(batch: pa.RecordBatch, column: int):
    texts = batch.column(column)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    for a, b in chunks(batch, sizes, BYTES):
        yield a, b, texts.slice(a, b - a).to_pylist()


def document_frequencies(docs: DataFrame, vocabulary: list[bytes], text: str = "text") -> np.ndarray:
    """In how many rows each word of ``vocabulary`` occurs; one number for each comes to the driver."""

    def of(batches):
        number, n = {w: i for i, w in enumerate(vocabulary)}, len(vocabulary)
        df = np.zeros(n, np.int64)
        for batch in batches:
            for a, b, texts in _pieces(batch, 0):
                words, begin = _numbered(texts, number)
                owner = np.repeat(np.arange(b - a), np.diff(begin))[words >= 0]
                df += np.bincount(np.unique(owner * n + words[words >= 0]) % n, minlength=n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n), pa.int32()), pa.array(df)], ["word", "df"])

    df = np.zeros(len(vocabulary), np.int64)
    counted = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(of, "word int, df long")
    for r in counted.groupBy("word").agg(F.sum("df").alias("df")).collect():
        df[r.word] = r.df
    return df


class RareIndex:
    """Postings (template, position) of the rarest words of each template."""

    def __init__(self, known: list[Template], vocabulary: list[bytes], df: np.ndarray):
        number = {w: i for i, w in enumerate(vocabulary)}
        self.known = known
        self.words = [np.array([number[w] for w in t.words], np.int32) for t in known]
        self.postings: dict[int, list[tuple[int, int]]] = {}
        for i, (t, words) in enumerate(zip(known, self.words)):
            rarest = np.lexsort((np.arange(len(words)), words, df[words]))[: len(words) - t.needed + 1]
            for at in rarest:
                self.postings.setdefault(int(words[at]), []).append((i, int(at)))
        self.indexed = np.zeros(len(vocabulary) + 1, bool)  # the last stands for all other words
        self.indexed[list(self.postings)] = True

    def notices(self, words: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
        """Accepted notices: arrays of text number, template, offset in ``words``, words in place."""
        hits = np.flatnonzero(self.indexed[words])
        hits = hits[np.argsort(words[hits], kind="stable")]
        text = np.searchsorted(begin, hits, "right") - 1
        cut = np.flatnonzero(np.diff(words[hits], prepend=-2))
        begins: list[list[np.ndarray]] = [[] for _ in self.known]
        for a, b in zip(cut, [*cut[1:], len(hits)]):
            for t, at in self.postings[int(words[hits[a]])]:
                begins[t].append(np.stack([text[a:b], hits[a:b] - at]))
        out = [(np.empty(0, np.int64),) * 4]
        for t, found in enumerate(begins):
            if found:
                text, start = np.unique(np.concatenate(found, axis=1), axis=1)
                out.append(self._accepted(t, start, text, words, begin))
        return tuple(np.concatenate(c) for c in zip(*out))

    def _accepted(self, t: int, start: np.ndarray, text: np.ndarray, words: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, ...]:
        """Notices of template ``t`` at offsets ``start``, read within ``text`` only."""
        mine = self.words[t]
        place = start[:, None] + np.arange(len(mine))
        inside = (place >= begin[text][:, None]) & (place < begin[text + 1][:, None])
        same = inside & (words[np.clip(place, 0, len(words) - 1)] == mine)
        kept = same.sum(axis=1)
        good = kept >= self.known[t].needed
        for a, b in self.known[t].phrases:
            good &= same[:, a:b].all(axis=1)
        return text[good], np.full(good.sum(), t, np.int64), start[good], kept[good]


ADDED = {
    "n_words": T.LongType(),
    "n_base": T.LongType(),
    "first_word": T.LongType(),
    "last_word": T.LongType(),
    "base_labels": T.StringType(),
    "labels": T.StringType(),
    "score": T.DoubleType(),
    "notices": T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("word", T.LongType()), T.StructField("share", T.DoubleType())])),
}


def _judged(index: RareIndex, vocabulary: list[bytes], column: int):
    def of(batches):
        number = {w: i for i, w in enumerate(vocabulary)}
        for batch in batches:
            for a, b, texts in _pieces(batch, column):
                words, begin = _numbered(texts, number)
                found: list[list[tuple[bool, str, int, float]]] = [[] for _ in range(b - a)]
                for text, t, at, kept in zip(*(c.tolist() for c in index.notices(words, begin))):
                    known = index.known[t]
                    found[text].append((known.base, known.label, at - int(begin[text]), kept / len(known.words)))
                rows = []
                for text, notices in enumerate(found):
                    starts = sorted(at for base, _, at, _ in notices if base)
                    rows.append(
                        {
                            "n_words": int(begin[text + 1] - begin[text]),
                            "n_base": len(starts),
                            "first_word": starts[0] if starts else None,
                            "last_word": starts[-1] if starts else None,
                            "base_labels": ",".join(sorted({label for base, label, _, _ in notices if base})),
                            "labels": ",".join(sorted({label for _, label, _, _ in notices})),
                            "score": max((share for *_, share in notices), default=0.0),
                            "notices": [{"label": label, "word": at, "share": share} for at, label, share in sorted((at, label, share) for _, label, at, share in notices)],
                        }
                    )
                part = batch.slice(a, b - a)
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
                types.append(pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("share", pa.float64())])))
                added = [pa.array([r[name] for r in rows], kind) for name, kind in zip(ADDED, types)]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], [*part.schema.names, *ADDED])

    return of


def scan_licenses(docs: DataFrame, known: list[Template] | None = None, text: str = "text") -> DataFrame:
    """``docs`` with word count, base phrases (number, first, last, labels), all labels,
    score, and ``notices``: label, first word (negative where a notice lacks its beginning at the start of a text), share in place."""
    known = templates() if known is None else known
    vocabulary = sorted({w for t in known for w in t.words})
    index = RareIndex(known, vocabulary, document_frequencies(docs, vocabulary, text))
    kept, schema = with_columns_schema(docs, ADDED)
    return kept.mapInArrow(_judged(index, vocabulary, kept.columns.index(text)), schema)
