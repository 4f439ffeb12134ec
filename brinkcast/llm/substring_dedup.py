"""Removal of word runs that already stand earlier in the corpus.

A window is ``k`` consecutive words of one document.  Every word covered by a
window whose words also start earlier (a smaller id, or the same document and an
earlier start) is removed.  Windows are judged on the input.

1. A count-min sketch, made in parts and merged, overestimates how often each
   window occurs.  Windows estimated once are surely unique.
2. The others are grouped exactly by a 96-bit hash.  They travel as arrays, one
   row for each section of texts and range of hashes.  A section first settles
   what repeats within itself, so a run shared by a third of all documents sends
   one window a section, not one a document.
   A row names only the documents whose windows it holds.
3. What stood earlier meets by range of documents, where each document that loses
   something gets one row with all its starts; texts are cut where they meet it.

The sketch is bounded by ``most_bits``; a larger input sends more windows to the
second step, with the same result.  Null texts have no words; words are split at
ASCII white space.  Every row is a document of its own: rows that share an id come
in the order in which they are stored, and so do rows without id, after all
others.  Those rows are stored with a number (``sub``), which is 0 for all others.
Further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinkcast.llm.hashing import BASES, WordHashes, run_hashes
from brinkcast.llm.sketch import merged_sketch, sketch_bits
from brinkcast.llm.storage import broadcast_if_small, stored

#: Words of a section.
WORDS = 1_000_000
#: Bytes of text for each range of hashes, and for each range of documents.
PART_BYTES, GROUP_BYTES = 6_000_000, 4_000_000
LAST = np.iinfo(np.int64).max
#: Least ``sub`` of a row without id.
NO_ID = 1 << 62

WINDOWS = "part int, ids binary, subs binary, h1 binary, h2 binary, doc binary, start binary"
FOUND = "grp long, docs binary, marked binary, starts binary"
MARKS = "doc_id long, sub long, starts binary"
KEPT = "doc_id long, n_words long, n_removed long, kept string"


def _sections(batches, words_at_once: int = WORDS):
    """(ids and subs, word hashes, words of each document) of consecutive rows; a
    longer text is a section of its own."""
    hashes = WordHashes()
    for batch in batches:
        ids, held, n = [], [], 0
        for *doc, text in zip(*[c.to_pylist() for c in batch.columns]):
            w = hashes.of((text or b"").split())
            if held and n + len(w) > words_at_once:
                yield np.array(ids, np.int64).T, np.concatenate(held), np.array([len(x) for x in held])
                ids, held, n = [], [], 0
            ids.append(doc)
            held.append(w)
            n += len(w)
        if held:
            yield np.array(ids, np.int64).T, np.concatenate(held), np.array([len(x) for x in held])


def _places(sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each window: place in the section, number of the document, start in it."""
    windows = np.maximum(sizes - k + 1, 0)
    doc = np.repeat(np.arange(len(sizes)), windows)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    return np.repeat(np.cumsum(sizes) - sizes, windows) + start, doc, start


def _openings(*sorted_keys: np.ndarray) -> np.ndarray:
    """Which rows of sorted arrays differ from the row before."""
    new = np.ones(len(sorted_keys[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in sorted_keys])
    return new


def _narrow(a: np.ndarray) -> bytes:
    wide = len(a) and int(a.max()) > 65535
    return (b"4" if wide else b"2") + a.astype("<u4" if wide else "<u2").tobytes()


def _widened(blob: bytes) -> np.ndarray:
    return np.frombuffer(blob, "<u4" if blob[:1] == b"4" else "<u2", offset=1).astype(np.int64)


def _rising(a: np.ndarray) -> bytes:
    """Sorted hashes as differences, in six bytes each where they fit."""
    gaps = np.diff(a, prepend=np.uint64(0))
    gaps[:1] = 0
    head = int(a[0]).to_bytes(8, "little")
    if int(gaps.max()) >> 48:
        return b"8" + head + gaps.astype("<u8").tobytes()
    return b"6" + head + gaps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _risen(blob: bytes) -> np.ndarray:
    width = int(blob[:1])
    gaps = np.zeros(((len(blob) - 9) // width, 8), np.uint8)
    gaps[:, :width] = np.frombuffer(blob, np.uint8, offset=9).reshape(-1, width)
    return np.cumsum(gaps.view("<u8")[:, 0], dtype=np.uint64) + np.uint64(int.from_bytes(blob[1:9], "little"))


def _deltas(a: np.ndarray) -> bytes:
    """The first value, then differences in as few bytes as they fit."""
    gaps = np.diff(a)
    width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(gaps) or max(int(gaps.max()), -int(gaps.min())) < 1 << (8 * w - 1))
    return b"%d" % width + a[:1].astype("<i8").tobytes() + gaps.astype(f"<i{width}").tobytes()


def _summed(blob: bytes) -> np.ndarray:
    gaps = np.frombuffer(blob, f"<i{int(blob[:1])}", offset=9)
    return np.cumsum(np.concatenate([np.frombuffer(blob, "<i8", 1, 1), gaps.astype(np.int64)]))


def _found(docs: np.ndarray, subs: np.ndarray, starts: np.ndarray, groups: int) -> pa.RecordBatch:
    """Windows to remove, one row for each range of documents."""
    grp = (docs % groups + subs % groups) % groups
    order = np.lexsort((starts, subs, docs, grp))
    grp, docs, subs, starts = grp[order], docs[order], subs[order], starts[order]
    at = np.append(np.flatnonzero(_openings(grp)), len(grp))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(grp[at[:-1]], pa.int64()),
            pa.array([_deltas(docs[a:b]) for a, b in zip(at, at[1:])], pa.binary()),
            pa.array([_deltas(subs[a:b]) for a, b in zip(at, at[1:])], pa.binary()),
            # differences of neighbouring windows are mostly 1, which compresses well
            pa.array([np.diff(starts[a:b], prepend=0).astype("<i4").tobytes() for a, b in zip(at, at[1:])], pa.binary()),
        ],
        ["grp", "docs", "marked", "starts"],
    )


def _flagged(rows: DataFrame, sketch, k: int, parts: int, groups: int) -> DataFrame:
    """Windows to group (``WINDOWS``), and those settled within a section (``FOUND``)."""

    def scan(batches):
        for (ids, subs), words, sizes in _sections(batches):
            place, doc, start = _places(sizes, k)
            if not len(place):
                continue
            h1 = run_hashes(words, k)[place]
            flagged = np.flatnonzero(sketch.repeated(h1))
            h1, place, doc, start = h1[flagged], place[flagged], doc[flagged], start[flagged]
            h2 = (run_hashes(words, k, BASES[1], place) >> np.uint64(32)).astype("<u4")
            order = np.lexsort((start, subs[doc], ids[doc], h2, h1))
            h1, h2, doc, start = h1[order], h2[order], doc[order], start[order]
            new = _openings(h1, h2)
            if not new.all():
                batch = _found(ids[doc[~new]], subs[doc[~new]], start[~new], groups)
                yield _widen(batch, None, parts)
            h1, h2, doc, start = h1[new], h2[new], doc[new], start[new]
            part = ((h1 >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
            at = np.append(np.flatnonzero(_openings(part)), len(part))
            pieces = list(zip(at, at[1:]))
            held = [np.unique(doc[a:b], return_inverse=True) for a, b in pieces]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array(part[at[:-1]], pa.int32()),
                    pa.array([_deltas(ids[d]) for d, _ in held], pa.binary()),
                    pa.array([_deltas(subs[d]) if subs[d].any() else b"" for d, _ in held], pa.binary()),
                    pa.array([_rising(h1[a:b]) for a, b in pieces], pa.binary()),
                    pa.array([h2[a:b].tobytes() for a, b in pieces], pa.binary()),
                    pa.array([_narrow(i) for _, i in held], pa.binary()),
                    pa.array([_narrow(start[a:b]) for a, b in pieces], pa.binary()),
                ],
                ["part", "ids", "subs", "h1", "h2", "doc", "start"],
            )
            yield _widen(None, batch, parts)

    return rows.mapInArrow(scan, f"{WINDOWS}, {FOUND}")


def _widen(found: pa.RecordBatch | None, windows: pa.RecordBatch | None, parts: int) -> pa.RecordBatch:
    """Rows of either kind; what is found goes through the grouping as it is."""
    n = (found or windows).num_rows
    left = windows.columns if windows else [pa.array(np.arange(n) % parts, pa.int32())] + [pa.nulls(n, pa.binary())] * 6
    right = found.columns if found else [pa.nulls(n, pa.int64())] + [pa.nulls(n, pa.binary())] * 3
    return pa.RecordBatch.from_arrays(
        [*left, *right], ["part", "ids", "subs", "h1", "h2", "doc", "start", "grp", "docs", "marked", "starts"]
    )


def _grouped(windows: DataFrame, parts: int, groups: int) -> DataFrame:
    """Exact grouping of the windows of each range of hashes."""

    def settle(rows):
        passed = [r for r in rows if r[1] is None]
        if passed:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(list(zip(*passed))[7:], (pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                ["grp", "docs", "marked", "starts"],
            )
        rows = [r for r in rows if r[1] is not None]
        if not rows:
            return
        h1 = np.concatenate([_risen(r[3]) for r in rows])
        h2 = np.concatenate([np.frombuffer(r[4], "<u4") for r in rows])
        at = [_widened(r[5]) for r in rows]
        doc = np.concatenate([_summed(r[1])[i] for r, i in zip(rows, at)])
        sub = np.concatenate([_summed(r[2])[i] if r[2] else np.zeros(len(i), np.int64) for r, i in zip(rows, at)])
        start = np.concatenate([_widened(r[6]) for r in rows])
        order = np.lexsort((start, sub, doc, h2, h1))
        later = ~_openings(h1[order], h2[order])
        if later.any():
            order = order[later]
            yield _found(doc[order], sub[order], start[order], groups)

    def merge(batches):
        held: list = []
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                if held and row[0] != held[0][0]:
                    yield from settle(held)
                    held = []
                held.append(row)
        if held:
            yield from settle(held)

    return (
        windows.select("part", "ids", "subs", "h1", "h2", "doc", "start", "grp", "docs", "marked", "starts")
        .repartition(parts, "part")
        .sortWithinPartitions("part")
        .mapInArrow(merge, FOUND)
    )


def _numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, sub, text), where doc_id and sub name one row only."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    counted = rows.groupBy("doc_id").agg(F.count("*").alias("n"))
    shared = stored(counted.where("n > 1 or doc_id is null").select("doc_id"), "shared")
    alone = F.lit(0).cast("long").alias("sub")
    if not shared.limit(1).count():
        return rows.select("doc_id", alone, "text")
    ids = broadcast_if_small(shared.where("doc_id is not null"))
    odd = rows.where("doc_id is null").union(rows.join(ids, "doc_id", "left_semi").select("doc_id", "text"))
    number = F.monotonically_increasing_id() + 1
    odd = stored(
        odd.select(
            F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"),
            F.when(F.col("doc_id").isNull(), number + F.lit(NO_ID)).otherwise(number).alias("sub"),
            "text",
        ),
        "numbered",
    )
    plain = rows.where("doc_id is not null").join(ids, "doc_id", "left_anti")
    return plain.select("doc_id", alone, "text").union(odd)


def _id_of(doc: int, sub: int) -> int | None:
    return None if sub >= NO_ID else doc


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 20, most_bits: int = 28, depth: int = 2,
    most_touched: int = 500_000,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every row; ``kept`` holds the words
    that stay, joined by one space."""
    rows = _numbered(docs, doc_id, text)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts, groups = max(1, size // PART_BYTES), max(1, size // GROUP_BYTES)

    def windows(batches):
        for _, words, sizes in _sections(batches, 2 * WORDS):
            place, _, _ = _places(sizes, k)
            if len(place):
                yield run_hashes(words, k)[place]

    sketch = merged_sketch(rows, windows, sketch_bits(size / 6, 4, most_bits), depth)
    found = _grouped(_flagged(rows, sketch, k, parts, groups), parts, groups)
    by_range = found.repartition(max(1, groups // 2), "grp").sortWithinPartitions("grp")
    marks = stored(by_range.mapInArrow(_marks, MARKS), "marks")
    sketch.drop()
    # texts that lose nothing stay where they are, if the list of the others is short
    if marks.limit(most_touched + 1).count() > most_touched:
        return rows.join(marks, ["doc_id", "sub"], "left").select("doc_id", "sub", "text", "starts").mapInArrow(_cut(k), KEPT)
    touched = F.broadcast(marks.select("doc_id", "sub"))
    whole = rows.join(touched, ["doc_id", "sub"], "left_anti").select("doc_id", "sub", "text", F.lit(None).cast("binary").alias("starts"))
    less = rows.join(touched, ["doc_id", "sub"], "left_semi").join(marks, ["doc_id", "sub"]).select("doc_id", "sub", "text", "starts")
    return less.mapInArrow(_cut(k), KEPT).union(whole.mapInArrow(_cut(k), KEPT))


def _marks(batches):
    """Starts of windows to remove, one row for each document that has any."""
    grp, held = None, []
    for batch in batches:
        for g, docs, subs, starts in zip(*[c.to_pylist() for c in batch.columns]):
            if held and g != grp:
                yield _by_document(held)
                held = []
            grp = g
            held.append((_summed(docs), _summed(subs), np.cumsum(np.frombuffer(starts, "<i4"), dtype=np.int64)))
    if held:
        yield _by_document(held)


def _by_document(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    docs, subs, starts = (np.concatenate(c) for c in zip(*held))
    order = np.lexsort((starts, subs, docs))
    docs, subs, starts = docs[order], subs[order], starts[order]
    at = np.append(np.flatnonzero(_openings(docs, subs)), len(docs))
    # differences of neighbouring windows are mostly 1, which compresses well
    blobs = [np.diff(starts[a:b], prepend=0).astype("<i4").tobytes() for a, b in zip(at, at[1:])]
    return pa.RecordBatch.from_arrays([pa.array(docs[at[:-1]]), pa.array(subs[at[:-1]]), pa.array(blobs, pa.binary())], ["doc_id", "sub", "starts"])


def _cut(k: int):
    """Tasks that take the words of marked windows out of texts."""

    def of(batches):
        for batch in batches:
            out = []
            for doc, sub, text, starts in zip(*[c.to_pylist() for c in batch.columns]):
                words = (text or b"").split()
                n = len(words)
                if starts is not None:
                    at = np.cumsum(np.frombuffer(starts, "<i4"), dtype=np.int64)
                    edge = np.bincount(at, minlength=n + 1)[: n + 1] - np.bincount(np.minimum(at + k, n), minlength=n + 1)[: n + 1]
                    gone = np.cumsum(edge)[:n] > 0
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                out.append((_id_of(doc, sub), n, n - len(words), b" ".join(words)))
            ids, total, removed, kept = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(total, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return of
