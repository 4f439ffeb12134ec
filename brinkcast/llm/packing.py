"""Packing of tokenized documents into sequences by the sum-of-squares rule.

A document is its token ids and an end id.  One longer than a sequence is cut
into pieces of full length, the first of which may be shorter.  Pieces are dealt
evenly over groups of bounded size; in each, the longest first, a piece goes
where the sum over all residual gaps of the squared number of open sequences with
that gap becomes smallest (ties: the smallest gap left, a new sequence last).
What the groups leave at most half full is dealt and packed once more, as units.

Null texts are empty: one end id.  Repeated rows are packed as often as they
occur.  Every piece row keeps its ids; ``pack`` takes any table with a length.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brinkcast.llm.arrow import begin, kept, with_columns_schema
from brinkcast.llm.storage import stored

#: Word pieces a worker remembers, texts it cuts and pieces it looks up at a time.
KEPT_PIECES, TEXTS, LOOKUPS = 600_000, 300, 1_000
#: Pieces that one task packs.
GROUP = 50_000


#: Word pieces of a text of ``PLAIN`` characters, as the tokenizer's own pattern cuts it.
PLAIN = r"[\n\t\r\x20-\x7eÀ-ÖØ-öø-ſ]*"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ſ]+| ?[0-9]+| ?[^\sA-Za-z0-9À-ÖØ-öø-ſ]+|\s+(?!\S)|\s+"
#: Characters of a long text that are cut into pieces at a time.
SLICE = 1_000_000


class PieceIds(dict):
    """Byte-level BPE by word piece: ids (little-endian, 32 bits) of each piece.

    A merge never crosses the border of two pieces, so a text's ids are those of
    its pieces; about ``most`` are remembered.  Texts with other characters than
    ``PLAIN``, or with the name of a special token, go through the tokenizer whole.
    """

    def __init__(self, tokenizer: str, most: int = KEPT_PIECES):
        from tokenizers import Tokenizer

        self.most = most
        self.whole = Tokenizer.from_file(tokenizer)
        self.split = re.compile(PIECES).findall
        self.plain = re.compile(PLAIN).fullmatch
        self.special = tuple(t.content for t in self.whole.get_added_tokens_decoder().values())
        self.rare: dict[str, bytes] = {}  # pieces of the texts at hand that are not kept

    def __missing__(self, piece: str) -> bytes:
        return self.rare[piece]

    def encoded(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _slices(self, text: str):
        """Parts of a long text; a piece never spans the end of a word and a blank."""
        at = 0
        while len(text) - at > SLICE:
            cut = text.find(" ", at + SLICE)
            while cut > 0 and text[cut - 1].isspace():
                cut = text.find(" ", cut + 1)
            if cut < 0:
                break
            yield text[at:cut]
            at = cut
        yield text[at:]

    def _joined(self, texts: list[str]) -> list[bytes]:
        cut = [self.split(t) for t in texts]
        new = list({p for pieces in cut for p in pieces if p not in self})
        ids = []
        for lo in range(0, len(new), LOOKUPS):  # an encoding takes far more memory than its ids
            found = self.whole.encode_batch_fast(new[lo : lo + LOOKUPS], add_special_tokens=False)
            ids += [struct.pack(f"<{len(e)}I", *e.ids) for e in found]
        if len(self) < self.most:
            self.update(zip(new, ids))
        else:
            self.rare = dict(zip(new, ids))
        return [b"".join(map(self.__getitem__, pieces)) for pieces in cut]

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        out: list[bytes | None] = [None] * len(texts)
        short = []
        for i, text in enumerate(texts):
            if not self.plain(text) or any(s in text for s in self.special):
                out[i] = self.encoded(text)
            elif len(text) > SLICE:
                out[i] = b"".join(self._joined([part])[0] for part in self._slices(text))
            else:
                short.append(i)
        for i, ids in zip(short, self._joined([texts[i] for i in short])):
            out[i] = ids
        return out


def piece_ids(tokenizer: str, most: int) -> PieceIds:
    """The ids of a tokenizer file, kept by a worker process until it serves another operator."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    return kept("packing", f"{most} {tokenizer}", lambda: PieceIds(tokenizer, most))


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    length: int = 2048,
    end_id: int = 0,
    most: int = KEPT_PIECES,
) -> DataFrame:
    """(doc_id, piece, start, length, ids) of all documents; ``tokenizer`` is a file
    that every executor has.  ``most`` word pieces (some 250 bytes each) are remembered by
    a worker; fewer cost time, not results."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        begin("packing")
        encode = piece_ids(tokenizer, most)
        for batch in batches:
            for lo in range(0, batch.num_rows, TEXTS):
                docs_, texts = (c.to_pylist() for c in batch.slice(lo, TEXTS).columns)
                out = []
                for doc, ids in zip(docs_, encode.of([t or "" for t in texts])):
                    ids += end
                    n = len(ids) // 4
                    first = n % length or length if n > length else n
                    edges = [0, *range(first, n + 1, length)]
                    out += [(doc, i, a, b - a, ids[4 * a : 4 * b]) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(c, t)
                        for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()))
                    ],
                    ["doc_id", "piece", "start", "length", "ids"],
                )

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def sum_of_squares(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, placed in the order given."""
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]  # open bins by gap
    count = np.zeros(capacity + 1, np.int64)
    bins, offsets, used = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), 0
    for i, size in enumerate(sizes.tolist()):
        # moving a bin from gap g to g - size changes the sum by 2 (N(g - size) - N(g)) + 2; gap 0 counts nothing
        change = 2 * (count[: capacity + 1 - size] - count[size:]) + 2
        change[0] -= 2 * count[0] + 1
        gap = -1
        holds = np.flatnonzero(count[size:])
        if len(holds):
            best = holds[np.argmin(change[holds])]
            rest = capacity - size
            if change[best] <= (2 * count[rest] + 1 if rest else 0):
                gap = int(best) + size
        if gap < 0:
            chosen, gap, used = used, capacity, used + 1
        else:
            chosen = waiting[gap].pop()
            count[gap] -= 1
        bins[i], offsets[i] = chosen, capacity - gap
        if gap > size:
            waiting[gap - size].append(chosen)
            count[gap - size] += 1
    return bins, offsets


def _packed_groups(units: DataFrame, capacity: int, group: int) -> DataFrame:
    """``units`` (a stored table with ``length``) with ``sequence_id`` and ``offset``."""
    n = units.count()
    groups = max(1, -(-n // group))
    kept, schema = with_columns_schema(units, {"sequence_id": T.LongType(), "offset": T.LongType()})
    at = kept.columns.index("length")

    def place(key, table):
        table = table.drop_columns(["_group"])
        sizes = table.column(at).to_numpy()
        order = np.argsort(-sizes, kind="stable")
        bins, offsets = sum_of_squares(sizes[order], capacity)
        table = table.take(pa.array(order)).append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins, pa.int64()))
        return table.append_column("offset", pa.array(offsets, pa.int64()))

    dealt = kept.withColumn("_group", F.monotonically_increasing_id() % groups)
    return dealt.groupBy("_group").applyInArrow(place, schema)


def pack(pieces: DataFrame, capacity: int = 2048, group: int = GROUP, aside: tuple[str, ...] = ()) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    The input is written once, so that dealing by row number is repeatable.  A
    length above the capacity is an error; lengths are at least 1.  Wide columns named
    ``aside`` do not go through the packing; they meet their places by a row number.
    """
    if aside:
        units = stored(pieces.withColumn("_unit", F.monotonically_increasing_id()), "pieces")
        placed = pack(units.drop(*aside), capacity, group)
        return units.select("_unit", *aside).join(placed, "_unit").select(*pieces.columns, "sequence_id", "offset")
    units = stored(pieces, "pieces")
    placed = stored(_packed_groups(units, capacity, group), "placed")
    filled = placed.groupBy("sequence_id").agg(F.sum("length").alias("length")).where(F.col("length") <= capacity // 2)
    halves = stored(filled.select(F.col("sequence_id").alias("_from"), "length"), "halves")
    again = _packed_groups(halves, capacity, group).select(
        "_from", (-1 - F.col("sequence_id")).alias("_to"), F.col("offset").alias("_by")
    )
    return (
        placed.join(again, placed.sequence_id == again._from, "left")
        .withColumn("sequence_id", F.coalesce("_to", "sequence_id"))
        .withColumn("offset", F.col("offset") + F.coalesce("_by", F.lit(0)))
        .drop("_from", "_to", "_by")
    )


def pack_documents(docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0) -> DataFrame:
    """Token pieces of ``docs`` with their ids and places."""
    return pack(token_pieces(docs, tokenizer, length=length, end_id=end_id), length, aside=("ids",))
