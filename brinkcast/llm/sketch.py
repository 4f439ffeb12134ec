"""Count-min sketch whose partition parts are merged by cell range.

A task counts its hashes in cells and sends, per range of cells, the cells it
hit as often as matters.  Tasks that own a range add up what arrives, batch by
batch, in one array of fixed size.  The merged sketch holds one bit a cell ("hit
at least twice") or, where counts are asked for, one byte a cell (up to 255).
Its size is bounded by ``bits`` and ``depth`` whatever the input, so it can be
broadcast; a crowded sketch only overestimates, so nothing repeated is lost.
It is stored by ranges, of which the driver fetches a few at a time; it goes from
driver and executors as soon as its reader says so.

A table above ``whole`` bytes is broadcast in pieces of a quarter of that, of which the
driver and each task hold one at a time: a task looks up many hashes at once
(``at_once``), piece by piece, as each is read from the executor's disk anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brinkcast.llm.storage import stored

#: Odd multipliers, one for each row of the sketch.
ROWS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
#: log2 of the ranges, at least, and of the cells of a range, at most.
RANGE_BITS, INSIDE_BITS = 8, 22
MOST = 255
#: Hashes to look up at a time, in a table of one piece and in one of several.
AT_ONCE = (1 << 18, 1 << 20)
#: Mean difference from which two bytes each are shorter than a byte and a half.
FAR_APART = 2000


def sketch_bits(hashes: float, per_hash: float, most: int) -> int:
    """log2 of the cells of a row: ``per_hash`` cells for each hash, within bounds."""
    return int(min(most, max(16, np.ceil(np.log2(max(1.0, hashes * per_hash))))))


def cells_of(h: np.ndarray, bits: int, row: int) -> np.ndarray:
    cells = h * np.uint64(ROWS[row])
    cells >>= np.uint64(64 - bits)
    return cells


def _packed(cells: np.ndarray) -> bytes:
    """Sorted cells as differences: the low byte of each, then four bits each for
    what is above it (15: the difference follows whole, in four bytes).  Cells far
    apart, marked in the top bit of their number, take two bytes each (65535: the same)."""
    gaps = np.diff(cells, prepend=np.uint64(0)).astype(np.uint32)
    if len(cells) and int(cells[-1]) >= FAR_APART * len(cells):
        low = np.minimum(gaps, 0xFFFF).astype("<u2")
        return (len(gaps) | 1 << 31).to_bytes(4, "little") + low.tobytes() + gaps[low == 0xFFFF].astype("<u4").tobytes()
    high = np.minimum(gaps >> 8, 15).astype(np.uint8)
    wide = gaps[high == 15].astype("<u4")
    high = np.append(high, np.zeros(len(high) % 2, np.uint8))
    return len(gaps).to_bytes(4, "little") + gaps.astype(np.uint8).tobytes() + (high[::2] << 4 | high[1::2]).tobytes() + wide.tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    n = int.from_bytes(blob[:4], "little")
    if n >> 31:
        n &= (1 << 31) - 1
        gaps = np.frombuffer(blob, "<u2", n, 4).astype(np.int64)
        gaps[gaps == 0xFFFF] = np.frombuffer(blob, "<u4", offset=4 + 2 * n)
        return np.cumsum(gaps)
    half = (n + 1) // 2
    both = np.frombuffer(blob, np.uint8, half, 4 + n)
    high = np.column_stack([both >> 4, both & 15]).ravel()[:n].astype(np.int64)
    gaps = np.frombuffer(blob, np.uint8, n, 4) + (high << 8)
    gaps[high == 15] = np.frombuffer(blob, "<u4", offset=4 + n + half)
    return np.cumsum(gaps)


def merged_sketch(
    df: DataFrame,
    hashes: Callable[[Iterable[pa.RecordBatch]], Iterator[np.ndarray]],
    bits: int,
    depth: int = 1,
    counts: bool = False,
    whole: int | None = None,
) -> Sketch:
    """Sketch of all that ``hashes`` yields over the rows of ``df``, broadcast; in pieces
    if it takes more than ``whole`` bytes (a power of two)."""
    ranges = max(RANGE_BITS, bits - INSIDE_BITS)  # log2 of their number
    inside = bits - ranges
    most = MOST if counts else 2

    def parts(batches):
        for h in hashes(batches):
            for row in range(depth):
                cells = np.sort(cells_of(h, bits, row))
                if len(cells) > most:  # no more of a kind than can matter
                    cells = cells[np.concatenate((np.ones(most, bool), cells[most:] != cells[:-most]))]
                slots = (cells >> np.uint64(inside)).astype(np.int64)
                cuts = np.searchsorted(slots, np.arange((1 << ranges) + 1))
                used = np.flatnonzero(np.diff(cuts))
                low = cells & np.uint64((1 << inside) - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(used + (row << ranges), pa.int32()),
                        pa.array([_packed(low[cuts[s] : cuts[s + 1]]) for s in used], pa.binary()),
                    ],
                    ["slot", "cells"],
                )

    def merge(batches):
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            for slot, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if slot not in tables:
                    tables[slot] = np.zeros(1 << inside, np.uint8)
                table = tables[slot]
                cells, n = np.unique(_unpacked(blob), return_counts=True)
                table[cells] = np.minimum(table[cells].astype(np.int64) + n, MOST)
        for slot, table in tables.items():
            packed = table if counts else np.packbits(table > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot], pa.int32()), pa.array([packed.tobytes()], pa.binary())], ["slot", "table"]
            )

    spark = df.sparkSession
    rows = (
        df.mapInArrow(parts, "slot int, cells binary")
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "slot")
        .mapInArrow(merge, "slot int, table binary")
    )
    size = (1 << inside) // (1 if counts else 8)
    slots = depth << ranges
    held = max(1, whole // 4 // size) if whole and slots * size > whole else slots  # slots of a piece
    found = stored(rows, "sketch")
    if held < slots:
        found = found.orderBy("slot")
    pieces, table = [], np.zeros(held * size, np.uint8)

    def sent(until: int) -> None:
        """Broadcast what is behind, up to piece ``until``."""
        while len(pieces) < until:
            pieces.append(spark.sparkContext.broadcast(table))
            table[:] = 0

    for slot, packed in found.toLocalIterator():  # depth * 2^bits bits or bytes in all, a partition at a time
        sent(slot // held)
        table[slot % held * size :][:size] = np.frombuffer(packed, np.uint8)
    sent(-(-slots // held))
    return Sketch(pieces, held * size, bits, depth)


class Sketch:
    """A merged sketch; tasks look into its broadcast pieces of ``size`` bytes."""

    def __init__(self, pieces: list, size: int, bits: int, depth: int):
        self.pieces, self.size, self.bits, self.depth = pieces, size, bits, depth

    @property
    def table(self):
        """All of a sketch of one piece."""
        (table,) = self.pieces
        return table

    @property
    def at_once(self) -> int:
        """Hashes that are looked up together at best."""
        return AT_ONCE[len(self.pieces) > 1]

    def _bytes(self, at: np.ndarray) -> np.ndarray:
        """The table's bytes at these places."""
        if len(self.pieces) == 1:
            return self.table.value[at]
        out = np.empty(len(at), np.uint8)
        number = (at // self.size).astype(np.uint8 if len(self.pieces) <= 256 else np.int32)
        for i, piece in enumerate(self.pieces):
            here = np.flatnonzero(number == i)
            if len(here):
                out[here] = piece.value[at[here] - i * self.size]
                if getattr(piece, "_path", None):  # else the value can't be read again
                    vars(piece).pop("_value", None)
        return out

    def drop(self) -> None:
        """No task needs the table any more."""
        for piece in self.pieces:
            piece.destroy()

    def repeated(self, h: np.ndarray) -> np.ndarray:
        """False only for hashes that occurred once (sketch of bits)."""
        out = np.ones(len(h), bool)
        for row in range(self.depth):
            cell = cells_of(h, self.bits, row).view(np.int64)
            bit = 7 - (cell & 7).astype(np.uint8)
            cell >>= 3
            cell += row << self.bits >> 3
            out &= ((self._bytes(cell) >> bit) & 1).astype(bool)
        return out

    def estimates(self, h: np.ndarray) -> np.ndarray:
        """At least the number of times that each hash occurred, up to 255 (sketch of counts)."""
        out = np.full(len(h), MOST, np.uint8)
        for row in range(self.depth):
            cell = cells_of(h, self.bits, row).view(np.int64)
            cell += row << self.bits
            np.minimum(out, self._bytes(cell), out=out)
        return out
