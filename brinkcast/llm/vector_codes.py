"""Compress vectors to short codes: one codebook for each part of the vector.

Components become whole numbers (``floor(factor * x)``), vectors are cut into
consecutive parts, and each part is replaced by the number of the nearest entry of
its codebook.  A codebook starts with the parts of the vectors of the smallest ids;
in every round the parts move to their nearest entry and the entry to the floor of
their mean.  Entries that attract nothing stay.  Nearest entries are found in a
GNAT (``gnat``), exactly, ties to the lower entry.

A round is one pass: tasks send one row of sums for each entry they met, which Spark
adds up; the new entries, ``parts * entries`` short vectors, come to the driver and go
out with the next pass.

Vectors that are null, empty, hold null or non-finite components, or have another
length than most (ties: the longer) are left out.  Repeated rows and ids count as
often as they occur; rows without id are encoded, as seeds they come last.  With
fewer vectors than entries codebooks are shorter; without a vector the result is
empty.  Where a length is no multiple of ``parts`` the first parts are one longer.
Components beyond some ten million are refused, as squared distances would not be
exact.  Columns of the input other than id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinkcast.llm.gnat import Gnat
from brinkcast.llm.storage import broadcast_if_small, stored


@dataclass(frozen=True)
class Codebooks:
    """One array of entries (rows of whole numbers) for each part."""

    parts: tuple[np.ndarray, ...]

    def bounds(self) -> list[tuple[int, int]]:
        ends = np.cumsum([0, *[p.shape[1] for p in self.parts]]).tolist()
        return list(zip(ends, ends[1:]))

    def sha256(self) -> str:
        """Of all components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, np.concatenate([p.ravel() for p in self.parts]).tolist())).encode()).hexdigest()

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """Vectors that stand for rows of entry numbers."""
        return np.concatenate([p[codes[:, i]] for i, p in enumerate(self.parts)], axis=1)


def on_grid(vector: str, factor: int) -> Column:
    """``floor(factor * x)`` of every component; null unless all are finite."""
    finite = f"`{vector}` is not null and forall(`{vector}`, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
    return F.expr(f"case when {finite} then transform(`{vector}`, x -> cast(floor({factor}D * cast(x as double)) as bigint)) end")


def grid_vectors(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", factor: int = 1024) -> DataFrame:
    """Stored rows (vec_id, label, v) that take part."""
    picked = df.select(F.col(f"`{id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), on_grid(vector, factor).alias("v"))
    rows = stored(picked.where("size(v) > 0"), "vectors")
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    return rows if sizes is None else rows.where(F.size("v") == sizes.n)


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def first_codebooks(vectors: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """Parts of the vectors with the smallest ids."""
    seeds = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not seeds:
        return None
    rows = np.array([r.v for r in seeds], np.int64)
    return Codebooks(tuple(np.ascontiguousarray(p) for p in np.array_split(rows, parts, axis=1)))


def _sums(books: Codebooks):
    def of(batches):
        trees = [Gnat(p) for p in books.parts]
        counts = [np.zeros(len(p), np.int64) for p in books.parts]
        totals = [np.zeros(p.shape, np.int64) for p in books.parts]
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _matrix(batch.column(0))
            for i, (a, b) in enumerate(books.bounds()):
                entry, _ = trees[i].nearest(whole[:, a:b])
                n = len(counts[i])
                counts[i] += np.bincount(entry, minlength=n)
                for j in range(a, b):  # whole numbers far below the limit of doubles
                    totals[i][:, j - a] += np.bincount(entry, whole[:, j], n).astype(np.int64)
        for i, n in enumerate(counts):
            met = np.flatnonzero(n)
            yield pa.RecordBatch.from_pydict(
                {"part": np.full(len(met), i, np.int32), "entry": met.astype(np.int32), "n": n[met], "sums": totals[i][met].tolist()},
                pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))]),
            )

    return of


def next_codebooks(vectors: DataFrame, books: Codebooks) -> Codebooks:
    """One round: parts to their nearest entries, entries to the floor of the mean."""
    found = vectors.select("v").mapInArrow(_sums(books), "part int, entry int, n long, sums array<long>")
    width = max(p.shape[1] for p in books.parts)
    sums = [F.sum(F.get("sums", F.lit(j)).cast("decimal(20,0)")).alias(f"s{j}") for j in range(width)]
    parts = [p.copy() for p in books.parts]
    for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
        parts[r.part][r.entry] = [int(r[f"s{j}"]) // r.n for j in range(parts[r.part].shape[1])]
    return Codebooks(tuple(parts))


def train(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> Codebooks | None:
    """Codebooks after ``rounds`` passes; None without a vector."""
    books = first_codebooks(vectors, parts, entries)
    for _ in range(rounds if books else 0):
        books = next_codebooks(vectors, books)
    return books


def _encoded(books: Codebooks):
    digits = max(2, max(len(f"{len(p) - 1:x}") for p in books.parts))

    def of(batches):
        trees = [Gnat(p) for p in books.parts]
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = _matrix(batch.column("v"))
            code, error = np.full(len(whole), "", object), np.zeros(len(whole), np.int64)
            for i, (a, b) in enumerate(books.bounds()):
                entry, distance = trees[i].nearest(whole[:, a:b])
                code += np.array([f"{e:0{digits}x}" for e in range(len(books.parts[i]))], object)[entry]
                error += distance
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(code.tolist(), pa.string()), pa.array(error)],
                ["vec_id", "label", "code", "error"],
            )

    return of


def encode(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """(vec_id, label, code, error): entry numbers in hex, two digits or more a part,
    and the squared distance to what the code stands for."""
    id_type, label_type = (vectors.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    return vectors.select("vec_id", "label", "v").mapInArrow(_encoded(books), f"vec_id {id_type}, label {label_type}, code string, error long")


def with_label_error(encoded: DataFrame) -> DataFrame:
    """``encoded`` (stored) with the error summed over equal labels, nulls together."""
    sums = stored(encoded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    sums = broadcast_if_small(sums.withColumnRenamed("label", "_of"))
    return encoded.join(sums, F.col("label").eqNullSafe(F.col("_of"))).drop("_of")


def compress(df: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = 4, entries: int = 256, rounds: int = 4) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every vector that takes part."""
    vectors = grid_vectors(df, id, vector, label)
    books = train(vectors, parts, entries, rounds)
    if books is None:
        nothing = "'' as code, 0L as error, 0L as label_error, '' as codebooks_sha256"
        return vectors.where("false").selectExpr("vec_id", "label", *nothing.split(", "))
    coded = stored(encode(vectors, books), "codes")
    return with_label_error(coded).withColumn("codebooks_sha256", F.lit(books.sha256()))
