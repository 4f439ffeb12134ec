"""Ranked lexical search, exact, over posting lists cut into geometric blocks.

Items (queries) and documents are bags of terms; a document's score for an item is
the sum of the impacts of the terms both hold, an impact being the term's weight
times its damped frequency, in whole numbers (``Weights``).

Documents are dealt to segments of bounded size.  In a segment every term that items
ask for has a posting list.  A long list is clustered: some of its documents, evenly
taken, attract those whose vectors (impacts of all asked terms, projected to a few
dimensions) are most similar, and each cluster is a block.  A block stores the
coordinatewise maximum of its documents' impacts, for the terms that occur in an item
together with the list's term.  For an item the blocks of its terms' lists are visited
by falling bound (the sum of the block's maxima over the item's terms); a visited
block's documents are scored in full.  The visit ends when the largest bound left is
below the item's k-th best score, which a task carries on from segment to segment.  A bound is never below
a score in its block and equal bounds are visited, so nothing is lost, ties included.

Items come in groups of bounded size, dealt by a hash, each a pass over the documents;
tasks send their k best for each item.  Where two ranks tie, the smaller id is
first; null ids come last; rows that share an id are ranked each by itself, and equal
ones have an arbitrary order.  Null and term-less texts match nothing, an item without
terms or without id has no rows, item rows that share an id are one item with the terms of all.
Items, documents and other columns may be empty or have any name; only id and text are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brinkcast.llm.arrow import chunks
from brinkcast.llm.storage import stored

#: Terms of all items in one group, at most (an item is not divided).
ASKED = 8192
#: Numbers in a segment's matrix of impacts, most documents in it, documents a block, dimensions of the projection.
CELLS, DOCS, BLOCK, DIMS = 4_000_000, 2048, 32, 12
#: Bytes of text that are cut into terms at a time.
BYTES = 8_000_000
#: Documents that a task searches, unless that makes more than so many tasks.
TASK_DOCS, TASKS = 8192, 200_000

_LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Runs of ASCII letters and digits and of all characters beyond ASCII; only A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_LETTERS).split()


@dataclass(frozen=True)
class Weights:
    """Weights of the asked terms, number and total terms of the documents that have any."""

    of_term: np.ndarray
    docs: int
    terms: int

    def impacts(self, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Damped frequencies times weight: high for rare terms, frequent here, in short documents."""
        length = 10 + (90 * n * self.docs) // self.terms
        return self.of_term[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * length))


def weights(df: np.ndarray, docs: int, terms: int) -> Weights:
    w = [math.floor(1000 * math.log((2 * docs + 2) / (2 * int(f) + 1))) for f in df]
    return Weights(np.array(w, np.int64), docs, max(terms, 1))


def _bags(items: DataFrame, item: str, text: str) -> DataFrame:
    """Stored distinct (item, term)."""

    def of(batches):
        for batch in batches:
            found = [sorted(set(terms_of(t or ""))) for t in batch.column(1).to_pylist()]
            owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
            flat = pa.array([t for f in found for t in f], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner, pa.int64())), flat], ["item", "term"])

    picked = items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").alias("text")).where("item is not null")
    kind = picked.schema["item"].dataType.simpleString()
    return stored(picked.mapInArrow(of, f"item {kind}, term binary").distinct(), "items")


def _counted(vocabulary: list[bytes]):
    """Tasks that turn texts into (doc, n, terms, tfs); terms are numbers in ``vocabulary``."""

    def of(batches):
        number = {t: i for i, t in enumerate(vocabulary)}
        size = max(1, len(number))
        for batch in batches:
            texts = batch.column(1)
            sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
            for a, b in chunks(batch, sizes, BYTES):
                keys, lengths = [np.empty(0, np.int64)], []
                for i, text in enumerate(texts.slice(a, b - a).to_pylist()):
                    words = terms_of(text or "")
                    lengths.append(len(words))
                    found = np.fromiter(map(number.get, words, repeat(-1)), np.int64, len(words))
                    keys.append(found[found >= 0] + i * size)
                key, tf = np.unique(np.concatenate(keys), return_counts=True)
                cut = np.searchsorted(key, np.arange(b - a + 1) * size)
                lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(v, pa.int32())) for v in (key % size, tf)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(lengths, pa.int64()), *lists], ["doc", "n", "terms", "tfs"])

    return of


def term_counts(docs: DataFrame, vocabulary: list[bytes], id: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored (doc, n, terms, tfs) of documents that have terms."""
    picked = docs.select(F.col(f"`{id}`").alias("doc"), F.col(f"`{text}`").alias("text"))
    kind = picked.schema["doc"].dataType.simpleString()
    counted = picked.mapInArrow(_counted(vocabulary), f"doc {kind}, n long, terms array<int>, tfs array<int>")
    return stored(counted.where("n > 0"), "term-counts")


def corpus_weights(counts: DataFrame, terms: int) -> Weights:
    """One pass: documents that hold each of ``terms`` terms, all documents, all terms."""

    def of(batches):
        df = np.zeros(terms, np.int64)
        for batch in batches:
            df += np.bincount(batch.column(0).flatten().to_numpy(zero_copy_only=False), minlength=terms)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(df[held])], ["term", "df"])

    df = np.zeros(terms, np.int64)
    for r in counts.select("terms").mapInArrow(of, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        df[r.term] = r.df
    total = counts.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    return weights(df, total.docs, total.terms)


class Asked:
    """Items as arrays of term numbers, and for each term those it occurs with in an item."""

    def __init__(self, items: list[np.ndarray], terms: int):
        self.items = items
        beside: list[set[int]] = [set() for _ in range(terms)]
        for item in items:
            for t in item:
                beside[t].update(item)
        self.beside = [np.array(sorted(b), np.int64) for b in beside]
        self.place = [[np.searchsorted(self.beside[t], item) for t in item] for item in items]


class Segment:
    """Some documents' impacts, their posting lists in blocks, and the blocks' maxima."""

    def __init__(self, impacts: np.ndarray, asked: Asked, block: int = BLOCK, seed: int = 7):
        self.impacts = impacts
        draw = np.random.Generator(np.random.PCG64(seed)).normal(size=(impacts.shape[1], DIMS))
        flat = np.sqrt(impacts) @ draw
        flat /= np.maximum(np.linalg.norm(flat, axis=1, keepdims=True), 1e-12)
        self.docs: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []
        self.maxima: list[np.ndarray] = []
        held, doc = np.nonzero(impacts.T)
        ends = np.searchsorted(held, np.arange(impacts.shape[1] + 1))
        for t in range(impacts.shape[1]):
            posting = doc[ends[t] : ends[t + 1]]
            starts = np.zeros(min(1, len(posting)), np.int64)
            if len(posting) > block:
                leaders = posting[:: len(posting) // math.ceil(len(posting) / block)]
                owner = (flat[posting] @ flat[leaders].T).argmax(axis=1)
                order = np.argsort(owner, kind="stable")
                posting, owner = posting[order], owner[order]
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
            self.docs.append(posting)
            self.starts.append(starts)
            columns = impacts[np.ix_(posting, asked.beside[t])]
            self.maxima.append(np.maximum.reduceat(columns, starts, axis=0) if len(posting) else columns)
        self.scored = 0  # documents scored by searches

    def search(self, item: np.ndarray, place: list[np.ndarray], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (numbers) and scores, among them all of the ``k`` best with at least ``least``."""
        bounds = np.concatenate([self.maxima[t][:, p].sum(axis=1) for t, p in zip(item, place)])
        block = np.concatenate([np.arange(len(self.starts[t])) for t in item])
        term = np.repeat(item, [len(self.starts[t]) for t in item])
        order = np.argsort(-bounds, kind="stable")
        seen = np.zeros(len(self.impacts), bool)
        docs, scores = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        top = np.empty(0, np.int64)
        at, step = 0, 4
        while at < len(order):
            chosen = order[at : at + step]
            chosen = chosen[bounds[chosen] >= least]
            if not len(chosen):
                break
            met = np.unique(np.concatenate([self._block(term[b], block[b]) for b in chosen]))
            met = met[~seen[met]]
            seen[met] = True
            found = self.impacts[np.ix_(met, item)].sum(axis=1)
            self.scored += len(met)
            docs.append(met[found >= least])
            scores.append(found[found >= least])
            top = np.concatenate([top, scores[-1]])
            if len(top) >= k:
                top = np.partition(top, len(top) - k)[len(top) - k :]
                least = max(least, int(top.min()))
            at, step = at + step, min(2 * step, 64)
        return np.concatenate(docs), np.concatenate(scores)

    def _block(self, term: int, number: int) -> np.ndarray:
        ends = [*self.starts[term][number : number + 2], len(self.docs[term])]
        return self.docs[term][ends[0] : ends[1]]


def _found(asked: Asked, weight: Weights, k: int):
    def of(batches):
        terms = len(weight.of_term)
        most = max(1, min(DOCS, CELLS // max(1, terms)))
        best: list[list[tuple]] = [[] for _ in asked.items]
        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field(0).type
            for a in range(0, batch.num_rows, most):
                part = batch.slice(a, most)
                term, tf = (part.column(c).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for c in (2, 3))
                row = np.repeat(np.arange(part.num_rows), pc.list_value_length(part.column(2)).to_numpy(zero_copy_only=False))
                n = part.column(1).to_numpy(zero_copy_only=False)
                impacts = np.zeros((part.num_rows, terms), np.int64)
                impacts[row, term] = weight.impacts(term, tf, n[row])
                segment, ids = Segment(impacts, asked), part.column(0).to_pylist()
                for i, item in enumerate(asked.items):
                    least = best[i][-1][0] if len(best[i]) == k else 1
                    docs, scores = segment.search(item, asked.place[i], k, least)
                    if len(docs):
                        ties = sorted(best[i] + [(s, ids[d]) for d, s in zip(docs, scores.tolist())], key=lambda r: (-r[0], r[1] is None, r[1] or 0))
                        best[i] = ties[:k]
        rows = [(i, d, s) for i, found in enumerate(best) for s, d in found]
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), pa.array(columns[1], kind), pa.array(columns[2], pa.int64())], ["item", "doc", "score"])

    return of


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each item, first within salted parts so that no task holds what all tasks found for an item."""
    order = [F.desc("score"), F.col("doc").asc_nulls_last()]
    salted = found.withColumn("_salt", F.pmod(F.xxhash64("doc", "score"), F.lit(64)))
    few = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "_salt").orderBy(*order))).where(F.col("rank") <= k)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _answered(bags: DataFrame, docs: DataFrame, id: str, text: str, k: int) -> DataFrame:
    """(item, rank, doc, score) for the items of one group."""
    rows = bags.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms")).orderBy("item").collect()
    vocabulary = sorted({bytes(t) for r in rows for t in r.terms})
    number = {t: i for i, t in enumerate(vocabulary)}
    asked = Asked([np.array([number[bytes(t)] for t in r.terms], np.int64) for r in rows], len(vocabulary))
    counts = term_counts(docs, vocabulary, id, text)
    weight = corpus_weights(counts, len(vocabulary))
    kinds = bags.schema["item"].dataType, counts.schema["doc"].dataType.simpleString()
    tasks = min(math.ceil(weight.docs / TASK_DOCS), TASKS)  # its rows are small, so splits by bytes would make long tasks
    found = counts.repartition(max(1, tasks)).mapInArrow(_found(asked, weight, k), f"item int, doc {kinds[1]}, score long")
    names = docs.sparkSession.createDataFrame([(i, r.item) for i, r in enumerate(rows)], f"item int, item_id {kinds[0].simpleString()}")
    return _best(found, k).join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc", "score")


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", asked: int = ASKED) -> DataFrame:
    """The ``k`` best documents with a score above 0 for each item: (item_id, rank, doc_id, score)."""
    bags = _bags(items, item, item_text)
    groups = max(1, math.ceil(bags.count() / asked))
    parts = []
    for g in range(groups):
        mine = bags.where(F.pmod(F.xxhash64("item"), F.lit(groups)) == g)
        parts.append(stored(_answered(mine, docs, id, text, k), "ranked"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.withColumnRenamed("doc", id)
