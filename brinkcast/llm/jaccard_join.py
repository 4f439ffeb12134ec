"""Jaccard self-join of documents on their distinct word shingles.

A link is a pair of documents with ``100 * |A & B| >= percent * |A | B|``.  What
is returned is, per document, the smallest id it reaches over links; pairs are
never listed.

1. *Signatures*: per document a 128-bit key of its words and the size of its set.
   Documents with equal words form a class; its smallest id stands for it.
2. *Repeated shingles*: a document can only link if ``percent`` of its shingles
   occur elsewhere.  A merged count sketch (never underestimates) lets tasks keep
   the few documents for which that may hold.  Their sets are written once.
3. *Candidate groups*: shingles are ordered by estimated count, rarest first.
   Linked sets share one of their first ``n - ceil(percent n / 100) + 1`` in that
   order, so tying every set to the first holder of each such shingle puts all
   partners in one connected group.  Tasks tie their own sets first: a shingle
   held by a third of all rows leaves one row a task.
4. *T-occurrence search* within groups: an inverted index of the group answers,
   for each set, which others hold at least T of its shingles.  The longest lists
   are set aside (DivideSkip), the short ones merged with a heap.  A set that too
   few short lists hold is passed over, with all up to the next set that could be
   in enough of them; one that occurs often enough is looked up in the long lists
   by binary search.  Counts are exact, so is the decision.  Within a group sets
   already in one cluster are skipped in the lists as well.
5. Groups above ``block_shingles`` are cut into blocks.  Every set is compared
   with a few members of the group; whoever is linked to the largest cluster so
   found needs no more, as its links within the cluster change nothing.  The rest
   are searched against all blocks.

A null or wordless text has no shingles and links with nothing, a text of fewer
words than a shingle has is one shingle.  Rows that share an id are one document.
A row without id links with nothing and has no component.  Further columns are
ignored.  The sketches' sizes follow the input up to ``most_bits``, as a crowded one
would let most sets through; beyond, more documents go to steps 3 to 5, with the same
result.  Driver and tasks hold ``whole_bits`` of a sketch at a time.
"""

from __future__ import annotations

import heapq
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brinkcast.llm.arrow import begin, bounded_batches, runs_of, slices
from brinkcast.llm.components import connected_components
from brinkcast.llm.hashing import WordHashes, run_hashes
from brinkcast.llm.sketch import merged_sketch, sketch_bits
from brinkcast.llm.storage import broadcast_if_small, stored

#: Words held as arrays at a time while sets go to the sketch.
WORDS = 1_000_000
#: Keys of texts that a task remembers before it starts afresh.
KEPT_KEYS = 50_000
#: DivideSkip's weight of a merged entry against a probe.
MU = 0.0085
PIVOTS = 8


def _words(text: bytes | None) -> list[bytes]:
    """Lower-cased A-Z, split at ASCII white space."""
    return text.lower().split() if text else []


def _set(words: list[bytes], hashes: WordHashes, k: int) -> np.ndarray:
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(run_hashes(hashes.of(words), min(k, len(words))))


def _key(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


class _Firsts:
    """Ids and words of what a task reads, equal texts once, again only for a smaller id."""

    def __init__(self):
        self.least: dict[bytes, int] = {}

    def of(self, batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
        firsts: dict[bytes, tuple[int, bytes]] = {}
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = _words(text)
            if words and doc is not None:
                key = _key(words)
                if key not in firsts or doc < firsts[key][0]:
                    firsts[key] = (doc, text)
        for key, (doc, text) in firsts.items():  # words take far more memory than texts
            if key in self.least and self.least[key] <= doc:
                continue
            if len(self.least) >= KEPT_KEYS:
                self.least.clear()
            self.least[key] = doc
            yield doc, _words(text)


def signatures(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, key, n_shingles) of every row; key null without words."""

    def sign(batches):
        begin("jaccard_join")
        hashes = WordHashes()
        for batch in slices(batches, 1):
            keys, sizes = [], []
            for text in batch.column(1).to_pylist():
                words = _words(text)
                keys.append(_key(words) if words else None)
                sizes.append(len(_set(words, hashes, k)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64())], ["doc_id", "key", "n_shingles"]
            )

    return docs.mapInArrow(sign, "doc_id long, key binary, n_shingles long")


def _needed(n, percent: int):
    """Shingles that a partner of a set of ``n`` must share, at least."""
    return -(-percent * n // 100)


def _gathered(rows: Iterator[tuple[int, np.ndarray]], most: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """Documents with their sets, about ``most`` shingles at a time."""
    held, n = [], 0
    for doc, s in rows:
        held.append((doc, s))
        n += len(s)
        if n >= most:
            yield held
            held.clear()  # sets that were worked on go before others come
            n = 0
    if held:
        yield held


def _looked_up(held: list[tuple[int, np.ndarray]], look: Callable[[np.ndarray], np.ndarray]) -> list[np.ndarray]:
    """``look`` of every set, asked for all at once."""
    return np.split(look(np.concatenate([s for _, s in held])), np.cumsum([len(s) for _, s in held])[:-1])


def _bits(total: int, cells: float, fewer: float, most_bits: int, whole_bits: int) -> int:
    """log2 of a sketch's cells, ``cells`` for each shingle, or ``fewer`` if that is too much
    for one piece."""
    bits = sketch_bits(total, cells, most_bits)
    return bits if bits <= whole_bits else sketch_bits(total, fewer, most_bits)


def _candidates(docs: DataFrame, total: int, k: int, percent: int, most_bits: int, whole_bits: int) -> DataFrame:
    """(doc_id, n, shingles) of the documents that may have a partner, stored."""

    def shingles(batches):
        begin("jaccard_join")
        hashes, firsts = WordHashes(), _Firsts()
        held, n = [], 0
        for batch in slices(batches, 1):
            for _, words in firsts.of(batch):
                held.append(_set(words, hashes, k))
                n += len(held[-1])
                if n >= WORDS:
                    yield np.concatenate(held)
                    held, n = [], 0
        if held:
            yield np.concatenate(held)

    sketch = merged_sketch(docs, shingles, _bits(total, 1.6, 1.2, most_bits, whole_bits), whole=1 << whole_bits >> 3)

    def keep(batches):
        begin("jaccard_join")
        hashes, firsts = WordHashes(), _Firsts()
        rows = ((doc, _set(words, hashes, k)) for batch in slices(batches, 1) for doc, words in firsts.of(batch))
        for held in _gathered(rows, sketch.at_once):
            again = _looked_up(held, sketch.repeated)
            few = ((doc, s) for (doc, s), r in zip(held, again) if int(r.sum()) >= _needed(len(s), percent))
            for some in _gathered(few, WORDS // 8):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([doc for doc, _ in some], pa.int64()),
                        pa.array([len(s) for _, s in some], pa.int64()),
                        pa.array([s.astype("<u8").tobytes() for _, s in some], pa.binary()),
                    ],
                    ["doc_id", "n", "shingles"],
                )

    found = stored(docs.mapInArrow(keep, "doc_id long, n long, shingles binary"), "candidates")
    sketch.drop()
    return found


def _candidate_ties(sets: DataFrame, total: int, percent: int, most_bits: int, whole_bits: int) -> DataFrame:
    """Edges (a, b) that connect all sets which may be linked."""

    def shingles(batches):
        begin("jaccard_join")
        held, n = [], 0
        for batch in batches:
            for s in batch.column(2).to_pylist():
                held.append(np.frombuffer(s, "<u8"))
                n += len(held[-1])
                if n >= WORDS:
                    yield np.concatenate(held)
                    held, n = [], 0
        if held:
            yield np.concatenate(held)

    counts = merged_sketch(sets, shingles, _bits(total, 1.5, 0.8, most_bits - 3, whole_bits - 3), counts=True, whole=1 << whole_bits >> 3)

    def tie(batches):
        begin("jaccard_join")
        holder: dict[int, int] = {}
        ties: set[tuple[int, int]] = set()
        rows = ((doc, np.frombuffer(s, "<u8")) for batch in batches for doc, s in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()))
        for held in _gathered(rows, counts.at_once):
            for (doc, s), c in zip(held, _looked_up(held, counts.estimates)):
                first = np.lexsort((s, c))[: len(s) - _needed(len(s), percent) + 1]
                for t in s[first[c[first] > 1]].view(np.int64).tolist():
                    other = holder.setdefault(t, doc)
                    if other != doc:
                        ties.add((doc, other))
        done = list(ties)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([None] * len(done) + list(holder), pa.int64()),
                pa.array([a for a, _ in done] + list(holder.values()), pa.int64()),
                pa.array([b for _, b in done] + [None] * len(holder), pa.int64()),
            ],
            ["shingle", "a", "b"],
        )

    rows = stored(sets.mapInArrow(tie, "shingle long, a long, b long"), "ties")
    counts.drop()
    held = rows.where("shingle is not null").select("shingle", "a")
    first = held.groupBy("shingle").agg(F.min("a").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    return rows.where("shingle is null").select("a", "b").union(held.join(first, "shingle").select("a", "b").where("a <> b"))


class InvertedIndex:
    """Inverted lists of some sets, smaller sets first."""

    def __init__(self, ids: list[int], sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets])
        order = np.lexsort((np.array(ids), sizes))
        self.ids = np.array(ids)[order]
        self.sizes = sizes[order]
        self.sets = [sets[i] for i in order]
        self.tokens, token = np.unique(np.concatenate(self.sets), return_inverse=True)
        owner = np.repeat(np.arange(len(ids)), self.sizes)
        entries = np.sort(token.reshape(-1).astype(np.int64) * len(ids) + owner)
        self.cuts = np.searchsorted(entries, np.arange(len(self.tokens) + 1) * len(ids))
        #: Numbers of the sets in each list, ascending, list after list.
        self.owners = array("i", (entries % len(ids)).astype("<i4").tobytes())

    def partners(self, s: np.ndarray, percent: int, among: np.ndarray) -> np.ndarray:
        """Numbers of the sets linked with ``s``, of those that ``among`` marks."""
        return np.fromiter(self.linked(s, percent, among), np.int64)

    def linked(self, s: np.ndarray, percent: int, among: np.ndarray) -> Iterator[int]:
        """As ``partners``, one by one in ascending order; what the caller takes out of
        ``among`` meanwhile is passed over."""
        n = len(s)
        lo = int(np.searchsorted(self.sizes, _needed(n, percent)))
        hi = int(np.searchsorted(self.sizes, n * 100 // percent, side="right"))
        wanted = (np.flatnonzero(among[lo:hi]) + lo).tolist()
        if not wanted:
            return
        at = np.searchsorted(self.tokens, s)
        at = at[at < len(self.tokens)]
        lists = at[self.tokens[at] == s[: len(at)]]
        required = -(-(n + int(self.sizes[wanted[0]])) * percent // (100 + percent))
        if len(lists) < required:
            return
        lengths = self.cuts[lists + 1] - self.cuts[lists]
        lists = lists[np.argsort(lengths, kind="stable")]
        aside = min(required - 1, int(required / (MU * np.log2(max(2, int(lengths.max()))) + 1)))
        spans = list(zip(self.cuts[lists].tolist(), self.cuts[lists + 1].tolist()))
        short, long = spans[: len(lists) - aside], spans[len(lists) - aside :]
        least = required - aside
        owners, last = self.owners, wanted[-1]
        heap: list[tuple[int, int, int]] = []

        def move(span: tuple[int, int], to: int) -> None:
            """Put a list back at its first set from ``to`` on."""
            place = bisect_left(owners, to, *span)
            if place < span[1] and owners[place] <= last:
                heapq.heappush(heap, (owners[place], place, span[1]))

        for span in short:
            move(span, wanted[0])
        while len(heap) >= least:  # what fewer lists hold is out
            j = heap[0][0]
            place = bisect_left(wanted, j)
            if place == len(wanted):
                return
            if wanted[place] != j:  # nobody asks for j: all lists go on to the next set
                while heap and heap[0][0] < wanted[place]:
                    _, start, stop = heapq.heappop(heap)
                    move((start, stop), wanted[place])
                continue
            popped = []
            while heap and heap[0][0] == j:
                popped.append(heapq.heappop(heap))
            to = j + 1
            if len(popped) < least:  # sets before the next top are in fewer lists than needed
                while heap and len(popped) < least - 1:
                    popped.append(heapq.heappop(heap))
                to = max(to, heap[0][0]) if heap else last + 1
            else:
                size = int(self.sizes[j])
                missing = -(-percent * (n + size) // (100 + percent)) - len(popped)
                for k, (start, stop) in enumerate(long):
                    if missing <= 0 or missing > len(long) - k:
                        break
                    place = bisect_left(owners, j, start, stop)
                    missing -= place < stop and owners[place] == j
                if missing <= 0:
                    yield j
                    wanted = (np.flatnonzero(among[j + 1 : hi]) + j + 1).tolist()
                    if not wanted:
                        return
            for _, start, stop in popped:
                move((start, stop), to)


def _clusters_within(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all linked sets of a group; sets already in one cluster
    are not compared."""
    index = InvertedIndex(ids, sets)
    root = np.arange(len(ids))
    links = []
    for i, s in enumerate(index.sets):
        among = root != root[i]
        among[i:] = False  # the others look back at this one
        for j in index.linked(s, percent, among):
            root[root == root[j]] = root[i]
            np.not_equal(root[:i], root[i], out=among[:i])
            links.append((int(index.ids[i]), int(index.ids[j])))
    return links


def _links(rows: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in rows], pa.int64()), pa.array([b for _, b in rows], pa.int64())], ["a", "b"]
    )


def _search_small(grouped: DataFrame, percent: int, parts: int) -> DataFrame:
    def found(rows):
        links = _clusters_within([r[1] for r in rows], [np.frombuffer(r[2], "<u8") for r in rows], percent)
        if links:
            yield _links(links)

    return (
        grouped.select("grp", "doc_id", "shingles")
        .repartition(parts, "grp")
        .sortWithinPartitions("grp")
        .mapInArrow(lambda batches: runs_of(batches, 0, found), "a long, b long")
    )


def _search_blocks(queries: DataFrame, index: DataFrame, percent: int, parts: int) -> DataFrame:
    """Links of ``queries`` with ``index``, both (block, doc_id, shingles)."""

    def found(rows):
        asked = [(r[1], np.frombuffer(r[2], "<u8")) for r in rows if r[3]]
        held = [(r[1], np.frombuffer(r[2], "<u8")) for r in rows if not r[3]]
        if not asked or not held:
            return
        lists = InvertedIndex([i for i, _ in held], [s for _, s in held])
        links = []
        for doc, s in asked:
            links += [(doc, int(lists.ids[j])) for j in lists.partners(s, percent, lists.ids != doc)]
        if links:
            yield _links(links)

    both = queries.withColumn("asks", F.lit(True)).unionByName(index.withColumn("asks", F.lit(False)))
    return (
        both.select("block", "doc_id", "shingles", "asks")
        .repartition(parts, "block")
        .sortWithinPartitions("block")
        .mapInArrow(lambda batches: runs_of(batches, 0, found), "a long, b long")
    )


def _search_large(large: DataFrame, percent: int, block_shingles: int, parts: int) -> DataFrame:
    """Links that connect all linked sets of groups above a block, (grp, doc_id,
    shingles, total) with the shingles of the whole group in ``total``."""
    blocks = F.ceil(F.col("total") / block_shingles)
    number = F.pmod(F.xxhash64("doc_id"), blocks)
    index = large.select(F.struct("grp", number.alias("i")).alias("block"), "grp", "doc_id", "n", "shingles", "total", blocks.alias("blocks"))
    by_chance = F.row_number().over(Window.partitionBy("grp").orderBy(F.xxhash64("doc_id"), "doc_id"))
    pivots = large.withColumn("r", by_chance).where(f"r <= {PIVOTS}").drop("r")

    def over_all_blocks(df: DataFrame) -> DataFrame:
        spread = F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1))
        return df.withColumn("i", spread).select(F.struct("grp", "i").alias("block"), "doc_id", "shingles")

    near = stored(_search_blocks(over_all_blocks(pivots), index.select("block", "doc_id", "shingles"), percent, parts), "near")
    clusters = connected_components(near)
    placed = index.select("grp", "doc_id").join(clusters, F.col("doc_id") == F.col("node"), "left")
    sizes = placed.where("component is not null").groupBy("grp", "component").agg(F.count("*").alias("size"))
    core = sizes.groupBy("grp").agg(F.max_by("component", F.struct("size", "component")).alias("core"))
    rest = placed.join(core, "grp", "left").where("component is null or core is null or component <> core").select("doc_id")
    asking = large.join(rest, "doc_id", "left_semi")
    far = _search_blocks(over_all_blocks(asking), index.select("block", "doc_id", "shingles"), percent, parts)
    return near.union(far)


def jaccard_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    k: int = 5,
    percent: int = 75,
    block_shingles: int = 1 << 16,
    most_bits: int = 36,
    whole_bits: int = 28,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    signed = stored(signatures(rows, k), "signatures")
    classes = signed.where("key is not null and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("first"))
    total = signed.agg(F.sum("n_shingles")).first()[0] or 0
    shipped = _candidates(rows, total, k, percent, most_bits, whole_bits)
    # ids travel to find those that stand for their class; the sets stay where they are
    standing = stored(shipped.select("doc_id").join(classes.select(F.col("first").alias("doc_id")), "doc_id", "left_semi").distinct(), "standing")
    sets = stored(shipped.join(broadcast_if_small(standing), "doc_id", "left_semi"), "sets")
    held = sets.agg(F.sum("n")).first()[0] or 0
    groups = connected_components(_candidate_ties(sets, held, percent, most_bits, whole_bits))
    grouped = sets.select("doc_id", "n").join(groups.toDF("doc_id", "grp"), "doc_id")
    totals = grouped.groupBy("grp").agg(F.sum("n").alias("total"))
    grouped = stored(grouped.join(totals, "grp").select("doc_id", "grp", "total").distinct(), "groups")
    members = sets.join(broadcast_if_small(grouped), "doc_id")
    small = _search_small(members.where(F.col("total") <= block_shingles), percent, parts)
    links = small
    if grouped.where(F.col("total") > block_shingles).limit(1).count():
        large = stored(members.where(F.col("total") > block_shingles), "large")
        links = small.union(_search_large(large, percent, block_shingles, parts))
    joined = connected_components(links).withColumnRenamed("node", "first")
    named = classes.join(joined, "first", "left").select("key", F.coalesce("component", "first").alias("component_id"))
    return signed.join(named, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", F.when(F.col("key").isNull(), F.col("doc_id")))).alias("component_id"),
    )
