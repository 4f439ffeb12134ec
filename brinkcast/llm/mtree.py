"""Exact top-k by inner product over an M-tree.

The tree works on a metric: with ``most`` the largest squared length of a vector,
``x`` becomes ``(x, sqrt(most - |x|^2))`` and a query ``(q, 0)``; then
``distance^2 = |q|^2 + most - 2 * (inner product)``, so the nearest are the best.

The root's routing objects are at most ``roots`` vectors, chosen by hash.  Every
vector goes to the nearest; what one attracts is cut into blocks of bounded size.
Each block is a subtree of pages: an inner page holds routing objects with their
covering radius, the smallest id below and the distance to the routing object
above; a leaf page holds vectors with that distance.  Pages are rows of a table.

A query is searched best first: pages wait by the largest inner product that
their ball allows, and the search of a block ends when that falls below the k-th
best so far.  Within a page the stored distances exclude entries before anything
is computed.  First a query visits the blocks of its nearest root object, then,
with the k-th best found there, those whose ball may hold better ones.

Vectors are integers, so scores are exact; bounds are floating and taken with a
margin.  Equal vectors are one entry with their ``k + 1`` smallest ids, which is
all that can be asked of them, so a vector that a third of all rows share weighs
nothing.  Null vectors, those with null or non-finite components, rows without
id, and vectors of another length than most (ties: the longer) take no part.
Repeated rows count once.  Ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brinkcast.llm.arrow import runs_of
from brinkcast.llm.storage import stored

#: Entries of a page, of a block, queries that a task runs on a block.
PAGE, BLOCK, ASKED = 256, 4096, 1024
MARGIN = 1e-6


def scaled(vector: str, factor: int = 64) -> Column:
    """Components times ``factor``, rounded down; null where the vector is no vector."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(fine, F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long")))


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(float).reshape(-1, dims)


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    """The last coordinate, which makes all lengths equal."""
    return np.sqrt(np.maximum(0, most - (x * x).sum(axis=1)))


def _distances(x: np.ndarray, lx: np.ndarray, y: np.ndarray, ly: np.ndarray) -> np.ndarray:
    a, b = np.column_stack([x, lx]), np.column_stack([y, ly])
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(0, square))


def build_pages(x: np.ndarray, ids: list[list[int]], above: np.ndarray, most: float) -> list[dict]:
    """Pages of a subtree below the routing object ``above``; the first is its root."""
    lift, least = _lift(x, most), np.array([i[0] for i in ids])
    pages: list[dict] = []

    def page(rows: np.ndarray, over: np.ndarray) -> int:
        number = len(pages)
        pages.append({})
        over_lift = _lift(over[None, :], most)
        if len(rows) <= PAGE:
            up = _distances(x[rows], lift[rows], over[None, :], over_lift)[:, 0]
            pages[number] = {"leaf": True, "vectors": x[rows], "up": up, "radius": np.zeros(len(rows)), "least": least[rows], "ids": [ids[r] for r in rows]}
            return number
        seeds = rows[np.linspace(0, len(rows) - 1, min(PAGE, -(-len(rows) // (PAGE // 2)))).astype(int)]
        d = _distances(x[rows], lift[rows], x[seeds], lift[seeds])
        near = d.argmin(axis=1)
        if (near == near[0]).all():  # nothing to tell them apart by
            near = np.arange(len(rows)) % len(seeds)
        used = np.unique(near)
        below = [rows[near == s] for s in used]
        pages[number] = {
            "leaf": False,
            "vectors": x[seeds[used]],
            "up": _distances(x[seeds[used]], lift[seeds[used]], over[None, :], over_lift)[:, 0],
            "radius": np.array([d[near == s, s].max() for s in used]),
            "least": np.array([least[b].min() for b in below]),
            "ids": [[page(b, x[seeds[s]])] for s, b in zip(used, below)],
        }
        return number

    page(np.arange(len(x)), above)
    return pages


class Best:
    """The ``k`` best (score, id) so far."""

    def __init__(self, k: int, score: float, doc: int):
        self.k, self.rows, self.score, self.id = k, [], score, doc

    def add(self, rows: list[tuple[float, int]]) -> None:
        self.rows = sorted(self.rows + rows, key=lambda r: (-r[0], r[1]))[: self.k]
        if len(self.rows) == self.k:
            last = self.rows[-1]
            if (last[0], -last[1]) > (self.score, -self.id):
                self.score, self.id = last

    def closed(self, bound: float, least: int) -> bool:
        """Nothing at or below ``bound`` with ids from ``least`` can get in."""
        return bound < self.score or (bound == self.score and least > self.id)


def search(pages: list[dict], q: np.ndarray, over: np.ndarray, most: float, best: Best) -> None:
    """Best-first search of one subtree; ``over`` is the routing object above it."""
    qq = float(q @ q) + most
    waiting = [(-float("inf"), 0, 0, float(np.sqrt(max(0.0, qq - 2 * float(q @ over)))))]
    while waiting:
        bound, least, number, up = heapq.heappop(waiting)
        if best.closed(-bound, least):
            if -bound < best.score:
                return
            continue
        page = pages[number]
        reach = np.sqrt(max(0.0, qq - 2 * best.score)) + MARGIN if best.score > -float("inf") else float("inf")
        near = np.flatnonzero(np.abs(up - page["up"]) - page["radius"] <= reach)
        if not len(near):
            continue
        score = page["vectors"][near] @ q
        if page["leaf"]:
            good = np.flatnonzero(score >= best.score)
            rows = [(s, i) for j in good.tolist() for s in (float(score[j]),) for i in page["ids"][near[j]]]
            if rows:
                best.add(rows)
        else:
            d = np.sqrt(np.maximum(0, qq - 2 * score))
            gap = np.maximum(0, d - page["radius"][near] - MARGIN)
            most_below = np.floor((qq - gap * gap) / 2 + MARGIN)
            for j in np.flatnonzero(most_below >= best.score).tolist():
                entry = int(near[j])
                heapq.heappush(waiting, (-float(most_below[j]), int(page["least"][entry]), page["ids"][entry][0], float(d[j])))


class Index:
    """Table of pages, with the root's routing objects."""

    def __init__(self, pages: DataFrame, roots: np.ndarray, blocks: np.ndarray, radius: np.ndarray, least: np.ndarray, most: float):
        self.pages, self.roots, self.blocks = pages, roots, blocks
        self.radius, self.least, self.most = radius, least, most


PAGES = "block struct<root:int,part:int>, page int, leaf boolean, vectors binary, up binary, radius binary, least binary, ids array<array<long>>"


def build_index(entries: DataFrame, dims: int, most: float, roots: int = 256, block: int = BLOCK) -> Index:
    """``entries`` (v: array<long>, ids: array<long>), stored, as an M-tree."""
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = entries.count()
    chosen = entries.select("v").orderBy(F.xxhash64("v"), "v").limit(min(roots, -(-n // (block // 2)) or 1)).collect()
    root = np.array([r.v for r in chosen], float).reshape(-1, dims)
    lift = _lift(root, most)

    def route(batches):
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            d = _distances(x, _lift(x, most), root, lift)
            near = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.int32()), pa.array(d[np.arange(len(x)), near])], ["v", "ids", "root", "d"]
            )

    routed = stored(entries.select("v", "ids").mapInArrow(route, "v array<long>, ids array<long>, root int, d double"), "routed")
    sizes = routed.groupBy("root").agg(F.count("*").alias("n"), F.max("d").alias("d"), F.min(F.col("ids")[0]).alias("i")).collect()
    blocks, radius, least = np.zeros(len(root), int), np.full(len(root), -1.0), np.zeros(len(root), int)
    for r in sizes:
        blocks[r.root], radius[r.root], least[r.root] = -(-r.n // block), r.d, r.i

    def build(rows):
        x = np.array([r[1] for r in rows], float)
        number = rows[0][0]
        pages = build_pages(x, [r[2] for r in rows], root[number["root"]], most)
        yield pa.RecordBatch.from_pylist(
            [
                {
                    "block": number, "page": i, "leaf": p["leaf"], "vectors": p["vectors"].astype("<f8").tobytes(),
                    "up": p["up"].astype("<f8").tobytes(), "radius": p["radius"].astype("<f8").tobytes(),
                    "least": p["least"].astype("<i8").tobytes(), "ids": p["ids"],
                }
                for i, p in enumerate(pages)
            ],
            schema=pa.schema(
                [
                    ("block", pa.struct([("root", pa.int32()), ("part", pa.int32())])), ("page", pa.int32()), ("leaf", pa.bool_()),
                    ("vectors", pa.binary()), ("up", pa.binary()), ("radius", pa.binary()), ("least", pa.binary()),
                    ("ids", pa.list_(pa.list_(pa.int64()))),
                ]
            ),
        )

    count = F.element_at(F.array(*[F.lit(int(b)) for b in blocks]), F.col("root") + 1) if len(root) else F.lit(1)
    part = F.pmod(F.xxhash64("v"), count).cast("int")
    pages = (
        routed.select(F.struct("root", part.alias("part")).alias("block"), "v", "ids")
        .repartition(parts, "block")
        .sortWithinPartitions("block")
        .mapInArrow(lambda batches: runs_of(batches, 0, build), PAGES)
    )
    return Index(stored(pages, "pages"), root, blocks, radius, least, most)


def _visit(index: Index, asked: DataFrame, k: int, dims: int, parts: int) -> DataFrame:
    """``asked`` (root, qid, v, score, id) to the best (qid, id, score) in all blocks of
    the root; (score, id) is what has to be beaten."""
    root, most = index.roots, index.most
    counts = {r.root: r.n for r in asked.groupBy("root").agg(F.count("*").alias("n")).collect()}  # at most one row a root
    if not counts:
        return asked.select("qid", F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("score")).where("false")
    per = F.array(*[F.lit(-(-counts.get(i, 0) // ASKED)) for i in range(len(root))])
    blocks = F.array(*[F.lit(int(b)) for b in index.blocks])
    slices = F.element_at(per, F.col("root") + 1)
    queries = (
        asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.element_at(blocks, F.col("root") + 1) - 1)))
        .withColumn("slice", F.pmod(F.xxhash64("qid"), slices).cast("int"))
        .select(F.struct("root", "part", "slice").alias("task"), F.lit(True).alias("asks"), "qid", "v", "score", "id")
    )
    pages = index.pages.select("block.root", "block.part", "page", "leaf", "vectors", "up", "radius", "least", "ids")
    pages = pages.where(slices > 0).withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1)))
    pages = pages.select(F.struct("root", "part", "slice").alias("task"), "page", "leaf", "vectors", "up", "radius", "least", "ids")
    both = pages.withColumn("asks", F.lit(False)).unionByName(queries, allowMissingColumns=True)

    def run(rows):
        pages: dict[int, dict] = {}
        out = []
        over = root[rows[0][0]["root"]]
        for _, asks, number, leaf, vectors, up, radius, least, ids, qid, v, score, doc in rows:
            if not asks:
                pages[number] = {
                    "leaf": leaf, "vectors": np.frombuffer(vectors, "<f8").reshape(-1, dims), "up": np.frombuffer(up, "<f8"),
                    "radius": np.frombuffer(radius, "<f8"), "least": np.frombuffer(least, "<i8"), "ids": ids,
                }
            elif pages:
                best = Best(k, -float("inf") if score is None else score, doc or 0)
                search(pages, np.array(v, float), over, most, best)
                out += [(qid, i, int(s)) for s, i in best.rows]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["qid", "id", "score"])

    return (
        both.select("task", "asks", "page", "leaf", "vectors", "up", "radius", "least", "ids", "qid", "v", "score", "id")
        .repartition(parts, "task")
        .sortWithinPartitions("task", "asks")
        .mapInArrow(lambda batches: runs_of(batches, 0, run), "qid long, id long, score long")
    )


def _top(found: DataFrame, k: int, by: str) -> DataFrame:
    order = Window.partitionBy(by).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 20, roots: int = 256, block: int = BLOCK) -> DataFrame:
    """For every row of ``queries`` (vec_id, v) the ``k`` best of ``vectors`` (vec_id, v),
    its own id excepted: (query_id, rank, vec_id, score); ``v`` is array<long>."""
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    valid = "vec_id is not null and v is not null"
    square = F.aggregate("v", F.lit(0).cast("long"), lambda s, x: s + x * x)
    lengths = vectors.where(valid).groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.max(square).alias("most"))
    usual = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    dims, most = (usual.d, float(usual.most)) if usual else (0, 0.0)
    valid = f"{valid} and size(v) = {dims}"
    by_id = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    first = vectors.where(valid).select("vec_id", "v").withColumn("_r", by_id).where(F.col("_r") <= k + 1)
    entries = stored(first.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids")), "entries")
    asked = queries.where(valid).select("vec_id", "v").distinct()
    distinct = stored(asked.groupBy("v").agg(F.min("vec_id").alias("qid")), "asked")
    if not usual or dims == 0:
        return asked.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).where("false")
    index = build_index(entries, dims, most, roots, block)
    root, radius, least, blocks = index.roots, index.radius, index.least, index.blocks

    def route(first: bool):
        def go(batches):
            for batch in batches:
                q = _matrix(batch.column(1), dims)
                qq = (q * q).sum(axis=1)[:, None] + most
                d = np.sqrt(np.maximum(0, qq - 2 * q @ root.T))
                near = np.where(blocks > 0, d, np.inf).argmin(axis=1)
                go_there = np.zeros(d.shape, bool)
                if first:
                    go_there[np.arange(len(q)), near] = True
                else:
                    score = batch.column(2).to_numpy(zero_copy_only=False).astype(float)[:, None]
                    last = np.asarray(batch.column(3).fill_null(0))[:, None]
                    gap = np.maximum(0, d - radius - MARGIN)
                    bound = np.floor((qq - gap * gap) / 2 + MARGIN)
                    open_ = np.isnan(score) | (bound > score) | ((bound == score) & (least <= last))
                    go_there = open_ & (blocks > 0)
                    go_there[np.arange(len(q)), near] = False
                row, to = np.nonzero(go_there)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int32()), *[c.take(pa.array(row)) for c in batch.columns]], ["root", "qid", "v", "score", "id"]
                )

        return go

    none = F.lit(None).cast("long")
    schema = "root int, qid long, v array<long>, score long, id long"
    near = distinct.select("qid", "v", none.alias("score"), none.alias("id")).mapInArrow(route(True), schema)
    one = stored(_visit(index, stored(near, "near"), k + 1, dims, parts), "first")
    floor = _top(one, k + 1, "qid").where(F.col("rank") == k + 1).select("qid", "score", "id")
    far = distinct.join(floor, "qid", "left").select("qid", "v", "score", "id").mapInArrow(route(False), schema)
    two = _visit(index, stored(far, "far"), k + 1, dims, parts)
    best = _top(one.union(two), k + 1, "qid").drop("rank")
    who = asked.join(distinct, "v").select(F.col("vec_id").alias("query_id"), "qid")
    ranked = _top(who.join(best, "qid").where("id <> query_id"), k, "query_id")
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
