"""Exact top-k inner products by best-first search of M-trees.

Vectors become integers, floor(scale * x).  Two of them with distance d have the
product (|q|^2 + |x|^2 - d^2) / 2, so what bounds a distance from below bounds a
product from above.

* Cells: up to ``CELLS`` pivots are picked, each far from those before, in a
  sample of ``SAMPLE`` vectors with the smallest hashes; every vector belongs to
  the nearest pivot.  Per cell the covering radius, the greatest length and the
  number of rows go to the driver.
* Trees: a cell is dealt into trees of about ``TREE_ROWS`` vectors, however many
  of them are alike.  A tree is a row of the index table: leaf pages of up to
  ``PAGE`` vectors, each with its distance to the page's pivot, and routing
  nodes of up to ``FAN`` pages with pivot, covering radius, greatest length and
  the distance to the parent's pivot.
* Search: queries travel in blocks.  Each is first answered by one tree of its
  most promising cell, which gives it a floor; then it visits every cell whose
  bound reaches that floor.  In a tree nodes are taken from a heap, best bound
  first; |d(q, parent) - d(parent, child)| rules out children and vectors
  without computing their distances, and the search ends at the first node whose
  bound is below the k-th best score.

The sample only places the pivots; every vector is in a tree, and bounds leave
room for rounding, so the result is exact whatever the pivots are.

Vectors that are null or hold nulls, NaN or infinities take no part, nor do
those with a squared length of 2**62 and more, whose scores no long may hold.
Vectors may differ in length: shorter ones count as followed by zeros; empty
ones score 0 with all.  Every row is a vector of its own: rows with equal ids or
vectors are candidates for one another, a row is only kept from itself.  Ties go
to the smaller id, null ids come last and are no queries.  With fewer candidates
than ``k`` all are returned; an empty table gives no rows.  Extra columns are
ignored.  A task holds a block of queries and a batch of trees at a time.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from heapq import heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staging import staged
from .vectors import narrow, whole_numbers

SCALE = 256
TOP = 5
EVERY = 50
SAMPLE = 1024
CELLS = 64
TREE_ROWS = 4096
PAGE = 128
FAN = 16
BLOCK = 512
ROOM = 1e-6  # of the lengths: more than rounding may move a distance
LONGEST = 2.0 ** 62


def fitted(values: np.ndarray, width: int) -> np.ndarray:
    return values if values.shape[1] == width else np.pad(values, ((0, 0), (0, width - values.shape[1])))


def _exact(*sides: np.ndarray) -> list[np.ndarray]:
    """The sides in the fastest type that holds all their products: floats up to 2**53, else int64."""
    width = max(s.shape[-1] for s in sides)
    longest = max(float((s.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) for s in sides)
    kind = np.float64 if longest < 2 ** 52 else np.int64
    return [fitted(s, width).astype(kind) for s in sides]


def _distance(squares_a, squares_b, dots) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, squares_a + squares_b - 2.0 * dots))


def _bound(square: float, length, least) -> np.ndarray:
    """The greatest product of a query with a vector of at most ``length`` at least ``least`` away."""
    size = np.sqrt(square)
    near = np.maximum(0.0, least - ROOM * (size + length))
    most = np.minimum((square + length * length - near * near) / 2, size * length)
    return most + ROOM * (1 + size * length)


class Tree:
    """Vectors in the order of their leaf pages, and the nodes; the last node is the root."""

    FIELDS = ("vectors", "ids", "known", "rows", "far", "pivot", "radius", "length", "to_parent", "first", "last", "leaves")

    def __init__(self, **fields):
        self.__dict__.update(fields)
        self.computed = 0  # products that were computed

    @classmethod
    def build(cls, vectors: np.ndarray, ids: np.ndarray, known: np.ndarray, rows: np.ndarray, page: int = PAGE, fan: int = FAN) -> Tree:
        v, = _exact(vectors)
        squares = (v.astype(np.float64) ** 2).sum(axis=1)

        def away(index, p):
            return _distance(squares[index], squares[p], v[index] @ v[p])

        pages, open_ = [], [np.arange(len(v))]
        while open_:  # halves of equal size, each nearer to one of two distant vectors
            index = open_.pop()
            if len(index) <= page:
                pages.append(index)
                continue
            a = index[away(index, index[0]).argmax()]
            to_a = away(index, a)
            b = index[to_a.argmax()]
            index = index[np.argsort(to_a - away(index, b), kind="stable")]
            open_ += [index[len(index) // 2:], index[:len(index) // 2]]
        order = np.concatenate(pages)
        v, squares = v[order], squares[order]
        ends = np.cumsum([len(p) for p in pages])
        level = [(int(e - len(p)), int(e), int(e - len(p)), int(e)) for e, p in zip(ends, pages)]  # vectors, children
        far = np.zeros(len(v))
        nodes, pivots, radius, length, to_parent = [], [], [], [], []
        leaves = True
        while True:
            begin = len(nodes)
            for a, b, first, last in level:
                index = np.arange(a, b)
                centre = v[a:b].mean(axis=0)
                p = a + int(((v[a:b] - centre) ** 2).sum(axis=1).argmin())
                own = away(index, p)
                if leaves:
                    far[a:b] = own
                else:
                    to_parent[first:last] = away(np.array(pivots[first:last]), p).tolist()
                nodes.append((a, b, first, last))
                pivots.append(p)
                radius.append(float(own.max()))
                length.append(float(np.sqrt(squares[a:b].max())))
                to_parent.append(0.0)
            if leaves:
                n_leaves, leaves = len(nodes), False
            if len(nodes) - begin == 1:
                break
            level = [(nodes[i][0], nodes[min(i + fan, len(nodes)) - 1][1], i, min(i + fan, len(nodes)))
                     for i in range(begin, len(nodes), fan)]
        return cls(vectors=narrow(vectors[order]), ids=ids[order], known=known[order], rows=rows[order], far=far,
                   pivot=np.array(pivots), radius=np.array(radius), length=np.array(length), to_parent=np.array(to_parent),
                   first=np.array([n[2] for n in nodes]), last=np.array([n[3] for n in nodes]), leaves=np.array(n_leaves))

    def pack(self) -> bytes:
        return packed(**{f: getattr(self, f) for f in self.FIELDS})

    def prepare(self, queries: np.ndarray) -> np.ndarray:
        """Bring vectors and queries to one type and length; returns the queries."""
        self.v, q = _exact(self.vectors, queries)
        self.lengths = np.sqrt((self.v.astype(np.float64) ** 2).sum(axis=1))
        return q

    def best(self, q: np.ndarray, own: int, k: int, floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of the ``k`` best vectors of the tree for a prepared query,
        without row ``own`` and those with scores below ``floor``."""
        square = float((q.astype(np.float64) ** 2).sum())
        root = len(self.pivot) - 1
        far = _distance(square, self.lengths[self.pivot[root]] ** 2, float(self.v[self.pivot[root]] @ q))
        heap = [(-float(_bound(square, self.length[root], far - self.radius[root])), root, far)]
        places, scores = np.zeros(0, np.int64), np.zeros(0, self.v.dtype)
        while heap:
            most, node, far = heappop(heap)
            if -most < floor:
                break
            a, b = self.first[node], self.last[node]
            if node < self.leaves:
                least = np.abs(far - self.far[a:b])
                at = a + np.flatnonzero((_bound(square, self.lengths[a:b], least) >= floor) & (self.rows[a:b] != own))
                found = self.v[at] @ q
                self.computed += len(at)
                places, scores = np.concatenate([places, at]), np.concatenate([scores, found])
                if len(places) > k:
                    first = np.lexsort((self.ids[places], ~self.known[places], -scores))[:k]
                    places, scores = places[first], scores[first]
                if len(scores) == k:
                    floor = max(floor, float(scores.min()) if abs(scores.min()) < 2 ** 53 else np.nextafter(float(scores.min()), -np.inf))
            else:
                least = np.abs(far - self.to_parent[a:b]) - self.radius[a:b]
                at = a + np.flatnonzero(_bound(square, self.length[a:b], least) >= floor)
                pivots = self.pivot[at]
                away = _distance(square, self.lengths[pivots] ** 2, (self.v[pivots] @ q).astype(np.float64))
                self.computed += len(at)
                bounds = _bound(square, self.length[at], away - self.radius[at])
                for x, n, d in zip(bounds.tolist(), at.tolist(), away.tolist()):
                    if x >= floor:
                        heappush(heap, (-x, n, d))
        kept = scores >= floor
        return places[kept], scores[kept]


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(raw: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(raw)) as found:
        return {f: found[f] for f in found.files}


class Cells(NamedTuple):
    """The directory: at most ``CELLS`` rows."""

    pivots: np.ndarray
    radius: np.ndarray
    length: np.ndarray
    parts: np.ndarray


class Index(NamedTuple):
    rows: DataFrame  # row, vec_id, v, cell
    cells: Cells
    trees: DataFrame  # cell, part, tree


def _lists(column: pa.Array) -> np.ndarray:
    return whole_numbers(column, 1)[1]


def _list_array(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.reshape(-1)))


def _taking_part(batch: pa.RecordBatch, scale: int) -> tuple[pa.RecordBatch, np.ndarray]:
    rows, values = whole_numbers(batch.column("vector"), scale)
    short = (values.astype(np.float64) ** 2).sum(axis=1) < LONGEST
    return batch.take(pa.array(rows[short])), values[short]


def _pivots(vectors: DataFrame, scale: int) -> np.ndarray:
    """Vectors of the sample, each the farthest from those before it."""
    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_list_array(_taking_part(batch, scale)[1])], ["v"])

    found = vectors.mapInArrow(integers, "v array<long>").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    if not found:
        return np.zeros((0, 0), np.int64)
    width = max(len(r["v"]) for r in found)
    sample = np.array([r["v"] + [0] * (width - len(r["v"])) for r in found], np.int64).reshape(len(found), width)
    v = sample.astype(np.float64)
    chosen, away = [0], ((v - v[0]) ** 2).sum(axis=1)
    while len(chosen) < CELLS and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, ((v - v[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE,
                tree_rows: int = TREE_ROWS, page: int = PAGE) -> Index:
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    pivots = _pivots(given, scale)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in batches:
            batch, values = _taking_part(batch, scale)
            if not batch.num_rows:
                continue
            v, p = _exact(values, pivots)
            squares, own = ((x.astype(np.float64) ** 2).sum(axis=1) for x in (v, p))
            away = _distance(squares[:, None], own[None, :], (v @ p.T).astype(np.float64))
            cell = away.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number + np.arange(len(values))), batch.column("vec_id"), _list_array(values), pa.array(cell, pa.int32()),
                 pa.array(away[np.arange(len(cell)), cell]), pa.array(np.sqrt(squares))], ["row", "vec_id", "v", "cell", "away", "length"])
            number += len(values)

    rows = staged(given.mapInArrow(deal, "row long, vec_id long, v array<long>, cell int, away double, length double"), "vectors")
    radius, length, parts = np.zeros(len(pivots)), np.zeros(len(pivots)), np.ones(len(pivots), np.int64)
    for r in rows.groupBy("cell").agg(F.max("away").alias("away"), F.max("length").alias("length"), F.count(F.lit(1)).alias("n")).collect():
        radius[r["cell"]], length[r["cell"]], parts[r["cell"]] = r["away"], r["length"], -(-r["n"] // tree_rows)

    def grow(key: tuple, group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").combine_chunks()
        tree = Tree.build(_lists(group.column("v")), ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False),
                          group.column("row").to_numpy(), page)
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()),
                         "tree": pa.array([tree.pack()], pa.binary())})

    of_cell = F.element_at(F.array(*[F.lit(int(n)) for n in parts] or [F.lit(1)]), F.col("cell") + 1)
    trees = staged(rows.select("row", "vec_id", "v", "cell", F.pmod(F.xxhash64("row"), of_cell).cast("long").alias("part"))
                   .groupBy("cell", "part").applyInArrow(grow, "cell int, part long, tree binary"), "trees")
    return Index(rows, Cells(pivots, radius, length, parts), trees)


def _blocks(queries: DataFrame, cells: Cells, first: bool) -> DataFrame:
    """(cell, part, block): the queries that visit a cell, in blocks.  ``first``: only
    the most promising cell of each, and one part of it; else every cell that may
    hold scores from the floor on."""
    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                some = batch.slice(at, BLOCK)
                values, row, ids = _lists(some.column("v")), some.column("row").to_numpy(), some.column("vec_id").to_numpy()
                floor = some.column("floor").fill_null(-np.inf).to_numpy(zero_copy_only=False)
                q, p = _exact(values, cells.pivots)
                squares, own = ((x.astype(np.float64) ** 2).sum(axis=1) for x in (q, p))
                away = _distance(squares[:, None], own[None, :], (q @ p.T).astype(np.float64))
                most = _bound(squares[:, None], cells.length[None, :], away - cells.radius[None, :])
                best = most.argmax(axis=1)
                for c in range(len(cells.radius)):
                    going = np.flatnonzero(best == c) if first else np.flatnonzero(most[:, c] >= floor)
                    part = row[going] % cells.parts[c] if first else np.zeros(len(going), np.int64)
                    for x in np.unique(part):
                        own_ = going[part == x]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([c], pa.int32()), pa.array([x], pa.int64()),
                             pa.array([packed(v=narrow(values[own_]), row=row[own_], ids=ids[own_], floor=floor[own_])], pa.binary())],
                            ["cell", "part", "block"])

    return queries.mapInArrow(visit, "cell int, part long, block binary")


def _answers(visits: DataFrame, k: int) -> DataFrame:
    """(row, query_id, vec_id, score) of the best of each tree for each query of a block."""
    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree, block = Tree(**unpacked(batch.column("tree")[i].as_py())), unpacked(batch.column("block")[i].as_py())
                queries = tree.prepare(block["v"])
                found = [tree.best(q, own, k, floor) for q, own, floor in zip(queries, block["row"], block["floor"])]
                who = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
                places = np.concatenate([p for p, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(block["row"][who]), pa.array(block["ids"][who]), pa.array(tree.ids[places], pa.int64(), mask=~tree.known[places]),
                     pa.array(np.concatenate([s for _, s in found]).astype(np.int64))], ["row", "query_id", "vec_id", "score"])

    return visits.select("tree", "block").mapInArrow(answer, "row long, query_id long, vec_id long, score long")


def search(index: Index, queries: DataFrame, k: int = TOP) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best of all rows of the index for
    each of ``queries``, rows of it (row, vec_id, v)."""
    queries = queries.select("row", "vec_id", "v")
    parts = max(1, -(-queries.count() // BLOCK))
    dealt = queries.repartition(parts)
    begin = _blocks(dealt.withColumn("floor", F.lit(None).cast("double")), index.cells, True)
    sure = staged(_answers(begin.join(index.trees, ["cell", "part"]), k).groupBy("row")
                  .agg(F.when(F.count(F.lit(1)) == k, F.min("score").cast("double") - F.abs(F.min("score")) * 1e-15).alias("floor")), "floors")
    again = queries.join(sure, "row", "left").repartition(parts)
    found = staged(_answers(_blocks(again, index.cells, False).drop("part").join(index.trees, "cell"), k), "answers")
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op12_metric_tree(spark, sf_dir: str) -> DataFrame:
    """The 5 best of all ``embeddings`` for every row whose id is divisible by 50."""
    index = build_index(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return search(index, index.rows.filter(F.col("vec_id") % EVERY == 0))


OP12_SQL = f"""
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM ints q JOIN ints c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored
QUALIFY rank <= {TOP}
"""
