"""Approximate nearest neighbours by stable projections and kd-trees.

Unit vectors are projected to ``M`` dimensions by a Gaussian matrix: for two vectors at distance d the
squared projected distance over d^2 is chi-square with ``M`` degrees of freedom.  A kd-tree of the
projected space is fitted on a bounded sample; its cells deal out *all* rows.  A query visits projected
neighbours from near to far and verifies them on the original vectors.  It stops when a vector nearer than
the best found so far would, with probability ``CONFIDENCE``, have projected nearer than everything
not yet visited (the chi-square test).

Spark runs this in two rounds over the same index: the query's own cell gives a first bound, which
tells which other cells the test can't rule out; these are searched next.  Inside a cell (cut into blocks
of ``BLOCK_ROWS``) a small kd-tree gives the near-to-far order.

Equal vectors are one index entry with their smallest ids (``k + 1`` of them: no more can be among the
answers, as ties go to smaller ids), kept by a group limit before the shuffle.  Equal query vectors are
searched once.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import exp

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wattline.llm.common import map_batches, written

M, CONFIDENCE, SEED = 8, 0.98, 11
#: Vectors that the cells are fitted on at most, and of these in a cell at least.
SAMPLE, SAMPLE_CELL = 20_000, 8
#: Entries that a cell is planned for, and entries of a block at most (on average, by hash).
CELL_ROWS, BLOCK_ROWS, BUCKET_ROWS = 4096, 8192, 64


def chi_square_cdf(x: float, m: int = M) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 0.0
    for i in range(m // 2):
        total += term
        term *= x / 2 / (i + 1)
    return 1 - exp(-x / 2) * total


def chi_square_quantile(p: float, m: int = M) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi_square_cdf(mid, m) < p else (lo, mid)
    return hi


def projection(dim: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).normal(size=(dim, M))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


class Tree:
    """kd-tree by medians of the widest dimension: ``lo``/``hi`` boxes of the leaves."""

    def __init__(self, points: np.ndarray, leaves: int, tight: bool):
        self.lo, self.hi, self.rows = [], [], []
        self.split: list[tuple[int, float, int, int]] = []      # inner nodes: dimension, value, children (~leaf)
        self.tight = tight
        inf = np.full(points.shape[1], np.inf)
        self.root = self._build(points, np.arange(len(points)), leaves, -inf, inf)
        self.lo, self.hi = np.array(self.lo), np.array(self.hi)

    def _build(self, points: np.ndarray, rows: np.ndarray, leaves: int, lo: np.ndarray, hi: np.ndarray) -> int:
        p = points[rows]
        spread = p.max(0) - p.min(0) if len(p) else np.zeros(points.shape[1])
        d = int(np.argmax(spread))
        if leaves <= 1 or len(rows) < 2 or spread[d] == 0:
            self.lo.append(p.min(0) if self.tight and len(p) else lo)
            self.hi.append(p.max(0) if self.tight and len(p) else hi)
            self.rows.append(rows)
            return ~(len(self.rows) - 1)
        value = float(np.median(p[:, d]))
        left = p[:, d] < value
        if not left.any():
            left = p[:, d] <= value
            value = float(np.nextafter(value, np.inf))
        node = len(self.split)
        self.split.append((d, value, 0, 0))
        below, above = hi.copy(), lo.copy()
        below[d], above[d] = value, value
        a = self._build(points, rows[left], leaves // 2, lo, below)
        b = self._build(points, rows[~left], leaves - leaves // 2, above, hi)
        self.split[node] = (d, value, a, b)
        return node

    def find(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point."""
        out = np.zeros(len(points), dtype=np.int64)
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = ~node
            elif len(rows):
                d, value, a, b = self.split[node]
                left = points[rows, d] < value
                todo += [(a, rows[left]), (b, rows[~left])]
        return out

    def nearest(self, points: np.ndarray) -> np.ndarray:
        """Squared distance of each point to each leaf's box."""
        out = np.zeros((len(points), len(self.lo)))
        for d in range(self.lo.shape[1]):
            gap = np.maximum(np.maximum(self.lo[None, :, d] - points[:, d, None], points[:, d, None] - self.hi[None, :, d]), 0)
            out += gap * gap
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one dimension as a matrix of doubles."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)


class Block:
    """The entries of one block, searched by projected distance."""

    def __init__(self, x: np.ndarray, ids: list[list[int]]):
        self.x, self.ids = x, ids
        self.u = unit(x)
        self.p = self.u @ projection(x.shape[1])
        tree = Tree(self.p, max(1, len(x) // BUCKET_ROWS), tight=True)
        self.tree, self.size = tree, np.array([len(r) for r in tree.rows])

    def search(self, q: np.ndarray, bound: np.ndarray, want: int, stretch: float) -> Iterator[tuple[int, float, list[tuple[float, int]]]]:
        """For each query: its place, the squared distance of the ``want``-th entry found, (score, id) of the best.

        ``bound`` is a squared distance known to hold ``want`` entries (or infinity).
        """
        uq = unit(q)
        pq = uq @ projection(q.shape[1])
        reach = self.tree.nearest(pq)
        for i in range(len(q)):
            order = np.argsort(reach[i], kind="stable")
            far, best, near, at, step = float(bound[i]), np.zeros(0, np.int64), np.zeros(0), 0, 2
            while at < len(order) and reach[i, order[at]] <= far * stretch:       # else the chi-square test holds
                rows = np.concatenate([self.tree.rows[b] for b in order[at:at + step]])
                at, step = at + step, step * 2
                gap = self.p[rows] - pq[i]
                rows = rows[np.einsum("ij,ij->i", gap, gap) <= far * stretch]
                if not len(rows):
                    continue
                best = np.concatenate([best, rows])
                near = np.concatenate([near, np.maximum(2 - 2 * (self.u[rows] @ uq[i]), 0)])
                if len(near) > want:
                    # ties at the edge stay, as their ids decide
                    edge = np.partition(near, want - 1)[want - 1]
                    stay = near <= edge + 1e-12
                    best, near = best[stay], near[stay]
                if len(near) >= want:
                    far = min(far, float(np.partition(near, want - 1)[want - 1]) + 1e-12)
            norm = np.sqrt(np.dot(q[i], q[i]))
            found = []
            for r in best:
                y = self.x[r]
                found += [(float(np.dot(q[i], y) / (norm * np.sqrt(np.dot(y, y)))), v) for v in self.ids[r]]
            found.sort(key=lambda f: (-f[0], f[1]))
            yield i, far, found[:want]


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not zero."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False)))      # NaN is above infinity
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(x, lambda v: v != 0)


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors with their k + 1 smallest ids."""
    by_vector = Window.partitionBy("vector").orderBy("id")
    return (rows.withColumn("_rank", F.dense_rank().over(by_vector)).where(F.col("_rank") <= k + 1)
            .groupBy("vector").agg(F.array_sort(F.collect_set("id")).alias("ids")))


def _cells(entries: DataFrame) -> dict[int, tuple[int, Tree]]:
    """For each dimension of a bounded sample: number of its first cell, and the tree of its cells."""
    total = entries.count()
    sample = entries.orderBy(F.xxhash64("vector")).limit(SAMPLE).select("vector").toArrow()["vector"].to_pylist()
    by_dim: dict[int, list] = {}
    for v in sample:
        by_dim.setdefault(len(v), []).append(v)
    cells, base = {}, 0
    for dim, vectors in sorted(by_dim.items()):
        rows = total * len(vectors) // max(len(sample), 1)
        leaves = max(1, min(-(-rows // CELL_ROWS), len(vectors) // SAMPLE_CELL))
        tree = Tree(unit(np.array(vectors, dtype=np.float64)) @ projection(dim), leaves, tight=False)
        tree.rows = []
        cells[dim] = base, tree
        base += len(tree.lo)
    return cells


def _place(rows: DataFrame, cells: dict[int, tuple[int, Tree]]) -> DataFrame:
    """Add ``cell`` to rows (vector, ids): the leaf of the vector; -dim for a dimension that the sample missed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.list_value_length(batch.column(0)).to_numpy(zero_copy_only=False)
            cell = -size.astype(np.int64)
            for dim in np.unique(size):
                if int(dim) in cells:
                    base, tree = cells[int(dim)]
                    at = np.flatnonzero(size == dim)
                    cell[at] = base + tree.find(unit(_matrix(batch.column(0).take(pa.array(at)))) @ projection(int(dim)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int64())], [*batch.schema.names, "cell"])

    return rows.transform(map_batches, run, f"{_ddl(rows)}, cell long")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def _search(index: DataFrame, queries: DataFrame, want: int) -> DataFrame:
    """Search queries (query, vector, bound, cell, block) in the blocks of the index (vector, ids, cell, block).

    A partition reads its blocks in order, entries before queries: it holds one block and one batch
    of queries at a time.  Returns (query, far, found: array of (score, id)).
    """
    stretch = chi_square_quantile(CONFIDENCE)
    both = index.select("cell", "block", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("query"),
                        F.lit(0.0).alias("bound"), "ids", "vector").unionByName(
        queries.select("cell", "block", F.lit(1).alias("kind"), "query", "bound",
                       F.lit(None).cast("array<bigint>").alias("ids"), "vector"))
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = both.repartition(n, "cell", "block").sortWithinPartitions("cell", "block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, block = None, [], None
        for batch in batches:
            key = np.stack([batch.column(c).to_numpy() for c in range(3)], axis=1)
            cut = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
            for i, j in zip(np.append(0, cut), np.append(cut, len(key))):
                if not j > i:
                    continue
                part, here = batch.slice(i, j - i), (key[i, 0], key[i, 1])
                if here != at:
                    at, parts, block = here, [], None
                if key[i, 2] == 0:
                    parts.append(part)
                    continue
                if block is None and parts:
                    block = Block(np.concatenate([_matrix(p.column(6)) for p in parts]),
                                  [ids for p in parts for ids in p.column(5).to_pylist()])
                    parts = []
                if block is None:
                    continue
                query = part.column(3).to_pylist()
                out = [(query[w], far, [{"score": s, "id": v} for s, v in found]) for w, far, found in
                       block.search(_matrix(part.column(6)), part.column(4).to_numpy(), want, stretch)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.float64()),
                     pa.array([o[2] for o in out], pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64())])))],
                    ["query", "far", "found"])

    return dealt.transform(map_batches, run, "query long, far double, found array<struct<score: double, id: bigint>>")


def _visits(queries: DataFrame, cells: dict[int, tuple[int, Tree]], blocks: dict[int, int], home: bool) -> DataFrame:
    """Cells and blocks that each query (query, vector, bound, cell) visits: its own cell, or the
    others that the chi-square test can't rule out at its bound."""
    stretch = chi_square_quantile(CONFIDENCE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
            bound, own = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            rows, to = [], []
            if home:
                rows, to = [np.arange(len(own))], [own]
            else:
                for dim in np.unique(size):
                    if int(dim) not in cells:
                        continue
                    base, tree = cells[int(dim)]
                    at = np.flatnonzero(size == dim)
                    p = unit(_matrix(batch.column(1).take(pa.array(at)))) @ projection(int(dim))
                    q, c = np.nonzero(tree.nearest(p) <= bound[at][:, None] * stretch)
                    other = base + c != own[at[q]]
                    rows.append(at[q][other])
                    to.append(base + c[other])
            rows = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            to = np.concatenate(to) if to else np.zeros(0, np.int64)
            n = np.array([blocks.get(int(c), 0) for c in to], dtype=np.int64)
            rows, to = np.repeat(rows, n), np.repeat(to, n)
            block = np.arange(len(to)) - np.repeat(np.cumsum(n) - n, n)
            for i in range(0, len(rows), 4096):
                w = slice(i, i + 4096)
                take = batch.select([0, 1, 2]).take(pa.array(rows[w]))
                yield pa.RecordBatch.from_arrays([*take.columns, pa.array(to[w], pa.int64()), pa.array(block[w], pa.int64())],
                                                 ["query", "vector", "bound", "cell", "block"])

    rows = queries.select("query", "vector", "bound", "cell")
    kind = dict(rows.dtypes)["vector"]
    return rows.transform(map_batches, run, f"query long, vector {kind}, bound double, cell long, block long")


def nearest(table: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` rows of largest cosine found for each query: ``query_id``, ``rank`` (from 1), id, ``score``.

    Rows with a null id, a null, empty or zero vector or a component that is null or not finite take no
    part.  Vectors meet those of their own dimension only.  Ties go to smaller ids; repeated rows
    count once; an id with several vectors has its best score.  Fewer candidates than ``k`` are all returned.
    Tables without usable rows give no rows.  Other columns are read only through ``is_query``.
    """
    rows = (table.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("asks")))
    entries = written(_entries(rows, k), "ann-entries")
    cells = _cells(entries)
    placed = written(_place(entries, cells), "ann-placed")
    blocks = {r["cell"]: -(-r["count"] // BLOCK_ROWS) for r in placed.groupBy("cell").count().collect()}  # a row a cell
    per_cell = F.create_map(*[F.lit(x) for kv in (blocks or {0: 1}).items() for x in kv])
    index = placed.withColumn("block", F.pmod(F.xxhash64("vector"), F.element_at(per_cell, F.col("cell"))))

    # numbered once, by the write; equal query vectors are one search
    asked = rows.where("asks").select("vector").distinct().withColumn("query", F.monotonically_increasing_id())
    queries = written(_place(asked.select("vector", "query"), cells).withColumn("bound", F.lit(float("inf"))), "ann-queries")
    first = written(_search(index, _visits(queries, cells, blocks, home=True), k + 1), "ann-home")
    bounds = first.groupBy(F.col("query").alias("_query")).agg(F.min("far").alias("_far"))
    bounded = (queries.drop("bound").join(bounds, F.col("query") == F.col("_query"), "left")
               .withColumn("bound", F.coalesce("_far", F.lit(float("inf")))))
    second = _search(index, _visits(bounded, cells, blocks, home=False), k + 1)
    found = (first.unionByName(second).select("query", F.explode("found").alias("f"))
             .groupBy("query", F.col("f.id").alias("id")).agg(F.max("f.score").alias("score")))
    by_query = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    best = written(found.withColumn("_rank", F.row_number().over(by_query)).where(F.col("_rank") <= k + 1).drop("_rank")
                   .join(queries.select("query", "vector"), "query").select("vector", "id", "score"), "ann-best")
    asking = rows.where("asks").select(F.col("id").alias("query_id"), "vector").distinct()
    mine = asking.join(best, "vector").where(F.col("id") != F.col("query_id"))
    mine = mine.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (mine.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
