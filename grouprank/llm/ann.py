"""Approximate nearest neighbours by a forest of random-projection trees (operator 2)."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grouprank.llm.common import written

#: Rows that the trees are fitted on at most; a leaf holds so many of those, or more if a tree would have too many leaves.
SAMPLE_ROWS = 50_000
LEAF_ROWS = 256
LEAVES = 64
TREES = 4
#: Rows that a query's leaves hold, summed over the trees: so many times the index, and so many at least.
SEARCHED = 1.4
SEARCHED_ROWS = 8192
#: Rows of a leaf, and queries, that are compared in one task.
LEAF_BLOCK = 65_536
QUERY_BLOCK = 2048


@dataclass
class Tree:
    """Nodes of one tree: a unit direction and a threshold each; children's numbers, or -1 - leaf."""
    directions: np.ndarray
    thresholds: np.ndarray
    children: np.ndarray

    def leaves(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        at = np.zeros(len(points), dtype=np.int64) if len(self.thresholds) else np.full(len(points), -1)
        while (inner := np.flatnonzero(at >= 0)).size:
            node = at[inner]
            side = (np.einsum("ij,ij->i", points[inner], self.directions[node]) > self.thresholds[node]).astype(int)
            at[inner] = self.children[node, side]
        return -1 - at


def grow(points: np.ndarray, leaf_rows: int, seed: int) -> Tree:
    """Split at the median of a random projection until a leaf holds leaf_rows of the fitted points at most."""
    draw = np.random.default_rng(seed)
    directions, thresholds, children, n_leaves = [], [], [], 0
    todo = [(np.arange(len(points)), -1, 0)]
    while todo:
        rows, parent, side = todo.pop()
        cut = None
        if len(rows) > leaf_rows:
            a, b = points[draw.choice(rows, 2, replace=False)]
            for direction in (a - b, draw.standard_normal(points.shape[1])):
                if (norm := np.linalg.norm(direction)) > 1e-9:
                    along = points[rows] @ (direction / norm)
                    middle = float(np.median(along))
                    above = along > middle
                    if above.any() and not above.all():
                        cut = (direction / norm, middle, above)
                        break
        if cut is None:
            name, n_leaves = -1 - n_leaves, n_leaves + 1
        else:
            name = len(directions)
            directions.append(cut[0])
            thresholds.append(cut[1])
            children.append([0, 0])
            todo += [(rows[cut[2]], name, 1), (rows[~cut[2]], name, 0)]
        if parent >= 0:
            children[parent][side] = name
    width = points.shape[1]
    return Tree(np.array(directions).reshape(-1, width), np.array(thresholds), np.array(children, dtype=np.int64).reshape(-1, 2))


def visited(trees: list[Tree], held: list[np.ndarray], point: np.ndarray, wanted: int) -> list[tuple[int, int]]:
    """(tree, leaf) pairs in order of one priority queue over all trees, until their leaves hold `wanted` rows.

    A branch waits with the smallest distance to a cut on its way that the point is on the wrong side of.
    `held` has the rows in each leaf of each tree; `wanted` counts rows over all trees.
    """
    projected = [t.directions @ point - t.thresholds if len(t.thresholds) else None for t in trees]
    queue = [(-np.inf, k, 0 if len(t.thresholds) else -1) for k, t in enumerate(trees)]
    heapq.heapify(queue)
    found, rows = [], 0
    while queue and rows < wanted:
        worst, k, node = heapq.heappop(queue)
        while node >= 0:
            margin = projected[k][node]
            near, far = trees[k].children[node, int(margin > 0)], trees[k].children[node, int(margin <= 0)]
            heapq.heappush(queue, (max(worst, abs(margin)), k, int(far)))
            node = int(near)
        found.append((k, -1 - node))
        rows += int(held[k][-1 - node])
    return found


#: Products of unit vectors and exact cosines differ by less than this.
UNEXACT = 1e-9


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long arrays as rows of doubles."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a and the same row of b, always summed in the same order."""
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def usable(items: DataFrame, item_id: str, vector: str) -> DataFrame:
    """Rows whose vector is there, not zero, without null, NaN or infinite components, and as long as most are."""
    rows = items.select(F.col(item_id).cast("long").alias("vec_id"), F.col(vector).alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0) & finite
                      & F.exists("vec", lambda x: x != 0))
    widths = rows.groupBy(F.size("vec").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return rows.where(F.size("vec") == (widths["w"] if widths else 0))


def nearest(items: DataFrame, item_id: str = "vec_id", vector: str = "embedding", every: int = 50, k: int = 5,
            trees: int = TREES, searched: float = SEARCHED, seed: int = 2) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows found for each row whose id is divisible by `every`.

    Nearness is the cosine of the original vectors in double precision; ties go to the smaller id; a query's own id is
    no candidate. Equal vectors are indexed once, with their k + 1 smallest ids, which is all that a result can hold
    of them; so copies neither crowd a leaf nor multiply pairs. The trees are fitted on about SAMPLE_ROWS distinct
    vectors at most; every distinct vector is indexed in every tree. Each query walks all trees through one priority
    queue until its leaves hold `searched` times the index (summed over the trees), then candidates are ranked exactly.
    Vectors that are null, zero, of another length than most, or with null or non-finite components take no part, nor
    do null ids. Rows that repeat an id and its vector count once. An empty table gives no rows; a query without
    candidates gives none.
    """
    spark = items.sparkSession
    rows = usable(items, item_id, vector)
    first = Window.partitionBy("vec").orderBy("vec_id")
    ids = (rows.distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1)
           .groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))
    groups = written(ids.withColumn("rep", F.col("ids")[0]), "vectors")
    queries = written(rows.where(F.col("vec_id") % every == 0).distinct().join(groups.select("vec", "rep"), "vec")
                      .select(F.col("vec_id").alias("query_id"), "rep", "vec"), "queries")
    asked = queries.groupBy(F.col("rep").alias("query")).agg(F.first("vec").alias("query_vec"))  # equal within a rep

    n = groups.count()
    sample = groups.where(F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(1 << 30)) <= (1 << 30) * min(1.0, SAMPLE_ROWS / max(n, 1)))
    points = matrix(sample.select("vec").toArrow().column(0)) if n else np.zeros((0, 1))
    points = points / np.linalg.norm(points, axis=1, keepdims=True)
    forest = [grow(points, max(LEAF_ROWS, -(-len(points) // LEAVES)), seed + t) for t in range(trees)]
    shared = spark.sparkContext.broadcast(forest)  # LEAVES bounds the nodes of a tree

    vec_type = groups.schema["vec"].dataType.simpleString()

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column(1))
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                for t, tree in enumerate(shared.value):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(x), t, np.int32)), pa.array(tree.leaves(x).astype(np.int32)), *batch.columns],
                        ["tree", "leaf", "rep", "vec"])

    indexed = groups.select("rep", "vec").mapInArrow(index, f"tree int, leaf int, rep long, vec {vec_type}")
    sizes = indexed.groupBy("tree", "leaf").count().collect()  # leaves are bounded by the sample
    held = [np.zeros(len(tree.thresholds) + 1, np.int64) for tree in forest]
    for r in sizes:
        held[r["tree"]][r["leaf"]] = r["count"]
    blocks = max(1, -(-max((int(h.max()) for h in held), default=0) // LEAF_BLOCK))
    query_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    wanted = max(SEARCHED_ROWS, int(searched * n))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1)) if batch.num_rows else np.zeros((0, 1))
            for at in range(0, len(x), 256):
                part = batch.slice(at, 256)
                found = [visited(shared.value, held, row / np.linalg.norm(row), wanted) for row in x[at:at + 256]]
                of = np.repeat(np.arange(len(found)), [len(f) for f in found])
                where = np.array([pair for f in found for pair in f], dtype=np.int32)
                if len(of):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(where[:, 0]), pa.array(where[:, 1]), part.column(0).take(pa.array(of)), part.column(1).take(pa.array(of))],
                        ["tree", "leaf", "query", "query_vec"])

    visits = asked.select("query", "query_vec").mapInArrow(walk, f"tree int, leaf int, query long, query_vec {vec_type}")
    visits = (visits.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
              .withColumn("query_block", F.pmod(F.xxhash64("query"), F.lit(query_blocks)).cast("int")))
    indexed = (indexed.withColumn("block", F.pmod(F.xxhash64("rep"), F.lit(blocks)).cast("int"))
               .withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        """The nearest vectors of one leaf block to each query of one query block that visits it."""
        none = pa.table({"query": pa.array([], pa.int64()), "rep": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not left.num_rows or not right.num_rows:
            return none
        x, q = matrix(left.column("vec")), matrix(right.column("query_vec"))
        unit, rep = x / np.linalg.norm(x, axis=1, keepdims=True), left.column("rep").to_numpy()
        most, parts = min(k + 1, len(x)), []
        for at in range(0, len(q), 512):
            near = (q[at:at + 512] / np.linalg.norm(q[at:at + 512], axis=1, keepdims=True)) @ unit.T
            # these products are not exact: whatever may tie with the last one is ranked by exact scores and ids
            last = np.partition(near, len(x) - most, axis=1)[:, len(x) - most]
            of, to = np.nonzero(near >= last[:, None] - UNEXACT)
            score = cosines(q[of + at], x[to])
            order = np.lexsort((rep[to], -score, of))
            of, to, score = of[order], to[order], score[order]
            place = np.arange(len(of)) - np.searchsorted(of, of)
            parts.append((of[place < most] + at, to[place < most], score[place < most]))
        of, to, score = (np.concatenate(p) for p in zip(*parts, strict=True))
        return pa.table({"query": right.column("query").combine_chunks().take(pa.array(of)),
                         "rep": left.column("rep").combine_chunks().take(pa.array(to)), "score": pa.array(score)})

    key = ["tree", "leaf", "block", "query_block"]
    found = (indexed.groupBy(*key).cogroup(visits.groupBy(*key))
             .applyInArrow(rank, "query long, rep long, score double"))
    own = asked.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays(
        [b.column(0), b.column(0), pa.array(cosines(matrix(b.column(1)), matrix(b.column(1))))], ["query", "rep", "score"])
        for b in batches if b.num_rows), "query long, rep long, score double")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "rep")
    top = (found.union(own).distinct().withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
           .join(groups.select("rep", "ids"), "rep").select("query", "score", F.explode("ids").alias("vec_id")))
    each = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = top.withColumn("n", F.row_number().over(each)).where(F.col("n") <= k + 1).drop("n")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (queries.select("query_id", F.col("rep").alias("query")).distinct().join(top, "query")
            .where(F.col("query_id") != F.col("vec_id"))
            .withColumn("rank", F.row_number().over(final)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
