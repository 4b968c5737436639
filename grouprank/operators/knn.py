"""Nearest-neighbour ranking inside groups.

Shape of the work: a small query sample per group (bounded by ``n_queries`` times
the number of chosen groups) is broadcast and every candidate of the group
streams past it, so the candidate side is never shuffled. Pair rows are never
shuffled by query either: a hot query would put a whole group into one task.

* ``first_hit_rank`` is exact and needs no ranking of the pairs: the least (distance, id)
  of a same-entity candidate is one aggregate per query, and the rank is one plus the
  number of candidates ordered before it. Both passes see filtered rows and combine
  map-side, so one row per query and task crosses the shuffle, however many candidates
  are at equal distances. The best candidates are written once.
* ``knn_topk`` materialises the neighbour table with ``row_number() <= k``. A
  bound pass over a small deterministic candidate subset first gives each query
  a safe score bound, so only pairs inside it reach the (partial
  WindowGroupLimit) window instead of sorting every pair.
* ``knn_cells`` finds the same table for Euclidean distances from a ``cell_index`` that was
  written once: the triangle inequality rules out cells of candidates, and candidates
  inside a cell, before their distances are computed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grouprank.functions.columns import array_euclidean, euclidean
from grouprank.operators.basic import materialize
from grouprank.operators.sampling import sample_per_group


def pair_join(queries: DataFrame, candidates: DataFrame, *, group: str = "genre", id_col: str = "id",
              entity: str = "artist_id_primary", cols: list[str] | None = None,
              few_queries: bool = False, carried: list[str] | None = None) -> DataFrame:
    """All (query, candidate) pairs of the same group except a query with itself.

    Columns: group, qid, q_entity, cid, c_entity, q_<col>..., c_<col>..., and those of the queries named in ``carried``.
    ``few_queries`` says that parameters bound the query side (n_queries rows of each
    chosen group): it is broadcast. Otherwise Spark joins on the group by the sides' sizes.
    """
    cols = cols or []
    q = queries.select(group, F.col(id_col).alias("qid"), F.col(entity).alias("q_entity"),
                       *[F.col(c).alias(f"q_{c}") for c in cols], *(carried or []))
    c = candidates.select(group, F.col(id_col).alias("cid"), F.col(entity).alias("c_entity"),
                          *[F.col(x).alias(f"c_{x}") for x in cols])
    if few_queries:
        q = F.broadcast(q)
    return c.join(q, group).filter(F.col("qid") != F.col("cid"))


def distance_column(cols: list[str]) -> Column:
    """Euclidean distance between q_<col> and c_<col> over the listed numeric columns."""
    return euclidean([f"q_{c}" for c in cols], [f"c_{c}" for c in cols])


def array_distance_column(col: str) -> Column:
    return array_euclidean(f"q_{col}", f"c_{col}")


def _order_key(score: str, ascending: bool) -> Column:
    return F.col(score) if ascending else -F.col(score)


def first_hit_rank(pairs: DataFrame, k: int, *, score: str = "dist", ascending: bool = True,
                   group: str = "genre", few_queries: bool = False, meet: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rank of the first same-entity neighbour per query, NULL when it is not in the top ``k``.

    Ranking is by ``score`` (ascending for distances, descending for similarities),
    ties broken by candidate id ascending; the query itself never takes a rank.
    Only queries having at least one same-entity candidate appear. ``few_queries`` says
    that parameters bound the queries, so one row for each is broadcast. ``meet`` makes the pairs anew with the columns
    _best and _hit of a table (group, qid, _best, _hit), so that no pair is joined to its query a second time.
    Columns: group, qid, first_hit_rank.
    """
    def per_query(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few_queries else df

    def keyed(df: DataFrame, *more: str) -> DataFrame:
        return df.select(group, "qid", "cid", (F.col("q_entity") == F.col("c_entity")).alias("_same"), _order_key(score, ascending).alias("_ok"), *more)

    q = [group, "qid"]
    same = keyed(pairs).filter("_same")
    nearest = same.groupBy(*q).agg(F.min(F.struct("_ok", "cid")).alias("_b"))
    best = materialize(nearest.select(*q, F.col("_b._ok").alias("_best"), F.col("_b.cid").alias("_hit")))
    met = keyed(meet(best), "_best", "_hit") if meet else keyed(pairs).join(per_query(best), q)
    # the score is computed at each place that it is named: most pairs are ruled out at the first
    ahead = (met.filter((F.col("_ok") <= F.col("_best")) & ((F.col("cid") < F.col("_hit")) | (F.col("_ok") < F.col("_best"))))
                .groupBy(*q).agg(F.count(F.lit(1)).alias("_ahead")))
    rank = F.coalesce(F.col("_ahead"), F.lit(0)) + 1
    return best.join(ahead, q, "left").select(*q, F.when(rank <= k, rank).cast("int").alias("first_hit_rank"))


def _ranked(pairs: DataFrame, k: int, score: str, ascending: bool, group: str) -> DataFrame:
    order = F.col(score).asc() if ascending else F.col(score).desc()
    w = Window.partitionBy(group, "qid").orderBy(order, F.col("cid").asc())
    return pairs.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn_topk(pairs: DataFrame, k: int, *, score: str = "dist", ascending: bool = True,
             group: str = "genre", keep: list[str] | None = None, bound_sample: int | None = None,
             bounded: bool = True, group_sizes: DataFrame | None = None, few_queries: bool = False) -> DataFrame:
    """The ``k`` best candidates per query with their rank (1 = best); ties by id ascending.

    Exact, with a bound pass so the full pair stream is never sorted:

    1. a deterministic subset of each group's candidates (about ``bound_sample``
       of them; default sqrt(k * group size)) is ranked; its k-th best score
       is a safe bound on the true k-th best (a subset's k-th best is never
       better than the whole set's);
    2. the full pairs are filtered to scores within that bound before any
       shuffle, and only the survivors are ranked by the window (which Spark
       plans with a partial WindowGroupLimit).

    Queries whose subset holds fewer than ``k`` candidates get no bound. The bound
    pass reads ``pairs`` three times; pass ``bounded=False`` when the pairs come
    from an expensive plan (e.g. an aggregate) rather than a broadcast stream.
    ``group_sizes`` (group, n) saves counting candidates from the pairs. ``few_queries``
    says that parameters bound the queries and groups, so a row for each is broadcast.
    """
    cols = [group, "qid", "q_entity", "cid", "c_entity", score] + (keep or [])
    pairs = pairs.select(*cols)
    if not bounded:
        return _ranked(pairs, k, score, ascending, group)
    if group_sizes is not None:
        sizes = group_sizes.select(group, F.col("n").cast("double").alias("_n"))
    else:
        sizes = pairs.groupBy(group).agg(F.approx_count_distinct("cid").alias("_n"))
    target = F.lit(float(bound_sample)) if bound_sample else F.sqrt(F.lit(float(k)) * F.col("_n"))
    frac = F.least(F.lit(1.0), F.greatest(F.lit(4.0 * k), target) / F.col("_n"))
    sizes = sizes.select(group, frac.alias("_frac"))
    sizes = F.broadcast(sizes) if few_queries else sizes
    u = (F.xxhash64(F.col("cid")).cast("double") + 9.223372036854775808e18) / 1.8446744073709552e19
    subset = pairs.join(sizes, group).filter(u < F.col("_frac")).drop("_frac")
    kth = F.max(score) if ascending else F.min(score)
    bound = (_ranked(subset, k, score, ascending, group)
             .groupBy(group, "qid").agg(kth.alias("_bound"), F.count(F.lit(1)).alias("_have"))
             .filter(F.col("_have") >= k).drop("_have"))
    bound = F.broadcast(bound) if few_queries else bound
    within = F.col(score) <= F.col("_bound") if ascending else F.col(score) >= F.col("_bound")
    kept = (pairs.join(bound, [group, "qid"], "left")
                 .filter(F.col("_bound").isNull() | within).drop("_bound"))
    return _ranked(kept, k, score, ascending, group)


@dataclass(frozen=True)
class CellIndex:
    """Items by the nearest of their group's pivots, written once.

    ``items``: group, cell, r (distance to the cell's pivot), id, entity, features.
    ``cells``: group, cell, radius (the largest r), n, p_<feature> (the pivot).
    """

    items: DataFrame
    cells: DataFrame
    cols: list[str]
    group: str
    id_col: str
    entity: str
    few_cells: bool


def cell_index(items: DataFrame, cols: list[str], *, pivots: int = 64, group: str = "genre", id_col: str = "id",
               entity: str = "artist_id_primary", seed=42, few_groups: bool = False) -> CellIndex:
    """Items stored by the nearest of ``pivots`` items of their group, drawn in sample-key order.

    ``few_groups`` says that parameters bound the groups: their pivots go to the tasks, which find the nearest for blocks of
    items, so no row per item and pivot is made. Otherwise the nearest pivot is an aggregate over an item's own rows,
    which one task makes, so it is complete before the shuffle. Equal rows are one item. Values must not be NULL.
    """
    chosen = sample_per_group(items.select(group, id_col, *cols), group, pivots, id_col=id_col, seed=seed, salt="pivot", few_groups=few_groups)
    # cells are numbered by a hash of the pivot's id, as numbers keep the aggregates hash aggregates
    pivot = materialize(chosen.select(group, F.xxhash64(F.col(id_col)).alias("cell"), *[F.col(c).alias(f"p_{c}") for c in cols]))
    own = items.select(group, id_col, entity, *cols)
    if few_groups:
        near = _nearest_pivots(own, pivot, group, cols).select(group, "cell", "r", id_col, entity, *cols)
        stored = materialize(near.dropDuplicates(), spread=True, dealt=True)
    else:
        away = euclidean([f"p_{c}" for c in cols], cols)
        nearest = (own.join(pivot, group).withColumn("_d", away)
                   .groupBy(group, id_col, entity, *cols).agg(F.min("_d").alias("r"), F.min_by("cell", "_d").alias("cell")))
        stored = materialize(nearest.select(group, "cell", "r", id_col, entity, *cols), spread=True)
    sizes = stored.groupBy(group, "cell").agg(F.max("r").alias("radius"), F.count(F.lit(1)).alias("n"))
    return CellIndex(stored, materialize(sizes.join(pivot, [group, "cell"])), list(cols), group, id_col, entity, few_groups)


def _nearest_pivots(items: DataFrame, pivot: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """``items`` of groups that have pivots, with ``cell`` and ``r``: their nearest pivot and its distance.

    Parameters bound the pivots: all are one value of a subquery, which the first row of each task carries. A distance is
    summed in the order of the columns, as ``euclidean`` does.
    """
    every = pivot.agg(F.collect_list(F.struct(F.col(group).alias("g"), "cell", F.array(*[F.col(f"p_{c}").cast("double") for c in cols]).alias("at"))).alias("_pivots"))
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0  # the lower bits number a task's rows
    marked = items.withColumn("_pivots", F.when(first, every.scalar()))

    def with_pivots(batches):
        """The batches without their last column, and the pivots by group that it holds in one row."""
        found, held = None, []
        for batch in batches:
            carried = batch.column(batch.num_columns - 1).drop_null()
            if len(carried):
                found = {}
                for row in carried[0].as_py():
                    found.setdefault(row["g"], []).append((row["cell"], row["at"]))
            held.append(batch.select(range(batch.num_columns - 1)))
            if found is not None:
                yield from ((b, found) for b in held)
                held = []
        assert not any(b.num_rows for b in held), "a task's rows came without the pivots"

    def nearest(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        for batch, found in with_pivots(batches):
            table = pa.Table.from_batches([batch])
            codes = table[group].combine_chunks().dictionary_encode()
            for k, name in enumerate(codes.dictionary.to_pylist()):
                if name not in found:
                    continue
                part = table.filter(pc.equal(codes.indices, k)).combine_chunks()
                cells = np.array([c for c, _ in found[name]], dtype=np.int64)
                at = np.array([p for _, p in found[name]], dtype=np.float64)
                total = np.zeros((part.num_rows, len(cells)))
                for j, c in enumerate(cols):
                    away = at[None, :, j] - part[c].to_numpy().astype(np.float64)[:, None]
                    total += away * away
                r = np.sqrt(total)
                best = np.where(np.isnan(r), np.inf, r).argmin(axis=1)
                part = part.append_column("cell", pa.array(cells[best])).append_column("r", pa.array(r[np.arange(len(best)), best]))
                yield from part.to_batches()
    return marked.mapInArrow(nearest, T.StructType([*items.schema.fields, T.StructField("cell", T.LongType()), T.StructField("r", T.DoubleType())]))


#: Distances may differ from the triangle inequality in their last digits: bounds are widened by this share.
WIDER = 1e-9


def _query_cells(queries: DataFrame, index: CellIndex, few: bool) -> DataFrame:
    """Every cell of a query's group: group, qid, q_entity, q_<feature>, cell, n, d (to the pivot), nearest and furthest possible distance."""
    g, cols = index.group, index.cols
    q = queries.select(g, F.col(index.id_col).alias("qid"), F.col(index.entity).alias("q_entity"), *[F.col(c).alias(f"q_{c}") for c in cols])
    d = euclidean([f"q_{c}" for c in cols], [f"p_{c}" for c in cols])
    pairs = q.join(F.broadcast(index.cells) if index.few_cells else index.cells, g).withColumn("d", d)
    slack = WIDER * (F.col("d") + F.col("radius"))
    return pairs.select(g, "qid", "q_entity", *[f"q_{c}" for c in cols], "cell", "n", "d",
                        F.greatest(F.lit(0.0), F.col("d") - F.col("radius") - slack).alias("nearest"),
                        (F.col("d") + F.col("radius") + slack).alias("furthest"))


def _meet(index: CellIndex, query_cells: DataFrame, few: bool) -> DataFrame:
    """Pairs of queries and the items of their cells, with their distances; ``limit`` (NULL: none) leaves out items of a cell
    whose own distance to its pivot rules them out."""
    g, cols = index.group, index.cols
    q = F.broadcast(query_cells) if few else query_cells
    items = index.items.select(g, "cell", "r", F.col(index.id_col).alias("cid"), F.col(index.entity).alias("c_entity"), *[F.col(c).alias(f"c_{c}") for c in cols])
    ring = F.abs(F.col("d") - F.col("r")) <= F.col("limit") + WIDER * (F.col("d") + F.col("r"))
    pairs = items.join(q, [g, "cell"]).filter((F.col("qid") != F.col("cid")) & (F.col("limit").isNull() | ring))
    return pairs.select(g, "qid", "q_entity", "cid", "c_entity", distance_column(cols).alias("dist"), "limit")


def cell_plan(queries: DataFrame, index: CellIndex, k: int, *, few_queries: bool = False) -> tuple[DataFrame, DataFrame]:
    """(query, cell) pairs that can hold one of a query's ``k`` nearest, and the same before any was ruled out.

    The cells nearest to a query that surely hold k other items give a first bound (their furthest possible distance);
    the k-th distance among the items of those cells is the limit by which all other cells are judged.
    """
    g = index.group
    cells = materialize(_query_cells(queries, index, few_queries))
    order = Window.partitionBy(g, "qid").orderBy("furthest", "cell")
    # the query itself may be one of the items counted
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = cells.withColumn("_before", before).filter(F.col("_before") <= k).drop("_before").withColumn("limit", F.lit(None).cast("double"))
    near = _ranked(_meet(index, materialize(first), few_queries).drop("limit"), k, "dist", True, g)
    limits = near.groupBy(g, "qid").agg(F.max("dist").alias("limit"), F.count(F.lit(1)).alias("_have"))
    limits = limits.select(g, "qid", F.when(F.col("_have") >= k, F.col("limit")).alias("limit"))
    limits = F.broadcast(limits) if few_queries else limits
    kept = cells.join(limits, [g, "qid"], "left").filter(F.col("limit").isNull() | (F.col("nearest") <= F.col("limit")))
    return materialize(kept), cells


def knn_cells(queries: DataFrame, index: CellIndex, k: int, *, few_queries: bool = False) -> DataFrame:
    """The table of ``knn_topk`` over the Euclidean distance of the index's columns: the ``k`` nearest items of the query's
    group, the query itself left out, ties by id. ``few_queries`` says that parameters bound the queries."""
    kept, _ = cell_plan(queries, index, k, few_queries=few_queries)
    pairs = _meet(index, kept, few_queries).filter(F.col("limit").isNull() | (F.col("dist") <= F.col("limit"))).drop("limit")
    return _ranked(pairs, k, "dist", True, index.group)


def cell_work(queries: DataFrame, index: CellIndex, k: int, *, few_queries: bool = False) -> DataFrame:
    """Per group, how many (query, item) pairs there are and how many are in cells that were not ruled out: group, pairs, met."""
    kept, cells = cell_plan(queries, index, k, few_queries=few_queries)
    total = cells.groupBy(index.group).agg(F.sum("n").alias("pairs"))
    return total.join(kept.groupBy(index.group).agg(F.sum("n").alias("met")), index.group)


def first_hit_from_topk(topk: DataFrame, *, group: str = "genre") -> DataFrame:
    """First same-entity rank per query from a top-k neighbour table."""
    return (topk.filter(F.col("q_entity") == F.col("c_entity"))
                .groupBy(group, "qid").agg(F.min("rank").cast("int").alias("first_hit_rank")))


def hit_metrics(query_keys: DataFrame, first_hits: DataFrame, *, group: str = "genre") -> DataFrame:
    """Recall@K (share of queries with a hit in the top K) and MRR@K per group.

    Queries without any hit, or without any same-entity candidate, count as 0.
    Columns: group, n_queries, recall_at_k, mrr_at_k.
    """
    j = query_keys.select(group, "qid").join(first_hits, [group, "qid"], "left")
    hit = F.col("first_hit_rank").isNotNull()
    return j.groupBy(group).agg(
        F.count(F.lit(1)).cast("int").alias("n_queries"),
        F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("recall_at_k"),
        F.avg(F.when(hit, 1.0 / F.col("first_hit_rank")).otherwise(0.0)).alias("mrr_at_k"))
