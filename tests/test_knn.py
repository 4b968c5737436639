"""Nearest-neighbour ranking: aggregate first-hit rank and bounded top-k vs the plain window and brute force."""

import random

import pytest

from pyspark.sql import functions as F

from grouprank.operators.knn import (cell_index, cell_work, distance_column, first_hit_from_topk, first_hit_rank, hit_metrics,
                                     knn_cells, knn_topk, pair_join)


def brute_first_hit(items, queries, k):
    out = {}
    for g, qid, qe, qx in queries:
        cands = sorted(((abs(qx - x), cid, e) for gg, cid, e, x in items if gg == g and cid != qid),
                       key=lambda t: (t[0], t[1]))
        hit = next((i + 1 for i, (_, _, e) in enumerate(cands[:k]) if e == qe), None)
        out[(g, qid)] = hit
    return out


def test_first_hit_rank_exact(spark):
    rng = random.Random(11)
    items = [(f"g{i % 3}", f"i{i:03d}", f"e{rng.randrange(8)}", float(rng.randrange(20))) for i in range(240)]
    df = spark.createDataFrame(items, "genre string, id string, ent string, x double")
    qrows = [it for it in items if int(it[1][1:]) % 7 == 0]
    q = df.join(spark.createDataFrame([(r[1],) for r in qrows], "id string"), "id", "left_semi")
    pairs = pair_join(q, df, entity="ent", cols=["x"]).withColumn("dist", distance_column(["x"]))
    want = brute_first_hit(items, [(g, i, e, x) for g, i, e, x in qrows], 5)
    agg = {(r.genre, r.qid): r.first_hit_rank for r in first_hit_rank(pairs, 5).collect()}
    top = {(r.genre, r.qid): r.first_hit_rank for r in first_hit_from_topk(knn_topk(pairs, 5)).collect()}
    for key, v in want.items():
        assert agg.get(key) == v
        assert top.get(key) == v
    # self never ranked
    assert pairs.filter(F.col("qid") == F.col("cid")).count() == 0


def test_metrics_count_queries_without_hits(spark):
    keys = spark.createDataFrame([("g", "q1"), ("g", "q2"), ("g", "q3"), ("g", "q4")], "genre string, qid string")
    hits = spark.createDataFrame([("g", "q1", 1), ("g", "q2", 4), ("g", "q3", None)],
                                 "genre string, qid string, first_hit_rank int")
    m = hit_metrics(keys, hits).collect()[0]
    assert m.n_queries == 4
    assert m.recall_at_k == 0.5
    assert abs(m.mrr_at_k - (1 + 0.25) / 4) < 1e-12


@pytest.mark.parametrize("bound_sample", [None, 1, 7, 10_000])
def test_bounded_topk_equals_plain_window(spark, bound_sample):
    rng = random.Random(5)
    rows = []
    for g, n in (("big", 400), ("small", 12), ("tiny", 3)):
        for i in range(n):
            rows.append((g, f"{g}{i:04d}", f"e{rng.randrange(9)}", float(rng.randrange(15))))  # many ties
    df = spark.createDataFrame(rows, "genre string, id string, ent string, x double")
    q = df.filter(F.col("id").endswith("1") | F.col("id").endswith("7"))
    pairs = pair_join(q, df, entity="ent", cols=["x"]).withColumn("dist", distance_column(["x"]))
    for asc in (True, False):
        plain = sorted(tuple(r) for r in knn_topk(pairs, 5, ascending=asc, bounded=False).collect())
        bounded = sorted(tuple(r) for r in knn_topk(pairs, 5, ascending=asc, bound_sample=bound_sample).collect())
        assert bounded == plain


@pytest.mark.parametrize("pivots", [1, 5, 64])
def test_cells_give_the_plain_neighbours(spark, pivots):
    """Ties, groups smaller than k, equal rows, and values far apart."""
    rng = random.Random(pivots)
    rows = [(g, f"{g}{i:04d}", f"e{i % 5}", float(rng.randrange(12)), rng.choice([0.0, 1e6]) + rng.random()) for g, n in (("big", 500), ("small", 12), ("tiny", 3))
            for i in range(n)]
    rows += [("same", f"s{i}", "e", 1.0, 2.0) for i in range(40)]
    df = spark.createDataFrame(rows, "genre string, id string, ent string, x double, y double")
    q = df.filter(F.col("id").endswith("1") | F.col("id").endswith("7"))
    pairs = pair_join(q, df, entity="ent", cols=["x", "y"]).withColumn("dist", distance_column(["x", "y"]))
    plain = sorted(tuple(r) for r in knn_topk(pairs, 5, bounded=False).collect())
    for few in (True, False):
        index = cell_index(df, ["x", "y"], pivots=pivots, entity="ent", few_groups=few)
        assert sorted(tuple(r) for r in knn_cells(q, index, 5, few_queries=few).collect()) == plain


def test_cells_rule_out_most_pairs(spark):
    """On the fixture, less than half of all pairs are in cells that a query has to meet."""
    from grouprank.operators.basic import materialize
    from grouprank.plans import queries as Q
    from grouprank.plans.evaluate import audio_queries, eval_items
    from tests.conftest import SF01
    p = Q.PARAMS
    items = eval_items(Q.curated_table(spark, SF01), p)
    index = cell_index(items, p.features, few_groups=True)
    work = cell_work(materialize(audio_queries(items, p)), index, p.k, few_queries=True).agg(F.sum("met").alias("met"), F.sum("pairs").alias("pairs")).first()
    assert 0 < work.met < 0.5 * work.pairs


def test_equal_distances_fill_no_task(spark):
    """All candidates at one distance: one row per query and task goes on, and the least id is the hit."""
    df = spark.range(3000).select(F.lit("g").alias("genre"), F.format_string("i%05d", "id").alias("id"), (F.col("id") % 2).cast("string").alias("ent"), F.lit(1.0).alias("x"))
    q = df.filter(F.col("id").isin("i00000", "i00001", "i02000"))
    pairs = pair_join(q, df, entity="ent", cols=["x"], few_queries=True).withColumn("dist", distance_column(["x"]))
    hits = first_hit_rank(pairs, 5, few_queries=True)
    assert {r.qid: r.first_hit_rank for r in hits.collect()} == {"i00000": 2, "i00001": 3, "i02000": 1}


def test_cells_of_few_groups_make_no_row_per_pivot(spark):
    """The nearest pivot as the aggregate finds it; equal rows are one item, NaN comes last, unknown groups go."""
    from grouprank.operators.knn import _nearest_pivots
    rng = random.Random(5)
    rows = [(f"g{i % 3}", f"i{i}", f"e{i % 7}", rng.choice([0.0, 1e6]) + rng.random(), float(rng.randrange(12))) for i in range(400)]
    rows += rows[:50] + [(None, "n", "e", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "genre string, id string, ent string, x double, y double")
    few, many = (cell_index(df, ["x", "y"], pivots=9, entity="ent", few_groups=f) for f in (True, False))
    assert sorted(map(tuple, few.items.collect())) == sorted(map(tuple, many.items.collect())) and few.items.count() == 400
    assert sorted(map(tuple, few.cells.collect())) == sorted(map(tuple, many.cells.collect()))

    pivot = spark.createDataFrame([("g0", 7, 0.0, 0.0), ("g0", 8, float("nan"), 0.0)], "genre string, cell long, p_x double, p_y double")
    got = _nearest_pivots(df.drop("ent").filter("id IN ('i0', 'i1')").dropDuplicates(), pivot, "genre", ["x", "y"])
    assert [(r.id, r.cell) for r in got.collect()] == [("i0", 7)] and "Join" not in got._jdf.queryExecution().executedPlan().toString()


def test_hits_of_pairs_met_again_join_no_pair_to_its_query(spark):
    """Ranks from pairs that are made anew with the best hits are those of the pairs joined to them."""
    rng = random.Random(8)
    rows = [(f"g{i % 2}", f"i{i % 190}", f"e{rng.randrange(30)}", float(rng.randrange(6)), float(rng.randrange(6))) for i in range(200)]
    df = spark.createDataFrame(rows, "genre string, id string, ent string, x double, y double")
    q = df.filter("cast(substring(id, 2, 3) as int) < 40")

    def meet(best):
        known = q.join(best.withColumnRenamed("qid", "id"), ["genre", "id"])
        return pair_join(known, df, entity="ent", cols=["x", "y"], few_queries=True, carried=["_best", "_hit"]).withColumn("dist", distance_column(["x", "y"]))
    pairs = pair_join(q, df, entity="ent", cols=["x", "y"], few_queries=True).withColumn("dist", distance_column(["x", "y"]))
    joined, met = (first_hit_rank(pairs, 10, few_queries=True, meet=m) for m in (None, meet))
    assert sorted(map(tuple, met.collect()), key=str) == sorted(map(tuple, joined.collect()), key=str) and met.count() > 20
