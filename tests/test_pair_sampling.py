"""Drawn pairs: numbering without whole-group windows, the estimate near its expectation, gates and hot entities."""

import random

import pytest
from pyspark.sql import functions as F

from grouprank.operators import sampling
from grouprank.operators.basic import materialize
from grouprank.operators.importance import feature_importance
from grouprank.operators.pair_sampling import drawn_pairs, sampled_importance
from tests.test_plans import final_plan


def items(spark, seed=1):
    draw, rows = random.Random(seed), []
    for g in ("g1", "g2"):
        for n in range(300):
            e = "hot" if draw.random() < 0.4 else f"e{draw.randrange(25)}"
            rows.append((g, e, f"i{n:04d}", draw.gauss(hash(e) % 7, 1.0), draw.random()))
    rows += [("small", f"e{n % 6}", f"i{n}", 1.0, 2.0) for n in range(20)] + [("few", f"e{n % 2}", f"i{n}", 1.0, 2.0) for n in range(80)]
    rows += [("single", f"e{n}", f"i{n}", float(n), 2.0) for n in range(60)]
    return materialize(spark.createDataFrame(rows, "genre string, ent string, id string, a double, b double"))


def test_expectation_within_four_errors(spark):
    df = items(spark)
    kw = {"entity": "ent", "features": ["a", "b"]}
    exact = {(r.genre, r.feature): r.importance_raw for r in feature_importance(df, **kw).collect()}
    for seed in (1, 2, 3):
        got = {(r.genre, r.feature): r for r in sampled_importance(df, draws=4000, seed=seed, **kw).collect()}
        assert got.keys() == exact.keys() == {(g, f) for g in ("g1", "g2") for f in "ab"}
        for key, r in got.items():
            assert 0 < r.std_error < 0.2
            assert abs(r.importance_raw - exact[key]) < 4 * r.std_error
            assert r.n_same + r.n_different <= 4000 and r.n_same > 1500


def test_pairs_are_what_they_claim(spark):
    pairs = drawn_pairs(items(spark), group="genre", entity="ent", item="id", draws=2000, seed=5, min_items=50, min_entities=5).collect()
    assert all((p.entity_1 == p.entity_2) == p.same and (p.one.id != p.two.id or not p.same) for p in pairs)
    assert len({(p.genre, p.draw) for p in pairs}) == len(pairs)
    # entities are drawn evenly, whatever their size
    hot = sum(p.entity_1 == "hot" for p in pairs if p.genre == "g1" and not p.same)
    assert hot < 0.12 * sum(p.genre == "g1" and not p.same for p in pairs)
    again = drawn_pairs(items(spark).repartition(3), group="genre", entity="ent", item="id", draws=2000, seed=5, min_items=50, min_entities=5).collect()
    assert sorted(map(str, again)) == sorted(map(str, pairs))


@pytest.mark.parametrize("rows_per_range", [250_000, 40])
def test_numbers_are_dense_and_in_order(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(sampling, "ROWS_PER_RANGE", rows_per_range)
    df = materialize(spark.range(500).select(F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 3).cast("string")).alias("k"), F.hash("id").alias("v"), "id"))
    got = {}
    for r in sampling.numbered(df, ["k"], ["v"], "place").collect():
        got.setdefault(r.k, []).append((r.place, r.v))
    assert set(got) == {None, "0", "1", "2"}
    for rows in got.values():
        rows.sort()
        assert [p for p, _ in rows] == list(range(len(rows))) and [v for _, v in rows] == sorted(v for _, v in rows)


def test_no_window_over_a_whole_group(spark, monkeypatch):
    """Ranking every row of a group goes by ranges too: ten times the rows, ten times the ranges."""
    monkeypatch.setattr(sampling, "ROWS_PER_RANGE", 500)
    rows = materialize(spark.range(5000).select(F.lit("hot").alias("genre"), F.col("id").cast("string").alias("id")))
    ranked = sampling.sample_per_group(rows, "genre", None, id_col="id", keep_rank="rank")
    plan = final_plan(ranked)
    assert "_pid" in plan and not [line for line in plan.splitlines() if "Exchange hashpartitioning(genre" in line and "_pid" not in line and "_sk" in line]
    assert sorted(r["rank"] for r in ranked.collect()) == list(range(1, 5001))
    want = {r.id: r["rank"] for r in sampling.sample_per_group(rows, "genre", 5000, id_col="id", keep_rank="rank").collect()}
    assert {r.id: r["rank"] for r in ranked.collect()} == want
    assert sampling.range_count(50_000) == 10 * sampling.range_count(5_000)
