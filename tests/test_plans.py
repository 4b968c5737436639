"""Plan shape: the distributed strategies the design relies on are what Spark runs.

Final plans (after adaptive execution) are read, with a broadcast threshold so low that only
what the library itself marks as bounded is broadcast.
"""

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from grouprank.functions.columns import euclidean
from grouprank.operators.basic import materialize
from grouprank.operators.importance import feature_importance
from grouprank.operators.knn import first_hit_rank, knn_topk
from grouprank.operators.sampling import capped_sample, sample_per_group
from grouprank.operators.vectors import zscore
from grouprank.plans import queries as Q
from grouprank.plans.curate import curate_items
from grouprank.plans.evaluate import (audio_pairs, audio_queries, blend_inputs, blended_pairs, blended_survivors, blended_topk, eval_items,
                                      shared_postings, text_eval_items, text_queries)
from grouprank.plans import fixtures as fx
from tests.conftest import SF001, small_params


@pytest.fixture
def low_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def final_plan(df):
    """The physical plan that ran."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_no_driver_collect_in_library():
    src = pathlib.Path(__file__).resolve().parents[1] / "grouprank"
    for f in src.rglob("*.py"):
        if "llm" in f.parts:
            continue
        text = f.read_text()
        assert not re.search(r"\.(collect|toPandas|toLocalIterator)\(", text), f
        assert "localCheckpoint" not in text, f


def test_knn_plan(spark, low_broadcast):
    p = small_params()
    items = eval_items(Q.curated(spark, SF001), p)
    pairs = audio_pairs(items, p, queries=materialize(audio_queries(items, p)))
    plan = final_plan(knn_topk(pairs, 10, few_queries=True))
    assert "BroadcastHashJoin" in plan and "WindowGroupLimit" in plan and "SortMergeJoin" not in plan
    hits = final_plan(first_hit_rank(pairs, 10, few_queries=True))
    assert "SortAggregate" not in hits


def test_blended_scores_without_pair_shuffle(spark, low_broadcast):
    p = small_params()
    cur = Q.curated_table(spark, SF001)
    items = text_eval_items(cur, Q.enrich_with_text(cur, Q.text_records(spark, SF001)), p)
    plan = final_plan(blended_pairs(items, p, queries=materialize(text_queries(items, p))))
    # no exchange carries a query id next to a candidate id
    assert "qid" in plan
    assert not [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(.*(qid|cid).*qid", line)]


def rows_into_window(df):
    """Rows that the filter under the first partial WindowGroupLimit lets through, in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, found = [plan], []
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "FilterExec" and "floor" in node.condition().toString():
            found.append(node.metrics().apply("numOutputRows").value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_blended_ranking_meets_few_pairs(spark):
    """At sf0.1, less than a twentieth of all pairs meet postings, and less still reach the window."""
    p, d = Q.PARAMS, SF001.replace("0.001", "0.1")
    items = Q._text_items(spark, d)
    queries = materialize(text_queries(items, p))
    inputs = blend_inputs(items, p, queries=queries, few=True)
    _, lengths = shared_postings(inputs, p, few=True)
    n = items.join(queries.select("genre", F.col("track_id").alias("qid")), "genre").filter("track_id != qid").count()
    survivors = blended_survivors(inputs, p, lengths, p.k, few=True).count()
    top = blended_topk(items, p, p.k, queries=queries)
    ranked = rows_into_window(top)
    assert len(ranked) == 1 and 10 * queries.count() <= ranked[0] < survivors < 0.05 * n


@pytest.mark.parametrize("alpha", [0.0, 0.3, 1.0])
def test_blended_bounds_hold_for_any_weight(spark, alpha):
    p = small_params().with_(alpha=alpha, text_min_rows=10)
    cur = Q.curated_table(spark, SF001)
    items = text_eval_items(cur, Q.enrich_with_text(cur, Q.text_records(spark, SF001)), p)
    queries = materialize(text_queries(items, p))
    whole = knn_topk(blended_pairs(items, p, queries=queries), p.k, score="score", ascending=False, bounded=False)
    for few in (True, False):
        top = blended_topk(items, p, p.k, queries=queries, few=few)
        assert {(r.qid, r.genre, r["rank"]): round(r.score, 9) for r in top.collect()} == {(r.qid, r.genre, r["rank"]): round(r.score, 9) for r in whole.collect()}


def test_sampling_never_shuffles_rows_on_the_group(spark, low_broadcast):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 50)).alias("genre"),
                                      F.col("id").cast("string").alias("id"), F.repeat(F.lit("x"), 50).alias("payload"))
    rows = materialize(rows)
    few = final_plan(sample_per_group(rows, "genre", 5, id_col="id", few_groups=True))
    assert "SortMergeJoin" not in few and "BroadcastHashJoin" in few
    many = final_plan(sample_per_group(rows, "genre", 5, id_col="id"))
    assert "Join" not in many and many.count("WindowGroupLimit") >= 2
    whole = final_plan(capped_sample(rows, "id", 7))
    assert "CartesianProduct" not in whole and "NestedLoop" not in whole and "Window [" in whole
    assert "SinglePartition" not in re.sub(r"TakeOrderedAndProject.*", "", whole)


def test_scaling_a_chosen_group_does_not_shuffle_items(spark, low_broadcast):
    items = materialize(Q.curated(spark, SF001))
    plan = final_plan(zscore(items, "genre", ["tempo"], few_groups=True))
    assert "SortMergeJoin" not in plan


def test_importance_does_not_depend_on_exchange_reuse(spark):
    rows = spark.range(3000).select((F.col("id") % 2).cast("string").alias("genre"), (F.col("id") % 37).cast("string").alias("ent"),
                                    F.when(F.col("id") % 4 < 2, 0.0).otherwise(F.rand(3) * 100).alias("a"), F.rand(4).alias("b"))
    rows = materialize(rows)
    found = []
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        found.append({(r.genre, r.feature): round(r.importance_raw, 9)
                      for r in feature_importance(rows, entity="ent", features=["a", "b"], partitions=13).collect()})
    spark.conf.set("spark.sql.exchange.reuse", "true")
    assert found[0] == found[1] and len(found[0]) == 4


def test_half_equal_values_spread(spark):
    """Ties collapse before the ranges are made, so no range holds much more than its share."""
    from grouprank.operators.importance import _ranged, feature_counts
    rows = spark.range(40_000).select(F.lit("g").alias("genre"), (F.col("id") % 5000).alias("ent"), F.lit(8).alias("n_a"),
                                      F.when(F.col("id") % 2 == 0, 0.0).otherwise(F.col("id") * 1.0).alias("a"))
    sizes = [r["count"] for r in _ranged(feature_counts(rows, "genre", "ent", ["a"]), 16, "genre", "feature", "x", "ent")
             .groupBy("_pid").count().collect()]
    assert max(sizes) <= 3 * sum(sizes) / 16


def test_scan_prunes_columns(spark):
    plan = final_plan(curate_items(fx.fx_tracks(spark, SF001), fx.fx_artists(spark, SF001)).select("genre"))
    reads = " ".join(re.findall(r"ReadSchema: (\S+)", plan))
    assert "c_mktsegment" in reads
    for unused in ("o_orderpriority", "o_clerk", "o_comment", "c_comment", "c_address"):
        assert unused not in reads


def test_distance_is_a_plain_expression():
    assert "sqrt" in str(euclidean(["q_a"], ["c_a"])).lower()


def test_bucketed_tables_join_without_a_shuffle(spark):
    plan = final_plan(Q.q_join_composite_bucketed(spark, SF001))
    assert "SortMergeJoin" in plan and "Exchange" not in plan


def test_counts_need_no_scan_of_their_own(spark):
    """The counts of a run are those of its tables."""
    from grouprank.plans.pipeline import run_pipeline
    from grouprank.sources import io
    counts = {}
    out = run_pipeline(spark, fx.fx_tracks(spark, SF001), fx.fx_artists(spark, SF001), io.scratch_path(spark, "t-counts"), small_params(),
                       text_records=Q.text_records(spark, SF001), evaluate=False, counts=counts)
    assert counts == {name: df.count() for name, df in out.items()} and set(counts) == {"curated", "enriched"}


def test_blended_scores_shuffle_texts_not_terms(spark, low_broadcast):
    """Terms meet the queries where their document lies: no exchange is made by term."""
    p = small_params()
    cur = Q.curated_table(spark, SF001)
    items = text_eval_items(cur, Q.enrich_with_text(cur, Q.text_records(spark, SF001)), p)
    queries = materialize(text_queries(items, p))
    for df in (blended_pairs(items, p, queries=queries), blended_topk(items, p, p.k, queries=queries)):
        plan = final_plan(df)
        assert not [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(.*term", line)]


def test_lines_are_dealt_by_order_over_tasks_that_grow(spark, tmp_path, monkeypatch):
    from grouprank.plans import fixtures as fx
    orders = [(k if k < 39 else None, k % 5, "1996-01-02", float(k)) for k in range(40)]
    lines = [(k % 37 if k % 11 else None, float(k % 7), 0.01 * (k % 3), 0.02 * (k % 4) if k % 9 else None, 1.5 * k) for k in range(400)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_quantity double, l_discount double, l_tax double, l_extendedprice double").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(fx, "LINES_PER_TASK", 20)
    tracks = fx.fx_tracks(spark, str(tmp_path))
    plan = tracks._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and "20), REPARTITION_BY_NUM" in plan.replace("hashpartitioning(", "") and len(orders) == tracks.count()
    for r in tracks.collect():
        mine = [x for x in lines if r["id"] is not None and x[0] == int(r["id"])]
        for k, low, high in ((1, "danceability", "energy"), (2, "loudness", "speechiness"), (3, "acousticness", "instrumentalness"), (4, "liveness", "valence")):
            some = [x[k] for x in mine if x[k] is not None]
            assert (r[low], r[high]) == ((min(some), max(some)) if some else (None, None))
