"""Workflow invariants at sf0.001 (the reference's manual checks, as assertions)."""

import pytest
from pyspark.sql import functions as F

from grouprank.plans import compare as cmp
from grouprank.plans import fixtures as fx
from grouprank.plans import queries as Q
from grouprank.plans.pipeline import run_pipeline
from grouprank.sources import io
from tests.conftest import SF001, small_params


@pytest.fixture(scope="module")
def stages(spark):
    return run_pipeline(spark, fx.fx_tracks(spark, SF001), fx.fx_artists(spark, SF001), io.scratch_path(spark, "t-pipe"),
                        small_params(), text_records=Q.text_records(spark, SF001))


def test_entry_runs(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert rows and all(0 <= r.mrr_at_k <= r.recall_at_k <= 1 for r in rows)


def test_stage_outputs_have_rows(stages):
    for name in ("curated", "enriched", "predictors", "audio", "audio_text", "delta"):
        assert stages[name].count() > 0, name


def test_importance_norm_sums_to_one(stages):
    sums = stages["predictors"].groupBy("genre").agg(F.sum(F.abs("importance_norm")).alias("s")).collect()
    assert sums and all(abs(r.s - 1.0) < 1e-9 for r in sums)


def test_eval_bounds(stages):
    for name in ("audio", "audio_text"):
        for r in stages[name].collect():
            assert 0 <= r.mrr_at_k <= r.recall_at_k <= 1


def test_delta_flag(stages):
    rows = stages["delta"].collect()
    for r in rows:
        assert (r.baseline_available == 0) == (r.delta_recall is None) == (r.delta_mrr is None)


def test_text_quality(spark):
    tot = cmp.text_quality_total(Q.q_convert_text(spark, SF001)).collect()[0]
    assert 0 < tot.found_rows <= tot.lyric_rows


def test_every_sql_has_a_query():
    from __spark_entry__ import oracle_sql, queries
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("key", sorted(Q.QUERIES))
def test_every_query_runs(spark, key):
    df = Q.QUERIES[key](spark, SF001)
    assert len(set(df.columns)) == len(df.columns)
    df.write.format("noop").mode("overwrite").save()


def _folders(spark):
    path = spark._jvm.org.apache.hadoop.fs.Path(spark.conf.get("spark.checkpoint.dir") + "/scratch")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return {f.getPath().getName() for f in fs.listStatus(path)} if fs.exists(path) else set()


def test_whole_workflow_with_lookups_and_tables(spark, tmp_path):
    """Lookups from stored responses, a stored group table, hashed text, registered tables, no folder left behind."""
    before = _folders(spark)
    cur = Q.curated(spark, SF001)
    groups = cur.groupBy("genre").count().where("count >= 150").select("genre")
    out = run_pipeline(spark, fx.fx_tracks(spark, SF001), fx.fx_artists(spark, SF001), str(tmp_path), small_params().with_(lookup_per_group=None, text_min_rows=5, text_n_queries=5),
                       responses=fx.fx_responses(spark, SF001), database="t_workflow", groups=groups, tokens="hashed")
    assert _folders(spark) == before
    assert {t.tableName for t in io.list_tables(spark, "t_workflow").collect()} == {
        "curated", "text_enriched", "predictors", "eval_audio", "eval_audio_text", "delta"}
    assert spark.table("t_workflow.delta").count() == out["delta"].count() > 0
    given = {r.genre for r in groups.collect()}
    for name in ("predictors", "audio", "audio_text"):
        assert {r.genre for r in out[name].select("genre").collect()} <= given
    assert out["enriched"].where("lyrics_found").count() > 0
    with pytest.raises(ValueError):
        run_pipeline(spark, cur, cur, str(tmp_path))


def test_limits_accept_none(spark):
    p = small_params().with_(n_queries=None, top_groups=None, text_n_queries=None)
    cur = Q.curated(spark, SF001)
    from grouprank.plans.evaluate import evaluate_audio
    rows = evaluate_audio(cur, p).collect()
    counts = {r["genre"]: r["count"] for r in cur.groupBy("genre").count().collect()}
    assert rows and all(r.n_queries <= counts[r.genre] for r in rows) and max(r.n_queries for r in rows) > 150
    assert cmp.group_distribution(cur, None).count() == len(counts)
