"""Run comparison and report views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grouprank.operators.basic import complete_rows, materialize, require_columns
from grouprank.operators.groups import keep_groups
from grouprank.operators.importance import feature_importance
from grouprank.operators.pair_sampling import sampled_importance
from grouprank.operators.sampling import sample_per_group
from grouprank.params import Params
from grouprank.plans.evaluate import chosen_groups, few_groups


def genre_predictors(items: DataFrame, p: Params | None = None, *, cap: int | None = None,
                     run_ts=None, groups: DataFrame | None = None) -> DataFrame:
    """Feature importance of the chosen groups (C4).

    ``cap`` optionally ranks a reproducible random subset of each group first;
    by default every complete row is used. ``groups``: a stored group table to use
    instead of the chooser.
    Columns: genre, feature, importance_raw, importance_abs, importance_norm, run_ts.
    """
    p = p or Params()
    df = predictor_items(items, p, cap=cap, groups=groups).drop(p.item)
    out = feature_importance(df, group=p.group, entity=p.entity, features=p.features,
                             min_items=p.importance_min_items, min_entities=p.importance_min_entities)
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return out.withColumn("run_ts", ts)


def predictor_items(items: DataFrame, p: Params, *, cap: int | None = None, groups: DataFrame | None = None) -> DataFrame:
    """Complete rows of the chosen groups, written (the input of both importance estimates)."""
    keys = [p.item, p.group, p.entity]
    df = complete_rows(require_columns(items, keys + p.features).select(*keys, *p.features),
                       keys + p.features)
    few = few_groups(p, groups)
    df = keep_groups(df, chosen_groups(df, p, p.min_rows, groups), p.group, few_groups=few)
    if cap is not None:
        df = sample_per_group(df, p.group, cap, id_col=p.item, seed=p.seed, salt="cap", few_groups=few)
    return materialize(df, spread=True)


def sampled_predictors(items: DataFrame, p: Params | None = None, *, cap: int | None = None,
                       groups: DataFrame | None = None) -> DataFrame:
    """Importance estimated from ``p.importance_draws`` drawn pairs a group, beside its expectation.

    Columns: those of ``sampled_importance``, and ``expected_raw``, the exact value that draws converge to.
    """
    p = p or Params()
    df = predictor_items(items, p, cap=cap, groups=groups)
    gates = {"group": p.group, "entity": p.entity, "features": p.features, "min_items": p.importance_min_items,
             "min_entities": p.importance_min_entities}
    drawn = sampled_importance(df, item=p.item, draws=p.importance_draws, seed=p.seed, **gates)
    exact = feature_importance(df, **gates).select(p.group, "feature", F.col("importance_raw").alias("expected_raw"))
    return drawn.join(exact, [p.group, "feature"])


# The output names of the delta and report tables, as they stand in the functions below.

def compare_runs(audio: DataFrame, audio_text: DataFrame, *, flagged: bool = True) -> DataFrame:
    """Delta of the blended run against the numeric baseline, one row per blended-run group.

    ``flagged``: keep groups without a baseline (flag 0, deltas NULL);
    otherwise only groups present in both runs.
    """
    a = audio.select("genre", F.col("recall_at_k").alias("recall_audio"), F.col("mrr_at_k").alias("mrr_audio"),
                     F.lit(1).alias("_has"))
    al = audio_text.select("genre", F.col("recall_at_k").alias("recall_audio_lyrics"),
                           F.col("mrr_at_k").alias("mrr_audio_lyrics"), "alpha_audio_weight",
                           "n_queries", "n_tracks_in_genre",
                           *(["run_ts"] if "run_ts" in audio_text.columns else []))
    if "run_ts" not in al.columns:
        al = al.withColumn("run_ts", F.current_timestamp())
    j = al.join(a, "genre", "left" if flagged else "inner")
    has = F.col("_has").isNotNull()
    return j.select(
        F.when(has, 1).otherwise(0).alias("baseline_available"),
        "recall_audio", "recall_audio_lyrics",
        F.when(has, F.col("recall_audio_lyrics") - F.col("recall_audio")).alias("delta_recall"),
        "mrr_audio", "mrr_audio_lyrics",
        F.when(has, F.col("mrr_audio_lyrics") - F.col("mrr_audio")).alias("delta_mrr"),
        "alpha_audio_weight", "n_queries", "n_tracks_in_genre", "run_ts", "genre")


# ----------------------------------------------------------------------------- reports

def _at_most(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


def group_distribution(curated: DataFrame, limit: int | None = 50) -> DataFrame:
    return _at_most(curated.groupBy("genre").agg(F.count(F.lit(1)).alias("track_rows"))
                    .orderBy(F.col("track_rows").desc(), F.col("genre").asc()), limit)


def distinct_items_per_group(curated: DataFrame, approx: bool = False) -> DataFrame:
    agg = F.approx_count_distinct("id") if approx else F.count_distinct("id")
    return (curated.groupBy("genre").agg(agg.alias("distinct_tracks"))
                   .orderBy(F.col("distinct_tracks").desc(), "genre"))


def top_features(predictors: DataFrame, genre: str, limit: int | None = 20) -> DataFrame:
    return _at_most(predictors.filter(F.col("genre") == genre)
                    .select("genre", "feature", "importance_norm")
                    .orderBy(F.col("importance_norm").desc(), "feature"), limit)


def importance_by_feature(predictors: DataFrame, genre: str | None = None) -> DataFrame:
    df = predictors if genre is None else predictors.filter(F.col("genre") == genre)
    return (df.groupBy("feature").agg(F.sum("importance_norm").alias("importance_norm_sum"))
              .orderBy(F.col("importance_norm_sum").desc(), "feature"))


def importance_rollup(predictors: DataFrame) -> DataFrame:
    """One report for every (genre, feature), every feature over all genres, and all together; ``level`` is the grouping id."""
    return predictors.groupingSets([["genre", "feature"], ["feature"], []], "genre", "feature").agg(
        F.grouping_id("genre", "feature").cast("int").alias("level"), F.count(F.lit(1)).alias("scores"),
        F.sum("importance_norm").alias("importance_norm_sum"), F.max(F.abs("importance_norm")).alias("strongest"))


def distinct_sketches(curated: DataFrame, *by: str, lg_k: int = 14) -> DataFrame:
    """(by..., sketch): a mergeable sketch of the distinct items of each key; its error is about 1.04 / sqrt(2^lg_k)."""
    return curated.groupBy(*by).agg(F.hll_sketch_agg("id", F.lit(lg_k)).alias("sketch"))


def rolled_up(sketches: DataFrame, *by: str) -> DataFrame:
    """Estimated distinct items of coarser keys from stored sketches, without reading items again."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def distinct_groups(df: DataFrame) -> DataFrame:
    return df.select("genre").distinct().orderBy("genre")


def eval_report(evaluation: DataFrame) -> DataFrame:
    return evaluation.orderBy(F.col("recall_at_k").desc(), "genre")


def delta_report(delta: DataFrame) -> DataFrame:
    return (delta.select("genre", "baseline_available", "delta_recall", "delta_mrr", "alpha_audio_weight")
                 .orderBy(F.col("baseline_available").asc(), F.col("delta_recall").desc_nulls_last(), "genre"))


def text_quality_total(text_records: DataFrame) -> DataFrame:
    return text_records.agg(F.count(F.lit(1)).alias("lyric_rows"),
                            F.sum(F.when(F.col("lyrics_found"), 1).otherwise(0)).cast("long").alias("found_rows"))


def text_quality_by_group(enriched: DataFrame) -> DataFrame:
    has = F.col("lyrics").isNotNull() & (F.length("lyrics") > 0)
    return (enriched.groupBy("genre")
                    .agg(F.count(F.lit(1)).alias("tracks_in_curated"),
                         F.sum(F.when(has, 1).otherwise(0)).cast("long").alias("tracks_with_lyrics"))
                    .orderBy(F.col("tracks_with_lyrics").desc(), "genre"))


def table_row_counts(**tables: DataFrame) -> DataFrame:
    """One row: <name>_rows per named table (one count each, gathered by a sum)."""
    ones = [df.select(*[F.lit(int(name == mine)).cast("long").alias(f"{name}_rows") for name in tables])
            for mine, df in tables.items()]
    return reduce(DataFrame.unionByName, ones).agg(*[F.coalesce(F.sum(f"{n}_rows"), F.lit(0)).alias(f"{n}_rows") for n in tables])
