"""Registered queries: one callable (spark, sf_dir) -> DataFrame per operator key.

Each query reads the fixture frames derived from the given tables (see
``fixtures``) over their whole extent. Doubles are rounded to 6 places so the
results compare with the SQL oracle; ``run_ts`` is left out for the same reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grouprank.functions.columns import (clean_list_value, coalesce_existing, normalize_label, parse_list_string,
                                         pick_text, pick_text_variant, primary_entity_id, release_year)
from grouprank.operators.basic import (clean_lookup_input, complete_rows, dedupe_by_key, materialize,
                                       select_existing, text_available)
from grouprank.operators.groups import (eligible_groups, group_counts, keep_groups, select_groups,
                                        select_groups_with_reason, top_groups)
from grouprank.operators.knn import (array_distance_column, cell_index, first_hit_rank, hit_metrics, knn_cells, knn_topk,
                                     pair_join)
from grouprank.operators.sampling import capped_sample, range_count, sample_per_group
from grouprank.operators.text import hashed_term_counts, term_counts, term_weights, text_cosine, tfidf, tfidf_hashed
from grouprank.operators.vectors import l2_normalize, zscore
from grouprank.params import CURATED_COLUMNS, FEATURES, Params
from grouprank.plans import compare as cmp
from grouprank.plans import fixtures as fx
from grouprank.plans.curate import (LOOKUP_COLUMNS, convert_text, curate_items, enrich_with_text, entity_groups,
                                    explode_groups, items_with_entities, lookup_input_stratified,
                                    lookup_input_top, resolve_lookups)
from grouprank.plans.evaluate import (audio_pairs, audio_queries, blended_pairs, blended_topk, eval_items,
                                      evaluate_audio, evaluate_audio_text, few_groups, text_eval_items, text_queries)
from grouprank.sources import io

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, places: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    """Round doubles as round(x * 10^places) / 10^places: the scaled double is rounded
    half away from zero, which every engine does the same way."""
    overrides = overrides or {}

    def r(name):
        scale = float(10 ** overrides.get(name, places))
        return (F.round(F.col(name) * scale) / scale).alias(name)
    return df.select(*[r(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def _placed(report: DataFrame) -> DataFrame:
    """A report's rows with their place in its own order (a report has a row per group or feature)."""
    return report.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "place", F.row_number().over(Window.orderBy("_at"))).drop("_at")


# Raw importances are small differences of two large means (about 1e5 apart for the
# order-total feature), so summation order moves them by ~1e-9; 4 places keep the
# comparison stable. Normalised importances keep 6 places.
IMPORTANCE_PLACES = {"importance_raw": 4, "importance_abs": 4}


# ------------------------------------------------------------------ shared derivations

def curated(spark, d) -> DataFrame:
    return curate_items(fx.fx_tracks(spark, d), fx.fx_artists(spark, d))


def curated_table(spark, d) -> DataFrame:
    """The curated table written once, for queries that read it in several branches
    (as the pipeline reads its written stage table)."""
    return materialize(curated(spark, d), spread=True, dealt=True)


def lookup_rows(spark, d) -> DataFrame:
    """Every curated row as a lookup input row (track_id, track_name, artist_name_primary, genre)."""
    c = curated(spark, d)
    return c.select(F.col("id").alias("track_id"), F.col("name").alias("track_name"),
                    "artist_name_primary", "genre")


def text_records(spark, d) -> DataFrame:
    return convert_text(fx.fx_lyrics(spark, d))


def enriched(spark, d) -> DataFrame:
    return enrich_with_text(curated(spark, d), text_records(spark, d))


#: The same parameters on every folder.
PARAMS = Params()
VARIETY = PARAMS.with_(group_mode="top_n_plus_variety", top_groups=5, variety_groups=5, min_rows=300)


def _p(d) -> Params:
    return PARAMS


def _variety(d) -> Params:
    return VARIETY


def _audio_eval(spark, d, cur=None) -> DataFrame:
    return evaluate_audio(cur if cur is not None else curated_table(spark, d), _p(d))


def _text_eval(spark, d, cur=None) -> DataFrame:
    cur = cur if cur is not None else curated_table(spark, d)
    return evaluate_audio_text(cur, enrich_with_text(cur, text_records(spark, d)), _p(d))


def _predictors(spark, d) -> DataFrame:
    return cmp.genre_predictors(curated_table(spark, d), _p(d))


def _text_items(spark, d) -> DataFrame:
    cur = curated_table(spark, d)
    return text_eval_items(cur, enrich_with_text(cur, text_records(spark, d)), _p(d))


# ------------------------------------------------------------------ scans, sources, sinks

def q_scan_table(spark, d):
    return io.scan(spark, f"{d}/documents.parquet")


def q_csv_roundtrip(spark, d):
    """Whole texts, with line breaks, quotes and blanks, through CSV."""
    path = io.scratch_path(spark, "csv")
    src = fx.table(spark, d, "documents")
    io.unload_csv(src, path)
    return io.read_csv(spark, path, schema=src.schema, multi_line=True)


def q_csv_inferred(spark, d):
    """Raw CSV to a registered table with inferred column types."""
    path, table = io.scratch_path(spark, "rawcsv"), io.scratch_path(spark, "rawtable")
    io.unload_csv(fx.fx_tracks(spark, d), path)
    io.read_csv(spark, path).write.parquet(table)
    t = io.register_table(spark, "grouprank_tracks_raw", table)
    return t.select("id", "name", "popularity", "id_artists", "release_date", *FEATURES)


def q_jsonl_roundtrip(spark, d):
    path = io.scratch_path(spark, "jsonl")
    recs = resolve_lookups(lookup_rows(spark, d), fx.fx_responses(spark, d))
    io.write_jsonl(recs, path)
    back = io.read_jsonl(spark, path, schema=recs.schema)
    return convert_text(back)


def q_positional_csv(spark, d):
    """Lookup rows whose name is a whole text, by position, all columns as strings."""
    path = io.scratch_path(spark, "poscsv")
    rows = fx.table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("track_id"), F.col("text").alias("track_name"),
                                                  F.col("source").alias("artist_name_primary"), F.col("lang").alias("genre"))
    io.unload_csv(rows, path, header=True, escape="\\")
    return io.read_positional_csv(spark, path, LOOKUP_COLUMNS, header=True, multi_line=True)


def q_partitioned_sink(spark, d):
    path = io.scratch_path(spark, "curated")
    cur = curated(spark, d)
    io.write_by_group(cur, path, "genre")
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cur.schema.fields)
    t = io.register_table(spark, "grouprank_curated", path, "genre", ddl)
    return t.select(*cur.columns)


def q_ctas_partitioned(spark, d):
    path = io.scratch_path(spark, "ctas")
    dist = group_counts(curated(spark, d), "genre", "track_rows")
    t = io.create_table_as(spark, "grouprank_group_distribution", dist, path, ["genre"])
    return t.select("genre", "track_rows")


def q_catalog_tables(spark, d):
    io.ensure_database(spark, "grouprank_db")
    path = io.scratch_path(spark, "catalog")
    io.write_by_group(group_counts(curated(spark, d)), path, "genre", cluster=False)
    t = io.register_table(spark, "grouprank_db.group_counts", path, "genre", "n bigint, genre string")
    listed = io.list_tables(spark, "grouprank_db").select(F.col("namespace").alias("database"), F.col("tableName").alias("table_name"))
    known = listed.join(io.list_databases(spark), F.col("database") == F.col("namespace"), "left_semi")
    rows = t.agg(F.count(F.lit(1)).alias("groups"), F.sum("n").alias("track_rows")).withColumn("table_name", F.lit("group_counts"))
    return known.join(rows, "table_name").select("database", "table_name", "groups", "track_rows")


# ------------------------------------------------------------------ projections, filters

def q_select_existing(spark, d):
    return select_existing(fx.fx_tracks(spark, d), CURATED_COLUMNS)


def q_complete_rows(spark, d):
    return complete_rows(fx.fx_tracks(spark, d), ["id"] + FEATURES)


def q_text_available(spark, d):
    return text_available(enriched(spark, d))


def q_clean_lookup_input(spark, d):
    return clean_lookup_input(lookup_rows(spark, d), LOOKUP_COLUMNS, "genre")


def q_group_semi_filter(spark, d):
    c = curated_table(spark, d)
    p = _p(d)
    return keep_groups(c, select_groups(c, min_rows=p.min_rows, top=p.top_groups), few_groups=True).select("id", "genre")


def q_release_year(spark, d):
    t = fx.fx_tracks(spark, d)
    return t.select("id", "release_date", release_year("release_date").alias("release_year"))


# ------------------------------------------------------------------ joins

def q_curate_items(spark, d):
    return curated(spark, d)


def q_join_left(spark, d):
    """Items by entity, those without a known entity included."""
    j = items_with_entities(fx.fx_tracks(spark, d), fx.fx_artists(spark, d))
    return j.groupBy("artist_id_primary", "artist_name_primary").agg(
        F.count(F.lit(1)).alias("items"), F.max(F.size("artist_genres")).alias("n_genres"))


def q_enrich_text(spark, d):
    return enriched(spark, d)


def q_join_composite(spark, d):
    c = curated(spark, d).select(F.col("id").alias("track_id"), "genre", "artist_id_primary", "tempo")
    e = enriched(spark, d).select("track_id", "genre", "lyrics_found")
    return _round(c.join(e, ["track_id", "genre"], "inner"))


def q_join_composite_bucketed(spark, d):
    """The composite join of two stage tables that are bucketed by its keys: no shuffle under the join."""
    keys = ["track_id", "genre"]
    items = curated_table(spark, d)
    buckets = 8 * range_count(items.count())
    c = io.write_bucketed(items.select(F.col("id").alias("track_id"), "genre", "artist_id_primary", "tempo"), "grouprank_items_bucketed",
                          io.scratch_path(spark, "bucketed"), keys, buckets)
    texts = enrich_with_text(items, text_records(spark, d)).select("track_id", "genre", "lyrics_found")
    e = io.write_bucketed(texts, "grouprank_texts_bucketed", io.scratch_path(spark, "bucketed"), keys, buckets)
    return _round(c.join(e.hint("merge"), keys, "inner"))


def _per_query(pairs: DataFrame, value: str) -> DataFrame:
    """All pairs of each query, as a count, a sum and the extremes."""
    return pairs.groupBy("genre", "qid").agg(F.count(F.lit(1)).alias("pairs"), F.sum(value).alias("total"),
                                             F.min(value).alias("least"), F.max(value).alias("most"))


def q_pair_join(spark, d):
    p = _p(d)
    items = eval_items(curated_table(spark, d), p)
    pairs = audio_pairs(items, p, queries=materialize(audio_queries(items, p)))
    return _round(_per_query(pairs, "dist"), overrides={"total": 2})


def _text_weights(spark, d):
    """TF-IDF weights of all documents, written, and those of the query sample."""
    items = _text_items(spark, d)
    w = materialize(term_weights(items, ["track_id", "genre"], "lyrics"), spread=True, dealt=True)
    q = materialize(text_queries(items, _p(d)))
    return materialize(w.join(F.broadcast(q.select("track_id", "genre")), ["track_id", "genre"], "left_semi")), w


def q_text_cosine(spark, d):
    return _round(_per_query(text_cosine(*_text_weights(spark, d), few_queries=few_groups(_p(d))), "text_cos"))


def q_text_cosine_min(spark, d):
    """The pairs of a query sample whose text cosine reaches a bound."""
    return _round(text_cosine(*_text_weights(spark, d), min_cosine=_p(d).text_min_cosine, few_queries=few_groups(_p(d))))


# ------------------------------------------------------------------ aggregations

def q_group_distribution(spark, d):
    return cmp.group_distribution(curated(spark, d))


def q_table_row_counts(spark, d):
    return cmp.table_row_counts(tracks=fx.fx_tracks(spark, d), artists=fx.fx_artists(spark, d),
                                curated=curated(spark, d))


def q_distinct_items_sketched(spark, d):
    """Distinct items of each group: exact, and whether the estimate from sketches stored by group and year is within four errors."""
    items = curated_table(spark, d)
    stored = materialize(cmp.distinct_sketches(items, "genre", "release_year"))
    both = cmp.distinct_items_per_group(items).join(cmp.rolled_up(stored, "genre"), "genre")
    near = F.abs(F.col("estimate") - F.col("distinct_tracks")) <= 4 * 1.04 / 2 ** 7 * F.col("distinct_tracks") + 1
    return both.select("genre", "distinct_tracks", near.alias("estimate_near"))


def q_stage_counts(spark, d):
    """Rows of the written stages, counted while they were written."""
    from grouprank.plans.pipeline import run_pipeline
    counts: dict[str, int] = {}
    run_pipeline(spark, fx.fx_tracks(spark, d), fx.fx_artists(spark, d), io.scratch_path(spark, "pipeline"), _p(d), text_records=text_records(spark, d),
                 evaluate=False, counts=counts)
    return spark.createDataFrame(sorted(counts.items()), "stage string, n_rows long")


def q_text_quality_total(spark, d):
    recs = convert_text(resolve_lookups(lookup_rows(spark, d), fx.fx_responses(spark, d)))
    return cmp.text_quality_total(recs)


def q_text_quality_by_group(spark, d):
    return cmp.text_quality_by_group(enriched(spark, d))


def q_eligible_groups(spark, d):
    return eligible_groups(curated(spark, d), "genre", _p(d).min_rows, "track_rows")


def q_distinct_groups(spark, d):
    return cmp.distinct_groups(curated(spark, d))


def q_dedupe_by_key(spark, d):
    c = curated(spark, d).select("id", "genre", "artist_id_primary")
    return dedupe_by_key(c, ["id"], [F.col("genre").asc()])


def q_distinct_items_per_group(spark, d):
    return cmp.distinct_items_per_group(curated(spark, d))


def q_importance_by_feature(spark, d):
    return _round(cmp.importance_by_feature(_predictors(spark, d)))


def q_importance_rollup(spark, d):
    return _round(cmp.importance_rollup(_predictors(spark, d)))


def q_feature_importance(spark, d):
    return _round(_predictors(spark, d).drop("run_ts"), overrides=IMPORTANCE_PLACES)


def q_pair_sample_importance(spark, d):
    """The estimate from drawn pairs, its standard error, and its expectation."""
    return _round(cmp.sampled_predictors(curated_table(spark, d), _p(d)), overrides={**IMPORTANCE_PLACES, "std_error": 4, "expected_raw": 4})


def q_top_features(spark, d):
    return _round(_placed(cmp.top_features(_predictors(spark, d), "building")))


def q_eval_audio(spark, d):
    return _round(_audio_eval(spark, d).drop("run_ts"))


def q_eval_audio_text(spark, d):
    return _round(_text_eval(spark, d).drop("run_ts"))


def q_zscore(spark, d):
    items = _text_items(spark, d)
    z = zscore(items, "genre", FEATURES, few_groups=True)
    return _round(z.select("track_id", "genre", *[f"z_{c}" for c in FEATURES]))


def q_l2_normalize(spark, d):
    items = _text_items(spark, d)
    z = l2_normalize(zscore(items, "genre", FEATURES, few_groups=True), [f"z_{c}" for c in FEATURES], prefix="u_")
    return _round(z.select("track_id", "genre", *[f"u_z_{c}" for c in FEATURES]))


def q_tfidf(spark, d):
    return _round(tfidf(_text_items(spark, d), ["track_id", "genre"], "lyrics"))


def q_tokenize(spark, d):
    return term_counts(text_available(enriched(spark, d)), ["track_id", "genre"], "lyrics")


def q_tfidf_hashed(spark, d):
    """Spark ML's hashed weights: their number, sum and length per document."""
    h = tfidf_hashed(_text_items(spark, d), "lyrics", keep=["track_id", "genre"])
    from pyspark.ml.functions import vector_to_array
    some = F.array_remove(vector_to_array("lyr_vec"), 0.0)
    return _round(h.select("track_id", "genre", F.size(some).alias("nonzero_terms"),
                           F.aggregate(some, F.lit(0.0), lambda a, x: a + x).alias("total_weight")))


def q_hashed_term_counts(spark, d):
    """Hashed term frequencies as rows: buckets and tokens per document."""
    t = hashed_term_counts(_text_items(spark, d), ["track_id", "genre"], "lyrics", _p(d).hash_buckets)
    return t.groupBy("track_id", "genre").agg(F.count(F.lit(1)).alias("buckets"), F.sum("tf").alias("tokens"))


def q_eval_audio_text_hashed(spark, d):
    cur = curated_table(spark, d)
    return _round(evaluate_audio_text(cur, enrich_with_text(cur, text_records(spark, d)), _p(d), tokens="hashed").drop("run_ts"))


def q_eval_audio_zscore(spark, d):
    return _round(evaluate_audio(curated_table(spark, d), _p(d), scale="zscore").drop("run_ts"))


def q_eval_audio_variety(spark, d):
    """The numeric evaluation over a top-plus-variety group list that was stored as a table first."""
    cur, p = curated_table(spark, d), _variety(d)
    groups = materialize(select_groups_with_reason(cur, top=p.top_groups, variety=p.variety_groups, min_rows=p.min_rows, seed=p.seed))
    return _round(evaluate_audio(cur, p, groups=groups).drop("run_ts"))


def q_eval_report_audio(spark, d):
    return _round(_placed(cmp.eval_report(_audio_eval(spark, d))).drop("run_ts"))


def q_predictor_groups(spark, d):
    return cmp.distinct_groups(_predictors(spark, d))


def q_curate_first_id(spark, d):
    """Curation with the first id of any id list."""
    c = curate_items(fx.fx_tracks(spark, d), fx.fx_artists(spark, d), id_mode="first")
    return c.groupBy("genre").agg(F.count(F.lit(1)).alias("track_rows"), F.count_distinct("artist_id_primary").alias("entities"))


def q_optional_columns(spark, d):
    """Curation of raw items without a release date, and the columns it then has."""
    t = fx.fx_tracks(spark, d).drop("release_date", "popularity")
    c = curate_items(t, fx.fx_artists(spark, d))
    return c.select("id", "genre", "release_year", F.lit(",".join(c.columns)).alias("columns"))


def q_run_timestamp(spark, d):
    """The run timestamp that is given is in every row."""
    e = evaluate_audio(curated_table(spark, d), _p(d), run_ts="2024-01-02 03:04:05")
    return e.select("genre", F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("run_ts"))


def q_audio_cosine(spark, d):
    items = _text_items(spark, d)
    s = blended_pairs(items, _p(d), queries=materialize(text_queries(items, _p(d))))
    return _round(_per_query(s, "audio_cos"))


def q_blended_rank(spark, d):
    p = _p(d)
    items = _text_items(spark, d)
    return _round(blended_topk(items, p, p.k).select("genre", "qid", "cid", "score", "rank"))


# ------------------------------------------------------------------ windows, sorts, sampling

def q_sample_per_group(spark, d):
    c = complete_rows(curated_table(spark, d), ["id", "genre", "artist_id_primary"] + FEATURES)
    return sample_per_group(c.select("genre", "id"), "genre", _p(d).lookup_per_group, id_col="id", seed=42, salt="cap",
                            keep_rank="rank")


def q_knn_topk(spark, d):
    p = _p(d)
    items = eval_items(curated_table(spark, d), p)
    pairs = audio_pairs(items, p, queries=materialize(audio_queries(items, p)))
    sizes = group_counts(items, "genre")
    return _round(knn_topk(pairs, p.k, score="dist", group_sizes=sizes, few_queries=True)
                  .select("genre", "qid", "cid", "dist", "rank"))


def q_knn_cells(spark, d):
    """The neighbours of knn_topk from items stored by cells."""
    p = _p(d)
    items = eval_items(curated_table(spark, d), p)
    index = cell_index(items, p.features, few_groups=few_groups(p))
    return _round(knn_cells(materialize(audio_queries(items, p)), index, p.k, few_queries=True).select("genre", "qid", "cid", "dist", "rank"))


def q_first_hit_rank(spark, d):
    p = _p(d)
    items = eval_items(curated_table(spark, d), p)
    queries = materialize(audio_queries(items, p))
    hits = first_hit_rank(audio_pairs(items, p, queries=queries), p.k, few_queries=True)
    q = queries.select("genre", F.col("id").alias("qid"))
    return q.join(hits, ["genre", "qid"], "left")


def q_top_groups(spark, d):
    return top_groups(group_counts(curated(spark, d), "genre", "track_rows"), _p(d).top_groups, "genre", "track_rows")


def q_preview_rows(spark, d):
    """The first five rows by id of each of the three tables."""
    tables = {"tracks": fx.fx_tracks(spark, d), "artists": fx.fx_artists(spark, d), "curated": curated(spark, d)}
    parts = [df.orderBy("id", *(["genre"] if "genre" in df.columns else [])).limit(5)
             .select(F.lit(name).alias("table_name"), "id", "name", F.col("genre" if "genre" in df.columns else "name").alias("label"))
             for name, df in tables.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def q_capped_sample(spark, d):
    rows = curated_table(spark, d).select(F.col("id").alias("track_id"), F.col("name").alias("track_name"),
                                          "artist_name_primary", "genre")
    return capped_sample(rows, "track_id", _p(d).stratified_cap, seed=42)


def q_eval_report(spark, d):
    return _round(_placed(cmp.eval_report(_text_eval(spark, d))).drop("run_ts"))


def q_delta_report(spark, d):
    cur = curated_table(spark, d)
    delta = cmp.compare_runs(_audio_eval(spark, d, cur), _text_eval(spark, d, cur))
    return _round(_placed(cmp.delta_report(delta)))


def q_select_groups_top(spark, d):
    p = _p(d)
    return select_groups(curated(spark, d), mode="top_n", top=p.top_groups, min_rows=p.min_rows)


def q_select_groups_variety(spark, d):
    p = _variety(d)
    return select_groups(curated_table(spark, d), mode=p.group_mode, top=p.top_groups,
                         variety=p.variety_groups, min_rows=p.min_rows, seed=p.seed)


def q_select_groups_sql(spark, d):
    p = _variety(d)
    return select_groups_with_reason(curated_table(spark, d), top=p.top_groups, variety=p.variety_groups,
                                     min_rows=p.min_rows, seed=p.seed)


# ------------------------------------------------------------------ scalar functions

def q_primary_entity_id(spark, d):
    t = fx.fx_tracks(spark, d)
    return t.select("id", "id_artists", primary_entity_id("id_artists").alias("artist_id_primary"),
                    primary_entity_id("id_artists", "first").alias("artist_id_first"))


def q_parse_list_string(spark, d):
    a = fx.fx_artists(spark, d)
    arr = parse_list_string("genres")
    return a.select("id", "genres", F.array_join(arr, "|").alias("genre_list"),
                    F.when(arr.isNotNull(), F.size(arr)).alias("n_genres"))


def q_normalize_label(spark, d):
    a = entity_groups(fx.fx_artists(spark, d))
    ex = a.select("artist_id_primary", F.posexplode("artist_genres").alias("pos", "raw"))
    return ex.select("artist_id_primary", "pos", "raw", normalize_label("raw").alias("label"))


def q_explode_groups(spark, d):
    return explode_groups(entity_groups(fx.fx_artists(spark, d))).select("artist_id_primary", "genre")


def q_coalesce_existing(spark, d):
    c = curated(spark, d)
    return c.select(coalesce_existing(c, ["track_id", "id"]).alias("track_id"),
                    coalesce_existing(c, ["track_name", "name"]).alias("track_name"),
                    coalesce_existing(c, ["artist_name_primary", "artist_names", "artists"])
                    .alias("artist_name_primary"),
                    "genre")


def q_pick_text(spark, d):
    r = fx.fx_responses(spark, d)
    t = pick_text("response_json")
    return r.select("track_id", t.alias("lyrics"), t.isNotNull().alias("lyrics_found"))


def q_pick_text_variant(spark, d):
    """Texts of responses, some with a number in place of the text, and why there is none."""
    number = F.concat(F.lit('[{"plainLyrics":'), F.col("track_id"), F.lit("}]"))
    r = fx.fx_responses(spark, d).withColumn("response_json", F.when(F.col("track_id").cast("long") % 11 == 5, number).otherwise(F.col("response_json")))
    return pick_text_variant(r, "response_json").select("track_id", "lyrics", "reason")


def q_clean_list_value(spark, d):
    a = fx.fx_artists(spark, d).withColumn("genre_list", parse_list_string("genres"))
    return a.select("id", clean_list_value(a, "genre_list").alias("genres_clean"),
                    clean_list_value(a, "name").alias("name_clean"))


# ------------------------------------------------------------------ composite stages

def q_lookup_input_top(spark, d):
    p = _p(d)
    return lookup_input_top(curated_table(spark, d), top=p.lookup_top_groups, min_rows=p.lookup_min_rows,
                            per_group=p.lookup_per_group, seed=p.seed)


def q_lookup_input_stratified(spark, d):
    p = _p(d)
    return lookup_input_stratified(curated_table(spark, d), per_group=p.stratified_per_group,
                                   cap=p.stratified_cap, seed=p.seed)


def q_resolve_lookups(spark, d):
    return resolve_lookups(lookup_rows(spark, d), fx.fx_responses(spark, d))


def q_convert_text(spark, d):
    return convert_text(resolve_lookups(lookup_rows(spark, d), fx.fx_responses(spark, d)))


def q_delta_flagged(spark, d):
    cur = curated_table(spark, d)
    return _round(cmp.compare_runs(_audio_eval(spark, d, cur), _text_eval(spark, d, cur)).drop("run_ts"))


def q_delta_unflagged(spark, d):
    cur = curated_table(spark, d)
    return _round(cmp.compare_runs(_audio_eval(spark, d, cur), _text_eval(spark, d, cur),
                                   flagged=False).drop("run_ts"))


def q_pipeline_delta(spark, d):
    from grouprank.plans.pipeline import run_pipeline
    out = run_pipeline(spark, fx.fx_tracks(spark, d), fx.fx_artists(spark, d), io.scratch_path(spark, "pipeline"), _p(d),
                       text_records=text_records(spark, d))
    return _round(out["delta"].drop("run_ts"))


def q_pipeline_lookups(spark, d):
    """The text records that the workflow itself makes from lookup rows and stored responses, per group."""
    from grouprank.plans.pipeline import run_pipeline
    out = run_pipeline(spark, fx.fx_tracks(spark, d), fx.fx_artists(spark, d), io.scratch_path(spark, "pipeline"), _p(d),
                       responses=fx.fx_responses(spark, d), evaluate=False)
    return cmp.text_quality_by_group(out["enriched"])


def q_pipeline_incremental(spark, d):
    """The delta after a second run, for which the items of one entity's groups had changed."""
    from grouprank.plans.incremental import run_incremental
    tracks, artists, texts = fx.fx_tracks(spark, d), fx.fx_artists(spark, d), text_records(spark, d)
    other = tracks.withColumn("tempo", F.when(F.col("id_artists") == "['11']", F.col("tempo") * 2).otherwise(F.col("tempo")))
    base = io.scratch_path(spark, "incremental")
    run_incremental(spark, other, artists, base, texts, _p(d))
    return _round(run_incremental(spark, tracks, artists, base, texts, _p(d))["delta"].drop("run_ts"))


def q_eval_vectors(spark, d):
    """Numeric evaluation on 64-dim embedding arrays (second variant of the KNN core)."""
    p = _p(d).with_(n_queries=PARAMS.vector_n_queries, min_rows=PARAMS.vector_min_rows)
    items = complete_rows(fx.fx_vec_items(spark, d), ["id", "genre", "artist_id_primary", "embedding"])
    groups = select_groups(items, min_rows=p.min_rows, top=p.top_groups)
    items = keep_groups(items, groups, few_groups=True)
    items = materialize(keep_groups(items, group_counts(items).filter(F.col("n") >= p.n_queries + 50), few_groups=True), spread=True)
    q = materialize(sample_per_group(items, "genre", p.n_queries, id_col="id", seed=p.seed, salt="query", few_groups=True))
    pairs = pair_join(q, items, cols=["embedding"], few_queries=True).withColumn("dist", array_distance_column("embedding"))
    hits = first_hit_rank(pairs, p.k, few_queries=True)
    m = hit_metrics(q.select("genre", F.col("id").alias("qid")), hits)
    return _round(m.select("genre", "n_queries", F.lit(p.k).cast("int").alias("k"), "recall_at_k", "mrr_at_k"))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
