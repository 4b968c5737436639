"""Sampling, group selection, de-duplication, vectors: exact checks against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from grouprank.operators.basic import complete_rows, dedupe_by_key, require_columns
from grouprank.operators.groups import select_groups, select_groups_with_reason
from grouprank.operators.sampling import capped_sample, sample_per_group
from grouprank.operators.vectors import l2_normalize, zscore


def md5key(seed, salt, i):
    return hashlib.md5(f"{seed}:{salt}:{i}".encode()).hexdigest()


def test_sample_per_group_matches_brute_force(spark):
    rng = random.Random(7)
    rows = [(f"g{rng.randrange(4)}" if i % 10 else "hot", f"id{i}") for i in range(3000)]
    df = spark.createDataFrame(rows, "genre string, id string")
    for n, few in ((1, True), (5, True), (40, True), (5000, True), (1, False), (40, False), (5000, False), (None, False)):
        got = {(r.genre, r.id) for r in sample_per_group(df, "genre", n, id_col="id", seed=42, salt="s", few_groups=few).collect()}
        want = set()
        for g in {g for g, _ in rows}:
            ids = sorted((i for gg, i in rows if gg == g), key=lambda i: (md5key(42, "s", i), i))
            want |= {(g, i) for i in ids[:n]}
        assert got == want


def test_capped_sample_is_defined(spark):
    df = spark.createDataFrame([(f"t{i % 50}", f"g{i % 3}") for i in range(300)], "track_id string, genre string")
    a = [tuple(r) for r in capped_sample(df, "track_id", 17).collect()]
    b = [tuple(r) for r in capped_sample(df.repartition(7), "track_id", 17).collect()]
    assert sorted(a) == sorted(b) and len(a) == 17
    rows = [(r.track_id, r.genre) for r in df.collect()]
    assert sorted(a) == sorted(sorted(rows, key=lambda r: (md5key(42, "capped", r[0]), *r))[:17])
    assert capped_sample(df, "track_id", None).count() == 300


def test_select_groups(spark):
    rows = [("a", i) for i in range(50)] + [("b", i) for i in range(40)] + [("c", i) for i in range(30)] \
        + [("d", i) for i in range(30)] + [("e", i) for i in range(5)] + [(None, i) for i in range(99)]
    df = spark.createDataFrame(rows, "genre string, id int")
    top = [r.genre for r in select_groups(df, top=2, min_rows=10).collect()]
    assert sorted(top) == ["a", "b"]
    both = {r.genre for r in select_groups(df, mode="top_n_plus_variety", top=2, variety=5, min_rows=10).collect()}
    assert both == {"a", "b", "c", "d"}      # threshold applies to both slices
    reason = {(r.genre, r.reason) for r in select_groups_with_reason(df, top=2, variety=5, min_rows=10).collect()}
    assert reason == {("a", "top_n"), ("b", "top_n"), ("c", "variety"), ("d", "variety")}
    with pytest.raises(ValueError):
        select_groups(df, mode="bogus")


def test_require_and_complete(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None)], "id int, x double")
    with pytest.raises(ValueError):
        require_columns(df, ["id", "missing"])
    assert [r.id for r in complete_rows(df, ["id", "x"]).collect()] == [1]   # NaN kept, NULL dropped


def test_dedupe_by_key_keeps_first(spark):
    df = spark.createDataFrame([("1", "g", "b"), ("1", "g", "a"), ("2", "g", None), ("2", "g", "z")],
                               "id string, genre string, v string")
    got = sorted(tuple(r) for r in dedupe_by_key(df, ["id", "genre"]).collect())
    assert got == [("1", "g", "a"), ("2", "g", None)]


def test_zscore_and_l2_edge_cases(spark):
    df = spark.createDataFrame([("g", 1.0, 0.0), ("g", 1.0, 0.0), ("h", 1.0, 2.0), ("h", 3.0, 4.0)],
                               "genre string, a double, b double")
    z = zscore(df, "genre", ["a", "b"]).orderBy("genre", "z_a").collect()
    assert [(r.z_a, r.z_b) for r in z if r.genre == "g"] == [(0.0, 0.0), (0.0, 0.0)]   # constant -> 0
    assert [(r.z_a, r.z_b) for r in z if r.genre == "h"] == [(-1.0, -1.0), (1.0, 1.0)]
    u = l2_normalize(df, ["b"], prefix="u_").select("u_b").collect()
    assert sorted(r.u_b for r in u) == [0.0, 0.0, 1.0, 1.0]                              # zero stays zero


def test_variant_reasons(spark):
    """Responses of every shape; texts are taken from strings only."""
    from grouprank.functions.columns import pick_text_variant
    cases = {None: (None, "no_response"), "not json": (None, "not_json"), "": (None, "not_json"), "{}": (None, "no_array"), '"x"': (None, "no_array"),
             "[]": (None, "empty"), "[{}]": (None, "empty"), "[null]": (None, "empty"), '[{"plainLyrics":""}]': (None, "empty"),
             '[{"plainLyrics":null,"syncedLyrics":"b"}]': ("b", "ok"), '[{"plainLyrics":5}]': (None, "not_text"), '[{"plainLyrics":["a"]}]': (None, "not_text"),
             '[{"plainLyrics":5,"syncedLyrics":"b"}]': ("b", "ok"), '[{"plainLyrics":"a","syncedLyrics":"b"}]': ("a", "ok")}
    df = spark.createDataFrame([(k,) for k in cases], "r string")
    assert {r.r: (r.lyrics, r.reason) for r in pick_text_variant(df, "r").collect()} == cases


def test_sketches_merge_without_a_rescan(spark):
    from grouprank.plans import compare as cmp
    rows = spark.range(60_000).selectExpr("cast(id % 3 as string) as genre", "cast(id % 40 as int) as release_year", "cast(id % 20000 as string) as id")
    stored = cmp.distinct_sketches(rows, "genre", "release_year")
    whole = cmp.rolled_up(stored).first().estimate
    assert abs(whole - 20_000) < 4 * 1.04 / 2 ** 7 * 20_000
    by_genre = {r.genre: r.estimate for r in cmp.rolled_up(stored, "genre").collect()}
    exact = {r.genre: r.distinct_tracks for r in cmp.distinct_items_per_group(rows).collect()}
    assert by_genre.keys() == exact.keys() and all(abs(by_genre[g] - n) < 4 * 1.04 / 2 ** 7 * n for g, n in exact.items())


def test_hashed_weights_tokenise_once(spark):
    """Texts are read for the frequencies only: the weights come from what was written."""
    from grouprank.operators.text import tfidf_hashed
    df = spark.createDataFrame([("1", "a b b"), ("2", "b c"), ("3", "")], "track_id string, lyrics string")
    whole, lean = tfidf_hashed(df, "lyrics", 64), tfidf_hashed(df, "lyrics", 64, keep=["track_id"])
    assert whole.columns == ["track_id", "lyrics", "lyr_vec"] and lean.columns == ["track_id", "lyr_vec"]
    assert {r.track_id: r.lyr_vec for r in whole.collect()} == {r.track_id: r.lyr_vec for r in lean.collect()}
    plan = lean._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "LocalTableScan" not in plan and "lyrics" not in plan
