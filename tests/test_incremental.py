"""A second run on changed input: the result of a full run, and only what changed written anew."""

import os

from pyspark.sql import functions as F

from grouprank.plans import fixtures as fx
from grouprank.plans.incremental import Stages, changed_groups, fingerprints, run_incremental
from grouprank.plans.pipeline import run_pipeline
from grouprank.plans.queries import text_records
from tests.conftest import SF001, small_params


def files(base):
    """{(stage, group): {file: time it was written}}"""
    found = {}
    for folder, _, names in os.walk(base):
        stage, _, part = os.path.relpath(folder, base).partition("/")
        for n in names:
            if n.startswith("part-") and part.startswith("genre="):
                found.setdefault((stage, part[6:]), {})[n] = os.stat(f"{folder}/{n}").st_mtime_ns
    return found


def rows(df):
    return sorted(str(sorted((c, round(v, 9) if isinstance(v, float) else v) for c, v in r.asDict().items() if c != "run_ts")) for r in df.collect())


def test_fingerprints_see_every_change(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", None, 1), ("b", 2, 2), ("b", 2, 2), ("c", 3, 3)], "genre string, x int, y int")
    one = {r.genre: tuple(r)[1:] for r in fingerprints(df).collect()}
    assert one == {r.genre: tuple(r)[1:] for r in fingerprints(df.repartition(7).orderBy("y").select("y", "x", "genre")).collect()}
    other = spark.createDataFrame([("a", 1, 1), ("a", None, None), ("b", 2, 2), ("c", 3, 3), ("d", 1, 1)], "genre string, x int, y int")
    assert sorted(r.genre for r in changed_groups(fingerprints(other), fingerprints(df)).collect()) == ["a", "b", "d"]
    assert changed_groups(fingerprints(df), None).count() == 3 and changed_groups(fingerprints(df), fingerprints(df)).count() == 0


def test_stages_write_only_what_changed(spark, tmp_path):
    """Groups that go are not read, groups that come back are made anew, and nothing is written where nothing changed."""
    base, schema = str(tmp_path / "run"), "genre string, x int"

    def run(rows):
        return sorted(map(tuple, Stages(spark, "file://" + base, "genre").own("t", spark.createDataFrame(rows, schema)).select("genre", "x").collect()))
    one = [("007", 1), ("007", 2), ("b", None), ("c", 3)]
    assert run(one) == sorted(one, key=str)
    first = files(base)
    two = [("007", 1), ("b", 5), ("007", 2)]
    assert run(two) == sorted(two)
    second = files(base)
    assert second["t", "007"] == first["t", "007"] and second["t", "b"] != first["t", "b"]
    assert run(two) == sorted(two) and files(base) == second
    three = [("c", 4), ("007", 1), ("007", 2)]
    assert run(three) == sorted(three)
    assert files(base)["t", "c"] != first["t", "c"] and files(base)["t", "007"] == first["t", "007"]
    assert run([]) == []


def test_second_run_equals_a_full_one(spark, tmp_path):
    p = small_params().with_(text_min_rows=10, top_groups=3, n_queries=20, text_n_queries=10)
    tracks, artists, texts = fx.fx_tracks(spark, SF001), fx.fx_artists(spark, SF001), text_records(spark, SF001)
    base = str(tmp_path / "run")
    run_incremental(spark, tracks, artists, "file://" + base, texts, p)
    before = files(base)
    # an entity of one group only (its label has no second name), which is evaluated: one group changes
    evaluated = [g for stage, g in before if stage == "audio"]
    alone = artists.filter(F.lower(F.regexp_extract("genres", r"^\['([A-Za-z]+) '\]$", 1)).isin(evaluated))
    entity = alone.join(tracks.select(F.expr("substring_index(substring_index(id_artists, \"'\", 2), \"'\", -1)").alias("id")),
                                                                  "id", "left_semi").orderBy("id").first()
    group = entity.genres.strip("[' ]").lower()
    changed = tracks.withColumn("tempo", F.when(F.col("id_artists") == f"['{entity.id}']", F.col("tempo") * 3).otherwise(F.col("tempo")))
    second = run_incremental(spark, changed, artists, "file://" + base, texts, p)
    full = run_pipeline(spark, changed, artists, "file://" + str(tmp_path / "full"), p, text_records=texts)
    assert set(second) == {"curated", "enriched", "predictors", "audio", "audio_text", "delta"}
    for name, df in second.items():
        assert rows(df) == rows(full[name]), name
    after = files(base)
    same = {k for k in before if before[k] == after[k]}
    for stage in ("curated", "predictors", "audio"):
        assert (stage, group) in before and (stage, group) not in same
        assert {k for k in before if k[0] == stage and k[1] != group} <= same
    assert {k for k in before if k[0] == "enriched"} <= same  # the texts are the same
