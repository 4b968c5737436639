"""Sources and sinks: partition values, JSONL nulls, positional CSV with a header."""

import pytest
from pyspark.sql import functions as F

from grouprank.sources import io


def test_partition_values_stay_strings(spark):
    df = spark.createDataFrame([("007", 1), ("7", 2), ("a/b c", 3), ("r&b", 4)], "genre string, v int")
    path = io.scratch_path(spark, "t-part")
    io.write_by_group(df, path, "genre")
    back = spark.read.schema(df.schema).parquet(path)
    assert sorted((r.genre, r.v) for r in back.collect()) == [("007", 1), ("7", 2), ("a/b c", 3), ("r&b", 4)]
    t = io.register_table(spark, "t_part_roundtrip", path, "genre", "v int, genre string")
    assert sorted(r.genre for r in t.collect()) == ["007", "7", "a/b c", "r&b"]


AWKWARD = [("1", "two\nlines\r\nand \"quotes\""), ("2", "  padded "), ("3", ""), ("4", None), ("5", 'a,"b",\\'), ("6", "\\N is text?"),
           ("7", "tab\tend"), ("8", '"'), ("9", "ends in \\")]


def test_csv_keeps_fields_as_they_are(spark):
    df = spark.createDataFrame(AWKWARD, "id string, text string")
    path = io.scratch_path(spark, "t-awkward")
    io.unload_csv(df, path)
    assert sorted((tuple(r) for r in io.read_csv(spark, path, schema=df.schema, multi_line=True).collect())) == AWKWARD
    path = io.scratch_path(spark, "t-awkward")
    io.unload_csv(df, path, escape="\\")
    assert sorted((tuple(r) for r in io.read_positional_csv(spark, path, df.columns, header=True, multi_line=True).collect())) == AWKWARD


def test_a_large_file_is_read_by_many_tasks(spark):
    df = spark.range(40_000).select(F.col("id").cast("string").alias("a"), F.concat(F.lit('say "x", '), F.col("id")).alias("b"))
    path, again = io.scratch_path(spark, "t-large"), io.scratch_path(spark, "t-large")
    io.unload_csv(df.coalesce(1), path)
    io.unload_csv(df.coalesce(1), again, escape="\\")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        for read in (lambda **kw: io.read_csv(spark, path, schema=df.schema, **kw), lambda **kw: io.read_positional_csv(spark, again, df.columns, header=True, **kw)):
            assert read().rdd.getNumPartitions() > 5 and read(multi_line=True).rdd.getNumPartitions() == 1
            assert sorted(map(tuple, read().collect())) == sorted(map(tuple, df.collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_csv_infers_types(spark):
    df = spark.createDataFrame([(1, 2.5, "x"), (2, None, None)], "a int, b double, c string")
    path = io.scratch_path(spark, "t-infer")
    io.unload_csv(df, path)
    back = io.read_csv(spark, path)
    assert back.dtypes == [("a", "int"), ("b", "double"), ("c", "string")]
    assert sorted(tuple(r) for r in back.collect()) == [(1, 2.5, "x"), (2, None, None)]


def test_scratch_needs_a_shared_folder_and_is_cleared(spark):
    with io.scratch_scope(spark):
        path = io.scratch_path(spark, "t-scope")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path)
    class Unset:
        class conf:
            get = staticmethod(lambda key, default=None: default)
    with pytest.raises(ValueError):
        io.scratch_path(Unset, "t-none")


def test_jsonl_writes_nulls(spark):
    df = spark.createDataFrame([("1", None, False), ("2", "la la", True)], "track_id string, lyrics string, lyrics_found boolean")
    path = io.scratch_path(spark, "t-jsonl")
    io.write_jsonl(df, path)
    lines = spark.read.text(path).collect()
    assert any('"lyrics":null' in r.value for r in lines)
    back = io.read_jsonl(spark, path, df.schema)
    assert sorted(tuple(r) for r in back.collect()) == [("1", None, False), ("2", "la la", True)]


def test_positional_csv_drops_header(spark):
    df = spark.createDataFrame([("1", 'say "hi"', "a, b", "rock"), ("2", "x", "y", "pop")],
                               "track_id string, track_name string, artist_name_primary string, genre string")
    path = io.scratch_path(spark, "t-csv")
    io.unload_csv(df, path, header=True, escape="\\")
    back = io.read_positional_csv(spark, path, df.columns, header=True)
    assert sorted(tuple(r) for r in back.collect()) == sorted(tuple(r) for r in df.collect())


def test_catalog(spark):
    io.ensure_database(spark, "t_db")
    path = io.scratch_path(spark, "t-cat")
    io.write_by_group(spark.range(3).withColumn("genre", F.lit("g")), path, "genre", cluster=False)
    io.register_table(spark, "t_db.t_tab", path, "genre", "id bigint, genre string")
    assert [r.tableName for r in io.list_tables(spark, "t_db").collect()] == ["t_tab"]


def test_intermediate_tables_are_compressed_with_zstd(spark):
    from grouprank.operators.basic import materialize
    texts = spark.createDataFrame([(i, f"some words of text {i}") for i in range(50)], "id long, lyrics string")
    for kept in (materialize(texts), materialize(texts, spread=True)):
        assert kept.inputFiles() and all(f.endswith(".zstd.parquet") for f in kept.inputFiles())
        assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, texts.collect()))
