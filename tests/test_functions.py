"""Scalar functions on hand-made edge rows."""

import pytest
from pyspark.sql import functions as F

from grouprank.functions.columns import (clean_list_value, parse_list_string, pick_text,
                                         primary_entity_id, release_year)
from grouprank.operators.text import tokens


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_primary_entity_id(spark):
    vals = ["['abc']", "['a', 'b']", "[]", None, '["x"]']
    assert one_col(spark, vals, primary_entity_id) == ["abc", "", "", None, ""]
    assert one_col(spark, vals, lambda c: primary_entity_id(c, "first")) == ["abc", "a", "", None, ""]
    with pytest.raises(ValueError):
        primary_entity_id("x", "bogus")


def test_parse_list_string(spark):
    vals = ["['rock', 'Art Pop ']", "[]", "[ ]", None, "[\"children's music\", 'x']", "['a',,'b']"]
    got = one_col(spark, vals, parse_list_string)
    assert got == [["rock", "Art Pop"], [], [], None, ['"childrens music"', "x"], ["a", "", "b"]]
    assert one_col(spark, ["a, b", "['a'", "'a' ,\t'b']", "", "['']"], parse_list_string) == [["a", "b"], ["a"], ["a", "b"], [], []]


def test_release_year(spark):
    vals = ["1998-01-01", "2001", "99", "abcd", None]
    assert one_col(spark, vals, release_year) == [1998, 2001, None, None, None]


def test_pick_text(spark):
    vals = ['[{"plainLyrics":"","syncedLyrics":"s"}]', "[]", "bad", '[{"plainLyrics":"a"},{"plainLyrics":"b"}]',
            '[{"plainLyrics":null,"syncedLyrics":""}]', None]
    assert one_col(spark, vals, pick_text) == ["s", None, None, "a", None, None]
    assert one_col(spark, ['{"plainLyrics":"x"}', ' \n[{"plainLyrics":"two\\nlines \\"q\\""}]'], pick_text) == [None, 'two\nlines "q"']


def test_tokens_modes(spark):
    assert one_col(spark, [" Hello  the"], lambda c: tokens("x", "ml")) == [["", "hello", "", "the"]]
    assert one_col(spark, ["cat, Cat"], lambda c: tokens("x", "ml")) == [["cat,", "cat"]]
    assert one_col(spark, [" Hello  the \n"], lambda c: tokens("x", "words")) == [["hello", "the"]]


def test_clean_list_value(spark):
    df = spark.createDataFrame([([" a ", None, "b"], "  n "), (None, None), (["\t"], "\t\n"), (["x\u00a0"], "\u2003y\x1f")],
                               "l array<string>, s string")
    rows = df.select(clean_list_value(df, "l").alias("l"), clean_list_value(df, "s").alias("s")).collect()
    assert [tuple(r) for r in rows] == [("a b", "n"), ("", ""), ("", ""), ("x", "y")]


def test_hashed_buckets_are_those_of_spark_ml(spark):
    """Texts of every length modulo four, past ASCII, empty, and another number of buckets."""
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array
    from grouprank.operators.text import with_ml_bucket
    words = ["", "a", "ab", "abc", "abcd", "abcde", "é", "naïve", "日本", "😀x", "words" * 30, "z" * 63, "ÿ" * 5] + [f"w{n * n}" for n in range(200)]
    df = spark.createDataFrame([(w, [w]) for w in words], "w string, t array<string>")
    for buckets in (4096, 1000):
        ml = HashingTF(inputCol="t", outputCol="v", numFeatures=buckets).transform(df)
        want = {r.w: int(r.b) - 1 for r in ml.select("w", F.array_position(vector_to_array("v"), 1.0).alias("b")).collect()}
        assert {r.w: r.b for r in with_ml_bucket(df, "w", buckets, "b").collect()} == want
