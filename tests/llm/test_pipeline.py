import corpus_pipeline as pipeline
from grouprank.llm.common import shared_folder, written
from tests.conftest import SF001
from tests.llm.helpers import awkward_documents, empty_documents, prose


def test_stages_take_effect_and_keep_the_columns(spark, tmp_path):
    benchmark = spark.createDataFrame([(1, prose(55, 30))], "item_id long, text string")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(i, prose(i, 70), "en", "s", 9) for i in range(1, 21)]
    rows += [(30, prose(3, 70), "en", "s", 9), (31, f"{prose(4, 70)} tail", "en", "s", 9),  # an exact and a near copy
             (40, "!! 12 34", "en", "s", 9), (41, None, None, None, None),                  # no language
             (50, f"{prose(60, 40)} {prose(55, 30)} {prose(61, 40)}", "en", "s", 9),         # a benchmark passage
             (60, f"{prose(70, 40)} {' '.join(prose(5, 70).split()[10:40])} {prose(71, 40)}", "en", "s", 9)]  # a repeated passage
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, str(tmp_path)), "t")
        assert after.dtypes == docs.dtypes
        gone = {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in after.collect()}
        assert gone == {"language ID": {40, 41}, "n-gram Jaccard join": {30, 31}, "suffix-array dedup": set(), "benchmark decontamination": {50}}[name]
        if name == "suffix-array dedup":
            text = {r["doc_id"]: (r["text"], r["n_chars"]) for r in after.collect()}
            assert text[1] == (prose(1, 70), len(prose(1, 70)))  # n_chars is computed anew
            assert len(text[60][0]) == text[60][1] < len(rows[-1][1]) - 100
        docs = after
    packed = pipeline.packing(spark, docs, str(tmp_path))
    assert {r["doc_id"] for r in packed.collect()} == {*range(1, 21), 60}


def test_awkward_and_empty_documents(spark, tmp_path):
    spark.createDataFrame([(1, prose(55, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = awkward_documents(spark)
    left = docs
    for _, stage in pipeline.STAGES[:-1]:
        left = written(stage(spark, left, str(tmp_path)), "t")
        assert left.dtypes == docs.dtypes
    ids = sorted(str(r["doc_id"]) for r in left.collect())
    assert len(ids) == len(set(ids)) and {"1", "5", "9", "10", "11", "12", "13"} <= set(ids) and not {"2", "3", "4", "8"} & set(ids)
    left = empty_documents(spark)
    for _, stage in pipeline.STAGES:
        left = stage(spark, left, str(tmp_path))
    assert left.collect() == []


def test_run(spark):
    rows = pipeline.run(spark, SF001).collect()
    assert rows and max(r["offset"] + r["length"] for r in rows) <= 2048
    assert shared_folder(spark)


def test_one_row_of_near_copies_with_one_id_stays(spark, tmp_path):
    rows = [(1, prose(1, 70)), (1, prose(1, 70) + " tail"), (2, prose(1, 70) + " end"),  # near copies, two of one id
            (3, prose(3, 70)), (3, prose(4, 70))]                                        # one id, unlike texts
    left = pipeline.near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string"), str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in left) == [1, 3, 3]
