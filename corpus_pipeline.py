"""The corpus pipeline: each stage keeps, cuts or places documents by one of the operators of grouprank.llm.

language ID -> n-gram Jaccard join -> suffix-array dedup -> benchmark decontamination -> best-fit packing

Every stage takes the documents that the one before kept and, but for the last, returns the columns of documents.
Rows with null ids or texts, repeated rows and empty tables are treated as the operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grouprank.llm.common import documents, written
from grouprank.llm.decontamination import contaminated
from grouprank.llm.jaccard_join import jaccard_groups
from grouprank.llm.language_id import UNKNOWN, identify, train
from grouprank.llm.packing import pack_documents
from grouprank.llm.suffix_dedup import remove_repeats

#: A document stays if its language is found with at least this score.
LEAST_SCORE = 0.5


def restored(found: DataFrame, docs: DataFrame, **anew: Column) -> DataFrame:
    """The columns of docs, all of which were carried as c0, c1, ..., but for those computed anew."""
    return found.select(*[anew.get(c, F.col(f"c{k}")).alias(c) for k, c in enumerate(docs.columns)])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found stay; those without text or letters, or torn between languages, go."""
    found = identify(docs, train(docs), tuple(docs.columns))
    return restored(found.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE)), docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the least id, of rows with that id the least hash."""
    classes = written(jaccard_groups(docs), "classes")
    first = classes.where("doc_id = class_id and class_set is not null").select("class_set", "doc_id", "text_hash")
    least = first.groupBy("class_set").agg(F.min("text_hash").alias("least"))
    same_id = first.join(least, "class_set").where("text_hash != least").select("doc_id", "text_hash")
    rest = classes.where("doc_id != class_id").select("doc_id", "text_hash").union(same_id).toDF("_doc_id", "_text_hash").distinct()
    marked = docs.withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    same = (marked["doc_id"] == rest["_doc_id"]) & (marked["_hash"] == rest["_text_hash"])
    return marked.join(rest.hint("merge"), same, "left_anti").dropDuplicates(["doc_id", "_hash"]).select(*docs.columns)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose what an earlier document holds too; documents that lose all of their text go."""
    found = remove_repeats(docs, tuple(docs.columns), with_kept=True)
    some = found.where((F.col("n_removed") == 0) | (F.trim("kept") != ""))
    text = docs.columns.index("text")
    cut = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col(f"c{text}"))
    return restored(some, docs, text=cut, **({"n_chars": F.length(cut).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}))


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    found = contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), tuple(docs.columns))
    return restored(found.where(~F.col("is_contaminated")), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: a place in a sequence for every piece of every document that is left."""
    return pack_documents(docs)


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_strings),
    ("benchmark decontamination", benchmark_free),
    ("best-fit packing", packing),
]
#: SQL has no tokenizer, n-gram classifier or byte-wise removal: the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, each to what the one before wrote."""
    docs = documents(spark, sf_dir)
    for n, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"stage-{n}")
    return docs
