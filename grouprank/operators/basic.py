"""Projections, filters and de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grouprank.functions.columns import all_not_null, clean_list_value


ROWS_PER_FILE = 20_000


def select_existing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Keep the listed columns that exist, in list order."""
    return df.select(*[c for c in cols if c in df.columns])


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fail fast (no Spark job) when a required column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns {missing}; found {df.columns}")
    return df


def complete_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where every listed column IS NOT NULL (NaN is kept, as in SQL)."""
    require_columns(df, cols)
    return df.filter(all_not_null(cols))


def text_available(df: DataFrame, found: str = "lyrics_found", text: str = "lyrics") -> DataFrame:
    return df.filter((F.col(found) == F.lit(True)) & F.col(text).isNotNull())


def clean_lookup_input(df: DataFrame, cols: list[str], label_col: str) -> DataFrame:
    """Trim every field (lists joined, NULL -> ''), lower-case the label, drop rows with an empty field."""
    out = df.select(*[clean_list_value(df, c).alias(c) for c in cols])
    out = out.withColumn(label_col, F.lower(F.col(label_col)))
    for c in cols:
        out = out.filter(F.col(c) != "")
    return out


def dedupe_by_key(df: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """One row per key. The survivor is the first by ``order`` (default: all other columns
    ascending), so the result is defined, unlike ``dropDuplicates``.

    Plans as a shuffle on the keys plus a per-key top-1 (WindowGroupLimit runs a
    partial limit before the shuffle).
    """
    if order is None:
        order = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    if not order:
        return df.dropDuplicates(keys)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_dedupe_rn", F.row_number().over(w)).filter("_dedupe_rn = 1").drop("_dedupe_rn")


def materialize(df: DataFrame, *, spread: bool = False, dealt: bool = False) -> DataFrame:
    """Write ``df`` once as Parquet under the session's checkpoint folder and read it back.

    Used where one intermediate feeds several branches of a plan: every branch
    then reads the same rows (sampling stays consistent) instead of recomputing
    the lineage, and a lost executor recomputes nothing before this point. A
    Parquet table (unlike an RDD checkpoint) gives later reads column pruning,
    filter pushdown and real size statistics for join planning.

    ``spread`` is for inputs whose downstream work grows faster than their bytes
    (each candidate meets every query of its group). The rows are rebalanced (AQE
    sizes the tasks by bytes, so their number grows with the data) and written in
    files of at most ``ROWS_PER_FILE`` rows, which the readers of the table deal to
    all cores when there are few of them. ``dealt`` says that the rows come evenly from
    a shuffle by their ids already, so they are not rebalanced. Files are compressed with zstd: whole texts and terms
    are most of what is written.
    """
    from grouprank.sources.io import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    even = df.hint("rebalance") if spread and not dealt else df
    writer = even.write.option("compression", "zstd")
    writer = writer.option("maxRecordsPerFile", ROWS_PER_FILE) if spread else writer
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
