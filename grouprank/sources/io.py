"""Scans, sinks and catalog helpers.

Scratch output goes under the session's ``spark.checkpoint.dir`` (shared storage
on a cluster), never a machine-local folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def scan(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table by name, or a Parquet path (anything with a '/')."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


#: Stands for NULL in CSV files, so that an empty text stays an empty text.
CSV_NULL = "\\N"

#: Fields as they are: line breaks inside quotes, blanks at either end, empty texts.
CSV_FAITHFUL = {"quote": '"', "nullValue": CSV_NULL, "emptyValue": "", "encoding": "UTF-8",
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, null_value: str = CSV_NULL, multi_line: bool = False) -> DataFrame:
    """Comma separated, '"' quoted, '"' escaped (RFC 4180 style).

    Without ``schema`` the column types are inferred. A large file is read by many tasks. ``multi_line`` allows line
    breaks inside quoted fields; a file is then read by one task, so write many (``unload_csv`` writes one a task).
    """
    r = spark.read.options(**CSV_FAITHFUL).options(header=header, escape='"', multiLine=multi_line, nullValue=null_value)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def read_positional_csv(spark: SparkSession, path: str, names: list[str], *,
                        header: bool = False, escape: str = "\\", multi_line: bool = False) -> DataFrame:
    """Headerless CSV read by position into string columns ``names``. ``multi_line``: as for ``read_csv``.

    Rows with fewer fields get NULLs (and fall to the valid-input filter). With
    ``header=True`` the first line is skipped, and any row equal to the column
    names is dropped too.
    """
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = (spark.read.options(**CSV_FAITHFUL).options(header=header, escape=escape, multiLine=multi_line, mode="PERMISSIVE")
               .schema(schema).csv(path))
    if header:
        from functools import reduce
        from pyspark.sql import functions as F
        same = reduce(lambda a, b: a & b, [F.col(n) == F.lit(n) for n in names])
        df = df.filter(~F.coalesce(same, F.lit(False)))
    return df


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def write_by_group(df: DataFrame, path: str, group: str = "genre", *, cluster: bool = True,
                   mode: str = "overwrite") -> None:
    """Parquet partitioned by ``group``.

    ``cluster`` rebalances rows so each task writes few group folders; it uses
    a rebalance hint, which AQE splits for large groups instead of sending a whole
    group to one task.
    """
    out = df.hint("rebalance", group) if cluster else df
    out.write.mode(mode).partitionBy(group).parquet(path)


def create_table_as(spark: SparkSession, name: str, df: DataFrame, path: str,
                    partition_by: list[str] | None = None) -> DataFrame:
    """CTAS to an external Parquet location (replaces the table and its files)."""
    w = df.write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)
    return spark.table(name)


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A table bucketed and sorted by ``keys``, one file a bucket: tables with as many buckets join on the keys without a shuffle."""
    df.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def unload_csv(df: DataFrame, path: str, *, header: bool = True, escape: str = '"') -> None:
    """Comma separated, uncompressed, with header; NULL is written as CSV_NULL, all else as it is."""
    # on writing, emptyValue is what stands in the file: quotes around nothing
    (df.write.mode("overwrite").options(**(CSV_FAITHFUL | {"emptyValue": '""'}))
       .options(header=header, compression="none", escape=escape, escapeQuotes=True).csv(path))


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line; NULL fields are written as ``null``."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def list_databases(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW DATABASES")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def register_table(spark: SparkSession, name: str, path: str, partitioned_by: str | None = None,
                   schema_ddl: str | None = None) -> DataFrame:
    """A queryable table over Parquet files; partitions are discovered."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    cols = f"({schema_ddl}) " if schema_ddl else ""
    part = f"PARTITIONED BY ({partitioned_by}) " if partitioned_by and schema_ddl else ""
    spark.sql(f"CREATE TABLE {name} {cols}USING parquet {part}LOCATION '{path}'")
    if partitioned_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return spark.table(name)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's checkpoint folder."""
    from grouprank.session import checkpoint_dir
    path = f"{checkpoint_dir(spark)}/scratch/{label}-{uuid.uuid4().hex[:12]}"
    for held in _scopes:
        held.append(path)
    return path


_scopes: list[list[str]] = []


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the scratch folders that were named inside; results must have been written elsewhere by then."""
    held: list[str] = []
    _scopes.append(held)
    try:
        yield
    finally:
        _scopes.remove(held)
        conf = spark._jsc.hadoopConfiguration()
        for path in held:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)
