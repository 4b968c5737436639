"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import re
import sys
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT = "spark.checkpoint.dir"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of an Arrow batch where rows hold whole texts.
TEXT_ROWS = 1000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it in spark.checkpoint.dir.

    A local session without the setting (tests) gets one of its own; any other session must set it.
    """
    folder = spark.conf.get(CHECKPOINT, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
        raise ValueError(f"set {CHECKPOINT} to a folder that all executors share")
    return own_folder()


@lru_cache(maxsize=1)
def own_folder() -> str:
    return "file://" + tempfile.mkdtemp(prefix="grouprank-llm-")


def written(df: DataFrame, name: str, compression: str = "snappy", rows_per_batch: int | None = None) -> DataFrame:
    """Write df once as Parquet in the shared folder and read it back.

    Branches that follow see the same rows, and a lost executor recomputes nothing before this point. rows_per_batch
    bounds the Arrow batches of this write alone: whole texts in the usual 10,000 rows take much memory.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    usual = spark.conf.get(BATCH_ROWS)
    if rows_per_batch:
        spark.conf.set(BATCH_ROWS, str(rows_per_batch))
    try:
        df.write.option("compression", compression).parquet(path)
    finally:
        spark.conf.set(BATCH_ROWS, usual)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of each query that is made and run within, as soon as it has ended.

    For steps that are run once, to be written or collected; a frame that is returned should be made outside.
    """
    usual = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, usual)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def narrow(df: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """Only the named columns, cast; further columns of the input, whatever they are called, take no part."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in columns])


def with_carried(df: DataFrame, columns: tuple[tuple[str, str], ...], carry: tuple[str, ...]) -> DataFrame:
    """The named columns, cast, and the columns in carry as c0, c1, ... (so that no name clashes)."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c, kind in columns], *[F.col(c).alias(f"c{k}") for k, c in enumerate(carry)])


def carried_schema(df: DataFrame) -> str:
    """Schema text of the columns c0, c1, ... of df, each after a comma."""
    return "".join(f", {f.name} {f.dataType.simpleString()}" for f in df.schema if f.name[0] == "c" and f.name[1:].isdigit())


def give_back() -> None:
    """Return freed memory to the system: idle Python workers stay, and would keep what their largest task took."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def text_slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows whose texts hold about most_bytes (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.nan_to_num(np.asarray(pc.binary_length(col).to_numpy(zero_copy_only=False), dtype=np.float64))
        place = np.concatenate(([0.0], np.cumsum(sizes)))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(place, place[start] + most_bytes, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end
        batch = col = None
    give_back()


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Each run of rows with equal keys (numbers, not null) as one table, of batches that are sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            now = tuple(c[lo] for c in columns)
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            last = now
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)
