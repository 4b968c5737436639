"""Reproducible per-group sampling.

Random order is the md5 hex of ``seed:salt:id`` (same text in every engine), ties
broken by the id, so a sample is a pure function of the data and the seed.

A group may hold a large share of all rows, so no plan here puts a whole group into
one task or shuffles all rows on the group:

* Groups from a chooser (``few_groups``, at most top + variety of them): a histogram of
  the leading hash bits per group (map-side combined, at most 2**bits rows per group)
  finds the bucket where the running count reaches ``n``. That cut, one row per group,
  is broadcast; rows beyond it go before any shuffle, and the survivors (``n`` and about
  size/2**bits per group) are ranked.
* Any number of groups, and the whole frame: rows are ranked by (group, salt) first,
  with a partial limit before the shuffle, and at most ``n`` rows of each of ``SALTS``
  salts are ranked again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grouprank.functions.columns import sample_key

_HEX_DIGITS = 5          # 20 bits -> 1,048,576 histogram buckets per group
SALTS = 32


def with_sample_key(df: DataFrame, id_col: str, seed, salt: str, name: str = "_sk") -> DataFrame:
    return df.withColumn(name, sample_key(seed, salt, id_col))


def _first(df: DataFrame, n: int, by: list[str], order: list[str], rank: str = "_rn") -> DataFrame:
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def _salted(keyed: DataFrame, n: int, groups: list[str], order: list[str]) -> DataFrame:
    """At most ``n`` rows of each (group, salt): they hold the first ``n`` of each group."""
    salted = keyed.withColumn("_salt", F.pmod(F.xxhash64("_sk"), F.lit(SALTS)))
    return _first(salted, n, [*groups, "_salt"], order).drop("_salt", "_rn")


#: Rows of a range where rows are put in order by ranges; the number of ranges grows with the rows.
ROWS_PER_RANGE = 250_000


def range_count(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_RANGE))


def shuffle_tasks(df: DataFrame, least: int) -> int:
    """``least`` tasks, and as many as a shuffle has at least."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), least)


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """Add ``name``: the place from 0 of a row among those of its ``keys``, in the order of the ``order`` columns.

    No window holds a whole key: rows are put into ranges of about ``ROWS_PER_RANGE`` rows, written with the number of
    their range, counted within it, and shifted by the rows of the key in the ranges before. ``df`` is counted first,
    so it should be a written table. Rows that are equal in all of ``order`` are numbered in any way.
    """
    from grouprank.operators.basic import materialize
    ranges = range_count(df.count())
    placed = materialize(df.repartitionByRange(ranges, *keys, *order).withColumn("_pid", F.spark_partition_id()))
    placed = placed.repartition(shuffle_tasks(df, ranges), "_pid", *keys)
    local = F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order)) - 1
    before = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    shift = (placed.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_rows"))
             .select("_pid", *keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_shift")))
    same = [placed[c].eqNullSafe(F.col(f"_r_{c}")) for c in ["_pid", *keys]]
    shift = shift.withColumnsRenamed({c: f"_r_{c}" for c in ["_pid", *keys]})
    return placed.withColumn("_local", local).join(shift, same).select(*df.columns, (F.col("_shift") + F.col("_local")).alias(name))


def sample_per_group(df: DataFrame, group_cols, n: int | None, *, id_col: str, seed=42,
                     salt: str = "cap", keep_rank: str | None = None,
                     tiebreak: list[str] | None = None, few_groups: bool = False) -> DataFrame:
    """The ``n`` rows with the smallest sample key in each group (all rows if fewer, or if ``n`` is None).

    Order: sample key, then ``id_col``, then ``tiebreak`` columns (for ids that
    repeat inside a group). ``few_groups`` says that a chooser bounds the number of
    groups, so one row per group may be broadcast.
    """
    groups = [group_cols] if isinstance(group_cols, str) else list(group_cols)
    keyed = with_sample_key(df, id_col, seed, salt)
    order = ["_sk", id_col, *(tiebreak or [])]
    if n is None:
        if not keep_rank:
            return df
        ranked = numbered(keyed, groups, order, "_place")
        return ranked.select(*df.columns, (F.col("_place") + 1).cast("int").alias(keep_rank))
    if few_groups:
        bucket = F.conv(F.substring("_sk", 1, _HEX_DIGITS), 16, 10).cast("int")
        keyed = keyed.withColumn("_sb", bucket)
        hist = keyed.groupBy(*groups, "_sb").agg(F.count(F.lit(1)).alias("_cnt"))
        before = Window.partitionBy(*groups).orderBy("_sb").rowsBetween(Window.unboundedPreceding, -1)
        cut = (hist.withColumn("_before", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
                   .filter(F.col("_before") < n)
                   .groupBy(*groups).agg(F.max("_sb").alias("_cut")))
        survivors = keyed.join(F.broadcast(cut), groups).filter(F.col("_sb") <= F.col("_cut")).drop("_sb", "_cut")
    else:
        survivors = _salted(keyed, n, groups, order)
    out = _first(survivors, n, groups, order)
    return out.select(*df.columns, *([F.col("_rn").alias(keep_rank)] if keep_rank else []))


def random_subset(df: DataFrame, id_col: str, m: int | None, *, seed=42, salt: str = "group") -> DataFrame:
    """``m`` rows in sample-key order over the whole frame (all rows if ``m`` is None).

    Each salt keeps its first ``m`` rows in a task of its own, so the final ordered limit
    reads at most ``SALTS * m`` rows, however many tasks the input has. Ties on the key (an
    id repeated in several rows) are broken by the id, then by the remaining columns, so
    the subset is defined.
    """
    if m is None:
        return df
    order = ["_sk", id_col, *(c for c in df.columns if c != id_col)]
    return _salted(with_sample_key(df, id_col, seed, salt), m, [], order).orderBy(*order).limit(m).drop("_sk")


def capped_sample(df: DataFrame, id_col: str, cap: int | None, *, seed=42, salt: str = "capped") -> DataFrame:
    """An overall row cap that is defined: the first ``cap`` rows in sample-key order."""
    return random_subset(df, id_col, cap, seed=seed, salt=salt)
