"""Group statistics and group choosers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grouprank.operators.sampling import random_subset

GROUP_MODES = ("top_n", "top_n_plus_variety")


def group_counts(df: DataFrame, group: str = "genre", name: str = "n") -> DataFrame:
    """Rows per non-NULL group (partial + final hash aggregate)."""
    return (df.filter(F.col(group).isNotNull())
              .groupBy(group).agg(F.count(F.lit(1)).alias(name)))


def eligible_groups(df: DataFrame, group: str = "genre", min_rows: int = 500, name: str = "n") -> DataFrame:
    return group_counts(df, group, name).filter(F.col(name) >= min_rows)


def top_groups(counts: DataFrame, top: int | None, group: str = "genre", name: str = "n") -> DataFrame:
    """Largest groups first; ties by group name. Plans as TakeOrderedAndProject. ``None``: all groups."""
    ordered = counts.orderBy(F.col(name).desc(), F.col(group).asc())
    return ordered if top is None else ordered.limit(top)


def select_groups(df: DataFrame, *, group: str = "genre", mode: str = "top_n", top: int | None = 10,
                  variety: int | None = 10, min_rows: int = 500, seed=42) -> DataFrame:
    """Chosen groups (one column). The row threshold applies to both slices.

    ``top_n``: the ``top`` largest groups with at least ``min_rows`` rows.
    ``top_n_plus_variety``: plus ``variety`` further eligible groups in sample-key order.
    The result has at most ``top + variety`` rows (``None``: all eligible groups).
    """
    if mode not in GROUP_MODES:
        raise ValueError(f"unsupported group mode {mode!r}; use one of {GROUP_MODES}")
    counts = eligible_groups(df, group, min_rows)
    chosen = top_groups(counts, top, group).select(group)
    if mode == "top_n":
        return chosen
    rest = random_subset(counts.join(chosen, group, "left_anti"), group, variety, seed=seed).select(group)
    return chosen.unionByName(rest).distinct()


def select_groups_with_reason(df: DataFrame, *, group: str = "genre", top: int | None = 10,
                              variety: int | None = 10, min_rows: int = 500, seed=42) -> DataFrame:
    """SQL-style chooser: the threshold applies only to the variety slice.

    Columns: group, n_tracks, reason ('top_n' | 'variety').
    """
    counts = group_counts(df, group, "n_tracks")
    chosen = top_groups(counts, top, group, "n_tracks")
    rest = counts.join(chosen.select(group), group, "left_anti").filter(F.col("n_tracks") >= min_rows)
    variety_df = random_subset(rest, group, variety, seed=seed)
    return (chosen.withColumn("reason", F.lit("top_n"))
                  .unionByName(variety_df.withColumn("reason", F.lit("variety"))))


def keep_groups(df: DataFrame, groups: DataFrame, group: str = "genre", *, few_groups: bool = False) -> DataFrame:
    """Membership filter as a semi join against a chooser frame (no collect).

    ``few_groups`` says that the chooser's parameters bound the frame (top + variety
    rows), so it is broadcast; otherwise Spark decides by its size.
    """
    names = groups.select(group)
    return df.join(F.broadcast(names) if few_groups else names, group, "left_semi").select(*df.columns)
