"""Per-group scaling and vector normalisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grouprank.functions.columns import norm


def group_stats(df: DataFrame, group: str, cols: list[str]) -> DataFrame:
    """Mean and population standard deviation per group (sd 0 -> 1)."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"_mu_{c}"), F.stddev_pop(c).alias(f"_sd_{c}")]
    stats = df.groupBy(group).agg(*aggs)
    for c in cols:
        stats = stats.withColumn(f"_sd_{c}", F.when(F.col(f"_sd_{c}") == 0, F.lit(1.0))
                                 .otherwise(F.col(f"_sd_{c}")))
    return stats


def zscore(df: DataFrame, group: str, cols: list[str], *, prefix: str = "z_",
           stats: DataFrame | None = None, few_groups: bool = False) -> DataFrame:
    """Add ``prefix+col`` = (x - group mean) / group population sd.

    Statistics are a grouped aggregate joined back on the group (one row per
    group), not a window, so a large group is not gathered into one task. With
    ``few_groups`` (the groups come from a chooser, which bounds their number) the
    statistics are broadcast, so the rows are not shuffled on the group.
    """
    stats = stats if stats is not None else group_stats(df, group, cols)
    out = df.join(F.broadcast(stats) if few_groups else stats, group)
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", (F.col(c) - F.col(f"_mu_{c}")) / F.col(f"_sd_{c}"))
    return out.drop(*[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])


def l2_normalize(df: DataFrame, cols: list[str], *, prefix: str = "u_") -> DataFrame:
    """Add ``prefix+col`` = col / ||row||; a zero vector stays zero."""
    n = norm(cols)
    d = F.when(n == 0, F.lit(1.0)).otherwise(n)
    out = df.withColumn("_norm", d)
    for c in cols:
        out = out.withColumn(f"{prefix}{c}", F.col(c) / F.col("_norm"))
    return out.drop("_norm")
