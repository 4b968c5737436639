"""The workflow run again on changed input (C15, S5): only what changed is computed and written anew.

Every stage keeps, beside its table, the fingerprint of the rows that each group was made from: their number, and the sum
and the exclusive or of their hashes, which no order of rows or tasks changes. In the next run a group whose fingerprint
is the same is left as it lies; the others are recomputed and replace their partition (dynamic partition overwrite).
Readers see the groups of the latest run only, so a group that is gone needs no deletion.

A stage's rows are written before its fingerprints: a run that dies between the two repeats that work, and loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grouprank.operators.basic import complete_rows, materialize
from grouprank.params import Params
from grouprank.plans.compare import compare_runs, genre_predictors
from grouprank.plans.curate import curate_items, enrich_with_text
from grouprank.plans.evaluate import chosen_groups, evaluate_audio, evaluate_audio_text, text_candidates
from grouprank.sources import io

PRINT = ["n_rows", "hash_sum", "hash_xor"]


def fingerprints(df: DataFrame, group: str = "genre") -> DataFrame:
    """(group, n_rows, hash_sum, hash_xor) of the rows of each group, whatever their order; NULLs count by their column."""
    cols = [c for c in sorted(df.columns) if c != group]
    row = F.xxhash64(*[F.col(c) for c in cols], *[F.col(c).isNull() for c in cols])
    return df.select(group, row.alias("_h")).groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("_h").cast("decimal(20,0)")).alias("hash_sum"), F.bit_xor("_h").alias("hash_xor"))


def changed_groups(now: DataFrame, before: DataFrame | None, group: str = "genre") -> DataFrame:
    """Groups of ``now`` that ``before`` has not, or with another fingerprint."""
    if before is None:
        return now.select(group)
    return now.join(before, [group, *PRINT], "left_anti").select(group)


class Stages:
    """Tables of a run under ``base``, with the fingerprints of the run before."""

    def __init__(self, spark: SparkSession, base: str, group: str):
        self.spark, self.base, self.group = spark, base.rstrip("/"), group
        self.tables: dict[str, DataFrame] = {}
        self.prints: dict[str, DataFrame] = {}

    def _known(self, name: str) -> DataFrame | None:
        path = f"{self.base}/fingerprints/{name}"
        where = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if not where.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(where):
            return None
        return self.spark.read.parquet(path)

    def update(self, name: str, now: DataFrame, rows: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Make a stage's groups that are new or changed by ``rows(groups)``; the stage's table of the groups of ``now``.

        ``now``: the fingerprints that the groups are made from.
        """
        now = materialize(now)
        changed = materialize(changed_groups(now, self._known(name), self.group))
        made = rows(changed)
        path = f"{self.base}/{name}"
        (made.hint("rebalance", self.group).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(self.group).parquet(path))
        prints = f"{self.base}/fingerprints/{name}"
        now.write.mode("overwrite").parquet(prints)
        # the written schema keeps the group a string, whatever the partition type inference says
        table = self.spark.read.schema(made.schema).parquet(path).select(*made.columns)
        self.prints[name] = self.spark.read.schema(now.schema).parquet(prints).filter(F.col(self.group).isNotNull())
        present = self.prints[name].select(self.group)
        self.tables[name] = table.join(present, self.group, "left_semi").select(*made.columns)
        return self.tables[name]

    def own(self, name: str, df: DataFrame) -> DataFrame:
        """A stage whose groups are made from their own rows: only changed ones are written."""
        df = materialize(df)
        return self.update(name, fingerprints(df, self.group), lambda groups: df.join(groups, self.group, "left_semi").select(*df.columns))


def run_incremental(spark: SparkSession, tracks: DataFrame, artists: DataFrame, base_path: str, text_records: DataFrame,
                    p: Params | None = None) -> dict[str, DataFrame]:
    """The tables of ``run_pipeline`` (curated, enriched, predictors, audio, audio_text, delta), kept under ``base_path`` between runs.

    Importance and the numeric evaluation of a group depend on its curated rows alone. In the blended evaluation the
    document frequencies are those of all chosen groups, so it is made anew for all of them if one has changed.
    A group's ``run_ts`` is that of the run that made it. With other parameters use another folder.
    """
    p = p or Params()
    g = p.group
    with io.scratch_scope(spark):
        stages = Stages(spark, base_path, g)
        curated = stages.own("curated", curate_items(tracks, artists))
        enriched = stages.own("enriched", enrich_with_text(curated, text_records))
        prints = stages.prints["curated"]

        whole = complete_rows(curated, [p.item, g, p.entity, *p.features])
        chosen = materialize(prints.join(chosen_groups(whole, p, p.min_rows, None), g, "left_semi"))
        stages.update("predictors", chosen, lambda groups: genre_predictors(curated, p, groups=groups))
        audio = stages.update("audio", chosen, lambda groups: evaluate_audio(curated, p, groups=groups))

        text_groups = chosen_groups(text_candidates(curated, enriched, p), p, p.text_min_rows, None)
        both = prints.union(stages.prints["enriched"]).join(text_groups, g, "left_semi")
        # few rows: every group has the sums of all
        all_of = both.agg(F.sum("n_rows").alias("n_rows"), F.sum("hash_sum").alias("hash_sum"), F.bit_xor("hash_xor").alias("hash_xor"))
        each = both.select(g).distinct().withColumn("_one", F.lit(1)).join(all_of.withColumn("_one", F.lit(1)), "_one").drop("_one")
        audio_text = stages.update("audio_text", each, lambda groups: evaluate_audio_text(curated, enriched, p, groups=groups))
        stages.own("delta", compare_runs(audio, audio_text))
    return stages.tables
