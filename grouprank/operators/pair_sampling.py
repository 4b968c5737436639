"""Feature importance estimated from drawn pairs (J9): the sampled counterpart of ``feature_importance``.

Each of a group's draws is one attempt: by a fair coin a pair of the same entity (an entity, then two of its items; no
pair if it has only one) or of different entities (two entities, then an item of each). A draw's numbers are taken from
md5 of seed, group and draw, so it is the same on every run and in any engine. Entities are numbered within their group
and items within their entity, and a draw is looked up by those numbers: joins on unique keys, however large a group or
an entity is. Besides the estimate, its standard error tells how far it may be from the expectation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grouprank.operators.basic import materialize
from grouprank.operators.sampling import numbered


def draw_number(seed, salt: str, part: int, *cols: str) -> Column:
    """One of the four 32-bit numbers of md5 of 'seed:salt:columns...'."""
    text = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(salt), *[F.col(c).cast("string") for c in cols]))
    return F.conv(F.substring(text, 8 * part + 1, 8), 16, 10).cast("long")


def below(number: Column, most: Column) -> Column:
    """A 32-bit number as one from 0 to most - 1."""
    return F.shiftright(number * most, 32)


def drawn_pairs(df: DataFrame, *, group: str, entity: str, item: str, draws: int, seed, min_items: int,
                min_entities: int) -> DataFrame:
    """(group, draw, same, item_1, item_2, entity_1, entity_2 with the columns of ``df`` in structs ``one`` and ``two``)."""
    sizes = materialize(df.groupBy(group, entity).agg(F.count(F.lit(1)).alias("n")))
    gates = (sizes.groupBy(group).agg(F.sum("n").alias("_n"), F.count(F.lit(1)).alias("k"))
             .filter((F.col("_n") >= min_items) & (F.col("k") >= min_entities)).select(group, "k"))
    entities = materialize(numbered(sizes, [group], [entity], "e"))
    items = materialize(numbered(df, [group, entity], [item], "i"))

    draw = gates.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1)))).select(
        group, "draw", "k", *[draw_number(seed, salt, part, group, "draw").alias(f"u{n}")
                              for n, (salt, part) in enumerate([("pair", 0), ("pair", 1), ("pair", 2), ("item", 0), ("item", 1)])])
    draw = draw.withColumn("same", F.col("u0") < (1 << 31)).withColumn("e1", below(F.col("u1"), F.col("k")))
    other = below(F.col("u2"), F.col("k") - 1)
    draw = materialize(draw.withColumn("e2", F.when(F.col("same"), F.col("e1")).otherwise(other + F.when(other >= F.col("e1"), 1).otherwise(0))))

    def of(side: int) -> DataFrame:
        return entities.select(group, F.col("e").alias(f"e{side}"), F.col(entity).alias(f"entity_{side}"), F.col("n").alias(f"n{side}"))
    both = draw.join(of(1), [group, "e1"]).join(of(2), [group, "e2"]).filter(~F.col("same") | (F.col("n1") >= 2))
    second = below(F.col("u4"), F.when(F.col("same"), F.col("n2") - 1).otherwise(F.col("n2")))
    both = both.withColumn("i1", below(F.col("u3"), F.col("n1")))
    both = both.withColumn("i2", second + F.when(F.col("same") & (second >= F.col("i1")), 1).otherwise(0))

    def look_up(rows: DataFrame, side: int, name: str) -> DataFrame:
        found = items.select(group, F.col(entity).alias(f"entity_{side}"), F.col("i").alias(f"i{side}"),
                             F.struct(*[c for c in df.columns if c not in (group, entity)]).alias(name))
        return rows.join(found, [group, f"entity_{side}", f"i{side}"])
    return look_up(look_up(both, 1, "one"), 2, "two").select(group, "draw", "same", "entity_1", "entity_2", "one", "two")


def sampled_importance(df: DataFrame, *, group: str = "genre", entity: str = "artist_id_primary", item: str = "id",
                       features: list[str], draws: int = 30_000, seed=42, min_items: int = 50, min_entities: int = 5) -> DataFrame:
    """Columns: group, feature, importance_raw, importance_abs, importance_norm, std_error, n_same, n_different.

    ``importance_raw`` is the mean absolute difference of the drawn pairs of different entities less that of the same
    entity; ``std_error`` is the root of both means' variances. ``df`` is a written table of complete rows of the groups
    to score, with ids that are unique within an entity of a group. Groups below the gates, or without a drawn pair of
    either kind, give no rows (as in the exact form).
    """
    pairs = materialize(drawn_pairs(df.select(group, entity, item, *features), group=group, entity=entity, item=item, draws=draws, seed=seed,
                                    min_items=min_items, min_entities=min_entities))
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.abs(F.col(f"one.{f}") - F.col(f"two.{f}")).cast("double").alias("d")) for f in features])
    each = pairs.select(group, "same", F.explode(cells).alias("c")).select(group, "c.feature", "same", "c.d")

    def of(same: bool) -> list[Column]:
        mine = F.when(F.col("same") == F.lit(same), F.col("d"))
        name = "same" if same else "different"
        return [F.avg(mine).alias(f"m_{name}"), F.var_samp(mine).alias(f"v_{name}"), F.count(mine).alias(f"n_{name}")]
    stats = each.groupBy(group, "feature").agg(*of(True), *of(False)).filter("n_same > 0 and n_different > 0")
    raw = stats.withColumn("importance_raw", F.col("m_different") - F.col("m_same")).withColumn(
        "std_error", F.sqrt(F.col("v_same") / F.col("n_same") + F.col("v_different") / F.col("n_different")))
    total = raw.groupBy(group).agg(F.sum(F.abs("importance_raw")).alias("_s"))
    scale = F.when(F.col("_s") == 0, 1.0).otherwise(F.col("_s"))
    return raw.join(total, group).select(group, "feature", "importance_raw", F.abs("importance_raw").alias("importance_abs"),
                                         (F.col("importance_raw") / scale).alias("importance_norm"), "std_error", "n_same", "n_different")
