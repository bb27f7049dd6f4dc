"""Equi-join that spreads hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .guards import broadcast_if_small

HOT_ROWS = 2_000_000


def salted_left_join(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join for a big, skewed left side and a right side that must be shuffled.

    Keys with more than `hot_rows` rows on the left get one salt per `hot_rows`;
    only for those keys is the right side replicated. Salts come from row
    position, so even identical rows spread.
    """
    heat = (
        left.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select(*keys, F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_salts"))
    )
    heat = broadcast_if_small(heat)
    salts = F.coalesce("_salts", F.lit(1))
    spread = (
        left.withColumn("_at", F.monotonically_increasing_id())
        .join(heat, keys, "left")
        .withColumn("_salt", F.pmod(F.col("_at"), salts).cast("int"))
        .drop("_salts", "_at")
    )
    copies = (
        right.join(heat, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("_salts")
    )
    return spread.join(copies, [*keys, "_salt"], "left").drop("_salt")
