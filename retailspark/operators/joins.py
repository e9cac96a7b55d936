"""Dimension lookups at fact grain that keep working with hot keys and big dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Two-column lookups of this many rows stay in the tens of megabytes.
BROADCAST_ROWS = 1_000_000
# Keys the sketch reports as hot; any key above 0.1 % of the rows is among them.
HOT_KEYS = 1_000
SKETCH_ITEMS = 20_000


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    spread_by: Column,
    how: str = "inner",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Join ``fact`` with the narrow lookup table ``dim``, unique on ``key``.

    ``dim`` is counted first (a metadata read for a stored table) and broadcast
    only up to ``broadcast_rows``. A larger one is joined by shuffle, with the hot
    keys of ``fact`` spread over all shuffle partitions.
    """
    if dim.count() <= broadcast_rows:
        return fact.join(F.broadcast(dim), key, how)
    return spread_join(fact, dim, key, spread_by, how)


def hot_keys(fact: DataFrame, key: str) -> list:
    """The most frequent keys, ``HOT_KEYS`` at most, from a one-pass sketch."""
    sketch = fact.filter(F.col(key).isNotNull()).agg(
        F.expr(f"approx_top_k({key}, {HOT_KEYS}, {SKETCH_ITEMS})").alias("top")
    )
    return [row[0] for row in sketch.select(F.explode("top.item")).collect()]


def spread_join(
    fact: DataFrame, dim: DataFrame, key: str, spread_by: Column, how: str = "inner"
) -> DataFrame:
    """Equi-join in which each hot key is divided into one slot per shuffle partition.

    Fact rows of a hot key go to the slot given by a hash of ``spread_by``, and the
    dimension row is repeated for each slot. Other keys have slot 0 only. Rows with
    a NULL key match nothing and are spread as well. Slots come from the data and
    the hot keys are fixed once, so both sides agree and a recomputed task places
    its rows as before.
    """
    slots = _slots(fact.sparkSession)
    hot = F.col(key).isin(hot_keys(fact, key))
    own_slot = F.pmod(F.xxhash64(spread_by), F.lit(slots)).cast("int")
    fact_slots = fact.withColumn(
        "_slot", F.when(F.col(key).isNull() | hot, own_slot).otherwise(F.lit(0))
    )
    every_slot = F.sequence(F.lit(0), F.lit(slots - 1))
    dim_slots = dim.withColumn(
        "_slot", F.explode(F.when(hot, every_slot).otherwise(F.array(F.lit(0))))
    )
    return fact_slots.join(dim_slots, [key, "_slot"], how).drop("_slot")


def _slots(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def unique_lookup(dim: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)`` of ``dim``; fails the job if a key repeats and would multiply rows."""
    message = F.concat(F.lit(f"{key} repeats in the lookup table: "), F.col(key).cast("string"))
    return (
        dim.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count("*").alias("_n"), F.min(value).alias("_value"))
        .select(
            key,
            F.when(F.col("_n") == 1, F.col("_value"))
            .otherwise(F.raise_error(message))
            .alias(value),
        )
    )
