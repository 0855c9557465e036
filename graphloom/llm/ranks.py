"""Distributed ranks and running sums, and joins with totals of keys of which a few may hold most rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import materialize, shuffle_partitions


def placed(df: DataFrame, *keys: Column | str, tag: str = "placed") -> DataFrame:
    """df, written in the order of keys, with `part` (its range of the order) and `at` (its place there). A key that many rows share is divided if further keys tell them apart."""
    spot = F.monotonically_increasing_id()
    ordered = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return materialize(ordered.select("*", F.shiftright(spot, 33).cast("int").alias("part"), spot.bitwiseAND(F.lit((1 << 33) - 1)).alias("at")), tag)[0]


def rank_in(rows: DataFrame, group: str) -> DataFrame:
    """rows, as placed() gives them with group as first key, with `idx`: the row's rank within its group, from 0. Only counts of (group, part) are summed."""
    counts = rows.groupBy(group, "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(group, "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    return rows.join(shifts, [group, "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def sums_before(rows: DataFrame, value: str, name: str) -> DataFrame:
    """rows, as placed() gives them, with `name`: the sum of value over all rows before. One row a part meets in one task, all others stay in theirs."""
    totals = rows.groupBy("part").agg(F.sum(value).alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0))).join(shifts, "part").withColumn(name, F.col(name) + F.col("shift")).drop("part", "at", "shift")


def attach(rows: DataFrame, totals: DataFrame, key: str, total_rows: int) -> DataFrame:
    """rows left joined with totals (key, n, others) by key, where n is how many rows have the key; nulls match.

    Keys that more than an even share of a shuffle partition have are fewer than there are partitions, so they are broadcast and their
    rows stay where they are; the rows of the others are shuffled. rows and totals are read several times: pass written tables.
    """
    share = max(1, total_rows // shuffle_partitions(rows.sparkSession))
    hot = totals.where(F.col("n") > share).withColumnRenamed(key, "_key")
    rest = totals.where(F.col("n") <= share).withColumnRenamed(key, "_key")
    match = F.col(key).eqNullSafe(F.col("_key"))
    near = rows.join(F.broadcast(hot), match)
    far = rows.join(F.broadcast(hot.select("_key")), match, "left_anti").join(rest, match)
    return near.unionByName(far).drop("_key", "n")
