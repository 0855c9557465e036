"""Ranks and running sums of groups of any size, from ranges of their order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.session import new_folder


#: Rows that one task sorts: a range of ordered().
ROWS_A_RANGE = 500_000


def written(df: DataFrame, tag: str) -> DataFrame:
    """df as a table in the shared folder: later plans start from its files, which outlive executors."""
    path = new_folder(df.sparkSession, tag)
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def placed(df: DataFrame, *keys: Column | str, tag: str = "placed", ranges: int | None = None) -> DataFrame:
    """df written in the order of keys, with `_part`, its range of the order, and `_at`, its place there. ranges: how many at most; else as many as Spark takes."""
    spot = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(*keys) if ranges is None else df.repartitionByRange(ranges, *keys)
    return written(dealt.sortWithinPartitions(*keys).select("*", F.shiftright(spot, 33).cast("int").alias("_part"), spot.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")), tag)


def ordered(df: DataFrame, *keys: str, rank: str = "_idx") -> tuple[DataFrame, DataFrame]:
    """(df with the rank of each row in the order of keys, from 0; one row with _total). There are more ranges for more rows, so a task sorts a bounded number of them, and ranks need no window over rows."""
    rows = placed(df, *keys, tag="ordered", ranges=max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // ROWS_A_RANGE)))
    counts = rows.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as there are ranges
    shifts = counts.select(F.col("_part").alias("_range"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    met = rows.join(F.broadcast(shifts), F.col("_part") == F.col("_range"))
    return met.select(*df.columns, (F.col("_before") + F.col("_at")).alias(rank)), counts.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("_total"))


def running(df: DataFrame, by: str, order: list[Column | str], sums: dict[str, str], rank: str = "idx") -> DataFrame:
    """df with the rank of each row in its group (from 0) and, for each name of sums, the sum of that column over the group's rows before it.

    Rows are dealt by ranges of (by, order), so a group that holds most rows is many tasks; totals of (group, range) are shifted by those
    before. Rows that are equal in by and order are ordered by chance: give an order that tells them apart. Nulls count as 0, a null group is a group.
    """
    rows = placed(df, by, *order)
    inside = Window.partitionBy(by, "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.select("*", (F.row_number().over(inside.rowsBetween(Window.unboundedPreceding, 0)) - 1).alias(rank), *(F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(name) for name, c in sums.items()))
    totals = rows.groupBy(by, "_part").agg(F.count("*").alias("_rows"), *(F.sum(c).alias(f"_{name}") for name, c in sums.items()))
    shifts = totals.select(F.col(by).alias("_by"), F.col("_part").alias("_range"), *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("_rows", *(f"_{name}" for name in sums))))
    met = own.join(shifts, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_part") == F.col("_range")))
    whole = met.withColumn(rank, (F.col(rank) + F.col("_rows_before")).cast("bigint"))
    for name in sums:
        whole = whole.withColumn(name, (F.col(name) + F.col(f"_{name}_before")).cast("bigint"))
    return whole.select(*df.columns, rank, *sums)
