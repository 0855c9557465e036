"""Batches under caps of bytes and rows, filled in order, and the cut of a response that would be too large.

Greedy batches: a batch takes the next rows of its group until one would break either cap; a row larger than the cap is alone. Where a batch begins depends on
all rows before it, so groups are cut into stretches of consecutive rows. As no batch has more than most_rows rows, the first batch that begins in a stretch begins in one
of its first most_rows rows. Each stretch says for each of these entries which entry of the next stretch follows and how many batches lie between; these
maps are composed over blocks of stretches, and over blocks of blocks, until one is left. Going back down gives every stretch its entry, and its rows their batches.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.operators.ordering import running, written

MAPS = "group string, part long, entry int, exit int, batches long"


def following(sizes: np.ndarray, most_bytes: int, most_rows: int) -> np.ndarray:
    """For each row as the first of a batch the first row that isn't in it; the last batch may be cut short by the end of the rows."""
    ends = np.cumsum(sizes)
    upto = np.searchsorted(ends, ends - sizes + most_bytes, "right")
    at = np.arange(len(sizes))
    return np.minimum(np.maximum(upto, at + 1), at + most_rows)


def stretch_map(stretch: int, most_bytes: int, most_rows: int) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    """entry -> exit of a stretch, whose rows are followed by the first ones of the next stretch. A group's first stretch has one entry."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        own = int((rows["idx"].to_numpy() // stretch == key[1]).sum())
        step = following(rows["size"].to_numpy(), most_bytes, most_rows)[:own]
        jump, count = step.copy(), np.ones(own, np.int64)
        while (inside := jump < own).any():  # doubles the batches passed in each round
            count[inside] += count[jump[inside]]
            jump[inside] = jump[jump[inside]]
        entry = np.arange(min(own, most_rows if key[1] else 1))
        return pd.DataFrame({"group": key[0], "part": key[1], "entry": entry.astype(np.int32), "exit": (jump[entry] - own).astype(np.int32), "batches": count[entry]})

    return run


def composed(rows: pd.DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """part -> (exits, batches) by entry, parts in order."""
    ordered = rows.sort_values(["part", "entry"])
    return {int(part): (one["exit"].to_numpy(), one["batches"].to_numpy()) for part, one in ordered.groupby("part", sort=True)}


def block_map(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The map of a block of parts: those of its parts one after the other. An exit beyond a part's rows is the end of the group."""
    parts = list(composed(rows).values())
    at, batches = parts[0][0].copy(), parts[0][1].copy()
    for exits, counts in parts[1:]:
        live = at < len(exits)
        batches[live] += counts[at[live]]
        at[live] = exits[at[live]]
    return pd.DataFrame({"group": key[0], "part": key[1], "entry": np.arange(len(at), dtype=np.int32), "exit": at.astype(np.int32), "batches": batches})


def entries(maps: DataFrame, block: int) -> DataFrame:
    """(group, part, entry, before): where the first batch that begins in a part begins, and how many begin before."""
    if (maps.agg(F.max("part")).first()[0] or 0) == 0:
        return maps.where("entry = 0").select("group", "part", F.lit(0).cast("int").alias("entry"), F.lit(0).cast("long").alias("before"))
    inner = maps.withColumn("block", F.expr(f"part div {block}"))
    above = entries(written(inner.groupBy("group", "block").applyInPandas(block_map, MAPS), "batch-maps"), block)

    def down(key: tuple, rows: pd.DataFrame, begins: pd.DataFrame) -> pd.DataFrame:
        at, before, found = int(begins["entry"].iloc[0]), int(begins["before"].iloc[0]), []
        for part, (exits, batches) in composed(rows).items():
            found.append((key[0], part, at, before))
            if at < len(exits):
                at, before = int(exits[at]), before + int(batches[at])
        return pd.DataFrame(found, columns=["group", "part", "entry", "before"])

    here = inner.groupBy("group", "block").cogroup(above.withColumnRenamed("part", "block").groupBy("group", "block"))
    return written(here.applyInPandas(down, "group string, part long, entry int, before long"), "batch-entries")


def greedy(data: DataFrame, by: str, order: list[str], size: str, most_bytes: int = 6_000_000, most_rows: int = 500, stretch: int = 65_536, block: int = 256) -> DataFrame:
    """data with `batch`, from 0 in each group. order must tell a group's rows apart; null sizes count as 0, a null group is a group, an empty table gives no rows.

    Groups may be of any size: no task holds more than a stretch with its overlap, or the maps of a block of stretches.
    """
    if stretch < most_rows:
        raise ValueError("a stretch must hold a batch")
    group = F.coalesce(F.concat(F.lit("="), F.col(by).cast("string")), F.lit(""))
    ranked = written(running(data, by, [F.col(c) for c in order], {"_bytes": size}, "_idx").drop("_bytes").withColumn("_group", group), "batch-rows")
    light = ranked.select(F.col("_group").alias("group"), F.col("_idx").alias("idx"), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size")).withColumn("part", F.expr(f"idx div {stretch}"))
    overlap = light.where(f"part > 0 and idx % {stretch} < {most_rows}").withColumn("part", F.col("part") - 1)
    parts = light.unionByName(overlap).groupBy("group", "part")
    maps = written(parts.applyInPandas(stretch_map(stretch, most_bytes, most_rows), MAPS), "batch-maps")

    def number(key: tuple, rows: pd.DataFrame, begins: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx")
        own = int((rows["idx"].to_numpy() // stretch == key[1]).sum())
        step = following(rows["size"].to_numpy(), most_bytes, most_rows)
        starts, at = np.zeros(own, np.int64), int(begins["entry"].iloc[0])
        while at < own:
            starts[at] = 1
            at = int(step[at])
        batch = int(begins["before"].iloc[0]) - 1 + np.cumsum(starts)
        return pd.DataFrame({"group": key[0], "idx": rows["idx"].to_numpy()[:own], "batch": batch})

    numbered = parts.cogroup(entries(maps, block).groupBy("group", "part")).applyInPandas(number, "group string, idx long, batch long")
    return ranked.join(numbered.select(F.col("group").alias("_group"), F.col("idx").alias("_idx"), "batch"), ["_group", "_idx"]).select(*data.columns, "batch")


def response_cut(records: DataFrame, by: str, order: list[str], size: str, result: str = "result", most_bytes: int = 6_000_000, per_group: int = 500) -> DataFrame:
    """records of responses (by) with what may stay: those that are 'Ok' stay while they and the 'Ok' ones before them have at most most_bytes bytes; later ones are 'Dropped' from the
    response and leave again in groups of per_group rows (`regroup`, from 0; null for what stays). Others keep their result and count for nothing."""
    fine = F.coalesce(F.col(result) == "Ok", F.lit(False))
    counted = records.withColumn("_size", F.when(fine, F.col(size)).otherwise(0))
    summed = running(counted, by, [F.col(c) for c in order], {"_before": "_size"}, "_idx")
    over = fine & (F.col("_before") + F.coalesce("_size", F.lit(0)) > most_bytes)
    marked = summed.withColumn("_over", over.cast("int")).drop("_idx", "_before", "_size")
    again = running(marked, by, [F.col(c) for c in order], {"_gone": "_over"}, "_idx")
    left = F.col("_over") == 1
    return again.withColumn("regroup", F.when(left, F.expr(f"_gone div {per_group}"))).withColumn(result, F.when(left, "Dropped").otherwise(F.col(result))).select(*records.columns, "regroup")


def retried(records: DataFrame, attempts: DataFrame, key: str, most_attempts: int = 20) -> DataFrame:
    """records with `attempts` made so far and `state`: put once an attempt has no error_code, retry after fewer than most_attempts with one, else failed.

    attempts: (key, attempt, error_code); an empty code is none. Records without an attempt are new."""
    tried = attempts.groupBy(key).agg(F.count("*").alias("attempts"), F.bool_or(F.coalesce(F.col("error_code"), F.lit("")) == "").alias("_put"))
    state = F.when(F.col("attempts").isNull(), "new").when(F.col("_put"), "put").when(F.col("attempts") < most_attempts, "retry").otherwise("failed")
    return records.join(tried, key, "left").withColumn("state", state).withColumn("attempts", F.coalesce("attempts", F.lit(0))).drop("_put")
