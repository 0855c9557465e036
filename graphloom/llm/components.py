"""Connected components of a table of links: contracted inside tasks, then by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import forget, materialize

#: So many links (16 bytes each) are settled by one task; more go through rounds of shuffles.
FEW = 1 << 18


def contracted(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(v, u): every node of the links read, with the smallest node that it reaches by them. After `most` nodes a new forest begins, so memory is bounded."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root[x]) != x:
            root[x] = root[up]
            x = up
        return x

    def stars() -> pa.RecordBatch:
        found = [(v, u) for v in root if (u := find(v)) != v]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.int64()) for k in (0, 1)], names=["v", "u"])

    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            a, b = find(root.setdefault(a, a)), find(root.setdefault(b, b))
            if a != b:
                root[max(a, b)] = min(a, b)
        if len(root) > most:
            yield stars()
            root.clear()
    yield stars()


def components(links: DataFrame, left: str = "a", right: str = "b", most_rounds: int = 60, few: int = FEW) -> DataFrame:
    """(node, component): every node of a link with the smallest node that it reaches. Nodes are longs.

    The links are written; who makes them in Python should pass them through contracted() there. Up to `few` of them are settled by one task. More
    are contracted in tasks, then kept as (v, u) with u < v: each round hangs all larger neighbours of a node below the smallest one around it (large
    star), then does the same for the smaller ones (small star), until nothing changes. Minima are aggregated before the shuffle; a hub
    has many rows on the left side of the join that follows, which adaptive execution splits. Each round's links are written to
    the shared folder. Links to oneself and nulls are ignored.
    """
    spark = links.sparkSession
    pairs = links.select(F.greatest(left, right).cast("long").alias("v"), F.least(left, right).cast("long").alias("u")).where(f"`{left}` is not null and `{right}` is not null").where("u != v")
    now, path = materialize(pairs, "links")
    seen, small = None, now.count() <= few
    source = now.coalesce(1) if small else now
    stars, new_path = materialize(source.mapInArrow(lambda b: contracted(b, 2 * FEW), "v long, u long"), "links")
    forget(spark, path)
    now, path = stars, new_path
    if small:
        return with_roots(now)
    for _ in range(most_rounds):
        least = now.groupBy(F.col("v").alias("u")).agg(F.min("u").alias("m"))  # the smallest node around one that isn't the smallest itself
        large = now.join(least, "u", "left").select("v", F.coalesce("m", "u").alias("u")).distinct()
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v")
        stars = small.select("v", F.col("m").alias("u")).unionByName(small.where("u != m").select(F.col("u").alias("v"), F.col("m").alias("u"))).distinct()
        after, new_path = materialize(stars, "links")
        mark = after.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        forget(spark, path)
        now, path = after, new_path
        if mark == seen:
            return with_roots(now)
        seen = mark
    raise RuntimeError("components did not settle")


def with_roots(stars: DataFrame) -> DataFrame:
    roots = stars.select(F.col("u").alias("node"), F.col("u").alias("component"))
    return stars.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots).distinct()
