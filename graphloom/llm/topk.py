"""Exact top-k inner products by dual-tree search over cover trees of queries and data.

1. Upper levels: a farthest-first order of at most `most_pivots` sampled vectors gives nested nets. Vectors are dealt to the
   cells of the finer net, whose cells belong to those of the coarser one; radii of cells are measured over all their rows. The
   sample only shapes the cells, whatever it holds results are the same.
2. Seeds: the queries of each cell are searched in the cells with the largest products of centres. Their k-th scores so far
   are lower bounds; pairs of cells whose upper bound is below the worst of them are dropped before anything of theirs is shuffled.
3. Each (coarse cell of queries, fine cell of data) with pairs left is a task. Both sides get cover trees: the children of a node of radius r are a net of its
   points whose centres lie more than r / 2 apart and whose members lie within r / 2. Query nodes go down with the candidate
   nodes that may still improve them; rows of the surviving leaves are scored in batches, best bound first.

Bounds: for centres q, c, covering radii r, s and largest norms A, B no product exceeds q.c + r|c| + s|q| + rs nor
(A^2 + B^2 - max(0, |q - c| - r - s)^2) / 2. A node pair is dropped if that is below the worst k-th score of the query group.
A node most of whose children would be single points (vectors without clusters in many dimensions) stays a leaf: nothing can be pruned there.

Blocks have a fixed largest size, so the work is split ever finer as tables grow; nothing is broadcast. Of equal vectors
only the k + 1 smallest ids are candidates, as no other can be among a query's best, so a vector repeated very often is a few rows.

Results: components become floor(scale * x) as integers, scores are exact integers, ties go to the smaller id. Null
vectors and ids, and vectors with null, NaN or infinite components take no part, nor do empty ones, nor those
whose integers' squares sum to 2**63 or more (their scores need not fit into 64 bits). Of rows with one id the smallest vector counts.
Vectors of another length than the query's are no candidates of it. Fewer candidates than k: all are returned. An empty table
gives no rows. Only the two named columns and those of the condition are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import materialize, shuffle_partitions

#: Nodes up to LEAF points aren't divided; a node is a leaf too if NET centres have fewer than FEW points each.
LEAF, NET, FEW = 16, 32, 3
#: Rows of a query group and of a batch of candidates in one product.
GROUP, BATCH = 512, 2048
LOWEST = np.iinfo(np.int64).min


@dataclass
class Tree:
    """Nodes in breadth-first order: children and rows of a node are contiguous. rows permutes the points."""

    rows: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    norm: np.ndarray
    top: np.ndarray
    first: np.ndarray
    last: np.ndarray
    begin: np.ndarray
    end: np.ndarray

    def children(self, nodes: np.ndarray) -> np.ndarray:
        count = self.last[nodes] - self.first[nodes]
        return np.repeat(self.first[nodes] - np.cumsum(count) + count, count) + np.arange(count.sum())


def net(x: np.ndarray, rows: np.ndarray, distance: np.ndarray, centre: int, radius: float) -> list[tuple[int, np.ndarray]] | None:
    """(centre, members) of a greedy net: members within radius / 2, centres farther apart. None if the points are too scattered for one."""
    parts, left, far = [], np.arange(len(rows)), distance
    while len(left):
        near = far <= radius / 2
        parts.append((centre, rows[left[near]]))
        left = left[~near]
        if len(parts) % NET == 0 and len(left) and len(rows) - len(left) < FEW * len(parts):
            return None
        if len(left):
            centre = int(rows[left[0]])
            far = np.sqrt(((x[rows[left]] - x[centre]) ** 2).sum(1))
    return parts


def cover_tree(x: np.ndarray) -> Tree:
    norms = np.sqrt((x * x).sum(1))
    todo, nodes, at = [(0, np.arange(len(x)))], [], 0
    order, spans = np.arange(len(x)), [(0, len(x))]
    while at < len(todo):
        centre, rows = todo[at]
        distance = np.sqrt(((x[rows] - x[centre]) ** 2).sum(1))
        radius = float(distance.max())
        parts = net(x, rows, distance, centre, radius) if len(rows) > LEAF and radius > 0 else None
        first, begin = len(todo), spans[at][0]
        for child, members in parts or ():
            order[begin : begin + len(members)] = members
            spans.append((begin, begin + len(members)))
            todo.append((child, members))
            begin += len(members)
        nodes.append((centre, radius, float(norms[rows].max()), first, len(todo)))
        todo[at] = (centre, rows[:0])
        if not parts:
            order[spans[at][0] : spans[at][1]] = rows
        at += 1
    centre, radius, top, first, last = (np.array(c) for c in zip(*nodes, strict=True))
    begin, end = np.array(spans).T
    return Tree(order, x[centre], radius, norms[centre], top, first, last, begin, end)


def bound(q: np.ndarray, r: float, a: float, top: float, c: np.ndarray, s: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Upper bounds of products between the ball (q, r) and balls (c, s); a, b: norms of centres; top, most: largest norms."""
    product = c @ q
    gap = np.maximum(0, np.sqrt(np.maximum(0, a * a + b * b - 2 * product)) - r - s)
    return np.minimum(product + r * b + s * a + r * s, (top * top + most * most - gap * gap) / 2) + 1e-9 * top * most + 1e-6


class Search:
    """The k best of candidates c for each query; ids ascending. worst: scores that k other candidates are known to reach, LOWEST if none."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, c: np.ndarray, k: int, worst: np.ndarray | None = None):
        order = np.argsort(ids)
        self.q_ids, self.ids, self.k, self.scored = q_ids, ids[order], k, 0
        self.worst = np.full(len(q), LOWEST) if worst is None else worst.copy()
        self.qf, self.cf = q.astype(np.float64), c[order].astype(np.float64)
        self.queries, self.data = cover_tree(self.qf), cover_tree(self.cf)
        exact = self.queries.top[0] * self.data.top[0] >= 2**52  # beyond what doubles hold: 64-bit integers, which scores fit
        self.left, self.right = (q, c[order]) if exact else (self.qf, self.cf)
        self.found: list[np.ndarray] = [np.empty((0, 3), np.int64)]

    def limit(self, rows: np.ndarray) -> float:
        low = self.worst[rows].min()
        return -math.inf if low == LOWEST else float(low)

    def best(self, rows: np.ndarray, held: np.ndarray, at: np.ndarray) -> np.ndarray:
        """held (row of rows, score, candidate) with the candidates at `at`, cut to the k best of each row; raises worst."""
        scores = (self.left[rows] @ self.right[at].T).astype(np.int64)
        self.scored += scores.size
        own = self.ids[at] == self.q_ids[rows][:, None]
        good = (scores >= self.worst[rows][:, None]) & ~own
        if scores.shape[1] > self.k and np.count_nonzero(good) > 4 * self.k * len(rows):
            scores[own] = LOWEST
            good &= scores >= np.partition(scores, scores.shape[1] - self.k, axis=1)[:, -self.k][:, None]
        row, column = np.nonzero(good)
        held = np.concatenate([held, np.stack([row, scores[row, column], at[column]], 1)])
        held = held[np.lexsort((held[:, 2], ~held[:, 1], held[:, 0]))]
        count = np.bincount(held[:, 0], minlength=len(rows))
        starts = np.cumsum(count) - count
        held = held[np.arange(len(held)) - starts[held[:, 0]] < self.k]
        full = count >= self.k
        count = np.minimum(count, self.k)
        last = (np.cumsum(count) - 1)[full]
        self.worst[rows[full]] = np.maximum(self.worst[rows[full]], held[last, 1])
        return held

    def bounds(self, node: int, nodes: np.ndarray) -> np.ndarray:
        a, b = self.queries, self.data
        return bound(a.centre[node], a.radius[node], a.norm[node], a.top[node], b.centre[nodes], b.radius[nodes], b.norm[nodes], b.top[nodes])

    def down(self, node: int, nodes: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Candidate nodes that may improve the query node, divided until none with children is wider than least."""
        rows = self.queries.rows[self.queries.begin[node] : self.queries.end[node]]
        done, open_ = [], nodes
        while len(open_):
            open_ = open_[self.bounds(node, open_) >= self.limit(rows)]
            wide = (self.data.last[open_] > self.data.first[open_]) & (self.data.radius[open_] > least)
            done.append(open_[~wide])
            open_ = self.data.children(open_[wide])
        nodes = np.concatenate(done) if done else nodes
        return nodes, self.bounds(node, nodes)

    def score_leaf(self, node: int, nodes: np.ndarray, upper: np.ndarray, seed: bool = False) -> None:
        """Rows of candidate leaves, best bound first, in batches; seed: only as many as give k-th scores."""
        nodes = nodes[np.argsort(-upper, kind="stable")]
        upper = np.sort(upper)[::-1]
        every = self.queries.rows[self.queries.begin[node] : self.queries.end[node]]
        size = self.data.end[nodes] - self.data.begin[nodes]
        parts = np.repeat(self.data.begin[nodes] - np.cumsum(size) + size, size) + np.arange(size.sum())
        at, upper = self.data.rows[parts], np.repeat(upper, size)
        for k in range(0, len(every), GROUP):
            rows, held = every[k : k + GROUP], np.empty((0, 3), np.int64)
            step = 4 * self.k + 4 if len(self.data.rows) > BATCH else BATCH  # the first batch sets the scores to beat
            begin = 0
            while begin < len(at) and upper[begin] >= self.limit(rows):
                held = self.best(rows, held, at[begin : begin + step])
                begin, step = begin + step, min(BATCH, 4 * step)
                if seed and begin >= 2 * self.k + 2:
                    break
            if not seed and len(held):
                self.found.append(np.stack([self.q_ids[rows[held[:, 0]]], self.ids[held[:, 2]], held[:, 1]], 1))

    def seed(self, node: int) -> None:
        """k-th scores of a query leaf's rows from the leaves below the few candidate nodes with the best products, by greedy descent."""
        nodes = np.zeros(1, np.int64)
        while (self.data.last[nodes] > self.data.first[nodes]).any():
            inner = self.data.last[nodes] > self.data.first[nodes]
            nodes = np.concatenate([nodes[~inner], self.data.children(nodes[inner])])
            product = self.data.centre[nodes] @ self.queries.centre[node]
            order = np.argsort(-product)
            size = np.cumsum((self.data.end[nodes] - self.data.begin[nodes])[order])
            nodes = nodes[order[: max(4, int(np.searchsorted(size, 2 * self.k + 2)) + 1)]]
        self.score_leaf(node, nodes, self.data.centre[nodes] @ self.queries.centre[node] + np.inf, seed=True)

    def run(self) -> np.ndarray:
        """Rows (query id, id, score)."""
        a, b = self.queries, self.data
        leaves = np.flatnonzero(a.first == a.last)
        if len(b.radius) > 1:
            for node in leaves.tolist():
                self.seed(node)
        stack = [(0, np.zeros(1, np.int64))]
        while stack:
            node, nodes = stack.pop()
            leaf = a.first[node] == a.last[node]
            nodes, upper = self.down(node, nodes, -1.0 if leaf else a.radius[node])
            if leaf:
                self.score_leaf(node, nodes, upper)
            elif len(nodes):
                stack += [(child, nodes) for child in range(a.first[node], a.last[node])]
        return np.concatenate(self.found)


def farthest_first(x: np.ndarray, most: int) -> np.ndarray:
    """Indexes of up to `most` rows of x, each farthest from those before; repeated rows count once."""
    if not len(x):
        return np.empty(0, np.int64)
    chosen, distance = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < most and distance.max() > 0:
        chosen.append(int(distance.argmax()))
        distance = np.minimum(distance, ((x - x[chosen[-1]]) ** 2).sum(1))
    return np.array(chosen)


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as long; null if the vector takes no part."""
    numbers = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    square = F.aggregate(vector, F.lit(0.0), lambda s, x: s + F.pow(F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"), F.lit(2.0)))
    fine = F.size(vector) > 0
    fine &= F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(2.0**32 / scale)))
    return F.when(fine, F.when(square < F.lit(2.0**63 * (1 - 1e-9)), F.transform(numbers, lambda x: x.cast("long"))))


def matrix(column: pa.ChunkedArray | pa.Array, count: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return np.array(flat, np.int64).reshape(count, -1)


PLACED = "vec_id long, asks boolean, v array<long>, dims int, fine int, coarse int, to_fine double, norm double"
FOUND = "query_id long, vec_id long, score long"


def place(batches: Iterator[pa.RecordBatch], nets: dict[int, np.ndarray], coarse: int) -> Iterator[pa.RecordBatch]:
    """Rows with their cell in the fine net and the one of its first `coarse` centres that it belongs to; lengths without centres are one cell around zero."""
    names = [x.split()[0] for x in PLACED.split(", ")]
    for batch in batches:
        dims = batch.column("dims").to_numpy()
        for size in np.unique(dims).tolist():
            part = batch.filter(pa.array(dims == size))
            x = matrix(part.column("v"), part.num_rows).astype(np.float64)
            centres = nets.get(size, np.zeros((1, size)))
            square = (x * x).sum(1)
            fine = ((centres * centres).sum(1) - 2 * x @ centres.T).argmin(1)
            parent = ((centres * centres).sum(1)[:coarse] - 2 * centres @ centres[:coarse].T).argmin(1)
            columns = [part.column(c) for c in ("vec_id", "asks", "v", "dims")]
            far = np.sqrt(((x - centres[fine]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fine, pa.int32()), pa.array(parent[fine], pa.int32()), pa.array(far), pa.array(np.sqrt(square))], names=names)


def bounded(batches: Iterator[pa.RecordBatch], nets: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Pairs of cells with the product of their centres and the upper bound of their rows' products."""
    for batch in batches:
        rows = batch.to_pydict()
        product, upper = [], []
        for size, of, fine, r, top, s, most in zip(*(rows[c] for c in ("dims", "q_fine", "fine", "q_radius", "q_top", "c_radius", "c_top")), strict=True):
            centres = nets.get(size, np.zeros((1, size)))
            q, c = centres[of], centres[fine : fine + 1]
            product.append(float(c[0] @ q))
            upper.append(float(bound(q, r, float(np.sqrt(q @ q)), top, c, np.array([s]), np.sqrt((c * c).sum(1)), np.array([most]))[0]))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(product, pa.float64()), pa.array(upper, pa.float64())], names=[*batch.schema.names, "product", "upper"])


def block(rows: DataFrame, cell: str, part: str, most: int) -> DataFrame:
    """rows with `part`: cells of more than `most` rows are cut by hashed id."""
    counts = rows.groupBy("dims", cell).agg(F.ceil(F.count("*") / F.lit(float(most))).alias("_parts"))
    return rows.join(counts, ["dims", cell]).withColumn(part, F.pmod(F.xxhash64("vec_id"), F.col("_parts")).cast("int")).drop("_parts")


def top_k(vectors: DataFrame, queries: Column, k: int = 20, scale: int = 64, most_block: int = 32_768, most_pivots: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows of vectors that meet the condition queries (over the key, named vec_id) against all rows."""
    spark = vectors.sparkSession
    clean = vectors.select(F.col(key).cast("long").alias("vec_id"), integers(F.col(vector), scale).alias("v")).where("vec_id is not null and v is not null")
    one = clean.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("asks", F.coalesce(queries, F.lit(False))).withColumn("dims", F.size("v"))
    count, asking = clean.agg(F.count("*"), F.count_if(F.coalesce(queries, F.lit(False)))).first()
    nets, coarse = cells(clean, count, asking, most_block, most_pivots)
    rows, _ = materialize(one.mapInArrow(lambda b: place(b, nets, coarse), PLACED), "cells")

    copy = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    data, _ = materialize(block(rows.drop("asks", "coarse").withColumn("_copy", copy).where(F.col("_copy") <= k + 1).drop("_copy"), "fine", "c_part", most_block), "candidates")
    asks, _ = materialize(block(rows.where("asks").drop("asks").withColumnRenamed("fine", "q_fine"), "coarse", "q_part", most_block // 4), "queries")
    of, on, task = ("dims", "fine", "c_part"), ("dims", "q_fine", "coarse", "q_part"), ("dims", "coarse", "q_part", "fine", "c_part")
    c_blocks = data.groupBy(*of).agg(F.count("*").alias("n"), F.max("to_fine").alias("c_radius"), F.max("norm").alias("c_top"))
    q_blocks = asks.groupBy(*on).agg(F.max("to_fine").alias("q_radius"), F.max("norm").alias("q_top"))
    paired = q_blocks.join(c_blocks, "dims")
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in paired.schema)
    before = Window.partitionBy(*on).orderBy(F.desc("product"), "fine", "c_part").rowsBetween(Window.unboundedPreceding, -1)
    seeds = F.coalesce(F.sum("n").over(before), F.lit(0)) < 2 * k + 2
    pairs, _ = materialize(paired.mapInArrow(lambda b: bounded(b, nets), f"{kinds}, product double, upper double").withColumn("seeds", seeds), "pairs")

    def cell(table: pa.Table) -> pa.Table:
        is_query = table.column("asks").to_numpy()
        ids, x = table.column("vec_id").to_numpy(), matrix(table.column("v"), table.num_rows)
        found = np.empty((0, 3), np.int64)
        if is_query.any() and not is_query.all():
            worst = table.column("worst").combine_chunks().fill_null(LOWEST).to_numpy()[is_query]
            found = Search(ids[is_query], x[is_query], ids[~is_query], x[~is_query], k, worst).run()
        return pa.table({name: pa.array(found[:, i]) for i, name in enumerate(("query_id", "vec_id", "score"))})

    def searched(chosen: DataFrame, worst: DataFrame | None) -> DataFrame:
        left = asks.join(worst.withColumnRenamed("query_id", "vec_id"), "vec_id", "left") if worst is not None else asks.withColumn("worst", F.lit(None).cast("long"))
        a = left.join(chosen, [*on]).select(*task, "vec_id", "v", F.lit(True).alias("asks"), "worst")
        b = data.join(chosen.select(*task).distinct(), [*of]).select(*task, "vec_id", "v", F.lit(False).alias("asks"), F.lit(None).cast("long").alias("worst"))
        return a.unionByName(b).groupBy(*task).applyInArrow(cell, FOUND)

    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    keys = [*on, "fine", "c_part"]
    first, _ = materialize(searched(pairs.where("seeds").select(*keys), None).withColumn("rank", rank).where(F.col("rank") <= k), "seeds")
    worst = first.where(F.col("rank") == k).select("query_id", F.col("score").alias("worst"))
    reach = asks.select(*on, F.col("vec_id").alias("query_id")).join(worst, "query_id", "left")
    limits = reach.groupBy(*on).agg(F.when(F.count("*") == F.count("worst"), F.min("worst")).alias("limit"))
    rest = pairs.where("not seeds").join(limits, [*on]).where("limit is null or upper >= limit").select(*keys)
    best = first.drop("rank").unionByName(searched(rest, worst))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def cells(clean: DataFrame, count: int, asking: int, most_block: int, most_pivots: int) -> tuple[dict[int, np.ndarray], int]:
    """(centres of the fine net by vector length, how many of the first ones are the coarse net) from a bounded sample."""
    goal = max(2, math.isqrt(2 * shuffle_partitions(clean.sparkSession)))
    fine = min(most_pivots, max(1, -(-count // most_block), min(4 * goal, -(-count // 1024))))
    coarse = min(fine, max(1, -(-asking // (most_block // 4)), min(goal, -(-asking // 256))))
    sample = clean.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most_pivots).select("v").collect()
    by_length: dict[int, list] = {}
    for r in sample:
        by_length.setdefault(len(r["v"]), []).append(r["v"])
    nets = {}
    for size, found in by_length.items():
        x = np.array(found, np.float64)
        nets[size] = x[farthest_first(x, fine)]
    return nets, coarse
