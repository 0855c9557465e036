"""A Merkle manifest of a dataset: a tree for each group of rows, a tree over the groups' roots, and a proof for each row.

Superblock reduction: the nodes of a group have indices from 0, and those with one value of index div fanout^levels are a bucket.
applyInPandas collapses all levels of a bucket at once to its root; the roots, with the buckets as their indices, are reduced
the same way until every group has one node, its subroot. The subroots, in the order of their groups, are reduced likewise to the
root. Proofs are made downwards: each bucket meets its root's upper proof (one row, by cogroup), which is appended to the lower proof
of each of its nodes. So rows of the dataset are shuffled with their leaf alone, whatever the height of the tree.

Rules: while several nodes remain, each run of `fanout` consecutive ones becomes the hash of their hex texts; the last run may be
shorter and may be one node, which is hashed too. One leaf is its own subroot, one subroot the root. Groups ascend bytewise, null first.
Within a group rows ascend by key (null first), then by leaf: rows repeated with all their values are leaves of their own.
A null value is `-` in a leaf, so it differs from an empty one. An empty table gives no rows. No group, however large, is one task: its
ranks come from counts per range and its buckets are as small as any other's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from graphloom.llm.common import materialize
from graphloom.llm.ranks import placed, rank_in


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def framed(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*(framed(v) for v in values)), 256)


def collapse(nodes: list[str], fanout: int, levels: int, whole: bool) -> list[list[str]]:
    """The nodes of each level, from the given ones up to one; as many levels as asked unless the bucket is a whole tree, which ends with one node."""
    found = [nodes]
    while len(found[-1]) > 1 if whole else len(found) <= levels:
        below = found[-1]
        found.append([digest("".join(below[i : i + fanout])) for i in range(0, len(below), fanout)])
    return found


def is_whole(bucket: int, nodes: int, fanout: int, levels: int) -> bool:
    """Buckets fill one after the other, so the first one alone can be a whole tree, if it isn't full."""
    return bucket == 0 and nodes < fanout**levels


def up(nodes: DataFrame, fanout: int, levels: int) -> DataFrame:
    """(group, idx, node) of the next layer: one node for each bucket of this one."""

    def roots(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        name, bucket = key
        found = collapse(rows.sort_values("idx")["node"].tolist(), fanout, levels, is_whole(bucket, len(rows), fanout, levels))
        return pd.DataFrame({"group": [name], "idx": [bucket], "node": [found[-1][0]]})

    light = nodes.select("group", "idx", "node", F.expr(f"idx div {fanout**levels}").alias("bucket"))
    return light.groupBy("group", "bucket").applyInPandas(roots, "group string, idx long, node string")


def layers(nodes: DataFrame, fanout: int, levels: int) -> list[DataFrame]:
    """The layers from the given one to that which has one node for each group."""
    found = [nodes]
    while (found[-1].agg(F.max("idx")).first()[0] or 0) > 0:
        found.append(materialize(up(found[-1], fanout, levels), "layer")[0])
    return found


def down(nodes: DataFrame, upper: DataFrame, fanout: int, levels: int) -> DataFrame:
    """nodes with `left` and `right`, lists of the siblings' joined hex texts for each level up to the root, and what else upper has.

    upper: (group, idx, left, right, ...) of the next layer, one row for each bucket of nodes."""
    others = [f for f in upper.schema if f.name not in ("group", "idx", "left", "right")]
    schema = StructType(list(nodes.schema)).add("left", ArrayType(StringType())).add("right", ArrayType(StringType()))
    for f in others:
        schema = schema.add(f)

    def proofs(key: tuple, rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("idx").drop(columns="bucket").reset_index(drop=True)
        if len(above) != 1:
            raise ValueError(f"bucket {key} has {len(above)} roots")
        top = above.iloc[0]
        heights = collapse(rows["node"].tolist(), fanout, levels, is_whole(key[1], len(rows), fanout, levels))[:-1]
        left, right = [], []
        for i in range(len(rows)):
            before, after = [], []
            for level in heights:
                run = i - i % fanout
                before.append("".join(level[run:i]))
                after.append("".join(level[i + 1 : run + fanout]))
                i //= fanout
            left.append([*before, *top["left"]])
            right.append([*after, *top["right"]])
        return rows.assign(left=left, right=right, **{f.name: top[f.name] for f in others})

    here = nodes.withColumn("bucket", F.expr(f"idx div {fanout**levels}")).groupBy("group", "bucket")
    return here.cogroup(upper.withColumnRenamed("idx", "bucket").groupBy("group", "bucket")).applyInPandas(proofs, schema)


def manifest(leaves: DataFrame, fanout: int = 3, levels: int = 6) -> DataFrame:
    """leaves (group, key, node, others) with subroot, root and the proof (left, right: siblings before and after the path, level by level up to the root).

    group is text or null, node the leaf's hex text, others are text. Buckets have fanout^levels nodes. leaves is read once.
    """
    named = leaves.withColumn("group", F.coalesce(F.concat(F.lit("="), F.col("group")), F.lit("")))
    ranked, _ = materialize(rank_in(placed(named, "group", "key", "node", tag="leaves"), "group"), "ranked")
    trees = layers(ranked, fanout, levels)
    groups = trees[-1].select(F.lit("").alias("group"), F.col("group").alias("name"), "node")
    tops = layers(materialize(rank_in(placed(groups, "group", "name", tag="groups"), "group"), "ranked")[0], fanout, levels)
    no_proof = F.array().cast("array<string>")
    proven = tops[-1].select("group", "idx", no_proof.alias("left"), no_proof.alias("right"), F.col("node").alias("root"))
    for layer in reversed(tops[:-1]):
        proven = down(layer, proven, fanout, levels).select("group", "idx", *([F.col("name"), F.col("node").alias("subroot")] if layer is tops[0] else []), "left", "right", "root")
    if len(tops) == 1:  # one group: its subroot is the root
        proven = proven.join(groups, "group").withColumn("subroot", F.col("root")).drop("node")
    proven = proven.select(F.col("name").alias("group"), F.lit(0).cast("long").alias("idx"), "left", "right", "root", "subroot")
    for layer in reversed(trees[1:-1]):
        proven, _ = materialize(down(layer, proven, fanout, levels).drop("node"), "proofs")
    if len(trees) == 1:  # each group has one leaf
        return ranked.join(proven, ["group", "idx"]).drop("group", "idx")
    texts = ranked.withColumn("key", F.col("key").cast("string"))  # pandas has no integers beside nulls
    return down(texts, proven, fanout, levels).drop("group", "idx").withColumn("key", F.col("key").cast(ranked.schema["key"].dataType))


def folded(start: Column, left: Column, right: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    steps = F.zip_with(left, right, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    return F.aggregate(steps, start, lambda node, step: F.sha2(F.concat(step["a"], node, step["b"]), 256))


def proof_digest(left: Column, right: Column) -> Column:
    return F.sha2(F.array_join(F.zip_with(left, right, lambda a, b: F.concat(a, b)), ""), 256)


def of_documents(docs: DataFrame, altered: Callable[[Column], Column], fanout: int = 3, levels: int = 6) -> DataFrame:
    """The manifest of documents, by source, with `altered`: the leaf that the row has with its text changed so."""
    row = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    text = F.col("text")
    return manifest(docs.select(F.col("source").alias("group"), F.col("doc_id").alias("key"), leaf(*row, text).alias("node"), leaf(*row, altered(text)).alias("altered")), fanout, levels)
