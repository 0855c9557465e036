"""Remote and local ids, link history and current links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.ids import link_edge_id, link_vertex_id


def reconcile(remote: DataFrame, known: DataFrame, key: str = "id_value") -> DataFrame:
    """(key, outcome) for remote ids against known (key, is_linked): new, link (known, not linked, now seen) or unlink (linked, no longer seen). One full outer join."""
    far = remote.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_far", F.lit(True))
    near = known.where(F.col(key).isNotNull()).groupBy(key).agg(F.bool_or("is_linked").alias("_linked"))
    outcome = F.when(F.col("_linked").isNull(), "new").when(F.col("_far").isNull() & F.col("_linked"), "unlink").when(F.col("_far") & ~F.col("_linked"), "link")
    return far.join(near, key, "full").select(key, outcome.alias("outcome")).where("outcome is not null")


def reconcile_with_new(remote: DataFrame, known: DataFrame, key: str = "id_value") -> DataFrame:
    """The older reconciliation: as reconcile(), but every remote id that isn't linked is linked, new ones too, so these have two rows."""
    found = reconcile(remote, known, key)
    return found.unionByName(found.where("outcome = 'new'").withColumn("outcome", F.lit("link")))


def current(history: DataFrame, *keys: str, moment: str = "ts", unlink: str = "is_unlink", tie: str | None = None) -> DataFrame:
    """Per key the latest entry: (keys, is_linked, changed_at). tie breaks equal moments, larger last."""
    order = F.struct(moment, tie) if tie else F.struct(moment, unlink)
    return history.groupBy(*keys).agg((~F.max_by(unlink, order)).alias("is_linked"), F.max(moment).alias("changed_at"))


def id_sets(linked: DataFrame, by: str, key: str) -> DataFrame:
    """Counts of linked, unlinked and all ids per stem: sets stay tables, only their sizes are gathered."""
    return linked.groupBy(by).agg(F.count_if("is_linked").alias("linked"), F.count_if(~F.col("is_linked")).alias("unlinked"), F.count_distinct(key).alias("all_ids"))


def link_entries(outcomes: DataFrame, as_of: str, key: str = "id_value") -> DataFrame:
    """The history entries that a reconciliation adds; new ids are linked."""
    return outcomes.select(F.col(key), F.lit(as_of).cast("timestamp").alias("ts"), (F.col("outcome") == "unlink").alias("is_unlink")).distinct()


def source_graph(history: DataFrame, key: str, source: str) -> tuple[DataFrame, DataFrame]:
    """(source vertices, link edges) of a link history."""
    vertices = history.select(F.md5(F.concat(F.lit("IdSource"), F.col(source))).alias("internal_id"), F.col(source).alias("id_source")).distinct()
    edges = history.select(link_edge_id(F.col(key), F.col("ts")).alias("internal_id"), link_vertex_id(F.col(key)).alias("src_id"), F.md5(F.concat(F.lit("IdSource"), F.col(source))).alias("dst_id"), F.when(F.col("is_unlink"), "_unlink_").otherwise("_link_").alias("edge_label")).distinct()
    return vertices, edges


def incremental(remote_max: DataFrame, local_max: DataFrame, working: DataFrame, sample: int | None = None) -> DataFrame:
    """Ids in (local max, remote max] that nothing works on: one-row tables (max_id) and working (id_value). The driver learns the two
    bounds only; the range is made by as many tasks as it needs. sample: no more than the first so many ids of the range are looked at in this pass."""
    high, low = (m.agg(F.max("max_id")).first()[0] for m in (remote_max, local_max))
    first, last = (low or 0) + 1, high if high is not None else 0
    if sample is not None:
        last = min(last, first + sample - 1)
    ids = remote_max.sparkSession.range(first, max(first, last + 1)).select(F.col("id").alias("id_value"))
    return ids.join(working.select("id_value"), "id_value", "left_anti")


def max_indexed(vertices: DataFrame, stems: DataFrame, fallback: int | None = None) -> DataFrame:
    """(identifier_stem, max_id, is_empty) of each asked stem: the largest id indexed under it; an empty index gives the fallback, or an error without one."""
    found = vertices.groupBy("identifier_stem").agg(F.max("id_value").alias("_max"))
    joined = stems.select("identifier_stem").distinct().join(found, "identifier_stem", "left")
    missing = F.lit(fallback).cast("bigint") if fallback is not None else F.raise_error(F.concat(F.lit("nothing is indexed under "), F.col("identifier_stem"))).cast("bigint")
    return joined.select("identifier_stem", F.when(F.col("_max").isNotNull(), F.col("_max").cast("bigint")).otherwise(missing).alias("max_id"), F.col("_max").isNull().alias("is_empty"))


def of_stem(history: DataFrame, stem: str, key: str = "identifier_stem") -> DataFrame:
    """The current links under one stem, a filter that reaches the scan of the history."""
    return current(history.where(F.col(key) == stem), key, "id_value").where("is_linked").select(key, "id_value", "changed_at")


def propagate(ids: DataFrame, categories: DataFrame, most: int = 1000) -> DataFrame:
    """Every id with every category. The categories are a fixed dimension of at most `most` rows, which is checked: they become a literal that each id is exploded by, so no table is joined or shuffled."""
    rows = categories.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} categories")
    fields = categories.schema.fields
    listed = F.array(*(F.struct(*(F.lit(r[k]).cast(f.dataType).alias(f.name) for k, f in enumerate(fields))) for r in rows)).cast(f"array<{categories.schema.simpleString()}>")
    return ids.withColumn("_category", F.explode(listed)).select(*ids.columns, *(F.col(f"_category.`{f.name}`").alias(f.name) for f in fields))
