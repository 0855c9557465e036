"""Indexes as schemas declare them: keys of objects, what they miss, and writing only what breaks no unique index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.ordering import written
from graphloom.schema import Index, Schema


def built_in(sid: str = "sid_value", stem: str = "identifier_stem", internal_id: str = "internal_id", id_value: str = "id_value", fungal_stem: str = "fungal_stem", numeric_id: str = "numeric_id_value") -> tuple[Index, ...]:
    """The unique indexes that every store has: of objects, internal ids, stems, links (which no object type is in) and change-log growth."""
    return (
        Index("object_index", (sid, stem)),
        Index("internal_id_index", (internal_id,)),
        Index("identifier_stem_index", (stem, id_value)),
        Index("link_index", ("id_source", "object_type", "utc_link_time"), object_types=()),
        Index("fungal_index", (fungal_stem, numeric_id), object_types=("ChangeLog",)),
    )


def declared(schema: Schema) -> tuple[Index, ...]:
    """The indexes of a schema's vertices and edges, each for its own entry unless it names types."""
    entries = [(v.name, v.indexes) for v in schema.vertices.values()] + [(e.label, e.indexes) for e in schema.edges.values()]
    return tuple(Index(i.name, i.fields, i.unique, i.object_types if i.object_types != ("*",) else (name,)) for name, indexes in entries for i in indexes)


def applies(index: Index, object_type: Column) -> Column:
    return F.lit(True) if "*" in index.object_types else object_type.isin(*index.object_types) if index.object_types else F.lit(False)


def has(objects: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`").isNotNull() if name in objects.columns else F.lit(False)


def key_of(objects: DataFrame, index: Index, object_type: str = "object_type") -> Column:
    """The key as text; null if the index isn't for the object's type or a field is missing."""
    if not all(f in objects.columns for f in index.fields):
        return F.lit(None).cast("string")
    whole = F.lit(True)
    for f in index.fields:
        whole = whole & has(objects, f)
    text = F.to_json(F.array(F.lit(index.name), *(F.col(f"`{f}`").cast("string") for f in index.fields)))
    return F.when(applies(index, F.col(object_type)) & whole, text)


def missing(objects: DataFrame, indexes: tuple[Index, ...], object_type: str = "object_type") -> DataFrame:
    """objects with `missing`: (index, fields) for each index of their type that they lack fields of."""
    found = []
    for index in indexes:
        lacking = F.array_compact(F.array(*(F.when(~has(objects, f), F.lit(f)) for f in index.fields)))
        found.append(F.when(applies(index, F.col(object_type)) & (F.size(lacking) > 0), F.struct(F.lit(index.name).alias("index"), lacking.alias("fields"))))
    return objects.withColumn("missing", F.array_compact(F.array(*found)))


def accepted(objects: DataFrame, indexes: tuple[Index, ...], order: list[str], stored: DataFrame | None = None, object_type: str = "object_type", most_rounds: int = 1000) -> DataFrame:
    """objects with `accepted` and `violates`: what writing them one after the other would do, each only if none of its unique keys is held.

    stored: objects that are there already. violates names the indexes whose key a stored or accepted object holds. Rows with equal order are taken in any order.

    Rounds: objects that are the first undecided ones of all their keys are accepted, others with one of these keys are beaten, until nothing is undecided. An
    object without a key is accepted. Every round decides the first undecided object at least, mostly all but chains of objects that wait for each other;
    undecided rows alone are read by the next one. Keys are aggregated before they are joined, so a key that most objects share costs one row a task.
    """
    unique = [i for i in indexes if i.unique]
    rows = written(objects.withColumn("_row", F.monotonically_increasing_id()), "objects")
    pair = lambda of: F.array_compact(F.array(*(F.when(key_of(of, i, object_type).isNotNull(), F.struct(F.lit(i.name).alias("index"), key_of(of, i, object_type).alias("key"))) for i in unique)))
    if not unique:
        return rows.drop("_row").withColumn("accepted", F.lit(True)).withColumn("violates", F.array().cast("array<string>"))
    keys = written(rows.select("_row", F.struct(*order, "_row").alias("_at"), F.explode(pair(rows)).alias("_k")).select("_row", "_at", "_k.index", "_k.key"), "keys")
    held = written((keys.select("key").limit(0) if stored is None else stored.select(F.explode(pair(stored)).alias("_k")).select("_k.key")).distinct(), "held")
    lost = keys.join(held, "key", "left_semi").select("_row").distinct()
    open_ = written(keys.join(lost, "_row", "left_anti"), "open")
    won: list[DataFrame] = []
    for _ in range(most_rounds):
        if open_.isEmpty():
            break
        first = open_.groupBy("key").agg(F.min("_at").alias("_first"))
        ahead = open_.join(first, "key").groupBy("_row").agg(F.bool_and(F.col("_at") == F.col("_first")).alias("_wins"))
        winners = written(ahead.where("_wins").select("_row"), "winners")
        won.append(winners)
        taken = open_.join(winners, "_row", "left_semi").select("key").distinct()
        beaten = open_.join(taken, "key", "left_semi").select("_row").distinct()  # the winners too
        open_ = written(open_.join(beaten, "_row", "left_anti"), "open")
    else:
        raise RuntimeError("objects wait for each other in too many rounds")
    winners = None
    for one in won:
        winners = one if winners is None else winners.unionByName(one)
    if winners is None:
        winners = keys.select("_row").limit(0)
    holders = keys.join(winners, "_row", "left_semi").select("key", F.col("_row").alias("_holder")).unionByName(held.select("key", F.lit(None).cast("long").alias("_holder")))
    against = keys.join(holders, "key").where(~F.col("_holder").eqNullSafe(F.col("_row"))).groupBy("_row").agg(F.array_sort(F.collect_set("index")).alias("violates"))
    return rows.join(against, "_row", "left").withColumn("accepted", F.col("violates").isNull()).withColumn("violates", F.coalesce("violates", F.array().cast("array<string>"))).select(*objects.columns, "accepted", "violates")
