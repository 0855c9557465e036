"""Shapes of rows between stages: cleaned properties, index rows, profiles, nested maps, merged enrichments and histories."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clean_properties(props: Column) -> Column:
    """A property map in which empty texts are null."""
    return F.transform_values(props, lambda _, v: F.nullif(v, F.lit("")))


def epoch_properties(rows: DataFrame, moments: tuple[str, ...]) -> DataFrame:
    """Timestamps as epoch seconds, for numeric property stores."""
    return rows.withColumns({m: F.unix_micros(F.col(m).cast("timestamp")) / 1e6 for m in moments})


def index_rows(vertices: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """A flat row per vertex: fixed fields, the numeric id and named properties as columns."""
    fixed = ("identifier_stem", "internal_id", "object_type", "id_value")
    return vertices.select(*fixed, F.col("id_value").cast("string").alias("sid_value"), *(F.col("props")[n].alias(n) for n in names if n not in fixed))


def extraction_profile(stem_pairs: Column, schema_properties: Column) -> Column:
    """Both maps; the schema's values win."""
    return F.map_from_entries(F.concat(F.filter(F.map_entries(stem_pairs), lambda e: ~F.map_contains_key(schema_properties, e["key"])), F.map_entries(schema_properties)))


def potentials(rows: DataFrame, key: str, name: str, value: str) -> DataFrame:
    """Per key a map of named values; names are those of a rule set, a bounded list. Of a name twice the larger value counts."""
    single = rows.groupBy(key, name).agg(F.max(value).alias(value))
    return single.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(name, value)))).alias("potentials"))


def shaped(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows as JSON objects for a query interface; nulls are kept."""
    return rows.select(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("object"))


def merge_histories(parts: list[DataFrame], sequence: str, *keys: str) -> DataFrame:
    """The union of histories, one row per key: the later one of `sequence`."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), sequence).alias("_r")).select("_r.*")


def merge_enrichments(rows: DataFrame, key: str, scalars: tuple[str, ...], lists: tuple[str, ...], order: str) -> DataFrame:
    """Per key the last scalar that isn't null and all list items, in order."""
    last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in scalars]

    def joined(c: str) -> Column:
        parts = F.sort_array(F.collect_list(F.struct(order, c)))
        return F.flatten(F.transform(parts, lambda x: F.coalesce(x[c], F.array().cast(rows.schema[c].dataType)))).alias(c)

    return rows.groupBy(key).agg(*last, *map(joined, lists))


def task_arguments(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Per argument its distinct values."""
    return rows.groupBy(key).agg(F.sort_array(F.collect_set(value)).alias("values"))


def one_of_each(rows: DataFrame, key: str, value: str) -> DataFrame:
    """The single value of each key; two different ones are an error."""
    found = rows.groupBy(key).agg(F.count_distinct(value).alias("_n"), F.min(value).alias(value))
    return found.select(key, F.when(F.col("_n") <= 1, F.col(value)).otherwise(F.raise_error(F.concat(F.lit("several values of "), F.col(key).cast("string"))).cast(rows.schema[value].dataType)).alias(value))


def branch_level(members: Column, width: Column) -> Column:
    """The level of a branch in a tree of a width."""
    return F.floor(F.log(members.cast("double")) / F.log(width.cast("double")) + 1e-12)


def recipients(people: DataFrame, attribute: str, values: list[str], closure: DataFrame | None = None, person: str = "emp_id") -> DataFrame:
    """People whose attribute is listed and, with a closure (ancestor, descendant), all above them."""
    chosen = people.where(F.col(attribute).isin(*values)).select(person)
    if closure is None:
        return chosen.distinct()
    above = closure.join(chosen.withColumnRenamed(person, "descendant"), "descendant").select(F.col("ancestor").alias(person))
    return chosen.unionByName(above).distinct()


def complete(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is null or empty."""
    on = F.lit(True)
    for c in columns:
        on = on & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    return rows.where(on)


def contains_all(text: Column, parts: tuple[str, ...]) -> Column:
    """Whether the text holds every part."""
    on = F.lit(True)
    for part in parts:
        on = on & text.contains(part)
    return on


def merged_maps(left: Column, right: Column) -> Column:
    """A deep merge of two map<string, map<string, string>>: inner maps are joined, the right value wins."""
    inner = lambda a, b: F.when(a.isNull(), b).when(b.isNull(), a).otherwise(F.map_zip_with(a, b, lambda _, x, y: F.coalesce(y, x)))
    return F.map_zip_with(left, right, lambda _, a, b: inner(a, b))


def widest(rows: DataFrame, cells: str) -> DataFrame:
    return rows.agg(F.max(F.size(cells)).alias("columns"))
