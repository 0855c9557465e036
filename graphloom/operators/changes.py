"""Change logs: mapping, enrichment, targets, change types."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions import text
from graphloom.functions.types import source_time
from graphloom.registry import mutations

mutations("split_record_id")(lambda c: F.struct(text.split_entry(c)["entry_id"].alias("record_id"), text.split_entry(c)["entry_text"].alias("record_type")))
mutations("get_client_id")(lambda c: text.split_entry(c)["entry_id"])
mutations("convert_datetime")(source_time)
mutations("convert_datetime_utc")(source_time)


def choose_mapping(mappings: Mapping, id_source: str, id_type: str) -> dict:
    """A source's own mapping, else the default one, of a type."""
    return (mappings.get(id_source) or mappings["default"])[id_type]


def mapped(rows: DataFrame, mapping: dict[str, dict]) -> DataFrame:
    """Columns renamed and mutated by {source column: {"name": ..., "mutation": ...}}; others go. Empty text stays as it is."""
    out: list[Column] = []
    for source, to in mapping.items():
        value = F.col(f"`{source}`")
        if to.get("mutation"):
            value = F.when(value.isNotNull() & (value.cast("string") != ""), mutations.get(to["mutation"])(value))
        out.append(value.alias(to["name"]))
    return rows.select(*out)


def enrich(log: DataFrame, by_emp: DataFrame, detail_ids: DataFrame, details: DataFrame, driving_id: str) -> DataFrame:
    """log (change_date_utc, ...) with the employee who did it (else the driving id), its changelog id and its details: three left joins on the moment and the changelog id."""
    joined = log.join(by_emp.select("change_date_utc", "emp_id"), "change_date_utc", "left").join(detail_ids.select("change_date_utc", "changelog_id"), "change_date_utc", "left").join(details, "changelog_id", "left")
    return joined.withColumn("emp_id", F.coalesce("emp_id", F.col(driving_id)))


def with_category(log: DataFrame, change_types: DataFrame) -> DataFrame:
    """log with its action's id and category; an unknown action is an error."""
    joined = log.join(change_types.select("action", "action_id", "category"), "action", "left")
    return joined.withColumn("action_id", F.when(F.col("action_id").isNotNull(), F.col("action_id")).otherwise(F.raise_error(F.concat(F.lit("unknown action "), F.coalesce("action", F.lit("null")))).cast("bigint")))


def changed_targets(rows: DataFrame, driving_type: str | None = None) -> DataFrame:
    """One row per client, visit and record that a change names. A record without a type has the driving type; a record with the driving id itself is left out; an id that is no number makes all of its record null."""
    number = lambda c: F.nullif(F.col(c).cast("string"), F.lit("")).try_cast("bigint")
    record = F.struct(F.coalesce(F.nullif(F.col("record_type"), F.lit("")), F.lit(driving_type or "unspecified")).alias("id_type"), number("record_id").alias("id_value"))
    options = [F.struct(F.lit("Clients").alias("id_type"), number("client_id").alias("id_value")), F.struct(F.lit("ClientVisit").alias("id_type"), number("clientvisit_id").alias("id_value"))]
    own = (number("record_id") == number("client_id")) | (number("record_id") == number("clientvisit_id"))
    every = F.array(*options, F.when(~F.coalesce(own, F.lit(False)), record))
    return rows.withColumn("_target", F.explode(F.filter(every, lambda t: t.isNotNull() & t["id_value"].isNotNull()))).select(*rows.columns, "_target.id_type", "_target.id_value")


def changed_targets_before(rows: DataFrame, static_types: dict[str, tuple[str, str]], driving_type: str, driving_name: str) -> DataFrame:
    """The older form of changed_targets(), with id names: clients and visits whose id isn't 0, and the record under its own type. Clients and visits as record types are left out, as they are there
    already; an unspecified record has the type and name that static_types gives the row's `action`, and an action without them is an error."""
    number = lambda c: F.nullif(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("0")).try_cast("bigint")
    one = lambda kind, name, value: F.struct(kind.alias("id_type"), name.alias("id_name"), value.alias("id_value"))
    kind = F.coalesce(F.nullif(F.col("record_type"), F.lit("")), F.lit(driving_type))
    static = F.create_map(*(x for k, (t, n) in static_types.items() for x in (F.lit(k), F.struct(F.lit(t).alias("t"), F.lit(n).alias("n")))))
    given = static[F.col("action")]
    value = F.nullif(F.col("record_id").cast("string"), F.lit("")).try_cast("bigint")
    known = F.when(given.isNotNull(), given["t"]).otherwise(F.raise_error(F.concat(F.lit("no type for records of "), F.col("action"))).cast("string"))
    record = F.when(value.isNull() | kind.isin("ClientVisit", "Clients"), F.lit(None)).when(kind == "unspecified", one(known, given["n"], value)).otherwise(one(kind, F.lit(driving_name), value))
    every = F.array(one(F.lit("Clients"), F.lit("client_id"), number("client_id")), one(F.lit("ClientVisit"), F.lit("clientvisit_id"), number("clientvisit_id")), record)
    return rows.withColumn("_target", F.explode(F.filter(every, lambda t: t.isNotNull() & t["id_value"].isNotNull()))).select(*rows.columns, "_target.id_type", "_target.id_name", "_target.id_value")


def listed_actions(pages: DataFrame, html: str, pattern: str, change_types: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pages with the stored types of the actions that they list, the listed actions that no type has). pattern's first group is an action; each counts once a page."""
    rest = [c for c in pages.columns if c != html]
    each = pages.select(*rest, F.explode(F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(1)))).alias("action"))
    return each.join(change_types, "action"), each.join(change_types.select("action"), "action", "left_anti")


def since_known(log: DataFrame, known: DataFrame, category: str, driving_id: str = "id_value", moment: str = "change_date") -> DataFrame:
    """Of a log (driving id, moment, category, ...) one category's rows from each driving id's latest known moment on; of ids without one all. Known moments are aggregated first."""
    latest = known.groupBy(driving_id).agg(F.max(moment).alias("_latest"))
    return log.where(F.col("category") == category).join(latest, driving_id, "left").where(F.col("_latest").isNull() | (F.col(moment) >= F.col("_latest"))).drop("_latest")


def type_index(change_types: DataFrame, prefix: str | None = None) -> DataFrame:
    """(action, action_id, category_id, category): the dimension's rows, of categories that begin with a prefix if one is given."""
    rows = change_types if prefix is None else change_types.where(F.col("category").startswith(prefix))
    return rows.select("action", "action_id", "category_id", "category").dropDuplicates(["action_id"])


def by_category(change_types: DataFrame, prefix: str | None = None) -> DataFrame:
    """(category_id, actions map<action_id, action>) of the same rows."""
    rows = type_index(change_types, prefix)
    return rows.groupBy("category_id").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("action_id", "action")))).alias("actions"))


def setup(configs: DataFrame, asked: DataFrame, *keys: str) -> DataFrame:
    """asked with the configuration of its keys; one that isn't set up is an error that names it."""
    joined = asked.join(configs, [*keys], "left")
    names = F.concat_ws(".", *keys)
    return joined.withColumn("setup", F.when(F.col("setup").isNotNull(), F.col("setup")).otherwise(F.raise_error(F.concat(F.lit("not set up: "), names)).cast(configs.schema["setup"].dataType)))


def categories(change_types: DataFrame) -> DataFrame:
    """Per category its actions and what they share; a dimension of a few dozen rows."""
    return change_types.groupBy("category_id").agg(F.min("category").alias("category"), F.sort_array(F.collect_set("action_id")).alias("action_ids"), F.count("*").alias("actions"))


def daily_log(log: DataFrame, start: str, end: str) -> DataFrame:
    """A date range of a log by moment: a later row replaces an earlier one of the same moment."""
    kept = log.where(F.col("change_date").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    return kept.groupBy("change_date_utc").agg(F.max_by(F.struct(*[c for c in log.columns if c != "change_date_utc"]), "sequence").alias("_r")).select("change_date_utc", "_r.*")
