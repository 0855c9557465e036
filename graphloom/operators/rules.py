"""Linking rules: targets of a vertex, their resolution against known vertices, and edges.

A potential target is a map of properties; those that the rule doesn't give are missing and match anything. Targets are
resolved per type by an equality join on the properties that every potential of the rule has, with the rest as a
residual. What matches nothing follows the rule: stub, create or pass. Edges run to each matched vertex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from graphloom.functions import ids
from graphloom.operators.vertices import build
from graphloom.registry import edge_properties, specifiers
from graphloom.schema import EdgeEntry, Rule, Schema, VertexEntry


def constant(value: str) -> Column:
    """source.<field> refers to the source row and keeps its type; all else is a literal."""
    return F.col(f"`{value.removeprefix('source.')}`") if value.startswith("source.") else F.lit(value)


def targets(sources: DataFrame, rule: Rule, *keep: str, child: tuple[DataFrame, str] | None = None) -> DataFrame:
    """One row per target: `keep` columns, the target's properties as columns, and `extracted` for extraction rules, whose rows are an array of the source or a table of their own (child, key), joined by a column of the source. Constants win over extracted values."""
    fixed = {name: constant(value) for name, value in rule.constants}
    if rule.specifier == "shared":
        given = {name: F.col(f"`{name}`") for name in rule.shared}
        return sources.select(*keep, *(c.alias(n) for n, c in {**given, **fixed}.items()))
    if rule.specifier == "extraction":
        if child is None:
            each = sources.withColumn("extracted", F.explode(rule.name))
        else:
            rows, key = child
            each = sources.join(rows.select(key, F.struct(*(c for c in rows.columns if c != key)).alias("extracted")), key)
        fields = each.schema["extracted"].dataType.names
        given = {n: F.col(f"extracted.{n}") for n in fields if n not in keep}
        return each.select(*keep, "extracted", *(c.alias(n) for n, c in {**given, **fixed}.items()))
    return specifiers.get(rule.name)(sources, rule, fixed, keep)


@specifiers("derive_change_targeted")
def derive_change_targeted(sources: DataFrame, rule: Rule, fixed: dict[str, Column], keep: tuple[str, ...]) -> DataFrame:
    """Targets of change records: one row for each id that isn't empty (client, visit, employee, record). A deliberate choice: each id is a target of its own."""
    kinds = {"client_id": "Clients", "clientvisit_id": "ClientVisit", "emp_id": "Employees"}
    each = sources.withColumn("_t", F.explode("changed_target"))
    fields = each.schema["_t"].dataType.names
    one = [F.struct(F.lit(kind).alias("id_type"), F.lit(name).alias("id_name"), F.nullif(F.col(f"_t.{name}").cast("string"), F.lit("")).try_cast("bigint").alias("id_value")) for name, kind in kinds.items() if name in fields]
    if "record_id" in fields:
        one.append(F.struct(F.coalesce(F.nullif(F.col("_t.record_type"), F.lit("")), F.lit("unspecified")).alias("id_type"), F.coalesce(F.nullif(F.col("_t.primarykey_name"), F.lit("")), F.lit("record_id")).alias("id_name"), F.nullif(F.col("_t.record_id").cast("string"), F.lit("")).try_cast("bigint").alias("id_value")))
    found = each.withColumn("_p", F.explode(F.filter(F.array(*one), lambda x: x["id_value"].isNotNull())))
    given = {n: F.col(f"_p.{n}") for n in ("id_type", "id_name", "id_value")}
    return found.select(*keep, F.col("_t").alias("extracted"), *(c.alias(n) for n, c in {**given, **fixed}.items()))


def signed(potentials: DataFrame, known: DataFrame, always: tuple[str, ...], free: list[str], missing: str, given: str) -> tuple[DataFrame, DataFrame, list[str]]:
    """(potentials, known, names): both sides with `_lacks`, the signature of what a potential lacks, and the properties as keys, hidden where the signature lacks them. Known vertices are repeated for each signature that there is."""
    bit = lambda n: F.when(F.array_contains(missing, free[n]), 1 << n).otherwise(0)
    lacks = F.lit(0)
    for n in range(len(free)):
        lacks = lacks + bit(n)
    shown = lambda column, n: F.when(F.col("_lacks").bitwiseAND(F.lit(1 << n)) == 0, F.col(column))
    keys = lambda side: [*(F.col(f"{side}{name}").alias(f"_always{n}") for n, name in enumerate(always)), *(shown(f"{side}{name}", n).alias(f"_free{n}") for n, name in enumerate(free))]
    asked = potentials.withColumn("_lacks", F.coalesce(lacks, F.lit(0)))
    asked = asked.select(*potentials.columns, "_lacks", *keys(given))
    signatures = [r["_lacks"] for r in asked.select("_lacks").distinct().collect()]
    held = known.withColumn("_lacks", F.explode(F.array(*map(F.lit, signatures)).cast("array<int>")))
    return asked, held.select(F.col("internal_id").alias("matched_id"), "_lacks", *keys("")), ["_lacks", *(f"_always{n}" for n in range(len(always))), *(f"_free{n}" for n in range(len(free)))]


def same_keys(names: list[str]) -> Column:
    """Of p and v: equal keys, nulls are equal only where a property may be missing."""
    on = F.lit(True)
    for name in names:
        p, v = F.col(f"p.{name}"), F.col(f"v.{name}")
        on = on & (p.eqNullSafe(v) if name.startswith("_free") else p == v)
    return on


def resolve(potentials: DataFrame, known: DataFrame, properties: tuple[str, ...], always: tuple[str, ...], missing: str = "missing", given: str = "") -> DataFrame:
    """potentials (potential_id, properties, missing array) with matched_id: equality on `always`, on others only where the potential has them; one row per match, matched_id null without one. given: where the potentials keep their properties, such as "a_struct.".

    Potentials that lack the same properties have one signature. Known vertices are met once for each signature that there is (2 to the number of other
    properties at most), with the properties outside it hidden, so every property is part of one equality join and none is tested on pairs.
    """
    free = [name for name in properties if name not in always]
    if not free:
        p, v = potentials.alias("p"), known.alias("v")
        on = F.lit(True)
        for name in always:
            on = on & (F.col(f"p.{given}{name}") == F.col(f"v.{name}"))
        return p.join(v, on, "left").select("p.*", F.col("v.internal_id").alias("matched_id"))
    asked, held, names = signed(potentials, known, always, free, missing, given)
    p, v = asked.alias("p"), held.hint("merge").alias("v")  # a small table may be many rows once it is repeated
    return p.join(v, same_keys(names), "left").select(*(F.col(f"p.`{c}`") for c in potentials.columns), "v.matched_id")


def resolve_counts(potentials: DataFrame, known: DataFrame, properties: tuple[str, ...], always: tuple[str, ...], missing: str = "missing", given: str = "") -> DataFrame:
    """Each of the potentials once, with `matches`, how many known vertices resolve() pairs it with, and the smallest of them as matched_id.

    Known vertices are counted by what a potential can ask for before they meet, so no pair is made: a potential that lacks much matches a share of all vertices.
    """
    free = [name for name in properties if name not in always]
    asked, held, names = signed(potentials, known, always, free, missing, given)
    counted = held.groupBy(*names).agg(F.count("*").alias("matches"), F.min("matched_id").alias("matched_id"))
    p, v = asked.alias("p"), counted.hint("merge").alias("v")
    return p.join(v, same_keys(names), "left").select(*(F.col(f"p.`{c}`") for c in potentials.columns), F.coalesce("v.matches", F.lit(0)).alias("matches"), "v.matched_id")


def apply_policy(resolved: DataFrame, complete: str, if_absent: str) -> DataFrame:
    """resolved with outcome and target_id: complete targets are themselves, matches win, then the policy."""
    own = F.col(complete)
    outcome = F.when(own, "self").when(F.col("matched_id").isNotNull(), "match").otherwise(if_absent)
    rows = resolved.withColumn("outcome", outcome).where("outcome != 'pass'")
    return rows.withColumn("target_id", F.when(F.col("outcome") == "self", F.col("internal_id")).when(F.col("outcome") == "match", F.col("matched_id")).when(F.col("outcome") == "create", F.col("internal_id")))


def edge_value(name: str, source: str, source_name: str, inbound: bool) -> Column:
    if source == "function":
        return edge_properties.get(source_name or name)(inbound)
    if source == "extraction":
        return F.col(f"extracted.{source_name or name}")
    side = "source" if (source == "source_vertex") != inbound else "target"
    return F.col(f"{side}_props")[source_name or name]


def edges(linked: DataFrame, entry: EdgeEntry, inbound: bool = False) -> DataFrame:
    """Edges for rows (source_id, source_type, source_props, target_id, target_type, target_props[, extracted]); types the entry doesn't allow raise an error. Inbound edges swap ends, roles and id."""
    values = {p.name: edge_value(p.name, p.source, p.source_name, inbound).cast("string") for p in entry.properties}
    a, b = ("target", "source") if inbound else ("source", "target")
    allowed = F.lit(True)
    for side, types in ((a, entry.from_types), (b, entry.to_types)):
        if "*" not in types:
            allowed = allowed & F.col(f"{side}_type").isin(*types)
    checked = F.when(allowed, F.col(f"{a}_id")).otherwise(F.raise_error(F.lit(f"{entry.label} doesn't join these types")).cast("string"))
    more = [values[k] for k in entry.id_key[3:]]
    props = F.create_map(*(x for n, v in values.items() for x in (F.lit(n), v))) if values else F.create_map().cast("map<string,string>")
    return linked.select(
        F.lit(entry.label).alias("edge_label"),
        F.when(F.col("target_id").isNotNull(), ids.edge_id(F.col(f"{a}_id"), F.lit(entry.label), F.col(f"{b}_id"), *more)).alias("internal_id"),
        checked.alias("src_id"),
        F.col(f"{b}_id").alias("dst_id"),
        props.alias("props"),
        F.lit(inbound).alias("inbound"),
    )


def follow(sources: DataFrame, entry: VertexEntry, rule: Rule, schema: Schema, known: DataFrame | None = None, child: tuple[DataFrame, str] | None = None, hashed: bool = True) -> tuple[DataFrame, DataFrame]:
    """(new target vertices, edges) of one rule. Without known vertices a target is built once for all sources that give it the same properties. sources: vertices of entry beside the columns its rules read. known: vertices of the target type, with their properties as columns. child: see targets(). hashed: see build(), of the sources too."""
    target = schema.vertices[rule.target_type]
    own = sources.withColumnsRenamed({"internal_id": "source_id", "props": "source_props", "object_type": "source_type"})
    keep = ["source_id", "source_type", "source_props"]
    rows = targets(own, rule, *keep, child=child)
    extra = ["extracted"] if "extracted" in rows.columns else []
    names = tuple(p.name for p in target.properties if p.name in rows.columns)
    made = build(rows.withColumn("_given", F.struct(*names)), target, (*keep, *extra, "_given"), hashed)
    if known is None:
        matched = made.withColumn("matched_id", F.lit(None).cast("string"))
    else:
        matched = resolve(made, known, names, names, given="_given.")
    settled = apply_policy(matched, "is_complete", rule.if_absent)
    if known is None and not any(isinstance(rows.schema[n].dataType, MapType) for n in names):
        each = build(rows.select(*names).distinct(), target, hashed=hashed).withColumn("matched_id", F.lit(None).cast("string"))
        fresh = apply_policy(each, "is_complete", rule.if_absent)
    else:
        fresh = settled.where("outcome != 'match'")
    new = fresh.select("object_type", "internal_id", "identifier_stem", "id_value", "id_value_field", "props", "missing", "is_identifiable", "is_complete", (F.col("outcome") == "stub").alias("is_stub"))
    linked = settled.select(*keep, *extra, "target_id", F.lit(target.name).alias("target_type"), F.col("props").alias("target_props"))
    return new, edges(linked, schema.edges[rule.edge_label], rule.inbound)
