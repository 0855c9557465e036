"""Vertices from rows: projection, typing, ids, stems, masking, stubs.

A vertex row has object_type, internal_id, identifier_stem, id_value, id_value_field, props map<string,string> (canonical
texts), missing array<string> (declared properties that the rows don't have), is_identifiable and is_complete. Absent,
null and empty are different: an absent column is missing, an empty text is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from graphloom.functions import ids
from graphloom.functions.types import NUMBER, canonical, graph_time, to_property
from graphloom.schema import Property, VertexEntry


def text_of(value: Column, kind: str) -> Column:
    if kind == "Number":
        return canonical(value)
    return graph_time(value) if kind == "DateTime" else value.cast("string")


def typed(rows: DataFrame, properties: tuple[Property, ...]) -> dict[str, tuple[Column, Column]]:
    """(value, canonical text) of each declared property that rows have. Integers take a short way to the same text."""
    found = {}
    for p in properties:
        if p.name not in rows.columns:
            continue
        column = F.col(f"`{p.name}`")
        if p.kind == "Number" and isinstance(rows.schema[p.name].dataType, IntegralType):
            value = F.nullif(column, F.lit(0))
            found[p.name] = value.cast(NUMBER), value.cast("string")
        else:
            value = to_property(column, p.kind)
            found[p.name] = value, text_of(value, p.kind)
    return found


def build(rows: DataFrame, entry: VertexEntry, keep: tuple[str, ...] = (), hashed: bool = True) -> DataFrame:
    """Vertices of one type; `keep` columns of rows stay beside them (for rules). Projections only, no shuffle: texts are made once, then used in ids, stems and properties. Not hashed: internal_id is the text that it is the md5 of, for those who make rows distinct first."""
    found = typed(rows, entry.properties)
    absent = [p.name for p in entry.properties if p.name not in found]
    id_property = entry.id_property
    raw = [k for k in entry.stem_key if k not in found and k in rows.columns]
    staged = rows.select(
        F.struct(*(F.col(f"`{k}`") for k in keep)).alias("_keep") if keep else F.lit(None).alias("_keep"),
        *(text.alias(f"_text_{name}") for name, (_, text) in found.items()),
        *(F.col(f"`{k}`").cast("string").alias(f"_raw_{k}") for k in raw),
        (found[id_property.name][0] if id_property.name in found else F.lit(None)).alias("_id"),
    )
    text = {name: F.col(f"`_text_{name}`") for name in found}

    def key(name: str) -> Column:
        if name == "object_type":
            return F.lit(entry.name)
        if name == "id_value_field":
            return F.lit(id_property.name)
        return text.get(name, F.lit(None).cast("string"))

    keys = [key(k) for k in entry.id_key]
    identifiable = F.lit(True)
    for k in keys:
        identifiable = identifiable & k.isNotNull()
    value = (F.unix_micros("_id") / 1e6 if id_property.kind == "DateTime" and id_property.name in found else F.col("_id")).try_cast(NUMBER)
    placed = staged.withColumn("_internal", F.when(identifiable, ids.internal_id(*keys) if hashed else ids.key_text(*keys)))
    internal = F.col("_internal")
    owner = internal if hashed else F.md5(internal)
    stem = {k: text[k] if k in text else F.col(f"`_raw_{k}`") for k in entry.stem_key if k in text or k in raw}
    shown = dict(text)
    for p in entry.properties:
        if p.sensitive and p.name in text:
            shown[p.name] = F.when(text[p.name].isNull(), entry.missing_secret).when(internal.isNotNull(), ids.secret_token(owner, p.kind))
    props = F.create_map(*(x for name, v in shown.items() for x in (F.lit(name), v))) if shown else F.create_map().cast("map<string,string>")
    quoted = {p.name for p in entry.properties if p.kind != "Number"} | set(raw)
    return placed.select(
        F.lit(entry.name).alias("object_type"),
        internal.alias("internal_id"),
        (ids.identifier_stem(entry.name, stem, quoted) if len(stem) == len(entry.stem_key) else F.lit(None).cast("string")).alias("identifier_stem"),
        value.alias("id_value"),
        F.lit(id_property.name).alias("id_value_field"),
        props.alias("props"),
        F.array(*map(F.lit, absent)).cast("array<string>").alias("missing"),
        internal.isNotNull().alias("is_identifiable"),
        (F.lit(not absent and len(stem) == len(entry.stem_key)) & internal.isNotNull()).alias("is_complete"),
        *(F.col(f"_keep.`{k}`").alias(k) for k in keep),
    )


def secrets(rows: DataFrame, entry: VertexEntry) -> DataFrame:
    """(token, sensitive_entry): the plain values behind tokens; the first property's value of a token counts."""
    hidden = [p for p in entry.properties if p.sensitive and p.name in rows.columns]
    plain = F.array(*(F.struct(F.lit(k).alias("at"), F.lit(p.kind).alias("kind"), text_of(to_property(F.col(f"`{p.name}`"), p.kind), p.kind).alias("value")) for k, p in enumerate(hidden)))
    each = build(rows.withColumn("_plain", plain), entry, ("_plain",)).select("internal_id", F.explode("_plain").alias("p")).where("p.value is not null and internal_id is not null")
    return each.groupBy(F.md5(F.concat("internal_id", "p.kind")).alias("token")).agg(F.min_by("p.value", "p.at").alias("sensitive_entry"))


def first_wins(new: DataFrame, stored: DataFrame, *keys: str) -> DataFrame:
    """Rows whose key is not stored yet, one per key: what a conditional put would write."""
    return new.dropDuplicates(list(keys)).join(stored.select(*keys).distinct(), list(keys), "left_anti")


def last_wins(rows: DataFrame, sequence: str, *keys: str) -> DataFrame:
    """Per key the row of the largest sequence, by an aggregation that combines before the shuffle."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rows.columns), sequence).alias("_row")).select("_row.*")


def violations(vertices: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Keys of a unique index that several objects hold."""
    return vertices.groupBy(*fields).agg(F.count_distinct("internal_id").alias("objects")).where("objects > 1")
