"""Deterministic ids: md5 of concatenated key texts, identifier stems, edge, link and secret ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values written where a value is absent; a vertex entry may have another one for sensitive ones.
MISSING = "MISSING_OBJECT_PROPERTY"
MISSING_SECRET = "MISSING_SENSITIVE_VALUE"


def key_text(*keys: Column) -> Column:
    """What an internal id is the md5 of: the keys' texts; a missing key reads as the missing marker."""
    return F.concat(*(F.coalesce(k.cast("string"), F.lit(MISSING)) for k in keys))


def internal_id(*keys: Column) -> Column:
    """md5 of the keys' texts."""
    return F.md5(key_text(*keys))


def json_pairs(pairs: dict[str, Column], quoted: set[str] | None = None) -> Column:
    """{"a": 1, "b": "x"} with ", " and ": " between, nulls kept; only the named (None: all) values are quoted."""
    parts: list[Column] = []
    for k, (name, value) in enumerate(pairs.items()):
        text = value.cast("string")
        escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
        shown = F.concat(F.lit('"'), escaped, F.lit('"')) if quoted is None or name in quoted else text
        parts += [F.lit((", " if k else "") + f'"{name}": '), F.coalesce(shown, F.lit("null"))]
    return F.concat(F.lit("{"), *parts, F.lit("}"))


def identifier_stem(object_type: str, pairs: dict[str, Column], quoted: set[str] | None = None, graph_type: str = "vertex") -> Column:
    """#graph_type#object_type#{pairs}#; a null value makes the type a stub."""
    stub = F.lit(False)
    for value in pairs.values():
        stub = stub | value.isNull()
    kind = F.when(stub, f"{object_type}::stub").otherwise(object_type)
    return F.concat(F.lit(f"#{graph_type}#"), kind, F.lit("#"), json_pairs(pairs, quoted), F.lit("#"))


def stem_type(stem: Column) -> Column:
    return F.regexp_extract(stem, "^#[^#]*#([^#]*)#", 1)


def stem_pairs(stem: Column) -> Column:
    """The pairs as map<string,string>; null values stay."""
    return F.from_json(F.regexp_extract(stem, r"(\{.*\})", 1), "map<string,string>")


def is_stub(stem: Column) -> Column:
    return stem_type(stem).endswith("::stub")


def edge_id(source: Column, label: Column, target: Column, *more: Column, inbound: Column | None = None) -> Column:
    """md5 of from, label, to and any properties; inbound edges swap the ends."""
    if inbound is None:
        return internal_id(source, label, target, *more)
    return F.when(inbound, internal_id(target, label, source, *more)).otherwise(internal_id(source, label, target, *more))


def link_vertex_id(value: Column) -> Column:
    return F.md5(F.concat(F.lit("fip_link"), value.cast("string")))


def link_edge_id(value: Column, moment: Column) -> Column:
    return F.md5(F.concat(F.lit("fip_link"), value.cast("string"), moment.cast("string")))


def secret_token(object_id: Column, kind: str) -> Column:
    """The recorded order is id, then type: all sensitive values of a type on one object share a token."""
    return F.md5(F.concat(object_id, F.lit(kind)))


def change_stem(source: Column, kind: Column, identifier: Column, category: Column) -> Column:
    return F.concat(F.lit("#"), F.concat_ws("#", source, kind, identifier, category), F.lit("#"))


def stub_sort_id(value: Column, props: Column) -> Column:
    """What a stub is ordered by: its id, or the JSON of its properties as texts."""
    return F.coalesce(value.cast("string"), F.to_json(F.transform_values(props, lambda _, v: v.cast("string"))))


def link_entry(moment: Column, unlink: Column) -> Column:
    return F.concat(F.unix_seconds(moment.cast("timestamp")).cast("string"), F.when(unlink, "!unlink").otherwise("!link"))


def parse_link_entry(entry: Column) -> Column:
    return F.struct(F.timestamp_seconds(F.split_part(entry, F.lit("!"), F.lit(1)).cast("bigint")).alias("ts"), (F.split_part(entry, F.lit("!"), F.lit(2)) == "unlink").alias("is_unlink"))
