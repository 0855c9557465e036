"""Typed JSON made plain: key-value store items, GraphSON and tagged values. A small helper per text; Spark deals the rows."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DataType, MapType, NumericType, StringType, StructType

#: Fixed tags of the formats.
STORE_TAGS = {"S", "N", "BOOL", "NULL", "M", "L", "SS", "NS"}
GRAPH_LISTS, GRAPH_PLAIN = {"g:List", "g:Set", "g:Path"}, {"g:Int32", "g:Int64", "g:Double", "g:Float", "g:Date", "g:T", "g:Vertex", "g:Edge", "g:VertexProperty", "g:Property"}


def number(text: str) -> int | float:
    value = float(text)
    return int(value) if value.is_integer() and "." not in text else value


def plain(value: object) -> object:
    """The value without type wrappers."""
    if isinstance(value, list):
        return [plain(v) for v in value]
    if not isinstance(value, dict):
        return value
    if "@type" in value:
        inner = value.get("@value")
        if value["@type"] == "g:Map":
            return {str(plain(k)): plain(v) for k, v in zip(inner[::2], inner[1::2], strict=True)}
        if value["@type"] in GRAPH_LISTS | GRAPH_PLAIN:
            return plain(inner)
        raise ValueError(f"no type {value['@type']}")
    if "_alg_class" in value and set(value) == {"_alg_class", "value"}:
        return plain(value["value"])
    if len(value) == 1 and (tag := next(iter(value))) in STORE_TAGS:
        inner = value[tag]
        if tag == "N":
            return number(inner)
        if tag == "NS":
            return [number(x) for x in inner]
        if tag == "NULL":
            return None
        return {k: plain(v) for k, v in inner.items()} if tag == "M" else plain(inner)
    return {k: plain(v) for k, v in value.items()}


@F.pandas_udf(StringType())
def plain_json(texts: pd.Series) -> pd.Series:
    """Plain JSON of typed JSON; null for what is none."""

    def one(text: str | None) -> str | None:
        try:
            return None if text is None else json.dumps(plain(json.loads(text)), sort_keys=True)
        except (ValueError, AttributeError, TypeError):
            return None

    return texts.map(one)


def tagged(value: Column, kind: DataType) -> Column:
    """value with the store's type tags, for encoded(): numbers as text under N, lists under L, structs and maps under M, null under NULL, all else as text under S."""
    if isinstance(kind, StructType):
        tag, inner = "M", F.struct(*(tagged(value[f.name], f.dataType).alias(f.name) for f in kind))
    elif isinstance(kind, MapType):
        tag, inner = "M", F.transform_values(value, lambda _, v: tagged(v, kind.valueType))
    elif isinstance(kind, ArrayType):
        tag, inner = "L", F.transform(value, lambda v: tagged(v, kind.elementType))
    elif isinstance(kind, BooleanType):
        tag, inner = "BOOL", value
    else:
        tag, inner = ("N" if isinstance(kind, NumericType) else "S"), value.cast("string")
    return F.struct(F.when(value.isNotNull(), inner).alias(tag), F.when(value.isNull(), F.lit(True)).alias("NULL"))


def encoded(value: Column, kind: DataType) -> Column:
    """Typed JSON text of a column of a type; plain_json() gives the plain JSON back. Built-in expressions only."""
    return F.to_json(tagged(value, kind), {"ignoreNullFields": "true"})
