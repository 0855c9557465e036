"""Declarative graph schemas: vertex and edge entries with properties, linking rules, sensitive fields and indexes."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from graphloom.functions.ids import MISSING_SECRET

PROPERTY_KINDS = ("String", "Number", "DateTime", "Boolean")
EDGE_ID_START = ("from.internal_id", "schema.edge_label", "to.internal_id")
EDGE_SOURCES = ("source_vertex", "target_vertex", "extraction", "function")


class SchemaError(ValueError):
    """A schema that contradicts itself; the message names the entry."""


@dataclass(frozen=True)
class Property:
    name: str
    kind: str = "String"
    sensitive: bool = False
    is_id: bool = False

    def __post_init__(self) -> None:
        if self.kind not in PROPERTY_KINDS:
            raise SchemaError(f"{self.name}: no property type {self.kind}")


@dataclass(frozen=True)
class EdgeProperty:
    name: str
    kind: str
    source: str
    source_name: str = ""

    def __post_init__(self) -> None:
        if self.source not in EDGE_SOURCES:
            raise SchemaError(f"{self.name}: no property source {self.source}")


@dataclass(frozen=True)
class Rule:
    """How a vertex finds its targets. specifier: shared (fields of its own), extraction (rows extracted with it) or function (a registered one); constants are literals or source.<field> and win."""

    target_type: str
    edge_label: str
    specifier: str
    name: str = ""
    shared: tuple[str, ...] = ()
    constants: tuple[tuple[str, str], ...] = ()
    if_absent: str = "stub"
    inbound: bool = False

    def __post_init__(self) -> None:
        if self.specifier not in ("shared", "extraction", "function") or self.if_absent not in ("stub", "create", "pass"):
            raise SchemaError(f"{self.edge_label}: {self.specifier}, {self.if_absent}")


@dataclass(frozen=True)
class Index:
    name: str
    fields: tuple[str, ...]
    unique: bool = True
    object_types: tuple[str, ...] = ("*",)

    def applies(self, object_type: str) -> bool:
        return "*" in self.object_types or object_type in self.object_types


@dataclass(frozen=True)
class VertexEntry:
    name: str
    properties: tuple[Property, ...]
    id_key: tuple[str, ...]
    stem_key: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    indexes: tuple[Index, ...] = ()
    missing_secret: str = MISSING_SECRET

    def __post_init__(self) -> None:
        names = [p.name for p in self.properties]
        if len(set(names)) < len(names):
            raise SchemaError(f"{self.name}: a property is declared twice")
        if sum(p.is_id for p in self.properties) != 1:
            raise SchemaError(f"{self.name}: one property must be the id value")

    @property
    def id_property(self) -> Property:
        return next(p for p in self.properties if p.is_id)


@dataclass(frozen=True)
class EdgeEntry:
    label: str
    from_types: tuple[str, ...] = ("*",)
    to_types: tuple[str, ...] = ("*",)
    properties: tuple[EdgeProperty, ...] = ()
    id_key: tuple[str, ...] = EDGE_ID_START
    indexes: tuple[Index, ...] = ()

    def __post_init__(self) -> None:
        if self.id_key[:3] != EDGE_ID_START:
            raise SchemaError(f"{self.label}: an edge id begins with {', '.join(EDGE_ID_START)}")

    def allows(self, source_type: str, target_type: str, inbound: bool = False) -> bool:
        """Whether the label may join the types; an inbound edge is read from its target's side."""
        a, b = (target_type, source_type) if inbound else (source_type, target_type)
        return ("*" in self.from_types or a in self.from_types) and ("*" in self.to_types or b in self.to_types)


@dataclass(frozen=True)
class Schema:
    vertices: dict[str, VertexEntry] = field(default_factory=dict)
    edges: dict[str, EdgeEntry] = field(default_factory=dict)

    def __getitem__(self, name: str) -> VertexEntry | EdgeEntry:
        """By vertex name first, then by edge label."""
        found = self.vertices.get(name) or self.edges.get(name)
        if found is None:
            raise KeyError(name)
        return found

    def __post_init__(self) -> None:
        for v in self.vertices.values():
            for r in v.rules:
                if r.target_type not in self.vertices or r.edge_label not in self.edges:
                    raise SchemaError(f"{v.name}: rule {r.edge_label} to {r.target_type} has no entry")

    @staticmethod
    def from_json(text: str) -> Schema:
        """A schema of JSON text; {"$ref": "#/a/b"} stands for what is there in the same text."""
        given = with_references(json.loads(text))

        def indexes(entry: dict) -> tuple[Index, ...]:
            return tuple(Index(i["name"], tuple(i["fields"]), i.get("unique", True), tuple(i.get("object_types", ("*",)))) for i in entry.get("indexes", ()))

        def rule(r: dict) -> Rule:
            return Rule(**{**r, "shared": tuple(r.get("shared", ())), "constants": tuple((c[0], c[1]) for c in r.get("constants", ()))})

        vertices = [VertexEntry(v["name"], tuple(Property(**p) for p in v["properties"]), tuple(v["id_key"]), tuple(v["stem_key"]), tuple(map(rule, v.get("rules", ()))), indexes(v), v.get("missing_secret", MISSING_SECRET)) for v in given["vertices"]]
        edges = [EdgeEntry(e["label"], tuple(e.get("from_types", ("*",))), tuple(e.get("to_types", ("*",))), tuple(EdgeProperty(**p) for p in e.get("properties", ())), tuple(e.get("id_key", EDGE_ID_START)), indexes(e)) for e in given["edges"]]
        return Schema({v.name: v for v in vertices}, {e.label: e for e in edges})


def with_references(whole: object) -> object:
    """whole with each {"$ref": "#/a/b"} replaced by what its pointer names, which may hold references too. A pointer to nothing or within itself is an error."""

    def at(pointer: str) -> object:
        if not pointer.startswith("#"):
            raise SchemaError(f"{pointer}: only references within the text are known")
        value = whole
        for part in filter(None, pointer[1:].split("/")):
            part = part.replace("~1", "/").replace("~0", "~")
            try:
                value = value[int(part)] if isinstance(value, list) else value[part]
            except (KeyError, IndexError, ValueError, TypeError) as e:
                raise SchemaError(f"{pointer} names nothing") from e
        return value

    def resolved(value: object, within: tuple[str, ...]) -> object:
        if isinstance(value, list):
            return [resolved(v, within) for v in value]
        if not isinstance(value, dict):
            return value
        if "$ref" in value:
            if value["$ref"] in within:
                raise SchemaError(f"{value['$ref']} refers to itself")
            return resolved(at(value["$ref"]), (*within, value["$ref"]))
        return {k: resolved(v, within) for k, v in value.items()}

    return resolved(whole, ())


def newer(versions: list[tuple[int, str]], text: str) -> list[tuple[int, str]]:
    """versions with text as the next one, if it differs from the newest."""
    last = max(versions, default=(0, ""))
    return versions if last[1] == text else [*versions, (last[0] + 1, text)]
