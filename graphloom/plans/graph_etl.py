"""Graph ETL as one plan: extract, transform, assimilate, index, graph."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.functions.ids import edge_id
from graphloom.operators.rules import follow
from graphloom.operators.vertices import build, first_wins, secrets
from graphloom.schema import Schema

VERTEX = ("object_type", "internal_id", "identifier_stem", "id_value", "id_value_field", "props", "missing", "is_identifiable", "is_complete", "is_stub")


@dataclass(frozen=True)
class Graph:
    vertices: DataFrame
    edges: DataFrame
    secrets: DataFrame | None
    stub_edges: DataFrame | None = None


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def distinct_edges(parts: list[tuple[str, bool, DataFrame]], schema: Schema, hashed: bool = True) -> DataFrame:
    """Edges with an id, once each, of (label, inbound, edges). Without edge properties the ends and the label say all, so the ends of each label are made distinct and the ids after that; ends that aren't hashed yet are shorter until then."""
    if any(e.properties for e in schema.edges.values()):
        return union([rows for _, _, rows in parts]).where("internal_id is not null").dropDuplicates(["internal_id"])
    found = []
    for label, inbound in dict.fromkeys((label, inbound) for label, inbound, _ in parts):
        rows = union([rows for name, way, rows in parts if (name, way) == (label, inbound)])
        plain = rows.where(F.col("src_id" if inbound else "dst_id").isNotNull()).select("src_id", "dst_id").distinct()
        ends = plain if hashed else plain.select(F.md5("src_id").alias("src_id"), F.md5("dst_id").alias("dst_id"))
        made = edge_id(F.col("src_id"), F.lit(label), F.col("dst_id"))
        found.append(ends.select(F.lit(label).alias("edge_label"), made.alias("internal_id"), "src_id", "dst_id", F.create_map().cast("map<string,string>").alias("props"), F.lit(inbound).alias("inbound")))
    return union(found)


def assimilate(extracted: dict[str, DataFrame], schema: Schema, known: dict[str, DataFrame] | None = None, children: dict[str, tuple[DataFrame, str]] | None = None) -> Graph:
    """extracted: rows by vertex type (with the arrays that extraction rules name, or those in `children`, tables by rule name with the column that joins them; columns that rules read can't have a vertex column's name). Vertices that several rules make are one row, complete ones before stubs; edges without a target id are kept apart, as stub edges."""
    vertices, edges, hidden = [], [], []
    hashed = bool(known) or any(e.properties for e in schema.edges.values())  # else ids are the texts behind them until rows are distinct
    for name, rows in extracted.items():
        entry = schema.vertices[name]
        wanted = [c for c in rows.columns if c not in VERTEX]
        sources = build(rows, entry, tuple(wanted), hashed)
        vertices.append(sources.withColumn("is_stub", F.lit(False)).select(*VERTEX))
        if any(p.sensitive for p in entry.properties):
            hidden.append(secrets(rows, entry))
        for rule in entry.rules:
            own = sources.select("internal_id", "props", "object_type", *wanted)
            new, linked = follow(own, entry, rule, schema, (known or {}).get(rule.target_type), (children or {}).get(rule.name), hashed)
            vertices.append(new.select(*VERTEX))
            edges.append((schema.edges[rule.edge_label].label, rule.inbound, linked))
    id_of = lambda c: F.col(c) if hashed else F.md5(c)
    merit = F.when(F.col("is_complete"), 1 << 40).otherwise(0) + F.when(F.col("is_stub"), 0).otherwise(1 << 39) + F.size("props")
    rest = [c for c in VERTEX if c != "internal_id"]  # each by itself, so those that nobody reads aren't shuffled; rows of one merit are met in one order by all
    best = union(vertices).where("internal_id is not null").withColumn("_merit", merit).groupBy("internal_id").agg(*(F.max_by(c, "_merit").alias(c) for c in rest))
    best = best.withColumn("internal_id", id_of("internal_id")).select(*VERTEX)
    stubs = union([rows for _, _, rows in edges]).where("internal_id is null").dropDuplicates(["edge_label", "src_id", "dst_id", "inbound"]) if edges else None
    if stubs is not None:
        stubs = stubs.withColumns({c: id_of(c) for c in ("src_id", "dst_id")})
    return Graph(best, distinct_edges(edges, schema, hashed) if edges else None, union(hidden) if hidden else None, stubs)


def assimilated(graph: Graph) -> DataFrame:
    """(internal_id, object_type, edge_label, edge_id, other_id): each new vertex with the edges that leave it."""
    edges = graph.edges.select(F.col("src_id").alias("internal_id"), "edge_label", F.col("internal_id").alias("edge_id"), F.col("dst_id").alias("other_id"))
    return graph.vertices.select("internal_id", "object_type").join(edges, "internal_id")


def upsert(new: Graph, stored_vertices: DataFrame, stored_edges: DataFrame) -> Graph:
    """What the graph doesn't hold yet: the first write of an id stays."""
    return Graph(first_wins(new.vertices, stored_vertices, "internal_id"), first_wins(new.edges, stored_edges, "internal_id"), new.secrets)
