"""Graph reads: lookups, pages, neighbours, counts, hierarchy closure and the named queries."""

from __future__ import annotations

import base64
import hashlib
import hmac
import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.operators.ordering import ordered, written


def equal_to(properties: dict[str, object]) -> Column:
    """All given properties; those given as None are not asked for."""
    on = F.lit(True)
    for name, value in properties.items():
        if value is not None:
            on = on & (F.col("props")[name] == F.lit(str(value)))
    return on


def find(vertices: DataFrame, object_type: str | None = None, internal_id: str | None = None, **properties: object) -> DataFrame:
    rows = vertices if object_type is None else vertices.where(F.col("object_type") == object_type)
    return (rows if internal_id is None else rows.where(F.col("internal_id") == internal_id)).where(equal_to(properties))


def properties(vertices: DataFrame, names: list[str] | None = None) -> DataFrame:
    kept = F.col("props") if names is None else F.map_filter("props", lambda k, _: k.isin(*names))
    return vertices.select("internal_id", "object_type", F.explode(kept).alias("name", "value"))


def page(rows: DataFrame, start: int, size: int, *order: str) -> DataFrame:
    """Rows [start, start + size) of a total order. For deep paging of large tables use after() instead."""
    return rows.orderBy(*order).offset(start).limit(size)


def after(rows: DataFrame, last: str | None, size: int, key: str = "internal_id") -> DataFrame:
    """The next page by key: a filter and a top-k, however deep."""
    return (rows if last is None else rows.where(F.col(key) > last)).orderBy(key).limit(size)


def edge_page(edges: DataFrame, internal_id: str, start: int = 0, size: int = 10, labels: list[str] | None = None) -> DataFrame:
    """A vertex's edges with direction and `more`: one row beyond the page is asked for. Edges that end here are inbound."""
    mine = edges.where((F.col("src_id") == internal_id) | (F.col("dst_id") == internal_id))
    if labels:
        mine = mine.where(F.col("edge_label").isin(*labels))
    direction = F.when(F.col("dst_id") == internal_id, "inbound").otherwise("outbound")
    found = mine.withColumn("direction", direction).orderBy("internal_id").offset(start).limit(size + 1)
    return found.withColumn("more", F.expr("count(*) over ()") > size).orderBy("internal_id").limit(size)


def seal(token: dict, secret: str) -> str:
    body = json.dumps(token, sort_keys=True).encode()
    return base64.urlsafe_b64encode(hmac.new(secret.encode(), body, hashlib.sha256).digest() + body).decode()


def unseal(text: str, secret: str) -> dict:
    raw = base64.urlsafe_b64decode(text.encode())
    if not hmac.compare_digest(raw[:32], hmac.new(secret.encode(), raw[32:], hashlib.sha256).digest()):
        raise ValueError("this page token was not made here")
    return json.loads(raw[32:])


def next_token(token: dict) -> dict:
    """The following page of a token (username, source, context, start, end, id)."""
    size = token["end"] - token["start"]
    return {**token, "start": token["end"], "end": token["end"] + size}


def neighbours(edges: DataFrame, vertices: DataFrame, direction: str) -> DataFrame:
    """vertices (internal_id) with the edges that leave ("out") or reach ("in") them, or both, and the other end."""
    parts = {"out": ("src_id", "dst_id"), "in": ("dst_id", "src_id")}
    chosen = parts.values() if direction == "both" else [parts[direction]]
    rows = None
    for near, far in chosen:
        part = edges.select(F.col(near).alias("internal_id"), F.col(far).alias("other_id"), "edge_label", F.col("internal_id").alias("edge_id"))
        rows = part if rows is None else rows.unionByName(part)
    return vertices.select("internal_id").distinct().join(rows, "internal_id")


def edge_counts(edges: DataFrame) -> DataFrame:
    """(internal_id, outbound, inbound, edges) of every vertex with edges: one aggregation over both ends."""
    ends = edges.select(F.col("src_id").alias("internal_id"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("dst_id").alias("internal_id"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return ends.groupBy("internal_id").agg(F.sum("o").alias("outbound"), F.sum("i").alias("inbound"), F.count("*").alias("edges"))


def closure(pairs: DataFrame, parent: str = "parent", child: str = "child") -> DataFrame:
    """(ancestor, descendant, depth), the shortest depth each, in as many rounds as the largest depth has binary digits; cycles end.

    After a round all pairs up to depth n are known. A longer shortest way of at most 2n begins with one of exactly n steps, so only the pairs of that depth
    are joined with the known ones, and what is known already is left out. Each round's new pairs are written.
    """
    base = pairs.select(F.col(parent).alias("ancestor"), F.col(child).alias("descendant")).where("ancestor is not null and descendant is not null").distinct()
    known = written(base.withColumn("depth", F.lit(1)), "closure")
    reach = 1
    while True:
        half = known.where(F.col("depth") == reach).select("ancestor", F.col("descendant").alias("_middle"), F.col("depth").alias("_half"))
        if half.isEmpty():
            return known
        rest = known.select(F.col("ancestor").alias("_middle"), "descendant", "depth")
        longer = half.join(rest, "_middle").groupBy("ancestor", "descendant").agg(F.min(F.col("_half") + F.col("depth")).alias("depth"))
        known = known.unionByName(written(longer.join(known, ["ancestor", "descendant"], "left_anti"), "closure"))
        reach *= 2


def page_table(rows: DataFrame, size: int, *order: str) -> DataFrame:
    """(page, rows, first_<order>, ...) of rows in an order that tells them apart: the key that each page starts with, and how many rows it has.

    Rows are written in order by ranges, so a row's rank is its place in its range and the counts of the ranges before: no task sorts or holds rows for that, only ranges are
    counted. Any page is then read by its keys, see read_page()."""
    ranked, total = ordered(rows.select(*order), *order)
    whole = F.expr(f"_idx div {size}")
    return ranked.where(F.col("_idx") % size == 0).crossJoin(F.broadcast(total)).select(whole.alias("page"), F.least(F.lit(size), F.col("_total") - F.col("_idx")).alias("rows"), *(F.col(c).alias(f"first_{c}") for c in order))


def read_page(rows: DataFrame, pages: DataFrame, number: int, *order: str) -> DataFrame:
    """The rows of a page of page_table(), in order: those from its first key up to the next page's. Of a single key the bounds reach the scan as filters. No rows beyond the last page."""
    bounds = {r["page"]: tuple(r[f"first_{c}"] for c in order) for r in pages.where(F.col("page").isin(number, number + 1)).collect()}
    if number not in bounds:
        return rows.limit(0)

    def from_key(key: tuple) -> Column:
        whole = F.lit(False)
        for n in reversed(range(len(order))):
            above = F.col(order[n]) > F.lit(key[n])
            whole = above | ((F.col(order[n]) == F.lit(key[n])) & (whole if n < len(order) - 1 else F.lit(True)))
        return whole if len(order) > 1 else F.col(order[0]) >= F.lit(key[0])

    found = rows.where(from_key(bounds[number]))
    if number + 1 in bounds:
        found = found.where(~from_key(bounds[number + 1]) if len(order) > 1 else F.col(order[0]) < F.lit(bounds[number + 1][0]))
    return found.orderBy(*order)


def closure_sql(spark, pairs_view: str, most_depth: int = 20) -> DataFrame:
    """The same as one recursive query, for hierarchies without long cycles. Walks go one step beyond most_depth, and a pair that no shorter walk connects raises, so none is lost. LIMIT ALL: Spark stops recursive queries at a million rows without it."""
    return spark.sql(f"""
        WITH RECURSIVE walk(ancestor, descendant, depth) AS (
            SELECT parent, child, 1 FROM {pairs_view} WHERE parent IS NOT NULL AND child IS NOT NULL
            UNION ALL
            SELECT w.ancestor, p.child, w.depth + 1 FROM walk w JOIN {pairs_view} p ON p.parent = w.descendant WHERE w.depth <= {most_depth})
        SELECT ancestor, descendant, CASE WHEN min(depth) > {most_depth} THEN CAST(raise_error('pairs more than {most_depth} levels apart') AS INT) ELSE min(depth) END AS depth FROM (SELECT * FROM walk LIMIT ALL) GROUP BY ancestor, descendant""")


def without(vertices: DataFrame, edges: DataFrame, selected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vertices, edges) after dropping the selected vertices (internal_id) and every edge that touches one."""
    gone = selected.select("internal_id").distinct()
    ends = [F.col("internal_id").alias("src_id"), F.col("internal_id").alias("dst_id")]
    left = edges.join(gone.select(ends[0]), "src_id", "left_anti").join(gone.select(ends[1]), "dst_id", "left_anti")
    return vertices.join(gone, "internal_id", "left_anti"), left.select(*edges.columns)


def _of_type(kind: str) -> Callable:
    return lambda v, e, **a: find(v, kind, **a)


def _paged(kind: str) -> Callable:
    return lambda v, e, start, end, **a: page(find(v, kind, **a), start, end - start, "id_value", "internal_id")


def _ranged(v: DataFrame, e: DataFrame, low, high, **a) -> DataFrame:
    return find(v, "ExternalId", **a).where(F.col("id_value").between(low, high)).orderBy("id_value", "internal_id")


def _extremes(kind: str) -> Callable:
    return lambda v, e, **a: find(v, kind, **a).agg(F.max("id_value").alias("max"), F.min("id_value").alias("min"))


def _property(name: str) -> Callable:
    return lambda v, e, internal_id: find(v, "ExternalId", internal_id).select(F.col("props")[name].alias(name))


#: Reads by name, each f(vertices, edges, **arguments).
NAMED: dict[str, Callable] = {
    "getVertex": lambda v, e, internal_id: find(v, internal_id=internal_id),
    "findExternalId": _of_type("ExternalId"),
    "getExternalId": lambda v, e, internal_id: find(v, "ExternalId", internal_id),
    "listExternalIds": _of_type("ExternalId"),
    "getExternalIds": _ranged,
    "getExternalIdValues": lambda v, e, **a: find(v, "ExternalId", **a).select("id_value"),
    "pageExternalIdValues": lambda v, e, start, end, **a: _paged("ExternalId")(v, e, start, end, **a).select("id_value"),
    "pageExternalIds": _paged("ExternalId"),
    "pageChangeLogEntries": _paged("ChangeLogEntry"),
    "pageChangeDetails": _paged("Change"),
    "chunkExternalIds": _ranged,
    "singleTypeExternalIds": lambda v, e, id_type: find(v, "ExternalId", id_type=id_type),
    "outbound_edges": lambda v, e, internal_id: e.where(F.col("src_id") == internal_id),
    "inbound_edges": lambda v, e, internal_id: e.where(F.col("dst_id") == internal_id),
    "GenericEdge.internal_id": lambda v, e, edge_id: e.where(F.col("internal_id") == edge_id).select("internal_id"),
    "GenericEdge.label": lambda v, e, edge_id: e.where(F.col("internal_id") == edge_id).select("edge_label"),
    "GenericEdge.in_vertex": lambda v, e, edge_id: v.join(e.where(F.col("internal_id") == edge_id).select(F.col("dst_id").alias("internal_id")), "internal_id", "left_semi"),
    "GenericEdge.out_vertex": lambda v, e, edge_id: v.join(e.where(F.col("internal_id") == edge_id).select(F.col("src_id").alias("internal_id")), "internal_id", "left_semi"),
    "ExternalId.internal_id": lambda v, e, internal_id: find(v, "ExternalId", internal_id).select("internal_id"),
    "ExternalId.id_source": _property("id_source"),
    "ExternalId.id_type": _property("id_type"),
    "ExternalId.id_name": _property("id_name"),
    "ExternalId.id_value": _property("id_value"),
    "getExtIdMaxMin": _extremes("ExternalId"),
    "getChangeLogMaxMin": _extremes("ChangeLogEntry"),
    "addExternalId": lambda v, e, new: v.unionByName(new.join(v, "internal_id", "left_anti").dropDuplicates(["internal_id"])),
}
NAMED["postExternalId"] = NAMED["postChangeLogEntry"] = NAMED["addExternalId"]


def newest(rows: DataFrame, *order: str) -> DataFrame:
    """The newest row: last in an order that tells rows apart."""
    return rows.orderBy(*(F.col(c).desc_nulls_last() for c in order)).limit(1)
