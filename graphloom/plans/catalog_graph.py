"""Queries of graphs, rules, workflows and shapes, each with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import ids
from graphloom.operators import changes, history, links, reading, rules, shaping, vertices
from graphloom.plans import change_log
from graphloom.plans.catalog import EDGES_SQL, KEY, ORDERS, SMALL_SQL, literal_id, order_graph, query, small_edges, t, thing
from graphloom.plans.graph_etl import assimilate, assimilated, union
from graphloom.registry import edge_properties, merged
from graphloom.schema import EdgeEntry, EdgeProperty, Property, Rule, Schema, SchemaError, VertexEntry, newer

STUBS = Schema({"Order": thing("Order", Rule("Customer", "_placed_by_", "shared", shared=("id_source",), constants=(("id_type", "Customer"),), if_absent="stub")), "Customer": thing("Customer")}, {"_placed_by_": EdgeEntry("_placed_by_", ("Order",), ("Customer",))})


def stub_graph(spark: SparkSession, d: str):
    """Orders whose customers are known by source and type only, so they are stubs without an id."""
    rows = t(spark, d, "orders").select(F.lit("TPC").alias("id_source"), F.lit("Order").alias("id_type"), F.col("o_orderkey").alias("id_value"))
    return assimilate({"Order": rows}, STUBS)


@query(f"SELECT '_placed_by_' AS edge_label, {KEY.format('Order', 'o_orderkey')} AS src_id, true AS no_id, true AS no_target FROM orders WHERE o_orderkey <> 0 UNION ALL SELECT '_placed_by_', NULL, true, true FROM orders WHERE o_orderkey = 0")
def stub_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges to stubs have neither an id nor a target."""
    return stub_graph(spark, d).stub_edges.select("edge_label", "src_id", F.col("internal_id").isNull().alias("no_id"), F.col("dst_id").isNull().alias("no_target"))


@query("SELECT 'Customer' AS object_type, '#vertex#Customer#{\"id_source\": \"TPC\", \"id_type\": \"Customer\"}#' AS identifier_stem, true AS is_stub, '{\"id_source\":\"TPC\",\"id_type\":\"Customer\"}' AS sort_id")
def stub_index(spark: SparkSession, d: str) -> DataFrame:
    """Stubs once each, ordered by their id or, without one, the JSON of their properties."""
    rows = t(spark, d, "orders").select(F.lit("TPC").alias("id_source"), F.lit("Order").alias("id_type"), F.col("o_orderkey").alias("id_value"))
    entry = STUBS.vertices["Order"]
    sources = vertices.build(rows, entry, ("id_source",)).select("internal_id", "props", "object_type", "id_source")
    new, _ = rules.follow(sources, entry, entry.rules[0], STUBS)
    stubs = new.where("is_stub").withColumn("sort_id", ids.stub_sort_id(F.col("id_value"), F.col("props")))
    return stubs.dropDuplicates(["identifier_stem", "sort_id"]).select("object_type", "identifier_stem", "is_stub", "sort_id")


@query(f"""
    WITH edges AS ({EDGES_SQL})
    SELECT src_id AS internal_id, 'Order' AS object_type, edge_label, internal_id AS edge_id, dst_id AS other_id FROM edges
""")
def assimilation_results(spark: SparkSession, d: str) -> DataFrame:
    """New vertices with all edges that leave them, of either label, and their ends."""
    return assimilated(order_graph(spark, d))


@edge_properties("catalog_direction")
def direction(inbound: bool) -> Column:
    return F.lit("inbound" if inbound else "outbound")


TARGETS = Schema(
    {"Change": thing("Change", Rule("ExternalId", "_changed_", "function", "derive_change_targeted", constants=(("id_source", "TPC"),), if_absent="create")), "ExternalId": thing("ExternalId")},
    {"_changed_": EdgeEntry("_changed_", ("Change",), ("*",), (EdgeProperty("id_type", "String", "target_vertex"), EdgeProperty("change", "String", "source_vertex", "id_value"), EdgeProperty("client", "String", "extraction", "client_id"), EdgeProperty("direction", "String", "function", "catalog_direction")))},
)


@query(f"""
    SELECT md5('TPC' || 'Clients' || CAST(user_id AS VARCHAR)) AS dst_id, {KEY.format('Change', 'event_id')} AS src_id, 'Clients' AS id_type, CAST(event_id AS VARCHAR) AS change, CAST(user_id AS VARCHAR) AS client, 'outbound' AS direction FROM events WHERE user_id <> 0 AND event_id <> 0
    UNION ALL SELECT md5('TPC' || 'Employees' || CAST(1000 + user_id % 9 AS VARCHAR)), {KEY.format('Change', 'event_id')}, 'Employees', CAST(event_id AS VARCHAR), CAST(user_id AS VARCHAR), 'outbound' FROM events WHERE event_id <> 0
""")
def change_target_edges(spark: SparkSession, d: str) -> DataFrame:
    """Targets by the registered specifier, properties of source, target, extraction and a function; any target type is allowed."""
    target = F.struct(F.col("user_id").cast("string").alias("client_id"), F.lit("").alias("clientvisit_id"), (1000 + F.col("user_id") % 9).cast("string").alias("emp_id"))
    rows = t(spark, d, "events").select(F.lit("TPC").alias("id_source"), F.lit("Change").alias("id_type"), F.col("event_id").alias("id_value"), F.array(target).alias("changed_target"))
    edges = assimilate({"Change": rows}, TARGETS).edges.where("src_id is not null")
    return edges.select("dst_id", "src_id", *(F.col("props")[n].alias(n) for n in ("id_type", "change", "client", "direction")))


@query("SELECT l_orderkey AS id, '_contains_' AS edge_label, true AS inbound FROM lineitem WHERE l_orderkey <> 0 AND l_partkey <> 0 GROUP BY l_orderkey, l_partkey")
def inbound_edges(spark: SparkSession, d: str) -> DataFrame:
    """an inbound edge accepts its types from the other side."""
    rows = t(spark, d, "lineitem").where("l_orderkey <> 0 and l_partkey <> 0").select("l_orderkey", "l_partkey").distinct()
    empty = F.create_map().cast("map<string,string>")
    linked = rows.select(F.col("l_partkey").cast("string").alias("source_id"), F.lit("Part").alias("source_type"), empty.alias("source_props"), F.col("l_orderkey").cast("string").alias("target_id"), F.lit("Order").alias("target_type"), empty.alias("target_props"))
    return rules.edges(linked, ORDERS.edges["_contains_"], inbound=True).select(F.col("src_id").cast("bigint").alias("id"), "edge_label", "inbound")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id_value, n_name AS name, 2 AS versions, true AS checked FROM nation WHERE n_nationkey <> 0")
def schema_from_json(spark: SparkSession, d: str) -> DataFrame:
    """A schema read from its file, a new version only if it differs, ids of edges checked."""
    text = '{"vertices": [{"name": "Nation", "properties": [{"name": "n_nationkey", "kind": "Number", "is_id": true}, {"name": "n_name"}], "id_key": ["object_type", "n_nationkey"], "stem_key": ["n_name"]}], "edges": []}'
    versions = newer(newer(newer([], "{}"), text), text)
    try:
        EdgeEntry("_x_", id_key=("to.internal_id", "schema.edge_label", "from.internal_id"))
        checked = False
    except SchemaError:
        checked = True
    schema = Schema.from_json(versions[-1][1])
    found = vertices.build(t(spark, d, "nation"), schema.vertices["Nation"]).where("is_complete")
    return found.select(F.col("props")["n_nationkey"].alias("id_value"), F.col("props")["n_name"].alias("name"), F.lit(len(versions)).alias("versions"), F.lit(checked).alias("checked"))


@query(f"SELECT internal_id FROM ({SMALL_SQL}) WHERE dst_id <> 'n3' AND src_id <> 'n3'")
def dropped_vertices(spark: SparkSession, d: str) -> DataFrame:
    """What a selection drops takes its edges along."""
    edges = small_edges(spark, d)
    nodes = edges.select(F.col("src_id").alias("internal_id")).distinct()
    return reading.without(nodes, edges, nodes.where("internal_id = 'n3'"))[1].select("internal_id")


EXTERNAL = VertexEntry("ExternalId", (Property("id_source"), Property("id_type"), Property("id_name"), Property("id_value", "Number", is_id=True)), ("id_source", "id_type", "id_value"), ("id_source", "id_type"))
CHANGE, ENTRY = (VertexEntry(n, EXTERNAL.properties, EXTERNAL.id_key, EXTERNAL.stem_key) for n in ("Change", "ChangeLogEntry"))


@query("""
    SELECT * FROM (VALUES ('getVertex', 1), ('findExternalId', 24), ('getExternalId', 1), ('listExternalIds', 24), ('getExternalIds', 6), ('getExternalIdValues', 24), ('pageExternalIdValues', 5), ('pageExternalIds', 5), ('pageChangeLogEntries', 5), ('pageChangeDetails', 5), ('chunkExternalIds', 6), ('singleTypeExternalIds', 24),
        ('GenericEdge.internal_id', 1), ('GenericEdge.label', 1), ('GenericEdge.in_vertex', 1), ('GenericEdge.out_vertex', 1), ('ExternalId.internal_id', 1), ('ExternalId.id_source', 1), ('ExternalId.id_type', 1), ('ExternalId.id_name', 1), ('ExternalId.id_value', 1), ('getExtIdMaxMin', 1), ('getChangeLogMaxMin', 1), ('addExternalId', 73), ('postExternalId', 73), ('postChangeLogEntry', 73)) v(read, rows)
    UNION ALL SELECT 'outbound_edges', 1 UNION ALL SELECT 'inbound_edges', 1
""")
def every_named_read(spark: SparkSession, d: str) -> DataFrame:
    """Each read and add of the catalogue by its name, with how many rows it finds among the nations."""
    kind = lambda name: t(spark, d, "nation").select(F.lit("TPC").alias("id_source"), F.lit(name).alias("id_type"), F.lit("n_nationkey").alias("id_name"), F.col("n_nationkey").alias("id_value"))
    v = union([vertices.build(kind(e.name), e) for e in (EXTERNAL, CHANGE, ENTRY)]).where("id_value is not null")
    key = lambda name, k: F.md5(F.lit(f"TPC{name}{k}"))
    one = v.where(F.col("internal_id") == key("ExternalId", 3)).first()["internal_id"]
    edge = v.where("object_type = 'ExternalId'").select(F.col("internal_id").alias("src_id"), F.md5(F.concat(F.lit("TPCChange"), F.col("id_value").cast("bigint").cast("string"))).alias("dst_id"), F.lit("_is_").alias("edge_label"))
    e = edge.withColumn("internal_id", ids.edge_id(F.col("src_id"), F.col("edge_label"), F.col("dst_id")))
    edge_id, other = e.where(F.col("src_id") == one).select("internal_id", "dst_id").first()
    new = vertices.build(kind("Other").where("id_value = 3"), EXTERNAL)
    by_id = dict.fromkeys(("getVertex", "getExternalId", "ExternalId.internal_id", "ExternalId.id_source", "ExternalId.id_type", "ExternalId.id_name", "ExternalId.id_value", "outbound_edges"), {"internal_id": one})
    given = {**by_id, "inbound_edges": {"internal_id": other}, **dict.fromkeys(("getExternalIds", "chunkExternalIds"), {"low": 5, "high": 10}), **dict.fromkeys(("pageExternalIdValues", "pageExternalIds", "pageChangeLogEntries", "pageChangeDetails"), {"start": 5, "end": 10}), "singleTypeExternalIds": {"id_type": "ExternalId"}, **dict.fromkeys((n for n in reading.NAMED if n.startswith("GenericEdge")), {"edge_id": edge_id}), **dict.fromkeys(("addExternalId", "postExternalId", "postChangeLogEntry"), {"new": new})}
    return union([read(v, e, **given.get(name, {})).agg(F.count("*").cast("int").alias("rows")).select(F.lit(name).alias("read"), "rows") for name, read in reading.NAMED.items()])


@query(f"SELECT internal_id, 2 AS start, 12 AS end_ FROM ({SMALL_SQL}) WHERE src_id = 'n3' OR dst_id = 'n3' ORDER BY internal_id LIMIT 10 OFFSET 2".replace("end_", '"end"'))
def page_by_token(spark: SparkSession, d: str) -> DataFrame:
    """The page that a sealed token's successor asks for; a page's size is the feature."""
    token = reading.seal({"id": "n3", "start": -8, "end": 2}, "secret")
    place = reading.next_token(reading.unseal(token, "secret"))
    found = reading.edge_page(small_edges(spark, d), place["id"], place["start"], place["end"] - place["start"])
    return found.select("internal_id", F.lit(place["start"]).alias("start"), F.lit(place["end"]).alias("end"))


@query(f"SELECT kind, object FROM (SELECT 'n' AS kind, '{{\"src_id\":\"' || src_id || '\",\"dst_id\":\"' || dst_id || '\",\"note\":null}}' AS object FROM ({SMALL_SQL}) WHERE edge_label = '_in_')")
def shaped_objects(spark: SparkSession, d: str) -> DataFrame:
    """Rows as objects of a query interface, nulls kept."""
    rows = small_edges(spark, d).where("edge_label = '_in_'").withColumn("note", F.lit(None).cast("string"))
    return shaping.shaped(rows, "src_id", "dst_id", "note").select(F.lit("n").alias("kind"), "object")


@query("SELECT c_custkey AS id, nullif(CASE WHEN c_custkey % 2 = 0 THEN '' ELSE c_name END, '') AS name, CAST(86400.5 + c_custkey AS DOUBLE) AS seen, c_mktsegment AS segment, 'TPC' AS source, CAST(c_custkey AS VARCHAR) AS sid_value FROM customer WHERE c_custkey <> 0")
def index_entries(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned properties, times as epoch seconds, the stem's pairs under the schema's, flattened for an index."""
    k = F.col("c_custkey")
    rows = t(spark, d, "customer").where("c_custkey <> 0").select("c_custkey", F.timestamp_micros((k + 86400) * 1_000_000 + 500_000).alias("seen"), F.create_map(F.lit("name"), F.when(k % 2 == 0, "").otherwise(F.col("c_name")), F.lit("segment"), F.col("c_mktsegment")).alias("props"))
    profile = shaping.extraction_profile(F.create_map(F.lit("source"), F.lit("TPC"), F.lit("segment"), F.lit("old")), shaping.clean_properties(F.col("props")))
    flat = shaping.epoch_properties(rows, ("seen",)).select("c_custkey", "seen", profile.alias("props"), F.lit("stem").alias("identifier_stem"), F.md5(k.cast("string")).alias("internal_id"), F.lit("Client").alias("object_type"), k.alias("id_value"))
    found = shaping.index_rows(flat, ("name", "segment", "source")).join(flat.select("internal_id", "seen"), "internal_id")
    return found.select(F.col("id_value").alias("id"), "name", "seen", "segment", "source", "sid_value")


@query("SELECT o_custkey, CAST(count(DISTINCT o_orderstatus) AS INTEGER) AS rules, max(o_orderkey) FILTER (WHERE o_orderstatus = 'F') AS finished FROM orders GROUP BY 1")
def potentials_by_rule(spark: SparkSession, d: str) -> DataFrame:
    """Per vertex a map of what each rule may link."""
    made = shaping.potentials(t(spark, d, "orders"), "o_custkey", "o_orderstatus", "o_orderkey")
    return made.select("o_custkey", F.size("potentials").alias("rules"), F.col("potentials")["F"].alias("finished"))


@query("SELECT event_id, CASE event_type WHEN 'signup' THEN 1 WHEN 'view' THEN 2 WHEN 'click' THEN 3 WHEN 'purchase' THEN 4 ELSE 5 END AS action_id, CASE WHEN event_type IN ('signup', 'view') THEN 'A' ELSE 'B' END AS category FROM events")
def categorized_changes(spark: SparkSession, d: str) -> DataFrame:
    """Actions looked up in the change types; an unknown one would be an error."""
    kinds = spark.createDataFrame([("signup", 1, "A"), ("view", 2, "A"), ("click", 3, "B"), ("purchase", 4, "B"), ("error", 5, "B")], "action string, action_id bigint, category string")
    return changes.with_category(t(spark, d, "events").select("event_id", F.col("event_type").alias("action")), kinds).select("event_id", F.col("action_id").cast("int").alias("action_id"), "category")


@query("SELECT 'employee' AS how, n_nationkey AS id FROM nation WHERE n_regionkey IN (1, 2) UNION ALL SELECT DISTINCT 'all', n_regionkey + 100 FROM nation WHERE n_regionkey IN (1, 2) UNION ALL SELECT 'all', n_nationkey FROM nation WHERE n_regionkey IN (1, 2)")
def recipients(spark: SparkSession, d: str) -> DataFrame:
    """people of a list, with and without all above them."""
    people = t(spark, d, "nation").select(F.col("n_nationkey").cast("bigint").alias("emp_id"), F.col("n_regionkey").cast("string").alias("team"))
    above = reading.closure(people.select((F.col("team").cast("bigint") + 100).alias("parent"), F.col("emp_id").alias("child")))
    own = shaping.recipients(people, "team", ["1", "2"]).select(F.lit("employee").alias("how"), F.col("emp_id").alias("id"))
    return own.unionByName(shaping.recipients(people, "team", ["1", "2"], above).select(F.lit("all").alias("how"), F.col("emp_id").alias("id")))


@query("SELECT '#' || n_regionkey AS identifier_stem, max(n_nationkey) AS max_id, false AS is_empty FROM nation GROUP BY 1 UNION ALL SELECT '#none', -1, true")
def max_indexed_ids(spark: SparkSession, d: str) -> DataFrame:
    """The largest id under each stem; an empty index has the fallback."""
    rows = t(spark, d, "nation").select(F.concat(F.lit("#"), F.col("n_regionkey").cast("string")).alias("identifier_stem"), F.col("n_nationkey").cast("bigint").alias("id_value"))
    asked = rows.select("identifier_stem").unionByName(spark.createDataFrame([("#none",)], "identifier_stem string"))
    return links.max_indexed(rows, asked, fallback=-1)


@query("SELECT o_orderkey, o_custkey FROM orders")
def single_values(spark: SparkSession, d: str) -> DataFrame:
    """The one distinct value of each key; two would be an error."""
    rows = t(spark, d, "orders").select("o_orderkey", "o_custkey").join(t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left")
    return shaping.one_of_each(rows, "o_orderkey", "o_custkey")


@query("SELECT user_id, arg_max(event_type, event_id) AS last, CAST(count(*) AS INTEGER) AS items FROM events GROUP BY 1")
def merged_enrichments(spark: SparkSession, d: str) -> DataFrame:
    """Enrichments merged by key: lists are joined, later values replace earlier ones."""
    halves = [t(spark, d, "events").where(f"event_id % 2 = {k}") for k in (0, 1)]
    rows = union(halves).select("user_id", "event_id", F.col("event_type").alias("last"), F.array("event_id").alias("items"))
    return shaping.merge_enrichments(rows, "user_id", ("last",), ("items",), "event_id").select("user_id", "last", F.size("items").alias("items"))


@query("SELECT n_nationkey, 'right' AS both, 'l' AS own_left, n_name AS own_right, 3 AS members, 'x' AS driver FROM nation")
def deep_merges(spark: SparkSession, d: str) -> DataFrame:
    """Maps of maps merged, as columns and as configurations."""
    left = F.create_map(F.lit("a"), F.create_map(F.lit("both"), F.lit("left"), F.lit("l"), F.lit("l")))
    right = F.create_map(F.lit("a"), F.create_map(F.lit("both"), F.lit("right")), F.lit("b"), F.create_map(F.lit("r"), F.col("n_name")))
    config = merged({"list": [1, 2], "sub": {"driver": "x"}}, {"list": [3], "sub": {"more": 1}})
    m = F.col("m")
    return t(spark, d, "nation").select("n_nationkey", shaping.merged_maps(left, right).alias("m")).select("n_nationkey", m["a"]["both"].alias("both"), m["a"]["l"].alias("own_left"), m["b"]["r"].alias("own_right"), F.lit(len(config["list"])).alias("members"), F.lit(config["sub"]["driver"]).alias("driver"))


@query("SELECT event_type AS argument, CAST(count(DISTINCT user_id) AS INTEGER) AS distinct_values FROM events GROUP BY 1")
def merged_arguments(spark: SparkSession, d: str) -> DataFrame:
    """Arguments of tasks, each with its distinct values."""
    made = shaping.task_arguments(t(spark, d, "events").select(F.col("event_type").alias("argument"), "user_id"), "argument", "user_id")
    return made.select("argument", F.size("values").alias("distinct_values"))


@query("SELECT event_id, md5('TPC' || 'events' || event_id) AS internal_id, '#TPC#' || event_type || '#' || user_id || '#' || (user_id % 3) || '#' AS stem, epoch(date_trunc('second', ts))::BIGINT || CASE WHEN event_type = 'error' THEN '!unlink' ELSE '!link' END AS entry, event_type = 'error' AS unlinks, CAST(floor(ln(user_id + 8) / ln(8) + 1e-12) AS BIGINT) AS level FROM events")
def ids_and_entries(spark: SparkSession, d: str) -> DataFrame:
    """md5 ids, stems of changes, levels of branches, link entries written and read."""
    e = t(spark, d, "events")
    text = lambda c: F.col(c).cast("string")
    entry = ids.link_entry(F.col("ts"), F.col("event_type") == "error")
    return e.select(
        "event_id",
        ids.internal_id(F.lit("TPC"), F.lit("events"), F.col("event_id")).alias("internal_id"),
        ids.change_stem(F.lit("TPC"), F.col("event_type"), text("user_id"), (F.col("user_id") % 3).cast("string")).alias("stem"),
        entry.alias("entry"),
        ids.parse_link_entry(entry)["is_unlink"].alias("unlinks"),
        shaping.branch_level(F.col("user_id") + 8, F.lit(8)).alias("level"),
    )


@query("SELECT 'IdSource' AS kind, md5('IdSource' || '3') AS internal_id UNION ALL SELECT 'IdSource', md5('IdSource' || n) FROM (VALUES ('0'), ('1'), ('2'), ('4')) v(n)")
def source_vertices(spark: SparkSession, d: str) -> DataFrame:
    """A vertex per source of links."""
    rows = t(spark, d, "events").select((F.col("user_id") % 5).cast("string").alias("source"), F.col("user_id").alias("id_value"), "ts", (F.col("event_type") == "error").alias("is_unlink"))
    return links.source_graph(rows, "id_value", "source")[0].select(F.lit("IdSource").alias("kind"), "internal_id")


EVENTS_SQL = """
    e AS (SELECT user_id AS operation_id, user_id % 6 AS g, event_id % 5 AS started_id, ts, event_id, CASE event_type WHEN 'view' THEN 'pending' WHEN 'click' THEN 'live' WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'completed' END AS state FROM events),
    a AS (SELECT operation_id, g, started_id, arg_max(state, (ts, event_id)) AS state FROM e WHERE state IS NOT NULL GROUP BY 1, 2, 3),
    o AS (SELECT operation_id, g, count(*) FILTER (WHERE state = 'failed') AS fail_count, bool_or(state = 'live') AS is_live, bool_or(state = 'completed') AS is_complete FROM a GROUP BY 1, 2),
    s AS (SELECT *, CASE WHEN is_complete THEN 'complete' WHEN is_live THEN 'live' WHEN fail_count > 0 THEN 'failed' ELSE 'pending' END AS status FROM o)
"""
#: Event names of each kind of operation, for the six kinds by turns.
NAMES = {"view": "ActivityTaskScheduled", "click": ("ActivityTaskStarted", "LambdaFunctionStarted", "ChildWorkflowExecutionStarted"), "error": ("ActivityTaskTimedOut", "LambdaFunctionFailed", "ChildWorkflowExecutionTerminated"), "purchase": ("ActivityTaskCompleted", "LambdaFunctionCompleted", "ChildWorkflowExecutionCompleted")}


def folded(spark: SparkSession, d: str) -> DataFrame:
    """Operations of a history that is polled in two pages which overlap; activities, functions and subtasks by turns."""
    pick = F.lit(None).cast("string")
    for kind, names in NAMES.items():
        name = F.lit(names) if isinstance(names, str) else F.get(F.array(*map(F.lit, names)), (F.col("user_id") % 3).cast("int"))
        pick = F.when(F.col("event_type") == kind, name).otherwise(pick)
    rows = t(spark, d, "events").select(F.col("user_id").alias("operation_id"), (F.col("event_id") % 5).alias("started_id"), "ts", "event_id", history.state_of(pick).alias("state"))
    pages = [rows.where("event_id % 10 < 7"), rows.where("event_id % 10 > 4")]
    return history.operations(history.attempts(shaping.merge_histories(pages, "event_id", "event_id")))


@query(f"WITH {EVENTS_SQL} SELECT g, bool_or(status <> 'pending') AS started, bool_and(status = 'complete') AS complete, bool_or(status = 'failed') AS failed, CAST(sum(fail_count) AS BIGINT) AS fail_count, count(*) FILTER (WHERE is_live) AS live, count(*) AS operations FROM s GROUP BY 1")
def group_states(spark: SparkSession, d: str) -> DataFrame:
    """Groups that run in parallel and their concurrency, over a history of several pages and kinds of operations."""
    ops = folded(spark, d).withColumn("g", F.col("operation_id") % 6)
    return history.group_state(ops, "g").join(history.concurrency(ops, "g"), "g")


@query(f"WITH {EVENTS_SQL}, c AS (SELECT operation_id, arg_max('r' || event_id, (ts, event_id)) AS checkpoint FROM e WHERE operation_id % 4 = 1 AND ts >= TIMESTAMP '2024-01-10' - INTERVAL 2 DAY GROUP BY 1) SELECT coalesce(s.operation_id, c.operation_id) AS operation_id, CASE WHEN checkpoint IS NOT NULL THEN 'complete' ELSE status END AS status, checkpoint FROM s FULL JOIN c ON c.operation_id = s.operation_id")
def checkpointed_operations(spark: SparkSession, d: str) -> DataFrame:
    """Checkpoints of the last two days come before what events say; the later one wins."""
    saved = t(spark, d, "events").where("user_id % 4 = 1").select(F.col("user_id").alias("operation_id"), F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("result"), "ts", F.col("event_id").alias("seq"))
    latest = history.reused(saved.withColumn("ts", F.col("ts").cast("timestamp")), "2024-01-10", 2)
    return history.with_checkpoints(folded(spark, d), latest).select("operation_id", "status", "checkpoint")


@query(f"WITH {EVENTS_SQL} SELECT operation_id FROM s WHERE status = 'complete' AND operation_id % 3 = 0")
def finished_markers(spark: SparkSession, d: str) -> DataFrame:
    """Workers marked as open whose subtask is complete."""
    markers = t(spark, d, "events").select(F.col("user_id").alias("operation_id"), (F.col("user_id") % 3 == 0).alias("is_open")).distinct()
    return history.open_markers(markers, folded(spark, d)).select("operation_id")


@query("SELECT event_id, CASE event_type WHEN 'signup' THEN 'extract' WHEN 'view' THEN 'extract' WHEN 'click' THEN 'transform' WHEN 'purchase' THEN 'assimilate' END AS repair FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 30 MINUTE AND event_type <> 'error'")
def stalled_items(spark: SparkSession, d: str) -> DataFrame:
    """Items not seen for half an hour and not yet graphing, with the stage that repairs them."""
    stage = F.create_map(*map(F.lit, ("signup", "monitoring", "view", "extraction", "click", "transformation", "purchase", "assimilation", "error", "graphing")))[F.col("event_type")]
    rows = t(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("last_time_seen"), stage.alias("stage"))
    return history.stalled(rows, "2024-01-15 12:00:00").select("event_id", "repair")


@query("SELECT 'f' || n_nationkey AS descendant, 'f' || (n_nationkey - 1) AS ancestor, 1 AS depth FROM nation WHERE n_nationkey % 5 <> 0 UNION ALL SELECT 'f' || (n_nationkey - n_nationkey % 5 + j), 'f' || (n_nationkey - n_nationkey % 5 + i), CAST(j - i AS INTEGER) FROM nation, range(5) a(i), range(5) b(j) WHERE n_nationkey % 5 = 0 AND j - i > 1")
def run_trees(spark: SparkSession, d: str) -> DataFrame:
    """Workflow runs attached to all above them, chains of five."""
    n = F.col("n_nationkey")
    name = lambda c: F.concat(F.lit("f"), c.cast("string"))
    flows = t(spark, d, "nation").select(name(n).alias("run_id"), F.when(n % 5 != 0, name(n - 1)).alias("parent_id"))
    return reading.closure(history.tree(flows)).select("descendant", "ancestor", "depth")


@query("SELECT 'Clients' AS id_type, user_id AS id_value, count(*) AS changes FROM events WHERE user_id % 3 = 0 AND user_id > 0 AND event_type IN ('signup', 'click') GROUP BY user_id")
def grown_change_log(spark: SparkSession, d: str) -> DataFrame:
    """Ids reconciled, propagated over categories, their changes read, named, enriched and split into targets."""
    e = t(spark, d, "events").where("user_id > 0")
    remote = e.where("user_id % 3 = 0").select(F.col("user_id").alias("id_value")).distinct()
    known = e.select(F.col("user_id").alias("id_value"), F.lit(False).alias("is_linked")).distinct()
    kinds = spark.createDataFrame([("signup", 1, "A"), ("view", 2, "C"), ("click", 3, "B"), ("purchase", 4, "C"), ("error", 5, "C")], "action string, action_id bigint, category string")
    moment = F.col("event_id").cast("string")
    log = e.select(F.col("user_id").alias("id_value"), moment.alias("UTC Date"), F.col("event_type").alias("Action"), F.concat(F.lit("Client ("), F.col("user_id").cast("string"), F.lit(")")).alias("Client"))
    mapping = {"UTC Date": {"name": "change_date_utc"}, "Action": {"name": "action"}, "Client": {"name": "client_id", "mutation": "get_client_id"}}
    by_emp = e.select(moment.alias("change_date_utc"), (F.col("user_id") % 9).alias("emp_id"))
    detail_ids = e.select(moment.alias("change_date_utc"), F.col("event_id").alias("changelog_id"))
    details = e.select(F.col("event_id").alias("changelog_id"), F.lit("").alias("record_id"), F.lit("").alias("record_type"), F.lit("").alias("clientvisit_id"))
    grown = change_log.grow(remote, known, spark.createDataFrame([("A",), ("B",)], "category string"), log, by_emp, detail_ids, details, kinds, mapping, "2024-02-01")
    return grown.targets.groupBy("id_type", "id_value").agg(F.count("*").alias("changes"))


@query("SELECT ' Id' AS header, o_orderkey AS id FROM orders")
def odd_headers(spark: SparkSession, d: str) -> DataFrame:
    """A column whose header begins with a blank."""
    rows = t(spark, d, "orders").select(F.col("o_orderkey").alias(" Id"))
    return changes.mapped(rows, {" Id": {"name": "id"}}).select(F.lit(" Id").alias("header"), "id")


@query("SELECT o_orderstatus AS id_type, count(*) AS vertices FROM orders WHERE o_orderkey <> 0 GROUP BY 1")
def staged_vertices(spark: SparkSession, d: str) -> DataFrame:
    """Monitor, extract, transform, assimilate and load as stages of one plan over new ids only."""
    o = t(spark, d, "orders")
    outcomes = links.reconcile(o.select(F.col("o_orderkey").alias("id_value")), o.where("false").select(F.col("o_orderkey").alias("id_value"), F.lit(True).alias("is_linked")))
    extracted = o.select(F.lit("TPC").alias("id_source"), F.col("o_orderstatus").alias("id_type"), F.col("o_orderkey").alias("id_value")).join(outcomes.where("outcome = 'new'").select("id_value"), "id_value", "left_semi")
    schema = Schema({"Order": thing("Order", Rule("Customer", "_of_", "shared", shared=("id_source",), constants=literal_id("Customer"), if_absent="pass")), "Customer": thing("Customer")}, {"_of_": EdgeEntry("_of_")})
    graph = assimilate({"Order": extracted}, schema)
    return graph.vertices.where("object_type = 'Order'").groupBy(F.col("props")["id_type"].alias("id_type")).agg(F.count("*").alias("vertices"))
