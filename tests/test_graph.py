import hashlib
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphloom.operators import changes, history, links, matching, reading, rules, vertices
from graphloom.plans import catalog, catalog_graph  # noqa: F401
from graphloom.plans.graph_etl import assimilate, upsert
from graphloom.registry import arguments, merged
from graphloom.schema import EdgeEntry, EdgeProperty, Property, Rule, Schema, SchemaError, VertexEntry, newer

CHANGE = VertexEntry("Change", (Property("detail_id", "Number", is_id=True), Property("changelog_id", "Number"), Property("id_source"), Property("detail_one", sensitive=True)), ("id_source", "object_type", "changelog_id", "detail_id"), ("id_source",), (Rule("ExternalId", "_changed_", "function", "derive_change_targeted", constants=(("id_source", "source.id_source"),), if_absent="create"),))
EXTERNAL = VertexEntry("ExternalId", (Property("id_value", "Number", is_id=True), Property("id_source"), Property("id_type"), Property("id_name")), ("id_source", "id_type", "id_value"), ("id_source", "id_type", "id_name"))
SCHEMA = Schema({"Change": CHANGE, "ExternalId": EXTERNAL}, {"_changed_": EdgeEntry("_changed_", properties=(EdgeProperty("change_date_utc", "DateTime", "extraction"),), id_key=("from.internal_id", "schema.edge_label", "to.internal_id", "change_date_utc"))})
TARGET = "struct<change_date_utc:string,client_id:string,clientvisit_id:string,emp_id:string,record_id:string,record_type:string,primarykey_name:string>"


def change_rows(spark):
    return spark.createDataFrame([(1230, 177, "MBI", "old", [("2019", "5", "", "3889", "", "", "")])], f"detail_id long, changelog_id long, id_source string, detail_one string, changed_target array<{TARGET}>")


def test_change_graph(spark):
    graph = assimilate({"Change": change_rows(spark)}, SCHEMA)
    found = {r["internal_id"]: r for r in graph.vertices.collect()}
    assert {"7b4043d1fe270c1ed1f032f8ec31e899", "ff9ccecb77051747a9ff6cc4169de27d"} <= set(found) and len(found) == 3
    assert found["7b4043d1fe270c1ed1f032f8ec31e899"]["props"]["detail_one"] == "e7b0192b71294db66f1ac4e0a9b36bff"
    assert [tuple(r) for r in graph.secrets.collect()] == [("e7b0192b71294db66f1ac4e0a9b36bff", "old")]
    edges = graph.edges.collect()
    assert len(edges) == 2 and {e["src_id"] for e in edges} == {"7b4043d1fe270c1ed1f032f8ec31e899"} and edges[0]["props"] == {"change_date_utc": "2019"}


def test_upsert_keeps_first(spark):
    graph = assimilate({"Change": change_rows(spark)}, SCHEMA)
    again = upsert(graph, graph.vertices, graph.edges)
    assert again.vertices.count() == 0 and again.edges.count() == 0


def test_known_targets_and_policies(spark):
    known = spark.createDataFrame([("x1", 5, "MBI", "Clients", "client_id")], "internal_id string, id_value long, id_source string, id_type string, id_name string")
    potentials = spark.createDataFrame([(1, 5, "MBI", "Clients", []), (2, 9, "MBI", "Clients", []), (3, 5, "MBI", None, ["id_type"])], "potential_id int, id_value long, id_source string, id_type string, missing array<string>")
    found = {r["potential_id"]: r["matched_id"] for r in rules.resolve(potentials, known, ("id_value", "id_source", "id_type"), ("id_value", "id_source")).collect()}
    assert found == {1: "x1", 2: None, 3: "x1"}
    settled = rules.resolve(potentials, known, ("id_value", "id_source", "id_type"), ("id_value", "id_source")).withColumn("complete", F.lit(False)).withColumn("internal_id", F.lit("own"))
    for policy, count in (("pass", 2), ("stub", 3), ("create", 3)):
        assert rules.apply_policy(settled, "complete", policy).count() == count


def test_edge_types_are_checked(spark):
    linked = spark.createDataFrame([("a", "A", {}, "b", "B", {})], "source_id string, source_type string, source_props map<string,string>, target_id string, target_type string, target_props map<string,string>")
    with pytest.raises(PySparkException):
        rules.edges(linked, EdgeEntry("_x_", ("B",), ("A",))).collect()
    swapped = rules.edges(linked, EdgeEntry("_x_", ("B",), ("A",)), inbound=True).first()
    assert (swapped["src_id"], swapped["dst_id"]) == ("b", "a")


def test_missing_null_and_empty(spark):
    rows = spark.createDataFrame([(1, ""), (0, "MBI")], "detail_id long, id_source string")
    found = vertices.build(rows, CHANGE).collect()
    assert found[0]["missing"] == ["changelog_id", "detail_one"] and not found[0]["is_identifiable"]
    assert found[0]["identifier_stem"] == '#vertex#Change::stub#{"id_source": null}#' and found[1]["id_value"] is None


def test_schema_errors_and_json():
    with pytest.raises(SchemaError):
        Property("x", "Text")
    with pytest.raises(SchemaError):
        EdgeEntry("_e_", id_key=("to.internal_id",))
    with pytest.raises(SchemaError):
        Schema({"Change": CHANGE}, {})
    given = {"vertices": [{"name": "V", "properties": [{"name": "a", "kind": "Number", "is_id": True}], "id_key": ["a"], "stem_key": ["a"], "rules": [{"target_type": "V", "edge_label": "_e_", "specifier": "shared", "shared": ["a"], "constants": [["a", "source.a"]]}], "indexes": [{"name": "i", "fields": ["a"]}]}], "edges": [{"label": "_e_"}]}
    made = Schema.from_json(json.dumps(given))
    assert made["V"].rules[0].constants == (("a", "source.a"),) and made["_e_"].allows("V", "V") and made["V"].indexes[0].applies("V")
    with pytest.raises(KeyError):
        made["W"]
    assert newer(newer([], "x"), "x") == [(1, "x")] and newer([(1, "x")], "y")[-1] == (2, "y")


def test_links_and_pages(spark):
    known = spark.createDataFrame([(1, True), (2, False), (3, True)], "id_value long, is_linked boolean")
    remote = spark.createDataFrame([(2,), (3,), (4,), (4,), (None,)], "id_value long")
    assert {tuple(r) for r in links.reconcile(remote, known).collect()} == {(1, "unlink"), (2, "link"), (4, "new")}
    edges = spark.createDataFrame([(f"e{i:02d}", "v" if i % 2 else f"o{i}", f"o{i}" if i % 2 else "v", "_l_") for i in range(12)], "internal_id string, src_id string, dst_id string, edge_label string")
    page = reading.edge_page(edges, "v", 0, 10).collect()
    assert len(page) == 10 and all(r["more"] for r in page) and page[0]["direction"] == "inbound"
    assert [r["more"] for r in reading.edge_page(edges, "v", 10, 10).collect()] == [False, False]
    token = {"username": "u", "source": "s", "context": {}, "start": 0, "end": 10, "id": "v"}
    assert reading.unseal(reading.seal(token, "k"), "k") == token and reading.next_token(token)["end"] == 20
    with pytest.raises(ValueError):
        reading.unseal(reading.seal(token, "k"), "other")


def test_closure_ends_on_cycles(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, 4)], "parent long, child long")
    found = {(r["ancestor"], r["descendant"]): r["depth"] for r in reading.closure(pairs).collect()}
    assert found[1, 4] == 3 and found[1, 1] == 3 and len(found) == 12
    pairs.where("parent <> 3 or child <> 1").createOrReplaceTempView("pairs")
    assert {(r["ancestor"], r["descendant"]) for r in reading.closure_sql(spark, "pairs").collect()} == {(1, 2), (1, 3), (1, 4), (2, 3), (2, 4), (3, 4)}


def test_closure_of_deep_chains(spark):
    pairs = spark.createDataFrame([(k, k + 1) for k in range(24)], "parent long, child long")
    assert {(r["ancestor"], r["descendant"], r["depth"]) for r in reading.closure(pairs).collect()} == {(a, b, b - a) for b in range(25) for a in range(b)}
    pairs.createOrReplaceTempView("deep")
    assert reading.closure_sql(spark, "deep", 24).count() == 300
    with pytest.raises(PySparkException, match="levels apart"):
        reading.closure_sql(spark, "deep").collect()


def test_named_reads(spark):
    rows = spark.createDataFrame([(i, "MBI", "Clients", "client_id") for i in range(1, 6)], "id_value long, id_source string, id_type string, id_name string")
    made = vertices.build(rows, EXTERNAL)
    edges = spark.createDataFrame([("e", made.first()["internal_id"], "other", "_l_")], "internal_id string, src_id string, dst_id string, edge_label string")
    first = made.first()["internal_id"]
    assert reading.NAMED["getVertex"](made, edges, first).count() == 1 and reading.NAMED["getExternalIds"](made, edges, 2, 4).count() == 3
    assert reading.NAMED["pageExternalIds"](made, edges, 1, 3).count() == 2 and reading.NAMED["outbound_edges"](made, edges, first).count() == 1
    assert reading.NAMED["ExternalId.id_type"](made, edges, first).first()[0] == "Clients" and reading.NAMED["GenericEdge.out_vertex"](made, edges, "e").count() == 1
    assert reading.NAMED["findExternalId"](made, edges, id_value=3).count() == 1 and reading.NAMED["addExternalId"](made, edges, made).count() == 5
    assert reading.properties(made, ["id_type"]).count() == 5


def test_history(spark):
    rows = spark.createDataFrame([(1, 1, "ActivityTaskScheduled", 7, 1), (2, 2, "ActivityTaskStarted", 7, 1), (3, 3, "ActivityTaskFailed", 7, 1), (4, 3, "ActivityTaskStarted", 7, 2), (5, 9, "ChildWorkflowExecutionFailed", 8, 3), (6, 9, "LambdaFunctionCompleted", 9, 4), (7, 9, "Other", 10, 5)], "event_id int, ts int, event_type string, operation_id int, started_id int")
    folded = history.operations(history.attempts(rows.withColumn("state", history.state_of(F.col("event_type")))))
    found = {r["operation_id"]: (r["status"], r["fail_count"]) for r in folded.collect()}
    assert found == {7: ("live", 1), 8: ("failed", 1), 9: ("complete", 0)}
    saved = spark.createDataFrame([(8, "r", 1)], "operation_id int, result string, seq int")
    assert {r["operation_id"]: r["status"] for r in history.with_checkpoints(folded, saved).collect()}[8] == "complete"
    assert history.group_state(folded.withColumn("g", F.lit(1)), "g").first()["failed"]
    with pytest.raises(PySparkException):
        history.results(spark.createDataFrame([(1, "a"), (1, "b")], "operation_id int, result string")).collect()


def test_changes(spark):
    log = spark.createDataFrame([("t1", 4), ("t2", 5)], "change_date_utc string, client_id long")
    emp = spark.createDataFrame([("t1", 77)], "change_date_utc string, emp_id long")
    ids_ = spark.createDataFrame([("t1", 9)], "change_date_utc string, changelog_id long")
    details = spark.createDataFrame([(9, "x")], "changelog_id long, detail string")
    assert sorted((r["change_date_utc"], r["emp_id"], r["detail"]) for r in changes.enrich(log, emp, ids_, details, "client_id").collect()) == [("t1", 77, "x"), ("t2", 5, None)]
    types = spark.createDataFrame([("ADD", 1, "Clients")], "action string, action_id long, category string")
    with pytest.raises(PySparkException):
        changes.with_category(spark.createDataFrame([("DROP",)], "action string"), types).collect()
    assert changes.choose_mapping({"default": {"T": {"a": 1}}}, "MBI", "T") == {"a": 1}


def test_registries():
    assert merged({"a": {"b": 1}, "l": [1]}, {"a": {"c": 2}, "l": [2]}) == {"a": {"b": 1, "c": 2}, "l": [1, 2]}
    assert arguments({"x": 1, "y": {"provided": "p"}, "z": {"function": lambda p: p + 1}}, {"p": 4}) == {"x": 1, "y": 4, "z": 5}


def test_patient_match_equals_every_pair(spark):
    names, numbers = ("Ann", "ANN", "bo", None), ("1", "12", "", None)
    people = [(k, numbers[k % 4], names[k // 4 % 4], names[k // 16 % 3]) for k in range(48)] + [(3, "1", "bo", "bo"), (5, "12", "Ann", "x"), (5, "12", "Ann", "x"), (99, "5", "y", "z")]
    clients = [(k, m and m + "2", f, s) for k, m, f, s in people if k % 3] + [(200, "512", "Y", "q")]
    same = lambda a, b: a is not None and b is not None and a.lower() == b.lower()
    hit = lambda r, c: c[1] is not None and r[1] in c[1] and (same(r[2], c[2]) or same(r[3], c[3])) if r[1] else same(r[2], c[2]) and same(r[3], c[3])
    expected = {k: {c[0] for r in people if r[0] == k for c in clients if hit(r, c)} for k, *_ in people}
    kinds = "medicaid string, first_name string, last_name string"
    rows = matching.patient_match(spark.createDataFrame(people, f"record_id long, {kinds}"), spark.createDataFrame(clients, f"client_id long, {kinds}")).collect()
    assert len(rows) == len(people) and {r["record_id"]: (r["matches"], r["client_id"]) for r in rows} == {k: (len(x), min(x) if len(x) == 1 else None) for k, x in expected.items()}


def test_a_frequent_name_costs_its_distinct_numbers(spark):
    rows = spark.range(20_000).selectExpr("id", "cast(id % 3 + 1 as string) as medicaid", "'Ann' as first_name", "'Lee' as last_name")
    found = matching.patient_match(rows.withColumnRenamed("id", "record_id"), rows.withColumnRenamed("id", "client_id"))
    assert {(r["matches"], r["outcome"]) for r in found.select("matches", "outcome").distinct().collect()} == {(6667, "duplicate"), (6666, "duplicate")}


def test_extraction_from_a_table_equals_extraction_from_an_array(spark):
    orders = spark.createDataFrame([(1, 10), (2, 11), (3, 12)], "id_value long, customer long").select(F.lit("TPC").alias("id_source"), F.lit("Order").alias("id_type"), "id_value", "customer", F.col("id_value").alias("order_key"))
    parts = spark.createDataFrame([(1, 5), (1, 6), (1, 6), (2, 5), (9, 7)], "order_key long, id_value long")
    arrays = parts.groupBy("order_key").agg(F.collect_set(F.struct("id_value")).alias("contents"))
    one = assimilate({"Order": orders.join(arrays, "order_key", "left")}, catalog.ORDERS)
    two = assimilate({"Order": orders}, catalog.ORDERS, children={"contents": (parts, "order_key")})
    columns = ("edge_label", "internal_id", "src_id", "dst_id")
    assert sorted(map(tuple, one.edges.select(*columns).collect())) == sorted(map(tuple, two.edges.select(*columns).collect())) and two.edges.count() == 6
    assert {r[0] for r in one.vertices.select("internal_id").collect()} == {r[0] for r in two.vertices.select("internal_id").collect()}


def test_assimilation_results_have_edges_of_every_label(spark, tmp_path):
    orders = spark.createDataFrame([(1, 7), (2, 7), (0, 7), (3, 0)], "o_orderkey long, o_custkey long")
    items = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, 0), (0, 5), (3, 6), (9, 5)], "l_orderkey long, l_partkey long")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    items.write.parquet(str(tmp_path / "lineitem.parquet"))
    md5 = lambda kind, n: hashlib.md5(f"TPC{kind}{n}".encode()).hexdigest()
    ends = [(1, "_placed_by_", md5("Customer", 7)), (2, "_placed_by_", md5("Customer", 7)), (1, "_contains_", md5("Part", 5)), (1, "_contains_", md5("Part", 6)), (3, "_contains_", md5("Part", 6))]
    expected = [(md5("Order", n), "Order", label, hashlib.md5(f"{md5('Order', n)}{label}{to}".encode()).hexdigest(), to) for n, label, to in ends]
    found = catalog.QUERIES["assimilation_results"](spark, str(tmp_path))
    assert found.columns == ["internal_id", "object_type", "edge_label", "edge_id", "other_id"]
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)
