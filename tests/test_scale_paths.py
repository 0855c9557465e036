"""Paths that small tables don't take by themselves: ranges, stretches, bounds, errors."""

import hashlib

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from graphloom.functions import text
from graphloom.operators import changes, history, links, ordering, reading, rules, shaping, vertices
from graphloom.plans import catalog
from graphloom.plans.graph_etl import assimilate
from graphloom.registry import merged
from graphloom.sources import readers
from graphloom.streaming import item_states


def test_many_new_ids_are_made_by_many_tasks(spark):
    one = lambda x: spark.createDataFrame([(x,)], "max_id bigint")
    ids = links.incremental(one(10**7), one(None), spark.createDataFrame([(5,), (10**7,)], "id_value bigint"))
    assert ids.agg(F.count("*"), F.min("id_value"), F.max("id_value")).first() == (10**7 - 2, 1, 10**7 - 1)
    assert links.incremental(one(3), one(3), spark.createDataFrame([], "id_value bigint")).count() == 0
    assert links.incremental(one(None), one(3), spark.createDataFrame([], "id_value bigint")).count() == 0


def test_categories_are_bounded(spark):
    ids = spark.range(3)
    found = links.propagate(ids, spark.createDataFrame([("a", 1), ("b", None)], "category string, rank int"))
    assert sorted((r["id"], r["category"], r["rank"]) for r in found.collect()) == [(k, c, n) for k in range(3) for c, n in (("a", 1), ("b", None))]
    with pytest.raises(ValueError):
        links.propagate(ids, spark.range(20).withColumnRenamed("id", "category"), most=10)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("stretch", [1, 7, 1000])
@pytest.mark.parametrize("order", ["n", "at", "name"])
def test_batches_are_the_same_in_any_stretches(spark, stretch, order):
    rows = spark.range(200).select((F.col("id") * F.col("id") % 211).alias("n"), F.timestamp_seconds(F.col("id") * 97 % 1000).alias("at"), F.format_string("k%04d", F.col("id")).alias("name"), (F.col("id") % 13 + 1).alias("size"), (F.col("id") % 10 == 0).alias("shard"))
    rows = rows.dropDuplicates([order])
    expected, running = {}, {}
    for r in sorted(rows.collect(), key=lambda r: r[order]):
        total, count = running.get(r["shard"], (0, 0))
        expected[r[order]] = max(total // 50, count // 9)
        running[r["shard"]] = total + r["size"], count + 1
    found = readers.put_batches(rows, order, "size", "shard", 50, 9, stretch)
    assert found.columns == [*rows.columns, "batch"] and {r[order]: r["batch"] for r in found.collect()} == expected
    assert readers.put_batches(rows.limit(0), order, "size", "shard").count() == 0


def test_log_fields_of_odd_lines(spark):
    lines = ["[INFO] now r1 {f} done", "[INFO] now r1 {} ", "[WARN]\tnow\tr2\t{g}\ta {b} [c]", "plain", "", None, "\x01a\x01b\x01c\x01d\x01e", "[X] a b {c} m\x01n\x01o"]
    rows = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k int, line string").select("k", text.log_fields(F.col("line")).alias("f")).collect()
    found = {r["k"]: tuple(r["f"]) for r in rows}
    assert found[0] == ("INFO", "now", "r1", "f", "done") and found[2] == ("WARN", "now", "r2", "g", "a {b} [c]") and found[7] == ("X", "a", "b", "c", "m\x01n\x01o")
    assert found[3] == found[4] == found[5] == (None,) * 5


def test_errors_name_what_is_missing(spark):
    asked = spark.createDataFrame([("a",), ("none",)], "id_type string")
    with pytest.raises(PySparkException, match="not set up: none"):
        changes.setup(spark.createDataFrame([("a", "x")], "id_type string, setup string"), asked, "id_type").collect()
    indexed = spark.createDataFrame([("#a", 3)], "identifier_stem string, id_value bigint")
    stems = spark.createDataFrame([("#b",)], "identifier_stem string")
    with pytest.raises(PySparkException, match="nothing is indexed under #b"):
        links.max_indexed(indexed, stems).collect()
    assert links.max_indexed(indexed, stems, -1).first() == ("#b", -1, True)


def test_decisions_that_close_a_run_are_last(spark):
    rows = spark.createDataFrame([("r", 1, "CompleteWorkflowExecution"), ("r", 2, "StartTimer"), ("r", 3, "RecordMarker"), ("s", 1, "FailWorkflowExecution")], "run_id string, sequence int, kind string")
    assert [(r["run_id"], r["sequence"]) for r in history.completion_last(rows).orderBy("run_id", "place").collect()] == [("r", 2), ("r", 3), ("r", 1), ("s", 1)]


def test_dropping_vertices_takes_their_edges(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("c",)], "internal_id string")
    edges = spark.createDataFrame([("1", "a", "b"), ("2", "b", "c"), ("3", "a", "c"), ("4", "a", None)], "internal_id string, src_id string, dst_id string")
    left, kept = reading.without(nodes, edges, nodes.where("internal_id = 'b'"))
    assert {r[0] for r in left.collect()} == {"a", "c"} and {r["internal_id"] for r in kept.collect()} == {"3", "4"} and kept.columns == edges.columns


def test_deep_merges_agree(spark):
    a, b = {"x": {"p": "1", "q": "2"}, "y": {"r": "3"}}, {"x": {"q": "9"}, "z": {"s": "4"}}
    row = spark.createDataFrame([(a, b)], "a map<string, map<string, string>>, b map<string, map<string, string>>")
    assert row.select(shaping.merged_maps(F.col("a"), F.col("b")).alias("m")).first()["m"] == merged(a, b)


class HeldState:
    """What the item machine asks of a group's state."""

    exists, hasTimedOut, timeout = False, False, None

    def __init__(self, watermark):
        self.watermark = watermark

    def update(self, value):
        self.get, self.exists = value, True

    def setTimeoutTimestamp(self, at):
        self.timeout = at

    def getCurrentWatermarkMs(self):
        return self.watermark


@pytest.mark.parametrize("gated", [True, False])
def test_items_of_a_group_are_folded_in_one_call(gated):
    machine, state = item_states.ItemMachine(1000, gated, True), HeldState(0)
    page = lambda *rows: iter([pd.DataFrame(rows, columns=["item", "place", "ms"])])
    many = [(f"i{k}", stage, 10 * k + stage) for k in range(20_000) for stage in (1, 2)]
    (found,) = machine.fold((0,), page(*many, ("late", 3, 5), (None, 1, 6)), state)
    assert len(found) == 20_001 + (not gated) and set(found["stages"]) == {1, 2} and state.timeout == 1001
    (found,) = machine.fold((0,), page(("late", 1, 7), ("late", 2, 7), ("i1", 2, 3), ("i2", 5, 30)), state)
    expected = {("late", 3, 3)} if gated else {("late", 3, 3), ("i2", 5, 3)}
    assert {tuple(r) for r in found[["item", "place", "stages"]].itertuples(index=False)} == expected
    state.hasTimedOut, state.watermark = True, 1012  # i1 was seen at 12, so it is stalled at 1012 and not before
    (found,) = machine.fold((0,), iter([]), state)
    assert set(found["stalled"]) == {True} and {None if x is None or x != x else x for x in found["item"]} == {"late", None, "i0", "i1"}
    assert list(machine.fold((0,), iter([]), state)) == [] and state.timeout == (1029 if gated else 1031)


def test_recursive_closure_has_no_limit_of_rows(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "50")
    try:
        spark.range(100).select((F.col("id") % 10 + 1000).alias("parent"), "id").union(spark.range(10).select(F.lit(7000), F.col("id") + 1000)).toDF("parent", "child").createOrReplaceTempView("wide_pairs")
        found = reading.closure_sql(spark, "wide_pairs", 4)
        assert found.groupBy("depth").count().orderBy("depth").collect() == [(1, 110), (2, 100)]
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", before)


def test_potentials_are_counted_without_pairs(spark):
    known = spark.range(30_000).select(F.col("id").alias("internal_id"), F.when(F.col("id") % 100 != 7, "a").alias("brand"), F.when(F.col("id") % 3 != 0, F.col("id") % 5).alias("size"))
    gone = F.col("id") % 2 == 0
    some = known.select(F.col("internal_id").alias("id"), "brand", "size").select(F.col("id").alias("potential_id"), "brand", F.when(~gone, F.col("size")).alias("size"), F.array_compact(F.array(F.when(gone, "size"))).alias("missing"))
    found = rules.resolve_counts(some, known, ("brand", "size"), ("brand",))
    counts = {(r["potential_id"] % 2, r["brand"], r["size"]): (r["matches"], r["matched_id"]) for r in found.collect()}
    assert found.count() == 30_000 and counts[0, "a", None] == (29_700, 0) and {v for k, v in counts.items() if k[1] is None} == {(0, None)}
    of_size = lambda size: [k for k in range(30_000) if k % 100 != 7 and (k % 5 if k % 3 else None) == size]
    assert all(counts[1, "a", size] == (len(of_size(size)), of_size(size)[0]) for size in (None, 0, 1, 2, 3, 4))
    few = some.where("potential_id % 1000 < 8")
    pairs = rules.resolve(few, known.where("internal_id < 500"), ("brand", "size"), ("brand",)).groupBy("potential_id").agg(F.count("matched_id").alias("matches"), F.min("matched_id").alias("matched_id"))
    same = rules.resolve_counts(few, known.where("internal_id < 500"), ("brand", "size"), ("brand",)).select("potential_id", "matches", "matched_id")
    assert sorted(pairs.collect(), key=str) == sorted(same.collect(), key=str)
    assert rules.resolve_counts(some.limit(0), known, ("brand", "size"), ("brand",)).count() == 0 and "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("rows, size", [(1003, 10), (1000, 10), (7, 10), (0, 10)])
def test_page_tables_come_from_bounded_ranges(spark, monkeypatch, rows, size):
    monkeypatch.setattr(ordering, "ROWS_A_RANGE", 90)
    made = spark.range(rows).select((F.col("id") * 7919 % 1009 % 50).alias("a"), F.col("id").alias("b")).repartition(3)
    ranked, total = ordering.ordered(made, "a", "b")
    assert total.first()[0] == rows and {r["_idx"] for r in ranked.collect()} == set(range(rows))
    keys = sorted(tuple(r) for r in made.collect())
    expected = [(n // size, min(size, rows - n), *keys[n]) for n in range(0, rows, size)]
    table = reading.page_table(made, size, "a", "b")
    assert sorted(tuple(r) for r in table.collect()) == expected
    assert table.columns == ["page", "rows", "first_a", "first_b"] and "SortAggregate" not in table._jdf.queryExecution().executedPlan().toString()


def test_graph_targets_are_distinct_before_they_are_built(spark):
    orders = spark.range(1, 301).select(F.lit("TPC").alias("id_source"), F.lit("Order").alias("id_type"), F.col("id").alias("id_value"), F.col("id").alias("order_key"), (F.col("id") % 3 + 1).alias("customer"))
    contents = orders.select("order_key", F.explode(F.array(F.lit(5), F.lit(5), F.col("customer"))).alias("id_value"))
    entry, rule = catalog.ORDERS.vertices["Order"], catalog.ORDERS.vertices["Order"].rules[0]
    own = vertices.build(orders, entry, ("customer",)).select("internal_id", "props", "object_type", "customer")
    new, linked = rules.follow(own, entry, rule, catalog.ORDERS)
    assert new.count() == 3 and linked.count() == 300
    graph = assimilate({"Order": orders}, catalog.ORDERS, children={"contents": (contents, "order_key")})
    md5 = lambda kind, n: hashlib.md5(f"TPC{kind}{n}".encode()).hexdigest()
    ids = {md5("Order", n) for n in range(1, 301)} | {md5("Customer", n) for n in (1, 2, 3)} | {md5("Part", n) for n in (1, 2, 3, 5)}
    found = graph.vertices.collect()
    assert len(found) == len(ids) and {r["internal_id"] for r in found} == ids and {r["props"]["id_value"] for r in found if r["object_type"] == "Part"} == {"1", "2", "3", "5"}
    pairs = {("_placed_by_", md5("Order", n), md5("Customer", n % 3 + 1)) for n in range(1, 301)} | {("_contains_", md5("Order", n), md5("Part", p)) for n in range(1, 301) for p in (5, n % 3 + 1)}
    made = graph.edges.collect()
    assert len(made) == len(pairs) == 900 and {(r["edge_label"], r["src_id"], r["dst_id"]) for r in made} == pairs
    assert all(r["internal_id"] == hashlib.md5(f"{r['src_id']}{r['edge_label']}{r['dst_id']}".encode()).hexdigest() for r in made)
    counted = graph.vertices.groupBy("object_type").count()._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by(object_type" in counted and "max_by(props" not in counted and "identifier_stem" not in counted.split("Aggregate [internal_id")[0]
