"""Workflow logs, batches, unique indexes, the graph store and item states against plain versions of themselves."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphloom.operators import attribution, batching, indexes, ordering
from graphloom.schema import Index
from graphloom.sources.graph_store import GraphStore
from graphloom.streaming import item_states

BEGAN = datetime(2024, 1, 1)
EVENT = "run_id long, event_id long, ts timestamp, event_type string, operation_key string, schedule_ref long, start_ref long, name string, details string"


def event(n, kind, key=None, schedule=None, start=None, name=None, details=None, run=1):
    return (run, n, BEGAN + timedelta(seconds=n), kind, key, schedule, start, name, details)


LOG = [
    event(1, "ActivityTaskScheduled", "a"),
    event(2, "ActivityTaskStarted", schedule=1),
    event(3, "ActivityTaskFailed", schedule=1, start=2),
    event(4, "TimerStarted", name="error_back_off!x", details='{"fn_identifier": "a", "timeout": 2}'),
    event(5, "TimerFired", start=4),
    event(6, "ActivityTaskScheduled", "a"),
    event(7, "ActivityTaskStarted", schedule=6),
    event(8, "ActivityTaskTimedOut", schedule=6, start=7),
    event(9, "ActivityTaskTimedOut", schedule=6, start=0),  # without a start
    event(10, "LambdaFunctionScheduled", "f"),
    event(11, "StartChildWorkflowExecutionInitiated", "c"),
    event(12, "ChildWorkflowExecutionStarted", schedule=11),
    event(13, "ChildWorkflowExecutionCompleted", schedule=11, start=12),
    event(14, "ScheduleActivityTaskFailed", "r"),
    event(15, "TimerStarted", name="error_back_off!y", details='{"fn_identifier": "r", "timeout": 2}'),
    event(16, "ActivityTaskStarted", schedule=99),  # nobody scheduled it
    event(17, "ActivityTaskScheduled", "p"),
    event(18, "WorkflowExecutionSignaled", name="start", details="{}"),
    event(19, "WorkflowExecutionSignaled", name="stop", details="{}"),
    event(20, "MarkerRecorded", name="signal", details='{"18": "done"}'),
    event(21, "MarkerRecorded", name="checkpoint", details='{"a": "1", "b": "2"}'),
    event(22, "MarkerRecorded", name="checkpoint", details='{"a": "3"}'),
    event(23, "MarkerRecorded", name="note", details="plain"),
    event(1, "ActivityTaskScheduled", "other", run=2),  # the same ids in another run
    event(2, "ActivityTaskStarted", schedule=1, run=2),
]


@pytest.fixture(params=[0, 1])
def log(spark, request):
    rows = LOG + LOG[5:9]  # a page that came twice
    random.Random(request.param).shuffle(rows)
    return spark.createDataFrame(rows, EVENT)


def test_events_find_their_attempts(log):
    found = {(r["run_id"], r["event_id"]): (r["operation_id"], r["schedule_id"], r["start_id"]) for r in attribution.attributed(log).collect()}
    assert found[1, 3] == ("a", 1, 2) and found[1, 8] == ("a", 6, 7) and found[1, 9] == ("a", 6, None)
    assert found[1, 16] == (None, None, None) and found[2, 2] == ("other", 1, 2) and found[1, 14] == ("r", 14, None)
    assert len(found) == 16


def test_decisions(log):
    folded = attribution.operations(attribution.attempts(attribution.attributed(log)))
    found = {(r["run_id"], r["operation_id"]): r.asDict() for r in attribution.decisions(folded, attribution.timers(log)).collect()}
    picked = {k: (v["attempts"], v["fail_count"], v["status"], v["back_off"], v["next"], v["wait_seconds"]) for k, v in found.items()}
    assert picked == {
        (1, "a"): (3, 3, "failed", "due", "back_off", 8),
        (1, "f"): (1, 0, "live", None, "run", None),
        (1, "c"): (1, 0, "complete", None, "done", None),
        (1, "r"): (1, 1, "failed", "pending", "wait", None),
        (1, "p"): (1, 0, "pending", None, "run", None),
        (2, "other"): (1, 0, "live", None, "run", None),
    }
    assert found[1, "r"]["due_at"] == BEGAN + timedelta(seconds=17)


def test_spent_back_off_restarts(spark):
    rows = LOG[:5]
    folded = attribution.operations(attribution.attempts(attribution.attributed(spark.createDataFrame(rows, EVENT))))
    (found,) = attribution.decisions(folded, attribution.timers(spark.createDataFrame(rows, EVENT))).collect()
    assert (found["back_off"], found["next"]) == ("spent", "restart")


def test_markers_and_signals(log):
    assert {(r["name"], r["key"]): r["value"] for r in attribution.markers(log).collect()} == {("signal", "18"): "done", ("checkpoint", "a"): "3", ("checkpoint", "b"): "2", ("note", ""): "plain"}
    assert [r["event_id"] for r in attribution.open_signals(log).collect()] == [19]


def greedy(sizes, most_bytes, most_rows):
    found, batch, size, rows = [], -1, 0, 0
    for s in sizes:
        if batch < 0 or size + s > most_bytes or rows == most_rows:
            batch, size, rows = batch + 1, 0, 0
        size, rows = size + s, rows + 1
        found.append(batch)
    return found


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=1, max_size=60), st.integers(1, 40), st.integers(1, 7))
def test_following_starts_greedy_batches(sizes, most_bytes, most_rows):
    step, at, starts = batching.following(np.array(sizes), most_bytes, most_rows), 0, []
    while at < len(sizes):
        starts.append(at)
        at = int(step[at])
    want = greedy(sizes, most_bytes, most_rows)
    assert starts == [i for i in range(len(sizes)) if not i or want[i] != want[i - 1]]


@pytest.mark.parametrize("seed", range(3))
def test_greedy_batches(spark, seed):
    rng = random.Random(seed)
    groups = {"hot": [rng.choice([0, 1, 5, 999, 1500]) for _ in range(400)], "b": [1500, *[1] * 98], "six": [999] * 6, None: [3] * 25, "one": [7]}
    rows = [(g, i, s) for g, sizes in groups.items() for i, s in enumerate(sizes)]
    rng.shuffle(rows)
    found = batching.greedy(spark.createDataFrame(rows, "g string, i long, s long"), "g", ["i"], "s", 1000, 11, stretch=11 + seed, block=3).collect()
    by = {}
    for r in found:
        by.setdefault(r["g"], {})[r["i"]] = r["batch"]
    assert {g: [by[g][i] for i in range(len(sizes))] for g, sizes in groups.items()} == {g: greedy(sizes, 1000, 11) for g, sizes in groups.items()}


def test_greedy_batches_of_nothing(spark):
    assert batching.greedy(spark.createDataFrame([], "g string, i long, s long"), "g", ["i"], "s").count() == 0


def test_response_cut(spark):
    rows = [(i, 40, "Ok" if i % 4 else "ProcessingFailed") for i in range(12)]
    found = {r["i"]: (r["result"], r["regroup"]) for r in batching.response_cut(spark.createDataFrame(rows, "i long, s long, result string").withColumn("g", F.lit(1)), "g", ["i"], "s", most_bytes=100, per_group=3).collect()}
    assert [found[i] for i in (0, 1, 2, 3, 4, 5, 6, 7, 9)] == [("ProcessingFailed", None), ("Ok", None), ("Ok", None), ("Dropped", 0), ("ProcessingFailed", None), ("Dropped", 0), ("Dropped", 0), ("Dropped", 1), ("Dropped", 1)]


def test_running_sums_of_groups(spark):
    rows = [(("hot", "hot", None, "x")[i % 4], i, i % 7 or None) for i in range(300)]
    found = ordering.running(spark.createDataFrame(rows, "g string, i long, v long").repartition(5), "g", [F.col("i")], {"before": "v"}).collect()
    assert len(found) == 300
    for r in found:
        earlier = [v or 0 for g, i, v in rows if g == r["g"] and i < r["i"]]
        assert (r["idx"], r["before"]) == (len(earlier), sum(earlier))


def sequential(objects, declared, stored):
    key = lambda o, i: (i.name, *(o.get(f) for f in i.fields)) if ("*" in i.object_types or o["object_type"] in i.object_types) and all(o.get(f) is not None for f in i.fields) else None
    keys = lambda o: {key(o, i) for i in declared if i.unique} - {None}
    held, won = set().union(*(keys(o) for o in stored)) if stored else set(), []
    for o in sorted(objects, key=lambda o: o["n"]):
        if not keys(o) & held:
            won.append(o["n"])
            held |= keys(o)
    return won


@pytest.mark.parametrize("seed", range(3))
def test_unique_indexes_one_after_the_other(spark, seed):
    rng = random.Random(seed)
    declared = (Index("a", ("x",)), Index("b", ("y", "z"), object_types=("T",)), Index("c", ("w",), unique=False), Index("none", ("x",), object_types=()))
    objects = [{"n": n, "object_type": rng.choice("TU"), "x": rng.choice([None, *range(40)]), "y": rng.randrange(6), "z": rng.choice([None, *range(9)]), "w": 1} for n in range(120)]
    objects += [{"n": n, "object_type": "T", "x": 100, "y": 50, "z": n % 5} for n in range(200, 230)]  # a key that most of these share
    stored = [{"n": -1, "object_type": "T", "x": 3, "y": 0, "z": 0, "w": 1}]
    schema = "n long, object_type string, x long, y long, z long, w long"
    table = lambda rows: spark.createDataFrame([tuple(o.get(c) for c in ("n", "object_type", "x", "y", "z", "w")) for o in rows], schema)
    found = indexes.accepted(table(objects), declared, ["n"], table(stored)).collect()
    assert sorted(r["n"] for r in found if r["accepted"]) == sequential(objects, declared, stored)
    assert len(found) == len(objects) and all(r["accepted"] != bool(r["violates"]) for r in found)


def test_graph_store_replay_and_old_versions(spark, tmp_path):
    store = GraphStore(spark, str(tmp_path / "graph"), buckets=4)
    vertex = lambda ids, wave: spark.createDataFrame([(i, "V" if n % 2 else "W", {"wave": wave}) for n, i in enumerate(ids)], "internal_id string, object_type string, props map<string,string>")
    edge = lambda pairs: spark.createDataFrame([(f"{a}-{b}", "_e_", a, b, None) for a, b in pairs], "internal_id string, edge_label string, src_id string, dst_id string, props map<string,string>")
    assert store.read("vertices").count() == 0
    held = store.upsert(vertex("abcd", "1"), edge([("a", "b"), ("a", "z")]))
    assert [r["internal_id"] for r in held.collect()] == ["a-z"] and store.version() == 1
    store.upsert(vertex("abcdz", "2"), edge([("a", "b"), ("a", "z"), ("z", "d")]))
    names = sorted(p.name for p in (tmp_path / "graph").rglob("*.parquet"))
    store.upsert(vertex("abcdz", "3"), edge([("z", "d")]))
    assert store.version() == 2 and sorted(p.name for p in (tmp_path / "graph").rglob("*.parquet")) == names  # a replay writes nothing
    again = GraphStore(spark, str(tmp_path / "graph"))
    assert again.buckets == 4
    assert {r["internal_id"]: r["props"]["wave"] for r in again.read("vertices").collect()} == {"a": "1", "b": "1", "c": "1", "d": "1", "z": "2"}
    assert sorted(r["internal_id"] for r in again.read("edges", "_e_").collect()) == ["a-b", "a-z", "z-d"]
    assert sorted(r["internal_id"] for r in again.read("edges", version=1).collect()) == ["a-b"]
    one = again.read("vertices", ids=["a"])
    assert [r["internal_id"] for r in one.collect()] == ["a"] and len(one.inputFiles()) < len(again.read("vertices").inputFiles())
    with pytest.raises(RuntimeError, match="another writer"):
        again._commit(2, {})


def test_item_states_with_late_and_repeated_events(spark, tmp_path):
    at = lambda minute: BEGAN + timedelta(minutes=minute)
    pages = [[("a", "extraction", 1), ("b", "graphing", 1), ("c", "monitoring", 2)], [("a", "monitoring", 3), ("a", "extraction", 3), ("c", "monitoring", 2)], [("d", "monitoring", 300)], [("c", "extraction", 4), ("d", "nonsense", 301)]]
    found = []
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    spark.conf.set(store, item_states.ROCKS)
    try:
        for page in pages:  # a run of its own each, from the same checkpoint
            spark.createDataFrame([(i, s, at(m)) for i, s, m in page], "item string, stage string, at timestamp").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema("item string, stage string, at timestamp").parquet(str(tmp_path / "in")).withWatermark("at", "10 minutes")
            item_states.item_states(stream, gated=True, event_time=True).writeStream.outputMode("update").foreachBatch(lambda b, _: found.extend((r["item"], r["kind"], r["stage"], r["repair"]) for r in b.collect())).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(store, before)
    assert ("a", "stage", "extraction", None) in found and ("c", "stage", "monitoring", None) in found
    assert [r for r in found if r[0] == "a"].count(("a", "stage", "extraction", None)) == 1
    assert {r for r in found if r[1] == "repair"} == {("a", "repair", "extraction", "extract"), ("b", "repair", None, "extract"), ("c", "repair", "monitoring", "extract")}
