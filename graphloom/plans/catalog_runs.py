"""Queries over raw workflow logs and batches. The logs are made of the events table: sixteen events are a run, their places in it and their types say what happened."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators import attribution, batching
from graphloom.plans.catalog import query, t
from graphloom.session import new_folder
from graphloom.streaming import item_states


def by_kind(activity: str, function: str, subtask: str) -> str:
    return f"CASE run_id % 3 WHEN 0 THEN '{activity}' WHEN 1 THEN '{function}' ELSE '{subtask}' END"


def by_slot(other: str, **slots: str) -> str:
    return "CASE slot " + " ".join(f"WHEN {name[1:]} THEN {then}" for name, then in slots.items()) + f" ELSE {other} END"


SCHEDULE = by_kind("ActivityTaskScheduled", "LambdaFunctionScheduled", "StartChildWorkflowExecutionInitiated")
START = by_kind("ActivityTaskStarted", "LambdaFunctionStarted", "ChildWorkflowExecutionStarted")
REFUSED = by_kind("ScheduleActivityTaskFailed", "ScheduleLambdaFunctionFailed", "StartChildWorkflowExecutionFailed")
FAILED = by_kind("ActivityTaskFailed", "LambdaFunctionFailed", "ChildWorkflowExecutionFailed")
TIMED_OUT = by_kind("ActivityTaskTimedOut", "LambdaFunctionTimedOut", "ChildWorkflowExecutionTerminated")
COMPLETED = by_kind("ActivityTaskCompleted", "LambdaFunctionCompleted", "ChildWorkflowExecutionCompleted")
END = f"CASE WHEN was = 'purchase' THEN {COMPLETED} WHEN was = 'signup' THEN {TIMED_OUT} ELSE {FAILED} END"
ASKED = f"CASE WHEN run_id % 3 = 0 THEN 'ActivityTaskCancelRequested' ELSE {START} END"
FIRST = "16 * run_id"
LOG_COLUMNS = {
    "run_id": "run_id",
    "event_id": "event_id",
    "ts": "ts",
    "event_type": by_slot("'WorkflowExecutionSignaled'", s0=SCHEDULE, s1=START, s2=END, s3="'TimerStarted'", s4="CASE WHEN was IN ('click', 'view') THEN 'TimerFired' WHEN was = 'purchase' THEN 'TimerCanceled' ELSE 'DecisionTaskScheduled' END", s5=SCHEDULE, s6=START, s7=END, s8="'MarkerRecorded'", s10=f"CASE WHEN was IN ('error', 'click') THEN {REFUSED} ELSE {SCHEDULE} END", s11=ASKED, s12=SCHEDULE, s13=START, s14=END),
    "operation_key": by_slot("NULL", s0="'a'", s5="CASE WHEN was = 'view' THEN 'b' ELSE 'a' END", s10="'c'", s11="CASE WHEN run_id % 3 = 0 THEN 'a' END", s12="'d'"),
    "schedule_ref": by_slot("NULL", s1=FIRST, s2=FIRST, s6=f"CASE WHEN was = 'error' THEN {FIRST} + 4 ELSE {FIRST} + 5 END", s7=f"{FIRST} + 5", s11=f"{FIRST} + 10", s13=f"{FIRST} + 12", s14=f"{FIRST} + 12"),
    "start_ref": by_slot("NULL", s2=f"{FIRST} + 1", s4=f"{FIRST} + 3", s7=f"CASE was WHEN 'signup' THEN 0 WHEN 'click' THEN {FIRST} + 1 ELSE {FIRST} + 6 END", s14=f"{FIRST} + 13"),
    "name": by_slot("NULL", s3="concat('error_back_off!', CAST(run_id AS VARCHAR(20)))", s8="CASE was WHEN 'purchase' THEN 'checkpoint' WHEN 'view' THEN 'signal' ELSE 'names' END", s9="'start_ruffian'", s15="CASE WHEN was = 'error' THEN 'stop_ruffian' ELSE 'note' END"),
    "details": by_slot("NULL", s3="""concat('{"fn_identifier": "a", "timeout": ', CAST(2 + run_id % 5 AS VARCHAR(20)), '}')""", s8=f"""CASE was WHEN 'purchase' THEN concat('{{"a": "r', CAST(event_id AS VARCHAR(20)), '"}}') WHEN 'view' THEN concat('{{"', CAST({FIRST} + 9 AS VARCHAR(20)), '": "done"}}') ELSE concat('n', CAST(event_id AS VARCHAR(20))) END""", s9="props", s15="props"),
}
LOG_INPUT = {"run_id": "CAST(floor(event_id / 16) AS BIGINT)", "slot": "event_id % 16", "event_id": "event_id", "ts": "ts", "was": "event_type", "props": "props"}
LOG_SQL = f"placed AS (SELECT {', '.join(f'{e} AS {c}' for c, e in LOG_INPUT.items())} FROM events), log AS (SELECT {', '.join(f'{e} AS {c}' for c, e in LOG_COLUMNS.items())} FROM placed)"


def log(spark: SparkSession, d: str) -> DataFrame:
    """Raw events in no order; a tenth of them arrive a second time with a later page."""
    rows = t(spark, d, "events").selectExpr(*(f"{e} AS {c}" for c, e in LOG_INPUT.items()))
    made = rows.selectExpr(*(f"{e} AS {c}" for c, e in LOG_COLUMNS.items()))
    return made.unionByName(made.where("event_id % 10 = 3"))


KINDS_SQL = "kinds(event_type, kind, role, state) AS (VALUES " + ", ".join(f"('{name}', '{kind}', '{role}', {repr(state) if state else 'NULL'})" for name, (kind, role, state) in attribution.roles().items()) + ")"
ATTRIBUTED_SQL = f"""{LOG_SQL}, {KINDS_SQL},
    typed AS (SELECT log.*, kind, role, state FROM log JOIN kinds USING (event_type)),
    attributed AS (
        SELECT e.run_id, e.event_id, e.ts, e.event_type, e.kind, e.role, e.state,
               CASE WHEN e.role IN ('start', 'end') THEN s.operation_key ELSE e.operation_key END AS operation_id,
               CASE WHEN e.role IN ('start', 'end') THEN s.event_id WHEN e.role <> 'asked' THEN e.event_id END AS schedule_id,
               CASE WHEN s.event_id IS NULL THEN NULL WHEN e.role = 'start' THEN e.event_id WHEN e.role = 'end' THEN b.event_id END AS start_id
        FROM typed e
        LEFT JOIN typed s ON s.role = 'schedule' AND s.run_id = e.run_id AND s.kind = e.kind AND s.event_id = e.schedule_ref
        LEFT JOIN typed b ON b.role = 'start' AND b.run_id = e.run_id AND b.kind = e.kind AND b.event_id = e.start_ref AND b.schedule_ref = e.schedule_ref)"""


@query(f"WITH {ATTRIBUTED_SQL} SELECT run_id, event_id, event_type, kind, operation_id, schedule_id, start_id FROM attributed")
def attributed_events(spark: SparkSession, d: str) -> DataFrame:
    """Every event of an operation with the operation, schedule and start that it belongs to, from unordered pages that overlap."""
    return attribution.attributed(log(spark, d)).select("run_id", "event_id", "event_type", "kind", "operation_id", "schedule_id", "start_id")


FOLDED_SQL = f"""{ATTRIBUTED_SQL},
    latest AS (
        SELECT run_id, kind, operation_id, schedule_id, start_id, arg_max(state, (ts, event_id)) AS state, bool_or(role <> 'schedule') AS more
        FROM attributed WHERE operation_id IS NOT NULL AND state IS NOT NULL GROUP BY ALL),
    tried AS (
        SELECT * FROM latest a WHERE start_id IS NOT NULL OR more
            OR NOT EXISTS (SELECT 1 FROM latest b WHERE b.run_id = a.run_id AND b.schedule_id = a.schedule_id AND b.start_id IS NOT NULL)),
    folded AS (
        SELECT run_id, kind, operation_id, count(*) AS attempts, count(*) FILTER (WHERE state = 'failed') AS fail_count,
               CASE WHEN bool_or(state = 'completed') THEN 'complete' WHEN bool_or(state = 'live') THEN 'live' WHEN bool_or(state = 'failed') THEN 'failed' ELSE 'pending' END AS status
        FROM tried GROUP BY ALL),
    ended AS (SELECT run_id, start_ref, arg_min(event_type, (ts, event_id)) AS how, min(ts) AS ended_at FROM log WHERE event_type IN ('TimerFired', 'TimerCanceled') GROUP BY ALL),
    timers AS (
        SELECT l.run_id, l.event_id AS timer_id, string_split(name, '!')[1] AS name, json_extract_string(details, '$.fn_identifier') AS operation_id, ts + to_seconds(CAST(json_extract_string(details, '$.timeout') AS BIGINT)) AS due_at, ended_at,
               CASE how WHEN 'TimerFired' THEN 'fired' WHEN 'TimerCanceled' THEN 'canceled' ELSE 'waiting' END AS state
        FROM log l LEFT JOIN ended e ON e.run_id = l.run_id AND e.start_ref = l.event_id WHERE l.event_type = 'TimerStarted')"""


@query(f"WITH {FOLDED_SQL} SELECT run_id, timer_id, name, operation_id, epoch_us(due_at) AS due_us, epoch_us(ended_at) AS ended_us, state FROM timers")
def run_timers(spark: SparkSession, d: str) -> DataFrame:
    """Timers paired with what fired or canceled them."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return attribution.timers(log(spark, d)).select("run_id", "timer_id", "name", "operation_id", us("due_at").alias("due_us"), us("ended_at").alias("ended_us"), "state")


@query(f"""
    WITH {FOLDED_SQL},
    held AS (SELECT run_id, operation_id, count(*) FILTER (WHERE state = 'waiting') AS waiting, count(*) FILTER (WHERE state = 'fired') AS fired FROM timers WHERE name = 'error_back_off' GROUP BY ALL),
    met AS (SELECT f.*, coalesce(waiting, 0) AS waiting, coalesce(fired, 0) AS fired FROM folded f LEFT JOIN held h ON h.run_id = f.run_id AND h.operation_id = f.operation_id),
    next AS (
        SELECT *, CASE WHEN waiting > 0 THEN 'pending' WHEN fail_count = 0 THEN NULL WHEN fail_count <> fired THEN 'due' ELSE 'spent' END AS back_off,
               CASE WHEN waiting > 0 THEN 'wait' WHEN status = 'complete' THEN 'done' WHEN status <> 'failed' THEN 'run' WHEN fail_count <> fired THEN 'back_off' ELSE 'restart' END AS step FROM met)
    SELECT run_id, kind, operation_id, attempts, fail_count, status, waiting, fired, back_off, step AS next, CASE WHEN step = 'back_off' THEN CAST(power(2, fail_count) AS BIGINT) END AS wait_seconds FROM next
""")
def operation_decisions(spark: SparkSession, d: str) -> DataFrame:
    """Attempts of activities, lambdas and subtasks folded, with back-off timers that are pending, due or spent."""
    rows = log(spark, d)
    folded = attribution.operations(attribution.attempts(attribution.attributed(rows)))
    return attribution.decisions(folded, attribution.timers(rows)).select("run_id", "kind", "operation_id", "attempts", "fail_count", "status", "waiting", "fired", "back_off", "next", "wait_seconds")


@query(f"""
    WITH {LOG_SQL}, marks AS (SELECT *, CASE WHEN details LIKE '{{%' THEN json_keys(details)[1] ELSE '' END AS key FROM log WHERE event_type = 'MarkerRecorded')
    SELECT run_id, name, key, arg_max(CASE WHEN key = '' THEN details ELSE json_extract_string(details, '$."' || key || '"') END, (ts, event_id)) AS value FROM marks GROUP BY ALL
""")
def run_markers(spark: SparkSession, d: str) -> DataFrame:
    """What markers say, the later one of a key."""
    return attribution.markers(log(spark, d))


@query(f"""
    WITH {LOG_SQL}
    SELECT run_id, event_id, name, details FROM log s WHERE event_type = 'WorkflowExecutionSignaled'
    AND NOT EXISTS (SELECT 1 FROM log m WHERE m.event_type = 'MarkerRecorded' AND m.name = 'signal' AND m.run_id = s.run_id AND json_exists(m.details, '$."' || CAST(s.event_id AS VARCHAR) || '"'))
""")
def run_signals(spark: SparkSession, d: str) -> DataFrame:
    """Signals that no marker has settled."""
    return attribution.open_signals(log(spark, d))


SIZES = "event_id * 7919 % 397 + CASE WHEN event_id % 97 = 0 THEN 2600 ELSE 1 END"
GREEDY_SQL = f"""
    r AS (SELECT event_type, event_id, {SIZES} AS size, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events),
    filled AS (
        SELECT event_type, event_id, size, n, size AS bytes, 1 AS rows, 0 AS batch FROM r WHERE n = 1
        UNION ALL
        SELECT r.event_type, r.event_id, r.size, r.n, CASE WHEN f.bytes + r.size > 2500 OR f.rows = 15 THEN r.size ELSE f.bytes + r.size END, CASE WHEN f.bytes + r.size > 2500 OR f.rows = 15 THEN 1 ELSE f.rows + 1 END, f.batch + CASE WHEN f.bytes + r.size > 2500 OR f.rows = 15 THEN 1 ELSE 0 END
        FROM filled f JOIN r ON r.event_type = f.event_type AND r.n = f.n + 1)
"""


@query(f"WITH RECURSIVE {GREEDY_SQL} SELECT event_type, event_id, batch FROM filled")
def greedy_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches in order under 2500 bytes and 15 rows, both of which bind; rows larger than a batch are alone."""
    rows = t(spark, d, "events").select("event_type", "event_id", F.expr(SIZES).alias("size"))
    return batching.greedy(rows, "event_type", ["event_id"], "size", 2500, 15, stretch=512, block=8).select("event_type", "event_id", "batch")


@query("""
    WITH r AS (SELECT event_type, event_id, length(props) + length(CAST(event_id AS VARCHAR)) AS size, CASE WHEN user_id % 11 = 0 THEN 'ProcessingFailed' ELSE 'Ok' END AS result FROM events),
    s AS (SELECT *, result = 'Ok' AND sum(CASE WHEN result = 'Ok' THEN size ELSE 0 END) OVER (PARTITION BY event_type ORDER BY event_id) > 6000 AS over FROM r)
    SELECT event_type, event_id, CASE WHEN over THEN 'Dropped' ELSE result END AS result,
           CASE WHEN over THEN CAST(floor((count(*) FILTER (WHERE over) OVER (PARTITION BY event_type ORDER BY event_id) - 1) / 50) AS BIGINT) END AS regroup
    FROM s
""")
def reingestion_cut(spark: SparkSession, d: str) -> DataFrame:
    """The first 6000 bytes of each response stay, later records leave again in groups of 50."""
    rows = t(spark, d, "events").select("event_type", "event_id", (F.length("props") + F.length(F.col("event_id").cast("string"))).alias("size"), F.when(F.col("user_id") % 11 == 0, "ProcessingFailed").otherwise("Ok").alias("result"))
    return batching.response_cut(rows, "event_type", ["event_id"], "size", most_bytes=6000, per_group=50).select("event_type", "event_id", "result", "regroup")


@query("""
    WITH a AS (SELECT user_id, count(*) AS attempts, bool_or(event_type IN ('purchase', 'signup')) AS put FROM events WHERE event_type <> 'view' GROUP BY 1)
    SELECT c_custkey AS record_id, coalesce(attempts, 0) AS attempts, CASE WHEN attempts IS NULL THEN 'new' WHEN put THEN 'put' WHEN attempts < 20 THEN 'retry' ELSE 'failed' END AS state
    FROM customer LEFT JOIN a ON a.user_id = c_custkey
""")
def reingestion_attempts(spark: SparkSession, d: str) -> DataFrame:
    """Records by the attempts to put them, at most 20."""
    tried = t(spark, d, "events").where("event_type <> 'view'").select(F.col("user_id").alias("record_id"), F.col("event_id").alias("attempt"), F.when(~F.col("event_type").isin("purchase", "signup"), F.col("event_type")).otherwise("").alias("error_code"))
    return batching.retried(t(spark, d, "customer").select(F.col("c_custkey").alias("record_id")), tried, "record_id")


STAGE_OF = "CASE event_type WHEN 'signup' THEN 'monitoring' WHEN 'view' THEN 'extraction' WHEN 'click' THEN 'transformation' WHEN 'purchase' THEN 'assimilation' ELSE 'graphing' END"


@query(f"""
    WITH s AS (SELECT user_id || '-' || event_id % 23 AS item, {STAGE_OF} AS stage, epoch_us(ts) // 1000 AS ms FROM events),
    i AS (
        SELECT item, max(ms) AS ms, bool_or(stage = 'monitoring') AS m, bool_or(stage = 'extraction') AS e, bool_or(stage = 'transformation') AS t, bool_or(stage = 'assimilation') AS a, bool_or(stage = 'graphing') AS g FROM s GROUP BY 1),
    r AS (SELECT *, CASE WHEN NOT m THEN 0 WHEN NOT e THEN 1 WHEN NOT t THEN 2 WHEN NOT a THEN 3 WHEN NOT g THEN 4 ELSE 5 END AS stages FROM i),
    n AS (SELECT *, ['monitoring', 'extraction', 'transformation', 'assimilation', 'graphing'][stages] AS stage FROM r)
    SELECT item, 'stage' AS kind, stage, stages, NULL AS repair, ms AS at_ms FROM n WHERE stages > 0
    UNION ALL
    SELECT item, 'repair', stage, stages, CASE stages WHEN 0 THEN 'extract' WHEN 1 THEN 'extract' WHEN 2 THEN 'extract' WHEN 3 THEN 'transform' ELSE 'assimilate' END, ms FROM n
    WHERE stages < 5 AND ms + 30 * 60000 <= (SELECT max(ms) - 10 * 60000 FROM s)
""")
def stream_item_states(spark: SparkSession, d: str) -> DataFrame:
    """items' stages in a stream, each stage after the ones before it, with a timer for what stalls; time is the events'."""
    folder = new_folder(spark, "items")
    rows = spark.readStream.schema(t(spark, d, "events").schema).parquet(f"{d}/events.parque[t]")
    stream = rows.select(F.concat(F.col("user_id").cast("string"), F.lit("-"), (F.col("event_id") % 23).cast("string")).alias("item"), F.expr(STAGE_OF).alias("stage"), F.col("ts").cast("timestamp").alias("at"))
    states = item_states.item_states(stream.withWatermark("at", "10 minutes"), 30, gated=True, event_time=True)
    store, provider = "spark.sql.streaming.stateStore.providerClass", item_states.ROCKS
    before = spark.conf.get(store)
    spark.conf.set(store, provider)
    try:
        started = states.writeStream.outputMode("update").foreachBatch(lambda batch, n: batch.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start()
        started.awaitTermination()
    finally:
        spark.conf.set(store, before)
    return spark.read.schema(item_states.OUTPUT).parquet(f"{folder}/out").select("item", "kind", "stage", "stages", "repair", F.unix_millis("at").alias("at_ms"))
