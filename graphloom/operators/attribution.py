"""Raw workflow logs: each event is given its operation and attempt by the ids it refers to, then folded with timers, markers and signals.

A raw event has run_id, event_id (unique in its run), ts, event_type and the attributes of its type: operation_key (on schedules, refusals and
cancel requests), schedule_ref and start_ref (the ids of the events that scheduled and started what it ends), name and details (timers, markers,
signals). Rows may come in any order; pages that arrive again repeat rows, which count once. References are resolved by joins of the log with itself on
(run, kind, id), keys that few rows share however long a run is.

What refers to no known schedule keeps its row with operation_id null. An end whose start isn't known, or is another schedule's, is kept apart: it belongs to
its operation and schedule, as an attempt without a start.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators import history


@dataclass(frozen=True)
class Kind:
    """Event names of one kind of operation. ends: name of the event and the state that it gives the attempt."""

    name: str
    schedule: str
    schedule_state: str
    start: str
    refused: tuple[str, ...]
    ends: tuple[tuple[str, str], ...]
    asked: tuple[str, ...] = ()


#: Fixed event names and what they mean for an attempt.
KINDS = (
    Kind("activity", "ActivityTaskScheduled", "pending", "ActivityTaskStarted", ("ScheduleActivityTaskFailed",), (("ActivityTaskCompleted", "completed"), ("ActivityTaskFailed", "failed"), ("ActivityTaskTimedOut", "failed"), ("ActivityTaskCanceled", "failed")), ("ActivityTaskCancelRequested",)),
    Kind("lambda", "LambdaFunctionScheduled", "live", "LambdaFunctionStarted", ("ScheduleLambdaFunctionFailed",), (("LambdaFunctionCompleted", "completed"), ("LambdaFunctionFailed", "failed"), ("LambdaFunctionTimedOut", "failed"), ("StartLambdaFunctionFailed", "failed"))),
    Kind("subtask", "StartChildWorkflowExecutionInitiated", "live", "ChildWorkflowExecutionStarted", ("StartChildWorkflowExecutionFailed",), (("ChildWorkflowExecutionCompleted", "completed"), ("ChildWorkflowExecutionFailed", "failed"), ("ChildWorkflowExecutionTimedOut", "failed"), ("ChildWorkflowExecutionCanceled", "failed"), ("ChildWorkflowExecutionTerminated", "failed"))),
)
BACK_OFF = "error_back_off"


def roles(kinds: tuple[Kind, ...] = KINDS) -> dict[str, tuple[str, str, str | None]]:
    """event type -> (kind, role, state)."""
    found: dict[str, tuple[str, str, str | None]] = {}
    for k in kinds:
        found[k.schedule] = (k.name, "schedule", k.schedule_state)
        found[k.start] = (k.name, "start", "live")
        found |= {name: (k.name, "refused", "failed") for name in k.refused} | {name: (k.name, "end", state) for name, state in k.ends} | {name: (k.name, "asked", None) for name in k.asked}
    return found


def once(events: DataFrame) -> DataFrame:
    """Each event of a run once: pages that came again repeat it with equal attributes."""
    return events.dropDuplicates(["run_id", "event_id"])


def typed(events: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """Events of operations with kind, role and state."""
    table = roles(kinds)
    of = F.create_map(*(x for name, (kind, role, state) in table.items() for x in (F.lit(name), F.struct(F.lit(kind).alias("kind"), F.lit(role).alias("role"), F.lit(state).cast("string").alias("state")))))
    known = once(events.where(F.col("event_type").isin(*table))).withColumn("_of", of[F.col("event_type")])
    return known.select("run_id", "event_id", "ts", "event_type", "operation_key", "schedule_ref", "start_ref", "_of.kind", "_of.role", "_of.state")


def attributed(events: DataFrame, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(run_id, event_id, ts, event_type, kind, role, state, operation_id, schedule_id, start_id) of each event of an operation.

    start_id is null for schedules and refusals (a refusal is an attempt of its own, its schedule_id is its own id), cancel requests and ends without a start.
    """
    rows = typed(events, kinds)
    schedules = rows.where("role = 'schedule'").select("run_id", "kind", F.col("event_id").alias("schedule_ref"), F.col("operation_key").alias("_operation"))
    starts = rows.where("role = 'start'").select("run_id", "kind", "schedule_ref", F.col("event_id").alias("start_ref"), F.lit(True).alias("_started"))
    named = rows.where("role in ('schedule', 'refused', 'asked')").withColumn("schedule_id", F.when(F.col("role") != "asked", F.col("event_id"))).withColumn("start_id", F.lit(None).cast("bigint")).withColumn("operation_id", F.col("operation_key"))
    met = rows.where("role in ('start', 'end')").join(schedules, ["run_id", "kind", "schedule_ref"], "left").join(starts, ["run_id", "kind", "schedule_ref", "start_ref"], "left")
    start = F.when(F.col("role") == "start", F.col("event_id")).when(F.col("_started"), F.col("start_ref"))
    found = met.withColumn("operation_id", F.col("_operation")).withColumn("schedule_id", F.when(F.col("_operation").isNotNull(), F.col("schedule_ref"))).withColumn("start_id", F.when(F.col("_operation").isNotNull(), start))
    shown = ["run_id", "event_id", "ts", "event_type", "kind", "role", "state", "operation_id", "schedule_id", "start_id"]
    return named.select(*shown).unionByName(found.select(*shown))


ATTEMPT = ("run_id", "kind", "operation_id", "schedule_id", "start_id")


def attempts(events: DataFrame) -> DataFrame:
    """(run_id, kind, operation_id, schedule_id, start_id, state, at): the latest event of each attempt, of events that attributed() gives.

    A schedule is an attempt while nothing has started for it; after that its starts are, and ends without a start beside them.
    """
    own = events.where("operation_id is not null and state is not null")
    per = own.groupBy(*ATTEMPT).agg(F.max_by("state", F.struct("ts", "event_id")).alias("state"), F.max("ts").alias("at"), F.bool_or(F.col("role") != "schedule").alias("_more"))
    begun = F.max("start_id").over(Window.partitionBy(*ATTEMPT[:-1])).isNotNull()
    return per.withColumn("_begun", begun).where("start_id is not null or _more or not _begun").drop("_more", "_begun")


def operations(tried: DataFrame) -> DataFrame:
    """Attempts folded to (run_id, kind, operation_id, attempts, fail_count, status, ...)."""
    return history.operations(tried, ("run_id", "kind", "operation_id"))


def timers(events: DataFrame) -> DataFrame:
    """(run_id, timer_id, name, operation_id, started_at, due_at, ended_at, state): TimerStarted paired with the first TimerFired or TimerCanceled that refers to it.

    name: the timer's id up to its first `!`; details is JSON with fn_identifier, the operation that it holds back, and timeout in seconds.
    """
    rows = once(events.where(F.col("event_type").isin("TimerStarted", "TimerFired", "TimerCanceled")))
    detail = F.from_json("details", "fn_identifier string, timeout bigint")
    started = rows.where("event_type = 'TimerStarted'").select("run_id", F.col("event_id").alias("timer_id"), F.split("name", "!")[0].alias("name"), detail.alias("_d"), F.col("ts").alias("started_at"))
    ended = rows.where("event_type <> 'TimerStarted'").groupBy("run_id", F.col("start_ref").alias("timer_id")).agg(F.min(F.struct("ts", "event_id", "event_type")).alias("_e"))
    state = F.when(F.col("_e.event_type") == "TimerFired", "fired").when(F.col("_e").isNotNull(), "canceled").otherwise("waiting")
    due = F.timestamp_micros(F.unix_micros(F.col("started_at").cast("timestamp")) + F.col("_d.timeout") * 1_000_000)
    return started.join(ended, ["run_id", "timer_id"], "left").select("run_id", "timer_id", "name", F.col("_d.fn_identifier").alias("operation_id"), "started_at", due.alias("due_at"), F.col("_e.ts").alias("ended_at"), state.alias("state"))


def back_off_seconds(fail_count: Column, jitter: Column) -> Column:
    return history.back_off(fail_count, jitter)


def decisions(folded: DataFrame, timed: DataFrame, jitter: Column | None = None) -> DataFrame:
    """folded operations with what their back-off timers say and what happens next.

    back_off: pending while a timer waits, due when there are other failures than fired timers, spent when every failure has been waited for. next: wait for a
    pending timer, else done, back_off (start a timer of wait_seconds), restart, run (it is live or was scheduled). Canceled timers count for nothing.
    """
    held = timed.where(F.col("name") == BACK_OFF).groupBy("run_id", "operation_id").agg(F.count_if(F.col("state") == "waiting").alias("waiting"), F.count_if(F.col("state") == "fired").alias("fired"), F.max(F.when(F.col("state") == "waiting", F.col("due_at"))).alias("due_at"))
    met = folded.join(held, ["run_id", "operation_id"], "left").fillna(0, ["waiting", "fired"])
    back_off = F.when(F.col("waiting") > 0, "pending").when(F.col("fail_count") == 0, F.lit(None)).when(F.col("fail_count") != F.col("fired"), "due").otherwise("spent")
    step = F.when(F.col("waiting") > 0, "wait").when(F.col("status") == "complete", "done").when(F.col("is_failed") & (F.col("fail_count") != F.col("fired")), "back_off").when(F.col("is_failed"), "restart").otherwise("run")
    wait = F.when(step == "back_off", back_off_seconds(F.col("fail_count"), F.lit(0.0) if jitter is None else jitter))
    return met.withColumn("back_off", back_off).withColumn("next", step).withColumn("wait_seconds", wait)


def markers(events: DataFrame) -> DataFrame:
    """(run_id, name, key, value): entries of MarkerRecorded's JSON details by name; of one key the later value stays. Details that are no object have the key ''."""
    rows = once(events.where("event_type = 'MarkerRecorded'"))
    object_ = F.from_json("details", "map<string,string>")
    entries = F.when(F.col("details").startswith("{") & object_.isNotNull(), object_).otherwise(F.create_map(F.lit(""), F.col("details")))
    each = rows.select("run_id", "name", "ts", "event_id", F.explode(entries).alias("key", "value"))
    return each.groupBy("run_id", "name", "key").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))


def open_signals(events: DataFrame) -> DataFrame:
    """(run_id, event_id, name, details) of WorkflowExecutionSignaled for which the same run has no marker `signal` with the signal's event id as a key."""
    signals = once(events.where("event_type = 'WorkflowExecutionSignaled'")).select("run_id", "event_id", "name", "details")
    done = markers(events.where("name = 'signal'")).select("run_id", F.col("key").try_cast("bigint").alias("event_id"))
    return signals.join(done, ["run_id", "event_id"], "left_anti")


def chain_steps(plan: DataFrame, folded: DataFrame) -> DataFrame:
    """(run_id, chain_id, steps, completed, step, operation_id, action) of chains (run_id, chain_id, step, operation_id), whose steps run one after the other.

    The first step that isn't complete decides: start it if it has no attempt, retry it if it failed, else wait; done when all are complete. A later step's state counts for nothing before that.
    """
    met = plan.join(folded.select("run_id", "operation_id", "status"), ["run_id", "operation_id"], "left")
    undone = F.col("status").isNull() | (F.col("status") != "complete")
    here = F.min_by(F.struct("step", "operation_id", "status"), F.when(undone, F.col("step")))
    found = met.groupBy("run_id", "chain_id").agg(F.count("*").alias("steps"), F.count_if(~undone).alias("completed"), here.alias("_h"))
    action = F.when(F.col("completed") == F.col("steps"), "done").when(F.col("_h.status").isNull(), "start").when(F.col("_h.status") == "failed", "retry").otherwise("wait")
    open_ = action != "done"
    return found.select("run_id", "chain_id", "steps", "completed", F.when(open_, F.col("_h.step")).alias("step"), F.when(open_, F.col("_h.operation_id")).alias("operation_id"), action.alias("action"))


def group_starts(plan: DataFrame, folded: DataFrame, caps: DataFrame) -> DataFrame:
    """plan (run_id, group_id, position, operation_id, config) with `action`, for groups whose members run in parallel under caps (config, cap) of live operations in a run.

    Members that have no attempt are started in order of position while the run's live operations of the config leave room, else held; failed ones are retried, others run or are done. Without a cap there is none.
    """
    met = plan.join(folded.select("run_id", "operation_id", "status"), ["run_id", "operation_id"], "left").join(caps, "config", "left")
    live = met.groupBy("run_id", "config").agg(F.count_if(F.col("status").isin("live", "pending")).alias("_live"))
    waiting = Window.partitionBy("run_id", "config", F.col("status").isNull()).orderBy("position", "operation_id")
    ranked = met.withColumn("_turn", F.row_number().over(waiting)).join(live, ["run_id", "config"])
    room = F.col("cap").isNull() | (F.col("_live") + F.col("_turn") <= F.col("cap"))
    action = F.when(F.col("status").isNull(), F.when(room, "start").otherwise("hold")).when(F.col("status") == "failed", "retry").when(F.col("status") == "complete", "done").otherwise("run")
    return ranked.select("run_id", "group_id", "position", "operation_id", "config", action.alias("action"))
