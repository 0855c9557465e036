"""Workflow histories: an event log folded into attempts and operations, back-off, checkpoints, concurrency.

An event has event_id, ts, event_type, operation_id, started_id (the scheduling event of its attempt) and reason. Events
are attributed to their own attempt only, by started_id; ties in time are broken by event_id. A failed child counts as failed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Fixed event names by kind of operation: what is live, failed, completed.
KINDS = {
    "activity": {"live": ("ActivityTaskStarted",), "failed": ("ActivityTaskFailed", "ActivityTaskTimedOut", "ScheduleActivityTaskFailed"), "completed": ("ActivityTaskCompleted",), "pending": ("ActivityTaskScheduled",)},
    "lambda": {"live": ("LambdaFunctionScheduled", "LambdaFunctionStarted"), "failed": ("LambdaFunctionFailed", "LambdaFunctionTimedOut", "ScheduleLambdaFunctionFailed", "StartLambdaFunctionFailed"), "completed": ("LambdaFunctionCompleted",), "pending": ()},
    "subtask": {"live": ("StartChildWorkflowExecutionInitiated", "ChildWorkflowExecutionStarted"), "failed": ("StartChildWorkflowExecutionFailed", "ChildWorkflowExecutionFailed", "ChildWorkflowExecutionTimedOut", "ChildWorkflowExecutionCanceled", "ChildWorkflowExecutionTerminated"), "completed": ("ChildWorkflowExecutionCompleted",), "pending": ()},
}


def state_of(event_type: Column, kinds: dict = KINDS) -> Column:
    """live, failed, completed or pending, by the kind that the event type belongs to; null for others."""
    found = F.lit(None).cast("string")
    for kind in kinds.values():
        for state, names in kind.items():
            if names:
                found = F.when(event_type.isin(*names), state).otherwise(found)
    return found


def attempts(events: DataFrame, state: str = "state") -> DataFrame:
    """(operation_id, started_id, state, at): each attempt's latest event."""
    latest = F.struct("ts", "event_id")
    return events.where(f"{state} is not null").groupBy("operation_id", "started_id").agg(F.max_by(state, latest).alias("state"), F.max("ts").alias("at"))


def operations(tried: DataFrame, by: tuple[str, ...] = ("operation_id",)) -> DataFrame:
    """(operation_id or what it is told apart by, attempts, fail_count, is_live, is_complete, is_failed, status). A live attempt outweighs failures, a completed one everything."""
    per = tried.groupBy(*by).agg(F.count("*").alias("attempts"), F.count_if(F.col("state") == "failed").alias("fail_count"), F.bool_or(F.col("state") == "live").alias("is_live"), F.bool_or(F.col("state") == "completed").alias("is_complete"))
    failed = ~F.col("is_complete") & ~F.col("is_live") & (F.col("fail_count") > 0)
    status = F.when(F.col("is_complete"), "complete").when(F.col("is_live"), "live").when(failed, "failed").otherwise("pending")
    return per.withColumn("is_failed", failed).withColumn("status", status)


def results(executions: DataFrame, key: str = "operation_id", value: str = "result") -> DataFrame:
    """The one distinct result of each operation; two different ones are an error."""
    single = executions.where(F.col(value).isNotNull()).groupBy(key).agg(F.count_distinct(value).alias("_n"), F.any_value(value).alias(value))
    return single.select(key, F.when(F.col("_n") == 1, F.col(value)).otherwise(F.raise_error(F.concat(F.lit("several results of "), F.col(key).cast("string"))).cast(executions.schema[value].dataType)).alias(value))


def with_checkpoints(folded: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """A checkpoint (operation_id, result) makes an operation complete, whatever its events say."""
    saved = checkpoints.groupBy("operation_id").agg(F.max_by("result", "seq").alias("checkpoint"))
    return folded.join(saved, "operation_id", "full").withColumn("status", F.when(F.col("checkpoint").isNotNull(), "complete").otherwise(F.col("status")))


def back_off(fail_count: Column, jitter: Column) -> Column:
    """Whole seconds to wait: 2 ** n plus jitter of 0 to 1."""
    return F.round(F.pow(F.lit(2), fail_count) + jitter).cast("bigint")


def pending(signals: DataFrame, done: DataFrame, key: str = "signal_id") -> DataFrame:
    return signals.join(done.select(key), key, "left_anti")


def group_state(folded: DataFrame, by: str) -> DataFrame:
    """Members of a group that run in parallel: started if any is, complete if all are, failed if any is."""
    return folded.groupBy(by).agg(F.bool_or(F.col("status") != "pending").alias("started"), F.bool_and(F.col("status") == "complete").alias("complete"), F.bool_or(F.col("status") == "failed").alias("failed"), F.sum("fail_count").alias("fail_count"))


def concurrency(folded: DataFrame, by: str) -> DataFrame:
    return folded.groupBy(by).agg(F.count_if("is_live").alias("live"), F.count("*").alias("operations"))


def moving_average(rows: DataFrame, by: str, order: str, value: str, last: int = 500) -> DataFrame:
    """The average over up to `last` values so far, per partition key."""
    return rows.withColumn("moving_average", F.avg(value).over(Window.partitionBy(by).orderBy(order).rowsBetween(-(last - 1), 0)))


def stalled(items: DataFrame, as_of: str, minutes: int = 30) -> DataFrame:
    """Items last seen longer ago, not yet graphing, with the stage that repairs them."""
    old = items.where((F.col("last_time_seen") < F.lit(as_of).cast("timestamp") - F.expr(f"interval {minutes} minutes")) & (F.col("stage") != "graphing"))
    return old.withColumn("repair", F.when(F.col("stage").isin("monitoring", "extraction"), "extract").when(F.col("stage") == "transformation", "transform").when(F.col("stage") == "assimilation", "assimilate").otherwise("graph"))


STAGES = ("monitoring", "extraction", "transformation", "assimilation", "graphing", "processing")


def latest_stage(states: DataFrame) -> DataFrame:
    """Per item its latest stage: a stage counts once, the furthest one wins at equal times."""
    place = F.array_position(F.array(*map(F.lit, STAGES)), F.col("stage"))
    return states.withColumn("_at", F.struct("stage_ts", place)).groupBy("identifier_stem", "sid_value").agg(F.max_by("stage", "_at").alias("stage"), F.max("stage_ts").alias("stage_ts"), F.count_distinct("stage").alias("stages"))


def completion_last(decisions: DataFrame, run: str = "run_id", sequence: str = "sequence", kind: str = "kind", closing: tuple[str, ...] = ("CompleteWorkflowExecution", "FailWorkflowExecution", "CancelWorkflowExecution")) -> DataFrame:
    """decisions with their place in each run: in order, those that close the run after all others."""
    order = Window.partitionBy(run).orderBy(F.col(kind).isin(*closing), sequence)
    return decisions.withColumn("place", F.row_number().over(order))


def open_markers(markers: DataFrame, subtasks: DataFrame, key: str = "operation_id") -> DataFrame:
    """Worker markers that are open though their subtask has completed: inner join on the operation."""
    done = subtasks.where("status = 'complete'").select(key)
    return markers.where("is_open").join(done, key)


def reused(checkpoints: DataFrame, as_of: str, days: int = 2) -> DataFrame:
    """Checkpoints of past runs that may be reused: those of the last days, the latest of each operation."""
    recent = checkpoints.where(F.col("ts") >= F.lit(as_of).cast("timestamp") - F.expr(f"interval {days} days"))
    return recent.groupBy("operation_id").agg(F.max_by("result", F.struct("ts", "seq")).alias("result"), F.max("seq").alias("seq"))


def tree(flows: DataFrame, run: str = "run_id", parent: str = "parent_id") -> DataFrame:
    """(parent, child) pairs of workflow runs, for closure()."""
    return flows.where(f"{parent} is not null").select(F.col(parent).alias("parent"), F.col(run).alias("child"))
