"""Structured Streaming: change-stream triggers, log parsing, first-wins sinks; item_states.py has the item state machine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import invocation_fields, log_fields, log_kind

CHANGE = "event_name string, identifier_stem string, sid_value string, new struct<disposition:string,progress:map<string,boolean>>, old struct<disposition:string,progress:map<string,boolean>>"


def changes(records: DataFrame, column: str = "value") -> DataFrame:
    """Change-stream records of JSON text."""
    return records.select(F.from_json(F.col(column), CHANGE).alias("_c")).select("_c.*")


def is_ready(new: Column, old: Column) -> Column:
    """All assimilation flags are true now and some was not before."""
    every = F.forall(F.map_values(new), lambda x: F.coalesce(x, F.lit(False)))
    some = F.exists(F.map_values(old), lambda x: ~F.coalesce(x, F.lit(False)))
    return F.coalesce((F.size(F.map_values(new)) > 0) & every & some, F.lit(False))


def load_orders(stream: DataFrame) -> DataFrame:
    """Items to load: inserted as graphing, or modified so that their assimilation is complete. Works on a stream and on a table."""
    inserted = (F.col("event_name") == "INSERT") & (F.col("new.disposition") == "graphing")
    modified = (F.col("event_name") == "MODIFY") & is_ready(F.col("new.progress"), F.col("old.progress"))
    return stream.where(F.coalesce(inserted, F.lit(False)) | modified).select("identifier_stem", "sid_value", F.when(F.col("event_name") == "INSERT", "insert").otherwise("assimilated").alias("reason"))


def log_lines(stream: DataFrame, column: str = "message") -> DataFrame:
    """Parsed log lines by kind."""
    kind = log_kind(F.col(column))
    return stream.select("*", kind.alias("kind"), F.when(kind == "python", log_fields(F.col(column))).alias("python"), F.when(kind == "invocation", invocation_fields(F.col(column))).alias("invocation"))


def first_wins_sink(path: str, *keys: str, order: str | None = None, buckets: int = 32) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that keeps the first row of a key: the one of the smallest `order` in its batch, or any of them.

    Rows lie in folders by a hash of their key and by batch. A batch reads the keys of its own buckets only, and a batch that is run again replaces its own folders, so it writes nothing new.
    For streams of very many keys keep them in the state store instead (dropDuplicates), which reads only what a batch asks for.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        exists = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
        rest = [c for c in batch.columns if c not in keys]
        chosen = F.min_by(F.struct(*rest), order) if order else F.first(F.struct(*rest))
        new = batch.groupBy(*keys).agg(chosen.alias("_r")).select(*keys, "_r.*") if rest else batch.distinct()
        new = new.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:
            rows = new
            if exists:
                touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]  # buckets at most
                stored = spark.read.parquet(path).where(F.col("bucket").isin(touched) & (F.col("batch_id") != batch_id))
                rows = new.join(stored.select("bucket", *keys), ["bucket", *keys], "left_anti")
            rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "batch_id").parquet(path)
        finally:
            new.unpersist()

    return write


def by_destination(destinations: dict[str, Callable[[DataFrame], None]], column: str = "destination") -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that hands each destination its rows of the batch, which is computed once."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, send in destinations.items():
                send(batch.where(F.col(column) == name))
        finally:
            batch.unpersist()

    return write


def windowed_counts(stream: DataFrame, moment: str, by: str, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Event counts per window; moment must be a TIMESTAMP (cast TIMESTAMP_NTZ first)."""
    return stream.withWatermark(moment, late).groupBy(F.window(moment, length), by).agg(F.count("*").alias("events"))
