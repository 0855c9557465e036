"""Shared helpers: reading tables, cutting lineage in the shared folder, Arrow batch plumbing."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Bytes of an Arrow batch between Spark and a Python worker.
BATCH_BYTES = 16 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Ask the session for Arrow batches of at most BATCH_BYTES, as rows may be long texts: both sides of every Python stage hold whole batches. Changes memory, never results."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(name).rstrip("bB")) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only a local session without one gets a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="graphloom-"))
    return context._jsc.sc().getCheckpointDir().get().rstrip("/")


def new_folder(spark: SparkSession, tag: str) -> str:
    """A new folder below the application's own one in the shared folder, which goes when the driver's JVM ends."""
    base = f"{shared_dir(spark)}/graphloom/{spark.sparkContext.applicationId}"
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    files = own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(own)
    files.deleteOnExit(own)
    return f"{base}/{tag}-{uuid.uuid4().hex[:12]}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


LOCK, WRITING = threading.Lock(), {}


@contextmanager
def cleaning(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go with the query that made them; the session's own setting returns when the last of several writers is done."""
    with LOCK:
        count, before = WRITING.get(id(spark), (0, spark.conf.get(CLEANUP, "false")))
        WRITING[id(spark)] = count + 1, before
        spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        with LOCK:
            count, before = WRITING.pop(id(spark))
            if count > 1:
                WRITING[id(spark)] = count - 1, before
            else:
                spark.conf.set(CLEANUP, before)


def materialize(df: DataFrame, tag: str, **options: object) -> tuple[DataFrame, str]:
    """Write df as Parquet in the shared folder and read it back: later plans start from files that outlive executors, and the shuffle files that made them go at once. options are the writer's."""
    spark = df.sparkSession
    bounded_batches(spark)
    path = new_folder(spark, tag)
    schema = df.schema
    with cleaning(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(schema).parquet(path), path


def forget(spark: SparkSession, *paths: str) -> None:
    """Remove folders made by materialize() that no later plan reads."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, name: str) -> str:
    """name, or one like it that df has no column of."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def partitions_for(docs: DataFrame, text: str, most_bytes: int = 64 << 20) -> int:
    """Tasks for work on docs' texts: the session's shuffle partitions, or more so that none gets more than about most_bytes."""
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return max(shuffle_partitions(docs.sparkSession), -(-total // most_bytes))


def bucket_ids(spark: SparkSession, partitions: int) -> list[int]:
    """For each of so many shuffle partitions a number that repartition() by that number sends there: even buckets, one a task."""
    numbers = spark.range(16 * partitions + 64).select(F.col("id").cast("int").alias("id"))
    rows = numbers.groupBy(F.pmod(F.hash("id"), F.lit(partitions)).alias("p")).agg(F.min("id").alias("id")).collect()
    found = {r["p"]: r["id"] for r in rows}
    return [found.get(p, p) for p in range(partitions)]


def slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about most_bytes of the named column (one row at least)."""
    for batch in batches:
        size = max(1, batch.column(column).nbytes)
        step = max(1, int(batch.num_rows * most_bytes / size))
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The column's strings; null counts as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


class Kept:
    """Results by string key in bounded memory: when the younger half is full it becomes the older one, and what is still used moves on. Keys count once, and once more for each 256 characters, so long ones fill a half sooner."""

    def __init__(self, most: int):
        self.half, self.young, self.old, self.used = max(1, most // 2), {}, {}, 0

    @staticmethod
    def weight(keys: set) -> int:
        return len(keys) + (sum(map(len, keys)) >> 8)

    def of(self, keys: list, find) -> dict:
        """A dict that has all keys; find(keys) gives the results of keys not kept."""
        young, old = self.young, self.old
        new = {k for k in keys if k not in young}
        if new:
            self.used += self.weight(new)
            if self.used > self.half:
                self.old, self.young = old, young = young, {}
                new = set(keys)
                self.used = self.weight(new)
            fresh = []
            for k in new:
                found = old.get(k)
                if found is None:
                    fresh.append(k)
                else:
                    young[k] = found
            if fresh:
                young.update(zip(fresh, find(fresh), strict=True))
        return young


class Frequent:
    """Counts of the more frequent values of a stream in bounded memory; rare ones are dropped now and then."""

    def __init__(self, most: int = 150_000, block: int = 1 << 20):
        self.most, self.block, self.waiting, self.size = most, block, [], 0
        self.values, self.counts = np.empty(0, np.uint64), np.empty(0, np.int64)

    def add(self, x: np.ndarray) -> None:
        self.waiting.append(x)
        self.size += len(x)
        if self.size >= self.block:
            self.settle()

    def settle(self) -> None:
        new, times = np.unique(np.concatenate([*self.waiting, np.empty(0, np.uint64)]), return_counts=True)
        values, counts = np.concatenate([self.values, new]), np.concatenate([self.counts, times])
        self.waiting, self.size = [], 0
        if not len(values):
            return
        order = np.argsort(values, kind="stable")
        starts = np.flatnonzero(np.append(True, values[order][1:] != values[order][:-1]))
        values, counts = values[order][starts], np.add.reduceat(counts[order], starts)
        if len(values) > self.most:
            keep = counts > max(1, np.partition(counts, len(counts) - self.most)[len(counts) - self.most])
            values, counts = values[keep], counts[keep]
        self.values, self.counts = values, counts

    def found(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        keep = self.counts >= least
        return self.values[keep], self.counts[keep]
