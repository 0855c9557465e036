"""A property graph in files: vertices by type and edges by label, in hashed buckets, behind a manifest.

An upsert writes the buckets that it touches anew, beside the old files, and then one manifest that names them, with a number that nobody else can take. What
fails before that leaves files that no manifest names; what is repeated after it finds everything there. Readers use the newest manifest, so they see
an upsert whole or not at all, and read only the buckets that they ask for.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators.ordering import written

VERTEX = "internal_id string, object_type string, props map<string,string>"
EDGE = "internal_id string, edge_label string, src_id string, dst_id string, props map<string,string>"
KINDS = {"vertices": ("object_type", VERTEX), "edges": ("edge_label", EDGE)}


class GraphStore:
    """folder: in a file system that driver and executors share. buckets: fixed when the store is made; a bucket should be some hundred MB."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.jvm = spark.sparkContext._jvm
        self.files = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.buckets = self.manifest().get("buckets", buckets)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def version(self) -> int:
        """The newest manifest's number; 0 for an empty store."""
        if not self.files.exists(self._path("manifests")):
            return 0
        return max((int(s.getPath().getName().removesuffix(".json")) for s in self.files.listStatus(self._path("manifests")) if s.getPath().getName().endswith(".json")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """{"buckets": n, "vertices": {type: {bucket: folder}}, "edges": {label: {bucket: folder}}}."""
        number = self.version() if version is None else version
        if not number:
            return {"vertices": {}, "edges": {}}
        stream = self.files.open(self._path(f"manifests/{number:012d}.json"))
        try:
            return json.loads(self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, number: int, manifest: dict) -> None:
        """Written under another name, then renamed: the number is taken whole or not at all, and only once."""
        hidden, target = self._path(f"manifests/.{uuid.uuid4().hex}"), self._path(f"manifests/{number:012d}.json")
        stream = self.files.create(hidden, False)
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        stream.close()
        if self.files.exists(target) or not self.files.rename(hidden, target):
            self.files.delete(hidden, False)
            raise RuntimeError(f"another writer made version {number}; repeat the upsert")

    def bucket(self, ids: Column) -> Column:
        return F.pmod(F.xxhash64(ids), F.lit(self.buckets)).cast("int")

    def _stored(self, kind: str, found: dict, wanted: Iterable[tuple[str, int]] | None = None) -> DataFrame:
        schema = KINDS[kind][1]
        chosen = None if wanted is None else set(wanted)
        paths = [path for of, buckets in found[kind].items() for bucket, path in buckets.items() if chosen is None or (of, int(bucket)) in chosen]
        return self.spark.read.schema(schema).parquet(*(f"{self.folder}/{p}" for p in paths)) if paths else self.spark.createDataFrame([], schema)

    def read(self, kind: str, *of: str, ids: list[str] | None = None, version: int | None = None) -> DataFrame:
        """Vertices or edges of the given types or labels (all without any); with ids only the buckets that may hold them are read."""
        found = self.manifest(version)
        types = list(of) or list(found[kind])
        buckets = range(self.buckets)
        if ids is not None:
            listed = self.spark.createDataFrame([(i,) for i in ids], "id string")
            buckets = [r[0] for r in listed.select(self.bucket(F.col("id"))).distinct().collect()]
        rows = self._stored(kind, found, [(name, b) for name in types for b in buckets])
        return rows if ids is None else rows.where(F.col("internal_id").isin(*ids))

    def _merged(self, kind: str, new: DataFrame, found: dict, run: str) -> dict[str, dict[str, str]]:
        """Write the touched buckets with what is new in them; where they are. Buckets to which nothing is new aren't written."""
        column, _ = KINDS[kind]
        names = [c.strip().split(" ")[0] for c in KINDS[kind][1].split(", ")]
        first = new.where("internal_id is not null").groupBy("internal_id").agg(F.min_by(F.struct(*names[1:]), "_order").alias("_r"))
        one = written(first.select("internal_id", "_r.*").withColumn("bucket", self.bucket(F.col("internal_id"))), kind)
        spots = lambda rows: [(r[column], r["bucket"]) for r in rows.select(column, "bucket").distinct().collect()]  # noqa: E731  types times buckets at most
        stored = self._stored(kind, found, spots(one))
        added = written(one.join(stored.select("internal_id"), "internal_id", "left_anti"), kind)
        touched = spots(added)
        if not touched:
            return {}
        kept = self._stored(kind, found, touched).withColumn("bucket", self.bucket(F.col("internal_id")))
        whole = added.select(*names, "bucket").unionByName(kept.select(*names, "bucket"))
        base = f"{kind}/{run}"
        whole.withColumn("_of", F.md5(column)).repartition(max(1, min(len(touched), 4096)), column, "bucket").write.partitionBy("_of", "bucket").parquet(f"{self.folder}/{base}")
        hashes = {r["_of"]: r[column] for r in self.spark.createDataFrame([(c,) for c in {c for c, _ in touched}], f"{column} string").withColumn("_of", F.md5(column)).collect()}
        made: dict[str, dict[str, str]] = {}
        for digest, name in hashes.items():
            for of, b in touched:
                if of == name:
                    made.setdefault(name, {})[str(b)] = f"{base}/_of={digest}/bucket={b}"
        return made

    def upsert(self, vertices: DataFrame, edges: DataFrame, order: str = "_order") -> DataFrame:
        """Write what the store doesn't hold: the first write of an id stays, within a call the row of the smallest order (all of them alike without such a column).

        Vertices count before edges. Returned are the edges that weren't written because the store has no vertex for one of their ends; each row with a null id is left out. Repeating a call changes nothing.
        """
        number, found, run = self.version(), self.manifest(), uuid.uuid4().hex
        found.setdefault("buckets", self.buckets)
        ordered = lambda rows: rows.withColumn("_order", F.col(order) if order in rows.columns else F.lit(0))
        for of, made in self._merged("vertices", ordered(vertices), found, run).items():
            found["vertices"].setdefault(of, {}).update(made)
        given = written(ordered(edges), "edges")
        ends = written(given.select(F.explode(F.array("src_id", "dst_id")).alias("internal_id")).where("internal_id is not null").distinct(), "ends")
        buckets = {r[0] for r in ends.select(self.bucket(F.col("internal_id"))).distinct().collect()}
        known = self._stored("vertices", found, [(of, b) for of in found["vertices"] for b in buckets]).select("internal_id")
        there = written(ends.join(known, "internal_id", "left_semi"), "known")
        both = given.join(there.withColumnRenamed("internal_id", "src_id"), "src_id", "left_semi").join(there.withColumnRenamed("internal_id", "dst_id"), "dst_id", "left_semi")
        for of, made in self._merged("edges", both, found, run).items():
            found["edges"].setdefault(of, {}).update(made)
        if found != self.manifest(number) | {"buckets": self.buckets} or not number:
            self.files.mkdirs(self._path("manifests"))
            self._commit(number + 1, found)
        gone = lambda end: given.join(there.withColumnRenamed("internal_id", end), end, "left_anti").where("internal_id is not null")
        return gone("src_id").unionByName(gone("dst_id"), allowMissingColumns=True).dropDuplicates(["internal_id"]).select(*edges.columns)
