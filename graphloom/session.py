"""Sessions and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(name: str = "graphloom", cores: str = "*", partitions: int = 8) -> SparkSession:
    """For tests and benches; on a cluster the session comes from the launcher."""
    return SparkSession.builder.master(f"local[{cores}]").appName(name).config("spark.sql.shuffle.partitions", partitions).config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "8g").getOrCreate()


def ensure_checkpoints(spark: SparkSession) -> None:
    """Spark takes spark.checkpoint.dir itself; only a local session without one gets a temporary folder."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder")
        context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="graphloom-"))


def new_folder(spark: SparkSession, tag: str) -> str:
    """A new folder below the application's own one in the shared checkpoint folder, which goes when the driver's JVM ends."""
    ensure_checkpoints(spark)
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext._jsc.sc().getCheckpointDir().get()
    base = f"{shared.rstrip('/')}/graphloom/{spark.sparkContext.applicationId}"
    own = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    files = own.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(own)
    files.deleteOnExit(own)
    return f"{base}/{tag}-{uuid.uuid4().hex[:12]}"
