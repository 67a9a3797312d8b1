"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import functools
import tempfile
import uuid
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(app: str = "callsift", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A loopback-only session for tests and the local bench; a cluster brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. Only a local session without one gets a folder of its own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="callsift-"))
    return context.getCheckpointDir()


_JOB: ContextVar[str | None] = ContextVar("job folder", default=None)


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{(_JOB.get() or shared_folder(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def whole_job(job):
    """A job whose results are all in its targets: what it settles goes to a folder of its own, deleted when it ends."""

    @functools.wraps(job)
    def run(spark: SparkSession, *args, **options):
        folder = fresh_path(spark, job.__name__)
        token = _JOB.set(folder)
        try:
            return job(spark, *args, **options)
        finally:
            _JOB.reset(token)
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

    return run


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder and go on from the written table.

    Cuts lineage in a way that survives lost executors, and gives later stages column pruning and true sizes.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
