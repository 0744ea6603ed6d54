"""Session settings, the shared work folder and materialised tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every operator relies on. Shuffle parallelism is left to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # hot join keys are split at run time, even where that costs one more exchange
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # a join whose partitions all turn out small is hashed instead of sorting both sides
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
}

# Spark then deletes the shuffle files of an execution when it ends
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCAL_ROOTS: dict[str, str] = {}
_OPEN = threading.local()  # paths: what the open scratch of this thread will delete


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "docweave",
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session for local runs and tests; on a cluster use ``configure`` on the given session."""
    builder = (
        SparkSession.builder.appName(app)
        .master(master)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", "-Xss8m")
    )
    for key, value in (conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """A folder of this application that all executors can reach, below ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/docweave/{context.applicationId}"
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app_id = context.applicationId
    if app_id not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app_id] = tempfile.mkdtemp(prefix="docweave-")
        atexit.register(shutil.rmtree, _LOCAL_ROOTS[app_id], ignore_errors=True)
    return _LOCAL_ROOTS[app_id]


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables materialised inside are deleted at the end, but for those written with ``keep``. Nothing lazy that reads the others may leave."""
    outer, _OPEN.paths = getattr(_OPEN, "paths", None), []
    try:
        yield
    finally:
        paths, _OPEN.paths = _OPEN.paths, outer
        for path in paths:
            delete_folder(spark, path)


def materialize(df: DataFrame, purpose: str, keep: bool = False) -> DataFrame:
    """Write once to the shared folder and read back: fixed rows, no lineage, survives lost executors.

    The shuffle files of the write are deleted with it, as nothing reads them again; else they stay until the driver
    happens to collect its garbage, and the steps of a query add up on disk.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, purpose)
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)
        if not keep and getattr(_OPEN, "paths", None) is not None:
            _OPEN.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession) -> None:
    """Delete what this application has materialised; results that were not written elsewhere are lost with it."""
    delete_folder(spark, shared_root(spark))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
