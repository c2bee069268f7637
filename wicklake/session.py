"""Session settings, and the shared folder that staged data goes to."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. All of them can be changed on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

_local_dirs: dict[str, str] = {}


def spark_session(app: str = "wicklake", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Checkpoint files go away together with the frame they belong to.
    # Call-site capture costs two gateway calls for every column expression.
    settings = {
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false", **RUNTIME, **(conf or {})}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session somebody else created."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor sees: `spark.checkpoint.dir`.

    Only a local session may do without the setting, and then gets a temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = _local_dirs.get(sc.applicationId)
        if configured is None:
            configured = _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="wicklake-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "staged") -> DataFrame:
    """`df` written once, as Parquet in the shared folder; later passes read the columns they need from that copy.

    The copies of a session lie in one folder and go with `drop_staged`.
    """
    spark = df.sparkSession
    path = f"{_staged_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _staged_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/staged-{spark.sparkContext.applicationId}"


def drop_staged(spark: SparkSession) -> None:
    """Delete what `staged` has written in this application. Frames that read it cannot be used any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_staged_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def runtime_conf(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
