"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the results depend on; they can be changed on a running session.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings for throughput; applied only to sessions built here.
TUNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.checkpoint.compress": "true",
    # Plans here have many columns; noting the Python line of each one costs more than planning.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Open hours live outside the JVM heap and are saved as changes, not as whole copies.
STREAMING_CONF = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _apply(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Put the settings that results depend on into an existing session."""
    return _apply(spark, REQUIRED_CONF)


def prepare_streaming(spark: SparkSession) -> SparkSession:
    """The same for a session that starts streams; a started stream keeps its settings."""
    return _apply(prepare(spark), STREAMING_CONF)


def create_session(app_name: str = "airhour", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's settings; ``master`` stays with spark-submit when None."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING_CONF, **STREAMING_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only a local session may go without both and gets a temporary folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="airhour-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never used before."""
    return f"{shared_folder(spark)}/airhour/{name}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make reliable ``checkpoint()`` usable, in the shared folder."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
