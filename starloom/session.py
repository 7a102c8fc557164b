"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a cluster job of this library wants. Sizes that depend on the cluster (executor
# memory, initial shuffle partitions) are left to whoever submits the job.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE merges small shuffle partitions up to this size and splits skewed ones above it.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # No call-site capture per column expression: the plans here have many.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A side is broadcast only when its measured shuffle output is below this.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "starloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the recommended settings; keyword settings win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without that setting: it gets a temporary folder. On a cluster a
    machine-local folder would lose data with its machine, so a missing setting is an error there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="starloom-")
    return _local_folders[application]


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
