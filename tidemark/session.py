"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import functools
import tempfile
import uuid
from math import ceil

from pyspark.sql import SparkSession

# Values every job needs for right results (the zone) or for sound plans at scale (AQE and its skew handling).
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Loads of several sources share the executors.
    "spark.scheduler.mode": "FAIR",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Recording the Python call site of every expression doubles the time it takes to build a wide plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

# Beyond this the driver spends more on bookkeeping than smaller partitions save.  A shuffle of more than this number of
# ``partition_bytes`` gets larger partitions; raise ``partition_bytes`` there, with the executors' memory.
MAX_SHUFFLE_PARTITIONS = 100_000


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_conf(largest_shuffle_bytes: int, partition_bytes: int = 128 << 20) -> dict[str, str]:
    """Settings for a job whose largest shuffle moves about ``largest_shuffle_bytes``.

    AQE can merge shuffle partitions that turn out small but cannot add any, so the initial number has to suit the
    largest shuffle: partitions of ``partition_bytes`` sort in memory.
    """
    partitions = min(max(200, ceil(largest_shuffle_bytes / partition_bytes)), MAX_SHUFFLE_PARTITIONS)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(2 * partition_bytes),
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The folder shared by all executors that the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a machine-local folder; on a cluster a missing setting is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return _local_folder(spark.sparkContext.applicationId)


@functools.cache
def _local_folder(_application: str) -> str:
    return tempfile.mkdtemp(prefix="tidemark-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, keeping a directory that is already set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_root(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused path under the shared folder."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"
