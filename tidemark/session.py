"""Session settings and the shared folder in which written tables and checkpoints live."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A join followed by an aggregate on the same key keeps its partitioning, which would
    # otherwise stop Spark from splitting a hot key; an extra shuffle is the smaller cost.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # "The last n per key" is cut to n rows in every map task, also for a large n.
    "spark.sql.optimizer.windowGroupLimitThreshold": "1000000",
    # Session windows are merged inside each map task before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}

# For runs over many terabytes, on top of the above: larger scan splits, reduce partitions merged
# towards a size instead of a count, stream state outside the heap.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Reduce partitions so that one holds about 128 MiB, and every core has some. AQE merges small ones."""
    return max(2 * cores, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def cluster_conf(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for one large run."""
    return {**CLUSTER_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes, cores))}


def build_session(app_name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with this package's settings; `conf` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings, the time zone included, to a session somebody else built; they stay set."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by `spark.checkpoint.dir`.

    Only a local session without the setting gets a folder of its own: on a cluster a machine-local
    folder would lose its files with the machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="run-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def fresh_dir(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
