"""SparkSession defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. ANSI stays on (bad casts go through try_cast
# explicitly); AQE re-plans joins at runtime from real sizes, which is the
# size check behind every dimension join (autoBroadcastJoinThreshold) and
# splits skewed shuffle partitions.
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.legacy.charVarcharAsString": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_spark(master: str | None = None, app: str = "claimlake",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    On a cluster this comes from ``spark.checkpoint.dir`` (a shared file
    system the operator configured). A local master (tests) gets a fresh scratch
    folder that goes with the process; any other master without it is refused.
    """
    global _LOCAL_CKPT
    sc = spark.sparkContext
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        if _LOCAL_CKPT is None:
            _LOCAL_CKPT = tempfile.mkdtemp(prefix="claimlake-ckpt-")
            atexit.register(shutil.rmtree, _LOCAL_CKPT, ignore_errors=True)
        d = _LOCAL_CKPT
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


_LOCAL_CKPT: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for a written table."""
    return os.path.join(checkpoint_dir(spark), name)


def give_up_shuffles(spark: SparkSession) -> None:
    """Spark removes the shuffle files of a finished step when the driver collects its handles; asking
    for that between steps that wrote their result keeps disks at one step's shuffles."""
    spark.sparkContext._jvm.System.gc()
