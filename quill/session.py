"""Session helpers for tests, the bench and the driver contract.

Library operators never create a session: they take DataFrames and return
DataFrames. Those that cut lineage (checkpoints, fits, written intermediates) run
jobs while they are called; the README lists them. Only tests and ``bench.py``
build a session, through :func:`local_session`.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session should have, whatever the cluster size.
SCALE_CONF = {
    # Adaptive execution: coalesce small shuffle partitions, split skewed
    # join partitions, switch sort-merge to broadcast when a side turns out
    # small at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # delete checkpoint files once the checkpointed data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "quill") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        # local runs shuffle a few MB into CPU-heavy stages (tokenising); let
        # AQE keep partitions down to 64 KB instead of merging to 1 MB, so all
        # cores get work. Cluster-sized partitions never come near this floor.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _configured(spark: SparkSession) -> str | None:
    sc = spark.sparkContext
    return (sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
            or sc.getConf().get("spark.checkpoint.dir", None))


def require_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for cut lineage: the one already set on the context, else
    ``spark.checkpoint.dir`` of the session. Operators never invent a folder."""
    found = _configured(spark)
    if not found:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (or call "
                           "SparkContext.setCheckpointDir) before using this operator")
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return sc.getCheckpointDir() or found


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """:func:`require_checkpoint_dir`, but a one-process ``local`` session (tests,
    bench) that names no folder gets a scratch folder; a cluster never does."""
    master = spark.sparkContext.master
    if not _configured(spark) and master.startswith("local") and not master.startswith("local-cluster"):
        spark.sparkContext.setCheckpointDir(
            tempfile.mkdtemp(prefix="quill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp")))
    return require_checkpoint_dir(spark)
