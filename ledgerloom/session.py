"""Session helpers.

Library code never creates its own session: every job takes the caller's
``SparkSession``.  ``get_spark`` is for tests, the bench and local runs only.
"""

from __future__ import annotations

import os
import tempfile

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings that matter at cluster scale as much as on one machine: AQE re-plans
# joins at runtime (broadcast only when the *measured* side is small, split
# skewed partitions), coalesces small shuffle partitions, and the session
# time zone is pinned so no expression depends on the machine's zone.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8, app: str = "ledgerloom") -> SparkSession:
    master = master or os.environ.get("LEDGERLOOM_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate data.

    ``spark.checkpoint.dir`` of the session is used as is.  Where it is unset,
    a single-machine session (``local[...]``, as in tests) gets a scratch
    folder; any other session raises, because a folder of one machine cannot
    be read by the others."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    d = d or sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint ``df`` into the shared checkpoint folder, computing it once.

    A reliable checkpoint writes the data in a second job; persisting first
    lets that job read the blocks the first job produced instead of running
    the plan again.  The returned DataFrame reads the checkpoint files, so
    its lineage is cut and it survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = df.checkpoint(eager=True)
    df.unpersist()
    return out
