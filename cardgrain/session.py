"""Session settings and the shared checkpoint folder.

The engine never picks a machine-local folder on a cluster: it reads
``spark.checkpoint.dir`` (or the SparkContext checkpoint dir) from the
session, and only in local mode, when neither is set, falls back to a fresh
temporary folder so that tests can run.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings a job of this engine expects. AQE re-plans joins at run time from
# measured shuffle sizes (so a side is broadcast only once it is known to be
# small), coalesces small shuffle partitions and splits skewed ones.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "cardgrain") -> SparkSession:
    """Create (or fetch) a session with the engine's settings.

    Without ``master`` the session takes the one that spark-submit sets.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master is not None and master.startswith("local"):
        conf["spark.driver.memory"] = "16g"  # driver and executors are one process
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session (driver-made)."""
    for k, v in ENGINE_CONF.items():
        if spark.conf.isModifiable(k):  # static settings stay as they are
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder every executor "
            "can reach (HDFS, S3, ...) before running order-dependent operators")
    path = tempfile.mkdtemp(prefix="cardgrain-ckpt-")
    sc.setCheckpointDir(path)
    return path


def reliable_checkpoint(df):
    """Materialise ``df`` into the shared checkpoint folder and cut lineage.

    Used where a result feeds two branches of one plan and must be the same
    rows in both (range-partitioned row positions); a recomputation after an
    executor loss then reads the checkpoint instead of re-sampling.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
