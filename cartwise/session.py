"""Session helpers.

Library code never overrides a caller's session settings.  ``local_session`` is
for tests, the bench and ad-hoc use on one machine; on a cluster, pass the
cluster's own session to the library functions.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale; applied only by ``local_session``.  On a
# cluster they belong in the job's spark-defaults.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "cartwise", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "16g"))
    for k, v in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder of this session.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that is
    used as is.  Only when it is unset on a local master (tests) a fresh scratch
    folder is created so ``DataFrame.checkpoint`` and written intermediate tables work.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share: "
                               "intermediate tables are written there")
        configured = tempfile.mkdtemp(prefix="cartwise-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the session's shared checkpoint folder (never machine-local on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "cartwise", *parts])
