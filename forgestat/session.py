"""SparkSession construction and shared-folder settings."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings every session needs for parity with the reference's semantics:
# timestamps are wall-clock UTC, ANSI casts stay strict (P12).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    # partition values are names: a repository called 007 stays so
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str = "local[8]", app: str = "forgestat",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and benches; on a cluster use the cluster's
    session and call :func:`configure` on it."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and materialised tables.

    Read from ``spark.checkpoint.dir``, which the cluster names. Where it is
    unset, a local session (tests, bench) gets a scratch folder of its own; on
    a cluster a machine-local folder would be wrong, so that raises.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="forgestat-ckpt-", dir=os.environ.get("FORGESTAT_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured
