"""Steps of a large job, each written before the next begins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from forgestat.session import checkpoint_dir

# Spark's setting that takes a query's shuffle files away when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back. All shuffles of a
    query stay on disk until it ends, so a job of many holds all of them at once; those of
    a step that ends here go, and its rows stay, by column and compressed."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/step-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
