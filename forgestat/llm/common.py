"""Shared small helpers of the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgestat.session import checkpoint_dir


#: Whole texts travel in these batches, so they are kept small: long texts
#: count by their bytes.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
               "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package's code to the executors, as ``--py-files`` would, once
    per application: tasks import it wherever their working folder is. Also
    sets the size of Arrow batches."""
    for name, value in ARROW_BATCH.items():
        spark.conf.set(name, value)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="forgestat-code-"), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a few numbers that are worth a file of their own.
ROWS_PER_FILE = 1 << 16


def in_few(df: DataFrame, rows: int, per_file: int = ROWS_PER_FILE) -> DataFrame:
    """``df``, whose last stage makes or reads about so many rows, with a task per
    ``per_file`` rows, or one per core, at most, however many partitions a shuffle has."""
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_file)))


def saved(df: DataFrame, name: str, rows: int | None = None, per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage in a way that survives the loss of any executor and gives
    later joins a side that is a plain scan, so that adaptive skew splitting
    can apply to both inputs.

    Where its ``rows`` are known, or a bound on them or on those of the step before,
    it is written as few files (``in_few``): each costs requests to its store, and on a
    local folder a process that the executor starts to set the file's mode.
    """
    spark = df.sparkSession
    if rows is not None:
        df = in_few(df, rows, per_file)
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0 (a null id counts as empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def documents_of(df: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    ship_package(df.sparkSession)
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.col(text_col).cast("string").alias("text"), *more)
