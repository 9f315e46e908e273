"""Sizes: broadcasts behind a proven bound, tasks of a bounded size at any input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows above which a dimension is left to the shuffle join (and AQE's runtime
# conversion, which measures the real size of the materialised side).
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000

# Bytes of files that a scan's task reads and of shuffled rows that a task takes:
# sorts hold some 30 times that in memory.
TASK_BYTES = 16 << 20
# Bytes of input files per shuffle partition, before small ones are put together. The
# widest shuffle of the models moves some five times its input.
INPUT_BYTES = 2 << 20
# Shuffled bytes count as they are written, and rows that compress well hold much more in
# memory. So many times the number of partitions with which shuffles begin is asked to
# stay: large shuffles keep theirs, small ones are put together to 1 MB (Spark's least).
KEPT = 4
# Partitions up to which a shuffle's writer sends each row straight to its partition's
# file; for more it holds all rows of its task in memory, and sorts them (Spark's default
# of ``spark.shuffle.sort.bypassMergeThreshold``).
STRAIGHT = 200


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the files at these paths, from their listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(paths)
    return files.agg(F.sum("length")).first()[0] or 0


def deal_by_size(spark: SparkSession, size: int) -> int:
    """Let the tasks of this session's queries over ``size`` bytes of files grow in
    number, not in size: scans are split and shuffle partitions put together at
    ``TASK_BYTES``, and shuffles begin with a partition per ``INPUT_BYTES``, or
    ``spark.sql.shuffle.partitions`` if that is more. Of the former, those of large
    shuffles are not put together to ``TASK_BYTES`` (``KEPT``). Returns that number."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(TASK_BYTES))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(TASK_BYTES))
    least, first = int(spark.conf.get("spark.sql.shuffle.partitions")), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    kept = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
    wanted = -(-size // INPUT_BYTES)
    if wanted > least:
        spark.conf.set(first, str(wanted))
        spark.conf.set(kept, str(KEPT * wanted))
    else:
        spark.conf.unset(first)
        spark.conf.unset(kept)
    return max(wanted, least)


def dealt_out(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` dealt out by these columns, without holding a task's rows in memory. A
    scan's task takes whole row groups, whatever its split size, and one may be the whole
    file. What sorts, aggregates or is dealt over many partitions right on it holds all of
    it; here that task only sends its rows on, to ``STRAIGHT`` partitions at most. Where
    rows repeat and the columns are few, their tasks grow; give all that tell rows apart."""
    conf = df.sparkSession.conf
    wanted = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions")
    most = int(conf.get("spark.shuffle.sort.bypassMergeThreshold", str(STRAIGHT)))
    return df.repartition(max(1, min(int(wanted), most)), *columns)


def broadcast_if_bounded(df: DataFrame, known_rows: int | None,
                         max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Return ``broadcast(df)`` when ``known_rows`` (a bound derived from
    parameters or table metadata, never from the data flowing through the
    query) is below ``max_rows``; otherwise the DataFrame unchanged."""
    if known_rows is not None and known_rows <= max_rows:
        return F.broadcast(df)
    return df
