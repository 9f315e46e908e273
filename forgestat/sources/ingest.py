"""Incremental cursors and the three write modes (SRC-10 ... SRC-13, SRC-18).

All operations are DataFrame plans: a cursor is a small DataFrame keyed by
(entity, owner, repo); merge keeps the newest version per primary key with a
partial (map-side) aggregation, so a key repeated across many loads never
collects into one task; append is a left-anti join on the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

CURSOR_SCHEMA = T.StructType([
    T.StructField("entity", T.StringType(), False),
    T.StructField("_owner", T.StringType(), True),
    T.StructField("_repo", T.StringType(), True),
    T.StructField("last_value", T.TimestampNTZType(), True),
])

# Fixed value from the reference: cursor start when no state exists.
DEFAULT_INITIAL_CURSOR = "2025-01-01 00:00:00"


def upsert(rows: DataFrame, pk: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Merge write mode: one row per primary key, the newest by ``order_by``
    (descending, NULL oldest; later columns break ties; the remaining columns
    of the row break any tie left). Implemented as ``max(struct)`` per key, a
    hash aggregate with partial aggregation before the shuffle."""
    order = [c for c in order_by if c not in pk]          # key columns are equal within a group
    rest = [c for c in rows.columns if c not in pk and c not in order]
    if not order and not rest:
        return rows.dropDuplicates(list(pk))
    packed = F.struct(*[F.col(c) for c in order + rest]).alias("_v")
    out = rows.groupBy(*pk).agg(F.max(packed).alias("_v"))
    return out.select(*[F.col(c) for c in pk], *[F.col("_v." + c).alias(c) for c in order + rest]).select(*rows.columns)


def merge_into(existing: DataFrame | None, incoming: DataFrame, pk: Sequence[str],
               order_by: Sequence[str]) -> DataFrame:
    """Bronze after merging a new batch into the existing table. Idempotent
    and independent of batch order."""
    allrows = incoming if existing is None else existing.unionByName(incoming, allowMissingColumns=True)
    return upsert(allrows, pk, order_by)


def append_new(existing: DataFrame | None, incoming: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Append write mode: rows whose key is not yet stored (and one row per key
    within the batch). Returns only the rows to append."""
    fresh = incoming.dropDuplicates(list(pk))
    if existing is None:
        return fresh
    return fresh.join(existing.select(*pk), list(pk), "left_anti")


def replace_partitions(incoming: DataFrame, existing: DataFrame | None,
                       partition_cols: Sequence[str] = ("_owner", "_repo")) -> DataFrame:
    """Replace write mode at repository grain: the repositories present in the
    batch are replaced, the others kept (dynamic partition overwrite)."""
    if existing is None:
        return incoming
    keep = existing.join(incoming.select(*partition_cols).distinct(), list(partition_cols), "left_anti")
    return keep.unionByName(incoming, allowMissingColumns=True)


def initial_cursors(spark: SparkSession, initial: str = DEFAULT_INITIAL_CURSOR) -> DataFrame:
    return spark.createDataFrame([], CURSOR_SCHEMA).withColumn(
        "last_value", F.coalesce(F.col("last_value"), F.lit(initial).cast("timestamp_ntz")))


def apply_cursor(rows: DataFrame, entity: str, cursor_col: str, cursors: DataFrame | None,
                 initial: str = DEFAULT_INITIAL_CURSOR, keep_null: bool = False) -> DataFrame:
    """Keep rows at or after the stored cursor of their (entity, owner, repo).

    Ties are kept (``>=``); the merge on the primary key removes repeats.
    ``keep_null`` keeps rows whose cursor field is NULL (releases that are not
    published yet, issues without an update time). ``cursor_col`` may be a nested path such as
    ``commit.committer.date``.
    """
    ts = F.col(cursor_col).cast("timestamp_ntz")
    if cursors is None:
        bound = F.lit(initial).cast("timestamp_ntz")
        joined = rows
    else:
        c = cursors.filter(F.col("entity") == entity).select(
            F.col("_owner").alias("_c_owner"), F.col("_repo").alias("_c_repo"),
            F.col("last_value").alias("_c_last"))
        joined = rows.join(c,
                           (rows._owner == c._c_owner) & (rows._repo == c._c_repo), "left")
        bound = F.coalesce(F.col("_c_last"), F.lit(initial).cast("timestamp_ntz"))
    keep = ts >= bound
    if keep_null:
        keep = keep | ts.isNull()
    out = joined.filter(keep)
    return out.drop("_c_owner", "_c_repo", "_c_last") if cursors is not None else out


def next_cursors(rows: DataFrame, entity: str, cursor_col: str, cursors: DataFrame | None) -> DataFrame:
    """New high-water marks: max cursor per (owner, repo), never moving back."""
    fresh = rows.groupBy("_owner", "_repo").agg(F.max(F.col(cursor_col).cast("timestamp_ntz")).alias("v"))
    fresh = fresh.select(F.lit(entity).alias("entity"), "_owner", "_repo", F.col("v").alias("last_value"))
    if cursors is None:
        return fresh
    both = cursors.unionByName(fresh)
    others = both.filter(F.col("entity") != entity)
    mine = (both.filter(F.col("entity") == entity)
                .groupBy("entity", "_owner", "_repo").agg(F.max("last_value").alias("last_value")))
    return others.unionByName(mine)


def load_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per bronze table; tables that are missing (None) are skipped."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items() if df is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
