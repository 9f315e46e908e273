"""Bronze tables: partitioned parquet folders in three write modes.

* merge and replace tables are partitioned by (``_owner``, ``_repo``) and
  written with dynamic partition overwrite: only the repositories of the batch
  are read and replaced, the files of all others stay as they are;
* append tables are partitioned by event date and load; the key anti-join reads
  only the dates that the batch can meet, old files are never touched.

Rows are written to the shared checkpoint folder before they replace what they
were read from. Spark moves finished files into place when a job commits; a
store without atomic renames needs a table format or its committer for that.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from forgestat.session import checkpoint_dir
from forgestat.sources import ingest

REPOSITORY = ("_owner", "_repo")
NO_DATE = "0001-01-01"           # partition of events without an instant
# Partitions named one by one in a scan's filter; beyond it a semi-join finds them.
NAMED_PARTITIONS = 5000


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table at ``path``, or None where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/bronze-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _met(existing: DataFrame, batch: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the partitions that the batch names, by partition pruning."""
    names = batch.select(*by).distinct().limit(NAMED_PARTITIONS + 1).collect()
    if len(names) > NAMED_PARTITIONS:
        return existing.join(batch.select(*by).distinct(), list(by), "left_semi")
    # a null partition value reads back as null; no separator stands in a length
    def key(c: str):
        return F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
    wanted = ["".join("-" if v is None else f"{len(v)}:{v}" for v in row) for row in names]
    return existing.filter(F.concat(*[key(c) for c in by]).isin(wanted))


class BronzeTable:
    def __init__(self, spark: SparkSession, path: str, later: dict[str, DataType] | None = None):
        """``later``: columns that files of an earlier schema may lack; they are
        null there (the schema of a folder is read from one file)."""
        self.spark = spark
        self.path = path.rstrip("/")
        self.later = later or {}

    def _stored(self) -> DataFrame | None:
        df = read_or_none(self.spark, self.path)
        new = [StructField(c, t) for c, t in self.later.items()] if df is not None else []
        new = [f for f in new if f.name not in df.columns]
        return self.spark.read.schema(StructType([*df.schema.fields, *new])).parquet(self.path) if new else df

    def read(self) -> DataFrame | None:
        df = self._stored()
        return None if df is None else df.drop("_event_date")

    def _overwrite(self, df: DataFrame) -> None:
        # rebalanced by repository: a large one is split over tasks, small ones share a file each
        (df.hint("rebalance", *REPOSITORY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*REPOSITORY).parquet(self.path))

    def merge(self, batch: DataFrame, pk: Sequence[str], order_by: Sequence[str]) -> None:
        """SRC-11 in place: the batch's repositories get the newest version per
        key of what is stored and what arrives. A key belongs to one repository."""
        existing = self.read()
        if existing is not None:
            existing = _met(existing, batch, REPOSITORY)
        self._overwrite(staged(ingest.merge_into(existing, batch, pk, order_by), "merge"))

    def replace(self, batch: DataFrame) -> None:
        """SRC-13 in place: the batch's repositories are replaced."""
        self._overwrite(batch)

    def append(self, batch: DataFrame, pk: Sequence[str], event_time: str, load_id: str) -> None:
        """SRC-12 in place: rows whose key is not stored are added as new files.
        A key has one event time, so only that date's partitions are read."""
        date = F.coalesce(F.date_format(F.col(event_time), "yyyy-MM-dd"), F.lit(NO_DATE))
        batch = batch.withColumn("_event_date", date).withColumn("_load_id", F.lit(load_id))
        existing = self._stored()
        if existing is not None:
            existing = _met(existing, batch, ["_event_date"])
        fresh = staged(ingest.append_new(existing, batch, pk), "append")
        if not fresh.isEmpty():
            (fresh.hint("rebalance", "_event_date").write.mode("append")
             .partitionBy("_event_date", "_load_id").parquet(self.path))
