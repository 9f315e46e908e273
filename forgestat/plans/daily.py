"""The daily run: landed JSON -> bronze (cursors + write modes) -> models ->
tests, as one sequence of Spark jobs (the reference's extract / transform /
test chain without its HTTP client).

Landing layout: ``<landing>/<entity>/_owner=<o>/_repo=<r>/*.json``. Each entity
is one ``availableNow`` query (``streaming.ingest_stream``): its checkpoint
below ``<bronze>/_landing_log`` names the files already read, so a run opens and
parses each new file once. Tables are partitioned folders (``sources.bronze``).
"""

from __future__ import annotations

import datetime as dt
import hashlib
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from forgestat.operators import quality
from forgestat.params import WarehouseParams
from forgestat.plans.warehouse import Warehouse, audited_run, run_pipeline
from forgestat.sources import ingest, landing
from forgestat.sources.adapters import LazyTables
from forgestat.sources.bronze import BronzeTable
from forgestat.streaming.ingest_stream import Absorber, start_ingest

ENTITIES = ("repositories", "issues", "pull_requests", "pr_reviews", "issue_comments", "commits", "releases",
            "stargazers", "contributors")
# Landing folders beside the entity's own: answers that hold reviews.
SOURCES = {"pr_reviews": ("pr_reviews", "pr_review_responses")}


@dataclass(frozen=True)
class Repository:
    """One configured repository: where it starts without a cursor, and whether it is loaded."""
    owner: str
    repo: str
    initial_date: str | None = None
    enabled: bool = True


def _landed(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def load_entity(spark: SparkSession, landing_root: str, bronze_root: str, entity: str, load_id: str,
                modes: str = "effective", initial: str = ingest.DEFAULT_INITIAL_CURSOR,
                repositories: tuple[Repository, ...] = (),
                new_fields: dict[str, int] | None = None) -> tuple[dict[str, int], DataFrame]:
    """Take one entity's new files into its bronze table; what was read, and the
    table. ``new_fields`` takes the undeclared fields met, with their rows."""
    fields = new_fields if new_fields is not None else {}
    dated = [(entity, r.owner, r.repo, r.initial_date) for r in repositories if r.initial_date]
    seeds = (spark.createDataFrame(dated, "entity string, _owner string, _repo string, last_value string")
             .withColumn("last_value", F.col("last_value").cast("timestamp_ntz"))) if dated else None
    skipped = [(r.owner, r.repo) for r in repositories if not r.enabled]
    stats: dict[str, int] = {}
    log = hashlib.md5(landing_root.rstrip("/").encode()).hexdigest()[:12]
    for source in SOURCES.get(entity, (entity,)):
        if _landed(spark, f"{landing_root.rstrip('/')}/{source}"):
            absorber = Absorber(spark, bronze_root, source, load_id, modes, initial, seeds, skipped)
            checkpoint = f"{bronze_root.rstrip('/')}/_landing_log/{log}/{source}"
            start_ingest(spark, landing_root, bronze_root, checkpoint, absorber).awaitTermination()
            stats = {k: stats.get(k, 0) + v for k, v in absorber.stats.items()}
            fields.update({f"{source}.{path}": n for path, n in absorber.new_fields.items()})
    table = BronzeTable(spark, f"{bronze_root}/{entity}", {"_extra": landing.EXTRA}).read()
    if table is None:      # never landed: an empty table of the bronze shape
        table = landing.to_bronze(spark.createDataFrame([], landing.landed_schema(entity)), entity, load_id)
    return stats, table


def daily_run(spark: SparkSession, landing_root: str, bronze_root: str, out_root: str, load_id: str,
              params: WarehouseParams, modes: str = "effective",
              initial: str = ingest.DEFAULT_INITIAL_CURSOR, repositories: tuple[Repository, ...] = (),
              as_of: dt.datetime | None = None, publish_db: str | None = None, warn: tuple[str, ...] = ()) -> dict:
    """The daily job. ``initial`` is where an entity without a stored cursor
    starts, unless its repository has an ``initial_date``; ``as_of`` (now) is the
    instant at which freshness is judged. With ``publish_db`` the models go into a
    folder of this run and its views move to them only if the tests pass, but for
    those that only ``warn`` (see :func:`audited_run`); else ``out_root`` is written
    in place."""
    bronze: dict[str, DataFrame] = {}
    landed: dict[str, dict[str, int]] = {}
    fields: dict[str, int] = {}
    for entity in ENTITIES:
        stats, table = load_entity(spark, landing_root, bronze_root, entity, load_id, modes, initial, repositories, fields)
        bronze[entity] = table
        if stats:
            landed[entity] = stats
    summary = {r["table_name"]: r["row_count"] for r in ingest.load_summary(bronze).collect()}
    reviews = summary["pr_reviews"] > 0
    wh = Warehouse(spark, LazyTables({k: (lambda v=v: v) for k, v in bronze.items() if reviews or k != "pr_reviews"}), params)
    result = audited_run(wh, out_root, publish_db, warn) if publish_db else run_pipeline(wh, out_root)
    result["bronze_rows"] = summary
    result["landed"] = landed
    result["new_fields"] = fields
    result["quarantined_rows"] = {k: v["quarantined"] for k, v in landed.items()}
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    result["freshness"] = {e: quality.freshness(bronze[e], e, landing.CURSORS[e], as_of).first()["status"]
                           for e in ENTITIES if e in landing.CURSORS}
    return result
