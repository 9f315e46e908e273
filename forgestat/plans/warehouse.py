"""The model DAG: bronze -> staging -> intermediate + dims -> facts -> metrics.

``Warehouse`` memoises each model's DataFrame (a lazy plan, not a cache), so
a model used by several others is one plan node. ``materialize`` writes the
tables the reference materialises (dims and facts) to the shared folder and
re-reads them, which cuts the lineage before the metric views.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from fnmatch import fnmatchcase
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from forgestat.functions.sizing import broadcast_if_bounded, deal_by_size, input_bytes
from forgestat.functions.steps import saved
from forgestat.operators import dates, intermediate, marts, metrics, staging
from forgestat.params import WarehouseParams
from forgestat.sources.landing import child_table

TABLE_MODELS = ("dim_dates", "dim_repositories", "dim_users", "fct_pull_requests", "fct_issues",
                "fct_commits", "fct_stargazers")


class Warehouse:
    def __init__(self, spark: SparkSession, bronze: Mapping[str, DataFrame], params: WarehouseParams,
                 date_join: bool = False, users_join: bool = False, spine_bounds: DataFrame | None = None):
        self.spark = spark
        self.spine_bounds = spine_bounds          # one row (first, past): the date spine from the data
        self.bronze = bronze
        self.params = params
        self.date_join = date_join
        self.users_join = users_join
        self.steps: frozenset[str] = frozenset()  # models that are written before others read them
        self.known_repositories: int | None = None  # rows of dim_repositories, where they are counted
        self._tables: dict[str, DataFrame] = {}
        self._written: set[str] = set()           # models served from written files

    def in_steps(self, names: Iterable[str]) -> "Warehouse":
        """The same warehouse with these models saved (``functions.steps``) when they are first
        asked for, so that no query holds the shuffles of all models that it reads."""
        wh = Warehouse(self.spark, self.bronze, self.params, self.date_join, self.users_join, self.spine_bounds)
        wh.steps, wh.known_repositories = frozenset(names), self.known_repositories
        wh.adapters, wh.input_bytes = getattr(self, "adapters", None), getattr(self, "input_bytes", None)  # type: ignore[attr-defined]
        return wh

    def _step(self, name: str, df: DataFrame) -> DataFrame:
        return saved(df, name) if name in self.steps else df

    # ---- staging ----------------------------------------------------------------
    @cached_property
    def stg_repositories(self): return staging.stg_repositories(self.bronze["repositories"])
    @cached_property
    def stg_issues(self): return staging.stg_issues(self.bronze["issues"], self.params.exclude_pull_requests)
    @cached_property
    def stg_pull_requests(self): return staging.stg_pull_requests(self.bronze["pull_requests"])
    @cached_property
    def stg_issue_comments(self): return staging.stg_issue_comments(self.bronze["issue_comments"],
                                                                      self.params.strict_comment_numbers)
    @cached_property
    def stg_commits(self): return staging.stg_commits(self.bronze["commits"])
    @cached_property
    def stg_releases(self): return staging.stg_releases(self.bronze["releases"])
    @cached_property
    def stg_stargazers(self): return staging.stg_stargazers(self.bronze["stargazers"])
    @cached_property
    def stg_issue_labels(self): return staging.stg_issue_labels(child_table(self.bronze["issues"], "labels"))
    @cached_property
    def stg_pr_labels(self): return staging.stg_pr_labels(child_table(self.bronze["pull_requests"], "labels"))
    @cached_property
    def stg_repository_topics(self):
        return staging.stg_repository_topics(child_table(self.bronze["repositories"], "topics"))
    @cached_property
    def stg_pr_reviews(self):
        return staging.stg_pr_reviews(self.bronze["pr_reviews"]) if "pr_reviews" in self.bronze else None
    @cached_property
    def comment_authors(self):
        """The comments' columns that make activity and users, of those with an author."""
        return self._step("comment_authors", self.stg_issue_comments.filter(F.col("author_id").isNotNull()).select(
            "comment_id", "repository_full_name", "author_login", "author_id", "created_at"))
    @cached_property
    def star_logins(self):
        pairs = staging.user_pairs(self.stg_stargazers, "user_id", "user_login")
        return self._step("star_logins", pairs.distinct()) if "star_logins" in self.steps else pairs
    @cached_property
    def stg_users(self):
        return self._step("stg_users", staging.stg_users(self.stg_issues, self.stg_pull_requests, self.comment_authors,
                                                         self.stg_commits, self.star_logins))

    # ---- intermediate -------------------------------------------------------------
    @cached_property
    def comment_stats(self): return self._step("comment_stats", intermediate.comment_stats(self.stg_issue_comments))
    @cached_property
    def activity_rows(self):
        return intermediate.activity_rows(self.stg_issues, self.stg_pull_requests, self.comment_authors, self.stg_commits)
    @cached_property
    def int_contributor_activity(self):
        return intermediate.int_contributor_activity(
            self.activity_rows, self.dim_users if "dim_users" in self._written else self.stg_users)
    @cached_property
    def user_months(self):
        return metrics.user_months(self.activity_rows, self.star_logins)
    @property
    def human_months(self): return metrics.human_months(self.user_months)
    @cached_property
    def int_issue_lifecycle(self):
        return intermediate.int_issue_lifecycle(self.stg_issues, self.stg_issue_labels, self.comment_stats)
    @cached_property
    def review_stats(self):
        reviews = self._step("reviews", self.stg_pr_reviews.select(*intermediate.REVIEW_COLUMNS))
        return self._step("review_stats", intermediate.review_stats(reviews))
    @cached_property
    def labelled_prs(self):
        return self._step("labelled_prs", intermediate.labelled_prs(self.stg_pull_requests, self.stg_pr_labels))
    @cached_property
    def int_pr_with_reviews(self):
        reviews = self.review_stats if self.stg_pr_reviews is not None else None
        return intermediate.int_pr_with_reviews(self.labelled_prs, self.comment_stats, reviews)

    # ---- marts ------------------------------------------------------------------------
    def _t(self, name: str, build) -> DataFrame:
        """Materialised table if written, else the (memoised) lazy plan."""
        if name not in self._tables:
            self._tables[name] = build()
        return self._tables[name]

    @property
    def dim_dates(self):
        if self.spine_bounds is not None:
            return self._t("dim_dates", lambda: dates.dim_dates_between(self.spine_bounds))
        return self._t("dim_dates", lambda: dates.dim_dates(self.spark, self.params.date_spine_start,
                                                             self.params.date_spine_end))
    @property
    def dim_repositories(self):
        return self._t("dim_repositories", lambda: broadcast_if_bounded(
            marts.dim_repositories(self.stg_repositories), self.known_repositories))
    @property
    def dim_users(self): return self._t("dim_users", lambda: marts.dim_users(self.stg_users))

    @property
    def fact_context(self) -> marts.FactContext:
        return marts.FactContext(lambda: self.dim_repositories, lambda: self.dim_users, lambda: self.dim_dates,
                                 (self.params.date_spine_start, self.params.date_spine_end),
                                 date_join=self.date_join, users_join=self.users_join)

    @property
    def fct_pull_requests(self):
        return self._t("fct_pull_requests", lambda: marts.fct_pull_requests(self.int_pr_with_reviews, self.fact_context))
    @property
    def fct_issues(self):
        return self._t("fct_issues", lambda: marts.fct_issues(self.int_issue_lifecycle, self.fact_context))
    @property
    def fct_commits(self):
        return self._t("fct_commits", lambda: marts.fct_commits(self.stg_commits, self.fact_context))
    @property
    def fct_stargazers(self):
        return self._t("fct_stargazers", lambda: marts.fct_stargazers(self.stg_stargazers, self.fact_context))

    # ---- metrics ------------------------------------------------------------------------
    @property
    def pr_cycle_time(self):
        return self._t("pr_cycle_time", lambda: metrics.pr_cycle_time(
            self.fct_pull_requests, self.dim_repositories, monday_week_start=self.params.monday_week_start,
            iso_year=self.params.iso_year))
    @property
    def contributor_engagement(self):
        return self._t("contributor_engagement", lambda: metrics.contributor_engagement(self.human_months))
    @property
    def top_contributors(self): return metrics.top_contributors(self.human_months)
    @property
    def release_velocity(self):
        return self._t("release_velocity", lambda: metrics.release_velocity(self.stg_releases, self.dim_repositories))
    @property
    def commits_per_release(self): return metrics.commits_per_release(self.stg_commits)
    @property
    def release_intervals(self): return metrics.release_intervals(self.stg_releases, self.dim_repositories)

    # ---- materialisation ------------------------------------------------------------
    def materialize(self, root: str, models=TABLE_MODELS, with_audit: bool = True,
                    parallel: int = 4) -> dict[str, str]:
        """Write the table models (full refresh) under ``root`` - a folder every
        executor can reach, e.g. below ``spark.checkpoint.dir`` - and serve
        later reads from the written files. Independent tables are written by
        concurrent jobs (``parallel`` driver threads sharing the executors),
        so small stages of one table do not leave the cluster idle."""
        from concurrent.futures import ThreadPoolExecutor

        plans = {}
        for name in models:                      # build plans on the calling thread
            df = getattr(self, name)
            if with_audit:
                df = df.withColumn("_loaded_at", F.current_timestamp())
            plans[name] = df
        paths = {name: f"{root.rstrip('/')}/{name}" for name in models}

        def write(name: str) -> str:
            plans[name].write.mode("overwrite").parquet(paths[name])
            return name

        if parallel > 1 and len(models) > 1:
            with ThreadPoolExecutor(max_workers=min(parallel, len(models))) as pool:
                list(pool.map(write, models))
        else:
            for name in models:
                write(name)
        for name in models:
            self._tables[name] = self.spark.read.parquet(paths[name]).drop("_loaded_at")
        self._written |= set(models)
        return paths

    def publish(self, database: str, models=TABLE_MODELS + ("int_contributor_activity", "pr_cycle_time",
                                                             "contributor_engagement", "release_velocity"),
                with_audit: bool = True) -> list[str]:
        """Save models as catalog tables of ``database`` (created if missing),
        so existing SQL (``SELECT ... FROM marts.fct_pull_requests``) runs
        through ``spark.sql`` unchanged. Publish the dimension / fact / metric
        models into ``marts`` and the activity stream into ``intermediate`` to
        keep the reference's qualified names."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        names = []
        for name in models:
            df = getattr(self, name)
            if with_audit:
                df = df.withColumn("_loaded_at", F.current_timestamp())
            df.write.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{name}`")
            names.append(f"{database}.{name}")
        return names


def driver_params(spark: SparkSession, sf_dir: str) -> WarehouseParams:
    """Date-spine bounds from the data: first order day to
    ``DRIVER_SPINE_END_DAYS`` after the last event day (exclusive end).
    Two scalar aggregates; only the two dates reach the driver."""
    import dataclasses
    import datetime as dt
    from forgestat.params import DRIVER_PARAMS, DRIVER_SPINE_END_DAYS
    d = sf_dir.rstrip("/")
    first = spark.read.parquet(f"{d}/orders.parquet").agg(F.min(F.col("o_orderdate").cast("date"))).first()[0]
    last = spark.read.parquet(f"{d}/events.parquet").agg(F.max(F.col("ts").cast("date"))).first()[0]
    if first is None or last is None:
        raise ValueError("orders or events hold no date: the date spine has no bounds")
    return dataclasses.replace(DRIVER_PARAMS, date_spine_start=first,
                               date_spine_end=last + dt.timedelta(days=DRIVER_SPINE_END_DAYS))


def driver_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounds of :func:`driver_params` as a one-row table."""
    from forgestat.params import DRIVER_SPINE_END_DAYS
    d = sf_dir.rstrip("/")
    first = spark.read.parquet(f"{d}/orders.parquet").select(F.col("o_orderdate").cast("date").alias("first"),
                                                             F.lit(None).cast("date").alias("past"))
    last = spark.read.parquet(f"{d}/events.parquet").select(
        F.lit(None).cast("date").alias("first"), F.date_add(F.col("ts").cast("date"), DRIVER_SPINE_END_DAYS).alias("past"))
    return first.unionByName(last).agg(F.min("first").alias("first"), F.max("past").alias("past"))


def driver_warehouse(spark: SparkSession, sf_dir: str, params: WarehouseParams | None = None,
                     with_reviews: bool = False, **kw) -> Warehouse:
    """Warehouse over the driver's tables through the adapters."""
    from forgestat.params import DRIVER_PARAMS
    from forgestat.sources.adapters import DriverBronze
    size = input_bytes(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in DriverBronze.TABLES])
    deal_by_size(spark, size)
    p = params or driver_params(spark, sf_dir)
    b = DriverBronze(spark, sf_dir, p)
    if params is None:
        kw.setdefault("spine_bounds", driver_spine(spark, sf_dir))
    wh = Warehouse(spark, b.entities(with_reviews=with_reviews), p, **kw)
    wh.adapters, wh.input_bytes = b, size  # type: ignore[attr-defined]
    wh.known_repositories = b.known_rows["repo_map"]      # a row per nation and region
    return wh

METRIC_MODELS = ("pr_cycle_time", "contributor_engagement", "release_velocity")


def run_pipeline(wh: Warehouse, root: str) -> dict:
    """The daily full refresh: write dims and facts (tables), write the metric
    views' results, run every declared mart test over the written tables and
    store failing rows. Returns per-step row counts and test failures."""
    from forgestat.operators import quality
    wh.materialize(root)                                 # dims and facts, concurrent jobs
    wh.materialize(root, METRIC_MODELS, parallel=len(METRIC_MODELS))   # metrics over the written facts
    out = {"tables": {}, "metrics": {}, "tests": {}}
    for name in TABLE_MODELS:
        out["tables"][name] = wh._tables[name].count()
    for name in METRIC_MODELS:
        out["metrics"][name] = wh._tables[name].count()
    models = {n: wh._tables[n] for n in TABLE_MODELS + METRIC_MODELS}
    _, summary = quality.store_declared_failures(models, quality.MART_TESTS, root)
    for r in summary.collect():
        out["tests"][f"{r['model']}.{r['test']}.{r['column_name']}"] = r["failures"]
    for test, failing in (("assert_positive_cycle_time", quality.negative_cycle_time), ("assert_no_orphan_prs", quality.orphan_prs)):
        path = quality.store_failures(failing(models["fct_pull_requests"]), root, test)
        out["tests"][test] = wh.spark.read.parquet(path).count()
    return out


def audited_run(wh: Warehouse, root: str, database: str, warn: tuple[str, ...] = ()) -> dict:
    """Write, audit, publish: :func:`run_pipeline` into a new folder ``<root>/run=<id>``,
    then views of ``database`` (created if missing) over that folder, but only if no
    declared or singular test has failing rows. Tests whose name matches a pattern of
    ``warn`` (``fct_issues.*``) are reported and stored, and do not hold a run back.

    Tables that were published are never written again: a run that fails, dies or is
    held back leaves the views on the folder of the run before, and readers that have
    begun keep their files. The views are switched one after another once all tables
    are there. Returns the result of ``run_pipeline`` with ``run`` (the folder),
    ``blocked_by`` and ``warnings`` (test: failing rows) and ``published`` (view names).
    Folders of earlier runs, with their failing rows, stay for the operator to remove."""
    run = f"{root.rstrip('/')}/run={uuid.uuid4().hex}"
    out = run_pipeline(wh, run)
    failing = {test: n for test, n in out["tests"].items() if n}
    out["run"] = run
    out["warnings"] = {test: n for test, n in failing.items() if any(fnmatchcase(test, p) for p in warn)}
    out["blocked_by"] = {test: n for test, n in failing.items() if test not in out["warnings"]}
    out["published"] = []
    if not out["blocked_by"]:
        wh.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for name in TABLE_MODELS + METRIC_MODELS:
            path = f"{run}/{name}".replace("`", "``")
            wh.spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT * FROM parquet.`{path}`")
            out["published"].append(f"{database}.{name}")
    return out
