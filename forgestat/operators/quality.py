"""Data-quality checks (T-01 ... T-08, SNK-03).

Every check returns its FAILING rows (empty = pass), so the rows can be
stored and inspected. ``failing_keys`` runs all declared tests of all models in
one pass over each model and one shuffle; ``run_mart_tests`` counts it to one
summary (model, test, column, failures), ``store_declared_failures`` stores it;
``run_tests_in_steps`` counts a few models after the others, with only their shuffles on disk.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from forgestat.functions.numeric import round_scaled
from forgestat.functions.steps import saved


def unique_failures(df: DataFrame, col: str) -> DataFrame:
    """Values present more than once (NULL ignored)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_records"))
              .filter(F.col("n_records") > 1))


def not_null_failures(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def relationship_failures(child: DataFrame, col: str, parent: DataFrame, field_: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent row (left-anti join)."""
    p = parent.select(F.col(field_).alias("_parent_key")).filter(F.col("_parent_key").isNotNull())
    c = child.filter(F.col(col).isNotNull())
    return c.join(p, c[col] == p._parent_key, "left_anti")


def accepted_values_failures(df: DataFrame, col: str, values: list) -> DataFrame:
    """Rows whose value is outside the list (NULL is not a failure)."""
    return df.filter(~F.col(col).isin(*values))


def expression_failures(df: DataFrame, expression: str, where: str | None = None) -> DataFrame:
    """Rows (within ``where``) for which ``expression`` is false."""
    x = df.filter(F.expr(where)) if where else df
    return x.filter(~F.expr(expression))


def orphan_prs(fct_prs: DataFrame) -> DataFrame:
    return fct_prs.filter(F.col("repo_key").isNull()).select("pr_key", "repo_key")


def negative_cycle_time(fct_prs: DataFrame) -> DataFrame:
    h = F.col("time_to_merge_hours")
    return (fct_prs.filter((F.col("is_merged") == True) & h.isNotNull() & (h < 0))  # noqa: E712
                   .select("pr_key", "pull_request_id", "time_to_merge_hours"))


# Fixed values from the reference's source freshness block.
WARN_AFTER_HOURS = 24
ERROR_AFTER_HOURS = 72


def freshness(df: DataFrame, source: str, loaded_at: str, as_of: dt.datetime,
              warn_after_hours: int = WARN_AFTER_HOURS, error_after_hours: int = ERROR_AFTER_HOURS) -> DataFrame:
    """One row: newest ``loaded_at`` value, its age in hours at ``as_of`` (an
    explicit parameter, so the check is reproducible) and pass/warn/error.
    An empty table is an error."""
    asof = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    m = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    age = round_scaled((F.unix_micros(asof.cast("timestamp")) - F.unix_micros(F.col("max_loaded_at").cast("timestamp")))
                       / F.lit(3_600_000_000.0), 3)
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
               .when(F.col("age_hours") > error_after_hours, "error")
               .when(F.col("age_hours") > warn_after_hours, "warn").otherwise("pass"))
    return (m.select(F.lit(source).alias("source"), "max_loaded_at", age.alias("age_hours"))
             .withColumn("status", status))


@dataclass
class ModelTests:
    model: str
    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    # (column, expression, where)
    expressions: list[tuple[str, str, str | None]] = field(default_factory=list)
    accepted: list[tuple[str, list]] = field(default_factory=list)
    # (column, parent model, parent field)
    relationships: list[tuple[str, str, str]] = field(default_factory=list)


@dataclass(frozen=True)
class DeclaredTest:
    number: int
    model: str
    test: str
    column: str
    parent: tuple[str, str] | None = None        # relationships: model and field

    @property
    def name(self) -> str:
        return f"{self.test}_{self.model}_{self.column}"


def declared(specs: list[ModelTests]) -> list[DeclaredTest]:
    """The tests of all specs, numbered; a column's expressions count one each."""
    listed = [(s.model, kind, c, parent) for s in specs for kind, c, parent in [
        *[("unique", c, None) for c in s.unique], *[("not_null", c, None) for c in s.not_null],
        *[("expression_is_true", c, None) for c, _, _ in s.expressions], *[("accepted_values", c, None) for c, _ in s.accepted],
        *[("relationships", c, (p, f)) for c, p, f in s.relationships]]]
    return [DeclaredTest(k, *x) for k, x in enumerate(listed)]


# Kinds of entries: a row that fails by itself, a value to be counted, a child's
# key and a parent's key.
_FAILED, _VALUE, _CHILD, _PARENT = "failed", "value", "child", "parent"


def _entries(df: DataFrame, spec: ModelTests | None, tests: list[DeclaredTest], parents: set[tuple[str, str]],
             model: str, with_rows: bool) -> DataFrame:
    """One pass over a model: ``(kind, scope, key, number)`` of every value that must be
    unique, every key that must have a parent, every key that is one, and every
    row that fails by itself (its key: the row as JSON, or NULL)."""
    def entry(when: Column, kind: str, scope: str, key: Column, number: int) -> Column:
        return F.when(when, F.struct(F.lit(kind).alias("kind"), F.lit(scope).alias("scope"), key.alias("key"), F.lit(number).alias("number")))
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])) if with_rows else F.lit(None).cast("string")
    checks = {}
    if spec is not None:
        checks = {("not_null", c): [F.col(c).isNull()] for c in spec.not_null}
        for c, e, w in spec.expressions:
            cond = ~F.expr(e) if w is None else (F.expr(w) & ~F.expr(e))
            checks.setdefault(("expression_is_true", c), []).append(F.coalesce(cond, F.lit(False)))
        for c, vals in spec.accepted:
            checks.setdefault(("accepted_values", c), []).append(F.coalesce(~F.col(c).isin(*vals), F.lit(False)))
    out = []
    for t in tests:
        value = F.col(t.column).cast("string")
        if t.test == "unique":
            out.append(entry(value.isNotNull(), _VALUE, f"{t.model}.{t.column}", value, t.number))
        elif t.test == "relationships":
            out.append(entry(value.isNotNull(), _CHILD, ".".join(t.parent), value, t.number))
        else:
            out.append(entry(checks[t.test, t.column].pop(0), _FAILED, "", row, t.number))
    out += [entry(F.col(f).isNotNull(), _PARENT, f"{m}.{f}", F.col(f).cast("string"), -1) for m, f in sorted(parents) if m == model]
    return df.select(F.explode(F.filter(F.array(*out), lambda e: e.isNotNull())).alias("e")).select("e.*")


def failing_keys(models: dict[str, DataFrame], specs: list[ModelTests], with_rows: bool = False) -> DataFrame:
    """``(number, key, n_records)`` of everything that fails: a value that occurs more
    than once, a child's key without a parent (how many rows have it), a row that
    fails by itself. Every model is scanned once and there is one shuffle: all
    entries are counted by (scope, key), partially before it, so a key that a
    third of the rows share is one row per task."""
    tests = declared(specs)
    parents = {t.parent for t in tests if t.parent}
    of = {s.model: s for s in specs}
    rows = None
    for model in dict.fromkeys([s.model for s in specs] + sorted(m for m, _ in parents)):
        own = [t for t in tests if t.model == model]
        part = _entries(models[model], of.get(model), own, parents, model, with_rows)
        rows = part if rows is None else rows.unionByName(part)
    links = [t.number for t in tests if t.parent]
    n = F.count_if
    grouped = rows.groupBy(F.when(F.col("kind") == _PARENT, _CHILD).otherwise(F.col("kind")).alias("kind"), "scope", "key",
                           F.when(F.col("kind").isin(_FAILED, _VALUE), F.col("number")).alias("number")).agg(
        F.count(F.lit(1)).alias("n"), n(F.col("kind") == _PARENT).alias("found"),
        *[n(F.col("number") == k).alias(f"c{k}") for k in links])
    linked = [F.when((F.col("kind") == _CHILD) & (F.col("found") == 0) & (F.col(f"c{k}") > 0),
                     F.struct(F.lit(k).alias("number"), F.col(f"c{k}").alias("n_records"))) for k in links]
    itself = F.when((F.col("kind") == _FAILED) | ((F.col("kind") == _VALUE) & (F.col("n") > 1)),
                    F.struct(F.col("number").alias("number"), F.col("n").alias("n_records")))
    return (grouped.select("key", F.explode(F.filter(F.array(itself, *linked), lambda x: x.isNotNull())).alias("x"))
            .select("x.number", "key", "x.n_records"))


def summary_of(failing: DataFrame, specs: list[ModelTests]) -> DataFrame:
    """``(model, test, column_name, failures)`` of every declared test. A ``unique``
    failure is a value that occurs more than once, as the failing rows of
    :func:`unique_failures` are; the other failures are rows."""
    tests = declared(specs)
    unique = [t.number for t in tests if t.test == "unique"]
    counted = failing.groupBy("number").agg(
        F.sum(F.when(F.col("number").isin(unique), 1).otherwise(F.col("n_records"))).alias("failures"))
    named = failing.sparkSession.createDataFrame([(t.number, t.model, t.test, t.column) for t in tests],
                                                 "number int, model string, test string, column_name string")
    return (named.join(counted, "number", "left")
            .select("model", "test", "column_name", F.coalesce("failures", F.lit(0)).cast("bigint").alias("failures")))


def profile(df: DataFrame, spec: ModelTests) -> DataFrame:
    """The checks of one model by itself."""
    return run_mart_tests({spec.model: df}, [spec])


# The reference's declared mart tests (fixed list).
MART_TESTS = [
    ModelTests("dim_repositories", unique=["repo_key", "repository_id"],
               not_null=["repo_key", "repository_id", "repository_full_name"]),
    ModelTests("dim_users", unique=["user_key", "user_id"], not_null=["user_key", "user_id", "user_login", "is_bot"]),
    ModelTests("dim_dates", unique=["date_key", "date"], not_null=["date_key", "date"]),
    ModelTests("fct_pull_requests", unique=["pr_key", "pull_request_id"],
               not_null=["pr_key", "pull_request_id", "repo_key", "is_merged"],
               expressions=[("time_to_merge_hours", "time_to_merge_hours >= 0", "time_to_merge_hours is not null")],
               relationships=[("repo_key", "dim_repositories", "repo_key"), ("author_key", "dim_users", "user_key"),
                              ("created_date_key", "dim_dates", "date_key")]),
    ModelTests("fct_issues", unique=["issue_key", "issue_id"], not_null=["issue_key", "issue_id", "repo_key"],
               expressions=[("time_to_close_hours", "time_to_close_hours >= 0", "time_to_close_hours is not null")],
               relationships=[("repo_key", "dim_repositories", "repo_key"), ("author_key", "dim_users", "user_key")]),
    ModelTests("fct_commits", unique=["commit_key", "commit_sha"], not_null=["commit_key", "commit_sha", "repo_key"],
               relationships=[("repo_key", "dim_repositories", "repo_key"), ("author_key", "dim_users", "user_key")]),
    ModelTests("fct_stargazers", unique=["stargazer_key"],
               not_null=["stargazer_key", "repo_key", "user_key", "starred_at"],
               relationships=[("repo_key", "dim_repositories", "repo_key"), ("user_key", "dim_users", "user_key")]),
    ModelTests("pr_cycle_time", not_null=["period_type", "repository_name", "merged_pr_count"],
               accepted=[("period_type", ["weekly", "monthly"])]),
    ModelTests("contributor_engagement", not_null=["repository_full_name", "year", "month", "unique_contributors"]),
    ModelTests("release_velocity", not_null=["period_type", "repository_name", "release_count"],
               accepted=[("period_type", ["monthly", "quarterly"])]),
]


# The reference's declared source (bronze) and staging tests (fixed list).
# Bronze column names are this package's (`_parent_row_id` for child tables).
SOURCE_TESTS = [
    ModelTests("b_repositories", unique=["id"], not_null=["id"]),
    ModelTests("b_issues", unique=["id"], not_null=["id"]),
    ModelTests("b_pull_requests", unique=["id"], not_null=["id"]),
    ModelTests("b_issue_comments", unique=["id"], not_null=["id"]),
    ModelTests("b_commits", not_null=["sha"]),
    ModelTests("b_releases", unique=["id"], not_null=["id"]),
    ModelTests("b_stargazers", not_null=["user_id"]),
    ModelTests("b_contributors", not_null=["user_id"]),
    ModelTests("c_issue_labels", not_null=["_parent_row_id"]),
    ModelTests("c_pr_labels", not_null=["_parent_row_id"]),
    ModelTests("c_repository_topics", not_null=["_parent_row_id"]),
]
STAGING_TESTS = [
    ModelTests("stg_repositories", unique=["repository_id"], not_null=["repository_id", "repository_name", "owner_login"]),
    ModelTests("stg_issues", unique=["issue_id"], not_null=["issue_id", "issue_number", "repository_full_name"]),
    ModelTests("stg_pull_requests", unique=["pull_request_id"], not_null=["pull_request_id", "pr_number", "is_merged"]),
    ModelTests("stg_issue_comments", unique=["comment_id"], not_null=["comment_id", "issue_number"]),
    ModelTests("stg_commits", not_null=["commit_sha", "commit_date"]),
    ModelTests("stg_releases", unique=["release_id"], not_null=["release_id", "tag_name"]),
    ModelTests("stg_stargazers", not_null=["user_id", "starred_at"]),
    ModelTests("stg_users", unique=["user_id"], not_null=["user_id", "user_login"]),
    ModelTests("stg_issue_labels", not_null=["issue_dlt_id", "label_name"]),
    ModelTests("stg_pr_labels", not_null=["pr_dlt_id", "label_name"]),
    ModelTests("stg_repository_topics", not_null=["repository_dlt_id", "topic_name"]),
]
# Only with landed reviews (the model is disabled in the reference).
REVIEW_TESTS = [ModelTests("stg_pr_reviews", unique=["review_id"],
                           not_null=["review_id", "pull_request_number", "reviewer_user_id"])]


def run_mart_tests(models: dict[str, DataFrame], specs: list[ModelTests] = MART_TESTS) -> DataFrame:
    """Summary of every declared test, from one pass over each model."""
    return summary_of(failing_keys(models, specs), specs)


def run_tests_in_steps(models: Mapping[str, DataFrame], steps: list[list[ModelTests]]) -> DataFrame:
    """:func:`run_mart_tests` over a few models after the others. The summary of a step is
    saved before the next begins, so that the disk holds the shuffles of its models and
    their parents, not of all. A parent of many steps is best a written table."""
    return reduce(DataFrame.unionByName, [saved(run_mart_tests(models, specs), f"tests-{specs[0].model}") for specs in steps])


def store_declared_failures(models: dict[str, DataFrame], specs: list[ModelTests], root: str) -> tuple[str, DataFrame]:
    """Failing records of all declared tests (SNK-03) in one write below
    ``<root>/test_results/declared``, a folder per failing test: the key (or the row as
    JSON) and how many records have it. Returns the folder and the summary, which
    is counted from what was written."""
    tests = declared(specs)
    path = f"{root.rstrip('/')}/test_results/declared"
    failing = failing_keys(models, specs, with_rows=True)
    spark = failing.sparkSession
    named = spark.createDataFrame([(t.number, t.name) for t in tests], "number int, test_name string")
    (failing.join(F.broadcast(named), "number").hint("rebalance", "test_name")
     .write.mode("overwrite").partitionBy("test_name").parquet(path))
    written = spark.read.schema("number int, key string, n_records bigint, test_name string").parquet(path)
    return path, summary_of(written, specs)


def store_failures(failing: DataFrame, root: str, test_name: str) -> str:
    """Persist failing rows (SNK-03) under ``<root>/test_results/<test>``."""
    path = f"{root.rstrip('/')}/test_results/{test_name}"
    failing.write.mode("overwrite").parquet(path)
    return path
