"""Give the driver's star-schema tables the bronze shape.

Plain projections, joins and aggregations over ``region nation customer
supplier orders lineitem events``; every derived value is a function of the
source row so the DuckDB oracle can state the same projection in SQL. The
mapping:

* repositories   nation x region; owner = region name, repo = nation name
* people         customer; login gets a ``[bot]`` suffix when key % 50 = 0
* issues         every order; an odd key's also names its pull request (an attribute)
* pull_requests  every order; repo = nation of the customer
* issue_comments line items (repeated primary keys -> exercised upsert)
* commits        events; author NULL for ``error`` events
* releases       every order; drafts, prereleases and unpublished ones are attributes
* stargazers     (customer, supplier nation) first ship date
* contributors   (customer, repo) order counts
* pr_reviews     every line item (disabled entity)
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from forgestat.functions.keys import row_id
from forgestat.functions.sizing import broadcast_if_bounded, dealt_out
from forgestat.params import WarehouseParams

# Fixed adapter values (shared with the oracle SQL in plans/oracle_sql.py).
FORBIDDEN_EVERY, MISSING_EVERY = 11, 13   # keys of pull requests whose reviews cannot be read
TORN_EVERY = 17                    # keys of issues whose landed line is cut short
BOT_EVERY = 50                     # key % 50 = 0 -> login gets "[bot]"
URL_ROOT = "https://forge.example/"
API_ROOT = "https://api.forge.example/repos/"
# label name -> (id, color, description, default)
LABELS = {
    "bug": (1, "d73a4a", "defect", True),
    "Bug": (2, "b60205", "defect (legacy)", False),
    "Enhancement": (3, "a2eeef", "improvement", True),
    "feature": (4, "0e8a16", "new capability", False),
    "debug": (5, "cccccc", "debugging aid", False),
}
# order priority -> labels attached to the issue / pull request
PRIORITY_LABELS = {
    "1-URGENT": ["bug"],
    "2-HIGH": ["Enhancement", "Bug"],
    "3-MEDIUM": ["feature"],
    "4-NOT SPECIFIED": [],
    "5-LOW": ["debug"],
}
LANGUAGES = ["Python", "C++", "Rust", "Go", "SQL"]   # by region key % 5
REVIEW_STATES = {"A": "APPROVED", "R": "CHANGES_REQUESTED"}  # else COMMENTED

LABEL_TYPE = "array<struct<id:bigint,name:string,color:string,description:string,default:boolean>>"


def _minutes(ts: Column, n: Column) -> Column:
    return ts + F.make_dt_interval(mins=n.cast("int"))


def _seconds(ts: Column, n: Column) -> Column:
    return ts + F.make_dt_interval(secs=n.cast("int"))


def _login(name: Column, key: Column) -> Column:
    return F.concat(name, F.when(key % BOT_EVERY == 0, F.lit("[bot]")).otherwise(F.lit("")))


def _label_struct(name: str) -> Column:
    lid, color, desc, default = LABELS[name]
    return F.struct(F.lit(lid).cast("bigint").alias("id"), F.lit(name).alias("name"),
                    F.lit(color).alias("color"), F.lit(desc).alias("description"),
                    F.lit(default).alias("default"))


def _labels_for(priority: Column) -> Column:
    expr = F.array().cast(LABEL_TYPE)
    for prio, names in PRIORITY_LABELS.items():
        if names:
            expr = F.when(priority == prio, F.array(*[_label_struct(n) for n in names])).otherwise(expr)
    return expr


class DriverBronze:
    """Bronze DataFrames derived from the driver's parquet tables.

    Each property is a lazy DataFrame; nothing is computed until an action.
    """

    TABLES = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")

    def __init__(self, spark: SparkSession, sf_dir: str, params: WarehouseParams):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.params = params
        self._reads: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._reads:
            self._reads[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._reads[name]

    # columns by which a table's rows are dealt out
    DEALT_BY = {"customer": ("c_custkey", "c_nationkey"), "orders": ("o_orderkey", "o_custkey"),
                "events": ("event_id", "user_id")}

    def dealt(self, name: str, *columns: str) -> DataFrame:
        """A table dealt out by ``DEALT_BY``, or some columns of it dealt out by their
        values, so that no step on it holds a whole row group (``sizing.dealt_out``)."""
        if not columns:
            return dealt_out(self.table(name), *self.DEALT_BY[name])
        return dealt_out(self.table(name).select(*columns), *columns)

    def lines(self, *columns: str, by: str = "l_orderkey") -> DataFrame:
        """Columns of the line items, dealt out by the key of the step that follows, so that
        it needs no shuffle of its own: an order's key, or ``l_orderkey_line``, the id of an
        order's line as comments and reviews have it. Rows of a key are a handful, and all
        steps on them stream or spill.

        ``line_key`` stands beside ``l_orderkey`` after the dealing: a column made there keeps
        the planner from dealing the scan's rows over the session's number of partitions."""
        li = self.table("lineitem")
        line = (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("l_orderkey_line")
        if by == "l_orderkey_line":
            return dealt_out(li.select(*[line if c == "l_orderkey_line" else c for c in columns]), by)
        raw = dict.fromkeys("l_linenumber" if c == "l_orderkey_line" else c for c in columns)
        return dealt_out(li.select(*raw), by).select(
            *[line if c == "l_orderkey_line" else c for c in columns], F.col("l_orderkey").alias("line_key"))

    @cached_property
    def known_rows(self) -> dict[str, int]:
        """Rows of the tables that may be small enough to be broadcast, from their files'
        footers: the nations of all regions (joined) and the suppliers."""
        places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        return {"repo_map": places.count(), "supplier": self.table("supplier").count()}

    def _load_id(self) -> Column:
        return F.lit(self.params.load_id)

    # ---- shared building blocks -------------------------------------------------
    @cached_property
    def repo_map(self) -> DataFrame:
        """nation x region -> (nationkey, owner, repo), broadcast behind its count."""
        n = self.table("nation")
        r = self.table("region")
        return broadcast_if_bounded(n.join(r, n.n_regionkey == r.r_regionkey).select(
            n.n_nationkey.alias("nationkey"), r.r_regionkey.alias("regionkey"),
            r.r_name.alias("_owner"), n.n_name.alias("_repo")), self.known_rows["repo_map"])

    @cached_property
    def people(self) -> DataFrame:
        c = self.dealt("customer")
        return c.select(
            c.c_custkey.alias("user_id"),
            _login(c.c_name, c.c_custkey).alias("login"),
            F.when(c.c_custkey % BOT_EVERY == 0, "Bot").otherwise("User").alias("user_type"),
            c.c_nationkey.alias("nationkey"))

    @cached_property
    def people_repo(self) -> DataFrame:
        p = self.people
        return p.join(self.repo_map, "nationkey").drop("nationkey", "regionkey")

    @cached_property
    def suppliers(self) -> DataFrame:
        s = self.table("supplier")
        return broadcast_if_bounded(s.select(
            s.s_suppkey.alias("supp_id"), _login(s.s_name, s.s_suppkey).alias("supp_login"),
            s.s_nationkey.alias("supp_nationkey")), self.known_rows["supplier"])

    @cached_property
    def order_repo(self) -> DataFrame:
        o = self.dealt("orders").select("o_orderkey", "o_custkey")
        return o.join(self.people_repo, o.o_custkey == F.col("user_id")).select(
            "o_orderkey", "_owner", "_repo")

    @cached_property
    def orders_x(self) -> DataFrame:
        """Orders with author, repository, and activity times."""
        o = self.dealt("orders")
        li = self.lines("l_orderkey", "l_shipdate")
        last_ship = li.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
        x = (o.join(self.people_repo, o.o_custkey == F.col("user_id"))
              .join(last_ship, o.o_orderkey == last_ship.l_orderkey, "left"))
        created = _minutes(F.col("o_orderdate"), F.col("o_orderkey") % 1440)
        end = _minutes(F.col("last_ship"), (F.col("o_orderkey") * 7) % 1440)
        x = (x.withColumn("created_at", created)
              .withColumn("end_at", end)
              .withColumn("merged_at", F.when(F.col("o_orderstatus") == "F", F.col("end_at")))
              .withColumn("closed_at", F.when(F.col("o_orderstatus").isin("F", "O"), F.col("end_at")))
              .withColumn("updated_at", F.greatest(F.col("created_at"),
                                                   F.coalesce(F.col("end_at"), F.col("created_at")))))
        return x

    def _issue_like(self, x: DataFrame, entity: str, prefix: str) -> list[Column]:
        k = F.col("o_orderkey")
        return [
            k.alias("id"),
            F.concat(F.lit(prefix), k.cast("string")).alias("node_id"),
            row_id(entity, "o_orderkey").alias("_row_id"),
            k.alias("number"),
            F.concat(F.lit("Order "), k.cast("string"), F.lit(" ("), F.col("o_orderpriority"), F.lit(")")).alias("title"),
            F.when(k % 5 == 0, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit("Placed by customer "), F.col("o_custkey").cast("string"))).alias("body"),
            F.when(F.col("closed_at").isNotNull(), "closed").otherwise("open").alias("state"),
            F.lit(False).alias("locked"),
            F.col("login").alias("user__login"),
            F.col("user_id").alias("user__id"),
            F.when(k % 3 == 0, F.col("login")).alias("assignee__login"),
            F.when(k % 3 == 0, F.col("user_id")).alias("assignee__id"),
        ]

    # ---- bronze entities ----------------------------------------------------------
    @cached_property
    def repositories(self) -> DataFrame:
        m = self.repo_map
        # topics beyond region and nation: the market segments of the nation's
        # customers (a set over a fixed domain, so bounded per group)
        stars = self.table("customer").groupBy(F.col("c_nationkey").alias("nationkey")).agg(
            F.count(F.lit(1)).cast("int").alias("n_customers"),
            F.array_sort(F.collect_set(F.lower(F.col("c_mktsegment")))).alias("segments"))
        forks = self.table("supplier").groupBy(F.col("s_nationkey").alias("nationkey")).agg(
            F.count(F.lit(1)).cast("int").alias("n_suppliers"))
        x = m.join(stars, "nationkey", "left").join(forks, "nationkey", "left")
        k = F.col("nationkey")
        lang = F.lit(None).cast("string")
        for i, name in enumerate(LANGUAGES):
            lang = F.when(F.col("regionkey") % len(LANGUAGES) == i, name).otherwise(lang)
        full = F.concat(F.col("_owner"), F.lit("/"), F.col("_repo"))
        n_cust = F.coalesce(F.col("n_customers"), F.lit(0))
        return x.select(
            k.cast("bigint").alias("id"),
            F.concat(F.lit("R_"), k.cast("string")).alias("node_id"),
            row_id("repositories", k).alias("_row_id"),
            F.col("_owner").alias("owner__login"),
            F.col("regionkey").cast("bigint").alias("owner__id"),
            F.col("_repo").alias("name"),
            full.alias("full_name"),
            F.concat(F.lit("Activity of "), F.col("_repo")).alias("description"),
            F.lit(False).alias("private"),
            (k % 10 == 9).alias("archived"),
            F.lit(False).alias("disabled"),
            F.concat(F.lit(URL_ROOT), full).alias("html_url"),
            F.date_add(F.lit("1990-01-01").cast("date"), k).cast("timestamp_ntz").alias("created_at"),
            F.lit("2024-01-31 00:00:00").cast("timestamp_ntz").alias("updated_at"),
            F.lit("2024-01-30 12:00:00").cast("timestamp_ntz").alias("pushed_at"),
            (k.cast("bigint") * 1024).alias("size"),
            n_cust.alias("stargazers_count"),
            n_cust.alias("watchers_count"),
            F.coalesce(F.col("n_suppliers"), F.lit(0)).alias("forks_count"),
            ((k * 7) % 17).cast("int").alias("open_issues_count"),
            lang.alias("language"),
            F.lit("main").alias("default_branch"),
            F.when(k % 3 == 0, "MIT").when(k % 3 == 1, "Apache-2.0").alias("license__name"),
            F.lit(True).alias("has_issues"),
            (k % 2 == 0).alias("has_projects"),
            F.lit(True).alias("has_wiki"),
            F.lit(False).alias("has_pages"),
            F.lit(True).alias("has_downloads"),
            F.concat(F.array(F.lower(F.col("_owner")), F.concat(F.lit("nation-"), k.cast("string"))),
                     F.coalesce(F.col("segments"), F.array().cast("array<string>"))).alias("topics"),
            "_owner", "_repo",
            self._load_id().alias("_load_id"),
        )

    @cached_property
    def issues(self) -> DataFrame:
        x = self.orders_x
        k = F.col("o_orderkey")
        return x.select(
            *self._issue_like(x, "issues", "I_"),
            (k % 7).cast("int").alias("comments"),
            "created_at", "updated_at", "closed_at",
            F.when(k % 2 == 1, F.concat(F.lit(URL_ROOT), F.col("_owner"), F.lit("/"), F.col("_repo"),
                                        F.lit("/pull/"), k.cast("string"))).alias("pull_request__url"),
            _labels_for(F.col("o_orderpriority")).alias("labels"),
            "_owner", "_repo", self._load_id().alias("_load_id"))

    @cached_property
    def pull_requests(self) -> DataFrame:
        x = self.orders_x
        k = F.col("o_orderkey")
        ks = k.cast("string")
        return x.select(
            *self._issue_like(x, "pull_requests", "PR_"),
            (k % 9 == 0).alias("draft"),
            F.concat(F.lit("topic-"), ks).alias("head__ref"),
            F.md5(F.concat(F.lit("head|"), ks)).alias("head__sha"),
            F.lit("main").alias("base__ref"),
            F.md5(F.concat(F.lit("base|"), ks)).alias("base__sha"),
            F.when(F.col("merged_at").isNotNull(), F.md5(F.concat(F.lit("merge|"), ks))).alias("merge_commit_sha"),
            "created_at", "updated_at", "closed_at", "merged_at",
            _labels_for(F.col("o_orderpriority")).alias("labels"),
            "_owner", "_repo", self._load_id().alias("_load_id"))

    @cached_property
    def _comment_versions(self) -> DataFrame:
        """Landed comment versions, narrow: key, cursor, tie-break and the raw
        fields every other column is a function of."""
        return self._comment_columns(self.lines("l_orderkey", "l_orderkey_line", "l_partkey", "l_suppkey", "l_shipdate",
                                                by="l_orderkey_line"))

    def _comment_columns(self, li: DataFrame, *more: str) -> DataFrame:
        created = _minutes(F.col("l_shipdate"), F.col("l_partkey") % 1440)
        return li.select(
            F.col("l_orderkey_line").alias("id"),
            _seconds(created, F.col("l_suppkey") % 3600).alias("updated_at"),
            F.concat(F.lit("part "), F.col("l_partkey").cast("string"), F.lit(" from supplier "),
                     F.col("l_suppkey").cast("string")).alias("body"),
            created.alias("created_at"), "l_orderkey", "l_suppkey", *more)

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows of line items with their order's repository and their supplier."""
        return rows.join(self.order_repo, F.col("line_key" if "line_key" in rows.columns else "l_orderkey") == F.col("o_orderkey")).join(
            self.suppliers, F.col("l_suppkey") == F.col("supp_id"), "left")

    def _comment_facts(self, x: DataFrame) -> DataFrame:
        """Placed comments without the columns that follow from the id alone."""
        return x.select(
            "id",
            F.concat(F.lit(API_ROOT), F.col("_owner"), F.lit("/"), F.col("_repo"), F.lit("/issues/"),
                     F.col("l_orderkey").cast("string")).alias("issue_url"),
            "body",
            F.col("supp_login").alias("user__login"),
            F.col("l_suppkey").alias("user__id"),
            "created_at", "updated_at", "_owner", "_repo")

    def issue_comments_named(self, facts: DataFrame) -> DataFrame:
        """The facts with the columns that follow from the id, in bronze order: md5 texts
        that a merge of narrow rows does not have to sort and move."""
        cid = F.col("id")
        return facts.select(
            cid,
            F.concat(F.lit("IC_"), cid.cast("string")).alias("node_id"),
            row_id("issue_comments", cid).alias("_row_id"),
            "issue_url", "body", "user__login", "user__id", "created_at", "updated_at", "_owner", "_repo",
            self._load_id().alias("_load_id"))

    def _comment_rows(self, versions: DataFrame) -> DataFrame:
        return self.issue_comments_named(self._comment_facts(self._placed(versions)))

    @cached_property
    def issue_comments_facts(self) -> DataFrame:
        """Every landed comment row, narrow: see :meth:`issue_comments_named`. Dealt out by
        id as a merge needs them, before their texts are made: these are longer than what
        they are made of."""
        placed = self._placed(self.lines("l_orderkey", "l_orderkey_line", "l_partkey", "l_suppkey", "l_shipdate")).select(
            "l_orderkey", "l_orderkey_line", "l_partkey", "l_suppkey", "l_shipdate", "supp_login", "_owner", "_repo")
        return self._comment_facts(self._comment_columns(dealt_out(placed, "l_orderkey_line"), "supp_login", "_owner", "_repo"))

    @cached_property
    def issue_comments_landed(self) -> DataFrame:
        """Every landed comment row; primary keys repeat (newer versions)."""
        return self._comment_rows(self._comment_versions)

    @cached_property
    def issue_comments(self) -> DataFrame:
        """Bronze after the merge write mode: newest version per primary key.
        The merge runs on the narrow landed versions; the wide derived columns
        (URLs, hashes, the author's login) are added to the survivors only.
        Equal to ``upsert(issue_comments_landed, ...)`` because every derived
        column is a function of the kept version."""
        from forgestat.sources.ingest import upsert
        return self._comment_rows(upsert(self._comment_versions, ["id"], ["updated_at", "body"]))

    @cached_property
    def commits(self) -> DataFrame:
        e = self.dealt("events")
        x = e.join(self.people_repo, e.user_id == self.people_repo.user_id, "left").drop(self.people_repo.user_id)
        eid = F.col("event_id").cast("string")
        authored = F.col("event_type") != "error"
        email = F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com"))
        sha = F.md5(eid)
        return x.select(
            sha.alias("sha"),
            F.concat(F.lit("C_"), eid).alias("node_id"),
            row_id("commits", sha).alias("_row_id"),
            F.when(authored, F.col("login")).alias("author__login"),
            F.when(authored, F.col("user_id")).alias("author__id"),
            F.col("login").alias("committer__login"),
            F.col("user_id").alias("committer__id"),
            F.col("login").alias("commit__author__name"),
            email.alias("commit__author__email"),
            F.col("ts").alias("commit__author__date"),
            F.col("login").alias("commit__committer__name"),
            email.alias("commit__committer__email"),
            _minutes(F.col("ts"), F.col("event_id") % 60).alias("commit__committer__date"),
            F.concat(F.col("event_type"), F.lit(": "), F.col("props")).alias("commit__message"),
            F.md5(F.concat(F.lit("tree|"), eid)).alias("commit__tree__sha"),
            (F.col("event_id") % 3).cast("bigint").alias("commit__comment_count"),
            "_owner", "_repo", self._load_id().alias("_load_id"))

    @cached_property
    def releases(self) -> DataFrame:
        o = self.dealt("orders")
        x = o.join(self.people_repo, o.o_custkey == F.col("user_id"))
        k = F.col("o_orderkey")
        ks = k.cast("string")
        return x.select(
            k.alias("id"),
            F.concat(F.lit("RE_"), ks).alias("node_id"),
            row_id("releases", k).alias("_row_id"),
            F.col("user_id").alias("author__id"),
            F.concat(F.lit("v"), ks).alias("tag_name"),
            F.lit("main").alias("target_commitish"),
            F.concat(F.lit("Release "), ks).alias("name"),
            (k % 20 == 0).alias("draft"),
            (F.col("o_orderstatus") == "P").alias("prerelease"),
            F.concat(F.lit("Notes for "), ks).alias("body"),
            F.col("o_orderdate").alias("created_at"),
            F.when(k % 25 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("o_orderdate")).alias("published_at"),
            "_owner", "_repo", self._load_id().alias("_load_id"))

    @cached_property
    def stargazers(self) -> DataFrame:
        li = self.lines("l_orderkey", "l_suppkey", "l_shipdate")
        o = dealt_out(self.table("orders").select("o_orderkey", "o_custkey"), "o_orderkey")
        s = self.suppliers.select("supp_id", F.col("supp_nationkey").alias("s_nationkey"))
        first = (li.join(o, li.line_key == o.o_orderkey)
                   .join(s, li.l_suppkey == s.supp_id)
                   .groupBy("o_custkey", "s_nationkey")
                   .agg(F.min("l_shipdate").alias("starred_at")))
        people = self.people.select("user_id", "login", "user_type")
        x = (first.join(people, first.o_custkey == people.user_id)
                  .join(self.repo_map, first.s_nationkey == self.repo_map.nationkey))
        return x.select(
            "starred_at",
            F.col("user_id").alias("user_id"),
            F.col("login").alias("user_login"),
            "user_type", "_owner", "_repo", self._load_id().alias("_load_id"))

    @cached_property
    def contributors(self) -> DataFrame:
        o = self.dealt("orders").select("o_custkey")
        x = o.join(self.people_repo, o.o_custkey == F.col("user_id"))
        return (x.groupBy("user_id", "login", "user_type", "_owner", "_repo")
                 .agg(F.count(F.lit(1)).cast("int").alias("contributions"))
                 .select("user_id", F.col("login").alias("user_login"), "user_type", "contributions",
                         "_owner", "_repo", self._load_id().alias("_load_id")))

    @cached_property
    def _review_facts(self) -> DataFrame:
        """Landed review rows without the columns that follow from the id alone, dealt out by
        id before their texts are made."""
        columns = ["l_orderkey", "l_orderkey_line", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"]
        placed = self.lines(*columns).join(self.order_repo, F.col("line_key") == F.col("o_orderkey"))
        x = dealt_out(placed.select(*columns, "_owner", "_repo"), "l_orderkey_line")
        state = F.lit("COMMENTED")
        for flag, name in REVIEW_STATES.items():
            state = F.when(F.col("l_returnflag") == flag, name).otherwise(state)
        return x.select(
            F.col("l_orderkey_line").alias("id"),
            F.col("_owner"), F.col("_repo"),
            F.col("l_orderkey").alias("_pr_number"),
            F.when(F.col("l_suppkey") % 10 == 0, F.lit(None).cast("bigint")).otherwise(F.col("l_suppkey")).alias("user__id"),
            state.alias("state"),
            F.concat(F.lit("review of part "), F.col("l_partkey").cast("string"), F.lit(" flag "),
                     F.col("l_returnflag")).alias("body"),
            _minutes(F.col("l_shipdate"), F.col("l_partkey") % 1440).alias("submitted_at"))

    def _review_rows(self, facts: DataFrame) -> DataFrame:
        rid = F.col("id")
        return facts.select(
            "id", "_owner", "_repo", "_pr_number", "user__id", "state", "body",
            F.md5(F.concat(F.lit("review|"), rid.cast("string"))).alias("commit_id"),
            "submitted_at", self._load_id().alias("_load_id"), row_id("pr_reviews", rid).alias("_row_id"))

    @cached_property
    def pr_reviews_landed(self) -> DataFrame:
        """Landed review rows (the reference extracts none; SURVEY D14): every
        line item; review ids repeat like comments."""
        return self._review_rows(self._review_facts)

    @cached_property
    def pr_reviews(self) -> DataFrame:
        """Reviews after de-duplication on the key (latest submission wins). The merge
        runs on the narrow rows; equal to merging the landed ones, whose other
        columns follow from the key."""
        from forgestat.sources.ingest import upsert
        return self._review_rows(upsert(self._review_facts, ["id"], ["submitted_at", "body", "user__id"]))

    @cached_property
    def review_responses(self) -> DataFrame:
        """One answer per order: its reviews, or by the key's rule a forbidden or a
        missing one without. An order has a handful of line items."""
        r = self.pr_reviews
        n = F.col("_pr_number")
        status = F.when(n % FORBIDDEN_EVERY == 0, 403).when(n % MISSING_EVERY == 0, 404).otherwise(200)
        review = F.struct("id", F.struct(F.lit(None).cast("string").alias("login"), F.col("user__id").alias("id"),
                                         F.lit(None).cast("string").alias("type")).alias("user"),
                          "state", "body", "commit_id", F.col("submitted_at").cast("timestamp").alias("submitted_at"))
        return r.groupBy("_owner", "_repo", "_pr_number").agg(F.collect_list(review).alias("all")).select(
            "_owner", "_repo", "_pr_number", status.cast("int").alias("status"), F.when(status == 200, F.col("all")).alias("reviews"))

    ENTITIES = ("repositories", "issues", "pull_requests", "issue_comments", "commits",
                "releases", "stargazers", "contributors")

    def entities(self, with_reviews: bool = False) -> "LazyTables":
        names = self.ENTITIES + (("pr_reviews",) if with_reviews else ())
        return LazyTables({n: (lambda n=n: getattr(self, n)) for n in names})


class LazyTables(Mapping):
    """Name -> DataFrame mapping that builds each plan on first access."""

    def __init__(self, builders: dict):
        self._builders = dict(builders)
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)
