"""Landed JSON -> bronze shape (SRC-01 ... SRC-09, SRC-14 ... SRC-16).

The landing zone holds one directory per entity, partitioned by repository
(``<root>/<entity>/_owner=<o>/_repo=<r>/*.json``): provenance columns come from
the partition path, so one read covers every configured repository (no
driver loop over repositories, SRC-17). Schemas are declared, never inferred;
malformed rows are kept in ``_corrupt_record``, and fields that the schema does
not declare in ``_extra``: as (path, JSON text) beside the row, from where
:func:`with_fields` makes typed columns of them, for rows of any age.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from forgestat.functions.keys import row_id

# ISO text with a zone suffix is parsed as an instant (zoned type) and turned into
# UTC wall clock (timestamp_ntz) by to_bronze.
S, L, I, B, TS = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType(), T.TimestampType()


def _st(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


USER = _st(("login", S), ("id", L), ("type", S))
LABEL = _st(("id", L), ("name", S), ("color", S), ("description", S), ("default", B))
REVIEW = (("id", L), ("user", USER), ("state", S), ("body", S), ("commit_id", S), ("submitted_at", TS))
# Declared schemas of the landed API objects (only the fields the models read).
SCHEMAS: dict[str, T.StructType] = {
    "repositories": _st(("id", L), ("node_id", S), ("owner", USER), ("name", S), ("full_name", S),
                        ("description", S), ("private", B), ("archived", B), ("disabled", B),
                        ("html_url", S), ("created_at", TS), ("updated_at", TS), ("pushed_at", TS),
                        ("size", L), ("stargazers_count", I), ("watchers_count", I), ("forks_count", I),
                        ("open_issues_count", I), ("language", S), ("default_branch", S),
                        ("license", _st(("name", S))), ("topics", T.ArrayType(S)),
                        ("has_issues", B), ("has_projects", B), ("has_wiki", B), ("has_pages", B),
                        ("has_downloads", B)),
    "issues": _st(("id", L), ("node_id", S), ("number", L), ("title", S), ("body", S), ("state", S),
                  ("locked", B), ("user", USER), ("assignee", USER), ("comments", I),
                  ("created_at", TS), ("updated_at", TS), ("closed_at", TS),
                  ("pull_request", _st(("url", S))), ("labels", T.ArrayType(LABEL))),
    "pull_requests": _st(("id", L), ("node_id", S), ("number", L), ("title", S), ("body", S), ("state", S),
                         ("locked", B), ("draft", B), ("user", USER), ("assignee", USER),
                         ("head", _st(("ref", S), ("sha", S))), ("base", _st(("ref", S), ("sha", S))),
                         ("merge_commit_sha", S), ("created_at", TS), ("updated_at", TS),
                         ("closed_at", TS), ("merged_at", TS), ("labels", T.ArrayType(LABEL))),
    "issue_comments": _st(("id", L), ("node_id", S), ("issue_url", S), ("body", S), ("user", USER),
                          ("created_at", TS), ("updated_at", TS)),
    "commits": _st(("sha", S), ("node_id", S), ("author", USER), ("committer", USER),
                   ("commit", _st(("author", _st(("name", S), ("email", S), ("date", TS))),
                                  ("committer", _st(("name", S), ("email", S), ("date", TS))),
                                  ("message", S), ("tree", _st(("sha", S))), ("comment_count", L)))),
    "releases": _st(("id", L), ("node_id", S), ("author", USER), ("tag_name", S), ("target_commitish", S),
                    ("name", S), ("draft", B), ("prerelease", B), ("body", S),
                    ("created_at", TS), ("published_at", TS)),
    # star events arrive as {"starred_at": ..., "user": {...}}
    "stargazers": _st(("starred_at", TS), ("user", USER)),
    "contributors": _st(("id", L), ("login", S), ("type", S), ("contributions", I)),
    "pr_reviews": _st(*REVIEW, ("_pr_number", L)),
    # one answer per pull request: its HTTP status and, if it could be read, its reviews
    "pr_review_responses": _st(("_pr_number", L), ("status", I), ("reviews", T.ArrayType(_st(*REVIEW)))),
}

# Primary keys and write modes per entity (merge everywhere in effect, SURVEY D4;
# stars keyed with the repository, SURVEY D18).
PRIMARY_KEYS = {
    "repositories": ["id"], "issues": ["id"], "pull_requests": ["id"], "issue_comments": ["id"],
    "commits": ["sha"], "releases": ["id"], "stargazers": ["user_id", "_owner", "_repo", "starred_at"],
    "contributors": ["user_id", "_owner", "_repo"], "pr_reviews": ["id"],
}
CURSORS = {
    "issues": "updated_at", "pull_requests": "updated_at", "issue_comments": "updated_at",
    "commits": "commit__committer__date", "releases": "published_at", "stargazers": "starred_at",
}


def flatten(df: DataFrame, sep: str = "__", keep_arrays: bool = True) -> DataFrame:
    """Nested structs -> ``parent__child`` columns, recursively (SRC-15).
    Arrays are kept whole for :func:`child_table`."""
    cols: list[Column] = []

    def walk(prefix: str, name: str, dtype: T.DataType) -> None:
        path = f"{prefix}.`{name}`" if prefix else f"`{name}`"
        alias = f"{prefix.replace('`', '').replace('.', sep)}{sep}{name}" if prefix else name
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                walk(path, f.name, f.dataType)
        elif keep_arrays or not isinstance(dtype, T.ArrayType):
            cols.append(F.col(path).alias(alias))

    for f in df.schema.fields:
        walk("", f.name, f.dataType)
    return df.select(*cols)


def child_table(parent: DataFrame, array_col: str, parent_id: str = "_row_id", fields: dict[str, str] | None = None) -> DataFrame:
    """Array -> child rows with the parent's row id and the 0-based position
    (SRC-16). Struct elements are spread to columns; scalars land in ``value``.
    Parents with an empty or NULL array contribute no rows. ``fields`` adds typed
    columns of elements' fields that the schema does not declare, from the parent's
    ``_extra``: dotted path inside the element -> type, as :func:`with_fields`."""
    path = array_col.replace("__", ".")
    more = {f"_f{k}": (f"{path}[].{name}", name, kind) for k, (name, kind) in enumerate((fields or {}).items())}
    exploded = parent.select(F.col(parent_id).alias("_parent_row_id"),
                             *[F.from_json(_extra_value(p), "array<string>").alias(c) for c, (p, _, _) in more.items()],
                             F.posexplode(F.col(array_col)).alias("_list_idx", "_elem"))
    added = [_typed(F.get(c, F.col("_list_idx").cast("int")), kind).alias(name.replace(".", "__"))
             for c, (_, name, kind) in more.items()]
    exploded = exploded.withColumn("_list_idx", F.col("_list_idx").cast("bigint"))
    etype = parent.schema[array_col].dataType.elementType
    if isinstance(etype, T.StructType):
        return exploded.select("_parent_row_id", "_list_idx",
                               *[F.col("_elem").getField(f.name).alias(f.name) for f in etype.fields], *added)
    return exploded.select("_parent_row_id", "_list_idx", F.col("_elem").alias("value"), *added)


def landed_schema(entity: str) -> T.StructType:
    """A fresh copy of the entity's declared schema plus the partition columns
    (``StructType.add`` mutates, so the shared declaration is never extended)."""
    return T.StructType(list(SCHEMAS[entity].fields)).add("_owner", S).add("_repo", S)


def read_landed(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """One read over every repository partition of an entity."""
    schema = landed_schema(entity).add("_corrupt_record", S)
    return (spark.read.schema(schema)
            .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
            .json(f"{root.rstrip('/')}/{entity}"))


EXTRA = T.ArrayType(_st(("path", S), ("value", S)))


def open_lines(text: DataFrame) -> DataFrame:
    """Lines of landed files (``value`` and other columns), one object each:
    a line that is a list gives its elements, a blank line nothing."""
    listed = F.when(F.ltrim("value").startswith("["), F.from_json("value", "array<string>"))
    return (text.filter(F.trim("value") != "")
            .withColumn("value", F.explode(F.coalesce(listed, F.array("value")))))


def extra_fields(text: Column, entity: str) -> Column:
    """Fields of a landed object that the entity's schema does not declare, at the
    top, inside declared objects and inside the elements of declared lists, as
    (dotted path, value): strings as they are, other values as JSON text. A field
    of elements (``labels[].slug``) has one value, the JSON list of the elements'
    values in their order, null where an element lacks it. Empty for a line that
    is no object."""
    fields = T.MapType(S, S)

    def undeclared(text: Column, prefix: str, declared: T.StructType) -> Column:
        # of a name that an object holds twice the last value counts
        held = F.from_json(text, fields)
        names = [f.name for f in declared.fields]
        own = F.transform(F.map_entries(F.map_filter(held, lambda k, v: ~k.isin(names))),
                          lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("path"), e["value"].alias("value")))
        inner = []
        for f in declared.fields:
            value = F.try_element_at(held, F.lit(f.name))
            if isinstance(f.dataType, T.StructType):
                inner.append(undeclared(value, f"{prefix}{f.name}.", f.dataType))
            elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
                inner.append(in_elements(F.from_json(value, T.ArrayType(fields)), f"{prefix}{f.name}[].", f.dataType.elementType))
        return F.concat(F.coalesce(own, F.array().cast(EXTRA)), *inner)

    def objects(held: Column, name: str) -> Column:
        return F.transform(held, lambda m: F.from_json(F.try_element_at(m, F.lit(name)), fields))

    def in_elements(held: Column, prefix: str, declared: T.StructType) -> Column:
        names = [f.name for f in declared.fields]
        keys = F.array_distinct(F.flatten(F.transform(held, lambda m: F.coalesce(F.map_keys(m), F.array().cast("array<string>")))))
        own = F.transform(F.filter(keys, lambda k: ~k.isin(names)), lambda k: F.struct(
            F.concat(F.lit(prefix), k).alias("path"), F.to_json(F.transform(held, lambda m: F.try_element_at(m, k))).alias("value")))
        inner = [in_elements(objects(held, f.name), f"{prefix}{f.name}.", f.dataType)
                 for f in declared.fields if isinstance(f.dataType, T.StructType)]
        return F.concat(F.coalesce(own, F.array().cast(EXTRA)), *inner)
    return undeclared(text, "", SCHEMAS[entity])


def new_fields(rows: DataFrame) -> DataFrame:
    """``(path, n_rows)`` of the fields held in ``_extra``."""
    return (rows.select(F.explode("_extra.path").alias("path")).groupBy("path").agg(F.count("*").alias("n_rows")))


def _extra_value(path: str) -> Column:
    return F.get(F.filter("_extra", lambda e: e["path"] == path), F.lit(0))["value"]


def _typed(text: Column, kind: str) -> Column:
    nested = kind.lower().startswith(("array<", "struct<", "map<"))
    return F.from_json(text, kind) if nested else text.try_cast(kind)


def with_fields(table: DataFrame, fields: dict[str, str]) -> DataFrame:
    """The bronze table with typed columns from ``_extra``: dotted path -> type.
    ``user.site_admin`` becomes ``user__site_admin``. Null where the field is
    missing or its value is not of that type. For fields of list elements see
    :func:`child_table`."""
    return table.select("*", *[_typed(_extra_value(p), k).alias(p.replace(".", "__")) for p, k in fields.items()])


# Landed name -> bronze name where the loader's projection renames a field.
_RENAMED = {"stargazers": {"user__id": "user_id", "user__login": "user_login", "user__type": "user_type"},
            "contributors": {"id": "user_id", "login": "user_login", "type": "user_type"}}


def as_landed(bronze: DataFrame, entity: str) -> DataFrame:
    """Bronze rows as landed JSON text (``value``, ``_owner``, ``_repo``): the
    fields of the declared schema, nested again, instants in ISO form. Fields
    that bronze does not hold, and nulls, are left out of the text."""
    renamed = _RENAMED.get(entity, {})
    held = {f.name: f.dataType for f in bronze.schema.fields}

    def value(path: str, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.StructType):
            return F.struct(*[value(f"{path}__{f.name}" if path else f.name, f.dataType).alias(f.name)
                              for f in dtype.fields])
        name = renamed.get(path, path)
        return F.col(name).cast(dtype) if name in held else F.lit(None).cast(dtype)

    text = F.to_json(value("", SCHEMAS[entity]), {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"})
    return bronze.select(text.alias("value"), "_owner", "_repo")


def parse_landed(lines: DataFrame, entity: str) -> DataFrame:
    """Landed JSON text (``value``) -> the declared schema, provenance columns
    and ``_corrupt_record`` (the text of a malformed line, else null), as
    :func:`read_landed` gives for files."""
    schema = T.StructType(list(SCHEMAS[entity].fields)).add("_corrupt_record", S)
    record = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    others = [c for c in lines.columns if c != "value"]
    return lines.select(record.alias("r"), *others).select("r.*", *others)


# Fixed values from the reference: answers that are skipped; any other failure ends the run.
FORBIDDEN, NOT_FOUND = 403, 404


def open_reviews(responses: DataFrame) -> DataFrame:
    """Answers -> one row per review with its answer's number and status, and one
    with null review fields for an answer without reviews (outer explode), so
    that forbidden and empty answers stay countable. A missing status is 200."""
    carried = [c for c in responses.columns if c not in ("status", "reviews")]
    opened = responses.select(*carried, F.coalesce("status", F.lit(200)).alias("status"), F.explode_outer("reviews").alias("r"))
    return opened.select(*carried, "status", "r.*")


def readable_reviews(opened: DataFrame) -> DataFrame:
    """Review rows in the landed shape of ``pr_reviews``. Fails on an answer that
    is neither read, forbidden nor missing, as the extraction does."""
    ok = F.col("status").between(200, 299)
    known = ok | F.col("status").isin(FORBIDDEN, NOT_FOUND)
    bad = F.raise_error(F.concat(F.lit("review answer with status "), F.col("status").cast("string")))
    return (opened.filter(F.when(known, ok).otherwise(bad.cast("boolean"))).filter(F.col("id").isNotNull()).drop("status"))


def review_access(opened: DataFrame) -> DataFrame:
    """Per repository: answers by status and readable reviews (SRC-04's counts).
    One aggregation per pull request first, so an answer's rows count once."""
    ok = F.col("status").between(200, 299)
    answers = opened.groupBy("_owner", "_repo", "_pr_number", "status").agg(F.count("id").alias("n"))
    return answers.groupBy("_owner", "_repo").agg(
        F.count_if(ok).alias("readable_pull_requests"),
        F.count_if(F.col("status") == FORBIDDEN).alias("forbidden_count"),
        F.count_if(F.col("status") == NOT_FOUND).alias("not_found_count"),
        F.coalesce(F.sum(F.when(ok, F.col("n"))), F.lit(0)).alias("accessible_count"))


def to_bronze(landed: DataFrame, entity: str, load_id: str) -> DataFrame:
    """Flatten, project stars / contributors to their bronze columns, stamp the
    loader metadata (SRC-14)."""
    df = landed
    kept = ["_extra"] if "_extra" in landed.columns else []
    if entity == "stargazers":
        df = df.select("starred_at", F.col("user.id").alias("user_id"), F.col("user.login").alias("user_login"),
                       F.col("user.type").alias("user_type"), "_owner", "_repo", *kept)
    elif entity == "contributors":
        df = df.select(F.col("id").alias("user_id"), F.col("login").alias("user_login"),
                       F.col("type").alias("user_type"), "contributions", "_owner", "_repo", *kept)
    elif entity == "pr_reviews":
        df = df.select("id", "_owner", "_repo", "_pr_number", F.col("user.id").alias("user__id"),
                       "state", "body", "commit_id", "submitted_at", *kept)
    else:
        df = flatten(df.drop("_corrupt_record"))
    # instant -> wall clock of the session zone, pinned to UTC by session.configure
    df = df.select(*[F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
                     if isinstance(f.dataType, T.TimestampType) else F.col(f"`{f.name}`")
                     for f in df.schema.fields])
    pk = PRIMARY_KEYS[entity]
    return df.withColumn("_row_id", row_id(entity, *pk)).withColumn("_load_id", F.lit(load_id))
