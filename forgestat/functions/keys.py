"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's key function:
# fields are cast to text, NULL replaced by this marker, joined by '-', md5 hex.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*cols: str | Column) -> Column:
    parts = [F.coalesce(F.col(c).cast("string") if isinstance(c, str) else c.cast("string"),
                        F.lit(NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws(SEPARATOR, *parts))


def row_id(entity: str, *pk: str | Column) -> Column:
    """Stable loader row id: md5 of the entity name and the primary key."""
    parts = [F.col(c) if isinstance(c, str) else c for c in pk]
    return F.md5(F.concat_ws("|", F.lit(entity), *[p.cast("string") for p in parts]))
