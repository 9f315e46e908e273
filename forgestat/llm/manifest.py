"""Operator 13: a Merkle manifest of a dataset, with leaf places from bitmap ranks.

A row's leaf digest is that of its columns; the leaves of a group (a language)
stand in the order of their ids, and every two neighbours become one node until
one is left; the groups' roots make one more tree.

Places come without sorting the rows. Every group keeps a compressed bitmap of
its ids: 64-bit words, only those with a bit set, merged from the tasks' own by
a bitwise or. A popcount directory holds, for every word, how many rows lie
before it; it has four levels of at most 65536 entries each, so that no window
covers a group, however the ids are spread. A row's rank is its word's entry
plus the bits before its own. Words in which an id stands more than once get a
directory over (id, digest, place of writing) in place of the popcount.

Levels are reduced by slot arrays keyed by (group, place >> 10): a task puts up
to 1024 digests into their slots and computes ten levels of the tree at once;
their roots are the next round's slots. Paths come down the same way, one row
per array, and only the last step, per leaf, joins them with the leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forgestat.llm.common import saved, ship_package

STEPS = 10                   # levels that one slot array reduces
NULL_WORD = -(1 << 57) - 1   # before the words of all ids
SAME_ROWS = 16               # bits: rows of one place of writing that a task numbers


# --- places --------------------------------------------------------------------------------

def ranked(counts: DataFrame, group: list[str], chain: list[str]) -> DataFrame:
    """``counts`` (one row per group and chain, with ``n``) and ``before``, the sum
    of n of the group's rows with a smaller chain. One directory per column of
    the chain, so that a window covers the values of one column only."""
    out = None
    for depth in range(1, len(chain) + 1):
        keys = group + chain[:depth]
        level = counts if depth == len(chain) else counts.groupBy(*keys).agg(F.sum("n").alias("n"))
        over = Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
        level = level.withColumn("before", F.coalesce(F.sum("n").over(over), F.lit(0)))
        if out is not None:
            above = out.select(*keys[:-1], F.col("before").alias("above"))
            level = level.join(above, keys[:-1]).withColumn("before", F.col("before") + F.col("above")).drop("above")
        out = level
    return out


def places(rows: DataFrame) -> DataFrame:
    """``rows(tree, id, leaf, uid, ...)`` with ``slot``, the row's place among its
    tree's rows by (id, leaf), and ``total``, the tree's rows. Null ids come first."""
    rows = rows.withColumn("word", F.coalesce(F.shiftright("id", 6), F.lit(NULL_WORD)))
    words = saved(rows.groupBy("tree", "word").agg(
        F.coalesce(F.bit_or(F.expr("shiftleft(1L, cast(id & 63 as int))")), F.lit(0)).alias("bits"), F.count("*").alias("n"))
        .withColumn("again", F.bit_count("bits") < F.col("n")), "words")
    chain = ["top", "high", "low", "word"]
    index = ranked(words.select("*", *[F.shiftright("word", s).alias(c) for c, s in zip(chain, (48, 32, 16), strict=False)]),
                   ["tree"], chain)
    index = saved(index.join(words.groupBy("tree").agg(F.sum("n").alias("total")), "tree")
                  .select("tree", "word", "bits", "again", "before", "total"), "directory")
    below = F.expr("cast(bit_count(bits & ~shiftleft(-1L, cast(id & 63 as int))) as long)")
    plain = rows.join(index.filter("not again"), ["tree", "word"]).withColumn("slot", F.col("before") + below)
    out = plain.drop("word", "bits", "again", "before")
    again = index.filter("again").select("tree", "word", F.col("before").alias("start"), "total")
    if words.filter("again").isEmpty():
        return out
    chain = ["key", "head", "leaf", "part"]
    rows = saved(rows.join(again, ["tree", "word"]).withColumn("key", F.coalesce("id", F.lit(0)))
                 .withColumn("head", F.substring("leaf", 1, 4)).withColumn("part", F.shiftright("uid", SAME_ROWS)), "again")
    group = ["tree", "word"]
    offsets = ranked(rows.groupBy(*group, *chain).agg(F.count("*").alias("n")), group, chain).drop("n")
    number = F.row_number().over(Window.partitionBy(*group, *chain).orderBy("uid")) - 1
    more = (rows.withColumn("number", number).join(offsets, group + chain)
            .withColumn("slot", (F.col("start") + F.col("before") + F.col("number")).cast("long")))
    return out.unionByName(more.select(*out.columns))


# --- trees ---------------------------------------------------------------------------------

def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def steps_of(total: int, steps: int) -> int:
    """Levels that one array of a tree of ``total`` nodes reduces."""
    return min(steps, (total - 1).bit_length())


def reduced(nodes: list[bytes], steps: int) -> list[list[bytes]]:
    """The nodes and the levels above them; the last run of a level may be one node."""
    out = [nodes]
    for _ in range(steps):
        below = out[-1]
        out.append([digest(b"".join(below[k:k + 2])) for k in range(0, len(below), 2)])
    return out


def path_of(levels: list[list[bytes]], at: int) -> list[bytes]:
    """One step per level: b"<" or b">" (the sibling's side) and the sibling, or b"."."""
    out = []
    for nodes in levels[:-1]:
        other = at ^ 1
        out.append(b"." if other >= len(nodes) else (b"<" if other < at else b">") + nodes[other])
        at >>= 1
    return out


def folded(leaf: bytes, path: list[bytes]) -> bytes:
    for step in path:
        side, other = step[:1], step[1:]
        leaf = digest(other + leaf if side == b"<" else leaf + other)
    return leaf


def _slotted(members: list[dict]) -> list[dict]:
    out: list = [None] * len(members)
    for m in members:
        out[m["at"]] = m
    return out


def _rows_of(batches: Iterator[pa.RecordBatch], schema: pa.Schema, one: Callable[[dict], Iterator[tuple]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            rows = list(one(batch.slice(k, 1).to_pylist()[0]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


UP = pa.schema([("tree", pa.string()), ("slot", pa.int64()), ("digest", pa.string()), ("total", pa.int64())])
DOWN = pa.schema([("tree", pa.string()), ("slot", pa.int64()), ("path", pa.string())])
LEAVES = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                    ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])
_SQL = {pa.string(): "string", pa.int64(): "long", pa.bool_(): "boolean"}


def _mapped(df: DataFrame, schema: pa.Schema, one: Callable[[dict], Iterator[tuple]]) -> DataFrame:
    return df.mapInArrow(lambda batches: _rows_of(batches, schema, one), ", ".join(f"{f.name} {_SQL[f.type]}" for f in schema))


def _up(steps: int, row: dict) -> Iterator[tuple]:
    nodes = [m["digest"].encode() for m in _slotted(row["members"])]
    yield row["tree"], row["slot"], reduced(nodes, steps_of(row["total"], steps))[-1][0].decode(), -(-row["total"] >> steps)


def _down(steps: int, row: dict) -> Iterator[tuple]:
    levels = reduced([m["digest"].encode() for m in _slotted(row["members"])], steps_of(row["total"], steps))
    for at in range(len(row["members"])):
        yield row["tree"], (row["slot"] << steps) + at, " ".join([*[p.decode() for p in path_of(levels, at)], row["path"]]).strip()


def _verify(steps: int, row: dict) -> Iterator[tuple]:
    members = _slotted(row["members"])
    levels = reduced([m["digest"].encode() for m in members], steps_of(row["total"], steps))
    above = row["path"].encode().split()
    for at, m in enumerate(members):
        path = path_of(levels, at) + above
        end = folded((m["other"] or m["digest"]).encode(), path).decode()
        yield (m["doc_id"], m["digest"], row["subroot"], row["root"], digest(b"".join(p[1:] for p in path)).decode(),
               end, end == row["root"])


def _arrays(nodes: DataFrame, steps: int, *more: str) -> DataFrame:
    """``nodes(tree, slot, total, digest, ...)`` as slot arrays, keyed by (tree, slot >> steps)."""
    return (nodes.groupBy("tree", F.shiftright("slot", steps).alias("array"))
            .agg(F.collect_list(F.struct((F.col("slot") % (1 << steps)).cast("int").alias("at"), "digest", *more)).alias("members"),
                 F.max("total").alias("total"))
            .withColumnRenamed("array", "slot"))


def _climb(arrays: DataFrame, most: int, steps: int) -> tuple[list[DataFrame], DataFrame]:
    """All rounds of slot arrays from the given one up, and the roots ``(tree, digest)``;
    ``most``: the nodes of the largest tree."""
    rounds = [arrays]
    while True:
        nodes = saved(_mapped(rounds[-1].select("tree", "slot", "members", "total"), UP, partial(_up, steps)), "nodes")
        most = -(-most >> steps)
        if most <= 1:
            return rounds, nodes.select("tree", "digest")
        rounds.append(saved(_arrays(nodes, steps), "arrays"))


def _descend(rounds: list[DataFrame], paths: DataFrame, steps: int) -> DataFrame:
    """``paths(tree, path)`` above the roots -> ``(tree, slot, path)`` above the arrays of the first round."""
    paths = paths.withColumn("slot", F.lit(0).cast("long"))
    for arrays in rounds[:0:-1]:
        paths = saved(_mapped(arrays.select("tree", "slot", "members", "total").join(paths, ["tree", "slot"]), DOWN, partial(_down, steps)), "paths")
    return paths


def _field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def merkle_manifest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    source_col: str = "source", chars_col: str = "n_chars", steps: int = STEPS) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)``, one row
    per input row.

    Nulls are digested as ``-`` and differ from empty texts; the null language is
    a tree of its own, the first. Null ids stand before all others. Rows of one
    id stand in the order of their digests; equal rows are a leaf each and share
    the places of their digest in any order. An empty table gives no rows. Only
    the five columns are read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    id_, chars = F.col(id_col).cast("long"), F.col(chars_col).cast("long")

    def leaf(n: Column) -> Column:
        return F.sha2(F.concat(*[_field(c) for c in (id_, F.col(source_col), F.col(lang_col), n, F.col(text_col))]), 256)
    hit = (F.crc32(id_.cast("string").cast("binary")) % 7 == 0) & chars.isNotNull()
    tree = F.coalesce(F.concat(F.lit("="), F.col(lang_col).cast("string")), F.lit(""))       # null first
    rows = saved(docs.select(tree.alias("tree"), id_.alias("id"), leaf(chars).alias("leaf"), F.when(hit, leaf(chars + 1)).alias("other"),
                             F.monotonically_increasing_id().alias("uid")), "leaves")
    placed = places(rows).select("tree", "slot", "total", F.col("leaf").alias("digest"), "other", F.col("id").alias("doc_id"))
    leaves = saved(_arrays(placed, steps, "other", "doc_id"), "slots")
    most = leaves.agg(F.max("total")).first()[0] or 0
    rounds, subroots = _climb(leaves, most, steps)
    # the languages' own tree: their order comes from a range partitioned table
    ordered = saved(subroots.repartitionByRange("tree").sortWithinPartitions("tree")
                    .withColumn("uid", F.monotonically_increasing_id())
                    .select(F.lit("").alias("all"), F.shiftright("uid", 33).alias("part"), "tree", "uid", "digest"), "subroots")
    before = ranked(ordered.groupBy("all", "part").agg(F.count("*").alias("n")), ["all"], ["part"]).drop("n")
    n_trees = ordered.count()
    named = ordered.join(before, ["all", "part"]).select(
        F.col("tree").alias("name"), "digest", (F.col("before") + F.expr("uid & ((1L << 33) - 1)")).alias("slot"))
    forest = saved(_arrays(named.select(F.lit("").alias("tree"), "slot", F.lit(n_trees).cast("long").alias("total"), "digest"), steps), "forest")
    above, root = _climb(forest, n_trees, steps)
    root = root.first()
    root = root["digest"] if root else ""
    over = _descend([None, *above], spark.createDataFrame([("", "")], "tree string, path string"), steps)
    tops = saved(named.join(over.select("slot", "path"), "slot").select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), "path"), "tops")
    paths = _descend(rounds, tops.select("tree", "path"), steps)
    full = (leaves.join(paths, ["tree", "slot"]).join(tops.select("tree", "subroot"), "tree")
            .select("members", "total", "path", "subroot", F.lit(root).alias("root")))
    return _mapped(full, LEAVES, partial(_verify, steps))


def oracle_sql() -> str:
    """The same in DuckDB SQL: places by sorting, levels by recursion."""
    part = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')".format
    leaf = "sha256({0} || {1} || {2} || {{0}} || {3})".format(*[part(c) for c in ("doc_id", "source", "lang", "text")]).format
    # unsigned CRC-32 (polynomial 0xEDB88320) of the decimal id, one step per bit
    bit = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    return f"""
with recursive crc(doc_id, k, c) as (
  select distinct doc_id, 0, 4294967295::bigint from documents where doc_id is not null
  union all
  select doc_id, k + 1, {bit}
  from (select doc_id, k, case when k % 8 = 0 then xor(c, ascii(substr(doc_id::varchar, k // 8 + 1, 1))::bigint) else c end as c
        from crc where k < 8 * length(doc_id::varchar))),
hit as (select doc_id from crc where k = 8 * length(doc_id::varchar) and xor(c, 4294967295) % 7 = 0),
digests as (
  select doc_id, lang, {leaf(part("n_chars"))} as leaf,
         case when doc_id in (select doc_id from hit) then {leaf(part("(n_chars + 1)"))} end as other
  from documents),
leaves as (select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as pos from digests),
up(lang, level, pos, digest, n) as (
  select lang, 0, pos, leaf, count(*) over (partition by lang) from leaves
  union all
  select lang, level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (n + 1) // 2
  from up where n > 1 group by lang, level, pos // 2, n),
langs as (select lang, digest, row_number() over (order by lang nulls first) - 1 as pos from up where n = 1),
top(level, pos, digest, n) as (
  select 0, pos, digest, count(*) over () from langs
  union all
  select level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (n + 1) // 2 from top where n > 1 group by level, pos // 2, n),
steps as (
  select l.doc_id, l.lang, l.pos, 0 as stage, e.level, (l.pos >> e.level) as here, s.pos as side, s.digest
  from leaves l join (select distinct lang, level from up where n > 1) e on l.lang is not distinct from e.lang
  left join up s on s.lang is not distinct from l.lang and s.level = e.level and s.pos = xor(l.pos >> e.level, 1)
  union all
  select l.doc_id, l.lang, l.pos, 1, e.level, (g.pos >> e.level), s.pos, s.digest
  from leaves l join langs g on l.lang is not distinct from g.lang cross join (select distinct level from top where n > 1) e
  left join top s on s.level = e.level and s.pos = xor(g.pos >> e.level, 1)),
paths as (
  select lang, pos, coalesce(string_agg(digest, '' order by stage, level), '') as proof,
         list(case when digest is null then '.' when side < here then '<' || digest else '>' || digest end order by stage, level) as path
  from steps group by lang, pos),
ends as (
  select l.doc_id, l.leaf, g.digest as subroot, (select digest from top where n = 1) as root, sha256(coalesce(p.proof, '')) as proof_sha256,
         list_reduce(list_prepend(coalesce(l.other, l.leaf), coalesce(p.path, [])),
                     lambda a, x: case when x[1] = '<' then sha256(x[2:] || a) when x[1] = '>' then sha256(a || x[2:]) else sha256(a) end) as folded_root
  from leaves l join langs g on l.lang is not distinct from g.lang left join paths p on p.lang is not distinct from l.lang and p.pos = l.pos)
select *, folded_root = root as verified from ends
"""
