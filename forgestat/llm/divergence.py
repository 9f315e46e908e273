"""Operator 12: how far the word use of sources of one language differs.

1. Document frequencies: tasks count, for terms they have hashed to 64 bits, in
   how many of their documents each stands, and sum these counts in bounded
   tables before they are shuffled by (lang, term).
2. Terms in at least ``least`` documents of a language are its vocabulary. They
   are range partitioned and sorted; each shard becomes a minimal acyclic
   transducer (``transducer.py``) from term to lexicographic ordinal; ordinals
   of a language run on through its shards.
3. Recounting: the whole texts are streamed through the transducers, a bounded
   slab of them at a time (one slab up to SLAB_BYTES); counts by (lang, source,
   ordinal) are summed in the tasks first, then by shuffle. A language's own
   counts travel as rows without a source.
4. Blocks of ordinals: a task gets the counts of a block's terms for two tiles
   of sources and gives partial sums for pairs of sources and the block's best
   terms of each source. Shares and values are exact integers.
5. Ranks; ties among terms go to the smaller ordinal, which is byte order.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forgestat.llm import textnp
from forgestat.llm.common import saved, ship_package
from forgestat.llm.transducer import Streamer, Transducer, build

SHARD_TERMS = 20_000      # terms of a transducer
SLAB_BYTES = 48 << 20     # transducers that tasks hold at a time
HELD = 300_000            # counts that a task holds before it sends them on
BLOCK_TERMS = 512         # terms of a block
TILE = 64                 # sources of a tile
UNIT = 10 ** 9            # shares are integers of this unit
SMOOTH = 2                # added to every count

SEPARATORS = np.ones(256, dtype=bool)        # terms: ASCII letters and all that is not ASCII
SEPARATORS[0x41:0x5B] = SEPARATORS[0x61:0x7B] = SEPARATORS[0x80:] = False

_LANG = np.uint64(0xD6E8FEB86659FD93)


def _names(column: pa.Array) -> tuple[np.ndarray, list[str]]:
    coded = column.combine_chunks().dictionary_encode() if isinstance(column, pa.ChunkedArray) else column.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.to_pylist()


def _cut_out(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The words as a string array."""
    length = end - start
    at = np.zeros(len(start) + 1, np.int64)
    np.cumsum(length, out=at[1:])
    data = buf[np.repeat(start - at[:-1], length) + np.arange(at[-1])]
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(at.tobytes()), pa.py_buffer(data.tobytes()))


def _grouped(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, where each stands first, and sums of ``n`` by key."""
    order = np.argsort(key, kind="stable")
    at = key[order]
    begin = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]])) if len(at) else np.zeros(0, np.int64)
    return at[begin], order[begin], np.add.reduceat(n[order], begin) if len(begin) else np.zeros(0, np.int64)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> (lang, term, df): documents of the task that hold the term."""
    codes: dict[str, int] = {}
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]] = []      # key, df, lang, term

    def merged():
        key, n, lang = (np.concatenate([h[i] for h in held]) for i in range(3))
        terms = pa.concat_arrays([h[3] for h in held])
        key, first, n = _grouped(key, n)
        return key, n, lang[first], terms.take(pa.array(first))

    def leave() -> Iterator[pa.RecordBatch]:
        names = pa.array(list(codes), pa.string())
        for _, n, lang, terms in held:
            for a in range(0, len(n), 50_000):
                yield pa.RecordBatch.from_arrays(
                    [names.take(pa.array(lang[a:a + 50_000])), terms.slice(a, 50_000).cast(pa.string()),
                     pa.array(n[a:a + 50_000].astype(np.int64))], names=["lang", "term", "df"])
        held.clear()
        codes.clear()
    for batch in batches:
        index, names = _names(batch.column("lang"))
        of_row = np.array([codes.setdefault(x, len(codes)) for x in names], np.int64)[index]
        for piece in textnp.pieces(batch.column("text"), SEPARATORS):
            doc = piece.doc_of_word()
            lang = of_row[piece.lo:piece.hi][doc]
            key = textnp.mix(piece.word_hash() + (lang.astype(np.uint64) + np.uint64(1)) * _LANG)
            order = np.argsort(key, kind="stable")       # documents ascend within a term
            at, of = key[order], doc[order]
            if not len(at):
                continue
            new = np.concatenate([[True], at[1:] != at[:-1]])
            begin = np.flatnonzero(new)
            n = np.add.reduceat((new | np.concatenate([[True], of[1:] != of[:-1]])).astype(np.int64), begin)
            first = order[begin]
            held.append((at[begin], n, lang[first], _cut_out(piece.buf, piece.start[first], piece.end[first])))
        if sum(len(h[0]) for h in held) >= HELD:
            held[:] = [merged()]
            if len(held[0][0]) >= HELD // 2:
                yield from leave()
    if held:
        held[:] = [merged()]
        yield from leave()
    textnp.release()


def _shard(key: tuple, rows: pa.Table) -> pa.Table:
    """(lang, shard, mid, term) rows of one shard -> its transducer."""
    rows = rows.sort_by("mid")
    terms = rows["term"].cast(pa.binary()).to_pylist()
    return pa.table({"lang": rows["lang"][:1], "shard": rows["shard"][:1], "low": rows["mid"][:1].cast(pa.int64()),
                     "terms": pa.array([len(terms)], pa.int64()), "first": pa.array([terms[0]], pa.binary()),
                     "machine": pa.array([build(terms).to_bytes()], pa.binary())})


def vocabulary(texts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``texts(lang, text)`` -> ``(lang, term, shard, mid)`` of the kept terms, where
    mid ascends with (lang, term), and ``(lang, shard, low, terms, first, machine)``."""
    kept = saved(texts.select("lang", "text").mapInArrow(_frequencies, "lang string, term string, df long")
                 .groupBy("lang", "term").agg(F.sum("df").alias("df")).filter(F.col("df") >= least).drop("df"), "kept")
    shards = max(1, -(-kept.count() // SHARD_TERMS))
    # terms of one shard boundary never share their first 8 bytes: words find their shard by them
    terms = saved(kept.withColumn("head", F.substring(F.encode("term", "UTF-8"), 1, 8))
                  .repartitionByRange(shards, "lang", "head").sortWithinPartitions("lang", "term")
                  .withColumn("mid", F.monotonically_increasing_id())
                  .select("lang", "term", F.shiftright("mid", 33).cast("int").alias("shard"), "mid"), "terms")
    machines = saved(terms.repartition(shards, "lang", "shard").groupBy("lang", "shard").applyInArrow(
        _shard, "lang string, shard int, low long, terms long, first binary, machine binary"), "machines")
    return terms, machines


_streamers: dict[str, Streamer] = {}      # of a worker: the slab at hand


def _recount(slab, name: str) -> Callable:
    """(lang, source, text) -> (lang, source, ord, n); rows of null source count the language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _streamers:
            _streamers.clear()
            _streamers[name] = Streamer([(lang, first, base, Transducer.from_bytes(raw)) for lang, first, base, raw in slab.value])
        machine = _streamers[name]
        codes: dict[tuple[str, str | None], int] = {}
        held_k, held_n, size = [], [], 0

        def leave() -> Iterator[pa.RecordBatch]:
            key, _, n = _grouped(np.concatenate(held_k), np.concatenate(held_n))
            names = [pa.array([c[i] for c in codes], pa.string()) for i in (0, 1)]
            for a in range(0, len(key), 50_000):
                part = key[a:a + 50_000]
                group = pa.array(part >> 40)
                yield pa.RecordBatch.from_arrays([names[0].take(group), names[1].take(group), pa.array(part & ((1 << 40) - 1)),
                                                  pa.array(n[a:a + 50_000])], names=["lang", "source", "ord", "n"])
        for batch in batches:
            lang_of, langs = _names(batch.column("lang"))
            source_of, sources = _names(batch.column("source"))
            both, where = np.unique(lang_of * len(sources) + source_of, return_inverse=True)
            named = [(langs[b // len(sources)], sources[b % len(sources)]) for b in both.tolist()]
            own = np.array([codes.setdefault(x, len(codes)) for x in named], np.int64)[where]
            whole = np.array([codes.setdefault((x, None), len(codes)) for x in langs], np.int64)[lang_of]
            for piece in textnp.pieces(batch.column("text"), SEPARATORS):
                doc = piece.doc_of_word() + piece.lo
                for code, lang in enumerate(langs):
                    some = np.flatnonzero(lang_of[doc] == code)
                    ordinal = machine.ordinals(lang, piece.buf, piece.start[some], piece.end[some])
                    known = ordinal >= 0
                    ordinal, at = ordinal[known], doc[some[known]]
                    for group in (own, whole):
                        key, _, n = _grouped((group[at] << 40) | ordinal, np.ones(len(at), np.int64))
                        held_k.append(key)
                        held_n.append(n)
                        size += len(key)
            if size >= 2 * HELD:
                key, _, n = _grouped(np.concatenate(held_k), np.concatenate(held_n))
                held_k, held_n, size = [key], [n], len(key)
                if size >= HELD:
                    yield from leave()
                    held_k, held_n, size = [], [], 0
                    codes.clear()
        if size:
            yield from leave()
        textnp.release()
    return run


def counts(texts: DataFrame, machines: DataFrame) -> DataFrame:
    """``(lang, source, ord, n)`` of all kept terms, n > 0; null source: the language."""
    spark = texts.sparkSession
    directory = machines.select("lang", "shard", "low", "terms", F.length("machine").alias("bytes")).orderBy("low").collect()
    out, slab, size = None, [], 0
    base: dict[str, int] = {}

    def pass_over(slab: list) -> DataFrame:
        names = spark.createDataFrame([(r["lang"], r["shard"]) for r, _ in slab], "lang string, shard int")
        machine = {(r["lang"], r["shard"]): r for r in
                   machines.join(F.broadcast(names), ["lang", "shard"]).select("lang", "shard", "first", "machine").collect()}
        held = spark.sparkContext.broadcast([(r["lang"], bytes(machine[r["lang"], r["shard"]]["first"]), at,
                                              bytes(machine[r["lang"], r["shard"]]["machine"])) for r, at in slab])
        return (texts.select("lang", "source", "text").mapInArrow(_recount(held, uuid.uuid4().hex), "lang string, source string, ord long, n long"))
    for row in directory:
        if slab and size + row["bytes"] > SLAB_BYTES:
            found = pass_over(slab)
            out, slab, size = found if out is None else out.unionByName(found), [], 0
        slab.append((row, base.get(row["lang"], 0)))
        base[row["lang"]] = base.get(row["lang"], 0) + row["terms"]
        size += row["bytes"]
    found = pass_over(slab)
    out = found if out is None else out.unionByName(found)
    return saved(out.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n")), "cells")


def shares(n: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(UNIT * (n + SMOOTH) / (total + SMOOTH * terms)), by long division
    in steps of three digits: exact for any count below 2 ** 53."""
    whole = total + SMOOTH * terms
    rest, out = n + SMOOTH, np.zeros(len(n), np.int64)
    out, rest = rest // whole, rest % whole
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q) ** 2 / (p + q)); shares are at most UNIT + 1, so it fits."""
    d = p - q
    return d * d // (p + q)


def _block(best: int) -> Callable:
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("other", pa.string()), ("ord", pa.int64()), ("value", pa.int64())])

    def run(key: tuple, cells: pa.Table, groups: pa.Table) -> pa.Table:
        lang, block, one, two = (k.as_py() for k in key)
        if not groups.num_rows:
            return schema.empty_table()
        rows = sorted(zip(*(groups[c].to_pylist() for c in ("source", "tile", "total", "terms")), strict=True),
                      key=lambda r: (r[0] is not None, r[0]))
        terms = rows[0][3]
        width = max(0, min(BLOCK_TERMS, terms - block * BLOCK_TERMS))
        place = {r[0]: k for k, r in enumerate(rows)}
        n = np.zeros((len(rows), width), np.int64)
        if cells.num_rows and width:
            index, names = _names(cells["source"].combine_chunks().fill_null("\0"))
            n[np.array([place[None if x == "\0" else x] for x in names])[index], cells["ord"].to_numpy() - block * BLOCK_TERMS] = cells["n"].to_numpy()
        p = np.array([shares(n[k], r[2], terms) for k, r in enumerate(rows)]) if width else n
        out: dict[str, list] = {name: [] for name in schema.names}

        def put(source, other, ordinal, value):
            for name, x in zip(schema.names, (lang, source, other, ordinal, value), strict=True):
                out[name].append(x)
        own = [k for k, r in enumerate(rows) if r[0] is not None and r[1] == one]
        others = own if one == two else [k for k, r in enumerate(rows) if r[0] is not None and r[1] == two]
        for k in own:
            to = [j for j in others if one != two or j > k]
            for j, value in zip(to, gap(p[k], p[to]).sum(axis=1).tolist(), strict=True):
                put(rows[k][0], rows[j][0], None, value)
        if one == two and width:
            q = p[place[None]]
            for k in own:
                more = np.flatnonzero((n[k] > 0) & (p[k] > q))
                value = gap(p[k][more], q[more])
                for at in np.lexsort((more, -value))[:best].tolist():
                    put(rows[k][0], None, block * BLOCK_TERMS + int(more[at]), int(value[at]))
        return pa.table(out, schema=schema)
    return run


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      least: int = 10, best: int = 10) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    Null texts, languages and sources are empty strings, which are a language
    and a source like others. Every row is a document, so repeated rows count
    again. A pair's value is that of its two groups summed over all kept terms
    of the language, 0 where it has none; a language's only source has no pairs.
    An empty table gives no rows. Only the three columns are read.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(to)
                          for c, to in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    terms, machines = vocabulary(texts, least)
    cells = counts(texts, machines)
    found = saved(texts.select("lang", "source").distinct(), "sources")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = found.unionByName(found.select("lang").distinct().withColumn("source", F.lit(None).cast("string")))
    groups = groups.alias("g").join(totals.alias("t"), (F.col("g.lang") == F.col("t.lang")) & F.col("g.source").eqNullSafe(F.col("t.source")), "left")
    sizes = machines.groupBy("lang").agg(F.sum("terms").alias("terms"))
    groups = saved(groups.select("g.lang", "g.source", F.coalesce("total", F.lit(0)).alias("total")).join(sizes, "lang", "left")
                   .withColumn("terms", F.coalesce("terms", F.lit(0))), "groups")
    most = groups.groupBy("lang").count().agg(F.max("count")).first()[0] or 1
    tiles = -(-most // TILE)
    tile = F.when(F.col("source").isNotNull(), F.pmod(F.xxhash64("source"), F.lit(tiles)).cast("int"))
    each = F.sequence(F.lit(0), F.lit(tiles - 1))
    # a source meets every tile; a language's own counts meet each tile by itself
    spread = lambda df: (df.withColumn("tile", tile).withColumn("with", F.explode(each))
                         .withColumn("one", F.least("tile", "with")).withColumn("two", F.greatest("tile", "with")).drop("with"))
    key = ["lang", "block", "one", "two"]
    left = spread(cells.withColumn("block", F.expr(f"cast(ord div {BLOCK_TERMS} as int)"))).select(*key, "source", "ord", "n")
    right = spread(groups.withColumn("block", F.explode(F.sequence(
        F.lit(0), F.greatest(F.lit(0), F.expr(f"cast((terms - 1) div {BLOCK_TERMS} as int)")))))).select(*key, "source", "tile", "total", "terms")
    parts = saved(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _block(best), "lang string, source string, other string, ord long, value long"), "parts")
    sums = (parts.filter("other is not null").groupBy("lang", "source", "other").agg(F.sum("value").alias("value")))
    pairs = sums.unionByName(sums.select("lang", F.col("other").alias("source"), F.col("source").alias("other"), "value"))
    by = Window.partitionBy("lang", "source")
    pairs = (pairs.withColumn("rank", F.row_number().over(by.orderBy(F.desc("value"), "other")))
             .select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank"))
    top = (parts.filter("ord is not null").withColumn("rank", F.row_number().over(by.orderBy(F.desc("value"), "ord")))
           .filter(F.col("rank") <= best).drop("other"))
    bases = machines.select("lang", "shard", "low", F.coalesce(F.sum("terms").over(
        Window.partitionBy("lang").orderBy("low").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    # names: every shard's first ordinal, then places within the shard
    named = terms.join(bases, ["lang", "shard"]).select("lang", (F.col("mid") - F.col("low") + F.col("base")).alias("ord"), "term")
    top = top.join(named, ["lang", "ord"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")
    return pairs.unionByName(top)


def oracle_sql() -> str:
    """The same in DuckDB SQL, without transducers."""
    return r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
words as (
  select r, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
kept as (select lang, term from words group by lang, term having count(distinct r) >= 10),
v as (select l.lang, count(kept.term) as v from (select distinct lang from d) l left join kept using (lang) group by l.lang),
cells as (select lang, source, term, count(*) as n from words join kept using (lang, term) group by all),
groups as (
  select g.lang, g.source, v.v, coalesce(sum(cells.n), 0)::hugeint as total
  from (select distinct lang, source from d) g join v using (lang) left join cells using (lang, source) group by all),
p as (
  select g.lang, g.source, k.term, coalesce(c.n, 0) as n,
         1 + (1000000000::hugeint * (coalesce(c.n, 0) + 2)) // (g.total + 2 * g.v) as p
  from groups g join kept k using (lang) left join cells c using (lang, source, term)),
q as (
  select k.lang, k.term, 1 + (1000000000::hugeint * (coalesce(sum(c.n), 0) + 2)) // (any_value(t.total) + 2 * any_value(t.v)) as q
  from kept k join (select lang, sum(total) as total, any_value(v) as v from groups group by lang) t using (lang)
  left join cells c using (lang, term) group by k.lang, k.term),
pair as (
  select a.lang, a.source, b.source as item, coalesce(sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)), 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join p x on x.lang = a.lang and x.source = a.source
  left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term group by all),
term as (
  select p.lang, p.source, p.term as item, ((p - q) * (p - q)) // (p + q) as value
  from p join q using (lang, term) where n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value, row_number() over (partition by lang, source order by value desc, item) as rank from pair
  union all
  select * from (select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item) as rank from term)
  where rank <= 10)
select lang, source, part, item, value::bigint as value, rank::integer as rank from ranked
"""
