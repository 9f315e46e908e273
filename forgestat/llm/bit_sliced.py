"""Operator 11: exact top-k inner products by a bit-sliced index.

Every component x is the integer floor(256 * x). The index cuts the vectors
into blocks of rows that ascend by id; a block keeps, for every component, one
bitmap per binary digit of (value - smallest value of the block).

A query multiplies and adds with bitmap arithmetic only: for every binary digit
of its own components the slices of the components that have the digit are
added by a tree of carry-save adders, then the digits' sums, shifted, by one
more. Negative components take the complement of the slices, which changes a
query's scores in a block by a constant. The sum is again bit-sliced; the top
rows are selected from its most significant slice downward: rows with the digit
set are taken if they are at most k, else they are all that is left to choose
from. Rows that no slice parts have equal scores; they are taken by id.

Blocks and slabs of queries meet through an equi-join on the cells of a grid
(each side is repeated once per row or column of the grid); every pair of a
block and a slab is one row of bounded size. What leaves a task is k rows per
query and task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forgestat.llm.common import saved, ship_package

SCALE = 256.0
BLOCK = 8192         # rows of an index block
SLAB = 1024          # queries of a slab
CELL_BLOCKS = 8      # index blocks in a cell of the grid
LARGEST = 1 << 27    # a component's integer beyond this takes no part: scores must fit 64 bits


def quantised(column: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) integers floor(256 * x) of a list column of one length."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * x).astype(np.int64).reshape(len(column), dim)


def usable_vector(v: Column) -> Column:
    """Not null, without null or non-finite components, and within LARGEST."""
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > LARGEST / SCALE))
    return v.isNotNull() & ~F.coalesce(bad, F.lit(False))


# --- index ---------------------------------------------------------------------------------

def slices_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest values (dim) and slices (dim, width, words) of (rows, dim) integers."""
    n, dim = values.shape
    low = values.min(axis=0) if n and dim else np.zeros(dim, np.int64)
    rest = (values - low).astype(np.uint64)
    width = max(1, int(rest.max()).bit_length()) if rest.size else 1
    out = np.zeros((dim, width, -(-n // 64) * 8), dtype=np.uint8)
    for b in range(width):
        bits = ((rest >> np.uint64(b)) & np.uint64(1)).astype(bool)
        out[:, b, :-(-n // 8)] = np.packbits(bits.T, axis=1, bitorder="little")
    return low, out.view(np.uint64)


def _add(terms: np.ndarray) -> np.ndarray:
    """Carry-save tree: ``(n, width, words)`` -> at most two bit-sliced numbers
    with the same sum, ``(<= 2, wider, words)``."""
    while len(terms) > 2:
        n, width, words = terms.shape
        third, rest = n // 3, n % 3
        a, b, c = terms[:third], terms[third:2 * third], terms[2 * third:3 * third]
        out = np.zeros((2 * third + rest, width + 1, words), dtype=np.uint64)
        either = a ^ b
        np.bitwise_xor(either, c, out=out[:third, :width])
        np.bitwise_and(either, c, out=either)
        np.bitwise_or(a & b, either, out=out[third:2 * third, 1:])
        out[2 * third:, :width] = terms[3 * third:]
        terms = out
    return terms


def _ripple(pair: np.ndarray) -> np.ndarray:
    """One bit-sliced number from at most two."""
    if len(pair) == 1:
        return pair[0]
    a, b = pair
    out = np.zeros((a.shape[0] + 1, a.shape[1]), dtype=np.uint64)
    carry = np.zeros(a.shape[1], dtype=np.uint64)
    for r in range(a.shape[0]):
        half = a[r] ^ b[r]
        out[r] = half ^ carry
        carry = (a[r] & b[r]) | (half & carry)
    out[-1] = carry
    return out


def sliced_scores(slices: np.ndarray, low: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, int]:
    """Bit-sliced scores of a block's rows and the constant to add to them."""
    dim, width, words = slices.shape
    negative = query < 0
    size = np.abs(query)
    terms = slices ^ np.where(negative, np.uint64(2 ** 64 - 1), np.uint64(0))[:, None, None]
    sums = []
    for j in range(int(size.max()).bit_length() if dim else 0):
        some = np.flatnonzero((size >> j) & 1)
        if len(some):
            sums += [(j, s) for s in _add(terms[some])]
    constant = int(query @ low) - int(size[negative].sum()) * ((1 << width) - 1)
    if not sums:
        return np.zeros((1, words), dtype=np.uint64), constant
    wide = np.zeros((len(sums), max(j + len(s) for j, s in sums), words), dtype=np.uint64)
    for k, (j, s) in enumerate(sums):
        wide[k, j:j + len(s)] = s
    return _ripple(_add(wide)), constant


def top_rows(scores: np.ndarray, valid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of the k largest scores among the ``valid`` rows, from
    the most significant slice downward; the boundary goes to the first rows."""
    taken, open_ = np.zeros_like(valid), valid.copy()
    n_taken = 0
    if int(np.bitwise_count(open_).sum()) > k:
        for row in scores[::-1]:
            ones = open_ & row
            n = int(np.bitwise_count(ones).sum())
            if n_taken + n > k:
                open_ = ones
            else:
                taken |= ones
                n_taken += n
                open_ &= ~row
                if n_taken == k:
                    break
    at = np.concatenate([_positions(taken), _positions(open_)[:k - n_taken]])
    value = np.zeros(len(at), dtype=np.int64)
    for r, row in enumerate(scores):
        bit = (row[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
        value += bit.astype(np.int64) << r
    return at, value


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


# --- Spark jobs ----------------------------------------------------------------------------

def _packed(most: int, pack):
    """Rows (id, v, dim) in groups of at most ``most`` rows of one length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        serial = TaskContext.get().partitionId() << 32

        def full(dim: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            ids = np.concatenate([i for i, _ in held[dim]])
            values = np.concatenate([v for _, v in held[dim]])
            while len(ids) >= least and len(ids):
                yield ids[:most], values[:most]
                ids, values = ids[most:], values[most:]
            held[dim] = [(ids, values)]
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                held.setdefault(dim, []).append((part.column("id").to_numpy(), quantised(part.column("v"), dim)))
                if sum(len(i) for i, _ in held[dim]) >= most:
                    for ids, values in full(dim, most):
                        yield pack(dim, serial, ids, values)
                        serial += 1
        for dim in list(held):
            for ids, values in full(dim, 1):
                yield pack(dim, serial, ids, values)
                serial += 1
    return run


def _block(dim: int, serial: int, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    order = np.argsort(ids, kind="stable")
    low, slices = slices_of(values[order])
    return pa.RecordBatch.from_arrays(
        [pa.array([dim], pa.int32()), pa.array([serial], pa.int64()), pa.array([ids[order].astype("<i8").tobytes()]),
         pa.array([low.astype("<i8").tobytes()]), pa.array([slices.shape[1]], pa.int32()), pa.array([slices.tobytes()])],
        names=["dim", "block", "ids", "low", "width", "slices"])


def _slab(dim: int, serial: int, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([dim], pa.int32()), pa.array([serial], pa.int64()), pa.array([ids.astype("<i8").tobytes()]),
         pa.array([values.astype("<i8").tobytes()])], names=["dim", "slab", "query_ids", "queries"])


def _searcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["dim", "slab", "place", "query_id", "vec_id", "score"]
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}     # of the slab at hand: scores and ids
        at = None

        def leave() -> Iterator[pa.RecordBatch]:
            if at is None:
                return
            dim, slab, query_ids = at
            place = np.repeat(np.array(list(best), np.int64), [len(best[q][0]) for q in best])
            if len(place):
                columns = [np.full(len(place), dim, np.int32), np.full(len(place), slab, np.int64), place, query_ids[place],
                           np.concatenate([i for _, i in best.values()]), np.concatenate([s for s, _ in best.values()])]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
            best.clear()
        for batch in batches:
            for row in batch.to_pylist():
                dim, slab = row["dim"], row["slab"]
                if at is None or at[:2] != (dim, slab):
                    yield from leave()
                    at = (dim, slab, np.frombuffer(row["query_ids"], "<i8"))
                queries = np.frombuffer(row["queries"], "<i8").reshape(len(at[2]), dim)
                ids, low = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["low"], "<i8")
                slices = np.frombuffer(row["slices"], np.uint64).reshape(dim, row["width"], -(-len(ids) // 64))
                everyone = np.zeros(-(-len(ids) // 64) * 64, dtype=bool)
                everyone[:len(ids)] = True
                for q, own in enumerate(at[2].tolist()):
                    some = everyone.copy()
                    some[np.searchsorted(ids, own):np.searchsorted(ids, own, side="right")] = False
                    valid = np.packbits(some, bitorder="little").view(np.uint64)
                    scores, constant = sliced_scores(slices, low, queries[q])
                    rows, value = top_rows(scores, valid, k)
                    value, found = value + constant, ids[rows]
                    if q in best:
                        value, found = np.concatenate([best[q][0], value]), np.concatenate([best[q][1], found])
                    order = np.lexsort((found, -value))[:k]
                    best[q] = (value[order], found[order])
        yield from leave()
    return run


def top_inner_products(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5,
                       every: int = 50) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row whose id is divisible by
    ``every`` the ``k`` largest integer inner products with the rows of other
    ids, ranks from 1, ties to the smaller id; fewer than ``k`` rows: all.

    Rows whose id or vector is null, or whose vector holds null or non-finite
    components (or components beyond 2 ** 19, whose products need not fit 64
    bits) take no part. Vectors meet only those of their own length; empty ones
    score 0. A row that is repeated (id and vector) counts once; one id with
    several vectors is several candidates and, if divisible, several queries
    that share their ranks' names. An empty table gives no rows.
    """
    ship_package(df.sparkSession)
    v = F.col(vector_col).cast("array<double>")
    rows = (df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .filter(F.col("id").isNotNull() & usable_vector(F.col("v"))).withColumn("dim", F.size("v")))
    again = rows.groupBy("id").count().filter("count > 1").select("id")
    again = saved(again, "repeated")
    if not again.isEmpty():      # only rows of such ids are compared with each other
        twice = rows.join(again, "id", "left_semi").dropDuplicates(["id", "v"])
        rows = saved(rows.join(again, "id", "left_anti").select("id", "v", "dim")
                     .unionByName(twice.select("id", "v", "dim")), "vectors")
    asked = F.col("id") % every == 0
    n, n_queries = rows.agg(F.count("*"), F.count(F.when(asked, 1))).first()
    blocks = saved(rows.coalesce(max(1, -(-n // BLOCK))).mapInArrow(
        _packed(BLOCK, _block), "dim int, block long, ids binary, low binary, width int, slices binary"), "blocks")
    slabs = saved(rows.filter(asked).coalesce(max(1, -(-n_queries // SLAB))).mapInArrow(
        _packed(SLAB, _slab), "dim int, slab long, query_ids binary, queries binary"), "slabs")
    down, across = max(1, slabs.count()), max(1, -(-blocks.count() // CELL_BLOCKS))
    cell = ["dim", "gs", "gb"]
    left = (slabs.withColumn("gs", F.pmod(F.xxhash64("slab"), F.lit(down)).cast("int"))
            .withColumn("gb", F.explode(F.sequence(F.lit(0), F.lit(across - 1)))))
    right = (blocks.withColumn("gb", F.pmod(F.xxhash64("block"), F.lit(across)).cast("int"))
             .withColumn("gs", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))))
    parts = down * across        # as many tasks as cells: the work is in the cells, not in their bytes
    found = (left.repartition(parts, *cell).join(right.repartition(parts, *cell), cell)
             .select("dim", "slab", "query_ids", "queries", "ids", "low", "width", "slices")
             .sortWithinPartitions("dim", "slab")
             .mapInArrow(_searcher(k), "dim int, slab long, place long, query_id long, vec_id long, score long"))
    order = Window.partitionBy("dim", "slab", "place").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def oracle_sql() -> str:
    """The same in DuckDB SQL, by comparing every query with every row."""
    return """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as query_id, b.vec_id, cast(list_inner_product(a.q, b.q) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id and len(a.q) = len(b.q) where a.vec_id % 50 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
where rank <= 5
"""
