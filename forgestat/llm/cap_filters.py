"""Operator 8: near-duplicate vectors by spherical-cap filters.

A random product code gives C * C filter directions (g, h): one Gaussian code
word for either half of the randomly rotated space. A unit vector v = (x, y)
lies in the cap of every direction with <g, x> + <h, y> >= tau. The list of
those caps is decoded from the two short score lists: only code words that can
still reach tau with the best word of the other half are combined. Vectors that
share a cap are compared exactly (cosine in double precision).

tau follows from the number of vectors, so that a cap holds CAP_ROWS vectors of
an even distribution at every size; C then follows from the probability that
two vectors of the threshold's cosine share a cap, so that such a pair is
expected to share EXPECTED caps (pairs above the threshold more). A pair is
missed with a probability of about exp(-EXPECTED) at the threshold.

Equal vectors are one class first. A cap with many members is cut into blocks
and every two blocks are compared by one matrix product; what leaves a task is
one count per vector and a spanning forest, never the list of pairs. A pair
that shares several caps is counted in the first of them only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forgestat.llm.common import saved, ship_package
from forgestat.llm.components import components

CAP_ROWS = 24        # vectors expected in a cap
EXPECTED = 14.0      # caps that a pair at the threshold is expected to share
BLOCK = 512          # vectors of one cap that a task holds on either side
SEED = 20240607


def _tail(z: np.ndarray | float) -> np.ndarray:
    return 0.5 * np.array([math.erfc(v / math.sqrt(2)) for v in np.atleast_1d(z)])


def cap_parameters(n: int, cosine: float) -> tuple[float, int]:
    """(tau, C) for ``n`` vectors and a threshold."""
    share = min(0.25, CAP_ROWS / max(n, 1))
    lo, hi = 0.0, 12.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _tail(mid)[0] > share else (lo, mid)
    z = np.linspace(lo, lo + 8, 801)
    rho = min(max(cosine, 0.0), 0.999)
    density = np.exp(-z * z / 2) / math.sqrt(2 * math.pi) * _tail((lo - rho * z) / math.sqrt(1 - rho * rho))
    both = float(((density[1:] + density[:-1]) / 2 * np.diff(z)).sum())
    return lo, max(2, math.ceil(math.sqrt(EXPECTED / both)))


def _codes(dim: int, c: int) -> tuple[np.ndarray, np.ndarray]:
    """Rotated code words of both halves as (dim, C) matrices."""
    rng = np.random.default_rng([SEED, dim, c])
    turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    half = (dim + 1) // 2
    return (turn[:, :half] @ rng.standard_normal((half, c)),
            turn[:, half:] @ rng.standard_normal((dim - half, c)))


def _unit(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def decode_list(x: np.ndarray, codes: tuple[np.ndarray, np.ndarray], tau: float) -> list[np.ndarray]:
    """Caps of each row of ``x``, ascending."""
    one, two = x @ codes[0], x @ codes[1]
    top1, top2, c = one.max(axis=1), two.max(axis=1), one.shape[1]
    out = []
    for i in range(len(x)):
        a = np.flatnonzero(one[i] >= tau - top2[i])
        b = np.flatnonzero(two[i] >= tau - top1[i])
        hit = np.flatnonzero((one[i, a][:, None] + two[i, b][None, :] >= tau).ravel())
        out.append((a[hit // max(len(b), 1)] * c + b[hit % max(len(b), 1)]).astype(np.int32))
    return out


def _decoder(plans: dict[int, tuple[float, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                if dim not in plans:
                    continue
                tau, c = plans[dim]
                if dim not in kept:
                    kept[dim] = _codes(dim, c)
                part = batch.filter(pa.array(dims == dim))
                for at in range(0, part.num_rows, 2048):
                    some = part.slice(at, 2048)
                    caps = decode_list(_unit(some.column("v"), dim), kept[dim], tau)
                    yield pa.RecordBatch.from_arrays(
                        [some.column("id"), some.column("dim"), some.column("copies"), some.column("v"),
                         pa.array(caps, pa.list_(pa.int32()))], names=["id", "dim", "copies", "v", "caps"])
    return run


def _labels(linked: np.ndarray) -> np.ndarray:
    """Smallest index reachable in a symmetric boolean matrix."""
    n = len(linked)
    label = np.arange(n)
    reach = linked | np.eye(n, dtype=bool)
    while True:
        new = np.where(reach, label[None, :], n).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _compare(batch: pa.Table, cosine: float):
    """Links of one cap's block or pair of blocks, counted in their first common cap;
    ``caps`` holds each vector's caps before this one."""
    dim = batch["dim"][0].as_py()
    ids, side = batch["id"].to_numpy(), batch["side"].to_numpy()
    x = _unit(batch["v"], dim)
    linked = x @ x.T >= cosine
    linked &= ids[:, None] != ids[None, :]
    if side.any():                               # two blocks: only pairs across them
        linked &= side[:, None] != side[None, :]
    if not linked.any():
        return None
    some = np.flatnonzero(linked.any(axis=1))
    linked, ids = linked[np.ix_(some, some)], ids[some]
    lists = batch["caps"].combine_chunks().take(pa.array(some))
    flat, sizes = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    if len(flat):
        names, col = np.unique(flat, return_inverse=True)
        member = np.zeros((len(some), len(names)), dtype=np.float32)
        member[np.repeat(np.arange(len(some)), sizes), col] = 1
        linked &= member @ member.T == 0
    if not linked.any():
        return None
    copies = batch["copies"].to_numpy()[some]
    return ids, (linked * copies[None, :]).sum(axis=1), ids[_labels(linked)]


def _comparer(cosine: float):
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64()), ("other", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups():
            held = None                          # an unfinished group: at most two blocks
            for batch in batches:
                t = pa.Table.from_batches([batch])
                t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
                if not t.num_rows:
                    continue
                key = [t[c].to_numpy() for c in ("dim", "cap", "bi", "bj")]
                cut = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
                at = [0, *cut.tolist()]
                for a, b in zip(at[:-1], at[1:], strict=True):
                    yield t.slice(a, b - a)
                held = t.slice(at[-1])
            if held is not None and held.num_rows:
                yield held
        out, rows = [], 0
        for group in groups():
            if group.num_rows < 2 or (got := _compare(group, cosine)) is None:
                continue
            out.append(got)
            rows += len(got[0])
            if rows >= 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64))
                                                  for c in zip(*out, strict=True)], schema=schema)
                out, rows = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64))
                                              for c in zip(*out, strict=True)], schema=schema)
    return run


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 cosine: float = 0.9) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per input row.

    Vectors that are null, empty, zero, or hold null or non-finite components
    link with nothing; vectors of different length never link. Equal vectors
    always link, their copies count as links. Rows that repeat one id with
    different vectors are one node for components. A row with a null id links
    only with equal vectors and has a null component unless one of them has an
    id. An empty table gives no rows.
    """
    ship_package(df.sparkSession)
    # single precision stays as it is until a task reads it as double: half of what is moved
    single = df.schema[vector_col].dataType == T.ArrayType(T.FloatType())
    kind = "float" if single else "double"
    v = F.col(vector_col).cast(f"array<{kind}>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0.0)
    # adding 0.0 turns -0.0 into 0.0, so equal vectors group alike
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"),
                     F.when(usable, F.transform(v, lambda x: x + F.lit(0.0).cast(kind))).alias("v"))
    classes = saved(rows.filter("v is not null").groupBy("v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
                    .withColumn("dim", F.size("v")), "vectors")
    counts = {r["dim"]: r["n"] for r in classes.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    plans = {dim: cap_parameters(n, cosine) for dim, n in counts.items()}
    lists = saved(classes.filter("id is not null").select("id", "dim", "copies", "v")
                  .mapInArrow(_decoder(plans), f"id long, dim int, copies long, v array<{kind}>, caps array<int>"), "caps")
    cell = lists.select("dim", F.explode("caps").alias("cap"))
    large = saved(cell.groupBy("dim", "cap").count().filter(F.col("count") > BLOCK)
                  .select("dim", "cap", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "largecaps")
    spread = (lists.withColumn("cap", F.explode("caps")).join(large, ["dim", "cap"], "left")
              .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
              .withColumn("own", F.pmod(F.xxhash64("id", "cap"), F.col("blocks")).cast("int"))
              .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
              .withColumn("bi", F.least("own", "with")).withColumn("bj", F.greatest("own", "with"))
              .withColumn("side", (F.col("own") != F.col("bi")).cast("int"))
              # only the caps before this one tell where a pair has been counted
              .select("dim", "cap", "bi", "bj", "side", "id", "copies", "v",
                      F.filter("caps", lambda c: c < F.col("cap")).alias("caps")))
    found = saved(spread.repartition("dim", "cap", "bi", "bj").sortWithinPartitions("dim", "cap", "bi", "bj")
                  .mapInArrow(_comparer(cosine), "id long, links long, other long"), "found")
    links = saved(found.groupBy("id").agg(F.sum("links").alias("links")), "vlinks")
    edges = found.select(F.col("id").alias("a"), F.col("other").alias("b"))
    again = rows.filter("vec_id is not null and v is not null").groupBy("vec_id").count().filter("count > 1").select("vec_id")
    if not again.isEmpty():                       # an id on several vectors ties their classes together
        tied = rows.join(again, "vec_id").join(classes.select("v", "id"), "v").select(F.col("vec_id").alias("a"), F.col("id").alias("b"))
        edges = edges.unionByName(tied)
    parts = components(edges)
    of = saved(classes.select("v", "id", "copies").join(links, "id", "left")
               .join(parts, F.col("id") == F.col("node"), "left")
               .select("v", F.col("id").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"),
                       F.coalesce("component", "id").alias("component")), "vresult")
    rows = rows.withColumn("h", F.xxhash64("v"))
    of = of.select(F.xxhash64("v").alias("oh"), F.col("v").alias("ov"), "n", "component")
    out = rows.join(of, (F.col("h") == F.col("oh")) & (F.col("v") == F.col("ov")), "left")
    component = F.when(F.col("v").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
