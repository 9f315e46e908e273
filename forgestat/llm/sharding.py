"""Operator 7: byte-balanced shards by Karmarkar-Karp differencing.

Rows with equal text are one indivisible group. Groups that are large beside a
shard stay items of their own; all smaller groups are bundled, by a hash, into
a fixed number of items. Item counts are therefore bounded whatever the input
(see ``items_bound``), and the differencing itself is a small step on the
driver: the two partial partitions of largest spread are combined, the largest
bin of one with the smallest of the other, until one partition is left.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from forgestat.llm.common import documents_of, saved

ITEMS_PER_SHARD = 256    # bundles per shard; a group above a bundle's mean size is an item of its own
SLOT_ROWS = 20_000       # rows that one task numbers, copies of a row that one task writes out


def items_bound(shards: int) -> int:
    """Most items there can be: the bundles, and the groups of more than a
    1 / (shards * ITEMS_PER_SHARD) share of all bytes."""
    return 2 * shards * ITEMS_PER_SHARD


def karmarkar_karp(sizes: list[int], shards: int) -> list[int]:
    """Shard of each item. Deterministic; ties go to the earlier item."""
    if not sizes:
        return []
    heap = []
    for k, size in enumerate(sizes):
        sums = [size] + [0] * (shards - 1)
        heap.append((-(size if shards > 1 else 0), k, sums, [[k]] + [None] * (shards - 1)))
    heapq.heapify(heap)
    serial = len(sizes)
    while len(heap) > 1:
        _, _, a, bins_a = heapq.heappop(heap)
        _, _, b, bins_b = heapq.heappop(heap)
        merged = []
        for i in range(shards):                      # a descends, b is taken ascending
            x, y = bins_a[i], bins_b[shards - 1 - i]
            merged.append((a[i] + b[shards - 1 - i], i, x if y is None else y if x is None else (x, y)))
        merged.sort(key=lambda m: (-m[0], m[1]))
        heapq.heappush(heap, (merged[-1][0] - merged[0][0], serial, [m[0] for m in merged], [m[2] for m in merged]))
        serial += 1
    out = [0] * len(sizes)
    for shard, tree in enumerate(heap[0][3]):
        stack = [tree]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack.extend(node)
            elif node is not None:
                out[node[0]] = shard
    return out


def shard_by_bytes(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per
    input row; ``size`` is the text's UTF-8 bytes plus 16, ``slot`` numbers the
    rows of a shard from 0 without gaps, by (hash bucket of id and text, id, text).

    Null texts have no bytes and are one group with the empty text. Rows with
    equal text share a shard. Null ids are numbered like others; repeated rows
    get slots of their own. An empty table gives no rows.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = saved(documents_of(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text).cast("long") + 16).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.unhex(F.md5(text.cast("binary"))).alias("key")), "rows")
    groups = saved(rows.groupBy("key").agg(F.sum("size").alias("size")), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    bundles = shards * ITEMS_PER_SHARD
    large = F.col("size") * bundles > total            # fewer than ``bundles`` groups
    heavy = groups.filter(large).select("key", "size")
    light = (groups.filter(~large).withColumn("bundle", F.pmod(F.xxhash64("key"), F.lit(bundles)).cast("int"))
             .groupBy("bundle").agg(F.sum("size").alias("size")))
    items = [(r["key"], None, r["size"]) for r in heavy.collect()]
    items += [(None, r["bundle"], r["size"]) for r in light.collect()]
    items.sort(key=lambda x: (-x[2], bytes(x[0] or b""), -1 if x[1] is None else x[1]))
    assert len(items) <= items_bound(shards)
    placed = karmarkar_karp([x[2] for x in items], shards)
    both = [(None if k is None else bytes(k), b, s) for (k, b, _), s in zip(items, placed, strict=True)]
    # both tables have at most ``bundles`` rows
    own = spark.createDataFrame([(k, s) for k, _, s in both if k is not None], "key binary, own int")
    bundled = spark.createDataFrame([(b, s) for _, b, s in both if b is not None], "bundle int, bundled int")
    slots = max(1, -(-rows.count() // SLOT_ROWS))
    put = saved(rows.withColumn("bundle", F.pmod(F.xxhash64("key"), F.lit(bundles)).cast("int"))
                .join(F.broadcast(own), "key", "left").join(F.broadcast(bundled), "bundle", "left")
                .select("doc_id", "size", "text_crc32", F.coalesce("own", "bundled").alias("shard"),
                        F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(slots)).cast("int").alias("part")), "placed")
    counts = put.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.sum("n").over(
        Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    before = saved(before.select("shard", "part", F.coalesce("before", F.lit(0)).alias("before")), "before")
    # rows that agree in all columns are numbered as one row with a number of copies
    order = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = saved(put.groupBy("shard", "part", "doc_id", "text_crc32", "size").agg(F.count("*").alias("copies"))
                     .withColumn("upto", F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)))
                     .join(before, ["shard", "part"])
                     .select("doc_id", "size", "text_crc32", "shard", "copies",
                             (F.col("before") + F.col("upto") - F.col("copies")).alias("first")), "numbered")

    def rows_of(part: DataFrame) -> DataFrame:
        return part.withColumn("slot", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("copies") - 1)))
    # many copies leave their task in blocks
    blocks = (numbered.filter(F.col("copies") > SLOT_ROWS)
              .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / SLOT_ROWS))))
              .withColumn("first", F.col("first") + F.col("block") * SLOT_ROWS)
              .withColumn("copies", F.least(F.lit(SLOT_ROWS), F.col("copies") - F.col("block") * SLOT_ROWS))
              .drop("block").repartition("first"))
    return (rows_of(numbered.filter(F.col("copies") <= SLOT_ROWS)).unionByName(rows_of(blocks))
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))
