"""Operator 10: quality scores from random Fourier features.

Statistics of a text (lengths, shares of character classes, repetition) are
standardised over all documents; random Fourier features approximate a Gaussian
kernel over them. Every task sums its part of the normal equations over all
labelled rows that are not held out; the summed system gives ridge scores, and
an isotonic fit over score bins turns them into probabilities of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgestat.llm import textnp
from forgestat.llm.common import documents_of, held_out, saved

FEATURES = 256           # random Fourier features
RIDGE = 1e-3             # times the number of rows
BINS = 512               # score bins of the isotonic fit
THRESHOLD = 0.3
SUMMERS = 8              # groups in which the tasks' sums are added before the driver
SEED = 11

_CLASSES = 12
_CLASS = np.zeros(256, dtype=np.uint8)             # 0: other control characters
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[ord(c) for c in " \t"]] = 4
_CLASS[[ord(c) for c in "\n\r\x0b\x0c"]] = 5
_CLASS[[ord(c) for c in ".,;:'\"-()"]] = 6
_CLASS[[ord(c) for c in "!?"]] = 7
_CLASS[[ord(c) for c in "#$%&*@^~+=_`"]] = 8
_CLASS[[ord(c) for c in "|<>[]{}/\\"]] = 9
_CLASS[0x80:0xC0] = 10                              # continuation bytes
_CLASS[0xC0:] = 11                                  # first bytes of other characters
N_STATS = _CLASSES + 11


def text_statistics(piece: textnp.Piece) -> np.ndarray:
    """One row of N_STATS numbers for each text of a piece (read without lowering)."""
    docs, size = piece.hi - piece.lo, np.diff(piece.doc_at)
    kind = _CLASS[piece.buf]
    counts = np.bincount(np.repeat(np.arange(docs) * _CLASSES, size) + kind,
                         minlength=docs * _CLASSES).reshape(docs, _CLASSES)
    share = counts / np.maximum(size, 1)[:, None]
    words = np.diff(piece.first)
    per = np.maximum(words, 1)
    length = (piece.end - piece.start).astype(np.float64)
    doc = piece.doc_of_word()

    def total(values):
        return np.bincount(doc, weights=values, minlength=docs)
    mean = total(length) / per
    upper = np.concatenate([[0], np.cumsum(kind == 2)])
    capitals = (upper[piece.end] - upper[piece.start]) / np.maximum(length, 1)
    hashes = piece.word_hash()
    repeat = np.zeros(len(hashes))
    repeat[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    tail = kind[piece.end - 1] if len(hashes) else np.zeros(0, np.uint8)
    distinct, top = np.zeros(docs), np.zeros(docs)
    for d, (a, b) in enumerate(zip(piece.first[:-1].tolist(), piece.first[1:].tolist(), strict=True)):
        if b > a:
            n = np.unique(hashes[a:b], return_counts=True)[1]
            distinct[d], top[d] = len(n) / (b - a), n.max() / (b - a)
    return np.column_stack([
        share, np.log1p(size), np.log1p(words), mean, np.sqrt(np.maximum(total(length ** 2) / per - mean ** 2, 0)),
        distinct, distinct * np.sqrt(per), top, total(repeat) / per, total(capitals) / per,
        total((tail == 8) | (tail == 9) | (tail == 7)) / per, total(tail == 6) / per])


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None       # None: no labels were given, all scores are 0.5
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def __post_init__(self):
        rng = np.random.default_rng(SEED)
        self.turn = rng.standard_normal((N_STATS, FEATURES)) / np.sqrt(N_STATS)
        self.phase = rng.uniform(0, 2 * np.pi, FEATURES)

    def expand(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.turn + self.phase) * np.sqrt(2 / FEATURES)
        return np.column_stack([z, np.ones(len(z))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.expand(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        if self.weights is None or self.steps is None:
            return np.full(len(stats), 0.5)
        return np.clip(np.interp(self.raw(stats), *self.steps), 0.0, 1.0)


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over ascending ``x``: block centres and means."""
    blocks = []
    for a, b, w in zip(x.tolist(), y.tolist(), weight.tolist(), strict=True):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last, strict=True)]
    return (np.array([b[0] / b[2] for b in blocks]), np.array([b[1] / b[2] for b in blocks]))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, stats)`` of every row; null texts count as empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in textnp.pieces(batch.column("text"), textnp.SPACE, lower=False):
                rows = text_statistics(piece)
                n = piece.hi - piece.lo
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(piece.lo, n), batch.column("held_out").slice(piece.lo, n),
                     pa.FixedSizeListArray.from_arrays(pa.array(rows.ravel()), N_STATS).cast(pa.list_(pa.float64()))],
                    names=["doc_id", "held_out", "stats"])
    texts = documents_of(docs, id_col, text_col, held_out(F.col(id_col)).alias("held_out"))
    return texts.mapInArrow(run, "doc_id long, held_out boolean, stats array<double>")


def fit_quality(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> QualityModel:
    """Fit on all labelled rows that are not held out. Labels that are null or
    neither 0 nor 1 are left out; a document with several label rows counts
    once for each. Without any usable label all scores are 0.5."""
    sums = stats.select(*[f(F.col("stats")[k]).alias(f"{n}{k}") for k in range(N_STATS)
                          for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([sums[f"m{k}"] or 0.0 for k in range(N_STATS)])
    scale = np.array([sums[f"s{k}"] or 0.0 for k in range(N_STATS)])
    model = QualityModel(mean, np.where(scale > 1e-12, scale, 1.0), None)
    marked = (labels.select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("int").alias("y"))
              .filter("y in (0, 1)"))
    train = saved(stats.filter("not held_out").join(marked, F.col("doc_id") == F.col("label_id"))
                  .select("stats", "y"), "labelled")
    width = FEATURES + 1

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system = np.zeros((width, width + 1))
        rows = 0
        for batch in batches:
            if batch.num_rows:
                z, y = model.expand(_matrix(batch.column("stats"))), batch.column("y").to_numpy()
                system[:, :width] += z.T @ z
                system[:, width] += z.T @ y
                rows += len(y)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([rows], pa.int64()), pa.array([system.tobytes()], pa.binary())],
                                             names=["n", "system"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, dtype=np.float64) for b in table["system"].to_pylist())
        return pa.table({"n": pa.array([sum(table["n"].to_pylist())], pa.int64()),
                         "system": pa.array([total.tobytes()], pa.binary())})
    parts = (train.mapInArrow(sums_of, "n long, system binary")
             .withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(SUMMERS)))
             .groupBy("slot").applyInArrow(add, "n long, system binary").toArrow())
    n = sum(parts["n"].to_pylist())
    if not n:
        return model
    system = sum(np.frombuffer(b, dtype=np.float64) for b in parts["system"].to_pylist()).reshape(width, width + 1)
    ridge = np.eye(width) * RIDGE * n
    ridge[-1, -1] = 0
    model.weights = np.linalg.solve(system[:, :width] + ridge + np.eye(width) * 1e-9, system[:, width])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = model.raw(_matrix(batch.column("stats")))
                place = np.floor(np.clip(raw + 0.5, 0, 2) * BINS / 2).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(place), batch.column("y"), pa.array(raw)], names=["bin", "y", "raw"])
    got = (train.mapInArrow(binned, "bin int, y int, raw double").groupBy("bin")
           .agg(F.avg("raw").alias("x"), F.avg("y").alias("y"), F.count("*").alias("n")).orderBy("x").toArrow())
    model.steps = isotonic(*(got[c].to_numpy().astype(np.float64) for c in ("x", "y", "n")))
    return model


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per input row.

    Null and empty texts are scored like any text without words. Null ids are
    given back (they have no label). Repeated rows give repeated result rows and
    equal texts equal scores. An empty table gives no rows.
    """
    stats = saved(statistics(docs, id_col, text_col), "stats")
    model = fit_quality(stats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                score = model.score(_matrix(batch.column("stats")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("held_out"), pa.array(score),
                     pa.array((score >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])
    return stats.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def quality_kept(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score reaches the threshold."""
    model = fit_quality(saved(statistics(docs, id_col, text_col), "stats"), labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for piece in textnp.pieces(batch.column(text_col), textnp.SPACE, lower=False):
                good[piece.lo:piece.hi] = model.score(text_statistics(piece)) >= threshold
            yield batch.filter(pa.array(good))
    return docs.mapInArrow(keep, docs.schema)
