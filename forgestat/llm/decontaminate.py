"""Operator 1: benchmark decontamination by SimHash windows.

For an item of L words every window of L words of a document is a candidate.
Windows without any shingle of an item of that length have similarity 0 to all
of them, so fingerprints are taken of the windows around such shingles only.
A window's 64-bit SimHash over its shingles is looked up in a multi-index of
eight tables, one per 8-bit block, from a block's value to the items that have
it. Looked up are all values within BLOCK_RADIUS bits of the window's block, so
every item within RADIUS bits in all is met in at least one table (eight blocks
with more than BLOCK_RADIUS bits each would exceed RADIUS).
Candidates within RADIUS bits are verified: a shingle weighs as often as it
occurs, similarity = sum of smaller weights / sum of larger weights.

The benchmark is taken in blocks of bounded bytes, each block against all
documents; only a block's index is sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgestat.llm import textnp
from forgestat.llm.common import documents_of, ship_package

RADIUS = 23              # bits; at similarity 0.75 the expected distance is 11, deviation 3
BLOCK_RADIUS = 2         # floor(RADIUS / 8)
BLOCK_BYTES = 1 << 22    # benchmark text handled at a time
STARTS = 1 << 14         # window starts fingerprinted at a time
MET = 1 << 20            # table entries met at a time

_BITS = 22
_HITS = "doc_id long, item_id long, start_word long, n_words long, distance int, similarity double"


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    """SimHash of rows of signed bit sums (ties give 0)."""
    return np.packbits(sums > 0, axis=-1)


def _signs(grams: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.ascontiguousarray(grams).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


_COUNT = np.array([bin(a).count("1") for a in range(256)], dtype=np.uint8)
#: For each block value the values within BLOCK_RADIUS bits of it.
_BALL = np.arange(256)[:, None] ^ np.flatnonzero(_COUNT <= BLOCK_RADIUS)[None, :]


class BlockTables:
    """Multi-index over the fingerprints of items of one length."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints
        self.items = [np.argsort(prints[:, k], kind="stable") for k in range(8)]
        self.at = [np.concatenate([[0], np.cumsum(np.bincount(prints[:, k], minlength=256))]) for k in range(8)]
        self.load = np.stack([np.diff(at)[_BALL].sum(axis=1) for at in self.at])    # entries met, by block and value

    def within(self, got: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(row of ``got``, item, distance) of all items within RADIUS bits, for
        as many rows at a time as meet about MET entries."""
        if not len(got):
            return
        load = np.cumsum(self.load[np.arange(8), got].sum(axis=1))
        ends = np.flatnonzero(np.diff(load // MET)) + 1
        for lo, hi in zip([0, *ends.tolist()], [*ends.tolist(), len(got)], strict=True):
            met = []
            for k in range(8):
                values = _BALL[got[lo:hi, k]].ravel()
                start, size = self.at[k][values], self.at[k][values + 1] - self.at[k][values]
                place = np.repeat(start - np.cumsum(size) + size, size) + np.arange(size.sum())
                row = np.repeat(np.arange(lo, hi), size.reshape(hi - lo, -1).sum(axis=1))
                met.append(row * len(self.prints) + self.items[k][place])
            row, item = np.divmod(np.unique(np.concatenate(met)), len(self.prints))
            far = _COUNT[got[row] ^ self.prints[item]].sum(axis=1, dtype=np.int64)
            yield row[far <= RADIUS], item[far <= RADIUS], far[far <= RADIUS]


class BenchmarkIndex:
    """Index over one block of benchmark items."""

    def __init__(self, ids: list, texts: pa.Array):
        self.items = []                                   # (id, words, shingle width, sorted shingles)
        for piece in textnp.pieces(texts, textnp.SPACE):
            words = piece.word_hash()
            for k, (a, b) in enumerate(zip(piece.first[:-1].tolist(), piece.first[1:].tolist(), strict=True)):
                if b > a and ids[piece.lo + k] is not None:
                    width = min(textnp.SHINGLE, b - a)
                    self.items.append((ids[piece.lo + k], b - a, width, np.sort(textnp.gram_hashes(words[a:b], width))))
        self.widths = sorted({i[2] for i in self.items})
        self.anchors = {}                                 # width -> sorted shingles, item lengths that have each
        self.by_length = {}                               # words -> item numbers, block tables
        for width in self.widths:
            pairs = np.unique(np.array([(g, i[1]) for i in self.items if i[2] == width for g in i[3].tolist()],
                                       dtype=np.uint64), axis=0)
            seen = np.zeros(1 << _BITS, dtype=bool)
            seen[(pairs[:, 0] >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.anchors[width] = (pairs[:, 0].copy(), pairs[:, 1].astype(np.int64), np.packbits(seen))
        for length in sorted({i[1] for i in self.items}):
            numbers = [n for n, i in enumerate(self.items) if i[1] == length]
            prints = np.stack([_fingerprints(_signs(self.items[n][3]).sum(axis=0)) for n in numbers])
            self.by_length[length] = (numbers, BlockTables(prints))

    def scan(self, piece: textnp.Piece) -> Iterator[tuple[int, int, int, int, int, float]]:
        """(document, item, start word, words, distance, similarity): the best
        window of each item in each document that reaches any; see ``matches``."""
        words = piece.word_hash()
        doc = piece.doc_of_word()
        for width in self.widths:
            grams = textnp.gram_hashes(words, width)
            inside = doc[:len(grams)] == doc[width - 1:] if len(grams) else np.zeros(0, bool)
            known, lengths, packed = self.anchors[width]
            seen = np.unpackbits(packed)[(grams >> np.uint64(64 - _BITS)).astype(np.int64)].astype(bool)
            at = np.flatnonzero(inside & seen)
            lo, hi = np.searchsorted(known, grams[at], "left"), np.searchsorted(known, grams[at], "right")
            at, lo, hi = at[hi > lo], lo[hi > lo], hi[hi > lo]
            if not len(at):
                continue
            place = np.repeat(at, hi - lo)
            first = np.repeat(lo - np.concatenate([[0], np.cumsum(hi - lo)[:-1]]), hi - lo)
            length = lengths[first + np.arange(len(place))]
            for d in np.unique(doc[place]).tolist():
                here = doc[place] == d if len(place) > 1 else np.ones(len(place), bool)
                a, b = int(piece.first[d]), int(piece.first[d + 1])
                for size in np.unique(length[here]).tolist():
                    yield from self._document(d, grams[a:b - width + 1], place[here & (length == size)] - a,
                                              b - a, size, width)

    def _document(self, d, grams, places, n, size, width):
        numbers, tables = self.by_length[size]
        window = min(size, n)
        last, run = n - window, window - width + 1        # last start; shingles in a window
        cover = np.zeros(last + 2, dtype=np.int64)
        np.add.at(cover, np.clip(places - run + 1, 0, last), 1)
        np.add.at(cover, np.clip(places, 0, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(cover[:-1]) > 0)
        best = {}
        for k in range(0, len(starts), STARTS):
            some = starts[k:k + STARTS]
            # pieces of consecutive starts, so that the sums cover only what is needed
            for block in np.split(some, np.flatnonzero(np.diff(some) > run) + 1):
                lo, hi = int(block[0]), int(block[-1]) + run
                sums = np.zeros((hi - lo + 1, 64), dtype=np.int32)
                np.cumsum(_signs(grams[lo:hi]), axis=0, out=sums[1:])
                got = _fingerprints(sums[block - lo + run] - sums[block - lo])
                for found in tables.within(got):
                    for w, j, distance in zip(*(c.tolist() for c in found), strict=True):
                        best.setdefault(j, []).append((int(block[w]), distance))
        for j, windows in best.items():
            hit = self._verify(grams, self.items[numbers[j]], windows, run)
            if hit:
                yield d, numbers[j], hit[1], window, hit[2], hit[0]

    @staticmethod
    def _verify(grams, item, windows, run):
        """Best (similarity, start, distance); windows are tried in the order of
        the most that they can share, until none can be better."""
        shingles = item[3]
        total = run + len(shingles)
        inside = np.concatenate([[0], np.cumsum(np.isin(grams, shingles))])
        most = sorted(((min(int(inside[s + run] - inside[s]), len(shingles)), s, far) for s, far in windows),
                      key=lambda x: (-x[0], x[1]))
        names, want = np.unique(shingles, return_counts=True)
        best = None
        for shared, s, far in most:
            if best and shared / (total - shared) <= best[0]:
                break
            run_names, have = np.unique(grams[s:s + run], return_counts=True)
            _, a, b = np.intersect1d(names, run_names, assume_unique=True, return_indices=True)
            both = int(np.minimum(want[a], have[b]).sum())
            value = both / (total - both)
            if best is None or value > best[0]:
                best = (value, s, far)
        return best

    def matches(self, piece: textnp.Piece, least: float) -> list[tuple]:
        return [m for m in self.scan(piece) if m[5] >= least]


def _indexes(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[BenchmarkIndex]:
    """Indexes over blocks of the benchmark, each of about BLOCK_BYTES of text."""
    items = benchmark.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES) or 1
    items = items.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)))
    for k in range(blocks):
        got = items.filter(F.col("block") == k).select("id", "text").orderBy("id", "text").toArrow()
        yield BenchmarkIndex(got["id"].to_pylist(), got["text"].combine_chunks())


def contaminations(docs: DataFrame, benchmark: DataFrame, least: float = 0.75, id_col: str = "doc_id",
                   text_col: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``(doc_id, item_id, start_word, n_words, distance, similarity)``: for each
    document row and each item that one of its windows matches, the window of
    greatest similarity (ties: the first).

    Words are split at ASCII white space, A-Z in lower case. Documents and items
    that are null, empty or have no word match nothing, nor do items with a null
    id. Items of one to four words are one shingle. A document shorter than the
    item is one window. Repeated rows on either side give repeated result rows.
    An empty table on either side gives no rows.
    """
    texts = documents_of(docs, id_col, text_col)
    out = None
    for index in _indexes(benchmark, item_id, item_text):
        def scan(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in textnp.pieces(batch.column("text"), textnp.SPACE):
                    hits = index.matches(piece, least)
                    if hits:
                        d, j, start, size, far, value = zip(*hits, strict=True)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("doc_id").take(pa.array([piece.lo + x for x in d])),
                             pa.array([index.items[x][0] for x in j], pa.int64()), pa.array(start, pa.int64()),
                             pa.array(size, pa.int64()), pa.array(far, pa.int32()), pa.array(value, pa.float64())],
                            names=[c.split()[0] for c in _HITS.split(", ")])
        part = texts.mapInArrow(scan, _HITS)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.75, text_col: str = "text",
                   item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found (rows with
    null or empty text stay)."""
    ship_package(docs.sparkSession)
    for index in _indexes(benchmark, item_id, item_text):
        def keep(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, dtype=bool)
                for piece in textnp.pieces(batch.column(text_col), textnp.SPACE):
                    clean[[piece.lo + m[0] for m in index.matches(piece, least)]] = False
                yield batch.filter(pa.array(clean))
        docs = docs.mapInArrow(keep, docs.schema)
    return docs
