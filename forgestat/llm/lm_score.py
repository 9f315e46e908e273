"""Operator 4: masked pseudo-likelihood of a bidirectional window network.

Every word is one of VOCABULARY classes: the most frequent words of the corpus
have a class each, all other words share hashed classes, and one class marks
the ends of a text. The network predicts a word from the class on either side:
h = tanh(A[left] + B[right] + c), p = softmax(h O + b).

What it learns from are the counts of (left, word, right) over all documents,
summed per task before they are shuffled; they also make an exact epoch cheap,
as equal contexts are one row. Each round every task returns the gradient over
its contexts (of fixed size), and the driver takes one Adam step.

A word's probability is p(class | left, right) p(word | class): the network
gives the first factor, the counts of all words of the corpus the second one,
n(word) / n(class). So the vocabulary is every word there is, and its table
grows with the corpus. Tasks hold the shares of at most HELD words, the most
frequent ones; all other words get theirs by a join with the whole table. A
document's score is the sum of log p(word | left, right) over all its words.
The contexts are still pairs of classes, one word on either side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgestat.llm import textnp
from forgestat.llm.common import documents_of, saved

VOCABULARY = 256         # classes
FREQUENT = 127           # of them: words of their own
END = FREQUENT           # class of the text's ends; above it: hashed classes
HIDDEN = 32
ROUNDS = 25
RATE = 0.05
SEED = 7
HELD = 1 << 16           # words at most whose shares every task holds
UNIT = 1 << 26           # logarithms of shares are summed as whole numbers of 1 / UNIT, exactly in any order
COUNTED = 1 << 21        # words a task counts at a time
CONTEXTS = 32            # partitions of the contexts (at most VOCABULARY ** 2 rows)
_BLOCK = 4096            # contexts handled at a time


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)``: hashes of all words of the corpus and their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held):
            word, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])
        held, size = [], 0
        for batch in batches:
            for piece in textnp.pieces(batch.column("text"), textnp.SPACE):
                held.append(piece.word_hash())
                size += len(held[-1])
                if size >= COUNTED:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)
    return texts.mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _classes(piece: textnp.Piece, frequent: np.ndarray, place: np.ndarray) -> np.ndarray:
    words = piece.word_hash()
    out = (END + 1 + words % np.uint64(VOCABULARY - END - 1)).astype(np.int32)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, words), len(frequent) - 1)
        known = frequent[at] == words
        out[known] = place[at[known]]
    return out


def _windows(piece: textnp.Piece, frequent: np.ndarray, place: np.ndarray) -> np.ndarray:
    """(left * V + right) * V + word of every word of a piece."""
    word = _classes(piece, frequent, place)
    left, right = np.empty_like(word), np.empty_like(word)
    left[1:], right[:-1] = word[:-1], word[1:]
    some = np.diff(piece.first) > 0
    left[piece.first[:-1][some]] = END
    right[piece.first[1:][some] - 1] = END
    return (left * VOCABULARY + right) * VOCABULARY + word


class Network:
    """Weights as one flat vector, so that gradients add as vectors."""
    SHAPES = ((VOCABULARY, HIDDEN), (VOCABULARY, HIDDEN), (HIDDEN,), (HIDDEN, VOCABULARY), (VOCABULARY,))

    def __init__(self, flat: np.ndarray | None = None):
        size = sum(int(np.prod(s)) for s in self.SHAPES)
        self.flat = np.random.default_rng(SEED).standard_normal(size) * 0.1 if flat is None else flat
        self.parts, at = [], 0
        for shape in self.SHAPES:
            n = int(np.prod(shape))
            self.parts.append(self.flat[at:at + n].reshape(shape))
            at += n

    def log_chances(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b, c, o, bias = self.parts
        hidden = np.tanh(a[left] + b[right] + c)
        logits = hidden @ o + bias
        logits -= logits.max(axis=1, keepdims=True)
        return hidden, logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))

    def gradient(self, left, right, counts) -> tuple[np.ndarray, float]:
        """Of the summed negative log-likelihood over contexts with word counts."""
        hidden, chance = self.log_chances(left, right)
        loss = -float((counts * chance).sum())
        off = np.exp(chance) * counts.sum(axis=1, keepdims=True) - counts
        back = (off @ self.parts[3].T) * (1 - hidden ** 2)
        ga, gb = np.zeros_like(self.parts[0]), np.zeros_like(self.parts[1])
        np.add.at(ga, left, back)
        np.add.at(gb, right, back)
        return np.concatenate([x.ravel() for x in (ga, gb, back.sum(axis=0), hidden.T @ off, off.sum(axis=0))]), loss

    def table(self) -> np.ndarray:
        """Log-probability of each (left, right, word), flat."""
        out = np.empty((VOCABULARY ** 2, VOCABULARY), dtype=np.float32)
        context = np.arange(VOCABULARY ** 2)
        for k in range(0, len(context), _BLOCK):
            some = context[k:k + _BLOCK]
            out[k:k + _BLOCK] = self.log_chances(some // VOCABULARY, some % VOCABULARY)[1]
        return out.ravel()


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (window, n) sorted by window -> one row per context."""
    held_w, held_n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def rows(w, n):
        context = w // VOCABULARY
        cut = np.concatenate([[0], np.flatnonzero(np.diff(context)) + 1, [len(w)]])
        for k in range(0, len(cut) - 1, _BLOCK):
            some = cut[k:k + _BLOCK + 1]
            dense = np.zeros((len(some) - 1, VOCABULARY))
            own = slice(some[0], some[-1])
            dense[np.repeat(np.arange(len(some) - 1), np.diff(some)), w[own] % VOCABULARY] = n[own]
            yield pa.RecordBatch.from_arrays([pa.array(context[some[:-1]]), pa.array([r.tobytes() for r in dense], pa.binary())],
                                             names=["context", "counts"])
    for batch in batches:
        w = np.concatenate([held_w, batch.column("window").to_numpy()])
        n = np.concatenate([held_n, batch.column("n").to_numpy()])
        if not len(w):
            continue
        last = int(np.searchsorted(w, w[-1] // VOCABULARY * VOCABULARY))     # the last context may go on
        held_w, held_n = w[last:], n[last:]
        if last:
            yield from rows(w[:last], n[:last])
    if len(held_w):
        yield from rows(held_w, held_n)


def fit_network(texts: DataFrame, words: DataFrame | None = None) -> tuple[Network, np.ndarray, np.ndarray]:
    """``texts(text)`` -> the network and the frequent words (sorted hashes, classes);
    ``words``: the counts of all words, if they are there.

    Ties among the most frequent words go to the smaller hash. A corpus without
    words gives the untrained network.
    """
    top = (word_counts(texts) if words is None else words).orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    frequent = top["word"].to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(frequent)
    frequent, place = frequent[order], order.astype(np.int32)

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held):
            window, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(window.astype(np.int64)), pa.array(n.astype(np.int64))],
                                              names=["window", "n"])
        held, size = [], 0
        for batch in batches:
            for piece in textnp.pieces(batch.column("text"), textnp.SPACE):
                held.append(_windows(piece, frequent, place))
                size += len(held[-1])
                if size >= COUNTED:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)
    counts = saved(texts.mapInArrow(windows, "window long, n long").groupBy("window").agg(F.sum("n").alias("n")), "windows")
    contexts = saved(counts.withColumn("context", F.expr(f"window div {VOCABULARY}")).repartition(CONTEXTS, "context")
                     .sortWithinPartitions("window").select("window", "n")
                     .mapInArrow(_packed, "context long, counts binary"), "contexts")
    start = np.zeros(VOCABULARY)
    for r in counts.groupBy(F.expr(f"window % {VOCABULARY}").alias("w")).agg(F.sum("n").alias("n")).collect():
        start[r["w"]] = r["n"]
    net, total = Network(), start.sum()
    if not total:
        return net, frequent, place
    net.parts[4][:] = np.log((start + 1) / (total + VOCABULARY))
    one, two = np.zeros_like(net.flat), np.zeros_like(net.flat)
    for k in range(1, ROUNDS + 1):
        flat = net.flat.copy()

        def part(batches: Iterator[pa.RecordBatch], flat=flat) -> Iterator[pa.RecordBatch]:
            own, grad = Network(flat), np.zeros_like(flat)
            for batch in batches:
                for a in range(0, batch.num_rows, _BLOCK):
                    some = batch.slice(a, _BLOCK)
                    context = some.column("context").to_numpy()
                    dense = np.frombuffer(b"".join(some.column("counts").to_pylist())).reshape(-1, VOCABULARY)
                    grad += own.gradient(context // VOCABULARY, context % VOCABULARY, dense)[0]
            yield pa.RecordBatch.from_arrays([pa.array([grad.tobytes()], pa.binary())], names=["gradient"])
        got = contexts.coalesce(CONTEXTS).mapInArrow(part, "gradient binary").toArrow()
        grad = sum(np.frombuffer(g) for g in got["gradient"].to_pylist()) / total
        one = 0.9 * one + 0.1 * grad
        two = 0.99 * two + 0.01 * grad ** 2
        net.flat -= RATE * (one / (1 - 0.9 ** k)) / (np.sqrt(two / (1 - 0.99 ** k)) + 1e-8)
    return net, frequent, place


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each text's words; each text is summed by itself: equal texts, equal sums."""
    n = np.diff(first)
    out = np.zeros(len(n), dtype=values.dtype)
    if len(values):
        out[n > 0] = np.add.reduceat(values, first[:-1][n > 0])
    return out


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, log_likelihood, mean_log_likelihood)`` of the words'
    classes alone, log p(class | left, right): the network's part of
    ``word_scores``, which has the same rows.
    """
    texts = documents_of(docs, id_col, text_col)
    net, frequent, place = fit_network(texts.select("text"))
    flat = net.flat.copy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = Network(flat).table() if table is None else table
            for piece in textnp.pieces(batch.column("text"), textnp.SPACE):
                n = np.diff(piece.first)
                score = _sums(table[_windows(piece, frequent, place)].astype(np.float64), piece.first)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(piece.lo, piece.hi - piece.lo), pa.array(n), pa.array(score),
                     pa.array(score / np.maximum(n, 1), mask=n == 0)],
                    names=["doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood"])
    return texts.mapInArrow(run, "doc_id long, n_tokens long, log_likelihood double, mean_log_likelihood double")


def word_shares(words: DataFrame, frequent: np.ndarray) -> DataFrame:
    """``(word, level, share)`` of every word that shares its class: share is
    log p(word | class) in 1 / UNIT, level rises with the word's count."""
    own = [int(w) for w in frequent.view(np.int64)]
    # 2 ** 64 is a multiple of the number of hashed classes, so the sign does not matter
    rest = words.filter(~F.col("word").isin(own)).withColumn("class", F.pmod("word", F.lit(VOCABULARY - END - 1)))
    total = rest.groupBy("class").agg(F.sum("n").alias("total"))        # one row per hashed class
    return rest.join(F.broadcast(total), "class").select(
        "word", F.floor(F.log2("n") * 4).cast("int").alias("level"),
        F.round(F.log(F.col("n") / F.col("total")) * UNIT).cast("long").alias("share"))


def word_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens, log_likelihood, mean_log_likelihood)``, one row per
    input row, by a network and word counts of the same documents;
    log_likelihood is the sum of log p(word | left, right).

    Words are split at ASCII white space, A-Z in lower case. Null, empty and
    wordless texts have 0 tokens, log-likelihood 0 and a null mean. Equal texts
    score alike, repeated rows repeat, null ids are given back, an empty table
    gives no rows.
    """
    texts = documents_of(docs, id_col, text_col)
    words = saved(word_counts(texts.select("text")), "words")
    net, frequent, place = fit_network(texts.select("text"), words)
    flat = net.flat.copy()
    shares = saved(word_shares(words, frequent), "shares")
    least, many = 1 << 30, 0                     # words of at least this level fit in HELD
    for r in sorted(shares.groupBy("level").count().collect(), reverse=True):
        many += r["count"]
        if many > HELD:
            break
        least = r["level"]
    held = shares.filter(F.col("level") >= least).select("word", "share").toArrow()
    known, share = held["word"].to_numpy().astype(np.int64).view(np.uint64), held["share"].to_numpy().astype(np.int64)
    order = np.argsort(known)
    known, share = known[order], share[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            table = Network(flat).table() if table is None else table
            for piece in textnp.pieces(batch.column("text"), textnp.SPACE):
                window, word = _windows(piece, frequent, place), piece.word_hash()
                part, far = np.zeros(len(word), np.int64), window % VOCABULARY > END
                if len(known):
                    at = np.minimum(np.searchsorted(known, word), len(known) - 1)
                    here = known[at] == word
                    part[here] = share[at[here]]
                    far &= ~here
                upto = np.concatenate([[0], np.cumsum(far)])[piece.first]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(piece.lo, piece.hi - piece.lo), pa.array(np.diff(piece.first)),
                     pa.array(_sums(table[window].astype(np.float64), piece.first)), pa.array(_sums(part, piece.first)),
                     pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(word[far].view(np.int64)))],
                    names=["doc_id", "n_tokens", "score", "part", "far"])
    # written once, so that the row numbers stay what they are
    rows = saved(texts.mapInArrow(run, "doc_id long, n_tokens long, score double, part long, far array<long>")
                 .withColumn("row", F.monotonically_increasing_id()), "scored")
    more = (rows.select("row", F.explode("far").alias("word")).join(shares.filter(F.col("level") < least), "word")
            .groupBy("row").agg(F.sum("share").alias("more")))
    score = F.col("score") + (F.col("part") + F.coalesce("more", F.lit(0))) / F.lit(float(UNIT))
    return (rows.drop("far").join(more, "row", "left")
            .select("doc_id", "n_tokens", score.alias("log_likelihood"),
                    F.when(F.col("n_tokens") > 0, score / F.col("n_tokens")).alias("mean_log_likelihood")))
