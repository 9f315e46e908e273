"""Operator 6: language identification by a linear-chain CRF over words.

A word's features are its hashed text (lexicon), its first and last one to
three bytes (affixes) and all its runs of three bytes; each has a weight per
language. Learned transitions tie neighbouring words, so that a switch of
language inside a text needs evidence. Forward-backward gives the probability
of each language at each word; a document's language is the one with the
greatest expected number of words.

The model is trained on a bounded sample of labelled documents: at most
SAMPLE_DOCS expected per language, chosen by a hash of the id, and
SAMPLE_WORDS consecutive words of each, from a place chosen by the same hash.
Training sequences join such pieces of several documents, now and then of
different languages, as code-switched text does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forgestat.llm import textnp
from forgestat.llm.common import documents_of, held_out

SAMPLE_DOCS = 250        # labelled documents per language, expected
SAMPLE_WORDS = 96        # words taken of each
BUCKETS = 1 << 16        # hashed features
RUN = 12                 # words of one document in a row of a training sequence
RUNS = 4                 # such runs in a sequence
SWITCH = 0.3             # share of runs that change the language
ROUNDS = 30
RATE = 0.25
PIECE = 1 << 20

_HAS_LETTER = np.zeros(256, dtype=bool)
_HAS_LETTER[ord("a"):ord("z") + 1] = True
_HAS_LETTER[0x80:] = True


def lettered(piece: textnp.Piece) -> np.ndarray:
    """Which words have an ASCII letter or a character beyond ASCII."""
    count = np.concatenate([[0], np.cumsum(_HAS_LETTER[piece.buf])])
    return count[piece.end] > count[piece.start]


def word_features(piece: textnp.Piece, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature buckets of the given words and the word that each belongs to."""
    s, e = piece.start[words], piece.end[words]
    size = e - s
    three = np.maximum(size - 2, 0)
    of = np.repeat(np.arange(len(words)), three)
    at = np.arange(len(of)) - np.repeat(np.concatenate([[0], np.cumsum(three)[:-1]]), three) + s[of]
    spans = [s, e]
    for k in (1, 2, 3):
        spans += [s, np.minimum(s + k, e), np.maximum(e - k, s), e]
    got = piece.span_hash(*spans, at, at + 3)
    one = np.arange(len(words))
    kinds = [textnp.mix(h + np.uint64(7919 * (k + 1))) for k, h in enumerate(got)]
    return ((np.concatenate(kinds) % np.uint64(BUCKETS)).astype(np.int64),
            np.concatenate([one] * (len(got) - 1) + [of]))


@dataclass
class ChainModel:
    languages: list[str]
    weight: np.ndarray           # BUCKETS x languages
    move: np.ndarray             # log weights of transitions
    begin: np.ndarray            # log weights of first labels

    def emissions(self, piece: textnp.Piece, words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Weights of each language at each of the words; equal words are looked up once."""
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        bucket, of = word_features(piece, words[first])
        score = np.stack([np.bincount(of, weights=self.weight[bucket, k], minlength=len(first))
                          for k in range(len(self.languages))], axis=1)
        return score[which]


def forward_backward(emission: np.ndarray, first: np.ndarray, move: np.ndarray, begin: np.ndarray,
                     edges: bool = False):
    """Marginals of chains laid end to end (``first``: offsets, and the end).
    Chains advance together, one word at a time; with ``edges`` also the
    expected number of each transition and of each first label."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    at, n = first[:-1][order], n[order]
    steps = int(n[0]) if len(n) else 0
    active = np.searchsorted(-n, -np.arange(1, steps + 1), side="right")    # chains longer than each step
    e = np.exp(emission - emission.max(axis=1, keepdims=True)) if len(emission) else emission
    t, out = np.exp(move), np.empty_like(e)
    if steps:
        a = np.exp(begin - begin.max()) * e[at[:active[0]]]
        a /= a.sum(axis=1, keepdims=True)
        out[at[:active[0]]] = a
    for k in range(1, steps):
        rows = at[:active[k]] + k
        a = (a[:active[k]] @ t) * e[rows]
        a /= a.sum(axis=1, keepdims=True)
        out[rows] = a
    moves = np.zeros_like(t)
    b = np.ones((0, len(t)))
    for k in range(steps - 1, -1, -1):
        m = active[k]
        if len(b) < m:
            b = np.concatenate([b, np.ones((m - len(b), len(t)))])
        rows = at[:m] + k
        ahead = e[rows] * b
        gamma = out[rows] * b
        total = gamma.sum(axis=1, keepdims=True)
        if edges and k:
            before = out[rows - 1]
            both = before[:, :, None] * t[None] * ahead[:, None, :]
            moves += (both / both.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        out[rows] = gamma / total
        b = ahead @ t.T
        b /= b.sum(axis=1, keepdims=True)
    if edges:
        return out, moves, out[first[:-1][np.diff(first) > 0]].sum(axis=0)
    return out


def _train(pieces: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]], languages: list[str]) -> ChainModel:
    """``pieces``: (language, words of a document as indices into unique words,
    feature buckets, feature owners) of the sample."""
    rng = np.random.default_rng(5)
    n_lang = len(languages)
    runs = [(lang, k, a) for k, (lang, n, _, _) in enumerate(pieces) for a in range(0, n, RUN)]
    by = [[r for r in runs if r[0] == k] for k in range(n_lang)]
    for some in by:
        rng.shuffle(some)
    base, buckets, owners = [], [], []
    total = 0
    for _, n, bucket, owner in pieces:
        base.append(total)
        buckets.append(bucket)
        owners.append(owner + total)
        total += n
    bucket, owner = np.concatenate(buckets), np.concatenate(owners)
    place, label, first = [], [], [0]
    turn = [0] * n_lang
    for lang, _, _ in runs[::RUNS]:
        for _ in range(RUNS):
            some = by[lang]
            _, doc, a = some[turn[lang] % len(some)]
            turn[lang] += 1
            words = np.arange(a, min(a + RUN, pieces[doc][1])) + base[doc]
            place.append(words)
            label.append(np.full(len(words), lang))
            if n_lang > 1 and rng.random() < SWITCH:
                lang = int((lang + 1 + rng.integers(n_lang - 1)) % n_lang)
        first.append(sum(map(len, place[-RUNS:])) + first[-1])
    place, label, first = np.concatenate(place), np.concatenate(label), np.array(first)
    model = ChainModel(languages, np.zeros((BUCKETS, n_lang)), np.zeros((n_lang, n_lang)), np.zeros(n_lang))
    gold = np.eye(n_lang)[label]
    joins = np.ones(len(label), dtype=bool)
    joins[first[:-1]] = False
    inner = np.flatnonzero(joins)
    gold_moves = np.zeros((n_lang, n_lang))
    np.add.at(gold_moves, (label[inner - 1], label[inner]), 1)
    gold_begin = gold[first[:-1]].sum(axis=0)
    speed = [np.zeros_like(w) for w in (model.weight, model.move, model.begin)]
    for _ in range(ROUNDS):
        score = np.stack([np.bincount(owner, weights=model.weight[bucket, k], minlength=total) for k in range(n_lang)], axis=1)
        got, moves, begin = forward_backward(score[place], first, model.move, model.begin, edges=True)
        off = np.stack([np.bincount(place, weights=gold[:, k] - got[:, k], minlength=total) for k in range(n_lang)], axis=1)
        step = np.stack([np.bincount(bucket, weights=off[owner, k], minlength=BUCKETS) for k in range(n_lang)], axis=1)
        for w, g, v in zip((model.weight, model.move, model.begin),
                           (step - 0.05 * model.weight, gold_moves - moves - model.move, gold_begin - begin - model.begin),
                           speed, strict=True):
            v += g * g
            w += RATE * g / np.sqrt(v + 1e-8)
    return ChainModel(languages, model.weight.astype(np.float32), model.move, model.begin)


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> ChainModel | None:
    """Learn from the rows with a language that are not held out; None if there are none."""
    lang = F.col(lang_col).cast("string")
    marked = documents_of(docs, id_col, text_col, lang.alias("lang"),
                          held_out(F.col(id_col)).alias("held")).filter("lang is not null and text is not null and not held")
    # every label is learned, so the model and this list grow with the number of labels
    counts = {r["lang"]: r["n"] for r in marked.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    # a hash of the id decides: about SAMPLE_DOCS rows of each language, at any size
    place = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(-1)), "text"), F.lit(1 << 30))
    limits = docs.sparkSession.createDataFrame([(k, int((1 << 30) * min(1.0, SAMPLE_DOCS / n))) for k, n in counts.items()],
                                               "lang string, most long")
    sample = marked.withColumn("place", place).join(F.broadcast(limits), "lang").filter(F.col("place") < F.col("most"))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where, langs = batch.column("place").to_numpy(), batch.column("lang").to_pylist()
            for piece in textnp.pieces(batch.column("text"), textnp.SPACE, PIECE):
                fine = lettered(piece)
                for d in range(piece.hi - piece.lo):
                    words = np.flatnonzero(fine[piece.first[d]:piece.first[d + 1]]) + piece.first[d]
                    if not len(words):
                        continue
                    a = int(where[piece.lo + d]) % max(1, len(words) - SAMPLE_WORDS + 1)
                    words = words[a:a + SAMPLE_WORDS]
                    bucket, owner = word_features(piece, words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(where[piece.lo + d])], pa.int64()), pa.array([langs[piece.lo + d]]),
                         pa.array([len(words)], pa.int32()), pa.array([bucket.astype(np.int32).tobytes()], pa.binary()),
                         pa.array([owner.astype(np.int32).tobytes()], pa.binary())],
                        names=["place", "lang", "n", "bucket", "owner"])
    got = (sample.select("doc_id", "text", "lang", "place")
           .mapInArrow(take, "place long, lang string, n int, bucket binary, owner binary")
           .orderBy("place", "lang", "n", "bucket").limit(2 * SAMPLE_DOCS * len(languages)).toArrow().to_pylist())
    have = [x for x in languages if any(r["lang"] == x for r in got)]
    if not have:
        return None
    return _train([(have.index(r["lang"]), r["n"], np.frombuffer(r["bucket"], np.int32).astype(np.int64),
                    np.frombuffer(r["owner"], np.int32).astype(np.int64)) for r in got], have)


def label_words(model: ChainModel, piece: textnp.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lettered words of a piece, their offsets per document and the probability
    of each language at each of them."""
    fine = lettered(piece)
    words = np.flatnonzero(fine)
    first = np.concatenate([[0], np.cumsum(fine)])[piece.first]
    if not len(words):
        return words, first, np.zeros((0, len(model.languages)))
    emission = model.emissions(piece, words, piece.word_hash()[words])
    return words, first, forward_backward(emission, first, model.move, model.begin)


def _shares(model: ChainModel, piece: textnp.Piece) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: expected share of each language, changes of language, words."""
    words, first, chance = label_words(model, piece)
    n = np.diff(first)
    sums = np.concatenate([np.zeros((1, len(model.languages))), np.cumsum(chance, axis=0)])
    share = (sums[first[1:]] - sums[first[:-1]]) / np.maximum(n, 1)[:, None]
    best = chance.argmax(axis=1) if len(words) else np.zeros(0, int)
    change = np.zeros(len(words) + 1, dtype=np.int64)
    if len(words) > 1:
        doc = np.repeat(np.arange(len(n)), n)
        change[2:] = np.cumsum((best[1:] != best[:-1]) & (doc[1:] == doc[:-1]))
    switches = np.where(n > 0, change[first[1:]] - change[np.minimum(first[:-1] + 1, len(words))], 0)
    raw, at = piece.buf, piece.doc_at
    ascii_letter = np.concatenate([[0], np.cumsum((raw >= 97) & (raw <= 122))])
    for d in np.flatnonzero((n > 0) & (ascii_letter[at[1:]] == ascii_letter[at[:-1]])).tolist():
        if not any(c.isalpha() for c in bytes(raw[at[d]:at[d + 1]]).decode()):
            n = n.copy()
            n[d] = 0                             # signs beyond ASCII, but no letter
    return share, switches, n


def identify(docs: DataFrame, model: ChainModel | None, id_col: str = "doc_id", text_col: str = "text",
             *more: Column) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score, n_words, n_switches)``, one row per
    input row; ``score`` is the expected share of the words in that language,
    ``n_words`` the words with letters, ``n_switches`` the changes of the most
    probable language from word to word.

    ``und`` with score 0 for null, empty and letterless texts, and for all
    without a model. Ties go to the first language in code point order. Null
    ids are given back; repeated rows give repeated result rows; an empty table
    gives no rows.
    """
    names = ["doc_id", "held_out", "lang_pred", "score", "n_words", "n_switches"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in textnp.pieces(batch.column("text"), textnp.SPACE, PIECE):
                n = piece.hi - piece.lo
                if model is None:
                    share, switches, words = np.zeros((n, 1)), np.zeros(n, np.int64), np.zeros(n, np.int64)
                else:
                    share, switches, words = _shares(model, piece)
                best = share.argmax(axis=1)
                lang = [model.languages[b] if w else "und" for b, w in zip(best.tolist(), words.tolist(), strict=True)]
                score = np.where(words > 0, np.clip(share[np.arange(n), best], 0, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(piece.lo, n), batch.column("held_out").slice(piece.lo, n),
                     pa.array(lang, pa.string()), pa.array(score), pa.array(words.astype(np.int64)),
                     pa.array(switches.astype(np.int64))], names=names)
    texts = documents_of(docs, id_col, text_col, held_out(F.col(id_col)).alias("held_out"))
    return texts.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, n_words long, n_switches long")


def identified(docs: DataFrame, model: ChainModel | None, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text has a language with at
    least the share ``least`` of its words."""
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, dtype=bool)
            for piece in textnp.pieces(batch.column(text_col), textnp.SPACE, PIECE):
                if model is not None:
                    share, _, words = _shares(model, piece)
                    good[piece.lo:piece.hi] = (words > 0) & (share.max(axis=1) >= least)
            yield batch.filter(pa.array(good))
    return docs.mapInArrow(keep, docs.schema)
