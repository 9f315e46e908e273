"""Operator 9: BPE encoding and decoding with content-defined chunk reuse.

A text is cut at white space (space or line feed) where the rolling hash of the
bytes before it is 0 modulo the mean chunk size in words, so equal passages are
cut alike in every document. Each distinct chunk that a task meets is encoded
and decoded by the tokenizers library once; a document's ids are its chunks' ids
in order. Where the tokenizer's steps treat words apart (``apart``) a new chunk is
encoded by its words, each distinct one once per task, as long as no tested join
differs; else as a whole.

A cut is only right if the tokenizer does not look across it, so every distinct
join of two neighbouring chunks is tested by re-encoding: both sides together, with
the white space, against the two sides alone. Where they differ, the cut is taken
back, the longer chunk has new neighbours, and so on until every join agrees. The
sides are the whole chunks; for a tokenizer whose steps treat words apart
(``apart``) they are the words beside the cut, which decide its join alone, and
chunks' decoded texts are joined as their ids are (else the ids are decoded text by
text). (A token that depends on three chunks, though each two neighbours agree, is
not seen.)

Chunk sizes: 63 % of two-word chunks and 90 % of four-word chunks are distinct
within a task, so what repeats are passages; the fewer cuts, the fewer joins to test.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgestat.llm import textnp
from forgestat.llm.common import documents_of

EDGE_WORDS = 64          # words in a chunk, on average, where a join is tested by its two words
TESTED_WORDS = 8         # the same where it is tested by its two chunks
WINDOW = 4               # bytes under the rolling hash
KEPT = 1 << 19           # distinct chunks and distinct joins that a task keeps
KEPT_WORDS = 1 << 20     # distinct words that it keeps
KEPT_BYTES = 1 << 25     # bytes of ids and decoded texts of the chunks, and of the words, that it keeps
PIECE = 1 << 20          # bytes of text handled at a time
BATCH = 4096             # chunks given to the tokenizer at a time
TOGETHER = 64            # texts given to it as one, set apart by an added token

_OUT = "doc_id long, n_tokens long, ids binary, decoded string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])


def public_tokenizer() -> str:
    """Path of the default tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


# Steps that work character by character or within a run without
# white space, and word patterns that match no white space and look at none.
_LOCAL_NORMALIZERS = ("BertNormalizer", "Lowercase", "NFC", "NFD", "NFKC", "NFKD", "StripAccents")
_WORD_SPLITTERS = ("BertPreTokenizer", "Whitespace", "WhitespaceSplit")
_WORD_PATTERNS = (r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",)
_WITHIN_WORDS = (*_WORD_SPLITTERS, "ByteLevel", "Digits", "Punctuation")


def _steps(step: dict | None, inner: str) -> list[dict]:
    if step is None:
        return []
    return [x for s in step[inner] for x in _steps(s, inner)] if step["type"] == "Sequence" else [step]


def apart(tokenizer) -> bool:
    """Whether the ids and the decoded text of a text are those of its words, cut
    at spaces and line feeds, one after the other: no added token holds white
    space, the normalizer is local, the first pre-tokenizer drops white space,
    the model sees single words without chance, and tokens decode apart."""
    spec = json.loads(tokenizer.to_str())
    splits = _steps(spec["pre_tokenizer"], "pretokenizers")
    first = splits[0] if splits else {"type": None}
    spaces = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    return (not any(c.isspace() for t in spec["added_tokens"] for c in t["content"])
            and all(n["type"] in _LOCAL_NORMALIZERS or n == spaces for n in _steps(spec["normalizer"], "normalizers"))
            and (first["type"] in _WORD_SPLITTERS
                 or (first["type"] == "Split" and first["pattern"].get("Regex") in _WORD_PATTERNS
                     and first["behavior"] == "Removed" and first["invert"]))
            and all(p["type"] in _WITHIN_WORDS for p in splits[1:])
            and not spec["model"].get("dropout") and spec["decoder"] is None)


def separator(tokenizer) -> tuple[str, int] | None:
    """An added token (and its id) that sets texts apart within one: it is found before
    all other steps, no other added token can take a part of it, and for a tokenizer
    whose steps treat words apart nothing looks across it. None, if there is none."""
    added = json.loads(tokenizer.to_str())["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        return None
    for t in added:
        text = t["content"]
        others = [x["content"] for x in added if x is not t]
        ends = {x[k:] for x in others for k in range(len(x))} | {text[k:] for k in range(1, len(text))}
        if text and t["special"] and not t["normalized"] and not any(text in x for x in others) and not any(text.startswith(e) for e in ends):
            return text, t["id"]
    return None


class _Kept:
    """Ids and decoded texts of spans (chunks or words), looked up by the spans' hashes."""

    def __init__(self, most: int):
        self.most = most
        self.forget()

    def forget(self):
        self.hashes = np.zeros(0, dtype=np.uint64)       # sorted
        self.row = np.zeros(0, dtype=np.int64)           # row of each hash in the tables
        self.ids, self.texts = pa.array([], pa.large_binary()), pa.array([], pa.large_string())
        self.sizes = np.zeros(0, dtype=np.int64)

    def missing(self, names: np.ndarray) -> np.ndarray:
        """Which of the (sorted) hashes are to be added; all, if they no longer fit."""
        at = np.searchsorted(self.hashes, names)
        known = np.zeros(len(names), dtype=bool)
        known[at < len(self.hashes)] = self.hashes[at[at < len(self.hashes)]] == names[at < len(self.hashes)]
        new = np.flatnonzero(~known)
        if len(new) and (len(self.hashes) + len(new) > self.most or self.ids.nbytes + self.texts.nbytes > KEPT_BYTES):
            self.forget()
            return np.arange(len(names))
        return new

    def add(self, names: np.ndarray, ids: pa.Array, texts: pa.Array, sizes: np.ndarray):
        at = np.searchsorted(self.hashes, names)
        self.row = np.insert(self.row, at, len(self.sizes) + np.arange(len(names)))
        self.hashes = np.insert(self.hashes, at, names)
        self.ids, self.texts = pa.concat_arrays([self.ids, ids]), pa.concat_arrays([self.texts, texts])
        self.sizes = np.concatenate([self.sizes, sizes]).astype(np.int64)

    def joined(self, names: np.ndarray, which: np.ndarray, first: np.ndarray) -> tuple[pa.Array, pa.Array, np.ndarray]:
        """Ids, decoded texts and numbers of ids of runs of spans, given by the distinct
        hashes, by which of them each span has, and by each run's first span (and the end)."""
        code = self.row[np.searchsorted(self.hashes, names)][which]
        size = self.sizes[code]
        some = size > 0                                    # spans without tokens leave no trace
        offsets = pa.array(np.concatenate([[0], np.cumsum(some)])[first], pa.int64())
        take = pa.array(code[some])

        def join(values, between):
            if not len(take):
                return pa.array([b""] * (len(first) - 1), pa.large_binary()).cast(values.type)
            return pc.binary_join(pa.LargeListArray.from_arrays(offsets, values.take(take)), pa.scalar(between, values.type))
        return (join(self.ids, b""), join(self.texts, " "),
                np.diff(np.concatenate([[0], np.cumsum(size)])[first]))


class ChunkCoder:
    """Encodes texts by chunks that are kept between calls."""

    def __init__(self, tokenizer, chunk_words: int | None = None):
        """``tokenizer``: the path of a tokenizers file, or a Tokenizer."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer) if isinstance(tokenizer, str) else tokenizer
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.apart = apart(self.tokenizer)
        self.chunk_words = chunk_words or (EDGE_WORDS if self.apart else TESTED_WORDS)
        self.cut_at = np.zeros(256, dtype=bool)
        self.cut_at[[0x20, 0x0A]] = True
        self.agrees: dict[int, bool] = {}                # joins that were tested
        self.separator = separator(self.tokenizer) if self.apart else None
        self.chunks, self.words = _Kept(KEPT), _Kept(KEPT_WORDS)
        self.by_words = True                             # until a join of two words differs

    def _alone(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text. The tokenizer takes some time for every text that it is given,
        so where words are apart it gets many as one, with an added token between
        them; texts in which that token itself occurs are found by its count."""
        if self.separator is None:
            return self._alone(texts)
        between, mark = self.separator
        groups = [texts[k:k + TOGETHER] for k in range(0, len(texts), TOGETHER)]
        out = []
        for group, ids in zip(groups, self._alone([between.join(g) for g in groups]), strict=True):
            if ids.count(mark) != len(group) - 1:
                out += self._alone(group)
                continue
            start = 0
            for _ in group[1:]:
                end = ids.index(mark, start)
                out.append(ids[start:end])
                start = end + 1
            out.append(ids[start:])
        return out

    def _decode(self, ids: list[list[int]]) -> list[str]:
        return self.tokenizer.decode_batch(ids, skip_special_tokens=False)

    def _differing(self, piece: textnp.Piece, left, middle, right) -> np.ndarray:
        """Which joins of two chunks (or of their words beside the cut), given by the
        bytes at which the left one starts, the right one starts and the right one
        ends, change the ids."""
        hashes = piece.span_hash(left, middle, middle, right)
        joins = textnp.mix(hashes[0] + textnp.mix(hashes[1]))
        names, where, which = np.unique(joins, return_index=True, return_inverse=True)
        raw = piece.raw.tobytes()
        if len(self.agrees) + len(names) > KEPT:
            self.agrees = {}
        new = [k for k, name in enumerate(names.tolist()) if name not in self.agrees]
        for some in (new[k:k + BATCH] for k in range(0, len(new), BATCH)):
            at = [tuple(int(c[where[k]]) for c in (left, middle, right)) for k in some]
            sides = [(raw[a:b].decode(), raw[b:c].decode()) for a, b, c in at]
            texts = list(dict.fromkeys(t for a, b in sides for t in (a, b, a + b)))
            ids = dict(zip(texts, self._encode(texts), strict=True))
            for k, (a, b) in zip(some, sides, strict=True):
                self.agrees[int(names[k])] = ids[a] + ids[b] == ids[a + b]
        return ~np.array([self.agrees[name] for name in names.tolist()], dtype=bool)[which]

    def _chunks(self, piece: textnp.Piece):
        """Starts and ends (bytes) of the chunks, their hashes, and each text's first chunk.

        Where words are apart the white space around chunks is left out; otherwise
        it belongs to the chunk after it (or the text's last one)."""
        first_word = np.zeros(len(piece.start) + 1, dtype=bool)
        first_word[piece.first] = True
        inner = np.flatnonzero(~first_word[:-1])          # words that follow another of their text
        before = piece.end[inner - 1]
        window = piece.span_hash(np.maximum(before - WINDOW, piece.start[inner - 1]), before)
        cut = window % np.uint64(self.chunk_words) == 0
        if self.apart:
            words = inner[cut]                            # words after a cut
            if len(words):
                differ = self._differing(piece, piece.start[words - 1], piece.start[words], piece.end[words])
                if self.by_words and differ.any():
                    self.by_words = False
                    self.chunks.forget()
                words = words[~differ]
            starts = first_word[:-1].copy()
            starts[words] = True
            begin = np.flatnonzero(starts)
            last = np.append(begin[1:], len(piece.start)) - 1
            return (piece.start[begin], piece.end[last], piece.span_hash(piece.start[begin], piece.end[last]),
                    np.searchsorted(begin, piece.first))
        texts = piece.doc_at[:-1][np.diff(piece.doc_at) > 0]
        begin = np.union1d(texts, before[cut])
        while True:
            end = np.append(begin[1:], piece.doc_at[-1:])[:len(begin)]
            joins = np.flatnonzero(~np.isin(begin, texts))
            differ = self._differing(piece, begin[joins - 1], begin[joins], end[joins]) if len(joins) else joins > 0
            if not differ.any():
                return begin, end, piece.span_hash(begin, end), np.searchsorted(begin, piece.doc_at)
            begin = np.delete(begin, joins[differ])

    def _add(self, kept: _Kept, piece: textnp.Piece, names: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Encode spans (bytes) as wholes."""
        raw = piece.raw.tobytes()
        texts = [raw[a:b].decode() for a, b in zip(start.tolist(), end.tolist(), strict=True)]
        flat, size, decoded = [], [], []
        for k in range(0, len(texts), BATCH):
            ids = self._encode(texts[k:k + BATCH])
            size.append(np.fromiter(map(len, ids), np.int64, len(ids)))
            flat.append(np.fromiter(chain.from_iterable(ids), "<u4", size[-1].sum()))
            decoded.append(pa.array(self._decode(ids) if self.apart else [""] * len(ids), pa.large_string()))
        sizes = np.concatenate(size)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        kept.add(names, pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(4 * ends), pa.py_buffer(np.concatenate(flat))]),
                 pa.concat_arrays(decoded), sizes)

    def _add_by_words(self, piece: textnp.Piece, names: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Encode chunks by their words: the tokenizer sees those that are new."""
        low, high = np.searchsorted(piece.start, start), np.searchsorted(piece.start, end)
        first = np.concatenate([[0], np.cumsum(high - low)])
        word = np.arange(first[-1]) + np.repeat(low - first[:-1], high - low)
        hashes = piece.span_hash(piece.start[word], piece.end[word])
        distinct, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = self.words.missing(distinct)
        if len(new):
            at = word[where[new]]
            self._add(self.words, piece, distinct[new], piece.start[at], piece.end[at])
        self.chunks.add(names, *self.words.joined(distinct, which, first))

    def encode(self, piece: textnp.Piece) -> pa.RecordBatch:
        """Columns n_tokens, ids (little-endian unsigned 32-bit), decoded of the piece's texts."""
        start, end, hashes, first = self._chunks(piece)
        names, where, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = self.chunks.missing(names)
        if len(new):
            at = where[new]
            if self.apart and self.by_words:
                self._add_by_words(piece, names[new], start[at], end[at])
            else:
                self._add(self.chunks, piece, names[new], start[at], end[at])
        ids, decoded, sizes = self.chunks.joined(names, which, first)
        ids = ids.cast(pa.binary())
        if self.apart:
            decoded = decoded.cast(pa.string())
        else:
            decoded = pa.array(self._decode([np.frombuffer(x, "<u4").tolist() for x in ids.to_pylist()]), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), ids, decoded],
                                          names=["n_tokens", "ids", "decoded"])


def bpe_encode(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
               chunk_words: int | None = None) -> DataFrame:
    """``(doc_id, n_tokens, ids, decoded)``, one row per input row: the token ids
    of the whole text as little-endian unsigned 32-bit numbers, and the text that
    they decode to. ``tokenizer`` is the path of a tokenizers file that every
    executor has (default: word_bpe_49k.json of the public tokenizers);
    ``chunk_words`` the mean size of a chunk (default: by the tokenizer).

    Null and empty texts have no tokens, empty ids and an empty decoded text. A
    null id is given back. Repeated rows give repeated result rows. An empty
    table gives no rows. Equality of chunks is equality of their 64-bit hash.
    """
    path = tokenizer or public_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = ChunkCoder(path, chunk_words)
        for batch in batches:
            for piece in textnp.pieces(batch.column("text"), coder.cut_at, PIECE, lower=False):
                got = coder.encode(piece)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(piece.lo, piece.hi - piece.lo),
                                                  *got.columns], schema=_SCHEMA)
    return documents_of(docs, id_col, text_col).mapInArrow(run, _OUT)


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
