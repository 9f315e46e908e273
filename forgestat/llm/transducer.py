"""Minimal acyclic transducers: sorted terms to their lexicographic ordinals.

``build`` adds the terms one by one in ascending order; states that no later
term can change are looked up in a register of states, so equal suffixes share
one state. An edge's output is the number of terms that precede its branch;
outputs along a term's path sum to the term's ordinal.

``Streamer`` holds several transducers in one hash table of edges and advances
many words at once, one byte a step; a word leaves as soon as no edge fits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_PREFIX = 8          # bytes that choose a word's transducer


@dataclass
class Transducer:
    """States 0 .. n - 1, the last one is the root; edges by source state, then byte."""
    source: np.ndarray       # int32, state of each edge
    label: np.ndarray        # uint8
    target: np.ndarray       # int32
    output: np.ndarray       # int64
    final: np.ndarray        # bool, by state
    terms: int

    def to_bytes(self) -> bytes:
        head = np.array([len(self.source), len(self.final), self.terms], "<i8").tobytes()
        return b"".join([head, self.output.astype("<i8").tobytes(), self.source.astype("<i4").tobytes(),
                         self.target.astype("<i4").tobytes(), self.label.tobytes(), self.final.astype(np.uint8).tobytes()])

    @staticmethod
    def from_bytes(raw: bytes) -> Transducer:
        edges, states, terms = np.frombuffer(raw, "<i8", 3).tolist()
        at, parts = 24, []
        for kind, n in (("<i8", edges), ("<i4", edges), ("<i4", edges), ("u1", edges), ("u1", states)):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
        output, source, target, label, final = parts
        return Transducer(source, label, target, output, final.astype(bool), terms)


def build(terms: Sequence[bytes]) -> Transducer:
    """Of distinct terms in ascending byte order."""
    register: dict[tuple, int] = {}
    kept: list[tuple] = []               # (final, byte, target, byte, target ...) of each state
    count: list[int] = []                # terms that a state accepts
    path: list[list[int]] = [[0]]        # unfinished states from the root down; the last target is open
    last = b""

    def close(depth: int) -> None:
        """Finish the states below ``depth``."""
        while len(path) > depth + 1:
            state = tuple(path.pop())
            number = register.get(state)
            if number is None:
                number = register[state] = len(kept)
                kept.append(state)
                count.append(state[0] + sum(count[t] for t in state[2::2]))
            path[-1][-1] = number
    for term in terms:
        same, most = 0, min(len(term), len(last))
        while same < most and term[same] == last[same]:
            same += 1
        if term <= last and (term or len(path) > 1 or path[0][0]):
            raise ValueError("terms must ascend")
        close(same)
        for byte in term[same:]:
            path[-1] += (byte, -1)
            path.append([0])
        path[-1][0] = 1
        last = term
    close(0)
    root = tuple(path[0])                # never shared: it is the last state
    kept.append(root)
    source, label, target, output = [], [], [], []
    for number, state in enumerate(kept):
        before = state[0]
        for byte, to in zip(state[1::2], state[2::2], strict=True):
            source.append(number)
            label.append(byte)
            target.append(to)
            output.append(before)
            before += count[to]
    return Transducer(np.array(source, np.int32), np.array(label, np.uint8), np.array(target, np.int32),
                      np.array(output, np.int64), np.array([s[0] for s in kept], bool),
                      root[0] + sum(count[t] for t in root[2::2]))


def prefix_keys(buf: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The first bytes of each word as one number; numbers ascend as the prefixes do."""
    padded = np.concatenate([buf, np.zeros(_PREFIX, np.uint8)])
    out = np.zeros(len(start), np.uint64)
    for k in range(_PREFIX):
        out = (out << np.uint64(8)) | np.where(k < length, padded[start + k], 0).astype(np.uint64)
    return out


class Streamer:
    """``parts``: (name of the vocabulary, smallest term, first ordinal, transducer),
    ascending by term within a vocabulary. Terms of different parts of one
    vocabulary must differ in their first 8 bytes."""

    def __init__(self, parts: Sequence[tuple[str, bytes, int, Transducer]]):
        self.roots: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        by_name: dict[str, list[tuple[int, int, int]]] = {}
        keys, targets, outputs, finals, states = [], [], [], [], 0
        for name, first, base, t in parts:
            keys.append(((t.source.astype(np.int64) + states) << 8) | t.label)
            targets.append(t.target + np.int32(states))
            outputs.append(t.output)
            finals.append(t.final)
            states += len(t.final)
            by_name.setdefault(name, []).append((int.from_bytes(first[:_PREFIX].ljust(_PREFIX, b"\0"), "big"), states - 1, base))
        for name, rows in by_name.items():
            low, root, base = zip(*rows, strict=True)
            self.roots[name] = np.array(low, np.uint64), np.array(root, np.int64), np.array(base, np.int64)
        joined = lambda arrays, kind: np.concatenate(arrays).astype(kind) if arrays else np.zeros(0, kind)
        self.final = joined(finals, bool)
        self._fill(joined(keys, np.int64), joined(targets, np.int32), joined(outputs, np.int64))

    def _fill(self, keys: np.ndarray, targets: np.ndarray, outputs: np.ndarray) -> None:
        bits = max(4, int(3 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.targets, self.outputs = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int64)
        slot, left = self._slots(keys), np.arange(len(keys))
        while len(left):                                 # one edge per free slot each round
            free = np.flatnonzero(self.keys[slot] < 0)
            at, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.keys[at] = keys[left[put]]
            self.targets[at], self.outputs[at] = targets[left[put]], outputs[left[put]]
            rest = np.ones(len(left), bool)
            rest[put] = False
            left, slot = left[rest], (slot[rest] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _SPREAD) >> self.shift).astype(np.int64)

    def _edges(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each edge, or -1."""
        slot = self._slots(keys)
        held = self.keys[slot]
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        slot[held < 0] = -1
        while len(open_):
            at = (slot[open_] + 1) & self.mask
            held = self.keys[at]
            slot[open_] = np.where(held < 0, -1, at)
            open_ = open_[(held >= 0) & (held != keys[open_])]
        return slot

    def ordinals(self, name: str, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Ordinal of each word ``buf[start:end]`` in a vocabulary, -1 where it has none."""
        out = np.full(len(start), -1, np.int64)
        if name not in self.roots or not len(start):
            return out
        low, root, base = self.roots[name]
        length = end - start
        if len(low) > 1:
            part = np.searchsorted(low, prefix_keys(buf, start, length), side="right") - 1
            word = np.flatnonzero(part >= 0)
            state, total = root[part[word]], base[part[word]]
        else:
            word = np.arange(len(start))
            state, total = np.full(len(start), root[0]), np.full(len(start), base[0])
        at, left = start[word], length[word]
        while len(word):
            done = left == 0
            if done.any():
                good = done & self.final[state]
                out[word[good]] = total[good]
                word, state, total, at, left = (x[~done] for x in (word, state, total, at, left))
                if not len(word):
                    break
            edge = self._edges((state << 8) | buf[at])
            fits = edge >= 0
            edge = edge[fits]
            word, at, left = word[fits], at[fits] + 1, left[fits] - 1
            state, total = self.targets[edge].astype(np.int64), total[fits] + self.outputs[edge]
        return out
