"""Exact byte-level BPE ids by the tokenizers library, with a table of known pre-tokens."""

from __future__ import annotations

import os
import unicodedata
from array import array

import numpy as np

#: Fixed value: the contractions that the public byte-level BPE pattern splits off.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
MOST = 1_500_000  # pre-tokens kept by a Python worker, about 60 MB
LONGEST = 200  # characters of a pre-token that is kept
BLOCK = 500_000  # characters handled at once
LETTER, DIGIT, OTHER, SPACE, EDGE, ODD = range(6)


def _classes() -> np.ndarray:
    """Classes of the code points below U+0250. Beyond them, and for the separators 1C-1F, texts go to the library whole."""
    out = np.full(0x251, ODD, np.uint8)
    for c in range(0x250):
        kind = unicodedata.category(chr(c))
        out[c] = LETTER if kind[0] == "L" else DIGIT if kind[0] == "N" else SPACE if chr(c).isspace() else OTHER
    out[0x1C:0x20] = ODD
    return out


CLASS = _classes()
_rng = np.random.default_rng(11)
_BASES = [int(b) | 1 for b in _rng.integers(1 << 40, 1 << 62, 2)]


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    n = BLOCK + 16
    with np.errstate(over="ignore"):
        up = np.cumprod(np.full(n, base, np.uint64))
        down = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
    return up, down


_made: dict[str, Coder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def coder(path: str) -> Coder:
    """The Python worker's coder; its table outlives a task."""
    if path not in _made:
        _made[path] = Coder(path)
    return _made[path]


class Coder:
    """Turns texts into the little-endian 16-bit bytes of their ids.

    The model encodes each pre-token by itself, so a distinct pre-token is
    encoded by the library once and then found by a 128-bit hash of its
    characters. Cutting, hashing and looking up are array operations.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        if self.model.get_vocab_size() > 65536:
            raise ValueError("ids must fit in 16 bits")
        self.powers = [_powers(b) for b in _BASES]
        self.bits = 22
        self._clear()

    def _clear(self) -> None:
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = np.zeros((2, MOST), np.uint64)
        self.start, self.size = np.zeros(MOST, np.int32), np.zeros(MOST, np.int32)
        self.pool, self.n, self.used = np.zeros(1 << 20, np.uint16), 0, 0

    def whole(self, texts: list[str]) -> list[bytes]:
        return [array("H", e.ids).tobytes() for e in self.model.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        held: list[int] = []
        size = 0
        for i, t in enumerate(texts):
            if len(t) >= BLOCK:
                out[i] = self.whole([t])[0]
                continue
            if size + len(t) + 1 > BLOCK:
                self._block(texts, held, out)
                held, size = [], 0
            held.append(i)
            size += len(t) + 1
        self._block(texts, held, out)
        return out  # type: ignore[return-value]

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each key, or -1."""
        at = (h[0] >> np.uint64(64 - self.bits)).astype(np.int64)
        got = self.slots[at]
        open_ = np.flatnonzero((got >= 0) & ((self.keys[0][got] != h[0]) | (self.keys[1][got] != h[1])))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            e = self.slots[at[open_]]
            got[open_] = e
            open_ = open_[(e >= 0) & ((self.keys[0][e] != h[0][open_]) | (self.keys[1][e] != h[1][open_]))]
        return got

    def _add(self, h: np.ndarray, ids: list[bytes]) -> None:
        n = len(ids)
        if self.n + n > MOST:
            self._clear()
        size = np.fromiter(map(len, ids), np.int64, n) // 2
        flat = np.frombuffer(b"".join(ids), np.uint16)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.pool[self.used : self.used + len(flat)] = flat
        entry = np.arange(self.n, self.n + n)
        self.keys[:, entry] = h
        self.start[entry], self.size[entry] = self.used + np.cumsum(size) - size, size
        self.n, self.used = self.n + n, self.used + len(flat)
        at = (h[0] >> np.uint64(64 - self.bits)).astype(np.int64)
        left = np.arange(n)
        while len(left):
            free = self.slots[at[left]] < 0
            self.slots[at[left[free]]] = entry[left[free]]
            left = left[self.slots[at[left]] != entry[left]]
            at[left] = (at[left] + 1) & ((1 << self.bits) - 1)

    def _block(self, texts: list[str], which: list[int], out: list) -> None:
        if not which:
            return
        text = "\0".join(["", *(texts[i] for i in which), ""])
        char = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        edge = np.cumsum([0, *(len(texts[i]) + 1 for i in which)])
        cls = CLASS[np.minimum(char, 0x250)]
        cls[edge] = EDGE
        odd = np.logical_or.reduceat(cls == ODD, edge[:-1]) if len(edge) > 1 else np.zeros(0, bool)
        if odd.any():
            strange = [i for i, o in zip(which, odd) if o]
            for i, b in zip(strange, self.whole([texts[i] for i in strange])):
                out[i] = b
            self._block(texts, [i for i, o in zip(which, odd) if not o], out)
            return
        space = cls == SPACE
        first = np.ones(len(char), bool)
        # After white space, the next piece starts at the last space of the run, which it takes in.
        first[1:] = np.where(space[1:], ~space[:-1], np.where(space[:-1], char[:-1] != 32, cls[1:] != cls[:-1]))
        first[:-1] |= space[:-1] & ~space[1:] & (cls[1:] != EDGE)
        first[edge] = True
        quote = np.flatnonzero(char == 39)
        if len(quote):
            before = quote - 1
            quote = quote[(cls[before] != OTHER) & (char[before] != 32)]
            ends = np.zeros(len(quote), np.int64)
            for c in CONTRACTIONS:
                hit = np.ones(len(quote), bool)
                for k, x in enumerate(c):
                    hit &= (np.take(char, quote + k, mode="clip") == ord(x)) & (np.take(cls, quote + k, mode="clip") != EDGE)
                ends[hit & (ends == 0)] = len(c)
            hit = ends > 0
            first[quote[hit]] = True
            first[quote[hit] + 1] = False
            first[quote[hit] + ends[hit]] = True
        a = np.flatnonzero(first)
        z = np.append(a[1:], len(char))
        real = cls[a] != EDGE
        piece_of = np.cumsum(~real) - 1  # number of the text
        a, z, piece_of = a[real], z[real], piece_of[real]
        n = len(char)
        h = np.empty((2, len(a)), np.uint64)
        value = char.astype(np.uint64) + np.uint64(1)
        with np.errstate(over="ignore"):
            for k, (up, down) in enumerate(self.powers):
                total = np.zeros(n + 1, np.uint64)
                np.cumsum(value * up[:n], out=total[1:])
                x = (total[z] - total[a]) * down[a]
                x ^= x >> np.uint64(31)
                h[k] = x * np.uint64(0x9E3779B97F4A7C15)
        entry = self._find(h)
        miss = np.flatnonzero(entry < 0)
        if len(miss):
            long = z[miss] - a[miss] > LONGEST
            keep = miss[~long]
            _, one = np.unique(h[0][keep], return_index=True)
            new = keep[one]
            before = self.n
            self._add(h[:, new], self.whole([text[s:e] for s, e in zip(a[new].tolist(), z[new].tolist())]))
            entry = self._find(h) if self.n < before + len(new) else entry  # the table was cleared
            entry[miss] = self._find(h[:, miss])
            if long.any() or (entry < 0).any():  # very long pieces, or what a cleared table lost: as the library has it
                lost = np.unique(piece_of[entry < 0])
                again = [which[i] for i in lost.tolist()]
                for i, b in zip(again, self.whole([texts[i] for i in again])):
                    out[i] = b
                entry[entry < 0] = 0
        size = self.size[entry].astype(np.int64)
        end = np.cumsum(size)
        flat = self.pool[np.repeat(self.start[entry] - (end - size), size) + np.arange(int(size.sum()))].tobytes()
        last = np.searchsorted(piece_of, np.arange(len(which)), side="right")
        mark = [0, *(2 * np.concatenate([[0], end])[last]).tolist()]
        for i, s, e in zip(which, mark[:-1], mark[1:]):
            if out[i] is None:
                out[i] = flat[s:e]
