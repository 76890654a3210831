"""Token ids of whole texts from a bounded cache of their space-separated pieces.

Tokenizers that never join a non-space with a following space treat the pieces between such places
alone; so each distinct piece goes through the library once and texts are put together from the cache.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np

#: Characters of text handled at a time; longer texts are cut at a place where pieces part anyway.
CHUNK = 1_000_000
SAFE = re.compile(r"(?<=\S) (?=\S)")
ODD = re.compile(r" \s")
PLAIN = re.compile(r" \S[^ ]*")
PARTS = re.compile(r"(?<=\S)(?= )|(?= \S)")


class _Index(dict):
    """Piece to number; new pieces get the next number and wait in pending."""

    def __init__(self) -> None:
        super().__init__()
        self.pending: list = []

    def __missing__(self, key):
        self[key] = n = len(self)
        self.pending.append(key)
        return n


class PieceCache:
    """keys(text, first) gives a text's pieces; encode(keys) all keys' ids in a row, and each key's number of ids.

    cut: whether pieces part between a non-space, a space and a non-space; else texts stay whole.
    """

    def __init__(self, keys: Callable[[str, bool], list], encode: Callable[[list], tuple[np.ndarray, np.ndarray]], limit: int = 400_000, cut: bool = True) -> None:
        self.keys, self.encode, self.limit, self.cut = keys, encode, limit, cut
        self.clear()

    def clear(self) -> None:
        self.index = _Index()
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)
        self.hits = np.zeros(1 << 14, np.int64)

    def _shrink(self) -> None:
        """Forgets the pieces seen once; all of them if most were seen again."""
        keep = np.flatnonzero(self.hits[: len(self.index)] > 1)
        if 2 * len(keep) > self.limit:
            self.clear()
            return
        keys, lengths = list(self.index), self.length[keep]
        take = np.repeat(self.start[keep] - np.cumsum(lengths) + lengths, lengths) + np.arange(int(lengths.sum()))
        flat = self.pool[take]
        self.clear()
        for k in keep.tolist():
            self.index[keys[k]] = len(self.index)
        self._store(flat, lengths)
        self.hits[: len(keep)] = 1  # to be seen again before the next time

    def _learn(self) -> None:
        new, self.index.pending = self.index.pending, []
        if not new:
            return
        self._store(*self.encode(new))

    def _store(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        new, n = len(lengths), len(self.index)
        if n > len(self.start):
            self.start, self.length, self.hits = (np.concatenate([x, np.zeros(2 * n - len(x), x.dtype)]) for x in (self.start, self.length, self.hits))
        if self.used + len(flat) > len(self.pool):
            self.pool = np.resize(self.pool, 2 * (self.used + len(flat)))
        self.pool[self.used : self.used + len(flat)] = flat
        self.start[n - new : n] = self.used + np.cumsum(lengths) - lengths
        self.length[n - new : n] = lengths
        self.used += len(flat)

    def _ids(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        """All pieces' ids in a row, and each piece's number of ids."""
        at = np.fromiter(map(self.index.__getitem__, pieces), np.int64, len(pieces))
        self._learn()
        np.add.at(self.hits, at, 1)
        lengths = self.length[at]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        take = np.repeat(self.start[at] - (ends - lengths), lengths)
        take += np.arange(total)
        return self.pool[take], lengths

    def batches(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
        """(ids of some texts in a row, each text's number of ids, whether the last text goes on in the next batch)."""
        pieces: list = []
        cuts = [0]
        size = 0
        for text in texts:
            at = 0
            while self.cut and len(text) - at > CHUNK and (m := SAFE.search(text, at + CHUNK)):
                pieces += self.keys(text[at + (at > 0) : m.start()], at == 0)
                cuts.append(len(pieces))
                yield (*self._out(pieces, cuts), True)
                pieces, cuts, size, at = [], [0], 0, m.start()
            pieces += self.keys(text[at + (at > 0) :], at == 0)
            cuts.append(len(pieces))
            size += len(text) - at
            if size > CHUNK:
                yield (*self._out(pieces, cuts), False)
                pieces, cuts, size = [], [0], 0
        if len(cuts) > 1:
            yield (*self._out(pieces, cuts), False)

    def _out(self, pieces: list, cuts: list) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > self.limit:
            self._shrink()
        ids, lengths = self._ids(pieces)
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.asarray(cuts)]
        return ids, np.diff(ends)

    def texts(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """Each text's ids."""
        parts: list = []
        for ids, lengths, goes_on in self.batches(texts):
            one = np.split(ids, np.cumsum(lengths)[:-1])
            for k, x in enumerate(one):
                parts.append(x)
                if not (goes_on and k == len(one) - 1):
                    yield parts[0] if len(parts) == 1 else np.concatenate(parts)
                    parts = []


def spaced_keys(text: str, first: bool) -> list:
    """Keys of a text for byte-level BPE: a string, without spaces, stands for a space and that string;
    a tuple stands for its only element as it is.

    first is false for the rest of a cut text, whose leading space has been taken off.
    """
    if ODD.search(text):
        parts = PARTS.split(text if first else " " + text)
        return [p[1:] if PLAIN.fullmatch(p) else (p,) for p in parts if p]
    pieces = text.split(" ")
    if not pieces[-1]:
        pieces[-1] = (" ",)
    if first:
        if pieces[0] and text:
            pieces[0] = (pieces[0],) if isinstance(pieces[0], str) else ("",)
        else:
            del pieces[0]
    return pieces


#: Pieces joined for one call of a library.
JOINED = 256


def joined_encode(keys: list, kind: Callable[[object], int], together: list[Callable[[list[str]], list]], alone: Callable[[list], list], starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids and numbers of ids of keys; those of a kind k >= 0 are joined by spaces, JOINED at a time, and go to together[k].

    together[k](texts) and, for keys of kind -1, alone(keys) give lists of ids; starts tells by id
    whether a piece starts there, which it does just where its leading space is.
    """
    kinds = np.fromiter(map(kind, keys), np.int8, len(keys))
    sizes, flats = np.zeros(len(keys), np.int64), {}
    for k in np.unique(kinds).tolist():
        at = np.flatnonzero(kinds == k)
        own = keys if len(at) == len(keys) else [keys[j] for j in at.tolist()]
        lists = alone(own) if k < 0 else together[k]([" ".join(own[j : j + JOINED]) for j in range(0, len(own), JOINED)])
        flat = flats[k] = np.concatenate([np.asarray(x, np.uint32) for x in lists])
        if k < 0:
            sizes[at] = [len(x) for x in lists]
            continue
        first = np.flatnonzero(starts[flat])
        if len(first) != len(own):
            raise ValueError("pieces and places where pieces start don't agree")
        sizes[at] = np.diff(np.append(first, len(flat)))
    if len(flats) == 1:
        return flats.popitem()[1], sizes
    out, whose = np.zeros(int(sizes.sum()), np.uint32), np.repeat(kinds, sizes)
    for k, flat in flats.items():
        out[whose == k] = flat
    return out, sizes
