"""Ids of texts from the ids of their pieces, each distinct piece resolved once while memory lasts."""

from __future__ import annotations

import itertools

import numpy as np

#: Pieces of more characters (or bytes) are resolved each time and not remembered.
LONG = 64


class Growing:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.data, self.n = np.zeros(1024, kind), 0

    def extend(self, more: np.ndarray) -> None:
        need = self.n + len(more)
        if need > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(max(need, 2 * len(self.data)) - self.n, self.data.dtype)])
        self.data[self.n : need] = more
        self.n = need

    def view(self) -> np.ndarray:
        return self.data[: self.n]


class _Places(dict):
    """A piece's number; an unknown piece gets the next one and is noted."""

    def __init__(self):
        super().__init__()
        self.new: list = []
        self.next = 0

    def __missing__(self, piece) -> int:
        self[piece] = n = self.next
        self.next += 1
        self.new.append(piece)
        return n


class PieceMemo:
    """Subclasses resolve new pieces: ``resolve(pieces)`` gives their ids end to end and how many each has.

    memory: how many pieces are remembered at most, of ``LONG`` characters at most each; the ids that are kept are
    bounded by eight times as many.  Beyond, the memo starts afresh.
    """

    def __init__(self, memory: int, kind):
        self.memory, self.kind = memory, kind
        self.forget()

    def forget(self) -> None:
        self.places = _Places()
        self.starts, self.flat = Growing(np.int64), Growing(self.kind)
        self.starts.extend(np.zeros(1, np.int64))

    def resolve(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        raise NotImplementedError

    def lookup(self, split: list[list]) -> list[np.ndarray]:
        """ids of each text, given its pieces."""
        if len(self.places) > self.memory or self.flat.n > 8 * self.memory:
            self.forget()
        at = np.fromiter(map(self.places.__getitem__, itertools.chain.from_iterable(split)), np.int64)
        if new := self.places.new:
            found, n = self.resolve(new)
            self.places.new = []
            for piece in new:
                if len(piece[0] if type(piece) is tuple else piece) > LONG:
                    del self.places[piece]
            self.starts.extend(self.starts.data[self.starts.n - 1] + np.cumsum(n))
            self.flat.extend(np.asarray(found, self.kind))
        starts = self.starts.view()
        n = starts[at + 1] - starts[at]
        ends = np.cumsum(n)
        ids = self.flat.view()[np.repeat(starts[at] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)]
        last = np.cumsum([len(x) for x in split])
        return np.split(ids, np.concatenate([[0], ends])[last[:-1]]) if split else []
