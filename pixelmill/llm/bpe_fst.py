"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

A sequence of tokens is the BPE encoding of its bytes if and only if every two neighbours stay apart when
merged alone.  So the encoding of every prefix of a piece ends in exactly one token, and that token can be found
from left to right: the transducer reads a byte, and its state holds, for every suffix of the input that may
still grow into a token, the place in the trie of tokens, the token before that suffix, and the tokens not yet
emitted.  What all of these agree on is emitted; the lookahead is bounded by the longest token.  States and
transitions are made when first needed and kept; a machine that has grown beyond ``STATES`` starts afresh.

Decoding is streamed: ids come in chunks, and an incremental UTF-8 state machine holds back the bytes of an
unfinished character.  It runs byte by byte only over tokens that do not consist of whole characters.

Scale: one narrow pass over documents, no shuffle; tables per Python worker are bounded (vocabulary, memo of
pieces in number and length, states), and so is the batch of texts.

Defined results: a null or empty text has no ids and decodes to nothing; rows with equal ids are encoded each; an
empty table gives none.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelmill.llm.common import slices
from pixelmill.llm.pieces import Growing, PieceMemo

STATES = 250_000
MEMORY = 400_000
PAIRS = 400_000
END = 256
BATCH = 128
CHUNK = 8192
#: Pieces of more bytes are read one byte after the other, shorter ones side by side.
ALONE = 512
DOUBLE = re.compile(r"\s |\A ").search
SPACE = re.compile(r"(?<=\S) ").split


class Merges:
    """The vocabulary, and whether two neighbouring tokens stay apart."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = {n: b for b, n in ranks.items()}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.apart: dict[tuple[int, int], bool] = {}
        self.spines: dict[tuple[int, bool], list[int]] = {}
        for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
            if len(token) > 1:
                self._halves(token, rank)

    def _halves(self, token: bytes, rank: int) -> None:
        """The two tokens of which the token is merged last."""
        for k in range(1, len(token)):
            a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
            if a is not None and b is not None and a < rank and b < rank and self._stay(a, b, rank):
                self.left[rank], self.right[rank] = a, b
                return

    def _spine(self, token: int, right: bool) -> list[int]:
        """The tokens that stand at one edge of a token as it is merged, from its byte to itself."""
        found = self.spines.get((token, right))
        if found is None:
            half = (self.right if right else self.left).get(token)
            found = self.spines[token, right] = [*([] if half is None else self._spine(half, right)), token]
        return found

    def _stay(self, a: int, b: int, below: float = float("inf")) -> bool:
        """Whether no merge of a rank under ``below`` crosses the border of a and b.

        The tokens at the border grow along the spines in the order of their ranks; a crossing merge comes
        first if its rank is under that of the next growth to its left and not over that to its right.
        """
        xs, ys = self._spine(a, True), self._spine(b, False)
        i = j = 0
        while True:
            grow_x = xs[i + 1] if i + 1 < len(xs) else below
            grow_y = ys[j + 1] if j + 1 < len(ys) else below
            merge = self.ranks.get(self.bytes[xs[i]] + self.bytes[ys[j]])
            if merge is not None and merge < grow_x and (merge <= grow_y if j + 1 < len(ys) else merge < below):
                return False
            if i + 1 == len(xs) and j + 1 == len(ys):
                return True
            if grow_x <= grow_y and i + 1 < len(xs):
                i += 1
            else:
                j += 1

    def stay(self, a: int, b: int) -> bool:
        found = self.apart.get((a, b))
        if found is None:
            if len(self.apart) > PAIRS:
                self.apart.clear()
            found = self.apart[a, b] = self._stay(a, b)
        return found


class Transducer:
    """Encodes pieces of text.  States and moves are numbers; moves are found by state and byte in a hash table
    of arrays, so that many pieces advance together, one byte at a time.  The byte ``END`` flushes a state."""

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        self.child: dict[int, int] = {}
        self.token, self.leaf = [-1], [True]
        for token, rank in ranks.items():
            node = 0
            for c in token:
                self.leaf[node] = False
                after = self.child.get(node << 8 | c)
                if after is None:
                    after = self.child[node << 8 | c] = len(self.token)
                    self.token.append(-1)
                    self.leaf.append(True)
                node = after
            self.token[node] = rank
        self.forget()

    def forget(self) -> None:
        start = ((0, -1, ()),)
        self.states, self.numbers = [start], {start: 0}
        self.n_moves, self.out, self.one = 0, Growing(np.uint32), {}
        self.keys, self.moves = np.full(1 << 16, -1, np.int64), np.zeros(1 << 16, np.int32)
        self.target, self.out_at = np.zeros(1 << 15, np.int32), np.zeros((1 << 15) + 1, np.int64)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, or the free slot where it would go."""
        mask = len(self.keys) - 1
        slot = (keys * 0x9E3779B1 >> 7) & mask
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & mask
            open_ = open_[(self.keys[slot[open_]] != keys[open_]) & (self.keys[slot[open_]] != -1)]
        return slot

    def _put(self, keys: np.ndarray, moves: np.ndarray) -> None:
        """Enter new keys: of those that want one free slot the first gets it, the others look on."""
        while len(keys):
            slot = self._slots(keys)
            first = np.unique(slot, return_index=True)[1]
            self.keys[slot[first]], self.moves[slot[first]] = keys[first], moves[first]
            keys, moves = np.delete(keys, first), np.delete(moves, first)

    def _add(self, keys: list[int]) -> None:
        """Determinise new moves."""
        made = [self._make(key) for key in keys]
        before, self.n_moves = self.n_moves, self.n_moves + len(keys)
        if 2 * self.n_moves > len(self.keys):
            old, values = self.keys, self.moves
            size = 1 << (4 * self.n_moves).bit_length()
            self.keys, self.moves = np.full(size, -1, np.int64), np.zeros(size, np.int32)
            self._put(old[old >= 0], values[old >= 0])
            self.target = np.resize(self.target, size // 2)
            self.out_at = np.resize(self.out_at, size // 2 + 1)
        self._put(np.array(keys), np.arange(before, self.n_moves, dtype=np.int32))
        self.target[before : self.n_moves] = [target for target, _ in made]
        self.out_at[before + 1 : self.n_moves + 1] = self.out.n + np.cumsum([len(x) for _, x in made])
        self.out.extend(np.array([t for _, x in made for t in x], np.uint32))

    def _make(self, key: int) -> tuple[int, tuple[int, ...]]:
        """Target and emission of one move."""
        state, byte = self.states[key >> 9], key & 511
        if byte == END:
            return 0, state[-1][2]
        grown, end = [], None
        for node, before, waiting in state:
            node = self.child.get(node << 8 | byte)
            if node is None:
                continue
            if not self.leaf[node]:
                grown.append((node, before, waiting))
            token = self.token[node]
            if token >= 0 and end is None and (before < 0 or self.merges.stay(before, token)):
                end = (0, token, (*waiting, token))
        if end is None:
            raise ValueError("the vocabulary lacks a byte or is not one of merges")
        grown.append(end)
        first = grown[0][2]
        n = 0
        while n < len(first) and all(len(x[2]) > n and x[2][n] == first[n] for x in grown):
            n += 1
        after = tuple((node, before, waiting[n:]) for node, before, waiting in grown)
        number = self.numbers.get(after)
        if number is None:
            number = self.numbers[after] = len(self.states)
            self.states.append(after)
        return number, first[:n]

    def step(self, states: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The moves of states on bytes, made where they are new."""
        keys = states.astype(np.int64) << 9 | byte
        slot = self._slots(keys)
        missing = self.keys[slot] != keys
        if missing.any():
            self._add(np.unique(keys[missing]).tolist())
            slot = self._slots(keys)
        return self.moves[slot]

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all pieces end to end, and how many each has."""
        if len(self.states) > STATES:
            self.forget()
        if max(map(len, pieces), default=0) <= ALONE:
            return self._side_by_side(pieces)
        ids, n = self._side_by_side([x if len(x) <= ALONE else b"" for x in pieces])
        parts = np.split(ids, np.cumsum(n)[:-1])
        for k, x in enumerate(pieces):
            if len(x) > ALONE:
                parts[k] = self._alone(x)
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def _alone(self, piece: bytes) -> np.ndarray:
        """ids of one piece, byte by byte."""
        state, out = 0, []
        for byte in itertools.chain(piece, (END,)):
            key = state << 9 | byte
            move = self.one.get(key)
            if move is None:
                if len(self.one) > STATES:
                    self.one.clear()
                move = self.one[key] = self._make(key)
            state, emitted = move
            out += emitted
        return np.array(out, np.uint32)

    def _side_by_side(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in pieces], np.int64)
        order = np.argsort(-sizes, kind="stable")
        starts = (np.cumsum(sizes) - sizes)[order]
        data = np.frombuffer(b"".join(pieces), np.uint8)
        states, done = np.zeros(len(pieces), np.int32), sizes[order]
        who, moved = [], []
        for k in range(int(sizes.max(initial=0)) + 1):
            n = int(np.searchsorted(-done, -k, side="right"))  # pieces of at least k bytes; those of k end here
            byte = np.full(n, END, np.int64)
            going = int(np.searchsorted(-done, -k, side="left"))
            byte[:going] = data[starts[:going] + k]
            move = self.step(states[:n], byte)
            states[:n] = self.target[move]
            who.append(order[:n])
            moved.append(move)
        who, moved = np.concatenate(who), np.concatenate(moved)
        by_piece = np.argsort(who, kind="stable")
        who, moved = who[by_piece], moved[by_piece]
        n = self.out_at[moved + 1] - self.out_at[moved]
        ends = np.cumsum(n)
        ids = self.out.view()[np.repeat(self.out_at[moved] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)]
        return ids, np.bincount(who, weights=n, minlength=len(pieces)).astype(np.int64)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder(PieceMemo):
    """ids of whole texts: a pattern splits them into pieces, the transducer encodes each."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.split = regex.compile(pattern).findall
        self.transducer = Transducer(read_ranks(path))
        super().__init__(MEMORY, np.uint32)

    def resolve(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.split(x[0] if type(x) is tuple else " " + x) for x in pieces]
        whole = self.transducer.merges.ranks
        flat = [x.encode() for found in parts for x in found]
        # a piece that is a token is that token
        ids, n = self.transducer.encode([x for x in flat if x not in whole])
        known = np.array([whole.get(x, -1) for x in flat], np.int64)
        sizes = np.ones(len(flat), np.int64)
        sizes[known < 0] = n
        out = np.empty(int(sizes.sum()), np.uint32)
        own = np.repeat(known, sizes)
        out[own >= 0], out[own < 0] = own[own >= 0], ids
        ends = np.cumsum([0, *map(len, parts)])
        totals = np.concatenate([[0], np.cumsum(sizes)])[ends]
        return out, np.diff(totals)

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text.

        A space after a character that is no white space always starts a piece, so a text falls apart there
        (its first part, which has no space before it, is told from the others by a tuple).
        """
        split = []
        for x in texts:
            first, *rest = SPACE(x) if DOUBLE(x) else x.split(" ")
            split.append([(first,), *rest])
        return self.lookup(split)


def _utf8_moves() -> list[dict[int, int]]:
    """Well-formed UTF-8 as moves by byte: state 0 is between characters; a missing move is an error.

    States 1 to 3 wait for that many plain continuation bytes; 4 to 7 wait for the narrower second byte after
    E0, ED, F0 and F4.
    """
    tail = range(0x80, 0xC0)
    start = {b: 0 for b in range(0x80)} | {b: 1 for b in range(0xC2, 0xE0)} | {b: 2 for b in range(0xE1, 0xF0)} | {b: 3 for b in range(0xF1, 0xF4)}
    start |= {0xE0: 4, 0xED: 5, 0xF0: 6, 0xF4: 7}
    narrow = [({b: 1 for b in range(0xA0, 0xC0)}), ({b: 1 for b in range(0x80, 0xA0)}), ({b: 2 for b in range(0x90, 0xC0)}), ({b: 2 for b in range(0x80, 0x90)})]
    return [start, {b: 0 for b in tail}, {b: 1 for b in tail}, {b: 2 for b in tail}, *narrow]


class Decoder:
    """Streaming: ``feed`` gives the whole characters known so far, ``end`` what is left.

    A byte that cannot continue a character is passed on as it is, as are unfinished bytes at the end, so the
    bytes that come out are those of the tokens.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.table = [b""] * (max(ranks.values(), default=0) + 1)
        for token, n in ranks.items():
            self.table[n] = token
        self.moves = _utf8_moves()
        self.whole = np.array([self._run(0, x) == (0, 0) for x in self.table], bool)
        self.reset()

    def _run(self, state: int, data: bytes) -> tuple[int, int]:
        """State after the bytes, and how many bytes of an unfinished character are at the end (-1: an error)."""
        open_ = 0
        for b in data:
            after = self.moves[state].get(b)
            if after is None:
                return 0, -1
            state, open_ = after, open_ + 1 if after else 0
        return state, open_

    def reset(self) -> None:
        self.state, self.held = 0, b""

    def feed(self, ids: np.ndarray) -> bytes:
        data = self.held + b"".join(map(self.table.__getitem__, ids.tolist()))
        # only the bytes after the last token of whole characters can be unfinished
        odd = np.flatnonzero(self.whole[ids]) if len(ids) else []
        tail = ids[odd[-1] + 1 :] if len(odd) else ids
        rest = b"".join(map(self.table.__getitem__, tail.tolist()))
        if not len(odd):
            rest = self.held + rest
        keep = 0
        for back in range(1, min(4, len(rest) + 1)):  # an unfinished character has three bytes at most
            state, open_ = self._run(0, rest[-back:])
            if state and open_ == back:
                keep, self.state = back, state
        self.held = data[len(data) - keep :]
        return data[: len(data) - keep]

    def whole_text(self, ids: np.ndarray, chunk: int) -> bytes:
        self.reset()
        return b"".join([self.feed(ids[k : k + chunk]) for k in range(0, len(ids), chunk)] + [self.end()])

    def end(self) -> bytes:
        held, self.held, self.state = self.held, b"", 0
        return held


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One per Python worker."""
    return Encoder(path, pattern)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    """One per Python worker; a task that decodes needs no transducer."""
    return Decoder(read_ranks(path))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def _encoded(enc: Encoder, part: pa.RecordBatch) -> list[np.ndarray]:
    return [x.astype("<u4") for x in enc.texts([x or "" for x in part.column("text").to_pylist()])]


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids): ids as little-endian unsigned 32-bit numbers."""

    def run(batches):
        enc = encoder(path, pattern)
        for part in slices(batches, "text", BATCH):
            ids = _encoded(enc, part)
            yield pa.record_batch([part.column("id"), pa.array(map(len, ids), pa.int64()), pa.array([x.tobytes() for x in ids], pa.binary())], ["id", "n_tokens", "ids"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "id long, n_tokens long, ids binary").withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, path: str, id_col: str = "doc_id", chunk: int = CHUNK) -> DataFrame:
    """Encoded rows with ``decoded``, the bytes of their tokens."""

    def run(batches):
        dec = decoder(path)
        for part in slices(batches, "ids", BATCH):
            out = [dec.whole_text(np.frombuffer(x, "<u4"), chunk) for x in part.column("ids").to_pylist()]
            yield part.append_column("decoded", pa.array(out, pa.binary()))

    rows = encoded.select(F.col(id_col).alias("id"), "n_tokens", "ids")
    return rows.mapInArrow(run, "id long, n_tokens long, ids binary, decoded binary").withColumnRenamed("id", id_col)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes and decodes in one task: (id, n_tokens, ids_sha256, decoded_sha256)."""
    digest = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches):
        enc, dec = encoder(path, pattern), decoder(path)
        for part in slices(batches, "text", BATCH):
            ids = _encoded(enc, part)
            yield pa.record_batch(
                [part.column("id"), pa.array(map(len, ids), pa.int64()), pa.array([digest(x.tobytes()) for x in ids]), pa.array([digest(dec.whole_text(x, CHUNK)) for x in ids])],
                ["id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _rows(docs, id_col, text_col).mapInArrow(run, schema).withColumnRenamed("id", id_col)
