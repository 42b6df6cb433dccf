"""Mixture-controlled packing of documents into token sequences.

Documents are tokenised once.  Every source has a queue: its documents in the order of the input, each at a known
place, the number of the source's tokens before it.  A schedule says by which total number of tokens a source is to
have served that place: with target shares, a source that runs dry leaves its share to the others.  The total is cut
into buckets of about equal tokens, and a document goes to the bucket in which its first token is due.  What a bucket
serves a source too little or too much is carried to the next one: the boundary is where the schedule stands, not
where the bucket before it stopped.

Inside a bucket, deficit round robin fills one window (a sequence of ``window`` tokens) after the other: in each
window every source is credited its share of the bucket and the sources take turns, each serving what it is owed,
``least`` tokens or more at a time; deficits are carried over from window to window.  What is left at a bucket's end is
cut into sequences whose lengths are powers of two, so there is no padding at all.

Target: each source's share of all tokens (or the shares given; sources without one come after all that have one).

Scale: ids are checkpointed once (2 bytes each where they fit), so texts are tokenised once, and shuffled once by
bucket.  Buckets are bounded by tokens (and one document), whatever the ids and sources: a source that holds a third of
all rows is spread over all buckets, as are rows of equal or no id.  Queue places come from running totals inside a
task and sums over (task, source), which Spark aggregates and which are broadcast while they measure
``BROADCAST_BYTES`` at most; token ids never reach the driver.

Defined results: a null text counts as empty and yields the end token alone; a null source is a source; rows
with equal ids are documents of their own; an empty table gives no pieces.  Other columns are ignored, whatever their
names.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelmill.llm.common import cut, slices
from pixelmill.llm.pieces import PieceMemo

WINDOW = 2048
#: Most tokens of a bucket, but for its last document's.
BUCKET_TOKENS = 4_000_000
#: Bytes of the table of queue places, one row for each task and source, up to which it is broadcast.
BROADCAST_BYTES = 32 << 20
#: Distinct words whose ids a worker remembers; it starts afresh beyond.
MEMORY = 500_000


class WordEncoder(PieceMemo):
    """Ids of texts by a word-end BPE tokenizer file, each distinct word tokenised once.

    The tokenizer's normaliser works on characters (composition, lower case) and its splitter drops white
    space, so a text's ids are those of its words one after the other.  Words end at ASCII white space; other
    white space stays inside and is dropped by the split.  The merges run in tiktoken: the word end is written
    as a zero byte, so the vocabulary's word-end tokens become byte strings, and an id is its own rank.  Words
    with a zero character go through the tokenizers library instead.
    """

    def __init__(self, path: str):
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        spec = json.load(open(path))
        pattern = next(x["pattern"]["Regex"] for x in spec["pre_tokenizer"]["pretokenizers"] if "pattern" in x)
        self.split = regex.compile(rf"{pattern}|\n").findall
        shown = _shown_bytes()
        suffix = spec["model"]["end_of_word_suffix"]
        special = {x["content"] for x in spec["added_tokens"]}
        ranks = {}
        for token, rank in spec["model"]["vocab"].items():
            if token not in special:
                raw = bytes(shown[c] for c in token.removesuffix(suffix))
                ranks[raw + b"\0" if token.endswith(suffix) else raw] = rank
        self.bpe = tiktoken.Encoding("words", pat_str=r"[^\x00]*\x00", mergeable_ranks=ranks, special_tokens={})
        self.gap = ranks[b"\n\0"]
        super().__init__(MEMORY, np.uint16 if max(ranks.values()) < 1 << 16 else np.uint32)

    def resolve(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, none of which has ASCII white space, and how many each has."""
        text = unicodedata.normalize("NFC", b"\n".join(words).decode())
        if "\0" in text:
            ids = [np.array(e.ids, np.uint32) for e in self.tok.encode_batch([w.decode() for w in words], add_special_tokens=False)]
            return np.concatenate(ids), np.array([len(x) for x in ids])
        # lower case by character, as the normaliser does: no final sigma
        pieces = self.split(text.replace("\u03a3", "\u03c3").lower())
        ids = np.array(self.bpe.encode_ordinary("\0".join(pieces) + "\0"), np.uint32)
        gaps = np.flatnonzero(ids == self.gap)
        return np.delete(ids, gaps), np.diff(np.r_[-1, gaps, len(ids)]) - 1

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """ids of each text."""
        return self.lookup([x.encode().split() for x in texts])


def _shown_bytes() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable Latin-1 shows itself, the rest follow from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def keep(ids: np.ndarray) -> bytes:
    """ids as little-endian numbers of two bytes each, or of four if one does not fit."""
    return np.asarray(ids).astype("<u2" if not len(ids) or int(ids.max()) < 1 << 16 else "<u4").tobytes()


def read(kept: bytes, n: int) -> np.ndarray:
    return np.frombuffer(kept, "<u2" if len(kept) == 2 * n else "<u4")


def tokenise(docs: DataFrame, encoder: Callable[[], object], id_col: str, text_col: str, source_col: str, end: int) -> DataFrame:
    """(task, source, before, id, n, ids): ids with the end token last; before: tokens of the source earlier in the task."""

    def run(batches):
        enc, task, totals = encoder(), TaskContext.get().partitionId(), {}
        for part in slices(batches, "text"):
            found = enc.texts([x or "" for x in part.column("text").to_pylist()])
            ids = [keep(np.append(x, end)) for x in found]
            sizes, before = [len(x) + 1 for x in found], []
            for s, n in zip(part.column("source").to_pylist(), sizes):
                before.append(totals.get(s, 0))
                totals[s] = before[-1] + n
            yield pa.record_batch(
                [pa.array([task] * len(ids), pa.int64()), part.column("source"), pa.array(before, pa.int64()), part.column("id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                ["task", "source", "before", "id", "n", "ids"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(source_col).cast("string").alias("source"))
    return rows.mapInArrow(run, "task long, source string, before long, id long, n long, ids binary")


def powers(n: int) -> list[int]:
    """n as a falling sum of powers of two."""
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def fill(sizes: dict, shares: dict, credit: dict, window: int, least: int) -> list[list[tuple[object, int]]]:
    """Deficit round robin over queues that hold ``sizes`` tokens: for each sequence, (source, tokens) in turn.

    credit: what each source is owed at the start; it is kept up to date.  A source whose turn it is serves what it is
    owed if that makes a piece of ``least`` tokens (or fills the window, or empties the queue); if nobody is owed so
    much, the source that is owed most gets ahead by one piece.
    """
    left = {s: n for s, n in sizes.items() if n}
    out, rest, ring, turn = [], sum(left.values()), list(credit), 0
    lengths = [window] * (rest // window) + powers(rest % window)
    for length in lengths:
        room, sequence, passed = length, [], 0
        for s in ring:
            credit[s] += shares.get(s, 0.0) * length
        while room:
            ahead = passed >= len(ring)
            s = max(left, key=credit.__getitem__) if ahead else ring[turn % len(ring)]
            turn, passed = turn + (not ahead), passed + 1
            have = left.get(s, 0)
            take = min(have, room, max(least, int(credit[s])) if ahead else int(credit[s]))
            if have and (ahead or take >= min(least, room, have)):
                sequence.append((s, take))
                credit[s] -= take
                left[s] -= take
                room, passed = room - take, 0
                if not left[s]:
                    del left[s]
        out.append(sequence)
    return out


def schedule(totals: dict, targets: dict) -> dict[object, list[tuple[float, float, float]]]:
    """For each target source, its phases (tokens of the source, tokens of all, tokens of all per one of the source).

    In a phase the sources that still have tokens are served in the proportion of their targets; it ends when one of
    them runs dry.
    """
    left = {s: totals[s] for s, w in targets.items() if w > 0 and totals.get(s)}
    served, out, at = dict.fromkeys(left, 0.0), {s: [] for s in left}, 0.0
    while left:
        weight = sum(targets[s] for s in left)
        long = min(n * weight / targets[s] for s, n in left.items())
        for s in list(left):
            share = targets[s] / weight
            out[s].append((served[s], at, 1 / share))
            served[s] += long * share
            left[s] -= long * share
            if left[s] <= 1e-9 * totals[s]:
                del left[s]
        at += long
    return out


def _due(place: Column, totals: dict | None, targets: dict | None) -> Column:
    """When a place of a source's queue is due, in tokens of all sources; ``share`` is the source's share of all."""
    own = place / F.col("share")
    if targets is None:
        return own
    phases = schedule(totals, targets)
    served = sum(totals[s] for s in phases)
    rest = max(1, sum(totals.values()) - served)
    out = served + own * (rest / max(1, sum(totals.values())))  # sources without a target, in their own mixture
    for s, own_phases in phases.items():
        due = None
        for first, at, rate in own_phases:
            here = F.lit(at) + (place - F.lit(first)) * F.lit(rate)
            due = here if due is None else F.when(place >= F.lit(first), here).otherwise(due)
        out = F.when(F.col("source").eqNullSafe(F.lit(s)), due).otherwise(out)
    return out


def _bytes(small: DataFrame, name: str) -> int:
    """About the bytes of a table of one string and a few numbers a row."""
    return small.agg(F.sum(F.coalesce(F.octet_length(name), F.lit(0)) + 64)).first()[0] or 0


def pack(
    docs: DataFrame,
    encoder: Callable[[], object],
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    end: int = 1,
    window: int = WINDOW,
    least: int = 128,
    docs_per_bucket: int = 4000,
    targets: dict[str | None, float] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per piece: id, start and length in its document, crc32 of its ids, sequence and offset there, source, ids.

    docs_per_bucket: a bucket holds the tokens of so many average documents, ``BUCKET_TOKENS`` at most.
    targets: wanted shares by source; without them each source's share of all tokens.
    broadcast_bytes: the table of queue places is broadcast up to this measured size, joined by shuffles beyond.
    """
    tokens = cut(tokenise(docs, encoder, id_col, text_col, source_col, end))
    spans = tokens.groupBy("task", "source").agg(F.sum("n").alias("own"), F.count("*").alias("docs"))
    totals = cut(spans.groupBy("source").agg(F.sum("own").alias("all"), F.sum("docs").alias("docs")))
    size, n_docs = totals.agg(F.sum("all"), F.sum("docs")).first()
    if not size:
        size, n_docs = 1, 1
    bucket_tokens = max(window, min(BUCKET_TOKENS, docs_per_bucket * size // n_docs))
    known = None
    if targets is not None:  # the sources named, and all others as one
        wanted = F.array(*[F.lit(s) for s in targets if s is not None]) if any(s is not None for s in targets) else F.array().cast("array<string>")
        named = F.coalesce(F.array_contains(wanted, F.col("source")), F.lit(None in targets))
        known = {r["source"]: r["all"] for r in totals.where(named).collect()}
        known["\0others"] = size - sum(known.values())
    to_here = Window.partitionBy("source").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = spans.select(F.col("task").alias("at"), F.col("source").alias("name"), F.coalesce(F.sum("own").over(to_here), F.lit(0)).alias("first"))
    share = totals.select(F.col("source").alias("s"), (F.col("all") / F.lit(size)).alias("share"))
    queues = cut(first.join(share, F.col("name").eqNullSafe(F.col("s"))).drop("s"))
    if _bytes(queues, "name") <= broadcast_bytes:  # beyond, Spark chooses and the ids may be shuffled twice
        queues = F.broadcast(queues)
    placed = tokens.join(queues, (F.col("task") == F.col("at")) & F.col("source").eqNullSafe(F.col("name"))).withColumn("place", F.col("first") + F.col("before"))
    bucket = F.floor(_due(F.col("place"), known, targets) / F.lit(bucket_tokens)).cast("long").alias("bucket")

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        return pack_bucket(int(key[0]), rows, window, least)

    out = placed.select(bucket, "source", "place", "id", "n", "ids").groupBy("bucket").applyInPandas(
        lambda key, rows: run(key, rows),
        "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string, ids binary",
    )
    return out.withColumnRenamed("id", id_col)


def pack_bucket(bucket: int, rows: pd.DataFrame, window: int, least: int) -> pd.DataFrame:
    """The pieces of one bucket."""
    name = lambda s: None if pd.isna(s) else s
    rows = rows.sort_values("place", kind="stable")
    ids = [read(x, n) for x, n in zip(rows["ids"], rows["n"])]
    doc_ids, queues = rows["id"].tolist(), {}
    for k, s in enumerate(rows["source"]):
        queues.setdefault(name(s), []).append(k)
    queues = dict(sorted(queues.items(), key=lambda x: (x[0] is not None, x[0] or "")))
    sizes = {s: sum(len(ids[k]) for k in queue) for s, queue in queues.items()}
    size = sum(sizes.values())
    at = dict.fromkeys(queues, (0, 0))  # place in the queue, tokens of that document already placed
    out = []
    for q, sequence in enumerate(fill(sizes, {s: n / size for s, n in sizes.items()}, dict.fromkeys(sizes, 0.0), window, least)):
        offset = 0
        for s, take in sequence:
            place, done = at[s]
            while take:
                k = queues[s][place]
                n = min(take, len(ids[k]) - done)
                data = ids[k][done : done + n].astype("<u4").tobytes()
                out.append((doc_ids[k], done, n, zlib.crc32(data), len(ids[k]), (bucket << 32) + q, offset, s, data))
                offset, take, done = offset + n, take - n, done + n
                if done == len(ids[k]):
                    place, done = place + 1, 0
            at[s] = (place, done)
    return pd.DataFrame(out, columns=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source", "ids"]).astype({"id": "Int64"})


def mixture(pieces: DataFrame) -> DataFrame:
    """(source, tokens, share): what was packed; a target that its source could not fill shows here."""
    total = pieces.agg(F.sum("length")).first()[0] or 1
    own = pieces.groupBy("source").agg(F.sum("length").alias("tokens"))
    return own.withColumn("share", F.col("tokens") / F.lit(total))
