"""Exact substring deduplication by FM-indexes over shards.

A window of ``window`` words is repeated if its word sequence also starts anywhere else.  Every window
belongs to the run of neighbouring windows that share their minimizer (the occurrence of the smallest hash of
``GRAM`` words, leftmost first).  Equal windows have equal minimizers, so windows are sharded by minimizer
and compared within their shard alone; each shard's run segments are indexed by a compressed FM-index, and the
segments of the documents are streamed through it by backward search.

1. One pass over the documents yields a row per run: place, minimizer, content hash (about one per 15 words).
2. Minimizers that occur once drop out; runs of equal content become one segment, heavy if it has several places.
3. The texts of the remaining distinct segments are fetched by one join with the documents, indexed and streamed.
4. Repeated stretches go back to all runs of that content and from there to their texts.

A text is known by two 64-bit hashes, whatever its id.  Texts that occur several times are counted by these hashes
alone; they lose all words (of a window or more), and stand for one text in the search for others.

Hot keys: copies are one text, and equal segments one segment, whatever their number.  Joins on minimizers, segments
and texts read tables kept before on both sides, so Spark can split a hot key.  A minimizer with more than ``HOT``
different segments (a passage in a large share of all documents, each time in other surroundings) is cut into single
windows, equal windows are counted before they are sharded by their own hash, so no shard holds what grows with the
passage.

Defined results: a null or empty text has no words and loses none; texts shorter than a window lose none;
rows of equal text are occurrences of each other, with any ids or none.  Hashes of text, of minimizer and content have
64 bits each and count in pairs; words in a shard are compared as they are.  Other columns are ignored or carried
along, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelmill.llm.common import shuffle_width, slices, store
from pixelmill.llm.fm_index import FMIndex

WINDOW = 35
GRAM = 8
HOT = 5000
SHARD_WORDS = 400_000
_MIX, _BASE = np.uint64(0x9E3779B97F4A7C15), 0xD6E8FEB86659FD93


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return x ^ (x >> np.uint64(29))


def runs_of(hashes: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """(start, windows, minimizer, content hash) of each run of a text's windows."""
    n = len(hashes)
    if n < window:
        return (np.zeros(0, np.int64),) * 4
    h = np.zeros(n - gram + 1, np.uint64)
    for k in range(gram):
        h = h * np.uint64(_BASE) + hashes[k : n - gram + 1 + k]
    h = _mix(h)
    span, wide = 1, window - gram + 1
    best = np.arange(len(h))
    while 2 * span <= wide:
        a, b = best[:-span], best[span:]
        best = np.where(h[b] < h[a], b, a)
        span *= 2
    if span < wide:
        a, b = best[: len(best) - (wide - span)], best[wide - span :]
        best = np.where(h[b] < h[a], b, a)
    cuts = np.flatnonzero(np.r_[True, best[1:] != best[:-1], True])
    start, count = cuts[:-1], np.diff(cuts)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * _powers(_BASE, n), dtype=np.uint64)])
    content = (sums[start + count + window - 1] - sums[start]) * _powers(pow(_BASE, -1, 1 << 64), n)[start]
    content = _mix(content + (count.astype(np.uint64) << np.uint64(40)))
    return start, count, h[best[start]].view(np.int64), content.view(np.int64)


def _keyed(docs: DataFrame, text_col: str, others: list[str]) -> DataFrame:
    """(h1, h2, others, text): the hashes of a text, the other columns as one struct."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    carried = F.struct(*[F.col(f"`{c}`") for c in others]) if others else F.struct(F.lit(0).alias("_"))
    return docs.select(F.xxhash64(F.lit(1), text).alias("h1"), F.xxhash64(F.lit(2), text).alias("h2"), carried.alias("others"), F.col(text_col).alias("text"))


class _Seen(set):
    """Whether a text came before in this task, as far as is remembered: then it need not be read again."""

    def again(self, h1: int, h2: int) -> bool:
        if len(self) > 500_000:
            self.clear()
        n = len(self)
        self.add((h1, h2))
        return len(self) == n


def _runs_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = [np.concatenate(x) for x in zip(*rows)]
    return pa.record_batch([pa.array(x.astype(np.int64)) for x in columns], ["h1", "h2", "start", "n", "key", "seg"])


def find_runs(keyed: DataFrame, window: int) -> DataFrame:
    """(h1, h2, start, n, key, seg) of the runs of each text; of copies in one task, of one mostly."""

    def run(batches):
        memo, seen = _Hashes(), _Seen()
        for part in slices(batches, "text"):
            if len(memo) > 500_000:
                memo.clear()
            out = []
            for h1, h2, text in zip(*(part.column(c).to_pylist() for c in ("h1", "h2", "text"))):
                words = (text or "").encode().split()
                if len(words) < window or seen.again(h1, h2):
                    continue
                start, count, key, seg = runs_of(np.fromiter(map(memo.__getitem__, words), np.uint64, len(words)), window, GRAM)
                out.append((np.full(len(start), h1), np.full(len(start), h2), start, count, key, seg))
            if out:
                yield _runs_batch(out)

    return keyed.select("h1", "h2", "text").mapInArrow(run, "h1 long, h2 long, start long, n long, key long, seg long")


def _segments(keyed: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Texts of segments: rows of (key, seg, off, weight, hot, words); a hot segment gives each of its windows."""
    lists = store(wanted.groupBy("h1", "h2").agg(F.collect_list(F.struct("key", "seg", "start", "n", "weight", "hot")).alias("list")))
    names = ["key", "seg", "off", "weight", "hot", "words"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names)

    def run(batches):
        seen = _Seen()
        for part in slices(batches, "text", 64):
            out = []
            for h1, h2, text, items in zip(*(part.column(c).to_pylist() for c in ("h1", "h2", "text", "list"))):
                if seen.again(h1, h2):
                    continue
                words = (text or "").encode().split()
                for x in items:
                    s, n = x["start"], x["n"]
                    if x["hot"]:
                        out += [(x["key"], x["seg"], k, x["weight"], True, b" ".join(words[s + k : s + k + window])) for k in range(n)]
                    else:
                        out.append((x["key"], x["seg"], 0, x["weight"], False, b" ".join(words[s : s + n + window - 1])))
                if len(out) > 10_000:
                    yield batch(out)
                    out = []
            if out:
                yield batch(out)

    joined = keyed.select("h1", "h2", "text").join(lists, ["h1", "h2"])
    # copies of a text that come in several tasks give its segments again: one each is kept below
    return joined.mapInArrow(run, "key long, seg long, off long, weight long, hot boolean, words binary")


def _search(units: DataFrame, window: int, shards: int) -> DataFrame:
    """(key, seg, a, b): repeated stretches of segments, in words from the segment's start."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates(["key", "seg"])
        texts = [x.split() for x in group["words"]]
        sizes = np.array([len(x) for x in texts])
        codes = pd.factorize(np.array([w for x in texts for w in x], object))[0].astype(np.int64) + 1
        sequences = np.split(codes, np.cumsum(sizes)[:-1])
        index = FMIndex(sequences, group["weight"].to_numpy() >= 2, int(sizes.max()) + 1)
        who, a, b = index.repeats(sequences, window)
        return pd.DataFrame({"key": group["key"].to_numpy()[who], "seg": group["seg"].to_numpy()[who], "a": a, "b": b})

    shard = F.pmod(F.xxhash64("key"), F.lit(shards))
    return units.groupBy(shard.alias("shard")).applyInPandas(lambda g: run(g), "key long, seg long, a long, b long")


def repeated(keyed: DataFrame, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """(h1, h2, spans, whole): the repeated stretches [a, b) in words of each text that has any, and whether it has copies."""
    width = shuffle_width(keyed.sparkSession)
    copies = keyed.groupBy("h1", "h2").agg(F.count("*").alias("copies")).where("copies > 1").select("h1", "h2", F.array().cast("array<struct<a:long,b:long>>").alias("spans"), F.lit(True).alias("whole"))
    every = store(find_runs(keyed, window))
    # most minimizers occur once: their runs go before anything else is made of them
    often = store(every.groupBy("key").agg(F.count("*").alias("total")).where("total > 1").select("key"))
    # one row a place; grouped without the minimizer, so that the join before may split a hot one
    place = every.join(often, "key", "left_semi").groupBy("h1", "h2", "start")
    runs = store(place.agg(*[F.first(c).alias(c) for c in ("n", "key", "seg")]))
    segs = store(runs.groupBy("key", "seg").agg(F.count("*").alias("weight"), F.min(F.struct("h1", "h2", "start", "n")).alias("at")).select("key", "seg", "weight", "at.*"))
    many = store(segs.groupBy("key").agg(F.count("*").alias("kinds")).where(F.col("kinds") > hot).select("key", F.lit(True).alias("hot")))
    is_hot = not many.isEmpty()
    wanted = segs.join(many, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False))) if is_hot else segs.withColumn("hot", F.lit(False))
    if is_hot:
        wanted = store(wanted)
    size = segs.agg(F.sum(F.col("n") + window)).first()[0] or 0
    shards = max(1, -(-size // SHARD_WORDS), min(4 * width, size // 20_000))

    units = _segments(keyed, wanted, window)
    if is_hot:  # read twice below
        units = store(units)
    found = _search(units.where(~F.col("hot")).select("key", "seg", "weight", "words"), window, shards)
    if is_hot:
        cut = units.where("hot").select("key", "seg", "off", "weight", "words", F.xxhash64("words").alias("w1"), F.xxhash64(F.lit(7), "words").alias("w2"))
        cut = store(cut.dropDuplicates(["key", "seg", "off"]))
        kinds = cut.groupBy("w1", "w2").agg(F.sum("weight").alias("weight"), F.first("words").alias("words"))
        again = _search(kinds.select(F.col("w1").alias("key"), F.col("w2").alias("seg"), "weight", "words"), window, max(shards, 4 * width))
        again = store(again.select(F.col("key").alias("w1"), F.col("seg").alias("w2")))
        found = found.unionByName(cut.select("w1", "w2", "key", "seg", "off").join(again, ["w1", "w2"]).select("key", "seg", F.col("off").alias("a"), (F.col("off") + window).alias("b")))
    spans = store(found.groupBy("key", "seg").agg(F.collect_list(F.struct("a", "b")).alias("spans")))  # one per window at most
    back = runs.select("h1", "h2", "start", "key", "seg").join(spans, ["key", "seg"])
    placed = F.transform("spans", lambda x: F.struct((x["a"] + F.col("start")).alias("a"), (x["b"] + F.col("start")).alias("b")))
    own = back.select("h1", "h2", placed.alias("spans"), F.lit(False).alias("whole")).unionByName(copies)
    return store(own.groupBy("h1", "h2").agg(F.flatten(F.collect_list("spans")).alias("spans"), F.max("whole").alias("whole")))


def _covered(n: int, spans, whole: bool | None, window: int) -> np.ndarray:
    """Which of a text's words are removed."""
    if n < window:
        return np.zeros(n, bool)
    if whole:
        return np.ones(n, bool)
    marks = np.zeros(n + 1, np.int64)
    if spans:
        np.add.at(marks, [x["a"] for x in spans], 1)
        np.add.at(marks, [x["b"] for x in spans], -1)
    return np.cumsum(marks)[:-1] > 0


def _removed(docs: DataFrame, text_col: str, others: list[str], window: int, hot: int, make, kind: T.DataType) -> DataFrame:
    """(others, n_words, n_removed, made): make(text, kept words or None if none went) of every document."""
    keyed = _keyed(docs, text_col, others)
    joined = keyed.join(repeated(keyed, window, hot), ["h1", "h2"], "left").select("others", "text", "spans", "whole")
    schema = T.StructType([joined.schema["others"], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("made", kind)])

    def run(batches):
        for part in slices(batches, "text"):
            out = []
            for text, spans, whole in zip(*(part.column(c).to_pylist() for c in ("text", "spans", "whole"))):
                words = (text or "").encode().split()
                gone = _covered(len(words), spans, whole, window)
                n = int(gone.sum())
                out.append((len(words), n, make(text, words if not n else [w for w, g in zip(words, gone.tolist()) if not g], n)))
            yield pa.record_batch([part.column("others"), *(pa.array(x, k) for x, k in zip(zip(*out), (pa.int64(), pa.int64(), pa.string())))], ["others", "n_words", "n_removed", "made"])

    return joined.mapInArrow(run, schema)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, hot: int = HOT, digest: bool = False) -> DataFrame:
    """Per document: n_words, n_removed, and the kept words joined by one space (or their SHA-256)."""

    def make(text: str | None, kept: list[bytes], n: int) -> str:
        joined = b" ".join(kept)
        return hashlib.sha256(joined).hexdigest() if digest else joined.decode()

    out = _removed(docs, text_col, [id_col], window, hot, make, T.StringType())
    return out.select(F.col(f"others.`{id_col}`").alias(id_col), "n_words", "n_removed", F.col("made").alias("kept_sha256" if digest else "kept_text"))


def without_repeats(docs: DataFrame, text_col: str = "text", size_col: str | None = None, window: int = WINDOW, hot: int = HOT) -> DataFrame:
    """The documents, one row each, all columns as they were but the text: if it lost words, its kept words joined by one space.

    size_col: a column of the text's length in characters, made anew for such texts.  Documents that lose all their
    words go; those that had none stay.
    """
    others = [c for c in docs.columns if c != text_col]
    out = _removed(docs, text_col, others, window, hot, lambda text, kept, n: b" ".join(kept).decode() if n else text, T.StringType())
    left = out.where("n_removed = 0 or n_removed < n_words")
    column = {c: F.col(f"others.`{c}`") for c in others} | {text_col: F.col("made")}
    if size_col in others:
        column[size_col] = F.when(F.col("n_removed") > 0, F.char_length("made").cast(docs.schema[size_col].dataType)).otherwise(column[size_col])
    return left.select(*[column[c].alias(c) for c in docs.columns])
