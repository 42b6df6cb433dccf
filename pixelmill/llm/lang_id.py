"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of bytes in both directions, labels every position, and a document's probabilities
are the mean of those of all its positions.  It is trained in numpy by backpropagation through time, in one of two ways.

``fit_all`` learns from every byte of every labelled row, once, in rounds that grow sixteenfold.  A row belongs to one
round and one task of it, by its hash; a task starts from the round before's model and takes its rows' windows in updates
of mixed texts, languages weighted alike; the round's model is the mean of its tasks', weighted by their bytes.
``calibrate`` reads every labelled row held out of that.

``fit`` learns from a bounded sample: at most ``SAMPLE`` rows a language and ``SAMPLE_ROWS`` in all, those of the lowest
hashes of id and text.  The spans of an update lie anywhere in their whole texts; each row gives ``SPANS`` of them, drawn
where the row is.  Prediction reads whole texts, cut into windows that run side by side; a window that ends with its text is as
long as what is left, so no network ever reads padding, in training as in prediction.

Scale: ``fit_all`` counts bytes by language in one pass, then every round reads the table and shuffles its own rows (all
texts once in all), in tasks of about ``TASK_BYTES``.  ``fit`` ranks hashes per language in one pass (the rank limit is
pushed before the shuffle, which carries no text) and fetches the sampled rows by a broadcast of at most ``SAMPLE_ROWS``
hashes.  One narrow pass predicts; the model has about 13,000 numbers and travels with the task.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is every text if no labelled
row can be learned from (an empty table among them).  Rows with a null id are predicted and never learned from; rows
equal in id, text and language are one row of the sample, and one row each for ``fit_all``.  ``predict`` puts its two columns in the place of any
columns of the same names; all others pass through, whatever their names.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelmill.llm.common import cut, give_back, slices

SAMPLE = 300
SAMPLE_ROWS = 20_000
SPANS = 24
SPAN = 128
HIDDEN = 8
BATCH = 2048
#: Bytes of the spans of one update after the other: short ones for the texts of a few words.
TRAIN_SPANS = (48, 12, 48, 6, 48, 24)
#: Bytes of the first round of ``fit_all`` (few bytes are read again until at least ``LEAST_BYTES`` were), of later tasks,
#: and of the windows that are mixed at a time.
FIRST_BYTES, GROWTH, LEAST_BYTES = 4 << 20, 16, 3 << 19
TASK_BYTES, POOL_BYTES = 16 << 20, 2 << 20
#: Windows of an update and pace of learning, in the first round and in later ones.
WIDTHS, RATES = (96, 256), (0.02, 0.004)
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@dataclass(frozen=True)
class Model:
    """emb: 2 x 256 x 3H inputs of bytes; rec: 2 x H x 3H; out: 2H x L; bias: L.  Gate order: update, reset, candidate."""

    langs: tuple[str, ...]
    emb: np.ndarray
    rec: np.ndarray
    out: np.ndarray
    bias: np.ndarray


def _forward(m: Model, x: np.ndarray, keep: bool = False, inside: np.ndarray | None = None):
    """States of both directions at every position (T, 2, B, H); keep: also what backpropagation needs.

    inside (T, B): where a window's own bytes are; behind them the backward state stays zero.
    """
    steps, width = x.shape
    h = np.zeros((2, width, HIDDEN), np.float32)
    states, cache = np.empty((steps, 2, width, HIDDEN), np.float32), []
    g = np.empty((2, width, 3 * HIDDEN), np.float32)
    for t in range(steps):
        np.take(m.emb[0], x[t], axis=0, out=g[0])
        np.take(m.emb[1], x[steps - 1 - t], axis=0, out=g[1])
        r = np.matmul(h, m.rec)
        gates = g[:, :, : 2 * HIDDEN] + r[:, :, : 2 * HIDDEN]
        gates *= 0.5
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        z, s, rc = gates[:, :, :HIDDEN], gates[:, :, HIDDEN:], r[:, :, 2 * HIDDEN :]
        c = s * rc
        c += g[:, :, 2 * HIDDEN :]
        np.tanh(c, out=c)
        if keep:
            cache.append((h, z, s, rc, c))
        h = h + z * (c - h)
        if inside is not None:
            h[1] *= inside[steps - 1 - t, :, None]
        states[t, 0] = h[0]
        states[steps - 1 - t, 1] = h[1]
    return (states, cache) if keep else states


def _positions(m: Model, states: np.ndarray) -> np.ndarray:
    """Probabilities at every position, T x B x L."""
    logits = states[:, 0] @ m.out[:HIDDEN] + states[:, 1] @ m.out[HIDDEN:] + m.bias
    logits -= logits.max(2, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(2, keepdims=True)
    return logits


def _by_byte(x: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Sums of the rows of d by their byte, 256 x 3H."""
    order = np.argsort(x, kind="stable")
    own = x[order]
    first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
    out = np.zeros((256, d.shape[1]), d.dtype)
    out[own[first]] = np.add.reduceat(d[order], first, axis=0)
    return out


def _gradients(m: Model, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> tuple[dict[str, np.ndarray], float]:
    """Gradients of the mean cross-entropy over positions, by backpropagation through time; weight: of each window."""
    steps, width = x.shape
    states, cache = _forward(m, x, keep=True)
    p = _positions(m, states)
    loss = float(-np.log(np.maximum(p[:, np.arange(width), y], 1e-9)).mean())
    d = p
    d[:, np.arange(width), y] -= 1
    d /= steps * width
    if weight is not None:
        d *= weight[:, None].astype(d.dtype)
    flat = np.concatenate([states[:, 0], states[:, 1]], 2).reshape(-1, 2 * HIDDEN)
    grad = {"out": flat.T @ d.reshape(-1, d.shape[2]), "bias": d.sum((0, 1))}
    back = d @ m.out.T
    dh = np.zeros((2, width, HIDDEN), np.float32)
    before, inputs, inner = (np.empty((2, steps, width, n * HIDDEN), np.float32) for n in (1, 3, 3))
    turned = m.rec.transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        h, z, s, rc, c = cache[t]
        dh[0] += back[t, :, :HIDDEN]
        dh[1] += back[steps - 1 - t, :, HIDDEN:]
        dz = dh * z
        dh -= dz
        dc = dz * (1 - c * c)
        dr = np.empty((2, width, 3 * HIDDEN), np.float32)
        dr[:, :, :HIDDEN] = (c - h) * dz * (1 - z)
        dr[:, :, HIDDEN : 2 * HIDDEN] = dc * rc * s * (1 - s)
        inputs[:, t, :, : 2 * HIDDEN] = dr[:, :, : 2 * HIDDEN]
        inputs[:, t, :, 2 * HIDDEN :] = dc
        np.multiply(dc, s, out=dr[:, :, 2 * HIDDEN :])
        before[:, t], inner[:, t] = h, dr
        dh += np.matmul(dr, turned)
    grad["rec"] = np.matmul(before.reshape(2, -1, HIDDEN).transpose(0, 2, 1), inner.reshape(2, -1, 3 * HIDDEN))
    grad["emb"] = np.stack([_by_byte(bytes_.ravel(), g.reshape(-1, 3 * HIDDEN)) for bytes_, g in zip((x, x[::-1]), inputs)])
    return grad, loss


PARTS = ("emb", "rec", "out", "bias")


def _start(langs: tuple[str, ...], rng: np.random.Generator) -> Model:
    """A model of random numbers."""
    small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    return Model(langs, small(2, 256, 3 * HIDDEN), small(2, HIDDEN, 3 * HIDDEN), small(2 * HIDDEN, len(langs)), np.zeros(len(langs), np.float32))


class _Steps:
    """Updates of a model in its place: gradients of norm 1 at most, by first and second moments."""

    def __init__(self, m: Model):
        self.m, self.n = m, 0
        self.first = {k: np.zeros_like(getattr(m, k)) for k in PARTS}
        self.second = {k: np.zeros_like(v) for k, v in self.first.items()}

    def take(self, grad: dict[str, np.ndarray], pace: float) -> None:
        self.n += 1
        size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        for k, g in grad.items():
            g = g * min(1.0, 1 / max(size, 1e-9))
            self.first[k] = 0.9 * self.first[k] + 0.1 * g
            self.second[k] = 0.99 * self.second[k] + 0.01 * g * g
            getattr(self.m, k)[...] -= pace * (self.first[k] / (1 - 0.9**self.n)) / (np.sqrt(self.second[k] / (1 - 0.99**self.n)) + 1e-8)


def train(spans: list[tuple[bytes, str]], updates: int = 240, width: int = 96, rate: float = 0.02, seed: int = 7) -> Model | None:
    """A model from (bytes, language); every update draws languages alike and reads spans of one length."""
    by: dict[str, list[np.ndarray]] = {}
    for data, lang in sorted(spans):
        if len(data):
            by.setdefault(lang, []).append(np.frombuffer(data, np.uint8))
    for own in by.values():
        own.sort(key=len)
    langs = tuple(sorted(by))
    if not langs:
        return None
    rng = np.random.default_rng(seed)
    m = _start(langs, rng)
    if len(langs) == 1:
        return m
    steps = _Steps(m)
    sizes = [np.array([len(x) for x in by[lang]]) for lang in langs]
    for step in range(1, updates + 1):
        y = rng.integers(len(langs), size=width)
        span = int(min(TRAIN_SPANS[step % len(TRAIN_SPANS)], *(x[-1] for x in sizes)))
        from_ = [int(np.searchsorted(x, span)) for x in sizes]  # the first that is long enough
        x = np.empty((span, width), np.uint8)
        for k, lang in enumerate(y):
            data = by[langs[lang]][rng.integers(from_[lang], len(sizes[lang]))]
            at = rng.integers(len(data) - span + 1)
            x[:, k] = data[at : at + span]
        grad, _ = _gradients(m, x, y)
        steps.take(grad, rate * min(1.0, 2 * (1 - step / (updates + 1))))
    return m


def sampled(docs: DataFrame, id_col: str, text_col: str, lang_col: str, learn: Column, per_lang: int = SAMPLE, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(text, lang, draw): the bounded sample of labelled rows, whole texts."""
    drawn = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.lit(11), F.col(id_col), F.col(text_col)).alias("draw"), F.col(text_col).alias("text")
    )
    ranked = drawn.select("lang", "draw").distinct().withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("draw")))
    # all languages' first rows come before any second ones
    chosen = ranked.where(F.col("rank") <= per_lang).orderBy("rank", "draw", "lang").limit(rows).select("lang", "draw")
    return drawn.join(F.broadcast(chosen), ["lang", "draw"]).dropDuplicates(["lang", "draw"]).select("text", "lang", "draw")


def spans_of(text: str, draw: int, n: int = SPANS, size: int = max(TRAIN_SPANS)) -> list[bytes]:
    """Spans at places drawn over the whole text; the text itself if it is no longer than one."""
    data = text.encode()
    if len(data) <= size:
        return [data]
    places = np.random.default_rng(draw & (1 << 63) - 1).integers(len(data) - size + 1, size=n)
    return [data[at : at + size] for at in places.tolist()]


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, learn: Column, per_lang: int = SAMPLE, rows: int = SAMPLE_ROWS) -> list[tuple[bytes, str]]:
    """(span, language): the spans to train on, at most ``SPANS`` a sampled row."""

    def run(batches):
        for part in slices(batches, "text"):
            found = [(x, lang) for text, lang, draw in zip(*(part.column(k).to_pylist() for k in range(3))) for x in spans_of(text, draw)]
            yield pa.record_batch([pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.string())], ["span", "lang"])

    got = sampled(docs, id_col, text_col, lang_col, learn, per_lang, rows).mapInArrow(run, "span binary, lang string").collect()
    return [(bytes(r["span"]), r["lang"]) for r in got]


def _document_probabilities(m: Model, texts: list[bytes]) -> np.ndarray:
    """Mean position probabilities of every (non-empty) text, over all its bytes."""
    sums = np.zeros((len(texts), len(m.langs)))
    flat = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.array([len(x) for x in texts])
    pieces = -(-sizes // SPAN)
    owner = np.repeat(np.arange(len(texts)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    start = (np.cumsum(sizes) - sizes)[owner] + nth * SPAN
    length = np.minimum(SPAN, sizes[owner] - nth * SPAN)
    order = np.argsort(-length, kind="stable")  # windows of like length run side by side
    for lo in range(0, len(order), BATCH):
        at = order[lo : lo + BATCH]
        step = np.arange(length[at[0]])[:, None]
        inside = step < length[at]
        x = flat[np.where(inside, start[at] + step, 0)]
        whole = bool(inside.all())
        p = _positions(m, _forward(m, x, inside=None if whole else inside))
        if not whole:
            p *= inside[:, :, None]
        np.add.at(sums, owner[at], p.sum(0))
    return sums / np.maximum(sizes, 1)[:, None]


def label_texts(m: Model | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """Language and its probability for every text; long texts are read in bounded parts."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    if m is None:
        return out
    todo = [k for k, x in enumerate(texts) if isinstance(x, str) and LETTER.search(x)]
    lo = 0
    while lo < len(todo):
        hi, size = lo, 0
        while hi < len(todo) and (hi == lo or size < 1 << 20):
            size += len(texts[todo[hi]])
            hi += 1
        p = _document_probabilities(m, [texts[k].encode() for k in todo[lo:hi]])
        for k, row in zip(todo[lo:hi], p):
            best = int(row.argmax())
            out[k] = (m.langs[best], float(min(1.0, row[best])))
        lo = hi
    return out


def predict(docs: DataFrame, model: Model | None, text_col: str = "text", lang_out: str = "lang_pred", score_out: str = "lang_score") -> DataFrame:
    """All columns of docs (but those of the output's names, which give way), the predicted language and its score."""
    base = docs.drop(lang_out, score_out)
    schema = T.StructType([*base.schema.fields, T.StructField(lang_out, T.StringType()), T.StructField(score_out, T.DoubleType())])

    def run(batches):
        for b in slices(batches, text_col):
            found = label_texts(model, b.column(text_col).to_pylist())
            yield b.append_column(lang_out, pa.array([x for x, _ in found], pa.string())).append_column(score_out, pa.array([s for _, s in found], pa.float64()))

    return base.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", mod: int = 5) -> Column:
    """Whether crc32 of the id as text is divisible by ``mod``."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % mod == 0, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", learn: Column | None = None) -> Model | None:
    learn = F.col(id_col).isNotNull() & ~held_out(id_col) if learn is None else learn
    return train(sample(docs, id_col, text_col, lang_col, learn))


def windows_of(data: bytes, phase: int = 0) -> dict[int, np.ndarray]:
    """A text's bytes as windows of the lengths of ``TRAIN_SPANS``, by length: every byte is in one.

    The least length may take the last window back over bytes of the one before; a shorter text is its own window.
    """
    x, least = np.frombuffer(data, np.uint8), min(TRAIN_SPANS)
    if len(x) <= least:
        return {len(x): x[None]} if len(x) else {}
    cycle = np.roll(TRAIN_SPANS, -(phase % len(TRAIN_SPANS)))
    sizes = np.resize(cycle, (len(x) // sum(TRAIN_SPANS) + 1) * len(cycle))
    ends = np.cumsum(sizes)
    n = int(np.searchsorted(ends, len(x), side="right"))
    sizes, starts = sizes[:n].tolist(), (ends[:n] - sizes[:n]).tolist()
    at = int(ends[n - 1]) if n else 0
    while at < len(x):
        size = max((s for s in TRAIN_SPANS if s <= len(x) - at), default=least)
        at = min(at, len(x) - size)
        sizes.append(size)
        starts.append(at)
        at += size
    sizes, starts = np.array(sizes), np.array(starts)
    return {int(s): x[starts[sizes == s][:, None] + np.arange(s)] for s in np.unique(sizes)}


class _Learner:
    """Learns from texts one after the other: windows are pooled, mixed, and taken in updates of one length."""

    def __init__(self, m: Model, weights: np.ndarray, width: int, rate: float, size: float, seed: list[int]):
        self.m, self.weights, self.width, self.rate, self.size = m, weights, width, rate, size
        self.rng, self.steps = np.random.default_rng(seed), _Steps(m)
        self.pool: dict[int, list[tuple[np.ndarray, int]]] = {}
        self.held = self.done = self.seen = 0

    def add(self, data: bytes, lang: int) -> None:
        for size, x in windows_of(data, int(self.rng.integers(len(TRAIN_SPANS)))).items():
            self.pool.setdefault(size, []).append((x, lang))
        self.held += len(data)
        self.seen += len(data)
        if self.held >= POOL_BYTES:
            self.learn(last=False)

    def learn(self, last: bool) -> None:
        """Takes what is pooled; windows that fill no update wait for the next time, unless it is the last."""
        tables, todo = {}, []
        for size, rows in self.pool.items():
            x = np.concatenate([x for x, _ in rows])
            y = np.repeat([lang for _, lang in rows], [len(x) for x, _ in rows])
            order = self.rng.permutation(len(x))
            tables[size] = x[order], y[order]
            todo += [(size, lo) for lo in range(0, len(x), self.width) if last or lo + self.width <= len(x)]
        for k in self.rng.permutation(len(todo)).tolist():
            size, lo = todo[k]
            x, y = (part[lo : lo + self.width] for part in tables[size])
            grad, _ = _gradients(self.m, np.ascontiguousarray(x.T), y, self.weights[y])
            self.steps.take(grad, self.rate * min(1.0, max(0.02, 2 * (1 - self.done / self.size))))
            self.done += x.size
        self.pool, self.held = {}, 0
        for size, (x, y) in tables.items():
            lo = len(x) if last else len(x) // self.width * self.width
            for k in range(lo, len(x)):
                self.pool.setdefault(size, []).append((x[k : k + 1], int(y[k])))
                self.held += size


def _flat(m: Model) -> np.ndarray:
    return np.concatenate([getattr(m, k).ravel() for k in PARTS])


def _shaped(m: Model, flat: np.ndarray) -> Model:
    """A model like m of the numbers of ``_flat``."""
    ends = np.cumsum([getattr(m, k).size for k in PARTS])
    return Model(m.langs, *(x.reshape(getattr(m, k).shape).astype(np.float32) for k, x in zip(PARTS, np.split(flat, ends[:-1]))))


def _round(rows: DataFrame, m: Model, weights: np.ndarray, parts: int, size: float, nth: int, passes: int = 1) -> Model:
    """The mean of the models that the tasks make of m, each from its own rows (lang, draw, text) in the order of draw."""
    codes = {lang: k for k, lang in enumerate(m.langs)}
    later = nth > 0

    def run(batches):
        learner = None
        for part in slices(batches, "text"):
            if learner is None and part.num_rows:
                task = part.column("part")[0].as_py()
                learner = _Learner(_shaped(m, _flat(m)), weights, WIDTHS[later], RATES[later], max(1.0, passes * size / parts), [7, nth, task])
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist()):
                learner.add(text.encode(), codes[lang])
        if learner is not None:
            pool = {k: list(v) for k, v in learner.pool.items()}
            for again in range(passes):
                learner.pool = dict(pool) if again else learner.pool
                learner.learn(last=True)
            give_back()
            yield pa.record_batch([pa.array([task], pa.int32()), pa.array([learner.seen], pa.int64()), pa.array([_flat(learner.m).astype(np.float32).tobytes()], pa.binary())], ["part", "seen", "model"])

    def add(batches):
        seen, total = 0, 0.0
        for b in batches:
            for n, x in zip(b.column("seen").to_pylist(), b.column("model").to_pylist()):
                seen, total = seen + n, total + n * np.frombuffer(x, np.float32).astype(np.float64)
        if seen:
            yield pa.record_batch([pa.array([seen], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["seen", "model"])

    dealt = rows.select("lang", "draw", "text", F.pmod(F.shiftright("draw", 20), F.lit(parts)).cast("int").alias("part"))
    # hashes of one part stand in one order, so a task that runs twice learns the same
    made = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "draw", "lang").mapInArrow(run, "part int, seen long, model binary")
    heaps = math.isqrt(parts)
    if heaps > 1:
        made = made.repartitionById(heaps, F.col("part") % heaps).sortWithinPartitions("part")
    sums = [(r["seen"], np.frombuffer(r["model"], np.float64)) for r in made.mapInArrow(add, "seen long, model binary").collect()]
    return _shaped(m, sum(x for _, x in sums) / sum(n for n, _ in sums)) if sums else m


def fit_all(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", learn: Column | None = None) -> Model | None:
    """A model of every byte of every labelled row."""
    learn = F.col(id_col).isNotNull() & ~held_out(id_col) if learn is None else learn
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.lit(11), F.col(id_col), F.col(text_col)).alias("draw"), F.col(text_col).alias("text")
    )
    sizes = {r["lang"]: r["size"] for r in rows.groupBy("lang").agg(F.sum(F.octet_length("text").cast("long")).alias("size")).collect()}
    langs = tuple(sorted(sizes))
    if not langs:
        return None
    m = _start(langs, np.random.default_rng(7))
    if len(langs) == 1:
        return m
    total = sum(sizes.values())
    weights = np.array([total / len(langs) / sizes[lang] for lang in langs])
    low, nth, end = 0, 0, float(FIRST_BYTES)
    place = F.pmod("draw", F.lit(1 << 20))
    while low < 1 << 20:
        high = min(1 << 20, max(low + 1, int(end / total * (1 << 20))))
        size = total * (high - low) / (1 << 20)
        parts = 1 if nth == 0 else max(-(-int(size) // TASK_BYTES), min(8, -(-int(size) // FIRST_BYTES)), 1)
        m = _round(rows.where((place >= low) & (place < high)), m, weights, parts, size, nth, max(1, -(-LEAST_BYTES // total)))
        low, nth, end = high, nth + 1, end * GROWTH
    return m


@lru_cache(maxsize=1 << 17)
def _script(c: str) -> str:
    """The script of a letter, by the first word of its Unicode name."""
    return unicodedata.name(c, "").split(" ")[0].split("-")[0]


def scripts(text: str | None) -> Counter:
    """Letters of a text by script."""
    out = Counter()
    for c, n in Counter(text or "").items():
        if c.isalpha():
            out[_script(c)] += n
    return out


@dataclass(frozen=True)
class Bounds:
    """What a document in a known language shows: at least this probability, mostly these scripts."""

    least: float = 0.3
    scripts: frozenset[str] | None = None


def calibrate(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", missed: float = 0.001) -> Bounds:
    """Bounds from all labelled rows held out of training; whole texts are read.

    The probability is the one that a share of ``missed`` stays under; a script is learned if it has a hundredth of
    the letters of a language.
    """
    if model is None:
        return Bounds()
    known = F.col(lang_col).isin(*model.langs) & F.col(text_col).rlike(r"\p{L}")
    rows = docs.where(held_out(id_col) & known).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def run(batches):
        for part in slices(batches, "text"):
            texts = part.column("text").to_pylist()
            seen = [list(scripts(x).items()) for x in texts]
            yield pa.record_batch(
                [part.column("lang"), pa.array([p for _, p in label_texts(model, texts)]), pa.array([[s for s, _ in x] for x in seen], pa.list_(pa.string())), pa.array([[n for _, n in x] for x in seen], pa.list_(pa.int64()))],
                ["lang", "p", "scripts", "letters"],
            )

    found = cut(rows.mapInArrow(run, "lang string, p double, scripts array<string>, letters array<long>"))
    n = found.count()
    if not n:
        return Bounds()
    # the quantile lies between two neighbours in the order of all
    at = missed * (n - 1)
    lowest = [r["p"] for r in found.select("p").orderBy("p").limit(int(at) + 2).collect()][int(at) :]
    least = lowest[0] + (at - int(at)) * (lowest[-1] - lowest[0])
    by_lang: dict[str, Counter] = {}
    each = found.select("lang", F.explode(F.arrays_zip("scripts", "letters")).alias("x")).groupBy("lang", "x.scripts").agg(F.sum("x.letters").alias("n"))
    for r in each.collect():
        by_lang.setdefault(r["lang"], Counter())[r["scripts"]] += r["n"]
    return Bounds(float(least), frozenset(s for c in by_lang.values() for s, n in c.items() if 100 * n >= c.total()))


def keep_known(docs: DataFrame, model: Model | None, bounds: Bounds = Bounds(), text_col: str = "text") -> DataFrame:
    """Documents in a language the model knows, by its probability and by the scripts of most letters; columns as they were.

    A network has a language for every text, with a high probability for scripts it never saw: hence the scripts.
    """

    def known(text: str | None) -> bool:
        if bounds.scripts is None:
            return True
        seen = scripts(text)
        return 2 * sum(n for s, n in seen.items() if s in bounds.scripts) >= seen.total()

    def run(batches):
        for part in slices(batches, text_col):
            texts = part.column(text_col).to_pylist()
            found = label_texts(model, texts)
            yield part.filter(pa.array([lang != UNKNOWN and p >= bounds.least and known(x) for x, (lang, p) in zip(texts, found)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
