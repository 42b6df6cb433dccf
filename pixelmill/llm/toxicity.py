"""Toxicity by classifier chains.

The categories are predicted one after the other by linear models; a later model gets the probabilities of the
earlier ones as features.  In training these are out-of-fold predictions (each row's come from models that did not
see it), so a later model learns from probabilities as good as those it will get.  The chain here follows the
labels there are: ``low_quality`` (quality = 0), then ``toxic``.

Features: presence of words whose share among a category's positive rows stands out (z-score), found on the
training sample alone, and six shares of the text's surface.  Models are logistic regressions in numpy.  The
decision threshold is the one of the best F1 of the out-of-fold predictions.

``fit_all`` learns from every pair of a label row and a document, ``fit`` from at most ``SAMPLE`` of them, drawn by a hash
of the id; texts are read whole, in training as in prediction.  Scale: words are counted over all learned rows by an
aggregation; the driver gets the words that stand out (at most 250 a category and fold).  ``fit`` also gets of each
sampled row the ones of these it has; ``fit_all`` keeps them in a table and takes every Newton step, for all folds at
once, from sums that tasks make of it (a few MB, whatever the rows).  Prediction is one narrow pass over whole texts, a
slice of a batch at a time, with a model of a few thousand words.

Defined results: a null or empty text has no features and gets the models' base rates; labels that are null are
not learned from; without rows of both classes a category's probability is its base rate (0 without rows).
Several label rows of one document, or documents of one id, count as one row each.  ``predict`` puts its columns in
the place of any of the same names; ``keep_clean`` adds none.  Empty tables give a chain that calls nothing toxic.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelmill.llm.common import cut, slices, store

SAMPLE = 6_000
WORDS = 250
Z_LEAST = 4.0
ROWS_LEAST = 5
FOLDS = 5
#: Rows of a part of the feature table.
FEATURE_ROWS = 16_384
WORD = regex.compile(r"\p{L}+")
CATEGORIES = ("low_quality", "toxic")


@dataclass(frozen=True)
class Link:
    """One category's model: weights of words, of the surface and of earlier probabilities."""

    words: dict[str, float]
    dense: np.ndarray
    bias: float


@dataclass(frozen=True)
class Chain:
    categories: tuple[str, ...]
    links: tuple[Link, ...]
    thresholds: tuple[float, ...]


def surface(text: str) -> list[float]:
    """Shares of symbols, bars, exclamation marks, capitals and repeated words, and the log length."""
    n = max(1, len(text))
    words = text.split()
    marks = Counter(text)
    count = lambda chars: sum(marks.get(c, 0) for c in chars)
    upper = sum(v for c, v in marks.items() if c.isupper())
    return [count("#*$%&<>~^") / n * 10, marks.get("|", 0) / n * 10, count("!?") / n * 10, upper / n * 5, 1 - len(set(words)) / max(1, len(words)), float(np.log10(n)) / 5]


def _fit(x: np.ndarray, y: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton steps with an L2 penalty."""
    x1 = np.c_[x, np.ones(len(x))]
    w = np.zeros(x1.shape[1])
    base = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    w[-1] = np.log(base / (1 - base))
    ridge = np.full(x1.shape[1], penalty)
    ridge[-1] = 1e-6
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + np.diag(ridge), x1.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-4:
            break
    return w[:-1], float(w[-1])


def _choose(sets: list[set[str]], y: np.ndarray, most: int = WORDS, z_least: float = Z_LEAST, least: int = ROWS_LEAST) -> list[str]:
    """Words whose share among positive rows stands out from their share among all."""
    seen, hits = Counter(), Counter()
    for words, positive in zip(sets, y):
        seen.update(words)
        if positive:
            hits.update(words)
    base = float(y.mean())
    z = {w: (hits[w] - n * base) / np.sqrt(n * base * (1 - base)) for w, n in seen.items() if n >= least and 0 < base < 1}
    return sorted((w for w, v in z.items() if v >= z_least), key=lambda w: (-z[w], w))[:most]


def _link(sets: list[set[str]], dense: np.ndarray, y: np.ndarray) -> Link:
    if len(y) == 0 or y.min() == y.max():
        rate = float(y.mean()) if len(y) else 0.0
        return Link({}, np.zeros(dense.shape[1]), -30.0 if rate == 0 else 30.0)
    words = _choose(sets, y)
    at = {w: k for k, w in enumerate(words)}
    x = np.zeros((len(sets), len(words)))
    for row, s in enumerate(sets):
        for w in s & at.keys():
            x[row, at[w]] = 1
    w, bias = _fit(np.c_[x, dense], y)
    return Link(dict(zip(words, w[: len(words)].tolist())), w[len(words) :], bias)


def _probability(link: Link, sets: list[set[str]], dense: np.ndarray) -> np.ndarray:
    score = np.array([sum(link.words[w] for w in s & link.words.keys()) for s in sets]) if sets else np.zeros(0)
    return 1 / (1 + np.exp(-np.clip(score + dense @ link.dense + link.bias, -30, 30)))


def train(sets: list[set[str]], dense: np.ndarray, labels: dict[str, np.ndarray], folds: np.ndarray) -> Chain:
    """The chain over the labels in their order; folds: the fold of each row."""
    links, thresholds = [], []
    for name, y in labels.items():
        out = np.zeros(len(y))
        for fold in range(FOLDS):
            rest, own = np.flatnonzero(folds != fold), np.flatnonzero(folds == fold)
            link = _link([sets[k] for k in rest], dense[rest], y[rest])
            out[own] = _probability(link, [sets[k] for k in own], dense[own])
        links.append(_link(sets, dense, y))
        tries = np.linspace(0.1, 0.9, 33)
        f1 = [2 * ((out >= t) & (y == 1)).sum() / max(1, (out >= t).sum() + (y == 1).sum()) for t in tries]
        thresholds.append(float(tries[int(np.argmax(f1))]) if len(y) else 0.5)
        dense = np.c_[dense, out]
    return Chain(tuple(labels), tuple(links), tuple(thresholds))


def _words(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def _standing_out(sampled: DataFrame) -> tuple[dict[int, Row], dict[str, Row]]:
    """Rows and positive rows by fold, and all words that ``_choose`` would take for any category, with any fold left out or none.

    Words come with their counts: of rows by fold, and of positive rows by category and fold.
    """
    per = {r["fold"]: r for r in sampled.groupBy("fold").agg(F.count("*").alias("n"), *[F.sum(c).alias(c) for c in CATEGORIES]).collect()}
    words = sampled.select("fold", *CATEGORIES, F.explode("words").alias("word")).groupBy("word")
    own = lambda c, f: F.count(F.when((F.col("fold") == f) & (F.col(c) != 0 if c else F.lit(True)), 1)).alias(f"{c}{f}")
    counts = words.agg(*[own(c, f) for c in ("", *CATEGORIES) for f in range(FOLDS)])
    tries = []
    for c in CATEGORIES:
        for left_out in (None, *range(FOLDS)):
            folds = [f for f in per if f != left_out]
            rows = sum(per[f]["n"] for f in folds)
            base = sum(per[f][c] for f in folds) / rows if rows else 0
            if 0 < base < 1:
                n, hits = (sum((F.col(f"{x}{f}") for f in folds), F.lit(0)) for x in ("", c))
                z = (hits - n * F.lit(base)) / F.sqrt(n * F.lit(base) * F.lit(1 - base))
                tries.append(F.struct(F.lit(len(tries)).alias("at"), F.when(n >= ROWS_LEAST, z).alias("z")))
    if not tries:
        return per, {}
    found = counts.select("*", F.explode(F.array(*tries)).alias("try")).select(*counts.columns, "try.*").where(F.col("z") >= Z_LEAST - 1e-9)
    best = found.withColumn("rank", F.row_number().over(Window.partitionBy("at").orderBy(F.desc("z"), "word"))).where(F.col("rank") <= WORDS)
    return per, {r["word"]: r for r in best.select(*counts.columns).distinct().collect()}


def _known(labels: DataFrame) -> DataFrame:
    """(_id, _quality, _toxic, _draw) of the label rows that say both."""
    rows = labels.select(F.col("doc_id").alias("_id"), F.col("quality").alias("_quality"), F.col("toxic").alias("_toxic")).where("_quality is not null and _toxic is not null")
    return rows.withColumn("_draw", F.xxhash64(F.lit(17), F.col("_id")))


def _featured(joined: DataFrame) -> DataFrame:
    """(draw, fold, categories, words, dense, tie) of documents joined with their labels."""

    def run(batches):
        for part in slices(batches, "_text"):
            texts = [x or "" for x in part.column("_text").to_pylist()]
            draw, quality, toxic = (part.column(c).to_pylist() for c in ("_draw", "_quality", "_toxic"))
            yield pa.record_batch(
                [
                    pa.array(draw, pa.int64()), pa.array([(d >> 7) % FOLDS for d in draw], pa.int32()), pa.array([1 - q for q in quality], pa.int32()), pa.array(toxic, pa.int32()),
                    pa.array([sorted(_words(x)) for x in texts], pa.list_(pa.string())), pa.array([surface(x) for x in texts], pa.list_(pa.float64())), pa.array([zlib.crc32(x.encode()) for x in texts], pa.int64()),
                ],
                ["draw", "fold", "low_quality", "toxic", "words", "dense", "tie"],
            )

    return joined.mapInArrow(run, "draw long, fold int, low_quality int, toxic int, words array<string>, dense array<double>, tie long")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE) -> Chain:
    """A chain from the labelled documents, of which at most ``rows`` are drawn."""
    # so many label rows of the lowest hashes suffice; their documents may be more, of which again so many are kept
    known = _known(labels).orderBy("_draw", "_id", "_quality", "_toxic").limit(rows)
    joined = docs.select(F.col(id_col).alias("_id2"), F.col(text_col).alias("_text")).join(F.broadcast(known), F.col("_id") == F.col("_id2"))
    sampled = cut(_featured(joined).orderBy("draw", "low_quality", "toxic", "tie").limit(rows).drop("tie"))
    chosen = set(_standing_out(sampled)[1])

    def pick(batches):
        for b in batches:
            b["words"] = [sorted(chosen.intersection(x)) for x in b["words"]]
            yield b

    # a choice among these words is the choice among all: a word's score depends on its own counts alone
    got = sampled.mapInPandas(pick, sampled.schema).collect()
    got.sort(key=lambda r: (r["draw"], r["words"], r["dense"], r["low_quality"], r["toxic"]))
    sets = [set(r["words"]) for r in got]
    dense = np.array([r["dense"] for r in got]).reshape(len(got), 6)
    y = {c: np.array([r[c] for r in got], float) for c in CATEGORIES}
    return train(sets, dense, y, np.array([r["fold"] for r in got]))


@dataclass
class _Part:
    """A model in training: its category, the fold it does not see, its words' places among all, numbers as in ``_fit``."""

    category: str
    left_out: int | None
    words: list[str]
    at: np.ndarray
    w: np.ndarray


class _Batch:
    """Rows of the feature table as arrays."""

    def __init__(self, b: pa.RecordBatch):
        self.fold = b.column("fold").to_numpy()
        self.y = {c: b.column(c).to_numpy().astype(float) for c in CATEGORIES}
        self.dense = b.column("dense").flatten().to_numpy().reshape(-1, 6)
        self.word = b.column("words").flatten().to_numpy()
        self.row = np.repeat(np.arange(len(self.fold)), b.column("words").value_lengths().to_numpy())

    def design(self, part: _Part) -> np.ndarray:
        """Words, dense features and a one, n x numbers of the model."""
        x = np.zeros((len(self.fold), len(part.words)))
        to = part.at[self.word]
        x[self.row[to >= 0], to[to >= 0]] = 1
        return np.c_[x, self.dense, np.ones(len(x))]

    def out_of_fold(self, parts: list[_Part]) -> np.ndarray:
        """Each row's probability by the model that did not see it."""
        out = np.zeros(len(self.fold))
        for part in parts:
            own = self.fold == part.left_out
            out[own] = _sigmoid(self.design(part) @ part.w)[own]
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sums(features: DataFrame, make, earlier: list[list[_Part]]) -> dict[int, np.ndarray]:
    """Sums over all rows of the arrays that make(batch) returns by number; earlier categories' probabilities are in dense."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for lo in range(0, b.num_rows, 4096):
                rows = _Batch(b.slice(lo, 4096))
                for parts in earlier:
                    rows.dense = np.c_[rows.dense, rows.out_of_fold(parts)]
                for k, x in make(rows).items():
                    total[k] = total[k] + x if k in total else x
        if total:
            task = TaskContext.get().partitionId()
            for k, x in total.items():
                yield pa.record_batch([pa.array([k], pa.int32()), pa.array([task], pa.int32()), pa.array([x.astype(float).tobytes()], pa.binary())], ["k", "task", "x"])

    def add(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, x in zip(b.column("k").to_pylist(), b.column("x").to_pylist()):
                total[k] = total.get(k, 0.0) + np.frombuffer(x)
        for k, x in total.items():
            yield pa.record_batch([pa.array([k], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["k", "x"])

    kinds = FOLDS + 1
    made = features.mapInArrow(run, "k int, task int, x binary").repartitionById(kinds, F.col("k")).sortWithinPartitions("k", "task")
    return {r["k"]: np.frombuffer(r["x"]) for r in made.mapInArrow(add, "k int, x binary").collect()}


def _fit_parts(features: DataFrame, parts: list[_Part], earlier: list[list[_Part]], penalty: float = 1.0) -> None:
    """``_fit`` of several models at once, each step from sums over all rows."""
    live = {k for k, part in enumerate(parts) if len(part.words) or np.abs(part.w[-1]) < 30}
    for _ in range(12):
        if not live:
            return
        now = sorted(live)

        def make(rows: _Batch) -> dict[int, np.ndarray]:
            found = {}
            for k in now:
                own = np.flatnonzero(rows.fold != parts[k].left_out) if parts[k].left_out is not None else slice(None)
                x, y = rows.design(parts[k])[own], rows.y[parts[k].category][own]
                p = _sigmoid(x @ parts[k].w)
                found[k] = np.concatenate([((x * (p * (1 - p))[:, None]).T @ x).ravel(), x.T @ (y - p)])
            return found

        for k, total in _sums(features, make, earlier).items():
            w = parts[k].w
            ridge = np.full(len(w), penalty)
            ridge[-1] = 1e-6
            step = np.linalg.solve(total[: len(w) ** 2].reshape(len(w), len(w)) + np.diag(ridge), total[len(w) ** 2 :] - ridge * w)
            parts[k].w = w + step
            if np.abs(step).max() < 1e-4:
                live.discard(k)


def fit_all(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Chain:
    """A chain from all labelled documents: what ``fit`` would make without a bound, by sums that tasks make."""
    joined = docs.select(F.col(id_col).alias("_id2"), F.col(text_col).alias("_text")).join(_known(labels), F.col("_id") == F.col("_id2"))
    made = store(_featured(joined).drop("tie"))
    per, counts = _standing_out(made)
    place = {w: k for k, w in enumerate(sorted(counts))}
    n = sum(r["n"] for r in per.values())

    def pick(batches):
        for b in batches:
            b["words"] = [[place[w] for w in x if w in place] for x in b["words"]]
            yield b

    schema = "draw long, fold int, low_quality int, toxic int, words array<int>, dense array<double>"
    width = -(-n // FEATURE_ROWS) or 1
    features = store(made.mapInPandas(pick, schema).repartitionById(width, F.pmod("draw", F.lit(width)).cast("int")))
    links, thresholds, earlier = [], [], []
    for c in CATEGORIES:
        parts = []
        for left_out in (None, *range(FOLDS)):
            folds = [f for f in per if f != left_out]
            rows, positive = (sum(per[f][x] for f in folds) for x in ("n", c))
            base, words, size = positive / rows if rows else 0.0, [], 6 + len(earlier) + 1
            if not 0 < base < 1:
                parts.append(_Part(c, left_out, [], np.full(len(place), -1), np.r_[np.zeros(size - 1), -30.0 if base == 0 else 30.0]))
                continue
            z = {}
            for w, r in counts.items():
                seen, hits = (sum(r[f"{x}{f}"] for f in folds) for x in ("", c))
                if seen >= ROWS_LEAST:
                    z[w] = (hits - seen * base) / np.sqrt(seen * base * (1 - base))
            words = sorted((w for w, v in z.items() if v >= Z_LEAST), key=lambda w: (-z[w], w))[:WORDS]
            at = np.full(len(place), -1)
            at[[place[w] for w in words]] = np.arange(len(words))
            start = np.clip(base, 1e-3, 1 - 1e-3)
            parts.append(_Part(c, left_out, words, at, np.r_[np.zeros(len(words) + size - 1), np.log(start / (1 - start))]))
        _fit_parts(features, parts, earlier)
        whole, held = parts[0], parts[1:]
        k = len(whole.words)
        links.append(Link(dict(zip(whole.words, whole.w[:k].tolist())), whole.w[k:-1], float(whole.w[-1])))
        tries = np.linspace(0.1, 0.9, 33)

        def hits(rows: _Batch) -> dict[int, np.ndarray]:
            called, y = rows.out_of_fold(held)[:, None] >= tries, rows.y[c] == 1
            return {0: np.concatenate([2 * (called & y[:, None]).sum(0), called.sum(0) + y.sum()])}

        got = _sums(features, hits, earlier).get(0)
        thresholds.append(float(tries[int(np.argmax(got[:33] / np.maximum(1, got[33:])))]) if got is not None else 0.5)
        earlier.append(held)
    return Chain(CATEGORIES, tuple(links), tuple(thresholds))


def score_texts(chain: Chain, texts: list[str | None]) -> np.ndarray:
    """Probabilities of all categories, n x categories, from whole texts."""
    texts = [x if isinstance(x, str) else "" for x in texts]
    sets = [_words(x) for x in texts]
    dense = np.array([surface(x) for x in texts]).reshape(len(texts), 6)
    for link in chain.links:
        dense = np.c_[dense, _probability(link, sets, dense)]
    return dense[:, 6:]


def predict(docs: DataFrame, chain: Chain, text_col: str = "text", prefix: str = "p_") -> DataFrame:
    """All columns of docs (but those of the output's names) and a probability for every category."""
    names = [prefix + c for c in chain.categories]
    base = docs.drop(*names)
    schema = T.StructType([*base.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])

    def run(batches):
        for b in slices(batches, text_col):
            p = score_texts(chain, b.column(text_col).to_pylist())
            for k, n in enumerate(names):
                b = b.append_column(n, pa.array(p[:, k], pa.float64()))
            yield b

    return base.mapInArrow(run, schema)


def keep_clean(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """Documents under the threshold of the chain's last category (toxic); columns as they were."""

    def run(batches):
        for b in slices(batches, text_col):
            p = score_texts(chain, b.column(text_col).to_pylist())
            yield b.filter(pa.array(p[:, -1] < chain.thresholds[-1], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
