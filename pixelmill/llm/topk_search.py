"""Exact top-k search by inner product over norm buckets.

Candidates are grouped by length (Euclidean norm) into buckets of bounded size; a bucket whose rows are too many
for one block (many vectors of one length) is dealt over several by a hash of the id.  Queries are dealt into
blocks.  The bucket of the longest vectors gives every query a first threshold, its k-th best product there.  In
every other bucket a query's threshold becomes a local cosine threshold t = theta / (|q| * longest in the bucket):
- t > 1: the bucket is skipped (whole pairs of block and bucket are not even sent);
- t >= ``COORDINATE_FROM``: coordinate pruning: on the query's largest coordinate only candidates within the
  interval that a cosine of t allows are looked at;
- below: length pruning: candidates are sorted by length, and only those long enough are looked at.
What is left is verified by the integer product.  Every row is indexed, nothing is sampled: results are exact.

Scale: a candidate is sent once to every query block that can reach its bucket (blocks hold 8,192 queries); from
a pair of block and bucket at most k rows a query come back.  Buckets are ordered by length, so what a block reaches
is one number, the last bucket; tasks get one number a block and three a bucket (of which there are ``BUCKETS`` at
most), never a table of pairs.  Work grows with queries times rows, less what is pruned.

Defined results: vectors that are null or hold null or non-finite components take no part, nor do rows with a
null id.  Vectors of different lengths are compared as if zeros followed the shorter.  An empty vector has
product 0 with all.  Rows with the query's id count as its own; queries of equal id are one.  Components are integers
of any size; products are summed as doubles while every sum stays under 2^53, and as integers beyond.  A score beyond
a long is given as the nearest long, and such scores tie.  Other columns are ignored, whatever their names; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixelmill.llm.common import cut

BLOCK = 8192
BUCKETS = 65_536
COORDINATE_FROM = 0.5
LONG = (1 << 63) - 1


def pack_vector(v: np.ndarray) -> bytes:
    """Whole numbers as 32-bit integers; if one is larger as doubles, with a byte behind that makes the length odd."""
    small = not len(v) or float(np.abs(v).max()) < 1 << 31
    return v.astype("<i4").tobytes() if small else v.astype("<f8").tobytes() + b"d"


def _vectors(data) -> np.ndarray:
    """Packed vectors as rows of doubles (whole numbers), zeros behind the shorter."""
    rows = [np.frombuffer(x[:-1], "<f8") if len(x) % 2 else np.frombuffer(x, "<i4") for x in data]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for k, v in enumerate(rows):
        out[k, : len(v)] = v
    return out


def prepare(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v, norm): v is floor(scale * x), packed."""

    def run(batches):
        for b in batches:
            column = b.column("x")
            values = column.values
            flat = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False)
            with np.errstate(over="ignore"):
                flat = np.floor(flat * scale)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            at = column.offsets.to_numpy()
            use = np.flatnonzero(pc.is_valid(column).to_numpy(zero_copy_only=False) & (bad[at[1:]] == bad[at[:-1]]))
            rows = [flat[at[k] : at[k + 1]] for k in use.tolist()]
            top = [float(np.abs(v).max(initial=0)) or 1.0 for v in rows]
            norm = [t * float(np.sqrt(np.square(v / t).sum())) for v, t in zip(rows, top)]
            yield pa.record_batch([b.column("id").take(pa.array(use)), pa.array(map(pack_vector, rows), pa.binary()), pa.array(norm, pa.float64())], ["id", "v", "norm"])

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x")).where("id is not null")
    return rows.mapInArrow(run, "id long, v binary, norm double")


def _products(q: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, float]:
    """Inner products as doubles, and how far they can be off: 0 while every sum stays under 2^53."""
    with np.errstate(over="ignore", invalid="ignore"):
        top = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, q.shape[1])
        return q @ c.T, 0.0 if top < 2**53 else top * 2.0**-50


def _whole(q: np.ndarray, c: np.ndarray) -> list[int]:
    """The exact products of one query."""
    a = [int(x) for x in q]
    return [sum(x * int(y) for x, y in zip(a, row) if x) for row in c.tolist()]


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to smaller ids."""
    if len(score) > 4 * k:
        keep = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    else:
        keep = np.arange(len(score))
    return keep[np.lexsort((ids[keep], ~score[keep]))[:k]]  # ~: the least long has no negative


def search_bucket(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best of one bucket for every query of one block that can still enter its list."""
    order = np.argsort(-candidates["norm"].to_numpy(), kind="stable")
    norm, ids = candidates["norm"].to_numpy()[order], candidates["id"].to_numpy()[order]
    c, q = _vectors(candidates["v"].to_numpy()[order]), _vectors(queries["v"])
    width = max(c.shape[1], q.shape[1])
    c, q = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (c, q))
    qn, qid, theta = queries["norm"].to_numpy(), queries["id"].to_numpy(), queries["theta"].to_numpy(np.float64)
    with np.errstate(divide="ignore", invalid="ignore"):
        reach = np.where(qn > 0, theta / qn, np.where(theta > 0, np.inf, -np.inf))  # a candidate must be this long
        local = np.where(reach > 0, reach / norm[0] if norm[0] > 0 else np.inf, -np.inf)
    found = []

    def take(row: int, at: np.ndarray, score: np.ndarray, off: float) -> None:
        own = ids[at] != qid[row]
        at, score = at[own], score[own]
        if off:  # the doubles are not exact: all that can be among the best is summed as integers
            least = theta[row] - off if np.isfinite(off) else -np.inf
            if len(score) > k and np.isfinite(off):
                least = max(least, np.partition(score, len(score) - k)[len(score) - k] - 2 * off)
            # scores beyond a long tie
            least = -np.inf if least <= -(2.0**63) else min(least, 2.0**63 - off) if np.isfinite(off) else least
            at = at[~(score < least)]
            exact = _whole(q[row], c[at])
            keep = [x >= theta[row] for x in exact]
            at, score = at[np.array(keep, bool)], np.array([max(-LONG - 1, min(LONG, x)) for x, y in zip(exact, keep) if y], np.int64)
        else:
            at, score = at[score >= theta[row]], score[score >= theta[row]].astype(np.int64)
        best = _best(score, ids[at], k)
        found.append(pd.DataFrame({"query_id": qid[row], "vec_id": ids[at[best]], "score": score[best]}))

    coordinate = np.flatnonzero((local >= COORDINATE_FROM) & (local <= 1 + 1e-9))
    if len(coordinate):
        unit = c / np.where(norm > 0, norm, 1)[:, None]
        by: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for row in coordinate.tolist():
            u, t = q[row] / qn[row], min(1.0, local[row])
            f = int(np.abs(u).argmax())
            if f not in by:
                at = np.argsort(unit[:, f], kind="stable")
                by[f] = (at, unit[at, f])
            at, values = by[f]
            half = np.sqrt(max(0.0, (1 - t * t) * (1 - u[f] * u[f])))
            # within the angle of t around the query the axis itself may lie: then values go up to it
            low, high = -1.0 if u[f] <= -t else u[f] * t - half, 1.0 if u[f] >= t else u[f] * t + half
            # the root makes of a rounding error of 1e-16 one of 1e-8
            near = at[np.searchsorted(values, low - 1e-7) : np.searchsorted(values, high + 1e-7, side="right")]
            near = near[norm[near] >= reach[row] * (1 - 1e-12)]
            if len(near):
                scores, off = _products(q[row : row + 1], c[near])
                take(row, near, scores[0], off)
    length = np.flatnonzero(local < COORDINATE_FROM)
    long_enough = np.searchsorted(-norm, -reach[length] * (1 - 1e-12), side="right")
    length, long_enough = length[np.argsort(long_enough)], np.sort(long_enough)
    for lo in range(0, len(length), 128):
        rows, n = length[lo : lo + 128], int(long_enough[lo : lo + 128].max(initial=0))
        if n:
            scores, off = _products(q[rows], c[:n])
            for r, row in zip(rows.tolist(), scores):
                at = np.flatnonzero(~(row < theta[r] - off)) if np.isfinite(theta[r]) and np.isfinite(off) else np.arange(n)
                if len(at):
                    take(r, at, row[at], off)
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")


def _mixed(ids: np.ndarray, seed: int) -> np.ndarray:
    """A hash of each id."""
    return np.array([xxhash.xxh64_intdigest(x.tobytes(), seed) >> 1 for x in ids.astype("<i8")], np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest integer products of each query with all rows of ``vectors``."""
    rows = cut(prepare(vectors, id_col, vec_col, scale))
    asked = cut(prepare(queries, id_col, vec_col, scale).dropDuplicates(["id"]))
    n, n_asked = rows.count(), asked.count()
    if not n:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")).limit(0)
    buckets = min(BUCKETS, max(1, -(-n // BLOCK), min(24, -(-n // 1024))))
    edges = rows.agg(F.percentile_approx("norm", [i / buckets for i in range(1, buckets)], 10_000)).first()[0] if buckets > 1 else []
    edges = np.unique(np.array(edges, np.float64))

    def bucket_of(norm: np.ndarray) -> np.ndarray:
        """0: the longest."""
        return len(edges) - np.searchsorted(edges, norm, side="right")

    def number(batches):
        for b in batches:
            yield pd.DataFrame({"bucket": bucket_of(b["norm"].to_numpy()), "norm": b["norm"]})

    stats = rows.select("norm").mapInPandas(number, "bucket long, norm double").groupBy("bucket").agg(F.count("*").alias("n"), F.max("norm").alias("longest")).collect()
    parts, longest = np.zeros(len(edges) + 1, np.int64), np.full(len(edges) + 1, -np.inf)
    for r in stats:
        parts[r["bucket"]], longest[r["bucket"]] = -(-r["n"] // BLOCK), r["longest"]
    top = int(np.flatnonzero(parts)[0])
    blocks = max(1, -(-n_asked // BLOCK))
    # what is reachable, as if no bucket were longer than one before it
    reach = np.minimum.accumulate(np.where(parts > 0, longest, np.inf))

    def pairs(asked: DataFrame, first: int, last: np.ndarray) -> DataFrame:
        """The k best of each pair of query block and tile; last: the last bucket of each block, from ``first`` on."""
        by_reach = np.argsort(-last, kind="stable")  # the blocks that reach a bucket come first
        n_blocks = np.searchsorted(-last[by_reach], -np.arange(len(parts)), side="right")

        def spread(b: pd.DataFrame, row: np.ndarray, block: np.ndarray, bucket: np.ndarray, part: np.ndarray, kind: str) -> pd.DataFrame:
            own = b.iloc[row]
            return pd.DataFrame({"block": block, "bucket": bucket, "part": part, "kind": kind, "id": own["id"].to_numpy(), "v": own["v"].to_numpy(), "norm": own["norm"].to_numpy(), "theta": own["theta"].to_numpy() if kind == "q" else 0.0})

        def send_queries(batches):
            for b in batches:
                for lo in range(0, len(b), 512):
                    part = b.iloc[lo : lo + 512]
                    block = _mixed(part["id"].to_numpy(), 3) % blocks
                    out = [(r, x, p) for r, t in enumerate(last[block].tolist()) for x in range(first, t + 1) for p in range(int(parts[x]))]
                    if out:
                        r, x, p = np.array(out, np.int64).T
                        yield spread(part, r, block[r], x, p, "q")

        def send_rows(batches):
            for b in batches:
                for lo in range(0, len(b), 512):
                    part = b.iloc[lo : lo + 512]
                    bucket = bucket_of(part["norm"].to_numpy())
                    times = np.where(bucket >= first, n_blocks[bucket], 0)
                    r = np.repeat(np.arange(len(part)), times)
                    if len(r):
                        nth = np.arange(len(r)) - np.repeat(np.cumsum(times) - times, times)
                        own = _mixed(part["id"].to_numpy(), 5) % np.maximum(parts[bucket], 1)
                        yield spread(part, r, by_reach[nth], bucket[r], own[r], "c")

        def run(group: pd.DataFrame) -> pd.DataFrame:
            q, c = group[group["kind"] == "q"], group[group["kind"] == "c"]
            return search_bucket(q, c, k) if len(q) and len(c) else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")

        schema = "block long, bucket long, part long, kind string, id long, v binary, norm double, theta double"
        sent = asked.select("id", "v", "norm", "theta").mapInPandas(send_queries, schema).unionByName(rows.mapInPandas(send_rows, schema))
        return sent.groupBy("block", "bucket", "part").applyInPandas(lambda g: run(g), "query_id long, vec_id long, score long")

    first = cut(pairs(asked.withColumn("theta", F.lit(float("-inf"))), top, np.full(blocks, top)))
    ranked = lambda found: found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).where(F.col("rank") <= k)
    # a score of more than 53 bits may be rounded up as a double: then a little less
    known = F.col("score").cast("double") - F.when(F.abs(F.col("score").cast("double")) >= 2.0**52, F.abs(F.col("score").cast("double")) * 2.0**-52).otherwise(F.lit(0.0))
    theta = ranked(first).where(F.col("rank") == k).select(F.col("query_id").alias("id"), known.alias("known"))
    asked = cut(asked.join(theta, "id", "left").withColumn("theta", F.when(F.col("known") > -(2.0**63), F.col("known")).otherwise(F.lit(float("-inf")))).select("id", "v", "norm", "theta"))

    def needs(batches):
        """The shortest length that the queries of a block could still use, by block."""
        for b in batches:
            norm, t = b["norm"].to_numpy(), b["theta"].to_numpy()
            with np.errstate(divide="ignore", invalid="ignore"):
                need = np.where(norm > 0, t / norm, np.where(t > 0, np.inf, -np.inf))
            yield pd.DataFrame({"block": _mixed(b["id"].to_numpy(), 3) % blocks, "need": need})

    least = np.full(blocks, np.inf)
    for r in asked.select("id", "norm", "theta").mapInPandas(needs, "block long, need double").groupBy("block").agg(F.min("need").alias("need")).collect():
        least[r["block"]] = r["need"]
    last = np.searchsorted(-reach * (1 + 1e-9), -least, side="right") - 1  # reach falls from bucket to bucket
    found = first.unionByName(pairs(asked, top + 1, last)) if (last > top).any() else first
    return ranked(found).select("query_id", "rank", "vec_id", "score")
