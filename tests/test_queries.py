"""Every registered query against its oracle."""

from __future__ import annotations

import numpy as np
import pytest

from pixelmill.oracles import ORACLES
from pixelmill.queries import QUERIES
from tests.conftest import compare


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    compare(spark, name, QUERIES[name], ORACLES[name])


def _embeddings(folder, rows) -> str:
    import pyarrow as pa
    import pyarrow.parquet as pq

    ids, vectors = zip(*rows)
    pq.write_table(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32()))}), f"{folder}/embeddings.parquet")
    return str(folder)


def test_hamming_pairs_of_odd_vectors(spark, tmp_path):
    """Values that are missing, no number or next to each other, other lengths, empty and missing vectors, ids that repeat or are missing."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(6, 70)).astype(np.float32)
    rows = [(k, (base[k % 6] + rng.normal(scale=0.2, size=70).astype(np.float32))[: (64, 64, 64, 10, 70)[k % 5]].tolist()) for k in range(120)]
    for k in range(0, 120, 7):
        rows[k][1][k % 9] = None
        rows[k + 1 if k < 119 else k][1][3] = float("nan")
    near = float(np.nextafter(np.float32(1), np.float32(2)))
    rows += [(200, [1.0, near]), (201, [near, 1.0]), (202, []), (203, None), (204, [None, None]), (5, [2.0, 1.0, 3.0]), (5, [3.0, 1.0, 2.0]), (None, [1.0, 5.0, 4.0]), (206, [0.0] * 64)]
    compare(spark, "hamming_pairs", QUERIES["hamming_pairs"], ORACLES["hamming_pairs"], _embeddings(tmp_path, rows))


def test_hamming_pairs_compares_without_a_join(spark, tmp_path):
    """Bands of seven bits make most pairs candidates: all pairs are compared by blocks, in several shards."""
    x = np.random.default_rng(4).normal(size=(9000, 64)).astype(np.float32)
    found = QUERIES["hamming_pairs"](spark, _embeddings(tmp_path, enumerate(x.tolist())))
    assert "Join" not in found._jdf.queryExecution().toString()
    bits = np.packbits(x > np.median(x, axis=1, keepdims=True), axis=1).view(np.uint64)[:, 0]
    want = {(k, k + 1 + int(j), int(d[j])) for k in range(len(bits)) for d in [np.bitwise_count(bits[k + 1 :] ^ bits[k])] for j in np.flatnonzero(d <= 16)}
    got = [tuple(r) for r in found.select("vec_a", "vec_b", "distance").collect()]
    assert len(got) == len(want) > 1000 and set(got) == want
