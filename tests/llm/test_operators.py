"""The operators on small fixtures against brute force, with nulls, empty texts, ties, repeats and odd columns."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from pixelmill.llm import bpe_fst, chat_format, fm_index, lang_id, packing, quality_rules, simhash, substring_dedup, topk_search, toxicity, url_model

GAP = re.compile(r"[\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def words_of(text):
    return [w for w in GAP.split(text or "") if w]


def odd_texts() -> list[tuple[int | None, str | None]]:
    rnd = random.Random(3)
    vocab = [f"w{k}" for k in range(40)] + ["é", "日本", "naïve,", "x\u0085y"]
    texts = [" ".join(rnd.choice(vocab) for _ in range(rnd.randrange(0, 90))) for _ in range(40)]
    passage = " ".join(f"p{k}" for k in range(50))
    texts += [texts[0], texts[1] + " tail", passage, "a " + passage + " b", passage + "\n" + passage, "z " * 300, "x y " * 60]
    rows = [(k, t) for k, t in enumerate(texts)]
    return rows + [(900, None), (901, ""), (902, " \t\n"), (903, "\U0001f600" * 500), (904, "one"), (904, "one"), (905, "long " * 30_000), (None, "no id here " + passage)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, k % 3, "clash") for k, (i, t) in enumerate(odd_texts())]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words int, id string").withColumn("words", F.lit(1)).withColumn("t", F.lit("t"))


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert quality_rules.quality(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.keep_one(empty).count() == 0
    assert substring_dedup.dedup(empty).count() == 0
    assert packing.pack(empty, lambda: packing.WordEncoder(WORDS)).count() == 0
    assert bpe_fst.encode_documents(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    assert lang_id.predict(empty, lang_id.fit(empty)).count() == 0
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.predict(empty, toxicity.fit(empty, labels)).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top_k(vectors, vectors).count() == 0
    assert chat_format.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert url_model.judge(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_quality(docs):
    got = {}
    for r in quality_rules.quality(docs).collect():
        got.setdefault(r["doc_id"], []).append(r)
    for i, text in odd_texts():
        t, w = text or "", words_of(text)
        windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        covered = {p for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
        lines = [x for x in t.split("\n") if words_of(x)]
        want = (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert want in [(r["n_words"], r["word_chars"], r["n_dup_lines"], r["n_repeat_words"]) for r in got[i]]


def test_quality_rules_by_line(spark):
    prose = "This is a plain line of prose with some words in it, and it goes on for a while longer."
    rows = [(1, prose + "\nHome | About | Contact | Login\nAll rights reserved."), (2, "Home | A | B\n" * 3 + " ".join(f"a{k} |" for k in range(30))), (3, " ".join(f"w{k}$$$" for k in range(40))), (4, " ".join(f"A{k}!!" for k in range(40)))]
    got = {r["doc_id"]: r for r in quality_rules.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["kept"] and got[1]["clean_text"] == prose and got[1]["n_removed_lines"] == 2
    assert not any(got[k]["kept"] for k in (2, 3, 4))


def test_quality_spark_and_sql_agree_on_every_rule(spark, tmp_path):
    """Each rule alone and with marks of the others, so that every planted line tips its document's verdict."""
    from pixelmill.llm.oracles import ORACLES
    from pixelmill.llm.queries import QUERIES
    from tests.conftest import compare

    prose = [" ".join(f"plain{k}x{j}" for j in range(24)) for k in range(40)]
    bad = [
        "All rights reserved. Nothing of this site may be copied without the consent that we give in writing to anybody who asks for it", "All rights reserved! See our site for what else we may have reserved in the course of the many years since then",
        "We use cookies? accept cookies & privacy policy are what this long line is about and nothing else, as you can see quite well here",
        "!" * 3, "Home | About | Contact | Login | Search | Imprint", "Home - About us - Contact - Login", "# $ % & * < > ~ ^ a", "wow!! yes!! no!!", "... --- ...", "» next → previous", "HOME", "home sweet home", "What? A fine line! It is kept.", "Read more | privacy policy",
    ]
    rows = [(k, prose[k] + "\n" + "\n".join([x] * max(1, 260 // len(x)))) for k, x in enumerate(bad)] + [(100 + k, x) for k, x in enumerate(bad)] + [(200, None), (201, ""), (202, "é " * 30_000 + "\n" + "w " * 10)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    flat = tmp_path / "flat"
    flat.mkdir()
    import pandas as pd

    pd.DataFrame(rows, columns=["doc_id", "text"]).to_parquet(flat / "documents.parquet")
    compare(spark, "op1_quality_rules", QUERIES["op1_quality_rules"], ORACLES["op1_quality_rules"], str(flat))
    got = {r["doc_id"]: r for r in quality_rules.quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    kept = {k for k, x in enumerate(bad) if not got[k]["n_removed_lines"]}
    assert {bad[k] for k in kept} == {"home sweet home", "What? A fine line! It is kept."}


def test_url_model_joins_alike_with_and_without_broadcast(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").withColumn("url", F.when(F.col("page_id") % 9 == 0, F.concat("url", F.repeat(F.lit("/long"), 5000))).otherwise(F.col("url")))
    rows = lambda p: Counter(tuple(r) for r in url_model.judge(pages, params=p).collect())
    assert rows(url_model.UrlParams()) == rows(url_model.UrlParams(broadcast_rows=0))


def test_url_rules_and_odd_urls(spark):
    rows = [(1, "https://A.Example.com/en/7?x"), (2, "http://example.com/en/8"), (3, None), (4, "no scheme/en/"), (5, "http://xexample.net/de/8"), (6, "http://example.net/de/81"), (7, "x://org/es/#f"), (7, "x://org/es/#f"), (8, "http://net"), (9, "")]
    got = [tuple(r) for r in url_model.judge(spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit(1))).select("page_id", "host", "path", "rule", "verdict").collect()]
    by = {r[0]: r for r in got}
    assert len(got) == 10
    assert by[1] == (1, "a.example.com", "/en/7", "example.com/en/7", "allow")
    assert by[2][3:] == ("com/en/", "block") and by[5][3] == "net/de/" and by[6][3] == "example.net/de/8"
    assert by[3][1:4] == ("", "", None) and by[4][1:4] == ("", "", None) and by[8][1:4] == ("net", "", None)
    assert {r[4] for r in got} <= {"allow", "block"}


def test_url_model_learns_its_sides(spark):
    good = [(k, f"http://kitten{k}.example.com/en/7{k}") for k in range(60)]
    bad = [(100 + k, f"http://zzz{k}.net/de/q{k}") for k in range(60)]
    new = [(900, "http://kitten.example.com/fr/71"), (901, "http://zzz.net/dex/q5")]
    got = {r["page_id"]: r["verdict"] for r in url_model.judge(spark.createDataFrame(good + bad + new, "page_id long, url string")).collect()}
    assert got[900] == "allow" and got[901] == "block"


def test_top_k(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(0, 0.2, (300, 16)) * rng.gamma(2, 1, (300, 1))
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(base)] + [(400 + k, [float(x) for x in base[7]]) for k in range(60)]
    rows += [(600, None), (601, [None] * 16), (602, [float("inf")] * 16), (620, [0.0] * 16), (603, [0.5] * 4), (640, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("norm", F.lit("x"))
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk_search.top_k(df, df.where("vec_id % 20 = 0"), k=20).collect()}
    v = {}
    for i, x in rows:
        if x is not None and all(c is not None and np.isfinite(c) for c in x):
            v[i] = np.zeros(16, np.int64)
            v[i][: len(x)] = np.floor(64 * np.array(x))
    want = {}
    for q in (i for i in v if i % 20 == 0):
        best = sorted(((-int(v[q] @ v[c]), c) for c in v if c != q))[:20]
        want.update({(q, k): (c, -s) for k, (s, c) in enumerate(best, 1)})
    assert got == want


@pytest.mark.parametrize("scale", [1.0, 2.0**34, 2.0**80])
def test_top_k_of_many_blocks_and_large_components(spark, monkeypatch, scale):
    """Small blocks, so that buckets have parts and queries several blocks; components beyond 2^40 and beyond a long's product."""
    monkeypatch.setattr(topk_search, "BLOCK", 24)
    rng = np.random.default_rng(7)
    base = rng.normal(0, 0.3, (240, 8)) * rng.gamma(2, 1, (240, 1))
    base[100:160] = base[100]  # many of one length
    rows = [(k, [float(x) * (scale if k % 3 else 1.0) for x in v]) for k, v in enumerate(base)] + [(k, [float(x) for x in v]) for k, v in zip((1000, 1005), ((3.0e6, 1.0), (2.5e6, 1.0)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk_search.top_k(df, df.where("vec_id % 5 = 0"), k=6).collect()}
    v = {i: [int(np.floor(64 * c)) for c in x] for i, x in rows}
    top = (1 << 63) - 1
    want = {}
    for q in (i for i in v if i % 5 == 0):
        score = {c: max(-top - 1, min(top, sum(x * y for x, y in zip(v[q], v[c])))) for c in v if c != q}
        want.update({(q, k): (c, score[c]) for k, c in enumerate(sorted(score, key=lambda c: (-score[c], c))[:6], 1)})
    assert got == want


def test_search_bucket_prunes_by_coordinate_exactly():
    import pandas as pd

    rng = np.random.default_rng(2)
    c = np.floor(64 * rng.normal(0, 1, (500, 8))).astype("<i4")
    frame = lambda x: pd.DataFrame({"id": np.arange(len(x)), "v": [r.tobytes() for r in x], "norm": np.sqrt((x.astype(float) ** 2).sum(1))})
    every = c.astype(np.int64) @ c.astype(np.int64).T
    q = frame(c[:40])
    q["id"] += 10_000
    q["theta"] = np.sort(every[:40], 1)[:, -5].astype(float)  # high thresholds: coordinate pruning
    got = topk_search.search_bucket(q, frame(c), 5)
    for row in range(40):
        want = sorted(zip(-every[row], range(500)))[:5]
        assert sorted(zip(-got[got.query_id == 10_000 + row].score, got[got.query_id == 10_000 + row].vec_id)) == want


def test_search_bucket_keeps_candidates_nearer_to_the_axis():
    import pandas as pd

    rng = np.random.default_rng(4)
    c = np.zeros((600, 32), "<i4")
    for row in c:
        row[rng.choice(32, 3, replace=False)] = np.floor(64 * rng.normal(0, 1, 3))
        row[rng.integers(0, 4)] += rng.choice([-160, 160])
    c[0], c[1] = 0, 0
    c[0, 0], c[1, :3] = 64, (58, 20, 20)
    frame = lambda x: pd.DataFrame({"id": np.arange(len(x)), "v": [r.tobytes() for r in x], "norm": np.sqrt((x.astype(float) ** 2).sum(1))})
    c = c[np.abs(c).sum(1) > 0]
    unit = np.floor(256 * c / np.sqrt((c.astype(float) ** 2).sum(1))[:, None]).astype("<i4")  # of like length: only the angle prunes
    q = frame(unit[:60])
    q["id"] += 10_000
    every = unit.astype(np.int64) @ unit.astype(np.int64).T
    for t in (0.5, 0.6, 0.8, 0.95):
        q["theta"] = t * q["norm"] * frame(unit)["norm"].max()
        got = topk_search.search_bucket(q, frame(unit), 600)
        for row in range(60):
            want = {(k, int(every[row, k])) for k in range(len(unit)) if every[row, k] >= q["theta"][row]}
            own = got[got["query_id"] == 10_000 + row]
            assert set(zip(own["vec_id"], own["score"])) == want


def test_chat_round_trip(spark):
    own = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "user", own), (1, 1, "assistant", own), (1, 2, "assistant", None), (1, 2, "assistant", "a\\<|im_sep|>\\l<"), (2, 5, "us\ner", "\\\\n\n"), (2, 1, None, ""), (None, 0, "assistant", "x"), (3, 0, "assistant", "y"), (3, 0, "assistant", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("merged", F.lit(1))
    f = chat_format.format_conversations(df)
    got = {r["conv_id"]: r for r in chat_format.read_back(f).collect()}
    by: dict = {}
    for c, t, r, x in sorted(((a, b, c or "", d or "") for a, b, c, d in rows), key=lambda x: (x[0] is None, x[0] or 0, *x[1:])):
        by.setdefault(c, []).append((r, x, r == "assistant"))
    assert {c: [tuple(t) for t in r["turns"]] for c, r in got.items()} == by
    merged = {r["conv_id"]: r["n_merged"] for r in f.collect()}
    assert merged == {1: 2, 2: 2, 3: 1, None: 1}
    for r in f.collect():  # the runs lead through the whole text, and the mask lies on the assistant's texts alone
        at, learned = 0, []
        for run in r["loss_runs"]:
            at += run["lead"]
            learned += [r["formatted"][at : at + run["size"]]] if run["loss"] else []
            at += run["size"]
        assert r["formatted"][at:] == "<|im_end|>\n"
        assert learned == [x.replace("\\", "\\\\").replace("<", "\\l") for _, x, own in by[r["conv_id"]] if own]


def test_chat_mask_is_read_from_the_runs_and_must_fit(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "ab"), (2, 0, "assistant", "long " * 60_000), (2, 1, "user", "\U0001f600<" * 20_000)]
    f = chat_format.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    digests = {r["conv_id"]: (r["loss_chars"], r["n_turns"]) for r in chat_format.digest(chat_format.read_back(f)).collect()}
    assert digests == {1: (2, 2), 2: (300_000, 2)}
    turned = f.withColumn("loss_runs", F.transform("loss_runs", lambda x: x.withField("loss", ~x["loss"])))
    assert {r["conv_id"]: r["loss_chars"] for r in chat_format.digest(chat_format.read_back(turned)).collect()} == {1: 1, 2: 40_000}
    cut_off = f.withColumn("loss_runs", F.transform("loss_runs", lambda x: x.withField("size", x["size"] + 1)))
    with pytest.raises(Exception, match="does not fit"):
        chat_format.read_back(cut_off).collect()


def brute_windows(rows, size):
    split = [words_of(t) for _, t in rows]
    seen = Counter(tuple(w[k : k + size]) for w in split for k in range(len(w) - size + 1))
    for (i, _), w in zip(rows, split):
        gone = np.zeros(len(w), bool)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = True
        yield i, len(w), int(gone.sum()), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()


@pytest.mark.parametrize("hot", [substring_dedup.HOT, 1])
def test_substrings(docs, hot):
    got = Counter(tuple(r) for r in substring_dedup.dedup(docs, hot=hot, digest=True).collect())
    assert got == Counter(brute_windows([(i, t) for i, t in odd_texts()], 35))


def test_substrings_of_many_copies(spark):
    """Spans do not grow with the copies, and copies meet a passage in other texts."""
    rnd = random.Random(4)
    text = lambda n: " ".join(f"c{rnd.randrange(10**6)}" for _ in range(n))
    copy, passage = text(400), text(45)
    rows = [(None, copy)] * 300 + [(7, copy)] * 20 + [(k, f"{text(20)} {passage} {text(20)}") for k in range(40)] + [(900, text(10) + " " + " ".join(copy.split()[100:150])), (901, text(60)), (902, "short one"), (902, "short one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = Counter(tuple(r) for r in substring_dedup.dedup(df, digest=True).collect())
    assert got == Counter(brute_windows(rows, 35))
    spans = substring_dedup.repeated(substring_dedup._keyed(df, "text", []))
    assert max(len(r["spans"]) for r in spans.collect()) <= 60


def test_without_repeats_carries_odd_columns(spark):
    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(1, "one " + passage, "x", 5, [1]), (2, passage + " two", None, None, None), (3, None, "y", 1, []), (4, passage, "z", 2, [])]
    df = spark.createDataFrame(rows, "doc_id long, text string, others string, n_removed int, `odd name` array<int>").withColumns({c: F.lit(c) for c in ("h1", "spans", "whole", "made", "key")})
    got = substring_dedup.without_repeats(df)
    assert got.columns == df.columns
    assert Counter((r["doc_id"], r["text"], r["others"], r["n_removed"], r["key"]) for r in got.collect()) == Counter([(1, "one", "x", 5, "key"), (2, "two", None, None, "key"), (3, None, "y", 1, "key")])


def test_fm_index_finds_maximal_repeats():
    rng = np.random.default_rng(5)
    texts = [rng.integers(1, 4, rng.integers(5, 40)) for _ in range(30)]
    index = fm_index.FMIndex(texts, np.zeros(30, bool), 64)
    seen = Counter(tuple(t[k : k + 6]) for t in texts for k in range(len(t) - 5))
    want = {(k, p) for k, t in enumerate(texts) for s in range(len(t) - 5) if seen[tuple(t[s : s + 6])] > 1 for p in range(s, s + 6)}
    assert {(int(w), p) for w, a, b in zip(*index.repeats(texts, 6, 7)) for p in range(a, b)} == want


def test_packing(spark, docs):
    df = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise("b"))
    rows = packing.pack(df, lambda: packing.WordEncoder(WORDS), docs_per_bucket=20).collect()
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    tok.encode_special_tokens = True
    want = Counter((i, *tok.encode(t or "", add_special_tokens=False).ids, 1) for i, t in odd_texts())
    sequences: dict[int, list] = {}
    parts: dict = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append(r)
        parts.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    for pieces in sequences.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == np.cumsum([0, *[r["length"] for r in pieces][:-1]]).tolist()
        n = sum(r["length"] for r in pieces)
        assert n == 2048 or n & (n - 1) == 0
    got = Counter()
    for (i, n), pieces in parts.items():
        pieces.sort(key=lambda r: r["start"])
        copies = sum(r["length"] for r in pieces) // n
        for _ in range(copies):
            ids, at = [], 0
            while at < n:
                piece = next(r for r in pieces if r["start"] == at)
                pieces.remove(piece)
                ids += np.frombuffer(piece["ids"], "<u4").tolist()
                at += piece["length"]
            got[(i, *ids)] += 1
    assert got == want


def test_fill_keeps_the_mixture():
    sizes, shares = {"a": 60_000, "b": 30_000, "c": 10_000}, {"a": 0.6, "b": 0.3, "c": 0.1}
    for sequence in packing.fill(dict(sizes), shares, dict.fromkeys(sizes, 0.0), 2048, 64)[:40]:
        own = Counter()
        for s, n in sequence:
            own[s] += n
        assert sum(own.values()) == 2048 and all(abs(own[s] - shares[s] * 2048) <= 130 for s in sizes)


def test_packing_fills_windows_to_given_targets(spark):
    """Of a (nine tenths of all tokens) and b, targets of one half each: windows hold both alike until b runs dry."""

    class Counting:
        def texts(self, texts):
            return [np.arange(len(x.split())) for x in texts]

    rows = [(k, "t " * 99, "b" if k % 10 == 0 else "a") for k in range(2000)] + [(5000, "t " * 99, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    pieces = packing.pack(df, Counting, docs_per_bucket=100, targets={"a": 0.5, "b": 0.5}).cache()
    by: dict = {}
    for r in pieces.collect():
        by.setdefault(r["sequence_id"], Counter())[r["source"]] += r["length"]
    both = [c for i, c in by.items() if i >> 32 < 3]  # 40,000 tokens, all of b are 20,000
    assert all(abs(c["a"] - c["b"]) <= 0.25 * sum(c.values()) for c in both if sum(c.values()) == 2048)
    assert sum(c["b"] for i, c in by.items() if i >> 32 > 4) == 0
    got = {r["source"]: r["tokens"] for r in packing.mixture(pieces).collect()}
    assert got == {"a": 180_000, "b": 20_000, None: 100}
    assert max(i >> 32 for i in by) >= 18 and {i >> 32 for i, c in by.items() if c[None]} == {20_000 * 10 // 10_000}


def test_packing_is_the_same_without_a_broadcast(spark, docs):
    df = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 7 == 0, F.lit(None)).otherwise("b"))
    make = lambda n: packing.pack(df, lambda: packing.WordEncoder(WORDS), docs_per_bucket=20, broadcast_bytes=n).drop("ids")
    near, far = make(1 << 20), make(-1)
    assert near.count() == far.count() > 0
    assert near.exceptAll(far).count() == 0


def test_packing_spreads_equal_ids_and_keeps_wide_ids(spark):
    class Wide:
        def texts(self, texts):
            return [np.full(len(x), 70_000 + len(x)) for x in texts]

    df = spark.createDataFrame([(None, "x" * 500, "s")] * 400 + [(7, None, "s")] * 400, "doc_id long, text string, source string")
    rows = packing.pack(df, Wide, docs_per_bucket=50).collect()
    assert len({r["sequence_id"] >> 32 for r in rows}) >= 10
    assert sum(r["length"] for r in rows) == 400 * 501 + 400
    assert {70_500, 1} == {int(x) for r in rows for x in np.frombuffer(r["ids"], "<u4")}


def test_word_encoder_matches_the_tokenizer():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(WORDS)
    tok.encode_special_tokens = True
    texts = [t or "" for _, t in odd_texts()] + ["Σίσυφος ΣΑΣ İ ﬁ", "a\x00b 'Don't I'LL", "\u0301 x\u0301", "<|endoftext|> 12 345"]
    assert [x.tolist() for x in packing.WordEncoder(WORDS).texts(texts)] == [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]


def plain_fingerprint(text, n=3, seed=42):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + n]), seed) for k in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs):
    rows = odd_texts()
    fps = [plain_fingerprint(t) for _, t in rows]
    ids = [k for k, (i, _) in enumerate(rows) if i is not None]
    parent = {k: k for k in ids}
    for a in ids:
        for b in ids:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                old, new = parent[a], parent[b]
                parent = {k: new if p == old else p for k, p in parent.items()}
    least, by_fp = {}, {}
    for k in ids:
        least[parent[k]] = min(rows[k][0], least.get(parent[k], rows[k][0]))
    for k in ids:
        by_fp[fps[k]] = least[parent[k]]
    want = Counter((i, f.to_bytes(8, "big"), by_fp.get(f)) for (i, _), f in zip(rows, fps))
    assert Counter((r["doc_id"], bytes(r["fp"]), r["component_id"]) for r in simhash.near_duplicates(docs).collect()) == want


def test_simhash_links_through_rows_without_an_id(spark, monkeypatch):
    """Fingerprints 0, 3 and 15: the middle one has no id, and without it the outer two are not linked."""
    prints = {"a": 0, "b": 3, "c": 15, "d": 0xFFFF << 40}
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *a: docs.select(F.col("doc_id").alias("id"), F.unhex(F.lpad(F.hex("n"), 16, "0")).alias("fp"), F.col("n").alias("key")))
    rows = [(5, prints["a"]), (None, prints["b"]), (2, prints["c"]), (9, prints["d"]), (None, prints["d"])]
    got = Counter((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, n long")).collect())
    assert got == Counter([(5, 2), (None, None), (2, 2), (9, 9), (None, 9)])


@pytest.mark.parametrize("parts", [4, 8, 16])
def test_simhash_parts_and_blocks_find_the_links_of_brute_force(spark, monkeypatch, parts):
    monkeypatch.setattr(simhash, "TILE_ROWS", 20)
    monkeypatch.setattr(simhash, "GROUP_ROWS", 500)
    rng = np.random.default_rng(3)
    fps = {0, 2**64 - 1}
    for center in [int(x) for x in rng.integers(0, 2**63, 12)]:
        for _ in range(25):
            x = center
            for b in rng.integers(0, 64, rng.integers(0, 4)):
                x ^= 1 << int(b)
            fps.add(x)
    fps |= {3 << k for k in range(60)}  # one tile of many rows
    fps = sorted(fps)
    df = spark.createDataFrame([(x.to_bytes(8, "big"), k) for k, x in enumerate(fps)], "fp binary, id long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash._part_links(df, 2, parts)).collect()}
    label = list(range(len(fps)))
    for a in range(len(fps)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 2 and label[a] != label[b]:
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    assert [roots.get(k, k) for k in range(len(fps))] == label


def test_simhash_ranges_find_the_links_of_brute_force(spark):
    rng = np.random.default_rng(8)
    centers = rng.integers(0, 2**63, (40, 2), dtype=np.int64).astype(np.uint64)
    fps = []
    for c in centers:
        for _ in range(30):
            x = c.copy()
            for b in rng.integers(0, 128, rng.integers(0, 16)):
                x[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
            fps.append(x)
    fps = np.unique(np.array(fps), axis=0)
    df = spark.createDataFrame([(x.tobytes(), k) for k, x in enumerate(fps)], "fp binary, id long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(df, 10, 2)).collect()}
    label = np.arange(len(fps))
    near = sum(np.bitwise_count(fps[:, None, k] ^ fps[None, :, k]) for k in range(2)) <= 10
    while True:
        new = np.array([label[near[k]].min() for k in range(len(fps))])
        if (new == label).all():
            break
        label = new
    assert [roots.get(k, k) for k in range(len(fps))] == label.tolist()


def test_keep_one_catches_near_copies_and_keeps_the_rest(spark):
    rnd = random.Random(2)
    text = lambda n: [f"v{rnd.randrange(3000)}" for _ in range(n)]
    rows, base = [], text(300)
    for k in range(20):
        w = list(base)
        for _ in range(3):
            w[rnd.randrange(300)] = "changed"
        rows.append((k, " ".join(w)))
    rows += [(100 + k, " ".join(text(200))) for k in range(60)]
    rows += [(None, rows[0][1]), (None, "alone"), (0, rows[0][1])]
    kept = Counter(r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert kept == Counter([0, None, None, *range(100, 160)])


def brute_keep_one(rows):
    """Of each component of five-word-shingle Jaccard 0.8 or more the smallest (id, text), null ids aside."""
    named = sorted({(i, t or "") for i, t in rows if i is not None})
    sets = []
    for _, t in named:
        w = t.encode().lower().split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    label = list(range(len(named)))
    for a in range(len(named)):
        for b in range(a):
            if sets[a] == sets[b] or 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    least = {}
    for k, x in enumerate(label):
        least.setdefault(x, named[k][0])
    return Counter([*least.values(), *(None for i, _ in rows if i is None)])


def near_pairs() -> list[tuple[int | None, str | None]]:
    """Pairs of similarity 0.55 to 0.95, short texts, repeats, one id twice, null ids and texts."""
    rnd = random.Random(12)
    text = lambda n: [f"u{rnd.randrange(100_000)}" for _ in range(n)]
    rows = []
    for k in range(90):
        w = text(rnd.choice([60, 120, 300]))
        other = list(w)
        for at in rnd.sample(range(len(w)), max(1, round(len(w) * rnd.uniform(0.005, 0.09)))):
            other[at] = "other"
        rows += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(other))]
    for k in range(40):  # of 1 to 12 shingles, one more in the second
        w = text(5 + k % 12)
        rows += [(500 + 2 * k, " ".join(w)), (501 + 2 * k, " ".join([*w, "more"]))]
    w = text(40)
    rows += [(700, " ".join(w)), (701, " ".join(w * 5)), (702, " ".join(w).upper()), (703, " ".join(w[:39]))]
    rows += [(800, " ".join(text(50))), (800, " ".join(text(50))), (801, "one"), (802, "one"), (803, "two"), (804, None), (805, ""), (806, " \n"), (None, None), (None, "one")]
    return rows


@pytest.mark.parametrize("part", [simhash.PART, 3])
def test_keep_one_drops_what_brute_force_drops(spark, monkeypatch, part):
    monkeypatch.setattr(simhash, "PART", part)
    rows = near_pairs()
    w = [f"g{k}" for k in range(100)]
    rows += [(900 + k, " ".join([*w[: k % 25], f"own{k}", *w[k % 25 :]])) for k in range(25)]  # one component of many pairs
    want = brute_keep_one(rows)
    assert 150 < sum(want.values()) < len(rows) - 60
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert Counter(r["doc_id"] for r in got.collect()) == want


def test_byte_bpe(spark, docs):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe_fst.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    got = Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), bytes(r["decoded"])) for r in bpe_fst.decode_documents(encoded, RANKS, chunk=7).collect())
    want = Counter()
    for i, t in odd_texts():
        ids = enc.encode_ordinary(t or "")
        want[(i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode())] += 1
    assert got == want
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert Counter(tuple(r) for r in bpe_fst.round_trip(docs, RANKS, public_tokenizers.PATTERN).collect()) == Counter({(i, n, sha(a), sha(b)): c for (i, n, a, b), c in want.items()})
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("aeinrst lo'.\n  é日") for _ in range(80)) for _ in range(400)]
    own = bpe_fst.encoder(RANKS, public_tokenizers.PATTERN)
    assert [x.tolist() for x in own.texts(texts)] == enc.encode_ordinary_batch(texts)


def test_streaming_decoder_gives_whole_characters():
    d = bpe_fst.decoder(RANKS)
    ids = bpe_fst.encoder(RANKS, public_tokenizers.PATTERN).texts(["a\U0001f600日é" * 20])[0]
    d.reset()
    parts = [d.feed(ids[k : k + 1]) for k in range(len(ids))]
    assert "".join(p.decode() for p in parts) == "a\U0001f600日é" * 20 and d.end() == b""


def test_language_gradients():
    rng = np.random.default_rng(0)
    H = lang_id.HIDDEN
    m = lang_id.Model(("a", "b"), *(rng.normal(0, 0.5, s).astype(np.float64) for s in ((2, 256, 3 * H), (2, H, 3 * H), (2 * H, 2), (2,))))
    x, y = rng.integers(0, 256, (6, 3)).astype(np.uint8), np.array([0, 1, 1])
    grad, loss = lang_id._gradients(m, x, y)
    for name, at in (("rec", (0, 2, 5)), ("rec", (1, 3, 2 * H + 1)), ("out", (4, 1)), ("emb", (0, int(x[2, 1]), H + 2)), ("emb", (1, int(x[4, 0]), 1))):
        p = getattr(m, name)
        p[at] += 1e-3
        up = lang_id._gradients(m, x, y)[1]
        p[at] -= 2e-3
        down = lang_id._gradients(m, x, y)[1]
        p[at] += 1e-3
        assert abs((up - down) / 2e-3 - grad[name][at]) < 2e-3


def plain_language(m, data):
    """One byte after the other, window by window, no padding."""
    H, sums = lang_id.HIDDEN, np.zeros(len(m.langs))
    sig = lambda x: 1 / (1 + np.exp(-x))
    for lo in range(0, len(data), lang_id.SPAN):
        part = data[lo : lo + lang_id.SPAN]
        states = np.zeros((2, len(part), H))
        for d in (0, 1):
            h = np.zeros(H)
            for t in range(len(part)) if d == 0 else range(len(part) - 1, -1, -1):
                g, r = m.emb[d][part[t]], h @ m.rec[d]
                z, s = sig(g[:H] + r[:H]), sig(g[H : 2 * H] + r[H : 2 * H])
                h = h + z * (np.tanh(g[2 * H :] + s * r[2 * H :]) - h)
                states[d, t] = h
        logits = np.concatenate([states[0], states[1]], 1) @ m.out + m.bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        sums += (p / p.sum(1, keepdims=True)).sum(0)
    return sums / len(data)


def test_language_equals_a_plain_loop():
    rng = np.random.default_rng(5)
    H = lang_id.HIDDEN
    m = lang_id.Model(("a", "b", "c"), *(rng.normal(0, 0.5, s).astype(np.float32) for s in ((2, 256, 3 * H), (2, H, 3 * H), (2 * H, 3), (3,))))
    texts = [bytes(rng.integers(1, 256, n).astype(np.uint8)) for n in (1, 2, 5, 48, 127, 128, 129, 200, 256, 300)]
    got = lang_id._document_probabilities(m, texts)
    assert np.allclose(got, [plain_language(m, x) for x in texts], atol=1e-4)


def test_language_of_few_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang_id.fit(docs)
    held = [(r["text"], r["lang"]) for r in docs.where(lang_id.held_out() & F.col("text").rlike("[a-z]") & F.col("lang").isNotNull()).select("text", "lang").collect()]
    for n, least in ((2, 0.9), (4, 0.95), (8, 0.97)):
        found = lang_id.label_texts(model, [" ".join(t.split()[:n]) for t, _ in held])
        assert np.mean([a == lang for (a, _), (_, lang) in zip(found, held)]) >= least, n


def test_samples_keep_their_bounds(spark):
    """The bounds are of rows, however many documents share an id."""
    rows = [(k % 3, f"text number {k} of a language", "ab"[k % 2]) for k in range(400)] + [(None, "text", "a"), (5, "  12 ", "a"), (6, None, "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = lang_id.sampled(docs, "doc_id", "text", "lang", F.col("doc_id").isNotNull(), per_lang=30, rows=50).collect()
    assert Counter(r["lang"] for r in got) == {"a": 25, "b": 25}
    labels = spark.createDataFrame([(k, k % 2, 1 - k % 2) for k in range(3)], "doc_id long, quality int, toxic int")
    made = []
    real = toxicity.train
    toxicity.train = lambda sets, dense, labels, folds: made.append(len(sets)) or real(sets, dense, labels, folds)
    try:
        toxicity.fit(docs, labels, rows=2)
    finally:
        toxicity.train = real
    assert made == [2]


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = lang_id.fit(docs)
    rows = lang_id.predict(docs.withColumn("lang_score", F.lit("clash")), model).where(lang_id.held_out()).select("lang", "lang_pred", "lang_score").collect()
    assert len(rows) > 100 and np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (None, "the and of"), (5, "é" * 100_000)], "doc_id long, text string")
    got = {r["doc_id"]: (r["lang_pred"], r["lang_score"]) for r in lang_id.predict(odd, model).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and got[None][0] in model.langs and 0 <= got[5][1] <= 1
    assert lang_id.keep_known(odd, model).columns == odd.columns


def test_language_stage_drops_unlearned_scripts(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    strange = ["Это обычный русский текст о погоде. " * 5, "今天天气很好，我们去公园散步。" * 8, "Η Ελλάδα είναι μια όμορφη χώρα. " * 5, "هذا نص عربي عادي عن الطقس والمدينة. " * 6, "यह एक सामान्य हिंदी पाठ है। " * 8]
    new = spark.createDataFrame([(10**9 + k, t, None) for k, t in enumerate(strange)], docs.schema)
    left = corpus_pipeline.language(spark, docs.unionByName(new), "").select("doc_id").collect()
    assert not [r for r in left if r["doc_id"] >= 10**9]
    assert len(left) >= 0.99 * docs.count()


def test_toxicity_chain(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("p_toxic", F.lit("clash"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    chain = toxicity.fit(docs, labels)
    assert chain.categories == ("low_quality", "toxic") and len(chain.links[1].dense) == 7
    found = toxicity.predict(docs, chain).join(labels, "doc_id").select("toxic", "p_toxic", "quality", "p_low_quality").collect()
    called = [r["p_toxic"] >= chain.thresholds[1] for r in found]
    hits = sum(c and r["toxic"] for c, r in zip(called, found))
    assert hits >= 0.6 * sum(r["toxic"] for r in found) and sum(c and not r["toxic"] for c, r in zip(called, found)) <= 0.05 * len(found)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "x" * 200_000)], "doc_id long, text string")
    assert toxicity.predict(odd, chain).count() == 3


def test_toxicity_learns_from_whole_texts(spark):
    import zlib

    rnd = random.Random(6)
    letters = "abcdefghij"
    spell = lambda k: "".join(letters[int(c)] for c in str(k))
    vocab = [spell(k) for k in range(1000, 3000)]
    marker = max((spell(k) for k in range(5000, 9000)), key=lambda w: zlib.crc32(w.encode()))
    texts = [rnd.sample(vocab, 700) + [marker] * (k % 5 == 0) for k in range(200)]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 7 > 0), int(k % 5 == 0)) for k in range(200)], "doc_id long, quality int, toxic int")
    chain = toxicity.fit(docs, labels)
    assert marker in chain.links[1].words
    drawn = sorted((r["d"], r["doc_id"]) for r in labels.select("doc_id", F.xxhash64(F.lit(17), F.col("doc_id")).alias("d")).collect())
    whole = [" ".join(texts[k]) for _, k in drawn]
    y = {"low_quality": np.array([float(k % 7 == 0) for _, k in drawn]), "toxic": np.array([float(k % 5 == 0) for _, k in drawn])}
    want = toxicity.train([toxicity._words(x) for x in whole], np.array([toxicity.surface(x) for x in whole]), y, np.array([(d >> 7) % toxicity.FOLDS for d, _ in drawn]))
    assert [x.words.keys() for x in chain.links] == [x.words.keys() for x in want.links] and chain.thresholds == want.thresholds
    assert all(np.allclose(list(a.words.values()), list(b.words.values())) and np.allclose(a.dense, b.dense) for a, b in zip(chain.links, want.links))


def test_pipeline_stages(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.store(stage(spark, before, sf))
        assert after.columns == docs.columns and 0 < after.count() <= before.count(), name
        before = after
    left = [(r["doc_id"], r["text"]) for r in before.collect()]
    packed = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {i for i, _ in left}


def test_pipeline_stages_with_odd_rows(spark):
    """Null and equal ids, repeated rows, null, empty and very long texts, clashing columns, and no rows at all."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    real = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").limit(60)
    odd = [(None, "no id", None, None, 5), (None, "no id", None, None, 5), (7, "one id, this text", None, "s", None), (7, "one id, other text", "en", None, 0), (8, "twice the same", "en", "s", 1), (8, "twice the same", "en", "s", 1), (10**9, None, None, None, None), (10**9 + 1, "", "", "", 0), (10**9 + 2, "long words " * 60_000, "en", "s", 1)]
    clash = ["n_words", "n_removed", "kept_text", "others", "made", "doc", "id", "hash", "node", "fp", "rank", "key", "p_toxic", "_p_toxic", "lang_pred", "task", "before", "bucket", "place", "share", "name", "ids", "spans"]
    docs = real.unionByName(spark.createDataFrame(odd, real.schema)).withColumns({c: F.lit("clash") for c in clash})
    docs = corpus_pipeline.store(docs)
    rows = lambda df: Counter(tuple(r) for r in df.select("doc_id", "text", "source").collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.store(stage(spark, docs, sf))
        assert out.columns == docs.columns, name
        assert out.count() <= docs.count() and out.where("ids <> 'clash'").isEmpty(), name
        if name != "repeated_passages":
            assert not rows(out) - rows(docs), name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), sf).count() == 0


def test_recall_of_candidates_at_the_least_similarity(spark):
    """Pairs of similarity 0.8 to 0.83 are candidates, whatever bands of sizes and tiles they fall in."""
    rnd = random.Random(21)
    rows, pairs = [], []
    while len(pairs) < 150:
        w = [f"q{rnd.randrange(10**6)}" for _ in range(rnd.choice([40, 90, 200]))]
        other = list(w)
        for at in rnd.sample(range(len(w)), max(1, len(w) // 45)):
            other[at] = f"q{rnd.randrange(10**6)}"
        a, b = ({tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in (w, other))
        if 0.8 <= len(a & b) / len(a | b) <= 0.83:
            pairs.append((len(rows), len(rows) + 1))
            rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(other))]
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {a for a, _ in pairs}


def test_repeated_passages_keep_rows_without_an_own_id(spark):
    import corpus_pipeline

    passage = " ".join(f"p{k}" for k in range(40))
    rows = [(None, "one " + passage), (None, passage + " two"), (None, "three"), (None, "three"), (None, None), (7, "seven " + passage), (7, "eight"), (8, passage)]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in rows], "doc_id long, text string, n_chars long")
    got = Counter(tuple(r) for r in corpus_pipeline.repeated_passages(spark, docs, "").collect())
    assert got == Counter([(None, "one", 3), (None, "two", 3), (None, "three", 5), (None, "three", 5), (None, None, 0), (7, "seven", 5), (7, "eight", 5)])


def test_pipeline_stages_3_to_5_against_brute_force(spark):
    import corpus_pipeline
    from tokenizers import Tokenizer

    passage = " ".join(f"p{k}" for k in range(40))
    rows = near_pairs() + [(950 + k, f"{' '.join(f'own{k}x{j}' for j in range(30 + k))} {passage}") for k in range(6)] + [(None, "null " + passage), (990, passage)]
    docs = spark.createDataFrame([(i, t, len(t or ""), "ab"[k % 2]) for k, (i, t) in enumerate(rows)], "doc_id long, text string, n_chars long, source string")

    def left(df):
        return [(r["doc_id"], r["text"]) for r in df.collect()]

    third = corpus_pipeline.store(corpus_pipeline.near_duplicates(spark, docs, ""))
    after = left(third)
    assert Counter(i for i, _ in after) == brute_keep_one(rows) and not Counter(after) - Counter(rows)

    fourth = corpus_pipeline.store(corpus_pipeline.repeated_passages(spark, third, ""))
    seen = Counter(tuple(w[k : k + 35]) for _, t in after for w in [words_of(t)] for k in range(len(w) - 34))
    want = Counter()
    for i, t in after:
        w = words_of(t)
        gone = {p for k in range(len(w) - 34) if seen[tuple(w[k : k + 35])] > 1 for p in range(k, k + 35)}
        if not gone or len(gone) < len(w):
            want[i, " ".join(x for p, x in enumerate(w) if p not in gone) if gone else t] += 1
    assert Counter(left(fourth)) == want and sum(want.values()) < len(after)

    tok = Tokenizer.from_file(WORDS)
    tok.encode_special_tokens = True
    tokens = Counter()
    for (i, t), n in want.items():
        tokens[i] += n * (len(tok.encode(t or "", add_special_tokens=False).ids) + 1)
    got = Counter()
    for r in corpus_pipeline.packed(spark, fourth, "").collect():
        got[r["doc_id"]] += r["length"]
    assert got == tokens


def test_windows_hold_every_byte():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 6, 7, 11, 47, 48, 185, 186, 187, 1000, 2003):
        data = bytes(rng.integers(0, 256, n).astype(np.uint8))
        for phase in range(7):
            found = lang_id.windows_of(data, phase)
            assert all(x.shape[1] == size for size, x in found.items())
            assert n <= sum(x.size for x in found.values()) <= n + 5
            assert all(bytes(w) in data for x in found.values() for w in x)
            counts = sum((np.bincount(x.ravel(), minlength=256) for x in found.values()), np.zeros(256, int))
            assert (counts >= np.bincount(np.frombuffer(data, np.uint8), minlength=256)).all()


def test_language_stage_learns_from_all_rows(spark):
    """A language's second script stands in none of the 300 rows of the lowest hashes, neither of those learned nor of those held out."""
    import corpus_pipeline

    rnd = random.Random(8)
    kinds = {"x": ["kala mutu vesi", "talo puro lumi"], "y": ["straat boek zon", "brood weg huis"]}
    rows = [(k, " ".join(rnd.choices(" ".join(kinds[lang]).split(), k=8)) + f" {k}", lang) for k in range(9000) for lang in ["xy"[k % 2]]]
    rows += [(10_000 + k, " ".join(rnd.choices("νερό σπίτι χιόνι δρόμος ήλιος".split(), k=8)) + f" {k}", "x") for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    draw = F.xxhash64(F.lit(11), "doc_id", "text")
    docs = docs.where((draw < 0) == (F.col("doc_id") < 10_000)).cache()
    by = {(r["lang"], r["held"], r["second"]): r["count"] for r in docs.groupBy("lang", lang_id.held_out().alias("held"), (F.col("doc_id") >= 10_000).alias("second")).count().collect()}
    assert min(by["x", held, False] for held in (True, False)) > lang_id.SAMPLE and min(by["x", held, True] for held in (True, False)) > 50
    left = corpus_pipeline.language(spark, docs, "").where("doc_id >= 10000").count()
    assert left >= 0.98 * docs.where("doc_id >= 10000").count()
    model = lang_id.fit_all(docs)
    found = lang_id.label_texts(model, [r["text"] for r in docs.where("doc_id >= 10000").collect()])
    assert np.mean([lang == "x" for lang, _ in found]) > 0.95


def test_toxicity_stage_learns_from_all_rows(spark, tmp_path, monkeypatch):
    """The toxic word stands in none of the 6,000 rows of the lowest hashes; within them the sums give what one fit gives."""
    import corpus_pipeline

    rnd = random.Random(9)
    n = 7500
    order = [r["id"] for r in spark.range(n).orderBy(F.xxhash64(F.lit(17), "id")).collect()]
    late = set(order[toxicity.SAMPLE :: 4])
    rows = [(k, " ".join(rnd.choices("an old road runs by the river and a mill".split(), k=12)) + " zorp" * (k in late)) for k in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(rnd.random() < (0.9 if k in late else 0.3))) for k in range(n)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(toxicity, "keep_clean", lambda docs, chain: chain)
    a, b = corpus_pipeline.clean(spark, docs, str(tmp_path)), toxicity.fit(docs, labels, rows=n)
    assert "zorp" in a.links[1].words
    p = toxicity.score_texts(a, ["an old road runs by the river zorp", "an old road runs by the river"])[:, 1]
    assert p[0] > 0.8 and p[1] < 0.4
    assert a.thresholds == b.thresholds and all(x.words.keys() == y.words.keys() for x, y in zip(a.links, b.links))
    assert all(np.allclose([*x.words.values(), *x.dense, x.bias], [*(y.words[w] for w in x.words), *y.dense, y.bias], atol=1e-6) for x, y in zip(a.links, b.links))
    nothing = toxicity.fit_all(docs.limit(0), labels)
    assert nothing.thresholds == toxicity.fit(docs.limit(0), labels).thresholds and (toxicity.score_texts(nothing, ["zorp"]) < 0.01).all()
