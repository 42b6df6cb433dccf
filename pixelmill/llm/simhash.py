"""SimHash near-duplicates by tiled exact comparison.

Fingerprint: texts in lower case (A-Z only), word shingles with repeats, XXH64 of each; a bit is 1 if it is set
in over half the hashes.  A second lane of 64 bits takes the next seed.  Fingerprints of equal value are one
class; only distinct fingerprints are compared.

Tiles hold fingerprints of like population counts.  Two fingerprints at distance d differ by d or less in their
population counts, so tile pairs whose counts differ beyond the radius are skipped unread; in the others every
pair is compared by exclusive-or and bit counts in numpy blocks of bounded size.
- Up to radius 2 a tile is the vector of counts of 4, 8 or 16 equal parts, more for more fingerprints, and only tiles
  at L1 distance 2 or less meet: at most 21, 73 or 273 copies of a fingerprint.  A tile of more than ``TILE_ROWS``
  rows is cut into blocks.
- Beyond, tiles are ranges of the total count of at most 65,536 rows, in bands of set sizes where sizes bound the
  similarity, and work grows with the square of the number of distinct fingerprints, less what counts and sizes skip.
Of the links found in a tile pair only a spanning forest leaves the task, so a group of near copies never
becomes all its pairs.

Scale: documents are read once, in one narrow pass; shuffles carry fingerprints, tiles and forest edges.
Components are found by alternating star contraction on the edges with checkpoints between the rounds; nothing
is collected but a histogram of population counts (by band of set sizes).

Defined results: a null or empty text, or one without words, has fingerprint zero and is linked like any other;
with fewer words than a shingle the whole sequence is the only shingle.  Equal texts share a class whatever
their number.  Rows with a null id take part: they link others, and are returned with the component of their class if
that has ids, else with null.  Other columns are ignored, whatever their names; an empty table gives none.

``keep_one`` takes such links as candidates alone and verifies them on the whole shingle sets before it drops a text.
Sets are sent for members of candidate components only, in pieces of at most ``PART`` members of each side.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pixelmill.functions.graph import components
from pixelmill.llm.common import cut, shuffle_width, slices

SEED = 42
BLOCK = (256, 2048)
TILE_ROWS = 65_536
MIN_TILES = 24
#: Rows that meet in one group of narrow tiles.
GROUP_ROWS = 100_000
CHUNK = 50_000
#: Most members of a candidate component that are compared in one piece.
PART = 512
PART_SHINGLES = 1_000_000


def fingerprint(text: str | None, shingle: int = 3, lanes: int = 1) -> bytes:
    """SimHash of a whole text, 8 bytes a lane, in chunks of bounded memory."""
    words = (text or "").encode().lower().split()
    if not words:
        return bytes(8 * lanes)
    counts, total = np.zeros(64 * lanes, np.int64), 0
    last = max(1, len(words) - shingle + 1)
    for at in range(0, last, CHUNK):
        part = words[at : min(at + CHUNK, last) + shingle - 1]
        line = b" ".join(part)
        ends = list(itertools.accumulate(map(len, part)))
        k = min(shingle, len(part)) - 1
        # word i starts at (length of the words before) + i spaces and ends its own length later
        shingles = [line[s + i : e + i + k] for i, (s, e) in enumerate(zip([0, *ends], ends[k:]))]
        for lane in range(lanes):
            digests = b"".join([xxhash.xxh64_digest(x, SEED + lane) for x in shingles])
            bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 64)
            for b in range(0, len(bits), 200):  # sums of up to 200 ones fit a byte
                counts[64 * lane : 64 * lane + 64] += bits[b : b + 200].sum(0, dtype=np.uint8)
        total += len(shingles)
    return np.packbits(counts * 2 > total).tobytes()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, lanes: int = 1) -> DataFrame:
    """(id, fp, key): fp is the fingerprint as 8 bytes a lane, most significant first; key a number that stands for it."""

    def run(batches):
        for part in slices(batches, "text"):
            found = [fingerprint(x, shingle, lanes) for x in part.column("text").to_pylist()]
            # one lane is its own number
            keys = [int.from_bytes(x, "big", signed=True) if lanes == 1 else xxhash.xxh64_intdigest(x) - (1 << 63) for x in found]
            yield pa.record_batch([part.column("id"), pa.array(found, pa.binary()), pa.array(keys, pa.int64())], ["id", "fp", "key"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, fp binary, key long")


def _words64(fp: pd.Series, lanes: int) -> np.ndarray:
    """n x lanes unsigned numbers."""
    return np.frombuffer(b"".join(fp), np.uint64).reshape(-1, lanes)


def _tiles(fp: np.ndarray, parts: int) -> np.ndarray:
    """Population counts of the parts of 64-bit fingerprints, n x parts."""
    bits = np.unpackbits(np.ascontiguousarray(fp).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.reshape(-1, parts, 64 // parts).sum(2, dtype=np.int64)


def _shifts(radius: int, parts: int) -> np.ndarray:
    """Half of the tile shifts within the radius (first non-zero part positive), the zero shift first."""

    def grow(n: int, left: int):
        if n == 0:
            yield ()
        else:
            for s in range(-left, left + 1):
                for rest in grow(n - 1, left - abs(s)):
                    yield (s, *rest)

    every = grow(parts, radius)
    return np.array([(0,) * parts, *(s for s in every if next((x for x in s if x), 0) > 0)], np.int64)


def _pack(tiles: np.ndarray, parts: int) -> np.ndarray:
    """A tile's counts as one number."""
    out = np.zeros(len(tiles), np.int64)
    for k in range(parts):
        out = out * (64 // parts + 1) + tiles[:, k]
    return out


def _near(home: np.ndarray, other: np.ndarray, radius: int):
    """For blocks of home rows: (row, positions in other within the radius) of each row that has any."""
    for i in range(0, len(home), BLOCK[0]):
        rows, cols = [], []
        for j in range(0, len(other), BLOCK[1]):
            gap = sum(np.bitwise_count(home[i : i + BLOCK[0], None, k] ^ other[None, j : j + BLOCK[1], k]) for k in range(home.shape[1]))
            a, b = np.nonzero(gap <= radius)
            rows.append(a)
            cols.append(b + j)
        a, b = np.concatenate(rows), np.concatenate(cols)
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        cuts = np.flatnonzero(np.r_[True, a[1:] != a[:-1], True]) if len(a) else []
        for lo, hi in itertools.pairwise(cuts):
            yield i + int(a[lo]), b[lo:hi]


def _forest(home: np.ndarray, fp: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links of the first len(home) rows of fp with all of its rows."""
    parent, edges = np.arange(len(fp)), []
    stale = False

    def find(x: int) -> int:
        while (up := int(parent[x])) != x:
            parent[x] = x = int(parent[up])
        return x

    for row, found in _near(home, fp, radius):
        found = found[found != row]
        if len(found) > 64:  # in a dense group most are of one tree by now: look at trees, not at rows
            while stale and (up := parent[parent]).tolist() != parent.tolist():
                parent[:] = up
            stale = False
            found = found[np.unique(parent[found], return_index=True)[1]]
        for other in found.tolist():
            a, b = find(row), find(other)
            if a != b:
                parent[max(a, b)] = min(a, b)
                stale = True
                edges.append((row, other))
    return edges


def _edges(ids: np.ndarray, edges: list[tuple[int, int]]) -> pd.DataFrame:
    e = np.array(edges, np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": ids[e[:, 0]], "b": ids[e[:, 1]]})


def parts_for(n: int) -> int:
    """Into how many parts a fingerprint is cut for n distinct ones.

    More parts are narrower tiles: a random pair meets with probability 1.4e-2, 2.5e-4 or 3e-7, at 21, 73 or 273
    copies of a row.  The bounds are where the pairs saved outweigh the copies.
    """
    return 4 if n <= 4_000_000 else 8 if n <= 1_000_000_000 else 16


def _part_links(classes: DataFrame, radius: int, parts: int | None = None) -> DataFrame:
    """Links by tiles of the parts' population counts: a tile meets itself and the tiles within the radius."""
    n = classes.count()
    parts = parts or parts_for(n)
    shifts = _shifts(radius, parts)

    def spread(batches):
        for b in batches:
            for lo in range(0, len(b), 2048):
                part = b.iloc[lo : lo + 2048]
                to = _tiles(_words64(part["fp"], 1), parts)[:, None, :] + shifts[None, :, :]
                row, shift = np.nonzero(((to >= 0) & (to <= 64 // parts)).all(2))
                yield pd.DataFrame({"tile": _pack(to[row, shift], parts), "visit": shift > 0, "fp": part["fp"].to_numpy()[row], "id": part["id"].to_numpy()[row]})

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["tile", "block", "visit"], kind="stable")
        tile, block, visit, fp, ids = group["tile"].to_numpy(), group["block"].to_numpy(), group["visit"].to_numpy(), _words64(group["fp"], 1), group["id"].to_numpy()
        out = []
        for lo, hi in itertools.pairwise(np.flatnonzero(np.r_[True, (tile[1:] != tile[:-1]) | (block[1:] != block[:-1]), True])):
            own = int(np.searchsorted(visit[lo:hi], True))
            if own and hi - lo > 1:
                out.append(_edges(ids[lo:hi], _forest(fp[lo : lo + own], fp[lo:hi], radius)))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    sent = classes.mapInPandas(spread, "tile long, visit boolean, fp binary, id long")
    # a tile of too many rows of its own is cut into blocks; every visitor meets every block, every block every later one
    full = cut(sent.where("not visit").groupBy("tile").count().where(F.col("count") > TILE_ROWS).select("tile", F.ceil(F.col("count") / TILE_ROWS).alias("blocks")))
    if full.isEmpty():
        dealt = sent.withColumn("block", F.lit(0).cast("long"))
    else:
        dealt = cut(sent.join(full, "tile", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1).cast("long")))).withColumn("home", F.pmod(F.xxhash64(F.lit(5), "id"), "blocks"))
        first = F.when(F.col("visit"), F.lit(0).cast("long")).otherwise(F.col("home"))
        dealt = dealt.withColumn("block", F.explode(F.sequence(first, F.col("blocks") - 1))).withColumn("visit", F.col("visit") | (F.col("block") != F.col("home")))
    slots = max(1, n * len(shifts) // GROUP_ROWS)
    slot = F.pmod(F.xxhash64("tile", "block"), F.lit(slots)).alias("slot")
    return dealt.select("tile", "block", "visit", "fp", "id").groupBy(slot).applyInPandas(lambda g: compare(g), "a long, b long")


def _range_links(classes: DataFrame, radius: int, lanes: int, least: float | None = None) -> DataFrame:
    """Links by tiles that are ranges of the population count: pairs of tiles beyond the radius are skipped.

    With ``least``, classes have ``n``, the number of distinct shingles: sets of that Jaccard similarity differ in size
    by that factor at most, so tiles stand in bands of sizes, and only neighbouring bands meet.
    """
    spark = classes.sparkSession
    count = sum(F.bit_count(F.conv(F.hex(F.substring("fp", 8 * k + 4 * h + 1, 4)), 16, 10).cast("long")) for k in range(lanes) for h in range(2))
    band = F.floor(F.log(F.greatest(F.col("n"), F.lit(1))) / F.lit(float(np.log(1 / least) * (1 + 1e-9)))).cast("int") if least else F.lit(0)
    counted = classes.withColumn("ones", count.cast("int")).withColumn("band", band)
    # 64 * lanes + 1 counts, and a few dozen bands
    histogram = {(r["band"], r["ones"]): r["count"] for r in counted.groupBy("band", "ones").count().collect()}
    total = sum(histogram.values())
    if not total:
        return classes.select(F.col("id").alias("a"), F.col("id").alias("b"))
    size = max(1, min(TILE_ROWS, -(-total // MIN_TILES)))
    # tile of a row: its place in its band's order by (count, hash), by which a hot count is cut into several tiles
    place, spans, at = {}, [], 0  # spans: (band, first count, last count) of each tile
    for b in sorted({b for b, _ in histogram}):
        base, at = len(spans), 0
        for ones in sorted(o for x, o in histogram if x == b):
            n = histogram[b, ones]
            place[b, ones] = (base, at, n)
            for tile in range(base + at // size, base + (at + n - 1) // size + 1):
                if tile == len(spans):
                    spans.append((b, ones, ones))
                else:
                    spans[tile] = (b, spans[tile][1], ones)
            at += n
    tiles: dict[int, list[int]] = {}
    for tile, (b, _, _) in enumerate(spans):
        tiles.setdefault(b, []).append(tile)

    def met(tile: int) -> list[list[int]]:
        """First and last tile to meet in each band that has any: counts rise with the tile, so they are a range."""
        b, low, high = spans[tile]
        found = [[u for u in tiles.get(x, []) if spans[u][1] - high <= radius and low - spans[u][2] <= radius] for x in (b - 1, b, b + 1)]
        return [[x[0], x[-1]] for x in found if x]

    per = F.broadcast(spark.createDataFrame([(b, o, *x) for (b, o), x in place.items()], "band int, ones int, base long, before long, share long"))
    reach = F.broadcast(spark.createDataFrame([(k, met(k)) for k in range(len(spans))], "tile long, reach array<array<long>>"))
    draw = F.pmod(F.xxhash64("fp"), F.lit(1 << 20)) / (1 << 20)
    placed = counted.join(per, ["band", "ones"]).withColumn("tile", (F.col("base") + F.floor((F.col("before") + F.floor(draw * F.col("share"))) / size)).cast("long")).join(reach, "tile")
    others = F.flatten(F.transform("reach", lambda x: F.sequence(x[0], x[1])))
    sent = placed.select("fp", "id", "tile", F.explode(others).alias("other"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        low, high = group["lo"].iloc[0], group["hi"].iloc[0]
        group = group.sort_values("tile", kind="stable")
        fp, ids = _words64(group["fp"], lanes), group["id"].to_numpy()
        own = int((group["tile"] == low).sum())
        if low == high:
            return _edges(ids, _forest(fp, fp, radius))
        # rows of the lower tile against those of the higher alone: each tile meets itself in its own pair
        edges = _cross_forest(fp[:own], fp[own:], radius)
        return _edges(ids, [(a, b + own) for a, b in edges])

    pair = [F.least("tile", "other").alias("lo"), F.greatest("tile", "other").alias("hi")]
    return sent.select(*pair, "tile", "fp", "id").groupBy("lo", "hi").applyInPandas(lambda g: compare(g), "a long, b long")


def _cross_forest(home: np.ndarray, other: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between two sets of rows: (position in home, position in other)."""
    if not len(home) or not len(other):
        return []
    tree = np.arange(len(other))
    edges = []
    for row, found in _near(home, other, radius):
        roots, at = np.unique(tree[found], return_index=True)
        edges += [(row, int(found[k])) for k in at.tolist()]
        if len(roots) > 1:
            tree[np.isin(tree, roots)] = roots[0]
    return edges


def links(classes: DataFrame, radius: int = 2, lanes: int = 1) -> DataFrame:
    """(a, b): edges between ids of distinct fingerprints (fp, id); their components are those of all links."""
    return _part_links(classes, radius) if radius <= 2 and lanes == 1 else _range_links(classes, radius, lanes)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, lanes: int = 1) -> DataFrame:
    """(id, fp, component_id) for every document."""
    fps = cut(fingerprints(docs, id_col, text_col, shingle, lanes))
    classes = cut(fps.groupBy("key").agg(F.first("fp").alias("fp"), F.min("id").alias("least")))
    roots = components(links(classes.select("fp", F.col("key").alias("id")), radius, lanes))
    named = classes.join(roots, classes["key"] == roots["node"], "left").select("key", "least", F.coalesce("root", "key").alias("root"))
    smallest = named.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"))
    # kept, so that a fingerprint of very many documents is split in the join
    ids = cut(named.join(smallest, named["root"] == smallest["of"]).select("key", F.when(F.col("least").isNotNull(), F.col("component_id")).alias("component_id")))
    return fps.join(ids, "key").select(F.col("id").alias(id_col), "fp", "component_id")


def shingle_set(text: str | None, shingle: int = 5) -> tuple[np.ndarray, bytes]:
    """The distinct shingles of a whole text as sorted 64-bit hashes, and the shingles themselves joined by lines."""
    words = (text or "").encode().lower().split()
    distinct = {b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))} if words else set()
    hashes = np.frombuffer(b"".join([xxhash.xxh64_digest(x, SEED) for x in distinct]), ">u8").astype(np.uint64)
    return np.sort(hashes), b"\n".join(distinct)


def _set_fingerprint(joined: bytes, lanes: int) -> bytes:
    """SimHash of distinct shingles, each counted once however often the text repeats it."""
    shingles = joined.split(b"\n") if joined else []
    counts = np.zeros(128 * (lanes // 2), np.int64)
    for at in range(0, len(shingles), CHUNK):
        for lane in range(lanes // 2):
            digests = b"".join([xxhash.xxh3_128_digest(x, SEED + lane) for x in shingles[at : at + CHUNK]])
            bits = np.unpackbits(np.frombuffer(digests, np.uint8)).reshape(-1, 128)
            for b in range(0, len(bits), 200):  # sums of up to 200 ones fit a byte
                counts[128 * lane : 128 * lane + 128] += bits[b : b + 200].sum(0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(shingles)).tobytes()


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sorted sets of distinct hashes have a Jaccard similarity of ``least`` or more."""
    small, large = sorted((len(a), len(b)))
    if large == 0:
        return True
    if small < least * large - 1e-9:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (small + large - both) - 1e-9


def _verified_forest(home: np.ndarray, fp: np.ndarray, sets: list[np.ndarray], shift: int, radius: int, least: float) -> list[tuple[int, int]]:
    """Spanning forest of the verified links of home rows with the rows of fp from ``shift`` on (0: home itself).

    A pair in one tree already is not verified again, so a group of near copies is not all its pairs.
    """
    parent, edges = list(range(len(sets))), []

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for row, found in _near(home, fp[shift:], radius):
        for other in (found + shift).tolist():
            if not shift and other <= row:
                continue
            a, b = find(row), find(other)
            if a != b and similar(sets[row], sets[other], least):
                parent[max(a, b)] = min(a, b)
                edges.append((row, other))
    return edges


def _verified_links(members: DataFrame, sets: DataFrame, radius: int, lanes: int, least: float) -> DataFrame:
    """(a, b): forest of the verified links; members (node, root, fp, n) of candidate components, sets (node, hashes).

    A component beyond ``PART`` members or ``PART_SHINGLES`` shingles is dealt over parts, of which every pair meets.
    """
    sizes = members.groupBy("root").agg(F.ceil(F.greatest(F.count("*") / PART, F.sum("n") / PART_SHINGLES)).cast("int").alias("parts"))
    dealt = members.drop("n").join(sizes, "root").join(sets, "node")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("root", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "node", "fp", "hashes")
    n, shingles = members.agg(F.count("*"), F.sum("n")).first()
    slots = max(8 * shuffle_width(members.sparkSession), -(-n // PART), -(-(shingles or 0) // PART_SHINGLES))

    def compare(slot: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, low, high), group in slot.groupby(["root", "lo", "hi"], sort=False):
            group = group.sort_values(["part", "node"], kind="stable")
            fp, ids = _words64(group["fp"], lanes), group["node"].to_numpy()
            hashes = [np.frombuffer(x, np.uint64) for x in group["hashes"]]
            own = int((group["part"] == low).sum())
            if own and (low == high or own < len(ids)):
                out.append(_edges(ids, _verified_forest(fp[:own], fp, hashes, 0 if low == high else own, radius, least)))
        return pd.concat(out) if out else pd.DataFrame({"a": [], "b": []}, dtype="int64")

    return dealt.groupBy(F.pmod(F.xxhash64("root", "lo", "hi"), F.lit(slots)).alias("slot")).applyInPandas(lambda g: compare(g), "a long, b long")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, radius: int = 72, lanes: int = 4, least: float = 0.8) -> DataFrame:
    """The documents without near copies: of each component the one with the smallest id stays, once.

    A link is a pair of texts whose sets of distinct word shingles have a Jaccard similarity of ``least`` or more,
    verified exactly (on 64-bit hashes) for all pairs with fingerprints within the radius.  Texts with equal sets,
    those without words among them, are one class from the start; a component is chained by verified links alone.

    256 bits and radius 72: a pair of similarity 0.8 has a cosine of 0.89 and an expected distance of 39 (standard
    deviation 6); a pair of four and five shingles one of 48 (6), so about 1 in 10,000 such pairs is not looked at.
    Unrelated texts (128, 8) come that close with a probability of about 1e-12, and cost a comparison only.

    Rows with one id and different texts are different documents; of rows equal in both, the one whose other columns
    have the smallest hash stays.  Documents with a null id cannot be told apart by it and all stay.  Columns may have
    any names.
    """
    # a row is known by its id and the hash of its text; its columns travel in a struct, out of the way of names
    key = [F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("hash")]
    every = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *key)
    rows = docs.where(F.col(id_col).isNotNull()).select(*key, F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()

    def keys(batches):
        for part in slices(batches, "text"):
            found = [(shingle_set(x, shingle)) for x in part.column("text").to_pylist()]
            nodes = [xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63) for h, _ in found]
            prints = [_set_fingerprint(joined, lanes) for _, joined in found]
            yield pa.record_batch([part.column("id"), part.column("hash"), pa.array(nodes, pa.int64()), pa.array(prints, pa.binary()), pa.array([len(h) for h, _ in found], pa.int64())], ["id", "hash", "node", "fp", "n"])

    def sets(batches):
        for part in slices(batches, "text"):
            yield pa.record_batch([part.column("node"), pa.array([shingle_set(x, shingle)[0].tobytes() for x in part.column("text").to_pylist()], pa.binary())], ["node", "hashes"])

    found = cut(rows.mapInArrow(keys, f"id {kind}, hash long, node long, fp binary, n long"))
    classes = cut(found.groupBy("node").agg(F.first("fp").alias("fp"), F.first("n").alias("n"), F.min(F.struct("id", "hash")).alias("row")))
    near = components(_range_links(classes.select("fp", "n", F.col("node").alias("id")), radius, lanes, least))
    members = cut(near.join(classes, "node").select("node", "root", "fp", "n", "row.*"))
    # copies of a member's row give its set once a task at most; one each is kept
    texts = rows.join(members.select("node", "id", "hash"), ["id", "hash"]).dropDuplicates(["id", "hash"]).select("node", "text")
    links = _verified_links(members.select("node", "root", "fp", "n"), texts.mapInArrow(sets, "node long, hashes binary"), radius, lanes, least)
    chosen = cut(classes.join(components(links), "node", "left").groupBy(F.coalesce("root", "node")).agg(F.min("row").alias("row")).select("row.*"))
    others = [F.col(f"doc.`{c}`") for c in docs.columns if c not in (id_col, text_col)]
    tie = F.xxhash64(F.to_json(F.struct(*others))) if others else F.lit(0)
    first = every.where("id is not null").withColumn("rank", F.row_number().over(Window.partitionBy("id", "hash").orderBy(tie))).where("rank = 1")
    kept = first.join(chosen, ["id", "hash"], "left_semi").select("doc")
    return kept.unionByName(every.where("id is null").select("doc")).select("doc.*")
