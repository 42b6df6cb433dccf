"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pixelmill.session import cut

#: Beyond so many edges the smallest neighbours are kept before they are joined: both sides of the join are then plain
#: exchanges, and Spark splits the edges of a node that most others point to.
MANY = 1_000_000


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): every node of an edge (a, b) with the smallest node of its component.

    Alternating large and small stars: each step connects a node's neighbours to the smallest of them; the number of
    rounds grows with the logarithm of the longest chain.  Every round ends in a checkpoint; the loop ends when a
    round changes nothing and raises after ``rounds``.  Edges may repeat, have either direction or join a node to
    itself.
    """

    def star(pairs: DataFrame, large: bool, many: bool) -> DataFrame:
        low = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = pairs.join(cut(low) if many else low, "a")
        if large:
            out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b")))
        return out.where("a != b").distinct()

    def mark(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())  # made once, used twice
    alone = edges.where("a = b").select(F.col("a").alias("node"), F.col("a").alias("root"))
    pairs = edges.where("a != b")
    seen = mark(pairs)
    for _ in range(rounds):
        many = seen[0] > MANY
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # both steps leave edges from a node to a smaller one
        pairs = cut(star(star(both, True, many), False, many))
        now = mark(pairs)
        if now == seen:
            roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            found = pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
            return found.unionByName(alone.join(found.select("node"), "node", "left_anti"))
        seen = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
