"""Path expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pixelmill.session import cut


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(path: Column) -> Column:
    """Last suffix in lower case; a name that is only a suffix has none."""
    return F.lower(F.regexp_extract(base_name(path), r"^.+(\.[^.]+)$", 1))


def stem(path: Column) -> Column:
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]+$", "")


def depth(path: Column) -> Column:
    return F.size(F.split(path, "/"))


def order_key(path: Column) -> Column:
    """Component-wise order, as paths sort."""
    return F.split(path, "/")


def has_suffix(path: Column, exts) -> Column:
    return suffix(path).isin(*[x.lower() for x in exts])


def ranked(rows: DataFrame, key: Column, name: str) -> DataFrame:
    """Rows with their place (from 1) in the order of the key.

    A range sort numbers the rows of each partition; only the partitions' sizes are summed up in one place.
    """
    placed = cut(rows.orderBy(key).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    inside = F.col("_at") - F.shiftleft(part, 33)
    return placed.join(offsets, part == F.col("_part")).withColumn(name, F.col("_before") + inside + 1).drop("_at", "_part", "_before")
