"""Line-first quality rules in Spark expressions only.

Every line is judged by punctuation, navigation and boilerplate rules, failing lines are removed, and a
document that loses too much of its text is rejected.  Document-level word statistics (word characters,
symbols, repeated lines, words in repeated 8-word windows) come from the same pass.

No shuffle: every document is judged inside its own row by array functions, so no key can be hot.

Defined results: a null text counts as empty (no words, base_failed); an empty text likewise; blank lines are
neither judged nor counted; a text without any judged line loses nothing.  Rows with equal ids stay separate
rows.  Other columns of the input are ignored, whatever their names.  An empty table gives an empty result; very long
lines and texts are judged whole.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pixelmill.llm.common import GAP

WINDOW = 8
WORD = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
#: Phrases that mark licence, rights and consent lines.
BOILERPLATE = (
    "all rights reserved",
    "licensed under the",
    "released under the",
    "is licensed under",
    "terms of service",
    "terms of use",
    "privacy policy",
    "accept cookies",
    "uses cookies",
    "enable javascript",
)
#: The items of menus.
MENU = (
    "home",
    "about",
    "about us",
    "contact",
    "contact us",
    "login",
    "log in",
    "sign in",
    "sign up",
    "register",
    "menu",
    "search",
    "sitemap",
    "next",
    "previous",
    "back to top",
    "read more",
    "skip to content",
)
#: A line of up to eight such items and marks between them, nothing else.
MENU_LINE = r"(?i)^[^\p{L}\p{N}]*(?:(?:" + "|".join(sorted(MENU, key=lambda x: (-len(x), x))) + r")(?:[^\p{L}\p{N}]+|$)){1,8}$"


@dataclass(frozen=True)
class QualityParams:
    """Limits of the rules; shares are of a line's words or characters, or of a text's characters."""

    min_words: int = 20
    max_repeat_percent: int = 30
    max_symbol_share: float = 0.10
    max_shout_share: float = 0.30
    max_bar_share: float = 0.15
    max_menu_chars: int = 120
    max_removed_share: float = 0.50


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("long")


def line_verdict(line: Column, phrases: Column, p: QualityParams) -> Column:
    """The first rule a line fails, or null: ``punctuation``, ``navigation`` or ``boilerplate``; every rule is tried.

    phrases: whether any of the text's lines has a boilerplate phrase.  Counting stands behind one search for
    any character that a rule counts, so that plain prose is read once.
    """
    words = F.size(F.split(line, GAP))
    marks = line.rlike(r"[#*$%&<>~^|»›→!?]")
    crowded = (_count(line, r"[#*$%&<>~^]") > p.max_symbol_share * F.char_length(line)) | (_count(line, r"[!?]{2,}") > p.max_shout_share * words)
    return F.coalesce(
        F.when(marks, F.when(crowded, F.lit("punctuation")).when(_count(line, r"[|»›→]") > p.max_bar_share * words, F.lit("navigation"))),
        F.when((F.char_length(line) <= p.max_menu_chars) & line.rlike(MENU_LINE), F.lit("navigation")),
        F.when(phrases & line.rlike("(?i)" + "|".join(BOILERPLATE)), F.lit("boilerplate")),
        F.when(~line.rlike(r"\p{L}|\p{N}"), F.lit("punctuation")),
    )


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: QualityParams = QualityParams()) -> DataFrame:
    """One row per document: the statistics, the verdict, the removed share and the cleaned text."""
    p = params
    t = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    t = t.select("id", "t", F.lower("t").alias("low")).select(
        "id",
        "t",
        F.filter(F.split("t", GAP), lambda w: w != "").alias("w"),
        F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD)).alias("lines"),
        reduce(or_, [F.col("low").contains(x) for x in BOILERPLATE]).alias("phrases"),
    )
    # Hashes of 1, 2, 4 and 8 words, each made of two of the size before (xxhash64 passes over the null past the
    # end; the last seven, of fewer words, are cut off).  Every step
    # is used twice in the next (as array and inside its lambda), which keeps Catalyst from inlining it there.
    join = lambda name, k: F.transform(name, lambda x, i: F.xxhash64(x, F.get(F.col(name), i + k)))
    keep = [c for c in t.columns if c != "h"]
    t = t.withColumn("h1", F.transform("w", lambda w: F.xxhash64(w)))
    for name, before, k in (("h2", "h1", 1), ("h4", "h2", 2), ("h8", "h4", 4)):
        t = t.select(*keep, join(before, k).alias(name))
    t = t.select(
        "id",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOL).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.slice("h8", 1, F.greatest(F.size("h8") - WINDOW + 1, F.lit(0))).alias("h"),
        F.transform("lines", lambda x: F.struct(x.alias("line"), line_verdict(x, F.col("phrases"), p).alias("rule"))).alias("judged"),
        "phrases",
    )
    t = t.withColumn(
        "s",
        F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.sort_array(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.cast("long").alias("at")))),
        ),
    )
    repeated = F.filter(
        F.transform(
            "s",
            lambda x, i: F.when((x["h"] == F.get(F.col("s"), i - 1)["h"]) | (x["h"] == F.get(F.col("s"), i + 1)["h"]), x["at"]),
        ),
        lambda at: at.isNotNull(),
    )
    covered = F.aggregate(
        F.sort_array(repeated),
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda a, at: F.struct((at + WINDOW).alias("end"), (a["n"] + at + WINDOW - F.greatest(a["end"], at)).alias("n")),
        lambda a: a["n"],
    )
    size = lambda keep: F.aggregate(F.filter("judged", keep), F.lit(0).cast("long"), lambda a, x: a + F.char_length(x["line"]))
    t = t.select(
        "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "judged", "phrases",
        F.when(F.size("s") > 0, covered).otherwise(F.lit(0)).cast("long").alias("n_repeat_words"),
        size(lambda x: F.lit(True)).alias("line_chars"),
        size(lambda x: x["rule"].isNotNull()).alias("removed_chars"),
    )
    t = t.withColumn("base_failed", (F.col("n_words") < p.min_words) | (100 * F.col("n_repeat_words") > p.max_repeat_percent * F.col("n_words")))
    t = t.withColumn("removed_share", F.when(F.col("line_chars") > 0, F.col("removed_chars") / F.col("line_chars")).otherwise(F.lit(0.0)))
    return t.select(
        F.col("id").alias(id_col),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_share",
        (~F.col("base_failed") & (F.col("removed_share") <= p.max_removed_share)).alias("kept"),
        F.size(F.filter("judged", lambda x: x["rule"].isNotNull())).cast("long").alias("n_removed_lines"),
        F.col("phrases").alias("has_phrase"),
        F.array_join(F.transform(F.filter("judged", lambda x: x["rule"].isNull()), lambda x: x["line"]), "\n").alias("clean_text"),
    )
