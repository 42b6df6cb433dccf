"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role are merged by an
array aggregation; the merged turns are concatenated by a template of control strings.  Control strings inside
roles and texts are escaped reversibly: every "<" and "\\\\" that would start or end one is written with a
backslash escape, so no text can contain ``<|`` after escaping; in roles, newlines are escaped as well.

Template of a merged turn: ``<|im_start|>`` role newline text (``<|im_sep|>`` text)* ``<|im_end|>`` newline.
``<|im_sep|>`` stands where two turns of one role were merged, so the turns can be read back.

Loss mask: ``loss_runs`` beside the text has a run for every turn in order: ``lead``, the code points of the template
between the text before (or the start) and this one, ``size``, those of its escaped text, and ``loss``, whether the
text is learned from (the assistant's are).  After the last run stands the last end mark.  Runs need no prefix sums,
so they cost as much as the text is long; ``read_back`` takes the mask from them alone and fails where a run does not
fit the text.

Order and ties: by turn (nulls first), then role, then text.  A null role or text counts as empty; null
conversation ids form one conversation.  Repeated rows are turns of their own.  An empty table gives an empty
result.  Other columns of the input are ignored, whatever their names.

Scale: one shuffle by conversation; a conversation is one training text, so its turns meet in one row by
definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
LEARNED = "assistant"


def escape(text: Column) -> Column:
    """Backslashes double, and ``<`` is written ``\\\\l``: no control string can appear."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    """The inverse of escape; what stands between two doubled backslashes has no doubled backslash."""
    return F.array_join(F.transform(F.split(text, r"\\\\", -1), lambda x: F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n"))), "\\")


def run_starts(turns: Column) -> Column:
    """Where a run of neighbours of one role starts in sorted turns."""
    return F.filter(
        F.transform(turns, lambda x, i: F.when((i == 0) | (x["role"] != F.get(turns, i - 1)["role"]), i)),
        lambda i: i.isNotNull(),
    )


def format_conversations(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation: the formatted text and the merged turns."""
    t = rows.select(
        F.col(id_col).alias("id"),
        F.struct(F.col(turn_col).alias("turn"), F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text")).alias("x"),
    )
    t = t.groupBy("id").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    # starts is used twice below and xs in every step, which keeps both out of the lambdas
    t = t.select("id", "xs", run_starts(F.col("xs")).alias("starts"))
    run = lambda i, k: F.slice("xs", i + 1, F.coalesce(F.get(F.col("starts"), k + 1), F.size("xs")) - i)
    t = t.select(
        "id",
        F.transform("starts", lambda i, k: F.struct(F.get(F.col("xs"), i)["role"].alias("role"), F.transform(run(i, k), lambda x: escape(x["text"])).alias("texts"))).alias("raw"),
    )
    # the header and the escaped texts are made once, for the text and for the mask
    head = lambda m: F.concat(F.lit(START), F.replace(escape(m["role"]), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    t = t.select("id", F.transform("raw", lambda m: F.struct(head(m).alias("head"), m["texts"].alias("texts"), (m["role"] == LEARNED).alias("loss"))).alias("merged"))
    block = lambda m: F.concat(m["head"], F.array_join(m["texts"], SEP), F.lit(END + "\n"))
    chars = lambda x: F.char_length(x).cast("long")
    lead = lambda m, i, j: F.when(j > 0, F.lit(len(SEP))).otherwise(chars(m["head"]) + F.when(i > 0, F.lit(len(END) + 1)).otherwise(F.lit(0)))
    runs = F.transform("merged", lambda m, i: F.transform(m["texts"], lambda x, j: F.struct(lead(m, i, j).cast("long").alias("lead"), chars(x).alias("size"), m["loss"].alias("loss"))))
    return t.select(
        F.col("id").alias(id_col), F.array_join(F.transform("merged", block), "").alias("formatted"), F.flatten(runs).alias("loss_runs"), F.size("merged").cast("long").alias("n_merged")
    )


def read_back(formatted: DataFrame, id_col: str = "conv_id", text_col: str = "formatted", runs_col: str = "loss_runs") -> DataFrame:
    """The turns (role, text, in_loss) of formatted conversations, in order; in_loss as the mask has it."""
    # no split pattern ends a turn but the control strings: an escaped text has no "<"
    blocks = F.filter(F.split(F.col(text_col), r"<\|im_end\|>\n", -1), lambda b: b != "")
    one = lambda b: F.struct(
        unescape(F.regexp_extract(b, r"(?s)^<\|im_start\|>([^\n]*)", 1)).alias("role"),
        F.split(F.regexp_extract(b, r"(?s)^<\|im_start\|>[^\n]*\n(.*)$", 1), r"<\|im_sep\|>", -1).alias("texts"),
    )
    t = formatted.select(F.col(id_col).alias("id"), F.col(text_col).alias("f"), F.col(runs_col).alias("runs"), F.transform(blocks, one).alias("blocks"))
    texts = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda x: F.struct(b["role"].alias("role"), x.alias("text")))))
    t = t.select("id", "f", "runs", texts.alias("texts"))
    # a turn is learned from if its run says so, and a run must be as long as its text
    fits = lambda x, k: F.get(F.col("runs"), k)["size"].eqNullSafe(F.char_length(x["text"]).cast("long"))
    learned = lambda x, k: F.when(fits(x, k), F.get(F.col("runs"), k)["loss"]).otherwise(F.raise_error(F.lit("the loss mask does not fit the text")).cast("boolean"))
    turns = F.transform("texts", lambda x, k: F.struct(x["role"].alias("role"), unescape(x["text"]).alias("text"), learned(x, k).alias("in_loss")))
    return t.select(F.col("id").alias(id_col), F.col("f").alias(text_col), turns.alias("turns"))


def digest(read: DataFrame, id_col: str = "conv_id", text_col: str = "formatted") -> DataFrame:
    """Counts and digests of the turns that were read back."""
    loss = F.array_join(F.transform(F.filter("turns", lambda x: x["in_loss"]), lambda x: x["text"]), "")
    t = read.select(
        F.col(id_col),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        loss.alias("loss"),
        F.char_length(text_col).cast("long").alias("formatted_chars"),
    )
    return t.select(id_col, "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
