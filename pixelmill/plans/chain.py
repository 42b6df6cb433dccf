"""The ordered filter chain as a fold over DataFrame stages.

An operator sees only rows that are still pending; REJECT and ERROR both end a row's way.  Column operators are
``when`` expressions.  Neighbouring kernel operators share one Arrow pass that opens each image once and stops at the
first that ends it; rows that are not pending are passed by unopened.  A batch operator is a barrier: its decisions are
joined back by id, and images it does not mention pass; image bytes stay out of that join.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pixelmill.operators.base import BatchOperator, ColumnOperator, KernelOperator
from pixelmill.schema import ERROR, PASS, PENDING, REJECT, TRACE, TRACE_ENTRY, failed
from pixelmill.session import cut
from pixelmill.sources.codec import open_row

#: Rows carry whole images, so Arrow batches are kept small by the session setting named here.
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: What of a row is the image itself.
BYTES = ("content", "pixels", "pixel_height", "pixel_width")
IMAGE_COLUMNS = ("sample_id", "source_path", "relative_path", "length", "content", "pixels", "pixel_height", "pixel_width", "faces")


def start(images: DataFrame) -> DataFrame:
    """Images with the state every chain begins with."""
    return images.withColumns({
        "status": F.lit(PENDING),
        "rejected_by": F.lit(None).cast("string"),
        "reject_reason": F.lit(None).cast("string"),
        "trace": F.array().cast(TRACE),
    })


def _record(state: DataFrame, name: str) -> DataFrame:
    """Takes the result in ``_r`` (null: the operator did not run) into the state."""
    ends = F.col("_r.decision").isin(REJECT, ERROR)
    entry = F.struct(F.lit(name).alias("name"), F.col("_r.decision").alias("decision"), F.col("_r.reason").alias("reason"), F.col("_r.metrics").alias("metrics"))
    return state.withColumns({
        "trace": F.when(F.col("_r").isNotNull(), F.array_append("trace", entry)).otherwise(F.col("trace")),
        "rejected_by": F.when(ends, F.lit(name)).otherwise(F.col("rejected_by")),
        "reject_reason": F.when(ends, F.col("_r.reason")).otherwise(F.col("reject_reason")),
        "status": F.when(ends, F.col("_r.decision")).otherwise(F.col("status")),
    }).drop("_r")


def _column_stage(state: DataFrame, op: ColumnOperator) -> DataFrame:
    columns = {c: F.col(c) for c in state.columns}
    columns.setdefault("open_error", F.lit(None).cast("string"))
    return _record(state.withColumn("_r", F.when(F.col("status") == PENDING, op.result(columns))), op.name)


def run_kernels(ops: list[KernelOperator], rows: list[dict[str, Any]]) -> list[list[dict[str, Any]]]:
    """Trace entries that the operators add to each row (none for rows that are not pending)."""
    out = []
    for row in rows:
        entries: list[dict[str, Any]] = []
        if row["status"] == PENDING:
            image = error = None
            try:
                image = open_row(row)
            except Exception as e:
                error = repr(e)
            for op in ops:
                if image is None:
                    found = failed(op.open_error.format(error=error))
                else:
                    try:
                        found = op.process(image, row)
                    except Exception as e:
                        found = failed(f"operator_exception: {e!r}")
                entries.append(found.entry(op.name))
                if found.decision in (REJECT, ERROR):
                    break
        out.append(entries)
    return out


def _kernel_stage(state: DataFrame, ops: list[KernelOperator]) -> DataFrame:
    names = ["status", *[c for c in IMAGE_COLUMNS if c in state.columns]]

    @F.pandas_udf(T.ArrayType(TRACE_ENTRY))
    def kernel(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for op in ops:
            op.setup()
        try:
            for b in batches:
                yield pd.Series(run_kernels(ops, b.to_dict("records")))
        finally:
            for op in ops:
                op.teardown()

    entries = kernel(F.struct(*names))
    last = F.element_at("_k", -1)
    ends = (F.size("_k") > 0) & last["decision"].isin(REJECT, ERROR)
    return state.withColumn("_k", entries).withColumns({
        "trace": F.concat("trace", F.col("_k")),
        "rejected_by": F.when(ends, last["name"]).otherwise(F.col("rejected_by")),
        "reject_reason": F.when(ends, last["reason"]).otherwise(F.col("reject_reason")),
        "status": F.when(ends, last["decision"]).otherwise(F.col("status")),
    }).drop("_k")


def without_bytes(state: DataFrame) -> DataFrame:
    return state.drop(*BYTES)


def _batch_stage(state: DataFrame, op: BatchOperator, images: DataFrame, again: bool) -> DataFrame:
    """What came before runs once: the state is kept without the images, with what the operator made of each.

    again: whether later operators open images; then their bytes are joined to the survivors anew.
    """
    names = [c for c in BYTES if c in images.columns]
    attach = lambda rows: rows.join(images.select("sample_id", *names), "sample_id") if names else rows
    prepared = op.prepare(state)
    if prepared is not None:
        slim = cut(without_bytes(prepared))
        found = op.decide(slim.where(F.col("status") == PENDING))
        slim = slim.select(*without_bytes(state).columns)
    else:
        slim = cut(without_bytes(state))
        found = op.process_batch(attach(slim.where(F.col("status") == PENDING)))
    found = found.select(F.col("sample_id").alias("_id"), F.struct("decision", "reason", "metrics").alias("_found"))
    default = F.struct(F.lit(PASS).alias("decision"), F.lit(None).cast("string").alias("reason"), F.lit("{}").alias("metrics"))
    joined = slim.join(found, slim["sample_id"] == found["_id"], "left").drop("_id")
    out = _record(joined.withColumn("_r", F.when(F.col("status") == PENDING, F.coalesce("_found", default))).drop("_found"), op.name)
    return attach(cut(out)) if again else out


def apply_chain(images: DataFrame, operators: list) -> DataFrame:
    """The state of every image after all operators; survivors are still PENDING."""
    state, done = start(images), 0
    for kind, group in itertools.groupby(operators, key=lambda op: isinstance(op, KernelOperator)):
        group = list(group)
        done += len(group)
        if kind:
            state = _kernel_stage(state, group)
            continue
        for k, op in enumerate(group, 1):
            if isinstance(op, ColumnOperator):
                state = _column_stage(state, op)
            elif isinstance(op, BatchOperator):
                later = [*group[k:], *operators[done:]]
                state = _batch_stage(state, op, images, any(not isinstance(x, ColumnOperator) for x in later))
            else:
                raise TypeError(f"not a filter operator: {op!r}")
    return state
