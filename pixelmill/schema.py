"""Record types and result columns shared by all operators."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

PASS, REJECT, LABEL, ERROR, PENDING = "PASS", "REJECT", "LABEL", "ERROR", "PENDING"

#: Metrics differ by operator, so they travel as JSON with the operator's key order.
RESULT = T.StructType([T.StructField("decision", T.StringType()), T.StructField("reason", T.StringType()), T.StructField("metrics", T.StringType())])
TRACE_ENTRY = T.StructType([T.StructField("name", T.StringType()), *RESULT.fields])
TRACE = T.ArrayType(TRACE_ENTRY)

#: One image per row; pixels (row-major RGB bytes) stand in for content where images are views over other data.
IMAGE = T.StructType([
    T.StructField("sample_id", T.StringType()),
    T.StructField("source_path", T.StringType()),
    T.StructField("relative_path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("content", T.BinaryType()),
])
MANIFEST = T.StructType([
    *[T.StructField(c, T.StringType()) for c in ("sample_id", "source_path", "relative_path", "archive_path", "status", "rejected_by", "reject_reason")],
    T.StructField("operator_trace", TRACE),
])


@dataclass(frozen=True)
class Result:
    """What an operator says of one image."""

    decision: str
    reason: str | None = None
    metrics: dict[str, Any] = field(default_factory=dict)
    labels: dict[str, str] | None = None

    def entry(self, name: str) -> dict[str, Any]:
        return {"name": name, "decision": self.decision, "reason": self.reason, "metrics": json.dumps(self.metrics)}


def passed(metrics: dict | None = None) -> Result:
    return Result(PASS, None, metrics or {})


def rejected(reason: str, metrics: dict | None = None) -> Result:
    return Result(REJECT, reason, metrics or {})


def labelled(labels: dict[str, str], metrics: dict | None = None) -> Result:
    return Result(LABEL, None, metrics or {}, labels)


def failed(reason: str, metrics: dict | None = None) -> Result:
    return Result(ERROR, reason, metrics or {})


def result(decision: Column, reason: Column, **metrics: Column) -> Column:
    """The struct column of a result, metrics in the order given."""
    body = F.to_json(F.struct(*[v.alias(k) for k, v in metrics.items()]), {"ignoreNullFields": "false"}) if metrics else F.lit("{}")
    return F.struct(decision.alias("decision"), reason.cast("string").alias("reason"), body.alias("metrics"))
