"""Column expressions: membership flag (R1), output casts (P3), run moment."""

from __future__ import annotations

import datetime as _dt

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the day-first clock format of the monitoring rows.
MOMENT_FORMAT = "%d/%m/%Y %H:%M:%S"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_array(c: str | Column, vector: bool = True) -> Column:
    """An ML vector column as ``array<double>`` (arrays pass through)."""
    return vector_to_array(_col(c)) if vector else _col(c)


def membership_flag(probability: str | Column, threshold: float = 0.7, vector: bool = True) -> Column:
    """1 when *every* membership is strictly below ``threshold``, else 0 (integer).

    Same truth table as Python's ``all(p < t for p in ps)``: NaN never counts as below
    (Spark orders NaN above every number), an empty membership list gives 1. A higher-order
    ``forall`` keeps the test inside whole-stage codegen, without a Python worker.
    """
    t = F.lit(float(threshold))
    return F.forall(as_array(probability, vector), lambda p: p < t).cast("int")


def vector_text(c: str | Column) -> Column:
    """An ML vector rendered as text, e.g. ``[0.25,0.75]`` (how results store memberships)."""
    return _col(c).cast("string")


def run_moment(now: _dt.datetime | None = None) -> str:
    """The moment stamp of one run, day first; computed once on the driver per run."""
    return (now or _dt.datetime.now()).strftime(MOMENT_FORMAT)


def vector_parts(vector: str) -> Column:
    """``type``, ``indices`` and ``values`` of an ML vector, for Arrow. A dense vector's ``indices`` are empty
    here and not null: Spark's Arrow writer takes some 2 microseconds a row for the vector with an empty list,
    and 18 with a null one."""
    v = F.unwrap_udt(F.col(vector))
    none = F.array().cast("array<int>")
    return F.struct(v["type"].alias("type"), F.coalesce(v["indices"], none).alias("indices"), v["values"].alias("values"))
