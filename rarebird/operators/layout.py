"""Partition layout by bytes.

A frame gets more partitions when its scan has fewer than its size calls for (a small file is one
split, however many columns an iterative fit reads a hundred times); it is never merged into fewer.
Frames to fit go by the bytes of their rows in memory (``spread_rows``), others by those of their files.
The count depends on the bytes alone, never on the cores that happen to be registered, so a run's
layout - and with it the floating-point path of a fit - is the same on every cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: bytes of one partition of a large frame
PARTITION_BYTES = 128 << 20
#: bytes of one partition of a small frame, and up to how many such partitions it is cut
SMALL_PARTITION_BYTES = 1 << 20
SMALL_PARTITIONS = 64
#: Parquet options under which numbers take in a file what they take in memory, so that the splits of a
#: scan hold as many rows as fit a partition (a dictionary of few values packs a hundred times more)
PLAIN = {"compression": "uncompressed", "parquet.enable.dictionary": "false"}
#: bytes of rows from which that matters
PLAIN_BYTES = 1 << 30
#: statistics above this are Spark's "unknown"
_UNKNOWN = 1 << 60


def partitions_for(size: int) -> int:
    """Partitions that ``size`` bytes call for: 128 MB each, small frames 1 MB each up to 64."""
    large = -(-size // PARTITION_BYTES)
    small = -(-size // SMALL_PARTITION_BYTES)
    return max(1, large, min(SMALL_PARTITIONS, small))


def options_for(size: int) -> dict[str, str]:
    """Parquet options for a frame to fit of ``size`` bytes in memory: ``PLAIN`` for a large one."""
    return PLAIN if size >= PLAIN_BYTES else {}


def plan_bytes(df: DataFrame) -> int | None:
    """Spark's size estimate of the optimized plan; ``None`` when it has none. Runs nothing."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < _UNKNOWN else None


def has_exchange(df: DataFrame) -> bool:
    """Whether the physical plan shuffles or broadcasts, read from its nodes. Runs nothing."""
    plan = df._jdf.queryExecution().executedPlan()
    todo = [plan]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.initialPlan())
            continue
        if name.endswith("ExchangeExec"):
            return True
        children = node.children()
        todo.extend(children.apply(i) for i in range(children.size()))
    return False


def partition_count(df: DataFrame) -> int | None:
    """Partitions of an exchange-free plan (its scan splits); ``None`` when not free to know."""
    if has_exchange(df):
        return None
    return df.rdd.getNumPartitions()


def spread_rows(df: DataFrame, bytes_per_row: int) -> DataFrame:
    """``spread`` by what the rows take in memory instead of in their files: one counting pass, which
    reads the columns of the filters alone. Compressed files say little about the vectors made of them."""
    current = partition_count(df)
    if current is None:
        return df
    target = max(partitions_for(df.count() * bytes_per_row), partitions_for(plan_bytes(df) or 0))
    return df.repartition(target) if current < target else df


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` with at least the partitions its bytes call for (or ``partitions``). A plan that
    shuffles keeps its layout: asking for its partitions would run the shuffle."""
    current = partition_count(df)
    if current is None:
        return df
    size = plan_bytes(df)
    target = partitions or (partitions_for(size) if size is not None else current)
    return df.repartition(target) if current < target else df
