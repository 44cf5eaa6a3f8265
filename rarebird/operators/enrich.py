"""Enrichment and deduplication.

The enrichment join is a plain equi-join: Catalyst + AQE choose broadcast only when the
runtime size of a side is under ``spark.sql.autoBroadcastJoinThreshold`` and split skewed
partitions (``spark.sql.adaptive.skewJoin``) otherwise, so no side is broadcast on faith.

Ordered deduplication keeps the first row of each key by ``row_number() = 1``, which Spark runs as
a group limit before the shuffle too: every map partition sends one row per key, so a key holding a
third of all rows never meets in one task whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from rarebird.session import remove_at_exit, scratch_path

_SALT, _OTHER, _PLACE = "__salt", "__other_salt", "__place"
_SALTABLE = {"inner", "left", "left_outer", "leftouter", "left_semi", "leftsemi", "semi", "left_anti", "leftanti", "anti"}


def hot_keys(df: DataFrame, key: str, share: float = 0.05) -> list:
    """Key values that may hold more than ``share`` of the rows: one pass of Spark's
    frequent-items sketch, so at most ``1 / share`` values (false positives possible, misses
    not) come back to the driver."""
    row = df.stat.freqItems([key], support=share).first()
    return [v for v in (row[0] or []) if v is not None]


def enrich(
    result: DataFrame,
    source: DataFrame,
    on,
    how: str = "inner",
    skew_keys: Sequence | str | None = None,
    rows_per_bucket: int = 1_000_000,
    hot_share: float = 0.05,
) -> DataFrame:
    """Join the stored result with any other table.

    Without ``skew_keys`` this is a plain equi-join (AQE picks broadcast by runtime size and
    splits skewed partitions). With ``skew_keys`` (a list of values, or ``"auto"`` to find
    the keys above ``hot_share`` of the result's rows) the rows of each such key are counted on both
    sides and spread over one bucket per ``rows_per_bucket`` of them by their place (see
    :func:`row_place`), so equal rows part too. A key that is hot on both sides gets a grid: each side's
    rows are dealt over its own buckets and repeated over the other's, so that every pair still meets exactly
    once. ``on`` must then be one column name. Semi and anti joins, and left joins, which must see all
    matches of a row together, spread the result's side alone.
    """
    if skew_keys is None:
        return result.join(source, on=on, how=how)
    if not isinstance(on, str):
        raise TypeError("salting needs 'on' as one column name")
    if how.lower() not in _SALTABLE:
        raise ValueError(f"salting keeps rows whole only for inner / left / semi / anti joins, not {how!r}")
    keys = hot_keys(result, on, hot_share) if isinstance(skew_keys, str) and skew_keys == "auto" else list(skew_keys)
    if not keys:
        return result.join(source, on=on, how=how)
    buckets = _buckets(result, on, keys, rows_per_bucket)
    if how.lower() != "inner":
        left = _dealt(result, buckets, _SALT)
        return left.join(_repeated(source, buckets, _SALT), on=[on, _SALT], how=how).drop(_SALT)
    others = _buckets(source, on, keys, rows_per_bucket)
    left = _repeated(_dealt(result, buckets, _SALT), others, _OTHER)
    right = _repeated(_dealt(source, others, _OTHER), buckets, _SALT)
    return left.join(right, on=[on, _SALT, _OTHER], how=how).drop(_SALT, _OTHER)


def _buckets(df: DataFrame, on: str, keys: list, rows_per_bucket: int) -> Column:
    """Buckets of a row's key: one per ``rows_per_bucket`` rows of a hot key, else one."""
    counted = df.where(F.col(on).isin(keys)).groupBy(on).agg(F.count(F.lit(1)).alias("n")).collect()
    out = F.lit(1)
    for row in counted:  # at most one per hot key
        out = F.when(F.col(on) == row[on], F.lit(-(-row["n"] // rows_per_bucket))).otherwise(out)
    return out.cast("int")


def _dealt(df: DataFrame, buckets: Column, name: str) -> DataFrame:
    placed = row_place(df, _PLACE)
    return placed.withColumn(name, F.pmod(F.xxhash64(_PLACE), buckets).cast("int")).drop(_PLACE)


def _repeated(df: DataFrame, buckets: Column, name: str) -> DataFrame:
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), buckets - 1)))


def row_place(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a column that tells its rows apart, the same whenever a task is run again: file and row
    of the scan that they come from, where the plan is one scan; else the place in a copy of the rows
    that is written to the shared scratch folder first (a join or an aggregate gives no lasting order)."""
    try:
        placed = df.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias(name))
        if len(df.inputFiles()) and not _many_leaves(df):
            return placed
    except AnalysisException:  # no file scan below, or its metadata do not reach here
        pass
    spark, where = df.sparkSession, scratch_path(df.sparkSession, "placed")
    placed = df.withColumn(name, F.monotonically_increasing_id())
    placed.write.parquet(where)
    remove_at_exit(spark, where)
    return spark.read.schema(placed.schema).parquet(where)


def _many_leaves(df: DataFrame) -> bool:
    """Whether rows of one file row may come out more than once (joins, unions, generators)."""
    todo, leaves = [df._jdf.queryExecution().optimizedPlan()], 0
    while todo:
        node = todo.pop()
        children = node.children()
        leaves += children.size() == 0
        if node.getClass().getSimpleName() in ("Generate", "Expand"):
            return True
        todo.extend(children.apply(i) for i in range(children.size()))
    return leaves != 1


def _holds_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_holds_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.MapType, T.VariantType))


def dedupe(df: DataFrame, key: str | Sequence[str], order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per key.

    Without ``order_by`` the survivor is arbitrary (``dropDuplicates``). With ``order_by``
    (strings, ``"-col"`` for descending) the first row in that order survives; ties go by the other
    columns that have an order. Nulls in an ordering column sort first ascending and last descending.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if not order_by:
        return df.dropDuplicates(keys)
    terms, named = [], set()
    for term in order_by:
        if not isinstance(term, str):
            raise TypeError("order_by takes column names; prefix '-' for descending")
        name = term.lstrip("-")
        named.add(name)
        terms.append(F.col(name).desc_nulls_last() if term.startswith("-") else F.col(name).asc_nulls_first())
    ties = [F.col(f"`{f.name}`").asc_nulls_first() for f in df.schema.fields
            if f.name not in named and f.name not in keys and not _holds_map(f.dataType)]
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*terms, *ties))
    return df.withColumn("__first", first).where("__first = 1").drop("__first")


def enrich_and_dedupe(
    spark: SparkSession, query_or_df: str | DataFrame, key: str, order_by: Sequence[str] | None = None
) -> DataFrame:
    """E7/E8 middle step: the configured cross-reference query, one row per segmentation id."""
    df = spark.sql(query_or_df) if isinstance(query_or_df, str) else query_or_df
    return dedupe(df, key, order_by)
