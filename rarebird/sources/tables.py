"""Table sources and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarebird.session import remove_path


def sql_source(spark: SparkSession, query_or_df: str | DataFrame) -> DataFrame:
    """A configured SQL text over the catalog, or a DataFrame passed straight through."""
    return spark.sql(query_or_df) if isinstance(query_or_df, str) else query_or_df


def read_file(
    spark: SparkSession, fmt: str, path: str, schema: T.StructType | str, header: bool = True, **options
) -> DataFrame:
    """S3: a file source with an explicit schema (no inference pass) and a header line."""
    reader = spark.read.format(fmt).schema(schema).option("header", str(header).lower())
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load(path)


def overwrite_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Replace the table's content (created when missing; ``path`` is the folder of its files).

    The new content is written to a folder of its own and the table is pointed there by one change of the
    catalog, so a write that dies leaves the old table, readers see the one or the other, and ``df`` may
    read the table it replaces. Only then are the old files removed. A table of other columns is
    replaced by two renames; :func:`recover_table` (called here first) undoes a crash between them.
    """
    _swap(df, name, fmt, path)


def _swap(df: DataFrame, name: str, fmt: str, path: str | None) -> None:
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    recover_table(spark, name)
    if not spark.catalog.tableExists(name):
        writer = df.write.format(fmt).mode("errorifexists")
        if path:
            writer = writer.option("path", f"{path.rstrip('/')}/{mark}")
        writer.saveAsTable(name)
        return
    old, old_fmt = _detail(spark, name, "Location"), _detail(spark, name, "Provider")
    fresh = f"{path.rstrip('/')}/{mark}" if path else f"{old.split(_VERSION)[0]}{_VERSION}{mark}"
    try:
        df.write.format(fmt).save(fresh)
    except BaseException:
        remove_path(spark, fresh)
        raise
    if _columns(df) == _columns(spark.table(name)) and old_fmt.lower() == fmt.lower():
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
    else:
        new, was = f"{name}{_NEW}{mark}", f"{name}{_OLD}{mark}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {new} ({columns}) USING {fmt} LOCATION '{fresh}'")
        _rename(spark, name, was)
        _rename(spark, new, name)
        old = _detail(spark, was, "Location")
        spark.sql(f"DROP TABLE {was}")
    spark.catalog.refreshTable(name)
    _remove_old(spark, old, fresh)


_VERSION, _NEW, _OLD = "__v", "__new_", "__old_"


def _rename(spark: SparkSession, name: str, to: str) -> None:
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")


def recover_table(spark: SparkSession, name: str) -> bool:
    """Brings ``name`` back after a crash between the two renames of a replacement: the new content if it
    stands under its temporary name, else the old one. Returns whether there was anything to do."""
    if spark.catalog.tableExists(name):
        return False
    database, _, plain = name.rpartition(".")
    listed = [t.name for t in (spark.catalog.listTables(database) if database else spark.catalog.listTables()) if not t.isTemporary]
    for kind in (_NEW, _OLD):
        held = sorted(t for t in listed if t.startswith((plain + kind).lower()) or t.startswith(plain + kind))
        if held:
            _rename(spark, f"{database}.{held[-1]}" if database else held[-1], name)
            return True
    return False


def _detail(spark: SparkSession, name: str, what: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where(F.col("col_name") == what).collect()
    return rows[-1]["data_type"] if rows else ""


def _columns(df: DataFrame) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def _remove_old(spark: SparkSession, old: str, fresh: str) -> None:
    """Removes the files at ``old``, but for the folder ``fresh`` if that lies inside."""
    paths = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    where = paths(old)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    plain = lambda p: fs.makeQualified(p).toUri().getPath().rstrip("/")
    if not plain(paths(fresh)).startswith(plain(where) + "/"):
        remove_path(spark, old)
        return
    for item in fs.listStatus(where):
        if not (plain(paths(fresh)) + "/").startswith(plain(item.getPath()) + "/"):
            fs.delete(item.getPath(), True)


def append_table(df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None) -> None:
    """Append rows; against an existing table, columns are matched by name and must be the
    table's own, no fewer and no more. ``path`` places the files of a table created by this call."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        target = [f.name for f in spark.table(name).schema.fields]
        missing, extra = set(target) - set(df.columns), set(df.columns) - set(target)
        if missing or extra:
            raise ValueError(f"rows for {name}: missing columns {sorted(missing)}, unknown columns {sorted(extra)}")
        df = df.select(*target)
        path = None
    writer = df.write.format(fmt).mode("append")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def replace_table_ctas(
    spark: SparkSession, df: DataFrame, name: str, fmt: str = "parquet", path: str | None = None
) -> None:
    """Drop the table (purging its files) and create it again from ``df`` (CTAS), as a swap: see
    :func:`overwrite_table`, with which it shares how content, columns and files are replaced. ``path`` is
    the folder under which each call places the files in a new folder of its own.
    """
    _swap(df, name, fmt, path)


def table_location(root: str | None, name: str | None) -> str | None:
    """Where a job puts table ``name`` under ``root`` (``None``: the catalog decides)."""
    if not root or not name:
        return None
    return f"{root.rstrip('/')}/{name.replace('.', '/')}"


def refresh(spark: SparkSession, name: str) -> None:
    """Drop cached metadata / file listings of a table after it was rewritten."""
    spark.catalog.refreshTable(name)
