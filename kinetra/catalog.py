"""Publishing tables through the session's catalog.

A rebuilt table is written to a folder of its own; then one catalog statement
(``ALTER TABLE ... SET LOCATION``) makes the name stand for it.  A reader sees the old
rows or the new ones, never none and never a mixture, on any file system: nothing is
renamed or overwritten, and a write that dies leaves the name as it was.  Folders that
no name stands for any more stay until ``drop_unused`` is called, so that queries which
began on them can end.

A partitioned table is switched partition by partition: the catalog holds one location
for each, so a reader sees each partition old or new.  The statements are as many as the
partitions of the batch (source files of a run), not of the table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from kinetra.session import _hadoop_path, for_partitioned_write, remove_path


class SchemaConflict(ValueError):
    """The new rows lack a column of the table, or hold it with another type."""


@dataclass(frozen=True)
class Buckets:
    """How the rows of each partition are dealt to files: tables with equal buckets are
    joined and windowed by the columns ``by`` without a shuffle."""

    number: int
    by: tuple[str, ...]
    sort: tuple[str, ...]

    def clause(self) -> str:
        by, sort = (", ".join(f"`{c}`" for c in cols) for cols in (self.by, self.sort))
        return f"CLUSTERED BY ({by}) SORTED BY ({sort}) INTO {self.number} BUCKETS"


def write_bucketed(df: DataFrame, table: str, path: str, buckets: Buckets,
                   partition_col: str | None = None) -> DataFrame:
    """Write ``df`` to ``path`` as the new table ``table`` and return a reader.  Rows that
    are dealt by the buckets already are only sorted; others make a file per task and
    bucket, so deal them (``repartition``) first."""
    w = df.write.format("parquet").bucketBy(buckets.number, *buckets.by).sortBy(*buckets.sort)
    if partition_col:
        w = w.partitionBy(partition_col)
    w.option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(df: DataFrame, names: list[str]) -> str:
    return ", ".join(f"`{n}` {df.schema[n].dataType.simpleString()}" for n in names)


def _sync_columns(df: DataFrame, table: str) -> None:
    """Give the table the columns that are new in ``df``; readers of the old folder see
    NULL there."""
    have, new = dict(df.sparkSession.table(table).dtypes), dict(df.dtypes)
    wrong = [n for n, t in have.items() if new.get(n) != t]
    if wrong:
        raise SchemaConflict(f"{table}: columns {wrong} are missing or of another type")
    added = [n for n in df.columns if n not in have]
    if added:
        df.sparkSession.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(df, added)})")


def publish(df: DataFrame, table: str, root: str, partition_col: str | None = None,
            buckets: Buckets | None = None) -> DataFrame:
    """Make the catalog's ``table`` hold the rows of ``df`` (with ``partition_col``: make
    its partitions that occur in ``df`` hold them; the others stay).  Folders are made
    below ``root``; the table is created where there is none.  ``df`` may read the table
    itself.  Columns can be added, not dropped or retyped (``SchemaConflict``).  Without
    rows a table is emptied, a partitioned one stays as it is.  ``buckets`` (partitioned
    tables only, the same at every call) bucket the files.  Returns a reader."""
    spark = df.sparkSession
    path = f"{root.rstrip('/')}/{table}-{uuid.uuid4().hex[:12]}"
    exists = spark.catalog.tableExists(table)
    if partition_col is None:
        df.write.parquet(path)
        if exists:
            _sync_columns(df, table)
            spark.sql(f"ALTER TABLE {table} SET LOCATION {_text(path)}")
        else:
            spark.sql(f"CREATE TABLE {table} ({_columns(df, df.columns)}) USING parquet LOCATION {_text(path)}")
        spark.catalog.refreshTable(table)
        return spark.table(table)

    names = [c for c in df.columns if c != partition_col] + [partition_col]
    if buckets:
        own = f"{table}_{uuid.uuid4().hex[:12]}"
        write_bucketed(df.select(*names), own, path, buckets, partition_col)
        spark.sql(f"DROP TABLE {own}")  # an external table: its files stay
    else:
        for_partitioned_write(df.select(*names), partition_col).write.partitionBy(partition_col).parquet(path)
    if exists:
        _sync_columns(df, table)
    else:
        home = f"{root.rstrip('/')}/{table}-partitions"
        spark.sql(f"CREATE TABLE {table} ({_columns(df, names)}) USING parquet PARTITIONED BY (`{partition_col}`) "
                  f"{buckets.clause() if buckets else ''} LOCATION {_text(home)}")
    known = {r[0] for r in _partitions(spark, table, partition_col)}
    for value, folder in _written(spark, path, partition_col):
        spec = f"PARTITION (`{partition_col}` = {_text(value)})"
        if f"{partition_col}={value}" in known:
            spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION {_text(folder)}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD {spec} LOCATION {_text(folder)}")
    spark.catalog.refreshTable(table)
    return spark.table(table)


def _partitions(spark: SparkSession, table: str, partition_col: str):
    """The catalog's partitions as ``column=value``."""
    return [(f"{partition_col}={_unescaped(spark, r[0].split('=', 1)[1])}",)
            for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]


def _unescaped(spark: SparkSession, name: str) -> str:
    """A value as Spark spells it in a folder's name, read back."""
    return spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(name)


def _written(spark: SparkSession, path: str, partition_col: str) -> list[tuple[str, str]]:
    """(value, folder) of the partitions below ``path``: one per source file of the batch."""
    fs, p = _hadoop_path(spark, path)
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(partition_col + "="):
            out.append((_unescaped(spark, name.split("=", 1)[1]), s.getPath().toString()))
    return sorted(out)


def locations(spark: SparkSession, table: str, partition_col: str | None = None) -> set[str]:
    """The folders that the table's name stands for."""
    if partition_col is None:
        return {r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
                if r.col_name == "Location"}
    found = set()
    for name, in _partitions(spark, table, partition_col):
        spec = f"PARTITION (`{partition_col}` = {_text(name.split('=', 1)[1])})"
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {spec}").collect()
        found |= {r.data_type for r in rows if r.col_name == "Location"}
    return found


def drop_unused(spark: SparkSession, table: str, root: str, partition_col: str | None = None) -> int:
    """Delete the folders of earlier publications of ``table`` below ``root`` that its name
    does not stand for any more; returns how many.  Call it when no query that began
    before the last publication still runs."""
    used = {u.rstrip("/") for u in locations(spark, table, partition_col)}
    fs, p = _hadoop_path(spark, root)
    gone = 0
    for s in fs.listStatus(p):
        name, folder = s.getPath().getName(), s.getPath().toString().rstrip("/")
        if not name.startswith(table + "-") or len(name) != len(table) + 13:
            continue
        if not any(_same(u, folder) or _same(u.rsplit("/", 1)[0], folder) for u in used):
            remove_path(spark, folder)
            gone += 1
    return gone


def _same(a: str, b: str) -> bool:
    """Whether two spellings of a folder (``file:/x``, ``file:///x``) are one."""
    return a.split(":", 1)[-1].lstrip("/") == b.split(":", 1)[-1].lstrip("/")

