"""Writers: partitioned layers, prediction batches, JDBC, exports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from txnlake.schemas import PARTITION_COLS


def write_layer(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_cols: list[str] | None = None,
    touched_only: bool = False,
    rebalance: bool = False,
) -> None:
    """Write a layer partitioned by (year, month).

    * ``touched_only``: dynamic partition overwrite, so only the months present
      in ``df`` are replaced (incremental refresh); otherwise the whole layer.
    * ``rebalance``: one shuffle on the partition columns through the
      ``REBALANCE`` hint; AQE then splits any month larger than the advisory
      partition size over several tasks and merges small ones, so files come
      out near the advisory size even when one month holds a third of the
      data (a plain ``repartition(year, month)`` would write that month from
      a single task).  Without it no shuffle is added: rows are sorted by
      month inside each task, which then writes one file per month it holds.
      Use it after a shuffle on another key (Silver's dedupe); a narrow job
      over month-partitioned input (Gold) does not need it.

    Never point ``path`` at the layer ``df`` was read from: Spark deletes the
    old files before the new ones are computed.
    """
    parts = partition_cols if partition_cols is not None else PARTITION_COLS
    if rebalance and parts:
        df = df.hint("rebalance", *parts)
    if parts:
        df = df.sortWithinPartitions(*parts)
    # Set on every write: a session-wide default must not turn a full
    # recompute into a partial one (or the reverse).
    w = df.write.mode(mode).option("partitionOverwriteMode", "dynamic" if touched_only else "static")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(path)


def _file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path``, so any store that Spark writes to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file_system(spark, path)
    return fs.exists(p)


def touch(spark: SparkSession, path: str) -> None:
    """An empty marker file."""
    p, fs = _file_system(spark, path)
    fs.create(p, True).close()


def drop_partitions(spark: SparkSession, path: str, values: list[tuple], partition_cols: list[str] | None = None) -> None:
    """Remove the named partitions of a layer: a dynamic overwrite replaces the
    partitions it has rows for and leaves one that lost its last row."""
    for row in values:
        parts = (f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(partition_cols or PARTITION_COLS, row))
        p, fs = _file_system(spark, "/".join([path.rstrip("/"), *parts]))
        fs.delete(p, True)


def batch_path(root: str, batch_id: str) -> str:
    return f"{root.rstrip('/')}/batch_id={batch_id}"


def write_batch(df: DataFrame, root: str, batch_id: str) -> str:
    """Overwrite the batch directory ``root/batch_id=<id>``; an empty batch is
    written too, so a downstream step never replays an older batch."""
    p = batch_path(root, batch_id)
    df.write.mode("overwrite").parquet(p)
    return p


JDBC_BATCH_ROWS = 5000  # fixed value: rows per INSERT batch


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    properties: dict[str, str] | None = None,
    batchsize: int = JDBC_BATCH_ROWS,
    max_connections: int | None = None,
    truncate: bool = True,
) -> None:
    """JDBC write from the executors, ``batchsize`` rows per INSERT batch.
    ``max_connections`` coalesces (no shuffle) to bound open connections;
    ``truncate`` keeps the table's DDL on overwrite."""
    if max_connections:
        df = df.coalesce(max_connections)
    props = dict(properties or {})
    props["batchsize"] = str(batchsize)
    if mode == "overwrite" and truncate:
        props["truncate"] = "true"
    df.write.jdbc(url, table, mode=mode, properties=props)


def export(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Backup copy as CSV (with header) or Parquet, written by the executors."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def jdbc_storable(df: DataFrame) -> DataFrame:
    """Drop nested columns (structs, maps), such as the ingestion tool's
    metadata record: JDBC has no column type for them."""
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StructType, T.MapType))]
    return df.drop(*nested) if nested else df


def full_load(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, **kw) -> None:
    """Overwrite a database table with a layer, nested columns dropped."""
    write_jdbc(jdbc_storable(df), url, table, mode="overwrite", properties=properties, **kw)


_TABLE_NAME = re.compile(r"^[A-Za-z_]\w*(\.[A-Za-z_]\w*)?$")


def reset_tables(spark: SparkSession, names: list[str]) -> None:
    """Drop the named catalog tables (an explicit list, never a pattern).
    Names must be plain, optionally database-qualified, identifiers."""
    bad = [n for n in names if not _TABLE_NAME.match(n)]
    if bad:
        raise ValueError(f"not a table name: {bad}")
    for n in names:
        spark.sql(f"DROP TABLE IF EXISTS {n}")
