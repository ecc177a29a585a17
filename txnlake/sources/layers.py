"""Readers for lake layers, raw CSV, existing prediction keys and JDBC tables."""

from __future__ import annotations

import datetime as dt
import decimal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.schemas import KEY, check_columns


def read_layer(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    required: list[str] | None = None,
) -> DataFrame:
    """Parquet layer; partition discovery restores ``transaction_year/month``.

    With ``schema`` the files are read with that contract (no inference pass);
    ``required`` columns are checked either way.  Filters and projections
    applied by callers reach the scan as ``PushedFilters`` /
    ``PartitionFilters`` / ``ReadSchema``.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(path)
    if required:
        check_columns(df, required, path)
    return df


#: A layer that holds tombstones has this file beside its data; files written before the first one lack the column.
TOMBSTONES = "_tombstones"


def read_with_tombstones(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """A layer with its ``is_deleted`` column, if any of its files may have one (else as ``read_layer``)."""
    from txnlake.operators.changes import DELETED
    from txnlake.sinks.layers import path_exists

    df = read_layer(spark, path, required=required)
    if DELETED in df.columns or not path_exists(spark, f"{path.rstrip('/')}/{TOMBSTONES}"):
        return df
    # Spark takes the schema from one file; a column that a file lacks is NULL in its rows.
    return read_layer(spark, path, T.StructType([*df.schema.fields, T.StructField(DELETED, T.BooleanType())]))


def _is_missing_path(e: AnalysisException) -> bool:
    cond = getattr(e, "getCondition", None) or getattr(e, "getErrorClass", None)
    name = cond() if callable(cond) else None
    return name == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(e)


def holds_nothing(spark: SparkSession, path: str) -> bool:
    """Whether a partitioned layer was written without a row: it has no file to take a schema from."""
    try:
        spark.read.parquet(path)
        return False
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" in str(e):
            return True
        raise


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """An absent table is an empty one; every other failure propagates
    (an outage must not read as "nothing scored yet")."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as e:
        if _is_missing_path(e):
            return spark.createDataFrame([], schema)
        raise


def read_raw_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    corrupt_column: str = "_corrupt_record",
    infer: bool = True,
) -> DataFrame:
    """Header CSV, parsed on the executors. With a schema, malformed lines
    are kept (PERMISSIVE) and their text lands in ``corrupt_column``.
    ``infer=False`` keeps every value as text, without a pass for the types."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is not None:
        if corrupt_column not in schema.fieldNames():
            schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])
        reader = reader.schema(schema).option("columnNameOfCorruptRecord", corrupt_column)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def existing_keys(predictions: DataFrame, key: str = KEY) -> DataFrame:
    """Only the key column of the scored table (column pruning reaches the scan)."""
    return predictions.select(F.col(key)).filter(F.col(key).isNotNull())


def jdbc_table_exists(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> bool:
    """Whether the database's metadata list the table; a failed connection raises."""
    props = spark._jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, str(v))
    owner, _, name = table.replace('"', "").rpartition(".")
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        meta = connection.getMetaData()
        # Unquoted names are stored in the database's own case.
        spellings = {(owner, name), (owner.upper(), name.upper()), (owner.lower(), name.lower())}
        return any(meta.getTables(None, o or None, n, None).next() for o, n in spellings)
    finally:
        connection.close()


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    num_partitions: int | None = None,
    columns: list[str] | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """Database table read in parallel: by ranges of a numeric ``partition_column``,
    or by ``predicates``, disjoint SQL conditions that together cover all rows (as
    ranges or a hash of a text key), one connection for each; without either in one
    task. ``columns`` prunes the
    SELECT list sent to the database."""
    props = dict(properties or {})
    # Quoted names: Spark creates tables with case-preserved column names.
    src = table if not columns else "(SELECT {} FROM {}) t".format(", ".join(f'"{c}"' for c in columns), table)
    if predicates is not None:
        return spark.read.jdbc(url, src, predicates=predicates, properties=props)
    if partition_column is not None:
        return spark.read.jdbc(
            url,
            src,
            column=partition_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=num_partitions or 8,
            properties=props,
        )
    return spark.read.jdbc(url, src, properties=props)


def read_jdbc_parallel(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    num_partitions: int,
    properties: dict[str, str] | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """Whole-table read in ``num_partitions`` parallel ranges of a numeric
    column, the bounds asked from the database first (one tiny MIN/MAX query
    run by the database, not a scan in Spark).  An empty table reads as one
    empty partition."""
    props = dict(properties or {})
    q = f'(SELECT MIN("{partition_column}") AS lo, MAX("{partition_column}") AS hi FROM {table}) b'
    row = spark.read.jdbc(url, q, properties=props).first()
    lo, hi = (row[0], row[1]) if row is not None else (None, None)
    if lo is None:
        return read_jdbc(spark, url, table, props, columns=columns)
    return read_jdbc(
        spark, url, table, props, partition_column=partition_column, lower=int(lo), upper=int(hi) + 1,
        num_partitions=num_partitions, columns=columns,
    )


# One row a split point, asked from the database's own order of the column; with an index it reads the index.
SPLIT_SQL = '(SELECT "{column}" AS k FROM {table} WHERE "{column}" IS NOT NULL ORDER BY "{column}" OFFSET {at} ROWS FETCH NEXT 1 ROWS ONLY) s'


def split_points(
    spark: SparkSession, url: str, table: str, column: str, num_partitions: int, properties: dict[str, str] | None = None, split_sql: str = SPLIT_SQL
) -> list:
    """Values of ``column`` that cut the table into ``num_partitions`` ranges of about equal rows, in rising order.

    The database counts the rows and gives the value at each cut; no key travels but the cuts.  A value that many rows
    share is one cut, as ranges can't divide it.  ``split_sql`` is the query for databases with another dialect."""
    props = dict(properties or {})
    n = spark.read.jdbc(url, f'(SELECT COUNT("{column}") AS n FROM {table}) c', properties=props).first()[0]
    points = []
    for i in range(1, num_partitions):
        at = n * i // num_partitions
        if 0 < at < n:
            row = spark.read.jdbc(url, split_sql.format(column=column, table=table, at=at), properties=props).first()
            if row is not None and row[0] not in points:
                points.append(row[0])
    return points


def _literal(value) -> str:
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no range can be cut at {value!r}")
    if isinstance(value, (int, float, decimal.Decimal)):
        return repr(value) if isinstance(value, float) else str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    raise ValueError(f"no range can be cut at {value!r}")


def range_predicates(column: str, points: list) -> list[str]:
    """Disjoint conditions that cover all rows: NULLs are in the first."""
    if not points:
        return ["1 = 1"]
    c, cuts = f'"{column}"', [_literal(p) for p in points]
    middle = [f"{c} >= {a} AND {c} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [f"({c} < {cuts[0]} OR {c} IS NULL)", *middle, f"{c} >= {cuts[-1]}"]


def read_jdbc_balanced(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    num_partitions: int,
    properties: dict[str, str] | None = None,
    columns: list[str] | None = None,
    split_sql: str = SPLIT_SQL,
) -> DataFrame:
    """Whole-table read in ranges of about equal rows of any ordered ``column``, also a text key or a skewed number."""
    points = split_points(spark, url, table, column, num_partitions, properties, split_sql)
    wanted = columns if columns is None or column in columns else [*columns, column]
    df = read_jdbc(spark, url, table, properties, columns=wanted, predicates=range_predicates(column, points))
    return df if columns is None else df.select(*columns)
