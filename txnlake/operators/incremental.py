"""Incremental state: ingestion cursor, unscored selection, batch, idempotent append."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.operators.silver import dedupe_latest
from txnlake.schemas import KEY
from txnlake.session import checkpoint_dir

CURSOR = "ingestion_timestamp"
BATCH_SIZE = 5000  # fixed value: rows scored per run


def cursor_max(df: DataFrame, cursor: str = CURSOR):
    """High-water mark of a layer: one aggregate, one scalar to the driver."""
    return df.agg(F.max(F.col(cursor)).alias("m")).first()["m"]


def _lower_bound(source: DataFrame, bronze: DataFrame, cursor: str, lookback: dt.timedelta):
    """``max(cursor) - lookback`` of Bronze as a literal, None without a mark."""
    hi = cursor_max(bronze, cursor)
    return None if hi is None else F.lit(hi - lookback).cast(source.schema[cursor].dataType)


def _not_in(rows: DataFrame, seen: DataFrame, cursor: str, key: str) -> DataFrame:
    """``rows`` whose record ``seen`` lacks.  A record is its key plus its cursor
    value, compared NULL-safely; without a key it is its whole row (a hash)."""
    shared = [f.name for f in rows.schema.fields if f.name in seen.columns and not isinstance(f.dataType, T.MapType)]

    def identity(df: DataFrame) -> DataFrame:
        return df.withColumn("_row", F.when(F.col(key).isNull(), F.xxhash64(*shared)))

    s, b = identity(rows).alias("s"), identity(seen).select(key, cursor, "_row").alias("b")
    cond = None
    for c in (key, cursor, "_row"):
        same = F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}"))
        cond = same if cond is None else cond & same
    return s.join(b, cond, "left_anti").select(*[F.col(f"s.{c}") for c in rows.columns])


def ingest(
    source: DataFrame,
    bronze: DataFrame | None = None,
    cursor: str = CURSOR,
    lookback: dt.timedelta = dt.timedelta(0),
    key: str = KEY,
) -> DataFrame:
    """Rows of ``source`` to append to Bronze.

    First load (no Bronze, or Bronze empty): every source row.  Later loads:
    rows at or beyond ``max(cursor) - lookback``, minus those already in Bronze
    (a record is its key plus its cursor value, so a re-sent copy of a record
    with a newer ingestion time is kept, and the lookback overlap is not
    appended twice; a record without a key is its whole row).  The anti-join's
    right side is only Bronze's lookback window, not all of Bronze.  Rows
    without a cursor value cannot be placed after the mark; they are candidates
    on every load and matched NULL-safely, so each is appended once.
    ``below_mark`` reports what the mark leaves out.
    """
    lo = None if bronze is None else _lower_bound(source, bronze, cursor, lookback)
    if lo is None:
        return source
    window = (F.col(cursor) >= lo) | F.col(cursor).isNull()
    return _not_in(source.filter(window), bronze.filter(window), cursor, key)


def below_mark(
    source: DataFrame,
    bronze: DataFrame,
    cursor: str = CURSOR,
    lookback: dt.timedelta = dt.timedelta(0),
    key: str = KEY,
) -> DataFrame:
    """Source rows older than the ingestion window that Bronze does not hold:
    what a load with this ``lookback`` leaves out (load them with a longer one)."""
    lo = _lower_bound(source, bronze, cursor, lookback)
    if lo is None:
        return source.limit(0)
    return _not_in(source.filter(F.col(cursor) < lo), bronze.filter(F.col(cursor) < lo), cursor, key)


def unscored(gold: DataFrame, scored_keys: DataFrame, key: str = KEY) -> DataFrame:
    """Gold rows with no prediction yet (left anti-join on the key).

    NULL keys are excluded up front: they could never match and would be
    rescored forever.  No join hint: AQE picks broadcast when the scored-key
    side is measured small, sort-merge otherwise, and splits a skewed key.
    """
    keys = scored_keys.select(key).filter(F.col(key).isNotNull())
    return gold.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")


def next_batch(df: DataFrame, n: int | None = BATCH_SIZE, key: str = KEY, order: str = CURSOR) -> DataFrame:
    """The ``n`` oldest rows by (ingestion time, key), NULL times first.

    The key breaks ties so the batch is the same on every run and layout.
    Planned as ``TakeOrderedAndProject``: per-task top-n, merged in one task
    (n x tasks rows at most).  ``n=None`` selects everything.
    """
    if n is None:
        return df
    return df.orderBy(F.col(order).asc_nulls_first(), F.col(key).asc()).limit(n)


def batch_cut(df: DataFrame, n: int, order: str = CURSOR):
    """A time that the oldest ``n`` rows do not pass, or None if all are needed.

    Rows are counted per hour (one partial aggregate, one row per hour of
    history); filtering to the hour in which the running total reaches ``n``
    before the top-n keeps its merge to the rows of that hour instead of
    n rows from every task."""
    hours = df.filter(F.col(order).isNotNull()).groupBy(F.date_trunc("hour", order).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    # One row per hour: a year is 8,760 rows in the ordered pass.
    running = hours.withColumn("total", F.sum("n").over(Window.orderBy("h")))
    h = running.filter(F.col("total") >= n).agg(F.min("h").alias("h")).first()["h"]
    return None if h is None else h + dt.timedelta(hours=1)


def stamp(df: DataFrame, run_ts, col: str = "inference_timestamp") -> DataFrame:
    """One run time for all rows, passed in so a retried run writes the same value."""
    return df.withColumn(col, F.lit(run_ts).cast("timestamp_ntz"))


# Largest key set broadcast to filter another table's keys, in rows and in bytes
# of key text; beyond either the reduction is a plain (shuffled) semi-join.
MAX_BROADCAST_KEYS = 2_000_000
MAX_BROADCAST_BYTES = 64 << 20


def small_keys(rows: DataFrame, key: str = KEY) -> DataFrame:
    """The key column, marked for broadcast if its checked size, in rows and in bytes, allows it."""
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(key).cast("string"))).alias("b")).first()
    keys = rows.select(key)
    if size["n"] <= MAX_BROADCAST_KEYS and (size["b"] or 0) <= MAX_BROADCAST_BYTES:
        return F.broadcast(keys)
    return keys


def absent(rows: DataFrame, target_keys: DataFrame, key: str = KEY) -> DataFrame:
    """``rows`` (keys not NULL) whose key the target lacks.

    The target grows with every run; ``rows`` often does not.  A left-anti join
    can only build its right side, so the target's key column is first cut down
    to the keys asked for: one scan and no shuffle of it when their checked
    size, in rows and in bytes, allows a broadcast."""
    present = target_keys.select(key).join(small_keys(rows, key), key, "left_semi")
    return rows.join(present, key, "left_anti")


def one_row_per_key(batch: DataFrame, key: str = KEY, order: str = "inference_timestamp") -> DataFrame:
    """The batch's latest row of each key, checkpointed: what follows reads it several times."""
    b = batch.filter(F.col(key).isNotNull())
    if order in b.columns:
        b = dedupe_latest(b, key, order)
    elif CURSOR in b.columns:
        b = dedupe_latest(b, key, CURSOR)
    else:
        b = b.dropDuplicates([key])
    checkpoint_dir(batch.sparkSession)
    return b.checkpoint(eager=True)


def rows_to_append(batch: DataFrame, target_keys: DataFrame, key: str = KEY, order: str = "inference_timestamp") -> DataFrame:
    """Batch rows whose key the target lacks, one row per key: the idempotent
    part of an append. Re-applying the same batch yields no rows."""
    return absent(one_row_per_key(batch, key, order), target_keys, key)


def append_idempotent(batch: DataFrame, target_path: str, batch_id: str, key: str = KEY, store=None) -> int:
    """Append ``batch`` to a Parquet predictions table under ``batch_id=<id>``.

    Keys already present in *other* batches are skipped; the batch's own
    directory is replaced whole, so a retried run of the same batch replaces
    its files instead of adding a second copy, also when it has fewer rows or
    none.  Single writer per table is assumed (plain files have no MERGE).
    With ``store`` (a ``KeyStore`` of the table) the keys are looked up there
    instead of scanning those of all batches.  Returns the number of rows written.
    """
    from txnlake.sinks.batches import read_batches, uncover

    spark = batch.sparkSession
    schema = batch.schema
    if "batch_id" not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField("batch_id", T.StringType())])
    # Only *other* batches are read (partition pruning on batch_id), and only
    # this batch's directory is replaced, so the plan never reads what it
    # overwrites and a task retried after an executor loss sees the same input.
    own = f"{target_path.rstrip('/')}/batch_id={batch_id}"
    if store is not None:
        rows = store.absent(one_row_per_key(batch.drop("batch_id"), key), without=batch_id)
    else:
        others = read_batches(spark, target_path, schema).filter(F.col("batch_id") != F.lit(batch_id))
        rows = rows_to_append(batch.drop("batch_id"), others, key)
    rows.write.mode("overwrite").parquet(own)
    uncover(spark, target_path, batch_id)  # a compacted copy of the batch no longer counts
    return spark.read.schema(batch.drop("batch_id").schema).parquet(own).count()


# One row per scoring run: where its window began, and where the next one may
# begin once the run's batch is persisted.  Marks are arrival times: when the
# Gold file of a row was written, which no source clock or late record changes.
CURSOR_STATE = T.StructType(
    [
        T.StructField("mark_before", T.TimestampType()),
        T.StructField("mark_after", T.TimestampType()),
        T.StructField("rows", T.LongType()),
        T.StructField("batch_id", T.StringType()),
    ]
)
ARRIVED = "_arrived"


def with_arrival(layer: DataFrame) -> DataFrame:
    """A layer read from files with the time each row's file was written."""
    return layer.withColumn(ARRIVED, F.col("_metadata.file_modification_time"))


def scoring_mark(state: DataFrame, batch_id: str, persisted) -> dt.datetime | None:
    """Rows that arrived before this mark are all scored; None if nothing is known.

    A run's ``mark_after`` holds only once its batch is in the predictions
    (``persisted(batch_id)``), so a failed or skipped persistence never moves the
    mark.  A rerun of a batch starts where its first run did and selects the same rows.
    """
    rows = state.orderBy(F.desc("mark_after")).select("batch_id", "mark_before", "mark_after", "rows")
    own = rows.filter(F.col("batch_id") == F.lit(batch_id)).first()
    if own is not None:
        return own["mark_before"]
    for r in rows.filter(F.col("mark_after").isNotNull()).toLocalIterator():
        if r["rows"] == 0 or persisted(r["batch_id"]):
            return r["mark_after"]
    return None
