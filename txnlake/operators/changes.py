"""Edits and deletes at a source that has no cursor for them: snapshot difference with tombstones.

The ingestion cursor sees rows that are new.  A row that was edited in place or deleted
leaves it where it was.  ``snapshot_changes`` compares what Bronze holds with a full
snapshot of the source and returns the rows to append to Bronze: inserted and updated
rows as they are now, and for each deleted key a tombstone (its last row with
``is_deleted``), all stamped with the snapshot's time, so that the latest copy of a key
is its present state.  Silver keeps tombstones like any latest row, so an older copy
that arrives late doesn't bring a deleted record back; Gold leaves them out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.operators.reconcile import compared_columns, suspects
from txnlake.operators.silver import ORDER_COL, dedupe_latest
from txnlake.schemas import KEY

DELETED = "is_deleted"


def is_live(df: DataFrame) -> Column:
    return ~F.coalesce(F.col(DELETED), F.lit(False)) if DELETED in df.columns else F.lit(True)


def live(df: DataFrame) -> DataFrame:
    """Rows without tombstones, and without their column."""
    return df.filter(is_live(df)).drop(DELETED) if DELETED in df.columns else df


def snapshot_changes(
    bronze: DataFrame, snapshot: DataFrame, at, key: str = KEY, order: str = ORDER_COL, bits: int | None = None
) -> DataFrame:
    """Rows to append to Bronze so that its live keys are those of ``snapshot``: the snapshot's columns with ``order``
    set to ``at``, ``is_deleted``, and ``change`` (insert, update, delete).

    A key's content is its latest row without the time in ``order``; a key that repeats in the snapshot counts with
    its latest row, rows without a key are left out.  Only keys in leaves whose digests differ are joined
    (``reconcile.suspects``), so a snapshot without changes costs one aggregate a side."""
    snapshot = dedupe_latest(snapshot.filter(F.col(key).isNotNull()), key, order)
    held = live(dedupe_latest(bronze.filter(F.col(key).isNotNull()), key, order)).select(*snapshot.columns)
    columns = compared_columns(held, snapshot, key, (order,))
    before, after = suspects(held, snapshot, key, columns, bits)
    before = before.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    after = after.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"))
    both = before.join(after, F.col("_old_key") == F.col("_new_key"), "full_outer")
    both = both.filter(~F.col("_old").eqNullSafe(F.col("_new")))
    gone = F.col("_new").isNull()
    row = F.when(gone, F.col("_old")).otherwise(F.col("_new"))
    change = F.when(gone, "delete").when(F.col("_old").isNull(), "insert").otherwise("update")
    rows = both.select(F.coalesce("_new_key", "_old_key").alias(key), row.alias("_row"), gone.alias(DELETED), change.alias("change"))
    kind = snapshot.schema[order].dataType
    return rows.select(key, "_row.*", F.lit(at).cast(kind).alias(order), DELETED, "change").select(*snapshot.columns, DELETED, "change")
