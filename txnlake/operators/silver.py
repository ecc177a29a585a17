"""Bronze -> Silver: key hygiene, deduplication, parsing, temporal features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.functions import features as X
from txnlake.schemas import KEY

ORDER_COL = "ingestion_timestamp"


def split_null_keys(df: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, quarantined rows without one).

    A NULL key never matches an anti-join, so such rows would be rescored on
    every run; they are kept out of the layers and reported instead.
    """
    return df.filter(F.col(key).isNotNull()), df.filter(F.col(key).isNull())


def _orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _orderable(dtype.elementType)
    return True


def latest_row(df: DataFrame, key: str = KEY, order: str = ORDER_COL) -> Column:
    """The aggregate that gives a key's latest row, as a struct of the other columns.

    Ties on ``order`` are broken by a 64-bit hash of the remaining values, so the
    choice is the same on every run and layout (rows tying on both are identical)."""
    cols = [c for c in df.columns if c != key]
    others = [c for c in cols if c != order]
    tie = F.xxhash64(*[F.col(c) for c in others if _orderable(df.schema[c].dataType)]) if others else F.lit(0)
    return F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(F.col(order), tie))


def dedupe_latest(df: DataFrame, key: str = KEY, order: str = ORDER_COL) -> DataFrame:
    """Keep one row per key: the latest by ``order`` (``latest_row``).

    Written as a grouped ``max_by`` rather than a ``row_number`` window: the
    aggregate combines map-side, so a key repeated millions of times (a feed
    resending one transaction) is collapsed before the shuffle instead of
    landing whole in one task.  The ordering is (time, hash), two fixed-width
    fields, so each row crosses the shuffle once, not twice.
    """
    rows = df.groupBy(key).agg(latest_row(df, key, order).alias("_row"))
    return rows.select(F.col(key), "_row.*").select(*df.columns)


def silver_columns(df: DataFrame, ts_col: str = "trans_date_trans_time") -> dict[str, Column]:
    # Text is parsed (unparseable -> NULL); a timestamp column (the source
    # table's declared type) only has its type normalised to wall-clock NTZ.
    kind = df.schema[ts_col].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        ts = F.col(ts_col).cast("timestamp_ntz")
    else:
        ts = X.parse_timestamp(F.col(ts_col))
    return {
        ts_col: ts,
        "transaction_year": F.year(ts),
        "transaction_month": F.month(ts),
        "transaction_day": F.dayofmonth(ts),
        "transaction_hour": F.hour(ts),
        "is_weekend": X.weekend_flag(ts),
        "amt": X.to_double(F.col("amt")),
    }


def standardize(df: DataFrame) -> DataFrame:
    """Parse the transaction time, derive year/month/day/hour and the weekend
    flag, and make the amount a double. One projection, no shuffle."""
    return df.withColumns(silver_columns(df))


def to_silver(bronze: DataFrame, dedupe: bool = True, key: str = KEY) -> DataFrame:
    """Bronze -> Silver. Null keys are quarantined, duplicates collapsed to the
    latest ingestion, then the row-level standardisation is applied."""
    valid, _ = split_null_keys(bronze, key)
    if dedupe:
        valid = dedupe_latest(valid, key)
    return standardize(valid)


def silver_quality(bronze: DataFrame, key: str = KEY) -> DataFrame:
    """One row of reject counts over Bronze: rows, NULL keys, duplicate copies
    (rows beyond one per key), unparseable times (text present, no
    timestamp), NULL amounts and NULL coordinates.  One aggregate; the
    distinct count combines map-side, so a key repeated millions of times
    collapses before its shuffle."""
    ts = X.parse_timestamp(F.col("trans_date_trans_time"))
    return bronze.agg(
        F.count(F.lit(1)).alias("bronze_rows"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
        (F.count(F.col(key)) - F.count_distinct(F.col(key))).alias("duplicate_rows"),
        F.count_if(F.col("trans_date_trans_time").isNotNull() & ts.isNull()).alias("bad_timestamps"),
        F.count_if(X.to_double(F.col("amt")).isNull()).alias("null_amounts"),
        F.count_if(F.col("lat").isNull() | F.col("long").isNull()).alias("null_coordinates"),
    )
