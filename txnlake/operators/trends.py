
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _windowed_counts(df: DataFrame, ts_col: str, flag_col: str, every: str, slide: str | None) -> DataFrame:
    w = F.window(F.col(ts_col), every, slide) if slide else F.window(F.col(ts_col), every)
    return (
        df.filter(F.col(ts_col).isNotNull())
        .groupBy(w.alias("w"))
        .agg(F.count(F.lit(1)).alias("transactions"), F.count_if(F.col(flag_col) == 1).alias("frauds"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "transactions",
            "frauds",
            (F.col("frauds") * F.lit(100.0) / F.col("transactions")).alias("fraud_rate"),
        )
    )


def fraud_trend(
    df: DataFrame,
    ts_col: str = "trans_date_trans_time",
    flag_col: str = "is_fraud",
    every: str = "1 hour",
    slide: str | None = None,
) -> DataFrame:
    """Transactions, frauds and fraud rate per event-time window (tumbling, or
    sliding with ``slide``), and the change in frauds against the previous
    window, the one that starts ``every`` (``slide``, if given) earlier; a
    window without transactions has 0 frauds, the first one no change.

    The counts are a partial aggregate keyed by window; the change is a join of
    these few rows with themselves, moved on by one window.
    """
    counts = _windowed_counts(df, ts_col, flag_col, every, slide)
    step = F.expr(f"INTERVAL {slide or every}")
    before = counts.select((F.col("window_start") + step).alias("window_start"), F.col("frauds").alias("_before"))
    start = counts.agg(F.min("window_start").alias("_first"))
    joined = counts.join(before, "window_start", "left").join(F.broadcast(start))
    change = F.when(F.col("window_start") > F.col("_first"), F.col("frauds") - F.coalesce("_before", F.lit(0)))
    return joined.withColumn("frauds_change", change).drop("_before", "_first")


def fraud_trend_stream(
    stream: DataFrame,
    ts_col: str = "trans_date_trans_time",
    flag_col: str = "is_fraud",
    every: str = "1 hour",
    slide: str | None = None,
    watermark: str = "2 hours",
) -> DataFrame:
    """The same counts on a stream: event time cast to TIMESTAMP (watermarks
    reject TIMESTAMP_NTZ), windows finalised once the watermark passes them
    (append mode), late rows beyond the watermark dropped by Spark."""
    ev = "_event_time"
    s = stream.withColumn(ev, F.col(ts_col).cast("timestamp")).withWatermark(ev, watermark)
    return _windowed_counts(s, ev, flag_col, every, slide)
