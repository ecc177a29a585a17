"""Fraud alerts: recent predicted frauds, newest first, and their message."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions import formatting as fmt
from txnlake.schemas import ALERTS, KEY

ALERT_LIMIT = 10  # fixed value: alerts per message
ALERT_WINDOW = dt.timedelta(days=1)  # fixed value: look-back from "now"
ALERT_COLUMNS = ALERTS.fieldNames()


def _ts(now) -> F.Column:
    return F.lit(now).cast("timestamp_ntz")


def recent_fraud(df: DataFrame, now, window: dt.timedelta = ALERT_WINDOW) -> DataFrame:
    """Predicted frauds scored at or after ``now - window``; ``now`` is an argument."""
    since = _ts(now) - F.make_dt_interval(F.lit(window.days), F.lit(0), F.lit(0), F.lit(window.seconds))
    return df.filter((F.col("fraud_prediction") == 1) & (F.col("inference_timestamp") >= since))


def alerts(
    df: DataFrame,
    now,
    limit: int = ALERT_LIMIT,
    threshold: float | None = None,
    already_alerted: DataFrame | None = None,
    key: str = KEY,
) -> DataFrame:
    """Up to ``limit`` latest recent frauds, ties broken by key.

    Optional, off by default: a probability ``threshold`` and an anti-join
    against keys alerted before, so repeated runs do not resend.
    """
    d = recent_fraud(df, now)
    if threshold is not None:
        d = d.filter(F.col("fraud_probability") >= threshold)
    if already_alerted is not None:
        d = d.join(already_alerted.select(key), key, "left_anti")
    return d.orderBy(F.desc("inference_timestamp"), F.col(key)).limit(limit).select(*ALERT_COLUMNS)


def alert_message(a: DataFrame) -> DataFrame:
    """One row: alert count, status text, and the message (title + one block
    per alert, newest first; NULL when there is nothing to send).

    The input is already bounded by ``limit``; the blocks are ordered inside
    one array (sorted structs), not by a window.
    """
    line = fmt.alert_line(F.col("trans_num"), F.col("amt"), F.col("fraud_probability"), F.col("inference_timestamp"))
    # Newest first without a zone-dependent cast: micro-seconds until a fixed
    # far-future instant grow as the timestamp gets older.
    newest_first = F.expr("timestampdiff(MICROSECOND, inference_timestamp, TIMESTAMP_NTZ'2200-01-01 00:00:00')")
    order_key = F.struct(
        newest_first.alias("o"),
        F.col("trans_num").alias("k"),
        line.alias("m"),
    )
    agg = a.agg(F.count(F.lit(1)).alias("n_alerts"), F.array_sort(F.collect_list(order_key)).alias("_b"))
    body = F.concat(F.lit(fmt.ALERT_TITLE), F.array_join(F.transform(F.col("_b"), lambda s: s["m"]), ""))
    return agg.select(
        "n_alerts",
        F.when(F.col("n_alerts") == 0, F.lit(fmt.ALERT_NONE))
        .otherwise(F.format_string(fmt.ALERT_SENT.replace("{}", "%d"), F.col("n_alerts")))
        .alias("status"),
        F.when(F.col("n_alerts") > 0, body).alias("message"),
    )


def alert_batch(df: DataFrame, now, **kw) -> DataFrame:
    return alert_message(alerts(df, now, **kw))
