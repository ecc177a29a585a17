"""Label recoding and display formatting as Spark SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed display labels of the reports.
PREDICTION_LABELS = {0: "Non Fraud", 1: "Fraud"}
AMOUNT_LABELS = {0: "Normal Amount", 1: "High Amount"}
TIME_LABELS = {0: "Day", 1: "Night"}

# Fixed alert texts.
ALERT_TITLE = "\U0001f6a8 Fraud Transactions Detected\n\n"
ALERT_NONE = "No frauds detected."
ALERT_SENT = "{} fraud alerts sent."


def recode(c: Column, mapping: dict) -> Column:
    """Replace mapped values by their label; unmapped values pass through as text."""
    out = None
    for k, v in mapping.items():
        out = (F.when(c == F.lit(k), F.lit(v))) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out.otherwise(c.cast("string")) if out is not None else c.cast("string")


def thousands(c: Column) -> Column:
    """1234 -> '1,234'."""
    return F.format_number(c, 0)


def percent(c: Column, digits: int = 2) -> Column:
    """12.3456 -> '12.35%'; NULL stays NULL (``format_string`` would print
    a truncated 'null')."""
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f%%", c))


def money(c: Column) -> Column:
    """1234.5 -> '$1,234.50'."""
    return F.concat(F.lit("$"), F.format_number(c, 2))


def fixed(c: Column, digits: int = 4) -> Column:
    return F.when(c.isNotNull(), F.format_string(f"%.{digits}f", c))


def minute_stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm")


def alert_line(trans_num: Column, amt: Column, prob: Column, ts: Column) -> Column:
    """One alert block: key, amount as stored, probability to 4 places, time."""
    return F.format_string(
        "Transaction: %s\nAmount: $%s\nProbability: %.4f\nTimestamp: %s\n\n",
        trans_num,
        amt.cast("string"),
        prob,
        ts.cast("string"),
    )
