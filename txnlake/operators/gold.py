"""Silver -> Gold: customer age, amount and night flags, merchant distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.functions import features as X
from txnlake.operators.changes import live


def gold_columns(as_of=None, with_haversine: bool = False) -> dict[str, Column]:
    cols = {
        "customer_age": X.customer_age(F.col("dob"), as_of),
        "high_amount_flag": X.high_amount_flag(F.col("amt")),
        "night_transaction_flag": X.night_flag(F.col("transaction_hour")),
        "customer_merchant_distance": X.euclidean_degrees(
            F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long")
        ),
    }
    if with_haversine:
        cols["customer_merchant_km"] = X.haversine_km(
            F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long")
        )
    return cols


def to_gold(silver: DataFrame, as_of=None, with_haversine: bool = False) -> DataFrame:
    """Narrow projection over Silver: no shuffle, partitioning preserved.

    ``as_of`` fixes the date ages are measured at, so a rerun of the same data
    gives the same features; ``None`` means today, as the original job did.
    Tombstones (``operators.changes``) are left out.
    """
    return live(silver).withColumns(gold_columns(as_of, with_haversine))
