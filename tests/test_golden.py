"""Recompute flags and distance of the ten published prediction rows."""

import pytest
from pyspark.sql import functions as F

from txnlake.operators.gold import gold_columns

# The ten published sample predictions (amt, lat, long, merch_lat,
# merch_long, transaction_hour, high_amount_flag, night_transaction_flag,
# customer_merchant_distance), rounded to 6 places as published.
GOLDEN = [
    (259.23, 35.648352, -81.293576, 35.642961, -81.328790, 16, 0, 0, 0.035624),
    (299.77, 35.336268, -89.218425, 35.321683, -89.263368, 7, 0, 0, 0.047250),
    (263.33, 30.892875, -94.582859, 30.905323, -94.578914, 18, 0, 0, 0.013058),
    (128.82, 36.286214, -82.499280, 36.242350, -82.503554, 2, 0, 1, 0.044072),
    (71.92, 37.642593, -86.040738, 37.672605, -86.069031, 7, 0, 0, 0.041246),
    (46.95, 36.236825, -85.231244, 36.257197, -85.201960, 20, 0, 0, 0.035673),
    (31.99, 39.944753, -78.655733, 39.922838, -78.606837, 22, 0, 0, 0.053583),
    (155.55, 37.797859, -74.447809, 37.810607, -74.491782, 2, 0, 1, 0.045784),
    (119.42, 34.191304, -76.696008, 34.197400, -76.723568, 5, 0, 1, 0.028226),
    (18.81, 30.574312, -84.313331, 30.594959, -84.289883, 2, 0, 1, 0.031243),
]


def test_published_rows_recompute(spark):
    df = spark.createDataFrame(
        GOLDEN,
        "amt double, lat double, long double, merch_lat double, merch_long double, transaction_hour int, "
        "hi int, night int, dist double",
    ).withColumn("dob", F.lit(None).cast("date"))
    cols = gold_columns(as_of="2026-05-13")
    out = df.select("hi", "night", "dist", *[v.alias(k) for k, v in cols.items() if k != "customer_age"]).collect()
    for r in out:
        assert r["high_amount_flag"] == r["hi"]
        assert r["night_transaction_flag"] == r["night"]
        assert r["customer_merchant_distance"] == pytest.approx(r["dist"], abs=1e-5)
