"""Transaction-shaped test data derived from the driver's ``events`` table.

The driver's tables hold no card transactions, so Bronze is derived from
``events`` by fixed expressions (FIXTURES.md section 8) that add the
duplicates, NULLs, ties and malformed values the operators must handle.
The same expressions exist as SQL for the DuckDB oracle in
``txnlake.plans.oracle``.  Test data only, not a product feature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.schemas import FEATURES, KEY

# Fixed values of the mapping (FIXTURES.md section 8).
BAD_TS_MOD, BAD_TS_REM = 100, 99
NULL_LAT_MOD, NULL_LAT_REM = 50, 7
DUP_MOD, DUP_REM = 20, 3
AMT_SCALE = 20
DOB_BASE = "1944-01-01"
AS_OF = "2024-02-01"
RUN_TS = "2024-01-31 00:00:00"  # inference time of the fixture and alert clock


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def bronze_from_events(events: DataFrame) -> DataFrame:
    """events -> Bronze transactions, including 5 % re-ingested copies."""
    eid, uid, ts, etype = F.col("event_id"), F.col("user_id"), F.col("ts"), F.col("event_type")
    is_err = etype == F.lit("error")
    lat_full = F.lit(30.0) + (uid * 37 % 1500) / F.lit(100.0)
    lon = F.lit(-100.0) + (uid * 53 % 3000) / F.lit(100.0)
    lat_off = F.when(is_err, F.lit(10) + eid % 10).otherwise(((eid * 7) % 100 - 50) / F.lit(1000.0))
    lon_off = F.when(is_err, F.lit(10) + eid % 10).otherwise(((eid * 11) % 100 - 50) / F.lit(1000.0))
    base = events.select(
        eid.cast("string").alias("trans_num"),
        uid.alias("cc_num"),
        F.when(eid % BAD_TS_MOD == BAD_TS_REM, F.lit("bad"))
        .otherwise(F.date_trunc("second", ts).cast("timestamp_ntz").cast("string"))
        .alias("trans_date_trans_time"),
        etype.alias("category"),
        (F.col("value") * AMT_SCALE).alias("amt"),
        F.when(eid % NULL_LAT_MOD == NULL_LAT_REM, F.lit(None).cast("double"))
        .otherwise(lat_full)
        .alias("lat"),
        lon.alias("long"),
        (lat_full + lat_off).cast("double").alias("merch_lat"),
        (lon + lon_off).cast("double").alias("merch_long"),
        (F.lit(1000) + (uid * 7919) % 999000).cast("int").alias("city_pop"),
        F.date_add(F.lit(DOB_BASE).cast("date"), ((uid * 97) % 22000).cast("int")).alias("dob"),
        F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").alias("unix_time"),
        F.when(is_err != (eid % 10 == 0), 1).otherwise(0).alias("is_fraud"),
        F.date_trunc("hour", ts).cast("timestamp_ntz").alias("ingestion_timestamp"),
    )
    dups = base.filter(F.col("trans_num").cast("long") % DUP_MOD == DUP_REM).withColumn(
        "ingestion_timestamp", F.col("ingestion_timestamp") + F.expr("INTERVAL 1 HOUR")
    )
    return base.unionByName(dups)


def predictions_from_gold(gold: DataFrame) -> DataFrame:
    """Stand-in scores for report tests (DuckDB cannot run a forest):
    a fixed formula of the features, one inference time per ``event_id % 3``."""
    eid = F.col("trans_num").cast("long")
    dist = F.least(F.coalesce(F.col("customer_merchant_distance"), F.lit(0.0)), F.lit(20.0))
    p = F.round(
        F.lit(0.25) * F.col("high_amount_flag")
        + F.lit(0.1) * F.col("night_transaction_flag")
        + F.lit(0.02) * dist
        + F.lit(0.25) * (eid % 97) / F.lit(97.0),
        6,
    )
    its = F.lit(RUN_TS).cast("timestamp_ntz") - F.make_dt_interval((eid % 3).cast("int"), F.lit(0), F.lit(0), F.lit(0))
    return gold.select(
        F.col(KEY),
        *[F.col(c) for c in FEATURES],
        F.when(p >= 0.5, 1).otherwise(0).alias("fraud_prediction"),
        p.alias("fraud_probability"),
        its.cast("timestamp_ntz").alias("inference_timestamp"),
    )


def fixture_layers(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> dict[str, DataFrame]:
    """Lazily derived layers over one scan of ``events``."""
    from txnlake.operators.gold import to_gold
    from txnlake.operators.silver import to_silver

    events = load_table(spark, sf_dir, "events")
    bronze = bronze_from_events(events)
    silver = to_silver(bronze)
    gold = to_gold(silver, as_of=as_of)
    return {
        "events": events,
        "bronze": bronze,
        "silver": silver,
        "gold": gold,
        "predictions": predictions_from_gold(gold),
    }
