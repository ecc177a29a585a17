"""Hand-written edge rows for the Silver and Gold features (FIXTURES.md section 9)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txnlake.operators.gold import to_gold
from txnlake.operators.silver import dedupe_latest, silver_quality, split_null_keys, to_silver

SCHEMA = (
    "trans_num string, trans_date_trans_time string, amt double, lat double, long double, "
    "merch_lat double, merch_long double, dob date, ingestion_timestamp timestamp_ntz"
)
T0 = dt.datetime(2024, 1, 1)


def row(key, ts="2024-01-05 10:00:00", amt=10.0, dob=dt.date(1990, 1, 1), ing=T0, lat=30.0):
    return (key, ts, amt, lat, -90.0, 30.0, -90.0, dob, ing)


def silver_of(spark, rows):
    return to_silver(spark.createDataFrame(rows, SCHEMA))


def by_key(df, col):
    return {r["trans_num"]: r[col] for r in df.select("trans_num", col).collect()}


def test_high_amount_is_strictly_above_500(spark):
    g = to_gold(silver_of(spark, [row("a", amt=499.99), row("b", amt=500.0), row("c", amt=500.01), row("d", amt=None)]))
    assert by_key(g, "high_amount_flag") == {"a": 0, "b": 0, "c": 1, "d": 0}


def test_night_is_hours_0_to_5_inclusive(spark):
    rows = [row(str(h), ts=f"2024-01-05 {h:02d}:30:00") for h in (0, 5, 6, 23)]
    g = to_gold(silver_of(spark, rows))
    assert by_key(g, "night_transaction_flag") == {"0": 1, "5": 1, "6": 0, "23": 0}


def test_weekend_is_saturday_and_sunday(spark):
    days = {"fri": "2024-01-05", "sat": "2024-01-06", "sun": "2024-01-07", "mon": "2024-01-08"}
    s = silver_of(spark, [row(k, ts=f"{d} 12:00:00") for k, d in days.items()])
    assert by_key(s, "is_weekend") == {"fri": 0, "sat": 1, "sun": 1, "mon": 0}


def test_bad_timestamp_is_null_not_an_error(spark):
    s = silver_of(spark, [row("x", ts="nope"), row("y", ts=None)])
    r = {x["trans_num"]: x for x in s.collect()}
    assert r["x"]["trans_date_trans_time"] is None and r["x"]["transaction_hour"] is None
    assert r["x"]["is_weekend"] == 0  # NULL reads as weekday, as the original job did
    q = silver_quality(spark.createDataFrame([row("x", ts="nope"), row("y", ts=None)], SCHEMA)).first()
    assert q["bad_timestamps"] == 1


def test_age_uses_as_of_and_365_day_years(spark):
    as_of = dt.date(2024, 2, 1)
    rows = [
        row("on", dob=as_of - dt.timedelta(days=365 * 30)),
        row("before", dob=as_of - dt.timedelta(days=365 * 30 - 1)),
        row("after", dob=as_of - dt.timedelta(days=365 * 30 + 1)),
    ]
    g = to_gold(silver_of(spark, rows), as_of=as_of)
    assert by_key(g, "customer_age") == {"on": 30, "before": 29, "after": 30}
    assert dict(g.dtypes)["customer_age"] == "bigint"


def test_distance_is_degrees_and_null_propagates(spark):
    rows = [("k", "2024-01-05 10:00:00", 1.0, 30.0, -90.0, 33.0, -86.0, dt.date(1990, 1, 1), T0), row("n", lat=None)]
    g = to_gold(spark.createDataFrame(rows, SCHEMA).transform(to_silver))
    d = by_key(g, "customer_merchant_distance")
    assert d["k"] == pytest.approx(5.0) and d["n"] is None


def test_null_keys_quarantined_and_duplicates_keep_latest(spark):
    rows = [
        row(None),
        row("d", amt=1.0, ing=T0),
        row("d", amt=2.0, ing=T0 + dt.timedelta(hours=1)),
        row("e", amt=3.0, ing=T0),
        row("e", amt=3.0, ing=T0),  # identical copy
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    ok, bad = split_null_keys(df)
    assert bad.count() == 1 and ok.count() == 4
    s = to_silver(df)
    assert s.count() == 2
    assert by_key(s, "amt") == {"d": 2.0, "e": 3.0}


def test_dedupe_tie_is_deterministic(spark):
    rows = [row("t", amt=float(a), ing=T0) for a in (5, 1, 3)]
    a = dedupe_latest(spark.createDataFrame(rows, SCHEMA)).first()["amt"]
    b = dedupe_latest(spark.createDataFrame(list(reversed(rows)), SCHEMA).repartition(3)).first()["amt"]
    assert a == b


def test_hot_key_collapses_before_shuffle(spark):
    """A key repeated many times is combined map-side (partial aggregate)."""
    df = spark.range(0, 20000).select(
        F.lit("hot").alias("trans_num"),
        F.lit("2024-01-05 10:00:00").alias("trans_date_trans_time"),
        F.col("id").cast("double").alias("amt"),
        F.lit(30.0).alias("lat"),
        F.lit(-90.0).alias("long"),
        F.lit(30.0).alias("merch_lat"),
        F.lit(-90.0).alias("merch_long"),
        F.lit(dt.date(1990, 1, 1)).alias("dob"),
        (F.lit(T0).cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("int"))).alias(
            "ingestion_timestamp"
        ),
    )
    out = dedupe_latest(df)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan
    assert out.first()["amt"] == 19999.0


def test_empty_input(spark):
    e = spark.createDataFrame([], SCHEMA)
    assert to_gold(to_silver(e)).count() == 0


def test_layer_contracts(spark):
    """Fixture Bronze fits the source record; Silver and Gold add exactly the
    documented columns with the documented types."""
    from txnlake.schemas import BRONZE, GOLD_DERIVED, SILVER_DERIVED
    from txnlake.plans.fixtures import fixture_layers

    L = fixture_layers(spark, "/root/testdata/sf0.001")
    assert set(L["bronze"].columns) <= set(BRONZE.fieldNames())
    s, g = L["silver"].schema, L["gold"].schema
    for f in SILVER_DERIVED.fields:
        assert s[f.name].dataType == f.dataType
    for f in GOLD_DERIVED.fields:
        assert g[f.name].dataType == f.dataType
    assert s["trans_date_trans_time"].dataType.typeName() == "timestamp_ntz"
    assert s["amt"].dataType.typeName() == "double"


def test_jobs_reject_a_layer_missing_columns(spark, scratch):
    from txnlake.plans import jobs

    spark.createDataFrame([("a",)], "trans_num string").write.parquet(f"{scratch}/bronze")
    with pytest.raises(ValueError, match="missing columns"):
        jobs.bronze_to_silver(spark, f"{scratch}/bronze", f"{scratch}/silver")


def test_timestamp_typed_source_is_not_reparsed(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 6, 3, 15), 1.0, dt.datetime(2024, 1, 6))],
        "trans_num string, trans_date_trans_time timestamp_ntz, amt double, ingestion_timestamp timestamp_ntz",
    )
    r = to_silver(df).first()
    assert (r["transaction_hour"], r["is_weekend"], r["transaction_day"]) == (3, 1, 6)
    assert "to_timestamp" not in to_silver(df)._jdf.queryExecution().optimizedPlan().toString()


def test_haversine_is_offered_beside_the_degree_distance(spark):
    rows = [("k", "2024-01-05 10:00:00", 1.0, 30.0, -90.0, 31.0, -90.0, dt.date(1990, 1, 1), T0)]
    g = to_gold(to_silver(spark.createDataFrame(rows, SCHEMA)), with_haversine=True).first()
    assert g["customer_merchant_distance"] == pytest.approx(1.0)  # degrees, unchanged
    assert g["customer_merchant_km"] == pytest.approx(111.2, abs=0.1)  # one degree of latitude
