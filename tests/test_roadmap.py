"""Roadmap analytics: anomaly z-scores, drift, model comparison."""

import pytest
from pyspark.sql import functions as F

from txnlake.operators.anomaly import amount_anomalies, drift_report
from txnlake.schemas import FEATURES, KEY, LABEL


def test_hot_customer_is_aggregated_not_windowed(spark):
    rows = [(str(i), 1, 100.0) for i in range(300)] + [("x", 1, 1000.0), ("y", 2, 5.0), ("z", 2, 7.0), ("w", 3, 1.0)]
    df = spark.createDataFrame(rows, "trans_num string, cc_num long, amt double")
    out = amount_anomalies(df, hot_share=0.5)  # customer 1 holds > half: hot
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "BroadcastHashJoin" in plan
    r = {x[KEY]: x for x in out.collect()}
    assert r["x"]["is_anomaly"] and not r["0"]["is_anomaly"]
    assert r["w"]["z_score"] is None and not r["w"]["is_anomaly"]  # single transaction: no spread
    assert r["y"]["z_score"] == pytest.approx(-0.707107)


def test_drift_zero_for_same_data_and_flags_a_shift(spark):
    base = spark.range(0, 2000).select(*[(F.col("id") % 100).cast("double").alias(f) for f in FEATURES])
    same = drift_report(base, base).collect()
    assert all(r["psi"] == 0.0 and r["status"] == "stable" for r in same)
    shifted = base.withColumn("amt", F.col("amt") + 60)
    r = {x["feature"]: x for x in drift_report(base, shifted).collect()}
    assert r["amt"]["status"] == "shifted" and r["city_pop"]["psi"] == 0.0


def test_compare_models_on_one_holdout(spark, scratch):
    from txnlake.plans import jobs

    df = spark.range(0, 3000).select(
        F.col("id").cast("string").alias(KEY),
        *[(F.col("id") % 37 * (i + 1)).cast("double").alias(c) for i, c in enumerate(FEATURES) if c != "amt"],
        F.when(F.col("id") % 10 == 0, F.lit(4000.0)).otherwise(F.col("id") % 200 * 1.0).alias("amt"),
        F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias(LABEL),
        (F.col("id") >= 1500).alias("newer"),
    )
    df.write.parquet(f"{scratch}/gold")
    res = jobs.compare_models(
        spark, f"{scratch}/gold", F.col("newer") == F.lit(False), F.col("newer"), num_trees=5, max_depth=3
    ).collect()
    assert sorted(r["model"] for r in res) == ["candidate", "current"]
    assert all(0.0 <= r["accuracy"] <= 1.0 for r in res)


def test_hot_key_join_equals_plain_join_and_spreads_hot_rows(spark):
    from txnlake.operators.anomaly import join_per_key_stats

    n = 30000
    rows = spark.range(0, n).select(
        F.col("id").cast("string").alias(KEY),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500).cast("long").alias("cc_num"),
    )
    stats = rows.groupBy("cc_num").agg(F.count(F.lit(1)).alias("n"), F.max(KEY).alias("mx"))
    got = join_per_key_stats(rows, stats, "cc_num", spread_by=KEY)
    want = rows.join(stats, "cc_num", "left").select(*got.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # customer 7 (a third of the rows) never meets in one shuffle partition
    sizes = (
        got.filter(F.col("cc_num") == 7)
        .groupBy(F.spark_partition_id().alias("p"))
        .count()
        .collect()
    )
    assert len(sizes) > 1
