"""Bootstrap comparison, sketches, quantile drift and anomalies against the past: brute force and bounds."""

import datetime as dt
import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from txnlake.operators import bootstrap as BS
from txnlake.operators import sketches as SK
from txnlake.operators.anomaly import past_anomalies
from txnlake.plans.fixtures import fixture_layers
from txnlake.schemas import KEY, PREDICTIONS_TABLE

SF = "/root/testdata/sf0.001"


# --- bootstrap ---------------------------------------------------------------------------
def test_weights_are_poisson_and_reproducible(spark):
    rows = spark.range(0, 40_000).select(F.col("id").cast("string").alias("k"))
    got = rows.select("k", BS.weight(F.col("k"), F.lit(7)).alias("w")).collect()
    cuts = BS.poisson_cuts()
    for r in got[:500]:
        h = int(hashlib.md5(f"7#{r['k']}".encode()).hexdigest()[:6], 16)
        assert r["w"] == sum(h >= c for c in cuts)
    w = [r["w"] for r in got]
    assert abs(statistics.mean(w) - 1) < 0.02 and abs(statistics.pvariance(w) - 1) < 0.04
    assert abs(w.count(0) / len(w) - math.exp(-1)) < 0.01
    other = [r["w"] for r in rows.select(BS.weight(F.col("k"), F.lit(8)).alias("w")).collect()]
    assert abs(statistics.correlation(w, other)) < 0.02


def rows_of(n, better, seed):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        y = int(rng.random() < 0.3)
        a = y if rng.random() < 0.8 else 1 - y
        b = y if rng.random() < 0.8 + better else 1 - y
        out.append((str(i), y, a, b))
    return out


def compared(spark, rows, **args):
    df = spark.createDataFrame(rows, "trans_num string, is_fraud int, a int, b int")
    return {r["metric"]: r for r in BS.compare_predictions(df, "a", "b", **args).collect()}


def test_metrics_and_intervals_equal_brute_force(spark):
    rows = rows_of(400, 0.05, 1) + [(None, 1, 1, 1), ("x", None, 1, 0), ("y", 1, None, 0)]
    b, cuts = 40, BS.poisson_cuts()

    def metrics(weighed, side):
        tp, fp, fn, tn = (sum(w for r, w in weighed if r[side] == s and r[1] == y) for s, y in ((1, 1), (1, 0), (0, 1), (0, 0)))
        p, q = tp / (tp + fp) if tp + fp else 0, tp / (tp + fn) if tp + fn else 0
        return {"accuracy": (tp + tn) / (tp + fp + fn + tn), "precision": p, "recall": q, "f1_score": 2 * p * q / (p + q) if p + q else 0}

    valid = rows[:400]
    real = [metrics([(r, 1) for r in valid], s) for s in (2, 3)]
    drawn = []
    for j in range(1, b + 1):
        weighed = [(r, sum(int(hashlib.md5(f"{j}#{r[0]}".encode()).hexdigest()[:6], 16) >= c for c in cuts)) for r in valid]
        drawn.append([metrics(weighed, s) for s in (2, 3)])
    got = compared(spark, rows, b=b)
    assert set(got) == set(BS.METRICS)
    for m, r in got.items():
        assert (r["current"], r["candidate"]) == (round(real[0][m], 6), round(real[1][m], 6))
        d = sorted(y[m] - x[m] for x, y in drawn)
        # the first and last of the 95 % between 2.5 and 97.5 per cent of forty: places 1 and 40
        assert (r["low"], r["high"]) == (pytest.approx(d[0], abs=2e-6), pytest.approx(d[39], abs=2e-6))


def test_a_better_model_is_seen_and_an_equal_one_is_not(spark):
    better = compared(spark, rows_of(3000, 0.1, 2))
    assert all(r["significant"] and r["low"] > 0 for r in better.values())
    same = compared(spark, rows_of(3000, 0.0, 3))
    assert not same["accuracy"]["significant"] and same["accuracy"]["low"] < 0 < same["accuracy"]["high"]
    twin = compared(spark, [(k, y, a, a) for k, y, a, _ in rows_of(300, 0, 4)])
    assert all((r["low"], r["high"], r["significant"]) == (0, 0, False) for r in twin.values())
    assert compared(spark, []) == {}


def test_intervals_cover_the_truth(spark):
    """Of samples from models whose accuracies differ by 0.05, most intervals hold that difference."""
    held = 0
    for seed in range(6):
        r = compared(spark, rows_of(800, 0.05, 100 + seed))["accuracy"]
        held += r["low"] <= 0.05 <= r["high"]
    assert held >= 4


def test_a_row_is_hashed_once_a_resample(spark):
    """the plan reads a weight off one computed hash, and neither other labels nor resamples without a row get in the way."""
    df = spark.createDataFrame([("1", 1, 1, 0), ("2", 0, 1, 0), ("3", 2, 1, 1)], "trans_num string, is_fraud int, a int, b int")
    plan = BS.replicate_metrics(df, "a", "b")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1
    got = {r["replicate"]: r for r in BS.replicate_metrics(df, "a", "b").collect()}
    assert got[0]["a_accuracy"] == 0.5 and got[0]["b_accuracy"] == 0.5 and got[0]["b_precision"] == 0

    def w(j, k):
        return sum(int(hashlib.md5(f"{j}#{k}".encode()).hexdigest()[:6], 16) >= c for c in BS.poisson_cuts())

    drawn = {j for j in range(1, 101) if any(w(j, k) for k in "123")}
    assert set(got) == drawn | {0} and len(drawn) < 100


# --- theta sketches ------------------------------------------------------------------------
def test_estimates_lie_within_their_bounds(spark):
    def keys(lo, hi, by=7):
        return spark.range(lo, hi).select(F.col("id").cast("string").alias(KEY), (F.col("id") % by).cast("string").alias("batch_id"))

    for have, lack in (((0, 60_000), (0, 45_000)), ((0, 60_000), (0, 60_000)), ((0, 60_000), (59_900, 90_000)), ((0, 3000), (1000, 2000)), ((0, 100), (0, 0)), ((0, 0), (0, 50))):
        a, b = (SK.key_sketches(keys(*x).union(keys(*x).limit(10)), ["batch_id"]) for x in (have, lack))
        d = SK.distinct_keys(a).first()
        assert abs(d["estimate"] - (have[1] - have[0])) <= d["bound"], have
        truth = len(set(range(*have)) - set(range(*lack)))
        m = SK.missing_keys(a, b).first()
        assert abs(m["estimate"] - truth) <= m["bound"], (have, lack, m, truth)
        if have[1] < 4096 and lack[1] < 4096:
            assert m["bound"] == d["bound"] == 0


def test_sketches_follow_the_batches(spark, scratch):
    p = fixture_layers(spark, SF)["predictions"]
    k = F.col(KEY).cast("long")
    state = SK.KeySketches(spark, f"{scratch}/s", f"{scratch}/p")
    assert state.refresh() == {"batches": 0} and SK.distinct_keys(state.sketches()).first()["estimate"] == 0
    for i in range(3):
        p.filter(k % 4 == i).write.parquet(f"{scratch}/p/batch_id=b{i}")
    assert state.refresh() == {"batches": 3}
    assert SK.distinct_keys(state.sketches()).first()["estimate"] == 750
    p.filter(k % 4 == 3).write.mode("overwrite").parquet(f"{scratch}/p/batch_id=b1")
    p.filter(k < 500).write.parquet(f"{scratch}/p/batch_id=late")
    assert state.refresh() == {"batches": 2}
    gold = SK.key_sketches(p.withColumn("batch_id", F.lit("all")), ["batch_id"])
    truth = p.filter((k % 4 == 1) & (k >= 500)).count()
    assert SK.missing_keys(gold, state.sketches()).first()["estimate"] == truth
    plan = SK.missing_keys(gold, state.sketches())._jdf.queryExecution().executedPlan().toString()
    assert "left_anti" not in plan.lower() and "trans_num" not in plan.split("Scan parquet")[-1]


# --- quantile drift --------------------------------------------------------------------------
def exact_ks(a, b):
    a, b = sorted(a), sorted(b)
    import bisect

    return max(abs(bisect.bisect_right(a, v) / len(a) - bisect.bisect_right(b, v) / len(b)) for v in {*a, *b})


def drift(spark, base, cur):
    one, two = (spark.createDataFrame([(float(x) if x is not None else None,) for x in v], "x double") for v in (base, cur))
    rows = SK.quantile_drift(SK.feature_sketches(one, ["x"]), SK.feature_sketches(two, ["x"]), ["x"]).collect()
    return rows[0] if rows else None


def test_ks_distance_is_within_the_error(spark):
    rng = random.Random(0)
    base = [rng.gauss(0, 1) for _ in range(8000)]
    for cur in ([rng.gauss(0, 1) for _ in range(6000)], [rng.gauss(0.3, 1) for _ in range(6000)], [rng.gauss(0, 2) for _ in range(6000)], [float(rng.random() < 0.3) for _ in range(3000)]):
        r = drift(spark, base, cur)
        assert abs(r["ks"] - exact_ks(base, cur)) <= r["ks_error"]
    flags = [0.0] * 900 + [1.0] * 100
    r = drift(spark, flags, [0.0] * 600 + [1.0] * 400)
    assert abs(r["ks"] - 0.3) <= r["ks_error"] and r["status"] == "shifted"
    assert drift(spark, flags, flags)["ks"] == 0


def test_an_outlier_does_not_move_the_result(spark):
    rng = random.Random(1)
    base, shifted = [rng.gauss(0, 1) for _ in range(5000)], [rng.gauss(0.8, 1) for _ in range(5000)]
    clean, dirty = drift(spark, base, shifted), drift(spark, [*base, 1e12, float("nan"), None], [*shifted, -1e15])
    assert clean["status"] == dirty["status"] == "shifted"
    assert abs(clean["ks"] - dirty["ks"]) < 0.02 and abs(clean["psi"] - dirty["psi"]) < 0.1
    # equal-width bins put nearly all rows in one bin and see nothing
    from txnlake.operators.anomaly import drift_report

    frames = [spark.createDataFrame([(x,) for x in v], "x double") for v in ([*base, 1e12], shifted)]
    assert drift_report(*frames, features=["x"]).first()["status"] == "stable"


def test_drift_of_empty_periods(spark):
    assert drift(spark, [1.0], []) is None and drift(spark, [None], [1.0]) is None


# --- anomalies against the past ------------------------------------------------------------------
SCHEMA = "trans_num string, cc_num long, amt double, trans_date_trans_time timestamp_ntz"


def test_only_earlier_transactions_judge(spark):
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    rows = [(f"t{i}", rng.choice([1, 1, 1, 2, 3]), round(rng.uniform(1, 100), 2), start + dt.timedelta(minutes=rng.randint(0, 9) * 40)) for i in range(300)]
    rows += [("late", 1, 5000.0, start + dt.timedelta(days=2)), ("after", 1, 50.0, start + dt.timedelta(days=3))]
    rows += [("n1", None, 1.0, start), ("n2", 1, None, start), ("n3", 1, 1.0, None)]
    got = {r["trans_num"]: r for r in past_anomalies(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert set(got) == {r[0] for r in rows if r[0] not in ("n1", "n2", "n3")}
    for customer in (1, 2, 3):
        own = sorted((r for r in rows if r[1] == customer and r[0] in got), key=lambda r: (r[3], r[0]))
        for i, r in enumerate(own):
            past, g = [x[2] for x in own[:i]], got[r[0]]
            assert g["past"] == i
            if i < 5:
                assert g["z_score"] is None and not g["is_anomaly"]
            else:
                assert g["past_mean"] == pytest.approx(statistics.mean(past), abs=1e-5)
                z = (r[2] - statistics.mean(past)) / statistics.stdev(past)
                assert g["z_score"] == pytest.approx(z, abs=1e-4) and g["is_anomaly"] == (abs(z) > 3)
    assert got["late"]["is_anomaly"]  # the outlier isn't in its own mean


def test_a_hot_customer_is_not_one_group(spark):
    """A customer with half of all rows: no window has more rows than a chunk of time holds."""
    start = dt.datetime(2024, 1, 1)
    rows = spark.range(0, 40_000).select(
        F.col("id").cast("string").alias("trans_num"),
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id") % 1000).cast("long").alias("cc_num"),
        (F.col("id") % 997 / 7).alias("amt"),
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("id").cast("int") % 14_000)).cast("timestamp_ntz").alias("trans_date_trans_time"),
    )
    df = past_anomalies(rows)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    import re

    parts = re.findall(r"Window \[.*?\], \[([^\]]*)\], \[", plan)
    assert len(parts) == 2 and all("_chunk" in p or "ORDER" in p or "cc_num" in p for p in parts)
    hot = rows.filter("cc_num = 7").groupBy(F.date_trunc("hour", "trans_date_trans_time")).count()
    assert hot.agg(F.max("count")).first()[0] < 200
    got = df.filter("cc_num = 7").agg(F.count(F.lit(1)).alias("n"), F.max("past").alias("p"), F.count_distinct("past").alias("d")).first()
    assert got["n"] == got["d"] == got["p"] + 1 == rows.filter("cc_num = 7").count()


# --- balanced reads -----------------------------------------------------------------------------
def test_balanced_ranges_of_a_text_key_and_a_skewed_number(spark, scratch):
    from txnlake.sources.layers import range_predicates, read_jdbc_balanced, split_points

    url = f"jdbc:derby:{scratch}/db;create=true"
    rows = spark.range(0, 4000).select(
        F.md5(F.col("id").cast("string")).alias("trans_num"),
        F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.pow(F.col("id") / 100.0, 6)).alias("skewed"),
        F.when(F.col("id") < 2400, F.lit("same")).otherwise(F.concat(F.lit("k'"), F.col("id").cast("string"))).alias("hot"),
    )
    rows.write.option("createTableColumnTypes", "trans_num VARCHAR(40), hot VARCHAR(40)").jdbc(url, "t")
    for column in ("trans_num", "skewed"):
        df = read_jdbc_balanced(spark, url, "t", column, 8)
        sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert df.rdd.getNumPartitions() == len(sizes) == 8 and sum(sizes) == 4000
        assert max(sizes) <= 2 * min(sizes), (column, sizes)
    assert df.exceptAll(rows).count() == 0
    # equal widths would put almost all rows of the skewed number in one range
    from txnlake.sources.layers import read_jdbc_parallel

    wide = read_jdbc_parallel(spark, url, "t", "skewed", 8)
    assert max(r[1] for r in wide.groupBy(F.spark_partition_id()).count().collect()) > 2000
    # a value of many rows is one range; none is lost
    hot = read_jdbc_balanced(spark, url, "t", "hot", 8, columns=["trans_num"])
    assert hot.columns == ["trans_num"] and hot.count() == hot.distinct().count() == 4000
    assert split_points(spark, url, "t", "hot", 8).count("same") == 1
    spark.createDataFrame([], "a string").write.option("createTableColumnTypes", "a VARCHAR(9)").jdbc(url, "e")
    assert read_jdbc_balanced(spark, url, "e", "a", 4).count() == 0
    assert range_predicates("c", ["a'b", "z"]) == ["(\"c\" < 'a''b' OR \"c\" IS NULL)", "\"c\" >= 'a''b' AND \"c\" < 'z'", "\"c\" >= 'z'"]
