"""Monitoring panels and alerts on hand-written rows."""

import datetime as dt

import pytest

from txnlake.operators import alerts as AL
from txnlake.operators import monitoring as MON

SCHEMA = (
    "trans_num string, amt double, lat double, long double, transaction_hour int, customer_age long, "
    "high_amount_flag int, night_transaction_flag int, customer_merchant_distance double, "
    "fraud_prediction int, fraud_probability double, inference_timestamp timestamp_ntz"
)
NOW = dt.datetime(2024, 1, 31)


def pred(key, p, pred=1, amt=100.0, lat=30.0, hour=3, ts=NOW, dist=1.0):
    return (key, amt, lat, -90.0, hour, 40, int(amt > 500), int(hour <= 5), dist, pred, p, ts)


@pytest.fixture()
def preds(spark):
    rows = [
        pred("a", 0.0, pred=0),
        pred("b", 0.5),
        pred("c", 0.8999),
        pred("d", 0.90),
        pred("e", 1.0, amt=6000.0),
        pred("f", 0.7, lat=None),
        pred("g", 0.6, amt=5000.0),
        pred("h", 0.95, ts=NOW - dt.timedelta(days=2)),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def keys(df):
    return sorted(r["trans_num"] for r in df.collect())


def test_map_cut_offs_are_strict(preds):
    assert keys(MON.map_filter(preds)) == ["b", "c", "f"]
    assert keys(MON.map_points(preds)) == ["b", "c"]


def test_filter_choice(preds):
    assert keys(MON.by_prediction(preds, "Non Fraud Only")) == ["a"]
    assert len(keys(MON.by_prediction(preds, "Fraud Only"))) == 7
    with pytest.raises(ValueError):
        MON.by_prediction(preds, "Some")


def test_kpis_and_format(preds):
    k = MON.kpis(preds).first()
    assert k["total_transactions"] == 8 and k["fraud_transactions"] == 7
    assert k["fraud_rate"] == pytest.approx(87.5)
    assert k["fraud_amount"] == pytest.approx(100 * 4 + 6000 + 5000 + 100)
    f = MON.format_kpis(MON.kpis(preds)).first()
    assert f["fraud_amount"] == "$11,500.00" and f["fraud_rate"] == "87.50%" and f["transactions"] == "8"


def test_kpis_on_empty(spark):
    k = MON.kpis(spark.createDataFrame([], SCHEMA)).first()
    assert (k["total_transactions"], k["fraud_transactions"], k["fraud_rate"], k["fraud_amount"]) == (0, 0, None, 0.0)


def test_histogram_top_edge_in_last_bin(preds):
    h = {r["bin"]: r["count"] for r in MON.histogram(preds, "fraud_probability", 40, 0.0, 1.0).collect()}
    assert h[39] == 1 + 0  # 1.0 falls into the last bin with 0.975..1.0
    assert h[0] == 1 and sum(h.values()) == 8


def test_seeded_sample_exact_size_and_stable(spark):
    df = spark.range(0, 5000).selectExpr("cast(id as string) as trans_num")
    a = keys(MON.seeded_sample(df, 300))
    b = keys(MON.seeded_sample(df.repartition(9), 300))
    assert len(a) == 300 and a == b


def test_alerts_window_order_and_message(preds):
    a = AL.alerts(preds, NOW)
    got = [r["trans_num"] for r in a.collect()]
    assert "h" not in got and len(got) == 6
    m = AL.alert_message(a).first()
    assert m["n_alerts"] == 6 and m["status"] == "6 fraud alerts sent."
    assert m["message"].startswith("\U0001f6a8 Fraud Transactions Detected\n\nTransaction: b\nAmount: $100.0\n")
    assert "Probability: 0.8999\n" in m["message"]


def test_alerts_threshold_and_already_sent(spark, preds):
    sent = spark.createDataFrame([("e",)], "trans_num string")
    got = keys(AL.alerts(preds, NOW, threshold=0.9, already_alerted=sent))
    assert got == ["d"]


def test_no_alerts(spark):
    m = AL.alert_batch(spark.createDataFrame([], SCHEMA), NOW).first()
    assert m["n_alerts"] == 0 and m["status"] == "No frauds detected." and m["message"] is None


@pytest.mark.parametrize("which", ["All", "Fraud Only", "Non Fraud Only"])
def test_one_pass_panels_equal_per_panel(spark, which):
    from txnlake.plans.fixtures import fixture_layers

    p = fixture_layers(spark, "/root/testdata/sf0.001")["predictions"]
    a = MON.monitoring(p, which, one_pass=True)
    b = MON.monitoring(p, which, one_pass=False)
    assert set(a) == set(b)
    for name in a:
        ra = sorted(map(tuple, a[name].collect()), key=repr)
        rb = sorted(map(tuple, b[name].select(*a[name].columns).collect()), key=repr)
        assert ra == rb, name
        assert a[name].dtypes == b[name].select(*a[name].columns).dtypes, name


def test_one_pass_plan_scans_once(spark):
    from txnlake.plans.fixtures import fixture_layers

    p = fixture_layers(spark, "/root/testdata/sf0.001")["predictions"]
    plan = MON.panel_aggregates(p)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1


def test_empty_table_panels(spark):
    m = MON.monitoring(spark.createDataFrame([], SCHEMA))
    assert m["kpis"].first()["total_transactions"] == 0
    assert m["status"].first()["rows_processed"] == 0


def test_approximate_uniqueness_has_no_key_shuffle(spark):
    from txnlake.operators.validation import uniqueness

    df = spark.range(0, 50000).selectExpr("cast(id % 40000 as string) as trans_num")
    exact = uniqueness(df).first()
    approx = uniqueness(df, approx=True)
    assert exact["unique_rows"] == 40000 and not exact["is_unique"]
    assert abs(approx.first()["unique_rows"] - 40000) <= 40000 * 0.03
    p = approx._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(trans_num" not in p
