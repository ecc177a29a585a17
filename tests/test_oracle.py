"""Every oracle-checked query equals its DuckDB twin on sf0.001 (exact values)."""

import pytest

import __spark_entry__ as E
from tests.oracle_compare import canon, duck_conn
from txnlake.plans.oracle_queries import ORACLE
from txnlake.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"
NAMES = sorted(ORACLE)


@pytest.fixture(scope="module")
def duck():
    return duck_conn(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = REGISTRY[name](spark, SF)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLE[name])
    d_cols, d_rows = canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows
    spark_types = {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes}
    duck_types = {r[0]: r[1] for r in duck.execute("DESCRIBE " + ORACLE[name]).fetchall()}
    assert spark_types == duck_types


SPARK_TO_DUCK = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def test_every_query_has_oracle_or_is_model_fitting():
    model_fitting = {"assemble", "train", "score", "importance_rank", "inference_batch", "train_model"}
    assert set(REGISTRY) - set(ORACLE) == model_fitting


FACTS = {
    # sf: bronze rows, distinct keys, bad times, null lat, predicted fraud,
    #     (p >= 0.90, amt >= 5000, null lat) among those, confusion 00, 01, 10, 11
    "sf0.001": (1050, 1000, 10, 20, 210, (10, 2, 1), (684, 59, 106, 151)),
    "sf0.01": (10500, 10000, 100, 200, 2168, (79, 21, 13), (6799, 593, 1033, 1575)),
    "sf0.1": (105000, 100000, 1000, 2000, 21081, (815, 171, 141), (68471, 5767, 10448, 15314)),
}


@pytest.mark.parametrize("sf", sorted(FACTS))
def test_fixture_facts(spark, sf):
    """Counts the fixture mapping promises (FIXTURES.md section 8)."""
    from pyspark.sql import functions as F

    from txnlake.plans.fixtures import fixture_layers

    rows, keys, bad, null_lat, fraud, sub, cm = FACTS[sf]
    L = fixture_layers(spark, f"/root/testdata/{sf}")
    b = L["bronze"].agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("trans_num").alias("k"),
        F.count_if(F.col("trans_date_trans_time") == "bad").alias("bad"),
    ).first()
    assert (b["n"], b["k"], b["bad"]) == (rows, keys, bad)
    assert L["silver"].filter(F.col("lat").isNull()).count() == null_lat
    f = L["predictions"].filter("fraud_prediction = 1").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("fraud_probability") >= 0.90).alias("p90"),
        F.count_if(F.col("amt") >= 5000).alias("amt"),
        F.count_if(F.col("lat").isNull()).alias("nl"),
    ).first()
    assert (f["n"], (f["p90"], f["amt"], f["nl"])) == (fraud, sub)
    got = {(r["label"], r["prediction"]): r["count"] for r in REGISTRY["confusion_matrix"](spark, f"/root/testdata/{sf}").collect()}
    assert got == dict(zip([(0, 0), (0, 1), (1, 0), (1, 1)], cm))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert len(df.columns) > 0
