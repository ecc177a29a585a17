"""Sources and sinks: missing tables, raw CSV preparation, exports, JDBC.

JDBC runs against Derby's in-memory embedded driver (shipped with Spark):
no server process and no port.
"""

import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from txnlake.functions.columns import drop_if_present, normalize_columns
from txnlake.plans import jobs
from txnlake.schemas import PREDICTIONS
from txnlake.sinks import layers as SINK
from txnlake.sources.layers import read_jdbc, read_jdbc_parallel, read_or_empty, read_raw_csv

DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def test_missing_table_is_empty_but_other_errors_raise(spark, scratch):
    df = read_or_empty(spark, f"{scratch}/nothing", PREDICTIONS)
    assert df.count() == 0 and df.schema == PREDICTIONS
    os.makedirs(f"{scratch}/notparquet")
    with open(f"{scratch}/notparquet/x.parquet", "w") as f:
        f.write("garbage")
    with pytest.raises(Exception):
        read_or_empty(spark, f"{scratch}/notparquet", PREDICTIONS).count()


def test_prepare_raw_csv(spark, scratch):
    src = f"{scratch}/raw.csv"
    with open(src, "w") as f:
        f.write("Unnamed: 0,Trans Num, AMT ,First\n0,t1,1.5,Ann\n1,t2,2.5,Bob\n")
    out = jobs.prepare_raw(spark, src, f"{scratch}/clean", rename={"first": "first_name"})
    assert out.columns == ["trans_num", "amt", "first_name"]
    back = spark.read.option("header", True).csv(f"{scratch}/clean")
    assert sorted(r["trans_num"] for r in back.collect()) == ["t1", "t2"]


def test_normalize_collision_fails(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError):
        normalize_columns(df)
    assert drop_if_present(df, "nope").columns == df.columns


def test_csv_keeps_malformed_lines(spark, scratch):
    src = f"{scratch}/bad.csv"
    with open(src, "w") as f:
        f.write("trans_num,amt\nt1,1.5\nt2,notanumber\n")
    df = read_raw_csv(spark, src, schema=spark.createDataFrame([], "trans_num string, amt double").schema)
    rows = {r["trans_num"]: r for r in df.collect()}
    assert rows["t1"]["_corrupt_record"] is None
    assert rows["t2"]["amt"] is None and rows["t2"]["_corrupt_record"] is not None


def test_backup_csv_and_parquet(spark, scratch):
    df = spark.createDataFrame([("a", 0.5)], "trans_num string, fraud_probability double")
    jobs.backup(df, f"{scratch}/bk")
    assert spark.read.parquet(f"{scratch}/bk/parquet").count() == 1
    assert spark.read.option("header", True).csv(f"{scratch}/bk/csv").first()["trans_num"] == "a"


def test_jdbc_full_load_append_and_partitioned_read(spark):
    url = "jdbc:derby:memory:txnlake_test;create=true"
    props = {"driver": DERBY}
    df = spark.range(0, 100).select(
        F.col("id").alias("row_id"),
        F.col("id").cast("string").alias("trans_num"),
        (F.col("id") / 10).alias("amt"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("inference_timestamp"),
        F.struct(F.lit(1).alias("x")).alias("_ingestion_meta"),
    )
    SINK.full_load(df, url, "FULLLOAD", props, max_connections=2)
    SINK.write_jdbc(SINK.jdbc_storable(df).limit(10), url, "FULLLOAD", mode="append", properties=props)
    back = read_jdbc(spark, url, "FULLLOAD", props, partition_column="row_id", lower=0, upper=100, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 110
    keys = read_jdbc(spark, url, "FULLLOAD", props, columns=["trans_num"])
    assert keys.columns == ["trans_num"] and keys.count() == 110
    par = read_jdbc_parallel(spark, url, "FULLLOAD", "row_id", 3, props)
    assert par.rdd.getNumPartitions() == 3 and par.count() == 110


def test_reset_tables_only_named(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW keepme AS SELECT 1 AS x")
    spark.range(3).write.mode("overwrite").saveAsTable("txnlake_drop_me")
    SINK.reset_tables(spark, ["txnlake_drop_me"])
    assert not spark.catalog.tableExists("txnlake_drop_me")
    assert spark.table("keepme").count() == 1
    with pytest.raises(ValueError):
        SINK.reset_tables(spark, ["x; DROP TABLE keepme"])


def test_layer_read_and_overwrite_guard(spark, scratch):
    with pytest.raises(ValueError):
        jobs.bronze_to_silver(spark, f"{scratch}/same", f"{scratch}/same/")
    with pytest.raises(AnalysisException):
        spark.read.parquet(f"{scratch}/absent").count()


def test_jdbc_persist_is_idempotent_and_historical_load(spark, scratch):
    from txnlake.operators.gold import to_gold
    from txnlake.operators.silver import to_silver
    from txnlake.plans.fixtures import bronze_from_events, load_table, predictions_from_gold

    url = "jdbc:derby:memory:txnlake_persist;create=true"
    props = {"driver": DERBY}
    gold = to_gold(to_silver(bronze_from_events(load_table(spark, "/root/testdata/sf0.001", "events"))), as_of="2024-02-01")
    SINK.write_batch(predictions_from_gold(gold).limit(300), f"{scratch}/b", "r1")
    assert jobs.persist_predictions_jdbc(spark, f"{scratch}/b", "r1", url, "PREDS", props) == 300
    assert jobs.persist_predictions_jdbc(spark, f"{scratch}/b", "r1", url, "PREDS", props) == 0
    back = read_jdbc(spark, url, "PREDS", props)
    assert back.count() == 300 and back.select("trans_num").distinct().count() == 300
    gold.write.partitionBy("transaction_year", "transaction_month").parquet(f"{scratch}/gold")
    jobs.historical_load(spark, f"{scratch}/gold", url, "GOLDFULL", props)
    assert read_jdbc(spark, url, "GOLDFULL", props).count() == 1000


def test_empty_batch_persists_nothing(spark, scratch):
    SINK.write_batch(spark.createDataFrame([], PREDICTIONS), f"{scratch}/b", "e")
    assert jobs.persist_predictions(spark, f"{scratch}/b", "e", f"{scratch}/p") == 0


def test_prepare_raw_keeps_text_as_text(spark, scratch):
    import os

    from txnlake.plans import jobs

    os.makedirs(f"{scratch}/raw")
    with open(f"{scratch}/raw/a.csv", "w") as f:
        f.write("Unnamed: 0,trans_date_trans_time,Zip\n0,2019-01-01 00:00:18,01234\n")
    jobs.prepare_raw(spark, f"{scratch}/raw", f"{scratch}/out")
    row = spark.read.option("header", True).csv(f"{scratch}/out").first()
    assert (row["trans_date_trans_time"], row["zip"]) == ("2019-01-01 00:00:18", "01234")


def test_only_a_table_the_database_lists_is_read(spark, scratch):
    import pytest

    from txnlake.sources.layers import jdbc_table_exists

    url = f"jdbc:derby:{scratch}/db;create=true"
    assert not jdbc_table_exists(spark, url, "predictions")
    spark.range(1).write.jdbc(url, "predictions")
    assert jdbc_table_exists(spark, url, "predictions")
    with pytest.raises(Exception):
        jdbc_table_exists(spark, f"jdbc:derby:{scratch}/missing", "predictions")
