"""Physical-plan properties the design relies on at scale."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txnlake.operators import incremental as INC
from txnlake.operators import monitoring as MON
from txnlake.plans.fixtures import fixture_layers


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    L = fixture_layers(spark, "/root/testdata/sf0.001")
    L["gold"].write.parquet(f"{root}/gold")
    L["predictions"].withColumn("batch_id", F.lit("b1")).write.partitionBy("batch_id").parquet(f"{root}/pred")
    return {"gold": spark.read.parquet(f"{root}/gold"), "pred": spark.read.parquet(f"{root}/pred")}


def test_panel_filters_and_columns_reach_the_scan(tables):
    p = plan(MON.by_hour(tables["pred"]))
    assert "EqualTo(fraud_prediction,1)" in p
    assert "ReadSchema: struct<transaction_hour:int,fraud_prediction:int>" in p


def test_map_reads_only_plotted_columns(tables):
    p = plan(MON.map_points(tables["pred"]))
    read = p[p.index("ReadSchema: struct<") :].split(">")[0]
    assert "city_pop" not in read and "unix_time" not in read and "lat:double" in read


def test_batch_is_a_top_k_not_a_global_sort(tables):
    none = tables["pred"].select("trans_num").limit(0)
    p = plan(INC.next_batch(INC.unscored(tables["gold"], none)))
    assert "TakeOrderedAndProject" in p and "Sort [" not in p


def test_report_aggregates_combine_map_side(tables):
    assert "partial_count" in plan(MON.kpis(tables["pred"]))
    assert "Expand" in plan(MON.panel_aggregates(tables["pred"]))


def test_cursor_mode_prunes_prediction_batches(spark, tables):
    state = spark.createDataFrame(
        [("b1", dt.datetime(2024, 1, 31))], "batch_id string, max_ingestion timestamp_ntz"
    ).filter(F.col("max_ingestion") >= F.lit(dt.datetime(2024, 1, 30)))
    pruned = tables["pred"].join(state.select("batch_id"), "batch_id", "left_semi").select("trans_num")
    pruned.collect()
    assert "dynamicpruning" in plan(pruned).lower()


def test_no_python_in_the_hot_path(tables):
    for df in MON.monitoring(tables["pred"]).values():
        p = plan(df)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
