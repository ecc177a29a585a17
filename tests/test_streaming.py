"""Streaming twins: same results as the batch jobs, replay-safe."""

import pytest
from pyspark.sql import functions as F

from txnlake.operators.gold import to_gold
from txnlake.operators.silver import to_silver
from txnlake.plans.fixtures import AS_OF, bronze_from_events, load_table
from txnlake.streaming import layers as S

SF = "/root/testdata/sf0.001"
CUT = "2024-01-15 00:00:00"


@pytest.fixture(scope="module")
def bronze(spark):
    return bronze_from_events(load_table(spark, SF, "events"))


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_stream_builds_silver_and_gold_like_batch(spark, bronze, scratch):
    ts = F.col("ingestion_timestamp")
    bronze.filter(ts < F.lit(CUT).cast("timestamp_ntz")).write.parquet(f"{scratch}/bronze")
    schema = spark.read.parquet(f"{scratch}/bronze").schema
    for _ in range(2):
        q = S.start_silver_gold(
            S.bronze_stream(spark, f"{scratch}/bronze", schema),
            f"{scratch}/silver",
            f"{scratch}/gold",
            f"{scratch}/ckpt",
            as_of=AS_OF,
        )
        q.awaitTermination(300)
        assert q.exception() is None
        # second round: more files land, the query resumes from its checkpoint
        bronze.filter(ts >= F.lit(CUT).cast("timestamp_ntz")).write.mode("append").parquet(f"{scratch}/bronze")
    silver = spark.read.parquet(f"{scratch}/silver")
    assert silver.count() == 1000
    assert _same(silver, to_silver(bronze))
    gold = spark.read.parquet(f"{scratch}/gold")
    assert _same(gold, to_gold(to_silver(bronze), as_of=AS_OF))


def test_stream_dedupe_and_idempotent_append(spark, bronze, scratch):
    bronze.write.parquet(f"{scratch}/bronze")
    schema = spark.read.parquet(f"{scratch}/bronze").schema
    for _ in range(2):
        q = S.start_idempotent_append(
            S.dedupe_stream(S.bronze_stream(spark, f"{scratch}/bronze", schema, max_files_per_trigger=2)),
            f"{scratch}/target",
            f"{scratch}/ckpt",
        )
        q.awaitTermination(300)
        assert q.exception() is None
    t = spark.read.parquet(f"{scratch}/target")
    assert t.count() == t.select("trans_num").distinct().count() == 1000


def test_stream_trend_matches_batch_for_closed_windows(spark, bronze, scratch):
    import datetime as dt
    import time

    from txnlake.operators.gold import to_gold
    from txnlake.operators.trends import fraud_trend, fraud_trend_stream

    gold = to_gold(to_silver(bronze), as_of=AS_OF).select("trans_num", "trans_date_trans_time", "is_fraud")
    ts = F.col("trans_date_trans_time")
    # Files land in time order, five days per file, as a feed would deliver them.
    for d in range(1, 32, 5):
        lo, hi = dt.datetime(2024, 1, d), dt.datetime(2024, 1, d) + dt.timedelta(days=5)
        gold.filter((ts >= F.lit(lo)) & (ts < F.lit(hi))).coalesce(1).write.mode("append").parquet(f"{scratch}/g")
        time.sleep(1.1)  # distinct modification times: the file source takes oldest first
    schema = spark.read.parquet(f"{scratch}/g").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/g")
    q = (
        fraud_trend_stream(stream)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{scratch}/trend")
        .option("checkpointLocation", f"{scratch}/ckpt")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(f"{scratch}/trend").withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    batch = fraud_trend(gold)
    # Windows are emitted once the watermark (max event time - 2 h) passes
    # them; the last few stay open.  Every emitted window is complete.
    emitted = got.count()
    assert emitted > 400
    j = got.alias("s").join(batch.alias("b"), "window_start")
    assert j.count() == emitted
    assert j.filter("s.transactions != b.transactions OR s.frauds != b.frauds").count() == 0


def test_stream_scoring_scores_every_scorable_row_once(spark, bronze, scratch):
    from txnlake.operators import ml as ML
    from txnlake.schemas import FEATURES, LABEL

    gold = to_gold(to_silver(bronze), as_of=AS_OF)
    gold.repartition(4).write.parquet(f"{scratch}/gold")
    g = spark.read.parquet(f"{scratch}/gold")
    model = ML.train(ML.clean_training(g.select(*FEATURES, LABEL)), num_trees=5, max_depth=3)
    for _ in range(2):  # second start: nothing new, nothing appended twice
        q = S.start_scoring(
            spark.readStream.schema(g.schema).option("maxFilesPerTrigger", 1).parquet(f"{scratch}/gold"),
            model,
            f"{scratch}/pred",
            f"{scratch}/ckpt",
        )
        q.awaitTermination(300)
        assert q.exception() is None
    p = spark.read.parquet(f"{scratch}/pred")
    scorable = ML.split_scorable(g)[0].count()
    assert p.count() == p.select("trans_num").distinct().count() == scorable
    assert p.select("batch_id").distinct().count() == 4


def _latest_run(spark, root, schema):
    stream = S.bronze_stream(spark, f"{root}/bronze", schema, arrival=True)
    q = S.start_latest_merge(S.latest_stream(stream), f"{root}/silver", f"{root}/ckpt", gold_path=f"{root}/gold", as_of=AS_OF)
    q.awaitTermination(300)
    assert q.exception() is None
    return q


def test_stream_keeps_the_latest_copy_whatever_the_order_of_arrival(spark, bronze, scratch):
    """Copies arrive oldest last, newest last, and long after: each time Silver and Gold equal the batch rule."""
    import datetime as dt

    part = F.col("trans_num").cast("long") % 3
    newer = bronze.filter(part == 1).withColumn("amt", F.col("amt") + 1).withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + dt.timedelta(days=40))
    older = bronze.filter(part == 2).withColumn("amt", F.col("amt") + 2).withColumn("ingestion_timestamp", F.col("ingestion_timestamp") - dt.timedelta(days=400))
    moved = bronze.filter(part == 0).withColumn("trans_date_trans_time", F.lit("2023-03-04 05:06:07")).withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + dt.timedelta(days=90))
    nothing = bronze.limit(5).withColumn("trans_num", F.lit(None).cast("string"))
    so_far = None
    for drop in (newer.unionByName(nothing), bronze, older.unionByName(moved)):
        drop.write.mode("append").parquet(f"{scratch}/bronze")
        _latest_run(spark, scratch, bronze.schema)
        so_far = drop if so_far is None else so_far.unionByName(drop)
        silver = to_silver(so_far)
        assert _same(spark.read.parquet(f"{scratch}/silver"), silver)
        assert _same(spark.read.parquet(f"{scratch}/gold"), to_gold(silver, as_of=AS_OF))


def test_replayed_micro_batches_change_nothing(spark, bronze, scratch):
    """A query that died before it committed its last micro-batch runs it again."""
    import os

    ts = F.col("ingestion_timestamp")
    for early in (True, False):
        rows = bronze.filter((ts < F.lit(CUT).cast("timestamp_ntz")) == F.lit(early))
        rows.write.mode("append").parquet(f"{scratch}/bronze")
        _latest_run(spark, scratch, bronze.schema)
    assert _same(spark.read.parquet(f"{scratch}/silver"), to_silver(bronze))
    commits = sorted(int(x) for x in os.listdir(f"{scratch}/ckpt/commits") if x.isdigit())
    for last in commits[-2:]:  # as if the driver had died before these commits
        os.rename(f"{scratch}/ckpt/commits/{last}", f"{scratch}/lost-{last}")
        if os.path.exists(f"{scratch}/ckpt/commits/.{last}.crc"):
            os.rename(f"{scratch}/ckpt/commits/.{last}.crc", f"{scratch}/lost-{last}.crc")
    _latest_run(spark, scratch, bronze.schema)
    assert _same(spark.read.parquet(f"{scratch}/silver"), to_silver(bronze))


def test_latest_state_is_evicted(spark, bronze, scratch):
    """Arrival windows behind the watermark leave the state."""
    import datetime as dt

    at = bronze.withColumn("_arrived", F.lit(dt.datetime(2024, 1, 1, 12)))
    at.write.mode("append").parquet(f"{scratch}/in")
    for day in (2, 3):
        bronze.limit(3).withColumn("_arrived", F.lit(dt.datetime(2024, 1, day, 12))).write.mode("append").parquet(f"{scratch}/in{day}")
    held = []
    for folder in ("in", "in2", "in3"):
        if folder != "in":
            spark.read.parquet(f"{scratch}/{folder}").write.mode("append").parquet(f"{scratch}/in")
        stream = spark.readStream.schema(at.schema).parquet(f"{scratch}/in")
        w = S.latest_stream(stream).writeStream.outputMode("update").foreachBatch(lambda b, i: b.write.format('noop').mode('overwrite').save())
        q = w.option("checkpointLocation", f"{scratch}/ckpt").trigger(availableNow=True).start()
        q.awaitTermination(300)
        held.append([p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]])
    assert held[0][0] == 1000 and held[-1][-1] <= 3
