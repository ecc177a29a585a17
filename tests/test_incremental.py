
import datetime as dt

import pytest
from pyspark.sql import functions as F

from txnlake.operators import incremental as INC
from txnlake.operators import ml as ML
from txnlake.plans import jobs
from txnlake.schemas import FEATURES, KEY, LABEL
from txnlake.sinks.layers import write_layer
from txnlake.plans.fixtures import AS_OF, bronze_from_events, load_table
from txnlake.sources.layers import read_layer

SF = "/root/testdata/sf0.001"
RUN = dt.datetime(2024, 2, 1, 12, 0, 0)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Bronze written once; Silver and Gold built by the real jobs; a small
    forest trained and saved (replay properties do not depend on its size)."""
    root = str(tmp_path_factory.mktemp("lake"))
    bronze = bronze_from_events(load_table(spark, SF, "events"))
    bronze.write.parquet(f"{root}/bronze")
    assert jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver") == 1000
    assert jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", as_of=AS_OF) == 1000
    gold = read_layer(spark, f"{root}/gold")
    model = ML.train(ML.clean_training(gold.select(*FEATURES, LABEL)), num_trees=5, max_depth=3)
    ML.save_model(model, f"{root}/model")
    scorable = ML.split_scorable(gold)[0].count()
    return {"root": root, "scorable": scorable}


def _run(spark, lake, preds, batches, k, n, state=None):
    bid = f"run{k:03d}"
    jobs.run_inference(spark, f"{lake['root']}/gold", preds, f"{lake['root']}/model", batches, bid, RUN, n, state_path=state)
    return jobs.persist_predictions(spark, batches, bid, preds)


def test_cursor_mode_selects_the_same_batches_as_full_scans(spark, lake, scratch):
    full, inc = f"{scratch}/full", f"{scratch}/inc"
    for k in range(1, 5):
        _run(spark, lake, f"{full}/p", f"{full}/b", k, 250)
        _run(spark, lake, f"{inc}/p", f"{inc}/b", k, 250, state=f"{inc}/state")
        a = {r[KEY] for r in spark.read.parquet(f"{full}/b/batch_id=run{k:03d}").collect()}
        b = {r[KEY] for r in spark.read.parquet(f"{inc}/b/batch_id=run{k:03d}").collect()}
        assert a == b and len(a) == min(250, lake["scorable"] - 250 * (k - 1))
    st = spark.read.parquet(f"{inc}/state")
    assert st.count() == 4 and st.agg(F.sum("rows")).first()[0] == lake["scorable"]


def test_k_runs_have_no_duplicates(spark, lake, scratch):
    preds, batches, n = f"{scratch}/predictions", f"{scratch}/batches", 300
    for k in range(1, 5):
        _run(spark, lake, preds, batches, k, n)
        p = spark.read.parquet(preds)
        total, distinct = p.count(), p.select(KEY).distinct().count()
        assert total == distinct == min(k * n, lake["scorable"])
    # Everything scored: a further run writes an empty batch and appends nothing.
    before = spark.read.parquet(preds).count()
    assert _run(spark, lake, preds, batches, 99, n) == 0
    assert spark.read.parquet(preds).count() == before
    # Re-running the writer of an old batch alone changes nothing.
    assert jobs.persist_predictions(spark, batches, "run001", preds) == n
    assert spark.read.parquet(preds).count() == before


def test_rerun_of_a_completed_batch_writes_the_same_rows(spark, lake, scratch):
    preds, batches, state = f"{scratch}/predictions", f"{scratch}/batches", f"{scratch}/state"
    _run(spark, lake, preds, batches, 1, 200, state=state)
    _run(spark, lake, preds, batches, 2, 200, state=state)
    before = sorted(r[KEY] for r in spark.read.parquet(preds).collect())
    _run(spark, lake, preds, batches, 2, 200, state=state)  # batch 2 again
    after = sorted(r[KEY] for r in spark.read.parquet(preds).collect())
    assert before == after and len(after) == 400
    _run(spark, lake, preds, batches, 3, 200, state=state)
    assert spark.read.parquet(preds).select(KEY).distinct().count() == 600


def test_rerun_of_same_batch_is_replaced_not_appended(spark, lake, scratch):
    preds, batches = f"{scratch}/predictions", f"{scratch}/batches"
    _run(spark, lake, preds, batches, 1, 200)
    jobs.persist_predictions(spark, batches, "run001", preds)
    jobs.persist_predictions(spark, batches, "run001", preds)
    p = spark.read.parquet(preds)
    assert p.count() == p.select(KEY).distinct().count() == 200


def test_batch_is_independent_of_layout(spark, lake):
    gold = read_layer(spark, f"{lake['root']}/gold")
    none = spark.createDataFrame([], "trans_num string")
    a = [r[KEY] for r in INC.next_batch(INC.unscored(gold, none), 50).collect()]
    shuffled = gold.repartition(7, F.rand(3))
    b = [r[KEY] for r in INC.next_batch(INC.unscored(shuffled, none), 50).collect()]
    assert a == b


def test_ties_at_the_batch_boundary_break_on_key(spark):
    ts = dt.datetime(2024, 1, 1)
    rows = [(str(i), ts) for i in range(20)]
    df = spark.createDataFrame(rows, "trans_num string, ingestion_timestamp timestamp_ntz")
    got = [r[KEY] for r in INC.next_batch(df, 5).collect()]
    assert got == sorted(str(i) for i in range(20))[:5]


def test_null_times_come_first_and_null_keys_never_selected(spark):
    rows = [("a", dt.datetime(2024, 1, 2)), ("b", None), (None, dt.datetime(2024, 1, 1))]
    df = spark.createDataFrame(rows, "trans_num string, ingestion_timestamp timestamp_ntz")
    none = spark.createDataFrame([], "trans_num string")
    got = [r[KEY] for r in INC.next_batch(INC.unscored(df, none), 10).collect()]
    assert got == ["b", "a"]


def test_ingest_cursor_with_lookback_takes_back_dated_rows_once(spark):
    t = dt.datetime(2024, 1, 10)
    schema = "trans_num string, ingestion_timestamp timestamp_ntz"
    bronze = spark.createDataFrame([("a", t - dt.timedelta(hours=2)), ("b", t)], schema)
    source = spark.createDataFrame(
        [
            ("a", t - dt.timedelta(hours=2)),  # already loaded
            ("b", t),  # already loaded, inside the look-back window
            ("c", t - dt.timedelta(hours=1)),  # back-dated, arrived late
            ("d", t + dt.timedelta(hours=1)),  # new
            ("b", t + dt.timedelta(hours=3)),  # re-sent copy with a newer time
            ("z", t - dt.timedelta(days=3)),  # older than the look-back: not re-read
            ("n", None),  # no cursor value: taken once
        ],
        schema,
    )
    got = sorted((r[KEY], r["ingestion_timestamp"]) for r in INC.ingest(source, bronze, lookback=dt.timedelta(hours=6)).collect())
    assert got == [
        ("b", t + dt.timedelta(hours=3)),
        ("c", t - dt.timedelta(hours=1)),
        ("d", t + dt.timedelta(hours=1)),
        ("n", None),
    ]
    assert INC.ingest(source, spark.createDataFrame([], schema)).count() == 7
    loaded = bronze.unionByName(INC.ingest(source, bronze, lookback=dt.timedelta(hours=6)))
    assert INC.ingest(source, loaded, lookback=dt.timedelta(hours=6)).count() == 0  # rerun: nothing twice


def test_rows_to_append_one_per_key(spark):
    schema = "trans_num string, fraud_probability double, inference_timestamp timestamp_ntz"
    t = dt.datetime(2024, 1, 1)
    batch = spark.createDataFrame([("a", 0.1, t), ("a", 0.2, t + dt.timedelta(hours=1)), ("b", 0.3, t), ("c", 0.4, t)], schema)
    target = spark.createDataFrame([("c",)], "trans_num string")
    got = {r[KEY]: r["fraud_probability"] for r in INC.rows_to_append(batch, target).collect()}
    assert got == {"a": 0.2, "b": 0.3}


def test_touched_only_overwrite_keeps_other_months(spark, scratch):
    schema = "trans_num string, transaction_year int, transaction_month int"
    path = f"{scratch}/layer"
    write_layer(spark.createDataFrame([("a", 2024, 1), ("b", 2024, 2)], schema), path)
    write_layer(spark.createDataFrame([("c", 2024, 2)], schema), path, touched_only=True)
    got = sorted(r[KEY] for r in spark.read.parquet(path).collect())
    assert got == ["a", "c"]
    write_layer(spark.createDataFrame([("d", 2024, 3)], schema), path, rebalance=True)
    assert sorted(r[KEY] for r in spark.read.parquet(path).collect()) == ["d"]


def test_incremental_silver_and_gold_equal_full_recompute(spark, scratch):
    """Two increments through the touched-months path give the same Silver and
    Gold as one full recompute over all of Bronze."""
    bronze = bronze_from_events(load_table(spark, SF, "events"))
    cut1, cut2 = "2024-01-12 00:00:00", "2024-01-22 00:00:00"
    ts = F.col("ingestion_timestamp")
    # Bronze grows in three appends; the dedupe must reach across them.
    bronze.filter(ts < F.lit(cut1).cast("timestamp_ntz")).write.parquet(f"{scratch}/bronze")
    jobs.bronze_to_silver(spark, f"{scratch}/bronze", f"{scratch}/silver")
    for lo, hi in ((cut1, cut2), (cut2, None)):
        part = bronze.filter(ts >= F.lit(lo).cast("timestamp_ntz"))
        if hi:
            part = part.filter(ts < F.lit(hi).cast("timestamp_ntz"))
        part.write.mode("append").parquet(f"{scratch}/bronze")
        months = jobs.bronze_to_silver_incremental(spark, f"{scratch}/bronze", f"{scratch}/silver", dt.datetime.fromisoformat(lo))
        assert months
        jobs.silver_to_gold(spark, f"{scratch}/silver", f"{scratch}/gold", as_of=AS_OF, months=months)
    jobs.bronze_to_silver(spark, f"{scratch}/bronze", f"{scratch}/silver_full")
    a = spark.read.parquet(f"{scratch}/silver")
    b = spark.read.parquet(f"{scratch}/silver_full").select(*a.columns)
    assert a.count() == 1000 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_ingest_job_first_then_incremental_then_rerun(spark, scratch):
    bronze_src = bronze_from_events(load_table(spark, SF, "events"))
    ts = F.col("ingestion_timestamp")
    first = bronze_src.filter(ts < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    assert jobs.ingest_to_bronze(spark, first, f"{scratch}/bronze") == first.count()
    # the source now holds everything; the lookback re-reads an hour, appends only what is new
    n2 = jobs.ingest_to_bronze(spark, bronze_src, f"{scratch}/bronze")
    assert n2 == bronze_src.count() - first.count()
    assert jobs.ingest_to_bronze(spark, bronze_src, f"{scratch}/bronze") == 0
    b = spark.read.parquet(f"{scratch}/bronze")
    assert b.count() == 1050 and b.exceptAll(bronze_src.select(*b.columns)).count() == 0


def test_cursor_mode_scores_rows_without_ingestion_time_once(spark, lake, scratch):
    gold = read_layer(spark, f"{lake['root']}/gold")
    nulled = gold.withColumn(
        "ingestion_timestamp",
        F.when(F.col("trans_num").isin("1", "2", "3"), F.lit(None)).otherwise(F.col("ingestion_timestamp")),
    )
    nulled.write.parquet(f"{scratch}/gold")
    preds, batches, state = f"{scratch}/p", f"{scratch}/b", f"{scratch}/st"
    for k in range(1, 6):
        jobs.run_inference(spark, f"{scratch}/gold", preds, f"{lake['root']}/model", batches, f"r{k}", RUN, 100,
                           state_path=state)
        jobs.persist_predictions(spark, batches, f"r{k}", preds)
    p = spark.read.parquet(preds)
    assert p.count() == p.select(KEY).distinct().count() == 500
    first = {r[KEY] for r in spark.read.parquet(f"{batches}/batch_id=r1").collect()}
    assert {"1", "2", "3"} <= first  # NULL times first, as in a full run


# --- incremental equals full ---------------------------------------------------


def _gold_copy(spark, lake, path):
    read_layer(spark, f"{lake['root']}/gold").write.partitionBy("transaction_year", "transaction_month").parquet(path)
    return path


def _late(spark, gold_path, key, ts):
    """A copy of a scorable row under another key and ingestion time, in a new file."""
    gold = spark.read.parquet(gold_path)
    row = ML.split_scorable(gold)[0].limit(1).withColumn(KEY, F.lit(key)).withColumn("ingestion_timestamp", F.lit(ts).cast("timestamp_ntz"))
    row.select(*gold.columns).write.mode("append").partitionBy("transaction_year", "transaction_month").parquet(gold_path)


def test_cursor_mode_equals_full_mode_with_late_resent_and_unpersisted_rows(spark, lake, scratch):
    gold = _gold_copy(spark, lake, f"{scratch}/gold")
    roots = {m: {"p": f"{scratch}/{m}/p", "b": f"{scratch}/{m}/b"} for m in ("full", "inc")}

    def run(k, n, persist=True):
        out = {}
        for m, r in roots.items():
            bid = f"run{k:03d}"
            jobs.run_inference(
                spark, gold, r["p"], f"{lake['root']}/model", r["b"], bid, RUN, n,
                state_path=f"{scratch}/inc/state" if m == "inc" else None, lookback=dt.timedelta(0),
            )
            out[m] = sorted(x[KEY] for x in spark.read.parquet(f"{r['b']}/batch_id={bid}").collect())
            if persist:
                jobs.persist_predictions(spark, r["b"], bid, r["p"])
        assert out["full"] == out["inc"]
        return out["inc"]

    run(1, 300)
    skipped = run(2, 200, persist=False)  # scored, never persisted
    assert run(3, 200) == skipped  # so it comes up again
    assert len(run(4, None)) == lake["scorable"] - 500
    assert run(5, None) == []
    _late(spark, gold, "late", dt.datetime(2020, 1, 1))  # ingested long before the last mark
    assert run(6, None) == ["late"]
    scored = spark.read.parquet(roots["inc"]["p"]).select(KEY).first()[0]
    _late(spark, gold, scored, dt.datetime(2024, 3, 1))  # resent: scored before
    assert run(7, 5) == []
    assert run(6, None) == ["late"]  # a rerun of a batch selects its rows again
    p = spark.read.parquet(roots["inc"]["p"])
    assert p.count() == p.select(KEY).distinct().count() == lake["scorable"] + 1


def test_incremental_silver_equals_full_after_corrected_times(spark, scratch):
    bronze = bronze_from_events(load_table(spark, SF, "events"))
    bad = bronze.filter("trans_date_trans_time = 'bad'").select(KEY).orderBy(KEY).first()[0]
    moved = bronze.filter("trans_date_trans_time <> 'bad'").select(KEY).orderBy(KEY).first()[0]
    # Two corrections: a time that could not be parsed, and one that moves to a month of its own.
    fixed = (
        bronze.filter(F.col(KEY).isin(bad, moved)).dropDuplicates([KEY])
        .withColumn("trans_date_trans_time", F.when(F.col(KEY) == bad, "2024-01-05 10:00:00").otherwise("2023-06-01 00:00:00"))
        .withColumn("ingestion_timestamp", F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))
    )
    back = fixed.filter(F.col(KEY) == moved).withColumn("trans_date_trans_time", F.lit("2024-01-02 00:00:00")).withColumn(
        "ingestion_timestamp", F.lit("2024-04-01 00:00:00").cast("timestamp_ntz")
    )
    bronze.write.parquet(f"{scratch}/bronze")
    jobs.bronze_to_silver(spark, f"{scratch}/bronze", f"{scratch}/inc")
    jobs.silver_to_gold(spark, f"{scratch}/inc", f"{scratch}/gold", as_of=AS_OF)
    for step, (more, since) in enumerate(((fixed, "2024-02-15"), (back, "2024-03-15"))):
        more.select(*bronze.columns).write.mode("append").parquet(f"{scratch}/bronze")
        months = jobs.bronze_to_silver_incremental(spark, f"{scratch}/bronze", f"{scratch}/inc", since)
        jobs.silver_to_gold(spark, f"{scratch}/inc", f"{scratch}/gold", as_of=AS_OF, months=months)
        jobs.bronze_to_silver(spark, f"{scratch}/bronze", f"{scratch}/full{step}")
        rows = {}
        for name in ("inc", f"full{step}"):
            df = spark.read.parquet(f"{scratch}/{name}")
            rows[name] = sorted(map(str, df.select(*sorted(df.columns)).collect()))
        assert rows["inc"] == rows[f"full{step}"] and len(rows["inc"]) == 1000
        gold = spark.read.parquet(f"{scratch}/gold")
        assert gold.count() == gold.select(KEY).distinct().count() == 1000


def test_ingest_takes_rows_without_a_key_once(spark):
    schema = "trans_num string, amt double, ingestion_timestamp timestamp_ntz"
    t = dt.datetime(2024, 1, 1)
    source = spark.createDataFrame([(None, 1.0, t), (None, 2.0, t), (None, 3.0, None), ("a", 1.0, t)], schema)
    assert INC.ingest(source, source.limit(0)).count() == 4
    assert INC.ingest(source, source).count() == 0
    more = source.union(spark.createDataFrame([(None, 4.0, t)], schema))
    assert [r["amt"] for r in INC.ingest(more, source).collect()] == [4.0]


def test_rows_below_the_mark_are_reported(spark):
    schema = "trans_num string, ingestion_timestamp timestamp_ntz"
    t = dt.datetime(2024, 1, 10)
    bronze = spark.createDataFrame([("a", t), ("b", t - dt.timedelta(days=2))], schema)
    source = bronze.union(spark.createDataFrame([("old", t - dt.timedelta(days=3)), ("new", t)], schema))
    assert [r[KEY] for r in INC.below_mark(source, bronze, lookback=dt.timedelta(hours=1)).collect()] == ["old"]
    assert INC.below_mark(source, bronze, lookback=dt.timedelta(days=5)).count() == 0


def test_a_rerun_that_shrinks_replaces_its_batch(spark, scratch):
    schema = "trans_num string, fraud_probability double, inference_timestamp timestamp_ntz"
    t = dt.datetime(2024, 1, 1)
    rows = spark.createDataFrame([(str(i), 0.5, t) for i in range(20)], schema)
    assert INC.append_idempotent(rows, f"{scratch}/p", "x") == 20
    assert INC.append_idempotent(rows.limit(0), f"{scratch}/p", "x") == 0
    assert INC.append_idempotent(rows, f"{scratch}/p", "y") == 20
    assert spark.read.parquet(f"{scratch}/p").count() == 20


def test_batch_cut_keeps_the_oldest_rows(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(str(i), t + dt.timedelta(minutes=20 * i)) for i in range(30)] + [("n", None)], "trans_num string, ingestion_timestamp timestamp_ntz")
    assert INC.batch_cut(df, 4) == t + dt.timedelta(hours=2)
    assert INC.batch_cut(df, 31) is None


def test_a_first_cycle_without_a_scorable_row(spark, scratch, lake):
    """Nothing can be scored yet: the cycle ends with zeros, and a later one scores."""
    bronze = bronze_from_events(load_table(spark, SF, "events"))
    paths = {k: f"{scratch}/{k}" for k in ("bronze", "silver", "gold", "batches", "predictions", "state")}
    paths["model"] = f"{lake['root']}/model"
    bronze.withColumn("lat", F.lit(None).cast("double")).write.parquet(paths["bronze"])
    out = jobs.scoring_cycle(spark, paths, RUN, "one", as_of=AS_OF)
    assert (out["scored"], out["appended"], out["alerts"]) == (0, 0, 0)
    later = bronze.withColumn("ingestion_timestamp", F.col("ingestion_timestamp") + dt.timedelta(days=60))
    later.write.mode("append").parquet(paths["bronze"])
    out = jobs.scoring_cycle(spark, paths, RUN, "two", as_of=AS_OF, n=None)
    assert out["scored"] == out["appended"] == lake["scorable"]
