"""

Each takes ``(spark, sf_dir)``, derives the transaction layers from the
whole ``events`` table (``txnlake.plans.fixtures``) and returns a lazy
DataFrame.  Column names equal those of the matching SQL in
``txnlake.plans.oracle_queries``.  Keys are the operator names of the survey,
except A10 (keyed ``run_status``) and E8 (keyed ``validation_report``).
Beyond one key per survey row: ``fraud_by_hour_gold`` (the first end-to-end
slice), ``silver_quality`` (reject counts, traps T11/T12),
``monitoring_panels`` (E7's one-pass aggregate), ``inference_selection``
(E3 up to the model) and the roadmap reports ``fraud_trend``,
``amount_anomalies`` and ``feature_drift``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions import features as X
from txnlake.functions.columns import INDEX_COLUMN, drop_if_present, normalize_columns
from txnlake.functions.formatting import AMOUNT_LABELS, TIME_LABELS
from txnlake.operators import alerts as AL
from txnlake.operators import changes as CH
from txnlake.operators import sketches as SK
from txnlake.operators.anomaly import amount_anomalies, drift_report, past_anomalies
from txnlake.operators.bootstrap import compare_predictions
from txnlake.operators.silver import silver_quality, to_silver
from txnlake.operators.trends import fraud_trend
from txnlake.plans import jobs
from txnlake.operators import incremental as INC
from txnlake.operators import ml as ML
from txnlake.operators import monitoring as MON
from txnlake.operators import reconcile as REC
from txnlake.operators.keystore import KeyStore
from txnlake.operators.panel_state import PanelState
from txnlake.operators import validation as VAL
from txnlake.schemas import FEATURES, KEY, LABEL, PREDICTIONS, PREDICTIONS_TABLE
from txnlake.plans import fixtures as FX
from txnlake.session import checkpoint_dir
from txnlake.sinks import batches as BATCHES
from txnlake.sinks.layers import write_layer
from txnlake.sources.layers import existing_keys, read_layer, read_or_empty
from txnlake.streaming import layers as S

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Fixed state of the fixture runs (test data only).
SCORED_BEFORE = "2024-01-10 00:00:00"  # earlier runs scored Gold rows ingested before this
BATCH_UPTO = "2024-01-15 00:00:00"  # the two halves of the drift report
BRONZE_UPTO = "2024-01-20 00:00:00"  # Bronze holds rows ingested before this
LOOKBACK = dt.timedelta(days=1)
NOW = FX.RUN_TS  # alert clock


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn

    return deco


def _layers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return FX.fixture_layers(spark, sf_dir)


def _before(df: DataFrame, ts: str) -> DataFrame:
    return df.filter(F.col("ingestion_timestamp") < F.lit(ts).cast("timestamp_ntz"))


def _scored_keys(L: dict[str, DataFrame]) -> DataFrame:
    """Keys of the predictions earlier runs wrote."""
    return existing_keys(FX.predictions_from_gold(_before(L["gold"], SCORED_BEFORE)))


def _waiting(L):
    return INC.unscored(L["gold"], _scored_keys(L))


def _batch(L):
    return INC.next_batch(_waiting(L))


def _labelled(L) -> DataFrame:
    """Fixture predictions with the true label beside them."""
    g = L["gold"]
    return FX.predictions_from_gold(g).join(g.select(KEY, LABEL), KEY)


# --- the minimum slice ------------------------------------------------------


@register("fraud_by_hour_gold")
def q_fraud_by_hour_gold(spark, sf_dir):
    """Labelled frauds per transaction hour on Gold."""
    gold = _layers(spark, sf_dir)["gold"]
    return gold.filter(F.col("is_fraud") == 1).groupBy("transaction_hour").agg(F.count(F.lit(1)).alias("frauds"))


# --- 2.1 sources --------------------------------------------------------------

EVENTS_REQUIRED = ["event_id", "ts", "user_id", "event_type", "value"]


@register("scan_layer")
def q_scan_layer(spark, sf_dir):
    events = read_layer(spark, f"{sf_dir.rstrip('/')}/events.parquet", required=EVENTS_REQUIRED)
    return FX.bronze_from_events(events)


@register("scan_keys")
def q_scan_keys(spark, sf_dir):
    return _scored_keys(_layers(spark, sf_dir))


@register("scan_predictions")
def q_scan_predictions(spark, sf_dir):
    return _layers(spark, sf_dir)["predictions"]


@register("ingest_full")
def q_ingest_full(spark, sf_dir):
    L = _layers(spark, sf_dir)
    empty = spark.createDataFrame([], L["bronze"].schema)
    return INC.ingest(L["bronze"], empty)


@register("ingest_incremental")
def q_ingest_incremental(spark, sf_dir):
    b = _layers(spark, sf_dir)["bronze"]
    return INC.ingest(b, _before(b, BRONZE_UPTO), lookback=LOOKBACK)


# --- 2.2 sinks (the selection part of the idempotent append) ------------------


@register("append_idempotent")
def q_append_idempotent(spark, sf_dir):
    L = _layers(spark, sf_dir)
    batch = FX.predictions_from_gold(L["gold"])
    return INC.rows_to_append(batch, _scored_keys(L))


# --- 2.3 projections ------------------------------------------------------


@register("feature_select")
def q_feature_select(spark, sf_dir):
    return ML.select_features(_layers(spark, sf_dir)["gold"])


@register("training_select")
def q_training_select(spark, sf_dir):
    return ML.select_training(_layers(spark, sf_dir)["gold"])


@register("cast_amount")
def q_cast_amount(spark, sf_dir):
    return _layers(spark, sf_dir)["silver"].select(KEY, "amt")


@register("parse_timestamp")
def q_parse_timestamp(spark, sf_dir):
    b = _layers(spark, sf_dir)["bronze"]
    return b.select(
        KEY,
        F.col("trans_date_trans_time").alias("raw_time"),
        X.parse_timestamp(F.col("trans_date_trans_time")).alias("parsed_time"),
    )


@register("temporal_parts")
def q_temporal_parts(spark, sf_dir):
    return _layers(spark, sf_dir)["silver"].select(
        KEY, "transaction_year", "transaction_month", "transaction_day", "transaction_hour"
    )


@register("weekend_flag")
def q_weekend_flag(spark, sf_dir):
    return _layers(spark, sf_dir)["silver"].select(KEY, "trans_date_trans_time", "is_weekend")


@register("customer_age")
def q_customer_age(spark, sf_dir):
    return _layers(spark, sf_dir)["gold"].select(KEY, "dob", "customer_age")


@register("high_amount_flag")
def q_high_amount_flag(spark, sf_dir):
    return _layers(spark, sf_dir)["gold"].select(KEY, "amt", "high_amount_flag")


@register("night_flag")
def q_night_flag(spark, sf_dir):
    return _layers(spark, sf_dir)["gold"].select(KEY, "transaction_hour", "night_transaction_flag")


@register("distance")
def q_distance(spark, sf_dir):
    return _layers(spark, sf_dir)["gold"].select(KEY, "customer_merchant_distance")


@register("stamp_inference")
def q_stamp_inference(spark, sf_dir):
    L = _layers(spark, sf_dir)
    return INC.stamp(ML.select_features(_batch(L)), NOW)


@register("label_recode")
def q_label_recode(spark, sf_dir):
    return MON.recode_labels(_layers(spark, sf_dir)["predictions"])


@register("format_metrics")
def q_format_metrics(spark, sf_dir):
    p = _layers(spark, sf_dir)["predictions"]
    return MON.format_kpis(MON.kpis(p))


@register("alert_message")
def q_alert_message(spark, sf_dir):
    p = _layers(spark, sf_dir)["predictions"]
    return AL.alert_message(AL.alerts(p, NOW)).select("message")


# --- 2.4 filters --------------------------------------------------------------


@register("prediction_filter")
def q_prediction_filter(spark, sf_dir):
    p = _layers(spark, sf_dir)["predictions"]
    return MON.by_prediction(p, "Non Fraud Only").select(KEY, "fraud_prediction", "fraud_probability")


@register("fraud_only")
def q_fraud_only(spark, sf_dir):
    p = _layers(spark, sf_dir)["predictions"]
    return MON.fraud_only(p).select(KEY, "amt", "fraud_probability")


@register("map_filter")
def q_map_filter(spark, sf_dir):
    p = _layers(spark, sf_dir)["predictions"]
    return MON.map_filter(p).select(KEY, "amt", "fraud_probability", "lat", "long")


@register("drop_null_coords")
def q_drop_null_coords(spark, sf_dir):
    p = _layers(spark, sf_dir)["predictions"]
    return MON.drop_null_coords(MON.map_filter(p)).select(KEY, "amt", "fraud_probability", "lat", "long")


@register("drop_null_training")
def q_drop_null_training(spark, sf_dir):
    return ML.clean_training(ML.select_training(_layers(spark, sf_dir)["gold"]))


@register("recent_fraud")
def q_recent_fraud(spark, sf_dir):
    p = _layers(spark, sf_dir)["predictions"]
    return AL.recent_fraud(p, NOW).select(*AL.ALERT_COLUMNS)


# --- 2.5 join -------------------------------------------------------------------


@register("unscored")
def q_unscored(spark, sf_dir):
    return _waiting(_layers(spark, sf_dir))


# --- 2.6 aggregations -------------------------------------------------------------


@register("row_count")
def q_row_count(spark, sf_dir):
    return VAL.row_count(_layers(spark, sf_dir)["predictions"], "predictions")


@register("kpis")
def q_kpis(spark, sf_dir):
    return MON.kpis(_layers(spark, sf_dir)["predictions"])


@register("fraud_distribution")
def q_fraud_distribution(spark, sf_dir):
    return MON.distribution(_layers(spark, sf_dir)["predictions"])


@register("fraud_by_hour")
def q_fraud_by_hour(spark, sf_dir):
    return MON.by_hour(_layers(spark, sf_dir)["predictions"])


@register("by_high_amount")
def q_by_high_amount(spark, sf_dir):
    return MON.by_flag(_layers(spark, sf_dir)["predictions"], "high_amount_flag", AMOUNT_LABELS)


@register("by_night")
def q_by_night(spark, sf_dir):
    return MON.by_flag(_layers(spark, sf_dir)["predictions"], "night_transaction_flag", TIME_LABELS)


@register("monitoring_panels")
def q_monitoring_panels(spark, sf_dir):
    """E7's one-scan GROUPING SETS aggregate behind the seven aggregate panels."""
    return MON.panel_aggregates(_layers(spark, sf_dir)["predictions"])


@register("hist_probability")
def q_hist_probability(spark, sf_dir):
    p = _layers(spark, sf_dir)["predictions"]
    return MON.histogram(p, "fraud_probability", MON.PROBABILITY_BINS, 0.0, 1.0)


@register("hist_distance")
def q_hist_distance(spark, sf_dir):
    p = _layers(spark, sf_dir)["predictions"]
    return MON.histogram(p, "customer_merchant_distance", MON.DISTANCE_BINS)


@register("silver_quality")
def q_silver_quality(spark, sf_dir):
    return silver_quality(_layers(spark, sf_dir)["bronze"])


@register("uniqueness")
def q_uniqueness(spark, sf_dir):
    return VAL.uniqueness(_layers(spark, sf_dir)["bronze"])


@register("run_status")
def q_run_status(spark, sf_dir):
    return MON.pipeline_status(_layers(spark, sf_dir)["predictions"])


@register("layer_validation")
def q_layer_validation(spark, sf_dir):
    L = _layers(spark, sf_dir)
    layers = {k: L[k] for k in ("bronze", "silver", "gold", "predictions")}
    return VAL.validate_layers(layers, batch=_batch(L), waiting=_waiting(L))


# --- 2.7 top-k / sampling -----------------------------------------------------------


@register("next_batch")
def q_next_batch(spark, sf_dir):
    return _batch(_layers(spark, sf_dir))


@register("top_risk")
def q_top_risk(spark, sf_dir):
    return MON.top_risk(_layers(spark, sf_dir)["predictions"])


@register("latest_predictions")
def q_latest_predictions(spark, sf_dir):
    return MON.latest(_layers(spark, sf_dir)["predictions"], 20)


@register("alerts")
def q_alerts(spark, sf_dir):
    return AL.alerts(_layers(spark, sf_dir)["predictions"], NOW)


@register("raw_head")
def q_raw_head(spark, sf_dir):
    return MON.preview(_layers(spark, sf_dir)["predictions"])


@register("map_sample")
def q_map_sample(spark, sf_dir):
    p = _layers(spark, sf_dir)["predictions"]
    return MON.map_points(p).select(KEY, "lat", "long", "amt", "fraud_probability")


# --- 2.9 machine learning -------------------------------------------------------------

_MODELS: dict[tuple[str, str], object] = {}


def _training(L) -> DataFrame:
    return ML.clean_training(L["gold"].select(KEY, *FEATURES, LABEL))


def _split(L) -> DataFrame:
    return ML.stratified_split(_training(L))


def _model(spark, sf_dir, L):
    """The fitted pipeline for this data, fitted once per application."""
    k = (spark.sparkContext.applicationId, sf_dir)
    if k not in _MODELS:
        data = _training(L)
        rows = data.count()
        # Rows that one task of the fit may hold stay where the split leaves them; more are laid out for the fit.
        split = _split(L) if rows <= jobs.FIT_ROWS else jobs.split_for_fit(data, jobs.fit_partitions(rows))
        _MODELS[k] = ML.train(split.filter(~F.col("is_test")).drop("is_test"))
    return _MODELS[k]


@register("stratified_split")
def q_stratified_split(spark, sf_dir):
    return _split(_layers(spark, sf_dir)).select(KEY, LABEL, "is_test")


@register("reject_unscorable")
def q_reject_unscorable(spark, sf_dir):
    g = _layers(spark, sf_dir)["gold"]
    _, bad = ML.split_scorable(g)
    return bad.select(KEY, ML.null_feature_count().alias("null_features"))


@register("binary_metrics")
def q_binary_metrics(spark, sf_dir):
    return ML.binary_metrics(_labelled(_layers(spark, sf_dir)))


@register("classification_report")
def q_classification_report(spark, sf_dir):
    return ML.classification_report(_labelled(_layers(spark, sf_dir)))


@register("confusion_matrix")
def q_confusion_matrix(spark, sf_dir):
    return ML.confusion_matrix(_labelled(_layers(spark, sf_dir)))


@register("assemble")
def q_assemble(spark, sf_dir):
    g = _layers(spark, sf_dir)["gold"]
    ok, _ = ML.split_scorable(g)
    return ML.assemble(ML.select_features(ok)).select(KEY, vector_to_array(F.col("features")).alias("features"))


@register("assemble_elements")
def q_assemble_elements(spark, sf_dir):
    """The assembled vectors taken apart: one row per key and position."""
    ok, _ = ML.split_scorable(_layers(spark, sf_dir)["gold"])
    vectors = ML.assemble(ML.select_features(ok)).select(KEY, vector_to_array(F.col("features")).alias("v"))
    return vectors.select(KEY, F.posexplode("v").alias("position", "value"))


@register("train")
def q_train(spark, sf_dir):
    L = _layers(spark, sf_dir)
    m = _model(spark, sf_dir, L)
    rf = m.stages[-1]
    rows = [(i, t.depth, t.numNodes) for i, t in enumerate(rf.trees)]
    return spark.createDataFrame(rows, "tree int, depth int, nodes int")


@register("score")
def q_score(spark, sf_dir):
    L = _layers(spark, sf_dir)
    ok, _ = ML.split_scorable(_waiting(L))
    return ML.score(ML.select_features(INC.next_batch(ok)), _model(spark, sf_dir, L), NOW)


@register("importance_rank")
def q_importance_rank(spark, sf_dir):
    L = _layers(spark, sf_dir)
    return ML.feature_importance(_model(spark, sf_dir, L), spark)


# --- 2.10 end-to-end jobs ---------------------------------------------------------


@register("bronze_to_silver")
def q_bronze_to_silver(spark, sf_dir):
    return _layers(spark, sf_dir)["silver"]


@register("silver_to_gold")
def q_silver_to_gold(spark, sf_dir):
    return _layers(spark, sf_dir)["gold"]


@register("inference_selection")
def q_inference_selection(spark, sf_dir):
    """E3 up to the model: unscored -> scorable -> oldest 5,000 -> features."""
    L = _layers(spark, sf_dir)
    ok, _ = ML.split_scorable(_waiting(L))
    return ML.select_features(INC.next_batch(ok))


@register("inference_batch")
def q_inference_batch(spark, sf_dir):
    L = _layers(spark, sf_dir)
    return jobs.inference_batch(L["gold"], _scored_keys(L), _model(spark, sf_dir, L), NOW)


@register("train_model")
def q_train_model(spark, sf_dir):
    """E5 through the job itself: its hold-out metrics."""
    return jobs.train_on(_layers(spark, sf_dir)["gold"])["metrics"]


# --- incremental paths, against the full rule ----------------------------------------


FIRST_BATCH = 700  # rows of the first run in ``unscored_cursor``


@register("unscored_cursor")
def q_unscored_cursor(spark, sf_dir):
    """N1/E3 as cursor mode does it.  Gold arrives in two loads: a first run scores and persists a batch and leaves its mark;
    then a part of Gold is written again as it was, and late and new rows arrive.  What the next run selects from the files
    behind its mark must be what a run over all of Gold would."""
    L = _layers(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/cursor-{uuid.uuid4().hex[:12]}"
    P = {k: f"{root}/{k}" for k in ("source", "gold", "predictions", "model", "batches", "state")}
    # Derived once, in columns: the loads, the scored part and each pass of the fit read what they need of it.
    L["gold"].write.parquet(P["source"])
    gold = spark.read.schema(L["gold"].schema).parquet(P["source"])
    ML.save_model(ML.train(_training({"gold": gold}).drop(KEY), num_trees=2, max_depth=2), P["model"])
    FX.predictions_from_gold(_before(gold, SCORED_BEFORE)).write.parquet(f"{P['predictions']}/batch_id=earlier")
    k = F.col(KEY).cast("long")
    first = _before(gold, BRONZE_UPTO).filter(k % 13 != 0)
    for part, rows in (("a", first.filter(k % 5 == 0)), ("b", first.filter(k % 5 != 0))):
        rows.write.parquet(f"{P['gold']}/part={part}")

    def run(batch_id: str, n: int) -> None:
        jobs.run_inference(
            spark, P["gold"], P["predictions"], P["model"], P["batches"], batch_id, dt.datetime(2024, 1, 31), n, P["state"], dt.timedelta(0)
        )

    run("one", FIRST_BATCH)
    jobs.persist_predictions(spark, P["batches"], "one", P["predictions"])
    first.filter(k % 5 == 0).write.mode("overwrite").parquet(f"{P['gold']}/part=a")
    later = F.coalesce(F.col("ingestion_timestamp") >= F.lit(BRONZE_UPTO).cast("timestamp_ntz"), F.lit(True))
    gold.filter((k % 13 == 0) | later).write.parquet(f"{P['gold']}/part=c")
    run("two", INC.BATCH_SIZE)
    return spark.read.schema(PREDICTIONS).parquet(f"{P['batches']}/batch_id=two").select(KEY, "amt")


@register("silver_merge")
def q_silver_merge(spark, sf_dir):
    """E1 incrementally: Silver of the earlier Bronze rows, then the later ones merged into its months.
    Times of every 50th record were wrong at first, so the merge also moves records between months."""
    L = _layers(spark, sf_dir)
    path = f"{checkpoint_dir(spark)}/silver-merge-{uuid.uuid4().hex[:12]}"
    early = F.col("ingestion_timestamp") < F.lit(BRONZE_UPTO).cast("timestamp_ntz")
    wrong = F.col(KEY).cast("long") % 50 == 0
    first = L["bronze"].filter(early | wrong).withColumn(
        "trans_date_trans_time", F.when(wrong, F.lit("2023-06-01 00:00:00")).otherwise(F.col("trans_date_trans_time"))
    ).withColumn("ingestion_timestamp", F.when(wrong, F.lit("2000-01-01").cast("timestamp_ntz")).otherwise(F.col("ingestion_timestamp")))
    write_layer(to_silver(first), path, rebalance=True)
    jobs.merge_into_silver(L["bronze"].filter(~early | wrong), path)
    silver = L["silver"]
    return spark.read.schema(silver.schema).parquet(path).select(*silver.columns)


def _copy() -> Column:
    """Whether a Bronze row is a re-ingested copy: it came later than the hour of its transaction."""
    return F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ingestion_timestamp) > unix_time")


@register("stream_latest")
def q_stream_latest(spark, sf_dir):
    """Bronze arrives in three drops, each streamed when it is there (one checkpoint): newer copies before their
    originals, the rest, and late newer copies.  Silver must hold the latest copy of every key."""
    bronze = _layers(spark, sf_dir)["bronze"]
    root = f"{checkpoint_dir(spark)}/stream-latest-{uuid.uuid4().hex[:12]}"
    ahead = F.col(KEY).cast("long") % 40 == 3  # of every second re-sent key the newer copy comes first
    early = F.col("ingestion_timestamp") < F.lit(BRONZE_UPTO).cast("timestamp_ntz")
    drop = F.when(_copy(), F.when(ahead, 1).otherwise(3)).when(ahead | ~early, 2).otherwise(1)
    for i in (1, 2, 3):
        bronze.filter(drop == i).write.mode("append").parquet(f"{root}/bronze")
        stream = S.bronze_stream(spark, f"{root}/bronze", bronze.schema, arrival=True)
        query = S.start_latest_merge(S.latest_stream(stream), f"{root}/silver", f"{root}/checkpoint")
        query.awaitTermination()
    silver = _layers(spark, sf_dir)["silver"]
    return read_or_empty(spark, f"{root}/silver", silver.schema).select(*silver.columns)


def _edited(df: DataFrame, key: str = KEY) -> DataFrame:
    """The rows with edits: some keys gone, some amounts and cities changed, some new keys."""
    k = F.col(key).cast("long")
    kept = df.filter(k % 97 != 5).withColumns(
        {
            "amt": F.when(k % 89 == 3, F.col("amt") + 1).otherwise(F.col("amt")).cast(df.schema["amt"].dataType),
            "city_pop": F.when(k % 83 == 7, F.lit(None)).otherwise(F.col("city_pop")).cast("int"),
        }
    )
    return kept.unionByName(df.filter(k % 101 == 9).withColumn(key, F.concat(F.lit("9000000"), F.col(key))))


@register("reconcile_layers")
def q_reconcile_layers(spark, sf_dir):
    """Gold against a loaded copy of it with planted edits and rows that were loaded twice."""
    gold = _layers(spark, sf_dir)["gold"]
    loaded = _edited(gold)
    return REC.reconcile(gold, loaded.unionByName(loaded.filter(F.col(KEY).cast("long") % 103 == 11)))


SNAPSHOT_AT = dt.datetime(2024, 3, 1)


@register("snapshot_changes")
def q_snapshot_changes(spark, sf_dir):
    """Rows inserted, edited or deleted at the source between Bronze's last load and a full snapshot."""
    bronze = _layers(spark, sf_dir)["bronze"]
    found = CH.snapshot_changes(bronze, _edited(bronze.filter(~_copy())), SNAPSHOT_AT)
    return found.select(KEY, "amt", "city_pop", INC.CURSOR, CH.DELETED, "change")


@register("snapshot_merge")
def q_snapshot_merge(spark, sf_dir):
    """S7 through the layers: a snapshot's changes are appended to Bronze and merged into Silver and Gold; Gold must be
    that of the snapshot."""
    bronze = _layers(spark, sf_dir)["bronze"]
    root = f"{checkpoint_dir(spark)}/snapshot-{uuid.uuid4().hex[:12]}"
    bronze.write.parquet(f"{root}/bronze")
    jobs.bronze_to_silver(spark, f"{root}/bronze", f"{root}/silver")
    jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", as_of=FX.AS_OF)
    jobs.ingest_snapshot(spark, _edited(bronze.filter(~_copy())), f"{root}/bronze", SNAPSHOT_AT)
    months = jobs.bronze_to_silver_incremental(spark, f"{root}/bronze", f"{root}/silver", SNAPSHOT_AT)
    jobs.silver_to_gold(spark, f"{root}/silver", f"{root}/gold", as_of=FX.AS_OF, months=months)
    gold = _layers(spark, sf_dir)["gold"]
    return read_or_empty(spark, f"{root}/gold", gold.schema).select(*gold.columns).drop(INC.CURSOR)


def _in_batches(predictions: DataFrame, path: str, n: int) -> None:
    """The predictions table as runs leave it: ``n`` batch folders."""
    batch = F.concat(F.lit("run"), F.pmod(F.col(KEY).cast("long"), F.lit(n)).cast("string"))
    predictions.withColumn("batch_id", batch).repartition("batch_id").write.partitionBy("batch_id").parquet(path)


@register("append_keystore")
def q_append_keystore(spark, sf_dir):
    """K4/N1 on a bucketed key store: a part of the scored batches is in the store, later ones are in their folders,
    and one was written again since, with half of its rows at first."""
    L = _layers(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/key-store-{uuid.uuid4().hex[:12]}"
    scored = FX.predictions_from_gold(_before(L["gold"], SCORED_BEFORE)).withColumn("_run", F.pmod(F.col(KEY).cast("long"), F.lit(24)))
    half = scored.filter((F.col("_run") < 16) & ((F.col("_run") != 3) | (F.col("amt") > 100))).drop("_run")
    _in_batches(half, f"{root}/predictions", 24)
    store = KeyStore(spark, f"{root}/keys", f"{root}/predictions")
    store.refresh()
    again = scored.filter("_run = 3").drop("_run")
    again.write.mode("overwrite").parquet(f"{root}/predictions/batch_id=run3")
    scored.filter("_run >= 16").withColumn("batch_id", F.concat(F.lit("run"), F.col("_run"))).drop("_run").write.mode("append").partitionBy(
        "batch_id"
    ).parquet(f"{root}/predictions")
    return store.absent(INC.one_row_per_key(FX.predictions_from_gold(L["gold"])))


@register("compact_batches")
def q_compact_batches(spark, sf_dir):
    """K2/K3: two hundred batch folders packed into few files, a batch written again, the rest packed again; the table's rows
    are those of the batches."""
    predictions = _layers(spark, sf_dir)["predictions"]
    path = f"{checkpoint_dir(spark)}/compact-{uuid.uuid4().hex[:12]}"
    _in_batches(predictions, path, 200)
    jobs.compact_predictions(spark, path, target_mb=4)
    INC.append_idempotent(predictions.filter(F.col(KEY).cast("long") % 200 == 7), path, "run7")
    jobs.compact_predictions(spark, path)
    return BATCHES.read_batches(spark, path, PREDICTIONS_TABLE).select(*predictions.columns)


@register("panels_refreshed")
def q_panels_refreshed(spark, sf_dir):
    """E7 from partial states: a refresh over the first batches, then some are written again and late ones arrive, and a
    second refresh reads only those."""
    predictions = _layers(spark, sf_dir)["predictions"]
    root = f"{checkpoint_dir(spark)}/panels-{uuid.uuid4().hex[:12]}"
    k = F.pmod(F.col(KEY).cast("long"), F.lit(24))
    early = predictions.filter(k < 20).withColumn("fraud_probability", F.when(k == 5, F.lit(0.5)).otherwise(F.col("fraud_probability")))
    _in_batches(early, f"{root}/predictions", 24)
    state = PanelState(spark, f"{root}/panels", f"{root}/predictions")
    state.refresh()
    predictions.filter(k == 5).write.mode("overwrite").parquet(f"{root}/predictions/batch_id=run5")
    late = predictions.filter(k >= 20).withColumn("batch_id", F.concat(F.lit("run"), k))
    late.write.mode("append").partitionBy("batch_id").parquet(f"{root}/predictions")
    state.refresh()
    return state.totals()


# --- contracts of the model operators: what holds for any right forest --------------


@register("score_contract")
def q_score_contract(spark, sf_dir):
    """M4 over all scorable rows: every key once, a probability in 0..1, a label that agrees with it, one run time."""
    L = _layers(spark, sf_dir)
    ok, _ = ML.split_scorable(L["gold"])
    p = F.col("fraud_probability")
    return ML.score(ML.select_features(ok), _model(spark, sf_dir, L), NOW).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(KEY).alias("keys"),
        F.count_if(p.isNull() | (p < 0) | (p > 1)).alias("bad_probability"),
        F.count_if(F.col("fraud_prediction") != (p > 0.5).cast("int")).alias("bad_label"),
        F.count_if(F.col("inference_timestamp") != F.lit(NOW).cast("timestamp_ntz")).alias("bad_time"),
    )


@register("train_contract")
def q_train_contract(spark, sf_dir):
    """M3: a row for each tree of the forest: its depth within the limit, and the same tree from Gold in few and in four times as many files."""
    L = _layers(spark, sf_dir)
    gold = L["gold"]
    root = f"{checkpoint_dir(spark)}/train-{uuid.uuid4().hex[:12]}"
    # Two and eight files of a small Gold; of a larger one as many times more, so no file grows with the table.
    times = jobs.fit_partitions(L["events"].count()) // jobs.FIT_PARTITIONS
    fits = []
    for files in (2 * times, 8 * times):
        gold.repartition(files).write.parquet(f"{root}/gold{files}")
        gold = spark.read.schema(gold.schema).parquet(f"{root}/gold{files}")  # derived once: the second layout is dealt from the first
        forest = jobs.train_on(gold)["model"].stages[-1]
        fits.append([(t.depth, t.toDebugString.split("\n", 1)[1]) for t in forest.trees])
    rows = [(i, a[0] <= ML.MAX_DEPTH, a == b) for i, (a, b) in enumerate(zip(*fits))]
    return spark.createDataFrame(rows, "tree int, within_depth boolean, same_on_other_files boolean")


@register("inference_batch_contract")
def q_inference_batch_contract(spark, sf_dir):
    """The keys that the batch must hold, whatever the model says of them."""
    L = _layers(spark, sf_dir)
    return jobs.inference_batch(L["gold"], _scored_keys(L), _model(spark, sf_dir, L), NOW).select(KEY, "amt")


@register("train_model_contract")
def q_train_model_contract(spark, sf_dir):
    """E5: the class supports of the hold-out that the job reports on."""
    r = jobs.train_on(_layers(spark, sf_dir)["gold"], num_trees=5, max_depth=4)["confusion"]
    return r.groupBy(F.col("label").alias("actual")).agg(F.sum("count").alias("support"))


@register("importance_contract")
def q_importance_contract(spark, sf_dir):
    """Each feature once, shares that are not negative and sum to 1."""
    L = _layers(spark, sf_dir)
    r = ML.feature_importance(_model(spark, sf_dir, L), spark)
    return r.agg(
        F.count_distinct("feature").alias("features"),
        F.count_if(F.col("importance") < 0).alias("negative"),
        F.round(F.sum("importance"), 6).alias("total"),
    )


# --- column operators and absent sources over the derived Bronze -----------------------


def _messy(b: DataFrame) -> DataFrame:
    """Bronze under the names a raw export has."""
    return b.select(F.col(KEY).alias(" Trans Num "), F.col("amt").alias("AMT"), F.col("city_pop").alias("City Pop"), F.lit(0).alias(INDEX_COLUMN))


@register("normalize_columns")
def q_normalize_columns(spark, sf_dir):
    b = _messy(_layers(spark, sf_dir)["bronze"])
    return normalize_columns(drop_if_present(b, INDEX_COLUMN), {"amt": "amount"})


@register("drop_if_present")
def q_drop_if_present(spark, sf_dir):
    b = _layers(spark, sf_dir)["bronze"].select(KEY, "amt", "dob")
    return drop_if_present(b, "dob", "no_such_column")


@register("separate_columns")
def q_separate_columns(spark, sf_dir):
    """The key stays beside the vector, which holds the features alone."""
    ok, _ = ML.split_scorable(_layers(spark, sf_dir)["gold"])
    return ML.assemble(ML.select_features(ok)).select(KEY, F.size(vector_to_array(F.col("features"))).alias("width"))


@register("missing_source")
def q_missing_source(spark, sf_dir):
    """With the predictions absent, every Gold key is unscored."""
    gold = _layers(spark, sf_dir)["gold"]
    none = read_or_empty(spark, f"{sf_dir.rstrip('/')}/no_such_predictions", PREDICTIONS)
    return INC.unscored(gold, existing_keys(none)).select(KEY)


@register("alert_batch")
def q_alert_batch(spark, sf_dir):
    return AL.alert_batch(_layers(spark, sf_dir)["predictions"], NOW)


@register("validation_report")
def q_validation_report(spark, sf_dir):
    L = _layers(spark, sf_dir)
    return VAL.validation_report({k: L[k] for k in ("bronze", "silver", "gold", "predictions")})


# --- 2.14 roadmap ------------------------------------------------------------------


@register("fraud_trend")
def q_fraud_trend(spark, sf_dir):
    return fraud_trend(_layers(spark, sf_dir)["gold"])


@register("amount_anomalies")
def q_amount_anomalies(spark, sf_dir):
    return amount_anomalies(_layers(spark, sf_dir)["gold"])


@register("feature_drift")
def q_feature_drift(spark, sf_dir):
    g = _layers(spark, sf_dir)["gold"]
    cut = F.lit(BATCH_UPTO).cast("timestamp_ntz")
    return drift_report(g.filter(F.col("ingestion_timestamp") < cut), g.filter(F.col("ingestion_timestamp") >= cut))


@register("past_anomalies")
def q_past_anomalies(spark, sf_dir):
    """X5 against earlier transactions only."""
    return past_anomalies(_layers(spark, sf_dir)["gold"])


@register("model_comparison")
def q_model_comparison(spark, sf_dir):
    """Two classifiers on the labelled rows, with bootstrap intervals of the differences.  The stand-ins: the fixture's
    scores, and a rule on distance and amount."""
    L = _layers(spark, sf_dir)
    rule = ((F.col("customer_merchant_distance") > 5) | ((F.col("amt") > 900) & (F.col("night_transaction_flag") == 1))).cast("int")
    rows = _labelled(L).select(KEY, LABEL, F.col("fraud_prediction").alias("current"), F.coalesce(rule, F.lit(0)).alias("candidate"))
    return compare_predictions(rows, "current", "candidate")


@register("key_sketches")
def q_key_sketches(spark, sf_dir):
    """A9/A11 by stored sketches: distinct keys by layer and keys still unscored, exactly, and whether each estimate lies
    within its bound."""
    L = _layers(spark, sf_dir)
    root = f"{checkpoint_dir(spark)}/sketches-{uuid.uuid4().hex[:12]}"
    SK.write_key_sketches(L["gold"], f"{root}/gold")
    _in_batches(FX.predictions_from_gold(_before(L["gold"], SCORED_BEFORE)), f"{root}/predictions", 12)
    scored = SK.KeySketches(spark, f"{root}/keys", f"{root}/predictions")
    scored.refresh()
    gold = SK.read_key_sketches(spark, f"{root}/gold")
    found = [
        ("gold", L["gold"], SK.distinct_keys(gold)),
        ("scored", _scored_keys(L), SK.distinct_keys(scored.sketches())),
        ("unscored", _waiting(L), SK.missing_keys(gold, scored.sketches())),
    ]
    out = None
    for name, rows, estimate in found:
        exact = rows.agg(F.count_distinct(KEY).alias("keys"))
        row = exact.join(estimate).select(F.lit(name).alias("what"), "keys", (F.abs(F.col("estimate") - F.col("keys")) <= F.col("bound")).alias("within_bound"))
        out = row if out is None else out.unionByName(row)
    return out


@register("quantile_drift")
def q_quantile_drift(spark, sf_dir):
    """X4 by KLL sketches: for each feature the rows of both periods, and how many of the sketches' deciles are not at
    their rank within the error (counted over all rows)."""
    g = _layers(spark, sf_dir)["gold"]
    at = F.lit(BATCH_UPTO).cast("timestamp_ntz")
    periods = [g.filter(F.col("ingestion_timestamp") < at), g.filter(F.col("ingestion_timestamp") >= at)]
    sketched = [SK.feature_sketches(p) for p in periods]
    drift = SK.quantile_drift(*sketched)
    sizes = sketched[0].join(sketched[1].toDF(*[f"c_{c}" for c in sketched[1].columns]))
    rows = sizes.select(
        F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"n_{f}").alias("base_rows"), F.col(f"c_n_{f}").alias("current_rows")) for f in FEATURES])).alias("r")
    ).select("r.*")
    ranks = [i / 10 for i in range(1, 10)]
    at_ranks = F.array(*[F.lit(r) for r in ranks])
    deciles = sketched[0].select(
        *[F.when(F.col(f"n_{f}") > 0, F.kll_sketch_get_quantile_double(f"s_{f}", at_ranks)).alias(f"q_{f}") for f in FEATURES]
    )
    tested = periods[0].join(F.broadcast(deciles))  # one row
    counts = []
    for f in FEATURES:
        x = F.col(f).cast("double")
        for i in range(9):
            q = F.get(f"q_{f}", F.lit(i))
            counts += [F.count_if(x < q).alias(f"lt_{f}_{i}"), F.count_if(x <= q).alias(f"le_{f}_{i}")]
        counts.append(F.count(F.when(~F.isnan(x), x)).alias(f"n_{f}"))
    counted = tested.agg(*counts)

    def below(count: str, f: str) -> Column:
        return F.try_divide(F.col(count), F.col(f"n_{f}"))

    off = [
        F.struct(
            F.lit(f).alias("feature"),
            sum(
                F.coalesce((below(f"lt_{f}_{i}", f) > r + SK.KLL_ERROR * 2) | (below(f"le_{f}_{i}", f) < r - SK.KLL_ERROR * 2), F.lit(False)).cast("int")
                for i, r in enumerate(ranks)
            ).alias("off"),
        )
        for f in FEATURES
    ]
    off = counted.select(F.explode(F.array(*off)).alias("o")).select("o.*")
    bad = drift.select("feature", ((F.col("ks") < 0) | (F.col("ks") > 1) | (F.col("psi") < 0)).cast("int").alias("bad"))
    return rows.join(F.broadcast(off), "feature").join(F.broadcast(bad), "feature", "left").select(
        "feature", "base_rows", "current_rows", (F.col("off") + F.coalesce("bad", F.lit(0))).cast("long").alias("beyond_error")
    )
