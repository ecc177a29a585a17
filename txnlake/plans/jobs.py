"""

Each job reads its inputs, builds one plan from the operators and writes
its output.  Row counts are read back from the written Parquet footers (no
second pass over the inputs).  ``DataFrame.observe`` is deliberately not
used: in Spark 4.1 it makes the session unserialisable for a fitted
forest's closures later in the same application.  Clocks, dates and batch
ids are arguments, so a retried job writes the same thing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.functions.columns import INDEX_COLUMN, drop_if_present, normalize_columns
from txnlake.operators import alerts as AL
from txnlake.operators import incremental as INC
from txnlake.operators import ml as ML
from txnlake.operators import reconcile as REC
from txnlake.operators.bootstrap import compare_predictions
from txnlake.operators.changes import DELETED, live, snapshot_changes
from txnlake.operators.gold import to_gold
from txnlake.operators.keystore import KeyStore
from txnlake.operators.silver import dedupe_latest, split_null_keys, standardize, to_silver
from txnlake.schemas import (
    FEATURES,
    GOLD_INPUT,
    KEY,
    LABEL,
    PARTITION_COLS,
    PREDICTIONS,
    PREDICTIONS_TABLE,
    SCORING_INPUT,
    SILVER_INPUT,
    TRAINING_INPUT,
)
from txnlake.session import checkpoint_dir
from txnlake.sinks import batches as BATCHES
from txnlake.sinks import layers as SINK
from txnlake.sources.layers import (
    TOMBSTONES,
    existing_keys,
    holds_nothing,
    jdbc_table_exists,
    read_jdbc,
    read_layer,
    read_or_empty,
    read_raw_csv,
    read_with_tombstones,
)


def _written_rows(spark: SparkSession, path: str) -> int:
    """Rows in a written Parquet output, answered from file footers."""
    return 0 if holds_nothing(spark, path) else spark.read.parquet(path).count()


# --- S6, S7: ingestion ------------------------------------------------------------


def ingest_to_bronze(
    spark: SparkSession,
    source: DataFrame,
    bronze_path: str,
    lookback: dt.timedelta = dt.timedelta(hours=1),
) -> int:
    """Append to Bronze the source rows it does not hold yet.

    First load: everything.  Later loads: rows at or beyond Bronze's
    ``max(ingestion_timestamp) - lookback``, minus records (key + ingestion
    time) already in that window.  A rerun after a failure appends nothing
    twice.  The rows to append are checkpointed before the append: the plan
    reads the Bronze window it is about to extend.  Returns rows appended.
    """
    schema = source.schema
    bronze = read_or_empty(spark, bronze_path, schema)
    if bronze.isEmpty():  # a first load reads nothing it extends: written once, straight from the source
        source.write.mode("append").parquet(bronze_path)
        return _written_rows(spark, bronze_path)
    checkpoint_dir(spark)
    new = INC.ingest(source, bronze, lookback=lookback).checkpoint(eager=True)
    n = new.count()
    if n:
        new.write.mode("append").parquet(bronze_path)
    return n


def ingest_snapshot(spark: SparkSession, snapshot: DataFrame, bronze_path: str, at) -> dict[str, int]:
    """Append to Bronze what a full snapshot of the source says has changed: new and edited rows and tombstones of
    deleted ones, stamped ``at`` (``operators.changes``).  The next layer refresh carries them through Silver and Gold.
    A rerun after a failure finds nothing left to append.  Returns the rows by change."""
    bronze = read_or_empty(spark, bronze_path, snapshot.schema)
    if bronze.isEmpty():
        snapshot.write.mode("append").parquet(bronze_path)
        return {"insert": _written_rows(spark, bronze_path)}
    checkpoint_dir(spark)
    changes = snapshot_changes(read_with_tombstones(spark, bronze_path), snapshot, at).checkpoint(eager=True)
    counts = {r["change"]: r["count"] for r in changes.groupBy("change").count().collect()}
    if counts:
        SINK.touch(spark, f"{bronze_path.rstrip('/')}/{TOMBSTONES}")
        changes.drop("change").write.mode("append").parquet(bronze_path)
    return counts


def verify_load(source: DataFrame, loaded: DataFrame, key: str = KEY, ignore: tuple[str, ...] = ()) -> dict:
    """Whether a loaded table holds the content of its source, by digest trees; counts of the keys that differ."""
    return REC.summary(REC.reconcile(source, loaded, key, ignore)).first().asDict()


# --- E1, E2: layers -------------------------------------------------------------


def bronze_to_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    touched_only: bool = False,
    rebalance: bool = True,
) -> int:
    """Bronze -> Silver. ``touched_only`` replaces only the months present in
    the input (for a Bronze read restricted to new rows); otherwise the layer
    is recomputed whole.  ``rebalance`` (default) re-shuffles the deduplicated
    rows by month so files come out near the advisory size (see
    ``write_layer``)."""
    if bronze_path.rstrip("/") == silver_path.rstrip("/"):
        raise ValueError("a layer cannot be rewritten in place")
    df = to_silver(read_with_tombstones(spark, bronze_path, required=SILVER_INPUT))
    SINK.write_layer(df, silver_path, touched_only=touched_only, rebalance=rebalance)
    if DELETED in df.columns:
        SINK.touch(spark, f"{silver_path.rstrip('/')}/{TOMBSTONES}")
    return _written_rows(spark, silver_path)


def merge_into_silver(new_bronze: DataFrame, silver_path: str) -> list[tuple]:
    """Merge Bronze rows into Silver, rewriting only the months they touch.

    The touched months are those of the new rows and those in which their keys
    already sit (one scan of Silver's key column): a corrected transaction time
    moves a record to another month.  Silver's rows of these months are unioned
    with the new ones, deduplicated (latest ingestion wins) and the months are
    overwritten; a month that lost its last row is removed.  The merge is checkpointed into the cluster's checkpoint folder
    before the overwrite: the plan must not read the files it replaces.
    Replaying the same rows gives the same Silver (idempotent).
    Returns the (year, month) partitions rewritten.
    """
    spark = new_bronze.sparkSession
    new = standardize(split_null_keys(new_bronze)[0])
    existing = read_or_empty(spark, silver_path, new.schema)
    marked = SINK.path_exists(spark, f"{silver_path.rstrip('/')}/{TOMBSTONES}")
    if marked and DELETED not in new.columns:
        new = new.withColumn(DELETED, F.lit(None).cast("boolean"))
        existing = read_or_empty(spark, silver_path, new.schema)
    elif DELETED in new.columns and not marked:  # before the first tombstone is written
        SINK.touch(spark, f"{silver_path.rstrip('/')}/{TOMBSTONES}")
    sitting = existing.select(KEY, *PARTITION_COLS).join(INC.small_keys(new), KEY, "left_semi").select(*PARTITION_COLS)
    touched = new.select(*PARTITION_COLS).union(sitting).distinct()
    months = [tuple(r) for r in touched.limit(MAX_MONTHS + 1).collect()]
    if not months:
        return []
    if len(months) > MAX_MONTHS:
        # Corrupt times can name any month: all months are then rewritten, by a plan that names none.  Their list is
        # bounded by the calendar: 12 months of 9,999 years.
        months = [tuple(r) for r in existing.select(*PARTITION_COLS).union(new.select(*PARTITION_COLS)).distinct().collect()]
        merged = dedupe_latest(existing.select(*new.columns).unionByName(new))
    else:
        merged = dedupe_latest(existing.filter(_months_filter(months)).select(*new.columns).unionByName(new))
    # Rebalanced by month before the checkpoint, so the checkpointed
    # partitions are already the files to write.
    checkpoint_dir(spark)
    merged = merged.hint("rebalance", *PARTITION_COLS).checkpoint(eager=True)
    SINK.write_layer(merged, silver_path, touched_only=True)
    left = {tuple(r) for r in merged.select(*PARTITION_COLS).distinct().collect()}
    SINK.drop_partitions(spark, silver_path, [m for m in months if m not in left])
    return months


# Most months named one by one in a filter.
MAX_MONTHS = 500


def _months_filter(months: list[tuple]):
    cond = None
    for y, m in months:
        c = F.col(PARTITION_COLS[0]).eqNullSafe(F.lit(y)) & F.col(PARTITION_COLS[1]).eqNullSafe(F.lit(m))
        cond = c if cond is None else cond | c
    return cond


def bronze_to_silver_incremental(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    since,
) -> list[tuple]:
    """E1, touched months only: Bronze rows ingested at or after ``since``
    (a pushed-down filter) are merged into Silver (``merge_into_silver``).
    Work grows with the increment and the months it touches, not with the
    whole history.  Returns the (year, month) partitions rewritten."""
    if bronze_path.rstrip("/") == silver_path.rstrip("/"):
        raise ValueError("a layer cannot be rewritten in place")
    since_lit = F.lit(since).cast("timestamp_ntz")
    new_rows = read_with_tombstones(spark, bronze_path, required=SILVER_INPUT).filter(F.col(INC.CURSOR) >= since_lit)
    return merge_into_silver(new_rows, silver_path)


def silver_to_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    as_of=None,
    touched_only: bool = False,
    months: list[tuple[int, int]] | None = None,
) -> int:
    """Silver -> Gold. ``months`` restricts the read to those (year, month)
    partitions (partition pruning) and implies ``touched_only``."""
    if holds_nothing(spark, silver_path):  # nothing was ever ingested
        return 0
    silver = live(read_with_tombstones(spark, silver_path, required=GOLD_INPUT))
    if months and len(months) > MAX_MONTHS:
        months = None  # too many to name: the whole layer
    if months:
        silver = silver.filter(_months_filter(months))
        touched_only = True
    SINK.write_layer(to_gold(silver, as_of=as_of), gold_path, touched_only=touched_only)
    if months:
        left = {tuple(r) for r in silver.select(*PARTITION_COLS).distinct().collect()}
        SINK.drop_partitions(spark, gold_path, [m for m in months if tuple(m) not in left])
    written = spark.read.parquet(gold_path)
    return (written.filter(_months_filter(months)) if months else written).count()


# --- E3, E4: scoring and persistence ------------------------------------------


def inference_batch(
    gold: DataFrame,
    scored_keys: DataFrame,
    model,
    run_ts,
    n: int | None = INC.BATCH_SIZE,
) -> DataFrame:
    """Unscored Gold rows -> scorable ones -> oldest ``n`` -> model -> one run
    timestamp.  Fully distributed; the batch never visits the driver.

    Rows the model cannot score (a NULL feature) are set aside *before* the
    batch is cut: otherwise they would stay "unscored", sit at the head of
    the queue and, run after run, take batch slots until nothing else fits.
    ``unscorable_rows`` reports them.
    """
    ok, _ = ML.split_scorable(INC.unscored(gold, scored_keys))
    batch = INC.next_batch(ok, n)
    return ML.score(ML.select_features(batch), model, run_ts).select(*PREDICTIONS.fieldNames())


def unscorable_rows(gold: DataFrame, scored_keys: DataFrame) -> DataFrame:
    """Unscored rows with a NULL feature, with how many features are missing."""
    _, bad = ML.split_scorable(INC.unscored(gold, scored_keys))
    return bad.select(KEY, "ingestion_timestamp", ML.null_feature_count().alias("null_features"))


def run_inference(
    spark: SparkSession,
    gold_path: str,
    predictions_path: str | None,
    model_path: str,
    batch_root: str,
    batch_id: str,
    run_ts,
    n: int | None = INC.BATCH_SIZE,
    state_path: str | None = None,
    lookback: dt.timedelta = dt.timedelta(hours=1),
    predictions: DataFrame | None = None,
    store=None,
) -> int:
    """Write this run's batch (possibly empty) under ``batch_root``.

    Only keys and times are compared: the scorable Gold rows' keys are
    anti-joined with the scored keys, the batch is cut from them, and the wide
    rows are fetched by its keys.

    With ``state_path`` a run looks only at Gold files written since the mark of
    the last persisted run, less ``lookback`` for clocks that differ between
    writers, and finds the already scored among them by their keys.  The mark is
    the arrival time of the oldest row still waiting (of the newest file, if
    none is), so it selects exactly what a run over all of Gold would: a late
    record arrives in a new file, a rewritten month is looked at again, and a
    batch that was not persisted never moves the mark.

    With ``store`` (a ``KeyStore`` of the predictions) the scored keys are looked up
    there, without scanning or moving those of all batches.
    """
    gold = INC.with_arrival(read_layer(spark, gold_path, required=SCORING_INPUT))
    # A batch id is one unit of work: its selection ignores its own earlier
    # output, so rerunning a batch (after a failure, or by mistake after it
    # completed) selects and writes the same rows instead of new ones.
    this = F.lit(batch_id)
    # ``predictions`` names the scored keys in another store (a database read); the mark needs files.
    if predictions is not None:
        if state_path is not None:
            raise ValueError("a scoring state needs predictions in files")
        preds = predictions
    else:
        preds = BATCHES.read_batches(spark, predictions_path, PREDICTIONS_TABLE).filter(F.col("batch_id") != this)
    mark = None
    if state_path is not None:
        state = read_or_empty(spark, state_path, INC.CURSOR_STATE)
        packed = BATCHES.manifest(spark, predictions_path).covered
        mark = INC.scoring_mark(
            state,
            batch_id,
            lambda b: b in packed or SINK.path_exists(spark, f"{SINK.batch_path(predictions_path, b)}/_SUCCESS"),
        )
        if mark is not None:
            gold = gold.filter(F.col(INC.ARRIVED) >= F.lit(mark) - F.lit(lookback))
    checkpoint_dir(spark)
    ok, _ = ML.split_scorable(gold.filter(F.col(KEY).isNotNull()))
    waiting = ok.select(KEY, INC.CURSOR, INC.ARRIVED)
    if store is not None:
        waiting = store.absent(waiting.checkpoint(eager=True), without=batch_id)
    elif mark is not None:  # a window: its keys are few beside the predictions'
        waiting = INC.absent(waiting, existing_keys(preds))
    else:
        waiting = INC.unscored(waiting, existing_keys(preds))
    waiting = waiting.checkpoint(eager=True)
    batch = waiting
    if n is not None:
        until = INC.batch_cut(waiting, n)
        if until is not None:
            batch = batch.filter(F.col(INC.CURSOR).isNull() | (F.col(INC.CURSOR) <= F.lit(until).cast("timestamp_ntz")))
        batch = INC.next_batch(batch, n)
    batch = batch.select(KEY).checkpoint(eager=True)
    keys = INC.small_keys(batch)
    rows = gold.join(keys, KEY, "left_semi")
    scored = ML.score(ML.select_features(rows), ML.load_model(model_path), run_ts).select(*PREDICTIONS.fieldNames())
    p = SINK.write_batch(scored, batch_root, batch_id)
    count = _written_rows(spark, p)
    if state_path is not None:
        after = waiting.join(keys, KEY, "left_anti").agg(F.min(INC.ARRIVED)).first()[0]
        if after is None:
            after = gold.agg(F.max(INC.ARRIVED)).first()[0] or mark
        (
            spark.createDataFrame([(mark, after, count, batch_id)], INC.CURSOR_STATE)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(state_path)
        )
    return count


def persist_predictions(spark: SparkSession, batch_root: str, batch_id: str, predictions_path: str, store=None) -> int:
    """Append the batch idempotently; rerunning adds nothing.  An empty
    batch is a no-op (checked with ``isEmpty``, one row read at most), unless an
    earlier run of it left rows, which it then replaces."""
    batch = read_or_empty(spark, SINK.batch_path(batch_root, batch_id), PREDICTIONS)
    if batch.isEmpty() and batch_id not in BATCHES.versions(spark, predictions_path):
        return 0
    return INC.append_idempotent(batch, predictions_path, batch_id, store=store)


def compact_predictions(spark: SparkSession, predictions_path: str, target_mb: int = 256) -> int:
    """Pack the table's small batches into files of about ``target_mb`` (``sinks.batches``); the batches packed."""
    return BATCHES.compact(spark, predictions_path, PREDICTIONS_TABLE, target_mb << 20, sort_by=KEY)


def persist_predictions_jdbc(
    spark: SparkSession,
    batch_root: str,
    batch_id: str,
    url: str,
    table: str,
    properties: dict | None = None,
    batchsize: int = SINK.JDBC_BATCH_ROWS,
    **key_read,
) -> int:
    """E4 into a database table: only keys the table lacks are inserted, in
    INSERT batches of ``batchsize`` rows from the executors.  The table's
    keys are read pruned to the key column (pass ``partition_column``,
    ``lower``, ``upper``, ``num_partitions`` to read them in parallel ranges);
    a table that the database does not list counts as empty, every other failure
    propagates.  The rows to insert (at most one batch)
    are checkpointed once into the cluster's checkpoint folder, so counting
    and writing them does not read the table's keys twice.
    Returns the rows inserted."""
    batch = read_or_empty(spark, SINK.batch_path(batch_root, batch_id), PREDICTIONS)
    if batch.isEmpty():
        return 0
    if jdbc_table_exists(spark, url, table, properties):
        keys = read_jdbc(spark, url, table, properties, columns=[KEY], **key_read)
    else:
        keys = spark.createDataFrame([], f"{KEY} string")
    checkpoint_dir(spark)
    new = INC.rows_to_append(batch, keys).checkpoint(eager=True)
    n = new.count()
    if n:
        SINK.write_jdbc(new, url, table, mode="append", properties=properties, batchsize=batchsize)
    return n


# --- E5: training -----------------------------------------------------------------


# The forest is fitted on one partition per so many rows, FIT_PARTITIONS at
# least.  Bagging draws per partition and in row order, so a number that follows
# from the data alone, filled by key and sorted, makes the model a function of the
# data and the seed, on any cluster.
FIT_PARTITIONS, FIT_ROWS = 16, 250_000


def fit_partitions(rows: int) -> int:
    return max(FIT_PARTITIONS, -(-rows // FIT_ROWS))


def fixed_layout(df: DataFrame, partitions: int) -> DataFrame:
    """Rows in ``partitions`` partitions by key, sorted by key in each."""
    return df.repartition(partitions, KEY).sortWithinPartitions(KEY, *[c for c in df.columns if c != KEY])


def split_for_fit(data: DataFrame, partitions: int | None = None) -> DataFrame:
    """The exact split of clean training rows in the layout that the forest is fitted on.

    The forest reads its input several times (metadata, split candidates, binned
    rows) and the hold-out once more: the split is computed once and checkpointed
    into the cluster's checkpoint folder."""
    checkpoint_dir(data.sparkSession)
    # Counted before the split's join: one narrow scan.
    return fixed_layout(ML.stratified_split(data), partitions or fit_partitions(data.count())).checkpoint(eager=True)


def train_model(
    spark: SparkSession,
    gold_path: str,
    model_path: str | None = None,
    balanced: bool = False,
    partitions: int | None = None,
    **forest_args,
) -> dict:
    """Select, clean, split (exact, stratified), fit, evaluate on the hold-out,
    rank features, save.  Returns the fitted model and report frames."""
    gold = read_layer(spark, gold_path, required=TRAINING_INPUT)
    return train_on(gold, model_path, balanced, partitions, **forest_args)


def train_on(
    gold: DataFrame,
    model_path: str | None = None,
    balanced: bool = False,
    partitions: int | None = None,
    **forest_args,
) -> dict:
    """``train_model`` on a Gold frame.  The model does not depend on the number
    of cores or files (see ``FIT_PARTITIONS``)."""
    spark = gold.sparkSession
    data = ML.clean_training(gold.select(KEY, *FEATURES, LABEL))
    split = split_for_fit(data, partitions)
    fit_rows = split.filter(~F.col("is_test")).drop("is_test")
    if balanced:  # off by default, as in the original fit
        fit_rows = ML.with_balanced_weights(fit_rows)
        forest_args = {**forest_args, "weight_col": "class_weight"}
    model = ML.train(fit_rows, **forest_args)
    test = split.filter(F.col("is_test"))
    scored = ML.score(test.select(KEY, *FEATURES), model).join(test.select(KEY, LABEL), KEY)
    if model_path:
        ML.save_model(model, model_path)
    return {
        "model": model,
        "metrics": ML.binary_metrics(scored),
        "report": ML.classification_report(scored),
        "confusion": ML.confusion_matrix(scored),
        "importance": ML.feature_importance(model, spark),
    }


def compare_models(
    spark: SparkSession,
    gold_path: str,
    current_rows,
    candidate_rows,
    replicates: int = 0,
    **forest_args,
) -> DataFrame:
    """Roadmap X6: fit the current and a candidate model on two row ranges
    (column conditions, e.g. two ingestion periods) and score both on one
    shared hold-out, the exact stratified test split of all rows.  Returns
    one metrics row per model; with ``replicates`` a row per metric with the
    interval of the difference (``operators.bootstrap``)."""
    gold = read_layer(spark, gold_path, required=TRAINING_INPUT)
    data = ML.clean_training(gold)
    split = split_for_fit(data)
    train = split.filter(~F.col("is_test"))
    test = split.filter(F.col("is_test"))
    out = None
    for name, cond in (("current", current_rows), ("candidate", candidate_rows)):
        m = ML.train(train.filter(cond).select(*FEATURES, LABEL), **forest_args)
        scored = ML.score(test.select(KEY, *FEATURES), m)
        if replicates:
            row = scored.select(KEY, F.col("fraud_prediction").alias(name))
            out = row.join(test.select(KEY, LABEL), KEY) if out is None else out.join(row, KEY)
        else:
            row = ML.binary_metrics(scored.join(test.select(KEY, LABEL), KEY)).withColumn("model", F.lit(name))
            out = row if out is None else out.unionByName(row)
    return compare_predictions(out, "current", "candidate", b=replicates) if replicates else out


# --- E6: alerts -------------------------------------------------------------------


def alert_batch(predictions: DataFrame, now, threshold: float | None = None, already_alerted: DataFrame | None = None) -> DataFrame:
    return AL.alert_message(AL.alerts(predictions, now, threshold=threshold, already_alerted=already_alerted))


# --- E9, E10, E11: exports and loads ------------------------------------------------


def backup(predictions: DataFrame, out_dir: str) -> None:
    SINK.export(predictions, f"{out_dir.rstrip('/')}/csv", "csv")
    SINK.export(predictions, f"{out_dir.rstrip('/')}/parquet", "parquet")


def historical_load(spark: SparkSession, gold_path: str, url: str, table: str, properties: dict | None = None, **kw) -> None:
    SINK.full_load(read_layer(spark, gold_path), url, table, properties, **kw)


def prepare_raw(
    spark: SparkSession,
    csv_path: str,
    out_path: str,
    rename: dict[str, str] | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """Raw CSV -> drop the index column -> normalised names -> CSV/Parquet.
    Values stay the text they are (times, leading zeros)."""
    df = normalize_columns(drop_if_present(read_raw_csv(spark, csv_path, infer=False), INDEX_COLUMN), rename)
    SINK.export(df, out_path, fmt)
    return df


# --- one scheduled run ---------------------------------------------------------------


def scoring_cycle(
    spark: SparkSession,
    paths: dict[str, str],
    run_ts,
    batch_id: str,
    as_of=None,
    n: int | None = INC.BATCH_SIZE,
    since=None,
) -> dict:
    """One scheduled run, in order: Silver, Gold, score the next batch,
    persist it, select alerts.  ``paths`` names bronze, silver, gold, model,
    batches, predictions and (optional) state and keys (a ``KeyStore``).  With ``since`` the layers are
    refreshed for the touched months only; with a state path scoring runs in
    cursor mode.  Every step is replay-safe, so a failed cycle is rerun with
    the same arguments."""
    if since is None:
        bronze_to_silver(spark, paths["bronze"], paths["silver"])
        silver_to_gold(spark, paths["silver"], paths["gold"], as_of=as_of)
    else:
        months = bronze_to_silver_incremental(spark, paths["bronze"], paths["silver"], since)
        if months:
            silver_to_gold(spark, paths["silver"], paths["gold"], as_of=as_of, months=months)
    store = KeyStore(spark, paths["keys"], paths["predictions"]) if paths.get("keys") else None
    scored = run_inference(
        spark, paths["gold"], paths["predictions"], paths["model"], paths["batches"], batch_id, run_ts, n,
        state_path=paths.get("state"), store=store,
    )
    appended = persist_predictions(spark, paths["batches"], batch_id, paths["predictions"], store=store)
    alert = alert_batch(BATCHES.read_batches(spark, paths["predictions"], PREDICTIONS_TABLE), run_ts).first()
    return {"scored": scored, "appended": appended, "alerts": alert["n_alerts"], "status": alert["status"]}


def run_clock() -> dt.datetime:
    """Wall-clock run time, truncated to the second; callers pass it down."""
    return dt.datetime.now().replace(microsecond=0)
