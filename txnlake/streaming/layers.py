"""

The same operators as the batch jobs, driven by Structured Streaming: a
file-source stream over Bronze, ``foreachBatch`` into idempotent sinks, and a
checkpoint location that records which input files each micro-batch took.
A restarted query replays an unfinished micro-batch with the same id and the
same files; every sink below rewrites the same partitions for it, so a
replay never duplicates rows.  ``trigger(availableNow=True)`` processes what
has arrived and stops: scheduled incremental runs without a long-lived job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from txnlake.operators.incremental import ARRIVED, CURSOR, append_idempotent, with_arrival
from txnlake.operators.silver import latest_row
from txnlake.schemas import KEY
from txnlake.session import checkpoint_dir


def bronze_stream(
    spark: SparkSession,
    bronze_path: str,
    schema: T.StructType | None = None,
    max_files_per_trigger: int | None = None,
    arrival: bool = False,
) -> DataFrame:
    """Stream of Bronze rows as Parquet files land (a file source needs a
    schema up front; by default it is taken from the files present).  ``arrival``
    adds the time at which each row's file was written."""
    schema = schema or spark.read.parquet(bronze_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(bronze_path)
    return with_arrival(rows) if arrival else rows


def _trigger(writer, available_now: bool, interval: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval or "1 minute")


def start_silver_gold(
    stream: DataFrame,
    silver_path: str,
    gold_path: str,
    checkpoint_location: str,
    as_of=None,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """Each micro-batch is merged into Silver (touched months only, latest
    ingestion wins) and the same months of Gold are rebuilt."""
    from txnlake.plans.jobs import merge_into_silver, silver_to_gold

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        months = merge_into_silver(batch, silver_path)
        if months:
            silver_to_gold(batch.sparkSession, silver_path, gold_path, as_of=as_of, months=months)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    return _trigger(w, available_now, interval).start()


def dedupe_stream(stream: DataFrame, key: str = KEY, event_time: str = CURSOR, watermark: str = "1 day") -> DataFrame:
    """Drop repeats of a key arriving within ``watermark`` of each other
    (state kept per key, evicted after the watermark passes): the *first* copy
    stays, for feeds whose copies are equal.  ``latest_stream`` keeps the latest.
    The event time is cast to TIMESTAMP: watermarks reject TIMESTAMP_NTZ."""
    return (
        stream.filter(F.col(key).isNotNull())
        .withColumn("_event_time", F.col(event_time).cast("timestamp"))
        .withWatermark("_event_time", watermark)
        .dropDuplicatesWithinWatermark([key])
        .drop("_event_time")
    )


def latest_stream(
    stream: DataFrame,
    key: str = KEY,
    order: str = CURSOR,
    arrival: str = ARRIVED,
    window: str = "1 hour",
    watermark: str = "1 hour",
) -> DataFrame:
    """Each key's latest copy, as a stateful aggregation for update mode.

    The state holds a key's latest row (by ``order``; the batch rule of
    ``dedupe_latest``) per window of *arrival* time, and is evicted when the
    watermark passes the window.  Arrival (``bronze_stream(with_arrival=True)``) is
    the clock, not the record's own time: a record may be late by any amount and
    still arrives now, so the watermark drops no late copy and the state is
    bounded by the keys that arrive within a window and the watermark.  Copies that
    arrive in different windows come out once each; the sink must keep the latest,
    as the merge into Silver does.
    """
    row = stream.drop(arrival)
    latest = latest_row(row, key, order).alias("_row")
    return (
        stream.filter(F.col(key).isNotNull())
        .withColumn("_at", F.col(arrival).cast("timestamp"))
        .withWatermark("_at", watermark)
        .groupBy(F.window("_at", window), key)
        .agg(latest)
        .select(key, "_row.*")
        .select(*row.columns)
    )


def start_latest_merge(
    stream: DataFrame,
    silver_path: str,
    checkpoint_location: str,
    gold_path: str | None = None,
    as_of=None,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """X2 sink: the updated keys of each micro-batch (``latest_stream``) are merged into
    Silver, and the touched months of Gold rebuilt.  A copy that is older than the
    stored one changes nothing, and a replayed micro-batch merges the same rows again."""
    from txnlake.plans.jobs import merge_into_silver, silver_to_gold

    checkpoint_dir(stream.sparkSession)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # Read several times by the merge: the state is updated once.
        batch = batch.checkpoint(eager=True)
        months = merge_into_silver(batch, silver_path)
        if months and gold_path:
            silver_to_gold(batch.sparkSession, silver_path, gold_path, as_of=as_of, months=months)

    w = stream.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    return _trigger(w, available_now, interval).start()


def start_idempotent_append(
    stream: DataFrame,
    target_path: str,
    checkpoint_location: str,
    key: str = KEY,
    available_now: bool = True,
    interval: str | None = None,
) -> StreamingQuery:
    """X2 sink: each micro-batch goes through the idempotent append under
    ``batch_id=mb<id>``; keys already in the target are skipped, and a
    replayed micro-batch replaces its own directory."""

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        append_idempotent(batch, target_path, f"mb{batch_id:012d}", key)

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    return _trigger(w, available_now, interval).start()


def start_scoring(
    stream: DataFrame,
    model,
    predictions_path: str,
    checkpoint_location: str,
    available_now: bool = True,
    interval: str | None = None,
    key: str = KEY,
) -> StreamingQuery:
    """Continuous E3 + E4: every micro-batch of new Gold rows is split into
    scorable rows (the rest are left for the quality report), scored on the
    executors, stamped with the time that Spark logged for the micro-batch (a
    replay reads the same time from the checkpoint), and appended through the
    idempotent sink under ``batch_id=s<id>``.  Pace it with
    ``maxFilesPerTrigger`` on the source rather than a row limit.  A replayed
    micro-batch rescores the same keys and replaces its own directory."""
    from txnlake.operators import ml as ML
    from txnlake.schemas import PREDICTIONS

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        first = batch.select("_run").first()
        ok, _ = ML.split_scorable(batch.filter(F.col(key).isNotNull()))
        scored = ML.score(ML.select_features(ok), model, first["_run"] if first else None)
        append_idempotent(scored.select(*PREDICTIONS.fieldNames()), predictions_path, f"s{batch_id:012d}", key)

    # In a streaming plan this is the micro-batch's logged time, not the clock of a retry.
    timed = stream.withColumn("_run", F.current_timestamp().cast("timestamp_ntz"))
    w = timed.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint_location)
    return _trigger(w, available_now, interval).start()
