"""Command line: one job per sub-command, for ``spark-submit`` or ``python -m txnlake``.

    python -m txnlake bronze-to-silver --bronze B --silver S [--since TS]
    python -m txnlake silver-to-gold --silver S --gold G [--as-of DATE]
    python -m txnlake train --gold G --model M
    python -m txnlake infer --gold G --predictions P --model M --batches D --batch-id ID --run-ts TS [--state ST]
    python -m txnlake persist --batches D --batch-id ID --predictions P
    python -m txnlake alerts --predictions P --now TS
    python -m txnlake monitor --predictions P --out DIR [--filter "Fraud Only"]
    python -m txnlake validate --bronze B --silver S --gold G --predictions P
    python -m txnlake backup --predictions P --out DIR
    python -m txnlake prepare-raw --csv F --out DIR
    python -m txnlake cycle --root R --batch-id ID --run-ts TS [--since TS]
    python -m txnlake ingest --source SRC --bronze B [--format parquet|csv] [--lookback-hours H]
    python -m txnlake full-load --gold G --url URL --table T --jdbc-properties FILE.json
    python -m txnlake reset --tables T1,T2
    python -m txnlake quality --bronze B
    python -m txnlake stream-layers --bronze B --silver S --gold G --checkpoint C [--interval "5 minutes"]
    python -m txnlake stream-score --gold G --model M --predictions P --checkpoint C [--interval ...]

JDBC credentials are read from a JSON properties file (user, password,
driver, ...), never from the command line.

Clocks, dates and batch ids are arguments, never read from the machine, so
a rerun with the same arguments writes the same output.  Results that are
reports are printed as JSON lines (they are small aggregates).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys


def _ts(s: str) -> dt.datetime:
    return dt.datetime.fromisoformat(s)


def _rows(s: str) -> int | None:
    return None if s == "all" else int(s)


def _database(a) -> None:
    """Predictions held in a database instead of files."""
    a.add_argument("--url")
    a.add_argument("--table")
    a.add_argument("--jdbc-properties", help="JSON file")
    a.add_argument("--predicate", action="append", help="one of several disjoint conditions, each read by a task")


def _properties(args) -> dict | None:
    if not args.jdbc_properties:
        return None
    with open(args.jdbc_properties) as f:
        return json.load(f)


def _predictions(spark, args):
    """The predictions a command reads: of the database if ``--url`` names one, else of the files."""
    from txnlake.schemas import PREDICTIONS_TABLE
    from txnlake.sinks.batches import read_batches
    from txnlake.sources.layers import read_jdbc

    if not args.url:
        return read_batches(spark, args.predictions, PREDICTIONS_TABLE)
    return read_jdbc(spark, args.url, args.table, _properties(args), predicates=args.predicate)


def _store(spark, args):
    from txnlake.operators.keystore import KeyStore

    return KeyStore(spark, args.keys, args.predictions) if args.keys and not args.url else None


def _print_rows(df) -> None:
    for r in df.collect():
        print(json.dumps(r.asDict(recursive=True), default=str))


def main(argv: list[str] | None = None, spark=None) -> int:
    from txnlake.plans import jobs
    from txnlake.session import BASE_CONF, scale_conf

    p = argparse.ArgumentParser(prog="txnlake")
    p.add_argument("--input-gb", type=float, help="size of the input: sets the shuffle's partitions (scale_conf)")
    sub = p.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("bronze-to-silver")
    a.add_argument("--bronze", required=True)
    a.add_argument("--silver", required=True)
    a.add_argument("--since", type=_ts)
    a = sub.add_parser("silver-to-gold")
    a.add_argument("--silver", required=True)
    a.add_argument("--gold", required=True)
    a.add_argument("--as-of")
    a = sub.add_parser("train")
    a.add_argument("--gold", required=True)
    a.add_argument("--model", required=True)
    a.add_argument("--balanced", action="store_true", help="weight classes equally (off by default)")
    a = sub.add_parser("infer")
    _database(a)
    for k in ("gold", "model", "batches", "batch-id"):
        a.add_argument(f"--{k}", required=True)
    a.add_argument("--predictions")
    a.add_argument("--run-ts", type=_ts, required=True)
    a.add_argument("--state")
    a.add_argument("--keys", help="a key store of the predictions")
    a.add_argument("--n", type=_rows, default=5000, help="rows to score, or all")
    a = sub.add_parser("persist")
    _database(a)
    for k in ("batches", "batch-id"):
        a.add_argument(f"--{k}", required=True)
    a.add_argument("--predictions")
    a.add_argument("--keys", help="a key store of the predictions")
    a = sub.add_parser("alerts")
    _database(a)
    a.add_argument("--predictions")
    a.add_argument("--now", type=_ts, required=True)
    a.add_argument("--threshold", type=float)
    a = sub.add_parser("monitor")
    _database(a)
    a.add_argument("--predictions")
    a.add_argument("--out", required=True)
    a.add_argument("--filter", default="All")
    a = sub.add_parser("validate")
    for k in ("bronze", "silver", "gold", "predictions"):
        a.add_argument(f"--{k}", required=True)
    a.set_defaults(url=None)
    a.add_argument("--approx", action="store_true", help="HyperLogLog distinct counts (no key shuffle)")
    a.add_argument("--batch", help="a written batch: report rows per layer and its size too")
    a = sub.add_parser("reconcile", help="keys whose content differs between two Parquet tables")
    a.add_argument("--source", required=True)
    a.add_argument("--target", required=True)
    a.add_argument("--key", default="trans_num")
    a.add_argument("--out", help="write the differing keys there")
    a = sub.add_parser("ingest-snapshot", help="append inserts, edits and tombstones of a full snapshot to Bronze")
    a.add_argument("--snapshot", required=True)
    a.add_argument("--bronze", required=True)
    a.add_argument("--at", type=_ts, required=True)
    a = sub.add_parser("compact", help="pack small prediction batches; --vacuum-days frees what older readers may still read")
    a.add_argument("--predictions", required=True)
    a.add_argument("--target-mb", type=int, default=256)
    a.add_argument("--vacuum-days", type=float)
    a = sub.add_parser("refresh-keys", help="fold new batches into the key store")
    a.add_argument("--predictions", required=True)
    a.add_argument("--keys", required=True)
    a = sub.add_parser("refresh-panels", help="bring the panels' partial states up to date and write the panels")
    a.add_argument("--predictions", required=True)
    a.add_argument("--state", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--filter", default="All")
    a = sub.add_parser("backup")
    _database(a)
    a.add_argument("--predictions")
    a.add_argument("--out", required=True)
    a = sub.add_parser("prepare-raw")
    a.add_argument("--csv", required=True)
    a.add_argument("--out", required=True)
    a = sub.add_parser("cycle")
    a.add_argument("--root", required=True)
    a.add_argument("--batch-id", required=True)
    a.add_argument("--run-ts", type=_ts, required=True)
    a.add_argument("--since", type=_ts)
    a.add_argument("--as-of")
    a.add_argument("--n", type=_rows, default=5000, help="rows to score, or all")
    a.add_argument("--keys", help="a key store of the predictions")
    a = sub.add_parser("ingest")
    a.add_argument("--source", required=True)
    a.add_argument("--bronze", required=True)
    a.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    a.add_argument("--lookback-hours", type=float, default=1.0)
    a = sub.add_parser("full-load")
    a.add_argument("--gold", required=True)
    a.add_argument("--url", required=True)
    a.add_argument("--table", required=True)
    a.add_argument("--jdbc-properties", required=True)
    a = sub.add_parser("reset")
    a.add_argument("--tables", required=True)
    a = sub.add_parser("quality")
    a.add_argument("--bronze", required=True)
    a = sub.add_parser("stream-layers")
    for k in ("bronze", "silver", "gold", "checkpoint"):
        a.add_argument(f"--{k}", required=True)
    a.add_argument("--as-of")
    a.add_argument("--interval", help="processing-time trigger; default: process what is there and stop")
    a.add_argument("--max-files", type=int)
    a = sub.add_parser("stream-score")
    for k in ("gold", "model", "predictions", "checkpoint"):
        a.add_argument(f"--{k}", required=True)
    a.add_argument("--interval")
    a.add_argument("--max-files", type=int)
    args = p.parse_args(argv)

    if spark is None:
        from pyspark.sql import SparkSession

        b = SparkSession.builder.appName(f"txnlake-{args.cmd}")
        sized = scale_conf(int(args.input_gb * 2**30)) if args.input_gb else {}
        for k, v in (BASE_CONF | sized).items():
            b = b.config(k, v)
        spark = b.getOrCreate()

    c = args.cmd
    if c == "bronze-to-silver":
        if args.since:
            out = jobs.bronze_to_silver_incremental(spark, args.bronze, args.silver, args.since)
        else:
            out = jobs.bronze_to_silver(spark, args.bronze, args.silver)
        print(json.dumps({"result": out}, default=str))
    elif c == "silver-to-gold":
        print(json.dumps({"rows": jobs.silver_to_gold(spark, args.silver, args.gold, as_of=args.as_of)}))
    elif c == "train":
        r = jobs.train_model(spark, args.gold, args.model, balanced=args.balanced)
        _print_rows(r["metrics"])
        _print_rows(r["importance"])
    elif c == "infer":
        n = jobs.run_inference(
            spark, args.gold, args.predictions, args.model, args.batches, args.batch_id, args.run_ts, args.n,
            state_path=args.state, predictions=_predictions(spark, args) if args.url else None,
            store=_store(spark, args),
        )
        print(json.dumps({"scored": n}))
    elif c == "persist":
        if args.url:
            n = jobs.persist_predictions_jdbc(
                spark, args.batches, args.batch_id, args.url, args.table, _properties(args), predicates=args.predicate
            )
        else:
            n = jobs.persist_predictions(spark, args.batches, args.batch_id, args.predictions, store=_store(spark, args))
        print(json.dumps({"appended": n}))
    elif c == "alerts":
        _print_rows(jobs.alert_batch(_predictions(spark, args), args.now, threshold=args.threshold))
    elif c == "monitor":
        from txnlake.operators.monitoring import monitoring

        for name, df in monitoring(_predictions(spark, args), args.filter).items():
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        print(json.dumps({"panels": args.out}))
    elif c == "validate":
        from txnlake.operators.validation import validate_layers, validation_report

        layers = {k: spark.read.parquet(getattr(args, k)) for k in ("bronze", "silver", "gold")}
        layers["predictions"] = _predictions(spark, args)
        _print_rows(validation_report(layers, approx=args.approx))
        if args.batch:
            _print_rows(validate_layers(layers, spark.read.parquet(args.batch)))
    elif c == "reconcile":
        from txnlake.operators.reconcile import reconcile, summary

        found = reconcile(spark.read.parquet(args.source), spark.read.parquet(args.target), args.key)
        if args.out:
            found.write.mode("overwrite").parquet(args.out)
            found = spark.read.parquet(args.out)
        _print_rows(summary(found))
    elif c == "ingest-snapshot":
        print(json.dumps(jobs.ingest_snapshot(spark, spark.read.parquet(args.snapshot), args.bronze, args.at)))
    elif c == "compact":
        out = {"packed": jobs.compact_predictions(spark, args.predictions, args.target_mb)}
        if args.vacuum_days is not None:
            from txnlake.sinks.batches import vacuum

            out["removed"] = vacuum(spark, args.predictions, args.vacuum_days * 86_400)
        print(json.dumps(out))
    elif c == "refresh-keys":
        from txnlake.operators.keystore import KeyStore

        print(json.dumps({"keys": KeyStore(spark, args.keys, args.predictions).refresh()}))
    elif c == "refresh-panels":
        from txnlake.operators.panel_state import PanelState

        state = PanelState(spark, args.state, args.predictions, args.filter)
        print(json.dumps(state.refresh()))
        for name, df in state.panels().items():
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
    elif c == "backup":
        jobs.backup(_predictions(spark, args), args.out)
    elif c == "prepare-raw":
        jobs.prepare_raw(spark, args.csv, args.out)
    elif c == "ingest":
        from txnlake.sources.layers import read_raw_csv

        src = read_raw_csv(spark, args.source) if args.format == "csv" else spark.read.parquet(args.source)
        n = jobs.ingest_to_bronze(spark, src, args.bronze, lookback=dt.timedelta(hours=args.lookback_hours))
        print(json.dumps({"appended": n}))
    elif c == "full-load":
        with open(args.jdbc_properties) as f:
            props = json.load(f)
        jobs.historical_load(spark, args.gold, args.url, args.table, props)
        print(json.dumps({"loaded": args.table}))
    elif c == "reset":
        from txnlake.sinks.layers import reset_tables

        names = [t.strip() for t in args.tables.split(",") if t.strip()]
        reset_tables(spark, names)
        print(json.dumps({"dropped": names}))
    elif c == "quality":
        from txnlake.operators.silver import silver_quality

        _print_rows(silver_quality(spark.read.parquet(args.bronze)))
    elif c in ("stream-layers", "stream-score"):
        from txnlake.streaming import layers as S

        if c == "stream-layers":
            src = S.bronze_stream(spark, args.bronze, max_files_per_trigger=args.max_files)
            q = S.start_silver_gold(
                src, args.silver, args.gold, args.checkpoint, as_of=args.as_of,
                available_now=args.interval is None, interval=args.interval,
            )
        else:
            from txnlake.operators.ml import load_model

            src = S.bronze_stream(spark, args.gold, max_files_per_trigger=args.max_files)
            q = S.start_scoring(
                src, load_model(args.model), args.predictions, args.checkpoint,
                available_now=args.interval is None, interval=args.interval,
            )
        q.awaitTermination()
        print(json.dumps({"stream": c, "batches": q.lastProgress["batchId"] + 1 if q.lastProgress else 0}))
    elif c == "cycle":
        r = args.root.rstrip("/")
        paths = {k: f"{r}/{k}" for k in ("bronze", "silver", "gold", "model", "batches", "predictions", "state")}
        if args.keys:
            paths["keys"] = args.keys
        out = jobs.scoring_cycle(spark, paths, args.run_ts, args.batch_id, as_of=args.as_of, n=args.n, since=args.since)
        print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
