"""The command line drives the jobs end to end, and a cycle reruns safely."""

import datetime as dt
import json

from txnlake.__main__ import main
from txnlake.plans.fixtures import bronze_from_events, load_table

SF = "/root/testdata/sf0.001"


def test_cycle_from_the_command_line(spark, scratch, capsys):
    root = f"{scratch}/lake"
    bronze_from_events(load_table(spark, SF, "events")).write.parquet(f"{root}/bronze")
    main(["bronze-to-silver", "--bronze", f"{root}/bronze", "--silver", f"{root}/silver"], spark)
    main(["silver-to-gold", "--silver", f"{root}/silver", "--gold", f"{root}/gold", "--as-of", "2024-02-01"], spark)
    from txnlake.operators import ml as ML
    from txnlake.schemas import FEATURES, LABEL

    gold = spark.read.parquet(f"{root}/gold")
    ML.save_model(ML.train(ML.clean_training(gold.select(*FEATURES, LABEL)), num_trees=5, max_depth=3), f"{root}/model")
    capsys.readouterr()
    ts = "2024-02-01T12:00:00"
    main(["cycle", "--root", root, "--batch-id", "c1", "--run-ts", ts, "--as-of", "2024-02-01"], spark)
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["scored"] == first["appended"] > 0
    main(["cycle", "--root", root, "--batch-id", "c1", "--run-ts", ts, "--as-of", "2024-02-01"], spark)
    again = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    p = spark.read.parquet(f"{root}/predictions")
    assert p.count() == p.select("trans_num").distinct().count() == first["scored"]
    assert again["alerts"] == first["alerts"]
    main(["monitor", "--predictions", f"{root}/predictions", "--out", f"{scratch}/panels"], spark)
    assert spark.read.parquet(f"{scratch}/panels/kpis").first()["total_transactions"] == first["scored"]
    main(["validate", "--bronze", f"{root}/bronze", "--silver", f"{root}/silver", "--gold", f"{root}/gold",
          "--predictions", f"{root}/predictions"], spark)
    rows = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines() if x.startswith("{")]
    assert {r["layer"]: r["passed"] for r in rows if "layer" in r} == {
        "bronze": True, "silver": True, "gold": True, "predictions": True
    }
    _ = dt


def test_ingest_full_load_and_reset_from_the_command_line(spark, scratch, capsys):
    from txnlake.sources.layers import read_jdbc

    src = bronze_from_events(load_table(spark, SF, "events"))
    src.write.parquet(f"{scratch}/source")
    capsys.readouterr()
    main(["ingest", "--source", f"{scratch}/source", "--bronze", f"{scratch}/bronze"], spark)
    main(["ingest", "--source", f"{scratch}/source", "--bronze", f"{scratch}/bronze"], spark)
    out = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert out == [{"appended": 1050}, {"appended": 0}]
    props = f"{scratch}/jdbc.json"
    with open(props, "w") as f:
        json.dump({"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}, f)
    url = "jdbc:derby:memory:txnlake_cli;create=true"
    main(["full-load", "--gold", f"{scratch}/bronze", "--url", url, "--table", "HISTORY_LOAD", "--jdbc-properties", props], spark)
    assert read_jdbc(spark, url, "HISTORY_LOAD", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}).count() == 1050
    main(["quality", "--bronze", f"{scratch}/bronze"], spark)
    q = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (q["bronze_rows"], q["duplicate_rows"], q["bad_timestamps"]) == (1050, 50, 10)
    spark.range(2).write.saveAsTable("txnlake_cli_tmp")
    main(["reset", "--tables", "txnlake_cli_tmp"], spark)
    assert not spark.catalog.tableExists("txnlake_cli_tmp")


def test_remaining_commands(spark, scratch, capsys):
    from txnlake.operators import ml as ML
    from txnlake.operators.gold import to_gold
    from txnlake.operators.silver import to_silver
    from txnlake.schemas import FEATURES, LABEL
    from txnlake.plans.fixtures import predictions_from_gold

    gold = to_gold(to_silver(bronze_from_events(load_table(spark, SF, "events"))), as_of="2024-02-01")
    gold.write.parquet(f"{scratch}/gold")
    ML.save_model(ML.train(ML.clean_training(gold.select(*FEATURES, LABEL)), num_trees=3, max_depth=2), f"{scratch}/m")
    args = ["--gold", f"{scratch}/gold", "--predictions", f"{scratch}/p", "--model", f"{scratch}/m",
            "--batches", f"{scratch}/b", "--run-ts", "2024-02-01T00:00:00", "--state", f"{scratch}/st", "--n", "300"]
    capsys.readouterr()
    main(["infer", *args, "--batch-id", "r1"], spark)
    main(["persist", "--batches", f"{scratch}/b", "--batch-id", "r1", "--predictions", f"{scratch}/p"], spark)
    main(["infer", *args, "--batch-id", "r2"], spark)
    main(["persist", "--batches", f"{scratch}/b", "--batch-id", "r2", "--predictions", f"{scratch}/p"], spark)
    lines = [json.loads(x) for x in capsys.readouterr().out.strip().splitlines()]
    assert [list(x.values())[0] for x in lines] == [300, 300, 300, 300]
    predictions_from_gold(gold).write.parquet(f"{scratch}/fixture_preds")
    main(["alerts", "--predictions", f"{scratch}/fixture_preds", "--now", "2024-01-31T00:00:00"], spark)
    alert = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert alert["n_alerts"] == 10 and alert["message"].count("Transaction: ") == 10
    main(["backup", "--predictions", f"{scratch}/p", "--out", f"{scratch}/bk"], spark)
    assert spark.read.parquet(f"{scratch}/bk/parquet").count() == 600
    with open(f"{scratch}/raw.csv", "w") as f:
        f.write("Unnamed: 0,Trans Num\n0,a\n")
    main(["prepare-raw", "--csv", f"{scratch}/raw.csv", "--out", f"{scratch}/clean"], spark)
    assert spark.read.option("header", True).csv(f"{scratch}/clean").columns == ["trans_num"]


def test_stream_commands(spark, scratch, capsys):
    from txnlake.operators import ml as ML
    from txnlake.schemas import FEATURES, LABEL

    bronze_from_events(load_table(spark, SF, "events")).write.parquet(f"{scratch}/bronze")
    main(["stream-layers", "--bronze", f"{scratch}/bronze", "--silver", f"{scratch}/silver", "--gold",
          f"{scratch}/gold", "--checkpoint", f"{scratch}/c1", "--as-of", "2024-02-01"], spark)
    gold = spark.read.parquet(f"{scratch}/gold")
    assert gold.count() == 1000
    ML.save_model(ML.train(ML.clean_training(gold.select(*FEATURES, LABEL)), num_trees=3, max_depth=2), f"{scratch}/m")
    main(["stream-score", "--gold", f"{scratch}/gold", "--model", f"{scratch}/m", "--predictions",
          f"{scratch}/p", "--checkpoint", f"{scratch}/c2"], spark)
    p = spark.read.parquet(f"{scratch}/p")
    assert p.count() == p.select("trans_num").distinct().count() == ML.split_scorable(gold)[0].count()


def test_predictions_in_a_database(spark, scratch, capsys):
    """Score, persist and read alerts with the predictions in a database of this process."""
    import json

    from txnlake.plans import jobs
    from txnlake.plans.fixtures import AS_OF, bronze_from_events, load_table

    bronze_from_events(load_table(spark, SF, "events")).write.parquet(f"{scratch}/bronze")
    jobs.bronze_to_silver(spark, f"{scratch}/bronze", f"{scratch}/silver")
    jobs.silver_to_gold(spark, f"{scratch}/silver", f"{scratch}/gold", as_of=AS_OF)
    jobs.train_model(spark, f"{scratch}/gold", f"{scratch}/model", num_trees=3, max_depth=3)
    url = f"jdbc:derby:{scratch}/db;create=true"
    base = ["--gold", f"{scratch}/gold", "--model", f"{scratch}/model", "--batches", f"{scratch}/b", "--run-ts", "2024-02-01T00:00:00"]
    half = "CAST(\"trans_num\" AS VARCHAR(50)) < '5'"  # this database stores Spark's strings as CLOB
    halves = ["--predicate", half, "--predicate", f"NOT ({half})"]
    db = ["--url", url, "--table", "predictions"]
    main(["infer", *base, "--batch-id", "one", "--predictions", f"{scratch}/none", "--n", "300"], spark=spark)
    main(["persist", "--batches", f"{scratch}/b", "--batch-id", "one", *db], spark=spark)
    main(["infer", *base, "--batch-id", "two", *db, *halves, "--n", "all"], spark=spark)
    main(["persist", "--batches", f"{scratch}/b", "--batch-id", "two", *db, *halves], spark=spark)
    main(["alerts", "--now", "2024-02-01T00:00:00", *db], spark=spark)
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert out[0]["scored"] == out[1]["appended"] == 300
    assert out[2]["scored"] == out[3]["appended"] > 600
    rows = spark.read.jdbc(url, "predictions")
    assert rows.count() == rows.select("trans_num").distinct().count() == 300 + out[3]["appended"]


def test_tables_kept_by_state(spark, scratch, capsys):
    """Compaction, key store, panels, reconciliation and a snapshot from the command line."""
    import json

    from pyspark.sql import functions as F

    from txnlake.plans.fixtures import bronze_from_events, fixture_layers, load_table

    p = fixture_layers(spark, SF)["predictions"]
    k = F.col("trans_num").cast("long")
    for i in range(3):
        p.filter(k % 3 == i).write.parquet(f"{scratch}/p/batch_id=b{i}")
    main(["refresh-keys", "--predictions", f"{scratch}/p", "--keys", f"{scratch}/k"], spark)
    main(["refresh-panels", "--predictions", f"{scratch}/p", "--state", f"{scratch}/s", "--out", f"{scratch}/panels"], spark)
    main(["compact", "--predictions", f"{scratch}/p", "--vacuum-days", "1"], spark)
    spark.read.parquet(f"{scratch}/p/batch_id=b1").withColumn("amt", F.col("amt") + 1).write.parquet(f"{scratch}/edited")
    main(["reconcile", "--source", f"{scratch}/p/batch_id=b1", "--target", f"{scratch}/edited", "--out", f"{scratch}/found"], spark)
    bronze = bronze_from_events(load_table(spark, SF, "events"))
    bronze.write.parquet(f"{scratch}/bronze")
    bronze.filter(k >= 100).write.parquet(f"{scratch}/snapshot")
    main(["ingest-snapshot", "--snapshot", f"{scratch}/snapshot", "--bronze", f"{scratch}/bronze", "--at", "2024-03-01T00:00:00"], spark)
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    n = spark.read.parquet(f"{scratch}/edited").filter("amt is not null").count()
    assert out == [
        {"keys": 1000},
        {"batches": 3, "binned": 3},
        {"packed": 3, "removed": 0},
        {"missing": 0, "extra": 0, "differs": n, "passed": False},
        {"delete": bronze.filter(k < 100).select("trans_num").distinct().count()},
    ]
    assert spark.read.parquet(f"{scratch}/panels/kpis").first()["total_transactions"] == 1000
    assert {r["changed"] for r in spark.read.parquet(f"{scratch}/found").collect()} == {"amt"}
