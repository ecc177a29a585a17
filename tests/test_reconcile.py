"""Digest trees, reconciliation and snapshot changes against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from txnlake.operators import changes as CH
from txnlake.operators import reconcile as R
from txnlake.operators.gold import to_gold
from txnlake.operators.silver import to_silver
from txnlake.plans import jobs
from txnlake.plans.fixtures import AS_OF, bronze_from_events, load_table
from txnlake.session import checkpoint_dir

SF = "/root/testdata/sf0.001"
SCHEMA = "trans_num string, a int, b double, c string"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def brute(source, target):
    out = {}
    for key in {r[0] for r in source + target}:
        s, t = (sorted((r[1:] for r in rows if r[0] == key), key=str) for rows in (source, target))
        if s != t:
            changed = None
            if s and t:
                changed = "rows" if len(s) != len(t) else ",".join(n for i, n in enumerate("abc") if sorted((r[i] for r in s), key=str) != sorted((r[i] for r in t), key=str))
            out[key] = ("differs" if s and t else "missing" if s else "extra", changed, len(s), len(t))
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len({r[0] for r in rows})
    return {r[0]: r[1:] for r in rows}


def rows_of(n, seed):
    rng = random.Random(seed)
    return [(f"k{i}", rng.choice([None, 1, 2]), rng.choice([None, 0.5, float("inf")]), rng.choice([None, "", "x"])) for i in range(n)]


@pytest.mark.parametrize("bits", [4, 12])
def test_reconcile_equals_brute_force(spark, bits):
    source = rows_of(300, 1) + [("dup", 1, 1.0, "x")] * 3 + [(None, 1, None, None), (None, 2, None, None)]
    target = [r for r in source if r[0] != "k7"]
    target[11] = (target[11][0], 99, target[11][2], target[11][3])
    target[12] = (target[12][0], None, None, "changed")
    target += [("new", 1, 1.0, None), ("dup", 1, 1.0, "x")]
    target.remove((None, 2, None, None))
    got = found(R.reconcile(table(spark, source), table(spark, target), bits=bits))
    assert got == brute(source, target) and len(got) == 6


def test_values_that_only_change_places(spark):
    """NULLs that move between columns, and values that swap rows, are differences; the order of rows is none."""
    source = [("p", 1, None, "x"), ("q", None, 1.0, "x"), ("r", 1, 2.0, None), ("s", 1, 2.0, "y")]
    target = [("q", 1, None, "x"), ("p", None, 1.0, "x"), ("r", 1, 2.0, "y"), ("s", 1, 2.0, None)]
    assert found(R.reconcile(table(spark, source), table(spark, target))) == brute(source, target)
    assert found(R.reconcile(table(spark, source), table(spark, source[::-1]))) == {}


def test_empty_sides(spark):
    none, some = table(spark, []), table(spark, rows_of(5, 2))
    assert found(R.reconcile(none, none)) == {}
    assert {v[0] for v in found(R.reconcile(some, none)).values()} == {"missing"}
    assert {v[0] for v in found(R.reconcile(none, some)).values()} == {"extra"}
    assert R.summary(R.reconcile(some, none)).first().asDict() == {"missing": 5, "extra": 0, "differs": 0, "passed": False}


def test_tables_that_cannot_be_compared(spark):
    a = table(spark, rows_of(3, 3))
    with pytest.raises(ValueError, match="one table only"):
        R.reconcile(a, a.drop("b"))
    with pytest.raises(ValueError, match="can't be compared"):
        R.reconcile(a, a.withColumn("a", F.col("a").cast("long")))


def test_only_differing_leaves_are_read_below_the_root(spark):
    """One edit: a path of one node a level; the rows of its leaf alone are compared."""
    rows = rows_of(4000, 4)
    edited = [(r[0], 50, r[2], r[3]) if r[0] == "k1234" else r for r in rows]
    a, b = table(spark, rows), table(spark, edited)
    columns = R.compared_columns(a, b, "trans_num")
    trees = [R.digest_tree(x, "trans_num", columns, 12) for x in (a, b)]
    leaves = R.differing_leaves(*trees, 12)
    assert leaves.count() == 1
    some, _ = R.suspects(a, b, "trans_num", columns, 12)
    assert some.count() == a.filter(R.leaf("trans_num", 12) == leaves.first()["node"]).count() < 20
    # levels sum up to the same root, whatever the number of leaves
    for tree in trees:
        assert tree.filter("level = 0").count() == 1 and tree.groupBy("level").agg(F.sum("rows").alias("n")).select("n").distinct().count() == 1
    roots = [R.digest_tree(a, "trans_num", columns, bits).filter("level = 0").select(R.DIGESTS).first() for bits in (4, 8, 12)]
    assert len(set(roots)) == 1
    assert R.differing_leaves(trees[0], R.digest_tree(a.repartition(7), "trans_num", columns, 12), 12).count() == 0


def test_no_row_is_shuffled_to_tell_equal_tables(spark, scratch):
    table(spark, rows_of(100, 5)).write.parquet(f"{scratch}/t")
    t = spark.read.parquet(f"{scratch}/t")
    plan = R.leaf_digests(t, "trans_num", ["a", "b", "c"], 8)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "partial_bit_xor" in plan and plan.count("Exchange") == 1
    leaves = R.leaf_digests(t, "trans_num", ["a", "b", "c"], 8).select("node").limit(3)
    plan = R.rows_of_leaves(t, leaves.cache(), "trans_num", 8)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_tree_grows_with_the_table():
    assert [R.tree_bits(n) for n in (0, 1, 4096, 4097, 65_536, 65_537, 10**7, 10**12)] == [4, 4, 4, 4, 4, 8, 12, 24]


def test_verify_load_into_a_database(spark, scratch):
    """A full load into a database of this process, then one row edited there."""
    gold = to_gold(to_silver(bronze_from_events(load_table(spark, SF, "events"))), as_of=AS_OF)
    gold = gold.select("trans_num", "cc_num", "amt", "lat", "customer_age", "trans_date_trans_time")
    gold.write.parquet(f"{scratch}/gold")
    url = f"jdbc:derby:{scratch}/db;create=true"
    jobs.historical_load(spark, f"{scratch}/gold", url, "loaded")
    gold = spark.read.parquet(f"{scratch}/gold")

    def loaded():
        rows = spark.read.option("preferTimestampNTZ", True).jdbc(url, "loaded")
        return rows.select([F.col(f.name).cast(f.dataType) for f in gold.schema.fields])

    assert jobs.verify_load(gold, loaded())["passed"]
    connection = spark._jvm.java.sql.DriverManager.getConnection(url)
    connection.createStatement().executeUpdate('UPDATE loaded SET "amt" = -1 WHERE "cc_num" = (SELECT MIN("cc_num") FROM loaded)')
    connection.close()
    first = gold.agg(F.min("cc_num")).first()[0]
    assert jobs.verify_load(gold, loaded()) == {"missing": 0, "extra": 0, "differs": gold.filter(F.col("cc_num") == first).count(), "passed": False}


# --- snapshots -----------------------------------------------------------------------------
AT = [dt.datetime(2024, 3, d) for d in range(1, 8)]


def edit(rows, step):
    rng = random.Random(step)
    out = {}
    for key, (a, ts) in rows.items():
        act = rng.random()
        if act < 0.1:
            continue
        out[key] = (a + 1 if act < 0.2 else a, ts)
    return out | {f"n{step}-{i}": (i, dt.datetime(2024, 1, 1)) for i in range(5)}


def test_changes_follow_a_series_of_snapshots(spark):
    """Bronze after each snapshot holds its live rows; deleted keys come back, unchanged snapshots add nothing."""
    schema = "trans_num string, a int, ingestion_timestamp timestamp_ntz"

    def frame(rows):
        return spark.createDataFrame([(k, *v) for k, v in rows.items()], schema)

    now = {f"k{i}": (i, dt.datetime(2024, 1, 1)) for i in range(60)}
    bronze = frame(now)
    gone = {}
    for step, at in enumerate(AT):
        old = dict(now)
        now = edit(now, step) | ({k: gone.pop(k) for k in list(gone)[:2]} if step > 2 else {})
        gone |= {k: v for k, v in old.items() if k not in now}
        snapshot = frame(now)
        got = CH.snapshot_changes(bronze, snapshot.union(frame({"k-null": (1, None)}).withColumn("trans_num", F.lit(None))), at)
        want = {(k, "insert") for k in now.keys() - old.keys()} | {(k, "delete") for k in old.keys() - now.keys()}
        want |= {(k, "update") for k in now.keys() & old.keys() if now[k] != old[k]}
        rows = got.collect()
        assert {(r["trans_num"], r["change"]) for r in rows} == want and len(rows) == len(want)
        assert {r["ingestion_timestamp"] for r in rows} <= {at} and all(r["is_deleted"] == (r["change"] == "delete") for r in rows)
        bronze = bronze.unionByName(got.drop("change"), allowMissingColumns=True)
        checkpoint_dir(spark)
        bronze = bronze.checkpoint()
        from txnlake.operators.silver import dedupe_latest

        held = CH.live(dedupe_latest(bronze))
        assert {(r["trans_num"], r["a"]) for r in held.collect()} == {(k, v[0]) for k, v in now.items()}
        assert CH.snapshot_changes(bronze, snapshot, at).count() == 0


def test_deletes_reach_gold_and_stay_deleted(spark, scratch):
    bronze = bronze_from_events(load_table(spark, SF, "events"))
    path = {k: f"{scratch}/{k}" for k in ("bronze", "silver", "gold")}
    bronze.write.parquet(path["bronze"])
    jobs.bronze_to_silver(spark, path["bronze"], path["silver"])
    jobs.silver_to_gold(spark, path["silver"], path["gold"], as_of=AS_OF)
    source = bronze.filter(F.col("trans_num").cast("long") % 10 != 0)
    counts = jobs.ingest_snapshot(spark, source, path["bronze"], AT[0])
    assert counts == {"delete": 100}
    assert jobs.ingest_snapshot(spark, source, path["bronze"], AT[1]) == {}  # a rerun finds nothing
    months = jobs.bronze_to_silver_incremental(spark, path["bronze"], path["silver"], AT[0])
    jobs.silver_to_gold(spark, path["silver"], path["gold"], as_of=AS_OF, months=months)

    def keys():
        return {int(r[0]) for r in spark.read.parquet(path["gold"]).select("trans_num").collect()}

    assert len(keys()) == 900 and not any(k % 10 == 0 for k in keys())
    # older copies of deleted keys that arrive late don't bring them back
    months = jobs.merge_into_silver(bronze.filter(F.col("trans_num").cast("long") % 10 == 0), path["silver"])
    jobs.silver_to_gold(spark, path["silver"], path["gold"], as_of=AS_OF, months=months)
    assert len(keys()) == 900
    # a full rebuild agrees, and months without tombstones are read beside those with them
    jobs.bronze_to_silver(spark, path["bronze"], f"{scratch}/silver2")
    jobs.silver_to_gold(spark, f"{scratch}/silver2", f"{scratch}/gold2", as_of=AS_OF)
    a, b = spark.read.parquet(path["gold"]), spark.read.parquet(f"{scratch}/gold2")
    assert a.columns == b.columns and "is_deleted" not in a.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    # a record that is back at the source is back in Gold
    assert jobs.ingest_snapshot(spark, bronze, path["bronze"], AT[2]) == {"insert": 100}
    months = jobs.bronze_to_silver_incremental(spark, path["bronze"], path["silver"], AT[2])
    jobs.silver_to_gold(spark, path["silver"], path["gold"], as_of=AS_OF, months=months)
    assert len(keys()) == 1000
