"""Compaction, the key store and panel states: replays, crashes between steps, and plans."""

import datetime as dt
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txnlake.operators import incremental as INC
from txnlake.operators import monitoring as MON
from txnlake.operators.keystore import KeyStore, buckets_for
from txnlake.operators.panel_state import PanelState
from txnlake.plans import jobs
from txnlake.plans.fixtures import fixture_layers
from txnlake.schemas import KEY, PREDICTIONS_TABLE
from txnlake.sinks import batches as B

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def predictions(spark):
    from txnlake.session import checkpoint_dir

    checkpoint_dir(spark)
    return fixture_layers(spark, SF)["predictions"].checkpoint()


def write(predictions, path, n, prefix="b"):
    k = F.pmod(F.col(KEY).cast("long"), F.lit(n))
    rows = predictions.withColumn("batch_id", F.concat(F.lit(prefix), k.cast("string")))
    rows.repartition(8, "batch_id").write.mode("append").partitionBy("batch_id").parquet(path)


def read(spark, path):
    return B.read_batches(spark, path, PREDICTIONS_TABLE)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def files(root):
    return sum(f.endswith(".parquet") for d, _, names in os.walk(root) for f in names)


# --- compaction ----------------------------------------------------------------------
@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 120), max_size=40))
def test_bins_hold_every_item_once_and_fit(sizes):
    named = {f"n{i}": s for i, s in enumerate(sizes)}
    got = B.bins(named, 100)
    assert sorted(n for b in got for n in b) == sorted(n for n, s in named.items() if s <= 100)
    loads = [sum(named[n] for n in b) for b in got]
    assert all(x <= 100 for x in loads)
    # first fit: at most one bin is half empty
    assert sum(x <= 50 for x in loads) <= 1
    # by falling size into the first bin with room
    room = []
    for n, s in sorted(named.items(), key=lambda x: (-x[1], x[0])):
        if s <= 100:
            at = next((i for i, r in enumerate(room) if r >= s), len(room))
            room[at:] = [room[at] - s, *room[at + 1 :]] if at < len(room) else [100 - s]
    assert len(room) == len(got)


def test_a_thousand_batches_become_few_files(spark, predictions, scratch):
    path = f"{scratch}/p"
    write(predictions, path, 1000)
    want = read(spark, path)
    assert files(path) == 1000 and len(B.folders(spark, path)) == 1000
    assert jobs.compact_predictions(spark, path) == 1000
    got = read(spark, path)
    assert len(got.inputFiles()) == 1 and same(got, want) and got.select("batch_id").distinct().count() == 1000
    assert B.versions(spark, path) == {b: f.version for b, f in B.folders(spark, path).items()}
    assert jobs.compact_predictions(spark, path) == 0  # nothing left to pack
    assert B.vacuum(spark, path) == 0  # too young
    before = got.count()
    assert B.vacuum(spark, path, older_than_s=-60) == 1000
    assert read(spark, path).count() == before and len(B.versions(spark, path)) == 1000
    # new batches are read beside the group, and packed with it while it is small
    write(predictions.withColumn(KEY, F.concat(F.lit("7"), KEY)), path, 3, "c")
    assert read(spark, path).count() == 2 * before
    assert jobs.compact_predictions(spark, path) == 1003 and len(read(spark, path).inputFiles()) == 1
    assert B.vacuum(spark, path, older_than_s=-60) == 4 and read(spark, path).count() == 2 * before


def test_bins_of_the_target_size(spark, predictions, scratch):
    path = f"{scratch}/p"
    write(predictions, path, 40)
    size = sum(f.size for f in B.folders(spark, path).values())
    B.compact(spark, path, PREDICTIONS_TABLE, target_bytes=size // 5, sort_by=KEY)
    groups = B.manifest(spark, path).groups
    assert len(groups) >= 5 and sum(len(g["batches"]) for g in groups.values()) == 40
    assert same(read(spark, path), spark.read.schema(PREDICTIONS_TABLE).parquet(path))


def test_a_task_sorts_a_part_of_one_bin(spark, predictions, scratch, monkeypatch):
    """neither a bin nor several of them are one task's to sort."""
    path = f"{scratch}/p"
    write(predictions, path, 40)
    want, sizes = read(spark, path), {b: f.size for b, f in B.folders(spark, path).items()}
    largest, target = max(sizes.values()), sum(sizes.values()) // 5
    monkeypatch.setattr(B, "TASK_BYTES", 2 * largest, raising=False)
    B.compact(spark, path, PREDICTIONS_TABLE, target_bytes=target, sort_by=KEY)
    of: dict[str, set] = {}
    for f in read(spark, path).inputFiles():
        assert spark.read.schema(PREDICTIONS_TABLE).parquet(f).select("batch_id").distinct().count() <= 4  # batches are of about one size
        of.setdefault(os.path.basename(f).split("-")[1], set()).add(os.path.dirname(f))
    assert len(of) >= 10 and all(len(bins) == 1 for bins in of.values())
    assert same(read(spark, path), want)


def test_a_crash_between_the_steps_loses_and_doubles_nothing(spark, predictions, scratch, monkeypatch):
    path = f"{scratch}/p"
    write(predictions, path, 30)
    want = read(spark, path)

    def dies(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # before the manifest: the group's files are there, but no manifest names them
        m.setattr(B, "publish_text", dies)
        with pytest.raises(RuntimeError):
            jobs.compact_predictions(spark, path)
    assert os.path.exists(f"{path}/_groups") and same(read(spark, path), want)
    assert spark.read.schema(PREDICTIONS_TABLE).parquet(path).count() == want.count()  # hidden from plain readers too
    assert jobs.compact_predictions(spark, path) == 30 and same(read(spark, path), want)
    assert B.vacuum(spark, path, older_than_s=-60) == 31  # the folders and the lost group
    assert len(read(spark, path).inputFiles()) == 1


def test_a_reader_that_began_before_a_compaction_ends_well(spark, predictions, scratch):
    path = f"{scratch}/p"
    write(predictions, path, 20)
    early = read(spark, path)
    jobs.compact_predictions(spark, path)
    assert early.count() == predictions.count() == read(spark, path).count()


def test_two_writers_cannot_publish_the_same_manifest(spark, predictions, scratch):
    path = f"{scratch}/p"
    write(predictions, path, 4)
    jobs.compact_predictions(spark, path)
    stale = B.Manifest(0)
    with pytest.raises(RuntimeError, match="another writer"):
        B.publish(spark, path, stale)
    assert not [f for f in os.listdir(f"{path}/_manifests") if ".tmp" in f]


def test_a_packed_batch_that_is_written_again(spark, predictions, scratch):
    path = f"{scratch}/p"
    write(predictions, path, 10)
    jobs.compact_predictions(spark, path)
    B.vacuum(spark, path, older_than_s=-60)
    own = predictions.filter(F.col(KEY).cast("long") % 10 == 3)
    fewer = own.limit(7)
    assert INC.append_idempotent(fewer, path, "b3") == 7
    rest = predictions.filter(F.col(KEY).cast("long") % 10 != 3)
    assert same(read(spark, path).drop("batch_id"), rest.unionByName(fewer))
    assert read(spark, path).filter("batch_id = 'b3'").count() == 7
    # the keys it gave up can be appended by another batch; the others can't
    assert INC.append_idempotent(own, path, "other") == own.count() - 7
    # its group is left with nine batches, is packed again with the folders, and an old copy is never read
    assert jobs.compact_predictions(spark, path) == 11
    B.vacuum(spark, path, older_than_s=-60)
    assert same(read(spark, path).drop("batch_id"), predictions)


def test_a_batch_written_again_during_a_compaction_stays_out(spark, predictions, scratch, monkeypatch):
    path = f"{scratch}/p"
    write(predictions, path, 5)
    seen = []
    real = B.folders

    def folders(*a):
        if seen:  # the second look: another run has replaced a batch meanwhile
            predictions.limit(2).write.mode("overwrite").parquet(f"{path}/batch_id=b1")
        seen.append(1)
        return real(*a)

    monkeypatch.setattr(B, "folders", folders)
    monkeypatch.setattr(B, "read_batches", lambda s, r, schema, only=None: s.read.schema(schema).parquet(r).filter(F.col("batch_id").isin(only)))
    assert B.compact(spark, path, PREDICTIONS_TABLE) == 4
    monkeypatch.undo()
    assert read(spark, path).filter("batch_id = 'b1'").count() == 2
    assert "b1" not in B.manifest(spark, path).covered


def test_incomplete_folders_are_not_packed(spark, predictions, scratch):
    path = f"{scratch}/p"
    for b in "abc":
        predictions.limit(5).write.parquet(f"{path}/batch_id={b}")
    os.rename(f"{path}/batch_id=c/_SUCCESS", f"{scratch}/moved")
    assert jobs.compact_predictions(spark, path) == 2 and read(spark, path).count() == 15
    assert B.manifest(spark, f"{scratch}/absent") == B.Manifest() and B.folders(spark, f"{scratch}/absent") == {}
    assert read(spark, f"{scratch}/absent").count() == 0 and jobs.compact_predictions(spark, f"{scratch}/absent") == 0


# --- the key store ------------------------------------------------------------------------
def keys_of(df):
    return sorted(r[0] for r in df.select(KEY).collect())


def test_store_answers_like_the_whole_table(spark, predictions, scratch):
    """Batches before and after the store, written again, emptied, removed and compacted."""
    path, rng = f"{scratch}/p", random.Random(4)
    write(predictions.filter(F.col(KEY).cast("long") % 2 == 0), path, 12)
    store = KeyStore(spark, f"{scratch}/keys", path)
    asked = INC.one_row_per_key(predictions)

    def check(without=None):
        others = read(spark, path).filter(F.col("batch_id") != F.lit(without or ""))
        assert keys_of(store.absent(asked, without)) == keys_of(INC.absent(asked, others.select(KEY)))

    check()  # no store yet: all in folders
    assert store.refresh(buckets=8) == 500
    check()
    check(without="b4")
    predictions.limit(30).write.mode("overwrite").parquet(f"{path}/batch_id=new")
    check()
    check(without="new")
    predictions.limit(0).write.mode("overwrite").parquet(f"{path}/batch_id=b6")
    predictions.sample(0.1, seed=rng.randint(0, 99)).write.mode("overwrite").parquet(f"{path}/batch_id=b8")
    check()
    os.rename(f"{path}/batch_id=b10", f"{scratch}/gone")
    check()
    jobs.compact_predictions(spark, path)
    check()
    total = store.refresh(buckets=8)
    assert total == read(spark, path).count() and store._state()["number"] == 2
    check()
    assert store.refresh() == total and store._state()["number"] == 2  # nothing new


def test_stored_side_is_not_shuffled_and_only_asked_buckets_are_read(spark, predictions, scratch):
    path = f"{scratch}/p"
    write(predictions, path, 6)
    store = KeyStore(spark, f"{scratch}/keys", path)
    store.refresh(buckets=64)
    one_file_each = [f for f in os.listdir(f"{scratch}/keys/generation-000001") if f.endswith(".parquet")]
    assert 40 < len(one_file_each) <= 64
    some = predictions.limit(3).select(KEY)
    df = store.absent(some.checkpoint())
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    stored = plan[plan.index("SortMergeJoin") :].split("+- ")
    assert "SortMergeJoin" in plan and "Bucketed: true" in plan
    import re

    picked, of = map(int, re.search(r"SelectedBucketsCount: (\d+) out of (\d+)", plan).groups())
    assert of == 64 and 1 <= picked <= 3
    # one Exchange, on the asking side: nothing stands between the join and the store's scan but a sort and a filter
    final = plan.split("Initial Plan")[-1]
    assert final.count("Exchange hashpartitioning") == 1, stored


def test_a_refresh_that_fails_leaves_the_store_as_it_was(spark, predictions, scratch, monkeypatch):
    path = f"{scratch}/p"
    write(predictions.filter(F.col(KEY).cast("long") < 400), path, 4)
    store = KeyStore(spark, f"{scratch}/keys", path)
    store.refresh(buckets=8)
    write(predictions.filter(F.col(KEY).cast("long") >= 400).withColumn("x", F.lit(1)).drop("x"), path, 4)
    predictions.filter(F.col(KEY).cast("long") >= 400).write.parquet(f"{path}/batch_id=late")

    def dies(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(B, "publish_text", dies)
        with pytest.raises(RuntimeError):
            store.refresh(buckets=8)
    assert store._state()["number"] == 1 and keys_of(store.absent(INC.one_row_per_key(predictions))) == []
    store.refresh(buckets=8)  # over the half-written generation
    assert store._state()["number"] == 2 and keys_of(store.absent(INC.one_row_per_key(predictions))) == []
    # another session finds the table by its folder
    assert keys_of(KeyStore(spark.newSession(), f"{scratch}/keys", path).absent(INC.one_row_per_key(predictions))) == []


def test_append_with_a_store_is_idempotent(spark, predictions, scratch):
    path = f"{scratch}/p"
    store = KeyStore(spark, f"{scratch}/keys", path)
    for i, (lo, hi) in enumerate([(0, 300), (200, 500), (200, 500), (450, 1000), (0, 1000)]):
        k = F.col(KEY).cast("long")
        INC.append_idempotent(predictions.filter((k >= lo) & (k < hi)), path, f"r{min(i, 2) if i < 3 else i}", store=store)
        if i == 1:
            store.refresh(buckets=8)
    got = read(spark, path)
    assert got.count() == got.select(KEY).distinct().count() == predictions.count()


def test_bucket_numbers_follow_the_keys():
    assert [buckets_for(n) for n in (0, 1, 16_000_000, 16_000_001, 10**9, 10**12)] == [8, 8, 8, 16, 512, 65_536]


# --- panels ---------------------------------------------------------------------------------
@pytest.mark.parametrize("which", MON.FILTER_CHOICES[:2])
def test_panels_follow_the_batches(spark, predictions, scratch, which):
    path = f"{scratch}/p"
    state = PanelState(spark, f"{scratch}/panels", path, which)

    def check():
        got, want = state.panels(), MON.monitoring(read(spark, path), which)
        assert list(got) and set(got) == set(want)
        for name, df in want.items():
            assert got[name].columns == df.columns, name
            a, b = ([tuple(r) for r in x.collect()] for x in (got[name], df))
            assert (a == b) if name in ("top_risk", "preview", "map_points") else (sorted(a, key=repr) == sorted(b, key=repr)), name

    check()  # no batch yet
    assert state.refresh() == {"batches": 0, "binned": 0}
    near = predictions.filter(F.col("customer_merchant_distance") < 5)
    write(near, path, 4)
    assert state.refresh()["batches"] == 4
    check()
    near.filter(F.col(KEY).cast("long") % 4 == 2).limit(50).withColumn("fraud_probability", F.lit(0.77)).write.mode("overwrite").parquet(f"{path}/batch_id=b2")
    predictions.limit(0).write.mode("overwrite").parquet(f"{path}/batch_id=b3")
    near.limit(10).withColumns({KEY: F.concat(F.lit("0"), KEY), "inference_timestamp": F.lit(dt.datetime(2030, 1, 1))}).write.parquet(f"{path}/batch_id=late")
    assert state.refresh()["batches"] == 3
    check()
    # a new extreme distance: every batch's distances are binned again, nothing else of them is read
    predictions.filter("customer_merchant_distance > 15").limit(3).write.parquet(f"{path}/batch_id=far")
    assert state.refresh()["batches"] == 1
    check()
    os.rename(f"{path}/batch_id=b1", f"{scratch}/gone")
    assert state.refresh()["batches"] == 0
    check()
    jobs.compact_predictions(spark, path)  # the same batches in other files: nothing to do
    assert state.refresh() == {"batches": 0, "binned": 0}
    check()


def test_a_refresh_reads_only_new_batches(spark, predictions, scratch, monkeypatch):
    path = f"{scratch}/p"
    write(predictions, path, 8)
    state = PanelState(spark, f"{scratch}/panels", path)
    state.refresh()
    predictions.limit(5).write.parquet(f"{path}/batch_id=new")
    asked = []
    real = B.read_batches
    monkeypatch.setattr(B, "read_batches", lambda s, r, schema, only=None: asked.append(only) or real(s, r, schema, only))
    assert state.refresh() == {"batches": 1, "binned": 1}
    assert asked == [["new"], ["new"]]
    asked.clear()
    state.panels()
    assert asked == []


def test_a_refresh_that_dies_is_done_again(spark, predictions, scratch, monkeypatch):
    path = f"{scratch}/p"
    write(predictions, path, 3)
    state = PanelState(spark, f"{scratch}/panels", path)

    def dies(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(B, "publish_text", dies)
        with pytest.raises(RuntimeError):
            state.refresh()
    assert state.totals().filter("gid = 31").first()["n"] == 0
    assert state.refresh()["batches"] == 3
    assert state.totals().filter("gid = 31").first()["n"] == predictions.count()


def test_folders_are_folded(spark, predictions, scratch, monkeypatch):
    from txnlake.operators import panel_state

    monkeypatch.setattr(panel_state, "MOST_FOLDERS", 2)
    path = f"{scratch}/p"
    state = PanelState(spark, f"{scratch}/panels", path)
    for i in range(4):
        predictions.filter(F.col(KEY).cast("long") % 4 == i).write.parquet(f"{path}/batch_id=b{i}")
        state.refresh()
    assert len(set(state._state()["folders"]["sums"].values())) == 2
    assert state.totals().filter("gid = 31").first()["n"] == predictions.count()
