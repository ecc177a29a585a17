"""Every oracle-checked query on an empty ``events`` table equals DuckDB on it."""

import os

import pytest

from tests.oracle_compare import canon, duck_conn
from txnlake.plans.oracle_queries import ORACLE
from txnlake.plans.queries import REGISTRY


@pytest.fixture(scope="module")
def empty_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("empty_sf"))
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    ev.limit(0).coalesce(1).write.parquet(f"{d}/events_dir")
    part = [f for f in os.listdir(f"{d}/events_dir") if f.endswith(".parquet")][0]
    os.rename(f"{d}/events_dir/{part}", f"{d}/events.parquet")
    return d


FITTED = {"train_contract", "unscored_cursor", "score_contract", "inference_batch_contract", "train_model_contract", "importance_contract"}  # no forest without rows


@pytest.mark.parametrize("name", sorted(set(ORACLE) - FITTED))
def test_empty_input_matches_oracle(spark, empty_dir, name):
    df = REGISTRY[name](spark, empty_dir)
    s_cols, s_rows = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck_conn(empty_dir).execute(ORACLE[name])
    d_cols, d_rows = canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert s_rows == d_rows
