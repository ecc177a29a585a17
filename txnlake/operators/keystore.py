"""Which keys have predictions, without reading all of them: a key store bucketed by key.

The store is a table of (key, batch_id) bucketed and sorted by key, one file a bucket, made
from the predictions' batches up to a point.  A lookup joins against it without moving it:
the asking side is shuffled into the table's own buckets, and while the asked keys can be
named, only the buckets that hold one of them are opened.  Batches written after the store
(few, until the next ``refresh``) are looked up in their folders.

The predictions stay the truth.  The store's state names the version of each batch in it,
so a batch that was written again is looked up in its folder and its old keys in the store
don't count; nothing has to be written when a batch is appended, and a crash leaves no state
behind.  ``refresh`` writes a new generation and publishes it in one step.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.schemas import KEY
from txnlake.session import checkpoint_dir
from txnlake.sinks import batches as B
from txnlake.sinks.layers import _file_system

#: Keys of a bucket: a file of some tens of MB.
BUCKET_KEYS = 2_000_000
LEAST_BUCKETS, MOST_BUCKETS = 8, 1 << 16
#: Most asked keys that are named in the plan to open only their buckets.
MAX_NAMED_KEYS = 10_000


def buckets_for(keys: int) -> int:
    """A power of two with about ``BUCKET_KEYS`` keys a bucket."""
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << max(0, -(-keys // BUCKET_KEYS) - 1).bit_length()))


class KeyStore:
    """The scored keys of the predictions at ``predictions_path``, stored under ``path``."""

    def __init__(self, spark: SparkSession, path: str, predictions_path: str, key: str = KEY):
        self.spark, self.path, self.predictions, self.key = spark, path.rstrip("/"), predictions_path.rstrip("/"), key
        self.schema = T.StructType([T.StructField(key, T.StringType()), T.StructField(B.BATCH, T.StringType())])

    # --- state -----------------------------------------------------------------
    def _state(self) -> dict:
        """number, folder, buckets and batch versions of the latest generation."""
        p, fs = _file_system(self.spark, f"{self.path}/_states")
        if not fs.exists(p):
            return {"number": 0, "folder": None, "buckets": 0, "batches": {}}
        latest = max(n for s in fs.listStatus(p) if (n := s.getPath().getName()).endswith(".json"))
        return json.loads(B.read_text(self.spark, f"{self.path}/_states/{latest}"))

    def _table(self, folder: str, buckets: int) -> str:
        """The generation's name in this session's catalog: an external table over its files."""
        place = f"{self.path}/{folder}"
        name = f"key_store_{hashlib.md5(place.encode()).hexdigest()[:16]}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (`{self.key}` STRING, {B.BATCH} STRING) USING parquet "
            f"CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        return name

    def _split(self) -> tuple[dict, list[str], list[str]]:
        """The state, its batches that no longer count, and the batches to be looked up in their folders."""
        state = self._state()
        now = B.versions(self.spark, self.predictions)
        stale = sorted(b for b, v in state["batches"].items() if now.get(b) != v)
        fresh = sorted(b for b, v in now.items() if state["batches"].get(b) != v)
        return state, stale, fresh

    # --- reading ----------------------------------------------------------------
    def _stored(self, state: dict, drop: list[str]) -> DataFrame | None:
        if not state["folder"]:
            return None
        rows = self.spark.table(self._table(state["folder"], state["buckets"]))
        return rows.filter(~F.col(B.BATCH).isin(drop)) if drop else rows

    def _recent(self, batches: list[str]) -> DataFrame:
        return B.read_batches(self.spark, self.predictions, self.schema, only=batches).filter(F.col(self.key).isNotNull())

    def absent(self, rows: DataFrame, without: str | None = None) -> DataFrame:
        """``rows`` (keys not NULL) whose key has no prediction in a batch other than ``without``.

        ``rows`` is read more than once: checkpoint it if it is dear."""
        from txnlake.operators.incremental import absent

        state, stale, fresh = self._split()
        stored = self._stored(state, [*stale, *([without] if without in state["batches"] else [])])
        if fresh := [b for b in fresh if b != without]:
            rows = absent(rows, self._recent(fresh), self.key)
        if stored is None:
            return rows
        named = [r[0] for r in rows.select(self.key).limit(MAX_NAMED_KEYS + 1).collect()]
        if len(named) <= MAX_NAMED_KEYS:
            stored = stored.filter(F.col(self.key).isin(sorted(set(named))))
        # The store is clustered by the key: only ``rows`` are shuffled, into its buckets.
        return rows.join(stored.select(self.key).hint("merge"), self.key, "left_anti")

    # --- writing ----------------------------------------------------------------
    def refresh(self, buckets: int | None = None) -> int:
        """Fold the batches written since into a new generation; the number of keys in it."""
        state, stale, fresh = self._split()
        if state["folder"] and not stale and not fresh:
            return self.spark.read.schema(self.schema).parquet(f"{self.path}/{state['folder']}").count()
        now = B.versions(self.spark, self.predictions)
        rows = self._recent(fresh)
        stored = self._stored(state, stale)
        rows = rows if stored is None else stored.unionByName(rows)
        checkpoint_dir(self.spark)
        total = rows.count()
        buckets = buckets or buckets_for(total)
        number = state["number"] + 1
        folder = f"generation-{number:06d}"
        # A generation that a failed run left half written is written anew: no state names it.
        p, fs = _file_system(self.spark, f"{self.path}/{folder}")
        fs.delete(p, True)
        table = self._table(folder, buckets)
        self.spark.sql(f"DROP TABLE {table}")
        # Dealt like the table, so each bucket is one sorted file.
        dealt = rows.select(self.key, B.BATCH).repartition(buckets, self.key).sortWithinPartitions(self.key)
        dealt.write.format("parquet").bucketBy(buckets, self.key).sortBy(self.key).option("path", f"{self.path}/{folder}").saveAsTable(table)
        after = B.versions(self.spark, self.predictions)
        held = {b: v for b, v in now.items() if after.get(b) == v}  # one written meanwhile is looked up in its folder
        text = json.dumps({"number": number, "folder": folder, "buckets": buckets, "batches": held})
        B.publish_text(self.spark, f"{self.path}/_states/v{number:010d}.json", text)
        return total
