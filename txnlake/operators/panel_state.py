"""Monitoring panels kept up to date: mergeable partial states stored per batch.

A refresh reads only batches that are new or were written again, and stores for each of
them what the panels need: counts and exact sums by class, flag, hour and probability bin,
the batch's own top rows, and the bins of its distances.  The panels are merged from these
small tables: sums are added, tops of tops are taken, and the histogram's bins are added as
long as the range of all distances stays the same (a new extreme has the bins of the other
batches counted again, from their distance column alone).

A refresh writes a folder of its own and then publishes a state that says in which folder the
partials of each batch are.  A reader uses what the state names; a refresh that fails leaves a
folder that no state names, and the next one does its work again.  Late batches and batches
that were replaced or removed are seen by their versions (``sinks.batches``).
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlake.operators import monitoring as MON
from txnlake.schemas import KEY, PREDICTIONS_TABLE
from txnlake.session import checkpoint_dir
from txnlake.sinks import batches as B
from txnlake.sinks.layers import _file_system

DISTANCE = "customer_merchant_distance"
#: Refresh folders of one kind that may pile up before a refresh folds them into its own.
MOST_FOLDERS = 50


def batch_tops(df: DataFrame, order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each batch; shares of a batch are cut first, so a large batch is not ordered in one task."""
    share = Window.partitionBy(B.BATCH, F.spark_partition_id()).orderBy(*order)
    batch = Window.partitionBy(B.BATCH).orderBy(*order)
    kept = df
    for window in (share, batch):
        kept = kept.withColumn("_place", F.row_number().over(window)).filter(F.col("_place") <= n).drop("_place")
    return kept


class BatchPartials:
    """Partials of a table's batches, of several kinds; ``kinds`` says how each is made from rows with ``batch_id``."""

    kinds: dict = {}

    def __init__(self, spark: SparkSession, path: str, predictions_path: str):
        self.spark, self.path, self.predictions = spark, path.rstrip("/"), predictions_path.rstrip("/")

    # --- state ---------------------------------------------------------------------
    def _state(self) -> dict:
        """For each kind the folder of each batch's partials; the batches' versions."""
        p, fs = _file_system(self.spark, f"{self.path}/_states")
        if not fs.exists(p):
            return {"number": 0, "versions": {}, "folders": {}}
        latest = max(n for s in fs.listStatus(p) if (n := s.getPath().getName()).endswith(".json"))
        return json.loads(B.read_text(self.spark, f"{self.path}/_states/{latest}"))

    def _rows(self, only: list[str]) -> DataFrame:
        return B.read_batches(self.spark, self.predictions, PREDICTIONS_TABLE, only=only)

    def _read(self, kind: str, folders: dict[str, str] | None) -> DataFrame | None:
        """The partials of the batches named, each from its own folder."""
        if not folders:
            return None
        names = sorted(set(folders.values()))
        rows = self.spark.read.parquet(*[f"{self.path}/{kind}/{n}" for n in names])
        if len(names) == 1:
            return rows.filter(F.col(B.BATCH).isin(sorted(folders)))
        # A batch that was written again has older partials in another folder.
        columns = rows.columns
        own = self.spark.createDataFrame(sorted(folders.items()), f"{B.BATCH} string, _folder string")
        at = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/[^/]+$", 1)
        return rows.withColumn("_folder", at).join(F.broadcast(own), [B.BATCH, "_folder"], "left_semi").select(*columns)

    def _write(self, kind: str, name: str, partials: DataFrame, folders: dict, batches: list[str]) -> None:
        own = folders.setdefault(kind, {})
        if len(set(own.values())) >= MOST_FOLDERS:  # fold the earlier ones in
            partials = partials.unionByName(self._read(kind, own))
            batches = sorted({*batches, *own})
        partials.coalesce(8).write.parquet(f"{self.path}/{kind}/{name}")
        own |= {b: name for b in batches}

    # --- refresh -------------------------------------------------------------------
    def refresh(self) -> dict[str, int]:
        """Bring the partials up to date; how many batches were read."""
        state = self._state()
        now = B.versions(self.spark, self.predictions)
        changed = sorted(b for b, v in now.items() if state["versions"].get(b) != v)
        if not changed and set(now) == set(state["versions"]):
            return self._report([], [])
        name = f"{state['number'] + 1:06d}-{uuid.uuid4().hex[:8]}"
        folders = {k: {b: f for b, f in at.items() if b in now and b not in changed} for k, at in state["folders"].items()}
        if changed:
            rows = self._rows(changed)
            for kind, make in self.kinds.items():
                self._write(kind, name, make(rows), folders, changed)
        new = {"number": state["number"] + 1, "versions": now, "folders": folders}
        more = self._further(state, new, name, changed)
        B.publish_text(self.spark, f"{self.path}/_states/v{new['number']:010d}.json", json.dumps(new))
        return self._report(changed, more)

    def _further(self, state: dict, new: dict, name: str, changed: list[str]) -> list[str]:
        """Partials that follow from the others; the batches read for them."""
        return []

    def _report(self, changed: list[str], more: list[str]) -> dict[str, int]:
        return {"batches": len(changed)}


def tops(rows: DataFrame) -> DataFrame:
    """The rows that the top-k panels may need of each batch, with the panel's ``kind``."""
    columns = [f.name for f in PREDICTIONS_TABLE.fields]
    points = MON.drop_null_coords(MON.map_filter(rows)).select(*columns)
    parts = [
        batch_tops(rows, [F.desc(MON.PROB), F.col(KEY)], MON.TOP_RISK_N).withColumn("kind", F.lit("risk")),
        batch_tops(rows, [F.col(KEY)], MON.PREVIEW_ROWS).withColumn("kind", F.lit("preview")),
        batch_tops(points, [MON.sample_order(), F.col(KEY)], MON.MAP_CAP).withColumn("kind", F.lit("map")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


class PanelState(BatchPartials):
    """The panels of the predictions at ``predictions_path`` under one sidebar filter, stored under ``path``."""

    kinds = {"sums": MON.panel_partials, "tops": tops}

    def __init__(self, spark: SparkSession, path: str, predictions_path: str, which: str = "All"):
        super().__init__(spark, f"{path.rstrip('/')}/{which.lower().replace(' ', '_')}", predictions_path)
        self.which = which

    def _rows(self, only: list[str]) -> DataFrame:
        return MON.by_prediction(super()._rows(only), self.which)

    def _further(self, state: dict, new: dict, name: str, changed: list[str]) -> list[str]:
        """The bins of the distances: of new batches, or of all if the range has changed (it is in the grand totals)."""
        sums = self._read("sums", new["folders"].get("sums"))
        r = None if sums is None else sums.agg(F.min("distance_lo").alias("lo"), F.max("distance_hi").alias("hi")).first()
        span = new["range"] = None if r is None or r["lo"] is None else [r["lo"], r["hi"]]
        binned = changed
        if span != state.get("range"):
            binned = sorted(new["versions"])
            new["folders"]["distance"] = {}
        if not binned or span is None:
            return []
        x = F.col(DISTANCE)
        rows = self._rows(binned).select(B.BATCH, DISTANCE).filter(x.isNotNull() & ~F.isnan(x))
        counted = rows.groupBy(B.BATCH, MON.bin_of(x, span[0], span[1], MON.DISTANCE_BINS).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
        self._write("distance", name, counted, new["folders"], binned)
        return binned

    def _report(self, changed: list[str], more: list[str]) -> dict[str, int]:
        return {"batches": len(changed), "binned": len(more)}

    # --- panels --------------------------------------------------------------------
    def totals(self) -> DataFrame:
        """What ``panel_aggregates`` gives for the whole table, merged from the partials."""
        sums = self._read("sums", self._state()["folders"].get("sums"))
        if sums is None:
            sums = MON.panel_partials(self._rows([]))
        return MON.merged_partials(sums)

    def panels(self) -> dict[str, DataFrame]:
        """The panels of ``monitoring``, without reading the table."""
        state = self._state()
        checkpoint_dir(self.spark)
        first = self._read("tops", state["folders"].get("tops"))
        if first is None:
            first = tops(self._rows([]))
        bins = self._read("distance", state["folders"].get("distance"))
        if state.get("range") is None or bins is None:
            histogram = MON.histogram(self._rows([]), DISTANCE, MON.DISTANCE_BINS)
        else:
            counts = bins.groupBy("bin").agg(F.sum("count").alias("count"))
            histogram = MON.with_edges(counts, state["range"][0], state["range"][1], MON.DISTANCE_BINS)

        def of(kind: str) -> DataFrame:
            return first.filter(F.col("kind") == kind).drop("kind")

        return {
            **MON.panels_from_aggregates(self.totals().checkpoint(eager=True)),
            "map_points": MON.map_points(of("map")),
            "top_risk": MON.top_risk(of("risk")),
            "distance_histogram": histogram,
            "preview": MON.preview(of("preview")),
        }
