"""The random forest over many rows.

Spark's own fit takes all trees through the table row by row: a row of 13 features costs 550 bytes with its draws for 100
trees, and each of its updates goes to another place of 150 MB of counts.  Here a row is its bin in each feature and its label
(14 bytes), a task takes one tree at a time through its rows, in arrays, and the draws are made again in each pass.

The method is that of Spark: split candidates at quantiles of a sample, Poisson draws per row and tree, for each node a random
subset of the features, counts of its rows by bin and class added up over all tasks, the split of the largest Gini gain, and
leaves of one parent with the same class merged.  Only the random numbers are others.  Counts are whole numbers, so the trees
follow from the rows of each partition, their order and the seed.  The result is Spark's model class.
"""

from __future__ import annotations

import math
import sys
import uuid

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.session import checkpoint_dir
from txnlake.sinks.layers import _file_system

# Rows, about, whose quantiles are the split candidates; Spark takes 10,000.
SAMPLE = 100_000
# Levels of a tree, at most: a task holds the counts of one level, a kilobyte a node and two classes.
MAX_DEPTH = 12
# Classes, at most, as in Spark.
MAX_CLASSES = 100
# Rows that a task takes through a tree at once.
BLOCK = 1 << 17
# A node without a split: no bin is beyond this one.
NO_CUT = 255
# P(draw > k) in 2^32nds, for a Poisson draw of mean 1.
_DRAWS = [round(2**32 * sum(math.exp(-1) / math.factorial(i) for i in range(k + 1))) for k in range(13)]
DRAWS = np.array([x for x in _DRAWS if x < 2**32], np.uint32)

# Workers get these functions with the job; they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def fit(df: DataFrame, features: list[str], rf: RandomForestClassifier) -> RandomForestClassificationModel:
    """The forest of ``rf`` (its trees, depth, bins, seed, bootstrap and a subset of "sqrt" or "all") on the rows of ``df``;
    neither features nor the label may be null.

    A task holds a partition of ``df`` in bins.  The driver holds the trees, the sample and the results of a pass: one split
    for each open node."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    label, depth, seed = rf.getLabelCol(), rf.getMaxDepth(), rf.getSeed() % 2**64
    y = F.col(label).cast("double")
    rows, top, odd = df.agg(F.count(F.lit(1)), F.max(y), F.count_if(y.isNull() | F.isnan(y) | (y < 0) | (y != F.floor(y)))).first()
    if not rows or odd or top >= MAX_CLASSES or depth > MAX_DEPTH or not 2 <= rf.getMaxBins() <= NO_CUT:
        raise ValueError(f"{rows} rows, {odd} labels that are no class, class {top} at most, {rf.getMaxBins()} bins, {depth} levels")
    classes = int(top) + 1
    numbers = df.select(y.alias("_label"), *[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(features)])
    ddl = ", ".join(f"_{i} double" for i in range(len(features)))
    sample = numbers.drop("_label").mapInArrow(_sampled(min(1.0, SAMPLE / rows), seed), ddl).toArrow()
    cuts = [candidates(sample.column(i).to_numpy(), rf.getMaxBins()) for i in range(len(features))]
    binned = numbers.mapInArrow(_binned(cuts), "bins binary, labels binary").checkpoint(eager=True)

    per_split = len(features) if rf.getFeatureSubsetStrategy() == "all" else math.ceil(math.sqrt(len(features)))
    trees = [Tree() for _ in range(rf.getNumTrees())]
    sc = spark.sparkContext
    tasks = min(len(trees), max(2 * sc.defaultParallelism, 8))
    for level in range(max(depth, 1)):
        growing = {}
        for i, tree in enumerate(trees):
            if len(tree.open):
                pick = np.random.Generator(np.random.PCG64([seed, i, level])).random((len(tree.open), len(features)))
                growing[i] = (tree.feature, tree.cut, tree.below, tree.slots(), np.sort(np.argsort(pick, axis=1)[:, :per_split], axis=1))
        if not growing:
            break
        sent = sc.broadcast(growing)
        counted = binned.rdd.mapPartitionsWithIndex(_counted(sent, level, len(features), rf.getMaxBins(), classes, seed, rf.getBootstrap()))
        best = counted.partitionBy(tasks, lambda i: i % tasks).mapPartitions(_best(sent, [len(c) for c in cuts], rf.getMaxBins(), classes))
        for i, found in best.collect():
            trees[i].grow(*found, depth - level)
        sent.destroy()
    return _model(spark, rf, trees, cuts, classes)


# --- candidates and bins ------------------------------------------------------


def candidates(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins`` - 1 thresholds, as Spark places them: between all values, or else at the quantiles."""
    found, count = np.unique(values, return_counts=True)
    between = (found[:-1] + found[1:]) / 2
    if len(between) < bins:
        return between
    seen = np.cumsum(count)
    stride = target = len(values) / bins
    out = []
    for i in range(len(between)):
        if abs(seen[i] - target) < abs(seen[i + 1] - target):
            out.append(between[i])
            target += stride
    return np.array(out[: bins - 1])


def _sampled(share: float, seed: int):
    def run(batches):
        from pyspark import TaskContext

        draw = np.random.Generator(np.random.PCG64([seed, TaskContext.get().partitionId()]))
        for batch in batches:
            yield batch.filter(pa.array(draw.random(batch.num_rows) < share))

    return run


def _binned(cuts: list[np.ndarray]):
    def run(batches):
        for batch in batches:
            out = np.empty((batch.num_rows, len(cuts)), np.uint8)
            for i, c in enumerate(cuts):
                column = batch.column(i + 1)
                values = column.to_numpy(zero_copy_only=False)
                if column.null_count or np.isnan(values).any():
                    raise ValueError("a feature is null")
                out[:, i] = np.searchsorted(c, values)
            labels = batch.column(0).to_numpy().astype(np.uint8)
            yield pa.record_batch([pa.array([out.tobytes()], pa.binary()), pa.array([labels.tobytes()], pa.binary())], ["bins", "labels"])

    return run


# --- a pass: the counts of a task's rows, the best split of the sums ------------


def draws(bits: np.random.PCG64, n: int) -> np.ndarray:
    """How often each of ``n`` rows is drawn: Poisson of mean 1."""
    u = bits.random_raw((n + 1) // 2).view(np.uint32)[:n]
    out = np.zeros(n, np.uint8)
    for c in DRAWS:
        out += (u >= c).view(np.uint8)
    return out


def _counted(sent, level: int, width: int, bins: int, classes: int, seed: int, bagged: bool):
    """For each growing tree the counts by (picked feature, class, open node, bin)."""

    def run(partition, rows):
        rows = list(rows)
        if not rows:
            return
        x = np.frombuffer(b"".join(r.bins for r in rows), np.uint8)
        y = np.frombuffer(b"".join(r.labels for r in rows), np.uint8)
        del rows
        for i, (feature, cut, below, slots, picked) in sent.value.items():
            bits = np.random.PCG64([seed, partition, i])
            cells = len(picked) * bins * classes
            of = np.ascontiguousarray(picked.T)
            out = np.zeros((picked.shape[1], cells), np.uint32)
            for start in range(0, len(y), BLOCK):
                n = min(BLOCK, len(y) - start)
                drawn = draws(bits, n) if bagged else np.ones(n, np.uint8)
                row = np.flatnonzero(drawn)
                at = (row + start) * width
                node = np.zeros(len(row), np.intp)
                for _ in range(level):
                    node = below.take(node) + (x.take(at + feature.take(node)) > cut.take(node))
                slot = slots.take(node)
                open_ = slot >= 0
                if not open_.all():
                    row, at, slot = row[open_], at[open_], slot[open_]
                weight = drawn.take(row).astype(np.float64)
                cell = (y[start:].take(row).astype(np.intp) * len(picked) + slot) * bins
                for j in range(picked.shape[1]):
                    b = x.take(at + of[j].take(slot))
                    out[j] += np.bincount(cell + b, weight, cells).astype(np.uint32)
            yield i, out

    return run


def _gini(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.ones(n.shape)
    for k in range(counts.shape[-1]):
        share = counts[..., k] / np.maximum(n, 1)
        out -= share * share
    return np.where(n > 0, out, 0.0)


def best_splits(counts: np.ndarray, picked: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
    """For each node (feature, bin, gain, counts at left, counts at right) of its best split, -1 as the feature if none gains.
    ``counts`` by picked feature, node, bin and class; the first of equal splits counts, as in Spark."""
    left = counts.cumsum(axis=2)[:, :, :-1].transpose(1, 0, 2, 3)
    total = counts[0].sum(axis=1)
    right = total[:, None, None] - left
    n, n_left, n_right = total.sum(-1), left.sum(-1), right.sum(-1)
    every = np.maximum(n, 1)[:, None, None]
    gain = _gini(total, n)[:, None, None] - n_left / every * _gini(left, n_left) - n_right / every * _gini(right, n_right)
    there = np.arange(gain.shape[2]) < cuts[picked][:, :, None]
    gain = np.where(there & (n_left > 0) & (n_right > 0), gain, -1.0).reshape(len(n), -1)
    best = gain.argmax(axis=1)
    j, b = np.divmod(best, left.shape[2])
    nodes = np.arange(len(n))
    gain = gain[nodes, best]
    return np.where(gain > 0, picked[nodes, j], -1), b, gain, left[nodes, j, b], right[nodes, j, b]


def _best(sent, cuts: list[int], bins: int, classes: int):
    def run(counted):
        sums = {}
        for i, counts in counted:
            if i in sums:
                sums[i] += counts
            else:
                sums[i] = counts.astype(np.int64)
        for i, counts in sums.items():
            picked = sent.value[i][4]
            counts = counts.reshape(picked.shape[1], classes, len(picked), bins).transpose(0, 2, 3, 1)
            yield i, best_splits(counts, picked, np.array(cuts))

    return run


# --- trees ----------------------------------------------------------------------


class Tree:
    """Nodes in the order they were made.  ``below`` has the left child, the right one follows it; of a node without a split, itself."""

    def __init__(self):
        self.feature, self.cut, self.below = np.zeros(1, np.intp), np.full(1, NO_CUT, np.uint8), np.zeros(1, np.intp)
        self.gain, self.counts = np.full(1, -1.0), None
        self.open = np.zeros(1, np.intp)

    def slots(self) -> np.ndarray:
        out = np.full(len(self.feature), -1, np.intp)
        out[self.open] = np.arange(len(self.open))
        return out

    def grow(self, feature, cut, gain, left, right, levels: int) -> None:
        """The open nodes get their splits, if any; ``levels`` may still be added."""
        if self.counts is None:
            self.counts = left + right
        some = (feature >= 0) & (levels > 0)
        at, n = self.open[some], 2 * int(some.sum())
        new = len(self.feature) + np.arange(n)
        self.feature[at], self.cut[at], self.gain[at] = feature[some], cut[some], gain[some]
        self.below[at] = new[::2]
        counts = np.stack([left[some], right[some]], axis=1).reshape(n, left.shape[1])
        self.feature = np.append(self.feature, np.zeros(n, np.intp))
        self.cut = np.append(self.cut, np.full(n, NO_CUT, np.uint8))
        self.gain = np.append(self.gain, np.full(n, -1.0))
        self.below = np.append(self.below, new)
        self.counts = np.concatenate([self.counts, counts])
        self.open = new[(counts > 0).sum(axis=1) > 1] if levels > 1 else new[:0]

    def nodes(self) -> list[tuple[int, int, int, float]]:
        """(node, left, right, class) from the root on, a node before those below it, children by their place in the list or -1.
        Leaves of one parent with the same class are merged."""
        below, made = self.below.tolist(), self.counts.argmax(axis=1).tolist()
        leaf = [True] * len(below)
        for i in range(len(below) - 1, -1, -1):
            a = below[i]
            if a != i:
                leaf[i] = leaf[a] and leaf[a + 1] and made[a] == made[a + 1]
                made[i] = made[a] if leaf[i] else made[i]
        out, left = [], [(0, None, 0)]
        while left:
            i, above, side = left.pop()
            if above is not None:
                out[above][side] = len(out)
            if not leaf[i]:
                left += [(below[i] + 1, len(out), 2), (below[i], len(out), 1)]
            out.append([i, -1, -1, float(made[i])])
        return [tuple(x) for x in out]


def _model(spark, rf: RandomForestClassifier, trees: list[Tree], cuts: list[np.ndarray], classes: int) -> RandomForestClassificationModel:
    """Spark's model: it writes one of as many trees and classes, whose nodes are then replaced."""
    blank = spark.createDataFrame([(float(k), Vectors.dense([0.0] * len(cuts))) for k in range(classes)], [rf.getLabelCol(), rf.getFeaturesCol()])
    path = f"{checkpoint_dir(spark)}/forest-{uuid.uuid4().hex[:12]}"
    rf.fit(blank.coalesce(1)).write().save(path)
    kept = [tree.nodes() for tree in trees]
    of = np.repeat(np.arange(len(trees), dtype=np.int32), [len(k) for k in kept])
    place = np.concatenate([np.arange(len(k), dtype=np.int32) for k in kept])
    node, left, right, made = (np.array(c) for c in zip(*[n for k in kept for n in k]))
    at = np.cumsum([0] + [len(t.feature) for t in trees])[of] + node
    counts = np.concatenate([t.counts for t in trees])[at]
    inner = left >= 0
    feature = np.where(inner, np.concatenate([t.feature for t in trees])[at], -1)
    cut = np.concatenate([t.cut for t in trees])[at]
    n = len(at)
    ends = np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)
    values = np.array([cuts[f][c] for f, c in zip(feature[inner], cut[inner])], float)
    split = {
        "featureIndex": pa.array(feature.astype(np.int32)),
        "leftCategoriesOrThreshold": pa.ListArray.from_arrays(ends, pa.array(values, pa.float64())),
        "numCategories": pa.array(np.full(n, -1, np.int32)),
    }
    data = {
        "id": pa.array(place),
        "prediction": pa.array(made.astype(float)),
        "impurity": pa.array(_gini(counts, counts.sum(axis=1))),
        "impurityStats": pa.ListArray.from_arrays(np.arange(0, n * classes + 1, classes, dtype=np.int32), pa.array(counts.ravel().astype(float))),
        "rawCount": pa.array(counts.sum(axis=1)),
        "gain": pa.array(np.where(inner, np.concatenate([t.gain for t in trees])[at], -1.0)),
        "leftChild": pa.array(left.astype(np.int32)),
        "rightChild": pa.array(right.astype(np.int32)),
        "split": pa.StructArray.from_arrays(list(split.values()), list(split)),
    }
    table = pa.table({"treeID": pa.array(of), "nodeData": pa.StructArray.from_arrays(list(data.values()), list(data))})
    spark.createDataFrame(table).write.mode("overwrite").parquet(f"{path}/data")
    model = RandomForestClassificationModel.load(path)
    place, files = _file_system(spark, path)
    files.delete(place, True)
    return model
