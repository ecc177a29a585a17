"""Comparing two models with an error measure: a Poisson bootstrap in one aggregate.

Each row gets a weight in each of B resamples, drawn from a Poisson distribution of mean 1
by a hash of its key and the resample's number.  The weighted counts of right and wrong
predictions of both models are summed in one pass (a partial aggregate of B rows a task),
the metrics and their differences follow from these B rows, and the interval of a difference is
read off its sorted values.  Weights depend on keys alone: reruns, other layouts and SQL give
the same ones, and both models are weighted alike, so the differences are paired.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.schemas import KEY, LABEL

REPLICATES, CONFIDENCE = 100, 0.95
METRICS = ["accuracy", "precision", "recall", "f1_score"]
REPORT_DIGITS = 6
#: Values of a weight's hash: 24 bits.
HASH_VALUES = 1 << 24


def poisson_cuts() -> list[int]:
    """Hash values from which the weight is at least 1, 2, ...: the Poisson distribution's sums over ``HASH_VALUES``."""
    cuts, total, k = [], 0.0, 0
    while True:
        total += math.exp(-1) / math.factorial(k)
        cut = round(total * HASH_VALUES)
        if cut >= HASH_VALUES:
            return cuts
        cuts.append(cut)
        k += 1


def weight_hash(key: Column, replicate: Column) -> Column:
    """The hash that a row's weight in a resample is read off: six hexadecimal digits, whose text order is that of their values."""
    return F.substring(F.md5(F.concat_ws("#", replicate.cast("string"), key.cast("string"))), 1, 6)


def weight_at(h: Column) -> Column:
    """The weight that a hash stands for; the most frequent weights are found first."""
    out = None
    for w, c in enumerate(poisson_cuts()):
        below = h < F.lit(f"{c:06x}")
        out = F.when(below, w) if out is None else out.when(below, w)
    return out.otherwise(len(poisson_cuts()))


def weight(key: Column, replicate: Column) -> Column:
    """The row's weight in a resample."""
    return weight_at(weight_hash(key, replicate))


def _metrics(prefix: str) -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(f"{prefix}_{x}") for x in ("tp", "fp", "fn", "tn"))

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))

    precision, recall = share(tp, tp + fp), share(tp, tp + fn)
    both = precision + recall
    return {
        "accuracy": share(tp + tn, tp + fp + fn + tn),
        "precision": precision,
        "recall": recall,
        "f1_score": F.when(both > 0, 2 * precision * recall / both).otherwise(F.lit(0.0)),
    }


def replicate_metrics(df: DataFrame, current: str, candidate: str, label: str = LABEL, key: str = KEY, b: int = REPLICATES) -> DataFrame:
    """replicate (0: the rows as they are) and the metrics of both models in it: b + 1 rows.

    A row costs one hash a resample, and one sum: weights are summed by cell (label and both predictions), and the
    counts of both models follow from the cells.  Rows are dealt out evenly first, since each of them stands for b."""
    rows = df.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & F.col(current).isNotNull() & F.col(candidate).isNotNull())

    def side(c: str) -> Column:  # 0, 1, or 2 for what is neither
        return F.when(F.col(c) == 1, 1).when(F.col(c) == 0, 0).otherwise(2)

    rows = rows.select(F.col(key).cast("string").alias("key"), (side(label) * 9 + side(current) * 3 + side(candidate)).alias("cell"))
    rows = rows.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.select("key", "cell", F.explode(F.sequence(F.lit(0), F.lit(b))).alias("replicate"))
    rows = rows.select("replicate", "cell", weight_hash(F.col("key"), F.col("replicate")).alias("h"))
    w = F.when(F.col("replicate") == 0, 1).otherwise(weight_at(F.col("h")))
    cells = rows.groupBy("replicate", "cell").agg(F.sum(w).alias("w"))  # 27 cells a replicate at most
    real, said = F.floor(F.col("cell") / 9), {"a": F.floor(F.col("cell") / 3) % 3, "b": F.col("cell") % 3}
    sums = []
    for side_, p in said.items():
        for name, s, r in (("tp", 1, 1), ("fp", 1, 0), ("fn", 0, 1), ("tn", 0, 0)):
            sums.append(F.coalesce(F.sum(F.when((p == s) & (real == r), F.col("w"))), F.lit(0)).alias(f"{side_}_{name}"))
    counted = cells.groupBy("replicate").agg(*sums, F.sum("w").alias("w")).filter("w > 0")
    a, c = _metrics("a"), _metrics("b")
    return counted.select("replicate", *[a[m].alias(f"a_{m}") for m in METRICS], *[c[m].alias(f"b_{m}") for m in METRICS])


def compare_predictions(
    df: DataFrame, current: str, candidate: str, label: str = LABEL, key: str = KEY, b: int = REPLICATES, confidence: float = CONFIDENCE
) -> DataFrame:
    """A row for each metric: current, candidate, difference, the bounds ``low`` and ``high`` of its interval, and whether it
    lies on one side of 0.  ``df`` has a row for each key with the label (0/1) and both predictions (0/1); rows where one of
    them is NULL take no part.  Without rows there is no metric."""
    replicates = replicate_metrics(df, current, candidate, label, key, b)
    stacked = replicates.select(
        "replicate",
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"a_{m}").alias("a"), F.col(f"b_{m}").alias("b")) for m in METRICS])).alias("m"),
    ).select("replicate", "m.metric", "m.a", "m.b")
    drawn = F.col("replicate") > 0
    ordered = F.array_sort(F.collect_list(F.when(drawn, F.col("b") - F.col("a"))))  # b values
    outside = round((1 - confidence) / 2 * b, 9)  # resamples beyond a bound
    first, last = max(1, math.ceil(outside)), min(b, math.floor(b - outside) + 1)
    real = ~drawn
    out = stacked.groupBy("metric").agg(
        F.max(F.when(real, F.col("a"))).alias("current"),
        F.max(F.when(real, F.col("b"))).alias("candidate"),
        F.max(F.when(real, F.col("b") - F.col("a"))).alias("difference"),
        ordered.alias("_d"),
    )
    low, high = F.get("_d", F.lit(first - 1)), F.get("_d", F.least(F.lit(last), F.size("_d")) - 1)
    rounded = {c: F.round(F.col(c), REPORT_DIGITS) for c in ("current", "candidate", "difference")}
    return out.select(
        "metric", *[rounded[c].alias(c) for c in rounded], F.round(low, REPORT_DIGITS).alias("low"), F.round(high, REPORT_DIGITS).alias("high"),
        ((low > 0) | (high < 0)).alias("significant"),
    )
