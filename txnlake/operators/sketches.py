"""Stored sketches: distinct and unscored keys, and drift by quantiles, without reading rows again.

*Theta sketches* of keys are kept per month of a layer and per batch of the predictions.  Their
union estimates a layer's distinct keys, the difference of two unions the keys that one has and the
other lacks: "still unscored" without a join.  The error bound comes with the estimate.

*KLL sketches* of the features are made in one pass over a period.  Ranks from two periods' sketches give the
Kolmogorov-Smirnov distance and a stability index over bins of equal frequency, which an outlier doesn't
move: it is one value among many, wherever it lies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.operators.panel_state import BatchPartials
from txnlake.schemas import FEATURES, KEY, PARTITION_COLS
from txnlake.session import checkpoint_dir
from txnlake.sinks.layers import write_layer
from txnlake.sources.layers import read_or_empty

#: log2 of the hashes that a theta sketch keeps: 32 KB, 1.6 % standard error.
LG_K = 12
#: Standard errors that a bound stands for.
DEVIATIONS = 4
#: Size of a KLL sketch; its rank error is below ``KLL_ERROR`` (2.296 / k^0.9021, for 99 % of the ranks asked).
KLL_K = 2000
KLL_ERROR = 2.296 / KLL_K**0.9021
DRIFT_BINS = 10
RANKS = 200


# --- keys ---------------------------------------------------------------------------
def key_sketches(df: DataFrame, by: list[str], key: str = KEY, lg_k: int = LG_K) -> DataFrame:
    """``by`` and the sketch of the keys there: one aggregate that merges map-side, no key is shuffled."""
    return df.groupBy(*by).agg(F.theta_sketch_agg(F.col(key), lg_k).alias("sketch"))


def write_key_sketches(df: DataFrame, path: str, touched_only: bool = False, key: str = KEY) -> None:
    """A layer's sketches by month; ``touched_only`` replaces those of the months in ``df``."""
    write_layer(key_sketches(df, PARTITION_COLS, key), path, touched_only=touched_only)


def read_key_sketches(spark: SparkSession, path: str) -> DataFrame:
    """The stored sketches of a layer; none if it had no rows."""
    return read_or_empty(spark, path, T.StructType([*(T.StructField(c, T.IntegerType()) for c in PARTITION_COLS), T.StructField("sketch", T.BinaryType())]))


class KeySketches(BatchPartials):
    """The sketches of the predictions' batches, kept up to date like the panels."""

    kinds = {"keys": lambda rows: key_sketches(rows, ["batch_id"])}

    def sketches(self) -> DataFrame:
        found = self._read("keys", self._state()["folders"].get("keys"))
        return key_sketches(self._rows([]), ["batch_id"]) if found is None else found


def union(sketches: DataFrame, name: str = "sketch", lg_k: int = LG_K) -> DataFrame:
    """One row: the sketch of all keys."""
    return sketches.agg(F.theta_union_agg("sketch", lg_k).alias(name))


def _estimate(sketch: Column) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")


def distinct_keys(sketches: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """estimate and bound: the distinct keys lie within ``bound`` of it (``DEVIATIONS`` standard errors; exact below 2^lg_k keys)."""
    found = union(sketches, lg_k=lg_k).select(_estimate(F.col("sketch")).alias("estimate"))
    rse = 1 / math.sqrt((1 << lg_k) - 1)
    bound = F.when(F.col("estimate") < (1 << lg_k), 0).otherwise(F.ceil(DEVIATIONS * rse * F.col("estimate")))
    return found.select("estimate", bound.cast("long").alias("bound"))


def missing_keys(having: DataFrame, lacking: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """estimate and bound of the keys that ``having`` holds and ``lacking`` doesn't, from their sketches alone.

    A difference keeps the hashes below the smaller sample's limit, so its error follows the larger set."""
    both = union(having, "a", lg_k).join(union(lacking, "b", lg_k))  # one row each
    more = F.when(F.col("a").isNull(), F.lit(0)).when(F.col("b").isNull(), _estimate(F.col("a"))).otherwise(
        _estimate(F.theta_difference(F.col("a"), F.col("b")))
    )
    sizes = F.greatest(_estimate(F.col("a")), _estimate(F.col("b")))
    found = both.select(more.cast("long").alias("estimate"), sizes.alias("size"))
    rse = 1 / math.sqrt((1 << lg_k) - 1)
    # A share p of the keys is missing: its sample of about 2^lg_k hashes has sqrt(p) of the relative error of a whole one.
    spread = DEVIATIONS * rse * F.sqrt((F.col("estimate") + 1) * F.col("size"))
    bound = F.when(F.col("size") < (1 << lg_k), 0).otherwise(F.ceil(spread))
    return found.select("estimate", bound.cast("long").alias("bound"))


# --- quantiles ------------------------------------------------------------------------
def feature_sketches(df: DataFrame, features: list[str] = FEATURES, k: int = KLL_K) -> DataFrame:
    """One row: for each feature the KLL sketch of its values (NULL and NaN apart) and their number.  One pass."""
    out = []
    for f in features:
        x = F.col(f).cast("double")
        x = F.when(~F.isnan(x), x)
        out += [F.kll_sketch_agg_double(x, k).alias(f"s_{f}"), F.count(x).alias(f"n_{f}")]
    return df.agg(*out)


def quantile_drift(baseline: DataFrame, current: DataFrame, features: list[str] = FEATURES, bins: int = DRIFT_BINS) -> DataFrame:
    """A row for each feature with values in both periods (from ``feature_sketches`` of each): feature, ks (the
    Kolmogorov-Smirnov distance), psi over bins of equal frequency in the baseline, status, and the error of ks."""
    checkpoint_dir(baseline.sparkSession)
    one, two = (df.toDF(*[f"{p}{c}" for c in df.columns]) for df, p in ((baseline, "b_"), (current, "c_")))
    both = one.join(two).checkpoint(eager=True)  # one row each
    quantile, rank = F.kll_sketch_get_quantile_double, F.kll_sketch_get_rank_double
    at = F.array(*[F.lit(i / RANKS) for i in range(RANKS + 1)])
    cuts = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    asked = []
    for f in features:
        b, c = F.col(f"b_s_{f}"), F.col(f"c_s_{f}")
        known = (F.col(f"b_n_{f}") > 0) & (F.col(f"c_n_{f}") > 0)
        values = F.struct(F.array_distinct(F.concat(quantile(b, at), quantile(c, at))).alias("grid"), F.array_sort(F.array_distinct(quantile(b, cuts))).alias("edges"))
        asked.append(F.when(known, values).alias(f))
    # Ranks can be asked for constants only: some hundred values a feature.
    places = both.select(*asked).first().asDict()
    parts = []
    for f in features:
        if places[f] is not None:
            grid, edges = (F.array(*[F.lit(float(x)) for x in places[f][k]]) for k in ("grid", "edges"))
            ranks = [rank(F.col(f"{side}_s_{f}"), xs).alias(f"{kind}{side}") for kind, xs in (("r", grid), ("e", edges)) for side in "bc"]
            parts.append(F.struct(F.lit(f).alias("feature"), *ranks))
    if not parts:
        return both.sparkSession.createDataFrame([], "feature string, ks double, psi double, status string, ks_error double")
    rows = both.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
    ks = F.array_max(F.zip_with("rb", "rc", lambda x, y: F.abs(x - y)))

    def shares(ranks: str) -> Column:
        upper, lower = F.concat(F.col(ranks), F.array(F.lit(1.0))), F.concat(F.array(F.lit(0.0)), F.col(ranks))
        return F.zip_with(upper, lower, lambda x, y: F.greatest(x - y, F.lit(1e-4)))

    terms = F.zip_with(shares("eb"), shares("ec"), lambda p, q: (q - p) * F.log(q / p))
    rows = rows.select("feature", ks.alias("ks"), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x).alias("psi"))
    status = F.when(F.col("psi") < 0.1, "stable").when(F.col("psi") < 0.25, "moderate").otherwise("shifted")
    return rows.select("feature", "ks", "psi", status.alias("status"), F.lit(2 * KLL_ERROR + 1 / RANKS).alias("ks_error"))
