"""
feature drift between two periods (X4)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake.schemas import FEATURES, KEY

Z_THRESHOLD = 3.0
REPORT_DIGITS = 6  # reported statistics are rounded to 6 decimals
DRIFT_BINS = 10
DRIFT_EPSILON = 1e-4  # share given to an empty bin so the log stays finite


# A key holding more than this share of all rows is "hot".  At most
# 1 / HOT_KEY_SHARE keys can be hot, which bounds what is broadcast.
HOT_KEY_SHARE = 1e-3
_HOT_SPREAD = 4096  # tasks the hot rows are spread over in the shuffled join


def join_per_key_stats(rows: DataFrame, stats: DataFrame, key: str, spread_by: str, hot_share: float = HOT_KEY_SHARE) -> DataFrame:
    """Left-join per-key statistics (one row per key, with its row count
    ``n``) onto ``rows`` without letting one key's rows meet in one task.

    AQE cannot split this join's skew: the statistics side is an aggregate on
    the join key, so no exchange is left to split.  Instead hot keys (more
    than ``hot_share`` of all rows, so at most ``1 / hot_share`` of them) are
    joined map-side against a broadcast of their statistics, and for the
    shuffled join of the remaining keys their rows carry a salted key that
    matches nothing and spreads them over ``_HOT_SPREAD`` tasks.  ``stats``
    is checkpointed so the counting passes do not re-aggregate ``rows``.
    """
    from txnlake.session import checkpoint_dir

    spark = rows.sparkSession
    checkpoint_dir(spark)
    stats = stats.checkpoint(eager=True)
    total = stats.agg(F.sum("n")).first()[0] or 0
    bound = int(1 / hot_share)
    hot_rows = stats.filter(F.col("n") > F.lit(total * hot_share)).limit(bound + 1).collect()
    value_cols = [c for c in stats.columns if c != key]
    if not hot_rows:
        # Same column order as the split path: the input's columns, then the stats.
        return rows.join(stats, key, "left").select(*rows.columns, *value_cols)
    hot = F.broadcast(spark.createDataFrame(hot_rows, stats.schema).select(key, *[F.col(c).alias(f"_h_{c}") for c in value_cols]))
    tagged = rows.join(hot, key, "left")
    is_hot = F.col(f"_h_{value_cols[0]}").isNotNull() if value_cols else F.lit(False)
    jk = "_join_key"
    salted = F.concat(F.lit("\u0000hot:"), F.pmod(F.xxhash64(F.col(spread_by)), F.lit(_HOT_SPREAD)).cast("string"))
    left = tagged.withColumn(jk, F.when(is_hot, salted).otherwise(F.col(key).cast("string")))
    cold = stats.select(F.col(key).cast("string").alias(jk), *[F.col(c).alias(f"_c_{c}") for c in value_cols])
    joined = left.join(cold, jk, "left")
    return joined.select(
        *[F.col(c) for c in rows.columns],
        *[F.coalesce(F.col(f"_h_{c}"), F.col(f"_c_{c}")).alias(c) for c in value_cols],
    )


def amount_anomalies(
    df: DataFrame,
    customer: str = "cc_num",
    value: str = "amt",
    threshold: float = Z_THRESHOLD,
    key: str = KEY,
    hot_share: float = HOT_KEY_SHARE,
) -> DataFrame:
    """Each transaction's z-score against its customer's mean and sample
    standard deviation; ``is_anomaly`` when ``|z| > threshold``.

    Per-customer statistics are a grouped aggregate (combined map-side, one
    row per customer), joined back by ``join_per_key_stats``, not a window
    partitioned by customer, which would put a customer holding a third of
    all rows into one task.  Customers with one transaction, or constant
    amounts, get no z-score.
    """
    valid = df.filter(F.col(customer).isNotNull() & F.col(value).isNotNull())
    stats = valid.groupBy(customer).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(value).alias("_mean"),
        F.stddev_samp(value).alias("_std"),
    )
    j = join_per_key_stats(valid.select(key, customer, value), stats, customer, spread_by=key, hot_share=hot_share)
    z = F.when(F.col("_std") > 0, (F.col(value) - F.col("_mean")) / F.col("_std"))
    return j.select(
        key,
        customer,
        value,
        F.round(F.col("_mean"), REPORT_DIGITS).alias("customer_mean"),
        F.round(F.col("_std"), REPORT_DIGITS).alias("customer_std"),
        F.round(z, REPORT_DIGITS).alias("z_score"),
        F.coalesce(F.abs(z) > F.lit(threshold), F.lit(False)).alias("is_anomaly"),
    )


# --- against the past only ---------------------------------------------------------
#: Earlier transactions a customer must have before one is judged.
MIN_HISTORY = 5
#: Amounts are summed exactly, to 1/10,000; squares to 10^-8.
_AMOUNT = "decimal(18,4)"


def past_anomalies(
    df: DataFrame,
    customer: str = "cc_num",
    value: str = "amt",
    at: str = "trans_date_trans_time",
    chunk: str = "hour",
    threshold: float = Z_THRESHOLD,
    min_history: int = MIN_HISTORY,
    key: str = KEY,
) -> DataFrame:
    """Each transaction's z-score against its customer's *earlier* ones (by time, then key).

    Two levels instead of a window over a customer, who may hold a third of all rows:
    time is cut into chunks; sums of each (customer, chunk) are a partial aggregate, running
    totals go over a customer's chunks (as many as there are chunks of time, whatever the
    number of rows), and only within a (customer, chunk) are rows put in order.  Sums are exact
    decimals, so the totals of the levels add up to those of one window.  Rows without a
    customer, an amount or a time have no place in the order and are left out."""
    rows = df.filter(F.col(customer).isNotNull() & F.col(value).isNotNull() & F.col(at).isNotNull())
    x = F.col(value).cast(_AMOUNT)
    rows = rows.select(key, customer, value, at, F.date_trunc(chunk, F.col(at)).alias("_chunk"), x.alias("_x"), (x * x).alias("_xx"))
    sums = rows.groupBy(customer, "_chunk").agg(F.count(F.lit(1)).alias("n"), F.sum("_x").alias("s"), F.sum("_xx").alias("ss"))
    before = Window.partitionBy(customer).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    totals = sums.select(customer, "_chunk", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in ("n", "s", "ss")])
    within = Window.partitionBy(customer, "_chunk").orderBy(at, key).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({"_n1": F.count(F.lit(1)).over(within), "_s1": F.sum("_x").over(within), "_ss1": F.sum("_xx").over(within)})
    rows = rows.join(totals, [customer, "_chunk"])
    n = F.col("_n") + F.col("_n1")
    s = (F.col("_s") + F.coalesce("_s1", F.lit(0))).cast("double")
    ss = (F.col("_ss") + F.coalesce("_ss1", F.lit(0))).cast("double")
    rows = rows.select(key, customer, value, at, n.alias("past"), s.alias("_s"), ss.alias("_ss"))
    enough = F.col("past") >= max(2, min_history)
    mean = F.col("_s") / F.col("past")
    variance = (F.col("_ss") - F.col("_s") * F.col("_s") / F.col("past")) / (F.col("past") - 1)
    rows = rows.withColumns({"_mean": F.when(enough, mean), "_std": F.when(enough, F.sqrt(F.greatest(variance, F.lit(0.0))))})
    z = F.when(F.col("_std") > 0, (F.col(value) - F.col("_mean")) / F.col("_std"))
    return rows.select(
        key,
        customer,
        value,
        "past",
        F.round("_mean", REPORT_DIGITS).alias("past_mean"),
        F.round("_std", REPORT_DIGITS).alias("past_std"),
        F.round(z, REPORT_DIGITS).alias("z_score"),
        F.coalesce(F.abs(z) > F.lit(threshold), F.lit(False)).alias("is_anomaly"),
    )


def _stacked(df: DataFrame, features: list[str]) -> DataFrame:
    """(feature, value) rows: one narrow projection, no shuffle."""
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in features])
        ).alias("s")
    ).select("s.feature", "s.x")


def feature_drift(
    baseline: DataFrame,
    current: DataFrame,
    features: list[str] = FEATURES,
    bins: int = DRIFT_BINS,
) -> DataFrame:
    """Population stability index per feature: equal-width bins over the
    baseline's range (values outside fall in the end bins), then
    ``sum((c - b) * ln(c / b))`` over bin shares, empty bins given
    ``DRIFT_EPSILON``.

    Two aggregates: the baseline range (2 scalars per feature, one row), and
    the bin counts of both periods (at most ``features x bins`` rows per
    period), so nothing larger than a few hundred rows is ever combined.
    """
    rng = baseline.agg(
        *[F.min(F.col(f).cast("double")).alias(f"lo_{f}") for f in features],
        *[F.max(F.col(f).cast("double")).alias(f"hi_{f}") for f in features],
    ).first()

    lo_of = F.create_map(*chain.from_iterable((F.lit(f), F.lit(rng[f"lo_{f}"]).cast("double")) for f in features))
    hi_of = F.create_map(*chain.from_iterable((F.lit(f), F.lit(rng[f"hi_{f}"]).cast("double")) for f in features))

    def binned(df: DataFrame, period: str) -> DataFrame:
        s = _stacked(df, features).filter(F.col("x").isNotNull())
        lo, hi = lo_of[F.col("feature")], hi_of[F.col("feature")]
        width = hi - lo
        idx = F.when(width > 0, F.floor((F.col("x") - lo) / width * bins)).otherwise(F.lit(0))
        b = F.least(F.greatest(idx, F.lit(0)), F.lit(bins - 1)).cast("int")
        counts = s.groupBy("feature", b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        # Shares over the aggregated counts (<= features x bins rows), no second scan.
        total = F.sum("n").over(Window.partitionBy("feature"))
        return counts.select("feature", "bin", (F.col("n") / total).alias(f"share_{period}"))

    b, c = binned(baseline, "base"), binned(current, "cur")
    eps = F.lit(DRIFT_EPSILON)
    j = b.join(c, ["feature", "bin"], "full_outer").select(
        "feature",
        "bin",
        F.coalesce(F.col("share_base"), eps).alias("pb"),
        F.coalesce(F.col("share_cur"), eps).alias("pc"),
    )
    term = (F.col("pc") - F.col("pb")) * F.log(F.col("pc") / F.col("pb"))
    # Terms are added in bin order, so the sum is the same on every layout.
    return j.groupBy("feature").agg(
        F.round(
            F.aggregate(
                F.array_sort(F.collect_list(F.struct(F.col("bin"), term.alias("t")))),
                F.lit(0.0),
                lambda acc, x: acc + x["t"],
            ),
            REPORT_DIGITS,
        ).alias("psi")
    )


def drift_report(baseline: DataFrame, current: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """PSI per feature with the usual reading: < 0.1 stable, < 0.25 moderate, else shifted."""
    return feature_drift(baseline, current, features).withColumn(
        "status",
        F.when(F.col("psi") < 0.1, "stable").when(F.col("psi") < 0.25, "moderate").otherwise("shifted"),
    )

