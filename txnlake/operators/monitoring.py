"""Monitoring reports over the predictions table (the monitoring panels).

Each panel is one aggregate or top-k plan; only aggregates and bounded
top-k results ever leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.functions import formatting as fmt
from txnlake.schemas import KEY

PRED = "fraud_prediction"
PROB = "fraud_probability"
TS = "inference_timestamp"

# Fixed values of the reports.
FILTER_CHOICES = ("All", "Fraud Only", "Non Fraud Only")
MAP_MAX_PROBABILITY = 0.90  # strictly below
MAP_MAX_AMOUNT = 5000  # strictly below
MAP_CAP = 3000
MAP_SEED = 42
TOP_RISK_N = 20
TOP_RISK_COLUMNS = [
    "trans_num",
    "amt",
    "customer_age",
    "transaction_hour",
    "customer_merchant_distance",
    "fraud_probability",
    "fraud_prediction",
]
MAP_COLUMNS = [
    "trans_num",
    "lat",
    "long",
    "amt",
    "fraud_probability",
    "customer_age",
    "transaction_hour",
    "customer_merchant_distance",
]
PROBABILITY_BINS = 40
DISTANCE_BINS = 50
PREVIEW_ROWS = 100


# --- filters ---------------------------------------------------------------


def by_prediction(df: DataFrame, which: str = "All") -> DataFrame:
    """Sidebar filter: All / Fraud Only / Non Fraud Only."""
    if which not in FILTER_CHOICES:
        raise ValueError(f"which must be one of {FILTER_CHOICES}")
    if which == "Fraud Only":
        return df.filter(F.col(PRED) == 1)
    if which == "Non Fraud Only":
        return df.filter(F.col(PRED) == 0)
    return df


def fraud_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col(PRED) == 1)


def map_filter(df: DataFrame) -> DataFrame:
    """Frauds worth plotting: below the probability and amount cut-offs."""
    return fraud_only(df).filter((F.col(PROB) < MAP_MAX_PROBABILITY) & (F.col("amt") < MAP_MAX_AMOUNT))


def drop_null_coords(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["lat", "long"])


def seeded_sample(df: DataFrame, n: int, seed: int = MAP_SEED, key: str = KEY) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones on every run and layout.

    Rows are ranked by a hash of (key, seed); the top-n is a
    ``TakeOrderedAndProject``: each task keeps n candidates, one task merges
    them, so nothing larger than n x tasks rows meets in one place.
    ``DataFrame.sample`` is neither exact nor stable across partitionings.
    """
    return df.orderBy(sample_order(seed, key), F.col(key)).limit(n)


def sample_order(seed: int = MAP_SEED, key: str = KEY):
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))


def map_points(df: DataFrame, cap: int = MAP_CAP, seed: int = MAP_SEED) -> DataFrame:
    """The map's points: only the columns it plots or shows, so the scan reads
    just those."""
    return seeded_sample(drop_null_coords(map_filter(df)).select(*MAP_COLUMNS), cap, seed)


# --- aggregates -----------------------------------------------------------


# Sums of doubles depend on the order partitions are combined in; these
# report sums go through exact decimals so every run and cluster layout
# gives the same bits.  18 digits keep Spark on its long-backed decimal
# arithmetic: money to 1/10,000 (up to 10^14), probabilities to 10^-12.
AMOUNT_DECIMAL = "decimal(18,4)"
PROBABILITY_DECIMAL = "decimal(18,12)"


def exact_sum(c, decimal_type: str):
    return F.sum(c.cast(decimal_type)).cast("double")


def kpis(df: DataFrame) -> DataFrame:
    """Total, frauds, rate in %, fraud amount, mean score: one aggregate.
    Empty input gives 0 counts, NULL rate/mean and a 0 amount."""
    is_f = F.col(PRED) == 1
    total = F.count(F.lit(1))
    frauds = F.count_if(is_f)
    return df.agg(
        total.alias("total_transactions"),
        frauds.alias("fraud_transactions"),
        F.try_divide(frauds * F.lit(100.0), total).alias("fraud_rate"),
        F.coalesce(exact_sum(F.when(is_f, F.col("amt")), AMOUNT_DECIMAL), F.lit(0.0)).alias("fraud_amount"),
        F.try_divide(exact_sum(F.col(PROB), PROBABILITY_DECIMAL), F.count(F.col(PROB)).cast("double")).alias(
            "avg_probability"
        ),
    )


def format_kpis(k: DataFrame) -> DataFrame:
    """Display strings for the KPI row: '1,234', '12.34%', '$1,234.56', '0.1234'."""
    return k.select(
        fmt.thousands(F.col("total_transactions")).alias("transactions"),
        fmt.thousands(F.col("fraud_transactions")).alias("frauds"),
        fmt.percent(F.col("fraud_rate")).alias("fraud_rate"),
        fmt.money(F.col("fraud_amount")).alias("fraud_amount"),
        fmt.fixed(F.col("avg_probability")).alias("avg_fraud_score"),
    )


def distribution(df: DataFrame) -> DataFrame:
    """Rows per predicted class, labelled; NULL classes dropped as the
    original grouping did."""
    return (
        df.filter(F.col(PRED).isNotNull())
        .groupBy(PRED)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(fmt.recode(F.col(PRED), fmt.PREDICTION_LABELS).alias("fraud"), "count")
        .orderBy(F.desc("count"), "fraud")
    )


def by_hour(df: DataFrame) -> DataFrame:
    """Predicted frauds per hour of day; hours without frauds are absent."""
    return (
        fraud_only(df)
        .filter(F.col("transaction_hour").isNotNull())
        .groupBy("transaction_hour")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("transaction_hour")
    )


def by_flag(df: DataFrame, flag: str, labels: dict | None = None) -> DataFrame:
    """Rows per value of a 0/1 flag, labelled."""
    labels = labels or {}
    return (
        df.filter(F.col(flag).isNotNull())
        .groupBy(flag)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(fmt.recode(F.col(flag), labels).alias(flag), "count")
    )


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Equal-width histogram of ``col``: non-empty bins with their edges.

    Bin i covers [lo + i*w, lo + (i+1)*w); the top edge ``hi`` falls in the
    last bin.  When the range is not given it is taken from one aggregate
    (two scalars) over the data.  NULL and NaN have no place on the axis and
    are not counted.
    """
    x = F.col(col)
    df = df.filter(x.isNotNull() & ~F.isnan(x))
    if lo is None or hi is None:
        r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
        lo = r["lo"] if lo is None else lo
        hi = r["hi"] if hi is None else hi
    if lo is None or hi is None:  # empty input or all NULL
        return df.sparkSession.createDataFrame(
            [], "bin int, bin_start double, bin_end double, count long"
        )
    lo, hi = float(lo), float(hi)
    return with_edges(df.groupBy(bin_of(x, lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("count")), lo, hi, bins)


def bin_of(x, lo: float, hi: float, bins: int):
    """The equal-width bin of a value between ``lo`` and ``hi``."""
    if hi > lo and (hi - lo) / bins > 0:
        return F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(bins)), F.lit(bins - 1)).cast("int")
    return F.lit(0)


def with_edges(counts: DataFrame, lo: float, hi: float, bins: int) -> DataFrame:
    width = (hi - lo) / bins
    return counts.select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_start"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
        "count",
    )


def pipeline_status(df: DataFrame) -> DataFrame:
    """Rows processed, fraud alerts, last inference time (and its display)."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_processed"),
        F.count_if(F.col(PRED) == 1).alias("fraud_alerts"),
        F.max(TS).alias("last_inference"),
    ).withColumn("last_inference_display", fmt.minute_stamp(F.col("last_inference")))


# --- top-k ----------------------------------------------------------------


def top_risk(df: DataFrame, n: int = TOP_RISK_N) -> DataFrame:
    return df.orderBy(F.desc(PROB), F.col(KEY)).limit(n).select(*TOP_RISK_COLUMNS)


def latest(df: DataFrame, n: int = 20) -> DataFrame:
    return df.orderBy(F.desc(TS), F.col(KEY)).limit(n)


def preview(df: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    return df.orderBy(F.col(KEY)).limit(n)


def recode_labels(df: DataFrame) -> DataFrame:
    """Per-row display labels of the three 0/1 columns."""
    return df.select(
        KEY,
        fmt.recode(F.col(PRED), fmt.PREDICTION_LABELS).alias("fraud_label"),
        fmt.recode(F.col("high_amount_flag"), fmt.AMOUNT_LABELS).alias("amount_label"),
        fmt.recode(F.col("night_transaction_flag"), fmt.TIME_LABELS).alias("time_label"),
    )


# --- all aggregate panels in one scan -------------------------------------------

_BIN = "_prob_bin"
_PANEL_KEYS = [PRED, "high_amount_flag", "night_transaction_flag", "transaction_hour", _BIN]


def _gid(*grouped: str) -> int:
    """grouping_id of a grouping set: bit set for every key *not* grouped."""
    n = len(_PANEL_KEYS)
    return sum(1 << (n - 1 - i) for i, k in enumerate(_PANEL_KEYS) if k not in grouped)


_PANEL_SETS = [[], [PRED], ["high_amount_flag"], ["night_transaction_flag"], ["transaction_hour"], [_BIN]]


def _is_fraud():
    return F.col(PRED) == 1


def _binned(df: DataFrame) -> DataFrame:
    bin_ = F.least(F.floor(F.col(PROB) * F.lit(PROBABILITY_BINS)), F.lit(PROBABILITY_BINS - 1)).cast("int")
    return df.withColumn(_BIN, bin_)


def panel_partials(df: DataFrame, by: str = "batch_id") -> DataFrame:
    """``panel_aggregates`` for each value of ``by``, in a form that merges: sums stay exact decimals, and the grand
    total has the range of the distances.  About 100 rows for each value."""
    x = F.col("customer_merchant_distance")
    known = F.when(~F.isnan(x), x)
    keys = [by, *_PANEL_KEYS]
    out = _binned(df).groupingSets([[by, *s] for s in _PANEL_SETS], *keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(_is_fraud()).alias("frauds"),
        F.sum(F.when(_is_fraud(), F.col("amt")).cast(AMOUNT_DECIMAL)).alias("fraud_amount"),
        F.sum(F.col(PROB).cast(PROBABILITY_DECIMAL)).alias("prob_sum"),
        F.count(F.col(PROB)).alias("prob_n"),
        F.max(TS).alias("last_ts"),
        F.min(known).alias("distance_lo"),
        F.max(known).alias("distance_hi"),
        F.grouping_id().alias("gid"),  # ``by`` is in every set: its bit, the highest, is 0
    )
    total = F.col("gid") == _gid()
    return out.withColumns({c: F.when(total, F.col(c)) for c in ("distance_lo", "distance_hi")})


def merged_partials(partials: DataFrame) -> DataFrame:
    """``panel_aggregates`` of the whole, from its parts' partials: a row of each set and value is summed up."""
    merged = partials.groupBy(*_PANEL_KEYS, "gid").agg(
        F.sum("n").alias("n"),
        F.sum("frauds").alias("frauds"),
        F.sum("fraud_amount").cast("double").alias("fraud_amount"),
        F.sum("prob_sum").cast("double").alias("prob_sum"),
        F.sum("prob_n").alias("prob_n"),
        F.max("last_ts").alias("last_ts"),
    )
    merged = merged.select(*_PANEL_KEYS, "n", "frauds", "fraud_amount", "prob_sum", "prob_n", "last_ts", "gid")
    if partials.isEmpty():
        return _no_rows(merged)
    return merged


def _no_rows(out: DataFrame) -> DataFrame:
    total = (None,) * len(_PANEL_KEYS) + (0, 0, None, None, 0, None, _gid())
    return out.sparkSession.createDataFrame([total], out.schema)


def panel_aggregates(df: DataFrame) -> DataFrame:
    """Every aggregate panel from one scan: a GROUPING SETS aggregate over
    (), prediction, amount flag, night flag, hour and probability bin.  The
    Expand feeds a map-side partial aggregate, so the shuffle carries a few
    rows per set and task, and the result has at most ~100 rows."""
    out = (
        _binned(df)
        .groupingSets(_PANEL_SETS, *_PANEL_KEYS)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(_is_fraud()).alias("frauds"),
            exact_sum(F.when(_is_fraud(), F.col("amt")), AMOUNT_DECIMAL).alias("fraud_amount"),
            exact_sum(F.col(PROB), PROBABILITY_DECIMAL).alias("prob_sum"),
            F.count(F.col(PROB)).alias("prob_n"),
            F.max(TS).alias("last_ts"),
            F.grouping_id().alias("gid"),
        )
    )
    # Spark returns no grand-total row for an empty input; SQL (and a
    # global aggregate) returns one.  Reading one row settles which case.
    if df.isEmpty():
        return _no_rows(out)
    return out


def panels_from_aggregates(agg: DataFrame) -> dict[str, DataFrame]:
    """The aggregate panels, each a filter + projection of ``panel_aggregates``
    (same columns and values as the one-panel functions above)."""

    def grp(*keys):
        g = agg.filter(F.col("gid") == _gid(*keys))
        for k in keys:
            g = g.filter(F.col(k).isNotNull())
        return g

    total = grp()
    kp = total.select(
        F.col("n").alias("total_transactions"),
        F.col("frauds").alias("fraud_transactions"),
        F.try_divide(F.col("frauds") * F.lit(100.0), F.col("n")).alias("fraud_rate"),
        F.coalesce(F.col("fraud_amount"), F.lit(0.0)).alias("fraud_amount"),
        F.try_divide(F.col("prob_sum"), F.col("prob_n").cast("double")).alias("avg_probability"),
    )
    width = 1.0 / PROBABILITY_BINS
    return {
        "kpis": kp,
        "kpis_display": format_kpis(kp),
        "distribution": grp(PRED)
        .select(fmt.recode(F.col(PRED), fmt.PREDICTION_LABELS).alias("fraud"), F.col("n").alias("count"))
        .orderBy(F.desc("count"), "fraud"),
        "probability_histogram": grp(_BIN).select(
            F.col(_BIN).alias("bin"),
            (F.lit(0.0) + F.col(_BIN) * F.lit(width)).alias("bin_start"),
            (F.lit(0.0) + (F.col(_BIN) + 1) * F.lit(width)).alias("bin_end"),
            F.col("n").alias("count"),
        ),
        "fraud_by_hour": grp("transaction_hour")
        .filter(F.col("frauds") > 0)
        .select("transaction_hour", F.col("frauds").alias("count"))
        .orderBy("transaction_hour"),
        "by_high_amount": grp("high_amount_flag").select(
            fmt.recode(F.col("high_amount_flag"), fmt.AMOUNT_LABELS).alias("high_amount_flag"), F.col("n").alias("count")
        ),
        "by_night": grp("night_transaction_flag").select(
            fmt.recode(F.col("night_transaction_flag"), fmt.TIME_LABELS).alias("night_transaction_flag"),
            F.col("n").alias("count"),
        ),
        "status": total.select(
            F.col("n").alias("rows_processed"),
            F.col("frauds").alias("fraud_alerts"),
            F.col("last_ts").alias("last_inference"),
            fmt.minute_stamp(F.col("last_ts")).alias("last_inference_display"),
        ),
    }


def monitoring(df: DataFrame, which: str = "All", one_pass: bool = True) -> dict[str, DataFrame]:
    """Every panel, after the sidebar filter (which applies to all of them).

    With ``one_pass`` the seven aggregate panels come from one GROUPING SETS
    scan, checkpointed (it is tiny) so that reading the panels does not scan
    the table again; the top-k panels and the distance histogram (whose
    range needs its own pass) scan on their own.
    """
    d = by_prediction(df, which)
    rest = {
        "map_points": map_points(d),
        "top_risk": top_risk(d),
        "distance_histogram": histogram(d, "customer_merchant_distance", DISTANCE_BINS),
        "preview": preview(d),
    }
    if one_pass:
        from txnlake.session import checkpoint_dir

        checkpoint_dir(d.sparkSession)
        return {**panels_from_aggregates(panel_aggregates(d).checkpoint(eager=True)), **rest}
    k = kpis(d)
    return {
        "kpis": k,
        "kpis_display": format_kpis(k),
        "distribution": distribution(d),
        "probability_histogram": histogram(d, PROB, PROBABILITY_BINS, 0.0, 1.0),
        "fraud_by_hour": by_hour(d),
        "by_high_amount": by_flag(d, "high_amount_flag", fmt.AMOUNT_LABELS),
        "by_night": by_flag(d, "night_transaction_flag", fmt.TIME_LABELS),
        "status": pipeline_status(d),
        **rest,
    }
