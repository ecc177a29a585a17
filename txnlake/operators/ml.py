"""Model operators on Spark ML: assemble, split, train, score, evaluate.

Training and scoring run on the executors (``Pipeline.fit`` or, of many rows,
``operators.forest.fit`` / ``PipelineModel.transform``); metrics are single
aggregates.  Nothing is converted to pandas.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlake.operators import forest as FOREST
from txnlake.schemas import FEATURES, KEY, LABEL

# Fixed model settings (100 trees, depth 10, seed 42, sqrt features per split).
NUM_TREES = 100
MAX_DEPTH = 10
SEED = 42
TEST_FRACTION = 0.2
FEATURES_COL = "features"

# Execution settings of the forest (not model settings: the fitted trees are
# identical): split more nodes per pass over the data, and derive each row's
# node ids in every pass.  Cached, they are 100 numbers a row in two copies,
# more than the row itself: three times the memory and, where that is short, the time.
FOREST_NODE_MEMORY_MB = 1024
FOREST_CACHE_NODE_IDS = False
# Beyond so many rows the forest is fitted by ``operators.forest``: the same method, in 14 bytes a row and a sixth of the task time.
SPARK_FIT_ROWS = 250_000

# Bucketing of the split hash: the first 5 hex digits -> 2^20 buckets.
_SPLIT_HEX_DIGITS = 5
# Most classes a label may have before the split's per-class table is joined
# by shuffle instead of broadcast.
_MAX_BROADCAST_CLASSES = 10_000


# --- frames ---------------------------------------------------------------


def select_features(df: DataFrame, key: str = KEY) -> DataFrame:
    """Key + the 13 model inputs (pruned down to the scan)."""
    return df.select(key, *FEATURES)


def select_training(df: DataFrame) -> DataFrame:
    """The 13 model inputs + the label."""
    return df.select(*FEATURES, LABEL)


def _any_null(cols: list[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull() | F.isnan(F.col(c).cast("double"))
    return cond


def clean_training(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with a NULL (or NaN) in any model column."""
    return df.dropna(subset=cols or [*FEATURES, LABEL])


def split_scorable(df: DataFrame, features: list[str] = FEATURES) -> tuple[DataFrame, DataFrame]:
    """(rows the model can score, rows with a NULL/NaN feature).

    The assembler would fail the whole job on one such row; training drops
    them, so scoring sets them aside for the quality report instead.
    """
    bad = _any_null(features)
    return df.filter(~bad), df.filter(bad)


def null_feature_count(features: list[str] = FEATURES) -> Column:
    n = F.lit(0)
    for c in features:
        n = n + F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), 1).otherwise(0)
    return n


def assembler(features: list[str] = FEATURES) -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=FEATURES_COL, handleInvalid="error")


def assemble(df: DataFrame, key: str = KEY, features: list[str] = FEATURES) -> DataFrame:
    """Key (and label when present) beside the feature vector: the key never
    enters the model but stays on the row."""
    keep = [c for c in (key, LABEL) if c in df.columns]
    return assembler(features).transform(df).select(*keep, FEATURES_COL)


# --- split ------------------------------------------------------------------


def _split_hash(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))


def stratified_split(
    df: DataFrame,
    test_fraction: float = TEST_FRACTION,
    seed: int = SEED,
    label: str = LABEL,
    key: str = KEY,
) -> DataFrame:
    """Adds ``is_test``: per class, exactly ``ceil(test_fraction * n_class)``
    rows go to test -- those ranked first by (md5(key || seed), key).

    Exact and repeatable, unlike ``sampleBy``, and without a window over a
    whole class (a class can be most of the data).  A histogram of the hash's
    first 5 hex digits (one partial aggregate, at most 2^20 rows per class) has
    running totals that locate, per class, the one bucket the cut falls in; a
    second aggregate over that bucket counts its distinct (hash, key) pairs, and
    their running totals give the exact threshold.  The split itself is one
    narrow pass: test rows are those at or below their class's threshold.

    Keys are expected unique (the training frame comes from Gold, which is
    deduplicated on the key).  Copies of one key go to the same side, so a copied
    key at the cut can make the test part larger by its copies; they are counted,
    never ranked, so a hot key is no hot task.
    """
    h = _split_hash(key, seed)
    bucket = F.conv(F.substring(F.col("_h"), 1, _SPLIT_HEX_DIGITS), 16, 10).cast("long")
    d = df.select(label, F.col(key).cast("string").alias("_key"), h.alias("_h")).withColumn("_b", bucket)
    counts = d.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w_run = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy(label)
    cut = (
        counts.withColumn("_before", F.coalesce(F.sum("_n").over(w_run), F.lit(0)))
        .withColumn("_k", F.ceil(F.sum("_n").over(w_all) * F.lit(test_fraction)).cast("long"))
        .filter((F.col("_before") < F.col("_k")) & (F.col("_before") + F.col("_n") >= F.col("_k")))
        .select(F.col(label).alias("_class"), F.col("_b").alias("_cut_b"), "_before", "_k")
    )
    # One row per class, computed once and size-checked before the broadcast;
    # beyond the bound it stays a distributed frame joined by shuffle.
    cut = _small(df, cut)
    in_bucket = d.join(cut, d[label].eqNullSafe(F.col("_class")) & (F.col("_b") == F.col("_cut_b")))
    pairs = in_bucket.groupBy("_class", "_before", "_k", "_h", "_key").agg(F.count(F.lit(1)).alias("_n"))
    w_cut = Window.partitionBy("_class").orderBy("_h", "_key").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_before") + F.coalesce(F.sum("_n").over(w_cut), F.lit(0))
    edge = pairs.withColumn("_below", below).filter(F.col("_below") < F.col("_k"))
    edge = _small(df, edge.groupBy("_class").agg(F.max(F.struct("_h", "_key")).alias("_edge")))
    rows = df.withColumn("_h", h)
    j = rows.join(edge, rows[label].eqNullSafe(F.col("_class")), "left")
    is_test = F.coalesce(F.struct(F.col("_h"), F.col(key).cast("string").alias("_key")) <= F.col("_edge"), F.lit(False))
    return j.select(*[rows[c] for c in df.columns], is_test.alias("is_test"))


def _small(df: DataFrame, per_class: DataFrame) -> DataFrame:
    rows = per_class.limit(_MAX_BROADCAST_CLASSES + 1).collect()
    if len(rows) > _MAX_BROADCAST_CLASSES:
        return per_class
    return F.broadcast(df.sparkSession.createDataFrame(rows, per_class.schema))


# --- train / score --------------------------------------------------------


def forest(
    num_trees: int = NUM_TREES,
    max_depth: int = MAX_DEPTH,
    seed: int = SEED,
    weight_col: str | None = None,
) -> RandomForestClassifier:
    rf = RandomForestClassifier(
        featuresCol=FEATURES_COL,
        labelCol=LABEL,
        numTrees=num_trees,
        maxDepth=max_depth,
        seed=seed,
        featureSubsetStrategy="sqrt",
        maxMemoryInMB=FOREST_NODE_MEMORY_MB,
        cacheNodeIds=FOREST_CACHE_NODE_IDS,
    )
    if weight_col:
        rf = rf.setWeightCol(weight_col)
    return rf


def with_balanced_weights(df: DataFrame, label: str = LABEL, col: str = "class_weight") -> DataFrame:
    """Adds ``n / (classes * n_class)`` per row, so each class weighs the same
    in the fit (for ``train(..., weight_col=col)``; off by default).  The class
    counts come from one aggregate, a handful of scalars."""
    found = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(_MAX_BROADCAST_CLASSES + 1).collect()
    if len(found) > _MAX_BROADCAST_CLASSES:
        raise ValueError(f"more than {_MAX_BROADCAST_CLASSES} classes")
    counts = {r[label]: r["n"] for r in found}
    total, k = sum(counts.values()), len(counts)
    w = None
    for cls, n in counts.items():
        c = F.col(label) == F.lit(cls)
        w = F.when(c, F.lit(total / (k * n))) if w is None else w.when(c, F.lit(total / (k * n)))
    return df.withColumn(col, (w if w is not None else F.lit(1.0)).cast("double"))


def train(df: DataFrame, **forest_args) -> PipelineModel:
    """Fit assembler + forest on a cleaned training frame (label double).  A fit with weights or
    of deeper trees than ``operators.forest`` makes is Spark's at any size."""
    data = df.withColumn(LABEL, F.col(LABEL).cast("double"))
    rf = forest(**forest_args)
    if not rf.isSet("weightCol") and rf.getMaxDepth() <= FOREST.MAX_DEPTH and data.count() > SPARK_FIT_ROWS:
        return PipelineModel([assembler(), FOREST.fit(data, FEATURES, rf)])
    return Pipeline(stages=[assembler(), rf]).fit(data)


def score(df: DataFrame, model: PipelineModel, run_ts=None, key: str = KEY) -> DataFrame:
    """Predicted class and probability of class 1 for every scorable row,
    computed on the executors; the key and features stay on the row."""
    out = model.transform(df)
    res = out.select(
        key,
        *FEATURES,
        F.col("prediction").cast("int").alias("fraud_prediction"),
        vector_to_array(F.col("probability")).getItem(1).alias("fraud_probability"),
    )
    if run_ts is not None:
        res = res.withColumn("inference_timestamp", F.lit(run_ts).cast("timestamp_ntz"))
    return res


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_importance(model: PipelineModel, spark=None) -> DataFrame:
    """Features by importance, descending (13 rows built from the model)."""
    rf = model.stages[-1]
    imp = rf.featureImportances.toArray().tolist()
    names = model.stages[0].getInputCols()
    spark = spark or SparkSession.getActiveSession()
    rows = [(n, float(v)) for n, v in zip(names, imp)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


# --- evaluation -------------------------------------------------------------


def _counts(df: DataFrame, label: str, pred: str) -> DataFrame:
    y, p = F.col(label), F.col(pred)
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    )


def _ratio(a: Column, b: Column) -> Column:
    """a / b, 0 when b is 0 (the zero-division convention of the metrics)."""
    return F.when(b == 0, F.lit(0.0)).otherwise(a.cast("double") / b.cast("double"))


def _f1(prec: Column, rec: Column) -> Column:
    return F.when((prec + rec) == 0, F.lit(0.0)).otherwise(F.lit(2.0) * prec * rec / (prec + rec))


def binary_metrics(df: DataFrame, label: str = LABEL, pred: str = "fraud_prediction") -> DataFrame:
    """Accuracy, precision, recall, F1 of class 1: one aggregate."""
    c = _counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    prec, rec = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return c.select(
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        prec.alias("precision"),
        rec.alias("recall"),
        _f1(prec, rec).alias("f1"),
    )


def confusion_matrix(df: DataFrame, label: str = LABEL, pred: str = "fraud_prediction") -> DataFrame:
    """(label, prediction, count) for the four cells, zeros included: one
    aggregate exploded into four rows, no join."""
    c = _counts(df, label, pred)
    cells = F.array(
        *[
            F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(n).alias("count"))
            for y, p, n in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
        ]
    )
    return c.select(F.explode(cells).alias("c")).select("c.*")


def classification_report(df: DataFrame, label: str = LABEL, pred: str = "fraud_prediction") -> DataFrame:
    """Per class precision / recall / F1 / support, then accuracy, macro and
    support-weighted means: five rows from one aggregate."""
    c = _counts(df, label, pred)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    f1_1, f1_0 = _f1(p1, r1), _f1(p0, r0)
    s1, s0 = (tp + fn), (tn + fp)
    total = s0 + s1
    acc = _ratio(tp + tn, total)

    def row(name, p, r, f, s):
        return F.struct(
            F.lit(name).alias("class"),
            p.cast("double").alias("precision"),
            r.cast("double").alias("recall"),
            f.cast("double").alias("f1_score"),
            s.cast("long").alias("support"),
        )

    def wmean(a, b):
        return _ratio(a * s0 + b * s1, total)

    rows = F.array(
        row("0", p0, r0, f1_0, s0),
        row("1", p1, r1, f1_1, s1),
        row("accuracy", F.lit(None), F.lit(None), acc, total),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f1_0 + f1_1) / 2, total),
        row("weighted avg", wmean(p0, p1), wmean(r0, r1), wmean(f1_0, f1_1), total),
    )
    return c.select(F.explode(rows).alias("r")).select("r.*")
