"""Model operators: determinism, reload, metric formulas, exact split."""

import math

import pytest
from pyspark.sql import functions as F

from txnlake.operators import ml as ML
from txnlake.schemas import FEATURES, KEY, LABEL


@pytest.fixture(scope="module")
def separable(spark):
    """Label 1 exactly when the amount is high: a forest must beat the
    majority class here."""
    df = spark.range(0, 2000).select(
        F.col("id").cast("string").alias(KEY),
        *[
            (F.col("id") % 97 * (i + 1)).cast("double").alias(c)
            for i, c in enumerate(FEATURES)
            if c not in ("amt", "high_amount_flag")
        ],
        F.when(F.col("id") % 10 == 0, F.lit(3000.0)).otherwise(F.col("id") % 300 * 1.0).alias("amt"),
        F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("high_amount_flag"),
        F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias(LABEL),
    )
    return df.select(KEY, *FEATURES, LABEL)


def test_refit_is_deterministic_and_reload_is_identical(spark, separable, scratch):
    m1 = ML.train(separable, num_trees=10, max_depth=4)
    m2 = ML.train(separable, num_trees=10, max_depth=4)
    p1 = ML.score(separable, m1).select(KEY, "fraud_probability")
    p2 = ML.score(separable, m2).select(KEY, "fraud_probability")
    assert p1.exceptAll(p2).count() == 0
    ML.save_model(m1, f"{scratch}/m")
    p3 = ML.score(separable, ML.load_model(f"{scratch}/m")).select(KEY, "fraud_probability")
    assert p1.exceptAll(p3).count() == 0


def test_beats_majority_baseline(spark, separable):
    m = ML.train(separable, num_trees=10, max_depth=4)
    scored = ML.score(separable, m).join(separable.select(KEY, LABEL), KEY)
    acc = ML.binary_metrics(scored).first()["accuracy"]
    assert acc > 0.9  # majority class alone gives 0.9
    imp = ML.feature_importance(m, spark).collect()
    assert len(imp) == 13 and imp[0]["importance"] >= imp[-1]["importance"]


def test_split_is_exact_per_class_and_stable(spark, separable):
    s = ML.stratified_split(separable)
    per = {(r[LABEL], r["is_test"]): r["n"] for r in s.groupBy(LABEL, "is_test").agg(F.count("*").alias("n")).collect()}
    assert per[(1, True)] == math.ceil(0.2 * 200)
    assert per[(0, True)] == math.ceil(0.2 * 1800)
    a = {r[KEY] for r in s.filter("is_test").collect()}
    b = {r[KEY] for r in ML.stratified_split(separable.repartition(5, F.rand(1))).filter("is_test").collect()}
    assert a == b


def test_split_all_one_class(spark, separable):
    one = separable.filter(F.col(LABEL) == 0)
    s = ML.stratified_split(one)
    assert s.filter("is_test").count() == math.ceil(0.2 * one.count())


def test_metrics_zero_division_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], f"{LABEL} int, fraud_prediction int")
    m = ML.binary_metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (1.0, 0.0, 0.0, 0.0)
    cm = sorted(tuple(r) for r in ML.confusion_matrix(df).collect())
    assert cm == [(0, 0, 2), (0, 1, 0), (1, 0, 0), (1, 1, 0)]


def test_classification_report_matches_hand_count(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 2 + [(0, 0)] * 4
    df = spark.createDataFrame(rows, f"{LABEL} int, fraud_prediction int")
    r = {x["class"]: x for x in ML.classification_report(df).collect()}
    assert r["1"]["precision"] == pytest.approx(3 / 5) and r["1"]["recall"] == pytest.approx(3 / 4)
    assert r["0"]["precision"] == pytest.approx(4 / 5) and r["0"]["recall"] == pytest.approx(4 / 6)
    assert r["accuracy"]["f1_score"] == pytest.approx(0.7) and r["accuracy"]["support"] == 10
    f1_1, f1_0 = 2 * 0.6 * 0.75 / 1.35, 2 * 0.8 * (4 / 6) / (0.8 + 4 / 6)
    assert r["macro avg"]["f1_score"] == pytest.approx((f1_0 + f1_1) / 2)
    assert r["weighted avg"]["f1_score"] == pytest.approx((f1_0 * 6 + f1_1 * 4) / 10)


def test_unscorable_rows_split_off(spark, separable):
    bad = separable.limit(3).withColumn("lat", F.lit(None).cast("double"))
    ok, rej = ML.split_scorable(separable.limit(10).unionByName(bad))
    assert rej.count() == 3 and ok.count() == 10


def test_balanced_weights_and_weighted_fit(spark, separable):
    w = ML.with_balanced_weights(separable)
    r = {x[LABEL]: x["class_weight"] for x in w.select(LABEL, "class_weight").distinct().collect()}
    assert r[1] == pytest.approx(2000 / (2 * 200)) and r[0] == pytest.approx(2000 / (2 * 1800))
    m = ML.train(w, num_trees=5, max_depth=3, weight_col="class_weight")
    assert ML.score(separable, m).count() == 2000


def test_model_is_the_same_on_any_layout_and_core_count(spark, tmp_path):
    """Partitions of the input, and with them the tasks of a run, don't change the model."""
    from txnlake.plans import jobs
    from txnlake.plans.fixtures import fixture_layers

    gold = fixture_layers(spark, "/root/testdata/sf0.001")["gold"]
    got = []
    for n in (2, 8):
        gold.repartition(n).write.parquet(f"{tmp_path}/gold{n}")
        m = jobs.train_model(spark, f"{tmp_path}/gold{n}", num_trees=5, max_depth=4)["model"]
        scored = ML.score(ML.select_features(ML.split_scorable(gold)[0]), m)
        got.append(sorted((r[KEY], r["fraud_probability"]) for r in scored.collect()))
    assert got[0] == got[1] and len(got[0]) > 900


def trees(model):
    return [t.toDebugString.split("\n", 1)[1] for t in model.stages[-1].trees]


def test_no_task_of_the_shared_fit_holds_a_large_table(spark, monkeypatch):
    """Beyond FIT_ROWS rows the partitions follow the rows, whatever the shuffle left."""
    from txnlake.plans import jobs, queries
    from txnlake.plans.fixtures import fixture_layers

    L = fixture_layers(spark, "/root/testdata/sf0.001")
    seen = []
    monkeypatch.setattr(ML, "train", lambda df: seen.append([r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]))
    monkeypatch.setattr(queries, "_MODELS", {})
    queries._model(spark, "small", L)
    monkeypatch.setattr(jobs, "FIT_ROWS", 25)
    queries._model(spark, "large", L)
    assert sum(seen[0]) == sum(seen[1]) > 700
    assert len(seen[1]) > 30 and max(seen[1]) <= 2 * jobs.FIT_ROWS


def test_node_ids_are_not_cached_and_trees_are_the_same(spark, separable):
    """the node ids of a row take more memory than the row."""
    from pyspark.ml import Pipeline

    assert not ML.forest().getCacheNodeIds()
    fits = [Pipeline(stages=[ML.assembler(), ML.forest(num_trees=8, max_depth=6).setCacheNodeIds(x)]).fit(separable.withColumn(LABEL, F.col(LABEL).cast("double"))) for x in (True, False)]
    assert trees(fits[0]) == trees(fits[1])


def test_files_of_the_training_contract_follow_the_rows(spark, monkeypatch):
    """no file, and no task that writes one, grows with Gold."""
    from txnlake.plans import jobs, queries

    monkeypatch.setattr(jobs, "FIT_ROWS", 20)
    seen = []

    class Enough(Exception):
        pass

    def looked(gold, **_):
        seen.append(len(gold.inputFiles()))
        if len(seen) == 2:
            raise Enough
        return {"model": type("M", (), {"stages": [type("F", (), {"trees": []})]})}

    monkeypatch.setattr(jobs, "train_on", looked)
    with pytest.raises(Enough):
        queries.q_train_contract(spark, "/root/testdata/sf0.001")
    assert seen == [2 * 3, 8 * 3]  # 1,000 rows: 50 partitions


@pytest.fixture(scope="module")
def mixed(spark):
    """Three classes; features of 20 values and of a thousand, so candidates lie between values and at quantiles."""
    h = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(20 if i % 2 else 1000)).cast("double") for i in range(len(FEATURES))]
    df = spark.range(0, 3000, 1, 4).select(F.col("id").cast("string").alias(KEY), *[x.alias(c) for x, c in zip(h, FEATURES)])
    signal = (F.col(FEATURES[1]) > 8) & (F.col(FEATURES[4]) < 600)
    noise = F.pmod(F.xxhash64(KEY), F.lit(10)) == 0
    return df.withColumn(LABEL, (signal.cast("int") + noise.cast("int")).cast("double")).cache()


@pytest.mark.parametrize("depth", [0, 1, 7])
def test_a_tree_of_many_rows_is_that_of_spark(spark, mixed, depth):
    """without random draws nothing is left in which the two fits may differ."""
    from pyspark.ml import Pipeline

    from txnlake.operators import forest

    rf = ML.forest(num_trees=2, max_depth=depth).setFeatureSubsetStrategy("all").setBootstrap(False)
    a, b = forest.fit(mixed, FEATURES, rf), Pipeline(stages=[ML.assembler(), rf]).fit(mixed).stages[-1]
    assert [t.toDebugString.split("\n", 1)[1] for t in a.trees] == [t.toDebugString.split("\n", 1)[1] for t in b.trees]
    x = ML.assembler().transform(mixed)
    columns = ["rawPrediction", "probability", "prediction"]
    assert a.transform(x).select(columns).exceptAll(b.transform(x).select(columns)).count() == 0
    assert a.featureImportances == b.featureImportances
    assert (a.numClasses, a.numFeatures, a.getMaxDepth(), a.getNumTrees) == (b.numClasses, b.numFeatures, depth, 2)


def test_the_fit_of_many_rows_is_the_same_on_any_layout(spark, separable, scratch, monkeypatch):
    """F1: beyond SPARK_FIT_ROWS rows; its model is saved, loaded and scored as any other."""
    from txnlake.operators import forest
    from txnlake.plans import jobs

    calls = []
    fit = forest.fit
    monkeypatch.setattr(forest, "fit", lambda *a: calls.append(1) or fit(*a))
    few = ML.train(separable, num_trees=6, max_depth=4)
    assert not calls
    monkeypatch.setattr(ML, "SPARK_FIT_ROWS", 1000)
    monkeypatch.setattr(forest, "BLOCK", 300)
    models = [ML.train(jobs.fixed_layout(separable.repartition(n), 4), num_trees=6, max_depth=4) for n in (2, 8)]
    assert len(calls) == 2
    assert trees(models[0]) == trees(models[1]) != trees(few)
    assert len(set(trees(models[0]))) > 1
    assert max(t.depth for t in models[0].stages[-1].trees) <= 4
    scored = ML.score(separable, models[0])
    accuracy = ML.binary_metrics(scored.join(separable.select(KEY, LABEL), KEY)).first()["accuracy"]
    assert accuracy > 0.9
    ML.save_model(models[0], f"{scratch}/m")
    assert scored.exceptAll(ML.score(separable, ML.load_model(f"{scratch}/m"))).count() == 0
    with_weights = ML.train(ML.with_balanced_weights(separable), num_trees=2, max_depth=2, weight_col="class_weight")
    ML.train(separable, num_trees=1, max_depth=forest.MAX_DEPTH + 1)
    assert len(calls) == 2 and len(with_weights.stages) == 2


def test_a_row_of_a_large_fit_takes_14_bytes_and_may_not_be_null(spark, separable):
    """Spark's own fit holds 550 bytes a row."""
    import numpy as np

    from txnlake.operators import forest

    numbers = separable.select(F.col(LABEL).cast("double"), *[F.col(c).cast("double") for c in FEATURES])
    binned = numbers.mapInArrow(forest._binned([np.array([1.0])] * 13), "bins binary, labels binary")
    size = binned.select(F.sum(F.length("bins") + F.length("labels"))).first()[0]
    assert size == 14 * 2000
    with pytest.raises(Exception, match="a feature is null"):
        forest.fit(separable.withColumn("lat", F.lit(None).cast("double")), FEATURES, ML.forest(num_trees=2, max_depth=1))
    with pytest.raises(ValueError, match="2000 labels that are no class"):
        forest.fit(separable.withColumn(LABEL, F.lit(0.5)), FEATURES, ML.forest(num_trees=2, max_depth=1))


def test_draws_of_a_large_fit_are_poisson():
    import numpy as np

    from txnlake.operators import forest

    n = 200_001
    drawn = np.bincount(forest.draws(np.random.PCG64([42, 0, 1]), n), minlength=5) / n
    assert np.abs(drawn[:5] - [math.exp(-1) / math.factorial(k) for k in range(5)]).max() < 0.005
    assert (forest.draws(np.random.PCG64([42, 0, 1]), n) == forest.draws(np.random.PCG64([42, 0, 1]), n)).all()


def test_the_training_contract_derives_gold_once(spark, monkeypatch):
    """the second layout of Gold is dealt from the files of the first."""
    from txnlake.plans import jobs, queries

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    L = dict(queries._layers(spark, "/root/testdata/sf0.001"))
    n = L["gold"].count()
    L["gold"] = L["gold"].mapInArrow(counted, L["gold"].schema)
    monkeypatch.setattr(queries, "_layers", lambda *_: L)
    read = []
    none = type("M", (), {"stages": [type("F", (), {"trees": []})]})
    monkeypatch.setattr(jobs, "train_on", lambda gold: read.append((len(gold.inputFiles()), gold.count())) or {"model": none})
    queries.q_train_contract(spark, "/root/testdata/sf0.001")
    assert read == [(2, n), (8, n)]
    assert seen.value == n
