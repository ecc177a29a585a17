"""Nulls, empty and very long texts, ties and repeated rows, empty tables and clashing columns, for every operator."""

import re
from collections import Counter
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnlake.llm import html_extract, imi, langid, lm, mixing, packing, simhash, token_counts, toxicity
from txnlake.llm.exact_dedup import exact_dedup
from txnlake.session import checkpoint_dir

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 60_000
ROWS = [
    (1, "the cat sat on the mat", "en", "a", 1),
    (2, "the  cat\tsat on the mat", "en", "a", 1),
    (2, "the cat sat on the mat", "en", None, None),
    (2, "the cat sat on the mat", "en", None, None),
    (3, None, None, None, None),
    (None, "", "en", "a", 0),
    (None, "le chat est sur la table", "fr", "b", 0),
    (5, LONG, "en", "a", len(LONG)),
    (6, "le chien est dans la maison", "fr", "b", 0),
    (7, "12 34 --- !!", "en", "b", 0),
    (8, "   \n\t ", "fr", "*", 0),
]
#: Names that the operators use inside.
CLASHING = ["id", "digest", "content", "fp", "key", "row", "rare", "topic", "n_tokens", "probability", "held_out", "lang_pred", "score", "sketch", "toxic", "text_sha256", "kept", "cell_source", "n", "asked"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, DOCS)
    return df.select("*", *(F.lit("x").alias(c) for c in CLASHING))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (2, 0, 1), (2, 1, 0), (None, 1, 1), (99, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


def operators(docs, labels):
    return {
        "lm": lambda d: lm.score_documents(d),
        "toxicity": lambda d: toxicity.score_documents(d, labels),
        "mixing": lambda d: mixing.mix(d),
        "token_counts": lambda d: token_counts.section_tokens(d),
        "exact_dedup": lambda d: exact_dedup(d),
        "langid": lambda d: langid.identify(d),
        "packing": lambda d: packing.pack(d),
        "simhash": lambda d: simhash.near_duplicates(d),
    }


@pytest.mark.parametrize("name", ["lm", "toxicity", "mixing", "exact_dedup", "langid", "simhash"])
def test_one_row_for_each_row(docs, labels, name):
    got = operators(docs, labels)[name](docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in ROWS)


@pytest.mark.parametrize("name", ["lm", "toxicity", "mixing", "token_counts", "exact_dedup", "langid", "packing", "simhash"])
def test_empty_table(docs, labels, name):
    assert operators(docs, labels)[name](docs.limit(0)).collect() == []


def test_exact_dedup_of_ties_and_nulls(docs):
    got = exact_dedup(docs).collect()
    cats = [r for r in got if r["group_size"] == 4]
    assert {r["doc_id"] for r in cats} == {1, 2} and {r["keep_id"] for r in cats} == {1}
    assert [r["doc_id"] for r in cats if r["kept"]] == [1]
    nothing = [r for r in got if r["text_sha256"].startswith("e3b0c442")]  # null and empty
    assert {r["doc_id"] for r in nothing} == {3, None} and {r["keep_id"] for r in nothing} == {3}
    assert sum(r["kept"] for r in got) == len({r["text_sha256"] for r in got})


def test_simhash_of_nulls_and_repeats(docs):
    got = simhash.near_duplicates(docs).collect()
    zero = [r for r in got if r["fingerprint"] == "0" * 16]
    assert sorted(str(r["doc_id"]) for r in zero) == ["3", "8", "None"] and {r["component_id"] for r in zero} == {3}
    assert {r["component_id"] for r in got if r["doc_id"] in (1, 2)} == {1}


def test_langid_of_texts_without_letters(docs):
    got = langid.identify(docs).collect()
    assert all(r["lang_pred"] == "und" and r["score"] == 0 for r in got if r["doc_id"] in (3, 7, 8))
    assert all(0 <= r["score"] <= 1 for r in got)


def test_lm_of_empty_texts(docs):
    got = [r for r in lm.score_documents(docs).collect() if r["doc_id"] in (3, 8)]
    assert all(r["n_tokens"] == 1 for r in got) and len({r["base_score"] for r in got}) == 1


def test_mixing_needs_no_python_worker(docs):
    """Its cells come from the driver as columns; rows would start a daemon and workers on every executor."""
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "LocalRelation" in plan and "ExistingRDD" not in plan


def test_mixing_of_nulls(docs):
    got = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    assert got[3]["n_tokens"] == 0 and got[3]["topic"] == "none" and got[3]["lang"] == "unknown"
    assert got[5]["n_tokens"] == 60_000


def test_packing_covers_every_token_once(docs):
    got = packing.pack(docs).collect()
    whole = sum(len(packing.encoder(packing.tokenizer_path()).document((r[1] or "").encode())) // 4 + 1 for r in ROWS)
    assert sum(r["length"] for r in got) == whole
    assert sorted(str(r["doc_id"]) for r in got if r["start"] == 0) == sorted(str(r[0]) for r in ROWS)


def test_token_counts_of_empty_text(docs):
    got = [r for r in token_counts.section_tokens(docs).collect() if r["doc_id"] == 3]
    assert [(r["section"], r["char_start"], r["char_end"], r["n_tokens"]) for r in got] == [(1, 0, 0, 0)]


PAGES = "page_id long, url string, html string"


def test_html_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>" * 300 + "deep text stands here, it is long enough to read"), (4, "u", "<article>a &amp; b<p>c  d</article>"), (4, "u", "<article>a &amp; b<p>c  d</article>"), (5, "u", "<<>><a <b ></p> </ &#xZ;")]
    df = spark.createDataFrame(rows, PAGES).withColumn("text", F.lit("x")).withColumn("x", F.lit(1))
    got = sorted(html_extract.extract(df).collect(), key=str)
    assert len(got) == len(rows)
    assert all(r["text"] == "" and r["n_chars"] == 0 for r in got if r["page_id"] in (1, 2))
    assert [r["text"] for r in got if r["page_id"] == 4] == ["a & b c d"] * 2
    assert [r["text"] for r in got if r["page_id"] is None] == ["deep text stands here, it is long enough to read"]
    assert html_extract.extract(df.limit(0)).collect() == []


def test_search_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, []), (None, [1.0, 1.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (40, [-1.0, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("first", F.lit(1))
    got = sorted(imi.search(df, F.col("vec_id") % 20 == 0, recall=1.0).collect(), key=lambda r: (r["query_id"], r["rank"]))
    by = {q: [r["vec_id"] for r in got if r["query_id"] == q] for q in (0, 20, 40)}
    assert by == {0: [1, 2, 20, 40], 20: [40, 0, 1, 2], 40: [20, 0, 1, 2]}
    assert imi.search(df.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    # null, [] and [1.0] alone: the most frequent usable length is 1, and nothing is near it
    assert imi.search(df.filter("vec_id in (3, 8, 9)"), F.col("vec_id") % 20 == 0).collect() == []


def test_pipeline_stages_on_edge_rows(spark, docs):
    import corpus_pipeline

    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, "")
        assert rows.columns == corpus_pipeline.COLUMNS, name
        if name == "language_id":
            assert {r["doc_id"] for r in rows.collect()} <= {1, 2, 5, 6, None}
        if name == "exact_dedup":
            texts = [" ".join(r["text"].split()) for r in rows.collect()]
            assert len(texts) == len(set(texts))
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
    assert empty.collect() == []


def test_exact_stage_writes_no_table_of_its_own(spark, docs, monkeypatch):
    """Its result needs the smallest ids alone; each table written costs every executor files and tasks."""
    import importlib

    import corpus_pipeline

    written = []
    for module in (corpus_pipeline, importlib.import_module("txnlake.llm.exact_dedup")):
        monkeypatch.setattr(module, "cut", lambda df, name, *a, **k: written.append(name) or df)
    rows = docs.union(docs.limit(2)).union(docs.filter("doc_id IS NULL"))
    got = Counter((r["doc_id"], r["text"]) for r in corpus_pipeline.drop_exact_copies(spark, rows, "").collect())
    assert written == [] and max(got.values()) == 1
    first = {}
    for doc, text, *_ in rows.collect():
        key, place = re.sub(r"[\x20\x09-\x0d]+", " ", text or ""), (doc is None, doc or 0)
        first[key] = min(first.get(key, place), place)
    assert sorted(re.sub(r"[\x20\x09-\x0d]+", " ", t or "") for _, t in got) == sorted(first)
    assert all(first[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")] == (i is None, i or 0) for i, t in got)


def test_representatives_are_the_kept_rows(docs):
    from txnlake.llm.exact_dedup import representatives

    rows = docs.union(docs).union(docs.filter("doc_id IS NULL"))
    kept = exact_dedup(rows).filter("kept").select("doc_id", "text_sha256")
    for window, ids in ((1 << 20, 1000), (1, 1)):
        got = representatives(rows, window_bytes=window, ids_per_row=ids).collect()
        assert sorted(map(str, got)) == sorted(map(str, kept.collect()))


@pytest.mark.parametrize("stage", [0, 1, 2, 4])
def test_pipeline_bounds_batches_by_bytes(spark, docs, stage):
    """A worker and its executor hold a batch whole: 10,000 long rows would be far more than a stage needs at once."""
    import corpus_pipeline

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])

    def largest(session):
        long = session.range(0, 2000, 1, 1).select(F.repeat(F.lit("x"), 20_000).alias("text"))
        got = long.mapInArrow(sizes, "rows long, bytes long").collect()
        assert sum(r["rows"] for r in got) == 2000
        return max(r["bytes"] for r in got)

    own = spark.newSession()
    rows = own.createDataFrame(docs.limit(3).collect(), docs.schema)
    corpus_pipeline.STAGES[stage][1](own, rows, "")
    assert largest(own) < 8 << 20
    chosen = spark.newSession()
    chosen.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "16m")
    corpus_pipeline.STAGES[stage][1](chosen, chosen.createDataFrame(docs.limit(3).collect(), docs.schema), "")
    assert chosen.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "16m"


def test_language_id_bounds_what_is_read_at_once(spark, docs, tmp_path):
    """Whole texts in arrays of 4,096 rows let an executor's heap grow beyond what the job needs."""
    spark.range(0, 2000, 1, 1).select(F.lit("a text").alias("text")).write.parquet(f"{tmp_path}/read")

    def batches(session):
        run = session.read.parquet(f"{tmp_path}/read")._jdf.queryExecution()
        run.toRdd().count()
        plan = run.executedPlan()
        while "numInputBatches" not in str(plan.metrics().keySet()):
            plan = plan.children().head()
        return plan.metrics().apply("numInputBatches").value()

    own = spark.newSession()
    langid.identify(own.createDataFrame(docs.limit(3).collect(), docs.schema))
    assert batches(own) == 8
    chosen = spark.newSession()
    chosen.conf.set("spark.sql.parquet.columnarReaderBatchSize", "1000")
    langid.identify(chosen.createDataFrame(docs.limit(3).collect(), docs.schema))
    assert batches(chosen) == 2


def test_language_id_leaves_no_counts(spark, docs):
    """Neither tables in the shared folder nor blocks on the executors, also when training ends in an error."""
    shared = Path(checkpoint_dir(spark).removeprefix("file:"))

    def left():
        return {p.name for p in shared.glob("llm-langid-*")}, spark.sparkContext._jsc.getPersistentRDDs().size()

    before = left()
    assert langid.identify(docs).count() == docs.count()
    assert left() == before
    with pytest.raises(ValueError, match="languages"):
        langid.train(docs.filter("lang IS NOT NULL"), max_languages=0)
    assert left() == before
