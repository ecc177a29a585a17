"""The training-data pipeline: five stages over ``documents``, each one an operator of ``txnlake.llm``.

``run`` writes every stage's result as Parquet to the shared folder and reads it
back as the next stage's input, so a lost executor never repeats an earlier stage.
Stages that send texts to Python workers bound the session's batches by bytes, since
a caller may write what a stage returns by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import WHITE, bound_batches, cut, remainder, table
from txnlake.llm.exact_dedup import representatives
from txnlake.llm.langid import HELD_OUT, UNDETERMINED, predict, train
from txnlake.llm.mixing import mix
from txnlake.llm.packing import pack
from txnlake.llm.simhash import near_duplicates

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell stay, with that language as ``lang``; ``und``
    (no letter, or null) goes, and so does a text that no language holds with a probability of half."""
    bound_batches(spark)
    rows = docs.select(*COLUMNS)
    model = train(rows.filter(remainder("doc_id", HELD_OUT[0]) != HELD_OUT[1]))
    found = predict(rows, model, COLUMNS).filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= 0.5))
    return found.withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the smallest doc_id stays; rows repeated whole, id included, stay once."""
    bound_batches(spark)
    kept = representatives(docs)
    digest = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), WHITE, " "), 256)
    rows = docs.select(*COLUMNS).withColumn("digest", digest)
    both = rows.join(kept, rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["digest"] == kept["text_sha256"]), "left_semi")
    if not docs.groupBy("doc_id").count().filter("count > 1").isEmpty():  # ids that repeat: one row of each id and text
        both = both.dropDuplicates(["doc_id", "digest"])
    return both.select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class (3-word shingles, 3 differing bits) the document of the smallest id stays;
    rows that share an id are one document."""
    bound_batches(spark)
    kept = near_duplicates(docs, shingle=3, max_bits=3).filter("doc_id <=> component_id").select("doc_id").distinct()
    rows = docs.select(*COLUMNS)
    return rows.join(kept, rows["doc_id"].eqNullSafe(kept["doc_id"]), "left_semi")


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose token weights are at the target shares of source, language and topic."""
    drawn = mix(docs).filter("sampled").select("doc_id").distinct()
    rows = docs.select(*COLUMNS)
    return rows.join(drawn, rows["doc_id"].eqNullSafe(drawn["doc_id"]), "left_semi")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sample's tokens in sequences of 4096: a row for each piece."""
    bound_batches(spark)
    return pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("ipf_mixing", sample_mixture),
    ("packing", pack_sequences),
]

#: SQL can't express the language model or the fingerprints; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
