"""The operators' queries over the given tables, with production parameters, and
their DuckDB twins where SQL can say what the operator returns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm import lm, toxicity
from txnlake.llm.common import shared_path, table
from txnlake.llm.exact_dedup import exact_dedup
from txnlake.llm.html_extract import extract
from txnlake.llm.imi import search
from txnlake.llm.langid import identify
from txnlake.llm.mixing import mix
from txnlake.llm.packing import pack
from txnlake.llm.phrases import collocations
from txnlake.llm.simhash import near_duplicates
from txnlake.llm.spelling import variants
from txnlake.llm.token_counts import section_tokens, windows
from txnlake.llm.token_files import read_tokens, write_tokens


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op4_ipf_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return section_tokens(table(spark, sf_dir, "documents"), "largest", windows(1000))


def op6_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_tokens(table(spark, sf_dir, "documents"), path)
    return read_tokens(spark, path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_scoring": op1_lm_scoring,
    "op2_toxicity": op2_toxicity,
    "op3_html_extraction": op3_html_extraction,
    "op4_ipf_mixing": op4_ipf_mixing,
    "op5_token_counts": op5_token_counts,
    "op6_inverted_multi_index": op6_inverted_multi_index,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_simhash": op10_simhash,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_files": op13_token_files,
}

ORACLE: dict[str, str] = {
    "op7_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
            FROM documents
        )
        SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept,
               text_sha256
        FROM t
    """,
    "op11_phrase_mining": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ),
        words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
        grams AS (
            SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
            UNION ALL
            SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
            UNION ALL
            SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
        ),
        f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
        totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
        c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
        parts AS (
            SELECT lang, k, phrase, a, 1 AS cut, w[1] AS head, CASE WHEN k = 2 THEN w[2] ELSE w[2] || ' ' || w[3] END AS tail FROM c
            UNION ALL
            SELECT lang, k, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE k = 3
        ),
        cuts AS (
            SELECT p.lang, p.k, p.phrase, p.a, p.cut, x.f AS l, y.f AS r,
                   CAST(1000000 * CAST(p.a AS HUGEINT) * p.a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM parts p JOIN f x ON x.lang = p.lang AND x.phrase = p.head JOIN f y ON y.lang = p.lang AND y.phrase = p.tail
        ),
        best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        longer AS (
            SELECT lang, phrase, max(a) AS a
            FROM (SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM c WHERE k = 3 UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM c WHERE k = 3)
            GROUP BY lang, phrase
        ),
        kept AS (
            SELECT b.* FROM best b LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase AND b.k = 2
            WHERE o.a IS NULL OR 100 * o.a < 50 * b.a
        )
        SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
        FROM kept k JOIN totals t ON t.lang = k.lang
        QUALIFY rank <= 2000
    """,
}
