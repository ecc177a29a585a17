"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from txnlake.llm import spelling
from txnlake.llm.common import cut

SF = "/root/testdata/sf0.001"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(rows):
    words = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return words


def one_error(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, length=6, count=5, ratio=5):
    n = {w: c for w, c in counted(rows).items() if len(w) >= length and c >= count}
    form, near = {}, {}
    for w in n:
        close = [v for v in n if v != w and abs(len(v) - len(w)) <= 1 and one_error(v, w)]
        near[w] = len(close)
        if close:
            best = min(close, key=lambda v: (-n[v], v))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], near[w], n[form[w]] if w in form else None))
    return sorted(out, key=str)


def found(df, **args):
    got = spelling.variants(df, **args)
    assert got.columns == COLUMNS
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_equals_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute(rows)
    assert len(want) > 100 and any(r[1] for r in want)
    assert found(docs) == want


@pytest.mark.parametrize("block_words", [1 << 16, 7])
def test_equals_brute_force_on_close_words(spark, block_words):
    """Words over few letters, so blocks are crowded and most words have many near ones; chains of several forms; shared blocks."""
    rng = random.Random(1 << 16)
    words = ["".join(rng.choices("aBé", k=rng.randint(5, 9))) for _ in range(500)]
    rows = [(i if i % 9 else None, " ".join(rng.choices(words, [1 + 3000 // (k + 1) for k in range(500)], k=400)) + "×÷ß _Œuvre12") for i in range(60)]
    rows += [(1000, None), (1001, ""), (1002, " ... "), rows[3], rows[3]]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit("x").alias(c) for c in ("word", "n", "near", "block", "lang")))
    want = brute(rows)
    assert max(r[4] for r in want) > 5 and any(r[1] and r[2] != r[1] for r in want)
    assert found(df, block_words=block_words) == want


def test_long_texts_and_words(spark):
    long = "abcdefg" * 3000
    texts = ["Wordone wordtwo " * 400_000, " ".join([long] * 6), " ".join([long + "x"] * 31), long * 200]
    rows = list(enumerate(texts))
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []


def test_index_tracks_one_error():
    rng = random.Random(5)
    words = sorted({"".join(rng.choices("abc", k=rng.randint(1, 7))) for _ in range(700)})
    index = spelling.PositionIndex(words)
    for w in words[::7] + ["", "abcabcabcabc"]:
        got, begin = index.near(w, 2)
        assert {v for i, v in enumerate(words) if got >> i & 1} == {v for v in words if v != w and one_error(v, w)}
        if len(w) >= 2:
            assert {v for i, v in enumerate(words) if begin >> i & 1} == {v for v in words if v[:2] == w[:2]}


def test_near_words_of_a_shared_block(spark):
    """A block larger than a share gives each pair once."""
    rows = [(f"prefix{a}{b}", 5 + i) for i, (a, b) in enumerate((a, b) for a in "abcdefgh" for b in "abcdefgh")]
    words = cut(spark.createDataFrame(rows, "word string, n long"), "test-words")
    n = dict(rows)
    got = {r["word"]: (r["near"], r["best"], r["best_n"]) for r in spelling.near_words(words, block_words=10).collect()}
    for w in n:
        close = [v for v in n if one_error(v, w) and v != w]
        best = min(close, key=lambda v: (-n[v], v))
        assert got[w] == (len(close), best, n[best])
