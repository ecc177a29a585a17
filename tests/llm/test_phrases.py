"""Collocations against brute force, at thresholds that need several rounds, and on edge rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlake.llm import phrases

SF = "/root/testdata/sf0.01"


def brute(rows, top, least, percent):
    f, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        count = f.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                count.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, count in f.items():
        found = []
        for p, a in count.items():
            if len(p) < 2 or a < least:
                continue
            longer = [c for q in {x for x in count if len(x) == 3 and len(p) == 2 and p in (x[:2], x[1:])} if (c := count[q]) >= least] if len(p) == 2 else []
            if any(100 * c >= percent * a for c in longer):
                continue
            cuts = [(1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), a, count[p[:k]], count[p[k:]], n[lang], score))
        out += [(lang, i + 1, x[2].decode(), *x[3:]) for i, x in enumerate(sorted(found)[:top])]
    return sorted(out)


def found(df, **args):
    got = phrases.collocations(df.select("text", "lang", *(F.lit("x").alias(c) for c in ("h", "w1", "t", "score", "rank"))), **args)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def corpus(seed):
    rng = random.Random(seed)
    words = ["the", "The", "cat", "Éa", "éa", "a-b", "dog", " x", "un", "deux", "z"]
    rows = []
    for i in range(120):
        text = "".join(rng.choices(words, range(1, 12))[0] + rng.choice([" ", "  ", "\t", " ", ", ", ".\n", " "]) for _ in range(rng.randint(0, 40)))
        rows.append((text if i % 17 else None, rng.choice(["en", "en", "fr", None])))
    return rows + rows[:25]


@pytest.mark.parametrize("top,least,percent", [(5, 2, 50), (40, 3, 50), (1000, 2, 80), (3, 10, 20)])
def test_equals_brute_force(spark, top, least, percent):
    rows = corpus(top)
    assert found(spark.createDataFrame(rows, "text string, lang string"), top=top, least=least, inside_percent=percent) == brute(rows, top, least, percent)


def test_a_threshold_that_drops_most_pairs_falls_until_enough_survive(spark):
    """Pairs that all lie in triples go; the first threshold leaves too few, later ones settle the language."""
    rows = []
    for i in range(60):  # fixed triples of own words, each pair of them dropped
        rows += [(f"a{i} b{i} c{i}", "en")] * (10 + i % 3)
    rng = random.Random(1)
    rows += [(" ".join(rng.choices("k l m n o p".split(), k=12)), "en") for _ in range(80)]
    args = dict(top=25, least=5, inside_percent=50)
    assert found(spark.createDataFrame(rows, "text string, lang string"), grid=1, **args) == brute(rows, *args.values())
    args["top"] = 70
    assert found(spark.createDataFrame(rows, "text string, lang string"), **args) == brute(rows, *args.values())


def test_edges(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert found(empty) == []
    nothing = spark.createDataFrame([(None, "en"), ("", None), (" .. ,\t", "fr"), ("once upon", "en")], "text string, lang string")
    assert found(nothing) == []
    # one text of one phrase repeated, far longer than a slice, without and with ends of pieces
    for gap in (" ", ". "):
        text = gap.join(["ab cd"] * 900_000)
        got = found(spark.createDataFrame([(text, "en")], "text string, lang string"))
        if gap == ". ":
            assert got == [("en", 1, "ab cd", 900_000, 900_000, 900_000, 1_800_000, 1_000_000)]
        else:
            assert [(r[2], r[3]) for r in got] == [("ab cd ab", 899_999), ("cd ab cd", 899_999)]


def test_scores_are_exact_beyond_64_bits(spark):
    big = [(999_999_999_999_999, 999_999_999_999_999, 999_999_999_999_999), (123_456_789_012_345, 987_654_321_098_765, 123_456_789_012_346), (10, 11, 13)]
    got = spark.createDataFrame(big, "a long, l long, r long").select(phrases.score_of("a", "l", "r")).collect()
    assert [r[0] for r in got] == [1000000 * a * a // (x * y) for a, x, y in big]


def test_hashes_that_collide_are_reported():
    """Two words of one hash in one task come out as two rows, so the check for injective hashes sees them."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["one two one"], "lang": ["en"]})
    old = phrases.mix
    phrases.mix = lambda x: x & np.uint64(0)
    try:
        rows = [r for b in phrases.count_words(1)(iter([batch])) for r in b.to_pylist()]
    finally:
        phrases.mix = old
    assert len({r["h"] for r in rows}) == 1 and sum(r["c"] for r in rows) == 3


def test_filter_has_its_keys_and_few_others(spark):
    keys = np.random.default_rng(0).integers(-(2**63), 2**63, 20_000)
    rows = spark.createDataFrame([(int(k),) for k in keys], "h long")
    bloom = phrases.filter_of(rows, lambda b: phrases._column(b, "h"))
    assert bloom.has(keys.view(np.uint64)).all()
    other = np.random.default_rng(1).integers(-(2**63), 2**63, 50_000).view(np.uint64)
    assert bloom.has(other).mean() < 0.01
