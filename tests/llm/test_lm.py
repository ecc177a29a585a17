"""LM scoring by two passes: against exact counts, with many shards, and the filter's error at two sizes."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from txnlake.llm import lm

END = None


def grams(text):
    words = [END, *(text or "").lower().split(), END]
    return words, list(zip(words, words[1:])), list(zip(words, words[1:], words[2:]))


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2


def brute_force(rows):
    """Scores by the documented formulas from exact counts, without a filter."""
    one, two, three = Counter(), Counter(), Counter()
    for i, text in rows:
        if not held_out(i):
            w, p, t = grams(text)
            one.update(w[1:])
            two.update(p)
            three.update(t)
    whole = sum(one.values()) + len(one) + 1

    def level(c):
        return 1 + math.floor(2 * math.log2(c) + 1e-9)

    def low(c, context):
        return min(math.sqrt(2) ** (level(c) - 1), context) if c else 0

    def score(text):
        w, pairs, triples = grams(text)
        total = 0.0
        for i in range(1, len(w)):
            p = (one[w[i]] + 1) / whole
            if one[w[i - 1]]:
                p = (low(two[pairs[i - 1]], one[w[i - 1]]) + lm.K1 * p) / (one[w[i - 1]] + lm.K1)
            if i >= 2 and two[pairs[i - 2]]:
                high = math.sqrt(2) ** level(two[pairs[i - 2]])
                p = (low(three[triples[i - 2]], high) + lm.K2 * p) / (high + lm.K2)
            total += math.log10(p)
        return total

    return [(i, score(text)) for i, text in rows]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(0, 40))) for _ in range(400)]
    return [*enumerate(texts), (7, texts[7]), (7, "other text"), (None, "w1 w2"), (500, None), (501, ""), (502, "W1\tw2  never seen before")]


@pytest.mark.parametrize("shard, slice_", [(lm.SHARD, lm.SLICE), (900, 4_000)])
def test_scores_equal_brute_force(spark, rows, monkeypatch, shard, slice_):
    """One shard and one block, or many of both (and several shards and blocks in a task): the same scores."""
    monkeypatch.setattr(lm, "SHARD", shard)
    monkeypatch.setattr(lm, "SLICE", slice_)
    if shard < 1000:
        monkeypatch.setattr(lm, "MOST_TASKS", 3)
        monkeypatch.setattr(lm, "AT_ONCE", 50)
    got = lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()

    def ordered(pairs):
        return sorted(pairs, key=lambda x: (-1 if x[0] is None else x[0], x[1]))

    got, expected = ordered((r["doc_id"], r["score"]) for r in got), ordered(brute_force(rows))
    assert [i for i, _ in got] == [i for i, _ in expected]
    # A filter may read an unseen n-gram as seen: at 16 bits an event in a few of 10,000 probes.
    same = [a == pytest.approx(b, abs=1e-6) for (_, a), (_, b) in zip(got, expected)]
    assert sum(same) >= 0.95 * len(same)
    assert sum(x for _, x in got) == pytest.approx(sum(x for _, x in expected), rel=2e-3)


def test_counts_come_from_the_filter_alone(spark, rows, monkeypatch):
    """With filters that hold nothing, pairs and triples are unseen: no other count of them exists."""
    monkeypatch.setattr(lm.LogBloom, "get", lambda self, key: np.zeros(len(key), np.int32))
    found = lm.Shard({"words": b"", "counts": b"", "size": 1 << 16, "bits": lm.pa.compress(bytes(1 << 13), "zstd", asbytes=True)})
    assert not found.find(np.arange(9, dtype=np.uint64), False).any() and not found.find(np.arange(9, dtype=np.uint64), True).any()
    blocks = lm.blocked(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "false AS held_out"), "t")
    model, _, _ = lm._trained(blocks)
    assert set(model.shards.columns) == {"bucket", "words", "counts", "size", "bits", "n", "v"} and model.buckets == 1
    asked = lm.questions(blocks, model.buckets, model.spare, training=False)
    assert set(asked.columns) == {"block", "bucket", "words", "grams"}


@pytest.mark.parametrize("events", [20_000, 700_000])
def test_false_positives_do_not_rise_with_the_events(events):
    rng = np.random.default_rng(events)
    key = rng.integers(0, 2**63, events).astype(np.uint64)
    bloom = lm.LogBloom(events)
    bloom.add(key, np.ones(events, np.int32))
    assert (bloom.get(rng.integers(0, 2**63, 200_000).astype(np.uint64)) > 0).mean() < 0.001


def test_shards_follow_the_occurrences():
    assert [lm.shards_for(n) for n in (0, 1, lm.SHARD, lm.SHARD + 1, 1000 * lm.SHARD)] == [1, 1, 1, 2, 1000]


def test_keys_grow_with_the_occurrences():
    for n in (1, 1000, 10**8, 10**11, 10**14):
        assert 2 ** (64 - lm.spare_bits(n)) > n * 2**lm.MARGIN
    assert lm.spare_bits(2**60) == 0


def test_sums_of_parts(monkeypatch):
    monkeypatch.setattr(lm, "AT_ONCE", 10)
    rng, sums, exact = np.random.default_rng(1), lm.Sums(), Counter()
    for n in (0, 3, 30, 1, 200, 7):
        key, count = rng.integers(0, 40, n).astype(np.uint64), rng.integers(1, 5, n)
        sums.add(key, count)
        for k, c in zip(key.tolist(), count.tolist()):
            exact[k] += c
    key, total = sums.result()
    assert dict(zip(key.tolist(), total.tolist())) == exact and (np.diff(key.astype(np.int64)) > 0).all()


def test_shards_folder_is_removed(spark, rows, monkeypatch):
    made = []
    real = lm.shared_path
    monkeypatch.setattr(lm, "shared_path", lambda s, name: made.append(real(s, name)) or made[-1])
    lm.score_documents(spark.createDataFrame(rows, "doc_id long, text string")).count()
    from txnlake.sinks.layers import path_exists

    assert len(made) == 1 and not path_exists(spark, made[0])
