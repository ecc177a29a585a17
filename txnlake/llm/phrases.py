"""Collocations of two and three words, by best-first growth with admissible bounds.

Everything is counted per language.  A phrase of a words has the score
floor(1000000 a a / (l r)) of its lowest-scoring cut, where l and r are the
counts of its two parts.  Phrases grow from frequent prefixes:

1. Words are counted under 64-bit hashes that are checked to be injective (a
   further seed is taken if two words share one).
2. Pairs of frequent words are counted.  No count of a phrase exceeds that of any
   part, so a triple that begins with a pair of count b and first word of count l
   scores at most b / l (its first cut), and one that ends with a pair of count b
   and last word of count r at most b / r (its second).
3. Best first: each language gets a threshold, which some thousands of its pairs
   reach.  Expanded are the pairs whose bounds reach it, and on both sides those
   that reach it themselves, as a longer phrase may drop them; only the triples
   that they allow are counted.  What is at or above the threshold is then known
   exactly.  A language with enough survivors there is settled, ties included;
   for the others the threshold falls, down to 0, where nothing is left out.

The frontier goes to the tasks as a Bloom filter of at most 2^28 bits.  A false
positive lets a triple be counted that isn't needed and changes no result.

Defined results: null text is empty, null language is ``und``; repeated rows count
each time; a text or language without words, or an empty table, gives no rows;
further columns are ignored.  Counts must stay below 10^15.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txnlake.llm.common import cut, shuffle_partitions, slices, text_bytes
from txnlake.llm.tokens import _base_powers, mix

_U = np.uint64
UNKNOWN_LANG = "und"
#: A piece ends at these bytes; within it, words stand between blanks.
BREAK = re.compile(rb"[.,;:!?\x0A-\x0D]")
_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[ord(c) for c in ".,;:!?\x0a\x0b\x0c\x0d"]] = 2

SLICE_BYTES, CHUNK_ROWS = 1 << 20, 1_000_000


# --- texts as arrays of hashes ----------------------------------------------
def byte_values(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte; A-Z share the values of a-z."""
    value = np.random.default_rng(seed).integers(1, 2**64, 256, dtype=np.uint64)
    value[ord("A") : ord("Z") + 1] = value[ord("a") : ord("z") + 1]
    return value


def parts(text: bytes, limit: int = SLICE_BYTES) -> list[bytes]:
    """A long text in parts that end where a piece ends: no phrase stands across."""
    out, at = [], 0
    while len(text) - at > limit and (end := BREAK.search(text, at + limit)):
        out.append(text[at : end.start()])
        at = end.end()
    return [*out, text[at:]]


def spans(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The buffer of all texts, each word's start and end in it, its text, and whether the word before is in the same piece."""
    buffer = b"\n".join([b"", *texts, b""])
    kind = _CLASS[np.frombuffer(buffer, np.uint8)]
    gap = kind > 0
    turn = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    start, end = turn[0::2], turn[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[start]
    joined = np.zeros(len(start), bool)
    joined[1:] = piece[1:] == piece[:-1]
    of = np.searchsorted(np.cumsum([1, *(len(t) + 1 for t in texts)]), start, side="right") - 1
    return buffer, start, end, of, joined


def hashes(buffer: bytes, start: np.ndarray, end: np.ndarray, salt: np.ndarray, value: np.ndarray) -> np.ndarray:
    """A word's hash: the sum of its bytes' values times rising powers of an odd base, mixed with its language's salt."""
    raw = np.frombuffer(buffer, np.uint8)
    power, inverse = _base_powers(len(raw))
    sums = np.zeros(len(raw) + 1, _U)
    np.cumsum(value[raw] * power[: len(raw)], out=sums[1:])
    return mix(mix((sums[end] - sums[start]) * inverse[start]) ^ salt)


def _read(batches: Iterator[pa.RecordBatch], seed: int):
    """The languages of a slice's texts, its buffer, and each word's start, end, text, ``joined`` and hash."""
    value = byte_values(seed)
    for batch in slices(batches, "text", SLICE_BYTES):
        texts, langs = [], []
        for text, lang in zip(text_bytes(batch.column("text")), batch.column("lang").to_pylist()):
            if text:
                own = parts(text)
                texts += own
                langs += [lang] * len(own)
        if texts:
            buffer, start, end, of, joined = spans(texts)
            salts = {x: xxhash.xxh64_intdigest(x.encode(), seed) for x in set(langs)}
            salt = np.array([salts[x] for x in langs], _U)
            yield langs, buffer, start, end, of, joined, hashes(buffer, start, end, salt[of], value)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


# --- counting -----------------------------------------------------------------
def count_words(seed: int, held_most: int = 200_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def out() -> pa.RecordBatch:
            h = np.fromiter(held, _U, len(held))
            c, lang, word = zip(*held.values())
            return pa.RecordBatch.from_arrays([_signed(h), pa.array(lang, pa.string()), pa.array(word, pa.binary()), pa.array(c, pa.int64())], names=["h", "lang", "word", "c"])

        for langs, buffer, start, end, of, _, h in _read(batches, seed):
            key, first, count = np.unique(h, return_index=True, return_counts=True)
            for k, c, a, b, d in zip(key.tolist(), count.tolist(), start[first].tolist(), end[first].tolist(), of[first].tolist()):
                word = buffer[a:b].lower()
                seen = held.get(k)
                if seen is None:
                    held[k] = [c, langs[d], word]
                elif seen[2] == word and seen[1] == langs[d]:
                    seen[0] += c
                else:  # two words of one hash: both are reported
                    yield pa.RecordBatch.from_arrays([_signed(np.array([k], _U)), pa.array([langs[d]], pa.string()), pa.array([word], pa.binary()), pa.array([c], pa.int64())], names=["h", "lang", "word", "c"])
            if len(held) >= held_most:
                yield out()
                held.clear()
        if held:
            yield out()

    return run


def _counted(columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """The different rows with their numbers."""
    order = np.argsort(pair_key(columns[-2], columns[-1]) if len(columns) == 2 else pair_key(pair_key(columns[0], columns[1]), columns[2]))
    rows = [c[order] for c in columns]
    new = np.ones(len(order), bool)
    new[1:] = np.logical_or.reduce([r[1:] != r[:-1] for r in rows])
    at = np.flatnonzero(new)
    arrays = [*(_signed(r[at]) for r in rows), pa.array(np.diff(np.append(at, len(order))))]
    yield from pa.table(arrays, names=[*(f"h{i + 1}" for i in range(len(rows))), "c"]).to_batches(max_chunksize=100_000)


def _count_grams(seed: int, pick, size: int):
    """``pick`` gives for each word whether a phrase of ``size`` words that ends with it is to be counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        rows = 0
        for *_, joined, h in _read(batches, seed):
            at = np.flatnonzero(pick(joined, h))
            held.append([h[at - size + 1 + i] for i in range(size)])
            rows += len(at)
            if rows >= CHUNK_ROWS:
                yield from _counted([np.concatenate(c) for c in zip(*held)])
                held, rows = [], 0
        if rows:
            yield from _counted([np.concatenate(c) for c in zip(*held)])

    return run


# --- the frontier's filter -------------------------------------------------------
def pair_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _U(0x9E3779B97F4A7C15) + b)


def tagged(key: np.ndarray, tag: np.ndarray | int) -> np.ndarray:
    return mix(key + np.asarray(tag, _U) * _U(0xD1B54A32D192ED03))


SLICES, MOST_BITS, PROBES = 64, 1 << 28, 4


def _places(key: np.ndarray, width: int):
    """Bits of a key, all in the slice that its highest bits name; a slice has 2^width bits."""
    step = mix(key) | _U(1)
    at = (key >> _U(58)) << _U(width)
    for _ in range(PROBES):
        key = key + step
        yield at + ((key >> _U(5)) & _U((1 << width) - 1))


class Bloom:
    def __init__(self, bits: np.ndarray, width: int):
        self.bits, self.width = bits, width

    def has(self, key: np.ndarray) -> np.ndarray:
        left = np.arange(len(key))
        probes = [None] * len(key) if not len(key) else _places(key, self.width)
        for place in probes:
            place = place[left]
            left = left[(self.bits[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)) & 1 == 1]
        out = np.zeros(len(key), bool)
        out[left] = True
        return out


def filter_of(keys: DataFrame, make) -> Bloom:
    """A filter of the rows' keys (``make`` gives them for a batch): 16 bits a key, at most ``MOST_BITS`` in all.

    Each slice is filled by the one task that its keys go to; the driver only joins the slices."""
    width = max(8, min(MOST_BITS // SLICES, 16 * keys.count() // SLICES).bit_length())
    width = min(width, (MOST_BITS // SLICES).bit_length() - 1)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = make(batch)
            yield pa.RecordBatch.from_arrays([pa.array((key >> _U(58)).astype(np.int32)), _signed(key)], names=["slice", "key"])

    def filled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for batch in batches:
            key = batch.column("key").to_numpy(zero_copy_only=False).view(_U)
            piece = batch.column("slice").to_numpy(zero_copy_only=False)
            for s in np.unique(piece).tolist():
                bits = own.setdefault(s, np.zeros(1 << width, bool))
                for place in _places(key[piece == s], width):
                    bits[(place & _U((1 << width) - 1)).astype(np.int64)] = True
        for s, bits in own.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())], names=["slice", "bits"])

    spark = keys.sparkSession
    rows = keys.mapInArrow(hashed, "slice int, key long").repartition(min(SLICES, shuffle_partitions(spark)), "slice")
    whole = np.zeros(SLICES << width >> 3, np.uint8)
    size = 1 << width >> 3
    for r in rows.mapInArrow(filled, "slice int, bits binary").collect():  # at most MOST_BITS in all
        whole[r["slice"] * size : (r["slice"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return Bloom(whole, width)


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64).view(_U)


# --- growth -----------------------------------------------------------------------
def score_of(a: str, left: str, right: str):
    """floor(1000000 a a / (left right)) in whole numbers of up to 38 digits."""
    wide = f"cast(1000000 as decimal(7,0)) * cast({a} as decimal(15,0)) * cast({a} as decimal(15,0))"
    return F.expr(f"({wide}) div (cast({left} as decimal(18,0)) * cast({right} as decimal(18,0)))")


#: Most languages whose rows are broadcast.
MAX_BROADCAST_LANGS = 100_000


def _by_lang(rows: DataFrame) -> DataFrame:
    """A table of a row for each language, to be joined: without moving the other side, in which one language may
    have most rows, while its checked size allows."""
    return F.broadcast(rows) if rows.count() <= MAX_BROADCAST_LANGS else rows


def _thresholds(pairs: DataFrame, open_: DataFrame, wanted: int, grid: int) -> DataFrame:
    """For each open language the highest multiple of ``grid`` that ``wanted`` of its pairs reach; 0 if there are fewer."""
    bins = pairs.groupBy("lang", F.expr(f"score div {grid}").alias("bin")).agg(F.count(F.lit(1)).alias("rows"))
    above = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("bin")))  # 1 + 1000000 / grid bins at most
    reached = bins.withColumn("above", above).filter(F.col("above") >= wanted).groupBy("lang").agg((F.max("bin") * grid).alias("t"))
    return open_.join(reached, "lang", "left").select("lang", F.coalesce("t", F.lit(0)).alias("t"))


def _triples(rows: DataFrame, seed: int, pairs: DataFrame, limits: DataFrame, least: int) -> DataFrame:
    """All triples that score at least their language's threshold, or may drop a pair that does."""
    spark = rows.sparkSession
    reach = pairs.join(_by_lang(limits), "lang").select(
        "h1", "h2",
        F.explode(
            F.array_compact(
                F.array(
                    F.when(F.expr("1000000 * cast(a as decimal(18,0)) >= cast(t as decimal(18,0)) * l"), 1),
                    F.when(F.expr("1000000 * cast(a as decimal(18,0)) >= cast(t as decimal(18,0)) * r"), 2),
                    F.when(F.expr("score >= t"), 3),
                )
            )
        ).alias("tag"),
    )
    reach = cut(reach, "phrase-frontier")
    frontier = spark.sparkContext.broadcast(
        filter_of(reach, lambda b: tagged(pair_key(_column(b, "h1"), _column(b, "h2")), _column(b, "tag")))
    )

    def pick(joined: np.ndarray, h: np.ndarray) -> np.ndarray:
        bloom = frontier.value
        here = np.flatnonzero(joined)
        key = pair_key(h[here - 1], h[here])
        prefix, suffix, self_ = (np.zeros(len(h), bool) for _ in range(3))
        prefix[here], suffix[here], self_[here] = (bloom.has(tagged(key, t)) for t in (1, 2, 3))
        out = np.zeros(len(h), bool)
        out[1:] = joined[1:] & joined[:-1] & ((prefix[:-1] & suffix[1:]) | self_[:-1] | self_[1:])
        return out

    grams = rows.mapInArrow(_count_grams(seed, pick, 3), "h1 long, h2 long, h3 long, c long")
    grams = grams.groupBy("h1", "h2", "h3").agg(F.sum("c").alias("a")).filter(F.col("a") >= least)
    head = pairs.select("h1", "h2", "lang", F.col("a").alias("head"), F.col("l").alias("first"))
    tail = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("tail"), F.col("r").alias("last"))
    grams = grams.join(head, ["h1", "h2"]).join(tail, ["h2", "h3"])
    grams = grams.withColumn("s1", score_of("a", "first", "tail")).withColumn("s2", score_of("a", "head", "last"))
    one = F.col("s1") <= F.col("s2")  # the lowest cut counts, ties to the shorter first part
    return cut(
        grams.select(
            "lang", "h1", "h2", "h3", "a",
            F.when(one, F.col("first")).otherwise(F.col("head")).alias("l"),
            F.when(one, F.col("tail")).otherwise(F.col("last")).alias("r"),
            F.least("s1", "s2").alias("score"),
        ),
        "phrase-triples",
    )


def collocations(docs: DataFrame, top: int = 2000, least: int = 10, inside_percent: int = 50, grid: int = 1000) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Candidates occur at least ``least`` times; one goes if a longer candidate that holds it has
    ``inside_percent`` of its occurrences or more."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"))
    spark = docs.sparkSession
    seed = 0
    while True:
        seed += 1
        words = rows.mapInArrow(count_words(seed), "h long, lang string, word binary, c long")
        words = cut(words.groupBy("h", "lang", "word").agg(F.sum("c").alias("f")), "phrase-words")
        if words.groupBy("h").count().filter("count > 1").isEmpty():
            break
    frequent = words.filter(F.col("f") >= least)
    known = spark.sparkContext.broadcast(filter_of(frequent.select("h"), lambda b: _column(b, "h")))

    def pick(joined: np.ndarray, h: np.ndarray) -> np.ndarray:
        often = known.value.has(h)
        out = joined & often
        out[1:] &= often[:-1]
        return out

    pairs = rows.mapInArrow(_count_grams(seed, pick, 2), "h1 long, h2 long, c long")
    pairs = pairs.groupBy("h1", "h2").agg(F.sum("c").alias("a")).filter(F.col("a") >= least)
    left = frequent.select(F.col("h").alias("h1"), "lang", F.col("f").alias("l"))
    right = frequent.select(F.col("h").alias("h2"), F.col("f").alias("r"))
    pairs = cut(pairs.join(left, "h1").join(right, "h2").withColumn("score", score_of("a", "l", "r")), "phrase-pairs")

    out, open_, wanted = None, pairs.select("lang").distinct(), 4 * top
    while True:
        limits = cut(_thresholds(pairs, open_, wanted, grid), "phrase-limits")
        if limits.isEmpty():
            break
        triples = _triples(rows, seed, pairs, limits, least)
        longer = triples.select("h1", "h2", "a").union(triples.select("h2", "h3", "a")).toDF("h1", "h2", "long").groupBy("h1", "h2").agg(F.max("long").alias("long"))
        alive = pairs.join(longer, ["h1", "h2"], "left").filter(F.col("long").isNull() | (100 * F.col("long") < inside_percent * F.col("a")))
        columns = ["lang", "h1", "h2", "h3", "a", "l", "r", "score"]
        both = alive.withColumn("h3", F.lit(None).cast("long")).select(columns).union(triples.select(columns))
        both = cut(both.join(_by_lang(limits), "lang").filter("score >= t"), "phrase-survivors")
        counts = limits.join(both.groupBy("lang").agg(F.count(F.lit(1)).alias("rows")), "lang", "left")
        settled = cut(counts.filter((F.col("t") == 0) | (F.col("rows") >= top)).select("lang"), "phrase-settled")
        own = both.drop("t").join(_by_lang(settled), "lang", "left_semi")
        out = own if out is None else out.unionByName(own)
        open_ = cut(limits.select("lang").join(settled, "lang", "left_anti"), "phrase-open")
        wanted *= 8
    if out is None:
        out = pairs.withColumn("h3", F.lit(None).cast("long"))
    return _ranked(out, words, frequent, top)


def _ranked(found: DataFrame, words: DataFrame, frequent: DataFrame, top: int) -> DataFrame:
    text = frequent.select("h", F.col("word").cast("string").alias("w"))
    for i in (1, 2, 3):
        found = found.join(text.toDF(f"h{i}", f"w{i}"), f"h{i}", "left" if i == 3 else "inner")
    found = found.withColumn("phrase", F.concat_ws(" ", "w1", "w2", "w3"))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # In two steps, so no language's survivors meet in one task: the first of each share, then the first of those.
    shares = shuffle_partitions(found.sparkSession)
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(shares))).orderBy(*order)
    found = found.withColumn("rank", F.row_number().over(share)).filter(F.col("rank") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    n = cut(words.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    return found.join(_by_lang(n), "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
