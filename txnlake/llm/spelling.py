"""Spelling variants: words that differ by one letter, found with bit-sliced position indexes.

Words are counted in one pass over the texts.  Two words are near if one inserted,
deleted or replaced code point turns one into the other.  With h = half the shorter
length, such words share their first h or their last h code points, so the
vocabulary is dealt to blocks by class (the larger length), side and those code
points; the pairs of a class have its length, or its length and the one below.

In a block, a bitset for each (position, letter) says which words have that letter
there.  A query reads its letters once and keeps, for all words of the block at
the same time, the set without an error and three sets with one error: replaced (same
position), inserted in the query (the word lags by one) and inserted in the word (the
word is one ahead).  Bits are ordered by falling count, so the lowest set bit of a
result is the word's form.  The result gives a count and the best word; no pair
leaves a block.

A block of more than ``block_words`` words is dealt out: its index in shares, its
words as queries to every share, so no task holds or asks more than that at once.

Defined results: null text is empty, a null doc_id is the empty text in the
contract's hash; repeated rows count each time; an empty table gives no rows;
further columns are ignored.  Very long words are read like others.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby, islice
from operator import itemgetter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import cut, shuffle_partitions, slices, text_bytes

#: Letters: A-Z (read as a-z) and U+00C0 to U+00FF.
RUN, OTHER = "[a-zÀ-ÿ]{%d,}", re.compile("[^a-zÀ-ÿ]")
DAMAGE = 199
PART = 4 << 20


# --- words ------------------------------------------------------------------------
def parts(text: str, limit: int = PART) -> Iterator[str]:
    """A long text in parts that end at no letter, so no run is cut."""
    at = 0
    while len(text) - at > limit and (end := OTHER.search(text, at + limit)):
        yield text[at : end.start()]
        at = end.end()
    yield text[at:]


def runs_of(text: bytes, doc: bytes, least: int) -> Iterator[list[bytes]]:
    """The runs of at least ``least`` letters, lower-cased, by parts; the contract's typing errors made in some of them."""
    run = re.compile(RUN % least)
    state = crc32(doc + b":")
    for part in parts(text.lower().decode(errors="replace")):
        if found := run.findall(part):
            words = "\n".join(found).encode().split(b"\n")
            for i, h in [(i, h) for i, h in enumerate([crc32(w, state) for w in words]) if not h % DAMAGE]:
                letters, at = found[i], h % len(found[i])
                words[i] = (letters[:at] + letters[at + 1 :]).encode() if len(letters) > least else b""
            yield words


def _counted(least: int, held_most: int = 400_000):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            held.pop(b"", None)
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()).cast(pa.string()), pa.array(held.values(), pa.int64())], names=["word", "c"])

        for batch in slices(batches, "text"):
            for doc, text in zip(text_bytes(batch.column("doc_id")), text_bytes(batch.column("text"))):
                for words in runs_of(text, doc, least):
                    held.update(words)
                if len(held) >= held_most:
                    yield out()
                    held.clear()
        if held:
            yield out()

    return run


def vocabulary(docs: DataFrame, length: int, count: int) -> DataFrame:
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.mapInArrow(_counted(length), "word string, c long")
    return counted.groupBy("word").agg(F.sum("c").alias("n")).filter(F.col("n") >= count)


# --- the bit-sliced index -------------------------------------------------------------
class PositionIndex:
    """Bitsets over a block's words, as whole numbers: bit i is word i."""

    def __init__(self, words: list[str]):
        self.words = words
        self.letter: dict[tuple[int, str], int] = {}
        self.length: dict[int, int] = {}
        letters: dict[tuple[int, str], list[int]] = {}
        lengths: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            lengths.setdefault(len(word), []).append(i)
            for at in enumerate(word):
                letters.setdefault(at, []).append(i)
        self.letter = {at: self._bits(which) for at, which in letters.items()}
        self.length = {n: self._bits(which) for n, which in lengths.items()}

    def _bits(self, which: list[int]) -> int:
        if len(self.words) <= 512:
            return sum(1 << i for i in which)
        row = bytearray((len(self.words) + 7) // 8)
        for i in which:
            row[i >> 3] |= 1 << (i & 7)
        return int.from_bytes(row, "little")

    def near(self, word: str, head: int = 0) -> tuple[int, int]:
        """The words exactly one error away, and those that begin with the first ``head`` letters of ``word``."""
        letter, size = self.letter.get, len(word)
        same = (1 << len(self.words)) - 1
        replaced = more = less = 0
        begin = same
        for i, c in enumerate(word):
            here, ahead = letter((i, c), 0), letter((i + 1, c), 0)
            # less: the query has a letter that the word lacks; more: the word has one that the query lacks.
            less = (less & (letter((i - 1, c), 0) if i else 0)) | same
            more = (more | same) & ahead
            replaced = (replaced & here) | (same & ~here)
            same &= here
            if i == head - 1:
                begin = same
        length = self.length.get
        found = (replaced & length(size, 0)) | (less & length(size - 1, 0)) | ((more | same) & length(size + 1, 0))
        return found, begin


def _block(rows: list[tuple], asks: Iterator[tuple] | None, size: int, side: int) -> Iterator[tuple]:
    """For each query that has near words among ``rows`` (word, n): itself, their number, the best one and its n."""
    index = PositionIndex([w for w, _ in rows])
    half = (size - 1) // 2
    for word, _ in rows if asks is None else asks:
        found, begin = index.near(word, half)
        # Words of the lower length meet each other in their own class.
        found &= index.length.get(size, 0) | (index.length.get(size - 1, 0) if len(word) == size else 0)
        found &= ~begin if side else begin  # a pair that shares both sides counts once
        if found:
            best = rows[(found & -found).bit_length() - 1]
            yield word, found.bit_count(), *best


def _matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, share, class, side, role (0: index, 1: query), falling n, word.  A share's index is held, queries pass by."""

    def read():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("block", "share", "role", "size", "side", "alone", "word", "n")))

    def out(rows: list[tuple]) -> pa.RecordBatch:
        word, count, best, n = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(count, pa.int64()), pa.array(best, pa.string()), pa.array(n, pa.int64())], names=["word", "near", "best", "best_n"])

    def answers():
        for (_, _, size, side), group in groupby(read(), itemgetter(0, 1, 3, 4)):
            index = []
            for role, some in groupby(group, itemgetter(2)):
                if role == 0:
                    index = [(r[6], r[7], r[5]) for r in some]
                    if index[0][2]:
                        yield from _block([x[:2] for x in index], None, size, side)
                elif index:
                    yield from _block([x[:2] for x in index], (r[6:] for r in some), size, side)

    found = answers()
    while done := list(islice(found, 10_000)):
        yield out(done)


def near_words(words: DataFrame, block_words: int = 1 << 16) -> DataFrame:
    """word, near (number of near words), best (the most frequent, then smallest), best_n; words without a near one are absent."""
    size = F.length("word")
    blocks = F.array(
        *(
            F.struct(
                (size + more).cast("int").alias("size"),
                F.lit(side).alias("side"),
                (F.substring("word", 1, half) if side == 0 else F.expr(f"right(word, cast((length(word) + {more} - 1) div 2 as int))")).alias("part"),
            )
            for more in (0, 1)
            for half in [F.expr(f"cast((length(word) + {more} - 1) div 2 as int)")]
            for side in (0, 1)
        )
    )
    rows = words.select("word", "n", F.explode(blocks).alias("b")).select("word", "n", "b.size", "b.side", F.xxhash64("b.size", "b.side", "b.part").alias("block"))
    counts = rows.groupBy("block").agg(F.count(F.lit(1)).alias("rows"))
    # A block of one word has no pair: it isn't dealt out.
    rows = rows.join(counts.filter("rows > 1").select("block", F.ceil(F.col("rows") / block_words).cast("int").alias("shares")), "block")
    own = F.pmod(F.xxhash64("word"), F.col("shares")).cast("int")
    index = rows.select("block", own.alias("share"), F.lit(0).alias("role"), "size", "side", (F.col("shares") == 1).alias("alone"), "word", "n")
    asks = rows.filter("shares > 1").select(
        "block", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(1).alias("role"), "size", "side", F.lit(False).alias("alone"), "word", "n"
    )
    dealt = index.unionByName(asks).repartition(shuffle_partitions(words.sparkSession), "block", "share")
    dealt = dealt.sortWithinPartitions("block", "share", "size", "side", "role", F.desc("n"), "word")
    found = dealt.mapInArrow(_matched, "word string, near long, best string, best_n long")
    # The largest n, then the smallest word.
    order = F.struct((-F.col("best_n")).alias("m"), F.col("best"))
    return found.groupBy("word").agg(F.sum("near").alias("near"), F.min(order).alias("b")).select("word", "near", F.col("b.best").alias("best"), (-F.col("b.m")).alias("best_n"))


# --- forms and roots ----------------------------------------------------------------
def variants(docs: DataFrame, length: int = 6, count: int = 5, ratio: int = 5, block_words: int = 1 << 16) -> DataFrame:
    """A row for each word of the vocabulary: word, form, root, n, n_near, form_n."""
    words = cut(vocabulary(docs, length, count), "spelling-words")
    near = near_words(words, block_words)
    rows = words.join(near, "word", "left").withColumn("is_form", F.col("best_n") >= ratio * F.col("n"))
    rows = cut(
        rows.select(
            "word",
            F.when(F.col("is_form"), F.col("best")).alias("form"),
            "n",
            F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
            F.when(F.col("is_form"), F.col("best_n")).alias("form_n"),
        ),
        "spelling-forms",
    )
    # Counts rise at least ``ratio`` times with each step, so chains are short and each round halves them.
    steps = cut(rows.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        longer = cut(steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-steps")
        steps = longer.drop("moved")
        if longer.filter("moved").isEmpty():
            break
    return rows.join(steps, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
