"""Language ID by word-first backoff.

A word that training has seen is scored by its log frequency in each language.
An unseen word falls back to its longest known character n-grams (from
``max_gram`` down to one character, over the word in boundary marks); only when
none of a length is known does the next shorter length count.

The model keeps what has at least ``min_share`` of a language's words (or of its
n-grams of one length).  At most 1 / min_share entries per language can have
that share, so the model that is sent to the workers has a proven size bound
however large the corpus is, and the rule is the same at every size.  Counts
cover all training rows and whole texts.

Words are runs of letters, in lower case.  The score is the posterior of the
predicted language under the word scores and the share of each language.

Defined results: null text, or text without a letter, is ``und`` with score 0;
rows with null lang are predicted but never learned from; a null id counts as
the empty text in the fold rule; without any training row all is ``und``; ties
go to the alphabetically first language; further columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import bound_batches, remainder, slices

LETTERS = re.compile(r"[^\W\d_]+")
MARK = "\x02"
UNDETERMINED = "und"


def grams(word: str, n: int) -> list[str]:
    """The n-grams of a word in boundary marks; of one character, its letters."""
    if n == 1:
        return list(word)
    marked = f"{MARK}{word}{MARK}"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    """Log frequencies by language: of words, and of n-grams for each length.

    Every worker holds the model, so its entries become places in one matrix: an array for each would take several times the memory."""

    langs: list[str]
    prior: np.ndarray
    words: dict[str, np.ndarray]
    grams: list[dict[str, np.ndarray]]  # longest first

    def __post_init__(self) -> None:
        self.words, self.rows = self._placed(self.words, 0)
        self.grams = [self._placed(g, 1) for g in self.grams]  # row 0 is for unknown n-grams, all zero

    def _placed(self, table: dict[str, np.ndarray], first: int) -> tuple[dict[str, int], np.ndarray]:
        rows = np.vstack([np.zeros((first, len(self.langs)), np.float32), *table.values()])
        return {entry: i for i, entry in enumerate(table, first)}, rows

    def unseen(self, words: list[str]) -> np.ndarray:
        """Scores of words that training hasn't kept: the mean over a word's known n-grams of the greatest length with any."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        left = np.arange(len(words))
        longest = len(self.grams)
        for n, (place, known) in zip(range(longest, 0, -1), self.grams):
            if not len(left) or not place:
                continue
            parts = [grams(words[i], n) for i in left.tolist()]
            at = np.fromiter((place.get(g, 0) for p in parts for g in p), np.int64)
            of = np.repeat(np.arange(len(left)), [len(p) for p in parts])
            count = np.bincount(of, at > 0, len(left))
            rows = known[at]
            some = np.flatnonzero(count)
            for lang in range(len(self.langs)):
                out[left[some], lang] = (np.bincount(of, rows[:, lang], len(left))[some] / count[some]).astype(np.float32)
            left = np.delete(left, some)
        return out


class Scorer:
    """Adds up word scores; the scores of unseen words are kept, ``cache`` of them."""

    def __init__(self, model: Model, cache: int):
        self.model, self.cache = model, cache
        self.known, self.table = model.words, model.rows
        self._reset()

    def _reset(self) -> None:
        self.place = dict(self.known)
        self.rows = self.table

    def totals(self, texts: list[list[str]]) -> np.ndarray:
        """The sum of word scores of each text."""
        out = np.zeros((len(texts), len(self.model.langs)))
        at = 0
        while at < len(texts):  # as many texts at a time as half the cache has words; of a longer text, a part
            end, n = at, 0
            while end < len(texts) and (end == at or n + len(texts[end]) <= self.cache // 2):
                n += len(texts[end])
                end += 1
            for start in range(0, max(1, n), self.cache // 2):
                part = [t[start : start + self.cache // 2] for t in texts[at:end]] if end == at + 1 else texts[at:end]
                self._add(out[at:end], part)
                if end > at + 1:
                    break
            at = end
        return out

    def _add(self, out: np.ndarray, texts: list[list[str]]) -> None:
        new = list(set().union(*texts) - self.place.keys())
        if len(self.place) - len(self.known) + len(new) > self.cache:
            self._reset()
            new = list(set().union(*texts) - self.place.keys())
        if new:
            first = len(self.rows)
            self.rows = np.vstack([self.rows, self.model.unseen(new)])
            self.place.update(zip(new, range(first, first + len(new))))
        flat = np.fromiter((i for t in texts for i in map(self.place.__getitem__, t)), np.int64)
        of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        for lang in range(len(self.model.langs)):
            out[:, lang] += np.bincount(of, self.rows[flat, lang], len(texts))


def _word_counts(flush: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, c in counts.items():
                items = list(c.items())
                for at in range(0, len(items), 50_000):
                    w, n = zip(*items[at : at + 50_000])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(w)), pa.array(w), pa.array(n, pa.int64())], names=["lang", "word", "n"])
            counts.clear()

        for batch in slices(batches, "text", 2 << 20):
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                counts[lang].update(LETTERS.findall(text.lower()))
            if sum(map(len, counts.values())) > flush:
                yield from out()
        yield from out()

    return run


def _gram_counts(max_gram: int):
    """n-grams of distinct words, weighted by the words' counts, combined per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))

        def out() -> Iterator[pa.RecordBatch]:
            for lang, c in counts.items():
                items = list(c.items())
                for at in range(0, len(items), 50_000):
                    g, n = zip(*items[at : at + 50_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(g)), pa.array([len(x) for x in g], pa.int32()), pa.array(g), pa.array(n, pa.int64())],
                        names=["lang", "length", "gram", "n"],
                    )
            counts.clear()

        for batch in batches:
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n"))):
                c = counts[lang]
                for g in word:
                    c[g] += n
                marked = f"{MARK}{word}{MARK}"
                for length in range(2, max_gram + 1):
                    for i in range(len(marked) - length + 1):
                        c[marked[i : i + length]] += n
            if sum(map(len, counts.values())) > 500_000:
                yield from out()
        yield from out()

    return run


def train(docs: DataFrame, max_gram: int = 4, min_share: float = 4e-6, max_languages: int = 200) -> Model:
    """Learn from every row of ``docs`` (text, lang); rows with null text or lang teach nothing.

    The counts stay on the executors' disks until the model stands: tables would leave files in the shared folder."""
    rows = docs.filter("text IS NOT NULL AND lang IS NOT NULL").select("lang", "text")
    counts = rows.mapInArrow(_word_counts(600_000), "lang string, word string, n long")
    counts = counts.groupBy("lang", "word").agg(F.sum("n").alias("n")).persist(StorageLevel.DISK_ONLY)
    gram_rows = counts.mapInArrow(_gram_counts(max_gram), "lang string, length int, gram string, n long")
    gram_rows = gram_rows.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")).persist(StorageLevel.DISK_ONLY)
    try:
        return _model(counts, gram_rows, max_gram, min_share, max_languages)
    finally:
        gram_rows.unpersist()
        counts.unpersist()


def _model(counts: DataFrame, gram_rows: DataFrame, max_gram: int, min_share: float, max_languages: int) -> Model:
    totals = {r["lang"]: r["n"] for r in counts.groupBy("lang").agg(F.sum("n").alias("n")).limit(max_languages + 1).collect()}
    if len(totals) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if that is meant")
    langs = sorted(totals)
    place = {x: i for i, x in enumerate(langs)}

    def kept(frame: DataFrame, per: list[str], of: DataFrame) -> DataFrame:
        """Entries with the share, at most 1 / min_share of each language (and length)."""
        return frame.join(F.broadcast(of), per).filter(F.col("n") >= F.col("total") * min_share)

    sums = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    words = _table(kept(counts, ["lang"], sums).select("word", "lang", "n", "total").collect(), place, min_share)
    gram_sums = gram_rows.groupBy("lang", "length").agg(F.sum("n").alias("total"))
    known = defaultdict(list)
    for r in kept(gram_rows, ["lang", "length"], gram_sums).select("length", "gram", "lang", "n", "total").collect():
        known[r[0]].append(r[1:])
    whole = sum(totals.values()) or 1
    prior = np.log(np.array([max(totals[x], 1) / whole for x in langs], np.float64))
    return Model(langs, prior, words, [_table(known[n], place, min_share) for n in range(max_gram, 0, -1)])


def _table(rows: list, place: dict[str, int], min_share: float) -> dict[str, np.ndarray]:
    """Log frequency by language; a language that lacks an entry gets a tenth of the least share kept."""
    floor = math.log(min_share / 10)
    found: dict[str, np.ndarray] = {}
    for entry, lang, n, total in rows:
        if (row := found.get(entry)) is None:
            row = found[entry] = np.full(len(place), floor, np.float32)
        row[place[lang]] = math.log(n / total)
    return found


def predict(docs: DataFrame, model: Model, keep: list[str], cache: int = 100_000) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score.  A scorer lives as long as its task:
    what a worker process kept would stand beside the later stages' memory."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        reader = Scorer(model, cache)
        for batch in slices(batches, "text", 2 << 20):
            texts = [LETTERS.findall(t.lower()) if t else [] for t in batch.column("text").to_pylist()]
            langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if model.langs:
                total = reader.totals(texts) + model.prior
                best = total.argmax(axis=1)
                sure = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
                for i, words in enumerate(texts):
                    if words:
                        langs[i], scores[i] = model.langs[best[i]], sure[i]
            cols = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(langs, pa.string()), pa.array(scores)], names=[*keep, "lang_pred", "score"])

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return docs.select(*keep, *(["text"] if "text" not in keep else [])).mapInArrow(run, f"{ddl}, lang_pred string, score double")


HELD_OUT = (4, 2)


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from the rows that are not held out."""
    bound_batches(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1])
    model = train(rows.filter("NOT held_out"))
    return predict(rows, model, ["doc_id", "held_out"])
