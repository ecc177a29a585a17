"""Toxicity scoring by a weighted finite-state pattern grammar.

A lexicon transducer maps the words of a clause to classes (insult with a
weight, threat, target, negation, reported speech, other).  It is composed with
three small transducers, each a table of states: ``negated`` (a negation holds for
the next words), ``reported`` (a verb of saying holds for the rest of the clause)
and ``targeted`` (a target word within reach, before or after).  Each insult or
threat leaves the composition in a context; a clause's evidence is the largest
weight in each context, a text's is the largest of its clauses.  A logistic
model turns that into a probability, so how far a negation or a report excuses
an insult is learned, starting from a stated prior.

Learning takes a bounded sample of the labelled training rows (``max_rows``, by a
hash of the id) without near copies.  The insult lexicon holds words and word
beginnings that toxic texts have and clean ones lack.  For the logistic model each
half of the sample is read with a lexicon of the other half, so it learns from
evidence on unseen texts; the final lexicon comes from the whole sample.  Function
words of the other classes are fixed lists.  Every text is scored whole.

Defined results: null or empty text scores as a text without a match; rows
without a label, or with a null one, teach nothing; a null id counts as the
empty text in the fold rule; repeated label rows count once, a contradiction
teaches the higher label; without labels of both kinds all texts score the
share of toxic ones (0 without any); an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import bounded_sample, cut, remainder, slices

LETTERS = re.compile(r"[^\W\d_]+")
CLAUSE = re.compile(r"[.!?;:\n]+")

# Function words of the grammar's classes (English, German, French, Spanish).
TARGETS = frozenset("you your yours u he she him her they them their we us du dich dir ihr euch sie er ihn tu te toi vous votre ton il elle ils tú ti usted ustedes vosotros él ella ellos".split())
NEGATIONS = frozenset("not no never nobody isn aren wasn don doesn didn won can cannot nicht kein keine keinen nie niemals pas jamais aucun non nunca ningún ninguna jamás".split())
REPORTS = frozenset("said says say wrote writes called calls claimed quoted quote reported sagte sagt schrieb nannte zitiert dit disait écrit appelle cité dijo dice escribió llamó citó".split())
THREATS = frozenset("kill murder hurt destroy punish shoot stab beat die töten umbringen schlagen sterben tuer frapper mourir matar golpear morir".split())

CONTEXTS = ("plain", "targeted", "negated", "reported", "threat")
#: Prior weights of the contexts: a negated or reported insult counts for less.
PRIOR = np.array([1.0, 1.2, 0.4, 0.6, 0.5])
REACH_NEGATION, REACH_TARGET = 3, 4
PREFIXES = (4, 5, 6)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)


def machine(reach: int, opens: int) -> dict[tuple[int, int], int]:
    """A transducer that is open for ``reach`` words after each word of class ``opens``: state = words left open."""
    return {(state, kind): reach if kind == opens else max(0, state - 1) for state in range(reach + 1) for kind in range(6)}


NEGATED = machine(REACH_NEGATION, NEGATION)
TARGETED = machine(REACH_TARGET, TARGET)
REPORTED = {(state, kind): int(state or kind == REPORT) for state in (0, 1) for kind in range(6)}


def states(table: dict[tuple[int, int], int], kinds: list[int]) -> list[int]:
    state, out = 0, []
    for kind in kinds:
        out.append(state)  # the state before the word
        state = table[state, kind]
    return out


def clause_evidence(kinds: list[int], weights: list[float]) -> np.ndarray:
    """The composed machines over one clause: the largest weight in each context."""
    found = np.zeros(len(CONTEXTS))
    negated, reported = states(NEGATED, kinds), states(REPORTED, kinds)
    before = states(TARGETED, kinds)
    after = states(TARGETED, kinds[::-1])[::-1]
    for i, kind in enumerate(kinds):
        if kind == INSULT:
            context = 2 if negated[i] else 3 if reported[i] else 1 if before[i] or after[i] else 0
            found[context] = max(found[context], weights[i])
        elif kind == THREAT and (before[i] or after[i]) and not negated[i] and not reported[i]:
            found[4] = max(found[4], 1.0)
    return found


@dataclass
class Lexicon:
    """Insult weights of words and of word beginnings (of 4 to 6 letters)."""

    words: dict[str, float] = field(default_factory=dict)
    starts: dict[str, float] = field(default_factory=dict)

    def read(self, word: str) -> tuple[int, float]:
        weight = max([self.words.get(word, 0.0), *(self.starts.get(word[:n], 0.0) for n in PREFIXES if len(word) > n)])
        if weight:
            return INSULT, weight
        for kind, members in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS)):
            if word in members:
                return kind, 0.0
        return OTHER, 0.0


class Reader:
    """Evidence of whole texts; what each word means is looked up once (cache of bounded size)."""

    def __init__(self, lexicon: Lexicon, limit: int = 300_000):
        self.lexicon, self.limit, self.known = lexicon, limit, {}

    def _read(self, word: str) -> tuple[int, float]:
        if (got := self.known.get(word)) is None:
            if len(self.known) >= self.limit:
                self.known.clear()
            got = self.known[word] = self.lexicon.read(word)
        return got

    def evidence(self, text: str | None) -> np.ndarray:
        found = np.zeros(len(CONTEXTS))
        low = (text or "").lower()
        read = self._read
        if not any(read(w)[0] in (INSULT, THREAT) for w in set(LETTERS.findall(low))):
            return found
        for clause in CLAUSE.split(low):
            parts = [read(w) for w in LETTERS.findall(clause)]
            if any(kind in (INSULT, THREAT) for kind, _ in parts):
                found = np.maximum(found, clause_evidence([k for k, _ in parts], [w for _, w in parts]))
        return found


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray
    bias: float

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(evidence @ self.weights + self.bias, -50, 50)))


def features(text: str) -> set[str]:
    """Words, and word beginnings marked by ``*``, of a text."""
    words = set(LETTERS.findall(text.lower()))
    return words | {f"{w[:n]}*" for w in words for n in PREFIXES if len(w) > n}


def _sketch(text: str) -> int:
    """The smallest hash of a text's five-word shingles: copies and near copies mostly share it."""
    w = text.lower().split()
    return min((xxhash.xxh64_intdigest(" ".join(w[i : i + 5])) >> 1 for i in range(max(1, len(w) - 4))), default=0)


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        yield pa.RecordBatch.from_arrays([batch.column("text"), batch.column("toxic"), pa.array([_sketch(t) for t in batch.column("text").to_pylist()], pa.int64())], names=["text", "toxic", "sketch"])


def _feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = (Counter(), Counter())

    def out() -> Iterator[pa.RecordBatch]:
        names = list(counts[0].keys() | counts[1].keys())
        for at in range(0, len(names), 50_000):
            part = names[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array([c[x] for x in part], pa.int64()) for c in counts)], names=["feature", "clean", "toxic"])
        for c in counts:
            c.clear()

    for batch in batches:
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts[toxic].update(features(text))
            if len(counts[0]) + len(counts[1]) > 1_000_000:
                yield from out()
    yield from out()


def fit(evidence: np.ndarray, toxic: np.ndarray, strength: float = 0.02, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Logistic regression by Newton's method with a normal prior at ``PRIOR``; weights stay non-negative."""
    x = np.hstack([evidence, np.ones((len(evidence), 1))])
    centre = np.append(PRIOR, -3.0)
    pull = np.full(len(centre), strength)
    w = centre.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (toxic - p) - pull * (w - centre)
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, slope)
        size = np.abs(step).max()
        w = w + step * min(1.0, 2.0 / max(size, 1e-12))
        w[:-1] = np.maximum(w[:-1], 0)
        if size < 1e-6:
            break
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, max_lexicon: int = 20_000) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) labels: at most ``max_rows``."""
    chosen = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = bounded_sample(chosen, ["doc_id"], max_rows)
    rows = docs.select("doc_id", "text").filter("text IS NOT NULL").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("text", "toxic").mapInArrow(_sketched, "text string, toxic int, sketch long")
    rows = rows.groupBy("sketch").agg(F.max_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.max("toxic").alias("toxic"))
    rows = cut(rows, "toxic-sample")
    if (n := rows.count()) > max_rows:  # repeated ids added rows: a share of them keeps the bound, without a merge of texts in one task
        rows = rows.filter(F.xxhash64("sketch") < int(-(2**63) + max_rows / n * 2**64))
    total = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if not total.get(0) or not total.get(1):
        share = total.get(1, 0) / max(1, sum(total.values()))
        return Model(Lexicon(), np.zeros(len(CONTEXTS)), float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    fold = F.pmod(F.xxhash64("sketch", F.lit(7)), F.lit(2))
    halves = [rows.filter(fold == i) for i in (0, 1)]
    evidence = [_evidence(mine, lexicon_of(other, max_lexicon)) for mine, other in (halves, halves[::-1])]
    weights, bias = fit(np.concatenate([e for e, _ in evidence]), np.concatenate([t for _, t in evidence]))
    return Model(lexicon_of(rows, max_lexicon), weights, bias)


def lexicon_of(rows: DataFrame, max_lexicon: int) -> Lexicon:
    """Words and word beginnings of toxic texts that clean texts lack, weighted by their log odds ratio."""
    counts = rows.select("text", "toxic").mapInArrow(_feature_counts, "feature string, clean long, toxic long")
    counts = counts.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    shown = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = shown.get(1, 0), shown.get(0, 0)
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1)))
    found = counts.withColumn("weight", odds).filter((F.col("toxic") >= max(3, 0.004 * toxic)) & (F.col("weight") >= 2.5))
    found = found.orderBy(F.desc(F.col("weight") * F.col("toxic")), "feature").limit(max_lexicon).collect()
    return Lexicon(
        {r["feature"]: r["weight"] for r in found if not r["feature"].endswith("*")},
        {r["feature"][:-1]: r["weight"] for r in found if r["feature"].endswith("*")},
    )


def _evidence(rows: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """The evidence of a bounded sample, and its labels."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for batch in batches:
            found = [reader.evidence(t).tolist() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column("toxic")], names=["evidence", "toxic"])

    got = rows.select("text", "toxic").mapInArrow(run, "evidence array<double>, toxic int").collect()
    return np.array([r["evidence"] for r in got], float).reshape(-1, len(CONTEXTS)), np.array([r["toxic"] for r in got], float)


def score(docs: DataFrame, model: Model, keep: list[str], threshold: float = 0.7) -> DataFrame:
    """The columns ``keep`` with score and predicted for every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        reader = Reader(model.lexicon)
        for batch in slices(batches, "text"):
            p = model.probability(np.array([reader.evidence(t) for t in batch.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[*keep, "score", "predicted"])

    rows = docs.select(*keep, *(["text"] if "text" not in keep else []))
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    return rows.mapInArrow(run, f"{ddl}, score double, predicted int")


HELD_OUT = (3, 1)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; learns from labelled rows that are not held out."""
    held = remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1]
    rows = docs.select("doc_id", "text").withColumn("held_out", held)
    model = train(rows.filter("NOT held_out"), labels.select("doc_id", "toxic").filter(~held))
    return score(rows, model, ["doc_id", "held_out"])
