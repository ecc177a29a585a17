"""Mixing sources to target weights by iterative proportional fitting.

The token weights of the cells source x language x topic are raked to target
shares of each of the three marginals in turn until all three hold; a document's
probability is its cell's weight, scaled so that the whole sample has ``fraction``
of the tokens.  A probability can't pass 1: a cell at 1 stays there and the other
cells of its marginals take up the rest.  Documents are then drawn by a hash of
their id, so a draw is repeatable and needs no shuffle.

Targets are stated by the caller for named values (at most ``MAX_TARGETS`` in
all), or a dimension is ``EQUAL``: every value that the data hold with at least
``TAIL`` of the tokens gets the same share, or all that it can supply if that is
less.  Every other value of a dimension falls into one rest cell, which keeps
its natural share unless a target for ``*`` is stated.  So the table of cells has
a proven bound, whatever the data hold, and can be fitted on the driver and
broadcast; token counts come from one partial aggregate over all documents.

Topic: documents carry no topic of their own, so the third marginal is a length
profile, a bucket of a text's number of words and its mean word length (``topic``);
a caller with topics passes them as ``topic_of``.

Defined results: null text has no token, weight 0 and the topic ``none``; null
source or language is the value ``unknown``; repeated rows are documents of their
own but share a draw; null ids draw by the empty text; a target whose value the
data lack is shared out among the others; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import WHITE, cut

MAX_TARGETS = 300
REST = "*"
EQUAL = "equal"
#: The share of the tokens from which on a value has a target of its own in an ``EQUAL`` dimension: 200 values at most.
TAIL = 1 / 200
DIMENSIONS = ("source", "lang", "topic")

#: Production targets: all sources alike, whatever their names, English at half. Targets must be within reach: a topic
#: with 1 % of the tokens can't be a quarter of a sample of a quarter; such a marginal ends short of its target.
TARGETS: dict[str, dict[str, float] | str] = {
    "source": EQUAL,
    "lang": {"en": 0.5, "de": 0.2, "fr": 0.2, "es": 0.1},
    "topic": {"brief": 0.01, "plain": 0.4, "dense": 0.25, "long": 0.34},
}
FRACTION = 0.25


def n_words(text: str = "text") -> Column:
    """Tokens of a text: its words between white space."""
    trimmed = F.regexp_replace(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " "), "^ | $", "")
    return F.when(trimmed == "", 0).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1).cast("long")


def topic(text: str = "text", n: str = "n_tokens") -> Column:
    """The default third marginal, a length profile: buckets of a text's length and its mean word length, not a subject."""
    mean = F.length(text) / F.col(n)
    return (
        F.when(F.col(n) == 0, "none").when(F.col(n) < 60, "brief").when(F.col(n) >= 1000, "long").when(mean < 6.2, "plain").otherwise("dense")
    )


def rake(tokens: np.ndarray, cells: list[np.ndarray], targets: list[np.ndarray], fraction: float, rounds: int = 500, tolerance: float = 1e-9) -> np.ndarray:
    """Probabilities of the cells: within 0 to 1, ``fraction`` of all tokens, each marginal at its target shares.

    ``cells[d]`` numbers each cell's value in dimension d; ``targets[d]`` has that dimension's shares."""
    total = tokens.sum()
    if not total:
        return np.zeros(len(tokens))
    p = np.full(len(tokens), fraction)
    for _ in range(rounds):
        before = p.copy()
        for of, share in zip(cells, targets):
            want = share * fraction * total
            for _ in range(20):  # cells that reach 1 hand their excess to the others of the value
                full = p >= 1
                fixed = np.bincount(of, tokens * full, len(share))
                free = np.bincount(of, tokens * np.where(full, 0, p), len(share))
                factor = np.where(free > 0, np.maximum(want - fixed, 0) / np.where(free > 0, free, 1), 1.0)
                p = np.where(full, np.where((fixed > want)[of], np.minimum(1, (want / np.where(fixed > 0, fixed, 1))[of]), 1.0), p * factor[of])
                if (p <= 1).all():
                    break
                p = np.minimum(p, 1)
        if np.abs(p - before).max() < tolerance:
            break
    return p


def equal_shares(natural: np.ndarray, fraction: float) -> np.ndarray:
    """The same share of the sum of ``natural`` for all, except for those that can't supply it (at probability 1): they give what they can."""
    share, most, total = np.zeros(len(natural)), natural / fraction, natural.sum()
    open_ = np.ones(len(natural), bool)
    while open_.any():
        level = (total - share[~open_].sum()) / open_.sum()
        short = open_ & (most < level)
        if not short.any():
            share[open_] = level
            break
        share[short] = most[short]
        open_ &= ~short
    return share


def _stated(rows: DataFrame, targets: dict[str, dict[str, float] | str], fraction: float) -> dict[str, dict[str, float]]:
    """The targets with those of ``EQUAL`` dimensions taken from the data."""
    out = {}
    for d in DIMENSIONS:
        stated = targets.get(d, {})
        if stated == EQUAL:
            sums = rows.groupBy(d).agg(F.sum("n_tokens").alias("n"))
            total = rows.agg(F.sum("n_tokens")).first()[0] or 0
            found = sums.filter((F.col("n") > 0) & (F.col("n") >= TAIL * total)).orderBy(d).collect()
            shares = equal_shares(np.array([r["n"] for r in found], float) / max(total, 1), fraction)
            stated = {r[d]: float(x) for r, x in zip(found, shares)}
        out[d] = stated
    return out


def mix(docs: DataFrame, targets: dict[str, dict[str, float] | str] = TARGETS, fraction: float = FRACTION, seed: str = "mix", topic_of: Column | None = None) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, probability, sampled for every row of ``docs``."""
    if sum(len(x) for x in targets.values() if x != EQUAL) > MAX_TARGETS:
        raise ValueError(f"at most {MAX_TARGETS} targets can be stated")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce("source", F.lit("unknown")).alias("source"), F.coalesce("lang", F.lit("unknown")).alias("lang"))
    rows = rows.withColumn("n_tokens", n_words())
    rows = rows.withColumn("topic", F.coalesce(topic() if topic_of is None else topic_of, F.lit("none"))).drop("text")
    rows = cut(rows.select("doc_id", *DIMENSIONS, "n_tokens"), "mix-rows")
    equal = [d for d in DIMENSIONS if targets.get(d) == EQUAL]
    targets = _stated(rows, targets, fraction)
    # Named values are marked, so that one of an equal dimension that is called as the rest is not taken for it.
    names = {d: [v for v in targets[d] if v != REST or d in equal] for d in DIMENSIONS}
    rest = {d: None if d in equal else targets[d].get(REST) for d in DIMENSIONS}
    named = [F.when(F.col(d).isin(names[d]), F.concat(F.lit("="), F.col(d))).otherwise(REST).alias(f"cell_{d}") for d in DIMENSIONS]
    keys = [f"cell_{d}" for d in DIMENSIONS]
    found = rows.select(*named, "n_tokens").groupBy(*keys).agg(F.sum("n_tokens").alias("n")).orderBy(*keys).collect()
    tokens = np.array([r["n"] or 0 for r in found], float)
    places, shares = [], []
    for d, key in zip(DIMENSIONS, keys):
        values = sorted({r[key] for r in found})
        place = {v: i for i, v in enumerate(values)}
        of = np.array([place[r[key]] for r in found], int)
        natural = np.bincount(of, tokens, len(values)) / max(tokens.sum(), 1)
        share = np.array([targets[d][v[1:]] if v != REST else natural[i] if rest[d] is None else rest[d] for i, v in enumerate(values)])
        if REST in place and rest[d] is None:  # the rest keeps its share, the stated ones divide what is left
            others = share.sum() - share[place[REST]]
            share = np.where(np.arange(len(values)) == place[REST], share, share * (1 - natural[place[REST]]) / others if others else 0)
        places.append(of)
        shares.append(share * (natural > 0) / max((share * (natural > 0)).sum(), 1e-300))
    p = rake(tokens, places, shares, fraction)
    # As an Arrow table: rows would go through Python workers of their own, which then stay beside those of the operators.
    columns = {k: pa.array([r[k] for r in found], pa.string()) for k in keys} | {"probability": pa.array(p, pa.float64())}
    cells = docs.sparkSession.createDataFrame(pa.table(columns))
    # The cells number at most (stated, or 1 / TAIL, + 1) in each dimension, so the broadcast has a bound.
    out = rows.select("*", *named).join(F.broadcast(cells), keys, "left")
    draw = F.conv(F.substring(F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10).cast("double") / float(16**13)
    return out.select("doc_id", *DIMENSIONS, "n_tokens", F.coalesce("probability", F.lit(0.0)).alias("probability"), (draw < F.coalesce("probability", F.lit(0.0))).alias("sampled"))
