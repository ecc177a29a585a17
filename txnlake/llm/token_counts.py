"""Token counts of sections by offset-mapped attribution.

Each document is encoded once, as a whole, so its counts add up to what a model
would see; encoding section by section would not.  Every token's span of
characters follows from the lengths of the tokens' bytes.  The spans are joined
to the sections' intervals (both are sorted: a binary search), and a token that
crosses a border goes to one section by a stated rule:

- ``first``: the section of its first character;
- ``last``: the section of its last character;
- ``largest``: the section with most of its characters, the earlier one in a tie.

A token outside all sections counts for none of them (``section`` 0, only present
if there are such tokens).  A token that holds part of a character spans that character.

Sections are given by a function from a text to sorted, disjoint spans; by
default they are the lines, each with its line feed, which cover the whole text.

Defined results: null text is empty; an empty text has one empty section; without
line feeds the text is one section; repeated rows and null ids are kept, each row
attributed on its own; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

from base64 import b64decode
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import slices

VOCABULARY = "byte_bpe_50k.tiktoken"
RULES = ("first", "last", "largest")


class Encoder:
    """Byte-level BPE from a file of ranks; one for each worker process."""

    def __init__(self, path: str, pattern: str):
        import tiktoken

        with open(path, "rb") as file:
            ranks = {b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        self.encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and end of every token."""
        ids = np.array(self.encode(text), np.int64)
        if not len(ids):
            return ids, ids
        raw = np.frombuffer(text.encode(), np.uint8)
        end = np.cumsum(self.lengths[ids])
        of = np.cumsum((raw & 0xC0) != 0x80) - 1  # each byte's character
        return of[end - self.lengths[ids]], of[end - 1] + 1


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, pattern)
    return _ENCODERS[path]


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The spans of a text's lines, each with its line feed."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    ends = np.flatnonzero(points == 10) + 1
    if not len(ends) or ends[-1] < len(points):
        ends = np.append(ends, len(points))
    return np.concatenate([[0], ends[:-1]]), ends


def windows(size: int) -> Callable[[str], tuple[np.ndarray, np.ndarray]]:
    """Sections of ``size`` characters, whose borders fall inside tokens."""

    def spans(text: str) -> tuple[np.ndarray, np.ndarray]:
        start = np.arange(0, max(1, len(text)), size)
        return start, np.minimum(start + size, len(text))

    return spans


def attribute(start: np.ndarray, end: np.ndarray, section_start: np.ndarray, section_end: np.ndarray, rule: str = "first") -> tuple[np.ndarray, np.ndarray]:
    """The section of each token (-1: none), and whether it crosses a border."""
    n = len(section_start)
    if not n:
        return np.full(len(start), -1), np.zeros(len(start), bool)

    def at(point: np.ndarray) -> np.ndarray:
        found = np.searchsorted(section_start, point, "right") - 1
        return np.where((found >= 0) & (point < section_end[found]), found, -1)

    first, last = at(start), at(end - 1)
    crossing = first != last
    if rule == "first":
        return first, crossing
    if rule == "last":
        return last, crossing
    out = first.copy()
    low, high = np.searchsorted(section_end, start, "right"), np.searchsorted(section_start, end, "left")
    for i in np.flatnonzero(high - low > 1):
        shared = np.minimum(section_end[low[i] : high[i]], end[i]) - np.maximum(section_start[low[i] : high[i]], start[i])
        out[i] = low[i] + int(np.argmax(shared))
    single = high - low == 1
    return np.where(single, low, np.where(high > low, out, -1)), crossing


RESULT = "doc_id long, section int, char_start long, char_end long, n_tokens long, n_crossing long, doc_tokens long"


def section_tokens(
    docs: DataFrame,
    rule: str = "first",
    sections: Callable[[str], tuple[np.ndarray, np.ndarray]] = lines,
    path: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """A row for each section of each row of ``docs`` (doc_id, text), numbered from 1."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    if path is None:
        import public_tokenizers

        path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(path, pattern)
        for batch in slices(batches, "text", 1 << 20):
            parts, rows = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                start, end = tokens.spans(text)
                a, b = sections(text)
                of, crossing = attribute(start, end, a, b, rule)
                count = np.bincount(of + 1, minlength=len(a) + 1)
                cross = np.bincount(of + 1, crossing, len(a) + 1).astype(np.int64)
                number = np.arange(len(a) + 1)
                spans = np.concatenate([[0], a]), np.concatenate([[0], b])
                use = slice(0 if count[0] else 1, None)
                parts.append([x[use] for x in (number, *spans, count, cross)])
                rows.append((i, len(parts[-1][0]), len(start)))
            columns = [np.concatenate(x) for x in zip(*parts)]
            which, n, total = (np.array(x) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(np.repeat(which, n))),
                    pa.array(columns[0].astype(np.int32)),
                    *(pa.array(c.astype(np.int64)) for c in columns[1:]),
                    pa.array(np.repeat(total, n).astype(np.int64)),
                ],
                names=["doc_id", "section", "char_start", "char_end", "n_tokens", "n_crossing", "doc_tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, RESULT)
