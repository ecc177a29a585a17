"""Packing tokens into windows by non-negative least squares.

A document longer than the window gives whole windows first; its rest joins the
pieces to be packed.  Each task packs its own rows, so no text or token crosses
the network:

1. Histogram the pieces by length class (multiples of ``grid``, rounded up).
2. Enumerate the shallow combinations (up to ``depth`` pieces) of classes that
   fill a window within the grid's slack, and solve for how often to repeat each
   so that they use up the histogram: min |A x - h| with x >= 0.
3. Round down, take pieces off the classes, and fill the small gap that rounding
   up left with a cut from the residual pieces.
4. Pack the residual greedily: pieces one after another, cut at window ends.
5. What is left is less than one window per block; it is cut into sequences
   whose lengths are powers of two, which need no padding.

A block is at most ``block_tokens`` tokens, so memory is bounded, and a sequence
id is the block's place: task, block within the task, sequence within the block.

Defined results: null text is the empty document, its one token is the end id;
repeated rows are documents of their own; null ids are kept; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import slices

WINDOW, END_ID = 4096, 2
TOKENIZER = "word_bpe_49k.json"
#: A word may be followed by marks: the tokenizer splits there, so both parts are encoded on their own.
MARKS = b"!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Words of these letters alone are one piece to the tokenizer and need no normalising but lower case.
PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary has for each byte: itself if printable in Latin-1, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder(dict):
    """Token ids (little-endian uint32 bytes) of words between white space.

    The tokenizer drops white space and never merges across it, so a document's
    ids are the ids of its words one after another; each word is encoded once.
    Texts that hold a special token's string are encoded as a whole."""

    def __init__(self, path: str, limit: int = 400_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.letters = byte_letters()
        # The model itself takes a single piece at a quarter of the cost; only a file of this kind allows it.
        parts = json.loads(self.tokenizer.to_str())
        self.model = self.tokenizer.model if _word_level_pieces(parts) else None
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def piece(self, word: bytes) -> bytes:
        """The ids of a word without marks at its end."""
        if self.model is not None and PLAIN.fullmatch(low := word.decode().lower()):
            return np.array([t.id for t in self.model.tokenize("".join(map(self.letters.__getitem__, low.encode())))], "<u4").tobytes()
        return self.whole(word)

    def whole(self, text: bytes) -> bytes:
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(MARKS)
        # The tokenizer splits between a letter and a mark. Letters beyond Latin are left to it.
        if core and len(core) < len(word) and (last := core.decode()[-1]).isalpha() and last < "\u0250":
            ids = self[core] + self[word[len(core) :]]
        else:
            ids = self.piece(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = ids
        return ids

    def document(self, text: bytes) -> bytes:
        low = text.lower()
        if any(s in low for s in self.special):
            return self.whole(text)
        return b"".join(map(self.__getitem__, low.split()))


def _word_level_pieces(parts: dict) -> bool:
    """Lower case, then splits into runs of letters, digits and marks, then bytes as letters."""
    kinds = [x["type"] for x in parts["normalizer"].get("normalizers", [])]
    steps = [x["type"] for x in parts["pre_tokenizer"].get("pretokenizers", [])]
    return kinds == ["NFC", "Replace", "Lowercase"] and steps == ["Split", "ByteLevel"] and not parts["pre_tokenizer"]["pretokenizers"][1]["add_prefix_space"]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 300) -> np.ndarray:
    """min |a x - b| with x >= 0 by the active-set method of Lawson and Hanson."""
    n = a.shape[1]
    x, passive = np.zeros(n), np.zeros(n, bool)
    gram, target = a.T @ a, a.T @ b
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(rounds):
        gain = target - gram @ x
        gain[passive] = -np.inf
        best = int(np.argmax(gain))
        if gain[best] <= tolerance:
            break
        passive[best] = True
        while True:
            on = np.flatnonzero(passive)
            s = np.linalg.lstsq(gram[np.ix_(on, on)], target[on], rcond=None)[0]
            if s.min() > 0:
                x[:] = 0
                x[on] = s
                break
            bad = s <= 0
            step = np.min(x[on][bad] / np.maximum(x[on][bad] - s[bad], 1e-30))
            x[on] += step * (s - x[on])
            x[on[x[on] <= 1e-12]] = 0
            passive &= x > 0
            if not passive.any():
                break
    return x


_RECIPES: dict[tuple[int, int, int], np.ndarray] = {}


def recipes(window: int, grid: int, depth: int) -> np.ndarray:
    """Combinations of up to ``depth`` length classes whose sum is the window: a row each, counts by class."""
    key = (window, grid, depth)
    if key not in _RECIPES:
        classes = window // grid
        rows = []
        for k in range(1, depth + 1):
            for first in combinations_with_replacement(range(1, classes + 1), k - 1):
                last = classes - sum(first)
                if last >= (first[-1] if first else 1):
                    rows.append(np.bincount([*first, last], minlength=classes + 1)[1:])
        _RECIPES[key] = np.array(rows, float)
    return _RECIPES[key]


def plan(lengths: np.ndarray, window: int = WINDOW, grid: int = 128, depth: int = 4) -> tuple[list[list[int]], list[int]]:
    """Groups of pieces that share a window, and the residual pieces (indices into ``lengths``, all below the window)."""
    classes = window // grid
    of = np.clip(-(-lengths // grid), 1, classes)
    shelves = [np.flatnonzero(of == c).tolist() for c in range(1, classes + 1)]
    table = recipes(window, grid, depth)
    histogram = np.array([len(s) for s in shelves], float)
    if not histogram.any():
        return [], []
    # An empty class can't serve a combination.
    usable = np.flatnonzero((table[:, histogram == 0] == 0).all(axis=1))
    groups: list[list[int]] = []
    if len(usable):
        times = np.floor(nnls(table[usable].T, histogram) + 1e-6).astype(int)
        for i in np.flatnonzero(times):
            recipe = table[usable[i]].astype(int)
            uses = np.flatnonzero(recipe)
            for _ in range(min(times[i], *(len(shelves[c]) // recipe[c] for c in uses))):
                groups.append([shelves[c].pop() for c in uses for _ in range(recipe[c])])
    return groups, sorted(i for s in shelves for i in s)


def pack_lengths(lengths: list[int], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length): each token once, nothing but powers of two below the window."""
    sequences: list[list[tuple[int, int, int]]] = []
    rest, where = [], []
    for d, n in enumerate(lengths):
        for start in range(0, n - window + 1, window):
            sequences.append([(d, start, window)])
        if n % window:
            rest.append(n % window)
            where.append((d, n - n % window))
    rest_of = np.array(rest, np.int64)
    groups, residual = plan(rest_of, window) if rest else ([], [])
    stream = [(*where[i], int(rest_of[i])) for i in reversed(residual)]  # taken from the end

    def fill(sequence: list[tuple[int, int, int]], room: int) -> int:
        while room and stream:
            d, start, n = stream.pop()
            take = min(n, room)
            sequence.append((d, start, take))
            if take < n:
                stream.append((d, start + take, n - take))
            room -= take
        return room

    short: list[tuple[int, int, int]] = []
    for group in groups:
        sequence = [(*where[i], int(rest_of[i])) for i in group]
        if fill(sequence, window - sum(p[2] for p in sequence)):
            short += sequence  # no residual is left to fill it
        else:
            sequences.append(sequence)
    stream[:0] = reversed(short)
    left = sum(p[2] for p in stream)
    while left:
        size = min(window, 1 << (left.bit_length() - 1))
        fill(sequence := [], size)
        sequences.append(sequence)
        left -= size
    return sequences


def _pack(make: Callable[[], Callable[[bytes], bytes]], window: int, block_tokens: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()
        end = np.array([END_ID], "<u4").tobytes()
        task = TaskContext.get().partitionId()
        docs, ids, held, block = [], [], 0, 0

        def out() -> pa.RecordBatch:
            rows = []
            lengths = [len(x) // 4 for x in ids]
            for number, sequence in enumerate(pack_lengths(lengths, window)):
                offset = 0
                for d, start, n in sequence:
                    rows.append((docs[d], start, n, zlib.crc32(ids[d][4 * start : 4 * (start + n)]), lengths[d], (task << 36) | (block << 22) | number, offset))
                    offset += n
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

        for batch in slices(batches, "text"):
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()):
                docs.append(doc)
                ids.append(encode(text) + end)
                held += len(ids[-1]) // 4
                if held >= block_tokens:
                    yield out()
                    docs, ids, held, block = [], [], 0, block + 1
        if docs:
            yield out()

    return run


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, block_tokens: int = 8 << 20) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    path = path or tokenizer_path()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(
        _pack(lambda: encoder(path).document, window, block_tokens),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
