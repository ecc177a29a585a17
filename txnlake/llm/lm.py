"""LM scoring with a log-frequency Bloom filter in shards.

The model keeps every word, word pair and triple of the training texts, however
rare.  Texts are put into blocks, and two passes run over them.  The first sends
the different n-grams of each block's training texts, with their occurrences, by
key hash to shards.  A shard sums them and is written: pairs and triples as a
log-frequency Bloom filter sized from the events it counted (words keep exact
counts).  From there on no other count exists.  The second pass sends the n-grams
of all texts, without counts, to the written shards; these probe their filters and
answer each block in the order it asked, so an answer is a byte and needs no key.
The block then scores its texts.

The number of shards follows from the counted occurrences (``SHARD``), that of the
scoring tasks from the blocks, so a task reads the same at every size of the corpus;
where a task has several shards or blocks it takes them one at a time.  A shard's
memory is its different n-grams; a filter can't be outgrown, since its size follows
its events.  Sending all shards to every worker would need memory that grows with the
corpus, so the questions go to the filters.  Nothing is broadcast or gathered on the
driver but totals.

The filter holds an n-gram at level 1 to q, where q is its count on a scale of
powers of sqrt 2.  Nothing but bits is kept: a count is read by probing level
after level until a miss.

    P(w)     = (c(w) + 1) / (N + V + 1)                 exact counts
    P(w|v)   = (q(vw) + K1 P(w)) / (c(v) + K1)          each context smoothed by the shorter one
    P(w|uv)  = (q(uvw) + K2 P(w|v)) / (Q(uv) + K2)

q is rounded down and Q up, so that the probabilities of all words sum to at most
1 (but for the filter's false positives).  An unseen context leaves the shorter
one's probability as it is.  The context of a text's first word is the end token.

Words are known by 64-bit hashes, pairs and triples by ``MARGIN`` bits more than their
occurrences have, so an unseen one meets another's key with a probability below
2^-MARGIN (6 x 10^-5) at every size of the corpus, a tenth of the filter's own false positives (6 x 10^-4).

Defined results: null text is empty, its one token is the end; a null id counts
as the empty text in the fold rule; repeated rows each count and each get a
score; without training rows every word is unseen (N = V = 0); an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import cut, drop, remainder, shared_path, slices, text_bytes
from txnlake.llm.tokens import count_words, mix, sequences

_U = np.uint64
#: How many occurrences the shorter context's probability weighs as, by length of the context.
K1, K2 = 800.0, 5.0
COUNT_BASE = 2**0.5
SLICE = 4 << 20
#: Occurrences of pairs and triples for which a shard is made, and blocks for which a scoring task is.
SHARD, TASK_BLOCKS = 4_000_000, 4
#: Beyond so many tasks one takes several shards or more blocks, one after the other.
MOST_TASKS = 100_000
#: Parts of the shards that are asked one after the other, so that the shuffle holds one part's questions at a time.
PARTS = 2
#: Keys that are summed up or asked for at once.
AT_ONCE = 1 << 20


class LogBloom:
    """Small integers by 64-bit key, held as membership of (key, 1), (key, 2), ... in a Bloom filter."""

    def __init__(self, events: int, bits_per_event: int = 16, hashes: int = 8):
        self.size, self.hashes = max(1 << 10, -(-events * bits_per_event // 8) * 8), hashes
        self.bits = np.zeros(self.size // 8, np.uint8)

    def _start(self, key: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        y = mix(key + _U((level * 0xD6E8FEB86659FD93) & (2**64 - 1)))
        return y, (y * _U(0x9E3779B97F4A7C15)) | _U(1)

    def _place(self, y: np.ndarray) -> np.ndarray:
        """From 0 to size - 1, by the high bits (of a filter with more bits than 32 can count: by the remainder)."""
        return (y >> _U(32)) * _U(self.size) >> _U(32) if self.size < 1 << 32 else y % _U(self.size)

    def _places(self, key: np.ndarray, level: int) -> Iterator[np.ndarray]:
        y, step = self._start(key, level)
        for _ in range(self.hashes):
            yield self._place(y)
            y = y + step

    def add(self, key: np.ndarray, value: np.ndarray) -> None:
        plane = np.unpackbits(self.bits, bitorder="little")
        for level in range(1, int(value.max(initial=0)) + 1):
            key, value = key[value >= level], value[value >= level]
            for place in self._places(key, level):
                plane[place] = 1
        self.bits = np.packbits(plane, bitorder="little")

    def get(self, key: np.ndarray) -> np.ndarray:
        """Probe level after level; 0 if level 1 is missing. Never below the value added."""
        value = np.zeros(len(key), np.int32)
        live, level = np.arange(len(key)), 0
        while len(live):
            level += 1
            live = self._rest(key, live, level)
            value[live] = level
        return value

    def _rest(self, key: np.ndarray, live: np.ndarray, level: int) -> np.ndarray:
        """Those of ``live`` whose bits of this level are all set, dropping misses hash by hash."""
        y, step = self._start(key[live], level)
        for _ in range(self.hashes):
            place = self._place(y)
            hit = (self.bits[place >> _U(3)] >> (place & _U(7)).astype(np.uint8)) & 1 == 1
            live, y, step = live[hit], y[hit] + step[hit], step[hit]
        return live

# --- keys -------------------------------------------------------------------
PAIR, TRIPLE = _U(0x1111111111111111), _U(0x2222222222222222)
#: Bits of a pair's or triple's key beyond those of the number of occurrences; the fewer, the shorter the gaps between a block's keys.
MARGIN = 14


def spare_bits(occurrences: int) -> int:
    """The low bits that keys of pairs and triples leave 0."""
    return max(0, 64 - MARGIN - max(1, occurrences).bit_length())


def _spots(flat: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Of each entry, its place within its text (the leading end token is 0)."""
    return np.arange(len(flat)) - np.repeat(first[:-1], np.diff(first))


def keys_of(flat: np.ndarray, spot: np.ndarray, spare: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each entry's word, pair and triple (those that end with it); 0 where the text has too few entries before it."""
    word = mix(flat)
    pair, triple = np.zeros(len(flat), _U), np.zeros(len(flat), _U)
    pair[1:] = mix(mix(flat[:-1] ^ PAIR) + flat[1:])
    triple[2:] = mix(mix(pair[1:-1] ^ TRIPLE) + flat[2:])
    kept = _U((2**64 - 1) >> spare << spare)
    return word, np.where(spot >= 1, pair & kept, _U(0)), np.where(spot >= 2, triple & kept, _U(0))


def level_of(count: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(count) / np.log(COUNT_BASE) + 1e-9).astype(np.int32)


def low(level: np.ndarray) -> np.ndarray:
    return COUNT_BASE ** (level - 1.0)


# --- blocks -----------------------------------------------------------------
BLOCKS = "block long, docs long, occurrences long, doc_ids binary, nulls binary, held binary, lengths binary, size long, texts binary"
QUESTIONS = "block long, bucket int, words binary, grams binary"
#: Words, pairs and triples of training texts come with their occurrences.
COUNTED = f"{QUESTIONS}, word_counts binary, gram_counts binary"


def _pack(values: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, in as many planes as the largest needs (the first byte says)."""
    if not len(values):
        return b""
    values = values.astype(np.int64, copy=False).view(_U)
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, : data[0]] = planes.T
    return out.view(np.int64).ravel()


def _pack_keys(keys: np.ndarray, spare: int = 0) -> bytes:
    return _pack((np.diff(keys, prepend=_U(0)) >> _U(spare)).view(np.int64))


def _unpack_keys(data: bytes, spare: int = 0) -> np.ndarray:
    return np.cumsum(_unpack(data).view(_U) << _U(spare), dtype=_U)


def blocked(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` (doc_id, text, held_out) written in blocks of a few thousand texts, each with a number of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 36, [], 0

        def block() -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            ids = table.column("doc_id")
            texts = text_bytes(table.column("text"))
            whole = b"".join(texts)
            out = table.column("held_out").to_numpy().astype(bool)
            trained = [t for t, x in zip(texts, out.tolist()) if not x]
            row = {
                "block": number,
                "docs": len(texts),
                "occurrences": 2 * count_words(trained) + len(trained),
                "doc_ids": _pack(pa.compute.fill_null(ids, 0).to_numpy()),
                "nulls": pa.compute.is_null(ids).to_numpy().tobytes(),
                "held": out.tobytes(),
                "lengths": _pack(np.array([len(t) for t in texts])),
                "size": len(whole),
                "texts": pa.compress(whole, "zstd", asbytes=True),
            }
            return pa.RecordBatch.from_arrays([pa.array([row[k]], pa.int64() if k in ("block", "docs", "occurrences", "size") else pa.binary()) for k in row], names=list(row))

        for batch in slices(batches, "text", SLICE):
            more = pa.compute.sum(pa.compute.binary_length(batch.column("text"))).as_py() or 0
            if held and size + more > SLICE:
                yield block()
                number, held, size = number + 1, [], 0
            held.append(batch)
            size += more
        if held:
            yield block()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.col("held_out").cast("boolean").alias("held_out"))
    return cut(rows.mapInArrow(run, BLOCKS), name)


def _texts(row: dict) -> list[bytes]:
    whole = pa.decompress(row["texts"], row["size"], "zstd", asbytes=True) if row["size"] else b""
    edge = np.concatenate([[0], np.cumsum(_unpack(row["lengths"]))]).tolist()
    return [whole[a:b] for a, b in zip(edge, edge[1:])]


def _different(key: np.ndarray) -> np.ndarray:
    """The different keys in order, by sorting (np.unique hashes them, which is far slower for mostly different ones)."""
    key = np.sort(key)
    return key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key


def shards_for(occurrences: int) -> int:
    return max(1, -(-occurrences // SHARD))


def questions(blocks: DataFrame, buckets: int, spare: int, training: bool, part: range | None = None) -> DataFrame:
    """The different n-grams of each block, dealt to ``buckets`` by their keys: of training texts with their occurrences, or of all texts.

    ``part``: only those of these buckets."""
    part = range(buckets) if part is None else part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            texts = _texts(row)
            if training:
                texts = [t for t, out in zip(texts, np.frombuffer(row["held"], bool).tolist()) if not out]
                if not texts:
                    continue
            flat, first = sequences(texts)
            spot = _spots(flat, first)
            word, pair, triple = keys_of(flat, spot, spare)
            columns: dict[str, list[bytes]] = {}
            # The leading end token is a context, but doesn't count.
            for name, key, low_bits in (("word", word[spot >= 1], 0), ("gram", np.concatenate([pair[spot >= 1], triple[spot >= 2]]), spare)):
                key, count = np.unique(key, return_counts=True) if training else (_different(key), None)
                edges = np.searchsorted(bucket_of(key, buckets), np.arange(part.start, part.stop + 1)).tolist()
                # The first key of a part counts from 0, so a part can be read by itself.
                columns[f"{name}s"] = [_pack_keys(key[a:b], low_bits) for a, b in zip(edges, edges[1:])]
                if training:
                    columns[f"{name}_counts"] = [_pack(count[a:b]) for a, b in zip(edges, edges[1:])]
            present = [i for i in range(len(part)) if columns["words"][i] or columns["grams"][i]]
            names = ["words", "grams", *(["word_counts", "gram_counts"] if training else [])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["block"]] * len(present), pa.int64()),
                    pa.array([part.start + i for i in present], pa.int32()),
                    *(pa.array([columns[x][i] for i in present], pa.binary()) for x in names),
                ],
                names=["block", "bucket", *names],
            )

    return blocks.select("block", "held", "lengths", "size", "texts").mapInArrow(run, COUNTED if training else QUESTIONS)


def _dealt(rows: DataFrame, buckets: int) -> DataFrame:
    """Bucket by bucket, and in each the blocks in order (a shard, which is of no block, first)."""
    n = min(buckets, MOST_TASKS)
    return rows.repartitionById(n, (F.col("bucket") % n).cast("int")).sortWithinPartitions("bucket", "block")


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    """Rises with the key, so sorted keys are in the order of their buckets."""
    return ((key >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int32)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            yield from batch.slice(at, 16).to_pylist()


# --- shards -----------------------------------------------------------------
SHARDS = "bucket int, words binary, counts binary, size long, bits binary, n long, v long"


class Sums:
    """Totals by key; the entries that wait are added up whenever they are many against the keys."""

    def __init__(self) -> None:
        self.keys, self.totals, self.waiting = [np.zeros(0, _U)], [np.zeros(0, np.int64)], 0

    def add(self, key: np.ndarray, count: np.ndarray) -> None:
        self.keys.append(key)
        self.totals.append(count)
        self.waiting += len(key)
        if self.waiting > max(AT_ONCE, len(self.keys[0]) // 2):
            self.result()

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        if self.waiting:
            key, total = np.concatenate(self.keys), np.concatenate(self.totals)
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            self.keys, self.totals, self.waiting = [key[first]], [np.add.reduceat(total[order], first)], 0
        return self.keys[0], self.totals[0]


def _shards(spare: int):
    """A shard of each bucket: exact counts of its words, a filter of its pairs and triples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in groupby(_rows(batches), key=itemgetter("bucket")):
            words, grams = Sums(), Sums()
            for r in rows:
                words.add(_unpack_keys(r["words"]), _unpack(r["word_counts"]))
                grams.add(_unpack_keys(r["grams"], spare), _unpack(r["gram_counts"]))
            key, total = grams.result()
            level = level_of(total)
            bloom = LogBloom(int(level.sum()))
            bloom.add(key, level)
            key, total = words.result()
            row = (bucket, _pack_keys(key), _pack(total), bloom.size, pa.compress(bloom.bits.tobytes(), "zstd", asbytes=True), int(total.sum()), len(key))
            types = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=["bucket", "words", "counts", "size", "bits", "n", "v"])

    return run


class Shard:
    """A written shard, read: all that is known of the counts of its keys."""

    def __init__(self, row: dict):
        self.words, self.counts, self.bloom = _unpack_keys(row["words"]), _unpack(row["counts"]), LogBloom(1)
        self.bloom.size, self.bloom.bits = row["size"], np.frombuffer(pa.decompress(row["bits"], row["size"] // 8, "zstd", asbytes=True), np.uint8)

    def find(self, key: np.ndarray, words: bool) -> np.ndarray:
        """Counts of words, or levels of pairs and triples."""
        if not words:
            return self.bloom.get(key)
        if not len(self.words):
            return np.zeros(len(key), np.int64)
        place = np.minimum(np.searchsorted(self.words, key), len(self.words) - 1)
        return np.where(self.words[place] == key, self.counts[place], 0)


ANSWERS = "block long, bucket int, words binary, grams binary"


def _answer(spare: int):
    """To each question the words' counts and the pairs' and triples' levels, as the bucket's shard has them (none: all 0)."""

    def answers(shard: Shard | None, bucket: int, asked: list[tuple], small: zstandard.ZstdCompressor) -> pa.RecordBatch:
        columns = []
        for i, words in ((1, True), (2, False)):
            keys = np.concatenate([r[i] for r in asked])
            found = shard.find(keys, words) if shard else np.zeros(len(keys), np.int64)
            edges = np.cumsum([0, *(len(r[i]) for r in asked)]).tolist()
            columns.append([_pack(found[a:b]) if words else small.compress(found[a:b].astype(np.uint8).tobytes()) for a, b in zip(edges, edges[1:])])
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in asked], pa.int64()), pa.array([bucket] * len(asked), pa.int32()), *(pa.array(x, pa.binary()) for x in columns)],
            names=["block", "bucket", "words", "grams"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = zstandard.ZstdCompressor(level=1)
        for bucket, rows in groupby(_rows(batches), key=itemgetter("bucket")):
            shard, asked, waiting = None, [], 0
            for r in rows:
                if r["block"] is None:
                    shard = Shard(r)
                    continue
                asked.append((r["block"], _unpack_keys(r["words"]), _unpack_keys(r["grams"], spare)))
                waiting += len(asked[-1][1]) + len(asked[-1][2])
                if waiting > AT_ONCE:
                    yield answers(shard, bucket, asked, small)
                    asked, waiting = [], 0
            if asked:
                yield answers(shard, bucket, asked, small)

    return run


# --- a model that stays -----------------------------------------------------
@dataclass
class Model:
    """A trained model in a written table of shards; ``find`` fetches the shards it is asked for, for a few texts."""

    n: int  # training tokens
    v: int  # different ones
    shards: DataFrame | None
    buckets: int
    spare: int  # low bits that keys of pairs and triples lack
    held: dict = field(default_factory=dict)

    def find(self, key: np.ndarray, words: bool) -> np.ndarray:
        bucket = bucket_of(key, self.buckets)
        asked = np.unique(bucket).tolist()
        new = [b for b in asked if b not in self.held]
        if new:
            self.held |= {b: None for b in new}
            for r in self.shards.filter(F.col("bucket").isin(new)).collect():
                self.held[r["bucket"]] = Shard(r)
        out = np.zeros(len(key), np.int64)
        for b in asked:
            at = np.flatnonzero(bucket == b)
            if self.held[b]:
                out[at] = self.held[b].find(key[at], words)
        return out


def _totals(rows: DataFrame) -> tuple[int, int]:
    return tuple(rows.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first())


def _trained(blocks: DataFrame) -> tuple[Model, str, int]:
    """The model of the blocks' training texts, the folder of its shards, and the number of blocks."""
    occurrences, n = blocks.agg(F.coalesce(F.sum("occurrences"), F.lit(0)), F.count("block")).first()
    buckets, spare, path = shards_for(occurrences), spare_bits(occurrences), shared_path(blocks.sparkSession, "lm-shards")
    rows = _dealt(questions(blocks, buckets, spare, training=True), buckets)
    shards = cut(rows.mapInArrow(_shards(spare), SHARDS), "lm-shards", path, free=True)
    return Model(*_totals(shards), shards, buckets, spare), path, n


def train(rows: DataFrame) -> tuple[Model, DataFrame, int]:
    """The model, its table of shards and their number of buckets; learns from every row of ``rows`` (text)."""
    blocks = blocked(rows.select(F.lit(0).alias("doc_id"), "text", F.lit(False).alias("held_out")), "lm-blocks")
    model, _, _ = _trained(blocks)
    return model, model.shards, model.buckets


# --- scoring ----------------------------------------------------------------
Find = Callable[[np.ndarray, bool], np.ndarray]


def log_probabilities(model: Model, flat: np.ndarray, first: np.ndarray, find: Find | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each entry: the word's count, its log10 (c + 1), and log10 P (unseen words: less their log10 P(w)).

    ``find`` gives the counts of different words, or the levels of different pairs and triples, in rising order of their keys."""
    find = find or model.find
    spot = _spots(flat, first)
    word, pair, triple = keys_of(flat, spot, model.spare)
    key, back = np.unique(word, return_inverse=True)
    c = find(key, True)[back]
    one, two = np.flatnonzero(spot >= 1), np.flatnonzero(spot >= 2)
    key, back = np.unique(np.concatenate([pair[one], triple[two]]), return_inverse=True)
    found = find(key, False)[back]
    level2, level3 = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
    level2[one], level3[two] = found[: len(one)], found[len(one) :]
    whole = model.n + model.v + 1
    p = (c + 1) / whole
    context = c[one - 1]
    q = np.where(level2[one] > 0, np.minimum(low(level2[one]), context), 0)
    p[one] = np.where(context > 0, (q + K1 * p[one]) / (context + K1), p[one])
    context = np.where(level2[two - 1] > 0, low(level2[two - 1] + 1), 0)
    q = np.where(level3[two] > 0, np.minimum(low(level3[two]), context), 0)
    p[two] = np.where(context > 0, (q + K2 * p[two]) / (context + K2), p[two])
    return c, np.log10(c + 1.0), np.log10(p) + np.where(c > 0, 0, np.log10(whole))


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
COLUMNS = [x.split()[0] for x in RESULT.split(", ")]


def _scored(n: int, v: int, spare: int):
    """The rows of each block, from its texts (first) and all answers to it, by their buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(n, v, None, 0, spare)
        for block, rows in groupby(_rows(batches), key=itemgetter("block")):
            row = next(rows)
            answers = [(r["words"], r["grams"]) for r in rows]

            def find(key: np.ndarray, words: bool) -> np.ndarray:
                got = [_unpack(x) if words else np.frombuffer(zstandard.decompress(y), np.uint8).astype(np.int64) for x, y in answers]
                got = np.concatenate([np.zeros(0, np.int64), *got])
                if len(got) != len(key):
                    raise ValueError(f"block {block}: {len(got)} answers to {len(key)} questions")
                return got

            flat, first = sequences(_texts(row))
            c, base, value = log_probabilities(model, flat, first, find)
            whole = np.log10(n + v + 1)
            value = value - np.where(c > 0, 0, whole)
            known = (c > 0).astype(np.int64)
            at = first[:-1]
            base[at] = value[at] = known[at] = 0  # the leading end token isn't scored
            length = np.diff(first) - 1
            ids = pa.array(_unpack(row["doc_ids"]), mask=np.frombuffer(row["nulls"], bool))
            out = pa.table(
                [
                    ids,
                    pa.array(np.frombuffer(row["held"], bool)),
                    pa.array(length),
                    pa.array(np.add.reduceat(known, at)),
                    pa.array(np.full(len(length), n, np.int64)),
                    pa.array(np.add.reduceat(base, at) - length * whole),
                    pa.array(np.add.reduceat(value, at)),
                ],
                names=COLUMNS,
            )
            yield from out.to_batches(max_chunksize=10_000)

    return run


HELD_OUT = (7, 2)


def score_documents(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` scored by a model of the rows that are not held out."""
    rows = docs.select("doc_id", "text").withColumn("held_out", remainder("doc_id", HELD_OUT[0]) == HELD_OUT[1])
    blocks = blocked(rows, "lm-blocks")
    model, path, n = _trained(blocks)
    both, edges = blocks.drop("occurrences"), [model.buckets * i // PARTS for i in range(PARTS + 1)]
    for part in map(range, edges, edges[1:]):
        if part:
            shards = model.shards.drop("n", "v").filter(F.col("bucket").between(part.start, part.stop - 1))
            asked = questions(blocks, model.buckets, model.spare, False, part).unionByName(shards, allowMissingColumns=True)
            answers = cut(_dealt(asked, len(part)).mapInArrow(_answer(model.spare), ANSWERS), "lm-answers", free=True)
            both = both.unionByName(answers, allowMissingColumns=True)
    drop(docs.sparkSession, path)
    both = both.repartition(min(MOST_TASKS, max(1, -(-n // TASK_BLOCKS))), "block").sortWithinPartitions("block", "bucket")
    return both.mapInArrow(_scored(model.n, model.v, model.spare), RESULT)
