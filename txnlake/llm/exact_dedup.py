"""Exact dedup with a cuckoo-filter index.

1. Each task reads its rows once and keeps a cuckoo filter of the live digests
   beside a store of their contents, bucketed as the filter is.  A text that the
   filter doesn't know is new; a hit is verified against the stored content.
   Copies join their group, so a group of copies leaves a task as one content
   and a list of ids, however many rows it has (combine before the shuffle).
   When the store passes ``window_bytes`` its digests are deleted again and the
   groups go out: memory stays bounded, and the next step unites the parts.
2. One content per task and group is shuffled by digest and verified in the
   same way; a content that differs under one digest becomes another variant.
3. Sizes and smallest ids are aggregated with partial sums; the id lists (at
   most ``ids_per_row`` in a row, each with the content) are joined to them.  Both sides are read from
   written tables, so that Spark can split a hot digest or broadcast a small side.
   Who wants only the rows that stay asks for ``representatives``: step 3 is then one aggregate.

Defined results: null text counts as empty; null ids sort after all others (a
group of null ids alone has a null keep_id); repeated rows, ids included, are
rows like any others, and exactly one row of a group is kept; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import WHITE, cut, slices

NO_ID = np.iinfo(np.int64).max  # a null id inside the lists
SLICE = 2 << 20  # bytes of content that are taken out of a batch at a time


class CuckooIndex:
    """A cuckoo filter over live keys, four 16-bit fingerprints to a bucket, with
    the keys and contents stored by bucket for verification, deletion and growth.

    ``get`` asks the filter first: a miss needs no look at the store.  ``add`` may
    evict fingerprints to their other bucket; when that finds no room the filter
    doubles and is rebuilt from the stored keys."""

    SLOTS, KICKS = 4, 200

    def __init__(self, buckets: int = 1024):
        self.resizes = 0
        self.size = 0
        self._store: dict[int, list[tuple[bytes, bytes, object]]] = {}
        self._new(buckets)

    def _new(self, buckets: int) -> None:
        self.buckets = buckets
        self._table: list[list[int]] = [[] for _ in range(buckets)]

    @staticmethod
    def _hash(x: int) -> int:
        x = (x * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
        return x ^ (x >> 29)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        h = self._hash(int.from_bytes(key[:8], "little"))
        mark = (h >> 48) or 1
        first = h & (self.buckets - 1)
        return mark, first, self._other(first, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (self._hash(mark) & (self.buckets - 1))

    def _home(self, key: bytes) -> int:
        return self._hash(int.from_bytes(key[:8], "little")) & 0xFFFFFFFF

    def _insert(self, key: bytes) -> bool:
        mark, a, b = self._places(key)
        for place in (a, b):
            if len(self._table[place]) < self.SLOTS:
                self._table[place].append(mark)
                return True
        place = b
        for turn in range(self.KICKS):
            row = self._table[place]
            mark, row[turn % self.SLOTS] = row[turn % self.SLOTS], mark
            place = self._other(place, mark)
            if len(self._table[place]) < self.SLOTS:
                self._table[place].append(mark)
                return True
        return False

    def _rebuild(self) -> None:
        while True:
            self.resizes += 1
            self._new(self.buckets * 2)
            if all(self._insert(key) for row in self._store.values() for key, _, _ in row):
                return

    def maybe(self, key: bytes) -> bool:
        """The filter's answer: False is certain."""
        mark, a, b = self._places(key)
        return mark in self._table[a] or mark in self._table[b]

    def get(self, key: bytes, content: bytes):
        """The value stored for this very content, else None."""
        if self.maybe(key):
            for k, c, value in self._store.get(self._home(key), ()):
                if k == key and c == content:
                    return value
        return None

    def add(self, key: bytes, content: bytes, value: object) -> None:
        self._store.setdefault(self._home(key), []).append((key, content, value))
        self.size += 1
        if not self._insert(key):
            self._rebuild()

    def remove(self, key: bytes, content: bytes) -> bool:
        row = self._store.get(self._home(key), [])
        for i, (k, c, _) in enumerate(row):
            if k == key and c == content:
                row.pop(i)
                if not row:
                    del self._store[self._home(key)]
                mark, a, b = self._places(key)
                self._table[a if mark in self._table[a] else b].remove(mark)
                self.size -= 1
                return True
        return False

    def items(self) -> list[tuple[bytes, bytes, object]]:
        return [x for row in self._store.values() for x in row]


GROUPS = "digest binary, least long, n long, ids binary, content binary"
VARIANTS = "digest binary, variant int, least long, n long, ids binary"


def _combine(window_bytes: int, ids_per_row: int):
    def out(index: CuckooIndex) -> Iterator[pa.RecordBatch]:
        rows = []
        for digest, content, ids in index.items():
            ids = np.sort(np.array(ids, np.int64))
            for at in range(0, len(ids), ids_per_row):
                part = ids[at : at + ids_per_row]
                rows.append((digest, int(part[0]), len(part), part.tobytes(), content))
            index.remove(digest, content)
        for at in range(0, len(rows), 2000):
            cols = list(zip(*rows[at : at + 2000]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                names=["digest", "least", "n", "ids", "content"],
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held = CuckooIndex(), 0
        for batch in slices(batches, "content", SLICE):
            contents = batch.column("content").cast(pa.binary()).to_pylist()
            for doc, digest, content in zip(batch.column("id").to_pylist(), batch.column("digest").to_pylist(), contents):
                doc = NO_ID if doc is None else doc
                if (ids := index.get(digest, content)) is not None:
                    ids.append(doc)
                    held += 8
                else:
                    index.add(digest, content, [doc])
                    held += len(content) + 200
                if held > window_bytes:
                    yield from out(index)
                    held = 0
        yield from out(index)

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number the different contents under one digest (one, unless the digest fails)."""
    index, seen = CuckooIndex(), {}
    for batch in slices(batches, "content", SLICE):
        variants = []
        for digest, content in zip(batch.column("digest").to_pylist(), batch.column("content").to_pylist()):
            if (variant := index.get(digest, content)) is None:
                variant = seen[digest] = seen.get(digest, -1) + 1
                index.add(digest, content, variant)
            variants.append(variant)
        yield pa.RecordBatch.from_arrays(
            [batch.column("digest"), pa.array(variants, pa.int32()), *(batch.column(c) for c in ("least", "n", "ids"))],
            names=["digest", "variant", "least", "n", "ids"],
        )


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document: the id lists taken apart."""
    for batch in batches:
        ids = [np.frombuffer(x, np.int64) for x in batch.column("ids").to_pylist()]
        counts = np.array([len(x) for x in ids])
        if not len(ids):
            continue
        at = np.repeat(np.arange(len(ids)), counts)
        flat = np.concatenate(ids)
        first = np.zeros(len(flat), bool)
        first[np.cumsum(counts) - counts] = True
        take = pa.array(at)
        keep = batch.column("keep_id").take(take)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(flat, mask=flat == NO_ID),
                pa.compute.if_else(pa.compute.equal(keep, NO_ID), pa.scalar(None, pa.int64()), keep),
                batch.column("group_size").take(take),
                pa.compute.and_(batch.column("keeps").take(take), pa.array(first)),
                batch.column("text_sha256").take(take),
            ],
            names=["doc_id", "keep_id", "group_size", "kept", "text_sha256"],
        )


def _variants(docs: DataFrame, window_bytes: int, ids_per_row: int) -> DataFrame:
    """The id lists of each group, verified: a group is a digest and the number of its content."""
    content = F.regexp_replace(F.coalesce("text", F.lit("")), WHITE, " ")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), content.alias("content"))
    rows = rows.select("id", F.unhex(F.sha2(F.col("content"), 256)).alias("digest"), "content")
    groups = rows.mapInArrow(_combine(window_bytes, ids_per_row), GROUPS)
    return groups.repartition("digest").mapInArrow(_verify, VARIANTS)


def representatives(docs: DataFrame, window_bytes: int = 32 << 20, ids_per_row: int = 1000) -> DataFrame:
    """doc_id, text_sha256 of the row that stays of each group: the rows that ``exact_dedup`` marks as kept, without
    those of their copies.  Nothing but the smallest ids is asked for, so no list is joined and no table written."""
    least = _variants(docs, window_bytes, ids_per_row).groupBy("digest", "variant").agg(F.min("least").alias("least"))
    return least.select(F.when(F.col("least") != NO_ID, F.col("least")).alias("doc_id"), F.lower(F.hex("digest")).alias("text_sha256"))


def exact_dedup(docs: DataFrame, window_bytes: int = 32 << 20, ids_per_row: int = 1000) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text)."""
    variants = _variants(docs, window_bytes, ids_per_row)
    # A list's own name settles which row stays when ids repeat; it is fixed by the write.
    variants = cut(variants.withColumn("row", F.expr("uuid()")), "exact-variants")
    key = ["digest", "variant"]
    sizes = variants.groupBy(*key).agg(F.min(F.struct("least", "row")).alias("keep"), F.sum("n").alias("group_size"))
    sizes = cut(sizes.select(*key, F.col("keep.least").alias("keep_id"), F.col("keep.row").alias("keep_row"), "group_size"), "exact-sizes")
    joined = variants.join(sizes, key).select(
        "ids", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("keeps"), F.lower(F.hex("digest")).alias("text_sha256")
    )
    return joined.mapInArrow(_members, "doc_id long, keep_id long, group_size long, kept boolean, text_sha256 string")

