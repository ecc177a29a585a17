"""SimHash near-dedup with pivot distance tables.

Fingerprint: 64 bits from the XXH64 (seed 42) of all 3-word shingles; a bit is 1
if it is set in over half of them.  Two fingerprints link at ``max_bits`` or
fewer differing bits.

Search: distances to reference fingerprints can differ by no more than the
distance of the two points, so a pair whose pivot table rows differ by more
than ``max_bits`` in any coordinate is discarded; survivors are verified by
their exact distance.  So that not all pairs need a look, only fingerprints
that agree in five of their eight bytes meet: of two fingerprints with at most
three differing bits, at least five bytes are the same, so no link is lost.
A meeting group has at most 2^24 different fingerprints whatever the data are,
a proven bound; a group above ``dense`` is searched in linear time by flipping
up to three of its 24 free bits.  Each group emits a spanning set of links
(a star for each class found), never all its pairs.

Classes: connected components over the links by alternating star contraction
on DataFrames, each round written to the shared folder.

Defined results: null or wordless text has fingerprint zero and links like any
other; null ids keep their rows, and count last as class ids; repeated rows and
copies share a fingerprint and so a class; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlake.llm.common import components, cut, slices, text_bytes, words

BYTES, SAME = 8, 5
GROUPS = list(combinations(range(BYTES), SAME))
PIVOTS = np.random.default_rng(64).integers(0, 2**64, 24, dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = 3, block: int = 1 << 16) -> int:
    """The SimHash of one text in UTF-8; shingles are hashed in blocks, so a long text needs no more memory."""
    w = words(text)
    if not w:
        return 0
    total = max(1, len(w) - shingle + 1)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, block):
        part = w[at : at + block + shingle - 1]
        runs = zip(*(part[i:] for i in range(shingle))) if len(part) >= shingle else [part]
        h = np.fromiter((digest(b" ".join(x), 42) for x in runs), np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            fp = np.array([fingerprint(x, shingle) for x in text_bytes(batch.column("text"))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every fingerprint once for each choice of five bytes: the choice's number and those bytes."""
    for batch in batches:
        fp = np.ascontiguousarray(batch.column("fp").to_numpy(zero_copy_only=False)).astype("<i8")
        own = fp.view(np.uint8).reshape(-1, 8).astype(np.int64)
        for number, chosen in enumerate(GROUPS):
            key = np.full(len(fp), number, np.int64)
            for byte in chosen:
                key = (key << 8) | own[:, byte]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp)], names=["key", "fp"])


def near_pairs(fp: np.ndarray, max_bits: int, dense: int, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Positions of linked pairs among different fingerprints (uint64): pivot tables first, then the exact distance.

    Rows are sorted by the first pivot's distance, so a block meets only the rows within ``max_bits`` of it."""
    if len(fp) > dense:
        return _flip_pairs(fp, max_bits)
    if len(fp) == 2:
        near = np.bitwise_count(fp[:1] ^ fp[1:]) <= max_bits
        return np.flatnonzero(near), np.flatnonzero(near) + 1
    tables = np.bitwise_count(fp[:, None] ^ PIVOTS).astype(np.int8)
    order = np.argsort(tables[:, 0], kind="stable")
    tables, fp = tables[order], fp[order]
    left, right = [], []
    for at in range(0, len(fp), block):
        end = min(at + block, len(fp))
        reach = int(np.searchsorted(tables[:, 0], tables[end - 1, 0] + max_bits, "right"))
        for low in range(at, reach, block):
            high = min(low + block, reach)
            # A few coordinates at a time: most pairs go at the first.
            a, b = np.nonzero(np.abs(tables[at:end, None, 1] - tables[None, low:high, 1]) <= max_bits)
            for c in (0, *range(2, len(PIVOTS))):
                if not len(a):
                    break
                live = np.abs(tables[at + a, c] - tables[low + b, c]) <= max_bits
                if live.all() and c > 8:
                    break
                a, b = a[live], b[live]
            a, b = a + at, b + low
            near = (a < b) & (np.bitwise_count(fp[a] ^ fp[b]) <= max_bits)
            left.append(order[a[near]])
            right.append(order[b[near]])
    return np.concatenate(left), np.concatenate(right)


def _flip_pairs(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The same pairs for a dense group, in time that grows with the group and not its square:
    each fingerprint with up to ``max_bits`` of the bits flipped in which the group differs is looked up."""
    order = np.argsort(fp)
    fp = fp[order]
    free = [i for i in range(64) if (int(np.bitwise_or.reduce(fp) ^ np.bitwise_and.reduce(fp)) >> i) & 1]
    parent = np.arange(len(fp))
    for bits in range(1, max_bits + 1):
        for chosen in combinations(free, bits):
            other = fp ^ np.uint64(sum(1 << i for i in chosen))
            at = np.minimum(np.searchsorted(fp, other), len(fp) - 1)
            hit = np.flatnonzero((fp[at] == other) & (parent != parent[at]))
            if len(hit):  # only links between classes not yet joined are of use
                parent = components(len(fp), np.concatenate([np.arange(len(fp)), hit]), np.concatenate([parent, at[hit]]))
    return order, order[parent]


def _links(max_bits: int, dense: int):
    """Links inside each run of equal keys (the rows come sorted by key and fingerprint)."""

    def stars(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        a, b = near_pairs(fp.view(np.uint64), max_bits, dense)
        label = components(len(fp), a, b)
        member = np.flatnonzero(label != np.arange(len(fp)))
        return fp[member], fp[label[member]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = None, []
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def take() -> Iterator[pa.RecordBatch]:
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                found.clear()
                pairs = np.unique(np.stack([a, b]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        for batch in batches:
            key, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "fp"))
            if not len(key):
                continue
            edges = [0, *(np.flatnonzero(np.diff(key)) + 1).tolist(), len(key)]
            lengths = np.diff(edges)
            for i in np.flatnonzero((lengths > 1) | (np.arange(len(lengths)) == 0) | (np.arange(len(lengths)) == len(lengths) - 1)):
                a, b = edges[i], edges[i + 1]
                if key[a] != held_key:
                    if held_key is not None and sum(map(len, held)) > 1:
                        found.append(stars(np.concatenate(held)))
                    held_key, held = key[a], []
                    if i < len(lengths) - 1:  # complete within this batch
                        if b - a > 1:
                            found.append(stars(fp[a:b]))
                        held_key = None
                        continue
                held.append(fp[a:b])
            if sum(len(x[0]) for x in found) > 200_000:
                yield from take()
        if sum(map(len, held)) > 1:
            found.append(stars(np.concatenate(held)))
        yield from take()

    return run


def connected(links: DataFrame, rounds: int = 50) -> DataFrame:
    """node, root (the smallest node reached) of every node of the links (a, b).

    Large star: every greater neighbour of a node links to its smallest one.  Small star: so do the smaller
    neighbours.  The smallest neighbours come from a partial aggregate and both sides of the join are read
    from written tables, so a node with many links is neither gathered nor stuck in one task."""

    def star(edges: DataFrame, small: bool) -> DataFrame:
        both = edges if small else edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star-least")
        near = both.join(least, "a")
        if small:
            moved = near.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        else:
            moved = near.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        return cut(moved.filter("a != b").distinct(), "star-links")

    edges = cut(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct(), "links")
    for _ in range(rounds):
        after = star(star(edges, small=False), small=True)
        # Finished when every link leads to a root: no node has two, and no target has a link of its own.
        counts = after.groupBy("a").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]
        deep = after.join(after.select(F.col("a").alias("b")).distinct(), "b", "left_semi").isEmpty()
        edges = after
        if deep and (counts or 0) <= 1:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError(f"components not settled after {rounds} rounds")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, dense: int = 1 << 16) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable) for every row."""
    if not 0 <= max_bits <= BYTES - SAME:
        raise ValueError(f"max_bits must be 0 to {BYTES - SAME}")
    prints = cut(fingerprints(docs, shingle), "simhash-prints")
    points = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-points")
    met = points.select("fp").mapInArrow(_keys, "key long, fp long").repartition("key").sortWithinPartitions("key", "fp")
    roots = connected(met.mapInArrow(_links(max_bits, dense), "a long, b long"))
    tree = roots.union(roots.select("root", "root").distinct())
    named = tree.join(points, tree.node == points.fp).select("fp", "root", "least")
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.select("fp", "root").join(least, "root").select("fp", "component_id")
    # Every fingerprint once, linked or not, in a written table: its join with the documents can be split at a hot fingerprint.
    classes = cut(points.join(classes, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id")), "simhash-classes")
    return prints.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
