"""Content reconciliation: do two tables hold the same rows, and if not, which keys differ?

Rows are dealt to leaves by a hash of their key, and each leaf gets an order-free digest
(its rows, and sums of row hashes).  The leaves are summed up into a tree whose root
stands for the whole table.  Two trees are compared from the root down, level by level,
visiting only children of nodes that differ; then only the rows of the differing leaves
are compared by key.  Equal tables are told apart from unequal ones by one aggregate on
each side and no shuffle of rows, and a few edits in a large table cost the leaves that
they lie in.

A digest may be kept (``digest_tree`` is a small table), so a source that was read once
need not be read again to be compared with a later target.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.schemas import KEY
from txnlake.session import checkpoint_dir

#: Each level of the tree splits a node in 2^FAN_BITS.
FAN_BITS = 4
LEAF_ROWS = 4096
MAX_BITS = 24
#: Most leaf numbers that are broadcast to pick the rows of the differing leaves (8 bytes each).
MAX_BROADCAST_LEAVES = 1_000_000
_LOW = (1 << 32) - 1
DIGESTS = ["rows", "low", "high", "mask"]


def tree_bits(rows: int) -> int:
    """Bits of the leaf number for a table of ``rows``: about ``LEAF_ROWS`` rows a leaf, a multiple of ``FAN_BITS``."""
    wanted = math.log2(max(rows, 1) / LEAF_ROWS) if rows > LEAF_ROWS else 0
    return min(MAX_BITS, max(FAN_BITS, FAN_BITS * math.ceil(wanted / FAN_BITS)))


def compared_columns(a: DataFrame, b: DataFrame, key: str, ignore: tuple[str, ...] = ()) -> list[str]:
    """The columns whose values are compared: those of both tables, which must be of one type."""
    columns = [c for c in a.columns if c != key and c not in ignore]
    other = [c for c in b.columns if c != key and c not in ignore]
    if set(columns) != set(other):
        raise ValueError(f"columns of one table only: {sorted(set(columns) ^ set(other))}")
    odd = [c for c in [key, *columns] if a.schema[c].dataType != b.schema[c].dataType or isinstance(a.schema[c].dataType, (T.MapType, T.VariantType))]
    if odd:
        raise ValueError(f"columns that can't be compared (cast them first): {odd}")
    return sorted(columns)


def _hash(columns: list[str], seed: int) -> Column:
    """A 64-bit hash of values in their places: NULLs leave a hash as it is, so which ones are NULL is hashed too."""
    nulls = [F.col(c).isNull() for c in columns]
    return F.xxhash64(F.lit(seed), *columns, *nulls)


def leaf(key: str, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(7), F.col(key)), 64 - bits)


def leaf_digests(df: DataFrame, key: str, columns: list[str], bits: int) -> DataFrame:
    """node, rows, low, high, mask of each leaf that has rows: one aggregate that combines map-side."""
    every = [key, *columns]
    rows = df.select(leaf(key, bits).alias("node"), _hash(every, 1).alias("h"), _hash(every, 2).alias("x"))
    return rows.groupBy("node").agg(
        F.count(F.lit(1)).alias("rows"),
        F.pmod(F.sum(F.col("h").bitwiseAND(F.lit(_LOW))), F.lit(1 << 32)).alias("low"),
        F.pmod(F.sum(F.shiftrightunsigned("h", 32)), F.lit(1 << 32)).alias("high"),
        F.bit_xor("x").alias("mask"),
    )


def digest_tree(df: DataFrame, key: str, columns: list[str], bits: int) -> DataFrame:
    """level (0: the root), node, and the digest of all rows below it.  At most 2^bits leaves, whatever the table's size."""
    checkpoint_dir(df.sparkSession)
    leaves = leaf_digests(df, key, columns, bits).checkpoint(eager=True)
    tree, below = leaves.withColumn("level", F.lit(bits // FAN_BITS)), leaves
    for level in range(bits // FAN_BITS - 1, -1, -1):
        below = below.groupBy(F.shiftright("node", FAN_BITS).alias("node")).agg(
            F.sum("rows").alias("rows"),
            F.pmod(F.sum("low"), F.lit(1 << 32)).alias("low"),
            F.pmod(F.sum("high"), F.lit(1 << 32)).alias("high"),
            F.bit_xor("mask").alias("mask"),
        )
        tree = tree.unionByName(below.withColumn("level", F.lit(level)))
    return tree.select("level", "node", *DIGESTS)


def differing_leaves(a: DataFrame, b: DataFrame, bits: int) -> DataFrame:
    """Leaves whose digests differ, found from the root down: a level looks only below the nodes that differ above it."""
    checkpoint_dir(a.sparkSession)
    found = None
    for level in range(bits // FAN_BITS + 1):
        sides = []
        for tree, name in ((a, "a"), (b, "b")):
            nodes = tree.filter(F.col("level") == level).select("node", *DIGESTS)
            if found is not None:
                above = found.select(F.col("node").alias("above"))
                nodes = nodes.join(above, F.shiftright("node", FAN_BITS) == F.col("above"), "left_semi")
            sides.append(nodes.select("node", F.struct(*DIGESTS).alias(name)))
        both = sides[0].join(sides[1], "node", "full_outer")
        found = both.filter(~F.col("a").eqNullSafe(F.col("b"))).select("node").checkpoint(eager=True)
        if found.isEmpty():
            break
    return found


def rows_of_leaves(df: DataFrame, leaves: DataFrame, key: str, bits: int) -> DataFrame:
    """The rows of ``df`` in the given leaves: no shuffle while the leaves' numbers may be broadcast."""
    if leaves.count() <= MAX_BROADCAST_LEAVES:
        leaves = F.broadcast(leaves)
    return df.join(leaves, leaf(key, bits) == F.col("node"), "left_semi")


def suspects(a: DataFrame, b: DataFrame, key: str, columns: list[str], bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows of both tables that lie in leaves whose content differs."""
    bits = bits or tree_bits(a.count())
    leaves = differing_leaves(digest_tree(a, key, columns, bits), digest_tree(b, key, columns, bits), bits)
    return rows_of_leaves(a, leaves, key, bits), rows_of_leaves(b, leaves, key, bits)


def reconcile(
    source: DataFrame, target: DataFrame, key: str = KEY, ignore: tuple[str, ...] = (), bits: int | None = None
) -> DataFrame:
    """The keys whose content differs: key, status (``missing`` in the target, ``extra`` there, ``differs``),
    changed (names of the columns, or ``rows`` if a key has another number of rows), source_rows, target_rows.

    Rows of a key that repeats are compared as a bag, and a NULL key is a key.  Each key is one row before the two
    sides meet, so repeated keys never multiply."""
    columns = compared_columns(source, target, key, ignore)

    def by_key(df: DataFrame, side: str) -> DataFrame:
        sums = [F.sum(F.xxhash64(F.lit(3), F.col(c), F.col(c).isNull()).bitwiseAND(F.lit(_LOW))).alias(c) for c in columns]
        whole = F.sum(_hash([key, *columns], 1).bitwiseAND(F.lit(_LOW))).alias("_whole")
        rows = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"), whole, *sums)
        return rows.select(F.col("_key").alias(f"_key_{side}"), F.struct("_rows", "_whole", *columns).alias(side))

    some, others = suspects(source, target, key, columns, bits)
    s, t = by_key(some, "s"), by_key(others, "t")
    both = s.join(t, F.col("_key_s").eqNullSafe(F.col("_key_t")), "full_outer")
    both = both.filter(~F.col("s").eqNullSafe(F.col("t")))
    names = [F.when(~F.col("s")[c].eqNullSafe(F.col("t")[c]), F.lit(c)) for c in columns]
    paired = F.col("s").isNotNull() & F.col("t").isNotNull()
    same_rows = F.col("s")["_rows"] == F.col("t")["_rows"]
    return both.select(
        F.when(F.col("s").isNotNull(), F.col("_key_s")).otherwise(F.col("_key_t")).alias(key),
        F.when(F.col("t").isNull(), "missing").when(F.col("s").isNull(), "extra").otherwise("differs").alias("status"),
        F.when(paired & same_rows, F.concat_ws(",", *names)).when(paired, F.lit("rows")).alias("changed"),
        F.coalesce(F.col("s")["_rows"], F.lit(0)).alias("source_rows"),
        F.coalesce(F.col("t")["_rows"], F.lit(0)).alias("target_rows"),
    )


def summary(differences: DataFrame) -> DataFrame:
    """One row for a report: keys missing, extra and different, and whether the tables hold the same content."""
    status = F.col("status")
    return differences.agg(
        F.count_if(status == "missing").alias("missing"),
        F.count_if(status == "extra").alias("extra"),
        F.count_if(status == "differs").alias("differs"),
        (F.count(F.lit(1)) == 0).alias("passed"),
    )
