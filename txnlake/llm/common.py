"""Helpers shared by the operators: tables, the shared folder, Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.session import checkpoint_dir
from txnlake.sinks.layers import _file_system

#: White space of every contract here: space and the bytes 9 to 13.
WHITE = r"[\x20\x09-\x0D]+"
#: Spark's setting that removes the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's bound on the bytes of a batch that goes to a Python worker: 64 MB unless set.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows that Spark's Parquet reader decodes at once: 4,096 unless set.
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share (``spark.checkpoint.dir``)."""
    return f"{checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame, name: str, path: str | None = None, free: bool = False) -> DataFrame:
    """``df`` written once to the shared folder (at ``path``, if given) and read back: lineage ends here,
    so a lost executor costs only the tasks it ran, and later passes don't repeat the work.

    ``free`` has Spark remove the shuffle files of this write when it is done; nothing may read ``df`` itself again at their cost."""
    spark = df.sparkSession
    path = path or shared_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    if free:
        spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, most: str = "4m", rows: int = 256) -> None:
    """From now on batches to Python workers have ``most`` bytes and those of the Parquet reader ``rows`` rows, unless the
    session has bounds of its own: by Spark's defaults, 10,000 rows or 64 MB stand in the executor and in each worker at
    once, and 4,096 whole texts in arrays of 10 to 25 MB each, which G1 can only place by growing its heap."""
    for key, bound in ((BATCH_BYTES, most), (READ_ROWS, str(rows))):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, bound)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``cut`` wrote, once all that read it are done."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(key: str | Column, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``; a null key counts as the empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key, F.lit("")).cast("binary")) % of


def bounded_sample(rows: DataFrame, on: list[str], n: int, seed: int = 11) -> DataFrame:
    """At most ``n`` rows, those of the smallest hashes of ``on``.

    A hash range that holds about 2 n rows is cut out first, so the ordered merge never sees n rows of every task."""
    total = rows.count()
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), *on))
    if total > 2 * n:
        rows = rows.filter(F.col("_h") < int(-(2**63) + 2 * n / total * 2**64))
    return rows.orderBy("_h", *on).limit(n).drop("_h")


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """The texts of a batch in UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Lower-cased A-Z, split at white space: ``bytes`` methods know ASCII only, as the contracts ask."""
    return text.lower().split()


def binary_rows(keys: Iterable, blobs: Iterable[bytes]) -> tuple[pa.Array, pa.Array]:
    return pa.array(keys), pa.array(blobs, pa.binary())


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``limit`` bytes of ``column`` (one row at least),
    which bounds the memory of what is derived from them."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.array([0 if x is None else x for x in pa.compute.binary_length(batch.column(column)).to_pylist()])
        part = np.cumsum(sizes) // limit
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            yield batch.slice(a, b - a)


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest node that each of ``n`` nodes reaches over the links a-b."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while (label[label] != label).any():
            label = label[label]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label
