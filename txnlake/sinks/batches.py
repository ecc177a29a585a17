"""Batch folders of a table, compacted behind a manifest.

Every run appends one folder ``batch_id=<id>``, so a table of years is hundreds of
thousands of small files.  ``compact`` packs small folders into groups of about one file
size and publishes a manifest that says which group stands for which batches:

    root/batch_id=<id>/...             as written
    root/_groups/<run>/bin=<n>/...     rows of many batches, with their batch_id
    root/_manifests/v0000000012.json   groups, and the version of each batch in them

The manifest is one file that appears under its name at once, so a reader sees the table
before or after a compaction and never both.  A crash before that leaves a group that no
manifest names, one after it folders that the manifest stands for: neither is read, and
``vacuum`` removes both later, when no reader of the older state is left.  A batch that is
written again is first written to its folder and then taken out of the manifest
(``uncover``).  One writer at a time publishes; a second one that tries fails.

Tables without a manifest are read as they are.
"""

from __future__ import annotations

import json
import time
import uuid
import zlib
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlake.sinks.layers import _file_system, batch_path, path_exists
from txnlake.sources.layers import read_or_empty

TARGET_BYTES = 256 << 20
#: Bytes of batches that one task of a compaction sorts and writes (one batch at least): a bin is a few such files.
TASK_BYTES = 32 << 20
BATCH = "batch_id"
#: Most batches that one compaction packs; what is left waits for the next.
MOST_BATCHES = 100_000


@dataclass(frozen=True)
class Folder:
    size: int
    version: str  # changes whenever the folder's files do
    done: bool


@dataclass(frozen=True)
class Manifest:
    number: int = 0
    #: Group folder (below the root) -> bytes and the batches that it stands for.
    groups: dict[str, dict] = field(default_factory=dict)
    #: The version that each of these batches had when it was packed.
    versions: dict[str, str] = field(default_factory=dict)

    @property
    def covered(self) -> set[str]:
        return set(self.versions)


def folders(spark: SparkSession, root: str) -> dict[str, Folder]:
    """The batch folders on disk."""
    p, fs = _file_system(spark, root)
    if not fs.exists(p):
        return {}
    out = {}
    listed = list(fs.listStatus(p))
    whole = any(s.getPath().getName() == "_SUCCESS" for s in listed)  # written partitioned, by one job
    for status in listed:
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{BATCH}="):
            files = [(f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(status.getPath())]
            names = {f[0] for f in files}
            data = sorted(f for f in files if not f[0].startswith(("_", ".")))
            version = f"{zlib.crc32(repr(data).encode()):08x}"
            done = "_SUCCESS" in names or (whole and "_temporary" not in names)
            out[name.partition("=")[2]] = Folder(sum(f[1] for f in data), version, done)
    return out


def manifest(spark: SparkSession, root: str) -> Manifest:
    """The latest manifest; an empty one if there is none."""
    p, fs = _file_system(spark, f"{root.rstrip('/')}/_manifests")
    if not fs.exists(p):
        return Manifest()
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    numbers = [int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")]
    if not numbers:
        return Manifest()
    path = f"{root.rstrip('/')}/_manifests/v{max(numbers):010d}.json"
    return Manifest(max(numbers), **json.loads(read_text(spark, path)))


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that appears whole under its name; raises if the name is taken."""
    jvm = spark._jvm
    aside = f"{path}.{uuid.uuid4().hex[:8]}.tmp"
    p, fs = _file_system(spark, aside)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    final = jvm.org.apache.hadoop.fs.Path(path)
    uri = fs.makeQualified(final).toUri()
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark._jsc.hadoopConfiguration()).rename(
            fs.makeQualified(p), fs.makeQualified(final), options
        )
    except Exception as e:
        fs.delete(p, False)
        raise RuntimeError(f"{path} was published by another writer") from e


def publish(spark: SparkSession, root: str, new: Manifest) -> Manifest:
    """The next manifest, if ``new`` was made from the latest one."""
    new = replace(new, number=new.number + 1)
    path = f"{root.rstrip('/')}/_manifests/v{new.number:010d}.json"
    publish_text(spark, path, json.dumps({"groups": new.groups, "versions": new.versions}))
    return new


def versions(spark: SparkSession, root: str, on_disk: dict[str, Folder] | None = None) -> dict[str, str]:
    """The version of each batch of the table, which changes when the batch is written again."""
    on_disk = folders(spark, root) if on_disk is None else on_disk
    return {b: f.version for b, f in on_disk.items()} | manifest(spark, root).versions


def read_batches(spark: SparkSession, root: str, schema: T.StructType, only: list[str] | None = None) -> DataFrame:
    """The table's rows (``schema`` with ``batch_id``): of all batches or of those named, each from its group or its folder."""
    root = root.rstrip("/")
    now = manifest(spark, root)
    if not now.groups and only is None:
        return read_or_empty(spark, root, schema)
    wanted = set(folders(spark, root)) | now.covered
    if only is not None:
        wanted &= set(only)
    out = spark.createDataFrame([], schema)
    if plain := sorted(wanted - now.covered):
        out = spark.read.schema(schema).option("basePath", root).parquet(*[batch_path(root, b) for b in plain]).select(*schema.fieldNames())
    whole, part = [], []
    for path, group in sorted(now.groups.items()):
        if named := wanted & set(group["batches"]):
            (whole if len(named) == group["packed"] else part).append((path, named))
    for some, names in ((whole, None), (part, {b for _, own in part for b in own})):
        if some:
            rows = spark.read.schema(schema).parquet(*[f"{root}/{path}" for path, _ in some])
            if names is not None:
                rows = rows.filter(F.col(BATCH).isin(sorted(names)))
            out = out.unionByName(rows)
    return out


def uncover(spark: SparkSession, root: str, batch_id: str) -> None:
    """After a batch's folder was written again: the folder counts, not the group's rows."""
    now = manifest(spark, root)
    if batch_id not in now.versions:
        return
    groups = {p: g | {"batches": [b for b in g["batches"] if b != batch_id]} for p, g in now.groups.items()}
    groups = {p: g for p, g in groups.items() if g["batches"]}
    publish(spark, root, replace(now, groups=groups, versions={b: v for b, v in now.versions.items() if b != batch_id}))


def bins(sizes: dict[str, int], target: int) -> list[list[str]]:
    """Names packed into bins of at most ``target`` bytes: first fit by falling size, in n log n with a tree of free space."""
    leaves = 1
    while leaves < max(1, len(sizes)):
        leaves *= 2
    room = [target] * (2 * leaves)
    out: list[list[str]] = [[] for _ in range(leaves)]
    for name, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        if size > target:
            continue
        at = 1
        while at < leaves:
            at = 2 * at if room[2 * at] >= size else 2 * at + 1
        out[at - leaves].append(name)
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return [b for b in out if b]


def compact(spark: SparkSession, root: str, schema: T.StructType, target_bytes: int = TARGET_BYTES, sort_by: str | None = None) -> int:
    """Pack complete batch folders and groups of up to half of ``target_bytes`` into groups of up to ``target_bytes``, and publish
    them.  Returns the number of batches packed.  Readers are not disturbed; ``vacuum`` frees the space."""
    root = root.rstrip("/")
    now = manifest(spark, root)
    on_disk = folders(spark, root)
    small = {b: f.size for b, f in on_disk.items() if f.done and b not in now.covered and f.size <= target_bytes // 2}
    small = dict(sorted(small.items())[:MOST_BATCHES])
    groups = {p: g for p, g in now.groups.items() if g["bytes"] <= target_bytes // 2}
    packed = [b for b in bins(small | {p: g["bytes"] for p, g in groups.items()}, target_bytes) if len(b) > 1]
    if not packed:
        return 0
    members = [[b for name in names for b in (groups[name]["batches"] if name in groups else [name])] for names in packed]
    moved = [b for own in members for b in own]
    rows = read_batches(spark, root, schema, only=moved)
    sizes = small | {b: g["bytes"] / g["packed"] for g in groups.values() for b in g["batches"]}
    where, task = [], -1
    for i, own in enumerate(members):  # no task has rows of two bins
        task, held = task + 1, 0
        for b in sorted(own):
            if held and held + sizes[b] > TASK_BYTES:
                task, held = task + 1, 0
            held += sizes[b]
            where.append((b, i, task))
    run = f"_groups/{uuid.uuid4().hex[:12]}"
    dealt = rows.join(F.broadcast(spark.createDataFrame(where, f"{BATCH} string, bin int, task int")), BATCH)  # MOST_BATCHES rows at most
    dealt = dealt.repartitionById(task + 1, "task").drop("task").sortWithinPartitions("bin", BATCH, *([sort_by] if sort_by else []))
    dealt.write.partitionBy("bin").parquet(f"{root}/{run}")
    counted = spark.read.schema(T.StructType([*schema.fields, T.StructField("bin", T.IntegerType())])).parquet(f"{root}/{run}")
    got = {r["bin"]: r["count"] for r in counted.groupBy("bin").count().collect()}
    if sum(got.values()) != rows.count():
        raise RuntimeError(f"{run} does not hold the rows of its batches; nothing was published")
    # A batch that was written again meanwhile stays with its folder.
    after = folders(spark, root)
    versions = {b: now.versions.get(b) or on_disk[b].version for b in moved}
    versions = {b: v for b, v in versions.items() if b in now.versions or (b in after and after[b].version == v)}
    _, fs = _file_system(spark, root)
    new = {}
    for i, own in enumerate(members):
        path = f"{run}/bin={i}"
        if named := [b for b in own if b in versions]:
            size = fs.getContentSummary(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{path}")).getLength() if i in got else 0
            if i not in got:  # batches without rows: an empty group keeps them known
                spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{root}/{path}")
            new[path] = {"bytes": size, "batches": named, "packed": len(own)}
    kept = {p: g for p, g in now.groups.items() if p not in {name for names in packed for name in names}}
    publish(spark, root, replace(now, groups=kept | new, versions=now.versions | versions))
    return len(versions)


def vacuum(spark: SparkSession, root: str, older_than_s: float = 7 * 86_400) -> int:
    """Remove folders that a group stands for and groups that no manifest names, if they are older than ``older_than_s``: longer
    than any reader runs.  Returns the number of folders removed."""
    root = root.rstrip("/")
    now = manifest(spark, root)
    p, fs = _file_system(spark, root)
    limit = (time.time() - older_than_s) * 1000
    gone = 0
    for batch, folder in folders(spark, root).items():
        if now.versions.get(batch) == folder.version:  # else it was written again and counts
            path, _ = _file_system(spark, batch_path(root, batch))
            if fs.getFileStatus(path).getModificationTime() <= limit:
                gone += fs.delete(path, True)
    if path_exists(spark, f"{root}/_groups"):
        for run in fs.listStatus(_file_system(spark, f"{root}/_groups")[0]):
            for group in fs.listStatus(run.getPath()) if run.isDirectory() else []:
                name = f"_groups/{run.getPath().getName()}/{group.getPath().getName()}"
                if group.isDirectory() and name not in now.groups and group.getModificationTime() <= limit:
                    gone += fs.delete(group.getPath(), True)
    return gone
