"""Token ids in files of shuffled bit or byte planes, with a chunk index.

``write_tokens`` encodes every text, appends the end id and writes the ids in
ascending doc_id order: rows are dealt by ranges of the id, each task writes one
file, and a manifest (one row a file) says what the files hold.  ``read_tokens``
reads the files back, a task a file; ``TokenFile`` reads any span of ids by the
chunk index without touching the rest.

A file is a header, chunks, the index and a trailer::

    header   magic, version, planes by bits (1) or bytes (0), ids a chunk
    chunk    planes one after another, each a zstandard frame (empty: all zero),
             then the documents that end in the chunk: end, doc_id, null flag
    index    a row for each chunk: offset, bytes, first id, ids, documents,
             bytes of each plane
    trailer  offset and bytes of the index, magic

A chunk is a fixed number of ids (the last one of a file is shorter).  Its ids are
transposed: plane i holds bit (or byte) i of all its ids, so the high planes, which
hardly vary, compress to almost nothing.  Memory is one chunk and one text.

A file appears under its name only when it is complete (written under another name
and moved), and a task that runs again writes the same file, so lost executors and
doubled tasks do no harm.  Files go to local and shared folders and to the stores
that ``pyarrow.fs`` reaches.

Defined results: null text is the empty document, its one id is the end id; repeated
rows are documents of their own, rows of one doc_id in the order of their texts'
hashes; null ids come first; an empty table writes no file and reads back empty;
further columns are ignored.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlake.llm.common import shuffle_partitions, slices
from txnlake.llm.packing import END_ID, byte_letters, tokenizer_path

TOKENIZER = "byte_bpe_50k.json"
MAGIC, VERSION = b"TIDP", 1
HEADER, TRAILER = struct.Struct("<4sBBI"), struct.Struct("<QI4s")
CHUNK_IDS, LEVEL = 1 << 16, 3


# --- planes -------------------------------------------------------------------
def to_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The block's bit (32) or byte (4) planes, lowest first; a plane of zeros is empty."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        planes = np.packbits(np.unpackbits(octets, axis=1, bitorder="little").T, axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(octets.T)
    return [p.tobytes() if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    width = (n + 7) // 8 if bits else n
    rows = np.stack([np.frombuffer(p, np.uint8) if p else np.zeros(width, np.uint8) for p in planes])
    if bits:
        rows = np.unpackbits(rows, axis=1, count=n, bitorder="little")
        octets = np.packbits(rows.T, axis=1, bitorder="little")
    else:
        octets = rows.T
    return np.ascontiguousarray(octets).view("<u4").ravel()


# --- files ----------------------------------------------------------------------
class TokenWriter:
    """Writes documents to a stream: ``add`` for each one, then ``close``."""

    def __init__(self, sink, bits: bool = False, chunk_ids: int = CHUNK_IDS, level: int = LEVEL):
        self.sink, self.bits, self.chunk_ids = sink, bits, chunk_ids
        self.pack = zstandard.ZstdCompressor(level=level)
        self.buffer, self.ends, self.index = bytearray(), [], []
        self.done = self.ids = self.docs = 0
        self.offset = self._put(HEADER.pack(MAGIC, VERSION, bits, chunk_ids))

    def _put(self, data: bytes) -> int:
        self.sink.write(data)
        return len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids``: little-endian unsigned 32-bit."""
        self.buffer += ids
        self.ids += len(ids) // 4
        self.docs += 1
        self.ends.append((self.ids, 0 if doc_id is None else doc_id, doc_id is None))
        while len(self.buffer) >= 4 * self.chunk_ids:
            self._chunk(self.chunk_ids)

    def _chunk(self, n: int) -> None:
        planes = [self.pack.compress(p) if p else b"" for p in to_planes(np.frombuffer(bytes(self.buffer[: 4 * n]), "<u4"), self.bits)]
        del self.buffer[: 4 * n]
        first, self.done = self.done, self.done + n
        closed = 0
        while closed < len(self.ends) and self.ends[closed][0] <= self.done:
            closed += 1
        docs = self.pack.compress(np.array(self.ends[:closed], "<i8").reshape(-1, 3).T.tobytes())
        del self.ends[:closed]
        size = sum(self._put(p) for p in (*planes, docs))
        self.index.append((self.offset, size, first, n, closed, *map(len, planes)))
        self.offset += size

    def close(self) -> None:
        if self.buffer:
            self._chunk(len(self.buffer) // 4)
        table = self.pack.compress(np.array(self.index, "<i8").tobytes())
        self._put(table)
        self.offset += self._put(TRAILER.pack(self.offset, len(table), MAGIC)) + len(table)


class TokenFile:
    """A file of ids, read by its chunk index."""

    def __init__(self, source):
        self.source, self.unpack = source, zstandard.ZstdDecompressor()
        magic, version, bits, self.chunk_ids = HEADER.unpack(self._read(0, HEADER.size))
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a file of token ids")
        self.bits = bool(bits)
        size = source.size()
        at, length, magic = TRAILER.unpack(self._read(size - TRAILER.size, TRAILER.size))
        if magic != MAGIC:
            raise ValueError("the file ends early")
        columns = 5 + (32 if self.bits else 4)
        self.index = np.frombuffer(self.unpack.decompress(self._read(at, length)), "<i8").reshape(-1, columns)
        self.n_ids = int(self.index[:, 3].sum())

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def chunk(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """The chunk's ids, and its documents: rows of end, doc_id, null flag."""
        at, size, _, n, _, *lengths = self.index[i].tolist()
        data, planes, start = self._read(at, size), [], 0
        for length in lengths:
            planes.append(self.unpack.decompress(data[start : start + length]) if length else b"")
            start += length
        docs = np.frombuffer(self.unpack.decompress(data[start:]), "<i8").reshape(3, -1).T
        return from_planes(planes, n, self.bits), docs

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the file, from the chunks that hold them."""
        stop = min(stop, self.n_ids)
        out = [np.zeros(0, "<u4")]
        for i in range(start // self.chunk_ids, -(-stop // self.chunk_ids) if stop > start else 0):
            first = i * self.chunk_ids
            out.append(self.chunk(i)[0][max(start - first, 0) : stop - first])
        return np.concatenate(out)

    def documents(self) -> Iterator[tuple[int | None, int, int, int]]:
        """doc_id, start, number of ids, crc32 of the ids; one chunk is held at a time."""
        begin = at = check = 0
        for i in range(len(self.index)):
            ids, docs = self.chunk(i)
            data, first = memoryview(ids.tobytes()), at
            for end, doc_id, null in docs.tolist():
                check = zlib.crc32(data[4 * (at - first) : 4 * (end - first)], check)
                yield None if null else doc_id, begin, end - begin, check
                begin, at, check = end, end, 0
            check = zlib.crc32(data[4 * (at - first) :], check)
            at = first + len(ids)


def file_system(path: str) -> tuple[pa.fs.FileSystem, str]:
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return (pa.fs.LocalFileSystem(), path) if path.startswith("/") else pa.fs.FileSystem.from_uri(path)


# --- encoding ---------------------------------------------------------------------
MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"
_INNER = re.compile(r"(?<=\S) (?=\S)")
#: Letters, and all characters, that are surely of one kind for any version of Unicode's tables.
_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
_KNOWN = re.compile("[\t\n\r\x20-\x7e\u00a1-\u024f]+")
_LETTERS = {b: ord(c) for b, c in byte_letters().items()}
_BLANK = chr(_LETTERS[0x20])


class _Unsafe(Exception):
    """A segment whose ids depend on its neighbours."""


class TextEncoder(dict):
    """Ids (little-endian uint32 bytes) of segments that follow a single blank.

    The tokenizer begins a new piece at each blank between two characters that aren't
    white space, so a document's ids are the ids of its segments one after another; each
    is encoded once.  Texts with other white space at a segment's ends are split only
    at such blanks, and texts that hold a special token's string are encoded whole."""

    def __init__(self, path: str, limit: int = 350_000):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit = Tokenizer.from_file(path), limit
        self.older: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}
        # The model itself takes a single piece at a quarter of the cost; only a file of this kind allows it.
        kind = json.loads(self.tokenizer.to_str())
        before = kind["pre_tokenizer"] or {}
        plain = kind["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"]
        self.model = self.tokenizer.model if plain and sys.byteorder == "little" and array("I").itemsize == 4 and not kind["model"]["ignore_merges"] else None
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(1000)  # it sees each word about once
        self.pieces = regex.compile(public_tokenizers.PATTERN).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        letters = piece.encode().decode("latin-1").translate(_LETTERS)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _encoded(self, text: str) -> bytes:
        """The ids of a short text, by its pieces if they are known."""
        if self.model is None or not _KNOWN.fullmatch(text):
            return self.whole(text)
        return b"".join(map(self._piece, self.pieces(text)))

    def _word(self, word: str) -> bytes:
        """The ids of letters after a blank: one piece."""
        letters = _BLANK + (word if word.isascii() else word.encode().decode("latin-1").translate(_LETTERS))
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _plain(self, text: str) -> bytes:
        """The ids of a text that follows no blank: marks after a word, words after the end of a line."""
        ids = self.others.get(text)
        if ids is None:
            if len(self.others) >= self.limit:
                self.others.clear()
            ids = self.others[text] = self._encoded(text)
        return ids

    def __missing__(self, segment: str) -> bytes:
        ids = self.older.get(segment)
        if ids is None:
            if self.model is not None and _WORD.fullmatch(segment):
                ids = self._word(segment)
            elif not segment or segment[0].isspace() or segment[-1].isspace():
                raise _Unsafe
            elif "\n" in segment and len(lines := segment.split("\n")) == 2 and _KNOWN.fullmatch(segment) and not (lines[0][-1].isspace() or lines[1][0].isspace()):
                # One line's end between two characters: a piece of its own. Not kept: few of these come again.
                return self[lines[0]] + self._plain("\n") + self._line(lines[1])
            else:
                core = segment.rstrip(MARKS)
                # Letters and digits are never in one piece with the marks after them. Characters beyond Latin are left to the tokenizer.
                if core and len(core) < len(segment) and core[-1].isalnum() and core[-1] < "ɐ":
                    ids = self[core] + self._plain(segment[len(core) :])
                else:
                    ids = self._encoded(" " + segment)
        if len(self) >= self.limit:  # words that were used since the last time stay
            self.older = dict(self)
            self.clear()
        self[segment] = ids
        return ids

    def _line(self, text: str) -> bytes:
        core = text.rstrip(MARKS)
        if core and _WORD.fullmatch(core):
            return self._plain(core) + (self._plain(text[len(core) :]) if len(core) < len(text) else b"")
        return self._plain(text)

    def document(self, text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in self.special):
            return self.whole(text)
        segments = text.split(" ")
        try:
            rest = b"".join(map(self.__getitem__, segments[1:]))
            if segments[0] and not segments[0][-1].isspace():
                return self.whole(segments[0]) + rest
        except _Unsafe:
            pass
        first, *others = _INNER.split(text)
        return b"".join([self.whole(first), *(self[s] if not s[-1].isspace() else self.whole(" " + s) for s in others)])


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(path: str) -> TextEncoder:
    """One encoder for each worker process, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = TextEncoder(path)
    return _ENCODERS[path]


# --- tables ------------------------------------------------------------------------
MANIFEST = "part int, file string, n_ids long, n_docs long, n_bytes long"


def _written(path: str, make: Callable[[], Callable[[str], bytes]], bits: bool, chunk_ids: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = make()
        end = np.array([END_ID], "<u4").tobytes()
        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}.tids"
        fs, root = file_system(path)
        working = f"{root}/.{name}.{context.taskAttemptId()}"
        writer = sink = None
        try:
            for batch in slices(batches, "text"):
                if writer is None:
                    fs.create_dir(root, recursive=True)
                    sink = fs.open_output_stream(working)
                    writer = TokenWriter(sink, bits, chunk_ids, level)
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                    writer.add(doc, encode(text) + end)
            if writer is None:
                return
            writer.close()
            sink.close()
            fs.move(working, f"{root}/{name}")
        except BaseException:
            if sink is not None and not sink.closed:
                sink.close()
            if fs.get_file_info(working).type != pa.fs.FileType.NotFound:
                fs.delete_file(working)
            raise
        row = (context.partitionId(), name, writer.ids, writer.docs, writer.offset)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["part", "file", "n_ids", "n_docs", "n_bytes"]).cast(
            pa.schema([("part", pa.int32()), ("file", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64()), ("n_bytes", pa.int64())])
        )

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, bits: bool = False, chunk_ids: int = CHUNK_IDS, level: int = LEVEL, files: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into files under ``path``, a new folder; the manifest, which is written there too.

    ``bits`` shuffles bit planes instead of byte planes."""
    tokenizer = tokenizer or tokenizer_path(TOKENIZER)
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # The hash spreads an id that many rows share over several ranges.
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    rows = rows.repartitionByRange(files or shuffle_partitions(spark), *order).sortWithinPartitions(*order, "text")
    written = rows.mapInArrow(_written(path, lambda: encoder(tokenizer).document, bits, chunk_ids, level), MANIFEST)
    written.write.parquet(f"{path}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def _read_back(path: str):
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(path)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("base").to_pylist()):
                with fs.open_input_file(f"{root}/{name}") as source:
                    rows = []
                    for doc, start, n, check in TokenFile(source).documents():
                        rows.append((doc, base + start, n, check))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return run


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """A row for each document of the files: doc_id, start, n_tokens, ids_crc32."""
    files, base = [], 0
    for r in spark.read.schema(MANIFEST).parquet(f"{path}/manifest").orderBy("part").collect():  # a row for each file
        files.append((r["file"], base))
        base += r["n_ids"]
    rows = spark.createDataFrame(files, "file string, base long").repartition(max(1, len(files)), "file")
    return rows.mapInArrow(_read_back(path), "doc_id long, start long, n_tokens long, ids_crc32 long")
