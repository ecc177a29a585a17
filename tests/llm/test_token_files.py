"""Token files: exact round trips, random access, and what a killed writer leaves."""

import io
import os
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from txnlake.llm import token_files as T
from txnlake.llm.common import shared_path
from txnlake.llm.packing import tokenizer_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path(T.TOKENIZER))


def whole(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def expected(tokenizer, rows):
    out, start = [], 0
    for doc, text in rows:
        ids = whole(tokenizer, text)
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(0)
    for n in (1, 2, 7, 8, 9, 4095, 65536):
        for high in (2, 50_000, 2**32):
            ids = rng.integers(0, high, n).astype("<u4")
            planes = T.to_planes(ids, bits)
            assert len(planes) == (32 if bits else 4)
            assert (T.from_planes(planes, n, bits) == ids).all()
    # a plane is the same bit, or byte, of every id
    ids = np.array([1, 0, 3, 256], "<u4")
    assert T.to_planes(ids, True)[:2] == [b"\x05", b"\x04"] and T.to_planes(ids, True)[8] == b"\x08"
    assert T.to_planes(ids, False) == [b"\x01\x00\x03\x00", b"\x00\x00\x00\x01", b"", b""]


@pytest.mark.parametrize("bits", [False, True])
def test_whole_table(spark, tokenizer, bits):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = shared_path(spark, "test-tokens")
    manifest = T.write_tokens(docs, path, bits=bits, chunk_ids=5000)
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    want = expected(tokenizer, rows)
    got = sorted(tuple(r) for r in T.read_tokens(spark, path).collect())
    assert got == want
    files = manifest.orderBy("part").collect()
    assert sum(r["n_docs"] for r in files) == len(rows) and len(files) > 1
    # any span comes from the chunks that hold it
    stream = np.concatenate([whole(tokenizer, t) for _, t in rows])
    assert sum(r["n_ids"] for r in files) == len(stream)
    assert sum(r["n_bytes"] for r in files) < 2 * len(stream)
    fs, root = T.file_system(path)
    first, rng = 0, random.Random(1)
    for r in files:
        with fs.open_input_file(f"{root}/{r['file']}") as source:
            file = T.TokenFile(source)
            assert file.n_ids == r["n_ids"] and fs.get_file_info(f"{root}/{r['file']}").size == r["n_bytes"]
            for _ in range(20):
                a = rng.randrange(file.n_ids)
                b = min(file.n_ids, a + rng.choice([0, 1, 4999, 5000, 12_345]))
                assert (file.ids(a, b) == stream[first + a : first + b]).all()
        first += r["n_ids"]
    assert not [f for f in os.listdir(root) if f.startswith(".part") and not f.endswith(".crc")]


ODD = [
    " leading", "trailing ", "two  blanks", "three   blanks", "tab\tand \t both", "line\nline", "line \n line", "\n", " ", "   ", "", None, "a b", "a   b", "dog's tail, dogs' tails",
    "don't 'quoted' ''twice''", "x. y, (z) [w]! 12,5 12.", "é, ü; ß: ½. ² ª", "日本語 のテキスト。 はい", "emoji 😀 👩‍👩‍👧 ok", "a\x1cb \x1d c", "<|endoftext|> in the middle <|endoftext|>", "A<|endoftext|>", "​ zero ​ width",
    "café's l'été ’s", "word" * 3000, "x " * 5000, "\r\n\r\n a", "a \x85 b", "ends with mark ,", "'s 't 're", "foo 's,", "_a_ __b__ c_d", "ǅ, ʼn. ΐ! ё, я.",
]


def test_segments_equal_whole_texts(tokenizer):
    encode = T.TextEncoder(tokenizer_path(T.TOKENIZER), limit=50)
    rng = random.Random(2)
    letters = ["a", "B", "é", " ", " ", "  ", "\t", "\n", "'", "'s", ",", ".", "1", "½", "日", " ", "\x1c", "ʼ", "😀", "_"]
    texts = [t for t in ODD if t] + ["".join(rng.choices(letters, k=rng.randint(1, 30))) for _ in range(3000)]
    for t in texts:
        assert encode.document(t) == np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes(), repr(t)


def test_edge_rows(spark, tokenizer):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, "again"), (3, "again"), (None, "no id"), (None, None), (-5, "below"), (2**63 - 1, "top")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *(F.lit("x").alias(c) for c in ("start", "part", "file", "n_tokens")))
    path = shared_path(spark, "test-tokens")
    T.write_tokens(df.repartition(5), path, chunk_ids=64)
    got = T.read_tokens(spark, path).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x or 0))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == sorted((str(d), n, c) for d, _, n, c in expected(tokenizer, rows))
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]


def test_empty_table(spark):
    path = shared_path(spark, "test-tokens")
    assert T.write_tokens(spark.createDataFrame([], "doc_id long, text string"), path).collect() == []
    assert T.read_tokens(spark, path).collect() == []


def test_a_text_longer_than_many_chunks():
    sink = io.BytesIO()
    writer = T.TokenWriter(sink, chunk_ids=100)
    docs = [(1, np.arange(12_345)), (None, np.array([7])), (2, np.arange(55)), (3, np.arange(1000))]
    for i, ids in docs:
        writer.add(i, ids.astype("<u4").tobytes())
    writer.close()
    assert writer.offset == len(sink.getvalue())
    file = T.TokenFile(pa.BufferReader(sink.getvalue()))
    want, at = [], 0
    for i, ids in docs:
        want.append((i, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
        at += len(ids)
    assert list(file.documents()) == want and len(file.index) == -(-at // 100)


def test_a_file_that_ends_early_is_refused():
    sink = io.BytesIO()
    writer = T.TokenWriter(sink)
    writer.add(1, np.arange(10).astype("<u4").tobytes())
    writer.close()
    with pytest.raises(ValueError):
        T.TokenFile(pa.BufferReader(sink.getvalue()[:-3]))
    with pytest.raises(ValueError):
        T.TokenFile(pa.BufferReader(b"x" + sink.getvalue()))


def test_a_failed_task_leaves_no_file(tmp_path, monkeypatch):
    class Context:
        partitionId = staticmethod(lambda: 4)
        taskAttemptId = staticmethod(lambda: 9)

    monkeypatch.setattr(T.TaskContext, "get", staticmethod(lambda: Context))

    def fails():
        def encode(text):
            if text == "bad":
                raise RuntimeError("lost")
            return b""

        return encode

    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["good", "bad"]})
    run = T._written(str(tmp_path), fails, False, 100, 3)
    with pytest.raises(RuntimeError):
        list(run(iter([batch])))
    assert os.listdir(tmp_path) == []
    # the next attempt writes the file
    list(run(iter([batch.slice(0, 1)])))
    assert os.listdir(tmp_path) == ["part-000004.tids"]
