import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe, idfiles
from millrace.llm.queries import op10_id_files
from millrace.session import scratch_path

SF = "/root/testdata/sf0.001"


def streams():
    rng = np.random.default_rng(2)
    b = idfiles.BLOCK
    yield "none", np.zeros(0, np.uint32)
    yield "one", np.array([50_256], np.uint32)
    for n in (b - 1, b, b + 1, 3 * b + 5):
        yield f"even {n}", rng.integers(0, 50_257, n).astype(np.uint32)
        yield f"steep {n}", np.minimum(rng.zipf(1.3, n), 50_256).astype(np.uint32)
        yield f"same {n}", np.full(n, 7, np.uint32)
    yield "turns", np.tile(np.array([0, 1, 2, 0, 1, 3, 9, 9], np.uint32), 3000)


def test_frames_come_back():
    for name, ids in streams():
        sizes = np.array([len(ids) // 2, 0, len(ids) - len(ids) // 2])
        data = idfiles.pack(ids, sizes)
        back, each = idfiles.unpack(data)
        assert back.tolist() == ids.tolist() and each.tolist() == sizes.tolist(), name


def test_predictable_ids_take_little_room():
    ids = np.tile(np.arange(600, dtype=np.uint32), 50)
    assert len(idfiles.pack(ids, np.array([len(ids)]))) * 8 < 4 * len(ids)


def test_damage_is_found():
    ids = np.random.default_rng(1).integers(0, 900, 9000).astype(np.uint32)
    data = bytearray(idfiles.pack(ids, np.array([9000])))
    data[-200] ^= 64
    with pytest.raises(ValueError):
        idfiles.unpack(bytes(data))


def test_query_equals_the_library(spark):
    plain = Tokenizer.from_file(bpe.default_path())
    rows = sorted((r.doc_id, r.text) for r in
                  spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op10_id_files(spark, SF).collect()}
    start = 0
    for k, t in rows:
        ids = [*plain.encode(t, add_special_tokens=False).ids, 2]
        assert got.pop(k) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not got


def test_edge_rows(spark):
    rows = [(5, "b", 1), (5, "b", 1), (2, None, 1), (None, "é", 2), (4, "", 2), (-3, "long " * 40_000, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, part int")
    path = scratch_path(spark, "ids")
    idfiles.write(docs, path)
    got = sorted(idfiles.read(spark, path).collect(), key=lambda r: r.start)
    assert [r.key for r in got] == [None, -3, 2, 4, 5, 5]
    assert [r.start for r in got] == np.cumsum([0, *(len(r.ids) for r in got)])[:-1].tolist()
    assert [len(r.ids) for r in got if r.key in (2, 4)] == [1, 1] and all(r.ids[-1] == 2 for r in got)
    idfiles.write(docs.limit(0), path + "-none")
    assert idfiles.read(spark, path + "-none").count() == 0


def test_frames_are_even_and_documents_stay_whole():
    """Batches of any size give frames of about as many ids, none of a few; one document over the limit is alone."""
    runs = [(pa.array([k]), np.full(n, k, np.uint32), np.array([n])) for k, n in
            enumerate([700, 900, 50, 3000, 1, 1, 400, 1000, 1000, 30])]
    got = list(idfiles.even(iter(runs), 1000))
    assert sum((f[0].to_pylist() for f in got), []) == list(range(len(runs)))
    assert np.concatenate([f[1] for f in got]).tolist() == np.concatenate([r[1] for r in runs]).tolist()
    for keys, ids, sizes in got:
        assert len(keys) == len(sizes) and sizes.sum() == len(ids)
    assert len(got) <= 8
    small = [(pa.array([k]), np.zeros(10, np.uint32), np.array([10])) for k in range(150)]
    assert [len(f[1]) for f in idfiles.even(iter(small), 1000)] == [750, 750]
    assert list(idfiles.even(iter([]), 1000)) == []


def test_blocks_share_their_steps():
    """NumPy is called a fixed number of times for each step of a frame, however many blocks it has."""
    calls = []
    take = idfiles.Predictor.look
    ids = np.random.default_rng(3).integers(0, 70_000, 40 * idfiles.BLOCK + 9).astype(np.uint32)

    class Counted(idfiles.Predictor):
        def look(self):
            calls.append(1)
            return take(self)

    plain, idfiles.Predictor = idfiles.Predictor, Counted
    try:
        back, _ = idfiles.unpack(idfiles.pack(ids, np.array([len(ids)])))
    finally:
        idfiles.Predictor = plain
    assert back.tolist() == ids.tolist() and len(calls) == 2 * idfiles.BLOCK


def test_large_ids_come_back():
    ids = np.random.default_rng(4).choice(np.array([0, 5, 1 << 23, (1 << 32) - 1], np.uint32), 9000)
    back, _ = idfiles.unpack(idfiles.pack(ids, np.array([9000])))
    assert back.dtype == np.uint32 and back.tolist() == ids.tolist()
