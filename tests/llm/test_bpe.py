import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from millrace.llm import bpe
from millrace.llm.queries import op7_bpe
from millrace.llm.texts import Texts

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(bpe.default_path())


def odd_texts(seed=3, n=400):
    rng = random.Random(seed)
    bits = ["a", "The", " ", "  ", "\n", "\t", " ", "　", " ", "\x85", "é", "ß", "漢字", "😀", "'s", "'ll", "1", "12345", "<|endoftext|>",
            "!!", "...", "\x1c", "\x00", "word", "ü ", "Ā", "́", "﻿", "x" * 40, "\r\n", "ñ", " ", "​"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(n)]


def test_encoder_equals_the_library(plain):
    enc = bpe.Encoder(bpe.default_path())
    texts = odd_texts() + ["", " ", "a", "x" * 5000, " " * 5000]
    for _ in range(2):  # the second time from memory
        ids, at = enc.encode(Texts.from_list([t.encode() for t in texts]))
        for i, t in enumerate(texts):
            assert ids[at[i]: at[i + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids, repr(t)
            assert enc.decode(ids[at[i]: at[i + 1]]).decode() == t


def test_chunks_depend_on_content_only():
    rng = np.random.default_rng(0)
    common = bytes(rng.integers(97, 123, 20_000, np.uint8))
    texts = Texts.from_list([common, b"other start " * 9 + common, b""])
    starts, ends, first = bpe.chunks(texts)
    keys = texts.hashes(starts, ends)
    assert len(set(keys[: first[1]]) & set(keys[first[1]:])) > 0.9 * first[1] > 10
    assert first[3] == first[2] and (np.diff(starts) > 0).all() and starts[0] == 0


def test_assembled_from_any_known_chunks(plain):
    """Whatever part of the chunks is known, the ids are those of the whole text."""
    enc, rng = bpe.Encoder(bpe.default_path()), random.Random(7)
    texts = odd_texts(9, 40)
    texts = ["".join(rng.choice(texts) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    texts += ["", "x" * 30_000, "漢" * 3000, " " * 4000 + "a", "ab　" * 3000]
    packed = Texts.from_list([t.encode() for t in texts])
    starts, ends, _ = bpe.chunks(packed)
    keys = packed.hashes(starts, ends).tolist()
    raw = packed.data.tobytes()
    for share in (0.0, 0.3, 0.8, 1.0):
        known = {k: np.array(plain.encode(raw[a:b].decode(), add_special_tokens=False).ids, np.uint32)
                 for k, a, b in zip(keys, starts, ends, strict=True) if rng.random() < share}
        for t, ids in zip(texts, bpe.assemble(packed, known, enc), strict=True):
            assert ids.tolist() == plain.encode(t, add_special_tokens=False).ids, (share, repr(t[:80]))


def test_query_equals_the_library(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r for r in op7_bpe(spark, SF).collect()}
    assert len(got) == len(rows)
    for k, t in rows:
        ids = plain.encode(t, add_special_tokens=False).ids
        text = plain.decode(ids, skip_special_tokens=False)
        assert (got[k].n_tokens, got[k].ids_sha256, got[k].decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


def test_round_trip_of_edge_rows(spark):
    long = "many words " * 30_000
    rows = [(1, "a b c", 1), (1, "a b c", 1), (2, None, 1), (None, "é", 2), (4, "", 2), (5, long, 3), (6, long, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, block int")
    back = bpe.decoded(bpe.encoded(docs, ["doc_id", "block"])).collect()
    def order(r):
        return str(r[0]), r[1]
    assert sorted(((r.doc_id, r.text) for r in back), key=order) == sorted(((k, t or "") for k, t, _ in rows), key=order)
    assert bpe.encoded(docs.limit(0), ["doc_id"]).count() == 0


def test_pieces_end_between_words_and_signs():
    """Apostrophes, runs of signs, added tokens and odd white space around the places that pieces are cut at."""
    rng = np.random.default_rng(7)
    parts = ["it", "'s", "'", "''s", "don't", ".", "..", "...a", "-", "co-op", "1", "23", "_x_", "!'ll", "<|endoftext|>",
             "<|", "|>", "endoftext", " ", "  ", "\n", "\r\n", "\t", " ", "　", "é", "é", "日本", "(", ")", "'é", "'S"]
    made = ["".join(rng.choice(parts, rng.integers(1, 30))) for _ in range(3000)] + ["", "'", ".", "\n.", "s"]
    plain = Tokenizer.from_file(bpe.default_path())
    enc = bpe.Encoder(bpe.default_path())
    for texts in (made, made[::-1]):
        ids, at = enc.encode(Texts.from_list([t.encode() for t in texts]))
        for i, t in enumerate(texts):
            assert ids[at[i]: at[i + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids, t
    data = np.frombuffer(b"co-op, it's. <|endoftext|>", np.uint8)
    assert enc.cuts(data).tolist() == [2, 3, 5, 6, 9, 11, 12]
