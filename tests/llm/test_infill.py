import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import infill
from tests.compare import difference, duck, spark_rows

SF = "/root/testdata/sf0.001"


def brute(key, text, rate=90, spm=20):
    """The same cuts by a list of all tokens."""
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digits = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digits[8 * i: 8 * i + 8], 16) for i in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(tokens), "plain", None, None, text
    a, b = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    p, m, s = ("".join(t) for t in (tokens[:a], tokens[a:b], tokens[b:]))
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return len(tokens), "spm" if h[3] % 100 < spm else "psm", len(p), len(m), out


def all_places(text: str) -> list[int]:
    at = [len(text[: m.start()].encode()) for m in re.finditer(r"[A-Za-z]+|[^A-Za-z]", text)]
    return [*at, len(text.encode())]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="abYZ é漢😀 .1\n<>PSM", max_size=400), st.sampled_from([0, 1, 3, 120]))
def test_every_rank_is_exact(text, error):
    index = infill.RankIndex(np.frombuffer(text.encode(), np.uint8), error)
    want = all_places(text)
    assert [index.place(r) for r in range(index.tokens + 1)] == want and index.tokens + 1 == len(want)


@pytest.mark.parametrize("piece", [1, 2, 7, 64])
def test_cuts_inside_long_texts(monkeypatch, piece):
    monkeypatch.setattr(infill, "PIECE", piece)
    text = "Ünder the bridge 漢字 " * 9 + "x" * 30
    index = infill.RankIndex(np.frombuffer(text.encode(), np.uint8))
    assert [index.place(r) for r in range(index.tokens + 1)] == all_places(text)


def test_segments_are_few_and_bounded():
    rng = np.random.default_rng(5)
    places = np.cumsum(rng.choice([1, 5, 6], 200_000))
    runs = list(infill.segments(places, infill.ERROR))
    assert runs[0][0] == 0 and [b for _, b, _ in runs[:-1]] == [a for a, _, _ in runs[1:]] and runs[-1][1] == len(places)
    assert len(runs) < 1000
    for a, b, slope in runs:
        assert np.abs(places[a:b] - places[a] - slope * np.arange(b - a)).max() <= infill.ERROR + 1e-6


def test_outputs_and_way_back(spark):
    rng = random.Random(3)
    texts = [None, "", "word", "漢", "a <P> b", "<S><M>", "ends with <", "<P", "two\nlines\n", "é" * 50, " " * 40]
    texts += ["".join(rng.choice(["ab", "Wörter ", "\n", "😀", "<", "S>", " x"]) for _ in range(rng.randrange(80))) for _ in range(300)]
    texts += ["tok en " * 200_000, "z" * 700_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "no key here"), (7, "again"), (7, "again"), (-5, "minus five words")]
    docs = spark.createDataFrame([(t, k, "clash") for k, t in rows], "text string, doc_id long, output string")
    made = infill.infilled(docs).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    got = [(r.doc_id, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output), r.back) for r in made]
    want = [(k, brute(k, t), t or "") for k, t in rows]
    order = lambda x: (x[0] is None, x[0] or 0, x[1][4])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert {f for _, (_, f, *_), _ in got} == {"plain", "psm", "spm"}


def test_rates_are_parameters(spark):
    docs = spark.createDataFrame([(i, "one two three four") for i in range(200)], "doc_id long, text string")
    assert {r.form for r in infill.infilled(docs, rate=0).collect()} == {"plain"}
    assert {r.form for r in infill.infilled(docs, rate=100, spm=100).collect()} == {"spm"}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert infill.digest(docs).count() == 0


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert difference(spark_rows(infill.digest(docs)), duck(SF, infill.SQL)) is None
