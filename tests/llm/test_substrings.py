import hashlib
import random

import numpy as np

from millrace.llm import substrings
from millrace.llm.queries import op6_substrings

SF = "/root/testdata/sf0.001"
N = substrings.LENGTH


def brute(rows):
    """Removed runs of each row, in order of the rows."""
    least = {}
    for k, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - N + 1):
            s = b[i: i + N]
            least[s] = min(least.get(s, k), k)
    out = []
    for k, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 2, bool)
        for i in range(len(b) - N + 1):
            if least[b[i: i + N]] < k:
                gone[i + 1: i + 1 + N] = True
        edge = np.flatnonzero(np.diff(gone.astype(np.int8)))
        out.append([(int(a), int(z)) for a, z in edge.reshape(-1, 2)])
    return out


def wanted(rows):
    for (k, t), runs in zip(rows, brute(rows), strict=True):
        b, at, kept = (t or "").encode(), 0, b""
        for a, z in runs:
            kept, at = kept + b[at:a], z
        kept += b[at:]
        yield k, len(b), sum(z - a for a, z in runs), len(runs), hashlib.sha256(kept).hexdigest()


def passages(seed, alphabet, n=60):
    rng = random.Random(seed)

    def some(k):
        return "".join(rng.choice(alphabet) for _ in range(k))

    shared = [some(rng.choice([30, 49, 50, 51, 80, 300])) for _ in range(12)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice([some(rng.randrange(60)), rng.choice(shared), rng.choice(shared)[10:]])
                       for _ in range(rng.randrange(8)))
        rows.append((i * 3 % 61, text))
    return rows


def test_marks_equal_brute_force(spark):
    for seed, alphabet in ((1, "abcdefgh é"), (2, "ab"), (3, "x")):
        rows = passages(seed, alphabet)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        got = sorted(tuple(r) for r in substrings.spans(
            docs, substrings._digest_of, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string",
            block_bytes=2000).collect())
        assert got == sorted(wanted(rows)), seed


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in op6_substrings(spark, SF).collect())
    assert got == sorted(wanted(rows))
    assert sum(r[2] for r in got) > 1000


def test_edge_rows(spark):
    t = "the same passage of rather more than fifty bytes, said again"
    rows = [(2, t, 1), (2, t, 1), (1, t + "!", 2), (None, t, 3), (None, t, 3), (7, None, 4), (8, "", 5), (9, t * 3, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, block int")
    got = {(r.doc_id, tuple(tuple(s) for s in r.removed)) for r in substrings.without_repeats(docs).collect()}
    n = len(t)
    assert got == {(2, ((0, n),)), (1, ()), (None, ((0, n),)), (7, ()), (8, ()), (9, ((0, 3 * n),))} or \
        (9, ((0, n), (n, 2 * n), (2 * n, 3 * n))) in got
    assert substrings.without_repeats(docs.limit(0)).count() == 0


def test_multikey_order_sorts_rows():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, (5000, 5)).astype(np.uint64)
    got = words[substrings.multikey_order(words)]
    assert got.tolist() == sorted(words.tolist())


def test_splitters_come_from_all_rows(spark, monkeypatch):
    """The start of the table holds one leading key only; the sample must see the rest, and grows with the buckets."""
    monkeypatch.setattr(substrings, "SAMPLED_ROWS", 8)
    rng = random.Random(6)
    rows = [(i, "a" * 80) for i in range(1500)]
    rows += [(i, "".join(rng.choice("abcdefghijklmnop") for _ in range(400))) for i in range(1500, 3000)]
    docs = spark.createDataFrame(rows, "key bigint, text string").coalesce(1)
    few, many = (substrings.splitters(docs, n, len(rows)) for n in (4, 32))
    assert len(few) == 3 and len(many) == 31 and len(set(many.tolist())) > 5
    assert substrings.splitters(docs, 1, len(rows)).tolist() == [] and len(substrings.splitters(docs.limit(0), 4, 0)) == 0
