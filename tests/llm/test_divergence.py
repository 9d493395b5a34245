import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import divergence
from tests.compare import difference, duck, spark_rows

SF = "/root/testdata/sf0.001"


def brute(rows, least_docs=10, top=10):
    """Both parts by plain integers; rows are (lang, source, text)."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", low)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= least_docs]
        groups = {s: {t: c[t] for t in kept} for (la, s), c in counts.items() if la == lang}
        whole = {t: sum(g[t] for g in groups.values()) for t in kept}

        def weigh(g, kept=kept):
            total = sum(g.values()) + 2 * len(kept)
            return {t: 1 + 10**9 * (g[t] + 2) // total for t in kept}

        p, q = {s: weigh(g) for s, g in groups.items()}, weigh(whole)
        for s in groups:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // (p[s][t] + p[o][t]) for t in kept), o) for o in groups if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // (p[s][t] + q[t])), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", terms, top)):
                order = sorted(items, key=lambda x: (x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, -v, i + 1) for i, (v, item) in enumerate(order)]
    return sorted(out)


def measured(spark, rows, **more):
    docs = spark.createDataFrame([(t, "clash", s, la, 1) for la, s, t in rows],
                                 "text string, term string, source string, lang string, count int")
    got = divergence.divergence(docs, **more).collect()
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in got)


def made(seed, n=150, sources=5):
    rng = random.Random(seed)
    words = ["Alpha", "beta", "gämma", "Ärger", "漢字", "x", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mü", "nu"]
    rows = []
    for _ in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice([None, *(f"s{i}" for i in range(sources))])
        rows.append((lang, source, " ".join(rng.choices(words, k=rng.randrange(12), weights=range(1, 15)))))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = made(seed) + [("xx", "alone", None), ("xx", None, ""), ("one", "s", "word " * 30), (None, None, None)]
    assert measured(spark, rows) == brute(rows)
    assert measured(spark, rows, least_docs=1, top=3) == brute(rows, 1, 3)


def test_tiles_blocks_and_flushes(spark, monkeypatch):
    """Small limits: many tiles of sources, blocks of terms and parts of counts, the same numbers."""
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "BLOCK", 3)
    monkeypatch.setattr(divergence, "HELD", 5)
    rows = made(3, 200, 7)
    assert measured(spark, rows, least_docs=2) == brute(rows, 2)


def test_hot_source_and_copies(spark):
    rows = made(4, 60) + [("en", "hot", "same words in every copy Copy")] * 120
    assert measured(spark, rows) == brute(rows)


def test_ties_go_to_the_earlier_item(spark):
    rows = [("en", s, "bb aa ÿ 漢 cc") for s in ("b", "a", "Z") for _ in range(10)] + [("en", "other", "dd dd")] * 10
    got = measured(spark, rows)
    assert got == brute(rows)
    assert [r[3] for r in got if r[1:3] == ("other", "pair")] != []


def test_long_text(spark):
    rows = [("en", "long", "word other " * 300_000 + "y" * 400_000)] + [("en", "short", "word y")] * 9
    assert measured(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert measured(spark, []) == []


@pytest.mark.parametrize("k", [1, 2, 5])
def test_skyband_equals_all_comparisons(k):
    rng = random.Random(k)
    items = sorted({(rng.randrange(12), rng.randrange(12), f"t{rng.randrange(60):02d}") for _ in range(300)},
                   key=lambda x: (-x[0], x[1], x[2]))
    items = list({t: (c, n, t) for c, n, t in reversed(items)}.values())
    items.sort(key=lambda x: (-x[0], x[1], x[2]))
    want = [sum(c2 >= c and n2 <= n and t2 < t for c2, n2, t2 in items) < k for c, n, t in items]
    band, got = divergence.Skyband(k), []
    for a in range(0, len(items), 7):
        part = items[a: a + 7]
        got += band.add(np.array([n for _, n, _ in part]), [t.encode() for _, _, t in part]).tolist()
    assert got == want


def test_weights_of_large_counts():
    counts, total = [0, 10**15, 9 * 10**15 - 4], 9 * 10**15 - 2
    assert divergence.weights(np.array(counts), np.array(total)).tolist() == [1 + 10**9 * (c + 2) // total for c in counts]


def test_whole_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert difference(spark_rows(divergence.divergence(docs)), duck(SF, divergence.SQL)) is None


def test_terms_come_in_pieces(monkeypatch):
    """Pieces end between terms; long terms stay whole."""
    text = "Über x-Y 12zz\tÀB\x85c " + "Q" * 40 + "\n\x7fend"
    whole = re.findall(rb"[A-Za-z\x80-\xff]+", text.encode().lower())
    for piece in (1, 3, 17, 1 << 18):
        monkeypatch.setattr(divergence, "PIECE", piece)
        parts = list(divergence.terms_of(text.encode()))
        assert [t for p in parts for t in p] == whole
        assert piece > 99 or len(parts) > 2
    assert list(divergence.terms_of(b"")) == []
