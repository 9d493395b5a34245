import math
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import perplexity as px
from millrace.llm.queries import op2_perplexity

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    five = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    count, cover = Counter(five), set()
    for i, w in enumerate(five):
        if count[w] > 1:
            cover.update(range(i, i + 5))
    failed = len(words) < 10 or 100 * len(cover) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(cover), failed


def model(rows):
    """Modified Kneser-Ney over all texts by plain dictionaries: log-probability of a text."""
    def stream(t):
        b = b"".join(w.encode() + b" " for w in WORD.findall(t or ""))
        padded = bytes(3) + b
        return [padded[i: i + 4] for i in range(len(b))]

    top = defaultdict(Counter)
    for _, t, lang in rows:
        top[lang].update(stream(t))
    logs = {}
    for lang, counts in top.items():
        levels = {4: counts}
        for k in (3, 2, 1):
            levels[k] = Counter(g[1:] for g in levels[k + 1])
        p = {b"": 1 / 256}
        for k in (1, 2, 3, 4):
            c = levels[k]
            n = Counter(c.values())
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
            d = []
            for j in (1, 2, 3):
                v = j - (j + 1) * y * n[j + 1] / n[j] if n[j] else -1
                d.append(v if 0 < v < j else 0.5 * j)
            whole, taken = Counter(), Counter()
            for g, m in c.items():
                whole[g[:-1]] += m
                taken[g[:-1]] += d[min(m, 3) - 1]
            now = {g: (m - d[min(m, 3) - 1]) / whole[g[:-1]] + taken[g[:-1]] / whole[g[:-1]] * p[g[1:]]
                   for g, m in c.items()}
            p = now if k == 4 else {**now}
        logs[lang] = {g: math.log(v) for g, v in p.items()}
    return [sum(logs[lang][g] for g in stream(t)) for _, t, lang in rows], [len(stream(t)) for _, t, _ in rows]


def test_query_equals_plain_counts(spark):
    rows = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r for r in op2_perplexity(spark, SF).collect()}
    assert len(got) == len(rows)
    logs, sizes = model(rows)
    for (k, t, _), log, n in zip(rows, logs, sizes, strict=True):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t)
        assert not (r.base_failed and r.kept)
        assert n == 0 or abs(math.log(r.perplexity) + log / n) < 1e-5


def test_fetched_model_equals_held_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    order = "id"
    held = px.described(docs).orderBy(order).collect()
    fetched = px.described(docs, most_rows=0).orderBy(order).collect()
    assert [r[:-1] for r in held] == [r[:-1] for r in fetched]
    assert np.allclose([r.logp for r in held], [r.logp for r in fetched])


def test_counts_on_odd_texts():
    from millrace.llm.texts import Texts
    odd = ["", "\n\n", "a", "a\na\n a\na", "é é é é é é é é é é", "x\x0by\n\x0c\nx\x0by", "1 2 3 4 5 1 2 3 4 5 6",
           "a b c d e " * 30, "<|> #\n<|> #\n", "é é", "a b c d", "same line\r\nsame line\r\n"]
    got = px.base_counts(Texts.from_list([t.encode() for t in odd]))
    for i, t in enumerate(odd):
        assert tuple(int(got[c][i]) for c in px.STATS) == base(t)[:5], repr(t)


def test_edge_rows(spark):
    t = "twelve plain words stand here so that this text is long enough to pass"
    rows = [(1, t, "en", 1), (1, t, "en", 1), (2, None, "en", 1), (None, t, None, 2), (4, "", "de", 2),
            (5, "long text of many words " * 9000, "de", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_words int")
    got = px.judged(docs).collect()
    assert len(got) == 6 and {r.kept for r in got if r.doc_id in (1, None)} == {True}
    assert all(r.base_failed and r.perplexity is None for r in got if r.doc_id in (2, 4))
    assert [r.base_failed for r in got if r.doc_id == 5] == [True]
    assert px.judged(docs.limit(0)).count() == 0


def test_band_rejects_both_sides(spark):
    rows = [(i, "xx", 100 + i % 7, 100, -200.0 - i % 7, 0) for i in range(90)] + [
        (100, "xx", 100, 100, -20.0, 0), (101, "xx", 100, 100, -900.0, 0)]
    found = spark.createDataFrame(rows, "id int, lang string, n_words long, n_bytes long, logp double, n_repeat_words long")
    low, high = px.bands(found).select("low", "high").first()
    assert 0.2 < low < 2.0 < 2.06 < high < 9
    assert px.bands(found.limit(0)).count() == 0 and F is not None


def test_copies_do_not_switch_the_band_off(spark):
    def row(i, nats, mark):
        return i, "en", 100, 1000, mark, -1000.0 * nats, 0

    clean = [row(i, 1.48 + i % 60 / 1000, i) for i in range(600)]
    odd = [row(900, 0.75, 900), row(901, 5.0, 901)]
    plain = None
    # None, a third and half of the language: copies of one text, then different texts as like as copies.
    for copies in (0, 300, 600):
        for apart in (False, True):
            rows = clean + odd + [row(1000 + i, 0.9, 1000 + i * apart) for i in range(copies)]
            found = spark.createDataFrame(
                rows, "id int, lang string, n_words long, n_bytes long, mark long, logp double, n_repeat_words long")
            low, high = px.bands(found).select("low", "high").first()
            plain = plain or (low, high)
            if not apart:
                assert np.allclose((low, high), plain, atol=0.01)
            if apart and copies == 300:
                assert 0.75 < low and high < 5.0
            assert low > 0.5 and high < 5.0


def test_random_text_is_rejected_beside_copies(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("lang = 'en'").select(
        "doc_id", "text", "lang")
    rng = np.random.default_rng(3)
    junk = " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz0123456789"), 8)) for _ in range(150))
    one = px.judged(docs).filter("kept").orderBy("doc_id").first().doc_id
    body = docs.filter(F.col("doc_id") == one).first().text
    n = docs.count()
    extra = spark.createDataFrame([(-1, junk, "en")], docs.schema)
    for many in (n // 2, n):
        more = spark.range(many).select((-2 - F.col("id")).alias("doc_id"), F.lit(body).alias("text"), F.lit("en").alias("lang"))
        got = px.judged(docs.unionByName(extra).unionByName(more))
        assert [r.kept for r in got.filter("doc_id = -1").collect()] == [False]
