import zlib

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import quality
from millrace.llm.queries import op1_quality
from millrace.llm.texts import Texts

SF = "/root/testdata/sf0.01"


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(1)
    net = quality.Network.fresh()
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    net.weights["bias"] += 0.1  # away from the kink that an empty text would sit on
    texts = Texts.from_list([bytes(rng.integers(97, 123, n, np.uint8)) for n in (0, 5, 300, 900, 2100)])
    labels = np.array([0, 1, 1, 0, 1], np.float64)

    def loss():
        z = net.forward(texts)["logit"]
        return float((np.log1p(np.exp(-z)) * labels + np.log1p(np.exp(z)) * (1 - labels)).mean())

    grads = net.gradients(texts, labels)
    for name, w in net.weights.items():
        # The biggest entry of each gradient, moved a little.
        at = np.unravel_index(np.abs(grads[name]).argmax(), w.shape)
        step = 1e-5
        w[at] += step
        up = loss()
        w[at] -= 2 * step
        down = loss()
        w[at] += step
        assert abs((up - down) / (2 * step) - grads[name][at]) < 1e-4 * (1 + abs(grads[name][at])), name


def test_score_covers_the_whole_text_and_no_neighbour():
    net = quality.Network.fresh()
    rng = np.random.default_rng(2)
    texts = [bytes(rng.integers(97, 123, n, np.uint8)) for n in (0, 1, 255, 256, 257, 511, 512, 513, 5000, 200_000)]
    alone = [net.score(Texts.from_list([t]))[0] for t in texts]
    assert np.allclose(net.score(Texts.from_list(texts)), alone, atol=1e-6)
    long = texts[-1]
    assert net.score(Texts.from_list([long[:-2000] + b"Z!" * 1000]))[0] != alone[-1]


def test_held_out_accuracy(spark):
    got = op1_quality(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    right = np.mean([r.predicted == r.quality for r in rows])
    assert right > 0.9, right
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "a", 7.0), (1, "a", 7.0), (2, None, 1.0), (None, "", None)],
                                 "doc_id bigint, text string, score double")
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    assert {r.score for r in quality.score(docs, quality.fit(docs, none)).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (9, None)], "doc_id bigint, quality int")
    net = quality.fit(docs, one)
    scores = [(r.doc_id, r.score) for r in quality.score(docs, net).collect()]
    assert len(scores) == 4 and len({s for _, s in scores}) == 2
    assert quality.score(docs.limit(0), net).count() == 0
    kept = quality.accepted(docs, net, least=0.0)
    assert kept.columns == docs.columns and kept.count() == 4
    assert quality.fit(docs, one, F.col("doc_id") != 1).known is False


def test_a_repeated_key_brings_no_more_texts(spark, monkeypatch):
    """One key on a third of the rows: the sample keeps its bound."""
    docs = spark.range(3000).selectExpr("cast(case when id % 3 = 0 then 1 else id end as bigint) as doc_id",
                                        "concat('text number ', id) as text")
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (4, 0), (5, 1)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality.Network, "train", lambda self, texts, wanted, steps: seen.append((texts, wanted)) or self)
    quality.fit(docs, labels, per_class=5)
    (texts, wanted), = seen
    assert len(texts) == 7 and (wanted == 1).sum() == 5 and {b"text number 2", b"text number 4"} <= set(texts)


def plain_logit(net, text):
    """One text's logit, byte by byte."""
    w = {k: v.astype(np.float64) for k, v in net.weights.items()}
    wide = quality.HALF * quality.STEP
    halves = (len(text) + quality.STEP) // wide + 1
    top = np.full((halves, quality.FILTERS), -1e9)
    for i in range(halves):
        for start in range(i * wide, (i + 1) * wide, quality.STEP):
            if start == 0 or start + quality.WIDTH - quality.STEP < len(text):
                z = np.zeros(quality.FILTERS)
                for j in range(quality.WIDTH):
                    byte = text[start + j] if start + j < len(text) else quality.PAD
                    z += w["embed"][byte] @ w["filter"][j * quality.EMBED: (j + 1) * quality.EMBED]
                top[i] = np.maximum(top[i], z)
    chunks = [np.maximum(top[i], top[i + 1]) for i in range(halves - 1)] or [top[0]]
    act = np.array([np.maximum(c + w["bias"], 0) for c in chunks])
    length = np.log1p(len(text)) / 8
    pooled = np.concatenate([act.mean(0), act.max(0), [length, length ** 2]])
    return float(np.tanh(pooled @ w["hidden"] + w["shift"]) @ w["out"] + w["base"][0])


def test_scores_equal_byte_by_byte():
    net, rng = quality.Network.fresh(), np.random.default_rng(8)
    net.weights["bias"] += 0.3
    sizes = [0, 1, 4, 7, 8, 9, 251, 252, 253, 255, 256, 257, 511, 512, 513, 767, 768, 1500]
    texts = [bytes(rng.integers(0, 256, n, np.uint8)) for n in sizes]
    got = net.score(Texts.from_list(texts), limit=700)
    assert np.allclose(got, [1 / (1 + np.exp(-plain_logit(net, t))) for t in texts], atol=1e-5)
