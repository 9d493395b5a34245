"""Quality classifier: a byte-level convolutional network in NumPy.

Bytes are embedded; filters of eight bytes slide over the whole text in steps of four. Text is seen in chunks of 512
bytes that overlap by half; each filter is max-pooled per chunk. The mean and the maximum over all chunks and the
length in bytes pass a hidden layer and give one probability. Only the text's bytes enter it.

The network is fitted by Adam on a bounded sample: the texts, up to ``longest`` bytes each, of the ``per_class`` first
rows of each label in hash order of the key. Scoring covers all texts in full. Null and empty texts have one chunk of
padding and get its score. Without labels every score is 0.5. Equal texts get equal scores; an empty table gives an
empty result; columns other than the named ones are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.texts import Texts

WIDTH, STEP, HALF = 8, 4, 64  # bytes of a filter, bytes between positions, positions of half a chunk
EMBED, FILTERS, HIDDEN = 8, 24, 16
PAD = 256


@dataclass
class Network:
    """Weights; ``known`` is False for a network that has seen no label."""

    weights: dict[str, np.ndarray]
    known: bool = True

    @classmethod
    def fresh(cls, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)

        def init(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        embed = rng.standard_normal((257, EMBED)).astype(np.float32) * 0.5
        embed[PAD] = 0
        return cls({"embed": embed, "filter": init(WIDTH * EMBED, FILTERS), "bias": np.zeros(FILTERS, np.float32),
                    "hidden": init(2 * FILTERS + 2, HIDDEN), "shift": np.zeros(HIDDEN, np.float32),
                    "out": init(HIDDEN), "base": np.zeros(1, np.float32)})

    def forward(self, texts: Texts) -> dict[str, np.ndarray]:
        w = self.weights
        sizes = np.diff(texts.offsets)
        halves = (sizes + STEP) // (HALF * STEP) + 1
        first = np.concatenate([[0], np.cumsum(halves)])
        ids = np.full(first[-1] * HALF * STEP + WIDTH, PAD, np.uint16)
        shift = first[:-1] * HALF * STEP - texts.offsets[:-1]
        ids[np.arange(len(texts.data)) + np.repeat(shift, sizes)] = texts.data
        flat = w["embed"][ids].reshape(-1)
        seen = np.lib.stride_tricks.sliding_window_view(flat, WIDTH * EMBED)[:: STEP * EMBED][: first[-1] * HALF]
        z = (seen @ w["filter"]).reshape(first[-1], HALF, FILTERS)
        # A position counts if it adds bytes of its own text.
        start = np.arange(first[-1] * HALF) * STEP - np.repeat(first[:-1] * HALF * STEP, halves * HALF)
        real = (start == 0) | (start + WIDTH - STEP < np.repeat(sizes, halves * HALF))
        z[~real.reshape(first[-1], HALF)] = -1e9
        top = z.max(1)
        # A chunk is two neighbouring halves of one text; a text of one half has one chunk.
        last = np.zeros(first[-1], bool)
        last[first[1:] - 1] = True
        chunk = np.maximum(top, np.where(last[:, None], top, np.roll(top, -1, 0)))
        ends = last & ~np.isin(np.arange(first[-1]), first[:-1])  # the last half belongs to the chunk before
        act = np.maximum(chunk + w["bias"], 0)
        act[ends] = 0
        count = np.maximum(halves - 1, 1)
        mean = np.add.reduceat(act, first[:-1], axis=0) / count[:, None]
        peak = np.maximum.reduceat(act, first[:-1], axis=0)
        length = np.log1p(sizes, dtype=np.float32)[:, None] / 8
        pooled = np.concatenate([mean, peak, length, length ** 2], 1)
        inner = np.tanh(pooled @ w["hidden"] + w["shift"])
        return {"ids": ids, "seen": seen, "z": z, "top": top, "first": first, "halves": halves, "count": count,
                "act": act, "peak": peak, "pooled": pooled, "inner": inner,
                "logit": inner @ w["out"] + w["base"]}

    def score(self, texts: Texts, limit: int = 1 << 19) -> np.ndarray:
        if not self.known or not len(texts):
            return np.full(len(texts), 0.5)
        logits = [self.forward(part)["logit"] for _, _, part in texts.slices(limit)]
        return 1 / (1 + np.exp(-np.concatenate(logits).astype(np.float64)))

    def gradients(self, texts: Texts, labels: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(texts)
        d_logit = (1 / (1 + np.exp(-f["logit"])) - labels).astype(np.float32) / len(labels)
        d_inner = d_logit[:, None] * w["out"] * (1 - f["inner"] ** 2)
        d_pooled = d_inner @ w["hidden"].T
        doc = np.repeat(np.arange(len(labels)), f["halves"])
        act, first = f["act"], f["first"]
        d_act = d_pooled[doc, :FILTERS] / f["count"][doc][:, None]
        at_peak = (act == f["peak"][doc]) & (act > 0)
        ties = np.maximum(np.add.reduceat(at_peak.astype(np.float32), first[:-1], axis=0), 1)
        d_act += np.where(at_peak, d_pooled[doc, FILTERS: 2 * FILTERS] / ties[doc], 0)
        d_act *= act > 0
        # The larger half of a chunk gets its gradient.
        after = np.roll(f["top"], -1, 0)
        last = np.zeros(first[-1], bool)
        last[first[1:] - 1] = True
        to_next = ~last[:, None] & (after > f["top"])
        d_top = np.where(to_next, 0, d_act) + np.roll(np.where(to_next, d_act, 0), 1, 0)
        place = f["z"].argmax(1) + np.arange(first[-1])[:, None] * HALF
        d_filter, d_embed = np.zeros_like(w["filter"]), np.zeros_like(w["embed"], dtype=np.float64)
        reach = np.arange(WIDTH)
        for k in range(FILTERS):
            hit = np.flatnonzero(d_top[:, k])
            rows, g = place[hit, k], d_top[hit, k]
            d_filter[:, k] = g @ f["seen"][rows]
            byte = f["ids"][rows[:, None] * STEP + reach]
            for j in range(WIDTH):
                d_embed += np.outer(np.bincount(byte[:, j], g, PAD + 1), w["filter"][j * EMBED: (j + 1) * EMBED, k])
        d_embed[PAD] = 0
        return {"embed": d_embed, "filter": d_filter, "bias": d_act.sum(0), "hidden": f["pooled"].T @ d_inner,
                "shift": d_inner.sum(0), "out": f["inner"].T @ d_logit, "base": d_logit.sum(keepdims=True)}

    def train(self, texts: list[bytes], labels: np.ndarray, steps: int, batch: int = 32, rate: float = 4e-3,
              seed: int = 3) -> Network:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.weights.items()}
        second = {k: np.zeros_like(v) for k, v in self.weights.items()}
        order = np.zeros(0, np.int64)
        for step in range(1, steps + 1):
            if len(order) < batch:
                order = np.concatenate([order, rng.permutation(len(texts))])
            chosen, order = order[:batch], order[batch:]
            speed = rate * (1 - (step - 1) / steps)
            for k, g in self.gradients(Texts.from_list([texts[i] for i in chosen]), labels[chosen]).items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                move = (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)
                self.weights[k] -= (speed * move).astype(np.float32)
        return self


def fit(docs: DataFrame, labels: DataFrame, learn: Column | None = None, key: str = "doc_id", text: str = "text",
        label: str = "quality", per_class: int = 2500, longest: int = 32_768, steps: int = 900) -> Network:
    """Network fitted to a 0/1 label; ``learn`` (over ``key``) names the rows that may be learned from.

    The sample holds at most ``per_class`` texts of either label, each of at most ``longest`` bytes. Rows without key,
    text or label do not count; a key with several labels or texts counts with each, in the order of a hash of key and
    text up to that bound.
    """
    rows = labels.select(F.col(key), F.col(label).cast("int").alias("_label")).filter(F.col("_label").isin(0, 1))
    if learn is not None:
        rows = rows.filter(learn)
    chosen = None
    for value in (0, 1):
        part = rows.filter((F.col("_label") == value) & F.col(key).isNotNull()).orderBy(
            F.xxhash64(key), key).limit(per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    # At most 2 * per_class keys, so the texts need no shuffle; rows that repeat a key count up to the bound.
    held = docs.select(F.col(key), F.col(text).alias("_text")).filter(F.octet_length("_text") <= longest).join(
        F.broadcast(chosen), key)
    first = Window.partitionBy("_label").orderBy(F.xxhash64(key, "_text"), "_text")
    found = held.withColumn("_place", F.row_number().over(first)).filter(F.col("_place") <= per_class).select(
        "_text", "_label").toArrow()
    texts = [t.encode() for t in found.column("_text").to_pylist()]
    if not texts:
        return Network({}, known=False)
    wanted = np.array(found.column("_label").to_pylist(), np.float32)
    order = np.lexsort((wanted, np.array(texts, object)))
    return Network.fresh().train([texts[i] for i in order], wanted[order], steps)


def score(docs: DataFrame, network: Network, key: str = "doc_id", text: str = "text", out: str = "score") -> DataFrame:
    """key and the probability of label 1, for every row."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(network.score(Texts.of(batch.column(1))))], names=[key, out])

    return docs.select(key, text).mapInArrow(rows, f"`{key}` {kind}, `{out}` double")


def accepted(docs: DataFrame, network: Network, least: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores ``least`` or more."""

    @F.pandas_udf("double")
    def worth(column):
        import pandas as pd

        return pd.Series(network.score(Texts.of(pa.array(column, pa.string()))))

    return docs.filter(worth(F.col(text)) >= least)
