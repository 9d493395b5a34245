"""Quality rules: counts of a text's words and lines, and bands of its n-gram perplexity.

The n-grams are ``ORDER`` bytes of a text's words, joined by single spaces and begun by zeros. Spark counts them over
all texts, per language, and works out an interpolated modified Kneser-Ney model (three discounts per order, continuation
counts below the highest order, uniform at the bottom) as joins and groupings. The log-probability of each n-gram that
occurs stands under a 64-bit key of language and bytes. If the sorted arrays of keys and values are small enough (their
rows are counted first) every task gets them; otherwise blocks of documents fetch the n-grams they hold by a join, with
the same result.

A text passes if its mean negative log-probability per byte lies in its language's band: the median, less or plus
``REACH`` times the distance of the lower or upper quartile, at least ``LEAST_REACH``, among the texts that pass the base
rules, and an allowance for short texts. Quartiles come from counts over all distinct texts, not from samples: copies
count once, however many there are. However wide the quartiles, the band ends at ``LEAST_SHARE`` and ``MOST_SHARE`` of
the median, so that no group switches a side of it off.

A null language is a language of its own. Null and empty texts have no words, fail the base rules and have no
perplexity. Repeated rows are judged one by one; an empty table gives an empty result; columns other than key, text and
language are not touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm import lookups
from millrace.llm.tables import materialize, parts_for, text_bytes
from millrace.llm.texts import SEPARATOR, Texts, U, splitmix, windows

ORDER = 4
REACH, LEAST_REACH = 6.0, 0.08
#: Limits of the band as shares of the median.
LEAST_SHARE, MOST_SHARE = 0.75, 2.0
#: A mean over n bytes strays: the band is wider by this over the root of n on both sides.
STRAY = 2.0
#: Rows of the model that every task may hold, at 12 bytes each.
MOST_ROWS = 8_000_000
_SLICE = 1 << 21
_KEPT_GRAMS = 2_000_000
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPREAD = U(0xD6E8FEB86659FD93)
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the values between neighbouring bounds."""
    return np.diff(np.concatenate([[0], np.cumsum(values)])[first])


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """Per text: words, code points in them, symbols, repeated lines, and words in repeated windows of five words."""
    data, n = texts.data, len(texts)
    starts, ends, first = texts.words()
    letters = ~SEPARATOR[data] & ((data & 0xC0) != 0x80)
    # Lines end at line feeds and at the text's end.
    feeds = np.flatnonzero(data == 10)
    begin = texts.with_starts(feeds + 1)
    line_doc = np.searchsorted(texts.offsets, begin, "right") - 1
    end = np.minimum(np.append(feeds, len(data))[np.searchsorted(feeds, begin)], texts.offsets[line_doc + 1])
    full = np.searchsorted(starts, begin) < np.searchsorted(starts, end)
    lines, line_doc = texts.hashes(begin[full], end[full]), line_doc[full]
    with np.errstate(over="ignore"):
        _, one = np.unique(splitmix(lines + line_doc.astype(U) * _SPREAD), return_index=True)
        later = np.ones(len(lines), bool)
        later[one] = False
        hashes = texts.hashes(starts, ends)
        doc = np.searchsorted(texts.offsets, starts, "right") - 1
        runs = windows(hashes, 5)
        whole = doc[: len(runs)] == doc[4:]
        _, which, count = np.unique(splitmix(runs[whole] + doc[: len(runs)][whole].astype(U) * _SPREAD),
                                    return_inverse=True, return_counts=True)
    again = np.flatnonzero(whole)[count[which] > 1]
    cover = np.zeros(len(starts) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + 5, -1)
    return {"n_words": np.diff(first), "word_chars": _per_text(letters, texts.offsets),
            "n_symbols": _per_text(_SYMBOL[data], texts.offsets),
            "n_dup_lines": np.bincount(line_doc[later], minlength=n),
            "n_repeat_words": _per_text(np.cumsum(cover[:-1]) > 0, first)}


def grams(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte of the joined words, as a number, and each text's first (n + 1)."""
    starts, ends, first = texts.words()
    size = ends - starts
    total = np.concatenate([[0], np.cumsum(size)])
    body = np.insert(texts.data[~SEPARATOR[texts.data]], total[1:], 32)
    offsets = total[first] + first
    place = np.arange(len(body)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = body.astype(U)
    for k in range(1, ORDER):
        before = np.zeros(len(body), U)
        before[k:] = body[:-k]
        before[place < k] = 0
        out |= before << U(8 * k)
    return out, offsets


def _language(lang: str | None) -> int:
    return zlib.crc32(lang.encode()) + 1 & 0xFFFFFFFF if lang is not None else 0


def _keys(batch_lang: pa.Array, a: int, b: int, found: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit keys of n-grams: language, then bytes."""
    lang = np.array([_language(x) for x in batch_lang.slice(a, b - a).to_pylist()], U)
    return np.repeat(lang << U(32), np.diff(offsets)) | found


def counted(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """key, n: how often each n-gram stands in the texts of its language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.zeros(0, U), np.zeros(0, np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["key", "n"])

        for batch in batches:
            for a, b, part in Texts.of(batch.column(1)).slices(_SLICE):
                new, n = np.unique(_keys(batch.column(0), a, b, *grams(part)), return_counts=True)
                keys, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
                counts = np.bincount(place, np.concatenate([counts, n]), len(keys)).astype(np.int64)
                if len(keys) > _KEPT_GRAMS:
                    yield rows()
                    keys, counts = np.zeros(0, U), np.zeros(0, np.int64)
        if len(keys):
            yield rows()

    return docs.select(lang, text).mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """key, logp (natural) of every n-gram in ``counts`` (key, n)."""
    levels = [counts.select(F.shiftrightunsigned("key", 32).alias("lang"),
                            F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("gram"), "n")]
    for size in range(ORDER - 1, 0, -1):  # continuation counts
        levels.append(levels[-1].groupBy("lang", F.col("gram").bitwiseAND(F.lit((1 << 8 * size) - 1)).alias("gram")).agg(
            F.count("*").alias("n")))
    below = None
    for size, level in zip(range(1, ORDER + 1), reversed(levels), strict=True):
        many = [F.count_if(F.col("n") == k).cast("double").alias(f"n{k}") for k in (1, 2, 3, 4)]
        y = F.coalesce(F.try_divide("n1", F.col("n1") + 2 * F.col("n2")), F.lit(0.0))

        def discount(k: int, y: Column = y) -> Column:
            value = k - (k + 1) * y * F.try_divide(f"n{k + 1}", f"n{k}")
            # Too few counts to tell, or none: half of each.
            return F.when((F.col(f"n{k}") > 0) & (value > 0) & (value < k), value).otherwise(0.5 * k).alias(f"d{k}")

        discounts = level.groupBy("lang").agg(*many).select("lang", *[discount(k) for k in (1, 2, 3)])
        level = level.join(F.broadcast(discounts), "lang").withColumn(
            "off", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3")))
        before = F.shiftright("gram", 8).alias("before")
        context = level.groupBy("lang", before).agg(F.sum("n").alias("whole"), F.sum("off").alias("taken"))
        level = level.select("lang", "gram", before, "n", "off").join(context, ["lang", "before"])
        if below is None:
            under = F.lit(1 / 256)
        else:
            shorter = F.col("gram").bitwiseAND(F.lit((1 << 8 * (size - 1)) - 1))
            level = level.withColumn("shorter", shorter).join(
                below.select("lang", F.col("gram").alias("shorter"), F.col("p").alias("under")), ["lang", "shorter"])
            under = F.col("under")
        p = (F.col("n") - F.col("off")) / F.col("whole") + F.col("taken") / F.col("whole") * under
        below = level.select("lang", "gram", p.alias("p"))
    return below.select(F.shiftleft("lang", 32).bitwiseOR(F.col("gram")).alias("key"), F.log("p").alias("logp"))


def _described(ids: pa.Array, langs: pa.Array, texts: Texts, logp) -> pa.RecordBatch:
    """Counts and log-probabilities of rows; ``logp`` gives those of keys."""
    out = {c: [] for c in (*STATS, "n_bytes", "mark", "logp")}
    for a, b, part in texts.slices(_SLICE):
        for c, v in base_counts(part).items():
            out[c].append(v)
        found, offsets = grams(part)
        out["n_bytes"].append(np.diff(offsets))
        out["mark"].append(part.hashes(part.offsets[:-1], part.offsets[1:]).view(np.int64))
        out["logp"].append(_per_text(logp(_keys(langs, a, b, found, offsets)), offsets))
    columns = [pa.array(np.concatenate(v) if v else [], pa.float64() if c == "logp" else pa.int64())
               for c, v in out.items()]
    return pa.RecordBatch.from_arrays([ids, langs, *columns], names=["id", "lang", *out])


def described(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
              most_rows: int = MOST_ROWS) -> DataFrame:
    """id, lang, the counts ``STATS``, n_bytes, mark (a hash of the text) and logp (sum over the text) of every row."""
    rows = docs.select(F.col(key).alias("id"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    model = materialize(kneser_ney(materialize(counted(rows, "text", "lang"), "grams")), "model")
    kinds = docs.schema[key].dataType.simpleString()
    schema = f"id {kinds}, lang string, " + ", ".join(f"{c} bigint" for c in (*STATS, "n_bytes", "mark")) + ", logp double"
    if model.count() <= most_rows:
        table = model.toArrow()
        keys = table.column("key").to_numpy().view(U)
        order = np.argsort(keys)
        arrays = rows.sparkSession.sparkContext.broadcast(
            (keys[order], table.column("logp").to_numpy()[order].astype(np.float32)))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, values = arrays.value
            for batch in batches:
                yield _described(batch.column(0), batch.column(1), Texts.of(batch.column(2)),
                                 lambda k: values[np.searchsorted(keys, k)].astype(np.float64))

        return rows.mapInArrow(score, schema)

    n = parts_for(text_bytes(rows), lookups.BLOCK_BYTES)
    blocked = lookups.dealt(rows, n, "id", "text")

    def ask(group: pa.Table) -> pa.Table:
        langs, texts = group.column("lang").combine_chunks(), lookups.texts_of(group)
        parts = [np.unique(_keys(langs, a, b, *grams(part))) for a, b, part in texts.slices(_SLICE)]
        keys = np.unique(np.concatenate([np.zeros(0, U), *parts]))
        block = group.column("block")[0].as_py()
        return pa.Table.from_arrays([pa.array(keys.view(np.int64)), pa.array([block] * len(keys), pa.int32())],
                                    names=["key", "block"])

    got = blocked.groupBy("block").applyInArrow(ask, "key bigint, block int").join(model, "key")

    def finish(group: pa.Table, answer: pa.Table) -> pa.Table:
        keys = answer.column("key").to_numpy().view(U)
        order = np.argsort(keys)
        keys, values = keys[order], answer.column("logp").to_numpy()[order].astype(np.float32)
        ids, langs = (group.column(c).combine_chunks() for c in ("id", "lang"))
        return pa.Table.from_batches([_described(ids, langs, lookups.texts_of(group), lambda k: values[np.searchsorted(keys, k)].astype(np.float64))])

    return blocked.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(finish, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def bands(found: DataFrame, reach: float = REACH, least_reach: float = LEAST_REACH) -> DataFrame:
    """lang, low, high: limits of nats per byte, from exact quartiles (to 1/1000) of the texts that pass the base.

    Rows of one language with the same ``mark``, if there is one, are one text.
    """
    rows = found.filter(~base_failed()).select(
        "lang", F.floor(F.try_divide(-1000 * F.col("logp"), "n_bytes")).alias("bin"),
        *[c for c in ("mark",) if c in found.columns])
    if "mark" in rows.columns:
        rows = rows.groupBy("lang", "mark").agg(F.min("bin").alias("bin"))
    bins = rows.groupBy("lang", "bin").agg(F.count("*").alias("n"))
    by_lang = Window.partitionBy("lang")
    share = F.sum("n").over(by_lang.orderBy("bin")) / F.sum("n").over(by_lang)
    at = bins.select("lang", "bin", share.alias("share")).groupBy("lang").agg(*[
        (F.min(F.when(F.col("share") >= q, F.col("bin"))) / 1000.0).alias(c)
        for q, c in ((0.25, "q1"), (0.5, "mid"), (0.75, "q3"))])
    return at.select("lang", *[
        (F.col("mid") + sign * F.greatest(F.lit(least_reach), F.least(
            F.abs(share - 1) * F.col("mid"), reach * F.abs(F.col(q) - F.col("mid"))))).alias(c)
        for sign, q, c, share in ((-1, "q1", "low", F.lit(LEAST_SHARE)), (1, "q3", "high", F.lit(MOST_SHARE)))])


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", reach: float = REACH,
           least_reach: float = LEAST_REACH, most_rows: int = MOST_ROWS) -> DataFrame:
    """key, the counts ``STATS``, base_failed, kept and perplexity (per byte) for every row."""
    found = materialize(described(docs, key, text, lang, most_rows), "described")
    limits = bands(found, reach, least_reach).withColumnRenamed("lang", "of")
    nats = F.try_divide(-F.col("logp"), "n_bytes")
    stray = F.try_divide(F.lit(STRAY), F.sqrt("n_bytes"))
    within = (nats >= F.col("low") - stray) & (nats <= F.col("high") + stray)
    return found.join(limits, F.col("lang").eqNullSafe(F.col("of")), "left").select(
        F.col("id").alias(key), *STATS, base_failed().alias("base_failed"),
        (~base_failed() & F.coalesce(within, F.lit(False))).alias("kept"), F.exp(nats).alias("perplexity"))
