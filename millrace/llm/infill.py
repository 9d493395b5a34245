"""Fill-in-the-middle: texts cut at two token bounds and put together as prefix, suffix, middle.

Tokens are runs of ``A-Z a-z`` and single other characters. The ranks of the cuts are drawn from the row's key; a
learned index turns a rank into a place. ``RankIndex`` fits straight segments to all bounds of a text, none of which is
further than ``ERROR`` bytes from its line, and keeps what the rounded line misses in one signed byte a bound: the place
of a rank is the line's value plus that byte, exactly. It is built piece by piece, so a text of any length costs its own
bytes, one byte a bound and a few arrays over ``PIECE`` bytes.

A null text counts as empty; empty texts, texts that hold a marker and the share ``1 - rate`` of all stay as they are.
A null key draws as the empty string. Repeated rows are cut alike; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.texts import Texts, binary

ERROR = 120
PIECE = 1 << 20
#: Bytes of text given back at once.
_OUT = 8 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_P, _S, _M = (m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def bounds(piece: np.ndarray, after_letter: bool) -> np.ndarray:
    """Places in a piece of UTF-8 where tokens start; ``after_letter``: what came before it ends in a letter."""
    letter = _LETTER[piece]
    inside = letter.copy()
    inside[1:] &= letter[:-1]
    inside[:1] &= after_letter
    return np.flatnonzero(~(inside | ((piece & 0xC0) == 0x80)))


def segments(places: np.ndarray, error: int) -> Iterator[tuple[int, int, float]]:
    """(first, last, slope): the longest runs from the left that one line through their first point meets within ``error``.

    The slopes that still serve all points seen form an interval, which every further point narrows.
    """
    first, width = 0, 1024
    while first < len(places):
        while True:
            ahead = places[first + 1: first + 1 + width] - places[first]
            step = np.arange(1, len(ahead) + 1)
            low = np.maximum.accumulate((ahead - error) / step)
            high = np.minimum.accumulate((ahead + error) / step)
            n = int(np.searchsorted(low > high, True))
            if n < len(ahead) or first + 1 + width >= len(places):
                break
            width *= 4
        yield first, first + 1 + n, (low[n - 1] + high[n - 1]) / 2 if n else 0.0
        first += 1 + n
        width = max(8, 2 * n)


class RankIndex:
    """Where the token of each rank starts in a text; the rank after the last token is the text's end."""

    def __init__(self, text: np.ndarray, error: int = ERROR):
        self.ranks, self.places, self.slopes, missed, count = [], [], [], [], 0
        for at in range(0, len(text), PIECE):
            here = at + bounds(text[at: at + PIECE], at > 0 and bool(_LETTER[text[at - 1]]))
            self._fit(here, count, missed, error)
            count += len(here)
        self._fit(np.array([len(text)]), count, missed, error)
        self.tokens = count
        self.missed = np.concatenate(missed)

    def _fit(self, places: np.ndarray, rank: int, missed: list, error: int) -> None:
        for first, last, slope in segments(places, error):
            self.ranks.append(rank + first)
            self.places.append(int(places[first]))
            self.slopes.append(slope)
            line = np.floor(slope * np.arange(last - first)).astype(np.int64)
            missed.append((places[first: last] - places[first] - line).astype(np.int8))

    def place(self, rank: int) -> int:
        s = bisect_right(self.ranks, rank) - 1
        line = int(np.floor(self.slopes[s] * (rank - self.ranks[s])))
        return self.places[s] + line + int(self.missed[rank])


def _characters(text: np.ndarray) -> int:
    return sum(int(np.count_nonzero((text[at: at + PIECE] & 0xC0) != 0x80)) for at in range(0, len(text), PIECE))


def cut(raw: bytes, h1: int, h2: int, h3: int, h4: int, rate: int, spm: int) -> tuple:
    """n, form, code points of prefix and middle, output."""
    text = np.frombuffer(raw, np.uint8)
    index = RankIndex(text)
    n = index.tokens
    if not n or h3 % 100 >= rate or _P in raw or _S in raw or _M in raw:
        return n, "plain", None, None, raw
    a, b = (index.place(r) for r in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = raw[:a], raw[a:b], raw[b:]
    swapped = h4 % 100 < spm
    parts = (_S, suffix, _P, prefix, _M, middle) if swapped else (_P, prefix, _S, suffix, _M, middle)
    return n, "spm" if swapped else "psm", _characters(text[:a]), _characters(text[a:b]), b"".join(parts)


def draws(key: Column, seed: int) -> list[Column]:
    """Four numbers below 2^32 from the row's key: groups of digits of a SHA-256."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digits, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def infilled(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, rate: int = 90,
             spm: int = 20) -> DataFrame:
    """key, n, form, prefix_chars, middle_chars, output: every text whole, ``rate`` percent of them cut.

    ``psm`` gives ``<P>`` prefix ``<S>`` suffix ``<M>`` middle; ``spm`` percent of the cut texts put the suffix first.
    """
    kind = docs.schema[key].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = Texts.of(batch.column(1))
            h = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(2, 6)], 1).tolist()
            for first, last, part in texts.slices(_OUT):
                n, form, prefix, middle, output = zip(
                    *(cut(part.text(i), *h[first + i], rate, spm) for i in range(len(part))), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(n, pa.int64()), pa.array(form, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), binary(list(output)).view(pa.string())],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text"), *draws(F.col(key), seed)).mapInArrow(
        rows, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string",
    ).withColumnRenamed("id", key)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A cut text holds no marker, so the first ones are those put in."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", 4)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def digest(docs: DataFrame) -> DataFrame:
    """Where each document is cut, with hashes of its output and of the text restored from it."""
    return infilled(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


SQL = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), split AS (
  SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS t,
    CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
    CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM drawn
), placed AS (
  SELECT *, least(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS a, greatest(h1 % (len(t) + 1), h2 % (len(t) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM split
), cut AS (
  SELECT *, array_to_string(list_slice(t, 1, a), '') AS prefix, array_to_string(list_slice(t, a + 1, b), '') AS middle,
    array_to_string(list_slice(t, b + 1, len(t)), '') AS suffix
  FROM placed
)
SELECT doc_id, CAST(len(t) AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM cut
"""
