"""Exact removal of repeated passages by sparse suffix arrays.

A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts in a row with a smaller key; strings are
judged on the input and never cross rows.

Not every suffix is sorted. Each string of 50 bytes names one anchor in it: the least hash among its 33 grams of 18
bytes (the leftmost of equals). Equal strings name the same anchor at the same place, so it is enough to sort the
suffixes that begin at anchors, about one in seventeen, and, lossless again, only at anchors whose gram stands in the
corpus more than once.

1. Blocks of documents ask shards how often each of their grams stands in the corpus (``lookups``).
2. Strings whose whole surroundings stand in the same block with a smaller key are marked there. One entry for each
   other anchor goes on, so that a passage shared by a third of all documents sends one entry per block.
3. Splitters, sampled from the suffixes' leading bytes, range-partition the entries. A leading key that holds more
   than its share takes several buckets, chosen by the gram. Equal strings have equal grams, so they meet in one
   bucket and no match straddles a boundary.
4. A bucket sorts its suffixes, and the reversed bytes before them, by multikey quicksort on words of eight bytes.
   Common prefix lengths of neighbours tell which strings are equal at each offset around the anchor; all but those
   with the smallest key are marked.
5. Marks return to their blocks, which cut the texts.

Keys are integers. Rows without key count as behind all others and do not remove from each other; rows that repeat a
key do not remove from each other either. Null and empty texts and texts under 50 bytes lose nothing. An empty table
gives an empty result; columns other than key and text are not touched.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import lookups
from millrace.llm.tables import parts_for
from millrace.llm.texts import Texts, U, binary, splitmix

LENGTH, GRAM = 50, 18
SPAN = LENGTH - GRAM + 1  # grams of a string
LEFT = SPAN - 1  # bytes that may lie before an anchor in a string
_PLACE = U(28)  # low bits that hold a place while minima slide
_NULL = np.iinfo(np.int64).max
SAMPLED_ROWS = 64  # rows that splitters are drawn from, for each bucket
_SLICE = 1 << 20  # bytes whose grams are hashed at a time

ENTRY = np.dtype([("key", "<i8"), ("row", "<u4"), ("at", "<u4"), ("low", "u1"), ("high", "u1"),
                  ("near", "u1", LEFT + LENGTH)])
MARK = np.dtype([("row", "<u4"), ("first", "<u4"), ("last", "<u4")])


def anchors(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Place of each anchor, first and last start of the strings that name it, and the hash of its gram."""
    parts = [[np.zeros(0, np.int64)] * 3 + [np.zeros(0, U)]]
    for a, _, part in texts.slices(_SLICE):
        *places, grams = _anchors(part)
        parts.append([p + texts.offsets[a] for p in places] + [grams])
    return tuple(map(np.concatenate, zip(*parts, strict=True)))


def _anchors(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(texts.data)
    if n < LENGTH:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),)
    starts = np.arange(n - GRAM + 1)
    grams = texts.hashes(starts, starts + GRAM)
    least = (grams >> _PLACE) << _PLACE | starts.astype(U)
    for k in (1, 2, 4, 8, 16):
        least = np.minimum(least[:-k], least[k:])
    least = np.minimum(least[: n - LENGTH + 1], ((grams >> _PLACE) << _PLACE | starts.astype(U))[SPAN - 1:])
    ends = np.repeat(texts.offsets[1:], np.diff(texts.offsets))[: len(least)]
    valid = np.flatnonzero(np.arange(len(least)) + LENGTH <= ends)
    named = (least[valid] & U((1 << 28) - 1)).astype(np.int64)
    # Starts that name one anchor follow one another.
    new = np.flatnonzero(np.diff(named, prepend=-1))
    if not len(new):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, U),)
    place = named[new]
    return place, valid[new], valid[np.append(new[1:], len(valid)) - 1], grams[place]


def _ordered(group: pa.Table) -> tuple[Texts, np.ndarray, np.ndarray]:
    """A block's texts by key, then text; their keys; and the order taken. The same whenever the block is read."""
    texts = lookups.texts_of(group)
    keys = group.column("key").combine_chunks().fill_null(_NULL).to_numpy()
    prints = np.array([zlib.crc32(texts.text(i)) for i in range(len(texts))], np.int64)
    order = np.lexsort((prints, keys))
    if (np.diff(order) == 1).all():
        return texts, keys, order
    sizes = np.diff(texts.offsets)[order]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    data = texts.data[np.arange(offsets[-1]) + np.repeat(texts.offsets[:-1][order] - offsets[:-1], sizes)]
    return Texts(data, offsets), keys[order], order


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of the rows of big-endian words: each further word is compared only among rows equal so far."""
    order = np.argsort(words[:, 0])
    first = words[order, 0]
    border = np.append(True, first[1:] != first[:-1])
    for k in range(1, words.shape[1]):
        single = border & np.append(border[1:], True)
        tied = np.flatnonzero(~single)
        if not len(tied):
            break
        group = np.cumsum(border)[tied]
        rows = order[tied]
        order[tied] = rows[np.lexsort((words[rows, k], group))]
        word = words[order[tied], k]
        border[tied] |= np.append(True, word[1:] != word[:-1])
    return order


def _classes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the byte rows, and the common prefix length of each with the one before it (0 at first)."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    order = multikey_order(padded.view(">u8").astype(U))
    differs = rows[order[1:]] != rows[order[:-1]]
    common = np.where(differs.any(1), differs.argmax(1), rows.shape[1])
    return order, np.append(0, common)


def repeated(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Strings in ``entries`` (in order of their keys) that also stand with a smaller key: their entries and marks."""
    right_order, right = _classes(entries["near"][:, LEFT:])
    left_order, left = _classes(entries["near"][:, :LEFT][:, ::-1])
    n, out = len(entries), []
    to_right, to_left = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for before in range(SPAN):
        # Strings that begin ``before`` bytes ahead of their anchor.
        rows = np.flatnonzero((entries["low"] >= before) & (entries["high"] <= before))
        if len(rows) < 2:
            continue
        to_right[right_order] = np.cumsum(right < LENGTH - before)
        to_left[left_order] = np.cumsum(left < before) if before else 0
        _, first, which = np.unique(to_right[rows] * (n + 1) + to_left[rows], return_index=True, return_inverse=True)
        keys = entries["key"][rows]
        rows = rows[keys > keys[first[which]]]
        mark = np.zeros(len(rows), MARK)
        mark["row"], mark["first"] = entries["row"][rows], entries["at"][rows] - before
        out.append((rows, mark))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, MARK)
    rows = np.concatenate([r for r, _ in out])
    marks = np.concatenate([m for _, m in out])
    marks["last"] = marks["first"]
    return rows, marks


def _joined(marks: np.ndarray) -> np.ndarray:
    """Marks of the same rows with neighbouring starts put together."""
    if not len(marks):
        return marks
    marks = marks[np.lexsort((marks["first"], marks["row"]))]
    reach = marks["last"].astype(np.int64)
    new = np.append(True, (marks["row"][1:] != marks["row"][:-1]) | (marks["first"][1:] > reach[:-1] + 1))
    at = np.flatnonzero(new)
    out = marks[at].copy()
    out["last"] = np.maximum.reduceat(reach, at)
    return out


def _entries(texts: Texts, keys: np.ndarray, answer: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marks decided in the block, entries that go on, and the grams of these."""
    place, first, last, grams = anchors(texts)
    if not len(place):
        return np.zeros(0, MARK), np.zeros(0, ENTRY), grams
    _, which = np.unique(grams, return_inverse=True)
    often = (lookups.totals_of(answer) > 1)[which]
    place, first, last, grams = place[often], first[often], last[often], grams[often]
    row = np.searchsorted(texts.offsets, place, "right") - 1
    entry = np.zeros(len(place), ENTRY)
    entry["key"], entry["row"], entry["at"] = keys[row], row, place - texts.offsets[row]
    entry["low"], entry["high"] = place - first, place - last
    padded = np.concatenate([np.zeros(LEFT, np.uint8), texts.data, np.zeros(LENGTH, np.uint8)])
    near = np.lib.stride_tricks.sliding_window_view(padded, LEFT + LENGTH)[place]
    reach = np.arange(LEFT + LENGTH)
    entry["near"] = near * ((reach >= LEFT - entry["low"][:, None]) &
                            (reach < LEFT + LENGTH - entry["high"][:, None].astype(np.int64)))
    # Rows are in order of their keys, so the first of equal surroundings has the smallest.
    whole = _row_hash(entry["near"], entry["low"].astype(U) << U(8) | entry["high"].astype(U))
    _, one, same = np.unique(whole, return_index=True, return_inverse=True)
    one = one[same]
    later = (entry["key"] > entry["key"][one]) & (entry["low"] == entry["low"][one]) & (
        entry["high"] == entry["high"][one]) & (entry["near"] == entry["near"][one]).all(1)
    mark = np.zeros(int(later.sum()), MARK)
    mark["row"], base = entry["row"][later], entry["at"][later]
    mark["first"], mark["last"] = base - entry["low"][later], base - entry["high"][later]
    return _joined(mark), entry[~later], grams[~later]


def _row_hash(rows: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes and its start value."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    padded[:, : rows.shape[1]] = rows
    for word in padded.view(U).T:
        start = splitmix(start ^ word)
    return start


def _lead(near: np.ndarray) -> np.ndarray:
    """The first eight bytes of each suffix as a number."""
    return np.ascontiguousarray(near[:, LEFT: LEFT + 8]).view(">u8")[:, 0].astype(U)


def splitters(rows: DataFrame, buckets: int, total: int) -> np.ndarray:
    """``buckets - 1`` leading keys from the anchors of about ``SAMPLED_ROWS`` rows a bucket.

    The rows are drawn from all ``total`` ones by a hash of key and text, so wherever a text lies in the table it may
    be drawn, and the sample grows with the number of buckets. Many rows alike in both are drawn together; no more
    than four times the wanted rows are looked at.
    """

    def leads(batches):
        for batch in batches:
            texts = Texts.of(batch.column(0))
            for _, _, part in texts.slices(_SLICE):
                place = _anchors(part)[0][::16]
                if len(place):
                    near = np.lib.stride_tricks.sliding_window_view(part.data, 8)[place]
                    yield pa.RecordBatch.from_arrays(
                        [binary([np.ascontiguousarray(near).tobytes()])], names=["leads"])

    every = max(1, total // (SAMPLED_ROWS * buckets))
    drawn = F.pmod(F.xxhash64("key", F.octet_length("text"), F.substring("text", 1, 64)), F.lit(every)) == 0
    some = rows.filter(drawn & (F.octet_length("text") >= LENGTH)).select("text").limit(4 * SAMPLED_ROWS * buckets)
    cells = [r.leads for r in some.mapInArrow(leads, "leads binary").collect()]
    found = np.sort(np.frombuffer(b"".join(cells), ">u8").astype(U))
    if not len(found) or buckets < 2:
        return np.zeros(0, U)
    return found[np.arange(1, buckets) * len(found) // buckets]


def _bucket(lead: np.ndarray, grams: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    low, high = np.searchsorted(cuts, lead, "left"), np.searchsorted(cuts, lead, "right")
    return low + (splitmix(grams) % (high - low + 1).astype(U)).astype(np.int64)


def spans(docs: DataFrame, finish: Callable[[Texts, list[np.ndarray]], dict[str, pa.Array]], columns: str,
          key: str = "doc_id", text: str = "text", block_bytes: int = lookups.BLOCK_BYTES) -> DataFrame:
    """The key and what ``finish`` makes of each block's texts and their removed runs (start, end)."""
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    size = rows.select(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes"), F.count("*").alias("rows")).first()
    n = parts_for(size["bytes"], block_bytes)
    blocked = lookups.dealt(rows, n, "key", "text")
    cuts = splitters(rows, n, size["rows"])

    def keys_of(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(anchors(_ordered(group)[0])[3], return_counts=True)

    answered = lookups.answers(lookups.asks(blocked, keys_of, n)).select("block", "shard", "totals")

    def offer(group: pa.Table, answer: pa.Table) -> pa.Table:
        texts, keys, _ = _ordered(group)
        block = group.column("block")[0].as_py()
        marks, entry, grams = _entries(texts, keys, answer)
        bucket = _bucket(_lead(entry["near"]), grams, cuts)
        order = np.argsort(bucket, kind="stable")
        entry, bucket = entry[order], bucket[order]
        at = np.flatnonzero(np.diff(bucket, prepend=-1))
        parts = [zlib.compress(entry[a:b].tobytes(), 1) for a, b in zip(at, np.append(at[1:], len(entry)), strict=True)]
        # Marks travel along to any bucket.
        return pa.Table.from_arrays(
            [pa.array([*bucket[at], block % (len(cuts) + 1)], pa.int32()), pa.array([block] * (len(at) + 1), pa.int32()),
             binary([*parts, None]), binary([*[None] * len(at), marks.tobytes()])],
            names=["bucket", "block", "entries", "marks"])

    offered = blocked.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(
        offer, "bucket int, block int, entries binary, marks binary")

    def sort(group: pa.Table) -> pa.Table:
        out: dict[int, list[bytes]] = {}
        blocks, cells = [], []
        for block, cell, mark in zip(group.column("block").to_pylist(), group.column("entries"),
                                     group.column("marks"), strict=True):
            if mark.is_valid:
                out.setdefault(block, []).append(mark.as_py())
            else:
                cells.append(np.frombuffer(zlib.decompress(cell.as_buffer()), ENTRY))
                blocks.append(np.full(len(cells[-1]), block, np.int32))
        if cells:
            entry, block = np.concatenate(cells), np.concatenate(blocks)
            order = np.argsort(entry["key"], kind="stable")
            which, marks = repeated(entry[order])
            block = block[order][which]
            for b in np.unique(block).tolist():
                out.setdefault(b, []).append(_joined(marks[block == b]).tobytes())
        return pa.Table.from_arrays([pa.array(list(out), pa.int32()), binary([b"".join(v) for v in out.values()])],
                                    names=["block", "marks"])

    marked = offered.groupBy("bucket").applyInArrow(sort, "block int, marks binary")

    def cut(group: pa.Table, got: pa.Table) -> pa.Table:
        texts, _, order = _ordered(group)
        marks = np.frombuffer(b"".join(c.as_py() for c in got.column("marks")), MARK)
        removed = [np.zeros((0, 2), np.int64)] * len(texts)
        if len(marks):
            wide = marks.copy()
            wide["last"] += LENGTH - 1
            wide = _joined(wide)
            at = np.flatnonzero(np.diff(wide["row"].astype(np.int64), prepend=-1))
            for a, b in zip(at, np.append(at[1:], len(wide)), strict=True):
                runs = np.stack([wide["first"][a:b], wide["last"][a:b].astype(np.int64) + 1], 1).astype(np.int64)
                removed[wide["row"][a]] = runs
        made = finish(texts, removed)
        keys = group.column("key").combine_chunks().take(pa.array(order))
        return pa.Table.from_arrays([keys, *made.values()], names=["key", *made])

    out = blocked.groupBy("block").cogroup(marked.groupBy("block")).applyInArrow(cut, f"key bigint, {columns}")
    return out.withColumnRenamed("key", key)


def _kept(texts: Texts, i: int, runs: np.ndarray) -> bytes:
    raw, at, out = texts.text(i), 0, []
    for a, b in runs.tolist():
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def _spans_of(texts: Texts, removed: list[np.ndarray]) -> dict[str, pa.Array]:
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    kept = [_kept(texts, i, r).decode("utf-8", "ignore") for i, r in enumerate(removed)]
    return {"text": pa.array(kept, pa.string()),
            "removed": pa.array([[{"start": a, "end": b} for a, b in r.tolist()] for r in removed], kind)}


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text without the removed bytes (and without halves of characters), removed runs as byte ranges."""
    return spans(docs, _spans_of, "text string, removed array<struct<start:bigint,end:bigint>>", key, text)


def _digest_of(texts: Texts, removed: list[np.ndarray]) -> dict[str, pa.Array]:
    return {"n_bytes": pa.array(np.diff(texts.offsets), pa.int64()),
            "n_removed": pa.array([int((r[:, 1] - r[:, 0]).sum()) for r in removed], pa.int64()),
            "n_spans": pa.array([len(r) for r in removed], pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(_kept(texts, i, r)).hexdigest() for i, r in enumerate(removed)],
                                    pa.string())}


def digest(docs: DataFrame) -> DataFrame:
    return spans(docs, _digest_of, "n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
