"""Token ids in compressed binary files: an adaptive context-mixing range coder over independent blocks.

A data set is a folder of tables that Spark commits whole; a row is a frame of whole documents in ascending key order
(``part``, ``frame`` order the rows; ``keys``; ``n_ids``; ``data``). ``data`` is, little-endian:

====================  ==============================================================================================
``MRID`` and version  4 + 1 bytes
counts                u32 documents, u32 ids, u32 ids per block, u32 different ids
directory             u32 length and zlib of: ids per document (u32 each), the different ids (u32 each, ascending)
                      and their frequencies in 2**18 (u32 each)
blocks                u32 bytes and u32 crc32 (of the ids as u32) of each block, then the blocks' bytes
====================  ==============================================================================================

Blocks of ``BLOCK`` ids start from a fresh state, so each can be read alone with the directory and is checked on its
own. Per id three predictions are mixed: the id that followed the last two ids before (order 2), the last one (order
1), and the frame's frequencies (order 0). Their weights belong to how sure orders 2 and 1 have been, and adapt with
every id. A 56-bit range coder with 32-bit digits codes which order is right and, for order 0, the id. All blocks of a
frame are coded side by side, one id of each per step.

Null texts count as empty; an empty text has the end id alone; rows that repeat a key stay apart and are ordered by
their text; rows without key come first; an empty table gives an empty data set.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.bpe import encoder
from millrace.llm.tables import parts_for, text_bytes
from millrace.llm.texts import Texts

MAGIC, VERSION = b"MRID", 2
BLOCK = 4096
PART_BYTES = 24 << 20
SLICE_BYTES = 4 << 20  # of text, encoded at once
FRAME_IDS = 10_000_000
SLOT_BITS = 12  # remembered contexts per order and block
ORDER0_BITS, CHOICE_BITS = 18, 12
LOW_BITS, DIGIT = 31, 32  # the coder keeps 31 to 63 bits of range
BOTTOM, MASK, WIDEST = 1 << LOW_BITS, np.uint64((1 << LOW_BITS) - 1), (1 << LOW_BITS + DIGIT) - 1
RANK_BITS = 30
RANKS, SURE_SHIFT, TWO = np.uint32((1 << RANK_BITS) - 1), np.uint32(RANK_BITS), np.uint32(2)
#: What a slot's number grows by, by its sureness (0 to 3): after a miss, after a hit.
SURER = np.array([0, -1, -1, -1, 1, 1, 1, 0]).astype(np.uint32) << SURE_SHIFT
HASHES, HASH_SHIFT = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)), np.uint32(32 - SLOT_BITS)
TABLED = 1 << 22  # ids below are counted and ranked by a table
TOGETHER = 32  # steps of the blocks that are predicted before they are coded
RATE = 4  # speed of the weights: 1 / 2 ** RATE of the way


class Predictor:
    """State of the blocks that are coded side by side; ids are their ranks among the frame's.

    Both orders lie in the rows of one array each: order 1, order 2.
    """

    def __init__(self, lanes: int):
        self.slots = np.zeros(2 * lanes << SLOT_BITS, np.uint32)  # sureness << RANK_BITS | rank
        self.base = (np.arange(2 * lanes) << SLOT_BITS).reshape(2, lanes)
        # Weights for each pair of surenesses, in 2 ** 16: order 2, and order 1 if not order 2. A pair is read as one.
        self.weights = np.full(lanes << 5, 1 << 12, np.int32).view(np.int64)
        self.choice = np.arange(lanes, dtype=np.uint32) << np.uint32(4)
        self.last, self.older = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)

    def narrow(self, n: int) -> None:
        """Goes on with the first ``n`` blocks."""
        self.base, self.choice = self.base[:, :n], self.choice[:n]
        self.last, self.older = self.last[:n], self.older[:n]

    def look(self) -> tuple[np.ndarray, np.ndarray]:
        """Predicted ranks of both orders, and their weights (in rows: order 2, order 1)."""
        hashed = np.empty(self.base.shape, np.uint32)
        np.multiply(self.last, HASHES[0], out=hashed[0])
        np.add(hashed[0], self.older, out=hashed[1])
        hashed >>= HASH_SHIFT
        self.at = hashed + self.base
        self.seen = self.slots.take(self.at)
        self.sure = self.seen >> SURE_SHIFT
        self.where = self.sure[1] << TWO
        self.where += self.sure[0]
        self.where += self.choice
        self.now = self.weights.take(self.where)
        # In rows, which NumPy goes through much faster.
        self.now = np.ascontiguousarray(self.now.view(np.int32).reshape(-1, 2).T)
        return self.seen & RANKS, self.now

    def learn(self, ranks: np.ndarray, hit: np.ndarray) -> None:
        """``hit``: which order was right, in rows."""
        step = hit[::-1] * np.int32(65535)
        step -= self.now
        step >>= RATE
        step[1] *= ~hit[1]
        step += self.now
        self.weights[self.where] = np.ascontiguousarray(step.T).view(np.int64)[:, 0]
        # A hit makes surer, a miss less sure, and what is not sure at all is replaced.
        self.sure += hit * np.uint32(4)
        new = SURER.take(self.sure)
        new += self.seen
        np.copyto(new, ranks, where=self.sure == 0)
        self.slots[self.at] = new
        np.multiply(self.last, HASHES[1], out=self.older)
        self.last[:] = ranks


def shares(weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares of orders 2 and 1 in 2 ** CHOICE_BITS."""
    room = np.int32((1 << CHOICE_BITS) - 2)
    two = weights[..., 0, :] * (room - np.int32(96))
    two >>= 16
    two += 1
    one = room - two
    one *= weights[..., 1, :]
    one >>= 16
    one += 1
    return two, one


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different ids, ascending, their frequencies, all over 0, in 2 ** ORDER0_BITS, and the ids' ranks."""
    if len(ids) and ids.max() < TABLED:
        count = np.bincount(ids)
        kinds = np.flatnonzero(count)
        rank = np.zeros(len(count), np.uint32)
        rank[kinds] = np.arange(len(kinds), dtype=np.uint32)
        count, ranks = count[kinds], rank.take(ids)
    else:
        kinds, ranks, count = np.unique(ids, return_inverse=True, return_counts=True)
    share = 1 + count * ((1 << ORDER0_BITS) - len(kinds)) // max(len(ids), 1)
    if len(kinds):
        share[count.argmax()] += (1 << ORDER0_BITS) - share.sum()
    return kinds, share, ranks.astype(np.uint32, copy=False)


def _alive(sizes: np.ndarray) -> Iterator[tuple[range, int]]:
    """Steps and number of blocks that have an id in each of them; blocks are full but for the last."""
    yield range(sizes[-1]), len(sizes)
    if len(sizes) > 1 and sizes[-1] < BLOCK:
        yield range(sizes[-1], BLOCK), len(sizes) - 1


def _lanes(n_ids: int) -> np.ndarray:
    """Ids of each block."""
    sizes = np.full(-(-n_ids // BLOCK), BLOCK)
    sizes[-1:] = n_ids - BLOCK * (len(sizes) - 1)
    return sizes


def code_blocks(ranks: np.ndarray, share: np.ndarray) -> list[bytes]:
    """Blocks of ids, given by their ranks among those that ``share`` has frequencies of."""
    sizes = _lanes(len(ranks))
    lanes = len(sizes)
    if not lanes:
        return []
    none = len(share)
    ranks = np.append(ranks, np.zeros(lanes * BLOCK - len(ranks), np.uint32))
    ranks = np.ascontiguousarray(ranks.reshape(lanes, BLOCK).T)  # one row a step
    # Behind the ids' own: what orders 1 and 2 code has no second part.
    start = np.concatenate([[0], np.cumsum(share)]).astype(np.uint64)
    start[-1] = 0
    share = np.append(share, 1).astype(np.uint64)
    low, width = np.zeros(lanes, np.uint64), np.full(lanes, WIDEST, np.uint64)
    # An id gives one digit at most.
    digits, place = np.zeros(lanes * (BLOCK + 2), np.uint64), np.arange(lanes) * (BLOCK + 2)
    begin, model = place.copy(), Predictor(lanes)
    for steps, n in _alive(sizes):
        model.narrow(n)
        bottom, room = low[:n], width[:n]
        weights, hits = np.empty((TOGETHER, 2, n), np.int32), np.empty((TOGETHER, 2, n), bool)
        for t in range(steps.start, steps.stop, TOGETHER):
            # The predictions do not hang on the coder: some steps of them, then the same steps of the coder.
            some = min(TOGETHER, steps.stop - t)
            for i in range(some):
                now = ranks[t + i, :n]
                guess, weights[i] = model.look()
                model.learn(now, np.equal(guess, now, out=hits[i]))
            two, one = shares(weights[:some])
            first, second = hits[:some, 1], hits[:some, 0]
            rest = ~(first | second)
            lead = np.where(second, two, two + one)
            lead[first] = 0
            size = np.where(first, two, one)
            np.copyto(size, (1 << CHOICE_BITS) - two - one, where=rest)
            lead, size = lead.astype(np.uint64), size.astype(np.uint64)
            k = np.where(rest, ranks[t: t + some, :n], np.uint32(none))
            from_, part, shift = start.take(k), share.take(k), rest * np.uint64(ORDER0_BITS)
            for i in range(some):
                unit = room >> np.uint64(CHOICE_BITS)
                bottom += unit * lead[i]
                unit *= size[i]
                unit >>= shift[i]
                bottom += unit * from_[i]
                np.multiply(unit, part[i], out=room)
                short = np.flatnonzero(room < BOTTOM)
                if len(short):
                    at, moved = place.take(short), bottom.take(short)
                    digits[at] = moved >> np.uint64(LOW_BITS)
                    place[short] = at + 1
                    moved &= MASK
                    moved <<= np.uint64(DIGIT)
                    bottom[short] = moved
                    room[short] <<= np.uint64(DIGIT)
    digits[place] = low >> np.uint64(LOW_BITS)
    digits[place + 1] = (low & MASK) << np.uint64(DIGIT - LOW_BITS)
    # A digit over 32 bits carries into the one before it.
    over = np.flatnonzero(digits >> np.uint64(DIGIT))
    while len(over):
        digits[over] &= np.uint64((1 << DIGIT) - 1)
        over -= 1
        digits[over] += np.uint64(1)
        over = over[digits[over] >> np.uint64(DIGIT) > 0]
    words = digits.astype(">u4")
    return [words[a:b].tobytes() for a, b in zip(begin.tolist(), (place + 2).tolist(), strict=True)]


def read_blocks(blocks: list[bytes], n_ids: int, kinds: np.ndarray, share: np.ndarray) -> np.ndarray:
    sizes = _lanes(n_ids)
    lanes = len(sizes)
    if not lanes:
        return np.zeros(0, np.uint32)
    out = np.zeros((BLOCK, lanes), np.uint32)
    at = np.cumsum([0, *(len(b) // 4 + 2 for b in blocks)])[:-1]
    word = np.frombuffer(b"".join(b[: len(b) // 4 * 4] + bytes(8) for b in blocks), ">u4").astype(np.int64)
    # The first 63 bits of the code, less the (zero) low end; what follows is read from a block's 64th bit on.
    back = DIGIT - LOW_BITS
    ahead = word[at] << LOW_BITS | word[at + 1] >> back
    word[:-1] = (word[:-1] << DIGIT - back & (1 << DIGIT) - 1) | word[1:] >> back
    at += 1
    width = np.full(lanes, WIDEST, np.int64)
    start = np.concatenate([[0], np.cumsum(share)])
    lookup = np.repeat(np.arange(len(kinds), dtype=np.uint32), share)
    model = Predictor(lanes)
    for steps, n in _alive(sizes):
        model.narrow(n)
        left, room = ahead[:n], width[:n]
        for t in steps:
            guess, weights = model.look()
            two, one = shares(weights)
            unit = room >> CHOICE_BITS
            end2 = unit * two
            end1 = unit * one
            np.copyto(room, end1)
            end1 += end2
            is_two = left < end2
            now = np.where(is_two, guess[1], guess[0])
            np.copyto(room, end2, where=is_two)
            end2 *= ~is_two
            rows = np.flatnonzero(left >= end1)
            if len(rows):
                before = end1.take(rows)
                part = (1 << CHOICE_BITS) - (two + one).take(rows)
                part = part * unit.take(rows) >> ORDER0_BITS
                value = (left.take(rows) - before).view(np.uint64) // part.view(np.uint64)
                k = lookup.take(value.view(np.int64), mode="clip")
                now[rows] = k
                before += part * start.take(k)
                end2[rows] = before
                part *= share.take(k)
                room[rows] = part
            left -= end2
            short = np.flatnonzero(room < BOTTOM)
            if len(short):
                place = at.take(short)
                # A damaged block may ask for more than there is.
                left[short] = left.take(short) << DIGIT | word.take(place, mode="clip")
                at[short] = place + 1
                room[short] <<= DIGIT
            out[t, :n] = now
            model.learn(now, guess == now)
    return kinds.astype(np.uint32).take(out.T.ravel()[:n_ids])


def pack(ids: np.ndarray, sizes: np.ndarray) -> bytes:
    """A frame of documents with ``sizes`` ids each."""
    kinds, share, ranks = frequencies(ids)
    blocks = code_blocks(ranks, share)
    directory = zlib.compress(b"".join(a.astype("<u4").tobytes() for a in (sizes, kinds, share)), 6)
    table = np.array([[len(b), zlib.crc32(ids[i * BLOCK: (i + 1) * BLOCK].astype("<u4").tobytes())]
                      for i, b in enumerate(blocks)], "<u4")
    return b"".join([MAGIC, struct.pack("<BIIII", VERSION, len(sizes), len(ids), BLOCK, len(kinds)),
                     struct.pack("<I", len(directory)), directory, table.tobytes(), *blocks])


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Ids and ids per document of a frame; raises ValueError if a block's checksum is wrong."""
    if data[:4] != MAGIC or data[4] != VERSION:
        raise ValueError("no frame of token ids")
    n_docs, n_ids, block, n_kinds = struct.unpack_from("<IIII", data, 5)
    if block != BLOCK:
        raise ValueError(f"blocks of {block} ids are not supported")
    (length,) = struct.unpack_from("<I", data, 21)
    directory = np.frombuffer(zlib.decompress(data[25: 25 + length]), "<u4").astype(np.int64)
    sizes, kinds, share = np.split(directory, [n_docs, n_docs + n_kinds])
    lanes = -(-n_ids // BLOCK)
    table = np.frombuffer(data, "<u4", 2 * lanes, 25 + length).reshape(-1, 2)
    ends = np.cumsum(table[:, 0], dtype=np.int64) + 25 + length + 8 * lanes
    ids = read_blocks([data[e - n: e] for e, n in zip(ends, table[:, 0].tolist(), strict=True)], n_ids, kinds, share)
    for i, crc in enumerate(table[:, 1].tolist()):
        if zlib.crc32(ids[i * BLOCK: (i + 1) * BLOCK].astype("<u4").tobytes()) != crc:
            raise ValueError(f"block {i} is damaged")
    return ids, sizes


def with_end(ids: np.ndarray, first: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with ``end_id`` behind each document, and ids per document."""
    return np.insert(ids, first[1:], end_id), np.diff(first) + 1


def even(runs: Iterator[tuple[pa.Array, np.ndarray, np.ndarray]],
         limit: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Runs of documents (keys, ids, ids per document) put together to about as many ids each, mostly up to ``limit``."""
    held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

    def cut(last: bool) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        keys = pa.concat_arrays([h[0] for h in held])
        ids, sizes = (np.concatenate([h[i] for h in held]) for i in (1, 2))
        held.clear()
        ends = np.cumsum(sizes)
        n = max(1, -(-len(ids) // limit))
        inner = np.searchsorted(ends, len(ids) * np.arange(1, n) // n, "right")
        bounds = np.unique(np.concatenate([[0], inner, [len(sizes)]]))
        for a, b in zip(bounds, bounds[1:], strict=False):
            first = ends[a] - sizes[a]
            run = keys.slice(a, b - a), ids[first: ends[b - 1]], sizes[a:b]
            if last or b < len(sizes):
                yield run
            else:
                held.append(run)

    for run in runs:
        held.append(run)
        if sum(len(h[1]) for h in held) >= 2 * limit:
            yield from cut(False)
    if held:
        yield from cut(True)


def write(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = 2,
          tokenizer: str | None = None) -> None:
    """Writes the ids of all texts, each with ``end_id`` behind it, in ascending order of the keys."""
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    parts = parts_for(text_bytes(rows), PART_BYTES)
    ordered = rows.repartitionByRange(parts, "key", F.xxhash64("text")).sortWithinPartitions("key", "text")

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, frame = TaskContext.get().partitionId(), 0
        for keys, ids, sizes in even(encoded(batches), FRAME_IDS):
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([frame], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                 pa.array([len(ids)], pa.int64()), pa.array([pack(ids, sizes)], pa.binary())],
                names=["part", "frame", "keys", "n_ids", "data"])
            frame += 1

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
        for batch in batches:
            for a, b, texts in Texts.of(batch.column(1)).slices(SLICE_BYTES):
                yield batch.column(0).slice(a, b - a), *with_end(*encoder(tokenizer).encode(texts), end_id)

    ordered.mapInArrow(frames, f"part int, frame int, keys array<{kind}>, n_ids bigint, data binary").write.mode(
        "errorifexists").option("compression", "uncompressed").parquet(path)


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """key, start (ids of all documents before), n_tokens, ids_crc32 and, if wanted, ids, from a written data set."""
    found = spark.read.parquet(path)
    element = found.schema["keys"].dataType.elementType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one, sizes = unpack(batch.column("data")[i].as_py())
                ends = np.cumsum(sizes)
                each = np.split(one, ends[:-1])
                keys = batch.column("keys").slice(i, 1).flatten()
                columns = [keys, *(batch.column(c).slice(i, 1).take(pa.array(np.zeros(len(sizes), np.int64)))
                                   for c in ("part", "frame")), pa.array(ends - sizes),
                           pa.array(sizes), pa.array([zlib.crc32(e.astype("<u4").tobytes()) for e in each], pa.int64())]
                names = ["key", "part", "frame", "start", "n_tokens", "ids_crc32"]
                if ids:
                    columns.append(pa.array([e.astype(np.int32) for e in each], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    more = ", ids array<int>" if ids else ""
    docs = found.select("part", "frame", "keys", "data").mapInArrow(
        rows, f"key {element}, part int, frame int, start bigint, n_tokens bigint, ids_crc32 bigint{more}")
    # Offsets: of parts from one row per part, of frames within their part.
    frames = found.select("part", "frame", "n_ids")
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = frames.groupBy("part").agg(F.sum("n_ids").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(before.orderBy("part")), F.lit(0)).alias("part_start"))
    inside = frames.select("part", "frame", F.coalesce(F.sum("n_ids").over(
        before.partitionBy("part").orderBy("frame")), F.lit(0)).alias("frame_start"))
    starts = inside.join(parts, "part").select("part", "frame", (F.col("part_start") + F.col("frame_start")).alias("base"))
    return docs.join(starts, ["part", "frame"]).select(
        "key", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if ids else []))
