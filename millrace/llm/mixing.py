"""Language-model scores by online logistic mixing of hashed-context bit predictors.

A byte is a path of yes/no decisions down a Huffman tree of the corpus's bytes. Four predictors know how often each
decision went which way in the training texts after a hashed context: the last one, two, three and four bytes. Their
log-odds are combined by weights from a set that the three-byte context gates, and the result is refined by an adaptive
probability map; weights and map start equal in every segment of ``SEGMENT`` bytes and learn online along it, while the
contexts reach back over its start. Log-probabilities add up to the text's score, and with its length to bits per byte.

Counts are taken from all training texts. The predictor tables are read by hash and have a row for each 1 KB of text
(contexts may share one), so they grow with the corpus. Up to ``WHOLE_BITS`` bits of rows they are broadcast whole (25
MB); larger ones lie in shards of ``PART_BITS`` bits of rows, where the counts of all blocks of texts meet, and a block
gets back the log-odds of the decisions it holds. Scores are the same either way. The unigram counts of the base score
grow with the vocabulary; they are summed and looked up by shards.

A null or empty text has probability 1. Without training texts every decision costs one bit. Rows with a null key
count as training texts unless the split says otherwise; repeated rows are counted and scored one by one; an empty
table gives an empty result.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import lookups
from millrace.llm.tables import materialize, parts_for, text_bytes
from millrace.llm.texts import BASE, Texts, U, binary, splitmix

WHOLE_BITS = 15  # larger predictor tables are not held whole
PART_BITS = 13  # rows of a table in one shard
ORDERS = 4
SEGMENT = 512
SCALE = 12.0  # steps of a stored log-odds per unit
START = (0.15, 0.25, 0.4, 0.35)  # weights at the start of a segment
GATED = 2  # the predictor whose log-odds choose the weights
RATE, MAP_RATE = 0.02, 0.02
GATES = (1.0, 3.0)
CELLS = 65
SHARD_BITS = 12  # contexts of one row of counts
VOTED = 1 << 13  # bytes whose decisions are looked up together
AHEAD = 16  # decisions of a segment that are read together
END_KEY = splitmix(np.array([0xE0D], U))[0]


def tree(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Huffman tree of all 256 bytes: path length of each, and the nodes and bits of all paths end to end."""
    heap = [(int(c) + 1, b, [b]) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    paths: list[list[tuple[int, int]]] = [[] for _ in range(256)]
    node = 254
    while len(heap) > 1:
        (m, x, low), (n, y, high) = heapq.heappop(heap), heapq.heappop(heap)
        for bit, side in ((0, low), (1, high)):
            for b in side:
                paths[b].append((node, bit))
        heapq.heappush(heap, (m + n, min(x, y), low + high))
        node -= 1
    flat = [step for path in paths for step in reversed(path)]
    return (np.array([len(p) for p in paths]), np.array([s[0] for s in flat], np.uint8),
            np.array([s[1] for s in flat], np.uint8))


def contexts(texts: Texts, bits: int, orders: int = ORDERS) -> list[np.ndarray]:
    """For each byte the rows of the predictor tables; a context never reaches over its text's start."""
    data, n = texts.data, len(texts.data)
    back = np.zeros((orders, n), np.uint32)
    near = np.zeros(0, np.int64)  # less than ``k`` bytes behind a text's start
    for k in range(1, orders + 1):
        near = np.concatenate([near, texts.offsets[:-1] + (k - 1)])
        near = near[near < n]
        back[k - 1, k:] = data[:-k]
        back[k - 1][near] = 0
    rows = [back[0]]
    last = back[0].copy()
    for k in range(1, orders):
        last |= back[k] << np.uint32(8 * k)
        # A multiplicative hash of the last k + 1 bytes; the product's high bits depend on all of them.
        mixed = (last ^ last >> np.uint32(15)) * np.uint32(0x9E3779B1 + 2 * k)
        rows.append((mixed ^ mixed >> np.uint32(13)) * np.uint32(0x85EBCA6B) >> np.uint32(32 - bits))
    return rows


def cells(rows: np.ndarray, data: np.ndarray, bits: int) -> np.ndarray:
    """The cell of each byte: the row of its context, and the byte."""
    kind = np.uint32 if bits <= 24 else U
    return rows.astype(kind) << kind(8) | data


def _summed(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers in order, and how often each occurs."""
    at = np.sort(at)
    last = np.flatnonzero(np.append(at[1:] != at[:-1], True)[: len(at)])
    return at[last], np.diff(last, prepend=-1)


def histograms(docs: DataFrame, text: str, bits: int, orders: int = ORDERS) -> DataFrame:
    """order, shard, counts: how often each byte follows each context, summed over all rows.

    A task keeps its counts in arrays of fixed size and gives their filled cells once, in rows of ``2 ** SHARD_BITS``
    contexts, so that what is shuffled grows with the number of tasks and not of bytes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros((256 if k == 0 else 1 << bits) * 256, np.uint32) for k in range(orders)]
        for batch in batches:
            for _, _, part in Texts.of(batch.column(0)).slices(1 << 21):
                for acc, rows in zip(tables, contexts(part, bits, orders), strict=True):
                    # Sorted, the cells of a table are gone through in order, each once.
                    at, n = _summed(cells(rows, part.data, bits))
                    acc[at] += n.astype(np.uint32)
        for k, acc in enumerate(tables):
            for shard, part in enumerate(np.split(acc, max(1, len(acc) >> SHARD_BITS + 8))):
                at = np.flatnonzero(part)
                if len(at):
                    packed = zlib.compress(at.astype(np.uint32).tobytes() + part[at].tobytes(), 1)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k], pa.int32()), pa.array([shard], pa.int32()), binary([packed])],
                        names=["order", "shard", "cells"])

    def add(group: pa.Table) -> pa.Table:
        k = group.column("order")[0].as_py()
        acc = np.zeros(min(256 if k == 0 else 1 << bits, 1 << SHARD_BITS) * 256, np.int64)
        for cell in group.column("cells"):
            at, n = np.frombuffer(zlib.decompress(cell.as_py()), np.uint32).reshape(2, -1)
            acc[at] += n
        whole = acc.reshape(-1, 256).sum(0) if k == 0 else np.zeros(256, np.int64)
        return pa.Table.from_arrays(
            [pa.array([k], pa.int32()), group.column("shard").slice(0, 1).combine_chunks(),
             binary([zlib.compress(acc.tobytes(), 1)]), pa.array([whole.tolist()], pa.list_(pa.int64()))],
            names=["order", "shard", "cells", "bytes"])

    parts = docs.select(text).mapInArrow(count, "order int, shard int, cells binary")
    return parts.groupBy("order", "shard").applyInArrow(
        add, "order int, shard int, cells binary, bytes array<bigint>")


class Mixer:
    """Predictor tables and the code tree; scores texts."""

    by_step = False  # whether the log-odds of a table lie by decisions of a byte or by nodes

    def __init__(self, bits: int, code: tuple, tables: list[np.ndarray]):
        self.bits, self.tables = bits, tables
        self.length, self.nodes, self.turns = code
        self.start = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int32)

    def _rows(self, part: Texts) -> list[np.ndarray]:
        """For each byte the places in the tables from which its log-odds are."""
        return [r.astype(np.int64) << 8 for r in contexts(part, self.bits)]

    def log10(self, texts: Texts) -> np.ndarray:
        """log10 of the probability of each text."""
        out = np.zeros(len(texts))
        for first, last, part in texts.slices(1 << 21):
            if len(part.data):
                out[first:last] = self._slice(part)
        return out

    def _slice(self, part: Texts) -> np.ndarray:
        sizes = np.diff(part.offsets)
        # Segments: starts in the data, none over a text's end.
        per_text = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(part)), per_text)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
        seg = part.offsets[owner] + nth * SEGMENT
        # Decisions of all bytes end to end: of byte ``i`` from ``first[i]`` on.
        first = np.concatenate([[0], np.cumsum(self.length[part.data])])
        begin = first[seg]
        count = first[np.minimum(seg + SEGMENT, part.offsets[owner + 1])] - begin
        order = np.argsort(-count, kind="stable")
        begin, count = begin[order], count[order]
        # How many segments still have a decision, step by step.
        alive = np.searchsorted(-count, -np.arange(int(count[0])), "left")
        odds, turns = self._votes(part, first)
        return np.bincount(owner[order], self._lanes(odds, turns, begin, alive), len(part))

    def _votes(self, part: Texts, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The four log-odds of each decision as one 32-bit number, and its turn with its gate above, in text order."""
        # What is read ahead of the last decision is no one's.
        odds = np.zeros((int(first[-1]) + AHEAD, ORDERS), np.int8)
        turns = np.zeros(len(odds), np.uint8)
        size = np.abs(np.arange(256, dtype=np.uint8).view(np.int8).astype(np.float32))
        gate = sum((size > g * SCALE).astype(np.uint8) for g in GATES) << 1
        rows = self._rows(part)
        # Some bytes at a time, so that what belongs to them stays near the processor.
        for a in range(0, len(part.data), VOTED):
            data = part.data[a: a + VOTED]
            steps = self.length[data]
            here = slice(int(first[a]), int(first[a + len(data)]))
            byte = np.repeat(np.arange(len(data)), steps)
            place, begin = np.arange(here.start, here.stop), first[a: a + len(data)]
            where = place + (self.start[data] - begin).take(byte)
            node = place if self.by_step else self.nodes.take(where).astype(np.int64)
            for k in range(ORDERS):
                row = rows[k][a: a + len(data)]
                odds[here, k] = self.tables[k].take((row - begin if self.by_step else row).take(byte) + node)
            turns[here] = self.turns.take(where) | gate.take(odds[here, GATED].view(np.uint8))
        return odds.view(np.int32)[:, 0], turns

    @staticmethod
    def _lanes(odds: np.ndarray, turns: np.ndarray, begin: np.ndarray, alive: np.ndarray) -> np.ndarray:
        """log10 of the probability of each segment's decisions; all segments go step by step together."""
        lanes, gates = len(begin), len(GATES) + 1
        # Four weights are read and written as one number of 16 bytes.
        weight = np.tile(np.array(START, np.float32), (gates * lanes, 1)).view(np.complex128)[:, 0]
        map_ = np.tile(1 / (1 + np.exp(-np.linspace(-8, 8, CELLS))), lanes).astype(np.float32)
        base, row = np.arange(lanes) * gates, np.arange(lanes) * CELLS
        unit, half = np.float32(1 / SCALE), np.float32(0.5)
        rate, map_rate, cells = np.float32(RATE), np.float32(MAP_RATE), np.float32((CELLS - 1) / 16)
        low, high, eight = np.float32(1e-4), np.float32(1 - 1e-4), np.float32(8)
        # Products of 32 steps stay in the range of a float.
        cost, shares = np.zeros(lanes), np.ones((32, lanes), np.float32)
        later = np.arange(AHEAD)[:, None]
        for t, n in enumerate(alive.tolist()):
            k = t % AHEAD
            if not k:  # the next decisions, one row a step
                now = begin[:n] + t + later
                xs, turn = odds.take(now).view(np.int8), turns.take(now)
            x = np.multiply(xs[k, : ORDERS * n], unit, dtype=np.float32).reshape(n, ORDERS)
            y, at = (turn[k, :n] & 1).astype(np.float32), base[:n] + (turn[k, :n] >> 1)
            held = weight.take(at)
            w = held.view(np.float32).reshape(n, ORDERS)
            z = w * x
            z = (z[:, 0] + z[:, 1]) + (z[:, 2] + z[:, 3])
            np.clip(z, -eight, eight, out=z)
            p = np.negative(z)
            np.exp(p, out=p)
            p += 1
            np.reciprocal(p, out=p)
            miss = y - p
            miss *= rate
            for i in range(ORDERS):
                x[:, i] *= miss
            w += x
            weight[at] = held
            # The adaptive map: the cell nearest to z.
            z += 8
            z *= cells
            at = row[:n] + np.rint(z, out=z).astype(np.int64)
            fine = map_.take(at)
            p += fine
            p *= half
            miss = y - fine
            miss *= map_rate
            fine += miss
            map_[at] = fine
            np.clip(p, low, high, out=p)
            y -= 1
            np.add(p, y, out=shares[t % 32, :n])
            if t % 32 == 31:
                cost += np.log10(np.abs(shares, out=shares).prod(0, np.float64))
                shares[:] = 1
        return cost + np.log10(np.abs(shares, out=shares).prod(0, np.float64))


class FetchedMixer(Mixer):
    """A mixer of the log-odds that a block of texts was answered with, for scoring these texts."""

    by_step = True

    def __init__(self, mixer: Mixer, answers: list[tuple[np.ndarray, np.ndarray]]):
        """``mixer`` has the table of the last byte; the others' distinct cells and their log-odds are the answers."""
        self.bits, self.length, self.nodes, self.turns, self.start = (
            mixer.bits, mixer.length, mixer.nodes, mixer.turns, mixer.start)
        self.tables = [mixer.tables[0].reshape(256, 256)[:, self.nodes].ravel(), *(odds for _, odds in answers)]
        self.found = [self._sought(at) for at, _ in answers]

    def _sought(self, at: np.ndarray) -> tuple:
        """The cells by a hash that keeps them apart, where their log-odds begin, and where each hash's first is."""
        steps = self.length[at & at.dtype.type(255)]
        key = at.astype(U) * BASE
        order = np.argsort(key)
        key = key[order]
        bits = max(1, (2 * len(key)).bit_length())
        first = np.zeros((1 << bits) + 1, np.int32)
        np.cumsum(np.bincount((key >> U(64 - bits)).astype(np.int64), minlength=1 << bits), out=first[1:])
        return key, (np.cumsum(steps) - steps)[order], first, U(64 - bits)

    def _rows(self, part: Texts) -> list[np.ndarray]:
        rows = contexts(part, self.bits)
        out = [rows[0].astype(np.int64) * len(self.nodes) + self.start[part.data]]
        for row, (found, begin, first, shift) in zip(rows[1:], self.found, strict=True):
            key = cells(row, part.data, self.bits).astype(U) * BASE
            at = first.take((key >> shift).astype(np.int64))
            # Every cell is there: those that are not at their hash's first place are behind it.
            miss = np.flatnonzero(found.take(at) != key)
            while len(miss):
                at[miss] += 1
                miss = miss[found.take(at[miss]) != key[miss]]
            out.append(begin.take(at))
        return out


def bits_for(size: int) -> int:
    """Bits of the tables' rows: one row for each 1 KB of text."""
    return min(32, max(SHARD_BITS, math.ceil(math.log2(max(size, 1) / 1024 + 1))))


def _log_odds(all_: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Stored log-odds of decisions by how often they were taken, and how often they were 1."""
    odds = np.log((one + 0.2) / (all_ - one + 0.2))
    return np.clip(np.rint(odds * SCALE), -127, 127).astype(np.int8)


def train(docs: DataFrame, learn: Column | None = None, text: str = "text", size: int | None = None,
          orders: int = ORDERS) -> Mixer:
    """Mixer with the counts of all rows of ``docs`` for which ``learn`` holds.

    Its tables are whole, 768 bytes for each 1 KB of text; with ``orders`` 1 there is only that of the last byte.
    """
    size = text_bytes(docs, text) if size is None else size
    bits = bits_for(size)
    known = docs if learn is None else docs.filter(learn)
    counts = materialize(histograms(known, text, bits, orders), "histograms")
    whole = counts.filter("order = 0").select("bytes").first()
    code = tree(np.array(whole["bytes"] if whole else [0] * 256))
    length, nodes, turns = code
    owner = np.repeat(np.arange(256), length)
    seen, ones = np.zeros((256, 256)), np.zeros((256, 256))
    seen[owner, nodes] = 1
    ones[owner, nodes] = turns

    def log_odds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for cell in batch.column("cells"):
                n = np.frombuffer(zlib.decompress(cell.as_py()), np.int64).reshape(-1, 256).astype(np.float64)
                out.append(zlib.compress(_log_odds(n @ seen, n @ ones).tobytes(), 1))
            yield pa.RecordBatch.from_arrays([batch.column("order"), batch.column("shard"), binary(out)],
                                             names=["order", "shard", "odds"])

    tables = [np.zeros((256 if k == 0 else 1 << bits) * 256, np.int8) for k in range(orders)]
    for r in counts.select("order", "shard", "cells").mapInArrow(
            log_odds, "order int, shard int, odds binary").toLocalIterator():
        odds = np.frombuffer(zlib.decompress(r["odds"]), np.int8)
        at = r["shard"] << SHARD_BITS + 8
        tables[r["order"]][at: at + len(odds)] = odds
    return Mixer(bits, code, tables)


def _block_cells(texts: Texts, learn: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each table but that of the last byte the sorted distinct cells, and their counts in training texts."""
    some: list[list[tuple]] = [[] for _ in range(ORDERS)]
    for first, last, part in texts.slices(1 << 21):
        apart = ~np.repeat(learn[first:last], np.diff(part.offsets))
        for k, rows in enumerate(contexts(part, bits)[1:], 1):
            at = cells(rows, part.data, bits)
            found, n = _summed(at)
            other, less = _summed(at[apart])
            n[np.searchsorted(found, other)] -= less
            some[k].append((found, n))
    for found in some[1:]:
        at, place = np.unique(np.concatenate([np.zeros(0, np.uint32), *(f for f, _ in found)]), return_inverse=True)
        n = np.concatenate([np.zeros(0), *(n for _, n in found)])
        yield at, np.bincount(place, n, len(at)).astype(np.int64)


def _paths(code: tuple, start: np.ndarray, byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The decisions of the bytes end to end: for each the index of its byte, and its place among all paths."""
    steps = code[0][byte]
    owner = np.repeat(np.arange(len(byte)), steps)
    return owner, np.arange(len(owner)) + (start[byte] - (np.cumsum(steps) - steps))[owner]


def fetched(blocked: DataFrame, bits: int, low: int, code: tuple) -> DataFrame:
    """block, order, shard, cells, odds: for each cell a block holds the log-odds of its byte's decisions.

    Blocks send their distinct cells with the counts to shards of ``2 ** low`` cells of a table. Both grow in number
    with the text and not in size.
    """

    def ask(group: pa.Table) -> pa.Table:
        found = []
        learned = group.column("learn").to_numpy()
        for k, (at, n) in enumerate(_block_cells(lookups.texts_of(group), learned, bits), 1):
            shard = (at >> at.dtype.type(low)).astype(np.int64)
            inside = (at & at.dtype.type((1 << low) - 1)).astype(np.uint32)
            edges = np.flatnonzero(np.diff(shard, prepend=-1))
            for a, b in zip(edges, np.append(edges[1:], len(at)), strict=True):
                found.append((k, int(shard[a]), inside[a:b].tobytes(), n[a:b].tobytes()))
        return pa.Table.from_arrays(
            [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int32()),
             pa.array([group.column("block")[0].as_py()] * len(found), pa.int32()),
             binary([f[2] for f in found]), binary([f[3] for f in found])],
            names=["order", "shard", "block", "cells", "counts"])

    length, nodes, turns = code
    start = np.concatenate([[0], np.cumsum(length)])

    def answer(group: pa.Table) -> pa.Table:
        asked = [np.frombuffer(c.as_buffer(), np.uint32) for c in group.column("cells")]
        counts = np.concatenate([np.frombuffer(c.as_buffer(), np.int64) for c in group.column("counts")])
        total = np.bincount(np.concatenate(asked), counts, 1 << low)  # whole numbers, exact below 2^53
        at = np.flatnonzero(total)
        owner, where = _paths(code, start, at & 255)
        place, n = (at >> 8 << 8)[owner] | nodes[where], total[at][owner]
        all_, one = np.bincount(place, n, 1 << low), np.bincount(place, n * turns[where], 1 << low)
        odds, taken = np.zeros(1 << low, np.int8), np.flatnonzero(all_)
        odds[taken] = _log_odds(all_[taken], one[taken])
        out = []
        for cell in asked:
            cell = cell.astype(np.int64)
            owner, where = _paths(code, start, cell & 255)
            out.append(odds.take((cell >> 8 << 8)[owner] | nodes[where]).tobytes())
        return pa.Table.from_arrays(
            [*(group.column(c).combine_chunks() for c in ("block", "order", "shard", "cells")), binary(out)],
            names=["block", "order", "shard", "cells", "odds"])

    asked = blocked.groupBy("block").applyInArrow(ask, "order int, shard int, block int, cells binary, counts binary")
    return asked.groupBy("order", "shard").applyInArrow(
        answer, "block int, order int, shard int, cells binary, odds binary")


def _answers_of(answer: pa.Table, bits: int, low: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """A block's cells of each table but that of the last byte, and their log-odds, as ``fetched`` gives them."""
    kind = np.uint32 if bits <= 24 else U
    order, shard = answer.column("order").to_numpy(), answer.column("shard").to_numpy()
    cell, odds = answer.column("cells").combine_chunks(), answer.column("odds").combine_chunks()
    out = []
    for k in range(1, ORDERS):
        mine = np.flatnonzero(order == k).tolist()
        at = [kind(int(shard[i]) << low) | np.frombuffer(cell[i].as_buffer(), np.uint32).astype(kind) for i in mine]
        out.append((np.concatenate([np.zeros(0, kind), *at]),
                    np.concatenate([np.zeros(0, np.int8), *(np.frombuffer(odds[i].as_buffer(), np.int8) for i in mine)])))
    return out


def _tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words, and for each text the index of its first (n + 1)."""
    keys, first = [np.zeros(0, U)], [np.zeros(1, np.int64)]
    done = 0
    for _, _, part in texts.slices(1 << 21):
        part = part.lower()
        starts, ends, at = part.words()
        keys.append(part.hashes(starts, ends))
        first.append(at[1:] + done)
        done += len(starts)
    return np.concatenate(keys), np.concatenate(first)


def _block_keys(texts: Texts, learn: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys (words and the end), counts in training texts, place of each word, first words."""
    words, first = _tokens(texts)
    keys, place = np.unique(np.append(words, END_KEY), return_inverse=True)
    known = np.append(np.repeat(learn, np.diff(first)), False)
    counts = np.bincount(place[known], minlength=len(keys))
    counts[place[-1]] += int(learn.sum())
    return keys, counts, place, first


def scores(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text",
           block_bytes: int = lookups.BLOCK_BYTES) -> DataFrame:
    """key, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for every row; learns where ``learn``.

    Tokens are the lower-cased words and one end per text; the base score is the sum of
    log10((c + 1) / (N + V + 1)).
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"),
                       F.coalesce(learn, F.lit(True)).alias("learn"))
    size = text_bytes(rows)
    bits = bits_for(size)
    low = min(bits, PART_BITS) + 8  # bits of a cell inside its shard
    whole_tables = bits <= WHOLE_BITS
    mixer = train(rows, F.col("learn"), size=size, orders=ORDERS if whole_tables else 1)
    n = parts_for(size, block_bytes)
    blocked = lookups.dealt(rows, n, "key", "text")

    def keys_of(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        learned = group.column("learn").to_numpy()
        return _block_keys(lookups.texts_of(group), learned)[:2]

    answered = materialize(lookups.answers(lookups.asks(blocked, keys_of, n)), "counts")
    whole = answered.agg(F.sum("all_count").alias("n"), F.sum("all_keys").alias("v")).first()
    tokens, kinds = whole["n"] or 0, whole["v"] or 0
    below = math.log10(tokens + kinds + 1)
    none = F.lit(None).cast("binary").alias("odds")
    got = answered.select("block", F.lit(0).alias("order"), "shard", F.col("totals").alias("cells"), none)
    if not whole_tables:
        got = got.unionByName(fetched(blocked, bits, low, (mixer.length, mixer.nodes, mixer.turns)))
    held = rows.sparkSession.sparkContext.broadcast(mixer)

    def finish(group: pa.Table, answer: pa.Table) -> pa.Table:
        texts = lookups.texts_of(group)
        _, _, place, first = _block_keys(texts, np.zeros(len(texts), bool))
        words = answer.filter(pa.compute.equal(answer.column("order"), 0)).rename_columns({"cells": "totals"})
        total = lookups.totals_of(words)
        worth, known = np.log10(total + 1)[place], (total > 0)[place]
        size = np.diff(first) + 1
        added = np.concatenate([[0], np.cumsum(worth[:-1])])[first]
        seen = np.concatenate([[0], np.cumsum(known[:-1])])[first]
        model = held.value if whole_tables else FetchedMixer(held.value, _answers_of(answer, bits, low))
        score = model.log10(texts)
        length = np.diff(texts.offsets)
        rate = np.where(length > 0, -score * math.log2(10) / np.maximum(length, 1), np.nan)
        return pa.Table.from_arrays(
            [group.column("key").combine_chunks(), pa.array(size), pa.array(np.diff(seen) + int(known[-1])),
             pa.array(np.full(len(texts), tokens)), pa.array(np.diff(added) + worth[-1] - size * below),
             pa.array(score), pa.array(rate, from_pandas=True)],
            names=["key", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"])

    return blocked.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(
        finish, f"key {kind}, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, "
                "bits_per_byte double").withColumnRenamed("key", key)
