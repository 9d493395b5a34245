"""Corpus-wide counts of hashed keys, brought back to the documents that ask for them.

Documents are dealt into blocks by a hash of their key. A block asks once for each distinct key it holds; asks go to
shards by key range, so each key is summed in one place whatever its frequency, and nothing whole passes one task or
the driver. Both blocks and shards grow in number with the input and stay bounded in size.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm.tables import blocks_of
from millrace.llm.texts import Texts, U, binary

BLOCK_BYTES = 8 << 20

ASKS = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def dealt(rows: DataFrame, n: int, *columns: str) -> DataFrame:
    """Rows in ``n`` blocks by a hash of the columns, with ``block`` and the column ``text`` packed for the shuffle."""
    blocked = blocks_of(rows, n, *columns)
    place = blocked.columns.index("text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(place).cast(pa.large_binary())
            packed = binary([zlib.compress(t.as_buffer() or b"", 1) for t in raw])
            yield pa.RecordBatch.from_arrays(
                [packed if i == place else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    kinds = [f"`{f.name}` {'binary' if f.name == 'text' else f.dataType.simpleString()}" for f in blocked.schema]
    return blocked.mapInArrow(pack, ", ".join(kinds)).repartition(n, "block")


def texts_of(group: pa.Table) -> Texts:
    """The texts of a block."""
    return Texts.from_list([zlib.decompress(t.as_buffer()) for t in group.column("text")])


def by_shard(keys: np.ndarray, shards: int) -> Iterator[tuple[int, slice]]:
    """The slices of sorted keys that belong to each shard, empty ones left out."""
    shard = ((keys >> U(32)) * U(shards)) >> U(32)
    edges = np.flatnonzero(np.diff(shard, prepend=U(shards)))
    for a, b in zip(edges, np.append(edges[1:], len(keys)), strict=True):
        yield int(shard[a]), slice(a, b)


def asks(blocked: DataFrame, keys_of: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], shards: int) -> DataFrame:
    """shard, block, keys, counts. ``keys_of`` gives a block's sorted distinct keys and their counts in it."""

    def rows(group: pa.Table) -> pa.Table:
        keys, counts = keys_of(group)
        block = group.column("block")[0].as_py()
        parts = list(by_shard(keys, shards))
        return pa.Table.from_arrays(
            [pa.array([s for s, _ in parts], pa.int32()), pa.array([block] * len(parts), pa.int32()),
             binary([keys[at].tobytes() for _, at in parts]),
             binary([counts[at].astype(np.int64).tobytes() for _, at in parts])], schema=ASKS)

    return blocked.groupBy("block").applyInArrow(rows, "shard int, block int, keys binary, counts binary")


def answers(asked: DataFrame) -> DataFrame:
    """block, shard, totals: the sum over all blocks for each key asked, in the order asked.

    ``all_count`` and ``all_keys`` (on one row per shard, else 0) hold the shard's sum and its keys with a sum over 0.
    """

    def rows(group: pa.Table) -> pa.Table:
        keys = [np.frombuffer(k.as_buffer(), U) for k in group.column("keys")]
        counts = np.concatenate([np.frombuffer(c.as_buffer(), np.int64) for c in group.column("counts")])
        found, place = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(found), np.int64)
        np.add.at(total, place, counts)
        ends = np.cumsum([len(k) for k in keys])
        back = np.split(total[place], ends[:-1])
        rest = [0] * (len(keys) - 1)
        return pa.Table.from_arrays(
            [group.column("block").combine_chunks(), group.column("shard").combine_chunks(),
             binary([t.tobytes() for t in back]), pa.array([int(total.sum()), *rest], pa.int64()),
             pa.array([int((total > 0).sum()), *rest], pa.int64())],
            names=["block", "shard", "totals", "all_count", "all_keys"])

    return asked.groupBy("shard").applyInArrow(
        rows, "block int, shard int, totals binary, all_count bigint, all_keys bigint")


def totals_of(answer: pa.Table) -> np.ndarray:
    """A block's totals in the order of its sorted keys."""
    order = np.argsort(answer.column("shard").to_numpy())
    cells = answer.column("totals").combine_chunks()
    return np.concatenate([np.frombuffer(cells[int(i)].as_buffer(), np.int64) for i in order])
