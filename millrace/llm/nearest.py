"""Exact nearest neighbours of a query set by a block matrix join on int8 tiles.

Vectors are packed into blocks: int8 components with a scale, the length of what rounding lost, and the originals. Each
block of candidates meets ``TOGETHER`` blocks of queries in one task, so a task holds one of them and these, and
candidates are sent once for so many blocks of queries; blocks are shuffled and never broadcast. In a tile one integer product gives all distances of the
rounded vectors; with the lost lengths it bounds each true distance from below and above. Pairs whose lower bound is
over the tile's ``k``-th upper bound are out; the others are computed in double precision from the originals. The
sorted lists of a query's tiles are merged by a heap. The result is exact, so its recall is 1.

Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without id. Vectors
of other lengths than the query's are no candidates. Rows with the query's own id are the query itself; rows that
repeat an id are candidates each. Equal distances go by smaller id. Fewer candidates than ``k`` give fewer rows; an
empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from millrace.llm.tables import parts_for
from millrace.llm.texts import binary

QUERY_BLOCK, BLOCK = 1024, 8192
TOGETHER = 16
_EXACT = 1024  # components whose int8 products a float32 sums up without rounding


def usable(vector: Column) -> Column:
    """Whether a vector takes part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & whole & F.exists(vector, lambda x: x != 0)


def _packed(rows: DataFrame, block: str, kind: type) -> DataFrame:
    """One row per block and vector length: ids, int8 components, scales, lost lengths and originals as ``kind``."""

    def pack(group: pa.Table) -> pa.Table:
        ids = group.column("id").to_numpy()
        flat = group.column("vector").combine_chunks().flatten().to_numpy()
        x = flat.reshape(len(ids), -1).astype(np.float64)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        scale = np.abs(x).max(1) / 127
        scale[scale == 0] = np.finfo(np.float64).tiny  # components too small to divide
        q = np.clip(np.rint(x / scale[:, None]), -127, 127).astype(np.int8)
        lost = np.sqrt(((x - q * scale[:, None]) ** 2).sum(1))
        return pa.Table.from_arrays(
            [group.column(block).slice(0, 1), group.column("size").slice(0, 1),
             *(binary([a.tobytes()]) for a in (ids, q, scale, lost, x.astype(kind)))],
            names=[block, "size", "ids", "q", "scale", "lost", "x"])

    return rows.groupBy(block, "size").applyInArrow(
        pack, f"{block} int, size int, ids binary, q binary, scale binary, lost binary, x binary")


def _parts(rows: pa.Table, i: int, kind: type) -> tuple[np.ndarray, ...]:
    def of(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(rows.column(name)[i].as_buffer(), kind)

    size = rows.column("size")[i].as_py()
    return (of("ids", np.int64), of("q", np.int8).reshape(-1, size), of("scale", np.float64), of("lost", np.float64),
            of("x", kind).reshape(-1, size).astype(np.float64))


def tile(queries: tuple, cands: tuple, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its id, and ids and distances of the tile's ``k`` nearest."""
    q_id, q8, q_scale, q_lost, q_x = queries
    c_id, c8, c_scale, c_lost, c_x = cands
    dot = np.zeros((len(q_id), len(c_id)))
    for at in range(0, q8.shape[1], _EXACT):
        dot += q8[:, at: at + _EXACT].astype(np.float32) @ c8[:, at: at + _EXACT].astype(np.float32).T
    def square(q: np.ndarray, scale: np.ndarray) -> np.ndarray:
        return (q.astype(np.int64) ** 2).sum(1) * scale**2

    near = square(q8, q_scale)[:, None] + square(c8, c_scale) - 2 * q_scale[:, None] * c_scale * dot
    near = np.sqrt(np.maximum(near, 0))
    # Rounding in the bounds themselves.
    slack = q_lost[:, None] + c_lost
    slack += 1e-6 * (slack + np.sqrt(square(q8, q_scale))[:, None] + np.sqrt(square(c8, c_scale)))
    own = q_id[:, None] == c_id
    high = np.where(own, np.inf, near + slack)
    limit = np.partition(high, k - 1, axis=1)[:, k - 1] if high.shape[1] > k else np.full(len(q_id), np.inf)
    alive = (near - slack <= limit[:, None]) & ~own
    for i in range(len(q_id)):
        some = np.flatnonzero(alive[i])
        total = np.zeros(len(some))
        for j in range(q_x.shape[1]):  # in order, as one would add them up by hand
            total += (q_x[i, j] - c_x[some, j]) ** 2
        distance = np.sqrt(total)
        best = np.lexsort((c_id[some], distance))[:k]
        yield int(q_id[i]), c_id[some][best], distance[best]


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, key: str = "vec_id", vector: str = "embedding",
            query_block: int = QUERY_BLOCK, block: int = BLOCK, together: int = TOGETHER) -> DataFrame:
    """query_id, rank (from 1), the key and score (Euclidean distance) of each query's ``k`` nearest rows."""
    rows = vectors.filter(usable(F.col(vector)) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), F.size(vector).alias("size"),
        F.coalesce(is_query, F.lit(False)).alias("asks"))
    count = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("asks")).first()
    n_c, n_q = parts_for(count["n"], block), parts_for(count["asks"], query_block)

    def dealt(n: int, name: str) -> Column:
        return F.pmod(F.xxhash64("id", "vector"), F.lit(n)).cast("int").alias(name)

    def every(n: int, name: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)

    # Originals as they come; a float is the same number as a double.
    kind = np.float32 if isinstance(rows.schema["vector"].dataType.elementType, FloatType) else np.float64
    queries = _packed(rows.filter("asks").select("id", "vector", "size", dealt(n_q, "qb")), "qb", kind)
    cands = _packed(rows.select("id", "vector", "size", dealt(n_c, "cb")), "cb", kind)
    asked = queries.select("*", F.floor(F.col("qb") / together).cast("int").alias("side"), every(n_c, "cb"))
    offered = cands.select("*", every(parts_for(n_q, together), "side"))

    def tiles(asked: pa.Table, offered: pa.Table) -> pa.Table:
        found = []
        if offered.num_rows:
            near = _parts(offered, 0, kind)
            for i in range(asked.num_rows):
                found += tile(_parts(asked, i, kind), near, k)
        return pa.Table.from_arrays(
            [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.list_(pa.int64())),
             pa.array([f[2] for f in found], pa.list_(pa.float64()))], names=["query_id", "ids", "scores"])

    met = ["side", "cb", "size"]
    lists = asked.groupBy(*met).cogroup(offered.groupBy(*met)).applyInArrow(
        tiles, "query_id bigint, ids array<bigint>, scores array<double>")

    def merge(group: pa.Table) -> pa.Table:
        runs = [zip(s, i, strict=True) for s, i in zip(group.column("scores").to_pylist(),
                                                       group.column("ids").to_pylist(), strict=True)]
        best = [x for _, x in zip(range(k), heapq.merge(*runs), strict=False)]
        return pa.Table.from_arrays(
            [pa.array([group.column("query_id")[0].as_py()] * len(best), pa.int64()),
             pa.array(range(1, len(best) + 1), pa.int32()), pa.array([b[1] for b in best], pa.int64()),
             pa.array([b[0] for b in best], pa.float64())], names=["query_id", "rank", "id", "score"])

    out = lists.groupBy("query_id").applyInArrow(merge, "query_id bigint, rank int, id bigint, score double")
    return out.withColumnRenamed("id", key)
