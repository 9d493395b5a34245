"""Near duplicates: one-permutation MinHash with optimal densification, bands, star-shaped candidate edges.

A document's set holds the distinct ``n``-word shingles of its whole text (``A-Z`` lower-cased); a text of fewer words
has its whole sequence as one shingle; a text without words has the empty set and is linked with nothing. Two documents
are linked if their sets' Jaccard similarity is ``least`` or more; each link is confirmed on the full sets.

1. Documents with equal sets become one class; the smallest key stands for it. Nothing later sees its copies.
2. One hash of each shingle picks its bin; a bin keeps its least hash, an empty bin borrows from the first full one in
   its own random order of bins. Bands of bins are bucket keys.
3. A bucket offers each member with the bucket's smallest key: a star, not all pairs. Confirmed stars give components.
4. What no star can see, a link between two members that are both unlike the centre, is found last, in buckets that
   still hold several components: the members outside the largest meet the members of all others, in blocks of
   ``BLOCK`` members. A block pair holds the sets themselves, each once, and counts all common shingles by a matrix
   product; it gives back one link a member, not one a pair. So no candidate pair of a bucket is lost, none is built
   inside a component, and none ever becomes a row.
5. Components of all confirmed links are found by rounds of pointing to the least neighbour, each written to the shared
   folder.

Rows without key are linked with nothing and have a null component. Rows that repeat a key count as one document: what
one of them is linked with, all are. Columns other than key and text are not touched; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import materialize
from millrace.llm.texts import Texts, U, binary, sequence_hash, splitmix, windows

BANDS, ROWS = 32, 5
BINS = BANDS * ROWS
#: Members, and shingles of their sets, of one block; and shared shingles that a task counts at once.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 20
_COLUMNS = 4096
_SLICE = 1 << 21


def _tables(seed: int = 17) -> tuple[np.ndarray, np.ndarray]:
    """For each bin its own order of all bins, itself first; and the bins of each band."""
    rng = np.random.default_rng(seed)
    order = np.argsort(rng.random((BINS, BINS)), axis=1)
    order[np.arange(BINS), np.argmax(order == np.arange(BINS)[:, None], 1)] = order[:, 0]
    order[:, 0] = np.arange(BINS)
    return order, rng.permutation(BINS).reshape(BANDS, ROWS)


_ORDER, _BANDS = _tables()


def shingle_sets(texts: Texts, n: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    for _, _, part in texts.slices(_SLICE):
        part = part.lower()
        starts, ends, first = part.words()
        words = part.hashes(starts, ends)
        runs = windows(words, n)
        for i in range(len(part)):
            a, b = first[i], first[i + 1]
            if b - a >= n:
                yield np.unique(runs[a: b - n + 1])
            else:
                yield np.array([sequence_hash(words[a:b])] if b > a else [], U)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Least hash of each bin, empty bins densified; the set must not be empty."""
    hashes = np.sort(splitmix(shingles))
    edges = (np.arange(BINS, dtype=np.float64) * (2.0**64 / BINS)).astype(U)
    at = np.searchsorted(hashes, edges)
    full = at < np.append(at[1:], len(hashes))
    source = _ORDER[np.arange(BINS), full[_ORDER].argmax(1)]
    return hashes[at[source]]


def band_keys(sign: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = np.arange(BANDS, dtype=U)
        for k in range(ROWS):
            key = splitmix(key * U(0x2545F4914F6CDD1D) + sign[_BANDS[:, k]])
    return key.view(np.int64)


def _print(s: np.ndarray) -> bytes:
    """128-bit fingerprint of a set."""
    return sequence_hash(s).tobytes() + sequence_hash(splitmix(s)).tobytes()


def sketches(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """key, set size, 128-bit fingerprint of the set and its band keys (none for an empty set)."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, print_, bands = [], [], []
            for s in shingle_sets(Texts.of(batch.column(1)), n):
                size.append(len(s))
                print_.append(_print(s))
                bands.append(band_keys(signature(s)) if len(s) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), binary(print_), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "size", "print", "bands"])

    return docs.select(key, text).mapInArrow(rows, f"id {kind}, size bigint, print binary, bands array<bigint>")


def _sets_of(docs: DataFrame, wanted: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """id, shingles (packed): the sets of the wanted classes (id, print), each made from one of its texts."""
    kind = docs.schema[key].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(Texts.of(batch.column(1)), n))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), binary([_print(s) for s in sets]), binary([s.tobytes() for s in sets])],
                names=["id", "print", "shingles"])

    few = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(wanted, "id", "left_semi")
    made = few.mapInArrow(rows, f"id {kind}, print binary, shingles binary")
    # Rows that repeat a key may hold other sets, or the same set again.
    return materialize(made.join(wanted, ["id", "print"], "left_semi").dropDuplicates(["id", "print"]), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) of ids with sets that are alike: 100 * intersection >= least * union."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum())
                keep.append(100 * both >= least * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")
    return materialize(both.mapInArrow(rows, f"a {kind}, b {kind}"), "confirmed")


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """id, root: the least id reachable over the links (a, b), for each id that has a link.

    Every round each node takes the least root among its own and its neighbours', then the root of its root.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = materialize(both, "links")
    state = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("root"))
    for _ in range(rounds):
        state = materialize(state.select("id", "root"), "roots")
        near = both.join(state.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(
            F.min("root").alias("near"))
        hop = state.select(F.col("id").alias("root"), F.col("root").alias("far"))
        step = materialize(state.join(near, "id").join(hop, "root").select(
            "id", F.col("root").alias("old"), F.least("root", "near", "far").alias("root")), "roots")
        if step.filter("root <> old").isEmpty():
            return state
        state = step
    raise RuntimeError(f"components have not settled after {rounds} rounds")


def _fits(a: Column, b: Column, least: int) -> Column:
    """Sizes that allow the wanted similarity."""
    return 100 * F.least(a, b) >= least * F.greatest(a, b)


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after more links; only the roots that these touch are worked on."""
    def root_of(c: str) -> DataFrame:
        return roots.select(F.col("id").alias(c), F.col("root").alias(f"root_{c}"))

    joins = links.join(root_of("a"), "a", "left").join(root_of("b"), "b", "left").select(
        "a", "b", F.coalesce("root_a", "a").alias("x"), F.coalesce("root_b", "b").alias("y"))
    joins = materialize(joins, "joins")
    moved = components(joins.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")))
    ids = joins.select(F.col("a").alias("id"), F.col("x").alias("root")).union(joins.select("b", "y"))
    return materialize(roots.union(ids).distinct().join(
        moved.select(F.col("id").alias("root"), F.col("root").alias("to")), "root", "left").select(
        "id", F.coalesce("to", "root").alias("root")), "merged")


def _mixed(crowded: DataFrame, roots: DataFrame) -> DataFrame:
    """bucket, id, size, root, main: the members of buckets with several components, and the largest of these."""
    placed = crowded.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    kinds = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    main = kinds.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("main"),
                                       F.count("*").alias("kinds")).filter("kinds > 1").drop("kinds")
    return materialize(placed.join(main, "bucket"), "mixed")


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``left`` with those ``right``, by products of parts of their incidence."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    place = (np.cumsum(shared) - 1)[code]
    place, owner = place[shared[code]], owner[shared[code]]
    order = np.argsort(place, kind="stable")
    place, owner = place[order], owner[order]
    out = np.zeros((len(left), len(right)))
    for first in range(0, int(shared.sum()), _COLUMNS):
        at = slice(*np.searchsorted(place, [first, first + _COLUMNS]))
        holds = np.zeros((len(sets), _COLUMNS), np.float32)
        holds[owner[at], place[at] - first] = 1
        out += holds[left] @ holds[right].T
    return out.astype(np.int64)


def _new_links(members: pa.Table, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a bucket's block pair and for each the row that now stands for its component, if that is new."""
    sets = [np.frombuffer(x.as_buffer(), U) for x in members.column("shingles").combine_chunks()]
    root = members.column("root").combine_chunks().dictionary_encode().indices.to_numpy()
    block, low, high = (members.column(c).to_numpy() for c in ("block", "low", "high"))
    left, right = np.flatnonzero(block == low), np.flatnonzero((block == high) | members.column("small").to_numpy())
    size = np.array([len(x) for x in sets])
    both = _common(sets, left, right)
    alike = 100 * both >= least * (size[left][:, None] + size[right][None, :] - both)
    alike &= root[left][:, None] != root[right][None, :]
    i, j = np.nonzero(alike)
    i, j = left[i], right[j]
    # The least row that each row reaches over the links found.
    label = np.arange(len(sets))
    while len(i):
        was = label.copy()
        np.minimum.at(label, i, was[j])
        np.minimum.at(label, j, was[i])
        label = label[label]
        if (label == was).all():
            break
    rows = np.flatnonzero(label != np.arange(len(sets)))
    return rows, label[rows]


def _block_links(mixed: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """Links (a, b) between components that share a bucket, enough to join all that are linked there.

    ``mixed`` has bucket, id, size, root and main. In each bucket the members outside the largest component fill the first
    blocks, the others the rest; two blocks meet if one of them is of the first kind.
    """
    outside = F.col("root") != F.col("main")

    def blocks(n: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")

    n, shingles = F.count("*"), F.sum("size")
    counts = mixed.groupBy("bucket").agg(
        n.alias("n"), shingles.alias("shingles"), F.count_if(outside).alias("outs"),
        F.sum(F.when(outside, F.col("size")).otherwise(0)).alias("out_shingles"))
    counts = counts.select(
        "bucket", "n", "shingles", blocks(F.col("outs"), F.col("out_shingles")).alias("first"),
        blocks(F.col("n") - F.col("outs"), F.col("shingles") - F.col("out_shingles")).alias("rest"))
    # Buckets of one block of either kind share a call, so that calls are few and of like size.
    is_small = (F.col("first") <= 1) & (F.col("rest") <= 1)
    whole = counts.filter(is_small).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "shingles")]).first()
    calls = max(1, -(-whole["n"] // (2 * BLOCK)), -(-whole["shingles"] // (2 * BLOCK_SHINGLES)))
    deal = F.xxhash64("id", "bucket")
    block = F.when(outside, F.pmod(deal, F.col("first"))).otherwise(F.col("first") + F.pmod(deal, F.col("rest"))).cast("int")
    # A block of the first kind meets all blocks, one of the second only those of the first. In a small bucket the
    # block of the first kind meets the whole bucket at once.
    meets = F.when(is_small, 1).when(outside, F.col("first") + F.col("rest")).otherwise(F.col("first"))
    other = F.sequence(F.lit(0), meets.cast("int") - 1)
    call = F.when(is_small, F.pmod(F.col("bucket"), F.lit(calls))).otherwise(F.col("bucket"))
    dealt = mixed.join(counts, "bucket").select(
        "bucket", "id", "root", block.alias("block"), is_small.alias("small"), call.alias("call"), F.explode(other).alias("with"))
    met = dealt.withColumns({
        "low": F.when(F.col("small"), 0).otherwise(F.least("block", "with")),
        "high": F.when(F.col("small"), 0).otherwise(F.greatest("block", "with"))}).drop("with")
    kind = mixed.schema["id"].dataType.simpleString()

    def rows(group: pa.Table) -> pa.Table:
        group = group.sort_by("bucket")
        bucket = group.column("bucket").to_numpy()
        edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        found = []
        for a, b in zip(edges, [*edges[1:], len(group)], strict=True):
            member, by = _new_links(group.slice(a, b - a), least)
            found.append((member + a, by + a))
        member, by = (pa.array(np.concatenate(x)) for x in zip(*found, strict=True))
        ids = group.column("id")
        return pa.Table.from_arrays([ids.take(member), ids.take(by)], names=["a", "b"])

    full = met.join(sets.select("id", "shingles"), "id")
    links = full.groupBy("small", "call", "low", "high").applyInArrow(rows, f"a {kind}, b {kind}")
    return materialize(links.distinct(), "links")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, least: int = 80) -> DataFrame:
    """key, n_shingles and component (the smallest key of the group) for every row of ``docs``."""
    rows = materialize(sketches(docs, key, text, n), "sketches")
    # One class per set, named by its smallest key.
    full = rows.filter("size > 0 and id is not null")
    classes = materialize(full.groupBy("print").agg(
        F.min("id").alias("id"), F.first("size").alias("size"), F.first("bands").alias("bands")), "classes")
    member = classes.select("id", "size", F.explode("bands").alias("bucket"))
    star = member.groupBy("bucket").agg(F.count("*").alias("n"), F.min("id").alias("low"),
                                        F.min_by("size", "id").alias("low_size")).filter("n > 1").drop("n")
    crowded = materialize(member.join(star, "bucket"), "buckets")
    wanted = crowded.select("id").distinct().join(classes.select("id", "print"), "id")
    sets = _sets_of(docs, wanted, key, text, n)

    # First the star around each bucket's smallest key.
    pairs = materialize(crowded.filter((F.col("low") != F.col("id")) & _fits(F.col("low_size"), F.col("size"), least))
                        .select(*_ordered("low", "id")).distinct(), "pairs")
    # A key with several sets joins their classes.
    named = rows.select("id", "size", "print").join(classes.select("print", F.col("id").alias("class")), "print", "left")
    several = named.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("hi")).filter("a < hi")
    same_key = named.join(several, "id").filter("class <> a").select("a", F.col("class").alias("b"))
    roots = components(confirmed(pairs, sets, least).union(same_key))

    # Then, in buckets that still hold several components, what no star could see.
    mixed = _mixed(crowded.select("bucket", "id", "size"), roots)
    roots = _merged(roots, _block_links(mixed, sets, least))

    return named.join(roots.withColumnRenamed("id", "class"), "class", "left").select(
        F.col("id").alias(key), F.col("size").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("root", "class", "id")).alias("component"))


def first_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, least: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, that stand first in their group.

    Rows without key or words stay; rows that repeat a kept key stay.
    """
    member = groups(docs, key, text, n, least)
    drop = member.filter(F.col("component") != F.col(key)).select(key).distinct()
    return docs.join(drop, docs[key] == drop[key], "left_anti")
