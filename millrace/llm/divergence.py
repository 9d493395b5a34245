"""How far the sources of a language lie from each other, and the words that set each of them apart.

Terms are runs of ASCII letters and characters beyond ASCII (``A-Z`` lower-cased). A language keeps the terms of at least
``least_docs`` of its documents (V of them). Every group of a language and a source, and every language, gives each kept
term the weight ``1 + floor(SCALE * (count + 2) / (N + 2 * V))``; N is its sum of counts over kept terms. Two weights p
and q differ by ``floor((p - q)^2 / (p + q))``. All of it is exact integer arithmetic.

* ``pair``: each other source of the language by the sum of differences over all kept terms. Blocks of terms meet tiles
  of sources; a task holds at most about ``BLOCK`` terms of two tiles of ``TILE`` sources and gives back their sums.
* ``term``: the terms that a group uses more than its language, by their difference, the first ``top``. A term cannot be
  among them if ``top`` others have no lower count in the group, no higher count in the language and come earlier in
  UTF-8. Partitions keep only terms dominated by fewer than ``top`` others (a skyband), the skybands of a group are
  merged by the same rule, and only what is left is ranked. Rows come sorted, dominators first, so a task holds the
  skyband of one group at a time and reads the rest as a stream.

Null text, language and source count as ''. Groups without terms take part in pairs with the weight of no
occurrence. Repeated rows are documents of their own; ties go to the item earlier in UTF-8; an empty table gives an
empty result. Columns beside the three that are named are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import materialize
from millrace.llm.texts import binary

SCALE = 1_000_000_000
TILE, BLOCK = 64, 4096
#: Distinct terms that a task holds before it hands them on.
HELD = 1 << 19
#: Bytes of a text that are cut into terms at once, and what is outside terms as a blank, ``A-Z`` lower-cased.
PIECE = 1 << 18
_FOLD = bytes(b if b > 127 else b | 32 if chr(b).isalpha() else 32 for b in range(256))
_CHUNK = 512


def _strings(column: pa.Array) -> list[str]:
    return ["" if v is None else v for v in column.to_pylist()]


def terms_of(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, some pieces of whole terms after each other."""
    folded, at = raw.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def counted(docs: DataFrame) -> DataFrame:
    """lang, source, term, count, docs: sums of parts of the rows of ``docs`` (lang, source, text)."""

    def rows_of(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (count, seen) in held.items():
            for terms in batched(count, 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(lang, pa.string()), len(terms)), pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                     binary(terms).view(pa.string()), *(pa.array(np.fromiter(map(n.__getitem__, terms), np.int64, len(terms)))
                                                        for n in (count, seen))],
                    names=["lang", "source", "term", "count", "docs"])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(_strings(batch.column(0)), _strings(batch.column(1)), batch.column(2),
                                          strict=True):
                raw = text.as_buffer()
                if not raw:
                    continue
                count, seen = held.setdefault((lang, source), (Counter(), Counter()))
                before, once = len(count), set()
                for terms in terms_of(raw.to_pybytes()):
                    count.update(terms)
                    once.update(terms)
                seen.update(once)
                size += len(count) - before
                if size > HELD:
                    yield from rows_of(held)
                    held, size = {}, 0
        yield from rows_of(held)

    return docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        rows, "lang string, source string, term string, count bigint, docs bigint")


def kept_terms(docs: DataFrame, least_docs: int) -> DataFrame:
    """lang, source, term, count, lang_count, first (true in one row of each term of a language): kept terms."""
    # One shuffle serves both the sums of a group and those of its language.
    sums = counted(docs).repartition("lang", "term").groupBy("lang", "source", "term").agg(
        F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    return sums.select(
        "lang", "source", "term", "count", F.sum("docs").over(term).alias("docs"),
        F.sum("count").over(term).alias("lang_count"), (F.min("source").over(term) == F.col("source")).alias("first"),
    ).filter(F.col("docs") >= least_docs).drop("docs")


def group_totals(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, n, lang_n, terms, sources for every group that occurs, terms or not."""
    sums = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count_if("first").alias("firsts"))
    groups = docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").na.fill(0)
    langs = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("firsts").alias("terms"),
                                       F.count("*").alias("sources"))
    return groups.drop("firsts").join(langs, "lang")


# Pairs of sources -----------------------------------------------------------------------------------------------------

def weights(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / total), by long division in steps that stay within 64 bits."""
    whole, rest = np.divmod(count + 2, total)
    for _ in range(3):
        more, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + more
    return whole + 1


def _block_sums(block: pa.Table) -> pa.Table:
    """lang, a, b, value: the differences of each pair of sources, a from the lower tile, over the terms of one block.

    Rows without term name the sources of both tiles with their totals; their count is the number of the block's terms.
    Terms that occur in neither tile are no rows, but the sources' totals set them apart as well.
    """
    named = block.filter(pc.is_null(block.column("term")))
    cells = block.filter(pc.is_valid(block.column("term")))
    names = named.column("source").to_pylist()
    place = {name: i for i, name in enumerate(names)}
    tiles = named.column("tile").to_numpy()
    term = cells.column("term").combine_chunks().dictionary_encode()
    counts = np.zeros((len(term.dictionary), len(names)), np.int64)
    source = np.fromiter((place[s] for s in cells.column("source").to_pylist()), np.int64, len(cells))
    counts[term.indices.to_numpy(), source] = cells.column("count").to_numpy()
    total = named.column("total").to_numpy()
    p = weights(counts, total[None, :])
    absent, bare = named.column("count")[0].as_py() - len(counts), weights(np.zeros(len(names), np.int64), total)
    low, high = block.column("low")[0].as_py(), block.column("high")[0].as_py()
    out = []
    for i, name in enumerate(names):
        others = [j for j in range(len(names)) if tiles[i] == low and tiles[j] == high and (low < high or name < names[j])]
        if others:
            gap, both = p[:, i: i + 1] - p[:, others], p[:, i: i + 1] + p[:, others]
            rest = (bare[i] - bare[others]) ** 2 // (bare[i] + bare[others]) * absent
            out += [(name, names[j], int(v)) for j, v in zip(others, (gap * gap // both).sum(0) + rest, strict=True)]
    return pa.Table.from_arrays(
        [pa.array([block.column("lang")[0].as_py()] * len(out), pa.string()), pa.array([r[0] for r in out], pa.string()),
         pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.int64())],
        names=["lang", "a", "b", "value"])


def pair_sums(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value: the distance of each two sources of a language, in both directions."""
    tiles = F.ceil(F.col("sources") / TILE).cast("int")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("terms") / BLOCK)).cast("int")
    langs = groups.groupBy("lang").agg(F.first(tiles).alias("tiles"), F.first(blocks).alias("blocks"))
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")

    def met(rows: DataFrame) -> DataFrame:
        """Each row once for every tile that its own one meets."""
        return rows.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
            "lang", "source", "term", "count", "total", "block", "tile", F.least("tile", "other").alias("low"),
            F.greatest("tile", "other").alias("high"))

    cells = kept.join(langs, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int"))
    sizes = cells.filter("first").groupBy("lang", "block").agg(F.count("*").alias("count"))
    names = groups.join(langs, "lang").select(
        "lang", "source", "tiles", F.lit(None).cast("string").alias("term"),
        (F.col("n") + 2 * F.col("terms")).alias("total"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    ).join(sizes, ["lang", "block"], "left").na.fill(0, ["count"])
    sums = met(cells.withColumn("total", F.lit(0).cast("bigint"))).unionByName(met(names)).groupBy(
        "lang", "low", "high", "block").applyInArrow(_block_sums, "lang string, a string, b string, value bigint")
    whole = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                             F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    return whole.select("lang", ways.alias("way"), "value").select("lang", "way.source", "way.item", "value")


# Terms that set a group apart -----------------------------------------------------------------------------------------

class Skyband:
    """Terms of one group dominated by fewer than ``k`` others; they come by count, highest first, then language count,
    lowest first, then UTF-8, so that dominators come before what they dominate."""

    def __init__(self, k: int):
        self.k, self.lang_counts, self.terms = k, np.zeros(0, np.int64), []

    def add(self, lang_counts: np.ndarray, terms: list[bytes]) -> np.ndarray:
        """Which of the next terms stay. Dominance is transitive: the terms kept are enough to count ``k``."""
        had = len(self.terms)
        order = pc.array_sort_indices(pa.array(self.terms + terms, pa.binary())).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        mine, theirs = place[:had], place[had:]
        above = ((self.lang_counts[None, :] <= lang_counts[:, None]) & (mine[None, :] < theirs[:, None])).sum(1)
        stay, new_counts, new_places = np.zeros(len(terms), bool), [], []
        for i in np.flatnonzero(above < self.k):
            more = 0
            if new_counts:
                more = int(((np.array(new_counts) <= lang_counts[i]) & (np.array(new_places) < theirs[i])).sum())
            if above[i] + more < self.k:
                stay[i] = True
                new_counts.append(lang_counts[i])
                new_places.append(theirs[i])
        self.lang_counts = np.append(self.lang_counts, lang_counts[stay])
        self.terms += [t for t, s in zip(terms, stay, strict=True) if s]
        return stay


def skybands(rows: DataFrame, k: int) -> DataFrame:
    """The rows that each partition's skyband of their group keeps."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, band = None, Skyband(k)
        for batch in batches:
            names = pa.StructArray.from_arrays([batch.column(0), batch.column(1)], ["lang", "source"])
            runs = pc.run_end_encode(batch.column(1)).run_ends.to_numpy()
            edges = np.union1d(runs, pc.run_end_encode(batch.column(0)).run_ends.to_numpy())
            counts = batch.column(4).to_numpy()
            stay, at = np.zeros(len(batch), bool), 0
            for end in edges.tolist():
                if (here := names[at].as_py()) != group:
                    group, band = here, Skyband(k)
                terms = batch.column(2).slice(at, end - at).cast(pa.binary()).to_pylist()
                for a in range(0, end - at, _CHUNK):
                    stay[at + a: min(end, at + a + _CHUNK)] = band.add(
                        counts[at + a: min(end, at + a + _CHUNK)], terms[a: a + _CHUNK])
                at = end
            yield batch.filter(pa.array(stay))

    ordered = rows.select("lang", "source", "term", "count", "lang_count").sortWithinPartitions(
        "lang", "source", F.desc("count"), "lang_count", "term")
    return ordered.mapInArrow(keep, ordered.schema)


def _weight(count: str, total: str) -> Column:
    """As ``weights``, in exact decimals."""
    return F.expr(f"(cast({count} as decimal(20,0)) + 2) * {SCALE}BD div cast({total} as decimal(20,0)) + 1")


def top_terms(kept: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """lang, source, item, value, rank: the terms that set a group apart most."""
    local = skybands(kept, top)
    merged = skybands(local.repartition("lang", "source"), top)
    valued = merged.join(groups, ["lang", "source"]).withColumn("total", F.expr("n + 2 * terms")).withColumn(
        "lang_total", F.expr("lang_n + 2 * terms")).select(
        "lang", "source", F.col("term").alias("item"), _weight("count", "total").alias("p"),
        _weight("lang_count", "lang_total").alias("q")).filter("p > q")
    return _ranked(valued.select("lang", "source", "item", F.expr("(p - q) * (p - q) div (p + q)").alias("value"))).filter(
        F.col("rank") <= top)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def divergence(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 10,
               top: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: both parts for every group of a language and a source."""
    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(to)
                          for c, to in ((lang, "lang"), (source, "source"), (text, "text"))))
    kept = materialize(kept_terms(plain, least_docs), "terms")
    groups = materialize(group_totals(plain, kept), "groups")
    parts = [("pair", _ranked(pair_sums(kept, groups))), ("term", top_terms(kept, groups, top))]
    pair, term = (rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, rows in parts)
    return pair.unionByName(term)


SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS line, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[a-z\\x{80}-\\x{10FFFF}]+') AS t
  FROM documents
), words AS (
  SELECT line, lang, source, unnest(t) AS term FROM docs
), kept AS (
  SELECT lang, term, CAST(count(*) AS HUGEINT) AS c FROM words GROUP BY lang, term HAVING count(DISTINCT line) >= 10
), found AS (
  SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY lang
), groups AS (
  SELECT g.lang, g.source, coalesce(sum(f.c), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM docs) g LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source
  GROUP BY g.lang, g.source
), weights AS (
  SELECT g.lang, g.source, k.term, coalesce(f.c, 0) AS c,
    1 + 1000000000 * (coalesce(f.c, 0) + 2) // (g.n + 2 * s.v) AS p, 1 + 1000000000 * (k.c + 2) // (s.n + 2 * s.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang)
    LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    (SELECT coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) FROM weights x JOIN weights y USING (lang, term)
     WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM weights WHERE c > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank FROM ranked
WHERE part = 'pair' OR place <= 10
"""
