"""Mixing to target weights over learned domains, in DataFrame operations only.

The domains are the label combinations of a table of labelled documents. A logistic classifier, fitted to a bounded
sample of it, gives every document a posterior over the domains. Nonnegative rates per document then make the expected
tokens of each domain, ``sum(rate * tokens * posterior)``, match the targets: projected gradients from rate 1 minimise
the squared differences (as shares of all tokens). A document's rate depends on its own posterior and on one vector per
step, so a step is one aggregation over all documents and a rate is a fold over the steps so far.
A rate becomes whole copies by a hash of key and text: ``floor(rate)`` and one more for the share of them that the
fraction names. Rows that repeat key and text are sampled systematically along their number: their copies sum up to
their rates, but for less than one.

Only built-in expressions run: no Python on the executors. Null texts count as empty. Without labels there is one
domain, and every rate is 1. Targets name domains; those not named keep their share, all are scaled to sum 1. Rows with
a null key take part and get a rate; rows that repeat a key each get the rate of their own text. An empty table gives
an empty result. Columns other than key and text are not touched.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tables import materialize

#: Bounds of the fitted sample and of the vocabulary.
SAMPLE_ROWS, VOCABULARY = 20_000, 200
#: Documents of the common kind that each domain is thought to hold besides its own.
SHRINK = 8.0
#: A feature's share in some domain is at least this many times the common share, or that much less.
LEAST_RATIO = 1.6
#: Descent: steps, momentum and pull of the weights towards 0.
STEPS, MOMENTUM, DECAY = 25, 0.9, 1.0
#: Rows of one run of neighbours, as a power of 2.
RUN_BITS = 10
_SEPARATOR, _BETWEEN = "[\\t-\\r]", "[\\t-\\r.,;:!?]"


def _level(name: str, share: Column, bounds: list[float]) -> Column:
    """A feature word for the band that a share falls into."""
    band = sum((F.when(share > b, 1).otherwise(0) for b in bounds), F.lit(0))
    return F.concat(F.lit(f"\x01{name}"), band.cast("string"))


def described(docs: DataFrame, text: str) -> DataFrame:
    """``row`` (the whole row), ``tokens`` (number of words) and ``found``: its features.

    Features are the different lower-cased words without their punctuation and bands of what the text is made of. Each
    step is a column of its own, so that no expression is worked out twice.
    """
    rows = docs.select(F.struct("*").alias("row")).select("row", F.coalesce(F.col(f"row.`{text}`"), F.lit("")).alias("body"))
    # Patterns of single characters and splits at a space: both are cheap on long texts.
    plain = F.regexp_replace("body", _SEPARATOR, " ")
    folded = F.regexp_replace(F.lower("body"), _BETWEEN, " ")
    rows = rows.select("row", "body", F.size(F.array_remove(F.split(plain, " "), "")).alias("tokens"),
                       F.array_distinct(F.array_remove(F.split(folded, " "), "")).alias("kinds"))
    size = F.greatest(F.length("body"), F.lit(1))
    upper = F.regexp_count("body", F.lit("[A-Z]"))
    signs = F.regexp_count("body", F.lit("[#*$%&|<>!]"))
    bands = F.array(
        _level("upper", upper / size, [0.05, 0.3]), _level("sign", signs / size, [0.005, 0.05]),
        _level("kinds", F.size("kinds") / F.greatest(F.col("tokens"), F.lit(1)), [0.1, 0.2, 0.35]),
        _level("words", F.col("tokens"), [10, 100, 1000]))
    return rows.select("row", F.col("tokens").cast("long").alias("tokens"), F.concat("kinds", bands).alias("found"))


@dataclass
class Domains:
    """Names, and the weights of the base and of the known features, per domain."""

    names: list[str] = field(default_factory=lambda: ["all"])
    base: list[float] = field(default_factory=lambda: [0.0])
    weight: dict[str, list[float]] = field(default_factory=dict)

    def posterior(self, rows: DataFrame) -> DataFrame:
        """``row``, ``tokens`` and ``posterior``: array<double> over ``names``, from the column ``found``."""
        if len(self.names) == 1:
            return rows.select("row", "tokens", F.array(F.lit(1.0)).alias("posterior"))
        table = F.create_map(*[x for w, v in (self.weight or {"": self.base}).items()
                               for x in (F.lit(w), F.array(*map(F.lit, v)))])
        logs = F.aggregate("known", F.array(*map(F.lit, self.base)),
                           lambda a, w: F.zip_with(a, F.element_at(table, w), lambda x, y: x + y))
        rows = rows.select("row", "tokens", F.array_intersect("found", F.array(*map(F.lit, self.weight or [""]))).alias("known"))
        rows = rows.select("row", "tokens", logs.alias("logs"))
        rows = rows.select("row", "tokens", F.transform(
            "logs", lambda x: F.exp(x - F.array_max("logs"))).alias("odds"))
        whole = F.aggregate("odds", F.lit(0.0), lambda a, b: a + b)
        return rows.select("row", "tokens", "odds", whole.alias("whole")).select(
            "row", "tokens", F.transform("odds", lambda x: x / F.col("whole")).alias("posterior"))


def fit(docs: DataFrame, labels: DataFrame, names: list[str], key: str = "doc_id", text: str = "text",
        sample: int = SAMPLE_ROWS, vocabulary: int = VOCABULARY) -> Domains:
    """Classifier of the combinations of the label columns ``names``: logistic regression on the features.

    The sample holds the ``sample`` first label rows in hash order of the key. A feature is known if it is among the
    ``vocabulary`` that tell the domains apart best. Each of ``STEPS`` steps of descent is one aggregation over the
    sample; a step is scaled by a bound of the curvature, so that it never overshoots, and has momentum.
    """
    whole = F.concat_ws(",", *[F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in names])
    some = labels.filter(F.col(key).isNotNull()).select(F.col(key), whole.alias("domain")).filter(
        F.size(F.split("domain", ",")) == len(names)).orderBy(F.xxhash64(key), key, "domain").limit(sample)
    known = docs.select(F.col(key), F.col(text).alias("body")).join(F.broadcast(some), key)
    # Bounded by the sample: one row per document with its features.
    seen = materialize(described(known, "body").select("row.domain", "found"), "labelled")
    sizes = {r["domain"]: r["n"] for r in seen.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Domains([*sizes] or ["all"])
    order, total = sorted(sizes), sum(sizes.values())
    counts = seen.select("domain", F.explode("found").alias("word")).groupBy("word").agg(
        *[F.count_if(F.col("domain") == d).alias(str(i)) for i, d in enumerate(order)])
    # Shares shrink towards the common one, the more the smaller the domain.
    mean = (sum(F.col(str(i)) for i in range(len(order))) + 0.5) / (total + 1.0)
    share = [(F.col(str(i)) + SHRINK * mean) / (sizes[d] + SHRINK) for i, d in enumerate(order)]
    # How much the feature tells about the domain of a document.
    told = sum((s * F.log(s / mean) + (1 - s) * F.log((1 - s) / (1 - mean))) * sizes[d]
               for s, d in zip(share, order, strict=True))
    # Words that are near as frequent everywhere say more of a text's length than of its domain.
    far = F.greatest(*[F.abs(F.log(s / mean)) for s in share], F.lit(0.0))
    often = sum(F.col(str(i)) for i in range(len(order))) >= 5
    best = counts.filter(often & (far > math.log(LEAST_RATIO))).orderBy(F.desc(told), "word").limit(
        vocabulary).select("word")
    words = [r["word"] for r in best.collect()]
    listed = F.array(*map(F.lit, words)) if words else F.array().cast("array<string>")
    places = F.transform(F.array_intersect("found", listed), lambda w: F.array_position(listed, w).cast("int"))
    rows = materialize(seen.select(F.array_position(F.array(*map(F.lit, order)), F.col("domain")).alias("domain"),
                                   F.concat(F.array(F.lit(0)), places).alias("places")).coalesce(8), "places")
    n = len(order)
    weight, speed = np.zeros((len(words) + 1, n)), np.zeros((len(words) + 1, n))
    weight[0] = [math.log(sizes[d] / total) for d in order]
    for _ in range(STEPS):
        table = F.array(*[F.array(*map(F.lit, w)) for w in (weight + MOMENTUM * speed).tolist()])
        logs = F.aggregate("places", F.array(*[F.lit(0.0)] * n), lambda a, i: F.zip_with(
            a, F.get(table, i), lambda x, y: x + y))
        scored = rows.select("domain", "places", logs.alias("logs")).select("domain", "places", F.transform(
            "logs", lambda x: F.exp(x - F.array_max("logs"))).alias("odds"))
        scored = scored.select("domain", "odds", F.size("places").alias("many"), F.explode("places").alias("place"),
                               F.aggregate("odds", F.lit(0.0), lambda a, b: a + b).alias("whole"))
        slope = scored.groupBy("place").agg(F.sum("many").alias("many"), *[
            F.sum(F.col("odds")[k] / F.col("whole") - F.when(F.col("domain") == k + 1, 1.0).otherwise(0.0)).alias(str(k))
            for k in range(n)])
        speed *= MOMENTUM
        ahead = weight + speed
        for r in slope.collect():
            speed[r["place"]] -= (np.array([r[str(k)] for k in range(n)]) + ahead[r["place"]] * DECAY) / (
                0.5 * r["many"] + DECAY)
        weight += speed
    return Domains(order, weight[0].tolist(), dict(zip(words, weight[1:].tolist(), strict=True)))


def rate_of(posterior: Column, steps: list[list[float]]) -> Column:
    """The rate after the projected steps: each vector moves it by its product with the posterior, not under 0."""
    if not steps:
        return F.lit(1.0)

    def move(rate: Column, step: Column) -> Column:
        return F.greatest(F.lit(0.0), rate + F.aggregate(
            F.zip_with(posterior, step, lambda p, s: p * s), F.lit(0.0), lambda a, b: a + b))

    return F.aggregate(F.array(*[F.array(*map(F.lit, s)) for s in steps]), F.lit(1.0), move)


def solve(weights: DataFrame, names: list[str], targets: dict[str, float], most: int = 30,
          close: float = 1e-4) -> tuple[list[list[float]], list[float], list[float]]:
    """Steps whose rates bring each domain's share of the tokens within ``close`` of its target; shares; targets.

    ``weights`` holds ``tokens`` and ``posterior``. The gradient of the squared differences, each document's rate
    weighed by its tokens, is the posterior times the differences; it is scaled by the matrix of the expected tokens
    of two domains over the documents whose rate is not 0, and shortened while it makes no progress.
    """
    n = len(names)
    p = [F.col("posterior")[i] for i in range(n)]
    total = weights.agg(F.sum("tokens")).first()[0] or 0
    if n < 2 or not total:
        return [], [1.0] * n, [1.0] * n

    def look(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray]:
        rate, part = F.col("rate"), F.col("tokens") / float(total)
        row = weights.withColumn("rate", rate_of(F.col("posterior"), steps)).agg(
            *[F.sum(rate * part * a) for a in p],
            *[F.sum(F.when(rate > 0, part * a * b).otherwise(0.0)) for a in p for b in p]).first()
        return np.array(row[:n]), np.array(row[n:]).reshape(n, n)

    steps: list[list[float]] = []
    now, matrix = look(steps)
    wanted = np.array([max(targets.get(d, s), 0.0) for d, s in zip(names, now, strict=True)])
    wanted /= wanted.sum()
    pace = 1.0
    for _ in range(most):
        miss = wanted - now
        if np.abs(miss).max() < close or pace < 1e-3:
            break
        step = np.linalg.solve(matrix + 1e-9 * np.eye(n), miss) * pace
        after, its_matrix = look([*steps, step.tolist()])
        if np.abs(wanted - after).sum() < np.abs(miss).sum():
            steps.append(step.tolist())
            now, matrix, pace = after, its_matrix, min(1.0, 2 * pace)
        else:
            pace /= 2
    return steps, now.tolist(), wanted.tolist()


def with_rates(docs: DataFrame, labels: DataFrame, names: list[str], targets: dict[str, float], key: str,
               text: str, keep: list[str]) -> tuple[DataFrame, list[str]]:
    """``row`` (the columns ``keep`` of ``docs``), ``tokens``, ``posterior``, ``rate`` and ``copies``; and the domains' names.

    Posteriors are worked out once, in one pass over the texts.
    """
    domains = fit(docs, labels, names, key, text)
    scored = materialize(domains.posterior(described(docs, text)).select(
        F.struct(*[F.col(f"row.`{c}`").alias(c) for c in keep]).alias("row"), "tokens", "posterior",
        F.xxhash64(F.col(f"row.`{key}`"), F.col(f"row.`{text}`"), F.lit("copies")).alias("mark"),
        F.monotonically_increasing_id().alias("at")), "posteriors")
    steps, _, _ = solve(scored.select("tokens", "posterior"), domains.names, targets)
    rated = numbered(scored).withColumn("rate", rate_of(F.col("posterior"), steps))
    return rated.withColumn("copies", copies(F.col("rate"), F.col("mark"), F.col("nth"))), domains.names


def rates(docs: DataFrame, labels: DataFrame, names: list[str], targets: dict[str, float], key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """key, tokens, posterior (map of domain to share), rate and copies for every row of ``docs``."""
    found, domains = with_rates(docs, labels, names, targets, key, text, [key])
    return found.select(
        F.col(f"row.`{key}`").alias(key), "tokens",
        F.map_from_arrays(F.array(*map(F.lit, domains)), "posterior").alias("posterior"), "rate",
        "copies")


def mixed(docs: DataFrame, labels: DataFrame, names: list[str], targets: dict[str, float], key: str = "doc_id",
          text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, each as often as its copies."""
    found, _ = with_rates(docs, labels, names, targets, key, text, docs.columns)
    many = found.select("row", F.explode(F.sequence(F.lit(0), "copies")).alias("nth")).filter("nth > 0")
    return many.select("row.*")


def numbered(scored: DataFrame) -> DataFrame:
    """``nth``: the number from 1 of each row among those of its ``mark``, by ``at``.

    Rows of a mark are numbered in runs of at most ``2 ** RUN_BITS`` neighbours, so a hot mark is dealt out; a second sum
    over one row per run gives the number that a run starts from. Without repeated marks nothing is dealt.
    """
    if scored.groupBy("mark").count().filter("count > 1").isEmpty():
        return scored.withColumn("nth", F.lit(1).cast("long"))
    rows = scored.withColumn("run", F.shiftright("at", RUN_BITS))
    earlier = Window.partitionBy("mark").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("mark", "run").agg(F.count("*").alias("n")).select(
        "mark", "run", F.sum("n").over(earlier).alias("before")).filter("before > 0")
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("mark", "run").orderBy("at")).cast("long"))
    return rows.join(starts, ["mark", "run"], "left").withColumn(
        "nth", F.col("nth") + F.coalesce("before", F.lit(0).cast("long"))).drop("run", "before")


def copies(rate: Column, mark: Column, nth: Column) -> Column:
    """Whole copies: the rate rounded down or up by a hash, so that the first n of a mark have n rates, rounded."""
    draw = mark.bitwiseAND(F.lit((1 << 52) - 1)) / float(1 << 52)
    whole = F.floor(rate)
    return (whole + F.floor(nth * (rate - whole) + draw) - F.floor((nth - 1) * (rate - whole) + draw)).cast("int")
