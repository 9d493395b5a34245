"""URL filter: host and path rules, and a weighted vocabulary for the addresses that no rule settles.

The host is what stands between the first ``://`` and the next ``/``, ``?`` or ``#`` (``A-Z`` lower-cased), the path
what follows up to ``?`` or ``#``. A rule holds for its host and every subdomain if the path starts with the rule's; the
longest rule wins, of equal ones that with the longer host.

Otherwise an Aho-Corasick automaton runs once over the whole address. A term counts if it is no part of a longer word:
no letter, digit or character beyond ASCII stands beside it. One strict term blocks, or ``several`` different soft ones:
a strict term weighs ``several``, a soft one 1, each counted once.

An address that is null or holds no ``://`` has an empty host and path and no rule; its words still count. Null
addresses are allowed. Repeated rows are judged one by one; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = str.maketrans(UPPER, LOWER)
ADDRESS = "(?s)^.*?://([^/?#]*)([^?#]*)"

#: (host, path, verdict)
Rule = tuple[str, str, str]


@dataclass(frozen=True)
class Vocabulary:
    """Lower-case terms; ``several`` different soft ones count as much as a strict one."""

    strict: tuple[str, ...]
    soft: tuple[str, ...]
    several: int = 2

    @property
    def weights(self) -> dict[str, int]:
        return dict.fromkeys(self.soft, 1) | dict.fromkeys(self.strict, self.several)


#: Words of adult, gambling and spam sites; soft ones are harmless alone.
VOCABULARY = Vocabulary(
    strict=("adult", "casino", "hentai", "malware", "phishing", "poker", "porn", "sex", "spam", "viagra", "xxx"),
    soft=("ads", "bet", "bets", "bonus", "cheap", "click", "coupon", "deal", "escort", "farm", "free", "loan", "pills",
          "popup", "track", "tracker", "win", "x"),
)


@lru_cache(maxsize=8)
def automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for term, weight in vocabulary.weights.items():
        built.add_word(term, (term, len(term), weight))
    if len(built):
        built.make_automaton()
    return built


def _inner(c: str) -> bool:
    """A character that makes a term beside it part of a longer word."""
    return c > "\x7f" or c.isalnum()


def hits(address: str, vocabulary: Vocabulary) -> dict[str, int]:
    """Weight of each term that stands alone in an address."""
    found, low, built = {}, address.translate(_LOWERED), automaton(vocabulary)
    if len(built):
        for last, (term, size, weight) in built.iter(low):
            start, end = last + 1 - size, last + 1
            if not (start and _inner(low[start - 1])) and not (end < len(low) and _inner(low[end])):
                found[term] = weight
    return found


@lru_cache(maxsize=8)
def _by_host(rules: tuple[Rule, ...]) -> dict[str, list[tuple[str, str]]]:
    table: dict[str, list[tuple[str, str]]] = {}
    for host, path, verdict in rules:
        table.setdefault(host, []).append((path, verdict))
    return {h: sorted(ps, key=lambda p: -len(p[0])) for h, ps in table.items()}


def rule_for(host: str, path: str, rules: tuple[Rule, ...]) -> tuple[str | None, str | None]:
    """The longest rule that holds, and its verdict."""
    table, best = _by_host(rules), (-1, "", "")
    labels = host.split(".")
    for i in range(len(labels)):
        name = ".".join(labels[i:])
        fit = next(((p, v) for p, v in table.get(name, ()) if path.startswith(p)), None)
        # Longer hosts come first, so only a longer rule takes their place.
        if fit and len(name) + len(fit[0]) > best[0]:
            best = len(name) + len(fit[0]), name + fit[0], fit[1]
    return best[1:] if best[0] >= 0 else (None, None)


def filtered(pages: DataFrame, rules: Iterable[Rule], vocabulary: Vocabulary = VOCABULARY, key: str = "page_id",
             url: str = "url") -> DataFrame:
    """key, host, path, rule, verdict, weight, terms: the rule and the words that each row's address holds."""
    fixed = tuple(rules)

    @F.pandas_udf("rule string, verdict string, weight bigint, terms string")
    def judge(host: pd.Series, path: pd.Series, address: pd.Series) -> pd.DataFrame:
        out = []
        for h, p, a in zip(host, path, address, strict=True):
            rule, verdict = rule_for(h, p, fixed) if h else (None, None)
            found = hits(a, vocabulary)
            weight = sum(found.values())
            out.append((rule, verdict or ("block" if weight >= vocabulary.several else "allow"), weight,
                        ",".join(sorted(found))))
        return pd.DataFrame(out, columns=["rule", "verdict", "weight", "terms"])

    address = F.coalesce(F.col(url), F.lit(""))
    split = pages.select(F.col(key).alias("id"), address.alias("address"),
                         F.translate(F.regexp_extract(address, ADDRESS, 1), UPPER, LOWER).alias("host"),
                         F.regexp_extract(address, ADDRESS, 2).alias("path"))
    return split.select("id", "host", "path", judge("host", "path", "address").alias("j")).select(
        F.col("id").alias(key), "host", "path", "j.*")


#: The rules of the registered query.
RULES: tuple[Rule, ...] = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def _alone(term: str) -> str:
    return f"CAST(regexp_matches(u, '(^|[^a-z0-9\\x{{80}}-\\x{{10FFFF}}]){term}($|[^a-z0-9\\x{{80}}-\\x{{10FFFF}}])') AS BIGINT)"


def sql(rules: tuple[Rule, ...] = RULES, vocabulary: Vocabulary = VOCABULARY) -> str:
    """The registered query for terms made of letters and digits."""
    weights = sorted(vocabulary.weights.items())
    total = " + ".join(f"{w} * {_alone(t)}" for t, w in weights)
    names = ", ".join(f"CASE WHEN {_alone(t)} = 1 THEN '{t}' END" for t, _ in weights)
    listed = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in rules)
    return f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {listed}), split AS (
  SELECT row_number() OVER () AS line, page_id,
    translate(regexp_extract(coalesce(url, ''), '{ADDRESS}', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '{ADDRESS}', 2) AS path, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS u
  FROM pages
), fitting AS (
  SELECT line, max_by(struct_pack(rule := rule_host || rule_path, verdict := rule_verdict),
    length(rule_host || rule_path) * 1000 + length(rule_host)) AS best
  FROM split JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY line
), weighed AS (
  SELECT *, {total} AS weight, concat_ws(',', {names}) AS terms FROM split
)
SELECT page_id, host, path, best.rule AS rule,
  coalesce(best.verdict, CASE WHEN weight >= {vocabulary.several} THEN 'block' ELSE 'allow' END) AS verdict, weight, terms
FROM weighed LEFT JOIN fitting USING (line)
"""


SQL = sql()
