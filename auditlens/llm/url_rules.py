"""URL rules indexed by their rarest literal token (operator 7).

Method: a rule is a host and the start of a path. It is filed under the one
of its whole tokens (runs of letters, digits, ``_`` and ``%`` with a
delimiter on both sides) that fewest URLs hold. The tokens of a URL fetch the
rules filed under them, and only those run their regular expression; of the
rules that fit, the longest decides.

The rules are configuration and come as a list, so the index is a literal
map in the plan, and judging is one expression per row: no join, no
shuffle, no Python. One aggregate over the URLs counts the tokens that
rules have.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = r"[\p{L}\p{N}_%]+"


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def pattern(self) -> str:
        """Regular expression over host + path (the path of a rule begins with a slash, which no host holds)."""
        return rf"^(?:[^/]*\.)?{java(self.host)}{java(self.path)}"

    def tokens(self) -> list[str]:
        """Tokens that every URL that the rule fits holds as whole tokens."""
        found = re.finditer(r"[\w%]+", self.text)
        return sorted({m[0] for m in found if m.end() < len(self.text)})


def java(text: str) -> str:
    return re.sub(r"([^\w/ ])", r"\\\1", text)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"({_TOKEN})"), F.lit(1)))


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow", url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (text of the rule that decides, else null) and verdict.

    Null URLs and those without ``://`` have an empty host and path, which no
    rule fits; without a rule the verdict is ``default``. Of fitting rules the
    longest wins, of equally long ones the first in order of text and verdict.
    Every row stays, repeated ones too; columns of the added names are
    replaced (``url`` itself may not be one of them).
    """
    if any(not r.path.startswith("/") or not r.host for r in rules):
        raise ValueError("a rule needs a host, and a path that begins with /")
    named = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    if not rules:
        return named.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})
    wanted = sorted({t for r in rules for t in r.tokens()})
    seen = tokens_of(F.concat("host", "path"))
    counts = {}
    if wanted:
        held = named.select(F.array_intersect(seen, F.array(*map(F.lit, wanted))).alias("t"))
        counts = {r["t"]: r["n"] for r in held.select(F.explode("t").alias("t")).groupBy("t").agg(
            F.count("*").alias("n")).collect()}  # at most one row per token of a rule
    index: dict[str, list[Rule]] = {}
    for rule in rules:
        own = rule.tokens()
        index.setdefault(min(own, key=lambda t: (counts.get(t, 0), t)) if own else "", []).append(rule)
    kind = "array<struct<size: int, text: string, verdict: string, pattern: string>>"
    lists = [F.array(*(F.struct(F.lit(-len(r.text)).alias("size"), F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"),
                                F.lit(r.pattern).alias("pattern")) for r in own)).cast(kind) for own in index.values()]
    filed = F.map_from_arrays(F.array(*map(F.lit, index)), F.array(*lists))
    everywhere = [""] if "" in index else []
    keys = F.array_intersect(F.concat(seen, F.array(*map(F.lit, everywhere)).cast("array<string>")), F.array(*map(F.lit, index)))
    fetched = F.flatten(F.transform(keys, lambda t: F.element_at(filed, t)))
    whole = F.concat("host", "path")
    best = F.array_min(F.filter(fetched, lambda r: F.rlike(whole, r["pattern"])))
    name = "_best"
    while name in named.columns:
        name += "_"
    return named.withColumn(name, best).withColumns(
        {"rule": F.col(f"{name}.text"), "verdict": F.coalesce(F.col(f"{name}.verdict"), F.lit(default))}).drop(name)


ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, position('://' IN coalesce(url, '')) AS p FROM pages
), s AS (
  SELECT page_id, CASE WHEN p > 0 THEN substr(url, p + 3) ELSE '' END AS rest FROM u
), h AS (
  SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM s
), n AS (
  SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h
), r(verdict, rhost, rpath) AS (
  VALUES {rules}
), f AS (
  SELECT n.page_id, n.host, n.path, r.rhost || r.rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY n.page_id ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS k
  FROM n LEFT JOIN r ON (n.host = r.rhost OR ends_with(n.host, '.' || r.rhost)) AND starts_with(n.path, r.rpath)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE k = 1
"""


def oracle(rules: Sequence[Rule]) -> str:
    return ORACLE_SQL.format(rules=", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in rules))
