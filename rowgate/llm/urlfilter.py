"""URL filter: listed hosts and paths first, then a weighted vocabulary matched by Aho-Corasick."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgate.llm.common import binaries

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
TERM = re.compile("[a-z0-9]([a-z0-9-]*[a-z0-9])?")


@dataclass(frozen=True)
class Vocabulary:
    """Terms of lower-case letters, digits and inner hyphens. One strict term rejects; so do soft terms whose
    weights reach ``least_weight``, each counted once, if there are ``least_soft`` of them."""

    strict: tuple[str, ...]
    soft: Mapping[str, float] = field(default_factory=dict)
    least_soft: int = 2
    least_weight: float = 2.0

    @classmethod
    def from_table(cls, terms: DataFrame, most_terms: int = 200_000, **limits: float) -> Vocabulary:
        """The vocabulary of a table of ``term`` and ``weight``; a null weight makes a term strict.

        Terms are trimmed and lower-cased. Of a term given more than once, strict goes before soft and a larger
        weight before a smaller. Null and empty terms are left out; terms of other characters, weights that are
        not above 0 and more than ``most_terms`` terms (which go to every task) are a ValueError.
        """
        named = terms.select(F.lower(F.trim(F.col("term").cast("string"))).alias("term"), F.col("weight").cast("double").alias("weight"))
        given = named.where(F.col("term") != "").groupBy("term")
        one = given.agg(F.count_if(F.col("weight").isNull()).alias("strict"), F.max("weight").alias("weight"))
        rows = one.orderBy("term").take(most_terms + 1)
        if len(rows) > most_terms:
            raise ValueError(f"more than {most_terms} terms")
        odd = [r["term"] for r in rows if not TERM.fullmatch(r["term"])]
        odd += [r["term"] for r in rows if not r["strict"] and not 0 < r["weight"] < math.inf]
        if odd:
            raise ValueError(f"terms or weights that cannot be matched: {odd[:5]}")
        soft = {r["term"]: r["weight"] for r in rows if not r["strict"]}
        return cls(tuple(r["term"] for r in rows if r["strict"]), soft, **limits)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and where ``://`` is missing."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of ``(verdict, "host/path")`` rules that fits, and its verdict; nulls if none does.

    A rule fits its host and all subdomains, if the path starts with the rule's, slash included.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


@lru_cache(maxsize=8)
def _automaton(terms: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        found.add_word(term, i)
    if terms:
        found.make_automaton()
    return found


def hits(url: str, terms: tuple[str, ...]) -> dict[int, int]:
    """How often each term (by its place) stands in a lower-cased url with no letter or digit beside it."""
    found: dict[int, int] = {}
    if not terms or not url:
        return found
    for end, i in _automaton(terms).iter(url):
        start = end - len(terms[i]) + 1
        before, after = url[start - 1 : start] if start else "", url[end + 1 : end + 2]
        if not (before.isascii() and before.isalnum()) and not (after.isascii() and after.isalnum()):
            found[i] = found.get(i, 0) + 1
    return found


def term_counts(url: Column, vocabulary: Vocabulary) -> Column:
    """``strict`` (hits of strict terms), ``soft`` (different soft terms) and ``weight`` (theirs) of each url."""
    terms = (*vocabulary.strict, *sorted(vocabulary.soft))
    strict = len(vocabulary.strict)
    weights = [vocabulary.soft[t] for t in terms[strict:]]

    @F.arrow_udf("strict int, soft int, weight double")
    def counts(urls: pa.Array) -> pa.Array:
        out: tuple[list, list, list] = ([], [], [])
        for url in binaries(urls):
            found = hits(url.lower().decode("utf-8", "replace"), terms)
            soft = [weights[i - strict] for i in found if i >= strict]
            values = (sum(n for i, n in found.items() if i < strict), len(soft), float(sum(soft)))
            for column, value in zip(out, values, strict=True):
                column.append(value)
        arrays = [pa.array(v, t) for v, t in zip(out, (pa.int32(), pa.int32(), pa.float64()), strict=True)]
        return pa.StructArray.from_arrays(arrays, names=["strict", "soft", "weight"])

    return counts(F.coalesce(url.cast("string"), F.lit("")))


def judged(urls: DataFrame, key: str, rules: Sequence[tuple[str, str]], vocabulary: Vocabulary) -> DataFrame:
    """``key, host, path, rule, verdict, strict_hits, soft_hits, soft_weight`` of every row.

    A rule that fits decides; otherwise the vocabulary does, over the whole url. Null and empty urls
    fit no rule and hold no term: they are allowed. Nothing is shuffled; repeated rows stay and
    further columns do not matter. Terms are lower-case ASCII; boundaries are ASCII letters and digits.
    """
    host, path = host_and_path(F.col("url"))
    counted = urls.select(
        F.col(key), host.alias("host"), path.alias("path"), term_counts(F.col("url"), vocabulary).alias("hits")
    )
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    rejected = (F.col("hits.strict") >= 1) | (
        (F.col("hits.soft") >= vocabulary.least_soft) & (F.col("hits.weight") >= vocabulary.least_weight)
    )
    return counted.select(
        key,
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(said, F.when(rejected, BLOCK).otherwise(ALLOW)).alias("verdict"),
        F.col("hits.strict").alias("strict_hits"),
        F.col("hits.soft").alias("soft_hits"),
        F.col("hits.weight").alias("soft_weight"),
    )
