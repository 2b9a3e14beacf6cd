"""URL filter: host and path rules, and a weighted vocabulary counted by an Aho-Corasick automaton."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from string import ascii_lowercase, digits

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.common import ascii_lower

_WORD = frozenset(ascii_lowercase + digits)


@dataclass(frozen=True)
class UrlRule:
    """A host with all its subdomains, and the start of the path."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlVocabulary:
    """Lower-case ASCII terms; each strict term weighs ``limit``, each soft term its own weight.

    A url is rejected when the distinct terms it holds weigh ``limit`` or more together.
    """

    strict: tuple[str, ...]
    soft: tuple[tuple[str, int], ...]
    limit: int = 2

    def weights(self) -> dict[str, int]:
        return {**dict(self.soft), **dict.fromkeys(self.strict, self.limit)}


#: Rules of the query.
RULES = (
    UrlRule("allow", "org"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)

#: Terms for spam, adult and gambling sites.
VOCABULARY = UrlVocabulary(
    strict=("casino", "escort", "hentai", "porn", "viagra", "warez", "xxx"),
    soft=tuple(
        (term, 1)
        for term in (
            "adult", "bet", "cam", "cheap", "crack", "dating", "farm", "free", "hot", "loan", "lottery", "meds",
            "nude", "payday", "pills", "poker", "replica", "seo", "sex", "slots", "spam", "torrent", "win",
        )
    ),
)


def _bounded(text: str, start: int, end: int) -> bool:
    return (start == 0 or text[start - 1] not in _WORD) and (end == len(text) or text[end] not in _WORD)


@lru_cache(maxsize=4)
def _automaton(terms: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        found.add_word(term, (i, len(term)))
    found.make_automaton()
    return found


def term_hits(text: str, terms: tuple[str, ...]) -> set[int]:
    """Which terms stand in the lower-case ``text``, with no ASCII letter or digit directly before or after."""
    if not terms or not text:
        return set()
    return {
        i for end, (i, size) in _automaton(terms).iter(text) if _bounded(text, end + 1 - size, end + 1)
    }


def vocabulary_hits(url: Column, vocabulary: UrlVocabulary) -> Column:
    """Struct of the number of distinct strict and soft terms in the url and their weight."""
    weights = vocabulary.weights()
    terms, strict = tuple(weights), set(vocabulary.strict)

    @F.arrow_udf("struct<strict: int, soft: int, weight: int>")
    def hits(urls: pa.Array) -> pa.Array:
        found = [[terms[i] for i in term_hits(u, terms)] for u in urls.to_pylist()]
        n_strict = [sum(t in strict for t in f) for f in found]
        columns = (n_strict, [len(f) - n for f, n in zip(found, n_strict)], [sum(weights[t] for t in f) for f in found])
        return pa.StructArray.from_arrays([pa.array(c, pa.int32()) for c in columns], ["strict", "soft", "weight"])

    return hits(ascii_lower(F.coalesce(url, F.lit(""))))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end; path: from there up to ``?`` or ``#``."""
    has = F.coalesce(url.contains("://"), F.lit(False))
    host = F.regexp_extract(url, r"^[\s\S]*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"^[\s\S]*?://[^/?#]*([^?#]*)", 1)
    return F.when(has, ascii_lower(host)).otherwise(""), F.when(has, path).otherwise("")


def fitting_rule(host: Column, path: Column, rules: Sequence[UrlRule]) -> Column:
    """Struct (name, verdict) of the longest rule that fits, of equally long ones a blocking one; else null."""
    found = F.lit(None).cast("struct<name: string, verdict: string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block", r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def judge_urls(
    pages: DataFrame,
    url: str = "url",
    rules: Sequence[UrlRule] = RULES,
    vocabulary: UrlVocabulary = VOCABULARY,
) -> DataFrame:
    """``pages`` as one struct column ``row``, with host, path, rule, verdict and the vocabulary's counts.

    A rule decides where one fits; elsewhere a url is blocked if its terms weigh the vocabulary's limit.
    A null url, or one without ``://``, has an empty host and path and meets no rule; a null or empty one
    holds no terms, so it is allowed. Repeated rows are judged one by one, an empty table gives no rows, and extra
    columns stay inside ``row``, where their names cannot clash. Nothing is shuffled.
    """
    host, path = host_and_path(F.col(f"row.`{url}`"))
    judged = (
        pages.select(F.struct("*").alias("row"))
        .select("row", host.alias("host"), path.alias("path"), vocabulary_hits(F.col(f"row.`{url}`"), vocabulary).alias("hits"))
        .withColumn("found", fitting_rule(F.col("host"), F.col("path"), rules))
    )
    own = F.when(F.col("hits.weight") >= vocabulary.limit, "block").otherwise("allow")
    return judged.select(
        "row", "host", "path", F.col("found.name").alias("rule"),
        F.coalesce("found.verdict", own).alias("verdict"),
        F.col("hits.strict").alias("strict_hits"), F.col("hits.soft").alias("soft_hits"),
    )


def judge_sql(rules: Sequence[UrlRule] = RULES, vocabulary: UrlVocabulary = VOCABULARY) -> str:
    """DuckDB SQL for the query: a regular expression per term in place of the automaton."""
    def holds(term: str) -> str:
        return f"CAST(regexp_matches(lowered, '(^|[^a-z0-9]){term}([^a-z0-9]|$)') AS INTEGER)"

    strict = " + ".join(holds(t) for t in vocabulary.strict)
    soft = " + ".join(holds(t) for t, _ in vocabulary.soft)
    soft_weight = " + ".join(f"{w} * {holds(t)}" for t, w in vocabulary.soft)
    ordered = sorted(rules, key=lambda r: (len(r.name), r.verdict == "block", r.name), reverse=True)
    fits = [
        (f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN", r)
        for r in ordered
    ]
    upper = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
    return f"""
    WITH cut AS (
        SELECT page_id, translate(coalesce(url, ''), {upper}) AS lowered,
               CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), parts AS (
        SELECT page_id, lowered, translate(regexp_extract(rest, '^[^/?#]*'), {upper}) AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM cut
    ), counted AS (
        SELECT *, {strict} AS n_strict, {soft} AS n_soft, {soft_weight} AS soft_weight FROM parts
    )
    SELECT page_id, host, path,
           CASE {' '.join(f"{c} '{r.name}'" for c, r in fits)} ELSE NULL END AS rule,
           CASE {' '.join(f"{c} '{r.verdict}'" for c, r in fits)}
                WHEN {vocabulary.limit} * n_strict + soft_weight >= {vocabulary.limit} THEN 'block' ELSE 'allow' END AS verdict,
           CAST(n_strict AS INTEGER) AS strict_hits, CAST(n_soft AS INTEGER) AS soft_hits
    FROM counted
    """
