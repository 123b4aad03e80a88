"""URL verdicts: host and path rules first, a weighted vocabulary for the rest.

A rule (host, path) fits its host and all subdomains when the url's path
starts with the rule's path; of several that fit, the one with the longest
host and path wins.  Urls without a fitting rule are judged by words: an
Aho-Corasick automaton finds all strict and soft terms in one pass, a hit
counts only between boundaries (no letter or digit on either side), and one
strict term, or ``soft_needed`` different soft ones, reject the url.

Cases: a null url, or one without ``://``, has host and path "", fits no rule
and is judged by its words (null: none, so allowed); matching ignores the
case of A-Z; repeated pages are judged alike; further columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import Columns, kind_of, map_columns

# Rules of the production query as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# The vocabulary.
STRICT = ("adult", "casino", "hentai", "porn", "porno", "sexcam", "spam", "viagra", "xxx")
SOFT = ("bet", "bets", "bonus", "cheap", "escort", "farm", "free", "loan", "loans", "nude", "pill", "pills", "poker", "sex", "win")
SOFT_NEEDED = 2

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWER = str.maketrans(UPPER, LOWER)


@lru_cache(maxsize=8)
def vocabulary(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for weight, terms in ((1, soft), (0, strict)):  # a term in both lists is strict
        for term in terms:
            found.add_word(term.translate(_LOWER), (term.translate(_LOWER), weight))
    found.make_automaton()
    return found


def hits(url: str, automaton: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """The strict and the soft terms that stand between boundaries in ``url``."""
    text = url.translate(_LOWER)
    strict: set[str] = set()
    soft: set[str] = set()
    if not len(automaton):
        return strict, soft
    for end, (term, weight) in automaton.iter(text):
        start = end - len(term)
        if (start < 0 or not text[start].isalnum()) and (end + 1 == len(text) or not text[end + 1].isalnum()):
            (soft if weight else strict).add(term)
    return strict, soft


@lru_cache(maxsize=8)
def rule_index(rules: tuple[tuple[str, str, str], ...]) -> dict[str, list[tuple[str, str, str]]]:
    """By host, its (path, rule, verdict), longest path first."""
    by_host: dict[str, list[tuple[str, str, str]]] = {}
    for verdict, host, path in rules:
        by_host.setdefault(host.translate(_LOWER), []).append((path, host + path, verdict))
    for own in by_host.values():
        own.sort(key=lambda r: -len(r[0]))
    return by_host


def rule_for(host: str, path: str, index: dict[str, list[tuple[str, str, str]]]) -> tuple[str | None, str | None]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    best: tuple[str | None, str | None] = (None, None)
    while host:
        for own_path, rule, verdict in index.get(host, ()):
            if path.startswith(own_path):
                if best[0] is None or len(rule) > len(best[0]):
                    best = (rule, verdict)
                break
        host = host.partition(".")[2]
    return best


def url_parts(pages: DataFrame) -> DataFrame:
    """(page_id, url, host, path), the last two never null."""
    after = F.regexp_extract(F.col("url"), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    return pages.select(
        "page_id",
        "url",
        F.coalesce(F.translate(host, UPPER, LOWER), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit("")).alias("path"),
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    strict: Sequence[str] = STRICT,
    soft: Sequence[str] = SOFT,
    soft_needed: int = SOFT_NEEDED,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, strict_hits, soft_hits) of each page."""
    rules, strict, soft = tuple(map(tuple, rules)), tuple(strict), tuple(soft)

    def judge(batches: Iterator[Columns]) -> Iterator[Columns]:
        index, automaton = rule_index(rules), vocabulary(strict, soft)
        for b in batches:
            fitting = [rule_for(h, p, index) for h, p in zip(b["host"], b["path"])]
            words = [hits(u or "", automaton) for u in b["url"]]
            yield {
                "page_id": b["page_id"],
                "host": b["host"],
                "path": b["path"],
                "rule": [r for r, _ in fitting],
                "verdict": [v or ("block" if s or len(t) >= soft_needed else "allow") for (_, v), (s, t) in zip(fitting, words)],
                "strict_hits": [len(s) for s, _ in words],
                "soft_hits": [len(t) for _, t in words],
            }

    parts = url_parts(pages)
    schema = {"page_id": kind_of(parts, "page_id"), "host": "string", "path": "string", "rule": "string", "verdict": "string", "strict_hits": "bigint", "soft_hits": "bigint"}
    return map_columns(parts, judge, schema)
