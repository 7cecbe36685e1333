"""URL filter: host and path rules first, then a weighted vocabulary searched by Aho-Corasick.

The vocabulary is compiled into one automaton per Python worker, so a URL is read
once however many terms there are. A hit counts only between boundaries: the
characters before and after it must not be ASCII letters or digits. One strict
term, or `soft_needed` different soft terms, reject the URL.

Defined cases: a null URL, or one without `://`, has an empty host and path and is
judged by the vocabulary on its whole text (null: no terms, allowed); letters
A-Z count as a-z in terms and host; repeated rows stay repeated rows; a term in
both lists is strict; any other column is passed over.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: terms of which one is enough
STRICT = ("casino", "porn", "porno", "xxx", "viagra", "escort", "escorts", "jackpot", "malware", "phishing", "warez")
#: terms of which several different ones are needed
SOFT = (
    "ads", "adult", "bet", "bets", "bonus", "cheap", "coupon", "crack", "deal", "deals", "discount", "download",
    "farm", "free", "loan", "loans", "pill", "pills", "poker", "prize", "sex", "slots", "spam", "track", "win",
)
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
_TO_LOWER = str.maketrans(ASCII_UPPER, ASCII_LOWER)
_WORD_CHARS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789")


@dataclass(frozen=True)
class Rule:
    """Judges `host`, its subdomains, and paths that begin with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: fixed by the contract
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


@dataclass(frozen=True)
class Vocabulary:
    strict: tuple[str, ...] = field(default=STRICT)
    soft: tuple[str, ...] = field(default=SOFT)
    soft_needed: int = 2


@lru_cache(maxsize=4)
def _automaton(words: Vocabulary) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for weight, terms in ((1, words.soft), (2, words.strict)):  # strict last: it wins
        for term in terms:
            automaton.add_word(term.translate(_TO_LOWER), (term.translate(_TO_LOWER), weight))
    automaton.make_automaton()
    return automaton


def count_terms(url: str | None, words: Vocabulary) -> tuple[int, int]:
    """(strict hits, different soft terms) of one URL."""
    if not url or not (words.strict or words.soft):
        return 0, 0
    text = url.translate(_TO_LOWER)
    strict, soft = 0, set()
    for last, (term, weight) in _automaton(words).iter(text):
        first = last - len(term)
        if first >= 0 and text[first] in _WORD_CHARS:
            continue
        if last + 1 < len(text) and text[last + 1] in _WORD_CHARS:
            continue
        if weight == 2:
            strict += 1
        else:
            soft.add(term)
    return strict, len(soft)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: from the first `://` to `/`, `?`, `#` or the end, A-Z lowered. Path: on to `?`, `#` or the end."""
    after = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, after, 1), ASCII_UPPER, ASCII_LOWER), F.regexp_extract(text, after, 2)


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the rule with the longest name that fits; null if none does."""
    name = verdict = F.lit(None).cast("string")
    # shortest first, so that the last `when` around the others is the longest rule
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        below = host.endswith(f".{rule.host}") | (host == rule.host)
        fits = below & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def judge(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: Sequence[Rule] = RULES,
    words: Vocabulary = Vocabulary(),
) -> DataFrame:
    """Per row of `pages`: key, url, host, path, rule, strict_hits, soft_terms, verdict (allow or block)."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            urls = batch.column(1).to_pylist()
            found = [count_terms(u, words) for u in urls]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([s for s, _ in found], pa.int32()),
                    pa.array([s for _, s in found], pa.int32()),
                ],
                names=["key", "url", "strict_hits", "soft_terms"],
            )

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    counted = rows.mapInArrow(search, f"key {kind}, url string, strict_hits int, soft_terms int")
    host, path = host_and_path(F.col("url"))
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    bad = (F.col("strict_hits") >= 1) | (F.col("soft_terms") >= words.soft_needed)
    own = F.when(bad, "block").otherwise("allow")
    return (
        counted.withColumns({"host": host, "path": path})
        .withColumns({"rule": name, "verdict": F.coalesce(verdict, own)})
        .select(F.col("key").alias(key), F.col("url").alias(url), "host", "path", "rule", "strict_hits", "soft_terms", "verdict")
    )


def judge_sql(rules: Sequence[Rule] = RULES, words: Vocabulary = Vocabulary()) -> str:
    """The same judgement of `pages` as DuckDB SQL."""
    lowered = f"translate(coalesce(url, ''), '{ASCII_UPPER}', '{ASCII_LOWER}')"

    def hit(term: str) -> str:
        return f"regexp_matches({lowered}, '(?s)(^|[^a-z0-9]){term}([^a-z0-9]|$)')"

    strict = " OR ".join(hit(t) for t in words.strict)
    soft = " + ".join(f"{hit(t)}::INT" for t in words.soft)
    ordered = sorted(rules, key=lambda r: (len(r.name), r.name), reverse=True)
    fits = [f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')" for r in ordered]
    name = " ".join(f"WHEN {f} THEN '{r.name}'" for f, r in zip(fits, ordered))
    verdict = " ".join(f"WHEN {f} THEN '{r.verdict}'" for f, r in zip(fits, ordered))
    after = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return f"""
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '{after}', 1), '{ASCII_UPPER}', '{ASCII_LOWER}') AS host,
                   regexp_extract(coalesce(url, ''), '{after}', 2) AS path,
                   ({strict}) OR ({soft}) >= {words.soft_needed} AS bad
            FROM pages)
        SELECT page_id, host, path,
               CASE {name} END AS rule,
               CASE {verdict} WHEN bad THEN 'block' ELSE 'allow' END AS verdict
        FROM parts"""
