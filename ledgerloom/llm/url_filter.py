"""URL filters: host/path rules first, then a weighted vocabulary found by Aho-Corasick.

A rule fits its host and all subdomains when the path starts with the rule's path; the longest
rule wins.  Where no rule fits, the whole lower-cased (A-Z) URL is searched for all terms of the
vocabulary in one automaton pass.  A hit counts if no letter a-z or digit touches it on either
side.  One strict term, or ``min_soft`` distinct soft terms, reject the URL.

Defined cases: a null URL, or one without ``://``, has an empty host and path, so no rule fits;
a null or empty URL has no hits and is allowed; a term counts once however often it occurs;
repeated rows are judged each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.common import map_arrow, schema_of

STRICT = ("porn", "xxx", "casino", "escort", "camgirls", "hentai", "viagra", "cialis", "malware", "warez",
          "adult-x")
SOFT = ("adult", "bet", "bets", "betting", "poker", "slots", "jackpot", "lottery", "cheap", "pills", "pharmacy",
        "free", "win", "winner", "prize", "loan", "loans", "payday", "replica", "torrent", "crack", "keygen",
        "spam", "farm", "ads", "track", "clickbait", "sex", "sexy", "nude", "dating")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def parts(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    return (lower(m[1]), m[2]) if m else ("", "")


_LOWER = {c: c + 32 for c in range(65, 91)}


def lower(text: str) -> str:
    """A-Z only, so that positions and all other characters stay."""
    return text.lower() if text.isascii() else text.translate(_LOWER)


def by_rule(host: str, path: str, rules: dict[str, list[Rule]]) -> Rule | None:
    """``rules`` by host.  Host suffixes are looked up label by label."""
    best, at = None, 0
    while True:
        for rule in rules.get(host[at:], ()):
            if path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
                best = rule
        at = host.find(".", at) + 1
        if not at:
            return best


def automaton(strict=STRICT, soft=SOFT) -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, terms in ((1, soft), (0, strict)):  # a term in both lists is strict
        for term in terms:
            found.add_word(term, (term, kind))
    found.make_automaton()
    return found


def hits(url: str, vocabulary: ahocorasick.Automaton) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms with free edges."""
    url, out = lower(url), (set(), set())
    edge = lambda k: not (0 <= k < len(url) and url[k].isascii() and url[k].isalnum())
    for end, (term, kind) in vocabulary.iter(url):
        if edge(end + 1) and edge(end - len(term)):
            out[kind].add(term)
    return out


COLUMNS = (("host", T.StringType()), ("path", T.StringType()), ("rule", T.StringType()), ("verdict", T.StringType()),
           ("n_strict", T.LongType()), ("n_soft", T.LongType()))


def url_verdicts(pages: DataFrame, rules: tuple[Rule, ...] = RULES, strict=STRICT, soft=SOFT,
                 min_soft: int = 2) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict (allow or block), distinct hits of each kind."""

    def worker():
        vocabulary, by_host = automaton(strict, soft), {}
        for r in rules:
            by_host.setdefault(r.host, []).append(r)

        def one(url: str | None) -> tuple:
            host, path = parts(url)
            rule = by_rule(host, path, by_host)
            hard, mild = hits(url or "", vocabulary)
            verdict = rule.verdict if rule else "block" if hard or len(mild) >= min_soft else "allow"
            return host, path, rule and rule.text, verdict, len(hard), len(mild)

        def each(batch: pa.RecordBatch) -> dict:
            rows = [one(x) for x in batch.column("url").to_pylist()]
            return {"page_id": batch.column("page_id")} | {n: [r[k] for r in rows] for k, (n, _) in enumerate(COLUMNS)}
        return each

    return map_arrow(pages.select("page_id", "url"), worker, schema_of(pages, ["page_id"], *COLUMNS))


def oracle() -> str:
    """DuckDB SQL for :func:`url_verdicts` with the default parameters."""
    term = lambda t: f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::BIGINT"
    fits = " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN '{r.text}'"
        for r in sorted(RULES, key=lambda r: -len(r.text)))
    blocked = ", ".join(f"'{r.text}'" for r in RULES if r.verdict == "block")
    return f"""
WITH cut AS (
  SELECT page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS u,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
named AS (
  SELECT page_id, u, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
ruled AS (
  SELECT page_id, host, path, CASE {fits} END AS rule,
         {' + '.join(map(term, STRICT))} AS n_strict,
         {' + '.join(map(term, SOFT))} AS n_soft FROM named)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ({blocked}) THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN n_strict > 0 OR n_soft >= 2 THEN 'block' ELSE 'allow' END AS verdict, n_strict, n_soft FROM ruled"""


