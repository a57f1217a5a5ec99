"""Secret scans: base patterns, and a guess-cost rule for values in a credential context.

The guess cost of a value is the least total of bits over all segmentations into words of a
dictionary, runs of letters at the price of their pairs, dates, repeats, keyboard walks and brute-force
characters (dynamic programming over end positions).  Dictionary and pairs come from a public
tokenizer's vocabulary, whose order is by frequency.  A value whose cost reaches ``min_bits`` is hard
to guess, so it is a secret and not a placeholder such as ``changeme``.  A value with blanks is priced
word by word, and words that read as prose are free: a sentence is no secret (nor, then, a passphrase
of ordinary words).  References (``${NAME}``, ``process.env.NAME``) and URLs without credentials are no
values.  Base spans are always kept; the rule adds spans.

Defined cases: a null text counts as empty and has no spans; texts of any length are scanned
whole; overlapping spans of different kinds are all reported, and redaction merges them;
repeated rows are scanned each for itself; an empty table gives an empty result; of other columns,
clashing names included, the scan reads none and the redaction keeps all.
"""

from __future__ import annotations

import json
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache
from math import log2

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.common import map_arrow, schema_of, sha256, texts

ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: The kinds in the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "guess")

# Wider contexts than the base pattern: more names, other separators, quoted values, user:password@host.
CONTEXT = re.compile(
    r"""(?ai:(?:pass(?:word|wd|phrase|code)|pwd|secret|token|api[_-]?key|credential|access[_-]?key|private[_-]?key|"""
    r"""client[_-]?secret)["']?(?:[\x20\t]*+(?::=|=>|[:=])[\x20\t]*+|(?P<said>[\x20\t]++is:?[\x20\t]++))|(?P<bearer>bearer[\x20\t]++))"""
    r"""(?:"(?P<double>[^"\n]{4,})"|'(?P<single>[^'\n]{4,})'|(?P<bare>[^\s"'<>,;]{4,}))""")
LOGIN = re.compile(r"://[^\s/:@]++:(?P<bare>[^\s/@]{4,}+)@")
#: Names of values that stand elsewhere, and URLs without credentials.
REFERENCE = re.compile(r"\$\{[\w.]+\}|\$\([\w ./-]+\)|\$[A-Z][A-Z_]{2,}|%[A-Z][A-Z_]{2,}%|\{\{[^{}]*\}\}"
                       r"|(?:process\.env|os\.environ|os\.getenv|System\.getenv|getenv|ENV)[.\[(].*|[A-Za-z][\w+.-]*://[^\s@]*")
#: A word, or a short number, of a sentence with the punctuation around it.
PROSE_WORD = re.compile(r"[^\w\s]{0,3}(?:([^\W\d_]+(?:['\u2019./-][^\W\d_]+)*)|\d{1,4})[^\w\s]{0,3}|[^\w\s]{1,3}")
#: A call of code, if all its names read as words.
CALL = re.compile(r"[A-Za-z_]+(?:\.[A-Za-z_]+)*\([^()\d]*\)?")
LETTERS = re.compile(r"[^\W\d_]+")

# Common words of passwords and placeholders, most common first.
WORDS = ("password", "admin", "welcome", "login", "qwerty", "dragon", "master", "monkey", "letmein", "secret", "shadow",
         "sunshine", "princess", "football", "baseball", "iloveyou", "trustno", "superman", "batman", "hello",
         "freedom", "whatever", "flower", "summer", "winter", "spring", "autumn", "london", "paris", "berlin", "google",
         "changeme", "change", "default", "example", "sample", "test", "testing", "user", "guest", "root", "demo",
         "token", "key", "pass", "passwd", "api", "your", "here", "none", "null", "true", "false", "placeholder",
         "value", "string", "redacted", "hidden", "dummy", "temp", "access", "private", "public", "service", "system",
         "server", "client", "database", "account", "my", "the", "and", "for", "this", "that", "with", "not", "new",
         "old", "dev", "prod", "staging", "local", "insert", "replace", "enter", "type", "name", "code", "love", "god")
ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_LEET = str.maketrans("@4310$5!7", "aaeiossit")


@dataclass(frozen=True)
class GuessRules:
    min_bits: float = 40.0
    words: tuple[str, ...] = field(default=WORDS)
    max_year_distance: int = 150
    #: Tokenizer file (readable on every executor) whose tokens follow ``words``; None: no more words, pairs of ``words``.
    vocabulary: str | None = public_tokenizers.path("word_bpe_49k.json")


def _neighbours() -> dict[str, set[str]]:
    at = {c: (y, x) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    near = lambda a, b: a != b and abs(a[0] - b[0]) <= 1 and -1 <= a[1] - b[1] - 0 <= 1
    return {c: {d for d, q in at.items() if near(p, q)} for c, p in at.items()}


NEIGHBOURS = _neighbours()
DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?"
                  r"|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)\d\d", re.ASCII)


def _char_bits(c: str) -> float:
    if not c.isascii():
        return 8.0
    return log2(10) if c.isdigit() else log2(26) if c.isalpha() else log2(33)


#: Sizes of the character classes, and the shortest value of two classes that is priced by both together.
CLASSES = {"upper": 26, "lower": 26, "digit": 10, "symbol": 33}
MIXED_LENGTH = 7


def _class(c: str) -> str | None:
    return (None if not c.isascii() else "digit" if c.isdigit() else "symbol" if not c.isalpha()
            else "upper" if c.isupper() else "lower")


def _mixed_bits(value: str) -> float:
    """The least price of a brute-force character: that of one of the whole value's alphabet where the value mixes
    classes, as which class comes where is part of the guess.  Shorter values of two classes stay below 36 bits
    either way."""
    found = {_class(c) for c in value} - {None}
    return log2(sum(CLASSES[k] for k in found)) if len(found) > 2 or len(found) == 2 and len(value) >= MIXED_LENGTH else 0.0


#: Shortest and longest tokens that count as words, and the shortest that is looked for in other spelling (p4ssw0rd).
TOKEN_LENGTHS, LEET_LENGTH = (3, 16), 5


@dataclass(frozen=True)
class Lexicon:
    ranks: dict[str, int]         # by word, from 1
    few: frozenset[str]           # words that other spellings of digits and symbols are looked up in
    longest: int
    pairs: dict[tuple[str, str], float]  # bits of a letter after another; after "" at the start


@lru_cache(8)
def lexicon(words: tuple[str, ...], vocabulary: str | None) -> Lexicon:
    """One for each Python worker.  Tokens are ranked in the order of the vocabulary; the pairs are those of its whole
    words, each counted once."""
    ranks: dict[str, int] = {}
    for k, w in enumerate(words, 1):
        ranks.setdefault(w.lower(), k)
    few, whole = set(ranks), set(ranks)
    if vocabulary:
        with open(vocabulary, encoding="utf-8") as f:
            ids = json.load(f)["model"]["vocab"]
        k = len(ranks)
        for token in sorted(ids, key=ids.get):
            word = token.removesuffix("</w>")
            if word.isascii() and word.isalpha() and TOKEN_LENGTHS[0] <= len(word) <= TOKEN_LENGTHS[1]:
                if word != token:
                    whole.add(word)
                if word not in ranks:
                    k += 1
                    ranks[word] = k
                    if len(word) >= LEET_LENGTH:
                        few.add(word)
    seen = Counter(p for w in whole for p in zip(["", *w], w, strict=False))
    letters = "abcdefghijklmnopqrstuvwxyz"
    pairs = {}
    for a in ["", *letters]:
        total = sum(seen[a, b] + 0.5 for b in letters)
        pairs |= {(a, b): log2(total / (seen[a, b] + 0.5)) for b in letters}
    return Lexicon(ranks, frozenset(few), max(map(len, ranks), default=0), pairs)


@lru_cache(4096)
def _letter(c: str) -> str:
    """The plain lower-case letter of ``c``, or nothing."""
    base = unicodedata.normalize("NFD", c)[0].lower()
    return base if "a" <= base <= "z" else ""


def guess_bits(value: str, rules: GuessRules = GuessRules()) -> float:
    """The least cost in bits.  Each segment also costs one bit, for where it ends."""
    n, lex, mixed = len(value), lexicon(rules.words, rules.vocabulary), _mixed_bits(value)
    ranks, pairs = lex.ranks, lex.pairs
    low = value.lower() if len(value.lower()) == n else value
    plain = low.translate(_LEET)
    best = [0.0] + [float("inf")] * n

    def offer(a: int, b: int, bits: float) -> None:
        if best[a] + bits + 1 < best[b]:
            best[b] = best[a] + bits + 1

    dates: dict[int, list[int]] = {}
    for a in range(n):
        if value[a].isdigit() and (m := DATE.match(value, a)):
            dates.setdefault(a, []).append(m.end())
    run_end, walk_end, turns = 0, 0, []  # turns: where a keyboard walk changes its way
    brute = spoken = float("inf")
    before = ""
    for a in range(n):
        # Brute-force characters and letters by their pairs extend one span, so only the first pays for a segment.
        brute = min(best[a] + 1, brute) + max(_char_bits(value[a]) + value[a].isupper(), mixed)
        best[a + 1] = min(best[a + 1], brute)
        if letter := _letter(value[a]):
            spoken = (min(best[a] + 1 + pairs["", letter], spoken + pairs[before, letter] if before else float("inf"))
                      + value[a].isupper())
            best[a + 1] = min(best[a + 1], spoken)
        before = letter
        for size in range(2, min(lex.longest, n - a) + 1):
            word, other = low[a:a + size], plain[a:a + size]
            if (rank := ranks.get(word)) or other != word and other in lex.few:
                upper = sum(c.isupper() for c in value[a:a + size])
                offer(a, a + size, (log2(rank + 1) if rank else log2(ranks[other] + 1) + 1)
                      + (0 if not upper else 1 if upper in (1, size) else size))
        for b in dates.get(a, ()):
            offer(a, b, log2(2 * rules.max_year_distance) + (log2(365) + 2 if b - a > 4 else 0))
        if a >= run_end:
            run_end = a + 1
            while run_end < n and value[run_end] == value[a]:
                run_end += 1
        if run_end - a >= 3:
            offer(a, run_end, _char_bits(value[a]) + log2(run_end - a))
        for unit in range(2, 9):  # repeats of a longer unit
            part = value[a:a + unit]
            if part != value[a + unit:a + 2 * unit] or len(set(part)) == 1 or a >= unit and value[a - unit:a] == part:
                continue  # only where such a run starts, so that each run is walked through once
            b = a + 2 * unit
            while value[b:b + unit] == part:
                b += unit
            offer(a, b, sum(map(_char_bits, part)) + log2((b - a) // unit))
        if a >= walk_end - 1:
            walk_end, turns, last = a + 1, [], None
            while walk_end < n and low[walk_end] in NEIGHBOURS.get(low[walk_end - 1], ()):
                step = ord(low[walk_end]) - ord(low[walk_end - 1])
                row = next((r for r in ROWS if low[walk_end] in r and low[walk_end - 1] in r), None)
                way = (row is None, row and row.index(low[walk_end]) - row.index(low[walk_end - 1]) or step)
                if last is not None and way != last:
                    turns.append(walk_end - 1)
                last, walk_end = way, walk_end + 1
        if walk_end - a >= 4:
            offer(a, walk_end, log2(47) + log2(walk_end - a) + 2 * (len(turns) - bisect_right(turns, a)))
    return best[n]


def reads_as_prose(word: str, rules: GuessRules) -> bool:
    """Whether a word between blanks is one of a sentence: a word of the dictionary, letters whose pairs are cheaper than
    brute force (small, capital or with a capital first), letters of other scripts, or a short number."""
    m = PROSE_WORD.fullmatch(word)
    lex = lexicon(rules.words, rules.vocabulary)
    for part in LETTERS.findall(m[1]) if m and m[1] else ():
        plain = [_letter(c) for c in part]
        if not (part[1:].islower() or part.isupper() or not part.isascii() or len(part) == 1):
            return False
        if len(part) > 2 and all(plain) and "".join(plain) not in lex.ranks and (
                sum(lex.pairs[p] for p in zip(["", *plain], plain, strict=False)) >= _char_bits("a") * len(part)):
            return False
    return m is not None


def value_bits(value: str, rules: GuessRules = GuessRules(), said: bool = False) -> float:
    """What a value in a credential context costs.  ``said``: it follows a word ("is", "bearer") and no sign, so a
    single word may be prose too."""
    if REFERENCE.fullmatch(value.strip()):
        return 0.0
    if CALL.fullmatch(value) and all(reads_as_prose(w, rules) for w in LETTERS.findall(value)):
        return 0.0
    words = value.split()
    if len(words) == 1 and not said:
        return guess_bits(value, rules)
    return sum(guess_bits(w, rules) for w in words if not (REFERENCE.fullmatch(w) or reads_as_prose(w, rules)))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, sorted."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def guess_spans(text: str, base: list[tuple[int, int, int]], rules: GuessRules) -> tuple[list, float]:
    """Spans of hard values that no base span holds, and the highest cost of all values (0 if there is none)."""
    found, most, k = [], 0.0, 0
    values = sorted({(*m.span(m.lastgroup), p is CONTEXT and (m["said"] or m["bearer"]) is not None)
                     for p in (CONTEXT, LOGIN) for m in p.finditer(text)})
    reach = -1  # the furthest end of the base spans that start at or before the value
    for start, end, said in values:
        bits = value_bits(text[start:end], rules, said)
        most = max(most, bits)
        while k < len(base) and base[k][0] <= start:
            reach, k = max(reach, base[k][2]), k + 1
        if bits >= rules.min_bits and reach < end:
            found.append((start, 3, end))
    return found, most


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


COLUMNS = (("n_assign", T.LongType()), ("n_access", T.LongType()), ("n_hex", T.LongType()),
           ("base_sha256", T.StringType()), ("spans", T.StringType()), ("n_guess", T.LongType()),
           ("max_guess_bits", T.DoubleType()))


def scan(text: str, rules: GuessRules) -> tuple:
    base = base_spans(text)
    more, bits = guess_spans(text, base, rules)
    return (*(sum(s[1] == k for s in base) for k in range(3)), sha256(listed(base)), listed(sorted(base + more)),
            len(more), bits)


def secret_spans(docs: DataFrame, rules: GuessRules = GuessRules()) -> DataFrame:
    """One row per document: doc_id and :data:`COLUMNS`; positions are code points, ends exclusive."""

    def worker():
        def each(batch: pa.RecordBatch) -> dict:
            rows = [scan(x, rules) for x in texts(batch)]
            return {"doc_id": batch.column("doc_id")} | {n: [r[k] for r in rows] for k, (n, _) in enumerate(COLUMNS)}
        return each

    return map_arrow(docs.select("doc_id", "text"), worker, schema_of(docs, ["doc_id"], *COLUMNS))


def redacted(text: str, rules: GuessRules, mark: str) -> str:
    """``text`` with each run of overlapping spans replaced by ``mark``."""
    base = base_spans(text)
    spans = sorted(base + guess_spans(text, base, rules)[0])
    out, at = [], 0
    for start, _, end in spans:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:] if spans else text


def redact_secrets(docs: DataFrame, rules: GuessRules = GuessRules(), mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with secrets replaced in ``text`` (a null stays null) and ``n_chars``, if there, counted anew
    for the texts that changed.  All rows and columns stay."""

    names = docs.columns

    def worker():
        def each(batch: pa.RecordBatch) -> dict:
            out = {n: batch.column(k) for k, n in enumerate(names)}
            old = out["text"].to_pylist()
            new = [x and redacted(x, rules, mark) for x in old]
            if new != old:
                if "n_chars" in out:
                    out["n_chars"] = [c if a == b else len(b)
                                      for a, b, c in zip(old, new, out["n_chars"].to_pylist(), strict=True)]
                out["text"] = new
            return out
        return each

    return map_arrow(docs, worker, docs.schema)
