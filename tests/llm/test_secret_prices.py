import random
import string
from math import log2

import pytest

from ledgerloom.llm import secret_scan
from ledgerloom.llm.secret_scan import CLASSES, DATE, ROWS, WORDS, GuessRules

RULES = GuessRules()
LEX = secret_scan.lexicon(RULES.words, RULES.vocabulary)
LEET = {"@": "a", "4": "a", "3": "e", "1": "i", "0": "o", "$": "s", "5": "s", "!": "i", "7": "t", "9": "o"}


def char_bits(c):
    return log2(10 if c.isdigit() else 26 if c.isalpha() else 33)


def keyed(low, i):
    """How the key before ``i`` leads to that at ``i``; None if they are not neighbours."""
    at = {c: (y, x) for y, row in enumerate(ROWS) for x, c in enumerate(row)}
    a, b = low[i - 1], low[i]
    if a not in at or b not in at or a == b or max(abs(at[a][0] - at[b][0]), abs(at[a][1] - at[b][1])) > 1:
        return None
    return ("row", at[b][1] - at[a][1]) if at[a][0] == at[b][0] else ("step", ord(b) - ord(a))


def prices(value, a, b, mixed):
    """What value[a:b] costs as one segment of each kind that it can be."""
    part, low = value[a:b], value.lower()
    upper = sum(c.isupper() for c in part)
    yield sum(max(char_bits(c) + c.isupper(), mixed) for c in part)
    shouted = 0 if not upper else 1 if upper in (1, b - a) else b - a
    if low[a:b] in LEX.ranks:
        yield log2(LEX.ranks[low[a:b]] + 1) + shouted
    other = "".join(LEET.get(c, c) for c in low[a:b])
    if other != low[a:b] and other in LEX.ranks and low[a:b] not in LEX.ranks and (other in WORDS or len(other) >= 5):
        yield log2(LEX.ranks[other] + 1) + 1 + shouted
    if all(c in string.ascii_lowercase for c in low[a:b]):
        yield sum(LEX.pairs[p] for p in zip(["", *low[a:b]], low[a:b], strict=False)) + upper
    if value[a].isdigit() and (m := DATE.match(value, a)) and m.end() == b:
        yield log2(300) + (log2(365) + 2 if b - a > 4 else 0)
    if b - a >= 3 and len(set(part)) == 1 and value[b:b + 1] != part[0]:
        yield char_bits(part[0]) + log2(b - a)
    for unit in range(2, 9):
        one = part[:unit]
        times = (b - a) // unit
        if (times >= 2 and part == one * times and len(set(one)) > 1 and value[b:b + unit] != one
                and not (a >= unit and value[a - unit:a] == one)):
            yield sum(map(char_bits, one)) + log2(times)
    ways = [keyed(low, i) for i in range(a + 1, b)]
    if b - a >= 4 and None not in ways and (b == len(value) or keyed(low, b) is None):
        yield log2(47) + log2(b - a) + 2 * sum(x != y for x, y in zip(ways, ways[1:], strict=False))


def brute_bits(value):
    """All segmentations, one by one."""
    kinds = {secret_scan._class(c) for c in value}
    mixed = log2(sum(CLASSES[k] for k in kinds)) if len(kinds) > 2 or len(kinds) == 2 and len(value) >= 7 else 0.0
    n = len(value)
    cheapest = {(a, b): 1 + min(prices(value, a, b, mixed)) for a in range(n) for b in range(a + 1, n + 1)}
    best = float("inf")
    for cuts in range(1 << n - 1):
        ends = [0, *(k + 1 for k in range(n - 1) if cuts >> k & 1), n]
        best = min(best, sum(cheapest[p] for p in zip(ends, ends[1:], strict=False)))
    return best


def some_values():
    rng = random.Random(11)
    pieces = ["qwert", "asdf", "4321", "1999", "2024-12-24", "aaa", "77777", "abab", "xyzxyz", "Pass", "p4ss", "the", "Monkey",
              "hello", "zq", "X", "!", "kvj", "3", "_", "Th1s", "rewq", "lkjh"]
    while True:
        value = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 4)))
        yield value[:rng.randint(3, 10)]


def test_least_cost_of_all_segment_kinds():
    for value, _ in zip(some_values(), range(250), strict=False):
        assert secret_scan.guess_bits(value) == pytest.approx(brute_bits(value)), value


KINDS = {"lower": string.ascii_lowercase, "digits": string.digits, "letters": string.ascii_letters,
         "lower and digits": string.ascii_lowercase + string.digits, "letters and digits": string.ascii_letters + string.digits,
         "hex": "0123456789abcdef", "printable": string.ascii_letters + string.digits + "!#$%&*+-?@^_"}


@pytest.mark.parametrize("kind", KINDS)
def test_random_values_of_fifty_bits_are_found(kind):
    rng, letters = random.Random(kind), KINDS[kind]
    size = next(n for n in range(99) if n * log2(len(letters)) >= 50)
    values = ["".join(rng.choice(letters) for _ in range(size)) for _ in range(300)]
    assert sum(secret_scan.guess_bits(v) >= RULES.min_bits for v in values) >= 0.9 * len(values)


@pytest.mark.parametrize("text", [
    'pwd: "must be at least 12 characters"', 'pwd: "between 8 and 64 characters with 2 digits"', "bearer telecommunications",
    'client_secret = "Love is patient, love is kind"', "pwd=${DATABASE_PASSWORD_FROM_ENVIRONMENT}", "pwd: $(cat /run/secrets/db)",
    "client_secret: https://docs.example.com/guide/how-to-set-secrets", "credential is process.env.MY_SECRET_TOKEN_VALUE",
    'pwd: "mindestens zwölf Zeichen lang"', "pwd is case-sensitive", "passphrase: telecommunications", "pwd := 'Bearer ${TOKEN}'",
    "pwd: contraseña", "credential = config.get_password()", 'passphrase: "至少十二个 字符"', 'pwd: "   "'])
def test_prose_and_references_stay(text):
    assert secret_scan.redacted(text, RULES, "#") == text


@pytest.mark.parametrize(("text", "left"), [
    ('pwd: "xK9$mQ2!vL7p"', 'pwd: "#"'), ('pwd: "a8f3 99ab 12cd 77ee q1z9 5678"', 'pwd: "#"'), ("bearer kqzvxwjpfhtmrd", "bearer #"),
    ("pwd is qjzkxvwpfmhd", "pwd is #"), ('credential: "Bearer xK9mQ2vL7pRt"', 'credential: "#"'),
    ("passphrase: correct-horse-battery-staple", "passphrase: #")])
def test_secrets_in_the_same_contexts_go(text, left):
    assert secret_scan.redacted(text, RULES, "#") == left


def test_rules_without_a_vocabulary():
    rules = GuessRules(vocabulary=None)
    assert secret_scan.guess_bits("password", rules) < secret_scan.guess_bits("qzjxkvwp", rules)
    assert secret_scan.value_bits("", rules) == 0.0 and secret_scan.guess_bits("", GuessRules(words=(), vocabulary=None)) == 0.0
