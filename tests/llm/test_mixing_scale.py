import itertools
import random
import time
from collections import Counter

import pytest
from tests.llm.conftest import same

from ledgerloom.llm import mixing


def cheapest(patterns, quotas, epochs):
    """The largest flow and its least cost, by linear search over all whole flows of each arc."""
    arcs = [(p, s) for p, (members, _) in enumerate(patterns) for s in members]
    best = (0, 0)
    for flow in itertools.product(*(range(quotas[s] + 1) for _, s in arcs)):
        sent = [sum(f for f, (q, _) in zip(flow, arcs, strict=True) if q == p) for p in range(len(patterns))]
        got = {s: sum(f for f, (_, t) in zip(flow, arcs, strict=True) if t == s) for s in quotas}
        if all(got[s] <= quotas[s] for s in quotas) and all(f <= epochs * w for f, (_, w) in zip(sent, patterns, strict=True)):
            best = min(best, (-sum(sent), cost(sent, patterns, epochs)))
    return best


def cost(sent, patterns, epochs):
    return sum((2 * k + 1) * max(0, min(f - k * w, w)) for f, (_, w) in zip(sent, patterns, strict=True) for k in range(epochs))


def test_route_against_all_flows():
    rng = random.Random(6)
    for _ in range(60):
        names = ["a", "b", None][:rng.randint(1, 3)]
        patterns = [(m, rng.randint(0, 3)) for m in rng.sample([["a"], ["b"], ["a", "b"], [None, "a"], [None]], 3)
                    if set(m) <= set(names)]
        quotas, epochs = {s: rng.randint(0, 4) for s in names}, rng.randint(1, 3)
        sent = mixing.route(patterns, quotas, epochs)
        assert (-sum(sent), cost(sent, patterns, epochs)) == cheapest(patterns, quotas, epochs)


def test_route_with_thousands_of_sources():
    began = time.monotonic()
    n = 2_000
    single = [([f"s{k}"], 1_000 + k) for k in range(n)]
    quotas = {f"s{k}": 1_500 for k in range(n)}
    assert mixing.route(single, quotas) == [1_500] * n
    overlapping = single + [([f"s{k}", f"s{(7 * k + 1) % n}"], 500) for k in range(n)]
    sent = mixing.route(overlapping, quotas)
    assert sum(sent) == 1_500 * n and all(f <= 2 * w for f, (_, w) in zip(sent, overlapping, strict=True))
    assert time.monotonic() - began < 5


@pytest.mark.parametrize(("setting", "value"), [("BUCKETS_PER_GROUP", 1), ("BUCKETS_PER_GROUP", 3), ("MAX_BROADCAST_BYTES", 0)])
def test_mix_does_not_depend_on_its_sizes(docs, monkeypatch, setting, value):
    expected = mixing.words_taken(docs, docs_per_bucket=3).collect()
    monkeypatch.setattr(mixing, setting, value)
    same(mixing.words_taken(docs, docs_per_bucket=3).collect(), expected)


def test_too_many_patterns_are_an_error(docs, monkeypatch):
    monkeypatch.setattr(mixing, "MAX_PATTERNS", 1)
    with pytest.raises(ValueError, match="patterns"):
        mixing.words_taken(docs)


def test_chosen_copies_come_as_near_as_single_ones():
    rng = random.Random(9)
    for _ in range(200):
        sizes = [rng.choice([0, 5, 60, 300]) + rng.randrange(20) for _ in range(rng.randint(0, 5))]
        copies = [rng.choice([1, 1, 2, 7, 40]) for _ in sizes]
        room = rng.randint(1, sum(s * n for s, n in zip(sizes, copies, strict=True)) + 1)
        taken = mixing.chosen(sizes, room, copies)
        assert all(sizes[k] and 0 < n <= copies[k] for k, n in taken.items())
        total = sum(sizes[k] * n for k, n in taken.items())
        out = [s for k, s in enumerate(sizes) if taken.get(k, 0) < copies[k]]
        for a in [0, *out]:  # no exchange of one copy for one comes closer
            for b in [0, *(sizes[k] for k in taken)]:
                assert abs(room - total) <= abs(room - total - a + b)


@pytest.mark.parametrize("parts", [1, 5])
def test_a_source_of_one_repeated_row_comes_near_its_target(spark, parts):
    rows = [(1, "one two three", "a", k) for k in range(900)] + [(None, "x y", "b", k) for k in range(301)]
    rows += [(3, None, "b", 0), (3, "", "b", 0), (4, "z " * 5, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, part int").repartition(parts, "part")
    found = mixing.words_taken(docs, docs_per_bucket=100)
    got = found.collect()
    assert len(got) == len(rows) and all(r.taken in (0, r.size, 2 * r.size) for r in got)
    for size in {r.source_size for r in got}:
        of = [r for r in got if r.source_size == size]
        assert abs(sum(r.taken for r in of) - of[0].target) <= 1.5
    same(found.collect(), got)
    same(mixing.words_taken(docs.repartition(3), docs_per_bucket=100).collect(), got)
    mixed = mixing.mixed_documents(docs, docs_per_bucket=100)
    assert mixed.columns == docs.columns
    out = mixed.collect()
    epochs = Counter()
    for r in got:
        epochs[r.doc_id] += r.epochs
    assert Counter(r.doc_id for r in out) == Counter({d: n for d, n in epochs.items() if n})
    times = Counter((r.doc_id, r.part) for r in out)
    for d in (1, None):  # the copies of a document differ by at most one repetition
        each = {times[r[0], r[3]] for r in rows if r[0] == d}
        assert max(each) - min(each) <= 1
