"""Syncmers, ranked search and centroids against brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tests.llm.conftest import prose, same

from ledgerloom.llm import centroids, ranked_search, syncmers

# Syncmers -----------------------------------------------------------------------------------------------------------


def brute_codes(text):
    if not text:
        return []
    hashed = lambda x: xxhash.xxh64_intdigest(x.encode(), seed=42)
    signed = lambda v: v - 2**64 if v >= 2**63 else v
    k, s = syncmers.K, syncmers.S
    inner = [signed(hashed(text[i:i + s])) for i in range(len(text) - s + 1)]
    out, before = [], 0
    for i in range(len(text) - k + 1):
        window = inner[i:i + k - s + 1]
        if min(window) in (window[0], window[-1]):
            out.append(((i - before) << 32) | (hashed(text[i:i + k]) & 0xFFFFFFFF))
            before = i
    return out or [hashed(text) & 0xFFFFFFFF]


def brute_likeness(a, b):
    return 2 * len(set(a) & set(b)) / (len(set(a)) + len(set(b))) if a or b else 1.0


def signed_hash(text):
    v = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return v - 2**64 if v >= 2**63 else v


def brute_fingerprints(rows):
    """``rows``: (doc_id, text)."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), signed_hash(r[1])))
    out = []
    for k, (i, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        own, new = brute_codes(text), brute_codes(edited)
        digits = lambda codes: "".join(f"{c:09x}" for c in codes)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), digits(own), digits(new),
                    brute_likeness(own, new), brute_likeness(own, brute_codes(following))))
    return out


def test_fingerprints(spark, docs, rows):
    found = syncmers.document_fingerprints(docs)
    assert found.dtypes == [("doc_id", "bigint"), ("n_chars", "bigint"), ("edited_sha256", "string"), ("fingerprint", "string"),
                            ("edited_fingerprint", "string"), ("near_edited", "double"), ("near_next", "double")]
    same(found.collect(), brute_fingerprints([r[:2] for r in rows]))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 65, 130])
def test_next_document_across_blocks(spark, n):
    data = [(3 * k, prose(k, 1 + k % 7)) for k in range(n)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    same(syncmers.document_fingerprints(docs).collect(), brute_fingerprints(data))


def test_rows_that_repeat_id_and_text(spark):
    data = [(5, "a text that is there five times over")] * 5 + [(5, "another text of the same id"), (2, None), (2, ""), (9, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    same(syncmers.document_fingerprints(docs).collect(), brute_fingerprints(data))


def test_many_copies_come_back(spark):
    docs = spark.createDataFrame([(5, "one text")], "doc_id long, text string").crossJoin(spark.range(25_001)).drop("id")
    assert syncmers.document_fingerprints(docs).count() == 25_001


def test_anchors_are_dense_and_free_of_context(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("abcdefgh ÄλЖ😀\n") for _ in range(rng.randint(0, 1500))) for _ in range(40)]
    texts += ["a" * 700, "ab" * 400, "x" * 19, "x" * 20, "😀" * 300]
    frame = spark.createDataFrame([(t, t[200:] + t[:200]) for t in texts], "a string, b string")
    got = frame.select("a", syncmers.anchors(F.col("a")).alias("x"), syncmers.likeness(
        syncmers.anchors(F.col("a")), syncmers.anchors(F.col("b"))).alias("near")).collect()
    for row in got:
        assert row.x == brute_codes(row.a)
        assert all(c >> 32 <= syncmers.K - syncmers.S for c in row.x)
    moved = [r.near for r in got if len(r.a) > 800]
    assert moved and min(moved) > 0.9  # moved passages keep their anchors


def test_anchors_of_rows_are_compiled(spark):
    """hashes and window minima of a text's code points are columns; functions of array elements are interpreted."""
    rng, c, k = random.Random(5), syncmers.CHUNK, syncmers.K
    sizes = [0, 1, k - 1, k, k + 1, c - 1, c, c + 1, c + k - 2, c + k - 1, c + k, 2 * c, 2 * c + k - 1, 5 * c + 7]
    data = [(n % 3, n, "".join(rng.choice("abcdefgh ÄλЖ😀\n") for _ in range(n))) for n in sizes]
    data += [(7, 1, "a" * 700), (7, None, "ab" * 400), (None, 1, "x" * 20)]
    frame = spark.createDataFrame(data, "block int, place int, text string").repartition("block")
    found = syncmers.with_anchors(frame, ("block", "place"))
    same([(*r[:3], r.packed) for r in found.select("block", "place", "text", "packed").collect()],
         [(*r[:3], r.packed) for r in frame.select("*", syncmers.positions(F.col("text")).alias("packed")).collect()])
    query = syncmers.document_fingerprints(frame.select(F.col("place").alias("doc_id"), "text"))
    plan = query._jdf.queryExecution().optimizedPlan().toString()
    cut = next(line for line in plan.splitlines() if "regexp_extract_all" in line)
    assert "xxhash64" not in cut and "sequence" not in cut
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1  # that of ``frame``


# Ranked search ------------------------------------------------------------------------------------------------------

def brute_terms(text):
    return re.findall(ranked_search.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, k):
    counted = [(i, Counter(t), len(t)) for i, t in ((i, brute_terms(t)) for i, t in docs) if t]
    n_docs, n_terms = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for doc_id, c, n in counted:
            m = 100 - 25 + 25 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                        for t in brute_terms(text) if c[t])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scored)[:k], 1)]
    return out


def items_of(rows):
    texts = [r[1] for r in rows if r[1]]
    items = [(k, t[:200]) for k, t in enumerate(texts[:12])]
    return items + [(50, "the the river, THE stone"), (51, None), (52, ""), (53, "zzzunknown"), (50, "garden"), (None, "quiet light"),
                    (54, "Σ ΑΣ é tab AND"), (55, "winter winter table"), (55, "winter winter table"), (56, " ".join(texts[:3]))]


@pytest.mark.parametrize(("k", "width", "most_items"), [(20, 4096, 2048), (3, 16, 4), (1, 1, 1000)])
def test_search(spark, docs, rows, k, width, most_items):
    items = items_of(rows)
    frame = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, rank int").repartition(3)
    found = ranked_search.ranked_search(docs.repartition(6), frame, k=k, width=width, most_items=most_items)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    same(found.collect(), brute_search([r[:2] for r in rows], items, k))


def test_search_of_nothing(spark, docs, no_docs):
    items = spark.createDataFrame([(1, "river stone")], "item_id long, text string")
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert ranked_search.ranked_search(no_docs, items).collect() == []
    assert ranked_search.ranked_search(docs, nothing).collect() == []
    assert ranked_search.ranked_search(docs.where("text is null"), items).collect() == []


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = " ".join(f"Word{k % 97}É-x" for k in range(3000))
    expected = (Counter(t.encode() for t in brute_terms(text)), len(brute_terms(text)))
    assert ranked_search.term_counts(text) == expected
    monkeypatch.setattr(ranked_search, "PIECE", 64)
    assert ranked_search.term_counts(text) == expected
    assert ranked_search.term_counts("y" * 500) == (Counter([b"y" * 500]), 1)


def test_sketches_bound_scores_and_spare_work():
    rng = random.Random(5)
    words = [f"w{int(rng.paretovariate(0.7)) % 4000}" for _ in range(60_000)]
    counted = [ranked_search.term_counts(" ".join(words[a:a + 60])) for a in range(0, 60_000, 60)]
    n_terms = sum(n for _, n in counted)
    df = Counter(t for c, _ in counted for t in c)
    wanted = [[(t, n * ranked_search.weight(len(counted), df[t])) for t, n in c.items()] for c, _ in counted[::100]]
    items = ranked_search.Items(wanted, 512)
    for counts, n in counted[:200]:
        m = ranked_search.length_factor(n, len(counted), n_terms)
        sketch = np.zeros((1, len(items.weights)))
        items.sketch(counts, m, sketch[0])
        bounds = items.bounds(sketch)[0]
        assert all(bounds[q] >= items.score(q, counts, m) for q in range(len(wanted)))
    best = [ranked_search.Best(5) for _ in wanted]
    rescored = sum(ranked_search.search_batch(items, list(range(a, a + 50)), counted[a:a + 50], best, len(counted), n_terms)
                   for a in range(0, len(counted), 50))
    assert rescored < 0.5 * len(counted) * len(wanted)


# Centroids ----------------------------------------------------------------------------------------------------------

def brute_clusters(rows, width, k, rounds, scale=64):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None))
    centers = [v for _, v in order[:k]]
    if not centers:
        return []
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min((far(v, c), n) for n, c in enumerate(centers)) for _, v in kept]
    for _ in range(rounds):
        own = assign()
        for n in range(len(centers)):
            members = [v for (_, v), (_, m) in zip(kept, own, strict=True) if m == n]
            if members:
                centers[n] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    own = assign()
    inertia = Counter()
    for d, n in own:
        inertia[n] += d
    shown = lambda x: x if x < 2**63 else None
    return [(i, n, shown(d), shown(inertia[n]), shown(sum(inertia.values())),
             hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()) for (i, _), (d, n) in zip(kept, own, strict=True)]


VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                        T.StructField("cluster", T.IntegerType()), T.StructField("Ids", T.StringType())])


def vectors(n, width, seed, spread=1.0):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(width)] for _ in range(6)]
    rows = [(i, [float(np.float32(x + spread * rng.gauss(0, 0.1))) for x in rng.choice(middles)]) for i in range(n)]
    return rows + [(3, None), (4, []), (5, [0.5] * (width + 1)), (6, [0.5] * (width - 1) + [None]), (7, [float("nan")] * width),
                   (8, [float("-inf")] * width), (None, [0.25] * width), (9, [0.25] * width), (9, [0.25] * width), (9, [-0.25] * width)]


@pytest.mark.parametrize(("n", "width", "k", "block"), [(300, 8, 16, 4096), (300, 8, 16, 7), (200, 3, 5, 64), (4, 4, 16, 2), (50, 2, 1, 8)])
def test_clusters(spark, n, width, k, block):
    rows = vectors(n, width, n + k)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS).repartition(3)
    found = centroids.centroid_clusters(frame, k=k, width=width, block=block)
    assert found.dtypes == [("vec_id", "bigint"), ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"),
                            ("inertia", "bigint"), ("centroid_sha256", "string")]
    same(found.collect(), brute_clusters(rows, width, k, 3))


def test_huge_components(spark):
    rng = random.Random(1)
    sizes = [1e-3, 1.0, 2.0**20, 1e9, 1e17, 3e38]
    rows = [(i, [float(np.float32(rng.uniform(-1, 1) * sizes[i % 6])) for _ in range(4)]) for i in range(90)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS).repartition(2)
    same(centroids.centroid_clusters(frame, k=4, width=4, block=16).collect(), brute_clusters(rows, 4, 4, 3))
    doubles = [(i, [rng.uniform(-1, 1) * 10.0 ** (i * 7) for _ in range(3)]) for i in range(44)]
    frame = spark.createDataFrame(doubles, "vec_id long, embedding array<double>")
    same(centroids.centroid_clusters(frame, k=3, width=3).collect(), brute_clusters(doubles, 3, 3, 3))


def test_no_vectors(spark):
    assert centroids.centroid_clusters(spark.createDataFrame([], VECTORS)).collect() == []
    only_null = spark.createDataFrame([(None, [0.5, 0.5], 1, "x"), (1, [0.5], 1, "x")], VECTORS)
    assert centroids.centroid_clusters(only_null, width=2).collect() == []


def test_heaps_spare_rescans(spark):
    rows = vectors(2000, 6, 4, spread=0.2)
    history = []
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], VECTORS)
    centroids.centroid_clusters(frame, k=6, width=6, rounds=8, history=history)
    assert len(history) == 9 and history[0] >= 2000 and history[-1] < 0.2 * history[0]


def test_limbs():
    for x in (0, 1, -1, 2**40, -2**40, 2**200 + 12345, -(2**200) - 12345):
        digits = centroids.limbs(x)
        assert sum(d << (40 * k) for k, d in enumerate(digits)) == x and all(abs(d) <= 2**40 for d in digits)
