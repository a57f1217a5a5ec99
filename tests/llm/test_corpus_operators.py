import itertools
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tests.llm.conftest import SCHEMA, prose, same

from ledgerloom.llm import components, mixing, simhash, topk


# Exact search -------------------------------------------------------------------------------------------------------

def brute_top(vectors, k):
    out = []
    usable = [(i, [int(np.floor(64 * float(np.float32(x)))) for x in v]) for i, v in vectors
              if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    for at, (q, own) in enumerate(usable):
        if q % 20 == 0:
            scores = sorted((-sum(a * b for a, b in zip(own, w, strict=True)), c)
                            for n, (c, w) in enumerate(usable) if n != at and len(w) == len(own))
            out += [(q, r, c, -s if abs(s) < 2**63 else None) for r, (s, c) in enumerate(scores[:k], 1)]
    return out


@pytest.mark.parametrize(("n", "block", "shard", "fan_in"), [(400, 4, 30, 2), (400, 2048, 16384, 16), (15, 2, 3, 2)])
def test_top_k(spark, n, block, shard, fan_in):
    rng = random.Random(n)
    vectors = [(i, [rng.choice([-0.5, -0.25, 0.0, 0.3, 0.5]) for _ in range(4)]) for i in range(n)]
    vectors += [(40, vectors[0][1]), (41, vectors[1][1]), (n + 20, None), (None, [0.1] * 4), (n + 41, [0.1, None, 0.1, 0.1]),
                (n + 42, [0.1, float("nan"), 0.0, 0.0]), (n + 43, [float("inf"), 0.0, 0.0, 0.0]), (1000, [0.5, 0.5]), (1001, [1.0, 1.0])]
    rows = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors], "vec_id long, embedding array<float>, id int, q int").repartition(4)
    found = topk.top_k(rows, F.col("vec_id") % 20 == 0, query_block=block, shard=shard, fan_in=fan_in)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    same(found.collect(), brute_top(vectors, 20))


@pytest.mark.parametrize("sizes", [[1.0, 1e8, 1e9], [1e-3, 1.0, 1e17, 3e38], [3e38]])
def test_top_k_of_huge_components(spark, sizes):
    rng = random.Random(len(sizes))
    vectors = [(i, [float(np.float32(rng.choice([-1, 1, 0.3]) * rng.choice(sizes))) for _ in range(3)]) for i in range(70)]
    vectors += [(60, vectors[3][1])] * 3 + [(61, vectors[4][1])] * 2
    rows = spark.createDataFrame(vectors, "vec_id long, embedding array<float>").repartition(3)
    for block, shard in ((2, 9), (2048, 16384)):
        found = topk.top_k(rows, F.col("vec_id") % 20 == 0, k=8, query_block=block, shard=shard, fan_in=2)
        same(found.collect(), brute_top(vectors, 8))


def test_top_k_of_nothing(spark):
    rows = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(rows, F.col("vec_id") % 20 == 0).collect() == []
    rows = spark.createDataFrame([(1, [0.5])], "vec_id long, embedding array<float>")
    assert topk.top_k(rows, F.col("vec_id") % 20 == 0).collect() == []


def test_large_components_stay_exact():
    a, b = np.array([[2**40, 3]]), np.array([[2**40 + 1, 5], [7, 2**41]])
    assert topk.products(a, b)(slice(0, 1), slice(0, 2)).tolist() == [[2**40 * (2**40 + 1) + 15, 7 * 2**40 + 3 * 2**41]]


# SimHash ------------------------------------------------------------------------------------------------------------

def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 2:
            parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_simhash_query(spark, docs, no_docs, rows):
    prints = [brute_print(r[1]) for r in rows]
    groups = brute_groups(set(prints))
    first = {}
    for r, p in zip(rows, prints, strict=True):
        if r[0] is not None:
            first[groups[p]] = min(r[0], first.get(groups[p], r[0]))
    expected = [(r[0], f"{p:016x}", first.get(groups[p])) for r, p in zip(rows, prints, strict=True)]
    same(simhash.near_duplicates(docs).collect(), expected)
    assert simhash.near_duplicates(no_docs).collect() == [] and simhash.one_of_each_group(no_docs).collect() == []
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    assert sorted(groups[brute_print(r.text)] for r in left) == sorted(set(groups.values()))
    for r in left:
        assert r.doc_id == first.get(groups[brute_print(r.text)])


def test_golay_keys_meet():
    rng = random.Random(2)
    for _ in range(1000):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(1, 2)):
            y ^= 1 << b
        row, key, listed = simhash.keys(np.array([x, y], np.uint64).view(np.int64))
        assert set(key[(row == 0) & listed]) & set(key[row == 1]) and set(key[(row == 1) & listed]) & set(key[row == 0])


@pytest.mark.parametrize("max_bits", [0, 1, 2])
@pytest.mark.parametrize("bucket", [0, 3, 32])
def test_links_give_the_same_groups_with_any_bucket(spark, bucket, max_bits):
    rng = random.Random(7)
    prints = {rng.getrandbits(64) for _ in range(50)}
    for p in sorted(prints)[:6]:  # crowds: chains of near fingerprints
        for _ in range(40):
            for b in rng.sample(range(64), rng.randint(1, 2)):
                p ^= 1 << b
            prints.add(p)
    signed = {p: int(np.array(p, np.uint64).astype(np.int64)) for p in prints}
    fps = spark.createDataFrame([(s,) for s in signed.values()], "fp long").repartition(3)
    edges = {tuple(r) for r in simhash.links(fps, max_bits, bucket).collect()}
    back = {s: p for p, s in signed.items()}
    assert all((back[a] ^ back[b]).bit_count() <= max(2, max_bits) for a, b in edges)
    found = {r.node: r.root for r in components.components(simhash.links(fps, max_bits, bucket)).collect()}
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= max_bits:
            parent[find(a)] = find(b)
    mine = lambda p: found.get(signed[p], signed[p])
    groups = {}
    for p in prints:
        groups.setdefault(find(p), set()).add(mine(p))
    assert all(len(g) == 1 for g in groups.values()) and len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(500)] + [(1000, 1000), (2000, 2001), (2001, 2000)], "a long, b long")
    found = {r.node: r.root for r in components.components(edges).collect()}
    assert found == {**dict.fromkeys(range(501), 0), 2000: 2000, 2001: 2000}


# Mixing -------------------------------------------------------------------------------------------------------------

def test_targets():
    t = mixing.target_words({"b": 100, "a": 100, None: 100})
    assert t == {"a": 200, "b": Fraction(250, 3), None: Fraction(500, 3)}
    assert mixing.target_words({"x": 10}) == {"x": 15} and mixing.target_words({}) == {} and mixing.target_words({"x": 0}) == {"x": 0}


def test_route_is_a_cheapest_flow():
    patterns = [(["a"], 4), (["a", "b"], 3), (["b"], 2)]
    for qa, qb in itertools.product(range(0, 15, 2), range(0, 12, 3)):
        best = None
        for a1, b1, b2 in itertools.product(range(9), range(7), range(7)):
            for c in range(5):
                if b1 + b2 <= 6 and a1 + b1 <= qa and b2 + c <= qb:
                    price = sum(min(f, w) + 3 * max(0, f - w) for f, (_, w) in zip((a1, b1 + b2, c), patterns, strict=True))
                    best = min(best or (0, 0), (-(a1 + b1 + b2 + c), price))
        flow = mixing.route(patterns, {"a": qa, "b": qb})
        price = sum(min(f, w) + 3 * max(0, f - w) for f, (_, w) in zip(flow, patterns, strict=True))
        assert (-sum(flow), price) == best


def test_chosen_documents_come_near():
    rng = random.Random(4)
    for _ in range(200):
        sizes = [rng.choice([0, 5, 60, 300, 900, 4000]) + rng.randrange(50) for _ in range(rng.randint(0, 9))]
        room = rng.randint(1, sum(sizes) + 1)
        taken = mixing.chosen(sizes, room)
        assert len(set(taken)) == len(taken) and all(sizes[k] for k in taken)
        left = abs(room - sum(sizes[k] for k in taken))
        free = set(range(len(sizes))) - set(taken)
        for a in [None, *free]:  # no exchange of one for one comes closer
            for b in [None, *taken]:
                new = sum(sizes[k] for k in taken) + (sizes[a] if a is not None else 0) - (sizes[b] if b is not None else 0)
                assert left <= abs(room - new)


@pytest.mark.parametrize("per_bucket", [3, 2000])
def test_mix_query(docs, no_docs, rows, per_bucket):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    targets = mixing.target_words(dict(sizes))
    found = mixing.words_taken(docs, docs_per_bucket=per_bucket)
    got = found.collect()
    same(got, mixing.words_taken(docs.repartition(7), docs_per_bucket=per_bucket).collect())
    same([r[:4] for r in got], [(r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")), sizes[r[3]], float(targets[r[3]])) for r in rows])
    taken = Counter()
    for r in got:
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.target] += r.taken
    longest = {s: max(r.size for r in got if r.target == float(t)) for s, t in targets.items()}
    for s, t in targets.items():  # whole documents: half of the longest may be over or under
        assert abs(taken[float(t)] - t) <= longest[s] / 2, s
    mixed = mixing.mixed_documents(docs, docs_per_bucket=per_bucket)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter(
        {d: n for d, n in ((d, sum(r.epochs for r in got if r.doc_id == d)) for d in {r.doc_id for r in got}) if n})
    assert mixing.words_taken(no_docs).collect() == [] and mixing.mixed_documents(no_docs).collect() == []


def test_overlapping_sources(spark):
    rows = [(k, prose(k, 50), ["a", "b"] if k % 3 == 0 else ["a"] if k % 3 == 1 else ["b"]) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    found = mixing.mix(docs, F.col("sources"))
    assert found.sizes == {"a": 3000, "b": 3000}
    assert found.rows.agg(F.sum(F.col("size") * F.col("epochs"))).first()[0] == 9000


# Pipeline -----------------------------------------------------------------------------------------------------------

def test_pipeline(spark, tmp_path):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    from ledgerloom.llm import quality_rules, secret_scan
    from tests.llm.conftest import awkward_rows
    extra = [(500, prose(900, 200) + " password=hX9kq2vLmzPq", "en", "b", None, *[None] * 14)]
    spark.createDataFrame(awkward_rows() + extra, SCHEMA).repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, steps[-1], str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        steps.append(spark.read.parquet(f"{tmp_path}/{k}"))
    assert all(s.columns == docs.columns for s in steps[:-1])
    rows = [s.collect() for s in steps]
    rules = quality_rules.Rules()
    import zstandard
    packer = zstandard.ZstdCompressor(level=rules.level)
    same([r.doc_id for r in rows[1]] and [(r.doc_id,) for r in rows[1]],
         [(r.doc_id,) for r in rows[0] if quality_rules.judge(r.text or "", rules, packer)[6]])
    groups = brute_groups({brute_print(r.text) for r in rows[1]})
    assert sorted(groups[brute_print(r.text)] for r in rows[2]) == sorted(set(groups.values()))
    same([(r.doc_id, r.text) for r in rows[3]],
         [(r.doc_id, secret_scan.redacted(r.text, secret_scan.GuessRules(), "[SECRET]")) for r in rows[2]])
    assert not any("hX9kq2vLmzPq" in r.text for r in rows[3]) and any("[SECRET]" in r.text for r in rows[3])
    assert {r.doc_id for r in rows[4]} <= {r.doc_id for r in rows[3]} and max(Counter(r.doc_id for r in rows[4]).values()) == 2
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    same([(r.doc_id, r.source, r.ids) for r in rows[5]],
         [(r.doc_id, r.source, library.encode(r.text, add_special_tokens=False).ids) for r in rows[4]])
    same(corpus_pipeline.run(spark, str(tmp_path)).collect(), rows[5])


def test_empty_pipeline(spark, tmp_path):
    import corpus_pipeline
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
