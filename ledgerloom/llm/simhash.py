"""SimHash near-duplicates, with candidates from Golay codes.

A fingerprint has bit i set if more than half of the document's shingle hashes have it set.  Two
fingerprints link if at most ``max_bits`` (2) bits differ; components of links are the groups.

Candidates.  The 64 bits are three segments of 23, 23 and 18 bits (padded with zeros to 23).  Of two
fingerprints that differ in at most two bits, some segment is equal and some other differs in at most one
bit (pigeonhole).  The perfect binary Golay code has a codeword within 3 bits of every 23-bit word;
two words that differ in one bit have a codeword that is the nearest one of the first and within 4 bits of
the second.  So each fingerprint is listed, for each ordered pair of segments, under the first
segment's bits and the index of the second segment's nearest codeword; and it asks for the indices of all
codewords within 4 bits (1 or 6).  The join of both, and a check of the differing bits, finds every
link.  Keys are of *distinct* fingerprints, so exact copies cost nothing.

Large buckets.  Where more than ``max_bucket`` fingerprints are listed under one key, the fingerprints that
list or ask for it take an exact second way: two fingerprints link if and only if some point is within
one bit of both, and at most 65 fingerprints are within one bit of a point.  Grouping the 65 points around
each of them links them without any pair of a bucket.

Defined cases: a null text counts as empty; a text without words has fingerprint zero, and links like any
other; a null id gets a fingerprint and takes part in groups, but is never their id (a group of null ids has a
null id); repeated rows are in one group; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import checkpointed, fresh, map_arrow, schema_of
from ledgerloom.llm.components import components

SEED = 42
SEGMENTS = ((41, 23), (18, 23), (0, 18))   # shift and width
MAX_BUCKET = 32


def fingerprint(text: str, shingle: int = 3) -> int:
    """Words are runs of characters other than ASCII white space; A-Z is lower-cased."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    size = min(shingle, len(words))
    count = len(words) - size + 1
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, count, 4096):
        part = [digest(b" ".join(words[i:i + size]), SEED) for i in range(at, min(at + 4096, count))]
        bits = np.unpackbits(np.array(part, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in ``carry``, and fp: the fingerprint as a signed long."""
    keep = ["doc_id", *carry]

    def worker():
        def each(batch: pa.RecordBatch) -> dict:
            values = [fingerprint(x or "", shingle) for x in batch.column("text").to_pylist()]
            return {n: batch.column(n) for n in keep} | {"fp": np.array(values, np.uint64).view(np.int64)}
        return each

    return map_arrow(docs.select(*keep, "text"), worker, schema_of(docs, keep, ("fp", T.LongType())))


# The binary Golay code: multiples of this generator polynomial, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def _remainder(word: np.ndarray) -> np.ndarray:
    out = word.copy()
    for k in range(22, 10, -1):
        out ^= np.where(out >> k & 1, GENERATOR << (k - 11), 0)
    return out


@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error word of the nearest codeword, and the six (or one) error words of weight at most 4,
    the nearest one first (-1: none)."""
    def words(weight: int) -> np.ndarray:
        return np.array([sum(1 << b for b in c) for c in combinations(range(23), weight)], np.int64)

    every = np.full((2048, 6), -1, np.int64)
    filled = np.zeros(2048, np.int64)
    for weight in range(5):
        errors = words(weight)
        for error, syndrome in zip(errors.tolist(), _remainder(errors).tolist(), strict=True):
            every[syndrome, filled[syndrome]] = error
            filled[syndrome] += 1
    return every[:, 0].copy(), every


def codeword_keys(segment: np.ndarray) -> np.ndarray:
    """Per 23-bit word: the indices of the codewords within 4 bits, nearest first; -1 where there are fewer than 6.
    The code is systematic in its upper 12 bits, which are the index."""
    errors = golay()[1][_remainder(segment)]
    return np.where(errors >= 0, (segment[:, None] ^ errors) >> 11, -1)


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, whether the fingerprint is listed under the key) of all keys of distinct fingerprints."""
    whole = fps.view(np.uint64)
    parts = [(whole >> np.uint64(s) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in SEGMENTS]
    rows, found, own = [], [], []
    for pair, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j):
        near = codeword_keys(parts[j])
        at, k = np.nonzero(near >= 0)
        rows.append(at)
        found.append((parts[i][at] << 12 | near[at, k]) << 3 | pair)
        own.append(k == 0)
    return np.concatenate(rows), np.concatenate(found), np.concatenate(own)


def _key_table(fps: DataFrame) -> DataFrame:
    """key, fp, listed."""
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("fp", T.LongType()),
                           T.StructField("listed", T.BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            at, key, listed = keys(own)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(own[at]), pa.array(listed)],
                                             names=["key", "fp", "listed"])

    return fps.mapInArrow(run, schema)


def _points(fps: DataFrame) -> DataFrame:
    """Each fingerprint with the 65 points within one bit of it."""
    flips = F.array(F.lit(0).cast("long"), *(F.lit(1 << b if b < 63 else -2**63).cast("long") for b in range(64)))
    return fps.select("fp", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("fp")))).alias("point"))


def links(fps: DataFrame, max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fps`` (fp) that differ in at most ``max_bits`` <= 2 bits: all
    of them outside large buckets, and enough of them within (the components are the same)."""
    if not 0 <= max_bits <= 2:
        raise ValueError("the keys find links of at most 2 bits")
    table = _key_table(fps)  # made anew where it is used: a few operations on each fingerprint
    large = (table.where("listed").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > max_bucket)
             .select("key"))
    small = table.join(large, "key", "left_anti")
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    pairs = (small.where("listed").select("key", F.col("fp").alias("a"))
             .join(small.select("key", F.col("fp").alias("b")), "key")
             .where((F.col("a") < F.col("b")) & (differing <= max_bits)).select("a", "b"))
    crowd = table.join(large, "key", "left_semi").select("fp").distinct()
    if max_bits == 2:
        balls = _points(crowd).groupBy("point").agg(F.collect_set("fp").alias("near"))  # at most 65
        stars = balls.select(F.array_min("near").alias("a"), F.explode("near").alias("b"))
    else:  # a link of one bit: one fingerprint is a point around the other
        stars = _points(crowd).join(crowd.select(F.col("fp").alias("point")), "point").selectExpr("fp a", "point b")
        stars = stars.where(F.lit(max_bits == 1))
    return pairs.union(stars.where("a <> b")).distinct()


def with_components(prints: DataFrame, max_bits: int = 2, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``prints`` (doc_id, fp and other columns, already written) with ``root``, the group's smallest fingerprint,
    and component_id, its smallest doc_id."""
    least = checkpointed(prints.groupBy("fp").agg(F.min("doc_id").alias("first")))
    fps = least.select("fp")
    roots = components(links(fps, max_bits, max_bucket)).withColumnRenamed("node", "fp")
    grouped = checkpointed(least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    ids = grouped.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(grouped.select("fp", "root").join(ids, "root"), "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    prints = checkpointed(fingerprints(docs, shingle))
    return with_components(prints, max_bits).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` without all but one of each group: the one with the smallest doc_id (null last), then
    the smallest hash of its text; of rows that agree in both, one."""
    mark, id_, copies = fresh(docs, "text_hash", "kept_id", "copies")
    sketch = docs.select("doc_id", "text", F.xxhash64("text").alias(mark))
    prints = checkpointed(fingerprints(sketch, shingle, (mark,)))
    grouped = with_components(prints, max_bits)
    counts = grouped.groupBy("root", F.col("doc_id").alias(id_), mark).agg(F.count("*").alias(copies))
    first = F.min(F.struct(F.col(id_).isNull().alias("none"), F.col(id_).alias("id"), F.col(mark).alias("hash"),
                           F.col(copies).alias("n")))
    kept = checkpointed(counts.groupBy("root").agg(first.alias("k"))
                        .select(F.col("k.id").alias(id_), F.col("k.hash").alias(mark), F.col("k.n").alias(copies)))

    alone = docs.join(kept.where(F.col(copies) == 1),
                      docs["doc_id"].eqNullSafe(kept[id_]) & (F.xxhash64(docs["text"]) == kept[mark]), "left_semi")
    repeated = kept.where(F.col(copies) > 1)
    if repeated.isEmpty():
        return alone
    key = docs.withColumn(mark, F.xxhash64("text"))
    chosen = (key.join(repeated.select(id_, F.col(mark).alias(mark + "2")),
                       key["doc_id"].eqNullSafe(F.col(id_)) & (key[mark] == F.col(mark + "2")), "left_semi")
              .dropDuplicates(["doc_id", mark]).select(*docs.columns))
    return alone.unionByName(chosen)
