"""Centroid clustering with heap-ordered bounds, exact in whole numbers.

Vectors become whole numbers (floor of ``scale`` times each component) and are packed, within their own task, into
blocks of at most ``block`` rows; nothing is shuffled.  A block keeps, for each cluster, a heap of the gaps between the
distances to the nearest and the second nearest centroid.  The key of a heap entry is the gap at the time of its
rescan plus the cluster's drift until then, where a cluster drifts in each round by its own centroid's move and the
largest move of any other.  While a key is above its cluster's drift, no other centroid can have come as near,
so a round pops the expired entries only, compares those vectors with all centroids exactly and pushes them
anew.  Keys are lowered by a margin above the rounding of their square roots.

A round is a map over blocks, written to the shared folder.  Each block adds up its clusters; Spark adds the blocks,
and the driver sees one number for each cluster and component.  Sums travel in limbs of 40 bits, so they are exact
for any finite component.

Defined cases: vectors that are null, of another length, or with a null or non-finite component take no part; rows
that repeat an id count each for itself; a null id may be a member but no seed; of equal hashes the smaller vector
comes first; fewer vectors than clusters make as many clusters; of equal distances the smaller cluster number
wins, so the second of two equal seeds stays empty and keeps its centroid; a distance or inertia beyond long is
null; no vectors give an empty result.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.common import checkpointed, prepare

BLOCK, LIMB = 4096, 40
#: Components up to this go through 64-bit arithmetic; a block with larger ones uses Python's integers.
SMALL = 1 << 26
LONG_MAX = 2**63 - 1

STATE = T.StructType([
    T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("kind", T.StringType()),
    T.StructField("vectors", T.BinaryType()), T.StructField("labels", T.BinaryType()),
    T.StructField("keys", T.BinaryType()), T.StructField("members", T.BinaryType()),
    T.StructField("lengths", T.BinaryType()), T.StructField("rescanned", T.LongType()),
    # cluster, limb, rows of the cluster, its summed components with its squared distance last
    T.StructField("sums", T.ArrayType(T.StructType([
        T.StructField("cluster", T.IntegerType()), T.StructField("limb", T.IntegerType()),
        T.StructField("n", T.LongType()), T.StructField("values", T.ArrayType(T.LongType()))])))])


@dataclass
class Block:
    """``heaps``: for each cluster a heap of (key, row)."""
    ids: list
    vectors: np.ndarray
    labels: np.ndarray
    heaps: list[list[tuple[float, int]]]


# Whole numbers ------------------------------------------------------------------------------------------------------

def whole(rows: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x): int64 where all are small, else Python integers."""
    scaled = np.floor(rows.astype(np.float64) * scale) if rows.size else np.zeros(rows.shape)
    if not np.isfinite(scaled).all():  # doubles near their end
        return np.array([[math.floor(int(x) * scale) if abs(x) > 2**60 else math.floor(x * scale) for x in row]
                         for row in rows.tolist()], dtype=object).reshape(rows.shape)
    if scaled.size == 0 or np.abs(scaled).max() < SMALL:
        return scaled.astype(np.int64)
    return np.array([[int(x) for x in row] for row in scaled.tolist()], dtype=object).reshape(rows.shape)


def _fits(*numbers: np.ndarray) -> bool:
    return all(m.dtype != object for m in numbers)


def _matrix(centroids: list[list[int]]) -> np.ndarray:
    small = all(abs(x) < SMALL for c in centroids for x in c)
    return np.array(centroids, dtype=np.int64 if small else object)


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared Euclidean distances, rows x centroids."""
    if not _fits(vectors, centroids):
        vectors, centroids = vectors.astype(object), centroids.astype(object)
        return np.stack([((vectors - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    most = max(int(np.abs(vectors).max(initial=0)), int(np.abs(centroids).max(initial=0)))
    kind = np.float64 if 4 * most * most * vectors.shape[1] < 1 << 53 else np.int64
    a, b = vectors.astype(kind), centroids.astype(kind)
    out = (a * a).sum(axis=1)[:, None] - 2 * (a @ b.T) + (b * b).sum(axis=1)[None, :]
    return out.astype(np.int64)


def _root(x) -> float:
    """Square root as a float, infinite beyond floats."""
    try:
        return math.sqrt(x)
    except OverflowError:
        return math.inf


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector (ties: the smaller number), and the gap to the second nearest, lowered by a
    margin above its rounding error; a gap that floats cannot hold counts as none."""
    d = squared_distances(vectors, centroids)
    labels = np.argmin(d, axis=1) if d.dtype != object else np.array(
        [min(range(len(r)), key=r.__getitem__) for r in d], dtype=np.int64)
    if d.shape[1] == 1:
        return labels, np.full(len(d), np.inf)
    if d.dtype == object:
        two = [sorted(r)[:2] for r in d]
        low, high = (np.array([_root(t[k]) for t in two]) for k in (0, 1))
    else:
        part = np.sqrt(np.partition(d, 1, axis=1)[:, :2].astype(np.float64))
        low, high = part[:, 0], part[:, 1]
    with np.errstate(invalid="ignore"):
        gaps = high - low - 1e-9 * (1.0 + high + low)
    return labels, np.where(np.isfinite(gaps), gaps, -np.inf)


def own_distances(vectors: np.ndarray, labels: np.ndarray, centroids: np.ndarray) -> list[int]:
    if not _fits(vectors, centroids):
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    diff = vectors - centroids[labels]
    return [int(x) for x in (diff * diff).sum(axis=1)]


def drifts(old: list[list[int]], new: list[list[int]]) -> list[float]:
    """How much each cluster's gaps shrink at most when its centroid and the others move."""
    moves = [_root(sum((a - b) ** 2 for a, b in zip(x, y, strict=True))) * (1 + 1e-9) for x, y in zip(old, new, strict=True)]
    return [m + max([*moves[:k], *moves[k + 1:]], default=0.0) for k, m in enumerate(moves)]


# Blocks -------------------------------------------------------------------------------------------------------------

def assign_all(block: Block, centroids: np.ndarray) -> int:
    """First round: every vector is compared with all centroids."""
    block.labels, gaps = nearest(block.vectors, centroids)
    block.heaps = [[] for _ in centroids]
    for row, (label, gap) in enumerate(zip(block.labels.tolist(), gaps.tolist(), strict=True)):
        block.heaps[label].append((gap, row))
    for heap in block.heaps:
        heapq.heapify(heap)
    return len(block.ids)


def reassign(block: Block, centroids: np.ndarray, drift: list[float]) -> int:
    """Later rounds: pops the vectors whose gap has expired, rescans them and pushes them anew."""
    expired = []
    for heap, gone in zip(block.heaps, drift, strict=True):
        while heap and heap[0][0] <= gone:
            expired.append(heapq.heappop(heap)[1])
    if expired:
        labels, gaps = nearest(block.vectors[expired], centroids)
        block.labels[expired] = labels
        for row, label, gap in zip(expired, labels.tolist(), gaps.tolist(), strict=True):
            heapq.heappush(block.heaps[label], (gap + drift[label], row))
    return len(expired)


def limbs(value: int) -> list[int]:
    """``value`` in 40-bit digits, lowest first; the last one has the sign."""
    out = []
    while not -(1 << LIMB) < value < 1 << LIMB:
        out.append(value & ((1 << LIMB) - 1))
        value >>= LIMB
    return [*out, value]


def block_sums(block: Block, centroids: np.ndarray) -> list[dict]:
    distances = own_distances(block.vectors, block.labels, centroids)
    out = []
    for cluster in np.unique(block.labels).tolist():
        rows = np.flatnonzero(block.labels == cluster)
        totals = [int(x) for x in block.vectors[rows].sum(axis=0)] + [sum(distances[r] for r in rows.tolist())]
        digits = [limbs(x) for x in totals]
        for k in range(max(map(len, digits))):
            out.append({"cluster": cluster, "limb": k, "n": 0 if k else len(rows),
                        "values": [d[k] if k < len(d) else 0 for d in digits]})
    return out


def pack(block: Block, rescanned: int, centroids: np.ndarray) -> dict:
    if block.vectors.dtype == object:
        kind, data = "big", ",".join(str(x) for x in block.vectors.ravel()).encode()
    else:
        low, high = int(block.vectors.min(initial=0)), int(block.vectors.max(initial=0))
        kind = next(k for k in ("i1", "i2", "i4") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
        data = block.vectors.astype(kind).tobytes()
    entries = [e for heap in block.heaps for e in heap]
    return {"ids": block.ids, "kind": kind, "vectors": data, "labels": block.labels.astype(np.int32).tobytes(),
            "keys": np.array([e[0] for e in entries], np.float64).tobytes(),
            "members": np.array([e[1] for e in entries], np.int32).tobytes(),
            "lengths": np.array([len(h) for h in block.heaps], np.int32).tobytes(),
            "rescanned": rescanned, "sums": block_sums(block, centroids)}


def unpack(row: dict, width: int) -> Block:
    if row["kind"] == "big":
        vectors = np.array([int(x) for x in row["vectors"].split(b",")], dtype=object).reshape(-1, width)
    else:
        vectors = np.frombuffer(row["vectors"], row["kind"]).reshape(-1, width).astype(np.int64)
    entries = list(zip(np.frombuffer(row["keys"]).tolist(), np.frombuffer(row["members"], np.int32).tolist(), strict=True))
    cuts = [0, *np.cumsum(np.frombuffer(row["lengths"], np.int32)).tolist()]
    return Block(row["ids"], vectors, np.frombuffer(row["labels"], np.int32).astype(np.int64),
                 [entries[a:b] for a, b in zip(cuts, cuts[1:])])


# Spark --------------------------------------------------------------------------------------------------------------

def _row(schema: pa.Schema, out: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([out[f.name]], f.type) for f in schema], schema=schema)


def _packed(rows: DataFrame, scale: int, block: int, width: int, centroids: list[list[int]]) -> DataFrame:
    """The vectors of each task in blocks, assigned to the first centroids."""
    schema = to_arrow_schema(STATE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _matrix(centroids)

        def made(ids: list, values: list) -> pa.RecordBatch:
            found = Block(ids, whole(np.concatenate(values).reshape(-1, width), scale), np.empty(0), [])
            return _row(schema, pack(found, assign_all(found, table), table))

        ids, values = [], []
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                ids += part.column(0).to_pylist()
                values.append(part.column(1).flatten().to_numpy(zero_copy_only=False))
                if len(ids) >= block:
                    yield made(ids, values)
                    ids, values = [], []
        if ids:
            yield made(ids, values)

    return rows.mapInArrow(run, STATE)


def _each_block(state: DataFrame, width: int, work: Callable[[Block], pa.RecordBatch], schema: T.StructType) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                yield work(unpack(batch.slice(k, 1).to_pylist()[0], width))

    return state.mapInArrow(run, schema)


def _reassigned(state: DataFrame, width: int, centroids: list[list[int]], drift: list[float]) -> DataFrame:
    schema = to_arrow_schema(STATE)

    def work(block: Block) -> pa.RecordBatch:
        table = _matrix(centroids)
        return _row(schema, pack(block, reassign(block, table, drift), table))

    return _each_block(state, width, work, STATE)


def _totals(state: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Cluster -> rows, and exact sums of its components and (last) its squared distances."""
    part = (state.select(F.explode("sums").alias("s"))
            .select("s.cluster", "s.limb", "s.n", F.posexplode("s.values").alias("at", "value")))
    rows = part.groupBy("cluster", "limb", "at").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).alias("value"), F.sum("n").alias("n")).collect()
    width = 1 + max((r.at for r in rows), default=-1)
    out = {r.cluster: (0, [0] * width) for r in rows}
    for r in rows:
        n, sums = out[r.cluster]
        sums[r["at"]] += int(r.value) << (LIMB * r.limb)
        out[r.cluster] = (n + (r.n if r["at"] == 0 else 0), sums)
    return out


def centroid_text(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


RESULT = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("cluster", T.IntegerType()),
    T.StructField("distance", T.LongType()), T.StructField("cluster_inertia", T.LongType()),
    T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())])


def usable(vector: Column, width: int) -> Column:
    return (F.size(vector) == width) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def centroid_clusters(rows: DataFrame, k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, seed: int = 1,
                      id_col: str = "vec_id", vector_col: str = "embedding", block: int = BLOCK,
                      history: list | None = None) -> DataFrame:
    """One row per usable vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    ``history`` (optional) gets the number of vectors that each round compared with all centroids."""
    spark = prepare(rows.sparkSession)
    kept = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where(usable(F.col("v"), width))
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.where("id is not null").orderBy(hashed, "v").limit(k).select("v").collect()
    centroids = [[int(x) for x in whole(np.array([r.v], np.float64), scale)[0]] for r in first]
    if not centroids:
        return spark.createDataFrame([], RESULT)
    state = checkpointed(_packed(kept, scale, block, width, centroids))
    drift, totals = [0.0] * len(centroids), _totals(state)
    for turn in range(rounds + 1):
        if history is not None:
            history.append(state.agg(F.sum("rescanned")).first()[0])
        if turn == rounds:
            break
        moved = [[s // totals[c][0] for s in totals[c][1][:width]] if c in totals else old
                 for c, old in enumerate(centroids)]
        drift = [a + b for a, b in zip(drift, drifts(centroids, moved), strict=True)]
        centroids = moved
        state = checkpointed(_reassigned(state, width, centroids, drift))
        totals = _totals(state)
    shown = lambda x: x if x <= LONG_MAX else None
    inertia = {c: shown(sums[-1]) for c, (_, sums) in totals.items()}
    whole_inertia = shown(sum(sums[-1] for _, sums in totals.values()))
    digests = [centroid_text(c) for c in centroids]
    schema = to_arrow_schema(RESULT)

    def result(found: Block) -> pa.RecordBatch:
        labels = found.labels.tolist()
        columns = [found.ids, labels, [shown(x) for x in own_distances(found.vectors, found.labels, _matrix(centroids))],
                   [inertia[c] for c in labels], [whole_inertia] * len(labels), [digests[c] for c in labels]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return _each_block(state, width, result, RESULT)


def oracle(k: int = 16, rounds: int = 3, width: int = 64, scale: int = 64, seed: int = 1) -> str:
    """DuckDB SQL for :func:`centroid_clusters` over ``embeddings`` with distances within long."""
    square = f"list_sum(list_transform(range(1, {width + 1}), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))"
    parts = [f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, vec_id,
    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
             f"""c0 AS MATERIALIZED (
  SELECT CAST(c - 1 AS INTEGER) AS c, e FROM (
    SELECT e, row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), e) AS c
    FROM v WHERE vec_id IS NOT NULL) WHERE c <= {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT row_no, unnest(min(struct_pack(d := CAST({square} AS BIGINT), c := c.c))) FROM v, c{r} c GROUP BY row_no)""")
        if r < rounds:
            parts.append(f"""s{r} AS MATERIALIZED (
  SELECT c, i, sum(x) AS s, count(*) AS n FROM (
    SELECT a.c, unnest(v.e) AS x, unnest(range(1, {width + 1})) AS i FROM a{r} a JOIN v USING (row_no)) GROUP BY c, i)""")
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.c, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN (
    SELECT c, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY i) AS e FROM s{r} GROUP BY c) m USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a.c AS cluster, a.d AS distance,
  CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} a JOIN v USING (row_no) JOIN c{rounds} c ON a.c = c.c"""
