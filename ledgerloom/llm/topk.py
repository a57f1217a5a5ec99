"""Exact top-k search by inner product, in tiles.

Queries and rows are hashed into even blocks, each packed into one row with the smallest integers that hold it.  Every
(query block, shard) tile is one task's matrix product; the tile keeps the k best of each query.  The lists of
a query block are then merged in a tree, ``fan_in`` shards at a time, so no task ever holds
more than a tile or ``fan_in`` lists.

Tiles hold a bounded number of rows, so their number grows with queries times rows, which is
what an exact search costs.  The product runs in float32 or float64 where all sums are exact
there, else on Python integers, so any finite component is exact.

Defined cases: vectors that are null, or hold a null or non-finite component, and rows with a null id take no
part; rows that repeat an id are each a row of their own, as candidates (also of one another) and as queries; vectors of
another length than the query's score nothing against it; ties go to the smaller id; with fewer than k other rows, all
are returned; a score beyond long is null, in its right place; an empty table, or no query, gives an empty result.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.centroids import LONG_MAX, SMALL, whole
from ledgerloom.llm.common import checkpointed, prepare

QUERY_BLOCK, SHARD, FAN_IN, STRIPE = 2048, 16384, 16, 2048


def _usable(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _bytes(numbers: np.ndarray) -> tuple[str, bytes]:
    """Whole numbers as the smallest integers that hold them, or as text."""
    if numbers.dtype == object:
        return "big", ",".join(map(str, numbers.ravel())).encode()
    low, high = int(numbers.min(initial=0)), int(numbers.max(initial=0))
    kind = next(k for k in ("i1", "i2", "i4", "i8") if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return kind, numbers.astype(kind).tobytes()


def _numbers(kind: str, data: bytes) -> np.ndarray:
    if kind == "big":
        return np.array([int(x) for x in data.split(b",")], dtype=object)
    return np.frombuffer(data, kind).astype(np.int64)


BLOCK = "width int, n int, ids binary, uids binary, kind string, vectors binary"


def _pack(pdf: pd.DataFrame, key: str, scale: int) -> pd.DataFrame:
    """The rows of a block as one row for each vector length (and apart those of large numbers)."""
    out = []
    for width, part in pdf.groupby(pdf["v"].map(len), sort=True):
        part = part.sort_values(["id", "uid"])
        values = np.array(part["v"].tolist(), np.float64).reshape(len(part), width)
        large = np.abs(values).max(axis=1, initial=0.0) * scale >= SMALL
        for rows in (~large, large):
            if rows.any():
                kind, data = _bytes(whole(values[rows], scale))
                out.append([int(part[key].iloc[0]), int(width), int(rows.sum()), part["id"].to_numpy(np.int64)[rows].tobytes(),
                            part["uid"].to_numpy(np.int64)[rows].tobytes(), kind, data])
    return pd.DataFrame(out, columns=[key, *(c.split()[0] for c in BLOCK.split(", "))])


def _blocks(rows: DataFrame, n_blocks: int, name: str, scale: int) -> DataFrame:
    keyed = rows.withColumn(name, F.pmod(F.xxhash64("uid"), F.lit(n_blocks)).cast("int"))
    return keyed.groupBy(name).applyInPandas(lambda pdf: _pack(pdf, name, scale), f"{name} int, {BLOCK}")


@dataclass(frozen=True)
class Rows:
    """``uids``: one for each row, also where ids repeat."""
    ids: np.ndarray
    uids: np.ndarray
    vectors: np.ndarray


def _unpack(row) -> Rows:
    return Rows(np.frombuffer(row.ids, np.int64), np.frombuffer(row.uids, np.int64),
                _numbers(row.kind, row.vectors).reshape(row.n, row.width))


def products(queries: np.ndarray, rows: np.ndarray) -> Callable[[slice, slice], np.ndarray]:
    """The function from ranges of queries and rows to their exact inner products."""
    def most(m: np.ndarray) -> int:
        return max(int(m.max()), -int(m.min())) if m.size else 0

    bound = most(queries) * most(rows) * max(queries.shape[1], 1)
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object
    a, b = queries.astype(kind), rows.astype(kind).T
    return lambda q, r: a[q] @ b[:, r]


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of a list by score, then by smaller id."""
    if scores.dtype == object:
        order = np.array(sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))[:k], np.int64)
    else:
        order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


@dataclass(frozen=True)
class Found:
    """A query's best list."""
    uid: int
    query_id: int
    ids: np.ndarray
    scores: np.ndarray


def tile_best(queries: Rows, rows: Rows, k: int) -> list[Found]:
    """For each query its k best rows of the shard.  Rows come in stripes; a stripe's products are only
    looked at where they reach the query's k-th best so far."""
    score = products(queries.vectors, rows.vectors)
    out = []
    for start in range(0, len(queries.ids), 256):
        q = slice(start, start + 256)
        uids = queries.uids[q]
        lists: list[tuple] = [(np.empty(0, np.int64), None)] * len(uids)
        least = None
        for at in range(0, len(rows.ids), STRIPE):
            ids, others = rows.ids[at:at + STRIPE], rows.uids[at:at + STRIPE]
            found = score(q, slice(at, at + STRIPE))
            exact = found.dtype == object
            if least is None:  # of a query with fewer than k rows so far, every row counts
                least = np.full(len(uids), -math.inf, object if exact else np.float64)
            mask = found >= least[:, None]
            if found.shape[1] > k + 1 and not exact and np.isneginf(least).any():
                # k + 1, as the query itself may be among them
                mask &= found >= np.partition(found, found.shape[1] - k - 1, axis=1)[:, -k - 1][:, None]
            line, column = np.nonzero(mask)
            cuts = np.searchsorted(line, np.arange(len(uids) + 1))
            for i in np.flatnonzero(np.diff(cuts)):
                c = column[cuts[i]:cuts[i + 1]]
                c = c[others[c] != uids[i]]
                values = found[i, c] if exact else found[i, c].astype(np.int64)
                old_ids, old = lists[i]
                lists[i] = best_of(np.concatenate([old_ids, ids[c]]), values if old is None else np.concatenate([old, values]), k)
                if len(lists[i][0]) == k:
                    least[i] = lists[i][1][-1]
        out += [Found(int(u), int(i), a, b if b is not None else np.empty(0, np.int64))
                for u, i, (a, b) in zip(uids, queries.ids[q], lists, strict=True)]
    return out


LISTS = "q int, s int, uids binary, query_ids binary, lengths binary, ids binary, kind string, scores binary"


def _packed_lists(q: int, s: int, lists: list[Found]) -> pd.DataFrame:
    long = lambda xs: np.array(xs, np.int64).tobytes()
    scores = np.concatenate([x.scores for x in lists] or [np.empty(0, np.int64)])
    kind, data = _bytes(scores)
    return pd.DataFrame([[q, s, long([x.uid for x in lists]), long([x.query_id for x in lists]), long([len(x.ids) for x in lists]),
                          np.concatenate([x.ids for x in lists] or [np.empty(0, np.int64)]).astype(np.int64).tobytes(), kind, data]],
                        columns=[c.split()[0] for c in LISTS.split(", ")])


def _lists(row) -> list[Found]:
    long = lambda b: np.frombuffer(b, np.int64)
    cuts = np.cumsum(long(row.lengths))[:-1]
    uids = long(row.uids).tolist()
    scores = _numbers(row.kind, row.scores) if len(row.ids) else np.empty(0, np.int64)
    return [Found(*x) for x in zip(uids, long(row.query_ids).tolist(), np.split(long(row.ids), cuts), np.split(scores, cuts),
                                   strict=True)] if uids else []


def _merged(k: int, fan_in: int):
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        by_query: dict[int, Found] = {}
        for row in pdf.itertuples(index=False):
            for new in _lists(row):
                old = by_query.get(new.uid)
                by_query[new.uid] = new if old is None else Found(new.uid, new.query_id, *best_of(
                    np.concatenate([old.ids, new.ids]), np.concatenate([old.scores, new.scores]), k))
        return _packed_lists(int(pdf["q"].iloc[0]), int(pdf["s"].iloc[0]) // fan_in, list(by_query.values()))
    return merge


def top_k(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 64, query_block: int = QUERY_BLOCK, shard: int = SHARD, fan_in: int = FAN_IN) -> DataFrame:
    """The k best other rows of each query row: query_id long, rank int, vec_id long, score long."""
    prepare(rows.sparkSession)
    usable = (rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), is_query.alias("is_query"))
              .where(F.col("id").isNotNull() & F.col("v").isNotNull() & _usable(F.col("v"))))
    # A number for each row, kept by writing it: rows that repeat an id stay apart.
    one = checkpointed(usable.withColumn("uid", F.monotonically_increasing_id()))
    counts = one.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    n_q, n_s = -(-counts.q // query_block) or 1, -(-counts.n // shard) or 1
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = _blocks(one.where("is_query"), n_q, "q", scale).select("*", every(n_s).alias("s"))
    shards = _blocks(one, n_s, "s", scale).select("*", every(n_q).alias("q"))

    def tile(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        by_query: dict[int, Found] = {}
        for a in left.itertuples(index=False):
            for b in right.itertuples(index=False):
                if b.width == a.width:
                    for new in tile_best(_unpack(a), _unpack(b), k):
                        old = by_query.get(new.uid)
                        by_query[new.uid] = new if old is None else Found(new.uid, new.query_id, *best_of(
                            np.concatenate([old.ids, new.ids]), np.concatenate([old.scores, new.scores]), k))
        return _packed_lists(int(key[0]), int(key[1]), list(by_query.values()))

    tiles = queries.groupBy("q", "s").cogroup(shards.groupBy("q", "s")).applyInPandas(tile, LISTS)
    while True:
        tiles = tiles.groupBy("q", F.floor(F.col("s") / fan_in)).applyInPandas(_merged(k, fan_in), LISTS)
        n_s = -(-n_s // fan_in)
        if n_s == 1:
            break
    schema = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def listed(batches):
        for batch in batches:
            for row in batch.to_pandas().itertuples(index=False):
                found = [(x.query_id, rank, int(i), int(score) if -LONG_MAX <= score <= LONG_MAX else None)
                         for x in _lists(row) for rank, (i, score) in enumerate(zip(x.ids, x.scores, strict=True), 1)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return tiles.mapInArrow(listed, "query_id long, rank int, vec_id long, score long")


ORACLE = """
WITH v AS (
  SELECT row_number() OVER () AS row_no, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.row_no, a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.e::DOUBLE[], b.e::DOUBLE[]) AS BIGINT) AS score
  FROM v a JOIN v b ON a.row_no <> b.row_no WHERE a.vec_id % 20 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY row_no ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20"""
