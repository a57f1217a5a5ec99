"""Ranked lexical search with hashed max-sketches.

A term's impact in a document is ``(10^9 * tf) div (1000 * tf + 12 * m)``, with ``m`` from the document's length; an
item's score of a document adds ``weight * impact`` over the item's terms.  A document's sketch has ``width``
coordinates: every term hashes to one, and a coordinate holds the largest impact that fell on it.  So the item's
weights, added up by coordinate and multiplied with the sketch, bound its score from above.  For each Arrow batch all
bounds of a block of items are one matrix product over the coordinates that the block looks up; then, item by
item, documents are rescored exactly in descending order of their bounds until a bound is below the item's
``k``-th best score.  The best lists live as long as the task, so later batches start with a high threshold.

Documents are read where they lie: one pass counts documents, terms and document frequencies (of the block's terms),
one searches; a task sends ``k`` rows for each item, which meet in two steps, by groups of tasks and then by item.
Items come in blocks of at most ``ITEMS`` rows and about ``ITEM_CHARS`` characters (one longer item is a block
by itself), so what a task holds of them is bounded; more items mean more passes, as the work is items times rows.

Defined cases: a null text has no term; documents without a term are no candidates and do not count as documents;
each document row is judged for itself, also where ids or texts repeat, and a null id comes last among equal
scores; items that repeat id and text count once, other rows with the same id are lists of their own; an item
without a known term, and an empty table, give nothing; texts of any length are counted whole, a piece at a time.
Other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import prepare

WIDTH, K = 4096, 20
ITEMS, ITEM_CHARS, PIECE, GROUPS = 2048, 4 << 20, 1 << 20, 256
#: Bytes of a term: ASCII letters and digits, and all of a code point beyond ASCII.  The rest separates terms.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def term_counts(text: str | None) -> tuple[Counter, int]:
    """Occurrences of each term, and their number.  Long texts are split a piece at a time."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(_BYTES)
    if len(data) <= PIECE:
        words = data.split()
        return Counter(words), len(words)
    counts, n, at = Counter(), 0, 0
    while at < len(data):
        end = data.find(b" ", at + PIECE)
        words = data[at:end if end >= 0 else len(data)].split()
        counts.update(words)
        n += len(words)
        at = end if end >= 0 else len(data)
    return counts, n


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def length_factor(n: int, n_docs: int, n_terms: int) -> int:
    return 100 - 25 + 25 * n * n_docs // n_terms


def impact(tf: int, m: int) -> int:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def impacts(tf: np.ndarray, m: int) -> np.ndarray:
    # Beyond 2^58 the impact of any count that a text can hold is 0 either way.
    return 1_000_000_000 * tf // (1000 * tf + 12 * min(m, 1 << 58))


def coordinates(terms, width: int) -> np.ndarray:
    return np.fromiter(map(crc32, terms), np.int64, len(terms)) % width


@dataclass
class Items:
    """A block of items: each one's terms with weight times repeats (terms without weight are left out)."""
    terms: list[list[tuple[bytes, int]]]
    width: int

    def __post_init__(self) -> None:
        where = [coordinates([t for t, _ in ts], self.width) for ts in self.terms]
        used = np.unique(np.concatenate([np.empty(0, np.int64), *where]))
        #: Coordinate -> column of the sketches that are looked up, or -1.
        self.slot = np.full(self.width, -1, np.int64)
        self.slot[used] = np.arange(len(used))
        self.weights = np.zeros((len(used), len(self.terms)))
        for k, (ts, at) in enumerate(zip(self.terms, where, strict=True)):
            np.add.at(self.weights[:, k], self.slot[at], [w for _, w in ts])

    def sketch(self, counts: Counter, m: int, out: np.ndarray) -> None:
        """Coordinatewise maxima of a document's impacts, at the looked-up coordinates."""
        at = self.slot[coordinates(counts, self.width)]
        found = impacts(np.fromiter(counts.values(), np.int64, len(counts)), m)
        np.maximum.at(out, at[at >= 0], found[at >= 0])

    def bounds(self, sketches: np.ndarray) -> np.ndarray:
        """Documents x items; whole numbers, with a margin for those beyond 2^53."""
        return (sketches @ self.weights) * (1 + 1e-9)

    def score(self, item: int, counts: Counter, m: int) -> int:
        return sum(w * impact(tf, m) for t, w in self.terms[item] if (tf := counts.get(t)))


class Best:
    """The ``k`` best of one item: higher scores, then smaller ids, null ids last."""

    def __init__(self, k: int) -> None:
        self.k, self.heap = k, []

    @property
    def least(self) -> int:
        """What a score must reach to matter."""
        return self.heap[0][0] if len(self.heap) == self.k else 1

    def add(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, -(doc_id or 0))
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        else:
            heapq.heappushpop(self.heap, entry)

    def rows(self) -> list[tuple[int, int | None]]:
        return [(score, -negative if known else None) for score, known, negative in self.heap]


def search_batch(items: Items, ids: list, counted: list[tuple[Counter, int]], best: list[Best], n_docs: int,
                 n_terms: int) -> int:
    """Updates the best lists by a batch of documents; returns how many exact scores that took."""
    factors = [length_factor(n, n_docs, n_terms) for _, n in counted]
    sketches = np.zeros((len(ids), len(items.weights)))
    for row, ((counts, n), m) in enumerate(zip(counted, factors, strict=True)):
        if n:
            items.sketch(counts, m, sketches[row])
    bounds = items.bounds(sketches)
    least = np.array([b.least for b in best], np.float64)
    rescored = 0
    for item in np.flatnonzero(bounds.max(axis=0, initial=0) >= least):
        bound, found = bounds[:, item], best[item]
        rows = np.flatnonzero(bound >= least[item])
        for row in rows[np.argsort(-bound[rows], kind="stable")].tolist():
            if bound[row] < found.least:
                break
            rescored += 1
            if (score := items.score(int(item), counted[row][0], factors[row])) > 0:
                found.add(score, ids[row])
    return rescored


# Spark --------------------------------------------------------------------------------------------------------------

def _counted(batch: pa.RecordBatch) -> list[tuple[Counter, int]]:
    return [term_counts(t) for t in batch.column("text").to_pylist()]


def frequencies(docs: DataFrame, terms: set[bytes]) -> DataFrame:
    """Rows (term, n, words) of each task: for each of ``terms`` the documents that hold it; in the row with a null term
    the documents that hold any term, and all their terms."""
    schema = pa.schema([("term", pa.binary()), ("n", pa.int64()), ("words", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n_docs, n_terms = Counter(), 0, 0
        for batch in batches:
            for counts, n in _counted(batch):
                n_docs, n_terms = n_docs + (n > 0), n_terms + n
                df.update(terms & counts.keys())
        yield pa.RecordBatch.from_arrays([pa.array([None, *df], pa.binary()), pa.array([n_docs, *df.values()], pa.int64()),
                                          pa.array([n_terms, *[0] * len(df)], pa.int64())], schema=schema)

    return docs.select("text").mapInArrow(run, "term binary, n long, words long")


def _item_blocks(items: DataFrame, most_items: int, most_chars: int) -> tuple[DataFrame, int]:
    """The different items with a block number, and how many blocks there are."""
    different = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    size = different.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(-(-size.n // most_items), -(-(size.chars or 0) // most_chars), 1)
    return different.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), blocks


def _search(docs: DataFrame, rows: list, k: int, width: int) -> DataFrame | None:
    """Best lists of the items ``rows`` in each task: item_id, list_no, doc_id, score, task."""
    wanted = [term_counts(r.text)[0] for r in rows]
    terms = set().union(*wanted)
    if not terms:
        return None
    counts = frequencies(docs, terms).groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect()
    df = {bytes(r.term): r.n for r in counts if r.term is not None}
    n_docs, n_terms = next(((r.n, r.words) for r in counts if r.term is None), (0, 0))
    if not n_docs:
        return None
    weights = {t: weight(n_docs, n) for t, n in df.items()}
    block = [[(t, n * weights[t]) for t, n in c.items() if weights.get(t)] for c in wanted]
    item_ids = [r.item_id for r in rows]
    schema = pa.schema([("item_id", pa.int64()), ("list_no", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64()),
                        ("task", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(block, width)
        best = [Best(k) for _ in block]
        for batch in batches:
            search_batch(items, batch.column("doc_id").to_pylist(), _counted(batch), best, n_docs, n_terms)
        task = TaskContext.get().partitionId()
        found = [(item_ids[j], j, doc_id, score, task) for j, b in enumerate(best) for score, doc_id in b.rows()]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "item_id long, list_no int, doc_id long, score long, task int")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = K, width: int = WIDTH, most_items: int = ITEMS,
                  most_chars: int = ITEM_CHARS) -> DataFrame:
    """The ``k`` best documents of each item: item_id, rank int, doc_id, score."""
    spark = prepare(docs.sparkSession)
    different, blocks = _item_blocks(items, most_items, most_chars)
    parts = []
    for b in range(blocks):
        part = _search(docs, sorted(different.where(F.col("block") == b).collect(), key=lambda r: (r.item_id is None, r.item_id or 0, r.text)),
                       k, width)
        if part is not None:
            parts.append(part.withColumn("block", F.lit(b)))
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    found = reduce(DataFrame.union, parts)

    def best(df: DataFrame, *keys) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    some = best(found, "block", "list_no", F.pmod("task", F.lit(GROUPS))).drop("rank")
    return best(some, "block", "list_no").select("item_id", "rank", "doc_id", "score")


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_no, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '%(term)s') AS terms
  FROM documents WHERE text IS NOT NULL),
tf AS (
  SELECT row_no, any_value(doc_id) AS doc_id, term, any_value(n) AS n, count(*) AS tf
  FROM (SELECT row_no, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY row_no, term),
whole AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS words FROM d WHERE len(terms) > 0),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, docs),
items AS (
  SELECT row_number() OVER () AS list_no, item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '%(term)s') AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
wanted AS (
  SELECT list_no, any_value(item_id) AS item_id, term, count(*) AS times
  FROM (SELECT list_no, item_id, unnest(terms) AS term FROM items) GROUP BY list_no, term),
scored AS (
  SELECT list_no, any_value(item_id) AS item_id, row_no, any_value(doc_id) AS doc_id, CAST(sum(
    times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // words)))) AS BIGINT) AS score
  FROM wanted JOIN weights USING (term) JOIN tf USING (term), whole GROUP BY list_no, row_no),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY list_no ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= %(k)d""" % {"term": TERM, "k": K}
