"""Mixing sources to target weights, by a min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to (their pattern).  A flow network sends
words from patterns to the quotas of their sources; each further repetition of a pattern costs more
than the one before, so a document is repeated only where fresh words run out.  The network has one
node for each pattern and source, and is all that the driver sees; more than ``MAX_PATTERNS`` different patterns
are an error.  A pattern and a source that only have each other need no network.

The words that flow from a pattern are then taken from its documents in a seeded order: whole
repetitions of all documents, and one more for some.  For that last part documents are hashed into
buckets of about ``docs_per_bucket``; whole buckets are taken up to one edge bucket, whose
documents are taken one by one as long as they fit, and exchanged while that comes closer.
Documents are always taken whole.  Rows that agree in id, sources and text count as copies of one document: the edge
bucket takes any number of them, and that number is dealt over the partitions they lie in by running counts.

Defined cases: a null text or source counts as an empty text, and as a source of its own that
comes last; rows that agree in id, sources and text are taken copy by copy (if their other columns differ, which
of them the mix repeats depends on where they lie); a document without words takes nothing; targets without any words are 0; an empty table gives an empty result; other columns, clashing
names included, stay as they are in the mix.
"""

from __future__ import annotations

import json
from bisect import bisect_left
from collections import Counter, deque
from dataclasses import dataclass
from fractions import Fraction

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import checkpointed, fresh, map_arrow, prepare, schema_of

WEIGHTS = (3, 1, 2)
MAX_EPOCHS = 2
DOCS_PER_BUCKET = 2000
#: The most patterns whose sums the driver takes.
MAX_PATTERNS = 1_000_000
#: Tables of one row per pattern or source are broadcast up to this many bytes (their size is known here).
MAX_BROADCAST_BYTES = 8 << 20
#: Buckets of a pattern are added up in groups of this many first.
BUCKETS_PER_GROUP = 1024


def target_words(sizes: dict[str | None, int], weights=WEIGHTS, percent: int = 150,
                 max_epochs: int = MAX_EPOCHS) -> dict[str | None, Fraction]:
    """Shares of ``percent`` of all words by the weights, dealt in turn to the sources by code point, null last.  A
    share stops at ``max_epochs`` times the source's size; the excess is shared among the others by weight."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left = Fraction(sum(sizes.values()) * percent, 100)
    open_, out = list(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if unit * weight[s] > max_epochs * sizes[s]]
        if not full:
            return out | {s: unit * weight[s] for s in open_}
        for s in full:
            out[s] = Fraction(max_epochs * sizes[s])
            left -= out[s]
        open_ = [s for s in open_ if s not in out]
    return out


def route(patterns: list[tuple[list, int]], quotas: dict, max_epochs: int = MAX_EPOCHS) -> list[int]:
    """Words taken from each pattern (its sources, its words): a maximum flow of least cost.  The k-th repetition of a
    pattern costs 2k - 1 a word.

    Only the arcs into patterns cost anything and no path comes back to their common start, so a path costs what its first arc
    does: the flow is cheapest if the k-th repetitions are opened in turn, each after the flow is maximal without them."""
    uses = Counter(s for members, _ in patterns for s in members)
    taken = [0] * len(patterns)
    tied = []
    for p, (members, words) in enumerate(patterns):
        if len(members) == 1 and uses[members[0]] == 1:
            taken[p] = min(quotas.get(members[0], 0), max_epochs * words)
        elif members and words:
            tied.append(p)
    if tied:
        net = Network(2 + len(tied))
        named = sorted({s for p in tied for s in patterns[p][0]}, key=lambda s: (s is None, s or ""))
        node = {s: net.node() for s in named}
        into = [net.arc(0, 2 + k, 0) for k in range(len(tied))]
        for k, p in enumerate(tied):
            for s in patterns[p][0]:
                net.arc(2 + k, node[s], max_epochs * patterns[p][1])
        for s in named:
            net.arc(node[s], 1, quotas.get(s, 0))
        for _ in range(max_epochs):
            for k, p in enumerate(tied):
                net.room[into[k]] += patterns[p][1]
            net.fill()
        for k, p in enumerate(tied):
            taken[p] = net.room[into[k] ^ 1]
    return taken


class Network:
    """Arcs with room, from node 0 to node 1, filled along shortest paths, all of one length at a time."""

    def __init__(self, nodes: int):
        self.out: list[list[int]] = [[] for _ in range(nodes)]
        self.to: list[int] = []
        self.room: list[int] = []  # an arc's reverse has the number ^ 1

    def node(self) -> int:
        self.out.append([])
        return len(self.out) - 1

    def arc(self, a: int, b: int, room: int) -> int:
        for x, y, r in ((a, b, room), (b, a, 0)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
        return len(self.to) - 2

    def levels(self) -> list[int]:
        level = [-1] * len(self.out)
        level[0] = 0
        queue = deque([0])
        while queue and level[1] < 0:
            a = queue.popleft()
            for k in self.out[a]:
                if self.room[k] and level[self.to[k]] < 0:
                    level[self.to[k]] = level[a] + 1
                    queue.append(self.to[k])
        return level

    def fill(self) -> None:
        """Makes the flow maximal."""
        while (level := self.levels())[1] >= 0:
            tried, path = [0] * len(self.out), []
            while True:
                at = self.to[path[-1]] if path else 0
                if at == 1:
                    room = min(self.room[k] for k in path)
                    for k in path:
                        self.room[k] -= room
                        self.room[k ^ 1] += room
                    del path[next(i for i, k in enumerate(path) if not self.room[k]):]
                elif tried[at] < len(self.out[at]):
                    k = self.out[at][tried[at]]
                    if self.room[k] and level[self.to[k]] == level[at] + 1:
                        path.append(k)
                    else:
                        tried[at] += 1
                elif path:
                    tried[self.to[path.pop() ^ 1]] += 1
                else:
                    break


@dataclass(frozen=True)
class Mix:
    rows: DataFrame               # doc_id, text_hash, pattern, size, epochs: one row per document
    sizes: dict[str | None, int]  # words of each source
    targets: dict[str | None, Fraction]


def _side(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table that is joined to all documents by pattern or source, one of which may hold a third of them."""
    table = spark.createDataFrame(rows, schema)
    size = sum(len(x.encode("utf-8", "surrogatepass")) if isinstance(x, str) else 8 for row in rows for x in row)
    return F.broadcast(table) if size <= MAX_BROADCAST_BYTES else table  # beyond: AQE, which splits hot keys


def chosen(sizes: list[int], room: int, copies: list[int] | None = None, rounds: int = 1000) -> dict[int, int]:
    """Places of the documents to take, out of those in a seeded order, and how many of their copies (one each, if not
    given), so that their sizes come near ``room``: first all that still fit, one by one; then exchanges of one document
    (or none) for another (or none) while that comes closer, ``rounds`` times at most."""
    copies = copies or [1] * len(sizes)
    taken: dict[int, int] = {}
    for k, words in enumerate(sizes):
        if 0 < words <= room and copies[k]:
            taken[k] = min(copies[k], room // words)
            room -= taken[k] * words
    for _ in range(rounds):
        inside = sorted([(sizes[k], k) for k in taken] + [(0, -1)])
        values = [v for v, _ in inside]
        rest = [k for k, words in enumerate(sizes) if words and taken.get(k, 0) < copies[k]]
        best = (abs(room), None, None)
        for k in [*rest, -1]:
            new = sizes[k] if k >= 0 else 0
            at = bisect_left(values, new - room)
            for old, out in inside[max(0, at - 1):at + 1]:
                best = min(best, (abs(room - new + old), k, out), key=lambda x: x[0])
        _, k, out = best
        if k is None:
            break
        for place, step in ((k, 1), (out, -1)):
            if place >= 0:
                room -= step * sizes[place]
                taken[place] = taken.get(place, 0) + step
                if not taken[place]:
                    del taken[place]
    return taken


def _edges(spark: SparkSession, sums: DataFrame) -> list[tuple]:
    """(pattern, edge bucket, words that it may give): at most one for each pattern.  ``sums`` has one row for each
    bucket; groups of buckets are added up first, so a window sees documents / docs_per_bucket / BUCKETS_PER_GROUP rows of a
    pattern, then the buckets of one group."""

    def edge(rows: DataFrame, place: str) -> DataFrame:
        upto = F.col("before") + F.sum("words").over(Window.partitionBy("pattern").orderBy(place))
        return rows.withColumn("upto", upto).where("upto >= rest and upto - words < rest")

    group = F.expr(f"bucket div {BUCKETS_PER_GROUP}")
    coarse = (sums.groupBy("pattern", "rest", group.alias("group")).agg(F.sum("words").alias("words"))
              .withColumn("before", F.lit(0).cast("long")))
    found = [tuple(r) for r in edge(coarse, "group").selectExpr("pattern", "group", "upto - words").collect()]
    inside = (sums.withColumn("group", group)
              .join(_side(spark, found, "pattern string, group long, before long"), ["pattern", "group"]))
    return [tuple(r) for r in edge(inside, "bucket").selectExpr("pattern", "bucket", "rest - upto + words").collect()]


def _fill(pdf: pd.DataFrame) -> pd.DataFrame:
    """The documents of an edge bucket that are taken, and how many copies of each."""
    pdf = pdf.sort_values(["place", "doc_id", "text_hash"], na_position="last")
    keep = chosen([int(x) for x in pdf["words"]], int(pdf["room"].iloc[0]), [int(x) for x in pdf["copies"]])
    return pdf.iloc[list(keep)][[*KEY, "full", "copies"]].assign(more=list(keep.values()))


KEY = ("doc_id", "text_hash", "pattern")


def _shares(parts: DataFrame) -> DataFrame:
    """``parts``: the key, ``part``, ``here`` (its copies in that partition) and ``more`` (of all its copies, how many are
    taken).  Adds ``dealt``: how many of those here.  The window sees one row for each partition a document lies in."""
    before = F.sum("here").over(Window.partitionBy(*KEY).orderBy("part")) - F.col("here")
    return parts.withColumn("dealt", F.least("here", F.greatest(F.lit(0).cast("long"), F.col("more") - before)))


def _same_key(left: DataFrame, right: DataFrame) -> Column:
    return (left["doc_id"].eqNullSafe(right["doc_id"]) & (left["text_hash"] == right["text_hash"])
            & (left["pattern"] == right["pattern"]))


def mix(docs: DataFrame, members: Column, weights=WEIGHTS, percent: int = 150, max_epochs: int = MAX_EPOCHS,
        seed: int = 20, docs_per_bucket: int = DOCS_PER_BUCKET) -> Mix:
    """``members``: the array of a document's sources.  The number of different patterns must be small."""
    spark = prepare(docs.sparkSession)
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                        F.to_json(F.array_sort(F.array_distinct(members))).alias("pattern"), "text")
    keep = ["doc_id", "text_hash", "pattern"]

    def worker():
        def each(batch: pa.RecordBatch) -> dict:
            sizes = [len(x.encode("utf-8", "surrogatepass").split()) if x else 0
                     for x in batch.column("text").to_pylist()]
            return {n: batch.column(n) for n in keep} | {"size": sizes}
        return each

    sized = checkpointed(map_arrow(keyed, worker, schema_of(keyed, keep, ("size", T.LongType()))))
    sums = sized.groupBy("pattern").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    totals = sorted((r.pattern, r.words, r.n) for r in sums.limit(MAX_PATTERNS + 1).collect())
    if len(totals) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} different patterns of sources")
    patterns = [(json.loads(p), words) for p, words, _ in totals]
    sizes: dict[str | None, int] = {}
    for sources, words in patterns:
        for s in sources:
            sizes[s] = sizes.get(s, 0) + words
    targets = target_words(sizes, weights, percent, max_epochs)
    flow = route(patterns, {s: round(t) for s, t in targets.items()}, max_epochs)
    plan = [(p, f // words if words else 0, f % words if words else 0, n // docs_per_bucket + 1)
            for (p, words, n), f in zip(totals, flow, strict=True)]
    plan_schema = "pattern string, full long, rest long, buckets long"
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keep), 32).cast("long")
    placed = (sized.join(_side(spark, plan, plan_schema), "pattern")
              .withColumn("place", place).withColumn("bucket", F.expr("(place * buckets) >> 32")))
    edges = _edges(spark, checkpointed(placed.where("rest > 0").groupBy("pattern", "rest", "bucket")
                                       .agg(F.sum("size").alias("words"))))
    edge = _side(spark, edges, "pattern string, edge long, room long")
    placed = placed.join(edge, "pattern", "left")
    decision = T.StructType([*(sized.schema[n] for n in KEY),
                             *(T.StructField(n, T.LongType()) for n in ("full", "copies", "more"))])
    filled = checkpointed(placed.where("bucket = edge and size > 0").groupBy(*keep, "room", "place", "full")
                          .agg(F.max("size").alias("words"), F.count("*").alias("copies"))
                          .groupBy("pattern").applyInPandas(_fill, decision))
    joined = placed.join(filled, _same_key(placed, filled) & (placed["bucket"] == placed["edge"]), "left")
    more = F.when(F.col("bucket") < F.col("edge"), 1).when(F.col("more") == F.col("copies"), 1).otherwise(0)
    rows = (joined.where("more is null or more = copies")
            .select(*(placed[n] for n in KEY), "size", (placed["full"] + more).alias("epochs")))
    partial = filled.where("more < copies")
    if not partial.isEmpty():
        marked = sized.withColumn("part", F.spark_partition_id())
        parts = (marked.join(partial, _same_key(marked, partial))
                 .groupBy(*(marked[n] for n in KEY), "size", "full", "more", "part").agg(F.count("*").alias("here")))
        dealt = _shares(parts).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("here"))))
        rows = rows.unionByName(dealt.select(
            *KEY, "size", (F.col("full") + F.when(F.col("copy") <= F.col("dealt"), 1).otherwise(0)).alias("epochs")))
    return Mix(rows, sizes, targets)


def words_taken(docs: DataFrame, **settings) -> DataFrame:
    """One row per document of single-source ``docs``: doc_id, size, source_size, target, taken, epochs."""
    found = mix(docs, F.array("source"), **settings)
    sources = [(s, found.sizes[s], float(t)) for s, t in found.targets.items()]
    table = _side(docs.sparkSession, sources, "name string, source_size long, target double")
    named = found.rows.withColumn("of", F.from_json("pattern", "array<string>")[0])
    return (named.join(table, named["of"].eqNullSafe(table["name"]))
            .select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("epochs")).alias("taken"),
                    F.col("epochs").cast("int").alias("epochs")))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the rows of ``docs`` as often as they are taken, with all their columns."""
    found = mix(docs, F.array("source"), **settings)
    id_, mark, pattern, epochs, more, part, nth = fresh(docs, "mix_id", "mix_hash", "mix_pattern", "mix_epochs", "mix_more",
                                                        "mix_part", "mix_nth")

    def decided(rows: DataFrame, **values: Column) -> DataFrame:
        side = rows.select(F.col("doc_id").alias(id_), F.col("text_hash").alias(mark), F.col("pattern").alias(pattern),
                           *(v.alias(n) for n, v in values.items()))
        return docs.join(side, docs["doc_id"].eqNullSafe(side[id_]) & (F.xxhash64(docs["text"]) == side[mark])
                         & (F.to_json(F.array(docs["source"])) == side[pattern]))

    def repeated(rows: DataFrame) -> DataFrame:
        times = F.explode(F.sequence(F.lit(1).cast("long"), F.col(epochs)))
        return rows.where(F.col(epochs) > 0).withColumn(epochs, times).select(*docs.columns)

    each = (found.rows.groupBy(*KEY)
            .agg(F.min("epochs").alias("low"), F.max("epochs").alias("high"), F.sum("epochs").alias("all"), F.count("*").alias("n"))
            .where("high > 0"))
    uneven = checkpointed(each.where("low < high"))
    if uneven.isEmpty():
        return repeated(decided(each, **{epochs: F.col("high")}))
    # documents with some copies taken once more: their rows are fixed first, then numbered in each partition
    some = checkpointed(decided(uneven, **{epochs: F.col("low"), more: F.expr("`all` - n * low")}))
    some = some.withColumn(part, F.spark_partition_id())
    key = [F.col(n).alias(k) for n, k in zip((id_, mark, pattern), KEY, strict=True)]
    parts = _shares(some.groupBy(*key, F.col(part).alias("part"), F.col(more).alias("more"))
                    .agg(F.count("*").alias("here"))).select(*KEY, "part", "dealt")
    rows = some.withColumn(nth, F.row_number().over(Window.partitionBy(id_, mark, pattern, part).orderBy(F.lit(0))))
    numbered = rows.join(parts, rows[id_].eqNullSafe(parts["doc_id"]) & (rows[mark] == parts["text_hash"])
                         & (rows[pattern] == parts["pattern"]) & (rows[part] == parts["part"]))
    times = rows[epochs] + F.when(rows[nth] <= parts["dealt"], 1).otherwise(0)
    some = numbered.select(*(rows[c] for c in docs.columns), times.alias(epochs))
    return repeated(decided(each.where("low = high"), **{epochs: F.col("high")})).unionByName(repeated(some))
