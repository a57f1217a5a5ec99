"""Document fingerprints of closed syncmers, in DataFrame functions only.

A k-mer (``K`` code points) is an anchor if the least hash of its inner substrings of ``S`` code points is that of the
first or the last one.  Whether it is depends on nothing but the k-mer, so an edit changes the anchors that it
touches and no others, and at least one of any ``K - S`` neighbouring k-mers is one.  A fingerprint is the list of
a text's anchors, each as its distance from the anchor before (at most ``K - S``; of the first: from the start)
and 32 bits of its hash: ``gap * 2^32 + hash``.  Two fingerprints are matched by position: an anchor counts as found
where the other text has it at the same distance from the anchor before, wherever in the text that is.

For the same reason the edited text needs no pass of its own: its anchors are those of the kept half, those of the other
text's start moved behind it, and those of the few k-mers across the seam (``spliced``; tested against a whole pass).

A text is cut into chunks of ``CHUNK`` code points (with the first of the next chunk behind them), so the cost of
taking substrings does not grow with its length.  ``with_anchors`` makes a row of each chunk and a column of each hash in it,
which Spark compiles (functions of array elements it interprets, at several times the cost), and puts the chunks' anchors
together again by the row's key, without a shuffle of its own.  ``positions`` gives the same of a column.

``with_next`` puts beside each document the next one in descending order of ids.  Places in that order come from the
ids and text hashes alone (a range shuffle of small rows, written once); texts then meet in blocks of ``ROWS``
neighbours, each with the first document of the block after it.  Rows that repeat id and text are one row with a
count until the result, so no group is larger than a block.

Defined cases: a null text counts as empty; an empty text has no anchors, and a text without any (always below ``K``
code points) has one, its own hash; of two empty fingerprints the likeness is 1, of one it is 0; an anchor that
occurs twice at the same distance counts once in a likeness; documents that share an id follow one another
by the hash of their texts; a null id comes last; a single document is its own next; texts of any length are
read whole; no documents give an empty result.  Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed

K, S, ROWS = 20, 5, 64
#: With its more than 100 columns of hashes a chunk's projection is compiled in many small methods; in a single large one,
#: as whole-stage code of fewer columns, the JVM would not compile it further.
CHUNK = 96
#: Substrings are taken from pieces that begin at every so many code points, as their cost grows with what they are taken from.
PIECE = 8
#: Inner substrings of a k-mer; their least hash is taken four at a time.
INNER = K - S + 1
HASH = (1 << 32) - 1
#: Row numbers within a partition, as ``monotonically_increasing_id`` has them.
ROW_BITS = 33
COPIES = 10_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)``, with ``value`` evaluated once."""
    return F.transform(F.array(value), body)[0]


# Fingerprints -------------------------------------------------------------------------------------------------------

def _short_hash(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit(HASH))


def _chunk_anchors(chunk: Column, start: Column) -> Column:
    """Anchors of a chunk that begins at ``start``: array of position * 2^32 + hash."""
    def of_hashes(h: Column) -> Column:
        fours = F.transform(F.sequence(F.lit(0), F.size(h) - 4), lambda i: F.least(h[i], h[i + 1], h[i + 2], h[i + 3]))
        return let(fours, lambda m: F.filter(
            F.sequence(F.lit(0), F.size(h) - INNER),
            lambda i: F.least(h[i], h[i + INNER - 1]) == F.least(*[m[i + q] for q in range(0, INNER, 4)])))

    hashes = F.transform(F.sequence(F.lit(1), F.length(chunk) - (S - 1)), lambda j: F.xxhash64(chunk.substr(j, F.lit(S))))
    packed = F.transform(let(hashes, of_hashes), lambda i: F.shiftleft((start + i).cast("long"), 32).bitwiseOR(
        _short_hash(chunk.substr(i + 1, F.lit(K)))))
    return F.when(F.length(chunk) >= K, packed).otherwise(F.array().cast("array<bigint>"))


def positions(text: Column) -> Column:
    """The anchors of a text that is not null: array<bigint> of position * 2^32 + hash."""
    def of_chunks(chunks: Column) -> Column:
        behind = lambda i: F.coalesce(F.get(chunks, i + 1).substr(F.lit(1), F.lit(K - 1)), F.lit(""))
        return F.flatten(F.transform(chunks, lambda c, i: let(
            F.concat(c, behind(i)), lambda chunk: _chunk_anchors(chunk, i * CHUNK))))

    return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), of_chunks)


def with_anchors(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """``rows`` with ``packed``, the ``positions`` of their ``text``; ``key`` tells the rows apart.  Rows that lie together by
    some of ``key`` stay where they are."""
    others, long = [c for c in rows.columns if c not in key], CHUNK + K - 1
    # With each chunk what it has of the next one; the row itself goes with its first chunk.
    chunks = F.regexp_extract_all("text", F.lit(f"(?s)(?=(.{{1,{long}}})).{{1,{CHUNK}}}"), F.lit(1))
    parts = F.transform(F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(chunks), lambda c, i: F.struct(
        c.alias("chunk"), i.alias("at"), F.when(i == 0, F.struct(*others)).alias("row")))
    each = rows.select(*key, F.explode(parts).alias("part")).select(*key, "part.*")
    # As SQL text: so many expressions take the driver seconds to build one call at a time.
    starts = range(long - S + 1)
    piece = lambda j, n: f"substring(piece_{j // PIECE}, {j % PIECE + 1}, {n})"
    pieces = each.selectExpr("*", "length(chunk) AS n", *[
        f"substring(chunk, {j + 1}, {PIECE + K - 1}) AS piece_{j // PIECE}" for j in starts[::PIECE]])
    hashes = pieces.selectExpr("*", *[f"xxhash64({piece(j, S)}) AS hash_{j}" for j in starts])

    def anchor(i: int) -> str:
        inner = [f"hash_{i + q}" for q in range(INNER)]
        return (f"CASE WHEN n >= {i + K} AND least({inner[0]}, {inner[-1]}) = least({', '.join(inner)}) THEN "
                f"shiftleft(CAST(at * {CHUNK} + {i} AS bigint), 32) | (xxhash64({piece(i, K)}) & {HASH}L) ELSE -1L END")

    found = hashes.selectExpr(*key, "at", "row", f"array_remove(array({', '.join(map(anchor, range(CHUNK)))}), -1L) AS packed")
    whole = found.groupBy(*key).agg(F.first("row", ignorenulls=True).alias("row"),
                                    F.sort_array(F.collect_list(F.struct("at", "packed"))).alias("parts"))
    return whole.select(*key, "row.*", F.flatten("parts.packed").alias("packed"))


def spliced(own: Column, head: Column, other: Column, tail: Column) -> Column:
    """The anchors of ``head + tail``, where ``head`` begins the text with the anchors ``own`` and ``tail`` begins that of
    ``other``: those that lie within one of both, and those of the k-mers across the seam."""
    left = F.least(F.length(head), F.lit(K - 1))
    seam = F.concat(head.substr(F.length(head) - left + 1, left), tail.substr(F.lit(1), F.lit(K - 1)))
    within = lambda p, end: F.shiftright(p, 32) + K <= end
    kept = let(F.length(head), lambda n: F.filter(own, lambda p: within(p, n)))
    across = let(F.struct(seam.alias("text"), (F.length(head) - left).alias("start")),
                 lambda t: _chunk_anchors(t["text"], t["start"]))
    moved = let(F.struct(F.length(tail).alias("n"), F.shiftleft(F.length(head).cast("long"), 32).alias("by")),
                lambda t: F.transform(F.filter(other, lambda p: within(p, t["n"])), lambda p: p + t["by"]))
    return F.concat(kept, across, moved)


def fingerprint(packed: Column, text: Column) -> Column:
    """The fingerprint of a text with these anchors: array<bigint> of gap * 2^32 + hash."""
    before = F.slice(F.concat(F.array(F.lit(0).cast("long")), packed), F.lit(1), F.size(packed))
    gaps = F.zip_with(packed, before, lambda p, b: p - b.bitwiseAND(F.lit(~HASH)))
    return (F.when(F.size(packed) > 0, gaps).when(text == "", F.array().cast("array<bigint>"))
            .otherwise(F.array(_short_hash(text))))


def anchors(text: Column) -> Column:
    """The fingerprint of a text."""
    return let(F.coalesce(text, F.lit("")), lambda t: let(positions(t), lambda packed: fingerprint(packed, t)))


def as_text(codes: Column) -> Column:
    """A fingerprint as text: nine lowercase hex digits for each anchor, the first one its gap."""
    return F.lower(F.array_join(F.transform(codes, lambda c: F.hex(c + (1 << 36)).substr(2, 9)), ""))


def likeness(a: Column, b: Column) -> Column:
    """Share of the anchors of both texts that are found in the other at the same distance from the one before."""
    different = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(different == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / different)


# Neighbours in the order of ids -------------------------------------------------------------------------------------

#: What tells different rows apart: the id (0 where it is null), whether it is null, and the hash of the text.
KEY = ("known_id", "no_id", "text_hash")


def _places(docs: DataFrame) -> tuple[DataFrame, int]:
    """The key and place (0, 1, ... in descending order of ids) of the different rows, and their number."""
    keys = docs.select(*KEY).distinct()
    order = (F.col("no_id").asc(), F.col("known_id").desc(), F.col("text_hash").asc())
    placed = checkpointed(keys.repartitionByRange(*order).sortWithinPartitions(*order)
                          .withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", ROW_BITS)
    # One row for each shuffle partition.
    sizes = sorted(tuple(r) for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    offsets = [(p, before) for (p, _), before in zip(sizes, [0, *accumulate(n for _, n in sizes)])]
    first = F.broadcast(docs.sparkSession.createDataFrame(offsets, "part long, before long"))
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return placed.join(first, part == F.col("part")).select(*KEY, place.alias("place")), sum(n for _, n in sizes)


def with_next(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """Each different (doc_id, text) with the anchors of the text, ``packed``, its number of ``copies``, and ``next_text`` and
    ``next_packed`` of what follows its last copy."""
    id_type = docs.schema["doc_id"].dataType
    docs = docs.select(F.coalesce("doc_id", F.lit(0).cast(id_type)).alias("known_id"), F.col("doc_id").isNull().alias("no_id"),
                       F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    places, n = _places(docs)
    blocks = max(-(-n // rows), 1)
    # Grouped by the join's key, so each text is shuffled here and to its block, and nowhere else.
    one = docs.groupBy(*KEY).agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    block = F.floor(F.col("place") / rows)
    at = lambda k, guest: F.struct(k.cast("long").alias("block"), F.lit(guest).alias("guest"))
    # The first row of a block is also the last to be seen in the block before.
    sent = one.join(places, list(KEY)).select(
        F.when(~F.col("no_id"), F.col("known_id")).alias("doc_id"), "text", "copies", "place",
        F.explode(F.when(F.col("place") % rows == 0, F.array(at(block, False), at(F.pmod(block - 1, F.lit(blocks)), True)))
                  .otherwise(F.array(at(block, False)))).alias("to"))
    beside = with_anchors(sent.select("doc_id", "text", "copies", "place", "to.block", "to.guest").repartition("block"),
                          ("block", "guest", "place"))
    order = Window.partitionBy("block").orderBy("guest", "place")
    following = beside.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in ("text", "packed")])
    return following.where(~F.col("guest")).drop("block", "guest", "place")


# The query ----------------------------------------------------------------------------------------------------------

def document_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_next(docs)
    # All copies of a row but the last are followed by a copy.
    last = F.struct(F.lit(1).cast("long").alias("times"), F.col("next_text").alias("text"), F.col("next_packed").alias("packed"))
    other = F.struct((F.col("copies") - 1).alias("times"), F.col("text").alias("text"), F.col("packed").alias("packed"))
    pairs = rows.select("doc_id", "text", "packed", F.explode(
        F.when(F.col("copies") > 1, F.array(last, other)).otherwise(F.array(last))).alias("next"))
    # The edited text: its last half (rounded down) is replaced by as much of the next one's start, or all of it.
    half = F.floor(F.length("text") / 2).cast("int")
    cut = pairs.select("*", F.col("text").substr(F.lit(1), F.length("text") - half).alias("head"),
                       F.col("next.text").substr(F.lit(1), half).alias("tail"))
    changed = cut.select("doc_id", "text", "packed", "next", F.concat("head", "tail").alias("edited"), spliced(
        F.col("packed"), F.col("head"), F.col("next.packed"), F.col("tail")).alias("edited_packed"))
    printed = changed.select(
        "doc_id", "text", "edited", "next.times", fingerprint(F.col("packed"), F.col("text")).alias("codes"),
        fingerprint(F.col("edited_packed"), F.col("edited")).alias("edited_codes"),
        fingerprint(F.col("next.packed"), F.col("next.text")).alias("next_codes"))
    found = printed.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("codes")).alias("fingerprint"), as_text(F.col("edited_codes")).alias("edited_fingerprint"),
        likeness(F.col("codes"), F.col("edited_codes")).alias("near_edited"),
        likeness(F.col("codes"), F.col("next_codes")).alias("near_next"), "times")
    few = found.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / COPIES))))
    return few.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.least(
        F.lit(COPIES), F.col("times") - F.col("part") * COPIES))).alias("copy")).drop("times", "part", "copy")
