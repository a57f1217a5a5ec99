"""Quality rules with compression bands.

Base rules count words, symbols, repeated lines and words in repeated 3-word windows.
The compression rule compares the text with its zstandard frame: as a whole, and in
fixed chunks.  A low ratio means repetitive text, a high one incompressible text (keys,
random strings).  Short texts compress less, so both limits depend on the length.  Chunks outside
their limits reject a text where they follow one another for ``max_bad_run_bytes``, as a block of base64 or one
repeated block in an otherwise good text does, or where they are more than ``max_bad_chunk_share`` of all chunks.

Defined cases: a null text counts as empty; an empty text has zero words and fails the base
rules; repeated rows are judged each for itself; texts of any length are judged whole; an
empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.common import filter_arrow, map_arrow, schema_of

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Limits for texts of at most ``up_to`` bytes."""
    up_to: int
    lowest: float
    highest: float


@dataclass(frozen=True)
class Rules:
    min_words: int = 50
    max_repeat_percent: int = 50
    level: int = 3
    chunk_bytes: int = 4096
    min_chunk_bytes: int = 1024      # a shorter last chunk is joined to the one before
    max_bad_chunk_share: float = 0.25
    max_bad_run_bytes: int = 8192
    whole: tuple[Band, ...] = (Band(512, 0.30, 0.90), Band(2048, 0.25, 0.80), Band(8192, 0.20, 0.72),
                               Band(1 << 62, 0.15, 0.70))
    chunk: Band = field(default=Band(1 << 62, 0.20, 0.72))


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    size = len(index)
    pairs = ids[:-1] * size + ids[1:]
    if size >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    found = np.zeros(n - 2, bool)
    found[order[1:][same]] = True
    found[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k:n - 2 + k] |= found
    return int(covered.sum())


def dup_lines(raw: bytes) -> int:
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def compression_verdict(raw: bytes, rules: Rules, packer: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """The whole text's ratio, the share of chunks outside the limits, and whether the text is kept."""
    if not raw:
        return 0.0, 0.0, False
    whole = len(packer.compress(raw)) / len(raw)
    band = next(b for b in rules.whole if len(raw) <= b.up_to)
    kept = band.lowest <= whole <= band.highest
    bad = 0.0
    if len(raw) > rules.chunk_bytes:
        cuts = [*range(0, len(raw), rules.chunk_bytes), len(raw)]
        if cuts[-1] - cuts[-2] < rules.min_chunk_bytes:
            del cuts[-2]
        ratios = [len(packer.compress(raw[a:b])) / (b - a) for a, b in zip(cuts, cuts[1:], strict=False)]
        outside = [not rules.chunk.lowest <= r <= rules.chunk.highest for r in ratios]
        bad = sum(outside) / len(ratios)
        run = longest = 0
        for out, a, b in zip(outside, cuts, cuts[1:], strict=False):
            run = run + b - a if out else 0
            longest = max(longest, run)
        kept = kept and bad <= rules.max_bad_chunk_share and longest < rules.max_bad_run_bytes
    return whole, bad, kept


def judge(text: str, rules: Rules, packer: zstandard.ZstdCompressor) -> tuple:
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    repeated = repeat_words(words)
    failed = len(words) < rules.min_words or 100 * repeated > rules.max_repeat_percent * len(words)
    whole, bad, kept = compression_verdict(raw, rules, packer)
    return (len(words), len(text) - sum(map(text.count, SPACES)), sum(map(text.count, SYMBOLS)), dup_lines(raw),
            repeated, failed, kept and not failed, whole, bad)


COLUMNS = (("n_words", T.LongType()), ("word_chars", T.LongType()), ("n_symbols", T.LongType()),
           ("n_dup_lines", T.LongType()), ("n_repeat_words", T.LongType()), ("base_failed", T.BooleanType()),
           ("kept", T.BooleanType()), ("zstd_ratio", T.DoubleType()), ("bad_chunk_share", T.DoubleType()))


def quality_verdicts(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept, and the figures of the compression rule."""

    def worker():
        packer = zstandard.ZstdCompressor(level=rules.level)

        def each(batch: pa.RecordBatch) -> dict:
            rows = [judge(x or "", rules, packer) for x in batch.column("text").to_pylist()]
            return {"doc_id": batch.column("doc_id")} | {n: [r[k] for r in rows] for k, (n, _) in enumerate(COLUMNS)}
        return each

    return map_arrow(docs.select("doc_id", "text"), worker, schema_of(docs, ["doc_id"], *COLUMNS))


def keep_good(docs: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns."""
    at = docs.columns.index("text")

    def worker():
        packer = zstandard.ZstdCompressor(level=rules.level)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([judge(x or "", rules, packer)[6] for x in batch.column(at).to_pylist()],
                                         pa.bool_()))
        return each

    return filter_arrow(docs, worker)
