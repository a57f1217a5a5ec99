"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text's subwords are the character n-grams of its lower-cased words (letters with their combining marks, by Unicode
category), with a blank at either end.  Each is hashed to a row of an embedding table; the text's vector is their average, and a
linear softmax over it gives the languages.  Both are trained together by stochastic gradient
descent in numpy, on a bounded sample of labelled texts: at most ``sample_per_lang`` texts of each
language, those with the smallest hashes, and of each text one window of ``sample_chars``
characters at a hashed place.  Of more than ``most_langs`` labels the most frequent ones are learned.  Prediction always
uses the whole text, adding up pieces of at most ``PIECE`` characters that end at a blank (a piece without one is cut at its
end), so its memory does not grow with the text.

Calibration: a temperature, fitted on a fifth of the sample that the training does not see, makes
the scores probabilities; texts whose score is below ``threshold`` - chosen there so that at
least ``precision`` of the accepted texts are right - are marked as not accepted.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and is not
accepted; a null id is never held out nor used for training; repeated rows count once each; without
any labelled text all rows are ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import map_arrow, schema_of

UNKNOWN = "und"
PIECE = 1 << 16


@cache
def _kinds() -> np.ndarray:
    """For each code point 2 for a letter, 1 for a combining mark, else 0."""
    return np.array([{"L": 2, "M": 1}.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)], np.uint8)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _plain(text: str) -> np.ndarray:
    """Code points of the lower-cased words, with one blank before, between and after them; empty without a letter.
    Marks belong to a word where they follow a letter or another mark of it."""
    codes = _codes(text.lower())
    kinds = _kinds()[codes]
    if not (kinds == 2).any():
        return np.empty(0, np.uint32)
    # A mark counts if the last code point before it that is no mark is a letter.
    places = np.arange(len(codes))
    base = np.maximum.accumulate(np.where(kinds != 1, places, -1))
    part = (kinds == 2) | ((kinds == 1) & (base >= 0) & (kinds[np.maximum(base, 0)] == 2))
    keep = part.copy()
    keep[1:] |= part[:-1]  # the first code point after a word becomes its blank
    out = np.where(part, codes, np.uint32(32))[keep]
    return np.concatenate([[32], out, [32] if part[-1] else []]).astype(np.uint32)


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + size
        if end < len(text):
            blank = max(text.rfind(c, at, end) for c in " \n\t")
            end = blank if blank > at else end
        yield text[at:end]
        at = end


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    width: int = 16
    sizes: tuple[int, ...] = (1, 2, 3, 4)
    sample_per_lang: int = 1500      # bounds of the training sample
    most_langs: int = 200
    sample_chars: int = 600
    epochs: int = 6
    rate: float = 2.0
    seed: int = 17
    precision: float = 0.99


def subwords(text: str, settings: Settings) -> np.ndarray:
    """The buckets of all n-grams of the words of ``text`` (letters and their marks, lower case)."""
    codes = _plain(text)
    if len(codes) < 3:
        return np.empty(0, np.int64)
    blank = codes == 32
    found = []
    mix = np.zeros(len(codes), np.uint32)
    inner = np.zeros(len(codes), bool)   # whether a blank lies inside the n-gram, not at an end
    for n in range(1, max(settings.sizes) + 1):
        last = len(codes) - n + 1
        if last <= 0:
            break
        mix = mix[:last] * np.uint32(16777619) ^ codes[n - 1:]
        if n > 2:
            inner = inner[:last] | blank[n - 2:len(codes) - 1]
        if n in settings.sizes:
            keep = ~inner[:last] if n > 1 else ~blank[:last]
            h = mix[keep] * np.uint32(2654435761)
            found.append(((h ^ h >> np.uint32(15)) + np.uint32(n * 40503)) % np.uint32(settings.buckets))
    return np.concatenate(found).astype(np.int64)


@dataclass(frozen=True)
class Model:
    settings: Settings
    langs: tuple[str, ...]
    weights: np.ndarray      # buckets x languages: embedding rows times softmax weights
    bias: np.ndarray
    temperature: float
    threshold: float

    def logits(self, text: str) -> np.ndarray | None:
        total, n = np.zeros(len(self.langs)), 0
        for piece in pieces(text):
            found = subwords(piece, self.settings)
            total += self.weights[found].sum(0, dtype=np.float64)
            n += len(found)
        return total / n + self.bias if n else None

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.langs or not text or (z := self.logits(text)) is None:
            return UNKNOWN, 0.0
        p = softmax(z[None] / self.temperature)[0]
        best = int(p.argmax())
        return self.langs[best], min(1.0, float(p[best]))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(texts: list[str], langs: list[str], settings: Settings = Settings()) -> Model:
    names = tuple(sorted(set(langs)))
    bags = [subwords(t, settings) for t in texts]
    rows = [k for k, b in enumerate(bags) if len(b)]
    if not rows:
        return Model(settings, (), np.zeros((1, 0), np.float32), np.zeros(0), 1.0, 1.0)
    target = {n: k for k, n in enumerate(names)}
    y = np.array([target[x] for x in langs])
    rng = np.random.default_rng(settings.seed)
    rows = rng.permutation(rows)
    apart = rows[: len(rows) // 5]
    train = rows[len(rows) // 5:]
    embed = rng.uniform(-1, 1, (settings.buckets, settings.width)) / settings.width
    out, bias = np.zeros((settings.width, len(names))), np.zeros(len(names))
    share = len(train) / (len(names) * np.maximum(np.bincount(y[train], minlength=len(names)), 1))
    steps, total = 0, settings.epochs * len(train)
    for _ in range(settings.epochs):
        for k in rng.permutation(train):
            rate = settings.rate * (1 - steps / total) * min(share[y[k]], 10)
            steps += 1
            bag = bags[k]
            mean = embed[bag].mean(0)
            slope = softmax((mean @ out + bias)[None])[0]
            slope[y[k]] -= 1
            back = out @ slope
            out -= rate * np.outer(mean, slope)
            bias -= 0.1 * rate * slope
            np.subtract.at(embed, bag, rate * back / len(bag))
    weights = (embed @ out).astype(np.float32)
    raw = Model(settings, names, weights, bias, 1.0, 0.0)
    if not len(apart):
        return raw
    z = np.array([raw.logits(texts[k]) for k in apart])
    right = y[apart]
    grid = np.geomspace(0.05, 20, 60)
    loss = [-np.log(softmax(z / t)[np.arange(len(right)), right] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = softmax(z / temperature)
    order = np.argsort(-p.max(1), kind="stable")
    good = np.cumsum(p.argmax(1)[order] == right[order]) / np.arange(1, len(order) + 1)
    enough = np.flatnonzero(good >= settings.precision)
    threshold = float(p.max(1)[order][enough[-1]]) if len(enough) else 1.0
    return Model(settings, names, weights, bias, temperature, threshold)


def training_sample(docs: DataFrame, use: Column, settings: Settings) -> list[tuple[str, str]]:
    """(text window, language) of a bounded sample; the same for the same rows."""
    place = F.xxhash64(F.lit(settings.seed), "doc_id", "text")
    usable = (docs.where(use & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
              .select("lang", "text", place.alias("h")))
    # Repeated rows have one hash and count once.
    labels = usable.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("n"))
    counts = {r.lang: r.n for r in labels.orderBy(F.desc("n"), "lang").limit(settings.most_langs).collect()}
    if not counts:
        return []
    # Hashes are even, so a threshold per language leaves about sample_per_lang rows (with some
    # room, cut below), without sorting a language in one task.
    keep = F.lit(False)
    for lang, n in sorted(counts.items()):
        part = min(1.0, 1.2 * settings.sample_per_lang / n + 20 / n)
        highest = min(2**63 - 1, -2**63 + int(part * 2**64))
        keep = keep | ((F.col("lang") == lang) & (F.col("h") <= F.lit(highest)))
    size = settings.sample_chars
    start = F.pmod(F.col("h"), F.greatest(F.length("text") - size, F.lit(1))) + 1
    window = F.substr("text", start.cast("int"), F.lit(size))
    rows = usable.where(keep).groupBy("lang", "h").agg(F.min(window).alias("window")).collect()
    rows.sort(key=lambda r: (r.lang, r.h, r.window))
    seen: dict[str, int] = {}
    out = []
    for r in rows:
        seen[r.lang] = seen.get(r.lang, 0) + 1
        if seen[r.lang] <= settings.sample_per_lang:
            out.append((r.window, r.lang))
    return out


COLUMNS = (("lang_pred", T.StringType()), ("score", T.DoubleType()), ("accepted", T.BooleanType()))


def predict_languages(docs: DataFrame, model: Model, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, the columns in ``carry``, lang_pred, score, accepted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # buckets x languages floats
    keep = ["doc_id", *carry]

    def worker():
        tool = shared.value

        def each(batch: pa.RecordBatch) -> dict:
            rows = [tool.predict(x) for x in batch.column("text").to_pylist()]
            return {n: batch.column(n) for n in keep} | {
                "lang_pred": [r[0] for r in rows], "score": [r[1] for r in rows],
                "accepted": [r[0] != UNKNOWN and r[1] >= tool.threshold for r in rows]}
        return each

    return map_arrow(docs.select(*keep, "text"), worker, schema_of(docs, keep, *COLUMNS))


def language_ids(docs: DataFrame, held_out: Column, settings: Settings = Settings()) -> DataFrame:
    """Trains on the rows that are not held out and predicts all: doc_id, held_out, lang_pred, score, accepted."""
    marked = docs.select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    use = ~F.col("held_out") & F.col("doc_id").isNotNull()
    sample = training_sample(marked, use, settings)
    model = fit([t for t, _ in sample], [x for _, x in sample], settings)
    return predict_languages(marked, model, ("held_out",))
