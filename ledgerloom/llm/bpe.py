"""BPE encoding and decoding with forced boundaries.

A merge joins two neighbouring symbols into a token of the vocabulary.  A pair of bytes that no
token holds side by side can therefore never be joined, so a word is cut at each such pair, the
fragments are encoded independently, and their ids are concatenated.  Fragments and words recur,
so both are remembered in bounded tables.

The tokenizer file gives normalizer, split pattern, vocabulary, merges and end-of-word suffix;
special tokens in a text become their ids, as in the tokenizers library.  Decoding joins the tokens
with one blank, as that library does for a file without a decoder.

Defined cases: a null text counts as empty; an empty text has no tokens; a long word costs
n log n; repeated rows are encoded each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterable
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Regex, normalizers, pre_tokenizers

from ledgerloom.llm.common import map_arrow, schema_of, texts

#: Words that a worker remembers at most, and fragments (an eighth of it); longer ones are merged each time, so
#: that the tables' memory is bounded too.
REMEMBERED, LONGEST_REMEMBERED = 1 << 18, 64
#: Fragments up to this length are scanned for each merge; longer ones use a heap.
SCANNED = 24
TOKEN_BITS = 24
TOKEN = (1 << TOKEN_BITS) - 1
NEVER = 1 << 62
#: Below this code point, Unicode's categories have not changed between versions.
SETTLED = 0x530
UNSETTLED = re.compile(f"[^\\x00-\\u{SETTLED - 1:04x}]")


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 characters
    stand for themselves, the others are numbered from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + others.index(b)) for b in range(256)]


def spelled_out(pattern: str) -> str:
    r"""``pattern`` with \p{L}, \p{N} and \s as the characters below SETTLED that they stand for."""
    def members(test) -> str:
        return "".join(f"\\u{c:04x}" for c in range(SETTLED) if test(chr(c)))

    letters = members(lambda c: unicodedata.category(c)[0] == "L")
    numbers = members(lambda c: unicodedata.category(c)[0] == "N")
    blanks = members(lambda c: c.isspace() and c not in "\x1c\x1d\x1e\x1f")
    return (pattern.replace("[\\p{N}]", "\\p{N}").replace("|\\p{N}|", f"|[{numbers}]|")
            .replace("\\p{L}", letters).replace("\\p{N}", numbers).replace("\\s", blanks))


class Encoder:
    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.tokens = {i: t for t, i in self.ids.items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        # Of a mergeable pair: its rank, and the token that it makes, in one number that orders by rank.
        self.ranks = {(self.ids[a], self.ids[b]): k << TOKEN_BITS | self.ids[a + b]
                      for k, (a, b) in reversed([*enumerate(merges)])}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.specials.items()}
        self.cut_specials = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")")
        steps = [x["type"] for x in spec["normalizer"]["normalizers"]]
        pieces = spec["pre_tokenizer"]["pretokenizers"]
        if steps != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in pieces] != ["Split", "ByteLevel"]:
            raise ValueError(f"{path}: another kind of tokenizer")
        pattern = pieces[0]["pattern"]["Regex"]
        self.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.splitter = pre_tokenizers.Split(Regex(pattern), "removed", invert=True)
        self.plain = re.compile(spelled_out(pattern))
        self.letters = byte_letters()
        self.first = [self.ids[c] for c in self.letters]
        self.last = [self.ids[c + self.suffix] for c in self.letters]
        self.joined = self._joined_bytes()
        self.fragment = lru_cache(REMEMBERED // 8)(self._fragment)
        self.of_word = lru_cache(REMEMBERED)(self._of_word)

    def _joined_bytes(self) -> list[bytearray]:
        """[a][b]: whether some token holds byte a directly before byte b."""
        joined = [bytearray(256) for _ in range(256)]
        byte = {c: b for b, c in enumerate(self.letters)}
        for token in self.ids:
            for a, b in pairwise([byte[c] for c in token.removesuffix(self.suffix)]):
                joined[a][b] = 1
        return joined

    def words(self, text: str) -> list[str]:
        """The words of normalized text: NFC, lower case of each character by itself, split by the pattern.
        The pattern never takes white space into a word, so blanks need no normalizing.  Below
        :data:`SETTLED`, ``re`` with spelled-out classes does this; for other characters the answer depends
        on the Unicode version, so the library's own normalizer and splitter are asked."""
        if text.isascii():
            return self.plain.findall(text.lower())
        if not UNSETTLED.search(text):
            normal = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # no final sigma
            if not UNSETTLED.search(normal):
                return self.plain.findall(normal)
        return [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def fragments(self, word: bytes) -> list[bytes]:
        """``word`` cut at all pairs of bytes that no token holds."""
        joined, out, at = self.joined, [], 0
        for k, (a, b) in enumerate(pairwise(word), 1):
            if not joined[a][b]:
                out.append(word[at:k])
                at = k
        out.append(word[at:])
        return out

    def _fragment(self, raw: bytes, ends: bool) -> tuple[int, ...]:
        """Merges the pair of lowest rank, leftmost first, until none is left."""
        ids = [self.first[b] for b in raw]
        if ends:
            ids[-1] = self.last[raw[-1]]
        if len(ids) > SCANNED:
            return self._by_heap(ids)
        get = self.ranks.get
        found = [get(p, NEVER) for p in pairwise(ids)]
        while found and (least := min(found)) < NEVER:
            k = found.index(least)
            ids[k] = least & TOKEN
            del ids[k + 1], found[k]
            if k:
                found[k - 1] = get((ids[k - 1], ids[k]), NEVER)
            if k < len(found):
                found[k] = get((ids[k], ids[k + 1]), NEVER)
        return tuple(ids)

    def _by_heap(self, ids: list[int]) -> tuple[int, ...]:
        """The same for long fragments: a linked list, and a heap of the pairs that can be merged."""
        n, ranks = len(ids), self.ranks
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = [(m >> TOKEN_BITS, k, m & TOKEN, a, b) for k, (a, b) in enumerate(pairwise(ids))
                if (m := ranks.get((a, b))) is not None]
        heapq.heapify(heap)

        def offer(k: int, j: int) -> None:
            if (m := ranks.get((ids[k], ids[j]))) is not None:
                heapq.heappush(heap, (m >> TOKEN_BITS, k, m & TOKEN, ids[k], ids[j]))

        while heap:
            _, k, new, a, b = heapq.heappop(heap)
            j = after[k]
            if ids[k] != a or j < 0 or ids[j] != b:
                continue
            ids[k], ids[j], after[k] = new, -1, after[j]
            if after[k] >= 0:
                before[after[k]] = k
                offer(k, after[k])
            if before[k] >= 0:
                offer(before[k], k)
        return tuple(i for i in ids if i >= 0)

    def _of_word(self, word: str) -> tuple[int, str, str, tuple[int, ...]]:
        """Tokens of a word: their number, ids and texts joined by blanks, and the ids."""
        *cut, last = self.fragments(word.encode("utf-8", "replace"))
        parts = [self._fragment_ids(part, False) for part in cut]
        return self.packed(tuple(chain(*parts, self._fragment_ids(last, True))))

    def _fragment_ids(self, raw: bytes, ends: bool) -> tuple[int, ...]:
        return (self.fragment if len(raw) <= LONGEST_REMEMBERED else self._fragment)(raw, ends)

    def packed(self, ids: tuple[int, ...]) -> tuple[int, str, str, tuple[int, ...]]:
        return len(ids), " ".join(map(str, ids)), " ".join(map(self.tokens.__getitem__, ids)), ids

    def encoded(self, text: str) -> list[tuple[int, str, str, tuple[int, ...]]]:
        """The packed tokens of each word and special token of ``text``."""
        out = []
        for k, part in enumerate(self.cut_specials.split(text)):
            if k % 2:
                out.append(self.packed((self.specials[part],)))
            elif part:
                words = self.words(part)
                if max(map(len, words), default=0) <= LONGEST_REMEMBERED:
                    out += map(self.of_word, words)
                else:
                    out += [(self.of_word if len(w) <= LONGEST_REMEMBERED else self._of_word)(w) for w in words]
        return out

    def encode(self, text: str) -> list[int]:
        return [i for p in self.encoded(text) for i in p[3]]

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(self.tokens[i] for i in ids if i in self.tokens)


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One for each Python worker."""
    return Encoder(path)


COLUMNS = (("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()))


def bpe_tokens(docs: DataFrame, path: str, carry: tuple[str, ...] = (), with_ids: bool = False) -> DataFrame:
    """One row per document: doc_id, the columns named in ``carry``, n_tokens, the digests of the ids and of the
    decoded text, and the ids themselves if ``with_ids``.  ``path`` must be readable on every executor."""
    own = [*COLUMNS, *([("ids", T.ArrayType(T.IntegerType()))] if with_ids else [])]
    keep = ["doc_id", *carry]

    def worker():
        tool = encoder(path)

        def each(batch: pa.RecordBatch) -> dict:
            out = {n: batch.column(n) for n in keep} | {n: [] for n, _ in own}
            ends, flat = [0], []
            for text in texts(batch):
                parts = tool.encoded(text)
                counts, ids, tokens, of_words = zip(*parts, strict=True) if parts else ((), (), (), ())
                out["n_tokens"].append(sum(counts))
                out["ids_sha256"].append(hashlib.sha256(" ".join(ids).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(" ".join(tokens).encode()).hexdigest())
                if with_ids:
                    flat.append(np.fromiter(chain.from_iterable(of_words), np.int32, sum(counts)))
                    ends.append(ends[-1] + out["n_tokens"][-1])
            if with_ids:
                out["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                      pa.array(np.concatenate(flat)))
            return out
        return each

    return map_arrow(docs.select(*keep, "text"), worker, schema_of(docs, keep, *own))
