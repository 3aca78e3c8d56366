"""Byte-level BPE encoding and decoding with a contiguous rank array.

A short word keeps its part boundaries and, beside them, the rank of the pair that starts
at each boundary; the least rank is found by a scan, one boundary is deleted, and the two
neighbouring ranks are refreshed. For words over LONG_WORD bytes the scan would cost the
square of the length; they take the same merges from a heap.

The vocabulary file (tokenizers' JSON format) is read on the driver and broadcast: its
size is that of the vocabulary. Ids are kept packed, 4 bytes little-endian each.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterable
from functools import cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BinaryType, LongType, StringType, StructField

from .common import append_columns, texts_of

LONG_WORD = 128
#: Words that a worker remembers; it starts anew when full.
CACHE_WORDS = 100_000
#: Fixed value: how byte-level BPE splits a text before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"""


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in vocabulary files: a printable Latin-1 character
    for itself, the other bytes in order from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """ranks: (left id, right id) -> (rank, merged id); special: text -> id."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        ids = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.of_byte = [0] * 256
        for letter, b in letters.items():
            self.of_byte[b] = ids[letter]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[ids[a], ids[b]] = rank, ids[a + b]
        size = max([*ids.values(), *self.special.values()]) + 1
        self.bytes = [b""] * size
        for token, i in ids.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()

    def state(self) -> tuple:
        return self.ranks, self.of_byte, self.bytes, self.special


NONE = 1 << 60


def merge_short(parts: list[int], ranks: dict) -> list[int]:
    """parts: ids of the word's bytes. pair[i] is the rank of parts[i], parts[i + 1]."""
    missing = (NONE, 0)
    pair = [ranks.get(p, missing) for p in zip(parts, parts[1:])]
    while pair:
        best = min(pair)
        if best[0] == NONE:
            break
        i = pair.index(best)
        parts[i] = best[1]
        del parts[i + 1], pair[i]
        if i < len(pair):
            pair[i] = ranks.get((parts[i], parts[i + 1]), missing)
        if i:
            pair[i - 1] = ranks.get((parts[i - 1], parts[i]), missing)
    return parts


def merge_long(parts: list[int], ranks: dict) -> list[int]:
    """As ``merge_short``, least rank first and leftmost among equals, from a heap."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p][0], i, p) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, p = heapq.heappop(heap)
        j = after[i]
        if j >= n or (parts[i], parts[j]) != p or parts[i] < 0:
            continue
        parts[i], parts[j] = ranks[p][1], -1
        after[i] = k = after[j]
        if k < n:
            before[k] = i
        for a, b in ((before[i], i), (i, k)):
            if a >= 0 and b < n and (q := (parts[a], parts[b])) in ranks:
                heapq.heappush(heap, (ranks[q][0], a, q))
    return [x for x in parts if x >= 0]


class Codec:
    def __init__(self, state: tuple):
        self.ranks, self.of_byte, self.bytes, self.special = state
        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.words: dict[str, tuple[int, ...]] = {}

    def word(self, word: str) -> tuple[int, ...]:
        parts = [self.of_byte[b] for b in word.encode("utf-8")]
        return tuple((merge_short if len(parts) <= LONG_WORD else merge_long)(parts, self.ranks))

    def encode(self, text: str) -> array:
        out = array("I")
        for piece in self.cut.split(text) if self.cut else [text]:
            if piece in self.special:
                out.append(self.special[piece])
                continue
            for w in self.split.findall(piece):
                ids = self.words.get(w)
                if ids is None:
                    ids = self.word(w)
                    if len(w) <= LONG_WORD:
                        if len(self.words) >= CACHE_WORDS:
                            self.words.clear()
                        self.words[w] = ids
                out.extend(ids)
        return out


def decode(ids: array, tokens: list[bytes]) -> str:
    return b"".join([tokens[i] for i in ids]).decode("utf-8", "replace")


_CODECS: dict[tuple[str, str], Codec] = {}


def _codec(key: tuple[str, str], shared) -> Codec:
    """One per task and vocabulary: ``_forget`` ends it, else idle workers would hold its words."""
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value)
    return _CODECS[key]


def _forget() -> None:
    _CODECS.clear()


@cache
def _state(path: str) -> tuple:
    return Vocabulary(path).state()


def _share(spark: SparkSession, path: str, decode: bool = False):
    """The cache's key and the broadcast state; decoding needs the tokens' bytes alone."""
    sc, state = spark.sparkContext, _state(path)
    return (sc.applicationId, path), sc.broadcast(state[2] if decode else state)


def bpe_encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with ``ids`` (binary, the text's token ids packed as little-endian unsigned
    32-bit integers) and n_tokens. Special tokens' strings in a text become their ids,
    none are added. A null text is an empty one. Runs where the rows are."""
    key, shared = _share(docs.sparkSession, vocabulary)

    def make(batch: pa.RecordBatch):
        return _encoded(batch, text, _codec(key, shared))

    return append_columns(docs, [StructField(ids, BinaryType()), StructField("n_tokens", LongType())], make, _forget)


def _encoded(batch: pa.RecordBatch, text: str, codec: Codec) -> list[pa.Array]:
    packed, n = [], []
    for t in batch.column(batch.schema.get_field_index(text)).to_pylist():
        found = codec.encode(t) if t else array("I")
        n.append(len(found))
        packed.append(found.tobytes())
    return [pa.array(packed, pa.binary()), pa.array(n, pa.int64())]


def _decoded(packed: Iterable[bytes | None], tokens: list[bytes]) -> pa.Array:
    out = []
    for ids in packed:
        found = array("I")
        found.frombytes(ids or b"")
        out.append(decode(found, tokens))
    return pa.array(out, pa.string())


def bpe_decode(docs: DataFrame, vocabulary: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with ``decoded``, the text of the packed ids; special tokens stand as their
    strings, null or empty ids give an empty text, bytes that are no UTF-8 become U+FFFD."""
    _, shared = _share(docs.sparkSession, vocabulary, decode=True)

    def make(batch: pa.RecordBatch):
        return [_decoded(texts_of(batch, ids), shared.value)]

    return append_columns(docs, [StructField(decoded, StringType())], make)


def bpe_round_trip(docs: DataFrame, vocabulary: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``bpe_decode(bpe_encode(docs))`` in one pass: a task keeps one Python worker, not two."""
    key, shared = _share(docs.sparkSession, vocabulary)

    def make(batch: pa.RecordBatch):
        codec = _codec(key, shared)
        packed, n = _encoded(batch, text, codec)
        return [packed, n, _decoded(packed.to_pylist(), codec.bytes)]

    fields = [StructField(ids, BinaryType()), StructField("n_tokens", LongType()), StructField(decoded, StringType())]
    return append_columns(docs, fields, make, _forget)
