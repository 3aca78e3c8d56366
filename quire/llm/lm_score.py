"""Cross-entropy difference: a target and a background bigram model over one vocabulary.

The vocabulary is every word of all texts. Both models are interpolated modified
Kneser-Ney, from the counts of all bigrams of all texts (background) and of the target
ones; the lowest order is uniform over the vocabulary. A text's score is the mean over
its words of the loss under the target model less that under the background: low scores
are like the target.

Nothing that grows with the input is collected or broadcast:

1. texts become chunks of about CHUNK_BYTES: their words, and each token's place among them;
2. words meet by hash and get numbers, which go back to the chunks that hold them;
3. the distinct bigrams of a chunk meet those of other chunks by hash; what comes back is
   how often each occurs;
4. the figures of a word (followers by count, distinct words before) are summed by its
   number and go back to the chunks;
5. a chunk then has all that the probabilities of its bigrams need, and gives one row a text.

What goes between chunks is one packed array for each chunk and group. A group is about
GROUP_TOKENS tokens; the bigrams that start with one of the HOT most frequent words of a
word group are dealt by the whole bigram, so no other word holds more than 1 / HOT of one.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.skew import join_small
from quire.session import let_go

from .char_lm import discounts, discounts_of, mix
from .common import give_back, materialize, ship, texts_of

#: Words of a table that ``log_probabilities`` is meant for.
SIZE = 1024
CHUNK_BYTES = 8 << 20
GROUP_TOKENS = 4 << 20
HOT = 64
#: Least discount: without one, a bigram never seen would have no probability.
LEAST = np.array([0.0, 0.01, 0.01, 0.01])
#: Figures of a word, for each model: tokens after it, words after it once, twice and more often.
FOLLOWERS = 4
#: The text before the first word.
START = 0
WORD_BITS = 32

_CHUNKS = "chunk long, n_tokens long, texts binary, lengths binary, target binary, tokens binary, words binary, counts binary"
_PARTS = "kind string, chunk long, at int, data binary, more binary, stats array<long>"


def pack(x: np.ndarray) -> bytes:
    """Numbers from 0 on, compressed, by byte of equal weight."""
    width = next(w for w in (1, 2, 4, 8) if not len(x) or int(x.max()) < 1 << 8 * w)
    planes = x.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return struct.pack("<BQ", width, len(x)) + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpack(data: bytes) -> np.ndarray:
    width, n = struct.unpack_from("<BQ", data)
    if not n:
        return np.zeros(0, dtype=np.int64)
    planes = pa.decompress(data[9:], n * width, codec="zstd", asbytes=True)
    planes = np.frombuffer(planes, dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64)


def joined(arrays: Sequence[np.ndarray]) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype=np.int64), *arrays])


def sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights=values, minlength=n).astype(np.int64)


def counts_of_counts(n: np.ndarray) -> list[int]:
    """How many are 1, 2, 3, 4, and 3 or more."""
    return [*(int((n == k).sum()) for k in (1, 2, 3, 4)), int((n >= 3).sum())]


def _chunk(number: int, texts: list[bytes], marks: list[bool]) -> dict:
    ids: defaultdict[bytes, int] = defaultdict()
    ids.default_factory = ids.__len__
    parts = [np.array([*map(ids.__getitem__, t.lower().split())], dtype=np.int64) for t in texts]
    words = list(ids)
    hashes = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words))
    order = np.argsort(hashes, kind="stable")
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    tokens = place[joined(parts)]
    return {
        "chunk": number,
        "n_tokens": len(tokens),
        "texts": b"".join(hashlib.sha256(t).digest() for t in texts),
        "lengths": pack(np.array([len(p) for p in parts])),
        "target": pack(np.array(marks, dtype=np.int64)),
        "tokens": pack(tokens),
        "words": b"\n".join(words[i] for i in order),
        "counts": pack(np.bincount(tokens, minlength=len(words))),
    }


def chunks_of(docs: DataFrame, text: str, target: str) -> DataFrame:
    """The texts with words; the words of a chunk are in the order of their hashes."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        schema = pa.schema([(n, pa.int64() if t == "long" else pa.binary()) for n, t in (f.split() for f in _CHUNKS.split(", "))])
        texts, marks, size = [], [], 0
        for batch in batches:
            for t, mark in zip(texts_of(batch, text), batch.column(1).to_pylist()):
                if t and not t.isspace():
                    texts.append(t)
                    marks.append(bool(mark))
                    size += len(t)
                if size >= CHUNK_BYTES:
                    yield pa.RecordBatch.from_pylist([_chunk(number, texts, marks)], schema)
                    number, texts, marks, size = number + 1, [], [], 0
        if texts:
            yield pa.RecordBatch.from_pylist([_chunk(number, texts, marks)], schema)
        give_back()

    return docs.select(text, target).mapInArrow(make, _CHUNKS)


def word_numbers(chunks: DataFrame, groups: int) -> DataFrame:
    """(chunk, at, ids): the numbers of the chunk's words of word group ``at``, in their order.
    A number is rank * groups + at + 1, the most frequent word of the group first."""

    def deal(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, n = row["words"].split(b"\n"), unpack(row["counts"])
                group = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words)) * groups >> 32
                ends = np.searchsorted(group, np.arange(groups + 1))
                parts = [(at, b, e) for at, (b, e) in enumerate(zip(ends[:-1], ends[1:])) if e > b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["chunk"]] * len(parts), pa.int64()),
                        pa.array([at for at, _, _ in parts], pa.int32()),
                        pa.array([b"\n".join(words[b:e]) for _, b, e in parts], pa.binary()),
                        pa.array([pack(n[b:e]) for _, b, e in parts], pa.binary()),
                    ],
                    ["chunk", "at", "words", "counts"],
                )

    def number(table: pa.Table) -> pa.Table:
        at = table["at"][0].as_py()
        rows = [w.split(b"\n") for w in table["words"].to_pylist()]
        total: dict[bytes, int] = {}
        for words, n in zip(rows, table["counts"].to_pylist()):
            for w, k in zip(words, unpack(n).tolist()):
                total[w] = total.get(w, 0) + k
        ids = {w: rank * groups + at + 1 for rank, w in enumerate(sorted(total, key=lambda w: (-total[w], w)))}
        if len(ids) * groups >= 1 << (WORD_BITS - 1):
            raise ValueError("more words than a bigram's number can hold")
        packed = [pack(np.fromiter(map(ids.__getitem__, words), dtype=np.int64, count=len(words))) for words in rows]
        return pa.table({"chunk": table["chunk"], "at": table["at"], "ids": pa.array(packed, pa.binary())})

    dealt = chunks.select("chunk", "words", "counts").mapInArrow(deal, "chunk long, at int, words binary, counts binary")
    return dealt.groupBy("at").applyInArrow(number, "chunk long, at int, ids binary")


def _ordered(table: pa.Table, name: str) -> list[bytes]:
    rows = sorted(zip(table["at"].to_pylist(), table[name].to_pylist()), key=lambda r: r[0])
    return [data for _, data in rows]


class Bigrams:
    """The distinct bigrams of a chunk, ordered by bigram group and number."""

    def __init__(self, row: dict, ids: np.ndarray, groups: int):
        tokens, lengths = unpack(row["tokens"]), unpack(row["lengths"])
        self.starts = np.cumsum(lengths) - lengths
        before = np.roll(tokens, 1)
        before[self.starts] = len(ids)  # START stands after the chunk's words
        codes, self.of_token = np.unique(before * len(ids) + tokens, return_inverse=True)
        self.first, self.second = np.divmod(codes, len(ids))
        first = np.append(ids, START)[self.first]
        self.numbers = (first << WORD_BITS) + ids[self.second]
        hot = (first - 1) // groups < HOT
        self.group = (mix(np.where(hot, self.numbers, first)) % np.uint64(groups)).astype(np.int64)
        self.order = np.lexsort((self.numbers, self.group))

    def marked(self, row: dict) -> np.ndarray:
        """How often each occurs in target texts."""
        return sums(self.of_token, np.repeat(unpack(row["target"]), unpack(row["lengths"])), len(self.numbers))


def dealt_bigrams(chunks: DataFrame, numbers: DataFrame, groups: int) -> DataFrame:
    """(chunk, at, numbers, n, target): the chunk's bigrams of bigram group ``at`` and their counts."""

    def deal(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {name: [] for name in ("chunk", "at", "numbers", "n", "target")}
        for row in left.to_pylist():
            b = Bigrams(row, joined([unpack(x) for x in _ordered(right, "ids")]), groups)
            number, group = b.numbers[b.order], b.group[b.order]
            n, marked = np.bincount(b.of_token)[b.order], b.marked(row)[b.order]
            ends = np.searchsorted(group, np.arange(groups + 1))
            for at, (x, y) in enumerate(zip(ends[:-1], ends[1:])):
                if y > x:
                    new = (row["chunk"], at, pack(np.diff(number[x:y], prepend=0)), pack(n[x:y]), pack(marked[x:y]))
                    for column, value in zip(out.values(), new):
                        column.append(value)
        types = (pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types)})

    own = chunks.select("chunk", "lengths", "target", "tokens")
    schema = "chunk long, at int, numbers binary, n binary, target binary"
    return own.groupBy("chunk").cogroup(numbers.groupBy("chunk")).applyInArrow(deal, schema)


def _parts(rows: list[tuple]) -> pa.Table:
    types = (pa.string(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
    names = [f.split()[0] for f in _PARTS.split(", ")]
    return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(zip(names, types))})


def bigram_counts(dealt: DataFrame, groups: int) -> DataFrame:
    """Rows of three kinds. ``count``: (chunk, at, counts, target counts) of the bigrams that the
    chunk has dealt to group ``at``. ``word``: (word group ``at``, words, their figures from this
    group's bigrams). ``all``: counts of counts and the figures of START."""

    def followers(at: np.ndarray, n: np.ndarray, size: int) -> list[np.ndarray]:
        return [sums(at, n, size), sums(at, n == 1, size), sums(at, n == 2, size), sums(at, n > 2, size)]

    def count(table: pa.Table) -> pa.Table:
        at = table["at"][0].as_py()
        dealt = [np.cumsum(unpack(x)) for x in table["numbers"].to_pylist()]
        number, place = np.unique(joined(dealt), return_inverse=True)
        both = [sums(place, joined([unpack(x) for x in table[c].to_pylist()]), len(number)) for c in ("n", "target")]
        rows, ends = [], np.cumsum([len(x) for x in dealt])
        for chunk, e, x in zip(table["chunk"].to_pylist(), ends, dealt):
            own = place[e - len(x) : e]
            rows.append(("count", chunk, at, pack(both[0][own]), pack(both[1][own]), None))
        first, second = number >> WORD_BITS, number & ((1 << WORD_BITS) - 1)
        words = np.union1d(np.append(first, START), second)
        i, j = np.searchsorted(words, first), np.searchsorted(words, second)
        figures = np.array([f for n in both for f in (*followers(i, n, len(words)), sums(j, n > 0, len(words)))])
        start = figures[:, 0]
        group = (words - 1) % groups
        for to in np.unique(group[1:]).tolist():
            own = np.flatnonzero(group[1:] == to) + 1
            rows.append(("word", None, to, pack(words[own]), pack(figures[:, own].ravel()), None))
        rows.append(("all", None, at, None, None, [*counts_of_counts(both[0]), *counts_of_counts(both[1]), *start.tolist()]))
        return _parts(rows)

    return dealt.groupBy("at").applyInArrow(count, _PARTS)


def word_figures(partial: DataFrame, numbers: DataFrame) -> DataFrame:
    """``word`` rows: (chunk, at, words, their figures over all bigrams) of the chunk's words of
    word group ``at``; ``all`` rows: counts of the counts of distinct words before, and words."""

    def add(left: pa.Table, right: pa.Table) -> pa.Table:
        dealt = [unpack(x) for x in left["data"].to_pylist()]
        words, place = np.unique(joined(dealt), return_inverse=True)
        parts = [unpack(x).reshape(2 * FOLLOWERS + 2, -1) for x in left["more"].to_pylist()]
        figures = np.array([sums(place, f, len(words)) for f in np.concatenate(parts, axis=1)])
        rows = []
        for chunk, at, ids in zip(*(right[c].to_pylist() for c in ("chunk", "at", "ids"))):
            own = np.searchsorted(words, unpack(ids))
            rows.append(("word", chunk, at, ids, pack(figures[:, own].ravel()), None))
        before = figures[FOLLOWERS], figures[2 * FOLLOWERS + 1]
        rows.append(("all", None, None, None, None, [*counts_of_counts(before[0]), *counts_of_counts(before[1]), len(words)]))
        return _parts(rows)

    return partial.groupBy("at").cogroup(numbers.groupBy("at")).applyInArrow(add, _PARTS)


def _total(parts: DataFrame, size: int) -> list[int]:
    """The ``all`` rows, added up."""
    row = parts.filter("kind = 'all'").agg(*(F.sum(F.col("stats")[i]) for i in range(size))).first()
    return [n or 0 for n in row]


class Model:
    """What all words share: discounts of both orders, and the mass left to the uniform one."""

    def __init__(self, high: Sequence[int], low: Sequence[int], start: Sequence[int], words: int):
        self.high, self.low = (np.maximum(discounts_of(n[:4]), LEAST) for n in (high, low))
        self.left = float(np.dot(self.low[1:], [low[0], low[1], low[4]]))
        self.bigrams, self.start, self.words = high[0] + high[1] + high[4], start, words

    def log_probability(self, n: np.ndarray, followers: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Of bigrams seen ``n`` times, with the figures of their first words and the number
        of distinct words before their second ones."""
        if not self.bigrams:
            return np.full(len(n), -np.log(self.words))
        low = np.maximum(before - self.low[np.minimum(before, 3)], 0) + self.left / self.words
        total = np.maximum(followers[0], 1)
        rest = np.where(followers[0] > 0, self.high[1:] @ followers[1:] / total, 1.0)
        return np.log(np.maximum(n - self.high[np.minimum(n, 3)], 0) / total + rest * low / self.bigrams)


def text_losses(chunks: DataFrame, counts: DataFrame, figures: DataFrame, models: Sequence[Model], groups: int, key: str) -> DataFrame:
    """(key, n_tokens, ce_target, ce_background), a row for each text of the chunks."""

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {key: [], "n_tokens": [], "ce_target": [], "ce_background": []}
        words = right.filter(pc.equal(right["kind"], "word"))
        found = right.filter(pc.equal(right["kind"], "count"))
        for row in left.to_pylist():
            b = Bigrams(row, joined([unpack(x) for x in _ordered(words, "data")]), groups)
            known = np.concatenate([unpack(x).reshape(2 * FOLLOWERS + 2, -1) for x in _ordered(words, "more")], axis=1)
            lengths = unpack(row["lengths"])
            out[key] += [row["texts"][i : i + 32] for i in range(0, len(row["texts"]), 32)]
            out["n_tokens"] += lengths.tolist()
            for at, (model, name, data) in enumerate(zip(models, ("ce_background", "ce_target"), ("data", "more"))):
                n = np.empty(len(b.numbers), dtype=np.int64)
                n[b.order] = joined([unpack(x) for x in _ordered(found, data)])
                own = known[at * (FOLLOWERS + 1) : (at + 1) * (FOLLOWERS + 1)]
                followers = np.column_stack([own[:FOLLOWERS], model.start])[:, b.first]
                loss = -model.log_probability(n, followers, own[FOLLOWERS][b.second])
                out[name] += (np.add.reduceat(loss[b.of_token], b.starts) / lengths).tolist()
        types = (pa.binary(), pa.int64(), pa.float64(), pa.float64())
        return pa.table({c: pa.array(v, t) for (c, v), t in zip(out.items(), types)})

    own = chunks.select("chunk", "texts", "lengths", "target", "tokens")
    sent = counts.unionByName(figures).select("chunk", "kind", "at", "data", "more")
    schema = f"`{key}` binary, n_tokens long, ce_target double, ce_background double"
    return own.groupBy("chunk").cogroup(sent.groupBy("chunk")).applyInArrow(score, schema)


def log_probabilities(counts: np.ndarray) -> np.ndarray:
    """The model of a vocabulary small enough for one table, by the word before (START last)
    and the word: the lower order counts the words that a word follows."""
    uniform = 1.0 / counts.shape[1]
    follows = (counts > 0).sum(axis=0).astype(float)
    if not follows.sum():
        return np.full(counts.shape, np.log(uniform))

    def smoothed(n, base):
        d = np.maximum(discounts(n[n > 0]), LEAST)[np.minimum(n, 3).astype(np.int64)]
        total = np.maximum(n.sum(axis=-1, keepdims=True), 1)
        rest = np.where(n.sum(axis=-1, keepdims=True) > 0, d.sum(axis=-1, keepdims=True) / total, 1.0)
        return np.maximum(n - d, 0) / total + rest * base

    return np.log(smoothed(counts, smoothed(follows, uniform)))


def _losses(docs: DataFrame, text: str, target: str, key: str) -> DataFrame:
    """``text_losses`` of all texts, one row for equal ones."""
    spark = docs.sparkSession
    ship(spark)
    chunks = materialize(chunks_of(docs, text, target), "lm-chunks")
    tokens = chunks.agg(F.sum("n_tokens")).first()[0] or 0
    groups = max(spark.sparkContext.defaultParallelism, -(-tokens // GROUP_TOKENS))
    numbers = materialize(word_numbers(chunks, groups), "lm-words")
    let_go(spark)
    counted = materialize(bigram_counts(dealt_bigrams(chunks, numbers, groups), groups), "lm-bigrams", ["kind"])
    let_go(spark)
    figures = materialize(word_figures(counted.filter("kind = 'word'"), numbers), "lm-figures", ["kind"])
    let_go(spark)
    high, low = _total(counted, 10 + 2 * FOLLOWERS + 2), _total(figures, 11)
    models = [
        Model(high[5 * at :][:5], low[5 * at :][:5], high[10 + at * (FOLLOWERS + 1) :][:FOLLOWERS], low[10]) for at in (0, 1)
    ]
    counts, words = counted.filter("kind = 'count'"), figures.filter("kind = 'word'")
    out = materialize(text_losses(chunks, counts, words, models, groups, key).dropDuplicates([key]), "lm-losses")
    let_go(spark)
    return out


def cross_entropy_difference(docs: DataFrame, target: str, text: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ce_target, ce_background and score, in nats a word.

    ``target`` is a boolean column; null counts as false. Words are runs of anything but
    ASCII space, A-Z lower-cased. A null or empty text has no words and null scores.
    Without target rows the target model is uniform. Repeated rows count each time. A long
    text is a chunk of its own, held whole by one task. No more than 2 ** 31 words. Losses
    are joined to ``docs`` by the SHA-256 of the text.
    """
    new = ("n_tokens", "ce_target", "ce_background", "score")
    kept = [c for c in docs.columns if c.lower() not in new]
    key = "_text_sha256"
    while key in {c.lower() for c in docs.columns}:
        key += "_"
    losses = _losses(docs, text, target, key)
    keyed = docs.select(*(F.col(f"`{c}`") for c in kept), F.unhex(F.sha2(F.col(f"`{text}`").cast("binary"), 256)).alias(key))
    keyed = keyed.withColumn(key, F.coalesce(key, F.lit(b"")))  # a hot key like any other, unlike null
    out = join_small(keyed, losses, key, "left", counts=lambda: keyed.groupBy(key).agg(F.count(F.lit(1)).alias("_n")), keep=False)
    return out.select(
        *(F.col(f"`{c}`") for c in kept),
        F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"),
        "ce_target",
        "ce_background",
        (F.col("ce_target") - F.col("ce_background")).alias("score"),
    )


def with_target(docs: DataFrame, labels: DataFrame, condition: str, doc_id: str = "doc_id", name: str = "is_target") -> DataFrame:
    """``docs`` with a boolean column: whether a label row of the id meets ``condition``."""
    marks = labels.filter(condition).select(doc_id).distinct().withColumn(name, F.lit(True))
    return join_small(docs.drop(name), marks, doc_id, "left").withColumn(name, F.coalesce(name, F.lit(False)))
