"""Ranked lexical search with range-maximum tables over posting lists.

Each task indexes its own documents in blocks. A block has one posting list per query
term, in document order, and one sparse table over all lists: for every place and power
of two it names the posting of greatest impact (a term's share of the score) from there
on, so the greatest impact of a term in any interval of documents is two look-ups.

A query goes through a block best first. An interval of documents waits under its bound,
the sum of its terms' range maxima. The best interval is split at the document that holds
the greatest of these maxima; that document is scored and the two sides wait under their
own, smaller bounds. An interval of few postings is scored whole. The search ends when no
bound reaches the k-th best score, which a task carries from block to block.

Documents are never shuffled: what leaves a task is at most k rows a query. Statistics
(documents, terms, documents of each query term) cover the whole table. Queries are
taken in blocks of bounded size; each block reads the documents once.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from .common import give_back, materialize, ship, texts_of

#: Terms (summed over queries) and their bytes that one block of queries has at most,
#: unless a single query has more.
QUERY_TERMS = 200_000
QUERY_BYTES = 16 << 20
#: Postings that a task indexes at once (or one document's, if more).
BLOCK_POSTINGS = 400_000
#: Intervals of so many postings are scored whole.
LEAF_POSTINGS = 1_024
#: Texts of one step, in rows.
STEP = 256

#: A term's bytes: ASCII digits and letters and all beyond ASCII; A-Z become a-z, all else blank.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


@dataclass
class Queries:
    """A block of queries: ``ids`` their values, ``terms[i]`` the term numbers of query i,
    ``number`` the terms' numbers."""

    ids: list
    terms: list[np.ndarray]
    number: dict[bytes, int]


def query_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[Queries]:
    """The queries with their distinct terms, in blocks. Rows of one id are one query; a
    query without terms has no results and is left out."""
    ship(items.sparkSession)
    kind = items.schema[item_id].dataType
    out = StructType([StructField("item", kind), StructField("term", BinaryType())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, t in enumerate(texts_of(batch, "text")):
                found = list(set(terms_of(t)))
                item = batch.column(0).take(pa.array([row] * len(found), pa.int32()))
                yield pa.RecordBatch.from_arrays([item, pa.array(found, pa.binary())], ["item", "term"])

    renamed = items.select(F.col(item_id).alias("item"), F.col(text).alias("text"))
    rows = renamed.mapInArrow(split, out).distinct()
    ids, terms, number = [], [], {}
    size = n_bytes = 0
    for item, term in rows.orderBy("item", "term").toLocalIterator():
        if not ids or ids[-1] != item:
            if size > QUERY_TERMS or n_bytes > QUERY_BYTES:
                yield Queries(ids, [np.array(t) for t in terms], number)
                ids, terms, number, size, n_bytes = [], [], {}, 0, 0
            ids.append(item)
            terms.append([])
        term = bytes(term)
        terms[-1].append(number.setdefault(term, len(number)))
        size += 1
        n_bytes += len(term)
    if ids:
        yield Queries(ids, [np.array(t) for t in terms], number)


def query_postings(docs: DataFrame, doc_id: str, text: str, queries: Queries) -> DataFrame:
    """(doc, n, terms, tfs): for every document that has a term, the number of its terms
    and, packed as 32-bit integers, the query terms in it with their occurrences."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(queries.number)
    kind = docs.schema[doc_id].dataType
    fields = [StructField("doc", kind), StructField("n", LongType()), StructField("terms", BinaryType()), StructField("tfs", BinaryType())]

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                rows, n, terms, tfs = [], [], [], []
                for row, t in enumerate(texts_of(part, "text")):
                    words = terms_of(t)
                    if not words:
                        continue
                    found = Counter([w for w in words if w in number])
                    rows.append(row)
                    n.append(len(words))
                    terms.append(np.fromiter(map(number.__getitem__, found), np.uint32, len(found)).tobytes())
                    tfs.append(np.fromiter(found.values(), np.uint32, len(found)).tobytes())
                docs_of = part.column(0).take(pa.array(rows, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [docs_of, pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(tfs, pa.binary())],
                    [f.name for f in fields],
                )
        give_back()

    return docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("text")).mapInArrow(tally, StructType(fields))


def _packed(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return np.frombuffer(b"".join(texts_of(batch, name)), np.uint32).astype(np.int64)


def document_frequencies(postings: DataFrame, size: int) -> np.ndarray:
    """For each of ``size`` term numbers the documents that hold it; a task sends one row a
    term, and the driver gets as many as the block of queries has terms."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(size, np.int64)
        for batch in batches:
            n += np.bincount(_packed(batch, "terms"), minlength=size)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(n[held], pa.int64())], ["term", "df"])

    rows = postings.select("terms").mapInArrow(tally, "term long, df long").groupBy("term").agg(F.sum("df"))
    out = np.zeros(size, np.int64)
    for term, df in rows.collect():
        out[term] = df
    return out


class Block:
    """The posting lists of a block of documents, one after the other, by term."""

    def __init__(self, terms: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_terms: int, n_docs: int):
        order = np.argsort(terms, kind="stable")  # documents came in order
        self.docs, self.impacts, self.n_docs = docs[order], impacts[order], n_docs
        lists = terms[order]
        self.starts = np.searchsorted(lists, np.arange(n_terms + 1))
        self.keys = lists * n_docs + self.docs
        longest = int(np.diff(self.starts).max(initial=0))
        levels, width = [np.arange(len(lists), dtype=np.int32)], 1
        while 2 * width <= longest:
            a = levels[-1]
            b = np.concatenate([a[width:], a[len(a) - width :]])
            levels.append(np.where(self.impacts[a] >= self.impacts[b], a, b))
            width *= 2
        self.table = np.stack(levels)
        self.log = np.zeros(longest + 1, np.int64)
        for i in range(2, longest + 1):
            self.log[i] = self.log[i // 2] + 1

    def maxima(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and impacts of the greatest postings in [left, right), none of them empty."""
        level = self.log[right - left]
        a, b = self.table[level, left], self.table[level, right - (1 << level)]
        of_a, of_b = self.impacts[a], self.impacts[b]
        first = of_a >= of_b
        return np.where(first, a, b), np.where(first, of_a, of_b)

    def search(self, query: np.ndarray, best: Best, name: Sequence) -> None:
        """Offer ``best`` every document whose score can be among its k; name[d] is document d."""
        left, right = self.starts[query], self.starts[query + 1]
        waiting: list = []
        turn = count()

        def wait(query, left, right):
            there = right > left
            if there.any():
                query, left, right = query[there], left[there], right[there]
                places, impacts = self.maxima(left, right)
                if (bound := int(impacts.sum())) >= best.least:
                    heapq.heappush(waiting, (-bound, next(turn), query, left, right, places[impacts.argmax()]))

        wait(query, left, right)
        while waiting:
            bound, _, query, left, right, place = heapq.heappop(waiting)
            if -bound < best.least:
                break
            n = right - left
            if n.sum() <= LEAF_POSTINGS:
                ends = n.cumsum()
                held = np.arange(ends[-1]) + np.repeat(left - ends + n, n)
                docs = self.docs[held]
                first = int(docs.min())
                # Sums below 2 ** 53, so doubles hold them exactly.
                scores = np.bincount(docs - first, weights=self.impacts[held])
                for d in np.flatnonzero(scores >= best.least):
                    best.offer(int(scores[d]), name[int(d) + first])
                continue
            d = int(self.docs[place])
            at = np.clip(np.searchsorted(self.keys, query * self.n_docs + d), left, right)
            hit = at < right
            hit[hit] = self.docs[at[hit]] == d
            best.offer(int(self.impacts[at[hit]].sum()), name[d])
            wait(query, left, at)
            wait(query, at + hit, right)


class Best:
    """The k best (score, document) so far, equal scores by ascending document, null first."""

    def __init__(self, k: int):
        self.k, self.rows = k, []
        self.least = 1  # lower scores cannot enter

    def offer(self, score: int, doc) -> None:
        if score < self.least:
            return
        row = (score, Last(doc))
        if len(self.rows) < self.k:
            heapq.heappush(self.rows, row)
        elif row > self.rows[0]:
            heapq.heapreplace(self.rows, row)
        if len(self.rows) == self.k:
            self.least = self.rows[0][0]


class Last:
    """Orders documents backwards, so that the heap's least row has the greatest of them."""

    __slots__ = ("doc",)

    def __init__(self, doc):
        self.doc = doc

    def __lt__(self, other) -> bool:
        return self.doc is not None and (other.doc is None or other.doc < self.doc)

    def __eq__(self, other) -> bool:
        return self.doc == other.doc


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def _search_block(postings: DataFrame, queries: Queries, item_kind, k: int) -> DataFrame:
    """(item, doc, score): at most k rows a query and task."""
    spark = postings.sparkSession
    stats = postings.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = stats["docs"], stats["terms"] or 1
    of_term = weights(document_frequencies(postings, len(queries.number)), n_docs)
    shared = spark.sparkContext.broadcast((queries.ids, queries.terms, of_term))
    doc_kind = postings.schema["doc"].dataType
    fields = [StructField("item", item_kind), StructField("doc", doc_kind), StructField("score", LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, terms, weight = shared.value
        best = [Best(k) for _ in ids]

        def search(held: list) -> None:
            name = [d for names, *_ in held for d in names]
            per_doc = np.concatenate([x[1] for x in held])
            n, t, tf = (np.concatenate([x[i] for x in held]) for i in (2, 3, 4))
            doc = np.repeat(np.arange(len(name)), per_doc)
            m = 50 + (50 * n * n_docs) // n_terms
            impacts = weight[t] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
            some = impacts > 0
            if not some.any():
                return
            block = Block(t[some], doc[some], impacts[some], len(weight), len(name))
            for query, own in zip(terms, best):
                block.search(query, own, name)

        held, size = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                per_doc = np.array([len(x) // 4 for x in texts_of(part, "terms")], np.int64)
                n = part.column(1).to_numpy(zero_copy_only=False)
                held.append((part.column(0).to_pylist(), per_doc, n, _packed(part, "terms"), _packed(part, "tfs")))
                size += int(per_doc.sum())
                if size >= BLOCK_POSTINGS:
                    search(held)
                    held, size = [], 0
        if held:
            search(held)
        out = [(i, row[1].doc, row[0]) for i, own in zip(ids, best) for row in own.rows]
        for at in range(0, len(out), 10_000):
            columns = list(zip(*out[at : at + 10_000]))
            kinds = (to_arrow_type(item_kind), to_arrow_type(doc_kind), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [f.name for f in fields])
        give_back()

    return postings.mapInArrow(run, StructType(fields))


def _top(rows: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy("item", *by).orderBy(F.desc("score"), F.asc("doc"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def ranked_search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): for each item its k documents of highest score above
    0, equal scores by ascending doc_id.

    A null or empty text has no terms; items without terms have no rows. Rows of one
    item_id (null counts as one) are one item with all their terms. Repeated document rows
    are documents of their own and count as such; among rows equal in score and doc_id any
    order is the same. A null doc_id comes before others. Texts are read whole. Empty
    tables give no rows. No other column of either table is read, so their names cannot
    clash."""
    spark = docs.sparkSession
    item_kind = items.schema[item_id].dataType
    # Two steps, so that no task gets the rows of an item from all tasks.
    salts = max(1, math.isqrt(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    found = None
    for queries in query_blocks(items, item_id, item_text):
        postings = materialize(query_postings(docs, doc_id, text, queries), "postings")
        rows = _search_block(postings, queries, item_kind, k)
        found = rows if found is None else found.unionByName(rows)
    if found is None:
        kinds = [StructField("item", item_kind), StructField("doc", docs.schema[doc_id].dataType), StructField("score", LongType())]
        found = spark.createDataFrame([], StructType(kinds))
    some = _top(found.withColumn("salt", F.pmod(F.xxhash64("doc", "score"), F.lit(salts))), k, "salt").drop("salt", "rank")
    return _top(some, k).select(
        F.col("item").alias(item_id),
        F.col("rank").cast(IntegerType()).alias("rank"),
        F.col("doc").alias(doc_id),
        "score",
    )
