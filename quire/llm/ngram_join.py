"""N-gram Jaccard join with signature trees.

1. Texts with one shingle set are one class (128-bit digest of the sorted hashes).
2. Two sets that link share their smallest common shingles, and these are among the first
   few of either set in hash order. These prefixes are the only shingles that are shuffled.
   A class fewer of whose prefix shingles stand in another prefix than any link needs has
   no link; the others fall into families, connected by the shingles that they share.
3. A family's sets meet in a signature tree: nodes hold the OR of their sets' token
   bitmaps, the range of sizes and the most tokens that share a bit. The dual traversal
   drops a pair of nodes if even the largest overlap that bitmaps and sizes allow is too
   small, or if all sets below are linked already; pairs at the leaves are verified exactly.
   A family of more shingles than TILE_SHINGLES is first divided by the same argument with
   the rarest shingles first, which passages that many texts quote do not survive. What
   is still as large is dealt into tiles; neighbouring tiles are joined first, and other
   pairs of tiles only where that has left several components.

Links are not expanded into all pairs: what is kept of a component is a spanning forest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators.skew import hot_keys, join_back, join_small

from .common import materialize, ship, texts_of
from .components import connected_components
from .shingles import shingle_set, word_hashes

TILE_SHINGLES = 1_000_000
#: Rows whose sets are held at once.
ROWS = 512
#: One in so many shingles is in a prefix beyond what one shared shingle asks for.
SPARE = 7
#: Bits of a node's bitmap, sets of a leaf.
BITS = 2048
LEAF = 32


def overlap_of(n, percent: int):
    """Shingles of a set of ``n`` that a linked set shares at least."""
    return (percent * n + 99) // 100


def spare_of(n):
    """Prefix shingles beyond the first shared one: as many must be shared."""
    return np.maximum(1, n // SPARE)


def needed_of(n, percent: int):
    """Prefix shingles of a set of ``n`` that stand in a linked set's prefix: a linked set
    has at least ``overlap_of(n)`` shingles, and both prefixes hold the pair's smallest
    common ones, as many as the smaller spare."""
    return spare_of(overlap_of(n, percent))


def _shingled(docs: DataFrame, text: str, doc_id: str, size: int, make, schema: str) -> DataFrame:
    """``make(ids, sets)`` over the batches; ids are the column doc_id."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sets = [shingle_set(words, size) for _, words in word_hashes(texts_of(part, part.schema.names[0]))]
                yield from make(part.column(1).to_pylist(), sets)

    return docs.select(F.col(text), F.col(doc_id)).mapInArrow(run, schema)


def _digest(s: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(s.tobytes())


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    return np.frombuffer(b"".join(map(_digest, sets)), dtype="<i8").reshape(-1, 2)


def set_digests(docs: DataFrame, text: str, doc_id: str, size: int) -> DataFrame:
    """(id, n, d1, d2): the size and digest of each row's set; 0, null, null without words."""

    def make(ids, sets):
        d = _digests(sets)
        n = np.array([len(s) for s in sets], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(n), pa.array(d[:, 0], mask=n == 0), pa.array(d[:, 1], mask=n == 0)],
            ["id", "n", "d1", "d2"],
        )

    return _shingled(docs.withColumn(doc_id, F.col(doc_id).cast("long")), text, doc_id, size, make, "id long, n long, d1 long, d2 long")


def prefix_rows(docs: DataFrame, text: str, doc_id: str, size: int, percent: int) -> DataFrame:
    """(token, d1, n): the prefix shingles of each set, copies within a batch left out."""

    def make(ids, sets):
        tokens, owner, sizes = [], [], []
        seen = set()
        for s in sets:
            if len(s) and (d := _digest(s)) not in seen:
                seen.add(d)
                n = len(s)
                tokens.append(s[: min(n, n - overlap_of(n, percent) + int(spare_of(n)))])
                owner.append(int.from_bytes(d[:8], "little", signed=True))
                sizes.append(n)
        lengths = [len(t) for t in tokens]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate([*tokens, np.zeros(0, np.uint64)]).astype(np.int64)),
                pa.array(np.repeat(np.array(owner, dtype=np.int64), lengths)),
                pa.array(np.repeat(np.array(sizes, dtype=np.int64), lengths)),
            ],
            ["token", "d1", "n"],
        )

    return _shingled(docs, text, doc_id, size, make, "token long, d1 long, n long")


def candidate_families(docs: DataFrame, text: str, doc_id: str, size: int, percent: int) -> DataFrame:
    """(d1, family) for the sets that may have a link; linked sets are of one family."""
    rows = prefix_rows(docs, text, doc_id, size, percent)
    tokens = (
        rows.groupBy("token")
        .agg(F.min("d1").alias("least"), F.max("d1").alias("last"), F.count("*").alias("_n"))
        .filter(F.col("least") < F.col("last"))
        .drop("least", "last")
    )
    tokens = materialize(tokens, "shared-shingles")
    shared = join_back(rows, tokens, "token", "inner", hot_keys(tokens, "token", "_n"))
    # Linked sets share as many prefix shingles as needed; the rarest of these is among all
    # but the last needed - 1 of either set's prefix, rarest first. Only these connect.
    needed = F.greatest(F.lit(1), F.floor(F.floor((F.lit(percent) * F.col("n") + 99) / 100) / SPARE)).cast("int")
    own = shared.groupBy("d1", "n").agg(F.sort_array(F.collect_set(F.struct("_n", "token"))).alias("tokens"))
    heads = own.withColumn("first", F.size("tokens") - needed + 1).filter("first > 0")
    heads = materialize(heads.select("d1", F.explode(F.slice("tokens", F.lit(1), F.col("first"))).alias("t")).select("d1", "t.token"), "heads")
    able = heads.select("d1").distinct()
    hubs = heads.groupBy("token").agg(F.min("d1").alias("hub"), F.count("*").alias("_n")).filter("_n > 1")
    stars = join_small(heads, hubs.select("token", "hub"), "token", "inner", counts=lambda: hubs.select("token", "_n"))
    labels = connected_components(stars.select(F.col("d1").alias("a"), F.col("hub").alias("b")).distinct())
    families = able.join(labels.withColumnRenamed("node", "d1"), "d1", "left").select("d1", F.coalesce("label", "d1").alias("family"))
    alone = families.groupBy("family").agg(F.count("*").alias("_k")).filter("_k > 1").select("family")
    return materialize(families.join(alone, "family"), "families")


class _Tree:
    """A binary tree over the sets [low, high) of an order, with the nodes' summaries."""

    def __init__(self, bitmaps, sizes, slack, low, high):
        self.low, self.high = low, high
        self.least, self.most = int(sizes[low:high].min()), int(sizes[low:high].max())
        self.slack = int(slack[low:high].max())
        self.below: tuple[_Tree, ...] = ()
        if high - low > LEAF:
            middle = (low + high) // 2
            self.below = _Tree(bitmaps, sizes, slack, low, middle), _Tree(bitmaps, sizes, slack, middle, high)
            self.bitmap = self.below[0].bitmap | self.below[1].bitmap
        else:
            self.bitmap = np.bitwise_or.reduce(bitmaps[low:high], axis=0)


def tree_links(sets: list[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs of sets that link, enough to connect whatever links connect; sets of one
    label are connected already."""
    if len(sets) < 2:
        return []
    whole = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, times = np.unique(whole, return_inverse=True, return_counts=True)
    twice = times[at] > 1  # a shingle of one set is in no overlap
    whole, owner = whole[twice], owner[twice]
    bitmaps = np.zeros((len(sets), BITS // 64), dtype=np.uint64)
    bit = (whole >> np.uint64(7)) % np.uint64(BITS)
    np.bitwise_or.at(bitmaps, (owner, (bit // np.uint64(64)).astype(np.int64)), np.uint64(1) << (bit % np.uint64(64)))
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    slack = np.bincount(owner, minlength=len(sets)) - np.bitwise_count(bitmaps).sum(axis=1).astype(np.int64)
    first = np.full(len(sets), np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(first, owner, whole)
    order = np.lexsort((sizes, first))  # sets that share much stand together
    bitmaps, sizes, slack, labels = bitmaps[order], sizes[order], slack[order], labels[order].copy()
    root = _Tree(bitmaps, sizes, slack, 0, len(sets))
    links, stack = [], [(root, root)]

    def uniform(x: _Tree, y: _Tree) -> bool:
        one = labels[x.low]
        return bool((labels[x.low : x.high] == one).all() and (labels[y.low : y.high] == one).all())

    def enough(overlap, a, b):
        """Whether sets of sizes a, b with this overlap link: overlap over union."""
        return (100 + percent) * overlap >= percent * (a + b)

    while stack:
        x, y = stack.pop()
        top = min(x.most, y.most, int(np.bitwise_count(x.bitmap & y.bitmap).sum()) + min(x.slack, y.slack))
        if not enough(top, x.least, y.least) or uniform(x, y):
            continue
        if x.below and y.below:
            if x is y:
                stack += [(x.below[0], x.below[0]), (x.below[1], x.below[1]), (x.below[0], x.below[1])]
            else:
                stack += [(a, b) for a in x.below for b in y.below]
            continue
        if x.below or y.below:
            stack += [(a, y) for a in x.below] or [(x, b) for b in y.below]
            continue
        i, j = np.arange(x.low, x.high), np.arange(y.low, y.high)
        common = np.bitwise_count(bitmaps[i][:, None, :] & bitmaps[j][None, :, :]).sum(axis=2).astype(np.int64)
        most = common + np.minimum(slack[i][:, None], slack[j][None, :])
        may = enough(most, sizes[i][:, None], sizes[j][None, :]) & (labels[i][:, None] != labels[j][None, :])
        if x is y:
            may &= i[:, None] < j[None, :]
        for p, q in zip(*np.nonzero(may)):
            a, b = i[p], j[q]
            if labels[a] == labels[b]:
                continue
            s, t = sets[order[a]], sets[order[b]]
            if enough(len(np.intersect1d(s, t, assume_unique=True)), len(s), len(t)):
                links.append((int(order[a]), int(order[b])))
                labels[labels == labels[b]] = labels[a]
    return links


def _join_group(percent: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(b, dtype=np.uint64) for b in group["shingles"]]
        links = tree_links(sets, group["label"].to_numpy(), percent)
        ids = group["id"].to_numpy()
        return pd.DataFrame({"a": ids[[i for i, _ in links]], "b": ids[[j for _, j in links]]}, dtype="int64")

    return run


def divided(sets: DataFrame, percent: int) -> DataFrame:
    """(id, family) of sets (id, shingles), families by the rarest shingles: ordered by
    the number of sets that hold them, linked sets share one of their first
    n - overlap_of(n) + 1. Sets that share none are left out."""

    def explode(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                blobs = batch.column(1).slice(at, ROWS).to_pylist()
                sizes = np.array([len(b) // 8 for b in blobs], dtype=np.int64)
                ids = np.array(batch.column(0).slice(at, ROWS).to_pylist(), dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(b"".join(blobs), dtype=np.int64)), pa.array(np.repeat(ids, sizes)), pa.array(np.repeat(sizes, sizes))],
                    ["token", "id", "n"],
                )

    rows = sets.select("id", "shingles").mapInArrow(explode, "token long, id long, n long")
    held = materialize(rows.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"), "held-shingles")
    shared = join_back(rows, held, "token", "inner", hot_keys(held, "token", "df"))
    own = shared.groupBy("id", "n").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("tokens"))
    # Shingles that no other set holds come first, and link nothing.
    first = F.col("n") - F.floor((F.lit(percent) * F.col("n") + 99) / 100) + 1 - (F.col("n") - F.size("tokens"))
    heads = own.filter(first > 0).select("id", F.explode(F.slice("tokens", F.lit(1), first.cast("int"))).alias("t")).select("id", "t.token")
    heads = materialize(heads, "rare-shingles")
    hubs = heads.groupBy("token").agg(F.min("id").alias("hub"), F.count("*").alias("_n")).filter("_n > 1")
    edges = join_small(heads, hubs.select("token", "hub"), "token", "inner", counts=lambda: hubs.select("token", "_n"))
    labels = connected_components(edges.select(F.col("id").alias("a"), F.col("hub").alias("b")))
    ends = labels.select(F.col("label").alias("node"), "label").distinct()
    return labels.unionByName(ends).select(F.col("node").alias("id"), F.col("label").alias("family"))


def class_links(docs: DataFrame, classes: DataFrame, text: str, doc_id: str, size: int, percent: int) -> DataFrame:
    """(a, b): links between classes (by their smallest id) that connect all linked ones.
    classes: id (the smallest), n, d1, d2."""
    families = candidate_families(docs, text, doc_id, size, percent)
    members = materialize(classes.join(families, "d1").select("id", "n", "family"), "members")
    own = docs.select(F.col(text).alias("_text"), F.col(doc_id).cast("long").alias("id"))
    sets = _sets(join_small(own, members.select("id", "family"), "id", "inner", counts=None), size)
    sets = materialize(sets.dropDuplicates(["id"]), "sets")
    tiles = members.groupBy("family").agg(F.ceil(F.sum("n") / TILE_SHINGLES).cast("int").alias("tiles"), F.count("*").alias("_n"))
    tiles = materialize(tiles, "family-tiles")
    dealt = join_small(sets, tiles.drop("_n"), "family", "inner", counts=lambda: tiles.select("family", "_n"))
    schema = "a long, b long"
    small = dealt.filter("tiles = 1").withColumn("label", F.col("id"))
    links = small.groupBy("family").applyInPandas(_join_group(percent), schema)
    if tiles.filter("tiles > 1").isEmpty():
        return materialize(links, "links")

    large = materialize(dealt.filter("tiles > 1").drop("tiles", "family"), "large-families")
    families = materialize(divided(large, percent), "divided")
    sizes = members.select("id", "n").join(families, "id")
    tiles = sizes.groupBy("family").agg(F.ceil(F.sum("n") / TILE_SHINGLES).cast("int").alias("tiles"), F.count("*").alias("_n"))
    tiles = materialize(tiles.filter("_n > 1"), "divided-tiles")
    large = join_small(large, families, "id", "inner", counts=None)
    large = join_small(large, tiles.drop("_n"), "family", "inner", counts=lambda: tiles.select("family", "_n"))
    large = materialize(large.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")), "tiles")
    neighbours = F.when(F.col("tiles") <= 2, F.array(F.lit(0))).otherwise(F.array(F.col("tile"), F.pmod(F.col("tile") + 1, F.col("tiles"))))
    near = large.withColumn("label", F.col("id")).withColumn("pair", F.explode(neighbours))
    links = materialize(links.unionByName(near.groupBy("family", "pair").applyInPandas(_join_group(percent), schema)), "links")

    large = large.filter("tiles > 3")
    if large.isEmpty():
        return links
    labels = connected_components(links).withColumnRenamed("node", "id")
    labelled = large.select("id", "family").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    several = labelled.groupBy("family").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("family")
    labelled = materialize(join_small(labelled, several, "family", "inner", counts=None).select("id", "label"), "open-labels")
    far = (
        join_small(large, labelled, "id", "inner", counts=None)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .filter(F.pmod(F.col("other") - F.col("tile"), F.col("tiles")).between(F.lit(2), F.col("tiles") - 2))
        .withColumn("low", F.least("tile", "other"))
        .withColumn("high", F.greatest("tile", "other"))
    )
    return links.unionByName(far.groupBy("family", "low", "high").applyInPandas(_join_group(percent), schema))


def _sets(wanted: DataFrame, size: int) -> DataFrame:
    """(id, family, shingles) of the rows (_text, id, family)."""
    ship(wanted.sparkSession)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sets = [shingle_set(words, size).tobytes() for _, words in word_hashes(texts_of(part, "_text"))]
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(sets, pa.binary())], ["id", "family", "shingles"])

    return wanted.select("_text", "id", "family").mapInArrow(run, "id long, family long, shingles binary")


def ngram_join(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row: the size of its set of ``size``-word
    shingles, and the smallest id that links reach, its own included.

    Two rows link if their sets' overlap is ``percent`` % of their union or more. Words are
    runs of anything but ASCII space, A-Z lower-cased; a text with fewer words is one
    shingle; one without words (or null) has none and links with nothing. Ids are integers;
    rows with one id are each judged by their own text, and a row without id links with
    nothing and has no component. An empty table gives an empty result. Whole texts count.
    """
    rows = materialize(set_digests(docs, text, doc_id, size), "digests")
    known = rows.filter("id IS NOT NULL AND n > 0")
    classes = materialize(known.groupBy("d1", "d2").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.count("*").alias("_n")), "classes")
    links = class_links(docs.filter(F.col(doc_id).isNotNull()), classes, text, doc_id, size, percent)
    labels = connected_components(links).withColumnRenamed("node", "id")
    found = classes.join(labels, "id", "left").select("d1", "d2", F.coalesce("label", "id").alias("component_id"))
    found = join_small(rows, found, ["d1", "d2"], "left", counts=lambda: classes.select("d1", "d2", "_n"))
    own = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return found.select(F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), own.alias("component_id"))
