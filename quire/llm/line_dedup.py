"""Line dedup with a sharded minimal perfect hash.

1. Every line's 128-bit key hash, once per document, is counted by Spark; the hashes
   found in two documents or more are kept, with the smallest document.
2. They are dealt into shards by their first half. A shard is one minimal perfect hash
   and three arrays: fingerprints (the second half), document counts and first documents.
3. Each document's line hashes go to their shard and probe its arrays in bulk; the hits
   that belong to a later document come back as that document's lines to drop. No lines
   are joined, and no hash passes through the driver.

A line that a third of all documents hold is pre-aggregated before the shuffle in step 1;
in step 3 the shard that holds it is copied over several tasks, by the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from . import mph
from .common import append_columns, materialize, ship, texts_of

MIN_CODE_POINTS = 10
#: Probes that one task should answer.
SHARD_PROBES = 400_000
#: At most so many shards are copied over several tasks: bounds what is broadcast.
MAX_HOT = 4096
_SHARD_SCHEMA = (
    "shard int, sizes array<int>, bits array<binary>, rest binary, fingerprints binary, counts binary, firsts binary"
)


def key_of(line: bytes) -> bytes | None:
    """The line stripped of ASCII space and with A-Z lower-cased; None if too short to count."""
    key = line.strip().lower()
    n = len(key)
    if n < MIN_CODE_POINTS or (n < 4 * MIN_CODE_POINTS and not key.isascii() and len(key.decode()) < MIN_CODE_POINTS):
        return None
    return key


def _digests(text: bytes | None) -> list[bytes | None]:
    return [k if k is None else xxhash.xxh3_128_digest(k) for k in map(key_of, (text or b"").split(b"\n"))]


def line_hashes(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(first, second, doc): each document's distinct line hashes. Rows without id give none."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_pylist()
            found, owner, sizes = [], [], []
            for i, t in zip(ids, texts_of(batch, batch.schema.names[0])):
                if i is not None and t:
                    own = {d for d in _digests(t) if d is not None}
                    found.extend(own)
                    owner.append(i)
                    sizes.append(len(own))
            halves = np.frombuffer(b"".join(found), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(np.repeat(np.array(owner, dtype=np.int64), sizes))],
                ["first", "second", "doc"],
            )

    return docs.select(F.col(text), F.col(doc_id).cast("long")).mapInArrow(run, "first long, second long, doc long")


def _build_shard(keys: pd.DataFrame) -> pd.DataFrame:
    first = keys["first"].to_numpy().astype(np.uint64)
    # Two keys with one first half: the later ones are kept apart, behind the shard's own.
    order = np.lexsort((keys["second"].to_numpy(), first))
    keys, first = keys.iloc[order], first[order]
    once = np.concatenate([[True], first[1:] != first[:-1]])
    table = mph.build(first[once])
    at = table.index(first[once])
    own = keys[once].iloc[np.argsort(at)]
    all_ = pd.concat([own, keys[~once]])
    sizes, bits, rest = table.pack()
    extra = first[~once].tobytes()
    return pd.DataFrame([{
        "shard": int(keys["shard"].iloc[0]),
        "sizes": sizes,
        "bits": [*bits, extra],
        "rest": rest,
        "fingerprints": all_["second"].to_numpy(np.int64).tobytes(),
        "counts": all_["n"].to_numpy(np.int64).astype(np.int32).tobytes(),
        "firsts": all_["doc"].to_numpy(np.int64).tobytes(),
    }])


def _probe(probes: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
    """The probes that hit a line first found in a smaller document."""
    if probes.empty or arrays.empty:
        return pd.DataFrame({"doc": pd.Series(dtype="int64"), "first": pd.Series(dtype="int64"), "n_docs": pd.Series(dtype="int64")})
    shard = arrays.iloc[0]
    bits = list(shard["bits"])
    table = mph.PerfectHash.unpack(shard["sizes"], bits[:-1], shard["rest"])
    fingerprints = np.frombuffer(shard["fingerprints"], dtype=np.int64)
    counts, firsts = np.frombuffer(shard["counts"], dtype=np.int32), np.frombuffer(shard["firsts"], dtype=np.int64)
    first, second, doc = (probes[c].to_numpy() for c in ("first", "second", "doc"))
    at = table.index(first.astype(np.uint64))
    at[(at >= 0) & (fingerprints[at] != second)] = -1
    for k, x in enumerate(np.frombuffer(bits[-1], dtype=np.uint64)):
        j = table.size + k
        at[(first.astype(np.uint64) == x) & (second == fingerprints[j])] = j
    hit = (at >= 0) & (firsts[at] < doc)
    return pd.DataFrame({"doc": doc[hit], "first": first[hit], "n_docs": counts[at[hit]].astype(np.int64)})


def repeated_lines(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """(doc, first, n_docs): the line hashes that a document loses, with the number of
    documents that hold the line."""
    spark = docs.sparkSession
    lines = line_hashes(docs, text, doc_id)
    shared = (
        lines.groupBy("first", "second")
        .agg(F.count("*").alias("n"), F.min("doc").alias("doc"), F.max("doc").alias("last"))
        .filter(F.col("doc") < F.col("last"))
        .drop("last")
    )
    shared = materialize(shared, "shared-lines")
    # All line hashes are probes, so the shards follow from all lines; which are hot follows
    # from the repeated ones, as the others even out over the shards.
    held = shared.agg(F.sum("n")).first()[0] or 0
    breaks = F.length(text) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    probes = docs.agg(F.sum(breaks.cast("long") + 1)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-probes // SHARD_PROBES))
    shard_of = F.pmod(F.col("first"), F.lit(shards)).cast("int")
    shared = shared.withColumn("shard", shard_of)
    least = max(2 * SHARD_PROBES, held // MAX_HOT)
    hot = shared.groupBy("shard").agg(F.sum("n").alias("n")).filter(F.col("n") > least)
    copies = hot.select("shard", F.ceil(F.col("n") / SHARD_PROBES).cast("int").alias("copies")).collect()  # MAX_HOT rows at most
    copies = F.broadcast(spark.createDataFrame(copies, "shard int, copies int"))
    n_copies = F.coalesce(F.col("copies"), F.lit(1))
    arrays = (
        shared.groupBy("shard").applyInPandas(_build_shard, _SHARD_SCHEMA)
        .join(copies, "shard", "left")
        .withColumn("part", F.explode(F.sequence(F.lit(0), n_copies - 1)))
        .drop("copies")
    )
    probes = (
        lines.withColumn("shard", shard_of)
        .join(copies, "shard", "left")
        .withColumn("part", F.pmod(F.xxhash64("doc"), n_copies).cast("int"))
        .drop("copies")
    )
    return (
        probes.groupBy("shard", "part")
        .cogroup(arrays.groupBy("shard", "part"))
        .applyInPandas(_probe, "doc long, first long, n_docs long")
    )


def line_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` with the text's repeated lines dropped, and n_lines (before), n_dropped.

    A line is one if its key (``key_of``) has MIN_CODE_POINTS code points and is found in
    two documents or more; it stays in the smallest document id that holds it, as often as
    it stands there. Lines are what \\n separates; the kept ones are joined by \\n. A null
    text is an empty one: one empty line, and the result is empty, not null. Rows with one
    id are one document. A row without id loses nothing. An empty table stays empty.
    """
    drops = (
        repeated_lines(docs, text, doc_id)
        .groupBy("doc")
        .agg(F.collect_list("first").alias("_drop"))
        .withColumnRenamed("doc", "_doc")
    )
    joined = docs.join(drops, docs[doc_id].cast("long") == F.col("_doc"), "left").drop("_doc")

    def kept(batch: pa.RecordBatch):
        out, n_lines, n_dropped = [], [], []
        for t, gone in zip(texts_of(batch, text), batch.column(batch.schema.get_field_index("_drop")).to_pylist()):
            t = t or b""
            if gone:
                gone = set(gone)
                lines, marks = t.split(b"\n"), _digests(t)
                left = [x for x, d in zip(lines, marks) if d is None or int.from_bytes(d[:8], "little", signed=True) not in gone]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(left))
                out.append(b"\n".join(left))
            else:
                n_lines.append(t.count(b"\n") + 1)
                n_dropped.append(0)
                out.append(t)
        return [pa.array(out, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]

    fields = [StructField(text, StringType()), StructField("n_lines", LongType()), StructField("n_dropped", LongType())]
    order = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return append_columns(joined, fields, kept).select(*order, "n_lines", "n_dropped")
