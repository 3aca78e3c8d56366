"""Helpers shared by the operators of this subpackage.

Conventions that hold for every operator here:

* the text column may be null (treated as the docstring of the operator says) and
  texts are always processed whole;
* an operator keeps every input column and appends its own; an input column with
  the name of an output column is replaced by the output;
* intermediate tables go to the folder of ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from quire.session import ensure_checkpoint_dir

#: Text bytes that one vectorised step works on; a longer text is one step of its own.
SLICE_BYTES = 1 << 20

#: Rows that a worker turns into Python objects at once.
STEP_ROWS = 512

#: Words are runs of anything but these ASCII characters (also what bytes.split() splits at).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="quire-ship-"), "quire.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(package)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialize(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, and later reads prune columns."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(c, upper, upper.lower())


def texts_of(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, without decoding them."""
    col = batch.column(batch.schema.get_field_index(name))
    return col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()


def slices(texts: Sequence[bytes | None], limit: int = SLICE_BYTES) -> Iterator[range]:
    """Ranges of rows whose texts have ``limit`` bytes together (or one longer text)."""
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if size and size + n > limit:
            yield range(start, i)
            start, size = i, 0
        size += n
    if start < len(texts):
        yield range(start, len(texts))


def give_back() -> None:
    """Unused memory to the system: Spark keeps idle Python workers beside the next ones."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it
    if trim:
        trim(0)


def append_columns(
    df: DataFrame,
    fields: Sequence[StructField],
    make: Callable[[pa.RecordBatch], Sequence[pa.Array]],
    done: Callable[[], None] | None = None,
) -> DataFrame:
    """``df`` with ``fields`` appended; ``make`` returns their arrays for an Arrow batch of
    at most STEP_ROWS rows. Runs where the rows are: no shuffle. ``done`` is called at the
    end of each task."""
    ship(df.sparkSession)
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, STEP_ROWS):
                    part = batch.slice(at, STEP_ROWS)
                    old = [part.column(part.schema.get_field_index(n)) for n in names]
                    yield pa.RecordBatch.from_arrays([*old, *make(part)], names + [f.name for f in fields])
        finally:
            if done:
                done()
            give_back()

    return df.mapInArrow(run, StructType([*kept, *fields]))
