"""Dump rewriting as a Structured Streaming job.

The line rewrite is stateless, so it runs unchanged on a stream: new dump files
dropped into ``source`` are rewritten and appended to ``sink`` as text, with
exactly-once file output tracked in ``checkpoint`` (a folder every executor and
the driver can reach). ``available_now`` processes what is there and stops.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.operators.dump import normalize_line


def normalize_dump_stream(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(source)
    rewritten = lines.select(normalize_line(F.col("value")).alias("value"))
    writer = (
        rewritten.writeStream.format("text")
        .option("path", sink)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
