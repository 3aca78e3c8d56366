"""SQL text cut into statements, across lines and file splits.

A ``;`` ends a statement only outside quotes and comments, so whether it does depends on
everything before it in the file. Each file split (chunk) is therefore first summed up as
a function: for every state that the text before it may end in, the state that the chunk
ends in and whether a statement ends inside. These functions compose, one small row a
chunk, so the start state of every chunk is known without reading the file in one task.
Then each chunk is cut from its start state. What reaches over a chunk's end is put
together from its pieces, at most two a chunk; whole statements are never shuffled.

Strings in single or double quotes (backslash escapes and doubled quotes), names in
backticks, ``-- `` and ``#`` comments to the end of the line and ``/* */`` comments are
known. Comments are left out, but ``/*! */`` ones, which are text. DELIMITER commands are
not followed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import ship_package

CODE, SINGLE, DOUBLE, BACKTICK, LEFT_OUT, KEPT = range(6)
STATES = 6
_MARK = re.compile(r"['\"`;#]|/\*!?|--(?=\s|$)")
_QUOTES = {"'": SINGLE, '"': DOUBLE, "`": BACKTICK}
#: Up to the closing mark, which is group 1 if it is in this line.
_REST = {
    SINGLE: re.compile(r"(?s)(?:[^'\\]++|\\.)*+(')?"),
    DOUBLE: re.compile(r'(?s)(?:[^"\\]++|\\.)*+(")?'),
    BACKTICK: re.compile(r"(?s)[^`]*+(`)?"),
    LEFT_OUT: re.compile(r"(?s)(?:[^*]++|\*(?!/))*+(\*/)?"),
    KEPT: re.compile(r"(?s)(?:[^*]++|\*(?!/))*+(\*/)?"),
}
#: Chunks whose states the driver composes: one row each.
MAX_CHUNKS = 1_000_000
#: A statement longer than this has lost its end; it would be put together in one task.
MAX_BYTES = 1 << 30
END = None


def scan(line: str, state: int) -> tuple[int, list]:
    """(state after the line, parts): the line's text without comments, cut, with END after
    each part that ends a statement."""
    parts: list = []
    start = at = 0
    while at <= len(line):
        if state != CODE:
            rest = _REST[state].match(line, at)
            if not rest.group(1):
                break
            at = rest.end()
            if state == LEFT_OUT:
                start = at
            state = CODE
            continue
        mark = _MARK.search(line, at)
        if not mark:
            break
        found, at = mark.group(), mark.end()
        if found == ";":
            parts += [line[start:at], END]
            start = at
        elif found in _QUOTES:
            state = _QUOTES[found]
        elif found == "/*!":
            state = KEPT
        else:
            parts.append(line[start : mark.start()])
            start = len(line)
            if found != "/*":  # a comment to the end of the line
                return CODE, parts
            state = LEFT_OUT
    if state != LEFT_OUT and start < len(line):
        parts.append(line[start:])
    return state, parts


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], Iterator[str]]]:
    """(file, offset) and lines of each run of rows; a chunk may come in several runs."""
    for batch in batches:
        files, offsets, lines = (c.to_pylist() for c in batch.columns)
        at = 0
        for i in range(1, len(lines) + 1):
            if i == len(lines) or (files[i], offsets[i]) != (files[at], offsets[at]):
                yield (files[at], offsets[at]), lines[at:i]
                at = i


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a chunk: its state function, where a statement ends, and its length."""
    ends: dict[tuple[str, int], list] = {}
    for key, lines in _chunks(batches):
        state, cut, size = ends.setdefault(key, [list(range(STATES)), [False] * STATES, 0])
        for line in lines:
            after = {s: scan(line, s) for s in set(state)}
            cut[:] = [c or END in after[s][1] for c, s in zip(cut, state)]
            state[:] = [after[s][0] for s in state]
            size += len(line) + 1
        ends[key][2] = size
    rows = [(f, o, *v) for (f, o), v in ends.items()]
    columns = [list(c) for c in zip(*rows)] if rows else [[]] * 5
    kinds = (pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["file", "offset", "after", "cut", "size"])


def compose(chunks: list[tuple]) -> dict[tuple[str, int], tuple[int, int]]:
    """(start state, offset where the statement open at the start begins) of each chunk,
    from the chunks' (file, offset, after, cut, size). A file starts outside quotes."""
    out = {}
    file, state, owner, size = None, CODE, 0, 0
    for name, offset, after, cut, length in sorted(chunks):
        if name != file:
            file, state, owner, size = name, CODE, offset, 0
        out[name, offset] = state, owner
        size += length
        if cut[state]:
            owner, size = offset, 0
        elif size > MAX_BYTES:
            raise ValueError(f"the statement that begins in {file} after byte {owner} has no end within {MAX_BYTES} bytes")
        state = after[state]
    return out


def statements(lines: DataFrame) -> DataFrame:
    """(value, load_order): the statements of ``lines``, which has value (a line without its
    break) and load_order (file, offset, row) as ``sources.read_dump_lines`` gives them,
    straight from the scan: its rows in file order within each file split.

    ``value`` ends with the statement's ``;`` (the last one of a file may have none);
    statements without text are left out. ``load_order`` is (file, offset of the split it
    begins in, number within the split). The lines are scanned three times: for the state
    functions, for whole statements, and for the pieces at the ends of splits. The split
    size of the session must stay the same until the result has been computed."""
    spark = lines.sparkSession
    ship_package(spark)
    scanned = lines.select("load_order.file", "load_order.offset", "value")
    summary = scanned.mapInArrow(_summaries, "file string, offset long, after array<int>, cut array<boolean>, size long")
    rows = [tuple(r) for r in summary.limit(MAX_CHUNKS + 1).collect()]
    if len(rows) > MAX_CHUNKS:
        raise ValueError(f"more than {MAX_CHUNKS} file splits: raise spark.sql.files.maxPartitionBytes")
    starts = spark.sparkContext.broadcast(compose(rows))
    schema = "value string, file string, offset long, row long, piece long"

    def cut(pieces: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out: list[tuple] = []
            key = state = None
            text: list[str] = []

            def put(owner: int, row: int, piece: int | None) -> None:
                value = "".join(text)
                text.clear()
                if pieces and piece is not None:
                    out.append((value, key[0], owner, row, piece))
                elif not pieces and piece is None and value.strip() != ";":
                    out.append((value.strip(), key[0], owner, row, piece))

            def close() -> None:
                # What is left begins here if any statement ended here.
                put(key[1] if n else owner, TAIL, key[1])

            def flush() -> pa.RecordBatch:
                columns = [list(c) for c in zip(*out)] if out else [[]] * 5
                out.clear()
                kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64())
                return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["value", "file", "offset", "row", "piece"])

            owner = n = 0
            for now, found in _chunks(batches):
                if now != key:
                    if key:
                        close()
                    key, n = now, 0
                    state, owner = starts.value[key]
                for line in found:
                    state, parts = scan(line, state)
                    for part in parts:
                        if part is not END:
                            text.append(part)
                        elif n or key[1] == owner:  # it begins in this chunk
                            n += 1
                            put(key[1], n, None)
                        else:
                            n += 1
                            put(owner, TAIL, key[1])
                    text.append("\n")
                if len(out) >= 1000:
                    yield flush()
            if key:
                close()
            yield flush()

        return run

    whole = scanned.mapInArrow(cut(False), schema).select("value", "file", "offset", "row")
    parts = scanned.mapInArrow(cut(True), schema)
    # A statement's pieces: as many as the chunks it reaches over, MAX_BYTES together.
    joined = parts.groupBy("file", "offset", "row").agg(F.sort_array(F.collect_list(F.struct("piece", "value"))).alias("_p"))
    text = F.regexp_replace(F.concat_ws("", F.col("_p.value")), r"^\s++|(?<!\s)\s++\z", "")
    joined = joined.select(text.alias("value"), "file", "offset", "row").filter("value not in ('', ';')")
    return whole.unionByName(joined).select("value", F.struct("file", "offset", "row").alias("load_order"))


#: Place of the statement that a chunk ends in, after all that it holds whole.
TAIL = 1 << 62
