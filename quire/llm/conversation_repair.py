"""Conversation structure repair by alignment with the alternating grammar.

A conversation is legal when its roles' initials read ``(s?(ua)+)?``. Faulty ones are
repaired by the cheapest edits: Keep (0), Rerole to user or assistant (1), Delete (2),
Insert an empty user or assistant turn (5). Blank turns and repeats must be deleted; a
truncated turn that stays adds 5. Of equally cheap edits the ones whose initials come
first in ASCII order are taken.

The turns that may stay are aligned with the grammar string by Wagner and Fischer's table,
filled from the end: the last q letters of every feasible length are the same, so one
table holds the costs of all lengths, and a leading system turn is a start of its own.
A greedy alignment gives an incumbent cost C. By Ukkonen's argument no cell further than
C / 2 surplus turns or C / 5 missing ones from the diagonal lies on a cheapest path, so
only that band is filled. Every length of least cost is traced back, and the audits are
compared.

Faults of single turns are found with DataFrame functions; a conversation is then one run
of sorted rows in one task. The table has a byte a cell of the band.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import give_back, ship

DELETE, INSERT, RETITLE, TRUNCATED = 2, 5, 1, 5
LEGAL_PAIRS = {"su", "ua", "au"}
ROLES = {"u": "user", "a": "assistant"}
SPACES = " \t\n\x0b\x0c\r"
FAR = 1 << 30
D, I, K, R = b"DIKR"
#: Conversations that a task returns at once.
STEP = 256


def expected(left: int) -> str:
    """The grammar's letter where ``left`` letters are left, this one included."""
    return "a" if left % 2 else "u"


def incumbent(initials: Sequence[str], late: Sequence[bool]) -> int:
    """Cost of a quick alignment: a wrong role is deleted if the next turn fits, else changed."""
    cost, want = 0, "u"
    for i, letter in enumerate(initials):
        if late[i]:
            cost += DELETE
        elif letter == want or i + 1 == len(initials) or initials[i + 1] != want:
            cost += RETITLE * (letter != want)
            want = "a" if want == "u" else "u"
        else:
            cost += DELETE
    return cost + INSERT * (want == "a")


class Table:
    """Cheapest edits of turns i.. into the grammar's last q letters, within the band.

    Column c of row i stands for q = n - i - surplus + c. ``choice[i, c]`` is the first in
    ASCII order of the edits that a cheapest path can take there. ``cost`` is the least of
    all starts, ``starts`` the (i, q) that have it: the whole conversation, or what follows
    a system turn that is kept after deleting all before it. Among such system turns of
    one cost the last gives the audit with most D in front, so only that one is kept."""

    def __init__(self, initials: Sequence[str], late: Sequence[bool], bound: int):
        self.n = n = len(initials)
        self.surplus = min(n, bound // DELETE)
        width = self.surplus + bound // INSERT + 1
        self.choice = np.zeros((n + 1, width), np.uint8)
        self.cost, self.starts = FAR, []
        columns = np.arange(width)
        rise = INSERT * columns
        row = np.full(width, FAR)
        row[self.surplus] = 0
        edits = np.zeros(width, np.uint8)
        for i in range(n, -1, -1):
            q = columns + (n - i - self.surplus)
            if i < n:
                deleted = np.append(row[1:], FAR) + DELETE
                fits = (q % 2 == 1) if initials[i] == "a" else (q % 2 == 0) & (initials[i] == "u")
                stays = np.where(q >= 1, row + np.where(fits, 0, RETITLE) + TRUNCATED * late[i], FAR)
                edits = np.where(deleted <= stays, D, np.where(fits, K, R))
                row = np.where(q >= 0, np.minimum(deleted, stays), FAR)
            best = np.minimum(np.minimum.accumulate(row - rise) + rise, FAR)
            inserted = np.append(FAR, best[:-1] + INSERT)
            self.choice[i] = np.where((inserted == best) & ((row > best) | (edits > I)), I, edits)
            row = best
            if i and initials[i - 1] == "s":
                self._start(i, q, row, 2, DELETE * (i - 1) + TRUNCATED * late[i - 1])
            if not i:
                self._start(i, q, row, 0, 0)

    def _start(self, i: int, q: np.ndarray, row: np.ndarray, shortest: int, before: int) -> None:
        whole = np.where((q >= shortest) & (q % 2 == 0), row, FAR)
        cost = int(whole.min())
        if cost >= FAR or cost + before > self.cost:
            return
        if cost + before < self.cost:
            self.cost, self.starts = cost + before, []
        elif i:
            return  # a later system turn is as cheap
        self.starts += [(i, int(x)) for x in q[whole == cost]]

    def edits(self, i: int, q: int) -> str:
        out = ["D" * (i - 1) + "K"] if i else []
        while i < self.n or q:
            edit = chr(self.choice[i, q - (self.n - i) + self.surplus])
            out.append(edit)
            i += edit != "I"
            q -= edit != "D"
        return "".join(out)


def with_deletions(edits: str, kept: Sequence[int], n: int) -> str:
    """``edits`` of the turns ``kept`` as edits of all ``n`` turns; the others are deleted
    as soon as they are reached, D being the first letter."""
    out, at, turn = [], 0, 0
    for edit in edits:
        stop = kept[at] if at < len(kept) else n
        out.append("D" * (stop - turn) + edit)
        turn = stop
        if edit != "I":
            at, turn = at + 1, stop + 1
    out.append("D" * (n - turn))
    return "".join(out)


def cheapest_edits(initials: Sequence[str], unfit: Sequence[bool], late: Sequence[bool]) -> tuple[int, str]:
    """Cost and audit for turns of these initials, of which ``unfit`` must go and ``late``
    ones cost more if they stay."""
    n = len(initials)
    kept = [i for i in range(n) if not unfit[i]]
    own, own_late = [initials[i] for i in kept], [late[i] for i in kept]
    table = Table(own, own_late, incumbent(own, own_late))
    audit = min(with_deletions(table.edits(*start), kept, n) for start in table.starts)
    return table.cost + DELETE * (n - len(kept)), audit


def apply_edits(audit: str, roles: Sequence[str], texts: Sequence[str]) -> list[dict]:
    left = len(audit) - audit.count("D")
    out, i = [], 0
    for edit in audit:
        if edit != "D":
            role = roles[i] if edit == "K" else ROLES[expected(left)]
            out.append({"role": role, "text": "" if edit == "I" else texts[i]})
            left -= 1
        i += edit != "I"
    return out


class Conversation:
    """The turns of one conversation, given in order."""

    def __init__(self, key):
        self.key, self.turns, self.roles, self.texts, self.faults = key, [], [], [], []
        self.seen: set[tuple[str, str]] = set()

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        said = role, text
        if fault != "blank" and said in self.seen:
            fault = "duplicate"
        self.seen.add(said)
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)

    def repaired(self) -> dict:
        initials = [r[:1] for r in self.roles]
        count = self.faults.count
        cost, audit = cheapest_edits(
            initials, [f in ("blank", "duplicate") for f in self.faults], [f == "truncated" for f in self.faults]
        )
        known = {t for t in self.turns if t is not None}
        return {
            "key": self.key,
            "gaps": max(known) - min(known) + 1 - len(known) if known else 0,
            "blank": count("blank"),
            "duplicate": count("duplicate"),
            "truncated": count("truncated"),
            "illegal": sum(a + b not in LEGAL_PAIRS for a, b in zip(initials, initials[1:])),
            "cost": cost,
            "audit": audit,
            "turns": apply_edits(audit, self.roles, self.texts),
        }


def repair_conversations(
    turns: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    absent: str | None = None,
) -> DataFrame:
    """Per conversation: its id, gaps (turn numbers missing between the least and the
    greatest), blank, duplicate and truncated (turns by their first such fault), illegal
    (neighbours whose roles cannot follow each other), cost, audit (the edits' initials)
    and turns (array of role and text, the repaired conversation).

    Turns are ordered by number (null first), then role, then text, so ties and repeated
    rows have one order. A null role or text is one space; turns without a number make no
    gap. A null conversation id is an id. Rows where the boolean column ``absent`` is true
    are no turns, but their conversation is returned, without turns if it has no others:
    zeros and an empty audit. An empty table gives no rows. Other columns are not read, so
    their names cannot clash. Texts are taken whole; one conversation is held by one task,
    since its repaired turns are one value of the result."""
    ship(turns.sparkSession)
    space = F.lit(" ")
    bare = F.rtrim("text", F.lit(SPACES))
    rows = (
        turns.select(
            F.col(conv).alias("key"),
            F.col(turn).cast("long").alias("turn"),
            F.coalesce(role, space).alias("role"),
            F.coalesce(text, space).alias("text"),
            (F.coalesce(absent, F.lit(False)) if absent else F.lit(False)).alias("absent"),
        )
        .withColumn(
            "fault",
            F.when(bare == "", "blank").when(~F.substring(bare, -1, 1).isin(".", "!", "?"), "truncated").otherwise(""),
        )
        .repartition("key")
        .sortWithinPartitions("key", "turn", "role", "text")
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    said = StructType([StructField("role", StringType()), StructField("text", StringType())])
    out = StructType(
        [StructField("key", turns.schema[conv].dataType)]
        + [StructField(c, LongType()) for c in counts]
        + [StructField("audit", StringType()), StructField("turns", ArrayType(said))]
    )

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, now, done = to_arrow_schema(out), None, []
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                for key, number, who, what, gone, fault in zip(*(c.to_pylist() for c in batch.slice(at, STEP).columns)):
                    if now is None or now.key != key:
                        if now:
                            done.append(now.repaired())
                        now = Conversation(key)
                    if not gone:
                        now.add(number, who, what, fault)
                if len(done) >= STEP:
                    yield pa.RecordBatch.from_pylist(done, schema)
                    done = []
        if now:
            yield pa.RecordBatch.from_pylist([*done, now.repaired()], schema)
        give_back()

    return rows.mapInArrow(repair, out).withColumnRenamed("key", conv)


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` and absent: faults put into turns by the
    remainder of crc32(conv:turn) by 20. 0 makes the turn absent, 1 empties its text, 2
    takes its sentence ends, 3 repeats it, 4 makes the user its role. Nulls are one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col(conv).cast("string"), space), F.coalesce(F.col(turn).cast("string"), space))
    kind, role_, text_ = F.col("kind"), F.coalesce(role, space), F.coalesce(text, space)
    return turns.select(conv, turn, role, text, (F.crc32(key) % 20).alias("kind")).select(
        conv,
        turn,
        F.when(kind == 4, "user").otherwise(role_).alias(role),
        F.when(kind == 1, "").when(kind == 2, F.translate(text_, ".!?", "")).otherwise(text_).alias(text),
        (kind == 0).alias("absent"),
        F.explode(F.sequence(F.lit(1), F.when(kind == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")
