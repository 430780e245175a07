"""Cheapest repair of conversation structure, by Four-Russians block tables.

A repaired conversation has the role initials ``(s?(ua)+)?``: nothing, or alternating user and assistant turns
that end with the assistant, after at most one system turn. Keeping a row costs 0, giving it the role user or
assistant 1, deleting it 2, inserting an empty turn 5, and a truncated row that stays 5 more; blank and
duplicate rows have to go. The audit lists the edits' initials in order; of the cheapest audits the least
in ASCII order counts.

The costs from a place to the end form a vector over the four states of the role pattern. States reach one
another by few edits, so vectors less their last component take a small number of values, and rows fall into nine
kinds. ``tables()`` holds, for every such vector and every block of ``BLOCK`` rows, the vector before the
block and the cost added; conversations are processed from their end by one lookup a block. The blocks are then
expanded, last to first: within a block the least letter that keeps the cost decides, from each state the block may
be entered in, so ties fall as they should without a second search.

Scale. Rows are counted, compared and ordered by their keys and 128-bit digests of their texts, in as many
range partitions as the session shuffles to; a long conversation lies in many of them. What meets per
conversation is one byte a row, as its audit does anyway. Texts move once, to be read in order beside the
audit; they are streamed, never gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.shipping import ready

KEEP, REROLE, DELETE, INSERT = 0, 1, 2, 5
TRUNCATED_STAYS = 5
#: Rows a table lookup covers.
BLOCK = 4

INITIALS = "sua"  # any other initial is class 3
FAULTS = ("", "blank", "duplicate", "truncated")
ROLES = {"u": "user", "a": "assistant"}
# States of the role pattern: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
_KEPT = {(EMPTY, 0): SYSTEM, (EMPTY, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
#: The state after the only role that may be inserted or assigned.
_ADDED = (USER, USER, ASSISTANT, USER)
_NO = 10**6
# Kinds of rows: class of the initial, the same but truncated, gone, and nothing (filling of a block).
_GONE, _FILL, _KINDS = 8, 9, 10
#: Kind of each mark, a mark being four times the class plus the number of the fault.
_KIND_OF_MARK = np.array([[c, _GONE, _GONE, 4 + c][fault] for c in range(4) for fault in range(4)], np.int64)

Vector = tuple[int, int, int, int]


def _row_edits(kind: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits that use up a row, in ASCII order."""

    yield "D", DELETE, state
    if kind != _GONE:
        stays = TRUNCATED_STAYS if kind >= 4 else 0
        if (state, kind % 4) in _KEPT:
            yield "K", KEEP + stays, _KEPT[state, kind % 4]
        yield "R", REROLE + stays, _ADDED[state]


def _with_inserts(costs: list[int]) -> Vector:
    """Costs when turns may be inserted first."""

    user, assistant = costs[USER], costs[ASSISTANT]
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(costs[EMPTY], INSERT + user), min(costs[SYSTEM], INSERT + user), user, assistant


_END = _with_inserts([0, _NO, _NO, 0])


def _before(kind: int, after: Vector) -> Vector:
    """Costs before a row, from those after it."""

    if kind == _FILL:
        return after
    return _with_inserts([min(cost + after[to] for _, cost, to in _row_edits(kind, state)) for state in range(4)])


class Tables:
    """Vectors by number, and the transitions of single rows and of whole blocks."""

    def __init__(self):
        self.vectors: list[Vector] = [_END]
        number = {_END: 0}
        to, added = [], []
        for vector in self.vectors:  # grows until no row kind leads to a new vector
            for kind in range(_KINDS):
                found = _before(kind, vector)
                base = found[ASSISTANT]
                found = tuple(c - base for c in found)
                if found not in number:
                    number[found] = len(self.vectors)
                    self.vectors.append(found)
                to.append(number[found])
                added.append(base)
        self.row_to = np.array(to, np.int32).reshape(-1, _KINDS)
        self.row_added = np.array(added, np.int32).reshape(-1, _KINDS)
        # Block codes have their last row as the first digit, since that row is applied first.
        to, added = np.arange(len(self.vectors))[:, None], np.zeros((len(self.vectors), 1), np.int64)
        for _ in range(BLOCK):
            added = (added[..., None] + self.row_added[to]).reshape(len(self.vectors), -1)
            to = self.row_to[to].reshape(len(self.vectors), -1)
        self.block_to, self.block_added = to.tolist(), added.tolist()
        self._expanded: dict[tuple[int, int], list[tuple[str, int]]] = {}

    def letters(self, vector: int, kind: int, state: int) -> tuple[str, int]:
        """Edits up to and with a row, and the state behind it; ``vector`` holds behind the row."""

        if kind == _FILL:
            return "", state
        after = self.vectors[vector]
        costs = _before(kind, after)
        done = ""
        while True:
            edits = [(letter, to) for letter, cost, to in _row_edits(kind, state) if cost + after[to] == costs[state]]
            if edits and edits[0][0] == "D":
                return done + "D", state
            if INSERT + costs[_ADDED[state]] == costs[state]:
                done, state = done + "I", _ADDED[state]
                continue
            return done + edits[0][0], edits[0][1]

    def expand(self, vector: int, code: int) -> list[tuple[str, int]]:
        """(edits, state behind) of a block for each state before it; ``vector`` holds behind the block."""

        found = self._expanded.get((vector, code))
        if found is None:
            kinds = [code // _KINDS**k % _KINDS for k in range(BLOCK)]  # first row first
            behind = [vector]
            for kind in reversed(kinds[1:]):
                behind.append(int(self.row_to[behind[-1], kind]))
            found = []
            for state in range(4):
                text = ""
                for kind, after in zip(kinds, reversed(behind)):
                    letters, state = self.letters(after, kind, state)
                    text += letters
                found.append((text, state))
            self._expanded[vector, code] = found
        return found


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


_WEIGHTS = _KINDS ** np.arange(BLOCK)


def cheapest_audit(marks: np.ndarray) -> tuple[int, str]:
    """(cost, audit) of a conversation's marks."""

    table = tables()
    kinds = np.full(-(-len(marks) // BLOCK) * BLOCK, _FILL, np.int64)
    kinds[len(kinds) - len(marks) :] = _KIND_OF_MARK[marks]
    codes = (kinds.reshape(-1, BLOCK) @ _WEIGHTS).tolist()
    vector, cost, behind = 0, 0, []
    for code in reversed(codes):
        behind.append(vector)
        cost += table.block_added[vector][code]
        vector = table.block_to[vector][code]
    cost += table.vectors[vector][EMPTY]
    blocks = [table.expand(after, code) for after, code in zip(behind, reversed(codes))]
    state, parts = EMPTY, []
    for block in reversed(blocks):
        letters, state = block[state]
        parts.append(letters)
    return cost, "".join(parts) + {USER: "I", SYSTEM: "II"}.get(state, "")


# Spark

_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_REPORT_FIELDS = [part.split()[0] for part in _REPORT.split(", ")]
_SPACES = r"[\x20\x09-\x0D]"


def _tidy(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, copies: str | None) -> DataFrame:
    """Own columns under own names; a null role or text is one space."""

    times = F.coalesce(F.col(copies).cast("long"), F.lit(0)) if copies else F.lit(1).cast("long")
    named = turns.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
        times.alias("n"),
    )
    digest = F.substring(F.unhex(F.sha2("text", 256)), 1, 16)
    return named.withColumn("digest", digest)


def _narrow(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, digest, mark, again, n): distinct rows, how often they occur, and their marks.

    ``mark`` is that of the first row with this role and text, ``again`` that of its repetitions. Rows that
    stand for none name their conversation alone.
    """

    there = F.col("n") > 0
    blank = ~F.col("text").rlike(f"[^{_SPACES[1:-1]}]")
    complete = F.col("text").rlike(rf"[.!?]{_SPACES}*\z")
    initial = F.coalesce(*[F.when(F.substring("role", 1, 1) == letter, k) for k, letter in enumerate(INITIALS)], F.lit(3))
    fault = F.when(blank, 1).when(~complete, 3).otherwise(0)
    marks = rows.select(
        "conv",
        *[F.when(there, F.col(name)).alias(name) for name in ("turn", "role", "digest")],
        F.when(there, initial * 4 + fault).alias("mark"),
        F.when(there, initial * 4 + F.when(blank, 1).otherwise(2)).alias("again"),
        "n",
    )
    distinct = marks.groupBy("conv", "turn", "role", "digest", "mark", "again").agg(F.sum("n").alias("n"))
    firsts = distinct.where("n > 0").groupBy("conv", "role", "digest")
    firsts = firsts.agg(F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("first_turn"))
    left, right = distinct.alias("l"), firsts.alias("r")
    same = [F.col(f"l.{name}").eqNullSafe(F.col(f"r.{name}")) for name in ("conv", "role", "digest")]
    joined = left.join(right, same[0] & same[1] & same[2], "left")
    first = F.when(F.col("untimed"), F.col("l.turn").isNull()).otherwise(F.col("l.turn") == F.col("first_turn"))
    return joined.select("l.*", F.coalesce(first, F.lit(False)).alias("first"))


_ORDER = ["conv", "turn", "role", "digest"]


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a conversation as one row: turns seen and a mark a row."""

    for batch in batches:
        if not batch.num_rows:
            continue
        convs = batch.column("conv").to_pylist()
        cuts = [0, *[i for i in range(1, len(convs)) if convs[i] != convs[i - 1]], len(convs)]
        n = np.asarray(batch.column("n"))
        first = np.asarray(batch.column("first").cast(pa.int8())) & (n > 0)
        marks = np.stack([np.asarray(batch.column(name).fill_null(0)) for name in ("mark", "again")], 1)
        times = np.stack([first, n - first], 1)
        text = np.repeat(marks.ravel().astype(np.uint8), times.ravel()).tobytes()
        places = np.concatenate([[0], np.cumsum(n)])
        turns = batch.column("turn").to_pylist()
        out = []
        for low, high in zip(cuts, cuts[1:]):
            seen = [t for t in turns[low:high] if t is not None]
            distinct = sum(a != b for a, b in zip(seen, seen[1:])) + bool(seen)
            out.append((seen[0] if seen else None, seen[-1] if seen else None, distinct, text[places[low] : places[high]]))
        heads = [batch.column(name).take(pa.array(cuts[:-1])) for name in _ORDER]
        parts = [pa.array(values, kind) for values, kind in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([*heads, *parts], [*_ORDER, "low", "high", "distinct", "marks"])


_LEGAL = {(0, 1), (1, 2), (2, 1)}
_LEGAL_PAIR = np.array([[(a, b) in _LEGAL for b in range(4)] for a in range(4)])


def report(parts: list[dict]) -> tuple:
    """Values of ``_REPORT`` from a conversation's fragments in order."""

    marks = np.frombuffer(b"".join(part["marks"] for part in parts), np.uint8)
    timed = [part for part in parts if part["distinct"]]
    gaps = 0
    if timed:
        distinct = sum(part["distinct"] for part in timed) - sum(a["high"] == b["low"] for a, b in zip(timed, timed[1:]))
        gaps = timed[-1]["high"] - timed[0]["low"] + 1 - distinct
    faults = np.bincount(marks & 3, minlength=4).tolist()
    initials = marks >> 2
    illegal = int((~_LEGAL_PAIR[initials[:-1], initials[1:]]).sum())
    return gaps, *faults[1:], illegal, *cheapest_audit(marks)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 6 + [pa.string()]
    for batch in batches:
        if batch.num_rows:
            rows = [report(parts) for parts in batch.column("parts").to_pylist()]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *columns], ["conv", *_REPORT_FIELDS])


def _audited(rows: DataFrame) -> DataFrame:
    """(conv, fields of the report) of every conversation, written to the checkpoint folder."""

    conv = rows.schema["conv"].dataType.simpleString()
    ordered = _narrow(rows).repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    head = f"conv {conv}, turn long, role string, digest binary"
    found = ordered.mapInArrow(_fragments, f"{head}, low long, high long, distinct long, marks binary")
    part = F.struct("turn", "role", "digest", "low", "high", "distinct", "marks")
    whole = found.groupBy("conv").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return whole.mapInArrow(_reports, f"conv {conv}, {_REPORT}").checkpoint()


def _in_order(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's report followed by its rows, in one partition and in order."""

    told = F.struct(*_REPORT_FIELDS).alias("report")
    heads = reports.select("conv", F.lit(0).alias("part"), *[F.lit(None).cast(kind).alias(name) for name, kind in _TEXT], told)
    bodies = rows.where("n > 0").select("conv", F.lit(1).alias("part"), *[name for name, _ in _TEXT])
    bodies = bodies.withColumn("report", F.lit(None).cast(heads.schema["report"].dataType))
    return heads.unionByName(bodies).repartition("conv").sortWithinPartitions("conv", "part", *_ORDER[1:])


_TEXT = [("turn", "long"), ("role", "string"), ("digest", "binary"), ("text", "string"), ("n", "long")]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Events of all conversations: ("begin", conv, report), then ("turn", role, text, edit) in order.

    At any time one batch and one audit are held.
    """

    audit, at, state = "", 0, EMPTY

    def added() -> tuple:
        nonlocal state
        state = _ADDED[state]
        return ROLES["u" if state == USER else "a"]

    def inserted() -> Iterator[tuple]:
        nonlocal at
        while audit[at : at + 1] == "I":
            at += 1
            yield "turn", added(), "", "I"

    for batch in batches:
        for conv, part, _, role, _, text, n, told in zip(*(column.to_pylist() for column in batch.columns)):
            if part == 0:
                yield from inserted()
                audit, at, state = told["audit"], 0, EMPTY
                yield "begin", conv, told
                continue
            for _ in range(n):
                yield from inserted()
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = _KEPT[state, INITIALS.index(role[0])]
                    yield "turn", role, text, edit
                elif edit == "R":
                    yield "turn", added(), text, edit
    yield from inserted()


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], schema=schema)


def _schema(df: DataFrame, conv: str, fields: str) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    text = f"conv {conv}, {fields}"
    return text, to_arrow_schema(StructType.fromDDL(text))


def repaired_turns(
    turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", copies: str | None = None
) -> DataFrame:
    """(conv, position, role, text, edit) of the cheapest repair: edit K, R or I, positions from 0 without gaps.

    See ``conversation_reports`` for the treatment of odd rows. Conversations of which nothing is left have no rows.
    """

    ready(turns.sparkSession)
    rows = _tidy(turns, conv_col, turn_col, role_col, text_col, copies)
    kind, schema = _schema(rows, rows.schema["conv"].dataType.simpleString(), "position long, role string, text string, edit string")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flat():
            conv = position = None
            for event in _walk(batches):
                if event[0] == "begin":
                    conv, position = event[1], 0
                else:
                    yield conv, position, *event[1:]
                    position += 1

        return _in_batches(flat(), schema)

    return _in_order(rows, _audited(rows)).mapInArrow(each, kind).withColumnRenamed("conv", conv_col)


def conversation_reports(
    turns: DataFrame, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text", copies: str | None = None
) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Rows are taken by turn (nulls first), then role, then digest of the text, so ties have a fixed order. A null
    role or text is one space. ``copies`` names a column that says for how many equal adjacent rows a row
    stands; 0 (or null) stands for none but names its conversation, which then has a report of zeros and an
    empty audit. Null conversation ids form one conversation. Each row's first fault counts: blank, duplicate (role and text seen
    earlier), truncated. Gaps ignore null turns. Other columns play no part, whatever their names; an empty table
    gives no rows. The digest is that of the repaired ``role:text`` lines, joined by newlines.
    """

    ready(turns.sparkSession)
    rows = _tidy(turns, conv_col, turn_col, role_col, text_col, copies)
    kind, schema = _schema(rows, rows.schema["conv"].dataType.simpleString(), f"{_REPORT}, repaired_sha256 string")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests():
            head, digest, any_turn = None, hashlib.sha256(), False
            for event in _walk(batches):
                if event[0] == "begin":
                    if head:
                        yield *head, digest.hexdigest()
                    head, digest, any_turn = (event[1], *event[2].values()), hashlib.sha256(), False
                else:
                    digest.update(f"{chr(10) if any_turn else ''}{event[1]}:{event[2]}".encode())
                    any_turn = True
            if head:
                yield *head, digest.hexdigest()

        return _in_batches(digests(), schema)

    return _in_order(rows, _audited(rows)).mapInArrow(each, kind).withColumnRenamed("conv", conv_col)


def damage_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) of conversations, damaged by crc32 of ``conv_id:turn`` modulo 20.

    0 drops the row (no copies), 1 empties the text, 2 removes its sentence ends, 3 doubles the row, 4 sets the
    role user; nulls are one space, in the checksum too.
    """

    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    sort = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn")).cast("binary")) % 20
    marked = turns.select("conv_id", "turn", known("role").alias("role"), known("text").alias("text"), sort.alias("sort"))
    return marked.select(
        "conv_id",
        "turn",
        F.when(F.col("sort") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("sort") == 1, "").when(F.col("sort") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("sort") == 0, 0).when(F.col("sort") == 3, 2).otherwise(1).alias("copies"),
    )
