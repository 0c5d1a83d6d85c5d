"""Repair of conversations: cheapest edits to a legal order of roles, by Four-Russians block tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from panelcast.llm.staging import staged

# Costs of the edits, the added cost of a truncated row that stays, legal neighbours, spaces.
RETELL, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
LEGAL = {"su", "ua", "au"}
SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")

BLOCK = 4
SEGMENT_ROWS = 4096
SEGMENT_CHARACTERS = 4 << 20
BATCH_ROWS = 2000

START, SYSTEM, USER, ASSISTANT = range(4)
WANTED = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
AFTER = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
INITIALS = {"s": 0, "u": 1, "a": 2}
NONE, BLANK, DUPLICATE, CUT = range(4)
FORCED = 0
SYMBOLS = 9
FAR = 1 << 20


def symbol(role: str, fault: int) -> int:
    """What of a row decides its edits: 0 if it must go, else its initial and whether it is truncated."""
    if fault in (BLANK, DUPLICATE):
        return FORCED
    return 1 + 2 * INITIALS.get(role[:1], 3) + (fault == CUT)


def edits(sign: int, state: int) -> list[tuple[str, int, int]]:
    """Letter, cost and next state of the edits of a row, in order of the letters; every letter leads to one state."""
    out = [("D", DELETE, state)]
    if sign != FORCED:
        initial, added = (sign - 1) // 2, TRUNCATED * ((sign - 1) % 2)
        if (initial, state) in ((0, START), (1, START), (1, SYSTEM), (1, ASSISTANT), (2, USER)):
            out.append(("K", added, (SYSTEM, USER, ASSISTANT)[initial]))
        out.append(("R", RETELL + added, AFTER[state]))
    return out


class BlockTables:
    """Least costs from each state to the end, for every block of ``block`` symbols looked up in one step.

    Reading a row turns the vector of least costs behind it into the one before it. Less its minimum, a vector is one of a
    few, since inserted rows lead from any state to any later one. So the vectors are numbered, and for every block
    of symbols and every vector behind it there is the number of the vector before it. Only block boundaries are kept;
    a trace expands one block at a time backward from its boundary and then takes, forward, the smallest letter
    among the edits that keep the least cost, which gives the ASCII-least of all cheapest scripts.
    """

    _made: dict[int, "BlockTables"] = {}

    def __init__(self, block: int = BLOCK):
        self.block = block
        last = self._closed([0, FAR, FAR, 0])
        self.vectors = [last]
        number, step = {tuple(last): 0}, []
        for vector in self.vectors:  # grows while it is read
            row = []
            for sign in range(SYMBOLS):
                raw = self._closed([min(cost + vector[to] for _, cost, to in edits(sign, q)) for q in range(4)])
                normal = [x - min(raw) for x in raw]
                if tuple(normal) not in number:
                    number[tuple(normal)] = len(self.vectors)
                    self.vectors.append(normal)
                row.append(number[tuple(normal)])
            step.append(row)
        self.step = np.array(step, np.uint8).T  # symbol, vector behind -> vector before
        self.moves = [[[self._move(sign, v, q) for q in range(4)] for v in range(len(self.vectors))] for sign in range(SYMBOLS)]
        self.tail = ["I" * (self.vectors[0][q] // INSERT) for q in range(4)]
        table = np.arange(len(self.vectors), dtype=np.uint8)[None, :]
        for _ in range(block):  # a symbol more in front
            table = np.concatenate([self.step[sign][table] for sign in range(SYMBOLS)])
        self.table = table
        self.rows = [bytes(row) for row in table]
        self.weights = SYMBOLS ** np.arange(block - 1, -1, -1)

    @classmethod
    def load(cls, block: int = BLOCK) -> "BlockTables":
        """One per process."""
        if block not in cls._made:
            cls._made[block] = cls(block)
        return cls._made[block]

    @staticmethod
    def _closed(costs: list[int]) -> list[int]:
        """With rows inserted in front where that is cheaper."""
        for _ in range(2):
            costs = [min(costs[q], INSERT + costs[AFTER[q]]) for q in range(4)]
        return costs

    def _move(self, sign: int, behind: int, state: int) -> tuple[str, int]:
        """The letters up to and with the edit of a row, and the state after it."""
        after = self.vectors[behind]
        best = [min(cost + after[to] for _, cost, to in edits(sign, q)) for q in range(4)]
        least = self._closed(best)
        letters = ""
        while True:
            options = [(letter, to) for letter, cost, to in edits(sign, state) if cost + after[to] == least[state]]
            if INSERT + least[AFTER[state]] == least[state]:
                options.append(("I", AFTER[state]))
            letter, state = min(options)
            letters += letter
            if letter != "I":
                return letters, state

    def _cut(self, signs: bytes) -> tuple[bytes, list[int]]:
        """The symbols before the first whole block, and the numbers of the blocks."""
        first = len(signs) % self.block
        blocks = np.frombuffer(signs, np.uint8, offset=first).reshape(-1, self.block) @ self.weights if len(signs) > first else []
        return signs[:first], list(map(int, blocks))

    def change(self, signs: bytes) -> bytes:
        """For every vector behind a segment, the vector before it; such changes can be chained in any grouping."""
        front, blocks = self._cut(signs)
        now = np.arange(len(self.vectors), dtype=np.uint8)
        for block in reversed(blocks):
            now = self.table[block][now]
        for sign in reversed(front):
            now = self.step[sign][now]
        return now.tobytes()

    def trace(self, signs: bytes, behind: int = 0, state: int = START) -> tuple[list[str], int]:
        """The letters of each row of a segment, inserted ones before its own, and the state after the last."""
        front, blocks = self._cut(signs)
        bounds = [behind]
        for block in reversed(blocks):
            bounds.append(self.rows[block][bounds[-1]])
        out = []
        for part, bound in [(front, bounds[-1])] + [(signs[len(front) + k * self.block:len(front) + (k + 1) * self.block], bounds[len(blocks) - 1 - k])
                                                    for k in range(len(blocks))]:
            inside = [bound]
            for sign in reversed(part[1:]):
                inside.append(self.step[sign][inside[-1]])
            for sign, after in zip(part, reversed(inside)):
                letters, state = self.moves[sign][after][state]
                out.append(letters)
        return out, state


class Repaired:
    """One conversation's figures, fed segment by segment."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = self.rows = 0
        self.low = self.high = self.last = None
        self.state, self.audit, self.hash, self.lines = START, [], hashlib.sha256(), 0

    def add(self, tables: BlockTables, roles: list[str], texts: list[str], faults: bytes, turns: tuple, behind: int) -> None:
        signs = bytes(map(symbol, roles, faults))
        before = self.state
        moves, self.state = tables.trace(signs, behind, self.state)
        for role, text, fault, letters in zip(roles, texts, faults, moves):
            before = self._inserted(before, letters[:-1])
            letter = letters[-1]
            if letter == "K":
                before = (SYSTEM, USER, ASSISTANT)[INITIALS[role[:1]]]
                self._line(role, text, 0 + TRUNCATED * (fault == CUT))
            elif letter == "R":
                self._line(WANTED[before], text, RETELL + TRUNCATED * (fault == CUT))
                before = AFTER[before]
            else:
                self.cost += DELETE
        self.audit.append("".join(moves))
        counts = [faults.count(k) for k in (BLANK, DUPLICATE, CUT)]
        self.blank, self.duplicate, self.truncated = self.blank + counts[0], self.duplicate + counts[1], self.truncated + counts[2]
        for role in roles:
            if self.last is not None and self.last + role[:1] not in LEGAL:
                self.illegal += 1
            self.last = role[:1]
        low, high, distinct = turns
        if low is not None:
            self.turns += distinct - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high

    def _inserted(self, state: int, letters: str) -> int:
        for _ in letters:
            self._line(WANTED[state], "", INSERT)
            state = AFTER[state]
        return state

    def _line(self, role: str, text: str, cost: int) -> None:
        self.hash.update((b"\n" if self.lines else b"") + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.lines += 1
        self.cost += cost

    def end(self, tables: BlockTables) -> tuple:
        letters = tables.tail[self.state]
        self.audit.append(letters)
        self._inserted(self.state, letters)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())


FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
FIGURES_DDL = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Segment:
    """Rows of one conversation that follow each other, with the faults that can be seen inside."""

    def __init__(self):
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.faults = bytearray()
        self.digests: list[bytes | None] = []
        self.seen: set[tuple[str, str]] = set()
        self.characters = 0
        self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        kept = text.rstrip(SPACES)
        again = (role, text) in self.seen
        fault = BLANK if not kept else DUPLICATE if again else CUT if not kept.endswith(ENDS) else NONE
        if kept and not again:
            self.seen.add((role, text))
        self.roles.append(role)
        self.texts.append(text)
        self.faults.append(fault)
        self.characters += len(text)
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn

    @property
    def full(self) -> bool:
        return len(self.roles) >= SEGMENT_ROWS or self.characters >= SEGMENT_CHARACTERS

    def prints(self) -> list[bytes | None]:
        """Of each row that may turn out to repeat one of an earlier segment."""
        return [hashlib.sha256(f"{len(r)}:{r}{t}".encode("utf-8", "surrogatepass")).digest() if f in (NONE, CUT) else None
                for r, t, f in zip(self.roles, self.texts, self.faults)]


def damaged(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows with the damage that the hash of each deals, as ``conv``, ``turn``, ``role``, ``text``; dropped rows have
    a null role. A null role, text, or part of the hashed ``conv_id:turn`` is one space."""
    or_space = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat(or_space(F.col(id_col)), F.lit(":"), or_space(F.col(turn_col))).cast("binary")) % 20
    rows = conversations.select(F.col(id_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                                or_space(F.col(role_col)).alias("role"), or_space(F.col(text_col)).alias("text"), dealt.alias("dealt"))
    return rows.select(
        "conv", "turn", F.when(F.col("dealt") == 4, "user").when(F.col("dealt") != 0, F.col("role")).alias("role"),
        F.when(F.col("dealt") <= 1, "").when(F.col("dealt") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def repair(rows: DataFrame) -> DataFrame:
    """Per conversation its faults, the least cost of its repair, the edits' initials and a hash of the repaired rows.

    ``rows`` has ``conv`` (any type), ``turn``, ``role`` and ``text``; a row with a null role only says that the conversation
    exists. Rows are taken by turn (nulls first), equal turns by role and then by a hash of the text; equal rows are
    interchangeable. A first fault is blank, duplicate (of any earlier row) or truncated.
    The result has ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit``, ``repaired_sha256``.

    Rows are dealt by range, so that a conversation of any size lies in partitions that follow each other. One that is
    inside a partition is finished there. One that crosses partitions, or is longer than a segment, is cut into segments of
    bounded size: rows that repeat one of an earlier segment are found by digests, each segment's change of the cost vector
    is computed apart, the changes are chained from the end, and one pass over the segments in order follows the edits and
    feeds the hash, which no method can compute out of order. Nothing is collected by conversation.

    A null conversation is one of its own. Empty texts are blank, very long ones whole. Conversations without rows have zeros,
    an empty audit and the hash of the empty string. An empty table gives no rows.
    """
    kind = rows.schema["conv"].dataType
    order = [F.asc_nulls_first("conv"), F.asc_nulls_first("turn"), "role", "print", "uid"]
    dealt = (rows.select("conv", "turn", "role", "text", F.sha2("text", 256).alias("print"), F.monotonically_increasing_id().alias("uid"))
             .repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "turn", "role", "text"))
    first = StructType([StructField("conv", kind), *_fields(FIGURES_DDL), *_fields(
        "part long, seg long, roles array<string>, texts array<string>, faults binary, prints array<binary>, low long, high long, turns long")])
    first_arrow = _arrow(first)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, part = BlockTables.load(), TaskContext.get().partitionId()
        out: list[tuple] = []
        now, segment, number, opened, crosses = None, None, 0, False, True  # the first of a partition may have begun before
        held = 0

        def cut() -> None:
            nonlocal segment, number, held
            held += segment.characters
            out.append((now, *[None] * 8, part, number, segment.roles, segment.texts, bytes(segment.faults), segment.prints(), segment.low, segment.high, segment.turns))
            number += 1
            segment = Segment()

        for batch in batches:
            for conv, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if not opened or conv != now:
                    if opened:
                        if crosses:
                            cut()
                        else:
                            whole = Repaired()
                            whole.add(tables, segment.roles, segment.texts, bytes(segment.faults), (segment.low, segment.high, segment.turns), 0)
                            out.append((now, *whole.end(tables), *[None] * 9))
                        crosses = False
                    now, segment, opened = conv, Segment(), True
                if role is not None:
                    segment.add(turn, role, text)
                    if segment.full:
                        crosses = True
                        cut()
                if len(out) >= BATCH_ROWS or held >= SEGMENT_CHARACTERS:
                    yield _batch(out, first_arrow)
                    out.clear()
                    held = 0
        if opened:
            cut()
        yield _batch(out, first_arrow)

    walked = staged(dealt.mapInArrow(walk, first), "walked")
    names = ["conv", *FIGURES]
    done = walked.where("part is null").select(*names)
    parts = walked.where("part is not null")
    return done.union(_joined(parts, kind).select(*names))


def _joined(parts: DataFrame, kind) -> DataFrame:
    """The conversations that are in segments."""
    heads = parts.select("conv", "part", "seg", F.posexplode("prints").alias("at", "print")).where("print is not null")
    firsts = (heads.groupBy("conv", "print").agg(F.min(F.struct("part", "seg")).alias("first"), F.count("*").alias("n")).where("n > 1")
              .select(F.col("conv").alias("c"), F.col("print").alias("p"), "first"))
    again = (heads.join(firsts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("print") == F.col("p")))
             .where(F.struct("part", "seg") != F.col("first")).groupBy("part", "seg").agg(F.collect_list("at").alias("again")))

    def faults(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = BlockTables.load()
        for batch in batches:
            marked, changes = [], []
            for roles, known, later in zip(*(batch.column(i).to_pylist() for i in (3, 4, 5))):
                mine = bytearray(known)
                for i in later or ():
                    mine[i] = DUPLICATE
                marked.append(bytes(mine))
                changes.append(tables.change(bytes(map(symbol, roles, mine))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(marked, pa.binary()), pa.array(changes, pa.binary())],
                                             names=["conv", "part", "seg", "faults", "change"])

    known = StructType([StructField("conv", kind), *_fields("part long, seg long, faults binary, change binary")])
    marked = staged(parts.select("conv", "part", "seg", "roles", "faults").join(again, ["part", "seg"], "left")
                    .select("conv", "part", "seg", "roles", "faults", "again").mapInArrow(faults, known), "marked")

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, behind, opened = None, 0, False
        for batch in batches:
            out = []
            for conv, change in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if not opened or conv != now:
                    now, behind, opened = conv, 0, True
                out.append(behind)
                behind = change[behind]
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(out, pa.int64())], names=["part", "seg", "behind"])

    # the partitions are sorted, each conversation's segments from the last to the first
    behind = (marked.select("conv", "part", "seg", "change").repartition("conv")
              .sortWithinPartitions("conv", F.desc("part"), F.desc("seg")).mapInArrow(chain, "part long, seg long, behind long"))
    known_ends = marked.select("part", "seg", "faults").join(behind, ["part", "seg"])
    ready = (parts.drop("faults").join(known_ends, ["part", "seg"]).repartition("conv").sortWithinPartitions("conv", "part", "seg")
             .select("conv", "roles", "texts", "faults", "low", "high", "turns", "behind"))
    result = StructType([StructField("conv", kind), *_fields(FIGURES_DDL)])
    result_arrow = _arrow(result)

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = BlockTables.load()
        now, whole = None, None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                conv, roles, texts, known, low, high, turns, behind = (c[i].as_py() for c in batch.columns)
                if whole is None or conv != now:
                    if whole is not None:
                        out.append((now, *whole.end(tables)))
                    now, whole = conv, Repaired()
                whole.add(tables, roles, texts, known, (low, high, turns), behind)
            yield _batch(out, result_arrow)
        yield _batch([] if whole is None else [(now, *whole.end(tables))], result_arrow)

    return ready.mapInArrow(follow, result)


def _fields(ddl: str) -> list[StructField]:
    return StructType.fromDDL(ddl).fields


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
