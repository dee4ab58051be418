"""Conversation repair by lightest derivations.

A conversation is well formed when its role initials read ``(s?(ua)+)?``. An item (place, state) says that the rows before
the place are repaired and the output ends in the state; an edit deduces one item from another. Knuth's agenda pops items
by (cost, audit): both grow with every deduction and keep their order under it, so an item is final when it is popped, and
the search ends with the goal. Long conversations are cut into segments: within one the agenda runs from every state to
every state, and these passages are the deductions from segment to segment, taken in the same order.
"""

import hashlib
from collections.abc import Callable, Iterable, Iterator
from heapq import heappop, heappush
from itertools import groupby
from operator import itemgetter
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from dockflow.llm.common import importable, stored

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 2, 3, 2, 1  # costs
START, SYSTEM, USER, ASSISTANT = range(4)  # what the output ends in
STATES, FINAL = (START, SYSTEM, USER, ASSISTANT), (START, ASSISTANT)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
LEGAL = ("su", "ua", "au")
NAMES = {"u": "user", "a": "assistant"}
SEGMENT = 512  # rows
SPACE = " \t\n\x0b\x0c\r"
NONE, BLANK, TRUNCATED = 0, 1, 2

Weight = tuple[int, str]  # (cost, audit)


class Row(NamedTuple):
    """``count`` equal rows at one place; ``seen`` when an earlier row has the same role and text."""

    turn: int | None
    role: str
    text: str
    count: int
    fault: int
    seen: bool

    @property
    def forced(self) -> int:
        """How many of them must go."""
        return self.count if self.fault == BLANK or self.seen else self.count - 1


def wanted(state: int) -> str:
    """The only initial that an edit may put after the state."""
    return "a" if state == USER else "u"


def edits(rows: list[Row], place: int, state: int) -> Iterator[tuple[int, str, int, int]]:
    """Deductions from an item: (cost, edit, place, state). Rows that must go are one edit, since D sorts before I."""
    yield INSERT, "I", place, AFTER[state, wanted(state)]
    if place < len(rows):
        row = rows[place]
        lost = row.forced
        if lost == row.count:
            yield DELETE * lost, "D" * lost, place + 1, state
            return
        cost, tail, extra = DELETE * lost, "D" * lost, UNFINISHED * (row.fault == TRUNCATED)
        yield cost + DELETE, "D" + tail, place + 1, state
        yield cost + REROLE + extra, "R" + tail, place + 1, AFTER[state, wanted(state)]
        if after := AFTER.get((state, row.role[:1])):
            yield cost + KEEP + extra, "K" + tail, place + 1, after


def finalised(
    seeds: dict, deductions: Callable[[object], Iterable[tuple[int, str, object]]], goals: set, first: bool = False
) -> dict[object, Weight]:
    """Knuth's agenda: the least (cost, audit) of every goal that can be derived, or of the lightest goal alone."""
    agenda: list = []
    for item, (cost, audit) in seeds.items():
        heappush(agenda, (cost, audit, item))
    done, missing, found = set(), set(goals), {}
    while agenda and missing:
        cost, audit, item = heappop(agenda)
        if item in done:
            continue
        done.add(item)
        if item in missing:
            missing.remove(item)
            found[item] = cost, audit
            if first:
                break
        for more, edit, after in deductions(item):
            if after not in done:
                heappush(agenda, (cost + more, audit + edit, after))
    return found


def lightest(rows: list[Row]) -> Weight:
    """Cost and audit of the cheapest repair of a whole conversation, the ASCII-least audit among equals."""

    def deductions(item):
        return ((cost, edit, (place, state)) for cost, edit, place, state in edits(rows, *item))

    goals = {(len(rows), state) for state in FINAL}
    ((_, weight),) = finalised({(0, START): (0, "")}, deductions, goals, first=True).items()
    return weight


def passages(rows: list[Row]) -> list[dict]:
    """Of a segment: the lightest way from every state to every state that can follow."""

    def deductions(item):
        return ((cost, edit, (place, state)) for cost, edit, place, state in edits(rows, *item))

    out = []
    for state in STATES:
        goals = {(len(rows), s) for s in (STATES if state == START else STATES[state:] if state == SYSTEM else STATES[2:])}
        found = finalised({(0, state): (0, "")}, deductions, goals)
        out += [{"before": state, "after": s, "cost": c, "audit": a} for (_, s), (c, a) in found.items()]
    return out


def joined(segments: Iterable[list[dict]]) -> tuple[Weight, list[tuple[int, str]]]:
    """The lightest way through all segments: its cost and audit, and per segment the state before it and its audit.

    What the audits of the four states have in common is set aside, so the strings that are compared stay short.
    """
    held = {START: (0, "")}
    common: list[str] = []
    choices = []
    for ways in segments:
        by_state: dict[int, list[dict]] = {}
        for way in ways:
            by_state.setdefault(way["before"], []).append(way)
        agenda = sorted(
            (cost + way["cost"], audit + way["audit"], way["after"], state, way["audit"])
            for state, (cost, audit) in held.items()
            for way in by_state.get(state, ())
        )
        held, choice = {}, {}
        for cost, audit, after, before, piece in agenda:
            if after not in held:
                held[after], choice[after] = (cost, audit), (before, piece)
        choices.append(choice)
        low, high = min(a for _, a in held.values()), max(a for _, a in held.values())
        same = next((k for k, (x, y) in enumerate(zip(low, high, strict=False)) if x != y), len(low))
        common.append(low[:same])
        held = {s: (cost, audit[same:]) for s, (cost, audit) in held.items()}
    cost, audit, state = min((*held[s], s) for s in FINAL if s in held)
    pieces = []
    for choice in reversed(choices):
        before, piece = choice[state]
        pieces.append((state := before, piece))
    return (cost, "".join(common) + audit), pieces[::-1]


class Rendering:
    """Replays an audit over rows and hashes what comes out, ``role:text`` lines joined by newlines."""

    def __init__(self):
        self.digest, self.any = hashlib.sha256(), False

    def line(self, role: str, text: str) -> None:
        self.digest.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True

    def replay(self, state: int, audit: str, rows: Iterable[Row]) -> None:
        rows, place = iter(rows), 0
        while place < len(audit):
            edit = audit[place]
            if edit == "I":
                self.line(NAMES[initial := wanted(state)], "")
                state, place = AFTER[state, initial], place + 1
                continue
            row = next(rows)
            place += row.count
            if edit != "D":
                initial = row.role[:1] if edit == "K" else wanted(state)
                self.line(row.role if edit == "K" else NAMES[initial], row.text)
                state = AFTER[state, initial]

    def hexdigest(self) -> str:
        return self.digest.hexdigest()


class Tally(NamedTuple):
    """Counts of a run of rows, which add up over neighbouring runs."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    least: int | None = None
    most: int | None = None
    turns: int = 0
    first: str | None = None  # role initials at both ends
    last: str | None = None

    @classmethod
    def of(cls, row: Row) -> "Tally":
        blank = row.count if row.fault == BLANK else 0
        duplicate = 0 if blank else row.forced
        cut = int(row.fault == TRUNCATED and row.forced < row.count)
        ends = row.role[:1]
        illegal = (row.count - 1) * (ends + ends not in LEGAL)
        return cls(blank, duplicate, cut, illegal, row.turn, row.turn, int(row.turn is not None), ends, ends)

    def __add__(self, after: "Tally") -> "Tally":
        """Rows come by turn, nulls first, so two runs share a turn only where they touch."""
        if self.first is None or after.first is None:
            return after if self.first is None else self
        shared = self.most is not None and self.most == after.least
        return Tally(
            self.blank + after.blank,
            self.duplicate + after.duplicate,
            self.truncated + after.truncated,
            self.illegal + after.illegal + (self.last + after.first not in LEGAL),
            after.least if self.least is None else self.least,
            self.most if after.most is None else after.most,
            self.turns + after.turns - shared,
            self.first,
            after.last,
        )

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.turns


RESULT = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
    "audit string, repaired_sha256 string"
)
WAY = "struct<before: int, after: int, cost: bigint, audit: string>"
TALLY = (
    "struct<blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, least: bigint, most: bigint, "
    "turns: bigint, first: string, last: string>"
)
ROW = "turn bigint, role string, text string, count bigint, fault int, seen boolean"
# kind 0: a result; 1: a segment; 2: a row of a segment. The last two are of conversations that may reach over the
# edge of a partition or are longer than a segment.
PART = f"{RESULT}, kind int, part int, segment bigint, at int, {ROW}, ways array<{WAY}>, tally {TALLY}"


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies) after damage; a dropped row keeps its place with no copies.

    Nulls read as one space in the key that is hashed, and as the role or text.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key) % 20
    text = F.coalesce("text", F.lit(" "))
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind <= 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def ordered(rows: DataFrame) -> DataFrame:
    """Equal rows as one with their count and fault, in order of conversation, turn (nulls first), role and text.

    Equal rows are counted before they are moved. Whether a role and text were seen earlier comes from a join with their
    first turns, so a busy conversation or a phrase said often is split like any large partition of a join. The range
    partitions cut a conversation where it has many rows.
    """
    heard = F.sha2("text", 256)
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("count"))
    first = (
        rows.where("copies > 0")
        .groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), heard.alias("g"))
        .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("first"))
    )
    here = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(trimmed == "", BLANK).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NONE)
    joined_rows = counted.withColumn("h", heard).join(
        first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("h") == F.col("g")), "left"
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text"]
    return (
        joined_rows.select(
            "conv_id",
            "turn",
            "role",
            "text",
            "count",
            fault.alias("fault"),
            F.coalesce(here > F.col("first"), F.lit(False)).alias("seen"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )


def _packed(records: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for record in records:
        held.append(record)
        size += len(record.get("text") or "") + len(record.get("audit") or "")
        if len(held) == 4096 or size > 1 << 24:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _result(conv: int | None, tally: Tally, weight: Weight, rendering: Rendering) -> dict:
    return {
        "conv_id": conv,
        "gaps": tally.gaps,
        **{n: getattr(tally, n) for n in ("blank", "duplicate", "truncated", "illegal")},
        "cost": weight[0],
        "audit": weight[1],
        "repaired_sha256": rendering.digest.hexdigest(),
    }


def _parts(batches: Iterator[pa.RecordBatch], part: int, longest: int) -> Iterator[dict]:
    """Results of the conversations that lie within a partition; segments and rows of the others."""
    ended = []

    def read() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)
        ended.append(True)

    for number, (conv, group) in enumerate(groupby(read(), key=itemgetter(0))):
        rows, tally, segments = [], Tally(), 0

        def segment() -> Iterator[dict]:
            at = {"conv_id": conv, "part": part, "segment": segments}
            yield {**at, "kind": 1, "at": -1, "ways": passages(rows), "tally": tally._asdict()}
            for k, row in enumerate(rows):
                yield {**at, "kind": 2, "at": k, **row._asdict()}

        for _, *fields in group:
            row = Row(*fields)
            if row.count:
                rows.append(row)
                tally += Tally.of(row)
            if len(rows) == longest:
                yield from segment()
                rows, tally, segments = [], Tally(), segments + 1
        if number == 0 or ended or segments:  # it may begin or go on in another partition, or is long
            yield from segment()
        else:
            weight, rendering = lightest(rows), Rendering()
            rendering.replay(START, weight[1], rows)
            yield {"kind": 0, **_result(conv, tally, weight, rendering)}


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Results of the conversations that come in segments: first all segments of one, then its rows as a stream."""
    records = (r for batch in batches for r in batch.to_pylist())
    for conv, group in groupby(records, key=itemgetter("conv_id")):
        segments, pieces, rendering = [], None, Rendering()

        def replay(key: tuple | None, rows: Iterator[dict]) -> None:
            """Replay the segments before the key without rows, and that of the key with its rows."""
            for segment, (state, audit) in pieces:
                here = (segment["part"], segment["segment"]) == key
                rendering.replay(state, audit, (Row(*(r[n] for n in Row._fields)) for r in rows) if here else ())
                if here:
                    break

        for (kind, *key), run in groupby(group, key=itemgetter("kind", "part", "segment")):
            if kind == 1:
                segments.extend(run)
                continue
            if pieces is None:
                weight, chosen = joined(s["ways"] for s in segments)
                pieces = zip(segments, chosen, strict=True)
            replay(tuple(key), run)
        if pieces is None:  # no rows after damage
            weight, chosen = joined(s["ways"] for s in segments)
            pieces = zip(segments, chosen, strict=True)
        replay(None, iter(()))
        tally = Tally()
        for s in segments:
            tally += Tally(**s["tally"])
        yield _result(conv, tally, weight, rendering)


def repaired(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation of (conv_id, turn, role, text) with its faults, cheapest edits and repaired digest.

    Null conv_ids are one conversation. Rows are taken by turn (nulls first), rows of one turn by role and text, so
    repeated rows stand side by side. Empty texts are blank; an empty role has no initial and is never kept. A
    conversation without rows after damage has zeros, an empty audit and the digest of nothing; an empty table gives
    none. Extra columns are ignored. A conversation of any length is repaired in segments side by side. Only its digest,
    which is sequential by nature, and the audits of its segments, which are the result, pass through one task; texts
    pass it as a stream.
    """
    spark = conversations.sparkSession
    importable(spark)
    part, result = (to_arrow_schema(StructType.fromDDL(s)) for s in (PART, RESULT))
    parts = stored(
        ordered(damaged(conversations)).mapInArrow(
            lambda batches: _packed(_parts(batches, TaskContext.get().partitionId(), segment), part), PART
        ),
        "repair",
    )
    over = (
        parts.where("kind > 0")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "kind", "part", "segment", "at")
        .mapInArrow(lambda batches: _packed(_assembled(batches), result), RESULT)
    )
    return parts.where("kind = 0").select(*over.columns).union(over)
