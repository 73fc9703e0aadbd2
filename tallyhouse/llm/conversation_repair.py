"""Repair of conversations: the cheapest edits that give user and assistant in turn.

Rows of a conversation are taken by turn, nulls first, then by role and text. A row's first fault
of these counts: ``blank`` (nothing but separators), ``duplicate`` (its role and text were seen
earlier in the conversation), ``truncated`` (the last character that is no separator does not end
a sentence). Every row is kept (free), given another role (1) or deleted (2); blank and duplicate
rows must be deleted, and a truncated row that stays costs 5 more. Anywhere an empty row of a user
or an assistant can be inserted (5). After the edits the initials of the roles read ``ua`` any
number of times, after one ``s`` or not, or nothing is left. Among the cheapest edits those whose
initials (Delete, Insert, Keep, Rerole) sort first are taken.

Row by row the cheapest edits are known for each of four states: nothing so far, a system row,
a user's row open, all answered. Edits so far are paths in one tree (``edit_paths``), so a
state costs one node a row, and equal costs are decided by the longest common prefix of two paths.
Two lists of equal cost that lead to one state are never one the beginning of the other, as what
follows would be insertions, so the choice stands whatever comes later. A state that costs
so much that another could make up for it is dropped; what all states left have in common is
settled, handed out and forgotten. So a conversation streams through a task: sorted by Spark, on
disk if need be, without being held as a whole, unless two different lists stay equally good
over all of it.

A conversation is the unit of work, as the digest of its repaired text can only be taken from
beginning to end; conversations are spread over the tasks by id.

Defined results: a null role or text counts as one space; a null turn sorts first; rows with a
null id are one conversation. An empty role has no initial and cannot be kept. Other roles
cannot be kept either, but any role is known by its first letter. Rows that are equal in all
columns are copies: the first is no duplicate. Other columns are not read. An empty table gives
no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tallyhouse.llm.arrow import map_batches
from tallyhouse.llm.columns import column
from tallyhouse.llm.edit_paths import Path, cut, precedes, shared

# What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

NOTHING, SYSTEM, OPEN, ANSWERED = range(4)

#: The state after a row with that initial, and the role that may come next.
_AFTER = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): OPEN, (SYSTEM, "u"): OPEN, (ANSWERED, "u"): OPEN, (OPEN, "a"): ANSWERED}
_NEXT = {NOTHING: ("user", OPEN), SYSTEM: ("user", OPEN), ANSWERED: ("user", OPEN), OPEN: ("assistant", ANSWERED)}

#: What it costs at most to do from the first state whatever can be done from the second.
_CATCH_UP = {
    (NOTHING, ANSWERED): 0, (NOTHING, SYSTEM): 0, (NOTHING, OPEN): INSERT,
    (SYSTEM, NOTHING): 2 * INSERT, (SYSTEM, ANSWERED): 2 * INSERT, (SYSTEM, OPEN): INSERT,
    (ANSWERED, NOTHING): DELETE, (ANSWERED, SYSTEM): 0, (ANSWERED, OPEN): INSERT,
    (OPEN, ANSWERED): INSERT, (OPEN, SYSTEM): INSERT, (OPEN, NOTHING): INSERT + DELETE,
}

#: Rows after which settled edits are handed out.
_SETTLE_ROWS = 64
_BATCH_ROWS, _BATCH_CHARS = 500, 1 << 20

EDITS = (
    "conv_id bigint, step bigint, edit string, cost bigint, fault string, illegal boolean, turn bigint, "
    "role string, text string"
)
AUDITS = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "cost bigint, audit string, repaired_sha256 string"
)

_Row = tuple  # conv_id, turn, role, text, fault, illegal
_States = dict[int, tuple[int, Path]]


def _offer(states: _States, state: int, cost: int, parent: Path, letter: str, edit: tuple) -> None:
    """Take the edit after ``parent`` as the way to ``state`` if none better is known."""
    known = states.get(state)
    if known is None or cost < known[0]:
        states[state] = cost, Path(parent, letter, edit)
    elif cost == known[0]:
        path = Path(parent, letter, edit)
        if precedes(path, known[1]):
            states[state] = cost, path


def _with_inserts(states: _States) -> _States:
    """What can be reached by inserting before the next row: at most one row of each role, as
    more would come back to the same state."""
    for role, sources in (("user", (NOTHING, SYSTEM, ANSWERED)), ("assistant", (OPEN,))):
        for source in sources:
            if source in states:
                cost, path = states[source]
                _offer(states, _NEXT[source][1], cost + INSERT, path, "I", ("I", INSERT, None, role))
    return {
        state: (cost, path)
        for state, (cost, path) in states.items()
        if not any(o[0] + _CATCH_UP[other, state] < cost for other, o in states.items() if other != state)
    }


def _after_row(states: _States, row: _Row) -> _States:
    role, fault = row[2], row[4]
    found: _States = {}
    for state, (cost, path) in states.items():
        _offer(found, state, cost + DELETE, path, "D", ("D", DELETE, row, None))
        if fault in ("blank", "duplicate"):
            continue
        stays = TRUNCATED if fault == "truncated" else 0
        after = _AFTER.get((state, role[:1]))
        if after is not None:
            _offer(found, after, cost + stays, path, "K", ("K", stays, row, role))
        other, after = _NEXT[state]
        _offer(found, after, cost + stays + REROLE, path, "R", ("R", stays + REROLE, row, other))
    return _with_inserts(found)


def cheapest_edits(rows: Iterable[_Row]) -> Iterator[tuple]:
    """``(letter, cost, row or none, role or none)`` of the edits of one conversation, in order."""
    root = Path(None)
    states = _with_inserts({NOTHING: (0, root)})
    for n, row in enumerate(rows, 1):
        states = _after_row(states, row)
        if n % _SETTLE_ROWS == 0:
            paths = [path for _, path in states.values()]
            settled = shared(paths)
            yield from settled.edits(root)
            cut(paths, settled)
            root = settled
    ends = [states[s] for s in (NOTHING, ANSWERED) if s in states]
    best = ends[0]
    for other in ends[1:]:
        if other[0] < best[0] or (other[0] == best[0] and precedes(other[1], best[1])):
            best = other
    yield from best[1].edits(root)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(values.to_pylist() for values in batch.columns))


def _write(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Batches of bounded numbers of rows and characters."""

    def batch(held: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(v, t) for v, t in zip(zip(*held), schema.types)], schema=schema)

    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(value) for value in row if type(value) is str)
        if len(held) >= _BATCH_ROWS or chars >= _BATCH_CHARS:
            yield batch(held)
            held, chars = [], 0
    if held:
        yield batch(held)


def _arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(_parse_datatype_string(ddl))


def rows_with_faults(
    conversations: DataFrame, id_column: str, turn_column: str, role_column: str, text_column: str
) -> DataFrame:
    """The rows of each conversation together and in order, with their first fault, and whether
    their role may not follow the one before."""

    def text(name: str) -> Column:
        return F.coalesce(column(name).cast("string"), F.lit(" "))

    rows = conversations.select(
        column(id_column).cast("bigint").alias("conv_id"), column(turn_column).cast("bigint").alias("turn"),
        text(role_column).alias("role"), text(text_column).alias("text"),
    ).repartition("conv_id")
    order = ["turn", "role", "text"]
    copy = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy("turn"))
    before = F.lag("role").over(Window.partitionBy("conv_id").orderBy(*order))
    pair = F.concat(F.substring("before", 1, 1), F.substring("role", 1, 1))
    return (
        rows.withColumn("copy", copy)
        .withColumn("before", before)
        .select(
            "conv_id", "turn", "role", "text",
            F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), "blank")
            .when(F.col("copy") > 1, "duplicate")
            .when(~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z"), "truncated")
            .alias("fault"),
            F.coalesce(~pair.isin("su", "ua", "au"), F.lit(False)).alias("illegal"),
        )
        .sortWithinPartitions("conv_id", *order)
    )


def repair(
    conversations: DataFrame,
    id_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """One row per edit: ``step`` numbers a conversation's edits from 0, ``edit`` is the initial,
    ``cost`` what it costs, ``role, text`` the row after it (null where deleted), ``turn, fault,
    illegal`` tell of the row it was made on (null where inserted). A conversation's edits lie
    together and in order in one partition."""
    schema = _arrow_schema(EDITS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edits() -> Iterator[tuple]:
            for conv_id, rows in groupby(_read(batches), itemgetter(0)):
                for step, (letter, cost, row, role) in enumerate(cheapest_edits(rows)):
                    _, turn, _, text, fault, illegal = row or (None, None, None, "", None, None)
                    yield conv_id, step, letter, cost, fault, illegal, turn, role, None if role is None else text

        return _write(edits(), schema)

    faulty = rows_with_faults(conversations, id_column, turn_column, role_column, text_column)
    return map_batches(faulty, run, EDITS)


def audits(edits: DataFrame) -> DataFrame:
    """One row per conversation from what ``repair`` returns, without a shuffle: missing turns
    between its first and last, rows by fault, pairs of roles that may not follow each
    other, the cost of its edits, their initials, and the SHA-256 of the repaired ``role:text``
    lines."""
    schema = _arrow_schema(AUDITS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def summed() -> Iterator[tuple]:
            for conv_id, rows in groupby(_read(batches), itemgetter(0)):
                digest, lines, letters = hashlib.sha256(), 0, []
                faults = {"blank": 0, "duplicate": 0, "truncated": 0}
                illegal = total = distinct = 0
                first = last = None
                for _, _, letter, cost, fault, odd, turn, role, text in rows:
                    letters.append(letter)
                    total += cost
                    illegal += bool(odd)
                    if fault is not None:
                        faults[fault] += 1
                    if turn is not None and turn != last:
                        first, last, distinct = turn if first is None else first, turn, distinct + 1
                    if role is not None:
                        digest.update(("\n" if lines else "").encode() + f"{role}:{text}".encode())
                        lines += 1
                gaps = last - first + 1 - distinct if distinct else 0
                yield conv_id, gaps, *faults.values(), illegal, total, "".join(letters), digest.hexdigest()

        return _write(summed(), schema)

    return map_batches(edits, run, AUDITS)
