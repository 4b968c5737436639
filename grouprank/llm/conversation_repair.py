"""Repair of the turn structure of conversations by Hirschberg's divide and conquer (operator 13).

A legal conversation's role initials are `(s?(ua)+)?`, which four states tell apart: nothing yet, after the system turn,
after a user, after an assistant. Edits of a row (Keep, Rerole, Delete) and inserted turns lead from state to state; from
a state each letter leads to one state, so an audit is a path, and the cheapest audit that is least in ASCII order is one
path. A forward vector has the least cost of reaching each state and how the states' least audits compare; a backward
vector has the least cost from each state to the end. Where they meet, the crossing is the state of least total cost,
and of those the one whose audit so far is least. Both halves are then solved alone, so no table of all rows is kept.

Conversations of any length are divided the same way by Spark: rows are numbered in order over range partitions and cut
into segments of at most 2^SEGMENT rows. A segment's sixteen costs between its ends stand for it when the crossings at
the segments' borders are chosen, and every segment is then solved on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grouprank.llm.common import TEXT_ROWS, narrow, written

#: Costs of the edits, what an undeleted truncated row adds, and white space.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACE = " \t\n\x0b\f\r"
#: The states: start, after system, after user, after assistant. The state that a kept role's initial leads to, and the
#: state that an inserted or changed turn leads to: it is the user's but after a user.
STATES = range(4)
KEEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
TURN = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
#: Cost and letters from a state to a legal end.
TAIL = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))
#: Initials and faults of rows; a row's code is 3 * initial + fault.
INITIALS = "sua"
SOUND, GONE, CUT = range(3)
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
NEVER = 1 << 60
#: Rows of a segment, as a power of two.
SEGMENT = 14


def row_edits(code: int, state: int) -> dict[int, tuple[int, str]]:
    """For each state that one row can lead to, the least (cost, letters): inserted turns, then the row's own edit."""
    initial, fault = divmod(code, 3)
    found: dict[int, tuple[int, str]] = {}
    more, at = 0, state
    for inserted in ("", "I", "II"):
        ends = [(at, DELETE, "D")]
        if fault != GONE:
            added = TRUNCATED if fault == CUT else 0
            ends.append((TURN[at], REROLE + added, "R"))
            if INITIALS[initial:initial + 1] in KEEPS[at]:
                ends.append((KEEPS[at][INITIALS[initial]], added, "K"))
        for end, cost, letter in ends:
            found[end] = min(found.get(end, (NEVER, "")), (more + cost, inserted + letter))
        more, at = more + INSERT, TURN[at]
    return found


EDITS = [[row_edits(code, state) for state in STATES] for code in range(3 * (len(INITIALS) + 1))]

#: Least cost of reaching each state (NEVER if it can't be) and the order of the states' least audits.
Forward = tuple[tuple[int, ...], tuple[int, ...]]


def start_at(state: int) -> Forward:
    return tuple(0 if s == state else NEVER for s in STATES), (0,) * 4


def reached(ways: list[list[tuple[int, tuple]]]) -> Forward:
    """The vector of states that ways (cost, audit or what orders it) lead to."""
    best = [min(w, default=(NEVER, ())) for w in ways]
    order = sorted({w[1] for w in best})
    return tuple(w[0] for w in best), tuple(order.index(w[1]) for w in best)


@lru_cache(maxsize=1 << 16)
def step(cost: tuple[int, ...], order: tuple[int, ...], code: int) -> tuple[int, Forward]:
    """The least cost and the vector above it after one row more."""
    ways: list[list] = [[] for _ in STATES]
    for s in STATES:
        if cost[s] < NEVER:
            for end, (more, letters) in EDITS[code][s].items():
                ways[end].append((cost[s] + more, (order[s], letters)))
    costs, orders = reached(ways)
    least = min(costs)
    return least, (tuple(c - least if c < NEVER else NEVER for c in costs), orders)


@lru_cache(maxsize=1 << 16)
def step_back(cost: tuple[int, ...], code: int) -> tuple[int, tuple[int, ...]]:
    """The least cost and the backward vector above it with one row more in front."""
    costs = [min(NEVER, *(more + cost[end] for end, (more, _) in EDITS[code][s].items())) for s in STATES]
    least = min(costs)
    return least, tuple(c - least if c < NEVER else NEVER for c in costs)


def forward(codes: bytes, state: int) -> tuple[int, Forward]:
    base, vector = 0, start_at(state)
    for code in codes:
        more, vector = step(*vector, code)
        base += more
    return base, vector


def hirschberg(codes: bytes, start: int, end: int) -> list[str]:
    """The letters of each row on the best path from state start to state end."""
    if len(codes) == 1:
        return [EDITS[codes[0]][start][end][1]]
    mid = len(codes) // 2
    _, (cost, order) = forward(codes[:mid], start)
    back = tuple(0 if s == end else NEVER for s in STATES)
    for code in reversed(codes[mid:]):
        _, back = step_back(back, code)
    crossing = min(STATES, key=lambda s: (min(NEVER, cost[s] + back[s]), order[s]))
    return hirschberg(codes[:mid], start, crossing) + hirschberg(codes[mid:], crossing, end)


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Rows, as tuples, of each run of equal values in the first `keys` columns."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and held[0][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def in_batches(rows: Iterator[tuple], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def mapped(make: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]], *columns: tuple[str, pa.DataType]):
    """make's tuples as record batches of the columns."""
    schema = pa.schema(columns)
    return lambda batches: in_batches(make(batches), schema)


def expanded(codes: bytes, counts: bytes) -> bytes:
    """Codes of all rows; every copy of a row after its first is a duplicate."""
    return b"".join(bytes([c]) + bytes([c - c % 3 + GONE]) * (n - 1) for c, n in zip(codes, np.frombuffer(counts, "<i8").tolist(), strict=True))


def segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """A segment of rows (conv_id, segment, place, turn, initial, n, blank, first, truncated) as one."""
    for rows in runs(batches, 2):
        codes, counts = bytearray(), []
        blank = duplicate = truncated = illegal = turns = 0
        before, last_turn = None, None
        for _, _, _, turn, initial, n, is_blank, is_first, is_cut in rows:
            gone = is_blank or not is_first
            codes.append(3 * (INITIALS.index(initial) if initial and initial in INITIALS else len(INITIALS)) + (GONE if gone else CUT if is_cut else SOUND))
            counts.append(n)
            blank += n if is_blank else 0
            duplicate += 0 if is_blank else n - bool(is_first)
            truncated += bool(is_cut and not gone)
            illegal += n - 1 + (before is not None and (before, initial) not in LEGAL)
            turns += turn is not None and turn != last_turn
            before, last_turn = initial, turn
        packed = np.array(counts, "<i8").tobytes()
        whole = expanded(bytes(codes), packed)
        ends = []
        for s in STATES:
            base, (cost, order) = forward(whole, s)
            ends += [[base + c if c < NEVER else NEVER for c in cost], list(order)]
        known = [r[3] for r in rows if r[3] is not None]
        yield (rows[0][0], rows[0][2], np.array([r[2] for r in rows], "<i8").tobytes(), packed, bytes(codes), np.array(ends, "<i8").tobytes(),
               blank, duplicate, truncated, illegal, turns, known[0] if known else None, known[-1] if known else None, rows[0][4], rows[-1][4])


def crossings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """For each segment (conv_id, place, ends, ...) of a conversation: its states, and with the first the conversation's sums."""
    for rows in runs(batches, 1):
        ends = [np.frombuffer(r[2], "<i8").reshape(4, 2, 4).tolist() for r in rows]
        vectors = [start_at(0)]
        for end in ends:
            cost, order = vectors[-1]
            vectors.append(reached([[(cost[s] + end[s][0][t], (order[s], end[s][1][t])) for s in STATES if cost[s] < NEVER and end[s][0][t] < NEVER]
                                    for t in STATES]))
        back = [[c for c, _ in TAIL]]
        for end in reversed(ends):
            back.append([min(NEVER, *(end[s][0][t] + back[-1][t] for t in STATES)) for s in STATES])
        back.reverse()
        states = [min(STATES, key=lambda s: (cost[s] + b[s], order[s])) for (cost, order), b in zip(vectors, back, strict=True)]
        blank, duplicate, truncated, illegal, turns = (sum(r[k] for r in rows) for k in range(3, 8))
        illegal += sum((a[11], b[10]) not in LEGAL for a, b in zip(rows, rows[1:], strict=False))
        # a turn that goes on in the next segment is counted in both
        filled = [r for r in rows if r[8] is not None]
        turns -= sum(a[9] == b[8] for a, b in zip(filled, filled[1:], strict=False))
        gaps = filled[-1][9] - filled[0][8] + 1 - turns if filled else 0
        sums = (gaps, blank, duplicate, truncated, illegal, vectors[-1][0][states[-1]] + TAIL[states[-1]][0])
        for k, r in enumerate(rows):
            yield (r[0], r[1], states[k], states[k + 1], k == len(rows) - 1, *(sums if k == 0 else (None,) * len(sums)))


def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(place, edits, roles) of each row of segments (places, counts, codes, start, end, last)."""
    for batch in batches:
        for places, counts, codes, start, end, last in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            letters = hirschberg(expanded(codes, counts), start, end)
            if last:
                letters[-1] += TAIL[end][1]
            at, state = 0, start
            for place, n, code in zip(np.frombuffer(places, "<i8").tolist(), np.frombuffer(counts, "<i8").tolist(), codes, strict=True):
                edits, roles = "".join(letters[at:at + n]), []
                at += n
                for letter in edits:
                    state = {"D": state, "K": KEEPS[state].get(INITIALS[code // 3:code // 3 + 1])}.get(letter, TURN[state])
                    roles.append(ROLE[state] if letter in "RI" else None)
                yield place, edits, roles


def faults(rows: DataFrame) -> DataFrame:
    """Rows of a conversation that are equal as one, with their number n, in written order.

    place numbers them within a conversation by turn (nulls first), role and a hash of the text; first says that no
    earlier row of the conversation has the role and text.
    """
    stripped = F.btrim("text", F.lit(SPACE))
    marked = rows.withColumn("hash", F.md5("text")).withColumn("blank", stripped == "").withColumn(
        "truncated", (stripped != "") & ~F.right(stripped, F.lit(1)).isin(".", "!", "?"))
    row = ["conv_id", "turn", "role", "hash"]
    one = marked.groupBy(*row, "blank", "truncated").agg(F.count("*").alias("n"), F.first("text").alias("text"))
    one = written(one, "conversation-rows", rows_per_batch=TEXT_ROWS)
    early = one.groupBy("conv_id", "role", "hash").agg(F.min(F.struct("turn")).alias("least"))
    early = early.select(F.col("conv_id").alias("_conv_id"), F.col("least.turn").alias("_turn"), F.col("role").alias("_role"), F.col("hash").alias("_hash"))
    same = [F.col(c).eqNullSafe(F.col("_" + c)) for c in row]
    known = one.join(early, same, "left").withColumn("first", F.col("_hash").isNotNull())
    known = known.select(*row, "blank", "truncated", "first", "n", "text").repartitionByRange(*row).sortWithinPartitions(*row)
    return written(known.withColumn("place", F.monotonically_increasing_id()), "conversation-order", rows_per_batch=TEXT_ROWS)


def edited(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of faults with their edits (a letter each, inserted turns before or after) and the roles that these give;
    and one row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost."""
    rows = faults(rows)
    slim = rows.select("conv_id", F.shiftright("place", SEGMENT).alias("segment"), "place", "turn", F.left("role", F.lit(1)).alias("initial"), "n", "blank", "first",
                       "truncated")
    number, text, data = pa.int64(), pa.string(), pa.binary()
    kinds = [("conv_id", number), ("place", number), ("places", data), ("counts", data), ("codes", data), ("ends", data),
             *((c, number) for c in ("blank", "duplicate", "truncated", "illegal", "turns", "first_turn", "last_turn")),
             ("first_initial", text), ("last_initial", text)]
    names = {number: "long", text: "string", data: "binary", pa.bool_(): "boolean"}
    schema = ", ".join(f"{c} {names[k]}" for c, k in kinds)
    segments = written(slim.repartition("conv_id", "segment").sortWithinPartitions("conv_id", "segment", "place")
                       .mapInArrow(mapped(segment_rows, *kinds), schema), "conversation-segments")

    sums = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kinds = [("conv_id", number), ("place", number), ("start", number), ("end", number), ("last", pa.bool_()), *((c, number) for c in sums)]
    cut = (segments.drop("places", "counts", "codes").repartition("conv_id").sortWithinPartitions("conv_id", "place")
           .mapInArrow(mapped(crossings, *kinds), ", ".join(f"{c} {names[k]}" for c, k in kinds)))
    cut = written(cut, "conversation-crossings")

    kinds = [("place", number), ("edits", text), ("roles", pa.list_(text))]
    paths = (segments.select("place", "places", "counts", "codes").join(cut.select("place", "start", "end", "last"), "place").drop("place")
             .mapInArrow(mapped(solved, *kinds), "place long, edits string, roles array<string>"))
    return rows.join(paths, "place"), cut.where("cost is not null").select("conv_id", *sums)


def cleaned(conversations: DataFrame) -> DataFrame:
    """The columns that count; a null role or text is one space."""
    df = narrow(conversations, ("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string"))
    return df.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])


def repaired(conversations: DataFrame) -> DataFrame:
    """Every row and every inserted turn: conv_id, place, part, turn, edit (K, R, D, I), fault, role, text.

    (place, part) order the rows of a conversation; role and text are those after the edit (an inserted turn's text is
    empty, a deleted row keeps its own). fault is the row's first of blank, duplicate and truncated, else null. Without
    the rows of edit D, the role initials of a conversation are `(s?(ua)+)?`, at the least cost, and of the cheapest
    repairs the one whose edits come first in ASCII order. A role is judged by its first character; the empty role, and
    one with another initial, can't be kept. Null roles and texts are one space. Rows of one turn are ordered by role and a hash of their
    text; null turns come first, and null conv_ids are one conversation. An empty table gives no rows; further columns take no part.
    """
    rows, _ = edited(cleaned(conversations))
    each = rows.withColumn("edit", F.split("edits", "")).select("*", F.posexplode(F.arrays_zip("edit", "roles")).alias("part", "e"))
    inserted = F.col("e.edit") == "I"
    # of equal rows, the one whose own letter is the first is the one that counts
    own = F.length(F.replace(F.substr("edits", F.lit(1), F.col("part")), F.lit("I"), F.lit("")))
    fault = F.when(F.col("blank"), "blank").when(~F.col("first") | (own > 0), "duplicate").when(F.col("truncated"), "truncated")
    return each.select("conv_id", "place", "part", F.when(~inserted, F.col("turn")).alias("turn"), F.col("e.edit").alias("edit"),
                       F.when(~inserted, fault).alias("fault"), F.coalesce("e.roles", "role").alias("role"),
                       F.when(inserted, "").otherwise(F.col("text")).alias("text"))


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, audit, repaired_sha256) of rows (conv_id, edits, roles, role, text) in order, read as a stream."""
    now, audit, sha, some = None, [], None, False
    for batch in batches:
        for conv_id, edits, roles, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if sha is None or conv_id != now:
                if sha is not None:
                    yield now, "".join(audit), sha.hexdigest()
                now, audit, sha, some = conv_id, [], hashlib.sha256(), False
            audit.append(edits)
            for letter, new in zip(edits, roles, strict=True):
                if letter != "D":
                    sha.update(f"{chr(10) if some else ''}{new or role}:{'' if letter == 'I' else text}".encode())
                    some = True
    if sha is not None:
        yield now, "".join(audit), sha.hexdigest()


def repair_digests(rows: DataFrame) -> DataFrame:
    """One row per conversation of rows (conv_id, turn, role, text, none null but for conv_id and turn): conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256.

    The hash runs over the whole repaired conversation in order, so one task reads it, as a stream.
    """
    found, sums = edited(rows)
    kinds = [("conv_id", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    whole = (found.select("conv_id", "place", "edits", "roles", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "place").drop("place")
             .mapInArrow(mapped(digests, *kinds), "conv_id long, audit string, repaired_sha256 string"))
    whole = whole.withColumnRenamed("conv_id", "_conv_id")
    return sums.join(whole, F.col("conv_id").eqNullSafe(F.col("_conv_id"))).drop("_conv_id")


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by crc32 of `conv_id:turn` modulo 20.

    0 drops the row, 1 empties its text, 2 takes the marks .!? out, 3 repeats it, 4 makes its role user.
    """
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    rows = cleaned(conversations).withColumn("_kind", F.crc32(F.encode(name, "UTF-8")) % 20).where("_kind != 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "_kind")
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.withColumn("_copy", copies).drop("_kind", "_copy")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """repair_digests of the damaged conversations, with a row for every conv_id that there was (null too).

    Conversations without a row after the damage have zeros, an empty audit and the hash of the empty string.
    """
    ids = conversations.select(F.col("conv_id").cast("long").alias("_id")).distinct()
    found = repair_digests(damaged(conversations))
    empty = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return ids.join(found, F.col("_id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(empty.get(c, 0)).cast("string" if c in empty else "long")).alias(c)
                                         for c in found.columns if c != "conv_id"])

