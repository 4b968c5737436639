"""Repairs against a plain search over all edits, and digests against a replay in Python."""

import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import product

import pytest

from grouprank.llm import conversation_repair as cr

LEGAL = re.compile("(s?(ua)+)?")
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = re.sub("[.!?]", "", text)
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def fault_of(rows):
    seen, found = set(), []
    for _, _, role, text in rows:
        marks = VISIBLE.findall(text)
        found.append("blank" if not marks else "duplicate" if (role, text) in seen else "truncated" if marks[-1] not in ".!?" else None)
        seen.add((role, text))
    return found


def choices(role, fault):
    """(cost, letter, initial or nothing, new role) of a row."""
    yield 4, "D", "", None
    if fault not in ("blank", "duplicate"):
        more = 3 if fault == "truncated" else 0
        if role:  # a role without an initial can't be kept
            yield more, "K", role[0], role
        for new in ("user", "assistant"):
            yield 3 + more, "R", new[0], new


def search(rows, faults):
    """Least (cost, audit, repaired lines) over all edits, by initials alone; feasible prefixes only, state by state."""
    def dead(initials):
        return not re.fullmatch("(s?(ua)*u?)?", initials)

    # what may follow depends on the last initial only
    @lru_cache(maxsize=None)
    def best(at, last):
        ends = []
        if LEGAL.fullmatch(tail[last]):
            if at == len(rows):
                ends.append((0, "", ()))
        if at < len(rows):
            _, _, role, text = rows[at]
            for cost, letter, initial, new in choices(role, faults[at]):
                if initial and dead(tail[last] + initial):
                    continue
                rest = best(at + 1, initial or last)
                ends.append((cost + rest[0], letter + rest[1], ((f"{new}:{text}",) if new is not None else ()) + rest[2]))
        return min(ends + [(c, a, t) for c, a, t in inserted(at, last)], key=lambda x: (x[0], x[1]), default=(10**9, "", ()))

    tail = {"": "", "s": "s", "u": "u", "a": "ua"}

    @lru_cache(maxsize=None)
    def plain(at, last):
        """As best, but without an inserted turn first."""
        ends = []
        if at == len(rows) and LEGAL.fullmatch(tail[last]):
            ends.append((0, "", ()))
        if at < len(rows):
            _, _, role, text = rows[at]
            for cost, letter, initial, new in choices(role, faults[at]):
                if initial and dead(tail[last] + initial):
                    continue
                rest = best(at + 1, initial or last)
                ends.append((cost + rest[0], letter + rest[1], ((f"{new}:{text}",) if new is not None else ()) + rest[2]))
        return min(ends, key=lambda x: (x[0], x[1]), default=(10**9, "", ()))

    def inserted(at, last):
        for new in ("user", "assistant"):
            if dead(tail[last] + new[0]):
                continue
            rest = plain(at, new[0])
            yield 3 + rest[0], "I" + rest[1], (f"{new}:",) + rest[2]
            for second in ("user", "assistant"):
                if not dead(tail[new[0]] + second[0]):
                    rest = plain(at, second[0])
                    yield 6 + rest[0], "II" + rest[1], (f"{new}:", f"{second}:") + rest[2]

    return best(0, "")


def digest(rows):
    """The digest of one conversation's rows, in order."""
    faults = fault_of(rows)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, lines = search(rows, faults)
    return (gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def digests(rows, ids):
    by = {c: [] for c in ids}
    for r in rows:
        by[r[0]].append(r)
    return {c: digest(in_order(rs)) for c, rs in by.items()}


def conversations(seed, n, most):
    draw, rows = random.Random(seed), []
    texts = ["Yes.", "No!", "", " \n", "and then", "Why? ", "Fine.)", "été…", "x" * 3000 + "."]
    for conv in range(n):
        for turn in range(draw.randrange(1, most)):
            rows.append((conv, draw.choice([turn, turn, turn, turn + 3, None]), draw.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None]),
                         draw.choice([*texts, f"t{turn}.", f"u{turn}.", None])))
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("segment", [14, 1])
def test_digests_equal_search(spark, monkeypatch, segment):
    """Whole conversations, and conversations cut into segments of two rows."""
    monkeypatch.setattr(cr, "SEGMENT", segment)
    rows = conversations(segment, 120, 9) + conversations(segment + 50, 1, 2)
    rows += [(1000, t, "ua"[t % 2] + "x", f"word {t}" + (".", "", "!")[t % 3]) for t in range(300)]
    rows += [(1001, 5, "user", "Same.")] * 200 + [(1002, None, "assistant", f"{t % 7}.") for t in range(90)] + [(None, 1, "user", "No id.")]
    lost = next(c for c in range(2000, 3000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((lost, 0, "user", "Dropped."))
    df = spark.createDataFrame([(*r, "p", 1) for r in rows], SCHEMA + ", place string, edit int")
    found = {r.conv_id: tuple(r)[1:] for r in cr.repair_damaged(df).collect()}
    want = digests(damage(rows), {r[0] for r in rows})
    assert found == want
    assert found[lost] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())


def test_search_equals_all_edits():
    """The search that the other tests trust, against every sequence of edits of short conversations."""
    draw = random.Random(3)
    for _ in range(60):
        rows = [(0, t, draw.choice(["system", "user", "assistant", "tool"]), draw.choice(["Yes.", "no", "", f"{t}."])) for t in range(draw.randrange(4))]
        faults, ends = fault_of(rows), []
        turns = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
        for edits in product(*[list(choices(r[2], f)) for r, f in zip(rows, faults)]):
            for more in product(turns, repeat=len(rows) + 1):
                initials = audit = ""
                cost = 0
                for k, new in enumerate(more):
                    initials, audit, cost = initials + "".join(x[0] for x in new), audit + "I" * len(new), cost + 3 * len(new)
                    if k < len(rows):
                        c, letter, initial, _ = edits[k]
                        initials, audit, cost = initials + initial, audit + letter, cost + c
                if LEGAL.fullmatch(initials):
                    ends.append((cost, audit))
        assert min(ends) == search(rows, faults)[:2]


def test_repaired_rows_are_the_digest(spark):
    rows = conversations(9, 60, 9)
    df = spark.createDataFrame(rows, SCHEMA)
    out = cr.repaired(df).orderBy("conv_id", "place", "part").collect()
    clean = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    want = digests(clean, {r[0] for r in rows})
    for conv, d in want.items():
        mine = [r for r in out if r.conv_id == conv]
        kept = [r for r in mine if r.edit != "D"]
        assert "".join(r.edit for r in mine) == d[6]
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in kept).encode()).hexdigest() == d[7]
        assert LEGAL.fullmatch("".join(r.role[0] for r in kept))
        assert [sum(r.fault == f for r in mine) for f in ("blank", "duplicate", "truncated")] == list(d[1:4])


def test_empty_and_null_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cr.repair_damaged(empty).count() == 0 and cr.repaired(empty).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None)] * 3, SCHEMA)
    assert {r.conv_id: tuple(r)[1:] for r in cr.repair_damaged(nulls).collect()} == digests(damage([(None, None, None, None)] * 3), {None})


def test_one_state_path(spark):
    """Hirschberg's letters are the least audit also where many repairs cost the same."""
    draw = random.Random(1)
    for _ in range(200):
        codes = bytes(draw.randrange(12) for _ in range(draw.randrange(1, 40)))
        rows = [(0, t, ["system", "user", "assistant", "tool"][c // 3], "") for t, c in enumerate(codes)]
        faults = [[None, "blank", "truncated"][c % 3] for c in codes]
        cost, audit, _ = search(rows, faults)
        base, (costs, order) = cr.forward(codes, 0)
        end = min(cr.STATES, key=lambda s: (costs[s] + cr.TAIL[s][0], order[s]))
        assert "".join(cr.hirschberg(codes, 0, end)) + cr.TAIL[end][1] == audit
        assert base + costs[end] + cr.TAIL[end][0] == cost
