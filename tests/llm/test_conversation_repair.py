import hashlib
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import conversation_repair as C

WORD = re.compile(r"[^\x20\x09-\x0D]")
INITIALS = "suax"


def brute(rows):
    """(cost, edits' initials, result) of the best edits of [(initial, fault)], by all of them; faults: '', gone, cut."""

    @lru_cache(None)
    def go(at, state, inserts):
        found = []
        if at == len(rows) and state in (0, 3):
            found.append((0, "", ()))
        turn = "uuau"[state]
        to = 3 if state == 2 else 2

        def after(price, letter, made, nxt):
            rest = go(*nxt)
            if rest:
                found.append((price + rest[0], letter + rest[1], ((made,) if made else ()) + rest[2]))

        if inserts < 3:
            after(5, "I", turn, (at, to, inserts + 1))
        if at < len(rows):
            initial, fault = rows[at]
            after(2, "D", None, (at + 1, state, 0))
            if fault != "gone":
                more = 5 if fault == "cut" else 0
                after(1 + more, "R", turn, (at + 1, to, 0))
                if initial == "s" and state == 0:
                    after(more, "K", "s", (at + 1, 1, 0))
                if initial == turn:
                    after(more, "K", turn, (at + 1, to, 0))
        return min(found, default=None)

    return go(0, 0, 0)


def symbols(rows):
    return bytes(0 if f == "gone" else INITIALS.index(i) + 1 + (4 if f == "cut" else 0) for i, f in rows)


@settings(max_examples=600, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(INITIALS), st.sampled_from(["", "", "gone", "cut"])), max_size=14))
def test_tables_find_the_cheapest_and_least_edits(rows):
    cost, audit, made = brute(tuple(rows))
    assert C.cheapest(symbols(rows)) == (cost, audit)
    assert re.fullmatch("(s?(ua)+)?", "".join(made))


def test_long_conversation_in_linear_steps():
    cost, audit = C.cheapest(bytes([2, 3]) * 100_000)
    assert cost == 0 and audit == "K" * 200_000


def damaged(rows):
    """[(conv, turn, role, text)] after the damage, in order, by conversation; all ids of the input are keys."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
    return out


def expected(rows):
    out = set()
    for conv, mine in damaged(rows).items():
        seen, faults = set(), []
        for _, role, text in mine:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not WORD.search(text) else "duplicate" if (role, text) in seen else "cut" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] if r[1][:1] in ("s", "u", "a") else "x" for r in mine]
        cost, audit, _ = brute(tuple((i, "gone" if f in ("blank", "duplicate") else f) for i, f in zip(initials, faults, strict=True)))
        lines, state, left = [], 0, iter(zip(mine, initials, strict=True))
        for letter in audit:
            (_, role, text), initial = next(left) if letter != "I" else ((0, "", ""), "")
            if letter == "D":
                continue
            turn = "assistant" if state == 2 else "user"
            lines.append(f"{role if letter == 'K' else turn}:{text}")
            state = 1 if initial == "s" and letter == "K" else 3 if state == 2 else 2
        turns = {r[0] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        out.add((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("cut"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return out


ROLES = ["user", "assistant", "system", "tool", None, ""]


def rows_of(seed):
    import random

    rng, rows = random.Random(seed), []
    for conv in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            text = rng.choice(["Yes.", "No!", "and then", "", " \t", None, "naïve…", "Why? ", "long " * 3000 + "."])
            rows.append((conv, rng.choice([turn, turn, turn * 3, None]), rng.choice(ROLES if rng.random() < 0.3 else ["user", "assistant"]), text))
    return rows + rows[:20]  # repeated rows


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_of_damaged_rows(spark, seed):
    rows = rows_of(seed)
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, header string, h int").repartition(5)
    got = [tuple(r) for r in C.repair(C.damage(given), every=given).collect()]
    assert len(got) == len(set(got)) and set(got) == expected(rows)


def test_repaired_rows(spark):
    given = spark.createDataFrame([("a", 0, "user", "Hi."), ("a", 1, "user", "Hm."), ("a", 2, "assistant", "So"), ("b", 0, "system", "S.")], "conv_id string, turn int, role string, text string")
    got = {(r.conv_id, r.place): (r.role, r.text, r.edit) for r in C.repaired(given).collect()}
    assert got == {("a", 0): ("user", "Hi.", "K"), ("a", 1): ("assistant", "Hm.", "R")}
    audits = {r.conv_id: (r.cost, r.audit) for r in C.audits(given).collect()}
    assert audits == {"a": (3, "KRD"), "b": (2, "D")}


def test_empty_and_dropped(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.repair(none).count() == 0 and C.repaired(none).count() == 0
    every = spark.createDataFrame([(7,), (7,), (None,)], "conv_id long")
    nothing = hashlib.sha256(b"").hexdigest()
    assert {tuple(r) for r in C.repair(none, every=every).collect()} == {(7, 0, 0, 0, 0, 0, 0, "", nothing), (None, 0, 0, 0, 0, 0, 0, "", nothing)}
