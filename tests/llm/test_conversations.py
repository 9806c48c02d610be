"""Conversation repair against brute force over every sequence of edits."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from yearpanel.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, conv string, kind int, place int"
VISIBLE = re.compile(r"[^\x20\x09-\x0D]")


def harmed(rows):
    """Rows after damage in order, by conversation."""
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        harm = zlib.crc32(key.encode()) % 20
        role = "user" if harm == 4 else role
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        own += [(turn, role, text)] * (0 if harm == 0 else 2 if harm == 3 else 1)
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for k, v in out.items()}


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        visible = VISIBLE.findall(text)
        fault = ""
        if not visible:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif visible[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        out.append(fault)
    return out


def repairs(rows, marks, budget):
    """(cost, audit, lines) of every legal repair within a budget, illegal beginnings cut off."""

    def walk(k, cost, audit, lines, initials):
        if cost > budget or not re.fullmatch(r"(s?(ua)*u?)?", initials):
            return
        if k == len(rows) and re.fullmatch(r"(s?(ua)+)?", initials):
            yield cost, audit, lines
        for role in ("user", "assistant"):
            yield from walk(k, cost + 5, audit + "I", lines + [f"{role}:"], initials + role[0])
        if k == len(rows):
            return
        _, role, text = rows[k]
        yield from walk(k + 1, cost + 2, audit + "D", lines, initials)
        if marks[k] in ("blank", "duplicate"):
            return
        more = 5 * (marks[k] == "truncated")
        own = role[:1] if role[:1] in ("s", "u", "a") else "x"
        yield from walk(k + 1, cost + more, audit + "K", lines + [f"{role}:{text}"], initials + own)
        for new in ("user", "assistant"):
            yield from walk(k + 1, cost + 1 + more, audit + "R", lines + [f"{new}:{text}"], initials + new[0])

    return walk(0, 0, "", [], "")


def expected(rows):
    out = []
    for conv, own in harmed(rows).items():
        marks = faults(own)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, lines = min(repairs(own, marks, 2 * len(own)), key=lambda r: r[:2])
        text = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        counts = [marks.count(k) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, text))
    return out


def made(seed, conversations=150, most=6):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "usher"]
    texts = ["Yes.", "No!", "half", "", " \t", None, "Ünï 🙂?", "Yes.", "a. ", "word\x1c"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, most)):
            at = rng.choice([turn, turn, turn, 2 * turn, None])
            row = (conv or None, at, rng.choice(roles), rng.choice(texts))
            rows += [row] * rng.choice([1, 1, 1, 2])
    return rows


def run(spark, rows, bits=16):
    frame = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, conversations.repaired(frame, bits).collect()), key=str)


@pytest.mark.parametrize("seed, bits", [(1, 16), (2, 0), (3, 1)])
def test_every_repair_is_the_cheapest_and_least(spark, seed, bits):
    rows = made(seed)
    assert run(spark, rows, bits) == sorted(expected(rows), key=str)


def test_blocks_of_a_conversation_with_most_rows(spark):
    """One conversation over many tasks and blocks equals itself in one block."""
    rng = random.Random(5)
    roles, texts = ("user", "assistant", "system", "tool"), ("One.", "cut", "", "Two!")
    rows = [(7, k, rng.choice(roles), f"{k % 900} {rng.choice(texts)}") for k in range(3000)]
    turn = next(k for k in range(99) if zlib.crc32(f"7:{k}".encode()) % 20 > 4)
    rows += [(8, 1, "user", "Hi."), (8, 2, "assistant", "Yes.")] + [(7, turn, "user", "same.")] * 2000
    whole = run(spark, rows)
    assert whole == run(spark, rows, 3)
    hot = next(r for r in whole if r[0] == 7)
    assert hot[3] >= 1999 and len(hot[7]) > 4500


def test_a_run_goes_through_powers():
    for symbol in ("un", "ut", "sn", "on", "ab"):
        costs = conversations.END
        for _ in range(37):
            costs = conversations._step(symbol, costs)
        by_powers = conversations.END
        for matrix in conversations.powers(symbol, 37):
            by_powers = conversations.applied(matrix, by_powers)
        assert by_powers == costs
        assert conversations.applied(conversations.transition([(symbol, 37)]), conversations.END) == costs


def test_empty_null_and_far_turns(spark):
    assert run(spark, []) == []
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    rows = [(dropped, 1, "user", "Hi."), (None, None, None, None)]
    rows += [(3, -(1 << 63), "user", "x" * 300_000 + "."), (3, (1 << 63) - 1, "assistant", "y.")]
    found = {r[0]: r for r in run(spark, rows)}
    empty = hashlib.sha256().hexdigest()
    assert found[dropped] == (dropped, 0, 0, 0, 0, 0, 0, "", empty)
    assert found[None][1:3] == (0, 1) and found[None][7] == "D"
    assert found[3][1] == (1 << 63) - 1


def test_whole_table_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = sorted(map(tuple, conversations.repaired(table).collect()), key=str)
    want = {r[0]: r for r in expected_by_dp(rows)}
    assert {r[0]: r for r in got} == want


def expected_by_dp(rows):
    """As ``expected``, for longer conversations: beginnings of equal cost and state compete."""
    follow = {"": "us", "s": "u", "u": "a", "a": "u"}
    for conv, own in harmed(rows).items():
        marks = faults(own)
        states = {("", 0): {("", ())}}
        for k in range(len(own) + 1):
            for _ in range(3):  # insertions
                for (at, cost), held in list(states.items()):
                    for role in ("user", "assistant"):
                        if role[0] in follow[at]:
                            new = {(a + "I", (*ls, f"{role}:")) for a, ls in held}
                            states.setdefault((role[0], cost + 5), set()).update(new)
            least = {}
            for at, cost in states:
                least[at] = min(cost, least.get(at, cost))
            states = {(at, cost): held for (at, cost), held in states.items() if cost <= least[at]}
            if k == len(own):
                break
            _, role, text = own[k]
            after = {}
            for (at, cost), held in states.items():
                options = [(at, 2, "D", None)]
                if marks[k] not in ("blank", "duplicate"):
                    more = 5 * (marks[k] == "truncated")
                    if role[:1] and role[:1] in follow[at]:
                        options.append((role[0], more, "K", role))
                    options += [(r[0], 1 + more, "R", r) for r in ("user", "assistant") if r[0] in follow[at]]
                for to, paid, edit, new in options:
                    lines = {(a + edit, ls if new is None else (*ls, f"{new}:{text}")) for a, ls in held}
                    after.setdefault((to, cost + paid), set()).update(lines)
            states = after
        cost, audit, lines = min((c, a, ls) for (at, c), held in states.items() if at in ("", "a") for a, ls in held)
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        counts = [marks.count(k) for k in ("blank", "duplicate", "truncated")]
        text = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        yield conv, gaps, *counts, illegal, cost, audit, text
