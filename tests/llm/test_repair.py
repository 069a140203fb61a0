"""Conversation repair against a search over all alignments."""

from __future__ import annotations

import hashlib
import heapq
import random

import pytest

from cellpulse.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def cheapest(rows: list[tuple[str, str]]) -> tuple[list[int], int, str, list[str]]:
    """Counts of faults, cost, least audit and repaired lines of turns in order, by a shortest path over (turns done,
    state); two insertions in a row at most are ever needed."""
    seen, codes, counts = set(), [], [0, 0, 0, 0]
    for n, (role, text) in enumerate(rows):
        said = text.strip(WHITE)
        fault = 0 if not said else 1 if (role, text) in seen else 2 if said[-1] not in ".!?" else None
        if fault is not None:
            counts[fault] += 1
        seen.add((role, text))
        codes.append((role, text, fault))
        counts[3] += n > 0 and rows[n - 1][0][:1] + role[:1] not in ("su", "ua", "au")
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, lines = heapq.heappop(heap)
        if (i, state) in done:
            continue
        if i == len(codes) and state in ("", "a"):
            return counts, cost, audit, list(lines)
        done.add((i, state))
        wanted = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[wanted]
        heapq.heappush(heap, (cost + 5, audit + "I", i, wanted, (*lines, f"{name}:")))
        if i < len(codes):
            role, text, fault = codes[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, lines))
            if fault not in (0, 1):
                more = 5 * (fault == 2)
                if role[:1] == wanted or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
                heapq.heappush(heap, (cost + more + 1, audit + "R", i + 1, wanted, (*lines, f"{name}:{text}")))
    raise AssertionError


def expected(rows: list[tuple]) -> tuple:
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    rows = sorted(((r[1] is not None, r[1] or 0, *(" " if x is None else x for x in r[2:])) for r in rows), key=lambda r: (*r[:2], r[2].encode(), r[3].encode()))
    counts, cost, audit, lines = cheapest([r[2:] for r in rows])
    return (gaps, *counts, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversations(seed: int, n: int, longest: int) -> list[tuple]:
    chance = random.Random(seed)
    roles = ["user", "assistant"] * 4 + ["system", "tool", "s", "", "unknown", None]
    texts = ["Yes.", "no", "Why?", " ", "", None, "a b!", "ok\n", "done. \n"]
    rows = []
    for conv_id in range(n):
        for turn in range(chance.randint(1, longest)):
            role = ("user", "assistant")[turn % 2] if chance.random() < 0.7 else chance.choice(roles)
            text = f"{turn} says." if chance.random() < 0.7 else chance.choice(texts)
            at = None if chance.random() < 0.03 else turn + chance.choice([0, 0, 0, 0, 1, 3])
            rows.append((conv_id if conv_id else None, at, role, text))
            if chance.random() < 0.05:
                rows.append(rows[-1])
    chance.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_audits_equal_a_search_over_all_alignments(table, seed):
    rows = conversations(seed, 60, 12)
    made = {r[0]: tuple(r[1:]) for r in repair.audited(table(rows, SCHEMA)).collect()}
    ids = {r[0] for r in rows}
    assert made == {i: expected([r for r in rows if r[0] == i]) for i in ids}


def test_long_conversations_are_joined_from_runs_and_tasks(spark, table):
    """One conversation holds most rows, so that it spans the ranges of several tasks."""
    rows = [(7, *r[1:]) for r in conversations(5, 40, 14)] + conversations(6, 5, 6)
    told = table(rows, SCHEMA, files=6)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        turns = repair.placed(told)
        made = {r[0]: tuple(r[1:]) for r in repair.audited(told).collect()}
    finally:
        spark.conf.unset(setting)
    assert made[7] == expected([r for r in rows if r[0] == 7])
    parts = turns.filter("conv_id = 7").selectExpr("shiftright(place, 33) as part").distinct().count()
    assert parts > 2


def test_repaired_turns_follow_the_grammar_and_the_digest(table):
    import re

    rows = conversations(3, 40, 10)
    told = table(rows, SCHEMA)
    digests = {r.conv_id: r.repaired_sha256 for r in repair.audited(told).collect()}
    lines: dict = {}
    for r in repair.repaired(told).orderBy("conv_id", "place").collect():
        lines.setdefault(r.conv_id, []).append(r)
    for conv_id, digest in digests.items():
        mine = lines.get(conv_id, [])
        assert [r.place for r in mine] == list(range(len(mine)))
        assert re.fullmatch("(s?(ua)+)?", "".join(r.role[:1] for r in mine))
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in mine).encode()).hexdigest() == digest


def test_damage_and_conversations_without_turns(spark, table):
    import zlib

    rows = [(i, t, "user" if t % 2 == 0 else "assistant", f"Text {i}? Yes. {t}!") for i in range(40) for t in range(3)]
    rows += [(None, None, None, None), (50, None, "user", "alone.")]
    # A conversation whose only row is dropped.
    lone = next(i for i in range(1000, 2000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows.append((lone, 0, "user", "Gone."))
    told = table(rows, SCHEMA)
    wanted = []
    for conv_id, turn, role, text in rows:
        name = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind, role, text = zlib.crc32(name.encode()) % 20, role or " ", text or " "
        if kind:
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            wanted += [(conv_id, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    key = lambda r: tuple((x is not None, x or 0) for x in r[:2]) + r[2:]
    assert sorted(map(tuple, repair.damaged(told).collect()), key=key) == sorted(wanted, key=key)
    made = {r[0]: tuple(r[1:]) for r in repair.audited(repair.damaged(told), told).collect()}
    assert set(made) == {r[0] for r in rows}
    assert made[lone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_hard_columns_and_an_empty_table(spark, table):
    long = "word " * 200_000 + "."
    rows = [(1, 0, "user", long, "K", 9, 3), (1, 1, "assistant", " " * 300_000 + "x", "D", 8, 4), (1, 2, "user", "a\x00.", None, 7, 5)]
    told = table(rows, SCHEMA + ", audit string, place int, gaps int")
    made = repair.audited(told).collect()
    assert [tuple(r)[1:] for r in made] == [expected([r[:4] for r in rows])]
    empty = table([], SCHEMA)
    assert repair.audited(empty).count() == repair.repaired(empty).count() == 0


def test_texts_stay_out_of_groups(table):
    plan = repair.audited(table(conversations(1, 5, 5), SCHEMA))._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "NestedLoop", "FlatMapGroups", "CoGroups", "collect_list"):
        assert word not in plan
