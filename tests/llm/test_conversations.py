from __future__ import annotations

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pulsegrain.llm.conversations import (
    ASSISTANT, ENDINGS, START, STATES, before, BEHIND_ALL, repair_report, repaired, tables)
from tests.conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]")
GOAL = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        hit = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if hit == 1:
            text = ""
        if hit == 2:
            text = re.sub("[.!?]", "", text)
        if hit == 4:
            role = "user"
        for _ in range({0: 0, 3: 2}.get(hit, 1)):
            yield turn, role, text


def by_search(rows, faults):
    """Uniform-cost search over (rows done, initials' state), least audit first among equal costs."""
    ends = {"": True, "s": False, "u": False, "a": True}  # what came last
    def step(state, initial):
        word = {"": "", "s": "s", "u": "u", "a": "ua"}[state] + initial
        ok = any(GOAL.match(word + tail) for tail in ("", "a", "ua"))
        return initial if ok and initial else None
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and ends[state]:
            return cost, audit, out
        moves = [(5, "I", i, r[0], f"{r}:") for r in ("user", "assistant")]
        if i < len(rows):
            role, text = rows[i][1:]
            moves.append((2, "D", i + 1, None, None))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                moves.append((more, "K", i + 1, role[:1], f"{role}:{text}"))
                moves += [(1 + more, "R", i + 1, r[0], f"{r}:{text}") for r in ("user", "assistant")]
        for price, edit, j, initial, line in moves:
            then = state if initial is None else step(state, initial)
            if then is not None:
                heapq.heappush(heap, (cost + price, audit + edit, j, then, out if line is None else (*out, line)))
    raise AssertionError


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        after = list(damaged(r for r in rows if r[0] == conv))
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in after:
            chars = WORD.findall(text)
            faults.append("blank" if not chars else "duplicate" if (role, text) in seen
                          else "truncated" if chars[-1] not in ".!?" else None)
            seen.add((role, text))
        turns = [t for t, _, _ in after if t is not None]
        cost, audit, lines = by_search(after, faults)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                     *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(after)),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def check(df, rows):
    found = df.collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert len({r.conv_id for r in found}) == len(found)
    assert {r.conv_id: tuple(r[n] for n in names) for r in found} == brute(rows)


def generated(seed, n_conversations, longest=9):
    pick = random.Random(seed)
    roles = ["user", "assistant"] * 4 + ["system", "tool", "", None, "ass", "System"]
    texts = ["Yes.", "No!", "Why? ", "well", "so. (", None, "", " \t\n", "a.\u0085", "😀", "end.\n", "é?"]
    return [(c, pick.choice([t, t, t, t + 3, None]), pick.choice(roles), pick.choice(texts) if pick.random() < 0.6 else f"t{t}.")
            for c in range(n_conversations) for t in range(pick.randrange(1, longest))]


def test_given_conversations(spark):
    table = spark.read.parquet(f"{SMALL}/conversations.parquet")
    check(repair_report(table), [tuple(r) for r in table.collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_hard_conversations(spark, seed):
    rows = generated(seed, 150)
    rows += rows[:40]  # repeated rows
    rows += [(None, t, "user" if t % 2 else "assistant", f"n{t}.") for t in range(5)]
    rows += [(900, None, None, None), (901, None, "user", "x.")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    names = ("segment", "rows", "edits", "at", "last", "digest", "gone", "place", "letter", "fault", "c", "s")
    check(repair_report(df.withColumns({n: F.lit("clash") for n in names})), rows)


def test_long_conversations_are_cut_into_segments(spark):
    pick = random.Random(5)
    rows = [(c, t, pick.choice(["user", "assistant", "assistant", "system"]), pick.choice(["ok.", f"t{t}", f"t{t}."]))
            for c, n in ((1, 300), (2, 47), (3, 16), (4, 17), (5, 33)) for t in range(n)]
    check(repair_report(spark.createDataFrame(rows, SCHEMA)), rows)


def test_rows_that_are_all_dropped_and_an_empty_table(spark):
    turn = next(t for t in range(100) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    rows = [(7, turn, "user", "gone.")]
    check(repair_report(spark.createDataFrame(rows, SCHEMA)), rows)
    assert repair_report(spark.createDataFrame([], SCHEMA)).count() == 0


def test_repaired_rows_give_the_hash(spark):
    df = spark.createDataFrame(generated(8, 30), SCHEMA)
    by_conversation: dict = {}
    for r in sorted(repaired(df).collect(), key=lambda r: (r.conv_id, r.place)):
        by_conversation.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert r.edit in "KRI"
    for r in repair_report(df).collect():
        lines = by_conversation.get(r.conv_id, [])
        assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == r.repaired_sha256
        assert GOAL.match("".join(line[0] for line in lines))


def test_shared_suffixes_are_computed_once(monkeypatch):
    from pulsegrain.llm import conversations

    made = []
    monkeypatch.setattr(conversations, "before", lambda letter, node: made.append(letter) or before(letter, node))
    words = sorted((w for w in ("".join(p) for n in range(1, 5) for p in itertools.product("uaSx", repeat=n))),
                   key=lambda w: w[::-1])
    found = dict(tables(iter(words)))
    assert len(made) == len(words)  # a node is a distinct suffix
    for word in words:
        node = BEHIND_ALL
        for letter in reversed(word):
            node = before(letter, node)
        assert found[word] == node


def test_insertions_close_every_state():
    table = before("x", BEHIND_ALL)
    assert table[START][ASSISTANT] == (12, "IID") and ENDINGS[START] == (0, "") and len(table) == len(STATES)
