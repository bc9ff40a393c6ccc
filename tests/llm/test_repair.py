import heapq
import random
import re
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from panelspark.llm import repair as module
from panelspark.llm.repair import as_blocks, damaged, digests, op12, repair, tables

SPACE = r"[\x20\x09-\x0D]"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = re.sub(SPACE + r"+\Z", "", text)
        out.append(
            "blank" if not bare else "duplicate" if (role, text) in seen else None if bare[-1] in ".!?" else "truncated"
        )
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, lines) by uniform-cost search over whole edit strings."""
    marks = faults(rows)
    after = {"": "u", "s": "u", "u": "a", "a": "u"}
    queue, done = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, i, state, lines = heapq.heappop(queue)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(lines)
        if (i, state) in done:
            continue
        done.add((i, state))
        n = after[state]
        word = {"u": "user", "a": "assistant"}[n]
        heapq.heappush(queue, (cost + 3, audit + "I", i, n, (*lines, word + ":")))
        if i < len(rows):
            role, text = rows[i]
            heapq.heappush(queue, (cost + 4, audit + "D", i + 1, state, lines))
            if marks[i] in (None, "truncated"):
                more = 3 * (marks[i] == "truncated")
                heapq.heappush(queue, (cost + 3 + more, audit + "R", i + 1, n, (*lines, f"{word}:{text}")))
                if role[:1] == n or (role[:1] == "s" and state == ""):
                    heapq.heappush(queue, (cost + more, audit + "K", i + 1, role[:1], (*lines, f"{role}:{text}")))
    raise AssertionError


def expected(rows):
    """The contract's columns for the damaged (turn, role, text) of one conversation, in order."""
    if not rows:
        return (0, 0, 0, 0, 0, 0, "", sha256().hexdigest())
    said = [(r, t) for _, r, t in rows]
    found = faults(said)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
    cost, audit, lines = cheapest(said)
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha256(lines.encode()).hexdigest())


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        say = lambda x: " " if x is None else str(x)
        code = crc32(f"{say(conv)}:{say(turn)}".encode()) % 20
        role, text = say(role), say(text)
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        own += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    for own in out.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return out


def log(seed, convs=120):
    rng = random.Random(seed)
    rows = []
    for conv in range(convs):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "admin"])
            text = rng.choice(["Yes.", "No!", "half a", " \n", "", None, "é? ", f"w{rng.random()}.", f"cut {rng.random()}"])
            rows.append((conv, turn if rng.random() < 0.95 else rng.choice([None, 0, 3]), role, text))
    return rows


@pytest.mark.parametrize("seed", range(6))
def test_trace_against_search(seed):
    rng = random.Random(seed)
    for _ in range(150):
        rows = [
            (rng.choice(["system", "user", "assistant", "x"]), rng.choice(["ok.", "cut", "", f"{rng.random()}.", f"{rng.random()}"]))
            for _ in range(rng.randrange(0, 11))
        ]
        marks = faults(rows)
        symbols = np.array(
            [1 if f in ("blank", "duplicate") else (6 if f else 2) + ("sua".find(r[0]) % 4) for (r, _), f in zip(rows, marks)], np.int64
        )
        vector, cost, right = tables().fold(as_blocks(symbols))
        steps, end = tables().trace(symbols, 0, 0)
        audit = "".join(s for s, _ in steps) + module.CLOSING[end][0]
        assert (cost[0] + tables().vectors[vector[0]][0], audit) == cheapest(rows)[:2]
        assert tables().exits(as_blocks(symbols), right)[0, 0] == end


def test_few_vectors():
    assert len(tables().vectors) < 100
    assert min(map(min, tables().vectors)) == 0


@pytest.mark.parametrize("chunk", [module.CHUNK, 3])
def test_operator_against_search(spark, monkeypatch, chunk):
    monkeypatch.setattr(module, "CHUNK", chunk)
    rows = log(1) + [(None, t, "user", "hm.") for t in range(4)]
    rows += [(500, t, "user" if t % 2 else "assistant", f"t{t}.") for t in range(150)] + [(501, 0, "user", "same.")] * 40
    frame = spark.createDataFrame([(*r, 0, "x") for r in rows], "conv_id long, turn long, role string, text string, place int, edit string")
    turns, report = repair(frame)
    got = {r.conv: tuple(r)[1:] for r in report.join(digests(turns), "conv").collect()}
    by_conv = {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, own in by_conv.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        assert got[f"={conv}" if conv is not None else ""] == expected(own)
    assert len(got) == len(by_conv)


def test_query(spark, tmp_path):
    rows = log(2, 200) + [(1000 + k, 0, "user", "Gone?") for k in range(60)]
    rows += [(None, None, None, None), (None, 1, "user", "x."), (7, 0, "user", "y"), (7, 0, "user", "y")]
    spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, cost int").write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in op12(spark, str(tmp_path)).collect()}
    want = damage(rows)
    assert any(not own for own in want.values())
    assert got == {conv: expected(own) for conv, own in want.items()}


def test_long_texts_and_empty_table(spark):
    schema = "conv_id long, turn long, role string, text string"
    frame = spark.createDataFrame([(1, 0, "user", "é" * 200_000 + "."), (1, 1, "assistant", "x" * 200_000)], schema)
    turns, report = repair(frame)
    assert [(r.edit, r.role, len(r.text)) for r in turns.orderBy("place", "nth").collect()] == [("K", "user", 200_001), ("K", "assistant", 200_000)]
    assert (report.first().cost, report.first().truncated) == (3, 1)
    empty = spark.createDataFrame([], schema)
    turns, report = repair(empty)
    assert turns.count() == report.count() == digests(turns).count() == damaged(empty).count() == 0


def test_blocks_equal_single_symbols():
    rng, table = np.random.default_rng(0), tables()
    symbols = rng.integers(1, 10, 203)
    vector, cost, _ = table.fold(as_blocks(symbols))
    for v in range(len(table.vectors)):
        now, total = v, 0
        for symbol in symbols[::-1]:
            total, now = total + table.cost[now, symbol], table.step[now, symbol]
        assert (now, total) == (vector[v], cost[v])
