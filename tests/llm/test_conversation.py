import hashlib
import random
import re
from functools import cache

import numpy as np
import pytest
import xxhash

from millrace.llm import conversation
from tests.llm.odd import prose


def signed_hash(text):
    return (xxhash.xxh64(text.encode(), 42).intdigest() + 2**63) % 2**64 - 2**63


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), signed_hash(r[3])))


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        ending = text.rstrip(" \t\n\x0b\x0c\r")
        out.append(1 if not ending else 2 if (role, text) in seen else 3 if ending[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def repaired(rows, fault):
    """Cost, audit and lines by trying all edits from every state."""
    n = len(rows)

    @cache
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == n and state in "-a" else []
        to = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[to]
        if inserted < 3:
            c, a, lines = best(i, to, inserted + 1)
            ways.append((c + 3, "I" + a, (f"{name}:", *lines)))
        if i < n:
            _, _, role, text = rows[i]
            c, a, lines = best(i + 1, state, 0)
            ways.append((c + 4, "D" + a, lines))
            if fault[i] not in (1, 2):
                more = 3 if fault[i] == 3 else 0
                c, a, lines = best(i + 1, to, 0)
                ways.append((c + 3 + more, "R" + a, (f"{name}:{text}", *lines)))
                if (state, role[:1]) in {("-", "s"), ("-", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
                    c, a, lines = best(i + 1, role[0], 0)
                    ways.append((c + more, "K" + a, (f"{role}:{text}", *lines)))
        return min(ways, default=(10**9, "", ()))

    for i in range(n, 0, -1):
        for state in "-sua":
            best(i, state, 0)
    return best(0, "-", 0)


def brute(rows):
    out = []
    rows = [(c, t, " " if role is None else role, " " if text is None else text) for c, t, role, text in rows]
    for conv in {r[0] for r in rows}:
        own = in_order([r for r in rows if r[0] == conv])
        fault = faults(own)
        cost, audit, lines = repaired(own, fault)
        turns = {r[1] for r in own} - {None}
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, fault.count(1), fault.count(2), fault.count(3), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


SCHEMA = "conv_id long, turn long, role string, text string"


def result(spark, rows, parts=4):
    table = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA + ", place int, initial string, chunk int").repartition(parts)
    out = conversation.summaries(*conversation.repair(table))
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "digest"]
    return sorted((tuple(r) for r in out.select(conversation.given_id("conv"), *names).collect()), key=repr)


def conversations(seed, n, most=9):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "u2", "tool", "", None, "System"]
    texts = ["Yes.", "no", "Well? ", "", "  \n", "Yes.", "end!\t", None, "漢字。", "a.b", prose(1, 300)]
    rows = []
    for conv in [*range(n), None]:
        for k in range(draw.randrange(1, most)):
            role = draw.choice(["user", "assistant"]) if draw.random() < 0.6 else draw.choice(roles)
            rows.append((conv, draw.choice([k, k, k, k + 2, None]), role, draw.choice(texts) if draw.random() < 0.5 else f"text {k}" + draw.choice(["", "."])))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, seed):
    rows = conversations(seed, 150)
    assert result(spark, rows) == brute(rows)


def test_audit_pattern(spark):
    for r in result(spark, conversations(9, 80)):
        assert re.fullmatch("[DIKR]*", r[7])


def test_open_and_long_conversations(spark, monkeypatch):
    """Many blocks and partitions: one conversation has two thirds of all rows."""
    monkeypatch.setattr(conversation, "BLOCK", 7)
    monkeypatch.setattr(conversation, "LONG", 40)
    monkeypatch.setattr(conversation, "TOGETHER", 30)
    draw = random.Random(5)
    hot = [(17, None if k < 3 else k // 2 + k // 90, draw.choice(["user", "assistant", "user", "tool", "system"]), f"t{draw.randrange(300)}" + draw.choice([".", "", "!"])) for k in range(400)]
    middle = [(23, k, draw.choice(["user", "assistant"]), f"m{k}.") for k in range(60)]
    rows = hot + middle + [r for r in conversations(6, 60) if r[0] not in (17, 23)]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 50])
def test_crossings_equal_one_sweep(n):
    """Halving gives the same states as the audit that a sweep from the end would choose."""
    rng = np.random.default_rng(n)
    kind = rng.integers(0, conversation.KINDS, 40 * n)
    first = np.arange(40) * n
    cost, end = conversation.Steps.of_rows(kind).ends(first, first + n)
    edits, _ = conversation.row_edits(kind, first, first + n, np.zeros(40, np.int64), end)
    for a, c, e in zip(first.tolist(), cost.tolist(), end.tolist(), strict=True):
        rows = [(0, i, "suat"[k // 2] if k < 8 else "user", "x") for i, k in enumerate(kind[a : a + n].tolist())]
        fault = [1 if k == 8 else 3 * (k % 2) for k in kind[a : a + n].tolist()]
        want = repaired(rows, fault)
        assert ("".join(edits[a : a + n]) + conversation.LAST_EDITS[e], c) == (want[1], want[0])


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversation.summaries(*conversation.repair(empty)).collect() == []


def test_damage(spark, tmp_path):
    """Conversations whose rows are all dropped are reported with zeros; nulls take part as one blank."""
    import zlib

    rows = [(c, t, "user", "Why? So. Ok!") for c in (*range(60), None) for t in ((None, 0) if c is None or c % 2 else (c,))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    want = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        case = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        changed = (c, t, "user" if case == 4 else role, "" if case == 1 else "Why So Ok" if case == 2 else text)
        want[c] += [changed] * {0: 0, 3: 2}.get(case, 1)
    got = {r.conv_id: r for r in conversation.query(spark, str(tmp_path)).collect()}
    assert set(got) == set(want)
    none = [c for c, rs in want.items() if not rs]
    assert none
    for c in none:
        assert tuple(got[c])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    flat = brute([r for rs in want.values() for r in rs])
    assert sorted((tuple(got[r[0]]) for r in flat), key=repr) == flat
