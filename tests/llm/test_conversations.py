"""Repair of conversations against brute force."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pyarrow as pa
import pytest
from fixtures import stable

from goldthread.llm import conversations
from goldthread.llm.auction import CLOSED, CLOSING, Lattice, behind, cheapest, crossing
from goldthread.llm.conversations import as_given, damaged, plans, repair_conversations, repair_digest

SCHEMA = "conv_id long, turn long, role string, text string, cost long, row long"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults_of(rows: list[tuple[str, str]]) -> list[str]:
    seen, out = set(), []
    for row in rows:
        marks = BLANK.findall(row[1])
        out.append("blank" if not marks else "duplicate" if row in seen else "fine" if marks[-1] in ".!?" else "truncated")
        seen.add(row)
    return out


def plain_repair(rows: list[tuple[str, str]]) -> tuple[int, str, list[str]]:
    """Cheapest edits by trying them all in the order of cost and then of initials."""
    faults, heap, done = faults_of(rows), [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, roles, out = heapq.heappop(heap)
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, list(out)
        if (at, roles) in done or not re.fullmatch("(s?(ua)*u?)?", roles) or len(roles) > 2 * len(rows) + 2:
            continue
        done.add((at, roles))
        for role in ("user", "assistant"):
            heapq.heappush(heap, (cost + 2, audit + "I", at, roles + role[0], (*out, f"{role}:")))
        if at < len(rows):
            role, text = rows[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, roles, out))
            if faults[at] not in ("blank", "duplicate"):
                cut = cost + (faults[at] == "truncated")
                heapq.heappush(heap, (cut, audit + "K", at + 1, roles + (role[:1] or "?"), (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    heapq.heappush(heap, (cut + 2, audit + "R", at + 1, roles + new[0], (*out, f"{new}:{text}")))


def plain_damage(rows: list[dict]) -> dict:
    out = defaultdict(list)
    for r in rows:
        place = f"{' ' if r['conv_id'] is None else r['conv_id']}:{' ' if r['turn'] is None else r['turn']}"
        kind = zlib.crc32(place.encode()) % 20
        role, text = (" " if r[c] is None else r[c] for c in ("role", "text"))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out[r["conv_id"]] += [(r["turn"], "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain_digest(conv, rows: list[tuple]) -> dict:
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    faults = faults_of([r[1:] for r in rows])
    cost, audit, out = plain_repair([r[1:] for r in rows])
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    return {"conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(out).encode()).hexdigest()}


def talk(seed: int, convs: int, first: int = 0) -> list[tuple]:
    pick = random.Random(seed)
    rows = []
    for conv in range(first, first + convs):
        for turn in range(pick.randrange(1, 9)):
            role = pick.choice(["system"] * (turn == 0) + ["user", "assistant"] * 4 + ["tool", "", "student", None])
            text = pick.choice(["Ja.", "Ja.", "No!", "Why? ", "Half a", "a.\n", "", " \t", None, "..", "é。", "x. ", "v.\x0b\x0c"])
            rows.append((conv, pick.choice([turn, turn, turn, turn * 3, None]), role, text, 0, 1))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_auction_equals_brute_force(seed):
    pick = random.Random(seed)
    for _ in range(150):
        codes = bytes(pick.choice([pick.randrange(16), 1, 2, 1, 2, 0]) for _ in range(pick.randrange(7)))
        rows = [(("system", "user", "assistant", "tool")[c % 4], ("a%d.", "", "dup.", "a%d")[c // 4].replace("%d", str(i))) for i, c in enumerate(codes)]
        # Duplicates repeat an earlier row; make one where the code asks for it.
        rows = [r for r, c in zip(rows, codes) if c // 4 != 2]
        assert cheapest(bytes(c for c in codes if c // 4 != 2)) == plain_repair(rows)[:2]


@pytest.mark.parametrize("seed", range(4))
def test_stretches_give_the_whole(seed):
    pick = random.Random(seed)
    for _ in range(60):
        rows = bytes(pick.choice([pick.randrange(16), 1, 2, 1, 2, 0]) for _ in range(pick.randrange(2, 40)))
        cuts = sorted(pick.sample(range(1, len(rows)), min(len(rows) - 1, 4)))
        parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        edits, state = "", 0
        for part, exits in zip(parts, behind([crossing(p) for p in parts])):
            own, state = Lattice(part, exits).trace(state)
            edits += own
        assert edits + CLOSING[state][1] == cheapest(rows)[1]


def test_long_and_empty_lattices():
    assert cheapest(bytes([1, 2] * 10_000)) == (0, "KK" * 10_000)
    assert cheapest(bytes([1] * 1000)) == (1000, "KR" * 500)
    assert Lattice(b"", CLOSED).trace(0) == ("", 0) and cheapest(b"") == (0, "")


def test_digest_equals_brute_force(spark):
    rows = talk(1, 120) + [(None, 0, "user", "A.", 0, 0), (None, None, None, None, None, None), (500, None, "user", "A.", 0, 0)]
    rows += [rows[3], rows[3], (501, 7, "user", "long " * 30_000 + ".", 0, 0), (501, 7, "assistant", "tie.", 0, 0)]
    # A conversation of which no row is left.
    gone = next(c for c in range(10_000, 20_000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "A.", 0, 0))
    frame = stable(spark, spark.createDataFrame(rows, SCHEMA).coalesce(1))
    given = [r.asDict() for r in frame.collect()]
    by_conv = plain_damage(given)
    want = [plain_digest(c, by_conv[c]) for c in dict.fromkeys(r["conv_id"] for r in given)]
    got = [r.asDict() for r in repair_digest(frame).collect()]
    key = lambda r: str(r["conv_id"])
    assert sorted(got, key=key) == sorted(want, key=key)
    last = next(r for r in got if r["conv_id"] == gone)
    assert last["audit"] == "" and last["repaired_sha256"] == hashlib.sha256(b"").hexdigest()


def test_one_long_conversation_among_short_ones(spark):
    """A conversation with most of all rows is cut into stretches, in several tasks, and still repaired as one."""
    pick = random.Random(4)
    long = [(77, t, pick.choice(["user", "assistant"]), pick.choice([f"{t}.", f"{t}.", f"{t}", "", "Same."]), 0, 0) for t in range(10_000)]
    frame = stable(spark, spark.createDataFrame(talk(5, 300, 1000) + long, SCHEMA).repartition(4))
    got = {r.conv_id: r for r in plans(as_given(frame)).collect()}
    rows = [r[2:4] for r in long]
    code = {"fine": 0, "blank": 1, "duplicate": 2, "truncated": 3}
    faults = faults_of(rows)
    cost, audit = cheapest(bytes("sua".find(r[0][:1]) + 4 * code[f] for r, f in zip(rows, faults)))
    own = got[77]
    assert (own.cost, own.audit) == (cost, audit) and own.gaps == 0
    assert [own[f] for f in ("blank", "duplicate", "truncated")] == [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    assert own.illegal == sum(a[0] == b[0] for a, b in zip(rows, rows[1:])) and len(got) == 301


def test_stretches_are_cut_between_rows(monkeypatch):
    monkeypatch.setattr(conversations, "STRETCH", 3)
    columns = {"conv_id": [1, 2, 2, 2, 2, 2, 3, 3, 4], "known": [True] * 9, "turn": [0, 0, 1, 2, 3, 3, 0, 1, 0], "row": list(range(9)),
               "copies": [1, 1, 2, 1, 1, 1, 1, 0, 1], "initial": [1] * 9, "fault": [3] * 9}
    found = [(s.conv, len(s.rows), w) for s, w in conversations._stretches([pa.RecordBatch.from_pydict(columns)])]
    assert found == [(1, 1, False), (2, 3, False), (2, 3, False), (3, 1, True), (4, 1, False)]


def test_repaired_rows(spark):
    frame = stable(spark, spark.createDataFrame(talk(9, 60), SCHEMA).coalesce(1))
    by_conv = defaultdict(list)
    for r in frame.collect():
        by_conv[r.conv_id].append((r.turn, " " if r.role is None else r.role, " " if r.text is None else r.text))
    got = defaultdict(list)
    for r in sorted(repair_conversations(as_given(frame)).collect(), key=lambda r: (r.conv_id, r.place)):
        got[r.conv_id].append(f"{r.role}:{r.text}")
        assert r.place == len(got[r.conv_id]) - 1 and r.edit in "KRI"
    for conv, rows in by_conv.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        assert got[conv] == plain_repair([r[1:] for r in rows])[2]


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_digest(empty).count() == 0 and damaged(empty).count() == 0
