"""Repair of conversations against a walk over all edits."""

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from crownledger.llm import dialogue as D

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def plain_edits(codes, start=D.BEGIN, ends=(D.BEGIN, D.AFTER_A)):
    """The least (cost, audit) by trying every edit at every turn; at most three inserts in a row."""

    @lru_cache(None)
    def best(i, state, inserted):
        options = [(0, "")] if i == len(codes) and state in ends else []
        wanted, after = (D.A, D.AFTER_A) if state == D.AFTER_U else (D.U, D.AFTER_U)

        def take(cost, letter, rest):
            if rest:
                options.append((cost + rest[0], letter + rest[1]))

        if inserted < 3:
            take(2, "I", best(i, after, inserted + 1))
        if i < len(codes):
            role, cut = codes[i] & 3, bool(codes[i] & D.TRUNCATED)
            take(3, "D", best(i + 1, state, 0))
            if not codes[i] & (D.BLANK | D.DUPLICATE):
                take(cut + 2 * (role != wanted), "K" if role == wanted else "R", best(i + 1, after, 0))
                if role == D.S and state == D.BEGIN:
                    take(cut, "K", best(i + 1, D.AFTER_S, 0))
        return min(options, default=None)

    for i in range(len(codes), 0, -1):  # so that the recursion stays flat
        for state in range(4):
            best(i, state, 0)
    return best(0, start, 0)


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 1:
            text = ""
        elif kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain(rows):
    """{conv_id: the contract's columns}."""
    damaged = plain_damage(rows)
    out = {}
    for conv in {r[0] for r in rows}:
        turns = [r for r in damaged if r[0] == conv]
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))
        codes, seen = [], set()
        for _, _, role, text in turns:
            kept = text.rstrip(BLANKS)
            fault = D.BLANK if not kept else D.DUPLICATE if (role, text) in seen else D.TRUNCATED if kept[-1] not in ".!?" else 0
            seen.add((role, text))
            codes.append({"s": D.S, "u": D.U, "a": D.A}.get(role[:1], D.OTHER) + fault)
        known = [r[1] for r in turns if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        initials = "".join(r[2][:1] or "-" for r in turns)
        illegal = sum(initials[i : i + 2] not in ("su", "ua", "au") for i in range(len(turns) - 1))
        cost, audit = plain_edits(bytes(codes)) if turns else (0, "")
        left, repaired, wanted = list(turns), [], "user"
        for edit in audit:
            if edit == "I":
                role, text = wanted, ""
            else:
                _, _, role, text = left.pop(0)
                if edit == "D":
                    continue
                role = wanted if edit == "R" else role
            wanted = "assistant" if role[:1] == "u" else "user"
            repaired.append(f"{role}:{text}")
        faults = [sum(bool(c & f) for c in codes) for f in (D.BLANK, D.DUPLICATE, D.TRUNCATED)]
        out[conv] = (gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(repaired).encode()).hexdigest())
    return out


def messy_rows(seed=0, conversations=60):
    rng = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randrange(1, 12)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "ähm"])
            text = rng.choice(["Yes.", "No!", "Why?  \n", "cut off", "", " \t", None, f"Words {rng.randrange(9)}.", "é. \x0b"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), role, text))
    rows += [(None, 1, "user", "Hello."), (None, None, "assistant", "Hi."), (None, None, None, None)]
    rows += [(1000, None, "user", "A."), (1000, None, "user", "A.")]
    rows += [(2000, 5, "user", "Same."), (2000, 5, "assistant", "Same."), (2000, 5, "user", "Same.")]
    rows += [(conv, turn, "user", "Gone?") for conv in range(3000, 3030) for turn in (0,)]
    return rows + rows[:20]


def result(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = {r[0]: tuple(r[1:]) for r in D.op11_dialogue(table).collect()}
    return out


@pytest.mark.parametrize("seed", range(4))
def test_alignment_equals_all_edits(seed):
    rng = random.Random(seed)
    every = (D.BEGIN, D.AFTER_S, D.AFTER_U, D.AFTER_A)
    for _ in range(250):
        n = rng.randrange(9)
        codes = bytes(rng.choice([0, 1, 1, 2, 2, 3]) + rng.choice([0, 0, 0, 4, 8, 16]) for _ in range(n))
        assert min(D.align(codes).values()) == plain_edits(codes)
        paths = D.align(codes, every, every)
        for start in every:
            for end in every:
                assert paths.get((start, end)) == plain_edits(codes, start, (end,))
        a, b = sorted((rng.randrange(n + 1), rng.randrange(n + 1)))
        assert D.joined([D.align(x, every, every) for x in (codes[:a], codes[a:b], codes[b:])]) == plain_edits(codes)


def test_long_conversation_and_its_band():
    rng = random.Random(3)
    codes = bytes((1 + i % 2 if rng.random() > 0.1 else 1) + rng.choice([0] * 12 + [4, 8, 16]) for i in range(250) if rng.random() > 0.05)
    assert min(D.align(codes).values()) == plain_edits(codes)
    cells = sum(map(len, D.table(codes, D.A, D.greedy(codes, D.BEGIN))[1]))
    assert cells < len(codes) ** 2 / 2


def test_query_equals_plain(spark):
    rows = messy_rows()
    assert result(spark, rows) == plain(rows)


def test_conversations_of_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 3)
    rows = messy_rows(5, 20) + [(7, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(100, 200)]
    assert result(spark, rows) == plain(rows)


def test_repaired_turns(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (2, 0, "assistant", "x")]  # the second is deleted as a whole
    table = spark.createDataFrame(rows, SCHEMA)
    out = D.repaired(table, D.audited(table).select("conv_id", "audit")).collect()
    assert sorted((r.conv_id, r.number, r.role, r.text, r.edit) for r in out) == [(1, 0, "user", "A.", "K"), (1, 1, "assistant", "B.", "R")]


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA + ", cost string, audit string")
    assert D.op11_dialogue(empty).collect() == []
    long = "word " * 50_000 + "."
    rows = [(1, 0, "user", long), (1, 2, "assistant", long), (4, 1, None, None)]
    table = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA + ", code string, copy string")
    assert {r[0]: tuple(r[1:]) for r in D.op11_dialogue(table).collect()} == plain(rows)


def test_query_on_the_test_table(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r[1:]) for r in D.op11_dialogue(table).collect()} == plain(rows)
