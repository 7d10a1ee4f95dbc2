"""Repair of conversations: the cheapest edits that make the roles alternate.

A conversation is legal if the initials of its roles read ``(s?(ua)+)?``. Its turns are aligned, by Wagner and Fischer's
table, to the alternating string of every length that can be reached. The tables of all lengths are one, if targets are counted from
their end: a cell (turn, letters left) holds the cheapest edits of the remaining turns. Only Ukkonen's band around the turns that
are left is filled; its width comes from the cost of a plain walk, the incumbent. The audits of all lengths with the
least cost are traced back and the first in ASCII order wins.

A conversation may hold any share of all turns. Turns are sorted by conversation and turn over all tasks, as narrow
rows, and cut into blocks of at most ``BLOCK`` turns. Where a conversation has one block, which is the rule, that block is aligned as it is. Where it has
more, every block is aligned from each state that the blocks before may leave to each it can leave itself, in any task, and the blocks'
best are joined in order; since an audit is never the beginning of another of equal cost and equal turns, the first
audits of the blocks make the first of the whole. What one task must hold of a conversation is a few bytes per turn, never its texts;
these are streamed through the task that hashes them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownledger.llm.text import kind_of, schema
from crownledger.sources.scratch import written

BLOCK = 512  # turns that are aligned in one table
INSERT, REROLE, DELETE, CUT = 2, 2, 3, 1
S, U, A, OTHER = range(4)  # a turn's role by its initial
BLANK, DUPLICATE, TRUNCATED = 4, 8, 16  # a turn's fault
BEGIN, AFTER_S, AFTER_U, AFTER_A = range(4)  # states between turns; nothing is kept yet, or the last that is
SPACES = "\t\n\x0b\x0c\r "
ROLES = {U: "user", A: "assistant"}
Best = tuple[int, str]


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that the checksum of ``conv_id:turn`` chooses; nulls are one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    return (
        rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
        .filter("kind != 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def cost_to_keep(code: int) -> int:
    return CUT * bool(code & TRUNCATED)


def greedy(codes: bytes, state: int) -> int:
    """The incumbent: what a plain walk costs, with inserts for any end.

    It keeps what fits; before a turn out of step it inserts one if the next turn goes on from there, else it gives the turn another role.
    """
    cost, wanted = 2 * INSERT, A if state == AFTER_U else U
    left = [c for c in codes if not c & (BLANK | DUPLICATE)]
    cost += DELETE * (len(codes) - len(left)) + sum(map(cost_to_keep, left))
    for i, code in enumerate(left):
        role = code & 3
        if role == S and state == BEGIN and i == 0:
            continue
        if role == wanted:
            wanted = U + A - wanted
            continue
        cost += INSERT
        if role in ROLES and i + 1 < len(left) and left[i + 1] & 3 == U + A - role:
            wanted = U + A - role
        else:
            wanted = U + A - wanted
    return cost


def table(codes: bytes, last: int, most: int) -> tuple[list[int], list[list[int]]]:
    """(lowest letter counts, costs) per turn: the cheapest edits of the turns from there on to so many letters ending in ``last``.

    Cells that cost more than ``most`` in all are left out: of the turns that need not go, each beyond the letters costs two
    more at least when it is deleted, each letter beyond the turns an insert.
    """
    n = len(codes)
    gone = [bool(c & (BLANK | DUPLICATE)) for c in codes]
    least = sum(DELETE if g else cost_to_keep(c) for c, g in zip(codes, gone, strict=True))
    width = max(1, (most - least) // 2 + 1)
    left = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        left[i] = left[i + 1] + (not gone[i])
    lows, costs = [max(0, x - width) for x in left], [[] for _ in range(n + 1)]
    far = 1 << 40
    costs[n] = [INSERT * r for r in range(width + 1)]
    other = U if last == A else A
    for i in range(n - 1, -1, -1):
        low, below, under = lows[i], costs[i + 1], lows[i + 1]
        size, code, row, before = left[i] + width - low + 1, codes[i], [], far
        cut, role = cost_to_keep(code), code & 3
        kept = (cut + REROLE * (role != other), cut + REROLE * (role != last))
        for r in range(low, low + size):
            at = r - under
            cost = below[at] + DELETE if 0 <= at < len(below) else far
            if before + INSERT < cost:
                cost = before + INSERT
            if r and not gone[i] and 0 <= at - 1 < len(below) and below[at - 1] + kept[r & 1] < cost:
                cost = below[at - 1] + kept[r & 1]
            row.append(cost)
            before = cost
        costs[i] = row
    return lows, costs


def cell(filled: tuple[list[int], list[list[int]]], i: int, r: int) -> int:
    at = r - filled[0][i]
    return filled[1][i][at] if 0 <= at < len(filled[1][i]) else 1 << 40


def trace(codes: bytes, filled: tuple[list[int], list[list[int]]], i: int, r: int, last: int) -> str:
    """The first audit, in ASCII order, of the cheapest edits from turn ``i`` on to ``r`` letters."""
    out = []
    while i < len(codes) or r:
        here = cell(filled, i, r)
        if i < len(codes) and cell(filled, i + 1, r) + DELETE == here:
            out.append("D")
            i += 1
        elif r and cell(filled, i, r - 1) + INSERT == here:
            out.append("I")
            r -= 1
        else:
            wanted = last if r & 1 else U if last == A else A
            out.append("K" if codes[i] & 3 == wanted else "R")
            i, r = i + 1, r - 1
    return "".join(out)


def align(codes: bytes, starts: tuple[int, ...] = (BEGIN,), ends: tuple[int, ...] = (BEGIN, AFTER_A)) -> dict[tuple[int, int], Best]:
    """(cost, audit) of the cheapest edits of the turns from each state to each: targets of every length."""
    n, out = len(codes), {}
    gone = (DELETE * n, "D" * n)
    letters = [i for i, c in enumerate(codes) if c & 3 == S and not c & (BLANK | DUPLICATE)]
    for start in starts:
        for end in ends:
            found: list[Best] = [gone] if start == end else []
            if end == AFTER_S and start == BEGIN:
                found += [(DELETE * (n - 1) + cost_to_keep(codes[i]), "D" * i + "K" + "D" * (n - 1 - i)) for i in letters]
            if end in (AFTER_U, AFTER_A):
                last = U if end == AFTER_U else A
                most = greedy(codes, start)
                filled = table(codes, last, most)
                first = A if start == AFTER_U else U
                parity = 1 if first == last else 0
                low, row = filled[0][0], filled[1][0]
                lengths = [(cost, r) for r, cost in enumerate(row, low) if r and r % 2 == parity]
                best = min((c for c, _ in lengths), default=1 << 40)
                headed = []
                if start == BEGIN:  # an s may be kept first
                    for i in letters:
                        head = DELETE * i + cost_to_keep(codes[i])
                        rests = [(head + cost, r) for r, cost in enumerate(filled[1][i + 1], filled[0][i + 1]) if r and r % 2 == parity]
                        headed += [(c, i, r) for c, r in rests]
                        best = min([best, *[c for c, _ in rests]])
                found += [(c, trace(codes, filled, 0, r, last)) for c, r in lengths if c == best]
                found += [(c, "D" * i + "K" + trace(codes, filled, i + 1, r, last)) for c, i, r in headed if c == best]
            if found:
                out[start, end] = min(found)
    return out


def joined(parts: list[dict[tuple[int, int], Best]]) -> Best:
    """The cheapest of the whole conversation from its blocks', ending legally."""
    at: dict[int, Best] = {BEGIN: (0, "")}
    for part in parts:
        after: dict[int, Best] = {}
        for (start, end), (cost, audit) in part.items():
            if start in at:
                new = (at[start][0] + cost, at[start][1] + audit)
                if end not in after or new < after[end]:
                    after[end] = new
        at = after
    return min(at[s] for s in (BEGIN, AFTER_A) if s in at)


def legal(first: int, second: int) -> bool:
    return (first, second) in ((S, U), (U, A), (A, U))


def same(a: str, b: str, *columns: str) -> Column:
    """Equal in all columns; nulls are equal."""
    out = F.lit(True)
    for c in columns:
        out &= F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


ORDER = ("conv_id", "turn", "role", "digest")


def marked(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, code): every turn without its text; the digest stands for it."""
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", S).when(initial == "u", U).when(initial == "a", A).otherwise(OTHER)
    fault = F.when(end == "", BLANK).when(~end.isin(".", "!", "?"), TRUNCATED).otherwise(0)
    return rows.select("conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("digest"), (role + fault).alias("code"))


def ordered_blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, part, block, codes): every conversation's turns in blocks, with all faults marked.

    A turn is a duplicate if an earlier one has its role and text; the first of each is the least place in a partial aggregate.
    """
    out = schema(conv_id=kind_of(turns, "conv_id"), role="string", digest="string", code="long", part="long", place="long")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            own = [batch.column(i) for i in range(3)] + [batch.column(3).cast(pa.int64())]
            yield pa.RecordBatch.from_arrays([*own, pa.array([part] * n, pa.int64()), pa.array(range(place, place + n), pa.int64())], out.names)
            place += n

    ranged = turns.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).select("conv_id", "role", "digest", "code")
    numbered = written(ranged.mapInArrow(number, out))
    at = F.struct("part", "place")
    firsts = numbered.groupBy("conv_id", "role", "digest").agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    on = same("t", "f", "conv_id", "role", "digest")
    again = (F.col("first").isNotNull() & (F.struct("part", "place") > F.col("first")) & (F.col("code").bitwiseAND(BLANK) == 0))
    code = F.when(again, F.col("code").bitwiseAND(3) + DUPLICATE).otherwise(F.col("code"))
    flagged = numbered.alias("t").join(firsts.alias("f"), on, "left").select("t.conv_id", "part", "place", code.alias("code"))
    # the codes of a block, in order, as one string of digits
    held = F.transform(F.array_sort(F.collect_list(F.struct("place", "code"))), lambda x: F.chr(x["code"] + 48))
    return flagged.groupBy("conv_id", "part", (F.floor(F.col("place") / BLOCK)).alias("block")).agg(F.concat_ws("", held).alias("codes"))


def audited(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) per conversation of ``rows``.

    Turns are taken in order of turn, nulls first; turns that tie are taken by role, then by the MD5 of their text.
    """
    turns = marked(rows)
    kind = kind_of(rows, "conv_id")
    blocks = written(ordered_blocks(turns))
    several = blocks.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("conv_id", F.lit(True).alias("many"))
    known = blocks.alias("b").join(several.alias("s"), same("b", "s", "conv_id"), "left")
    known = known.select("b.conv_id", F.struct("part", "block").alias("at"), "codes", F.coalesce("many", F.lit(False)).alias("many"))
    paths = "array<struct<start: bigint, stop: bigint, cost: bigint, audit: string>>"
    faults = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), "long")
    out = schema(conv_id=kind, at="struct<part: bigint, block: bigint>", first="long", last="long", **faults, paths=paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns: list[list] = [[] for _ in out.names[2:]]
            for text, many in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                codes = bytes(ord(c) - 48 for c in text)
                roles = [c & 3 for c in codes]
                every = (BEGIN, AFTER_S, AFTER_U, AFTER_A)
                found = align(codes, every, every) if many else align(codes)
                values = [roles[0], roles[-1], *[sum(bool(c & f) for c in codes) for f in (BLANK, DUPLICATE, TRUNCATED)]]
                values.append(sum(not legal(x, y) for x, y in zip(roles, roles[1:], strict=False)))
                values.append([{"start": a, "stop": b, "cost": c, "audit": t} for (a, b), (c, t) in found.items()])
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            types = [pa.int64()] * 6 + [pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())]))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], out.names)

    aligned = known.mapInArrow(run, out)
    parts = F.array_sort(F.collect_list(F.struct("at", "first", "last", "paths"))).alias("parts")
    sums = [F.sum(c).alias(c) for c in faults]
    gathered = aligned.groupBy("conv_id").agg(*sums, parts)
    final = schema(conv_id=kind, **faults, cost="long", audit="string")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs, audits, edges = [], [], []
            for value in batch.column(5):
                own = value.as_py()
                edges.append(sum(not legal(x["last"], y["first"]) for x, y in zip(own, own[1:], strict=False)))
                cost, audit = joined([{(p["start"], p["stop"]): (p["cost"], p["audit"]) for p in x["paths"]} for x in own])
                costs.append(cost)
                audits.append(audit)
            illegal = [x + y for x, y in zip(batch.column(4).to_pylist(), edges, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(4)], pa.array(illegal, pa.int64()), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], final.names)

    whole = gathered.mapInArrow(join, final)
    once = turns.groupBy("conv_id", "turn").agg(F.lit(1).alias("one"))
    spans = once.groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    both = whole.alias("w").join(spans.alias("s"), same("w", "s", "conv_id"))
    return both.select("w.conv_id", "gaps", *faults, "cost", "audit")


def repaired(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, number, role, text, edit) of the conversations after the edits of their audits, in order within every partition.

    Each conversation's turns are streamed behind its audit; a task holds one turn at a time.
    """
    kind = kind_of(rows, "conv_id")
    names = ["conv_id", "first", "turn", "role", "digest", "text"]
    texts = rows.select("conv_id", F.lit(1).alias("first"), "turn", "role", F.md5(F.col("text").cast("binary")).alias("digest"), "text")
    none = F.lit(None)
    heads = audits.select("conv_id", F.lit(0).alias("first"), none.cast(kind_of(rows, "turn")).alias("turn"), none.cast("string").alias("role"),
        none.cast("string").alias("digest"), F.col("audit").alias("text"))
    dealt = heads.union(texts).repartition("conv_id").sortWithinPartitions(*names[:5]).select("conv_id", "first", "role", "text")
    out = schema(conv_id=kind, number="long", role="string", text="string", edit="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, at, number, wanted = "", 0, 0, U

        def insert(key: object, held: list[tuple]) -> None:
            nonlocal at, number, wanted
            while edits[at : at + 1] == "I":
                held.append((key, number, ROLES[wanted], "", "I"))
                at, number, wanted = at + 1, number + 1, U + A - wanted

        key = None
        for batch in batches:
            held: list[tuple] = []
            for conv, first, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if not first:
                    key, edits, at, number, wanted = conv, text, 0, 0, U
                    insert(key, held)
                    continue
                edit = edits[at]
                at += 1
                if edit != "D":
                    held.append((key, number, role if edit == "K" else ROLES[wanted], text, edit))
                    wanted = U if edit == "K" and role[:1] == "s" else U + A - wanted
                    number += 1
                insert(key, held)
            columns = list(zip(*held, strict=True)) if held else [()] * 5
            types = [batch.column(0).type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], out.names)

    return dealt.mapInArrow(run, out)


def digests(turns: DataFrame) -> DataFrame:
    """(conv_id, sha256) of the turns' ``role:text``, joined by newlines, for rows as :func:`repaired` gives them."""
    out = schema(conv_id=kind_of(turns, "conv_id"), sha256="string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha = None, None
        for batch in batches:
            done = []
            for conv, number, role, text in zip(*[batch.column(i).to_pylist() for i in range(4)], strict=True):
                if number == 0:
                    if sha is not None:
                        done.append((key, sha.hexdigest()))
                    key, sha = conv, hashlib.sha256()
                sha.update(f"{chr(10) if number else ''}{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], t) for i, t in enumerate((batch.column(0).type, pa.string()))], out.names)
            kind = batch.column(0).type
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], kind), pa.array([sha.hexdigest()])], out.names)

    return turns.select("conv_id", "number", "role", "text").mapInArrow(run, out)


def op11_dialogue(conversations: DataFrame) -> DataFrame:
    """The contract's columns per original conversation, a null conv_id being one of its own.

    Null roles and texts are one space, so such turns have no legal role or are blank. Repeated rows are turns of their own, the later ones
    duplicates. A conversation without a turn after the damage has zeros, no audit and the hash of nothing; an empty table gives no rows.
    """
    rows = damaged(conversations)
    audits = written(audited(rows))
    hashes = digests(repaired(rows, audits.select("conv_id", "audit")))
    every = conversations.select("conv_id").distinct()
    found = every.alias("e").join(audits.alias("a"), same("e", "a", "conv_id"), "left").join(hashes.alias("h"), F.col("e.conv_id").eqNullSafe(F.col("h.conv_id")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(
        "e.conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
