import hashlib
from collections import Counter

import pytest

from crownledger.llm import sharding as S


def plain_table(shards, slots):
    """Every shard's whole permutation first, then claims in turns."""
    orders = []
    for s in shards:
        start = int.from_bytes(hashlib.sha256(f"start:{s}".encode()).digest()[:8], "big") % slots
        skip = int.from_bytes(hashlib.sha256(f"skip:{s}".encode()).digest()[:8], "big") % (slots - 1) + 1
        orders.append(iter([(start + j * skip) % slots for j in range(slots)]))
    owner = {}
    while len(owner) < slots:
        for n, order in enumerate(orders):
            if len(owner) < slots:
                owner[next(x for x in order if x not in owner)] = n
    return [owner[i] for i in range(slots)]


@pytest.mark.parametrize(("n", "slots"), [(1, 2), (3, 7), (7, 7), (10, 1009)])
def test_table_equals_whole_permutations(n, slots):
    shards = [f"s{i}" for i in range(n)]
    table = S.filled(shards, slots)
    assert table == plain_table(shards, slots)
    counts = Counter(table)
    assert len(counts) == n and max(counts.values()) - min(counts.values()) <= 1


def test_few_slots_move_when_a_shard_leaves():
    shards = [f"s{i}" for i in range(20)]
    before, after = S.filled(shards, 10007), S.filled(shards[:-1], 10007)
    moved = sum(a != b for a, b in zip(before, after, strict=True)) / 10007
    assert moved < 0.15  # a twentieth must move


@pytest.mark.parametrize(("shards", "slots"), [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_wrong_tables_are_refused(shards, slots):
    with pytest.raises(ValueError):
        S.filled(shards, slots)


@pytest.mark.parametrize("table", ["messy", "small"])
def test_places_equal_plain_hashing(request, table):
    docs = request.getfixturevalue(table)
    owners = S.filled(S.SHARDS)
    got = S.placed(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % S.SLOTS
        assert (r.slot, r.shard) == (slot, S.SHARDS[owners[slot]])
    assert [c for c in S.placed(docs).columns if c not in ("slot", "shard")] == [c for c in docs.columns if c not in ("slot", "shard")]


def test_empty_table(nothing):
    assert S.placed(nothing).count() == 0 and S.op7_sharding(nothing).columns == ["doc_id", "slot", "shard"]


def test_written_shards_hold_all_rows(spark, small, tmp_path):
    S.write_shards(small, str(tmp_path / "out"), shards=["a", "b", "c"], files=2)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.doc_id for r in back.collect()) == sorted(r.doc_id for r in small.collect())
    want = {r.doc_id: r.shard for r in S.placed(small, shards=["a", "b", "c"]).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == want
