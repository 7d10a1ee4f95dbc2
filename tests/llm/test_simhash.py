import random
import re
import tracemalloc
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from crownledger.llm import components, likeness, simhash


def plain_print(text, width=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_groups(prints, radius=4):
    group = list(range(len(prints)))
    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius and group[i] != group[j]:
            group = [group[i] if g == group[j] else g for g in group]
    return group


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return Counter(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))) if words else Counter()


def plain_likeness(texts, similarity=0.8):
    """Groups of texts that are near by fingerprint, or alike by their shingles."""
    group = plain_groups([plain_print(t) for t in texts])
    held = [shingles(t) for t in texts]
    for i, j in combinations(range(len(texts)), 2):
        if group[i] != group[j] and min(held[i].total(), held[j].total()) >= similarity * max(held[i].total(), held[j].total()):
            a, b = held[i], held[j]
            if (a & b).total() >= similarity * (a | b).total():
                group = [group[i] if g == group[j] else g for g in group]
    return group


def test_near_copies_are_found_and_others_kept(spark):
    """Copies with one word in eighty changed go; texts of the same vocabulary and halves of others stay."""
    rng = random.Random(2)
    vocabulary = [f"w{int(rng.paretovariate(0.7)) % 5000}" for _ in range(20_000)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randrange(80, 400))] for _ in range(150)]
    docs, near, apart = [], [], []
    for i, words in enumerate(base):
        copy, other = list(words), list(words)
        for at in rng.sample(range(len(words)), len(words) // 80):
            copy[at] = f"new{rng.randrange(10**6)}"
        for at in rng.sample(range(len(words)), len(words) // 4):
            other[at] = f"new{rng.randrange(10**6)}"
        docs += [(3 * i, " ".join(words)), (3 * i + 1, " ".join(copy)), (3 * i + 2, " ".join(other))]
        near.append(3 * i + 1)
        apart += [3 * i, 3 * i + 2]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    kept = {r.doc_id for r in simhash.dedup(table).collect()}
    assert set(apart) <= kept
    assert sum(i not in kept for i in near) >= 0.95 * len(near)
    plain = {r.doc_id for r in simhash.dedup(table, similarity=None).collect()}
    assert sum(i not in plain for i in near) < 0.6 * len(near)  # what fingerprints of shingles alone find


def test_likeness_of_texts():
    assert likeness.similar(b"", b" ") == 1.0 and likeness.similar(b"", b"a") == 0.0 and likeness.similar(b"A b", b"a B") == 1.0
    assert likeness.similar(b"a b c d e f", b"a b c d e g") == pytest.approx(1 / 3)


@pytest.mark.parametrize("table", ["messy", "small"])
def test_contract_equals_brute_force(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    prints = [plain_print(r.text) for r in rows]
    groups = plain_groups(prints)
    least = {}
    for r, g in zip(rows, groups, strict=True):
        ids = [x for x in (least.get(g), r.doc_id) if x is not None]
        least[g] = min(ids) if ids else None
    want = sorted(((r.doc_id, f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, groups, strict=True)), key=repr)
    got = sorted((tuple(r) for r in simhash.op10_simhash(docs).collect()), key=repr)
    assert got == want


def test_no_rows(nothing):
    assert simhash.op10_simhash(nothing).count() == 0
    assert simhash.dedup(nothing).columns == nothing.columns


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_links_connect_all_near_fingerprints(spark, radius):
    rng = np.random.default_rng(7)
    base = [int(x) for x in rng.integers(0, 1 << 63, 12)]
    prints = set(base)
    for b in base:  # chains and bushes around each
        for _ in range(15):
            b ^= sum(1 << int(k) for k in rng.choice(64, int(rng.integers(1, 5)), replace=False))
            prints.add(b)
    prints = sorted(prints)
    table = spark.createDataFrame([(p if p < 1 << 63 else p - (1 << 64),) for p in prints], "fp long")
    links = simhash.links(table, radius)
    got = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in components.components(links).collect()}
    groups = plain_groups(prints, radius)
    for (a, g), (b, h) in combinations(zip(prints, groups, strict=True), 2):
        assert (got.get(a, a) == got.get(b, b)) == (g == h)


def test_hot_heads_are_split(spark, monkeypatch):
    """Many fingerprints under one head, and under one longer head: keys are split until few variants meet, and no link is lost."""
    rng = random.Random(5)
    head = 0xABCD << 48
    prints = {head | rng.getrandbits(48) for _ in range(600)} | {head | 0x1234 << 32 | rng.getrandbits(32) for _ in range(600)}
    for b in list(prints)[::3]:
        prints |= {b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(1, 5))) for _ in range(3)}
    prints = sorted(prints)
    table = spark.createDataFrame([(p if p < 1 << 63 else p - (1 << 64),) for p in prints], "fp long").repartition(4)
    groups = plain_groups(prints)
    monkeypatch.setattr(simhash, "HOT_VARIANTS", 100_000)
    hot = simhash.hot_keys(table, 2)
    assert head in hot[16] and head | 0x1234 << 32 in hot[32]
    got = {r.node & (1 << 64) - 1: r.root & (1 << 64) - 1 for r in components.components(simhash.links(table)).collect()}
    least = {}
    for p, g in zip(prints, groups, strict=True):
        least.setdefault(g, []).append(p)
    assert sorted(map(sorted, least.values())) == sorted(sorted(v) for v in by_root(prints, got).values())


def by_root(prints, roots):
    out = {}
    for p in prints:
        out.setdefault(roots.get(p, p), []).append(p)
    return out


def test_odd_radius_is_refused(spark):
    with pytest.raises(ValueError, match="even"):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_long_chains_hubs_and_cycles(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, i) for i in range(1001, 1200)]
    cycle = [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    odd = [(5, 5), (None, 7), (8, None), (1, 0), (0, 1)]
    links = spark.createDataFrame(chain + hub + cycle + odd, "a long, b long")
    got = {r.node: r.root for r in components.components(links).collect()}
    assert got == {**dict.fromkeys(range(1, 201), 0), **dict.fromkeys(range(1001, 1200), 1000), **dict.fromkeys(range(2001, 2050), 2000)}
    assert components.components(links.limit(0)).count() == 0


def test_dedup_keeps_one_row_of_each_group(messy):
    kept = simhash.dedup(messy)
    assert kept.columns == messy.columns
    rows, texts = kept.collect(), list({r.text or "" for r in messy.collect()})
    assert len(set(plain_likeness([r.text for r in rows]))) == len(rows) == len(set(plain_likeness(texts)))
    ids = [r.doc_id for r in rows]
    assert 1 in ids and not {2, 3, 5, 6} & set(ids) and 4 in ids and ids.count(12) == 1 and ids.count(None) == 1


def test_dedup_without_any_id(spark):
    docs = spark.createDataFrame([(None, "same words here"), (None, "same words here"), (None, "another text of words")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.dedup(docs).collect()) == ["another text of words", "same words here"]


def test_ids_of_any_kind(spark):
    docs = spark.createDataFrame([("b", "x y z"), ("a", "x y z"), ("c", "p q r")], "doc_id string, text string")
    got = {r.key: r.component for r in simhash.near_duplicates(docs, F.col("doc_id")).collect()}
    assert got == {"a": "a", "b": "a", "c": "c"}


def test_added_and_cut_copies_are_found(spark):
    """Copies with words appended, put before or cut off, alike by 0.8 to 0.9, all go."""
    rng = random.Random(3)
    docs, copies = [], []
    for i in range(60):
        words = [f"w{rng.randrange(20_000)}" for _ in range(rng.randrange(80, 500))]
        more = [f"new{rng.randrange(10**6)}" for _ in range(int(len(words) * rng.choice([0.1, 0.15, 0.2])))]
        copy = [words + more, more + words, words[len(more) :], words[: len(words) - len(more)]][i % 4]
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
        copies += [2 * i + 1] if likeness.similar(docs[-1][1].encode(), docs[-2][1].encode()) >= 0.8 else []
    kept = {r.doc_id for r in simhash.dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    assert len(copies) > 40 and not kept & set(copies)


def test_large_group_of_near_copies_without_their_origin(spark):
    """Every copy has a twentieth of its words changed, so that pairs lie about the threshold; components equal brute force."""
    rng = random.Random(6)
    base = [f"b{i}" for i in range(160)]
    texts = []
    for _ in range(120):
        copy = list(base)
        for at in rng.sample(range(160), rng.choice([1, 2, 3, 4])):
            copy[at] = f"new{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    passage = " ".join(f"p{i}" for i in range(60))  # in many texts that are else unlike
    texts += [f"{passage} " + " ".join(f"o{rng.randrange(10**5)}" for _ in range(rng.randrange(5, 40))) for _ in range(80)]
    kept = {r.doc_id for r in simhash.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)).collect()}
    least = {}
    for i, g in enumerate(plain_likeness(texts)):
        least.setdefault(g, i)
    assert kept == set(least.values()) and len(kept) < len(texts)


@pytest.mark.parametrize("seed", range(3))
def test_bitmaps_never_deny_shared_features(seed):
    rng = random.Random(seed)
    for _ in range(200):
        a = [f"w{rng.randrange(60)}" for _ in range(rng.randrange(1, 300))]
        b = list(a[rng.randrange(len(a)) :]) + [f"v{rng.randrange(60)}" for _ in range(rng.randrange(200))]
        x, y = (likeness.features(" ".join(t).encode()) for t in (a, b))
        shared = len(np.intersect1d(x, y))
        assert shared <= likeness.most_shared(len(x), likeness.bitmap(x), len(y), likeness.bitmap(y))
        counts = shingles(" ".join(a)), shingles(" ".join(b))
        assert shared == (counts[0] & counts[1]).total()


def test_copies_are_found_beside_an_unlike_text_of_the_same_words(spark):
    """Of texts with the same words, some are alike, but none is like the smallest or largest of all."""
    rng = random.Random(4)
    for n in range(3):
        words = [f"t{n}w{i}" for i in range(200)]
        turned = [words[:70] + words[68:200], words[:40] + words[20:200], words[30:] + words[:8], words[:150], words[25:175]]
        texts = [*turned, *(" ".join(rng.sample(words, 200)).split() for _ in range(3))]
        texts = list(dict.fromkeys(" ".join(t) for t in texts))
        kept = simhash.dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
        alike = [[likeness.similar(a.encode(), b.encode()) >= 0.8 for b in texts] for a in texts]
        group = plain_groups([plain_print(t) for t in texts])
        for i, j in combinations(range(len(texts)), 2):
            if alike[i][j] and group[i] != group[j]:
                group = [group[i] if g == group[j] else g for g in group]
        assert len(kept) == len(set(group)) < len(texts)


@pytest.mark.parametrize("partitions", ["12", "64"])
def test_keys_are_dealt_evenly_to_any_number_of_partitions(spark, partitions):
    """Keys have leading bits only; twelve partitions had them in three, sixty-four in one."""
    rng = np.random.default_rng(4)
    own = rng.integers(-(1 << 63), 1 << 63, 2000)
    near = own ^ (1 << rng.integers(0, 60, 2000))
    table = spark.createDataFrame([(int(x),) for x in [*own, *near]], "fp long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        used = simhash.links(table).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(used) == int(partitions)
    assert max(r["count"] for r in used) <= 2 * sum(r["count"] for r in used) / len(used)


def test_meetings_hold_little_more_than_the_variants():
    rng = np.random.default_rng(5)
    fps = np.full(900, 0x0123456789ABCDEF, np.uint64)
    for _ in range(3):
        fps ^= np.uint64(1) << rng.integers(0, 48, 900, dtype=np.uint64)
    fps = np.unique(fps)
    keys = fps & ~np.uint64((1 << 48) - 1)
    tracemalloc.start()
    a, b = simhash.meetings(keys, fps, 16, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(a) and (np.bitwise_count(a ^ b) <= 4).all() and (b < a).all()
    assert peak < 4 * 8 * simhash.ball(48, 2) * len(fps)


def test_new_links_contract_roots_only(spark, monkeypatch):
    rng = random.Random(6)
    first = [(rng.randrange(-300, 300), rng.randrange(-300, 300)) for _ in range(150)]
    later = [(rng.randrange(-300, 300), rng.randrange(-300, 400)) for _ in range(100)]
    table = lambda rows: spark.createDataFrame(rows, "a long, b long")
    roots = components.components(table(first))
    seen = []
    monkeypatch.setattr(components, "components", lambda links, f=components.components: f(seen.append(links) or links))
    got = sorted(tuple(r) for r in components.merged(roots, table(later)).collect())
    assert got == sorted(tuple(r) for r in components.components(table(first + later)).collect())
    children = {r.node for r in roots.collect()}
    assert not children & {x for r in seen[0].collect() for x in r}
    assert sorted(map(tuple, components.merged(roots, table(later).limit(0)).collect())) == sorted(map(tuple, roots.collect()))
