import gzip
import hashlib
import random

import pyarrow as pa
import pytest

from crownledger.llm import warc as R
from crownledger.session import work_folder

DATE = "2020-01-01T00:00:00Z"


def record(i, payload):
    return R.build("response", f"urn:x-page:{i}", f"http://a.example/{i} x", payload, hashlib.sha256(payload).hexdigest(), None, DATE)


def found(data):
    return list(R.salvage(pa.BufferReader(data), len(data)))


def covered(parts, size):
    at = 0
    for p in parts:
        if p.inner:  # of the same member as the one before
            continue
        assert p.offset == at
        at += p.length
    assert at == size


RNG = random.Random(5)
PAYLOADS = [RNG.randbytes(RNG.choice([0, 10, 3000, 400_000])) for _ in range(12)]
MEMBERS = [record(i, p) for i, p in enumerate(PAYLOADS)]
PLAIN = [gzip.decompress(m) for m in MEMBERS]


@pytest.mark.parametrize("pieces", [MEMBERS, PLAIN])
def test_whole_files_round_trip(pieces):
    data = b"".join(pieces)
    parts = found(data)
    covered(parts, len(data))
    assert [p.payload for p in parts] == PAYLOADS


@pytest.mark.parametrize("pieces", [MEMBERS, PLAIN])
@pytest.mark.parametrize("kind", ["flip", "cut", "zeros", "between", "begin", "tail"])
def test_damage_costs_only_the_record_it_hits(pieces, kind):
    hit = 5
    own = pieces[hit]
    half = len(own) // 2
    changed = {
        "flip": own[:half] + bytes([own[half] ^ 0x55]) + own[half + 1 :],
        "cut": own[:half],
        "zeros": own[:half] + bytes(len(own) - half),
        "between": b"junk \x1f\x8b\x08 WARC/1.1\r\n" + own,
        "begin": b"\0" * 8 + own[8:],
        "tail": own[:-3],
    }[kind]
    data = b"".join([*pieces[:hit], changed, *pieces[hit + 1 :]])
    parts = found(data)
    covered(parts, len(data))
    kept = [p.headers["warc-record-id"] for p in parts if isinstance(p, R.Record)]
    want = [f"<urn:x-page:{i}>" for i in range(len(pieces)) if i != hit or kind == "between"]
    assert kept == want
    gaps = [p for p in parts if isinstance(p, R.Gap)]
    assert len(gaps) == 1 and gaps[0].reason and gaps[0].offset == sum(map(len, pieces[:hit]))


def test_a_length_beyond_the_file_costs_one_record():
    """A damaged digit must neither fill the memory nor take the next record along."""
    bad = PLAIN[1].replace(b"Content-Length: ", b"Content-Length: 999999999", 1)
    for first in (bad, gzip.compress(bad), PLAIN[1].replace(b"Content-Length: ", b"Content-Length: " + b"9" * 30, 1)):
        data = first + PLAIN[2] + MEMBERS[3]
        parts = found(data)
        covered(parts, len(data))
        assert [p.payload for p in parts if isinstance(p, R.Record)] == PAYLOADS[2:4]
        assert [(p.offset, p.reason) for p in parts if isinstance(p, R.Gap)] == [(0, "length")]


def test_many_records_in_one_member(monkeypatch):
    monkeypatch.setattr(R, "READ", 1000)
    data = MEMBERS[0] + gzip.compress(b"".join(PLAIN[1:5])) + MEMBERS[5]
    parts = found(data)
    covered(parts, len(data))
    assert [p.payload for p in parts] == PAYLOADS[:6] and [p.inner for p in parts[2:5]] != [0, 0, 0]
    hurt = PLAIN[3][:200] + b"?" * 50 + PLAIN[3][250:]
    for middle in (b"lost words", hurt):
        packed = gzip.compress(PLAIN[1] + PLAIN[2] + middle + PLAIN[4])
        parts = found(MEMBERS[0] + packed + MEMBERS[5])
        assert [p.payload for p in parts if isinstance(p, R.Record)] == [PAYLOADS[i] for i in (0, 1, 2, 4, 5)]
        assert [(p.offset, p.inner) for p in parts if isinstance(p, R.Gap)] == [(len(MEMBERS[0]), len(PLAIN[1] + PLAIN[2]))]
    parts = found(gzip.compress(PLAIN[1] + b"tail that is none"))
    assert [type(p) for p in parts] == [R.Record, R.Gap]


def test_unpacking_holds_one_piece_at_a_time():
    """A member that swells is checked piece by piece; nothing of it is kept."""
    import tracemalloc

    bomb = gzip.compress(b"WARC/1.1\r\nContent-Length: 99999999999\r\n\r\n" + bytes(200 << 20), 1)
    tracemalloc.start()
    parts = found(bomb + MEMBERS[1])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [p.payload for p in parts if isinstance(p, R.Record)] == [PAYLOADS[1]] and peak < 20 << 20


def test_damage_across_reads_and_hopeless_files(monkeypatch):
    monkeypatch.setattr(R, "READ", 64)
    for pieces in (MEMBERS[:4], PLAIN[:4]):
        small = [p for p in pieces if len(p) < 5000]
        data = b"".join([small[0], b"?" * 1000, *small[1:]])
        parts = found(data)
        covered(parts, len(data))
        assert sum(isinstance(p, R.Record) for p in parts) == len(small)
    assert [(g.offset, g.length) for g in found(b"no archive at all" * 50)] == [(0, 850)]
    assert found(b"") == []


def test_read_back_logs_gaps(spark, tmp_path):
    path = tmp_path / "a.warc.gz"
    path.write_bytes(MEMBERS[0] + b"lost" * 10 + MEMBERS[1] + MEMBERS[2][:-20])
    rows = R.read_archives(spark.createDataFrame([(str(path),)], "uri string")).orderBy("offset").collect()
    assert [r.type for r in rows] == ["response", None, "response", None]
    assert [r.reason is None for r in rows] == [True, False, True, False]
    assert bytes(rows[2].payload) == PAYLOADS[1] and rows[2].target == "http://a.example/1%20x"


def plain(rows):
    out = []
    for page, html in rows:
        data = (html or "").encode()
        same = [p for p, h in rows if (h or "").encode() == data and p is not None]
        first = min(same) if same and len(data) >= 100 else None
        revisit = first is not None and first != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def test_contract_on_odd_pages(spark):
    long = "ü" * 60
    rows = [(3, long), (1, long), (2, long), (None, long), (4, None), (5, ""), (6, "short"), (7, "short"), (8, "x" * 99), (9, "x" * 99),
            (10, "y" * 100), (11, "y" * 100), (11, "y" * 100), (None, "z" * 100), (None, "z" * 100), (12, "w" * 3_000_000)]
    table = [(p, None if p == 6 else f"http://x/ {p}\r\n", h, 1, "e") for p, h in rows]
    pages = spark.createDataFrame(table, "page_id long, url string, html string, digest int, payload string").repartition(3)
    assert sorted((tuple(r) for r in R.op8_warc(pages).collect()), key=repr) == plain(rows)
    assert R.op8_warc(pages.limit(0)).count() == 0


def test_files_roll(spark, monkeypatch):
    pages = spark.createDataFrame([(i, "u", "h" * 50 + str(i)) for i in range(40)], "page_id long, url string, html string").coalesce(1)
    from crownledger.llm import files

    monkeypatch.setattr(files.Roller.__init__, "__defaults__", (1000,))
    folder = work_folder(spark)

    def run():
        roller = files.Roller(folder, ".x")
        for _ in range(30):
            roller.write(b"x" * 100)
        roller.close()
        return roller.closed

    closed = run()
    assert [c[1:] for c in closed] == [(1000, 10)] * 3
    assert R.write_archives(pages, work_folder(spark)).agg({"records": "sum"}).first()[0] == 40
