import random

import numpy as np
import pytest

from crownledger.llm import tokens as K
from crownledger.session import work_folder


def plain(ids, end, trailer):
    """(place, tokens, trailer) by walking over the file."""
    out, begin = [], 0
    for i, x in enumerate(ids):
        if x == end:
            out.append((i, i - begin - trailer, ids[i - trailer : i]))
            begin = i + 1
    return out, len(ids) - begin


def write(tmp_path, name, ids):
    path = tmp_path / name
    path.write_bytes(np.array(ids, "<u2").tobytes())
    return str(path)


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
@pytest.mark.parametrize("trailer", [0, 2])
def test_blocks_equal_a_walk(spark, tmp_path, block, trailer):
    rng = random.Random(block)
    files = {}
    for n in range(6):
        ids = []
        for _ in range(rng.randrange(9)):
            ids += [rng.randrange(1, 9) for _ in range(rng.choice([0, 1, 5, 30]) + trailer)] + [0]
        files[write(tmp_path, f"f{n}", ids + [5] * (3 * (n % 2)))] = ids + [5] * (3 * (n % 2))
    table = K.token_files(spark, str(tmp_path))
    got = K.count_tokens(table, 0, trailer, block).collect()
    for path, ids in files.items():
        ended, rest = plain(ids, 0, trailer)
        own = sorted((r.place, r.n_tokens, r.trailer) for r in got if r.uri.endswith(path) and r.ended)
        assert own == ended
        assert [r.n_tokens for r in got if r.uri.endswith(path) and not r.ended] == [rest] * (rest > 0)


def test_odd_files_are_refused(spark, tmp_path):
    (tmp_path / "odd").write_bytes(b"abc")
    with pytest.raises(Exception, match="odd number of bytes"):
        K.count_tokens(K.token_files(spark, str(tmp_path))).collect()


@pytest.mark.parametrize("value", [None, 0, 1, -1, 2**63 - 1, -(2**63), 123456789012345])
def test_ids_survive_the_trailer(spark, value):
    digits = K.id_trailer(value)
    assert len(digits) == K.ID_DIGITS and all(0 <= d < K.SEPARATOR for d in digits)
    row = spark.createDataFrame([(digits,)], "trailer array<int>").select(K.trailer_id().alias("id")).first()
    assert row.id == value


@pytest.mark.parametrize("table", ["messy", "small"])
def test_counts_equal_direct_encoding(request, spark, table):
    docs = request.getfixturevalue(table)
    encoder = K.encoding()
    want = sorted(((r.doc_id, len(encoder.encode_ordinary(r.text or ""))) for r in docs.collect()), key=repr)
    assert sorted((tuple(r) for r in K.op2_tokens(docs).collect()), key=repr) == want
    files = K.write_tokens(docs, work_folder(spark))
    stitched = K.count_tokens(files, trailer=K.ID_DIGITS, block=64).select(K.trailer_id().alias("doc_id"), "n_tokens")
    assert sorted((tuple(r) for r in stitched.collect()), key=repr) == want


def test_no_documents(nothing):
    assert K.op2_tokens(nothing).count() == 0
