import hashlib
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crownledger.llm import secrets as S

KEYWORDS = S.automaton()
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def plain(text):
    text = text or ""
    found = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[0], S.ORDER[s[1]]))


def token(prefix, body="A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"):
    value, check = zlib.crc32(body.encode()), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        check = S.BASE62[digit] + check
    return f"{prefix}_{body}{check}"


PIECES = ["password", "passwd", "secret", "token", "api_key", "APIKEY", "Token", "AKIA", "akia", "=", ":", " ", "'", '"', "abcdef",
          "0123456789abcdef", "é", "ſ", "K", "ABCDEFGH12345678", "x", "\n", "-", "_", "="]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join))
def test_base_spans_equal_plain_patterns(text):
    assert [s for s in S.spans(text.encode(), KEYWORDS) if s[1] in S.BASE] == plain(text)


def test_checksums_decide():
    good, other = token("ghp"), token("npm")
    bad = good[:-1] + ("0" if good[-1] != "0" else "1")
    text = f"é {good} {bad} {other} {good}x"
    assert [(s[0], s[1]) for s in S.spans(text.encode(), KEYWORDS)] == [(2, "forge"), (2 + 2 * len(good) + 2, "registry")]


def test_private_keys():
    key = "-----BEGIN RSA PRIVATE KEY-----\nProc-Type: 4,ENCRYPTED\n\nMIIB+/=\n-----END RSA PRIVATE KEY-----"
    text = "x -----BEGIN PRIVATE KEY----- abc " + key + " -----BEGIN PUBLIC KEY-----"
    assert [s[1:] for s in S.spans(text.encode(), KEYWORDS)] == [("private_key", text.index(key) + len(key))]
    assert S.spans(b"-----BEGIN PRIVATE KEY-----" * 20_000, KEYWORDS) == []


@pytest.mark.parametrize("table", ["messy", "small"])
def test_contract(request, table):
    docs = request.getfixturevalue(table)
    want = []
    for r in docs.collect():
        base = plain(r.text)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, k, b in base).encode()).hexdigest()
        want.append((r.doc_id, *(sum(s[1] == k for s in base) for k in S.BASE), digest))
    got = S.op3_secrets(docs).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == sorted(want, key=repr)


def test_empty_table(nothing):
    assert S.op3_secrets(nothing).count() == 0 and S.scan(nothing).count() == 0


def test_scan_and_redact(spark):
    docs = spark.createDataFrame([(1, "é password=hunter22 end"), (2, None), (3, "AKIA" + "B" * 16)], "doc_id long, text string")
    assert {r.doc_id: [tuple(s) for s in r.spans] for r in S.scan(docs).collect()} == {1: [(2, "assign", 19)], 2: [], 3: [(0, "access", 20)]}
    assert {r.doc_id: r.text for r in S.redact(docs).collect()} == {1: "é [secret] end", 2: None, 3: "[secret]"}
