"""Oracle SQL per query key, expanded to self-contained statements."""

from __future__ import annotations


def all_sql() -> dict[str, str]:
    from crownledger.oracle import layers, quality, relational, retrieval, rules, semantic, storage
    from crownledger.oracle.tables import with_tables

    out: dict[str, str] = {}
    for part in (layers, relational, quality, rules, semantic, retrieval, storage):
        out.update({key: with_tables(sql) for key, sql in part.SQL.items()})
    return out
