"""Sharding by a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of prime size: start, start + skip, ... modulo
the size. Shards take turns claiming their next free slot until the table is full, so that their numbers
of slots differ by one at most. When shards are added or removed, few slots change hands. A document's place
is one lookup of its id's hash: the table is of fixed size and broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crownledger.llm.text import whole_row

SLOTS = 65537  # prime, and over a hundred slots for each shard
SHARDS = tuple(f"shard-{n:03d}" for n in range(64))


def _number(name: str, what: str) -> int:
    return int.from_bytes(hashlib.sha256(f"{what}:{name}".encode()).digest()[:8], "big")


def filled(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """The owner of every slot, as a position in ``shards``; ``slots`` must be a prime above their number."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct, and there must be one")
    if slots < len(shards) or slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be a prime, not below the number of shards")
    at = [_number(s, "start") % slots for s in shards]
    skip = [1 + _number(s, "skip") % (slots - 1) for s in shards]
    owner, free = [-1] * slots, slots
    while True:
        for shard in range(len(shards)):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + skip[shard]) % slots
            owner[at[shard]] = shard
            free -= 1
            if not free:
                return owner


def slot_of(key: str | Column, slots: int = SLOTS) -> Column:
    """The slot of an id: 60 bits of its text's MD5 modulo the number of slots; null is the empty text."""
    column = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def placed(docs: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``docs`` with the columns slot and shard; columns of those names are replaced.

    Rows with equal ids go to one shard, null ids too. Nothing is shuffled.
    """
    owners = [(slot, shards[owner]) for slot, owner in enumerate(filled(shards, slots))]
    table = docs.sparkSession.createDataFrame(owners, "slot int, shard string")
    rows = docs.select(whole_row(docs, "slot", "shard"), slot_of(key, slots).alias("slot"))
    return rows.join(F.broadcast(table), "slot").select("row.*", "slot", "shard")


def write_shards(docs: DataFrame, path: str, key: str = "doc_id", shards: Sequence[str] = SHARDS, files: int = 1) -> None:
    """Write one folder per shard, each of about ``files`` files, whatever the number of input partitions."""
    out = placed(docs, key, shards)
    lane = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(files))
    out.repartition(len(shards) * files, "shard", lane).write.partitionBy("shard").parquet(path)


def op7_sharding(docs: DataFrame) -> DataFrame:
    return placed(docs.select("doc_id")).select("doc_id", "slot", "shard")


def _oracle() -> str:
    """The table spelled out as one string of two digits per slot."""
    owners = "".join(f"{n:02d}" for n in filled(SHARDS))
    return f"""
WITH placed AS (
  SELECT doc_id, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS})::INTEGER AS slot FROM documents
), owners AS (SELECT '{owners}' AS owner)
SELECT doc_id, slot, 'shard-0' || substr(owner, 2 * slot + 1, 2) AS shard FROM placed, owners
"""


ORACLE_SQL = _oracle()
