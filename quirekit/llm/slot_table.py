"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Slots of the production table, a prime; it bounds what is broadcast.
SLOTS = 65537
SHARDS = tuple(f"shard-{i:03d}" for i in range(64))


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill_table(shards: tuple[str, ...], slots: int = SLOTS) -> list[int]:
    """Shard (by place in ``shards``) of each slot: shards take turns, each claiming the next free slot it prefers.

    A shard's preference order steps through the prime-sized table from an offset by a skip, both hashes of its name.
    So shares differ by one slot at most, and when a shard comes or goes few other slots change hands.
    """
    if not shards or len(set(shards)) < len(shards) or slots < 2 or len(shards) > slots or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("distinct shards and a prime number of slots, no fewer than shards, are needed")
    at = [_number(f"{s}/offset") % slots for s in shards]
    skip = [_number(f"{s}/skip") % (slots - 1) + 1 for s in shards]
    table, left = [-1] * slots, slots
    while left:
        for k in range(len(shards)):
            while table[at[k]] >= 0:
                at[k] = (at[k] + skip[k]) % slots
            table[at[k]] = k
            left -= 1
            if not left:
                break
    return table


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of its md5 modulo ``slots``; a null key counts as the empty string."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")


def place(df: DataFrame, key: str, shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> DataFrame:
    """``df`` with ``slot`` and ``shard`` of each row's ``key``.

    The table has one row a slot, so its broadcast has a fixed size; rows aren't shuffled, and a hot key costs nothing but a
    full shard. Equal keys share a shard, null keys that of the empty string; repeated rows are placed alike; columns of those two
    names are replaced, others stay; an empty table stays empty.
    """
    spark = df.sparkSession
    text = ",".join(map(str, fill_table(shards, slots)))
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(text), ",")).alias("slot", "_k"))
    names = F.split(F.lit("\n".join(shards)), "\n")
    table = rows.select("slot", F.element_at(names, F.col("_k").cast("int") + 1).alias("shard"))
    return df.drop("slot", "shard").withColumn("slot", slot_of(F.col(key), slots)).join(F.broadcast(table), "slot")


def op10_slot_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` by id, over 64 shards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return place(docs.select("doc_id"), "doc_id").select("doc_id", "slot", "shard")


def oracle() -> str:
    """SQL with the table's rows as text."""
    text = ",".join(map(str, fill_table(SHARDS)))
    return f"""
WITH slots AS (SELECT unnest(string_split('{text}', ',')) AS k, unnest(range(0, {SLOTS})) AS slot)
SELECT doc_id, s.slot::INTEGER AS slot, 'shard-' || lpad(k, 3, '0') AS shard
FROM documents JOIN slots s ON s.slot = ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {SLOTS}
"""
