"""Sharding by a permutation-filled lookup table.

Each shard walks the slots of a table of prime size in an order of its own (an offset and a step from hashes of its name);
the shards take turns and each claims the next free slot of its order. A row's key hashes to a slot, and a broadcast of
the table (its size is the parameter `slots`, 65,537 rows at most by default) gives the shard in constant time. The shares
of the shards differ by at most one slot, and taking a shard away moves few keys but its own.

Native: the table is filled once on the driver from parameters alone (never from data) and enters as one SQL literal; all
else is DataFrame functions. Rows are placed where they are, without a shuffle, so hot keys cost nothing more here. A hot
key sends all its rows to one shard, as it must; `spread` deals the rows of each key over so many virtual keys instead.

Defined results: a null key is placed like the empty string. Equal keys get equal shards. Columns of the input named slot
or shard are replaced.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import free_name

SLOTS = 65_537
SHARDS = [f"shard-{i:03d}" for i in range(48)]


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def fill(shards: list[str], slots: int = SLOTS) -> list[int]:
    """The lookup table: for each slot the index of its shard. slots must be a prime and not under the number of shards."""
    if not shards or len(set(shards)) != len(shards) or slots < len(shards):
        raise ValueError("shards must be distinct names, at least one and at most as many as slots")
    if slots < 2 or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime")
    at = [_number(f"offset:{s}") % slots for s in shards]
    step = [_number(f"step:{s}") % (slots - 1) + 1 for s in shards]
    table, left = [-1] * slots, slots
    while left:
        for i in range(min(len(shards), left)):
            while table[at[i]] >= 0:
                at[i] = (at[i] + step[i]) % slots
            table[at[i]] = i
            left -= 1
    return table


def lookup(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """(slot long, shard string), one row for each slot."""
    listed = ",".join(map(str, fill(shards, slots)))
    names = F.split(F.lit("\n".join(shards)), "\n")
    return spark.range(1).select(F.posexplode(F.split(F.lit(listed), ",")).alias("slot", "i")).select(
        F.col("slot").cast("long").alias("slot"), F.get(names, F.col("i").cast("int")).alias("shard")
    )


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, 15)
    return F.conv(digest, 16, 10).cast("long") % slots


def shard(
    df: DataFrame, key: str = "doc_id", shards: list[str] = SHARDS, slots: int = SLOTS, spread: int = 1, spread_by: str | None = None
) -> DataFrame:
    """df with slot and shard. With spread over 1, a row's key is followed by hash(spread_by) mod spread."""
    value = F.coalesce(F.col(key).cast("string"), F.lit(""))
    if spread > 1:
        value = F.concat(value, F.lit("#"), F.pmod(F.xxhash64(F.col(spread_by or key)), F.lit(spread)).cast("string"))
    kept = df.drop("slot", "shard")
    wanted = free_name(kept, "_slot")
    table = lookup(df.sparkSession, shards, slots).withColumnRenamed("slot", wanted)
    out = df.withColumn(wanted, slot_of(value, slots)).drop("slot", "shard").join(F.broadcast(table), wanted, "left")
    return out.withColumn("slot", F.col(wanted)).drop(wanted)
