"""Placement of rows on shards by a permutation-filled lookup table, in SQL functions only.

Every shard has an order of preference over the slots of a table of prime size: an offset and a step, both from a digest
of its name. Shards take turns and each claims its first free slot, until all slots are taken, so shares differ by one slot
per turn of weight, and a shard that goes or comes moves few slots that are not its own. A row's slot is a digest of
its key modulo the size; the table is broadcast (it has ``size`` rows whatever the data) and placement takes constant time.

A shard of weight w takes w turns where one of weight 1 takes one. Defined results: a null key has the slot of the empty
key; equal keys share a shard; repeated rows are placed alike; an empty table gives an empty result; all columns stay.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 65537
MOST_SHARDS = SIZE // 16


def _digest(name: str, use: str) -> int:
    return int(hashlib.md5(f"{use}:{name}".encode()).hexdigest()[:15], 16)


def lookup_table(shards: dict[str, int], size: int = SIZE) -> list[str]:
    """The shard of every slot. ``shards`` maps names to positive weights; ``size`` must be prime and exceed their number."""
    if size < 2 or any(size % d == 0 for d in range(2, int(size ** 0.5) + 1)):
        raise ValueError("size must be prime")
    if not shards or min(shards.values()) < 1 or len(shards) > size:
        raise ValueError("there must be between 1 and size shards, with positive weights")
    names = sorted(shards)
    slot = {n: _digest(n, "offset") % size for n in names}
    step = {n: _digest(n, "skip") % (size - 1) + 1 for n in names}
    table: list[str | None] = [None] * size
    free = size
    while free:
        for name in names:
            for _ in range(shards[name]):
                if not free:
                    break
                while table[slot[name]] is not None:
                    slot[name] = (slot[name] + step[name]) % size
                table[slot[name]] = name
                free -= 1
    return table


def slot_of(key: Column, size: int = SIZE) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(size).cast("long"))


def slots(spark: SparkSession, table: list[str]) -> DataFrame:
    """(slot, shard) of a lookup table."""
    names = sorted(set(table))
    number = {n: str(i) for i, n in enumerate(names)}
    rows = spark.range(1).select(F.posexplode(F.split(F.lit(",".join(number[n] for n in table)), ",")).alias("slot", "n"))
    return rows.select(F.col("slot").cast("long").alias("slot"), F.element_at(F.array(*map(F.lit, names)), F.col("n").cast("int") + 1).alias("shard"))


def assign(rows: DataFrame, key: Column, shards: dict[str, int], size: int = SIZE) -> DataFrame:
    """``rows`` with slot and shard in front; its other columns may have any name but these two."""
    places = F.broadcast(slots(rows.sparkSession, lookup_table(shards, size)))
    return (rows.select(slot_of(key, size).alias("s"), F.struct("*").alias("row")).join(places, F.col("s") == F.col("slot"))
            .select("slot", "shard", "row.*"))


def write_shards(rows: DataFrame, key: Column, shards: dict[str, int], path: str, files_per_shard: int = 8, size: int = SIZE) -> None:
    """One folder per shard; a shard's rows are spread over ``files_per_shard`` tasks, so no task has a whole shard."""
    placed = assign(rows, key, shards, size)
    placed.repartition(files_per_shard * len(shards), "shard", F.pmod(F.col("slot"), F.lit(files_per_shard))).write.partitionBy("shard").parquet(path)
