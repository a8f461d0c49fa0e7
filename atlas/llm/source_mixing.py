"""A corpus mixed from its sources by target weights, in SQL functions only.

The words of a source, document after document, are one stream, cut into blocks of fixed length. Targets come from weights;
none is over ``most`` times its source's size, and what such sources leave is shared again by weight. A source fills as
many slots of the mix as its target needs: whole passes over its blocks, then part of one more pass, whose last slot takes
only the words still due, so a source contributes its target to the word, however small it is.

The slots of the mix lie in output shards of ``shard`` slots. One pseudorandom permutation over all slots deals the sources'
slots to places, so the source counts of the shards are multinomial draws given the sources' totals (drawn without this
condition, small sources would miss their targets). Within a source, slot j of a pass takes the block that the source's own
permutation for this pass gives for j. Permutations are swap-or-not networks: any index is computed on its own, for any number of
blocks, without a sort or a table. Blocks then meet slots in an equi-join on (source, block).

Running totals are sums within range partitions plus the totals of the partitions before, so neither a large source nor a
large number of sources is gathered in one task.

Words are runs of characters other than space and 0x09-0x0D. Defined results: a null text has no words; a null source is a
source of its own, after all others, apart from one named by the empty string; documents without words are returned and
nothing is taken; repeated rows are documents of their own; null ids come first in a source's stream; an empty table gives an
empty result; further columns are ignored. The result depends on the rows, ``seed`` and the parameters only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlas.llm.common import let, staged

WEIGHTS, MOST = (1, 2, 3), 3
BLOCK, SHARD = 1024, 256   # words a block, slots an output shard
RUN = 1 << 12   # slots of one source that are listed together
TASK_SLOTS, MOST_TASKS = 1 << 14, 20_000   # slots a task works out, until there are so many tasks
ROUNDS, SEED = 24, 1
PRIME = 2147483647


def number_of(text: Column) -> Column:
    """28 bits of a text."""
    return F.conv(F.substring(F.md5(text), 1, 7), 16, 10).cast("long")


def div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, b if isinstance(b, Column) else F.lit(b).cast("long"))


def long(n: int) -> Column:
    return F.lit(n).cast("long")


def permuted(x: Column, n: Column, seed: Column, inverse: bool = False) -> Column:
    """The place of ``x`` in a pseudorandom permutation of 0 … n - 1.

    Every round pairs each index with another one and swaps the pair or not, by a bit that both share.
    """
    def turn(at: Column, turn_number: Column) -> Column:
        def swapped(key: Column) -> Column:
            partner = ((key * (PRIME + 1) + key * 48271 % PRIME) % n + n - at) % n
            upper = F.greatest(at, partner)
            mixed = let((upper % PRIME * 16807 + div(upper, PRIME) * 40503 + key) % PRIME, lambda z: z * z % PRIME)
            return F.when(div(mixed, 128) % 2 == 1, partner).otherwise(at)

        return let(let((seed + turn_number * 1000003) % PRIME, lambda z: z * z % PRIME), swapped)

    turns = F.sequence(long(ROUNDS - 1), long(0), long(-1)) if inverse else F.sequence(long(0), long(ROUNDS - 1))
    return F.aggregate(turns, x.cast("long"), turn)


def running_total(rows: DataFrame, group: Sequence[str], order: Sequence[str], value: Column, name: str) -> DataFrame:
    """``rows`` with ``name``, the sum of ``value`` over the earlier rows of the group; equal rows stand next to each other."""
    laid = staged(rows.withColumn("value", value).repartitionByRange(*group, *order).withColumn("part", F.spark_partition_id()), name)
    parts = laid.groupBy("part", *group).agg(F.sum("value").alias("here"))
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)   # one row per partition and group
    parts = parts.select("part", *group, F.coalesce(F.sum("here").over(earlier), long(0)).alias("until"))
    inside = Window.partitionBy("part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (laid.withColumn("inside", F.coalesce(F.sum("value").over(inside), long(0))).join(parts, ["part", *group])
            .withColumn(name, F.col("until") + F.col("inside")).drop("value", "part", "until", "inside"))


def water_level(sources: DataFrame, most: int = MOST) -> float:
    """Words per unit of weight, so that the targets, none over ``most`` sizes, add up to all words.

    Sources under the level are full; each look at the sums fills more of them and raises the level, until none is added.
    """
    full = F.col("source_size") * most
    total, weights = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level, known = (total / weights if weights else 0.0), -1
    while True:
        over = full < F.lit(float(level)) * F.col("weight")
        filled, open_, count = sources.agg(F.coalesce(F.sum(F.when(over, full)), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
                                           F.count(F.when(over, 1))).first()
        if count == known or not open_:
            return float(level)
        level, known = (total - filled) / open_, count


def plan(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """One row per source: sizes, target, and the slots it fills, from ``start`` on."""
    sizes = staged(sized.groupBy("key").agg(F.sum("size").alias("source_size")), "sizes")
    ranked = running_total(sizes.withColumn("all", F.lit(0)), ["all"], ["key"], long(1), "rank")
    sources = staged(ranked.withColumn("weight", F.element_at(F.array(*map(long, weights)), (F.col("rank") % len(weights) + 1).cast("int"))), "weights")
    sources = (sources.withColumn("target", F.least((F.col("source_size") * most).cast("double"), F.lit(water_level(sources, most)) * F.col("weight")))
               .withColumn("want", F.round("target").cast("long")).withColumn("blocks", div(F.col("source_size") + (block - 1), block))
               .withColumn("last", F.col("source_size") - (F.col("blocks") - 1) * block))
    some = F.col("source_size") > 0
    sources = (sources.withColumn("passes", F.when(some, div(F.col("want"), F.col("source_size"))).otherwise(long(0)))
               .withColumn("due", F.col("want") - F.col("passes") * F.col("source_size"))
               .withColumn("seed", number_of(F.concat(F.lit(f"{seed}:"), F.col("key"))))
               .withColumn("last_at", F.when(some, permuted(F.col("blocks") - 1, F.col("blocks"), F.col("seed") + F.col("passes"), inverse=True))))
    plain = div(F.col("due") + (block - 1), block)
    short = (F.col("last_at") < plain) & (plain * block - (block - F.col("last")) < F.col("due"))
    sources = sources.withColumn("slots", F.coalesce(F.col("passes") * F.col("blocks") + plain + F.when(short, long(1)).otherwise(long(0)), long(0)))
    return staged(running_total(sources, ["all"], ["key"], F.col("slots"), "start").drop("all"), "plan")


def draws(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> DataFrame:
    """(shard, slot, key, block, pass, take): every slot of the mix with its block and the number of words it takes from the block's start."""
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    every, tasks = long(total), min(total // TASK_SLOTS + 1, MOST_TASKS)
    runs = sources.where("slots > 0").withColumn("run", F.explode(F.sequence(long(0), div(F.col("slots") - 1, RUN)))).repartition(tasks, "key", "run")
    each = runs.withColumn("j", F.explode(F.sequence(F.col("run") * RUN, F.least(F.col("slots"), (F.col("run") + 1) * RUN) - 1)))
    number, seat = div(F.col("j"), F.col("blocks")), F.col("j") % F.col("blocks")
    found = each.select("key", "start", "j", "blocks", "last", "passes", "due", "last_at", number.alias("pass"), seat.alias("seat"),
                        permuted(seat, F.col("blocks"), F.col("seed") + number).alias("block"))
    length = F.when(F.col("block") == F.col("blocks") - 1, F.col("last")).otherwise(long(block))
    before = F.col("seat") * block - F.when(F.col("last_at") < F.col("seat"), block - F.col("last")).otherwise(long(0))
    take = F.when(F.col("pass") < F.col("passes"), length).otherwise(F.least(length, F.col("due") - before))
    place = permuted(F.col("start") + F.col("j"), every, number_of(F.lit(f"{seed}:places")))
    return (found.select("key", "block", "pass", take.alias("take"), length.alias("length"), place.alias("place"))
            .select(div(F.col("place"), shard).alias("shard"), (F.col("place") % shard).alias("slot"), "key", "block", "pass", "take", "length"))


def sizes(documents: DataFrame) -> DataFrame:
    """(key, doc_id, hash, size); keys sort like sources, with null last."""
    key = F.when(F.col("source").isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col("source")))
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    return documents.select(key.alias("key"), "doc_id", F.xxhash64("text").alias("hash"), size.alias("size"))


def mixed(documents: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, block: int = BLOCK, shard: int = SHARD, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(slots, parts): the slots of ``draws``, and (key, doc_id, hash, size, begin, block): documents by the blocks that hold their words."""
    if min(weights, default=0) < 1 or min(most, block, shard) < 1:
        raise ValueError("weights, most, block and shard must be positive")
    sized = staged(sizes(documents), "sized")
    sources = plan(sized, weights, most, block, seed)
    streams = running_total(sized, ["key"], ["doc_id", "hash"], F.col("size"), "begin")
    blocks = F.sequence(div(F.col("begin"), block), div(F.col("begin") + F.col("size") - 1, block))
    parts = streams.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, blocks)))
    return draws(sources, block, shard, seed), parts.join(sources.select("key", "source_size", "target"), "key")


def taken(documents: DataFrame, block: int = BLOCK, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken and the first shard of the mix that holds words of the document, -1 if none does."""
    slots, parts = mixed(documents, block=block, **options)
    whole = F.col("take") == F.col("length")
    times = slots.groupBy("key", "block").agg(F.count(F.when(whole, 1)).alias("times"), F.coalesce(F.max(F.when(~whole, F.col("take"))), long(0)).alias("cut"),
                                              F.min(F.when(whole, F.col("shard"))).alias("shard"), F.min(F.when(~whole, F.col("shard"))).alias("cut_shard"))
    low, high = F.greatest("begin", F.col("block") * block), F.least(F.col("begin") + F.col("size"), (F.col("block") + 1) * block)
    begun = F.greatest(long(0), F.least(high, F.col("block") * block + F.col("cut")) - low)   # words in the slot that takes a part
    first = F.least("shard", F.when(begun > 0, F.col("cut_shard")))
    whose = ["key", "doc_id", "hash", "begin", "size", "source_size", "target"]
    found = (parts.where("size > 0").join(times, ["key", "block"], "left")
             .groupBy(*whose).agg(F.coalesce(F.sum(F.col("times") * (high - low) + begun), long(0)).alias("taken"), F.coalesce(F.min(first), long(-1)).alias("first_shard")))
    found = found.unionByName(parts.where("size = 0").select(*whose, long(0).alias("taken"), long(-1).alias("first_shard")))
    return found.select("doc_id", "size", "source_size", "target", "taken", "first_shard")
