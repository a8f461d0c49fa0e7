"""Phrases whose words occur together more often than apart, per language, counted in HAT-tries.

Texts are packed into chunks of one language each. Words are counted first; those that reach ``least`` occurrences in their
language get a number, and only they can be part of a phrase that does. Every task then walks its chunks and enters, for each
word, the window of up to ``longest`` numbered words that begins there into a trie: a node per first word, below it a hash
container of suffixes, which bursts into one container per second word when it has grown. When the trie holds ``room``
windows, its largest subtrees are written out whole, as runs sorted by word numbers, cut by a hash of the first three words
(the prefix partition), until half is left. A prefix partition merges its runs and sums equal windows, and from the sorted
windows the count of every phrase of three words and more that begins one. Pairs get partitions of their own, since a pair
may begin a large share of all windows: subtrees report them as totals.

A phrase's score is 1000 * a * n / (l * r), rounded down, at its worst cut into two parts with l and r occurrences, where n is
the number of words of the language. A phrase of at least ``least`` occurrences is dropped if one of its extensions has
``percent`` % of its occurrences; extensions by one word decide this, since longer ones are no more frequent.

Text: A-Z lower-cased, pieces end at ``.,;:!?`` and 0x0A-0x0D, words at space and tab. Defined results: a null text is empty;
a null language is ``und``, as is that very name; an empty table, or one without a frequent phrase, gives an empty result;
repeated rows count as often as they occur; ids and further columns are ignored. Scores beyond 63 bits are null: they
need over 9 * 10^15 words in one language. Words and phrases are compared as strings, never as hashes.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlas.llm.common import give_back, staged
from atlas.llm.exchange import U64, mix

LEAST, LONGEST, PERCENT, FIRST = 100, 5, 100, 2000
CHUNK_BYTES = 4_000_000
ROOM, BURST = 1_000_000, 4096   # windows in a task's trie, suffixes in a container
AT_ONCE = 1 << 17   # windows entered between two looks at the trie's size
PART_BITS, CHUNKS_A_PARTITIONING = 7, 256   # 128 prefix partitions up to 256 chunks, then twice as many for each doubling
UNKNOWN = "und"
UPPER, BREAKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b".,;:!?\x0b\x0c\r"
FOLD = bytes.maketrans(UPPER + BREAKS + b"\t", UPPER.lower() + b"\n" * len(BREAKS) + b" ")
BREAK = b"\xff"   # stands between pieces; no byte of UTF-8
MIXERS = np.array([0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0xA0761D6478BD642F], U64)


def words_and_breaks(text: bytes) -> list[bytes]:
    """Lower-cased words in order, with ``BREAK`` between pieces."""
    return text.translate(FOLD).replace(b"\n", b" \xff ").split()


def pack(documents: DataFrame) -> DataFrame:
    """(chunk, lang, blob): texts of one language, joined by line feeds and compressed; a text is never split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, squeeze = TaskContext.get().partitionId() << 24, zstandard.ZstdCompressor(level=3)
        held: dict[str, list[bytes]] = {}
        sizes: Counter = Counter()

        def chunk(lang: str) -> pa.RecordBatch:
            nonlocal number
            number += 1
            del sizes[lang]
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([lang], pa.string()), pa.array([squeeze.compress(b"\n".join(held.pop(lang)))], pa.binary())],
                                              names=["chunk", "lang", "blob"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()), strict=True):
                held.setdefault(lang, []).append(text.as_py())
                sizes[lang] += len(held[lang][-1]) + 1
                if sizes[lang] >= CHUNK_BYTES:
                    yield chunk(lang)
                elif sizes.total() >= 8 * CHUNK_BYTES:
                    yield chunk(sizes.most_common(1)[0][0])
        for lang in list(held):
            yield chunk(lang)

    rows = documents.select(F.coalesce("lang", F.lit(UNKNOWN)), F.coalesce("text", F.lit("")))
    return rows.mapInArrow(run, "chunk long, lang string, blob binary")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, list[bytes]]]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)}
            yield row, words_and_breaks(zstandard.ZstdDecompressor().decompress(row["blob"].as_py()))


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, lang, word, n): the different words of every chunk."""
    for row, words in _texts(batches):
        counts = Counter(words)
        del counts[BREAK]
        k = len(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["chunk"].as_py()] * k, pa.int64()), pa.array([row["lang"].as_py()] * k, pa.string()),
             pa.array(list(counts), pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64())], names=["chunk", "lang", "word", "n"])


def windows(numbers: np.ndarray, longest: int) -> np.ndarray:
    """For every place the numbers of up to ``longest`` words, filled with 0 from the first 0 on; those of two and more, in order."""
    out = np.zeros((len(numbers), longest), ">u8" if numbers.itemsize == 8 else ">u4")
    going = np.ones(len(numbers), bool)
    for k in range(longest):
        there = np.zeros_like(numbers)
        there[:max(0, len(numbers) - k)] = numbers[k:]
        going &= there > 0
        out[:, k] = np.where(going, there, 0)
    out = out[out[:, 1] > 0]
    return out[np.lexsort((out[:, 1], out[:, 0]))]


def _groups(values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(value, from, to) of every run of equal values."""
    if not len(values):
        return
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    yield from zip(values[first].tolist(), first.tolist(), [*first[1:].tolist(), len(values)], strict=True)


class HatTrie:
    """Counts of windows under their first word; a container over ``burst`` suffixes is split by the second word."""

    def __init__(self, longest: int, width: int, burst: int):
        self.suffix, self.kind, self.columns, self.burst = (longest - 1) * width, f">u{width}", longest, burst
        self.width, self.root, self.sizes = width, {}, Counter()

    def add(self, rows: np.ndarray) -> None:
        """Count windows that are sorted by their first two words."""
        keys = np.ascontiguousarray(rows[:, 1:]).view(f"S{self.suffix}").ravel().tolist()   # final zero bytes are implied
        second = rows[:, 1]
        for word, at, end in _groups(rows[:, 0]):
            node = self.root.setdefault(word, Counter())
            if isinstance(node, Counter):
                before = len(node)
                node.update(keys[at:end])
                self.sizes[word] += len(node) - before
                if len(node) > self.burst:
                    self.root[word] = self._burst(node)
            else:
                for below, a, b in _groups(second[at:end]):
                    leaf = node.setdefault(below, Counter())
                    before = len(leaf)
                    leaf.update(keys[at + a:at + b])
                    self.sizes[word] += len(leaf) - before

    def _burst(self, container: Counter) -> dict[int, Counter]:
        node: dict[int, Counter] = {}
        for key, n in container.items():
            node.setdefault(int.from_bytes(key[:self.width].ljust(self.width, b"\0"), "big"), Counter())[key] = n
        return node

    def spill(self, leave: int) -> tuple[np.ndarray, np.ndarray]:
        """(windows, counts) of the largest subtrees in order, until no more than ``leave`` windows stay."""
        rest, chosen = self.sizes.total(), []
        for word, size in self.sizes.most_common():
            if rest <= leave:
                break
            chosen.append(word)
            rest -= size
        keys, counts, first, sizes = [], [], sorted(chosen), []
        for word in first:
            node = self.root.pop(word)
            for leaf in [node] if isinstance(node, Counter) else [node[k] for k in sorted(node)]:
                inside = sorted(leaf)
                keys += inside
                counts += map(leaf.__getitem__, inside)
            sizes.append(self.sizes.pop(word))
        rows = np.empty((len(keys), self.columns), self.kind)
        rows[:, 0] = np.repeat(np.array(first, self.kind), sizes)
        rows[:, 1:] = np.array(keys, f"S{self.suffix}").view(self.kind).reshape(-1, self.columns - 1)
        return rows, np.array(counts, np.int64)


def _new(rows: np.ndarray, k: int) -> np.ndarray:
    """Places where the first ``k`` words change."""
    if not len(rows):
        return np.zeros(0, int)
    return np.flatnonzero(np.r_[True, (rows[1:, :k] != rows[:-1, :k]).any(axis=1)])


def _run(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """Byte planes of sorted windows and their counts, compressed."""
    fixed = np.ascontiguousarray(rows, rows.dtype.newbyteorder(">"))   # joining arrays may have turned it
    planes = np.hstack([fixed.view(np.uint8).reshape(len(rows), -1), counts.astype("<i8").view(np.uint8).reshape(-1, 8)])
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.T).tobytes())


def _rows(run: bytes, columns: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(run), np.uint8).reshape(columns * width + 8, -1)
    table = np.ascontiguousarray(planes.T)
    return (np.ascontiguousarray(table[:, :columns * width]).view(f">u{width}"), np.ascontiguousarray(table[:, columns * width:]).view("<i8").ravel())


def _by_partition(rows: np.ndarray, counts: np.ndarray, bits: int) -> Iterator[tuple[int, bytes]]:
    """(prefix partition, run): windows of three and more words by these three, totals of pairs by the pair."""
    first = _new(rows, 2)
    pairs = np.zeros((len(first), rows.shape[1]), rows.dtype)
    pairs[:, :2] = rows[first, :2]
    totals = np.add.reduceat(counts, first) if len(first) else counts[:0]
    if rows.shape[1] > 2:
        more = rows[:, 2] > 0
        rows, counts = np.concatenate([pairs, rows[more]]), np.concatenate([totals, counts[more]])
    else:
        rows, counts = pairs, totals
    prefix = rows[:, :3].astype(U64)
    part = mix((prefix * MIXERS[:prefix.shape[1]]).sum(axis=1, dtype=U64)) >> U64(64 - bits)
    order = np.argsort(part.astype(np.uint32), kind="stable")
    for number, at, end in _groups(part[order]):
        here = order[at:end]
        yield number, _run(rows[here], counts[here])


def _count(longest: int, width: int, bits: int, room: int, burst: int):
    def spilled(trie: HatTrie, leave: int) -> pa.RecordBatch:
        parts, runs = zip(*_by_partition(*trie.spill(leave), bits), strict=True)
        return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(runs, pa.binary())], names=["part", "run"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()   # what the worker's earlier tasks left
        trie = HatTrie(longest, width, burst)
        for row, words in _texts(batches):
            known = row["known"].values
            numbers = dict(zip(known.field("word").cast(pa.binary()).to_pylist(), known.field("id").to_pylist(), strict=True))
            places = np.fromiter(map(numbers.get, words, repeat(0)), f"u{width}", len(words))
            del row, words, known, numbers   # the trie needs the room
            rows = windows(places, longest)
            for at in range(0, len(rows), AT_ONCE):
                trie.add(rows[at:at + AT_ONCE])
                if trie.sizes.total() >= room:
                    yield spilled(trie, room // 2)
                    give_back()
            del places, rows
        if trie.sizes.total():
            yield spilled(trie, 0)
        del trie
        give_back()

    return run


def _merge(longest: int, width: int, least: int):
    """Phrases of a prefix partition with ``least`` occurrences or more."""
    def run(group: pa.Table) -> pa.Table:
        tables = [_rows(r.as_py(), longest, width) for r in group.column("run")]
        rows, counts = np.concatenate([t[0] for t in tables]), np.concatenate([t[1] for t in tables])
        del tables
        order = np.lexsort(tuple(rows[:, k] for k in reversed(range(longest))))
        rows, counts = rows[order], counts[order]
        found, a = [], []
        for k in range(2, longest + 1):
            here = rows[:, k - 1] > 0
            if k == 2 and longest > 2:
                here = rows[:, 2] == 0
            part, n = rows[here], counts[here]
            first = _new(part, k)
            sums = np.add.reduceat(n, first) if len(first) else n
            often = sums >= least
            found += part[first[often], :k].astype(np.int64).tolist()
            a += sums[often].tolist()
        return pa.table({"words": pa.array(found, pa.list_(pa.int64())), "a": pa.array(a, pa.int64())})

    return run


def count_phrases(documents: DataFrame, least: int, longest: int, room: int = ROOM, burst: int = BURST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(words as numbers, a) of the frequent phrases; (id, lang, word, f) of the frequent words; (lang, n)."""
    chunks = staged(pack(documents), "texts")
    vocabulary = staged(chunks.mapInArrow(_vocabulary, "chunk long, lang string, word string, n long"), "vocabulary")
    totals = staged(vocabulary.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    often = vocabulary.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    laid = staged(often.withColumn("slot", F.monotonically_increasing_id()), "frequent")
    task, seat = F.shiftright("slot", 33), F.col("slot").bitwiseAND((1 << 33) - 1)
    tasks, seats = laid.agg(F.coalesce(F.max(task), F.lit(0)) + 1, F.coalesce(F.max(seat), F.lit(0)) + 1).first()
    words = laid.select((seat * tasks + task + 1).alias("id"), "lang", "word", "f")
    width = 4 if tasks * seats < 1 << 32 else 8
    bits = PART_BITS + (chunks.count() // CHUNKS_A_PARTITIONING).bit_length()
    # an outer join, so that every row of the vocabulary yields one row, however many words are frequent; nulls are not collected
    known = (vocabulary.select("chunk", "lang", "word").join(words.select("id", "lang", "word"), ["lang", "word"], "left")
             .groupBy("chunk").agg(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("word", "id"))).alias("known")))
    runs = chunks.join(known, "chunk").select("chunk", "blob", "known").mapInArrow(_count(longest, width, bits, room, burst), "part int, run binary")
    phrases = runs.groupBy("part").applyInArrow(_merge(longest, width, least), "words array<long>, a long")
    return staged(phrases, "phrases"), words, totals


def _exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) in 38 decimal digits."""
    a, n, left, right = (c.cast("decimal(18,0)") for c in (a, n, left, right))
    return F.call_function("div", F.lit(1000).cast("decimal(4,0)") * (a * n).cast("decimal(34,0)"), left * right)


def collocations(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, percent: int = PERCENT, first: int = FIRST, **room) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``first`` phrases by score, then a, then phrase."""
    if least < 1 or longest < 2 or not 1 <= percent <= 100:
        raise ValueError("least must be positive, longest at least 2 and percent between 1 and 100")
    phrases, words, totals = count_phrases(documents, least, longest, **room)
    ends = F.explode(F.array(F.slice("words", 1, F.size("words") - 1), F.slice("words", 2, F.size("words") - 1))).alias("words")
    extended = phrases.where(F.size("words") > 2).select(ends, "a").groupBy("words").agg(F.max("a").alias("longer"))
    kept = phrases.join(extended, "words", "left").where(F.coalesce(100 * F.col("longer") < percent * F.col("a"), F.lit(True))).drop("longer")
    told = (kept.join(words.select(F.col("id").alias("head"), "lang"), F.col("words")[0] == F.col("head")).drop("head").join(totals, "lang"))
    cut = F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")
    counts = phrases.select(F.col("words").alias("part"), F.col("a").alias("f")).union(words.select(F.array("id"), "f"))
    cuts = (told.select("*", cut).withColumn("left", F.slice("words", 1, F.col("k"))).withColumn("right", F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")))
            .join(counts.select(F.col("part").alias("left"), F.col("f").alias("l")), "left").drop("left")
            .join(counts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right").drop("right"))
    worst = F.min(F.struct(_exact_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r")).alias("w")
    scored = cuts.groupBy("lang", "words", "a", "n").agg(worst).select("lang", "words", "a", "n", "w.l", "w.r", "w.score")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    short = staged(scored.withColumn("rank", F.rank().over(best)).where(F.col("rank") <= first).drop("rank"), "best")
    spelt = (short.select("words", F.posexplode("words").alias("at", "id")).join(words.select("id", "word"), "id").groupBy("words")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = short.join(spelt, "words").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
