"""Harmonic packing of tokenised documents into sequences of ``capacity`` tokens.

Classes have reciprocal capacity: a piece of class j has capacity / j tokens, for j = 1, 2, 4 … capacity. Every document
is cut into pieces of these lengths, longest first, so it has one piece of each short class at most. A bin of class j takes j
pieces of that class and is then full. Workers number their pieces per class on their own; the numbers before them come from
one small count per worker and class, so no piece waits for another and no bin is shared between classes. The last bin of a
class may hold m < j pieces; it is cut into one bin for each binary digit of m. Every sequence is therefore full or holds a
power of two of tokens, and none needs padding.

Token ids are those of a tokenizer file, followed by one end id per document. Defined results: null and empty texts
are documents of the end id alone; rows repeated under one doc_id are packed each; a null doc_id stays null; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atlas.llm.common import staged

CAPACITY, END_ID = 2048, 1
CACHE_WORDS, CACHE_PIECES = 1 << 19, 1 << 18   # what a worker keeps while other stages use the executor's memory
# Fixed value: the split of the vocabulary's own pre-tokenizer, for texts of the characters below.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+"
UNUSUAL = re.compile("[^\t\n\r\x20-\x7e\xa1-\xa9\xab-\xb1\xb4\xb6-\xb8\xbb\xbf-įĲ-ķĹ-ľŁ-ňŊ-ž]|<\\|")


class WordTokens:
    """Ids of whole texts by way of their words.

    For a vocabulary that drops white space, lower-cases and never joins across its own split, the ids of a text
    are those of its words in order. Words are looked up in a bounded table; new words go through the tokenizer's
    model, and texts with characters outside the plain Latin range go through the tokenizer as they are.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.split = re.compile(PIECES)
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(plain)]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}   # byte-level alphabet

    def _word(self, word: str) -> bytes:
        out = []
        for piece in self.split.findall(word.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                if len(piece) > 256:
                    ids = self._whole(piece)
                else:
                    mapped = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.letters)
                    ids = np.array([t.id for t in self.model.tokenize(mapped)], "<u4").tobytes()
                if len(self.pieces) >= CACHE_PIECES:
                    self.pieces.clear()
                self.pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if UNUSUAL.search(text):
            return self._whole(text)
        words, known = text.split(), self.words
        new = set(words).difference(known)
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = set(words)
        for word in new:
            known[word] = self._word(word)
        return b"".join([known[w] for w in words])


def _tokens(path: str) -> WordTokens:
    """One table per worker process, which outlives a task."""
    kept = sys.__dict__.setdefault("_word_tokens", {})
    if path not in kept:
        kept[path] = WordTokens(path)
    return kept[path]


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of ``n`` tokens: whole capacities, then its binary digits from the top."""
    return [capacity] * (n // capacity) + [1 << b for b in reversed(range(capacity.bit_length())) if n % capacity >> b & 1]


def pieces(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and the place (worker, seat) within the class of that length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        worker, seats, tokens = TaskContext.get().partitionId(), {}, _tokens(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, batch.num_rows, 256):
                rows, held = [], []
                for doc_id, text in zip(batch.column(0)[at:at + 256].to_pylist(), texts[at:at + 256], strict=True):
                    data = tokens.ids(text.as_py()) + end
                    start, n = 0, len(data) // 4
                    for length in cut_lengths(n, capacity):
                        part = data[4 * start:4 * (start + length)]
                        seat = seats[length] = seats.get(length, -1) + 1
                        rows.append((doc_id, start, length, zlib.crc32(part), n, worker, seat))
                        if with_ids:
                            held.append(np.frombuffer(part, "<i4"))
                        start += length
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "worker", "seat"]
                if with_ids:
                    columns, names = [*columns, pa.array(held, pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, worker long, seat long" + ", ids array<int>" * with_ids
    return documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))).mapInArrow(run, schema)


def _binary_bin(rank: Column, m: Column, capacity: int) -> tuple[Column, Column]:
    """(bin, seat in it) where ``m`` leftover pieces fill one bin per binary digit, largest first."""
    bins, seats = [], []
    for b in range(capacity.bit_length()):
        above = F.shiftright(m, b + 1)
        before = F.shiftleft(above, b + 1)
        here = (F.shiftright(m, b).bitwiseAND(1) == 1) & (rank >= before) & (rank < before + (1 << b))
        bins.append(F.when(here, F.bit_count(above).cast("long")))
        seats.append(F.when(here, rank - before))
    return F.coalesce(*bins), F.coalesce(*seats)


def pack(placed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces that know their worker and seat; sequences are numbered from 0 without gaps."""
    counts = placed.groupBy("worker", "length").agg(F.count("*").alias("n"))
    lane = Window.partitionBy("length").orderBy("worker").rowsBetween(Window.unboundedPreceding, -1)
    workers = counts.withColumn("before", F.coalesce(F.sum("n").over(lane), F.lit(0).cast("long")))
    total = workers.groupBy("length").agg(F.sum("n").alias("total"))
    per_bin = F.lit(capacity).cast("long") / F.col("length")
    full = F.floor(F.col("total") / per_bin).cast("long")
    left = (F.col("total") - full * per_bin).cast("long")
    classes = total.select("length", "total", per_bin.cast("long").alias("per_bin"), full.alias("full"), left.alias("left"),
                           (full + F.bit_count(left)).alias("bins"))
    # one row per class: at most log2(capacity) + 1
    classes = classes.withColumn("base", F.coalesce(F.sum("bins").over(Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    where = workers.join(classes, "length").select("worker", "length", "before", "per_bin", "full", "left", "base")
    rank = F.col("before") + F.col("seat")
    over = rank - F.col("full") * F.col("per_bin")
    bin_, seat = _binary_bin(over, F.col("left"), capacity)
    in_full = over < 0
    return (placed.join(where, ["worker", "length"])
            .withColumn("sequence_id", F.col("base") + F.when(in_full, F.floor(rank / F.col("per_bin")).cast("long")).otherwise(F.col("full") + bin_))
            .withColumn("offset", F.when(in_full, rank % F.col("per_bin")).otherwise(seat) * F.col("length"))
            .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *[c for c in placed.columns if c == "ids"]))


def packed(documents: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, if asked for, its ids."""
    if capacity < 1 or capacity & (capacity - 1):
        raise ValueError("capacity must be a power of two")
    return pack(staged(pieces(documents, vocabulary, capacity, end_id, with_ids), "pieces"), capacity)
