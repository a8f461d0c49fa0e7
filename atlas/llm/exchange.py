"""Corpus-wide questions about word sequences, asked in packed form.

Texts are packed into chunks of a few megabytes, one compressed row each. A chunk asks about its hashes by sending every
distinct one once, sorted and delta-coded, to the slice of the hash space it falls in; the slice answers each chunk with
one small value per hash, in the same order. So no hash travels with its position, a frequent passage costs a slice
one entry per chunk, and a slice's size follows the number of distinct hashes divided by the number of slices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.llm.common import give_back

CHUNK_BYTES = 4_000_000
CHUNK_DOCS = 1 << 16
SLICE_BITS, CHUNKS_A_SLICING = 9, 1024   # 512 slices up to 1024 chunks, then twice as many for each doubling
BLOCK = 1 << 20
U64 = np.uint64
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit over the output."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.size = base, 0

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, 1 << 16, 2 * self.size)
            both = []
            for b in (self.base, pow(self.base, -1, 1 << 64)):
                a = np.full(self.size, b, U64)
                a[0] = 1
                both.append(np.multiply.accumulate(a))
            self.up, self.down = both
        return self.up[:n], self.down[:n]


BYTE_POWERS, WORD_POWERS, CHECK_POWERS, SECOND_POWERS = (
    Powers(b) for b in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB))
BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
FOLDED_CODES = BYTE_CODES.copy()
FOLDED_CODES[0x41:0x5B] = BYTE_CODES[0x61:0x7B]


def word_hashes(values: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every run of bytes that are not ASCII white space; ``fold`` lower-cases A-Z first."""
    codes, hashes, starts, at = FOLDED_CODES if fold else BYTE_CODES, [], [], 0
    while at < len(values):
        end = min(at + BLOCK, len(values))
        while end < len(values) and not SPACES[values[end]]:   # to the end of the word
            tail = np.flatnonzero(SPACES[values[end:end + BLOCK]])
            end = end + tail[0] if len(tail) else min(end + BLOCK, len(values))
        block = values[at:end]
        inside = np.zeros(len(block) + 2, bool)
        inside[1:-1] = ~SPACES[block]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[0::2], edges[1::2]
        up, down = BYTE_POWERS.upto(len(block))
        sums = np.zeros(len(block) + 1, U64)
        np.cumsum(codes[block] * up, out=sums[1:])
        if len(first):
            hashes.append(mix((sums[last] - sums[first]) * down[first]))
            starts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def rolling(hashes: np.ndarray, width: int, powers: Powers = WORD_POWERS) -> np.ndarray:
    """Hash of every run of ``width`` consecutive word hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    up, down = powers.upto(len(hashes))
    sums = np.zeros(len(hashes) + 1, U64)
    np.cumsum(hashes * up, out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * down[:n])


class Chunk:
    """The texts of a chunk: ``ids``, the joined bytes, and the words of every text as ``bounds[d]:bounds[d + 1]``."""

    def __init__(self, ids: list, sizes: np.ndarray, blob: bytes, fold: bool = False):
        self.ids = ids
        self.data = zstandard.ZstdDecompressor().decompress(blob)
        self.offsets = np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64) + 1)])
        self.hashes, starts = word_hashes(np.frombuffer(self.data, np.uint8), fold)
        self.bounds = np.searchsorted(starts, self.offsets)
        self.doc = np.repeat(np.arange(len(ids)), np.diff(self.bounds))

    def text(self, d: int) -> bytes:
        return self.data[self.offsets[d]:self.offsets[d + 1] - 1]

    def inside(self, width: int) -> np.ndarray:
        """Whether the window of ``width`` words that starts at a word lies in one text."""
        n = len(self.hashes) - width + 1
        return self.doc[:n] == self.doc[width - 1:] if n > 0 else np.zeros(0, bool)


def key_hash() -> Column:
    """With the id, null as 0, equal for repeated rows only."""
    return F.xxhash64("text", F.col("doc_id").isNull())


def pack(documents: DataFrame) -> DataFrame:
    """(chunk, ids, keys, sizes, blob): the texts, null as empty, joined by line feeds and compressed; a text is never split."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        give_back()   # what the worker's earlier tasks left
        number, squeeze = TaskContext.get().partitionId() << 24, zstandard.ZstdCompressor(level=3)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary())
            at, parts = 0, []
            while at < len(ids):
                end, size, parts = at, 0, []
                while end < len(ids) and (end == at or size < CHUNK_BYTES) and end - at < CHUNK_DOCS:
                    parts.append(texts[end].as_py())
                    size += len(parts[-1]) + 1
                    end += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number]), pa.array([ids[at:end]], pa.list_(pa.int64())),
                     pa.array([batch.column(2)[at:end].to_pylist()], pa.list_(pa.int64())), pa.array([[len(p) for p in parts]], pa.list_(pa.int32())),
                     pa.array([squeeze.compress(b"\n".join([*parts, b""]))], pa.binary())], names=["chunk", "ids", "keys", "sizes", "blob"])
                number, at = number + 1, end
            del batch, ids, texts, parts
        give_back()

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), key_hash())
    return rows.mapInArrow(run, "chunk long, ids array<long>, keys array<long>, sizes array<int>, blob binary")


def encode(values: np.ndarray, low: int) -> bytes:
    """Sorted values as byte planes of their differences, the first from ``low``."""
    gaps = np.diff(values, prepend=U64(low))
    width = max(1, (int(gaps.max()).bit_length() + 7) // 8) if len(gaps) else 1
    return bytes([width]) + np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def decode(data: bytes, low: int) -> np.ndarray:
    width = data[0]
    planes = np.zeros((8, (len(data) - 1) // width), np.uint8)
    planes[:width] = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    gaps = np.ascontiguousarray(planes.T).view(U64).ravel()
    return np.cumsum(gaps) + U64(low)


def slicing(chunks: DataFrame) -> int:
    """Bits of the slice number, so that a slice has a few million hashes at most whatever the number of chunks."""
    return SLICE_BITS + max(0, (chunks.count() // CHUNKS_A_SLICING).bit_length())


def cuts(values: np.ndarray, bits: int, slices: int) -> list[tuple[int, int, int, int]]:
    """(slice, from, to, lowest value) of sorted values of ``bits`` bits, for each of the 2^``slices`` slices that has some."""
    number = values >> U64(bits - slices)
    first = np.flatnonzero(np.diff(number, prepend=~number[:1])) if len(values) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(values))
    return [(int(number[a]), int(a), int(b), int(number[a]) << (bits - slices)) for a, b in zip(first, ends, strict=False)]


def chunk_map(chunks: DataFrame, fn: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``fn(row) -> record batches`` to every chunk row, given as a dict of Arrow scalars."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()   # what the worker's earlier tasks left
        for batch in batches:
            for i in range(batch.num_rows):
                yield from fn({name: batch.column(k)[i] for k, name in enumerate(batch.schema.names)})
                give_back()

    return chunks.mapInArrow(run, schema)


def answered(chunks: DataFrame, answers: DataFrame, name: str) -> DataFrame:
    """``chunks`` with the answers (chunk, slice, bits) to each as one list column."""
    lists = answers.groupBy("chunk").agg(F.collect_list(F.struct("slice", "bits")).alias(name))
    return chunks.join(lists, "chunk", "left")


def in_order(answers: pa.Scalar) -> list[bytes]:
    """A chunk's answers by slice."""
    return [a["bits"] for a in sorted(answers.as_py() or [], key=lambda a: a["slice"])]


def flags(answers: pa.Scalar, sizes: list[int]) -> np.ndarray:
    """One boolean per hash from bitmaps by slice; ``sizes`` are the numbers of hashes by slice."""
    parts = [np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(in_order(answers), sizes, strict=True)]
    return np.concatenate(parts).astype(bool) if parts else np.zeros(0, bool)
