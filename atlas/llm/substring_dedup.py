"""Removal of repeated passages by fixed-block anchors.

Every text is cut into blocks of ``block`` words that do not overlap; their hashes are the index. All rolling windows of
``block`` words probe it. ``block`` is at most half of ``span + 1``, so every window of ``span`` words that also starts
elsewhere contains a block there and a probe here. Windows of ``span`` words around a hit are then compared exactly
(128 bits of hash) and the earliest start of each is kept: runs of repeated windows are the maximal exact repeats.

Words are runs of bytes other than space and 0x09-0x0D, unchanged. Defined results: null and empty texts have no words;
a text shorter than ``span`` loses nothing; a null doc_id counts as the smallest; rows repeated under one doc_id count
as separate documents in read order; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from atlas.llm.common import staged
from atlas.llm.exchange import (
    CHECK_POWERS,
    SECOND_POWERS,
    U64,
    Chunk,
    answered,
    chunk_map,
    cuts,
    decode,
    encode,
    flags,
    pack,
    rolling,
    slicing,
)

SPAN, BLOCK_WORDS = 20, 10
ANCHOR_BITS = 48
FIRST_ID = -(1 << 63)


def _chunk(row: dict) -> Chunk:
    return Chunk(row["ids"].as_py(), row["sizes"].values.to_numpy(), row["blob"].as_py())


def _probes(chunk: Chunk, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(rolling hash and validity by start; sorted distinct hash, state) of a chunk's windows of ``block`` words.

    state: 1 if the hash is a block of the index, 2 more if it occurs more than once.
    """
    inside = chunk.inside(block)
    hashes = rolling(chunk.hashes, block) >> U64(64 - ANCHOR_BITS)
    starts = np.flatnonzero(inside)
    aligned = (starts - chunk.bounds[chunk.doc[starts]]) % block == 0
    keys = np.sort((hashes[starts] << U64(1)) | aligned.astype(U64))
    values = keys >> U64(1)
    first = np.flatnonzero(np.diff(values, prepend=~values[:1])) if len(values) else np.zeros(0, np.int64)
    last = np.append(first[1:], len(values)) - 1 if len(first) else first
    state = (keys[last] & U64(1)).astype(np.uint8) | ((last > first).astype(np.uint8) << 1)
    return hashes, inside, values[first], state


def _ask_anchors(block: int, slices: int):
    def run(row: dict) -> Iterator[pa.RecordBatch]:
        _, _, values, state = _probes(_chunk(row), block)
        parts = cuts(values, ANCHOR_BITS, slices)
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, *_ in parts], pa.int32()), pa.array([row["chunk"].as_py()] * len(parts), pa.int64()),
             pa.array([encode(values[a:b], low) for _, a, b, low in parts], pa.binary()),
             pa.array([np.packbits(np.unpackbits(state[a:b, None], axis=1)[:, 6:]).tobytes() for _, a, b, _ in parts], pa.binary())],
            names=["slice", "chunk", "hashes", "state"])

    return run


def _answer_anchors(slices: int):
    """A bit for every probe whose hash is an indexed block and occurs at least twice in the corpus."""
    def run(group: pa.Table) -> pa.Table:
        low = group.column("slice")[0].as_py() << (ANCHOR_BITS - slices)
        hashes = [decode(h.as_py(), low) for h in group.column("hashes")]
        state = [np.packbits(np.pad(np.unpackbits(np.frombuffer(s.as_py(), np.uint8), count=2 * len(h)).reshape(-1, 2), ((0, 0), (6, 0))), axis=1).ravel()
                 for s, h in zip(group.column("state"), hashes, strict=True)]
        values, at = np.unique(np.concatenate(hashes), return_inverse=True)
        every = np.concatenate(state)
        indexed = np.bincount(at, every & 1, len(values)) > 0
        twice = np.bincount(at, 1 + (every >> 1), len(values)) > 1
        good = (indexed & twice)[at]
        ends = np.cumsum([len(h) for h in hashes])
        return pa.table({"slice": group.column("slice"), "chunk": group.column("chunk"),
                         "bits": pa.array([np.packbits(good[e - len(h):e]).tobytes() for e, h in zip(ends, hashes, strict=True)], pa.binary())})

    return run


class _Candidates:
    """Windows of ``span`` words around anchor hits, ordered by content and then by place."""

    def __init__(self, row: dict, span: int, block: int, slices: int):
        self.chunk = chunk = _chunk(row)
        hashes, inside, values, _ = _probes(chunk, block)
        good = flags(row["anchors"], [b - a for _, a, b, _ in cuts(values, ANCHOR_BITS, slices)])
        hit = np.zeros(len(chunk.hashes) + 1, np.int64)
        if len(values):
            hit[1:len(hashes) + 1] = inside & good[np.minimum(np.searchsorted(values, hashes), len(values) - 1)]
        hits = np.cumsum(hit)
        n = max(0, len(chunk.hashes) - span + 1)
        near = hits[span - block + 1:][:n] - hits[:n] > 0
        self.starts = np.flatnonzero(near & chunk.inside(span)) if n else np.zeros(0, np.int64)
        ids = np.array([FIRST_ID if i is None else i for i in chunk.ids], np.int64)
        rank = np.empty(len(ids), np.int64)
        rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))
        place = rank[chunk.doc[self.starts]] * (len(chunk.hashes) + 1) + self.starts
        a, b = (rolling(chunk.hashes, span, p)[self.starts] if n else np.zeros(0, U64) for p in (CHECK_POWERS, SECOND_POWERS))
        order = np.lexsort((place, b, a))
        self.starts, a, b = self.starts[order], a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.first = np.flatnonzero(new)
        self.group = np.cumsum(new) - 1
        self.a, self.b, self.ids = a[self.first], b[self.first], ids[chunk.doc[self.starts[self.first]]]


def _narrow(ids: np.ndarray) -> tuple[int, bytes]:
    """(least id, differences in as few bytes as they need)."""
    low = int(ids.min())
    gaps = (ids.astype(object) - low if int(ids.max()) - low >= 1 << 63 else ids - low)
    kind = next(k for k in ("u1", "u2", "u4", "u8") if int(gaps.max()) < 1 << (8 * int(k[1])))
    return low, kind[1].encode() + np.asarray(gaps, kind).tobytes()


def _wide(low: int, data: bytes) -> np.ndarray:
    gaps = np.frombuffer(data, "u" + chr(data[0]), offset=1)
    return (gaps.astype(U64) + U64(low % (1 << 64))).view(np.int64)


def _ask_windows(span: int, block: int, slices: int):
    def run(row: dict) -> Iterator[pa.RecordBatch]:
        found = _Candidates(row, span, block, slices)
        parts = cuts(found.a, 64, slices)
        ids = [_narrow(found.ids[a:b]) for _, a, b, _ in parts]
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, *_ in parts], pa.int32()), pa.array([row["chunk"].as_py()] * len(parts), pa.int64()),
             pa.array([encode(found.a[a:b], low) for _, a, b, low in parts], pa.binary()),
             pa.array([found.b[a:b].tobytes() for _, a, b, _ in parts], pa.binary()),
             pa.array([low for low, _ in ids], pa.int64()), pa.array([i for _, i in ids], pa.binary())],
            names=["slice", "chunk", "hashes", "check", "low", "ids"])

    return run


def _answer_windows(slices: int):
    """A bit for every window whose content also starts in an earlier document of another chunk."""
    def run(group: pa.Table) -> pa.Table:
        low = group.column("slice")[0].as_py() << (64 - slices)
        hashes = [decode(h.as_py(), low) for h in group.column("hashes")]
        sizes = [len(h) for h in hashes]
        a, b = np.concatenate(hashes), np.concatenate([np.frombuffer(c.as_py(), U64) for c in group.column("check")])
        ids = np.concatenate([_wide(n.as_py(), i.as_py()) for n, i in zip(group.column("low"), group.column("ids"), strict=True)])
        chunk = np.repeat(np.array(group.column("chunk").to_pylist(), np.int64), sizes)
        order = np.lexsort((chunk, ids, b, a))
        later = np.zeros(len(a), bool)
        later[order[1:]] = (a[order[1:]] == a[order[:-1]]) & (b[order[1:]] == b[order[:-1]])
        ends = np.cumsum(sizes)
        return pa.table({"slice": group.column("slice"), "chunk": group.column("chunk"),
                         "bits": pa.array([np.packbits(later[e - n:e]).tobytes() for e, n in zip(ends, sizes, strict=True)], pa.binary())})

    return run


def _cut(span: int, block: int, slices: int):
    def run(row: dict) -> Iterator[pa.RecordBatch]:
        found = _Candidates(row, span, block, slices)
        later = flags(row["windows"], [b - a for _, a, b, _ in cuts(found.a, 64, slices)])
        repeat = np.ones(len(found.starts), bool)
        if len(later):
            repeat[found.first] = later
            repeat |= later[found.group]
        chunk = found.chunk
        edges = np.zeros(len(chunk.hashes) + 1, np.int64)
        np.add.at(edges, found.starts[repeat], 1)
        np.add.at(edges, found.starts[repeat] + span, -1)
        gone = np.cumsum(edges[:-1]) > 0
        counts = np.diff(chunk.bounds)
        removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[chunk.bounds])
        texts = []
        for d in range(len(chunk.ids)):
            words = chunk.text(d).split()
            if removed[d]:
                keep = ~gone[chunk.bounds[d]:chunk.bounds[d + 1]]
                words = [w for w, k in zip(words, keep.tolist(), strict=True) if k]
            texts.append(b" ".join(words))
        yield pa.RecordBatch.from_arrays(
            [pa.array(chunk.ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()),
             pa.array(texts, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "text"])

    return run


def remove_repeats(documents: DataFrame, span: int = SPAN, block: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space, for every row of (doc_id, text)."""
    if not 1 <= block <= (span + 1) // 2:
        raise ValueError("block must be at most half of span + 1")
    chunks = staged(pack(documents), "chunks")
    slices = slicing(chunks)
    asked = chunk_map(chunks, _ask_anchors(block, slices), "slice int, chunk long, hashes binary, state binary")
    anchors = staged(asked.groupBy("slice").applyInArrow(_answer_anchors(slices), "slice int, chunk long, bits binary"), "anchors")
    with_anchors = answered(chunks, anchors, "anchors")
    asked = chunk_map(with_anchors, _ask_windows(span, block, slices), "slice int, chunk long, hashes binary, check binary, low long, ids binary")
    windows = staged(asked.groupBy("slice").applyInArrow(_answer_windows(slices), "slice int, chunk long, bits binary"), "windows")
    return chunk_map(answered(with_anchors, windows, "windows"), _cut(span, block, slices), "doc_id long, n_words long, n_removed long, text string")
