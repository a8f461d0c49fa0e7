"""Groups of spelling variants, found through a reduced alphabet.

Every letter is hashed to one of ``symbols`` symbols, so a word becomes a reduced word. Two words that differ by one edit have
reduced words that differ by one edit at most. For every reduced word the one-edit neighbourhood is generated: the word itself,
every replacement by a higher symbol, every deletion; replacements by lower symbols and insertions are the same pairs seen
from the other word. The neighbourhoods meet the reduced vocabulary slice by slice of the key space, as packed sorted keys.
A generated key carries 16 bits of the original letters that the edit leaves alone, which rejects nearly all words that only
share the reduced form before a pair is written; words of equal reduced form are paired by their letters around each place,
so a crowded reduced word costs no more than its true pairs. What is left is verified on the original strings.

A word's form is its most frequent neighbour (ties: smallest in code-point order) if that is ``times`` times as frequent or
more, and its root the end of the chain of forms; counts grow along a chain, so it has no circle, and pointers are doubled.

Words are maximal runs of A-Z, a-z and U+00C0-U+00FF, A-Z lower-cased, of ``least_length`` code points that occur
``least_count`` times. With ``noise`` N, a run of a document whose crc32(``<doc_id>:<run>``) N divides loses the code point at
crc32 % length first, as typing errors would make it. Defined results: a null text has no words; a null doc_id is the empty string
in the checksum; repeated rows count as often as they occur; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atlas.llm.common import staged
from atlas.llm.exchange import U64, Powers, decode, encode, mix

LEAST_LENGTH, LEAST_COUNT, TIMES = 7, 2, 10
SYMBOLS = 8
TEXT_PART, MOST_HELD = 1 << 21, 1 << 19   # letters looked at together; different words a task counts before it passes them on
SLICE_BITS, WORDS_A_SLICING = 6, 1 << 19   # 64 slices of the key space up to 2^19 words, then twice as many for each doubling
PAIRS = 1 << 21   # candidates compared together
LETTERS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))
REDUCED, ORIGINAL = Powers(0x9E3779B97F4A7C15), Powers(0xD1B54A32D192ED03)
SALT = U64(0xA0761D6478BD642F)
SPREAD = np.arange(1 << 16, dtype=U64) * SALT   # lengths and places, far apart


class Numbers(dict):
    """Words by number, in the order in which they were first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class Checksums:
    """crc32 of a start followed by words, from the checksums of both: a start's checksum is moved on by the word's length."""

    LONGEST = 255   # bytes of a word for which there is a table

    def __init__(self):
        table = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
        moved = [np.stack([np.arange(256, dtype=np.uint32) << np.uint32(8 * k) for k in range(4)])]
        for _ in range(self.LONGEST):
            moved.append((moved[-1] >> 8) ^ table[moved[-1] & 255])
        self.moved = np.stack(moved)

    def joined(self, start: np.ndarray, word: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = word.copy()
        for k in range(4):
            out ^= self.moved[size, k, (start >> np.uint32(8 * k)) & np.uint32(255)]
        return out


def _counts(noise: int, least_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Checksums()
        numbers, damaged = Numbers(), Counter()
        counts, codes, sizes, lengths = np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def words() -> Iterator[pa.RecordBatch]:
            found = Counter(damaged)
            for word, n in zip(numbers, counts.tolist(), strict=True):
                if n and len(word) >= least_length:
                    found[word] += n
            kept = [w for w in found if len(w) >= least_length]
            yield pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in kept], pa.string()), pa.array([found[w] for w in kept], pa.int64())], names=["word", "n"])

        for batch in batches:
            at, ids = 0, batch.column(0).to_pylist()
            texts = batch.column(1)
            while at < len(ids):
                held, starts, letters = [], [], 0
                while at < len(ids) and letters < TEXT_PART:
                    text = texts[at].as_py()
                    held.append(text.encode("latin-1", "replace").translate(LETTERS).split())   # what is not Latin-1 becomes "?", no letter
                    starts.append(zlib.crc32(f"{ids[at] or ''}:".encode()))
                    letters += len(text)
                    at += 1
                known = len(numbers)
                token = np.fromiter((numbers[w] for words_ in held for w in words_), np.int64)
                new = list(numbers)[known:] if len(numbers) > known else []
                if new:
                    utf8 = [w if w.isascii() else w.decode("latin-1").encode() for w in new]
                    codes = np.append(codes, np.array([zlib.crc32(w) for w in utf8], np.uint32))
                    sizes = np.append(sizes, np.array([len(w) for w in utf8], np.int64))
                    lengths = np.append(lengths, np.array([len(w) for w in new], np.int64))
                    counts = np.append(counts, np.zeros(len(new), np.int64))
                if noise:
                    start = np.repeat(np.array(starts, np.uint32), [len(w) for w in held])
                    size = sizes[token]
                    check = sums.joined(start, codes[token], np.minimum(size, Checksums.LONGEST)).astype(np.int64)
                    for i in np.flatnonzero(size > Checksums.LONGEST).tolist():
                        word = list(numbers)[token[i]]
                        check[i] = zlib.crc32(word.decode("latin-1").encode(), int(start[i]))
                    hit = check % noise == 0
                    places, often = np.unique(np.stack([token[hit], check[hit] % lengths[token[hit]]]), axis=1, return_counts=True)
                    if len(often):
                        order = list(numbers)
                        for (i, p), n in zip(places.T.tolist(), often.tolist(), strict=True):
                            damaged[order[i][:p] + order[i][p + 1:]] += n
                    token = token[~hit]
                counts += np.bincount(token, minlength=len(numbers))
                if len(numbers) + len(damaged) >= MOST_HELD:
                    yield from words()
                    numbers, damaged = Numbers(), Counter()
                    counts, codes, sizes, lengths = counts[:0], codes[:0], sizes[:0], lengths[:0]
        yield from words()

    return run


def vocabulary(documents: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, noise: int = 0) -> DataFrame:
    """(word, n)"""
    rows = documents.select(F.col("doc_id").cast("string"), F.coalesce("text", F.lit("")))
    counts = rows.mapInArrow(_counts(noise, least_length), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= least_count)


class Letters:
    """Code points of words, one after another, and sums over them that give the hash of a word with one place changed."""

    def __init__(self, points: np.ndarray, lengths: np.ndarray):
        self.points, self.lengths = points.astype(U64), lengths
        self.first = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)

    @classmethod
    def of(cls, words: list[str]) -> Letters:
        return cls(np.frombuffer("".join(words).encode("utf-32-le"), "<u4"), np.array([len(w) for w in words], np.int64))

    def table(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of the words of this length, their code points as rows)"""
        which = np.flatnonzero(self.lengths == length)
        return which, self.points[self.first[which][:, None] + np.arange(length)]


def totals(values: np.ndarray, powers: Powers) -> np.ndarray:
    return (values * powers.upto(values.shape[1])[0]).sum(axis=1, dtype=U64)


def reduced(points: np.ndarray, symbols: int) -> np.ndarray:
    return mix(points * SALT) % U64(symbols) + U64(1)


def key(total: np.ndarray, length: int) -> np.ndarray:
    return mix(total + SPREAD[length % len(SPREAD)])


def check_of(total: np.ndarray, place: np.ndarray | int) -> np.ndarray:
    """16 bits of a hash of letters; ``place`` is the hole that was left out, -1 for none."""
    return (mix(total + SPREAD[(place + 2) % len(SPREAD)]) >> U64(48)).astype(np.uint16)


def neighbourhood(points: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, np.ndarray]]:
    """(row numbers, keys, place, checks) of the replacements by higher symbols (place) and the deletions (-1) of words of one length."""
    length = points.shape[1]
    low, whole = reduced(points, symbols), totals(points, ORIGINAL)
    total = totals(low, REDUCED)
    up, down = REDUCED.upto(length + 1)
    up_o, down_o = ORIGINAL.upto(length + 1)
    parts, parts_o = low * up[:length], points * up_o[:length]
    before, before_o = np.zeros(len(points), U64), np.zeros(len(points), U64)
    for i in range(length):
        hole = check_of(whole - parts_o[:, i], i)
        for symbol in range(2, symbols + 1):
            rows = np.flatnonzero(low[:, i] < symbol)
            yield rows, key(total[rows] + (U64(symbol) - low[rows, i]) * up[i], length), i, hole[rows]
        rows = np.flatnonzero(points[:, i] != points[:, i - 1]) if i else np.arange(len(points))   # of equal letters one
        shorter = before + (total - before - parts[:, i]) * down[1]
        shorter_o = before_o + (whole - before_o - parts_o[:, i]) * down_o[1]
        yield rows, key(shorter[rows], length - 1), -1, check_of(shorter_o[rows], -1)
        before, before_o = before + parts[:, i], before_o + parts_o[:, i]


def squeezed(values: np.ndarray) -> bytes:
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def opened(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


ASKED = "slice int, listed boolean, keys binary, ids binary, places binary, checks binary, points binary, lengths binary"


def _ask(symbols: int, bits: int):
    """Packed rows for every slice: the words listed under their reduced key, and the generated keys."""
    def rows(listed: bool, keys: np.ndarray, ids: np.ndarray, places: np.ndarray, checks: np.ndarray, words: list[str] | None) -> Iterator[tuple]:
        order = np.argsort(keys)
        keys, slices = keys[order], keys[order] >> U64(64 - bits)
        first = np.flatnonzero(np.r_[True, slices[1:] != slices[:-1]]) if len(keys) else []
        for a, b in zip(first, [*first[1:], len(keys)], strict=True):
            here, number = order[a:b], int(slices[a])
            some = Letters.of([words[i] for i in here]) if words is not None else None
            yield (number, listed, encode(keys[a:b], number << (64 - bits)), squeezed(ids[here]), squeezed(places[here]), squeezed(checks[here]),
                   squeezed(some.points.astype("<u4")) if some else None, squeezed(some.lengths) if some else None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words = batch.column("id").to_numpy(), batch.column("word").to_pylist()
            letters = Letters.of(words)
            own, made = np.zeros(len(words), U64), []
            for length in np.unique(letters.lengths).tolist():
                which, points = letters.table(length)
                own[which] = key(totals(reduced(points, symbols), REDUCED), length)
                made += [(which[r], k, np.full(len(r), p, np.int32), c) for r, k, p, c in neighbourhood(points, symbols)]
            none = np.zeros(len(words), np.int32)
            out = list(rows(True, own, ids, none, none.astype(np.uint16), words))
            if made:
                who, keys, places, checks = (np.concatenate(x) for x in zip(*made, strict=True))
                out += rows(False, keys, ids[who], places, checks, None)
            if out:
                kinds = (pa.int32(), pa.bool_(), *[pa.binary()] * 6)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=[c.split()[0] for c in ASKED.split(", ")])

    return run


def _same_key(keys: np.ndarray, letters: Letters, whole: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of words of equal reduced form that differ at one place: equal hash of the letters around it."""
    crowded = np.zeros(len(keys), bool)
    same = keys[1:] == keys[:-1]
    crowded[1:] |= same
    crowded[:-1] |= same
    there = np.flatnonzero(crowded)
    longest = int(letters.lengths[there].max()) if len(there) else 0
    up = ORIGINAL.upto(max(1, longest))[0]
    for i in range(longest):
        rows = there[letters.lengths[there] > i]
        around = mix(whole[rows] - letters.points[letters.first[rows] + i] * up[i]) ^ keys[rows]
        order = np.argsort(around, kind="stable")
        around, rows = around[order], rows[order]
        for step in range(1, len(rows)):   # neighbours in a run of equal hashes, as far apart as the longest run has words
            equal = np.flatnonzero(around[step:] == around[:-step])
            if not len(equal):
                break
            yield rows[equal], rows[equal + step]


def _match(symbols: int, bits: int):
    """(x, y): candidate pairs of a slice."""
    def run(group: pa.Table) -> pa.Table:
        low = group.column("slice")[0].as_py() << (64 - bits)
        parts: dict[bool, list] = {True: [], False: []}
        for i in range(group.num_rows):
            row = {n: group.column(n)[i].as_py() for n in group.column_names}
            entry = [decode(row["keys"], low), opened(row["ids"], "<i8"), opened(row["places"], "<i4"), opened(row["checks"], "<u2")]
            if row["listed"]:
                entry += [opened(row["points"], "<u4"), opened(row["lengths"], "<i8")]
            parts[row["listed"]].append(entry)
        xs, ys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if parts[True]:
            keys, ids, _, _, points, lengths = (np.concatenate(c) for c in zip(*parts[True], strict=True))
            letters = Letters(points, lengths)
            up = ORIGINAL.upto(int(lengths.max()))[0]
            place = np.arange(len(points)) - np.repeat(letters.first, lengths)
            whole = np.add.reduceat(letters.points * up[place], letters.first)
            order = np.argsort(keys, kind="stable")
            keys, ids, whole = keys[order], ids[order], whole[order]
            letters.first, letters.lengths = letters.first[order], lengths[order]
            for a, b in _same_key(keys, letters, whole):
                xs.append(ids[a])
                ys.append(ids[b])
            for asked, who, places, checks, *_ in parts[False]:
                first, last = np.searchsorted(keys, asked), np.searchsorted(keys, asked, "right")
                n = last - first
                found = np.flatnonzero(n)
                ends = np.cumsum(n[found])
                at = 0
                while at < len(found):
                    end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
                    rows, k = found[at:end], n[found[at:end]]
                    probe = np.repeat(rows, k)
                    word = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + np.repeat(first[rows], k)
                    hole = places[probe].astype(np.int64)
                    left_out = np.where((hole >= 0) & (hole < letters.lengths[word]), hole, 0)
                    part = letters.points[letters.first[word] + left_out] * up[left_out]
                    right = check_of(whole[word] - np.where(hole >= 0, part, U64(0)), hole) == checks[probe]
                    xs.append(who[probe[right]])
                    ys.append(ids[word[right]])
                    at = end
        x, y = np.concatenate(xs), np.concatenate(ys)
        order = np.lexsort((y, x))   # 16 bits may let a second edit of a word through to the same neighbour
        x, y = x[order], y[order]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        return pa.table({"x": pa.array(x[new], pa.int64()), "y": pa.array(y[new], pa.int64())})

    return run


def near_pairs(words: DataFrame, symbols: int = SYMBOLS) -> DataFrame:
    """(x, y, x_word, y_word, x_n, y_n): every pair of words one edit apart, once; ``words`` has id, word and n."""
    bits = SLICE_BITS + (words.count() // WORDS_A_SLICING).bit_length()
    asked = words.select("id", "word").mapInArrow(_ask(symbols, bits), ASKED)
    pairs = asked.groupBy("slice").applyInArrow(_match(symbols, bits), "x long, y long")
    one = words.select(F.col("id").alias("x"), F.col("word").alias("x_word"), F.col("n").alias("x_n"))
    other = words.select(F.col("id").alias("y"), F.col("word").alias("y_word"), F.col("n").alias("y_n"))
    return pairs.join(one, "x").join(other, "y").where(F.levenshtein("x_word", "y_word", 1) == 1)


def roots(forms: DataFrame) -> DataFrame:
    """(id, root) from (id, form): the last word of each chain of forms; every round doubles the steps."""
    state = staged(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        further = state.select(F.col("id").alias("root"), F.col("root").alias("next"))
        state = staged(state.join(further, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if state.where("moved").isEmpty():
            return state.select("id", "root")
        state = state.select("id", "root")


def variants(words: DataFrame, times: int = TIMES, symbols: int = SYMBOLS) -> DataFrame:
    """word, form, root, n, n_near and form_n for every row of ``words`` (word, n); words are distinct."""
    if times < 2 or symbols < 2:
        raise ValueError("times and symbols must be 2 or more")
    words = staged(words.select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    pairs = staged(near_pairs(words, symbols), "near")
    swapped = pairs.select(F.col("y").alias("x"), F.col("x").alias("y"), F.col("x_word").alias("y_word"), F.col("y_n").alias("x_n"), F.col("x_n").alias("y_n"))
    both = pairs.select("x", "y", "y_word", "x_n", "y_n").union(swapped.select("x", "y", "y_word", "x_n", "y_n"))
    best = F.min(F.struct((-F.col("y_n")).alias("n"), F.col("y_word").alias("word"), F.col("y").alias("id"))).alias("best")
    found = staged(both.groupBy(F.col("x").alias("id"), "x_n").agg(F.count("*").alias("n_near"), best), "neighbours")
    often = -F.col("best.n") >= times * F.col("x_n")
    found = found.select("id", "n_near", F.when(often, F.col("best.word")).alias("form"), F.when(often, -F.col("best.n")).alias("form_n"), F.when(often, F.col("best.id")).alias("form_id"))
    ends = roots(found.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("form")))
    named = ends.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return (words.join(found, "id", "left").join(named, "id", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"))
