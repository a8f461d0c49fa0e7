"""Phrases, spelling variants and mixed sources against brute force, with every awkward case, and over empty tables."""

import collections
import gc
import math
import random
import re
import sys
import weakref
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from atlas.llm import phrase_mining, source_mixing, spelling_variants
from atlas.llm.common import give_back
from atlas.llm.queries import QUERIES
from tests.llm.data import SCHEMA, documents

ROWS = documents()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_phrases(rows, least, longest, percent, first):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", fold(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        phrases = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = collections.Counter()
        for p, a in phrases.items():
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p):
                        longer[p[i:j]] = max(longer[p[i:j]], a)
        found = []
        for p, a in phrases.items():
            if 100 * longer[p] >= percent * a:
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("least, longest, percent, first, room", [(2, 5, 100, 2000, {}), (3, 4, 60, 15, {"room": 50, "burst": 3})])
def test_phrases(docs, monkeypatch, least, longest, percent, first, room):
    monkeypatch.setattr(phrase_mining, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(phrase_mining, "CHUNKS_A_PARTITIONING", 3)
    got = phrase_mining.collocations(docs, least, longest, percent, first, **room)
    assert sorted(map(tuple, got.collect())) == brute_phrases([(r[2], r[1]) for r in ROWS], least, longest, percent, first)


def test_windows_enter_the_trie_in_parts(monkeypatch):
    """A chunk's windows may not pile up beyond the room: the trie is looked at after every part."""
    words = [b"w%d" % (i * 7919 % 30_011) for i in range(200_000)]
    known = pa.array([[{"word": w.decode(), "id": i + 1} for i, w in enumerate(sorted(set(words)))]])
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([zstandard.ZstdCompressor().compress(b" ".join(words))]), known], names=["chunk", "blob", "known"])
    sizes, add = [], phrase_mining.HatTrie.add
    monkeypatch.setattr(phrase_mining.HatTrie, "add", lambda trie, rows: (add(trie, rows), sizes.append(trie.sizes.total())))
    parts = list(phrase_mining._count(5, 4, 1, 20_000, 64)(iter([batch])))
    assert max(sizes) < 20_000 + phrase_mining.AT_ONCE
    runs = [phrase_mining._rows(r.as_py(), 5, 4) for p in parts for r in p.column("run")]
    assert sum(int(n[(rows[:, 1] > 0) & (rows[:, 2] == 0)].sum()) for rows, n in runs) == len(words) - 1


def test_given_back_memory_includes_ended_tasks():
    class Task:
        pass

    task = Task()
    task.itself, seen = task, weakref.ref(task)
    sys.__dict__["_word_tokens"] = {"table": task}
    gc.disable()
    try:
        del task
        give_back()
        assert seen() is None
    finally:
        gc.enable()


def test_phrases_odd_words(spark):
    texts = [("en", "a\0b \x1c c\x85d a\0b \x1c c\x85d"), ("und", "x y\tx  y, x y"), (None, "x y: X Y"), ("en", None), ("en", "new york new york new-york"), ("fr", "..;!?"), ("", "x y x y")]
    rows = spark.createDataFrame(texts, "lang string, text string")
    assert sorted(map(tuple, phrase_mining.collocations(rows, 2).collect())) == brute_phrases(texts, 2, 5, 100, 2000)


def test_phrases_of_wide_numbers_and_large_counts(spark):
    """Word numbers beyond 32 bits, and products beyond 64 bits."""
    rows = np.array([[1 << 33, 5, 0], [1 << 33, 5, 7], [1 << 33, 6, 0], [2, 5, 7]], ">u8")
    trie = phrase_mining.HatTrie(3, 8, 1)
    trie.add(rows[np.lexsort((rows[:, 1], rows[:, 0]))])
    trie.add(rows[3:])
    first, second = trie.spill(3), trie.spill(0)   # the larger subtree goes first, whole
    assert first[0].tolist() == [[1 << 33, 5, 0], [1 << 33, 5, 7], [1 << 33, 6, 0]] and first[1].tolist() == [1, 1, 1]
    assert second[0].tolist() == [[2, 5, 7]] and second[1].tolist() == [2] and not trie.root
    parts = dict(phrase_mining._by_partition(*first, bits=4))
    back = [tuple(r) + (n,) for run in parts.values() for r, n in zip(*(x.tolist() for x in phrase_mining._rows(run, 3, 8)), strict=True)]
    assert sorted(back) == [(1 << 33, 5, 0, 2), (1 << 33, 5, 7, 1), (1 << 33, 6, 0, 1)]
    a, n, left, right = 9 * 10**12, 10**13, 9 * 10**12 + 1, 9 * 10**12 + 7
    row = spark.range(1).select(phrase_mining._exact_score(*[F.lit(x).cast("long") for x in (a, n, left, right)]).alias("s")).first()
    assert row.s == 1000 * a * n // (left * right)


def brute_variants(rows, noise, least_length, least_count, times):
    counts = collections.Counter()
    for doc_id, text in rows:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = fold(word)
            check = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if noise and check % noise == 0:
                word = word[:check % len(word)] + word[check % len(word) + 1:]
            counts[word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least_length and n >= least_count}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    close = {w: [v for v in words if near(w, v)] for w in words}
    form = {w: min(c, key=lambda v: (-words[v], v)) for w, c in close.items() if c}
    form = {w: v for w, v in form.items() if words[v] >= times * words[w]}
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(close[w]), words[form[w]] if w in form else None))
    return out


@pytest.mark.parametrize("symbols, noise", [(2, 0), (8, 3)])
def test_variants(docs, monkeypatch, symbols, noise):
    for name, value in (("TEXT_PART", 500), ("MOST_HELD", 300), ("PAIRS", 40), ("WORDS_A_SLICING", 100)):
        monkeypatch.setattr(spelling_variants, name, value)
    words = spelling_variants.vocabulary(docs, least_length=2, least_count=1, noise=noise)
    got = spelling_variants.variants(words, times=2, symbols=symbols).collect()
    want = brute_variants([(r[0], r[1]) for r in ROWS], noise, 2, 1, 2)
    assert len(got) == len(want) and set(map(tuple, got)) == want and any(r[1] != r[2] and r[1] for r in want)


def test_variants_of_hard_words(spark):
    """Runs of one letter, very long words, places at either end, letters outside ASCII, chains of forms."""
    rng = random.Random(4)
    base = "zürichstraße" * 30
    words = ["a" * 7, "a" * 8, "a" * 9, "b" + "a" * 6, "a" * 6 + "b", base, base[1:], base[:-1], base[:100] + "q" + base[101:], "éèêëìíîï", "éèêëìíî", "éèêëìíïï", "chainone", "chaintne", "chainttne"]
    texts = [(i, " ".join([w] * (200 if w == "chainone" else 20 if w == "chaintne" else 1 + i % 3)) + " × ÷ x́ 日本") for i, w in enumerate(words)]
    texts += [(100, " ".join("".join(rng.choices("ab", k=7)) for _ in range(300))), (None, "nulldocid nulldocid nulldocie"), (101, None), (102, "ABCDEFG abcdefg ABCDEFH"), (102, "ABCDEFG abcdefg ABCDEFH")]
    frame = spark.createDataFrame([(i, t, "word", 1) for i, t in texts], "doc_id long, text string, word string, n int")
    got = spelling_variants.variants(spelling_variants.vocabulary(frame, least_count=1, noise=2), times=10).collect()
    assert set(map(tuple, got)) == brute_variants(texts, 2, 7, 1, 10)


def test_checksums_of_two_parts():
    rng, sums = random.Random(1), spelling_variants.Checksums()
    for size in (0, 1, 2, 7, 64, 255):
        start, word = rng.randbytes(9), rng.randbytes(size)
        joined = sums.joined(np.array([zlib.crc32(start)], np.uint32), np.array([zlib.crc32(word)], np.uint32), np.array([size]))
        assert int(joined[0]) == zlib.crc32(start + word)


def test_registered_variants(spark, folder):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_spelling_variants"](spark, folder)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"] and set(map(tuple, got.collect())) == brute_variants(rows, 31, 7, 2, 10)


def brute_targets(sizes, weights, most):
    """Shares by weight; what is over ``most`` times a size is shared again among the rest."""
    target, open_, left = {}, dict(weights), sum(sizes.values())
    while open_:
        unit = left / sum(open_.values())
        over = [s for s, w in open_.items() if unit * w > most * sizes[s] + 1e-9]
        if not over:
            return target | {s: unit * w for s, w in open_.items()}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            del open_[s]
    return target


SOURCES = [(i, " ".join(["w"] * n), s) for i, (n, s) in enumerate(
    [(1, "a"), (2, "a"), (50, "B"), (333, "é"), (1, None), (0, "zero"), (0, "a"), (5, ""), (17, "\U0001f600"), (400, "￿"), (7, "b"), (90, "b"), (4, "é"), (2000, "hot"), (1500, "hot")])]
SOURCES += [(20, None, "a"), (21, "x  y\tz\n  ", "hot"), (None, "x y", "hot"), (None, None, None), SOURCES[3], SOURCES[3], SOURCES[5], SOURCES[5]]


@pytest.mark.parametrize("block, shard, most", [(1024, 256, 3), (8, 5, 2)])
def test_mixing(spark, block, shard, most):
    frame = spark.createDataFrame([(i, t, s, 1, "r") for i, t, s in SOURCES], "doc_id long, text string, source string, size int, target string").repartition(4)
    got = source_mixing.taken(frame, block=block, shard=shard, most=most).collect()
    assert len(got) == len(SOURCES)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes, of = collections.Counter(), collections.defaultdict(list)
    for i, t, s in SOURCES:
        sizes[s] += size(t)
        of[i, size(t)].append(s)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    target = brute_targets(sizes, {s: 1 + i % 3 for i, s in enumerate(order)}, most)
    assert math.isclose(sum(target.values()), sum(sizes.values()))
    taken = collections.Counter()
    for r in got:
        (source,) = {s for s in of[r.doc_id, r.size] if math.isclose(target[s], r.target, abs_tol=1e-6) and sizes[s] == r.source_size}
        taken[source] += r.taken
        assert 0 <= r.taken <= most * r.size and (r.first_shard >= 0) == (r.taken > 0)
    assert {s: abs(taken[s] - target[s]) <= 0.5 for s in sizes} == dict.fromkeys(sizes, True)
    if block == 8:
        key = lambda r: str(tuple(r))
        assert sorted(got, key=key) == sorted(source_mixing.taken(frame.repartition(9), block=block, shard=shard, most=most).collect(), key=key)
        other = source_mixing.taken(frame, block=block, shard=shard, most=most, seed=2).collect()
        assert sum(r.taken for r in other) == sum(r.taken for r in got) and sorted(other, key=key) != sorted(got, key=key)


def test_slots_are_filled_once_and_blocks_evenly(spark):
    frame = spark.createDataFrame([(i, t, s) for i, t, s in SOURCES], "doc_id long, text string, source string")
    slots, _ = source_mixing.mixed(frame, block=8, shard=5)
    rows = slots.collect()
    assert sorted((r.shard * 5 + r.slot) for r in rows) == list(range(len(rows)))
    times = collections.Counter((r.key, r.block) for r in rows)
    for key in {k for k, _ in times}:
        counts = [n for (k, _), n in times.items() if k == key]
        assert max(counts) - min(counts) <= 1 and all(0 < r.take <= r.length <= 8 for r in rows)
    drawn = collections.Counter((r.shard, r.key) for r in rows)
    assert len({drawn[s, "0hot"] for s in range(len(rows) // 5)}) > 1   # drawn, not dealt in turn


@pytest.mark.parametrize("n", [1, 2, 257])
def test_permutations(spark, n):
    here = lambda x, inverse=False: source_mixing.permuted(x, F.lit(n).cast("long"), F.lit(77).cast("long"), inverse)
    rows = spark.range(n).select("id", here(F.col("id")).alias("to")).select("id", "to", here(F.col("to"), True).alias("back")).collect()
    assert sorted(r.to for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert phrase_mining.collocations(empty).count() == 0
    assert spelling_variants.variants(spelling_variants.vocabulary(empty, noise=31)).count() == 0
    assert source_mixing.taken(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "s")], "doc_id long, text string, source string")
    assert sorted((r.doc_id, r.size, r.target, r.taken, r.first_shard) for r in source_mixing.taken(blank).collect()) == [(1, 0, 0.0, 0, -1), (2, 0, 0.0, 0, -1)]


def test_mixing_runs_without_python(spark, docs):
    plan = source_mixing.taken(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan
