"""Benchmark decontamination by winnowing, in SQL functions only.

Every window of ``span`` words is represented by the least hash of the word k-grams inside it (winnowing with
``span - k + 1`` grams per window), so a shared span of ``span`` words or more has a common fingerprint on both
sides. Document fingerprints that cannot meet a benchmark fingerprint are dropped by a bitmap of fixed size; the rest
are joined with the benchmark's on (fingerprint, window words), which extends every hit to the exact words. Items of
fewer than ``span`` words are one window each, fingerprinted whole, for each short length that occurs.

Words: A-Z lower-cased, then runs of digits, a-z and non-ASCII characters. Defined results: a null, empty or wordless
text has no words and is never contaminated; a wordless item has no window; repeated rows and repeated doc_ids are
judged row by row; an item repeated under one id counts once; a null item_id is left out of ``items_sha256`` and
``n_items``; an empty benchmark leaves every document clean. Columns beyond the named ones are ignored by
``contamination`` and kept by ``clean_documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.llm.common import indices, join_back, let, lower_ascii, row_key, staged

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN, GRAM = 10, 5
BITMAP_BITS = 1 << 20


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(lower_ascii(text), F.lit("")), SEPARATORS), lambda w: w != "")


def fingerprints(tokens: Column, span: int, gram: int) -> Column:
    """For every window of ``span`` words its winnowing fingerprint, in window order."""
    grams = F.transform(indices(1, F.size(tokens) - (gram - 1)), lambda i: F.xxhash64(F.slice(tokens, i, gram)))
    width = span - gram + 1
    return let(grams, lambda h: F.transform(indices(1, F.size(h) - (width - 1)), lambda j: F.array_min(F.slice(h, j, width))))


def _window(tokens: Column, start: Column, length: int, fp: Column) -> Column:
    return F.struct(fp.alias("fp"), start.cast("int").alias("start"), F.lit(length).alias("length"),
                    F.array_join(F.slice(tokens, start, length), " ").alias("window"))


def _windows(tokens: Column, span: int, gram: int, keep=None) -> Column:
    """Windows of ``span`` words whose fingerprint passes ``keep``."""
    def pick(fps: Column) -> Column:
        starts = indices(1, F.size(fps))
        if keep is not None:
            starts = F.filter(starts, lambda s: keep(F.element_at(fps, s)))
        return F.transform(starts, lambda s: _window(tokens, s, span, F.element_at(fps, s)))

    return let(fingerprints(tokens, span, gram), pick)


def _short_windows(tokens: Column, length: int, keep) -> Column:
    def pick(fps: Column) -> Column:
        return F.transform(F.filter(indices(1, F.size(fps)), lambda s: keep(F.element_at(fps, s))),
                           lambda s: _window(tokens, s, length, F.element_at(fps, s)))

    return let(F.transform(indices(1, F.size(tokens) - (length - 1)), lambda i: F.xxhash64(F.slice(tokens, i, length))), pick)


def item_windows(benchmark: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """(item_id, fp, length, window), each once."""
    tokens = F.col("tokens")
    items = benchmark.select("item_id", F.explode(F.array(words(F.col("text")))).alias("tokens")).where(F.size(tokens) > 0)
    short = items.where(F.size(tokens) < span).select(
        "item_id", F.xxhash64(tokens).alias("fp"), F.size(tokens).alias("length"), F.array_join(tokens, " ").alias("window"))
    full = (items.where(F.size(tokens) >= span).select("item_id", F.inline(_windows(tokens, span, gram)))
            .select("item_id", "fp", "length", "window"))
    return full.unionByName(short).distinct()


def bitmap(hashes: DataFrame, bits: int = BITMAP_BITS) -> DataFrame:
    """One row with ``bits`` bits as an array of longs: bit ``hash mod bits`` is set for every hash in column ``fp``."""
    bit = F.pmod("fp", F.lit(bits))
    set_words = (hashes.select(F.shiftright(bit, 6).cast("int").alias("i"), F.expr(f"shiftleft(1L, cast(pmod(fp, {bits}L) & 63 AS int))").alias("w"))
                 .groupBy("i").agg(F.bit_or("w").alias("w")))
    every = hashes.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("i"))
    return (every.join(set_words, "i", "left")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("i", F.coalesce("w", F.lit(0).cast("long")).alias("w")))), lambda s: s["w"]).alias("map")))


def matched_windows(documents: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM,
                    bits: int = BITMAP_BITS) -> tuple[DataFrame, DataFrame]:
    """(rows, hits): one row per document with its key and n_words; one row per occurrence of an item's window."""
    if not 1 <= gram <= span:
        raise ValueError("gram must lie between 1 and span")
    items = staged(item_windows(benchmark, span, gram), "windows")
    seen = bitmap(items, bits).scalar()
    short = sorted(r["length"] for r in items.where(F.col("length") < span).select("length").distinct().collect())  # at most span - 1 values

    def keep(fp: Column) -> Column:
        bit = F.pmod(fp, F.lit(bits))
        cell = F.element_at(F.col("seen"), (F.shiftright(bit, 6) + 1).cast("int"))
        return F.getbit(cell, F.pmod(bit, F.lit(64)).cast("int")) == 1

    def both(tokens: Column) -> Column:
        found = [_windows(tokens, span, gram, keep), *(_short_windows(tokens, n, keep) for n in short)]
        return F.struct(F.size(tokens).cast("long").alias("n_words"), F.concat(*found).alias("windows"))

    rows = staged(documents.select(F.col("doc_id"), F.col("text"), seen.alias("seen"))
                  .select(*row_key(F.col("doc_id"), F.col("text")), let(words(F.col("text")), both).alias("d"))
                  .select("k_id", "k_hash", "d.n_words", "d.windows"), "fingerprints")
    probes = rows.select("k_id", "k_hash", F.inline("windows"))
    hits = (probes.join(items.select("item_id", "fp", "window"), ["fp", "window"])
            .select("k_id", "k_hash", "start", "length", "item_id"))
    return rows.drop("windows"), hits


def _covered(spans: Column) -> Column:
    """Number of words in the union of (start, length) spans."""
    def step(state: Column, s: Column) -> Column:
        end = s["start"] + s["length"]
        return F.struct(F.greatest(state["end"], end).alias("end"),
                        (state["n"] + F.greatest(end - F.greatest(s["start"], state["end"]), F.lit(0))).alias("n"))

    return F.aggregate(F.array_sort(spans), F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), step)["n"].cast("long")


def contamination(documents: DataFrame, benchmark: DataFrame, span: int = SPAN, gram: int = GRAM, bits: int = BITMAP_BITS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans, items.

    ``spans`` are the hit (start, length) windows, start counted from 1 in words; ``items`` the ids that occur.
    """
    rows, hits = matched_windows(documents, benchmark, span, gram, bits)
    per_row = (hits.groupBy("k_id", "k_hash")
               .agg(F.collect_set(F.struct("start", "length")).alias("spans"), F.collect_set("item_id").alias("items")))
    names = F.coalesce(F.array_sort(F.transform("items", lambda i: i.cast("string"))), F.array().cast("array<string>"))
    n_hit = F.coalesce(_covered(F.col("spans")), F.lit(0).cast("long"))
    return join_back(rows, per_row).select(
        F.col("k_id").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
        F.array_sort("spans").alias("spans"), names.alias("items"))


def clean_documents(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark window, with all their columns."""
    _, hits = matched_windows(documents, benchmark, **options)
    key = [c.alias(n) for c, n in zip(row_key(F.col("doc_id"), F.col("text")), ("k_id", "k_hash"))]
    dirty = hits.select("k_id", "k_hash").distinct()
    return join_back(documents.select(F.struct("*").alias("row"), *key), dirty, "left_anti").select("row.*")
