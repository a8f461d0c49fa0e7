"""Exact Jaccard join of word-shingle sets with skipping by set relations.

Equal sets are one set from the start. Shingles are ordered by rarity (the binary logarithm of the number of documents
that have them, then the hash), and every set enters the lists of the first ``n - need + 1`` of its shingles, so
two sets that reach the threshold meet in the list of their first common shingle. A list is cut into blocks by set
size and by position; a block whose best possible overlap with a set is too small is skipped as a whole.

Links are found in rounds. First every set is compared with one set of each of its lists, the one whose shingles are
shared most (the likely original of its copies). Sets linked with it take over its answers: a set of the same component
needs no comparison, and for others the overlaps of both with the common original bound the overlap of the pair,
which accepts or rejects most pairs without reading the sets. What the bounds leave open is compared in samples of
the list's sets of growing share and finally in full, so no link between different components is left out.

Text: A-Z lower-cased, words are runs of bytes other than space and 0x09-0x0D; a set has the distinct hashes of all
``shingle``-word windows, or of the whole sequence where it has fewer words. Defined results: null, empty and wordless
texts have the empty set, which links with nothing, not even another empty set; rows repeated under one doc_id are
documents of their own; null ids are never the smallest unless a component has no other; further columns are ignored by
``components``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

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
    in_order,
    key_hash,
    mix,
    pack,
    rolling,
    slicing,
)

SHINGLE, PERCENT = 5, 75
SAMPLES = (16, 128, 1024, None)   # expected number of a list's sets that each open set is compared with, by round
POSITION_BLOCK = 16


def need(n: Column | int, percent: int):
    """Least overlap of a set of ``n`` shingles with any set that reaches the threshold."""
    return -(-percent * n // 100) if isinstance(n, int) else F.floor((n * percent + 99) / 100)


class Sets:
    """Distinct shingle hashes of every text of a chunk, as ``values[bounds[d]:bounds[d + 1]]``, sorted."""

    def __init__(self, row: dict, shingle: int):
        chunk = self.chunk = Chunk(row["ids"].as_py(), row["sizes"].values.to_numpy(), row["blob"].as_py(), fold=True)
        starts = np.flatnonzero(chunk.inside(shingle))
        hashes, doc = rolling(chunk.hashes, shingle)[starts], chunk.doc[starts]
        counts = np.diff(chunk.bounds)
        short = np.flatnonzero((counts > 0) & (counts < shingle))
        whole = [mix(rolling(chunk.hashes[chunk.bounds[d]:chunk.bounds[d + 1]], int(counts[d])) + U64(counts[d])) for d in short]
        hashes, doc = np.concatenate([hashes, *whole]), np.concatenate([doc, short])
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        self.values, self.doc = hashes[new], doc[new]
        self.bounds = np.searchsorted(self.doc, np.arange(len(chunk.ids) + 1))
        self.sizes = np.diff(self.bounds)

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """128 bits that are equal for equal sets: sums of two mixes of the hashes."""
        return tuple(np.diff(np.concatenate([np.zeros(1, U64), np.cumsum(mix(self.values * U64(p.base)))])[self.bounds]).view(np.int64)
                     for p in (CHECK_POWERS, SECOND_POWERS))


def _describe(shingle: int):
    def run(row: dict) -> Iterator[pa.RecordBatch]:
        sets = Sets(row, shingle)
        a, b = sets.digests()
        n = len(sets.sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array([row["chunk"].as_py()] * n, pa.int64()), pa.array(np.arange(n, dtype=np.int32)), pa.array(sets.chunk.ids, pa.int64()), row["keys"].values,
             pa.array(sets.sizes, pa.int64()), pa.array(a), pa.array(b)], names=["chunk", "at", "doc_id", "key", "n", "a", "b"])

    return run


def _ask_counts(shingle: int, slices: int):
    def run(row: dict) -> Iterator[pa.RecordBatch]:
        values, counts = np.unique(Sets(row, shingle).values, return_counts=True)
        parts = cuts(values, 64, slices)
        yield pa.RecordBatch.from_arrays(
            [pa.array([s for s, *_ in parts], pa.int32()), pa.array([row["chunk"].as_py()] * len(parts), pa.int64()),
             pa.array([encode(values[a:b], low) for _, a, b, low in parts], pa.binary()),
             pa.array([np.minimum(counts[a:b], 255).astype(np.uint8).tobytes() for _, a, b, _ in parts], pa.binary())],
            names=["slice", "chunk", "hashes", "counts"])

    return run


def _answer_counts(slices: int):
    """For every hash the binary logarithm of the documents that have it, rounded up: 0 for one document."""
    def run(group: pa.Table) -> pa.Table:
        low = group.column("slice")[0].as_py() << (64 - slices)
        hashes = [decode(h.as_py(), low) for h in group.column("hashes")]
        counts = np.concatenate([np.frombuffer(c.as_py(), np.uint8) for c in group.column("counts")])
        _, at = np.unique(np.concatenate(hashes), return_inverse=True)
        rarity = np.ceil(np.log2(np.bincount(at, counts))).astype(np.uint8)[at]
        ends = np.cumsum([len(h) for h in hashes])
        return pa.table({"slice": group.column("slice"), "chunk": group.column("chunk"),
                         "bits": pa.array([rarity[e - len(h):e].tobytes() for e, h in zip(ends, hashes, strict=True)], pa.binary())})

    return run


def _index(shingle: int, percent: int):
    """One row for each chosen set that shares a prefix shingle with another document."""
    def run(row: dict) -> Iterator[pa.RecordBatch]:
        sets = Sets(row, shingle)
        values = np.unique(sets.values)
        rarity = np.concatenate([np.frombuffer(b, np.uint8) for b in in_order(row["rarity"])] or [np.zeros(0, np.uint8)])
        rare = rarity[np.searchsorted(values, sets.values)] if len(values) else rarity
        out = []
        for d in sorted(row["chosen"].as_py() or []):
            here = slice(sets.bounds[d], sets.bounds[d + 1])
            own, r, n = sets.values[here], rare[here], int(sets.sizes[d])
            p = n - need(n, percent) + 1
            first = np.lexsort((own, r))[:p]
            at = np.flatnonzero(r[first] > 0)
            if len(at):
                shared = own[r > 0]
                out.append((row["chunk"].as_py() << 16 | d, n, len(shared), own[first[at]].view(np.int64), at.astype(np.int32), shared.view(np.int64)))
        if out:
            sid, n, shared, tokens, at, content = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(sid, pa.int64()), pa.array(n, pa.int64()), pa.array(shared, pa.int64()), pa.array(tokens, pa.list_(pa.int64())),
                 pa.array(at, pa.list_(pa.int32())), pa.array(content, pa.list_(pa.int64()))], names=["sid", "n", "shared", "tokens", "at", "content"])

    return run


def _overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (x, y) with the size of their intersection."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            both = [len(np.intersect1d(a[i].values.to_numpy(), b[i].values.to_numpy(), assume_unique=True)) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(both, pa.int64())], names=["x", "y", "overlap"])

    x = sets.select(F.col("sid").alias("x"), F.col("content").alias("a"))
    y = sets.select(F.col("sid").alias("y"), F.col("content").alias("b"))
    return pairs.join(x, "x").join(y, "y").select("x", "y", "a", "b").mapInArrow(run, "x long, y long, overlap long")


def connected(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, comp) for the nodes of ``edges`` (x, y); nodes of one component, and only they, have equal comp.

    Every round replaces a node by the neighbour of least hash, so edges shrink by a constant share each time.
    """
    def order(c: str) -> Column:
        return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))

    nodes = None
    while True:
        ends = edges.where("x <> y").select("x", "y").distinct()
        ends = staged(ends.union(ends.select("y", "x")), name)
        if ends.isEmpty():
            break
        parent = ends.groupBy("x").agg(F.least(F.min(order("y")), F.min(order("x")))["v"].alias("p"))
        parent = staged(parent, name)
        nodes = parent.select(F.col("x").alias("node"), F.col("p").alias("comp")) if nodes is None else staged(
            nodes.join(parent, nodes["comp"] == parent["x"], "left").select("node", F.coalesce("p", "comp").alias("comp")), name)
        edges = (ends.where("x < y").join(parent.select("x", F.col("p").alias("px")), "x")
                 .join(parent.select(F.col("x").alias("y"), F.col("p").alias("py")), "y").select(F.col("px").alias("x"), F.col("py").alias("y")))
    if nodes is None:
        return edges.sparkSession.createDataFrame([], "node long, comp long")
    return nodes


def _enough(overlap: Column, n: Column, m: Column, percent: int) -> Column:
    return overlap * (100 + percent) >= (n + m) * percent


def _open_pairs(lists: DataFrame, sample: int | None, percent: int) -> DataFrame:
    """Pairs of one list and different components that no bound decides, (x, y, sure), each once.

    ``lists`` has token, sid, n, shared (shingles that any other document has), at, comp, pivot, pivot_n and the overlap
    with the pivot (null if not compared). Every set outside the list's largest component meets the list's sampled sets, by blocks of size and position.
    """
    per_comp = lists.groupBy("token", "comp").agg(F.count("*").alias("k"))
    per_list = (per_comp.groupBy("token").agg(F.sum("k").alias("m"), F.count("*").alias("comps"), F.max(F.struct("k", "comp"))["comp"].alias("main"))
                .where("comps > 1"))
    mixed = lists.join(per_list, "token").withColumn("block", F.floor(F.col("at") / POSITION_BLOCK)).withColumn("size", F.floor(F.log2("n") * 4))
    member = mixed if sample is None else mixed.where(F.pmod(F.xxhash64("sid", F.lit(sample)), F.greatest(F.lit(1).cast("long"), F.floor(F.col("m") / sample))) == 0)
    blocks = member.groupBy("token", "size", "block").agg(F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.max(F.col("n") - F.col("at")).alias("rest"))
    probe = mixed.where("comp <> main").select("token", *[F.col(c).alias("x_" + c) for c in ("sid", "n", "shared", "at", "comp", "overlap")])
    rest = F.col("x_n") - F.col("x_at")
    reach = (probe.join(blocks, "token")
             .where(_enough(F.least(rest, F.col("rest")), F.col("x_n"), F.col("n_min"), percent)
                    & (F.col("x_n") * percent <= F.col("n_max") * 100) & (F.col("n_min") * percent <= F.col("x_n") * 100)))
    pair = (reach.drop("n_min", "n_max", "rest").join(member, ["token", "size", "block"])
            .where((F.col("x_comp") != F.col("comp")) & (F.col("x_sid") != F.col("sid"))
                   & _enough(F.least(rest, F.col("n") - F.col("at")), F.col("x_n"), F.col("n"), percent)
                   & (F.col("x_n") * percent <= F.col("n") * 100) & (F.col("n") * percent <= F.col("x_n") * 100)))
    # both overlaps with the list's pivot bound the pair's overlap
    lower = F.col("overlap") + F.col("x_overlap") - F.col("pivot_n")
    upper = F.least("overlap", "x_overlap") + F.least(F.col("shared") - F.col("overlap"), F.col("x_shared") - F.col("x_overlap"))
    sure = F.coalesce(_enough(lower, F.col("n"), F.col("x_n"), percent), F.lit(False))
    maybe = F.coalesce(_enough(upper, F.col("n"), F.col("x_n"), percent), F.lit(True))
    return (pair.where(maybe).groupBy(F.least("sid", "x_sid").alias("x"), F.greatest("sid", "x_sid").alias("y")).agg(F.max(sure).alias("sure")))


def links(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, comp) of all sets that link with another; ``sets`` has sid, n, shared, tokens, at and content."""
    entries = sets.select("sid", "n", "shared", F.explode(F.arrays_zip("tokens", "at")).alias("e")).select(
        F.col("e.tokens").alias("token"), "sid", "n", "shared", F.col("e.at").alias("at"))
    first = F.struct(((F.col("n") - F.col("shared")) / F.col("n")).alias("alone"), F.col("sid"), F.col("n"))
    pivots = entries.groupBy("token").agg(F.count("*").alias("m"), F.min(first).alias("p")).where("m > 1").select(
        "token", F.col("p.sid").alias("pivot"), F.col("p.n").alias("pivot_n"))
    lists = staged(entries.join(pivots, "token"), "lists")
    size = sets.select("sid", "n")

    def judged(pairs: DataFrame) -> DataFrame:
        a, b = (size.select(F.col("sid").alias(k), F.col("n").alias("n" + k)) for k in ("x", "y"))
        return (_overlaps(pairs, sets).join(a, "x").join(b, "y")
                .select("x", "y", "overlap", _enough(F.col("overlap"), F.col("nx"), F.col("ny"), percent).alias("link")))

    stars = lists.where((F.col("sid") != F.col("pivot")) & (F.col("n") * percent <= F.col("pivot_n") * 100) & (F.col("pivot_n") * percent <= F.col("n") * 100))
    answers = staged(judged(stars.select(F.col("sid").alias("x"), F.col("pivot").alias("y")).distinct()), "answers")
    own = lists.select(F.col("sid").alias("x"), F.col("sid").alias("y"), F.col("n").alias("overlap")).distinct()
    known = answers.select("x", "y", "overlap").union(own)
    lists = staged(lists.join(known.select(F.col("x").alias("sid"), F.col("y").alias("pivot"), "overlap"), ["sid", "pivot"], "left"), "lists")
    edges = answers.where("link").select("x", "y")
    tried = answers.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    comps = connected(edges)
    for sample in SAMPLES:
        labelled = lists.join(comps.withColumnRenamed("node", "sid"), "sid", "left").withColumn("comp", F.coalesce("comp", "sid"))
        open_ = staged(_open_pairs(labelled, sample, percent).join(tried, ["x", "y"], "left_anti"), "open")
        if open_.isEmpty():
            continue
        sure = open_.where("sure").select("x", "y")
        found = staged(judged(open_.where("NOT sure").select("x", "y")), "found")
        edges = edges.union(sure).union(found.where("link").select("x", "y"))
        tried = tried.union(open_.select("x", "y"))
        comps = connected(edges)
    return comps


def components(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id of the component), key (see ``key_hash``) and comp, for every row.

    ``comp`` tells components apart even where repeated ids give two the same component_id; it is null for empty sets.
    """
    if shingle < 1 or not 1 <= percent <= 100:
        raise ValueError("shingle must be positive and percent between 1 and 100")
    chunks = staged(pack(documents), "chunks")
    rows = staged(chunk_map(chunks, _describe(shingle), "chunk long, at int, doc_id long, key long, n long, a long, b long"), "sets")
    equal = staged(rows.where("n > 0").groupBy("n", "a", "b").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("chunk", "at")).alias("rep")).select("n", "a", "b", "least_id", "rep.chunk", "rep.at"), "equal")
    chosen = equal.groupBy("chunk").agg(F.collect_list("at").alias("chosen"))
    slices = slicing(chunks)
    asked = chunk_map(chunks, _ask_counts(shingle, slices), "slice int, chunk long, hashes binary, counts binary")
    rarity = staged(asked.groupBy("slice").applyInArrow(_answer_counts(slices), "slice int, chunk long, bits binary"), "rarity")
    sets = staged(chunk_map(answered(chunks, rarity, "rarity").join(chosen, "chunk"), _index(shingle, percent),
                            "sid long, n long, shared long, tokens array<long>, at array<int>, content array<long>"), "index")
    comps = links(sets, percent)
    sid = F.shiftleft("chunk", 16).bitwiseOR(F.col("at").cast("long"))
    grouped = equal.withColumn("node", sid).join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = grouped.groupBy("comp").agg(F.min("least_id").alias("component_id"))
    ids = grouped.join(least, "comp").select("n", "a", "b", "component_id", "comp")
    return rows.join(ids, ["n", "a", "b"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "key", "comp")


def representatives(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, of its least doc_id, and all rows without words; all columns stay."""
    found = components(documents, shingle, percent)
    best = (found.where("n_shingles > 0").groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("b"))
            .select(F.coalesce("b.doc_id", F.lit(0)).alias("k_id"), F.col("b.key").alias("k_key")))
    rows = documents.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("k_id"), key_hash().alias("k_key"), F.struct("*").alias("row"))
    wordless = F.coalesce("text", F.lit("")).rlike(r"^[\x20\x09-\x0D]*\z")   # "$" would also match before a last U+0085, U+2028 or U+2029
    kept = rows.join(best, ["k_id", "k_key"]).dropDuplicates(["k_id", "k_key"]).select("row.*")
    return kept.unionByName(documents.where(wordless))
