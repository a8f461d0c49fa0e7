"""Exact top-k inner-product search by distributed histogram selection.

Equal vectors are one vector with its least ids, at most k + 1 of them (a query may be one and is left out in the end), so
a vector that fills a third of the table costs one comparison. An id that has several vectors asks under its own name: pairs
of equal id are left out while scores are counted and selected, however many vectors the id has. Blocks of queries meet
blocks of vectors on the block's number, with components in as few bytes as they need; a vector block stays in its task and
a block pair is one matrix product. Every pass scores everything in its range and reports, for each query, counts
of scores per histogram bin; the counts are summed over all blocks and the bin of the kth highest score is located. The
next pass refines that bin, until bins are one score wide. Then scores above the kth value and the ties at it are kept,
the ties to the smaller ids. A block reports only bins at or above its own kth score: lower ones cannot hold the kth of all.

Defined results: vectors that are null or hold a null, NaN or infinite component take no part, neither do null ids;
a vector meets only vectors of its own dimension; an id that occurs in several rows is a candidate for every row of another
id, with each different vector; an empty table gives an empty result; further columns are ignored. Components are
floor(scale * x); products are exact while dimension * largest component squared stays below 2^62.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.llm.common import staged

K, SCALE = 20, 64
QUERY_BLOCK, VECTOR_BLOCK, STRIP = 1024, 4096, 256
BINS = 256


def quantised(embeddings: DataFrame, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """(vec_id, dim, vec) with vec = floor(scale * x) as longs."""
    vec = F.transform(F.col(column), lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall(F.col(column), lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return (embeddings.where(F.col("vec_id").isNotNull() & F.col(column).isNotNull() & finite)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.size(column).alias("dim"), vec.alias("vec")))


def _least_ids(rows: DataFrame, keep: int) -> DataFrame:
    """(dim, vec, ids): each different vector with its ``keep`` least ids."""
    part = rows.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(32)))
    some = F.slice(F.array_sort(F.collect_list("vec_id")), 1, keep)
    first = part.groupBy("dim", "vec", "salt").agg(some.alias("ids"))
    return first.groupBy("dim", "vec").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep).alias("ids"))


def _matrix(rows: pa.Array, dim: int) -> np.ndarray:
    return rows.field("vec").flatten().to_numpy().astype(np.int64).reshape(len(rows), dim)


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer products, by floating point where that is exact."""
    dim = max(1, queries.shape[1])
    most = dim * int(np.abs(queries).max(initial=0)) * int(np.abs(vectors).max(initial=0))
    if most < 1 << 53:
        kind = np.float32 if most < 1 << 24 else np.float64
        return (queries.astype(kind) @ vectors.astype(kind).T).astype(np.int64)
    return queries @ vectors.T


class Vectors:
    """A block of vectors: rows with their number of ids and the least of them, for a query as it sees them."""

    def __init__(self, rows: pa.StructArray):
        self.rows, ids = rows, rows.field("ids")
        self.keys, self.weights = rows.field("key").to_numpy(), np.diff(ids.offsets.to_numpy())
        self.ids = ids.flatten().to_numpy()
        self.row = np.repeat(np.arange(len(rows)), self.weights)
        first = np.cumsum(self.weights) - self.weights
        self.least = self.ids[first]
        self.second = self.ids[np.minimum(first + 1, len(self.ids) - 1)]   # means something where there are two

    def for_query(self, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids, least id), without the query's own id if it asks under it."""
        if own is None:
            return self.weights, self.least
        mine = self.row[self.ids == own]
        weights, least = self.weights.copy(), self.least
        weights[mine] -= 1
        return weights, np.where(least == own, self.second, least)


def _strips(row: dict) -> Iterator[tuple]:
    """(query keys, own ids, low, high, vectors, scores) by strips of queries."""
    q, v = row["queries"].values, row["vectors"].values
    dim = row["dim"].as_py()
    qs, vs = _matrix(q, dim), _matrix(v, dim)
    low, high = (q.field(c).to_numpy() for c in ("low", "high"))
    keys, own, vectors = q.field("key").to_numpy(), q.field("own").to_pylist(), Vectors(v)
    for at in range(0, len(qs), STRIP):
        part = slice(at, at + STRIP)
        yield keys[part], own[part], low[part], high[part], vectors, _products(qs[part], vs)


def _by_pair(fn):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from fn({n: batch.column(k)[i] for k, n in enumerate(batch.schema.names)})

    return run


def _histogram(keep: int):
    """Counts of scores per bin of [low, high], highest bins first until ``keep`` scores are counted."""
    def fn(row: dict) -> Iterator[pa.RecordBatch]:
        out = []
        for keys, own, low, high, vectors, scores in _strips(row):
            width = (high - low) // BINS + 1
            for i, key in enumerate(keys.tolist()):
                weights, _ = vectors.for_query(own[i])
                inside = np.flatnonzero((scores[i] >= low[i]) & (scores[i] <= high[i]) & (weights > 0))
                bins = np.bincount((scores[i][inside] - low[i]) // width[i], weights[inside], BINS).astype(np.int64)
                above = np.cumsum(bins[::-1])[::-1] - bins
                for b in np.flatnonzero((bins > 0) & (above < keep)).tolist():
                    out.append((key, b, int(bins[b])))
        if out:
            k, b, n = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], names=["key", "bin", "n"])

    return _by_pair(fn)


def _select(keep: int):
    """Scores above low (the kth of all) and, of those equal to it, the ``keep`` with the least ids."""
    def fn(row: dict) -> Iterator[pa.RecordBatch]:
        out_q, out_v, out_s = [], [], []
        for keys, own, low, _, vectors, scores in _strips(row):
            for i, key in enumerate(keys.tolist()):
                weights, least = vectors.for_query(own[i])
                above, ties = np.flatnonzero((scores[i] > low[i]) & (weights > 0)), np.flatnonzero((scores[i] == low[i]) & (weights > 0))
                ties = ties[np.argsort(least[ties], kind="stable")[:keep]] if len(ties) > keep else ties
                at = np.concatenate([above, ties])
                out_q.append(np.full(len(at), key))
                out_v.append(vectors.keys[at])
                out_s.append(scores[i][at])
        if out_q:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in (out_q, out_v, out_s)], names=["key", "vec_key", "score"])

    return _by_pair(fn)


def top_k(embeddings: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` highest scores among the rows of other ids."""
    keep = k + 1   # the query itself may be among them
    rows = staged(quantised(embeddings, scale, column), "vectors")
    largest = rows.agg(F.coalesce(F.max(F.array_max(F.transform("vec", F.abs))), F.lit(0).cast("long"))).first()[0]
    small = "array<short>" if largest < 1 << 15 else "array<int>" if largest < 1 << 31 else "array<long>"
    key = F.xxhash64("vec", F.lit(5)).alias("key")
    vectors = staged(_least_ids(rows, keep).select("dim", "vec", "ids", key), "distinct")
    asked = rows.where(is_query).distinct()
    several = asked.groupBy("vec_id").agg(F.count("*").alias("m")).where("m > 1").select("vec_id", F.col("vec_id").alias("own"))
    asked = staged(asked.join(several, "vec_id", "left").withColumn("key", F.xxhash64("vec", F.lit(5), "own")), "asked")   # a null adds nothing to the hash
    bound = F.expr("aggregate(vec, 0L, (s, x) -> s + abs(x))") * largest
    want = F.when(F.col("own").isNull(), F.lit(keep)).otherwise(F.lit(k)).cast("long").alias("want")
    state = staged(asked.select("dim", "vec", "own", "key").distinct().select("dim", "vec", "own", "key", (-bound).alias("low"), bound.alias("high"), want), "state")

    n_blocks = max(1, -(-vectors.count() // VECTOR_BLOCK))
    right = staged(vectors.withColumn("block", F.pmod("key", F.lit(n_blocks))).groupBy("dim", "block").agg(
        F.collect_list(F.struct("key", F.col("vec").cast(small).alias("vec"), "ids")).alias("vectors")), "blocks")

    def pairs(queries: DataFrame) -> DataFrame:
        part = F.pmod("key", F.greatest(F.lit(1).cast("long"), F.ceil(queries.agg(F.count("*")).scalar() / QUERY_BLOCK)))
        left = (queries.withColumn("part", part).groupBy("dim", "part").agg(F.collect_list(F.struct("key", "own", F.col("vec").cast(small).alias("vec"), "low", "high")).alias("queries"))
                .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))))
        return left.join(right.hint("shuffle_hash"), ["dim", "block"]).select("dim", "queries", "vectors")

    done = None
    while True:
        counts = pairs(state).mapInArrow(_histogram(keep), "key long, bin long, n long").groupBy("key", "bin").agg(F.sum("n").alias("n"))
        lists = counts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("bin", "n")), asc=False).alias("bins"))
        # walk down the bins to the one that holds the wanted score; with too few scores the lowest bin stays
        walk = F.aggregate("bins", F.struct(F.lit(0).cast("long").alias("above"), F.lit(-1).cast("long").alias("bin"), F.lit(0).cast("long").alias("before")),
                           lambda s, b: F.when(s["above"] >= F.col("want"), s).otherwise(
                               F.struct((s["above"] + b["n"]).alias("above"), b["bin"].alias("bin"), s["above"].alias("before"))))
        width = F.floor((F.col("high") - F.col("low")) / BINS) + 1
        low = F.col("low") + F.col("w.bin") * width
        state = staged(state.join(lists, "key").withColumn("w", walk).select(
            "dim", "vec", "own", "key", low.alias("low"), F.least("high", low + width - 1).alias("high"), (F.col("want") - F.col("w.before")).alias("want")), "state")
        ready = state.where("low = high")
        done = ready if done is None else done.union(ready)
        state = state.where("low < high")
        if state.isEmpty():
            break
    done = staged(done, "thresholds")
    hits = pairs(done).mapInArrow(_select(keep), "key long, vec_key long, score long")
    ids = vectors.select(F.col("key").alias("vec_key"), "ids")
    ranked = hits.join(ids, "vec_key").select("key", "score", F.explode("ids").alias("vec_id"))
    owned = asked.where("own IS NOT NULL").select("key", "own").distinct()
    ranked = ranked.join(owned, "key", "left").where(F.coalesce(F.col("vec_id") != F.col("own"), F.lit(True)))
    order = F.struct((-F.col("score")).alias("s"), F.col("vec_id").alias("v"))
    best = ranked.groupBy("key").agg(F.slice(F.array_sort(F.collect_list(order)), 1, 2 * keep).alias("best"))
    queries = asked.select(F.col("vec_id").alias("query_id"), "key").distinct()
    others = F.slice(F.filter("best", lambda b: b["v"] != F.col("query_id")), 1, k)
    return (queries.join(best, "key").select("query_id", F.posexplode(others).alias("p", "b"))
            .select("query_id", (F.col("p") + 1).alias("rank"), F.col("b.v").alias("vec_id"), (-F.col("b.s")).alias("score")))
