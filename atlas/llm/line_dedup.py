"""Removal of recurring lines by a tree of log templates.

A line's tokens that hold a digit are variable fields (``<*>``). The tree's path to a leaf has fixed depth: the number of
tokens, then the first ``depth`` tokens. Inside a leaf the template has at every place the token that most lines of the
leaf share there, and a variable field where no more than ``agree`` of them do. The path's tokens agree by construction and
say nothing, nor do fields: beyond the path, ``least_fixed`` places and half of them must have a token, and a line belongs to
its leaf's template if at least ``similar`` of these tokens are its own; other lines are templates of their own, equal after
masking. A template that occurs in ``min_docs`` documents or more recurs, and its lines are dropped
from every document but the first (smallest doc_id), which keeps its first one. For a template that has a line of
``long_bytes`` bytes or more, ``long_docs`` documents are enough: about twenty words, or 33 letters of a script without
spaces, do not meet by chance, while a few words do.

Leaves that too few documents reach, or whose lines are all equal or too short to fit, need no template, so only one line of
each kind in the others is read again and looked at token by token.
Lines of fewer than ``min_tokens`` tokens always stay; the query and the pipeline pass ``EVERY_LINE``, so that all lines
that are not blank go through the tree. A line no longer than the path is its own leaf and template, equal after masking. A
line with more fields than other tokens says nothing once masked and equals only the same line unmasked.

Defined results: a null text stays null with no lines, an empty one has one empty line; blank lines stay, also those of
Unicode white space; rows repeated under one doc_id are one document in counts of documents, and each is rewritten; a null
doc_id counts as one document, the smallest; an empty table gives an empty result; all columns stay and n_lines and
n_dropped are added or replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.llm.common import join_back, row_key, small, staged

DEPTH, MIN_DOCS, MIN_TOKENS = 3, 3, 4
LONG_BYTES, LONG_DOCS = 100, 2
LEAST_FIXED = 2   # tokens beyond the path by which a leaf's template is known
EVERY_LINE = 1   # min_tokens by which only blank lines stay out of the tree
AGREE, SIMILAR = 0.5, 0.7
FIELD = "<*>"


def plain_tokens(line: Column) -> Column:
    return F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda t: t != "")


def masked_tokens(line: Column) -> Column:
    tokens = plain_tokens(line)
    return F.when(line.rlike("[0-9]"), F.transform(tokens, lambda t: F.when(t.rlike("[0-9]"), F.lit(FIELD)).otherwise(t))).otherwise(tokens)


def _lines(documents: DataFrame, depth: int, min_docs: int, min_tokens: int, long_bytes: int, long_docs: int) -> DataFrame:
    """(k_id, k_hash, at, leaf, own, least, n_tokens): lines that can be templates.

    ``own`` is the hash of the masked line, or of the line if most of it is fields; ``least`` is the number of documents
    in which the line's template must occur.
    """
    lines = documents.where(F.col("text").isNotNull()).select(
        *row_key(F.col("doc_id"), F.col("text")), F.posexplode(F.split("text", "\n", -1)).alias("at", "line"))
    tokens = F.explode(F.array(masked_tokens(F.col("line")))).alias("tokens")
    worded = (F.length("line") >= 2 * min_tokens - 1) & F.col("line").rlike(r"(?U)\S")
    fields = F.size(F.filter("tokens", lambda t: t == FIELD))
    own = F.when(2 * fields > F.size("tokens"), F.xxhash64(plain_tokens(F.col("line")))).otherwise(F.xxhash64("tokens"))
    least = F.when(F.octet_length("line") >= long_bytes, F.lit(min(long_docs, min_docs))).otherwise(F.lit(min_docs))
    return (lines.where(worded).select("k_id", "k_hash", "at", "line", tokens).where(F.size("tokens") >= min_tokens)
            .select("k_id", "k_hash", "at", F.xxhash64(F.size("tokens"), F.slice("tokens", 1, depth)).alias("leaf"), own.alias("own"),
                    least.alias("least"), F.size("tokens").alias("n_tokens")))


def _frequent(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur in ``least`` documents or more; a key's documents are made distinct before they meet."""
    documents = rows.groupBy(key, "k_id").agg(F.min("least").alias("least"))
    return documents.groupBy(key).agg(F.count("*").alias("docs"), F.min("least").alias("least")).where(F.col("docs") >= F.col("least")).select(key)


def templates(lines: DataFrame, depth: int, agree: float, similar: float, least_fixed: int) -> DataFrame:
    """(leaf, own, template) of the different masked lines: their leaf's template if they fit it, or their own.

    ``lines`` has leaf, own, tokens and n, the number of times the line occurs.
    """
    total = lines.groupBy("leaf").agg(F.sum("n").alias("all"))
    at_place = lines.select("leaf", "n", F.posexplode("tokens").alias("place", "token")).groupBy("leaf", "place", "token").agg(F.sum("n").alias("n"))
    best = at_place.groupBy("leaf", "place").agg(F.max(F.struct("n", "token")).alias("best"))
    fixed = best.join(total, "leaf").withColumn("keep", F.when(F.col("best.n") > agree * F.col("all"), F.col("best.token")).otherwise(FIELD))
    tree = fixed.groupBy("leaf").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "keep"))), lambda x: x["keep"]).alias("model"))
    beyond = F.slice("model", depth + 1, F.size("model"))
    fixed_places = F.size(F.filter(beyond, lambda m: m != FIELD))
    equal = F.zip_with(F.slice("tokens", depth + 1, F.size("tokens")), beyond, lambda t, m: ((t == m) & (m != FIELD)).cast("int"))
    same = F.aggregate(equal, F.lit(0), lambda s, x: s + x)
    says_enough = (fixed_places >= least_fixed) & (fixed_places * 2 >= F.size(beyond))
    fits = says_enough & (same >= similar * fixed_places)
    return lines.join(tree, "leaf").select("own", F.when(fits, F.xxhash64("leaf", F.lit("leaf"))).otherwise(F.col("own")).alias("template"))


def dropped_lines(documents: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS,
                  agree: float = AGREE, similar: float = SIMILAR, long_bytes: int = LONG_BYTES, long_docs: int = LONG_DOCS,
                  least_fixed: int = LEAST_FIXED) -> DataFrame:
    """(k_id, k_hash, at, template): the lines to drop."""
    brief = staged(_lines(documents, depth, min_docs, min_tokens, long_bytes, long_docs), "lines")
    leaves = staged(_frequent(brief, "leaf"), "leaves")
    near = staged(brief.join(small(leaves, 16), "leaf", "left_semi"), "near")
    place = F.min(F.when(F.col("n_tokens") >= depth + least_fixed, F.struct("k_id", "k_hash", "at"))).alias("place")
    counts = staged(near.groupBy("leaf", "own").agg(F.count("*").alias("n"), place), "counts")
    varied = counts.groupBy("leaf").agg(F.count("*").alias("different")).where("different > 1").select("leaf")
    # one line of each kind is read again, from the place where it was seen first
    asked = (counts.join(varied, "leaf", "left_semi").where("place IS NOT NULL").groupBy("place.k_id", "place.k_hash")
             .agg(F.collect_list(F.struct("leaf", "own", "n", F.col("place.at").alias("at"))).alias("asked")))
    rows = documents.select(*row_key(F.col("doc_id"), F.col("text")), "text")
    found = join_back(rows, small(staged(asked, "asked"), 200), "inner").select(F.split("text", "\n", -1).alias("lines"), F.explode("asked").alias("a"))
    different = found.select("a.leaf", "a.own", "a.n", masked_tokens(F.get("lines", F.col("a.at"))).alias("tokens"))
    different = staged(different.dropDuplicates(["leaf", "own"]), "different")   # repeated rows show the same line
    which = staged(templates(different, depth, agree, similar, least_fixed).where(F.col("template") != F.col("own")), "templates")
    placed = staged(near.drop("leaf", "n_tokens").join(which, "own", "left").withColumn("template", F.coalesce("template", "own")), "placed")
    first = placed.groupBy("template").agg(F.min(F.struct("k_id", "k_hash", "at")).alias("first"))
    recurring = staged(_frequent(placed, "template").join(first, "template"), "recurring")
    # both sides are read and dealt for this join alone, so a template that fills a third of the rows can be split
    return (placed.join(recurring, "template").where(~F.struct("k_id", "k_hash", "at").eqNullSafe(F.col("first")))
            .select("k_id", "k_hash", "at", "template"))


def drop_recurring_lines(documents: DataFrame, **options) -> DataFrame:
    """The rows with their text rewritten, n_lines and n_dropped."""
    gone = staged(dropped_lines(documents, **options).groupBy("k_id", "k_hash").agg(F.collect_set("at").alias("gone")), "gone")
    rows = documents.drop("n_lines", "n_dropped").select(F.struct("*").alias("row"), *row_key(F.col("doc_id"), F.col("text")))
    text = F.col("row.text")
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda _, i: ~F.array_contains("gone", i)), "\n")
    new = F.when(F.col("gone").isNotNull(), kept).otherwise(text)
    return join_back(rows, small(gone, 100)).select(
        F.col("row").withField("text", new).alias("row"),
        F.coalesce(F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped")).select("row.*", "n_lines", "n_dropped")
