"""Secret scanning with a trigram index, in SQL functions only.

Every rule's regular expression is parsed into a Boolean query of trigrams that any match must contain. The index has a
posting (trigram, document) for every trigram that some rule asks for. A rule's candidates are the intersections of
postings that fulfil its query; only they are verified with the expression. Rules without a mandatory trigram scan
every text. Index and queries are in lower case, so one index serves rules with and without case.

Matches are the leftmost non-overlapping ones of each rule; positions count code points from 0, ends are exclusive.
Defined results: a null text is empty and has no span; repeated rows get equal spans each; documents without candidates
keep an empty list; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlas.llm.common import join_back, let, row_key, staged

MOST_BRANCHES = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` is read alike by Java and Python; ``group`` must have ``least`` characters or the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three kinds every scan reports, then further well-known token formats.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
FURTHER_RULES = (
    Rule("forge", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)

Query = frozenset[frozenset[str]]   # any of these sets of trigrams, all of a set
ANY: Query = frozenset([frozenset()])


def trigram_query(pattern: str) -> Query:
    """Trigrams, lower-cased, that every match of ``pattern`` contains: alternatives of conjunctions, ``ANY`` if none is sure."""
    texts = _literals(list(re._parser.parse(pattern)))
    branches = set()
    for runs in texts:
        branches.add(frozenset(run[i:i + 3] for run in runs for i in range(len(run) - 2)))
    least = frozenset(b for b in branches if not any(other < b for other in branches))
    return ANY if len(least) > MOST_BRANCHES else least


def _literals(nodes: list) -> list[tuple[str, ...]]:
    """Alternatives, each the runs of literal text in order; runs are parted where anything may stand."""
    out: list[tuple[str, ...]] = [("",)]
    for op, value in nodes:
        name = str(op)
        if name == "LITERAL":
            step = [(chr(value).lower(),)]
        elif name == "SUBPATTERN":
            step = _literals(list(value[-1]))
        elif name == "BRANCH":
            step = [alt for branch in value[1] for alt in _literals(list(branch))]
        elif name == "MAX_REPEAT" and value[0] == 0 and value[1] == 1:
            step = [("",), *_literals(list(value[2]))]
        elif name == "MAX_REPEAT" and value[0] > 0:
            step = [("", *runs, "") for runs in _literals(list(value[2]))]
        elif name == "IN" and len(members := _members(value)) and len(members) <= 5:
            step = [(c,) for c in members]
        elif name == "AT":
            step = [("",)]
        else:
            step = [("", "")]
        out = [(*left[:-1], left[-1] + right[0], *right[1:]) for left in out for right in step]
        if len(out) > MOST_BRANCHES * 8:
            return [("", "")]
        out = list(dict.fromkeys(out))
    return out


def _members(parts: list) -> list[str]:
    found: set[str] = set()
    for op, value in parts:
        if str(op) == "LITERAL":
            found.add(chr(value).lower())
        elif str(op) == "RANGE" and value[1] - value[0] < 8:
            found.update(chr(c).lower() for c in range(value[0], value[1] + 1))
        else:
            return []
    return sorted(found)


def index(documents: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (k_id, k_hash, trigram) of the asked trigrams, each once per document."""
    quoted = "|".join(re.escape(t) for t in sorted(trigrams))
    lower = F.translate(F.coalesce("text", F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    found = F.array_distinct(F.regexp_extract_all(lower, F.lit(f"(?=({quoted}))"), F.lit(1)))
    return documents.select(*row_key(F.col("doc_id"), F.col("text")), F.explode(found).alias("trigram"))


def candidates(documents: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(k_id, k_hash, rules): names of the indexed rules whose trigram query the document fulfils."""
    queries = [(r.kind, b, t, len(branch)) for r in rules if (q := trigram_query(r.pattern)) != ANY
               for b, branch in enumerate(sorted(map(sorted, q))) for t in branch]
    spark = documents.sparkSession
    if not queries:
        return documents.select(*row_key(F.col("doc_id"), F.col("text")), F.array().cast("array<string>").alias("rules")).limit(0)
    asked = spark.sql("SELECT inline(array(" + ", ".join(f"named_struct('rule', '{r}', 'branch', {b}, 'trigram', '{_sql(t)}', 'needed', {n})" for r, b, t, n in queries) + "))")
    postings = index(documents, sorted({q[2] for q in queries})).distinct()
    met = (postings.join(F.broadcast(asked), "trigram")   # the rules' own trigrams: some hundred rows at most
           .groupBy("k_id", "k_hash", "rule", "branch", "needed").agg(F.count("*").alias("n")).where("n = needed"))
    return met.groupBy("k_id", "k_hash").agg(F.collect_set("rule").alias("rules"))


def _sql(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def find(text: Column, rule: Rule) -> Column:
    """array<struct<kind, start, end>> of the rule's matches: texts between matches give their places."""
    pattern = F.lit(rule.pattern)
    gaps, whole = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    step = F.transform(F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), kept.alias("kept")),
                       lambda m: F.struct(F.length(m["gap"]).alias("gap"), F.length(m["whole"]).alias("size"), F.length(m["kept"]).alias("kept")))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")

    def add(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        span = F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), (start + m["size"]).alias("end"))
        return F.struct((start + m["size"]).alias("at"), F.when(m["kept"] >= rule.least, F.concat(state["spans"], F.array(span))).otherwise(state["spans"]).alias("spans"))

    return F.aggregate(step, F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans")), add)["spans"]


def scan(documents: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + FURTHER_RULES) -> DataFrame:
    """doc_id and spans (kind, start, end), by start and then in the order of ``rules``, for every row."""
    indexed = {r.kind for r in rules if trigram_query(r.pattern) != ANY}
    found = staged(candidates(documents, rules), "candidates")
    rows = documents.select(*row_key(F.col("doc_id"), F.col("text")), F.coalesce("text", F.lit("")).alias("text"))
    checked = join_back(rows, found)
    nothing = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    parts = []
    for rank, rule in enumerate(rules):
        spans = F.transform(find(F.col("text"), rule), lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["kind"].alias("kind"), s["end"].alias("end")))  # noqa: B023
        parts.append(F.when(F.array_contains("rules", rule.kind), spans).otherwise(nothing) if rule.kind in indexed else spans)
    ordered = F.array_sort(F.concat(*parts))
    return checked.select(F.col("k_id").alias("doc_id"), let(ordered, lambda a: F.transform(a, lambda s: F.struct(s["kind"], s["start"], s["end"]))).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
