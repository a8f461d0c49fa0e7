"""The operators applied to the driver's tables, with DuckDB twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atlas.llm import (
    decontamination,
    jaccard_join,
    language_id,
    line_dedup,
    packing,
    phrase_mining,
    pii,
    secret_scan,
    sharding,
    source_mixing,
    spelling_variants,
    substring_dedup,
    topk_search,
)
from atlas.llm.common import table, tokenizer_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return register


@query("op1_language_id")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    found = language_id.identify(documents.select("doc_id", "text"), language_id.train(documents))
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


TOPK_ORACLE = """
WITH quantised AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, v.vec_id, CAST(list_sum(list_transform(list_zip(q.vec, v.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM quantised q JOIN quantised v ON v.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 20
"""


@query("op2_topk_search", TOPK_ORACLE)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op3_packing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokenizer_path(spark, "word_bpe_49k.json"))


SPACE_WORDS = r"list_filter(string_split_regex({0}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

REPEATS_ORACLE = f"""
WITH d AS (SELECT doc_id, {SPACE_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
later AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS p FROM (SELECT doc_id, unnest(range(i, i + 20)) AS p FROM later) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(len(p), 0) AS n_removed,
  sha256(array_to_string(CASE WHEN p IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(p, i)) END, ' ')) AS kept_sha256 FROM d LEFT JOIN gone USING (doc_id)
"""


@query("op4_substring_dedup", REPEATS_ORACLE)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


@query("op5_line_dedup")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.drop_recurring_lines(table(spark, folder, "documents").select("doc_id", "text"), min_tokens=line_dedup.EVERY_LINE)
    return found.select("doc_id", "n_lines", "n_dropped", "text")


@query("op6_secret_scan")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan(table(spark, folder, "documents"))
    base = [r.kind for r in secret_scan.BASE_RULES]
    own = F.filter("spans", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id", *[F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}") for k in base],  # noqa: B023
        F.sha2(secret_scan.joined(own), 256).alias("base_sha256"), secret_scan.joined(F.col("spans")).alias("spans"))


SHARDS = {f"shard-{i:03d}": 1 + (i < 8) for i in range(64)}   # the first eight take double shares
SHARD_TABLE = sharding.lookup_table(SHARDS)
SHARD_NAMES = sorted(SHARDS)
SHARD_ORACLE = f"""
WITH slots AS (SELECT string_split('{",".join(str(SHARD_NAMES.index(n)) for n in SHARD_TABLE)}', ',') AS numbers),
placed AS (SELECT doc_id, CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) % {sharding.SIZE} AS slot FROM documents)
SELECT doc_id, slot, 'shard-' || lpad(numbers[slot + 1], 3, '0') AS shard FROM placed, slots
"""


@query("op7_sharding", SHARD_ORACLE)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents").select("doc_id"), F.col("doc_id"), SHARDS).select("doc_id", "slot", "shard")


JACCARD_ORACLE = f"""
WITH RECURSIVE d AS (SELECT doc_id, {SPACE_WORDS.format(FOLDED)} AS w FROM documents),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
reached AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) USING (doc_id)
"""


@query("op8_ngram_jaccard_join", JACCARD_ORACLE)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.components(table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op9_pii")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    key = spark.conf.get("spark.atlas.pii.key", "demonstration key")   # a real run names its own
    found = pii.pseudonymise(table(spark, folder, "documents").select("doc_id", "text"), key)
    return found.select("doc_id", "text", *[F.col("pii_counts")[k].alias(f"n_{k}") for k in pii.KINDS])


PLAIN_WORDS = rf"list_filter(string_split_regex({FOLDED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
LEAKS_ORACLE = f"""
WITH d AS (SELECT doc_id, {PLAIN_WORDS} AS w FROM documents),
items AS (SELECT item_id, w, least(len(w), 10) AS n FROM (SELECT item_id, {PLAIN_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
places AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (n, s)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query("op10_decontamination", LEAKS_ORACLE)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = decontamination.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.drop("spans", "items")


PHRASES_ORACLE = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({FOLDED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
worded AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, range(1, 6) AS t(k) WHERE len(w) >= k)),
often AS (SELECT lang, k, s, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
parts AS (SELECT *, string_split(s, ' ') AS w FROM often WHERE k > 1),
longer AS (SELECT lang, s, max(a) AS longest FROM (SELECT lang, a, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:k], ' ')]) AS s FROM parts WHERE k > 2) GROUP BY ALL),
cuts AS (SELECT p.lang, p.s, p.a, c, l.a AS l, r.a AS r, n, CAST(CAST(1000 AS HUGEINT) * p.a * n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS c FROM parts LEFT JOIN longer USING (lang, s) WHERE longest IS NULL OR longest < a) p
  JOIN often l ON l.lang = p.lang AND l.s = array_to_string(p.w[1:c], ' ') JOIN often r ON r.lang = p.lang AND r.s = array_to_string(p.w[c + 1:p.k], ' ')
  JOIN totals t ON t.lang = p.lang),
worst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, s ORDER BY score, c) AS i FROM cuts) WHERE i = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank FROM worst)
SELECT lang, rank, s AS phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


@query("op11_phrase_collocations", PHRASES_ORACLE)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, folder, "documents"))


@query("op12_spelling_variants")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.variants(spelling_variants.vocabulary(table(spark, folder, "documents"), noise=31))


def permuted_sql(x: str, n: str, seed: str, turns: str = "range(24)") -> str:
    swap = f"""list_transform([((k * 2147483648 + k * 48271 % 2147483647) % {n} + {n} - v) % {n}], lambda y: list_transform(
      [(greatest(v, y) % 2147483647 * 16807 + greatest(v, y) // 2147483647 * 40503 + k) % 2147483647], lambda z: CASE WHEN z * z % 2147483647 // 128 % 2 = 1 THEN y ELSE v END)[1])[1]"""
    return f"""list_reduce(list_prepend(CAST({x} AS BIGINT), {turns}), lambda v, r: list_transform([({seed} + r * 1000003) % 2147483647],
      lambda h: list_transform([h * h % 2147483647], lambda k: {swap})[1])[1])"""


MIX_ORACLE = f"""
WITH docs AS (SELECT CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key, doc_id, CAST(len({SPACE_WORDS.format("coalesce(text, '')")}) AS BIGINT) AS size FROM documents),
sized AS (SELECT key, CAST(sum(size) AS BIGINT) AS source_size FROM docs GROUP BY key),
weighed AS (SELECT *, CAST(1 + (row_number() OVER (ORDER BY key) - 1) % 3 AS BIGINT) AS weight FROM sized),
sums AS (SELECT *, CAST(sum(source_size) OVER () AS BIGINT) - coalesce(CAST(sum(3 * source_size) OVER below AS BIGINT), 0) AS words,
  CAST(sum(weight) OVER () AS BIGINT) - coalesce(CAST(sum(weight) OVER below AS BIGINT), 0) AS weights FROM weighed
  WINDOW below AS (ORDER BY 3.0 * source_size / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT CAST(words AS DOUBLE) / weights AS level FROM sums WHERE CAST(words AS DOUBLE) / weights * weight <= 3 * source_size ORDER BY 3.0 * source_size / weight, key LIMIT 1),
wanted AS (SELECT key, source_size, least(CAST(3 * source_size AS DOUBLE), level * weight) AS target FROM weighed, level),
cut AS (SELECT *, CAST(round(target) AS BIGINT) AS want, (source_size + 1023) // 1024 AS blocks, CAST('0x' || substr(md5('1:' || key), 1, 7) AS BIGINT) AS seed FROM wanted WHERE source_size > 0),
passes AS (SELECT *, source_size - (blocks - 1) * 1024 AS last, want // source_size AS whole, want % source_size AS due FROM cut),
ended AS (SELECT *, {permuted_sql("blocks - 1", "blocks", "(seed + whole)", "range(23, -1, -1)")} AS last_at FROM passes),
counted AS (SELECT *, whole * blocks + (due + 1023) // 1024
  + CASE WHEN last_at < (due + 1023) // 1024 AND (due + 1023) // 1024 * 1024 - (1024 - last) < due THEN 1 ELSE 0 END AS slots FROM ended),
begun AS (SELECT *, CAST(coalesce(sum(slots) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
  CAST(sum(slots) OVER () AS BIGINT) AS every, CAST('0x' || substr(md5('1:places'), 1, 7) AS BIGINT) AS place_seed FROM counted),
seats AS (SELECT *, j // blocks AS pass, j % blocks AS seat, start + j AS dealt FROM (SELECT *, unnest(range(0, slots)) AS j FROM begun WHERE slots > 0)),
placed AS (SELECT *, {permuted_sql("seat", "blocks", "(seed + pass)")} AS block, {permuted_sql("dealt", "every", "place_seed")} // 256 AS shard FROM seats),
takes AS (SELECT key, block, shard, CASE WHEN block = blocks - 1 THEN last ELSE 1024 END AS length,
  CASE WHEN pass < whole THEN length ELSE least(length, due - (seat * 1024 - CASE WHEN last_at < seat THEN 1024 - last ELSE 0 END)) END AS take FROM placed),
streams AS (SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY key ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS begin FROM docs),
pieces AS (SELECT *, unnest(range(begin // 1024, (begin + size - 1) // 1024 + 1)) AS block FROM streams WHERE size > 0),
held AS (SELECT doc_id, shard, greatest(0, least(begin + size, block * 1024 + take) - greatest(begin, block * 1024)) AS words FROM pieces JOIN takes USING (key, block)),
summed AS (SELECT doc_id, CAST(sum(words) AS BIGINT) AS taken, min(shard) FILTER (words > 0) AS first_shard FROM held GROUP BY doc_id)
SELECT doc_id, size, source_size, coalesce(target, 0) AS target, coalesce(taken, 0) AS taken, coalesce(first_shard, -1) AS first_shard
FROM docs JOIN wanted USING (key) LEFT JOIN summed USING (doc_id)
"""


@query("op13_source_mixing", MIX_ORACLE)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return source_mixing.taken(table(spark, folder, "documents"))
