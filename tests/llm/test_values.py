"""Operators on vectors, keys, personal values and languages; the pipeline on a small folder."""

import collections
import math
import re
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from atlas.llm import language_id, pii, sharding, topk_search
from atlas.llm.queries import ORACLES, QUERIES
from atlas.queries.base import Query
from tests.compare import compare, connect
from tests.llm.data import SCHEMA, documents


@pytest.fixture(scope="module")
def con(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, con, folder, name):
    ok, note = compare(spark, con, folder, name, Query(QUERIES[name], ORACLES[name]))
    assert ok, note


def brute_top(rows, k, query):
    out = {}
    usable = {}
    for i, v, *_ in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(64 * x) for x in v]
    for q in usable:
        if query(q):
            scores = sorted((-sum(a * b for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q and len(v) == len(usable[q]))
            out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("scale", [1.0, 1e5])
def test_top_k_with_ties_and_copies(spark, monkeypatch, scale):
    monkeypatch.setattr(topk_search, "VECTOR_BLOCK", 50)
    monkeypatch.setattr(topk_search, "QUERY_BLOCK", 16)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) * scale for x in rng.integers(-2, 3, 4) / 8], 1, "r") for i in range(300)]
    rows += [(300 + i, [0.25 * scale, 0.5 * scale, 0.0, 0.0], 1, "r") for i in range(150)]
    rows += [(500, None, 1, "r"), (520, [1.0, None, 0.0, 0.0], 1, "r"), (540, [float("nan")] * 4, 1, "r"), (560, [float("inf"), 0.0, 0.0, 0.0], 1, "r"), (None, [1.0] * 4, 1, "r"),
             (580, [9.0, 9.0], 1, "r"), (600, [1.0, 2.0], 1, "r"), (620, [], 1, "r"), rows[0], rows[20]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, key int, vec string").repartition(7)
    got = collections.defaultdict(list)
    for r in topk_search.top_k(frame, F.col("vec_id") % 20 == 0, k=5).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    want = {q: v for q, v in brute_top(rows, 5, lambda q: q % 20 == 0).items() if v}
    assert {q: sorted(v) for q, v in got.items()} == want


def test_top_k_where_ids_repeat_with_other_vectors(spark, monkeypatch):
    """An id's own vectors never push other candidates out, however many it has."""
    monkeypatch.setattr(topk_search, "VECTOR_BLOCK", 16)
    rng = np.random.default_rng(2)
    draw = lambda: [float(x) for x in rng.integers(-3, 4, 4) / 8]
    rows = [(20, [v * 4 for v in draw()]) for _ in range(30)] + [(i, draw()) for i in range(1, 40)] + [(40, draw()), (40, draw()), (60, draw())]
    rows += [(7, rows[0][1]), (60, rows[1][1]), (21, rows[0][1])]   # other ids with a vector of id 20
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = collections.defaultdict(list)
    for r in topk_search.top_k(frame, F.col("vec_id") % 20 == 0, k=5).collect():
        got[r.query_id].append((r["rank"], r.score))
    whole = [(i, tuple(math.floor(64 * x) for x in v)) for i, v in rows]
    for q in (20, 40, 60):   # every different vector of an id asks; candidates are all rows of other ids, each different vector once
        want = []
        for vec in {v for i, v in whole if i == q}:
            scores = sorted((-sum(a * b for a, b in zip(vec, v)), i) for i, v in set(whole) if i != q)
            want += [(rank + 1, -s) for rank, (s, _) in enumerate(scores[:5])]
        assert sorted(got[q]) == sorted(want)


def test_top_k_of_nothing(spark):
    assert topk_search.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_lookup_table_shares_and_moves():
    shards = {f"s{i}": 1 for i in range(20)} | {"big": 3}
    table = sharding.lookup_table(shards, 4099)
    share = collections.Counter(table)
    light = [share[s] for s in shards if s != "big"]
    assert sum(share.values()) == 4099 and max(light) - min(light) <= 1 and 2.9 < share["big"] / statistics.mean(light) < 3.1
    without = sharding.lookup_table({s: w for s, w in shards.items() if s != "s7"}, 4099)
    moved = sum(a != b for a, b in zip(table, without) if a != "s7")
    assert moved < 0.15 * 4099
    for wrong in (({}, 7), ({"a": 0}, 7), ({"a": 1}, 8)):
        with pytest.raises(ValueError):
            sharding.lookup_table(*wrong)


def test_turns_follow_preferences():
    """The table by the rule as it reads: in turn, each shard takes the first slot of its own order that is free."""
    shards, size, taken = {"a": 1, "b": 2, "c": 1}, 31, {}
    order = {n: [(sharding._digest(n, "offset") + j * (sharding._digest(n, "skip") % (size - 1) + 1)) % size for j in range(size)] for n in shards}
    while len(taken) < size:
        for name in sorted(shards):
            for _ in range(shards[name]):
                if len(taken) < size:
                    taken[next(s for s in order[name] if s not in taken)] = name
    assert sharding.lookup_table(shards, size) == [taken[s] for s in range(size)]


def test_rows_are_placed_and_written(spark, tmp_path):
    rows = spark.createDataFrame([(i if i % 9 else None, f"t{i}", "x", 1) for i in range(400)], "id long, text string, slot string, row int").withColumnRenamed("slot", "s")
    shards = {"a": 1, "b": 1, "c": 2}
    placed = sharding.assign(rows, F.col("id"), shards, 31)
    assert placed.count() == 400 and placed.where("id is null").select("shard").distinct().count() == 1
    sharding.write_shards(rows, F.col("id"), shards, str(tmp_path / "out"), 2, 31)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 400 and back.select("shard").distinct().count() == 3
    assert sharding.assign(rows.limit(0), F.col("id"), shards, 31).count() == 0


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_phones_and_dates_among_other_numbers(spark):
    """A number behind a phone is not part of it; spaces alone separate; days may come first."""
    texts = ["call +1 (555) 123-4567 123 now", "+1 (555) 123-4567", "555 123 4567", "(555) 123 4567 9", "555.123.4567", "+44 20 7946 0958", "on 12/31/1999, 31/12/1999, 31.12.1999 and 1999-12-31", "31/13/1999 99/99/9999", "1 22 333"]
    frame = spark.createDataFrame([(i, t, "old") for i, t in enumerate(texts)], "doc_id long, text string, pii_counts string")
    found = pii.pseudonymise(frame, "key")
    assert found.columns.count("pii_counts") == 1
    got = {r.doc_id: (r.text, r.pii_counts) for r in found.collect()}
    number = lambda i: re.sub("[^0-9]", "", got[i][0])
    behind = re.fullmatch(r"call (\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}) 123 now", got[0][0])
    assert behind[1] == got[1][0] != texts[1]
    assert number(1)[1:] == number(2) == number(3)[:-1] == number(4) and got[3][0].endswith(" 9") and re.fullmatch("[0-9]{3} [0-9]{3} [0-9]{4}", got[2][0])
    assert re.fullmatch(r"\+44 [0-9]{2} [0-9]{4} [0-9]{4}", got[5][0]) and got[5][0] != texts[5]
    m, d, y, d2, m2, y2, rest = re.fullmatch(r"on ([0-9]{2})/([0-9]{2})/([0-9]{4}), ([0-9]{2})/([0-9]{2})/([0-9]{4}), (.*)", got[6][0]).groups()
    assert (m, d, y) == (m2, d2, y2) != ("12", "31", "1999") and rest == f"{d}.{m}.{y} and {y}-{m}-{d}"
    assert got[7][0] == texts[7] and got[8][0] == texts[8]
    assert [got[i][1]["phone"] for i in range(6)] == [1] * 6 and got[6][1]["date"] == 4


def test_pseudonyms_keep_formats_and_links(spark):
    texts = ["mail a.b@mail.example.com, +1 (743) 555-3824!! 227.5.221.1. 4785380592391139 4111111111111111 4111-1111-1111-1111",
             "2024-02-30 2024-02-29 02/29/2024 29.02.2024 123-45-6789 000-12-3456 666-11-1111 300.1.1.1 4111111111111112 (743) 555-3824", "", None, "no digits",
             "x" * 30_000 + " 4111 1111 1111 1111", "A.B@MAIL.example.com 4111111111111111"]
    rows = [(i, t, "r", {"k": 1}) for i, t in enumerate(texts)] + [(1, texts[1], "r", None), (None, texts[0], "r", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, row string, found map<string,int>")
    got = {(r.doc_id, r.text): r.pii_counts for r in pii.pseudonymise(frame, "key").collect()}
    by = {i: t for i, t in got}
    assert len(got) == len(rows) - 1 and by[2] == "" and by[3] is None and by[4] == "no digits" and by[None] == by[0]
    cards = re.findall(r"[0-9]{16}|[0-9]{4}(?:[ -][0-9]{4}){3}", by[0] + by[5])
    assert len(cards) == 4 and all(luhn(re.sub("[^0-9]", "", c)) for c in cards)
    assert len({re.sub("[^0-9]", "", c) for c in cards[1:]}) == 1 and cards[2].count("-") == 3 and cards[3].count(" ") == 3
    assert not {"4785380592391139", "4111111111111111"} & set(cards)
    a, b = re.search(r"\+1 (\([0-9]{3}\) [0-9]{3}-[0-9]{4})!!", by[0])[1], re.search(r"\([0-9]{3}\) [0-9]{3}-[0-9]{4}$", by[1])[0]
    assert a == b != "(743) 555-3824"
    assert "2024-02-30" in by[1] and "000-12-3456" in by[1] and "666-11-1111" in by[1] and "300.1.1.1" in by[1] and "4111111111111112" in by[1]
    y, m, d = re.search(r"2024-02-30 ([0-9]{4})-([0-9]{2})-([0-9]{2})", by[1]).groups()
    assert f"{m}/{d}/{y} {d}.{m}.{y}" in by[1]
    assert re.search(r"p[0-9a-f]{16}@example.org", by[0])[0] in by[6] and "mail.example" not in by[0]
    assert got[1, by[1]]["date"] == 3 and got[1, by[1]]["ssn"] == 1 and got[0, by[0]] == {"email": 1, "card": 3, "ipv4": 1, "date": 0, "ssn": 0, "phone": 1}
    other = {r.doc_id: r.text for r in pii.pseudonymise(frame, "other key").collect()}
    assert other[0] != by[0]
    assert pii.pseudonymise(frame.limit(0), "key").count() == 0


@pytest.mark.parametrize("a,b", [(1, 7), (10, 10), (189, 773), (898, 33)])
def test_feistel_is_a_permutation(spark, a, b):
    image = spark.range(a * b).select(pii.feistel(F.col("id"), F.lit(a).cast("long"), F.lit(b).cast("long"), "key", "kind").alias("v"))
    row = image.agg(F.count_distinct("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).first()
    assert (row.n, row.lo, row.hi) == (a * b, 0, a * b - 1)


def test_dates_and_numbers_permute(spark):
    days = spark.range(146097).select(pii._date(F.date_add(F.lit("1800-01-01").cast("date"), F.col("id").cast("int")).cast("string"), "k").alias("v"))
    assert days.agg(F.count_distinct("v"), F.min("v"), F.max("v")).first()[:] == (146097, "1800-01-01", "2199-12-31")
    numbers = spark.range(1000).select(pii._number(F.lpad(F.col("id").cast("string"), 3, "0"), "k", "n").alias("v"))
    assert numbers.agg(F.count_distinct("v"), F.min(F.length("v"))).first()[:] == (1000, 3)


def test_languages_held_out(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = QUERIES["op1_language_id"](spark, folder).join(docs.select("doc_id", "lang"), "doc_id")
    part = found.groupBy("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")).alias("right"), F.count("*").alias("n")).collect()
    assert {r.held_out for r in part} == {True, False} and all(r.right > 0.95 for r in part)
    assert found.where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_languages_of_awkward_rows(spark):
    docs = spark.createDataFrame(documents(), SCHEMA)
    found = language_id.identify(docs, language_id.train(docs))
    assert found.columns == ["lang_pred", "score", *docs.columns]
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in ("en", "fr")) == letters and (letters or (r.lang_pred, r.score) == ("und", 0))
    nothing = language_id.train(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}
    one = language_id.train(docs.where("lang = 'en'"))
    assert {(r.lang_pred, r.score) for r in language_id.identify(docs, one).collect()} == {("en", 1.0), ("und", 0.0)}
    assert language_id.identify(docs.limit(0), one).count() == 0


def test_letters_of_all_planes_count():
    assert language_id.gram_counts(["\U00030000\U00031350", "\U0002A700", "\U0010FFFF"]).any(axis=1).tolist() == [True, True, False]


def test_families_come_first():
    texts = {"en": "the house was there and with that ", "de": "das haus war dort und mit dem ", "fr": "la maison etait la et avec que ", "es": "la casa estaba alli y con el que ", "xx": "zq zq wk wk "}
    labels = np.array([k for k in texts for _ in range(20)], object)
    x = language_id.vectors([texts[k] * (i % 5 + 1) for i, k in enumerate(labels)]).astype(np.float32)
    family = np.array([language_id.FAMILY_OF.get(k, k) for k in labels], object)
    names = sorted(set(family))
    assert names == ["germanic", "romance", "xx"]
    model = language_id.Model(language_id.fit_pairs(names, x, family), {
        f: language_id.fit_pairs(sorted(set(labels[family == f])), x[family == f], labels[family == f]) for f in names}, language_id.FEATURES)
    assert model.predict([*texts.values(), None, "12"])[0] == [*texts, "und", "und"]
    assert len(model.families.weights) == 3 and len(model.languages["xx"].weights) == 0


def test_pipeline_stage_by_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, names = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, folder)
        assert after.columns == columns, name
        names.append((name, docs.count(), after.count()))
        docs = after.cache()
    assert [n for n, *_ in names] == ["language_id", "line_dedup", "ngram_jaccard_join", "decontamination"]
    assert names[1][1] == names[1][2] and names[2][1] > names[2][2] and names[3][1] > names[3][2]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_texts_of_no_learned_language_go(spark):
    import base64
    import random

    rng = random.Random(6)
    strange = [base64.b64encode(rng.randbytes(300)).decode() for _ in range(5)]
    strange += [" ".join("".join(rng.choices("абвгдежзиклмнопрст", k=rng.randint(2, 9))) for _ in range(60)) for _ in range(5)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*corpus_pipeline.COLUMNS)   # 200 rows teach too little
    rows = spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(strange)], docs.schema)
    kept = corpus_pipeline.in_known_language(spark, docs.unionByName(rows), "").cache()
    assert kept.where("doc_id < 0").count() == 0
    clean = docs.where(language_id.held_out(F.col("doc_id")) & (F.length("text") >= 100))
    assert clean.join(kept, "doc_id", "left_anti").count() == 0 < clean.count()


def test_pipeline_of_awkward_rows(spark, folder, tmp_path):
    awkward = [r[:5] for r in documents()]
    frame = spark.createDataFrame(awkward, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (frame, frame.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, folder).cache()
            docs.count()
