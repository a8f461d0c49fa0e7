"""The written token index: what it finds, what it covers, and how little of it a lookup reads."""

import pytest
from pyspark.sql import functions as F

from atlas.gates.address import address_gate
from atlas.operators import search, token_index
from atlas.plans.address_index import AddressIndex
from atlas.sources import sinks


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("address"))
    street = spark.createDataFrame([
        (1, "Strada București", ["улица Бухарестская"], "Chișinău", 47.0, 28.8, 3, 10, ["Кишинёв", "Кишинев"]),
        (2, "Ленинградская улица", None, "Бендеры", 46.8, 29.4, 1, 20, ["Bender"]), (3, "Leningrad", None, "", 46.8, 29.4, 1, None, None), (4, "—", None, "Alba", 46.0, 29.0, 1, 10, None)],
        "id bigint, name string, aliases array<string>, city string, lat double, lon double, houses int, locality int, city_alt array<string>")
    locality = spark.createDataFrame([(10, "Кишинёв", ["Chișinău", "Кишинев"], "city", "", 7, 47.0, 28.8, 700, 4), (20, "Bender", None, "town", "", None, 46.8, 29.4, 90, 1)],
                                     "id int, name string, aliases array<string>, kind string, district string, commune int, lat double, lon double, pop int, houses int")
    commune = spark.createDataFrame([(7, "Albești", "Comuna Albești", None, "")], "id int, name string, display string, aliases array<string>, district string")
    house = spark.createDataFrame([(1, "10a", 4, "10A", 470000000, 288000000), (2, "1", 8, None, 468000000, 294000000)], "street int, key string, osm int, num string, lat_e7 int, lon_e7 int")
    sinks.write_address_tables(AddressIndex(street, house, locality, commune, None), path)
    return path


def found(spark, path, table, query):
    return sorted(r.key for r in token_index.match(token_index.read_tokens(spark, path, table), query).collect())


@pytest.mark.parametrize("table, query, keys", [
    ("street", "bucuresti", [1]), ("street", "БУХАР*", [1]), ("street", "chisinau bucuresti", [1]), ("street", "bender* ленинградская*", [2]), ("street", "кишинев*", [1]),
    ("street", "leningrad", [3]), ("street", "ленин* strada", []), ("street", "name:bender", []), ("street", "city_alt:bender", [2]), ("street", "albesti*", []),
    ("locality", "кишинев", [10]), ("locality", "кишинёв", [10]), ("commune", "albest*", [7]), ("commune", "comuna", []), ("street", "  *", []), ("street", "", [])])
def test_search(spark, written, table, query, keys):
    assert found(spark, written, table, query) == keys


def test_gate_counts_covered_rows(spark, written):
    read = lambda name: spark.read.parquet(f"{written}/{name}")
    names = ("street", "locality", "commune")
    tokens = {n: token_index.read_tokens(spark, written, n) for n in names}
    assert {r.table: r.n for r in token_index.covered_rows(tokens).collect()} == {"street": 4, "locality": 2, "commune": 1}   # street 4 has no token and is covered
    rules = lambda some: {r.rule for r in address_gate(read("street"), read("house"), read("locality"), read("commune"), read("meta"), token_index.covered_rows(some)).collect()}
    assert rules(tokens) == {"streets without locality"}
    assert rules(tokens | {"street": tokens["street"].where("key <> 2")}) == {"streets without locality", "index does not cover street"}


def scan(df):
    """The rows its scans gave and their description, after a run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [(leaves.apply(i).metrics().apply("numOutputRows").value(), leaves.apply(i).toString()) for i in range(leaves.size())]


def test_a_lookup_reads_a_few_row_groups(spark, tmp_path):
    rows = spark.range(60_000).select("id", F.concat(F.lit("word"), F.lpad(F.col("id").cast("string"), 6, "0"), F.lit(" common")).alias("name"))
    token_index.write_tokens(rows, "id", ["name"], f"{tmp_path}/t_token", row_group_bytes=64 << 10)
    tokens = token_index.read_tokens(spark, str(tmp_path), "t")
    assert tokens.count() == 180_000
    hit = tokens.where(F.col("token").startswith("word0123"))
    ((read, plan),) = scan(hit)
    assert hit.count() == 100 and read < 20_000 and "StringStartsWith(token,word0123)" in plan
    matched = token_index.match(tokens, "word0123* common")._jdf.queryExecution().executedPlan().toString()
    assert "Or(StringStartsWith(token,word0123),EqualTo(token,common))" in matched and matched.count("Exchange") == 1


def test_a_token_of_every_row_is_cut(spark, tmp_path):
    rows = spark.range(2000).select("id", F.lit("common").alias("name"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # parts this small would be written as one
    token_index.write_tokens(rows, "id", ["name"], f"{tmp_path}/t_token")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    tokens = token_index.read_tokens(spark, str(tmp_path), "t")
    assert tokens.where("token = 'common'").groupBy(F.input_file_name()).count().count() > 1


def test_same_text_twice_and_nulls(spark):
    rows = spark.createDataFrame([(1, "a a", None), (1, "a a", None), (2, None, ["b", None]), (None, "a", None)], "id int, name string, aliases array<string>")
    got = [(r.token, r.field, r.key) for r in token_index.token_rows(rows, "id", ["name", "aliases"]).collect()]
    assert sorted(got, key=str) == sorted([("", "", 1), ("", "", 2), ("", "", None), ("a", "name", 1), ("a", "name", None), ("b", "aliases", 2)], key=str)


def test_lookups_move_the_questions_only(spark, tmp_path):
    street = spark.range(500).select("id", (F.col("id") / 10).alias("lat"), F.lit(28.0).alias("lon"))
    house = spark.range(5000).select((F.col("id") % 500).alias("street"), (F.col("id") % 10).cast("string").alias("key"), (F.col("id") * 4).alias("osm"),
                                     F.lit(470000000).alias("lat_e7"), F.lit(280000000).alias("lon_e7"))
    names = sinks.write_lookup_tables(street, house, str(tmp_path), "lookup_test", buckets=8)
    asked = spark.createDataFrame([(3, "3"), (3, "99"), (499, "9"), (7, "7")], "street bigint, key string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = search.house_lookup(asked, spark.table(names[1]), spark.table(names[0]))
    rows = sorted((r.street, r.key, r.exact, r.lat) for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == [(3, "3", True, 47.0), (3, "99", False, 0.3), (7, "7", True, 47.0), (499, "9", True, 47.0)]
    assert plan.count("Bucketed: true") == 2 and plan.count("Exchange hashpartitioning") == 2 == plan.count("Exchange")   # the questions, by house and by street
    for name in names:
        spark.sql(f"DROP TABLE {name}")
