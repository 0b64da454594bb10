"""Search against a brute-force cross join, on all ways it may run."""

import json
import random

import pytest
from pyspark.sql import functions as F

from twinloom import model, vocab
from twinloom.operators import index as indexing, search
from twinloom.sources.tables import TWIN_COLUMNS

WORDS = ["north pump", "South Pump", "valve", "Ventil für Öl", "a", "", "pumpe\nnord", "x" * 40]
DEFAULTS = {"expiryTimeout": "3", "scope": "GLOBAL", "responseType": "FULL"}


def some_twins(spark, n=300, seed=5):
    """Twins of which a third share a host, a type and a label."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        properties = [
            (vocab.RDF_TYPE, "http://t/Car" if hot else f"http://t/{rng.randint(0, 5)}", "Uri", None, None),
            (vocab.RDFS_LABEL, "north pump" if hot else rng.choice(WORDS), "StringLiteral", None, None),
            (vocab.RDFS_COMMENT, rng.choice(WORDS), "LangLiteral", rng.choice(["en", "de"]), None),
            ("size", str(rng.randint(0, 9)), "Literal", None, rng.choice([None, "integer", vocab.XSD + "integer"])),
        ]
        properties += properties[:1] if i % 5 == 0 else []
        place = (rng.uniform(-90, 90), rng.uniform(-180, 180)) if i % 7 else (None, None)
        rows.append((f"h{0 if hot else rng.randint(0, 3)}", f"t{i}", *place, properties))
    return spark.createDataFrame(rows, f"host_id string, twin_id string, lat double, lon double, properties array<{model.PROPERTY}>")


def some_requests(spark, n=40, seed=9):
    rng = random.Random(seed)
    requests = [{}, {"text": ""}, {"text": "PUMP"}, {"text": "öl"}, {"text": "a"}, {"scope": "LOCAL"}, {"text": "e\nn"},
                {"location": {"lat": 9876, "lon": 0, "r": 1}}, {"properties": [{"key": "k"}]}, {"scope": "WORLD"},
                {"location": {"lat": 90, "lon": 0, "r": 3000}}, {"location": {"lat": 0, "lon": 180, "r": 2500}}]
    for _ in range(n):
        request = {}
        if rng.random() < 0.6:
            request["properties"] = rng.sample([
                {"key": vocab.RDF_TYPE, "uri": "http://t/Car"}, {"key": "size", "literal": str(rng.randint(0, 9)), "dataType": "integer"},
                {"key": vocab.RDFS_COMMENT, "langLiteral": "valve", "lang": "en"}, {"key": vocab.RDFS_LABEL, "stringLiteral": "valve"},
            ], rng.randint(1, 2))
        if rng.random() < 0.4:
            request["text"] = rng.choice(["pump", "valve", "North P", "xxx", "nothing like it", "lv"])
        if rng.random() < 0.4:
            request["location"] = {"lat": rng.uniform(-90, 90), "lon": rng.uniform(-180, 180), "r": rng.choice([300, 3000, 12000])}
        if rng.random() < 0.3:
            request["scope"] = "LOCAL"
        requests.append(request)
    rows = [(i, json.dumps(r)) for i, r in enumerate(requests)] + [(len(requests), '{"text":')]
    docs = spark.createDataFrame(rows, "request_id int, content string")
    return search.parse_requests(docs, DEFAULTS, "h0").drop("content")


def pairs(found):
    return sorted((r["request_id"], r["twin_id"]) for r in found.select("request_id", "twin_id").collect())


@pytest.fixture(scope="module")
def setup(spark):
    twins, requests = some_twins(spark).cache(), some_requests(spark).cache()
    brute = pairs(twins.crossJoin(requests.where("error is null")).where(search.satisfies()))
    assert len(brute) > 1000 and len(set(brute)) == len(brute)
    return twins, requests, brute


@pytest.mark.parametrize("options", [{}, {"max_rows": 0}], ids=["broadcast", "shuffled"])
def test_search_finds_what_brute_force_finds(setup, options):
    twins, requests, brute = setup
    assert pairs(search.search(twins, requests, **options)) == brute


def test_anchor_lists_too_long_for_a_plan_give_the_same(setup, monkeypatch):
    twins, requests, brute = setup
    monkeypatch.setattr(search, "MAX_LISTED", 1)
    assert pairs(search.search(twins, requests)) == brute


@pytest.mark.parametrize("options", [{}, {"max_rows": 0}], ids=["broadcast", "shuffled"])
def test_rows_that_repeat_their_ids_are_each_answered(spark, setup, options):
    twins, requests, _ = setup
    first = twins.limit(4)
    again = requests.where("error is null").withColumn("request_id", F.lit(1))
    stored = twins.union(first)
    brute = pairs(stored.crossJoin(again).where(search.satisfies()))
    assert pairs(search.search(stored, again, **options)) == brute


@pytest.mark.parametrize("text", ["\u0130a", "w", "wo", "O", "\u0130"])
def test_short_and_growing_texts_are_found(spark, setup, text):
    twins = setup[0].withColumn("properties", F.transform("properties", lambda p: F.when(
        p["key"] == vocab.RDFS_LABEL, p.withField("value", F.concat(p["value"], F.lit("two \u0130ab")))).otherwise(p)))
    docs = spark.createDataFrame([(1, json.dumps({"text": text, "properties": []}))], "request_id int, content string")
    requests = search.parse_requests(docs, DEFAULTS, "h0")
    brute = pairs(twins.crossJoin(requests).where(search.satisfies()))
    assert brute and pairs(search.search(twins, requests)) == brute
    anchors = search.request_anchors(requests).first()["options"]
    assert all("host:" not in a for o in anchors for a in o["anchors"])


def test_the_rarest_anchor_is_chosen(spark, setup):
    twins = setup[0]
    docs = spark.createDataFrame([(1, json.dumps({"properties": [
        {"key": vocab.RDF_TYPE, "uri": "http://t/Car"}, {"key": vocab.RDFS_COMMENT, "langLiteral": "not there", "lang": "en"}]}))], "request_id int, content string")
    optioned = search.request_anchors(search.parse_requests(docs, DEFAULTS, "h0"))
    needs = search.measure(optioned, 100, 10_000)
    assert needs.has_choice and needs.small and not needs.text_sizes and not needs.levels
    chosen = search.choose_anchors(optioned, search.anchor_counts(twins, optioned, needs), True)
    assert [("not there" in r["anchor"]) for r in chosen.collect()] == [True]


def test_requests_in_error_find_nothing(setup):
    _, requests, brute = setup
    bad = {r["request_id"]: r["error"] for r in requests.where("error is not null").collect()}
    assert {7: vocab.LOCATION_BAD_LAT, 8: vocab.SPEC_NO_VALUE, 9: "invalid scope"}.items() <= bad.items()
    assert "malformed request" in bad.values()
    assert not set(bad) & {r for r, _ in brute}


def test_given_fields_win_and_properties_replace(spark):
    defaults = {**DEFAULTS, "text": "d", "properties": [{"key": "a", "uri": "1"}, {"key": "b", "uri": "2"}]}
    docs = spark.createDataFrame([(1, '{"properties":[{"key":"c","uri":"3"}],"expiryTimeout":7}'), (2, "{}")], "request_id int, content string")
    first, second = search.parse_requests(docs, defaults, "h").orderBy("request_id").collect()
    assert [p["key"] for p in first["wanted"]] == ["c"] and first["text"] == "d" and first["expiry_seconds"] == 7
    assert [p["key"] for p in second["wanted"]] == ["a", "b"] and second["expiry_seconds"] == 3


def test_expired_results_are_left_out(spark):
    requests = spark.sql("select 1 request_id, timestamp'2024-01-01' requested_at, 2 expiry_seconds")
    results = spark.sql("select 1 request_id, timestamp'2024-01-01' + make_dt_interval(0,0,0,s) responded_at, s from values (-1),(0),(1),(2) as t(s)")
    assert [r["s"] for r in search.within_expiry(results, requests).orderBy("s").collect()] == [0, 1]


# --- The kept index ----------------------------------------------------------------


def whole_twins(twins, batch=1):
    none = F.array().cast(f"array<{model.PORT}>")
    return twins.withColumn("feeds", none).withColumn("inputs", none).withColumn("batch", F.lit(batch))


@pytest.fixture(scope="module")
def odd_twins(setup):
    """Twins without a host, without an id, and repeated."""
    twins = setup[0]
    number = F.substring("twin_id", 2, 9).cast("int")
    bare = twins.where(number % 11 == 0).withColumn("host_id", F.lit(None).cast("string"))
    unnamed = twins.where(number % 13 == 0).withColumn("twin_id", F.lit(None).cast("string"))
    return twins.where(number % 11 != 0).union(bare).union(unnamed).union(unnamed.limit(3)).cache()


def brute_pairs(twins, requests):
    return pairs_or_null(twins.crossJoin(requests.where("error is null")).where(search.satisfies()))


def pairs_or_null(found):
    return sorted(((r["request_id"], r["host_id"], r["twin_id"]) for r in found.collect()), key=repr)


def test_all_ways_find_twins_without_ids(spark, setup, odd_twins, tmp_path):
    requests = setup[1]
    brute = brute_pairs(odd_twins, requests)
    assert any(t is None for *_, t in brute) and any(h is None for _, h, _ in brute)
    index = indexing.TwinIndex(str(tmp_path / "index"), 4)
    indexing.update_index(spark, index, whole_twins(odd_twins), 0)
    assert pairs_or_null(search.search(odd_twins, requests)) == brute
    assert pairs_or_null(search.search(odd_twins, requests, max_rows=0)) == brute
    assert pairs_or_null(indexing.search_index(spark, index, requests)) == brute
    assert pairs_or_null(indexing.search_index(spark, index, requests, max_rows=0)) == brute


def relabelled(twins, label):
    return twins.withColumn("properties", F.transform("properties", lambda p: F.when(
        p["key"] == vocab.RDFS_LABEL, p.withField("value", F.lit(label))).otherwise(p)))


def test_an_index_is_kept_up_to_date(spark, setup, tmp_path):
    twins, requests, _ = setup
    number = F.substring("twin_id", 2, 9).cast("int")
    index = indexing.TwinIndex(str(tmp_path / "index"), 4)
    indexing.update_index(spark, index, whole_twins(twins.where(number < 200), 5), 0)
    newer = whole_twins(relabelled(twins.where(number.between(150, 250)), "south pump valve"), 6)
    late = whole_twins(relabelled(twins.where(number.between(0, 20)), "too late"), 4)
    twice = whole_twins(relabelled(twins.where(number.between(150, 160)), "outdone"), 5)
    for _ in range(2):  # the same update again leaves the same
        indexing.update_index(spark, index, newer.unionByName(late).unionByName(twice), 1)
        now = newer.drop("batch").unionByName(whole_twins(twins.where(number < 150)).drop("batch"))
        assert pairs_or_null(indexing.search_index(spark, index, requests)) == brute_pairs(now, requests)
        assert indexing.indexed_twins(spark, index).count() == now.count()
    # Back to what it was before.
    back = whole_twins(twins.where(number.between(150, 199)), 9)
    indexing.update_index(spark, index, back, 2)
    now = now.where(~number.between(150, 199)).unionByName(back.drop("batch"))
    assert pairs_or_null(indexing.search_index(spark, index, requests)) == brute_pairs(now, requests)
    smaller = indexing.TwinIndex(str(tmp_path / "smaller"), 2)
    indexing.compact_index(spark, index, smaller)
    assert smaller.numbers(spark) == [0] and smaller.read(spark, "gone", [0]).count() == 0
    assert pairs_or_null(indexing.search_index(spark, smaller, requests)) == brute_pairs(now, requests)
    indexing.update_index(spark, smaller, back.limit(0), 1)
    assert pairs_or_null(indexing.search_index(spark, smaller, requests, max_rows=0)) == brute_pairs(now, requests)


def test_an_update_that_broke_off_is_not_seen(spark, setup, tmp_path):
    twins, requests, brute = setup
    index = indexing.TwinIndex(str(tmp_path / "index"), 4)
    indexing.update_index(spark, index, whole_twins(twins), 0)
    indexing.update_index(spark, index, whole_twins(relabelled(twins, "pump"), 2), 1)
    done = tmp_path / "index" / "done"
    import shutil
    shutil.rmtree(done)
    spark.createDataFrame([(0,)], "number int").write.parquet(str(done))
    assert pairs(indexing.search_index(spark, index, requests)) == brute


def test_only_candidates_are_read(spark, setup, tmp_path):
    twins = setup[0]
    index = indexing.TwinIndex(str(tmp_path / "index"), 8)
    indexing.update_index(spark, index, whole_twins(twins), 0)
    docs = spark.createDataFrame([(1, json.dumps({"properties": [{"key": "size", "literal": "3", "dataType": "integer"}], "text": "valve"}))], "request_id int, content string")
    requests = search.parse_requests(docs, DEFAULTS, "h0")
    found = indexing.search_index(spark, index, requests)
    brute = brute_pairs(twins, requests)
    assert brute and pairs_or_null(found) == brute
    plan = found._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "row_part" in line)
    assert "row_part#" in scan.split("PartitionFilters:")[1].split("]")[0] and "row_key" in scan.split("PushedFilters:")[1]
    assert found.select(TWIN_COLUMNS).columns == TWIN_COLUMNS


def test_an_update_takes_each_twin_apart_once(spark, setup, tmp_path, monkeypatch):
    twins, _, _ = setup
    taken = spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def nothing(_):
        taken.add(1)
        return []

    anchors = search.twin_anchors
    monkeypatch.setattr(search, "twin_anchors", lambda needs: F.concat(anchors(needs), nothing("row_key")))
    index = indexing.TwinIndex(str(tmp_path / "index"), buckets=2)
    indexing.update_index(spark, index, whole_twins(twins), 0)
    assert taken.value == twins.count()
    stored = index.read(spark, "anchors", [0]).groupBy("anchor", "bucket").agg(F.count("*").alias("count"))
    counts = index.read(spark, "counts", [0]).select("anchor", "bucket", "count")
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, stored.collect()))


@pytest.fixture
def stored_rows(monkeypatch):
    """How many rows each table that a search stores has, by name."""
    rows = {}

    def counted(module):
        store = module.materialize

        def materialize(df, name):
            table = store(df, name)
            rows[name] = rows.get(name, 0) + table.count()
            return table

        monkeypatch.setattr(module, "materialize", materialize)

    counted(search)
    counted(indexing)
    return rows


def alike(spark):
    """Requests of three kinds, many of each, and what they find of ``some_twins``."""
    asked = [{}, {"text": "NORTH PUMP"}, {"scope": "LOCAL"}]
    rows = [(i, json.dumps(asked[i % 3])) for i in range(150)]
    docs = spark.createDataFrame(rows, "request_id int, content string")
    return search.parse_requests(docs, DEFAULTS, "h0").drop("content").cache()


def test_requests_alike_store_their_candidates_once(spark, setup, stored_rows):
    twins, _, _ = setup
    requests = alike(spark)
    brute = pairs(twins.crossJoin(requests).where(search.satisfies()))
    assert len(brute) > 25_000
    assert pairs(search.search(twins, requests, max_rows=0)) == brute
    assert stored_rows["candidates"] <= 3 * 300


def test_requests_alike_store_their_candidates_once_from_an_index(spark, setup, stored_rows, tmp_path):
    twins, _, _ = setup
    requests = alike(spark)
    whole = twins.withColumn("feeds", F.array().cast(f"array<{model.PORT}>")).withColumn(
        "inputs", F.array().cast(f"array<{model.PORT}>")).withColumn("batch", F.lit(1))
    index = indexing.TwinIndex(str(tmp_path / "index"), buckets=2)
    indexing.update_index(spark, index, whole, 0)
    brute = pairs(twins.crossJoin(requests).where(search.satisfies()))
    assert pairs(indexing.search_index(spark, index, requests, max_rows=0)) == brute
    assert stored_rows["index-candidates"] <= 3 * 300


def test_a_join_by_pairs_deals_heavy_keys_on_both_sides(spark, monkeypatch):
    from twinloom import sizing

    monkeypatch.setattr(sizing, "PAIRS_A_TASK", 100)
    left = spark.range(400).select(F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("l"))
    right = spark.range(200).select(F.when(F.col("id") < 150, 0).otherwise(F.col("id") + 200).alias("k"), F.col("id").alias("r"))
    counts = left.groupBy("k").agg(F.count("*").alias("n_left")).join(right.groupBy("k").agg(F.count("*").alias("n_right")), "k")
    joined = sizing.paired_join(left, right, ["k"], F.col("l"), F.col("r"), counts, parts=40, least=10)
    both = sorted(tuple(r) for r in left.join(right, "k").collect())
    assert sorted(tuple(r) for r in joined.collect()) == both and len(both) > 45_000
    busiest = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert busiest < len(both) / 4
