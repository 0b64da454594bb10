"""Publishing, following and upserting, in batches and as streams."""

import json
from pathlib import Path
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from twinloom import model, sizing, vocab
from twinloom.operators import follow, publish, route, upsert
from twinloom.session import materialize, scratch_path, shared_dir
from twinloom.sources import documents as docs, shares as share_tables, tables
from twinloom.streaming import documents as doc_streams, follow as follow_streams, results as result_streams

T0 = datetime(2024, 1, 1)


def parsed(spark, *documents):
    texts = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return docs.parse_documents(spark.createDataFrame(texts, "doc_id bigint, content string"))


def feed(*values, **more):
    return {"id": "f", "values": [{"label": k, "value": v} for k, v in values], **more}


PUBLISHED = [
    {"id": "t", "feeds": [feed(("isOpen", True))]}, {"id": "t", "feeds": [feed(), feed(("a", "1"), ("b", "2"))]},
    {"id": "t", "feeds": [{"id": "f"}]}, {"id": "t", "feeds": [feed(("a", "1"), ("a", "2"))]}, {"id": "t", "feeds": [feed(("a", None))]},
    {"feeds": [feed(("a", "1"))]}, {"id": "t", "feeds": [{"values": [{"label": "a", "value": "1"}]}]}, {"id": "t"}, {"id": "t", "feeds": []}, "{",
]


def test_publish_routes(spark):
    docs_ = parsed(spark, *PUBLISHED)
    rows = publish.publish(docs_).orderBy("doc_id", "feed_pos").collect()
    assert [(r["doc_id"], r["route"], r["error"]) for r in rows] == [
        (0, "success", None), (1, "skipped", None), (1, "success", None), (2, "failure", vocab.VALUES_MISSING), (3, "failure", vocab.LABEL_DUPLICATE),
        (4, "failure", vocab.VALUE_NULL), (5, "failure", vocab.TWIN_ID_MISSING), (6, "failure", vocab.FEED_ID_MISSING), (7, "failure", vocab.FEEDS_MISSING)]
    assert json.loads(rows[0]["payload"]) == {"isOpen": "true"} and json.loads(rows[2]["payload"]) == {"a": "1", "b": "2"}
    assert json.loads(rows[0]["document"])["id"] == "t" and rows[1]["document"] is None
    assert json.loads(rows[4]["document"]) == {"twin": PUBLISHED[3], "error": vocab.LABEL_DUPLICATE}
    status = {r["doc_id"]: r for r in publish.document_status(docs_).collect()}
    assert len(status) == 10 and status[9]["route"] == "failure" and status[8]["n_feeds"] == 0
    assert (status[1]["n_feeds"], status[1]["n_success"], status[1]["n_skipped"]) == (2, 1, 1)


def test_the_status_of_a_document_needs_no_shuffle(spark):
    parsed = docs.parse_documents(spark.createDataFrame([(1, "[]")], "doc_id int, content string"))
    plan = publish.document_status(parsed)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_values_are_set_by_label(spark):
    values = [("a", None, None, "1"), ("a", None, None, "2"), ("b", None, None, "3")]
    rows = spark.createDataFrame([(values, {"a": "new", "zz": "x"})], f"v array<{model.VALUE}>, c map<string,string>")
    assert [v["value"] for v in rows.select(publish.set_values(F.col("v"), F.col("c"))).first()[0]] == ["new", "2", "3"]


def test_routes(spark):
    rows = route.with_route(spark.createDataFrame([(1, None), (2, "bad")], "i int, error string"))
    split = route.split_routes(rows)
    assert split["success"].count() == split["failure"].count() == 1 and split["original"].count() == 0
    assert {r["route"]: r["n"] for r in route.route_counts(rows).collect()} == {"success": 1, "failure": 1}


def share_rows(n=400):
    """Shares of which a third are of one feed."""
    rows = []
    for i in range(n):
        twin, name = ("t0", "f0") if i % 3 == 0 else (f"t{i % 5}", f"f{i % 4}")
        rows.append((i, "h", twin, name, "application/json", T0 + timedelta(minutes=(i * 37) % 200), bytearray(str(i), "utf8")))
    return rows


SHARES = "event_id bigint, host_id string, twin_id string, feed_id string, mime_type string, occurred_at timestamp, payload binary"
INTERESTS = [("h", "t0", "f0", True, "me"), ("h", "t0", "f0", True, "you"), ("h", "t1", "f1", True, "me"), ("h", "t2", "f2", False, "me"), ("h", "nobody", "f", True, "me"), (None, "t0", "f0", True, "no")]


@pytest.fixture(scope="module")
def feeds(spark):
    interests = spark.createDataFrame(INTERESTS, "host_id string, twin_id string, feed_id string, store_last boolean, follower_twin_id string")
    return materialize(spark.createDataFrame(share_rows(), SHARES), "shares"), materialize(interests, "interests")


def brute_follow(rows, stored_only=False):
    return Counter((who, r[0]) for r in rows for h, t, f, stored, who in INTERESTS if (h, t, f) == r[1:4] and (stored or not stored_only))


def newest(rows):
    best = {}
    for r in rows:
        if r[1:4] not in best or (r[5], r[0]) > (best[r[1:4]][5], best[r[1:4]][0]):
            best[r[1:4]] = r
    return list(best.values())


def followers(df):
    return Counter((r["follower_twin_id"], r["event_id"]) for r in df.select("follower_twin_id", "event_id").collect())


@pytest.mark.parametrize("small", [None, True, False])
def test_follow_joins_interests_both_ways(feeds, small):
    assert followers(follow.follow(*feeds, small)) == brute_follow(share_rows())


def test_last_stored_and_snapshot(feeds):
    shares, interests = feeds
    assert {r["event_id"] for r in follow.last_stored(shares).collect()} == {r[0] for r in newest(share_rows())}
    until = T0 + timedelta(minutes=90)
    early = [r for r in share_rows() if r[5] <= until]
    late = [r for r in share_rows() if r[5] > until]
    want = {"snapshot": brute_follow(newest(early), True), "live": brute_follow(late)}
    got = follow.snapshot_then_live(shares, interests, F.lit(until))
    assert {p: followers(got.where(F.col("phase") == p)) for p in want} == want


def test_a_stream_follows_and_goes_on_after_a_stop(spark, feeds, tmp_path):
    interests = feeds[1]
    source, out, progress = (str(tmp_path / x) for x in ("source", "out", "progress"))
    rows = share_rows()
    seen = []
    for part in (rows[:150], rows[150:], []):
        if part:
            spark.createDataFrame(part, SHARES).repartition(3).write.mode("append").parquet(source)
        live = share_tables.stream_shares(spark, source, feeds[0].schema, files_per_trigger=1)
        follow_streams.start_follow(live, interests, out, progress).awaitTermination()
        seen += part
        assert followers(spark.read.parquet(out)) == brute_follow(seen)


def test_a_stream_starts_from_the_snapshot(spark, feeds, tmp_path):
    shares, interests = feeds
    source, out, progress = (str(tmp_path / x) for x in ("source", "out", "progress"))
    shares.repartition(4).write.parquet(source)
    until = T0 + timedelta(minutes=90)
    live = share_tables.stream_shares(spark, source, shares.schema, files_per_trigger=1)
    follow_streams.start_follow_from_snapshot(live, shares, interests, until, out, progress).awaitTermination()
    want = follow.snapshot_then_live(shares, interests, F.lit(until))
    got = spark.read.parquet(out)
    for phase in ("snapshot", "live"):
        assert followers(got.where(F.col("phase") == phase)) == followers(want.where(F.col("phase") == phase))


def test_share_sink_appends_by_feed(spark, feeds, tmp_path):
    path = str(tmp_path / "sink")
    for _ in range(2):
        share_tables.write_shares(feeds[0], path)
    back = share_tables.read_shares(spark, path)
    assert back.count() == 800 and back.where("feed_id = 'f0'").count() == 2 * sum(r[3] == "f0" for r in share_rows())


def test_followers_are_twins(spark):
    definitions = spark.createDataFrame([("key", "myLabel", "myComment", "myType")], "key_name string, label string, comment string, type string")
    row = follow.follower_twins(definitions, "seed", "host").first()
    assert [(p["key"], p["value"], p["type"]) for p in row["properties"]] == [
        (vocab.HOST_ALLOW_LIST, vocab.ALLOW_ALL, "Uri"), (vocab.RDF_TYPE, "myType", "Uri"),
        (vocab.RDFS_LABEL, "myLabel", "StringLiteral"), (vocab.RDFS_COMMENT, "myComment", "StringLiteral")]
    assert row["feeds"][0]["id"] == "status" and [p["value"] for p in row["feeds"][0]["properties"]] == [vocab.FOLLOWER_FEED_LABEL, vocab.FOLLOWER_FEED_COMMENT]
    assert json.loads(row["payload"]) == {"isOperational": True}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_unfollowed_shares_are_not_shuffled(spark, feeds):
    shares, interests = feeds
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(follow.follow(shares, interests, small=False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Above the scan of shares the bits are tested before any exchange.
    lines = plan.splitlines()
    scan = next(k for k, line in enumerate(lines) if "event_id" in line and "FileScan" in line)
    above = lines[:scan][::-1]
    first_exchange = next(k for k, line in enumerate(above) if "Exchange hashpartitioning" in line)
    assert any("_bitmap" in line and "Join" in line for line in above[:first_exchange])
    kept = sizing.might_hold(interests, follow.FEED)(shares)
    wanted = {(h, t, f) for h, t, f, *_ in INTERESTS}
    assert {r["event_id"] for r in kept.collect()} == {r[0] for r in share_rows() if r[1:4] in wanted}


def test_a_busy_feed_is_spread_by_its_weight(spark, feeds):
    rows = [(i, "h", "t0", "f0", "m", T0, bytearray(str(i), "utf8")) for i in range(9000)]
    rows += [(i, "h", f"t{i}", "f0", "m", T0, bytearray(b"x")) for i in range(9000, 10_000)]
    shares = spark.createDataFrame(rows, SHARES)
    heavy = sizing.heavy_keys(follow.feed_counts(shares), follow.FEED)
    assert [(r["twin_id"], r["_salts"]) for r in heavy.collect()] == [("t0", 900)]
    people = [("h", "t0", "f0", True, f"p{k}") for k in range(3)] + [("h", "t9001", "f0", True, "p0")]
    interests = spark.createDataFrame(people, "host_id string, twin_id string, feed_id string, store_last boolean, follower_twin_id string")
    for counts in (None, follow.feed_counts(shares), follow.feed_counts(shares.limit(0))):
        found = follow.follow(shares, interests, False, counts)
        assert found.count() == 27_001 and found.distinct().count() == 27_001


def test_heavy_keys_on_both_sides_meet_once(spark):
    big = spark.range(3000).select((F.col("id") % 7 % 3).alias("k"), "id")
    other = spark.range(400).select((F.col("id") % 5 % 2).alias("k"), F.col("id").alias("v"))
    counts = lambda df: df.groupBy("k").agg(F.count("*").alias("n"))
    found = sizing.weighted_join(
        big, other, ["k"], F.col("id"), sizing.heavy_keys(counts(big), ["k"], parts=20), F.col("v"), sizing.heavy_keys(counts(other), ["k"], parts=10)
    )
    want = big.join(other, "k")
    assert found.count() == want.count() == found.distinct().count() and found.exceptAll(want).isEmpty()


def test_members_pass_and_hardly_any_other(spark):
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("n"))
    rows = spark.range(60_000).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("n"))
    passed = [r["n"] for r in sizing.might_hold(keys, ["key", "n"])(rows).collect()]
    assert len(set(passed)) == len(passed) and set(range(20_000)) <= set(passed) and len(passed) < 20_500
    tight = sizing.might_hold(keys, ["key"], max_bytes=4096)(rows)  # too small for all keys, but none is lost
    assert set(range(20_000)) <= {r["n"] for r in tight.collect()}
    assert sizing.might_hold(keys.limit(0), ["key"])(rows).count() == 0


def test_last_shares_are_aggregated_by_hash(feeds):
    shares, _ = feeds
    plan = plan_of(follow.last_stored(shares))
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_last_shares_of_odd_rows(spark):
    rows = [
        (1, None, "t", "f", "m", T0, None), (2, None, "t", "f", "m", T0, None), (None, "h", "t", "f", "m", T0, None), (-5, "h", "t", "f", "m", T0, None),
        (7, "h", "u", "f", "m", None, None), (6, "h", "u", "f", "m", None, None), (9, "h", "v", "f", "m", datetime(1950, 1, 1), None),
        (-2**63, "h", "v", "f", "m", datetime(1960, 1, 1), None), (2**63 - 1, "h", "v", "f", "m", datetime(1955, 1, 1), None),
        (3, "h", "w", "f", "a", T0, None), (3, "h", "w", "f", "b", T0, None), (3, "h", "x", "f", "a", T0, None), (3, "h", "x", "f", "a", T0, None),
    ]
    shares = spark.createDataFrame(rows, SHARES)
    found = [(r["host_id"], r["twin_id"], r["event_id"]) for r in follow.last_stored(shares.repartition(3)).collect()]
    assert sorted(found, key=str) == sorted(
        [(None, "t", 2), ("h", "t", -5), ("h", "u", 7), ("h", "v", -2**63), ("h", "w", 3), ("h", "x", 3)], key=str
    )
    picks = {follow.last_stored(shares.repartition(n)).where("twin_id = 'w'").first()["mime_type"] for n in (1, 2, 5)}
    assert len(picks) == 1


def test_the_last_share_is_kept_as_state(spark, feeds, tmp_path):
    source, out, progress = (str(tmp_path / x) for x in ("source", "out", "progress"))
    rows, seen = share_rows(), []
    late = [(1000 + i, *r[1:5], T0 - timedelta(days=1), r[6]) for i, r in enumerate(rows[:50])]
    for part in (rows[:100], rows[100:], late):
        spark.createDataFrame(part, SHARES).repartition(2).write.mode("append").parquet(source)
        live = share_tables.stream_shares(spark, source, feeds[0].schema, files_per_trigger=1)
        follow_streams.start_last_state(live, out, progress).awaitTermination()
        seen += part
        assert {r["event_id"] for r in follow_streams.read_last_state(spark, out).collect()} == {r[0] for r in newest(seen)}


def test_requests_are_closed_when_they_expire(spark, tmp_path):
    source, out, progress = (str(tmp_path / x) for x in ("source", "out", "progress"))
    schema = "request_id long, responded_at timestamp, result string"
    at = lambda hours: T0 + timedelta(hours=hours)
    requests = materialize(spark.createDataFrame([(1, at(0), 7200), (2, at(1), 3600), (3, at(500), 60)], "request_id long, requested_at timestamp, expiry_seconds int"), "timed")

    def arrive(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(source)
        live = spark.readStream.schema(schema).parquet(source)
        result_streams.start_bounded(live, requests, out, progress, delay="1 hour").awaitTermination()

    def found():
        return sorted((r["request_id"], r["result"]) for r in result_streams.read_results(spark, out).collect())

    arrive((1, at(0), "a"), (1, at(1.5), "b"), (2, at(0.5), "early"), (9, at(1), "of no request"), (1, at(1.9), "b"))
    assert found() == [(1, "a"), (1, "b"), (1, "b")] and result_streams.read_closed(spark, out).count() == 0
    arrive((1, at(2), "late"), (2, at(1.7), "c"), (1, at(1), "d"))
    assert found() == [(1, "a"), (1, "b"), (1, "b"), (1, "d"), (2, "c")]
    arrive((3, at(500), "e"))  # time has gone on: the first two are closed
    arrive((3, at(500.001), "f"))
    closed = {r["request_id"]: (r["in_time"], r["late"]) for r in result_streams.read_closed(spark, out).collect()}
    assert closed == {1: (4, 1), 2: (1, 1)} and found()[-2:] == [(3, "e"), (3, "f")]


def test_many_requests_share_a_group_of_state(spark, tmp_path, monkeypatch):
    source, out, progress = (str(tmp_path / x) for x in ("source", "out", "progress"))
    schema = "request_id long, responded_at timestamp, result string"
    at = lambda hours: T0 + timedelta(hours=hours)
    ends = {r: at(1 + r % 5) for r in range(300)}
    timed = [(r, at(0), 3600 * (1 + r % 5)) for r in ends]
    requests = materialize(spark.createDataFrame(timed, "request_id long, requested_at timestamp, expiry_seconds int"), "timed")

    def arrive(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        live = spark.readStream.schema(schema).parquet(source)
        query = result_streams.start_bounded(live, requests, out, progress, delay="1 hour")
        query.awaitTermination()
        return max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress)

    def closed():
        return {r["request_id"]: (r["in_time"], r["late"]) for r in result_streams.read_closed(spark, out).collect()}

    groups = arrive([row for r in ends for row in ((r, at(0.5), f"a{r}"), (r, ends[r], f"b{r}"))])
    assert groups <= 8 and closed() == {r: (1, 1) for r in ends if r % 5 < 3}
    monkeypatch.setattr(result_streams, "REQUESTS_A_GROUP", 50)  # goes on with more groups
    arrive([(r, at(4.5), f"c{r}") for r in ends if r % 5 in (0, 3, 4)])
    arrive([(0, at(100), "d")])
    counts = {0: (1, 2), 1: (1, 1), 2: (1, 1), 3: (1, 2), 4: (2, 1)}
    assert closed() == {r: counts[r % 5] if r else (1, 3) for r in ends}
    assert all(r["responded_at"] == ends[r["request_id"]] for r in spark.read.parquet(out).where("closed").collect())
    found = sorted((r["request_id"], r["result"]) for r in result_streams.read_results(spark, out).collect())
    assert found == sorted([(r, f"a{r}") for r in ends] + [(r, f"c{r}") for r in ends if r % 5 == 4])


# --- Upsert ------------------------------------------------------------------------


def twin_document(key, label):
    return json.dumps({"properties": [{"key": vocab.IDENTIFIER, "value": key, "type": "StringLiteral"}, {"key": vocab.RDFS_LABEL, "value": label, "type": "StringLiteral"}]})


def labels(twins):
    return sorted(r["properties"][1]["value"] for r in twins.collect())


def test_versions_keep_the_newest_of_each(spark, tmp_path):
    table, smaller = str(tmp_path / "twins"), str(tmp_path / "compacted")

    def add(rows):
        frame = spark.createDataFrame([(n, twin_document(*d)) for n, d in rows], "batch int, content string")
        upsert.append_versions(upsert.build_twins(docs.parse_twins(frame), "s", "h").drop("content", "error"), table, 4)

    add([(1, ("1", "a")), (2, ("2", "b")), (3, ("1", "a2"))])
    add([(9, ("2", "b3")), (4, ("3", "c")), (2, ("1", "late"))])
    assert labels(upsert.read_newest(spark, table)) == ["a2", "b3", "c"]
    add([(9, ("2", "b3"))])  # a batch that is run again
    upsert.compact(spark, table, smaller, buckets=2)
    assert labels(upsert.read_newest(spark, smaller)) == ["a2", "b3", "c"]
    assert upsert.read_versions(spark, smaller).count() == 3 and upsert.read_versions(spark, table).count() == 7
    assert labels(upsert.read_newest(spark, table, until=2)) == ["b", "late"]


def test_runs_are_merged_by_size(spark, tmp_path):
    table = str(tmp_path / "twins")
    schema = "twin_id string, batch int, v string"
    newest = {}
    for number in range(20):
        rows = [(f"t{(number * 7 + k) % 30}", (number * 5 + k) % 23, f"v{number}.{k}") for k in range(6)]
        for t, batch, v in rows:
            newest.setdefault(t, []).append((batch, v))
        upsert.append_versions(spark.createDataFrame(rows + rows[:1], schema), table, 2, number)
    upsert.append_versions(spark.createDataFrame([("t0", 99, "again")], schema), table, 2, 7)  # known: nothing changes
    runs = upsert.live_runs(spark, table)
    assert sorted(n for r in runs for n in r.numbers) == list(range(20)) and len(runs) < 8
    tiers = [r.tier for r in runs]
    assert all(tiers.count(t) < upsert.FAN_IN for t in tiers)
    found = upsert.read_newest(spark, table)
    assert "SortAggregate" not in plan_of(found) and "ShuffledHashJoin" in plan_of(found)
    rows = {r["twin_id"]: (r["batch"], r["v"]) for r in found.collect()}
    assert found.count() == 30 and {t: b for t, (b, _) in rows.items()} == {t: max(v)[0] for t, v in newest.items()}
    assert all((rows[t]) in newest[t] for t in rows)
    upsert.remove_old(spark, table)
    assert {r["twin_id"]: (r["batch"], r["v"]) for r in upsert.read_newest(spark, table).collect()} == rows
    files = [f for f in (tmp_path / "twins" / "runs").rglob("*.parquet")]
    assert len(files) <= 2 * len(runs) * 2 and len(list((tmp_path / "twins" / "live").iterdir())) == 1


def test_a_run_that_broke_off_is_not_read(spark, tmp_path):
    table = str(tmp_path / "twins")
    schema = "twin_id string, batch int, v string"
    upsert.append_versions(spark.createDataFrame([("a", 1, "x")], schema), table, 2, 0)
    broken = upsert.ranked(spark.createDataFrame([("a", 2, "half")], schema))
    upsert._write_run(broken, table, "u1", (1,), 2, "batch")  # but not made live
    assert [r["v"] for r in upsert.read_newest(spark, table).collect()] == ["x"]
    upsert.append_versions(spark.createDataFrame([("a", 2, "whole")], schema), table, 2, 1)
    assert [r["v"] for r in upsert.read_newest(spark, table).collect()] == ["whole"]


@pytest.mark.parametrize("few", [True, False])
def test_merge_replaces_whole_rows(spark, monkeypatch, few):
    monkeypatch.setattr(sizing, "fits", lambda df: few)
    schema = "twin_id string, batch int, v string"
    stored = spark.createDataFrame([("a", 1, "x"), ("b", 1, "x"), ("d", 5, "x"), ("e", 2, "x"), ("e", 1, "w")], schema)
    updates = spark.createDataFrame([("b", 2, "y"), ("c", 2, "y"), ("b", 3, "z"), ("d", 3, "late"), ("e", 3, "y")], schema)
    want = [("a", 1, "x"), ("b", 3, "z"), ("c", 2, "y"), ("d", 5, "x"), ("e", 3, "y")]
    assert sorted(tuple(r) for r in upsert.merge(stored, updates).collect()) == want


def test_ties_are_decided_by_content(spark):
    rows = [("a", 1, f"v{k}") for k in range(20)]
    found = {upsert.newest(spark.createDataFrame(r, "twin_id string, batch int, v string").repartition(n)).first()["v"]
             for r, n in ((rows, 1), (rows[::-1], 3), (rows[5:] + rows[:5], 7))}
    assert len(found) == 1


def test_distinct_ports_compare_by_content(spark):
    port = ("f", [], True, [("l", "d", "c", None)])
    twins = spark.createDataFrame([([port, ("f", [], False, [])],), ([port],)], f"feeds array<{model.PORT}>")
    assert upsert.distinct_ports(twins).count() == 2


def test_documents_stream_into_sinks(spark, tmp_path):
    source = tmp_path / "docs"
    source.mkdir()
    (source / "1.txt").write_text(twin_document("1", "a") + "\n{broken\n")
    (source / "2.txt").write_text(twin_document("2", "b") + "\n")
    store = str(tmp_path / "twins")
    lines = docs.read_document_lines(spark, str(source), streaming=True).withColumn("batch", F.lit(1))

    def run(build, progress):
        doc_streams.start_upsert(lines, build, store, str(tmp_path / "bad"), str(tmp_path / progress)).awaitTermination()

    run(doc_streams.twins_of_documents("s", "h"), "p1")
    (source / "3.txt").write_text(twin_document("3", "c") + "\n")
    run(doc_streams.twins_of_documents("s", "h"), "p1")
    assert labels(upsert.read_newest(spark, store)) == ["a", "b", "c"] and spark.read.parquet(str(tmp_path / "bad")).count() == 1

    feeds_ = tmp_path / "feeds"
    feeds_.mkdir()
    (feeds_ / "1.txt").write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in PUBLISHED))
    keyed = docs.read_document_lines(spark, str(feeds_), streaming=True).withColumn("doc_id", F.xxhash64("content"))
    doc_streams.start_publish(keyed, str(tmp_path / "out"), str(tmp_path / "p2")).awaitTermination()
    assert route.route_counts(spark.read.parquet(str(tmp_path / "out"))).where("route = 'success'").first()["n"] == 2

    doc_streams.start_share(keyed, str(tmp_path / "shares"), str(tmp_path / "p4")).awaitTermination()
    assert sorted(json.loads(r["p"])["isOpen" if "is" in r["p"] else "a"] for r in spark.read.parquet(str(tmp_path / "shares"))
                  .select(docs.bytes_text(F.col("payload")).alias("p")).collect()) == ["1", "true"]

    twins = upsert.read_newest(spark, store).select("host_id", "twin_id", "properties", "feeds", "inputs")
    known = twins.first()
    (feeds_ / "2.txt").write_text(json.dumps({"hostId": "h", "id": known["twin_id"]}))
    doc_streams.start_describe(keyed, twins, str(tmp_path / "described"), str(tmp_path / "p3")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "described")).where("route = 'success'").count() == 1


def test_linked_documents_stream_into_the_store(spark, tmp_path):
    source = tmp_path / "docs"
    source.mkdir()
    linked = {"@context": {"ID": vocab.IDENTIFIER, "label": vocab.RDFS_LABEL}, "ID": "1", "label": "x"}
    (source / "1.txt").write_text(json.dumps(linked) + "\n{broken\n")
    store = str(tmp_path / "twins")
    lines = docs.read_document_lines(spark, str(source), streaming=True).withColumn("batch", F.lit(1))
    build = doc_streams.twins_of_linked_documents("s", "h", vocab.ALLOW_NONE)
    doc_streams.start_upsert(lines, build, store, str(tmp_path / "bad"), str(tmp_path / "p")).awaitTermination()
    assert labels(upsert.read_newest(spark, store)) == ["x"] and spark.read.parquet(str(tmp_path / "bad")).first()["error"].startswith(vocab.JSONLD_INVALID)


# --- Tables and sizes ----------------------------------------------------------------


def test_sizes_are_measured(spark):
    rows = spark.range(100)
    assert sizing.fits(rows, max_rows=100) and not sizing.fits(rows, max_rows=99) and not sizing.fits(rows, max_bytes=500)


def test_spread_join_finds_each_pair_once(spark):
    big = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    other = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (7, "d")], "k bigint, v string")
    want = Counter(tuple(r) for r in big.join(other, "k").select("k", "id", "v").collect())
    assert Counter(tuple(r) for r in sizing.spread_join(big, other, ["k"], F.col("id")).select("k", "id", "v").collect()) == want


def test_twin_tables(spark, sf_dir, tmp_path):
    from twinloom.sources import testdata
    twins = testdata.twins(spark, sf_dir)
    tables.write_twins(twins, str(tmp_path / "t"))
    back = tables.read_twins(spark, str(tmp_path / "t"))
    assert back.count() == twins.count() and back.select("host_id").distinct().count() > 1
    assert tables.twin_properties(back).where(F.col("key") == vocab.IDENTIFIER).count() == twins.count()


def test_the_shared_folder_is_the_one_set(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/x-") and scratch_path(spark, "x") != scratch_path(spark, "x")


def test_scratch_tables_go_with_their_scope(spark):
    from twinloom.session import materialize, scratch_scope

    with scratch_scope(spark):
        inner = materialize(spark.range(5), "kept-in-scope")
        files = inner.inputFiles()
        assert inner.count() == 5 and files
    outer = materialize(spark.range(3), "kept")
    assert outer.count() == 3 and not any(Path(f.removeprefix("file:")).exists() for f in files)


def test_a_run_has_tasks_by_its_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(upsert, "ROWS_A_TASK", 50, raising=False)
    table = str(tmp_path / "twins")
    rows = [(f"t{k}", 1, "x" * 20) for k in range(1000)]
    upsert.append_versions(spark.createDataFrame(rows + rows[:10], "twin_id string, batch int, v string"), table, 2)
    stored = spark.read.parquet(f"{table}/runs")
    most = stored.groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert stored.count() == 1000 and most < 300


@pytest.mark.parametrize("name", ["q_publish_stream", "q_share_sink", "q_upsert_stream", "q_describe_stream"])
def test_streams_of_one_file_are_worked_on_by_all_cores(spark, sf_dir, name, monkeypatch):
    from twinloom.plans import queries

    made = {}
    streamed = queries.data.with_nation

    def noted(customer, nation):
        found = streamed(customer, nation)
        if customer.isStreaming:
            made["tasks"] = found._jdf.queryExecution().analyzed().toString()
        return found

    monkeypatch.setattr(queries.data, "with_nation", noted)
    assert queries.QUERIES[name](spark, sf_dir).count() > 0
    assert "Repartition 4, true" in made["tasks"]
