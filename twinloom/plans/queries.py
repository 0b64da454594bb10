"""The registered queries: each runs one operator over whole tables and gives flat rows."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from twinloom import vocab
from twinloom.functions import checks, datetimes, geo, properties as props, uris
from twinloom.functions.identity import twin_identity
from twinloom.functions.lets import let
from twinloom.operators import (
    chunks, describe as describing, follow as following, graph, index as indexing, jsonld, publish as publishing,
    reshape, route, search as searching, upsert as upserting,
)
from twinloom.session import materialize, scratch_path
from twinloom.sources import documents as docs, shares as share_tables, tables, testdata as data
from twinloom.sources.documents import bytes_text, twin_struct
from twinloom.streaming import documents as doc_streams, follow as follow_streams, results as result_streams

SEED = "seed-1"
FOLLOWER_KEY = "follower-1"
SNAPSHOT_END = datetime(2024, 1, 15)
CHUNKS_PER_SEGMENT = 64
SEARCH_TEXT = "Customer in nation_2"
CIRCLE = (50.0, 10.0, 2000)
WANTED = [
    {"key": vocab.RDF_TYPE, "uri": vocab.SCHEMA_ORG + "BUILDING"},
    {"key": vocab.RDFS_COMMENT, "langLiteral": "Customer in NATION_3", "lang": "en"},
]
FOLLOWED = {"type": {"properties": [WANTED[0]]}}

RECORD_RULES = reshape.TwinRules(
    properties=[
        reshape.PropertyRule(vocab.IDENTIFIER, "StringLiteral", "ID"),
        reshape.PropertyRule(vocab.SCHEMA_ORG + "category", "StringLiteral", "Segment"),
        reshape.PropertyRule(vocab.SCHEMA_ORG + "areaServed", "StringLiteral", "Country"),
        reshape.PropertyRule(vocab.SCHEMA_ORG + "quantity", "StringLiteral", "Quantity"),
        reshape.PropertyRule(vocab.RDFS_COMMENT, "StringLiteral", "Remark"),
        reshape.PropertyRule(vocab.HOST_ALLOW_LIST, "Uri", default=vocab.ALLOW_NONE),
        reshape.PropertyRule(vocab.RDFS_LABEL, "StringLiteral", "Title", "A customer"),
        reshape.PropertyRule(vocab.RDF_TYPE, "Uri", default=vocab.SCHEMA_ORG + "Person"),
    ],
    feeds=[{"id": "orders", "storeLast": True, "properties": [],
            "values": [{"label": "open", "dataType": "boolean"}]}],
)
LINKED_RULES = reshape.LinkedRules(
    context={"ID": vocab.IDENTIFIER, "Quantity": vocab.SCHEMA_ORG + "quantity"},
    type=vocab.SCHEMA_ORG + "Person", integers=("Quantity",), booleans=("Active",),
)


def _big(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def _requests(spark: SparkSession, requests: dict[str, dict]) -> DataFrame:
    rows = [(name, json.dumps(request)) for name, request in requests.items()]
    documents = spark.createDataFrame(rows, "request_id string, content string")
    return searching.parse_requests(documents, data.SEARCH_DEFAULTS, data.LOCAL_HOST).drop("content")


def _prop(key: str) -> Column:
    return props.find_property(F.col("properties"), key)


def _shown(properties: Column) -> Column:
    """The whole content of a list of properties as one text."""
    return F.array_join(F.transform(properties, lambda p: F.concat_ws(
        "|", p["key"], p["value"], p["type"], F.coalesce(p["lang"], F.lit("")), F.coalesce(p["dataType"], F.lit(""))
    )), ";")


def _ports_shown(ports: Column) -> Column:
    """The whole content of a list of ports as one text."""
    return F.array_join(F.transform(ports, lambda p: F.concat_ws(
        "/", p["id"], p["storeLast"].cast("string"), _shown(p["properties"]),
        F.array_join(F.transform(p["values"], lambda v: v["label"]), "+"),
    )), ";")


# --- Search -------------------------------------------------------------------


def q_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = searching.search(data.twins(spark, sf_dir), _requests(spark, data.SEARCH_REQUESTS))
    return searching.response(found).select(
        "request_id", "response_type", "host_id", "twin_id", "lat", "lon",
        _shown(F.col("properties")).alias("properties"), _ports_shown(F.col("feeds")).alias("feeds"),
    )


def _many(spark: SparkSession, sf_dir: str, **sizes: int) -> DataFrame:
    """The twins found by a table of requests, one of each customer."""
    requests = searching.parse_requests(
        data.request_documents(spark, sf_dir), data.SEARCH_DEFAULTS, data.LOCAL_HOST
    ).drop("content")
    found = searching.search(data.twins(spark, sf_dir), requests, **sizes)
    return found.select("request_id", "host_id", "twin_id")


def q_search_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _many(spark, sf_dir)


def q_search_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many requests as no executor should be sent: neither side is broadcast."""
    return _many(spark, sf_dir, max_rows=0)


def q_search_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a kept index: two thirds of the twins, some outdated, then the rest and what is new."""
    key = F.col("c_custkey")
    twins = data.keyed_twins(spark, sf_dir)
    outdated = F.transform("properties", lambda p: p.withField("value", F.concat(p["value"], F.lit(" before"))))
    first = twins.where(key % 3 != 0).withColumn(
        "properties", F.when(key % 5 == 1, outdated).otherwise(F.col("properties"))
    ).withColumn("batch", F.lit(1))
    index = indexing.TwinIndex(scratch_path(spark, "index"), buckets=16)
    indexing.update_index(spark, index, first.drop("c_custkey"), 0)
    later = twins.where((key % 3 == 0) | (key % 5 == 1)).withColumn("batch", F.lit(2))
    indexing.update_index(spark, index, later.drop("c_custkey"), 1)
    requests = searching.parse_requests(
        data.request_documents(spark, sf_dir), data.SEARCH_DEFAULTS, data.LOCAL_HOST
    ).drop("content")
    return indexing.search_index(spark, index, requests).select("request_id", "host_id", "twin_id")


def q_search_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    twins = data.twins(spark, sf_dir)
    found = twins.where(searching.text_matches(F.col("properties"), F.lit(SEARCH_TEXT)))
    return found.select("host_id", "twin_id")


def q_search_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon, radius = (F.lit(x) for x in CIRCLE)
    found = data.twins(spark, sf_dir).where(
        searching.in_location(F.col("lat"), F.col("lon"), lat, lon, radius)
    )
    distance = geo.distance_km(F.col("lat"), F.col("lon"), lat, lon)
    return found.select("host_id", "twin_id", F.round(distance, 6).alias("distance_km"))


def q_search_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = F.array(*[
        props.flat(
            F.lit(w["key"]), F.lit(w.get("uri", w.get("langLiteral"))),
            "Uri" if "uri" in w else "LangLiteral", F.lit(w.get("lang")),
        )
        for w in WANTED
    ])
    found = data.twins(spark, sf_dir).where(searching.has_properties(F.col("properties"), wanted))
    return found.select("host_id", "twin_id")


def q_search_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    local = searching.in_scope(F.col("host_id"), F.lit("LOCAL"), F.lit(data.LOCAL_HOST))
    return data.twins(spark, sf_dir).where(local).select("host_id", "twin_id")


def q_search_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = searching.parse_requests(
        data.request_documents(spark, sf_dir), data.SEARCH_DEFAULTS, data.LOCAL_HOST
    )
    return parsed.select(
        "request_id", "text", "lat0", "lon0", _big("radius_km").alias("radius_km"),
        _big(F.size("wanted")).alias("n_wanted"), "scope", "response_type",
        _big("expiry_seconds").alias("expiry_seconds"), "error",
    )


def q_search_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = data.twins(spark, sf_dir).select(searching.search_projection(twin_struct()).alias("t"))
    return shown.select(
        F.col("t.hostId").alias("host_id"), F.col("t.id").alias("twin_id"),
        _shown(F.col("t.properties")).alias("properties"), _ports_shown(F.col("t.feeds")).alias("feeds"),
        _ports_shown(F.col("t.inputs")).alias("inputs"),
    )


def q_response_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = data.keyed_twins(spark, sf_dir).withColumn("request_id", F.col("c_custkey"))
    kinds = F.array(*[F.lit(k) for k in vocab.RESPONSE_TYPES])
    typed = asked.withColumn("response_type", F.get(kinds, (F.col("c_custkey") % 3).cast("int")))
    return searching.response(typed).select(
        "request_id", "response_type", "host_id", "twin_id", "lat", "lon",
        _shown(F.col("properties")).alias("properties"), _ports_shown(F.col("feeds")).alias("feeds"),
        _ports_shown(F.col("inputs")).alias("inputs"),
    )


def q_search_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = data.keyed_twins(spark, sf_dir).withColumn("response_id", data.document_key())
    shown = F.when(F.col("response_id") % 10 != 0, F.struct(twin_struct()["hostId"].alias("hostId"), twin_struct()["id"].alias("id")))
    responses = keyed.groupBy("response_id").agg(F.collect_list(shown).alias("twins"))
    return searching.flatten_results(responses).select(
        "response_id", F.col("twin.hostId").alias("host_id"), F.col("twin.id").alias("twin_id")
    )


def _timed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    start = F.lit("2024-01-05 00:00:00").cast("timestamp_ntz")
    return data.table(spark, sf_dir, "customer").select(
        key.alias("request_id"),
        (start + F.make_dt_interval(days=(key % 20).cast("int"))).alias("requested_at"),
        ((key % 7 + 1) * 86400).cast("int").alias("expiry_seconds"),
    )


def q_bounded_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _timed_requests(spark, sf_dir)
    results = data.table(spark, sf_dir, "events").select(
        F.col("user_id").alias("request_id"), F.col("ts").alias("responded_at"), "event_id"
    )
    return searching.within_expiry(results, requests).select("request_id", "event_id", "responded_at")


# --- Documents and properties ---------------------------------------------------


def q_twin_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = docs.parse_documents(data.documents(spark, sf_dir))
    rows = parsed.select("doc_id", "error", F.posexplode_outer("twins").alias("twin_pos", "twin"))
    return rows.select(
        "doc_id", _big("twin_pos").alias("twin_pos"), F.col("twin.hostId").alias("host_id"),
        F.col("twin.id").alias("twin_id"), "error",
        _big(F.when(F.col("twin.properties").isNotNull(), F.size("twin.properties"))).alias("n_properties"),
        _big(F.when(F.col("twin.feeds").isNotNull(), F.size("twin.feeds"))).alias("n_feeds"),
    )


def q_twin_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = docs.parse_twins(data.twin_documents(spark, sf_dir))

    return parsed.select(
        "c_custkey", F.col("twin.hostId").alias("host_id"), F.col("twin.id").alias("twin_id"),
        _shown(F.col("twin.properties")).alias("properties"), _ports_shown(F.col("twin.feeds")).alias("feeds"),
        _ports_shown(F.col("twin.inputs")).alias("inputs"), "error",
    )


def q_twin_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    written = data.twins(spark, sf_dir).select("twin_id", docs.to_document(twin_struct()).alias("document"))
    read = F.get_json_object
    return written.select(
        "twin_id", read("document", "$.hostId").alias("host_id"),
        read("document", "$.properties[2].value").alias("label"),
        read("document", "$.properties[3].lang").alias("comment_lang"),
        read("document", "$.feeds[1].storeLast").alias("signup_stored"),
        F.col("document").contains("null").alias("has_null"),
    )


def q_twin_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All twins, read back from a stored table."""
    path = scratch_path(spark, "twin-table")
    tables.write_twins(data.twins(spark, sf_dir), path)
    twins = tables.read_twins(spark, path)
    return twins.select(
        "host_id", "twin_id", "lat", "lon", _shown(F.col("properties")).alias("properties"),
        _ports_shown(F.col("feeds")).alias("feeds"), _ports_shown(F.col("inputs")).alias("inputs"),
    )


def q_request_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of a request: what an attribute gives, else the content."""
    attribute = F.when(F.col("page_id") % 3 == 0, F.col("url"))
    return data.table(spark, sf_dir, "pages").select(
        "page_id", docs.request_text(attribute, F.col("html")).alias("text")
    )


def q_empty_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twins with an empty list for each that is missing, in their ports too."""
    filled = data.shared_twins(data.customers(spark, sf_dir)).select(
        "c_custkey", docs.with_empty_lists(F.col("twin")).alias("t")
    )
    values = F.flatten(F.transform("t.feeds", lambda f: F.transform(f["values"], lambda v: v["label"])))
    return filled.select(
        "c_custkey", F.col("t.hostId").alias("host_id"), F.col("t.id").alias("twin_id"),
        _big(F.size("t.feeds")).alias("n_feeds"), _big(F.size("t.inputs")).alias("n_inputs"),
        _big(F.size(values)).alias("n_values"),
        F.exists("t.feeds", lambda f: f["values"].isNull() | f["properties"].isNull()).alias("has_null"),
    )


def q_find_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.twins(spark, sf_dir).select(
        "twin_id", _prop(vocab.IDENTIFIER)["value"].alias("identifier"),
        _prop(vocab.RDFS_COMMENT)["value"].alias("comment"),
        _prop(vocab.RDFS_COMMENT)["lang"].alias("comment_lang"),
        _prop("http://example.com/missing")["value"].alias("missing"),
    )


def _keyed_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data.keyed_twins(spark, sf_dir).select("c_custkey", F.posexplode("properties").alias("pos", "p"))


def q_property_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.col("c_custkey") % 10
    members = ("literalValue", "langLiteralValue", "uriValue", "stringLiteralValue")

    def faulty(union: Column) -> Column:
        emptied = F.struct(union["key"].alias("key"), *[F.when(rest != 3, union[m]).alias(m) for m in members])
        return F.when(rest != 4, emptied)

    flat = _keyed_properties(spark, sf_dir).select(
        "c_custkey", "pos",
        let(props.typed_union(F.col("p")), lambda u: let(faulty(u), props.flatten_union)).alias("f"),
    )
    p = F.col("f.property")
    return flat.select(
        "c_custkey", _big("pos").alias("pos"), p["key"].alias("key"), p["value"].alias("value"),
        p["type"].alias("type"), p["lang"].alias("lang"), p["dataType"].alias("data_type"),
        F.col("f.error").alias("error"),
    )


def q_property_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.col("c_custkey") % 11
    p = F.col("p")
    data_type = F.when(rest == 5, F.lit("http://example.com/type")).when(
        rest == 6, F.lit("http://example.com/a b")
    ).when(rest == 7, F.lit(None)).when(rest == 8, F.lit("http://example.com#customType")).otherwise(p["dataType"])
    altered = _keyed_properties(spark, sf_dir).select("c_custkey", "pos", props.flat(
        F.when(rest != 0, p["key"]), F.when(rest != 1, p["value"]),
        F.when(rest == 2, F.lit("InvalidType")).when(rest != 3, p["type"]),
        F.when(rest != 4, p["lang"]), data_type,
    ).alias("p"))
    typed = altered.select("c_custkey", "pos", props.typed_union(p).alias("u"), props.property_error(p).alias("error"))
    u = F.col("u")
    return typed.select(
        "c_custkey", _big("pos").alias("pos"), u["key"].alias("key"),
        u["literalValue"]["value"].alias("literal"), u["literalValue"]["dataType"].alias("data_type"),
        u["langLiteralValue"]["value"].alias("lang_literal"), u["langLiteralValue"]["lang"].alias("lang"),
        u["uriValue"]["value"].alias("uri"), u["stringLiteralValue"]["value"].alias("string_literal"),
        "error",
    )


def q_property_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest, name = F.col("c_custkey") % 9, F.col("c_name")

    def given(*rests: int) -> Column:
        return F.when(rest.isin(*rests), name)

    spec = F.struct(
        F.when(rest != 0, F.lit("key")).alias("key"), given(7, 8).alias("uri"),
        given(1, 2, 8).alias("literal"), F.when(rest.isin(2, 8), F.lit("string")).alias("dataType"),
        given(3, 4).alias("langLiteral"), F.when(rest == 4, F.lit("en")).alias("lang"),
        given(5, 7).alias("stringLiteral"),
    )
    parsed = data.table(spark, sf_dir, "customer").select("c_custkey", spec.alias("s")).select(
        "c_custkey", props.spec_property(F.col("s")).alias("p"), props.spec_error(F.col("s")).alias("error")
    )
    return parsed.select(
        "c_custkey", F.col("p.key").alias("key"), F.col("p.value").alias("value"),
        F.col("p.type").alias("type"), F.col("p.lang").alias("lang"),
        F.col("p.dataType").alias("data_type"), "error",
    )


def q_property_list_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = F.col("c_custkey") % 5
    text = (
        F.when(rest == 0, F.concat(F.lit('[{"key":"k","uri":"'), "c_name", F.lit('"}]')))
        .when(rest == 1, F.concat(F.lit('[{},{"key":"k","uri":"u"},{"key":"k","literal":"'), "c_name", F.lit('"}]')))
        .when(rest == 2, F.concat(F.lit('{"key":"'), "c_name", F.lit('"}')))
        .when(rest == 3, F.concat(F.lit('[{"key":"'), "c_name"))
        .otherwise(F.lit("[]"))
    )
    return data.table(spark, sf_dir, "customer").select("c_custkey", props.spec_list_error(text).alias("error"))


def q_allow_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest, did = F.col("c_custkey") % 8, F.lit(vocab.DID_PREFIX)
    text = (
        F.when(rest == 0, F.lit(vocab.ALLOW_ALL)).when(rest == 1, F.lit(vocab.ALLOW_NONE))
        .when(rest == 2, F.concat(F.lit(" \t"), did, "c_name", F.lit(" , ,, ,"), did, F.lit("2,\n ")))
        .when(rest == 3, F.concat(did, "c_name", F.lit(",urn:elsewhere:7,"), did, F.lit("2")))
        .when(rest == 4, F.lit(", ,,, ,, , ,, ,")).when(rest == 5, F.col("c_name"))
        .when(rest == 6, F.lit(""))
    )
    parts = data.table(spark, sf_dir, "customer").select("c_custkey", checks.allow_list_parts(text).alias("a"))
    return parts.select(
        "c_custkey", F.col("a.value").alias("value"),
        _big(F.when(F.col("a.valid").isNotNull(), F.size("a.valid"))).alias("n_valid"),
        _big(F.when(F.col("a.invalid").isNotNull(), F.size("a.invalid"))).alias("n_invalid"),
    )


def q_location_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    text = F.concat(
        F.lit('{"lat":'), (key % 200 - 100).cast("string"), F.lit(',"lon":"'),
        (key % 400 - 200).cast("string"), F.lit('"'),
        F.when(key % 4 != 0, F.concat(F.lit(',"r":'), (key % 7 - 1).cast("string"), F.lit(".5"))).otherwise(F.lit("")),
        F.when(key % 50 != 49, F.lit("}")).otherwise(F.lit("")),
    )
    text = F.when(key % 50 == 48, F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    return data.table(spark, sf_dir, "customer").select("c_custkey", checks.location_text_error(text).alias("error"))


def q_datatype_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest, name = F.col("c_custkey") % 6, F.col("c_mktsegment")
    text = (
        F.when(rest == 0, F.concat(F.lit("http://example.com/types#"), name))
        .when(rest == 1, name).when(rest == 2, F.concat(F.lit("http://example.com/"), name))
        .when(rest == 3, F.concat(name, F.lit(" x"))).when(rest == 4, F.concat(F.lit("urn:a:b#"), name))
    )
    customer = data.table(spark, sf_dir, "customer").select("c_custkey", text.alias("data_type"))
    error = uris.data_type_error(F.col("data_type"))
    return customer.select(
        "c_custkey", F.when(error.isNull(), uris.short_data_type(F.col("data_type"))).alias("name"),
        error.alias("error"),
    )


def q_detect_uri(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest, url = F.col("page_id") % 5, F.col("url")
    text = (
        F.when(rest == 1, F.regexp_replace(url, "^https?://", ""))
        .when(rest == 2, F.concat(url, F.lit(" x"))).when(rest == 3, F.concat(F.lit("//"), url, F.lit("%zz")))
        .otherwise(url)
    )
    found = data.table(spark, sf_dir, "pages").select("page_id", uris.detect_uri(text).alias("d"))
    return found.select("page_id", "d.datatype", "d.error")


def q_detect_datetime(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest, ts = F.col("event_id") % 10, F.col("ts")
    day, time = F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss")
    both = F.concat(day, F.lit("T"), time)
    text = (
        F.when(rest == 0, day).when(rest == 1, time).when(rest == 2, both)
        .when(rest == 3, F.concat(both, F.lit("+02:00"))).when(rest == 4, F.concat(both, F.lit("Z")))
        .when(rest == 5, F.concat(both, F.lit("[Europe/Paris]")))
        .when(rest == 6, F.concat(F.date_format(ts, "yyyy"), F.lit("-02-30")))
        .when(rest == 7, F.substring(time, 1, 5)).when(rest == 8, F.col("event_type"))
        .otherwise(F.concat(both, F.lit(".123456789-05:30[Europe/Paris]")))
    )
    return data.table(spark, sf_dir, "events").select("event_id", datetimes.detect_datetime(text).alias("datatype"))


def q_request_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "expiryTimeout string, text string, scope string, responseType string"
    given = data.request_documents(spark, sf_dir).select("request_id", F.from_json("content", schema).alias("r"))
    error = checks.setting_error(
        F.coalesce("r.scope", F.lit("GLOBAL")), F.coalesce("r.responseType", F.lit("FULL")),
        F.coalesce("r.expiryTimeout", F.lit("3")), F.col("r.text"),
    )
    return given.select("request_id", error.alias("error"))


def _built(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = docs.parse_twins(data.twin_documents(spark, sf_dir))
    return upserting.build_twins(parsed, SEED, data.LOCAL_HOST)


def q_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    routed = route.with_route(_built(spark, sf_dir))
    document = F.when(F.col("error").isNotNull(), route.error_document(F.col("error"))).otherwise(
        F.to_json(F.struct(F.col("host_id").alias("hostId"), F.col("twin_id").alias("id")))
    )
    written = routed.select("c_custkey", "route", document.alias("document"))
    return written.select(
        "c_custkey", "route", F.get_json_object("document", "$.error").alias("error"),
        F.get_json_object("document", "$.hostId").alias("host_id"),
        F.get_json_object("document", "$.id").alias("twin_id"),
    )


# --- Describe, reshape, upsert ---------------------------------------------------


def q_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = data.twins(spark, sf_dir).select(describing.describe_projection(twin_struct()).alias("t"))
    return shown.select(
        F.col("t.hostId").alias("host_id"), F.col("t.id").alias("twin_id"), _shown(F.col("t.properties")).alias("properties"),
        _ports_shown(F.col("t.feeds")).alias("feeds"), _ports_shown(F.col("t.inputs")).alias("inputs"),
    )


def q_describe_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    asked = data.customers(spark, sf_dir).select(key.alias("request_id"), F.struct(
        F.when(key % 8 != 3, F.col("host_id")).alias("hostId"),
        F.when(key % 8 == 5, F.concat("twin_id", F.lit("x"))).when(key % 8 != 4, F.col("twin_id")).alias("id"),
    ).alias("twin"))
    described = describing.describe(asked, data.twins(spark, sf_dir))
    return described.select(
        "request_id", "route", "error", F.get_json_object("document", "$.id").alias("described_id"),
        F.get_json_object("document", "$.twin.id").alias("input_id"),
        F.get_json_object("document", "$.error").alias("document_error"),
        _big(F.when(F.col("described").isNotNull(), F.size("described.properties"))).alias("n_properties"),
    )


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return data.customers(spark, sf_dir).select(
        key.cast("string").alias("ID"), F.when(key % 9 != 0, F.col("c_mktsegment")).alias("Segment"), F.col("n_name").alias("Country"),
        F.when(key % 3 == 0, F.concat(key.cast("string"), F.lit("x"))).otherwise(key.cast("string")).alias("Quantity"),
        F.when(key % 4 == 0, F.lit("TRUE")).when(key % 4 == 1, F.lit("false")).when(key % 4 == 2, F.lit("1"))
        .alias("Active"),
        F.when(key % 5 != 0, F.lit("Served monthly")).alias("Remark"),
        F.when(key % 7 == 0, F.col("c_name")).alias("Title"),
    )


def q_reshape_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = reshape.concat_default(_records(spark, sf_dir), "Title", ["Segment", "Country", "ID"])
    twins = reshape.reshape_twin(labelled, RECORD_RULES)
    rows = twins.select(
        "ID", F.get("twin.feeds", F.lit(0))["id"].alias("feed_id"),
        _big(F.size("twin.inputs")).alias("n_inputs"), F.posexplode("twin.properties").alias("pos", "p"),
    )
    return rows.select(
        F.col("ID").alias("id"), "feed_id", "n_inputs", _big("pos").alias("pos"),
        F.col("p.key").alias("key"), F.col("p.value").alias("value"), F.col("p.type").alias("type"),
    )


def q_reshape_jsonld(spark: SparkSession, sf_dir: str) -> DataFrame:
    titled = reshape.concat_default(_records(spark, sf_dir), "Title", ["Country", "ID"], overwrite=True)
    linked = reshape.reshape_linked(titled, LINKED_RULES).select("ID", "document")
    quads = jsonld.to_quads(linked.select(F.col("ID").alias("doc_id"), F.col("document").alias("content")))
    operational = F.try_variant_get(F.try_parse_json("content"), "$.Active", "variant")
    return quads.select(
        F.col("doc_id").alias("id"), F.schema_of_variant(operational).alias("operational_type"),
        F.try_variant_get(operational, "$", "string").alias("operational"),
        F.get(F.filter("quads", lambda q: q["p"] == vocab.SCHEMA_ORG + "quantity"), F.lit(0))["o"].alias("quantity"),
        F.get(F.filter("quads", lambda q: q["p"] == vocab.SCHEMA_ORG + "quantity"), F.lit(0))["datatype"].alias("units_type"),
        F.get_json_object("content", "$.Title").alias("title"), _big(F.size("quads")).alias("n_quads"), "error",
    )


def q_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = data.table(spark, sf_dir, "customer")
    return customer.select("c_custkey", twin_identity(F.col("c_name"), SEED).alias("twin_id"))


def q_twin_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = data.keyed_twins(spark, sf_dir)
    key = F.col("c_custkey")
    stored = keyed.where(key % 2 == 0).withColumn("batch", F.when(key % 4 == 0, 5).otherwise(1))
    again = (key % 2 == 1) | (key % 5 == 0)

    def updated(number: int, rows: Column) -> DataFrame:
        renamed = F.transform("properties", lambda p: F.when(
            (p["key"] == vocab.RDFS_LABEL) & (key % 5 == 0), p.withField("value", F.concat(p["value"], F.lit(f" v{number}")))
        ).otherwise(p))
        return keyed.where(rows).withColumn("properties", renamed).withColumn("batch", F.lit(number))

    # Some are older than what is stored; some twins have two, the later one first.
    merged = upserting.merge(stored, updated(3, key % 10 == 5).unionByName(updated(2, again)))
    return merged.select("host_id", "twin_id", _big("batch").alias("batch"), _prop(vocab.RDFS_LABEL)["value"].alias("label"))


def q_upsert_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = data.stream_customers(spark, sf_dir)
    rows = data.twin_rows(named, data.declared_values()).withColumn("batch", F.explode(
        F.when(F.col("c_custkey") % 5 == 0, F.array(F.lit(2), F.lit(1))).otherwise(F.array(F.lit(1)))
    ))
    documents = rows.select(docs.to_document(twin_struct()).alias("content"), "batch")
    build = doc_streams.twins_of_documents(SEED, data.LOCAL_HOST)
    table, bad, checkpoint = (scratch_path(spark, name) for name in ("versions", "bad", "progress"))
    doc_streams.start_upsert(documents, build, table, bad, checkpoint).awaitTermination()
    return upserting.read_newest(spark, table).select(
        "host_id", "twin_id", _big("batch").alias("batch"), _prop(vocab.RDFS_LABEL)["value"].alias("label")
    )


def q_upsert_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = data.twins(spark, sf_dir).select("twin_id", upserting.upsert_ports(twin_struct()).alias("u"))
    feeds = sent.select("twin_id", F.lit("feed").alias("kind"), F.explode("u.feeds").alias("p")).select(
        "twin_id", "kind", F.col("p.id").alias("port_id"), F.col("p.storeLast").alias("store_last"),
        _big(F.size("p.properties")).alias("n_properties"), _big(F.size("p.values")).alias("n_values"),
        F.get("p.values", F.lit(0))["label"].alias("first_label"), F.get("p.properties", F.lit(0))["key"].alias("first_key"),
        F.get("p.properties", F.lit(0))["stringLiteralValue"]["value"].alias("first_text"),
    )
    inputs = sent.select("twin_id", F.lit("input").alias("kind"), F.explode("u.inputs").alias("p")).select(
        "twin_id", "kind", F.col("p.id").alias("port_id"), F.lit(None).cast("boolean").alias("store_last"),
        _big(F.size("p.properties")).alias("n_properties"), _big(F.size("p.values")).alias("n_values"),
        F.get("p.values", F.lit(0))["label"].alias("first_label"), F.get("p.properties", F.lit(0))["key"].alias("first_key"),
        F.get("p.properties", F.lit(0))["stringLiteralValue"]["value"].alias("first_text"),
    )
    return feeds.unionByName(inputs)


def q_feed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.feed_values(data.twins(spark, sf_dir)).withColumn("value_pos", _big("value_pos"))


def q_follower_twin(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = data.table(spark, sf_dir, "supplier")
    definitions = supplier.select(
        F.col("s_suppkey").cast("string").alias("key_name"), F.col("s_name").alias("label"),
        F.concat(F.lit("Follower of "), "s_name").alias("comment"),
        F.lit(vocab.SCHEMA_ORG + "Follower").alias("type"),
    )
    twins = following.follower_twins(definitions, SEED, data.LOCAL_HOST)
    feed = F.get("feeds", F.lit(0))
    return twins.select(
        "host_id", "twin_id", _prop(vocab.HOST_ALLOW_LIST)["value"].alias("visibility"),
        _prop(vocab.RDF_TYPE)["value"].alias("type"), _prop(vocab.RDFS_LABEL)["value"].alias("label"),
        _prop(vocab.RDFS_COMMENT)["value"].alias("comment"), feed["id"].alias("feed_id"),
        F.get(feed["values"], F.lit(0))["label"].alias("value_label"), "payload",
    )


def q_distinct_ports(spark: SparkSession, sf_dir: str) -> DataFrame:
    ports = upserting.distinct_ports(data.twins(spark, sf_dir))
    return ports.select(
        F.col("port.id").alias("port_id"), F.col("port.storeLast").alias("store_last"),
        _big(F.size("port.values")).alias("n_values"),
    )


# --- Publish -----------------------------------------------------------------------


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return docs.parse_documents(data.documents(spark, sf_dir))


def q_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publishing.fan_out(_parsed(spark, sf_dir)).select(
        "doc_id", _big("twin_pos").alias("twin_pos"), _big("feed_pos").alias("feed_pos"),
        F.col("twin.id").alias("twin_id"), F.col("feed.id").alias("feed_id"),
    )


def q_feed_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir).where(F.col("error").isNull())
    return parsed.select("doc_id", publishing.feed_total(F.col("twins")).alias("n_feeds"))


def q_feed_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.shared_twins(data.customers(spark, sf_dir)).select(
        "c_custkey", F.explode("twin.feeds").alias("feed")
    )
    values = F.col("feed.values")
    made = rows.select(
        "c_custkey", F.col("feed.id").alias("feed_id"), publishing.payload(values).alias("payload"),
        publishing.payload_error(values).alias("error"),
    )
    return made.select(
        "c_custkey", "feed_id", F.get_json_object("payload", "$.value").alias("value"),
        F.get_json_object("payload", "$.unit").alias("unit"),
        _big(F.length("payload")).alias("n_chars"), "error",
    )


def q_set_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = data.shared_twins(data.customers(spark, sf_dir)).select(
        "c_custkey", F.explode("twin.feeds").alias("feed")
    )
    content = F.create_map(F.lit("value"), F.concat(F.lit("new "), "c_custkey"), F.lit("other"), F.lit("ignored"))
    updated = rows.select(
        "c_custkey", F.col("feed.id").alias("feed_id"),
        F.posexplode(publishing.set_values(F.col("feed.values"), content)).alias("pos", "v"),
    )
    return updated.select(
        "c_custkey", "feed_id", _big("pos").alias("pos"), F.col("v.label").alias("label"), F.col("v.value").alias("value")
    )


def q_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    published = publishing.publish(_parsed(spark, sf_dir))
    return published.select(
        "doc_id", _big("twin_pos").alias("twin_pos"), _big("feed_pos").alias("feed_pos"), "route", "error",
        "host_id", "twin_id", "feed_id", F.get_json_object("payload", "$.value").alias("value"),
        F.get_json_object("document", "$.error").alias("document_error"),
    )


def q_document_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _parsed(spark, sf_dir)
    return publishing.document_status(parsed)


# --- Graph -------------------------------------------------------------------------


def _term_columns(name: str, prefix: str) -> list[Column]:
    return [F.col(f"`{name}`.{part}").alias(f"{prefix}_{part}") for part in ("value", "kind", "datatype", "lang")]


def q_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.triples(data.twins(spark, sf_dir)).select("s", "p", *_term_columns("o", "o"))


def _quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jsonld.to_quads(data.linked_documents(spark, sf_dir))


def q_jsonld_quads(spark: SparkSession, sf_dir: str) -> DataFrame:
    quads = jsonld.explode_quads(_quads(spark, sf_dir))
    return quads.select("doc_id", _big("pos").alias("pos"), "s", "p", "o", "kind", "datatype", "lang")


def q_first_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first graph of documents with none, one and three of them."""
    graphs = jsonld.first_graph(jsonld.to_graphs(data.graph_documents(spark, sf_dir)))
    shown = F.array_join(F.transform("quads", lambda q: F.concat_ws("|", q["s"], q["p"], q["o"])), ";")
    return graphs.select("doc_id", "graph", shown.alias("quads"), "error")


def q_jsonld_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    with_quads = _quads(spark, sf_dir)
    return jsonld.build_twins(with_quads, SEED, data.LOCAL_HOST).select("doc_id", "twin_id", "error")


def q_quads_to_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = jsonld.build_twins(_quads(spark, sf_dir), SEED, data.LOCAL_HOST, vocab.ALLOW_ALL)
    rows = built.select("doc_id", F.posexplode_outer("properties").alias("pos", "p")).where("pos is not null")
    return rows.select(
        "doc_id", _big("pos").alias("pos"), F.col("p.key").alias("key"), F.col("p.value").alias("value"),
        F.col("p.type").alias("type"), F.col("p.dataType").alias("data_type"),
    )


PATTERNS: list[graph.Pattern] = [
    ("?twin", graph.iri(vocab.RDF_TYPE), graph.iri(vocab.SCHEMA_ORG + "BUILDING")),
    ("?twin", graph.iri(vocab.HOST_ALLOW_LIST), graph.iri(vocab.ALLOW_NONE)),
    ("?twin", graph.iri(data.BALANCE), "?balance"),
]


def q_graph_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = graph.match_twins(data.twins(spark, sf_dir), PATTERNS)
    return found.select(
        F.col("`?twin`.value").alias("twin_id"), F.col("`?balance`.value").alias("balance"),
        F.col("`?balance`.datatype").alias("datatype"),
    )


GUIDES: list[graph.Pattern] = [
    ("?twin", graph.iri(vocab.RDFS_COMMENT), "?place"),
    ("?guide", graph.iri(vocab.RDFS_COMMENT), "?place"),
    ("?guide", graph.iri(vocab.RDF_TYPE), graph.iri(vocab.SCHEMA_ORG + "BUILDING")),
    ("?guide", graph.iri(vocab.HOST_ALLOW_LIST), graph.iri(f"{vocab.DID_PREFIX}1, {vocab.DID_PREFIX}2")),
]


def q_graph_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two subjects over a shared object, which a third of all twins have; joined by kept counts."""
    placed = F.transform("properties", lambda p: F.when(
        (p["key"] == vocab.RDFS_COMMENT) & (F.col("c_custkey") % 3 == 0), p.withField("value", F.lit("Customer of the house"))
    ).otherwise(p))
    twins = data.keyed_twins(spark, sf_dir).withColumn("properties", placed).drop("c_custkey")
    counts = materialize(graph.graph_counts(graph.triples(twins)), "graph-counts")
    found = graph.match_twins(twins, GUIDES, counts)
    return found.select(
        F.col("`?twin`.value").alias("twin_id"), F.col("`?guide`.value").alias("guide_id"), F.col("`?place`.value").alias("place")
    )


def q_pattern_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = graph.match_twins(data.twins(spark, sf_dir), PATTERNS[:2])
    return graph.count_solutions(found, "?twin", "n")


def q_bindings_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    pattern: graph.Pattern = ("?twin", graph.iri(vocab.RDF_TYPE), "?type")
    found = graph.match_twins(data.twins(spark, sf_dir), [pattern])
    counted = found.groupBy(F.col("`?type`").alias("type")).agg(F.count("*").alias("n"))
    documents = graph.bindings_documents(counted, {"type": F.col("type"), "n": graph.count_term(F.col("n"))})
    path = "$.results.bindings[0]"
    return documents.select(
        F.get_json_object("document", f"{path}.type.value").alias("type_value"),
        F.get_json_object("document", f"{path}.type.type").alias("type_kind"),
        F.get_json_object("document", f"{path}.n.value").alias("n_value"),
        F.get_json_object("document", f"{path}.n.datatype").alias("n_datatype"),
        F.get_json_object("document", "$.head.vars[1]").alias("second_variable"),
    )


def q_chunk_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = chunks.reassemble(data.result_chunks(spark, sf_dir), "doc_id", CHUNKS_PER_SEGMENT)
    return joined.select(
        "doc_id", "segment", "n_segments", "n_chunks", _big(F.length("text")).alias("n_chars"),
        F.md5(F.col("text").cast("binary")).alias("text_md5"), "route", "error",
    )


# --- Follow ------------------------------------------------------------------------


def _interests(spark: SparkSession, sf_dir: str, requests: dict[str, dict]) -> DataFrame:
    """Interests in the feeds of the twins found, and in one feed that does not exist; stored."""
    found = searching.search(data.twins(spark, sf_dir), _requests(spark, requests))
    follower = twin_identity(F.lit(FOLLOWER_KEY), SEED)
    interests = following.interests_of(found, follower)
    nobody = spark.range(1).select(
        F.lit(data.LOCAL_HOST).alias("host_id"), F.lit("nobody").alias("twin_id"), F.lit("view").alias("feed_id"),
        F.lit(True).alias("store_last"), follower.alias("follower_twin_id"),
    )
    return materialize(interests.unionByName(nobody), "interests")


def _share_columns(shares: DataFrame) -> DataFrame:
    return shares.withColumn("payload", bytes_text(F.col("payload")))


def q_follow(spark: SparkSession, sf_dir: str) -> DataFrame:
    interests = _interests(spark, sf_dir, FOLLOWED)
    return _share_columns(following.follow(data.shares(spark, sf_dir), interests))


def q_last_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _share_columns(following.last_stored(data.shares(spark, sf_dir)))


def q_follow_snapshot_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    interests = _interests(spark, sf_dir, FOLLOWED)
    until = F.lit(SNAPSHOT_END).cast("timestamp_ntz")
    return _share_columns(following.snapshot_then_live(data.shares(spark, sf_dir), interests, until))


def q_follow_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    interests = _interests(spark, sf_dir, FOLLOWED)
    live = data.shares_of_events(
        data.stream_table(spark, sf_dir, "events"),
        data.with_nation(data.table(spark, sf_dir, "customer"), data.table(spark, sf_dir, "nation")),
    )
    out, checkpoint = scratch_path(spark, "followed"), scratch_path(spark, "progress")
    follow_streams.start_follow(live, interests, out, checkpoint).awaitTermination()
    return _share_columns(spark.read.parquet(out))


def _live_shares(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The events in ``source`` as a stream of shares."""
    events = spark.readStream.schema(data.table(spark, sf_dir, "events").schema).option("maxFilesPerTrigger", 4).parquet(source)
    hosts = data.with_nation(data.table(spark, sf_dir, "customer"), data.table(spark, sf_dir, "nation"))
    return data.shares_of_events(events, hosts)


def _arrive(spark: SparkSession, sf_dir: str, source: str, part: int) -> None:
    """A third of the events reach the folder of the stream; later parts hold earlier events too."""
    events = data.table(spark, sf_dir, "events")
    events.where(F.col("event_id") % 3 == part).write.mode("append").parquet(source)


def q_refollow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A subscription that is lost half-way and taken up again from its checkpoint."""
    interests = _interests(spark, sf_dir, FOLLOWED)
    source, out, checkpoint = (scratch_path(spark, name) for name in ("events", "followed", "progress"))
    for part in range(3):
        _arrive(spark, sf_dir, source, part)
        if part != 1:  # what arrives while nobody listens is read later
            live = _live_shares(spark, sf_dir, source)
            follow_streams.start_follow(live, interests, out, checkpoint).awaitTermination()
    return _share_columns(spark.read.parquet(out))


def q_last_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last share of each feed as the state of a stream that was stopped and started again."""
    source, out, checkpoint = (scratch_path(spark, name) for name in ("events", "last", "progress"))
    for part in range(3):
        _arrive(spark, sf_dir, source, part)
        live = _live_shares(spark, sf_dir, source)
        follow_streams.start_last_state(live, out, checkpoint).awaitTermination()
    return _share_columns(follow_streams.read_last_state(spark, out))


def q_follow_snapshot_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot first, then every later share, as a stream."""
    interests = _interests(spark, sf_dir, FOLLOWED)
    stored = data.shares(spark, sf_dir)
    out, checkpoint = scratch_path(spark, "followed"), scratch_path(spark, "progress")
    live = data.shares_of_events(
        data.stream_table(spark, sf_dir, "events"),
        data.with_nation(data.table(spark, sf_dir, "customer"), data.table(spark, sf_dir, "nation")),
    )
    until = SNAPSHOT_END
    follow_streams.start_follow_from_snapshot(live, stored, interests, until, out, checkpoint).awaitTermination()
    return _share_columns(spark.read.parquet(out).drop("batch"))


def q_bounded_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results kept as they arrive until their request expires."""
    source, out, checkpoint = (scratch_path(spark, name) for name in ("events", "bounded", "progress"))
    requests = materialize(_timed_requests(spark, sf_dir), "timed-requests")
    for part in range(2):
        events = data.table(spark, sf_dir, "events")
        events.where(F.col("event_id") % 2 == part).write.mode("append").parquet(source)
        live = spark.readStream.schema(events.schema).parquet(source).select(
            F.col("user_id").alias("request_id"), F.col("ts").cast("timestamp").alias("responded_at"),
            F.col("event_id").cast("string").alias("result"),
        )
        result_streams.start_bounded(live, requests, out, checkpoint, delay="1000 days").awaitTermination()
    return result_streams.read_results(spark, out).select(
        "request_id", _big("result").alias("event_id"), F.col("responded_at").cast("timestamp_ntz").alias("responded_at")
    )


def _streamed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document for each customer, as a stream."""
    named = data.stream_customers(spark, sf_dir)
    return data.shared_twins(named).select(
        F.col("c_custkey").alias("doc_id"), docs.to_document(F.col("twin")).alias("content")
    )


def q_share_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of streamed documents in the table of feeds."""
    feeds, checkpoint = scratch_path(spark, "feeds"), scratch_path(spark, "progress")
    doc_streams.start_share(_streamed_documents(spark, sf_dir), feeds, checkpoint).awaitTermination()
    stored = share_tables.read_shares(spark, feeds)
    return stored.select(
        "host_id", "twin_id", "feed_id", "mime_type",
        F.get_json_object(bytes_text(F.col("payload")), "$.value").alias("value"),
    )


def q_describe_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streamed documents that ask for twins, described from the twin table."""
    key = F.col("c_custkey")
    named = data.stream_customers(spark, sf_dir)
    asked = F.struct(
        F.when(key % 8 != 3, F.col("host_id")).alias("hostId"),
        F.when(key % 8 == 5, F.concat("twin_id", F.lit("x"))).when(key % 8 != 4, F.col("twin_id")).alias("id"),
    )
    documents = named.select(key.alias("doc_id"), F.to_json(asked).alias("content"))
    out, checkpoint = scratch_path(spark, "described"), scratch_path(spark, "progress")
    twins = materialize(data.twins(spark, sf_dir), "twins")
    doc_streams.start_describe(documents, twins, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select(
        _big(F.substring_index("request_id", "/", 1)).alias("request_id"), "route", "error",
        F.get_json_object("document", "$.id").alias("described_id"),
        F.get_json_object("document", "$.twin.id").alias("input_id"),
        F.get_json_object("document", "$.error").alias("document_error"),
    )


def q_publish_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _streamed_documents(spark, sf_dir)
    out, checkpoint = scratch_path(spark, "published"), scratch_path(spark, "progress")
    doc_streams.start_publish(documents, out, checkpoint).awaitTermination()
    return spark.read.parquet(out).select(
        "doc_id", _big("feed_pos").alias("feed_pos"), "route", "error", "twin_id", "feed_id",
        F.get_json_object("payload", "$.value").alias("value"),
    )


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search, follow the feeds of what was found, and take the last share of each feed."""
    interests = _interests(spark, sf_dir, {"type": {"properties": [WANTED[0]], "text": "customer"}})
    followed = following.follow(data.shares(spark, sf_dir), interests)
    return _share_columns(following.last_stored(followed))


QUERIES = {name: function for name, function in globals().items() if name.startswith("q_")}
