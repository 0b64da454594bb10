"""Twins, shares, requests and documents derived from the star-schema test tables.

Every rule uses integer arithmetic on keys only, so that SQL can state the same one.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from twinloom import model, vocab
from twinloom.functions.properties import flat
from twinloom.sources.documents import text_bytes

HOST_PREFIX = vocab.DID_PREFIX + "host"
TWIN_PREFIX = vocab.DID_PREFIX + "twin"
BALANCE = vocab.SCHEMA_ORG + "balance"
FEED_IDS = ("view", "signup", "purchase", "click", "error")
STORED_FEED_IDS = ("purchase", "signup")
LOCAL_HOST = HOST_PREFIX + "1"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores, where the files are too few to give each core a task.

    Real tables have many more files than cores and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def money(amount: Column) -> Column:
    return amount.cast("decimal(12,2)").cast("string")


def _value(label: str, content: Column | None = None) -> Column:
    return F.struct(
        F.lit(label).alias("label"), F.lit("double").alias("dataType"),
        F.lit("event value").alias("comment"),
        (F.lit(None) if content is None else content).cast("string").alias("value"),
    )


def _ports(ids: list[tuple[str, bool]], values: Column) -> Column:
    def label(port_id: str) -> Column:
        return F.array(flat(F.lit(vocab.RDFS_LABEL), F.lit(port_id), "StringLiteral"))

    return F.array(*[
        F.struct(
            F.lit(port_id).alias("id"), label(port_id).alias("properties"),
            F.lit(stored).alias("storeLast"), values.alias("values"),
        )
        for port_id, stored in ids
    ])


def with_nation(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customers with their nation and the ids of their twin; the nation table is a few rows."""
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment", "n_name",
        F.concat(F.lit(HOST_PREFIX), F.col("n_regionkey")).alias("host_id"),
        F.concat(F.lit(TWIN_PREFIX), F.col("c_custkey")).alias("twin_id"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_nation(spread(table(spark, sf_dir, "customer")), table(spark, sf_dir, "nation"))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a table as a stream of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}*.parquet")


#: Rows of a customer, each of which becomes a twin of some kilobytes, in a task of a stream.
STREAMED_TOGETHER = 25_000


def stream_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers with their nation as a stream, over all cores however few the files are.

    A micro-batch has a task for each block of a file, and its shuffles are never split or put together; rows are
    dealt while they are narrow.
    """
    rows = table(spark, sf_dir, "customer").count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows // STREAMED_TOGETHER))
    return with_nation(stream_table(spark, sf_dir, "customer").repartition(tasks), table(spark, sf_dir, "nation"))


def twin_rows(named: DataFrame, values: Column) -> DataFrame:
    """One twin per customer, with its key; ``values`` are those of each feed."""
    key = F.col("c_custkey")
    allowed = (
        F.when(key % 10 == 0, F.lit(f"{vocab.DID_PREFIX}1, {vocab.DID_PREFIX}2"))
        .when(key % 10 == 1, F.lit("urn:elsewhere:7"))
        .otherwise(F.lit(vocab.ALLOW_NONE))
    )
    properties = F.array(
        flat(F.lit(vocab.IDENTIFIER), key, "StringLiteral"),
        flat(F.lit(vocab.RDF_TYPE), F.concat(F.lit(vocab.SCHEMA_ORG), "c_mktsegment"), "Uri"),
        flat(F.lit(vocab.RDFS_LABEL), F.col("c_name"), "StringLiteral"),
        flat(
            F.lit(vocab.RDFS_COMMENT), F.concat(F.lit("Customer in "), "n_name"),
            "LangLiteral", F.lit("en"),
        ),
        flat(
            F.lit(BALANCE), money(F.col("c_acctbal")), "Literal", None,
            F.lit(vocab.XSD + "decimal"),
        ),
        flat(F.lit(vocab.HOST_ALLOW_LIST), allowed, "Uri"),
    )
    inputs = F.when(key % 3 == 0, _ports([("control", False)], no_values())).otherwise(
        F.array().cast(f"array<{model.PORT}>")
    )
    return named.select(
        "c_custkey", "host_id", "twin_id",
        (key * 37 % 179 - 89).cast("double").alias("lat"),
        (key * 91 % 359 - 179).cast("double").alias("lon"),
        properties.alias("properties"),
        _ports([(f, f in STORED_FEED_IDS) for f in FEED_IDS], values).alias("feeds"),
        inputs.alias("inputs"),
    )


def no_values() -> Column:
    return F.array().cast(f"array<{model.VALUE}>")


def declared_values() -> Column:
    """Values that are declared but hold nothing: none, one, or one label twice."""
    key, value = F.col("c_custkey"), _value("value")
    return F.when(key % 7 == 0, no_values()).when(key % 11 == 0, F.array(value, value)).otherwise(
        F.array(value)
    )


def shared_values() -> Column:
    """Values to publish: missing, none, repeated, without content, or good."""
    key, value = F.col("c_custkey"), _value("value", money(F.col("c_acctbal")))
    return (
        F.when(key % 17 == 0, F.lit(None).cast(f"array<{model.VALUE}>"))
        .when(key % 7 == 0, no_values())
        .when(key % 11 == 0, F.array(value, value))
        .when(key % 13 == 0, F.array(_value("value")))
        .otherwise(F.array(value, _value("unit", F.lit("USD"))))
    )


def twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twin table: one twin per customer."""
    return twin_rows(customers(spark, sf_dir), declared_values()).drop("c_custkey")


def keyed_twins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twin table with the customer's key."""
    return twin_rows(customers(spark, sf_dir), declared_values())


def shared_twins(named: DataFrame) -> DataFrame:
    """``c_custkey, twin``: twins as they are published, some without id or feeds."""
    rows = twin_rows(named, shared_values())
    key = F.col("c_custkey")
    twin = F.struct(
        F.col("host_id").alias("hostId"), F.when(key % 19 != 0, F.col("twin_id")).alias("id"),
        "properties", F.when(key % 23 != 0, F.col("feeds")).alias("feeds"), "inputs",
    )
    return rows.select("c_custkey", twin.alias("twin"))


def document_key() -> Column:
    """Five customers in a row share a document; in every seventh group each has its own."""
    group = F.floor(F.col("c_custkey") / 5).cast("bigint")
    return F.when(group % 7 == 3, -F.col("c_custkey") - 1).otherwise(group)


def spoiled(text: Column) -> Column:
    """JSON text that has lost its last bracket."""
    return F.left(text, F.length(text) - 1)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, content``: arrays of five twins, some single twins, and some broken texts."""
    keyed = shared_twins(customers(spark, sf_dir)).withColumn("doc_id", document_key())
    grouped = keyed.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("c_custkey", "twin"))).alias("members")
    )
    listed = F.transform("members", lambda m: m["twin"])
    text = F.when(F.col("doc_id") < 0, F.to_json(F.element_at(listed, 1))).otherwise(F.to_json(listed))
    broken = F.col("doc_id") % 50 == 49
    return grouped.select(
        "doc_id", F.when(broken, spoiled(text)).otherwise(text).alias("content")
    )


def twin_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``c_custkey, content``: one twin per document, some faulty in one way each."""
    key = F.col("c_custkey")
    rows = twin_rows(customers(spark, sf_dir), declared_values())

    def field(name: str, text: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), text)

    properties = F.to_json(F.when(key % 29 == 0, F.slice("properties", 2, 5)).otherwise(F.col("properties")))
    feeds = (
        F.when(key % 13 == 0, F.lit('{"id":"view"}'))
        .when(key % 17 == 0, F.lit('[{"storeLast":true}]'))
        .when(key % 31 == 0, F.lit("[1]"))
        .otherwise(F.to_json("feeds"))
    )
    text = F.concat(F.lit("{"), F.concat_ws(
        ",", field("hostId", F.concat(F.lit('"'), "host_id", F.lit('"'))),
        field("id", F.concat(F.lit('"'), "twin_id", F.lit('"'))),
        F.when(key % 6 != 0, field("properties", properties)), field("feeds", feeds),
        F.when(key % 3 == 0, field("inputs", F.to_json("inputs"))), field("extra", F.lit("1")),
    ), F.lit("}"))
    broken = key % 50 == 49
    return rows.select(
        "c_custkey", F.when(broken, spoiled(text)).otherwise(text).alias("content")
    )


# The label's prefix is reached by a chain of six names; three terms are objects.
LINKED_CONTEXT: dict = {
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
    "one": "two:", "two": "three:", "three": "four:", "four": "five:", "five": "rdfs:",
    "ID": vocab.IDENTIFIER,
    "label": "one:label",
    "active": vocab.SCHEMA_ORG + "active",
    "Units": vocab.SCHEMA_ORG + "units",
    "Score": vocab.SCHEMA_ORG + "score",
    "Parts": vocab.SCHEMA_ORG + "parts",
    "allow": vocab.HOST_ALLOW_LIST,
    "Home": {"@id": vocab.SCHEMA_ORG + "url", "@type": "@id"},
    "Note": {"@id": "rdfs:comment", "@language": "en"},
    "Price": {"@id": vocab.SCHEMA_ORG + "price", "@type": vocab.XSD + "decimal"},
}
CYCLIC_CONTEXT: dict = {**LINKED_CONTEXT, "here": "there", "there": "here"}
HOME = "http://example.org/customer/"


def linked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, content``: a flat JSON-LD document per customer, some faulty in one way each."""
    key = F.col("c_custkey")
    allowed = F.when(key % 6 == 0, F.lit(f" {vocab.DID_PREFIX}1, {vocab.DID_PREFIX}2 ")).when(
        key % 6 == 3, F.lit("nonsense")
    )
    fields = F.to_json(F.struct(
        F.concat(F.lit(vocab.SCHEMA_ORG), "c_mktsegment").alias("@type"),
        F.when(key % 50 != 48, key.cast("string")).alias("ID"),
        F.col("c_name").alias("label"), (key % 2 == 0).alias("active"), key.alias("Units"),
        (key + F.lit(0.5)).alias("Score"), F.col("n_name").alias("Comment"),
        allowed.alias("allow"), F.concat(F.lit(HOME), key).alias("Home"),
        F.concat(F.lit("Customer in "), "n_name").alias("Note"), money(F.col("c_acctbal")).alias("Price"),
        F.when(key % 50 == 47, F.struct(F.lit(1).alias("a"))).alias("Parts"),
    ))
    context = F.when(key % 50 == 46, F.lit(json.dumps(CYCLIC_CONTEXT))).otherwise(F.lit(json.dumps(LINKED_CONTEXT)))
    text = F.concat(F.lit('{"@context":'), context, F.lit(","), F.substring(fields, F.lit(2), F.length(fields)))
    broken = key % 50 == 49
    return customers(spark, sf_dir).select(
        key.alias("doc_id"), F.when(broken, spoiled(text)).otherwise(text).alias("content")
    )


def graph_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, content``: per customer a document of no graph, a plain node, a list of nodes, a named graph, three graphs, or
    one that is not flat."""
    key = F.col("c_custkey")

    def node(name: str, at: int) -> Column:
        return F.concat(
            F.lit(f'{{"@id":"{HOME}{name}/'), key.cast("string"), F.lit(f'","label":"'), F.col("c_name"), F.lit(f" {at}"), F.lit('"}')
        )

    def listed(*nodes: Column) -> Column:
        inner: list[Column] = [F.lit("[")]
        for k, n in enumerate(nodes):
            inner += [F.lit(","), n] if k else [n]
        return F.concat(*inner, F.lit("]"))

    def named(name: str, *nodes: Column) -> Column:
        return F.concat(F.lit(f'{{"@id":"{HOME}{name}","@graph":'), listed(*nodes), F.lit("}"))

    bare = F.concat(F.lit('{"label":"'), F.col("c_name"), F.lit('"}'))
    graphs = (
        F.when(key % 6 == 0, F.lit("[]")).when(key % 6 == 2, listed(node("a", 0), bare, node("a", 2)))
        .when(key % 6 == 4, listed(named("g2", node("a", 0), node("b", 1)), named("g1", node("c", 0)), named("g3", node("d", 0))))
        .when(key % 6 == 5, listed(named("g2", node("a", 0)), node("b", 0), named("g2", node("c", 0)), named("g4")))
    )
    context = F.lit('{"@context":' + json.dumps({"label": vocab.RDFS_LABEL}))
    text = F.when(key % 6 == 1, F.concat(context, F.lit(',"label":"'), F.col("c_name"), F.lit('"}'))).when(
        key % 6 == 3, F.concat(context, F.lit(f',"@id":"{HOME}own","@graph":'), node("a", 0), F.lit("}"))
    ).otherwise(F.concat(context, F.lit(',"@graph":'), graphs, F.lit("}")))
    beside = F.concat(context, F.lit(',"label":"x","@graph":[]}'))
    return customers(spark, sf_dir).select(
        key.alias("doc_id"), F.when(key % 50 == 44, beside).otherwise(text).alias("content")
    )


def shares_of_events(events: DataFrame, hosts: DataFrame) -> DataFrame:
    """One share per event, with the host of the twin it belongs to."""
    keyed = hosts.select("c_custkey", "host_id", "twin_id")
    return events.join(keyed, F.col("user_id") == F.col("c_custkey")).select(
        "event_id", "host_id", "twin_id", F.col("event_type").alias("feed_id"),
        F.lit("application/json").alias("mime_type"), F.col("ts").alias("occurred_at"),
        text_bytes(F.concat(F.lit('{"value":"'), money(F.col("value")), F.lit('"}'))).alias("payload"),
    )


def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    hosts = with_nation(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"))
    return shares_of_events(table(spark, sf_dir, "events"), hosts)


def result_chunks(spark: SparkSession, sf_dir: str, size: int = 100) -> DataFrame:
    """Texts cut into chunks. Of twenty texts one lacks the mark of its last chunk, one its second chunk, one has
    every chunk twice, one a chunk before the first, and one a first chunk without content."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{size}}}"), 0).alias("pieces")
    )
    total = F.size("pieces")
    cut = docs.select("doc_id", total.alias("total"), F.posexplode("pieces").alias("at", "chunk"))
    cut = cut.where(~((F.col("doc_id") % 20 == 7) & (F.col("at") == 1) & (F.col("total") > 2)))
    rest, first = F.col("doc_id") % 20, F.col("at") == 0

    def sent(seq: Column, chunk: Column) -> Column:
        return F.struct(seq.cast("bigint").alias("seq"), chunk.cast("string").alias("chunk"))

    given = sent(F.col("at"), F.col("chunk"))
    rows = (
        F.when(rest == 11, F.array(given, given)).when((rest == 13) & first, F.array(given, sent(F.lit(-1), F.lit("?"))))
        .when((rest == 17) & first, F.array(sent(F.col("at"), F.lit(None)))).otherwise(F.array(given))
    )
    return cut.withColumn("_c", F.explode(rows)).select(
        "doc_id", F.col("_c.seq").alias("seq"),
        ((F.col("_c.seq") == F.col("total") - 1) & (rest != 0)).alias("last"), F.col("_c.chunk").alias("chunk"),
    )


def request_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``request_id, content``: a search request per customer, in parts missing or wrong."""
    key = F.col("c_custkey")

    def field(name: str, cases: dict[int, str | Column], modulo: int) -> Column:
        text = F.lit(None).cast("string")
        for rest, content in cases.items():
            content = F.lit(content) if isinstance(content, str) else content
            text = F.when(key % modulo == rest, content).otherwise(text)
        return F.concat(F.lit(f'"{name}":'), text)

    def quoted(text: Column) -> Column:
        return F.concat(F.lit('"'), text, F.lit('"'))

    location = F.concat(
        F.lit('{"lat":'), (key % 200 - 100).cast("string"), F.lit(',"lon":"'),
        (key % 400 - 200).cast("string"), F.lit('","r":'), (key % 7 - 1).cast("string"), F.lit(".5}"),
    )
    spec = F.concat(F.lit('[{"key":"k","stringLiteral":"'), "c_name", F.lit('"}]'))
    text = F.concat(F.lit("{"), F.concat_ws(
        ",",
        field("expiryTimeout", {0: '"2"', 1: "7", 2: "-1"}, 4),
        field("text", {0: quoted(F.col("c_name")), 1: '" "'}, 5),
        field("location", {0: location}, 3),
        field("scope", {0: '"LOCAL"', 1: '"WORLD"'}, 6),
        field("responseType", {0: '"MINIMAL"', 1: '"LOCATED"', 2: '"SOME"'}, 8),
        field("properties", {0: spec, 1: '[{"key":"k","literal":"1"}]',
                             2: '[{"key":"k","langLiteral":"1"},{}]', 3: "[]",
                             4: '[{"key":"k"}]'}, 9),
    ), F.lit("}"))
    broken = key % 50 == 49
    return customers(spark, sf_dir).select(
        key.alias("request_id"), F.when(broken, F.lit('{"text": "x')).otherwise(text).alias("content")
    )


def _wanted(key: str, **value: str) -> dict[str, str]:
    return {"key": key, **value}


_TYPE_BUILDING = _wanted(vocab.RDF_TYPE, uri=vocab.SCHEMA_ORG + "BUILDING")

# What each request of the search queries asks for; ``{}`` takes all defaults.
SEARCH_REQUESTS: dict[str, dict] = {
    "type": {"properties": [_TYPE_BUILDING]},
    "type_id": {"properties": [_TYPE_BUILDING, _wanted(vocab.IDENTIFIER, stringLiteral="4")]},
    "text": {"properties": [], "text": "naTION_1"},
    "geo": {"properties": [], "location": {"lat": 50, "lon": 10, "r": 2000}},
    "text_geo": {"properties": [], "text": "customer", "location": {"lat": -20.5, "lon": 175, "r": "1500"}},
    "local": {"properties": [], "scope": "LOCAL"},
    "defaults": {},
    "bad_lat": {"location": {"lat": 9876, "lon": 0.5, "r": 1}},
    "bad_property": {"properties": [_wanted(vocab.IDENTIFIER, literal="1")]},
    "minimal": {
        "expiryTimeout": "2", "text": "#0000000", "responseType": "MINIMAL",
        "properties": [_wanted(vocab.RDFS_COMMENT, langLiteral="Customer in NATION_7", lang="en")],
    },
    "located": {
        "responseType": "LOCATED",
        "properties": [_wanted(BALANCE, literal="1863.84", dataType="decimal")],
    },
}

# Settings of a request that does not give them.
SEARCH_DEFAULTS: dict = {
    "expiryTimeout": "3",
    "scope": "GLOBAL",
    "responseType": "FULL",
    "properties": [_wanted(vocab.RDF_TYPE, uri=vocab.SCHEMA_ORG + "MACHINERY")],
}
