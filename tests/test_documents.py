"""Parsing and writing twin documents."""

import json

import pytest
from pyspark.sql import functions as F

from twinloom import vocab
from twinloom.operators import describe, reshape, upsert
from twinloom.sources import documents as docs


def frame(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, content string")


def tolerant(spark, *texts):
    return [(r["twin"], r["error"]) for r in docs.parse_twins(frame(spark, *texts)).orderBy("doc_id").collect()]


def test_tolerant_parse(spark):
    rows = tolerant(
        spark, '{"hostId":"host-7","id":"twin-q","feeds":[]}',
        '{"id":"i","feeds":[{"id":"a","storeLast":true,"values":[{"label":"op","value":true}]},{"id":"b","values":{}}],"inputs":{"id":"x"}}',
        '{"id":"i","feeds":[{"properties":[]}]}', '{"id":"i","inputs":[5]}', '[{"id":"i"}]', '{"id":"i","prop', "null",
        '{"id":null,"unknown":1}', '{"id":"i","feeds":[{"id":"a","values":[1]}]}')
    assert tuple(rows[0][0]) == ("host-7", "twin-q", [], [], [])
    feeds = rows[1][0]["feeds"]
    assert feeds[0]["storeLast"] and feeds[0]["values"][0]["value"] == "true" and feeds[1]["values"] == [] and not feeds[1]["storeLast"]
    assert rows[1][0]["inputs"] == []
    assert [e for _, e in rows[2:7]] == [vocab.PORT_NO_ID, vocab.TWIN_BAD_LIST, *[vocab.TWIN_NOT_OBJECT] * 3]
    assert rows[7][0]["id"] is None and rows[7][1] is None and rows[8][1] == vocab.TWIN_BAD_LIST


def test_plain_parse_takes_one_twin_or_many_and_keeps_missing_lists(spark):
    parsed = docs.parse_documents(frame(spark, '[{"id":"a"},{"id":"b","feeds":[]}]', '{"id":"c"}', "[]", "[1]", "{", "", "5", "[null]"))
    rows = parsed.orderBy("doc_id").collect()
    assert [[t["id"] for t in r["twins"]] if r["twins"] is not None else None for r in rows] == [["a", "b"], ["c"], [], *[None] * 5]
    assert rows[0]["twins"][0]["feeds"] is None and rows[0]["twins"][1]["feeds"] == []
    assert [r["error"] for r in rows[3:]] == [vocab.DOCUMENT_NOT_TWINS, vocab.DOCUMENT_MALFORMED, vocab.DOCUMENT_MALFORMED,
                                              vocab.DOCUMENT_NOT_TWINS, vocab.DOCUMENT_NOT_TWINS]
    assert docs.explode_twins(parsed).count() == 3


def test_written_documents_have_no_nulls(spark):
    parsed = docs.parse_documents(frame(spark, '{"id":"c","feeds":[{"id":"f","values":[{"label":"l"}]}]}'))
    written = docs.explode_twins(parsed).select(docs.to_document(F.col("twin"))).first()[0]
    assert json.loads(written) == {"id": "c", "feeds": [{"id": "f", "values": [{"label": "l"}]}]}
    filled = docs.explode_twins(parsed).select(docs.with_empty_lists(F.col("twin")).alias("t")).first()["t"]
    assert filled["inputs"] == [] and filled["feeds"][0]["properties"] == [] and filled["feeds"][0]["storeLast"] is False


def test_documents_are_read_from_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":\n"a"}')
    (tmp_path / "b.json").write_text('[{"id":"b"}]')
    parsed = docs.parse_documents(docs.read_documents(spark, str(tmp_path)))
    assert sorted(r["twin"]["id"] for r in docs.explode_twins(parsed).collect()) == ["a", "b"]
    lines = docs.read_document_lines(spark, str(tmp_path / "b.json"))
    assert lines.columns == ["content"] and lines.count() == 1


IDENTIFIED = {"key": vocab.IDENTIFIER, "value": "1", "type": "StringLiteral"}


def test_twins_are_built_or_have_a_reason(spark):
    bad = {"key": "k", "value": "v", "type": "Nope"}
    texts = [{"properties": [IDENTIFIED]}, {"properties": []}, {"properties": [IDENTIFIED, bad]},
             {"properties": [IDENTIFIED], "feeds": [{"id": "f", "properties": [bad]}]}]
    built = upsert.build_twins(docs.parse_twins(frame(spark, *map(json.dumps, texts))), "seed", "host")
    rows = built.orderBy("doc_id").collect()
    assert rows[0]["twin_id"].startswith(vocab.DID_PREFIX) and rows[0]["error"] is None
    assert [r["error"] for r in rows[1:]] == [vocab.TWIN_NO_ID_PROPERTY + vocab.IDENTIFIER, *["invalid property type: Nope"] * 2]
    missing = upsert.build_twins(docs.parse_twins(frame(spark, json.dumps(texts[0]))), "s", "h", vocab.SCHEMA_ORG + "missing_identifier")
    assert missing.first()["error"] == "invalid twin: missing property http://schema.org/missing_identifier"


def test_a_record_becomes_a_twin(spark):
    record = spark.createDataFrame([("1", "Norlund", "Heron", "Teal")], "ID string, Yard string, Class string, Colour string")
    rules = reshape.TwinRules([
        reshape.PropertyRule(vocab.IDENTIFIER, "StringLiteral", "ID"), reshape.PropertyRule("color", "StringLiteral", "Colour"),
        reshape.PropertyRule("gone", "StringLiteral", "NoColumn"), reshape.PropertyRule(vocab.RDFS_LABEL, "StringLiteral", "Label", "A boat"),
        reshape.PropertyRule(vocab.HOST_ALLOW_LIST, "Uri", default=vocab.ALLOW_NONE),
    ], feeds=[{"id": "status", "storeLast": True}])
    labelled = reshape.concat_default(record, "Label", ["Yard", "Class", "ID"])
    twin = reshape.reshape_twin(labelled, rules).first()["twin"]
    assert [(p["key"], p["value"]) for p in twin["properties"]] == [
        (vocab.IDENTIFIER, "1"), ("color", "Teal"), ("gone", None), (vocab.RDFS_LABEL, "Norlund Heron 1"), (vocab.HOST_ALLOW_LIST, vocab.ALLOW_NONE)]
    assert twin["feeds"][0]["id"] == "status" and twin["inputs"] == []
    assert reshape.reshape_twin(record, rules).first()["twin"]["properties"][3]["value"] == "A boat"


def test_casts_keep_text_that_is_no_number_or_boolean(spark):
    rows = spark.createDataFrame([("5", "TRUE"), ("x", "1"), (None, None)], "Berths string, Afloat string")
    rules = reshape.LinkedRules({"Berths": "http://u"}, "http://t", ("Berths",), ("Afloat",))
    got = [json.loads(r["document"]) for r in reshape.reshape_linked(rows, rules).collect()]
    assert [(d.get("Berths"), d.get("Afloat")) for d in got] == [(5, True), ("x", "1"), (None, None)]
    assert got[0]["@type"] == "http://t" and got[0]["@context"] == {"Berths": "http://u"}


@pytest.mark.parametrize("few", [True, False])
def test_describe_finds_or_fails(spark, monkeypatch, few):
    monkeypatch.setattr(describe.sizing, "fits", lambda df: few)
    stored = docs.explode_twins(docs.parse_documents(frame(
        spark, '[{"hostId":"h","id":"a","properties":[],"feeds":[{"id":"f","storeLast":true,"values":[{"label":"l"}]}],"inputs":[]}]')))
    twins = stored.select(F.col("twin.hostId").alias("host_id"), F.col("twin.id").alias("twin_id"), "twin.properties", "twin.feeds", "twin.inputs")
    asked = docs.explode_twins(docs.parse_documents(frame(
        spark, '{"hostId":"h","id":"a"}', '{"id":"a"}', '{"hostId":"h"}', '{"hostId":"h","id":"b"}', '{"hostId":"h","id":"a"}')))
    rows = describe.describe(asked.select(F.col("doc_id").alias("request_id"), "twin"), twins).orderBy("request_id").collect()
    assert [r["error"] for r in rows] == [None, vocab.HOST_ID_MISSING, vocab.TWIN_ID_MISSING, vocab.TWIN_UNKNOWN, None]
    assert json.loads(rows[0]["document"])["feeds"] == [{"id": "f", "properties": [], "storeLast": True, "values": []}]
    assert json.loads(rows[3]["document"]) == {"twin": {"hostId": "h", "id": "b"}, "error": vocab.TWIN_UNKNOWN}


def test_a_column_made_of_others_may_replace_what_is_there(spark):
    rows = spark.createDataFrame([("a", "b", "old"), ("a", None, "old"), ("a", "b", None)], "x string, y string, t string")
    kept = [r["t"] for r in reshape.concat_default(rows, "t", ["x", "y"]).collect()]
    replaced = [r["t"] for r in reshape.concat_default(rows, "t", ["x", "y"], "-", overwrite=True).collect()]
    assert kept == ["old", "old", "a b"] and replaced == ["a-b", None, "a-b"]
