"""Column functions, on the cases the rules are known by and against the JDK's own parsers."""

import random

import pytest
from pyspark.sql import functions as F

from twinloom import model, vocab
from twinloom.functions import checks, datetimes, geo, properties as props, uris
from twinloom.functions.identity import twin_identity
from twinloom.functions.lets import let
from twinloom.operators.jsonld import canonical_double
from twinloom.sources import documents as docs


def evaluate(spark, values, function, kind="string"):
    """``function`` of a column that holds ``values``, in order."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(function(F.col("v"))).collect()]


# --- Dates, times and URIs ----------------------------------------------------

DATE_TEXTS = [
    "2031-11-23", "06:41:00", "2031-11-23T06:41:00", "2031-11-23T06:41:00+02:00", "2031-11-23T06:41:00Z",
    "foo", "2024-02-30", "2024-02-29", "2023-02-29", "2024", "25:00:00", "06:41", "06:41:00.123456789",
    "06:41:00.1234567890", "06:41:00.", "2031-11-23T06:41:00+02:00[Europe/Paris]", "2031-11-23T06:41[Europe/Paris]",
    "2031-11-23T06:41:00+02", "2031-11-23T06:41:00+0200", "2031-11-23t06:41:00z", "2031-11-23T06:41:00+18:00",
    "2031-11-23T06:41:00+18:01", "2031-11-23T24:00:00", "+12345-01-01", "12345-01-01", "-0001-01-01", "-0000-01-01",
    "0000-01-01", "2024-13-01", "2024-00-10", "2024-04-31", "1900-02-29", "2000-02-29", "2031-11-23T06:41:00+02:00[Foo/Bar]",
    "", " 2031-11-23", "2024-5-7", "2031-11-23 06:41:00", "2031-11-23T15", "2031-11-23T06:41:00+02:00:30",
]


def jdk_datetime(spark, text):
    time = spark._jvm.java.time
    for parser, name in ((time.LocalTime, "time"), (time.LocalDate, "date"), (time.LocalDateTime, "dateTime"),
                         (time.OffsetDateTime, "dateTime"), (time.ZonedDateTime, "dateTime")):
        try:
            parser.parse(text)
            return name
        except Exception:
            continue
    return None


def test_datetime_types_agree_with_the_jdk(spark):
    rng = random.Random(7)
    mixed = ["".join(rng.choice(["2024", "-", "05", "07", "T", ":", "15", "Z", "+02", ".5", "31"]) for _ in range(rng.randint(3, 9)))
             for _ in range(150)]
    texts = DATE_TEXTS + mixed
    assert evaluate(spark, texts, datetimes.detect_datetime) == [jdk_datetime(spark, t) for t in texts]


URI_TEXTS = [
    "http://example.org", "example.org", "", "a b", "1a:b", ":x", "#a", "http://x#a#b", "http://x/[a]", "http://x?[a]",
    "%zz", "%20", "mailto:a", "a:b c", "http://h^", "http://[::1]/x", "http://a_b/", "//x", "é:a", "http://é/", "x:#a", "http:",
    "urn:x", "file:///", "http:///x", "a:?b", "a:/", "?a:b", "/a:b", "a/b:c", "a?b:c", "x:[a]", "[a]", "did:x:1, did:x:2",
    "http://x/#", "http://x.org/types#decimal", "string", "http://\u2003x",
]


def jdk_uri(spark, text):
    try:
        uri = spark._jvm.java.net.URI.create(text)
    except Exception:
        return None, vocab.URI_ILLEGAL
    return ("anyURI" if uri.isAbsolute() else None), None


def test_uris_agree_with_the_jdk(spark):
    rng = random.Random(11)
    mixed = ["".join(rng.choice(["http", ":", "/", "//", "x", "?", "#", "a1", "%41", " ", "[", "é", "+"]) for _ in range(rng.randint(1, 7)))
             for _ in range(200)]
    texts = URI_TEXTS + [t for t in mixed if "[" not in t and "://:" not in t and "//" not in t[-2:]]
    got = [(r["datatype"], r["error"]) for r in evaluate(spark, texts, uris.detect_uri)]
    want = [jdk_uri(spark, t) for t in texts]
    assert [x for x in zip(texts, got, want) if x[1] != x[2]] == []


def test_data_type_names(spark):
    texts = [None, "http://example.com#customType", "integer", "http://example.com/x", "a b"]
    assert evaluate(spark, texts, uris.short_data_type)[:3] == ["string", "customType", "integer"]
    assert evaluate(spark, texts, uris.data_type_error) == [
        None, None, None, vocab.DATATYPE_NO_FRAGMENT, vocab.DATATYPE_ILLEGAL]


# --- Properties -----------------------------------------------------------------

FLAT = [
    ("key1", "http://example.com", "Uri", None, None), ("key2", "text", "StringLiteral", None, None),
    ("key3", "langValue", "LangLiteral", "en", None), ("key4", "1", "Literal", None, "integer"),
    ("key5", "literalValue", "Literal", None, "http://example.com#customType"), ("key6", "x", "Literal", None, None),
]


def test_flat_properties_become_typed_and_back(spark):
    rows = spark.createDataFrame([(p,) for p in FLAT], f"p {model.PROPERTY}")
    typed = rows.select("p", props.typed_union(F.col("p")).alias("u"))
    back = [tuple(r[0]["property"]) for r in typed.select(props.flatten_union(F.col("u"))).collect()]
    assert back == [*FLAT[:4], ("key5", "literalValue", "Literal", None, "customType"), ("key6", "x", "Literal", None, "string")]
    schema = typed.select("u").schema["u"].dataType.simpleString()
    assert schema == model.PROPERTY_UNION


@pytest.mark.parametrize("prop, error", [
    ((None, "v", "Uri", None, None), vocab.PROPERTY_NO_KEY), (("k", None, "Uri", None, None), vocab.PROPERTY_NO_VALUE),
    (("k", "v", "InvalidType", None, None), "invalid property type: InvalidType"),
    (("k", "v", None, None, None), "invalid property type: null"), (("k", "v", "LangLiteral", None, None), vocab.PROPERTY_NO_LANG),
])
def test_faulty_properties_have_reasons(spark, prop, error):
    assert evaluate(spark, [prop], props.property_error, model.PROPERTY) == [error]
    assert evaluate(spark, [prop], props.typed_union, model.PROPERTY) == [None]


def test_union_without_a_member_or_null_is_an_error(spark):
    rows = evaluate(spark, [("k", None, None, None, None), None], props.flatten_union, model.PROPERTY_UNION)
    assert [r["error"] for r in rows] == [vocab.PROPERTY_NO_MEMBER + "k", vocab.PROPERTY_NULL]


def test_the_first_property_of_a_key_is_found(spark):
    lists = [[("a", "1", "Uri", None, None), ("b", "2", "Uri", None, None), ("b", "3", "Uri", None, None)], []]
    found = evaluate(spark, lists, lambda c: props.find_property(c, "b"), f"array<{model.PROPERTY}>")
    assert found[0]["value"] == "2" and found[1] is None


SPECS = [
    ("{}", vocab.SPEC_NO_KEY), ('{"key":"k","literal":"1"}', vocab.SPEC_NO_DATATYPE),
    ('{"key":"k","langLiteral":"1"}', vocab.SPEC_NO_LANG), ('{"key":"k"}', vocab.SPEC_NO_VALUE),
    ('{"key":"k","literal":"1","dataType":"integer"}', None), ('{"key":"k","langLiteral":"1","lang":"en"}', None),
    ('{"key":"k","stringLiteral":"1"}', None), ('{"key":"k","uri":"u"}', None),
]


def test_wanted_properties(spark):
    parsed = evaluate(spark, [s for s, _ in SPECS], lambda c: props.spec_error(F.from_json(c, model.PROPERTY_SPEC)))
    assert parsed == [e for _, e in SPECS]
    texts = ["[" + ",".join(s for s, _ in SPECS[:4]) + "]", "[]", "{}", "[{", None]
    bad = vocab.SPECS_BAD_JSON + "not an array"
    assert evaluate(spark, texts, props.spec_list_error) == [", ".join(e for _, e in SPECS[:4]), None, bad, bad, bad]


def test_value_metadata_keeps_nulls(spark):
    values = [[("l", None, None, "content")]]
    assert [tuple(v) for v in evaluate(spark, values, props.value_metadata, f"array<{model.VALUE}>")[0]] == [("l", None, None)]


# --- Checks ---------------------------------------------------------------------

D = vocab.DID_PREFIX


def test_allow_lists(spark):
    texts = [vocab.ALLOW_ALL, vocab.ALLOW_NONE, f" {D}1, {D}2 ", f" {D}1, ,, ,{D}2, ", f"\t{D}1\n",
             f"{D}1,urn:elsewhere:7,{D}2", " ,, , ", "qqq", "", None, f"{D}1,\u2003,{D}2"]
    assert evaluate(spark, texts, checks.allow_list) == [
        vocab.ALLOW_ALL, vocab.ALLOW_NONE, f"{D}1,{D}2", f"{D}1,{D}2", f"{D}1", None, None, None, None, None, f"{D}1,{D}2"]


def test_locations(spark):
    radius, lat, lon = vocab.LOCATION_BAD_RADIUS, vocab.LOCATION_BAD_LAT, vocab.LOCATION_BAD_LON
    cases = {
        '{"lat":53.1,"lon":0.9,"r":1}': None, '{"lat":"53.1","lon":"0.9","r":"2"}': None,
        '{"lat":91,"lon":181,"r":0}': f"{radius}, {lat}, {lon}", '{"lat":-90,"lon":-180}': radius,
        '{"lat":9876,"lon":0,"r":1.9}': lat, '{"r":0.9,"lat":0,"lon":0}': radius, "{}": f"{radius}, {lat}, {lon}",
        "[1]": vocab.LOCATION_BAD_JSON + "not an object", "{": vocab.LOCATION_BAD_JSON + "not an object",
    }
    assert evaluate(spark, list(cases), checks.location_text_error) == list(cases.values())


def test_settings(spark):
    rows = spark.createDataFrame([("LOCAL", "FULL", "2", "x"), ("WORLD", "SOME", "-1", " "), (None, None, None, None)], "a string, b string, c string, d string")
    got = [r[0] for r in rows.select(checks.setting_error(*[F.col(c) for c in "abcd"])).collect()]
    bad = "invalid scope, invalid response type, invalid expiry timeout"
    assert got == [None, bad + ", blank text", bad]


def test_identity_depends_on_seed_and_key_only(spark):
    first, again, other = evaluate(spark, ["k", "k", "l"], lambda c: twin_identity(c, "s"))
    assert first == again != other and first.startswith(D)
    assert evaluate(spark, ["k"], lambda c: twin_identity(c, "t"))[0] != first


def test_texts_and_bytes(spark):
    texts = ["a\r\nb\rc\n", "a\n\n", "é"]
    assert evaluate(spark, texts, lambda c: docs.request_text(F.lit(None).cast("string"), c)) == ["a\nb\nc", "a\n", "é"]
    assert evaluate(spark, texts, lambda c: docs.request_text(F.lit("q"), c)) == ["q"] * 3
    assert evaluate(spark, texts, lambda c: docs.bytes_text(docs.text_bytes(c))) == texts


def test_canonical_doubles(spark):
    cases = {1.5: "1.5E0", 100000000.0: "1.0E8", 1e-5: "1.0E-5", -12.5: "-1.25E1", 0.0: "0.0E0", 0.001: "1.0E-3",
             123.456: "1.23456E2", 1e22: "1.0E22", 5.0: "5.0E0", 1020.0: "1.02E3"}
    assert evaluate(spark, list(cases), canonical_double, "double") == list(cases.values())


def test_let_names_a_value(spark):
    assert evaluate(spark, [2, None], lambda c: let(c + 1, lambda x: F.coalesce(x * x, F.lit(-1))), "int") == [9, -1]


# --- Circles ----------------------------------------------------------------------


def test_cells_of_a_circle_hold_every_point_in_it(spark):
    rng = random.Random(3)
    circles = [(rng.uniform(-90, 90), rng.uniform(-180, 180), rng.choice([1, 5, 50, 500, 3000, 12000, 25000])) for _ in range(60)]
    circles += [(90.0, 0.0, 10), (-90.0, 180.0, 300), (0.0, 180.0, 20), (89.9, -180.0, 5), (0.0, 0.0, 20100)]
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(150)] + [
        (90.0, 5.0), (-90.0, -5.0), (0.0, 180.0), (0.0, -180.0), (0.05, -179.95), (89.95, 179.0), (89.99, 10.0)]
    near = [(max(-90.0, min(90.0, a + rng.uniform(-0.05, 0.05))), o) for a, o, _ in circles]
    circle = spark.createDataFrame(circles, "lat0 double, lon0 double, r int")
    boxed = circle.withColumn("box", geo.circle_box(F.col("lat0"), F.col("lon0"), F.col("r")))
    leveled = boxed.withColumn("level", geo.box_level(F.col("box")))
    covered = leveled.withColumn("cells", geo.box_cells(F.col("box"), F.col("level"))).cache()
    point = spark.createDataFrame(points + near, "lat double, lon double")
    pairs = covered.crossJoin(point).withColumn("cell", geo.cell(F.col("lat"), F.col("lon"), F.col("level")))
    inside = geo.in_circle(F.col("lat"), F.col("lon"), F.col("lat0"), F.col("lon0"), F.col("r"))
    plain = geo.distance_km(F.col("lat"), F.col("lon"), F.col("lat0"), F.col("lon0")) <= F.col("r")
    assert pairs.where(plain & ~F.array_contains("cells", F.col("cell"))).count() == 0
    assert pairs.where(plain != inside).count() == 0
    assert pairs.where(plain).count() > 100
    sizes = covered.select(F.size("cells"), F.size(F.array_distinct("cells"))).collect()
    assert all(n == d and 0 < n <= geo.MAX_CELLS for n, d in sizes)
