"""JSON-LD, graph patterns and chunked results."""

import itertools
import json

import pytest
from pyspark.sql import functions as F

from twinloom import model, vocab
from twinloom.operators import chunks, graph, jsonld

SCHEMA = vocab.SCHEMA_ORG
CAR = {
    "@context": {"afloat": "http://x/op", "Units": "https://x/units", "label": "rdfs:label", "ID": vocab.IDENTIFIER,
                 "rdfs": "http://www.w3.org/2000/01/rdf-schema#", "Make": SCHEMA + "manufacturer"},
    "@type": SCHEMA + "Car", "ID": "1", "Make": "Norlund", "afloat": True, "Units": 5, "label": "Norlund Heron 1", "Comment": "no term",
}


def quads_of(spark, *documents):
    texts = [(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(documents)]
    return jsonld.to_quads(spark.createDataFrame(texts, "doc_id int, content string"))


def test_a_flat_document_becomes_quads(spark):
    quads = jsonld.explode_quads(quads_of(spark, CAR)).orderBy("pos").collect()
    assert [(q["p"], q["o"], (q["datatype"] or "").removeprefix(vocab.XSD)) for q in quads] == [
        (vocab.RDF_TYPE, SCHEMA + "Car", ""), ("http://schema.org/identifier", "1", "string"), (SCHEMA + "manufacturer", "Norlund", "string"),
        ("http://www.w3.org/2000/01/rdf-schema#label", "Norlund Heron 1", "string"), ("http://x/op", "true", "boolean"), ("https://x/units", "5", "integer")]
    assert {q["s"] for q in quads} == {jsonld.BLANK}


def test_contexts(spark):
    documents = [
        {"@context": {"@vocab": "http://v/", "@language": "en", "gone": None, "t": "@type", "id": "@id"}, "id": "urn:me", "a": "x", "gone": "y", "t": ["A", "http://B"], "b": "x", "n": 1.5},
        {"@context": {"x": "p:one", "p": "q:two/", "q": "http://q/"}, "x": 1, "p:z": 2, "urn:z": 3, "plain": 4},
        {"@context": {"a": "http://same", "b": "http://same"}, "a": "1", "b": "1"},
    ]
    rows = jsonld.explode_quads(quads_of(spark, *documents)).orderBy("doc_id", "pos").collect()
    assert [(r["s"], r["p"], r["o"], r["lang"]) for r in rows if r["doc_id"] == 0] == [
        ("urn:me", vocab.RDF_TYPE, "http://v/A", None), ("urn:me", vocab.RDF_TYPE, "http://B", None),
        ("urn:me", "http://v/a", "x", "en"), ("urn:me", "http://v/b", "x", "en"), ("urn:me", "http://v/n", "1.5E0", None)]
    assert [(r["p"], r["o"]) for r in rows if r["doc_id"] == 1] == [("http://q/two/one", "1"), ("http://q/two/z", "2"), ("urn:z", "3")]
    assert len([r for r in rows if r["doc_id"] == 2]) == 1


def test_aliases_are_followed_to_their_end(spark):
    for size in range(1, 14):
        chain = {f"t{k}": f"t{k + 1}:{k}/" for k in range(size)} | {f"t{size}": "http://h/"}
        quads = quads_of(spark, {"@context": chain, "t0": "x"}).first()["quads"]
        assert [q["p"] for q in quads] == ["http://h/" + "".join(f"{k}/" for k in reversed(range(size)))]
    for cycle in ({"a": "b", "b": "a"}, {"a": "a:x"}, {"a": "b:x", "b": "c:y", "c": "a:z"}, {"a": "a"}):
        assert quads_of(spark, {"@context": cycle, "a": "x"}).first()["error"] == vocab.JSONLD_INVALID + vocab.JSONLD_CYCLIC


def test_terms_that_are_objects(spark):
    xsd = vocab.XSD
    document = {
        "@context": {
            "xsd": xsd, "en": "http://h/en", "@language": "en", "@vocab": "http://v/",
            "r": {"@id": "http://h/r", "@type": "@id"}, "n": {"@id": "http://h/n", "@type": "xsd:decimal"},
            "l": {"@id": "http://h/l", "@language": "de"}, "p": {"@id": "http://h/p", "@language": None},
            "q": {"@type": "@vocab"}, "d": {"@id": "http://h/d", "@type": xsd + "double"},
        },
        "r": "http://o/1", "n": "1.5", "l": "Haus", "p": "plain", "q": "r", "z": "zz", "d": 5,
    }
    found = {q["p"]: (q["o"], q["kind"], q["datatype"], q["lang"]) for q in quads_of(spark, document).first()["quads"]}
    assert found == {
        "http://h/r": ("http://o/1", "iri", None, None), "http://h/n": ("1.5", "literal", xsd + "decimal", None),
        "http://h/l": ("Haus", "literal", vocab.RDF_LANG_STRING, "de"), "http://h/p": ("plain", "literal", xsd + "string", None),
        "http://v/q": ("http://h/r", "iri", None, None), "http://v/z": ("zz", "literal", vocab.RDF_LANG_STRING, "en"),
        "http://h/d": ("5.0E0", "literal", xsd + "double", None),
    }


def test_documents_that_are_not_flat_are_in_error(spark):
    bad = ['{"a":1,}', "[]", {"@context": "http://remote", "a": 1}, {"@context": {"a": "http://a"}, "a": {"b": 1}},
           {"@context": {"a": {"@id": "http://a", "@container": "@list"}}, "a": 1}, {"@graph": [1]}, {"@context": {"a": "http://a"}, "a": [1]}]
    errors = [r["error"] for r in quads_of(spark, *bad).orderBy("doc_id").collect()]
    assert errors == [vocab.JSONLD_INVALID + vocab.JSONLD_MALFORMED] + [vocab.JSONLD_INVALID + vocab.JSONLD_UNSUPPORTED] * 6


def test_graphs_stay_apart_and_the_first_is_used(spark):
    context = {"@context": {"a": "http://a", "g": "http://g/"}}
    nodes = lambda *names: [{"@id": f"urn:{n}", "a": n} for n in names]
    documents = [
        {**context, "@graph": []}, {**context, "@graph": nodes("x", "y")}, {**context, "@graph": [{"a": "1"}, {"a": "2"}]},
        {**context, "@id": "g:own", "@graph": nodes("x")[0]},
        {**context, "@graph": [{"@id": "g:2", "@graph": nodes("x")}, {"@id": "g:1", "@graph": nodes("y", "z")}, {"@id": "http://g/2", "@graph": nodes("w", "x")}]},
        {**context, "@graph": [{"@id": "g:2", "@graph": nodes("x")}, *nodes("y")]},
        {**context, "@graph": [{"@id": "nowhere", "@graph": nodes("x")}]}, {**context, "@graph": [{"@graph": nodes("x")}]},
    ]
    graphs = jsonld.to_graphs(spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(documents)], "doc_id int, content string"))
    found = {r["doc_id"]: [(g["graph"], [(q["s"], q["o"]) for q in g["quads"]]) for g in r["graphs"]] for r in graphs.collect()}
    of = lambda *names: [(f"urn:{n}", n) for n in names]
    assert found == {
        0: [], 1: [("@default", of("x", "y"))], 2: [("@default", [("_:b0", "1"), ("_:b1", "2")])], 3: [("http://g/own", of("x"))],
        4: [("http://g/2", of("x", "w")), ("http://g/1", of("y", "z"))], 5: [("@default", of("y")), ("http://g/2", of("x"))],
        6: [], 7: [("_:g", of("x"))],
    }
    first = {r["doc_id"]: (r["graph"], r["error"]) for r in jsonld.first_graph(graphs).collect()}
    missing = (None, vocab.JSONLD_INVALID + vocab.JSONLD_NO_GRAPH)
    assert [first[k] for k in (0, 1, 3, 4, 6)] == [missing, ("@default", None), ("http://g/own", None), ("http://g/2", None), missing]


def test_graphs_that_are_not_flat_are_in_error(spark):
    context = {"@context": {"a": "http://a"}}
    bad = [{**context, "a": 1, "@graph": []}, {**context, "@graph": [{"@context": {}, "a": 1}]}, {**context, "@graph": [{"a": {"b": 1}}]},
           {**context, "@graph": [{"a": 1, "@graph": []}]}, {**context, "@graph": [{"@graph": [{"@graph": []}]}]}, {**context, "@graph": "x"}, {**context, "@graph": [[]]}]
    errors = [r["error"] for r in quads_of(spark, *bad).orderBy("doc_id").collect()]
    assert errors == [vocab.JSONLD_INVALID + vocab.JSONLD_UNSUPPORTED] * len(bad)


def test_contexts_of_all_documents_or_of_their_own_give_the_same(spark):
    documents = [{"@context": {"a": f"http://h/{k % n}/", "b": "a:x", "c": {"@id": "a:c", "@type": "a:t"}, "d": "d" if k % 7 == 3 else "a:d"}, "b": k, "c": str(k), "@type": "a:T"}
                 for n in (1, 3, 200) for k in range(60)]
    documents += [{"a": 1, "urn:x": "y"}, {"@context": None, "urn:x": 1}, {"@context": {}, "urn:x": 1}, {"@context": [], "urn:x": 1}, {"@context": "http://r", "a": 1},
                  {"@context": {"b": "urn:b", "a": "urn:a"}, "a": 1}, {"@context": {"a": "urn:a", "b": "urn:b"}, "a": 1}]
    rows = [(i, json.dumps(d)) for i, d in enumerate(documents)] + [(1000, "{"), (1001, "[]"), (1002, None), (1003, "1")]
    docs = spark.createDataFrame(rows, "doc_id int, content string")
    ways = [sorted(map(tuple, jsonld.to_quads(docs, small=small).collect()), key=repr) for small in (True, False)]
    assert ways[0] == ways[1]
    kept = jsonld.resolved_contexts(docs)
    texts = {json.dumps(d["@context"], sort_keys=True) for d in documents if "@context" in d}
    assert kept.count() == len(texts) and kept.select("context_key").distinct().count() == len(texts)


def allow_document(*lists):
    terms = {f"a{i}": vocab.HOST_ALLOW_LIST for i in range(len(lists))}
    return {"@context": {**terms, "ID": vocab.IDENTIFIER}, "ID": "1", **{f"a{i}": x for i, x in enumerate(lists)}}


def test_the_last_allow_list_decides_or_the_default(spark):
    D = vocab.DID_PREFIX
    with_quads = quads_of(spark, allow_document(), allow_document(vocab.ALLOW_ALL), allow_document(vocab.ALLOW_ALL, "bad"), allow_document("bad", f"{D}7"))
    built = jsonld.build_twins(with_quads, "s", "h", f" {D}1, {D}2").orderBy("doc_id").collect()
    assert [r["properties"][-1]["value"] for r in built] == [f"{D}1,{D}2", vocab.ALLOW_ALL, f"{D}1,{D}2", f"{D}7"]
    assert all([p["key"] for p in r["properties"]].count(vocab.HOST_ALLOW_LIST) == 1 for r in built)
    wrong = jsonld.build_twins(with_quads, "s", "h", "wrong:thing").first()
    assert wrong["error"] == "invalid default for allow list value: wrong:thing" and wrong["twin_id"] is None


def test_quads_become_properties(spark):
    quads = [("_:b0", "p1", "v", "literal", vocab.RDF_LANG_STRING, "en"), ("_:b0", "p2", "5", "literal", vocab.XSD + "integer", None),
             ("_:b0", "p3", "http://o", "iri", None, None), ("_:b0", "p4", "v", "literal", "string", None)]
    rows = spark.createDataFrame([(quads,), ([*quads, ("_:b0", "p5", "_:b1", "blank", None, None)],)], f"quads array<{jsonld.QUAD}>")
    got = [r[0] for r in rows.select(jsonld.quads_to_properties(F.col("quads"), vocab.ALLOW_NONE)).collect()]
    assert [(p["type"], p["lang"], p["dataType"]) for p in got[0]["properties"]] == [
        ("LangLiteral", "en", None), ("Literal", None, "integer"), ("Uri", None, None), ("Literal", None, "string"), ("Uri", None, None)]
    assert got[1]["error"] == "blank node as object"


def test_a_document_without_identifier_is_in_error(spark):
    built = jsonld.build_twins(quads_of(spark, {"@context": {"a": "http://a"}, "a": "1"}, CAR), "s", "h").orderBy("doc_id").collect()
    assert built[0]["error"] == "invalid JSON-LD: missing 'http://schema.org/identifier'" and built[1]["error"] is None


# --- Patterns ------------------------------------------------------------------------


def graph_twins(spark):
    def twin(i):
        properties = [(vocab.RDF_TYPE, SCHEMA + ("Car" if i % 3 else "Van"), "Uri", None, None), ("name", ["Imke", "Odd"][i % 2], "StringLiteral", None, None),
                      ("owner", f"t{(i * 7) % 12}", "Uri", None, None), ("size", str(i % 4), "Literal", None, "integer")]
        return ("h", f"t{i}", properties + properties[1:2])
    return spark.createDataFrame([twin(i) for i in range(12)], f"host_id string, twin_id string, properties array<{model.PROPERTY}>")


def brute(rows, patterns):
    """All solutions by trying every triple for every pattern."""
    solutions = []
    for chosen in itertools.product(rows, repeat=len(patterns)):
        bound, good = {}, True
        for triple, pattern in zip(chosen, patterns):
            for part, term in zip(pattern, triple):
                known = bound.setdefault(part, term) if isinstance(part, str) else tuple(part)
                good = good and known == term
        if good:
            solutions.append(tuple(sorted(bound.items())))
    return sorted(solutions)


def solved(df):
    return sorted(tuple(sorted((c, tuple(r[c])) for c in df.columns)) for r in df.collect())


I, L = graph.iri, graph.literal
PATTERNS = {
    "star": [("?c", I(vocab.RDF_TYPE), I(SCHEMA + "Car")), ("?c", I("name"), L("Imke"))],
    "values": [("?c", I("size"), "?n"), ("?c", I("name"), L("Odd"))],
    "two subjects": [("?c", I("owner"), "?o"), ("?o", I(vocab.RDF_TYPE), I(SCHEMA + "Van"))],
    "same value": [("?a", I("owner"), I("t0")), ("?a", I("size"), "?n"), ("?b", I("size"), "?n")],
    "predicate": [("?c", "?p", L("Imke"))],
    "constant subject": [(I("t3"), "?p", "?o")],
    "loop": [("?c", I("owner"), "?c")],
}


@pytest.mark.parametrize("name", PATTERNS)
def test_patterns_find_what_brute_force_finds(spark, name):
    twins = graph_twins(spark)
    rows = [(tuple(I(r["s"])), tuple(I(r["p"])), tuple(r["o"])) for r in graph.triples(twins).collect()]
    assert len(rows) == len(set(rows)) == 48
    want = brute(rows, PATTERNS[name])
    assert want and solved(graph.match(graph.triples(twins), PATTERNS[name])) == want
    assert solved(graph.match_twins(twins, PATTERNS[name])) == want
    counts = graph.graph_counts(graph.triples(twins)).cache()
    assert solved(graph.match(graph.triples(twins), PATTERNS[name], counts)) == want
    assert solved(graph.match_twins(twins, PATTERNS[name], counts)) == want


def test_counts_tell_the_size_of_a_star(spark):
    twins = graph_twins(spark)
    rows = graph.triples(twins)
    counts = graph.graph_counts(rows).cache()
    for star in ([("?c", I("size"), "?n")], [("?c", I("size"), "?n"), ("?c", I("owner"), "?o")], [("?c", I("name"), L("Imke"))], [("?c", I("none"), "?n")]):
        found = graph.match_twins(twins, star).count()
        assert abs(graph.expected_rows(counts, star) - found) < 1e-6
    total = counts.where("kind = 'object'").agg(F.sum("n")).first()[0]
    assert total == rows.count() == counts.where("kind = 'set'").agg(F.sum("n")).first()[0]


def test_the_rarest_star_comes_first_and_hot_objects_are_dealt(spark):
    rows = []
    for k in range(6000):
        place = "hot" if k % 3 == 0 else f"p{k % 40}"
        rows.append((f"t{k}", [("place", place, "StringLiteral", None, None), ("kind", "guide" if k % 300 == 0 else "other", "StringLiteral", None, None)]))
    twins = spark.createDataFrame(rows, f"twin_id string, properties array<{model.PROPERTY}>").cache()
    counts = graph.graph_counts(graph.triples(twins)).cache()
    patterns = [("?a", I("place"), "?p"), ("?g", I("place"), "?p"), ("?g", I("kind"), L("guide"))]
    assert graph.expected_rows(counts, patterns[1:]) < graph.expected_rows(counts, patterns[:1]) == 6000
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        found = graph.match_twins(twins, patterns, counts)
        sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    want = sum(1 for a in rows for g in rows[::300] if a[1][0][1] == g[1][0][1])
    assert sum(sizes) == want and len(sizes) == 8 and sizes[-1] < 3 * sizes[4]


def test_a_large_result_is_dealt_by_its_rows_and_not_by_the_bytes_of_its_sides(spark, monkeypatch):
    from twinloom import sizing

    monkeypatch.setattr(sizing, "PAIRS_A_TASK", 1000)
    rows = []
    for k in range(2000):
        place = "hot" if k % 2 == 0 else f"p{k % 41}"
        rows.append((f"t{k}", [("place", place, "StringLiteral", None, None), ("kind", "guide" if k % 40 == 0 else "other", "StringLiteral", None, None)]))
    twins = spark.createDataFrame(rows, f"twin_id string, properties array<{model.PROPERTY}>").cache()
    counts = graph.graph_counts(graph.triples(twins)).cache()
    found = graph.match_twins(twins, [("?a", I("place"), "?p"), ("?g", I("place"), "?p"), ("?g", I("kind"), L("guide"))], counts)
    sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
    want = sum(1 for a in rows for g in rows[::40] if a[1][0][1] == g[1][0][1])
    assert sum(sizes) == want > 45_000 and len(sizes) > 30 and sizes[-1] < want / 8


def test_patterns_without_a_shared_variable_are_refused(spark):
    apart = [("?a", I("name"), "?x"), ("?b", I("size"), "?y")]
    for run in (lambda: graph.match(graph.triples(graph_twins(spark)), apart), lambda: graph.match_twins(graph_twins(spark), apart)):
        with pytest.raises(ValueError):
            run()


def test_quads_of_documents_can_be_matched(spark):
    triples = graph.quad_triples(jsonld.explode_quads(quads_of(spark, CAR, {**CAR, "Make": "Alfa"})))
    found = graph.match(triples, [("?c", I(vocab.RDF_TYPE), I(SCHEMA + "Car")), ("?c", I(SCHEMA + "manufacturer"), L("Alfa"))])
    assert found.count() == 1


def test_counts_as_result_documents(spark):
    found = graph.match_twins(graph_twins(spark), PATTERNS["star"])
    counted = graph.count_solutions(found, "?c", "n")
    document = graph.bindings_documents(counted, {"numberOfCars": graph.count_term(F.col("n"))}).first()["document"]
    assert json.loads(document) == {"head": {"vars": ["numberOfCars"]}, "results": {"bindings": [
        {"numberOfCars": {"type": "literal", "datatype": vocab.XSD + "integer", "value": "4"}}]}}


def test_bindings_keep_their_language(spark):
    label = graph._term(F.lit("Haus"), F.lit("literal"), F.lit(vocab.RDF_LANG_STRING), F.lit("de"))
    document = graph.bindings_documents(spark.range(1), {"l": label}).first()["document"]
    assert json.loads(document)["results"]["bindings"] == [{"l": {"type": "literal", "xml:lang": "de", "value": "Haus"}}]


def test_chunks_are_joined_in_order_and_long_results_stay_whole(spark):
    text = "".join(chr(97 + i % 26) for i in range(25))
    rows = [("a", i * 7 % 25, i * 7 % 25 == 24, text[i * 7 % 25]) for i in range(25)] + [("b", 1, False, "y"), ("b", 0, False, "x")]
    table = spark.createDataFrame(rows, "query_id string, seq bigint, last boolean, chunk string")
    whole = {r["query_id"]: r for r in chunks.reassemble(table).collect()}
    assert whole["a"]["text"] == text and whole["a"]["route"] == "success"
    assert whole["b"]["text"] == "xy" and whole["b"]["error"] == vocab.CHUNKS_INCOMPLETE
    gone = table.where("seq <> 3").union(table.where("query_id = 'b'")).union(table.where("seq = 4"))
    broken = {r["query_id"]: r for r in chunks.reassemble(gone).collect()}
    assert broken["a"]["route"] == "failure" and broken["a"]["text"] == text[:3] + text[4:]
    twice = chunks.reassemble(table.union(table)).where("query_id = 'a'").first()
    assert twice["text"] == text and twice["route"] == "success"
    parts = chunks.reassemble(table, per_segment=4).where("query_id = 'a'").orderBy("segment").collect()
    assert len(parts) == 7 and {p["n_segments"] for p in parts} == {7} and "".join(p["text"] for p in parts) == text


def test_results_with_odd_chunks_fail(spark):
    schema = "query_id string, seq bigint, last boolean, chunk string"
    odd = {
        "before": [(-1, False, "?"), (0, False, "x"), (2, True, "y")], "late start": [(1, False, "x"), (2, True, "y")],
        "no content": [(0, False, "x"), (1, False, None), (2, True, "y")], "unnumbered": [(0, False, "x"), (None, False, "y"), (1, True, "z")],
        "beyond": [(0, True, "x"), (1, False, "y")], "good": [(0, False, "x"), (1, False, None), (1, False, "y"), (2, True, "")],
    }
    rows = [(name, *chunk) for name, parts in odd.items() for chunk in parts]
    found = {r["query_id"]: r["route"] for r in chunks.reassemble(spark.createDataFrame(rows, schema)).collect()}
    assert found == {name: "success" if name == "good" else "failure" for name in odd}
