"""Flat JSON-LD documents: to quads, and on to twins.

A document holds a node with scalar values, or graphs of such nodes, and its own ``@context`` of terms, prefixes,
``@vocab`` and ``@language``; a term may be a text or an object of ``@id``, ``@type`` and ``@language``. Contexts are
resolved once each where documents share them. Anything deeper is put in error, not guessed at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinloom import model, sizing, vocab
from twinloom.functions import checks, uris
from twinloom.functions.identity import twin_identity
from twinloom.functions.lets import let
from twinloom.functions.properties import flat
from twinloom.session import materialize

QUAD = "struct<s:string,p:string,o:string,kind:string,datatype:string,lang:string>"
DEFAULT_GRAPH = "@default"
BLANK = "_:b0"
_CONTEXT_KEYWORDS = ("@vocab", "@language", "@version")
_TERM_KEYWORDS = ("@id", "@type", "@language")


def canonical_double(number: Column) -> Column:
    """XSD form of a double: one digit before the point, exponent behind ``E``."""
    zero = F.lit("0")

    def form(parts: Column, digits: Column, leading: Column, significant: Column) -> Column:
        rest = F.substring(significant, F.lit(2), F.length(significant))
        exponent = F.coalesce(F.get(parts, F.lit(1)).try_cast("int"), F.lit(0))
        shift = exponent + F.instr(F.get(parts, F.lit(0)), ".") - 2
        shift = shift - (F.length(digits) - F.length(leading))
        return F.concat(
            F.when(number < 0, F.lit("-")).otherwise(F.lit("")), F.substring(significant, 1, 1),
            F.lit("."), F.when(rest == "", zero).otherwise(rest), F.lit("E"), shift.cast("string"),
        )

    parts = F.split(F.abs(number).cast("string"), "E")
    made = let(parts, lambda ps: let(
        F.replace(F.get(ps, zero.cast("int")), F.lit("."), F.lit("")), lambda digits: let(
            F.ltrim(digits, zero), lambda leading: let(
                F.rtrim(leading, zero), lambda significant: form(ps, digits, leading, significant)
            ))))
    return F.when(number == 0, F.lit("0.0E0")).otherwise(made)


def _kind(value: Column) -> Column:
    """STRING, BIGINT, DECIMAL, DOUBLE, BOOLEAN, VOID, OBJECT or ARRAY."""
    return F.regexp_extract(F.schema_of_variant(value), r"^([A-Z]+)", 1)


def _text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def _is_compact(name: Column, context: Column) -> Column:
    """True for ``prefix:rest`` with a prefix of the context."""
    prefix, colon = F.substring_index(name, ":", 1), F.instr(name, ":")
    authority = F.substring(name, colon + 1, 2) == "//"
    return (colon > 0) & ~authority & F.map_contains_key(context, prefix)


def _expand_once(name: Column, context: Column) -> Column:
    """A term to what the context says, or ``prefix:rest`` to the prefix's text and the rest."""
    rest = F.substring(name, F.instr(name, ":") + 1, F.length(name))
    return F.when(F.map_contains_key(context, name), F.try_element_at(context, name)).when(
        _is_compact(name, context),
        F.concat(F.try_element_at(context, F.substring_index(name, ":", 1)), rest),
    ).otherwise(name)


def _resolved(context: Column) -> Column:
    """The context with its own terms and prefixes expanded.

    A round expands every value by what the rounds before have made of the others, so it goes
    twice as far as the last; a chain is no longer than the context, whose size sets the rounds.
    """
    rounds = F.sequence(F.lit(1), F.ceil(F.log2(F.size(context) + F.lit(2))).cast("int"))

    def expand(known: Column, _: Column) -> Column:
        return F.transform_values(
            known, lambda term, iri: F.when(term.startswith("@"), iri).otherwise(_expand_once(iri, known))
        )

    return F.aggregate(rounds, context, expand)


def _is_cyclic(context: Column) -> Column:
    """True if a value of a resolved context can still be expanded: its term stands for itself."""
    return F.exists(F.map_entries(context), lambda e: ~e["key"].startswith("@") & e["value"].isNotNull() & (
        F.map_contains_key(context, e["value"]) | _is_compact(e["value"], context)
    ))


def _definition(value: Column) -> Column:
    """The members of a term that is an object."""
    return F.when(_kind(value) == "OBJECT", F.try_variant_get(value, "$", "map<string,variant>"))


def _term_texts(given: Column) -> Column:
    """What each term of a context stands for; an object without ``@id`` leaves that to ``@vocab``."""
    def text(entry: Column) -> Column:
        value = entry["value"]
        named = _text(F.try_element_at(_definition(value), F.lit("@id")))
        return F.struct(
            entry["key"].alias("key"),
            F.when(_kind(value) == "STRING", _text(value)).when(_kind(value) == "OBJECT", named).alias("value"),
            ((_kind(value) != "OBJECT") | named.isNotNull()).alias("stands"),
        )

    kept = F.filter(F.transform(F.map_entries(given), text), lambda e: e["stands"])
    return F.map_from_entries(F.transform(kept, lambda e: F.struct(e["key"], e["value"])))


def _term_types(given: Column) -> Column:
    """``type``, ``tagged`` (a language is given, or none is wanted) and ``lang`` of terms that are objects."""
    objects = F.map_filter(given, lambda _, v: _kind(v) == "OBJECT")
    return F.transform_values(objects, lambda _, v: let(_definition(v), lambda d: F.struct(
        _text(F.try_element_at(d, F.lit("@type"))).alias("type"),
        F.map_contains_key(d, F.lit("@language")).alias("tagged"),
        _text(F.try_element_at(d, F.lit("@language"))).alias("lang"),
    )))


def _is_bad_definition(value: Column) -> Column:
    """True for an object with members beyond id, type and language, or with values that are no texts."""
    kind = _text(F.try_element_at(_definition(value), F.lit("@type")))
    return F.exists(F.map_entries(_definition(value)), lambda m: ~m["key"].isin(*_TERM_KEYWORDS) | ~(
        (_kind(m["value"]) == "STRING") | (m["key"] == "@language") & (_kind(m["value"]) == "VOID")
    )) | F.coalesce(kind.startswith("@") & ~kind.isin("@id", "@vocab"), F.lit(False))


def _absolute(name: Column, context: Column) -> Column:
    """An expanded name as a keyword or absolute IRI; null if it is neither."""
    return F.when(name.startswith("@") | name.startswith("_:") | uris.is_absolute(name), name).otherwise(
        F.concat(F.try_element_at(context, F.lit("@vocab")), name)
    )


def _expand_all(names: Column, context: Column) -> Column:
    """Absolute IRIs of a list of names; null for a name that has none."""
    return F.transform(names, lambda n: let(_expand_once(n, context), lambda e: _absolute(e, context)))


def _value_quad(subject: Column, entry: Column, language: Column, context: Column, term: Column) -> Column:
    """The quad of a value; ``term`` says how its term wants it to be read, if it does."""
    value, kind = entry["value"], entry["kind"]
    by_id = F.coalesce(term["type"].isin("@id", "@vocab") & (kind == "STRING"), F.lit(False))
    typed = term["type"].isNotNull() & ~term["type"].isin("@id", "@vocab")
    language = F.when(F.coalesce(term["tagged"], F.lit(False)), term["lang"]).otherwise(language)
    name = _text(value)
    whole = F.when((term["type"] == "@vocab") | _is_compact(name, context), _expand_once(name, context)).otherwise(name)
    iri = let(whole, lambda w: F.when(
        w.startswith("_:") | uris.is_absolute(w), w
    ).when(term["type"] == "@vocab", _absolute(w, context)))
    number = F.try_variant_get(value, "$", "double")
    # A decimal without digits behind the point is 5.0, or an integer too long for a bigint.
    long_integer = (F.abs(number) >= 9.3e18) & ~F.schema_of_variant(value).rlike(r",[1-9]")
    tagged = (kind == "STRING") & language.isNotNull() & ~typed
    plain = (
        F.when(tagged, F.lit(vocab.RDF_LANG_STRING))
        .when(kind == "STRING", F.lit(vocab.XSD + "string"))
        .when(kind == "BIGINT", F.lit(vocab.XSD + "integer"))
        .when(kind == "BOOLEAN", F.lit(vocab.XSD + "boolean"))
        .when((kind == "DECIMAL") & long_integer, F.lit(vocab.XSD + "integer"))
        .otherwise(F.lit(vocab.XSD + "double"))
    )
    wanted = let(_expand_once(term["type"], context), lambda t: _absolute(t, context))
    canonical = (kind != "STRING") & ((plain == vocab.XSD + "double") | (kind != "BOOLEAN") & typed & (wanted == vocab.XSD + "double"))
    return F.struct(
        subject.alias("s"), entry["iri"].alias("p"),
        F.when(by_id, iri).when(canonical, let(number, canonical_double)).otherwise(_text(value)).alias("o"),
        F.when(~by_id, F.lit("literal")).when(iri.startswith("_:"), F.lit("blank")).otherwise(F.lit("iri")).alias("kind"),
        F.when(~by_id, F.when(typed, wanted).otherwise(plain)).alias("datatype"),
        F.when(tagged & ~by_id, language).alias("lang"),
    )


def _texts(entry: Column) -> Column:
    """The texts of a type or an id: one, or a list of them."""
    listed = F.try_variant_get(entry["value"], "$", "array<string>")
    return F.when(entry["kind"] == "ARRAY", listed).otherwise(F.array(_text(entry["value"])))


def _entries(fields: Column, context: Column) -> Column:
    """The entries of a document that mean something, in the order of their terms."""
    def entry(key: Column, iri: Column) -> Column:
        return let(F.try_element_at(fields, key), lambda value: F.struct(
            key.alias("key"), value.alias("value"), _kind(value).alias("kind"), iri.alias("iri")
        ))

    keys = F.filter(F.sort_array(F.map_keys(fields)), lambda k: k != "@context")
    made = let(keys, lambda ks: let(
        _expand_all(ks, context), lambda iris: F.transform(ks, lambda k, i: entry(k, F.get(iris, i)))
    ))
    return F.filter(made, lambda e: e["iri"].isNotNull() & (e["kind"] != "VOID"))


def _named(entries: Column, keyword: str, context: Column) -> Column:
    """The expanded texts of ``@type`` or ``@id``."""
    texts = F.flatten(F.transform(F.filter(entries, lambda e: e["iri"] == keyword), _texts))
    return _expand_all(texts, context)


def _ordered_quads(entries: Column, types: Column, subject: Column, context: Column, terms: Column) -> Column:
    none = F.lit(None).cast("string")
    typed = F.transform(
        F.filter(types, lambda t: t.isNotNull()),
        lambda t, i: F.struct(F.lit("@type").alias("by"), F.lit("").alias("key"), i.alias("at"), F.struct(
            subject.alias("s"), F.lit(vocab.RDF_TYPE).alias("p"), t.alias("o"),
            F.when(t.startswith("_:"), F.lit("blank")).otherwise(F.lit("iri")).alias("kind"),
            none.alias("datatype"), none.alias("lang"),
        ).alias("q")),
    )
    language = F.try_element_at(context, F.lit("@language"))
    literals = F.transform(
        F.filter(entries, lambda e: ~e["iri"].startswith("@")),
        lambda e: F.struct(
            e["iri"].alias("by"), e["key"].alias("key"), F.lit(0).alias("at"),
            _value_quad(subject, e, language, context, F.try_element_at(terms, e["key"])).alias("q"),
        ),
    )
    # A reference that is no IRI leads nowhere.
    literals = F.filter(literals, lambda x: x["q"]["o"].isNotNull())
    ordered = F.sort_array(F.concat(typed, literals))
    return F.array_distinct(F.transform(ordered, lambda x: x["q"]))


# --- Contexts -----------------------------------------------------------------


def _context_of(root: Column) -> Column:
    """The context of a document as it is given, or null; a variant."""
    fields = F.try_variant_get(root, "$", "map<string,variant>")
    return let(fields, lambda f: F.try_element_at(f, F.lit("@context")))


def context_text(content: Column) -> Column:
    """The context of a document's text in a form of its own, the same for the same members in any order."""
    return let(F.try_parse_json(content), lambda root: F.to_json(_context_of(root)))


def resolve(context: Column) -> Column:
    """What a context (a variant) says: its expanded terms, how they are read, and what is wrong with it."""
    def of_given(given: Column) -> Column:
        bad = given.isNull() | F.exists(
            F.map_entries(given),
            lambda e: ~_kind(e["value"]).isin("STRING", "VOID", "OBJECT")
            | F.coalesce(_is_bad_definition(e["value"]), F.lit(False))
            | (e["key"].startswith("@") & ~e["key"].isin(*_CONTEXT_KEYWORDS)),
        )
        return let(let(_term_texts(given), _resolved), lambda expanded: F.struct(
            expanded.alias("context"), _term_types(given).alias("terms"),
            F.coalesce(bad, F.lit(True)).alias("bad"),
            F.coalesce(_is_cyclic(expanded), F.lit(False)).alias("cyclic"),
        ))

    none = F.from_json(F.lit("{}"), "map<string,variant>")
    given = F.when(context.isNull(), none).otherwise(F.try_variant_get(context, "$", "map<string,variant>"))
    return let(given, of_given)


def resolved_contexts(docs: DataFrame, content: str = "content") -> DataFrame:
    """``context_key, resolved`` of each distinct context of the documents, however often it is used."""
    texts = docs.select(context_text(F.col(content)).alias("text")).where("text is not null").distinct()
    return texts.select(
        F.sha2("text", 256).alias("context_key"), resolve(F.try_parse_json("text")).alias("resolved")
    )


# --- Documents ----------------------------------------------------------------


def _members(value: Column) -> Column:
    """The members of a graph, which is a list or one of them."""
    kind = _kind(value)
    return F.when(kind == "ARRAY", F.try_variant_get(value, "$", "array<variant>")).when(kind == "OBJECT", F.array(value))


def _fields(value: Column) -> Column:
    return F.try_variant_get(value, "$", "map<string,variant>")


def _nodes(fields: Column) -> Column:
    """The nodes of a document as ``struct(graph, fields, apart)``: one, or those that its graphs list.

    ``apart`` tells nodes that stand where none may: beside a graph, or with a context of their own.
    """
    graph, name = F.lit("@graph"), F.lit("@id")
    default = F.lit(DEFAULT_GRAPH)
    nothing = F.lit(None).cast("map<string,variant>")

    def node(of: Column, fields: Column) -> Column:
        alone = fields.isNull() | F.map_contains_key(fields, F.lit("@context"))
        return F.struct(of.alias("graph"), fields.alias("fields"), alone.alias("apart"))

    def only(fields: Column, *keys: str) -> Column:
        return F.forall(F.map_keys(fields), lambda k: k.isin(*keys))

    def named(of: Column, fields: Column, keys: tuple[str, ...]) -> Column:
        inner = _members(F.try_element_at(fields, graph))
        return F.when(inner.isNull() | ~only(fields, *keys), F.array(
            F.struct(of.alias("graph"), nothing.alias("fields"), F.lit(True).alias("apart"))
        )).otherwise(F.transform(inner, lambda n: let(_fields(n), lambda f: node(of, f))))

    def member(value: Column) -> Column:
        return let(_fields(value), lambda f: F.when(
            F.map_contains_key(f, graph), named(F.coalesce(_text(F.try_element_at(f, name)), F.lit("_:g")), f, ("@id", "@graph"))
        ).otherwise(F.array(node(default, f))))

    own = F.try_element_at(fields, name)
    listed = F.when(
        own.isNotNull(), named(_text(own), fields, ("@context", "@id", "@graph"))
    ).when(
        only(fields, "@context", "@graph") & _members(F.try_element_at(fields, graph)).isNotNull(),
        F.flatten(F.transform(_members(F.try_element_at(fields, graph)), member)),
    ).otherwise(F.array(F.struct(default.alias("graph"), nothing.alias("fields"), F.lit(True).alias("apart"))))
    whole = F.array(F.struct(default.alias("graph"), fields.alias("fields"), fields.isNull().alias("apart")))
    return F.when(F.map_contains_key(fields, graph), listed).otherwise(whole)


def _of_node(node: Column, blank: Column, resolved: Column) -> Column:
    """``struct(graph, quads, bad)`` of a node."""
    context = resolved["context"]

    def of_entries(entries: Column) -> Column:
        nested = F.exists(entries, lambda e: ~e["iri"].startswith("@") & e["kind"].isin("OBJECT", "ARRAY"))
        keyword = F.exists(entries, lambda e: e["iri"].startswith("@") & ~e["iri"].isin("@type", "@id"))

        def with_subject(ids: Column) -> Column:
            relative = (F.size(ids) > 0) & F.get(ids, F.lit(0)).isNull()
            subject = F.coalesce(F.get(ids, F.lit(0)), blank)
            types = _named(entries, "@type", context)
            quads = _ordered_quads(entries, types, subject, context, resolved["terms"])
            return F.when(relative, F.array().cast(f"array<{QUAD}>")).otherwise(quads)

        return F.struct(
            node["graph"].alias("graph"), let(_named(entries, "@id", context), with_subject).alias("quads"),
            (node["apart"] | nested | keyword).alias("bad"),
        )

    return let(_entries(node["fields"], context), of_entries)


def _by_graph(made: Column, context: Column) -> Column:
    """``array<struct(graph, quads)>``: the default graph, then others as they come; relative names lead nowhere."""
    named = F.transform(made, lambda m: F.struct(
        F.when(m["graph"] == DEFAULT_GRAPH, m["graph"]).otherwise(
            let(_expand_once(m["graph"], context), lambda n: _absolute(n, context))
        ).alias("graph"), m["quads"].alias("quads"),
    ))

    def grouped(nodes: Column) -> Column:
        names = F.array_distinct(F.transform(nodes, lambda n: n["graph"]))
        ordered = F.concat(
            F.filter(names, lambda g: g == DEFAULT_GRAPH), F.filter(names, lambda g: g != DEFAULT_GRAPH)
        )
        return F.transform(ordered, lambda g: F.struct(g.alias("graph"), F.array_distinct(F.flatten(F.transform(
            F.filter(nodes, lambda n: n["graph"] == g), lambda n: n["quads"]
        ))).alias("quads")))

    return let(F.filter(named, lambda n: n["graph"].isNotNull()), grouped)


def _of_document(content: Column, known: Column | None) -> Column:
    """``struct(graphs, error)`` of a document's text, its context ``known`` or still to be resolved."""
    def of_root(root: Column) -> Column:
        resolved = resolve(_context_of(root)) if known is None else known
        return let(_fields(root), lambda fields: let(resolved, lambda r: let(
            F.transform(_nodes(fields), lambda n, i: _of_node(n, F.concat(F.lit("_:b"), i.cast("string")), r)),
            lambda made: finish(root, fields, r, made),
        )))

    def finish(root: Column, fields: Column, resolved: Column, made: Column) -> Column:
        error = F.when(root.isNull(), F.lit(vocab.JSONLD_INVALID + vocab.JSONLD_MALFORMED)).when(
            fields.isNull() | resolved["bad"] | F.exists(made, lambda m: F.coalesce(m["bad"], F.lit(True))),
            F.lit(vocab.JSONLD_INVALID + vocab.JSONLD_UNSUPPORTED),
        ).when(resolved["cyclic"], F.lit(vocab.JSONLD_INVALID + vocab.JSONLD_CYCLIC))
        return let(error, lambda e: F.struct(
            F.when(e.isNull(), _by_graph(made, resolved["context"])).alias("graphs"), e.alias("error")
        ))

    return let(F.try_parse_json(content), of_root)


def to_graphs(docs: DataFrame, content: str = "content", small: bool | None = None) -> DataFrame:
    """Adds ``graphs`` (``graph, quads`` each, the default graph first) and ``error``.

    Documents mostly share a few contexts: these are resolved once each, and looked up by their digest
    if measured to be few. Contexts that are many, as where each document has one of its own, are
    resolved within their rows, where they need no shuffle. ``small`` skips the measuring.
    """
    if small is None and docs.isStreaming:
        small = False
    if small is not False:
        contexts = materialize(resolved_contexts(docs, content), "contexts")
        small = small or sizing.fits(contexts.select("context_key", F.col("resolved.context")))
    if small:
        keyed = docs.withColumn("_key", F.sha2(context_text(F.col(content)), 256))
        known = F.broadcast(contexts.select(F.col("context_key").alias("_key"), F.col("resolved").alias("_known")))
        nothing = resolve(F.lit(None).cast("variant"))  # a document without a context
        joined = keyed.join(known, "_key", "left")
        found = F.when(F.col("_key").isNull(), nothing).otherwise(F.col("_known"))
        made = joined.withColumn("_q", _of_document(F.col(content), found))
    else:
        made = docs.withColumn("_q", _of_document(F.col(content), None))
    return made.select(*docs.columns, "_q.graphs", "_q.error")


def first_graph(with_graphs: DataFrame) -> DataFrame:
    """``graph`` and ``quads`` of the first graph of each document; one without any is in error."""
    others = [c for c in with_graphs.columns if c not in ("graphs", "error")]
    first = F.get("graphs", F.lit(0))
    missing = F.when(F.size("graphs") == 0, F.lit(vocab.JSONLD_INVALID + vocab.JSONLD_NO_GRAPH))
    return with_graphs.select(
        *others, first["graph"].alias("graph"), first["quads"].alias("quads"), F.coalesce("error", missing).alias("error")
    )


def to_quads(docs: DataFrame, content: str = "content", small: bool | None = None) -> DataFrame:
    """Adds the ``quads`` of the first graph, in the order of nodes, predicate and term and each once, and ``error``."""
    return first_graph(to_graphs(docs, content, small)).select(*docs.columns, "quads", "error")


def explode_quads(with_quads: DataFrame) -> DataFrame:
    """One row per quad, in order.

    The outer explode adds no filter of its own, which would have to build the quads once more.
    """
    others = [c for c in with_quads.columns if c not in ("quads", "error")]
    rows = with_quads.select(*others, F.posexplode_outer("quads").alias("pos", "q"))
    return rows.where(F.col("pos").isNotNull()).select(*others, "pos", "q.*")


def identity_object(quads: Column, id_property: str = vocab.IDENTIFIER) -> Column:
    """The object of the first quad with the id property; null if there is none."""
    return F.get(F.filter(quads, lambda q: q["p"] == id_property), F.lit(0))["o"]


def quads_to_properties(quads: Column, default_allow_list: str) -> Column:
    """``struct(properties, error)`` of a document's quads.

    The allow list is decided by its last quad, or by the default where that is missing or
    invalid, and is added at the end. Objects that are blank nodes have no place in a twin.
    """
    default = checks.allow_list(F.lit(default_allow_list))
    plain = F.filter(quads, lambda q: q["p"] != vocab.HOST_ALLOW_LIST)

    def to_property(q: Column) -> Column:
        return (
            F.when(q["kind"] == "iri", flat(q["p"], q["o"], "Uri"))
            .when(q["lang"].isNotNull(), flat(q["p"], q["o"], "LangLiteral", q["lang"]))
            .otherwise(flat(q["p"], q["o"], "Literal", None, uris.short_data_type(q["datatype"])))
        )

    last = F.try_element_at(F.filter(quads, lambda q: q["p"] == vocab.HOST_ALLOW_LIST), F.lit(-1))
    decided = F.coalesce(checks.allow_list(last["o"]), default)
    reasons = F.filter(
        F.transform(plain, lambda q: F.when(q["kind"] == "blank", F.lit("blank node as object")).when(
            (q["kind"] == "literal") & q["lang"].isNull(), uris.data_type_error(q["datatype"])
        )),
        lambda e: e.isNotNull(),
    )
    error = F.when(
        default.isNull(), F.lit(vocab.BAD_ALLOW_LIST_DEFAULT + default_allow_list)
    ).otherwise(F.get(reasons, F.lit(0)))
    properties = F.array_append(
        F.transform(plain, to_property), flat(F.lit(vocab.HOST_ALLOW_LIST), decided, "Uri")
    )
    return F.struct(F.when(error.isNull(), properties).alias("properties"), error.alias("error"))


def build_twins(
    with_quads: DataFrame, seed: str, host_id: str, default_allow_list: str = vocab.ALLOW_NONE,
    id_property: str = vocab.IDENTIFIER,
) -> DataFrame:
    """Documents with quads to twins without ports, or an error each."""
    others = [c for c in with_quads.columns if c not in ("quads", "error")]
    found = with_quads.withColumn("_id", identity_object(F.col("quads"), id_property)).withColumn(
        "_p", quads_to_properties(F.col("quads"), default_allow_list)
    )
    missing = F.lit(f"{vocab.JSONLD_INVALID}missing '{id_property}'")
    error = F.coalesce("error", F.when(F.col("_id").isNull(), missing), F.col("_p.error"))
    return found.withColumn("error", error).select(
        *others, F.lit(host_id).alias("host_id"),
        F.when(F.col("error").isNull(), twin_identity(F.col("_id"), seed)).alias("twin_id"),
        F.when(F.col("error").isNull(), F.col("_p.properties")).alias("properties"),
        F.array().cast(f"array<{model.PORT}>").alias("feeds"),
        F.array().cast(f"array<{model.PORT}>").alias("inputs"), "error",
    )
