"""Properties of twins: flat rows, the typed union, and wanted properties of a search.

Every function takes and gives columns, so that it works on a row and inside ``transform``.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from twinloom import model, vocab
from twinloom.functions import uris


def flat(
    key: Column, value: Column, kind: Column | str, lang: Column | None = None,
    data_type: Column | None = None,
) -> Column:
    """A flat property struct."""
    none = F.lit(None).cast("string")
    return F.struct(
        key.cast("string").alias("key"),
        value.cast("string").alias("value"),
        (F.lit(kind) if isinstance(kind, str) else kind).cast("string").alias("type"),
        (none if lang is None else lang.cast("string")).alias("lang"),
        (none if data_type is None else data_type.cast("string")).alias("dataType"),
    )


def or_empty(items: Column, element: str) -> Column:
    """The list, or an empty one for null."""
    return F.coalesce(items, F.from_json(F.lit("[]"), f"array<{element}>"))


def find_property(properties: Column, key: Column | str) -> Column:
    """The first property with this key; null if there is none."""
    key = F.lit(key) if isinstance(key, str) else key
    return F.get(F.filter(properties, lambda p: p["key"] == key), F.lit(0))


def flatten_union(union: Column) -> Column:
    """Typed union to ``struct(property, error)``; the first member set decides."""
    key = union["key"]
    literal, lang_literal = union["literalValue"], union["langLiteralValue"]
    uri, string_literal = union["uriValue"], union["stringLiteralValue"]
    found = (
        F.when(literal.isNotNull(), flat(key, literal["value"], "Literal", None, literal["dataType"]))
        .when(lang_literal.isNotNull(), flat(key, lang_literal["value"], "LangLiteral", lang_literal["lang"]))
        .when(uri.isNotNull(), flat(key, uri["value"], "Uri"))
        .when(string_literal.isNotNull(), flat(key, string_literal["value"], "StringLiteral"))
    )
    error = F.when(union.isNull(), F.lit(vocab.PROPERTY_NULL)).when(
        found.isNull(), F.concat(F.lit(vocab.PROPERTY_NO_MEMBER), F.coalesce(key, F.lit("")))
    )
    return F.struct(found.alias("property"), error.alias("error"))


def property_error(prop: Column) -> Column:
    """Why a flat property cannot be typed; null if it can. Key, value and type in turn."""
    kind = prop["type"]
    return (
        F.when(prop["key"].isNull(), F.lit(vocab.PROPERTY_NO_KEY))
        .when(prop["value"].isNull(), F.lit(vocab.PROPERTY_NO_VALUE))
        .when(
            kind.isNull() | ~kind.isin(*vocab.PROPERTY_TYPES),
            F.concat(F.lit(vocab.PROPERTY_BAD_TYPE), F.coalesce(kind, F.lit("null"))),
        )
        .when((kind == "LangLiteral") & prop["lang"].isNull(), F.lit(vocab.PROPERTY_NO_LANG))
        .when(kind == "Literal", uris.data_type_error(prop["dataType"]))
    )


def typed_union(prop: Column) -> Column:
    """Flat property to the typed union; null where ``property_error`` has a reason."""
    kind, value = prop["type"], prop["value"]

    def member(name: str, *fields: Column) -> Column:
        return F.when(kind == name, F.struct(*fields))

    text = value.alias("value")
    union = F.struct(
        prop["key"].alias("key"),
        member("Literal", text, uris.short_data_type(prop["dataType"]).alias("dataType"))
        .alias("literalValue"),
        member("LangLiteral", text, prop["lang"].alias("lang")).alias("langLiteralValue"),
        member("Uri", text).alias("uriValue"),
        member("StringLiteral", text).alias("stringLiteralValue"),
    )
    return F.when(property_error(prop).isNull(), union)


def property_errors(properties: Column) -> Column:
    """The reasons of all properties of a list that cannot be typed."""
    return F.filter(F.transform(properties, property_error), lambda e: e.isNotNull())


def value_metadata(values: Column) -> Column:
    """Label, data type and comment of each value; the content is left out."""
    return F.transform(
        values,
        lambda v: F.struct(
            v["label"].alias("label"), v["dataType"].alias("dataType"), v["comment"].alias("comment")
        ),
    )


def spec_error(spec: Column) -> Column:
    """Why a wanted property is not usable; null if it is."""
    return (
        F.when(spec.isNull() | spec["key"].isNull(), F.lit(vocab.SPEC_NO_KEY))
        .when(
            spec["literal"].isNotNull(),
            F.when(spec["dataType"].isNull(), F.lit(vocab.SPEC_NO_DATATYPE)),
        )
        .when(
            spec["langLiteral"].isNotNull(),
            F.when(spec["lang"].isNull(), F.lit(vocab.SPEC_NO_LANG)),
        )
        .when(
            spec["stringLiteral"].isNull() & spec["uri"].isNull(), F.lit(vocab.SPEC_NO_VALUE)
        )
    )


def spec_property(spec: Column) -> Column:
    """The flat property a wanted property asks for; null where ``spec_error`` has a reason."""
    key = spec["key"]
    wanted = (
        F.when(spec["literal"].isNotNull(), flat(key, spec["literal"], "Literal", None, spec["dataType"]))
        .when(spec["langLiteral"].isNotNull(), flat(key, spec["langLiteral"], "LangLiteral", spec["lang"]))
        .when(spec["stringLiteral"].isNotNull(), flat(key, spec["stringLiteral"], "StringLiteral"))
        .otherwise(flat(key, spec["uri"], "Uri"))
    )
    return F.when(spec_error(spec).isNull(), wanted)


def spec_list_error(text: Column) -> Column:
    """Reasons of a JSON array of wanted properties, joined by ``", "``; null if all are usable."""
    specs = F.from_json(text, f"array<{model.PROPERTY_SPEC}>")
    is_array = text.rlike(r"^\s*\[")
    reasons = F.filter(F.transform(specs, spec_error), lambda e: e.isNotNull())
    return F.when(
        text.isNull() | ~is_array | specs.isNull(), F.lit(vocab.SPECS_BAD_JSON + "not an array")
    ).when(F.size(reasons) > 0, F.array_join(reasons, ", "))
