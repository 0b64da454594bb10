"""Reshape flat records into twins, or into flat JSON-LD documents."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from twinloom import model
from twinloom.functions.properties import flat


@dataclass(frozen=True)
class PropertyRule:
    """One property: its key and type, the column it is moved from, and a value for none."""

    key: str
    type: str
    column: str | None = None
    default: str | None = None
    data_type: str | None = None


@dataclass(frozen=True)
class TwinRules:
    """How records become twins: properties in order, and constant ports."""

    properties: list[PropertyRule]
    feeds: list[dict] = field(default_factory=list)
    inputs: list[dict] = field(default_factory=list)


@dataclass(frozen=True)
class LinkedRules:
    """How records become JSON-LD: casts, context and type."""

    context: dict[str, str]
    type: str
    integers: tuple[str, ...] = ()
    booleans: tuple[str, ...] = ()


def concat_default(
    df: DataFrame, name: str, columns: list[str], separator: str = " ", overwrite: bool = False
) -> DataFrame:
    """Adds a column made of others where it has no value yet, or anyway if it is to be overwritten.

    Nothing is made where one of the others is null, so that a default may still apply.
    """
    spaced = [part for c in columns for part in (F.lit(separator), F.col(c).cast("string"))][1:]
    made = F.concat(*spaced)
    keep = name in df.columns and not overwrite
    return df.withColumn(name, F.coalesce(F.col(name), made) if keep else made)


def reshape_twin(df: DataFrame, rules: TwinRules) -> DataFrame:
    """Adds ``twin``: the columns moved into properties, the rest filled from the rules."""
    def value(rule: PropertyRule) -> Column:
        default = F.lit(rule.default).cast("string")
        if rule.column is None or rule.column not in df.columns:
            return default
        return F.coalesce(F.col(rule.column).cast("string"), default)

    properties = F.array(*[
        flat(F.lit(r.key), value(r), r.type, None, F.lit(r.data_type)) for r in rules.properties
    ])

    def ports(items: list[dict]) -> Column:
        return F.from_json(F.lit(json.dumps(items)), f"array<{model.PORT}>")

    none = F.lit(None).cast("string")
    return df.withColumn("twin", F.struct(
        none.alias("hostId"), none.alias("id"), properties.alias("properties"),
        ports(rules.feeds).alias("feeds"), ports(rules.inputs).alias("inputs"),
    ))


def to_integer(text: Column) -> Column:
    """The integer a text stands for; null if it stands for none."""
    return text.cast("string").try_cast("int")


def to_boolean(text: Column) -> Column:
    """Only ``true`` and ``false``, in any case, are booleans."""
    lowered = F.lower(text.cast("string"))
    return F.when(lowered.isin("true", "false"), lowered == "true")


def reshape_linked(df: DataFrame, rules: LinkedRules) -> DataFrame:
    """Adds ``document``: the record as JSON-LD, cast columns typed where the cast succeeds.

    A value that cannot be cast stays text, so the type of a field may differ by record; the
    document therefore holds either the cast field or the text, never both.
    """
    context = F.from_json(F.lit(json.dumps(rules.context)), "map<string,string>")

    def scalar(name: str) -> Column:
        cast = {**dict.fromkeys(rules.integers, to_integer), **dict.fromkeys(rules.booleans, to_boolean)}
        text = F.col(name).cast("string")
        if name not in cast:
            return F.when(text.isNotNull(), F.to_variant_object(F.struct(text.alias("v"))))
        typed = cast[name](F.col(name))
        return F.when(typed.isNotNull(), F.to_variant_object(F.struct(typed.alias("v")))).when(
            text.isNotNull(), F.to_variant_object(F.struct(text.alias("v")))
        )

    fields = [F.try_variant_get(scalar(c), "$.v", "variant").alias(c) for c in df.columns]
    document = F.to_json(F.struct(context.alias("@context"), F.lit(rules.type).alias("@type"), *fields))
    return df.withColumn("document", document)
