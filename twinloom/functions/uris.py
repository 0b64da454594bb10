"""URI texts: legality, scheme, fragment, and the data type short name."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from twinloom import vocab

# --- Fixed values: the characters RFC 2396 allows, with non-ASCII letters ---
_MARKS = r"A-Za-z0-9_.!~*'();:@&=+$,\-"
_OTHER = r"\x{80}-\x{10FFFF}&&[^\p{Z}\p{Cc}]"
_ESCAPE = r"%[0-9A-Fa-f]{2}"
_PATH = rf"(?:[{_MARKS}/]|[{_OTHER}]|{_ESCAPE})"
_ANY = rf"(?:[{_MARKS}/?\[\]]|[{_OTHER}]|{_ESCAPE})"
_HOST = rf"(?:(?:[{_MARKS}]|[{_OTHER}]|{_ESCAPE})+|\[[0-9A-Fa-f:.]+\](?::[0-9]*)?)"
_SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*:"
# //host[/path], or /path, each with an optional ?query
_HIERARCHY = rf"(?://{_HOST}(?:/{_PATH}*)?|///{_PATH}*|/(?!/){_PATH}*)(?:\?{_ANY}*)?"
# scheme:anything that does not start with a slash
_OPAQUE = rf"(?!/){_ANY}+"
_RELATIVE = rf"(?![^/?#]*:){_PATH}*(?:\?{_ANY}*)?"
LEGAL = rf"^(?:{_SCHEME}(?:{_HIERARCHY}|{_OPAQUE})|{_HIERARCHY}|{_RELATIVE})(?:#{_ANY}*)?\z"
ABSOLUTE = rf"^{_SCHEME}"


def is_legal(text: Column) -> Column:
    return text.rlike(LEGAL)


def is_absolute(text: Column) -> Column:
    """True for a text that starts with a scheme; legality is a question of its own."""
    return text.rlike(ABSOLUTE)


def fragment(text: Column) -> Column:
    """The part after ``#``; null where there is none."""
    return F.when(text.contains("#"), F.regexp_extract(text, "#(.*)$", 1))


def detect_uri(text: Column) -> Column:
    """``struct(datatype, error)``: ``anyURI`` for an absolute URI, an error for an illegal one."""
    legal = is_legal(text)
    return F.struct(
        F.when(legal & is_absolute(text), F.lit("anyURI")).alias("datatype"),
        F.when(text.isNotNull() & ~legal, F.lit(vocab.URI_ILLEGAL)).alias("error"),
    )


def short_data_type(data_type: Column) -> Column:
    """``string`` by default, the fragment of an absolute URI, else the name as it is."""
    return (
        F.when(data_type.isNull(), F.lit("string"))
        .when(is_absolute(data_type), fragment(data_type))
        .otherwise(data_type)
    )


def data_type_error(data_type: Column) -> Column:
    """Why ``short_data_type`` has no answer; null where it has one."""
    return F.when(
        data_type.isNotNull() & ~is_legal(data_type), F.lit(vocab.DATATYPE_ILLEGAL)
    ).when(
        is_absolute(data_type) & ~data_type.contains("#"), F.lit(vocab.DATATYPE_NO_FRAGMENT)
    )
