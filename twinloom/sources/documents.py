"""Twin documents: JSON text to twins and back, and the text of a request.

There are two ways to read a twin. The plain way keeps a missing list null, so that later steps
can tell it from an empty one. The tolerant way, used when twins are built, gives an empty list
for anything that is not a list. Neither ever stops a job: a bad document gets an ``error``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from twinloom import model, vocab
from twinloom.functions.lets import let
from twinloom.functions.properties import or_empty

_SHALLOW_TWIN = "struct<hostId:string,id:string,properties:string,feeds:string,inputs:string,_bad:string>"
_SHALLOW_PORT = "struct<id:string,properties:string,storeLast:string,values:string>"


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files as documents: ``doc_id`` is the file, ``content`` its text."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("doc_id"), F.col("value").alias("content")
    )


def read_document_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """One document per line, in a batch or as a stream; ``path`` holds text files."""
    reader = spark.readStream if streaming else spark.read
    return reader.text(path).select(F.col("value").alias("content"))


def parse_documents(docs: DataFrame, content: str = "content") -> DataFrame:
    """The plain way: adds ``twins`` (from an array of twins or one twin) and ``error``.

    A document in error has null ``twins``; the other documents go on.
    """
    text = F.col(content)
    parsed = docs.withColumn("twins", F.from_json(text, f"array<{model.TWIN}>"))
    starts = F.regexp_extract(text, r"^\s*(.)", 1)
    broken = F.try_parse_json(text).isNull()
    error = F.when(F.col("twins").isNull() | ~starts.isin("[", "{"),
        F.when(broken, F.lit(vocab.DOCUMENT_MALFORMED)).otherwise(F.lit(vocab.DOCUMENT_NOT_TWINS)),
    ).when(
        F.exists("twins", lambda t: t.isNull()), F.lit(vocab.DOCUMENT_NOT_TWINS)
    )
    return parsed.withColumn("error", error).withColumn(
        "twins", F.when(F.col("error").isNull(), F.col("twins"))
    )


def explode_twins(parsed: DataFrame) -> DataFrame:
    """One row per twin of a parsed document, as a column ``twin``; documents in error are left out."""
    others = [c for c in parsed.columns if c not in ("twins", "error")]
    return parsed.select(*others, F.posexplode("twins").alias("twin_pos", "twin"))


def _list_text(text: Column) -> Column:
    """The text of a list; null for anything else."""
    return F.when(text.startswith("["), text)


def _structs(text: Column, element: str) -> Column:
    """The list in ``text``; empty where it is no list, null where an entry is no object."""
    listed = _list_text(text)
    parsed = F.from_json(listed, f"array<{element}>")
    return F.when(listed.isNull(), F.from_json(F.lit("[]"), f"array<{element}>")).otherwise(parsed)


def _ports(text: Column) -> Column:
    """Ports read the tolerant way; a null entry stands for a port that is not an object."""
    def port(p: Column) -> Column:
        return F.struct(
            p["id"].alias("id"),
            _structs(p["properties"], model.PROPERTY).alias("properties"),
            F.coalesce(F.lower(p["storeLast"]) == "true", F.lit(False)).alias("storeLast"),
            _structs(p["values"], model.VALUE).alias("values"),
        )

    return F.transform(_structs(text, _SHALLOW_PORT), lambda p: F.when(p.isNotNull(), port(p)))


def _twin_error(content: Column, shallow: Column, lists: Column) -> Column:
    """Why a text is no twin; null if it is one."""
    is_object = F.coalesce(content.rlike(r"^\s*\{") & shallow["_bad"].isNull(), F.lit(False))
    all_ports = F.concat(lists["feeds"], lists["inputs"])  # null if either is
    bad_entry = (
        lists["properties"].isNull() | all_ports.isNull()
        | F.exists(lists["properties"], lambda p: p.isNull())
        | F.exists(all_ports, lambda p: p.isNull() | p["properties"].isNull() | p["values"].isNull())
    )
    return (
        F.when(~is_object, F.lit(vocab.TWIN_NOT_OBJECT))
        .when(bad_entry, F.lit(vocab.TWIN_BAD_LIST))
        .when(F.exists(all_ports, lambda p: p["id"].isNull()), F.lit(vocab.PORT_NO_ID))
    )


def _twin_of(content: Column) -> Column:
    """``struct(error, twin)`` of a text."""
    def with_lists(shallow: Column) -> Column:
        lists = F.struct(
            _structs(shallow["properties"], model.PROPERTY).alias("properties"),
            _ports(shallow["feeds"]).alias("feeds"), _ports(shallow["inputs"]).alias("inputs"),
        )
        return let(lists, lambda ls: let(_twin_error(content, shallow, ls), lambda error: F.struct(
            error.alias("error"),
            F.when(error.isNull(), F.struct(
                shallow["hostId"].alias("hostId"), shallow["id"].alias("id"),
                *[ls[name].alias(name) for name in ("properties", "feeds", "inputs")],
            )).alias("twin"),
        )))

    return let(F.from_json(content, _SHALLOW_TWIN, {"columnNameOfCorruptRecord": "_bad"}), with_lists)


def parse_twins(docs: DataFrame, content: str = "content") -> DataFrame:
    """The tolerant way, one twin per document: adds ``error`` and ``twin``.

    Lists that are missing or no lists become empty, unknown fields are ignored. A port without
    ``id`` puts the whole twin in error.
    """
    return docs.withColumn("_t", _twin_of(F.col(content))).select(*docs.columns, "_t.error", "_t.twin")


def twin_struct(host_id: str = "host_id", twin_id: str = "twin_id") -> Column:
    """The document form of a row of a twin table."""
    return F.struct(
        F.col(host_id).alias("hostId"), F.col(twin_id).alias("id"),
        F.col("properties"), F.col("feeds"), F.col("inputs"),
    )


def with_empty_lists(twin: Column) -> Column:
    """The twin with an empty list in place of each missing one, in its ports too."""
    def port(p: Column) -> Column:
        return F.struct(
            p["id"].alias("id"),
            or_empty(p["properties"], model.PROPERTY).alias("properties"),
            F.coalesce(p["storeLast"], F.lit(False)).alias("storeLast"),
            or_empty(p["values"], model.VALUE).alias("values"),
        )

    def ports(name: str) -> Column:
        return F.transform(or_empty(twin[name], model.PORT), port).alias(name)

    return F.struct(
        twin["hostId"].alias("hostId"), twin["id"].alias("id"),
        or_empty(twin["properties"], model.PROPERTY).alias("properties"),
        ports("feeds"), ports("inputs"),
    )


def to_document(struct: Column) -> Column:
    """JSON text of a twin; fields that are null are left out."""
    return F.to_json(struct)


def request_text(attribute: Column, content: Column) -> Column:
    """The text in ``attribute``, else ``content`` with plain line ends and no final one."""
    lines = F.regexp_replace(F.regexp_replace(content, r"\r\n?", "\n"), r"\n\z", "")
    return F.coalesce(attribute, lines)


def text_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def bytes_text(data: Column) -> Column:
    return F.decode(data, "UTF-8")
