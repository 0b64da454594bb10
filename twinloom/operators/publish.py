"""Publish: the values of feeds as shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from twinloom import vocab
from twinloom.operators.route import error_document
from twinloom.sources.documents import explode_twins, text_bytes, to_document


def payload_error(values: Column) -> Column:
    """Why a list of values is no payload; null if it is one. An empty list is no error."""
    labels = F.transform(values, lambda v: v["label"])
    return (
        F.when(values.isNull(), F.lit(vocab.VALUES_MISSING))
        .when(F.exists(values, lambda v: v["label"].isNull()), F.lit(vocab.LABEL_NULL))
        .when(F.exists(values, lambda v: v["value"].isNull()), F.lit(vocab.VALUE_NULL))
        .when(F.size(F.array_distinct(labels)) < F.size(labels), F.lit(vocab.LABEL_DUPLICATE))
    )


def checked_payload(values: Column) -> Column:
    """JSON object of label and content of values that have no error.

    A repeated label would stop the job, so others must be null here.
    """
    pairs = F.transform(values, lambda v: F.struct(v["label"], v["value"]))
    return F.to_json(F.map_from_entries(pairs))


def payload(values: Column) -> Column:
    """JSON object of label and content; null for a list with an error."""
    return checked_payload(F.when(payload_error(values).isNull(), values))


def set_values(values: Column, content: Column) -> Column:
    """Put the content given per label into the first value of that label; other keys are ignored."""
    labels = F.transform(values, lambda v: v["label"])

    def update(value: Column, at: Column) -> Column:
        first = F.array_position(labels, value["label"]) == at + 1
        new = F.when(
            first & F.map_contains_key(content, value["label"]), F.try_element_at(content, value["label"])
        ).otherwise(value["value"])
        return F.struct(
            value["label"].alias("label"), value["dataType"].alias("dataType"),
            value["comment"].alias("comment"), new.alias("value"),
        )

    return F.transform(values, update)


def fan_out(parsed: DataFrame) -> DataFrame:
    """Documents to one row per feed of each twin.

    A twin without a feeds list keeps one row with a null feed, so that it is not lost.
    """
    twins = explode_twins(parsed)
    feeds = F.coalesce(F.col("twin.feeds"), _missing_feeds(parsed))
    return twins.select(*twins.columns, F.posexplode(feeds).alias("feed_pos", "feed"))


def _missing_feeds(parsed: DataFrame) -> Column:
    """A list of one null feed, in place of a list that is missing."""
    feed = parsed.schema["twins"].dataType.elementType["feeds"].dataType.elementType
    return F.array(F.lit(None).cast(feed))


def feed_error(twin_id: Column, feed: Column) -> Column:
    """Why a feed of a twin cannot be shared; null if it can, or has nothing to share."""
    has_values = F.size(feed["values"]) > 0
    return F.coalesce(
        F.when(feed.isNull(), F.lit(vocab.FEEDS_MISSING)),
        payload_error(feed["values"]),
        F.when(has_values & twin_id.isNull(), F.lit(vocab.TWIN_ID_MISSING)),
        F.when(has_values & feed["id"].isNull(), F.lit(vocab.FEED_ID_MISSING)),
    )


def publish(parsed: DataFrame) -> DataFrame:
    """One row per feed: route, error, share and output document.

    A success shows the whole input twin, which is written once per twin and not per feed. Feeds
    without values are skipped, not failed.
    """
    twins = explode_twins(parsed).select(
        "doc_id", "twin_pos", F.col("twin.hostId").alias("host_id"), F.col("twin.id").alias("twin_id"),
        F.coalesce(F.col("twin.feeds"), _missing_feeds(parsed)).alias("feeds"),
        to_document(F.col("twin")).alias("twin_document"),
    )
    events = twins.select(*twins.columns, F.posexplode("feeds").alias("feed_pos", "feed")).drop("feeds")
    values = F.col("feed.values")
    events = events.withColumn("error", feed_error(F.col("twin_id"), F.col("feed")))
    shared = F.col("error").isNull() & (F.size(values) > 0)
    failed = F.col("error").isNotNull()
    error_field = F.substring(error_document(F.col("error")), F.lit(2), F.length(error_document(F.col("error"))))
    return events.select(
        "doc_id", "twin_pos", "feed_pos",
        F.when(failed, F.lit("failure")).when(shared, F.lit("success")).otherwise(F.lit("skipped")).alias("route"),
        "error", "host_id", "twin_id", F.col("feed.id").alias("feed_id"),
        checked_payload(F.when(shared, values)).alias("payload"),
        F.when(shared, F.col("twin_document"))
        .when(failed, F.concat(F.lit('{"twin":'), "twin_document", F.lit(","), error_field))
        .alias("document"),
    )


def shares_of(published: DataFrame, occurred_at: Column) -> DataFrame:
    """The successful rows as shares, ready for the sink."""
    return published.where(F.col("route") == "success").select(
        "host_id", "twin_id", "feed_id", F.lit("application/json").alias("mime_type"),
        occurred_at.alias("occurred_at"), text_bytes(F.col("payload")).alias("payload"),
    )


def feed_total(twins: Column) -> Column:
    """How many feeds the twins of a document have together."""
    sizes = F.transform(twins, lambda t: F.greatest(F.size(F.coalesce(t["feeds"], F.array())), F.lit(0)))
    return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda total, n: total + n)


def document_status(parsed: DataFrame) -> DataFrame:
    """One row per document: its feeds, the outcomes of publishing them, and its own route.

    A document is one row, so its outcomes are counted within it.
    """
    missing = _missing_feeds(parsed)

    def outcomes(twin: Column) -> Column:
        return F.transform(F.coalesce(twin["feeds"], missing), lambda feed: F.when(
            feed_error(twin["id"], feed).isNotNull(), F.lit("failure")
        ).when(F.size(feed["values"]) > 0, F.lit("success")).otherwise(F.lit("skipped")))

    found = F.flatten(F.transform(F.coalesce("twins", F.array().cast(parsed.schema["twins"].dataType)), outcomes))

    def counted(route: str) -> Column:
        return F.size(F.filter("_found", lambda r: r == route)).cast("bigint")

    listed = parsed.withColumn("_found", found)
    return listed.select(
        "doc_id", F.coalesce(feed_total(F.col("twins")), F.lit(0)).cast("bigint").alias("n_feeds"),
        counted("success").alias("n_success"), counted("failure").alias("n_failure"),
        counted("skipped").alias("n_skipped"), "error",
        F.when(F.col("error").isNotNull(), F.lit("failure")).otherwise(F.lit("original")).alias("route"),
    )
