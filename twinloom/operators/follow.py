"""Follow: who follows which feeds, and the shares that reach them."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from twinloom import model, sizing, vocab
from twinloom.functions.identity import twin_identity
from twinloom.functions.properties import flat

FEED = ["host_id", "twin_id", "feed_id"]


def follower_twins(definitions: DataFrame, seed: str, host_id: str) -> DataFrame:
    """``definitions(key_name, label, comment, type)`` to the twins that follow, as a twin table."""
    feed_properties = F.array(
        flat(F.lit(vocab.RDFS_LABEL), F.lit(vocab.FOLLOWER_FEED_LABEL), "StringLiteral"),
        flat(F.lit(vocab.RDFS_COMMENT), F.lit(vocab.FOLLOWER_FEED_COMMENT), "StringLiteral"),
    )
    value = F.struct(
        F.lit(vocab.FOLLOWER_VALUE_LABEL).alias("label"), F.lit("boolean").alias("dataType"),
        F.lit(vocab.FOLLOWER_VALUE_COMMENT).alias("comment"),
        F.lit(None).cast("string").alias("value"),
    )
    status = F.struct(
        F.lit(vocab.FOLLOWER_FEED).alias("id"), feed_properties.alias("properties"),
        F.lit(False).alias("storeLast"), F.array(value).alias("values"),
    )
    return definitions.select(
        F.lit(host_id).alias("host_id"),
        twin_identity(F.col("key_name"), seed).alias("twin_id"),
        F.array(
            flat(F.lit(vocab.HOST_ALLOW_LIST), F.lit(vocab.ALLOW_ALL), "Uri"),
            flat(F.lit(vocab.RDF_TYPE), F.col("type"), "Uri"),
            flat(F.lit(vocab.RDFS_LABEL), F.col("label"), "StringLiteral"),
            flat(F.lit(vocab.RDFS_COMMENT), F.col("comment"), "StringLiteral"),
        ).alias("properties"),
        F.array(status).alias("feeds"),
        F.array().cast(f"array<{model.PORT}>").alias("inputs"),
        F.lit(vocab.FOLLOWER_PAYLOAD).alias("payload"),
    )


def interests_of(twins: DataFrame, follower_twin_id: Column) -> DataFrame:
    """One row per feed of the twins to follow: the feed and who follows it."""
    fed = twins.select("host_id", "twin_id", F.explode("feeds").alias("feed"), follower_twin_id.alias("follower_twin_id"))
    return fed.select(
        "host_id", "twin_id", F.col("feed.id").alias("feed_id"),
        F.coalesce("feed.storeLast", F.lit(False)).alias("store_last"), "follower_twin_id",
    )


#: Followers of one feed that a single task takes without being split.
FOLLOWERS_TOGETHER = 10_000


def feed_counts(shares: DataFrame) -> DataFrame:
    """``n`` shares of each feed; a task sends on one row a feed."""
    return shares.groupBy(*FEED).agg(F.count("*").alias("n"))


def follow(
    shares: DataFrame, interests: DataFrame, small: bool | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Shares of followed feeds, once per follower, in a batch or as a stream.

    ``interests`` should be a stored table. It is broadcast if measured to be small. Otherwise shares of feeds that
    nobody follows are left behind by a broadcast filter of the feeds; of the rest, feeds that hold a large
    part of the shares or have very many followers are split by their weight, and all others joined plainly.
    ``counts`` are those of ``feed_counts``; a batch without them counts the followed shares, a stream
    joins plainly. ``small`` skips the measuring.
    """
    if small is None:
        small = sizing.fits(interests)
    wanted = interests.select(*FEED, "follower_twin_id")
    if small:
        joined = shares.join(F.broadcast(wanted), FEED)
    else:
        followed = sizing.might_hold(wanted, FEED)(shares)
        if counts is None and not shares.isStreaming:
            counts = feed_counts(followed)
        if counts is None:
            joined = followed.join(wanted, FEED)
        else:
            busy = sizing.heavy_keys(counts, FEED)
            liked = sizing.heavy_keys(feed_counts(wanted), FEED, least=FOLLOWERS_TOGETHER)
            share = F.struct("occurred_at", "payload")
            joined = sizing.weighted_join(followed, wanted, FEED, share, busy, F.col("follower_twin_id"), liked)
    return joined.select("follower_twin_id", *shares.columns)


def moment(time: Column, number: Column) -> Column:
    """A time and a whole number as one decimal that sorts like the two, nulls first.

    Of fixed width, so that its maximum is kept in place by a hash aggregation.
    """
    micros = F.coalesce(F.unix_micros(time.cast("timestamp")), F.lit(-(1 << 62))).cast("decimal(19,0)")
    within = F.coalesce(number.cast("decimal(19,0)"), F.lit(Decimal(-(1 << 63))))
    return (micros * F.lit(Decimal(1 << 64)) + within).cast("decimal(38,0)")


def last_stored(shares: DataFrame, order: tuple[str, str] = ("occurred_at", "event_id")) -> DataFrame:
    """The most recent share of each feed, by time and number; between equals the content decides.

    The greatest moment of each feed is found by a hash aggregation: every task sends on one number per feed
    it saw, however many shares a busy feed has. Then shares meet it by feed and moment, so that those of
    a busy feed are spread over all tasks, and hardly more than one per feed is left.
    """
    timed = shares.withColumn("_moment", moment(F.col(order[0]), F.col(order[1])))
    newest = timed.groupBy(*FEED).agg(F.max("_moment").alias("_last"))
    # Renamed, as feeds may have null ids.
    newest = newest.select(*[F.col(c).alias(f"_{c}") for c in FEED], "_last")
    same = F.col("_moment") == F.col("_last")
    for c in FEED:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    left = timed.join(newest, same, "left_semi")
    first = Window.partitionBy(*FEED).orderBy(F.xxhash64(*shares.columns))
    return left.withColumn("_place", F.row_number().over(first)).where("_place = 1").select(*shares.columns)


def of_interest(shares: DataFrame, interests: DataFrame, small: bool) -> DataFrame:
    """Shares of feeds somebody follows, each once."""
    feeds = interests.select(*FEED).distinct()
    if small:
        return shares.join(F.broadcast(feeds), FEED, "left_semi")
    return sizing.might_hold(feeds, FEED)(shares).join(feeds, FEED, "left_semi")


def snapshot(
    shares: DataFrame, interests: DataFrame, until: Column, small: bool | None = None
) -> DataFrame:
    """What a new follower gets first: the last share, up to ``until``, of each stored feed."""
    if small is None:
        small = sizing.fits(interests)
    stored = interests.where("store_last")
    past = of_interest(shares.where(F.col("occurred_at") <= until), stored, small)
    return follow(last_stored(past), stored, small)


def snapshot_then_live(shares: DataFrame, interests: DataFrame, until: Column) -> DataFrame:
    """The snapshot and every later share, with a column ``phase``. Nothing is lost or repeated."""
    small = sizing.fits(interests)
    first = snapshot(shares, interests, until, small).withColumn("phase", F.lit("snapshot"))
    live = follow(shares.where(F.col("occurred_at") > until), interests, small)
    return first.unionByName(live.withColumn("phase", F.lit("live")))
