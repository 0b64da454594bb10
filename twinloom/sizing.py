"""Broadcast only what was measured to be small."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from twinloom.session import materialize

MAX_ROWS = 200_000
MAX_BYTES = 32 * 1024 * 1024


def fits(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """True if ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of JSON text.

    Reads at most ``max_rows + 1`` rows, so that a large input is found out early.
    """
    row_bytes = F.octet_length(F.to_json(F.struct("*")))
    rows, size = (
        df.limit(max_rows + 1).agg(F.count("*"), F.coalesce(F.sum(row_bytes), F.lit(0))).first()
    )
    return rows <= max_rows and size <= max_bytes


def broadcast_if(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def spread_join(
    big: DataFrame, other: DataFrame, on: list[str], salt_of: Column, salts: int = 16
) -> DataFrame:
    """Inner join on ``on`` where one key of ``big`` may hold a large share of its rows.

    The rows of a key are dealt to ``salts`` groups by the hash of ``salt_of`` (a column that
    differs between them); the other side is repeated once per group. Every pair is still
    found exactly once.
    """
    salt = F.pmod(F.xxhash64(salt_of), F.lit(salts)).cast("int")
    left = big.withColumn("_salt", salt)
    right = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*on, "_salt"]).drop("_salt")


def heavy_keys(
    counts: DataFrame, on: list[str], rows: str = "n", parts: int = 1000, least: int = 1
) -> DataFrame:
    """Keys that hold over one ``parts``-th of all rows, and in ``_salts`` how many groups each is dealt to.

    ``counts`` has one row a key with its number of ``rows``; a key of up to ``least`` is never heavy. Fewer than
    ``parts`` keys can be heavy, and all their groups together are fewer than ``2 * parts``, whatever
    the size of the table.
    """
    total = counts.agg(F.sum(rows)).first()[0] or 0
    share = max(1, least, int(total) // parts)
    return counts.where(F.col(rows) > share).select(
        *on, F.ceil(F.col(rows) / F.lit(share)).cast("int").alias("_salts")
    )


def weighted_join(
    big: DataFrame, other: DataFrame, on: list[str], salt_of: Column, heavy: DataFrame,
    other_salt_of: Column | None = None, other_heavy: DataFrame | None = None,
) -> DataFrame:
    """Inner join on ``on`` where only the ``heavy_keys`` are dealt to several groups, each by its weight.

    The rows of ``other`` are repeated for the groups of their own key alone; every pair is found once. With
    ``other_heavy`` the heavy keys of ``other`` are dealt as well, and the rows of ``big`` repeated for these.
    """
    groups = ["_salt"] if other_heavy is None else ["_salt", "_other"]

    def dealt(df: DataFrame, salt: str, by: Column, known: DataFrame) -> DataFrame:
        salts = F.coalesce("_salts", F.lit(1))
        met = df.join(F.broadcast(known), on, "left")
        return met.withColumn(salt, F.pmod(F.xxhash64(by), salts).cast("int")).drop("_salts")

    def repeated(df: DataFrame, salt: str, known: DataFrame) -> DataFrame:
        met = df.join(F.broadcast(known), on, "left")
        return met.withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")

    left, right = dealt(big, "_salt", salt_of, heavy), repeated(other, "_salt", heavy)
    if other_heavy is not None:
        left, right = repeated(left, "_other", other_heavy), dealt(right, "_other", other_salt_of, other_heavy)
    return left.join(right, [*on, *groups]).drop(*groups)


#: Pairs that one task is to give, and the most tasks of a join by pairs.
PAIRS_A_TASK = 5_000_000
MOST_TASKS = 2_000


def paired_join(
    left: DataFrame, right: DataFrame, on: list[str], left_salt_of: Column, right_salt_of: Column,
    counts: DataFrame, parts: int = 1000, least: int = 100,
) -> DataFrame:
    """Inner join on ``on`` for results far larger than both sides: work is dealt by the pairs of a key, not its rows.

    ``counts`` has each key once with ``n_left`` and ``n_right``, its rows on both sides or a bound of them. Keys of more than
    one ``parts``-th of all pairs, fewer than ``parts``, become a grid of cells. Its sides are in proportion to the rows,
    so that as few as possible are repeated; every pair is found once, and only the two sides are shuffled.
    """
    pairs = F.col("n_left").cast("double") * F.col("n_right")
    counts = materialize(counts.select(*on, "n_left", "n_right", pairs.alias("_pairs")), "pair-counts")
    total = counts.agg(F.sum("_pairs")).first()[0] or 0.0
    share = max(float(least), total / parts)
    cells = F.ceil(F.col("_pairs") / F.lit(share)).cast("int")
    rows = F.round(F.sqrt(cells * F.col("n_left") / F.col("n_right"))).cast("int")
    heavy = counts.where(F.col("_pairs") > share).select(*on, cells.alias("_cells"), rows.alias("_lefts"))
    heavy = heavy.withColumn("_lefts", F.greatest(F.lit(1), F.least("_lefts", "_cells"))).select(
        *on, "_lefts", F.ceil(F.col("_cells") / F.col("_lefts")).cast("int").alias("_rights")
    )

    def dealt(df: DataFrame, own: str, other: str, by: Column) -> DataFrame:
        met = df.join(F.broadcast(heavy), on, "left")
        mine = F.pmod(F.xxhash64(by), F.coalesce(F.col(f"{own}s"), F.lit(1))).cast("int")
        groups = F.sequence(F.lit(0), F.coalesce(F.col(f"{other}s"), F.lit(1)) - 1)
        return met.withColumn(own, mine).withColumn(other, F.explode(groups)).drop("_lefts", "_rights")

    groups = ["_left", "_right"]
    by_left, by_right = dealt(left, "_left", "_right", left_salt_of), dealt(right, "_right", "_left", right_salt_of)
    tasks = min(MOST_TASKS, int(total / PAIRS_A_TASK))
    if tasks >= 10:
        # What is shuffled is small, and would be put together in a few tasks by its bytes.
        by_left, by_right = (df.repartition(tasks, *on, *groups) for df in (by_left, by_right))
        by_right = by_right.hint("merge")
    return by_left.join(by_right, [*on, *groups]).drop(*groups)


# --- Membership ---------------------------------------------------------------

BLOCK_BITS = 32 * 1024  # of one bitmap
BITS_A_KEY = 16
PROBES = 4


def might_hold(
    keys: DataFrame, on: list[str], max_bytes: int = MAX_BYTES
) -> Callable[[DataFrame], DataFrame]:
    """A filter that keeps every row with one of ``keys``, and of the others hardly any, without a shuffle.

    A Bloom filter as a table of bitmaps: a key sets ``PROBES`` bits of one of them. It is broadcast, and never
    larger than ``max_bytes``: with more keys than that has room for, more other rows pass.
    """
    keys = keys.select(*on).distinct()
    blocks = max(1, min(max_bytes * 8 // BLOCK_BITS, -(-keys.count() * BITS_A_KEY // BLOCK_BITS)))
    block = F.pmod(F.xxhash64(*on), F.lit(blocks))
    bits = F.xxhash64(*on, F.lit("bits"))
    places = [F.shiftright(bits, 15 * k).bitwiseAND(BLOCK_BITS - 1) for k in range(PROBES)]
    set_bits = keys.select(block.alias("_block"), F.explode(F.array(*places)).alias("place"))
    bitmaps = materialize(
        set_bits.groupBy("_block").agg(F.bitmap_construct_agg(F.col("place")).alias("_bitmap")), "bitmaps"
    )

    def is_set(place: Column) -> Column:
        octet = F.substring(F.col("_bitmap"), F.shiftright(place, 3).cast("int") + 1, F.lit(1))
        value = F.conv(F.hex(octet), 16, 10).cast("int")
        return F.pmod(F.floor(value / F.pow(F.lit(2.0), place.bitwiseAND(7))), F.lit(2)) == 1

    def rows_that_might(df: DataFrame) -> DataFrame:
        met = df.withColumn("_block", block).join(F.broadcast(bitmaps), "_block")
        for place in places:
            met = met.where(is_set(place))
        return met.select(*df.columns)

    return rows_that_might
