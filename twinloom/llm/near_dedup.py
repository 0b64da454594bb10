"""Near-duplicate documents: MinHash bands, sequential Bayesian pruning, exact confirmation.

A document is the set of its word shingles. Texts of the same words are one node of a graph. Nodes
that share a band of MinHash values are candidates; their signatures are compared batch by batch,
and a pair is dropped as soon as its chance of reaching the threshold falls below ``miss``. The
shingle sets of the survivors are compared in full, and only that makes a link.

No group is written out as pairs. Among the documents that share a band, shingles that only one
of them has are counted; with u of its n shingles its own, a document can meet another of n' in at
most min(n - u, n' - u') shingles. That bounds their similarity, and documents that can reach the threshold with
no member of a group leave it. Of the others each is paired with the group's member that has the
fewest shingles of its own (a star, as many pairs as members), which tends to be the one all were copied from. Of the
members that the stars leave in different components, and that the bound does not exclude, those outside a group's
largest component meet the others in blocks within tasks, which give back only links between components.

Defined results: no words (null, empty or blank text) means no shingles and no link. Rows with a
null ``doc_id`` are linked with nothing and have a null component. Rows that repeat a ``doc_id`` are one document. Other
columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from twinloom.llm.components import connected
from twinloom.llm.sketch import (
    MinHash, TextCodes, band_keys, digest_of, shingle_hashes, shingle_set,
)
from twinloom.session import materialize
from twinloom.sizing import broadcast_if, fits


@dataclass(frozen=True)
class NearConfig:
    """``percent``: a link needs 100 * intersection >= percent * union.

    A pair at the threshold s shares no band with probability (1 - s**rows) ** bands: 3e-6 here.
    ``miss`` is the chance, at each batch, below which a pair is given up.
    """

    width: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 5
    batch: int = 32
    miss: float = 1e-7
    #: Documents left over after the stars that may have a rare shingle; changes the work, not the links.
    rare: int = 64
    #: Members of a group that meet in one task.
    block: int = 256


def least_matches(compared: int, similarity: float, miss: float) -> int:
    """Fewest equal values among ``compared`` at which a pair is still pursued.

    With m equal values and a uniform prior, similarity follows Beta(m + 1, compared - m + 1); its
    mass above s equals P(Binomial(compared + 1, s) <= m).
    """
    below = 0.0
    for m in range(compared + 1):
        below += comb(compared + 1, m) * similarity**m * (1 - similarity) ** (compared + 1 - m)
        if below >= miss:
            return m
    return compared


def sketches(docs: DataFrame, config: NearConfig) -> DataFrame:
    """``doc_id, n_shingles, digest, keys, signature`` of every row; the last three null without words."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
        ("keys", pa.list_(pa.int64())), ("signature", pa.binary()),
    ])

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TextCodes()
        hasher = MinHash(config.bands * config.rows)
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column(1):
                words, plain = codes.words(text.as_py())
                shingles = shingle_hashes(words, config.width)
                sizes.append(len(shingles))
                digests.append(digest_of(plain) if plain else None)
                signatures.append(hasher.signature(shingles))
            if not sizes:
                continue
            table = np.array(signatures)
            keys = band_keys(table, config.bands, config.rows)
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * config.bands),
                pa.array(keys.ravel()), mask=pa.array([d is None for d in digests]),
            )
            # A byte of each value is enough to compare: chance agreement only keeps a pair longer.
            rows = [None if d is None else s.tobytes() for d, s in zip(digests, table.astype(np.uint8))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                lists, pa.array(rows, pa.binary()),
            ], schema=schema)

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(
        sketch, "doc_id long, n_shingles long, digest binary, keys array<long>, signature binary"
    )


def _occurrences(texts: DataFrame, config: NearConfig) -> DataFrame:
    """``doc_id, shingle`` (a hash): a row for each shingle of each text."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TextCodes()

        def rows(ids: list[np.ndarray], hashes: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids)), pa.array(np.concatenate(hashes))], names=["doc_id", "shingle"]
            )

        for batch in batches:
            ids, gathered, size = [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = shingle_hashes(codes.words(text.as_py())[0], config.width).view(np.int64)
                ids.append(np.full(len(hashes), doc_id, np.int64))
                gathered.append(hashes)
                size += len(hashes)
                if size >= 1 << 16:
                    yield rows(ids, gathered)
                    ids, gathered, size = [], [], 0
            if size:
                yield rows(ids, gathered)

    return texts.mapInArrow(spread, "doc_id long, shingle long")


def _own_shingles(texts: DataFrame, config: NearConfig) -> DataFrame:
    """``doc_id, own``: how many shingles no other of these documents has; no row means none."""
    owned = _occurrences(texts, config).groupBy("shingle").agg(
        F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last")
    )
    return owned.filter("doc_id = last").groupBy("doc_id").agg(F.count("*").alias("own"))


def _reachable(total: Column, shared: Column, config: NearConfig) -> Column:
    """Whether sets of ``total`` elements in all, ``shared`` of them common at most, can reach the threshold."""
    return (100 + config.percent) * shared >= config.percent * total


def _within_reach(placed: DataFrame, common: str, config: NearConfig) -> DataFrame:
    """Members that can reach the threshold with some other member's size by their ``common`` shingles."""
    least = placed.groupBy("key").agg(F.min("n").alias("least"))
    near = placed.join(least, "key").filter(_reachable(F.col("n") + F.col("least"), F.col(common), config))
    several = (
        near.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .filter("a < b").select("key")
    )
    return near.join(several, "key", "left_semi").drop("least")


def _stars(placed: DataFrame, config: NearConfig) -> DataFrame:
    """Pairs of the member with the smallest share of own shingles with each other member."""
    rank = F.struct(((F.col("n") - F.col("shared")) / F.col("n")).alias("own"), "doc_id", "n", "shared")
    leaders = placed.groupBy("key").agg(F.min(rank).alias("leader"))
    one = F.col("leader")
    return (
        placed.join(leaders, "key").filter(F.col("doc_id") != one["doc_id"])
        .filter(_reachable(F.col("n") + one["n"], F.least(F.col("shared"), one["shared"]), config))
        .select(F.least("doc_id", one["doc_id"]).alias("a"), F.greatest("doc_id", one["doc_id"]).alias("b"))
        .distinct()
    )


def _across(
    placed: DataFrame, labels: DataFrame, known: DataFrame, texts: DataFrame, config: NearConfig
) -> tuple[DataFrame, DataFrame]:
    """Pairs to look at, and links, of members of one group that are in different components.

    Shingles that ``rare`` or fewer of the documents left over have are rare. A pair at the threshold either
    has a rare shingle in common, and then one among the rarest few of both (no more than may be missing from a
    link), or only frequent ones, whose number bounds its similarity far more closely. The first are found
    by those shingles, at most ``rare`` documents each; the second meet in blocks of their groups.
    """
    named = (
        placed.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id"))
    )
    mixed = (
        named.groupBy("key")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high").select("key")
    )
    rest = _within_reach(materialize(named.join(mixed, "key", "left_semi"), "near-mixed"), "shared", config)
    rest = materialize(rest, "near-rest")
    left = rest.select("doc_id", "component", "n", "shared").distinct()
    held = materialize(_occurrences(texts.join(left, "doc_id", "left_semi"), config).distinct(), "near-held")
    seldom = held.groupBy("shingle").agg(F.count("*").alias("docs")).filter(F.col("docs") <= config.rare)
    seldom = materialize(held.join(seldom, "shingle"), "near-seldom")
    often = left.join(seldom.groupBy("doc_id").agg(F.count("*").alias("seldom")), "doc_id", "left").select(
        "doc_id", "component", "n", "shared", (F.col("n") - F.coalesce("seldom", F.lit(0))).alias("often")
    )
    often = materialize(often, "near-often")

    first = Window.partitionBy("doc_id").orderBy("docs", "shingle")
    missing = F.col("n") - F.ceil(F.col("n") * config.percent / 100) + 1
    rarest = (
        seldom.withColumn("at", F.row_number().over(first)).join(often, "doc_id")
        .filter((F.col("at") <= missing) & (F.col("docs") > 1))
    )
    near = materialize(_within_reach(rest.select("key", "doc_id").join(often, "doc_id"), "often", config), "near-blocks")
    return _paired(rarest, "shingle", "shared", config), _met_in_blocks(near, known, texts, config)


class Components:
    """Labels that were found to be one, within a task."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def find(self, label: int) -> int:
        while (up := self.parent.get(label, label)) != label:
            self.parent[label] = self.parent.get(up, up)
            label = up
        return label

    def join(self, one: int, two: int) -> None:
        self.parent[self.find(one)] = self.find(two)


def _met_in_blocks(near: DataFrame, known: DataFrame, texts: DataFrame, config: NearConfig) -> DataFrame:
    """Links (``a, b``) between members (``key, doc_id, component, n, often``) of one group in different components.

    Members outside the largest component of their group meet all others: both are dealt to blocks, and a task
    holds a block of each. A pair is looked at in the first band that it shares, its signatures batch by
    batch and then its full sets. A task gives back a link only where it joins components that no other
    link of it has joined yet, so fewer links than members.
    """
    parts = near.groupBy("key", "component").agg(F.count("*").alias("size"))
    groups = parts.groupBy("key").agg(
        F.max(F.struct("size", "component")).alias("top"), F.sum("size").alias("total")
    ).select(
        "key", F.col("top.component").alias("largest"),
        F.ceil(F.col("total") / config.block).alias("blocks"),
        F.ceil((F.col("total") - F.col("top.size")) / config.block).alias("minor_blocks"),
    )
    full = texts.join(known.select("doc_id", "keys", "signature"), "doc_id")
    rows = near.join(materialize(groups, "near-block-groups"), "key").join(full, "doc_id")
    dealt = F.xxhash64("doc_id")

    def others(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    columns = ["doc_id", "component", "n", "often", "keys", "signature", "text"]
    members = rows.filter("minor_blocks > 0").select(
        "key", F.pmod(dealt, F.col("blocks")).alias("block"), others("minor_blocks").alias("minor"),
        (F.col("component") != F.col("largest")).alias("outside"), *columns,
    )
    minors = rows.filter("component <> largest").select(
        F.col("key").alias("key"), others("blocks").alias("block"), F.pmod(dealt, F.col("minor_blocks")).alias("minor"),
        *[F.col(c).alias(c) for c in columns],  # attributes of their own, apart from the members'
    )
    values = config.bands * config.rows
    steps, least = _batches(config)

    def meet(one: pd.DataFrame, two: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        if len(one) and len(two):
            codes, same, group = TextCodes(), Components(), int(one["key"].iloc[0])
            keys = np.stack(one["keys"].to_numpy())
            signatures = np.frombuffer(b"".join(one["signature"]), np.uint8).reshape(len(one), values)
            ids, sizes, often, outside = (one[c].to_numpy() for c in ("doc_id", "n", "often", "outside"))
            hashes: dict[int, np.ndarray] = {}
            for own in two.itertuples():
                shared = keys == np.asarray(own.keys)
                first = shared.argmax(axis=1)
                good = (keys[np.arange(len(keys)), first] == group) & shared.any(axis=1)
                # Two members outside the largest component would meet twice.
                good &= (ids != own.doc_id) & (~outside | (ids > own.doc_id))
                good &= (100 + config.percent) * np.minimum(often, own.often) >= config.percent * (sizes + own.n)
                at = np.flatnonzero(good)
                at = at[_pursued(signatures[at], np.frombuffer(own.signature, np.uint8), steps, least)]
                at = np.array([k for k in at if same.find(one["component"].iloc[k]) != same.find(own.component)], int)
                if not len(at):
                    continue
                for k in at:
                    if k not in hashes:
                        hashes[k] = shingle_hashes(codes.words(one["text"].iloc[k])[0], config.width)
                mine = shingle_hashes(codes.words(own.text)[0], config.width)
                every = np.concatenate([hashes[k] for k in at])
                starts = np.cumsum([0, *[len(hashes[k]) for k in at[:-1]]])
                place = np.minimum(np.searchsorted(mine, every), len(mine) - 1)
                both = np.add.reduceat((mine[place] == every).astype(np.int64), starts)
                whole = None
                for k, common in zip(at, both):
                    if 100 * common < config.percent * (len(mine) + len(hashes[k]) - common):
                        continue
                    if same.find(one["component"].iloc[k]) == same.find(own.component):
                        continue
                    whole = whole or shingle_set(codes.words(own.text)[1], config.width)
                    other = shingle_set(codes.words(one["text"].iloc[k])[1], config.width)
                    common = len(whole & other)
                    if 100 * common >= config.percent * (len(whole) + len(other) - common):
                        same.join(one["component"].iloc[k], own.component)
                        found.append((min(own.doc_id, ids[k]), max(own.doc_id, ids[k])))
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    place = ["key", "block", "minor"]
    return members.groupBy(*place).cogroup(minors.groupBy(*place)).applyInPandas(meet, "a long, b long")


def _paired(members: DataFrame, key: str, common: str, config: NearConfig) -> DataFrame:
    """Pairs with the same ``key`` in different components whose ``common`` shingles may do."""
    columns = ["doc_id", "component", "n", common]
    one = members.select(key, *[F.col(c).alias(f"{c}_a") for c in columns])
    two = members.select(F.col(key).alias("other"), *[F.col(c).alias(f"{c}_b") for c in columns])
    reach = _reachable(F.col("n_a") + F.col("n_b"), F.least(f"{common}_a", f"{common}_b"), config)
    apart = (F.col(key) == F.col("other")) & (F.col("doc_id_a") < F.col("doc_id_b"))
    pairs = one.join(two, apart & (F.col("component_a") != F.col("component_b")) & reach)
    return pairs.select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct()


def _batches(config: NearConfig) -> tuple[list[int], list[int]]:
    """After how many values signatures are looked at, and the fewest equal ones at which a pair goes on."""
    values = config.bands * config.rows
    steps = list(range(config.batch, values + 1, config.batch)) or [values]
    return steps, [least_matches(n, config.percent / 100, config.miss) for n in steps]


def _pursued(one: np.ndarray, two: np.ndarray, steps: list[int], least: list[int]) -> np.ndarray:
    """Which rows of signatures no batch of values rules out; ``two`` has a row for each, or one for all."""
    alive = np.arange(len(one))
    matches = np.zeros(len(one), np.int64)
    start = 0
    for end, needed in zip(steps, least):
        other = two[alive, start:end] if two.ndim == 2 else two[start:end]
        matches[alive] += (one[alive, start:end] == other).sum(axis=1)
        alive = alive[matches[alive] >= needed]
        start = end
    return alive


def _likely(pairs: DataFrame, signatures: DataFrame, config: NearConfig) -> DataFrame:
    """Pairs that no batch of signature values rules out."""
    values = config.bands * config.rows
    steps, least = _batches(config)

    def pursue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8)
                .reshape(batch.num_rows, values) for k in (2, 3)
            )
            alive = pa.array(_pursued(one, two, steps, least))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(alive), batch.column(1).take(alive)], names=["a", "b"]
            )

    one = signatures.select(F.col("doc_id").alias("a"), F.col("signature").alias("one"))
    two = signatures.select(F.col("doc_id").alias("b"), F.col("signature").alias("two"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return joined.mapInArrow(pursue, "a long, b long")


def _confirmed(pairs: DataFrame, texts: DataFrame, config: NearConfig) -> DataFrame:
    """Pairs whose full shingle sets reach the threshold."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = TextCodes()
        last: tuple[str | None, set] = (None, set())
        for batch in batches:
            linked = []
            for one, two in zip(batch.column(2), batch.column(3)):
                one, two = one.as_py(), two.as_py()
                if last[0] != one:
                    last = one, shingle_set(codes.words(one)[1], config.width)
                other = shingle_set(codes.words(two)[1], config.width)
                both = len(last[1] & other)
                linked.append(100 * both >= config.percent * (len(last[1]) + len(other) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(k).filter(pa.array(linked, pa.bool_())) for k in (0, 1)],
                names=["a", "b"],
            )

    one = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("one"))
    two = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("two"))
    joined = pairs.join(one, "a").join(two, "b").select("a", "b", "one", "two")
    return joined.mapInArrow(confirm, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, config: NearConfig = NearConfig()) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs`` (``doc_id, text``).

    ``component_id`` is the smallest ``doc_id`` that links lead to; that document is kept.
    """
    sketched = materialize(sketches(docs, config), "near-sketches")
    named = sketched.filter("doc_id is not null and digest is not null")
    groups = materialize(named.groupBy("digest").agg(F.min("doc_id").alias("node")), "near-groups")
    nodes = groups.select(F.col("node").alias("doc_id"), "digest")
    buckets = (
        named.select("doc_id", "digest", "keys").join(nodes, ["doc_id", "digest"], "left_semi")
        .select("doc_id", F.explode("keys").alias("key"))
    )
    several = (
        buckets.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"))
        .filter("a < b").select("key")
    )
    shared = materialize(buckets.join(several, "key", "left_semi").distinct(), "near-buckets")
    # From here on only documents that share a band matter.
    ids = materialize(shared.select("doc_id").distinct(), "near-ids")
    ids = broadcast_if(ids, fits(ids))
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = materialize(texts.join(ids, "doc_id", "left_semi").distinct(), "near-texts")
    known = named.join(ids, "doc_id", "left_semi").select("doc_id", "n_shingles", "keys", "signature").dropDuplicates(["doc_id"])
    known = known.join(_own_shingles(texts, config), "doc_id", "left").withColumn(
        "shared", F.col("n_shingles") - F.coalesce("own", F.lit(0))
    )
    known = materialize(known.withColumnRenamed("n_shingles", "n").drop("own"), "near-known")
    placed = shared.join(known.select("doc_id", "n", "shared"), "doc_id")
    placed = materialize(_within_reach(placed, "shared", config), "near-placed")

    def links(pairs: DataFrame, name: str) -> DataFrame:
        likely = materialize(_likely(pairs, known, config), f"{name}-likely")
        return materialize(_confirmed(likely, texts, config), f"{name}-links")

    stars = links(_stars(placed, config), "near-star")
    labels = connected(stars)
    pairs, met = _across(placed, labels, known, texts, config)
    rest = links(pairs, "near-across").union(materialize(met, "near-met"))
    if not rest.isEmpty():
        labels = connected(stars.union(rest))
    reached = groups.join(labels.withColumnRenamed("id", "node"), "node", "left").select(
        "digest", F.coalesce("component", "node").alias("reached")
    )
    found = sketched.select("doc_id", "n_shingles", "digest").join(reached, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("reached", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )
