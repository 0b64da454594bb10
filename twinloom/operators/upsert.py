"""Upsert: build twins from documents and merge them into the stored table."""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from twinloom import sizing, vocab
from twinloom.functions.identity import twin_identity
from twinloom.functions.properties import (
    find_property, property_errors, typed_union, value_metadata,
)
from twinloom.session import materialize


def upsert_port(port: Column, stored: bool) -> Column:
    """A port as it is sent for an upsert: typed properties and value metadata."""
    fields = [port["id"].alias("id")]
    if stored:
        fields.append(F.coalesce(port["storeLast"], F.lit(False)).alias("storeLast"))
    return F.struct(
        *fields,
        F.transform(port["properties"], typed_union).alias("properties"),
        value_metadata(port["values"]).alias("values"),
    )


def upsert_ports(twin: Column) -> Column:
    """``struct(feeds, inputs)`` of a twin for an upsert; inputs have no ``storeLast``."""
    return F.struct(
        F.transform(twin["feeds"], lambda p: upsert_port(p, True)).alias("feeds"),
        F.transform(twin["inputs"], lambda p: upsert_port(p, False)).alias("inputs"),
    )


def build_twins(
    parsed: DataFrame, seed: str, host_id: str, id_property: str = vocab.IDENTIFIER
) -> DataFrame:
    """Parsed twins (``twin``, ``error``) to rows of a twin table, or an error each.

    The twin's id comes from the value of its id property. A property that cannot be typed, in
    the twin or in one of its ports, puts the twin in error with the first reason.
    """
    twin = F.col("twin")
    found = find_property(twin["properties"], id_property)
    in_ports = F.flatten(F.transform(
        F.concat(twin["feeds"], twin["inputs"]), lambda p: property_errors(p["properties"])
    ))
    first_reason = F.get(F.concat(property_errors(twin["properties"]), in_ports), F.lit(0))
    error = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(found.isNull(), F.lit(vocab.TWIN_NO_ID_PROPERTY + id_property))
        .otherwise(first_reason)
    )
    others = [c for c in parsed.columns if c not in ("twin", "error")]
    identified = parsed.withColumn("error", error)
    return identified.select(
        *others, F.lit(host_id).alias("host_id"),
        F.when(F.col("error").isNull(), twin_identity(found["value"], seed)).alias("twin_id"),
        twin["properties"].alias("properties"), twin["feeds"].alias("feeds"),
        twin["inputs"].alias("inputs"), "error",
    )


def newest(records: DataFrame, key: str = "twin_id", order: str = "batch") -> DataFrame:
    """The latest record of each key; it replaces the earlier ones as a whole.

    Between records of the same order their content decides, so that the choice does not hang on
    how rows are dealt out.
    """
    rest = [c for c in records.columns if c != key]
    latest = F.struct(F.col(order).alias("order"), F.xxhash64(*rest).alias("content"))
    picked = records.groupBy(key).agg(F.max_by(F.struct(*rest), latest).alias("r"))
    return picked.select(key, "r.*").select(*records.columns)


def merge(stored: DataFrame, updates: DataFrame, key: str = "twin_id", order: str = "batch") -> DataFrame:
    """Stored rows, and in place of those with updates the newest of both by ``order``.

    An update that comes late does not replace a newer stored row. Stored rows are not aggregated but
    for those that have an update; the updated keys are broadcast if measured to be few.
    """
    keys = materialize(updates.select(key).distinct(), "updated-keys")
    keys = sizing.broadcast_if(keys, sizing.fits(keys))
    rivals = stored.join(keys, key, "left_semi").unionByName(updates)
    return stored.join(keys, key, "left_anti").unionByName(newest(rivals, key, order))


# --- A table of versions: written in runs, merged by size, newest on read --------


BUCKET = "twin_bucket"
#: Runs of about one size that are merged to one.
FAN_IN = 4
#: Versions that a task sorts, whole twins that they are.
ROWS_A_TASK = 10_000


@dataclass(frozen=True)
class Run:
    """A folder of versions that is part of the table, and the updates it holds."""

    name: str
    rows: int
    numbers: tuple[int, ...]

    @property
    def tier(self) -> int:
        return int(math.log(max(1, self.rows), FAN_IN))


def _files(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(place)] if system.exists(place) else []


def _states(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete lists of runs, in order; the last one is the table."""
    listed = [int(n.removeprefix("state=")) for n in _files(spark, f"{path}/live") if n.startswith("state=")]
    return sorted(n for n in listed if "_SUCCESS" in _files(spark, f"{path}/live/state={n}"))


def live_runs(spark: SparkSession, path: str) -> list[Run]:
    """The runs that make up the table; there are few, as runs are merged by size."""
    states = _states(spark, path)
    if not states:
        return []
    rows = spark.read.parquet(f"{path}/live/state={states[-1]}").collect()
    return [Run(r["name"], r["rows"], tuple(r["numbers"])) for r in rows]


def _set_live(spark: SparkSession, path: str, runs: list[Run]) -> None:
    """Makes these runs the table, at once for all readers that come after."""
    state = (_states(spark, path) or [0])[-1] + 1
    rows = [(r.name, r.rows, list(r.numbers)) for r in runs]
    frame = spark.createDataFrame(rows, "name string, rows long, numbers array<long>")
    frame.coalesce(1).write.mode("overwrite").parquet(f"{path}/live/state={state}")


def _tasks(rows: int) -> int:
    return max(1, -(-rows // ROWS_A_TASK))


def _write_run(
    versions: DataFrame, path: str, name: str, numbers: tuple[int, ...], buckets: int, order: str,
    most: int | None = None,
) -> Run:
    """Rows in order within each bucket, so that files know the range of their ``order``; no two are alike.

    Tasks are by rows (``most`` of them, if known), as a twin takes many times the memory of what is shuffled of it.
    """
    rows = versions.withColumn(BUCKET, F.pmod(F.xxhash64("twin_id"), F.lit(buckets)).cast("int"))
    folder = f"{path}/runs/run={name}"
    tasks = _tasks(versions.count() if most is None else most)
    part = F.pmod(F.xxhash64("twin_id", "rank", F.lit("part")), F.lit(-(-tasks // buckets)))
    spread = rows.repartition(tasks, BUCKET, part).sortWithinPartitions(BUCKET, order)
    spread.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
    return Run(name, rows.sparkSession.read.schema(rows.schema).parquet(folder).count(), numbers)


def ranked(updates: DataFrame, key: str = "twin_id", order: str = "batch") -> DataFrame:
    """Adds ``rank``: the order, and between equals the content, as one decimal of fixed width."""
    rest = [c for c in updates.columns if c != key]
    rank = F.col(order).cast("decimal(19,0)") * F.lit(Decimal(1 << 64)) + F.xxhash64(*rest).cast("decimal(19,0)")
    return updates.withColumn("rank", F.coalesce(rank.cast("decimal(38,0)"), F.lit(Decimal(-(10 ** 37)))))


def append_versions(
    updates: DataFrame, path: str, buckets: int = 64, number: int | None = None, order: str = "batch"
) -> None:
    """Adds versions of twins to the table at ``path`` as a run of their own, and merges runs of a size.

    ``number`` names the update: added once more, as after a failure, it changes nothing.
    """
    spark = updates.sparkSession
    runs = live_runs(spark, path)
    known = {n for r in runs for n in r.numbers}
    if number in known:
        return
    number = max(known, default=-1) + 1 if number is None else number
    most = updates.count()
    dealt = ranked(updates, order=order).repartition(_tasks(most), "twin_id", "rank")
    alike = dealt.dropDuplicates(["twin_id", "rank"])
    runs.append(_write_run(alike, path, f"u{number}", (number,), buckets, order, most))
    _set_live(spark, path, runs)
    merge_runs(spark, path, buckets, order)


def merge_runs(spark: SparkSession, path: str, buckets: int = 64, order: str = "batch") -> None:
    """Merges runs until no more than ``FAN_IN`` - 1 are of one size tier; older versions of a twin go.

    Runs that were merged stay as files for readers that still use them, until ``remove_old``.
    """
    while True:
        runs = live_runs(spark, path)
        tiers: dict[int, list[Run]] = {}
        for run in runs:
            tiers.setdefault(run.tier, []).append(run)
        full = next((tiers[t] for t in sorted(tiers) if len(tiers[t]) >= FAN_IN), None)
        if full is None:
            return
        numbers = tuple(sorted(n for r in full for n in r.numbers))
        name = f"m{(_states(spark, path) or [0])[-1] + 1}"
        most = sum(r.rows for r in full)
        merged = _write_run(_newest_of(spark, path, full, None, order), path, name, numbers, buckets, order, most)
        _set_live(spark, path, [r for r in runs if r not in full] + [merged])


def remove_old(spark: SparkSession, path: str) -> None:
    """Deletes runs and lists that are no longer part of the table; no reader of an older one may be at work."""
    states, live = _states(spark, path), {f"run={r.name}" for r in live_runs(spark, path)}
    gone = [f"{path}/runs/{n}" for n in _files(spark, f"{path}/runs") if n not in live]
    gone += [f"{path}/live/state={n}" for n in states[:-1]]
    for folder in gone:
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions that the table still holds."""
    return _read_runs(spark, path, live_runs(spark, path)).drop("rank", "run", BUCKET)


def _read_runs(spark: SparkSession, path: str, runs: list[Run]) -> DataFrame:
    folders = [f"{path}/runs/run={r.name}" for r in runs if r.rows]
    if not folders:
        raise ValueError(f"no versions at {path}")
    return spark.read.option("basePath", f"{path}/runs").parquet(*folders)


def _newest_of(spark: SparkSession, path: str, runs: list[Run], until: int | None, order: str) -> DataFrame:
    """The newest version of each twin, with its rank.

    Only keys, ranks and names of runs are aggregated, by hash; then rows meet the one chosen for their key. Equal
    versions of several runs count as that of the run with the greatest name.
    """
    rows = _read_runs(spark, path, runs)
    if until is not None:
        rows = rows.where(F.col(order) <= until)  # pruned by the range that files and row groups know
    names = F.create_map(*[x for k, r in enumerate(sorted(runs, key=lambda r: r.name)) for x in (F.lit(r.name), F.lit(k))])
    slim = rows.select("twin_id", "rank", names[F.col("run")].alias("_place"))
    places = slim.groupBy("twin_id", "rank").agg(F.max("_place").alias("_place"))
    best = slim.groupBy("twin_id").agg(F.max("rank").alias("rank"))
    chosen = places.join(best.hint("shuffle_hash"), ["twin_id", "rank"])
    numbered = rows.withColumn("_place", names[F.col("run")])
    return numbered.join(chosen.hint("shuffle_hash"), ["twin_id", "rank", "_place"], "left_semi").drop("_place", "run", BUCKET)


def read_newest(spark: SparkSession, path: str, order: str = "batch", until: int | None = None) -> DataFrame:
    """The newest version of each twin of the table at ``path``; with ``until``, as far as the table still knows, at that order."""
    return _newest_of(spark, path, live_runs(spark, path), until, order).drop("rank")


def compact(spark: SparkSession, path: str, to: str, order: str = "batch", buckets: int = 64) -> None:
    """Writes the newest versions as a new table at ``to``; when readers use it, ``path`` may go."""
    append_versions(read_newest(spark, path, order), to, buckets, order=order)


def distinct_ports(twins: DataFrame, ports: str = "feeds") -> DataFrame:
    """Ports that differ in content, each once, over all twins."""
    return twins.select(F.explode(ports).alias("port")).dropDuplicates(["port"])
