"""Search: many requests against all twins in one job.

A request asks for a text, a circle, properties and a scope; a twin is found if all hold. Testing
every request on every twin would be a cross join, so each request is looked up by one *anchor*
that its results must have: a property, a three-character piece of the text, the grid cells of
the circle, or, if it asks for none of these, the scope alone. Twins carry the same anchors, so
candidates come from an equi-join, and each candidate is then tested on the whole request. As a
request has one anchor, a twin is a candidate once at most and nothing needs removing later.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from twinloom import model, sizing, vocab
from twinloom.functions import checks, geo, uris
from twinloom.functions.lets import let
from twinloom.functions.properties import or_empty, spec_error, spec_property
from twinloom.session import materialize

PIECE = 3  # characters of a text anchor
LONG_PIECE = 8  # of one of a longer text: the runs of three characters of many names are few
MAX_LISTED = 2_000  # anchors that may be written into a plan
FEW_REQUESTS = 64  # of these, each twin has few enough anchors to need no counts


# --- Requests ---------------------------------------------------------------


def parse_requests(
    docs: DataFrame, defaults: dict, local_host: str, content: str = "content"
) -> DataFrame:
    """Requests as JSON text to checked requests.

    A field of the request wins over the default, the properties as a whole; adds the columns of
    a normal request and ``error``. A request in error finds nothing.
    """
    given = F.from_json(F.lit(json.dumps(defaults)), model.SEARCH_REQUEST)
    made = docs.withColumn("_r", _request_of(F.col(content), given, local_host))
    return made.select(*docs.columns, "_r.*")


def _request_of(content: Column, defaults: Column, local_host: str) -> Column:
    """All columns of a checked request in a struct."""
    fields = model.SEARCH_REQUEST.removesuffix(">") + ",_bad:string>"
    request = F.from_json(content, fields, {"columnNameOfCorruptRecord": "_bad"})
    names = ("text", "location", "properties", "scope", "responseType", "expiryTimeout")

    def with_settings(r: Column) -> Column:
        readable = F.coalesce(r.isNotNull() & r["_bad"].isNull(), F.lit(False))
        settings = F.struct(*[F.coalesce(r[n], defaults[n]).alias(n) for n in names])
        return let(settings, lambda s: F.struct(*normal(s), error(s, readable).alias("error")))

    def normal(s: Column) -> list[Column]:
        wanted = F.filter(F.transform(s["properties"], spec_property), lambda p: p.isNotNull())
        return [
            s["text"].alias("text"),
            s["location"]["lat"].try_cast("double").alias("lat0"),
            s["location"]["lon"].try_cast("double").alias("lon0"),
            checks.whole_number(s["location"]["r"]).alias("radius_km"),
            or_empty(F.array_distinct(wanted), model.PROPERTY).alias("wanted"),
            s["scope"].alias("scope"), F.lit(local_host).alias("local_host"),
            s["responseType"].alias("response_type"),
            checks.whole_number(s["expiryTimeout"]).alias("expiry_seconds"),
        ]

    def error(s: Column, readable: Column) -> Column:
        specs = F.filter(F.transform(s["properties"], spec_error), lambda e: e.isNotNull())
        reasons = F.concat_ws(
            ", ",
            F.when(~readable, F.lit("malformed request")),
            checks.setting_error(s["scope"], s["responseType"], s["expiryTimeout"], F.lit(None)),
            checks.location_error(s["location"]),
            F.when(F.size(specs) > 0, F.array_join(specs, ", ")),
        )
        return F.nullif(reasons, F.lit(""))

    return let(request, with_settings)


# --- Predicates -------------------------------------------------------------


def text_matches(properties: Column, text: Column) -> Column:
    """A label or comment holds the text, in any case; no text matches every twin."""
    needle = F.lower(text)
    found = F.exists(
        properties,
        lambda p: p["key"].isin(vocab.RDFS_LABEL, vocab.RDFS_COMMENT)
        & F.lower(p["value"]).contains(needle),
    )
    return text.isNull() | (text == "") | found


def _same_property(prop: Column, wanted: Column) -> Column:
    kind = wanted["type"]
    return (
        (prop["key"] == wanted["key"]) & (prop["type"] == kind) & (prop["value"] == wanted["value"])
        & ((kind != "LangLiteral") | (prop["lang"] == wanted["lang"]))
        & (
            (kind != "Literal")
            | (uris.short_data_type(prop["dataType"]) == uris.short_data_type(wanted["dataType"]))
        )
    )


def has_properties(properties: Column, wanted: Column) -> Column:
    """Every wanted property is among the twin's."""
    return F.forall(wanted, lambda w: F.exists(properties, lambda p: _same_property(p, w)))


def in_scope(host_id: Column, scope: Column, local_host: Column) -> Column:
    """``GLOBAL`` takes every host, ``LOCAL`` only the given one."""
    return (scope == "GLOBAL") | (host_id == local_host)


def in_location(lat: Column, lon: Column, lat0: Column, lon0: Column, radius_km: Column) -> Column:
    """Inside the circle of the request; no circle takes every twin, placed or not."""
    return radius_km.isNull() | F.coalesce(
        geo.in_circle(lat, lon, lat0, lon0, radius_km), F.lit(False)
    )


def satisfies() -> Column:
    """All conditions of a request, on a row that holds a twin and a request."""
    c = F.col
    return (
        in_scope(c("host_id"), c("scope"), c("local_host"))
        & in_location(c("lat"), c("lon"), c("lat0"), c("lon0"), c("radius_km"))
        & has_properties(c("properties"), c("wanted"))
        & text_matches(c("properties"), c("text"))
    )


# --- Anchors ----------------------------------------------------------------


def _property_anchor(prop: Column) -> Column:
    kind = prop["type"]
    detail = F.when(kind == "LangLiteral", prop["lang"]).when(
        kind == "Literal", uris.short_data_type(prop["dataType"])
    )
    return F.concat_ws(
        "\u0001", F.lit("property"), prop["key"], kind, F.coalesce(detail, F.lit("")), prop["value"]
    )


def _pieces(text: Column, size: int = PIECE) -> Column:
    """Every run of ``size`` characters in the text, in any case."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(rf"(?s)(?=(.{{{size}}}))"), 1)
    return F.transform(runs, lambda run: F.concat(F.lit("text:"), run))


def _piece_size(text: Column) -> Column:
    """How many characters the anchors of a request's text have."""
    size = F.length(F.lower(text))
    return F.when(size >= LONG_PIECE, LONG_PIECE).otherwise(F.least(size, F.lit(PIECE)))


def _asked_pieces(text: Column) -> Column:
    """The pieces of a request's text; a text shorter than a piece is one itself."""
    size = F.length(F.lower(text))
    return (
        F.when(size >= LONG_PIECE, _pieces(text, LONG_PIECE)).when(size >= PIECE, _pieces(text))
        .when(size > 0, F.array(F.concat(F.lit("text:"), F.lower(text))))
    )


def _scope_anchor(host: Column) -> Column:
    return F.concat(F.lit("host:"), host)


_EVERY_HOST = "host:*"


def request_anchors(requests: DataFrame) -> DataFrame:
    """Usable requests with ``options``: the anchors it may be looked up by, best first.

    ``_request`` tells requests apart, as their ids need not.

    An option is ``struct(rank, level, anchors)``; a twin that is found has exactly one of its
    ``anchors``. Ranks are a guess used where no counts are at hand: a property other than the
    type, then a circle, a text, a type, and the scope alone.
    """
    circle = geo.circle_box(F.col("lat0"), F.col("lon0"), F.col("radius_km"))
    # Kept in columns of their own: used several times, they must be computed once.
    leveled = (
        requests.where(F.col("error").isNull())
        .withColumn("_request", F.monotonically_increasing_id())  # fixed by being stored below
        .withColumn("_box", circle)
        .withColumn("geo_level", geo.box_level(F.col("_box")))
        .withColumn("_cells", geo.box_cells(F.col("_box"), F.col("geo_level")))
        .withColumn("_pieces", F.array_distinct(_asked_pieces(F.col("text"))))
    )

    def option(rank: Column | int, anchors: Column) -> Column:
        rank = F.lit(rank) if isinstance(rank, int) else rank
        return F.struct(rank.alias("rank"), anchors.alias("anchors"))

    by_property = F.transform(
        "wanted",
        lambda w: option(F.when(w["key"] == vocab.RDF_TYPE, 4).otherwise(1), F.array(_property_anchor(w))),
    )
    no_option = F.array().cast("array<struct<rank:int,anchors:array<string>>>")
    by_circle = F.when(F.col("_box").isNotNull(), F.array(option(2, F.col("_cells"))))
    by_text = F.transform("_pieces", lambda piece: option(3, F.array(piece)))
    by_scope = option(
        5,
        F.array(F.when(F.col("scope") == "LOCAL", _scope_anchor(F.col("local_host"))).otherwise(
            F.lit(_EVERY_HOST)
        )),
    )
    better = F.concat(*[F.coalesce(by, no_option) for by in (by_property, by_circle, by_text)])
    leveled = leveled.withColumn("options", F.sort_array(better)).drop("_box", "_cells", "_pieces")
    optioned = leveled.withColumn(
        "options", F.when(F.size("options") > 0, F.col("options")).otherwise(F.array(by_scope))
    )
    # Stored, as it is read again for counts, for the choice and for the lookup: each use, and each
    # filter pushed into it, would otherwise repeat the parsing and all steps above.
    return materialize(optioned, "requests")


@dataclass(frozen=True)
class Needs:
    """What a set of requests needs, and whether it may be broadcast: a few numbers, measured."""

    levels: tuple[int, ...]
    text_sizes: tuple[int, ...]
    has_scope: bool
    has_choice: bool
    small: bool
    requests: int = 0


def measure(optioned: DataFrame, max_rows: int, max_bytes: int) -> Needs:
    """One pass over the requests (with options) for their ``Needs``.

    A request is looked up by up to ``MAX_CELLS`` rows, so rows and bytes are counted that often.
    """
    repeats = F.array_max(F.transform("options", lambda o: F.size(o["anchors"])))
    row_bytes = F.octet_length(F.to_json(F.struct("*")))
    seen = optioned.agg(
        F.collect_set("geo_level").alias("levels"),
        F.collect_set(F.when(F.exists("options", lambda o: o["rank"] == 3), _piece_size(F.col("text")))).alias("sizes"),
        F.max(F.exists("options", lambda o: o["rank"] == 5)).alias("has_scope"),
        F.max(F.size("options") > 1).alias("has_choice"),
        F.count("*").alias("requests"),
        F.coalesce(F.sum(repeats), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(repeats * row_bytes), F.lit(0)).alias("bytes"),
    ).first()
    return Needs(
        levels=tuple(sorted(seen["levels"])),
        text_sizes=tuple(sorted(seen["sizes"])),
        has_scope=bool(seen["has_scope"]),
        has_choice=bool(seen["has_choice"]),
        small=seen["rows"] <= max_rows and seen["bytes"] <= max_bytes,
        requests=seen["requests"],
    )


def twin_anchors(needs: Needs) -> Column:
    """All anchors a twin can be looked up by, each once; none of a kind that no request uses."""
    kinds = [F.transform("properties", _property_anchor)]
    if needs.levels:
        cells = F.array(*[geo.cell(F.col("lat"), F.col("lon"), F.lit(n)) for n in needs.levels])
        kinds.append(F.filter(cells, lambda c: c.isNotNull()))
    if needs.text_sizes:
        texts = F.filter(
            F.col("properties"),
            lambda p: p["key"].isin(vocab.RDFS_LABEL, vocab.RDFS_COMMENT) & p["value"].isNotNull(),
        )
        kinds.append(F.flatten(F.transform(texts, lambda p: F.concat(
            *[_pieces(p["value"], size) for size in needs.text_sizes]
        ))))
    if needs.has_scope:
        kinds.append(F.array(F.lit(_EVERY_HOST), _scope_anchor(F.col("host_id"))))
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(*[F.coalesce(kind, none) for kind in kinds]))


def anchored(twins: DataFrame, needs: Needs, wanted: list[str] | None = None) -> DataFrame:
    """Twins once per anchor; only those in ``wanted`` if it is given.

    A short list keeps a twin without a wanted anchor from being repeated at all.
    """
    anchors = twin_anchors(needs)
    if wanted is not None:
        anchors = F.filter(anchors, lambda a: a.isin(*wanted))
    return twins.withColumn("anchor", F.explode(anchors))


def listed(anchors: DataFrame, small: bool) -> list[str] | None:
    """The distinct anchors, if they are few enough to be written into a plan."""
    if not small:
        return None
    rows = anchors.select("anchor").distinct().limit(MAX_LISTED + 1).collect()
    return [row["anchor"] for row in rows] if len(rows) <= MAX_LISTED else None


def anchor_counts(twins: DataFrame, optioned: DataFrame, needs: Needs) -> DataFrame:
    """How many twins have each anchor that is an option of some request."""
    options = optioned.where(F.size("options") > 1).select(F.explode("options.anchors").alias("a"))
    asked = options.select(F.explode("a").alias("anchor")).distinct()
    slim = twins.select("host_id", "lat", "lon", "properties")
    found = anchored(slim, needs, listed(asked, needs.small)).select("anchor")
    if needs.small:
        return found.join(F.broadcast(asked), "anchor").groupBy("anchor").count()
    # Counted before they are shuffled: most anchors of a twin are those of many.
    return found.groupBy("anchor").count().join(asked, "anchor", "left_semi")


def choose_anchors(requests: DataFrame, counts: DataFrame | None, small: bool = False) -> DataFrame:
    """One row per anchor of the option each request is looked up by.

    With counts, the option that fewest twins have; the order by rank decides between equals.
    """
    best_guess = F.element_at("options", 1)["anchors"]
    if counts is None:
        chosen = requests.withColumn("chosen", best_guess)
    else:
        several = requests.where(F.size("options") > 1)
        listed = several.select("_request", F.posexplode("options").alias("choice", "o")).select(
            "_request", "choice", F.col("o.anchors").alias("anchors"), F.explode("o.anchors").alias("anchor")
        )
        weighed = (
            listed.join(sizing.broadcast_if(counts, small), "anchor", "left")
            .groupBy("_request", "choice")
            .agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.first("anchors").alias("anchors"))
            .groupBy("_request")
            .agg(F.min_by("anchors", F.struct("n", "choice")).alias("rarest"))
        )
        weighed = sizing.broadcast_if(weighed, small)
        chosen = requests.join(weighed, "_request", "left").withColumn(
            "chosen", F.coalesce("rarest", best_guess)
        )
    return chosen.withColumn("anchor", F.explode("chosen")).drop("chosen", "rarest", "options", "geo_level")


# --- The search itself ------------------------------------------------------


def twin_key() -> Column:
    """A number for what a search looks at in a twin, null ids included.

    Twins of one number are candidates together and each tested for itself, so that no twin is lost or
    found wrongly, whether they are equal or meet by chance.
    """
    return F.xxhash64("host_id", "twin_id", "lat", "lon", "properties")


#: What ``satisfies`` and the anchors look at in a request.
CONDITIONS = ("text", "lat0", "lon0", "radius_km", "wanted", "scope", "local_host")


def request_classes(optioned: DataFrame) -> DataFrame:
    """Requests with options, each of those that ask for the same once, as ``_class`` tells: what it finds, all of them find."""
    return materialize(
        optioned.withColumn("_class", request_class())
        .dropDuplicates(["_class"]).select("_request", "_class", *CONDITIONS, "geo_level", "options"),
        "classes",
    )


def request_class() -> Column:
    """A digest of all conditions of a request."""
    return F.sha2(F.to_json(F.struct(*CONDITIONS)), 256)


def to_members(
    found: DataFrame, optioned: DataFrame, columns: list[str], small: bool, classes: DataFrame, pairs: DataFrame, salt_of: Column
) -> DataFrame:
    """What each class has found, for every request of the class, with its ``columns``.

    ``pairs`` (``_request`` and others, stored) bounds how much a class finds. Few requests are broadcast. Otherwise both sides are
    dealt by what they give together, so that of a result as large as requests times twins nothing is shuffled or stored.
    """
    members = optioned.withColumn("_class", request_class()).select("_class", "_request", *columns)
    if small:
        return found.join(F.broadcast(members.drop("_request")), "_class")
    finds = pairs.groupBy("_request").agg(F.count("*").alias("n_left"))
    finds = finds.join(classes.select("_request", "_class"), "_request").select("_class", "n_left")
    counts = finds.join(members.groupBy("_class").agg(F.count("*").alias("n_right")), "_class")
    return sizing.paired_join(found, members, ["_class"], salt_of, F.col("_request"), counts).drop("_class", "_request")


def with_requests(pairs: DataFrame, requests: DataFrame, small: bool, salt_of: Column) -> DataFrame:
    """``pairs`` (``_request`` and others) with the columns of their requests.

    A request that finds a large share of all twins is dealt to groups by its own number of pairs.
    """
    if small:
        return pairs.join(F.broadcast(requests), "_request")
    counts = pairs.groupBy("_request").agg(F.count("*").alias("n"))
    return sizing.weighted_join(pairs, requests, ["_request"], salt_of, sizing.heavy_keys(counts, ["_request"]))


def search(
    twins: DataFrame,
    requests: DataFrame,
    counts: DataFrame | None = None,
    max_rows: int = sizing.MAX_ROWS,
    max_bytes: int = sizing.MAX_BYTES,
) -> DataFrame:
    """Every usable request with every twin it finds: twin columns and request columns.

    Requests measured to be few are broadcast and twins are read in one pass without a shuffle.
    Otherwise only ``(anchor, twin key)`` pairs are shuffled, hot anchors spread over several
    groups, and the candidates meet twins by their keys and requests by their row. Ids of requests
    and twins may repeat or be null: every row is answered for itself, on either way.
    ``counts`` are anchor counts kept from earlier (``anchor_counts``); without them they are
    taken from ``twins`` if some request has a choice, and there are so many requests that a common
    anchor costs more than a pass over the twins. ``index.search_index`` needs no pass at all.
    """
    optioned = request_anchors(requests)
    needs = few = measure(optioned, max_rows, max_bytes)
    classes = optioned
    if needs.requests > FEW_REQUESTS:
        classes = request_classes(optioned)
        needs = measure(classes, max_rows, max_bytes)
    if counts is None and needs.has_choice and not (needs.small and few.requests <= FEW_REQUESTS):
        counts = anchor_counts(twins, classes, needs)
    anchors = choose_anchors(classes, counts, needs.small)
    if needs.small:
        anchors = materialize(anchors, "anchors")
    wanted = listed(anchors, needs.small) if classes is optioned or few.small else None
    pairs = None
    if wanted is not None:
        candidates = anchored(twins, needs, wanted).join(F.broadcast(anchors), "anchor").drop("anchor")
    else:
        # Only anchors that are asked for are worth a row, and of a twin only its key.
        slim = twins.select("host_id", "twin_id", "lat", "lon", "properties", twin_key().alias("_twin"))
        index = anchored(slim, needs).select("anchor", "_twin")
        asked = anchors.select("anchor", "_request")
        if needs.small:
            pairs = index.join(F.broadcast(asked), "anchor")
        else:
            asked = materialize(asked, "asked")
            index = sizing.might_hold(asked, ["anchor"])(index)
            pairs = sizing.spread_join(index, asked, ["anchor"], F.col("_twin"))
        # Each pair once, so that a twin stored twice is found as often as it is stored.
        pairs = materialize(pairs.select("_request", "_twin").distinct(), "candidates")
        asking = with_requests(pairs, classes.drop("options", "geo_level"), needs.small, F.col("_twin"))
        candidates = asking.join(twins.withColumn("_twin", twin_key()), "_twin")
    found = candidates.where(satisfies())
    if classes is not optioned:
        found = to_members(
            found.select(*twins.columns, "_class", *([] if pairs is None else ["_twin"])), optioned, requests.columns,
            few.small, classes, pairs, F.col("_twin"),
        )
    return found.select(*twins.columns, *requests.columns)


# --- Results ----------------------------------------------------------------


def search_projection(twin: Column) -> Column:
    """What a search gives of a twin: ports without values, inputs not stored, no location."""
    def ports(name: str, stored: bool) -> Column:
        return F.transform(
            twin[name],
            lambda p: F.struct(
                p["id"].alias("id"), p["properties"].alias("properties"),
                (p["storeLast"] if stored else F.lit(False)).alias("storeLast"),
                F.array().cast(f"array<{model.VALUE}>").alias("values"),
            ),
        ).alias(name)

    return F.struct(
        twin["hostId"].alias("hostId"), twin["id"].alias("id"),
        twin["properties"].alias("properties"), ports("feeds", True), ports("inputs", False),
    )


def response(found: DataFrame) -> DataFrame:
    """Found twins as far as the response type lets them show.

    ``FULL`` gives the projection of a search, ``LOCATED`` ids and place, ``MINIMAL`` ids only.
    """
    full, located = F.col("response_type") == "FULL", F.col("response_type") == "LOCATED"
    twin = search_projection(F.struct(
        F.col("host_id").alias("hostId"), F.col("twin_id").alias("id"), "properties", "feeds", "inputs"
    ))
    shown = found.withColumn("_t", twin)
    return shown.select(
        "request_id", "response_type", "host_id", "twin_id",
        *[
            F.when(full, F.col("_t")[name]).otherwise(F.array().cast(f"array<{element}>")).alias(name)
            for name, element in (
                ("properties", model.PROPERTY), ("feeds", model.PORT), ("inputs", model.PORT)
            )
        ],
        F.when(located, F.col("lat")).alias("lat"), F.when(located, F.col("lon")).alias("lon"),
    )


def flatten_results(responses: DataFrame, twins: str = "twins") -> DataFrame:
    """Responses that hold many twins to one row per twin; an empty response gives none."""
    others = [c for c in responses.columns if c != twins]
    return responses.select(*others, F.explode(twins).alias("twin"))


def within_expiry(results: DataFrame, requests: DataFrame) -> DataFrame:
    """Results that came after their request and before it expired.

    ``requests``: request_id, requested_at, expiry_seconds; ``results``: request_id, responded_at.
    """
    timed = requests.select("request_id", "requested_at", "expiry_seconds")
    ends = F.col("requested_at") + F.make_dt_interval(secs=F.col("expiry_seconds"))
    return results.join(timed, "request_id").where(
        (F.col("responded_at") >= F.col("requested_at")) & (F.col("responded_at") < ends)
    )
