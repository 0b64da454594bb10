"""SQL that states, straight from the star-schema tables, what each registered query must give.

The statements do not follow the engine's steps: they say which rows the rules of the test data
lead to. Names and texts come from ``vocab``, as SQL has to hold the same ones.
"""

from __future__ import annotations

from twinloom import vocab as v
from twinloom.plans import queries as q
from twinloom.sources import testdata as data


def _s(text: str) -> str:
    """A SQL text literal."""
    return "'" + text.replace("'", "''") + "'"


NULL = "CAST(NULL AS VARCHAR)"
XSD_STRING, XSD_DECIMAL = _s(v.XSD + "string"), _s(v.XSD + "decimal")

_BASE = f"""base AS (
  SELECT c_custkey AS k, CASE WHEN c_custkey // 5 % 7 = 3 THEN -c_custkey - 1 ELSE c_custkey // 5 END AS doc_id, c_name, c_mktsegment, n_name,
    {_s(data.HOST_PREFIX)} || n_regionkey AS host_id, {_s(data.TWIN_PREFIX)} || c_custkey AS twin_id,
    CAST(c_custkey * 37 % 179 - 89 AS DOUBLE) AS lat,
    CAST(c_custkey * 91 % 359 - 179 AS DOUBLE) AS lon,
    CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance,
    'Customer in ' || n_name AS comment,
    CASE WHEN c_custkey % 10 = 0 THEN {_s(f"{v.DID_PREFIX}1, {v.DID_PREFIX}2")}
         WHEN c_custkey % 10 = 1 THEN 'urn:elsewhere:7' ELSE {_s(v.ALLOW_NONE)} END AS allowed
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

_PROPS = f"""props AS (
  SELECT k, host_id, twin_id, 0 AS pos, {_s(v.IDENTIFIER)} AS key, CAST(k AS VARCHAR) AS value,
    'StringLiteral' AS type, {NULL} AS lang, {NULL} AS data_type FROM base
  UNION ALL SELECT k, host_id, twin_id, 1, {_s(v.RDF_TYPE)}, {_s(v.SCHEMA_ORG)} || c_mktsegment, 'Uri', NULL, NULL FROM base
  UNION ALL SELECT k, host_id, twin_id, 2, {_s(v.RDFS_LABEL)}, c_name, 'StringLiteral', NULL, NULL FROM base
  UNION ALL SELECT k, host_id, twin_id, 3, {_s(v.RDFS_COMMENT)}, comment, 'LangLiteral', 'en', NULL FROM base
  UNION ALL SELECT k, host_id, twin_id, 4, {_s(data.BALANCE)}, balance, 'Literal', NULL, {XSD_DECIMAL} FROM base
  UNION ALL SELECT k, host_id, twin_id, 5, {_s(v.HOST_ALLOW_LIST)}, allowed, 'Uri', NULL, NULL FROM base)"""

_FEED_ROWS = ", ".join(
    f"({i}, {_s(f)}, {'TRUE' if f in data.STORED_FEED_IDS else 'FALSE'})" for i, f in enumerate(data.FEED_IDS)
)
_FEEDS = f"feeds(feed_pos, feed_id, store_last) AS (VALUES {_FEED_ROWS})"

_SHARES = f"""shares AS (
  SELECT event_id, host_id, twin_id, event_type AS feed_id, 'application/json' AS mime_type,
    ts AS occurred_at,
    '{{"value":"' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR) || '"}}' AS payload, c_mktsegment
  FROM events JOIN base ON user_id = k)"""

_ID = f"{_s(v.DID_PREFIX)} || substr(sha256({_s(q.SEED + ':')} || {{0}}), 1, 32)"
_FOLLOWER = _ID.format(_s(q.FOLLOWER_KEY))


def _distance(lat: float, lon: float) -> str:
    return (
        f"2 * {v.EARTH_RADIUS_KM} * asin(sqrt(pow(sin(radians(lat - {lat}) / 2), 2) + "
        f"cos(radians({lat})) * cos(radians(lat)) * pow(sin(radians(lon - {lon}) / 2), 2)))"
    )


def _with(body: str, *tables: str) -> str:
    return "WITH " + ",\n".join((_BASE, *tables)) + "\n" + body


# The content of a twin's lists as one text each, as the queries write it.
_PROPS_SHOWN = "concat_ws(';', " + ", ".join((
    f"{_s(v.IDENTIFIER + '|')} || k || '|StringLiteral||'",
    f"{_s(v.RDF_TYPE + '|' + v.SCHEMA_ORG)} || c_mktsegment || '|Uri||'",
    f"{_s(v.RDFS_LABEL + '|')} || c_name || '|StringLiteral||'",
    f"{_s(v.RDFS_COMMENT + '|')} || comment || '|LangLiteral|en|'",
    f"{_s(data.BALANCE + '|')} || balance || {_s('|Literal||' + v.XSD + 'decimal')}",
    f"{_s(v.HOST_ALLOW_LIST + '|')} || allowed || '|Uri||'",
)) + ")"
_PROPS_UNNAMED = _PROPS_SHOWN.replace(f"{_s(v.IDENTIFIER + '|')} || k || '|StringLiteral||', ", "")


def _port_shown(port: str, stored: bool, labelled: bool = True) -> str:
    label = f"{v.RDFS_LABEL}|{port}|StringLiteral||" if labelled else ""
    return _s(f"{port}/{'true' if stored else 'false'}/{label}/")


def _feeds_shown(values: str = "''", labelled: bool = True) -> str:
    ports = ", ".join(f"{_port_shown(f, f in data.STORED_FEED_IDS, labelled)} || {values}" for f in data.FEED_IDS)
    return f"concat_ws(';', {ports})"


def _inputs_shown(labelled: bool = True) -> str:
    return f"CASE WHEN k % 3 = 0 THEN {_port_shown('control', False, labelled)} ELSE '' END"


_LABELS_DECLARED = "CASE WHEN k % 7 = 0 THEN '' WHEN k % 11 = 0 THEN 'value+value' ELSE 'value' END"


def _search() -> str:
    has_text = "(contains(lower(c_name), {0}) OR contains(lower(comment), {0}))"
    building = "c_mktsegment = 'BUILDING'"
    found = {
        "type": ("FULL", building),
        "type_id": ("FULL", f"{building} AND k = 4"),
        "text": ("FULL", has_text.format("'nation_1'")),
        "geo": ("FULL", f"{_distance(50, 10)} <= 2000"),
        "text_geo": ("FULL", f"{has_text.format(_s('customer'))} AND {_distance(-20.5, 175)} <= 1500"),
        "local": ("FULL", f"host_id = {_s(data.LOCAL_HOST)}"),
        "defaults": ("FULL", "c_mktsegment = 'MACHINERY'"),
        "minimal": ("MINIMAL", f"comment = 'Customer in NATION_7' AND {has_text.format(_s('#0000000'))}"),
        "located": ("LOCATED", "balance = '1863.84'"),
    }
    return _with("\nUNION ALL ".join(
        f"""SELECT {_s(name)} AS request_id, {_s(kind)} AS response_type, host_id, twin_id,
  {'lat' if kind == 'LOCATED' else 'CAST(NULL AS DOUBLE)'} AS lat, {'lon' if kind == 'LOCATED' else 'CAST(NULL AS DOUBLE)'} AS lon,
  {_PROPS_SHOWN if kind == 'FULL' else "''"} AS properties, {_feeds_shown() if kind == 'FULL' else "''"} AS feeds
FROM base WHERE {condition}"""
        for name, (kind, condition) in found.items()
    ))


# Values a twin's feeds declare, as (label, times): none, twice, or once.
_N_DECLARED = "CASE WHEN k % 7 = 0 THEN 0 WHEN k % 11 = 0 THEN 2 ELSE 1 END"
_PAYLOAD_ERROR = f"""CASE WHEN k % 17 = 0 THEN {_s(v.VALUES_MISSING)} WHEN k % 7 = 0 THEN NULL
  WHEN k % 11 = 0 THEN {_s(v.LABEL_DUPLICATE)} WHEN k % 13 = 0 THEN {_s(v.VALUE_NULL)} END"""

# Twins of readable documents: five to a document, or each alone in every seventh group.
_IN_DOCUMENT = "doc_id % 50 <> 49"
_TWIN_POS = "CAST(CASE WHEN doc_id < 0 THEN 0 ELSE k % 5 END AS BIGINT)"
_OUTCOME = f"""outcome AS (
  SELECT k, doc_id, {_TWIN_POS} AS twin_pos, host_id, CASE WHEN k % 19 <> 0 THEN twin_id END AS twin_id, balance,
    feed_pos, feed_id,
    CASE WHEN k % 23 = 0 THEN {_s(v.FEEDS_MISSING)}
         WHEN k % 17 = 0 OR (k % 7 <> 0 AND (k % 11 = 0 OR k % 13 = 0)) THEN {_PAYLOAD_ERROR}
         WHEN k % 7 <> 0 AND k % 19 = 0 THEN {_s(v.TWIN_ID_MISSING)} END AS error,
    k % 23 <> 0 AND k % 17 <> 0 AND k % 7 = 0 AS skipped
  FROM base JOIN feeds ON k % 23 <> 0 OR feed_pos = 0),
routed AS (
  SELECT k, doc_id, twin_pos, host_id, twin_id, CAST(feed_pos AS BIGINT) AS feed_pos,
    CASE WHEN k % 23 <> 0 THEN feed_id END AS feed_id,
    CASE WHEN error IS NOT NULL THEN 'failure' WHEN skipped THEN 'skipped' ELSE 'success' END AS route,
    error, CASE WHEN error IS NULL AND NOT skipped THEN balance END AS value
  FROM outcome)"""

_TWIN_FAULT = f"""fault AS (
  SELECT *, CASE WHEN k % 50 = 49 THEN {_s(v.TWIN_NOT_OBJECT)} WHEN k % 13 = 0 THEN NULL
    WHEN k % 17 = 0 THEN {_s(v.PORT_NO_ID)} WHEN k % 31 = 0 THEN {_s(v.TWIN_BAD_LIST)} END AS parse_error
  FROM base)"""
_BUILD_ERROR = f"""coalesce(parse_error, CASE WHEN k % 6 = 0 OR k % 29 = 0
  THEN {_s(v.TWIN_NO_ID_PROPERTY + v.IDENTIFIER)} END)"""

_LINKED = f"""linked AS (
  SELECT *, CASE WHEN k % 50 = 49 THEN {_s(v.JSONLD_INVALID + v.JSONLD_MALFORMED)}
      WHEN k % 50 = 47 THEN {_s(v.JSONLD_INVALID + v.JSONLD_UNSUPPORTED)}
      WHEN k % 50 = 46 THEN {_s(v.JSONLD_INVALID + v.JSONLD_CYCLIC)} END AS error,
    CASE WHEN k % 6 = 0 THEN {_s(f" {v.DID_PREFIX}1, {v.DID_PREFIX}2 ")} WHEN k % 6 = 3 THEN 'nonsense' END AS allow,
    CASE WHEN k = 0 THEN '5.0E-1' ELSE left(CAST(k AS VARCHAR), 1) || '.' || substr(CAST(k AS VARCHAR) || '5', 2)
      || 'E' || (length(CAST(k AS VARCHAR)) - 1) END AS score
  FROM base),
quad AS (
  SELECT k, 0 AS ord, {_s(v.RDF_TYPE)} AS p, {_s(v.SCHEMA_ORG)} || c_mktsegment AS o, 'iri' AS kind, {NULL} AS datatype, {NULL} AS lang FROM linked WHERE error IS NULL
  UNION ALL SELECT k, 1, {_s(v.HOST_ALLOW_LIST)}, allow, 'literal', {XSD_STRING}, NULL FROM linked WHERE error IS NULL AND allow IS NOT NULL
  UNION ALL SELECT k, 2, {_s(v.SCHEMA_ORG + 'active')}, CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END, 'literal', {_s(v.XSD + 'boolean')}, NULL FROM linked WHERE error IS NULL
  UNION ALL SELECT k, 3, {_s(v.IDENTIFIER)}, CAST(k AS VARCHAR), 'literal', {XSD_STRING}, NULL FROM linked WHERE error IS NULL AND k % 50 <> 48
  UNION ALL SELECT k, 4, {_s(v.SCHEMA_ORG + 'price')}, balance, 'literal', {XSD_DECIMAL}, NULL FROM linked WHERE error IS NULL
  UNION ALL SELECT k, 5, {_s(v.SCHEMA_ORG + 'score')}, score, 'literal', {_s(v.XSD + 'double')}, NULL FROM linked WHERE error IS NULL
  UNION ALL SELECT k, 6, {_s(v.SCHEMA_ORG + 'units')}, CAST(k AS VARCHAR), 'literal', {_s(v.XSD + 'integer')}, NULL FROM linked WHERE error IS NULL
  UNION ALL SELECT k, 7, {_s(v.SCHEMA_ORG + 'url')}, {_s(data.HOME)} || k, 'iri', NULL, NULL FROM linked WHERE error IS NULL
  UNION ALL SELECT k, 8, {_s(v.RDFS_COMMENT)}, comment, 'literal', {_s(v.RDF_LANG_STRING)}, 'en' FROM linked WHERE error IS NULL
  UNION ALL SELECT k, 9, {_s(v.RDFS_LABEL)}, c_name, 'literal', {XSD_STRING}, NULL FROM linked WHERE error IS NULL)"""
_LINKED_ERROR = f"""coalesce(error, CASE WHEN k % 50 = 48
  THEN {_s(f"{v.JSONLD_INVALID}missing '{v.IDENTIFIER}'")} END)"""

_SETTING_ERROR = """nullif(concat_ws(', ',
    CASE WHEN k % 6 = 1 THEN 'invalid scope' END,
    CASE WHEN k % 8 = 2 THEN 'invalid response type' END,
    CASE WHEN k % 4 = 2 THEN 'invalid expiry timeout' END{0}), '')"""

# Location rules of the request documents: r is (k % 7 - 1).5 cut to an integer, -1.5 to -1.
_LAT, _LON = "(k % 200 - 100)", "(k % 400 - 200)"
_LOCATION_REASONS = f"""CASE WHEN {{0}} THEN {_s(v.LOCATION_BAD_RADIUS)} END,
    CASE WHEN {_LAT} < -90 OR {_LAT} > 90 THEN {_s(v.LOCATION_BAD_LAT)} END,
    CASE WHEN {_LON} < -180 OR {_LON} > 180 THEN {_s(v.LOCATION_BAD_LON)} END"""
_SMALL_RADIUS = "k % 7 <= 1"

_INTERESTED = "c_mktsegment = 'BUILDING'"
_SHARE_COLUMNS = "host_id, twin_id, feed_id, mime_type, occurred_at, payload"
_NEWEST = "row_number() OVER (PARTITION BY host_id, twin_id, feed_id ORDER BY occurred_at DESC, event_id DESC) = 1"
_UNTIL = f"TIMESTAMP '{q.SNAPSHOT_END:%Y-%m-%d %H:%M:%S}'"
_FOLLOW = _with(
    f"SELECT {_FOLLOWER} AS follower_twin_id, event_id, {_SHARE_COLUMNS} FROM shares WHERE {_INTERESTED}", _SHARES
)

_UNITS_TEXT = "CASE WHEN k % 3 = 0 THEN CAST(k AS VARCHAR) || 'x' ELSE CAST(k AS VARCHAR) END"
_RECORD_PROPS = ((v.IDENTIFIER, "CAST(k AS VARCHAR)", "StringLiteral"), (v.SCHEMA_ORG + "category", "CASE WHEN k % 9 <> 0 THEN c_mktsegment END", "StringLiteral"),
    (v.SCHEMA_ORG + "areaServed", "n_name", "StringLiteral"), (v.SCHEMA_ORG + "quantity", _UNITS_TEXT, "StringLiteral"),
    (v.RDFS_COMMENT, "CASE WHEN k % 5 <> 0 THEN 'Served monthly' END", "StringLiteral"), (v.HOST_ALLOW_LIST, _s(v.ALLOW_NONE), "Uri"),
    (v.RDFS_LABEL, "CASE WHEN k % 7 = 0 THEN c_name WHEN k % 9 = 0 THEN 'A customer' ELSE c_mktsegment || ' ' || n_name || ' ' || k END", "StringLiteral"),
    (v.RDF_TYPE, _s(v.SCHEMA_ORG + "Person"), "Uri"))

_REQUESTS = f"""SELECT k AS request_id,
  CASE WHEN k % 50 = 49 THEN NULL WHEN k % 5 = 0 THEN c_name WHEN k % 5 = 1 THEN ' ' END AS text,
  CASE WHEN k % 50 <> 49 AND k % 3 = 0 THEN CAST({_LAT} AS DOUBLE) END AS lat0,
  CASE WHEN k % 50 <> 49 AND k % 3 = 0 THEN CAST({_LON} AS DOUBLE) END AS lon0,
  CASE WHEN k % 50 <> 49 AND k % 3 = 0 THEN CAST(k % 7 - 1 AS BIGINT) END AS radius_km,
  CAST(CASE WHEN k % 50 = 49 THEN 1 WHEN k % 9 IN (1, 2, 3, 4) THEN 0 ELSE 1 END AS BIGINT) AS n_wanted,
  CASE WHEN k % 50 = 49 THEN 'GLOBAL' WHEN k % 6 = 0 THEN 'LOCAL' WHEN k % 6 = 1 THEN 'WORLD' ELSE 'GLOBAL' END AS scope,
  CASE WHEN k % 50 = 49 THEN 'FULL' WHEN k % 8 = 0 THEN 'MINIMAL' WHEN k % 8 = 1 THEN 'LOCATED' WHEN k % 8 = 2 THEN 'SOME' ELSE 'FULL' END AS response_type,
  CAST(CASE WHEN k % 50 = 49 THEN 3 WHEN k % 4 = 0 THEN 2 WHEN k % 4 = 1 THEN 7 WHEN k % 4 = 2 THEN -1 ELSE 3 END AS BIGINT) AS expiry_seconds,
  CASE WHEN k % 50 = 49 THEN 'malformed request' ELSE nullif(concat_ws(', ', {_SETTING_ERROR.format('')},
    CASE WHEN k % 3 = 0 THEN nullif(concat_ws(', ', {_LOCATION_REASONS.format(_SMALL_RADIUS)}), '') END,
    CASE k % 9 WHEN 1 THEN {_s(v.SPEC_NO_DATATYPE)} WHEN 2 THEN {_s(v.SPEC_NO_LANG + ', ' + v.SPEC_NO_KEY)}
      WHEN 4 THEN {_s(v.SPEC_NO_VALUE)} END), '') END AS error
"""
# What the requests of a table find: a property no twin has, none, or the default type; text, circle and scope.
_MANY = _with(f"""SELECT r.request_id, t.host_id, t.twin_id
FROM (SELECT * FROM ({_REQUESTS}FROM base) WHERE error IS NULL) r JOIN base t ON
  (r.text IS NULL OR contains(lower(t.c_name), lower(r.text)) OR contains(lower(t.comment), lower(r.text)))
  AND (r.lat0 IS NULL OR {_distance("r.lat0", "r.lon0")} <= r.radius_km)
  AND r.request_id % 9 <> 0 AND (r.request_id % 9 = 3 OR t.c_mktsegment = 'MACHINERY')
  AND (r.scope <> 'LOCAL' OR t.host_id = {_s(data.LOCAL_HOST)})""")

_SEGMENT = 100 * q.CHUNKS_PER_SEGMENT  # characters

_LAST = _with(f"SELECT event_id, {_SHARE_COLUMNS} FROM shares QUALIFY {_NEWEST}", _SHARES)
_SNAPSHOT_LIVE = _with(f"""SELECT {_FOLLOWER} AS follower_twin_id, event_id, {_SHARE_COLUMNS}, 'live' AS phase
FROM shares WHERE {_INTERESTED} AND occurred_at > {_UNTIL}
UNION ALL SELECT {_FOLLOWER}, event_id, {_SHARE_COLUMNS}, 'snapshot' FROM (
  SELECT * FROM shares WHERE {_INTERESTED} AND occurred_at <= {_UNTIL} AND feed_id IN ('purchase', 'signup') QUALIFY {_NEWEST})""", _SHARES)
_BOUNDED = """SELECT user_id AS request_id, event_id, ts AS responded_at
FROM events JOIN customer ON user_id = c_custkey
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' + to_days(CAST(c_custkey % 20 AS INTEGER))
  AND ts < TIMESTAMP '2024-01-05 00:00:00' + to_days(CAST(c_custkey % 20 + c_custkey % 7 + 1 AS INTEGER))"""
_DESCRIBED = f"""SELECT k AS request_id, CASE WHEN error IS NULL THEN 'success' ELSE 'failure' END AS route, error,
  CASE WHEN error IS NULL THEN twin_id END AS described_id,
  CASE WHEN k % 8 = 3 THEN twin_id WHEN k % 8 = 5 THEN twin_id || 'x' END AS input_id, error AS document_error{{0}}
FROM (SELECT *, CASE k % 8 WHEN 3 THEN {_s(v.HOST_ID_MISSING)} WHEN 4 THEN {_s(v.TWIN_ID_MISSING)}
  WHEN 5 THEN {_s(v.TWIN_UNKNOWN)} END AS error FROM base)"""

ORACLES: dict[str, str] = {
    "q_search": _search(),
    "q_search_many": _MANY,
    "q_search_shuffled": _MANY,
    "q_search_indexed": _MANY,
    "q_search_text": _with(
        f"SELECT host_id, twin_id FROM base WHERE contains(lower(c_name), lower({_s(q.SEARCH_TEXT)})) "
        f"OR contains(lower(comment), lower({_s(q.SEARCH_TEXT)}))"
    ),
    "q_search_geo": _with(
        f"SELECT host_id, twin_id, round({_distance(50, 10)}, 6) AS distance_km FROM base WHERE {_distance(50, 10)} <= 2000"
    ),
    "q_search_properties": _with(
        "SELECT host_id, twin_id FROM base WHERE c_mktsegment = 'BUILDING' AND comment = 'Customer in NATION_3'"
    ),
    "q_search_scope": _with(f"SELECT host_id, twin_id FROM base WHERE host_id = {_s(data.LOCAL_HOST)}"),
    "q_search_defaults": _with(f"""{_REQUESTS}FROM base"""),
    "q_search_project": _with(f"""SELECT host_id, twin_id, {_PROPS_SHOWN} AS properties, {_feeds_shown()} AS feeds,
  {_inputs_shown()} AS inputs FROM base"""),
    "q_response_type": _with(f"""SELECT k AS request_id,
  CASE k % 3 WHEN 0 THEN 'FULL' WHEN 1 THEN 'LOCATED' ELSE 'MINIMAL' END AS response_type, host_id, twin_id,
  CASE WHEN k % 3 = 1 THEN lat END AS lat, CASE WHEN k % 3 = 1 THEN lon END AS lon,
  CASE WHEN k % 3 = 0 THEN {_PROPS_SHOWN} ELSE '' END AS properties, CASE WHEN k % 3 = 0 THEN {_feeds_shown()} ELSE '' END AS feeds,
  {_inputs_shown()} AS inputs FROM base"""),
    "q_search_flatten": _with("SELECT doc_id AS response_id, host_id, twin_id FROM base WHERE doc_id % 10 <> 0"),
    "q_bounded_results": _BOUNDED,
    "q_bounded_stream": _BOUNDED,
    "q_twin_documents": _with(f"""SELECT doc_id, {_TWIN_POS} AS twin_pos, host_id,
  CASE WHEN k % 19 <> 0 THEN twin_id END AS twin_id, {NULL} AS error, CAST(6 AS BIGINT) AS n_properties,
  CASE WHEN k % 23 <> 0 THEN CAST(5 AS BIGINT) END AS n_feeds FROM base WHERE {_IN_DOCUMENT}
UNION ALL SELECT DISTINCT doc_id, CAST(NULL AS BIGINT), {NULL}, {NULL}, {_s(v.DOCUMENT_MALFORMED)},
  CAST(NULL AS BIGINT), CAST(NULL AS BIGINT) FROM base WHERE doc_id % 50 = 49"""),
    "q_twin_parse": _with(f"""SELECT k AS c_custkey,
  CASE WHEN parse_error IS NULL THEN host_id END AS host_id, CASE WHEN parse_error IS NULL THEN twin_id END AS twin_id,
  CASE WHEN parse_error IS NULL THEN CASE WHEN k % 6 = 0 THEN '' WHEN k % 29 = 0 THEN {_PROPS_UNNAMED} ELSE {_PROPS_SHOWN} END END AS properties,
  CASE WHEN parse_error IS NULL THEN CASE WHEN k % 13 = 0 THEN '' ELSE {_feeds_shown(_LABELS_DECLARED)} END END AS feeds,
  CASE WHEN parse_error IS NULL THEN {_inputs_shown()} END AS inputs, parse_error AS error FROM fault""", _TWIN_FAULT),
    "q_twin_json": _with("""SELECT twin_id, host_id, c_name AS label, 'en' AS comment_lang,
  'true' AS signup_stored, FALSE AS has_null FROM base"""),
    "q_twin_list": _with(f"""SELECT host_id, twin_id, lat, lon, {_PROPS_SHOWN} AS properties, {_feeds_shown(_LABELS_DECLARED)} AS feeds,
  {_inputs_shown()} AS inputs FROM base"""),
    "q_request_text": """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE text END AS text FROM (
  SELECT page_id, url, CASE WHEN right(lines, 1) = chr(10) THEN left(lines, length(lines) - 1) ELSE lines END AS text FROM (
    SELECT page_id, url, replace(replace(html, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS lines FROM pages))""",
    "q_empty_lists": _with(f"""SELECT k AS c_custkey, host_id, CASE WHEN k % 19 <> 0 THEN twin_id END AS twin_id,
  CAST(CASE WHEN k % 23 = 0 THEN 0 ELSE 5 END AS BIGINT) AS n_feeds, CAST(CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS BIGINT) AS n_inputs,
  CAST(CASE WHEN k % 23 = 0 OR k % 17 = 0 OR k % 7 = 0 THEN 0 ELSE 10 - CASE WHEN k % 11 <> 0 AND k % 13 = 0 THEN 5 ELSE 0 END END AS BIGINT) AS n_values,
  FALSE AS has_null FROM base"""),
    "q_find_property": _with(f"""SELECT twin_id, CAST(k AS VARCHAR) AS identifier, comment,
  'en' AS comment_lang, {NULL} AS missing FROM base"""),
    "q_property_flatten": _with(f"""SELECT k AS c_custkey, CAST(pos AS BIGINT) AS pos,
  CASE WHEN k % 10 NOT IN (3, 4) THEN key END AS key, CASE WHEN k % 10 NOT IN (3, 4) THEN value END AS value,
  CASE WHEN k % 10 NOT IN (3, 4) THEN type END AS type, CASE WHEN k % 10 NOT IN (3, 4) THEN lang END AS lang,
  CASE WHEN k % 10 NOT IN (3, 4) AND type = 'Literal' THEN 'decimal' END AS data_type,
  CASE k % 10 WHEN 3 THEN {_s(v.PROPERTY_NO_MEMBER)} || key WHEN 4 THEN {_s(v.PROPERTY_NULL)} END AS error FROM props""", _PROPS),
    "q_property_typed": _with(f"""SELECT c_custkey, pos, CASE WHEN error IS NULL THEN key END AS key,
  CASE WHEN error IS NULL AND type = 'Literal' THEN value END AS literal,
  CASE WHEN error IS NULL AND type = 'Literal' THEN CASE WHEN c_custkey % 11 = 7 THEN 'string'
    WHEN c_custkey % 11 = 8 THEN 'customType' ELSE 'decimal' END END AS data_type,
  CASE WHEN error IS NULL AND type = 'LangLiteral' THEN value END AS lang_literal,
  CASE WHEN error IS NULL AND type = 'LangLiteral' THEN lang END AS lang,
  CASE WHEN error IS NULL AND type = 'Uri' THEN value END AS uri,
  CASE WHEN error IS NULL AND type = 'StringLiteral' THEN value END AS string_literal, error
FROM (SELECT k AS c_custkey, CAST(pos AS BIGINT) AS pos, key, value, type, lang,
  CASE k % 11 WHEN 0 THEN {_s(v.PROPERTY_NO_KEY)} WHEN 1 THEN {_s(v.PROPERTY_NO_VALUE)}
    WHEN 2 THEN {_s(v.PROPERTY_BAD_TYPE + 'InvalidType')} WHEN 3 THEN {_s(v.PROPERTY_BAD_TYPE + 'null')}
    WHEN 4 THEN CASE WHEN type = 'LangLiteral' THEN {_s(v.PROPERTY_NO_LANG)} END
    WHEN 5 THEN CASE WHEN type = 'Literal' THEN {_s(v.DATATYPE_NO_FRAGMENT)} END
    WHEN 6 THEN CASE WHEN type = 'Literal' THEN {_s(v.DATATYPE_ILLEGAL)} END END AS error FROM props)""", _PROPS),
    "q_property_spec": f"""SELECT c_custkey, CASE WHEN r IN (2, 4, 5, 7, 8) THEN 'key' END AS key,
  CASE WHEN r IN (2, 4, 5, 7, 8) THEN c_name END AS value,
  CASE WHEN r IN (2, 8) THEN 'Literal' WHEN r = 4 THEN 'LangLiteral' WHEN r IN (5, 7) THEN 'StringLiteral' END AS type,
  CASE WHEN r = 4 THEN 'en' END AS lang, CASE WHEN r IN (2, 8) THEN 'string' END AS data_type,
  CASE WHEN r = 0 THEN {_s(v.SPEC_NO_KEY)} WHEN r = 1 THEN {_s(v.SPEC_NO_DATATYPE)}
    WHEN r = 3 THEN {_s(v.SPEC_NO_LANG)} WHEN r = 6 THEN {_s(v.SPEC_NO_VALUE)} END AS error
FROM (SELECT c_custkey, c_name, c_custkey % 9 AS r FROM customer)""",
    "q_property_list_check": f"""SELECT c_custkey, CASE c_custkey % 5
  WHEN 1 THEN {_s(v.SPEC_NO_KEY + ', ' + v.SPEC_NO_DATATYPE)}
  WHEN 2 THEN {_s(v.SPECS_BAD_JSON + 'not an array')} WHEN 3 THEN {_s(v.SPECS_BAD_JSON + 'not an array')} END AS error
FROM customer""",
    "q_allow_list": f"""SELECT c_custkey, CASE r WHEN 0 THEN {_s(v.ALLOW_ALL)} WHEN 1 THEN {_s(v.ALLOW_NONE)}
    WHEN 2 THEN {_s(v.DID_PREFIX)} || c_name || ',' || {_s(v.DID_PREFIX + '2')} END AS value,
  CAST(CASE WHEN r = 2 OR r = 3 THEN 2 WHEN r = 7 THEN NULL ELSE 0 END AS BIGINT) AS n_valid,
  CAST(CASE WHEN r IN (0, 1, 3, 5) THEN 1 WHEN r = 7 THEN NULL ELSE 0 END AS BIGINT) AS n_invalid
FROM (SELECT c_custkey, c_name, c_custkey % 8 AS r FROM customer)""",
    "q_location_check": f"""SELECT c_custkey, CASE WHEN k % 50 IN (48, 49) THEN {_s(v.LOCATION_BAD_JSON + 'not an object')}
  ELSE nullif(concat_ws(', ', {_LOCATION_REASONS.format('k % 4 = 0 OR ' + _SMALL_RADIUS)}), '') END AS error
FROM (SELECT c_custkey, c_custkey AS k FROM customer)""",
    "q_datatype_name": f"""SELECT c_custkey,
  CASE c_custkey % 6 WHEN 0 THEN c_mktsegment WHEN 1 THEN c_mktsegment WHEN 4 THEN c_mktsegment WHEN 5 THEN 'string' END AS name,
  CASE c_custkey % 6 WHEN 2 THEN {_s(v.DATATYPE_NO_FRAGMENT)} WHEN 3 THEN {_s(v.DATATYPE_ILLEGAL)} END AS error
FROM customer""",
    "q_detect_uri": f"""SELECT page_id,
  CASE WHEN page_id % 5 IN (0, 4) AND regexp_matches(url, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN 'anyURI' END AS datatype,
  CASE WHEN page_id % 5 IN (2, 3) THEN {_s(v.URI_ILLEGAL)} END AS error FROM pages""",
    "q_detect_datetime": """SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'date' WHEN 1 THEN 'time'
  WHEN 2 THEN 'dateTime' WHEN 3 THEN 'dateTime' WHEN 4 THEN 'dateTime' WHEN 7 THEN 'time'
  WHEN 9 THEN 'dateTime' END AS datatype FROM events""",
    "q_request_check": f"""SELECT k AS request_id, CASE WHEN k % 50 <> 49 THEN {_SETTING_ERROR.format(''', 
    CASE WHEN k % 5 = 1 THEN 'blank text' END''')} END AS error FROM (SELECT c_custkey AS k FROM customer)""",
    "q_route": _with(f"""SELECT k AS c_custkey, CASE WHEN build_error IS NULL THEN 'success' ELSE 'failure' END AS route,
  build_error AS error, CASE WHEN build_error IS NULL THEN {_s(data.LOCAL_HOST)} END AS host_id,
  CASE WHEN build_error IS NULL THEN {_ID.format('k')} END AS twin_id
FROM (SELECT k, {_BUILD_ERROR} AS build_error FROM fault)""", _TWIN_FAULT),
    "q_describe": _with(f"""SELECT host_id, twin_id, {_PROPS_SHOWN} AS properties, {_feeds_shown(labelled=False)} AS feeds,
  {_inputs_shown(False)} AS inputs FROM base"""),
    "q_describe_lookup": _with(_DESCRIBED.format(
        ",\n  CASE WHEN error IS NULL THEN CAST(6 AS BIGINT) END AS n_properties"
    )),
    "q_describe_stream": _with(_DESCRIBED.format("")),
    "q_reshape_twin": _with("\nUNION ALL ".join(
        f"SELECT CAST(k AS VARCHAR) AS id, 'orders' AS feed_id, CAST(0 AS BIGINT) AS n_inputs, "
        f"CAST({i} AS BIGINT) AS pos, {_s(key)} AS key, {value} AS value, {_s(kind)} AS type FROM base"
        for i, (key, value, kind) in enumerate(_RECORD_PROPS)
    )),
    "q_reshape_jsonld": _with(f"""SELECT CAST(k AS VARCHAR) AS id,
  CASE WHEN k % 4 IN (0, 1) THEN 'BOOLEAN' WHEN k % 4 = 2 THEN 'STRING' END AS operational_type,
  CASE k % 4 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN '1' END AS operational, {_UNITS_TEXT} AS quantity,
  CASE WHEN k % 3 = 0 THEN {XSD_STRING} ELSE {_s(v.XSD + 'integer')} END AS units_type,
  n_name || ' ' || k AS title, CAST(3 AS BIGINT) AS n_quads, {NULL} AS error FROM base"""),
    "q_identity": f"SELECT c_custkey, {_ID.format('c_name')} AS twin_id FROM customer",
    "q_twin_upsert": _with("""SELECT host_id, twin_id,
  CAST(CASE WHEN k % 4 = 0 THEN 5 WHEN k % 10 = 5 THEN 3 WHEN k % 2 = 1 OR k % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS batch,
  CASE WHEN k % 4 = 0 THEN c_name WHEN k % 10 = 5 THEN c_name || ' v3' WHEN k % 5 = 0 THEN c_name || ' v2' ELSE c_name END AS label FROM base"""),
    "q_upsert_stream": _with(f"""SELECT {_s(data.LOCAL_HOST)} AS host_id, {_ID.format('k')} AS twin_id,
  CAST(CASE WHEN k % 5 = 0 THEN 2 ELSE 1 END AS BIGINT) AS batch, c_name AS label FROM base"""),
    "q_upsert_ports": _with(f"""SELECT twin_id, 'feed' AS kind, feed_id AS port_id, store_last, CAST(1 AS BIGINT) AS n_properties,
  CAST({_N_DECLARED} AS BIGINT) AS n_values, CASE WHEN k % 7 <> 0 THEN 'value' END AS first_label,
  {_s(v.RDFS_LABEL)} AS first_key, feed_id AS first_text FROM base, feeds
UNION ALL SELECT twin_id, 'input', 'control', CAST(NULL AS BOOLEAN), CAST(1 AS BIGINT), CAST(0 AS BIGINT), {NULL}, {_s(v.RDFS_LABEL)}, 'control'
FROM base WHERE k % 3 = 0""", _FEEDS),
    "q_feed_values": _with(f"""SELECT host_id, twin_id, feed_id, value_pos, 'value' AS label, 'double' AS data_type, 'event value' AS comment
FROM base, feeds, (VALUES (CAST(0 AS BIGINT)), (CAST(1 AS BIGINT))) AS n(value_pos) WHERE value_pos < {_N_DECLARED}""", _FEEDS),
    "q_follower_twin": f"""SELECT {_s(data.LOCAL_HOST)} AS host_id, {_ID.format('s_suppkey')} AS twin_id, {_s(v.ALLOW_ALL)} AS visibility,
  {_s(v.SCHEMA_ORG + 'Follower')} AS type, s_name AS label, 'Follower of ' || s_name AS comment, {_s(v.FOLLOWER_FEED)} AS feed_id,
  {_s(v.FOLLOWER_VALUE_LABEL)} AS value_label, {_s(v.FOLLOWER_PAYLOAD)} AS payload FROM supplier""",
    "q_distinct_ports": _with(f"SELECT DISTINCT feed_id AS port_id, store_last, CAST({_N_DECLARED} AS BIGINT) AS n_values FROM base, feeds", _FEEDS),
    "q_fan_out": _with(f"SELECT doc_id, twin_pos, feed_pos, twin_id, feed_id FROM routed WHERE {_IN_DOCUMENT}", _FEEDS, _OUTCOME),
    "q_feed_total": _with(f"""SELECT doc_id, CAST(sum(CASE WHEN k % 23 <> 0 THEN 5 ELSE 0 END) AS BIGINT) AS n_feeds
FROM base WHERE {_IN_DOCUMENT} GROUP BY doc_id"""),
    "q_feed_payload": _with(f"""SELECT c_custkey, feed_id, CASE WHEN good THEN balance END AS value, CASE WHEN good THEN 'USD' END AS unit,
  CASE WHEN good THEN CAST(length('{{"value":"","unit":"USD"}}') + length(balance) AS BIGINT) WHEN empty THEN CAST(2 AS BIGINT) END AS n_chars, error
FROM (SELECT k AS c_custkey, feed_id, balance, {_PAYLOAD_ERROR} AS error, k % 17 <> 0 AND k % 7 = 0 AS empty,
  k % 17 <> 0 AND k % 7 <> 0 AND k % 11 <> 0 AND k % 13 <> 0 AS good FROM base, feeds WHERE k % 23 <> 0)""", _FEEDS),
    "q_set_shares": _with("""SELECT k AS c_custkey, feed_id, pos, CASE WHEN pos = 0 OR k % 11 = 0 THEN 'value' ELSE 'unit' END AS label,
  CASE WHEN pos = 0 THEN 'new ' || k WHEN k % 11 = 0 THEN balance ELSE 'USD' END AS value
FROM base, feeds, (VALUES (CAST(0 AS BIGINT)), (CAST(1 AS BIGINT))) AS n(pos)
WHERE k % 23 <> 0 AND k % 17 <> 0 AND k % 7 <> 0 AND (pos = 0 OR k % 11 = 0 OR k % 13 <> 0)""", _FEEDS),
    "q_publish": _with(f"""SELECT doc_id, twin_pos, feed_pos, route, error, host_id, twin_id, feed_id, value, error AS document_error
FROM routed WHERE {_IN_DOCUMENT}""", _FEEDS, _OUTCOME),
    "q_document_status": _with(f"""SELECT doc_id,
  CAST(count(feed_id) AS BIGINT) AS n_feeds, CAST(count(*) FILTER (route = 'success') AS BIGINT) AS n_success,
  CAST(count(*) FILTER (route = 'failure') AS BIGINT) AS n_failure, CAST(count(*) FILTER (route = 'skipped') AS BIGINT) AS n_skipped,
  {NULL} AS error, 'original' AS route FROM routed WHERE {_IN_DOCUMENT} GROUP BY doc_id
UNION ALL SELECT DISTINCT doc_id, CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT), {_s(v.DOCUMENT_MALFORMED)}, 'failure'
FROM base WHERE doc_id % 50 = 49""", _FEEDS, _OUTCOME),
    "q_triples": _with(f"""SELECT twin_id AS s, key AS p, value AS o_value, CASE WHEN type = 'Uri' THEN 'iri' ELSE 'literal' END AS o_kind,
  CASE type WHEN 'StringLiteral' THEN {XSD_STRING} WHEN 'LangLiteral' THEN {_s(v.RDF_LANG_STRING)} WHEN 'Literal' THEN {XSD_DECIMAL} ELSE '' END AS o_datatype,
  coalesce(lang, '') AS o_lang FROM props""", _PROPS),
    "q_jsonld_quads": _with(f"""SELECT k AS doc_id, row_number() OVER (PARTITION BY k ORDER BY ord) - 1 AS pos, '_:b0' AS s, p, o, kind, datatype,
  lang FROM quad""", _LINKED),
    "q_first_graph": _with(f"""SELECT k AS doc_id,
  CASE WHEN bad OR r = 0 THEN NULL WHEN r = 3 THEN {_s(data.HOME + 'own')} WHEN r = 4 THEN {_s(data.HOME + 'g2')} ELSE '@default' END AS graph,
  CASE WHEN bad THEN NULL WHEN r = 1 THEN '_:b0' || p || c_name
    WHEN r = 2 THEN {_s(data.HOME + 'a/')} || k || p || c_name || ' 0;_:b1' || p || c_name || ';' || {_s(data.HOME + 'a/')} || k || p || c_name || ' 2'
    WHEN r = 3 THEN {_s(data.HOME + 'a/')} || k || p || c_name || ' 0'
    WHEN r = 4 THEN {_s(data.HOME + 'a/')} || k || p || c_name || ' 0;' || {_s(data.HOME + 'b/')} || k || p || c_name || ' 1'
    WHEN r = 5 THEN {_s(data.HOME + 'b/')} || k || p || c_name || ' 0' END AS quads,
  CASE WHEN bad THEN {_s(v.JSONLD_INVALID + v.JSONLD_UNSUPPORTED)} WHEN r = 0 THEN {_s(v.JSONLD_INVALID + v.JSONLD_NO_GRAPH)} END AS error
FROM (SELECT *, k % 6 AS r, k % 50 = 44 AS bad, {_s('|' + v.RDFS_LABEL + '|')} AS p FROM base)"""),
    "q_jsonld_identity": _with(f"""SELECT k AS doc_id, CASE WHEN e IS NULL THEN {_ID.format('k')} END AS twin_id, e AS error
FROM (SELECT k, {_LINKED_ERROR} AS e FROM linked)""", _LINKED),
    "q_quads_to_properties": _with(f"""SELECT k AS doc_id, row_number() OVER (PARTITION BY k ORDER BY ord) - 1 AS pos, key, value, type, data_type FROM (
  SELECT k, ord, p AS key, o AS value, CASE WHEN kind = 'iri' THEN 'Uri' WHEN lang IS NOT NULL THEN 'LangLiteral' ELSE 'Literal' END AS type,
    CASE WHEN kind = 'literal' AND lang IS NULL THEN regexp_extract(datatype, '#(.*)$', 1) END AS data_type FROM quad WHERE ord <> 1
  UNION ALL SELECT k, 99, {_s(v.HOST_ALLOW_LIST)}, CASE WHEN k % 6 = 0 THEN {_s(f"{v.DID_PREFIX}1,{v.DID_PREFIX}2")} ELSE {_s(v.ALLOW_ALL)} END,
    'Uri', NULL FROM linked WHERE error IS NULL) WHERE k % 50 <> 48""", _LINKED),
    "q_graph_pattern": _with(f"""SELECT twin_id, balance, {XSD_DECIMAL} AS datatype FROM base
WHERE c_mktsegment = 'BUILDING' AND allowed = {_s(v.ALLOW_NONE)}"""),
    "q_graph_join": _with(f"""SELECT t.twin_id, g.twin_id AS guide_id, t.place FROM placed t JOIN placed g ON t.place = g.place
WHERE g.c_mktsegment = 'BUILDING' AND g.allowed = {_s(f"{v.DID_PREFIX}1, {v.DID_PREFIX}2")}""",
        "placed AS (SELECT *, CASE WHEN k % 3 = 0 THEN 'Customer of the house' ELSE comment END AS place FROM base)"),
    "q_pattern_count": _with(f"SELECT count(*) AS n FROM base WHERE c_mktsegment = 'BUILDING' AND allowed = {_s(v.ALLOW_NONE)}"),
    "q_bindings_json": f"""SELECT {_s(v.SCHEMA_ORG)} || c_mktsegment AS type_value, 'uri' AS type_kind, CAST(count(*) AS VARCHAR) AS n_value,
  {_s(v.XSD + 'integer')} AS n_datatype, 'n' AS second_variable FROM customer GROUP BY c_mktsegment""",
    "q_chunk_join": f"""SELECT doc_id, segment, (n - 1) // {_SEGMENT} + 1 AS n_segments,
  CAST(ceil(length(whole) / 100.0) AS BIGINT) + CASE WHEN segment <> 0 THEN 0 WHEN gap THEN -1 WHEN r = 13 THEN 1 ELSE 0 END AS n_chunks,
  CAST(length(part) AS BIGINT) AS n_chars, md5(part) AS text_md5,
  CASE WHEN r IN (0, 13, 17) OR gap THEN 'failure' ELSE 'success' END AS route,
  CASE WHEN r IN (0, 13, 17) OR gap THEN {_s(v.CHUNKS_INCOMPLETE)} END AS error
FROM (SELECT doc_id, segment, n, gap, r, whole, CASE WHEN segment <> 0 THEN whole WHEN gap THEN left(whole, 100) || substr(whole, 201)
    WHEN r = 13 THEN '?' || whole WHEN r = 17 THEN substr(whole, 101) ELSE whole END AS part
  FROM (SELECT doc_id, length(text) AS n, doc_id % 20 = 7 AND length(text) > 200 AS gap, doc_id % 20 AS r, segment,
    substr(text, segment * {_SEGMENT} + 1, {_SEGMENT}) AS whole
  FROM documents, LATERAL (SELECT unnest(generate_series(CAST(0 AS BIGINT), CAST((length(text) - 1) // {_SEGMENT} AS BIGINT))) AS segment)))""",
    "q_follow": _FOLLOW,
    "q_last_stored": _LAST,
    "q_last_state": _LAST,
    "q_follow_snapshot_live": _SNAPSHOT_LIVE,
    "q_follow_snapshot_stream": _SNAPSHOT_LIVE,
    "q_refollow": _FOLLOW,
    "q_follow_stream": _FOLLOW.replace("occurred_at, payload FROM", "CAST(occurred_at AS TIMESTAMP) AS occurred_at, payload FROM"),
    "q_share_sink": _with(f"""SELECT host_id, twin_id, feed_id, 'application/json' AS mime_type, value FROM routed
WHERE route = 'success'""", _FEEDS, _OUTCOME),
    "q_publish_stream": _with("SELECT k AS doc_id, feed_pos, route, error, twin_id, feed_id, value FROM routed", _FEEDS, _OUTCOME),
}
