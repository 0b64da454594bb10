"""Names, patterns and texts that documents, tables and callers rely on."""

# --- Fixed values: stated as the wire format needs them -------------------

RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDF_LANG_STRING = "http://www.w3.org/1999/02/22-rdf-syntax-ns#langString"
RDFS_LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
RDFS_COMMENT = "http://www.w3.org/2000/01/rdf-schema#comment"
XSD = "http://www.w3.org/2001/XMLSchema#"
SCHEMA_ORG = "http://schema.org/"
IDENTIFIER = "http://schema.org/identifier"

HOST_ALLOW_LIST = "http://data.iotics.com/public#hostAllowList"
ALLOW_ALL = "http://data.iotics.com/public#all"
ALLOW_NONE = "http://data.iotics.com/public#none"
DID_PREFIX = "did:iotics:"

PROPERTY_TYPES = ("Uri", "LangLiteral", "Literal", "StringLiteral")
SCOPES = ("LOCAL", "GLOBAL")
RESPONSE_TYPES = ("FULL", "LOCATED", "MINIMAL")
ROUTES = ("success", "original", "failure", "skipped")

SPEC_NO_KEY = 'Invalid property: missing "key"'
SPEC_NO_DATATYPE = 'Invalid property: literal without "dataType"'
SPEC_NO_LANG = 'Invalid property: langLiteral without "lang"'
SPEC_NO_VALUE = (
    'Invalid property: missing one of "uri", "literal", "stringLiteral", "langLiteral" '
)
PROPERTY_NO_KEY = "invalid property: missing key"
PROPERTY_NO_VALUE = "invalid property: missing value"
PROPERTY_BAD_TYPE = "invalid property type: "
PROPERTY_NO_MEMBER = "invalid property type, missing value: "
PROPERTY_NULL = "null property"
LOCATION_BAD_RADIUS = "missing or invalid radius"
LOCATION_BAD_LAT = "missing or invalid lat"
LOCATION_BAD_LON = "missing or invalid lon"
LOCATION_BAD_JSON = "Exception when validating JSON: "
SPECS_BAD_JSON = "Exception when validating property: "
TWIN_NO_ID_PROPERTY = "invalid twin: missing property "
JSONLD_INVALID = "invalid JSON-LD: "
BAD_ALLOW_LIST_DEFAULT = "invalid default for allow list value: "

FOLLOWER_FEED = "status"
FOLLOWER_FEED_LABEL = "OperationalStatus"
FOLLOWER_FEED_COMMENT = "Whether the followed twin is at work"
FOLLOWER_VALUE_LABEL = "isOperational"
FOLLOWER_VALUE_COMMENT = "true while it is"
FOLLOWER_PAYLOAD = '{"isOperational":true}'

# --- Texts of this engine's own -------------------------------------------

PROPERTY_NO_LANG = "invalid property: missing lang"
DATATYPE_NO_FRAGMENT = "invalid property: dataType without fragment"
DATATYPE_ILLEGAL = "invalid property: dataType is not a legal URI"
URI_ILLEGAL = "illegal URI"
DOCUMENT_MALFORMED = "invalid document: malformed JSON"
DOCUMENT_NOT_TWINS = "invalid document: not a twin or an array of twins"
TWIN_NOT_OBJECT = "invalid twin: not a JSON object"
TWIN_BAD_LIST = "invalid twin: a list entry is not an object"
PORT_NO_ID = "invalid twin: port without id"
LABEL_DUPLICATE = "duplicate value label"
LABEL_NULL = "value without label"
VALUE_NULL = "value without content"
VALUES_MISSING = "feed without values list"
FEEDS_MISSING = "twin without feeds list"
TWIN_ID_MISSING = "missing twin id"
HOST_ID_MISSING = "missing host id"
FEED_ID_MISSING = "missing feed id"
TWIN_UNKNOWN = "twin not found"
JSONLD_MALFORMED = "malformed JSON"
JSONLD_UNSUPPORTED = "unsupported JSON-LD"
JSONLD_CYCLIC = "cyclic term in context"
JSONLD_NO_GRAPH = "missing graph"
CHUNKS_INCOMPLETE = "result incomplete: last chunk missing"

EARTH_RADIUS_KM = 6371.0088
