"""Schemas of twins and of everything that is exchanged about them (Spark DDL)."""

PROPERTY = "struct<key:string,value:string,type:string,lang:string,dataType:string>"
VALUE = "struct<label:string,dataType:string,comment:string,value:string>"
PORT = (
    f"struct<id:string,properties:array<{PROPERTY}>,storeLast:boolean,values:array<{VALUE}>>"
)
TWIN = (
    f"struct<hostId:string,id:string,properties:array<{PROPERTY}>,"
    f"feeds:array<{PORT}>,inputs:array<{PORT}>>"
)

# A property as a union: exactly one of the four members is set.
PROPERTY_UNION = (
    "struct<key:string,"
    "literalValue:struct<value:string,dataType:string>,"
    "langLiteralValue:struct<value:string,lang:string>,"
    "uriValue:struct<value:string>,"
    "stringLiteralValue:struct<value:string>>"
)

# A wanted property of a search request, as written in the request.
PROPERTY_SPEC = (
    "struct<key:string,uri:string,literal:string,dataType:string,"
    "langLiteral:string,lang:string,stringLiteral:string>"
)

# Numbers stay text until checked: documents hold both 2 and "2".
LOCATION = "struct<lat:string,lon:string,r:string>"
SEARCH_REQUEST = (
    f"struct<expiryTimeout:string,text:string,properties:array<{PROPERTY_SPEC}>,"
    f"location:{LOCATION},scope:string,responseType:string>"
)

SHARE = (
    "follower_twin_id string, host_id string, twin_id string, feed_id string, "
    "mime_type string, occurred_at timestamp, payload binary"
)

BINDINGS = (
    "struct<head:struct<vars:array<string>>,results:struct<bindings:array<"
    "map<string,struct<type:string,datatype:string,value:string>>>>>"
)
