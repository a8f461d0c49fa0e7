"""Explicit schemas of the file formats; nothing is inferred."""

NODE = "id bigint, lat double, lon double, tags map<string,string>"
WAY = "id bigint, refs array<bigint>, tags map<string,string>"
RELATION = "id bigint, members array<struct<type:string,ref:bigint,role:string>>, tags map<string,string>"
POINT = "struct<x:double,y:double>"
RINGS = f"array<array<{POINT}>>"

GEOMETRY = "struct<type:string,coordinates:string>"
FEATURE = f"type string, properties map<string,string>, geometry {GEOMETRY}, coordinates string"

PART = "struct<name:string,bytes:bigint,sha256:string>"
SIDE = ("struct<format:string,file:string,url:string,bytes:bigint,sha256:string,entries:bigint,"
        "osm_resolved:bigint,counts:map<string,bigint>,source_md5:string,source:string>")
MAP_SIDE = (f"struct<file:string,url:string,bytes:bigint,sha256:string,parts:array<{PART}>,"
            "addresses:struct<source_md5:string>>")
REGION = ("struct<region_id:int,title:string,graph_version:string,package:string,url:string,bytes:bigint,"
          f"sha256:string,tiles:bigint,engine:string,release:string,parts:array<{PART}>,engine_sha:string,"
          "engine_digest:string,source:struct<md5:string,sha256:string,replication:string>,"
          f"timezones:struct<sha256:string>,frontier:{SIDE},features:{SIDE},bus_lanes:{SIDE},"
          f"map:{MAP_SIDE},search:{MAP_SIDE},portals:array<string>>")
PORTAL_FILE = "struct<versions:array<string>,file:string,url:string,bytes:bigint,sha256:string,rows:bigint>"
MANIFEST = (f"schema int, kind string, tag string, created string, regions map<string,{REGION}>,"
            f"portals map<string,{PORTAL_FILE}>, absent map<string,string>,"
            "world struct<url:string,size:bigint>")
HALF = "struct<url:string,bytes:bigint,sha256:string,dataDate:string>"
INDEX = f"schema int, packages map<string,struct<countries:array<string>,graph:{HALF},basemap:{HALF},index:{HALF}>>"
