"""Declared schemas, keys and column mappings. Nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, LongType, StringType, StructType

_TYPES = {"string": StringType(), "bigint": LongType(), "int": IntegerType()}


def schema_of(columns: str) -> StructType:
    """``name type, ...`` as a schema; unlike ``fromDDL`` it needs no running session."""
    schema = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        schema = schema.add(name, _TYPES[kind])
    return schema


# --- fixed values: file and table formats -----------------------------------

PAGECOUNTS_RAW = schema_of(
    "project_name string, article_name string, count int, _deprecated string"
)

MEDIACOUNTS_RAW = schema_of(
    "filename string, total_response_bytes bigint, "
    "total_transfers_all int, total_transfers_restricted int, "
    "total_transfers_transcoded_audio int, _rffu_0 string, _rffu_1 string, "
    "total_transfers_transcoded_image int, "
    "total_transfers_transcoded_image_200 int, "
    "total_transfers_transcoded_image_400 int, "
    "total_transfers_transcoded_image_600 int, "
    "total_transfers_transcoded_image_800 int, "
    "total_transfers_transcoded_image_1000 int, "
    "total_transfers_transcoded_image_large int, _rffu_2 string, _rffu_3 string, "
    "total_transfers_transcoded_mov int, total_transfers_transcoded_mov_240 int, "
    "total_transfers_transcoded_mov_480 int, "
    "total_transfers_transcoded_mov_large int, _rffu_4 string, _rffu_5 string, "
    "transfers_from_wmf_domain int, transfers_from_non_wmf_domain int, "
    "transfers_from_invalid_domain int"
)

MEDIA_MEASURES = (
    "total_response_bytes",
    "total_transfers_all",
    "total_transfers_restricted",
    "total_transfers_transcoded_audio",
    "total_transfers_transcoded_image",
    "total_transfers_transcoded_mov",
    "transfers_from_wmf_domain",
    "transfers_from_non_wmf_domain",
    "transfers_from_invalid_domain",
)

PAGECOUNTS_KEY = ("project_name", "article_name", "interval_start_unixtime")
MEDIACOUNTS_KEY = ("date", "filename")

# Longest text the serving tables declare, in characters.
TEXT_LIMITS = {"project_name": 63, "article_name": 255, "filename": 1023}

# --- derived from the values above ------------------------------------------

_media_measures_ddl = ", ".join(
    f"{f.name} {f.dataType.simpleString()}" for f in MEDIACOUNTS_RAW if f.name in MEDIA_MEASURES
)

# Normalised files, as the load jobs write them (`date` is the directory).
PAGECOUNTS_NORMAL = schema_of(
    "project_name string, article_name string, interval_start_unixtime bigint, "
    "count int, date string"
)
MEDIACOUNTS_NORMAL = schema_of(
    f"filename string, _date string, {_media_measures_ddl}, date string"
)

# External tables over those files; `count` is widened to bigint on read.
PAGECOUNTS_EXTERNAL = schema_of(
    "project_name string, article_name string, interval_start_unixtime bigint, "
    "count bigint, date string"
)
MEDIACOUNTS_EXTERNAL = schema_of(
    f"filename string, {_media_measures_ddl}, date string"
)

# Serving tables.
PAGECOUNTS_SERVING = schema_of(
    "project_name string, article_name string, interval_start_unixtime bigint, count int"
)
MEDIACOUNTS_SERVING = schema_of(
    f"filename string, date string, {_media_measures_ddl}"
)

# target column -> source column; a target column left out is loaded as NULL.
PAGECOUNTS_MAPPING = {
    "project_name": "project_name",
    "article_name": "article_name",
    "interval_start_unixtime": "interval_start_unixtime",
    "count": "count",
}
MEDIACOUNTS_MAPPING = {
    "filename": "filename",
    "date": "_date",
    "total_response_bytes": "total_response_bytes",
    "total_transfers_all": "total_transfers_all",
}
MEDIACOUNTS_FULL_MAPPING = {
    "filename": "filename",
    "date": "_date",
    **{m: m for m in MEDIA_MEASURES},
}
