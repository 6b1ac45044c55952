"""Row types: raw events, parsed events and the canonical event."""

from __future__ import annotations

from pyspark.sql.types import LongType, StringType, StructField, StructType


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


INGEST = _strings("format", "source", "payload")
RAW = _strings("event_id", "received_at", "format", "source", "payload")
NETWORK = StructType(
    [
        StructField("src_ip", StringType()),
        StructField("src_port", LongType()),
        StructField("dst_ip", StringType()),
        StructField("dst_port", LongType()),
        StructField("protocol", StringType()),
    ]
)
SOURCE = _strings("type", "vendor", "product", "identifier")
EVENT = _strings("category", "action", "severity")
USER = _strings("username")
PARSED = StructType(
    [
        StructField("timestamp", StringType()),
        StructField("source", SOURCE),
        StructField("event", EVENT),
        StructField("network", NETWORK),
        StructField("user", USER),
    ]
)
UNIVERSAL = StructType(
    [
        StructField("event_id", StringType()),
        StructField("schema_version", StringType()),
        *PARSED.fields,
        StructField("raw", _strings("format", "message")),
        StructField("metadata", _strings("parser_version", "ingested_at")),
    ]
)
