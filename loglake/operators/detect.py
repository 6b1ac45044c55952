"""Format detection: ordered rules, the first that holds decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake.functions.records import csv_rows, fixed, json_value, lower_keys, same_width
from loglake.functions.text import trim

# Known formats, recognised CSV headers, syslog marks.
FORMATS = ("syslog", "json", "csv")
HEADERS = ("timestamp", "time", "action", "act", "protocol", "proto", "src_ip", "dst_ip", "src_port", "dst_port", "source", "severity", "ip")
SYSLOG_TIME = r"\A(?:<[0-9]+>)?(?:[A-Z][a-z]{2}[\t\n\f\r ]+[0-9]+[\t\n\f\r ]+[0-9]{2}:[0-9]{2}:[0-9]{2}|[0-9]{4}-[0-9]{2}-[0-9]{2}[T\t\n\f\r ][0-9]{2}:[0-9]{2}:[0-9]{2})"
SYSLOG_PAIR = r"(?i)(?<![0-9A-Za-z_])(?:SRC|DST|SPT|DPT|PROTO|ACTION)="


def prepare(df: DataFrame) -> DataFrame:
    """Adds what detection and the parsers share, made once: __hint, __trim, __json (variant), __rows (CSV)."""
    df = fixed(df, {"__hint": F.lower(trim(F.coalesce("format", F.lit("")))), "__trim": trim(F.coalesce("payload", F.lit("")))})
    t, open_ = F.col("__trim"), ~F.col("__hint").isin(*FORMATS)
    braces = (t.startswith("{") & t.endswith("}")) | (t.startswith("[") & t.endswith("]"))
    df = fixed(df, {"__json": F.when((F.col("__hint") == "json") | (open_ & braces), json_value(lower_keys(t)))})
    return fixed(df, {"__rows": F.when((F.col("__hint") == "csv") | (open_ & F.col("__json").isNull() & t.contains(",")), csv_rows(t))})


def detection() -> Column:
    """struct(format, source_type, confidence, reason) over prepared columns."""
    t, rows = F.col("__trim"), F.col("__rows")
    made = lambda fmt, kind, sure, why: F.struct(fmt.alias("format"), F.lit(kind).alias("source_type"), F.lit(sure).alias("confidence"), why.alias("reason"))
    header = F.transform(rows[0], lambda x: F.lower(trim(x)))
    csv = (F.size(rows) >= 2) & same_width(rows) & (F.size(rows[0]) >= 2) & F.arrays_overlap(header, F.array(*map(F.lit, HEADERS)))
    hint = F.col("__hint")
    return (
        F.when(hint.isin(*FORMATS), made(hint, "firewall", 1.0, F.concat(F.lit("Format explicitly provided by caller as "), hint)))
        .when(t == "", made(F.lit("unknown"), "unknown", 0.0, F.lit("Payload is empty")))
        .when(F.col("__json").isNotNull(), made(F.lit("json"), "firewall", 0.95, F.lit("Valid JSON structure detected")))
        .when(F.coalesce(csv, F.lit(False)), made(F.lit("csv"), "firewall", 0.9, F.lit("CSV column structure with recognized headers detected")))
        .when(t.rlike(SYSLOG_TIME) | t.rlike(SYSLOG_PAIR), made(F.lit("syslog"), "firewall", 0.85, F.lit("Syslog timestamp or key-value pattern detected")))
        .otherwise(made(F.lit("unknown"), "unknown", 0.0, F.lit("Unable to deterministically match syslog, json, or csv structure")))
    )


def drift(format_: Column, confidence: Column) -> Column:
    """struct(status, confidence, message, suggested_action): whether a parser is known for what was detected."""
    fmt = F.lower(trim(F.coalesce(format_, F.lit(""))))
    unknown = ~fmt.isin(*FORMATS) | (confidence < 0.5)
    made = lambda status, message, action: F.struct(F.lit(status).alias("status"), confidence.alias("confidence"), message.alias("message"), F.lit(action).alias("suggested_action"))
    return F.when(unknown, made("unknown", F.lit("Unrecognized log schema structure; candidate for AI escalation"), "escalate_to_ai")).otherwise(
        made("stable", F.concat(F.lit("Payload matches established "), fmt, F.lit(" parser contract")), "route_to_parser")
    )
