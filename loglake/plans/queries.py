"""Registered queries of the engine and their SQL over the same rendered events."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake import schemas
from loglake.functions.text import bsd_time, split_ip_port
from loglake.operators.detect import drift
from loglake.operators.normalize import to_contract_json, validate_json
from loglake.plans.fixtures import CONFIG, oracle, raw_events, redelivered
from loglake.plans.pipeline import accounting, detected, first_deliveries, flat, process, quarantine, skip_done
from loglake.sources.ingest import accepted, batch_gate, decode
from loglake.sources.stores import Stores

Query = Callable[[SparkSession, str], DataFrame]


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process(raw_events(spark, sf_dir), CONFIG)


def _parsed(format_: str, also: str = "true") -> Query:
    """Events that detection gave to a parser which could read them; also: a condition on payload."""
    return lambda s, d: flat(_done(s, d).where((F.col("detection.format") == format_) & F.col("universal").isNotNull() & F.expr(also)))


def ingest_accept(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_events(spark, sf_dir).withColumn("payload", F.when(F.col("id") % 7 == 0, F.lit("")).otherwise(F.col("payload")))
    return accepted(rows).select("event_id", "format", "source", F.length("payload").cast("long").alias("n"))


def ingest_batch_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = raw_events(spark, sf_dir).withColumn("payload", F.when(F.col("id") % 77 == 5, F.lit("")).otherwise(F.col("payload")))
    return batch_gate(rows.select((F.col("id") - F.col("id") % 50).alias("batch_id"), (F.col("id") % 50).alias("idx"), "payload"))


def detect_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detected(raw_events(spark, sf_dir)).select("event_id", "detection.format", "detection.source_type", "detection.confidence", "detection.reason")


def drift_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detected(raw_events(spark, sf_dir)).select("event_id", "drift.status", "drift.confidence", "drift.message", "drift.suggested_action")


def drift_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sure = F.col("id") % 101 / F.lit(100.0)
    got = drift(F.when(F.col("id") % 2 == 0, F.lit(" JSON ")).otherwise(F.lit("xml")), sure)
    return raw_events(spark, sf_dir).select("event_id", got.alias("d")).select("event_id", "d.status", "d.suggested_action")


def split_host_port(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.expr("CASE id % 6 WHEN 0 THEN concat(src, ':', sport) WHEN 1 THEN concat('[::', id % 9, ']:', sport) WHEN 2 THEN '::1' WHEN 3 THEN concat(src, ':') WHEN 4 THEN concat(src, ':x') ELSE src END")
    host, port = split_ip_port(F.col("v"))
    return raw_events(spark, sf_dir).select("event_id", value.alias("v")).select("event_id", host.alias("host"), port.alias("port"))


def syslog_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.expr("CASE id % 4 WHEN 0 THEN bsd WHEN 1 THEN 'Feb 30 10:00:00' WHEN 2 THEN 'Aug  5 10:00:00' ELSE replace(bsd, ' ', '  ') END")
    return raw_events(spark, sf_dir).select("event_id", bsd_time(value, CONFIG.year, CONFIG.now).alias("timestamp"))


def pipeline_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(_done(spark, sf_dir).where("status = 'valid'"))


def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(_done(spark, sf_dir)).select("event_id", "status", "error_type", "detected_format", "drift_status", "payload")


def validation_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _done(spark, sf_dir).select("event_id", F.explode("errors").alias("e")).select("event_id", "e.field", "e.message")


def validate_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's JSON form of every event, some with damage, validated from bytes."""
    text = F.expr("CASE id % 5 WHEN 0 THEN j WHEN 1 THEN replace(j, '\"schema_version\":\"1.0\"', '\"schema_version\":\"2.0\"') WHEN 2 THEN replace(j, '\"raw\":', '\"rew\":') WHEN 3 THEN substring(j, 1, 20) ELSE j END")
    made = _done(spark, sf_dir).where("universal IS NOT NULL").select("event_id", "id", to_contract_json(F.col("universal")).alias("j"))
    found = made.select("event_id", validate_json(text).alias("e"))
    return found.select("event_id", F.size("e").cast("long").alias("n"), F.concat_ws(",", F.array_sort(F.col("e.field"))).alias("fields"))


def severity_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("universal")
    return _done(spark, sf_dir).where("universal IS NOT NULL").groupBy(u["raw"]["format"].alias("format"), u["event"]["action"].alias("action"), u["event"]["severity"].alias("severity")).agg(F.count("*").alias("n"))


def audit_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _done(spark, sf_dir).where("net_summary IS NOT NULL").select("event_id", "net_summary")


def dedup_first_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_deliveries(redelivered(raw_events(spark, sf_dir))).select("event_id", "arrival", "payload")


def skip_done_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_events(spark, sf_dir)
    at = F.when(F.col("id") % 2 == 0, F.lit("2024-05-31T12:00:00Z")).otherwise(F.lit("2024-05-30T12:00:00Z"))
    return skip_done(raw, raw.where("id % 3 = 0").select("event_id", at.alias("done_at")), CONFIG).select("event_id", "payload")


def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.when(F.col("id") % 9 == 4, F.lit("not json")).otherwise(F.to_json(F.struct("event_id", "received_at", "format", "source", "payload")))
    got = decode(raw_events(spark, sf_dir).select(entry.alias("payload")))
    return got.groupBy(F.col("_corrupt").isNotNull().alias("corrupt")).agg(F.count("*").alias("n"), F.sum(F.length("payload")).alias("chars"))


def top_talkers(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("universal")
    hit = _done(spark, sf_dir).where("status = 'valid'").groupBy(u["network"]["src_ip"].alias("src_ip"))
    return hit.agg(F.count("*").alias("n"), F.count(F.when(u["event"]["severity"] == "high", 1)).alias("high")).orderBy(F.desc("n"), "src_ip").limit(20)


def hourly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("universal")
    hour = F.date_format(F.date_trunc("hour", F.try_to_timestamp(u["timestamp"])), "yyyy-MM-dd HH:mm")
    return _done(spark, sf_dir).where("status = 'valid'").groupBy(hour.alias("hour"), u["event"]["action"].alias("action")).agg(F.count("*").alias("n"))


def archive_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw events go to an archive, and one is looked up by its id and the hour of its receipt."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or "/tmp"
    stores, raw = Stores(f"{shared}/loglake-{uuid.uuid4().hex}"), raw_events(spark, sf_dir)
    stores.write("archive", raw.select(*schemas.RAW.names), 0, "received_at")
    at = raw.where("event_id = 'evt_42'").select("received_at").first()
    return stores.archived(spark, "evt_42", at[0] if at else CONFIG.now)


def queries() -> dict[str, Query]:
    return {
        "pipeline_valid": pipeline_valid,
        "accounting": lambda s, d: accounting(_done(s, d)),
        "quarantine": quarantined,
        "ingest_accept": ingest_accept,
        "ingest_batch_gate": ingest_batch_gate,
        "detect_format": detect_format,
        "drift_status": drift_status,
        "drift_boundary": drift_boundary,
        "split_ip_port": split_host_port,
        "syslog_timestamp": syslog_time,
        "parse_syslog": _parsed("syslog"),
        "parse_syslog_kv": _parsed("syslog", "payload LIKE '%ACTION=%'"),
        "parse_json_flat": _parsed("json", "payload NOT LIKE '%\"firewall\"%'"),
        "parse_json_nested": _parsed("json", "payload LIKE '%\"firewall\"%'"),
        "parse_csv": _parsed("csv"),
        "severity_rules": severity_rules,
        "validation_errors": validation_errors,
        "validate_bytes": validate_bytes,
        "audit_line": audit_line,
        "dedup_first_delivery": dedup_first_delivery,
        "skip_done": skip_done_ids,
        "decode_messages": decode_messages,
        "archive_lookup": archive_lookup,
        "top_talkers": top_talkers,
        "hourly_counts": hourly_counts,
    }


def oracle_sql() -> dict[str, str]:
    known = f"""
WITH {oracle()}, d AS (
  SELECT *, CASE WHEN class IN (0, 1, 2) THEN 'syslog' WHEN class IN (3, 4, 8, 9) THEN 'json' WHEN class IN (5, 6) THEN 'csv' ELSE 'unknown' END AS det,
    CASE WHEN class IN (1, 6, 8) THEN 1.0 WHEN class IN (3, 4, 9) THEN 0.95 WHEN class = 5 THEN 0.9 WHEN class IN (0, 2) THEN 0.85 ELSE 0.0 END::DOUBLE AS sure
  FROM raw
), e AS (
  SELECT *, concat('2024', substr(iso, 5)) AS syslog_iso,
    CASE WHEN class IN (0, 1) THEN CASE WHEN act IN ('deny', 'drop') THEN 'deny' ELSE 'allow' END ELSE act END AS action,
    CASE class WHEN 7 THEN 'parse_error' WHEN 8 THEN 'parse_error' WHEN 9 THEN 'invalid' ELSE 'valid' END AS status,
    CASE class WHEN 7 THEN 'parser_selection' WHEN 8 THEN 'parse' WHEN 9 THEN 'validation' END AS error_type
  FROM d
), u AS (
  SELECT id, class, status, event_id, payload, CASE WHEN class IN (0, 1, 2) THEN syslog_iso ELSE iso END AS timestamp,
    CASE WHEN source <> '' THEN source WHEN det = 'syslog' THEN concat('gw', id % 4) ELSE concat(det, '-source') END AS identifier,
    concat(det, '-firewall') AS product, 'network' AS category, action,
    CASE WHEN class = 6 THEN 'low' WHEN det = 'json' AND action IN ('deny', 'drop') THEN 'high' WHEN action = 'deny' THEN 'high' ELSE 'info' END AS severity,
    src AS src_ip, sport::BIGINT AS src_port, dst AS dst_ip, CASE WHEN class = 9 THEN 70000 ELSE dport END::BIGINT AS dst_port,
    CASE WHEN class IN (0, 3, 5, 9) THEN 'TCP' WHEN class = 2 THEN 'ICMP' ELSE 'UDP' END AS protocol,
    CASE WHEN class IN (4, 6) THEN concat('u', user_id) END AS username, det AS raw_format
  FROM e WHERE class NOT IN (7, 8)
)
"""
    flat_ = "SELECT event_id, timestamp, identifier, product, category, action, severity, src_ip, src_port, dst_ip, dst_port, protocol, username, raw_format FROM u WHERE "
    return {
        "pipeline_valid": f"{known} {flat_} status = 'valid'",
        "accounting": f"{known} SELECT status, coalesce(error_type, '') AS error_type, count(*) AS n FROM e GROUP BY ALL",
        "quarantine": f"{known} SELECT event_id, status, error_type, det AS detected_format, CASE WHEN det = 'unknown' THEN 'unknown' ELSE 'stable' END AS drift_status, payload FROM e WHERE status <> 'valid'",
        "ingest_accept": f"{known} SELECT event_id, format, source, length(payload)::BIGINT AS n FROM raw WHERE id % 7 <> 0",
        "ingest_batch_gate": f"""{known} SELECT batch_id, count(*) AS count, min(bad) IS NULL AS accepted, min(bad) AS first_bad,
  CASE WHEN min(bad) IS NOT NULL THEN concat('event at index ', min(bad), ': payload must not be empty') END AS message
  FROM (SELECT id - id % 50 AS batch_id, CASE WHEN id % 77 = 5 THEN id % 50 END AS bad FROM raw) GROUP BY batch_id""",
        "detect_format": f"""{known} SELECT event_id, det AS format, CASE WHEN det = 'unknown' THEN 'unknown' ELSE 'firewall' END AS source_type, sure AS confidence,
  CASE WHEN class IN (1, 6, 8) THEN concat('Format explicitly provided by caller as ', det) WHEN det = 'json' THEN 'Valid JSON structure detected'
    WHEN det = 'csv' THEN 'CSV column structure with recognized headers detected' WHEN det = 'syslog' THEN 'Syslog timestamp or key-value pattern detected'
    ELSE 'Unable to deterministically match syslog, json, or csv structure' END AS reason FROM d""",
        "drift_status": f"""{known} SELECT event_id, CASE WHEN det = 'unknown' THEN 'unknown' ELSE 'stable' END AS status, sure AS confidence,
  CASE WHEN det = 'unknown' THEN 'Unrecognized log schema structure; candidate for AI escalation' ELSE concat('Payload matches established ', det, ' parser contract') END AS message,
  CASE WHEN det = 'unknown' THEN 'escalate_to_ai' ELSE 'route_to_parser' END AS suggested_action FROM d""",
        "drift_boundary": f"{known} SELECT event_id, CASE WHEN id % 2 = 0 AND id % 101 >= 50 THEN 'stable' ELSE 'unknown' END AS status, CASE WHEN id % 2 = 0 AND id % 101 >= 50 THEN 'route_to_parser' ELSE 'escalate_to_ai' END AS suggested_action FROM raw",
        "split_ip_port": f"""{known} SELECT event_id, CASE id % 6 WHEN 0 THEN src WHEN 1 THEN concat('::', id % 9) WHEN 2 THEN '::1' WHEN 3 THEN concat(src, ':') WHEN 4 THEN concat(src, ':x') ELSE src END AS host,
  CASE WHEN id % 6 IN (0, 1) THEN sport END::BIGINT AS port FROM raw""",
        "syslog_timestamp": f"{known} SELECT event_id, CASE WHEN id % 4 IN (0, 3) THEN syslog_iso ELSE '2024-06-01T00:00:00Z' END AS timestamp FROM e",
        "parse_syslog": f"{known} {flat_} raw_format = 'syslog'",
        "parse_syslog_kv": f"{known} {flat_} raw_format = 'syslog' AND payload LIKE '%ACTION=%'",
        "parse_json_flat": f"{known} {flat_} raw_format = 'json' AND payload NOT LIKE '%\"firewall\"%'",
        "parse_json_nested": f"{known} {flat_} raw_format = 'json' AND payload LIKE '%\"firewall\"%'",
        "parse_csv": f"{known} {flat_} raw_format = 'csv'",
        "severity_rules": f"{known} SELECT raw_format AS format, action, severity, count(*) AS n FROM u GROUP BY ALL",
        "validation_errors": f"{known} SELECT event_id, '/network/dst_port' AS field, 'must be from 0 to 65535' AS message FROM u WHERE class = 9",
        "validate_bytes": f"""{known} SELECT event_id, CASE WHEN id % 5 = 3 THEN 1 ELSE (id % 5 IN (1, 2))::INT + (class = 9)::INT END::BIGINT AS n,
  CASE WHEN id % 5 = 3 THEN 'root' ELSE concat_ws(',', CASE WHEN class = 9 THEN '/network/dst_port' END, CASE id % 5 WHEN 1 THEN '/schema_version' WHEN 2 THEN '/raw' END) END AS fields FROM u""",
        "audit_line": f"{known} SELECT event_id, concat(src_ip, ':', src_port, ' -> ', dst_ip, ':', dst_port, ' (proto: ', protocol, ')') AS net_summary FROM u",
        "dedup_first_delivery": f"{known} SELECT event_id, 0 AS arrival, payload FROM raw",
        "skip_done": f"{known} SELECT event_id, payload FROM raw WHERE NOT (id % 3 = 0 AND id % 2 = 0)",
        "decode_messages": f"{known} SELECT id % 9 = 4 AS corrupt, count(*) AS n, CASE WHEN id % 9 = 4 THEN NULL ELSE sum(length(payload)) END::BIGINT AS chars FROM raw GROUP BY id % 9 = 4".replace("CASE WHEN id % 9 = 4 THEN NULL ELSE sum(length(payload)) END", "sum(CASE WHEN id % 9 <> 4 THEN length(payload) END)"),
        "archive_lookup": f"{known} SELECT event_id, received_at, format, source, payload FROM raw WHERE event_id = 'evt_42'",
        "top_talkers": f"{known} SELECT src_ip, count(*) AS n, count(*) FILTER (severity = 'high') AS high FROM u WHERE status = 'valid' GROUP BY src_ip ORDER BY n DESC, src_ip LIMIT 20",
        "hourly_counts": f"{known} SELECT concat(substr(timestamp, 1, 10), ' ', substr(timestamp, 12, 2), ':00') AS hour, action, count(*) AS n FROM u WHERE status = 'valid' GROUP BY ALL",
    }
