"""Raw events rendered from the events table, the same in Spark and in DuckDB: integers and strings only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake.config import EngineConfig
from loglake.plans.pipeline import spread

CONFIG = EngineConfig(now="2024-06-01T00:00:00Z", reference_year=2024)

_FIELDS = """
  SELECT event_id AS id, event_id % 10 AS class, {iso} AS iso, {bsd} AS bsd, user_id,
    CASE event_type WHEN 'error' THEN 'deny' WHEN 'click' THEN 'drop' WHEN 'signup' THEN 'allow' WHEN 'view' THEN 'accept' ELSE 'permit' END AS act,
    concat('10.', user_id % 250, '.', event_id % 250, '.', event_id % 200 + 1) AS src, 1024 + event_id % 60000 AS sport,
    concat('192.168.', event_id % 16, '.10') AS dst, CASE event_id % 4 WHEN 0 THEN 443 WHEN 1 THEN 80 WHEN 2 THEN 53 ELSE 22 END AS dport
  FROM events
"""
_RAW = """
SELECT id, class, act, src, sport, dst, dport, iso, bsd, user_id, concat('evt_', id) AS event_id, iso AS received_at,
  CASE class WHEN 1 THEN 'Syslog' WHEN 6 THEN 'csv' WHEN 8 THEN 'json' ELSE '' END AS format,
  CASE WHEN id % 3 = 0 THEN '' ELSE concat('fw-', user_id % 8) END AS source,
  CASE class
    WHEN 0 THEN concat(bsd, ' gw', id % 4, ' ', upper(act), ' TCP SRC=', src, ':', sport, ' DST=', dst, ':', dport)
    WHEN 1 THEN concat('<134>', bsd, ' gw', id % 4, ' ', upper(act), ' UDP SRC=', src, ' SPT=', sport, ' DST=', dst, ' DPT=', dport)
    WHEN 2 THEN concat(bsd, ' gw', id % 4, ' ACTION=', act, ' PROTO=icmp SRC=', src, ':', sport, ' DST=', dst, ':', dport)
    WHEN 3 THEN concat('{{"timestamp":"', iso, '","action":"', act, '","protocol":"tcp","src_ip":"', src, '","src_port":', sport, ',"dst_ip":"', dst, '","dst_port":', dport, '}}')
    WHEN 4 THEN concat('{{"timestamp":"', iso, '","firewall":{{"action":"', act, '","protocol":"udp"}},"network":{{"source":{{"ip":"', src, '","port":"', sport, '"}},"destination":{{"ip":"', dst, '","port":"', dport, '"}}}},"user":{{"username":"u', user_id, '"}}}}')
    WHEN 5 THEN concat('timestamp,action,protocol,src_ip,src_port,dst_ip,dst_port', {nl}, iso, ',', act, ',tcp,', src, ',', sport, ',', dst, ',', dport)
    WHEN 6 THEN concat('"dst_port","dst_ip","src_port","src_ip","severity","username","action","protocol","timestamp"', {nl}, '"', dport, '","', dst, '","', sport, '","', src, '","low","u', user_id, '","', act, '","udp","', iso, '"')
    WHEN 7 THEN concat('service heartbeat number ', id, ' is fine')
    WHEN 8 THEN concat('{{"action":"', act, '","src_ip":')
    ELSE concat('{{"timestamp":"', iso, '","action":"', act, '","protocol":"tcp","src_ip":"', src, '","src_port":', sport, ',"dst_ip":"', dst, '","dst_port":70000}}')
  END AS payload
FROM fields
"""


def _sql(iso: str, bsd: str, nl: str) -> tuple[str, str]:
    return _FIELDS.format(iso=iso, bsd=bsd), _RAW.format(nl=nl)


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events with the values they were made from."""
    stamp = "date_format(cast(ts AS timestamp_ntz), {})".format
    fields, raw = _sql(stamp("\"yyyy-MM-dd'T'HH:mm:ss'Z'\""), stamp("'MMM dd HH:mm:ss'"), "'\\n'")
    events = spread(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return spark.sql(_bound(fields, raw), events=events)


def _bound(fields: str, raw: str) -> str:
    # spark.sql() formats its text, so braces of the payloads are doubled again.
    return "WITH fields AS (" + fields.replace("FROM events", "FROM {events}") + ") " + raw.replace("{", "{{").replace("}", "}}")


def oracle() -> str:
    """The same as a DuckDB common table expression named raw."""
    fields, raw = _sql("strftime(ts, '%Y-%m-%dT%H:%M:%SZ')", "strftime(ts, '%b %d %H:%M:%S')", "chr(10)")
    return f"fields AS ({fields}), raw AS ({raw})"


def redelivered(raw: DataFrame) -> DataFrame:
    """Every event once, and those of the first three classes a second time, later."""
    return raw.withColumn("arrival", F.lit(0)).unionByName(raw.where("class < 3").withColumn("arrival", F.lit(1)))
