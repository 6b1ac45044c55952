"""Ingestion: requests become raw events in a spool folder, the stream's source."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loglake import schemas
from loglake.config import EngineConfig

# Answers to rejected requests.
EMPTY_PAYLOAD = "payload must not be empty"
EMPTY_BATCH = "batch must not be empty"


def requests(spark: SparkSession, rows: Iterable[Mapping[str, str | None]]) -> DataFrame:
    return spark.createDataFrame([tuple(r.get(n) for n in schemas.INGEST.names) for r in rows], schemas.INGEST)


def stamped(accepted: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Raw events. Ids are random: write the result before using it twice."""
    return accepted.select(F.concat(F.lit("evt_"), F.uuid()).alias("event_id"), F.lit(cfg.now).alias("received_at"), "format", "source", "payload")


def _empty() -> Column:
    return F.coalesce(F.col("payload") == "", F.lit(True))


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(~_empty())


def rejected(rows: DataFrame) -> DataFrame:
    """Requests with status and message of the refusal."""
    return rows.where(_empty()).select("*", F.lit("bad_request").alias("status"), F.lit(EMPTY_PAYLOAD).alias("message"))


def batch_gate(rows: DataFrame, batch: str = "batch_id", index: str = "idx") -> DataFrame:
    """One row per batch: count, accepted, and the first index with an empty payload, which refuses the whole batch."""
    bad = F.min(F.when(_empty(), F.col(index)))
    out = rows.groupBy(batch).agg(F.count("*").alias("count"), bad.alias("first_bad"))
    message = F.when(F.col("first_bad").isNotNull(), F.format_string("event at index %d: " + EMPTY_PAYLOAD, "first_bad"))
    return out.select(batch, "count", F.col("first_bad").isNull().alias("accepted"), "first_bad", message.alias("message"))


def accepted_batches(rows: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Rows of batches without an empty payload."""
    return rows.withColumn("__bad", F.max(_empty()).over(Window.partitionBy(batch))).where(~F.col("__bad")).drop("__bad")


def publish(raw: DataFrame, spool: str) -> None:
    """Append raw events to the spool as JSON lines; files appear whole, so a batch is published whole or not at all."""
    raw.select(*schemas.RAW.names).write.mode("append").json(spool)


def ingest(spark: SparkSession, rows: Iterable[Mapping[str, str | None]], spool: str, cfg: EngineConfig | None = None) -> DataFrame:
    """Publish a batch of requests; returns its answer: (status, count, event_ids), or a refusal with a message."""
    cfg, rows = cfg or EngineConfig(), list(rows)
    bad = next((k for k, r in enumerate(rows) if not r.get("payload")), None)
    if not rows or bad is not None:
        message = EMPTY_BATCH if not rows else f"event at index {bad}: {EMPTY_PAYLOAD}"
        return spark.createDataFrame([("bad_request", 0, None, message)], "status string, count long, event_ids array<string>, message string")
    made = stamped(requests(spark, rows), cfg).collect()  # one request body: ids are drawn once
    publish(spark.createDataFrame(made, schemas.RAW), spool)
    return spark.createDataFrame([("accepted", len(made), [r["event_id"] for r in made], None)], "status string, count long, event_ids array<string>, message string")


def decode(entries: DataFrame, value: str = "payload") -> DataFrame:
    """Raw events of stream entries whose value is their JSON; undecodable ones have null in event_id and stay visible in _corrupt."""
    parsed = F.from_json(value, schemas.RAW)
    return entries.select(parsed.alias("r"), F.col(value).alias("_v")).select("r.*", F.when(F.col("r.payload").isNull(), F.col("_v")).alias("_corrupt"))


def read_spool(spark: SparkSession, spool: str) -> DataFrame:
    return spark.read.schema(schemas.RAW).json(spool)


def stream_spool(spark: SparkSession, spool: str, cfg: EngineConfig) -> DataFrame:
    """The spool as a stream; undecodable lines come with null in payload and end in quarantine."""
    return spark.readStream.schema(schemas.RAW).option("maxFilesPerTrigger", cfg.max_files_per_trigger).json(spool)
