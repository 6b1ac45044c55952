"""The stream: spool -> dedup -> archive -> process -> normalized, quarantine, ledger."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loglake import schemas
from loglake.config import EngineConfig
from loglake.operators.parsers import Registry
from loglake.plans.pipeline import first_deliveries, normalized, process, quarantine, skip_done
from loglake.sources.ingest import stream_spool
from loglake.sources.stores import Stores


def handle(batch: DataFrame, batch_id: int, stores: Stores, cfg: EngineConfig, registry: Registry | None = None) -> None:
    """One micro-batch. It may run again after a crash: every table's partition of the batch is replaced.

    Ids done by other batches are left out before anything is written. Valid and invalid events count as done;
    events that couldn't be parsed don't, so a redelivery is tried again. The processed batch is written once and
    read for each table, so parsing happens once.
    """
    spark = batch.sparkSession
    raw = first_deliveries(batch.select(*schemas.RAW.names).withColumn("arrival", F.monotonically_increasing_id())).drop("arrival")
    since = datetime.fromisoformat(cfg.now) - timedelta(seconds=cfg.done_ttl_s)
    live = stores.ledger(spark, but=batch_id, since=since.isoformat())
    stores.write("work", skip_done(raw, live, cfg), batch_id)
    taken = spark.read.schema(schemas.RAW).parquet(f"{stores.path('work')}/batch_id={batch_id}")
    stores.write("archive", taken, batch_id, "received_at")
    stores.write("processed", process(taken, cfg, registry), batch_id)
    done = spark.read.parquet(f"{stores.path('processed')}/batch_id={batch_id}")
    stores.write("normalized", normalized(done), batch_id)
    stores.write("quarantine", quarantine(done), batch_id)
    stores.mark_done(done.where("status <> 'parse_error'"), batch_id, cfg)
    for name in ("work", "processed"):
        stores.forget(spark, name, batch_id)


def run_stream(spark: SparkSession, spool: str, root: str, cfg: EngineConfig | None = None, registry: Registry | None = None, once: bool = False) -> StreamingQuery:
    """Start the stream; once: process what is there and end. The checkpoint is the record of what was read.

    Settings are those of cfg, or else the session's, with the clock's time for each batch.
    """
    stores = Stores(root)
    step = lambda batch, k: handle(batch, k, stores, cfg or EngineConfig.of(spark), registry)
    writer = stream_spool(spark, spool, cfg or EngineConfig.of(spark)).writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/checkpoint")
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=f"{(cfg or EngineConfig.of(spark)).trigger_s} seconds")
    return writer.start()


def dedup_within(events: DataFrame, time: str = "event_time", delay: str = "24 hours") -> DataFrame:
    """The scalable variant of deduplication, on state that a watermark bounds; failed events aren't retried by it."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(["event_id"])


def counts_by_window(events: DataFrame, time: str = "event_time", width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Tumbling counts by action and severity; works on streams and tables."""
    marked = events.withWatermark(time, delay) if events.isStreaming else events
    return marked.groupBy(F.window(time, width).alias("w"), F.col("event.action").alias("action"), F.col("event.severity").alias("severity")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "action", "severity", "n")


def reprocess(spark: SparkSession, stores: Stores, cfg: EngineConfig, registry: Registry | None = None) -> DataFrame:
    """Quarantined parse errors once more, with the parsers of now."""
    again = stores.read(spark, "quarantine").where("status = 'parse_error'").select(*schemas.RAW.names)
    return process(first_deliveries(again.withColumn("arrival", F.monotonically_increasing_id())).drop("arrival"), cfg, registry)
