"""The whole chain from raw events to canonical ones, as one projection: no shuffle, no Python."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loglake import schemas
from loglake.config import EngineConfig
from loglake.functions.records import fixed
from loglake.operators.detect import detection, drift, prepare
from loglake.operators.normalize import universal, validate
from loglake.operators.parsers import Registry, default_registry

STATUSES = ("valid", "invalid", "parse_error")


def spread(df: DataFrame) -> DataFrame:
    """A table in fewer splits than there are cores, dealt over all of them; a large one stays as it is, without a shuffle."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _detected(raw: DataFrame) -> DataFrame:
    # Of equal keys the last counts; without this the session's variants refuse them.
    raw.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    for name in schemas.RAW.names:
        if name not in raw.columns:
            raw = raw.withColumn(name, F.lit(None).cast("string"))
    df = fixed(prepare(raw), {"detection": detection()})
    return df.withColumn("drift", drift(F.col("detection.format"), F.col("detection.confidence")))


def detected(raw: DataFrame) -> DataFrame:
    """raw with detection and drift alone, where nothing is to be parsed."""
    df = _detected(raw)
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def process(raw: DataFrame, cfg: EngineConfig | None = None, registry: Registry | None = None) -> DataFrame:
    """raw with detection, drift, parsed, universal, errors, error_type, error, net_summary and status.

    Errors are columns: a row that can't be parsed has status parse_error, one that violates the contract invalid.
    Missing raw columns are taken as null; columns of other names pass through.
    """
    cfg, registry = cfg or EngineConfig(), registry or default_registry()
    df = fixed(registry.parse(_detected(raw), cfg), {"universal": universal(cfg)})
    df = fixed(df, {"errors": F.when(F.col("universal").isNotNull(), validate(F.col("universal")))})
    invalid = F.size("errors") > 0
    df = df.withColumns(
        {
            "status": F.when(F.col("error_type").isNotNull(), F.lit("parse_error")).when(F.col("universal").isNull(), F.lit("parse_error")).when(invalid, F.lit("invalid")).otherwise(F.lit("valid")),
            "error_type": F.when(F.col("error_type").isNotNull(), F.col("error_type")).when(F.col("universal").isNull(), F.lit("normalization")).when(invalid, F.lit("validation")),
            "net_summary": net_summary(),
        }
    )
    return df.drop(*[c for c in df.columns if c.startswith("__")])


def net_summary():
    """Source and destination in one line, for logs; missing ports are 0."""
    n = F.col("universal.network")
    return F.when(n.isNotNull(), F.format_string("%s:%d -> %s:%d (proto: %s)", F.coalesce(n["src_ip"], F.lit("")), F.coalesce(n["src_port"], F.lit(0).cast("long")), F.coalesce(n["dst_ip"], F.lit("")), F.coalesce(n["dst_port"], F.lit(0).cast("long")), F.coalesce(n["protocol"], F.lit(""))))


def flat(df: DataFrame, *keep: str) -> DataFrame:
    """The canonical event's columns side by side."""
    u = F.col("universal")
    columns = [u["event_id"].alias("event_id"), u["timestamp"].alias("timestamp"), u["source"]["identifier"].alias("identifier"), u["source"]["product"].alias("product"), u["event"]["category"].alias("category"), u["event"]["action"].alias("action"), u["event"]["severity"].alias("severity")]
    columns += [u["network"][n].alias(n) for n in schemas.NETWORK.names] + [u["user"]["username"].alias("username"), u["raw"]["format"].alias("raw_format")]
    return df.select(*columns, *keep)


def normalized(df: DataFrame) -> DataFrame:
    """Valid events with the time as a timestamp (null if it isn't one) for partitioning and windows."""
    at = F.try_to_timestamp(F.col("universal.timestamp"))
    return df.where("status = 'valid'").select("universal.*", at.alias("event_time"), "net_summary")


def quarantine(df: DataFrame) -> DataFrame:
    """All others, with what is needed to look into them and to run them again."""
    return df.where("status <> 'valid'").select(*schemas.RAW.names, "status", "error_type", F.coalesce("error", F.concat_ws("; ", F.transform("errors", lambda e: F.concat_ws(" ", e["field"], e["message"])))).alias("details"), F.col("detection.format").alias("detected_format"), F.col("drift.status").alias("drift_status"))


def accounting(df: DataFrame) -> DataFrame:
    """Events by status and error type: every event is in one line."""
    return df.groupBy("status", F.coalesce("error_type", F.lit("")).alias("error_type")).agg(F.count("*").alias("n"))


def first_deliveries(raw: DataFrame, order: str = "arrival") -> DataFrame:
    """Of rows with one event id, the one that arrived first. Rows without an id stay.

    Ids are hashed over partitions; an id has as many rows as deliveries, and all but one are dropped before the
    shuffle where they meet in a task (the window's limit).
    """
    from pyspark.sql import Window

    # Rows without an id get keys of their own, so that one scan and one shuffle do.
    key = F.when(F.coalesce("event_id", F.lit("")) == "", F.monotonically_increasing_id())
    w = Window.partitionBy("event_id", "__own").orderBy(order)
    return raw.withColumn("__own", key).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n", "__own")


def skip_done(raw: DataFrame, ledger: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Events that weren't processed within the time that ids are remembered. ledger: event_id, done_at (RFC 3339)."""
    since = F.to_timestamp(F.lit(cfg.now)) - F.expr(f"INTERVAL {int(cfg.done_ttl_s)} SECONDS")
    live = ledger.where(F.to_timestamp("done_at") > since).select("event_id")
    return raw.join(live, "event_id", "left_anti")
