"""Normalization to the canonical event, its JSON form, and validation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loglake import schemas
from loglake.config import EngineConfig
from loglake.functions.records import json_value, kind, once, present, variants
from loglake.functions.text import blank_to_null, first_of

# Fixed values of the canonical event.
SCHEMA_VERSION = "1.0"
PARSER_VERSION = "1.0"


def universal(cfg: EngineConfig) -> Column:
    """The canonical event over raw columns, detection and parsed; null where parsed is. The payload stays as it came."""
    p = F.col("parsed")
    made = F.struct(
        F.coalesce(blank_to_null(F.col("event_id")), F.concat(F.lit("evt_"), F.uuid())).alias("event_id"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        first_of(p["timestamp"], F.col("received_at"), F.lit(cfg.now)).alias("timestamp"),
        p["source"].alias("source"),
        p["event"].alias("event"),
        p["network"].alias("network"),
        p["user"].alias("user"),
        F.struct(first_of(F.col("detection.format"), F.col("format"), F.lit("unknown")).alias("format"), F.coalesce("payload", F.lit("")).alias("message")).alias("raw"),
        F.struct(F.lit(PARSER_VERSION).alias("parser_version"), F.lit(cfg.now).alias("ingested_at")).alias("metadata"),
    ).cast(schemas.UNIVERSAL)
    return F.when(p.isNotNull(), made)


def to_contract_json(u: Column) -> Column:
    """The canonical event as JSON: empty strings and null ports are left out, a user's null name is written."""
    packed = lambda name, kind: F.struct(*[(u[name][f] if f.endswith("port") else blank_to_null(u[name][f])).alias(f) for f in kind.names])
    made = F.struct(
        *[u[n].alias(n) for n in ("event_id", "schema_version", "timestamp")],
        packed("source", schemas.SOURCE).alias("source"),
        packed("event", schemas.EVENT).alias("event"),
        F.when(u["network"].isNotNull(), packed("network", schemas.NETWORK)).alias("network"),
        # A map's nulls are written, a struct's aren't.
        F.when(u["user"].isNotNull(), F.create_map(F.lit("username"), u["user"]["username"])).alias("user"),
        u["raw"].alias("raw"),
        u["metadata"].alias("metadata"),
    )
    return F.when(u.isNotNull(), F.to_json(made))


def _violations(*rules: tuple[Column, str, str]) -> Column:
    found = [F.when(F.coalesce(broken, F.lit(False)), F.struct(F.lit(where).alias("field"), F.lit(what).alias("message"))) for broken, where, what in rules]
    return F.array_compact(F.array(*found)).cast("array<struct<field:string,message:string>>")


def validate(u: Column) -> Column:
    """Violations of the contract by a canonical event; empty for a valid one."""
    rules = [(u[n].isNull(), f"/{n}", "is required") for n in ("event_id", "schema_version", "timestamp", "source", "event", "raw", "metadata")]
    rules += [(F.length(u["event_id"]) == 0, "/event_id", "must not be empty"), (u["schema_version"] != SCHEMA_VERSION, "/schema_version", f"must be {SCHEMA_VERSION}")]
    rules += [(~u["network"][p].between(0, 65535), f"/network/{p}", "must be from 0 to 65535") for p in ("src_port", "dst_port")]
    rules += [(u[o].isNotNull() & u[o][n].isNull(), f"/{o}/{n}", "is required") for o, n in (("raw", "format"), ("raw", "message"), ("metadata", "parser_version"), ("metadata", "ingested_at"))]
    return _violations(*rules)


#: The contract's fields by the object that holds them.
OBJECTS = {
    "source": schemas.SOURCE.names,
    "event": schemas.EVENT.names,
    "network": schemas.NETWORK.names,
    "user": schemas.USER.names,
    "raw": ["format", "message"],
    "metadata": ["parser_version", "ingested_at"],
}


def validate_json(text: Column) -> Column:
    """Violations of the contract by a canonical event in JSON form, of which nothing is known; extra keys are allowed.

    The text, and each object in it, is read once.
    """
    whole = variants(["event_id", "schema_version", "timestamp", *OBJECTS])
    held = lambda top: F.struct(*[top[o].try_cast(variants(names)).alias(o) for o, names in OBJECTS.items()])
    no_object = _violations((F.lit(True), "/", "must be an object"))
    checked = lambda top: F.when(top.isNull(), no_object).otherwise(once(held(top), lambda inner: _violations(*_json_rules(top, inner))))
    invalid = _violations((F.lit(True), "root", "invalid JSON"))
    return once(json_value(text), lambda root: F.when(root.isNull(), invalid).otherwise(once(root.try_cast(whole), checked)))


def _json_rules(top: Column, held: Column) -> list[tuple[Column, str, str]]:
    """top: a variant for each known key; held: for each of OBJECTS a struct of variants, null if it isn't an object."""
    rules = [(top[n].isNull(), f"/{n}", "is required") for n in ("event_id", "schema_version", "timestamp", "source", "event", "raw", "metadata")]
    rules += [(kind(top[n]) != "STRING", f"/{n}", "must be a string") for n in ("event_id", "schema_version", "timestamp")]
    rules += [(top["event_id"].try_cast("string") == "", "/event_id", "must not be empty"), ((kind(top["schema_version"]) == "STRING") & (top["schema_version"].try_cast("string") != SCHEMA_VERSION), "/schema_version", f"must be {SCHEMA_VERSION}")]
    rules += [(top[o].isNotNull() & held[o].isNull(), f"/{o}", "must be an object") for o in ("source", "event", "raw", "metadata")]
    rules += [(present(top[o]).isNotNull() & held[o].isNull(), f"/{o}", "must be an object or null") for o in ("network", "user")]
    rules += [(~kind(held[o][n]).isin("STRING", "VOID"), f"/{o}/{n}", "must be a string or null") for o in ("source", "event", "network", "user") for n in OBJECTS[o] if not n.endswith("port")]
    for n in ("src_port", "dst_port"):
        port = held["network"][n]
        value = port.try_cast("double")
        number = kind(port).rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)") & (value == F.floor(value))
        rules += [(present(port).isNotNull() & ~F.coalesce(number & value.between(0, 65535), F.lit(False)), f"/network/{n}", "must be an integer from 0 to 65535")]
    rules += [(held[o].isNotNull() & F.coalesce(kind(held[o][n]) != "STRING", F.lit(True)), f"/{o}/{n}", "must be a string") for o in ("raw", "metadata") for n in OBJECTS[o]]
    return rules
