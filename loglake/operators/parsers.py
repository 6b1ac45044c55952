"""Parsers: record parsers as column expressions, and their registry.

A parser has a format, may add hidden columns in prepare() (made only for rows of its
format, so nothing is computed twice), and gives two expressions over the raw columns
and these: error() (null if it can parse) and parsed() (a struct of schemas.PARSED).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loglake import schemas
from loglake.config import EngineConfig
from loglake.functions import records as r
from loglake.functions.text import blank_to_null, bsd_time, first_of, integer, last_where, split_ip_port, trim


class Parser(Protocol):
    format: str

    def prepare(self, df: DataFrame, mine: Column) -> DataFrame: ...

    def error(self) -> Column: ...

    def parsed(self, cfg: EngineConfig) -> Column: ...


def event(time: Column, source: dict[str, Column], category: Column, action: Column, severity: Column, network: dict[str, Column], username: Column) -> Column:
    """The struct of a parsed event."""
    pack = lambda x: F.struct(*[c.alias(n) for n, c in x.items()])
    return F.struct(
        time.alias("timestamp"),
        pack(source).alias("source"),
        pack({"category": category, "action": action, "severity": severity}).alias("event"),
        pack(network).alias("network"),
        pack({"username": username}).alias("user"),
    ).cast(schemas.PARSED)


def _source(product: str, identifier: Column) -> dict[str, Column]:
    return {"type": F.lit("firewall"), "vendor": F.lit("generic"), "product": F.lit(product), "identifier": identifier}


def value_of(pairs: Column, name: str) -> Column:
    """v of the last (k, v) of that name."""
    return last_where(pairs, lambda p: p["k"] == name)["v"]


@dataclass(frozen=True)
class SyslogParser:
    format: str = "syslog"

    # The header, pairs, and words that stand for actions and protocols.
    HEADER = r"\A(?:<[0-9]+>)?([A-Z][a-z]{2}[\t\n\f\r ]+[0-9]+[\t\n\f\r ]+[0-9]{2}:[0-9]{2}:[0-9]{2})[\t\n\f\r ]+([^\t\n\f\r ]+)[\t\n\f\r ]+([^\n]*)\z"
    PAIR = r"(?i)(?<![0-9A-Za-z_])([A-Z_]+)=([^\t\n\f\r ]+)"
    DENY = ("DENY", "DROP", "BLOCK")
    ALLOW = ("ALLOW", "ACCEPT", "PERMIT")
    PROTOCOLS = ("TCP", "UDP", "ICMP")
    PAIRS = ("ACTION", "PROTO", "SRC", "SPT", "DST", "DPT")

    def prepare(self, df: DataFrame, mine: Column) -> DataFrame:
        t = F.col("__trim")
        df = r.fixed(df, {"__head": F.when(mine & t.rlike(self.HEADER), F.struct(*[F.regexp_extract(t, self.HEADER, k).alias(n) for k, n in ((1, "time"), (2, "host"), (3, "body"))]))})
        df = r.fixed(df, {"__body": F.when(mine, F.coalesce(F.col("__head.body"), t))})
        pairs = F.arrays_zip(F.transform(F.regexp_extract_all("__body", F.lit(self.PAIR), F.lit(1)), F.upper).alias("k"), F.regexp_extract_all("__body", F.lit(self.PAIR), F.lit(2)).alias("v"))
        tokens = F.transform(F.split("__body", r"(?U)\s+"), F.upper)
        df = r.fixed(df, {"__pairs": pairs.cast("array<struct<k:string,v:string>>"), "__tokens": tokens})
        verb = last_where(F.col("__tokens"), lambda w: w.isin(*self.DENY, *self.ALLOW))
        said = [value_of(F.col("__pairs"), name).alias(name) for name in self.PAIRS]
        return r.fixed(df, {"__said": F.when(mine, F.struct(*said, verb.alias("verb"), last_where(F.col("__tokens"), lambda w: w.isin(*self.PROTOCOLS)).alias("word")))})

    def error(self) -> Column:
        return F.when(F.col("__trim") == "", F.lit("empty syslog payload"))

    def parsed(self, cfg: EngineConfig) -> Column:
        pair = lambda name: F.col(f"__said.{name}")
        verb = pair("verb")
        action = F.coalesce(F.lower(pair("ACTION")), F.when(verb.isin(*self.DENY), F.lit("deny")).when(verb.isNotNull(), F.lit("allow")), F.lit("unknown"))
        protocol = F.coalesce(F.upper(pair("PROTO")), pair("word"), F.lit("unknown"))
        source = F.coalesce("source", F.lit(""))
        (src, sport), (dst, dport) = split_ip_port(pair("SRC")), split_ip_port(pair("DST"))
        network = {
            "src_ip": F.coalesce(src, F.lit("")),
            "src_port": F.coalesce(integer(pair("SPT")), sport),
            "dst_ip": F.coalesce(dst, F.lit("")),
            "dst_port": F.coalesce(integer(pair("DPT")), dport),
            "protocol": protocol,
        }
        time = F.coalesce(F.when(F.col("__head").isNotNull(), bsd_time(F.col("__head.time"), cfg.year, cfg.now)), F.lit(cfg.now))
        identifier = F.coalesce(blank_to_null(source), F.col("__head.host"), F.lit("unknown-host"))
        severity = F.when(action == "deny", F.lit("high")).otherwise(F.lit("info"))
        return event(time, _source("syslog-firewall", identifier), F.lit("network"), action, severity, network, F.lit(None))


@dataclass(frozen=True)
class JsonParser:
    format: str = "json"

    # Fields that must be strings, by the object that holds them ("" is the whole).
    TEXTS = {
        "": "timestamp action protocol category severity src_ip dst_ip source_ip destination_ip".split(),
        "source": "identifier vendor product type".split(),
        "firewall": "action protocol category severity".split(),
        "network": "protocol src_ip dst_ip".split(),
        "network.source": ["ip"],
        "network.destination": ["ip"],
        "user": ["username"],
    }

    # Fields of any type, by the object that holds them.
    OTHERS = {
        "": "source firewall network user src_port dst_port source_port destination_port".split(),
        "network": "source destination src_port dst_port".split(),
        "network.source": ["port"],
        "network.destination": ["port"],
    }

    @staticmethod
    def _at(path: str) -> Column:
        return F.col("__o_" + path.replace(".", "_"))

    @staticmethod
    def _holder(path: str) -> str:
        return path.rpartition(".")[0]

    def prepare(self, df: DataFrame, mine: Column) -> DataFrame:
        """One struct for each object of the payload, read once, with a variant for each field."""
        kind = lambda path: r.variants(self.TEXTS[path] + self.OTHERS.get(path, []))
        df = r.fixed(df, {"__o_": F.when(mine, F.col("__json").try_cast(kind("")))})
        for depth in (0, 1):
            paths = [p for p in self.TEXTS if p and p.count(".") == depth]
            df = r.fixed(df, {"__o_" + p.replace(".", "_"): self._at(self._holder(p))[p.rpartition(".")[2]].try_cast(kind(p)) for p in paths})
        return df

    def error(self) -> Column:
        bad = F.col("__json").isNull() | (F.col("__o_").isNull() & ~F.is_variant_null(F.col("__json")))
        for path, names in self.TEXTS.items():
            if path:
                bad = bad | (self._at(path).isNull() & r.present(self._at(self._holder(path))[path.rpartition(".")[2]]).isNotNull())
            wrong = F.lit(False)
            for n in names:
                wrong = wrong | r.not_text(r.present(self._at(path)[n]))
            bad = bad | (self._at(path).isNotNull() & wrong)
        return F.when(F.col("__trim") == "", F.lit("empty JSON payload")).when(bad, F.lit("failed to unmarshal JSON: syntax or type mismatch"))

    def parsed(self, cfg: EngineConfig) -> Column:
        # Rows that come here have strings or nothing in all of TEXTS.
        text = lambda path, name: blank_to_null(self._at(path)[name].try_cast("string"))
        port = lambda path, name: r.port_of(r.present(self._at(path)[name]))
        action = F.coalesce(F.lower(text("", "action")), F.lower(text("firewall", "action")), F.lit("unknown"))
        protocol = F.coalesce(F.upper(text("network", "protocol")), F.upper(text("", "protocol")), F.upper(text("firewall", "protocol")), F.lit("unknown"))
        given = F.coalesce(text("", "severity"), text("firewall", "severity"))
        severity = F.coalesce(given, F.when(action.isin("deny", "block", "drop"), F.lit("high")), F.lit("info"))
        default = {"type": F.lit("firewall"), "vendor": F.lit("generic"), "product": F.lit("json-firewall"), "identifier": first_of(F.col("source"), F.lit("json-source"))}
        source = {n: F.coalesce(text("source", n), c) for n, c in default.items()}
        side = lambda short, long: {
            f"{short}_ip": F.coalesce(text(f"network.{long}", "ip"), text("network", f"{short}_ip"), text("", f"{short}_ip"), text("", f"{long}_ip"), F.lit("")),
            f"{short}_port": F.coalesce(port(f"network.{long}", "port"), port("network", f"{short}_port"), port("", f"{short}_port"), port("", f"{long}_port")),
        }
        username = self._at("user")["username"].try_cast("string")
        category = F.coalesce(text("", "category"), text("firewall", "category"), F.lit("network"))
        return event(F.coalesce(text("", "timestamp"), F.lit(cfg.now)), source, category, action, severity, {**side("src", "source"), **side("dst", "destination"), "protocol": protocol}, username)


@dataclass(frozen=True)
class CsvParser:
    format: str = "csv"

    # The columns that are read.
    CELLS = "timestamp source category action severity src_ip src_port dst_ip dst_port protocol username".split()

    def prepare(self, df: DataFrame, mine: Column) -> DataFrame:
        rows = F.col("__rows")
        cells = F.zip_with(F.transform(rows[0], lambda x: F.lower(trim(x))), F.transform(F.get(rows, F.lit(1)), trim), lambda k, v: F.struct(k.alias("k"), v.alias("v")))
        df = r.fixed(df, {"__cells": F.when(mine & (F.size(rows) >= 2) & r.same_width(rows), cells)})
        named = [value_of(F.col("__cells"), name).alias(name) for name in self.CELLS]
        return r.fixed(df, {"__cell": F.when(F.col("__cells").isNotNull(), F.struct(*named))})

    def error(self) -> Column:
        rows = F.col("__rows")
        return (
            F.when(F.col("__trim") == "", F.lit("empty CSV payload"))
            .when(rows.isNull() | ~r.same_width(rows), F.lit("invalid CSV format: quotes or number of fields"))
            .when(F.size(rows) < 2, F.lit("CSV must contain at least a header row and one data row"))
        )

    def parsed(self, cfg: EngineConfig) -> Column:
        cell = lambda name: F.col(f"__cell.{name}")
        action = F.coalesce(F.lower(blank_to_null(cell("action"))), F.lit("unknown"))
        protocol = F.coalesce(F.upper(blank_to_null(cell("protocol"))), F.lit("unknown"))
        severity = F.coalesce(blank_to_null(cell("severity")), F.when(action == "deny", F.lit("high")), F.lit("info"))
        network = {"src_ip": F.coalesce(cell("src_ip"), F.lit("")), "src_port": integer(cell("src_port")), "dst_ip": F.coalesce(cell("dst_ip"), F.lit("")), "dst_port": integer(cell("dst_port")), "protocol": protocol}
        identifier = first_of(cell("source"), F.col("source"), F.lit("csv-source"))
        return event(first_of(cell("timestamp"), F.lit(cfg.now)), _source("csv-firewall", identifier), first_of(cell("category"), F.lit("network")), action, severity, network, blank_to_null(cell("username")))


@dataclass(frozen=True)
class FunctionParser:
    """A parser of the user's: an expression over payload and source that gives schemas.PARSED, null where it can't parse.

    It may be an Arrow-backed pandas UDF; built-in parsers never leave the JVM.
    """

    format: str
    build: Callable[[Column, Column], Column]

    def prepare(self, df: DataFrame, mine: Column) -> DataFrame:
        return df.withColumn(f"__u_{self.format}", F.when(mine, self.build(F.col("payload"), F.col("source"))))

    def error(self) -> Column:
        return F.when(F.col(f"__u_{self.format}").isNull(), F.lit("parser gave no event"))

    def parsed(self, cfg: EngineConfig) -> Column:
        return F.col(f"__u_{self.format}").cast(schemas.PARSED)


@dataclass
class Registry:
    """Parsers by format, in lower case without blanks; a later one replaces an earlier one. Read when a plan is built."""

    parsers: dict[str, Parser] = field(default_factory=dict)

    def register(self, parser: Parser | None) -> Registry:
        name = (parser.format if parser is not None else "").strip().lower()
        if name:
            self.parsers[name] = parser
        return self

    def get(self, name: str) -> Parser:
        if not name.strip():
            raise ValueError("format cannot be empty")
        found = self.parsers.get(name.strip().lower())
        if found is None:
            raise KeyError(f"no parser registered for format: {name}")
        return found

    def parse(self, df: DataFrame, cfg: EngineConfig) -> DataFrame:
        """Adds parsed, error_type and error by detection.format alone; each row evaluates only its own parser."""
        fmt = F.lower(trim(F.col("detection.format")))
        for name, p in self.parsers.items():
            df = p.prepare(df, fmt == name)
        none = F.concat(F.lit("parser selection failed: "), F.when(fmt == "", F.lit("format cannot be empty")).otherwise(F.concat(F.lit("no parser registered for format: "), F.col("detection.format"))))
        error = F.when(~fmt.isin(*self.parsers) if self.parsers else F.lit(True), none)
        for name, p in self.parsers.items():
            error = error.when(fmt == name, F.concat(F.lit(f"parsing failed for format {name}: "), p.error()))
        df = r.fixed(df, {"error": error})
        parsed = F.when(F.lit(False), F.lit(None).cast(schemas.PARSED))
        for name, p in self.parsers.items():
            parsed = parsed.when((fmt == name) & F.col("error").isNull(), p.parsed(cfg))
        kind = F.when(F.col("error").startswith("parser selection failed"), F.lit("parser_selection")).when(F.col("error").isNotNull(), F.lit("parse"))
        return r.fixed(df, {"parsed": parsed}).withColumn("error_type", kind)


def default_registry() -> Registry:
    return Registry().register(SyslogParser()).register(JsonParser()).register(CsvParser())
