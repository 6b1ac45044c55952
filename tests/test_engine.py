"""Detection, parsers, normalization and validation, each table in one DataFrame."""

import json

import pytest
from pyspark.sql import functions as F

from loglake import schemas
from loglake.config import EngineConfig
from loglake.functions.records import csv_rows
from loglake.functions.text import integer, split_ip_port, trim
from loglake.operators.detect import drift
from loglake.operators.normalize import to_contract_json, validate, validate_json
from loglake.operators.parsers import FunctionParser, Registry, default_registry
from loglake.plans.pipeline import STATUSES, accounting, flat, normalized, process, quarantine

CFG = EngineConfig(now="2026-09-01T00:00:00Z", reference_year=2026)
LINE = "Jul 14 07:21:45 gate-7 DENY TCP SRC=172.16.4.9:40111 DST=10.8.3.77:443"
CSV = "timestamp,action,protocol,src_ip,src_port,dst_ip,dst_port\n2026-07-14T07:21:45Z,deny,TCP,172.16.4.9,40111,10.8.3.77,443"
NESTED = '{"timestamp":"2026-07-14T07:21:45Z","firewall":{"action":"deny","protocol":"TCP"},"network":{"source":{"ip":"172.16.4.9","port":40111},"destination":{"ip":"10.8.3.77","port":443}}}'


def run(spark, rows, cfg=CFG, registry=None):
    """rows: (payload, hint, source); results in their order."""
    data = [(f"evt_{k}", "2026-08-31T00:00:00Z", h, s, p, k) for k, (p, h, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id string, received_at string, format string, source string, payload string, k int")
    return process(df, cfg, registry).orderBy("k").collect()


DETECT = [
    (LINE, "syslog", "syslog", 1.0),
    ("junk", "  SYSLOG  ", "syslog", 1.0),
    ("junk", "JSON", "json", 1.0),
    ("junk", "  Csv  ", "csv", 1.0),
    ("some text", "xml", "unknown", 0.0),
    ('{"a":1}', "xml", "json", 0.95),
    ('  {"a": 1}\n', "", "json", 0.95),
    ("[1, 2]", None, "json", 0.95),
    ('{"a":1} x', "", "unknown", 0.0),
    ('{"a":1}{"b":2}', "", "unknown", 0.0),
    ("{not json}", "", "unknown", 0.0),
    (CSV, "", "csv", 0.9),
    ("name,age\nbob,7", "", "unknown", 0.0),
    ("time,action", "", "unknown", 0.0),
    ("Hello, world, this is prose.\nAnd more, of it.", "", "unknown", 0.0),
    ("Traceback, most recent:\n File a, line 1, in x", "", "unknown", 0.0),
    (LINE, "", "syslog", 0.85),
    ("<134>" + LINE, "", "syslog", 0.85),
    ("2026-07-14T07:21:45 host up", "", "syslog", 0.85),
    ("anything src=1.2.3.4", "", "syslog", 0.85),
    ("XSRC=1", "", "unknown", 0.0),
    ("", "", "unknown", 0.0),
    ("  \t\n ", "", "unknown", 0.0),
    (None, None, "unknown", 0.0),
    ("plain text", "", "unknown", 0.0),
    ("<event><a/></event>", "", "unknown", 0.0),
]


def test_detection(spark):
    got = run(spark, [(p, h, "") for p, h, _, _ in DETECT])
    assert [(r.detection.format, r.detection.confidence) for r in got] == [(f, c) for _, _, f, c in DETECT]
    assert got[0].detection.reason == "Format explicitly provided by caller as syslog"
    assert got[21].detection.reason == "Payload is empty"
    assert all(r.detection.source_type == ("unknown" if r.detection.format == "unknown" else "firewall") for r in got)


@pytest.mark.parametrize(
    "fmt, sure, status",
    [("json", 0.49, "unknown"), ("json", 0.4999, "unknown"), ("json", 0.5, "stable"), ("csv", 0.51, "stable"), ("unknown", 0.9, "unknown"), ("", 1.0, "unknown"), ("  ", 1.0, "unknown"), ("xml", 0.95, "unknown"), ("  JSON  ", 0.85, "stable"), ("syslog", 1.0, "stable")],
)
def test_drift(spark, fmt, sure, status):
    d = spark.range(1).select(drift(F.lit(fmt), F.lit(sure)).alias("d")).first().d
    assert (d.status, d.confidence) == (status, sure)
    assert d.suggested_action == {"stable": "route_to_parser", "unknown": "escalate_to_ai"}[status]
    if status == "stable":
        assert d.message == f"Payload matches established {fmt.strip().lower()} parser contract"


HEAD = "Jul 14 07:21:45 fw "
SYSLOG = [
    # payload, source, action, severity, protocol, src, dst, identifier
    (LINE, "", "deny", "high", "TCP", ("172.16.4.9", 40111), ("10.8.3.77", 443), "gate-7"),
    (HEAD + "DENY TCP SRC=172.16.4.9 SPT=40111 DST=10.8.3.77 DPT=443", "", "deny", "high", "TCP", ("172.16.4.9", 40111), ("10.8.3.77", 443), "fw"),
    (HEAD + "ACTION=DENY PROTO=TCP SRC=1.1.1.1 DST=2.2.2.2", "edge", "deny", "high", "TCP", ("1.1.1.1", None), ("2.2.2.2", None), "edge"),
    (HEAD + "ACTION=DROP PROTO=udp SRC=1.1.1.1:1 SPT=x", "", "drop", "info", "UDP", ("1.1.1.1", 1), ("", None), "fw"),
    (HEAD + "ALLOW UDP SRC=10.9.1.4:1234 DST=10.9.1.2:53", "", "allow", "info", "UDP", ("10.9.1.4", 1234), ("10.9.1.2", 53), "fw"),
    (HEAD + "deny tcp src=1.1.1.1:2 dst=3.3.3.3:4", "", "deny", "high", "TCP", ("1.1.1.1", 2), ("3.3.3.3", 4), "fw"),
    (HEAD + "ALLOW then BLOCK ICMP TCP", "", "deny", "high", "TCP", ("", None), ("", None), "fw"),
    (HEAD + "PERMIT SRC=[::1]:80 DST=::1", "", "allow", "info", "unknown", ("::1", 80), ("::1", None), "fw"),
    (HEAD + "SRC=1.1.1.1: DST=h:x", "", "unknown", "info", "unknown", ("1.1.1.1:", None), ("h:x", None), "fw"),
    (HEAD + "SRC=1.1.1.1 SRC=2.2.2.2", "", "unknown", "info", "unknown", ("2.2.2.2", None), ("", None), "fw"),
    ("no header SRC=1.1.1.1", "core-sw-3", "unknown", "info", "unknown", ("1.1.1.1", None), ("", None), "core-sw-3"),
    ("no header SRC=1.1.1.1", "", "unknown", "info", "unknown", ("1.1.1.1", None), ("", None), "unknown-host"),
    (LINE + "\nSRC=9.9.9.9", "", "deny", "high", "TCP", ("9.9.9.9", None), ("10.8.3.77", 443), "unknown-host"),
    ("<134>" + LINE, "", "deny", "high", "TCP", ("172.16.4.9", 40111), ("10.8.3.77", 443), "gate-7"),
]


def test_syslog(spark):
    got = run(spark, [(p, "syslog", s) for p, s, *_ in SYSLOG])
    for r, (_, _, action, severity, protocol, src, dst, identifier) in zip(got, SYSLOG, strict=True):
        e = r.parsed
        assert (e.event.action, e.event.severity, e.network.protocol, e.source.identifier) == (action, severity, protocol, identifier), r.payload
        assert ((e.network.src_ip, e.network.src_port), (e.network.dst_ip, e.network.dst_port)) == (src, dst), r.payload
        assert (e.source.product, e.user.username, e.event.category) == ("syslog-firewall", None, "network")
    assert got[0].parsed.timestamp == "2026-07-14T07:21:45Z"
    bad = run(spark, [(p, "syslog", "") for p in ("", "  ", "Jul  5 07:21:45 fw x", "Feb 30 07:21:45 fw x", "Jul   14 07:21:45 fw x")])
    assert [r.error for r in bad[:2]] == ["parsing failed for format syslog: empty syslog payload"] * 2
    assert [r.parsed.timestamp for r in bad[2:]] == [CFG.now, CFG.now, "2026-07-14T07:21:45Z"]


def flat_json(**more):
    return json.dumps({"timestamp": "t", "action": "block", "protocol": "tcp", "src_ip": "1.1.1.1", "src_port": 1, "dst_ip": "2.2.2.2", "dst_port": 2, **more})


def test_json(spark):
    rows = [
        (flat_json(), "json", "fw-east"),
        (NESTED, "json", ""),
        (flat_json(src_port="40111", dst_port="invalid"), "json", ""),
        (flat_json(src_port="", dst_port=443.0), "json", ""),
        (flat_json(src_port=True, dst_port=None), "json", ""),
        ('{"source_ip":"a","source_port":1,"destination_ip":"b","destination_port":" 2 "}', "json", ""),
        ('{"ACTION":"Allow","Firewall":{"severity":"low"},"source":{"vendor":"v","identifier":"i"},"user":{"username":"bob"}}', "json", "x"),
        ('{"network":{"protocol":"udp","src_ip":"n","source":{"ip":"deep","port":7}},"protocol":"tcp","src_ip":"top"}', "json", ""),
        ('{"action":"drop","severity":"low"}', "json", ""),
        ("null", "json", ""),
        ('{"action":null,"network":null,"user":{"username":null}}', "json", ""),
    ]
    e = [r.parsed for r in run(spark, rows)]
    assert (e[0].event.action, e[0].event.severity, e[0].source.identifier, e[0].network.protocol) == ("block", "high", "fw-east", "TCP")
    assert (e[1].event.action, e[1].event.severity, e[1].source.identifier, e[1].network.src_port, e[1].network.dst_ip) == ("deny", "high", "json-source", 40111, "10.8.3.77")
    assert [(x.network.src_port, x.network.dst_port) for x in e[2:5]] == [(40111, None), (None, 443), (None, None)]
    assert (e[5].network.src_ip, e[5].network.src_port, e[5].network.dst_ip, e[5].network.dst_port) == ("a", 1, "b", 2)
    assert (e[6].event.action, e[6].event.severity, e[6].source.vendor, e[6].source.identifier, e[6].user.username) == ("allow", "low", "v", "i", "bob")
    assert (e[7].network.protocol, e[7].network.src_ip, e[7].network.src_port) == ("UDP", "deep", 7)
    assert e[8].event.severity == "low"
    assert e[9].timestamp == CFG.now and e[9].event.action == "unknown"
    assert e[10].event.action == "unknown" and e[10].user.username is None
    bad = run(spark, [(p, "json", "") for p in ("", "  ", '{"a":', '[{"a":1', "plain", '{"action":5}', '{"source":"fw"}', "[]", '{"network":{"source":3}}', '{"user":{"username":4}}')])
    assert all(r.status == "parse_error" and r.error_type == "parse" and r.parsed is None for r in bad)
    severities = run(spark, [(flat_json(action=a), "json", "") for a in ("deny", "BLOCK", "Drop", "allow", "permit", "accept")])
    assert [r.parsed.event.severity for r in severities] == ["high"] * 3 + ["info"] * 3


def test_csv(spark):
    rows = [
        (CSV, "csv", "fw-west"),
        ("dst_port,action,src_ip\n443,allow,1.1.1.1", "csv", ""),
        (" Action , PROTOCOL ,Src_IP\n allow , udp , 1.1.1.1 ", "csv", ""),
        ('"action","src_ip"\r\n"de""ny","1.1,1.1"\r\n', "csv", ""),
        ("action,src_port,dst_port\ndeny,not_a_port,", "csv", ""),
        ("action,src_ip\nallow,first\ndeny,second", "csv", ""),
        ("source,category,severity,username,action\npf-lab,network_security,critical,ops_anna,drop", "csv", "x"),
        ("action,action\nallow,drop", "csv", ""),
    ]
    e = [r.parsed for r in run(spark, rows)]
    assert (e[0].event.action, e[0].event.severity, e[0].network.protocol, e[0].network.src_port, e[0].network.dst_port, e[0].source.identifier) == ("deny", "high", "TCP", 40111, 443, "fw-west")
    assert (e[1].network.dst_port, e[1].network.src_ip, e[1].timestamp, e[1].source.identifier) == (443, "1.1.1.1", CFG.now, "csv-source")
    assert (e[2].event.action, e[2].network.protocol, e[2].network.src_ip) == ("allow", "UDP", "1.1.1.1")
    assert (e[3].event.action, e[3].network.src_ip) == ('de"ny', "1.1,1.1")
    assert (e[4].network.src_port, e[4].network.dst_port) == (None, None)
    assert e[5].network.src_ip == "first"
    assert (e[6].source.identifier, e[6].event.category, e[6].event.severity, e[6].user.username) == ("pf-lab", "network_security", "critical", "ops_anna")
    assert (e[7].event.action, e[7].event.severity) == ("drop", "info")
    bad = run(spark, [(p, "csv", "") for p in ("", " ", "action,src_ip", "action,src_ip\ndeny", 'action,src_ip\n"deny,1', 'action\nde"ny')])
    assert all(r.error_type == "parse" for r in bad)


def test_rows_and_scalars(spark):
    df = spark.createDataFrame([('a, "b\nc",d\n\n1,2,3\n',)], "p string")
    assert df.select(csv_rows(F.col("p")).alias("r")).first().r == [["a", "b\nc", "d"], ["1", "2", "3"]]
    values = spark.createDataFrame([(" 7",), ("+7",), ("99999999999999999999",), ("x",)], "v string")
    assert [r[0] for r in values.select(integer(F.col("v"))).collect()] == [None, 7, None, None]
    assert spark.range(1).select(trim(F.lit("   x\t　"))).first()[0] == "x"
    host, port = split_ip_port(F.col("v"))
    hosts = spark.createDataFrame([("1.2.3.4:80",), ("[::1]:80",), ("::1",), ("a:b:1",), ("1.2.3.4:",), ("h:x",), ("[::1]",), (":80",)], "v string")
    assert [tuple(r) for r in hosts.select(host, port).collect()] == [("1.2.3.4", 80), ("::1", 80), ("::1", None), ("a:b:1", None), ("1.2.3.4:", None), ("h:x", None), ("[::1]", None), ("", 80)]


def test_registry(spark):
    r = default_registry()
    assert r.get("  JSON ").format == "json"
    with pytest.raises(KeyError):
        r.get("xml")
    with pytest.raises(ValueError):
        r.get(" ")
    Registry().register(None).register(FunctionParser(" ", lambda p, s: p))
    event = F.struct(F.lit("t").alias("timestamp"), *[F.lit(None).cast(schemas.PARSED[n].dataType).alias(n) for n in ("source", "event", "network", "user")])
    got = run(spark, [("anything", "csv", "")], registry=default_registry().register(FunctionParser("CSV", lambda p, s: F.when(p == "anything", event))))
    assert got[0].parsed.timestamp == "t" and got[0].status == "invalid"
    none = run(spark, [(LINE, "", ""), ("what", "", "")], registry=Registry())
    assert [x.error for x in none] == ["parser selection failed: no parser registered for format: syslog", "parser selection failed: no parser registered for format: unknown"]


def test_three_formats_converge(spark):
    got = [flat_ for flat_ in flat(spark.createDataFrame([("e1", "r", f, "fw-west", p) for f, p in (("syslog", LINE), ("json", NESTED), ("csv", CSV))], schemas.RAW).transform(lambda d: process(d, CFG))).collect()]
    keys = ("identifier", "action", "severity", "protocol", "src_ip", "src_port", "dst_ip", "dst_port", "category", "timestamp")
    assert len({tuple(r[k] for k in keys) for r in got}) == 1
    assert got[0].identifier == "fw-west" and got[0].timestamp == "2026-07-14T07:21:45Z"


@pytest.mark.parametrize("payload", ["a\tb  c ", " x\n", "CEF:0|v|p|1|2|n|5|src=1.1.1.1", "<a>é</a>"])
def test_message_is_untouched(spark, payload):
    r = run(spark, [(payload, "syslog", "s")])[0]
    assert r.universal.raw.message == payload and r.universal.raw.format == "syslog"
    assert r.universal.metadata.ingested_at == CFG.now and r.universal.schema_version == "1.0"


def test_generated_id(spark):
    df = spark.createDataFrame([("", "r", "syslog", "", LINE)], schemas.RAW)
    assert process(df, CFG).first().universal.event_id.startswith("evt_")


def test_validation(spark):
    rows = [("SRC=1.1.1.1 SPT=%s" % p, "syslog", "") for p in ("0", "65535", "65536", "-1", "70000")]
    got = run(spark, rows)
    assert [r.status for r in got] == ["valid", "valid", "invalid", "invalid", "invalid"]
    assert got[2].errors[0].field == "/network/src_port" and got[2].error_type == "validation"


def test_typed_validation_of_missing_parts(spark):
    df = process(spark.createDataFrame([("e", "r", "syslog", "", LINE)], schemas.RAW), CFG)
    damaged = df.select(
        validate(F.col("universal").withField("event_id", F.lit(""))).alias("a"),
        validate(F.col("universal").withField("schema_version", F.lit("2.0"))).alias("b"),
        *[validate(F.col("universal").withField(n, F.lit(None).cast(schemas.UNIVERSAL[n].dataType))).alias(n) for n in ("timestamp", "source", "event", "raw", "metadata")],
        validate(F.col("universal").withField("network", F.lit(None).cast(schemas.NETWORK)).withField("user", F.lit(None).cast(schemas.USER))).alias("ok"),
    ).first()
    assert [x.field for x in damaged.a] == ["/event_id"] and [x.field for x in damaged.b] == ["/schema_version"]
    assert all([x.field for x in damaged[n]] == [f"/{n}"] for n in ("timestamp", "source", "event", "raw", "metadata"))
    assert damaged.ok == []


GOOD = {"event_id": "e", "schema_version": "1.0", "timestamp": "", "source": {}, "event": {"action": None}, "network": None, "raw": {"format": "f", "message": ""}, "metadata": {"parser_version": "1", "ingested_at": "t"}, "extra": 1}
BYTES = [
    (GOOD, []),
    ({**GOOD, "network": {"src_port": 443.0, "dst_port": None}, "user": {"username": None}}, []),
    ({k: v for k, v in GOOD.items() if k != "event_id"}, ["/event_id"]),
    ({**GOOD, "event_id": ""}, ["/event_id"]),
    ({**GOOD, "event_id": 5}, ["/event_id"]),
    ({**GOOD, "schema_version": ""}, ["/schema_version"]),
    ({**GOOD, "schema_version": "2.0"}, ["/schema_version"]),
    ({**GOOD, "source": []}, ["/source"]),
    ({**GOOD, "source": {"vendor": 1}}, ["/source/vendor"]),
    ({**GOOD, "network": "x"}, ["/network"]),
    ({**GOOD, "network": {"src_port": -1}}, ["/network/src_port"]),
    ({**GOOD, "network": {"dst_port": 70000}}, ["/network/dst_port"]),
    ({**GOOD, "network": {"dst_port": "443"}}, ["/network/dst_port"]),
    ({**GOOD, "network": {"dst_port": 1.5}}, ["/network/dst_port"]),
    ({**GOOD, "raw": {"format": "f"}}, ["/raw/message"]),
    ({**GOOD, "raw": {"message": "m"}}, ["/raw/format"]),
    ({**GOOD, "metadata": {"parser_version": "1"}}, ["/metadata/ingested_at"]),
]


def test_validation_of_bytes(spark):
    rows = [(k, json.dumps(v)) for k, (v, _) in enumerate(BYTES)] + [(100, "{"), (101, '{"a":1} x'), (102, "[]"), (103, "5")]
    df = spark.createDataFrame(rows, "k int, t string")
    got = {r.k: [e.field for e in r.e] for r in df.select("k", validate_json(F.col("t")).alias("e")).collect()}
    assert [got[k] for k in range(len(BYTES))] == [e for _, e in BYTES]
    assert got[100] == ["root"] and got[101] == ["root"] and got[102] == ["/"] and got[103] == ["/"]


def test_contract_json(spark):
    df = process(spark.createDataFrame([("e", "r", "syslog", "", "DENY SRC=1.1.1.1")], schemas.RAW), CFG)
    text = df.select(to_contract_json(F.col("universal")).alias("j"), validate_json(to_contract_json(F.col("universal"))).alias("e")).first()
    made = json.loads(text.j)
    assert text.e == [] and made["network"] == {"src_ip": "1.1.1.1", "protocol": "unknown"} and made["user"] == {"username": None}


def test_contract_json_of_missing_parts(spark):
    df = process(spark.createDataFrame([("e", "r", "syslog", "", "DENY")], schemas.RAW), CFG)
    damaged = F.col("universal").withField("timestamp", F.lit(None).cast("string")).withField("network", F.lit(None).cast(schemas.NETWORK)).withField("metadata", F.lit(None).cast(schemas.UNIVERSAL["metadata"].dataType))
    row = df.select(to_contract_json(damaged).alias("j"), validate_json(to_contract_json(damaged)).alias("e")).first()
    assert list(json.loads(row.j)) == ["event_id", "schema_version", "source", "event", "user", "raw"]
    assert [e.field for e in row.e] == ["/timestamp", "/metadata"]


def test_bytes_are_read_and_written_once(spark):
    df = process(spark.createDataFrame([("e", "r", "syslog", "", LINE)], schemas.RAW), CFG).select("universal")
    written = df.select(to_contract_json(F.col("universal")).alias("j"))
    assert written._jdf.queryExecution().analyzed().toString().split("\n")[0].count("to_json(") == 1
    plan = spark.createDataFrame([("{}",)], "t string").select(validate_json(F.col("t")).alias("e"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("parse_json(") == 1


def test_accounting_and_split(spark):
    df = process(spark.createDataFrame([(f"e{k}", "r", h, "", p) for k, (h, p) in enumerate([("", LINE), ("json", "{"), ("", "what"), ("", "SRC=1 SPT=70000"), ("", NESTED)])], schemas.RAW), CFG)
    assert {(r.status, r.error_type): r.n for r in accounting(df).collect()} == {("valid", ""): 2, ("parse_error", "parse"): 1, ("parse_error", "parser_selection"): 1, ("invalid", "validation"): 1}
    assert normalized(df).count() + quarantine(df).count() == 5
    assert {r.status for r in df.select("status").collect()} <= set(STATUSES)
    assert normalized(df).where("event_time is null").count() == 0
    assert df.where("event_id = 'e0'").first().net_summary == "172.16.4.9:40111 -> 10.8.3.77:443 (proto: TCP)"


def test_empty_table(spark):
    assert process(spark.createDataFrame([], schemas.RAW), CFG).count() == 0


def test_plan_is_one_stage(spark):
    plan = process(spark.createDataFrame([("e", "r", "", "", LINE)], schemas.RAW), CFG)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
