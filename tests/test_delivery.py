"""Ingestion, stores, streaming, redelivery."""

import http.client
import json
import threading

from pyspark.sql import functions as F

from loglake import schemas
from loglake.config import EngineConfig
from loglake.plans.pipeline import first_deliveries, skip_done
from loglake.sources import http as front
from loglake.sources.ingest import accepted, accepted_batches, batch_gate, decode, ingest, publish, read_spool, rejected, requests, stamped
from loglake.sources.stores import Stores
from loglake.streaming.stream import counts_by_window, dedup_within, handle, reprocess, run_stream

CFG = EngineConfig(now="2026-09-01T00:00:00Z", reference_year=2026)
LINE = "Aug 28 18:30:12 fw DENY TCP SRC=1.1.1.1:1 DST=2.2.2.2:2"


def raw(spark, rows):
    return spark.createDataFrame([(i, CFG.now, h, "", p) for i, h, p in rows], schemas.RAW)


def test_ingest(spark, tmp_path):
    spool = str(tmp_path / "spool")
    answer = ingest(spark, [{"payload": p} for p in ("a", " b ", "c\n")], spool, CFG).first()
    assert (answer.status, answer["count"], len(set(answer.event_ids))) == ("accepted", 3, 3)
    assert {r.payload for r in read_spool(spark, spool).collect()} == {"a", " b ", "c\n"}
    assert ingest(spark, [], spool, CFG).first().message == "batch must not be empty"
    assert "index 1" in ingest(spark, [{"payload": "a"}, {"payload": ""}], spool, CFG).first().message
    assert read_spool(spark, spool).count() == 3
    rows = requests(spark, [{"payload": "x"}, {"payload": ""}, {"format": "csv"}])
    assert accepted(rows).count() == 1 and {r.message for r in rejected(rows).collect()} == {"payload must not be empty"}
    made = stamped(accepted(rows), CFG).first()
    assert len(made.event_id) == 40 and made.received_at == CFG.now


def test_batch_gate(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "a"), (2, 1, ""), (2, 2, None)], "batch_id int, idx int, payload string")
    got = {r.batch_id: r for r in batch_gate(df).collect()}
    assert got[1].accepted and not got[2].accepted and got[2].first_bad == 1
    assert {r.batch_id for r in accepted_batches(df).collect()} == {1}


def test_decode(spark):
    df = spark.createDataFrame([('{"event_id":"e","payload":"p"}',), ("no",), (None,)], "payload string")
    got = decode(df).collect()
    assert got[0].event_id == "e" and got[0]._corrupt is None and got[1]._corrupt == "no"


def test_http(tmp_path):
    server = front.serve(str(tmp_path), port=0)
    threading.Thread(target=server.serve_forever, daemon=True).start()

    def ask(method, path, body=None):
        c = http.client.HTTPConnection("127.0.0.1", server.server_address[1], timeout=5)
        c.request(method, path, body)
        r = c.getresponse()
        return r.status, json.loads(r.read())

    assert ask("GET", "/health") == (200, {"status": "ok"})
    code, told = ask("POST", "/ingest", '{"payload":"x","source":"s"}')
    assert code == 202 and told["event_id"].startswith("evt_")
    code, told = ask("POST", "/ingest/batch", '[{"payload":"a"},{"payload":"b"},{"payload":"c"}]')
    assert code == 202 and told["count"] == 3 and len(set(told["event_ids"])) == 3
    for path, body in (("/ingest", "{"), ("/ingest", '{"payload":""}'), ("/ingest/batch", "[]"), ("/ingest/batch", '[{"payload":"a"},{"payload":""}]'), ("/ingest", "[]"), ("/ingest", '{"payload":5}'), ("/ingest", "null"), ("/ingest/batch", "null"), ("/ingest/batch", "[[]]x"), ("/ingest/batch", '{"payload":"a"}')):
        assert ask("POST", path, body)[0] == 400
    assert ask("GET", "/nowhere")[0] == 404 and ask("GET", "/ingest")[0] == ask("POST", "/health")[0] == ask("PUT", "/ingest/batch")[0] == 405
    assert ask("POST", "/ingest/batch", '[{"payload":"a"},{"source":"s"}]')[1]["message"] == "item at index 1 has empty payload"
    # Null leaves a field empty, names may have any case, the last of equal ones counts, what follows the value isn't read.
    assert ask("POST", "/ingest", '{"source":null,"PAYLOAD":"p","Payload":"q","extra":[1]} trailing')[0] == 202
    server.shutdown()
    lines = [json.loads(x) for p in tmp_path.glob("part-*.json") for x in p.read_text().splitlines()]
    assert sorted(x["payload"] for x in lines) == ["a", "b", "c", "q", "x"] and lines[0]["event_id"] != lines[1]["event_id"]


def test_dedup_and_ttl(spark):
    df = raw(spark, [("a", "", "1"), ("a", "", "2"), ("b", "", "3"), ("", "", "4"), ("", "", "5")]).withColumn("arrival", F.col("payload").cast("int"))
    assert sorted(r.payload for r in first_deliveries(df).collect()) == ["1", "3", "4", "5"]
    ledger = spark.createDataFrame([("a", "2026-08-31T12:00:00Z"), ("b", "2026-08-30T12:00:00Z")], "event_id string, done_at string")
    assert sorted(r.payload for r in skip_done(df, ledger, CFG).collect()) == ["3", "4", "5"]


def test_batches(spark, tmp_path):
    stores = Stores(str(tmp_path))
    one = raw(spark, [("v", "", LINE), ("v", "", LINE), ("bad", "json", "{"), ("inv", "", "SRC=1 SPT=70000")])
    handle(one, 0, stores, CFG)
    handle(one, 0, stores, CFG)  # a replay replaces the batch
    assert stores.read(spark, "normalized").count() == 1 and stores.read(spark, "quarantine").count() == 2
    assert {r.event_id for r in stores.ledger(spark).collect()} == {"v", "inv"}
    # Done ids are skipped without a trace, failed ones are tried again.
    handle(raw(spark, [("v", "", LINE), ("bad", "json", '{"action":"deny"}')]), 1, stores, CFG)
    assert {(r.event_id, r.batch_id) for r in stores.read(spark, "archive").collect()} == {("v", 0), ("bad", 0), ("inv", 0), ("bad", 1)}
    assert {r.event_id for r in stores.ledger(spark).collect()} == {"v", "inv", "bad"}
    assert stores.archived(spark, "inv").first().payload == "SRC=1 SPT=70000"
    found = stores.archived(spark, "inv", CFG.now)
    assert found.first().payload == "SRC=1 SPT=70000" and "PartitionFilters: [isnotnull(hour" in found._jdf.queryExecution().executedPlan().toString()
    live = stores.ledger(spark, but=0, since="2026-08-31T00:00:00Z")
    assert live.count() == 1 and "PartitionFilters: [isnotnull(hour" in live._jdf.queryExecution().executedPlan().toString()
    assert stores.ledger(spark, since="2026-09-01T01:00:00Z").count() == 0
    assert not (tmp_path / "work" / "batch_id=0").exists() and not (tmp_path / "processed" / "batch_id=1").exists()
    stores.compact(spark, "ledger", "2026-09-01-00")
    assert {r.event_id for r in stores.ledger(spark).collect()} == {"v", "inv", "bad"} and {r.batch_id for r in stores.ledger(spark).collect()} == {-1}
    assert stores.prune(spark, "ledger", CFG.now) == 0 and stores.prune(spark, "ledger", "2026-09-01T01:00:00Z") == 1 and stores.ledger(spark).count() == 0
    assert reprocess(spark, stores, CFG).select("status").first().status == "parse_error"


def test_stream_restart_and_redelivery(spark, tmp_path):
    spool, root = str(tmp_path / "spool"), str(tmp_path / "out")
    publish(raw(spark, [("a", "", LINE), ("b", "json", "{")]), spool)
    run_stream(spark, spool, root, CFG, once=True).awaitTermination()
    publish(raw(spark, [("a", "", LINE), ("c", "", LINE)]), spool)
    (tmp_path / "spool" / "bad.json").write_text("not json\n")
    run_stream(spark, spool, root, CFG, once=True).awaitTermination()
    run_stream(spark, spool, root, CFG, once=True).awaitTermination()
    stores = Stores(root)
    assert sorted(r.event_id for r in stores.read(spark, "normalized").collect()) == ["a", "c"]
    assert sorted(str(r.event_id) for r in stores.read(spark, "quarantine").collect()) == ["None", "b"]


def test_settings(spark):
    spark.conf.set("spark.loglake.done_ttl_s", "60")
    try:
        assert EngineConfig.of(spark).done_ttl_s == 60 and EngineConfig.of(spark).trigger_s == EngineConfig().trigger_s
    finally:
        spark.conf.unset("spark.loglake.done_ttl_s")


def test_windows(spark):
    df = spark.sql("select timestamp'2026-01-01 10:10:00' as event_time, 'e1' as event_id, named_struct('action','deny','severity','high') as event union all select timestamp'2026-01-01 10:50:00', 'e2', named_struct('action','deny','severity','high')")
    assert [(r.action, r.n) for r in counts_by_window(df).collect()] == [("deny", 2)]


def test_streaming_dedup_and_windows(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k, at in enumerate(("10:00:00", "10:10:00", "12:30:00")):
        (folder / f"{k}.json").write_text(json.dumps({"event_id": f"e{k % 2}", "at": f"2026-01-01T{at}Z"}) + "\n")
    events = spark.readStream.schema("event_id string, at string").json(str(folder)).select("event_id", F.to_timestamp("at").alias("event_time"))
    query = dedup_within(events).writeStream.format("memory").queryName("deduped").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("deduped").count() == 2
