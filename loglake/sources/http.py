"""A small HTTP front for the spool: POST /ingest, POST /ingest/batch, GET /health. No Spark runs here."""

from __future__ import annotations

import json
import os
import uuid
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

from loglake.config import EngineConfig
from loglake.sources.ingest import EMPTY_BATCH, EMPTY_PAYLOAD

# Routes, and answers to requests that can't be read.
ROUTES = {"/health": ("GET", "HEAD"), "/ingest": ("POST",), "/ingest/batch": ("POST",)}
EMPTY_ITEM = "item at index {} has empty payload"
INVALID = {"/ingest": "invalid JSON payload", "/ingest/batch": "invalid JSON batch payload"}
FIELDS = ("format", "source", "payload")


class _Fields(dict):
    """A request's fields by name, whatever their case; null leaves a field as it is, of equal names the last counts."""

    def __init__(self, pairs: list[tuple[str, object]]):
        super().__init__()
        for name, value in pairs:
            if name.lower() in FIELDS and value is not None:
                if not isinstance(value, str):
                    raise ValueError(f"{name.lower()} must be a string")
                self[name.lower()] = value


class _Object(list):
    """A JSON object as its pairs."""


def _decoded(body: bytes, batch: bool) -> list[_Fields]:
    """The requests of a body: its first JSON value, what follows isn't read."""
    value, _ = json.JSONDecoder(object_pairs_hook=_Object).raw_decode(body.decode("utf-8", "replace").lstrip(" \t\r\n"))
    rows = ([] if value is None else value) if batch else [value]
    if not isinstance(rows, list) or isinstance(rows, _Object):
        raise ValueError("not an array")
    if any(r is not None and not isinstance(r, _Object) for r in rows):
        raise ValueError("not an object")
    return [_Fields(r or []) for r in rows]


def _append(spool: Path, events: list[dict]) -> None:
    """One file per request, renamed into place, so that a reader never sees half of it."""
    spool.mkdir(parents=True, exist_ok=True)
    hidden = spool / f".{uuid.uuid4().hex}.tmp"
    hidden.write_text("".join(json.dumps(e, ensure_ascii=False) + "\n" for e in events), encoding="utf-8")
    os.replace(hidden, spool / f"part-{uuid.uuid4().hex}.json")


def _event(request: dict) -> dict:
    event = {"event_id": f"evt_{uuid.uuid4()}", "received_at": EngineConfig().now, "payload": request["payload"]}
    return event | {k: request[k] for k in ("format", "source") if request.get(k)}


def answer(method: str, path: str, body: bytes, spool: Path) -> tuple[int, dict]:
    """Status code and JSON answer of one request."""
    if path not in ROUTES:
        return 404, {"status": "not_found", "message": path}
    if method not in ROUTES[path]:
        return 405, {"status": "method_not_allowed", "message": method}
    if path == "/health":
        return 200, {"status": "ok"}
    batch = path == "/ingest/batch"
    try:
        rows = _decoded(body, batch)
    except ValueError as e:
        return 400, {"status": "bad_request", "message": f"{INVALID[path]}: {e}"}
    if not rows:
        return 400, {"status": "bad_request", "message": EMPTY_BATCH}
    for k, r in enumerate(rows):
        if not r.get("payload"):
            return 400, {"status": "bad_request", "message": EMPTY_ITEM.format(k) if batch else EMPTY_PAYLOAD}
    events = [_event(r) for r in rows]
    try:
        _append(spool, events)
    except OSError as e:
        return 500, {"status": "ingestion_error", "message": str(e)}
    ids = [e["event_id"] for e in events]
    return 202, {"status": "accepted", "count": len(ids), "event_ids": ids} if batch else {"status": "accepted", "event_id": ids[0]}


def serve(spool: str, port: int = 8080, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server that isn't running yet: call serve_forever() on it."""

    class Handler(BaseHTTPRequestHandler):
        timeout = 10

        def _reply(self) -> None:
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            path = self.path.partition("?")[0]
            code, told = answer(self.command, path, body, Path(spool))
            out = json.dumps(told).encode()
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            if code == 405:
                self.send_header("Allow", ", ".join(ROUTES[path]))
            self.send_header("Content-Length", str(len(out)))
            self.end_headers()
            if self.command != "HEAD":
                self.wfile.write(out)

        do_GET = do_HEAD = do_POST = do_PUT = do_PATCH = do_DELETE = do_OPTIONS = _reply  # noqa: N815

        def log_message(self, *args: object) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
