"""A small HTTP service over the runs table: health, start a run, list runs, one run.

``Service.answer`` is the whole behaviour and needs no socket; ``serve`` puts it
behind the standard library's server. Starting a run is a function that the
caller gives, so the service doesn't know how runs are made.
"""

from __future__ import annotations

import hmac
import json
from collections.abc import Callable
from datetime import date, datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import jobs
from ..schema import TIERS


#: Runs on a page of the list.
PAGE = 1000


class Service:
    """Answers requests; ``runs`` reads the runs table anew each time, ``save`` writes it, ``start`` begins a run."""

    def __init__(self, runs: Callable[[], DataFrame], save: Callable[[DataFrame], None], start: Callable[[str, str], None], key: str, tier: str = "A", clock: Callable[[], datetime] = datetime.now) -> None:
        self.runs, self.save, self.start, self.key, self.tier, self.clock = runs, save, start, key, tier, clock

    def answer(self, method: str, target: str, key: str | None = None, body: str = "") -> tuple[int, object]:
        """(status, value for JSON) of a request; key is the X-API-Key header."""
        parts = urlsplit(target)
        if (method, parts.path) == ("GET", "/health"):
            return 200, {"status": "ok"}
        routes = {("POST", "/pipeline/run"): self._trigger, ("GET", "/pipeline/runs"): self._list}
        route = routes.get((method, parts.path))
        run_id = parts.path.removeprefix("/pipeline/runs/")
        if route is None and not (method == "GET" and parts.path != run_id and run_id):
            return 404, {"detail": "no such page"}
        if not self.key:
            return 500, {"detail": "no key is set on the server"}
        if key is None or not hmac.compare_digest(key.encode(), self.key.encode()):
            return 401, {"detail": "invalid or missing key"}
        if route is not None:
            return route(parse_qs(parts.query), body)
        found = self._rows(self.runs().where(F.col("run_id") == run_id))
        return (200, found[0]) if found else (404, {"detail": f"no run {run_id}"})

    def _rows(self, runs: DataFrame, page: int = 0) -> list[dict]:
        return [json.loads(r[0]) for r in runs.orderBy(F.desc("started_at"), "run_id").offset(page * PAGE).limit(PAGE).select(F.to_json(F.struct(*runs.columns))).collect()]

    def _list(self, query: dict[str, list[str]], _: str) -> tuple[int, object]:
        """The runs of a day, newest first, PAGE of them from ``page`` (0 if not given) on; the page after the last one is empty."""
        day, page = query.get("date", [""])[0], query.get("page", ["0"])[0]
        if not day:
            return 422, {"detail": "date is required"}
        if not page.isascii() or not page.isdigit() or len(page) > 6:
            return 422, {"detail": "page has to be a number"}
        found = self._rows(self.runs().where(F.col("target_date").cast("string") == day), int(page))
        return (200, found) if found or int(page) else (404, {"detail": f"no run for {day}"})

    def _trigger(self, _: dict[str, list[str]], body: str) -> tuple[int, object]:
        try:
            asked = json.loads(body or "{}")
            day, tier = str(date.fromisoformat(asked["target_date"])), asked.get("tier") or self.tier
        except (ValueError, KeyError, TypeError, AttributeError):
            return 422, {"detail": "target_date has to be a day"}
        if tier not in TIERS:
            return 422, {"detail": f"no tier {tier}"}
        runs, now = self.runs(), F.lit(self.clock()).cast("timestamp_ntz")
        marked = jobs.fail_stale(runs, now)
        if marked.where("was_stale").limit(1).count():
            self.save(marked.drop("was_stale"))
            runs = self.runs()
        if jobs.active_runs(runs, now).first()[0]:
            return 409, {"detail": "a run is in progress"}
        try:
            self.start(day, tier)
        except (OSError, RuntimeError, ValueError) as failure:
            return 500, {"detail": f"the run could not be started: {failure}"}
        return 202, {"target_date": day, "message": f"run of {day} (tier {tier}) started"}


def serve(service: Service, port: int, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server that answers with the service; call serve_forever on it."""

    class Handler(BaseHTTPRequestHandler):
        def _reply(self) -> None:
            size = int(self.headers.get("Content-Length") or 0)
            status, value = service.answer(self.command, self.path, self.headers.get("X-API-Key"), self.rfile.read(size).decode("utf-8", "replace"))
            data = json.dumps(value).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = _reply  # noqa: N815

        def log_message(self, *_: object) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
