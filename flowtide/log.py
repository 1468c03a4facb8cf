"""Logging as lines of JSON or as text."""

from __future__ import annotations

import json
import logging
import sys

LEVELS = {"trace": 5, "debug": 10, "info": 20, "warn": 30, "error": 40}


class _Json(logging.Formatter):
    def format(self, r: logging.LogRecord) -> str:
        return json.dumps({"level": r.levelname.lower(), "time": self.formatTime(r, "%Y-%m-%dT%H:%M:%S%z"), "message": r.getMessage(), **getattr(r, "fields", {})})


def make(level: str = "info", form: str = "json", stream=None) -> logging.Logger:
    if level not in LEVELS or form not in ("json", "console"):
        raise ValueError(f"invalid log level or format: {level!r}, {form!r}")
    log = logging.getLogger("flowtide")
    log.setLevel(LEVELS[level])
    handler = logging.StreamHandler(stream or sys.stderr)
    handler.setFormatter(_Json() if form == "json" else logging.Formatter("%(asctime)s %(levelname)s %(message)s"))
    log.handlers, log.propagate = [handler], False
    return log
