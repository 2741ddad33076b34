"""Log records as lines of JSON."""

from __future__ import annotations

import json
import logging
from datetime import UTC, datetime

#: What a record may carry beside its message.
FIELDS = ("batch_id", "scenario", "dataset", "status")


class JsonLines(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        line = {"at": datetime.fromtimestamp(record.created, UTC).isoformat(), "level": record.levelname, "logger": record.name, "message": record.getMessage()}
        line |= {f: v for f in FIELDS if (v := getattr(record, f, None)) is not None}
        if record.exc_info:
            line["error"] = self.formatException(record.exc_info)
        return json.dumps(line, ensure_ascii=False, sort_keys=True)


def to_json(name: str = "finlake", level: str = "INFO") -> logging.Logger:
    """The logger `name`, writing JSON lines to standard error."""
    out, handler = logging.getLogger(name), logging.StreamHandler()
    handler.setFormatter(JsonLines())
    out.handlers, out.propagate = [handler], False
    out.setLevel(level.upper())
    return out
