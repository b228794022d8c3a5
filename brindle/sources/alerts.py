"""Alerts: lines of JSON, and a post to a web address if one is given. A failed post fails nothing."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable
from datetime import UTC, datetime
from pathlib import Path


class Alerts:
    """Appends to a file on the driver; ``post`` sends a body to ``url`` and may fail."""

    def __init__(self, path: str, url: str | None = None, post: Callable[[str, bytes], None] | None = None):
        self.path, self.url, self.post = Path(path), url, post or _post

    def tell(self, level: str, what: str, **details) -> bool:
        """Record one message; whether it was posted."""
        said = {"at": datetime.now(UTC).isoformat(timespec="seconds"), "level": level, "what": what, **details}
        self.path.parent.mkdir(parents=True, exist_ok=True)
        with self.path.open("a", encoding="utf-8") as f:
            f.write(json.dumps(said, sort_keys=True, default=str) + "\n")
        if not self.url:
            return False
        try:
            self.post(self.url, json.dumps(said, default=str).encode())
        except Exception as e:
            with self.path.open("a", encoding="utf-8") as f:
                f.write(json.dumps({"level": "warning", "what": "post failed", "error": f"{type(e).__name__}: {e}"}) + "\n")
            return False
        return True


def _post(url: str, body: bytes) -> None:
    request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
    urllib.request.urlopen(request, timeout=10).close()
