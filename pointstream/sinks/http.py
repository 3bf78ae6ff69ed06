"""Chunks to a bulk import endpoint: one gzipped multipart file a request, with retries."""

from __future__ import annotations

import gzip
import http.client
import json
import random
import time
import urllib.error
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

#: Fixed value: where the target takes lines.
PATH = "/api/v1/import/lp"


class Rejected(RuntimeError):
    """An answer that another try won't change."""


class Exhausted(RuntimeError):
    """No more tries are left."""


@dataclass
class Result:
    database: str = ""
    measurements: list[str] = field(default_factory=list)
    rows_imported: int = 0
    precision: str = ""
    duration_ms: int = 0


@dataclass
class Sink:
    """``retries`` further tries after the first, each after a wait between nothing and base * 2^k, at most ``longest``."""

    url: str
    token: str = ""
    precision: str = "ns"
    retries: int = 6
    base: float = 1.0
    longest: float = 60.0
    timeout: float = 600.0
    #: Where the target looks for the name of the database.
    database_header: str = "x-database"
    sleep: Callable[[float], None] = time.sleep

    def body(self, lines: bytes) -> tuple[bytes, str]:
        mark = uuid.uuid4().hex
        head = f'--{mark}\r\nContent-Disposition: form-data; name="file"; filename="chunk.lp.gz"\r\nContent-Type: application/octet-stream\r\n\r\n'
        return head.encode() + gzip.compress(lines) + f"\r\n--{mark}--\r\n".encode(), f"multipart/form-data; boundary={mark}"

    def wait(self, attempt: int) -> float:
        return random.uniform(0, min(self.base * 2**attempt, self.longest))

    def send(self, database: str, lines: bytes) -> Result:
        body, kind = self.body(lines)
        last: Exception | None = None
        for attempt in range(self.retries + 1):
            if attempt:
                self.sleep(self.wait(attempt - 1))
            try:
                return self._once(database, body, kind)
            except urllib.error.HTTPError as e:
                try:
                    said = e.read(300).decode("utf-8", "replace")
                except (OSError, http.client.HTTPException):
                    said = ""
                if e.code != 429 and e.code < 500:
                    raise Rejected(f"{e.code}: {said}") from None
                last = RuntimeError(f"{e.code}: {said}")
            except (OSError, http.client.HTTPException) as e:  # among them answers that break off
                last = e
        raise Exhausted(f"after {self.retries + 1} tries: {last}")

    def _once(self, database: str, body: bytes, kind: str) -> Result:
        query = urllib.parse.urlencode({"precision": self.precision})
        request = urllib.request.Request(f"{self.url.rstrip('/')}{PATH}?{query}", data=body, method="POST")
        request.add_header("Content-Type", kind)
        request.add_header(self.database_header, database)
        if self.token:
            request.add_header("Authorization", f"Bearer {self.token}")
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            if answer.status != 200:
                raise Rejected(f"{answer.status}: {answer.read(300).decode('utf-8', 'replace')}")
            return parse_result(answer.read())


def parse_result(answer: bytes | str) -> Result:
    """What the target says of a chunk that it took; an answer of another form says nothing."""
    try:
        got = json.loads(answer).get("result") or {}
        return Result(**{k: got[k] for k in Result.__dataclass_fields__ if got.get(k) is not None})
    except (ValueError, AttributeError, TypeError):
        return Result()
