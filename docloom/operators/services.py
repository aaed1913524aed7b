"""A client of an external enrichment service over HTTP: upload, submit, poll, and results as a stream of events."""

from __future__ import annotations

import base64
import codecs
import json
import re
import urllib.error
import urllib.request
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from ..options import OptionError, Options

#: Bytes that are read of a response at a time, and seconds that one request may take.
PIECE, REQUEST_SECONDS = 1 << 16, 60


def events(pieces: Iterable[bytes]) -> Iterator[tuple[str, str]]:
    """(type, data) of each event of an event stream, as its bytes come in, however they are cut. Comments are passed over; an event that the stream's end cuts off is none."""
    decoder = codecs.getincrementaldecoder("utf-8")("replace")
    held, kind, data, first = "", "", [], True

    def lines(text: str, last: bool) -> Iterator[str]:
        nonlocal held
        held += text
        at = 0
        for m in re.finditer(r"\r\n|\r|\n", held):
            if m[0] == "\r" and m.end() == len(held) and not last:
                break  # its \n may be yet to come
            yield held[at : m.start()]
            at = m.end()
        held = held[at:]

    for piece in _ended(pieces):
        for line in list(lines(decoder.decode(piece or b"", piece is None), piece is None)):
            if first:
                line, first = line.removeprefix("﻿"), False
            if not line:
                if data:
                    yield kind or "message", "\n".join(data)
                kind, data = "", []
                continue
            name, _, value = line.partition(":")
            value = value.removeprefix(" ")
            if name == "event":
                kind = value
            elif name == "data":
                data.append(value)


def _ended(pieces: Iterable[bytes]) -> Iterator[bytes | None]:
    yield from pieces
    yield None


@dataclass(frozen=True)
class HttpService:
    """Sends files to ``url`` with a bearer key: the bytes to processing/upload, their id to processing/push, then asks processing/requests/{id} until it is completed and reads its results."""

    url: str
    key: str | None = None

    @classmethod
    def of(cls, options: Options) -> HttpService:
        url = options.text("write.service.url")
        if not url or not re.match(r"https?://", url):
            raise OptionError("write.service.url must be an http or https address.")
        return cls(url.rstrip("/"), options.text("write.service.key"))

    def _opened(self, path: str, body: bytes | None = None, **headers: str):
        request = urllib.request.Request(f"{self.url}/{path}", data=body, headers=({"Authorization": f"Bearer {self.key}"} if self.key else {}) | headers, method="GET" if body is None else "POST")
        try:
            return urllib.request.urlopen(request, timeout=REQUEST_SECONDS)
        except urllib.error.HTTPError as problem:
            raise OSError(f"{path}: {problem.code} {problem.reason}") from problem

    def send(self, name: str, content: bytes) -> str:
        with self._opened("processing/upload", content, **{"X-Filename": base64.b64encode(name.encode()).decode(), "Content-Type": "application/octet-stream"}) as r:
            ident = r.read().decode().strip()
        with self._opened("processing/push", json.dumps({"filefield": {name: ident}}).encode(), **{"Content-Type": "application/json"}) as r:
            return json.loads(r.read())["processing_id"]

    def poll(self, ticket: str) -> Iterator[dict] | None:
        """Texts with an embedding and its model for each event that has any; None while the service works."""
        with self._opened(f"processing/requests/{ticket}") as r:
            if json.loads(r.read()).get("completed") is not True:
                return None
        return self._results(ticket)

    def _results(self, ticket: str) -> Iterator[dict]:
        with self._opened(f"processing/requests/{ticket}/results", Accept="text/event-stream") as r:
            for _, data in events(iter(lambda: r.read1(PIECE), b"")):
                found = json.loads(data)
                if not isinstance(found, dict):
                    continue
                for e in found.get("embeddings") or [{}]:
                    meta = found.get("metadata")
                    yield {"text": found.get("text"), "embedding": e.get("embedding"), "model": e.get("id"), "metadata": None if meta is None else json.dumps(meta)}
