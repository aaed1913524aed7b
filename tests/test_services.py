import base64
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from docloom.operators import documents, enrich, services
from docloom.options import OptionError

STREAM = ": hello\r\n\r\nevent: a\ndata: one\n\ndata: two\rdata:  three ü😀\r\rid: 5\r\n\r\ndata\n\nevent: b\ndata: {\"x\":1}\n\ndata: cut off".encode()
WANT = [("a", "one"), ("message", "two\n three ü😀"), ("message", ""), ("b", '{"x":1}')]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 1000])
def test_events_however_they_are_cut(size):
    assert list(services.events(STREAM[i : i + size] for i in range(0, len(STREAM), size))) == WANT


def test_events_of_nothing_and_of_an_endless_stream():
    assert list(services.events([])) == [] and list(services.events([b"\xef\xbb\xbfdata: x\n\n"])) == [("message", "x")]

    def endless():
        while True:
            yield b"data: t"
            yield b"ick\n\n"

    found = services.events(endless())
    assert [next(found) for _ in range(3)] == [("message", "tick")] * 3


class Handler(BaseHTTPRequestHandler):
    polls: dict = {}
    seen: list = []

    def log_message(self, *_):
        pass

    def answer(self, body: bytes, code=200):
        self.send_response(code)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def do_POST(self):
        body = self.rfile.read(int(self.headers["Content-Length"]))
        if self.headers.get("Authorization") != "Bearer k1":
            return self.answer(b"no", 401)
        if self.path.endswith("/upload"):
            name = base64.b64decode(self.headers["X-Filename"]).decode()
            self.seen.append((name, body))
            return self.answer(name.encode())
        (name,) = json.loads(body)["filefield"].values()
        if "bad" in name:
            return self.answer(b"broken", 500)
        self.answer(json.dumps({"processing_id": name}).encode())

    def do_GET(self):
        ident = self.path.split("/requests/")[1].split("/")[0]
        if not self.path.endswith("/results"):
            self.polls[ident] = self.polls.get(ident, 0) + 1
            return self.answer(json.dumps({"completed": "slow" not in ident and self.polls[ident] > 2}).encode())
        self.answer(b'data: {"extracted":true}\n\ndata: {"text":"t1","embeddings":[{"id":"m","embedding":[1.0,2.5]}],"metadata":{"page":3}}\n\ndata: [1]\n\n')


@pytest.fixture(scope="module")
def address():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/api/v1/"
    server.shutdown()


def test_documents_through_the_service(spark, address):
    docs = documents.blank(spark.createDataFrame([("/x/a.pdf", b"abc"), ("/x/bad.pdf", b"b"), ("/x/slow.pdf", b"s")], "URI string, content binary"))
    service = services.HttpService.of(services.Options.of({"write.service.url": address, "write.service.key": "k1"}))
    got = {r["URI"]: r["chunks"] for r in enrich.served(docs, service, timeout=1, pause=0.05).collect()}
    assert [(c["text"], c["embedding"], c["modelName"], json.loads(c["metadata"])) for c in got["/x/a.pdf"]] == [("t1", [1.0, 2.5], "m", {"page": 3})]
    assert got["/x/bad.pdf"] == [] and got["/x/slow.pdf"] == [] and Handler.polls["a.pdf"] == 3 and ("a.pdf", b"abc") in Handler.seen


def test_by_options(spark, address):
    docs = documents.blank(spark.createDataFrame([("/y/b.pdf", b"abc")], "URI string, content binary"))
    made = enrich.pipeline(docs, {"write.service.url": address, "write.service.key": "k1", "write.service.timeout": "20"})
    found = {r["URI"]: bytes(r["content"]).decode() for r in made.collect()}
    assert len(found) == 2 and '"t1"' in next(v for k, v in found.items() if "chunks" in k)


def test_refused(address):
    with pytest.raises(OptionError):
        services.HttpService.of(services.Options.of({"write.service.url": "ftp://x"}))
    with pytest.raises(OSError, match="401"):
        services.HttpService(address.rstrip("/"), "wrong").send("a", b"x")
