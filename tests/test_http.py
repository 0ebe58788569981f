import http.server
import json
import threading
import urllib.error

import pytest

from ledgerline.sources import http as H


def test_tries_again_where_that_may_help():
    waits, answers = [], [urllib.error.HTTPError("u", 503, "x", None, None), urllib.error.URLError("x"), json.dumps([{"a": 1}])]

    def ask(url):
        x = answers.pop(0)
        if isinstance(x, Exception):
            raise x
        return x

    assert H.fetch_objects("u", ask, waits.append) == [{"a": 1}] and waits == [0.25, 0.5]
    answers[:] = [urllib.error.HTTPError("u", 404, "x", None, None)]
    with pytest.raises(urllib.error.HTTPError):
        H.fetch_objects("u", ask, waits.append)
    answers[:] = [json.dumps({"a": 1})]
    with pytest.raises(ValueError):
        H.fetch_objects("u", ask, waits.append)


def test_feeds_over_http(spark):
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            ok = self.path == "/ok"
            self.send_response(200 if ok else 404)
            self.end_headers()
            self.wfile.write(b'[{"id": 1}, {"id": 2}]' if ok else b"no")

        def log_message(self, *a):
            pass

    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        base = f"http://127.0.0.1:{server.server_port}"
        rows = H.fetch_feeds(spark.createDataFrame([("a", f"{base}/ok"), ("b", f"{base}/gone")], "id string, url string")).collect()
        server.shutdown()
    assert sorted((r.source_id, r.payload) for r in rows if not r.error) == [("a", '{"id": 1}'), ("a", '{"id": 2}')]
    (bad,) = (r for r in rows if r.error)
    assert bad.source_id == "b" and "404" in bad.error
    assert H.search_endpoint(None, "https://x.org/main_server/") == "https://x.org/main_server/client_interface/json/?switcher=GetSearchResults"
