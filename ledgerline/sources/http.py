"""JSON feeds over HTTP: one request a source, tried again where that may help. Everything else of the package starts at captured
answers; this is the one reader that asks."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

ATTEMPTS, FIRST_WAIT, LONGEST_WAIT, TIMEOUT = 3, 0.25, 2.0, 20.0
#: Answers after which another try may help; so may one after no answer at all.
AGAIN = (408, 429, 500, 502, 503, 504)
AGENT = "ledgerline/0.1"


def request(url: str, agent: str = AGENT, timeout: float = TIMEOUT) -> str:
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": agent, "Accept": "application/json"}), timeout=timeout) as r:
        return r.read().decode(r.headers.get_content_charset() or "utf-8")


def fetch_objects(url: str, ask: Callable[[str], str] = request, wait: Callable[[float], None] = time.sleep) -> list[dict]:
    """The objects of a JSON array; an answer that is none is an error. Waits double from FIRST_WAIT to LONGEST_WAIT."""
    for n in range(ATTEMPTS):
        try:
            got = json.loads(ask(url))
        except urllib.error.HTTPError as e:
            if e.code not in AGAIN and not 500 <= e.code < 600 or n == ATTEMPTS - 1:
                raise
        except (urllib.error.URLError, TimeoutError, ConnectionError):
            if n == ATTEMPTS - 1:
                raise
        else:
            if not isinstance(got, list) or not all(isinstance(x, dict) for x in got):
                raise ValueError("expected a JSON array of objects")
            return got
        wait(min(FIRST_WAIT * 2**n, LONGEST_WAIT))
    raise AssertionError


def fetch_feeds(sources: DataFrame) -> DataFrame:
    """(source_id, pos, payload, error) of sources (id, url): one row for each object, or one with the error. One source's
    failure stops no other."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for source_id, url in b.itertuples(index=False):
                try:
                    out += [(source_id, i, json.dumps(x), None) for i, x in enumerate(fetch_objects(url))]
                except Exception as e:  # whatever it is, it is this source's
                    out.append((source_id, None, None, f"{type(e).__name__}: {e}"[:500]))
            yield pd.DataFrame(out, columns=["source_id", "pos", "payload", "error"]).astype({"pos": "Int32"})

    return sources.select("id", "url").mapInPandas(run, "source_id string, pos int, payload string, error string")


def search_endpoint(configured: str | None, url: str) -> str:
    """Where a server of feed B is searched: as configured, else below its root."""
    if configured:
        return configured
    base = url.split("?")[0].rstrip("/")
    return f"{base}/?switcher=GetSearchResults" if base.endswith("client_interface/json") else f"{base}/client_interface/json/?switcher=GetSearchResults"
