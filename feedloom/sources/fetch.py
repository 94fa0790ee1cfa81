"""Fetching of feeds: retries with backoff, conditional requests, an injectable transport; a row per source."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Policy: seconds to wait for an answer, repeats after the first try, first pause (each next one is twice as long).
TIMEOUT, RETRIES, PAUSE = 15.0, 2, 0.5
OUTCOMES = "source string, outcome string, code int, body string, etag string, last_modified string"

#: (url, headers) -> (status code, headers, body); raises OSError where nothing answers.
Transport = Callable[[str, dict], tuple[int, dict, bytes]]


def http(url: str, headers: dict) -> tuple[int, dict, bytes]:
    """The network; file:// works too, and answers 200."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=TIMEOUT) as r:  # noqa: S310
            return getattr(r, "status", None) or 200, dict(r.headers.items()), r.read()
    except urllib.error.HTTPError as e:
        return e.code, dict(e.headers.items()), b""


def conditions(captured: bool, etag: str, last_modified: str, own: dict[str, str]) -> dict[str, str]:
    """Request headers: validators only where an earlier capture is still there to serve; a source's own headers win."""
    out = {"If-None-Match": etag, "If-Modified-Since": last_modified} if captured else {}
    return {k: v for k, v in (out | own).items() if v}


def fetched(url: str, headers: dict, transport: Transport = http, retries: int = RETRIES, pause: float = PAUSE, sleep=time.sleep) -> tuple[str, int | None, bytes, dict]:
    """(outcome, code, body, headers): ok, not_modified, http_error or network_error. Only answers of 429 and from 500
    on, and silence, are tried again; a refusal (403) never is."""
    for turn in range(retries + 1):
        try:
            code, said, body = transport(url, headers)
        except OSError:
            code, said, body = None, {}, b""
        if code is not None and 200 <= code < 300:
            return "ok", code, body, said
        if code == 304:
            return "not_modified", code, b"", said
        if code is not None and code != 429 and code < 500 or turn == retries:
            break
        sleep(pause * 2**turn)
    return "network_error" if code is None else "http_error", code, b"", said


def _asked(transport: Transport, policy: dict):
    """Requests (url, headers) to their answers, one after the other, as the network is what a task waits for."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for url, asked, said_before in zip(batch["url"], batch["asked"], batch["headers"], strict=True):
                outcome, code, body, said = fetched(url, dict(said_before or {}), transport, **policy)
                low = {k.lower(): v for k, v in said.items()}
                rows.append((url, asked, outcome, code, body.decode("utf-8", "replace") if outcome == "ok" else None, low.get("etag"), low.get("last-modified")))
            out = pd.DataFrame(rows, columns=["url", "asked", "outcome", "code", "body", "etag", "last_modified"])
            yield out.astype({"code": "Int32"})

    return run


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)), F.lit(""))


def asked_once(requests: DataFrame, transport: Transport = http, spread: int = 1, **policy) -> DataFrame:
    """requests (url, headers map, and more) with outcome, code, body, etag and last_modified.

    Each url with the same headers is asked once over all tasks, and the answers are joined back to all who want them. A
    host's requests are the work of `spread` tasks, so no host gets more than so many at a time, whatever the number of
    tasks; different hosts are asked at once. Null urls are asked nothing and have outcome no_url. Write the result before
    reading it twice: it is not the same again."""
    asked = F.to_json(F.transform(F.array_sort(F.map_entries(F.coalesce("headers", F.map_from_arrays(F.array(), F.array()).cast("map<string,string>")))), lambda e: F.array(e["key"], e["value"])))
    wanted = requests.withColumn("asked", asked)
    once = wanted.filter("url is not null").groupBy("url", "asked").agg(F.first("headers").alias("headers"))
    n = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = once.repartition(n, host(F.col("url")), F.pmod(F.xxhash64("url"), F.lit(spread)))
    answers = dealt.mapInPandas(_asked(transport, policy), "url string, asked string, outcome string, code int, body string, etag string, last_modified string")
    out = wanted.drop("outcome", "code", "body", "etag", "last_modified").join(answers, ["url", "asked"], "left").drop("asked")
    return out.withColumn("outcome", F.coalesce("outcome", F.lit("no_url")))


def captures(sources: DataFrame, transport: Transport = http, **policy) -> DataFrame:
    """OUTCOMES of sources (source, url, captured, etag, last_modified, headers map): a validator of the state is sent
    only where an earlier capture is still there to serve, and a source's own headers win (as `conditions`)."""
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    own = F.coalesce("headers", F.map_from_arrays(F.array(), F.array()).cast("map<string,string>"))
    known = F.map_from_arrays(F.array(F.lit("If-None-Match"), F.lit("If-Modified-Since")), F.array(given("etag"), given("last_modified")))
    mine = F.map_filter(own, lambda k, v: v != "")
    rest = F.map_filter(known, lambda k, v: v.isNotNull() & F.coalesce(F.col("captured"), F.lit(False)) & ~F.map_contains_key(own, k))
    requests = sources.select("source", "url", F.map_concat(rest, mine).alias("headers"))
    return asked_once(requests, transport, **policy).select("source", "outcome", "code", "body", "etag", "last_modified")
