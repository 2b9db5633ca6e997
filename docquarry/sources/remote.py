"""A document store over HTTP as a Python data source: mapping, sampling, paging, retries with growing waits."""

from __future__ import annotations

import base64
import gzip
import http.client
import json
import logging
import ssl
import time
import urllib.parse
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.mapping import Resolved, merge, resolve

log = logging.getLogger("docquarry.http")
#: Statuses after which a request is sent again.
RETRY = (429, 500, 502, 503, 504)
#: The latest requests of this process, as rows of LOG_SCHEMA.
REQUESTS: deque[dict] = deque(maxlen=10_000)
LOG_SCHEMA = "started timestamp, duration_ms long, type string, url string, request_headers map<string,string>, body string, status int, reason string, response_headers map<string,string>"
HITS = "hits.hits._id,hits.hits._source"


class StoreError(RuntimeError):
    """What the store or the way to it answered."""


def _basic(user: str, password: str | None) -> str:
    return "Basic " + base64.b64encode(f"{user}:{password or ''}".encode()).decode()


def quoted(index: str) -> str:
    return urllib.parse.quote(index, safe="*,")


def http_log(spark) -> DataFrame:
    """The latest requests that this process sent; executors keep their own. Credentials are never logged."""
    return spark.createDataFrame([tuple(x.values()) for x in REQUESTS], LOG_SCHEMA)


@dataclass
class Client:
    """One connection that is kept open between requests; answers may be compressed. proxy: a URL, with a login or not."""

    host: str = "localhost"
    port: int = 9200
    use_ssl: bool = False
    verify_ssl: bool = True
    username: str | None = None
    password: str | None = None
    timeout: int = 30000
    max_retries: int = 3
    retry_interval: int = 100
    retry_backoff_factor: float = 2.0
    proxy: str | None = None
    _open: http.client.HTTPConnection | None = field(default=None, repr=False, compare=False)

    def base(self) -> urllib.parse.SplitResult:
        return urllib.parse.urlsplit(f"{self.host if '://' in self.host else f'{"https" if self.use_ssl else "http"}://{self.host}'}:{self.port}")

    def connect(self) -> http.client.HTTPConnection:
        to, via = self.base(), urllib.parse.urlsplit(self.proxy if "://" in self.proxy else f"http://{self.proxy}") if self.proxy else None
        seconds, at = self.timeout / 1000, (via or to)
        if to.scheme != "https":
            return http.client.HTTPConnection(at.hostname, at.port or 80, timeout=seconds)
        context = ssl.create_default_context()
        if not self.verify_ssl:
            context.check_hostname, context.verify_mode = False, ssl.CERT_NONE
        out = http.client.HTTPSConnection(at.hostname, at.port or 443, timeout=seconds, context=context)
        if via:
            out.set_tunnel(to.hostname, to.port, {"Proxy-Authorization": _basic(urllib.parse.unquote(via.username), urllib.parse.unquote(via.password or ""))} if via.username else {})
        return out

    def close(self) -> None:
        if self._open is not None:
            self._open.close()
            self._open = None

    def once(self, method: str, path: str, body: dict | None) -> tuple[int, str]:
        to = self.base()
        url = f"{to.scheme}://{to.netloc}{to.path}{path}"
        head = {"Content-Type": "application/json", "Accept-Encoding": "gzip", "Connection": "keep-alive"}
        secret = {"Authorization": _basic(self.username, self.password)} if self.username else {}
        via = urllib.parse.urlsplit(self.proxy if "://" in self.proxy else f"http://{self.proxy}") if self.proxy and to.scheme == "http" else None
        if via and via.username:
            secret["Proxy-Authorization"] = _basic(urllib.parse.unquote(via.username), urllib.parse.unquote(via.password or ""))
        raw = None if body is None else json.dumps(body).encode()
        began = time.time()
        for kept_open in (True, False):  # a connection that was kept open may have been closed at the other end
            known = self._open is not None
            self._open = self._open or self.connect()
            try:
                self._open.request(method, url if via else to.path + path, raw, head | secret)
                answer = self._open.getresponse()
                data = answer.read()
                break
            except http.client.HTTPException as e:
                self.close()
                if not (known and kept_open):
                    raise OSError(f"{type(e).__name__}: {e}") from e
            except OSError:
                self.close()
                if not (known and kept_open):
                    raise
        if answer.will_close:
            self.close()
        if answer.getheader("Content-Encoding", "").lower() == "gzip":
            data = gzip.decompress(data)
        row = {"started": datetime.fromtimestamp(began, UTC), "duration_ms": round((time.time() - began) * 1000), "type": method, "url": url, "request_headers": head, "body": raw.decode() if raw else None, "status": answer.status, "reason": answer.reason, "response_headers": dict(answer.getheaders())}
        REQUESTS.append(row)
        log.info("%s", json.dumps(row, default=str))
        return answer.status, data.decode(errors="replace")

    def send(self, method: str, path: str, body: dict | None = None, retry: bool = True) -> dict:
        wait, problem = self.retry_interval, ""
        for k in range(self.max_retries + 1 if retry else 1):
            if k:
                time.sleep(wait / 1000)
                wait *= self.retry_backoff_factor
            try:
                status, text = self.once(method, path, body)
            except OSError as e:
                problem = f"HTTP {method} request failed: {getattr(e, 'reason', e)}"
                continue
            if status < 300:
                try:
                    return json.loads(text or "{}")
                except ValueError as e:
                    raise StoreError(f"Failed to parse response: {e}") from e
            problem = f"HTTP {status}: {text}"
            if status not in RETRY:
                raise StoreError(problem)
        raise StoreError(problem + (f" (after {self.max_retries} retries)" if retry and self.max_retries else ""))

    def mapping(self, index: str) -> Resolved:
        try:
            got = self.send("GET", f"/{quoted(index)}/_mapping")
        except StoreError as e:
            raise StoreError(f"Failed to get mapping: {e}") from e
        return merge({k: resolve(v) for k, v in sorted(got.items())})

    def sample(self, index: str, size: int, query: dict) -> list[dict]:
        return self.send("POST", f"/{quoted(index)}/_search?size={size}&filter_path={HITS}", {"query": query}).get("hits", {}).get("hits", [])

    def scroll(self, index: str, body: dict, size: int, keep: str) -> Iterator[dict]:
        """All hits, page after page; the cursor is closed at the end, also after a failure."""
        cursor = None
        try:
            page = self.send("POST", f"/{quoted(index)}/_search?scroll={keep}&size={size}&filter_path=_scroll_id,{HITS}", body)
            while True:
                cursor = page.get("_scroll_id", cursor)
                hits = page.get("hits", {}).get("hits", [])
                yield from hits
                if not hits or not cursor:
                    return
                page = self.send("POST", f"/_search/scroll?filter_path=_scroll_id,{HITS}", {"scroll": keep, "scroll_id": cursor})
        finally:
            if cursor:
                try:
                    self.send("DELETE", "/_search/scroll", {"scroll_id": cursor}, retry=False)
                except StoreError:
                    log.warning("the cursor could not be closed")
            self.close()


def page_size(batch: int, factor: int, limit: int | None, offset: int = 0) -> int:
    """A small limit is one page."""
    total = (limit or 0) + offset
    return total if limit and total <= batch * factor else batch


@dataclass
class Slice(InputPartition):
    number: int
    of: int


class StoreReader(DataSourceReader):
    """Rows (_id, _source) of a request's hits by cursor; slices of the cursor are read in parallel."""

    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        n = int(self.options.get("slices", 1))
        return [Slice(k, n) for k in range(n)]

    def read(self, partition: Slice):
        body = json.loads(self.options.get("body") or '{"query": {"match_all": {}}}')
        if partition.of > 1:
            body["slice"] = {"id": partition.number, "max": partition.of}
        limit = int(self.options["limit"]) if self.options.get("limit") else None
        size = page_size(int(self.options.get("batch_size", 1000)), int(self.options.get("batch_size_threshold_factor", 5)), limit)
        for k, hit in enumerate(client_of(self.options).scroll(self.options["index"], body, size, self.options.get("scroll_time", "5m"))):
            if limit is not None and k >= limit:
                return
            yield hit["_id"], json.dumps(hit.get("_source", {}))


def client_of(o: dict) -> Client:
    flag = lambda k, d: str(o.get(k, d)).lower() == "true"
    return Client(o.get("host", "localhost"), int(o.get("port", 9200)), flag("use_ssl", False), flag("verify_ssl", True), o.get("username"), o.get("password"), int(o.get("timeout", 30000)), int(o.get("max_retries", 3)), int(o.get("retry_interval", 100)), float(o.get("retry_backoff_factor", 2.0)), o.get("proxy"))


class DocumentStore(DataSource):
    """spark.read.format("docsearch").option("index", ...): rows (_id, _source)."""

    @classmethod
    def name(cls) -> str:
        return "docsearch"

    def schema(self) -> str:
        if not self.options.get("host", "localhost"):
            raise ValueError("the source requires 'host' parameter")
        if not self.options.get("index"):
            raise ValueError("the source requires 'index' parameter")
        return "_id string not null, _source string"

    def reader(self, schema) -> StoreReader:
        return StoreReader(dict(self.options))
