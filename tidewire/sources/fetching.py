"""Fetching the URLs of a table: requests go in, answers come out, and nothing of either passes the driver.

A request has a url and may have method ("GET"), data (a body) and headers (a map). Equal requests are asked
once. Errors become rows, so one bad source never fails a run. Two transports answer:

- "capture" reads a folder of captured bodies by Spark's file reader: NAME (see capture_key), with NAME.modified
  for a Last-Modified header. It is a join of two tables.
- "http" deals requests to a bounded number of tasks by host. In a task a queue keeps the time from which each
  host may be asked again: a host is asked one request at a time, a failure moves all its requests back
  (backoff, or what Retry-After says), and meanwhile other hosts are served. A busy host is dealt over `lanes`
  tasks, which bounds how many requests it sees at once.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import shutil
import subprocess
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from . import records

AGENT = "Mozilla/5.0 (compatible; tidewire)"
#: Statuses (fixed values) that redirect, and those after which the second transport is tried.
REDIRECTS = (301, 302, 303, 307, 308)
BLOCKED = (403, 429, 500, 502, 503, 504, 520, 521, 522, 523, 524)
#: What an error says (fixed values) where the second transport is tried once all tries are used up.
UNSTABLE = ("ssl", "wrong version number", "handshake", "tls", "eof occurred in violation of protocol", "timed out", "timeout", "remote end closed connection without response", "http/2 stream", "not closed cleanly", "internal_error", "incompleteread")
#: Requests that a task holds at a time.
WINDOW = 512
ANSWER = "key string, status int, body binary, error string, modified string, final_url string"


@dataclass(frozen=True)
class Policy:
    timeout: float = 20
    tries: int = 3
    backoff: float = 1.5
    redirects: int = 5
    threads: int = 6
    gap: float = 0.0
    lanes: int = 6
    tasks: int = 64


@dataclass(frozen=True)
class Answer:
    status: int
    body: bytes = b""
    headers: tuple[tuple[str, str], ...] = ()
    error: str = ""
    url: str = ""

    def header(self, name: str) -> str:
        return next((v.strip() for k, v in self.headers if k.lower() == name.lower()), "")


def capture_name(url: str, data: str = "") -> str:
    return hashlib.sha1((url if not data else f"{url}\n{data}").encode()).hexdigest()


def capture_key(url: Column | str, data: Column | str | None = None) -> Column:
    """The name of a request: of its url, and of its body if it has one."""
    url, data = tx.text(url), tx.text(data) if data is not None else F.lit("")
    return F.sha1(F.when(data == "", url).otherwise(F.concat_ws("\n", url, data)))


class _Stay(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, *_):
        return None


def direct(url: str, method: str, data: bytes | None, headers: dict[str, str], timeout: float) -> Answer:
    """One request by the standard library, without following redirects."""
    request = urllib.request.Request(url, data, {"User-Agent": AGENT, "Accept-Encoding": "identity"} | headers, method=method)
    try:
        with urllib.request.build_opener(_Stay).open(request, timeout=timeout) as r:
            return Answer(r.status, r.read(), tuple(r.headers.items()), "", url)
    except urllib.error.HTTPError as e:
        return Answer(e.code, b"", tuple((e.headers or {}).items()), f"HTTP Error {e.code}: {e.reason}", url)


def by_curl(url: str, method: str, data: bytes | None, headers: dict[str, str], timeout: float) -> Answer:
    """The second transport, another client with its own TLS; an error where a worker has none."""
    binary = shutil.which("curl")
    if not binary:
        return Answer(0, error="no second transport", url=url)
    said = [x for k, v in ({"User-Agent": AGENT} | headers).items() for x in ("--header", f"{k}: {v}")]
    body = ["--data-binary", "@-"] if data is not None else []
    run = subprocess.run([binary, "--fail", "--silent", "--show-error", "--location", "--max-redirs", "5", "--http1.1", "--request", method, "--max-time", str(timeout), *said, *body, "--", url], input=data, capture_output=True, check=False)
    return Answer(0, error=run.stderr.decode("utf-8", "replace").strip() or f"curl exit {run.returncode}", url=url) if run.returncode else Answer(200, run.stdout, url=url)


def followed(ask: Callable, url: str, method: str, data: bytes | None, headers: dict[str, str], policy: Policy) -> Answer:
    """An answer after its redirects, policy.redirects at most; a 303, or a redirected POST, goes on as GET."""
    at = url
    for _ in range(policy.redirects + 1):
        got = ask(at, method, data, headers, policy.timeout)
        where = got.header("Location") if got.status in REDIRECTS else ""
        if not where:
            return got if got.status not in REDIRECTS else Answer(200, got.body, got.headers, "", at)
        at = urllib.parse.urljoin(at, where)
        if got.status == 303 or (method == "POST" and got.status in (301, 302)):
            method, data = "GET", None
    return Answer(0, error=f"too many redirects: {url}", url=at)


def tried(request: dict, attempt: int, policy: Policy, first: Callable, second: Callable) -> tuple[Answer, float | None]:
    """(answer, seconds to wait before the next try; None if this one is final)."""
    url, method, data, headers = request["url"], request.get("method") or "GET", request.get("data"), dict(request.get("headers") or {})
    data = data.encode() if data is not None and data != "" else None
    last = attempt + 1 >= policy.tries

    def ask(transport: Callable, follow: bool) -> Answer:
        try:
            return followed(transport, url, method, data, headers, policy) if follow else transport(url, method, data, headers, policy.timeout)
        except Exception as e:  # a transport's error is the request's answer
            return Answer(0, error=str(e) or type(e).__name__, url=url)

    got = ask(first, True)
    if got.error and (got.status in BLOCKED or (last and any(w in got.error.lower() for w in UNSTABLE))):
        other = ask(second, False)
        got = other if not other.error else Answer(got.status, b"", got.headers, got.error if other.error == "no second transport" else other.error, url)
    if not got.error or last:
        return got, None
    asked = got.header("Retry-After")
    return got, max(policy.backoff * (attempt + 1), float(asked) if asked.isdigit() else 0.0)


def drained(requests: Iterable[dict], policy: Policy, first: Callable = direct, second: Callable = by_curl, clock: Callable = time.monotonic, sleep: Callable = time.sleep) -> Iterator[tuple[dict, Answer]]:
    """Answers in the order they come. WINDOW requests are held at most; each has url, method, data, headers and host."""
    source, queue, opens, running, n, more = iter(requests), [], {}, {}, 0, True
    with ThreadPoolExecutor(policy.threads) as pool:
        while True:
            while more and len(queue) + len(running) < WINDOW:
                request = next(source, None)
                more = request is not None
                if more:
                    n += 1
                    heapq.heappush(queue, (0.0, n, 0, request))
            if not queue and not running:
                return
            now, later, busy = clock(), [], {r["host"] for r, _ in running.values()}
            while queue and len(running) < policy.threads:
                entry = heapq.heappop(queue)
                host = entry[3]["host"]
                if host in busy or max(entry[0], opens.get(host, 0.0)) > now:
                    later.append(entry)
                    continue
                busy.add(host)
                opens[host] = now + policy.gap
                running[pool.submit(tried, entry[3], entry[2], policy, first, second)] = (entry[3], entry[2])
            for entry in later:
                heapq.heappush(queue, entry)
            if not running:  # all that is left waits for its host
                sleep(max(0.0, min(max(e[0], opens.get(e[3]["host"], 0.0)) for e in queue) - now))
                continue
            for done in wait(running, timeout=None if len(running) == policy.threads or not queue else 0.05, return_when=FIRST_COMPLETED).done:
                request, attempt = running.pop(done)
                answer, pause = done.result()
                if pause is None:
                    yield request, answer
                else:
                    opens[request["host"]] = at = clock() + pause
                    n += 1
                    heapq.heappush(queue, (at, n, attempt + 1, request))
            if len(opens) > 4 * WINDOW:
                opens = {h: t for h, t in opens.items() if t > clock()}


def _asked(requests: DataFrame) -> DataFrame:
    """key, url, method, data, headers, host: each request once."""
    have = set(requests.columns)
    none = {"method": F.lit("GET"), "data": F.lit(None).cast("string"), "headers": F.create_map().cast("map<string,string>")}
    rows = requests.filter(tx.text("url") != "").select("url", *[(F.col(c) if c in have else v).alias(c) for c, v in none.items()])
    rows = rows.withColumn("key", capture_key("url", "data"))
    return rows.groupBy("key").agg(*[F.first(c).alias(c) for c in ("url", *none)]).withColumn("host", tx.host("url"))


def by_http(requests: DataFrame, policy: Policy = Policy(), first: Callable = direct, second: Callable = by_curl) -> DataFrame:
    """ANSWER for each of requests (key, url, method, data, headers, host), in policy.tasks tasks."""

    def fetch(batches):
        given = ({**row, "headers": dict(row["headers"] or [])} for batch in batches for row in batch.to_pylist())
        kept: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*kept, strict=True))
            kept.clear()
            kinds = (pa.string(), pa.int32(), pa.binary(), pa.string(), pa.string(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", "status", "body", "error", "modified", "final_url"])

        for request, a in drained(given, policy, first, second):
            kept.append((request["key"], a.status, a.body, a.error[:500], a.header("Last-Modified"), a.url))
            if len(kept) >= 64:
                yield out()
        if kept:
            yield out()

    lane = F.pmod(F.xxhash64("key"), F.lit(policy.lanes))
    return requests.withColumn("_lane", lane).repartition(policy.tasks, "host", "_lane").drop("_lane").mapInArrow(fetch, ANSWER)


def by_capture(requests: DataFrame, path: str, tasks: int) -> DataFrame:
    """ANSWER for each of requests (key, url) from the files of a folder."""
    spark = requests.sparkSession
    if not path or not records._exists(spark, path):
        return requests.select("key", F.lit(0).alias("status"), F.lit(b"").alias("body"), F.lit("404 not found").alias("error"), F.lit("").alias("modified"), F.col("url").alias("final_url"))
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9a-f]" * 40 + "*").option("recursiveFileLookup", "true")
    files = reader.load(path).select(F.regexp_extract("path", r"([0-9a-f]{40})(?:\.modified)?$", 1).alias("key"), F.endswith("path", F.lit(".modified")).alias("of_header"), "content").filter("key <> ''").coalesce(tasks)
    held = files.groupBy("key").agg(F.max(F.when(~F.col("of_header"), F.col("content"))).alias("body"), F.max(F.when(F.col("of_header"), tx.strip(F.col("content").cast("string")))).alias("modified"))
    both = requests.select("key", "url").join(held, "key", "left")
    found = F.col("body").isNotNull()
    return both.select("key", F.when(found, 200).otherwise(0).alias("status"), F.coalesce("body", F.lit(b"")).alias("body"), F.when(found, "").otherwise("404 not found").alias("error"), F.when(found, F.coalesce("modified", F.lit(""))).otherwise("").alias("modified"), F.col("url").alias("final_url"))


def answered(requests: DataFrame, transport: str = "capture", path: str = "", policy: Policy = Policy(), first: Callable = direct, second: Callable = by_curl) -> DataFrame:
    """requests with status, body (binary), modified, final_url and failed (what went wrong, or empty); null without a url."""
    asked = _asked(requests)
    got = by_capture(asked, path, policy.tasks) if transport == "capture" else by_http(asked, policy, first, second)
    keyed = requests.withColumn("_key", F.when(tx.text("url") != "", capture_key("url", "data" if "data" in requests.columns else None)))
    return keyed.join(got.select(F.col("key").alias("_key"), "status", "body", "modified", "final_url", F.col("error").alias("failed")), "_key", "left").drop("_key")


def http_json(url: str, payload: dict | None = None, timeout: float = 25, tries: int = 3) -> dict:
    """Driver-side: one answer's JSON."""
    policy = Policy(timeout=timeout, tries=tries, backoff=1.2)
    data = None if payload is None else json.dumps(payload)
    request = {"url": url, "host": "", "method": "GET" if data is None else "POST", "data": data, "headers": {} if data is None else {"Content-Type": "application/json"}}
    _, answer = next(drained([request], policy))
    if answer.error:
        raise OSError(answer.error)
    return json.loads(answer.body)


def api_url(endpoint: str, parameters: dict) -> str:
    return f"{endpoint}?{urllib.parse.urlencode(parameters)}"


def official_url(endpoint: str, per_page: int = 10, agency: str = "", term: str = "") -> str:
    return api_url(endpoint, {"order": "newest", "per_page": per_page} | ({"conditions[agencies][]": agency} if agency else {}) | ({"conditions[term]": term} if term else {}))


def post_webhook(url: str, payload: dict) -> dict:
    """Driver-side notification; the answer's JSON."""
    return http_json(url, payload)
