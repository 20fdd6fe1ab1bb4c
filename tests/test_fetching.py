"""The fetch of tables: queues by host, retries, redirects, the second transport; and links resolved in rounds."""

import base64
import json
from collections import Counter, defaultdict

from pyspark.sql import functions as F
from tidewire.operators import reports
from tidewire.sources import fetching, wrappers
from tidewire.sources.fetching import Answer, Policy


def _request(url: str, **more) -> dict:
    return {"url": url, "host": url.split("/")[2], "method": "GET", "data": None, "headers": {}} | more


class _Clock:
    """Time that passes only in sleep()."""

    def __init__(self):
        self.now, self.slept = 100.0, []

    def __call__(self) -> float:
        return self.now

    def sleep(self, seconds: float) -> None:
        self.slept.append(seconds)
        self.now += max(seconds, 0.001)


def _drain(requests, ask, second=lambda url, *_: Answer(0, error="no second transport"), **policy):
    clock = _Clock()
    got = list(fetching.drained(requests, Policy(**{"threads": 1} | policy), ask, second, clock, clock.sleep))
    return {r["url"]: a for r, a in got}, clock, [r["url"] for r, _ in got]


def test_retries_back_off_by_host_and_serve_others_meanwhile():
    asked = Counter()

    def ask(url, *_):
        asked[url] += 1
        return Answer(500, error="HTTP Error 500: x") if "slow" in url and asked[url] < 3 else Answer(200, url.encode())

    urls = ["http://slow.a/1", "http://slow.a/2", "http://b.c/1", "http://b.c/2"]
    got, clock, order = _drain([_request(u) for u in urls], ask)
    assert {u: a.body.decode() for u, a in got.items()} == {u: u for u in urls}
    assert order[:2] == urls[2:] and asked["http://slow.a/1"] == 3
    assert sum(clock.slept) >= 1.5 + 3.0  # linear: backoff, then twice as much


def test_a_final_error_is_an_answer_and_retry_after_is_kept():
    got, clock, _ = _drain([_request("http://a.b/1")], lambda url, *_: Answer(429, b"", (("Retry-After", "30"),), "HTTP Error 429: Too Many"))
    assert got["http://a.b/1"].error == "HTTP Error 429: Too Many" and got["http://a.b/1"].status == 429
    assert sum(clock.slept) >= 60  # two waits of what the host asked for

    def broken(*_):
        raise OSError("refused")

    got, _, _ = _drain([_request("http://a.b/1"), _request("http://c.d/1")], broken, tries=1)
    assert {a.error for a in got.values()} == {"refused"}


def test_gap_between_requests_of_a_host():
    _, clock, _ = _drain([_request(f"http://a.b/{i}") for i in range(4)], lambda url, *_: Answer(200), gap=2.0)
    assert sum(clock.slept) >= 6.0


def test_redirects():
    hops = {f"http://a.b/{i}": f"/{i + 1}" for i in range(5)}

    def ask(url, method, data, *_):
        if url in hops:
            return Answer(302, b"", (("location", hops[url]),), "HTTP Error 302: Found")
        return Answer(200, f"{method} {data} {url}".encode(), url=url)

    assert fetching.followed(ask, "http://a.b/0", "POST", b"x", {}, Policy()).body == b"GET None http://a.b/5"
    hops["http://a.b/5"] = "http://a.b/0"
    assert fetching.followed(ask, "http://a.b/0", "GET", None, {}, Policy()).error == "too many redirects: http://a.b/0"
    kept = fetching.followed(lambda *_: Answer(301, b"body", (), "HTTP Error 301: x"), "http://a.b/", "GET", None, {}, Policy())
    assert (kept.status, kept.body, kept.error) == (200, b"body", "")


def test_second_transport():
    used = []

    def second(url, *_):
        used.append(url)
        return Answer(200, b"second", url=url) if "ok" in url else Answer(0, error="curl: (92) reset", url=url)

    first = {"http://ok.a/403": Answer(403, error="HTTP Error 403: Forbidden"), "http://ok.b/ssl": Answer(0, error="SSL handshake"), "http://no.c/503": Answer(503, error="HTTP Error 503: x"), "http://no.d/404": Answer(404, error="HTTP Error 404: x")}
    got, _, _ = _drain([_request(u) for u in first], lambda url, *_: first[url], second)
    assert got["http://ok.a/403"].body == got["http://ok.b/ssl"].body == b"second"
    assert got["http://no.c/503"].error == "curl: (92) reset" and got["http://no.d/404"].error == "HTTP Error 404: x"
    assert Counter(used) == {"http://ok.a/403": 1, "http://ok.b/ssl": 1, "http://no.c/503": 3}  # TLS errors only after all tries


def test_window_bounds_what_is_held(monkeypatch):
    monkeypatch.setattr(fetching, "WINDOW", 8)
    taken, answered = [0], [0]

    def source():
        for i in range(200):
            taken[0] += 1
            assert taken[0] - answered[0] <= 9
            yield _request(f"http://h{i % 5}.x/{i}")

    for _ in fetching.drained(source(), Policy(threads=3), lambda url, *_: Answer(200)):
        answered[0] += 1
    assert answered[0] == 200


def test_a_table_is_fetched_in_a_bounded_number_of_tasks(spark):
    rows = spark.range(600).select(F.concat(F.lit("http://h"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("string"), F.lit(".x/"), F.col("id") % 500).alias("url"), "id")

    def ask(url, method, data, headers, timeout):
        from pyspark import TaskContext

        return Answer(200, str(TaskContext.get().partitionId()).encode(), (("Last-Modified", "then"),), "", url)

    got = fetching.answered(rows, "http", policy=Policy(tasks=5, lanes=3, threads=1), first=ask).collect()
    assert len(got) == 600 and {r.modified for r in got} == {"then"} and all(r.final_url == r.url for r in got)
    by_host = defaultdict(set)
    for r in got:
        by_host[r.url.split("/")[2]].add(int(r.body))
    assert set().union(*by_host.values()) <= set(range(5)) and len(by_host["h0.x"]) > 1 and all(len(x) <= 3 for x in by_host.values())


def _old(url: str) -> str:
    data = url.encode()
    size = bytes([len(data)]) if len(data) < 128 else bytes([len(data) & 0x7F | 0x80, len(data) >> 7])
    return base64.urlsafe_b64encode(b"\x08\x13\x22" + size + data + b"\xd2\x01\x00").decode().rstrip("=")


def _put(folder, url: str, body: str, data: str = "") -> None:
    (folder / fetching.capture_name(url, data)).write_text(body)


def _engine(folder, token: str, said: str | None = None, page: str = "", feed: str | None = None) -> None:
    """Captures of one token: its page, the engine's word, the feed's page."""
    signed = "<c-wiz><div jscontroller='x' data-n-a-sg='SG' data-n-a-ts='17'></div></c-wiz>" if said is not None else ""
    _put(folder, f"{wrappers.SITE}/articles/{token}", f"<html><body>{signed}{page}</body></html>")
    if said is not None:
        _put(folder, wrappers.EXECUTE, ")]}'\n\n" + json.dumps([["wrb.fr", "Fbv4je", json.dumps(["garturlres", said, 1])]]), wrappers.question(token, "17", "SG"))
    if feed is not None:
        _put(folder, f"{wrappers.SITE}/rss/articles/{token}", feed)


def test_wrapped_links_are_resolved_in_rounds(spark, tmp_path):
    wrap = lambda token: f"https://news.google.com/rss/articles/{token}?oc=5"
    _engine(tmp_path, "NEW", "https://a.com/new")
    _engine(tmp_path, "OWN", "https://www.google.com/x", "<a href='/local'>n</a><a href='https://a.com/page'>y</a>")
    _engine(tmp_path, "META", page="<meta http-equiv='refresh' content='0;URL=https://a.com/meta '>")
    _engine(tmp_path, "DATA", page="<p data-href='https://a.com/data'>x</p>")
    _engine(tmp_path, "FEED", page="<a href='https://a.com/later'>x</a>", feed="<a href='https://a.com/feed'>x</a>")
    _engine(tmp_path, "LEFT", page="<a href='https://policies.google.com/terms'>x</a>")
    _engine(tmp_path, "BARE", page="nothing")
    long = "https://a.com/" + "p" * 150
    want = {
        "https://b.com/x": ("https://b.com/x", "not_google_news"), "http://nodot/x": ("", "failed"), "https://www.google.com/y": ("", "failed"), None: ("", "failed"),
        wrap(_old("https://a.com/old")): ("https://a.com/old", "token_decode"), wrap(_old(long)): (long, "token_decode"), wrap(_old("https://www.google.com/z")): ("", "failed_html_extract"),
        wrap("NEW"): ("https://a.com/new", "html_extract"), wrap("OWN"): ("https://a.com/page", "html_extract"), wrap("META"): ("https://a.com/meta", "html_extract"), wrap("DATA"): ("https://a.com/data", "html_extract"),
        wrap("FEED"): ("https://a.com/feed", "html_extract"), wrap("LEFT"): ("", "failed_google_link_left"), wrap("BARE"): ("", "failed_html_extract"), wrap("GONE"): ("", "failed_html_extract"),
    }
    rounds = []

    def ask(requests):
        rounds.append({r.url.removeprefix(wrappers.SITE).split("/")[1] for r in requests.collect()})
        got = fetching.answered(requests, "capture", str(tmp_path))
        return got.select("link", F.col("body").cast("string").alias("body"))

    items = spark.createDataFrame([(u, i) for i, u in enumerate([*want, *want])], "url string, n int")  # each twice
    got = wrappers.resolved(items, "url", ask).collect()
    assert {r.url: (r.resolved_url, r.resolver_method) for r in got} == want and len(got) == 2 * len(want)
    assert all(r.resolved_ok == (r.resolved_url != "") and r.token_decoded == (r.resolver_method == "token_decode") for r in got)
    assert {r.resolver_method for r in got} == set(wrappers.METHODS)
    assert rounds == [{"articles"}, {"_", "rss"}, {"rss"}]
    offline = {r.url: r.resolver_method for r in wrappers.resolved(items, "url").collect()}
    assert offline[wrap("NEW")] == "failed_html_extract" and offline[wrap(_old("https://a.com/old"))] == "token_decode"
    raw = spark.createDataFrame([({"resolved_ok": str(r.resolved_ok).lower(), "resolver_method": r.resolver_method, "resolver_token_decode_ok": str(r.token_decoded).lower()},) for r in got if r.n < len(want)], "payload map<string,string>")
    counts = reports.resolver_metrics(raw).first().asDict()
    assert counts == {"query_rss_resolved_count": 8, "query_rss_resolve_fail_count": 7, "query_rss_resolve_failed_token_decode_count": 12, "query_rss_resolve_failed_html_extract_count": 3, "query_rss_resolve_failed_google_link_left_count": 1}
    assert wrappers.resolved(items.limit(0), "url", ask).collect() == []
