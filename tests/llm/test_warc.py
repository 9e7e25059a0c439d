import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from leadloom.llm.warc import PERMITTED, canonical_url, resolve_revisits

START = datetime(2024, 1, 1)
SCHEMA = "record_id long, url string, captured_at timestamp, status int, headers map<string,string>, payload string, outcome string"


def brute_force(rows):
    out = []
    for i, url, at, status, headers, *_ in rows:
        if status != 304:
            continue
        earlier = [r for r in rows if r[3] == 200 and url is not None and at is not None and r[1] == url and r[2] is not None and r[2] < at]
        if not earlier:
            out.append((i, "no_response", None, None))
            continue
        best = max(earlier, key=lambda r: (r[2], r[0]))
        own, old = headers or {}, best[4] or {}
        if own.get("etag") is not None and old.get("etag") is not None:
            outcome = "matched" if own["etag"].removeprefix("W/") == old["etag"].removeprefix("W/") else "mismatch"
        elif own.get("last-modified") is not None and old.get("last-modified") is not None:
            outcome = "matched" if own["last-modified"] == old["last-modified"] else "mismatch"
        else:
            outcome = "unchecked"
        new = {k: v for k, v in own.items() if k in PERMITTED and v is not None}
        out.append((i, outcome, best[0], {**old, **new} if outcome != "mismatch" else None))
    return sorted(out, key=lambda r: r[0])


def test_equals_brute_force(spark):
    draw = random.Random(3)
    rows = []
    for i in range(900):
        url = draw.choice(["hot.example/", "hot.example/", f"h{draw.randrange(40)}.example/a", None])
        at = START + timedelta(minutes=draw.randrange(700)) if draw.random() > 0.03 else None
        headers = {}
        if draw.random() < 0.6:
            headers["etag"] = draw.choice(["", "W/"]) + draw.choice(['"a"', '"b"'])
        if draw.random() < 0.6:
            headers["last-modified"] = draw.choice(["mon", "tue", None])
        headers |= {k: str(i) for k in ("cache-control", "content-length", "vary") if draw.random() < 0.5}
        rows.append((i, url, at, draw.choice([200, 304, 304, 500]), headers if draw.random() > 0.05 else None, "body", "?"))
    got = sorted((r["record_id"], r["outcome"], r["refers_to"], r["headers"]) for r in resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect())
    want = [(i, o, b, h) for i, o, b, h in brute_force([(r[0], r[1] and r[1].rstrip("/"), *r[2:]) for r in rows])]
    assert got == want


def test_repeated_ids_keep_their_own_headers(spark):
    """Rows of one record id differ in headers; one timestamp is far off, and a response has no id."""
    day = lambda n: START + timedelta(days=n)
    rows = [
        (1, "a.example/x", day(1), 200, {"etag": '"1"', "x": "old"}, "one", "?"), (1, "a.example/y", day(1), 200, {"etag": '"2"', "x": "other"}, "two", "?"),
        (2, "a.example/x", day(2), 304, {"etag": '"1"', "vary": "one"}, None, "?"), (2, "a.example/x", day(2), 304, {"etag": '"1"', "vary": "two"}, None, "?"),
        (2, "a.example/y", day(3), 304, {"vary": "three"}, None, "?"), (None, "a.example/z", day(1), 200, {"x": "none"}, "", "?"),
        (4, "a.example/z", day(4), 304, None, None, "?"), (5, "a.example/x", datetime(1970, 1, 2), 304, None, None, "?"), (5, None, day(5), 304, None, None, "?"),
    ]
    got = [(r["record_id"], r["outcome"], r["refers_to"], r["headers"]) for r in resolve_revisits(spark.createDataFrame(rows, SCHEMA)).collect()]
    want = [
        (2, "matched", 1, {"x": "old", "etag": '"1"', "vary": "one"}), (2, "matched", 1, {"x": "old", "etag": '"1"', "vary": "two"}),
        (2, "unchecked", 1, {"x": "other", "etag": '"2"', "vary": "three"}), (4, "unchecked", None, {"x": "none"}),
        (5, "no_response", None, None), (5, "no_response", None, None),
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_empty_table_and_urls(spark):
    assert resolve_revisits(spark.createDataFrame([], SCHEMA)).count() == 0
    urls = {
        "HTTPS://User@WWW.Example.com:443/A/b/?b=2&a=1&utm_source=x#top": "example.com/A/b?a=1&b=2",
        "http://example.com": "example.com", "example.com/?ref=3": "example.com", "http://www2.x.org:8080/?q": "x.org:8080?q", "": "", None: None,
    }
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", canonical_url(F.col("u")).alias("c")).collect()
    assert {r["u"]: r["c"] for r in rows} == urls
