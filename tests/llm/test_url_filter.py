"""Operator 10 against a direct look at every entry's history."""

import datetime as dt
import random

from barlake.llm import url_filter


def test_against_history(spark):
    r = random.Random(8)
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    entries = ["example.com", "a.example.com", "a.example.com/x", "b.org", "a.example.com/x/y"]
    events = [(r.choice(entries), r.choice(["block", "allow"]), r.choice(["add", "remove"]), day(r.randint(0, 400))) for _ in range(60)]
    events += [events[0], (None, "block", "add", day(1)), ("b.org", "block", "add", None)]
    urls = ["http://a.example.com/x/y", "https://www.a.example.com/x?z", "http://q.a.example.com", "http://B.org.", "x", None, "http://other.net/example.com"]
    captures = [(i, r.choice(urls), day(r.randint(-10, 420)) if i % 9 else None, "e") for i in range(200)] + [(3, urls[0], day(50), "e")] * 2
    got = url_filter.filter_urls(
        spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp_ntz, entry string"),
        spark.createDataFrame(events, "entry string, action string, op string, at timestamp_ntz"),
    )
    assert got.columns == ["page_id", "url", "fetched_at", "blocked", "entry", "action", "listed_since"]
    out = sorted(((x["page_id"], x["url"] or "", str(x["fetched_at"]), x["blocked"], x["entry"]) for x in got.collect()), key=str)
    keys = {urls[0]: ["a.example.com", "example.com", "a.example.com/x", "a.example.com/x/y"], urls[1]: ["a.example.com", "example.com", "a.example.com/x"], urls[2]: ["q.a.example.com", "a.example.com", "example.com"], urls[3]: ["b.org"], urls[6]: ["other.net"]}
    want = []
    for i, url, at, _ in captures:
        best = None
        for key in keys.get(url, []) if at else []:
            for action in ("block", "allow"):
                past = sorted({(t, op) for e, a, op, t in events if e == key and a == action and t and t <= at})
                if past and past[-1][1] == "add":
                    best = max(best or (0, False, ""), (len(key), action == "block", key))
        want.append((i, url or "", str(at), bool(best and best[1]), best and best[2]))
    assert out == sorted(want, key=str)


def test_long_paths_and_hosts(spark):
    """A URL of 100,000 characters is tested with the keys that the list can hold, its whole path among them."""
    path, name = "/".join(["ab"] * 33_000), ".".join(["h"] * 2_000)
    urls = [f"http://a.org/{path}", f"http://a.org/{path}/c", f"http://{name}.b.org/x", "http://localhost/x", "http://a.org//ab//c/"]
    at = dt.datetime(2024, 1, 1)
    entries = [f"a.org/{path}", "a.org/ab/c", "h.b.org", "localhost", "org", "a.org/", "a.org//ab", "x.y/1/2/3/4"]
    got = url_filter.filter_urls(
        spark.createDataFrame([(i, u, at) for i, u in enumerate(urls)], "page_id long, url string, fetched_at timestamp"),
        spark.createDataFrame([(e, "block", "add", at) for e in entries], "entry string, action string, op string, at timestamp"),
    )
    assert [r["entry"] for r in sorted(got.collect())] == [entries[0], entries[0], "h.b.org", "localhost", "a.org/ab/c"]
    labels, steps = url_filter.entry_shapes(spark.createDataFrame([(e,) for e in entries], "entry string"))
    assert (labels, steps) == ([1, 3], [1, 2, 4, 33_000])


def test_empty(spark):
    cap = spark.createDataFrame([(1, "http://a.b", None)], "page_id long, url string, fetched_at timestamp")
    events = spark.createDataFrame([], "entry string, action string, op string, at timestamp")
    assert [r["blocked"] for r in url_filter.filter_urls(cap, events).collect()] == [False]
    assert url_filter.filter_urls(cap.limit(0), events).count() == 0
