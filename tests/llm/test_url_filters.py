import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyloom.llm.url_filters import filter_urls, host_of, path_of, patterns_of, validity

DAY = dt.date(2021, 1, 1)


def on(n):
    return DAY + dt.timedelta(days=n)


@pytest.mark.parametrize(
    ("url", "host", "segments"),
    [
        ("https://A.Example.org:8080/x/Y/?q=/z#f", "a.example.org", ["x", "Y"]),
        ("http://user:pw@b.com", "b.com", []),
        ("http://b.com./", "b.com", []),
        ("/relative/x", "", []),
        ("", "", []),
    ],
)
def test_parts_of_urls(frame, url, host, segments):
    (r,) = frame("u string", (url,)).select(host_of(F.col("u")), path_of(F.col("u"))).collect()
    assert tuple(r) == (host, segments)


def test_patterns(frame):
    df = frame("u string", ("http://a.b.c.org/x/y/z/w",)).select(patterns_of(host_of(F.col("u")), path_of(F.col("u")), 2))
    assert df.first()[0] == ["a.b.c.org", "b.c.org", "c.org", "a.b.c.org/x", "a.b.c.org/x/y"]


def test_validity(frame):
    rows = [("a.org", "l", "block", on(0)), ("A.org", "l", "remove", on(9)), ("a.org", "l", "allow", on(9)), ("a.org", "l", "remove", on(20)),
            ("a.org", "m", "block", on(3)), ("a.org", "l", "nonsense", on(4)), (None, "l", "block", on(1)), ("b.org", "l", "block", None)]
    got = {tuple(r) for r in validity(frame("pattern string, list string, action string, day date", *rows)).collect()}
    assert got == {("a.org", "l", "block", on(0), on(9)), ("a.org", "l", "allow", on(9), on(20)), ("a.org", "m", "block", on(3), None)}


def test_entries_are_normalised_like_captures(frame):
    """Final and doubled slashes of an entry count no more than those of a URL."""
    written = ["b.org/", "A.org/Foo/", "c.org//x///y", "d.org", "/e.org"]
    entries = [(p, "l", "block", on(0)) for p in written]
    got = validity(frame("pattern string, list string, action string, day date", *entries)).collect()
    assert {r.pattern for r in got} == {"b.org", "a.org/Foo", "c.org/x/y", "d.org", "/e.org"}
    urls = ["http://b.org", "http://www.b.org/x", "http://a.org/Foo/bar", "http://a.org/foo", "http://c.org/x//y/", "http://e.org/"]
    captures = [(n, u, dt.datetime(2021, 5, 1)) for n, u in enumerate(urls)]
    found = filter_urls(
        frame("page_id long, url string, fetch_time timestamp", *captures),
        frame("pattern string, list string, action string, day date", *entries),
    )
    assert {r.page_id: r.verdict for r in found.collect()} == {0: "block", 1: "block", 2: "block", 3: "allow", 4: "block", 5: "allow"}


def by_loops(captures, entries):
    rank = {"remove": 0, "allow": 1, "block": 2}
    out = []
    for i, url, time in captures:
        host = url.split("/")[2] if url and "://" in url else ""
        segments = [s for s in url.split("/")[3:] if s] if host else []
        labels = host.split(".")
        keys = [".".join(labels[k:]) for k in range(max(1, len(labels) - 1))] if host else []
        keys += ["/".join([host, *segments[: n + 1]]) for n in range(min(3, len(segments)))]
        answers = {}
        for key in keys if time else []:
            for name in {e[1] for e in entries if e[0] == key}:
                past = [(e[3], rank[e[2]]) for e in entries if e[0] == key and e[1] == name and e[3] <= time.date()]
                if past and max(past)[1]:
                    since, action = max(past)
                    answers.setdefault(("/" in key, len(key), key, action == 2), []).append((name, since))
        best = max(answers) if answers else None
        out.append(
            (i, url, time, "block" if best and best[3] else "allow", best and best[2],
             sorted({n for n, _ in answers.get(best, [])}), max((s for _, s in answers.get(best, [])), default=None))
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket_days", [1, 64, 5000])
def test_captures_against_loops(frame, bucket_days):
    rnd = random.Random(4)
    hosts = ["a.x.org", "b.x.org", "x.org", "y.net"]
    entries = [
        (rnd.choice([*hosts, "x.org/p", "a.x.org/p/q"]), rnd.choice("lm"), rnd.choice(["block", "allow", "remove"]), on(rnd.randint(0, 300)))
        for _ in range(60)
    ]
    captures = [
        (n, f"http://{rnd.choice(hosts)}/{rnd.choice(['', 'p', 'p/q', 'r'])}", dt.datetime(2020, 12, 20) + dt.timedelta(hours=rnd.randint(0, 8000)))
        for n in range(200)
    ] + [(1, "http://x.org/p", dt.datetime(2021, 3, 1))] * 3 + [(None, None, dt.datetime(2021, 3, 1)), (7, "x", dt.datetime(2021, 3, 1)), (8, "http://x.org/", None)]
    got = filter_urls(
        frame("page_id long, url string, fetch_time timestamp", *captures),
        frame("pattern string, list string, action string, day date", *entries),
        bucket_days=bucket_days,
    ).select("page_id", "url", "fetch_time", "verdict", "pattern", "lists", "since")
    rows = [(*r[:5], list(r[5]), r[6]) for r in got.collect()]
    assert sorted(rows, key=repr) == by_loops(captures, entries)


def test_empty_tables(frame):
    captures = frame("page_id long, url string, fetch_time timestamp, pattern string, _url int", (1, "http://x.org", dt.datetime(2021, 1, 1), "p", 2))
    entries = frame("pattern string, list string, action string, day date, _to int", ("x.org", "l", "block", on(0), 3))
    assert filter_urls(captures, entries).first().verdict == "block"
    assert filter_urls(captures, entries.where("false")).first().verdict == "allow"
    assert filter_urls(captures.where("false"), entries).count() == 0


def judged(frame, patterns, urls):
    captures = frame("page_id long, url string, fetch_time timestamp", *[(n, u, dt.datetime(2021, 3, 1)) for n, u in enumerate(urls)])
    entries = frame("pattern string, list string, action string, day date", *[(p, "l", "block", on(0)) for p in patterns])
    return [r.pattern for r in sorted(filter_urls(captures, entries).collect())]


def test_paths_keep_their_case(frame):
    urls = ["http://A.org/Foo", "http://a.org/foo", "http://a.org/Foo/Bar", "http://b.org/x"]
    assert judged(frame, ["A.Org/Foo", "B.ORG"], urls) == ["a.org/Foo", None, "a.org/Foo", "b.org"]


def test_entries_of_any_depth(frame):
    deep = "a.org/" + "/".join(f"s{n}" for n in range(12))
    urls = [f"http://{deep}", f"http://{deep}/more?q", "http://a.org/s0/s1/s2/s3/s4", "http://a.org/s0/s1/s2/s3x"]
    assert judged(frame, [deep, "a.org/s0/s1/s2/s3"], urls) == [deep, deep, "a.org/s0/s1/s2/s3", None]
    assert judged(frame, ["a.org"], urls) == ["a.org"] * 4
