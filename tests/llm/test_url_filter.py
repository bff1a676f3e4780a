"""The URL filter against its SQL and against PageRank in plain Python."""
import re

import duckdb
import pyarrow.parquet as pq
import pytest

from kenning.llm import url_filter as U
from kenning.llm.queries import ORACLE, URL_RULES

PAGES = [
    (1, "https://A.example.COM/fr/1?x=/de/", '<a href="https://b.net/x">b</a> <a href="/local">l</a>'),
    (2, "https://a.example.com/en/2", "<a href='//c.net'>c</a>"),
    (3, "http://spam.com/de/1#f", '<a href="https://spam2.net/">s</a>'),
    (4, "http://spam2.net/x", '<A class="x > y" HREF = https://spam.com/de/7>s</A>'),
    (5, "https://b.net/", '<!-- <a href="https://spam.com/">no</a> --><a href="https://c.net/">c</a>'),
    (6, "https://c.net/", '<script>var s = \'<a href="https://spam.com/">\';</script><a href="https://b.net">b</a>'),
    (7, "https://both.net/", '<a href="http://spam.com/a"></a><a href="http://spam.com/b"></a><a href="http://b.net"></a>'),
    (8, "https://alone.net/", "no links <abbr href='http://spam.com'>"),
    (9, "https://example.org/es/", ""), (10, "https://x.example.org/en/19", None), (11, "https://x.example.org/en/2", None),
    (12, "https://example.org", None), (13, "notexample.org/es/", "<a href='http://spam.com'>"), (14, None, None), (15, "", "x"),
    (16, "https://xexample.org/es/1", None), (17, "ftp://www.example.org/es/a/b?q", None), (18, "a://b://c/d", "<a href=//u.net>"),
    (None, "http://spam.com/de/1#f", '<area href="https://spam2.net/">'), (1, "https://A.example.COM/fr/1?x=/de/", "<a href=//b.net"),
    (19, "http://late.net/", "<a href='http://spam2.net'>" + "x" * 300000 + "<a href='http://u.net'>"),
]


@pytest.fixture(scope="module")
def pages(lspark):
    df = lspark.createDataFrame([(*p, "clash") for p in PAGES], "page_id bigint, url string, html string, host string")
    for c in ("id", "verdict", "rule", "part", "trust", "src", "mass", "kind"):
        df = df.selectExpr("*", f"'clash' as {c}")
    return df


def plain_ranks(links, seeds, damping=U.DAMPING, steps=U.STEPS):
    """links: {(src, dst): n}; seeds: {host: weight}."""
    whole = sum(seeds.values())
    mass = {h: w / whole for h, w in seeds.items()} if whole else {}
    total = dict(mass)
    out = {}
    for (s, _), n in links.items():
        out[s] = out.get(s, 0) + n
    for _ in range(steps):
        step = {}
        for (s, d), n in links.items():
            if s in mass:
                step[d] = step.get(d, 0) + damping * mass[s] * n / out[s]
        for h, m in step.items():
            total[h] = total.get(h, 0) + m
        mass = step
    return total


def test_rules(pages):
    got = {(r.page_id, r.host, r.path): (r.rule, r.verdict) for r in U.judge_urls(pages, URL_RULES).collect()}
    assert got[1, "a.example.com", "/fr/1"] == ("com/fr/", "allow")
    assert got[3, "spam.com", "/de/1"] == ("com/de/", "block")
    assert got[9, "example.org", "/es/"] == ("example.org/es/", "block")
    assert got[10, "x.example.org", "/en/19"] == ("example.org/en/1", "block")
    assert got[11, "x.example.org", "/en/2"] == ("org/", "allow")
    assert got[12, "example.org", ""][0] is None and got[2, "a.example.com", "/en/2"][0] is None
    assert got[13, "", ""] == got[14, "", ""] == got[15, "", ""] == (None, "allow")
    assert got[16, "xexample.org", "/es/1"] == ("org/", "allow")
    assert got[17, "www.example.org", "/es/a/b"] == ("example.org/es/", "block")
    assert got[18, "b:", "//c/d"] == (None, "allow")
    assert got[4, "spam2.net", "/x"] == (None, "block")  # links to a blocked host
    assert got[7, "both.net", "/"] == got[19, "late.net", "/"] == (None, "block")
    assert got[5, "b.net", "/"] == got[6, "c.net", "/"] == got[8, "alone.net", "/"] == (None, "allow")


def test_links(pages):
    from pyspark.sql import functions as F
    got = {(r.src, r.dst): r.n for r in U.host_links(pages.select("url", "html"), U.host_of(F.col("url")), F.col("html")).collect()}
    assert got == {("a.example.com", "b.net"): 2, ("a.example.com", "c.net"): 1, ("spam.com", "spam2.net"): 2,
                   ("spam2.net", "spam.com"): 1, ("b.net", "c.net"): 1, ("c.net", "b.net"): 1, ("both.net", "spam.com"): 2,
                   ("both.net", "b.net"): 1, ("late.net", "spam2.net"): 1, ("late.net", "u.net"): 1, ("b:", "u.net"): 1}


@pytest.mark.parametrize("slot", [1, 100])
def test_ranks_against_plain_loop(lspark, slot):
    hosts = [f"h{i}" for i in range(12)]
    links = {(a, b): 1 + (i * j) % 4 for i, a in enumerate(hosts) for j, b in enumerate(hosts) if a != b and (i * 5 + j * 3) % 7 < 2}
    seeds = {"h0": (3.0, 0.0), "h3": (1.0, 2.0), "h5": (0.0, 1.0), "outside": (0.0, 4.0)}
    got = {r.host: (r.trust, r.distrust) for r in U.host_ranks(
        lspark.createDataFrame([(*k, n) for k, n in links.items()], "src string, dst string, n bigint"),
        lspark.createDataFrame([(h, *w) for h, w in seeds.items()], "host string, trust double, distrust double"),
        steps=8, slot=slot).collect()}
    trust = plain_ranks(links, {h: t for h, (t, _) in seeds.items()}, steps=8)
    distrust = plain_ranks({(d, s): n for (s, d), n in links.items()}, {h: d for h, (_, d) in seeds.items()}, steps=8)
    for h in {*trust, *distrust}:
        if trust.get(h, 0) or distrust.get(h, 0):
            assert got[h] == pytest.approx((trust.get(h, 0), distrust.get(h, 0)))
    assert set(got) == {h for h in {*trust, *distrust} if trust.get(h, 0) or distrust.get(h, 0)}


def test_against_sql(pages, tmp_path):
    path = str(tmp_path / "pages.parquet")
    pq.write_table(pages.select("page_id", "url", "html").toArrow(), path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{path}')")
    want = con.execute(ORACLE["op11_url_filter"]).fetchall()
    got = U.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_and_hostile(lspark, pages):
    assert U.judge_urls(pages.limit(0), URL_RULES).count() == 0
    assert [r.verdict for r in U.judge_urls(pages.limit(1), []).collect()] == ["allow"]
    rows = [(1, "http://x.org/", "<a " * 200000), (2, "http://y.org/", "<a href=\"" * 100000), (3, "http://z.org/", "<!--" * 100000),
            (4, "http://w.org/", "<script>" * 100000), (5, "http://v.org/", "<a " + "b " * 300000 + "href=//q.net>")]
    df = lspark.createDataFrame(rows, "page_id bigint, url string, html string")
    assert {r.verdict for r in U.judge_urls(df, URL_RULES).collect()} == {"allow"}


def test_no_python_in_the_plan(pages):
    plan = U.judge_urls(pages.select("page_id", "url", "html"), URL_RULES)._jdf.queryExecution().toString()
    assert not re.search("Arrow|Python|Pandas", plan)
