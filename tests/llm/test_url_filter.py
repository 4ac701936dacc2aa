import random
import re
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import duckdb

from sheetlake.llm import url_filter
from sheetlake.llm.queries import ORACLES
from sheetlake.llm.url_filter import RULES, judge

PAGES = [
    (1, "http://A.org/x", '<link rel="canonical" href="http://b.net/es/1">'), (2, "https://b.net/es/1", None),
    (3, "http://c.org/q?z=1#f", '<META http-equiv="refresh" content="0; url=/r">'), (4, "http://c.org/r", "<link href='//a.org/x' rel=canonical>"),
    (5, None, "x"), (6, "nourl", ""), (7, "http://x.com/z", '<link rel=canonical href="http://b.net/es/1">'),
    (8, "HTTP://WWW.Example.COM/en/1", ""), (9, "http://q.example.com/en/2", ""), (10, "http://d.org", ""), (10, "http://d.org", ""),
    (11, "http://e.org/a/b", "<link rel=canonical href=c>"), (12, "http://e.org/a/c", '<link rel=canonical href="?k=1">'),
    (13, "http://e.org/a/c?k=1", '<meta http-equiv=refresh content="5;URL=http://m.net/fr/">'), (None, "http://f.net/es", None),
    (14, "http://com/", None), (15, "http://xexample.com/en/", None), (16, "a://b://c.com/x?y#z", None), (17, "", None),
    (18, "http://g.org/" + "p/" * 20000, "<p>" * 20000), (19, "http://h.net/fr/?u=://i.com/", '<link rel="icon" href="http://b.net/es/1">')]


def test_matches_duckdb(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    con = duckdb.connect()
    con.register("pages", pages.toPandas().astype({"page_id": "Int64"}))
    want = [tuple(None if x is None or x != x else x for x in r) for r in con.sql(ORACLES["op10_url_filter"]).fetchall()]
    got = judge(pages.selectExpr("*", "1 as node", "2 as found", "3 as by_alias", "4 as host"))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    rows = list(map(tuple, got.collect()))
    assert sorted(map(str, rows)) == sorted(map(str, want)) and len(rows) == len(PAGES)
    verdicts = {r[0]: r[4] for r in rows}
    assert [verdicts[i] for i in (1, 3, 4, 7, 11, 12, 13, 10, 19)] == ["block"] * 3 + ["allow"] + ["block"] * 3 + ["allow", "block"]


def test_long_chain_and_hub(spark):
    chain = [(i, f"http://n{i}.org/", f'<link rel=canonical href="http://n{i + 1}.org/">') for i in range(60)]
    hub = [(1000 + i, f"http://s{i}.org/", '<link rel=canonical href="http://hub.net/fr/">') for i in range(300)]
    end = [(999, "http://n60.org/", '<link rel=canonical href="http://z.net/es/1">')]
    got = judge(spark.createDataFrame([*chain, *hub, *end, (5000, "http://ok.org/", "")], "page_id long, url string, html string"))
    assert {r.page_id for r in got.filter("verdict = 'allow'").collect()} == {5000}


class Tags(HTMLParser):
    def __init__(self, url):
        super().__init__()
        self.url, self.links = url, []

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "link" and (a.get("rel") or "").strip().lower() == "canonical" and (a.get("href") or "").strip():
            self.links.append(a["href"].strip())
        if tag == "meta" and (a.get("http-equiv") or "").strip().lower() == "refresh" and "url=" in (a.get("content") or "").lower():
            self.links.append(a["content"][a["content"].lower().index("url=") + 4:].strip())


def parts(url):
    m = re.match(r"([^/?#]*)([^?#]*)", (url or "").partition("://")[2], re.S)
    return (m[1].lower(), m[2]) if "://" in (url or "") else ("", "")


def brute(pages, rules):
    """Union-find over the links of a real HTML parser."""
    def rule(url):
        host, path = parts(url)
        fits = [(len(h) + len(p), v == "allow", h + p, v) for h, p, v in rules
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits) if fits else None

    def key(url):
        s = urlsplit(url)
        return (parts(url)[0], s.path or "/", s.query) if parts(url)[0] else None
    parent, bad = {}, set()

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    known = set()
    for _, url, html in pages:
        tags = Tags(url)
        tags.feed(html or "")
        for link in tags.links if url else []:
            target = urljoin(url, link)
            if key(url) and key(target):
                parent[find(key(url))] = find(key(target))
                known |= {(key(url), url), (key(target), target)}
    for k, url in known:
        if (rule(url) or [None] * 4)[3] == "block":
            bad.add(find(k))
    out = []
    for page_id, url, _ in pages:
        found = rule(url)
        alias = key(url) in parent and find(key(url)) in bad if url and key(url) else False
        out.append((page_id, *parts(url), found and found[2], found[3] if found else "block" if alias else "allow"))
    return out


TRICKY = [
    (1, "http://a1.org/x", "<!-- <link rel=canonical href='http://b.net/es/1'> --><p>"),
    (2, "http://a2.org/x", "<link data-rel=canonical href='http://b.net/es/1'>"),
    (3, "http://a3.org/x", "<link rel=canonical data-href='http://no.org/' href='http://b.net/es/1'>"),
    (4, "http://a4.net/a/b/c", "<link rel=canonical href='../../es/x'>"),
    (5, "http://a5.org/x", "<script>var s = \"<link rel=canonical href='http://b.net/es/1'>\";</script>"),
    (6, "http://a6.org/x", "<link rel=canonical href='http://b.org/?a=1&amp;b=2'>"),
    (7, "http://b.org/?a=1&b=2", "<link rel='canonical' href='http://b.net/fr/./q/../z'>"),
    (8, "http://a8.org/x", "<link rel=canonicals href='http://b.net/es/1'>"),
    (9, "http://a9.org/x", "<linkage rel=canonical href='http://b.net/es/1'><!-- open <link rel=canonical href='http://b.net/es/1'>"),
    (10, "http://a10.org/deep/er/", "<link href='./../../../x/..' rel=canonical>"), (11, "http://a10.org/", "<link rel=canonical href='http://b.net/es/1'>"),
    (12, "http://ok.org/", "<link rel=stylesheet href='http://b.net/es/1'>")]


def test_matches_an_html_parser(spark):
    pages = TRICKY + [p for p in PAGES if p[0] != 16]
    got = judge(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(pages, RULES)))
    assert {r.page_id for r in got if r.verdict == "block"} >= {3, 4, 6, 10, 11}


def test_any_number_of_rules_is_exact(spark, monkeypatch):
    rng = random.Random(3)
    hosts = ["com", "a.com", "b.a.com", "org", "x.org", ""]
    rules = [(rng.choice(hosts), "/" + "".join(rng.choice("ab/") for _ in range(rng.randrange(4))), rng.choice(["allow", "block"]))
             for _ in range(60)] + [("a.com", "", "block"), ("org", "/a", "allow"), ("org", "/a", "block")]
    pages = [(i, f"http://{rng.choice(['', 'q.', 'b.'])}{rng.choice(hosts[:-1])}/{''.join(rng.choice('ab/') for _ in range(5))}", None)
             for i in range(300)] + [(900, None, None), (901, "nourl", None)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    want = sorted(map(str, brute(pages, rules)))
    assert sorted(map(str, map(tuple, judge(df, rules=rules).collect()))) == want
    monkeypatch.setattr(url_filter, "INLINE_RULES", 0)
    assert sorted(map(str, map(tuple, judge(df, rules=rules).collect()))) == want


def test_a_hundred_thousand_rules(spark):
    rules = [("org", f"/{i}/", "block" if i % 2 else "allow") for i in range(100_000)]
    pages = spark.range(500).selectExpr("id as page_id", "concat('http://s', id, '.org/', id * 199, '/x') as url", "cast(null as string) as html")
    got = judge(pages, rules=rules).collect()
    assert {(r.page_id, r.rule, r.verdict) for r in got} == {
        (i, f"org/{i * 199}/", "block" if i % 2 else "allow") for i in range(500)}


def test_empty_and_native(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert judge(none).count() == 0
    plan = judge(none)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
