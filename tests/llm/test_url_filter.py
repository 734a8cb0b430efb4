import re
from collections import defaultdict

import pytest

from netvitals.llm.url_filter import RULES_DDL, judge_urls, rounds_for

PAGES = "page_id long, url string, html string"
RULES = [
    ("org", "/", "allow"), ("bad.org", "/", "block"), ("ok.bad.org", "/x", "allow"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"), ("Shop.net", "/a", "block"), ("shop.net", "", "allow"), (None, "/", "block"),
]


def link(*hosts):
    return "<p>" + " ".join(f'<a class="k" href="https://{h}/p">x</a>' for h in hosts)


ROWS = [
    (1, "http://good.org/a", link("friend.example", "friend.example", "other.example")),
    (2, "https://GOOD.org/b?x=://z/y", link("friend.example") + '<A  HREF = //Far.Example:80/?q>' + "<a href='/own'>"),
    (3, "http://bad.org/", None),
    (4, "http://www.bad.org/x#t", ""),
    (5, "http://ok.bad.org/xy", "<a href=http://nowhere.test>"),
    (6, "http://farm.example/1", link("bad.org", "www.bad.org")),
    (7, "http://farm.example/2", link("hub.example")),
    (8, "http://hub.example/3", link("farm.example", "bad.org", "friend.example")),
    (9, "http://friend.example/x", link("good.org")),
    (10, "http://m.com/fr/1", None), (11, "http://m.com/de/1", None), (12, "http://m.com/en/1", None),
    (13, "http://n.com/de/1", None), (14, "http://n.com/en", None), (15, "http://sub.n.com/en", None),
    (16, "http://shop.net/abc", None), (17, "http://shop.net", None), (18, "http://x.shop.net?a/b", None),
    (19, "http://net/", None), (20, "http://myshop.net/a", None), (21, "http://far.example:80/", None),
    (22, None, link("bad.org")), (23, "", ""), (24, "no scheme/x", link("good.org")), (25, "x://", None),
    (1, "http://good.org/a", link("friend.example")), (None, "ftp://10.0.0.1/de/", link("bad.org")),
    (26, "http://" + "a." * 3000 + "com/de/", None), (27, "http://lone.example.test/", "<a " * 2000 + "<a href=" * 2000),
]


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def fitting(host, path, rules):
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in ((h and h.lower(), p, v) for h, p, v in rules)
        if h and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[2:] if fits else (None, None)


def brute(rows, rules, kin=0.25, damping=0.85, tolerance=1e-3):
    pages = [(i, *split_url(u), h) for i, u, h in rows]
    counts, own = defaultdict(lambda: defaultdict(int)), defaultdict(lambda: [0, 0, 0])
    for _, host, path, html in pages:
        verdict = fitting(host, path, rules)[1]
        own[host][0] += 1
        own[host][1] += verdict == "allow"
        own[host][2] += verdict == "block"
        found = re.findall(r"""(?i)<a\s[^<>]*?\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\s]+)""", html or "")
        for to in {t.lower() for t in found} - {host}:
            if host:
                counts[host][to] += 1
    weight = defaultdict(lambda: defaultdict(float))
    for a, to in counts.items():
        for b, n in to.items():
            weight[a][b] += n / sum(to.values())
    near = defaultdict(set)
    for host in {*own, *(b for to in counts.values() for b in to)}:
        if not host or len(host) > 253 or re.search(r"(^|\.)\d+(:\d+)?$", host):
            continue
        while host.count(".") >= 2:
            up = host.split(".", 1)[1]
            near[host].add(up)
            near[up].add(host)
            host = up
    for a, to in near.items() if kin else ():
        for b in to:
            weight[a][b] += kin / len(to)
    edges = [(a, b, w / sum(to.values())) for a, to in weight.items() for b, w in to.items()]
    into = defaultdict(float)
    for _, b, w in edges:
        into[b] += w
    scores = []
    for k, flows in ((1, edges), (2, [(b, a, w / into[b]) for a, b, w in edges])):
        seed = {h: n[k] / n[0] for h, n in own.items()}
        x = {h: (1 - damping) * s for h, s in seed.items()}
        for _ in range(rounds_for(damping, tolerance)):
            y = defaultdict(float, {h: (1 - damping) * s for h, s in seed.items()})
            for a, b, w in flows:
                y[b] += damping * w * x.get(a, 0)
            x = y
        scores.append(x)
    out = []
    for i, host, path, _ in pages:
        rule, verdict = fitting(host, path, rules)
        t, d = (round(x.get(host, 0), 9) for x in scores)
        out.append((i, host, path, rule, verdict or ("block" if d - (t + d) / 2 > 1e-9 else "allow")))
    return out


def judged(spark, rows, rules, **kw):
    frame = judge_urls(spark.createDataFrame(rows, PAGES), spark.createDataFrame(rules, RULES_DDL), **kw)
    return [tuple(r) for r in frame.select("page_id", "host", "path", "rule", "verdict").collect()]


def test_results_equal_brute_force(spark):
    got, want = judged(spark, ROWS, RULES), brute(ROWS, RULES)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    by = {r[0]: r[4] for r in want}
    # trust along links, distrust against them, kin both ways, rules before either
    assert [by[i] for i in (9, 21, 6, 7, 8, 15, 12, 5, 3)] == [
        "allow", "allow", "block", "block", "block", "block", "allow", "allow", "block",
    ]


def test_links_alone(spark):
    got, want = judged(spark, ROWS, RULES, kin=0.0), brute(ROWS, RULES, kin=0.0)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert {r[0]: r[4] for r in want}[15] == "allow"


@pytest.mark.parametrize("rules", [[], RULES[3:5]])
def test_few_rules_and_empty_tables(spark, rules):
    assert judged(spark, [], rules) == []
    got = judged(spark, ROWS[:12], rules)
    assert sorted(got, key=repr) == sorted(brute(ROWS[:12], rules), key=repr)


def test_clashing_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", None, "old", "k")], PAGES + ", host string, `row.x` string")
    row = judge_urls(pages, spark.createDataFrame(RULES, RULES_DDL)).first().asDict()
    assert (row["host"], row["row.x"], row["rule"], row["verdict"]) == ("a.org", "k", "org/", "allow")
    assert row["trust"] > 0 == row["distrust"]
