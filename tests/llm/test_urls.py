import pytest
from pyspark.sql import functions as F

from shopgrain.llm.queries import RULES
from shopgrain.llm.urls import DAMPING, MARGIN, TOLERANCE, judge

URLS = [
    None, "", "no-scheme.net/en/", "http://A.Example.NET/en/1?x=/de/", "http://example.net/EN/1", "https://net/",
    "http://a.net", "ftp://b.com#/x", "http://x.example.com/de/1", "http://x.example.com/dex", "http://y.org/fr/",
    "http://y.org/fr", "http://notexample.net/en/", "x://y://z.net/a", "http://ÀB.org/fr/\nq", "http:///p",
]


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    return "".join(c.lower() if c.isascii() else c for c in rest[:cut]), path[:end]


def brute(rows, rules):
    placed = [(i, *split(u), h or "") for i, u, h in rows]
    ruled = []
    for _, host, path, _ in placed:
        fit = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        ruled.append(max(fit)[1:] if fit else (None, None))
    hosts = {p[1] for p in placed if p[1]}
    share = {
        v: {h: sum(r[1] == v for p, r in zip(placed, ruled) if p[1] == h) / sum(p[1] == h for p in placed) for h in hosts}
        for v in ("allow", "block")
    }
    links = {}
    for _, host, _, html in placed:
        for part in html.split('href="')[1:]:
            dst = split(part.split('"')[0])[0]
            if host and dst and dst != host:
                links[host, dst] = links.get((host, dst), 0) + 1
    scores = {}
    for kind, seed, edges in (
        ("trust", share["allow"], links),
        ("distrust", share["block"], {(b, a): n for (a, b), n in links.items()}),
    ):
        start = {h: (1 - DAMPING) * s for h, s in seed.items()}
        s = dict(start)
        for _ in range(400):
            new = dict(start)
            for (a, b), n in edges.items():
                out = sum(m for (x, _), m in edges.items() if x == a)
                new[b] = new.get(b, 0) + DAMPING * s.get(a, 0) * n / out
            s = new
        scores[kind] = s
    out = []
    for (i, host, path, _), (rule, verdict) in zip(placed, ruled):
        t, d = (scores[k].get(host, 0.0) for k in ("trust", "distrust"))
        out.append((i, host, path, rule, verdict or ("block" if d - t > MARGIN else "allow"), t, d))
    return sorted(out, key=repr)


def check(spark, rows, rules):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x"))
    got = judge(frame, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()
    mine, want = sorted((tuple(r) for r in got), key=repr), brute(rows, rules)
    assert [m[:5] for m in mine] == [w[:5] for w in want]
    assert all(abs(x - y) <= TOLERANCE for m, w in zip(mine, want) for x, y in zip(m[5:], w[5:]))
    return {r.page_id: r for r in got}


def test_rules_and_odd_urls(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(3, URLS[3], ""), (None, "http://y.org/fr/", "")]
    check(spark, rows, RULES)
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert judge(empty, spark.createDataFrame(RULES, "host string, path string, verdict string")).count() == 0


def test_distrust_runs_against_links(spark):
    spam, hub, good = "http://bad.net/x", "http://hub.com/", "http://fine.org/fr/"
    to = lambda *urls: "".join(f'<a class="x" href="{u}">y</a>' for u in urls)
    rows = [(1, spam, to("http://bad2.com/")), (2, hub, to(spam, "//bad.net/z", "/own")), (3, good, to("http://near.com/a"))]
    rows += [(4, "http://near.com/", to(good)), (5, "http://bad2.com/", ""), (6, "http://far.com/", to(hub, good))]
    rows += [(7, "http://bad3.net/", to(hub)), (8, "http://hub.com/2", to(spam, "https://bad3.net/"))]
    got = check(spark, rows, RULES)
    assert got[2].verdict == "block" and got[4].verdict == "allow" and got[4].trust > 0


def test_a_long_chain_is_followed_to_its_end(spark):
    """Thirty hosts in a row pass a seed's distrust back; twelve rounds would not reach the first ones."""
    link = lambda h: f'<a href="http://{h}/">y</a>'
    rows = [(i, f"http://h{i}.com/", link(f"h{i + 1}.com" if i < 29 else "bad.net")) for i in range(30)]
    rows += [(40, "http://bad.net/", "")]
    got = check(spark, rows, RULES)
    assert abs(got[0].distrust - (1 - DAMPING) * DAMPING**30) < TOLERANCE and got[29].verdict == "block"


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_on_pages(spark, folder):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    check(spark, rows, RULES)
