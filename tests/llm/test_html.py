import random

import pytest
from pyspark.sql import functions as F

from shopgrain.llm.html_text import closeness, common_lines, extract, loose, main_text, parse, without_shared, _Page


def texts(page):
    return [x.text for x in parse(page)]


@pytest.mark.parametrize(
    "page, want",
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<b>b</b> c\n\n d<p>e<br>f &lt;g&gt;", "ab c d e f <g>"),
        ("<body><nav>n</nav><article><h1>T</h1><p>x</article><footer>f", "T x"),
        ("<div class='ad'>buy<article>a</article>", "a"),
        ("<main><div id=comments><div>c</div></div><p>a</main>z", "a"),
        ("<script>var t='</p>';</script><style>p{}</style><!-- <p>no --><p>a", "a"),
        ("<article><header><h1>T</h1></header>x<form>f</form><aside>s</aside></article>", "T x"),
        ("<div class='side-bar'>s</div><header>h</header><p class=leader>a</p>", "a"),
        ("<div class='sidebar x'>s</div><div role=banner>h</div><p>a < b</p>", "a < b"),
        ("<article>a &copy; &nbsp; b &#x41;&#66;</article>", "a © b AB"),
        ('<article>a <a href="x>y">link</a> "q" <img alt=\'>\'>b</article', 'a link "q" b'),
    ],
)
def test_structure(page, want):
    assert main_text(page, None) == want


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next(row, x, b)
    return row[-1]


def _next(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
    return out


@pytest.mark.parametrize("seed", range(30))
def test_common_lines(seed):
    rng = random.Random(seed)
    a, b = (rng.choices("abcd", k=rng.randint(0, 14)) for _ in range(2))
    places = sorted(common_lines(a, b))
    assert len(places) == lcs(a, b)
    rest = iter(b)
    assert all(a[i] in rest for i in places)  # a subsequence of b


def page(i, body):
    return f"<div>Site menu</div><div>Top news</div><p>{body}</p><div>Contact us</div>"


def brute(rows):
    """Nearest URL among all pages of a host, by sorting on the driver."""
    def split(url):
        if url is None or "://" not in url:
            return "", ""
        rest = url.split("://", 1)[1]
        host = rest.split("/")[0].split("?")[0].split("#")[0]
        return host.lower(), rest[len(host) :].split("?")[0].split("#")[0]

    pages = sorted(
        (_Page(0, *split(u), loose(h or ""), h or "", (i, u)) for i, u, h in rows),
        key=lambda p: (p.host, p.path, p.row[0] is not None, p.row[0] or 0),
    )
    out = []
    for k, p in enumerate(pages):
        before = pages[k - 1] if k else None
        after = pages[k + 1] if k + 1 < len(pages) else None
        best = before if closeness(p, before) >= closeness(p, after) else after
        stays = without_shared(p.lines, best.lines) if closeness(p, best) >= 0 else None
        out.append((p.row[0], main_text(p.html, stays)))
    return sorted(out, key=repr)


def test_differencing_across_tasks(spark):
    rows = [(i, f"http://h{i % 3}.org/s{i % 7}/{i:03}", page(i, f"Own text {i}")) for i in range(60)]
    rows += [(100, None, "<p>x"), (101, "nohost", page(1, "y")), (102, "http://solo/", page(1, "z")), (103, "http://e/", None)]
    rows += [(104, "http://h0.org/s0/000", page(0, "Own text 0")), (None, "http://h1.org/a", page(0, "q"))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("t"))
    for parts in ("3", "20", "64"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            got = extract(frame).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert sorted(((r.page_id, r.text) for r in got), key=repr) == brute(rows)
    assert dict((r.page_id, r.text) for r in got)[5] == "Own text 5"
    assert extract(frame.limit(0)).count() == 0


def test_on_pages(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/pages.parquet")
    rows = [(r.page_id, r.url, r.html) for r in frame.collect()]
    got = sorted(((r.page_id, r.text) for r in extract(frame).collect()), key=repr)
    assert got == brute(rows)
    for (_, _, html), (_, text) in zip(sorted(rows), got):
        assert html.count("<article>") == 1 and text
        assert "&copy;" not in text and "©" not in text


def test_shared_lines_inside_an_article_are_deleted(spark):
    def post(i, same):
        own = "".join(f"<p>Line {k} of {same or i}</p>" for k in range(6))
        return f"<nav>n</nav><main><div>Our offers</div>{own}<div>Rate this page</div></main>"

    rows = [(i, f"http://a.org/{i}", post(i, 0)) for i in (1, 2)] + [(i, f"http://b.org/{i}", post(i, 9)) for i in (3, 4)]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == " ".join(f"Line {k} of 1" for k in range(6))
    assert "Line 5 of 9 Rate this page" in got[3] and got[3] == got[4]  # the same article twice


@pytest.mark.parametrize(
    "page, want",
    [
        ("<article>a</article><article class=comment>c<article>d</article></article>", "a"),
        ("<article>a</article><div class=related><article class=card>t</article></div>", "a"),
        ("<div class=ad>x<article>a</article><article class=comment>c</article>", "a"),
        ("<article class=has-sidebar>a</article>", "a"),
    ],
)
def test_articles_that_are_furniture(page, want):
    assert main_text(page, None) == want
