"""Main text of web pages by differencing each page against its nearest URL on the same host."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopgrain.llm.common import partitions, shards
from shopgrain.llm.urls import host_of, path_of

BATCH_BYTES = 4 << 20
#: An article that has this share of its lines in common with its partner's is a near copy of it.
COPY_SHARE = 0.5

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][\w:-]*)(?P<attrs>(?:\"[^\"<]*\"|'[^'<]*'|[^'\">])*|[^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S,
)
ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

#: Elements whose content is never text of a page.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "object", "math"}
#: Elements that hold no part of an article.
OUTER = {"nav", "aside", "footer", "form", "menu", "button", "select", "dialog", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"}
#: Words in a class or id that mark page furniture; they must be a whole part of the name.
NAMES = re.compile(
    r"(?:^|[\s_-])(?:nav\w*|menus?|header|footer|sidebars?|side|widgets?|ads?|adverts?|advertisement"
    r"|sponsor(?:ed)?|promos?|banners?|cookies?|consent|notices?|alerts?|popups?|modals?|overlay"
    r"|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|comments?|replies"
    r"|respond|disqus|breadcrumbs?|pagination|pager|toolbar|masthead|copyright|disclaimer|skip)(?:$|[\s_-])",
    re.I,
)
ARTICLE = {"article", "main"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
BLOCKS = set(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option "
    "p pre section select summary table tbody td tfoot th thead tr ul".split()
)


@dataclass
class Line:
    """A block of text; whether it stands in the article, and whether in page furniture.

    ``outer``: furniture begun since the last article opened, or an article that is furniture itself;
    ``around``: any furniture, also what an article stands in.
    """

    text: str
    inside: bool
    outer: bool
    around: bool


@dataclass
class _Furniture:
    tag: str = ""  # the element that opened the furniture, and how deep it is nested in itself
    depth: int = 0

    def begin(self, tag: str) -> None:
        self.tag, self.depth = tag, 1

    def shut(self, tag: str) -> None:
        if self.tag and (tag == self.tag or tag == "body"):
            self.depth -= 1
            if self.depth <= 0 or tag == "body":
                self.tag = ""


@dataclass
class _Parser:
    lines: list[Line] = field(default_factory=list)
    words: list[str] = field(default_factory=list)
    inside: int = 0
    outer: _Furniture = field(default_factory=_Furniture)
    around: _Furniture = field(default_factory=_Furniture)

    def flush(self) -> None:
        text = " ".join("".join(self.words).split())
        if text:
            self.lines.append(Line(text, self.inside > 0, bool(self.outer.tag), bool(self.around.tag)))
        self.words = []

    def open(self, tag: str, attrs: str) -> None:
        if tag in BLOCKS:
            self.flush()
        begins = tag not in VOID and tag not in ("body", "html") and self.furniture(tag, attrs)
        if tag in ARTICLE:
            self.inside += 1
            if not begins and self.outer.tag not in ARTICLE:
                self.outer.tag = ""  # the article may be right though it stands in furniture, see main_text
        for kind in (self.outer, self.around):
            if kind.tag:
                kind.depth += tag == kind.tag
            elif begins:
                kind.begin(tag)

    def furniture(self, tag: str, attrs: str) -> bool:
        if tag in OUTER or tag == "header" and not self.inside:
            return True
        for m in ATTR.finditer(attrs):
            value = m[2] or m[3] or m[4] or ""
            if value.lower() in ROLES if m[1].lower() == "role" else NAMES.search(value):
                return True
        return False

    def shut(self, tag: str) -> None:
        if tag in BLOCKS:
            self.flush()
        if tag in ARTICLE:
            self.inside = max(0, self.inside - 1)
        self.outer.shut(tag)
        self.around.shut(tag)


def parse(page: str) -> list[Line]:
    """The blocks of a page in order, character references decoded and white space evened."""
    p, at, raw = _Parser(), 0, re.compile("")
    while m := MARKUP.search(page, at):
        p.words.append(html.unescape(page[at : m.start()]))
        at = m.end()
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if m["close"]:
            p.shut(tag)
        elif tag in RAW and not m["attrs"].endswith("/"):
            raw = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I)
            end = raw.search(page, at)
            at = end.end() if end else len(page)
        else:
            p.open(tag, m["attrs"])
    p.words.append(html.unescape(page[at:]))
    p.flush()
    return p.lines


def common_lines(a: list[str], b: list[str]) -> set[int]:
    """Places in ``a`` of a longest common subsequence of lines, in linear memory (Hirschberg)."""
    codes = {t: i for i, t in enumerate(dict.fromkeys([*a, *b]))}
    x, y = (np.array([codes[t] for t in s], np.int64) for s in (a, b))

    def lengths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        row = np.zeros(len(y) + 1, np.int64)
        for c in x:
            better = np.where(y == c, row[:-1] + 1, row[1:])
            row[1:] = np.maximum.accumulate(np.maximum(better, row[1:]))
        return row

    found: set[int] = set()
    todo = [(0, len(x), 0, len(y))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and x[a0] == y[b0]:
            found.add(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and x[a1 - 1] == y[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.add(a1)
        if a0 == a1 or b0 == b1:
            continue
        if a1 - a0 == 1:
            if (y[b0:b1] == x[a0]).any():
                found.add(a0)
            continue
        mid = (a0 + a1) // 2
        head = lengths(x[a0:mid], y[b0:b1])
        tail = lengths(x[mid:a1][::-1], y[b0:b1][::-1])[::-1]
        cut = b0 + int((head + tail).argmax())
        todo += [(a0, mid, b0, cut), (mid, a1, cut, b1)]
    return found


def without_shared(own: list[str], other: list[str]) -> list[bool]:
    """Which of a page's lines stay after differencing against its partner, lines as ``loose`` gives them.

    A partner with the very same loose lines is a copy and says nothing about furniture unless
    nothing else can tell the pages apart; its loose lines are then kept. Lines of an article are compared
    with lines of the partner's article, and kept if COPY_SHARE of them are common: the same article.
    """
    stays = [True] * len(own)
    for kind in (LOOSE, INSIDE):
        places = [i for i, x in enumerate(own) if x[0] == kind]
        a, b = [own[i] for i in places], [x for x in other if x[0] == kind]
        if a == b or not b:
            continue
        shared = common_lines(a, b)
        if kind == INSIDE and len(shared) >= COPY_SHARE * len(a):
            continue
        for i in shared:
            stays[places[i]] = False
    return stays


def structure(lines: list[Line]) -> list[bool]:
    """The lines of the article, of an article within furniture if there is no other, or the loose
    lines that are no furniture; what is named like furniture only if the page has nothing else."""
    for article in (
        [x.inside and not x.outer and not x.around for x in lines],
        [x.inside and not x.outer for x in lines],
        [not x.inside and not x.outer for x in lines],
    ):
        if any(article):
            return article
    return [x.inside for x in lines]


def main_text(page: str, stays: list[bool] | None) -> str:
    """Lines of the article, or of a page without one, that are neither shared nor furniture."""
    lines = parse(page)
    kept = zip(lines, structure(lines), stays or [True] * len(lines))
    return " ".join(x.text for x, right, stay in kept if right and stay)


LOOSE, INSIDE = "-", "+"


def loose(page: str) -> list[str]:
    """The lines that differencing looks at, each after a sign that tells whether it stands in an article."""
    return [(INSIDE if x.inside else LOOSE) + x.text for x in parse(page)]


@dataclass
class _Page:
    index: int
    host: str
    path: str
    lines: list[str]
    html: str
    row: tuple


def closeness(a: _Page, b: _Page | None) -> int:
    """Characters that two paths begin with alike; -1 on different hosts or without a host."""
    if b is None or not a.host or a.host != b.host:
        return -1
    return len(commonprefix([a.path, b.path]))


def neighbours(pages: Iterator[_Page], parsed: bool) -> Iterator[tuple[_Page | None, _Page, _Page | None]]:
    """Each page with the one before and the one after; ``parsed``: with their loose lines."""
    before, own = None, None
    for after in pages:
        if parsed:
            after.lines = loose(after.html)
        if own is not None:
            yield before, own, after
        before, own = own, after
    if own is not None:
        yield before, own, None


def extract(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``id_col``, ``url_col``, ``text`` of each page.

    Pages are sorted by host and path over all tasks, so a page's nearest URL is the one before or
    after it, whichever path begins longer alike (the one before, if equal). Lines on a longest common
    subsequence with that page are deleted, inside and outside of articles, but those of an article that
    shares half of its lines: the same article under two URLs is no furniture. What is left of
    page furniture is dropped by element, role and class. The first and last page of each task are compared across
    tasks afterwards.

    Null html is empty and has no text; a null url, or one without a host, has no partner; equal
    URLs are ordered by id, null first; repeated rows are partners like others. An empty table
    gives no rows.
    """
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("text"),
        host_of(F.col(url_col)).alias("host"),
        path_of(F.col(url_col)).alias("path"),
    )
    kind = rows.schema["id"].dataType.simpleString()
    # Sorted once; a fixed number of tasks, so that both passes below number them alike.
    ranged = rows.repartitionByRange(partitions(pages.sparkSession), "host", "path", "id").sortWithinPartitions(
        "host", "path", "id"
    )

    def pages_of(batches: Iterator[pa.RecordBatch]) -> Iterator[_Page]:
        index = 0
        for b in shards(batches, BATCH_BYTES):
            ids, urls, texts, hosts, paths = (b.column(i) for i in range(5))
            for i in range(b.num_rows):
                yield _Page(index, hosts[i].as_py(), paths[i].as_py(), [], texts[i].as_py(), (ids[i], urls[i]))
                index += 1

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held: list[dict] = []
        size = 0
        for before, own, after in neighbours(pages_of(batches), parsed=True):
            near = max((closeness(own, before), 1, before), (closeness(own, after), 0, after), key=lambda x: x[:2])
            stays = without_shared(own.lines, near[2].lines) if near[0] >= 0 else None
            text = main_text(own.html, stays)
            held.append({"id": own.row[0].as_py(), "url": own.row[1].as_py(), "text": text, "part": part, "nth": own.index})
            size += len(text)
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(held, done_schema)
                held, size = [], 0
        yield pa.RecordBatch.from_pylist(held, done_schema)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for before, own, after in neighbours(pages_of(batches), parsed=False):
            if before is None or after is None:
                close = max(closeness(own, before), closeness(own, after))
                found = (part, own.index, close, own.host, own.path, own.html, loose(own.html))
                yield pa.RecordBatch.from_pylist([dict(zip(ends_schema.names, found))], ends_schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    done_ddl = f"id {kind}, url string, text string, part int, nth long"
    ends_ddl = "part int, nth long, close int, host string, path string, html string, lines array<string>"
    done_schema, ends_schema = (to_arrow_schema(StructType.fromDDL(d)) for d in (done_ddl, ends_ddl))
    done = ranged.mapInArrow(difference, done_ddl)
    edges = ranged.mapInArrow(ends, ends_ddl)
    # Two pages a task at most, in the tasks' order.
    order = Window.orderBy("part", "nth")
    beside = edges.select(
        "part",
        "nth",
        "close",
        "host",
        "path",
        "html",
        "lines",
        *(
            F.struct(f(c).over(order).alias("part"), f("host").over(order).alias("host"),
                     f("path").over(order).alias("path"), f("lines").over(order).alias("lines")).alias(n)
            for n, f, c in (("before", F.lag, "part"), ("after", F.lead, "part"))
        ),
    )

    def mend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                own = _Page(0, r["host"], r["path"], r["lines"], r["html"], ())
                best = None
                for side, better in (("before", 1), ("after", 0)):
                    x = r[side]
                    if x["part"] is None or x["part"] == r["part"]:
                        continue  # no page there, or compared in its task already
                    other = _Page(0, x["host"], x["path"], x["lines"], "", ())
                    close = closeness(own, other)
                    wins = close > r["close"] or close == r["close"] >= 0 and better
                    if wins and (best is None or close > best[0]):
                        best = (close, other)
                if best:
                    text = main_text(own.html, without_shared(own.lines, best[1].lines))
                    out.append({"part": r["part"], "nth": r["nth"], "mended": text})
            yield pa.RecordBatch.from_pylist(out, mended_schema)

    mended_ddl = "part int, nth long, mended string"
    mended_schema = to_arrow_schema(StructType.fromDDL(mended_ddl))
    mended = beside.mapInArrow(mend, mended_ddl)
    return done.join(F.broadcast(mended), ["part", "nth"], "left").select(  # two rows a task
        F.col("id").alias(id_col), F.col("url").alias(url_col), F.coalesce("mended", "text").alias("text")
    )
