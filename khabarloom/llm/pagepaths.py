"""Problem 6 for pages that still have their tags: consensus host paths.

Every container of a page is scored by the running text that stands in it: each block of text gives
points by length and sentence marks, less what of it is links, all to its container and half to
the one around it. A page votes for the path of its best container, the tags and generalised classes
from the root down to it (digits alike, names that are numbers or hashes left out). Votes are
counted over the distinct pages of a host; the paths that win a share of them are the host's. Each
page is then read again by the winning path it has, the one of most votes if it has several, so a
page whose own best container is an odd one (a long comment, an empty story) follows its host, and a
host of very few pages the others. Pages with no winning path are read by their own best container.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khabarloom.functions.html import Node, parse_html
from khabarloom.functions.text import clean_text
from khabarloom.runtime import cut

#: A path is a host's from this share of its distinct pages, so a host has at most twenty; a host of fewer pages than these has none.
LEAST_SHARE, LEAST_PAGES = 0.05, 3
#: Characters from which a block of text gives points, and the share of links from which it is none.
LEAST_BLOCK, MOST_LINKS = 25, 0.5

# Elements that hold blocks, that are blocks of text, and that never hold the story.
CONTAINERS = frozenset("body div section article main td center blockquote figure".split())
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dd dt figcaption".split())
NEVER = frozenset("script style noscript template nav aside footer header form button select iframe svg".split())

_DIGITS = re.compile(r"\d+")
_HASHED = re.compile(r"^(?=.*\d)(?=.*[a-z])[a-z\d]{6,}$|^\d+$", re.I)
_MARKS = re.compile("[।.,;?!]")


def step_of(node: Node) -> str:
    """A node as a step of a path: its tag and its generalised classes in order."""
    names = (node.attrs.get("class") or "").split()
    kept = sorted({_DIGITS.sub("0", c.lower()) for c in names if not _HASHED.match(c)})
    return ".".join([node.tag, *kept])


def _own_text(node: Node, links: bool = False) -> str:
    """Text of a node without elements that never hold the story; ``links``: only what links say."""
    out: list[str] = []
    stack: list[tuple[Node | str, bool]] = [(node, not links)]
    while stack:
        n, counts = stack.pop()
        if isinstance(n, str):
            if counts:
                out.append(n)
        elif n.tag not in NEVER:
            inside = counts or n.tag == "a"
            stack.extend((c, inside) for c in reversed(n.children))
            if n.tag in ("br", *BLOCKS):
                out.append(" ")
    return " ".join("".join(out).split())


def _blocks(container: Node) -> list[Node | str]:
    """The blocks of text below a container in page order: text elements, and bare text between them."""
    out: list[Node | str] = []
    stack: list[Node | str] = list(reversed(container.children))
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            if n.strip():
                out.append(n)
        elif n.tag in NEVER:
            continue
        elif n.tag in BLOCKS:
            out.append(n)
        else:
            stack.extend(reversed(n.children))
    return out


def _points(text: str, linked: str) -> float:
    if len(text) < LEAST_BLOCK or len(linked) > MOST_LINKS * len(text):
        return 0.0
    return (1 + min(len(text) / 100, 3) + min(len(_MARKS.findall(text)), 5)) * (1 - len(linked) / len(text))


def _holders(tree: Node) -> Iterator[tuple[Node, str]]:
    """Every container outside elements that never hold the story, with its path."""
    stack: list[tuple[Node, str]] = [(n, step_of(n)) for n in reversed(tree.elements())]
    while stack:
        n, path = stack.pop()
        if n.tag in NEVER:
            continue
        if n.tag in CONTAINERS:
            yield n, path
        stack.extend((c, f"{path}>{step_of(c)}") for c in reversed(n.elements()))


def best_container(tree: Node) -> tuple[str, Node | None, float]:
    """(path, node, points) of the container of most points; the first one at a tie, ("", None, 0) if no block has any."""
    points: dict[int, float] = {}
    held = {id(n): (n, path) for n, path in _holders(tree)}
    for n, _ in held.values():
        for child in n.children:
            if isinstance(child, str):
                got = _points(" ".join(child.split()), "")
            elif child.tag in BLOCKS and child.tag not in CONTAINERS:
                got = _points(_own_text(child), _own_text(child, links=True))
            elif child.tag in ("ul", "ol", "dl"):
                got = sum(_points(_own_text(x), _own_text(x, links=True)) for x in child.elements())
            else:
                continue
            if got:
                points[id(n)] = points.get(id(n), 0.0) + got
                up = n.parent
                while up is not None and id(up) not in held:
                    up = up.parent
                if up is not None:
                    points[id(up)] = points.get(id(up), 0.0) + got / 2
    if not points:
        return "", None, 0.0
    best = max(held, key=lambda k: points.get(k, 0.0))
    return held[best][1], held[best][0], points[best]


def container_text(node: Node | None) -> str:
    """The container's blocks, one to a line, without those that are mostly links."""
    lines = []
    for b in _blocks(node) if node is not None else []:
        text = " ".join(b.split()) if isinstance(b, str) else _own_text(b)
        linked = "" if isinstance(b, str) else _own_text(b, links=True)
        if text and len(linked) <= MOST_LINKS * len(text):
            lines.append(clean_text(text))
    return "\n".join(x for x in lines if x)


def page_votes(pages: DataFrame, host: str, html: str) -> DataFrame:
    """(host, path, page, points): the path of each page's best container; ``page`` names the page's text."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                path, _, points = best_container(parse_html(t)) if t else ("", None, 0.0)
                if path:
                    out.append((h, path, points, xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63)))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.string(), pa.float64(), pa.int64()))], names=["host", "path", "points", "page"])

    return pages.select(F.col(host).cast("string"), F.col(html)).mapInArrow(rows, "host string, path string, points double, page bigint")


def host_paths(pages: DataFrame, host: str = "host", html: str = "html", least_share: float = LEAST_SHARE) -> DataFrame:
    """(host, path, votes): the paths that win at least ``least_share`` of a host's distinct pages; a vote weighs its points.

    Pages are reduced to (host, path) counts in two steps that combine before they are shuffled.
    """
    each = page_votes(pages, host, html).groupBy("host", "path", "page").agg(F.max("points").alias("points"))
    votes = cut(each.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("points").alias("votes")), "container-votes")
    total = votes.groupBy(F.col("host").alias("_h")).agg(F.sum("n").alias("all"))
    both = votes.join(total, F.col("host").eqNullSafe(F.col("_h")))
    return both.filter((F.col("n") >= least_share * F.col("all")) & (F.col("all") >= LEAST_PAGES)).select("host", "path", "votes")


def common_paths(paths: DataFrame, least_share: float = LEAST_SHARE) -> list[str]:
    """The paths with at least ``least_share`` of all hosts' votes, most votes first: twenty at most, for hosts without paths of their own."""
    n = cut(paths.groupBy("path").agg(F.sum("votes").alias("v")), "common-paths")
    all_ = n.agg(F.sum("v")).first()[0] or 0.0
    rows = n.filter(F.col("v") >= least_share * all_).collect()
    return [r.path for r in sorted(rows, key=lambda r: (-r.v, r.path))]


def page_texts(pages: DataFrame, paths: DataFrame, keep: list[str], host: str = "host", html: str = "html") -> DataFrame:
    """``keep`` and (path, text): each page's main text, by its host's winning path.

    A host's paths, at most twenty, come as one list beside its pages; a host with too few pages
    follows the paths common to the others. A NULL or empty page, or one
    without a block of text, has path NULL and text ''. Other columns are ignored.
    """
    lists = paths.groupBy(F.col("host").alias("_h")).agg(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))).alias("_won"))
    src = pages.select(*keep, F.col(host).cast("string").alias("_host"), F.col(html).alias("_html")).join(lists, F.col("_host").eqNullSafe(F.col("_h")), "left")
    src = src.select(*keep, "_html", F.transform("_won", lambda x: x["path"]).alias("_won"))
    k = len(keep)
    common = common_paths(paths)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, texts = [], []
            for t, won in zip(b.column(k).to_pylist(), b.column(k + 1).to_pylist()):
                path, node = "", None
                if t:
                    tree = parse_html(t)
                    there: dict[str, list[Node]] = {}
                    for n, p in _holders(tree):
                        there.setdefault(p, []).append(n)
                    path = next((p for p in won or common if p in there), "")
                    if path:
                        text = "\n".join(x for x in map(container_text, there[path]) if x)
                    else:
                        path, node, _ = best_container(tree)
                        text = container_text(node)
                found.append(path or None)
                texts.append(text if t and path else "")
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(found, pa.string()), pa.array(texts, pa.string())], names=[*keep, "path", "text"])

    head = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:k])
    return src.mapInArrow(rows, head + "path string, text string")


def as_pages(articles: DataFrame) -> DataFrame:
    """(article_id, host, html): articles written as pages, each with a menu, teasers, a notice and a footer around its story."""
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    paras = F.array_join(F.transform(F.split("body", "\n", -1), lambda x: F.concat(F.lit("<p>"), esc(x), F.lit("</p>"))), "")
    title = esc(F.col("title"))
    page = F.concat(
        F.lit("<html><head><title>"), title, F.lit("</title><script>var a = 'long text, that is no text. None at all.';</script></head><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></nav>"),
        F.lit("<div class='page'><div class='col-8'><div class='story-"), F.col("article_id").cast("string"), F.lit(" story-body'>"), paras, F.lit("</div><div class='share'><p><a href='/s'>Share this story with all of your friends, today.</a></p></div></div>"),
        F.lit("<div class='col-4'><div class='teaser'><p><a href='/1'>"), title, F.lit("</a></p><p><a href='/2'>Another headline, that stands on every page of the site.</a></p></div></div></div>"),
        F.lit("<div class='cookies'><p>We use cookies, and so do others. By reading on, you agree to all of that.</p></div><footer><p>All rights reserved, by all of us. Nothing may be copied, or sold.</p></footer></body></html>"),
    )
    return articles.select("article_id", F.col("source_id").alias("host"), page.alias("html"))


PAGES_SQL = r"""
WITH x AS (SELECT article_id, list_transform(string_split(body, chr(10)),
    lambda x: trim(regexp_replace(nfc_normalize(regexp_replace(x, '<[^>]+>', ' ', 'g')), '[\s\x{00A0}\x{200B}\x{200C}\x{200D}]+', ' ', 'g'))) AS p FROM articles)
SELECT article_id, md5(array_to_string(list_filter(p, lambda x: x <> ''), chr(10))) AS text FROM x
"""
