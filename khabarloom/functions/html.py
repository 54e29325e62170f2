"""Pages read with selector packs: a small tree over the standard HTML tokenizer, the selectors the
packs use, and the page's JSON-LD."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from khabarloom.functions.text import clean_text

# Elements without content, elements a new one closes, and how article types rank.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SAME_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
ARTICLE_TYPES = ("NewsArticle", "Article", "BlogPosting", "ReportageNewsArticle")
JSONLD = "jsonld:"


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict[str, str | None], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    def elements(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    def walk(self) -> Iterator[Node]:
        stack = self.elements()[::-1]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(n.elements()[::-1])

    def text(self) -> str:
        out: list[str] = []
        stack: list[Node | str] = [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.children))
        return "".join(out)


class _Builder(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.here = Node("#root", {}, None)

    def _close(self, tags: tuple[str, ...], stop: frozenset[str]) -> None:
        n: Node | None = self.here
        while n is not None and n.tag not in stop:
            if n.tag in tags:
                self.here = n.parent or self.root
                return
            n = n.parent

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P:
            self._close(("p",), frozenset(("#root", "table", "td", "th", "button", "object")))
        if tag in SAME_CLOSES:
            self._close(SAME_CLOSES[tag], frozenset(("#root", "ul", "ol", "dl", "table", "select")))
        first: dict[str, str | None] = {}
        for k, v in attrs:
            first.setdefault(k, v)
        node = Node(tag, first, self.here)
        self.here.children.append(node)
        if tag not in VOID:
            self.here = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        n: Node | None = self.here
        while n is not None and n.tag != "#root":
            if n.tag == tag:
                self.here = n.parent or self.root
                return
            n = n.parent

    def handle_data(self, data: str) -> None:
        self.here.children.append(data)


def parse_html(page: str | None) -> Node:
    b = _Builder()
    b.feed(page or "")
    b.close()
    return b.root


_SIMPLE = re.compile(r"""\s*(?P<comb>[>\s]?)\s*(?P<part>(?:[a-zA-Z][\w-]*|\*)?(?:[#.][\w-]+|\[[^\]]+\]|:[\w-]+(?:\([^)]*\))?)*)""")
_PIECE = re.compile(r"""#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[*^$~|]?=)\s*(?P<val>"[^"]*"|'[^']*'|[^\]\s]+))?\s*\]|:(?P<pseudo>[\w-]+)(?:\((?P<arg>[^)]*)\))?""")


def _compile_part(part: str) -> list[tuple]:
    m = re.match(r"[a-zA-Z][\w-]*|\*", part)
    tests: list[tuple] = [("tag", m[0].lower())] if m and m[0] != "*" else []
    for p in _PIECE.finditer(part, m.end() if m else 0):
        if p["id"]:
            tests.append(("attr", "id", "=", p["id"]))
        elif p["cls"]:
            tests.append(("class", p["cls"]))
        elif p["attr"]:
            tests.append(("attr", p["attr"].lower(), p["op"], p["val"].strip("\"'") if p["val"] else None))
        elif p["pseudo"] == "not":
            tests.append(("not", _compile_part(p["arg"].strip())))
        elif p["pseudo"] in ("nth-child", "first-child", "first-of-type"):
            tests.append((p["pseudo"], int(p["arg"]) if p["arg"] else 1))
        else:
            raise ValueError(f"selector part not supported: {part!r}")
    return tests


@lru_cache(maxsize=1024)
def compile_selector(css: str) -> list[list[tuple[str, list[tuple]]]]:
    """Alternatives of (combinator, tests), left to right; types, classes, ids, attributes,
    descendants and children, :not, :nth-child, :first-child, :first-of-type."""
    out = []
    for alt in css.split(","):
        steps: list[tuple[str, list[tuple]]] = []
        at, alt = 0, alt.strip()
        while at < len(alt):
            m = _SIMPLE.match(alt, at)
            if not m or not m["part"]:
                raise ValueError(f"selector not supported: {css!r}")
            steps.append((">" if m["comb"] == ">" else " ", _compile_part(m["part"])))
            at = m.end()
        out.append(steps)
    return out


def _attr_fits(have: str | None, op: str | None, want: str | None) -> bool:
    if op is None:
        return True
    have, want = have or "", want or ""
    return {
        "=": have == want,
        "*=": bool(want) and want in have,
        "^=": bool(want) and have.startswith(want),
        "$=": bool(want) and have.endswith(want),
        "~=": want in have.split(),
        "|=": have == want or have.startswith(want + "-"),
    }[op]


def _fits(n: Node, tests: list[tuple]) -> bool:
    for t in tests:
        kind = t[0]
        if kind == "tag":
            ok = n.tag == t[1]
        elif kind == "class":
            ok = t[1] in (n.attrs.get("class") or "").split()
        elif kind == "attr":
            ok = t[1] in n.attrs and _attr_fits(n.attrs[t[1]], t[2], t[3])
        elif kind == "not":
            ok = not _fits(n, t[1])
        else:
            peers = n.parent.elements() if n.parent else [n]
            if kind == "first-of-type":
                peers = [p for p in peers if p.tag == n.tag]
            ok = len(peers) >= t[1] and peers[t[1] - 1] is n
        if not ok:
            return False
    return True


def _selected(n: Node, steps: list[tuple[str, list[tuple]]]) -> bool:
    comb, tests = steps[-1]
    if not _fits(n, tests):
        return False
    if len(steps) == 1:
        return True
    p = n.parent
    while p is not None and p.tag != "#root":
        if _selected(p, steps[:-1]):
            return True
        if comb == ">":
            return False
        p = p.parent
    return False


def select(tree: Node, css: str) -> list[Node]:
    """Matching elements in document order."""
    alts = compile_selector(css)
    return [n for n in tree.walk() if any(_selected(n, a) for a in alts)]


def _split(selector: str) -> tuple[str, str | None]:
    css, at, attr = selector.rpartition("@")
    return (css.strip(), attr.strip()) if at else (selector.strip(), None)


def _values(tree: Node, selector: str) -> Iterator[str]:
    css, attr = _split(selector)
    for n in select(tree, css):
        yield clean_text(n.attrs.get(attr) if attr else n.text())


def select_one(tree: Node, selector: str) -> str | None:
    """The first match's attribute or text; NULL if there is none or it is empty."""
    return next(_values(tree, selector), None) or None


def select_all(tree: Node, selector: str) -> list[str]:
    return [v for v in _values(tree, selector) if v]


def _flat(data: object) -> list[dict]:
    if isinstance(data, list):
        return [o for x in data for o in _flat(x)]
    return [data, *_flat(data.get("@graph"))] if isinstance(data, dict) else []


def jsonld_objects(tree: Node) -> list[dict]:
    """Every JSON-LD object of the page, graphs opened; broken blocks are passed over."""
    out: list[dict] = []
    for n in tree.walk():
        if n.tag == "script" and n.attrs.get("type") == "application/ld+json":
            try:
                out += _flat(json.loads(n.text()))
            except ValueError:
                continue
    return out


def _rank(obj: dict) -> int:
    types = obj.get("@type")
    names = [types] if isinstance(types, str) else [t for t in types or [] if isinstance(t, str)]
    return min((ARTICLE_TYPES.index(t) for t in names if t in ARTICLE_TYPES), default=len(ARTICLE_TYPES))


def jsonld_value(objects: list[dict], path: str) -> str | None:
    """The first scalar at a dotted path, article objects first; lists stand for their first element."""
    for obj in sorted(objects, key=_rank):
        at: object = obj
        for name in [*path.split("."), None]:
            if isinstance(at, list):
                at = at[0] if at else None
            if name is not None:
                at = at.get(name) if isinstance(at, dict) else None
        if isinstance(at, str | int | float):
            return clean_text(str(at)) or None
    return None


def check_pack(pack: dict) -> dict:
    """The pack itself, if every selector in it is a string this reader supports."""
    for part in ("article", "listing"):
        for name, sel in (pack.get(part) or {}).items():
            if not isinstance(sel, str):
                raise ValueError(f"{part}.{name}: a selector must be text, not {type(sel).__name__}")
            if not sel.startswith(JSONLD) and not name.endswith("_format"):
                compile_selector(_split(sel)[0])
    for sel in pack.get("exclude") or []:
        compile_selector(sel)
    return pack


def extract_page(page: str | None, pack: dict) -> dict[str, str | None]:
    """body, author, image and the raw date of a page; what is missing is NULL, a missing body ''.

    Excluded elements do not hide structured data: its objects are gathered from the whole page.
    """
    tree = parse_html(page)
    want = pack.get("article") or {}
    objects = jsonld_objects(tree) if any(s.startswith(JSONLD) for s in want.values()) else []
    for css in pack.get("exclude") or []:
        for n in select(tree, css):
            if n.parent:
                n.parent.children = [c for c in n.parent.children if c is not n]

    def one(name: str) -> str | None:
        sel = want.get(name)
        if not sel:
            return None
        return jsonld_value(objects, sel.removeprefix(JSONLD)) if sel.startswith(JSONLD) else select_one(tree, sel)

    body = want.get("body")
    text = "\n\n".join(select_all(tree, body)) if body and not body.startswith(JSONLD) else one("body") or ""
    return {"body": text, "author": one("author"), "published": one("published"), "image": one("image")}


def extract(page: Column, pack: dict) -> Column:
    """STRUCT<body, author, published, image> of each page under one pack."""
    check_pack(pack)

    @F.pandas_udf("body string, author string, published string, image string")
    def run(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([extract_page(p, pack) for p in pages], columns=["body", "author", "published", "image"])

    return run(page)


def page_cards(page: str | None, base: str | None, want: dict) -> list[dict]:
    """Cards of a listing page with a link and a title, the first of each address.

    Addresses are compared after they are resolved against ``base``, so two spellings of one link
    are one card.
    """
    seen: dict[str, dict] = {}
    for card in select(parse_html(page), want["item"]):
        got = {n: select_one(card, want[n]) if n in want else None for n in ("link", "title", "summary", "published")}
        if got["link"] and got["title"]:
            url = urljoin(base or "", got["link"].strip())
            seen.setdefault(url, {"url": url, "title": got["title"], "summary": got["summary"] or "", "published": got["published"]})
    return list(seen.values())


def listing(page: Column, base: Column, pack: dict) -> Column:
    """ARRAY<STRUCT<url, title, summary, published>>: the cards of each page, addresses resolved against ``base``."""
    check_pack(pack)
    want = pack["listing"]

    @F.pandas_udf("array<struct<url:string,title:string,summary:string,published:string>>")
    def run(pages: pd.Series, bases: pd.Series) -> pd.Series:
        return pd.Series([page_cards(p, b, want) for p, b in zip(pages, bases)])

    return run(page, base)
