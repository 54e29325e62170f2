"""Problem 6: a page's own story without the page around it.

Pages are texts of one block per line. Each block has a path: its generalised form (no case, digits
alike, single spaces) or, if it reads like running text, its text. Every distinct page of a host
votes for the paths it has; a path that recurs over a host's pages, or over many hosts, is page
furniture there, as a story is told once. Copies of a page vote as one. Furniture that pages follow
with headlines opens a list of teasers. Each block is then joined with its host's winning paths:
furniture goes, and so do teaser lists, breadcrumbs, menus and other blocks whose shape no
story has; headings, numbered points, quotes and bylines stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from khabarloom.runtime import cut

#: A path is furniture of a host from this many distinct pages and this share of them; of all hosts, from these counts.
LEAST_PAGES, LEAST_SHARE = 5, 0.004
LEAST_HOSTS, LEAST_ANYWHERE = 3, 10
#: Furniture opens a list of teasers if what follows it is a headline this often.
OPENS = 0.5
_LONGEST_FORM = 160
#: The last line of a page is a cut furniture line if a path begins with it and it has this many characters.
_LEAST_END = 12

# Words of bylines and bureau lines, which belong to the story.
BYLINE = re.compile(r"^(by |— ?|- ?|– ?)?.{0,60}(संवाददाता|ब्युरो|ब्यूरो|bureau|reporter|correspondent)$|^by \S+( \S+){0,3}$")

_SPACES = re.compile("[ \t  -​ 　\r]+")
_DIGITS = re.compile(r"\d+")
_BULLET = re.compile(r"^\s*(?:[•·▪‣◦*–-]|[\d]{1,2}[.)])\s+")
_AGO = re.compile(r"\(\s*\d+\s*(?:(?:minute|hour|day|week)s?\s+ago|\S*अघि|\S+\s+(?:पहिले|अघि))\s*\)\s*$", re.I)
_DEGREES = re.compile(r"^.{1,40}\s-?\d{1,2}\s*°\s*[CF]?$")
_MARK = re.compile(r"[।.?!…][”’\"')\]]*$")
_INNER_MARK = re.compile(r"[।?!][”’\"']?\s+\S|[a-z\d)”’\"'][.][”’\"']?\s+[A-Z\"“‘]")
_CRUMB = re.compile(r"\s[>»›]\s")
_LIST = re.compile(r"\s*[|·•/]\s*|  +")


def form_of(line: str) -> str:
    return _DIGITS.sub("0", _SPACES.sub(" ", line)).strip().lower()


def _path(form: str) -> str:
    return form if len(form) <= _LONGEST_FORM else "#" + xxhash.xxh3_64_hexdigest(form)


def _is_prose(line: str) -> bool:
    """Whether a block reads like running text rather than a heading or a label."""
    t = _BULLET.sub("", line.strip())
    return bool(_INNER_MARK.search(t)) or (bool(_MARK.search(t)) and not t.endswith(("?", "…", ")"))) or len(t.split()) >= 14


def _is_headline(line: str) -> bool:
    t = _BULLET.sub("", line.strip())
    return bool(_AGO.search(t)) or (not _is_prose(t) and 4 <= len(t.split()) <= 14 and not _is_furniture_shape(t))


def _is_furniture_shape(line: str) -> bool:
    """Blocks no story has, whatever their words."""
    t = line.strip()
    if t.startswith("©") or _DEGREES.match(t) or _AGO.search(t):
        return True
    if len(_CRUMB.findall(t)) >= 2:
        return True
    parts = [p for p in _LIST.split(t.replace(" ", " ")) if p]
    return len(parts) >= 4 and not _MARK.search(t) and max(len(p.split()) for p in parts) <= 3


def _blocks(body: str) -> list[tuple[int, str]]:
    return [(i, x) for i, x in enumerate(body.split("\n")) if x.strip()]


def _page(body: str) -> int:
    return xxhash.xxh64_intdigest(body.encode("utf-8", "surrogatepass")) - (1 << 63)


def page_paths(pages: DataFrame, host: str, body: str) -> DataFrame:
    """(host, path, page, opens): once per page and path; ``page`` names the body, ``opens`` 1 if a headline follows, NULL if nothing does."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hosts, paths, keys, opens = [], [], [], []
            for h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if not text:
                    continue
                key = _page(text)
                blocks = _blocks(text)
                seen: dict[str, int | None] = {}
                for (_, line), (_, after) in zip(blocks, [*blocks[1:], (0, "")]):
                    p = _path(form_of(line))
                    follows = int(_is_headline(after)) if after else None
                    seen[p] = follows if seen.get(p) is None else max(seen[p], follows or 0)
                hosts += [h] * len(seen)
                paths += list(seen)
                keys += [key] * len(seen)
                opens += list(seen.values())
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(keys, pa.int64()), pa.array(opens, pa.int32())], names=["host", "path", "page", "opens"])

    return pages.select(F.col(host).alias("host"), F.col(body).alias("body")).mapInArrow(rows, "host string, path string, page bigint, opens int")


def winning_paths(pages: DataFrame, host: str = "host", body: str = "body") -> DataFrame:
    """(host, path, opener): the paths that are page furniture on each host, and whether they open teaser lists.

    Votes are summed in two steps, over (host, path, page) and then (host, path), both combined
    before they are shuffled.
    """
    votes = page_paths(pages, host, body).groupBy("host", "path", "page").agg(F.max("opens").alias("opens"))
    by_host = cut(votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("opens").alias("opens"), F.count("opens").alias("led")), "path-votes")
    totals = pages.select(F.col(host).alias("host"), F.xxhash64(body).alias("page")).distinct().groupBy("host").agg(F.count(F.lit(1)).alias("total"))
    anywhere = by_host.groupBy("path").agg(F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("hosts"), F.sum("opens").alias("all_opens"), F.sum("led").alias("all_led"))
    anywhere = anywhere.filter((F.col("all_n") >= 2) & ((F.col("hosts") >= LEAST_HOSTS) & (F.col("all_n") >= LEAST_ANYWHERE) | (F.col("all_n") >= LEAST_PAGES)))
    both = by_host.drop("opens", "led").join(anywhere, "path").join(totals.withColumnRenamed("host", "_h"), F.col("host").eqNullSafe(F.col("_h")))
    here = (F.col("n") >= LEAST_PAGES) & (F.col("n") >= LEAST_SHARE * F.col("total"))
    wide = (F.col("hosts") >= LEAST_HOSTS) & (F.col("all_n") >= LEAST_ANYWHERE)
    won = both.filter((here | wide) & ~F.col("path").rlike(BYLINE.pattern))
    opener = (F.col("all_opens") >= OPENS * F.col("all_led")) & (F.size(F.split("path", " ")) <= 6)
    return won.select("host", "path", F.coalesce(opener, F.lit(False)).alias("opener"))


def _role(line: str, form: str, after: str) -> str:
    """What a block that is no furniture by its path is, by its shape and the next block.

    b: ends a list of teasers; s: never of a story; l: a list entry that stands alone; t: of a teaser list where one is open.
    """
    if BYLINE.match(form):
        return "b"
    if _is_furniture_shape(line):
        return "s"
    if _is_prose(line):
        return "b"
    words = len(_BULLET.sub("", line.strip()).split())
    if _BULLET.match(line):
        return "l" if words >= 4 else "t"
    return "b" if words <= 3 and _is_prose(after) else "t"


def page_blocks(pages: DataFrame, keys: list[str], host: str, body: str) -> DataFrame:
    """(keys, _host, _page, line_no, _path, _role, _end, _form): every block.

    ``_page`` names the body, ``_end`` is the form of a page's last block if it may be a cut line,
    ``_form`` the form of a block whose path is only its hash.
    """
    src = pages.filter(F.coalesce(F.col(body), F.lit("")) != "").select(*keys, F.col(host).alias("_host"), F.col(body).alias("_body"))
    k = len(keys) + 1

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place, names, lines, paths, roles, ends, forms = [], [], [], [], [], [], []
            for r, text in enumerate(b.column(k).to_pylist()):
                blocks = _blocks(text)
                names += [_page(text)] * len(blocks)
                for (i, line), (_, after) in zip(blocks, [*blocks[1:], (0, "")]):
                    form = form_of(line)
                    place.append(r)
                    lines.append(i)
                    paths.append(_path(form))
                    roles.append(_role(line, form, after))
                    ends.append(None)
                    forms.append(form if paths[-1] != form else None)
                if blocks and len(form) >= _LEAST_END and not BYLINE.match(form):
                    ends[-1] = form
            cols = [*(c.take(pa.array(place, pa.int32())) for c in b.columns[:k]), pa.array(names, pa.int64()), pa.array(lines, pa.int32()), pa.array(paths, pa.string()), pa.array(roles, pa.string()), pa.array(ends, pa.string()), pa.array(forms, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keys, "_host", "_page", "line_no", "_path", "_role", "_end", "_form"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:k])
    return src.mapInArrow(rows, f"{head}, _page bigint, line_no int, _path string, _role string, _end string, _form string")


def furniture_lines(pages: DataFrame, paths: DataFrame, keys: list[str], host: str = "host", body: str = "body") -> DataFrame:
    """(keys, line_no): the lines of each page that are not its story; NULL and empty bodies have none.

    Each block is joined with its host's winning path, and the last of a page, which may be the
    beginning of a cut line, with the paths that begin like it. A list of teasers is open at a block
    if the last block before it that opens or ends one opens it. ``keys`` name a page.
    """
    won = paths.select(F.col("host").alias("_h"), F.col("path").alias("_p"), "opener")
    same = F.col("_host").eqNullSafe(F.col("_h"))
    blocks = cut(page_blocks(pages, keys, host, body), "page-blocks")
    ends, rest = blocks.filter(F.col("_end").isNotNull()), blocks.filter(F.col("_end").isNull())
    # winning paths as texts: those that are hashes take the form of a block that has them
    hashed = won.filter(F.col("_p").startswith("#")).select("_h", "_p").distinct()
    long_ = blocks.filter(F.col("_form").isNotNull()).select("_path", "_form").join(hashed.select("_p").distinct(), F.col("_path") == F.col("_p"), "left_semi").groupBy("_path").agg(F.min("_form").alias("_t"))
    texts = won.select("_h", F.col("_p").alias("_t")).unionByName(hashed.join(long_, F.col("_p") == F.col("_path")).select("_h", "_t"))
    start = F.substring("_end", 1, _LEAST_END) == F.substring("_t", 1, _LEAST_END)
    begun = ends.select("_host", "_end").distinct().join(texts.filter(F.length("_t") >= _LEAST_END), same & start & F.col("_t").startswith(F.col("_end")), "left_semi")
    begun = begun.select(F.col("_host").alias("_h"), F.col("_end").alias("_e"), F.lit(True).alias("_cut"))
    ends = ends.join(begun, same & (F.col("_end") == F.col("_e")), "left").drop("_h", "_e")
    blocks = ends.unionByName(rest.withColumn("_cut", F.lit(None).cast("boolean"))).drop("_end", "_form").join(won, same & (F.col("_path") == F.col("_p")), "left")
    sets = F.when(F.col("opener").isNotNull(), F.col("opener")).when(F.col("_role") == "b", F.lit(False))
    before = Window.partitionBy(*keys, "_page").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.last(sets, ignorenulls=True).over(before), F.lit(False))
    gone = F.col("opener").isNotNull() | F.col("_cut").isNotNull() | F.col("_role").isin("s", "l") | ((F.col("_role") == "t") & F.col("_open"))
    return blocks.withColumn("_open", opened).filter(gone).select(*keys, "line_no")


def main_text(pages: DataFrame, marked: DataFrame, keys: list[str], body: str = "body") -> DataFrame:
    """``pages`` with only the story's lines in ``body``; all rows and other columns stay."""
    gone = marked.groupBy(*(F.col(c).alias(f"_{c}") for c in keys)).agg(F.collect_set("line_no").alias("_gone"))
    on: Column = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    kept = F.filter(F.split(body, "\n", -1), lambda line, i: ~F.array_contains("_gone", i))
    out = pages.join(gone, on, "left").withColumn(body, F.when(F.col("_gone").isNull(), F.col(body)).otherwise(F.array_join(kept, "\n")))
    return out.drop("_gone", *(f"_{c}" for c in keys))


def found(extracted: DataFrame, articles: DataFrame) -> DataFrame:
    """Lines of extracted pages and articles that are not the story."""
    pages = extracted.select(F.lit("extracted_articles").alias("rec"), F.col("page_id").alias("rec_id"), F.col("source_id").alias("host"), "body").unionByName(
        articles.select(F.lit("articles").alias("rec"), F.col("article_id").alias("rec_id"), F.col("source_id").alias("host"), "body")
    )
    paths = cut(winning_paths(pages), "host-paths")
    return furniture_lines(pages, paths, ["rec", "rec_id"])
