"""Items of landed feeds and pages. Fetching is not done here: payloads are read where they landed."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from khabarloom.functions.html import extract, listing
from khabarloom.functions.text import clean
from khabarloom.functions.urls import join_url

_TEXT = "STRUCT<_VALUE: STRING, _isPermaLink: STRING>"
_RSS = f"channel STRUCT<item: ARRAY<STRUCT<title: STRING, link: STRING, description: STRING, guid: {_TEXT}, pubDate: STRING, author: STRING>>>"
_ATOM = "entry ARRAY<STRUCT<title: STRING, link: ARRAY<STRUCT<_href: STRING, _rel: STRING>>, summary: STRING, id: STRING, published: STRING, updated: STRING, author: STRUCT<name: STRING>>>"


def _named(item: Column, atom: bool) -> Column:
    if atom:
        link = F.coalesce(F.filter(item["link"], lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")[0]["_href"], item["link"][0]["_href"])
        parts = (item["title"], link, item["summary"], item["id"], F.coalesce(item["published"], item["updated"]), item["author"]["name"])
    else:
        parts = (item["title"], item["link"], item["description"], item["guid"]["_VALUE"], item["pubDate"], item["author"])
    return F.struct(*(p.cast("string").alias(n) for p, n in zip(parts, ("title", "link", "summary", "guid", "published", "author"))))


def feed_items(payloads: DataFrame, keep: list[str], xml: str = "payload", base: str = "url") -> DataFrame:
    """One row per item of an RSS or Atom payload, with its place in it.

    Items without a link or a title are dropped; a payload that cannot be read has none. Links are
    resolved against ``base``; ``published`` is the feed's text, trimmed.
    """
    rss = F.from_xml(F.col(xml), _RSS)["channel"]["item"]
    atom = F.from_xml(F.col(xml), _ATOM)["entry"]
    items = F.coalesce(F.transform(rss, lambda x: _named(x, False)), F.transform(atom, lambda x: _named(x, True)))
    rows = payloads.select(*keep, F.col(base).alias("_base"), F.posexplode(items).alias("place", "i"))
    link = F.trim(F.col("i.link"), F.lit(" \n\t\r"))
    rows = rows.select(*keep, "place", "_base", link.alias("link"), clean(F.col("i.title")).alias("title"), "i.summary", "i.guid", "i.published", "i.author")
    rows = rows.filter("coalesce(link, '') != '' and title != ''")
    return rows.select(
        *keep,
        "place",
        join_url(F.col("_base"), F.col("link")).alias("url"),
        "title",
        clean(F.coalesce("summary", F.lit(""))).alias("summary"),
        F.nullif(clean(F.coalesce("author", F.lit(""))), F.lit("")).alias("author"),
        F.coalesce("guid", "link").alias("guid"),
        F.nullif(F.regexp_replace(F.trim(F.col("published"), F.lit(" \n\t\r")), "\\s+", " "), F.lit("")).alias("published"),
    )


def listing_items(pages: DataFrame, pack: dict, keep: list[str], html: str = "html", base: str = "url") -> DataFrame:
    """One row per card of a listing page, links resolved, the first of each address."""
    rows = pages.select(*keep, F.posexplode(listing(F.col(html), F.col(base), pack)).alias("place", "c"))
    return rows.select(*keep, "place", F.col("c.url").alias("url"), F.col("c.title").alias("title"), F.col("c.summary").alias("summary"), F.col("c.published").alias("published"))


def with_bodies(items: DataFrame, pages: DataFrame, pack: dict, html: str = "html", order: str | None = None) -> DataFrame:
    """Items with what their landed page adds: body and image where it has them, author and date to fill gaps.

    Of several pages of one address the one lowest in ``order`` counts (the text itself without an
    order), so items are never multiplied; items without a page stay as they are.
    """
    one = pages.filter("url is not null").groupBy(F.col("url").alias("_url")).agg((F.min_by(html, order) if order else F.min(html)).alias("_html"))
    got = one.select("_url", extract(F.col("_html"), pack).alias("p"))
    full = lambda new, old: F.coalesce(F.nullif(F.col(new), F.lit("")), F.col(old)).alias(old)
    fill = lambda new, old: F.coalesce(F.nullif(F.col(old), F.lit("")), F.col(new)).alias(old)
    both = items.join(got, F.col("url") == F.col("_url"), "left")
    changed = {"body": full("p.body", "body"), "image": full("p.image", "image"), "author": fill("p.author", "author"), "published": fill("p.published", "published")}
    return both.select(*(changed.get(c, F.col(c)) for c in items.columns))


def allowed_by_robots(urls: DataFrame, robots: DataFrame, agent: str = "*", url: str = "url") -> DataFrame:
    """Rows of ``urls`` their origin's landed robots.txt allows; an origin without a readable one allows all.

    ``robots``: origin, text (NULL where the fetch failed).
    """

    @F.pandas_udf("boolean")
    def fits(address: pd.Series, text: pd.Series) -> pd.Series:
        from urllib.robotparser import RobotFileParser

        known: dict[str, RobotFileParser] = {}
        out = []
        for u, t in zip(address, text):
            if not t:
                out.append(True)
                continue
            if t not in known:
                known[t] = RobotFileParser()
                known[t].parse(t.splitlines())
            out.append(known[t].can_fetch(agent, u))
        return pd.Series(out)

    origin = F.regexp_extract(F.col(url), "^([^:/?#]+://[^/?#]*)", 1)
    both = urls.withColumn("_o", origin).join(robots.select(F.col("origin").alias("_r"), F.col("text").alias("_t")), F.col("_o") == F.col("_r"), "left")
    return both.filter(fits(F.col(url), F.col("_t"))).drop("_o", "_r", "_t")
