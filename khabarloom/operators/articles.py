"""From feed items to canonical articles, and the reports over them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from khabarloom.functions.fingerprint import simhash
from khabarloom.functions.text import looks_devanagari
from khabarloom.functions.urls import canonical_url
from khabarloom.operators.groups import components, with_component


def published_ladder(feed: Column, page: Column, fetched: Column) -> tuple[Column, Column]:
    """(published_at, published_estimated): the feed's date, else the page's, else the time of fetching."""
    return F.coalesce(feed, page, fetched), feed.isNull() & page.isNull()


def language(source_lang: Column, title: Column) -> Column:
    """The outlet's language, but a Devanagari title of an English outlet is Nepali."""
    return F.when((source_lang == "en") & looks_devanagari(title), "ne").otherwise(source_lang)


def implausible(when: Column, now: Column) -> Column:
    """More than an hour ahead of ``now``, or before 2000 in Nepal."""
    ahead = F.unix_micros(when) - F.unix_micros(now) > 3_600_000_000
    return ahead | (F.year(F.from_utc_timestamp(when, "Asia/Kathmandu")) < 2000)


def normalize(items: DataFrame, sources: DataFrame, times: DataFrame, page_times: DataFrame | None = None) -> DataFrame:
    """Canonical articles of feed items.

    ``times`` and ``page_times`` have (ordinal, at): the readable instants of the items' feeds and pages.
    Items whose address or title is empty after cleaning are dropped, as are those of unknown sources.
    """
    rows = items.filter("trim(coalesce(url, '')) != '' and trim(coalesce(title, '')) != ''")
    rows = rows.join(sources.select(F.col("id").alias("source_id"), F.col("lang").alias("_lang"), "category"), "source_id").join(times, "ordinal", "left")
    if page_times is not None:
        rows = rows.join(page_times.select("ordinal", F.col("at").alias("_page_at")), "ordinal", "left")
    page = F.timestamp_seconds(F.col("_page_at")) if page_times is not None else F.lit(None).cast("timestamp")
    published, estimated = published_ladder(F.timestamp_seconds(F.col("at")), page, F.col("fetched_at"))
    body, summary, title = F.coalesce("body", F.lit("")), F.coalesce("summary", F.lit("")), F.trim("title")
    url = canonical_url(F.col("url"))
    return rows.select(
        "ordinal",
        "source_id",
        url.alias("url"),
        F.sha2(url, 256).alias("url_hash"),
        title.alias("title"),
        body.alias("body"),
        summary.alias("summary"),
        F.nullif(F.col("author"), F.lit("")).alias("author"),
        language(F.col("_lang"), title).alias("lang"),
        "category",
        published.alias("published_at"),
        estimated.alias("published_estimated"),
        "fetched_at",
        F.col("image").alias("image_url"),
        simhash(F.concat(title, F.lit(" "), F.when(body == "", summary).otherwise(body))).alias("simhash"),
        (body == "").alias("body_missing"),
    )


def source_report(articles: DataFrame) -> DataFrame:
    return articles.groupBy("source_id").agg(F.count(F.lit(1)).alias("articles"), F.max("published_at").alias("newest"))


def recent_fingerprints(articles: DataFrame, since: Column, limit: int = 5000) -> DataFrame:
    """The newest fingerprints since then; ties by address key. A bounded top-k, as the feature is one."""
    return articles.filter((F.col("published_at") >= since) & (F.col("simhash") != 0)).orderBy(F.desc("published_at"), "url_hash").limit(limit).select("url_hash", "simhash", "published_at")


def first_per_source(items: DataFrame, n: int, order: str = "ordinal") -> DataFrame:
    """The first ``n`` items of each source; ranks within chunks first, so only n rows per chunk meet."""
    chunk = F.pmod(F.xxhash64(order), F.lit(64))
    inner = Window.partitionBy("source_id", "_chunk").orderBy(order)
    some = items.withColumn("_chunk", chunk).withColumn("_r", F.row_number().over(inner)).filter(F.col("_r") <= n)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("source_id").orderBy(order))).filter(F.col("rank") <= n).drop("_chunk", "_r")


def inventory(sources: DataFrame) -> DataFrame:
    """Sources in listing order: active ones by priority and name with their rank, then inactive ones by name."""
    w = Window.partitionBy("active").orderBy(F.when(F.col("active"), F.col("priority")).otherwise(0), F.lower("name"), "id")
    return sources.withColumn("rank", F.row_number().over(w))


def validate_sources(rows: DataFrame) -> DataFrame:
    """``rows`` with ``problem``: the first rule a source breaks, NULL if none; checked in a fixed order."""
    # The allowed methods, languages, categories and priorities.
    methods, langs, priorities = ("html", "rss"), ("en", "ne"), (1, 2, 3, 4)
    categories = ("disaster", "economic", "entertainment", "govt", "news", "social", "sports")
    required = ("id", "name", "url", "method", "lang", "category", "priority", "active")
    missing = F.array_join(F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in sorted(required)))), ", ")
    return rows.withColumn(
        "problem",
        F.when(missing != "", F.concat(F.lit("missing: "), missing))
        .when(~F.col("method").isin(*methods), "method")
        .when(~F.col("lang").isin(*langs), "lang")
        .when(~F.col("category").isin(*categories), "category")
        .when(~F.col("priority").isin(*priorities), "priority")
        .when(~F.col("url").rlike("^https?://"), "url")
        .when(~F.col("active") & (F.coalesce("inactive_reason", F.lit("")) == ""), "inactive_reason")
        .when((F.col("method") == "html") & (F.coalesce("selectors", F.lit("")) == ""), "selectors"),
    )


def daily_volume(articles: DataFrame) -> DataFrame:
    return articles.groupBy("source_id", F.to_date("published_at").alias("day")).agg(F.count(F.lit(1)).alias("articles"), F.count_if("published_estimated").alias("estimated"))


def week_over_week(articles: DataFrame) -> DataFrame:
    """Articles per category and week, and the change from the week before that has any."""
    weekly = articles.groupBy("category", F.to_date(F.date_trunc("week", "published_at")).alias("week")).agg(F.count(F.lit(1)).alias("articles"))
    return weekly.withColumn("change", F.col("articles") - F.lag("articles").over(Window.partitionBy("category").orderBy("week")))


def cosine_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = 256) -> DataFrame:
    """(query, neighbour, rank): the ``k`` nearest rows of each query by cosine, itself left out; ties by id.

    Queries (a stated set) are packed into blocks of vectors, and every block meets every tile of at
    most 1,024 rows as one matrix product; what is left are k rows per query and tile, ranked again after the shuffle.
    Tiles and blocks are joined on the numbers of both, so the work is spread over tasks and nothing
    is broadcast that grows. Zero and NULL vectors have no neighbours. ``vec_id`` is unique.
    """
    packed = queries.filter("embedding is not null").groupBy(F.floor(F.col("vec_id") / (20 * block)).alias("g")).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("held"))
    tiles = vectors.filter("embedding is not null").groupBy(F.floor(F.col("vec_id") / 1024).alias("run")).agg(F.collect_list(F.struct("vec_id", "embedding")).alias("rows"))

    @F.pandas_udf("array<struct<query:bigint,neighbour:bigint,cosine:double>>")
    def nearest(held: pd.Series, rows_: pd.Series) -> pd.Series:
        out = []
        for q, r in zip(held, rows_):
            qid, ids = (np.array([x["vec_id"] for x in t], np.int64) for t in (q, r))
            qm, rm = (_unit(np.array([x["embedding"] for x in t], np.float64)) for t in (q, r))
            got = []
            for i, s in enumerate(qm @ rm.T):
                order = np.lexsort((ids, -s))
                order = order[(ids[order] != qid[i]) & rm[order].any(axis=1)][: k if qm[i].any() else 0]
                got += [{"query": int(qid[i]), "neighbour": int(ids[j]), "cosine": float(s[j])} for j in order]
            out.append(got)
        return pd.Series(out)

    ends = tiles.agg(F.min("run"), F.max("run")).first()
    if ends[0] is None:
        return tiles.select(F.lit(0).cast("long").alias("query"), F.lit(0).cast("long").alias("neighbour"), F.lit(0).alias("rank")).limit(0)
    asks = packed.select("held", F.explode(F.sequence(F.lit(ends[0]), F.lit(ends[1]))).alias("run"))
    near = asks.join(tiles, "run").select(F.explode(nearest("held", "rows")).alias("n")).select("n.*")
    w = Window.partitionBy("query").orderBy(F.desc("cosine"), "neighbour")
    return near.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query", "neighbour", "rank")


#: Vectors in a tile; two tiles meet as one matrix product.
TILE = 1024


def story_pairs(vectors: DataFrame, key: str, at: str, embedding: str, threshold: float = 0.8, hours: int = 48) -> DataFrame:
    """(a, b), a < b: rows at most ``hours`` apart whose vectors have a cosine of ``threshold`` or more.

    Rows fall into windows of ``hours``; a row can only match its own window and the next one.
    Windows are cut into tiles of about ``TILE`` rows, and pairs of tiles are joined on their
    numbers, so a window of any size is spread over tasks and only matches leave a task. NULL and
    zero vectors and rows without a time match nothing. ``key`` is unique.
    """
    span = hours * 3600
    rows = vectors.select(F.col(key).alias("id"), F.unix_micros(at).alias("at"), F.col(embedding).alias("v")).filter("id is not null and at is not null and v is not null")
    rows = rows.withColumn("w", F.floor(F.col("at") / (1_000_000 * span)))
    tiles = rows.groupBy("w").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))
    held = rows.join(tiles, "w").withColumn("t", F.pmod(F.xxhash64("id"), F.col("tiles"))).groupBy("w", "t").agg(F.collect_list(F.struct("id", "at", "v")).alias("held"))
    own = held.join(tiles, "w").join(tiles.select((F.col("w") - 1).alias("w"), F.col("tiles").alias("after")), "w", "left")
    beside = F.transform(F.sequence(F.col("t"), F.col("tiles") - 1), lambda x: F.struct(F.col("w").alias("w2"), x.alias("t2")))
    later = F.when(F.col("after").isNull(), F.array().cast("array<struct<w2:bigint,t2:bigint>>")).otherwise(F.transform(F.sequence(F.lit(0).cast("long"), F.col("after") - 1), lambda x: F.struct((F.col("w") + 1).alias("w2"), x.alias("t2"))))
    asks = own.select("w", "t", F.col("held").alias("left"), F.explode(F.concat(beside, later)).alias("p")).select("w", "t", "left", "p.*")
    met = asks.join(held.select(F.col("w").alias("w2"), F.col("t").alias("t2"), F.col("held").alias("right")), ["w2", "t2"])
    itself = (F.col("w") == F.col("w2")) & (F.col("t") == F.col("t2"))

    @F.pandas_udf("array<struct<a:bigint,b:bigint>>")
    def near(left: pd.Series, right: pd.Series, same: pd.Series) -> pd.Series:
        out = []
        for x, y, s in zip(left, right, same):
            xi, yi = (np.array([r["id"] for r in t], np.int64) for t in (x, y))
            xt, yt = (np.array([r["at"] for r in t], np.int64) for t in (x, y))
            xm, ym = (_unit(np.array([r["v"] for r in t], np.float64)) for t in (x, y))
            hit = (xm @ ym.T >= threshold) & (np.abs(xt[:, None] - yt[None, :]) <= span * 1_000_000)
            if s:
                hit &= xi[:, None] < yi[None, :]
            i, j = np.nonzero(hit)
            out.append([{"a": int(min(p, q)), "b": int(max(p, q))} for p, q in zip(xi[i], yi[j])])
        return pd.Series(out)

    return met.select(F.explode(near("left", "right", itself)).alias("p")).select("p.a", "p.b")


def story_clusters(vectors: DataFrame, key: str, at: str, embedding: str, threshold: float = 0.8, hours: int = 48) -> DataFrame:
    """(key, cluster): every row with the smallest key of its story; stories are the components of ``story_pairs``."""
    linked = components(story_pairs(vectors, key, at, embedding, threshold, hours))
    return with_component(vectors.select(key), linked, key, "cluster")


def stories_per_day(articles: DataFrame, clusters: DataFrame, key: str, at: str) -> DataFrame:
    """(day, articles, stories): what was published each day, an event counted once a day however often it is told."""
    rows = articles.select(key, F.to_date(at).alias("day")).join(clusters.select(key, "cluster"), key)
    per = rows.groupBy("day", "cluster").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("day").agg(F.sum("n").alias("articles"), F.count(F.lit(1)).alias("stories"))


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)
