"""Named queries over the core operators; each reads its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from khabarloom.functions import fingerprint, html, text, urls
from khabarloom.operators import articles as art
from khabarloom.operators import dedupe, schedule, times
from khabarloom.plans.oracles import ORACLES
from khabarloom.runtime import shared_dir, table
from khabarloom.sources import feeds, inventory, registry
from khabarloom.streaming import ingest

#: The instant at which due sources are asked for, in data that ends on 30 August 2026.
AS_OF = "2026-08-30 01:11:16"
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    _QUERIES[f.__name__] = f
    return f


def _s(column: str, name: str | None = None) -> Column:
    """A time as whole seconds since 1970."""
    return F.unix_seconds(column).alias(name or f"{column}_s")


@query
def p3_found(spark, d):
    items, articles, zones, months, names = (table(spark, d, t) for t in ("raw_items", "articles", "source_zones", "bs_months", "zone_names"))
    return times.found(items, articles, zones, months, names)


@query
def a5_source_report(spark, d):
    rows = dedupe.first_per_key(table(spark, d, "articles"), "url_hash", "article_id")
    return art.source_report(rows).select("source_id", "articles", _s("newest"))


@query
def f11_canonical_url(spark, d):
    return table(spark, d, "raw_items").select("ordinal", urls.canonical_url(F.col("url")).alias("url"))


@query
def f13_url_hash(spark, d):
    return table(spark, d, "raw_items").select("ordinal", urls.url_hash(F.col("url")).alias("url_hash"))


@query
def f10_homepage(spark, d):
    return table(spark, d, "sources").select("id", urls.homepage(F.col("url")).alias("homepage"))


@query
def f14_urljoin(spark, d):
    """References of every form against a base three levels deep."""
    rows = table(spark, d, "raw_items")
    origin = F.regexp_extract("url", "^([^:]+://[^/]+)", 1)
    path = F.regexp_extract("url", "^[^:]+://[^/]+(/[^?#]*)", 1)
    last = F.concat(F.lit("s"), F.col("ordinal").cast("string"))
    refs = {"path": path, "up": F.concat(F.lit("../"), last), "beside": F.concat(F.lit(" "), last, F.lit("?a=1 ")), "query": F.concat(F.lit("?q="), last), "host": F.concat(F.lit("//other.example/"), last), "whole": F.col("url")}
    asks = F.explode(F.array(*(F.struct(F.lit(k).alias("form"), v.alias("ref")) for k, v in refs.items())))
    rows = rows.select("ordinal", F.concat(origin, F.lit("/feed/all/now")).alias("base"), asks.alias("r"))
    return rows.select("ordinal", "r.form", urls.join_url(F.col("base"), F.col("r.ref")).alias("url"))


@query
def f1_clean(spark, d):
    return table(spark, d, "raw_items").select("ordinal", text.clean(F.col("title")).alias("title"), text.clean(F.col("summary")).alias("summary"))


@query
def f2_strip_tags(spark, d):
    marked = F.concat(F.lit("<p class='x'>"), F.col("summary"), F.lit("</p><br/>"))
    return table(spark, d, "raw_items").select("ordinal", text.strip_tags(marked).alias("text"))


@query
def f8_ascii_digits(spark, d):
    return table(spark, d, "articles").select("article_id", text.ascii_digits(F.col("title")).alias("title"))


@query
def f9_devanagari_share(spark, d):
    share = text.devanagari_share(F.col("body"))
    return table(spark, d, "articles").select("article_id", F.round(share, 6).alias("share"), text.looks_devanagari(F.col("body")).alias("devanagari"))


@query
def f31_bool(spark, d):
    return table(spark, d, "sources").select("id", text.truthy(F.col("active").cast("string")).alias("active"), text.truthy(F.col("notes"), True).alias("notes"))


@query
def f33_log_context(spark, d):
    return table(spark, d, "sources").select("id", schedule.log_context(F.col("id"), F.col("method"), F.col("homepage")).alias("context"))


@query
def f34_report_line(spark, d):
    line = schedule.report_line(*(F.col(c) for c in ("source_id", "ok", "not_modified", "items_seen", "items_new", "items_duplicate", "error")))
    return table(spark, d, "fetch_log").select("id", line.alias("line"))


def _story() -> Column:
    """What fingerprints and runs are taken of: the title and the body, or the summary if the body is empty."""
    return F.concat("title", F.lit(" "), F.when(F.col("body") == "", F.col("summary")).otherwise(F.col("body")))


@query
def d2_tokenize(spark, d):
    tokens = text.tokenize(_story())
    rows = table(spark, d, "articles").select("article_id", tokens.alias("t"))
    return rows.select("article_id", F.size("t").alias("n"), F.md5(F.array_join("t", " ")).alias("tokens"))


@query
def d3_runs(spark, d):
    rows = table(spark, d, "articles").select("article_id", text.runs(text.tokenize(_story())).alias("r"))
    return rows.select("article_id", F.size("r").alias("n"), F.md5(F.array_join("r", "|")).alias("runs"))


@query
def d1_first_items(spark, d):
    rows = table(spark, d, "raw_items").withColumn("url_hash", urls.url_hash(F.col("url")))
    return dedupe.first_per_key(rows, "url_hash", "ordinal").select("ordinal", "source_id", "url_hash")


@query
def d4_simhash(spark, d):
    """Every stored fingerprint computed again from its article's text."""
    rows = table(spark, d, "articles").filter("simhash != 0")
    return rows.select("article_id", fingerprint.simhash(_story()).alias("simhash"))


@query
def d4b_simhash_md5(spark, d):
    return table(spark, d, "articles").select("article_id", fingerprint.simhash_md5(_story()).alias("simhash"))


@query
def d5_hamming_pairs(spark, d):
    return dedupe.near_pairs(table(spark, d, "articles"), "article_id", "simhash")


@query
def d7_greedy_near_dup(spark, d):
    return dedupe.greedy_keep(table(spark, d, "articles"), "article_id", "simhash")


@query
def d7_kept_report(spark, d):
    """Flagship: exact and near duplicates gone, what each outlet keeps."""
    rows = dedupe.first_per_key(table(spark, d, "articles"), "url_hash", "article_id")
    kept = dedupe.greedy_keep(rows.select("article_id", "simhash"), "article_id", "simhash").filter("kept").select("article_id")
    return art.source_report(rows.join(kept, "article_id")).select("source_id", "articles", _s("newest"))


@query
def j1_known_items(spark, d):
    rows = table(spark, d, "raw_items").withColumn("url_hash", urls.url_hash(F.col("url")))
    return dedupe.known(rows, table(spark, d, "articles")).select("ordinal", "source_id")


@query
def j2_new_items(spark, d):
    """Incoming rows whose address is not stored yet."""
    return dedupe.unknown(table(spark, d, "incoming_articles"), table(spark, d, "articles")).select("article_id", "source_id")


@query
def j3_due_sources(spark, d):
    return schedule.due_sources(table(spark, d, "sources"), table(spark, d, "source_state"), F.lit(AS_OF).cast("timestamp")).select("id", "priority")


@query
def j4_item_sources(spark, d):
    s = table(spark, d, "sources").select(F.col("id").alias("source_id"), "category", "lang")
    return table(spark, d, "raw_items").join(s, "source_id").groupBy("category", "lang").agg(F.count(F.lit(1)).alias("items"))


@query
def j6_page_fill(spark, d):
    """Items filled from their landed pages, two of some address: body and image from the page, author only where there is none."""
    rows = table(spark, d, "extracted_articles")
    esc = lambda c: F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    paras = F.array_join(F.transform(F.split("body", "\n"), lambda x: F.concat(F.lit("<p>"), esc(x), F.lit("</p>"))), "")
    head = F.concat(F.lit("<html><head><meta property='og:image' content='"), F.coalesce("image", F.lit("")), F.lit("'></head><body><i class='by'>"), esc(F.coalesce("author", F.lit("desk"))))
    first = F.concat(head, F.lit("</i><div class='story'>"), paras, F.lit("</div></body></html>"))
    pages = rows.select("url", first.alias("html"), (2 * F.col("page_id")).alias("at")).unionByName(rows.select("url", F.lit("<div class='story'><p>later</p></div>").alias("html"), (2 * F.col("page_id") + 1).alias("at")))
    none = F.lit(None).cast("string")
    items = rows.select("page_id", "url", F.lit("").alias("body"), F.col("author"), none.alias("image"), F.lit("feed").alias("published"))
    items = items.unionByName(rows.select(-F.col("page_id"), F.concat("url", F.lit("#none")), F.lit("own"), F.lit("own"), none, none).toDF(*items.columns))
    pack = {"article": {"body": "div.story > p", "author": "i.by", "image": "meta[property='og:image']@content"}}
    return feeds.with_bodies(items, pages, pack, order="at").select("page_id", F.md5("body").alias("body"), "author", "image", "published")


@query
def j8_orphan_runs(spark, d):
    return schedule.orphan_runs(table(spark, d, "fetch_log"), table(spark, d, "source_state").filter("last_run_at is not null")).select("id", "source_id")


@query
def j7_near_known(spark, d):
    """Incoming articles near an accepted one published from 2026 on (the recent fingerprints)."""
    recent = table(spark, d, "articles").filter(F.col("published_at") >= F.lit("2026-01-01").cast("timestamp"))
    return dedupe.near_known(table(spark, d, "incoming_articles"), recent, "article_id", "simhash")


@query
def j5_packs(spark, d):
    """Outlets with their selector pack, of the packs that active outlets use, and how many active outlets share it."""
    packs = table(spark, d, "sources").filter("active and selectors is not null").groupBy(F.col("selectors").alias("pack")).agg(F.count(F.lit(1)).alias("users"))
    return table(spark, d, "sources").join(packs, F.col("selectors") == F.col("pack"), "left").select("id", "pack", "users")


@query
def k1_inserted(spark, d):
    from khabarloom.sources.sinks import to_insert

    return to_insert(table(spark, d, "incoming_articles"), table(spark, d, "articles"), "url_hash", "article_id").select("article_id", "source_id", "url_hash")


def _marked_runs(spark: SparkSession, d: str) -> DataFrame:
    """The log with the marks that responses bring: a new etag with every changed payload."""
    changed = F.when(F.col("ok") & ~F.col("not_modified"), F.concat(F.lit('"'), F.col("id").cast("string"), F.lit('"'))).otherwise("")
    return table(spark, d, "fetch_log").withColumn("etag", changed).withColumn("last_modified", F.lit(None).cast("string"))


@query
def k3_saved_state(spark, d):
    """The stored state after all runs of the log, which come after it."""
    state = schedule.saved_state(_marked_runs(spark, d), table(spark, d, "sources"), table(spark, d, "source_state"))
    return state.select("id", "etag", "last_modified", _s("last_run_at"), _s("next_run_at"), "consecutive_failures", "last_error")


@query
def k7_inventory_lines(spark, d):
    """The rows of the two tables of outlets."""
    return inventory.inventory_lines(table(spark, d, "sources"))


@query
def op_p1_normalize(spark, d):
    """Items with the instants their articles have: from the feed, from the page where that is said to be a guess, or none."""
    stated = table(spark, d, "articles").groupBy(F.col("item_ordinal").alias("ordinal"), "published_estimated").agg(F.min(F.unix_seconds("published_at")).alias("at"))
    feed, page = (stated.filter(F.col("published_estimated") == guess).select("ordinal", "at") for guess in (False, True))
    got = art.normalize(table(spark, d, "raw_items"), table(spark, d, "sources"), feed, page)
    return got.select("ordinal", "source_id", "url_hash", "title", "lang", "category", _s("published_at"), "published_estimated", "author", "body_missing")


@query
def op_p2_published_ladder(spark, d):
    """The ladder over articles: what the article says unless estimated, then what it says if it has an author, then when it was fetched."""
    feed = F.when(~F.col("published_estimated"), F.col("published_at"))
    page = F.when(F.col("author").isNotNull(), F.col("published_at"))
    at, guess = art.published_ladder(feed, page, F.col("fetched_at"))
    return table(spark, d, "articles").select("article_id", F.unix_seconds(at).alias("published_s"), guess.alias("estimated"))


@query
def op_p3_language(spark, d):
    s = table(spark, d, "sources").select(F.col("id").alias("source_id"), F.col("lang").alias("outlet"))
    return table(spark, d, "raw_items").join(s, "source_id").select("ordinal", art.language(F.col("outlet"), F.col("title")).alias("lang"))


@query
def op_p5_implausible(spark, d):
    return table(spark, d, "articles").filter(art.implausible(F.col("published_at"), F.col("fetched_at"))).select("article_id")


@query
def op_p8_selected(spark, d):
    """What each way to select sources gives: by name (an inactive one too), by priority, the due ones, all active ones."""
    sources, state = table(spark, d, "sources"), table(spark, d, "source_state")
    off = sources.filter("not active").agg(F.min("id")).first()[0]
    picks = {"name": {"source": off}, "priority": {"priority": 2}, "due": {"due": (state, F.lit(AS_OF).cast("timestamp"))}, "active": {}}
    parts = [schedule.select_sources(sources, **how).select(F.lit(name).alias("mode"), "id") for name, how in picks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query
def op_p9_article_text(spark, d):
    """Texts of articles, and of the same ones with a title or a body of blanks."""
    form = lambda n, x, y: F.struct(F.lit(n).alias("form"), x.alias("t"), y.alias("b"))
    forms = F.array(form("as is", F.col("title"), F.col("body")), form("no title", F.lit(" \n"), F.col("body")), form("no body", F.col("title"), F.lit("\t\n \u00a0")))
    rows = table(spark, d, "articles").select("article_id", F.explode(forms).alias("r"), "summary")
    return rows.select("article_id", "r.form", F.md5(text.article_text(F.col("r.t"), F.col("r.b"), F.col("summary"))).alias("text"))


@query
def op_p10_poll_interval(spark, d):
    return table(spark, d, "sources").select("id", schedule.poll_interval(F.col("priority")).alias("minutes"))


@query
def op_p11_error_cut(spark, d):
    return table(spark, d, "fetch_log").filter("error is not null").select("id", text.truncate_error(F.repeat("error", 300)).alias("error"))


@query
def a1_run_counters(spark, d):
    return schedule.run_counters(table(spark, d, "fetch_log"))


@query
def a2_cycle_summary(spark, d):
    return schedule.cycle_summary(table(spark, d, "fetch_log")).withColumn("day", F.col("day").cast("string"))


@query
def a3_config_counts(spark, d):
    return table(spark, d, "sources").agg(F.count(F.lit(1)).alias("configured"), F.count_if("active").alias("active"))


@query
def a4_estimated(spark, d):
    return table(spark, d, "articles").groupBy("source_id").agg(F.count_if("published_estimated").alias("estimated"), F.count(F.lit(1)).alias("articles"))


@query
def t4_fetch_state(spark, d):
    """What the last payload of each outlet says about the next request, and whether it was unchanged."""
    payloads = _marked_runs(spark, d).select("source_id", "etag", "last_modified", "not_modified", F.col("started_at").alias("fetched_at"))
    return registry.fetch_state(payloads)


@query
def x1_not_in_mix(spark, d):
    """Set difference: active outlets that no mix asks for."""
    return table(spark, d, "sources").filter("active").select("id").subtract(table(spark, d, "mix_targets").select(F.col("source").alias("id")))


@query
def a11_unhealthy(spark, d):
    return schedule.unhealthy(table(spark, d, "fetch_log"), 2)


@query
def w2_failure_streak(spark, d):
    return schedule.failure_streaks(table(spark, d, "fetch_log")).select("id", "source_id", "streak")


@query
def w3_next_run(spark, d):
    return schedule.next_runs(table(spark, d, "fetch_log"), table(spark, d, "sources")).select("id", "streak", "backoff", _s("next_run_at"))


@query
def w4_inventory(spark, d):
    return art.inventory(table(spark, d, "sources")).select("id", "active", "rank")


@query
def w5_first_items(spark, d):
    return art.first_per_source(table(spark, d, "raw_items"), 25).select("ordinal", "source_id", "rank")


@query
def o1_recent_fingerprints(spark, d):
    return art.recent_fingerprints(table(spark, d, "articles"), F.lit("2026-01-01").cast("timestamp")).select("url_hash", "simhash", _s("published_at"))


_CARDS = {"listing": {"item": "div.card", "link": "h2 a@href", "title": "h2 a", "summary": "div.text > p"}}
#: Items in a feed or listing that a query writes.
_FEED_ITEMS = 20


def _feeds(spark: SparkSession, d: str) -> DataFrame:
    """Items written as feeds of several items each, in order: (source_id, url, payload)."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    tag = lambda n, c: F.concat(F.lit(f"<{n}>"), esc(F.coalesce(c, F.lit(""))), F.lit(f"</{n}>"))
    item = F.concat(F.lit("<item>"), tag("title", F.col("title")), tag("link", F.col("url")), tag("description", F.col("summary")), tag("guid", F.col("ordinal").cast("string")), tag("author", F.col("author")), tag("pubDate", F.col("published")), F.lit("</item>"))
    rows = table(spark, d, "raw_items").select("source_id", F.floor(F.col("ordinal") / _FEED_ITEMS).alias("feed"), F.struct("ordinal", item.alias("x")).alias("i"))
    many = rows.groupBy("source_id", "feed").agg(F.array_sort(F.collect_list("i")).alias("all"))
    return many.select("source_id", F.lit("https://feeds.example/all").alias("url"), F.concat(F.lit("<rss><channel><title>t</title>"), F.array_join(F.transform("all", lambda i: i["x"]), ""), F.lit("</channel></rss>")).alias("payload"))


@query
def s1_rss_items(spark, d):
    """Items written as RSS, several to a feed, and read back."""
    return feeds.feed_items(_feeds(spark, d), ["source_id"]).select(F.col("guid").cast("long").alias("ordinal"), "source_id", "url", "title", "summary", "author", "published")


@query
def s9_payload_items(spark, d):
    """Landed payloads of both methods, each read by its outlet's reader; outlets whose stored etag still holds bring nothing."""
    held = table(spark, d, "source_state").filter("etag is not null").select(F.col("id").alias("source_id"), F.lit(True).alias("not_modified"))
    method = table(spark, d, "sources").select(F.col("id").alias("source_id"), "method")
    landed = _feeds(spark, d).join(method.filter("method = 'rss'"), "source_id").join(held, "source_id", "left")
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    card = F.concat(F.lit('<div class="card"><h2><a href="'), esc(F.col("url")), F.lit('">'), esc(F.col("title")), F.lit("</a></h2></div>"))
    pages = table(spark, d, "raw_items").select("source_id", F.lit("https://list.example/all").alias("at"), card.alias("payload"), "ordinal")
    pages = pages.groupBy("source_id", "at", F.floor(F.col("ordinal") / _FEED_ITEMS).alias("feed")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "payload"))), lambda x: x["payload"]), "").alias("payload"))
    pages = pages.join(method.filter("method = 'html'"), "source_id").join(held, "source_id", "left").select("source_id", F.col("at").alias("url"), "payload", "not_modified")
    rss = registry.read_payloads("rss", landed.select("source_id", "url", "payload", "not_modified"))
    html_ = registry.read_payloads("html", pages, _CARDS)
    return rss.unionByName(html_).groupBy("source_id", "url").agg(F.count(F.lit(1)).alias("times"), F.min("title").alias("title"))


@query
def s2_listing_items(spark, d):
    """Items written as cards of a listing page, each again with its whole address, and read back with a selector pack."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit('"'), F.lit("&quot;"))
    path = F.regexp_extract("url", "^[^:]+://[^/]+(/[^#]*)", 1)
    again = F.concat(F.lit('<div class="card"><h2><a href="https://list.example'), esc(path), F.lit('">again</a></h2></div>'))
    card = F.concat(F.lit('<div class="ad"><h2><a href="/x">x</a></h2></div><div class="card big"><h2><a href="'), esc(path), F.lit('">'), esc(F.col("title")), F.lit('</a></h2><div class="text"><b><p>no</p></b><p>'), esc(F.col("summary")), F.lit("</p></div></div>"), again)
    pages = table(spark, d, "raw_items").select("ordinal", F.lit("https://list.example/all").alias("url"), card.alias("html"))
    return feeds.listing_items(pages, _CARDS, ["ordinal"]).select("ordinal", "place", "url", "title", "summary")


_PACK = {"article": {"body": "div.story > p", "author": "jsonld:author.name", "published": "time@datetime", "image": "meta[property='og:image']@content"}, "exclude": ["script", "div.story p.ad"]}


@query
def f29_extract(spark, d):
    """Articles written as pages and read back: paragraphs, JSON-LD, attributes, exclusions."""
    paras = F.array_join(F.transform(F.filter(F.split("body", "\n"), lambda x: F.trim(x) != ""), lambda x: F.concat(F.lit("<p>"), F.replace(F.replace(x, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")))), "<p class='ad'>buy</p>")
    ld = F.concat(F.lit('<script type="application/ld+json">{"@graph":[{"@type":"Organization","author":{"name":"no"}},{"@type":["NewsArticle"],"author":[{"name":"'), F.coalesce("author", F.lit("")), F.lit('"}]}]}</script>'))
    page = F.concat(F.lit("<html><head><meta property='og:image' content='i.jpg'>"), ld, F.lit("</head><body><nav><p>menu</p></nav><div class='story x'>"), paras, F.lit("</div><time datetime='2026-01-02'>x</time>"))
    got = table(spark, d, "articles").select("article_id", html.extract(page, _PACK).alias("e"))
    return got.select("article_id", F.md5("e.body").alias("body"), "e.author", "e.published", "e.image")


@query
def f15_bs_dates(spark, d):
    """Every day of the calendar written as a Bikram Sambat date, and read."""
    months = table(spark, d, "bs_months")
    names = F.array(*(F.lit(x) for x in ("वैशाख", "जेठ", "असार", "साउन", "भदौ", "असोज", "कात्तिक", "मंसिर", "पुस", "माघ", "फागुन", "चैत")))
    rows = months.withColumn("day", F.explode(F.sequence(F.lit(1), F.col("days"))))
    number = F.col("bs_year") * 10000 + F.col("bs_month") * 100 + F.col("day")
    written = F.translate(F.format_string("%s %d, %d 14:29:53", F.element_at(names, F.col("bs_month")), F.col("day"), F.col("bs_year")), text.ASCII_DIGITS, text.DEVANAGARI_DIGITS)
    items = rows.select(F.lit("x").alias("source_id"), number.cast("long").alias("ordinal"), written.alias("published"), F.lit(None).cast("timestamp").alias("fetched_at"))
    got = times.item_times(items, table(spark, d, "source_zones"), months, table(spark, d, "zone_names"))
    return got.select("ordinal", "at")


@query
def f19_feed_dates(spark, d):
    """Start times of runs written as feed dates with Nepal's offset, and read."""
    log = table(spark, d, "fetch_log")
    local = F.from_utc_timestamp("started_at", "Asia/Kathmandu")
    written = F.concat(F.lit("Mon, "), F.date_format(local, "dd MMM yyyy HH:mm:ss"), F.lit(" +0545"))
    items = log.select("source_id", F.col("id").alias("ordinal"), written.alias("published"), F.col("started_at").alias("fetched_at"))
    return times.item_times(items, *(table(spark, d, t) for t in ("source_zones", "bs_months", "zone_names"))).select("ordinal", "at")


def _iso_dates(spark: SparkSession, d: str, zones: DataFrame) -> DataFrame:
    log = table(spark, d, "fetch_log").join(zones, "source_id")
    written = F.date_format(F.from_utc_timestamp("started_at", F.col("zone")), "yyyy-MM-dd'T'HH:mm:ss")
    items = log.select("source_id", F.col("id").alias("ordinal"), written.alias("published"), F.col("started_at").alias("fetched_at"))
    return times.item_times(items, table(spark, d, "source_zones"), table(spark, d, "bs_months"), table(spark, d, "zone_names")).select("ordinal", "at")


@query
def f18_iso_dates(spark, d):
    """Start times written without a zone, in each outlet's own clock, and read; a clock that occurs twice is its first occurrence."""
    return _iso_dates(spark, d, table(spark, d, "source_zones"))


@query
def f18_modes(spark, d):
    """Bikram Sambat and other dates read in each mode of a selector pack: how many each can read."""
    zones, months, names = (table(spark, d, t) for t in ("source_zones", "bs_months", "zone_names"))
    none = F.lit(None).cast("timestamp").alias("fetched_at")
    bs = months.select(F.lit("bs").alias("source_id"), (F.col("bs_year") * 100 + F.col("bs_month")).cast("long").alias("ordinal"), F.format_string("%d साउन १", F.col("bs_year")).alias("published"), none)
    iso = table(spark, d, "fetch_log").select(F.lit("iso").alias("source_id"), (F.col("id") + 1_000_000_000).alias("ordinal"), F.date_format("started_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published"), none)
    parts = [times.item_times(bs.unionByName(iso), zones, months, names, m).groupBy(F.col("source_id").alias("form")).agg(F.count(F.lit(1)).alias("readable")).withColumn("mode", F.lit(m)) for m in ("bs", "iso", "auto")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def f24_jsonld_value(spark, d):
    """Titles written into JSON-LD beside an organisation, and read by path."""
    ld = F.to_json(F.array(F.struct(F.lit("Organization").alias("@type"), F.lit("no").alias("headline")), F.struct(F.lit("NewsArticle").alias("@type"), F.col("title").alias("headline"))))
    page = F.concat(F.lit('<script type="application/ld+json">{broken</script><script type="application/ld+json">'), ld, F.lit("</script>"))
    return table(spark, d, "articles").select("article_id", html.extract(page, {"article": {"body": "jsonld:headline"}})["body"].alias("title"))


@query
def s8_retry_after(spark, d):
    header = F.when(F.col("id") % 3 == 0, F.col("items_seen").cast("string")).when(F.col("id") % 3 == 1, F.concat(F.lit(" "), (F.col("items_seen") * 10).cast("string"))).otherwise("Wed, 21 Oct 2026 07:28:00 GMT")
    return table(spark, d, "fetch_log").select("id", urls.retry_after(header).alias("seconds"))


@query
def s7_robots(spark, d):
    rows = table(spark, d, "raw_items").select("ordinal", "url")
    origins = rows.select(F.regexp_extract("url", "^([^:/?#]+://[^/?#]*)", 1).alias("origin")).distinct()
    robots = origins.withColumn("text", F.when(F.col("origin").startswith("https"), "User-agent: *\nDisallow: /desh/\n"))
    return feeds.allowed_by_robots(rows, robots).select("ordinal")


@query
def s11_source_validation(spark, d):
    """The outlets, and again with a field missing."""
    rows = table(spark, d, "sources")
    bare = rows.withColumn("id", F.concat(F.lit("bare-"), F.col("id"))).withColumn("lang", F.lit(None).cast("string")).withColumn("url", F.when(F.col("active"), F.col("url")))
    return art.validate_sources(rows.unionByName(bare)).select("id", "problem")


@query
def a8_daily_volume(spark, d):
    return art.daily_volume(table(spark, d, "articles")).withColumn("day", F.col("day").cast("string"))


@query
def a9_week_over_week(spark, d):
    return art.week_over_week(table(spark, d, "articles")).withColumn("week", F.col("week").cast("string"))


@query
def d9_cosine_neighbours(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", "embedding")
    return art.cosine_neighbours(rows, rows.filter("vec_id % 20 = 0"))


#: The cosine from which vectors of these tables tell one story; they are nearly at right angles.
STORY_COSINE = 0.3


def _dated_vectors(spark: SparkSession, d: str) -> DataFrame:
    """Vectors with the time of the document of the same number."""
    documents = table(spark, d, "documents").select((F.col("doc_id") - 1).alias("vec_id"), "published_at")
    return table(spark, d, "embeddings").select("vec_id", "embedding").join(documents, "vec_id")


@query
def d9_story_clusters(spark, d):
    """Vectors of one story: alike and told within 48 hours of one another, and what is so connected."""
    return art.story_clusters(_dated_vectors(spark, d), "vec_id", "published_at", "embedding", STORY_COSINE)


@query
def a10_stories_per_day(spark, d):
    """Each day's documents and stories, an event counted once a day."""
    rows = _dated_vectors(spark, d)
    clusters = art.story_clusters(rows, "vec_id", "published_at", "embedding", STORY_COSINE)
    return art.stories_per_day(rows, clusters, "vec_id", "published_at").withColumn("day", F.col("day").cast("string"))


def _arrive(rows: DataFrame, order: str, path: str, files: int = 4) -> None:
    """Write ``rows`` as files that appear one after the other, in ranges of ``order``."""
    place = F.col(order).cast("double")
    bounds = rows.select(place.alias("x")).approxQuantile("x", [k / files for k in range(1, files)], 0.01)
    piece = F.coalesce(sum(((place > x).cast("int") for x in bounds), F.lit(0)), F.lit(0))
    for k in range(len(bounds) + 1):
        rows.filter(piece == k).coalesce(1).write.mode("append").parquet(path)


@query
def t1_stream_insert(spark, d):
    """Incoming articles as a stream of files, a batch each, inserted if absent; equal to the batch result."""
    import uuid

    at = f"{shared_dir(spark)}/t1-{uuid.uuid4().hex}"
    rows = table(spark, d, "incoming_articles").select("article_id", "source_id", "url_hash")
    _arrive(rows, "article_id", f"{at}/in")
    stream = ingest.read_stream(spark, f"{at}/in", rows.schema.simpleString()[7:-1].replace(":", " "))
    ingest.ingest_stream(stream, f"{at}/out", f"{at}/log", order="article_id").awaitTermination()
    return spark.read.parquet(f"{at}/out").select("article_id", "source_id", "url_hash")


@query
def t3_state_stream(spark, d):
    """Run state kept by a stream over the whole log, from the stored state on; equal to the state computed at once."""
    import uuid

    at = f"{shared_dir(spark)}/t3-{uuid.uuid4().hex}"
    runs = _marked_runs(spark, d).select("source_id", "started_at", "id", "ok", "error", "etag", "last_modified")
    _arrive(runs, "started_at", f"{at}/in")
    stream = ingest.read_stream(spark, f"{at}/in", "source_id string, started_at timestamp, id bigint, ok boolean, error string, etag string, last_modified string")
    ingest.state_stream(stream, table(spark, d, "sources"), table(spark, d, "source_state"), f"{at}/out", f"{at}/log").awaitTermination()
    every = spark.read.parquet(f"{at}/out")
    last = every.join(every.agg(F.max("batch").alias("batch")), "batch")
    return last.select("id", "etag", "last_modified", _s("last_run_at"), _s("next_run_at"), "consecutive_failures", "last_error")


@query
def t5_stream_near(spark, d):
    """Incoming articles as a stream, near-duplicates of the last 48 hours left out. What a row meets depends on its batch: no SQL."""
    import uuid

    at = f"{shared_dir(spark)}/t5-{uuid.uuid4().hex}"
    rows = table(spark, d, "incoming_articles").select("article_id", "url_hash", "simhash", "published_at")
    _arrive(rows, "article_id", f"{at}/in")
    stream = ingest.read_stream(spark, f"{at}/in", "article_id bigint, url_hash string, simhash bigint, published_at timestamp")
    ingest.ingest_stream(stream, f"{at}/out", f"{at}/log", order="article_id", fingerprint="simhash").awaitTermination()
    return spark.read.parquet(f"{at}/out").select("article_id", "url_hash")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in _QUERIES}
