"""Operators against brute force, and invariants of sinks and streams."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from khabarloom.operators import articles, dedupe, groups, schedule
from khabarloom.sources import config, feeds, inventory, registry, sinks
from khabarloom.streaming import ingest

from .conftest import rows


def fingerprints(seed, n=120):
    rng = random.Random(seed)
    out = [rng.getrandbits(64) for _ in range(n // 4)]
    while len(out) < n:
        x = rng.choice(out)
        for b in rng.sample(range(64), rng.randrange(0, 12)):
            x ^= 1 << b
        out.append(x)
    return [(i + 1, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(out)]


def distance(a, b):
    return ((a ^ b) & (1 << 64) - 1).bit_count()


@pytest.mark.parametrize("seed", [1, 2])
def test_near_pairs_and_greedy(spark, seed):
    data = [*fingerprints(seed), (900, 0), (901, 0), (902, None), (903, fingerprints(seed)[0][1])]
    df = spark.createDataFrame(data, "id bigint, h bigint")
    first = {}
    for i, h in data:
        if h:
            first.setdefault(h, i)
    want = sorted((a, b, distance(x, y)) for x, a in first.items() for y, b in first.items() if a < b and distance(x, y) <= 8)
    assert rows(dedupe.near_pairs(df, "id", "h"), "a", "b", "distance") == sorted(want, key=repr)
    held, kept = [], {}
    for i, h in data:
        kept[i] = not h or all(distance(h, x) > 8 for x in held)
        if h and kept[i]:
            held.append(h)
    assert dict(rows(dedupe.greedy_keep(df.repartition(7), "id", "h"))) == kept
    with pytest.raises(ValueError):
        dedupe.partition_pairs(df, "id", "h", [list(range(i, i + 16)) for i in range(0, 64, 16)], (1, 1, 1, 1))


def test_greedy_on_nothing(spark):
    empty = spark.createDataFrame([], "id bigint, h bigint")
    assert dedupe.greedy_keep(empty, "id", "h").count() == 0


def test_first_per_key(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a"), (4, None), (5, None)], "ordinal bigint, k string")
    assert rows(dedupe.first_per_key(df, "k", "ordinal"), "ordinal") == [(1,), (2,), (4,), (5,)]


def test_streaks_over_weeks(spark):
    rng = random.Random(3)
    start = datetime(2026, 1, 1)
    data = [(i, "ab"[i % 2], start + timedelta(hours=9 * i), rng.random() < 0.3) for i in range(300)] + [(400 + i, "c", start + timedelta(days=4 * i), False) for i in range(12)]
    want, run = [], {}
    for i, s, t, ok in sorted(data, key=lambda r: (r[2], r[0])):
        run[s] = 0 if ok else run.get(s, 0) + 1
        want.append((i, run[s]))
    df = spark.createDataFrame(data, "id bigint, source_id string, started_at timestamp, ok boolean")
    assert rows(schedule.failure_streaks(df), "id", "streak") == sorted(want, key=repr)


def test_backoff(spark):
    df = spark.createDataFrame([(15, 0), (15, 1), (15, 4), (15, 5), (360, 1)], "i int, n int")
    assert [r[0] for r in df.select(schedule.backoff_minutes(F.col("i"), F.col("n"))).collect()] == [15, 30, 240, 360, 360]


def test_upsert_twice(spark, tmp_path):
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "ordinal bigint, url_hash string")
    path = str(tmp_path / "t")
    assert sinks.upsert(batch, path) == 2
    assert sinks.upsert(batch, path) == 0
    assert sinks.upsert(spark.createDataFrame([(9, "c"), (8, "a")], batch.schema), path) == 1
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (9, "c")]


def test_stream_is_idempotent(spark, tmp_path):
    schema = "ordinal bigint, url_hash string"
    for k in range(3):
        spark.createDataFrame([(10 * k + i, f"h{(k + i) % 4}") for i in range(3)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):
        stream = ingest.read_stream(spark, str(tmp_path / "in"), schema)
        ingest.ingest_stream(stream, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == out.select("url_hash").distinct().count() == 4


def test_validation(spark):
    good = ("a", "A", "https://a.example", "rss", "ne", "news", 1, True, None, None)
    cases = [(good, None), ((*good[:2], "ftp://a", *good[3:]), "url"), ((*good[:7], False, None, None), "inactive_reason"), ((*good[:3], "html", *good[4:]), "selectors"), ((*good[:3], "soap", "xx", *good[5:]), "method"), ((None, *good[1:]), "missing: id")]
    df = spark.createDataFrame([c for c, _ in cases], "id string, name string, url string, method string, lang string, category string, priority int, active boolean, inactive_reason string, selectors string")
    assert [r.problem for r in articles.validate_sources(df).collect()] == [p for _, p in cases]


RSS = """<rss version="2.0"><channel><title>t</title><item><title> One &amp; <![CDATA[two]]></title><link> /a </link><guid isPermaLink="false">g1</guid><pubDate>
 Mon, 17 Aug 2026   13:32:57 +0000 </pubDate></item><item><title></title><link>/b</link></item><item><title>c</title></item></channel></rss>"""
ATOM = '<feed><entry><title>A</title><link rel="self" href="/s"/><link href="/x"/><id>i</id><updated>2026-01-02T00:00:00Z</updated><author><name>N</name></author></entry></feed>'


def test_feeds(spark):
    df = spark.createDataFrame([(1, "https://h.example/feed", RSS), (2, "https://h.example/", ATOM), (3, "https://h.example/", "not xml"), (4, "https://h.example/", None)], "n int, url string, payload string")
    got = feeds.feed_items(df, ["n"]).orderBy("n").collect()
    assert [tuple(r) for r in got] == [
        (1, 0, "https://h.example/a", "One & two", "", None, "g1", "Mon, 17 Aug 2026 13:32:57 +0000"),
        (2, 0, "https://h.example/x", "A", "", "N", "i", "2026-01-02T00:00:00Z"),
    ]


def test_listing_and_bodies(spark):
    page = '<div class="card"><h2><a href="/1">T1</a></h2><div class="d"><p>by</p></div><p>s1</p></div><div class="card"><h2><a href="/1">again</a></h2></div><div class="card"><h2><a>no link</a></h2></div>'
    pack = {"listing": {"item": "div.card", "link": "h2 a@href", "title": "h2 a", "summary": "div.card > p"}}
    df = spark.createDataFrame([(page, "https://h.example/l")], "html string, url string")
    items = feeds.listing_items(df, pack, [])
    assert [tuple(r) for r in items.collect()] == [(0, "https://h.example/1", "T1", "s1", None)]
    pages = spark.createDataFrame([("https://h.example/1", "<p>body</p><i>who</i>")], "url string, html string")
    full = items.selectExpr("url", "title", "'' AS body", "'own' AS author", "cast(null AS string) AS image", "published")
    got = feeds.with_bodies(full, pages, {"article": {"body": "p", "author": "i"}}).first()
    assert (got.body, got.author) == ("body", "own")


def test_pages_never_multiply_items(spark):
    items = spark.createDataFrame([("u", "", "own", None, "p"), ("v", "kept", None, "i", None), (None, "x", None, None, None)], "url string, body string, author string, image string, published string")
    pages = spark.createDataFrame([("u", "<p>late</p><i>late</i>", 2), ("u", "<p>body</p><i>who</i>", 1), (None, "<p>none</p>", 0), ("w", "<p>w</p>", 3)], "url string, html string, at int")
    got = rows(feeds.with_bodies(items, pages, {"article": {"body": "p", "author": "i"}}, order="at"))
    assert got == sorted([("u", "body", "own", None, "p"), ("v", "kept", None, "i", None), (None, "x", None, None, None)], key=repr)
    assert feeds.with_bodies(items, pages.limit(0), {"article": {"body": "p"}}).count() == 3


def test_cards_of_one_address(spark):
    page = '<div class="card"><a href="/1">T1</a></div><div class="card"><a href="https://h.example/1">again</a></div><div class="card"><a href=" 2 ">T2</a></div>'
    df = spark.createDataFrame([(page, "https://h.example/l/all"), (None, None)], "html string, url string")
    got = feeds.listing_items(df, {"listing": {"item": "div.card", "link": "a@href", "title": "a"}}, [])
    assert [(r.url, r.title) for r in got.collect()] == [("https://h.example/1", "T1"), ("https://h.example/l/2", "T2")]


RUN = "source_id string, started_at timestamp, id bigint, ok boolean, error string, etag string, last_modified string"
STATE = "id string, etag string, last_modified string, last_run_at timestamp, next_run_at timestamp, consecutive_failures int, last_error string"


def test_state_goes_on_from_the_stored_one(spark, tmp_path):
    """Batches of runs on a stored state, one by one, against the rule applied run by run."""
    rng = random.Random(8)
    start = datetime(2026, 1, 1)
    sources = spark.createDataFrame([(s, k % 4 + 1) for k, s in enumerate("abcde")], "id string, priority int")
    state = {"a": ("e0", "m0", start, start, 3, "old"), "b": (None, None, None, None, 0, None), "e": ("keep", None, start, start, 2, "x" * 9)}
    initial = spark.createDataFrame([(s, *v) for s, v in state.items()], STATE)
    runs = []
    for i in range(60):
        ok = rng.random() < 0.4
        runs.append(("abcd"[i % 4], start + timedelta(minutes=i // 2), i, ok, None if ok else "e" * 3000, rng.choice(["", None, f"t{i}"]), rng.choice(["", f"m{i}"])))
    want = dict(state)
    minutes = {s: (15, 30, 60, 360)[k % 4] for k, s in enumerate("abcde")}
    for s, at, _, ok, error, etag, modified in sorted(runs, key=lambda r: (r[1], r[2])):
        e, m, _, _, n, _ = want.get(s, (None, None, None, None, 0, None))
        n = 0 if ok else n + 1
        wait = minutes[s] if ok else min(minutes[s] * 2**n, 360)
        want[s] = (etag or e, modified or m, at, at + timedelta(minutes=wait), n, None if ok else error[:2000])
    want = sorted([(s, *v) for s, v in want.items()], key=repr)
    df = spark.createDataFrame(runs, RUN)
    assert rows(schedule.saved_state(df, sources, initial)) == want
    assert rows(schedule.saved_state(df.limit(0), sources, initial)) == rows(initial)
    for k in range(3):
        df.filter(F.floor(F.col("id") / 20) == k).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ingest.read_stream(spark, str(tmp_path / "in"), RUN)
    ingest.state_stream(stream, sources, initial, str(tmp_path / "out"), str(tmp_path / "log")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out/batch=2"))) == want


def test_stream_leaves_near_rows_out(spark, tmp_path):
    rng = random.Random(2)
    start = datetime(2026, 1, 1)
    base = [rng.getrandbits(63) | 1 for _ in range(6)]
    data = []
    for i in range(45):
        h = rng.choice(base) ^ sum(1 << k for k in rng.sample(range(64), rng.choice([0, 2, 5, 9])))
        data.append((i, f"u{rng.randrange(30)}", h - (1 << 64) if h >> 63 else h, start + timedelta(hours=6 * i)))
    schema = "ordinal bigint, url_hash string, simhash bigint, published_at timestamp"
    for k in range(3):
        spark.createDataFrame(data[15 * k : 15 * k + 15], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = ingest.read_stream(spark, str(tmp_path / "in"), schema)
    ingest.ingest_stream(stream, str(tmp_path / "out"), str(tmp_path / "log"), fingerprint="simhash").awaitTermination()
    held = []
    for k in range(3):
        seen, batch = {u for _, u, _, _ in held}, []
        for r in data[15 * k : 15 * k + 15]:
            if r[1] not in seen:
                seen.add(r[1])
                batch.append(r)
        since = max(r[3] for r in batch) - timedelta(hours=48)
        recent = [r for r in held if r[3] >= since]
        for r in batch:
            if all(distance(r[2], x[2]) > 8 for x in recent):
                recent.append(r)
                held.append(r)
    assert rows(spark.read.parquet(str(tmp_path / "out")), "ordinal") == sorted([(r[0],) for r in held], key=repr)


def test_one_source_fails_alone(spark):
    def run(s):
        if s == "b":
            raise RuntimeError("broken")
        return spark.range(3).count()

    got = rows(ingest.run_isolated(spark, ["a", "b", "c"], run), "source_id", "ok", "error", "value")
    assert got == [("a", True, None, "3"), ("b", False, "RuntimeError: broken", None), ("c", True, None, "3")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(200, 300 + k) for k in range(40)] + [(500 + k, 501 + k) for k in range(30)] + [(7, 7), (None, 3)]
    label = {x: x for e in edges for x in e if None not in e}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            if a is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                moved = True
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    found = groups.components(df)
    assert rows(found, "id", "component") == sorted(label.items(), key=repr)
    own = groups.with_component(spark.createDataFrame([(1000,), (200,)], "k bigint"), found, "k")
    assert rows(own, "k", "component") == [(1000, 1000), (200, 200)]
    assert groups.components(df.limit(0)).count() == 0


def test_story_clusters(spark):
    rng = random.Random(4)
    start = datetime(2026, 1, 1)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(30)]
    data = [(i, start + timedelta(hours=rng.randrange(200)), [x + rng.gauss(0, 0.1) for x in rng.choice(base)]) for i in range(150)] + [(900, start, [0.0] * 8), (901, None, base[0]), (902, start, None)]
    import numpy as np

    want = []
    for k, (i, t, v) in enumerate(data[:150]):
        for j, u, w in data[k + 1 : 150]:
            c = np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)
            if c >= 0.9 and abs((t - u).total_seconds()) <= 48 * 3600:
                want.append((i, j))
    df = spark.createDataFrame(data, "k bigint, at timestamp, v array<double>").withColumn("id", F.lit("clash"))
    articles.TILE, kept = 7, articles.TILE
    try:
        got = rows(articles.story_pairs(df, "k", "at", "v", 0.9))
    finally:
        articles.TILE = kept
    assert want and got == sorted(want, key=repr)
    clusters = articles.story_clusters(df, "k", "at", "v", 0.9)
    assert clusters.count() == len(data) and clusters.filter("k >= 900 and k != cluster").count() == 0
    assert articles.story_pairs(df.limit(0), "k", "at", "v").count() == 0


def test_inventory_page(spark):
    df = spark.createDataFrame([("b", "B", "https://b", "ne", "news", 2, "rss", True, None), ("a", "A", "https://a", "en", "govt", 1, "html", True, None), ("z", "Z", "https://z", "en", "news", 1, "rss", False, "gone")], "id string, name string, url string, lang string, category string, priority int, method string, active boolean, inactive_reason string")
    on, off = inventory.inventory_tables(df)
    assert on.split("\n")[2:] == ["| 1 | A | <https://a> | en | govt | 1 | html |", "| 2 | B | <https://b> | ne | news | 2 | rss |"]
    assert off.split("\n")[2:] == ["| Z | <https://z> | gone |"]
    page = inventory.fill_block("x <!--1--> old <!--2--> y", "<!--1-->", "<!--2-->", on)
    assert not inventory.is_stale(page, [("<!--1-->", "<!--2-->", on)]) and inventory.is_stale(page, [("<!--1-->", "<!--2-->", off)])
    with pytest.raises(ValueError, match="no block"):
        inventory.fill_block(page, "<!--3-->", "<!--4-->", on)


def test_settings():
    got = config.load_settings({"MAX_RETRIES": "5", "RESPECT_ROBOTS": "no", "PER_HOST_DELAY": "0.5"})
    assert (got["MAX_RETRIES"], got["RESPECT_ROBOTS"], got["PER_HOST_DELAY"], got["REQUEST_TIMEOUT"], got["LOG_LEVEL"]) == (5, False, 0.5, 20.0, "INFO")
    with pytest.raises(ValueError, match="MAX_RETRIES"):
        config.load_settings({"MAX_RETRIES": "many"})


def test_registry_takes_readers(spark):
    payloads = spark.createDataFrame([("s", "https://h.example/f", "a b", False), ("s", "https://h.example/g", "c", True)], "source_id string, url string, payload string, not_modified boolean")
    registry.register("words", lambda p, pack: p.select("source_id", F.posexplode(F.split("payload", " ")).alias("place", "title"), "url").select("source_id", "place", "url", "title", *[F.lit(None).cast("string").alias(c) for c in registry.ITEM[4:]]))
    assert rows(registry.read_payloads("words", payloads), "place", "title") == [(0, "a"), (1, "b")]
    registry.register("words", lambda p, pack: p)
    with pytest.raises(ValueError, match="gives"):
        registry.read_payloads("words", payloads)
    with pytest.raises(ValueError, match="no reader"):
        registry.read_payloads("soap", payloads)


def test_config(spark, tmp_path):
    (tmp_path / "a.yaml").write_text("id: a\nname: A\nurl: https://a.example\nmethod: rss\nlang: ne\ncategory: news\npriority: 1\nactive: true\nrate_limit: 2\n")
    assert config.load_sources(spark, str(tmp_path)).first().rate_limit == 2.0
    (tmp_path / "b.yaml").write_text("id: c\n")
    with pytest.raises(ValueError, match="not the file's name"):
        config.load_sources(spark, str(tmp_path))
    (tmp_path / "p.yaml").write_text("")
    assert config.load_pack(str(tmp_path), "p") == {}


def test_neighbours_with_blocks(spark):
    rng = random.Random(5)
    data = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(3000)] + [(3000, [0.0] * 4), (3020, None)]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<float>")
    got = {}
    for q, n, r in rows(articles.cosine_neighbours(df, df.filter("vec_id % 20 = 0"), 3, 8)):
        got.setdefault(q, {})[r] = n
    import numpy as np

    m = np.array([v for _, v in data[:3000]], np.float32).astype(np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    for q in range(0, 3000, 20):
        s = m @ m[q]
        s[q] = -9
        assert [got[q][k] for k in (1, 2, 3)] == list(np.argsort(-s)[:3])
    assert 3000 not in got


def test_cut_and_release(spark):
    from khabarloom import runtime

    df = spark.createDataFrame([(1, "a", None)], "x int, `y z` string, w array<int>")
    assert rows(runtime.cut(df, "t")) == [(1, "a", None)]
    assert runtime.release(spark) >= 1
    assert runtime.release(spark) == 0
    with pytest.raises(ValueError):
        runtime.shared_dir(_Cluster())


class _Cluster:
    class conf:  # noqa: N801
        get = staticmethod(lambda name, default: default)

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"
