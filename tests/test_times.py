"""Readings of dates, Viterbi against brute force, and articles held against their items."""

from datetime import UTC, datetime, timedelta
from itertools import product
from zoneinfo import ZoneInfo

import pytest

from khabarloom.operators import times
from khabarloom.plans.queries import queries

from .conftest import SF, rows

BS = [(2082, 1, "2025-04-14", 31), (2083, 4, "2026-07-17", 31), (2083, 5, "2026-08-17", 31)]
READER = times.Reader(BS, [("NPT", 345), ("GMT", 0), ("EST", -300)])
KTM, NY = "Asia/Kathmandu", "America/New_York"


def at(*a):
    return int(datetime(*a, tzinfo=UTC).timestamp())


@pytest.mark.parametrize(
    ("text", "zone", "want"),
    [
        ("भदौ ३, २०८३ बुधबार १४:२९:५३", None, at(2026, 8, 19, 8, 44, 53)),
        ("०३ भदौ २०८३, बुधबार", None, at(2026, 8, 18, 18, 15)),
        ("२०८३ भदौ ३", None, at(2026, 8, 18, 18, 15)),
        ("Bhadau 3, 2083", None, at(2026, 8, 18, 18, 15)),
        ("१ बैशाख २०८२", None, at(2025, 4, 13, 18, 15)),
        ("श्रावण२९, २०८३", None, at(2026, 8, 13, 18, 15)),
        ("2026-08-19 14:29:53", KTM, at(2026, 8, 19, 8, 44, 53)),
        ("Mon, 17 Aug 2026 13:32:57 +0000", None, at(2026, 8, 17, 13, 32, 57)),
        ("\n  Mon, 17 Aug 2026 19:17:57 +0545\n", None, at(2026, 8, 17, 13, 32, 57)),
        ("2026-01-02T03:04:05.999999999Z", None, at(2026, 1, 2, 3, 4, 5)),
        ("1767225600", None, 1767225600),
        ("1767225600123", None, 1767225600),
        ("Jan 2, 2026, 3:04PM", KTM, at(2026, 1, 2, 9, 19)),
        ("12 January 2026 12:05 AM", "UTC", at(2026, 1, 12, 0, 5)),
        ("2026-01-02 10:00 EST", None, at(2026, 1, 2, 15)),
        ("2025-11-02 01:30:00", NY, at(2025, 11, 2, 5, 30)),  # twice: the first
        ("2025-03-09 02:30:00", NY, at(2025, 3, 9, 7, 30)),  # skipped: the offset before
        ("2026/03/04", "UTC", at(2026, 3, 4)),
    ],
)
def test_readings(text, zone, want):
    assert [t for _, t in READER.readings(text, zone)] == [want]


@pytest.mark.parametrize("text", [None, "", "कुनै मिति छैन", "N/A", "3 hours ago", "yesterday", "31 Feb 2026 10:00", "2026-01-01 25:61:00", "भदौ ३५, २०८३", "0000-00-00 00:00:00", "13:00 PM", "2026-01-02 10:00 XYZ"])
def test_unreadable(text):
    assert READER.readings(text, KTM) == []


def test_ambiguous_days():
    assert {t for _, t in READER.readings("03/04/2026", "UTC")} == {at(2026, 4, 3), at(2026, 3, 4)}
    assert [t for _, t in READER.readings("13/04/2026", "UTC")] == [at(2026, 4, 13)]


def test_viterbi_is_optimal():
    import random

    rng = random.Random(4)
    for _ in range(60):
        path = [[(rng.randrange(2), rng.randrange(5) * 86400) for _ in range(rng.randrange(1, 4))] for _ in range(rng.randrange(1, 5))]
        ends = [(rng.randrange(2), rng.randrange(5) * 86400) if rng.random() < 0.7 else None for _ in range(2)]

        def cost(p, ends=ends):
            full = [x for x in (ends[0], *p, ends[1]) if x is not None]
            return sum(times._step(a, b) for a, b in zip(full, full[1:]))

        assert cost(times.viterbi(path, *ends)) == pytest.approx(min(cost(p) for p in product(*path)))


@pytest.mark.parametrize("seed", [1, 2])
def test_long_runs_are_settled_by_chunks(spark, seed):
    """A source of nothing but ambiguous values, in chunks of every size: the path costs what the best one costs."""
    import random

    rng = random.Random(seed)
    data = [("a", 3 * i, [(f, rng.randrange(9) * 86400) for f in rng.sample(range(3), rng.randrange(2, 4))]) for i in range(40)]
    df = spark.createDataFrame([(s, o, [{"form": f, "at": t} for f, t in r]) for s, o, r in data], "source_id string, ordinal bigint, reads array<struct<form:int,at:bigint>>")
    best = times.viterbi([r for _, _, r in data], None, None)

    def least(instants):  # the cheapest path with these instants
        return times.viterbi([[x for x in r if x[1] == t] for (_, _, r), t in zip(data, instants)], None, None)

    cost = lambda p: sum(times._step(a, b) for a, b in zip(p, p[1:]))
    for chunk in (1, 2, 7, 30, 1000):
        got = rows(times.settle(df, chunk), "ordinal", "at")
        assert len(got) == len(data)
        assert cost(least([t for _, t in sorted(got)])) == pytest.approx(cost(best))


def test_modes(spark):
    items = spark.createDataFrame([("a", 1, "भदौ ३, २०८३", None), ("a", 2, "2026-08-19 14:29:53", None), ("a", 3, "x", None)], "source_id string, ordinal bigint, published string, fetched_at timestamp")
    zones = spark.createDataFrame([("a", KTM)], "source_id string, zone string")
    bs = spark.createDataFrame(BS, "bs_year int, bs_month int, first_day string, days int")
    names = spark.createDataFrame([("GMT", 0)], "abbr string, utc_offset_min int")
    got = {m: [r[0] for r in rows(times.item_times(items, zones, bs, names, m), "ordinal")] for m in ("bs", "iso", "auto")}
    assert got == {"bs": [1], "iso": [2], "auto": [1, 2]}
    with pytest.raises(ValueError, match="unknown date format"):
        times.item_times(items, zones, bs, names, "julian")


def test_settle_follows_the_source(spark):
    day = 86400
    reads = [
        ("a", 1, [(4, 10 * day)]),
        ("a", 2, [(4, 11 * day), (5, 300 * day)]),
        ("a", 3, []),
        ("a", 4, [(4, 12 * day), (5, 2 * day)]),
        ("a", 7, [(5, 1 * day), (4, 13 * day)]),
        ("a", 8, [(4, 14 * day)]),
        ("b", 5, [(5, 2 * day), (4, 30 * day)]),
        ("b", 9, [(5, 3 * day)]),
    ]
    df = spark.createDataFrame([(s, o, [{"form": f, "at": t} for f, t in r]) for s, o, r in reads], "source_id string, ordinal bigint, reads array<struct<form:int,at:bigint>>")
    assert rows(times.settle(df, 3), "ordinal", "at") == [(1, 10 * day), (2, 11 * day), (4, 12 * day), (5, 2 * day), (7, 13 * day), (8, 14 * day), (9, 3 * day)]


def test_edge_rows(spark):
    items = spark.createDataFrame(
        [("a", 1, "2026-01-02 00:00", None, 1), ("a", 1, "2026-01-02 00:00", None, 1), ("a", 2, None, datetime(2026, 1, 1), 2), (None, 3, "2026-01-02", datetime(2026, 1, 1), 3), ("a", 4, "x" * 100_000, datetime(2026, 1, 1), 4), ("a", 5, "", datetime(2026, 1, 1), 5)],
        "source_id string, ordinal bigint, published string, fetched_at timestamp, at int",
    )
    zones = spark.createDataFrame([("a", "UTC"), ("b", "Nowhere/Town")], "source_id string, zone string")
    bs = spark.createDataFrame(BS, "bs_year int, bs_month int, first_day string, days int")
    names = spark.createDataFrame([("GMT", 0)], "abbr string, utc_offset_min int")
    articles = spark.createDataFrame(
        [(1, 1, datetime(2026, 1, 2), False, datetime(2026, 1, 3)), (2, 2, datetime(2026, 1, 3), True, datetime(2026, 1, 3)), (3, None, None, None, datetime(2026, 1, 3)), (4, 1, datetime(2026, 1, 2), True, None)],
        "article_id bigint, item_ordinal bigint, published_at timestamp, published_estimated boolean, fetched_at timestamp",
    )
    got = rows(times.found(items, articles, zones, bs, names), "rec", "rec_id", "published_s")
    assert got == [("articles", 3, at(2026, 1, 3)), ("articles", 4, at(2026, 1, 2)), ("raw_items", 1, at(2026, 1, 2))]
    assert times.found(items.limit(0), articles.limit(0), zones, bs, names).count() == 0


def test_tables(spark):
    from khabarloom.plans.queries import queries

    got = queries()["p3_found"](spark, SF)
    assert dict(got.dtypes) == {"rec": "string", "rec_id": "bigint", "published_s": "bigint"}
    assert got.filter("rec = 'raw_items'").count() > 0


def test_clocks_without_a_zone_by_brute_force(spark, tmp_path):
    zones = {"np": "Asia/Kathmandu", "in": "Asia/Kolkata", "us": "America/New_York", "uk": "Europe/London", "au": "Australia/Sydney"}
    changes = [datetime(2025, 11, 2, 6), datetime(2026, 3, 8, 7), datetime(2025, 10, 26, 1), datetime(2026, 3, 29, 1), datetime(2026, 4, 4, 16), datetime(2025, 10, 4, 16)]
    at = [t.replace(tzinfo=UTC) + timedelta(minutes=20 * k) for t in changes for k in range(-9, 10)]
    log = [(1000 * n + i, s, t) for n, s in enumerate(zones) for i, t in enumerate(at)]
    spark.createDataFrame(log, "id bigint, source_id string, started_at timestamp").write.parquet(f"{tmp_path}/fetch_log.parquet")
    spark.createDataFrame([*zones.items()], "source_id string, zone string").write.parquet(f"{tmp_path}/source_zones.parquet")
    for name in ("bs_months", "zone_names"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SF}/{name}.parquet")

    def first(t, zone):
        """The first instant of the three hours up to t that shows t's clock."""
        clock = lambda x: x.astimezone(ZoneInfo(zone)).replace(tzinfo=None, fold=0)
        return int(min(x for x in (t - timedelta(minutes=20 * k) for k in range(10)) if clock(x) == clock(t)).timestamp())

    want = [(i, first(t, zones[s])) for i, s, t in log]
    assert sum(w != int(t.timestamp()) for (_, w), (_, _, t) in zip(want, log)) == 9  # three clocks go back once
    assert rows(queries()["f18_iso_dates"](spark, str(tmp_path))) == sorted(want, key=repr)
