"""Problem 3: one instant for times written in many forms and zones.

Every value is read in all the ways its text allows (``readings``). A value with one valid reading
is settled. The others are chosen by Viterbi over their source's record order: a path pays for a
change of form and for going back in time, and starts from and ends at the settled values around
it. Only runs of unsettled values between two settled ones are ever grouped, and a long run by
chunks: each chunk's costs from its first to its last readings are a small matrix, a path over one
row per chunk picks the readings at the borders, and each chunk is then settled between them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from khabarloom.runtime import cut

# Month and weekday names as dates spell them (several spellings per Bikram Sambat month).
ENGLISH_MONTHS = "january february march april may june july august september october november december".split()
BS_MONTHS = {
    "बैशाख": 1, "वैशाख": 1, "baishakh": 1, "baisakh": 1, "vaishakh": 1,
    "जेठ": 2, "जेष्ठ": 2, "ज्येष्ठ": 2, "jestha": 2, "jeth": 2, "jyestha": 2,
    "असार": 3, "आषाढ": 3, "अषाढ": 3, "asar": 3, "ashad": 3, "ashadh": 3, "asadh": 3,
    "साउन": 4, "श्रावण": 4, "सावन": 4, "shrawan": 4, "saun": 4, "sawan": 4,
    "भदौ": 5, "भाद्र": 5, "भाद्रपद": 5, "bhadau": 5, "bhadra": 5,
    "असोज": 6, "आश्विन": 6, "अश्विन": 6, "asoj": 6, "ashoj": 6, "ashwin": 6, "aswin": 6,
    "कात्तिक": 7, "कार्तिक": 7, "kartik": 7, "kattik": 7,
    "मंसिर": 8, "मङ्सिर": 8, "मार्ग": 8, "मार्गशीर्ष": 8, "mangsir": 8, "mansir": 8,
    "पुस": 9, "पुष": 9, "पौष": 9, "push": 9, "poush": 9, "paush": 9, "pus": 9,
    "माघ": 10, "magh": 10,
    "फागुन": 11, "फाल्गुन": 11, "phagun": 11, "falgun": 11, "fagun": 11, "phalgun": 11,
    "चैत": 12, "चैत्र": 12, "chait": 12, "chaitra": 12,
}
WEEKDAYS = "monday tuesday wednesday thursday friday saturday sunday mon tue tues wed thu thur thurs fri sat sun".split()
NEPALI_DAYS = "आइत सोम मंगल मङ्गल बुध बिहि बिही बृहस्पति विहि विही शुक्र शनि".split()

_MONTH = {n: i + 1 for i, n in enumerate(ENGLISH_MONTHS)} | {n[:3]: i + 1 for i, n in enumerate(ENGLISH_MONTHS)} | {"sept": 9}
_DIGITS = {0x966 + i: str(i) for i in range(10)}
_DAY = re.compile(rf"(?<![^\s,])(?:(?:{'|'.join(sorted(WEEKDAYS, key=len, reverse=True))})\b\.?|(?:{'|'.join(NEPALI_DAYS)})(?:बार|वार))\s*,?", re.I)
_BS = "|".join(sorted(BS_MONTHS, key=len, reverse=True))
_EN = "|".join(sorted(_MONTH, key=len, reverse=True))
_CLOCK = r"(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,]\d{1,9})?)?\s*(?P<ap>[ap]\.?m\.?(?![a-z]))?"
_ZONE = r"(?P<z>z|[a-z]{2,5}|(?:utc|gmt)?[+-]\d{2}:?\d{2}|\([a-z]{2,5}\))?"
_TAIL = rf"(?:[\sT,]+{_CLOCK}\s*{_ZONE})?"
_FORMS = [
    (name, re.compile(rf"^{body}{_TAIL}$", re.I))
    for name, body in (
        ("ymd", r"(?P<y>\d{4})(?P<sep>[-/.])(?P<m>\d{1,2})(?P=sep)(?P<d>\d{1,2})"),
        ("ymd", r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})"),
        ("num", r"(?P<a>\d{1,2})(?P<sep>[-/.])(?P<b>\d{1,2})(?P=sep)(?P<y>\d{4})"),
        ("name", rf"(?P<d>\d{{1,2}})(?:st|nd|rd|th)?[\s-]+(?P<mon>{_EN})\.?,?[\s-]+(?P<y>\d{{4}})"),
        ("name", rf"(?P<mon>{_EN})\.?\s+(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?P<y>\d{{4}})"),
        ("bs", rf"(?P<bs>{_BS})\s*(?P<d>\d{{1,2}})\s*,?\s*(?P<y>\d{{4}})"),
        ("bs", rf"(?P<d>\d{{1,2}})\s*(?P<bs>{_BS})\s*,?\s*(?P<y>\d{{4}})"),
        ("bs", rf"(?P<y>\d{{4}})\s*(?P<bs>{_BS})\s*,?\s*(?P<d>\d{{1,2}})"),
    )
] + [("name", re.compile(rf"^(?P<mon>{_EN})\s+(?P<d>\d{{1,2}})\s+{_CLOCK}\s*{_ZONE}\s+(?P<y>\d{{4}})$", re.I))]
_EPOCH = re.compile(r"^\d{10}(?:\d{3}|\d{6}|\d{9})?$")
_SINCE = datetime(2000, 1, 1, tzinfo=UTC).timestamp()
_AHEAD = 3600
NEPAL = "Asia/Kathmandu"
#: Forms as they are numbered in readings.
FORM_IDS = {"ymd": 0, "epoch": 1, "name": 2, "bs": 3, "dmy": 4, "mdy": 5, "bs_ymd": 6}


class Reader:
    """All readings of a text, given the Bikram Sambat calendar and what zone abbreviations mean."""

    def __init__(self, bs_months: list[tuple[int, int, str, int]], zone_names: list[tuple[str, int]]) -> None:
        self.bs = {(y, m): (date.fromisoformat(first), days) for y, m, first, days in bs_months}
        self.abbr = {a.lower(): timezone(timedelta(minutes=o)) for a, o in zone_names} | {"z": UTC}
        self.zones: dict[str, ZoneInfo | None] = {}

    def _zone(self, name: str | None) -> ZoneInfo | None:
        if name not in self.zones:
            try:
                self.zones[name] = ZoneInfo(name) if name else None
            except Exception:
                self.zones[name] = None
        return self.zones[name]

    def _offset(self, text: str) -> timezone | None:
        text = text.strip("()").lower()
        if text in self.abbr:
            return self.abbr[text]
        m = re.fullmatch(r"(?:utc|gmt)?([+-])(\d{2}):?(\d{2})", text)
        if not m or int(m[2]) > 14 or int(m[3]) > 59:
            return None
        return timezone((1 if m[1] == "+" else -1) * timedelta(hours=int(m[2]), minutes=int(m[3])))

    def _instant(self, day: date, g: dict, zone: str | None) -> int | None:
        h, mi, s = (int(g.get(k) or 0) for k in ("h", "mi", "s"))
        if ap := g.get("ap"):
            if not 1 <= h <= 12:
                return None
            h = h % 12 + 12 * (ap[0].lower() == "p")
        if h > 23 or mi > 59 or s > 59:
            return None
        tz = self._offset(g["z"]) if g.get("z") else self._zone(zone)
        if tz is None:
            return None
        # fold 0: the first of two occurrences, and the offset before a gap
        return int(datetime(day.year, day.month, day.day, h, mi, s, tzinfo=tz, fold=0).timestamp() // 1)

    def _bs_day(self, y: int, m: int, d: int) -> date | None:
        first, days = self.bs.get((y, m), (None, 0))
        return first + timedelta(days=d - 1) if first and 1 <= d <= days else None

    def readings(self, text: str | None, zone: str | None) -> list[tuple[int, int]]:
        """(form, seconds since 1970 UTC) for every way to read the text; impossible dates and clocks have none."""
        if not text:
            return []
        t = " ".join(_DAY.sub(" ", text.translate(_DIGITS)).replace(" ", " ").split()).strip(" ,")
        if _EPOCH.match(t):
            return [(FORM_IDS["epoch"], int(t[:10]))]
        out: list[tuple[int, int]] = []
        for name, form in _FORMS:
            if m := form.match(t):
                g = m.groupdict()
                y = int(g["y"])
                if name == "bs":
                    days = [("bs", self._bs_day(y, BS_MONTHS[g["bs"].lower()], int(g["d"])), NEPAL)]
                elif name == "num":
                    a, b = int(g["a"]), int(g["b"])
                    days = [("dmy", _day(y, b, a), zone), ("mdy", _day(y, a, b), zone)] if a != b else [("dmy", _day(y, a, b), zone)]
                elif name == "name":
                    days = [("name", _day(y, _MONTH[g["mon"].lower()], int(g["d"])), zone)]
                else:
                    mo, d = int(g["m"]), int(g["d"])
                    days = [("ymd", _day(y, mo, d), zone), ("bs_ymd", self._bs_day(y, mo, d), NEPAL)]
                for kind, day, z in days:
                    if day is not None and (at := self._instant(day, g, z)) is not None:
                        out.append((FORM_IDS[kind], at))
        return list(dict.fromkeys(out))


def _day(y: int, m: int, d: int) -> date | None:
    try:
        return date(y, m, d)
    except ValueError:
        return None


#: Forms each mode reads: Bikram Sambat dates, all others, or any.
MODES = {"bs": {FORM_IDS["bs"]}, "iso": set(FORM_IDS.values()) - {FORM_IDS["bs"], FORM_IDS["bs_ymd"]}, "auto": set(FORM_IDS.values())}
#: Rows a calendar or list of zone names may have; more cannot be one.
_TABLE_LIMIT = 1_000_000


def _small(table: DataFrame) -> list[tuple]:
    if (n := table.count()) > _TABLE_LIMIT:
        raise ValueError(f"{n} rows are no calendar or list of zone names")
    return [tuple(r) for r in table.collect()]


def readings(items: DataFrame, zones: DataFrame, bs_months: DataFrame, zone_names: DataFrame, mode: str = "auto") -> DataFrame:
    """(source_id, ordinal, reads): the valid readings of each item's ``published``.

    Valid: not before 2000 and at most an hour after ``fetched_at`` (NULL: no such bound). An outlet
    without a zone has no reading of clocks without one. The calendar has twelve rows a year and the
    zone names one per abbreviation; both are sent whole, once their size is checked. ``mode``: which
    forms are read, as a selector pack names them ("bs", "iso" or "auto").
    """
    if mode not in MODES:
        raise ValueError(f"unknown date format {mode!r}; there are {sorted(MODES)}")
    forms = MODES[mode]
    bs = _small(bs_months.select("bs_year", "bs_month", "first_day", "days"))
    names = _small(zone_names.select("abbr", "utc_offset_min"))
    zone_of = zones.groupBy(F.col("source_id").alias("_z")).agg(F.min("zone").alias("zone"))
    src = items.select("source_id", "ordinal", "published", F.unix_seconds("fetched_at").alias("fetched")).filter("published is not null")
    src = src.join(zone_of, F.col("source_id") == F.col("_z"), "left").select("source_id", "ordinal", "published", "fetched", "zone")
    kind = pa.list_(pa.struct([("form", pa.int32()), ("at", pa.int64())]))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(bs, names)
        for b in batches:
            out = []
            for text, fetched, zone in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                good = [(f, at) for f, at in reader.readings(text, zone) if f in forms and at >= _SINCE and (fetched is None or at <= fetched + _AHEAD)]
                out.append([{"form": f, "at": at} for f, at in good])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, kind)], names=["source_id", "ordinal", "reads"])

    return src.mapInArrow(rows, "source_id string, ordinal bigint, reads array<struct<form:int,at:bigint>>")


#: What a path pays for a change of form, for a step back in time, and per day of the step (at most ten).
SWITCH, BACK, BACK_DAY = 1.0, 1.0, 0.1
_CHUNK = 100_000


def _step(a: tuple[int, int], b: tuple[int, int]) -> float:
    back = a[1] - b[1]
    return (SWITCH if a[0] != b[0] else 0.0) + (BACK + BACK_DAY * min(10.0, back / 86400) if back > 0 else 0.0)


def viterbi(path: list[list[tuple[int, int]]], before: tuple[int, int] | None, after: tuple[int, int] | None) -> list[tuple[int, int]]:
    """The cheapest choice of one reading per value between two settled ones; ties take the earlier reading in the list."""
    costs = [_step(before, r) if before else 0.0 for r in path[0]]
    links: list[list[int]] = []
    for prev, now in zip(path, path[1:]):
        best = [min(range(len(prev)), key=lambda i, r=r: (costs[i] + _step(prev[i], r), i)) for r in now]
        costs = [costs[i] + _step(prev[i], r) for i, r in zip(best, now)]
        links.append(best)
    at = min(range(len(costs)), key=lambda i: (costs[i] + (_step(path[-1][i], after) if after else 0.0), i))
    out = [path[-1][at]]
    for k in range(len(links) - 1, -1, -1):
        at = links[k][at]
        out.append(path[k][at])
    return out[::-1]


def transfer(path: list[list[tuple[int, int]]]) -> list[list[float]]:
    """The cheapest cost from each reading of the first value to each of the last."""
    out = []
    for i in range(len(path[0])):
        costs = [0.0 if k == i else float("inf") for k in range(len(path[0]))]
        for prev, now in zip(path, path[1:]):
            costs = [min(c + _step(p, r) for c, p in zip(costs, prev)) for r in now]
        out.append(costs)
    return out


_READ = "struct<form:int,at:bigint>"


def _borders(runs: DataFrame) -> DataFrame:
    """(source_id, run, chunk, enter, leave): the readings chosen at the borders of each chunk of runs of several chunks."""
    import pandas as pd

    several = runs.groupBy("source_id", "run").agg(F.min("chunk").alias("lo"), F.max("chunk").alias("hi")).filter("lo < hi").select("source_id", "run")
    wide = runs.join(several, ["source_id", "run"])

    def costs(pdf):  # noqa: ANN001, ANN202
        pdf = pdf.sort_values("ordinal")
        path = [[(r["form"], r["at"]) for r in x] for x in pdf["reads"]]
        head = pdf.iloc[0]
        ends = [[{"form": f, "at": a} for f, a in x] for x in (path[0], path[-1])]
        return pd.DataFrame({"source_id": [head["source_id"]], "run": [head["run"]], "chunk": [head["chunk"]], "first": [ends[0]], "last": [ends[1]], "cost": [transfer(path)], "before": [head["before"]], "after": [head["after"]]})

    parts = wide.groupBy("source_id", "run", "chunk").applyInPandas(costs, f"source_id string, run bigint, chunk bigint, first array<{_READ}>, last array<{_READ}>, cost array<array<double>>, before {_READ}, after {_READ}")

    def walk(pdf):  # noqa: ANN001, ANN202
        pdf = pdf.sort_values("chunk")
        pair = lambda r: (r["form"], r["at"])
        ends = [None if (r := pdf[c].iloc[0]) is None or r["at"] is None else pair(r) for c in ("before", "after")]
        steps = [([pair(r) for r in f], [pair(r) for r in la], c) for f, la, c in zip(pdf["first"], pdf["last"], pdf["cost"])]
        total, links = None, []
        for first, last, cost in steps:
            if total is None:
                enter = [(_step(ends[0], r) if ends[0] else 0.0, -1) for r in first]
            else:
                enter = [min((t + _step(p, r), i) for i, (t, p) in enumerate(zip(total, before))) for r in first]
            best = [min((e + cost[k][j], k) for k, (e, _) in enumerate(enter)) for j in range(len(last))]
            links.append([(k, enter[k][1]) for _, k in best])
            total, before = [t for t, _ in best], last
        at = min(range(len(total)), key=lambda i: (total[i] + (_step(before[i], ends[1]) if ends[1] else 0.0), i))
        picks = []
        for (first, last, _), link in zip(steps[::-1], links[::-1]):
            k, prev = link[at]
            picks.append((first[k], last[at]))
            at = prev
        picks.reverse()
        as_row = lambda r: {"form": r[0], "at": r[1]}
        return pd.DataFrame({"source_id": pdf["source_id"].values, "run": pdf["run"].values, "chunk": pdf["chunk"].values, "enter": [as_row(a) for a, _ in picks], "leave": [as_row(b) for _, b in picks]})

    return parts.groupBy("source_id", "run").applyInPandas(walk, f"source_id string, run bigint, chunk bigint, enter {_READ}, leave {_READ}")


def settle(reads: DataFrame, chunk: int = _CHUNK) -> DataFrame:
    """(source_id, ordinal, at): one instant for each value with a valid reading.

    Settled neighbours are found by windows over chunks of a source's order and a window over one
    row per chunk, so a source of any size is spread over tasks; ``chunk`` is the length of a chunk.
    """
    none = "\0"  # rows without a source are one source
    reads = cut(reads.filter(F.size("reads") > 0).withColumn("source_id", F.coalesce("source_id", F.lit(none))), "readings")
    named = lambda df: df.withColumn("source_id", F.nullif(F.col("source_id"), F.lit(none)))
    sure = reads.filter(F.size("reads") == 1).select("source_id", "ordinal", F.col("reads")[0]["at"].alias("at"))
    if reads.filter(F.size("reads") > 1).isEmpty():
        return named(sure)
    anchor = F.when(F.size("reads") == 1, F.struct("ordinal", F.col("reads")[0].alias("r")))
    rows = reads.withColumn("chunk", F.floor(F.col("ordinal") / chunk)).withColumn("anchor", anchor)
    ends = rows.filter("anchor is not null").groupBy("source_id", "chunk").agg(F.min("anchor").alias("lo"), F.max("anchor").alias("hi"))
    chunks = rows.select("source_id", "chunk").distinct().join(ends, ["source_id", "chunk"], "left")
    over = Window.partitionBy("source_id").orderBy("chunk")
    chunks = chunks.select(
        "source_id",
        "chunk",
        F.last("hi", ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("prev"),
        F.first("lo", ignorenulls=True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("next"),
    )
    inside = Window.partitionBy("source_id", "chunk").orderBy("ordinal")
    rows = rows.withColumn("b", F.last("anchor", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("a", F.first("anchor", ignorenulls=True).over(inside.rowsBetween(1, Window.unboundedFollowing)))
    open_ = rows.filter("anchor is null").join(chunks, ["source_id", "chunk"])
    open_ = open_.select("source_id", "ordinal", "reads", F.coalesce("b", "prev").alias("b"), F.coalesce("a", "next").alias("a"))
    runs = open_.select("source_id", F.coalesce(F.col("b.ordinal"), F.lit(-1)).alias("run"), F.floor(F.col("ordinal") / chunk).alias("chunk"), "ordinal", "reads", F.col("b.r").alias("before"), F.col("a.r").alias("after"))
    runs = cut(runs, "open-runs")
    told = runs.join(_borders(runs), ["source_id", "run", "chunk"], "left")

    def choose(pdf):  # noqa: ANN001, ANN202
        import pandas as pd

        pdf = pdf.sort_values("ordinal")
        path = [[(r["form"], r["at"]) for r in reads_] for reads_ in pdf["reads"]]
        before, after, enter, leave = (None if (r := pdf[c].iloc[0]) is None or r["at"] is None else (r["form"], r["at"]) for c in ("before", "after", "enter", "leave"))
        if enter:  # a chunk of a longer run: its ends are chosen
            path[0], path[-1] = [enter], ([leave] if len(path) > 1 else [enter])
            before = after = None
        return pd.DataFrame({"source_id": pdf["source_id"], "ordinal": pdf["ordinal"], "at": [at for _, at in viterbi(path, before, after)]})

    chosen = told.groupBy("source_id", "run", "chunk").applyInPandas(choose, "source_id string, ordinal bigint, at bigint")
    return named(sure.unionByName(chosen))


def item_times(items: DataFrame, zones: DataFrame, bs_months: DataFrame, zone_names: DataFrame, mode: str = "auto") -> DataFrame:
    """(source_id, ordinal, at): each readable item's instant, whole seconds since 1970 UTC, fractions dropped.

    ``ordinal`` names an item; one that is there twice counts once, with its earliest instant. NULL,
    empty and unreadable values have no row.
    """
    settled = settle(readings(items, zones, bs_months, zone_names, mode))
    return settled.groupBy("ordinal").agg(F.min("source_id").alias("source_id"), F.min("at").alias("at"))


def found(items: DataFrame, articles: DataFrame, zones: DataFrame, bs_months: DataFrame, zone_names: DataFrame) -> DataFrame:
    """Instants of readable items, and of articles that do not say what their item says."""
    times = cut(item_times(items, zones, bs_months, zone_names).select("ordinal", "at"), "item-times")
    own = articles.select("article_id", "item_ordinal", "published_estimated", F.unix_seconds("published_at").alias("said"), F.unix_seconds("fetched_at").alias("fetched"))
    both = own.join(times, F.col("item_ordinal") == F.col("ordinal"), "left")
    right = F.coalesce("at", "fetched")
    wrong = both.filter(~(F.col("said").eqNullSafe(right) & F.col("published_estimated").eqNullSafe(F.col("at").isNull())))
    return times.select(F.lit("raw_items").alias("rec"), F.col("ordinal").alias("rec_id"), F.col("at").alias("published_s")).unionByName(
        wrong.select(F.lit("articles").alias("rec"), F.col("article_id").alias("rec_id"), right.alias("published_s"))
    )
