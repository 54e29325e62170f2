"""Run state: streaks, back-off, what is due, run counters and health."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Minutes between polls by priority, and the cap of the back-off.
INTERVALS = {1: 15, 2: 30, 3: 60, 4: 360}
BACKOFF_CAP = 360
#: Runs per window task when streaks are computed; a source of any size is spread over chunks of time.
_CHUNK_DAYS = 7


def poll_interval(priority: Column) -> Column:
    out = F.lit(None).cast("int")
    for p, minutes in INTERVALS.items():
        out = F.when(priority == p, minutes).otherwise(out)
    return out


def backoff_minutes(interval: Column, failures: Column) -> Column:
    """The interval doubled per failure in a row, at most six hours; without failures the interval itself."""
    return F.when(failures > 0, F.least(interval * F.pow(F.lit(2.0), F.least(failures, F.lit(30))), F.lit(float(BACKOFF_CAP)))).otherwise(interval).cast("int")


def failure_streaks(runs: DataFrame, source: str = "source_id", at: str = "started_at", key: str = "id", ok: str = "ok") -> DataFrame:
    """``runs`` with ``streak``: failures in a row up to and including each run, in order of (at, key).

    Streaks run through windows over a week of a source's runs; what a week begins with comes from a
    window over one row per week, so no source's whole log is sorted in one task.
    """
    bad = (~F.coalesce(F.col(ok), F.lit(False))).cast("int")
    rows = runs.withColumn("_week", F.floor(F.unix_seconds(F.col(at)) / (86400 * _CHUNK_DAYS))).withColumn("_bad", bad)
    inside = Window.partitionBy(source, "_week").orderBy(at, key)
    rows = rows.withColumn("_island", F.sum(1 - F.col("_bad")).over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_in", F.sum("_bad").over(Window.partitionBy(source, "_week", "_island").orderBy(at, key).rowsBetween(Window.unboundedPreceding, 0)))
    last_good = F.max(F.when(F.col("_bad") == 0, F.struct(F.col(at), F.col(key))))
    weeks = rows.groupBy(source, "_week").agg(last_good.alias("good"), F.count(F.lit(1)).alias("n"), F.max("_island").alias("last"))
    tails = rows.join(weeks.select(F.col(source).alias("_s"), F.col("_week").alias("_w"), "last"), F.col(source).eqNullSafe(F.col("_s")) & (F.col("_week") == F.col("_w")))
    tails = tails.groupBy(source, "_week").agg(F.sum(F.when(F.col("_island") == F.col("last"), F.col("_bad")).otherwise(0)).alias("tail"), (F.max("_island") > 0).alias("reset"))
    over = Window.partitionBy(source).orderBy("_week")
    tails = tails.withColumn("_run", F.sum(F.col("reset").cast("int")).over(over.rowsBetween(Window.unboundedPreceding, 0)))
    carried = Window.partitionBy(source, "_run").orderBy("_week")
    tails = tails.withColumn("upto", F.sum("tail").over(carried.rowsBetween(Window.unboundedPreceding, 0)))
    tails = tails.withColumn("carry", F.coalesce(F.lag("upto").over(over), F.lit(0))).select(F.col(source).alias("_s"), F.col("_week").alias("_w"), "carry")
    out = rows.join(tails, F.col(source).eqNullSafe(F.col("_s")) & (F.col("_week") == F.col("_w")))
    streak = F.when(F.col("_bad") == 0, 0).when(F.col("_island") == 0, F.col("_in") + F.col("carry")).otherwise(F.col("_in")).cast("int")
    return out.withColumn("streak", streak).drop("_week", "_bad", "_island", "_in", "_s", "_w", "carry")


def next_runs(runs: DataFrame, sources: DataFrame) -> DataFrame:
    """Every run with its streak, back-off and the time its source is due again."""
    rows = failure_streaks(runs).join(sources.select(F.col("id").alias("source_id"), poll_interval(F.col("priority")).alias("interval")), "source_id")
    minutes = backoff_minutes(F.col("interval"), F.col("streak"))
    return rows.withColumn("backoff", minutes).withColumn("next_run_at", F.timestamp_seconds(F.unix_seconds("started_at") + 60 * minutes))


def saved_state(runs: DataFrame, sources: DataFrame, previous: DataFrame) -> DataFrame:
    """The state of every source after ``runs``, which come after its ``previous`` state.

    Failures in a row go on from the previous state unless a run succeeded. etag and last_modified,
    if ``runs`` have them, replace the previous ones where the latest run that brought one is not
    empty. A failed run's error is cut to 2,000 characters. Sources without a run keep their state.

    Only grouped minima and maxima over ``runs``, which combine before they are shuffled: a source
    with a third of all runs costs one row per task.
    """
    at = F.struct("started_at", "id")
    good = F.coalesce(F.col("ok"), F.lit(False))
    marks = [c for c in ("etag", "last_modified") if c in runs.columns]
    newest = [F.max_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", at)).alias(f"_{c}") for c in marks]
    last = runs.groupBy("source_id").agg(F.max(F.when(good, at)).alias("good"), F.max_by(F.struct("started_at", "error", "ok"), at).alias("r"), *newest)
    since = runs.select("source_id", at.alias("at")).join(last.select("source_id", "good"), "source_id")
    since = since.groupBy("source_id").agg(F.count_if(F.col("good").isNull() | (F.col("at") > F.col("good"))).cast("int").alias("since"))
    new = last.join(since, "source_id").join(sources.select(F.col("id").alias("source_id"), poll_interval(F.col("priority")).alias("interval")), "source_id").withColumnRenamed("source_id", "id")
    both = previous.join(new, "id", "full")
    ran = F.col("r").isNotNull()
    fails = F.when(F.col("good").isNull(), F.coalesce("consecutive_failures", F.lit(0)) + F.col("since")).otherwise(F.col("since")).cast("int")
    both = both.withColumn("_fails", F.when(F.coalesce("r.ok", F.lit(False)), 0).otherwise(fails))
    wait = backoff_minutes(F.col("interval"), F.col("_fails"))
    pick = lambda a, b: F.when(ran, a).otherwise(F.col(b)).alias(b)
    mark = lambda c: (F.coalesce(f"_{c}", c) if c in marks else F.col(c)).alias(c)
    return both.select(
        "id",
        mark("etag"),
        mark("last_modified"),
        pick(F.col("r.started_at"), "last_run_at"),
        pick(F.timestamp_seconds(F.unix_seconds("r.started_at") + 60 * wait), "next_run_at"),
        pick(F.col("_fails"), "consecutive_failures"),
        pick(F.when(~F.coalesce("r.ok", F.lit(False)), F.substring("r.error", 1, 2000)), "last_error"),
    )


def due_sources(sources: DataFrame, state: DataFrame, now: Column) -> DataFrame:
    """Active sources whose time has come; one without state, or without a next run, is due."""
    return sources.filter("active").join(state.filter(F.col("next_run_at") > now).select("id"), "id", "left_anti")


def select_sources(sources: DataFrame, source: str | None = None, priority: int | None = None, due: tuple[DataFrame, Column] | None = None) -> DataFrame:
    """The sources to run: one by name, active or not; else the due ones (state, now); else the active ones, of one priority if given."""
    if source is not None:
        return sources.filter(F.col("id") == source)
    if due is not None:
        return due_sources(sources, *due)
    active = sources.filter("active")
    return active if priority is None else active.filter(F.col("priority") == priority)


def run_counters(runs: DataFrame) -> DataFrame:
    """Per source: runs, failures, items seen, new and duplicate, and the items no counter explains."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    rest = F.coalesce(F.sum(F.col("items_seen") - F.col("items_new") - F.col("items_duplicate")), F.lit(0)).alias("batch_duplicate")
    return runs.groupBy("source_id").agg(F.count(F.lit(1)).alias("runs"), F.count_if(~F.col("ok")).alias("failed"), total("items_seen"), total("items_new"), total("items_duplicate"), rest)


def cycle_summary(runs: DataFrame) -> DataFrame:
    """Per day: new items of all sources, and the sorted ids of sources with a failed run."""
    day = F.to_date("started_at").alias("day")
    failed = F.array_join(F.sort_array(F.collect_set(F.when(~F.col("ok"), F.col("source_id")))), ",")
    return runs.groupBy(day).agg(F.sum("items_new").alias("items_new"), failed.alias("failed"))


def unhealthy(runs: DataFrame, failures: int = 5) -> DataFrame:
    """Sources that ever failed this often in a row, with their longest streak."""
    return failure_streaks(runs).groupBy("source_id").agg(F.max("streak").alias("longest")).filter(F.col("longest") >= failures)


def report_line(source: Column, ok: Column, not_modified: Column, seen: Column, new: Column, dup: Column, error: Column) -> Column:
    """One line per run: failed, unchanged or counts, in that order of precedence."""
    return (
        F.when(~ok, F.concat(source, F.lit(": FAILED - "), F.coalesce(error, F.lit(""))))
        .when(not_modified, F.concat(source, F.lit(": unchanged (304)")))
        .otherwise(F.format_string("%s: %d seen, %d new, %d duplicate", source, seen, new, dup))
    )


def log_context(source: Column, method: Column, url: Column) -> Column:
    """The known parts of a log record's context."""
    part = lambda name, c: F.when(c.isNotNull(), F.concat(F.lit(f"{name}="), c))
    return F.concat_ws(" ", part("source", source), part("method", method), part("url", url))


def orphan_runs(runs: DataFrame, state: DataFrame) -> DataFrame:
    """Runs of sources that have no state row."""
    return runs.join(state.select(F.col("id").alias("source_id")), "source_id", "left_anti")
