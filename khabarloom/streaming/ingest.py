"""Micro-batches of items into the article table, and run state carried over the batches of a log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from khabarloom.operators import dedupe, schedule
from khabarloom.runtime import cut
from khabarloom.sources.sinks import stored, to_insert

#: Accepted articles of this many hours before a batch are looked at for near-duplicates.
HORIZON_HOURS = 48
#: Seconds between two looks for new input of a stream that runs on.
TICK = "60 seconds"


def _start(df: DataFrame, write, checkpoint: str, tick: str | None) -> StreamingQuery:  # noqa: ANN001
    out = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=tick) if tick else out.trigger(availableNow=True)).start()


def ingest_stream(items: DataFrame, path: str, checkpoint: str, key: str = "url_hash", order: str = "ordinal", fingerprint: str | None = None, at: str = "published_at", tick: str | None = None) -> StreamingQuery:
    """Insert-if-absent of every micro-batch; a batch that runs again writes the same folder again.

    With a ``fingerprint`` column, a row is also left out if an accepted row is near it: one stored
    with a time ``at`` of the HORIZON_HOURS before the batch's newest or later, or an earlier one of
    the batch. Each batch has its own subfolder, overwritten on a retry, so a failure between write
    and commit leaves no row twice. ``tick``: how often to look for input; None takes what is there
    and ends.
    """

    def write(batch: DataFrame, number: int) -> None:
        own = f"{path}/batch={number}"
        have = stored(batch.sparkSession, path)
        others = have.filter(F.col("batch") != number).drop("batch") if have is not None else None
        new = to_insert(batch, others, key, order)
        if fingerprint:
            new = without_near(cut(new, "stream-new"), others, order, fingerprint, at)
        new.write.mode("overwrite").parquet(own)

    return _start(items, write, checkpoint, tick)


def without_near(new: DataFrame, accepted: DataFrame | None, order: str, fingerprint: str, at: str, hours: int = HORIZON_HOURS) -> DataFrame:
    """Rows of ``new`` that no recently accepted row and no earlier kept row of ``new`` is near.

    Recent: not older than ``hours`` before the newest ``at`` of ``new``.
    """
    if accepted is not None:
        since = new.agg((F.max(at) - F.expr(f"INTERVAL {hours} HOURS")).alias("since")).first()[0]
        if since is not None:
            near = dedupe.near_known(new.select(order, fingerprint), accepted.filter(F.col(at) >= F.lit(since)).select(order, fingerprint), order, fingerprint)
            new = new.join(cut(near.select(order), "stream-near"), order, "left_anti")
    kept = dedupe.greedy_keep(new.select(order, fingerprint), order, fingerprint).filter("kept")
    return new.join(kept.select(order), order, "left_semi")


def read_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def state_stream(runs: DataFrame, sources: DataFrame, initial: DataFrame, path: str, checkpoint: str, tick: str | None = None) -> StreamingQuery:
    """The state of every source after each micro-batch of ``runs``, in ``path/batch=N``.

    Each batch is reduced to a row per source before it meets the state of the batch before, so an
    outlet with a third of all runs is no task of its own. A batch that runs again starts from the
    same state and writes the same folder. Runs that arrive after a newer run of their source was
    seen are taken as they arrive. ``runs``: source_id, started_at, id, ok, error.
    """

    def write(batch: DataFrame, number: int) -> None:
        before = stored(batch.sparkSession, f"{path}/batch={number - 1}") if number else None
        schedule.saved_state(batch, sources, initial if before is None else before).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return _start(runs, write, checkpoint, tick)


def run_isolated(spark: SparkSession, source_ids: list[str], run) -> DataFrame:  # noqa: ANN001
    """(source_id, ok, error, value): ``run(source_id)`` for every source; one that fails becomes a row and stops no other.

    ``value`` is what the run returns, as text. Sources are configuration: a few, run one by one;
    each run is a distributed job.
    """
    out = []
    for s in source_ids:
        try:
            out.append((s, True, None, str(run(s))))
        except Exception as e:  # noqa: BLE001
            out.append((s, False, f"{type(e).__name__}: {e}"[:2000], None))
    return spark.createDataFrame(out, "source_id string, ok boolean, error string, value string")
