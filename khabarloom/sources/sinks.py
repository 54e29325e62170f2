"""Idempotent writes to a folder of Parquet tables (one writer at a time)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException

from khabarloom.operators.dedupe import first_per_key
from khabarloom.runtime import cut


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None if nothing was written yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def to_insert(batch: DataFrame, table: DataFrame | None, key: str = "url_hash", order: str = "ordinal") -> DataFrame:
    """Rows of the batch that the table does not hold, the first per key; rows with a NULL key never conflict."""
    first = first_per_key(batch, key, order)
    return first if table is None else first.join(table.select(key), key, "left_anti").select(*batch.columns)


def upsert(batch: DataFrame, path: str, key: str = "url_hash", order: str = "ordinal") -> int:
    """Append what is new; returns the number of rows written. Running a batch again writes none.

    The new rows are written once and counted there: the table is read for its keys alone.
    """
    new = cut(to_insert(batch, stored(batch.sparkSession, path), key, order), "new-rows")
    new.write.mode("append").parquet(path)
    return new.count()


# The stored tables and their columns.
TABLES = {
    "articles": "source_id string, url string, url_hash string, title string, body string, summary string, author string, lang string, category string, published_at timestamp, published_estimated boolean, fetched_at timestamp, image_url string, simhash bigint",
    "source_state": "id string, etag string, last_modified string, last_run_at timestamp, next_run_at timestamp, consecutive_failures int, last_error string",
    "fetch_log": "id bigint, source_id string, started_at timestamp, finished_at timestamp, items_seen int, items_new int, items_duplicate int, not_modified boolean, ok boolean, error string",
}


def create_all(spark: SparkSession, folder: str) -> list[str]:
    """Create the tables that are not there yet, empty; returns their names."""
    made = [name for name in TABLES if stored(spark, f"{folder}/{name}") is None]
    for name in made:
        spark.createDataFrame([], TABLES[name]).write.parquet(f"{folder}/{name}")
    return made


def append(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)
