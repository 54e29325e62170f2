"""What reads an outlet's payloads, by its method."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khabarloom.sources.feeds import feed_items, listing_items

Reader = Callable[[DataFrame, dict | None], DataFrame]
#: Columns of every reader's result: items say where they come from and what the source's own text of them is.
ITEM = ("source_id", "place", "url", "title", "summary", "author", "guid", "published")


def _listing(payloads: DataFrame, pack: dict | None) -> DataFrame:
    if "listing" not in (pack or {}):
        raise ValueError("html outlets need a listing block")
    items = listing_items(payloads, pack, ["source_id"], "payload", "url")
    none = F.lit(None).cast("string")
    return items.select("source_id", "place", "url", "title", "summary", none.alias("author"), none.alias("guid"), "published")


_READERS: dict[str, Reader] = {
    "rss": lambda payloads, pack: feed_items(payloads, ["source_id"], "payload", "url").select(*ITEM),
    "html": _listing,
}


def register(method: str, reader: Reader) -> None:
    """Let ``reader`` read the payloads of outlets with this method: a DataFrame of payloads and a pack to one with the columns ITEM."""
    _READERS[method] = reader


def methods() -> list[str]:
    return sorted(_READERS)


def read_payloads(method: str, payloads: DataFrame, pack: dict | None = None) -> DataFrame:
    """Items (``ITEM``) of landed payloads (source_id, url, payload, not_modified) of outlets with this method.

    Unchanged payloads (304) bring nothing. A method nobody reads, a listing without a ``listing``
    block in its pack, or a reader with other columns is refused.
    """
    if method not in _READERS:
        raise ValueError(f"no reader for method {method!r}; there are {methods()}")
    items = _READERS[method](payloads.filter(~F.coalesce("not_modified", F.lit(False))), pack)
    if tuple(items.columns) != ITEM:
        raise ValueError(f"the reader of {method!r} gives {items.columns}, not {list(ITEM)}")
    return items


def fetch_state(payloads: DataFrame) -> DataFrame:
    """(source_id, etag, last_modified, not_modified) of each source's last payload, the greater marks at a tie; empty marks count as none."""
    full = lambda c: F.nullif(F.col(c), F.lit("")).alias(c)
    last = payloads.groupBy("source_id").agg(F.max_by(F.struct("etag", "last_modified", "not_modified"), F.struct("fetched_at", "etag", "last_modified")).alias("s"))
    return last.select("source_id", "s.*").select("source_id", full("etag"), full("last_modified"), F.coalesce("not_modified", F.lit(False)).alias("not_modified"))
