"""Addresses: one spelling per article, keys, and joins of relative ones."""

from __future__ import annotations

from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Query keys that do not change which article an address names.
TRACKING_PREFIXES = ("utm_", "pk_", "mc_")
TRACKING_KEYS = ("fbclid", "gclid", "igshid", "ref", "ref_src", "share", "amp")

_PARTS = "^(?:([^:/?#]+):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def _decode(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(text), text)


def _encode(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _is_tracking(key: Column) -> Column:
    low = F.lower(key)
    found = low.isin(*TRACKING_KEYS)
    for p in TRACKING_PREFIXES:
        found = found | low.startswith(p)
    return found


def canonical_url(url: Column) -> Column:
    """https, lower-case host without www, no tracking keys, no fragment, no trailing slashes."""
    u = F.trim(url)
    scheme, host, path, query = F.lower(_part(u, 1)), F.lower(_part(u, 2)), _part(u, 3), _part(u, 4)
    pairs = F.filter(F.split(query, "&", -1), lambda p: p != "")
    # key and value of each pair; a pair without "=" has an empty value
    read = F.transform(pairs, lambda p: F.struct(_decode(F.regexp_extract(p, "^([^=]*)", 1)).alias("k"), _decode(F.regexp_extract(p, "=(?s)(.*)$", 1)).alias("v")))
    kept = F.filter(read, lambda p: ~_is_tracking(p["k"]))
    again = F.array_join(F.transform(kept, lambda p: F.concat(_encode(p["k"]), F.lit("="), _encode(p["v"]))), "&")
    return F.concat(
        F.when(scheme == "", "").otherwise(F.concat(F.when(scheme == "http", "https").otherwise(scheme), F.lit(":"))),
        F.when((host == "") & ~u.contains("//"), "").otherwise(F.concat(F.lit("//"), F.regexp_replace(host, "^www\\.", ""))),
        F.when(F.char_length(path) > 1, F.rtrim(path, F.lit("/"))).otherwise(path),
        F.when(again == "", "").otherwise(F.concat(F.lit("?"), again)),
    )


def url_hash(url: Column) -> Column:
    return F.sha2(canonical_url(url), 256)


def homepage(url: Column) -> Column:
    return F.concat(_part(url, 1), F.lit("://"), _part(url, 2))


@F.pandas_udf(StringType())
def join_url(base: pd.Series, ref: pd.Series) -> pd.Series:
    """RFC 3986 resolution of ``ref`` against ``base``; NULL if either is."""
    return pd.Series([None if b is None or r is None else urljoin(b, r.strip()) for b, r in zip(base, ref)])


def retry_after(header: Column) -> Column:
    """Seconds to wait, at most 120; NULL for dates and anything else that is not a number."""
    number = F.trim(header).rlike("^\\d+(\\.\\d+)?$")
    return F.when(number, F.least(F.lit(120.0), F.trim(header).try_cast("double")))
