"""Outlet files and selector packs, read on the driver."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from khabarloom.functions.html import check_pack

FIELDS = "id string, name string, url string, method string, lang string, category string, priority int, active boolean, homepage string, selectors string, inactive_reason string, rate_limit double, notes string"
_NAMES = [f.split()[0] for f in FIELDS.split(", ")]


def load_sources(spark: SparkSession, folder: str, active_only: bool = False) -> DataFrame:
    """One row per outlet file in name order; a file that is no mapping, has other keys or another id than its name is refused."""
    import yaml

    rows = []
    for path in sorted(Path(folder).glob("*.yaml")):
        data = yaml.safe_load(path.read_text(encoding="utf-8"))
        if not isinstance(data, dict):
            raise ValueError(f"{path.name}: not a mapping")
        if extra := sorted(set(data) - set(_NAMES)):
            raise ValueError(f"{path.name}: unknown keys {', '.join(extra)}")
        if data.get("id") != path.stem:
            raise ValueError(f"{path.name}: id {data.get('id')!r} is not the file's name")
        rate = data.get("rate_limit")
        rows.append(tuple(float(rate) if n == "rate_limit" and rate is not None else data.get(n) for n in _NAMES))
    df = spark.createDataFrame(rows, FIELDS)
    return df.filter("active") if active_only else df


# Settings and what they are without a word of the environment.
DEFAULTS = {
    "REQUEST_TIMEOUT": 20.0,
    "PER_HOST_DELAY": 1.0,
    "MAX_RETRIES": 3,
    "RESPECT_ROBOTS": True,
    "FETCH_BODIES": True,
    "MAX_BODIES_PER_RUN": 25,
    "INGEST_CONCURRENCY": 4,
    "LOG_LEVEL": "INFO",
}


def load_settings(env: Mapping[str, str]) -> dict[str, bool | int | float | str]:
    """Every setting with the type of its default; a number that is none is refused by its name."""
    out: dict[str, bool | int | float | str] = {}
    for name, default in DEFAULTS.items():
        text = env.get(name)
        if text is None:
            out[name] = default
        elif isinstance(default, bool):
            out[name] = text.strip().lower() in ("1", "true", "yes", "on")
        else:
            try:
                out[name] = type(default)(text)
            except ValueError:
                raise ValueError(f"{name}: {text!r} is no {type(default).__name__}") from None
    return out


def load_pack(folder: str, name: str) -> dict:
    """A selector pack; an empty file is an empty pack, anything but a mapping is refused."""
    import yaml

    data = yaml.safe_load((Path(folder) / f"{name}.yaml").read_text(encoding="utf-8")) or {}
    if not isinstance(data, dict):
        raise ValueError(f"{name}: not a mapping")
    return check_pack(data)
