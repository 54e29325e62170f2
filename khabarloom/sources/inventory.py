"""The list of outlets as blocks of a Markdown page, and what keeps them up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khabarloom.operators.articles import inventory

# The heads of the two tables.
ACTIVE = ("| # | Source | Link | Lang | Cat | Prio | Method |", "|---|--------|------|:----:|:---:|:----:|:------:|")
INACTIVE = ("| Source | Link | Reason |", "|--------|------|--------|")


def inventory_lines(sources: DataFrame) -> DataFrame:
    """(active, rank, line): one table row per source; active ones by priority and name, the others by name."""
    cell = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    link = F.concat(F.lit("<"), cell("url"), F.lit(">"))
    row = lambda *cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    line = F.when(F.col("active"), row(cell("rank"), cell("name"), link, cell("lang"), cell("category"), cell("priority"), cell("method"))).otherwise(row(cell("name"), link, cell("inactive_reason")))
    return inventory(sources).select("active", "rank", line.alias("line"))


def inventory_tables(sources: DataFrame) -> tuple[str, str]:
    """The tables of active and inactive sources; a table without rows is empty. Sources are configuration: a few rows each."""
    rows = sorted((tuple(r) for r in inventory_lines(sources).collect()), key=lambda r: (not r[0], r[1]))
    tables = ([line for active, _, line in rows if active == want] for want in (True, False))
    return tuple("\n".join([*head, *lines]) if lines else "" for head, lines in zip((ACTIVE, INACTIVE), tables))


def fill_block(page: str, begin: str, end: str, text: str) -> str:
    """``page`` with ``text`` between the two marks, which stay; a page without them is refused."""
    head, found, rest = page.partition(begin)
    _, also, tail = rest.partition(end)
    if not found or not also:
        raise ValueError(f"the page has no block {begin!r} ... {end!r}")
    return f"{head}{begin}\n\n{text}\n\n{end}{tail}"


def is_stale(page: str, blocks: list[tuple[str, str, str]]) -> bool:
    """Whether filling the blocks (begin, end, text) would change the page."""
    fresh = page
    for begin, end, text in blocks:
        fresh = fill_block(fresh, begin, end, text)
    return fresh != page
