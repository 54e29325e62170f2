"""Cleaning and reading of feed text."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The characters that collapse to one space, and Devanagari digits.
SPACE_CLASS = "[ \t ​‌‍]+"
DEVANAGARI_DIGITS, ASCII_DIGITS = "०१२३४५६७८९", "0123456789"

_TAG = re.compile("<[^>]+>")
_SPACE = re.compile(SPACE_CLASS)
_BLANK = re.compile("\n{3,}")


def clean_text(value: str | None) -> str:
    """Entities and tags gone, NFC, single spaces, at most one blank line; NULL becomes ''.

    Entities are read once before tags go and once after, so a doubly escaped tag stays as text.
    """
    if not value:
        return ""
    text = html.unescape(_TAG.sub(" ", html.unescape(value)))
    text = unicodedata.normalize("NFC", text).replace("\r\n", "\n").replace("\r", "\n")
    text = "\n".join(line.strip() for line in _SPACE.sub(" ", text).split("\n"))
    return _BLANK.sub("\n\n", text).strip()


@F.pandas_udf(StringType())
def clean(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for v in values:
        yield v.map(clean_text, na_action=None)


def strip_tags(text: Column) -> Column:
    return F.regexp_replace(text, "<[^>]+>", " ")


def ascii_digits(text: Column) -> Column:
    return F.translate(text, DEVANAGARI_DIGITS, ASCII_DIGITS)


def devanagari_share(text: Column) -> Column:
    """Share of Devanagari among the letters; NULL if there are none."""
    letters = F.regexp_replace(text, "[^\\p{L}]", "")
    own = F.char_length(F.regexp_replace(letters, "[^ऀ-ॿ]", ""))
    return F.when(F.char_length(letters) > 0, own / F.char_length(letters))


def looks_devanagari(text: Column, share: float = 0.2) -> Column:
    return F.coalesce(devanagari_share(text) >= share, F.lit(False))


def tokenize(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[\\p{L}\\p{N}_ऀ-ॿ]+"), F.lit(0))


def bind(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it."""
    return F.element_at(F.transform(F.array(value), then), 1)


def runs(tokens: Column, size: int = 3) -> Column:
    """Every ``size`` consecutive tokens, repeats kept; fewer tokens make one run, none make none."""

    def of(t: Column) -> Column:
        many = F.transform(F.sequence(F.lit(0), F.size(t) - size), lambda i: F.concat_ws(" ", *(F.get(t, i + k) for k in range(size))))
        return F.when(F.size(t) >= size, many).when(F.size(t) > 0, F.array(F.array_join(t, " "))).otherwise(F.array().cast("array<string>"))

    return bind(tokens, of)


def truncate_error(error: Column) -> Column:
    return F.substring(error, 1, 2000)


#: Characters that count as white space at the ends of a text.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def article_text(title: Column, body: Column, summary: Column) -> Column:
    """Title, blank line and body (or summary), without white space of any kind around them; NULLs count as empty."""
    part = lambda c: F.coalesce(c, F.lit(""))
    return F.btrim(F.concat(part(title), F.lit("\n\n"), F.coalesce(F.nullif(body, F.lit("")), part(summary))), F.lit(WHITE))


def truthy(text: Column, default: bool = False) -> Column:
    """1, true, yes and on are true, any other text false; NULL is the default."""
    return F.when(text.isNull(), default).otherwise(F.lower(F.trim(text)).isin("1", "true", "yes", "on"))
