"""Problem 8: held-out test passages inside documents.

All stretches of 20 consecutive words of all test items go into an Aho-Corasick automaton. Words are
compared in their visual form without case; each distinct word of the items is one symbol (a code
point beyond the first plane), so a text is scanned once, as a string of symbols, and a match is a
run of equal words whatever stands between them. Spans are given in characters of the original text.

One automaton holds the items as long as they fit ``SHARD_BYTES``; more items are spread over several
by a hash of their text, each bounded by the same size, and every document is scanned by each.
"""

from __future__ import annotations

import re
import sys
import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khabarloom.llm.looks import STRETCH, Looks, confusable_classes, form_sql

#: Consecutive words in common that make a leak.
WORDS = 20
#: Bytes of test items in one broadcast and its automaton; items beyond it take further passes.
SHARD_BYTES = 16 << 20
#: Words of an item in one piece; longer items are several pieces that overlap by a stretch.
PIECE = 1 << 18


def _mark_ranges() -> str:
    out, start = [], None
    for c in range(sys.maxunicode + 2):
        mark = c <= sys.maxunicode and unicodedata.category(chr(c))[0] == "M"
        if mark and start is None:
            start = c
        elif not mark and start is not None:
            out.append(f"{chr(start)}-{chr(c - 1)}")
            start = None
    return "".join(out)


#: Runs of letters, combining marks, digits and underscores.
WORD = re.compile(f"[\\w{_mark_ranges()}]+")
_FIRST_SYMBOL, _LAST_SYMBOL = 0x10000, 0x10FFFF


def compared_words(looks: Looks, text: str) -> list[str]:
    """Words in the form in which they are compared."""
    return WORD.findall(looks.form(text).lower())


def placed_words(looks: Looks, text: str) -> list[tuple[str, int, int]]:
    """Compared words with their places in the original text.

    The k-th drawn stretch between blanks is the k-th stretch of the form. Where both have the same
    length a word is placed by its characters, else it has the place of its stretch.
    """
    out = []
    old = [m for m in STRETCH.finditer(text) if not looks.unseen(m[0])]
    for m, new in zip(old, re.findall("[^ \t\n]+", looks.form(text))):
        even = len(new) == m.end() - m.start() and len(new.lower()) == len(new)
        for w in WORD.finditer(new.lower()):
            out.append((w[0], m.start() + w.start(), m.start() + w.end()) if even else (w[0], m.start(), m.end()))
    return out


class Matcher:
    """Automata over all items: ``(item, text)``; usually one, more if the items' words exceed its symbols."""

    def __init__(self, items: list[tuple[int, str]], looks: Looks, width: int = WORDS, symbols: int = _LAST_SYMBOL - _FIRST_SYMBOL) -> None:
        self.looks, self.width = looks, width
        self.parts: list[tuple[dict[str, str], ahocorasick.Automaton]] = []
        known: dict[str, str] = {}
        holders: dict[str, set[int]] = defaultdict(set)
        piece = min(PIECE, symbols)
        for item, text in items:
            words = compared_words(looks, text)
            for at in range(0, max(1, len(words) - width + 1), max(1, piece - width + 1)):
                some = words[at : at + piece]
                if len(some) < width:
                    continue
                if len(known) + len(set(some) - known.keys()) > symbols:
                    self._close(known, holders)
                    known, holders = {}, defaultdict(set)
                for w in some:
                    if w not in known:
                        known[w] = chr(_FIRST_SYMBOL + len(known))
                coded = "".join([known[w] for w in some])
                for i in range(len(coded) - width + 1):
                    holders[coded[i : i + width]].add(item)
        self._close(known, holders)

    def _close(self, known: dict[str, str], holders: dict[str, set[int]]) -> None:
        if holders:
            automaton = ahocorasick.Automaton()
            for stretch, ids in holders.items():
                automaton.add_word(stretch, tuple(sorted(ids)))
            automaton.make_automaton()
            self.parts.append((known, automaton))

    def items_in(self, text: str) -> set[int]:
        words = compared_words(self.looks, text) if self.parts else []
        out: set[int] = set()
        for known, automaton in self.parts:
            coded = "".join([known.get(w, "\0") for w in words])
            for _, ids in automaton.iter(coded):
                out.update(ids)
        return out

    def spans_in(self, text: str) -> dict[int, tuple[int, int, int]]:
        """item -> (start, end, words): the characters from its first to its last match, and the words matched."""
        words = placed_words(self.looks, text) if self.parts else []
        ends: dict[int, set[int]] = defaultdict(set)
        for known, automaton in self.parts:
            coded = "".join([known.get(w, "\0") for w, _, _ in words])
            for last, ids in automaton.iter(coded):
                for i in ids:
                    ends[i].add(last)
        out = {}
        for item, lasts in ends.items():
            covered = {k for last in lasts for k in range(last - self.width + 1, last + 1)}
            out[item] = (words[min(covered)][1], words[max(covered)][2], len(covered))
        return out


#: The worker's automata of the last scan, so that its tasks share them.
_built: dict[tuple[str, int], Matcher] = {}


def leaks(documents: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", spans: bool = True, width: int = WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(key, item[, start, end, words]): every document and item with ``width`` consecutive words in common.

    The items' size is checked before any are sent: they go in shards of about ``shard_bytes``, one
    pass over the documents each, whatever their number. NULL and empty texts and items hold nothing;
    items shorter than ``width`` words cannot leak. Repeated item ids count as one item with several
    texts; a repeated document has its rows again. Other columns are ignored.
    """
    held = items.filter(F.col(text).isNotNull()).select(F.col(item).alias("i"), F.col(text).alias("t"))
    size = held.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    shards = -(-size // shard_bytes) or 1
    place = F.pmod(F.xxhash64("t"), F.lit(shards))
    passes = [_scan(documents, held.filter(place == n) if shards > 1 else held, key, text, item, spans, width) for n in range(shards)]
    out = reduce(DataFrame.unionByName, passes)
    if shards == 1 or not spans:
        return out
    # an item whose texts lie in several shards has one row, from its first to its last match
    return out.groupBy(key, item).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.max("words").alias("words"))


def _scan(documents: DataFrame, items: DataFrame, key: str, text: str, item: str, spans: bool, width: int) -> DataFrame:
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast((confusable_classes(spark), [tuple(r) for r in items.collect()]))
    kind = items.schema["i"].dataType.simpleString()
    mine = (uuid.uuid4().hex, width)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if mine not in _built:
            classes, held = shared.value
            _built.clear()
            _built[mine] = Matcher(held, Looks(classes), width)
        matcher = _built[mine]
        for b in batches:
            out = []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t and (hit := matcher.items_in(t)):
                    where = matcher.spans_in(t) if spans else {}
                    out += [(i, x, *(where.get(x, (None, None, None)) if spans else ())) for x in sorted(hit)]
            cols = list(zip(*out)) or [()] * (5 if spans else 2)
            kinds = [b.schema[0].type, None, pa.int32(), pa.int32(), pa.int32()]
            made = [pa.array(c, k or (pa.int64() if kind in ("bigint", "int") else pa.string())) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays(made, names=[key, item, "start", "end", "words"][: len(cols)])

    src = documents.select(key, text)
    shape = f"`{key}` {src.schema[0].dataType.simpleString()}, `{item}` {'bigint' if kind in ('bigint', 'int') else 'string'}"
    return src.mapInArrow(rows, shape + (", start int, end int, words int" if spans else ""))


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Every document and the items it holds 20 consecutive words of."""
    return leaks(documents, items, spans=False).select("doc_id", "item_id").distinct()


def _grams_sql(table: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, unnest(list_transform(range(1, len(w) - {WORDS - 2}), lambda i: hash(w[i:i + {WORDS - 1}]))) AS gram
      FROM (SELECT {key}, regexp_extract_all(lower({form_sql('text')}), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+') AS w FROM {table}) WHERE len(w) >= {WORDS}"""


FOUND_SQL = f"""
WITH d AS ({_grams_sql('documents', 'doc_id')}), i AS ({_grams_sql('eval_items', 'item_id')})
SELECT DISTINCT doc_id, item_id FROM d JOIN i USING (gram)
"""
