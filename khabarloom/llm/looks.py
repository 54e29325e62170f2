"""Problem 10: one form for texts that look the same; problem 8 compares words in this form.

A form folds width, composition, ligatures, invisible characters and kinds of space and hyphen,
spells Devanagari vowels in one way, and then gives every word one script: each letter belongs to a
class of letters that look alike, and each class to the scripts that have a letter in it. The
intersection over a word is the set of scripts that could have written it. A word that only one
script can write is spelled in it; one that several could (a whole-script confusable) takes the
script of the text's unmistakable letters; one that none could keeps its letters, each in its
class's first one. Only what is seen decides, so texts that look the same get the same form.

The classes are those of Unicode's published confusables, as ICU in Spark's JVM has them, over all
scripts; case and category must agree, so that a letter is never taken for a digit or for its
capital. Latin letters are told apart as far as Unicode gives them names of their own (accented,
dotless and long ones differ); only styled forms and small capitals join a class of Latin.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khabarloom.runtime import cut

# Sequences that look like one Devanagari vowel letter or sign (the Unicode Standard's list of
# spellings not to use, and two signs in a row that join into one).
VOWELS = {
    "अॆ": "ऄ", "अा": "आ", "र्इ": "ई", "उु": "ऊ", "एॅ": "ऍ", "एॆ": "ऎ", "एे": "ऐ", "अॉ": "ऑ", "आॅ": "ऑ",
    "अॊ": "ऒ", "आॆ": "ऒ", "अो": "ओ", "आे": "ओ", "अौ": "औ", "आै": "औ", "अॅ": "ॲ", "अऺ": "ॳ", "अऻ": "ॴ", "आऺ": "ॴ",
    "अॏ": "ॵ", "अॖ": "ॶ", "अॗ": "ॷ", "ाे": "ो", "ाै": "ौ", "ाॅ": "ॉ", "ाॆ": "ॊ", "ाऺ": "ऻ",
}
# Line breaks, hyphens, blanks that are drawn as a space or not at all though their category is another.
BREAKS = "\u0085  \u000b\u000c"
HYPHENS = "‐‑‒–−﹘﹣－⁃"
BLANK = "⠀"
UNSEEN = "͏ᅟᅠ឴឵᠋᠌᠍᠏⁥ㅤﾠ"
# Format characters that are drawn.
DRAWN = "؀؁؂؃؄؅۝܏࢐࢑࣢\U000110bd\U000110cd"
# Letters whose look-alike is another one than the data's prototype, or missing there.
LETTERS = {"ɑ": "a", "ɡ": "g", "ӏ": "l", "Ԛ": "Q", "ԛ": "q", "Ԝ": "W", "ԝ": "w"}

#: Compatibility forms that differ from their plain characters in width, style or joining alone.
_PLAIN = ("<wide>", "<narrow>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>")
_DEVANAGARI = range(0x900, 0x980)
_PIECES = [range(0x80, 0x3400), range(0xA000, 0xAC00), range(0xF900, 0x20000)]


def _plain_fold() -> dict[int, str | None]:
    fold: dict[int, str | None] = {}
    for c in range(0x80, sys.maxunicode + 1):
        if 0x3400 <= c < 0xA000 or 0xAC00 <= c < 0xF900 or 0x20000 <= c < 0xE0000:
            continue
        ch = chr(c)
        kind = unicodedata.category(ch)
        tag = unicodedata.decomposition(ch).partition(" ")[0]
        if kind == "Cf" and ch not in DRAWN:
            fold[c] = None
        elif kind == "Zs":
            fold[c] = " "
        elif tag in _PLAIN or (tag == "<compat>" and (kind == "Nl" or 0x2F00 <= c < 0x2FE0 or (kind[0] == "L" and "LIGATURE" in unicodedata.name(ch, "")))):
            plain = unicodedata.normalize("NFKC", ch)
            if " " not in plain:  # a fold never moves the border of a word
                fold[c] = plain
    fold |= {c: None for c in [*range(0xFE00, 0xFE10), *range(0xE0000, 0xE0080), *range(0xE0100, 0xE01F0)]} | {ord(c): None for c in UNSEEN}
    fold |= {ord(c): "\n" for c in BREAKS} | {ord(c): "-" for c in HYPHENS} | {ord(c): " " for c in BLANK}
    return {k: fold.get(ord(v), v) if isinstance(v, str) and len(v) == 1 else v for k, v in fold.items()}


_FOLD = _plain_fold()
#: Stretches of a text between blanks; each is one stretch of its form, or nothing if all of it is unseen.
STRETCH = re.compile("[^ \t\n\r" + re.escape("".join(chr(c) for c, x in _FOLD.items() if x in (" ", "\n"))) + "]+")
#: Texts of nothing but these need no folding and hold no look-alikes.
_UNUSUAL = re.compile("[^\t\n\x20-\x7eऀ-ॗॠ-ॿ‘’“”—…•©°·à-öø-þÀ-ÖØ-Þ]")
#: A character of a script beside Latin and Devanagari, or a Latin form that can belong to a class.
_FOREIGN = re.compile("[ɐ-ʯͰ-ࣿঀ-᷿ἀ-῿Ⰰ-ⷿꀀ-꣟꤀-꯿\U00010000-\U0001ffff]")
_VOWEL = re.compile("|".join(sorted(VOWELS, key=len, reverse=True)))


def _marks() -> str:
    out, start = [], None
    for c in range(0x300, 0x20000):
        mark = unicodedata.category(chr(c))[0] == "M"
        if mark and start is None:
            start = c
        elif not mark and start is not None:
            out.append(f"{chr(start)}-{chr(c - 1)}")
            start = None
    return "".join(out)


#: Letters with their marks; a word never holds a digit or an underscore.
_WORD = re.compile(f"[^\\W\\d_][^\\W\\d_{_marks()}]*(?:[{_marks()}]+[^\\W\\d_]*)*")


def script_of(letter: str) -> str:
    """The script, as the first word of the letter's name has it; small capitals are one of their own."""
    name = unicodedata.name(letter, "?")
    return "SMALL CAPITAL" if "SMALL CAPITAL" in name else name.split()[0]


def confusable_classes(spark: SparkSession) -> dict[str, str]:
    """Each letter that looks like one of another script -> the class's first letter.

    Unicode's data comes from ICU in the driver's JVM, in one call for all letters. The result has
    a few thousand entries whatever the input: it is bounded by Unicode.
    """
    letters = [chr(c) for piece in _PIECES for c in piece if unicodedata.category(chr(c))[0] == "L" and c not in _FOLD and c not in _DEVANAGARI]
    letters = [*(chr(c) for c in range(0x41, 0x7B) if chr(c).isalpha()), *letters]
    checker = spark._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    prototypes = dict(zip(letters, checker.getSkeleton("\n".join(letters)).split("\n")))
    classes: dict[tuple[str, str], list[str]] = defaultdict(list)
    for c, p in prototypes.items():
        if unicodedata.normalize("NFD", c)[0] != c:
            continue  # accents are marks: the base letter decides
        named = unicodedata.name(c, "")
        if named.startswith("LATIN") and not c.isascii() and "SMALL CAPITAL" not in named:
            continue
        kind = unicodedata.category(c)
        if kind not in ("Lu", "Ll"):  # no case: that of the prototype
            kind = unicodedata.category(p) if len(p) == 1 else "Lo"
        classes[p, kind].append(c)
    out: dict[str, str] = {}
    for members in classes.values():
        if len({script_of(c) for c in members}) > 1:
            first = min(members, key=lambda c: (not c.isascii(), script_of(c) != "LATIN", c))
            out |= dict.fromkeys(members, first)
    return out | {k: v for k, v in LETTERS.items()} | {v: v for v in LETTERS.values()}


class Looks:
    """Visual forms by a table of classes (``confusable_classes``)."""

    def __init__(self, classes: dict[str, str]) -> None:
        self.classes = classes
        self.spelled: dict[str, dict[str, str]] = defaultdict(dict)
        for c in sorted(classes, key=lambda c: (not c.isascii(), c)):
            self.spelled[classes[c]].setdefault(script_of(c), c)
        self._known: dict[str, frozenset[str]] = {}

    def _writers(self, letter: str) -> frozenset[str]:
        """Scripts with a letter that looks like this one (its base counts; marks are shared)."""
        got = self._known.get(letter)
        if got is None:
            base = unicodedata.normalize("NFD", letter)[0]
            first = self.classes.get(base)
            got = self._known[letter] = frozenset(self.spelled[first]) if first else frozenset([script_of(base)])
        return got

    def _spell(self, word: str, script: str | None) -> str:
        out = []
        for c in unicodedata.normalize("NFD", word):
            first = self.classes.get(c)
            out.append(c if first is None else self.spelled[first].get(script or "", first))
        return unicodedata.normalize("NFC", "".join(out))

    def _one_script(self, text: str) -> str:
        """Every word in the script that can have written all of it."""
        words = list(_WORD.finditer(text))
        could = []
        for m in words:
            sets = [self._writers(c) for c in set(m[0]) if not unicodedata.category(c).startswith("M")]
            could.append(frozenset.intersection(*sets) if sets else frozenset())
        sure: Counter[str] = Counter(next(iter(s)) for s in could if len(s) == 1)
        out, at = [], 0
        for m, scripts in zip(words, could):
            out.append(text[at : m.start()])
            at = m.end()
            best = min(scripts, key=lambda s: (-sure[s], s != "LATIN", s), default=None)
            out.append(self._spell(m[0], best))
        return "".join(out) + text[at:]

    @staticmethod
    def unseen(text: str) -> bool:
        """Whether nothing of the text is drawn."""
        return not text.translate(_FOLD)

    def form(self, text: str) -> str:
        """The one form of all texts that look like this one."""
        if _UNUSUAL.search(text):
            text = text.replace("\r\n", "\n").replace("\r", "\n").translate(_FOLD)
            text = unicodedata.normalize("NFC", text)
            if _FOREIGN.search(text):
                text = self._one_script(text)
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if _VOWEL.search(text):
            text = _VOWEL.sub(lambda m: VOWELS[m[0]], text)
        return text


def _halves(text: str) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(text.encode("utf-8", "surrogatepass"))
    return ((h >> 64) ^ 1 << 63) - (1 << 63), ((h & (1 << 64) - 1) ^ 1 << 63) - (1 << 63)


def with_forms(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, form), the whole text in its visual form; NULL stays NULL."""
    shared = texts.sparkSession.sparkContext.broadcast(confusable_classes(texts.sparkSession))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        looks = Looks(shared.value)
        for b in batches:
            forms = [None if t is None else looks.form(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(forms, pa.string())], names=[key, "form"])

    src = texts.select(key, text)
    return src.mapInArrow(rows, f"`{key}` {src.schema[0].dataType.simpleString()}, form string")


def form_keys(texts: DataFrame, key: str, text: str) -> DataFrame:
    """(key, f1, f2, t1, t2): 128-bit keys of the visual form and of the text itself; NULL texts have no row."""
    shared = texts.sparkSession.sparkContext.broadcast(confusable_classes(texts.sparkSession))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        looks = Looks(shared.value)
        for b in batches:
            ids, out = [], []
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t is not None:
                    own = _halves(t)
                    form = looks.form(t)
                    ids.append(i)
                    out.append((*(own if form is t else _halves(form)), *own))
            cols = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.schema[0].type), *(pa.array(c, pa.int64()) for c in cols)], names=[key, "f1", "f2", "t1", "t2"])

    src = texts.select(key, text)
    return src.mapInArrow(rows, f"`{key}` {src.schema[0].dataType.simpleString()}, f1 bigint, f2 bigint, t1 bigint, t2 bigint")


def same_looks(texts: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Texts that look the same as a different text: ``(classes, members)``.

    ``members``: (key, form, rep), rep the smallest key with exactly this text; ``classes``: (form,
    rep) with two or more reps per form. Copies of one text make one class entry, so a group of
    copies of any size costs its number of rows. NULL texts look like nothing; empty ones are equal.
    """
    keys = cut(form_keys(texts, key, text), "look-keys")
    form = F.struct("f1", "f2")
    reps = keys.groupBy("f1", "f2", "t1", "t2").agg(F.min(key).alias("rep"))
    several = reps.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("f1", "f2")
    classes = reps.join(several, ["f1", "f2"])
    members = keys.join(classes, ["f1", "f2", "t1", "t2"]).select(key, form.alias("form"), "rep")
    return classes.select(form.alias("form"), "rep"), members


def found(documents: DataFrame) -> DataFrame:
    """Pairs of documents that differ and look the same, smaller id first."""
    _, members = same_looks(documents, "doc_id", "text")
    a, b = members.alias("a"), members.alias("b")
    pairs = a.join(b, (F.col("a.form.f1") == F.col("b.form.f1")) & (F.col("a.form.f2") == F.col("b.form.f2")) & (F.col("a.rep") != F.col("b.rep")) & (F.col("a.doc_id") < F.col("b.doc_id")))
    return pairs.select(F.col("a.doc_id").alias("doc_a"), F.col("b.doc_id").alias("doc_b")).distinct()


def classes(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, rep, texts): each document that looks like a different text, the class's smallest key, and its number of texts.

    One row per document: a class of any size costs its rows, not its pairs.
    """
    reps, members = same_looks(documents, key, text)
    size = reps.groupBy("form").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("texts"))
    return members.drop("rep").join(size, "form").select(key, F.col("first").alias("rep"), "texts").distinct()


# The SQL has a table of its own, written down from what readers take for one another; it knows Latin,
# Greek, Cyrillic and full-width letters and Devanagari vowels, and spells every look-alike in Latin.
_SQL_FROM = "АВЕКМНОРСТУХІЈЅаеорсухіјѕһԁԛԝ" + "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονα"
_SQL_TO = "ABEKMHOPCTYXIJSaeopcyxijshdqw" + "ABEZHIKMNOPTYXova"
_SQL_SPACES = "              　"
_SQL_UNSEEN = "­​‌‍‎‏⁠⁡⁢⁣⁤﻿"
_SQL_VOWELS = (("अा", "आ"), ("अो", "ओ"), ("अौ", "औ"), ("आे", "ओ"), ("आै", "औ"), ("एे", "ऐ"), ("ाे", "ो"), ("ाै", "ौ"))


def form_sql(column: str) -> str:
    """SQL for the form of texts whose words are all Latin or Devanagari."""
    source = _SQL_FROM + "".join(chr(0xFF01 + i) for i in range(94)) + _SQL_SPACES + "‐‑‒–−" + _SQL_UNSEEN
    target = _SQL_TO + "".join(chr(0x21 + i) for i in range(94)) + " " * len(_SQL_SPACES) + "-----"
    out = column
    for whole, parts in (("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl")):
        out = f"replace({out}, '{whole}', '{parts}')"
    out = "nfc_normalize(translate({0}, '{1}', '{2}'))".format(out, source, target.replace("'", "''"))
    for parts, whole in _SQL_VOWELS:
        out = f"replace({out}, '{parts}', '{whole}')"
    return out


FOUND_SQL = f"""
WITH forms AS (SELECT doc_id, text, {form_sql('text')} AS form FROM documents)
SELECT a.doc_id AS doc_a, b.doc_id AS doc_b FROM forms a JOIN forms b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text
"""

CLASSES_SQL = f"""
WITH forms AS (SELECT doc_id, text, {form_sql('text')} AS form FROM documents),
several AS (SELECT form, min(doc_id) AS rep, count(DISTINCT text) AS texts FROM forms GROUP BY 1 HAVING count(DISTINCT text) > 1)
SELECT doc_id, rep, texts FROM forms JOIN several USING (form)
"""
