"""Problem 5: texts that a field limit or a broken transfer cut off.

Evidence is gathered per value and judged with statistics of the whole corpus: a vocabulary trie
(words, and every proper prefix of a word, as tables), how often each word ends a title, how often
a line occurs whole, and lengths at which one outlet's field piles up. A value is cut if its end is
broken outright, if it stops inside a sentence at a limit or in running text, or if its last token
is no word but the beginning of one. A whole text may lack its closing mark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from khabarloom.runtime import cut

#: A word is known from this many occurrences inside texts; it ends titles from this many and this share of them.
KNOWN, ENDS, ENDS_SHARE = 2, 2, 0.002
#: Words of fewer occurrences are judged by their last three letters, which end titles from this share on.
RARE, ENDING_SHARE = 20, 0.02
#: A line counts as whole when this many distinct texts hold it.
WHOLE_LINES = 4
#: A length is a limit of an outlet's field when this many distinct values have it, and so many times those of near lengths.
PILE, PILE_TIMES, PILE_NEAR = 4, 6.0, 30
#: Lengths below this are no limits: headlines pile up there by themselves.
LEAST_LIMIT = 80

_MARK = re.compile(r"[।.?!][”’\"')\]]*$|\)$|\d ?°[CF]?$")
_INNER_MARK = re.compile(r"[।?!][”’\"']?\s+\S|[a-z\d)”’\"'][.][”’\"']?\s+[A-Z\"“‘]")
_DOTS = re.compile(r"\s*(?:…|\.\.\.|[\[(](?:…|\.\.\.)[\])]|&hellip;|&#8230;)\s*$")
_BROKEN = re.compile(r"�\s*$|&#?[a-zA-Z0-9]{0,8}$|<[^<>]{0,200}$")
_WORD = re.compile("[^\\W\\d_][\\wऀ-ॣॱ-ॿ‌‍’']*")
_LAST = re.compile("[\\wऀ-ॣ०-९ॱ-ॿ‌‍]+[^\\wऀ-ॿ]*$")
_BYLINE = re.compile(r"(?:संवाददाता|ब्युरो|ब्यूरो|bureau|reporter|correspondent)$|^by \S+( \S+){0,3}$", re.I)
_SPACES = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_BULLET = re.compile(r"^\s*(?:[•·▪*–-]|\d{1,2}[.)])\s+")


def _tidy(text: str) -> str:
    return _SPACES.sub(" ", text).strip()


def _line_key(line: str) -> int:
    return xxhash.xxh64_intdigest(_DIGITS.sub("0", _tidy(line)).lower()) - (1 << 63)


def _prose(line: str) -> bool:
    """Whether a line reads like running text; its number or bullet does not count."""
    line = _BULLET.sub("", line)
    return bool(_INNER_MARK.search(line)) or len(line.split()) >= 14


def _last_token(text: str) -> str:
    m = _LAST.search(text.lower())
    return re.sub("[^\\wऀ-ॿ‌‍]+$", "", m[0]) if m else ""


def _continues(core: str, body: str) -> str:
    """What the body says about a summary's end: "cut" if its sentence goes on there, "whole" if it ends, "" if unknown."""
    at = body.find(core)
    if at < 0 or not core:
        return ""
    rest = body[at + len(core) :]
    if not rest.strip():
        return ""
    if rest[0] == "\n":
        return "whole"
    return "whole" if _MARK.search(rest.lstrip()[:1]) else "cut"


def judge_alone(field: str, value: str, body: str) -> tuple[str, str, int, bool]:
    """(verdict, last token, key of the last line, strict) from the value (and its record's body) alone.

    Verdicts: "cut", "whole", "text" (cut unless its last line is a whole one), "ask" (the corpus decides).
    ``strict``: an end that no title has is already enough to call the value cut.
    """
    lines = [x for x in value.split("\n") if x.strip()]
    last = lines[-1]
    key = _line_key(last)
    end = last.strip()
    if _BROKEN.search(value):
        return "cut", "", key, False
    dots = _DOTS.search(end)
    core = end[: dots.start()] if dots else end
    if dots:
        return ("whole" if _MARK.search(core) else "text"), "", key, False
    if _MARK.search(end) or _BYLINE.search(end):
        return "whole", "", key, False
    token = _last_token(end)
    if field == "summary":
        said = _continues(" ".join(value.split()), _flat(body))
        if said:
            return said, token, key, False
        return ("text" if _prose(end) else "ask"), token, key, len(end.split()) > 10
    if _prose(end) or last != last.rstrip(" "):
        return "text", token, key, True
    before = lines[-2].strip() if len(lines) > 1 else ""
    listed = bool(_BULLET.match(last))
    after_story = bool(before) and (_prose(before) or bool(_MARK.search(before))) and not listed
    return ("text" if after_story else "ask"), token, key, not listed


def _flat(body: str) -> str:
    """The body with single spaces inside lines and line ends kept."""
    return "\n".join(" ".join(x.split()) for x in body.split("\n") if x.strip())


def evidence(records: DataFrame, key: str, source: str, body: str, summary: str) -> DataFrame:
    """(key, source, field, chars, value_key, verdict, token, line_key, strict) for every non-empty value."""
    src = records.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(summary).alias("summary"), F.col(body).alias("body"))
    names = ["key", "source", "field", "chars", "value_key", "verdict", "token", "line_key", "strict"]
    kinds = [None, pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_()]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for k, s, summary_, body_ in zip(*(c.to_pylist() for c in b.columns)):
                for field, value in (("summary", summary_), ("body", body_)):
                    if value and value.strip():
                        verdict, token, line, strict = judge_alone(field, value, body_ or "")
                        out.append((k, s, field, len(value), xxhash.xxh64_intdigest(value.encode("utf-8", "surrogatepass")) - (1 << 63), verdict, token, line, strict))
            cols = list(zip(*out)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t or b.schema[0].type) for c, t in zip(cols, kinds)], names=names)

    return src.mapInArrow(rows, f"key {src.schema[0].dataType.simpleString()}, source string, field string, chars int, value_key bigint, verdict string, token string, line_key bigint, strict boolean")


def vocabulary(records: DataFrame, title: str, body: str, summary: str) -> DataFrame:
    """(word, n, ends): occurrences inside texts (last words of values apart) and at the end of titles, over all records."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: Counter[str] = Counter()
            ends: Counter[str] = Counter()
            for t, u, y in zip(*(c.to_pylist() for c in b.columns)):
                for value in (u, y):
                    if value:
                        n.update(_WORD.findall(value.lower())[:-1])
                if t:
                    words = _WORD.findall(t.lower())
                    n.update(words)
                    ends.update(words[-1:])
            words = list(n.keys() | ends.keys())
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([n[w] for w in words], pa.int64()), pa.array([ends[w] for w in words], pa.int64())], names=["word", "n", "ends"])

    parts = records.select(title, summary, body).mapInArrow(rows, "word string, n bigint, ends bigint")
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))


def whole_lines(records: DataFrame, body: str) -> DataFrame:
    """(line_key): lines that several distinct bodies hold."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lines, texts = [], []
            for y in b.column(0).to_pylist():
                if y:
                    got = {_line_key(x) for x in y.split("\n") if x.strip()}
                    lines += got
                    texts += [xxhash.xxh64_intdigest(y.encode("utf-8", "surrogatepass")) - (1 << 63)] * len(got)
            yield pa.RecordBatch.from_arrays([pa.array(lines, pa.int64()), pa.array(texts, pa.int64())], names=["line_key", "text"])

    pairs = records.select(body).mapInArrow(rows, "line_key bigint, text bigint").distinct()
    return pairs.groupBy("line_key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") >= WHOLE_LINES).select("line_key")


def limits(values: DataFrame) -> DataFrame:
    """(source, field, limit): lengths at which distinct values of an outlet's field pile up."""
    n = values.select("source", "field", "chars", "value_key").distinct().groupBy("source", "field", "chars").agg(F.count(F.lit(1)).alias("n"))
    near = Window.partitionBy("source", "field").orderBy("chars").rangeBetween(-PILE_NEAR, PILE_NEAR)
    around = n.withColumn("mean", (F.sum("n").over(near) - F.col("n")) / (2.0 * PILE_NEAR))
    piled = around.filter((F.col("chars") >= LEAST_LIMIT) & (F.col("n") >= PILE) & (F.col("n") >= PILE_TIMES * F.greatest("mean", F.lit(0.2))))
    return piled.select("source", "field", F.col("chars").alias("limit"))


def trie_nodes(words: DataFrame, asked: DataFrame) -> DataFrame:
    """(node): the proper prefixes of ``words`` that some token of ``asked`` can be: the trie's levels that are asked for.

    A level is a length. Lengths of tokens are few (n of them take n squared characters of text), so
    a word of any length has few nodes.
    """
    levels = sorted(r[0] for r in asked.select(F.char_length("token")).distinct().collect() if r[0])
    here = F.filter(F.array(*map(F.lit, levels)).cast("array<int>"), lambda n: n < F.char_length("word"))
    each = words.select("word", F.explode(here).alias("n"))
    return each.select(F.expr("substring(word, 1, n)").alias("node")).distinct()


def cut_values(records: DataFrame, key: str = "article_id", source: str = "source_id", title: str = "title", body: str = "body", summary: str = "summary") -> DataFrame:
    """(key, source, field): every value that was cut off. NULL, empty and blank values are not cut."""
    values = cut(evidence(records, key, source, body, summary), "cut-evidence")
    every = cut(vocabulary(records, title, body, summary), "cut-words")
    words = every.filter(F.col("n") >= KNOWN)
    endings = every.groupBy(F.substring("word", -3, 3).alias("ending")).agg(F.sum("n").alias("en"), F.sum("ends").alias("ee"))
    open_ = values.filter(F.col("verdict").isin("ask", "text"))
    asked = open_.select("token").distinct()
    nodes = trie_nodes(words, asked)
    known = asked.join(words.withColumnRenamed("word", "token"), "token", "left")
    known = known.join(nodes.select(F.col("node").alias("token"), F.lit(True).alias("inside")), "token", "left")
    known = known.join(endings, F.substring("token", -3, 3) == F.col("ending"), "left")
    zero = F.lit(0)
    own = (F.coalesce("ends", zero) >= ENDS) & (F.coalesce("ends", zero) >= ENDS_SHARE * F.col("n"))
    like = (F.coalesce("ee", zero) >= ENDS) & (F.coalesce("ee", zero) >= ENDING_SHARE * F.col("en")) & (F.char_length("token") > 3)
    known = known.select(
        "token",
        F.col("n").isNotNull().alias("is_word"),
        F.coalesce("inside", F.lit(False)).alias("is_prefix"),
        F.when(F.coalesce("n", zero) >= RARE, own).otherwise(own | like).alias("ends_title"),
    )
    piled = limits(values).withColumn("at_limit", F.lit(True))
    told = open_.join(known, "token", "left")
    told = told.join(whole_lines(records, body).withColumn("whole_line", F.lit(True)), "line_key", "left")
    for step in (0, 1):  # a cut right before a space may have lost it
        here = piled.select(F.col("source").alias("ps"), F.col("field").alias("pf"), (F.col("limit") - step).alias("pl"), F.col("at_limit").alias(f"limit{step}"))
        told = told.join(here, F.col("source").eqNullSafe(F.col("ps")) & (F.col("field") == F.col("pf")) & (F.col("chars") == F.col("pl")), "left").drop("ps", "pf", "pl")
    no = F.lit(False)
    at_limit = F.coalesce("limit0", no) | F.coalesce("limit1", no)
    is_cut = (
        F.when(F.coalesce("whole_line", no), False)
        .when(at_limit | (F.col("verdict") == "text"), True)
        .when(F.coalesce("is_word", no), F.col("strict") & ~F.coalesce("ends_title", no))
        .otherwise(F.coalesce("is_prefix", no) & ~F.coalesce("ends_title", no))
    )
    sure = values.filter("verdict = 'cut'").select("key", "source", "field")
    out = sure.unionByName(told.filter(is_cut).select("key", "source", "field"))
    return out.withColumnsRenamed({"key": key, "source": source})


def cut_rates(records: DataFrame, cuts: DataFrame, source: str = "source_id", body: str = "body", summary: str = "summary") -> DataFrame:
    """(source, field, values, cut, rate): how often each source's fields are cut, of those with text."""
    has = lambda c: (F.trim(F.coalesce(F.col(c), F.lit(""))) != "").cast("int")
    n = records.groupBy(source).agg(F.sum(has(body)).alias("body"), F.sum(has(summary)).alias("summary"))
    fields = F.explode(F.array(F.struct(F.lit("body").alias("field"), F.col("body").alias("values")), F.struct(F.lit("summary").alias("field"), F.col("summary").alias("values"))))
    n = n.select(F.col(source).alias("_s"), fields.alias("f")).select("_s", "f.field", "f.values")
    c = cuts.groupBy(F.col(source), F.col("field").alias("_f")).agg(F.count(F.lit(1)).alias("cut"))
    both = n.join(c, F.col("_s").eqNullSafe(F.col(source)) & (F.col("field") == F.col("_f")), "left")
    k = F.coalesce("cut", F.lit(0))
    return both.select(F.col("_s").alias(source), "field", "values", k.alias("cut"), F.when(F.col("values") > 0, k / F.col("values")).alias("rate"))


def found(articles: DataFrame) -> DataFrame:
    """Values of summary and body that were cut off."""
    return cut_values(articles).select("article_id", "field")
