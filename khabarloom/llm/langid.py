"""Problem 7: language of each line and document, with a confidence.

Evidence is fused by Bayes: the text's likelihood under a word and letter-pair model of each
language, what the record's label claims, and how often the host (the outlet; beyond it, its
address suffix; beyond that, all records) writes each language. Host counts are grouped sums over
the lines of all records, smoothed level by level. The model is fitted here, on a bounded sample of
labelled records chosen by hash, and refitted with lines moved to the language they are written in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from khabarloom.runtime import cut

LANGS = ("en", "hi", "ne")
# The scripts each language is written in (l Latin, d Devanagari).
SCRIPTS = {"en": "l", "hi": "d", "ne": "dl"}
#: Bounds of the sample the model is fitted on: labelled records per language, lines of each, characters of each line; hashed features.
SAMPLE, SAMPLE_LINES, SAMPLE_CHARS = 1500, 100, 1000
_FEATURES = 1 << 16
_ROUNDS = 12
#: Lines of fewer characters after trimming are not reported by ``found``, do not count for a host, and mix no document that has longer ones.
LEAST_CHARS = 40
#: A label is right with this probability, as evidence beside the text; pseudo-counts of the levels above.
LABEL_TRUST, HOST_WEIGHT = 0.8, 20.0

# Fixed value: labels that say nothing.
SILENT = ("", "und", "unknown")

_WORD = re.compile("[^\\W\\d_][\\wऀ-ॣॱ-ॿ]*")
_memo: dict[str, list[int]] = {}


def label_language(label: Column) -> Column:
    """The language a label names: its part before any "-", without case; NULL if it says nothing."""
    part = F.lower(F.trim(F.split(label, "-", 2)[0]))
    return F.when(label.isNull() | part.isin(*SILENT), None).otherwise(part)


def _ids(word: str) -> list[int]:
    """Features of a word: itself and its letter triples, borders marked."""
    got = _memo.get(word)
    if got is None:
        if len(_memo) > 500_000:
            _memo.clear()
        edged = f"^{word}$"
        parts = ["w" + word, *(edged[i : i + 3] for i in range(len(edged) - 2))]
        got = _memo[word] = [xxhash.xxh32_intdigest(p) & (_FEATURES - 1) for p in parts]
    return got


def features(line: str) -> tuple[list[int], str]:
    """Hashed features of a line's words, and the script of most of its words."""
    out: list[int] = []
    latin = 0
    words = _WORD.findall(line.lower())
    for w in words:
        out += _ids(w)
        latin += w[0] < "ऀ"
    return out, "l" if 2 * latin > len(words) else "d"


#: Log-odds against a language in a script it is not written in; features of one word are not independent.
_FOREIGN, _TEMPER = -50.0, 0.25


class Model:
    """Log-likelihoods of hashed features per language; fitted per script, so a script's share decides nothing."""

    def __init__(self, weights: dict[str, np.ndarray]) -> None:
        self.weights = weights
        self.foreign = {s: np.array([0.0 if s in SCRIPTS[x] else _FOREIGN for x in LANGS], np.float32) for s in "ld"}

    def score(self, line: str) -> np.ndarray:
        ids, script = features(line)
        if not ids:
            return np.zeros(len(LANGS), np.float32)  # no words, no evidence
        return self.weights[script][:, ids].sum(axis=1) * np.float32(_TEMPER) + self.foreign[script]


def fit(lines: list[tuple[str, int]], shares: dict[str, float] | None = None) -> Model:
    """A model from (line, index of the record's label); lines may be in another language than that.

    ``shares``: how often each label occurs among all records; the sample is weighted back to them.
    Lines that differ only in digits and spaces are one line with the label of most weight. Starts
    from the labels (a line that mostly has labels whose language is not written in its script has
    none to begin with) and refits
    on the lines' own best language: wrong labels, and paragraphs in another language, are outvoted
    by the lines that are labelled right. Each line is judged by the others alone, its own counts taken
    out, or words that stand nowhere else would hold it to its first label.
    """
    drawn = np.bincount([y for _, y in lines], minlength=len(LANGS)) if lines else np.zeros(len(LANGS))
    weight = [(shares or {}).get(x, 1.0) / max(1, n) for x, n in zip(LANGS, drawn)]
    votes: dict[str, np.ndarray] = {}
    for t, y in lines:
        form = re.sub("\\d+", "0", " ".join(t.split()))
        votes.setdefault(form, np.zeros(len(LANGS)))[y] += weight[y]
    model = Model({s: np.zeros((len(LANGS), _FEATURES), np.float32) for s in "ld"})
    scored = [(*features(t), v) for t, v in votes.items()]
    for script in "ld":
        can = np.array([script in SCRIPTS[x] for x in LANGS])
        mine = [(ids, v * can if (v * can).max() * 2 >= v.sum() else v * 0) for ids, at, v in scored if at == script and ids]
        if not any(v.any() for _, v in mine):
            continue
        sizes = np.array([len(ids) for ids, _ in mine])
        flat = np.concatenate([np.array(ids, np.int64) for ids, _ in mine])
        firsts = np.cumsum(sizes) - sizes
        line = np.repeat(np.arange(len(sizes)), sizes)
        _, at, times = np.unique(line * _FEATURES + flat, return_inverse=True, return_counts=True)
        mine_only = times[at]  # how often the feature stands in the line itself
        own = np.array([v.argmax() if v.any() else -1 for _, v in mine])
        for _ in range(_ROUNDS):
            y = own[line]
            told = np.flatnonzero(y >= 0)
            counts = np.bincount(y[told] * _FEATURES + flat[told], minlength=len(LANGS) * _FEATURES).reshape(len(LANGS), _FEATURES) + 0.02
            model.weights[script] = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
            prior = np.log((np.bincount(own[own >= 0], minlength=len(LANGS)) + 1.0) / len(own))
            each = model.weights[script][:, flat]
            # a line has no say in its own language: words of its own would keep it where it began
            rest = np.maximum(counts[y[told], flat[told]] - mine_only[told], 0.02) / (counts.sum(axis=1)[y[told]] - sizes[line[told]])
            each[y[told], told] = np.log(rest)
            ll = np.add.reduceat(each, firsts, axis=1) * _TEMPER
            best = (ll + (prior + model.foreign[script])[:, None]).argmax(axis=0)
            if (best == own).all():
                break
            own = best
    return model


def sample_lines(records: DataFrame, key: str, body: str, lang: str, per_language: int = SAMPLE) -> tuple[list[tuple[str, int]], dict[str, float]]:
    """(line, label) of at most about ``per_language`` records per labelled language, the ones lowest in hash; and the labels' shares."""
    told = records.withColumn("_told", label_language(F.col(lang))).filter(F.col("_told").isin(*LANGS) & (F.coalesce(F.col(body), F.lit("")) != ""))
    counts = {r[0]: r[1] for r in told.groupBy("_told").count().collect()}
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("_told") == name, min(1.0, per_language / n)).otherwise(share)
    unit = F.shiftrightunsigned(F.xxhash64(F.lit(7), key), 11).cast("double") / float(1 << 53)
    some = F.slice(F.filter(F.split(body, "\n", -1), lambda t: F.char_length(F.trim(t)) >= LEAST_CHARS), 1, SAMPLE_LINES)
    short = F.transform(some, lambda t: F.substring(t, 1, SAMPLE_CHARS))
    rows = told.filter(unit < share).select("_told", short.alias("lines")).limit(2 * per_language * len(LANGS)).collect()
    lines = [(t.strip(), LANGS.index(r[0])) for r in rows for t in r[1] if len(t.strip()) >= LEAST_CHARS]
    return lines, {x: n / sum(counts.values()) for x, n in counts.items()}


def line_scores(records: DataFrame, key: str, body: str, instead: str, keep: list[str], model: Model) -> DataFrame:
    """(key, keep, line_no, chars, ll): the log-likelihoods of every non-blank line.

    A record without such lines has one row from its text ``instead``, with line_no NULL.
    """
    shared = records.sparkSession.sparkContext.broadcast(model.weights)
    src = records.select(key, *keep, instead, body)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Model(shared.value)
        for b in batches:
            place, no, chars, ll = [], [], [], []
            for i, (other, text) in enumerate(zip(b.column(b.num_columns - 2).to_pylist(), b.column(b.num_columns - 1).to_pylist())):
                lines = [(k, line) for k, line in enumerate((text or "").split("\n")) if line.strip()]
                for k, line in lines or [(None, other or "")]:
                    place.append(i)
                    no.append(k)
                    chars.append(len(line.strip()))
                    ll.append(m.score(line))
            flat = np.concatenate(ll) if ll else np.zeros(0, np.float32)
            ends = np.arange(0, len(flat) + 1, len(LANGS), dtype=np.int32)
            cols = [c.take(pa.array(place, pa.int32())) for c in b.columns[:-2]]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(no, pa.int32()), pa.array(chars, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.float32()))],
                names=[*b.schema.names[:-2], "line_no", "chars", "ll"],
            )

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-2])
    return src.mapInArrow(rows, f"{head}, line_no int, chars int, ll array<float>")


def _best(ll: Column) -> Column:
    return F.array_position(ll, F.array_max(ll)).cast("int") - 1


def host_priors(scores: DataFrame) -> DataFrame:
    """(host, prior): per host its languages' log shares over its lines of at least LEAST_CHARS characters, smoothed to its suffix, that to all.

    Counts are summed per (host, suffix, language) first, so a host of any size is a few rows.
    """
    counts_for = F.col("line_no").isNotNull() & (F.col("chars") >= LEAST_CHARS)
    n = scores.groupBy("host", "suffix", _best(F.col("ll")).alias("lang")).agg(F.count(F.when(counts_for, 1)).cast("double").alias("n"))
    wide = n.groupBy("host", "suffix").agg(*(F.coalesce(F.sum(F.when(F.col("lang") == i, F.col("n"))), F.lit(0.0)).alias(f"n{i}") for i in range(len(LANGS))))
    counts = [F.col(f"n{i}") for i in range(len(LANGS))]
    total = sum(counts[1:], counts[0])
    world = wide.agg(*((F.sum(c) + 1).alias(f"w{i}") for i, c in enumerate(counts)))
    w_total = sum((F.col(f"w{i}") for i in range(1, len(LANGS))), F.col("w0"))
    world = world.select(*((F.col(f"w{i}") / w_total).alias(f"w{i}") for i in range(len(LANGS)))).withColumn("_one", F.lit(1))
    suffix = wide.groupBy("suffix").agg(*(F.sum(c).alias(f"s{i}") for i, c in enumerate(counts))).withColumn("_one", F.lit(1)).join(world, "_one")
    s_total = sum((F.col(f"s{i}") for i in range(1, len(LANGS))), F.col("s0"))
    suffix = suffix.select(F.col("suffix").alias("_suffix"), *(((F.col(f"s{i}") + HOST_WEIGHT * F.col(f"w{i}")) / (s_total + HOST_WEIGHT)).alias(f"p{i}") for i in range(len(LANGS))))
    both = wide.join(suffix, F.col("suffix").eqNullSafe(F.col("_suffix")))
    prior = F.array(*(F.log((F.col(f"n{i}") + HOST_WEIGHT * F.col(f"p{i}")) / (total + HOST_WEIGHT)) for i in range(len(LANGS))))
    return both.select("host", "suffix", prior.alias("prior"))


def line_languages(records: DataFrame, key: str = "article_id", body: str = "body", lang: str = "lang", host: str = "source_id", url: str = "url", title: str = "title", summary: str = "summary") -> DataFrame:
    """(key, line_no, chars, told, lang, confidence) for every non-blank line.

    ``told`` is the language the label names, NULL if none. A record without lines has one row with
    line_no NULL: the language of its title and summary, label and host.
    """
    model = fit(*sample_lines(records, key, body, lang))
    suffix = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), "^[a-zA-Z]+://[^/?#]*\\.([^./:?#]+)", 1)
    src = records.select(F.col(key).alias("key"), F.col(host).alias("host"), suffix.alias("suffix"), label_language(F.col(lang)).alias("told"), F.concat_ws(" ", title, summary).alias("instead"), F.col(body).alias("text"))
    scores = cut(line_scores(src, "key", "text", "instead", ["host", "suffix", "told"], model), "line-scores")
    priors = host_priors(scores).select(F.col("host").alias("_h"), F.col("suffix").alias("_s"), "prior")
    both = scores.join(priors, F.col("host").eqNullSafe(F.col("_h")) & F.col("suffix").eqNullSafe(F.col("_s")))
    wrong = (1 - LABEL_TRUST) / (len(LANGS) - 1)
    label = F.array(*(F.when(~F.coalesce(F.col("told"), F.lit("")).isin(*LANGS), 0.0).when(F.col("told") == x, float(np.log(LABEL_TRUST))).otherwise(float(np.log(wrong))) for x in LANGS))
    post = F.zip_with(F.zip_with(F.col("ll").cast("array<double>"), F.col("prior"), lambda a, b: a + b), label, lambda a, b: a + b)
    done = both.withColumn("post", post).withColumn("top", F.array_max("post"))
    weight = F.aggregate("post", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    names = F.array(*(F.lit(x) for x in LANGS))
    return done.select(F.col("key").alias(key), "line_no", "chars", "told", F.element_at(names, _best(F.col("post")) + 1).alias("lang"), (1 / weight).alias("confidence"))


def text_languages(texts: DataFrame, records: DataFrame, key: str = "item_id", text: str = "text", record_key: str = "article_id", body: str = "body", lang: str = "lang") -> DataFrame:
    """(key, lang): the language of texts that have neither label nor host, by the model that ``records`` give.

    A NULL text, or one without a word, has lang NULL.
    """
    shared = records.sparkSession.sparkContext.broadcast(fit(*sample_lines(records, record_key, body, lang)).weights)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(shared.value)
        for b in batches:
            scores = [model.score(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([LANGS[int(s.argmax())] if s.any() else None for s in scores], pa.string())], names=[key, "lang"])

    src = texts.select(key, text)
    return src.mapInArrow(rows, f"`{key}` {src.schema[0].dataType.simpleString()}, lang string")


def document_languages(lines: DataFrame, key: str = "article_id") -> DataFrame:
    """(key, lang, confidence, mixed): the language of most characters, its share of them, and whether others occur.

    Lines under LEAST_CHARS characters count for the language; for ``mixed`` only if there are no longer ones.
    """
    size, long = F.greatest("chars", F.lit(1)), F.col("chars") >= LEAST_CHARS
    by = lines.groupBy(key, "lang").agg(F.sum(size).alias("c"), F.sum(size * F.col("confidence")).alias("w"), F.max(long.cast("int")).alias("long"))
    top = by.groupBy(key).agg(F.max(F.struct("c", "lang", "w")).alias("top"), F.sum("c").alias("all"), F.count(F.lit(1)).alias("n"), F.sum("long").alias("n_long"))
    mixed = F.when(F.col("n_long") > 0, F.col("n_long") > 1).otherwise(F.col("n") > 1)
    return top.select(key, F.col("top.lang").alias("lang"), (F.col("top.w") / F.col("all")).alias("confidence"), mixed.alias("mixed"))


def found(articles: DataFrame) -> DataFrame:
    """Lines of at least LEAST_CHARS characters whose language is not what the article's label says, with their language."""
    lines = line_languages(articles).filter(F.col("line_no").isNotNull() & (F.col("chars") >= LEAST_CHARS))
    return lines.filter(~F.col("lang").eqNullSafe(F.col("told"))).select("article_id", "line_no", "lang")
