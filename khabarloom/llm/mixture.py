"""Problem 9: a mix of sources with target shares of the total size in tokens.

The total is given, or the largest one at which no source is used more than its allowed number of
times. A source gives whole passes over its documents, and for the rest of its budget the documents whose
hash lies under a threshold. Thresholds come from histograms of tokens by source and hash bucket:
each level cuts only the bucket in which the budget ends into 1,024 smaller ones, so documents are
never sorted. Documents under a smaller budget's threshold are under a larger one's: mixes nest.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from khabarloom.runtime import cut

_BITS, _LEVELS = 10, 4

# Fixed value: the split of a text into pieces before byte pairs are merged.
DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"


def token_counts(documents: DataFrame, keep: list[str], text: str = "text", tokenizer: str = DEFAULT_TOKENIZER, pattern: str | None = None) -> DataFrame:
    """``keep`` and ``tokens``: the size of each text in tokens of a byte-level vocabulary; NULL counts 0.

    ``tokenizer``: a file of ranks (base64 token and rank per line) that every executor can read.
    """
    src = documents.select(*keep, text)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        import tiktoken

        with open(tokenizer, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        coder = tiktoken.Encoding("ranks", pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        for b in batches:
            n = [len(coder.encode_ordinary(t)) if t else 0 for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(n, pa.int64())], names=[*b.schema.names[:-1], "tokens"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(rows, f"{head}, tokens bigint")


def _bucket(h: Column, level: int) -> Column:
    """The hash's bucket at a level: its first ``level * 10`` bits after the sign."""
    return F.shiftrightunsigned(h.bitwiseAND(F.lit((1 << 63) - 1)), 63 - _BITS * level)


def _under(rows: DataFrame, room: DataFrame) -> DataFrame:
    """(source, level, bucket): per level the bucket in which the source's room ends.

    ``rows``: source, h, tokens; ``room``: source, room. Hashes below the bucket at every level fit.
    """
    at = room.select("source", "room", F.lit(0).cast("long").alias("bucket"))
    out = None
    for level in range(1, _LEVELS + 1):
        inside = rows.join(at, "source").filter(_bucket(F.col("h"), level - 1) == F.col("bucket")) if level > 1 else rows.join(at, "source")
        sums = inside.groupBy("source", _bucket(F.col("h"), level).alias("b")).agg(F.sum("tokens").alias("t"), F.first("room").alias("room"))
        w = Window.partitionBy("source").orderBy("b")  # at most 1,024 rows a source
        run = sums.withColumn("upto", F.sum("t").over(w))
        # the first bucket that does not fit; if all fit, past the last one
        first = run.groupBy("source").agg(
            F.min(F.when(F.col("upto") > F.col("room"), F.col("b"))).alias("b"),
            F.max("b").alias("last"),
            F.first("room").alias("room"),
            F.min(F.when(F.col("upto") > F.col("room"), F.col("upto"))).alias("next"),
            F.max(F.when(F.col("upto") <= F.col("room"), F.col("upto"))).alias("used"),
        )
        end = F.coalesce("b", F.col("last") + 1)
        if level == _LEVELS:  # the last bucket is taken if that brings the source nearer to its budget
            over = F.col("next") - F.col("room")
            end = F.when(over <= F.col("room") - F.coalesce("used", F.lit(0)), F.col("b") + 1).otherwise(end)
        at = cut(first.select("source", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room"), end.alias("bucket")), "mix-level")
        mine = at.select("source", F.col("bucket").alias(f"b{level}"))
        out = mine if out is None else out.join(mine, "source", "left")
    return out


def mix(documents: DataFrame, targets: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", tokenizer: str = DEFAULT_TOKENIZER, seed: int = 0, total: int | None = None) -> tuple[DataFrame, DataFrame]:
    """``(chosen, report)``.

    ``chosen``: (key, source, tokens, copies) for every document used, copies >= 1. ``report``: one row
    per target: source, target_share, size, budget, used, share, repeats.

    ``targets``: source, target_share, max_repeats; unlisted sources give nothing. A listed source
    without a token reaches share 0 and does not limit the others, which then share the total in
    proportion to their targets. ``total``: the size asked for, in tokens; a source that cannot give
    its share of it gives all it may, falls short, and the report says so. Without it the size is the
    largest at which none falls short. Shares of NULL or 0, and max_repeats of NULL or 0, give nothing.
    Documents with a NULL source are in no source; empty texts are never chosen.
    """
    want = targets.select(F.col("source"), "target_share", "max_repeats").filter("source is not null")
    listed = documents.select(F.col(key).alias("key"), F.col(source).alias("source"), F.col(text).alias("text")).join(want.select("source"), "source", "left_semi")
    sized = cut(token_counts(listed, ["key", "source"], "text", tokenizer).filter("tokens > 0"), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("tokens").alias("size"))
    able = want.join(sizes, "source").filter("target_share > 0 and max_repeats > 0")
    total = float(total) if total is not None else able.agg(F.min(F.col("size") * F.col("max_repeats") / F.col("target_share"))).first()[0] or 0.0
    plan = able.withColumn("budget", F.least(F.floor(F.lit(total) * F.col("target_share")), F.col("size") * F.col("max_repeats")))
    plan = plan.withColumn("whole", F.floor(F.col("budget") / F.col("size"))).withColumn("room", F.col("budget") - F.col("whole") * F.col("size"))
    plan = cut(plan, "mix-plan")
    hashed = sized.withColumn("h", F.xxhash64(F.lit(seed), "key"))
    ends = _under(hashed.select("source", "h", "tokens"), plan.select("source", "room"))
    rows = hashed.join(plan.select("source", "whole"), "source").join(ends, "source")
    below = F.lit(False)
    for level in range(_LEVELS, 0, -1):
        b = _bucket(F.col("h"), level)
        end = F.col(f"b{level}")
        below = (b < end) | ((b == end) & below) if level < _LEVELS else b < end
    chosen = rows.withColumn("copies", (F.col("whole") + F.coalesce(below, F.lit(False)).cast("int")).cast("int")).filter("copies > 0")
    chosen = cut(chosen.select(F.col("key").alias(key), "source", "tokens", "copies"), "mix-chosen")
    used = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("used"), F.max("copies").alias("repeats"))
    all_used = F.lit(used.agg(F.sum("used")).first()[0] or 0)
    report = want.join(sizes, "source", "left").join(plan.select("source", "budget"), "source", "left").join(used, "source", "left")
    zero = F.lit(0).cast("long")
    report = report.select(
        "source",
        "target_share",
        F.coalesce("size", zero).alias("size"),
        F.coalesce("budget", zero).alias("budget"),
        F.coalesce("used", zero).alias("used"),
        F.when(all_used > 0, F.coalesce("used", zero) / all_used).otherwise(F.lit(0.0)).alias("share"),
        F.coalesce("repeats", F.lit(0)).alias("repeats"),
    )
    return chosen, report
