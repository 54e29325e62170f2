"""Exact join of texts on the overlap of their run sets.

Two texts join when ``|A & B| / |A | B|`` reaches a threshold. Seen as bit vectors over all runs,
that is a bound on their Hamming distance, ``(|A| + |B|) * (1 - t) / (1 + t)``, so the generalised
pigeonhole principle applies: put the bits into partitions, give partition ``i`` a threshold
``T_i >= -1`` such that ``sum(T_i + 1)`` exceeds the number of bits a text may miss, and every
true pair agrees within ``T_i`` on some partition. Partitions here are levels of equal estimated
frequency; the cost of raising ``T_i`` by one is the number of postings one more bit of that level
brings. These costs are linear inside a level, so the dynamic program over levels has its optimum
at the greedy fill: rare levels are used whole, one level in part, and all others get -1 (their
bits are never probed). Bits of a level are taken in hash order, the same order for all texts, so
both sides of a join may index just the bits they probe.

Frequencies are counted over *all* texts. Up to a bound they are hashed counters, as many as the texts
have runs, that are broadcast as one byte each. Beyond it the runs that occur often are counted
exactly, and their table is joined with the texts' runs (``RunOrder``). Either way the order decides
what a join costs, never which pairs it finds.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from khabarloom.functions.runs import run_sets, set_keys
from khabarloom.runtime import cut

#: log2 of the fewest and most frequency counters; one byte each once they are levels, so at most 4 MB are broadcast.
COUNTER_BITS = (16, 22)
#: Bytes of text per counter; with more than CROWDED times as many the counters no longer tell rare runs apart.
BYTES_PER_COUNTER, CROWDED = 8, 16
#: Runs of fewer occurrences need no place in the exact table: they are rare.
OFTEN = 4
#: Bits probed beyond the fewest that find every pair: each of them raises by one what a candidate must share.
SPARE = 6
_CHUNKS = 64
_LEVEL_SHIFT = np.uint64(55)
_REST = np.uint64((1 << 55) - 1)


def story_text(title: str = "title", body: str = "body", summary: str = "summary") -> Column:
    """title + " " + (body, or summary if body is empty); NULLs count as empty."""
    t, b, s = (F.coalesce(F.col(c), F.lit("")) for c in (title, body, summary))
    return F.concat(t, F.lit(" "), F.when(b == "", s).otherwise(b))


def _strings(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


class RunOrder:
    """The common order of runs, rare ones first: by level (0 to 127, four per doubling), then by hash.

    ``counters``: the level of each hashed counter; or ``table``: (run, level) of the runs that occur
    often, all others being of level 0.
    """

    def __init__(self, counters: np.ndarray | None = None, table: DataFrame | None = None) -> None:
        self.counters, self.table = counters, table


def stored_order(spark: SparkSession, order: RunOrder) -> DataFrame:
    """The order as a table: its own, or one row of counters, which a worker writes from their broadcast."""
    if order.table is not None:
        return order.table
    shared = spark.sparkContext.broadcast(order.counters.tobytes())

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array([shared.value], pa.binary())], names=["counters"])

    return spark.range(0, 1, 1, 1).mapInArrow(one, "counters binary")


def run_order(texts: DataFrame, text: str, width: int = 3, bits: tuple[int, int] = COUNTER_BITS) -> RunOrder:
    """The order of all runs of ``texts``: counters sized by the texts' bytes, or the exact table where they would be crowded."""
    size = (texts.agg(F.sum(F.octet_length(text))).first()[0] or 0) // BYTES_PER_COUNTER
    if size > CROWDED << bits[1]:
        return RunOrder(table=cut(frequent_runs(texts, text, width), "frequent-runs"))
    return RunOrder(frequency_levels(texts, text, width, min(max(size.bit_length(), bits[0]), bits[1])))


def frequent_runs(texts: DataFrame, text: str, width: int = 3) -> DataFrame:
    """(run, level) of every run with OFTEN occurrences or more, counted exactly; combined before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            run, n = np.unique(run_sets(_strings(b.column(0)), width)[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(run.view(np.int64)), pa.array(n.astype(np.int64))], names=["run", "n"])

    counts = texts.select(text).mapInArrow(count, "run bigint, n bigint").groupBy("run").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN)
    return counts.select("run", F.least(F.lit(127), F.floor(4 * F.log2(F.col("n") + 1.0))).cast("long").alias("level"))


def frequency_levels(texts: DataFrame, text: str, width: int = 3, bits: int = COUNTER_BITS[1]) -> np.ndarray:
    """Level of each of 2 ** ``bits`` hashed run counters, over all rows of ``texts``.

    Each task sends the counters it has touched; they are summed and made levels per chunk, so that
    the driver gets one byte per counter.
    """
    size, per = 1 << bits, (1 << bits) // _CHUNKS
    schema = pa.schema([("chunk", pa.int32()), ("at", pa.binary()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.uint32)
        for b in batches:
            _, run = run_sets(_strings(b.column(0)), width)
            at, n = np.unique((run & np.uint64(size - 1)).astype(np.int64), return_counts=True)
            total[at] += n.astype(np.uint32)
        at = np.flatnonzero(total).astype(np.uint32)
        ends = np.searchsorted(at, np.arange(1, _CHUNKS + 1, dtype=np.int64) * per)
        blobs = []
        for c, (a, z) in enumerate(zip([0, *ends], ends)):
            if z > a:
                gaps = np.diff(at[a:z], prepend=np.uint32(c * per)).astype(np.uint32)
                blobs.append((c, zlib.compress(gaps.tobytes(), 1), zlib.compress(total[at[a:z]].tobytes(), 1)))
        cols = list(zip(*blobs)) or [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(cols, schema)], schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for chunk, gaps, counts in zip(*(c.to_pylist() for c in b.columns)):
                at = np.cumsum(np.frombuffer(zlib.decompress(gaps), np.uint32), dtype=np.int64)
                sums.setdefault(chunk, np.zeros(per, np.uint64))[at] += np.frombuffer(zlib.decompress(counts), np.uint32)
        levels = [zlib.compress(np.minimum(127, 4 * np.log2(1.0 + v)).astype(np.uint8).tobytes(), 1) for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(levels, pa.binary())], names=["chunk", "levels"])

    parts = texts.select(text).mapInArrow(count, "chunk int, at binary, counts binary")
    out = np.zeros(size, np.uint8)
    for row in parts.repartition("chunk").mapInArrow(add, "chunk int, levels binary").collect():  # _CHUNKS rows, whatever the input
        out[row.chunk * per : (row.chunk + 1) * per] = np.frombuffer(zlib.decompress(row.levels), np.uint8)
    return out


def ordered_sets(texts: DataFrame, key: str, text: str, order: RunOrder, keep: list[str] | None = None, width: int = 3, whole: bool = False) -> DataFrame:
    """One row per text with at least one run: ``key``, the ``keep`` columns, ``hi``, ``lo``, ``n``, ``runs``.

    ``runs`` holds the probed bits: the n // 2 + 1 runs lowest in (level, hash), ascending; that
    many suffice for an overlap of 0.5 or more. If ``whole``, all others follow them in the same
    order. ``hi``, ``lo`` name the run set.
    """
    keep = keep or []
    if order.counters is None:
        return _ordered_by_table(texts, key, text, order.table, keep, width, whole)
    shared = texts.sparkSession.sparkContext.broadcast(order.counters.tobytes())
    low = np.uint64(len(order.counters) - 1)

    def ranks(run: np.ndarray) -> np.ndarray:
        level = np.frombuffer(shared.value, np.uint8)
        return (level[(run & low).astype(np.int64)].astype(np.uint64) << _LEVEL_SHIFT) | ((run >> np.uint64(9)) & _REST)

    return _sets(texts, key, text, keep, width, ranks, whole)


def _sets(texts: DataFrame, key: str, text: str, keep: list[str], width: int, ranks: Callable[[np.ndarray], np.ndarray], whole: bool) -> DataFrame:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, run = run_sets(_strings(b.column(b.num_columns - 1)), width)
            hi, lo, n = set_keys(b.num_rows, owner, run)
            rank = ranks(run)
            order = np.lexsort((rank, owner))
            rank, owner = rank[order], owner[order]
            first = np.cumsum(n) - n
            some = n > 0
            held = n if whole else np.where(some, n // 2 + 1, 0)
            rank = rank[np.arange(len(rank)) - first[owner] < held[owner]]
            ends = np.concatenate([[0], np.cumsum(held[some])]).astype(np.int32)
            chosen = pa.array(some)
            cols = [c.filter(chosen) for c in b.columns[:-1]]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(hi[some]), pa.array(lo[some]), pa.array(n[some].astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(rank.view(np.int64)))],
                names=[*b.schema.names[:-1], "hi", "lo", "n", "runs"],
            )

    src = texts.select(key, *keep, text)
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(rows, f"{head}, hi bigint, lo bigint, n int, runs array<bigint>")


def _ordered_by_table(texts: DataFrame, key: str, text: str, table: DataFrame, keep: list[str], width: int, whole: bool) -> DataFrame:
    """``ordered_sets`` by the exact table: runs are joined with their levels and gathered again per row of ``texts``."""
    sets = cut(_sets(texts, key, text, keep, width, lambda run: run, True).withColumn("_row", F.expr("uuid()")), "run-sets")
    each = sets.select("_row", F.explode("runs").alias("run")).join(table.select("run", "level"), "run", "left")
    rank = F.shiftleft(F.coalesce("level", F.lit(0).cast("long")), int(_LEVEL_SHIFT)).bitwiseOR(F.shiftright("run", 9).bitwiseAND(F.lit(int(_REST))))
    runs = each.groupBy("_row").agg(F.sort_array(F.collect_list(rank)).alias("runs"))
    out = sets.drop("runs").join(runs, "_row").drop("_row")
    return out if whole else out.withColumn("runs", F.slice("runs", F.lit(1), F.floor(F.col("n") / 2).cast("int") + 1))


def one_per_class(sets: DataFrame, key: str, columns: list[str], whole: bool = True) -> DataFrame:
    """The rows of smallest ``key`` per class, a class being equal ``columns``.

    The keys of all other copies are written first: where they are few, the join that drops them is
    planned as a broadcast and no run set is shuffled. ``whole``: for sets of a whole collection; for
    those of a batch the job costs more than the shuffle.
    """
    several = sets.groupBy(*columns).agg(F.min(key).alias("_first"), F.count(F.lit(1)).alias("_c")).filter("_c > 1").drop("_c")
    copies = sets.select(key, *columns).join(several, columns).filter(F.col(key) != F.col("_first")).select(key)
    return sets.join(cut(copies, "copies") if whole else copies, key, "left_anti")


def postings(sets: DataFrame, *columns: str) -> DataFrame:
    """One row per probed bit: ``run``, ``pos`` (its place in the text's order), ``n`` and ``columns``."""
    return sets.select(*columns, "n", F.posexplode(F.slice("runs", F.lit(1), F.floor(F.col("n") / 2).cast("int") + 1)).alias("pos", "run"))


def _third(n: Column) -> Column:
    return F.floor((n + 2) / 3).cast("int")


def _end(n: Column, need: Column) -> Column:
    """Place of the last bit that a text of ``n`` runs probes for partners that need ``need`` common runs."""
    return F.least(F.floor(n / 2).cast("int"), n - need + SPARE)


def probed(na: Column, pa_: Column, nb: Column, pb: Column) -> Column:
    """Whether two texts that share the run at places ``pa_``, ``pb`` probe it for one another.

    The sizes fix the common runs an overlap of 0.5 needs, hence the bits each side may miss; both
    probe that many, one more, and up to SPARE above. A common run also tells how far the overlap
    can still reach: the runs up to it, plus what is left after it.
    """
    need = _third(na + nb)
    most = F.least(pa_, pb) + 1 + F.least(na - pa_ - 1, nb - pb - 1)
    return (2 * F.least(na, nb) >= F.greatest(na, nb)) & (pa_ <= _end(na, need)) & (pb <= _end(nb, need)) & (most >= need)


def least_met(na: Column, nb: Column) -> Column:
    """Probed bits that two texts of these sizes must share.

    Of the two probed stretches one ends first in the common order of bits. What a text has beyond
    its stretch falls short of the needed overlap by its spare bits and one.
    """
    need = _third(na + nb)
    return 1 + F.least(_end(na, need) - (na - need), _end(nb, need) - (nb - need))


def overlap_pairs(pairs: DataFrame, texts: DataFrame, key: str, text: str, width: int = 3) -> DataFrame:
    """``pairs`` (columns a, b: keys of ``texts``) with ``shared`` and ``total``, counted on the full run sets."""
    ids = pairs.select(F.col("a").alias(key)).unionByName(pairs.select(F.col("b").alias(key))).distinct()
    chosen = texts.select(key, text).join(ids, key, "left_semi")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owner, run = run_sets(_strings(b.column(1)), width)
            n = np.bincount(owner, minlength=b.num_rows)
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(run.view(np.int64)))], names=["id", "runs"])

    kind = chosen.schema[key].dataType.simpleString()
    sets = chosen.mapInArrow(rows, f"id {kind}, runs array<bigint>")
    left, right = sets.select(F.col("id").alias("a"), F.col("runs").alias("ra")), sets.select(F.col("id").alias("b"), F.col("runs").alias("rb"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("ra", "rb"))
    return both.withColumn("shared", shared).withColumn("total", F.size("ra") + F.size("rb") - F.col("shared")).drop("ra", "rb")
