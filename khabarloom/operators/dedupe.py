"""Exact duplicates, known items, and the greedy near-duplicate filter over fingerprints."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from khabarloom.functions.fingerprint import hamming
from khabarloom.operators.bitparts import learn, sampled
from khabarloom.runtime import cut

#: Bits in which fingerprints of one story may differ.
DISTANCE = 8


def first_per_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The first row of each key in ``order``; ``order`` is unique.

    A grouped minimum, not a window: it combines before the shuffle, so a key with a third of all
    rows costs one row per task. Rows with a NULL key are all kept.
    """
    firsts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(order)).select(order)
    keyless = rows.filter(F.col(key).isNull())
    return rows.join(firsts, order, "left_semi").select(*rows.columns).unionByName(keyless)


def known(items: DataFrame, stored: DataFrame, key: str = "url_hash") -> DataFrame:
    return items.join(stored.select(key), key, "left_semi")


def unknown(items: DataFrame, stored: DataFrame, key: str = "url_hash") -> DataFrame:
    return items.join(stored.select(key), key, "left_anti")


def learned_parts(nodes: DataFrame, fingerprint: str, askers: int | None = None, distance: int = DISTANCE) -> tuple[list[list[int]], list[int]]:
    """The parts of the 64 bits, and how many bits of each may differ, of least cost for as many fingerprints as there are.

    ``askers``: how many others are looked up in ``nodes``; None joins ``nodes`` with themselves.
    """
    sample = sampled(nodes, fingerprint)
    if len(sample) < 2:
        return [list(range(i, i + 16)) for i in range(0, 64, 16)], [2, 1, 1, 1]
    n = nodes.count()
    parts, radii, _ = learn(sample, n, distance) if askers is None else learn(sample, askers, distance, against=n)
    return parts, radii


def part_value(fingerprint: Column, bits: list[int]) -> Column:
    """The fingerprint's bits at these places, packed together in their order."""
    out, at, i = F.lit(0).cast("long"), 0, 0
    bits = sorted(bits)
    while i < len(bits):
        k = i
        while k + 1 < len(bits) and bits[k + 1] == bits[k] + 1:
            k += 1
        size = k - i + 1
        piece = F.shiftrightunsigned(fingerprint, bits[i]).bitwiseAND(F.lit((1 << size) - 1).cast("long")) if size < 64 else fingerprint
        out = out.bitwiseOR(F.shiftleft(piece, at))
        at, i = at + size, k + 1
    return out


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << i for i in c) for n in range(radius + 1) for c in combinations(range(width), n)]


def partition_pairs(rows: DataFrame, key: str, fingerprint: str, parts: list[list[int]], radii: Sequence[int], distance: int = DISTANCE) -> DataFrame:
    """(a, b, distance), a < b: distinct fingerprints' first keys within ``distance``; 0 and NULL are near nothing.

    By the generalised pigeonhole principle two fingerprints within ``distance`` differ in at most
    ``radii[i]`` bits of some part i, if the radii plus one add up to more than ``distance``; a part
    with radius -1 is not searched. One side of the join has its own value of each part, the other
    all values within the radius. Rows of one fingerprint are one node, named by its smallest key.
    A pair is verified where it meets and counted in the first part that brings it together.
    """
    if sum(r + 1 for r in radii) <= distance:
        raise ValueError("these radii would miss pairs")
    nodes = rows.filter(F.coalesce(F.col(fingerprint), F.lit(0)) != 0).groupBy(F.col(fingerprint).alias("f")).agg(F.min(key).alias("id"))
    own, near = [], []
    for i, (bits, r) in enumerate(zip(parts, radii)):
        if r >= 0:
            value = part_value(F.col("f"), bits)
            own.append(F.struct(F.lit(i).alias("part"), value.alias("value")))
            masks = F.array(*(F.lit(m).cast("long") for m in _masks(len(bits), r)))
            near.append(_near(masks, i, value))
    held = nodes.select("id", "f", F.explode(F.array(*own)).alias("p")).select("id", "f", "p.part", "p.value")
    asks = nodes.select("id", "f", F.explode(F.flatten(F.array(*near))).alias("p")).select("id", "f", "p.part", "p.value")
    a, b = asks.alias("a"), held.alias("b")
    d = hamming(F.col("a.f"), F.col("b.f"))
    x = F.col("a.f").bitwiseXOR(F.col("b.f"))
    first = F.lit(None).cast("int")
    for i in reversed(range(len(parts))):
        if radii[i] >= 0:
            first = F.when(F.bit_count(part_value(x, parts[i])) <= radii[i], i).otherwise(first)
    met = a.join(b, (F.col("a.part") == F.col("b.part")) & (F.col("a.value") == F.col("b.value")) & (F.col("a.id") < F.col("b.id")) & (d <= distance))
    return met.filter(first == F.col("a.part")).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), d.alias("distance"))


def _near(masks: Column, part: int, value: Column) -> Column:
    return F.transform(masks, lambda m: F.struct(F.lit(part).alias("part"), value.bitwiseXOR(m).alias("value")))


def near_known(rows: DataFrame, stored: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """(key, known): for each row the smallest stored key within DISTANCE bits; zeros are near nothing.

    Both sides are reduced to distinct fingerprints before they meet.
    """
    mine = rows.filter(F.coalesce(F.col(fingerprint), F.lit(0)) != 0).select(F.col(fingerprint).alias("f")).distinct()
    theirs = stored.filter(F.coalesce(F.col(fingerprint), F.lit(0)) != 0).groupBy(F.col(fingerprint).alias("g")).agg(F.min(key).alias("known"))
    parts, radii = learned_parts(theirs, "g", mine.count())
    own, near = [], []
    for i, (bits, r) in enumerate(zip(parts, radii)):
        if r < 0:
            continue
        own.append(F.struct(F.lit(i).alias("part"), part_value(F.col("g"), bits).alias("value")))
        near.append(_near(F.array(*(F.lit(m).cast("long") for m in _masks(len(bits), r))), i, part_value(F.col("f"), bits)))
    asks = mine.select("f", F.explode(F.flatten(F.array(*near))).alias("p")).select("f", "p.part", "p.value")
    held = theirs.select("g", "known", F.explode(F.array(*own)).alias("p")).select("g", "known", "p.part", "p.value")
    met = asks.join(held, ["part", "value"]).filter(hamming(F.col("f"), F.col("g")) <= DISTANCE)
    best = met.groupBy("f").agg(F.min("known").alias("known"))
    return rows.join(best, F.col(fingerprint) == F.col("f")).select(key, "known")


def near_pairs(rows: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """(a, b, distance), a < b: distinct fingerprints' first keys within DISTANCE bits."""
    nodes = rows.filter(F.coalesce(F.col(fingerprint), F.lit(0)) != 0).select(F.col(fingerprint).alias("f")).distinct()
    return partition_pairs(rows, key, fingerprint, *learned_parts(nodes, "f"))


def greedy_keep(rows: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """(key, kept): rows taken in order of ``key``, each rejected if an earlier kept one is near.

    The first maximal independent set in arrival order: rounds accept every open row without an
    earlier open neighbour and reject the neighbours of accepted ones, each written to the shared
    folder. Zero and NULL fingerprints are always kept.
    """
    edges = cut(near_pairs(rows, key, fingerprint).select("a", "b"), "greedy-edges")
    usable = rows.filter(F.coalesce(F.col(fingerprint), F.lit(0)) != 0)
    nodes = usable.groupBy(F.col(fingerprint).alias("f")).agg(F.min(key).alias("id"))
    touched = edges.select(F.col("a").alias("id")).unionByName(edges.select(F.col("b").alias("id"))).distinct()
    state = touched.withColumn("state", F.lit(0))
    while True:
        earlier = edges.join(state.select(F.col("id").alias("a"), F.col("state").alias("sa")), "a").groupBy(F.col("b").alias("id"))
        seen = earlier.agg(F.max((F.col("sa") == 1).cast("int")).alias("hit"), F.max((F.col("sa") == 0).cast("int")).alias("wait"))
        told = state.join(seen, "id", "left")
        state = cut(
            told.select("id", F.when(F.col("state") != 0, F.col("state")).when(F.coalesce("hit", F.lit(0)) == 1, 2).when(F.coalesce("wait", F.lit(0)) == 1, 0).otherwise(1).alias("state")),
            "greedy-state",
        )
        if state.filter("state = 0").isEmpty():
            break
    first = nodes.join(state, "id", "left").select("id", (F.coalesce("state", F.lit(1)) == 1).alias("node_kept"))
    kept = rows.select(F.col(key).alias("k"), F.coalesce(F.col(fingerprint), F.lit(0)).alias("f")).join(first, F.col("k") == F.col("id"), "left")
    # a row that is not its fingerprint's first is near that first one, or near what rejected it
    return kept.select(F.col("k").alias(key), F.coalesce("node_kept", F.col("f") == 0).alias("kept"))
