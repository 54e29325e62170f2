"""How to split 64 bits for a Hamming join by the generalised pigeonhole principle.

The partition is learned: bits that vary together go into one part, so the other parts keep bits
that tell rows apart. Each part gets its own threshold; a dynamic program over parts spends the
distance where it brings the fewest candidates, estimated on a sample for the number of rows there
are. Sample and thresholds decide only the cost: every split whose thresholds plus one exceed the
distance finds every pair.
"""

from __future__ import annotations

from math import comb

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fingerprints the partition is learned on (the sample's bound), and the parts it may have.
SAMPLE = 2000
PARTS = (3, 4, 5, 6)
#: Cost of one probe against that of one candidate.
PROBE_COST = 1.0


def group_bits(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Split the columns of a 0/1 sample into equal parts, each grown around a bit by correlation."""
    width = bits.shape[1]
    with np.errstate(invalid="ignore", divide="ignore"):
        tie = np.abs(np.nan_to_num(np.corrcoef(bits.T)))
    free, out = set(range(width)), []
    for p in range(parts):
        size = width // parts + (p < width % parts)
        seed = min(free, key=lambda i: (-sum(tie[i, j] for j in free), i))
        part = [seed]
        free.discard(seed)
        while len(part) < size:
            best = min(free, key=lambda i: (-sum(tie[i, j] for j in part), i))
            part.append(best)
            free.discard(best)
        out.append(sorted(part))
    return out


def candidate_rates(bits: np.ndarray, part: list[int], most: int) -> list[float]:
    """Share of pairs that differ in at most 0, 1, ... ``most`` bits of the part.

    Counted on pairs of different rows of the sample, and no less than of even, independent bits:
    a sample cannot show rates below one in its pairs.
    """
    codes = bits[:, part].astype(np.int64) @ (1 << np.arange(len(part), dtype=np.int64))
    values, n = np.unique(codes, return_counts=True)
    hits = np.zeros(most + 1)
    for i in range(0, len(values), 512):
        far = np.bitwise_count(values[i : i + 512, None] ^ values[None, :])
        weight = n[i : i + 512, None] * n[None, :]
        for r in range(most + 1):
            hits[r] += weight[far <= r].sum()
    pairs = max(1, len(codes) * (len(codes) - 1))
    even = [sum(comb(len(part), k) for k in range(r + 1)) / 2.0 ** len(part) for r in range(most + 1)]
    return [max((h - len(codes)) / pairs, e) for h, e in zip(hits, even)]


def allocate(costs: list[list[float]], distance: int) -> tuple[list[int], float]:
    """Thresholds of least total cost whose successors add up to ``distance`` + 1.

    ``costs[i][t]`` is the cost of threshold t - 1 in part i (index 0: the part is not searched).
    """
    best: list[tuple[float, list[int]] | None] = [(0.0, [])] + [None] * (distance + 1)
    for c in costs:
        new: list[tuple[float, list[int]] | None] = [None] * (distance + 2)
        for spent, held in enumerate(best):
            if held is None:
                continue
            for t, cost in enumerate(c):
                at = min(distance + 1, spent + t)
                total = held[0] + cost
                if new[at] is None or total < new[at][0]:
                    new[at] = (total, [*held[1], t - 1])
        best = new
    if best[distance + 1] is None:
        raise ValueError("the parts cannot cover this distance")
    return best[distance + 1][1], best[distance + 1][0]


def learn(fingerprints: np.ndarray, rows: int, distance: int, against: int | None = None, most_in_part: int = 4) -> tuple[list[list[int]], list[int], float]:
    """(parts, radii, cost) of least estimated cost for joining ``rows`` fingerprints with themselves, or with ``against`` others."""
    bits = ((fingerprints.astype(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int8)
    pairs = rows * rows / 2 if against is None else rows * against
    plans = []
    for m in PARTS:
        parts = group_bits(bits, m)
        costs = []
        for part in parts:
            most = min(distance, most_in_part, len(part))
            rates = candidate_rates(bits, part, most)
            probes = [sum(comb(len(part), k) for k in range(r + 1)) for r in range(most + 1)]
            costs.append([0.0, *(rates[r] * pairs + PROBE_COST * probes[r] * rows for r in range(most + 1))])
        if sum(len(c) - 1 for c in costs) > distance:
            radii, cost = allocate(costs, distance)
            plans.append((cost, parts, radii))
    cost, parts, radii = min(plans, key=lambda p: p[0])
    return parts, radii, cost


def sampled(nodes: DataFrame, fingerprint: str, size: int = SAMPLE) -> np.ndarray:
    """At most ``size`` distinct fingerprints, the ones lowest in hash."""
    drawn = nodes.select(F.col(fingerprint).alias("f")).orderBy(F.xxhash64("f"), "f").limit(size).collect()
    return np.array([r[0] for r in drawn], np.int64)
