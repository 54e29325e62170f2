"""Hamming join of 64-bit fingerprints by the generalised pigeonhole principle.

The partition is learned (``operators/bitparts``): correlated bits are grouped, and a dynamic program
gives each group its own threshold, where the distance brings the fewest candidates for as many rows
as there are. Every split it may choose finds every pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khabarloom.operators.bitparts import SAMPLE, learn, sampled
from khabarloom.operators.dedupe import DISTANCE, partition_pairs


def fingerprint_pairs(rows: DataFrame, key: str, fingerprint: str, distance: int = DISTANCE, sample: int = SAMPLE) -> DataFrame:
    """(a, b, distance), a < b: distinct fingerprints' smallest keys within ``distance`` bits.

    Equal fingerprints are one node, named by its smallest key, so copies never pair up. 0 and NULL
    (not computed) are near nothing. ``key`` is unique; other columns are ignored.
    """
    nodes = rows.filter(F.coalesce(F.col(fingerprint), F.lit(0)) != 0).select(F.col(fingerprint).alias("f")).distinct()
    n = nodes.count()
    drawn = sampled(nodes, "f", sample)
    if len(drawn) < 2:
        return rows.limit(0).select(F.col(key).alias("a"), F.col(key).alias("b"), F.lit(0).alias("distance"))
    parts, radii, _ = learn(drawn, n, distance)
    return partition_pairs(rows, key, fingerprint, parts, radii, distance)


PAIRS_SQL = """
WITH n AS (SELECT simhash, min(article_id) AS id FROM articles WHERE simhash <> 0 GROUP BY 1)
SELECT a.id AS a, b.id AS b, CAST(bit_count(xor(a.simhash, b.simhash)) AS INTEGER) AS distance
FROM n a JOIN n b ON a.id < b.id WHERE bit_count(xor(a.simhash, b.simhash)) <= 8
"""
