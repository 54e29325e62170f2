"""Connected components of a graph of records, and what is counted once per component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khabarloom.runtime import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): every id of ``edges`` with the smallest id it is connected to.

    Rounds of two steps, each written to the shared folder: an id takes the smallest label around
    it, then the label of that label, so the rounds grow with the logarithm of the longest path. Both
    steps are grouped minima, which combine before they are shuffled: an id with any number of edges
    costs one row per task. Rows with a NULL end, loops and repeated edges change nothing.
    """
    ends = edges.select(F.col(a).alias("id"), F.col(b).alias("other")).filter("id is not null and other is not null")
    both = cut(ends.unionByName(ends.select(F.col("other").alias("id"), F.col("id").alias("other"))).distinct(), "component-edges")
    state = cut(both.groupBy("id").agg(F.min("other").alias("m")).select("id", F.least("id", "m").alias("label")), "component-labels")
    while True:
        around = both.join(state.select(F.col("id").alias("other"), "label"), "other").groupBy("id").agg(F.min("label").alias("m"))
        hooked = cut(state.join(around, "id").select("id", "label", F.least("label", "m").alias("near")), "component-hooked")
        jump = hooked.select(F.col("id").alias("near"), F.col("near").alias("far"))
        told = cut(hooked.join(jump, "near").select("id", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved")), "component-labels")
        state = told.select("id", "label")
        if told.filter("moved").isEmpty():
            return state.select("id", F.col("label").alias("component"))


def with_component(rows: DataFrame, found: DataFrame, key: str, name: str = "component") -> DataFrame:
    """``rows`` with their component; a row in no edge is a component of its own. ``key`` may repeat; a NULL one has NULL."""
    at = found.select(F.col("id").alias("_c_id"), F.col("component").alias("_c"))
    return rows.join(at, F.col(key) == F.col("_c_id"), "left").withColumn(name, F.coalesce("_c", F.col(key))).drop("_c_id", "_c")
