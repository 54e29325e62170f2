"""Problem 1: records whose content differs by small edits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from khabarloom.llm import runjoin
from khabarloom.operators.groups import components, with_component
from khabarloom.runtime import cut


def near_duplicates(records: DataFrame, key: str = "article_id", text: str = "text", order: runjoin.RunOrder | None = None) -> tuple[DataFrame, DataFrame]:
    """Texts whose run sets overlap by at least 0.5: ``(pairs, members)``.

    ``members``: (key, rep) names for every text with at least one run the smallest key of its
    class; a class is the texts of one run set. ``pairs``: (a, b), a < b, both representatives.
    Within a class every pair overlaps fully. ``key`` names a text; a row that is there twice counts
    once. NULL texts count as empty; texts without a token are in no class. Rows may carry any other
    columns, whatever their names. ``order``: an order of runs other than by their frequency here.
    """
    src = records.select(F.col(key), F.col(text).alias("_text"))
    sets = cut(runjoin.ordered_sets(src, key, "_text", order or runjoin.run_order(src, "_text")), "neardup-sets")
    classes = sets.groupBy("hi", "lo").agg(F.min(key).alias("rep"))
    members = sets.select(key, "hi", "lo").distinct().join(classes, ["hi", "lo"]).select(key, "rep")
    reps = runjoin.one_per_class(sets, key, ["hi", "lo"])
    post = runjoin.postings(reps.withColumnRenamed(key, "id"), "id")
    a, b = post.alias("a"), post.alias("b")
    na, nb = F.col("a.n"), F.col("b.n")
    met = a.join(b, (F.col("a.run") == F.col("b.run")) & (F.col("a.id") < F.col("b.id")) & runjoin.probed(na, F.col("a.pos"), nb, F.col("b.pos")))
    counted = met.groupBy(F.col("a.id").alias("a"), F.col("b.id").alias("b"), runjoin.least_met(na, nb).alias("least"))
    candidates = counted.agg(F.count(F.lit(1)).alias("met")).filter("met >= least").select("a", "b")
    candidates = cut(candidates, "neardup-candidates")
    checked = runjoin.overlap_pairs(candidates, src, key, "_text")
    return checked.filter(2 * F.col("shared") >= F.col("total")).select("a", "b").distinct(), members


def all_pairs(pairs: DataFrame, members: DataFrame, key: str = "article_id") -> DataFrame:
    """Every pair of texts that overlap, copies included: (a, b), a < b."""
    m = members.select(F.col(key).alias("x"), "rep")
    across = (
        pairs.join(m.select(F.col("x").alias("x"), F.col("rep").alias("a")), "a")
        .join(m.select(F.col("x").alias("y"), F.col("rep").alias("b")), "b")
        .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    )
    several = m.groupBy("rep").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("rep")
    copies = m.join(several, "rep")
    inside = copies.alias("p").join(copies.alias("q"), (F.col("p.rep") == F.col("q.rep")) & (F.col("p.x") < F.col("q.x")))
    return across.unionByName(inside.select(F.col("p.x").alias("a"), F.col("q.x").alias("b")))


def found(articles: DataFrame) -> DataFrame:
    """Pairs of articles with an overlap of 0.5 or more, smaller id first."""
    pairs, members = near_duplicates(articles.select("article_id", runjoin.story_text().alias("text")))
    return all_pairs(pairs, members).select(F.col("a").alias("article_a"), F.col("b").alias("article_b"))


def groups(articles: DataFrame) -> DataFrame:
    """(article_id, rep, links, story): each article's class, how many other classes overlap it by 0.5 or more, and its group.

    A class is one run set, named by its smallest article; a group (``story``) is what overlaps
    connect, directly or through others, named by its smallest article. One row per article, however
    many copies there are. Articles without a token are a class and a group of their own.
    """
    pairs, members = near_duplicates(articles.select("article_id", runjoin.story_text().alias("text")))
    pairs, members = cut(pairs, "group-pairs"), cut(members, "group-members")
    links = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).groupBy(F.col("a").alias("rep")).agg(F.count(F.lit(1)).alias("links"))
    classed = with_component(members.join(links, "rep", "left").select("article_id", "rep", F.coalesce("links", F.lit(0)).alias("links")), components(pairs), "rep", "story")
    alone = articles.select("article_id").distinct().join(members.select("article_id"), "article_id", "left_anti")
    return classed.unionByName(alone.select("article_id", F.col("article_id").alias("rep"), F.lit(0).cast("long").alias("links"), F.col("article_id").alias("story")))


RUNS_SQL = r"""
tokens_{0} AS (SELECT article_id, regexp_extract_all(lower(title || ' ' || CASE WHEN body = '' THEN summary ELSE body END), '[\p{{L}}\p{{N}}_\x{{0900}}-\x{{097F}}]+') AS t FROM {0}),
sets_{0} AS (SELECT article_id, list_distinct(CASE WHEN len(t) >= 3 THEN list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i + 2], ' ')) WHEN len(t) > 0 THEN [array_to_string(t, ' ')] ELSE [] END) AS r FROM tokens_{0}),
runs_{0} AS (SELECT article_id, len(r) AS n, unnest(r) AS run FROM sets_{0})"""

FOUND_SQL = f"""
WITH {RUNS_SQL.format('articles')}
SELECT a.article_id AS article_a, b.article_id AS article_b FROM runs_articles a JOIN runs_articles b ON a.run = b.run AND a.article_id < b.article_id
GROUP BY 1, 2 HAVING 2 * count(*) >= max(a.n) + max(b.n) - count(*)
"""

GROUPS_SQL = f"""
WITH RECURSIVE {RUNS_SQL.format('articles')},
keyed AS (SELECT article_id, md5(array_to_string(list_sort(r), '|')) AS k FROM sets_articles WHERE len(r) > 0),
reps AS (SELECT k, min(article_id) AS rep FROM keyed GROUP BY 1),
pairs AS (
  SELECT a.article_id AS a, b.article_id AS b FROM runs_articles a JOIN runs_articles b ON a.run = b.run AND a.article_id <> b.article_id
  WHERE a.article_id IN (SELECT rep FROM reps) AND b.article_id IN (SELECT rep FROM reps)
  GROUP BY 1, 2 HAVING 2 * count(*) >= max(a.n) + max(b.n) - count(*)
), links AS (SELECT a AS rep, count(*) AS links FROM pairs GROUP BY 1),
walk AS (SELECT a AS rep, a AS seen FROM pairs UNION SELECT w.rep, p.b FROM walk w JOIN pairs p ON p.a = w.seen),
stories AS (SELECT rep, min(seen) AS story FROM walk GROUP BY 1)
SELECT x.article_id, coalesce(r.rep, x.article_id) AS rep, coalesce(l.links, 0) AS links, coalesce(s.story, r.rep, x.article_id) AS story
FROM articles x LEFT JOIN keyed USING (article_id) LEFT JOIN reps r USING (k) LEFT JOIN links l ON l.rep = r.rep LEFT JOIN stories s ON s.rep = r.rep
"""
