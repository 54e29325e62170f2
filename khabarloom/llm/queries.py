"""Queries over the operators of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from khabarloom.llm import batches, gph, langid, leaks, looks, maintext, mixture, neardup, pagepaths, sitelines, truncation
from khabarloom.runtime import cut, table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.found(table(spark, d, "articles"))


def p1_fingerprint_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Articles whose stored fingerprints differ in at most 8 bits."""
    return gph.fingerprint_pairs(table(spark, d, "articles"), "article_id", "simhash")


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    """Every article with its class of equal run sets and the number of other classes it overlaps."""
    return neardup.groups(table(spark, d, "articles"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return batches.found(table(spark, d, "articles"), table(spark, d, "incoming_articles"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return sitelines.found(table(spark, d, "articles"))


def p4_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Every article without the lines that its outlet repeats."""
    articles = table(spark, d, "articles").select("article_id", "source_id", "body")
    marked = sitelines.mark_lines(articles, sitelines.repeated_lines(articles, texts_told=False))
    return sitelines.without_lines(articles, marked).select("article_id", F.md5("body").alias("body"))


def p4_by_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Lines that stand in several distinct texts of an outlet, told on several days."""
    lines = sitelines.repeated_lines(table(spark, d, "articles"), by="clusters")
    return lines.groupBy("source").agg(F.count(F.lit(1)).alias("lines"), F.sum("documents").alias("documents"), F.sum("clusters").alias("clusters"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return truncation.found(table(spark, d, "articles"))


def p5_rates(spark: SparkSession, d: str) -> DataFrame:
    """How often each outlet's fields are cut."""
    articles = table(spark, d, "articles")
    return truncation.cut_rates(articles, truncation.cut_values(articles))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return maintext.found(table(spark, d, "extracted_articles"), table(spark, d, "articles"))


def p6_main_text(spark: SparkSession, d: str) -> DataFrame:
    """The story of every extracted page, without the page around it."""
    pages = table(spark, d, "extracted_articles").select("page_id", F.col("source_id").alias("host"), "body")
    marked = maintext.furniture_lines(pages, cut(maintext.winning_paths(pages), "host-paths"), ["page_id"])
    return maintext.main_text(pages, marked, ["page_id"]).select("page_id", F.md5("body").alias("body"))


def p6_tagged_pages(spark: SparkSession, d: str) -> DataFrame:
    """Articles written as pages with tags, and read by the paths their hosts vote for."""
    pages = pagepaths.as_pages(table(spark, d, "articles"))
    return pagepaths.page_texts(pages, pagepaths.host_paths(pages), ["article_id"]).select("article_id", F.md5("text").alias("text"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return langid.found(table(spark, d, "articles"))


def p7_documents(spark: SparkSession, d: str) -> DataFrame:
    """The language of each article's lines, all together."""
    return langid.document_languages(langid.line_languages(table(spark, d, "articles"))).withColumn("confidence", F.round("confidence", 3))


def p7_items(spark: SparkSession, d: str) -> DataFrame:
    """The language of held-out items, told by the model that the articles give; the SQL states their true one."""
    return langid.text_languages(table(spark, d, "eval_items"), table(spark, d, "articles"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.found(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_spans(spark: SparkSession, d: str) -> DataFrame:
    """Where in each document an item's passages stand, from the first to the last."""
    return leaks.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    """Every document of the mix and how often it is used."""
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    """The share that each listed outlet reaches."""
    return mixture.mix(table(spark, d, "documents"), table(spark, d, "mix_targets"))[1]


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return looks.found(table(spark, d, "documents"))


def p10_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every document that looks like another text, with its class."""
    return looks.classes(table(spark, d, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [p1_found, p1_fingerprint_pairs, p1_groups, p2_found, p4_found, p4_cleaned, p4_by_clusters, p5_found, p5_rates, p6_found, p6_main_text, p6_tagged_pages, p7_found, p7_documents, p7_items, p8_found, p8_spans, p9_mix, p9_shares, p10_found, p10_classes]
    return {f.__name__: f for f in named}


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": neardup.FOUND_SQL,
        "p1_fingerprint_pairs": gph.PAIRS_SQL,
        "p1_groups": neardup.GROUPS_SQL,
        "p2_found": batches.FOUND_SQL,
        "p4_found": sitelines.FOUND_SQL,
        "p4_cleaned": sitelines.CLEANED_SQL,
        "p4_by_clusters": sitelines.CLUSTERS_SQL,
        "p6_tagged_pages": pagepaths.PAGES_SQL,
        "p7_items": "SELECT item_id, lang FROM eval_items",
        "p8_found": leaks.FOUND_SQL,
        "p10_found": looks.FOUND_SQL,
        "p10_classes": looks.CLASSES_SQL,
    }
