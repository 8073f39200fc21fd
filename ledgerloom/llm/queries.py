"""Queries of the llm problems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.registry import Registry
from ..sources.tables import materialise, table
from .mixture import mix, plan_budgets, quality, report
from .neardup import expanded, similar_classes, similar_groups
from .residue import residue
from .scans import repaired
from .spans import shared_parts, shared_spans, sharing_pairs
from .tokens import decode, encode, pieces
from .wrapper import main_text, site_lines
from .vectors import neighbour_pairs

LLM = Registry()


@LLM.add("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of vectors of which one is among the 10 most similar of the other."""
    return neighbour_pairs(table(spark, sf_dir, "topic_vectors"), "vec_id", "vector", 64, 10)


@LLM.add("p8_ids")
def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document by byte_bpe_50k."""
    return encode(table(spark, sf_dir, "documents"), "doc_id", "text")


@LLM.add("p8_decoded", sql="SELECT doc_id, coalesce(text, '') AS text FROM documents")
def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of all documents, decoded from their ids by the join with the pieces."""
    return decode(encode(table(spark, sf_dir, "documents"), "doc_id", "text"), "doc_id", "ids", pieces(spark))


def _sized(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, int]:
    """Documents with their size in tokens and their weight, as a table, and their number."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sizes = encode(docs, "doc_id", "text").select("doc_id", F.size("ids").alias("n_tokens"))
    weights = docs.select("doc_id", "source", quality(F.col("text")).alias("weight"))
    sized = materialise(weights.join(sizes, "doc_id"), "sized")
    return sized, sized.count()


@LLM.add("p9_mix")
def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of the mixture with their number of copies."""
    docs, rows = _sized(spark, sf_dir)
    return mix(docs, plan_budgets(docs, table(spark, sf_dir, "mix_targets"), None), rows)


@LLM.add("p9_report")
def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares of the sources of the mixture."""
    docs, rows = _sized(spark, sf_dir)
    plan = plan_budgets(docs, table(spark, sf_dir, "mix_targets"), None)
    return report(plan, mix(docs, plan, rows))


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, text) of the search results and pages that are compared; uid is twice the id, plus 1 for pages."""
    results = table(spark, sf_dir, "search_result").where("length(snippet) >= 80 and result_id is not null")
    results = results.select((F.col("result_id") * 2).alias("uid"), F.concat(F.coalesce("title", F.lit("")), F.lit("\n"), "snippet").alias("text"))
    pages = table(spark, sf_dir, "remote_page_result").where("length(extracted_text) >= 200 and page_id is not null")
    pages = pages.select((F.col("page_id") * 2 + 1).alias("uid"), F.col("extracted_text").alias("text"))
    both = results.unionByName(pages).where(r"text rlike '\\S'")
    return both


@LLM.add("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of records of one table with a similarity of at least 0.7 on 5-character substrings."""
    pairs = expanded(*similar_classes(_compared(spark, sf_dir), 0.7)).where("a < b").distinct()
    src = F.when(F.col("a").bitwiseAND(1) == 0, "search_result").otherwise("remote_page_result")
    return pairs.select(src.alias("src"), F.shiftright("a", 1).alias("id_a"), F.shiftright("b", 1).alias("id_b"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc"), "text").where("doc is not null")


@LLM.add("p10_found")
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents that share a verbatim span of at least 200 characters."""
    return sharing_pairs(*shared_spans(_documents(spark, sf_dir)))


@LLM.add("p10_shared")
def p10_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each document that also stands in another one, in spans of at least 200 characters."""
    docs = _documents(spark, sf_dir)
    return shared_parts(docs, *shared_spans(docs)).withColumnRenamed("doc", "doc_id")


def _residue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, row_key) of the pages and snippets that carry residue."""
    results = table(spark, sf_dir, "search_result").select("result_id", "title", "url", "snippet").where("result_id is not null")
    pages = table(spark, sf_dir, "remote_page_result").select("page_id", "result_id", "url", "site", "extracted_text").where("page_id is not null")
    src = lambda name: F.lit(name).alias("src")
    snippets = results.select(src("search_result"), F.col("result_id").alias("row_key"), F.col("snippet").alias("text"), F.regexp_extract("url", r"^[a-z]+://([^/]+)", 1).alias("host"))
    texts = snippets.unionByName(pages.select(src("remote_page_result"), F.col("page_id").alias("row_key"), F.col("extracted_text").alias("text"), F.col("site").alias("host")))

    def heads(rows: DataFrame) -> DataFrame:
        asked = rows.where("src = 'remote_page_result'").select(F.col("row_key").alias("page_id")).join(pages.select("page_id", "result_id", "url"), "page_id")
        titles = results.select("result_id", "title").join(asked.select("result_id").distinct(), "result_id", "left_semi").groupBy("result_id").agg(F.max("title").alias("title"))
        of_pages = asked.join(titles, "result_id", "left").select(src("remote_page_result"), F.col("page_id").alias("row_key"), "title", "url")
        of_results = rows.where("src = 'search_result'").join(results.select(F.col("result_id").alias("row_key"), "title", "url"), "row_key")
        return of_results.select("src", "row_key", "title", "url").unionByName(of_pages)

    names = results.select("title", "url").unionByName(pages.select(F.lit(None).cast("string").alias("title"), "url"))
    return residue(texts, heads, names, ["src", "row_key"], "text", "host", "title", "url")


@LLM.add("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and snippets that carry placeholders, filler, error messages or script notices instead of content."""
    return _residue(spark, sf_dir)


def _repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "remote_page_result").select(F.col("page_id").alias("id"), F.col("extracted_text").alias("text")).where("id is not null")
    corpus = table(spark, sf_dir, "documents").select("text").where("text is not null")
    return repaired(pages, corpus)


@LLM.add("p5_found")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of scanned pages to repair, one row per kind."""
    return _repaired(spark, sf_dir).select(F.col("id").alias("page_id"), F.explode("found").alias("f")).select("page_id", "f.line_no", "f.kind").distinct()


@LLM.add("p5_repaired")
def p5_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text of scanned pages in continuous paragraphs."""
    return _repaired(spark, sf_dir).select(F.col("id").alias("page_id"), "text")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, host, text) of the pages that carry content."""
    pages = table(spark, sf_dir, "remote_page_result").where("page_id is not null")
    # the rows of p6_found, since hosts and titles of all records are evidence
    bad = materialise(_residue(spark, sf_dir).where("src = 'remote_page_result'").select(F.col("row_key").alias("page_id")), "residue-pages")
    return pages.join(bad, "page_id", "left_anti").select(F.col("page_id").alias("id"), F.col("site").alias("host"), F.col("extracted_text").alias("text"))


@LLM.add("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of pages that belong to the site and not to the article or notice."""
    return site_lines(_pages(spark, sf_dir)).select(F.col("id").alias("page_id"), "line_no").distinct()


@LLM.add("p1_main_text")
def p1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of each page."""
    pages = _pages(spark, sf_dir)
    return main_text(pages, site_lines(pages)).withColumnRenamed("id", "page_id")


@LLM.add("p4_groups")
def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record with a similar or equal one: its group, named by the smallest id connected with it."""
    groups = similar_groups(_compared(spark, sf_dir), 0.7)
    src = F.when(F.col("uid").bitwiseAND(1) == 0, "search_result").otherwise("remote_page_result")
    return groups.select(src.alias("src"), F.shiftright("uid", 1).alias("id"), F.shiftright("group", 1).alias("group_id"))
