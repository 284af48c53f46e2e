"""Lines that a site repeats on many of its pages are dropped (operator 7)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import broadcast_if_small, saved

#: A line goes if it stands on more than this share of its site's pages, and on so many at least.
RATIO = 0.5
MIN_PAGES = 3
BROADCAST_ROWS = 200_000
SALTS = 64


def host(url: Column) -> Column:
    """The host of a web address, lower-cased; empty where there is none."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))), F.lit(""))


def page_text(source: Column) -> Column:
    """The text of a page with a line break for each tag: what stands between two tags is a line."""
    return F.regexp_replace(source, "<[^>]*>", "\n")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _name(line: Column) -> Column:
    return F.unhex(F.md5(line))


def boilerplate(pages: DataFrame, ratio: float, min_pages: int) -> DataFrame:
    """Rows (site, names): the md5 of each line that stands on over ``ratio`` of the site's pages, and on ``min_pages`` at least.

    A page counts once for a line. Of one site at most (lines a page)/``ratio``
    lines can be so frequent, so the arrays are bounded.
    """
    names = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), _has_word), _name))
    counts = pages.select("site", F.explode(names).alias("name")).groupBy("site", "name").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    totals = pages.groupBy(F.col("site").alias("t_site")).agg(F.count("*").alias("n_pages"))
    often = counts.join(totals, F.col("site").eqNullSafe(F.col("t_site"))).where(F.col("n") > ratio * F.col("n_pages"))
    return often.groupBy("site").agg(F.collect_list("name").alias("names"))


def drop_site_lines(pages: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    """Rows (page_id, host, n_lines, n_dropped, text), one per row of ``pages`` (page_id, url, html): pages without the lines that their host repeats.

    Pages without a url, or with one without a host, are one host; a null or
    empty html has no lines; else as in ``drop_repeated_lines``.
    """
    rows = pages.select("page_id", host(F.col("url")).alias("host"), page_text(F.col("html").cast("string")).alias("text"))
    found = drop_repeated_lines(rows, "page_id", "host", "text", ratio, min_pages)
    return found.withColumnsRenamed({"doc_id": "page_id", "site": "host"})


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", site_col: str = "source", text_col: str = "text", ratio: float = RATIO, min_pages: int = MIN_PAGES) -> DataFrame:
    r"""Rows (doc_id, site, n_lines, n_dropped, text), one per row of ``docs``, without its site's boilerplate lines.

    Lines are cut at \n and compared whole; those without a word are never
    dropped nor counted. Pages without a site are one site. A null text counts
    as empty and stays empty. Repeated rows count as pages of their own. The
    boilerplate of a site comes to its pages by broadcast if there are at most
    ``BROADCAST_ROWS`` lines of it in all; beyond that, each site is split into
    ``SALTS`` parts for a shuffled join, so that a site with a third of all
    pages is no single task.
    """
    pages = docs.select(F.col(id_col).alias("doc_id"), F.col(site_col).alias("site"), F.col(text_col).cast("string").alias("text"))
    found = saved(boilerplate(pages, ratio, min_pages), "boilerplate")
    n = found.agg(F.coalesce(F.sum(F.size("names")), F.lit(0))).first()[0]
    salts = 1 if n <= BROADCAST_ROWS else SALTS
    found = found.select(F.col("site").alias("b_site"), "names", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("b_salt"))
    salt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(salts))
    joined = pages.withColumn("salt", salt).join(broadcast_if_small(found, n, BROADCAST_ROWS), F.col("site").eqNullSafe(F.col("b_site")) & (F.col("salt") == F.col("b_salt")), "left")
    lines = joined.select("doc_id", "site", _lines(F.col("text")).alias("lines"), F.coalesce("names", F.expr("cast(array() as array<binary>)")).alias("names"))
    stays = lambda x: ~(_has_word(x) & F.array_contains(F.col("names"), _name(x)))
    kept = lines.select("doc_id", "site", "lines", F.when(F.size("names") == 0, F.col("lines")).otherwise(F.filter("lines", stays)).alias("kept"))
    return kept.select("doc_id", "site", F.size(F.filter("lines", _has_word)).cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_dropped"), F.array_join("kept", "\n").alias("text"))
