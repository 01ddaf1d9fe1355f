"""Articles, links and claims from a table of stored pages (page_id, url, html)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions import html as H
from tallyloom.functions.urls import normalise_url, portal_name, url_host
from tallyloom.operators.frames import unnest
from tallyloom.operators.keyed import dedupe
from tallyloom.operators.skew import ROWS_PER_TASK, address_filter, hot_keys, spread_join, with_filter
from tallyloom.session import cut_lineage

MIN_BODY = 100

# The paragraph rules in use (shortest length left out, text it is measured on, stripping).
BODY_RULES = {
    "plain": {"min_len": None, "measure": "raw", "strip": "none"},
    "portal": {"min_len": 20, "measure": "trimmed", "strip": "trim"},
    "site": {"min_len": 30, "measure": "raw", "strip": "nodes"},
    "claim": {"min_len": 20, "measure": "raw", "strip": "nodes"},
}


def fetched(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages that can be read, and the others with a reason: wrong status or no html."""
    reason = F.when(F.col("html").isNull(), F.lit("no html"))
    if "status" in pages.columns:
        reason = F.when(F.col("status").isNull() | (F.col("status") != 200),
                        F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("unknown")))).otherwise(reason)
    marked = pages.withColumn("reason", reason)
    return marked.filter(F.col("reason").isNull()).drop("reason"), marked.filter(F.col("reason").isNotNull())


def page_titles(pages: DataFrame, default: str | None = "No Title", strip: str = "trim") -> DataFrame:
    """Title of each page."""
    return pages.select("page_id", H.page_title(F.col("html"), default, strip).alias("title"))


def page_bodies(pages: DataFrame, rule: str = "plain") -> DataFrame:
    """Body text of each page under one of ``BODY_RULES``."""
    return pages.select("page_id", H.page_body(F.col("html"), **BODY_RULES[rule]).alias("body"))


def keep_article(articles: DataFrame, title: str = "Title", text: str = "Text", min_body: int = MIN_BODY) -> DataFrame:
    """Articles with a title and more than ``min_body`` characters of text."""
    return articles.filter(F.col(title).isNotNull() & (F.col(title) != "") & (F.length(text) > min_body))


def page_links(pages: DataFrame, patterns=None, limit: int | None = None) -> DataFrame:
    """Distinct links of each page in page order: (page_id, pos, link); the first ``limit`` ones if given."""
    links = H.page_hrefs(F.col("html"), patterns)
    if limit is not None:
        links = F.slice(links, 1, limit)
    return unnest(pages, ["page_id"], links, "link", "pos")


def article_rows(pages: DataFrame, label: str, rule: str = "portal", portal: bool = False) -> DataFrame:
    """News rows: source, title, text, date and a fixed label."""
    html = F.col("html")
    source = portal_name(F.col("url")) if portal else url_host(F.col("url"))
    return pages.select(
        "page_id", F.col("url").alias("URL"), source.alias("Source"),
        H.page_title(html, None).alias("Title"),
        H.page_body(html, **BODY_RULES[rule]).alias("Text"),
        H.publish_date(html).alias("Publish_Date"), F.lit(label).alias("Label"))


def claim_listing(pages: DataFrame) -> DataFrame:
    """Fact-check entries of listing pages: (page_id, pos, title, link), those with a heading and a link."""
    entries = unnest(pages, ["page_id"], H.claim_blocks(F.col("html")), "entry", "pos")
    return entries.select("page_id", "pos", "entry.title", "entry.link").filter(
        F.col("title").isNotNull() & F.col("link").isNotNull())


def join_claim_pages(listing: DataFrame, pages: DataFrame, label: str = "Fake",
                     rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The page behind each entry's link, as news rows. Only bodies of linked pages are cut, and html is not shuffled.

    A bitmap of the linked addresses, of a fixed size, goes to the pages first; the few other pages that pass it find no entry
    in the join. Of several stored pages of one address the first by id is used. Addresses linked very often are split.
    """
    entries = cut_lineage(listing.withColumn("address", normalise_url(F.col("link"))))
    linked = address_filter(entries, "address")
    keyed = with_filter(pages.select("page_id", normalise_url(F.col("url")).alias("address")), "address", linked)
    first = dedupe(keyed, ["address"], ["page_id"])
    found = with_filter(pages.select("page_id", "html", normalise_url(F.col("url")).alias("address")), "address", linked)
    texts = found.select("page_id", H.page_body(F.col("html"), **BODY_RULES["claim"]).alias("Text"))
    behind = first.join(texts, "page_id").select("address", "Text")
    hot = hot_keys(entries, "address", rows_per_task)
    joined = spread_join(entries, behind, "address", hot, spread_by=["page_id", "pos"])
    return joined.select("page_id", "pos", F.col("link").alias("URL"), F.col("title").alias("Title"), "Text",
                         F.lit(label).alias("Label"))
