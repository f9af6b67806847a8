"""Crawled articles: adaptation, language choice, deduplication and field rules.

Empty and null values follow the article contract: strings default to '', arrays to []. Equal titles are
compared in lower case without outer white space; blank titles are never merged. Ties are broken by the order columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from faultlake.functions import text as T

SUMMARY_CHARS = 200


def _strings(value: Column) -> Column:
    return F.coalesce(value, F.array().cast("array<string>"))


def adapt_articles(raw: DataFrame) -> DataFrame:
    """Raw articles in the contract's shape: stripped text, a summary, defaults, url (else source) as source."""
    content = F.coalesce(T.trim_ws(F.col("content")), F.lit(""))
    kept = [c for c in ("images", "categories", "tags", "fault_codes", "part_numbers") if c in raw.columns]
    address = F.coalesce(*(F.nullif(F.col(c), F.lit("")) for c in ("url", "source") if c in raw.columns), F.lit(""))
    used = {"title", "content", "summary", *kept, "comments", "published_date", "source", "url"}
    return raw.select(
        *(c for c in raw.columns if c not in used),
        F.coalesce(T.trim_ws(F.col("title")), F.lit("")).alias("title"), content.alias("content"),
        F.substring(content, 1, SUMMARY_CHARS).alias("summary"), *(_strings(F.col(c)).alias(c) for c in kept),
        *([F.coalesce("comments", F.array().cast(raw.schema["comments"].dataType)).alias("comments")] if "comments" in raw.columns else []),
        F.coalesce("published_date", F.lit("")).alias("published_date"), address.alias("source"))


def english_or_all(paragraphs: Column) -> Column:
    """The English paragraphs, or all of them where none is English."""
    found = F.filter(paragraphs, T.is_english)
    return F.when(F.size(found) > 0, found).otherwise(paragraphs)


def without_word(values: Column, word: str) -> Column:
    """Distinct values in order, without those that contain ``word``."""
    return F.filter(F.array_distinct(values), lambda c: ~F.contains(F.lower(c), F.lit(word)))


def without_inline_images(images: Column) -> Column:
    return F.array_distinct(F.filter(images, lambda u: u.isNotNull() & ~u.startswith("data:")))


def first_by_title(articles: DataFrame, order: list[str]) -> DataFrame:
    """One article for each title, the first by ``order``; blank titles are all kept."""
    keyed = articles.withColumn("_key", F.lower(T.trim_ws(F.coalesce("title", F.lit("")))))
    winners = keyed.where("_key <> ''").groupBy("_key").agg(F.min(F.struct(*order)).alias("_w"))
    titled = keyed.where("_key <> ''").join(winners, "_key").where(F.struct(*order) == F.col("_w"))
    return titled.select(*articles.columns).union(keyed.where("_key = ''").select(*articles.columns))


def collect_urls(links: DataFrame, most: int | None, order: list[str]) -> DataFrame:
    """Distinct URLs over the index pages, first place wins, at most ``most`` (None or 0: all)."""
    first = links.where("url is not null and url <> ''").groupBy("url").agg(F.min(F.struct(*order)).alias("_at"))
    found = first.select("url", "_at.*").orderBy(*order)
    return found.limit(most) if most else found


def preceding_label(nodes: DataFrame) -> DataFrame:
    """For each list node the text of the nearest label element before it: (page_id, ord, label)."""
    label = F.when(F.col("tag").isin("p", "h1", "h2", "h3", "strong", "b", "span"), F.col("text"))
    before = W.partitionBy("page_id").orderBy("ord").rowsBetween(W.unboundedPreceding, -1)
    return nodes.withColumn("label", F.last(label, ignorenulls=True).over(before)).where("tag = 'ul'").select("page_id", "ord", "text", "label")


def comments_of(comments: Column) -> Column:
    """Comments (author, text, date) that have a text, with '' for what is missing, in order."""
    made = F.transform(comments, lambda c: F.struct(*(F.coalesce(c[n], F.lit("")).alias(n) for n in ("author", "text", "date"))))
    return F.filter(F.coalesce(made, F.array().cast("array<struct<author:string,text:string,date:string>>")), lambda c: c["text"] != "")
