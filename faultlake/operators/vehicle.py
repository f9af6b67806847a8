"""Vehicle, revision and profile of a manual: footer, foreword, metadata and lookup, and the signs of a merged file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultlake.functions import text as T

# Forms of revision lines, page labels, footers, forewords and titles of manuals.
REVISION = r"(?i)^(?:Revision|Edition):\s*(.+)$"
PAGE_LABEL = r"^[A-Z]{2,5}-\d+$"
FOOTER = r"^(\d{4})?\s*([A-Za-z][A-Za-z0-9\-\.]*(?:\s+[A-Za-z0-9\-\.]+)?)\s*([A-Z]{2,})?$"
FOREWORD = r"(?i)for the (\d{4})\s+([A-Z][A-Z\-]+)\s+([A-Z][A-Z0-9\-]+)"
TITLE = r"(\d{4})\s+([A-Za-z]+)\s+([A-Za-z0-9\-]+)"
PREFIX = r"^([A-Z]{2,5})-"


def footer_info(lines: Column) -> Column:
    """Struct (revision_date, year, model, variant) of the last three non-empty footer lines; a later line wins."""
    kept = F.filter(F.transform(lines, T.trim_ws), lambda x: x != "")
    tail = F.slice(kept, F.greatest(F.size(kept) - 2, F.lit(1)), 3)
    start = F.struct(*(F.lit(None).cast("string").alias(n) for n in ("revision_date", "year", "model", "variant")))

    def step(s, line):
        revision = line.rlike(REVISION)
        vehicle = ~revision & ~line.rlike(PAGE_LABEL) & line.rlike(FOOTER)
        name = T.trim_ws(F.regexp_extract(line, FOOTER, 2))
        tail_word = F.regexp_extract(name, r"^(?:.*) ([A-Z]{2,4})$", 1)
        return F.struct(
            F.when(revision & ~line.rlike(PAGE_LABEL), T.trim_ws(F.regexp_extract(line, REVISION, 1))).otherwise(s["revision_date"]).alias("revision_date"),
            F.when(vehicle, T.none_if_blank(F.regexp_extract(line, FOOTER, 1))).otherwise(s["year"]).alias("year"),
            F.when(vehicle, F.when(tail_word != "", F.regexp_extract(name, r"^(.*) [A-Z]{2,4}$", 1)).otherwise(name)).otherwise(s["model"]).alias("model"),
            F.when(vehicle, F.when(tail_word != "", tail_word).otherwise(T.none_if_blank(F.regexp_extract(line, FOOTER, 3)))).otherwise(s["variant"]).alias("variant"))

    return F.aggregate(tail, start, step)


def revision_of(pages: DataFrame) -> DataFrame:
    """(doc, revision_date): first revision or edition line of the first five pages, header before footer."""
    lines = pages.where("page <= 5 and line is not null").withColumn("_r", T.none_if_blank(F.regexp_extract(T.trim_ws(F.col("line")), REVISION, 1))).where("_r is not null")
    return lines.groupBy("doc").agg(F.min_by(T.trim_ws(F.col("_r")), F.struct("page", "zone", "ord")).alias("revision_date"))


def foreword_info(text: Column) -> Column:
    """Struct (year, make, model) of the first foreword phrase, null without one."""
    return F.when(text.rlike(FOREWORD), F.struct(F.regexp_extract(text, FOREWORD, 1).alias("year"), T.title_case(F.regexp_extract(text, FOREWORD, 2)).alias("make"),
                                                 F.upper(F.regexp_extract(text, FOREWORD, 3)).alias("model")))


def title_info(title: Column) -> Column:
    """Struct (year, make, model) of a metadata title, null where it has none."""
    return F.when(title.rlike(TITLE), F.struct(F.regexp_extract(title, TITLE, 1).alias("year"), F.regexp_extract(title, TITLE, 2).alias("make"),
                                               F.upper(F.regexp_extract(title, TITLE, 3)).alias("model")))


def merge_vehicle(docs: DataFrame, lookup: DataFrame) -> DataFrame:
    """Vehicle fields by priority: footer (if it names a model), foreword, metadata if no make is known, then the lookup.

    ``docs``: doc, footer (struct), revision, foreword (struct), title (struct). ``lookup``: model, make.
    """
    foot = F.col("footer.model").isNotNull()
    fore, meta = F.col("foreword").isNotNull(), F.col("foreword.make").isNull() & F.col("title").isNotNull()
    year = F.coalesce(F.when(meta, F.col("title.year")), F.col("foreword.year"), F.when(foot, F.col("footer.year")))
    model = F.coalesce(F.when(meta, F.col("title.model")), F.col("foreword.model"), F.when(foot, F.col("footer.model")))
    make = F.coalesce(F.col("foreword.make"), F.when(meta, F.col("title.make")))
    method = F.when(meta, "metadata").when(fore, "foreword").when(foot, "footer")
    made = docs.select("doc", year.alias("year"), make.alias("make"), model.alias("model"), F.when(foot, F.col("footer.variant")).alias("variant"),
                       F.coalesce(F.when(foot, F.col("footer.revision_date")), F.col("revision")).alias("revision_date"), method.alias("method"))
    keyed = lookup.select(F.upper("model").alias("_key"), F.col("make").alias("_make"))
    joined = made.join(keyed, F.upper("model") == F.col("_key"), "left")
    from_lookup = F.col("make").isNull() & F.col("_make").isNotNull()
    return joined.select("doc", "year", F.coalesce("make", "_make").alias("make"), "model", "variant", "revision_date",
                         F.when(from_lookup & F.col("method").isNull(), "lookup").otherwise(F.col("method")).alias("method"))


def is_digital(pages: DataFrame) -> DataFrame:
    """(doc, digital): whether one of the first five pages has more than 50 signs of text."""
    return pages.groupBy("doc").agg(F.coalesce(F.max(F.when(F.col("page") <= 5, F.length(T.trim_ws(F.col("text"))) > 50)), F.lit(False)).alias("digital"))


def link_sample(links: DataFrame) -> DataFrame:
    """(doc, n_links, has_links, has_internal_links) over the first five pages."""
    return links.where("page <= 5").groupBy("doc").agg(F.count("*").alias("n_links"), (F.count("*") > 0).alias("has_links"), F.max(F.col("kind") == 4).alias("has_internal_links"))


def merged_verdict(labels: DataFrame, toc: DataFrame) -> DataFrame:
    """(doc, is_merged, confidence, evidence, notes) from page-label prefixes and top-level bookmarks.

    ``labels``: doc, ord, prefix; ``toc``: doc, level. Documents of either table come out.
    """
    code = labels.withColumn("code", T.none_if_blank(F.regexp_extract(F.coalesce("prefix", F.lit("")), PREFIX, 1)))
    first = code.where("code is not null").groupBy("doc", "code").agg(F.min("ord").alias("ord"))
    codes = first.groupBy("doc").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "code"))), lambda x: x["code"]).alias("codes"))
    tops = toc.groupBy("doc").agg(F.count_if(F.col("level") == 1).alias("n"))
    docs = labels.select("doc").union(toc.select("doc")).distinct().join(codes, "doc", "left").join(tops, "doc", "left")
    n, m = F.coalesce(F.size("codes"), F.lit(0)), F.coalesce("n", F.lit(0))
    n = F.when(F.col("codes").isNull(), 0).otherwise(n)
    score = F.when(n >= 2, 3).otherwise(0) + F.when(m >= 5, 2).when(m >= 2, 1).otherwise(0)
    listed = F.array_join("codes", ", ")
    # The sentences of evidence and notes.
    evidence = F.array_compact(F.array(
        F.when(n >= 2, F.concat(F.lit("page labels have "), n.cast("string"), F.lit(" distinct section prefixes: "), listed)),
        F.when(m >= 5, F.concat(F.lit("TOC has "), m.cast("string"), F.lit(" top-level sections")))))
    notes = F.array_compact(F.array(
        F.when(n == 1, F.concat(F.lit("single section prefix in page labels: "), listed)).when(n == 0, "no section-code prefixes found in page labels"),
        F.when((m >= 2) & (m < 5), F.concat(F.lit("TOC has "), m.cast("string"), F.lit(" top-level sections (weak signal)")))
        .when(m < 2, F.concat(F.lit("TOC has "), m.cast("string"), F.lit(" top-level section(s) — no signal"))),
        F.when(score == 1, "weak signal — treating as single manual")))
    return docs.select("doc", (score >= 2).alias("is_merged"), F.when(score >= 3, "high").when(score == 2, "medium").when(score == 1, "low").otherwise("high").alias("confidence"),
                       evidence.alias("evidence"), notes.alias("notes"))
