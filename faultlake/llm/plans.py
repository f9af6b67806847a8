"""Queries of the text problems with their SQL counterparts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultlake.llm import canonical, leaks, mainbody, mixing, neardup, split, subjects
from faultlake.session import table


def _records(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf, "dtc_records"), table(spark, sf, "code_records")


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return split.oversized(*_records(spark, sf))


def p1_pieces(spark: SparkSession, sf: str) -> DataFrame:
    return split.split_records(*_records(spark, sf))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.similar_records(neardup.code_texts(table(spark, sf, "code_records")))


def p3_classes(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.record_classes(neardup.code_texts(table(spark, sf, "code_records")))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return canonical.manual_models(table(spark, sf, "manuals"), table(spark, sf, "vehicle_models"))


def p4_unmatched(spark: SparkSession, sf: str) -> DataFrame:
    return canonical.unmatched(table(spark, sf, "manuals"), table(spark, sf, "vehicle_models"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return mainbody.main_lines(table(spark, sf, "articles"))


def p6_body(spark: SparkSession, sf: str) -> DataFrame:
    return mainbody.main_text(table(spark, sf, "articles"))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items")).select("doc_id", "item_id").distinct()


def p7_items(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items")).groupBy("item_id").agg(
        F.countDistinct("doc_id").alias("n_documents"), F.max("held_words").alias("most_words"))


def p7_clean(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.without_leaks(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return p8_shares(spark, sf).where("short").select("source")


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.shares(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture(table(spark, sf, "documents"), table(spark, sf, "mix_targets"))


def _subject_inputs(spark: SparkSession, sf: str) -> list[DataFrame]:
    return [table(spark, sf, t) for t in ("documents", "subject_labels", "subjects", "eval_items")]


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return subjects.document_subjects(*_subject_inputs(spark, sf)).select("doc_id", "subject_id")


def p9_composition(spark: SparkSession, sf: str) -> DataFrame:
    inputs = _subject_inputs(spark, sf)
    return subjects.composition(inputs[0], subjects.document_subjects(*inputs), inputs[2])


QUERIES = {f.__name__: f for f in (
    p1_found, p1_pieces, p3_found, p3_classes, p4_found, p4_unmatched, p6_found, p6_body, p7_found, p7_items, p7_clean,
    p8_found, p8_shares, p8_mixture, p9_found, p9_composition)}

SQL = {
    "p1_found": """select distinct item_table, record_id, cast(item_pos as integer) as item_pos from (
 select 'dtc_records' as item_table, record_id, unnest(sections).cleaned_text as t, generate_subscripts(sections, 1) as item_pos from dtc_records
 union all select 'code_records', record_id, unnest(content_blocks).text, generate_subscripts(content_blocks, 1) from code_records)
 where length(t) > 1500 and record_id is not null""",
}
