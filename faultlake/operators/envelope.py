"""Document envelopes: assembly, slim form, stubs, validation, reports and history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What an envelope may hold.
PDF_TYPES = ("digital", "merged", "scanned")
STATUSES = ("success", "no_content", "scanned", "error")
REQUIRED = ("schema_version", "schema_type", "document_id", "source_file", "metadata", "pdf_profile", "vehicle", "section", "processing")


def slim(records: DataFrame) -> DataFrame:
    """Records without raw texts of sections, rendered texts of tables and the OCR flag of tables."""
    out = records
    if "sections" in records.columns:
        out = out.withColumn("sections", F.transform("sections", lambda s: s.dropFields("raw_text")))
    if "tables" in records.columns:
        out = out.withColumn("tables", F.transform("tables", lambda t: t.dropFields("raw_table_text", "cleaned_table_text").withField("extraction", t["extraction"].dropFields("ocr_used"))))
    return out


def assemble(documents: DataFrame, records: DataFrame) -> DataFrame:
    """One row per document with its records as an ordered array; documents without records have none.

    A document's records are bounded by its pages, so the array of one document fits a task.
    """
    fields = [c for c in records.columns if c != "document_id"]
    nested = records.groupBy("document_id").agg(F.array_sort(F.collect_list(F.struct(F.col("location.start_pdf_page").alias("_page"), *fields))).alias("_r"))
    return documents.join(nested, "document_id", "left").withColumn("records", F.coalesce(F.transform("_r", lambda r: r.dropFields("_page")), F.array())).drop("_r")


def needs_stub(pdf_type: Column, n_records: Column) -> Column:
    """Why a document comes out as a stub: scanned, no_content, or null where it does not."""
    return F.when(pdf_type == "scanned", "scanned").when(F.coalesce(n_records, F.lit(0)) == 0, "no_content")


def envelope_errors(doc: DataFrame) -> Column:
    """Sorted 'path: message' strings of an envelope's faults; an empty array for a sound one."""
    checks = [F.when(F.col(c).isNull(), F.lit(f"{c}: None is not of the wanted type")) for c in REQUIRED if c in doc.columns]
    checks.append(F.when(~F.coalesce(F.col("document_id").rlike("^[0-9a-f]{64}$"), F.lit(True)), F.concat(F.lit("document_id: '"), F.col("document_id"), F.lit("' does not match '^[0-9a-f]{64}$'"))))
    checks.append(F.when(~F.coalesce(F.col("pdf_profile.pdf_type").isin(*PDF_TYPES), F.lit(True)), F.concat(F.lit("pdf_profile/pdf_type: '"), F.col("pdf_profile.pdf_type"), F.lit("' is not one of the types"))))
    checks.append(F.when(~F.coalesce(F.col("processing.extraction_status").isin(*STATUSES), F.lit(True)), F.concat(F.lit("processing/extraction_status: '"), F.col("processing.extraction_status"), F.lit("' is not one of the states"))))
    return F.array_sort(F.array_compact(F.array(*checks)))


def not_done(files: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Files whose stem has no output yet; two files of one stem count as the same."""
    return files if force else files.join(done.select("stem").distinct(), "stem", "left_anti")


def run_report(rows: DataFrame) -> DataFrame:
    """(status, pdf_type, files, records, codes) over a run."""
    return rows.groupBy("status", "pdf_type").agg(F.count("*").alias("files"), F.sum(F.coalesce("record_count", F.lit(0))).alias("records"), F.sum(F.coalesce("dtc_code_count", F.lit(0))).alias("codes"))


def document_counts(records: DataFrame) -> DataFrame:
    """(document_id, record_count, dtc_code_count)."""
    return records.groupBy("document_id").agg(F.count("*").alias("record_count"), F.sum(F.coalesce(F.greatest(F.size("codes"), F.lit(0)), F.lit(0))).alias("dtc_code_count"))


def write_documents(documents: DataFrame, path: str, keep_nulls: bool = True) -> None:
    """JSON lines through the committer's atomic rename; absent optional fields are left out unless nulls are kept."""
    documents.write.mode("overwrite").option("ignoreNullFields", str(not keep_nulls).lower()).json(path)


def append_history(runs: DataFrame, path: str) -> None:
    """The history only grows."""
    runs.write.mode("append").parquet(path)


def metadata_of(manuals: DataFrame) -> DataFrame:
    """Manuals with the fields of their metadata as columns; '' counts as none."""
    fields = manuals.schema["metadata"].dataType.fieldNames()
    return manuals.select(*manuals.columns, *(F.nullif(F.col(f"metadata.{c}"), F.lit("")).alias(c) for c in fields if c not in manuals.columns))


def write_articles(articles: DataFrame, root: str, site: str, output: str | None = None) -> str:
    """Adapted articles as JSON under ``output``, else in the folder of their site; the path is returned."""
    path = output or f"{root}/{site}/data.json"
    articles.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_images(images: DataFrame, folder: str) -> None:
    """Image bytes (name, content) as files of a shared folder, written by the tasks that hold them; equal names are one file.

    A folder with a scheme other than file goes through the file system of that scheme by pyarrow, so tasks of a cluster write to one place. A file is written beside its
    place and then moved, so none is seen half written.
    """

    def write(rows) -> None:
        import os
        from uuid import uuid4

        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)
        system.create_dir(root, recursive=True)
        for r in rows:
            part = f"{root}/.{os.path.basename(r['name'])}.{uuid4().hex}"
            with system.open_output_stream(part) as f:
                f.write(r["content"])
            system.move(part, f"{root}/{r['name']}")

    images.select("name", "content").foreachPartition(write)
