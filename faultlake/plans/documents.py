"""Queries of document assembly, validation, reports and file sources, and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultlake.operators import envelope as E
from faultlake.session import staged_folder, table

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f
    return add


_MAN = "m as (select * from manuals where document_id is not null qualify row_number() over (partition by document_id order by loaded_at) = 1)"
_DTC = "d as (select * from dtc_records where record_id is not null qualify row_number() over (partition by record_id order by loaded_at) = 1)"


def _manuals(spark, sf):
    return table(spark, sf, "manuals").dropDuplicates(["document_id"])


def _records(spark, sf):
    return table(spark, sf, "dtc_records").dropDuplicates(["record_id"])


@query("prj3_assembled_documents", f"with {_MAN}, {_DTC} select m.document_id, cast(count(d.record_id) as integer) as n_records, min(d.location.start_pdf_page) as first_page from m left join d on m.document_id = d.document_id group by 1")
def prj3(spark, sf):
    docs = E.assemble(_manuals(spark, sf).select("document_id", "source_file"), _records(spark, sf).select("document_id", "record_id", "codes", "location"))
    return docs.select("document_id", F.size("records").alias("n_records"), F.array_min(F.transform("records", lambda r: r["location"]["start_pdf_page"])).alias("first_page"))


@query("prj1_slim", f"with {_DTC} select record_id, cast(coalesce(len(sections), -1) as integer) as n_sections, cast(coalesce(len(tables), -1) as integer) as n_tables from d")
def prj1(spark, sf):
    r = _records(spark, sf)
    full = r.withColumn("sections", F.transform("sections", lambda s: s.withField("raw_text", s["cleaned_text"]))).withColumn(
        "tables", F.transform("tables", lambda t: t.withField("raw_table_text", F.lit("x")).withField("cleaned_table_text", F.lit("x")).withField("extraction", t["extraction"].withField("ocr_used", F.lit(False)))))
    slim = E.slim(full)
    if slim.schema["sections"] != r.schema["sections"] and slim.schema["sections"].dataType.elementType.fieldNames() != r.schema["sections"].dataType.elementType.fieldNames():
        raise AssertionError("slim records must have the stored fields")
    return slim.select("record_id", F.coalesce(F.when(F.col("sections").isNotNull(), F.size("sections")), F.lit(-1)).alias("n_sections"), F.coalesce(F.when(F.col("tables").isNotNull(), F.size("tables")), F.lit(-1)).alias("n_tables"))


@query("snk2_stubs", f"with {_MAN}, {_DTC}, n as (select document_id, count(*) as n from d group by 1) select m.document_id, case when pdf_profile.pdf_type = 'scanned' then 'scanned' when coalesce(n, 0) = 0 then 'no_content' end as reason from m left join n on m.document_id = n.document_id")
def snk2(spark, sf):
    n = E.document_counts(_records(spark, sf))
    return _manuals(spark, sf).join(n, "document_id", "left").select("document_id", E.needs_stub(F.col("pdf_profile.pdf_type"), F.col("record_count")).alias("reason"))


@query("agg7_document_counts", f"with {_DTC} select document_id, count(*) as record_count, cast(sum(coalesce(len(codes), 0)) as bigint) as dtc_code_count from d group by 1")
def agg7(spark, sf):
    return E.document_counts(_records(spark, sf))


@query("flt30_validation", f"""with {_MAN} select document_id, list_sort(list_filter([{', '.join(f"case when {c} is null then '{c}: None is not of the wanted type' end" for c in E.REQUIRED)},
 case when not regexp_matches(document_id, '^[0-9a-f]{{64}}$') then 'document_id: ''' || document_id || ''' does not match ''^[0-9a-f]{{64}}$''' end,
 case when pdf_profile.pdf_type not in {E.PDF_TYPES} then 'pdf_profile/pdf_type: ''' || pdf_profile.pdf_type || ''' is not one of the types' end,
 case when processing.extraction_status not in {E.STATUSES} then 'processing/extraction_status: ''' || processing.extraction_status || ''' is not one of the states' end], lambda x: x is not null)) as errors from m""")
def flt30(spark, sf):
    m = _manuals(spark, sf)
    return m.select("document_id", E.envelope_errors(m).alias("errors"))


@query("flt1_not_done", f"with {_MAN} select document_id from (select document_id, lower(regexp_replace(source_file, '\\.[^.]*$', '')) as stem from m) where stem not in (select lower(regexp_replace(file, '\\.[^.]*$', '')) from run_reports where status = 'success' and file is not null)")
def flt1(spark, sf):
    stem = lambda c: F.lower(F.regexp_replace(c, r"\.[^.]*$", ""))
    files = _manuals(spark, sf).select("document_id", stem("source_file").alias("stem"))
    done = table(spark, sf, "run_reports").where("status = 'success' and file is not null").select(stem("file").alias("stem"))
    return E.not_done(files, done).where("stem is not null").select("document_id")


@query("snk4_run_report", "select status, pdf_type, count(*) as files, cast(sum(coalesce(record_count, 0)) as bigint) as records, cast(sum(coalesce(dtc_code_count, 0)) as bigint) as codes from (select * from run_reports where report_id is not null qualify row_number() over (partition by report_id order by loaded_at) = 1) group by 1, 2")
def snk4(spark, sf):
    return E.run_report(table(spark, sf, "run_reports").where("report_id is not null").dropDuplicates(["report_id"]))


@query("snk5_history", "select run_date, count(distinct report_id) as n from run_reports where report_id is not null group by run_date")
def snk5(spark, sf):
    """The reports of a run appended to a history and read again."""
    from uuid import uuid4

    from faultlake.sources.files import history

    path = f"{staged_folder(spark)}/history-{uuid4().hex}"
    rows = table(spark, sf, "run_reports").where("report_id is not null").select("report_id", "run_date").distinct()
    E.append_history(rows, path)
    return history(spark, path, "report_id bigint, run_date string").groupBy("run_date").agg(F.count("*").alias("n"))


@query("snk1_documents_json", f"with {_MAN} select document_id, source_file from m")
def snk1(spark, sf):
    """Documents written as JSON lines and read again."""
    from uuid import uuid4

    path = f"{staged_folder(spark)}/documents-{uuid4().hex}"
    E.write_documents(_manuals(spark, sf).select("document_id", "source_file", "metadata"), path)
    return spark.read.schema("document_id string, source_file string").json(path)


@query("prj2_vehicle_source", f"with {_MAN} select document_id, vehicle.source.method as method, vehicle.source.pdf_page as pdf_page from m where vehicle is not null")
def prj2(spark, sf):
    v = _manuals(spark, sf).where("vehicle is not null").withColumn("vehicle", F.col("vehicle").withField("source", F.col("vehicle.source").withField("make_from_lookup", F.lit(True))))
    return v.withColumn("vehicle", F.col("vehicle").dropFields("source.make_from_lookup")).select("document_id", "vehicle.source.method", "vehicle.source.pdf_page")


@query("jn19_documents_of_adapters", f"with {_MAN}, {_DTC}, c as (select document_id, count(distinct record_id) as n_codes from code_records group by 1), t as (select document_id, count(*) as n_dtc from d group by 1) select m.document_id, n_dtc, n_codes from m join t on m.document_id = t.document_id join c on m.document_id = c.document_id")
def jn19(spark, sf):
    c = table(spark, sf, "code_records").select("document_id", "record_id").distinct().groupBy("document_id").agg(F.count("record_id").alias("n_codes"))
    t = _records(spark, sf).groupBy("document_id").agg(F.count("*").alias("n_dtc"))
    return _manuals(spark, sf).select("document_id").join(t, "document_id").join(c, "document_id")


@query("src3_document_ids", "select doc_id, sha256(text) as document_id from documents where text is not null")
def src3(spark, sf):
    return table(spark, sf, "documents").where("text is not null").select("doc_id", F.sha2(F.encode("text", "utf-8"), 256).alias("document_id"))


METADATA = ("title", "author", "subject", "keywords", "creator", "producer", "format", "creation_date", "modification_date", "encryption")


@query("src4_metadata", f"with {_MAN} select document_id, {', '.join(f"nullif(metadata.{c}, '') as {c}" for c in METADATA)} from m where metadata is not null")
def src4(spark, sf):
    return E.metadata_of(_manuals(spark, sf).where("metadata is not null")).select("document_id", *METADATA)


@query("srt1_files_by_name", f"with {_MAN} select document_id, source_file from m where source_file is not null")
def srt1(spark, sf):
    return _manuals(spark, sf).where("source_file is not null").select("document_id", "source_file").orderBy("source_file", "document_id")


@query("stream_new_reports", "select count(*) as n from (select distinct report_id from run_reports where report_id is not null)")
def stream(spark, sf):
    """An extension: the reports taken in as a stream that stops when all files are done, each delivered once."""
    from uuid import uuid4

    from faultlake.streaming.ingest import ingest

    base = f"{staged_folder(spark)}/stream-{uuid4().hex}"
    rows = table(spark, sf, "run_reports").where("report_id is not null").select("report_id", "status")
    rows.write.parquet(f"{base}/in")
    ingest(spark, f"{base}/in", "report_id bigint, status string", lambda s: s.dropDuplicates(["report_id"]), f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").agg(F.count("*").alias("n"))


@query("prj6_final_tables", f"with {_DTC} select record_id, cast(pos as integer) as pos, x.start_pdf_page as start_pdf_page, coalesce(x.end_pdf_page, x.start_pdf_page) as end_pdf_page, coalesce(x.page_refs, []) as page_refs from (select record_id, generate_subscripts(tables, 1) - 1 as pos, unnest(tables) as x from d)")
def prj6(spark, sf):
    t = _records(spark, sf).select("record_id", F.posexplode("tables").alias("pos", "x"))
    return t.select("record_id", "pos", "x.start_pdf_page", F.coalesce("x.end_pdf_page", "x.start_pdf_page").alias("end_pdf_page"), F.coalesce("x.page_refs", F.array().cast("array<string>")).alias("page_refs"))


@query("prj7_optional_fields", f"with {_DTC} select record_id, list_filter([case when title is not null then 'title' end, case when manual_type is not null then 'manual_type' end, 'record_id'], lambda k: k is not null) as present from d")
def prj7(spark, sf):
    """Absent optional fields are left out of the written JSON; the keys that remain are read back from the text."""
    made = _records(spark, sf).select("record_id", F.to_json(F.struct("title", "manual_type", "record_id")).alias("j"))
    return made.select("record_id", F.json_object_keys("j").alias("present"))


@query("flt3_gates", f"with {_MAN}, {_DTC} select document_id from m where pdf_profile.pdf_type is distinct from 'scanned' and document_id in (select document_id from d)")
def flt3(spark, sf):
    m = _manuals(spark, sf).where("not (pdf_profile.pdf_type <=> 'scanned')").select("document_id")
    return m.join(_records(spark, sf).select("document_id"), "document_id", "left_semi")


@query("src1_manual_folder", f"with {_MAN} select distinct lower(document_id) as stem, sha256(source_file) as document_id, cast(strlen(source_file) as bigint) as length from m where source_file is not null")
def src1(spark, sf):
    """File names of the manuals written as small files of their own and read again as binary files with content ids."""
    from uuid import uuid4

    from faultlake.sources.files import manual_files

    folder = f"{staged_folder(spark)}/manuals-{uuid4().hex}"
    rows = _manuals(spark, sf).where("source_file is not null").select(F.concat(F.lower("document_id"), F.lit(".pdf")).alias("name"), F.encode("source_file", "utf-8").alias("content"))
    E.write_images(rows, folder)
    return manual_files(spark, folder).select("stem", "document_id", "length")


@query("src15_model_lookup", "select upper(model) as model, min(make) as make from vehicle_models group by 1")
def src15(spark, sf):
    from uuid import uuid4

    from faultlake.sources.files import model_lookup

    path = f"{staged_folder(spark)}/lookup-{uuid4().hex}"
    one = table(spark, sf, "vehicle_models").groupBy(F.upper("model").alias("model")).agg(F.min("make").alias("make"))
    # the lookup is a list of known vehicles, one JSON object
    one.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("model", "make")))).alias("value")).coalesce(1).write.text(path)
    return model_lookup(spark, path).where("model is not null")


@query("snk6_articles_json", r"select article_id, regexp_replace(coalesce(title, ''), '^[\s\x{00A0}]+|[\s\x{00A0}]+$', '', 'g') as title from (select * from articles where article_id is not null qualify row_number() over (partition by article_id order by fetched_at) = 1)")
def snk6(spark, sf):
    """Adapted articles written as JSON to their site's folder and read again."""
    from uuid import uuid4

    from faultlake.operators import articles as A

    made = A.adapt_articles(table(spark, sf, "articles").where("article_id is not null").dropDuplicates(["article_id"]))
    path = E.write_articles(made, f"{staged_folder(spark)}/sites-{uuid4().hex}", "site")
    return spark.read.schema("article_id long, title string").json(path)


@query("flt30_schema_errors", f"""with {_MAN} select document_id, list_sort(list_filter([case when schema_version is null then 'schema_version:  None is not of type ''string''' end, case when vehicle is null then 'vehicle:  None is not of type ''object''' end,
 case when metadata is null then 'metadata:  None is not of type ''object''' end, case when section is null then 'section:  None is not of type ''object''' end, case when processing is null then 'processing:  None is not of type ''object''' end,
 case when processing is not null and processing.errors is null then 'processing  >  errors:  None is not of type ''array''' end,
 case when pdf_profile.pdf_type not in ('digital', 'merged') then 'pdf_profile  >  pdf_type:  ''' || pdf_profile.pdf_type || ''' is not one of [''digital'', ''merged'']' end], lambda e: e is not null)) as errors from m""")
def flt30b(spark, sf):
    """Envelopes checked against a JSON schema, read from a file as the pipeline does."""
    from faultlake.operators import validation

    schema = {"type": "object", "properties": {"schema_version": {"type": "string"}, "vehicle": {"type": "object"}, "metadata": {"type": "object"}, "section": {"type": "object"},
              "processing": {"type": "object", "properties": {"errors": {"type": "array", "items": {"type": "string"}}}}, "pdf_profile": {"type": ["object", "null"], "properties": {"pdf_type": {"enum": ["digital", "merged"]}}}}}
    m = _manuals(spark, sf)
    return m.select("document_id", validation.schema_errors(F.to_json(F.struct("schema_version", "vehicle", "metadata", "section", "processing", "pdf_profile"), {"ignoreNullFields": "false"}), schema).alias("errors"))
