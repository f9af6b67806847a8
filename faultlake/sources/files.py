"""File sources: folders of manuals, lookups and run histories."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def manual_files(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, stem, document_id, length, content) of the files right in a folder, by name; ValueError if there are none.

    The document id is the SHA-256 of the bytes; the content column is read only where it is used.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    if files.select("path").limit(1).count() == 0:
        raise ValueError(f"no {pattern} in {folder}")
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", F.regexp_replace(name, r"\.[^.]*$", "").alias("stem"), F.sha2("content", 256).alias("document_id"), "length", "content").orderBy(name)


def one_manual(spark: SparkSession, path: str) -> DataFrame:
    """A single manual; it must exist and end in .pdf in any case."""
    if not path.lower().endswith(".pdf"):
        raise ValueError(f"not a PDF: {path}")
    folder, _, name = path.rpartition("/")
    return manual_files(spark, folder or ".", name)


def model_lookup(spark: SparkSession, path: str) -> DataFrame:
    """(model, make) of a JSON object; no rows where the file is missing."""
    try:
        raw = spark.read.option("wholetext", True).text(path)
        raw.schema  # noqa: B018
    except Exception as missing:  # Spark raises its own class for a missing path
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], "model string, make string")
    return raw.select(F.explode(F.from_json("value", "map<string,string>")).alias("model", "make"))


def history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Earlier runs; an empty table where there are none yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as missing:
        if "PATH_NOT_FOUND" not in str(missing):
            raise
        return spark.createDataFrame([], schema)
