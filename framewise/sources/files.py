"""File sources and sinks: CSV with explicit schema, a folder of text files
read one row per file, and a CSV round trip with an NA token.

Written tables go to a fresh folder in the shared checkpoint area
(``scratch_path``), never to a machine-local temporary folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framewise.session import scratch_path

TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             na: str | None = None) -> DataFrame:
    """CSV with a header row; an explicit schema unless profiling (inference)."""
    r = (spark.read.option("header", True).option("timestampFormat", TS_FORMAT)
         .option("timestampNTZFormat", TS_FORMAT))
    if na is not None:
        r = r.option("nullValue", na)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def write_csv(df: DataFrame, path: str, na: str | None = None) -> str:
    w = (df.write.mode("error").option("header", True).option("timestampFormat", TS_FORMAT)
         .option("timestampNTZFormat", TS_FORMAT))
    if na is not None:
        w = w.option("nullValue", na)
    w.csv(path)
    return path


def csv_roundtrip(df: DataFrame, name: str, na: str = "NA") -> DataFrame:
    """Write ``df`` as CSV with ``na`` for NULL and read it back with the same
    schema (no index column is written)."""
    path = scratch_path(df.sparkSession, name)
    write_csv(df, path, na=na)
    return read_csv(df.sparkSession, path, schema=df.schema, na=na)


def write_doc_folder(docs: DataFrame, document: str, text: str, name: str) -> str:
    """Write the texts as files under one folder per document value
    (``<path>/<document>=x/part-*.txt``).  Every task writes its own files, so
    a document holding most rows is still written by many tasks."""
    path = scratch_path(docs.sparkSession, name)
    docs.select(document, text).write.partitionBy(document).text(path)
    return path


def read_doc_folder(spark: SparkSession, path: str, pattern: str = "*.txt") -> DataFrame:
    """Every file under ``path`` matching ``pattern``: (file_name, folder, text),
    one row per file, the whole file as one value."""
    # options go through text()'s keywords: it resets the ones it does not get
    df = spark.read.text(path, wholetext=True, pathGlobFilter=pattern,
                         recursiveFileLookup=True)
    return df.select(F.col("_metadata.file_name").alias("file_name"),
                     F.regexp_extract(F.col("_metadata.file_path"), "/([^/=]+)=([^/]+)/[^/]+$", 2)
                     .alias("folder"),
                     F.col("value").alias("text"))
