"""Readers.  Every path goes to Spark, never to the local file system."""

from __future__ import annotations

import logging
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LOG = logging.getLogger(__name__)


def delimited(spark: SparkSession, path, schema: str | None = None, sep: str = "\t", encoding: str = "UTF-8", header: bool = True, skip_bad: bool = False) -> DataFrame:
    """Delimited text, compressed or not; bad lines fail, or are skipped."""
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("header", header).option("mode", "DROPMALFORMED" if skip_bad else "FAILFAST")
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def tolerant(spark: SparkSession, path, schema: str, sep: str = ",", encoding: str = "UTF-8", header: bool = True) -> DataFrame:
    """Delimited text, compressed or not (zstd too), of which lines with too many fields are left out.

    Fields that a line lacks are null, and so are those that aren't of their column's type; such lines stay.
    """
    reader = spark.read.option("sep", sep).option("encoding", encoding).option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_line")
    rows = reader.schema(f"{schema}, _more STRING, _line STRING").csv(path)
    # A line of the right length is short by the field added here, so that Spark keeps it whole in ``_line``.
    return rows.where(F.col("_more").isNull() & F.col("_line").isNotNull()).drop("_more", "_line")


def batch_or_none(spark: SparkSession, path, schema: str) -> DataFrame | None:
    """A batch's table, without rows where its files have none; where there is no such path, a line in the log and None."""
    try:
        return spark.read.schema(schema).option("header", True).csv(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        LOG.warning("no batch at %s", path)
        return None


def json_records(spark: SparkSession, path, schema: str | None = None, lines: bool = True) -> DataFrame:
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema else reader).json(path)


def numbered_lines(spark: SparkSession, path, blank: Column | None = None) -> DataFrame:
    """``file, line, block, value``: each file's lines from 0, however many tasks read it; ``block`` counts the ``blank`` ones before.

    Spark cuts large files at lines.  A line's place in its cut and the sizes of the cuts before give its number, so that no
    file is ever in one row or sorted; only its cuts are, of which there is one in 128 MB.
    """
    blank = F.trim("value") == "" if blank is None else blank
    rows = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_cut"), blank.cast("int").alias("_blank"))
    rows = rows.withColumn("_id", F.monotonically_increasing_id())
    cut = Window.partitionBy("file").orderBy("_cut")
    sizes = rows.groupBy("file", "_cut").agg(F.count("*").alias("_n"), F.sum("_blank").alias("_b"), F.min("_id").alias("_first"))
    before = sizes.select("file", "_cut", "_first", (F.sum("_n").over(cut) - F.col("_n")).alias("_lines"), (F.sum("_b").over(cut) - F.col("_b")).alias("_blanks"))
    placed = rows.join(before, ["file", "_cut"])
    running = F.sum("_blank").over(Window.partitionBy("file", "_cut").orderBy("_id").rowsBetween(Window.unboundedPreceding, 0))
    return placed.select("file", (F.col("_lines") + F.col("_id") - F.col("_first")).alias("line"), (F.col("_blanks") + running).alias("block"), "value")


def tagged_tokens(spark: SparkSession, path) -> DataFrame:
    """BIO files (``index, term, tag``), in which blank lines or terms end sentences: ``file, line, sentence, term, tag``."""
    term = F.coalesce(F.trim(F.get(F.split("value", "\t"), F.lit(1))), F.lit(""))
    rows = numbered_lines(spark, path, term == "")
    fields = F.split("value", "\t")
    out = rows.select("file", "line", F.trim(F.get(fields, F.lit(1))).alias("term"), F.trim(F.get(fields, F.lit(2))).alias("tag"), F.col("block").alias("sentence"))
    return out.where(F.coalesce("term", F.lit("")) != "")


def json_elements(spark: SparkSession, path, schema: str, opens: str) -> DataFrame:
    """Records of files that are arrays, each read by many tasks: they are cut where ``opens`` stands.

    ``opens`` is how each record begins, its brace, first key and colon as the files write them, and stands nowhere else.
    What can't be read between two of them is an error.
    """
    pieces = spark.read.option("lineSep", opens).text(path).where(~F.col("value").rlike(r"^\s*\[?\s*\]?\s*$"))
    record = F.concat(F.lit(opens), F.regexp_replace("value", r"[\s,\]]+\z", ""))
    read = F.from_json(record, schema, {"mode": "FAILFAST"})
    return pieces.select(read.alias("r")).select("r.*")


def marked_up_text(spark: SparkSession, path) -> DataFrame:
    """One row a non-empty file: its text without prolog and tags, white space collapsed."""
    text = F.trim(F.regexp_replace(F.regexp_replace("value", r"(?s)<[^>]*>", " "), r"\s+", " "))
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), text.alias("text")).where("text <> ''")


def batches(spark: SparkSession, folder: str, kind: str, first: int, last: int) -> DataFrame:
    """The batches ``folder/kind/batch=n`` from first to last, by partition pruning; missing ones are passed over."""
    return spark.read.parquet(f"{folder}/{kind}").where(F.col("batch").between(first, last))


def latest(names: DataFrame, prefix: str, column: str = "name") -> DataFrame:
    """``name, version`` of the largest version of ``prefix``; no row where there is none."""
    from ..functions.text import version_of

    found = names.where(F.col(column).startswith(prefix)).select(F.col(column).alias("name"), version_of(F.col(column)).alias("version")).where("version is not null")
    return found.orderBy(F.desc("version"), "name").limit(1)


def decoded_lines(spark: SparkSession, path, encoding: str = "UTF-8") -> DataFrame:
    """``file, line, value``: lines of files with bytes that can't be read, which are left out."""

    @F.pandas_udf("string")
    def lossy(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield part.map(lambda b: bytes(b).decode(encoding, errors="ignore"))

    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), lossy("content").alias("text"))
    return files.select("file", F.posexplode(F.split("text", "\r?\n")).alias("line", "value"))


def plain_lines(spark: SparkSession, path) -> DataFrame:
    """Lines that aren't blank, trimmed."""
    return spark.read.text(path).select(F.trim("value").alias("value")).where("value <> ''")


def names_by_category(spark: SparkSession, path) -> DataFrame:
    """``category, name``: the lines of ``<category>.txt`` files, in ASCII letters."""
    from ..functions.forecasts import ascii_letters

    category = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]*$", 1)
    return spark.read.text(path).select(category.alias("category"), ascii_letters(F.trim("value")).alias("name")).where("name <> ''")


def synthetic(spark: SparkSession, folder: str, kind: str, batch: int, return_as: str = "frame"):
    """One batch of a kind, as a table or as its path."""
    path = f"{folder}/{kind}/batch={batch}"
    if return_as == "path":
        return path
    if return_as != "frame":
        raise ValueError(f"unknown return_as {return_as!r}")
    return spark.read.parquet(path)
