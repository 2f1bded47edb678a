"""Reading web pages, service answers and transcripts that are already in tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.forecasts import stakes

#: An item's number, and durations before ranges of years, as such lists write them.
NUMBERED = r"\b(\d{1,4})\.(?:\D|$)"
SPAN = r"([?\d]+(?:\s+years)?)\s+(\d{5}-\d{5}|\d{5}-\?{3})"


def plain(markup: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(markup, r"<[^>]*>", ""), r"[ \t\n\r]+", " "))


def paragraphs(html: Column) -> Column:
    """The texts of all ``p`` elements."""
    return F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?s)<p(?:\s[^>]*)?>(.*?)</p>"), 1), plain)


def list_items(html: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r"(?s)<li(?:\s[^>]*)?>(.*?)</li>"), 1), plain)


def links(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``url, link``: each distinct target of each page; a target that begins with ``/`` gets the page's scheme and host."""
    found = pages.select(url, F.explode(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(r'href="([^"]*)"'), 1)).alias("link"))
    base = F.regexp_extract(url, r"^([^:/?#]+://[^/?#]*)", 1)
    return found.select(url, F.when(F.col("link").startswith("/"), F.concat(base, "link")).otherwise(F.col("link")).alias("link")).distinct()


def newest(df: DataFrame, name: str, pattern: str, n: int) -> DataFrame:
    """The ``n`` last names that match, in any case of letters."""
    return df.where(F.col(name).rlike(f"(?i){pattern}")).select(name).distinct().orderBy(F.desc(name)).limit(n)


def yearly(years: DataFrame, template: str, column: str = "year") -> DataFrame:
    """``year, url`` of each distinct year; the template has ``{}`` where it goes.  A null year has none."""
    each = years.select(F.col(column).cast("int").alias("year")).where("year is not null").distinct()
    return each.select("year", F.replace(F.lit(template), F.lit("{}"), F.col("year").cast("string")).alias("url"))


def hits(answers: DataFrame, body: str, schema: str, site: str) -> DataFrame:
    """A row for each ``hits.hits[]._source`` of a search service's answers."""
    read = F.from_json(body, f"hits STRUCT<hits: ARRAY<STRUCT<_source: STRUCT<{schema}>>>>")
    return answers.select(F.explode(read["hits"]["hits"]).alias("h")).select("h._source.*", F.lit(site).alias("site"))


def transcript_sentences(segments: DataFrame, video: str, start: str, text: str) -> DataFrame:
    """``video, pos, sentence``: a video's timed pieces in order, joined and cut at full stops; blank pieces go."""
    whole = segments.groupBy(video).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(start, text))), lambda s: s[text]), " ").alias("_t"))
    cut = whole.select(video, F.posexplode(F.split("_t", r"\.")).alias("pos", "sentence"))
    return cut.withColumn("sentence", F.trim("sentence")).where("sentence <> ''")


def experiments(spark: SparkSession, folder: str) -> DataFrame:
    """``metrics_summary.csv``, a file or a folder that Spark wrote, below ``<experiment with a date>/seedN[_vK]``: the last version of each seed's files."""
    from pyspark.sql.window import Window

    rows = spark.read.option("header", True).option("inferSchema", True).option("recursiveFileLookup", True).option("pathGlobFilter", "{metrics_summary.csv,part-*.csv}").csv(folder)
    rows = rows.where(F.col("_metadata.file_path").rlike(r"/metrics_summary\.csv(?:/part-[^/]*)?$"))
    part = lambda p: F.regexp_extract(F.col("_metadata.file_path"), p, 1)
    named = rows.withColumns({"experiment": part(r"/([^/]*\d{4}-\d{2}-\d{2}[^/]*)/seed\d+"), "seed": part(r"/seed(\d+)").try_cast("int"), "version": F.coalesce(part(r"/seed\d+_v(\d+)/").try_cast("int"), F.lit(0))}).where("experiment <> ''")
    last = F.max("version").over(Window.partitionBy("experiment", "seed"))
    return named.withColumn("_last", last).where("version = _last").drop("_last")


def item_records(pages: DataFrame, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """``id, item, duration, dates, stakes, text``: a page's numbered list items, each number once (where it comes first).

    Numbers are those before a full stop; dates are ranges of five-digit years, as such lists have them.
    """
    each = pages.select(id_col, F.posexplode(list_items(F.col(html))).alias("pos", "text")).withColumn("item", F.regexp_extract("text", NUMBERED, 1)).where("item <> ''")
    first = each.groupBy(id_col, F.col("item").cast("int").alias("item")).agg(F.min(F.struct("pos", "text")).alias("x"))
    text = F.col("x.text")
    return first.select(id_col, "item", F.regexp_extract(text, SPAN, 1).alias("duration"), F.regexp_extract(text, SPAN, 2).alias("dates"), stakes(text).alias("stakes"), text.alias("text"))


def labelled_columns(pages: DataFrame, classes: list[str], html: str = "html", id_col: str = "page_id") -> DataFrame:
    """Rows of a page's spans by class, one column a class; the first row has the headers and goes."""
    lists = [F.transform(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(rf'(?s)<span class="{c}">(.*?)</span>'), 1), plain).alias(c) for c in classes]
    zipped = pages.select(id_col, *lists).select(id_col, F.posexplode(F.arrays_zip(*classes)).alias("pos", "x"))
    return zipped.where("pos > 0").select(id_col, "pos", "x.*")
