"""Writers: versions, batches, exports."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share (``spark.checkpoint.dir``); a local one only on a local master."""
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = tempfile.mkdtemp(prefix="spark-")
    return f"{top.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame, path: str | None = None, write=None) -> DataFrame:
    """``df`` written to a scratch folder (``write``: how, from its writer) and read from there; what was shuffled for it is deleted then."""
    spark = df.sparkSession
    path = path or scratch(spark)
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        write(df.write) if write else df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.set(name, before)
    return spark.read.schema(df.schema).parquet(path)


def forgotten(df: DataFrame) -> None:
    """Delete the folder of a table that ``written`` gave, which nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def append_batch(df: DataFrame, folder: str, kind: str, batch: int) -> None:
    """Write (or write again) one batch of a kind."""
    if kind not in ("prediction", "observation"):
        raise ValueError(f"unknown kind {kind!r}")
    df.write.mode("overwrite").parquet(f"{folder}/{kind}/batch={batch}")


def as_log_lines(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.lit("CSV Row: "), F.concat_ws(", ", *[F.col(c).cast("string") for c in df.columns])).alias("value"))


def next_version(names: DataFrame, prefix: str) -> DataFrame:
    """One more than the largest version of ``prefix-vN.ext`` in a table of ``name``; 1 if there is none."""
    found = F.regexp_extract("name", rf"^{prefix}-v?(\d+)(?:\.|$)", 1).try_cast("int")
    return names.agg((F.coalesce(F.max(found), F.lit(0)) + 1).alias("version"))


def json_rows(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def from_log_lines(lines: DataFrame, ignore: list[str], delimiter: str = ",") -> DataFrame:
    """``fields`` of the lines in which none of the words to ignore is; the fields are trimmed."""
    kept = lines
    for word in ignore:
        kept = kept.where(~F.col("value").contains(word))
    return kept.select(F.transform(F.split(F.trim("value"), rf"\Q{delimiter}\E"), lambda x: F.trim(x)).alias("fields"))


def versioned(df: DataFrame, folder: str, prefix: str, kind: str = "parquet", version: int | None = None) -> str:
    """Write ``prefix`` (over what is there) or, with a version, ``prefix-vN`` (an error if it is there); gives the path."""
    if kind not in ("parquet", "csv", "json"):
        raise ValueError(f"unknown kind {kind!r}")
    path = f"{folder}/{prefix}" + ("" if version is None else f"-v{version}")
    writer = df.write.mode("overwrite" if version is None else "errorifexists")
    (writer.option("header", True) if kind == "csv" else writer).format(kind).save(path)
    return path


def append_pending(todo: DataFrame, folder: str, id_col: str, work, schema: str) -> None:
    """A resumable job: rows whose id isn't in ``folder`` yet go through ``work`` and are appended."""
    try:
        left = todo.join(todo.sparkSession.read.schema(schema).parquet(folder).select(id_col), id_col, "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        left = todo
    work(left).write.mode("append").parquet(folder)


def sidecar(spark: SparkSession, folder: str, **values) -> None:
    """A run's parameters and counts as one row of JSON, written once."""
    spark.createDataFrame([tuple(map(str, values.values()))], list(values)).coalesce(1).write.mode("ignore").json(folder)


def next_dated(names: DataFrame, prefix: str, date: str) -> DataFrame:
    """One more than the largest version of ``<prefix>v<N>_<date>``; 1 if there is none of that date."""
    found = F.regexp_extract("name", rf"^\Q{prefix}\Ev(\d+)_\Q{date}\E$", 1).try_cast("int")
    return names.agg((F.coalesce(F.max(found), F.lit(0)) + 1).alias("version"))


def free_name(names: DataFrame, base: str) -> str:
    """``base``, or ``base_vN`` with the first N that isn't taken."""
    number = F.when(F.col("name") == base, 0).otherwise(F.regexp_extract("name", rf"^\Q{base}\E_v(\d+)$", 1).try_cast("int"))
    taken = names.select(number.alias("n")).where("n is not null").distinct()
    first = taken.where("n > 0").union(taken.sparkSession.range(1).select(F.lit(0).alias("n")))
    if not taken.where("n = 0").limit(1).count():
        return base
    after = first.select((F.col("n") + 1).alias("n")).join(first, "n", "left_anti").agg(F.min("n")).first()[0]
    return f"{base}_v{after}"


def write_run(df: DataFrame, experiment: str, seed: int, on_collision: str = "error", kind: str = "parquet") -> str:
    """A run below ``experiment/seed<N>``: an error, written over, or kept beside the first (``append``) where it is there already."""
    modes = {"error": "errorifexists", "overwrite": "overwrite", "append": "append", "cancel": "ignore"}
    if on_collision not in modes:
        raise ValueError(f"unknown on_collision {on_collision!r}")
    path = f"{experiment}/seed{seed}"
    df.write.mode(modes[on_collision]).format(kind).save(path)
    return path


def log_batches(df: DataFrame, folder: str, label: str = "sentence_label", batch: str = "batch_id") -> None:
    """Rows by kind (label 1: prediction, 0: observation) and batch, added to what is there."""
    kind = F.when(F.col(label) == 1, "prediction").otherwise("observation")
    df.withColumns({"kind": kind, "batch": F.col(batch)}).write.mode("append").partitionBy("kind", "batch").parquet(folder)


def without_header(df: DataFrame, path: str, sep: str = "\t") -> None:
    """Delimited text without a header, such as a vocabulary."""
    df.write.mode("overwrite").option("sep", sep).option("header", False).csv(path)


def latex_rows(df: DataFrame) -> DataFrame:
    """A LaTeX table's rows as text; columns in their order."""
    cells = [F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"([&%$#_{}])", r"\\$1"), F.lit("")) for c in df.columns]
    return df.select(F.concat(F.concat_ws(" & ", *cells), F.lit(r" \\")).alias("value"))
