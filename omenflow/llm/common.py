"""Small helpers that the corpus operators share."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of bytes other than the ASCII white space below (the same rule in Java, DuckDB and Python).
WORD = r"[^\x20\x09-\x0D]+"
#: A key with one in this many of all rows is dealt over salts.
SALTED = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``.  Only where that is unset and the master is local, as in tests, a
    local folder becomes the session's checkpoint folder; on a cluster that is an error.
    """
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext._jsc.sc().getCheckpointDir().getOrElse(None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        top = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(top)
    return f"{str(top).rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None, parts: list[str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = path or shared_dir(df.sparkSession)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*parts) if parts else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(col):
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_parts(url):
    """Host and path of a url: from the first ``://`` to ``/ ? #`` or the end, A-Z lower-cased; then to ``? #`` or the end."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    pick = lambda k: F.coalesce(F.regexp_extract(url, pattern, k), F.lit(""))
    return lower_ascii(pick(1)), pick(2)


def salted_join(left: DataFrame, right: DataFrame, key: str, rows: str = "_n", how: str = "left") -> DataFrame:
    """``left`` joined with ``right`` (unique by ``key``; ``rows``: how many rows of ``left`` it meets, dropped here).

    Keys with at least one in ``SALTED`` of all rows are dealt over salts, so that a hot key isn't one task's.
    """
    salts = F.ceil(F.col(rows) * SALTED / right.agg(F.sum(rows)).scalar()).cast("int")
    found = right.withColumn("_salts", salts)
    hot = found.where("_salts > 1").select(key, "_salts")  # SALTED rows at most
    dealt = left.join(F.broadcast(hot), key, "left").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    spread = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_salts"), F.lit(1)) - 1))).drop("_salts", rows)
    return dealt.join(spread, [key, "_salt"], how).drop("_salt")


def fold(doc_id):
    """crc32 of the id as text, modulo 5: the split into folds that all learning operators use."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def give_back() -> None:
    """Return memory that a worker no longer uses to the system: workers live on from task to task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(_libc(), "malloc_trim", None)
    if trim:
        trim(0)


@functools.cache
def _libc():
    return ctypes.CDLL(None)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, joined across batch borders; the input is sorted by the keys."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*cols, strict=True))
        begin = 0
        for i, key in enumerate(rows):
            if key != last:
                if i > begin:
                    held.append(batch.slice(begin, i - begin))
                if held:
                    yield pa.Table.from_batches(held)
                held, begin, last = [], i, key
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)
    held.clear()
    give_back()


def spread(df: DataFrame, parts: int, *keys: str) -> DataFrame:
    """Rows with equal keys together, in as many partitions as the session has for shuffles, or more where the data need them."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, *keys) if parts > least else df.repartition(*keys)


def per_group(df: DataFrame, keys: list[str], fn: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, parts: int = 0) -> DataFrame:
    """``fn`` on each group of rows, many small groups to a task: one Arrow stream a partition instead of one a group."""

    def run(batches):
        for t in groups(batches, keys):
            yield from fn(t)

    return spread(df, parts, *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def text_chunks(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most about ``limit`` bytes of text each (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(size, dtype=np.int64)
    begin = 0
    while begin < batch.num_rows:
        base = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end
    give_back()
