"""Joins by keys of which a few may have a large share of all rows, and small inputs dealt over all cores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with at least one in this many rows is hot.
HOT = 1 << 10


def over_cores(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt over all cores where the input has fewer splits than those, as one small file has; else as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def with_values(df: DataFrame, values: DataFrame, key: str, rows: str, how: str = "inner") -> DataFrame:
    """``df`` joined with ``values`` (a row a key; ``rows``: how many rows of ``df`` have the key; left out of the result).

    Hot keys, ``HOT`` at most, are dealt over salts on one side and repeated for each salt on the other, so that a task
    gets about one in ``HOT`` of all rows at most beside its share.  Null keys don't join.
    """
    salts = F.greatest(F.ceil(F.col(rows) * HOT / F.greatest(values.agg(F.sum(rows)).scalar(), F.lit(1))).cast("int"), F.lit(1))
    found = values.withColumn("_salts", salts)
    hot = found.where("_salts > 1").select(key, "_salts")
    dealt = df.join(F.broadcast(hot), key, "left").withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    spread = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1))).drop("_salts", rows)
    return dealt.join(spread, [key, "_salt"], how).drop("_salt")


def same(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """``left`` and ``right`` joined where the keys are the same, null as null; the keys stand once, as in a join by names."""
    renamed = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys))
    return left.join(renamed, on, how).drop(*(f"_same_{k}" for k in keys))
