"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Rows with equal texts form a group.  Groups are placed by greedy vector bin packing: in falling order of size, each
goes to the shard in which the dot product of its vector (bytes, tokens, rows) with the residual capacity is highest.
A greedy pass over every group of a large corpus would be one long loop in one place, so that the items packed are
bounded in number: groups too large for an even result are cut into pieces of about ``share`` of a shard, groups that have
at least one in ``n_shards * per_shard`` of all bytes, tokens or rows are items of their own, and only smaller groups are
hashed into as many bundles.  So at most ``3 * n_shards * (per_shard + 1 / share)`` groups and pieces and ``n_shards * per_shard``
bundles reach the driver, by their sums, whatever the corpus; on a small one nearly all groups are placed one by one.
Slots are counted inside parts of items and offset by the sizes of the parts before, so that no shard's or item's rows
meet in one task.

Cases: a null text counts as empty (size 16, crc32 0); equal rows, and rows with the same id, each get a slot of their
own; an empty table gives an empty result.  The law is ``bytes``: the sizes of the shards come out nearly equal.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, stored, table

DIMENSIONS = ("bytes", "tokens", "rows")
#: Rows that one part of an item has, about.
PART_ROWS = 1 << 17


def pack(vectors: np.ndarray, n_shards: int, order: np.ndarray | None = None) -> np.ndarray:
    """The shard of each item, largest items first, each where the dot product with the residual capacity is highest.

    Capacities are equal; a dimension's weight is one over its capacity.  Residuals may turn negative: the last items
    then go where least is exceeded.  Ties go to the smallest shard number.
    """
    out = np.zeros(len(vectors), np.int32)
    if not len(vectors):
        return out
    total = vectors.sum(axis=0).astype(np.float64)
    unit = vectors / np.where(total > 0, total / n_shards, 1.0)
    residual = np.ones((n_shards, unit.shape[1]))
    for i in np.lexsort((np.arange(len(unit)), -unit.max(axis=1))) if order is None else order:
        k = int(np.argmax(residual @ unit[i]))
        out[i] = k
        residual[k] -= unit[i]
    return out


def shard(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16, per_shard: int = 256, share: float = 1 / 8) -> DataFrame:
    """Adds ``size, text_crc32, shard, slot`` to the id column."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + overhead).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("grp"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("tokens"),
    )
    # Texts are read once; from here on rows are narrow, and have a number of their own, as ids may repeat or be null.
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("b"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("t"), F.count("*").alias("r")).first()
    piece = [max(1.0, x * share / n_shards) for x in total]
    n_bundles = n_shards * per_shard
    unit = [max(1.0, x / n_bundles) for x in total]
    sums = rows.groupBy("grp").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r"))
    most = lambda by: F.greatest(F.col("b") / by[0], F.col("t") / by[1], F.col("r") / by[2])
    pieces = F.greatest(F.lit(1), F.least(F.ceil(most(piece)).cast("int"), F.col("r").cast("int")))
    own = sums.where(most(unit) >= 1).select("grp", pieces.alias("pieces"))  # 3 * n_bundles rows at most
    dealt = rows.join(F.broadcast(own), "grp", "left")
    salt = F.pmod(F.xxhash64("row"), F.col("pieces"))
    bundle = F.when(F.col("pieces").isNull(), F.pmod(F.xxhash64("grp"), F.lit(n_bundles)).cast("string")).otherwise(F.concat_ws("/", F.col("grp").cast("string"), salt.cast("string")))
    subs = max(1, -(-int(total.r) // (n_bundles * PART_ROWS)))
    sub = F.pmod(F.xxhash64("row", F.lit(7)), F.lit(subs)).cast("int")
    dealt = dealt.select("id", "size", "text_crc32", "tokens", bundle.alias("bundle"), sub.alias("sub"))
    bundles = sorted((r.bundle, int(r.b), int(r.t), int(r.n)) for r in dealt.groupBy("bundle").agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("n")).collect())
    where = pack(np.array([x[1:] for x in bundles], np.float64).reshape(-1, 3), n_shards)
    offset, placed = [0] * n_shards, []
    for (name, _, _, n), k in zip(bundles, where.tolist(), strict=True):
        placed.append((name, k, offset[k]))
        offset[k] += n
    places = F.broadcast(spark.createDataFrame(placed, "bundle string, shard int, offset long"))  # bounded, see above
    if subs > 1:
        parts = dealt.groupBy("bundle", "sub").agg(F.count("*").alias("n"))
        before = F.sum("n").over(Window.partitionBy("bundle").orderBy("sub")) - F.col("n")
        places = parts.select("bundle", "sub", before.alias("before")).join(places, "bundle").select("bundle", "sub", "shard", (F.col("offset") + F.col("before")).alias("offset"))
    slot = F.row_number().over(Window.partitionBy("bundle", "sub").orderBy("id", "text_crc32", "size"))
    return dealt.join(places, ["bundle", "sub"] if subs > 1 else "bundle").select("id", "size", "text_crc32", "shard", (F.col("offset") + slot - 1).cast("long").alias("slot"))


def op3_vector_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shard(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
