"""Shaping, splitting and balancing of rows, and positional operators inside groups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.writers import scratch
from .skew import same


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """``label, n, pct``; only counts meet in one place."""
    counted = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("all"))
    return counted.join(total).select("label", "n", F.round(100 * F.col("n") / F.col("all"), 1).alias("pct"))


def profile(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by each key and in all, in one pass: ``key, value, n``."""
    sets = F.explode(F.array(F.struct(F.lit("all").alias("key"), F.lit("all").alias("value")), *(F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys)))
    return df.select(sets.alias("x")).groupBy("x.key", "x.value").agg(F.count("*").alias("n"))


def order_key(id_col: str, seed: int):
    """A fixed pseudo-random order of ids that any engine with MD5 can repeat."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary"))


def split(df: DataFrame, id_col: str, stratum: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Adds ``part`` (train or test), stratified: an exact share of each stratum's rows in hash order.

    A stratum's rows are cut by the first 16 bits of their hash first; only the slice in which the border falls is
    ranked, so that no stratum is sorted in one task.  Rows without a stratum are one of their own.
    """
    slot = F.conv(F.substring("_key", 1, 4), 16, 10).cast("int")
    rows = df.withColumn("_key", order_key(id_col, seed)).withColumn("_slot", slot)
    counts = rows.groupBy(stratum, "_slot").agg(F.count("*").alias("_n"))
    running = Window.partitionBy(stratum).orderBy("_slot")  # 65,536 rows a stratum at most
    border = counts.select(stratum, "_slot", (F.sum("_n").over(running) - F.col("_n")).alias("_before"), F.floor(F.sum("_n").over(Window.partitionBy(stratum)) * test_share + 0.5).alias("_test"))
    placed = same(rows, border, stratum, "_slot")
    rank = F.row_number().over(Window.partitionBy(stratum, "_slot").orderBy("_key", id_col))
    return placed.withColumn("part", F.when(F.col("_before") + rank <= F.col("_test"), "test").otherwise("train")).drop("_key", "_slot", "_before", "_test")


def balanced(df: DataFrame, id_col: str, label: str, method: str, seed: int = 42) -> DataFrame:
    """Over- or under-sampling to the largest or smallest class: whole copies, then the rows first in hash order.

    Rows without a label are a class.
    """
    if method not in ("oversample", "undersample"):
        raise ValueError(f"unknown method {method!r}")
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    goal = counts.agg((F.max if method == "oversample" else F.min)("_n").alias("_goal"))
    sized = counts.join(goal)
    copies = F.explode(F.sequence(F.lit(0), F.ceil(F.col("_goal") / F.col("_n")).cast("int") - 1))
    each = same(df, sized, label).withColumn("_copy", copies)
    # Whole copies stay; of the last one, what is needed is split off.
    rest = F.col("_goal") - F.col("_n") * F.floor(F.col("_goal") / F.col("_n"))
    whole = each.where(F.col("_copy") < F.floor(F.col("_goal") / F.col("_n")))
    part = each.where(F.col("_copy") >= F.floor(F.col("_goal") / F.col("_n"))).withColumn("_key", order_key(id_col, seed))
    slot = F.conv(F.substring("_key", 1, 4), 16, 10).cast("int")
    part = part.withColumn("_slot", slot).withColumn("_rest", rest)
    per = part.groupBy(label, "_slot").agg(F.count("*").alias("_c"))
    before = per.select(label, "_slot", (F.sum("_c").over(Window.partitionBy(label).orderBy("_slot")) - F.col("_c")).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(label, "_slot").orderBy("_key", id_col))
    kept = same(part, before, label, "_slot").withColumn("_rank", rank).where(F.col("_before") + F.col("_rank") <= F.col("_rest"))
    return whole.select(df.columns).unionByName(kept.select(df.columns))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    counted = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n").alias("all"), F.count("*").alias("k"))
    return counted.join(total).select("label", (F.col("all") / (F.col("k") * F.col("n"))).alias("weight"))


def islands(df: DataFrame, group: str, order: list[str], closes) -> DataFrame:
    """Adds ``block``: rows between those that close a block (which belong to none)."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("block", F.sum(closes.cast("int")).over(w)).where(~closes)


def transitions(df: DataFrame, group: str, order: str, state: str) -> DataFrame:
    """``state, next_state, n, p`` of neighbouring rows in each group; null is a state like others."""
    after = df.select(F.col(state).alias("state"), F.lead(F.struct(F.col(state).alias("s"))).over(Window.partitionBy(group).orderBy(order)).alias("next")).where("next is not null")
    counted = after.groupBy("state", F.col("next.s").alias("next_state")).agg(F.count("*").alias("n"))
    return counted.withColumn("p", F.col("n") / F.sum("n").over(Window.partitionBy("state")))  # a row for each pair of states


def lookback(df: DataFrame, group: str, order: list[str], value: str, n: int) -> DataFrame:
    """``x``: the last ``n`` values before each row, as a string of two decimals; ``y``: the row's own value."""
    w = Window.partitionBy(group).orderBy(*order)
    before = [F.lag(value, k).over(w) for k in range(n, 0, -1)]
    return df.select(group, *order, F.array(*before).alias("x"), F.col(value).alias("y")).where(F.forall("x", lambda v: v.isNotNull()))


def pending(todo: DataFrame, done: DataFrame, id_col: str) -> DataFrame:
    """What a resumed job has still to do."""
    return todo.join(done.select(id_col), id_col, "left_anti")


def keep_first(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The row with the smallest ``order`` of each key; rows of a hot key are pre-aggregated, not ranked."""
    rest = [c for c in df.columns if c not in (*keys, order)]
    return df.groupBy(*keys).agg(F.min(F.struct(order, *rest)).alias("_x")).select(*keys, "_x.*")


def natural_join(left: DataFrame, right: DataFrame) -> DataFrame:
    """Inner join on all columns of the same name."""
    return left.join(right, [c for c in left.columns if c in right.columns])


def slices(df: DataFrame, value: str, parts: int = 64):
    """A column that deals rows over up to ``parts`` ranges of a number, of about equal sizes.

    The borders are approximate quantiles, ``parts - 1`` numbers in one row; a row's slice depends on its value alone.
    """
    cuts = df.select(F.percentile_approx(value, [k / parts for k in range(1, parts)], 10000)).first()[0] or []
    return sum(((F.col(value) >= c).cast("int") for c in sorted(set(cuts))), F.lit(0))


def positioned(df: DataFrame, order: str) -> DataFrame:
    """Adds ``pos`` from 0 by ascending ``order`` of any type that sorts; nulls come last, equal ones in the order of the input.

    Rows are dealt over as many ranges as the session has shuffle partitions, or the input splits if those are more; equal
    values, however many, over several.  The sorted ranges are written once, so that positions inside and sizes
    of the ranges before are of one and the same sort.
    """
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())
    keys = [F.asc_nulls_last(order), F.asc("_tie")]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # A number's upper bits are its range, the lower 33 the place inside.
    ranged = ranged.drop("_tie").withColumn("_at", F.monotonically_increasing_id())
    path = scratch(spark)
    ranged.write.parquet(path)
    part = F.shiftright("_at", 33)
    placed = spark.read.schema(ranged.schema).parquet(path).withColumns({"_part": part, "_k": F.col("_at") - F.shiftleft(part, 33)})
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    base = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_base"))  # one row a range
    return placed.join(F.broadcast(base), "_part").withColumn("pos", F.col("_base") + F.col("_k")).drop("_part", "_base", "_k", "_at")


def zipped(left: DataFrame, left_order: str, right: DataFrame, right_order: str) -> DataFrame:
    """Rows at the same position of two ordered tables, side by side."""
    return positioned(left, left_order).join(positioned(right, right_order), "pos")
