"""Shaping of tables: selection, relabelling, pivots, positional joins, summaries.  Order always comes from a named column."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .rows import positioned
from .skew import same

#: Which rows each named dataset has, by the author type (0 people, 1 models).
DATASETS = {"all": None, "human": 0, "synthetic": 1}


def author_dataset(df: DataFrame, name: str, column: str = "author_type") -> DataFrame:
    """Rows by people, by models, or all; an unknown name or a missing column is an error."""
    if name not in DATASETS:
        raise ValueError(f"unknown dataset {name!r}; known: {', '.join(DATASETS)}")
    if column not in df.columns:
        raise ValueError(f"no column {column!r}")
    return df if DATASETS[name] is None else df.where(F.col(column) == DATASETS[name])


def without_columns(df: DataFrame, *names: str, pattern: str | None = None) -> DataFrame:
    """Drops named columns (absent ones don't matter) and those whose names match a pattern."""
    import re

    return df.drop(*names, *(c for c in df.columns if pattern and re.search(pattern, c)))


def sliced(df: DataFrame, order: str, begin: int, end: int | None = None) -> DataFrame:
    """Rows at positions ``begin`` to ``end`` (not with it; to the last if none), by ascending ``order``."""
    at = positioned(df, order)
    return at.where((F.col("pos") >= begin) & (F.lit(True) if end is None else F.col("pos") < end))


def last_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    """The ``n`` rows with the largest ``order``."""
    return df.orderBy(F.desc(order)).limit(n)


def batched(df: DataFrame, order: str, size: int = 50) -> DataFrame:
    """Adds ``batch`` from 0: each has ``size`` rows in order, the last the rest."""
    return positioned(df, order).withColumn("batch", F.floor(F.col("pos") / size).cast("long")).drop("pos")


def as_binary(df: DataFrame, label: str, target: str, column: str) -> DataFrame:
    """Adds 1 where a text label is the target, else 0 (null too)."""
    return df.withColumn(column, F.when(F.col(label).eqNullSafe(target), 1).otherwise(0))


def presence(df: DataFrame, keep: list[str]) -> DataFrame:
    """Each cell as 1 (there) or 0 (null), behind the columns to keep."""
    return df.select(*keep, *(F.col(c).isNotNull().cast("int").alias(c) for c in df.columns if c not in keep))


def same_length(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: the counts of two tables; an error if they differ."""
    both = a.agg(F.count("*").alias("rows")).withColumn("side", F.lit(0)).unionByName(b.agg(F.count("*").alias("rows")).withColumn("side", F.lit(1)))
    counts = both.agg(F.max(F.when(F.col("side") == 0, F.col("rows"))).alias("left"), F.max(F.when(F.col("side") == 1, F.col("rows"))).alias("right"))
    told = F.raise_error(F.concat_ws(" ", F.lit("different lengths:"), F.col("left").cast("string"), F.col("right").cast("string")))
    return counts.select(F.when(F.col("left") == F.col("right"), F.col("left")).otherwise(told).alias("rows"))


def beside(front: DataFrame, front_order: str, df: DataFrame, order: str) -> DataFrame:
    """The columns of ``front`` before those of ``df``, row by row; both have equally many rows, else an error."""
    checked = same_length(front, df).select("rows")
    a, b = positioned(front, front_order), positioned(df, order)
    out = a.join(b, "pos").where(F.col("pos") < checked.scalar())
    return out.select("pos", *front.columns, *(c for c in df.columns if c not in front.columns))


def with_labels(df: DataFrame, order: str, found: DataFrame, found_order: str, model: str) -> DataFrame:
    """The last rows of ``df``, as many as there are labels of a model (``y_hat``), with these as ``<model> Prediction``."""
    n, m = df.agg(F.count("*")), found.agg(F.count("*"))
    late = positioned(df, order).withColumn("_k", F.col("pos") - (n.scalar() - m.scalar())).where("_k >= 0")
    said = positioned(found, found_order).select(F.col("pos").alias("_k"), F.col("y_hat").alias(f"{model} Prediction"))
    return late.join(said, "_k").drop("_k", "pos")


def before_last(df: DataFrame, column: str) -> DataFrame:
    """Moves a column to the place before the last."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest[:-1], column, *rest[-1:])


def ordinal(value: Column, levels: dict[str, int]) -> Column:
    """A level's number by an explicit mapping; null where there is none."""
    return F.create_map(*[F.lit(x) for kv in levels.items() for x in kv])[value]


def stacked(df: DataFrame, subject: str, columns: list[str]) -> DataFrame:
    """``subject, rater, value``: wide to long without the nulls."""
    return df.unpivot([subject], columns, "rater", "value").where("value is not null")


def unstacked(long: DataFrame, subject: str, name: str, value: str, names: list[str]) -> DataFrame:
    """Long to wide: a column for each of the names, null where a subject has none."""
    return long.groupBy(subject).pivot(name, names).agg(F.first(value))


def matrix(counts: DataFrame, row: str, column: str, value: str, names: list, total=F.sum) -> DataFrame:
    """One row for each ``row`` and a column for each name, 0 where there is nothing."""
    return counts.groupBy(row).pivot(column, names).agg(total(value)).na.fill(0)


def values_of(df: DataFrame, column: str, order: str) -> DataFrame:
    """``value, first``: distinct values with where they first appear."""
    return df.groupBy(F.col(column).alias("value")).agg(F.min(order).alias("first"))


def listed(df: DataFrame, column: str, within: list[str]) -> DataFrame:
    """A group's distinct values as one sorted list (of a column with few values)."""
    return df.groupBy(*within).agg(F.array_sort(F.collect_set(column)).alias("values"))


def has_duplicates(df: DataFrame, *columns: str) -> DataFrame:
    """One row: whether any row repeats another in some columns."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).agg(F.coalesce(F.max("n") > 1, F.lit(False)).alias("duplicated"))


def columns_equal(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """One row: for each named pair of columns whether they are equal in all rows (nulls are)."""
    return df.agg(*(F.coalesce(F.bool_and(F.col(a).eqNullSafe(F.col(b))), F.lit(True)).alias(n) for n, (a, b) in pairs.items()))


def with_group_size(df: DataFrame, group: str, column: str) -> DataFrame:
    """Adds the number of rows of a row's group, null being one too; counts are made first, so that no group meets in one task."""
    return same(df, df.groupBy(group).agg(F.count("*").alias(column)), group)


def summary_rows(df: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """Mean and sample deviation of each group's columns, then ``mean`` and ``std`` rows: the mean of means, the deviation of deviations."""
    wide = df.groupBy(F.col(group).cast("string").alias("name")).agg(*(f(c).alias(f"{p}_{c}") for c in columns for p, f in (("mean", F.avg), ("std", F.stddev_samp))))
    both = lambda name, f: wide.agg(*(f(c).alias(c) for c in wide.columns[1:])).select(F.lit(name).alias("name"), "*")
    return wide.unionByName(both("mean", F.avg)).unionByName(both("std", F.stddev_samp))


def dataset_kind(name: Column) -> Column:
    """The kind of a dataset by what its name has in it, tried in this order; else the name."""
    out = name
    for kind in ("undersampled", "oversampled", "imbalanced"):
        out = F.when(name.contains(kind), kind).otherwise(out)
    return out


def margins(scores: DataFrame, model: str, columns: list[str]) -> DataFrame:
    """``model, mean, std, margin`` over some columns of each row (population deviation; nulls aside)."""
    long = scores.unpivot([model], columns, "dataset", "score").where("score is not null")
    return long.groupBy(model).agg(F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"), (F.max("score") - F.min("score")).alias("margin"))


def extremes(long: DataFrame, group: str, name: str, score: str) -> DataFrame:
    """Of each group: mean, sample deviation, least, most, margin, and the names that have the most and the least."""
    s = F.col(score)
    return long.groupBy(group).agg(
        F.avg(s).alias("mean"), F.stddev_samp(s).alias("std"), F.min(s).alias("min"), F.max(s).alias("max"), (F.max(s) - F.min(s)).alias("margin"),
        F.min(F.struct((-s).alias("x"), name))[name].alias("best"), F.min(F.struct(s.alias("x"), name))[name].alias("worst"),
    )


def subject_categories(ratings: DataFrame, categories: list) -> DataFrame:
    """How often each subject (``subject, value``) got each category."""
    return ratings.groupBy("subject").pivot("value", categories).agg(F.count(F.lit(1))).na.fill(0)


def ranked(df: DataFrame, score: str, *ties: str, k: int | None = None) -> DataFrame:
    """Rows by falling score, equals by other columns; with ``k`` the first ones only (a heap a task, no global sort)."""
    out = df.orderBy(F.desc(score), *ties)
    return out if k is None else out.limit(k)


def shuffled(df: DataFrame, id_col: str, seed: int = 42) -> DataFrame:
    """Adds ``place``: rows in an order by the hash of ids and a seed, which any engine can repeat; ranges of it are ranked apart."""
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string")).cast("binary")), 1, 15), 16, 10).cast("long")
    return positioned(df.withColumn("_key", key), "_key").withColumnRenamed("pos", "place").drop("_key")


def split_parts(df: DataFrame, id_col: str, labels: list[str], test_share: float = 0.2, seed: int = 42, stratify: bool = False, stratify_by: str | int | None = None) -> DataFrame:
    """Adds ``part`` by a split of rows with several label columns, stratified by one of them or not at all.

    ``stratify_by``: a label column by name or place, the first if none.  Where a class has fewer than two rows, or a part
    would have fewer rows than there are classes, the split isn't stratified.
    """
    from .rows import split

    if not labels:
        raise ValueError("at least one label column is needed")
    if not 0 < test_share < 1:
        raise ValueError(f"test_share must be between 0 and 1, not {test_share}")
    by = 0 if stratify_by is None else stratify_by
    if isinstance(by, bool) or not isinstance(by, (int, str)):
        raise TypeError("stratify_by must be a column's name or place")
    if isinstance(by, int) and not 0 <= by < len(labels):
        raise ValueError(f"stratify_by must be in [0, {len(labels) - 1}]")
    if isinstance(by, str) and by not in labels:
        raise ValueError(f"{by!r} is none of {labels}")
    if stratify:
        column = by if isinstance(by, str) else labels[by]
        sizes = df.groupBy(column).agg(F.count("*").alias("n")).agg(F.min("n").alias("least"), F.count("*").alias("classes"), F.sum("n").alias("n")).first()
        if sizes.n and sizes.least >= 2 and min(sizes.n * test_share, sizes.n * (1 - test_share)) >= sizes.classes:
            return split(df, id_col, column, test_share, seed)
    whole = df.withColumn("_all", F.lit(0))
    return split(whole, id_col, "_all", test_share, seed).drop("_all")


def unlabelled_filled(df: DataFrame, label: str, labeller) -> DataFrame:
    """Rows without a label go through ``labeller`` (which gives one to a table of them); the others come along as they are."""
    return df.where(F.col(label).isNotNull()).unionByName(labeller(df.where(F.col(label).isNull())).select(*df.columns))


def all_equal(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that meet every condition; a null one doesn't."""
    return df.where(reduce(and_, (F.coalesce(c, F.lit(False)) for c in conditions), F.lit(True)))


def sentences_again(tokens: DataFrame, sequence: str, order: str, word: str, closes: Column) -> DataFrame:
    """``sequence, sentence, words``: words in order between rows that close a sentence (a sentence is one short list)."""
    w = Window.partitionBy(sequence).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    numbered = tokens.withColumn("sentence", F.coalesce(F.sum(closes.cast("int")).over(w), F.lit(0)).cast("long")).where(~closes)
    lists = numbered.groupBy(sequence, "sentence").agg(F.array_sort(F.collect_list(F.struct(order, word))).alias("_w"))
    return lists.select(sequence, "sentence", F.transform("_w", lambda x: x[word]).alias("words"))
