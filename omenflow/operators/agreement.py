"""Classification metrics and agreement of raters, as aggregates over long tables of ratings (``subject, rater, value``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .rows import slices


def share(part: Column, whole: Column) -> Column:
    """0 where the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def long_ratings(df: DataFrame, subject: str, raters: list[str]) -> DataFrame:
    """Wide raters to rows; nulls are dropped."""
    return df.unpivot([subject], raters, "rater", "value").where("value is not null").withColumnRenamed(subject, "subject")


def confusion(df: DataFrame, truth: str, raters: list[str]) -> DataFrame:
    """``model, y, y_hat, n``."""
    return df.unpivot([truth], raters, "model", "y_hat").groupBy("model", F.col(truth).alias("y"), "y_hat").agg(F.count("*").alias("n"))


def binary_metrics(cells: DataFrame) -> DataFrame:
    """One row a model from its confusion matrix; ROC-AUC is that of the hard labels."""
    n = lambda y, p: F.coalesce(F.sum(F.when((F.col("y") == y) & (F.col("y_hat") == p), F.col("n"))), F.lit(0))
    c = cells.groupBy("model").agg(n(1, 1).alias("tp"), n(0, 1).alias("fp"), n(1, 0).alias("fn"), n(0, 0).alias("tn"))
    tp, fp, fn, tn = map(F.col, ("tp", "fp", "fn", "tn"))
    f1 = lambda hit, false, missed: share(2 * hit, 2 * hit + false + missed)
    return c.select(
        "model", share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        share(tn, tn + fn).alias("precision_class_0"), share(tp, tp + fp).alias("precision_class_1"),
        share(tn, tn + fp).alias("recall_class_0"), share(tp, tp + fn).alias("recall_class_1"),
        f1(tn, fn, fp).alias("f1_class_0"), f1(tp, fp, fn).alias("f1_class_1"),
        ((share(tp, tp + fn) + share(tn, tn + fp)) / 2).alias("auc"),
    )


def kappa_pairs(ratings: DataFrame) -> DataFrame:
    """Cohen's kappa of each pair of raters: one pass over pairs of ratings of a subject, then counts only."""
    a, b = ratings.alias("a"), ratings.alias("b")
    both = a.join(b, (F.col("a.subject") == F.col("b.subject")) & (F.col("a.rater") < F.col("b.rater")))
    cells = both.groupBy(F.col("a.rater").alias("model_1"), F.col("b.rater").alias("model_2"), F.col("a.value").alias("v1"), F.col("b.value").alias("v2")).agg(F.count("*").alias("n"))
    keys = ["model_1", "model_2"]
    total = cells.groupBy(keys).agg(F.sum("n").alias("t"), F.sum(F.when(F.col("v1") == F.col("v2"), F.col("n")).otherwise(0)).alias("same"))
    left = cells.groupBy(*keys, F.col("v1").alias("v")).agg(F.sum("n").alias("n1"))
    right = cells.groupBy(*keys, F.col("v2").alias("v")).agg(F.sum("n").alias("n2"))
    chance = left.join(right, [*keys, "v"]).groupBy(keys).agg(F.sum(F.col("n1") * F.col("n2")).alias("e"))
    po, pe = F.col("same") / F.col("t"), F.coalesce("e", F.lit(0)) / (F.col("t") * F.col("t"))
    return total.join(chance, keys, "left").select(*keys, F.try_divide(po - pe, 1 - pe).alias("kappa"))


def fleiss_kappa(ratings: DataFrame) -> DataFrame:
    """One row; every subject has the same number of ratings."""
    cells = ratings.groupBy("subject", "value").agg(F.count("*").alias("n"))
    by_subject = cells.groupBy("subject").agg(F.sum("n").alias("m"), F.sum(F.col("n") * F.col("n")).alias("q"))
    agree = by_subject.agg(F.avg((F.col("q") - F.col("m")) / (F.col("m") * (F.col("m") - 1))).alias("p"), F.sum("m").alias("t"))
    chance = cells.groupBy("value").agg(F.sum("n").alias("n")).agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("q"))
    pe = F.col("q") / (F.col("t").cast("double") * F.col("t"))
    return agree.join(chance).select(F.try_divide(F.col("p") - pe, 1 - pe).alias("fleiss_kappa"))


def majority(ratings: DataFrame) -> DataFrame:
    """``subject, vote, votes``: the most frequent value, the smallest of equals."""
    counted = ratings.groupBy("subject", "value").agg(F.count("*").alias("n"))
    return counted.groupBy("subject").agg(F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("x")).select("subject", F.col("x.value").alias("vote"), (-F.col("x.n")).alias("votes"))


def report(cells: DataFrame) -> DataFrame:
    """``model, class, precision, recall, f1, support`` of a confusion matrix."""
    said = cells.select("model", F.col("y_hat").alias("class"), "n", F.lit(1).alias("said"), (F.col("y") == F.col("y_hat")).alias("hit"))
    true = cells.select("model", F.col("y").alias("class"), "n", F.lit(0).alias("said"), F.lit(False).alias("hit"))
    of = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    sums = said.unionByName(true).groupBy("model", "class").agg(of(F.col("hit")).alias("h"), of(F.col("said") == 1).alias("s"), of(F.col("said") == 0).alias("support"))
    h, s, t = map(F.col, ("h", "s", "support"))
    return sums.select("model", "class", share(h, s).alias("precision"), share(h, t).alias("recall"), share(2 * h, s + t).alias("f1"), "support")


def report_averages(reported: DataFrame) -> DataFrame:
    """``model, row, precision, recall, f1, support``: each model's plain (macro) and support-weighted averages."""
    names = ("precision", "recall", "f1")
    n = F.sum("support")
    macro = reported.groupBy("model").agg(F.lit("macro avg").alias("row"), *(F.avg(c).alias(c) for c in names), n.alias("support"))
    return macro.unionByName(reported.groupBy("model").agg(F.lit("weighted avg").alias("row"), *(share(F.sum(F.col(c) * F.col("support")), n).alias(c) for c in names), n.alias("support")))


def ranked_pairs(kappas: DataFrame) -> DataFrame:
    """Adds ``rank``, by falling kappa.  A row for each pair of raters, so that one task ranks them."""
    return kappas.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("kappa"), "model_1", "model_2")))


def auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """One row: the chance that a positive scores above a negative, equals counting half.

    Equal scores are counted first; the running sum goes over ranges of scores, each in its own task, and over the
    ranges' totals.
    """
    y = F.col(truth).cast("int")
    counted = df.where(F.col(truth).isNotNull() & F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    ranged = counted.withColumn("part", slices(counted, "s"))
    totals = ranged.groupBy("part").agg(F.sum("neg").alias("all"))
    before = totals.select("part", (F.sum("all").over(Window.orderBy("part")) - F.col("all")).alias("base"))  # one row a range
    below = F.sum("neg").over(Window.partitionBy("part").orderBy("s")) - F.col("neg") + F.col("base")
    won = ranged.join(F.broadcast(before), "part").withColumn("won", F.col("pos") * (below + F.col("neg") / 2))
    return won.agg(F.try_divide(F.sum("won"), F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))
