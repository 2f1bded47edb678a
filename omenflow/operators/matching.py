"""Pairs of rows and what is made of them: products with a bounded side, matches, retrieval, certification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.writers import forgotten, written
from . import corpus, similarity
from .skew import over_cores, with_values

#: Of pairs by a key: rows of a bundle of the left side (fewer where the input is small) and of the right one, and pairs of a task, about.
LEFT, RIGHT, PAIRS = 1 << 16, 1 << 9, 1 << 25


def product(few: DataFrame, many: DataFrame, most: int = 10_000) -> DataFrame:
    """Each row of a bounded table with each row of another.

    The first table, a stated set of queries, is counted; more than ``most`` rows are an error, so that what every task
    is sent has a bound.  Larger sides need a key to join on (``sharing``).
    """
    n = few.limit(most + 1).count()
    if n > most:
        raise ValueError(f"over {most} rows on the bounded side of a product")
    kept = F.array_sort(F.collect_list(F.struct(*few.columns)))
    held = few.agg(kept.alias("_few")).withColumn("_one", F.lit(1))
    dealt = many.withColumn("_one", F.lit(1)).join(F.broadcast(held), "_one").withColumn("_f", F.explode("_few"))
    return dealt.select("_f.*", *many.columns)


def sharing(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Pairs of rows with equal keys: all of them, as many as the product of a key's rows; null keys are equal to none.

    Both sides are dealt to bundles by key and each two bundles of a key meet in a task, so that a hot key is dealt over all tasks
    and a task buffers one bundle of the right side.  Each row of a bundle meets the same few rows in the same order, so that
    what is written of the pairs repeats itself and is small.
    """
    cores = left.sparkSession.sparkContext.defaultParallelism
    key = F.struct(*keys).alias("_key")
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    a, b = (df.where(known).select(key, *(c for c in df.columns if c not in keys), F.monotonically_increasing_id().alias("_id")) for df in (left, right))
    met = written(a.groupBy("_key").agg(F.count("*").alias("_a")).join(b.groupBy("_key").agg(F.count("*").alias("_b")), "_key"))
    total = met.agg(F.sum("_a").alias("rows"), F.sum(F.col("_a").cast("double") * F.col("_b")).alias("pairs")).first()
    size = min(LEFT, max(1, (total.rows or 0) // (4 * cores)))
    parts = int(max(cores, (total.pairs or 0) // PAIRS))
    bundles = lambda n, most: F.ceil(F.col(n) / most).cast("int")
    met = met.select("_key", "_a", "_b", bundles("_a", size).alias("_is"), bundles("_b", RIGHT).alias("_js"))

    def dealt(df: DataFrame, rows: str, own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        # Ids are hashed, as keys may recur at regular distances.
        one = with_values(df, met.select("_key", rows, "_is", "_js"), "_key", rows).withColumn(own[0], F.pmod(F.xxhash64("_id"), F.col(own[1])).cast("int"))
        each = one.withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other[1]) - 1)))
        return each.repartition(parts, "_key", "_i", "_j").select("_key", "_i", "_j", *(c for c in df.columns if c not in ("_key", "_id")))

    i, j = ("_i", "_is"), ("_j", "_js")
    return dealt(a, "_a", i, j).hint("merge").join(dealt(b, "_b", j, i), ["_key", "_i", "_j"]).drop("_i", "_j").select("_key.*", "*").drop("_key")


def looked_up(df: DataFrame, table: DataFrame, keys: list[str], value: str, default) -> DataFrame:
    """Adds a table's value by keys, or the default."""
    return df.join(table.select(*keys, value), keys, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def with_observations(pairs: DataFrame, key: str, rank: str, content: str) -> DataFrame:
    """``key, matches``: what was found for each key as a list by rank (a search's top list)."""
    return pairs.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(rank, content))), lambda x: x[content]).alias("matches"))


def packed(df: DataFrame, content: str, kind: str = "meta") -> DataFrame:
    """``text`` and all other columns in one struct."""
    return df.select(F.col(content).alias("text"), F.struct(*(c for c in df.columns if c != content)).alias(kind))


def comparison(a: dict[str, Column], b: dict[str, Column], measures: dict[str, object]) -> Column:
    """The mean of several measures of likeness of two rows' fields; a measure that is null is left out."""
    parts = F.filter(F.array(*(m(a[n], b[n]).cast("double") for n, m in measures.items())), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(parts, F.lit(0.0), lambda s, x: s + x), F.size(parts).cast("double"))


def certified(pairs: DataFrame, judge) -> DataFrame:
    """Pairs that a judge (a column of 0 and 1 from ``pairs``) accepts, with its label."""
    return pairs.withColumn("label", judge).where("label = 1")


class Store:
    """Documents with vectors, and the searches over them."""

    #: Names of the searches.
    SEARCHES = ("similarity", "threshold", "varied")

    def __init__(self, vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding"):
        self.vectors = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector).alias("embedding"))

    def write(self, folder: str, mode: str = "append") -> None:
        self.vectors.write.mode(mode).parquet(folder)

    @classmethod
    def read(cls, spark, folder: str) -> Store:
        return cls(spark.read.parquet(folder))

    def query(self, queries: DataFrame, search: str = "similarity", k: int = 5, least: float = 0.0) -> DataFrame:
        """``query_id, vec_id, rank, search_type`` of ``vec_id, embedding`` queries; an unknown search is an error.

        ``similarity``: the ``k`` nearest; ``threshold``: those of them with a cosine of at least ``least``; ``varied``:
        the same in an order that also counts what they have in common.
        """
        if search == "all":
            return reduce(DataFrame.unionByName, (self.query(queries, s, k, least) for s in self.SEARCHES))
        if search not in self.SEARCHES:
            raise ValueError(f"unknown search {search!r}; known: all, {', '.join(self.SEARCHES)}")
        found = corpus.nearest(self.vectors, queries, k)
        if search == "threshold":
            found = found.where(F.col("cosine") >= least)
        if search == "varied":
            q = queries.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
            found = similarity.varied(found.select("query_id", "vec_id").join(self.vectors, "vec_id").join(q, "query_id"), k)
        return found.select("query_id", "vec_id", F.col("rank").cast("int").alias("rank"), F.lit(search).alias("search_type"))


def reranked(found: DataFrame, score: Column, k: int) -> DataFrame:
    """A query's found rows in a new order, by another score; the first ``k``."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "doc_id"))
    return found.withColumn("score", score).withColumn("rank", rank).where(F.col("rank") <= k)


def mean_of_words(docs: DataFrame, id_col: str, words: Column, table: DataFrame, width: int, stop: tuple[str, ...] = ()) -> DataFrame:
    """``id, vector``: the mean of the vectors (``word, vector``) of a text's words; zeros where none has one.

    Sums are made by place, so that a long text is no single list of vectors.
    """
    counted = corpus.word_counts(over_cores(docs, id_col), id_col, words).select(id_col, F.col("term").alias("word"), F.col("tf").alias("n"))
    counted = counted.where(~F.col("word").isin(*stop)) if stop else counted
    known = counted.groupBy("word").agg(F.count("*").alias("_rows")).join(table, "word")
    sums = [F.sum(F.col("n") * F.get(F.col("vector"), F.lit(i)).cast("double")) / F.sum("n") for i in range(width)]
    means = with_values(counted, known, "word", "_rows").groupBy(id_col).agg(F.array(*sums).alias("vector"))
    return docs.select(id_col).distinct().join(means, id_col, "left").withColumn("vector", F.coalesce("vector", F.array(*[F.lit(0.0)] * width)))


def linked_groups(pairs: DataFrame, nodes: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, cluster``: single-link clusters, the connected components of ``a, b``; the cluster is its least node.

    Labels spread by the least neighbour and, doubling their reach, by the label's own label.  Each round is written to
    the folder that driver and executors share; a hub's edges and a large component's nodes are dealt over salts.
    """
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = written(both)
    degree = both.groupBy("b").agg(F.count("*").alias("_rows"))
    labels = written(nodes.select("node").distinct().withColumn("cluster", F.col("node")))
    for _ in range(rounds):
        reached = degree.join(labels.select(F.col("node").alias("b"), F.col("cluster").alias("c")), "b")
        near = with_values(both, reached, "b", "_rows").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        step = written(labels.join(near, "node", "left").select("node", "cluster", F.least("cluster", F.coalesce("c", "cluster")).alias("new")))
        members = step.groupBy("new").agg(F.count("*").alias("_rows"))
        last, jump = labels, members.join(labels.select(F.col("node").alias("new"), F.col("cluster").alias("further")), "new")
        near_labels = step
        step = written(with_values(step, jump, "new", "_rows").select("node", "cluster", F.least("new", "further").alias("new")))
        forgotten(near_labels)
        forgotten(last)
        labels = step.select("node", F.col("new").alias("cluster"))
        if step.where("new <> cluster").isEmpty():
            return labels
    raise RuntimeError(f"labels still change after {rounds} rounds")
