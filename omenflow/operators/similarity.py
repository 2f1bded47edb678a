"""Likeness of vectors and token sets, and what retrieval makes of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import tokens


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector is zero."""
    return F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double"))), F.lit(0.0), lambda s, x: s + x)


def dice(a: Column, b: Column) -> Column:
    """Of the sets of lower-cased tokens of two texts; 0 where both are empty."""
    x, y = F.array_distinct(tokens(F.lower(a))), F.array_distinct(tokens(F.lower(b)))
    return F.coalesce(F.try_divide(2.0 * F.size(F.array_intersect(x, y)), F.size(x) + F.size(y)), F.lit(0.0))


def shared_tokens(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_intersect(tokens(F.lower(a)), tokens(F.lower(b))))


def pearson(a: Column, b: Column) -> Column:
    """Correlation over the places of two vectors; null where one is constant."""
    n = F.size(a).cast("double")
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double"))
    top = n * dot(a, b) - total(a) * total(b)
    return F.try_divide(top, F.sqrt(n * dot(a, a) - total(a) * total(a)) * F.sqrt(n * dot(b, b) - total(b) * total(b)))


def mean_ranks(v: Column) -> Column:
    """Ranks from 1; equals have the mean of theirs."""
    below = lambda x: F.size(F.filter(v, lambda y: y < x))
    same = lambda x: F.size(F.filter(v, lambda y: y == x))
    return F.transform(v, lambda x: below(x) + (same(x) + 1) / 2.0)


def spearman(a: Column, b: Column) -> Column:
    return pearson(mean_ranks(a), mean_ranks(b))


def row_mean(columns: list[str]) -> Column:
    """Of the values that aren't null."""
    held = F.filter(F.array(*[F.col(c).cast("double") for c in columns]), lambda x: x.isNotNull())
    return F.try_divide(F.aggregate(held, F.lit(0.0), lambda s, x: s + x), F.size(held).cast("double"))


def top_by_model(scores: DataFrame, ids: list[str], models: list[str], k: int = 3) -> DataFrame:
    """``ids, model, score, rank``: the ``k`` best rows of each model's column."""
    long = scores.unpivot(ids, models, "model", "score").where("score is not null")
    rank = F.row_number().over(Window.partitionBy("model").orderBy(F.desc("score"), *ids))  # Spark keeps k rows a task first
    return long.withColumn("rank", rank).where(F.col("rank") <= k)


def varied(found: DataFrame, k: int = 5, weight: float = 0.5) -> DataFrame:
    """Maximal marginal relevance: ``query_id, vec_id, rank`` of ``query_id, query, vec_id, embedding`` (a top list each).

    A query's candidates are what a search gave it, so that a group is bounded by that search's ``k``.
    """

    def pick(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        x = np.stack(rows["embedding"].to_numpy()).astype(np.float64)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        q = np.asarray(rows["query"].iloc[0], np.float64)
        near = x @ (q / max(np.linalg.norm(q), 1e-300))
        taken: list[int] = []
        gain = weight * near
        while len(taken) < min(k, len(x)):
            best = int(np.argmax(gain))
            taken.append(best)
            worst = (x @ x[taken].T).max(axis=1)
            gain = weight * near - (1 - weight) * worst
            gain[taken] = -np.inf
        return pd.DataFrame({"query_id": rows["query_id"].iloc[0], "vec_id": rows["vec_id"].to_numpy()[taken], "rank": range(1, len(taken) + 1)})

    return found.groupBy("query_id").applyInPandas(pick, "query_id long, vec_id long, rank int")


def hybrid(lexical: DataFrame, dense: DataFrame, k: int = 10) -> DataFrame:
    """The union of two ranked lists ``query_id, doc_id, score``: each document once, with its larger score, ``k`` a query."""
    both = lexical.unionByName(dense).groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "doc_id"))
    return both.withColumn("rank", rank).where(F.col("rank") <= k)


def prompts(found: DataFrame, question: str, text: str, head: str = "Use only these pieces:") -> DataFrame:
    """``query_id, prompt``: the found pieces by rank as a list, then the question.  A query's pieces are a top list."""
    pieces = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", text))), lambda x: F.concat(F.lit(" - "), x[text])), "\n")
    return found.groupBy("query_id").agg(F.concat(F.lit(head + "\n"), pieces, F.lit("\n"), F.min(question)).alias("prompt"))


def embedded(df: DataFrame, text: str, encode, column: str = "embedding") -> DataFrame:
    """Vectors by the caller's encoder, which takes a list of texts and gives a matrix; Arrow batches, one encoder a task."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(list(np.asarray(encode(part.fillna("").tolist()), np.float32)), index=part.index)

    return df.withColumn(column, run(text))


def stores(df: DataFrame, content: str) -> DataFrame:
    """Documents of a vector store: ``id`` (a digest of the content), ``content`` and a map of all other columns."""
    rest = [x for c in df.columns if c != content for x in (F.lit(c), F.col(c).cast("string"))]
    meta = F.create_map(*rest) if rest else F.create_map().cast("map<string,string>")
    return df.select(F.sha2(F.coalesce(content, F.lit("")), 256).alias("id"), F.col(content).alias("content"), meta.alias("meta"))
