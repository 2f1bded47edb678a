"""Features and retrieval over tokens: frequencies, bigrams, TF-IDF, BM25, chunks, nearest vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import tokens
from .skew import over_cores, with_values


#: Cosines of two blocks that are held at once.
STRIP = 1 << 22
#: Terms of queries that are sent to all tasks at most; more are joined on a key.
SENT = 200_000


def _repeats(docs: DataFrame, id_col: str) -> bool:
    return not docs.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def word_counts(docs: DataFrame, id_col: str, words: Column) -> DataFrame:
    """``id, size, term, tf``: a row for each distinct word of a row's ``words``; ``size`` is how many it has.

    A row's words are sorted and counted inside the row, so that nothing is moved.  Only where an id repeats are its rows'
    counts summed by id, size and term.
    """
    if _repeats(docs, id_col):
        each = docs.select(id_col, words.alias("_w")).select(id_col, F.size("_w").alias("size"), F.explode("_w").alias("term"))
        return each.groupBy(id_col, "size", "term").agg(F.count("*").alias("tf"))
    rows = docs.select(id_col, F.sort_array(words).alias("_w"))
    edge = lambda i: (i == 0) | (i == F.size("_w")) | ~F.get("_w", i).eqNullSafe(F.get("_w", i - 1))
    rows = rows.select(id_col, "_w", F.filter(F.sequence(F.lit(0), F.size("_w")), edge).alias("_e"))
    runs = F.zip_with("_e", F.slice("_e", 2, F.greatest(F.size("_e") - 1, F.lit(1))), lambda a, b: F.struct(F.get("_w", a).alias("term"), (b - a).cast("long").alias("tf")))
    return rows.select(id_col, F.size("_w").alias("size"), F.inline(F.filter(runs, lambda x: x["tf"].isNotNull())))


def _sized_counts(docs: DataFrame) -> DataFrame:
    return word_counts(over_cores(docs.select("doc_id", "text"), "doc_id"), "doc_id", tokens(F.lower("text")))


def term_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, term, tf`` of lower-cased white-space tokens."""
    docs = over_cores(docs.select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", F.explode(tokens(F.lower("text"))).alias("term")).groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def bigrams(docs: DataFrame) -> DataFrame:
    """``first, second, n, p``: pairs of neighbouring tokens and the share among pairs with the same first token.

    How many pairs a token begins is counted from the tokens, so that the pairs are counted once.
    """
    t = tokens(F.lower("text"))
    rest = F.greatest(F.size("t") - 1, F.lit(0))
    rows = over_cores(docs.select("text"), "text").select(t.alias("t"))
    pairs = rows.select(F.inline(F.arrays_zip(F.slice("t", 1, rest).alias("first"), F.slice("t", 2, rest).alias("second"))))
    counted = pairs.groupBy("first", "second").agg(F.count("*").alias("n"))
    total = rows.select(F.explode(F.slice("t", 1, rest)).alias("first")).groupBy("first").agg(F.count("*").alias("all"))
    return with_values(counted, total.withColumn("_rows", F.col("all")), "first", "_rows").select("first", "second", "n", (F.col("n") / F.col("all")).alias("p"))


def tfidf(docs: DataFrame, max_features: int) -> DataFrame:
    """Rows of ``doc_id, term, weight``: idf = ln((1 + n) / (1 + df)) + 1 over the most frequent terms, rows of length 1.

    Of the counts only those of the kept terms are moved, once.
    """
    tf = term_counts(docs) if _repeats(docs, "doc_id") else _sized_counts(docs).drop("size")
    vocabulary = tf.groupBy("term").agg(F.sum("tf").alias("all"), F.count("*").alias("df")).orderBy(F.desc("all"), "term").limit(max_features)
    n = docs.agg(F.count("*").alias("docs"))  # one row
    idf = vocabulary.join(n).select("term", (F.log((1 + F.col("docs")) / (1 + F.col("df"))) + 1).alias("idf"))
    raw = tf.join(F.broadcast(idf), "term").select("doc_id", "term", (F.col("tf") * F.col("idf")).alias("w"))  # max_features rows
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return raw.withColumn("len", length).select("doc_id", "term", (F.col("w") / F.col("len")).alias("weight"))


def _idf(docs: DataFrame, epsilon: float, asked: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """``term, idf`` and one row of ``n, avg_size``; a negative idf becomes a share of the mean idf of all terms.

    Only document frequencies are counted, each term once a document, and summed before they are moved.  The mean is over
    all terms, but only those ``asked`` for are given, if any are named.
    """
    t = over_cores(docs.select("doc_id", "text"), "doc_id").select(tokens(F.lower("text")).alias("t"))
    stats = t.agg(F.count("*").alias("n"), F.avg(F.size("t")).alias("avg_size"))  # one row
    df = t.select(F.explode(F.array_distinct("t")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    raw = df.select("term", (F.log(stats.select("n").scalar() - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)).alias("raw"))
    mean = raw.agg(F.avg("raw")).scalar()
    wanted = raw if asked is None else raw.join(asked.select("term").distinct(), "term", "left_semi")
    return wanted.select("term", F.when(F.col("raw") < 0, epsilon * mean).otherwise(F.col("raw")).alias("idf")), stats


def bm25(docs: DataFrame, query: list[str], k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25) -> DataFrame:
    """``doc_id, score`` of documents with a query term.  Frequencies of the query's terms only are counted, in each document's own row."""
    idf, stats = _idf(docs, epsilon)
    wanted = idf.where(F.col("term").isin(query))  # a row for each term of the query
    rows = over_cores(docs.select("doc_id", "text"), "doc_id").select("doc_id", tokens(F.lower("text")).alias("t"))
    rows = rows.select("doc_id", F.size("t").alias("size"), F.filter("t", lambda x: x.isin(*query)).alias("t")).where(F.size("t") > 0)
    each = F.transform(F.array_distinct("t"), lambda w: F.struct(w.alias("term"), F.size(F.filter("t", lambda x: x == w)).alias("tf")))
    met = rows.select("doc_id", "size", F.inline(each)).join(F.broadcast(wanted), "term")
    part = F.col("idf") * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("size") / stats.select("avg_size").scalar()))
    return met.groupBy("doc_id").agg(F.sum(part).alias("score"))


def bm25_search(docs: DataFrame, queries: DataFrame, k: int = 10, k1: float = 1.5, b: float = 0.75, epsilon: float = 0.25) -> DataFrame:
    """``query_id, doc_id, score``: the ``k`` best documents of each query (``query_id, text``); a repeated query term counts again.

    All documents are read and those with a query's term scored: for one set of queries.  For more, ``lexical.LexicalIndex``
    reads texts once.  The asked terms with their idf are joined first, so that of the vocabulary no more is moved.  Scores
    that agree to nine decimals are equal, as sums depend on their order; of equals the smallest ids come first.
    """
    asked = queries.select("query_id", F.explode(tokens(F.lower("text"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("qn"))
    idf, stats = _idf(docs, epsilon, asked)
    weights = asked.join(idf, "term").select("query_id", "term", (F.col("qn") * F.col("idf")).alias("w"))
    # Weights and terms of a stated set of queries are sent; a document's scores are then summed where its counts are.
    few = asked.limit(SENT + 1).count() <= SENT
    sent = F.broadcast if few else (lambda x: x)
    tf = _sized_counts(docs).join(sent(asked.select("term").distinct()), "term", "left_semi")
    impact = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("size") / stats.select("avg_size").scalar()))
    impacts = tf.select("doc_id", "term", impact.alias("impact"))
    if few:
        impacts = impacts.repartition("doc_id")
    scores = impacts.join(sent(weights), "term").groupBy("query_id", "doc_id").agg(F.sum(F.col("w") * F.col("impact")).alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), "doc_id"))
    return scores.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def smoothed_idf(docs: DataFrame) -> DataFrame:
    """``doc_id, term, score``: tf (share of the document's tokens) times ln(documents / (occurrences in all + 1)).

    A document's words are counted inside its row; the totals of the commonest terms are joined over salts.
    """
    tf = _sized_counts(docs)
    all_ = tf.groupBy("term").agg(F.sum("tf").alias("all"), F.count("*").alias("_rows"))
    n = docs.agg(F.count("*")).scalar()
    return with_values(tf, all_, "term", "_rows").select("doc_id", "term", (F.col("tf") / F.col("size") * F.log(n / (F.col("all") + 1))).alias("score"))


def keyword_score(docs: DataFrame, query: list[str], weights: dict[str, float], absent: float = 1e6) -> DataFrame:
    """``doc_id, score``: over the query's tokens, repeats too, tf times idf times weight.

    A token's idf is 0 in a document that has it and ln(``absent``) otherwise, less its weight (1 where none is given).
    """
    t = docs.select("doc_id", tokens(F.lower("text")).alias("t"))
    count = lambda w: F.size(F.filter("t", lambda x: x == w))
    parts = []
    for w in query:
        n = count(w)
        weight = float(weights.get(w, 1.0))
        parts.append(F.coalesce(F.try_divide(n, F.size("t")), F.lit(0.0)) * (F.when(n > 0, 0.0).otherwise(F.log(F.lit(absent))) - weight) * weight)
    return t.select("doc_id", sum(parts, F.lit(0.0)).alias("score"))


def chunks(docs: DataFrame, size: int = 512, overlap: int = 32) -> DataFrame:
    """``doc_id, chunk, words, text``: overlapping windows of words."""
    t = docs.select("doc_id", tokens("text").alias("t"))
    at = t.select("doc_id", "t", F.explode(F.sequence(F.lit(0), F.greatest(F.size("t") - 1, F.lit(0)), F.lit(size - overlap))).alias("at"))
    piece = F.slice("t", F.col("at") + 1, F.lit(size))
    return at.select("doc_id", (F.col("at") / (size - overlap)).cast("int").alias("chunk"), F.size(piece).alias("words"), F.array_join(piece, " ").alias("text")).where("words > 0")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, blocks: int | None = None, block_rows: int = 2048, least: float = -1.5) -> DataFrame:
    """``query_id, vec_id, cosine, rank``: the ``k`` most similar vectors of each query, itself left out; of equals the smallest ids.

    Rows whose vector is null or has null or non-finite components take no part; ids are of any type that sorts, and not null.

    Queries and vectors are dealt over blocks of about ``block_rows`` rows (``blocks`` sets their number instead); each pair
    of blocks is one task's matrix product, which keeps ``k`` rows a query, so that groups don't grow with the input and
    what is ranked at the end is bounded by queries times blocks times ``k``.  Only rows with a cosine of ``least`` or more are told.
    """
    whole = F.coalesce((F.size("embedding") > 0) & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf"))) & F.col("vec_id").isNotNull(), F.lit(False))
    vectors, queries = vectors.where(whole), queries.where(whole)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    n_q, n_v = (blocks or max(1, -(-x.count() // block_rows)) for x in (queries, vectors))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    q = queries.select(F.col("vec_id").alias("id"), "embedding", F.lit(1).alias("role"), part("vec_id", n_q).alias("qb"), every(n_v).alias("vb"))
    v = vectors.select(F.col("vec_id").alias("id"), "embedding", F.lit(0).alias("role"), every(n_q).alias("qb"), part("vec_id", n_v).alias("vb"))

    def product(t: pa.Table) -> pa.Table:
        t = t.sort_by("id")
        role = t["role"].to_numpy()
        ids = np.array(t["id"].to_pylist(), None if pa.types.is_integer(t["id"].type) else object)
        whole = t["embedding"].combine_chunks()
        x = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1 if len(whole) else 0)
        x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
        a, b = x[role == 1], x[role == 0]
        qi, vi = ids[role == 1], ids[role == 0]
        out: list[list] = [[], [], []]
        if len(a) and len(b):
            strip = max(1, STRIP // len(b))
            for s in range(0, len(a), strip):
                sims = a[s : s + strip] @ b.T
                sims[qi[s : s + strip, None] == vi[None, :]] = -2.0
                for i in np.flatnonzero(sims.max(axis=1) >= least - 1e-9):
                    row = sims[i]
                    floor = np.partition(row, -k)[-k] if len(row) > k else -2.0
                    near = np.flatnonzero((row >= max(floor, least) - 1e-9) & (row > -1.5))
                    # A matrix product may differ in last bits between equal vectors; these sums don't.
                    exact = (b[near] * a[s + i]).sum(axis=1)
                    top = np.argsort(-exact, kind="stable")[:k]
                    top = top[exact[top] >= least]
                    out[0] += [qi[s + i]] * len(top)
                    out[1] += vi[near[top]].tolist()
                    out[2] += exact[top].tolist()
        return pa.table([pa.array(out[0], t["id"].type), pa.array(out[1], t["id"].type), pa.array(out[2], pa.float64())], names=["query_id", "vec_id", "cosine"])

    found = q.unionByName(v).groupBy("qb", "vb").applyInArrow(product, f"query_id {kind}, vec_id {kind}, cosine double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)
