"""Queries on indexes, near names, learned tags and clusters, experiment trees, sidecars and stored models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import agreement, clustering, corpus, frames, learning, lexical, near_names, recurrent, rows, tagging, vector_index
from ..operators.skew import over_cores
from ..sources import pages, readers, writers
from .catalog import JUDGED, RATERS, SQL, TOKENS, judged, load, query
from .corpora import SEARCH


@query(SEARCH + "SELECT query_id, doc_id, round(score, 4) AS score FROM l WHERE r <= 10")
def indexed_search(spark, d):
    """The best documents of every query from a stored index, of which few documents are scored in full."""
    index = lexical.LexicalIndex.build(load(spark, d, "documents"))
    return index.search(load(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), "text")).withColumn("score", F.round("score", 4))


@query(SQL["nearest_vectors"])
def indexed_vectors(spark, d):
    """The exact neighbours of rows whose id is divisible by 50, from a stored index of cells and codes (V6-V8)."""
    v = load(spark, d, "embeddings")
    return vector_index.VectorIndex.build(v).search(v.where("vec_id % 50 = 0"), exact=True).withColumn("cosine", F.round("cosine", 5))


@query()
def probed_vectors(spark, d):
    """The same from the nearest cells only: nine in ten of the exact ones at least, which tests measure."""
    v = load(spark, d, "embeddings")
    return vector_index.VectorIndex.build(v).search(v.where("vec_id % 50 = 0"))


@query("SELECT a.c_name AS name_1, b.c_name AS name_2, levenshtein(a.c_name, b.c_name)::INT AS distance FROM customer a JOIN customer b ON a.c_name < b.c_name AND levenshtein(a.c_name, b.c_name) <= 1")
def near_customers(spark, d):
    """Names of customers that are one edit apart."""
    return near_names.near_names(load(spark, d, "customer"), "c_name", 1)


TYPED = "s_name || CASE s_suppkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'x' WHEN 2 THEN 'xy' ELSE ' ' END"


@query(f"WITH n AS (SELECT DISTINCT replace({TYPED}, '#0000', '') AS n FROM supplier) SELECT a.n AS name_1, b.n AS name_2, levenshtein(a.n, b.n)::INT AS distance FROM n a JOIN n b ON a.n < b.n AND levenshtein(a.n, b.n) <= 2")
def near_suppliers(spark, d):
    """Names of suppliers, some of them mistyped, that are at most two edits apart."""
    end = F.get(F.array(F.lit(""), F.lit("x"), F.lit("xy"), F.lit(" ")), (F.col("s_suppkey") % 4).cast("int"))
    return near_names.near_names(load(spark, d, "supplier").select(F.replace(F.concat("s_name", end), F.lit("#0000"), F.lit("")).alias("n")), "n")


@query()
def complete_clusters(spark, d):
    """Complete-link clusters of vectors over the graph of their nearest neighbours, cut at a cosine of 0.7."""
    v = load(spark, d, "embeddings")
    # Every row is a query here, so that an index would send each to most of its cells: blocks are multiplied, few rows come out.
    rows_ = min(1 << 15, max(1 << 11, -(-v.count() // 8)))
    near = corpus.nearest(v, v, 10, block_rows=rows_, least=0.7 - 1e-6)
    edges = near.select(F.col("query_id").alias("a"), F.col("vec_id").alias("b"), (1 - F.round("cosine", 9)).alias("d"))
    return clustering.cut(clustering.complete_link(edges.where("d <= 0.3")), v.select(F.col("vec_id").alias("node")))


def tagged_sentences(spark, d):
    """``doc_id, words, tags``: sentences of documents, each word tagged with the document's language."""
    docs = over_cores(load(spark, d, "documents").where("lang is not null").select("doc_id", "lang", "text"), "doc_id")
    cut = docs.select("doc_id", "lang", F.explode(tx.sentences(F.col("text"))).alias("s"))
    words = cut.select("doc_id", tx.tokens(F.col("s")).alias("words"), "lang")
    return words.select("doc_id", "words", F.transform("words", lambda w: F.col("lang")).alias("tags"))


@query()
def learned_tags(spark, d):
    """Tags of held-out documents' words by a tagger that learned from the other documents (L1, L7): right ones and all by tag."""
    all_ = tagged_sentences(spark, d)
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tagger = tagging.Tagger.fit(all_.where(~held), epochs=2)
    told = tagger.tag(all_.where(held).select(F.col("tags").alias("gold"), "words"))
    each = told.select(F.inline(F.arrays_zip(F.col("gold").alias("gold"), F.col("tags").alias("tag"))))
    return each.groupBy("gold", "tag").agg(F.count("*").alias("n"))


@query(f"""WITH w AS (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i FROM (SELECT doc_id, {TOKENS.format("coalesce(text, '')")} AS t FROM documents)),
c AS (SELECT doc_id, i, t[i] AS w, regexp_matches(t[i], '^[A-Z]') AS cap FROM w), g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM c WHERE cap)
SELECT doc_id, 'name' AS label, (min(i) - 1)::INT AS "begin", max(i)::INT AS "end", string_agg(w, ' ' ORDER BY i) AS term FROM g GROUP BY doc_id, run""")
def tag_spans(spark, d):
    """Entities of B-, I- and O tags: here runs of words with a capital (L2, S3)."""
    t = load(spark, d, "documents").select("doc_id", tx.tokens(F.col("text")).alias("words"))
    capital = lambda w: F.coalesce(w.rlike("^[A-Z]"), F.lit(False))
    tags = F.transform("words", lambda w, i: F.when(~capital(w), "O").when((i > 0) & capital(F.get("words", i - 1)), "I-name").otherwise("B-name"))
    return tagging.spans(t.select("doc_id", "words", tags.alias("tags")), "doc_id")


@query()
def recurrent_labels(spark, d):
    """Qualities of held-out documents by a recurrent network that learned from the others (C19): pairs of both, counted."""
    known = load(spark, d, "labels").select("doc_id", "quality").join(over_cores(load(spark, d, "documents").select("doc_id", "text"), "doc_id"), "doc_id")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    model = recurrent.RecurrentClassifier.fit(known.where(~held), "text", "quality", epochs=3)
    return model.predict(known.where(held), "text").groupBy("quality", "predicted").agg(F.count("*").alias("n"))


@query(JUDGED + """, p AS (UNPIVOT (SELECT doc_id % 3 AS seed, quality AS y, long_text, even_id, clean FROM j) ON long_text, even_id, clean INTO NAME model VALUE h),
a AS (SELECT seed, model, round(avg((y = h)::INT), 6) AS accuracy FROM p GROUP BY ALL) SELECT model, round(avg(accuracy), 4) AS mean, round(stddev_samp(accuracy), 4) AS std, count(*) AS n FROM a GROUP BY model""")
def experiment_tree(spark, d):
    """Results of runs by seed, some of them run twice, written as a tree of files and read as one table."""
    folder = f"{writers.scratch(spark)}/2024-08-21-runs"
    each = judged(spark, d).select((F.col("doc_id") % 3).alias("seed"), F.col("quality").alias("y"), *RATERS[1:]).unpivot(["seed", "y"], RATERS[1:], "model", "h")
    found = each.groupBy("seed", "model").agg(F.round(F.avg((F.col("y") == F.col("h")).cast("int")), 6).alias("accuracy"))
    for seed in range(3):
        one = found.where(F.col("seed") == seed).drop("seed").coalesce(1)
        for version in ("", "_v2") if seed == 1 else ("",):
            # The first run of seed 1 went wrong; the last one counts.
            said = one if version or seed != 1 else one.withColumn("accuracy", F.lit(0.0))
            said.write.option("header", True).csv(f"{folder}/seed{seed}{version}/metrics_summary.csv")
    read = pages.experiments(spark, folder)
    return read.groupBy("model").agg(F.round(F.avg("accuracy"), 4).alias("mean"), F.round(F.stddev_samp("accuracy"), 4).alias("std"), F.count("*").alias("n"))


@query("SELECT count(*)::VARCHAR AS documents, count(DISTINCT lang)::VARCHAR AS languages, sum(n_chars)::VARCHAR AS letters, min(doc_id)::VARCHAR AS first FROM documents")
def run_sidecar(spark, d):
    """A run's counts kept beside its results, written once and read again."""
    folder = writers.scratch(spark)
    told = load(spark, d, "documents").agg(F.count("*"), F.count_distinct("lang"), F.sum("n_chars"), F.min("doc_id")).first()
    writers.sidecar(spark, folder, **dict(zip(("documents", "languages", "letters", "first"), told, strict=True)))
    writers.sidecar(spark, folder, documents=-1, languages=-1, letters=-1, first=-1)  # the first one stays
    return spark.read.schema("documents STRING, languages STRING, letters STRING, first STRING").json(folder)


@query("SELECT s_suppkey, s_name FROM supplier WHERE NOT contains(s_suppkey || s_name, '7')")
def lines_read_back(spark, d):
    """Rows written as lines of a log and read back without those that have a word (K7, K8)."""
    path = writers.scratch(spark)
    lines = load(spark, d, "supplier").select(F.concat_ws(" , ", F.col("s_suppkey").cast("string"), "s_name").alias("value"))
    lines.write.text(path)
    fields = writers.from_log_lines(readers.plain_lines(spark, path), ["7"])
    return fields.select(F.get("fields", F.lit(0)).cast("long").alias("s_suppkey"), F.get("fields", F.lit(1)).alias("s_name"))


@query()
def stored_models(spark, d):
    """Models written, found in their folder and used again."""
    rows_ = learning.features(load(spark, d, "embeddings").withColumn("y", (F.col("label") % 2).cast("int")), "embedding", "y")
    folder = writers.scratch(spark)
    learning.save_all(learning.train_all(rows_, ["ridge", "perceptron"]), folder)
    return agreement.binary_metrics(agreement.confusion(learning.predict_all(rows_, learning.load_all(folder), ["vec_id", "y"]), "y", ["ridge", "perceptron"]))


@query("WITH r AS (SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) - 1 AS pos FROM events) SELECT event_id, pos::BIGINT AS pos FROM r WHERE pos >= 100 AND pos < 134")
def slice_of_events(spark, d):
    """Rows by their places in the order of time, written as a file of their own and read again."""
    e = load(spark, d, "events").select("event_id", F.struct("ts", "event_id").alias("at"))
    path = writers.versioned(frames.sliced(e, "at", 100, 134).select("event_id", "pos"), writers.scratch(spark), "slice", "parquet", 1)
    return spark.read.parquet(path)


@query("SELECT c_custkey, c_nationkey, count(*) OVER (PARTITION BY CASE WHEN c_nationkey % 5 <> 0 THEN c_nationkey END) AS n FROM customer")
def sizes_with_null_groups(spark, d):
    """Sizes of groups of which one has no key."""
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey", F.when(F.col("c_nationkey") % 5 != 0, F.col("c_nationkey")).alias("g"))
    return frames.with_group_size(c, "g", "n").select("c_custkey", "c_nationkey", "n")


@query("WITH g AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 > 0 THEN o_orderstatus END AS s, md5('42:' || o_orderkey::VARCHAR) AS k FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY k, o_orderkey) AS i, count(*) OVER (PARTITION BY s) AS n FROM g) SELECT o_orderkey, CASE WHEN i <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS part FROM r")
def split_with_null_labels(spark, d):
    """A stratified split in which rows without a label are a stratum."""
    o = load(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).alias("s"))
    return rows.split(o, "o_orderkey", "s").select("o_orderkey", "part")
