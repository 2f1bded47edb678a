"""Queries on shaping: selection, relabelling, pivots, positional joins, orders, summaries, audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import agreement, frames, matching, rows
from .catalog import JUDGED, RATERS, judged, load, query, rounded

PLACED = "(SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)"
LEVELS = {"1-URGENT": 5, "2-HIGH": 4, "3-MEDIUM": 3, "4-NOT SPECIFIED": 2, "5-LOW": 1}
LONG = "(UNPIVOT (SELECT doc_id, lang, quality AS y, long_text, even_id, clean FROM j) ON long_text, even_id, clean INTO NAME model VALUE h)"


def long_labels(spark, d):
    return judged(spark, d).select("doc_id", "lang", F.col("quality").alias("y"), *RATERS[1:]).unpivot(["doc_id", "lang", "y"], RATERS[1:], "model", "h")


def accuracies(spark, d):
    """``lang, model, accuracy``."""
    return long_labels(spark, d).groupBy("lang", "model").agg(F.avg((F.col("y") == F.col("h")).cast("int")).alias("accuracy"))


ACCURACIES = JUDGED + f", m AS (SELECT lang, model, avg((y = h)::INT) AS accuracy FROM {LONG} GROUP BY ALL) "


@query(JUDGED + "SELECT doc_id FROM j WHERE quality = 1 AND lang IS DISTINCT FROM 'de' AND quality <> clean")
def filtered_rows(spark, d):
    """Equality, negation that keeps nulls, one column against another."""
    return frames.all_equal(judged(spark, d), F.col("quality") == 1, ~F.col("lang").eqNullSafe("de"), F.expr("quality <> clean")).select("doc_id")


@query("SELECT d.doc_id, (quality IS NULL)::INT AS unlabelled, coalesce(quality, -1)::INT AS quality, coalesce(lang, 'dummy') AS lang FROM documents d LEFT JOIN labels USING (doc_id) WHERE text IS NOT NULL AND source IS NOT NULL")
def filled_nulls(spark, d):
    """Null masks, dropped and filled nulls."""
    df = load(spark, d, "documents").join(load(spark, d, "labels"), "doc_id", "left").na.drop(subset=["text", "source"])
    return df.select("doc_id", F.col("quality").isNull().cast("int").alias("unlabelled"), "quality", "lang").na.fill({"quality": -1, "lang": "dummy"})


@query("SELECT n_nationkey AS id, n_name AS base_sentence, 0 AS author_type, 'made' AS dataset, (SELECT count(*) FROM nation) AS n_sentences FROM nation")
def constant_columns(spark, d):
    """Selected and renamed columns, constants and the number of rows."""
    n = load(spark, d, "nation")
    out = n.select("n_nationkey", "n_name").withColumnsRenamed({"n_nationkey": "id", "n_name": "base_sentence"})
    return out.withColumns({"author_type": F.lit(0), "dataset": F.lit("made"), "n_sentences": n.agg(F.count("*")).scalar()})


@query("SELECT doc_id, doc_id % 2 AS author_type FROM documents WHERE doc_id % 2 = 1")
def author_dataset(spark, d):
    """One of the datasets by author."""
    return frames.author_dataset(load(spark, d, "documents").select("doc_id", (F.col("doc_id") % 2).alias("author_type")), "synthetic")


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders")
def pruned_columns(spark, d):
    """Columns dropped by name and by pattern."""
    return frames.without_columns(load(spark, d, "orders"), "o_custkey", "absent", pattern="status$|priority$")


@query(f"SELECT o_orderkey, pos FROM {PLACED} WHERE pos >= 100 AND pos < 134")
def positional_slice(spark, d):
    """Rows by position in a named order."""
    return frames.sliced(load(spark, d, "orders"), "o_orderkey", 100, 134).select("o_orderkey", "pos")


@query("SELECT o_orderkey FROM orders ORDER BY o_orderkey DESC LIMIT 34")
def last_orders(spark, d):
    """The last rows of an order."""
    return frames.last_rows(load(spark, d, "orders"), "o_orderkey", 34).select("o_orderkey")


@query("SELECT o_orderkey, (o_orderstatus IS NOT DISTINCT FROM 'F')::INT AS binary_label FROM orders")
def binary_labels(spark, d):
    """A text label as 1 or 0."""
    return frames.as_binary(load(spark, d, "orders"), "o_orderstatus", "F", "binary_label").select("o_orderkey", "binary_label")


@query("SELECT doc_id, (lang IS NOT NULL)::INT AS lang, (quality IS NOT NULL)::INT AS quality, (toxic IS NOT NULL)::INT AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def presence_matrix(spark, d):
    """Every cell as 1 or 0."""
    df = load(spark, d, "documents").select("doc_id", "lang").join(load(spark, d, "labels"), "doc_id", "left")
    return frames.presence(df, ["doc_id"])


@query("WITH a AS (SELECT r_name, row_number() OVER (ORDER BY r_regionkey) - 1 AS pos FROM region), b AS (SELECT n_name, row_number() OVER (ORDER BY n_nationkey) - 1 AS pos FROM nation WHERE n_nationkey < 5) SELECT pos, r_name, n_name FROM a JOIN b USING (pos)")
def prefixed_columns(spark, d):
    """Leading columns put before others of the same length."""
    n = load(spark, d, "nation").where("n_nationkey < 5").select("n_nationkey", "n_name")
    return frames.beside(load(spark, d, "region"), "r_regionkey", n, "n_nationkey").select("pos", "r_name", "n_name")


@query("SELECT lang, round(coalesce(avg(n_chars) FILTER (quality = 0), 0), 4) AS q0, round(coalesce(avg(n_chars) FILTER (quality = 1), 0), 4) AS q1 FROM documents JOIN labels USING (doc_id) GROUP BY lang")
def pivot_mean(spark, d):
    """A pivot by means."""
    out = frames.matrix(judged(spark, d), "lang", "quality", "n_chars", [0, 1], F.avg)
    return out.select("lang", F.round("0", 4).alias("q0"), F.round("1", 4).alias("q1"))


@query(JUDGED + f"SELECT model, lang, coalesce(sum((y = 0 AND h = 1)::INT), 0)::BIGINT AS false_positives, coalesce(sum((y = 1 AND h = 0)::INT), 0)::BIGINT AS false_negatives FROM {LONG} GROUP BY ALL")
def error_pivot(spark, d):
    """Errors by model and group, one column for each true label."""
    wrong = long_labels(spark, d).withColumn("n", (F.col("y") != F.col("h")).cast("int"))
    out = wrong.groupBy("model", "lang").pivot("y", [0, 1]).agg(F.sum("n")).na.fill(0)
    return out.withColumnsRenamed({"0": "false_positives", "1": "false_negatives"})


@query("SELECT doc_id, rater, value FROM (UNPIVOT (SELECT d.doc_id, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id)) ON quality, toxic INTO NAME rater VALUE value)")
def stacked_ratings(spark, d):
    """Wide to long without nulls."""
    return frames.stacked(load(spark, d, "documents").select("doc_id").join(load(spark, d, "labels"), "doc_id", "left"), "doc_id", ["quality", "toxic"])


@query("SELECT doc_id, max(value) FILTER (rater = 'quality') AS quality, max(value) FILTER (rater = 'toxic') AS toxic FROM (UNPIVOT labels ON quality, toxic INTO NAME rater VALUE value) GROUP BY doc_id")
def unstacked_ratings(spark, d):
    """Long to wide by rater (P25)."""
    long = frames.stacked(load(spark, d, "labels"), "doc_id", ["quality", "toxic"])
    return frames.unstacked(long, "doc_id", "rater", "value", ["quality", "toxic"])


@query("SELECT source, array_to_string(list_sort(list(DISTINCT lang)), ' ') AS values FROM documents WHERE lang IS NOT NULL GROUP BY source")
def listed_values(spark, d):
    """A column's values as lists."""
    return frames.listed(load(spark, d, "documents").where("lang is not null"), "lang", ["source"]).withColumn("values", F.array_join("values", " "))


@query("SELECT doc_id, toxic, quality, (doc_id % 2)::INT AS y_hat FROM labels")
def reordered_columns(spark, d):
    """A column moved to the place before the last."""
    df = load(spark, d, "labels").select("doc_id", "quality", "toxic", (F.col("doc_id") % 2).cast("int").alias("y_hat"))
    return frames.before_last(df, "quality")


@query("SELECT event_id, (props::JSON ->> '$.k')::INT AS k, NULL::VARCHAR AS kind FROM events UNION ALL SELECT n_nationkey, NULL, n_name FROM nation")
def ragged_rows(spark, d):
    """Records of different fields as rows of one table."""
    a = load(spark, d, "events").select("event_id", F.from_json("props", "map<string,int>")["k"].alias("k"))
    b = load(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("event_id"), F.col("n_name").alias("kind"))
    return a.unionByName(b, allowMissingColumns=True)


@query("SELECT o_orderkey, CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LEVELS.items()) + " END AS level FROM orders")
def ordinal_levels(spark, d):
    """Levels as numbers by a mapping."""
    return load(spark, d, "orders").select("o_orderkey", frames.ordinal(F.col("o_orderpriority"), LEVELS).alias("level"))


@query("SELECT vec_id, embedding[1] AS x, embedding[2] AS y, label FROM embeddings")
def first_dimensions(spark, d):
    """Two dimensions and the label, for drawing."""
    v = F.col("embedding")
    return load(spark, d, "embeddings").select("vec_id", F.get(v, F.lit(0)).alias("x"), F.get(v, F.lit(1)).alias("y"), "label")


@query(f"WITH a AS (SELECT o_orderkey, pos FROM {PLACED}), n AS (SELECT count(*) AS n FROM a), b AS (SELECT quality AS h, row_number() OVER (ORDER BY doc_id) - 1 AS k, count(*) OVER () AS m FROM labels) SELECT o_orderkey, h AS \"Model Prediction\" FROM a, n JOIN b ON true WHERE pos - (n - m) = k")
def labels_beside(spark, d):
    """A model's labels at the last rows of a table."""
    found = load(spark, d, "labels").select("doc_id", F.col("quality").alias("y_hat"))
    return frames.with_labels(load(spark, d, "orders").select("o_orderkey"), "o_orderkey", found, "doc_id", "Model")


@query("SELECT r_name, n_name, (n_regionkey = r_regionkey)::INT AS label FROM region, nation")
def bounded_product(spark, d):
    """Each of a few rows with each of many."""
    pairs = matching.product(load(spark, d, "region"), load(spark, d, "nation"))
    return pairs.select("r_name", "n_name", (F.col("n_regionkey") == F.col("r_regionkey")).cast("int").alias("label"))


@query("SELECT a.r_name AS r_name, b.n_name AS n_name FROM (SELECT * FROM region ORDER BY r_regionkey LIMIT 3) a, (SELECT * FROM nation ORDER BY n_nationkey LIMIT 20) b")
def limited_product(spark, d):
    """The first rows of two tables with each other."""
    return matching.product(load(spark, d, "region").orderBy("r_regionkey").limit(3), load(spark, d, "nation").orderBy("n_nationkey").limit(20)).select("r_name", "n_name")


@query("SELECT a.r_name AS name_1, b.r_name AS name_2, levenshtein(a.r_name, b.r_name)::INT AS distance FROM region a, region b")
def self_product(spark, d):
    """Distances of all pairs of a bounded table's rows, each with itself too."""
    r = load(spark, d, "region")
    pairs = matching.product(r.select(F.col("r_name").alias("name_1")), r.select(F.col("r_name").alias("name_2")))
    return pairs.withColumn("distance", F.levenshtein("name_1", "name_2"))


@query("SELECT e.event_id, coalesce(q.n, 0) AS n FROM events e LEFT JOIN (SELECT c_custkey AS user_id, count(*) AS n FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY ALL) q USING (user_id)")
def looked_up_counts(spark, d):
    """A look-up with a default."""
    n = load(spark, d, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("n"))
    return matching.looked_up(load(spark, d, "events"), n, ["user_id"], "n", 0).select("event_id", "n")


@query("SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey")
def shared_feature(spark, d):
    """All rows of two tables that share a feature."""
    c = load(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    return matching.sharing(c, load(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation")), "nation").drop("nation")


@query("WITH g AS (SELECT lang AS name, avg(n_chars) AS mean_n_chars, stddev_samp(n_chars) AS std_n_chars FROM documents GROUP BY lang), a AS (SELECT * FROM g UNION ALL SELECT 'mean', avg(mean_n_chars), avg(std_n_chars) FROM g UNION ALL SELECT 'std', stddev_samp(mean_n_chars), stddev_samp(std_n_chars) FROM g) SELECT name, round(mean_n_chars, 4) AS mean_n_chars, round(std_n_chars, 4) AS std_n_chars FROM a")
def summary_rows(spark, d):
    """Group means with rows of their mean and deviation (A5)."""
    out = frames.summary_rows(load(spark, d, "documents"), "lang", ["n_chars"])
    return out.select("name", F.round("mean_n_chars", 4).alias("mean_n_chars"), F.round("std_n_chars", 4).alias("std_n_chars"))


@query("SELECT p_partkey, CASE WHEN contains(n, 'imbalanced') THEN 'imbalanced' WHEN contains(n, 'oversampled') THEN 'oversampled' WHEN contains(n, 'undersampled') THEN 'undersampled' ELSE n END AS kind FROM (SELECT p_partkey, 'set_' || ['imbalanced', 'oversampled-imbalanced', 'undersampled', 'plain'][(p_partkey % 4 + 1)::INT] AS n FROM part)")
def dataset_kinds(spark, d):
    """A dataset's kind by its name."""
    names = F.array(*map(F.lit, ("imbalanced", "oversampled-imbalanced", "undersampled", "plain")))
    p = load(spark, d, "part").withColumn("n", F.concat(F.lit("set_"), F.get(names, (F.col("p_partkey") % 4).cast("int"))))
    return p.select("p_partkey", frames.dataset_kind(F.col("n")).alias("kind"))


@query(ACCURACIES + "SELECT model, round(avg(accuracy), 6) AS mean, round(stddev_pop(accuracy), 6) AS std, round(max(accuracy) - min(accuracy), 6) AS margin FROM m GROUP BY model")
def model_margins(spark, d):
    """Each model's mean, deviation and margin over datasets."""
    langs = ["de", "en", "es", "fr"]
    wide = accuracies(spark, d).groupBy("model").pivot("lang", langs).agg(F.first("accuracy"))
    return rounded(frames.margins(wide, "model", langs), "mean", "std", "margin")


@query(ACCURACIES + "SELECT lang, round(avg(accuracy), 6) AS mean, round(stddev_samp(accuracy), 6) AS std, round(min(accuracy), 6) AS min, round(max(accuracy), 6) AS max, round(max(accuracy) - min(accuracy), 6) AS margin, (list(model ORDER BY accuracy DESC, model))[1] AS best, (list(model ORDER BY accuracy, model))[1] AS worst FROM m GROUP BY lang")
def accuracy_extremes(spark, d):
    """Each dataset's accuracies and its best and worst models."""
    return rounded(frames.extremes(accuracies(spark, d), "lang", "model", "accuracy"), "mean", "std", "min", "max", "margin")


@query(JUDGED + "SELECT subject, coalesce(sum((value = 0)::INT), 0)::BIGINT AS zero, coalesce(sum((value = 1)::INT), 0)::BIGINT AS one FROM r GROUP BY subject")
def subject_categories(spark, d):
    """How many raters chose each category."""
    out = frames.subject_categories(agreement.long_ratings(judged(spark, d), "doc_id", RATERS), [0, 1])
    return out.withColumnsRenamed({"0": "zero", "1": "one"})


@query("SELECT source AS value, min(doc_id) AS first FROM documents GROUP BY source")
def first_appearances(spark, d):
    """Distinct values and where they first appear."""
    return frames.values_of(load(spark, d, "documents"), "source", "doc_id")


@query(JUDGED + f"SELECT doc_id, model, count(*) OVER (PARTITION BY model) AS n_misclassified FROM {LONG} WHERE y <> h")
def spread_counts(spark, d):
    """A group's size at each of its rows."""
    return frames.with_group_size(long_labels(spark, d).where("y <> h").select("doc_id", "model"), "model", "n_misclassified")


@query("SELECT count(*) > count(DISTINCT text) + (count(*) FILTER (text IS NULL) > 0)::INT AS duplicated FROM documents")
def repeated_texts(spark, d):
    """Whether any text repeats."""
    return frames.has_duplicates(load(spark, d, "documents"), "text")


@query("WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('42:' || doc_id::VARCHAR), doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents), s AS (SELECT lang, CASE WHEN k <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS part FROM r) SELECT part, lang, count(*) AS n FROM s GROUP BY ALL")
def split_statistics(spark, d):
    """Rows of each label in each part of a split."""
    return rows.split(load(spark, d, "documents").select("doc_id", "lang"), "doc_id", "lang").groupBy("part", "lang").agg(F.count("*").alias("n"))


@query("WITH r AS (SELECT doc_id, quality, toxic, row_number() OVER (PARTITION BY toxic ORDER BY md5('7:' || doc_id::VARCHAR), doc_id) AS k, count(*) OVER (PARTITION BY toxic) AS n FROM labels) SELECT doc_id, quality, toxic, CASE WHEN k <= floor(n * 0.25 + 0.5) THEN 'test' ELSE 'train' END AS part FROM r")
def split_of_labels(spark, d):
    """A split of rows with several label columns, stratified by one of them."""
    return frames.split_parts(load(spark, d, "labels"), "doc_id", ["quality", "toxic"], 0.25, 7, True, "toxic")


@query("WITH r AS (SELECT n_nationkey, row_number() OVER (ORDER BY md5('42:' || n_nationkey::VARCHAR), n_nationkey) AS k, count(*) OVER () AS n FROM nation) SELECT n_nationkey, CASE WHEN k <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS part FROM r")
def split_fallback(spark, d):
    """A split that can't be stratified, as each class has one row."""
    return frames.split_parts(load(spark, d, "nation").select("n_nationkey", "n_name"), "n_nationkey", ["n_name"], stratify=True).drop("n_name")


@query("SELECT doc_id, row_number() OVER (ORDER BY substr(md5('42:' || doc_id::VARCHAR), 1, 15)) - 1 AS place FROM documents")
def shuffled_rows(spark, d):
    """A repeatable shuffle."""
    return frames.shuffled(load(spark, d, "documents").select("doc_id"), "doc_id")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_orders(spark, d):
    """The first rows by falling values."""
    return frames.ranked(load(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey", k=20)


SCORED = "s AS (SELECT vec_id, embedding[1]::DOUBLE AS m1, embedding[2]::DOUBLE AS m2, embedding[3]::DOUBLE AS m3 FROM embeddings)"


def scored(spark, d):
    """Each vector's first three places as scores of three models."""
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    return load(spark, d, "embeddings").select("vec_id", at(0).alias("m1"), at(1).alias("m2"), at(2).alias("m3"))


@query(f"WITH {SCORED}, l AS (UNPIVOT s ON m1, m2, m3 INTO NAME model VALUE score) SELECT vec_id, model, score, row_number() OVER (PARTITION BY model ORDER BY score DESC, vec_id)::INT AS rank FROM l QUALIFY rank <= 3")
def top_of_each_model(spark, d):
    """The best rows of each model."""
    from ..operators import similarity

    return similarity.top_by_model(scored(spark, d), ["vec_id"], ["m1", "m2", "m3"])


@query(f"WITH {SCORED}, l AS (UNPIVOT s ON m1, m2, m3 INTO NAME model VALUE score) SELECT vec_id, model, score FROM l ORDER BY score DESC, vec_id, model LIMIT 10")
def top_of_all_models(spark, d):
    """The best rows over all models."""
    return frames.ranked(scored(spark, d).unpivot(["vec_id"], ["m1", "m2", "m3"], "model", "score"), "score", "vec_id", "model", k=10)


@query(f"WITH {SCORED} SELECT vec_id, round((m1 + m2 + m3) / 3, 6) AS average FROM s ORDER BY (m1 + m2 + m3) / 3 DESC, vec_id LIMIT 10")
def top_by_average(spark, d):
    """The best rows by the mean of the models' scores."""
    from ..operators import similarity

    out = scored(spark, d).select("vec_id", similarity.row_mean(["m1", "m2", "m3"]).alias("average"))
    return rounded(frames.ranked(out, "average", "vec_id", k=10), "average")


@query("SELECT lang AS name FROM documents WHERE lang IS NOT NULL UNION SELECT source FROM documents WHERE source IS NOT NULL UNION SELECT n_name FROM nation")
def united_names(spark, d):
    """The union of several sets."""
    docs = load(spark, d, "documents")
    parts = [docs.select(F.col("lang").alias("name")), docs.select(F.col("source").alias("name")), load(spark, d, "nation").select(F.col("n_name").alias("name"))]
    return parts[0].union(parts[1]).union(parts[2]).where("name is not null").distinct()


@query(f"SELECT o_orderkey, (pos // 50)::BIGINT AS batch FROM {PLACED}")
def row_batches(spark, d):
    """Batches of fifty rows."""
    return frames.batched(load(spark, d, "orders").select("o_orderkey"), "o_orderkey")


@query("WITH t AS (SELECT conv_id, turn, role, coalesce(sum((role = 'assistant')::INT) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS sentence FROM conversations) SELECT conv_id, sentence::BIGINT AS sentence, string_agg(role || turn, ' ' ORDER BY turn) AS words FROM t WHERE role <> 'assistant' GROUP BY conv_id, sentence")
def sentences_again(spark, d):
    """Words put together again between rows that end a sentence."""
    c = load(spark, d, "conversations").withColumn("word", F.concat("role", F.col("turn").cast("string")))
    return frames.sentences_again(c, "conv_id", "turn", "word", F.col("role") == "assistant").withColumn("words", F.array_join("words", " "))


@query("SELECT bool_and(d.doc_id IS NOT DISTINCT FROM l.doc_id) AS ids, bool_and(l.quality IS NOT DISTINCT FROM l.toxic) AS labels FROM labels l JOIN documents d USING (doc_id)")
def equal_columns(spark, d):
    """Whether columns are equal throughout."""
    both = load(spark, d, "labels").join(load(spark, d, "documents").select("doc_id", F.col("doc_id").alias("other")), "doc_id")
    return frames.columns_equal(both, {"ids": ("doc_id", "other"), "labels": ("quality", "toxic")})


@query("SELECT count(*) AS rows FROM documents")
def checked_lengths(spark, d):
    """The length of two tables that must have the same."""
    docs = load(spark, d, "documents")
    return frames.same_length(docs.select("doc_id"), docs.select("text"))


@query("SELECT round(avg((list_position(embedding, list_max(embedding)) - 1 = label)::INT), 6) AS accuracy FROM embeddings")
def argmax_accuracy(spark, d):
    """Accuracy of the place of the largest score."""
    v = F.col("embedding")
    hit = (F.array_position(v, F.array_max(v)) - 1 == F.col("label")).cast("int")
    return load(spark, d, "embeddings").agg(F.round(F.avg(hit), 6).alias("accuracy"))


@query(JUDGED + f""", c AS (SELECT model, k.c AS class, sum((y = k.c AND h = k.c)::INT)::DOUBLE AS hit, sum((h = k.c)::INT)::DOUBLE AS said, sum((y = k.c)::INT)::DOUBLE AS support FROM {LONG}, (VALUES (0), (1)) k(c) GROUP BY ALL),
s AS (SELECT model, support, CASE WHEN said > 0 THEN hit / said ELSE 0 END AS p, CASE WHEN support > 0 THEN hit / support ELSE 0 END AS r, CASE WHEN said + support > 0 THEN 2 * hit / (said + support) ELSE 0 END AS f FROM c)
SELECT model, 'macro avg' AS row, round(avg(p), 6) AS precision, round(avg(r), 6) AS recall, round(avg(f), 6) AS f1, sum(support)::BIGINT AS support FROM s GROUP BY model
UNION ALL SELECT model, 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), sum(support)::BIGINT FROM s GROUP BY model""")
def report_averages(spark, d):
    """Macro and weighted averages of a classification report (M6)."""
    return rounded(agreement.report_averages(agreement.report(agreement.confusion(judged(spark, d), "quality", RATERS[1:]))), "precision", "recall", "f1")


@query(JUDGED + """, c AS (SELECT a.rater AS model_1, b.rater AS model_2, avg((a.value = b.value)::INT) AS po, avg(a.value) AS p1, avg(b.value) AS p2 FROM r a JOIN r b ON a.subject = b.subject AND a.rater < b.rater GROUP BY ALL),
k AS (SELECT model_1, model_2, (po - (p1 * p2 + (1 - p1) * (1 - p2))) / (1 - (p1 * p2 + (1 - p1) * (1 - p2))) AS kappa FROM c)
SELECT model_1, model_2, round(kappa, 6) AS kappa, row_number() OVER (ORDER BY kappa DESC, model_1, model_2)::INT AS rank FROM k""")
def kappa_ranking(spark, d):
    """Pairs of raters by their agreement."""
    return rounded(agreement.ranked_pairs(agreement.kappa_pairs(agreement.long_ratings(judged(spark, d), "doc_id", RATERS))), "kappa")


@query(JUDGED + """, v AS (SELECT subject, CASE WHEN sum(value) > 1 THEN 1 ELSE 0 END AS vote FROM r WHERE rater <> 'quality' GROUP BY subject),
b AS (SELECT quality AS x, vote AS y FROM j JOIN v ON doc_id = subject), c AS (SELECT avg((x = y)::INT) AS po, avg(x) AS p1, avg(y) AS p2 FROM b)
SELECT 'gold' AS model_1, 'vote' AS model_2, round((po - (p1 * p2 + (1 - p1) * (1 - p2))) / (1 - (p1 * p2 + (1 - p1) * (1 - p2))), 6) AS kappa FROM c""")
def vote_agreement(spark, d):
    """Agreement of the majority vote with the gold label."""
    j = judged(spark, d)
    vote = agreement.majority(agreement.long_ratings(j, "doc_id", RATERS[1:])).select("subject", F.lit("vote").alias("rater"), F.col("vote").alias("value"))
    gold = j.select(F.col("doc_id").alias("subject"), F.lit("gold").alias("rater"), F.col("quality").alias("value"))
    return rounded(agreement.kappa_pairs(vote.unionByName(gold)), "kappa")


@query("SELECT lang AS label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS pct, 'before' AS stage FROM documents GROUP BY lang UNION ALL SELECT lang, (SELECT min(n) FROM (SELECT count(*) AS n FROM documents GROUP BY lang)), round(100.0 / (SELECT count(DISTINCT coalesce(lang, '')) FROM documents), 1)::DOUBLE, 'after' FROM documents GROUP BY lang")
def balance_before_after(spark, d):
    """What the charts of class balance show, before and after undersampling."""
    docs = load(spark, d, "documents").select("doc_id", "lang")
    of = lambda df, stage: rows.class_distribution(df, "lang").withColumn("stage", F.lit(stage))
    return of(docs, "before").unionByName(of(rows.balanced(docs, "doc_id", "lang", "undersample"), "after"))


@query("SELECT doc_id, quality, toxic, CASE WHEN toxic IS NULL THEN 'made' ELSE 'given' END AS origin FROM (SELECT d.doc_id, coalesce(quality, (d.doc_id % 2)::INT) AS quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))")
def relabelled_rows(spark, d):
    """Only rows without a label get a new one."""
    df = load(spark, d, "documents").select("doc_id").join(load(spark, d, "labels"), "doc_id", "left").withColumn("origin", F.when(F.col("toxic").isNull(), "made").otherwise("given"))
    return frames.unlabelled_filled(df, "quality", lambda x: x.withColumn("quality", (F.col("doc_id") % 2).cast("int")))


@query("SELECT c_custkey, trim(x, ' ') AS item FROM (SELECT c_custkey, unnest(string_split(c_name || ', ' || c_mktsegment, ',')) AS x FROM customer)")
def comma_rows(spark, d):
    """Comma-separated input as rows."""
    return load(spark, d, "customer").select("c_custkey", F.explode(F.split(F.concat_ws(", ", "c_name", "c_mktsegment"), ",")).alias("item")).withColumn("item", F.trim("item"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def exact_values(spark, d):
    """Rows with one exact value."""
    return load(spark, d, "orders").where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey")


@query("SELECT n_nationkey, '[CLS] ' || n_name || ' [SEP] ' || r_name || ' [SEP]' AS tokens FROM nation JOIN region ON n_regionkey = r_regionkey")
def token_pairs(spark, d):
    """Two texts' tokens as one sequence."""
    both = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return both.select("n_nationkey", F.array_join(tx.paired_tokens(F.col("n_name"), F.col("r_name")), " ").alias("tokens"))
