"""Every query of the library by name, with its SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import agreement, corpus, rows
from ..operators.skew import same
from ..sources import writers
from ..streaming import events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}
RATERS = ["quality", "long_text", "even_id", "clean"]
TOKENS = r"list_filter(regexp_split_to_array({}, '[ \t\n\x0B\f\r]+'), lambda x: x <> '')"
LOWER = TOKENS.format("lower(coalesce(text, ''))")


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def judged(spark: SparkSession, d: str) -> DataFrame:
    """Labelled documents with four raters of 0 and 1."""
    docs = load(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return load(spark, d, "labels").join(docs, "doc_id").select(
        "doc_id", "lang", "source", "n_chars", "quality", (F.col("n_chars") >= 1000).cast("int").alias("long_text"),
        (F.col("doc_id") % 2).cast("int").alias("even_id"), (1 - F.col("toxic")).cast("int").alias("clean"),
    )


JUDGED = "WITH j AS (SELECT l.doc_id, d.lang, d.source, d.n_chars, l.quality::INT AS quality, (d.n_chars >= 1000)::INT AS long_text, (l.doc_id % 2)::INT AS even_id, (1 - l.toxic)::INT AS clean FROM labels l JOIN documents d USING (doc_id)), r AS (UNPIVOT (SELECT doc_id AS subject, quality, long_text, even_id, clean FROM j) ON quality, long_text, even_id, clean INTO NAME rater VALUE value) "


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


METRICS = ["accuracy", "precision_class_0", "precision_class_1", "recall_class_0", "recall_class_1", "f1_class_0", "f1_class_1", "auc"]


@query(JUDGED + """, p AS (UNPIVOT (SELECT quality AS y, long_text, even_id, clean FROM j) ON long_text, even_id, clean INTO NAME model VALUE h),
c AS (SELECT model, sum((y = 1 AND h = 1)::INT)::DOUBLE AS tp, sum((y = 0 AND h = 1)::INT)::DOUBLE AS fp, sum((y = 1 AND h = 0)::INT)::DOUBLE AS fn, sum((y = 0 AND h = 0)::INT)::DOUBLE AS tn FROM p GROUP BY model)
SELECT model, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy,
round(CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0 END, 6) AS precision_class_0, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision_class_1,
round(CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END, 6) AS recall_class_0, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall_class_1,
round(CASE WHEN 2 * tn + fn + fp > 0 THEN 2 * tn / (2 * tn + fn + fp) ELSE 0 END, 6) AS f1_class_0, round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1_class_1,
round(((CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END) + (CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0 END)) / 2, 6) AS auc FROM c""")
def metrics_summary(spark, d):
    """Accuracy, precision, recall, F1 and AUC of hard labels."""
    return rounded(agreement.binary_metrics(agreement.confusion(judged(spark, d), "quality", RATERS[1:])), *METRICS)


@query(JUDGED + "SELECT 'long_text' AS model, quality AS y, long_text AS y_hat, count(*) AS n FROM j GROUP BY ALL")
def confusion_matrix(spark, d):
    return agreement.confusion(judged(spark, d), "quality", ["long_text"])


@query(JUDGED + """, c AS (SELECT a.rater AS model_1, b.rater AS model_2, avg((a.value = b.value)::INT) AS po, avg(a.value) AS p1, avg(b.value) AS p2 FROM r a JOIN r b ON a.subject = b.subject AND a.rater < b.rater GROUP BY ALL)
SELECT model_1, model_2, round((po - (p1 * p2 + (1 - p1) * (1 - p2))) / (1 - (p1 * p2 + (1 - p1) * (1 - p2))), 6) AS kappa FROM c""")
def kappa_pairs(spark, d):
    """Cohen's kappa of all pairs of raters."""
    return rounded(agreement.kappa_pairs(agreement.long_ratings(judged(spark, d), "doc_id", RATERS)), "kappa")


@query(JUDGED + """, s AS (SELECT subject, sum(value) AS one, count(*) - sum(value) AS zero FROM r GROUP BY subject),
p AS (SELECT avg((one * one + zero * zero - 4) / 12.0) AS p, sum(one) / (4.0 * count(*)) AS q FROM s)
SELECT round((p - (q * q + (1 - q) * (1 - q))) / (1 - (q * q + (1 - q) * (1 - q))), 6) AS fleiss_kappa FROM p""")
def fleiss_kappa(spark, d):
    return rounded(agreement.fleiss_kappa(agreement.long_ratings(judged(spark, d), "doc_id", RATERS)), "fleiss_kappa")


@query(JUDGED + "SELECT subject, CASE WHEN sum(value) > 2 THEN 1 ELSE 0 END AS vote, greatest(sum(value), 4 - sum(value))::BIGINT AS votes FROM r GROUP BY subject")
def majority_vote(spark, d):
    return agreement.majority(agreement.long_ratings(judged(spark, d), "doc_id", RATERS))


@query(JUDGED + "SELECT doc_id, model, y, y_hat FROM (UNPIVOT (SELECT doc_id, quality AS y, long_text, even_id, clean FROM j) ON long_text, even_id, clean INTO NAME model VALUE y_hat) WHERE y <> y_hat")
def misclassified(spark, d):
    return judged(spark, d).select("doc_id", F.col("quality").alias("y"), *RATERS[1:]).unpivot(["doc_id", "y"], RATERS[1:], "model", "y_hat").where("y <> y_hat").select("doc_id", "model", "y", "y_hat")


@query("SELECT lang AS label, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS pct FROM documents GROUP BY lang")
def class_distribution(spark, d):
    return rows.class_distribution(load(spark, d, "documents"), "lang")


@query("SELECT 'all' AS key, 'all' AS value, count(*) AS n FROM documents UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY lang UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source")
def dataset_profile(spark, d):
    return rows.profile(load(spark, d, "documents"), ["lang", "source"])


@query("SELECT lang, round(avg(n_chars), 4) AS mean, round(stddev_samp(n_chars), 4) AS std, format('{:.2f} ± {:.2f}', avg(n_chars), stddev_samp(n_chars)) AS shown FROM documents GROUP BY lang")
def group_mean_std(spark, d):
    m, s = F.avg("n_chars"), F.stddev_samp("n_chars")
    return load(spark, d, "documents").groupBy("lang").agg(F.round(m, 4).alias("mean"), F.round(s, 4).alias("std"), F.format_string("%.2f ± %.2f", m, s).alias("shown"))


@query("SELECT source, max_by(doc_id, struct_pack(n := n_chars, d := doc_id)) AS longest, min_by(doc_id, struct_pack(n := n_chars, d := doc_id)) AS shortest, max(n_chars) - min(n_chars) AS margin, round(stddev_pop(n_chars), 4) AS std FROM documents GROUP BY source")
def source_margins(spark, d):
    key = F.struct("n_chars", "doc_id")
    return load(spark, d, "documents").groupBy("source").agg(F.max_by("doc_id", key).alias("longest"), F.min_by("doc_id", key).alias("shortest"), (F.max("n_chars") - F.min("n_chars")).alias("margin"), F.round(F.stddev_pop("n_chars"), 4).alias("std"))


@query("SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL")
def crosstab(spark, d):
    return load(spark, d, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))


@query(JUDGED + "SELECT lang, coalesce(sum(CASE WHEN quality = 0 THEN n_chars END), 0)::BIGINT AS q0, coalesce(sum(CASE WHEN quality = 1 THEN n_chars END), 0)::BIGINT AS q1 FROM j GROUP BY lang")
def pivot_sum(spark, d):
    return judged(spark, d).groupBy("lang").pivot("quality", [0, 1]).agg(F.sum("n_chars")).na.fill(0).withColumnsRenamed({"0": "q0", "1": "q1"})


@query(r"""SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(text), '<[^\n]*?>', ' ', 'g'), 'http[^ \t\n\x0B\f\r]+', '', 'g'), '[^a-zA-Z0-9$% \t\n\x0B\f\r]', ' ', 'g'), ' +', ' ', 'g') AS cleaned FROM documents""")
def clean_text(spark, d):
    return load(spark, d, "documents").select("doc_id", tx.clean(F.col("text")).alias("cleaned"))


@query(f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({LOWER}) AS term FROM documents) GROUP BY ALL")
def term_frequency(spark, d):
    return corpus.term_counts(load(spark, d, "documents"))


@query(f"""WITH t AS (SELECT {LOWER} AS t FROM documents), p AS (SELECT unnest(list_zip(t[:-2], t[2:])) AS x FROM t WHERE len(t) > 1),
c AS (SELECT x[1] AS first, x[2] AS second, count(*) AS n FROM p GROUP BY ALL) SELECT first, second, n, round(n / sum(n) OVER (PARTITION BY first), 6) AS p FROM c""")
def bigram_counts(spark, d):
    return rounded(corpus.bigrams(load(spark, d, "documents")), "p")


@query(f"""WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({LOWER}) AS term FROM documents) GROUP BY ALL),
v AS (SELECT term, sum(tf) AS a, count(*) AS df FROM tf GROUP BY term ORDER BY a DESC, term LIMIT 500),
w AS (SELECT doc_id, term, tf * (ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1) AS w FROM tf JOIN v USING (term))
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w""")
def tfidf(spark, d):
    return rounded(corpus.tfidf(load(spark, d, "documents"), 500), "weight")


@query(f"""WITH t AS (SELECT doc_id, {LOWER} AS t FROM documents), tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM t) GROUP BY ALL),
s AS (SELECT count(*) AS n, avg(len(t)) AS a FROM t), i AS (SELECT term, ln(n - count(*) + 0.5) - ln(count(*) + 0.5) AS idf FROM tf, s GROUP BY term, n),
m AS (SELECT avg(idf) AS m FROM i), q AS (SELECT term, CASE WHEN idf < 0 THEN 0.25 * m ELSE idf END AS idf FROM i, m WHERE term IN ('the', 'thation', 'und', 'ereable', 'les'))
SELECT doc_id, round(sum(idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(t) / a))), 6) AS score FROM tf JOIN q USING (term) JOIN t USING (doc_id), s GROUP BY doc_id""")
def bm25(spark, d):
    return rounded(corpus.bm25(load(spark, d, "documents"), ["the", "thation", "und", "ereable", "les"]), "score")


@query(f"""WITH t AS (SELECT doc_id, {TOKENS.format("coalesce(text, '')")} AS t FROM documents), c AS (SELECT doc_id, t, unnest(range(0, greatest(len(t), 1), 480)) AS pos FROM t)
SELECT doc_id, (pos // 480)::INT AS chunk, len(t[pos + 1 : pos + 512])::INT AS words, array_to_string(t[pos + 1 : pos + 512], ' ') AS text FROM c WHERE len(t) > 0""")
def chunk_documents(spark, d):
    return corpus.chunks(load(spark, d, "documents"))


@query("""WITH q AS (SELECT a.vec_id AS query_id, b.vec_id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY cosine DESC, vec_id) AS rank FROM q) SELECT query_id, vec_id, round(cosine, 5) AS cosine, rank::INT AS rank FROM r WHERE rank <= 5""")
def nearest_vectors(spark, d):
    """Queries: rows whose id is divisible by 50, against all rows."""
    v = load(spark, d, "embeddings")
    return corpus.nearest(v, v.where("vec_id % 50 = 0")).withColumn("cosine", F.round("cosine", 5))


@query("WITH t AS (SELECT role AS state, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_state FROM conversations), c AS (SELECT state, next_state, count(*) AS n FROM t WHERE next_state IS NOT NULL GROUP BY ALL) SELECT state, next_state, n, round(n / sum(n) OVER (PARTITION BY state), 6) AS p FROM c")
def state_transitions(spark, d):
    return rounded(rows.transitions(load(spark, d, "conversations"), "conv_id", "turn", "role"), "p")


@query("WITH b AS (SELECT user_id, event_type, value, sum((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS block FROM events) SELECT user_id, block::BIGINT AS block, count(*) AS n, round(sum(value), 4) AS total FROM b WHERE event_type <> 'error' GROUP BY ALL")
def event_blocks(spark, d):
    found = rows.islands(load(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("event_type") == "error")
    return found.groupBy("user_id", "block").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))


@query("WITH w AS (SELECT user_id, event_id, lag(value, 3) OVER w AS a, lag(value, 2) OVER w AS b, lag(value) OVER w AS c, value AS y FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) SELECT user_id, event_id, round(a + b + c, 4) AS x, y FROM w WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL")
def lookback_windows(spark, d):
    found = rows.lookback(load(spark, d, "events"), "user_id", ["ts", "event_id"], "value", 3)
    return found.select("user_id", "event_id", F.round(F.col("x")[0] + F.col("x")[1] + F.col("x")[2], 4).alias("x"), "y")


KEY = "md5('42:' || doc_id::VARCHAR)"


@query(f"WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {KEY}, doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents) SELECT doc_id, lang, CASE WHEN k <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS part FROM r")
def stratified_split(spark, d):
    return rows.split(load(spark, d, "documents").select("doc_id", "lang"), "doc_id", "lang")


@query(f"WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {KEY}, doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents), g AS (SELECT *, max(n) OVER () AS m FROM r) SELECT doc_id, lang FROM (SELECT doc_id, lang, unnest(range(0, ((m // n) + (k <= m % n)::INT)::BIGINT)) FROM g)")
def oversample(spark, d):
    return rows.balanced(load(spark, d, "documents").select("doc_id", "lang"), "doc_id", "lang", "oversample")


@query(f"WITH r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {KEY}, doc_id) AS k, count(*) OVER (PARTITION BY lang) AS n FROM documents) SELECT doc_id, lang FROM r QUALIFY k <= min(n) OVER ()")
def undersample(spark, d):
    return rows.balanced(load(spark, d, "documents").select("doc_id", "lang"), "doc_id", "lang", "undersample")


@query("SELECT lang AS label, round(sum(count(*)) OVER () / (count(*) OVER () * count(*)), 6)::DOUBLE AS weight FROM documents GROUP BY lang")
def class_weights(spark, d):
    return rounded(rows.class_weights(load(spark, d, "documents"), "lang"), "weight")


@query("SELECT event_type, count(*) AS n, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS k FROM events GROUP BY event_type")
def json_fields(spark, d):
    k = F.from_json("props", "k BIGINT")["k"]
    return load(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("k"))


@query("SELECT text, min(doc_id) AS doc_id FROM documents GROUP BY text")
def keep_first(spark, d):
    return rows.keep_first(load(spark, d, "documents").select("doc_id", "text"), ["text"], "doc_id").select("text", "doc_id")


@query(f"SELECT doc_id, list_has_any({LOWER}, ['will', 'shall', 'would', 'could', 'should', 'may', 'might', 'must', 'can', 'going']) AS forecast FROM documents")
def future_modal_rule(spark, d):
    return load(spark, d, "documents").select("doc_id", F.coalesce(tx.has_future_modal(F.col("text")), F.lit(False)).alias("forecast"))


@query("SELECT a.n_name AS name_1, b.n_name AS name_2, levenshtein(a.n_name, b.n_name)::INT AS distance FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def blocked_name_pairs(spark, d):
    n = load(spark, d, "nation")
    a, b = n.alias("a"), n.alias("b")
    on = (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))
    return a.join(b, on).select(F.col("a.n_name").alias("name_1"), F.col("b.n_name").alias("name_2"), F.levenshtein("a.n_name", "b.n_name").alias("distance"))


@query("SELECT event_id, round((value - avg(value) OVER w) / stddev_pop(value) OVER w, 6) AS z FROM events WINDOW w AS (PARTITION BY event_type)")
def standard_scale(spark, d):
    e = load(spark, d, "events")
    stats = e.groupBy("event_type").agg(F.avg("value").alias("m"), F.stddev_pop("value").alias("s"))
    return same(e, stats, "event_type").select("event_id", F.round((F.col("value") - F.col("m")) / F.col("s"), 6).alias("z"))


@query(r"SELECT shape, count(*) AS n FROM (SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[a-z]', 'x', 'g'), '[A-Z]', 'X', 'g'), '[0-9]', 'd', 'g'), '(x{4})x+|(X{4})X+|(d{4})d+', '\1\2\3', 'g') AS shape FROM (SELECT unnest(" + TOKENS.format("coalesce(text, '')") + ") AS t FROM documents)) GROUP BY shape")
def token_shapes(spark, d):
    return load(spark, d, "documents").select(F.explode(tx.tokens(F.col("text"))).alias("t")).groupBy(tx.shape(F.col("t")).alias("shape")).agg(F.count("*").alias("n"))


@query("SELECT doc_id, len(list_filter(list_transform(string_split(text, '.'), lambda x: trim(x, ' ')), lambda x: x <> ''))::INT AS n FROM documents")
def sentence_counts(spark, d):
    return load(spark, d, "documents").select("doc_id", F.size(tx.sentences(F.col("text"))).alias("n"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_rows(spark, d):
    return rows.pending(load(spark, d, "documents").select("doc_id"), load(spark, d, "labels"), "doc_id")


@query("SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY ALL")
def windowed_counts(spark, d):
    return events.windowed_counts(load(spark, d, "events"))


@query("SELECT 'CSV Row: ' || r_regionkey || ', ' || r_name AS value FROM region")
def log_lines(spark, d):
    return writers.as_log_lines(load(spark, d, "region").select("r_regionkey", "r_name"))


def _all() -> None:
    from . import corpora, indexed, more, parsed, shaping, stored  # noqa: F401  register their queries here


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _all()
    return dict(QUERIES)


def sql() -> dict[str, str]:
    _all()
    return dict(SQL)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kappa_pairs(spark, sf_dir)
