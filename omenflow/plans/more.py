"""Queries on forecasts, sequences, likeness, pages and models, added to those of the catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import forecasts as fc
from ..functions import text as tx
from ..operators import agreement, corpus, learning, linguistic, providers, rows, sequences, similarity, topics
from ..sources import pages as pg
from .catalog import JUDGED, LOWER, RATERS, judged, load, query, rounded

HALVES = "WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings), p AS (SELECT a.vec_id, a.v AS a, b.v AS b FROM e a JOIN e b ON b.vec_id = a.vec_id + 1) "


def neighbours(spark, d) -> DataFrame:
    """Each vector and the one with the next id."""
    v = load(spark, d, "embeddings").select("vec_id", F.col("embedding").alias("a"))
    return v.join(v.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b")), "vec_id")


@query(HALVES + "SELECT vec_id, round(list_cosine_similarity(a, b), 5) AS cosine, round(list_sum(list_transform(list_zip(a, b), lambda x: (x[1] - x[2]) * (x[1] - x[2]))), 5) AS distance FROM p")
def aligned_similarity(spark, d):
    a, b = F.col("a"), F.col("b")
    return neighbours(spark, d).select("vec_id", F.round(similarity.cosine(a, b), 5).alias("cosine"), F.round(similarity.squared_distance(a, b), 5).alias("distance"))


@query(HALVES + ", x AS (SELECT vec_id, unnest(a) AS a, unnest(b) AS b FROM p), r AS (SELECT *, rank() OVER (PARTITION BY vec_id ORDER BY a) + (count(*) OVER (PARTITION BY vec_id, a) - 1) / 2.0 AS ra, rank() OVER (PARTITION BY vec_id ORDER BY b) + (count(*) OVER (PARTITION BY vec_id, b) - 1) / 2.0 AS rb FROM x) SELECT vec_id, round(corr(a, b), 5) AS pearson, round(corr(ra, rb), 5) AS spearman FROM r GROUP BY vec_id")
def vector_correlations(spark, d):
    a, b = F.col("a"), F.col("b")
    return neighbours(spark, d).select("vec_id", F.round(similarity.pearson(a, b), 5).alias("pearson"), F.round(similarity.spearman(a, b), 5).alias("spearman"))


@query(f"WITH t AS (SELECT item_id, list_distinct({LOWER}) AS s FROM benchmark) SELECT a.item_id, round(2.0 * len(list_intersect(a.s, b.s)) / (len(a.s) + len(b.s)), 6)::DOUBLE AS dice, len(list_intersect(a.s, b.s))::INT AS shared FROM t a JOIN t b ON b.item_id = a.item_id + 1")
def token_overlap(spark, d):
    t = load(spark, d, "benchmark")
    pairs = t.join(t.select((F.col("item_id") - 1).alias("item_id"), F.col("text").alias("other")), "item_id")
    return pairs.select("item_id", F.round(similarity.dice(F.col("text"), F.col("other")), 6).alias("dice"), F.size(similarity.shared_tokens(F.col("text"), F.col("other"))).alias("shared"))


@query()
def varied_search(spark, d):
    """Ten nearest of each query vector, five of which are picked for variety."""
    v = load(spark, d, "embeddings")
    found = corpus.nearest(v, v.where("vec_id % 50 = 0"), k=10).select("query_id", "vec_id")
    q = v.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return similarity.varied(found.join(v.select("vec_id", "embedding"), "vec_id").join(q, "query_id"))


@query(f"WITH c AS (SELECT w AS word, count(*) AS n FROM (SELECT unnest({LOWER}) AS w FROM documents) GROUP BY w) SELECT word, n FROM c WHERE n > 3 UNION ALL SELECT '< unk >', count(*) FROM c WHERE n <= 3")
def vocabulary(spark, d):
    return sequences.vocabulary(load(spark, d, "documents").select(F.explode(tx.tokens(F.lower("text"))).alias("word")))


@query("WITH c AS (SELECT role AS tag, (turn % 3)::VARCHAR AS word, count(*) AS n FROM conversations GROUP BY ALL) SELECT tag, word, n, round(n / sum(n) OVER (PARTITION BY tag), 6) AS p FROM c")
def emission_counts(spark, d):
    return rounded(sequences.emissions(load(spark, d, "conversations").select(F.col("role").alias("tag"), (F.col("turn") % 3).cast("string").alias("word"))), "p")


@query("WITH t AS (SELECT conv_id, role AS a, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM conversations), n AS (SELECT a, b, count(*) AS n FROM t WHERE b IS NOT NULL GROUP BY a, b), c AS (SELECT a, b, n / sum(n) OVER (PARTITION BY a) AS p FROM n) SELECT conv_id AS path, round(exp(sum(ln(p))), 6) AS p FROM t JOIN c USING (a, b) GROUP BY conv_id")
def path_probabilities(spark, d):
    c = load(spark, d, "conversations")
    paths = c.select(F.col("conv_id").alias("path"), F.col("turn").alias("pos"), F.col("role").alias("state"))
    return rounded(sequences.path_probability(paths, rows.transitions(c, "conv_id", "turn", "role")), "p")


@query("SELECT conv_id, turn, role || '_' || row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS unique_label FROM conversations")
def numbered_labels(spark, d):
    return sequences.numbered(load(spark, d, "conversations"), "role", ["turn"], "conv_id").select("conv_id", "turn", "unique_label")


@query("SELECT conv_id, max_by(text, turn) FILTER (role = 'user') AS \"user\", max_by(text, turn) FILTER (role = 'assistant') AS assistant FROM conversations GROUP BY conv_id")
def wide_roles(spark, d):
    return sequences.wide_entities(load(spark, d, "conversations"), "conv_id", "role", "text", "turn", ["user", "assistant"])


@query("SELECT conv_id, max((role = 'user' AND turn > 2)::INT) AS future FROM conversations GROUP BY conv_id")
def tense_rule(spark, d):
    """The tense rule on roles and late turns in place of parts of speech and tags."""
    c = load(spark, d, "conversations").select("conv_id", F.col("role").alias("pos"), F.when(F.col("turn") > 2, "MD").alias("tag"))
    return sequences.tense(c, "conv_id", wants=("user", "MD"))


@query("WITH e AS (SELECT DISTINCT lang AS a, source AS b FROM documents) SELECT node, count(*) AS degree FROM (SELECT a AS node FROM e UNION ALL SELECT b FROM e) WHERE node IS NOT NULL GROUP BY node")
def node_degrees(spark, d):
    return sequences.degrees(load(spark, d, "documents"), "lang", "source")


#: One sentence of each template; ``{p}`` is who, ``{o}`` where, ``{v}`` how much.
TEMPLATED = (
    "T1: On [2024-10-15], [{p}] predicts that the [revenue] at [{o}] [will] [rise] by [{v}] in [Q3 2027].",
    "T2: In [2024], [{p}] from [{o}], forecasts that the [revenue] [will] [fall] from [{v}] in [2027].",
    "T3: [{p}] says on [2024] that the [price] in [{o}] [may] [rise] by [{v}] in [2028].",
    "T4: According to a [{p}] from [{o}], on [May 2024], the [rate] [should] [go] beyond [{v}] in the timeframe of [June].",
    "T5: In [2026], the [rain] in [{o}] [will] [fall] by [{v}], as said by [{p}] on [Monday].",
    "T2: no sentence of its template by {p}",
    "{p} has no template",
)
#: Of each template, what the fields have: the pattern's groups in their order.
READ = (
    ("2024-10-15", "{p}", "revenue", "{o}", "will", "rise", "{v}", "Q3 2027"), ("2024", "{p}", "{o}", "revenue", "will", "fall", "{v}", "2027"), ("{p}", "says", "2024", "price", "{o}", "may", "rise", "2028"),
    ("{p}", "{o}", "May 2024", "rate", "should", "go", "{v}", "June"), ("2026", "rain", "{o}", "will", "fall", "{v}", "said", "Monday"),
)
PARTS = "SELECT c_custkey, c_custkey % 7 AS k, c_name AS p, 'nation ' || c_nationkey AS o, (c_custkey % 90 + 1) || '%' AS v FROM customer"


def templated(spark, d, texts: tuple[str, ...]) -> DataFrame:
    """``c_custkey, text``: a customer's sentence, of one template each."""
    c = load(spark, d, "customer")
    fill = {"p": F.col("c_name"), "o": F.concat(F.lit("nation "), F.col("c_nationkey").cast("string")), "v": F.concat((F.col("c_custkey") % 90 + 1).cast("string"), F.lit("%"))}
    text = F.get(F.array(*(tx.composed(t, **fill) for t in texts)), (F.col("c_custkey") % len(texts)).cast("int"))
    return c.select("c_custkey", text.alias("text"))


def in_sql(text: str) -> str:
    for name in "pov":
        text = text.replace("{" + name + "}", f"' || {name} || '")
    return f"'{text}'"


@query(f"WITH c AS ({PARTS}) " + " UNION ALL ".join(f"SELECT c_custkey, {k + 1} AS template, " + ", ".join(f"{in_sql(v)} AS {n}" for v, n in zip(values, (*fc.FIELDS, "p_f"), strict=True)) + f" FROM c WHERE k = {k}" for k, values in enumerate(READ)))
def template_extraction(spark, d):
    """Sentences of all templates and of none, made of customers and read back; those that don't fit go."""
    return fc.template_fields(fc.with_template(templated(spark, d, TEMPLATED))).select("c_custkey", "template", *fc.FIELDS, "p_f")


#: One sentence of each strict template, and its properties by name.
STRICT = (
    ("T1: On [2024-10-15], [{p}] is quite sure that the [revenue] at [{o}] [will] [rise] by [{v}] in [Q3 2027].", {"p_t": "2024-10-15", "p_a": "revenue", "p_s": "will", "p_m": "rise", "p_f": "Q3 2027"}),
    ("T2: In [2024], [{p}] from [{o}], says that the [price] [may] [move] from [1%] to [{v}] in [2028].", {"p_t": "2024", "p_a": "price", "p_s": "may", "p_m": "move", "p_f": "2028"}),
    ("T3: [{p}] hopes on [May] that the [rain] in [{o}] [should] [stop] by [{v}] in [June].", {"p_t": "May", "p_a": "rain", "p_s": "should", "p_m": "stop", "p_f": "June"}),
    ("T4: According to a [{p}] from [{o}], on [Monday], the [rate] [will] [go] beyond [{v}] in the timeframe of [July].", {"p_t": "Monday", "p_a": "rate", "p_s": "will", "p_m": "go", "p_f": "July"}),
    ("T5: In [2026], the [snow] in [{o}] [will] [fall] by [{v}], as told by [{p}] on [Friday].", {"p_t": "Friday", "p_a": "snow", "p_s": "will", "p_m": "fall", "p_f": "2026"}),
)


@query(f"WITH c AS ({PARTS.replace('% 7', '% 5')}) " + " UNION ALL ".join(f"SELECT c_custkey, {k + 1} AS template, " + ", ".join(f"'{x}' AS {n}" for n, x in named.items()) + f", p AS p_p, o AS p_o, v AS p_v FROM c WHERE k = {k}" for k, (_, named) in enumerate(STRICT)))
def strict_extraction(spark, d):
    """Sentences of the strict templates, each group under its own meaning."""
    found = fc.strict_fields(fc.with_template(templated(spark, d, tuple(t for t, _ in STRICT))))
    return found.select("c_custkey", "template", *fc.FIELDS, "p_f")


@query("SELECT doc_id, (lang IS NOT NULL)::INT AS lang, (source IS NOT NULL)::INT AS source, (text IS NOT NULL)::INT AS text, (lang IS NOT NULL)::INT + (source IS NOT NULL)::INT + (text IS NOT NULL)::INT AS total_properties FROM documents")
def property_flags(spark, d):
    return fc.property_flags(load(spark, d, "documents").select("doc_id", "lang", "source", "text"), ["lang", "source", "text"])


@query(r"SELECT doc_id FROM documents WHERE regexp_matches(text, '\b(the|The)\b') AND regexp_matches(text, '\b(and|of)\b')")
def keyword_search(spark, d):
    return load(spark, d, "documents").where(fc.keyword_query(F.col("text"), [["the", "The"], ["and", "of"]])).select("doc_id")


@query("SELECT a.n_name AS name_1, b.n_name AS name_2, round(jaro_winkler_similarity(a.n_name, b.n_name), 6) AS likeness FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def name_likeness(spark, d):
    n = load(spark, d, "nation")
    a, b = n.alias("a"), n.alias("b")
    on = (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey"))
    return a.join(b, on).select(F.col("a.n_name").alias("name_1"), F.col("b.n_name").alias("name_2"), F.round(fc.jaro_winkler("a.n_name", "b.n_name"), 6).alias("likeness"))


@query(r"SELECT page_id, len(regexp_extract_all(html, '(?s)<p(?:\s[^>]*)?>(.*?)</p>', 1))::INT AS paragraphs, len(regexp_extract_all(html, '(?s)<li(?:\s[^>]*)?>(.*?)</li>', 1))::INT AS items FROM pages")
def page_parts(spark, d):
    return load(spark, d, "pages").select("page_id", F.size(pg.paragraphs(F.col("html"))).alias("paragraphs"), F.size(pg.list_items(F.col("html"))).alias("items"))


@query("""WITH f AS (SELECT url, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS l FROM pages) SELECT DISTINCT url, CASE WHEN starts_with(l, '/') THEN regexp_extract(url, '^([^:/?#]+://[^/?#]*)', 1) || l ELSE l END AS link FROM f""")
def page_links(spark, d):
    return pg.links(load(spark, d, "pages"))


@query("SELECT DISTINCT year(o_orderdate)::INT AS year, 'http://example.org/' || year(o_orderdate) || '/list' AS url FROM orders")
def yearly_urls(spark, d):
    """A page's url for each year that a table has."""
    return pg.yearly(load(spark, d, "orders").select(F.year("o_orderdate").alias("year")), "http://example.org/{}/list")


@query(JUDGED + """, p AS (UNPIVOT (SELECT quality AS y, long_text, even_id, clean FROM j) ON long_text, even_id, clean INTO NAME model VALUE h), k AS (SELECT model, c, sum((y = c AND h = c)::INT)::DOUBLE AS hit, sum((h = c)::INT)::DOUBLE AS said, sum((y = c)::INT) AS support FROM p, (VALUES (0), (1)) v(c) GROUP BY ALL)
SELECT model, c AS class, round(CASE WHEN said > 0 THEN hit / said ELSE 0 END, 6) AS precision, round(CASE WHEN support > 0 THEN hit / support ELSE 0 END, 6) AS recall, round(CASE WHEN said + support > 0 THEN 2 * hit / (said + support) ELSE 0 END, 6) AS f1, support::BIGINT AS support FROM k""")
def classification_report(spark, d):
    return rounded(agreement.report(agreement.confusion(judged(spark, d), "quality", RATERS[1:])), "precision", "recall", "f1")


@query(JUDGED + ", s AS (SELECT quality AS y, n_chars, rank() OVER (ORDER BY n_chars) + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0 AS r FROM j) SELECT round((sum(r) FILTER (y = 1) - (sum(y) * (sum(y) + 1)) / 2.0) / (sum(y) * (count(*) - sum(y))), 6)::DOUBLE AS auc FROM s")
def rank_auc(spark, d):
    return rounded(agreement.auc(judged(spark, d), "quality", "n_chars"), "auc")


@query(JUDGED + ", p AS (UNPIVOT (SELECT quality AS y, long_text, even_id, clean FROM j) ON long_text, even_id, clean INTO NAME model VALUE h) SELECT model, sum((y <> h)::INT)::BIGINT AS misclassified, count(*) AS n, round(avg((y <> h)::INT), 6) AS ratio FROM p GROUP BY model")
def misclassified_ratio(spark, d):
    n = F.col("n")
    cells = agreement.confusion(judged(spark, d), "quality", RATERS[1:])
    wrong = F.sum(F.when(F.col("y") != F.col("y_hat"), n).otherwise(0))
    return cells.groupBy("model").agg(wrong.alias("misclassified"), F.sum(n).alias("n"), F.round(wrong / F.sum(n), 6).alias("ratio"))


@query("SELECT doc_id, label, reasoning FROM (SELECT doc_id, list_sort(list_distinct(list_intersect(" + LOWER + ", ['will', 'shall', 'would', 'could', 'should', 'may', 'might', 'must', 'can', 'going']))) AS f FROM documents), LATERAL (SELECT (len(f) > 0)::INT AS label, CASE WHEN len(f) > 0 THEN array_to_string(f, ', ') ELSE 'no modal' END AS reasoning)")
def judged_texts(spark, d):
    """A stand-in judge answers in JSON, which is read back."""
    return providers.judged(load(spark, d, "documents"), "doc_id", "text", "Does the text forecast?", {"keywords": providers.keyword_judge}).select("doc_id", "label", "reasoning")


def _vectors(spark, d) -> DataFrame:
    return learning.features(load(spark, d, "embeddings").withColumn("y", (F.col("label") % 2).cast("int")), "embedding", "y")


@query()
def classifiers(spark, d):
    """All kinds of models on the parity of the vectors' labels: learned on four fifths, and their metrics on the rest."""
    names = ["logistic_regression", "decision_tree", "random_forest", "x_gradient_boosting", "support_vector_machine", "perceptron", "sgd", "ridge", "elastic_net"]
    dealt = _vectors(spark, d).withColumn("part", F.crc32(F.col("vec_id").cast("string").cast("binary")) % 5).persist()
    found = learning.predict_all(dealt.where("part = 0"), learning.train_all(dealt.where("part <> 0"), names), ["vec_id", "y"])
    return agreement.binary_metrics(agreement.confusion(found, "y", names))


@query()
def cross_validation(spark, d):
    return learning.cross_validated(_vectors(spark, d), "ridge", "vec_id")


@query()
def vector_clusters(spark, d):
    return learning.clusters(_vectors(spark, d), 8).select("vec_id", "label", "cluster")


@query()
def cluster_centroids(spark, d):
    return learning.centroids(learning.clusters(_vectors(spark, d), 8), "embedding")


@query()
def principal_components(spark, d):
    return learning.projected(_vectors(spark, d)).select("vec_id", "projected")


@query()
def document_topics(spark, d):
    """Each document's share of two topics, learned from all documents with every term."""
    blocks = topics.Blocks.of_texts(load(spark, d, "documents"), 2)
    return topics.Topics.fit(blocks, 2, 10).shares(blocks)


@query("SELECT doc_id, lang, source, quality FROM documents JOIN labels USING (doc_id)")
def natural_join(spark, d):
    return rows.natural_join(load(spark, d, "documents").select("doc_id", "lang", "source"), load(spark, d, "labels").select("doc_id", "quality"))


@query("WITH a AS (SELECT c_name, row_number() OVER (ORDER BY c_custkey) AS k FROM customer), b AS (SELECT s_name, row_number() OVER (ORDER BY s_suppkey) AS k FROM supplier) SELECT k::BIGINT - 1 AS pos, c_name, s_name FROM a JOIN b USING (k)")
def positional_join(spark, d):
    return rows.zipped(load(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", load(spark, d, "supplier").select("s_suppkey", "s_name"), "s_suppkey").select("pos", "c_name", "s_name")


def unioned(parts: list[DataFrame]) -> DataFrame:
    """All rows of all tables by column names; what a table lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


@query("SELECT r_name AS name, r_regionkey AS region, -1 AS nation FROM region UNION ALL SELECT n_name, n_regionkey, n_nationkey FROM nation")
def union_by_name(spark, d):
    return unioned([load(spark, d, "region").select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("region")), load(spark, d, "nation").select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"), F.col("n_nationkey").alias("nation"))]).na.fill(-1, ["nation"])


@query(r"WITH t AS (SELECT item_id, unnest(regexp_extract_all(text, '[\p{L}\p{N}_]+(?:[''’][\p{L}\p{N}_]+)*|[^\p{L}\p{N}_\s]')) AS w FROM benchmark) SELECT item_id, count(*) AS n, sum((lower(w) IN ('will', 'shall', 'would', 'could', 'should', 'may', 'might', 'must', 'can'))::INT)::BIGINT AS modals FROM t GROUP BY item_id")
def tagged_words(spark, d):
    """Tokens and modals by the rules that stand in for a model."""
    found = linguistic.tokens(load(spark, d, "benchmark"), "item_id", "text")
    return found.groupBy("item_id").agg(F.count("*").alias("n"), F.sum((F.col("tag") == "MD").cast("int")).alias("modals"))


@query(f"SELECT doc_id, count(*) AS n, sum((label = 'O')::INT)::BIGINT AS words FROM (SELECT doc_id, unnest(list_append(list_transform({LOWER}, lambda x: 'O'), ' ')) AS label FROM documents) GROUP BY doc_id")
def labelling_rows(spark, d):
    r = linguistic.labelling_rows(load(spark, d, "documents").select("doc_id", F.lower("text").alias("text")), "doc_id", "text")
    return r.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum((F.col("label") == "O").cast("int")).alias("words"))
