"""Queries on what is written and read back: delimited text, records, tags, batches, versions, stores; and more of providers and tokens."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import corpus, frames, linguistic, matching, providers, sequences, similarity
from ..sources import pages as pg
from ..sources import readers, writers
from ..streaming import arrivals
from .catalog import LOWER, TOKENS, load, query


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def delimited_round_trip(spark, d):
    """Tab-separated text written with a version and read again."""
    folder = writers.scratch(spark)
    n = load(spark, d, "nation")
    n.write.option("header", True).option("sep", "\t").option("encoding", "ISO-8859-1").option("compression", "gzip").csv(f"{folder}/n")
    return readers.delimited(spark, f"{folder}/n", "n_nationkey INT, n_name STRING, n_regionkey INT", encoding="ISO-8859-1")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def json_round_trip(spark, d):
    """Records as lines of JSON, written and read again."""
    path = writers.versioned(load(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal"), writers.scratch(spark), "customers", "json", 1)
    return readers.json_records(spark, path, "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE")


@query("SELECT r_regionkey, r_name FROM region")
def json_array(spark, d):
    """A file that is one array of records."""
    path = f"{writers.scratch(spark)}/r"
    rows = load(spark, d, "region").agg(F.to_json(F.collect_list(F.struct("r_regionkey", "r_name"))).alias("x"))
    rows.coalesce(1).write.text(path)
    return readers.json_records(spark, path, "r_regionkey INT, r_name STRING", lines=False)


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer")
def json_elements(spark, d):
    """Arrays of records, in as many files as the table has parts, cut at their records."""
    path = f"{writers.scratch(spark)}/c"
    c = load(spark, d, "customer").select(F.col("c_custkey") % 4, F.struct("c_custkey", "c_name", "c_mktsegment").alias("r"))
    c.groupBy(F.col(c.columns[0]).alias("k")).agg(F.to_json(F.collect_list("r")).alias("x")).select("x").write.text(path)
    return readers.json_elements(spark, path, "c_custkey BIGINT, c_name STRING, c_mktsegment STRING", '{"c_custkey":')


@query("SELECT o_orderkey, o_totalprice, (o_orderkey % 3)::BIGINT AS batch FROM orders")
def arrived_batches(spark, d):
    """Files that arrive in three parts, taken in by a stream that is started again after each."""
    folder, schema = writers.scratch(spark), "o_orderkey BIGINT, o_totalprice DOUBLE"
    o = load(spark, d, "orders").select("o_orderkey", "o_totalprice")
    for k in range(3):
        o.where(F.col("o_orderkey") % 3 == k).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        arrivals.take_in(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/checkpoint")
    return arrivals.taken(spark, f"{folder}/out", schema)


@query("SELECT n_name AS term, CASE WHEN n_nationkey % 2 = 0 THEN 'B-p_s' ELSE 'O' END AS tag, n_nationkey // 5 AS sentence FROM nation")
def tagged_file(spark, d):
    """Tagged words of a file in which blank lines end sentences (S3)."""
    path = f"{writers.scratch(spark)}/t"
    n = F.col("n_nationkey")
    line = F.concat_ws("\t", n.cast("string"), "n_name", F.when(n % 2 == 0, "B-p_s").otherwise("O"))
    lines = load(spark, d, "nation").select(n.alias("k"), F.when(n % 5 == 4, F.concat(line, F.lit("\n"))).otherwise(line).alias("x"))
    lines.coalesce(1).sortWithinPartitions("k").select("x").write.text(path)  # one file, 25 rows
    return readers.tagged_tokens(spark, path).select("term", "tag", F.col("sentence").cast("int").alias("sentence"))


@query("SELECT o_orderkey, (o_orderkey % 4)::INT AS batch FROM orders WHERE o_orderkey % 4 BETWEEN 1 AND 2")
def batch_range(spark, d):
    """Some of the batches that were written."""
    folder = writers.scratch(spark)
    o = load(spark, d, "orders").select("o_orderkey")
    for k in range(4):
        writers.append_batch(o.where(F.col("o_orderkey") % 4 == k), folder, "prediction", k)
    return readers.batches(spark, folder, "prediction", 1, 2).select("o_orderkey", F.col("batch").cast("int").alias("batch"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'prediction' ELSE 'observation' END AS kind, (o_orderkey % 3)::INT AS batch FROM orders")
def logged_batches(spark, d):
    """Rows by kind and batch (K9)."""
    folder = writers.scratch(spark)
    o = load(spark, d, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").cast("int").alias("sentence_label"), (F.col("o_orderkey") % 3).alias("batch_id"))
    writers.log_batches(o, folder)
    return spark.read.parquet(folder).select("o_orderkey", "kind", F.col("batch").cast("int").alias("batch"))


@query("SELECT doc_id, 2 * doc_id AS done FROM documents")
def resumed_job(spark, d):
    """A job that was ended half-way and run again."""
    folder = writers.scratch(spark)
    docs = load(spark, d, "documents").select("doc_id")
    work = lambda left: left.withColumn("done", 2 * F.col("doc_id"))
    writers.append_pending(docs.where("doc_id % 2 = 0"), folder, "doc_id", work, "doc_id BIGINT, done BIGINT")
    writers.append_pending(docs, folder, "doc_id", work, "doc_id BIGINT, done BIGINT")
    return spark.read.parquet(folder)


@query("SELECT (max(c_custkey) FILTER (c_custkey % 3 <> 1) + 1)::INT AS next, (max(c_nationkey) + 1)::INT AS dated, 'run_v' || (CASE WHEN count(*) FILTER (c_nationkey = 0) = 0 THEN '1' ELSE '2' END) AS free FROM customer")
def next_names(spark, d):
    """The next version, the next of a date, and a free name (K2-K4)."""
    k, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    version = F.concat(F.lit("metrics-"), F.when(F.col("c_custkey") % 3 == 0, "v").when(F.col("c_custkey") % 3 == 1, "old").otherwise(""), k, F.lit(".csv"))
    # ``run`` is taken by all, ``run_v1`` where there is a nation 0.
    taken = F.when(F.col("c_nationkey") == 0, "run_v1").otherwise("run")
    names = load(spark, d, "customer").select(F.explode(F.array(version, F.concat(F.lit("v"), nation, F.lit("_2024-01-01")), taken)).alias("name"))
    both = writers.next_version(names, "metrics").withColumnRenamed("version", "next")
    return both.withColumns({"dated": writers.next_dated(names, "", "2024-01-01").scalar(), "free": F.lit(writers.free_name(names, "run"))})


@query("SELECT n_nationkey || ' & ' || replace(n_name, '_', '\\_') || ' \\\\' AS value FROM nation")
def latex_table(spark, d):
    """A table's rows in LaTeX."""
    return writers.latex_rows(load(spark, d, "nation").select("n_nationkey", "n_name"))


@query("SELECT term, n FROM (SELECT term, count(*) AS n FROM (SELECT unnest(" + LOWER + ") AS term FROM benchmark) GROUP BY term) WHERE n > 3 UNION ALL SELECT '< unk >', count(*) FROM (SELECT term, count(*) AS n FROM (SELECT unnest(" + LOWER + ") AS term FROM benchmark) GROUP BY term) WHERE n <= 3")
def vocabulary_file(spark, d):
    """A vocabulary as tab-separated text without a header."""
    path = f"{writers.scratch(spark)}/v"
    writers.without_header(sequences.vocabulary(load(spark, d, "benchmark").select(F.explode(tx.tokens(F.lower("text"))).alias("word"))), path)
    return readers.delimited(spark, path, "term STRING, n BIGINT", header=False)


@query("SELECT vec_id, len(embedding)::INT AS width FROM embeddings")
def stored_vectors(spark, d):
    """A store of vectors, written and opened again."""
    folder = writers.scratch(spark)
    matching.Store(load(spark, d, "embeddings")).write(folder)
    return matching.Store.read(spark, folder).vectors.select("vec_id", F.size("embedding").alias("width"))


@query("SELECT conv_id, sentence FROM (SELECT conv_id, trim(unnest(string_split(t, '.')), ' ') AS sentence FROM (SELECT conv_id, string_agg(text, ' ' ORDER BY turn) AS t FROM conversations GROUP BY conv_id)) WHERE sentence <> ''")
def transcript_sentences(spark, d):
    """Sentences of transcripts from their timed pieces."""
    return pg.transcript_sentences(load(spark, d, "conversations"), "conv_id", "turn", "text").select("conv_id", "sentence")


@query("SELECT n_name AS title, n_regionkey AS points, 'forum' AS site FROM nation")
def search_hits(spark, d):
    """Rows of a search service's answers."""
    hit = F.struct(F.struct(F.col("n_name").alias("title"), F.col("n_regionkey").alias("points")).alias("_source"))
    body = load(spark, d, "nation").select(F.to_json(F.struct(F.struct(F.array(hit).alias("hits")).alias("hits"))).alias("body"))
    return pg.hits(body, "body", "title STRING, points INT", "forum")


@query("SELECT url FROM (SELECT DISTINCT url FROM pages WHERE regexp_matches(url, '(?i)EXAMPLE')) ORDER BY url DESC LIMIT 7")
def newest_names(spark, d):
    """The last names that match a pattern."""
    return pg.newest(load(spark, d, "pages"), "url", "EXAMPLE", 7)


@query("""SELECT c_custkey, 12 AS item, CASE WHEN c_custkey % 3 = 0 THEN '02000-02050' WHEN c_custkey % 3 = 1 THEN '0' || (2000 + c_nationkey) || '-???' ELSE '' END AS dates, CASE WHEN c_custkey % 2 = 0 THEN '$' || c_custkey || ',000 $5' ELSE '' END AS stakes FROM customer
UNION ALL SELECT c_custkey, (c_nationkey + 100)::INT, '', '$7' FROM customer WHERE c_custkey % 4 = 0""")
def scraped_items(spark, d):
    """Numbered list items, each number once."""
    k, nation = F.col("c_custkey"), F.col("c_nationkey")
    dates = F.when(k % 3 == 0, "50 years 02000-02050").when(k % 3 == 1, F.concat(F.lit("? 0"), (2000 + nation).cast("string"), F.lit("-???"))).otherwise("soon")
    stakes = F.when(k % 2 == 0, F.concat(F.lit("$"), k.cast("string"), F.lit(",000 $5"))).otherwise("nothing")
    second = F.when(k % 4 == 0, F.concat(F.lit("<li>"), (nation + 100).cast("string"), F.lit(". for $7</li>"))).otherwise("")
    html = F.concat(F.lit("<ul><li>12. "), "c_name", F.lit(" "), dates, F.lit(" "), stakes, F.lit("</li><li>12. again</li>"), second, F.lit("<li>none</li></ul>"))
    return pg.item_records(load(spark, d, "customer").select("c_custkey", html.alias("html")), id_col="c_custkey").select("c_custkey", "item", "dates", "stakes")


@query("WITH r AS (SELECT c_custkey, c_name, c_mktsegment, unnest(range(1, (c_custkey % 4)::INT + 1))::INT AS pos FROM customer) SELECT c_custkey, pos, c_name || pos AS a, CASE WHEN pos < 3 THEN c_mktsegment END AS b FROM r")
def labelled_columns(spark, d):
    """Columns from spans by class, without the row of headers; some have fewer."""
    span = lambda c, x: F.concat(F.lit(f'<span class="{c}">'), x, F.lit("</span>"))
    each = F.transform(F.expr("slice(array(1, 2, 3), 1, cast(c_custkey % 4 as int))"), lambda i: F.concat(span("a", F.concat("c_name", i.cast("string"))), F.when(i < 3, span("b", F.col("c_mktsegment"))).otherwise("")))
    html = F.concat(span("a", F.lit("A")), span("b", F.lit("B")), F.array_join(each, ""))
    return pg.labelled_columns(load(spark, d, "customer").select("c_custkey", html.alias("html")), ["a", "b"], id_col="c_custkey")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN name ELSE upper(name) END AS rephrased FROM (SELECT c_custkey, c_mktsegment || ' ' || c_custkey AS name FROM customer)")
def rephrased_queries(spark, d):
    """A query as a provider puts it, or as it is where the provider has nothing to say."""
    asked = load(spark, d, "customer").select("c_custkey", F.concat_ws(" ", "c_mktsegment", F.col("c_custkey").cast("string")).alias("q"))
    loud = lambda prompts: [" \n\n" if int(p.split()[1]) % 3 == 0 else f"\n  {p.upper()} \nmore" for p in prompts]
    return providers.rephrased(asked, "q", loud).select("c_custkey", "rephrased")


@query("SELECT vec_id, (pos - 1)::INT AS place, embedding[pos] AS x FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS pos FROM embeddings)")
def array_rows(spark, d):
    """Arrays as rows."""
    return load(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("place", "x"))


WORDS = ("prices", "cities", "news", "buses", "glasses", "was", "has", "rose", "status", "analysis", "boxes", "is")
LEMMAS = ("price", "city", "news", "bus", "glass", "be", "have", "rise", "status", "analysis", "box", "be")


@query("WITH w AS (SELECT c_custkey, [" + ", ".join(f"'{x}'" for x in LEMMAS) + "] AS l, lower(c_mktsegment) AS s FROM customer) SELECT c_custkey, 'the ' || l[c_custkey % 12 + 1] || ' of ' || s || ' ' || l[c_custkey // 12 % 12 + 1] || ' .' AS lemmas FROM w")
def lemmatized_texts(spark, d):
    """Texts as lemmas by rules."""
    k = F.col("c_custkey")
    pick = lambda i: F.get(F.array(*map(F.lit, WORDS)), (i % 12).cast("int"))
    text = F.concat(F.lit("The "), pick(k), F.lit(" of "), F.lower("c_mktsegment"), F.lit(" "), pick(F.floor(k / 12)), F.lit("."))
    return linguistic.lemmatized(load(spark, d, "customer").select("c_custkey", text.alias("text")), "c_custkey", "text")


@query("SELECT c_custkey, (c_custkey % 3 = 0)::INT + (c_custkey % 5 = 0)::INT AS aux, 1 + (c_custkey % 2)::INT AS num, 1 + (c_custkey % 4)::INT AS punct FROM customer")
def tag_counts(spark, d):
    """How often each part of speech is in a text (L1, L4)."""
    k = F.col("c_custkey")
    text = F.concat(F.lit("prices "), F.when(k % 3 == 0, "will ").otherwise(""), F.when(k % 5 == 0, "may ").otherwise(""), F.lit("rise by "), k.cast("string"), F.when(k % 2 == 1, " to 7").otherwise(""), F.repeat(F.lit(" !"), (k % 4 + 1).cast("int")))
    t = linguistic.tokens(load(spark, d, "customer").select("c_custkey", text.alias("text")), "c_custkey", "text")
    out = frames.matrix(t.groupBy("c_custkey", "pos").agg(F.count("*").cast("int").alias("n")), "c_custkey", "pos", "n", ["AUX", "NUM", "PUNCT"], F.max)
    return out.select("c_custkey", F.col("AUX").alias("aux"), F.col("NUM").alias("num"), F.col("PUNCT").alias("punct"))


@query(r"SELECT shape, count(*) AS n FROM (SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[a-z]', 'x', 'g'), '[A-Z]', 'X', 'g'), '[0-9]', 'd', 'g'), '(x{4})x+|(X{4})X+|(d{4})d+', '\1\2\3', 'g') AS shape FROM (SELECT unnest(" + TOKENS.format("s") + ") AS t FROM (SELECT unnest(list_filter(list_transform(string_split(text, '.'), lambda x: trim(x, ' ')), lambda x: x <> '')) AS s FROM documents))) GROUP BY shape")
def sentence_shapes(spark, d):
    """Shapes of the words of sentences."""
    s = load(spark, d, "documents").select(F.explode(tx.sentences(F.col("text"))).alias("s"))
    return s.select(F.explode(tx.tokens(F.col("s"))).alias("t")).groupBy(tx.shape(F.col("t")).alias("shape")).agg(F.count("*").alias("n"))


@query(f"SELECT d.doc_id, len(list_filter({LOWER}, lambda x: x = 'the'))::BIGINT AS the, len(list_filter({LOWER}, lambda x: x = 'les'))::BIGINT AS les, coalesce(l.quality, -1)::INT AS label FROM documents d LEFT JOIN labels l USING (doc_id)")
def feature_scores(spark, d):
    """Terms as columns beside the text's id and label."""
    docs = load(spark, d, "documents").select("doc_id", "text")
    terms = frames.matrix(corpus.term_counts(docs).where(F.col("term").isin("the", "les")), "doc_id", "term", "tf", ["the", "les"])
    out = docs.select("doc_id").join(terms, "doc_id", "left").join(load(spark, d, "labels").select("doc_id", F.col("quality").alias("label")), "doc_id", "left")
    return out.na.fill({"the": 0, "les": 0, "label": -1})


@query("SELECT item_id, text, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 5) AS score FROM benchmark JOIN embeddings a ON a.vec_id = item_id JOIN embeddings b ON b.vec_id = item_id + 1")
def result_pairs(spark, d):
    """Found texts with their scores as typed pairs."""
    v = load(spark, d, "embeddings")
    a, b = v.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("a")), v.select((F.col("vec_id") - 1).alias("item_id"), F.col("embedding").alias("b"))
    pair = F.struct("text", similarity.cosine(F.col("a"), F.col("b")).alias("score")).alias("x")
    return load(spark, d, "benchmark").join(a, "item_id").join(b, "item_id").select("item_id", pair).select("item_id", "x.text", F.round("x.score", 5).alias("score"))
