"""Queries on parsed sentences: morphology, subtrees, graphs; lenient files, marked-up files, trees of decisions, judged matches."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import agreement, learning, matching, trees
from ..sources import readers, writers
from .catalog import LOWER, TOKENS, load, query
from .corpora import SEARCH, lexical

#: Sentences of documents, numbered from 0.
CUT = "c AS (SELECT doc_id, unnest(l) AS s, unnest(range(len(l)))::INT AS k FROM (SELECT doc_id, list_filter(list_transform(string_split(text, '.'), lambda x: trim(x, ' ')), lambda x: x <> '') AS l FROM documents)), "


def sentences(spark, d) -> DataFrame:
    return load(spark, d, "documents").select("doc_id", F.posexplode(tx.sentences(F.col("text"))).alias("k", "s"))


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


CLOSED = "MAP {" + ", ".join(f"{_quoted(k)}: {_quoted(v)}" for k, v in tx.MORPHS.items()) + "}"
OPEN = " ".join(f"WHEN regexp_full_match(lower(t), {_quoted(p)}) THEN {_quoted(v)}" for p, v in tx.FORMS)
SHAPE = "regexp_replace(regexp_replace(regexp_replace(regexp_replace(t, '[a-z]', 'x', 'g'), '[A-Z]', 'X', 'g'), '[0-9]', 'd', 'g'), '(x{4})x+|(X{4})X+|(d{4})d+', '\\1\\2\\3', 'g')"


@query(f"WITH {CUT} w AS (SELECT unnest(regexp_extract_all(s, '[\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}\\s]')) AS t FROM c) SELECT shape, morph, count(*) AS n FROM (SELECT {SHAPE} AS shape, coalesce(({CLOSED})[lower(t)], CASE {OPEN} ELSE '' END) AS morph FROM w) GROUP BY ALL")
def sentence_morphology(spark, d):
    """Shapes and features of the words of sentences."""
    t = sentences(spark, d).select(F.explode(tx.terms(F.col("s"))).alias("t")).groupBy("t").agg(F.count("*").alias("n"))  # each form's rules once
    return t.groupBy(tx.shape(F.col("t")).alias("shape"), tx.morphology(F.col("t")).alias("morph")).agg(F.sum("n").alias("n"))


#: A word's head is the next longer word of the classes under 8, under 12 and of 12 letters or more.
WORDED = f"WITH {CUT} v AS (SELECT doc_id, k, {TOKENS.format('s')} AS l FROM c), w AS (SELECT doc_id, k, unnest(l) AS term, unnest(range(len(l)))::INT AS pos FROM v), z AS (SELECT *, (length(term) >= 8)::INT + (length(term) >= 12)::INT AS class FROM w), "
NEXT = "min(pos) FILTER (class {}) OVER (PARTITION BY doc_id, k ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)"
PREVIOUS = "coalesce(max(pos) FILTER (class {}) OVER (PARTITION BY doc_id, k ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1, 0)"


def reached(spark, d) -> DataFrame:
    """``doc_id, k, terms, heads, first_pos, last_pos``: sentences with the reach of each word's subtree; no row is moved."""
    words = sentences(spark, d).select("doc_id", "k", tx.tokens(F.col("s")).alias("terms"))
    return trees.sentence_edges(words.withColumn("heads", trees.heads_by_length(F.col("terms"))))


@query(WORDED.rstrip(", ") + f" SELECT doc_id, k, pos, CASE class WHEN 0 THEN pos WHEN 1 THEN {PREVIOUS.format('>= 1')} ELSE {PREVIOUS.format('>= 2')} END::INT AS first_pos, pos AS last_pos FROM z")
def subtree_edges(spark, d):
    """The first and last word of each word's subtree."""
    places = F.transform("first_pos", lambda _, i: i)
    return reached(spark, d).select("doc_id", "k", F.inline(F.arrays_zip(places.alias("pos"), F.col("first_pos"), F.col("last_pos"))))


@query(WORDED + f"""u AS (SELECT *, CASE WHEN class = 2 THEN pos ELSE {NEXT.format('>= 2')} END AS top, CASE class WHEN 0 THEN {NEXT.format('>= 1')} WHEN 1 THEN {NEXT.format('>= 2')} END AS head FROM z),
p AS (SELECT *, dense_rank() OVER (PARTITION BY doc_id, k ORDER BY coalesce(top, pos)) - 1 AS place FROM u),
m AS (SELECT doc_id, k, place, string_agg(term, ' ' ORDER BY pos) AS term, count(*) AS n, CASE WHEN min(top) IS NULL THEN min(head) END AS head FROM p GROUP BY doc_id, k, place)
SELECT m.doc_id, m.k, m.place::INT AS place, m.term, m.n, p.place::INT AS head FROM m LEFT JOIN p ON p.doc_id = m.doc_id AND p.k = m.k AND p.pos = m.head""")
def merged_subtrees(spark, d):
    """Sentences in which the subtrees of the longest words are single tokens."""
    made = trees.merged_in_sentences(reached(spark, d), F.transform("terms", lambda w: F.length(w) >= 12))
    # As an expression: of a bare column Spark first asks whether it is empty, and works all of it out once more for that.
    return made.select("doc_id", "k", F.inline(F.coalesce("merged", F.array())))


@query(WORDED + """g AS (SELECT *, CASE WHEN regexp_matches(term, '^[A-Z]') THEN 'PROPN' WHEN regexp_matches(term, 's$') THEN 'VERB' WHEN length(term) > 3 THEN 'NOUN' END AS tag FROM z),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, k, tag ORDER BY pos) AS i FROM g),
x AS (SELECT doc_id, k, max(term) FILTER (tag = 'PROPN' AND i = 1) AS source, max(term) FILTER (tag = 'VERB' AND i = 1) AS relation, max(term) FILTER (tag = 'NOUN' AND i = 1) AS outcome, max(term) FILTER (tag = 'PROPN' AND i = 3) AS target FROM r GROUP BY doc_id, k),
e AS (SELECT doc_id, k, source AS a, outcome AS b, relation FROM x UNION ALL SELECT doc_id, k, outcome, target, NULL FROM x)
SELECT a, b, arg_max(relation, doc_id * 1000000 + k) AS relation FROM e WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY a, b""")
def relation_graph(spark, d):
    """The graph of sources, outcomes and targets, tags by form."""
    term = F.col("term")
    tag = F.when(term.rlike("^[A-Z]"), "PROPN").when(term.rlike("s$"), "VERB").when(F.length(term) > 3, "NOUN")
    words = sentences(spark, d).select("doc_id", "k", F.posexplode(tx.tokens(F.col("s"))).alias("pos", "term")).withColumn("tag", tag)
    return trees.relation_edges(words, ["doc_id", "k"])


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 1 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0")
def tolerated_lines(spark, d):
    """Compressed lines, some too long, which are left out, and some too short, which stay."""
    o = load(spark, d, "orders")
    key = F.col("o_orderkey")
    end = F.when(key % 5 == 1, "").otherwise(F.concat(F.lit(","), "o_orderstatus"))
    more = F.when(key % 7 == 0, F.when(key % 5 == 1, ",a,b").otherwise(",more")).otherwise("")
    path = writers.scratch(spark)
    o.select(F.concat(key.cast("string"), F.lit(","), F.col("o_custkey").cast("string"), end, more)).write.option("compression", "gzip").text(path)
    return readers.tolerant(spark, path, "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING", header=False)


@query(r"SELECT trim(regexp_replace(regexp_replace('DOC ' || item_id || ' ' || text, '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM benchmark")
def marked_up_items(spark, d):
    """Texts of files with a prolog and tags, one file a text."""
    words = tx.pieces(F.col("text"))
    marked = F.array_join(F.transform(words, lambda w, i: F.when(i % 3 == 1, F.concat(F.lit("<EVENT\nid='1'>"), w, F.lit("</EVENT>"))).otherwise(w)), "\n")
    doc = F.concat(F.lit("<?xml version='1.0' ?>\n<TimeML><DOCID>DOC "), F.col("item_id").cast("string"), F.lit("</DOCID>\n"), marked, F.lit("\n</TimeML>"))
    path = writers.scratch(spark)
    load(spark, d, "benchmark").select("item_id", doc.alias("value")).repartition("item_id").write.partitionBy("item_id").text(path)
    return readers.marked_up_text(spark, path).select("text")


@query()
def tree_models(spark, d):
    """A tree, a forest and boosted trees on the vectors' parity of labels, learned on four fifths: metrics on the rest."""
    names = ["decision_tree", "random_forest", "gradient_boosting"]
    v = load(spark, d, "embeddings").withColumn("y", (F.col("label") % 2).cast("int"))
    dealt = learning.features(v, "embedding", "y").withColumn("part", F.crc32(F.col("vec_id").cast("string").cast("binary")) % 5).persist()
    found = learning.predict_all(dealt.where("part = 0"), learning.train_all(dealt.where("part <> 0"), names), ["vec_id", "y"])
    return agreement.binary_metrics(agreement.confusion(found, "y", names))


@query("SELECT label AS cluster, place, n, round(x, 6) AS x FROM (SELECT label, (i - 1)::INT AS place, count(*) AS n, avg(embedding[i]::DOUBLE) AS x FROM embeddings, range(1, 65) r(i) WHERE label IS NOT NULL AND i <= len(embedding) GROUP BY label, i)")
def cluster_slices(spark, d):
    """Clusters cut apart and put together again, and the mean of each by place."""
    v = load(spark, d, "embeddings").select(F.col("label").alias("cluster"), "embedding").where("cluster is not null")
    named = [r.cluster for r in v.select("cluster").distinct().orderBy("cluster").limit(1000).collect()]  # clusters, not rows
    again = reduce(DataFrame.unionByName, learning.slices(v, named).values())
    return learning.centroids(again, "embedding").select("cluster", "n", F.posexplode("centroid").alias("place", "x")).withColumn("x", F.round("x", 6))


@query(SEARCH + f"SELECT query_id, l.doc_id, 1 AS label FROM l JOIN benchmark ON item_id = query_id JOIN documents d ON d.doc_id = l.doc_id WHERE r <= 10 AND contains(lower(d.text), array_to_string(list_slice({LOWER.replace('text', 'benchmark.text')}, 1, 6), ' '))")
def certified_matches(spark, d):
    """Found texts that a judge accepts, here if they have the forecast's first six words: candidates come from a search."""
    asked = load(spark, d, "benchmark").select(F.col("item_id").alias("query_id"), F.array_join(F.slice(tx.tokens(F.lower("text")), 1, 6), " ").alias("begin"))
    seen = load(spark, d, "documents").select("doc_id", F.lower("text").alias("seen"))
    found = F.broadcast(lexical(spark, d, 10).join(asked, "query_id"))  # ten a query, so that texts stay where they are
    pairs = seen.join(found, "doc_id")
    return matching.certified(pairs, F.contains("seen", "begin").cast("int")).select("query_id", "doc_id", "label")
