"""Hand-checkable cases of forecast reading, sequences, likeness, pages, models and writers."""

import json
import tempfile

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from omenflow.functions import forecasts as fc
from omenflow.functions import text as tx
from omenflow.operators import agreement, learning, providers, rows, sequences, similarity
from omenflow.plans import catalog
from omenflow.sources import pages, writers

SF = "/root/testdata/sf0.001"


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "x string").select(fn(F.col("x"))).first()[0]


def test_templates(spark):
    texts = [
        ("T1: On [2024-10-15], [Ann] predicts that the [revenue] at [Acme] [will] [rise] by [5%] in [Q3 2027].",),
        ("T4: According to a [report] from [Ann], on [May 1], the [sales] [will] [rise] beyond [5%] in the timeframe of [2027].",),
        ("T1: no brackets",), ("no template",), (None,),
    ]
    got = fc.template_fields(fc.with_template(spark.createDataFrame(texts, "text string"))).collect()
    by = {r.template: r.asDict() for r in got}
    assert sorted(by) == [1, 4] and len(got) == 2
    assert [by[1][k] for k in (*fc.FIELDS, "p_f", "p_l")] == ["2024-10-15", "Ann", "revenue", "Acme", "will", "rise", "5%", "Q3 2027", None]
    assert by[4]["p_v"] == "5%" and by[4]["p_f"] == "2027"
    with pytest.raises(PySparkException):
        fc.template_fields(spark.createDataFrame([("x", 6)], "text string, template int")).collect()


def test_reading(spark):
    assert one(spark, "it's  what I'm", lambda c: tx.expand(c, fc.CONTRACTIONS)) == "it is what I am"
    assert one(spark, "Ślusàrski", fc.ascii_letters) == "Slusarski"
    assert one(spark, "{0: ['a', 'b'], '1': ['c']}", fc.python_lists) == {"0": "a, b", "1": "c"}
    assert one(spark, "{'handle': 'x', 'followers': 3}", lambda c: fc.quoted_json(c, "handle STRING, followers INT")).asDict() == {"handle": "x", "followers": 3}
    assert one(spark, "by 21 August 2024 or Q3 of 2027", fc.dates_in) == ["21 August 2024", "Q3 of 2027"]
    assert one(spark, "a $2,000 $500 b", fc.stakes) == "$2,000 $500"
    assert one(spark, "[0.5 -1]", fc.printed_vector) == [0.5, -1.0]
    assert one(spark, None, lambda c: fc.keyword_query(c, [["NFL"]])) is False
    assert one(spark, "abcdef", lambda c: fc.shortened(c, 3)) == "abc..."
    pair = spark.createDataFrame([("MARTHA", "MARHTA"), ("", "x"), (None, "x")], "a string, b string").select(F.round(fc.jaro_winkler("a", "b"), 4)).collect()
    assert [r[0] for r in pair] == [0.9611, 0.0, None]


def test_viterbi_beats_greedy(spark):
    words = spark.createDataFrame([(1, 0, "x"), (1, 1, "y")], "sequence long, pos long, word string")
    move = {("a", "a"): 0.1, ("a", "b"): 0.1, ("b", "b"): 0.9}
    says = {("a", "x"): 0.6, ("b", "x"): 0.4, ("a", "y"): 0.5, ("b", "y"): 0.5}
    model = spark.createDataFrame([(*k, p) for k, p in move.items()], "state string, next_state string, p double"), spark.createDataFrame([(*k, p) for k, p in says.items()], "tag string, word string, p double")
    tags = lambda greedy: [r.tag for r in sequences.decode(words, *model, greedy).orderBy("pos").collect()]
    assert tags(True) == ["a", "a"] and tags(False) == ["b", "b"]


def test_path_probability(spark):
    paths = spark.createDataFrame([(1, 0, "t"), (1, 1, "i"), (1, 2, "p"), (2, 0, "t"), (2, 1, "z")], "path long, pos int, state string")
    moves = spark.createDataFrame([("t", "i", 0.3), ("i", "p", 0.6)], "state string, next_state string, p double")
    got = {r.path: round(r.p, 6) for r in sequences.path_probability(paths, moves).collect()}
    assert got == {1: 0.18, 2: 0.0}


def test_varied_takes_the_other_direction(spark):
    found = spark.createDataFrame([(0, [1.0, 1.0], 1, [1.0, 0.9]), (0, [1.0, 1.0], 2, [1.0, 0.9]), (0, [1.0, 1.0], 3, [0.0, 1.0])], "query_id long, query array<double>, vec_id long, embedding array<double>")
    got = [r.vec_id for r in similarity.varied(found, 2).orderBy("rank").collect()]
    assert got == [1, 3]


def test_likeness_edges(spark):
    df = spark.createDataFrame([([0.0, 0.0], [1.0, 2.0], "", "")], "a array<double>, b array<double>, s string, t string")
    r = df.select(similarity.cosine(F.col("a"), F.col("b")), similarity.dice(F.col("s"), F.col("t")), similarity.pearson(F.col("a"), F.col("b"))).first()
    assert tuple(r) == (0.0, 0.0, None)


def test_hybrid_and_prompts(spark):
    s = "query_id long, doc_id long, score double"
    both = similarity.hybrid(spark.createDataFrame([(1, 7, 0.2), (1, 8, 0.5)], s), spark.createDataFrame([(1, 7, 0.9)], s))
    assert [(r.doc_id, r.score) for r in both.orderBy("rank").collect()] == [(7, 0.9), (8, 0.5)]
    asked = both.withColumns({"text": F.col("doc_id").cast("string"), "question": F.lit("why?")})
    assert similarity.prompts(asked, "question", "text", "Use:").first().prompt == "Use:\n - 7\n - 8\nwhy?"


def test_votes(spark):
    j = spark.createDataFrame([(1, "a", 1), (1, "b", 1), (1, "c", 0), (2, "a", 1), (2, "b", 0), (3, "a", None), (3, "b", 1)], "id int, model string, label int")
    assert {r.id: r.vote for r in providers.voted(j, "id").collect()} == {1: "1", 2: "None as all are different labels", 3: "None as all are different labels"}


def test_generated_lines(spark):
    keys = spark.createDataFrame([("finance", "p")], "domain string, prompt string")
    got = providers.generated(keys, "prompt", lambda prompts: [" one \n\ntwo" for _ in prompts], 1, batch_id=3).orderBy("base_sentence").collect()
    assert [(r.domain, r.base_sentence, r.sentence_label, r.batch_id) for r in got] == [("finance", "one", 1, 3), ("finance", "two", 1, 3)]


def test_pages(spark):
    html = '<ul><li>a <b>c</b></li></ul><p class="x">one\n two</p><pre>no</pre><a href="/x">l</a><a href="http://o/y">m</a><a href="/x">l</a>'
    p = spark.createDataFrame([("http://h.org/p?q", html), ("none", None)], "url string, html string")
    assert [r[0] for r in p.select(pages.paragraphs(F.col("html"))).collect()] == [["one two"], []]
    assert {r.link for r in pages.links(p).collect()} == {"http://h.org/x", "http://o/y"}
    body = json.dumps({"hits": {"hits": [{"_source": {"text": "t", "n": 2}}]}})
    got = pages.hits(spark.createDataFrame([(body,)], "body string"), "body", "text: STRING, n: INT", "s").collect()
    assert [tuple(r) for r in got] == [("t", 2, "s")]
    segs = spark.createDataFrame([("v", 2.0, "c. d"), ("v", 1.0, "a b")], "video string, start double, text string")
    assert [r.sentence for r in pages.transcript_sentences(segs, "video", "start", "text").orderBy("pos").collect()] == ["a b c", "d"]


def test_experiments_keep_the_last_version(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    for version, accuracy in (("seed7", 0.1), ("seed7_v2", 0.3), ("seed7_v10", 0.5), ("seed33", 0.7)):
        spark.createDataFrame([("m", accuracy)], "model string, accuracy double").coalesce(1).write.option("header", True).csv(f"{folder}/run-2025-01-02/{version}/metrics_summary.csv")
    # Spark writes folders; the reader looks for files of the name, which a copy gives.
    import glob
    import shutil

    for part in glob.glob(f"{folder}/*/*/metrics_summary.csv/part-*.csv"):
        shutil.move(part, part.rsplit("/", 2)[0] + "/found.csv")
    import os

    for found in glob.glob(f"{folder}/*/*/found.csv"):
        top = found.rsplit("/", 1)[0]
        os.rename(f"{top}/metrics_summary.csv", f"{top}/_old")
        os.rename(found, f"{top}/metrics_summary.csv")
    got = {r.seed: r.accuracy for r in pages.experiments(spark, folder).collect()}
    assert got == {7: 0.5, 33: 0.7}


def test_writers(spark):
    folder = tempfile.mkdtemp(prefix="spark-")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, x string")
    assert writers.versioned(df, folder, "t", "csv", 2).endswith("/t-v2")
    with pytest.raises(PySparkException):
        writers.versioned(df, folder, "t", "csv", 2)
    with pytest.raises(ValueError):
        writers.versioned(df, folder, "t", "xml")
    done = lambda left: left.withColumn("x", F.upper("x"))
    writers.append_pending(df.where("id = 1"), f"{folder}/out", "id", done, "id long, x string")
    writers.append_pending(df, f"{folder}/out", "id", done, "id long, x string")
    assert sorted((r.id, r.x) for r in spark.read.parquet(f"{folder}/out").collect()) == [(1, "A"), (2, "B")]
    lines = spark.createDataFrame([("a| b",), ("INFO x|y",)], "value string")
    assert [r.fields for r in writers.from_log_lines(lines, ["INFO"], "|").collect()] == [["a", "b"]]


def test_positions_and_auc(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k"))
    assert df.count() == rows.positioned(df, "k").where("pos = k").count()
    s = spark.createDataFrame([(1, 2.0), (0, 1.0), (1, 1.0), (0, 0.0)], "y int, s double")
    assert agreement.auc(s, "y", "s").first().auc == 0.875


def test_models(spark, tmp_path):
    with pytest.raises(ValueError):
        learning.model("unknown")
    df = spark.createDataFrame([(i, [float(i % 2), float(i)], i % 2) for i in range(40)], "id long, v array<float>, y int")
    x = learning.features(df, "v", "y")
    fitted = learning.train_all(x, ["logistic_regression", "ridge"])
    learning.save_all(fitted, str(tmp_path))
    got = learning.predict_all(x, learning.load_all(str(tmp_path), list(fitted)), ["id", "y"])
    assert got.where("y <> logistic_regression or y <> ridge").count() == 0


@pytest.mark.parametrize("name", ["varied_search", "classifiers", "cross_validation", "vector_clusters", "cluster_centroids", "principal_components", "document_topics"])
def test_queries_without_sql_have_rows(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0


def test_linguistic_rules(spark):
    df = spark.createDataFrame([(1, "Acme Corp will pay $2,000 in Q3 of 2027."), (2, None), (3, "")], "id long, t string")
    from omenflow.operators import linguistic as lg

    tok = lg.tokens(df, "id", "t").orderBy("n").collect()
    assert [r.term for r in tok][:3] == ["Acme", "Corp", "will"] and {r.id for r in tok} == {1}
    assert (tok[2].pos, tok[2].tag, tok[0].shape, tok[2].is_alpha) == ("AUX", "MD", "Xxxx", True)
    assert sequences.tense(lg.tokens(df, "id", "t"), "id").first().future == 1
    assert [(r.label, r.term) for r in lg.entities(df, "id", "t").orderBy("n").collect()] == [("ORG", "Acme Corp"), ("MONEY", "$2,000"), ("DATE", "Q3 of 2027")]
    assert lg.lemmatized(df, "id", "t").first().lemmas.startswith("acme corp will")
    assert [(r.word, r.label) for r in lg.labelling_rows(df.where("id = 3"), "id", "t").collect()] == [(" ", " ")]


def test_a_number_of_points_is_no_year(spark):
    from omenflow.operators import linguistic as lg

    df = spark.createDataFrame([(1, "fall by 2001 points to $3 or so in 2012"), (2, "in 2003"), (3, "2004 basis points")], "id long, t string")
    assert [(r.id, r.label, r.term) for r in lg.entities(df, "id", "t").orderBy("id", "n").collect()] == [(1, "CARDINAL", "2001"), (1, "MONEY", "$3"), (1, "DATE", "2012"), (2, "DATE", "2003"), (3, "CARDINAL", "2004")]


def test_accents_go_without_python(spark):
    import unicodedata

    from omenflow.functions import forecasts as f

    keep = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ .,;'")
    texts = ["Åse, Émile; ça và!", "ẞ ß ﬁ Ǆ", "é K ; \U0001d400", None, "".join(map(chr, range(0x21, 0x2fff)))]
    found = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", f.ascii_letters("t").alias("x"))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    assert [r.x for r in found.orderBy("i").collect()] == [None if t is None else "".join(c for c in unicodedata.normalize("NFD", t) if c in keep) for t in texts]
