"""Shaping, matching, text, records, readers and writers on small tables with known answers."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from omenflow.functions import forecasts as fc
from omenflow.functions import text as tx
from omenflow.operators import corpus, frames, matching, providers, sequences
from omenflow.sources import pages, readers, writers


def one(df):
    return df.first()[0]


def test_split_contract(spark):
    df = spark.createDataFrame([(i, i % 2, i % 5) for i in range(100)], "id long, a int, b int")
    for bad in ({"labels": []}, {"labels": ["a"], "stratify": True, "stratify_by": "c"}, {"labels": ["a"], "stratify": True, "stratify_by": 1}, {"labels": ["a"], "test_share": 1.5}):
        with pytest.raises(ValueError):
            frames.split_parts(df, "id", **bad)
    with pytest.raises(TypeError):
        frames.split_parts(df, "id", ["a"], stratify=True, stratify_by=1.5)
    parts = frames.split_parts(df, "id", ["a", "b"], stratify=True, stratify_by=1)
    assert {(r.b, r.n) for r in parts.where("part = 'test'").groupBy("b").agg(F.count("*").alias("n")).collect()} == {(k, 4) for k in range(5)}
    lone = df.withColumn("b", F.col("id").cast("int"))
    assert frames.split_parts(lone, "id", ["b"], stratify=True).where("part = 'test'").count() == 20


def test_datasets_columns_and_lengths(spark):
    df = spark.createDataFrame([(1, 0, "x"), (2, 1, "y")], "id long, author_type int, `Unnamed: 0` string")
    assert [r.id for r in frames.author_dataset(df, "human").collect()] == [1] and frames.author_dataset(df, "all").count() == 2
    for name, d in (("nobody", df), ("human", df.drop("author_type"))):
        with pytest.raises(ValueError):
            frames.author_dataset(d, name)
    assert frames.without_columns(df, pattern="^Unnamed").columns == ["id", "author_type"]
    assert one(frames.same_length(df, df)) == 2
    with pytest.raises(Exception, match="different lengths"):
        frames.same_length(df, df.limit(1)).collect()
    assert frames.before_last(df, "id").columns == ["author_type", "id", "Unnamed: 0"]


def test_shuffle_is_a_permutation_that_depends_on_the_seed(spark):
    df = spark.range(500)
    a, b = ([r.id for r in frames.shuffled(df, "id", seed).orderBy("place").collect()] for seed in (1, 2))
    assert sorted(a) == sorted(b) == list(range(500)) and a != b and a != list(range(500))


def test_products_have_a_bound(spark):
    a, b = spark.range(3).withColumnRenamed("id", "a"), spark.range(4).withColumnRenamed("id", "b")
    assert sorted(map(tuple, matching.product(a, b).collect())) == [(x, y) for x in range(3) for y in range(4)]
    with pytest.raises(ValueError):
        matching.product(a, b, most=2)
    assert matching.product(a.limit(0), b).count() == 0


def test_linked_groups_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2))]
    top = list(range(60))
    for _ in range(60):
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    got = matching.linked_groups(spark.createDataFrame(edges, "a long, b long"), spark.range(60).withColumnRenamed("id", "node"))
    assert {r.node: r.cluster for r in got.collect()} == dict(enumerate(top))


def test_best_path_equals_brute_force(spark):
    states = ["a", "b", "c"]
    rng = np.random.default_rng(5)
    moves = {(x, y): float(rng.random()) for x in states for y in states}
    says = {(s, w): float(rng.random()) for s in states for w in "xyz"}
    words = ["xyzzy", "zzyx", "x"]
    rows = [(i, k, w) for i, ws in enumerate(words) for k, w in enumerate(ws)]
    model = spark.createDataFrame([(*k, p) for k, p in moves.items()], "state string, next_state string, p double"), spark.createDataFrame([(*k, p) for k, p in says.items()], "tag string, word string, p double")
    got = sequences.decode(spark.createDataFrame(rows, "sequence long, pos long, word string"), *model).orderBy("sequence", "pos").collect()
    for i, ws in enumerate(words):
        def p(path, ws=ws):
            return np.prod([says[s, w] for s, w in zip(path, ws, strict=True)]) * np.prod([moves[a, b] for a, b in zip(path, path[1:], strict=False)])

        assert tuple(r.tag for r in got if r.sequence == i) == max(itertools.product(states, repeat=len(ws)), key=p)


def test_store_searches_and_names(spark, tmp_path):
    v = spark.createDataFrame([(i, [float(i == k) + 0.1 * k for k in range(4)]) for i in range(4)], "vec_id long, embedding array<double>")
    store = matching.Store(v)
    store.write(f"{tmp_path}/s")
    got = matching.Store.read(spark, f"{tmp_path}/s").query(v.where("vec_id = 0"), "all", 2, 0.5)
    assert {r.search_type for r in got.collect()} <= set(matching.Store.SEARCHES) and got.where("search_type = 'similarity'").count() == 2
    with pytest.raises(ValueError):
        store.query(v, "guess")


def test_bm25_of_one_query_equals_the_search_of_many(spark):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * k) % 7}" for k in range(1, 6 + i % 4))) for i in range(30)], "doc_id long, text string")
    a = {r.doc_id: r.score for r in corpus.bm25(docs, ["w1", "w3"]).collect()}
    b = corpus.bm25_search(docs, spark.createDataFrame([(1, "w1 w3")], "query_id long, text string"), 100)
    assert {r.doc_id: pytest.approx(r.score) for r in b.collect()} == a


def test_records_read_from_print(spark):
    rows = [("{0: ['it's', 'b'], '1': []}",), ('{0: ["a \'quoted\' word"]}',), ("no",)]
    df = spark.createDataFrame(rows, "t string").select(fc.loose_lists(F.col("t")).alias("m"), fc.python_lists(F.col("t")).alias("p"))
    got = df.collect()
    assert got[0].p["0"] == "it's, b" and got[0].p["1"] == "" and got[2].p is None and got[2].m == {}
    assert got[0].m["0"] == "it's, b"


def test_strict_templates(spark):
    said = {
        1: "On [2024-10-15], [Ann] predicts that the [revenue] at [Acme] [will] [rise] by [5%] in [Q3 2027].",
        2: "In [2024], [Ann] from [Acme], may well say that the [revenue] [will] [rise] from [3%] to [5%] in [2027].",
        3: "[Ann] says on [2024] that the [revenue] in [Acme] [will] [rise] by [5%] in [2027].",
        4: "According to a [analyst] from [Acme], on [2024], the [revenue] [will] [rise] beyond [5%] in the timeframe of [2027].",
        5: "In [2027], the [revenue] in [Acme] [will] [rise] by [5%], as said by [Ann] on [2024].",
    }
    rows = [(n, t) for n, t in said.items()]
    df = spark.createDataFrame(rows, "template int, text string")
    got = {r.template: r for r in fc.strict_fields(df).collect()}
    first = {"p_t": "2024-10-15", "p_f": "Q3 2027"}
    for n, r in got.items():
        want = {"p_t": "2024", "p_p": "analyst" if n == 4 else "Ann", "p_a": "revenue", "p_o": "Acme", "p_s": "will", "p_m": "rise", "p_v": "5%", "p_f": "2027", "p_l": None} | (first if n == 1 else {})
        assert {k: r[k] for k in want} == want, n
    with pytest.raises(Exception, match="no match"):
        fc.strict_fields(spark.createDataFrame([(1, "else")], "template int, text string")).collect()


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "n").mkdir()
    (tmp_path / "n" / "French.txt").write_text("Élodie\n\nZoë\n", "utf-8")
    assert sorted(map(tuple, readers.names_by_category(spark, f"{tmp_path}/n").collect())) == [("French", "Elodie"), ("French", "Zoe")]
    (tmp_path / "l.csv").write_bytes(b"a\xff,b\nc")
    assert [r.value for r in readers.decoded_lines(spark, f"{tmp_path}/l.csv").orderBy("line").collect()] == ["a,b", "c"]
    assert readers.plain_lines(spark, f"{tmp_path}/n").count() == 2
    names = spark.createDataFrame([("run-v3.csv",), ("run-12.csv",), ("other-v99.csv",), ("base",), ("base_v1",), ("xv2_2024-01-01",), ("xv7_2024-01-02",)], "name string")
    assert tuple(readers.latest(names, "run").first()) == ("run-12.csv", 12)
    assert writers.free_name(names, "base") == "base_v2" and writers.free_name(names, "new") == "new"
    assert one(writers.next_dated(names, "x", "2024-01-01")) == 3 and one(writers.next_dated(names, "x", "2025-01-01")) == 1
    df = spark.createDataFrame([("a & b", 1, 1), (None, 0, 2)], "t string, sentence_label int, batch_id int")
    assert [r.value for r in writers.latex_rows(df.select("t", "batch_id")).orderBy("value").collect()] == [" & 2 \\\\", "a \\& b & 1 \\\\"]
    writers.log_batches(df, f"{tmp_path}/b")
    assert {tuple(r) for r in spark.read.parquet(f"{tmp_path}/b").select("kind", "batch").collect()} == {("prediction", 1), ("observation", 2)}
    path = writers.write_run(df, f"{tmp_path}/e", 7)
    assert path.endswith("seed7")
    with pytest.raises(Exception, match="already exists"):
        writers.write_run(df, f"{tmp_path}/e", 7)
    writers.write_run(df, f"{tmp_path}/e", 7, "overwrite")
    writers.without_header(df.select("t"), f"{tmp_path}/v")
    writers.append_batch(df, f"{tmp_path}/k", "prediction", 1)
    assert readers.synthetic(spark, f"{tmp_path}/k", "prediction", 1).count() == 2 and readers.synthetic(spark, "x", "prediction", 2, "path") == "x/prediction/batch=2"


def test_scraped_lists(spark):
    html = "<ul><li>12. By 2050 years 02000-02050 $1,000 $5 bet</li><li>12. again</li><li>none</li></ul><span class=\"a\">A</span><span class=\"b\">B</span><span class=\"a\">1</span><span class=\"b\">2</span>"
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    r = pages.item_records(df).collect()
    assert len(r) == 1 and r[0].item == 12 and r[0].stakes == "$1,000 $5" and r[0].dates == "02000-02050"
    assert [tuple(x)[2:] for x in pages.labelled_columns(df, ["a", "b"]).collect()] == [("1", "2")]


def test_providers_by_name_and_again():
    with pytest.raises(ValueError):
        providers.provider("nobody")
    calls = []

    def flaky(prompts):
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("busy")
        return prompts

    assert providers.patient(flaky, 5, 0)(["a"]) == ["a"] and len(calls) == 3
    with pytest.raises(RuntimeError):
        providers.patient(lambda p: 1 / 0 if False else (_ for _ in ()).throw(RuntimeError()), 2, 0)(["a"])


def test_names_and_spans(spark):
    df = spark.createDataFrame([("run-v3.csv",), ("run_v4",), ("plain",)], "name string")
    assert [r[0] for r in df.select(tx.version_of(F.col("name"))).collect()] == [3, 4, None]
