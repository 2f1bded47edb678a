"""The lexical and the vector index, and near names, against full scans."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from omenflow.operators import corpus, lexical, matching, near_names, vector_index

WORDS = [f"w{i}" for i in range(400)]


def texts(n, seed=0):
    r = np.random.Generator(np.random.PCG64(seed))
    common = 1 / np.arange(1, 401) ** 1.1
    return [" ".join(r.choice(WORDS, int(r.integers(3, 60)), p=common / common.sum())) for _ in range(n)]


def brute(docs, queries, k, k1=1.5, b=0.75):
    split = {i: (t or "").lower().split() for i, t in docs}
    df = Counter(w for t in split.values() for w in set(t))
    raw = {w: math.log(len(docs) - n + 0.5) - math.log(n + 0.5) for w, n in df.items()}
    mean = sum(raw.values()) / max(len(raw), 1)
    idf = {w: 0.25 * mean if x < 0 else x for w, x in raw.items()}
    average = sum(map(len, split.values())) / len(docs)
    out = []
    for q, text in queries:
        found = []
        for i, t in split.items():
            tf, hit = Counter(t), [w for w in (text or "").lower().split() if w in t]
            if hit:
                found.append((-round(sum(idf[w] * tf[w] * (k1 + 1) / (tf[w] + k1 * (1 - b + b * len(t) / average)) for w in hit), 9), i))
        out += [(q, i, -s) for s, i in sorted(found)[:k]]
    return sorted(out)


@pytest.fixture(scope="module")
def library(spark):
    docs = [*enumerate(texts(600)), (600, None), (601, ""), (602, "w1 w1 w1"), (603, "w1 w1 w1"), (604, "ONLY here")]
    asked = [(1, "w300 w5 w9 w9 w1"), (2, "w1"), (3, "only w0 w1 w2 w3"), (4, "unknown"), (5, None), (6, " ".join(WORDS[::7]))]
    return docs, asked, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "query_id long, text string")


def same(found, want):
    got = sorted((r.query_id, r.doc_id, r.score) for r in found.collect())
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(g[2] == pytest.approx(w[2], abs=1e-7) for g, w in zip(got, want, strict=True))


def test_both_lexical_searches_equal_brute_force(spark, library, tmp_path):
    docs, asked, df, queries = library
    want = brute(docs, asked, 10)
    same(corpus.bm25_search(df, queries, 10), want)
    lexical.LexicalIndex.build(df, str(tmp_path), block_docs=16)
    same(lexical.LexicalIndex(spark, str(tmp_path)).search(queries, 10), want)
    same(lexical.LexicalIndex.build(df, block_docs=1000).search(queries, 3), brute(docs, asked, 3))


def test_few_documents_are_scored_in_full(spark):
    """A rare term in a query of common ones: documents with common terms only can't reach its best."""
    docs = [(i, f"{t} rare{i // 12}") for i, t in enumerate(texts(1200, 3))]
    asked = [(q, f"rare{q} rare{q} w0 w1 w2") for q in range(20)]
    df, queries = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(asked, "query_id long, text string")
    index = lexical.LexicalIndex.build(df, block_docs=16)
    scored = index.scored(queries, 10).count()
    assert 200 <= scored < 20 * 1200 / 20
    same(index.search(queries, 10), brute(docs, asked, 10))


def test_an_empty_lexical_index(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    index = lexical.LexicalIndex.build(none)
    assert index.search(spark.createDataFrame([(1, "a")], "query_id long, text string")).count() == 0


def test_an_index_moves_texts_and_rows_of_asked_terms_only(spark, library, tmp_path, monkeypatch):
    """What a search moves has no row for each query that asks for a term, and tasks don't grow with the blocks."""
    monkeypatch.setattr(lexical, "TASK_BLOCKS", 4)
    docs, asked, df, queries = library
    index = lexical.LexicalIndex.build(df, str(tmp_path), block_docs=16)
    assert index.parts == -(-len(docs) // 16 // 4) and set(index.postings.columns) == {"term", "block", "top", "n", "docs", "sizes", "tfs"}
    of = index.asked(queries).cache()
    where = index._blocks(of).select("query_id", "block").cache()
    plan = re.sub(r"#\w+", "", plan_of(index._scores(of, where)))
    assert f"hashpartitioning(block, {index.parts})" in plan and "hashpartitioning(query_id, block, doc_id" not in plan
    same(index.search(queries, 10), brute(docs, asked, 10))


def test_a_query_without_an_id_finds_nothing(spark):
    index = lexical.LexicalIndex.build(spark.createDataFrame([(1, "a b"), (2, "b c"), (3, "d")], "doc_id long, text string"))
    found = index.search(spark.createDataFrame([(None, "a"), (7, "d")], "query_id long, text string")).collect()
    assert [(r.query_id, r.doc_id) for r in found] == [(7, 3)]


def test_blocks_are_inverted_whole(monkeypatch):
    """Words of a block that comes in two batches are one row; a chunk ends with a block."""
    monkeypatch.setattr(lexical, "TOKENS", 1)
    batch = lambda *rows: pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows]), pa.array([r[2] for r in rows], pa.list_(pa.string()))], ["block", "doc_id", "t"])
    sent = [batch((0, "a", ["y", "x", "y"]), (1, "b", [])), batch(), batch((1, "c", ["x"]), (1, "d", ["x", "z"]), (2, "e", []))]
    got = [r for b in lexical._inverted(iter(sent), {"k1": 1.5, "b": 0.0, "average": 2.0}) for r in b.to_pylist()]
    want = [("x", 0, 1, ["a"], [3], [1]), ("y", 0, 1, ["a"], [3], [2]), ("x", 1, 2, ["c", "d"], [1, 2], [1, 1]), ("z", 1, 1, ["d"], [2], [1])]
    assert [(r["term"], r["block"], r["n"], r["docs"], r["sizes"], r["tfs"]) for r in got] == want
    assert [round(r["top"], 9) for r in got] == [1.0, round(5 / 3.5, 9), 1.0, 1.0]


def clustered(n, d=12, groups=23, seed=1):
    r = np.random.Generator(np.random.PCG64(seed))
    middle = r.normal(size=(groups, d))
    return [(i, (middle[i % groups] + r.normal(size=d) * 0.15).tolist()) for i in range(n)]


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [*clustered(1500), *[(2000 + i, clustered(1)[0][1]) for i in range(60)], (3000, None), (3001, [float("nan")] * 12), (3002, [0.0] * 12)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)


def pairs(df):
    return [tuple(r) for r in df.select("query_id", "rank", "vec_id").orderBy("query_id", "rank").collect()]


def test_vector_index_finds_nine_in_ten_and_reads_few_cells(spark, vectors, tmp_path):
    index = vector_index.VectorIndex.build(vectors, str(tmp_path), part_rows=50)
    queries = vectors.where("vec_id % 50 = 0")
    exact = corpus.nearest(vectors, queries)
    index = vector_index.VectorIndex(spark, str(tmp_path))
    assert index.rows.count() == 1561 and sum(n for n, _, _ in index.cells.values()) == 1561
    assert index.probes < len(index.cells) / 2 and max(p for _, p, _ in index.cells.values()) > 1
    assert vector_index.recall(index.search(queries), exact) >= 0.9


def test_exact_search_over_the_index_equals_a_scan(spark, vectors):
    index = vector_index.VectorIndex.build(vectors, part_rows=40)
    queries = vectors.where("vec_id % 50 = 0 or vec_id = 3002")
    assert pairs(index.search(queries, exact=True)) == pairs(corpus.nearest(vectors, queries))
    # Even where the first search sees one cell only.
    assert pairs(index.search(queries, exact=True, probes=1, refine=1)) == pairs(corpus.nearest(vectors, queries))


def test_vector_index_of_names_and_of_nothing(spark):
    named = spark.createDataFrame([(f"id{i}", v) for i, v in clustered(40)], "vec_id string, embedding array<float>")
    index = vector_index.VectorIndex.build(named)
    assert pairs(index.search(named, 3, exact=True)) == pairs(corpus.nearest(named, named, 3))
    assert vector_index.VectorIndex.build(named.where("vec_id is null")) is None
    one = vector_index.VectorIndex.build(named.limit(1))
    assert one.search(named.limit(1), exact=True).count() == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("most", [1, 2])
def test_near_names_equal_brute_force(spark, most):
    r = np.random.Generator(np.random.PCG64(most))
    names = ["", "a", "ab", "ba", "Ann", "Anne", "Hannah", "naïve", "naive"] + ["".join(r.choice(list("abé"), int(r.integers(1, 8)))) for _ in range(150)]
    rows = [(x,) for x in names] + [(None,), ("Ann",)] + [("Ann",)] * 50
    got = sorted(map(tuple, near_names.near_names(spark.createDataFrame(rows, "n string"), "n", most).collect()))
    distinct = sorted(set(names))
    assert got == sorted((a, b, distance(a, b)) for a in distinct for b in distinct if a < b and distance(a, b) <= most)


def test_deletions(spark):
    row = spark.range(1).select(near_names.deletions(F.lit("aab"), 2).alias("x"), near_names.deletions(F.lit(""), 2).alias("y")).first()
    assert sorted(row.x) == ["a", "aa", "aab", "ab", "b"] and row.y == [""]


def test_linked_groups_of_a_chain_a_hub_and_loners(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 700)] + [(7, 7), (101, 100)]
    nodes = spark.createDataFrame([(i,) for i in [7, 8, *range(100, 161), *range(500, 700)]], "node long")
    got = {r.node: r.cluster for r in matching.linked_groups(spark.createDataFrame(edges, "a long, b long"), nodes).collect()}
    assert got == {7: 7, 8: 8} | dict.fromkeys(range(100, 161), 100) | dict.fromkeys(range(500, 700), 500)



def test_nearest_leaves_null_vectors_out_and_keeps_the_kind_of_ids(spark):
    rows = [("a", [1.0, 0.0]), ("b", [1.0, 0.1]), ("c", None), ("d", [None, 1.0]), (None, [1.0, 0.0]), ("e", [])]
    df = spark.createDataFrame(rows, "vec_id string, embedding array<double>")
    assert pairs(corpus.nearest(df, df)) == [("a", 1, "b"), ("b", 1, "a")]


def test_nearest_takes_the_smallest_ids_of_equals(spark):
    r = np.random.Generator(np.random.PCG64(5))
    copy, far = r.normal(size=16).tolist(), r.normal(size=16).tolist()
    rows = [(i, copy if i % 2 else far) for i in r.permutation(300).tolist()]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    for block_rows in (2048, 40):
        got = corpus.nearest(df, df.where("vec_id in (1, 100)"), k=4, block_rows=block_rows).orderBy("query_id", "rank").collect()
        assert [(x.query_id, x.vec_id) for x in got] == [(1, 3), (1, 5), (1, 7), (1, 9), (100, 0), (100, 2), (100, 4), (100, 6)]


@pytest.mark.parametrize("most", [1, 2])
def test_the_index_of_near_names_is_never_sent_whole(spark, most):
    found = near_names.near_names(spark.range(50).selectExpr("concat('name', id) n"), "n", most)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_the_index_of_near_names_takes_tasks_by_its_rows(spark, monkeypatch):
    """What all names begin with has no rows in the index, and a task's share of the others doesn't grow with the names."""
    monkeypatch.setattr(near_names, "TASK_ROWS", 500)
    found = near_names.near_names(spark.range(200).selectExpr("concat('a name of no use ', lpad(id, 4, '0')) n"), "n")
    assert found.rdd.getNumPartitions() == -(-200 * (2 * (1 + 3 + 3) + 3) // 500)  # 0 is what the last parts begin with, too
    names = [f"a name of no use {i:04d}" for i in range(200)]
    assert sorted(map(tuple, found.collect())) == sorted((x, y, distance(x[-4:], y[-4:])) for x in names for y in names if x < y and distance(x[-4:], y[-4:]) <= 2)


def test_masks(spark):
    row = spark.range(1).select(near_names.masks(F.lit("éab"), 2).alias("x"), near_names.masks(F.lit("a"), 2).alias("y"), near_names.masks(F.lit(""), 1).alias("z")).first()
    assert [(m.left, m.gone) for m in row.x] == [("\0\0b", "éa"), ("\0a\0", "éb"), ("é\0\0", "ab")] and row.y == row.z == []


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("again", [False, True])
def test_words_are_counted_inside_rows(spark, again):
    rows = [(1, "b a b"), (2, None), (3, ""), (4, "c c c"), *([(4, "c d e")] if again else [])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = corpus.word_counts(df, "doc_id", F.filter(F.split(F.coalesce("text", F.lit("")), " "), lambda x: x != ""))
    want = [(1, 3, "a", 1), (1, 3, "b", 2)] + ([(4, 3, "c", 4), (4, 3, "d", 1), (4, 3, "e", 1)] if again else [(4, 3, "c", 3)])
    assert sorted(map(tuple, found.collect())) == want
    assert again or "Exchange" not in plan_of(found)


def test_what_lexical_searches_move(spark, library):
    """Scores are summed where a document's counts are, so that pairs of queries and documents are never dealt anew."""
    docs, asked, df, queries = library
    plan = plan_of(corpus.bm25_search(df, queries, 10))
    assert "hashpartitioning(query_id, doc_id" not in re.sub(r"#\w+", "", plan) and "hashpartitioning(doc_id, size" not in re.sub(r"#\w+", "", plan)


def test_counts_move_once(spark, library):
    df = library[2]
    assert "hashpartitioning(doc_id, term" not in re.sub(r"#\w+", "", plan_of(corpus.tfidf(df, 20)))
    assert "hashpartitioning(doc_id, size" not in re.sub(r"#\w+", "", plan_of(corpus.smoothed_idf(df)))
    assert re.sub(r"#\w+", "", plan_of(corpus.bigrams(df))).count("hashpartitioning(first, second") == 1


def test_mean_of_words_counts_inside_rows(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, "zz"), (3, None)], "doc_id long, text string")
    table = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 3.0])], "word string, vector array<float>")
    found = matching.mean_of_words(df, "doc_id", F.split("text", " "), table, 2)
    assert "hashpartitioning(doc_id, word" not in re.sub(r"#\w+", "", plan_of(found))
    assert sorted((r.doc_id, [round(x, 6) for x in r.vector]) for r in found.collect()) == [(1, [0.666667, 1.0]), (2, [0.0, 0.0]), (3, [0.0, 0.0])]


def test_pairs_that_share_a_key_are_made_on_all_cores(spark, tmp_path):
    spark.range(40).selectExpr("id a", "id % 2 k").coalesce(1).write.parquet(f"{tmp_path}/a")
    found = matching.sharing(spark.read.parquet(f"{tmp_path}/a"), spark.range(10).selectExpr("id b", "id % 2 k"), "k").select("a", "b")
    assert found.count() == 200 and found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_pairs_of_a_hot_key_are_dealt_and_all_there(spark, monkeypatch):
    """However many rows a key has, no task makes all of its pairs, and files of them repeat few rows."""
    monkeypatch.setattr(matching, "RIGHT", 100, raising=False)
    a = spark.range(1_000).selectExpr("id a", "IF(id % 500 = 7, null, id % 100 div 99) k", "'x' j")
    b = spark.range(300).selectExpr("id b", "IF(id % 150 = 7, null, id % 100 div 99) k", "IF(id = 9, null, 'x') j")
    found = matching.sharing(a, b, "k", "j")
    assert found.columns == ["k", "j", "a", "b"]
    want = a.join(b, ["k", "j"])
    n = found.count()
    assert n == want.count() == found.distinct().count() and found.exceptAll(want).isEmpty()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        most = matching.sharing(a, b, "k", "j").where("k = 0").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert most < n * 0.6
    together = a.select("a", (F.col("a") * 0).alias("k"))
    copies = matching.sharing(together.withColumn("a", F.lit(1)), spark.range(2).selectExpr("id b", "0 k"), "k")
    assert copies.count() == 2_000


def test_pairs_of_keys_without_others_and_of_empty_tables(spark):
    a, b = spark.range(4).selectExpr("id % 2 k"), spark.range(3).selectExpr("id % 2 k", "id b")
    assert sorted(map(tuple, matching.sharing(a, b, "k").collect())) == [(0, 0), (0, 0), (0, 2), (0, 2), (1, 1), (1, 1)]
    assert matching.sharing(a.where("false"), b, "k").collect() == matching.sharing(a, b.where("false"), "k").collect() == []


def test_certified_pairs_are_dealt_by_bundles(spark):
    """A nation's pairs are spread by bundles of both sides, and those that are accepted are the join's."""
    from omenflow.plans import corpora

    d = "/root/testdata/sf0.001"
    found = corpora.certified_pairs(spark, d)
    assert "hashpartitioning(_key, _i, _j" in re.sub(r"#\w+", "", plan_of(found))
    c, s = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("customer", "supplier"))
    want = c.join(s, (F.col("c_nationkey") == F.col("s_nationkey")) & (F.col("c_acctbal") > F.col("s_acctbal"))).selectExpr("c_custkey", "s_suppkey", "1 label")
    assert found.count() == want.count() > 0 and found.exceptAll(want).isEmpty()
