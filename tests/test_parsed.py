"""Subtrees, graphs, morphology and lenient readers against brute force and hand-checkable cases."""

import random
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from __spark_entry__ import queries
from omenflow.functions import text as tx
from omenflow.operators import learning, trees
from omenflow.sources import readers

TREE = "s int, pos int, head int, term string, chosen boolean"


def random_forest(rng: random.Random, n: int) -> list:
    """Heads of ``n`` tokens without circles: crossing ones, chains and several roots."""
    order = rng.sample(range(n), n)
    deep = rng.random()
    heads: list = [None] * n
    for i, p in enumerate(order):
        roll = rng.random()
        if i and roll > 0.1:
            heads[p] = order[i - 1] if roll < deep else rng.choice(order[:i])
        elif roll < 0.03:
            heads[p] = p
        elif roll < 0.05:
            heads[p] = n + 7
    return heads


def reach(heads: list) -> list[tuple]:
    n = len(heads)
    lo, hi = list(range(n)), list(range(n))
    for p in range(n):
        at = p
        while heads[at] is not None and heads[at] != at and heads[at] < n:
            at = heads[at]
            lo[at], hi[at] = min(lo[at], p), max(hi[at], p)
    return list(zip(lo, hi, strict=True))


def merged(heads: list, terms: list, chosen: list) -> list[tuple]:
    n = len(heads)
    unit = list(range(n))
    for (a, b), c in zip(reach(heads), chosen, strict=True):
        if c:  # join everything from a to b, and what is joined with any of it already
            group = {unit[i] for i in range(a, b + 1)}
            unit = [min(group) if u in group else u for u in unit]
    names = sorted(set(unit))
    out = []
    for place, u in enumerate(names):
        inside = [i for i in range(n) if unit[i] == u]
        outer = [h for h in (heads[i] if heads[i] is not None and heads[i] < n and heads[i] != i else None for i in inside) if h is None or unit[h] != u]
        out.append((place, " ".join(terms[i] for i in inside), len(inside), None if outer[0] is None else names.index(unit[outer[0]])))
    return out


def test_subtrees_by_brute_force(spark):
    rng = random.Random(5)
    sentences = {s: random_forest(rng, n) for s, n in enumerate([1, 2, 3, *(rng.randint(2, 12) for _ in range(60)), 300])}
    sentences[98] = [None, *range(200)]  # a chain
    sentences[99] = [7] * 40  # a hub
    terms = {s: [f"w{i}" for i in range(len(h))] for s, h in sentences.items()}
    chosen = {s: [rng.random() < 0.2 for _ in h] for s, h in sentences.items()}
    rows = [(s, p, h, terms[s][p], chosen[s][p]) for s, heads in sentences.items() for p, h in enumerate(heads)]
    rng.shuffle(rows)
    got = trees.subtree_edges(spark.createDataFrame(rows, TREE), ["s"])
    found = {(r.s, r.pos): (r.first_pos, r.last_pos) for r in got.collect()}
    assert found == {(s, p): x for s, heads in sentences.items() for p, x in enumerate(reach(heads))}
    one = trees.merged_subtrees(got, ["s"], F.col("chosen")).orderBy("s", "place").collect()
    want = [(s, *x) for s in sorted(sentences) for x in merged(sentences[s], terms[s], chosen[s])]
    assert [(r.s, r.place, r.term, r.n, r.head) for r in one] == want


def test_merged_subtrees_work_a_sentence_out_once(spark):
    plan = queries()["merged_subtrees"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 3 and plan.count("split(s#") == 1


def test_sentences_with_heads_by_length(spark):
    rng = random.Random(7)
    said = {s: ["x" * rng.choice([1, 4, 8, 9, 12, 15]) for _ in range(n)] for s, n in enumerate([0, 1, 2, 5, 30, 200])} | {9: None}
    rows = spark.createDataFrame(list(said.items()), "s int, words array<string>").repartition(2)
    got = trees.sentence_edges(rows.withColumn("heads", trees.heads_by_length(F.col("words"))))
    for r in got.collect():
        kinds = [(len(w) >= 8) + (len(w) >= 12) for w in said[r.s] or []]
        want = [next((j for j in range(i + 1, len(kinds)) if kinds[j] > c), None) for i, c in enumerate(kinds)]
        assert r.heads == want and list(zip(r.first_pos, r.last_pos, strict=True)) == reach(want)
    assert trees.sentence_edges(spark.createDataFrame([(1, None)], "s int, heads array<int>")).first().first_pos == []


def test_merged_sentences_by_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for s, n in enumerate([1, 2, *(rng.randint(2, 14) for _ in range(80)), 0]):
        rows.append((s, [f"w{i}" for i in range(n)], random_forest(rng, n), [rng.random() < 0.2 for _ in range(n)]))
    got = trees.merged_in_sentences(trees.sentence_edges(spark.createDataFrame(rows, "s int, terms array<string>, heads array<int>, c array<boolean>")), F.col("c"))
    assert {r.s: [tuple(m) for m in r.merged] for r in got.collect()} == {s: merged(h, t, c) for s, t, h, c in rows}


def test_subtrees_at_the_edges(spark):
    rows = [(None, 0, 1, "a", False), (None, 1, None, "b", False), (1, None, 0, "c", True), (1, 4, 4, "d", True), (2, 0, 9, "e", None)]
    got = trees.subtree_edges(spark.createDataFrame(rows, TREE), ["s"])
    assert {(r.s, r.pos, r.first_pos, r.last_pos) for r in got.collect()} == {(None, 0, 0, 0), (None, 1, 0, 1), (1, None, None, None), (1, 4, 4, 4), (2, 0, 0, 0)}
    out = trees.merged_subtrees(got, ["s"], F.col("chosen"))
    assert {(r.s, r.place, r.term, r.head) for r in out.collect()} == {(None, 0, "a", 1), (None, 1, "b", None), (1, 0, "d", None), (2, 0, "e", None)}
    assert trees.subtree_edges(spark.createDataFrame([], TREE), ["s"]).count() == 0
    with pytest.raises(Exception, match="circle"):
        trees.subtree_edges(spark.createDataFrame([(1, 0, 1, "a", False), (1, 1, 2, "b", False), (1, 2, 0, "c", False)], TREE), ["s"]).collect()


def test_graph_of_relations(spark):
    said = [("Ann", "PROPN"), ("sees", "VERB"), ("profit", "NOUN"), ("Bob", "PROPN"), ("Cy", "PROPN")]
    later = [("Ann", "PROPN"), ("doubts", "VERB"), ("profit", "NOUN")]
    bare = [("Ann", "PROPN"), ("profit", "NOUN")]
    rows = [(s, i, t, w) for s, words in ((1, said), (2, later), (3, bare), (4, [("falls", "VERB")])) for i, (w, t) in enumerate(words)]
    got = trees.relation_edges(spark.createDataFrame(rows, "s int, pos int, tag string, term string"), ["s"]).collect()
    # A sentence without a relation doesn't take away an earlier one's.
    assert {tuple(r) for r in got} == {("Ann", "profit", "doubts"), ("profit", "Cy", None)}


def test_morphology(spark):
    cases = {
        "They": "Case=Nom|Number=Plur|Person=3|PronType=Prs", "the": "Definite=Def|PronType=Art", "will": "VerbForm=Fin", "1,200.5": "NumType=Card", "!": "PunctType=Peri",
        "rising": "Aspect=Prog|Tense=Pres|VerbForm=Part", "king": "Number=Sing", "walked": "Tense=Past|VerbForm=Fin", "bed": "Number=Sing", "prices": "Number=Plur",
        "glass": "Number=Sing", "status": "Number=Sing", "employees": "Number=Plur", "quickly": "", "largest": "Degree=Sup", "%": "", "of": "", None: None,
    }
    t = spark.createDataFrame([(c,) for c in cases], "t string").select("t", tx.morphology(F.col("t")).alias("m"), tx.terms(F.col("t")).alias("w"))
    assert {r.t: r.m for r in t.collect()} == cases
    assert t.where("t = '1,200.5'").first().w == ["1", ",", "200", ".", "5"] and t.where("t is null").first().w == []


def test_lines_with_too_many_fields(spark, tmp_path):
    zstandard = pytest.importorskip("zstandard")
    lines = b'id,name\n1,a\n2,b,c\n3\n4,d,\n5,"e,f"\nx,g\n'
    (tmp_path / "plain.csv").write_bytes(lines)
    (tmp_path / "packed.csv.zst").write_bytes(zstandard.compress(lines))
    for name in ("plain.csv", "packed.csv.zst"):
        got = readers.tolerant(spark, f"{tmp_path}/{name}", "id INT, name STRING").collect()
        assert sorted(map(tuple, got), key=str) == [(1, "a"), (3, None), (5, "e,f"), (None, "g")]


def test_batches_that_are_missing_or_empty(spark, tmp_path, caplog):
    assert readers.batch_or_none(spark, f"{tmp_path}/none", "id INT") is None
    assert "no batch at" in caplog.text
    (tmp_path / "empty.csv").write_text("")
    assert readers.batch_or_none(spark, f"{tmp_path}/empty.csv", "id INT").collect() == []
    (tmp_path / "one.csv").write_text("id\n3\n")
    assert [r.id for r in readers.batch_or_none(spark, f"{tmp_path}/one.csv", "id INT").collect()] == [3]


def test_slices_of_clusters(spark):
    rows = spark.createDataFrame([(0, "a"), (0, "b"), (1, "c"), (None, "d")], "cluster int, x string")
    cut = learning.slices(rows, [0, 1, None])
    assert {n: sorted(r.x for r in df.collect()) for n, df in cut.items()} == {0: ["a", "b"], 1: ["c"], None: ["d"]}
    assert sorted(r.x for r in reduce(DataFrame.unionByName, cut.values()).collect()) == ["a", "b", "c", "d"]


def test_a_form_is_classed_once_however_often_it_occurs(spark, tmp_path):
    from omenflow.plans import parsed

    spark.createDataFrame([(1, "The dog barked. The dog barked"), (2, None)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = parsed.sentence_morphology(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate(keys=[t#" in plan
    assert sorted(map(tuple, found.collect())) == [("Xxx", "Definite=Def|PronType=Art", 2), ("xxx", "Number=Sing", 2), ("xxxx", "Tense=Past|VerbForm=Fin", 2)]
