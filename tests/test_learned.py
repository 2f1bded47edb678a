"""Taggers, clusters, topics and estimators against brute force and numpy."""

import itertools
import json
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from omenflow.operators import clustering, learners, learning, linguistic, recurrent, tagging, topics

SENTENCES = (
    ("the {n} {v} the {n}", "DT NN VB DT NN"), ("they can {b} the {n}", "PR MD VB DT NN"), ("the can is {a}", "DT NN VB JJ"), ("a {a} can {v} it", "DT JJ NN VB PR"),
    ("it will {b} in May", "PR MD VB IN NNP"), ("they may {b} in April", "PR MD VB IN NNP"), ("his will was {a}", "PR NN VB JJ"), ("May is {a}", "NNP VB JJ"), ("you should {b} a {n}", "PR MD VB DT NN"),
)
FILL = {"n": ["dog", "house", "bank", "market", "river", "price"], "v": ["sees", "takes", "moves", "holds"], "b": ["rise", "fall", "move", "take", "hold"], "a": ["red", "high", "old", "new", "slow"]}


def tagged(n, seed):
    r = np.random.Generator(np.random.PCG64(seed))
    out = []
    for _ in range(n):
        said, tags = SENTENCES[int(r.integers(len(SENTENCES)))]
        words = said.split()
        words = [str(r.choice(FILL[w[1]])) if w[0] == "{" else w for w in words]
        out.append((words, tags.split()))
    return out


@pytest.fixture(scope="module")
def tagger(spark):
    return tagging.Tagger.fit(spark.createDataFrame([*tagged(600, 1), (None, None), ([], []), (["a"], ["DT", "NN"])], "words array<string>, tags array<string>"), epochs=4, buckets=1 << 14, parts=4)


def test_viterbi_equals_all_paths():
    r = np.random.Generator(np.random.PCG64(2))
    for _ in range(40):
        n, k = int(r.integers(1, 6)), int(r.integers(1, 4))
        scores, moves, start = r.normal(size=(n, k)), r.normal(size=(k, k)), r.normal(size=k)
        value = lambda p: start[p[0]] + scores[range(n), p].sum() + sum(moves[a, b] for a, b in itertools.pairwise(p))  # noqa: B023, E731
        assert tuple(tagging.viterbi(scores, moves, start)) == max(itertools.product(range(k), repeat=n), key=value)


def test_learned_tags_beat_the_rules_on_held_out_sentences(spark, tagger):
    held = tagged(300, 77)
    df = spark.createDataFrame([(i, w, t) for i, (w, t) in enumerate(held)], "id long, words array<string>, gold array<string>")
    got = tagger.tag(df).collect()
    flat = [(a, b) for r in got for a, b in zip(r.tags, r.gold, strict=True)]
    learned = np.mean([a == b for a, b in flat])
    modals = lambda tags: [t == "MD" for t in tags]
    gold = np.array([m for r in got for m in modals(r.gold)])
    mine = np.array([m for r in got for m in modals(r.tags)])
    rules = np.array([t[3] == "MD" for w, _ in held for t in linguistic.rule_tokens([" ".join(w)])[0]])
    assert learned > 0.98 and (mine == gold).mean() > 0.99 > (rules == gold).mean() + 0.02


def test_a_tagger_as_analyser_and_stored(spark, tagger, tmp_path):
    tagger.save(spark, str(tmp_path))
    again = tagging.Tagger.load(spark, str(tmp_path))
    assert again.of("the can is red".split()) == tagger.of("the can is red".split()) == ["DT", "NN", "VB", "JJ"]
    df = spark.createDataFrame([(1, "they can rise the dog"), (2, None), (3, "")], "id long, text string")
    rows = linguistic.tokens(df, "id", "text", again.analyser(str.split, wide={"MD": "AUX"})).orderBy("id", "n").collect()
    assert [(r.term, r.pos, r.tag) for r in rows][:2] == [("they", "PR", "PR"), ("can", "AUX", "MD")]
    assert again.tag(spark.createDataFrame([(None,), ([],), ([None],)], "words array<string>")).select("tags").collect()[0].tags is None


def test_mixing_one_learner_is_the_plain_averaged_perceptron(spark):
    rows = tagged(60, 5)
    got = tagging.Tagger.fit(spark.createDataFrame(rows, "words array<string>, tags array<string>"), epochs=2, buckets=1 << 10, parts=1)
    order = [(r.words, r.tags) for r in spark.createDataFrame(rows, "words array<string>, tags array<string>").orderBy(F.xxhash64("words")).collect()]
    number = {t: i for i, t in enumerate(got.tags)}
    w, total, n = tagging.Weights(1 << 10, len(number)), tagging.Weights(1 << 10, len(number)), 0
    for _ in range(2):
        for words, tags in order:
            at, gold = tagging.features(words, 1 << 10), np.array([number[t] for t in tags])
            path = w.path(at)
            for i in range(len(gold)):
                for t, sign in ((gold, 1), (path, -1)):
                    np.add.at(w.emit, (at[i], t[i]), sign)
                    w.move[t[i - 1] if i else -1, t[i]] += sign
            total.emit += w.emit
            total.move += w.move
            n += 1
    assert np.allclose(got.weights.emit, total.emit / n) and np.allclose(got.weights.move, total.move / n)


def test_a_learner_told_in_pieces_decodes_by_what_it_has_changed(monkeypatch):
    """Sequences decoded together give what one after the other does, mistakes and all."""
    rows, number = tagged(400, 8), {t: i for i, t in enumerate(["DT", "IN", "JJ", "MD", "NN", "NNP", "PR", "VB"])}
    w, total = tagging.Weights(1 << 10, len(number)), np.zeros((1 << 10, len(number)))
    start = np.random.Generator(np.random.PCG64(3)).normal(size=w.emit.shape)
    w.emit[:] = start
    for words, tags in rows:
        at, gold = tagging.features(words, 1 << 10), np.array([number[t] for t in tags])
        path = w.path(at)
        for i in range(len(gold)):
            for t, sign in ((gold, 1), (path, -1)):
                np.add.at(w.emit, (at[i], t[i]), sign)
                w.move[t[i - 1] if i else -1, t[i]] += sign
        total += w.emit - start
    monkeypatch.setattr(tagging, "TOGETHER", 50)
    learner = tagging.Learner(start, np.zeros(w.move.shape))
    for i in range(0, 400, 130):
        words, tags = zip(*rows[i : i + 130], strict=True)
        tagging._learned(learner, pa.RecordBatch.from_pydict({"words": words, "tags": tags}), number)
    assert learner.n == 400 and np.allclose(learner.w.emit, w.emit) and np.array_equal(learner.w.move, w.move)
    assert np.allclose(learner.n * learner.step.emit - learner.late.emit, total)


def test_a_tagger_learns_from_every_sequence(spark, monkeypatch):
    """Each sequence is told of in each round, however many there are."""
    monkeypatch.setattr(tagging, "SEQUENCES", 50, raising=False)
    seen, mixed = [], tagging.Tagger._mixed
    monkeypatch.setattr(tagging.Tagger, "_mixed", staticmethod(lambda *a: seen.append(mixed(*a)) or seen[-1]))
    df = spark.createDataFrame([*tagged(700, 1), (["a", None], ["DT", "NN"]), (["a"], [None])], "words array<string>, tags array<string>")
    tagging.Tagger.fit(df, epochs=2, buckets=1 << 10, parts=3)
    assert [n for n, *_ in seen] == [700, 700]
    from omenflow.plans import indexed

    asked, fit = [], tagging.Tagger.fit
    monkeypatch.setattr(tagging.Tagger, "fit", classmethod(lambda cls, *a, **b: asked.append(b) or fit(*a, **b)))
    held = {r.gold: r.n for r in indexed.learned_tags(spark, "/root/testdata/sf0.001").groupBy("gold").agg(F.sum("n").alias("n")).collect()}
    assert asked == [{"epochs": 2}] and min(held.values()) > 0


def test_spans_of_tags(spark):
    rows = [(1, "a b c d e f".split(), ["B-x", "I-x", "B-x", "I-y", "O", "I-y"]), (2, [], []), (3, None, None), (4, ["q"], ["I-z"])]
    got = tagging.spans(spark.createDataFrame(rows, "id long, words array<string>, tags array<string>"), "id").orderBy("id", "begin").collect()
    assert [tuple(r) for r in got] == [(1, "x", 0, 2, "a b"), (1, "x", 2, 3, "c"), (1, "y", 3, 4, "d"), (1, "y", 5, 6, "f"), (4, "z", 0, 1, "q")]


# Clusters


def brute_complete(edges, nodes):
    """Merges of the nearest two clusters, one after the other; clusters without all edges between them are never joined."""
    d = {(min(a, b), max(a, b)): x for a, b, x in edges}
    clusters, merges = {n: [n] for n in nodes}, []
    while True:
        best = min(((max(d.get((min(x, y), max(x, y)), np.inf) for x in clusters[a] for y in clusters[b]), a, b) for a in clusters for b in clusters if a < b), default=(np.inf, 0, 0))
        if best[0] == np.inf:
            return merges
        merges.append((best[1], best[2], best[0]))
        clusters[best[1]] += clusters.pop(best[2])


@pytest.mark.parametrize(("share", "seed"), [(1.0, 1), (0.5, 2), (0.2, 3)])
def test_complete_link_equals_brute_force(spark, share, seed):
    r = np.random.Generator(np.random.PCG64(seed))
    x = r.normal(size=(26, 3))
    edges = [(i, j, float(np.linalg.norm(x[i] - x[j]))) for i in range(26) for j in range(i) if r.random() < share]
    df = spark.createDataFrame([*edges, (3, 3, 0.0), edges[0], (1, 2, None)], "a long, b long, d double")
    merges = clustering.complete_link(df)
    got = sorted((m.a, m.b, m.height) for m in merges.collect())
    assert got == sorted(brute_complete(edges, range(26)))
    if share == 1.0:
        nodes = spark.createDataFrame([(i,) for i in range(26)], "node long")
        two = {r.node: r.cluster for r in clustering.cut(merges, nodes, clusters=2).collect()}
        assert len(two) == 26 and len(set(two.values())) == 2
        low = sorted(g[2] for g in got)[9]
        assert len({r.cluster for r in clustering.cut(merges, nodes, height=low).collect()}) == 16


def test_complete_link_without_edges(spark):
    none = spark.createDataFrame([], "a long, b long, d double")
    assert clustering.complete_link(none).count() == 0


# Topics


def two_themes(n, seed):
    r = np.random.Generator(np.random.PCG64(seed))
    return [(i, " ".join(f"{'ab'[i % 2]}{int(k)}" for k in r.integers(0, 40, 30)) + " the the of") for i in range(n)]


def test_topics_find_themes_and_perplexity_falls(spark):
    train = topics.bags(spark.createDataFrame([*two_themes(80, 1), (900, None), (901, "")], "doc_id long, text string"))
    held = topics.bags(spark.createDataFrame(two_themes(30, 9), "doc_id long, text string"))
    rounds = [topics.Topics.fit(train, 2, p).perplexity(held) for p in (0, 12)]
    assert rounds[1] < 0.75 * rounds[0]
    model = topics.Topics.fit(train, 2, 12)
    assert model.terms.count() == 82 and model.terms.agg(F.sum("p0"), F.sum("p1")).first()[:] == pytest.approx((1.0, 1.0))
    side = {r.doc_id: int(np.argmax(r.topics)) for r in model.shares(train).collect()}
    assert len({side[i] for i in range(0, 80, 2)}) == len({side[i] for i in range(1, 80, 2)}) == 1 and side[0] != side[1]
    assert {r.topic for r in model.words(3).collect()} == {0, 1}


def test_a_round_of_topics_equals_numpy(spark):
    rows = [(1, "a", 2), (1, "b", 1), (2, "b", 3), (2, "c", 1)]
    counts = spark.createDataFrame(rows, "doc_id long, term string, tf long")
    zero, one = (topics.Topics.fit(counts, 2, p, alpha=0.3, beta=0.2) for p in (0, 1))
    first = {r.term: (r.p0, r.p1) for r in zero.terms.collect()}
    # The first shares again, as the document's counts aren't in the model.
    draw = [(F.pmod(F.xxhash64("doc_id", "term", F.lit(42000 + i)), F.lit(1 << 20)) + 1) / (1 << 20) for i in range(2)]
    drawn = {(r.doc_id, r.term): np.array(r.d) for r in counts.select("doc_id", "term", F.array(*draw).alias("d")).collect()}
    of_doc, new = {}, {}
    for d, t, n in rows:
        of_doc[d] = of_doc.get(d, 0.3) + n * drawn[d, t] / drawn[d, t].sum()
    for d, t, n in rows:
        w = np.array(first[t]) * of_doc[d]
        new[t] = new.get(t, 0.2) + n * w / w.sum()
    total = sum(new.values())
    for r in one.terms.collect():
        assert (r.p0, r.p1) == pytest.approx(tuple(new[r.term] / total))


# Estimators


def s(g, h, m):
    return g[m].sum() ** 2 / (h[m].sum() + 1)


def points(spark, n=400, seed=4, ring=False):
    r = np.random.Generator(np.random.PCG64(seed))
    x = r.normal(size=(n, 4))
    y = ((x[:, 0] ** 2 + x[:, 1] ** 2 > 1.4) if ring else (x @ [1.0, -2.0, 0.5, 0.0] + 0.3 > 0)).astype(int)
    df = learning.features(spark.createDataFrame([(i, x[i].tolist(), int(y[i])) for i in range(n)], "id long, v array<double>, y int"), "v", "y")
    return x, y, df


def test_linear_learners_equal_numpy_passes(spark):
    x, y, df = points(spark)
    full = np.hstack([x, np.ones((400, 1))])
    for kind in ("perceptron", "hinge"):
        model = learners.MixedLinear(kind=kind, epochs=1).fit(df.coalesce(1))
        _, total, _ = learners.descend(kind, np.zeros(5), full, 2.0 * y - 1, 1.0, 0.0001, 0)
        assert np.allclose(model.getOrDefault("weights"), total / 400)
        mixed = learners.MixedLinear(kind=kind, epochs=8).fit(df.repartition(5))
        hit = mixed.transform(df).agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
        assert hit > 0.95


def test_a_first_split_equals_trying_all(spark):
    x, y, df = points(spark, ring=True)
    model = learners.SecondOrderBoosting(rounds=1, depth=1, bins=16, rate=1.0).fit(df.repartition(3))
    told = json.loads(model.getOrDefault("trees"))
    p = y.mean()
    g, h = p - y, np.full(len(y), p * (1 - p))
    best = max(((s(g, h, m) + s(g, h, ~m) - s(g, h, m | True)) / 2, i, k) for i in range(4) for k, cut in enumerate(told["edges"][i]) if (m := x[:, i] <= cut).any() and (~m).any())
    tree = told["trees"][0]
    assert (tree["feature"][0], tree["cut"][0]) == best[1:]
    left = x[:, best[1]] <= told["edges"][best[1]][best[2]]
    assert tree["value"][1] == pytest.approx(-g[left].sum() / (h[left].sum() + 1))


def test_boosting_learns_a_ring_and_is_stored(spark, tmp_path):
    _, _, df = points(spark, 600, ring=True)
    fitted = Pipeline(stages=[learners.SecondOrderBoosting(rounds=8, depth=3)]).fit(df)
    fitted.write().overwrite().save(str(tmp_path))
    again = PipelineModel.load(str(tmp_path)).transform(df)
    assert again.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0] > 0.93


def test_each_name_is_an_estimator_of_its_own(spark):
    _, _, df = points(spark, 200)
    kinds = {n: (type(m), m.getOrDefault("kind") if hasattr(m, "kind") else None) for n in ("perceptron", "sgd", "x_gradient_boosting", "gradient_boosting", "support_vector_machine") for m in [learning.model(n)]}
    assert len(set(kinds.values())) == 5
    fitted = learning.train_all(df, ["perceptron", "sgd"])
    got = learning.predict_all(df, fitted, ["id", "y"])
    assert got.agg(F.avg((F.col("perceptron") == F.col("y")).cast("double"))).first()[0] > 0.9
    none = learners.MixedLinear().fit(df.where("id < 0"))
    assert none.getOrDefault("weights") == [0.0]


# Recurrent


def test_gradients_through_time_equal_differences():
    net = recurrent.Network(3, hidden=5, seed=3)
    x, length = recurrent.padded([b"abcde", b"xy", b"", b"\xff\x00q"])
    y = np.array([0, 2, 1, 1])
    _, g = net.gradient(x, length, y)
    r = np.random.Generator(np.random.PCG64(1))
    live = np.flatnonzero(g)
    for k in r.permutation(live)[:60]:
        was, both = net.flat[k], []
        for step in (1e-5, -1e-5):
            net.flat[k] = was + step
            both.append(net.gradient(x, length, y)[0])
        net.flat[k] = was
        assert g[k] == pytest.approx((both[0] - both[1]) / 2e-5, rel=1e-4, abs=1e-8)


def test_windows_have_the_whole_text():
    for text in ("", "a", "é" * 100, "x" * 64, "y" * 65):
        cut = recurrent.windows(text)
        assert b"".join(cut) == text.encode() and max(map(len, cut)) <= recurrent.WIDTH


def test_a_recurrent_classifier_learns_held_out_names(spark, tmp_path):
    r = np.random.Generator(np.random.PCG64(2))
    ends = {"it": ["ini", "elli", "otti"], "ru": ["ov", "sky", "enko"], "jp": ["moto", "kawa", "yama"]}
    name = lambda lang: "".join(r.choice(list("bdfglmnprst"), 1).tolist() + r.choice(list("aeiou"), 1).tolist()) * int(r.integers(1, 3)) + str(r.choice(ends[lang]))
    rows = [(i, name(lang), lang) for i, lang in enumerate(list(ends) * 150)]
    df = spark.createDataFrame([*rows, (999, "x", None)], "id long, name string, lang string")
    model = recurrent.RecurrentClassifier.fit(df.where("id % 5 > 0"), "name", "lang", epochs=10, hidden=16, parts=2)
    model.save(spark, str(tmp_path))
    again = recurrent.RecurrentClassifier.load(spark, str(tmp_path))
    got = again.predict(df.where("id % 5 = 0 and lang is not null"), "name").collect()
    assert np.mean([g.predicted == g.lang for g in got]) > 0.9 and all(0 < g.score <= 1 for g in got)
    odd = spark.createDataFrame([(None,), ("",), ("z" * 5000,)], "name string")
    assert again.predict(odd, "name").count() == 3


def test_a_step_adds_up_what_its_loop_left(monkeypatch):
    """Rows of a byte are summed once a step of learning, not once a byte; windows are made rows of bytes once an epoch."""
    calls, padded = [], recurrent.padded
    monkeypatch.setattr(recurrent, "padded", lambda parts: calls.append(len(parts)) or padded(parts))
    parts = [bytes([65 + i % 7, 200 - i, *range(i % 5)]) for i in range(100)]
    flat = recurrent.one_epoch(recurrent.Network(3, hidden=8).flat, 3, 8, parts, [i % 3 for i in range(100)], 0.05, 1)
    assert calls == [100] and flat.dtype == np.float64
    net, x, length = recurrent.Network(3, hidden=8, seed=4), *padded(parts)
    g = net.views(net.gradient(x, length, np.arange(100) % 3)[1])
    assert set(np.flatnonzero(np.abs(g["into"]).sum(axis=1))) == {c for part in parts for c in part}
    assert g["into"].sum(axis=0) == pytest.approx(g["bias"], abs=1e-12)


def test_short_texts_are_told_together(spark, monkeypatch):
    """Windows of many texts are one call of the network, and each text's label is that of its own windows."""
    calls, net = [], recurrent.Network(2, hidden=4, seed=2)
    forward = recurrent.Network.forward
    monkeypatch.setattr(recurrent.Network, "forward", lambda self, x, length: calls.append(len(x)) or forward(self, x, length))
    texts = [f"t{i} " * (i % 90) for i in range(300)]
    sent = type("Sent", (), {"value": (["a", "b"], net.flat, 4)})
    rows = type("Rows", (), {"schema": spark.createDataFrame([], "t string").schema, "mapInArrow": lambda self, run, schema: run})()
    rows.sparkSession = type("S", (), {"sparkContext": type("C", (), {"broadcast": staticmethod(lambda value: sent)})})
    run = recurrent.RecurrentClassifier(["a", "b"], net).predict(rows, "t")
    got = [r for b in run(iter([pa.RecordBatch.from_pydict({"t": texts})])) for r in b.to_pylist()]
    assert max(calls) <= recurrent.TOLD and len(calls) < 20
    for text, r in zip(texts, got, strict=True):
        p = np.exp(forward(net, *recurrent.padded(recurrent.windows(text)))[1].mean(axis=0))
        assert r["t"] == text and r["predicted"] == "ab"[int(p.argmax())] and r["score"] == pytest.approx(p.max() / p.sum(), abs=1e-9)


def test_spans_of_a_long_row_are_found_in_one_pass(spark):
    """A text with many entities: work that grows with its square would take minutes here."""
    n = 30_000
    rows = spark.range(1).selectExpr("id", f"transform(sequence(1, {n}), i -> concat('w', i)) words", f"transform(sequence(1, {n}), i -> case i % 3 when 0 then 'O' when 1 then 'B-x' else 'I-x' end) tags")
    began = time.time()
    got = tagging.spans(rows, "id").selectExpr("count(*) n", "min(end - begin) least", "max(end - begin) most", "max_by(term, begin) last").first()
    assert tuple(got) == (n // 3, 2, 2, f"w{n - 2} w{n - 1}") and time.time() - began < 30


def test_spans_with_null_and_empty_labels(spark):
    rows = [(1, "a b c d e".split(), ["I-", "B-x", None, "I-x", "I-x"])]
    got = tagging.spans(spark.createDataFrame(rows, "id long, words array<string>, tags array<string>"), "id").orderBy("begin").collect()
    assert [tuple(r) for r in got] == [(1, "", 0, 1, "a"), (1, "x", 1, 2, "b"), (1, "x", 3, 5, "d e")]


def test_tags_of_many_sequences_equal_those_of_each(monkeypatch):
    r = np.random.Generator(np.random.PCG64(5))
    monkeypatch.setattr(tagging, "TOGETHER", 50)
    w = tagging.Weights(64, 3)
    w.emit[:], w.move[:] = r.normal(size=w.emit.shape), r.normal(size=w.move.shape)
    tagger = tagging.Tagger(["a", "b", "c"], w)
    many = [[f"W{k}" for k in r.integers(0, 30, int(n))] for n in r.integers(0, 12, 200)]
    assert tagger.of_many(many) == [tagger.of(x) for x in many] and tagger.of_many([]) == [] and tagger.of_many([[], []]) == [[], []]


def test_what_a_round_shuffled_and_wrote_is_deleted(spark):
    import os

    r = np.random.Generator(np.random.PCG64(8))
    x = r.normal(size=(16, 2))
    near = spark.createDataFrame([(i, j, float(np.linalg.norm(x[i] - x[j]))) for i in range(16) for j in range(i)], "a long, b long, d double")
    top = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    before = set(os.listdir(top)) if os.path.isdir(top) else set()
    merges = clustering.complete_link(near)
    left = [p for p in set(os.listdir(top)) - before]
    # The merges of each round, an empty round and its edges; not the edges of all rounds.
    rounds = len({f.rpartition("/")[0] for f in merges.inputFiles()})
    assert rounds > 2 and len(left) <= rounds + 2
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("strip", [1, 50, 1 << 22])
def test_near_rows_above_a_bound_equal_brute_force(spark, monkeypatch, strip):
    from omenflow.operators import corpus

    monkeypatch.setattr(corpus, "STRIP", strip)
    r = np.random.Generator(np.random.PCG64(5))
    x = r.normal(size=(90, 4)).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    u = x.astype(np.float64) / np.linalg.norm(x.astype(np.float64), axis=1, keepdims=True)
    sims = u @ u.T
    np.fill_diagonal(sims, -2)
    want = {(i, int(j)) for i in range(90) for j in np.argsort(-sims[i], kind="stable")[:6] if sims[i, j] >= 0.8}
    got = corpus.nearest(df, df, 6, block_rows=20, least=0.8)
    assert {(r.query_id, r.vec_id) for r in got.collect()} == want and len(want) > 50


def test_documents_stay_in_their_blocks(spark, monkeypatch):
    monkeypatch.setattr(topics, "BLOCK", 400)
    docs = spark.createDataFrame([*two_themes(60, 1), (7, "a1 a1 zz"), (900, None), (901, "")], "doc_id long, text string")
    dealt, whole = topics.Blocks.of_texts(docs, 2), topics.bags(docs)
    assert dealt.held.select("block").distinct().count() > 3
    # A block's documents are read where they are: no exchange below the rounds' side of them.
    plan = dealt.held.groupBy("block").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    got, want = topics.Topics.fit(dealt, 2, 3), topics.Topics.fit(whole, 2, 3)
    for a, b in ((got.terms, want.terms), (got.shares(dealt), want.shares(whole))):
        a, b = ({r[0]: np.ravel(r[1:] if len(r) > 2 else r[1]) for r in x.collect()} for x in (a, b))
        assert set(a) == set(b) and all(a[i] == pytest.approx(b[i]) for i in a)
    assert set(b) == set(range(60))


def test_rounds_of_topics_move_packed_sums(spark, monkeypatch):
    """Between rounds a block has a row for each bucket, and one for what it alone has, however many terms and documents."""
    monkeypatch.setattr(topics, "BLOCK", 400)
    docs = spark.createDataFrame([*two_themes(60, 1), *((100 + i, f"own{i} a1 b2") for i in range(40))], "doc_id long, text string")
    blocks = topics.Blocks.of_texts(docs, 2)
    n = blocks.held.select("block").distinct().count()
    assert n > 3 and blocks.first.count() <= n * (n + 1) < topics.bags(docs).select("term").distinct().count()
    assert "term" not in blocks.first.columns
    model = topics.Topics.fit(blocks, 2, 2)
    assert model.terms.count() == model.terms.select("term").distinct().count() == topics.bags(docs).select("term").distinct().count()
    assert model.terms.agg(F.sum("p0"), F.sum("p1")).first()[:] == pytest.approx((1.0, 1.0))
