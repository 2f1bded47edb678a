"""Cases in which an operator once did less than its whole job."""

import numpy as np
import pytest

import corpus_pipeline
from omenflow.llm import decontamination, extraction, fingerprints, language_id
from omenflow.operators import corpus


def likeness(spark, a, b):
    return fingerprints.compare_versions(spark.createDataFrame([(a, b)], "text string, other string"), "other").first().other_likeness


def test_fingerprints_cut_texts_of_any_length_alike(spark):
    said = [f"Sentence number {i} is said here." for i in range(120)]
    whole = " ".join(said)
    assert len(whole) > 2000 and "\n" not in whole
    assert likeness(spark, whole, " ".join(said[:80] + ["Another end."])) == pytest.approx(80 / 121)
    short = " ".join(said[:40])
    assert len(short) < 2000
    assert likeness(spark, whole, short) == pytest.approx(40 / 120)
    many = [f"Line {i} of very many. It goes on!" for i in range(1500)]
    assert likeness(spark, " ".join(many), " ".join(many[:1000])) == pytest.approx(1001 / 1501)


def test_extraction_keeps_what_is_outside_the_body_div(spark):
    body = "".join(f"<p>Paragraph {i} of the body of this article.</p>" for i in range(20))
    page = "<html><body><nav><a href='/'>Home</a></nav>{}<footer>Imprint</footer></body></html>".format
    plain = page(f"<article><h1>Title</h1><p>The lead.</p><div class='body'>{body}</div><p>The end.</p></article>")
    split = page(f"<div class='a'><h1>Title</h1><p>The lead.</p></div><div class='body'>{body}</div><div class='z'><p>The end.</p></div>")
    two = page(f"<h1>Title</h1><article><p>The lead.</p>{body}</article><article><p>The end.</p></article>")
    # Most pages of the host have only a body; those with more keep it all.
    bare = page(f"<article><div class='body'>{body}</div></article>")
    for host, pages in (("a", [plain] * 3), ("b", [split] * 3), ("c", [two] * 3), ("d", [bare] * 30 + [plain])):
        rows = spark.createDataFrame([(i, f"http://{host}.org/{i}", x) for i, x in enumerate(pages)], "page_id long, url string, html string")
        text = {r.page_id: r.text for r in extraction.extract(rows).collect()}[len(pages) - 1].split("\n\n")
        assert text[:2] == ["Title", "The lead."] and text[-1] == "The end." and len(text) == 23


def test_language_is_learned_from_short_texts(spark):
    said = {"aa": "lorem dolor amet", "bb": "xyzzy quux wibbly", "cc": "123 ééé ñññ 456"}
    rows = [(i, f"{said[lang]} {i % 7}", lang) for i, lang in enumerate(["aa", "bb"] * 60)]
    rows += [(1000 + i, said["cc"] * 40, "cc") for i in range(60)]
    model, languages = language_id.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), steps=150)
    assert languages == ["aa", "bb", "cc"]
    got = language_id.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model, languages, keep=["doc_id", "lang"]).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95
    short = [r for r in rows if r[2] != "cc"]
    assert language_id.fit(spark.createDataFrame(short, "doc_id long, text string, lang string"), steps=2)[1] == ["aa", "bb"]


def test_filled_windows_have_the_states_of_their_own_length():
    model = language_id.new_model(["a", "b"])
    x = np.zeros((1, 9), np.uint8)
    x[0, :5] = [3, 1, 4, 1, 5]
    inside = (np.arange(9)[:, None, None] < 5).astype(np.float32)
    for way in "fb":
        assert np.allclose(language_id.run_way(model, way, x, inside=inside)[:5], language_id.run_way(model, way, x[:, :5]), atol=1e-6)


def text_of(seed, n=60):
    return " ".join(f"word{seed}x{i}" for i in range(n))


def test_null_ids_are_decontaminated(spark, tmp_path):
    leak, other, clean = text_of(1, 20), text_of(2, 20), text_of(3)
    items = spark.createDataFrame([(1, leak), (None, other), (None, text_of(4, 20))], "item_id long, text string")
    rows = [(None, f"{clean} {leak}"), (None, f"a {leak}"), (None, clean), (5, f"{clean} {other}"), (6, clean), (7, leak), (7, clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.item_id, r.containment) for r in decontamination.contaminated(docs, items).collect()]
    assert sorted(got, key=str) == sorted([(None, 1, 1.0), (None, 1, 1.0), (5, None, 1.0), (7, 1, 1.0)], key=str)
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [tuple(r) for r in corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path)).collect()]
    assert sorted(left, key=str) == sorted([(None, clean), (6, clean), (7, clean)], key=str)


def test_copies_with_null_or_repeated_ids_go(spark):
    a, b, c, d = map(text_of, range(10, 14))
    rows = [(None, a), (None, a), (3, a), (1, a), (None, b), (2, c), (2, c), (2, d), (None, f"{d} more")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = [tuple(r) for r in corpus_pipeline.near_duplicate_stage(spark, docs, "").collect()]
    assert sorted(left, key=str) == sorted([(1, a), (None, b), (2, c), (2, d)], key=str)


def test_nearest_takes_the_smallest_ids_of_equals(spark):
    rng = np.random.Generator(np.random.PCG64(5))
    copy, far = rng.normal(size=16).tolist(), rng.normal(size=16).tolist()
    order = rng.permutation(300).tolist()
    rows = [(i, copy if i % 2 else far) for i in order]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)
    for block_rows in (2048, 40):
        got = corpus.nearest(vectors, vectors.where("vec_id in (1, 100)"), k=4, block_rows=block_rows).orderBy("query_id", "rank").collect()
        assert [(r.query_id, r.vec_id) for r in got] == [(1, 3), (1, 5), (1, 7), (1, 9), (100, 0), (100, 2), (100, 4), (100, 6)]


def test_short_items_are_found_by_all_their_words(spark):
    texts = {1: "So Hello\tWORLD again", 2: "hello", 3: "hello big world", 4: None, 5: "", 6: "one two three four five six seven", 7: "two three four", 8: "x hello world"}
    told = {1: "hello world", 2: "Two three  four", 3: "one two three four five six", 4: "hello", 5: "", 6: None, 7: "four", 8: "not there"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    items = spark.createDataFrame(list(told.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    split = lambda t: (t or "").lower().split()
    runs = lambda w, n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
    want = set()
    for d, a in texts.items():
        for i, b in told.items():
            w = split(b)
            if w:
                n = min(5, len(w))
                asked = runs(w, n)
                if len(asked & runs(split(a), n)) * 100 >= 75 * len(asked):
                    want.add((d, i))
    assert got == want and (1, 1) in want and (8, 1) in want and (3, 1) not in want and (7, 2) in want
    left = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items, short=False).collect()}
    assert left == {(6, 3)}


def test_short_items_equal_the_sql(spark, tmp_path):
    import duckdb

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    words = docs.where("text is not null").orderBy("doc_id").limit(40).collect()
    short = [(1000 + i, " ".join(r.text.split()[i % 3 : i % 3 + 1 + i % 4]).upper()) for i, r in enumerate(words)]
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").union(spark.createDataFrame(short, "item_id long, text string"))
    items.coalesce(1).write.parquet(f"{tmp_path}/b")
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{tmp_path}/b/*.parquet'")
    want = sorted(map(tuple, con.execute(f"SELECT doc_id, item_id, n_item, n_shared FROM ({decontamination.OP9_SQL})").fetchall()))
    got = decontamination.contaminated(docs, spark.read.parquet(f"{tmp_path}/b")).select("doc_id", "item_id", "n_item", "n_shared")
    assert sorted(map(tuple, got.collect())) == want and any(i >= 1000 for _, i, *_ in want)
