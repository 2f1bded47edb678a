"""The methods themselves against brute force, and the cases that each operator names."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from omenflow.llm import archive, extraction, language_id, lm_scoring, sharding, tokenizer, url_filter
from tests.llm.test_operators import TEXTS, words


def fold(i):
    import zlib

    return zlib.crc32(str(i).encode()) % 5


def counted(texts, order):
    """Counts of n-grams and of their contexts; a text begins with starts and ends with an end."""
    grams, contexts = [Counter() for _ in range(order + 1)], [Counter() for _ in range(order + 1)]
    for t in texts:
        line = ["<s>"] * (order - 1) + [*words(t), "</s>"]
        for i in range(order - 1, len(line)):
            for n in range(1, order + 1):
                grams[n][tuple(line[i - n + 1 : i + 1])] += 1
                contexts[n][tuple(line[i - n + 1 : i])] += 1
    return grams, contexts


def estimates(grams, contexts, line, i, order):
    """Estimates of each order, and the bucket of the longest context that was met."""
    out, level = [], 0
    for n in range(1, order + 1):
        c = contexts[n][tuple(line[i - n + 1 : i])]
        out.append(grams[n][tuple(line[i - n + 1 : i + 1])] / c if c else 0.0)
        if n > 1 and c:
            level = (n - 2) * lm_scoring.LEVELS + 1 + min(lm_scoring.LEVELS - 1, int(math.log2(c)))
    return out, level


@pytest.mark.parametrize("order", [2, 3])
def test_lm_scores_equal_brute_force(spark, order):
    texts = [t for t in TEXTS if t is None or len(t) < 2000] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    train = [t for i, t in enumerate(texts) if fold(i) != 1]
    rest = [t for i, t in enumerate(texts) if fold(i) not in (1, 2)]
    known = {w for t in train for w in [*words(t), "</s>"]}
    uniform = 1 / (len(known) + 1)
    hist = Counter()
    deleted = counted(rest, order)
    for t in (t for i, t in enumerate(texts) if fold(i) == 2):
        line = ["<s>"] * (order - 1) + [*words(t), "</s>"]
        for i in range(order - 1, len(line)):
            f, level = estimates(*deleted, line, i, order)
            hist[(level, *(int(lm_scoring.quantised(np.array([x]), uniform)[0]) for x in f))] += 1
    weights = lm_scoring.learn_weights(hist, order)
    full = counted(train, order)
    got = {r.doc_id: r.score for r in lm_scoring.score(docs, order=order).collect()}
    for d, t in enumerate(texts):
        line = ["<s>"] * (order - 1) + [*words(t), "</s>"]
        want = 0.0
        for i in range(order - 1, len(line)):
            f, level = estimates(*full, line, i, order)
            want += math.log10(weights[level][0] * uniform + sum(w * x for w, x in zip(weights[level][1:], f, strict=True)))
        assert got[d] == pytest.approx(want, rel=1e-6)
    # The mixture sums to 1 over the vocabulary and the unknown token, in contexts that were met and others.
    for before in (["the"], ["never-seen"], ["quick", "brown"][-(order - 1) :]):
        line = (["zzz"] * order + before)[-(order - 1) :] + [None]
        total = 0.0
        for w in [*known, "<unknown>"]:
            line[-1] = w
            f, level = estimates(*full, line, len(line) - 1, order)
            total += weights[level][0] * uniform + sum(a * x for a, x in zip(weights[level][1:], f, strict=True))
        assert total == pytest.approx(1)
        assert weights[level][0] > 1e-9


def test_weights_of_a_bucket_without_counts_are_a_distribution_of_the_met_orders():
    w = lm_scoring.learn_weights({(5, 40, 60): 1000, (0, 40, 0): 10}, 2)
    assert w.sum(axis=1) == pytest.approx(np.ones(len(w))) and w[0][2] == 0 and w[0][0] > 0.01


def model_of(bodies, order):
    """Counts of n-grams, and of contexts with what came after them."""
    grams, after = Counter(), defaultdict(Counter)
    for body in bodies:
        line = url_filter.START * order + body + url_filter.END
        for i in range(order, len(line)):
            for k in range(order + 1):
                grams[line[i - k : i + 1]] += 1
                after[line[i - k : i]][line[i]] += 1
    return grams, after


def log_p(model, line, i, order):
    grams, after = model
    p = 1 / 1024
    for k in range(order + 1):
        c = after.get(line[i - k : i], {})
        n, t = sum(c.values()), len(c)
        if n:
            p = (grams[line[i - k : i + 1]] + t * p) / (n + t)
    return math.log(p)


def test_url_ratios_equal_brute_force(spark):
    order = 3
    good, bad = [f"a{i}.com/news/{i}" for i in range(6)] * 2, [f"b{i}.net/es/x{i}" for i in range(6)]
    rows = [(x, True) for x in good] + [(x, False) for x in bad]
    model = url_filter.train(spark.createDataFrame(rows, "body string, accepted boolean"), order)
    asked = ["a1.com/news/1", "c.org/é/𝒳", "b9.net/es/", "z" * 40]
    a, b = model_of(good, order), model_of(bad, order)
    for r in url_filter.ratios(spark.createDataFrame([(x,) for x in asked], "body string"), model, order).collect():
        line = url_filter.START * order + r.body + url_filter.END
        each = [log_p(a, line, i, order) - log_p(b, line, i, order) for i in range(order, len(line))]
        assert r.ratio == pytest.approx(sum(each) / len(each))


def test_urls_by_rule_by_model_and_very_long(spark):
    rows = [(i, f"http://x{i}.com/{'ab' * (i % 7)}") for i in range(60)] + [(100 + i, f"http://y{i}.net/fr/{'qz' * (i % 7)}") for i in range(60)]
    rows += [(300, "http://o.org/" + "ab" * 50_000), (301, "http://o.org/" + "qz" * 50_000), (302, "http://o.org/abab"), (302, "http://o.org/abab"), (None, "http://X1.com/"), (304, "http://a.com?://b/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("gram", F.lit("clash"))
    got = url_filter.judge(pages).collect()
    by = {r.id: r for r in got}
    assert len(got) == len(rows) and by[300].verdict == "allow" and by[301].verdict == "block" and by[None].verdict == "allow" and (by[304].host, by[304].path) == ("a.com", "")
    assert url_filter.judge(pages.where("page_id < 0")).count() == 0
    rules = (("com", "/", "allow"), ("com", "/", "block"))
    assert {r.rule for r in spark.range(1).select(url_filter.ruled(F.lit("a.com"), F.lit("/"), rules)[1].alias("rule")).collect()} == {"allow"}


def test_packing_equals_the_greedy_rule_and_copies_stay_together(spark):
    rng = np.random.default_rng(2)
    items = rng.integers(1, 100, (60, 3)).astype(float)
    unit = items / (items.sum(axis=0) / 4)
    residual, want = [[1.0] * 3 for _ in range(4)], [0] * 60
    for i in sorted(range(60), key=lambda i: (-unit[i].max(), i)):
        dots = [sum(r * u for r, u in zip(res, unit[i], strict=True)) for res in residual]
        want[i] = dots.index(max(dots))
        residual[want[i]] = [r - u for r, u in zip(residual[want[i]], unit[i], strict=True)]
    assert sharding.pack(items, 4).tolist() == want
    texts = [f"text {i % 300} " + "word " * (i % 300 % 37) for i in range(900)] + ["hot"] * 600
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for rows_each in (1 << 17, 1):
        old, sharding.PART_ROWS = sharding.PART_ROWS, rows_each
        try:
            got = sharding.shard(docs, n_shards=5, per_shard=64).collect()
        finally:
            sharding.PART_ROWS = old
        sizes, counts, homes = [0] * 5, [[] for _ in range(5)], defaultdict(set)
        for r in got:
            sizes[r.shard] += r["size"]
            counts[r.shard].append(r.slot)
            homes[texts[r.id]].add(r.shard)
        assert max(sizes) < 1.03 * min(sizes) and max(map(len, counts)) < 1.1 * min(map(len, counts))
        assert all(sorted(x) == list(range(len(x))) for x in counts)
        assert all(len(h) == 1 for t, h in homes.items() if t != "hot") and len(homes["hot"]) > 1


def test_archive_cases(spark, tmp_path):
    rows = [(1, "u\r\nWARC-Refers-To: <urn:page:77>", "x"), (2, None, "x"), (None, "v", "x"), (3, "u", "y\r\n\r\nz"), (3, "u", "y\r\n\r\nz"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"sha256": F.lit(1), "id": F.lit(2), "payload": F.lit(3)})
    path = f"file://{tmp_path}/a"
    archive.write_archive(pages, path, date="2024-01-01T00:00:00Z")
    read = archive.read_archive(spark, path)
    got = sorted(((r.id, r.payload_bytes, r.record_type, r.refers_to) for r in archive.records(read).collect()), key=str)
    assert got == sorted([(1, 1, "revisit", 2), (2, 1, "response", None), (None, 1, "revisit", 2), (3, 6, "response", None), (3, 6, "response", None), (None, 0, "response", None)], key=str)
    assert all(b"\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n" in bytes(r.header) and bytes(r.header).count(b"WARC-Refers-To") <= 1 + (r.id == 1) for r in read.collect())
    assert all(bytes(r.header).index(b"\r\n\r\n") == len(bytes(r.header)) - 4 for r in read.collect())
    archive.write_archive(pages.where("false"), f"{path}0")
    assert archive.records(archive.read_archive(spark, f"{path}0")).count() == 0
    texts = spark.createDataFrame([("a>b", "u", "x"), ("c", "u", "x")], "page_id string, url string, html string")
    archive.write_archive(texts, f"{path}1")
    assert {r.id: r.refers_to for r in archive.records(archive.read_archive(spark, f"{path}1")).collect()} == {"a>b": "c", "c": None}
    archive.write_archive(pages, f"{path}2", min_bytes=2)
    assert {r.record_type for r in archive.records(archive.read_archive(spark, f"{path}2")).collect()} == {"response"}


@pytest.mark.parametrize("filled", [False, True])
def test_gradients_equal_differences(filled):
    rng = np.random.default_rng(4)
    model = {k: v.astype(np.float64) for k, v in language_id.new_model(["a", "b", "c"], 3).items()}
    x = rng.integers(0, 5, (4, 7)).astype(np.uint8)
    want = np.eye(3)[[0, 1, 2, 0]]
    inside = (np.arange(7)[:, None] < np.array([7, 3, 5, 1])).astype(float)[:, :, None] if filled else None
    _, grad = language_id.gradients(model, x, want, inside)
    for name, g in grad.items():
        for at in [np.unravel_index(i, g.shape) for i in np.argsort(-np.abs(g).ravel())[:6]]:
            ends = []
            for step in (1e-5, -1e-5):
                moved = {k: v.copy() for k, v in model.items()}
                moved[name][at] += step
                ends.append(language_id.gradients(moved, x, want, inside)[0])
            assert g[at] == pytest.approx((ends[0] - ends[1]) / 2e-5, rel=1e-4, abs=1e-9)


def test_one_language_no_language_and_equal_texts(spark):
    rows = [(i, "some words of one tongue", "aa") for i in range(30)] + [(99, None, "aa"), (100, "12 !", None), (101, "", "aa"), (None, "some words of one tongue", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("clash"))
    got = language_id.identify(docs).collect()
    assert len(got) == len(rows) and {(r.lang_pred, round(r.score, 9)) for r in got if r.doc_id is None or r.doc_id < 30} == {("aa", 1.0)}
    assert {r.lang_pred for r in got if r.doc_id in (99, 100, 101)} == {"und"}
    assert {r.lang_pred for r in language_id.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_long_unbroken_words_and_ids_of_other_types(spark):
    lib = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer.vocabulary_path())
    rng = np.random.default_rng(6)
    texts = {"a": "".join(rng.choice(list("etaoinshrdlu"), 60_000)), "b": "ab" * 700 + "ü" * 900, "c": "A" * 513 + " " + "é" * 256, None: "null id"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string").withColumn("ids", F.lit(1))
    got = tokenizer.digests(docs).collect()
    assert {r.doc_id for r in got} == set(texts)
    for r in got:
        ids = lib.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    ranks = tokenizer.codec(tokenizer.vocabulary_path()).ranks
    for n in (2, 3, 40, 600):
        word = "".join(rng.choice(list("aeinrst"), n)).encode()
        assert tokenizer.merge_word(word, ranks) == tokenizer.merge_long_word(word, ranks)
    back = tokenizer.decode(tokenizer.encode(docs)).collect()
    assert all(r.decoded == texts[r.doc_id] for r in back)


def test_extraction_by_whole_names_and_host_votes(spark):
    page = "<html><body><div class='site-header'>Name</div><article><header class='entry-header'><h1>T</h1></header><div class='share-price-analysis'><p>Price.</p></div><div class='article-header'><p>Lead.</p></div><p>A <math><mi>x</mi></math> b</p><div class='social-share'>Share</div></article><div class='related-posts sidebar-left'><p>Other</p></div></body></html>"
    assert extraction.Page(page).extract([]).split("\n\n") == ["T", "Price.", "Lead.", "A x b"]
    body = "<p>" + "Words of the page itself. " * 5 + "</p>"
    votes = [("h", f"<html><body><div class='c{i % 2}'>{body}</div></body></html>") for i in range(9)] + [("h", f"<html><body><main>{body}</main></body></html>"), ("g", f"<html><body><section>{body}</section></body></html>")]
    rows = spark.createDataFrame(votes, "host string, html string")
    got = {r.host: (r.paths, r._n) for r in extraction.winning_paths(extraction.votes(rows)).collect()}
    want = defaultdict(Counter)
    for host, html in votes:
        want[host][extraction.Page(html).vote()[0]] += 1
    for host, c in want.items():
        assert got[host] == ([p for p, n in sorted(c.items(), key=lambda x: (-x[1], x[0])) if n * 10 >= sum(c.values())], sum(c.values()))
    assert got["h"][0] == ["html/body/div.c", "html/body/main"]
    long = "<article>" + "".join(f"<p>Line {i} of it.</p>" for i in range(20_000)) + "</article>"
    pages = spark.createDataFrame([(1, "http://a.org/1", long), (1, "http://a.org/1", long), (None, None, None)], "page_id long, url string, html string").withColumns({"host": F.lit(1), "paths": F.lit(2)})
    texts = sorted((r.page_id is None, r.n_chars, r.text.count("\n\n")) for r in extraction.extract(pages).collect())
    assert [x[2] for x in texts] == [19_999, 19_999, 0] and texts[2][1] == 0
    assert extraction.extract(pages.where("page_id < 0")).count() == 0


SAID = {"en": "alpha beta gamma delta", "fr": "éta zêta ithé kappé"}


def text_of(lang, seed, n=40):
    rng = np.random.default_rng(seed)
    return " ".join(f"{rng.choice(SAID[lang].split())}{rng.choice(list('bcdfg'))}" for _ in range(n))


def test_pipeline_keeps_what_brute_force_keeps(spark, tmp_path):
    rows = [(i, text_of("en" if i % 2 else "fr", i), "en" if i % 2 else "fr") for i in range(40)]
    leak = " ".join(f"leak{i}" for i in range(20))
    rows += [(100, rows[3][1], None), (101, rows[4][1] + " more", "fr"), (101, rows[4][1] + " more", "fr"), (102, f"{text_of('en', 900)} {leak}", "en"), (103, None, "en"), (104, "12 34", None), (None, rows[5][1], "en"), (105, "", "fr")]
    lib = pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer.vocabulary_path())
    docs = spark.createDataFrame([(*r, "src", len(r[1] or ""), "clash") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, component_id string")
    spark.createDataFrame([(1, leak), (None, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert sorted(got) == list(range(40))
    for i, t, _ in rows[:40]:
        ids = lib.encode(t, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and got[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    empty = tmp_path / "empty"
    docs.where("false").write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(empty)).count() == 0
    kept = corpus_pipeline.language_stage(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r[0] for r in rows} - {103, 104, 105}
