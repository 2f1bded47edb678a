"""Operators on small hard tables: nulls, empty texts, copies, ties, extra columns, empty tables; against brute force."""

import base64
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from omenflow.llm import archive, decontamination, extraction, fingerprints, jaccard, language_id, lm_scoring, sharding, tokenizer, url_filter

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i * 7919 % 1013}" for i in range(9000))
TEXTS = [None, "", "One", "A b c d", "a B c d", *[f"the quick brown fox jumps over lazy dog number {i % 3}. Again and again.\nNew line {i % 2} here" for i in range(12)], LONG, LONG + " more", "!!! 123", "é ü ñ naïve café déjà vu encore une fois"]


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOW))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], "src", len(t or ""), "clash") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, h string").repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("doc_id < 0")


def test_lm_base_scores_are_exact(docs, nothing):
    got = {r.doc_id: r for r in lm_scoring.score(docs).collect()}
    train, seen = [], {}
    for i, t in enumerate(TEXTS):
        if zlib.crc32(str(i).encode()) % 5 != 1:
            train += [*words(t), None]
    for w in train:
        seen[w] = seen.get(w, 0) + 1
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        mine = [*words(t), None]
        want = sum(np.log10((seen.get(w, 0) + 0.5) / (len(train) + 0.5 * (len(seen) + 1))) for w in mine)
        assert got[i].base_score == pytest.approx(want) and got[i].n_tokens == len(mine) and got[i].train_tokens == len(train)
        assert got[i].n_known == sum(w in seen for w in mine) and got[i].score < 0
    assert lm_scoring.score(nothing).count() == 0


def test_em_finds_the_better_estimate():
    w = lm_scoring.learn_weights({(5, 40, 60): 1000, (5, 40, 0): 10}, 2)
    assert w[5].sum() == pytest.approx(1) and w[5][2] > 0.8


def test_url_rules_and_null(spark):
    urls = [(1, "https://a.example.com/en/x", 0), (2, "http://www.example.com/en/", 0), (3, None, 0), (4, "no scheme", 0), (5, "http://X.NET/es/?q", 0), (6, "http://b.org/p", 0), (6, "http://b.org/p", 0)]
    got = [(r.id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(spark.createDataFrame(urls, "page_id long, url string, host int")).collect()]
    assert len(got) == 7
    by = {g[0]: g for g in got}
    assert by[1][3:] == ("example.com/en/", "block") and by[2][3:] == ("www.example.com/en/", "allow") and by[5][1:] == ("x.net", "/es/", "net/es/", "block")
    assert by[3][1:4] == ("", "", None) and by[4][1:4] == ("", "", None)


def test_shards_are_even_and_gapless(docs, nothing):
    rows = sharding.shard(docs, n_shards=3).collect()
    assert len(rows) == len(TEXTS)
    for k in range(3):
        slots = sorted(r.slot for r in rows if r.shard == k)
        assert slots == list(range(len(slots)))
    assert all(r["size"] == len((TEXTS[r.id] or "").encode()) + 16 and r.text_crc32 == zlib.crc32((TEXTS[r.id] or "").encode()) for r in rows)
    assert sharding.shard(nothing, n_shards=3).count() == 0


def test_archive_round_trip(spark, tmp_path):
    pages = [(1, "u", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "v", ""), (5, "w", "x")]
    archive.write_archive(spark.createDataFrame(pages, "page_id long, url string, html string"), f"file://{tmp_path}/a")
    read = archive.read_archive(spark, f"file://{tmp_path}/a")
    got = {r.id: r for r in archive.records(read).collect()}
    for i, _, h in pages:
        raw = (h or "").encode()
        assert got[i].payload_bytes == len(raw) and got[i].payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
    assert [got[i].record_type for i in range(1, 6)] == ["revisit", "response", "revisit", "response", "response"]
    assert got[1].refers_to == 2 and got[3].refers_to == 4 and got[2].refers_to is None
    whole = {r.id: bytes(r.x) for r in read.select("id", archive.record_bytes(F.col("header"), F.col("payload")).alias("x")).collect()}
    assert whole[2].startswith(b"WARC/1.1\r\n") and whole[2].endswith("<p>é</p>\r\n\r\n".encode())


def test_language_gradients_and_unknown(docs, nothing):
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {i for i, t in enumerate(TEXTS) if not re.search(r"[^\W\d_]", t or "")}
    assert all(0 <= r.score <= 1 for r in got.values())
    assert language_id.identify(nothing).count() == 0
    rng = np.random.default_rng(1)
    x = np.where(np.arange(200)[:, None] % 2 == 0, rng.integers(97, 105, (200, 16)), rng.integers(105, 113, (200, 16))).astype(np.uint8)
    model = language_id.train(x, np.arange(200) % 2, ["a", "b"], steps=60, batch=64)
    assert (language_id.log_odds(model, x).mean(axis=0).argmax(axis=1) == np.arange(200) % 2).mean() > 0.95


def test_fingerprints_find_the_exact_difference(docs, nothing):
    rows = fingerprints.with_next(docs, ranges=4)
    pairs = {r.doc_id: r for r in fingerprints.compare_versions(rows, "next_text").collect()}
    cut = lambda t: {x for x in re.split(fingerprints.SENTENCE.replace("\\\\", "\\"), t) if x}
    for i in range(len(TEXTS)):
        a, b = TEXTS[i] or "", TEXTS[i - 1 if i else len(TEXTS) - 1] or ""
        assert pairs[i].next_text == b
        x, y = cut(a), cut(b)
        assert pairs[i].next_text_likeness == pytest.approx(len(x & y) / len(x | y) if x | y else 1.0)
    assert fingerprints.with_next(nothing).count() == 0
    many = "\n".join(f"line {i}" for i in range(400))
    big = docs.sparkSession.createDataFrame([(many, many.replace("line 1", "row 1"))], "text string, other string")
    r = fingerprints.compare_versions(big, "other").first()
    changed = sum(str(i).startswith("1") for i in range(400))
    assert r.other_likeness == pytest.approx((400 - changed) / (400 + changed))


def test_bpe_equals_the_library(docs, nothing):
    tokenizers = pytest.importorskip("tokenizers")
    lib = tokenizers.Tokenizer.from_file(tokenizer.vocabulary_path())
    for r in tokenizer.digests(docs).collect():
        ids = lib.encode(TEXTS[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert tokenizer.digests(nothing).count() == 0


def shingles(t):
    w = words(t)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


@pytest.mark.parametrize(("block", "long_list"), [(512, 1 << 13), (2, 1 << 13), (512, 0), (2, 2)])
def test_jaccard_join_equals_brute_force(docs, nothing, block, long_list):
    sets = [shingles(t) for t in TEXTS]
    top = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for k, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    top[i] = min(top[i], top[k])
    got = {r.doc_id: r for r in jaccard.link_components(docs, block=block, long_list=long_list).collect()}
    assert [got[i].component_id for i in range(len(sets))] == top
    assert [got[i].n_shingles for i in range(len(sets))] == [len(s) for s in sets]
    assert jaccard.link_components(nothing).count() == 0


def test_decontamination_finds_contained_items(docs, nothing):
    items = docs.sparkSession.createDataFrame([(1, " ".join(LONG.split()[300:340])), (2, "nothing of this is in any of them"), (3, None), (4, "too short")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.containment for r in decontamination.contaminated(docs, items).collect()}
    assert got == {(TEXTS.index(LONG), 1): 1.0, (TEXTS.index(LONG) + 1, 1): 1.0}
    assert decontamination.contaminated(nothing, items).count() == 0 and decontamination.contaminated(docs, items.where("item_id < 0")).count() == 0


def test_extraction_leaves_out_what_is_not_the_article(spark):
    page = "<html><body><nav><a href=x>menu</a></nav><article><h1>A &amp; B</h1><p>One  two\nthree</p><script>x()</script><p>Four</p></article><div class='comments'><p>reader comment</p></div><footer>foot</footer></body></html>"
    rows = spark.createDataFrame([(1, "http://a.org/1", page), (2, None, None), (3, "http://a.org/2", "")], "page_id long, url string, html string")
    got = {r.page_id: r for r in extraction.extract(rows).collect()}
    assert got[1].text == "A & B\n\nOne two three\n\nFour" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == ""


def test_pipeline_keeps_clean_documents(spark):
    import corpus_pipeline

    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    n = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert 0.5 * n < out.count() <= n
