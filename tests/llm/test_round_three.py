"""Hard negatives, chat formatting and whitening against brute force, and on hard tables."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from omenflow.llm import chat, hard_negatives, whitening

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id long, embedding array<float>, label int, row string"


def spoiled(n, d, seed, copies=0):
    """Clustered vectors, copies of one of them, and rows that take no part."""
    rng = np.random.Generator(np.random.PCG64(seed))
    middle = rng.normal(size=(5, d))
    rows = [(i, (middle[i % 5] + rng.normal(size=d) * 0.3).tolist(), int(rng.integers(0, 3)), "x") for i in range(n)]
    rows += [(n + i, rows[0][1], i % 3, "x") for i in range(copies)]
    bad = [(5000, None, 1, "x"), (5001, [1.0, None] + [0.0] * (d - 2), 1, "x"), (5002, [NAN] * d, 1, "x"), (5003, [INF] * d, 1, "x")]
    return rows + bad


def brute_negatives(rows, step=10, k=5):
    ok = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(object), l) for i, v, l, _ in rows if l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    d = max(len(v) for _, v, _ in ok)
    ok = [(i, [int(x) for x in v] + [0] * (d - len(v)), l) for i, v, l in ok]
    out = []
    for at, (i, v, l) in enumerate(ok):
        if i is None or i % step:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w, strict=True)), (j is None, j or 0), p, j, m) for p, (j, w, m) in enumerate(ok)]
        scored.sort()
        same = [x for x in scored if x[4] == l and x[2] != at][:k]
        for p in same:
            near = [x for x in scored if x[4] != l and -80 * p[0] <= -100 * x[0] <= -100 * p[0]][:k]
            out += [(i, p[3], r + 1, x[3], -p[0], -x[0]) for r, x in enumerate(near)]
    return sorted(out, key=str)


def mined(df, **more):
    return sorted(map(tuple, hard_negatives.mine(df, F.col("vec_id") % 10 == 0, **more).collect()), key=str)


@pytest.mark.parametrize(("cells", "size"), [(1, 4096), (8, 40), (64, 7)])
def test_hard_negatives_equal_brute_force(spark, cells, size):
    rows = [*spoiled(260, 6, 3, copies=90), (None, [0.5] * 6, 1, "x"), (3000, [1.0] * 6, None, "x"), (40, [0.3] * 6, 2, "x"), (40, [0.3] * 6, 2, "x"), (3010, [0.2], 0, "x"), (3020, [], 0, "x")]
    df = spark.createDataFrame(rows, VECTORS).repartition(3, "vec_id")
    got = mined(df, cells=cells, block_rows=size)
    assert got == brute_negatives(rows) and len(got) > 300


def test_hard_negatives_of_large_numbers_are_exact(spark):
    rows = [(i, [float(1 << 20) * (i % 7 + 1), float(i), 3.0], i % 2, "x") for i in range(40)]
    got = mined(spark.createDataFrame(rows, VECTORS), cells=4, block_rows=9)
    assert got == brute_negatives(rows) and got


def test_hard_negatives_without_rows(spark):
    none = spark.createDataFrame([], VECTORS)
    assert mined(none) == []
    one = spark.createDataFrame([(0, [1.0, 2.0], 1, "x"), (1, [1.0, 2.0], 0, "x")], VECTORS)
    assert mined(one) == []  # no positive
    below = spark.createDataFrame([(0, [1.0], 1, "x"), (1, [-1.0], 1, "x"), (2, [-1.0], 0, "x")], VECTORS)
    assert mined(below) == []  # a window below 0 is empty


def test_node_intervals_hold_all_products():
    rng = np.random.Generator(np.random.PCG64(2))
    for _ in range(50):
        a, b = (np.floor(rng.normal(size=(int(rng.integers(1, 9)), 5)) * 300 + rng.normal(size=5) * 200) for _ in range(2))
        ball = lambda x: (c := x.mean(axis=0), np.linalg.norm(x - c, axis=1).max(), np.linalg.norm(x, axis=1).min(), np.linalg.norm(x, axis=1).max())
        low, high = hard_negatives.interval(*ball(a), *ball(b))
        assert low <= (a @ b.T).min() and (a @ b.T).max() <= high


def test_search_scores_few_of_all_pairs_in_clusters(monkeypatch):
    rng = np.random.Generator(np.random.PCG64(8))
    middle = rng.normal(size=(40, 16)) * 200
    x = np.floor(np.repeat(middle, 50, axis=0) + rng.normal(size=(2000, 16)))
    labels, ids = np.arange(2000) % 2, np.arange(2000)
    tree = hard_negatives.Tree(x, labels, ids, 16)
    mine = hard_negatives.Tree(x[::20], labels[::20], ids[::20], 4)
    seen = []
    exact = hard_negatives.products
    monkeypatch.setattr(hard_negatives, "products", lambda a, b, bound: seen.append(len(a) * len(b)) or exact(a, b, bound))
    open_ = np.full((100, 1), hard_negatives.LEAST + 1), np.full((100, 1), hard_negatives.MOST)
    best = hard_negatives.search(mine, *open_, mine.ids, tree, tree.ids, True, 5)
    want = np.sort(np.where((labels[::20, None] == labels) & (ids[::20, None] != ids), x[::20] @ x.T, -np.inf), axis=1)[:, -5:][:, ::-1]
    assert (best.score[:, 0] == want[mine.order]).all()
    assert sum(seen) < 100 * 2000 / 8


# Chat

TURNS = [("user", "a"), ("assistant", "b"), ("assistant", ""), ("system", "\\"), ("tool", "<s>\\[INST]"), ("", "[/INST]\\\\"), ("assistant", "\\</s> é\n[ROLE]x[TEXT]y[/ROLE]")]


def expected(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(said), sha(said), sum(len(chat.turn_text(r, t)[0]) for r, t in turns)


def read(df, **more):
    return {r[0]: tuple(r[1:]) for r in chat.read_back(chat.format_turns(df, **more)).collect()}


def test_turns_come_back_from_text_and_mask(spark):
    rows = [(7, k, r, t, "x") for k, (r, t) in enumerate(TURNS)]
    rows += [(8, None, "user", None, "x"), (8, 0, None, "q", "x"), (None, 0, "user", "n", "x"), (None, 1, "assistant", "m", "x"), (9, 0, "user", "same", "x"), (9, 0, "user", "same", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(4)
    want = {7: expected(TURNS), 8: expected([("", "q"), ("user", "")]), None: expected([("user", "n"), ("assistant", "m")]), 9: expected([("user", "same")] * 2)}
    for segment in (1, 20, 1 << 20):
        assert read(chat.table_turns(df), segment=segment) == want
    assert read(chat.table_turns(df.limit(0))) == {}


def test_a_long_conversation_comes_in_bounded_segments(spark):
    rows = [(1, k, ["user", "assistant"][k % 2], "word " * 50) for k in range(3000)]
    out = chat.format_turns(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), segment=10_000)
    sizes = [r.chars for r in out.collect()]
    assert len(sizes) > 70 and max(sizes) < 10_300
    stored = out.repartition(5)
    got = chat.read_back(chat.in_order(stored)).first()
    assert tuple(got)[1:] == expected([(r[2], r[3]) for r in rows])


def test_escapes_round_trip_and_stay_linear():
    rng = np.random.Generator(np.random.PCG64(4))
    pieces = ["\\", "[INST]", "[/INST]", "<s>", "</s>", "[SYS]", "[", "<", "[ROLE]", "[TEXT]", "[/ROLE]", "a", "\n"]
    for _ in range(5000):
        turns = [(["user", "assistant", "x\\"][int(rng.integers(3))], "".join(rng.choice(pieces, int(rng.integers(7))))) for _ in range(int(rng.integers(4)))]
        assert chat.read_turns("".join(chat.turn_text(*t)[0] for t in turns)) == turns
    long = "\\" * 1_000_000 + "x" + "\\" * 1_000_000
    assert chat.unescaped(chat.escaped(long)) == long
    for broken in ("x", "[INST]a", "</s>", "[INST]a</s>", "[ROLE]a[/ROLE]"):
        with pytest.raises(ValueError, match=r"."):
            chat.read_turns(broken)


LAYOUTS = {
    "messages": {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]},
    "conversations": {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
    "dialogue": {"dialogue": {"turns": [{"speaker": "human", "utterance": "q"}, {"speaker": "bot", "utterance": "a"}]}},
    "prompt_completion": {"prompt": "q", "completion": "a"},
    "prompt_response": {"prompt": "q", "response": "a", "source": "extra", "meta": {"x": [1]}},
    "question_answer": {"question": "q", "answer": "a"},
    "instruction": {"instruction": "q", "output": "a"},
    "instruction_input": {"instruction": "q", "input": "", "output": "a"},
}
PLAIN = [("user", "q"), ("assistant", "a")]


def test_records_of_many_layouts_become_the_same_turns(spark):
    rows = [(i, json.dumps(x)) for i, x in enumerate(LAYOUTS.values())]
    more = [json.dumps({"system": "s", "prompt": "q", "response": None}), json.dumps({"instruction": "q", "input": "more", "output": 5}), None, "no json", "[]", '{"other": 1}', '{"messages": ["x"]}', '{"prompt": "\\ud800", "response": "a"}', '{"messages": []}']
    df = spark.createDataFrame(rows + [(100 + i, x) for i, x in enumerate(more)], "conv_id long, record string")
    got = {}
    for r in chat.json_turns(df, "record").orderBy("conv_id", "turn").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    assert [got[i] for i in range(len(LAYOUTS))] == [PLAIN] * len(LAYOUTS)
    assert got[100] == [("system", "s"), ("user", "q"), ("assistant", "")] and got[101] == [("user", "q\n\nmore"), ("assistant", "5")]
    assert sorted(r.conv_id for r in chat.unmapped(df, "record").collect()) == [102, 103, 104, 105, 106, 107, 108]


@pytest.mark.parametrize("name", list(LAYOUTS))
def test_tables_of_many_layouts_become_the_same_turns(spark, name):
    df = spark.read.json(spark.sparkContext.parallelize([json.dumps({"conv_id": 1, "turn_no": 3} | LAYOUTS[name])]))
    assert [(r.role, r.text) for r in chat.table_turns(df).orderBy("turn").collect()] == PLAIN


def test_layouts_without_a_mapping_and_mappings_that_clash(spark):
    with pytest.raises(ValueError, match="no mapping"):
        chat.table_turns(spark.createDataFrame([(1, "x")], "conv_id long, other string"))
    with pytest.raises(ValueError, match="same field paths"):
        chat.Layouts((*chat.MAPPINGS, chat.Mapping("again", fields=(("user", ("prompt",)), ("assistant", ("response",))))))
    assert chat.fingerprint(["a", "b[].c"]) == chat.fingerprint(["b[].c", "a"]) != chat.fingerprint(["a", "b.c"])


# Whitening


def whitened(df, **more):
    return whitening.whiten(df, **more).collect()


def test_whitening_equals_the_eigenvectors(spark):
    rows = spoiled(300, 7, 9, copies=150)
    got = whitened(spark.createDataFrame([*rows, (None, rows[3][1], 1, "x"), (4, rows[5][1], 1, "x")], VECTORS).repartition(5))
    kept = [r for r in rows[:450]]
    x = np.floor(256 * np.array([r[1] for r in kept], np.float32).astype(float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    e, v = np.linalg.eigh(((fit - sums / n).T @ (fit - sums / n)) / n)
    e, v = e[::-1], v[:, ::-1]
    assert len(got) == 4 * 452 and {r.n for r in got} == {n} and max(r.identity_error for r in got) < 1e-9
    by = {(r.id, r.component): r for r in got if r.id is not None and r.id != 4}
    for c in range(4):
        want = ((x - sums / n) @ v[:, c]) / np.sqrt(e[c])
        mine = np.array([by[r[0], c + 1].whitened if r[0] != 4 else np.nan for r in kept])
        ok = ~np.isnan(mine)
        assert np.allclose(mine[ok] * np.sign(mine[ok] @ want[ok]), want[ok], atol=1e-9)
        assert by[0, c + 1].explained == pytest.approx(e[c] / e.sum(), rel=1e-9)
    assert all(by[r[0], 1].deviation == int(((n * y - sums) ** 2).sum()) for r, y in zip(kept, x, strict=True) if r[0] != 4)


def test_whitening_in_several_rounds_of_folding(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    monkeypatch.setattr(whitening, "BLOCK", 3)
    df = spark.createDataFrame(spoiled(200, 5, 1), VECTORS)
    one = {(r.id, r.component): abs(r.whitened) for r in whitened(df.repartition(9))}
    monkeypatch.undo()
    two = {(r.id, r.component): abs(r.whitened) for r in whitened(df.coalesce(1))}
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k], abs=1e-9) for k in one)


def test_whitening_without_variance(spark):
    assert whitened(spark.createDataFrame([], VECTORS)) == []
    assert whitened(spark.createDataFrame([(1, [], 1, "x"), (2, None, 1, "x")], VECTORS)) == []
    same = whitened(spark.createDataFrame([(1, [1.0, 2.0], 1, "x")] * 3, VECTORS))
    assert len(same) == 6 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, 0.0, None) for r in same)
    line = whitened(spark.createDataFrame([(1, [1.0, 2.0], 1, "x"), (2, [-1.0, 5.0], 1, "x"), (3, [-1.0], 1, "x")], VECTORS))
    assert len(line) == 6 and all(r.whitened is not None for r in line)
    flat = whitened(spark.createDataFrame([(1, [1.0, 2.0], 1, "x"), (2, [3.0, 2.0], 1, "x")], VECTORS))
    assert [abs(r.whitened) if r.whitened is not None else None for r in flat if r.id == 1] == [pytest.approx(1.0), None]


def test_jacobi_keeps_small_deviations():
    rng = np.random.Generator(np.random.PCG64(6))
    q, _ = np.linalg.qr(rng.normal(size=(6, 6)))
    want = 10.0 ** np.arange(0, -12, -2)
    lengths, turns = whitening.jacobi((rng.permutation(np.eye(6)) * want) @ q.T)
    assert np.allclose(lengths, want, rtol=1e-6) and np.allclose(turns.T @ turns, np.eye(6), atol=1e-12)


def test_deviations_beyond_doubles_and_longs():
    x = np.array([[1 << 20, 3], [1 << 40, 5]], np.int64)
    assert whitening.deviations(x, 3, [7, 1]) == [(3 * (1 << 20) - 7) ** 2 + 64, None]


# Extraction


def text_of(*parts, host="a.org", pages=3):
    from omenflow.llm import extraction

    return extraction.Page("<html><body>" + "".join(parts) + "</body></html>").extract([])


ARTICLE = "".join(f"<p>Paragraph {i} of the body of this article.</p>" for i in range(10))


@pytest.mark.parametrize("name", sorted(["script", "style", "noscript", "template", "textarea", "iframe", "svg", "select", "canvas"]))
def test_raw_elements_take_nothing_with_them(name):
    for raw in (f"<{name} class='i'/>", f"<{name} x='>'>inside</{name}>", f"<{name}/><{name}></{name}>", f"<{name}>in</{name.upper()} >"):
        assert text_of(f"<article><p>First</p>{raw}<p>Second</p></article>") == "First\n\nSecond", raw
    unclosed = text_of(f"<article><p>First</p><{name}><p>Second</p></article>")
    assert unclosed == "First\n\nSecond"


def test_nested_and_unbalanced_icons():
    assert text_of("<article><p>A</p><svg><svg><g/></svg><text>no</text></svg><p>B</p></article>") == "A\n\nB"
    assert text_of("<article><p>A</p><svg><p>B</p><svg><path/></svg><p>C</p></article>").endswith("C")


def test_paragraphs_beside_the_article_stay():
    got = text_of(f"<article><h1>Title</h1>{ARTICLE}</article><div class='more'><p>It goes on here.</p></div><div><a href='/x'>Other pages</a></div>")
    assert got.startswith("Title\n\nParagraph 0") and "It goes on here." in got


@pytest.mark.parametrize("name", "comment-thread user-comments commentlist wp-block-comments ad-placement advert-mpu adsbygoogle cookie-message siteFooter related-articles social-media commentList userComments".split())
def test_other_parts_inside_the_article_go(name):
    assert "Buy" not in text_of(f"<article>{ARTICLE}<div class='{name}'><p>Buy or say this.</p></div></article>")


def test_articles_that_are_comments_go_and_topics_stay():
    got = text_of(f"<article>{ARTICLE}<article class='comment'><p>I disagree.</p></article><div class='search'><p>Real text</p></div></article>")
    assert "disagree" not in got and got.endswith("Real text")


@pytest.mark.parametrize("piece", ["<a x=\"'", "<a x=\">\"", "<a \"'>", "<!", "<b", "<", "<b><p></p>", "<i></b>", "<svg>", "<iframe>", "<script>", "<svg></svg", "<!-- ", "<a x='", "<p><b>", "<li><i>"])
def test_hostile_pages_take_linear_time(piece):
    import time

    from omenflow.llm import extraction

    took = []
    for size in (125_000, 500_000):
        began = time.process_time()
        extraction.Page(piece * (size // len(piece)))
        took.append(time.process_time() - began)
    assert took[1] < max(8 * took[0], 0.5) and took[1] < 6


def test_re_extraction_equals_brute_force(spark):
    """A page is read from the first of its host's paths, most votes first, that has all of its content; else from its own."""
    from omenflow.llm import extraction

    shapes = [f"<main><div class='b{{}}'>{ARTICLE}</div></main>", f"<article><h1>T</h1><div class='b'>{ARTICLE}</div></article>", f"<div class='x'>{ARTICLE}<p>End</p></div>", "", "<p>short</p>"]
    rows = [(i, f"http://h{i % 3}.org/{i}", f"<html><body><nav><a href='/'>Home</a></nav>{shapes[(i * i) % 5].format(i)}<footer>F</footer></body></html>") for i in range(60)]
    got = {r.page_id: r.text for r in extraction.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    by_host = {}
    for i, _, source in rows:
        path, _ = extraction.Page(source).vote()
        if path:
            by_host.setdefault(i % 3, {}).setdefault(path, []).append(i)
    for i, _, source in rows:
        cast = by_host.get(i % 3, {})
        all_ = sum(map(len, cast.values()))
        paths = sorted((p for p in cast if len(cast[p]) * 10 >= all_), key=lambda p: (-len(cast[p]), p))
        page = extraction.Page(source)
        places = page.content()[0]
        fits = [p for p in paths if p in page.path and page.holds(p, places) and page.text(p)]
        own = page.vote()[0]
        assert got[i] == (page.text(fits[0]) if fits else page.text(own or None))


# Shards


@pytest.mark.parametrize("copy_id", [7, None])
def test_copies_with_one_id_or_none_are_cut(spark, copy_id):
    from omenflow.llm import sharding

    rows = [(copy_id, "the same text again and again") for _ in range(600)] + [(1000 + i, f"text number {i} of its own") for i in range(600)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), 5).collect()
    sizes = [sum(r["size"] for r in got if r.shard == k) for k in range(5)]
    assert len(got) == 1200 and max(sizes) - min(sizes) < 0.03 * sum(sizes) / 5
    for k in range(5):
        assert sorted(r.slot for r in got if r.shard == k) == list(range(sum(r.shard == k for r in got)))


def test_the_whole_job_of_sharding(spark):
    from omenflow.llm import sharding

    r = np.random.Generator(np.random.PCG64(3))
    rows = [(i, " ".join(["w"] * int(r.integers(0, 300)))) for i in range(700)] + [(i, None) for i in range(5)] + [(None, "")]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 7).collect()
    assert sorted(((x.id is None, x.id or 0, x["size"]) for x in got)) == sorted((i is None, i or 0, len((t or "").encode()) + 16) for i, t in rows)
    sizes = [sum(x["size"] for x in got if x.shard == k) for k in range(7)]
    assert max(sizes) - min(sizes) < 0.03 * sum(sizes) / 7
    assert all(sorted(x.slot for x in got if x.shard == k) == list(range(sum(x.shard == k for x in got))) for k in range(7))
