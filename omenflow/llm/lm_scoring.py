"""LM scoring by deleted interpolation.

The probability of a token after the ``order - 1`` tokens before it is a mixture of maximum-likelihood estimates of
every order down to the uniform distribution over the training vocabulary and one unknown token.  The mixture's
weights depend on how often the longest context that was met occurs (buckets by powers of two).  They are learned by
expectation-maximisation on held-out counts: those of the training documents whose fold is ``HELD``, against estimates
from which these documents' own counts are deleted.

Counts stay in Spark.  Documents of one fold are put together in blocks of at most about ``BLOCK_TOKENS`` tokens; a
block asks for each distinct n-gram once, however often it occurs there, so that the most frequent n-gram of a corpus
has as many rows as there are blocks.  Requests are dealt over buckets by the n-gram's hash, summed, and answered
in the order they came in; the answers meet the block again by its key.  Only a histogram of fixed size reaches the
driver, where expectation-maximisation runs on it.

Cases: null and empty texts have the end as their only token; rows that repeat a ``doc_id`` are each counted and scored;
very long texts are read whole, in a block of their own; without training documents every token is unknown, and the
model is the uniform distribution over it; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import STEP, mix, pack, planes, unpack, unplanes, utf8, words
from .common import fold, groups, per_group, spread, stored, table, text_chunks

ORDER = 2
#: The fold that is scored without being learned from, and the training fold whose counts are held out for the weights.
UNSEEN, HELD = 1, 2
BLOCK_TOKENS = 700_000
#: Requests that one bucket has on average, and the least number of buckets.
BUCKET_KEYS, LEAST_BUCKETS = 1_000_000, 256
#: Buckets or blocks that a task has at most, on average.
GROUPS_A_TASK = 4
END, START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: Histogram of the logarithms of estimates over the uniform one: steps for a factor of two, and the largest logarithm.
FINE, TOP = 4, 40
LEVELS = 24


BLOCK_SCHEMA = "block string, fold int, doc_ids array<{kind}>, lengths binary, vocab binary, tokens binary, n_tokens long"


def blocks(docs: DataFrame, limit: int = BLOCK_TOKENS) -> DataFrame:
    """Documents (``doc_id, fold, text``) of one fold put together: their words as numbers in the block's own vocabulary."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        count = 0

        def block(f: int) -> pa.RecordBatch:
            nonlocal count
            rows = held.pop(f)
            count += 1
            ids = [i for r in rows for i in r[0]]
            vocab, tokens = np.unique(np.concatenate([r[2] for r in rows]), return_inverse=True)
            lengths = np.concatenate([r[1] for r in rows]).astype(np.uint32)
            name = f"{TaskContext.get().partitionId()}-{f}-{count}"
            row = [[name], [f], [ids], [planes(lengths)], [pack(vocab)], [planes(tokens.astype(np.uint32))], [len(tokens)]]
            kinds = [pa.string(), pa.int32(), pa.list_(id_type), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(row, kinds, strict=True)], names=["block", "fold", "doc_ids", "lengths", "vocab", "tokens", "n_tokens"])

        id_type = pa.int64()
        for whole in batches:
            id_type = whole.column(0).type
            for b in text_chunks(whole, "text", 1 << 20):
                hashes, counts = words(*utf8(b.column(2)))
                ends = np.cumsum(counts)
                # One end after each row's words.
                tokens = np.insert(hashes, ends, END)
                ends = ends + np.arange(1, len(ends) + 1)
                begins = ends - counts - 1
                of = b.column(1).to_numpy(zero_copy_only=False)
                ids = b.column(0).to_pylist()
                for f in np.unique(of).tolist():
                    mine = np.flatnonzero(of == f)
                    own = held.setdefault(f, [])
                    own.append(([ids[i] for i in mine], counts[mine] + 1, np.concatenate([tokens[begins[i] : ends[i]] for i in mine])))
                    if sum(len(r[2]) for r in own) >= limit:
                        yield block(f)
        for f in list(held):
            yield block(f)

    return docs.mapInArrow(run, BLOCK_SCHEMA.format(kind=kind))


def ngram_keys(vocab: np.ndarray, tokens: np.ndarray, lengths: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """For each order from 1: the key of the n-gram that ends at each position (56 bits; whole words' hashes below it)."""
    ends = np.cumsum(lengths)
    first = ends - lengths
    key = vocab[tokens]
    yield key
    place = np.arange(len(tokens)) - np.repeat(first, lengths)
    word = key
    for n in range(2, order + 1):
        before = np.full(len(word), START, np.uint64)
        if len(word) > n - 1:
            before[n - 1 :] = word[: -(n - 1)]
        before[place < n - 1] = START
        key = mix(key * STEP + before + np.uint64(n))
        yield key >> np.uint64(8)


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys ^ STEP) % np.uint64(buckets)).astype(np.int64)


def requests_of(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys by bucket, then key: keys, how often each occurs, where buckets begin, their numbers, and each position's key."""
    distinct, place, count = np.unique(keys, return_inverse=True, return_counts=True)
    bucket = bucket_of(distinct, buckets)
    order = np.argsort(bucket, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    bucket = bucket[order]
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    return distinct[order], count[order], np.append(starts, len(bucket)), bucket[starts] if len(bucket) else bucket, rank[place]


def _read_block(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return unpack(r["vocab"]), unplanes(r["tokens"], np.uint32), unplanes(r["lengths"], np.uint32).astype(np.int64)


def answers(stored_blocks: DataFrame, order: int, buckets: int) -> DataFrame:
    """``block, n, bucket, total, own``: for each request the training count of its n-grams, and what its own fold has of that."""
    asked = "n int, bucket int, block string, fold int, keys binary, counts binary"

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                for n, keys in enumerate(ngram_keys(*_read_block(r), order), 1):
                    distinct, count, starts, numbers, _ = requests_of(keys, buckets)
                    cuts = list(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True))
                    rows = [pa.array([n] * len(cuts), pa.int32()), pa.array(numbers.astype(np.int32)), pa.array([r["block"]] * len(cuts)), pa.array([r["fold"]] * len(cuts), pa.int32())]
                    rows += [pa.array([pack(distinct[a:z]) for a, z in cuts], pa.binary()), pa.array([planes(count[a:z].astype(np.uint32)) for a, z in cuts], pa.binary())]
                    yield pa.RecordBatch.from_arrays(rows, names=["n", "bucket", "block", "fold", "keys", "counts"])

    def answer(t: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = t.to_pylist()
        keys = [unpack(r["keys"]) for r in rows]
        counts = [unplanes(r["counts"], np.uint32).astype(np.int64) for r in rows]
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        folds = np.repeat([r["fold"] for r in rows], [len(k) for k in keys])
        flat = np.concatenate(counts)
        total = np.bincount(place, np.where(folds == UNSEEN, 0, flat), len(distinct)).astype(np.uint32)
        held = np.bincount(place, np.where(folds == HELD, flat, 0), len(distinct)).astype(np.uint32)
        ends = np.cumsum([len(k) for k in keys])
        out = []
        for r, k, end in zip(rows, keys, ends.tolist(), strict=True):
            mine = place[end - len(k) : end]
            out.append((planes(total[mine]), planes(held[mine]) if r["fold"] == HELD else b""))
        # The bucket's own sums: training tokens, and distinct ones of them.
        known = int((total > 0).sum())
        n = [r["n"] for r in rows]
        cols = [pa.array([r["block"] for r in rows]), pa.array([r["fold"] for r in rows], pa.int32()), pa.array(n, pa.int32()), t["bucket"].combine_chunks(), pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary())]
        cols += [pa.array([known] + [0] * (len(rows) - 1), pa.int64())]
        yield pa.RecordBatch.from_arrays(cols, names=["block", "fold", "n", "bucket", "total", "own", "known"])

    wanted = stored_blocks.select("block", "fold", "lengths", "vocab", "tokens").mapInArrow(ask, asked)
    return per_group(wanted, ["n", "bucket"], answer, "block string, fold int, n int, bucket int, total binary, own binary, known long", order * buckets // GROUPS_A_TASK)


def met(stored_blocks: DataFrame, answered: DataFrame) -> DataFrame:
    """Blocks and their answers, as rows of one table; a block's own row comes first."""
    left = stored_blocks.select("block", "fold", F.lit(0).alias("n"), F.lit(0).alias("bucket"), "doc_ids", "lengths", "vocab", "tokens", F.lit(None).cast("binary").alias("total"), F.lit(None).cast("binary").alias("own"))
    return left.unionByName(answered.select("block", "fold", "n", "bucket", "total", "own"), allowMissingColumns=True)


def block_counts(rows: list[dict], order: int, buckets: int) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """At each position, for every order: training count and own count; and the lengths of the documents."""
    first, rest = rows[0], rows[1:]
    vocab, tokens, lengths = _read_block(first)
    total, own = [], []
    for n, keys in enumerate(ngram_keys(vocab, tokens, lengths, order), 1):
        place = requests_of(keys, buckets)[-1]
        mine = [r for r in rest if r["n"] == n]  # sorted by bucket, as the requests were
        t = np.concatenate([unplanes(r["total"], np.uint32) for r in mine]).astype(np.int64)
        total.append(t[place])
        if first["fold"] == HELD:
            own.append(np.concatenate([unplanes(r["own"], np.uint32) for r in mine]).astype(np.int64)[place])
    return total, own, lengths


def estimates(counts: list[np.ndarray], lengths: np.ndarray, all_tokens: int, starts: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Maximum-likelihood estimates of every order, and the bucket of the longest context that was met."""
    size = len(counts[0])
    begin = np.cumsum(lengths) - lengths
    place = np.arange(size) - np.repeat(begin, lengths)
    out = [counts[0] / max(1, all_tokens)]
    level = np.zeros(size, np.int64)
    for n in range(2, len(counts) + 1):
        # The context of an n-gram is the (n-1)-gram that ends one position before; at the start of a text, all starts.
        context = np.empty(size, np.int64)
        context[1:] = counts[n - 2][:-1]
        context[:1] = 0
        context[place == 0] = starts
        out.append(np.where(context > 0, counts[n - 1] / np.maximum(context, 1), 0.0))
        seen = context > 0
        level[seen] = (n - 2) * LEVELS + 1 + np.minimum(LEVELS - 1, np.log2(context[seen]).astype(np.int64))
    return out, level


def quantised(x: np.ndarray, uniform: float) -> np.ndarray:
    """0: none; else 1 and up, by the logarithm of the ratio to the uniform distribution."""
    with np.errstate(divide="ignore"):
        r = np.log2(x / uniform)
    return np.where(x > 0, 1 + np.clip(np.rint((r + 8) * FINE), 0, (TOP + 8) * FINE).astype(np.int64), 0)


def learn_weights(hist: dict[tuple, int], order: int, rounds: int = 60) -> np.ndarray:
    """Weights by bucket (order + 1 of each: uniform first) by expectation-maximisation.

    ``hist``: how often each bucket and quantised estimates were met.  A bucket's weights are 0 for the orders whose
    context wasn't met, as their estimates are 0 there, so that the mixture is a distribution.  A bucket with few counts
    has the weights of the one below it, the first of an order those of all its counts together, and an order without
    any those of the order below.  Half a count for each weight keeps all of them, the uniform one too, above 0.
    """
    size = (order - 1) * LEVELS + 1
    keys = np.array([*hist], np.int64).reshape(-1, order + 1)
    n = np.array([*hist.values()], np.float64)
    ratio = np.where(keys[:, 1:] > 0, 2.0 ** ((keys[:, 1:] - 1) / FINE - 8), 0.0)
    ratio = np.concatenate([np.ones((len(n), 1)), ratio], axis=1)
    longest = np.where(keys[:, 0] > 0, (keys[:, 0] - 1) // LEVELS + 2, 1)  # the highest order whose context was met

    def em(rows: np.ndarray, top: int) -> np.ndarray:
        may = np.arange(order + 1) <= top
        w = may / may.sum()
        r, c = ratio[rows], n[rows]
        for _ in range(rounds):
            share = r * w
            share /= share.sum(axis=1, keepdims=True)
            w = (c @ share + 0.5 * may) / (c.sum() + 0.5 * may.sum())
        return w

    out = np.empty((size, order + 1))
    last = np.arange(order + 1) <= 1
    last = last / last.sum()
    for top in range(1, order + 1):
        mine = longest == top
        if len(n) and mine.any():
            last = em(mine, top)
        for level in range(0 if top == 1 else (top - 2) * LEVELS + 1, 1 if top == 1 else (top - 1) * LEVELS + 1):
            rows = keys[:, 0] == level if len(n) else np.zeros(0, bool)
            if len(n) and n[rows].sum() >= 20:
                last = em(rows, top)
            out[level] = last
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(fold(F.col(id_col)), F.lit(0)).cast("int").alias("fold"), F.col(text_col).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    made = stored(blocks(rows))
    sums = {r.fold: (int(r.n), int(r.d)) for r in made.groupBy("fold").agg(F.sum("n_tokens").alias("n"), F.sum(F.size("doc_ids")).alias("d")).collect()}  # five folds
    buckets = max(LEAST_BUCKETS, -(-sum(n for n, _ in sums.values()) // BUCKET_KEYS))
    answered = stored(answers(made, order, buckets))
    train = sum(n for f, (n, _) in sums.items() if f != UNSEEN)
    starts = sum(d for f, (_, d) in sums.items() if f != UNSEEN)
    held_tokens, held_docs = sums.get(HELD, (0, 0))
    distinct = int(answered.where("n = 1").agg(F.coalesce(F.sum("known"), F.lit(0))).first()[0])
    uniform = 1.0 / (distinct + 1)

    def histogram(t: pa.Table) -> Iterator[pa.RecordBatch]:
        total, own, lengths = block_counts(t.to_pylist(), order, buckets)
        deleted = [a - b for a, b in zip(total, own, strict=True)]
        f, level = estimates(deleted, lengths, train - held_tokens, starts - held_docs)
        seen, count = np.unique(np.stack([level, *(quantised(x, uniform) for x in f)]), axis=1, return_counts=True)
        yield pa.RecordBatch.from_arrays([*(pa.array(x.astype(np.int32)) for x in seen), pa.array(count.astype(np.int64))], names=names)

    names = ["level", *(f"q{n}" for n in range(1, order + 1)), "count"]
    schema = ", ".join(f"{x} int" for x in names[:-1]) + ", count long"
    n_blocks = made.count()
    found = by_block(met(made.where(F.col("fold") == HELD), answered.where(F.col("fold") == HELD)), histogram, schema, n_blocks // (5 * GROUPS_A_TASK))
    hist = {tuple(r[:-1]): r[-1] for r in found.groupBy(*names[:-1]).agg(F.sum("count").alias("count")).collect()}  # bounded by levels and steps
    weights = learn_weights(hist, order)

    def results(t: pa.Table) -> Iterator[pa.RecordBatch]:
        rows = t.to_pylist()
        total, _, lengths = block_counts(rows, order, buckets)
        f, level = estimates(total, lengths, train, starts)
        w = weights[level]
        p = w[:, 0] * uniform
        for k, x in enumerate(f, 1):
            p += w[:, k] * x
        begin = np.cumsum(lengths) - lengths
        sums_of = lambda x: np.add.reduceat(x, begin)  # noqa: E731  no text is without a token
        base = np.log10((total[0] + 0.5) / (train + 0.5 * (distinct + 1)))
        fold_of = rows[0]["fold"]
        ids = t["doc_ids"][0].values
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(np.full(len(lengths), fold_of == UNSEEN)), pa.array(lengths), pa.array(sums_of((total[0] > 0).astype(np.int64))), pa.array(np.full(len(lengths), train, np.int64)), pa.array(sums_of(base)), pa.array(sums_of(np.log10(p)))],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
        )

    return by_block(met(made, answered), results, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double", n_blocks // GROUPS_A_TASK)


def by_block(rows: DataFrame, fn, schema: str, parts: int = 0) -> DataFrame:
    """``fn`` on all rows of each block, its own row first and the answers by bucket; one Arrow stream a partition."""

    def run(batches):
        for t in groups(batches, ["block"]):
            yield from fn(t)

    return spread(rows, parts, "block").sortWithinPartitions("block", "n", "bucket").mapInArrow(run, schema)


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))
