"""A tagger learned from tagged sequences: an averaged structured perceptron, mixed over partitions in rounds.

All sequences are learned from.  In a round each learner starts from the mixed weights, goes through its sequences once, as they come,
and gives back what it changed; a Spark aggregate mixes the changes by how many sequences each learner had.  Features are hashed to ``BUCKETS`` places, so that the
weights that tasks are sent have a fixed size whatever the vocabulary.  Sequences are sentences, each of which fits a row.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import forgotten, written

BUCKETS = 1 << 18
#: Words that are tagged at once, about.
TOGETHER = 1 << 14
EPOCHS = 5


def word_shape(word: str) -> str:
    """Letters as x and X, digits as d; runs of the same are cut after two."""
    out = ""
    for c in word:
        k = "X" if c.isupper() else "x" if c.isalpha() else "d" if c.isdigit() else c
        if out[-2:] != k * 2:
            out += k
    return out


@lru_cache(1 << 16)
def _own(word: str, buckets: int) -> np.ndarray:
    low = word.lower()
    names = ["bias", f"w={low}", f"s={word_shape(word)}", *(f"p{i}={low[:i]}" for i in (1, 2, 3)), *(f"e{i}={low[-i:]}" for i in (1, 2, 3))]
    return np.array([crc32(x.encode("utf-8", "surrogatepass")) % buckets for x in names], np.int64)


@lru_cache(1 << 16)
def _near(word: str, side: str, buckets: int) -> np.ndarray:
    low = word.lower()
    return np.array([crc32(f"{side}{x}".encode("utf-8", "surrogatepass")) % buckets for x in (low, low[-3:])], np.int64)


def features(words: list[str], buckets: int = BUCKETS) -> np.ndarray:
    """The places of each word's features: itself, its ends and shape, and its neighbours'."""
    padded = ["\x02", *words, "\x03"]
    return np.stack([np.concatenate([_own(w, buckets), _near(padded[i], "-", buckets), _near(padded[i + 2], "+", buckets)]) for i, w in enumerate(words)])


def viterbi(scores: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best path through ``scores`` (positions x tags) with ``moves`` (from x to); of equals the first tag."""
    n = len(scores)
    back = np.zeros((n, scores.shape[1]), np.int64)
    best = scores[0] + start
    for i in range(1, n):
        ways = best[:, None] + moves
        back[i] = ways.argmax(axis=0)
        best = ways.max(axis=0) + scores[i]
    path = np.zeros(n, np.int64)
    path[-1] = best.argmax()
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def features_of_many(words: list[str], first: np.ndarray, last: np.ndarray, buckets: int) -> np.ndarray:
    """``features`` of many sequences one after the other; ``first`` and ``last``: which words begin and end one.

    What a word gives is looked up once for all its places.
    """
    known = {w: i for i, w in enumerate(dict.fromkeys(words))}
    return _features(np.fromiter((known[w] for w in words), np.int64, len(words)), list(known), first, last, buckets)


def _features(at: np.ndarray, known: list[str], first: np.ndarray, last: np.ndarray, buckets: int) -> np.ndarray:
    """The same of words by their numbers in ``known``."""
    before = np.where(first, len(known), np.roll(at, 1))
    after = np.where(last, len(known), np.roll(at, -1))
    own = np.stack([_own(w, buckets) for w in known])
    left = np.stack([_near(w, "-", buckets) for w in [*known, "\x02"]])
    right = np.stack([_near(w, "+", buckets) for w in [*known, "\x03"]])
    return np.concatenate([own[at], left[before], right[after]], axis=1)


def viterbi_of_many(scores: np.ndarray, sizes: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """``viterbi`` of many sequences, whose ``scores`` follow each other, place by place for all of them."""
    order = np.argsort(-sizes, kind="stable")
    begin, size = (np.cumsum(sizes) - sizes)[order], sizes[order]
    # How many sequences have a place; the longest come first.
    alive = [int(np.searchsorted(-size, -i, side="left")) for i in range(int(size[0]))]
    best, back = scores[begin] + start, np.zeros(scores.shape, np.int64)
    for i in range(1, len(alive)):
        n = alive[i]
        ways = best[:n, :, None] + moves
        back[begin[:n] + i] = ways.argmax(axis=1)
        best[:n] = ways.max(axis=1) + scores[begin[:n] + i]
    path = np.zeros(len(scores), np.int64)
    path[begin + size - 1] = best.argmax(axis=1)
    for i in range(len(alive) - 1, 0, -1):
        here = begin[: alive[i]] + i
        path[here - 1] = back[here, path[here]]
    return path


class Weights:
    """``emit`` (buckets x tags), ``move`` (from x to; the last row is the start)."""

    def __init__(self, buckets: int, n_tags: int):
        self.emit, self.move = np.zeros((buckets, n_tags)), np.zeros((n_tags + 1, n_tags))

    def path(self, at: np.ndarray) -> np.ndarray:
        return viterbi(self.emit[at].sum(axis=1), self.move[:-1], self.move[-1])


class Learner:
    """A learner's way through its sequences: ``w`` changes by each mistake.

    ``step`` is the sum of the changes, ``late`` the same with each change times the sequences before it: ``n`` times the first less
    the second is the sum of the changes over all moments after each sequence, so that dividing by ``n`` averages.
    """

    def __init__(self, emit: np.ndarray, move: np.ndarray):
        self.w, self.step, self.late = (Weights(*emit.shape) for _ in range(3))
        self.w.emit[:], self.w.move[:] = emit, move
        self.n, self.reach = 0, 1

    def learn(self, at: np.ndarray, gold: np.ndarray, sizes: np.ndarray) -> None:
        """Go through sequences that follow each other (``at``, ``gold``: features and tags of their words).

        Some are decoded together, as many as are likely without a mistake; those behind the first mistake are decoded again, so
        that each is told by the weights that all before it left.
        """
        ends = np.cumsum(sizes)
        begins, k = ends - sizes, 0
        while k < len(sizes):
            upto = min(k + self.reach, len(sizes))
            a, b = begins[k], ends[upto - 1]
            got = viterbi_of_many(self.w.emit[at[a:b]].sum(axis=1), sizes[k:upto], self.w.move[:-1], self.w.move[-1])
            wrong = np.flatnonzero(got != gold[a:b])
            if not len(wrong):
                k, self.reach = upto, self.reach * 2 if upto - k == self.reach else self.reach
                continue
            m = int(np.searchsorted(ends, a + wrong[0], side="right"))
            here = slice(begins[m], ends[m])
            self._change(at[here], gold[here], got[begins[m] - a : ends[m] - a], self.n + m)
            self.reach, k = m - k + 1, m + 1
        self.n += len(sizes)

    def _change(self, at: np.ndarray, gold: np.ndarray, got: np.ndarray, before: int) -> None:
        wrong = np.flatnonzero(got != gold)
        n_tags = self.w.move.shape[1]
        emitted = [(at[wrong] * n_tags + tags[wrong, None]).ravel() for tags in (gold, got)]
        moved = [np.concatenate([[n_tags], tags[:-1]]) * n_tags + tags for tags in (gold, got)]
        for x, by in ((self.w, 1.0), (self.step, 1.0), (self.late, float(before))):
            for weights, places in ((x.emit, emitted), (x.move, moved)):
                np.add.at(weights.reshape(-1), np.concatenate(places), np.repeat([by, -by], len(places[0])))

    def told(self) -> pa.RecordBatch:
        """Rows of ``n, kind, place, tag, change, total``; the first has the number of sequences."""
        n = self.n
        cols = [np.array([n]), np.array([-1]), np.array([0]), np.array([0]), np.array([0.0]), np.array([0.0])]
        for kind, step, late in ((0, self.step.emit, self.late.emit), (1, self.step.move, self.late.move)):
            at, tag = np.nonzero((step != 0) | (late != 0))
            cols = [np.concatenate([c, x]) for c, x in zip(cols, [np.full(len(at), n), np.full(len(at), kind), at, tag, step[at, tag], n * step[at, tag] - late[at, tag]], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["n", "kind", "place", "tag", "change", "total"])


def _learned(learner: Learner, b: pa.RecordBatch, number: dict[str, int]) -> None:
    """Go through a batch's rows, some words at a time."""
    sizes = b.column("words").value_lengths().to_numpy().astype(np.int64)
    ends, k = np.cumsum(sizes), 0
    while k < len(sizes):
        upto = max(k + 1, int(np.searchsorted(ends, ends[k] - sizes[k] + TOGETHER, side="right")))
        words, tags = (b.column(c).slice(k, upto - k).flatten().dictionary_encode() for c in ("words", "tags"))
        size = sizes[k:upto]
        last = np.zeros(len(words), bool)
        last[np.cumsum(size) - 1] = True
        at = _features(words.indices.to_numpy().astype(np.int64), words.dictionary.to_pylist(), np.roll(last, 1), last, len(learner.w.emit))
        learner.learn(at, np.array([number[t] for t in tags.dictionary.to_pylist()])[tags.indices.to_numpy()], size)
        k = upto


class Tagger:
    def __init__(self, tags: list[str], weights: Weights):
        self.tags, self.weights = tags, weights

    @classmethod
    def fit(cls, tagged: DataFrame, epochs: int = EPOCHS, buckets: int = BUCKETS, parts: int | None = None) -> Tagger:
        """Learn from all of ``words, tags`` (arrays of equal lengths, a row a sequence; null and empty ones are left out).

        ``parts``: how many learners are mixed, as many as the session has for shuffles if not given; where a learner's file is
        read in several splits, each of them is a learner.
        """
        spark = tagged.sparkSession
        parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = tagged.select("words", "tags").where((F.size("words") > 0) & (F.size("words") == F.size("tags")))
        dealt = rows.withColumn("_part", F.pmod(F.xxhash64("words"), F.lit(parts)).cast("int")).repartition(parts, "_part")
        # In order once, so that rounds only read; tags too, as sequences of the same words may differ in them.
        rows = written(dealt.sortWithinPartitions("_part", F.xxhash64("words"), F.xxhash64("tags")))
        tags = sorted(r.t for r in rows.select(F.explode(F.array_distinct("tags")).alias("t")).distinct().where("t is not null").collect())  # a tag set is small
        number = {t: i for i, t in enumerate(tags)}
        mixed, average, seen = Weights(buckets, len(tags)), Weights(buckets, len(tags)), 0
        full = lambda c: F.forall(c, lambda x: x.isNotNull())
        dealt = rows.where(full("words") & full("tags")).select("_part", "words", "tags")
        for _ in range(epochs):
            changes = cls._round(dealt, spark.sparkContext.broadcast((mixed.emit, mixed.move)), number)
            n, step, sums = cls._mixed(changes, buckets, len(tags))
            if not n:
                break
            # Averages within the round count from the weights it began with.
            average.emit += n * mixed.emit + sums.emit
            average.move += n * mixed.move + sums.move
            mixed.emit += step.emit
            mixed.move += step.move
            seen += n
        forgotten(rows)
        if seen:
            average.emit /= seen
            average.move /= seen
        return cls(tags, average)

    @staticmethod
    def _round(dealt: DataFrame, sent, number: dict[str, int]) -> DataFrame:
        """What each learner told."""

        def run(batches):
            learner, now = None, None
            for b in batches:
                part = b.column("_part").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
                for i, j in pairwise(cuts):
                    if i == j:
                        continue
                    if learner and part[i] != now:
                        yield learner.told()
                        learner = None
                    learner, now = learner or Learner(*sent.value), part[i]
                    _learned(learner, b.slice(i, j - i), number)
            if learner:
                yield learner.told()

        return dealt.mapInArrow(run, "n long, kind long, place long, tag long, change double, total double")

    @staticmethod
    def _mixed(changes: DataFrame, buckets: int, n_tags: int) -> tuple[int, Weights, Weights]:
        """Sequences in all, the learners' changes weighed by their sequences, and the sums of all moments."""
        weighed = changes.groupBy("kind", "place", "tag").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("change")).alias("c"), F.sum("total").alias("s")).toArrow()  # buckets x tags rows at most
        kind, place, tag, n, c, s = (weighed[x].to_numpy() for x in ("kind", "place", "tag", "n", "c", "s"))
        all_ = int(n[kind == -1].sum())
        step, sums = Weights(buckets, n_tags), Weights(buckets, n_tags)
        for k, name in ((0, "emit"), (1, "move")):
            at = kind == k
            getattr(step, name)[place[at], tag[at]] = c[at] / max(all_, 1)
            getattr(sums, name)[place[at], tag[at]] = s[at]
        return all_, step, sums

    def of(self, words: list[str]) -> list[str]:
        if not words or not self.tags:
            return []
        return [self.tags[i] for i in self.weights.path(features(words, len(self.weights.emit)))]

    def of_many(self, sequences: list[list[str]]) -> list[list[str]]:
        """``of`` each sequence; about ``TOGETHER`` words at once."""
        out: list[list[str]] = [[] for _ in sequences]
        held: list[int] = []
        words = 0
        for i, ws in enumerate(sequences):
            if ws and self.tags:
                held.append(i)
                words += len(ws)
            if held and (words >= TOGETHER or i + 1 == len(sequences)):
                sizes = np.array([len(sequences[k]) for k in held])
                ends = np.cumsum(sizes)
                first, last = np.zeros(ends[-1], bool), np.zeros(ends[-1], bool)
                first[ends - sizes], last[ends - 1] = True, True
                at = features_of_many([w for k in held for w in sequences[k]], first, last, len(self.weights.emit))
                path = viterbi_of_many(self.weights.emit[at].sum(axis=1), sizes, self.weights.move[:-1], self.weights.move[-1]).tolist()
                for k, a, b in zip(held, (ends - sizes).tolist(), ends.tolist(), strict=True):
                    out[k] = [self.tags[t] for t in path[a:b]]
                held, words = [], 0
        return out

    def tag(self, sequences: DataFrame, words: str = "words") -> DataFrame:
        """Adds ``tags`` to rows with an array of words; null words count as empty ones, null arrays stay null."""
        spark = sequences.sparkSession
        sent = spark.sparkContext.broadcast(self)

        def run(batches):
            tagger = sent.value
            for b in batches:
                given = b.column(b.schema.get_field_index(words)).to_pylist()
                found = tagger.of_many([[w or "" for w in ws or []] for ws in given])
                told = [None if ws is None else t for ws, t in zip(given, found, strict=True)]
                yield b.append_column("tags", pa.array(told, pa.list_(pa.string())))

        from pyspark.sql.types import ArrayType, StringType, StructType

        return sequences.mapInArrow(run, StructType([*sequences.schema.fields]).add("tags", ArrayType(StringType())))

    def analyser(self, split: Callable[[str], list[str]], lemma: Callable[[str], str] = str.lower, wide: dict[str, str] | None = None) -> Callable:
        """An analyser of texts for ``linguistic.tokens``: ``wide`` gives a tag's coarse part of speech."""

        def analyse(texts: list[str]) -> list[list[tuple]]:
            out = []
            for text in texts:
                words = split(text)
                out.append([(w, lemma(w), (wide or {}).get(t, t), t) for w, t in zip(words, self.of(words), strict=True)])
            return out

        return analyse

    def save(self, spark: SparkSession, folder: str) -> None:
        """Weights that aren't 0, and the tag set."""
        rows = []
        for kind, w in ((0, self.weights.emit), (1, self.weights.move)):
            at, tag = np.nonzero(w)
            rows.append(pa.table({"kind": np.full(len(at), kind), "place": at, "tag": tag, "w": w[at, tag]}))
        spark.createDataFrame(pa.concat_tables(rows)).write.mode("overwrite").parquet(f"{folder}/weights")
        spark.createDataFrame([(json.dumps({"tags": self.tags, "buckets": len(self.weights.emit)}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/tags")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> Tagger:
        told = json.loads(spark.read.text(f"{folder}/tags").first()[0])
        w = Weights(told["buckets"], len(told["tags"]))
        t = spark.read.parquet(f"{folder}/weights").toArrow()
        kind, place, tag, x = (t[c].to_numpy() for c in ("kind", "place", "tag", "w"))
        for k, name in ((0, w.emit), (1, w.move)):
            name[place[kind == k], tag[kind == k]] = x[kind == k]
        return cls(told["tags"], w)


def spans(tagged: DataFrame, key: str, words: str = "words", tags: str = "tags") -> DataFrame:
    """``key, label, begin, end, term``: entities of ``B-x, I-x, O`` tags, by places of their words; ``end`` is exclusive.

    An I- that doesn't go on with its label begins an entity; rows whose tags are null have none.  The work is linear in
    a row's words, and words aren't repeated by entity.
    """
    label = lambda t: F.regexp_extract(t, r"^[BI]-(.*)$", 1)
    before = lambda i: F.get("_t", i - 1)
    opens = lambda i: F.coalesce(F.get("_t", i).startswith("B-") | (F.get("_t", i).startswith("I-") & ((i == 0) | (label(F.get("_t", i)) != label(F.coalesce(before(i), F.lit("")))))), F.lit(False))
    # Where a token doesn't go on with the label before it, and at both ends; an entity reaches from its begin to the next of these.
    ends = lambda i: (i == 0) | ~F.coalesce(F.get("_t", i).startswith("I-"), F.lit(False)) | F.coalesce(F.get("_t", i) != F.concat(F.lit("I-"), label(before(i))), F.lit(True))
    rows = tagged.select(key, F.col(words).alias("_w"), F.col(tags).alias("_t"))
    marked = rows.select("*", F.filter(F.sequence(F.lit(0), F.size("_t")), ends).alias("_m"))
    pairs = F.zip_with("_m", F.slice("_m", 2, F.greatest(F.size("_m") - 1, F.lit(1))), lambda a, b: F.struct(a.alias("begin"), b.alias("end")))
    held = marked.select(key, "_w", "_t", F.filter(pairs, lambda p: opens(p["begin"])).alias("_p"))
    term = lambda p: F.array_join(F.slice("_w", p["begin"] + 1, p["end"] - p["begin"]), " ")
    entity = lambda p: F.struct(label(F.get("_t", p["begin"])).alias("label"), p["begin"].alias("begin"), p["end"].alias("end"), term(p).alias("term"))
    return held.select(key, F.inline(F.transform("_p", entity)))
