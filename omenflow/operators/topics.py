"""Topics over documents, with counts sharded by term and by blocks of documents.

Nothing of the model but its ``k`` topic totals is ever in one place.  Documents are dealt to blocks once and stay there, as
numbers of the block's terms; a round shares each occurrence out inside the block.  Terms that one block alone has stay there
too; the sums of others go to their bucket, a hash of the term, as packed numbers without the terms, and what all blocks of the
bucket have in sum comes back the same way.  Every term is kept.  (The rounds are those of expectation-maximisation for latent Dirichlet
allocation with priors ``alpha`` and ``beta``.)
"""

from __future__ import annotations

import uuid
from functools import reduce
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import tokens
from ..sources.writers import forgotten, scratch, written
from .skew import over_cores

#: Occurrences of terms in a block, about.
BLOCK = 1 << 21


def bags(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``doc_id, term, tf`` of lower-cased white-space tokens."""
    t = over_cores(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("t")), "doc_id").select("doc_id", F.explode(tokens(F.lower("t"))).alias("term"))
    return t.groupBy("doc_id", "term").agg(F.count("*").alias("tf"))


def _sum(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def _column(t: pa.Table, name: str) -> np.ndarray:
    return t[name].to_numpy()


class Blocks:
    """Documents dealt to blocks: ``held`` has ``block, place, doc_id, places, tf``, a row a document, numbered inside its block.

    A block's row with ``place`` -1 has its ``terms``; ``places`` are numbers of them.  ``links`` has ``bucket, block, places, slots,
    n``: where a block's terms that others have too are in the block and in their bucket, and once a bucket (block -1) how many
    terms it has.  ``first`` has the first sums (``state_schema``) of ``k`` topics, of shares drawn by hashes of document and term.
    """

    def __init__(self, held: DataFrame, first: DataFrame | None, links: DataFrame | None, k: int, seed: int):
        self.held, self.first, self.links, self.k, self.seed = held, first, links, k, seed

    @classmethod
    def of(cls, counts: DataFrame, k: int = 0, seed: int = 42) -> Blocks:
        """From ``doc_id, term, tf``; a null term is none."""
        rows = counts.where("term is not null").select("doc_id", F.array("term").alias("term"), F.array(F.col("tf").cast("double")).alias("tf"))
        return cls._dealt(rows, lambda dealt: dealt, counts.count(), k, seed)

    @classmethod
    def of_texts(cls, docs: DataFrame, k: int = 0, seed: int = 42, text: str = "text", id_col: str = "doc_id") -> Blocks:
        """The same as from ``bags``, but that texts are moved instead of counts."""
        rows = docs.select(F.col(id_col).alias("doc_id"), F.lower(text).alias("t"))
        each = lambda dealt: dealt.select("block", "doc_id", tokens(F.col("t")).alias("term"))
        return cls._dealt(rows, each, over_cores(rows, "doc_id").agg(F.sum(F.size(tokens(F.col("t"))))).first()[0] or 0, k, seed)

    @classmethod
    def _dealt(cls, rows: DataFrame, entries, n: int, k: int, seed: int) -> Blocks:
        spark = rows.sparkSession
        blocks = max(1, -(-n // BLOCK), min(spark.sparkContext.defaultParallelism, n // (BLOCK // 32)))
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")).repartition(blocks, "block")
        each = entries(dealt)
        # Rows keep their terms together, so that they are sorted by block as rows and not term by term.
        draw = lambda i: F.transform("term", lambda t: (F.pmod(F.xxhash64("doc_id", t, F.lit(seed * 1000 + i)), F.lit(1 << 20)) + 1).cast("int"))
        drawn = each.select("*", *(draw(i).alias(f"d{i}") for i in range(k)))

        def pack(t: pa.Table) -> pa.Table:
            flat = lambda c: t[c].combine_chunks().flatten()
            row = np.repeat(np.arange(len(t)), pc.fill_null(pc.list_value_length(t["term"]), 0).to_numpy())
            docs, words = (v.dictionary_encode("encode") for v in (t["doc_id"].combine_chunks().take(pa.array(row)), flat("term")))
            ids, terms = docs.dictionary, words.dictionary
            d, w = docs.indices.to_numpy().astype(np.int64), words.indices.to_numpy().astype(np.int64)
            key, one, at = np.unique(d * len(terms) + w, return_index=True, return_inverse=True)
            tf = np.bincount(at, weights=flat("tf").to_numpy() if "tf" in t.column_names else None).astype(np.float64)
            d, w = d[one], w[one]
            drawn = np.array([flat(f"d{i}").to_numpy()[one] for i in range(k)], np.float64)
            edges = np.searchsorted(key // len(terms), np.arange(len(ids) + 1))
            lists = lambda first, flat, offsets: pa.ListArray.from_arrays(np.concatenate([[0], offsets + len(first)]).astype(np.int32), pa.concat_arrays([first, flat]))
            one = np.arange(len(ids) + 1)
            cols = {"block": pa.array(np.full(len(ids) + 1, t["block"][0].as_py(), np.int32)), "place": pa.array((one - 1).astype(np.int32)), "doc_id": pa.concat_arrays([pa.nulls(1, ids.type), ids])}
            cols["terms"] = lists(terms, terms.slice(0, 0), np.zeros(len(ids) + 1, np.int64))
            cols["places"] = lists(pa.array(np.arange(len(terms), dtype=np.int32)), pa.array((key % len(terms)).astype(np.int32)), edges)
            cols["tf"] = lists(pa.array(np.zeros(0)), pa.array(tf), edges)
            for i in range(k):
                x = tf * drawn[i] / drawn.sum(axis=0)
                cols[f"x{i}"] = lists(pa.array(np.bincount(w, weights=x, minlength=len(terms))), pa.array(np.bincount(d, weights=x, minlength=len(ids))), one)
            return pa.table(cols).slice(0, len(cols["place"]) if len(w) else 0)

        schema = f"block int, place int, doc_id {rows.schema['doc_id'].dataType.simpleString()}, terms array<string>, places array<int>, tf array<double>" + "".join(f", x{i} array<double>" for i in range(k))
        packed = written(drawn.groupBy("block").applyInArrow(pack, schema))
        state = links = None
        if k:
            x = [f"x{i}" for i in range(k)]
            zipped = F.arrays_zip(F.col("places").alias("place"), F.col("terms").alias("term"))
            of_terms = packed.where("place = -1").select("block", F.inline(zipped)).withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int"))
            links = written(of_terms.groupBy("bucket").applyInArrow(_linked, "bucket int, block int, places binary, slots binary, n long"))

            def first(held: pa.Table, links: pa.Table) -> pa.Table:
                held = held.sort_by("place")
                sums = lambda rows: np.stack([rows[c].combine_chunks().flatten().to_numpy() for c in x], axis=1)
                return _state(held["block"][0].as_py(), sums(held.slice(1)), sums(held.slice(0, 1)), [(b, at) for b, at, _ in _sent(links, k)])

            sums = packed.select("block", "place", *x)
            state = written(sums.groupBy("block").cogroup(links.where("block >= 0").groupBy("block")).applyInArrow(first, state_schema(k)))
        # In buckets, so that rounds read blocks where they are.
        name, path = f"topics_{uuid.uuid4().hex}", scratch(spark)
        written(packed.select("block", "place", "doc_id", "terms", "places", "tf").repartition(blocks, "block"), path, lambda w: w.bucketBy(blocks, "block").saveAsTable(name, path=path))
        forgotten(packed)
        held = spark.table(name)
        spark.sql(f"DROP TABLE {name}")  # its name; the files stay
        return cls(held, state, links, k, seed)

    def terms(self) -> DataFrame:
        """``block, place, term``, a row for each term of each block."""
        zipped = F.arrays_zip(F.col("places").alias("place"), F.col("terms").alias("term"))
        return self.held.where("place = -1").select("block", F.inline(zipped))


def state_schema(k: int) -> str:
    """Sums of a block: ``x`` of its documents and of the terms that it alone has (``bucket`` -1), or of terms of a bucket; ``s0, s1, ..``: sums over terms."""
    return "block int, bucket int, x binary" + "".join(f", s{i} double" for i in range(k))


def _linked(t: pa.Table) -> pa.Table:
    """A bucket's links, from ``block, place, term``; a term is in a block once."""
    block, place = _column(t, "block"), _column(t, "place")
    words = t["term"].combine_chunks().dictionary_encode()
    number = words.indices.to_numpy()
    blocks = np.bincount(number, minlength=len(words.dictionary))
    slot = np.cumsum(blocks > 1) - 1
    at = np.flatnonzero(blocks[number] > 1)
    at = at[np.lexsort((place[at], block[at]))]
    which, begin = np.unique(block[at], return_index=True)
    cut = lambda v: [b"", *(v[i:j].astype(np.int32).tobytes() for i, j in pairwise([*begin, len(at)]))]
    cols = [np.full(len(which) + 1, t["bucket"][0].as_py(), np.int32), np.concatenate([[-1], which]).astype(np.int32), pa.array(cut(place[at]), pa.binary()), pa.array(cut(slot[number[at]]), pa.binary())]
    return pa.table([*cols, np.array([len(blocks)] + [0] * len(which))], names=["bucket", "block", "places", "slots", "n"])


def _sent(rows: pa.Table, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """``bucket``, places in the block and sums or shares there, by bucket."""
    rows = rows.sort_by("bucket")
    x = rows["x"].to_pylist() if "x" in rows.column_names else [b""] * len(rows)
    return [(b, np.frombuffer(at, np.int32), np.frombuffer(v, np.float64).reshape(-1, k)) for b, at, v in zip(rows["bucket"].to_pylist(), rows["places"].to_pylist(), x, strict=True)]


def _state(block: int, docs: np.ndarray, terms: np.ndarray, met: list[tuple[int, np.ndarray]]) -> pa.Table:
    """Rows of ``state_schema`` from sums by document and by term; ``met``: buckets, and which terms are theirs."""
    own = np.ones(len(terms), bool)
    for _, at in met:
        own[at] = False
    x = [np.concatenate([docs, terms[own]]), *(terms[at] for _, at in met)]
    s = np.array([terms[own].sum(axis=0), *(v.sum(axis=0) for v in x[1:])])
    cols = [np.full(len(x), block, np.int32), np.array([-1, *(b for b, _ in met)], np.int32), pa.array([v.tobytes() for v in x], pa.binary()), *s.T]
    return pa.table([pa.array(c) for c in cols], names=["block", "bucket", "x", *(f"s{i}" for i in range(s.shape[1]))])


def _numbers(sent: pa.Table, names: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """What was sent of each place, and which places were sent anything."""
    out, there = np.zeros((n, len(names))), np.zeros(n, bool)
    if len(sent):
        at = _column(sent, "place")
        there[at] = True
        for i, c in enumerate(names):
            out[at, i] = _column(sent, c)
    return out, there


def _block(held: pa.Table) -> tuple[pa.Array, pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of a block, its documents in order, and document, place and count of each entry."""
    held = held.sort_by("place")
    docs = held.slice(1)
    lists = docs["places"].combine_chunks()
    doc = np.repeat(np.arange(len(docs)), lists.value_lengths().to_numpy())
    return held["terms"].slice(0, 1).combine_chunks().flatten(), docs, doc, lists.flatten().to_numpy(), docs["tf"].combine_chunks().flatten().to_numpy()


def _shares(sent: pa.Table, n_terms: int, n_docs: int, k: int, beta: float, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Shares of a block's terms, its documents' sums, and which terms are of which bucket."""
    p, own, met = np.zeros((n_terms, k)), np.ones(n_terms, bool), []
    for bucket, at, x in _sent(sent, k):
        if bucket < 0:
            sums = x
        else:
            p[at], own[at] = x, False
            met.append((bucket, at))
    p[own] = (sums[n_docs:] + beta) / totals
    return p, sums[:n_docs], met


class Topics:
    """``terms`` (``term``, and for each topic its share ``p0, p1, ..`` of that topic) and the number of topics."""

    def __init__(self, terms: DataFrame, k: int, alpha: float):
        self.terms, self.k, self.alpha = terms, k, alpha
        self.names = [f"p{i}" for i in range(k)]

    @classmethod
    def fit(cls, counts: DataFrame | Blocks, k: int = 2, passes: int = 15, alpha: float = 0.1, beta: float = 0.01, seed: int = 42) -> Topics:
        """Learn from ``doc_id, term, tf``, or from ``Blocks`` of as many topics, whose first shares are used up.  The first shares of a document's terms are drawn by hashes of both."""
        own = not isinstance(counts, Blocks)
        blocks = Blocks.of(counts, k, seed) if own else counts
        if (blocks.k, blocks.seed) != (k, seed) or blocks.first is None:
            raise ValueError("the blocks were made for other topics, or their first shares are used up")
        state, blocks.first = blocks.first, None
        links = blocks.links
        vocabulary = links.agg(F.sum("n")).first()[0] or 0
        held = blocks.held.select("block", "place", "terms", "places", "tf")
        for _ in range(passes):
            sent, totals = cls._shared(state, links, k, beta, vocabulary)

            def share(held: pa.Table, sent: pa.Table) -> pa.Table:
                terms, docs, doc, place, tf = _block(held)
                p, t, met = _shares(sent, len(terms), len(docs), k, beta, totals)  # noqa: B023
                t = t + alpha
                w = p[place] * t[doc]
                w *= (tf / w.sum(axis=1))[:, None]
                by = lambda at, n: np.stack([np.bincount(at, weights=w[:, i], minlength=n) for i in range(k)], axis=1)
                return _state(held["block"][0].as_py(), by(doc, len(docs)), by(place, len(terms)), met)

            last, state = state, written(held.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(share, state_schema(k)))
            forgotten(last)
        # Each term once: a shared one by the first block that has it.
        sent, totals = cls._shared(state, links, k, beta, vocabulary, once=True)
        names = [f"p{i}" for i in range(k)]

        def told(held: pa.Table, sent: pa.Table) -> pa.Table:
            terms, docs, *_ = _block(held)
            p, _, _ = _shares(sent, len(terms), len(docs), k, beta, totals)
            at = np.flatnonzero(~np.isnan(p[:, 0]))
            return pa.table([terms.take(pa.array(at)), *p[at].T], names=["term", *names])

        schema = "term string" + "".join(f", {c} double" for c in names)
        model = cls(written(held.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(told, schema)), k, alpha)
        forgotten(state)
        forgotten(links)
        if own:
            forgotten(blocks.held)
        return model

    @staticmethod
    def _shared(state: DataFrame, links: DataFrame, k: int, beta: float, vocabulary: int, once: bool = False) -> tuple[DataFrame, np.ndarray]:
        """``block, bucket, places, x``: shares of terms that blocks share (``once``: nan but in the first block of each), and a block's own sums; ``k`` totals."""
        row = state.agg(*(F.sum(f"s{i}") for i in range(k))).first()
        totals = np.array([v or 0.0 for v in row]) + beta * vocabulary

        def summed(links: pa.Table, state: pa.Table) -> pa.Table:
            found = dict(zip(state["block"].to_pylist(), state["x"].to_pylist(), strict=True))
            links = links.sort_by("block")
            block, places = links["block"].to_pylist(), links["places"].to_pylist()
            slots = [np.frombuffer(v, np.int32) for v in links["slots"].to_pylist()]
            sums = np.zeros((max((int(v.max()) + 1 for v in slots), default=0), k))
            for b, at in zip(block, slots, strict=True):
                sums[at] += np.frombuffer(found[b], np.float64).reshape(-1, k)
            shares, x = (sums + beta) / totals, []
            for at in slots:
                x.append(shares[at].tobytes())
                if once:
                    shares[at] = np.nan
            bucket = np.full(len(block), links["bucket"][0].as_py(), np.int32)
            return pa.table([np.array(block, np.int32), bucket, pa.array(places, pa.binary()), pa.array(x, pa.binary())], names=["block", "bucket", "places", "x"])

        known = links.where("block >= 0").select("bucket", "block", "places", "slots")
        met = state.where("bucket >= 0").select("bucket", "block", "x")
        shared = known.groupBy("bucket").cogroup(met.groupBy("bucket")).applyInArrow(summed, "block int, bucket int, places binary, x binary")
        return shared.unionByName(state.where("bucket < 0").select("block", "bucket", F.lit(b"").alias("places"), "x")), totals

    def shares(self, counts: DataFrame | Blocks, passes: int = 5) -> DataFrame:
        """``doc_id, topics``: each document's share of each topic, with the terms' shares as they are; unknown terms don't count."""
        own = not isinstance(counts, Blocks)
        blocks = Blocks.of(counts) if own else counts
        names, k, alpha = self.names, self.k, self.alpha
        sent = blocks.terms().join(self.terms, "term").select((F.col("block") + 0).alias("block"), "place", *names)
        kind = blocks.held.schema["doc_id"].dataType.simpleString()

        def rounds(held: pa.Table, sent: pa.Table) -> pa.Table:
            terms, docs, doc, place, tf = _block(held)
            p, known = _numbers(sent, names, len(terms))
            met = known[place]
            doc, p, tf = doc[met], p[place[met]], tf[met]
            t = np.ones((len(docs), k))
            for _ in range(passes):
                w = p * t[doc]
                w *= (tf / w.sum(axis=1))[:, None]
                t = np.stack([np.bincount(doc, weights=w[:, i], minlength=len(docs)) for i in range(k)], axis=1) + alpha
            told = t / t.sum(axis=1, keepdims=True)
            topics = pa.ListArray.from_arrays(np.arange(0, told.size + 1, k).astype(np.int32), pa.array(told.ravel()))
            return pa.table([docs["doc_id"].combine_chunks(), topics], names=["doc_id", "topics"])

        held = blocks.held.select("block", "place", "doc_id", "terms", "places", "tf")
        found = written(held.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(rounds, f"doc_id {kind}, topics array<double>"))
        if own:
            forgotten(blocks.held)
        return found

    def perplexity(self, counts: DataFrame) -> float:
        """Of documents the model wasn't learned from: topics by one half of a document's terms, the score by the other."""
        half = F.pmod(F.xxhash64("term", F.lit(5)), F.lit(2)) == 0
        told, asked = counts.where(half), counts.where(~half)
        shares = self.shares(told)
        met = asked.join(self.terms, "term").join(shares, "doc_id")
        p = _sum([F.col(c) * F.col("topics")[i] for i, c in enumerate(self.names)])
        row = met.agg((-F.sum(F.col("tf") * F.log(p)) / F.sum("tf")).alias("h")).select(F.exp("h").alias("perplexity")).first()
        return row.perplexity

    def write(self, folder: str) -> None:
        self.terms.write.mode("overwrite").parquet(folder)

    @classmethod
    def read(cls, spark: SparkSession, folder: str, alpha: float = 0.1) -> Topics:
        terms = spark.read.parquet(folder)
        return cls(terms, len(terms.columns) - 1, alpha)

    def words(self, n: int = 10) -> DataFrame:
        """``topic, rank, term``: the terms with the largest share of each topic."""
        long = self.terms.select("term", F.posexplode(F.array(*self.names)).alias("topic", "p"))
        rank = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("p"), "term"))
        return long.withColumn("rank", rank).where(F.col("rank") <= n).select("topic", "rank", "term")
