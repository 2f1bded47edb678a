"""N-gram Jaccard join by T-occurrence search (DivideSkip), exact.

Documents with equal shingle sets form a class and are searched once.  A global order puts shingles that a fixed-size
count sketch has seen less often first; two sets with a Jaccard similarity of 0.75 or more share one of their first
``n - ceil(0.75 n) + 1`` shingles in that order, whatever the order is.  Spark groups these by shingle; the members of
a list, split where neighbouring sizes differ too much to link, make up the bundle of their least class.  So each pair
that can link is in some bundle, and a bundle holds whole sets: there the search runs.

Before whole sets are moved, a sieve drops what can't link.  Every class has a bitmap of about two bits a shingle that
holds the parities of its hashed shingles; two bitmaps that differ in ``d`` bits belong to sets whose overlap is
``(n + m - d) / 2`` at most.  A bundle falls apart into the components of its pairs that this bound allows.

A search inverts the sets of its bundle.  For a query with ``n`` shingles that must meet ``T`` times, the ``L`` longest
of its lists are put aside, the short ones are heap-merged to find documents that occur ``T - L`` times, and the long
ones are probed for these by binary search; the count is exact.  First the least class is a query; then each document
that isn't connected with it is.  Pairs that are both connected with it need no search, as they are in one component.

A bundle of over ``BLOCK`` classes, or of very long sets, is dealt over blocks; each has the least class too.  What isn't connected with it
there is then a query against all other blocks of its bundle.  Nothing is capped or dropped.

Cases: null and empty texts have no shingles and link with nothing; a text of fewer than five words has all its words
as its one shingle; rows that repeat a ``doc_id`` are all returned; very long texts are read whole; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .arrays import pack, shingle_rows, unpack, utf8, words
from .common import groups, per_group, salted_join, stored, table, text_chunks
from .components import components

SHARE = 75
WIDTH = 5
BLOCK = 512
#: Shingles that a block's sets have together, about.
BLOCK_SHINGLES = 2_000_000
#: A shingle's list that may have this many classes is not gathered in one task.
LONG_LIST = 1 << 13
#: Counters of the sketch: its size is fixed, so that it can go to every task whatever the corpus.
SKETCH_BITS = 20
SEGMENTS = 64
#: Cost of a probe against a merge step, for the choice of L.
MU = 0.0085


def sketch(values: DataFrame, explode_from, bits: int = SKETCH_BITS) -> np.ndarray:
    """How often each slot is hit; ``explode_from`` gives the 64-bit numbers of a batch.  Summed by segment in Spark."""
    slots, per = 1 << bits, (1 << bits) // SEGMENTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(slots, np.uint32)
        for b in batches:
            for x in explode_from(b):
                seen += np.bincount((x & np.uint64(slots - 1)).astype(np.int64), minlength=slots).astype(np.uint32)
        for k in range(SEGMENTS):
            part = seen[k * per : (k + 1) * per]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["segment", "counts"])

    def add(t: pa.Table) -> Iterator[pa.RecordBatch]:
        total = np.zeros(per, np.uint64)
        for x in t["counts"]:
            total += np.frombuffer(x.as_py(), np.uint32)
        yield pa.RecordBatch.from_arrays([t["segment"].combine_chunks()[:1], pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()], pa.binary())], names=["segment", "counts"])

    schema = "segment int, counts binary"
    out = np.zeros(slots, np.uint32)
    for r in per_group(values.mapInArrow(count, schema), ["segment"], add, schema).collect():  # 4 MB in all
        out[r.segment * per : (r.segment + 1) * per] = np.frombuffer(r.counts, np.uint32)
    return out


def rows_of(batch: pa.RecordBatch, width: int = WIDTH) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of a batch (``doc_id, text``) with the distinct shingles of each row."""
    for b in text_chunks(batch, "text", 1 << 22):
        raw, at = utf8(b.column(1))
        yield b, shingle_rows(*words(raw, at), width)


def class_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(n: int, share: int) -> int:
    return -(-share * n // 100)


def bitmap(shingles: np.ndarray) -> bytes:
    """Parities of hashed shingles: a power of two of 64 bits, twice as many bits as shingles at least."""
    size = 1 << max(6, int(2 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles >> np.uint64(24) & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def sieve(sizes: list[int], bitmaps: list[bytes], share: int = SHARE) -> list[int]:
    """For each set of a bundle the first set (smallest place) of its component of pairs that may link."""
    top = list(range(len(sizes)))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    order = sorted(top, key=lambda i: (len(bitmaps[i]), sizes[i]))
    n = np.array([sizes[i] for i in order], np.int64)
    words = [np.frombuffer(bitmaps[i], np.uint64) for i in order]
    width, rows = 0, np.zeros((0, 0), np.uint64)
    for at in range(len(order) - 1):
        if len(words[at]) != width:  # all sets from here on have bitmaps of this width or larger ones, which fold
            width = len(words[at])
            rows = np.stack([np.bitwise_xor.reduce(w.reshape(-1, width), axis=0) for w in words[at:]])
            base = at
        apart = np.bitwise_count(rows[at - base + 1 :] ^ rows[at - base]).sum(axis=1, dtype=np.int64)
        most = (n[at] + n[at + 1 :] - apart) // 2
        for k in np.flatnonzero(100 * most >= share * (n[at] + n[at + 1 :] - most)).tolist():
            a, b = find(order[at]), find(order[at + 1 + k])
            top[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sizes))]


class Bundle:
    """Inverted lists of some sets, and the components found so far."""

    def __init__(self, sets: list[np.ndarray], share: int = SHARE):
        self.share, self.sets = share, sets
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)])
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(flat, kind="stable")
        ranked = flat[order]
        new = np.ones(len(ranked), bool)
        np.not_equal(ranked[1:], ranked[:-1], out=new[1:])
        number = np.cumsum(new) - 1
        self.list_of = np.empty(len(flat), np.int64)
        self.list_of[order] = number
        self.posting = owner[order]
        self.starts = np.append(np.flatnonzero(new), len(flat))
        self.lengths = np.diff(self.starts)
        self.keys = number * len(sets) + self.posting  # sorted: by list, then by owner
        self.top = list(range(len(sets)))

    def find(self, i: int) -> int:
        while self.top[i] != i:
            self.top[i] = self.top[self.top[i]]
            i = self.top[i]
        return i

    def join(self, i: int, k: int) -> None:
        a, b = self.find(i), self.find(k)
        self.top[max(a, b)] = min(a, b)

    def query(self, i: int) -> np.ndarray:
        """The other sets that link with set i."""
        n = int(self.sizes[i])
        t = least_overlap(n, self.share)  # the least overlap with any set that can link
        lists = self.list_of[self.begins[i] : self.begins[i + 1]]
        lists = lists[self.lengths[lists] > 1]
        none = np.zeros(0, np.int64)
        if not t or len(lists) < t:
            return none
        lists = lists[np.argsort(-self.lengths[lists], kind="stable")]
        longest = int(self.lengths[lists[0]])
        n_long = min(t - 1, int(t / (MU * np.log2(longest) + 1)))
        far, near = lists[:n_long], lists[n_long:]
        need = t - n_long
        merged = heapq.merge(*(self.posting[self.starts[k] : self.starts[k + 1]].tolist() for k in near))
        met = [(k, c) for k, g in groupby(merged) if (c := sum(1 for _ in g)) >= need and k != i]
        found, count = np.array([k for k, _ in met], np.int64), np.array([c for _, c in met], np.int64)
        m = self.sizes[found]
        fits = (100 * np.minimum(m, n) >= self.share * np.maximum(m, n))
        found, count = found[fits], count[fits]
        if not len(found):
            return none
        for at in range(0, len(far), 4096):
            probe = far[at : at + 4096, None] * len(self.sets) + found[None, :]
            where = np.minimum(np.searchsorted(self.keys, probe), len(self.keys) - 1)
            count = count + (self.keys[where] == probe).sum(axis=0)
        return found[100 * count >= self.share * (n + self.sizes[found] - count)]

    def connect(self, first: int) -> list[int]:
        """Find the components; the sets that aren't connected with set ``first``."""
        for k in self.query(first):
            self.join(first, int(k))
        apart = [i for i in range(len(self.sets)) if self.find(i) != self.find(first)]
        for i in apart:
            for k in self.query(i):
                self.join(i, int(k))
        return [i for i in apart if self.find(i) != self.find(first)]

    def edges(self, names: list[int]) -> tuple[list[int], list[int]]:
        """A star for each component of several sets."""
        a, b = [], []
        for i in range(len(names)):
            if (r := self.find(i)) != i:
                a.append(names[i])
                b.append(names[r])
        return a, b


def _sets(column) -> list[np.ndarray]:
    return [unpack(x.as_py()) for x in column]


def _found(a: list[int], b: list[int], apart: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([apart] * len(a), pa.int32())], names=["a", "b", "apart"])


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE, width: int = WIDTH, block: int = BLOCK, long_list: int = LONG_LIST) -> tuple[DataFrame, DataFrame]:
    """Membership (``doc_id, n_shingles, cls``) and edges between classes (``a, b``) that span all components."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def numbers(batch):
        for _, rows in rows_of(batch, width):
            yield np.concatenate(rows)

    counts = spark.sparkContext.broadcast(sketch(docs, numbers))
    mask = np.uint64((1 << SKETCH_BITS) - 1)

    def first_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        order = counts.value
        for batch in batches:
            for b, rows in rows_of(batch, width):
                cls, first, often, bits = [], [], [], []
                for s in rows:
                    c = class_of(s) if len(s) else None
                    cls.append(c)
                    if c is None or c in seen:  # once a task is enough
                        first.append(None)
                        often.append(None)
                        bits.append(None)
                        continue
                    seen.add(c)
                    bits.append(bitmap(s))
                    met = order[(s & mask).astype(np.int64)]
                    rare = np.argsort(met, kind="stable")[: len(s) - least_overlap(len(s), share) + 1]
                    long = met[rare] >= long_list
                    first.append(s[rare[~long]].view(np.int64))
                    often.append(s[rare[long]].view(np.int64))
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (first, often)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(s) for s in rows], pa.int64()), pa.array(cls, pa.int64()), *lists, pa.array(bits, pa.binary())], names=["doc_id", "n_shingles", "cls", "first", "often", "bits"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = stored(docs.mapInArrow(first_shingles, f"doc_id {kind}, n_shingles long, cls long, first array<long>, often array<long>, bits binary"))

    # Lists of at least two classes whose sizes can link, each as a run of neighbouring sizes.
    def posted(column: str) -> DataFrame:
        return rows.where(f"{column} is not null").select(F.explode(column).alias("s"), "cls", F.col("n_shingles").cast("int").alias("n"))

    def runs(sizes: DataFrame, low: str, high: str) -> DataFrame:
        """Adds ``leader`` and ``other``: the least and the largest class of a row's run."""
        by_size = Window.partitionBy("s").orderBy("n", low)
        apart = F.coalesce(F.lag("n").over(by_size).cast("long") * 100 < F.col("n") * share, F.lit(True))
        run = sizes.withColumn("run", F.sum(apart.cast("int")).over(by_size.rowsBetween(Window.unboundedPreceding, 0)))
        in_run = Window.partitionBy("s", "run")
        return run.withColumns({"leader": F.min(low).over(in_run), "other": F.max(high).over(in_run)}).where("leader < other")

    listed = runs(posted("first"), "cls", "cls").select("leader", "cls", "n")
    # Of a long list only the sizes are gathered, with their least and largest classes; its rows are dealt over salts.
    long = posted("often").withColumn("key", F.struct("s", "n"))
    sizes = runs(long.groupBy("s", "n").agg(F.min("cls").alias("low"), F.max("cls").alias("high"), F.count("*").alias("_n")), "low", "high")
    led = salted_join(long.select("key", "cls", "n"), sizes.select(F.struct("s", "n").alias("key"), "leader", "_n"), "key", how="inner")
    members = stored(listed.unionByName(led.select("leader", "cls", "n")).distinct())

    def sieved(t: pa.Table) -> Iterator[pa.RecordBatch]:
        names = t["cls"].to_pylist()  # sorted
        of = sieve(t["n"].to_pylist(), t["bits"].to_pylist(), share)
        more = {k for i, k in enumerate(of) if k != i}
        keep = [i for i, k in enumerate(of) if k in more]
        if keep:
            yield pa.RecordBatch.from_arrays([pa.array([names[of[i]] for i in keep], pa.int64()), pa.array([names[i] for i in keep], pa.int64()), t["n"].combine_chunks().take(pa.array(keep))], names=["leader", "cls", "n"])

    # Wide bundles are left as they are: their members are searched by blocks.
    many = stored(members.groupBy("leader").agg(F.count("*").alias("_n")))
    flagged = salted_join(members, many.withColumn("wide", F.col("_n") > block), "leader", how="inner")
    bitmaps = rows.where("bits is not null").select("cls", "bits")
    bitmaps = bitmaps.join(members.select("cls").distinct(), "cls", "left_semi").dropDuplicates(["cls"])
    small = flagged.where("not wide").select("leader", "cls", "n").join(bitmaps, "cls")
    small = small.repartition("leader").sortWithinPartitions("leader", "cls").mapInArrow(lambda b: (x for t in groups(b, ["leader"]) for x in sieved(t)), "leader long, cls long, n int")
    members = stored(small.unionByName(flagged.where("wide").select("leader", "cls", "n")).distinct())

    blocks = F.ceil(F.greatest(F.col("_n") / block, F.col("all") / BLOCK_SHINGLES)).cast("int")
    wide = stored(members.groupBy("leader").agg(F.count("*").alias("_n"), F.sum("n").alias("all")).select("leader", "_n", blocks.alias("blocks")))
    dealt = salted_join(members.select("leader", "cls"), wide, "leader", how="inner")
    wide = wide.where("blocks > 1")
    dealt = dealt.where((F.col("blocks") == 1) | (F.col("cls") != F.col("leader"))).select("leader", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("block"), "cls", "blocks")
    leaders = wide.select("leader", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("leader").alias("cls"), "blocks")
    dealt = dealt.unionByName(leaders)

    def sets_of(wanted: DataFrame) -> DataFrame:
        """``cls, shingles`` of some classes; a fixed-size filter keeps most others from being moved at all."""
        bit = lambda x: x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
        bits = spark.sparkContext.broadcast(sketch(wanted, lambda b: [bit(b.column(0).to_numpy(zero_copy_only=False))]) > 0)

        def whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            may = bits.value
            for batch in batches:
                for _, rows in rows_of(batch, width):
                    cls, sets = [], []
                    for s in rows:
                        if len(s) and (c := class_of(s)) not in seen and may[int(bit(np.array([c], np.int64))[0] & mask)]:
                            seen.add(c)
                            cls.append(c)
                            sets.append(pack(s >> np.uint64(8)))
                    if cls:
                        yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(sets, pa.binary())], names=["cls", "shingles"])

        return docs.mapInArrow(whole_sets, "cls long, shingles binary").join(wanted, "cls", "left_semi").dropDuplicates(["cls"])

    sets = sets_of(members.select("cls").distinct())

    def search(t: pa.Table) -> Iterator[pa.RecordBatch]:
        names = t["cls"].to_pylist()
        leader = t["leader"][0].as_py()
        bundle = Bundle(_sets(t["shingles"]), share)
        left = bundle.connect(names.index(leader))
        a, b = bundle.edges(names)
        if a:
            yield _found(a, b, 0)
        if t["blocks"][0].as_py() > 1 and left:
            yield _found([leader] * len(left), [names[i] for i in left], 1)

    found = stored(per_group(dealt.join(sets, "cls"), ["leader", "block"], search, "a long, b long, apart int"))
    edges = found.where("apart = 0").select("a", "b")
    left = found.where("apart = 1").select(F.col("a").alias("leader"), F.col("b").alias("cls"))
    if left.limit(1).count():
        # Each of these is a query against every block of its bundle, so many of them at a time as a block has.
        chunks = left.groupBy("leader").agg(F.count("*").alias("_n")).withColumn("chunks", F.ceil(F.col("_n") / block).cast("int")).join(wide.select("leader", "blocks"), "leader")
        asked = salted_join(left, chunks, "leader", how="inner").withColumn("chunk", F.pmod(F.xxhash64("cls", F.lit(1)), F.col("chunks")).cast("int"))
        asked = asked.select("leader", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "chunk", "cls", F.lit(1).alias("role"))
        index = salted_join(dealt.where("blocks > 1"), chunks.select("leader", "chunks").join(wide.select("leader", "_n"), "leader"), "leader", how="inner")
        index = index.select("leader", "block", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "cls", F.lit(0).alias("role"))

        def across(t: pa.Table) -> Iterator[pa.RecordBatch]:
            names, roles = t["cls"].to_pylist(), t["role"].to_pylist()
            place: dict[int, int] = {}
            sets, ask = [], []
            for c, r, s in zip(names, roles, _sets(t["shingles"]), strict=True):
                if c not in place:
                    place[c] = len(sets)
                    sets.append(s)
                if r:
                    ask.append(place[c])
            bundle = Bundle(sets, share)
            for i in ask:
                for k in bundle.query(i):
                    bundle.join(i, int(k))
            a, b = bundle.edges(list(place))
            if a:
                yield _found(a, b, 0)

        in_wide = dealt.where("blocks > 1").select("cls").distinct()
        more = per_group(asked.unionByName(index).join(sets_of(in_wide), "cls"), ["leader", "block", "chunk"], across, "a long, b long, apart int")
        edges = edges.unionByName(stored(more).select("a", "b"))
    return rows.select("doc_id", "n_shingles", "cls"), edges


def link_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE, width: int = WIDTH, block: int = BLOCK, long_list: int = LONG_LIST) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row."""
    rows, edges = links(docs, id_col, text_col, share, width, block, long_list)
    named = components(edges)
    classes = rows.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("least"), F.count("*").alias("_n"))
    full = stored(classes.join(named, classes["cls"] == named["node"], "left").select("cls", "least", "_n", F.coalesce("component", "cls").alias("component")))
    ids = full.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("_m"))
    of_class = salted_join(full.drop("least"), ids, "component", "_m", "inner").select("cls", "component_id", "_n")
    out = salted_join(rows, of_class, "cls")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def op8_divide_skip_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"))
