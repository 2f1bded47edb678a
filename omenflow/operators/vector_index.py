"""A stored vector index: cells of near vectors, whose residuals are kept as product-quantised codes; exact ways beside it.

Centroids and codebooks are fitted on a bounded sample (``SAMPLE`` rows, ``SAMPLE_NUMBERS`` numbers); every row is indexed.
A cell's rows are dealt over parts, so that copies of one vector are no single group.  A search reads codes of the nearest cells only,
and full vectors only of its shortlist; how many cells that takes is learned when the index is built, from the exact
neighbours of a few rows.  ``exact`` searches then go on to every cell that may hold a better row (by its radius), score
what the codes' errors allow for, and so give the same rows as a full scan.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.writers import scratch
from . import corpus

#: Rows that centroids and codebooks are fitted on, and numbers in them, at most.
SAMPLE, SAMPLE_NUMBERS = 1 << 17, 1 << 24
CELLS = 4096
#: Rows of a part of a cell, and queries that are searched in it at once, about.
PART_ROWS, QUERY_ROWS = 1 << 15, 1 << 11
#: Rows whose exact neighbours teach how many cells a search needs.
TAUGHT = 100
FUZZ = 1e-6


def units(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Rows of length 1 (zeros stay zeros)."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1 if len(whole) else 0)
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


def usable(vector: Column) -> Column:
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf"))), F.lit(False))


def closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, in slices."""
    half = (centres * centres).sum(axis=1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ centres.T - half, axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


def k_means(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.Generator(np.random.PCG64(seed))
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = closest(x, centres)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


class Model:
    """Centroids of cells, and for each run of dimensions a codebook of residuals."""

    def __init__(self, centres: np.ndarray, books: list[np.ndarray]):
        self.centres, self.books = centres, books
        self.edges = np.cumsum([0, *(b.shape[1] for b in books)])

    @classmethod
    def fit(cls, x: np.ndarray, cells: int, runs: int, seed: int) -> Model:
        centres = k_means(x, min(cells, len(x)), seed)
        left = x - centres[closest(x, centres)]
        parts = [p for p in np.array_split(np.arange(x.shape[1]), min(runs, x.shape[1])) if len(p)]
        return cls(centres, [k_means(left[:, p], min(256, len(x)), seed + 1 + i) for i, p in enumerate(parts)])

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Cell, codes, length of what the codes miss, and distance from the centre of each row."""
        cell = closest(x, self.centres)
        left = x - self.centres[cell]
        codes = np.stack([closest(left[:, a:b], book) for a, b, book in zip(self.edges, self.edges[1:], self.books, strict=False)], axis=1).astype(np.uint8)
        return cell, codes, np.linalg.norm(left - self.decode(codes), axis=1), np.linalg.norm(left, axis=1)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], axis=1)

    def rows(self) -> list[tuple]:
        return [("centres", 0, self.centres.shape[1], self.centres.ravel().tolist())] + [("book", i, b.shape[1], b.ravel().tolist()) for i, b in enumerate(self.books)]

    @classmethod
    def of_rows(cls, rows) -> Model:
        shaped = lambda r: np.array(r.numbers).reshape(-1, r.width)
        found = sorted(rows, key=lambda r: r.place)
        return cls(next(shaped(r) for r in found if r.kind == "centres"), [shaped(r) for r in found if r.kind == "book"])


class VectorIndex:
    """``rows`` (``cell, part, id, code, error, embedding``), ``cells`` (``cell, n, parts, radius``) and ``model`` in a folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.rows = spark.read.parquet(f"{folder}/rows")
        self.model = Model.of_rows(spark.read.parquet(f"{folder}/model").collect())
        self.cells = {r.cell: (r.n, r.parts, r.radius) for r in spark.read.parquet(f"{folder}/cells").collect()}  # CELLS rows at most
        self.probes = json.loads(spark.read.text(f"{folder}/settings").first()[0])["probes"]

    @classmethod
    def build(cls, vectors: DataFrame, folder: str | None = None, id_col: str = "vec_id", vector: str = "embedding", cells: int | None = None, runs: int | None = None, part_rows: int = PART_ROWS, k: int = 5, recall: float = 0.97, seed: int = 11) -> VectorIndex | None:
        """Index all rows whose vector is whole and finite (all of one length); None where there are none.

        ``recall``: the share of the exact ``k`` neighbours whose cells a search must read, over ``TAUGHT`` rows.
        """
        spark = vectors.sparkSession
        folder = folder or scratch(spark)
        given = vectors.select(F.col(id_col).alias("id"), F.col(vector).alias("embedding")).where(usable(F.col("embedding")))
        n, width = given.agg(F.count("*"), F.max(F.size("embedding"))).first()
        if not n:
            return None
        most = min(SAMPLE, SAMPLE_NUMBERS // width)
        sample = units(given.select("embedding").sample(min(1.0, most / n), seed=seed).limit(2 * most).toArrow()["embedding"]) if n > 1 else units(given.select("embedding").toArrow()["embedding"])
        model = Model.fit(sample, cells or min(CELLS, max(1, round(n**0.5))), runs or max(1, width // 2), seed)
        spark.createDataFrame(model.rows(), "kind string, place int, width int, numbers array<double>").coalesce(1).write.mode("overwrite").parquet(f"{folder}/model")

        def encode(batches):
            for b in batches:
                if b.num_rows:
                    cell, codes, error, away = model.encode(units(b.column(1)))
                    yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(away)], ["id", "embedding", "cell", "code", "error", "away"])

        kinds = {f.name: f.dataType.simpleString() for f in given.schema}
        coded = given.mapInArrow(encode, f"id {kinds['id']}, embedding {kinds['embedding']}, cell int, code binary, error double, away double")
        coded.write.mode("overwrite").parquet(f"{folder}/coded")
        coded = spark.read.schema(coded.schema).parquet(f"{folder}/coded")
        stats = coded.groupBy("cell").agg(F.count("*").alias("n"), F.ceil(F.count("*") / part_rows).cast("int").alias("parts"), F.max("away").alias("radius"))
        stats.coalesce(1).write.mode("overwrite").parquet(f"{folder}/cells")
        places = F.broadcast(spark.read.schema(stats.schema).parquet(f"{folder}/cells").select("cell", "parts"))  # CELLS rows at most
        dealt = coded.join(places, "cell").withColumn("part", F.pmod(F.xxhash64("id", "embedding", F.monotonically_increasing_id()), "parts").cast("int"))
        dealt.select("cell", "part", "id", "code", "error", "embedding").repartitionByRange("cell", "part").sortWithinPartitions("cell", "part").write.mode("overwrite").parquet(f"{folder}/rows")
        # How many cells: a few rows' exact neighbours, and where their cells come in the order of a search.
        few = given.orderBy(F.xxhash64("id"), "id").limit(TAUGHT)
        exact = corpus.nearest(given.withColumnRenamed("id", "vec_id"), few.withColumnRenamed("id", "vec_id"), k)
        near = exact.join(coded.select(F.col("id").alias("vec_id"), "cell"), "vec_id").join(few.select(F.col("id").alias("query_id"), "embedding"), "query_id").select("embedding", "cell").toArrow()  # TAUGHT * k rows
        if near.num_rows:
            order = np.argsort(np.argsort(-(units(near["embedding"]) @ model.centres.T), axis=1), axis=1)
            ranks = np.sort(order[np.arange(near.num_rows), near["cell"].to_numpy()])
            probes = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))]) + 1
        else:
            probes = len(model.centres)
        spark.createDataFrame([(json.dumps({"probes": probes}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/settings")
        return cls(spark, folder)

    def _sent(self, queries: DataFrame, probes: int | None, floors: bool) -> DataFrame:
        """Queries (``query_id, q``, and ``floor``), once for each part of each cell they are searched in."""
        model, cells = self.model, self.cells
        radius = np.array([cells.get(c, (0, 0, -np.inf))[2] for c in range(len(model.centres))])
        there = np.array([c in cells for c in range(len(model.centres))])
        kind = queries.schema["query_id"].dataType.simpleString()

        def run(batches):
            for b in batches:
                if not b.num_rows:
                    continue
                near = units(b.column(1)) @ model.centres.T
                near[:, ~there] = -np.inf
                if floors:
                    pick = (near + radius + FUZZ >= b.column(2).to_numpy()[:, None]) & there
                else:
                    pick = (np.argsort(np.argsort(-near, axis=1, kind="stable"), axis=1) < probes) & there
                at, cell = np.nonzero(pick)
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(at)) for c in b.columns), pa.array(cell.astype(np.int32))], [*b.schema.names, "cell"])

        names = "query_id, q array<double>, floor double" if floors else "query_id, q array<double>"
        sent = queries.select("query_id", F.col("q").cast("array<double>").alias("q"), *(["floor"] if floors else [])).mapInArrow(run, names.replace("query_id", f"query_id {kind}") + ", cell int")
        counted = {r.cell: r.n for r in sent.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # CELLS rows at most
        if not counted:
            counted = {0: 0}
        places = self.spark.createDataFrame([(c, cells[c][1] if c in cells else 1, -(-n // QUERY_ROWS) or 1) for c, n in counted.items()], "cell int, parts int, chunks int")
        self._chunks = places
        out = sent.join(F.broadcast(places), "cell").withColumn("chunk", F.pmod(F.xxhash64("query_id"), "chunks").cast("int"))
        return out.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "chunks")

    def _scan(self, sent: DataFrame, columns: list[str], score, schema: str) -> DataFrame:
        """``score`` on each part's rows and the queries sent to it; cells that no query asks for aren't read further."""
        held = self.rows.select("cell", "part", *columns).join(F.broadcast(self._chunks.select("cell", "chunks")), "cell")
        held = held.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
        keys = ["cell", "part", "chunk"]
        return held.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(score, schema)

    def shortlist(self, queries: DataFrame, size: int, probes: int | None = None) -> DataFrame:
        """``query_id, vec_id, cell, part, near``: of the nearest cells, the ``size`` best rows by their codes."""
        model = self.model
        kind, id_kind = queries.schema["query_id"].dataType.simpleString(), self.rows.schema["id"].dataType.simpleString()

        def score(rows: pa.Table, asked: pa.Table) -> pa.Table:
            ids, queries_ = rows["id"].combine_chunks(), asked["query_id"].combine_chunks()
            at, to, near = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            if len(ids) and len(queries_):
                q = units(asked["q"])
                codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
                s = q @ model.decode(codes).T + (q @ model.centres[rows["cell"][0].as_py()])[:, None]
                k = min(size, len(ids))
                best = np.argpartition(-s, k - 1, axis=1)[:, :k]
                at, to, near = np.repeat(np.arange(len(q)), k), best.ravel(), np.take_along_axis(s, best, axis=1).ravel()
            cell = [rows[c][0].as_py() if len(ids) else 0 for c in ("cell", "part")]
            return pa.table([queries_.take(pa.array(at)), ids.take(pa.array(to)), *(pa.array([c] * len(at), pa.int32()) for c in cell), pa.array(near)], names=["query_id", "vec_id", "cell", "part", "near"])

        found = self._scan(self._sent(queries, probes or self.probes, False), ["id", "code"], score, f"query_id {kind}, vec_id {id_kind}, cell int, part int, near double")
        best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("near"), "vec_id"))
        return found.where("not (query_id <=> vec_id)").withColumn("_r", best).where(F.col("_r") <= size).drop("_r")

    def search(self, queries: DataFrame, k: int = 5, exact: bool = False, probes: int | None = None, refine: int = 24, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
        """``query_id, vec_id, cosine, rank``: the ``k`` most similar rows of each query, itself left out; of equals the smallest ids.

        ``refine`` times ``k`` rows are scored in full; ``exact`` goes on until nothing better can be left.
        """
        asked = queries.select(F.col(id_col).alias("query_id"), F.col(vector).alias("q")).where(usable(F.col("q")))
        short = self.shortlist(asked, refine * k, probes)
        full = short.join(self.rows.select("cell", "part", F.col("id").alias("vec_id"), "embedding"), ["cell", "part", "vec_id"]).join(asked, "query_id")
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id"))
        best = lambda found: found.withColumn("rank", rank).where(F.col("rank") <= k)
        found = best(_refined(full))
        if not exact:
            return found
        path = scratch(self.spark)
        found.write.parquet(path)
        floors = self.spark.read.schema(found.schema).parquet(path).where(F.col("rank") == k).select("query_id", F.col("cosine").alias("floor"))
        bounded = asked.join(floors, "query_id", "left").withColumn("floor", F.coalesce("floor", F.lit(-2.0)) - FUZZ)
        return best(self._whole(bounded, k))

    def _whole(self, bounded: DataFrame, k: int) -> DataFrame:
        """The ``k`` best of each part for each query, among the rows whose codes and errors let them reach the floor."""
        model = self.model
        kind, id_kind = bounded.schema["query_id"].dataType.simpleString(), self.rows.schema["id"].dataType.simpleString()

        def score(rows: pa.Table, asked: pa.Table) -> pa.Table:
            rows = rows.sort_by("id")
            ids, queries_ = rows["id"].combine_chunks(), asked["query_id"].combine_chunks()
            at, to, cosines = [], [], []
            if len(ids) and len(queries_):
                q, x, floor = units(asked["q"]), units(rows["embedding"]), asked["floor"].to_numpy()
                codes = np.frombuffer(b"".join(rows["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
                reach = q @ model.decode(codes).T + (q @ model.centres[rows["cell"][0].as_py()])[:, None] + rows["error"].to_numpy()[None, :] + FUZZ
                own = np.array(ids.to_pylist(), object)
                for i, name in enumerate(queries_.to_pylist()):
                    may = np.flatnonzero((reach[i] >= floor[i]) & (own != name))
                    exact = (x[may] * q[i]).sum(axis=1)
                    top = np.argsort(-exact, kind="stable")[:k]
                    at += [i] * len(top)
                    to += may[top].tolist()
                    cosines += exact[top].tolist()
            return pa.table([queries_.take(pa.array(at, pa.int64())), ids.take(pa.array(to, pa.int64())), pa.array(cosines, pa.float64())], names=["query_id", "vec_id", "cosine"])

        return self._scan(self._sent(bounded, None, True), ["id", "code", "error", "embedding"], score, f"query_id {kind}, vec_id {id_kind}, cosine double")


def _refined(pairs: DataFrame) -> DataFrame:
    """``query_id, vec_id, cosine`` of pairs with both vectors."""

    def run(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            if t.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array((units(t["q"]) * units(t["embedding"])).sum(axis=1))], ["query_id", "vec_id", "cosine"])

    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema}
    return pairs.select("query_id", "vec_id", "q", "embedding").mapInArrow(run, f"query_id {kinds['query_id']}, vec_id {kinds['vec_id']}, cosine double")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """The share of exact (``query_id, vec_id``) pairs that were found; 1 where there are none."""
    met = exact.select("query_id", "vec_id").join(found.select("query_id", "vec_id", F.lit(1).alias("hit")), ["query_id", "vec_id"], "left")
    return met.agg(F.coalesce(F.avg(F.coalesce("hit", F.lit(0))), F.lit(1.0))).first()[0]
