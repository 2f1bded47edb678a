"""Whitening of embeddings by a blockwise TSQR and a one-sided Jacobi SVD.

The centred rows of the fit list (each distinct vector once) are compressed block by block to a triangular R: each task
folds its blocks into an R of its own by QR, and Rs are folded again in groups of ``FAN``, so that no task has more than
``FAN`` of them and the driver gets one.  Plane rotations then make the columns of R orthogonal: their lengths are the
standard deviations (no covariance is formed, so that small ones keep their digits) and the accumulated rotations are the
components.  The driver holds matrices of the vectors' dimensions only.

Cases: rows whose vector is null or has null or non-finite components are dropped, all others are returned; a null id
stays; rows with equal ids or vectors each have their rows; shorter vectors count as filled with zeros; components without
variance (fewer distinct vectors than components, constant dimensions) have ``whitened`` null and ``explained`` 0 and take no part in
``identity_error``, which is null where none has any; a deviation that a long can't hold is null; vectors of ``d``
dimensions have ``d`` components at most, so empty ones have none; an empty table gives no rows.  Columns other than the
id and the vector are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table
from .vectors import extent, fitted, matrix, quantised, usable

#: Rs that one task folds into one.
FAN = 64
#: Rows that are folded into an R at once.
BLOCK = 4096
#: Whole numbers up to here are exact as doubles.
EXACT = 1 << 53


def jacobi(r: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the orthogonalised columns of ``r``, falling, and the rotations: column k of the second is component k.

    Columns are scaled by a power of two first, so that squares of large and small numbers stay in range.
    """
    d = r.shape[1]
    top = np.abs(r).max(initial=0.0)
    scale = 2.0 ** np.floor(np.log2(top)) if top > 0 else 1.0
    u, v = r / scale, np.eye(d)
    for _ in range(sweeps):
        turned = False
        for i in range(d - 1):
            for j in range(i + 1, d):
                a, b = u[:, i], u[:, j]
                aa, bb, ab = a @ a, b @ b, a @ b
                if ab == 0.0 or abs(ab) <= 1e-16 * np.sqrt(aa * bb):
                    continue
                turned = True
                zeta = (bb - aa) / (2.0 * ab)
                t = (1.0 if zeta >= 0 else -1.0) / (abs(zeta) + np.hypot(1.0, zeta))
                c = 1.0 / np.hypot(1.0, t)
                turn = np.array([[c, c * t], [-c * t, c]])
                u[:, [i, j]] = u[:, [i, j]] @ turn
                v[:, [i, j]] = v[:, [i, j]] @ turn
        if not turned:
            break
    lengths = np.sqrt(np.einsum("ij,ij->j", u, u)) * scale
    order = np.argsort(-lengths, kind="stable")
    return lengths[order], v[:, order]


def fold(rs: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The R of an R and further rows, with a column for each dimension and no more rows than that."""
    return np.linalg.qr(np.vstack([rs, rows]), mode="r") if len(rows) else rs


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n`` with one rounding: ``n * x - sums`` is exact."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most < EXACT:
        return (n * x - np.array(sums, np.int64)) / n
    whole = n * x.astype(object) - np.array(sums, object)
    return np.array([[k / n for k in row] for row in whole], np.float64).reshape(x.shape)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The exact sum of squares of ``n * x - sums`` of each row; None where a long can't hold it."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0)
    if most * most * x.shape[1] < 1 << 63:
        y = n * x - np.array(sums, np.int64)
        return np.einsum("ij,ij->i", y, y).tolist()
    y = n * x.astype(object) - np.array(sums, object)
    return [k if (k := int(sum(c * c for c in row))) < 1 << 63 else None for row in y]


def column_sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows and exact sums by dimension, first within tasks."""

    def run(batches):
        n, sums = 0, [0] * d
        for b in batches:
            x = matrix(b.column(0), d)
            if len(x):
                n += len(x)
                wide = int(np.abs(x).max(initial=0)) * len(x) >= 1 << 63
                sums = [s + int(k) for s, k in zip(sums, (x.astype(object) if wide else x).sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_pydict({"k": list(range(-1, d)), "s": [str(n), *map(str, sums)]}, pa.schema([("k", pa.int32()), ("s", pa.string())]))

    parts = fit.select("x").mapInArrow(run, "k int, s string").groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    got = {r.k: int(r.s) for r in parts.collect()}  # a row for each dimension
    return got.get(-1, 0), [got.get(k, 0) for k in range(d)]


def triangle(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The R of the centred fit list, by folding in rounds."""
    d, schema = len(sums), "part long, r binary"
    as_r = lambda raw: np.frombuffer(raw, np.float64).reshape(-1, d)
    arrow = pa.schema([("part", pa.int64()), ("r", pa.binary())])
    batch = lambda part, r: pa.RecordBatch.from_pydict({"part": [part], "r": [np.ascontiguousarray(r).tobytes()]}, arrow)

    def first(batches):
        from pyspark import TaskContext

        r, any_rows = np.zeros((0, d)), False
        for b in batches:
            x = matrix(b.column(0), d)
            for i in range(0, len(x), BLOCK):
                r, any_rows = fold(r, centred(x[i : i + BLOCK], n, sums)), True
        if any_rows:
            yield batch(TaskContext.get().partitionId(), r)

    def again(batches):
        r, part = np.zeros((0, d)), None
        for b in batches:
            for p, raw in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if part is not None and p != part:
                    yield batch(part, r)
                    r = np.zeros((0, d))
                r, part = fold(r, as_r(raw)), p
        if part is not None:
            yield batch(part, r)

    found = stored(fit.select("x").mapInArrow(first, schema))
    left = found.agg(F.max("part") + 1).first()[0]
    while left > 1:
        left = -(-left // FAN)
        grouped = found.withColumn("part", F.expr(f"part div {FAN}")).repartition("part").sortWithinPartitions("part")
        found = stored(grouped.mapInArrow(again, schema)) if left > 1 else grouped.mapInArrow(again, schema)
    return as_r(found.first().r)


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """``id, component, n, deviation, whitened, explained, identity_error``: rows for each usable vector and component."""
    spark = df.sparkSession
    kept = df.where(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), quantised(F.col(vector_col), scale).alias("x"))
    _, d, largest = extent(kept, "x")
    kept = fitted(kept, "x", d, largest)
    k = min(components, d)
    id_type = kept.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, component int, deviation long, whitened double"
    if not k:
        return spark.createDataFrame([], schema).select("id", "component", F.lit(0).cast("long").alias("n"), "deviation", "whitened", F.lit(0.0).alias("explained"), F.lit(0.0).alias("identity_error"))
    fit = stored(kept.select("x").distinct())
    n, sums = column_sums(fit, d)
    lengths, turns = jacobi(triangle(fit, n, sums))
    spread = lengths[:k] / np.sqrt(n)
    alive = lengths[:k] > lengths[0] * d * np.finfo(np.float64).eps if lengths[0] > 0 else np.zeros(k, bool)
    total = float(lengths @ lengths)
    explained = [float(x * x / total) if ok else 0.0 for x, ok in zip(lengths[:k], alive, strict=True)]
    axes = turns[:, :k] / np.where(alive, spread, np.inf)

    def project(batches):
        for b in batches:
            x = matrix(b.column(0), d)
            if len(x):
                yield pa.RecordBatch.from_arrays([pa.array((centred(x, n, sums) @ axes[:, c])) for c in range(k)], [f"y{c}" for c in range(k)])

    live = np.flatnonzero(alive).tolist()
    error = None
    if live:
        pairs = [(i, j) for i in live for j in live if i <= j]
        y = fit.select("x").mapInArrow(project, ", ".join(f"y{c} double" for c in range(k)))
        got = y.agg(*(F.covar_pop(f"y{i}", f"y{j}").alias(f"c{i}_{j}") for i, j in pairs)).first()
        error = max(abs(got[f"c{i}_{j}"] - (i == j)) for i, j in pairs)

    def apply(batches):
        for b in batches:
            x = matrix(b.column(1), d)
            if not len(x):
                continue
            ids = b.column(0).take(pa.array(np.repeat(np.arange(len(x)), k)))
            y = pa.array((centred(x, n, sums) @ axes).ravel(), mask=np.tile(~alive, len(x)))
            dev = pa.array([v for v in deviations(x, n, sums) for _ in range(k)], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), dev, y], ["id", "component", "deviation", "whitened"])

    shares = F.array(*map(F.lit, explained))
    out = kept.select("id", "x").mapInArrow(apply, schema)
    return out.select("id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", shares[F.col("component") - 1].alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op13_jacobi_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")
