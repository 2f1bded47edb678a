"""Estimators that ``pyspark.ml`` lacks: the perceptron, hinge descent, and boosting by gradients and hessians.

They are ``pyspark.ml`` estimators themselves, so that pipelines, cross-validation and saving work as with the others.
What tasks are sent and what the driver gets has the size of a model or of its histograms, never of the rows.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.writers import scratch


class _Columns(HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    def _rows(self, df: DataFrame) -> DataFrame:
        """``x`` (array), ``y`` (0 or 1), written once, in as many parts as there are."""
        x = F.col(self.getFeaturesCol())
        rows = df.select(vector_to_array(x).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y")).where("x is not null and y is not null")
        path = scratch(df.sparkSession)
        rows.write.parquet(path)
        return df.sparkSession.read.schema(rows.schema).parquet(path)


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    x = batch.column(0)
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1), batch.column(1).to_numpy(zero_copy_only=False)


def descend(kind: str, w: np.ndarray, x: np.ndarray, sign: np.ndarray, rate: float, alpha: float, at: int) -> tuple[np.ndarray, np.ndarray, int]:
    """One pass over rows; gives the weights, their sum over all moments, and the number of steps so far.

    Perceptron: a wrong row (or one on the border) is added with its sign.  Hinge: weights but the last, the intercept,
    shrink by ``alpha``, and rows inside the margin are added; steps get smaller as ``1 / (alpha * steps)``.
    """
    w, total = w.copy(), np.zeros_like(w)
    for row, s in zip(x, sign, strict=True):
        margin = s * (w @ row)
        if kind == "perceptron":
            if margin <= 0:
                w += rate * s * row
        else:
            step = 1.0 / (alpha * (at + 1.0 / (alpha * rate)))
            w[:-1] *= max(0.0, 1.0 - step * alpha)
            if margin < 1:
                w += step * s * row
        total += w
        at += 1
    return w, total, at


class LinearModel(Model, _Columns):
    weights = Param(Params._dummy(), "weights", "weights, the intercept last", TypeConverters.toListFloat)

    def __init__(self, weights: list[float] | None = None):
        super().__init__()
        if weights is not None:
            self._set(weights=weights)

    def _transform(self, df: DataFrame) -> DataFrame:
        w = self.getOrDefault("weights")
        parts = F.zip_with(vector_to_array(F.col(self.getFeaturesCol())), F.array(*map(F.lit, w[:-1])), lambda a, b: a * b)
        margin = F.aggregate(parts, F.lit(w[-1]), lambda s, x: s + x)
        return df.withColumn(self.getPredictionCol(), (margin > 0).cast("double"))


class MixedLinear(Estimator, _Columns):
    """Weights learned by passes over each partition's rows, mixed after each by the partitions' numbers of rows; the average of all moments counts."""

    kind = Param(Params._dummy(), "kind", "perceptron or hinge", TypeConverters.toString)
    epochs = Param(Params._dummy(), "epochs", "passes over the rows", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "length of the first steps", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "shrinking of hinge descent", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, kind="perceptron", epochs=10, rate=1.0, alpha=0.0001, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(kind="perceptron", epochs=10, rate=1.0, alpha=0.0001)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> LinearModel:
        rows = self._rows(df)
        kind, rate, alpha = (self.getOrDefault(n) for n in ("kind", "rate", "alpha"))
        if kind not in ("perceptron", "hinge"):
            raise ValueError(f"unknown kind {kind!r}")
        width = (rows.agg(F.max(F.size("x"))).first()[0] or 0) + 1
        w, average, seen = np.zeros(width), np.zeros(width), 0
        for epoch in range(self.getOrDefault("epochs")):

            def run(batches, w=w, epoch=epoch):
                n, now, total, at = 0, w, np.zeros(width), None
                for b in batches:
                    if b.num_rows:
                        x, y = _arrays(b)
                        # A partition's steps go on from where its rows of the passes before would have brought them.
                        at = epoch * b.num_rows if at is None else at
                        now, t, at = descend(kind, now, np.hstack([x, np.ones((len(x), 1))]), 2 * y - 1, rate, alpha, at)
                        n, total = n + len(x), total + t
                if n:
                    places = np.arange(width)
                    yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(np.full(width, n)), pa.array(n * now), pa.array(total)], ["place", "n", "w", "total"])

            got = rows.mapInArrow(run, "place long, n long, w double, total double").groupBy("place").agg(F.sum("n"), F.sum("w"), F.sum("total")).orderBy("place").collect()  # a row a weight
            if not got:
                break
            n = got[0][1]
            w = np.array([r[2] for r in got]) / n
            average += np.array([r[3] for r in got])
            seen += n
        made = LinearModel((average / max(seen, 1)).tolist())
        return self._copyValues(made)


def best_splits(gradient: np.ndarray, hessian: np.ndarray, shrink: float, cost: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gain, feature and bin of each node's best split, from nodes x features x bins sums; rows up to the bin go left."""
    gl, hl = gradient.cumsum(axis=2)[:, :, :-1], hessian.cumsum(axis=2)[:, :, :-1]
    g, h = gradient.sum(axis=2)[:, :, None], hessian.sum(axis=2)[:, :, None]
    gr, hr = g - gl, h - hl
    score = lambda a, b: a * a / (b + shrink)
    gain = (score(gl, hl) + score(gr, hr) - score(g, h)) / 2 - cost
    gain = np.where((hl >= least) & (hr >= least), gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    at = flat.argmax(axis=1)
    return flat[np.arange(len(flat)), at], at // gain.shape[2], at % gain.shape[2]


def leaves_of(trees: list[dict], bins: np.ndarray) -> np.ndarray:
    """The sum of all trees' leaves for rows of binned features.  A tree's node k has the children 2k+1 and 2k+2."""
    out = np.zeros(len(bins))
    for t in trees:
        feature, cut, value = (np.array(t[n]) for n in ("feature", "cut", "value"))
        at = np.zeros(len(bins), np.int64)
        while (inner := feature[at] >= 0).any():
            go = bins[np.arange(len(bins)), np.maximum(feature[at], 0)] > cut[at]
            at = np.where(inner, 2 * at + 1 + go, at)
        out += value[at]
    return out


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, i], side="left") for i, e in enumerate(edges)], axis=1) if len(edges) else np.zeros((len(x), 0), np.int64)


class BoostedModel(Model, _Columns):
    trees = Param(Params._dummy(), "trees", "edges of bins, trees and the first margin as JSON", TypeConverters.toString)

    def __init__(self, trees: str | None = None):
        super().__init__()
        if trees is not None:
            self._set(trees=trees)

    def margins(self, x: np.ndarray) -> np.ndarray:
        told = json.loads(self.getOrDefault("trees"))
        return told["base"] + leaves_of(told["trees"], binned(x, [np.array(e) for e in told["edges"]]))

    def _transform(self, df: DataFrame) -> DataFrame:
        margins = self.margins

        @F.pandas_udf("double")
        def score(x: pd.Series) -> pd.Series:
            return pd.Series(margins(np.stack(x.tolist())) if len(x) else np.zeros(0), index=x.index)

        return df.withColumn(self.getPredictionCol(), (score(vector_to_array(F.col(self.getFeaturesCol()))) > 0).cast("double"))


class SecondOrderBoosting(Estimator, _Columns):
    """Trees grown level by level on histograms of the logistic loss's gradients and hessians over quantile bins.

    A level is one pass: each task sums its rows' gradients by node, feature and bin, and Spark sums those.  A leaf's value is
    ``-G / (H + shrink)`` times ``rate``; a split must gain more than ``cost`` and leave hessians of ``least`` on both sides.
    """

    rounds = Param(Params._dummy(), "rounds", "trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "levels of a tree", TypeConverters.toInt)
    bins = Param(Params._dummy(), "bins", "quantile bins of a feature at most", TypeConverters.toInt)
    rate = Param(Params._dummy(), "rate", "share of a leaf's value that counts", TypeConverters.toFloat)
    shrink = Param(Params._dummy(), "shrink", "added to hessians", TypeConverters.toFloat)
    cost = Param(Params._dummy(), "cost", "gain that a split must exceed", TypeConverters.toFloat)
    least = Param(Params._dummy(), "least", "hessian of a child at least", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, rounds=20, depth=6, bins=64, rate=0.3, shrink=1.0, cost=0.0, least=1.0, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(rounds=20, depth=6, bins=64, rate=0.3, shrink=1.0, cost=0.0, least=1.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> BoostedModel:
        rounds, depth, n_bins, rate, shrink, cost, least = (self.getOrDefault(n) for n in ("rounds", "depth", "bins", "rate", "shrink", "cost", "least"))
        rows = self._rows(df)
        width = rows.agg(F.max(F.size("x"))).first()[0] or 0
        # Quantiles of every feature in one pass, by place.
        cuts = [i / n_bins for i in range(1, n_bins)]
        found = rows.select(F.posexplode("x").alias("place", "v")).groupBy("place").agg(F.percentile_approx("v", cuts, 10_000).alias("q")).collect()  # features x bins numbers
        edges = [np.zeros(0)] * width
        for r in found:
            edges[r.place] = np.unique(r.q)

        def encode(batches):
            for b in batches:
                if b.num_rows:
                    x, y = _arrays(b)
                    yield pa.RecordBatch.from_arrays([pa.array(list(binned(x, edges).astype(np.int16)), pa.list_(pa.int16())), pa.array(y)], ["b", "y"])

        path = scratch(df.sparkSession)
        coded = rows.mapInArrow(encode, "b array<smallint>, y double")
        coded.write.parquet(path)
        coded = df.sparkSession.read.schema(coded.schema).parquet(path)
        mean = coded.agg(F.avg("y")).first()[0]
        share = min(max(0.5 if mean is None else mean, 1e-6), 1 - 1e-6)
        base, trees = float(np.log(share / (1 - share))), []
        for _ in range(rounds if width else 0):
            tree = {"feature": [-1], "cut": [0], "value": [0.0]}
            open_ = [0]
            for level in range(depth + 1):
                g, h = self._histograms(coded, trees, tree, base, open_, width, n_bins)
                gain, feature, cut = best_splits(g, h, shrink, cost, least)
                size = 2 ** (level + 2) - 1
                for name, empty in (("feature", -1), ("cut", 0), ("value", 0.0)):
                    tree[name] += [empty] * (size - len(tree[name]))
                deeper = []
                for i, node in enumerate(open_):
                    if level < depth and gain[i] > 0:
                        tree["feature"][node], tree["cut"][node] = int(feature[i]), int(cut[i])
                        deeper += [2 * node + 1, 2 * node + 2]
                    else:
                        tree["value"][node] = float(-rate * g[i, 0].sum() / (h[i, 0].sum() + shrink))
                open_ = deeper
                if not open_:
                    break
            trees.append(tree)
        told = {"base": base, "edges": [e.tolist() for e in edges], "trees": trees}
        return self._copyValues(BoostedModel(json.dumps(told)))

    @staticmethod
    def _histograms(coded: DataFrame, trees: list[dict], tree: dict, base: float, nodes: list[int], width: int, n_bins: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums of gradients and hessians by open node, feature and bin."""
        place = {n: i for i, n in enumerate(nodes)}

        def run(batches):
            sums = np.zeros((2, len(nodes) * width * n_bins))
            for batch in batches:
                if not batch.num_rows:
                    continue
                b, y = _arrays(batch)
                p = 1 / (1 + np.exp(-(base + leaves_of(trees, b))))
                at = np.zeros(len(b), np.int64)
                feature, cut = np.array(tree["feature"]), np.array(tree["cut"])
                while (inner := feature[at] >= 0).any():
                    go = b[np.arange(len(b)), np.maximum(feature[at], 0)] > cut[at]
                    at = np.where(inner, 2 * at + 1 + go, at)
                rank = np.array([place.get(k, -1) for k in range(len(feature))])[at]
                keep = rank >= 0
                key = ((rank[keep, None] * width + np.arange(width)) * n_bins + b[keep]).ravel()
                for s, v in zip(sums, (p - y, p * (1 - p)), strict=True):
                    s += np.bincount(key, np.repeat(v[keep], width), len(s))
            hit = np.flatnonzero((sums != 0).any(axis=0))
            yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(sums[0, hit]), pa.array(sums[1, hit])], ["key", "g", "h"])

        got = coded.mapInArrow(run, "key long, g double, h double").groupBy("key").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).toArrow()  # nodes x features x bins at most
        out = np.zeros((2, len(nodes) * width * n_bins))
        key = got["key"].to_numpy()
        out[0, key], out[1, key] = got["g"].to_numpy(), got["h"].to_numpy()
        return out[0].reshape(len(nodes), width, n_bins), out[1].reshape(len(nodes), width, n_bins)
