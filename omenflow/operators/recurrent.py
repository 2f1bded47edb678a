"""A recurrent classifier of texts over their bytes, learned by back-propagation through time in data-parallel epochs.

In an epoch each partition goes through its windows from the same parameters; a Spark aggregate averages what the partitions
end with, by their numbers of windows.  Texts of any length are cut into windows of ``WIDTH`` bytes, all of which count: in training
each with its text's label, in prediction by the mean of their log probabilities.  What is moved has the model's size.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.writers import scratch

WIDTH = 64
BATCH = 32
#: Windows that are predicted at once, of as many texts as they come from; texts whose windows are held at once.
TOLD = 256


class Network:
    """``h = tanh(into[byte] + h @ over + bias)`` over a window, then a softmax of ``h @ out + last``."""

    def __init__(self, classes: int, hidden: int = 32, seed: int = 1, flat: np.ndarray | None = None):
        self.shapes = {"into": (256, hidden), "over": (hidden, hidden), "bias": (hidden,), "out": (hidden, classes), "last": (classes,)}
        size = sum(int(np.prod(s)) for s in self.shapes.values())
        if flat is None:
            rng = np.random.Generator(np.random.PCG64(seed))
            flat = rng.normal(size=size) * 0.1
        self.flat = np.array(flat, np.float64)
        self.at = self.views(self.flat)

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, begin = {}, 0
        for name, shape in self.shapes.items():
            n = int(np.prod(shape))
            out[name] = flat[begin : begin + n].reshape(shape)
            begin += n
        return out

    def forward(self, x: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """States (steps + 1 x rows x hidden; a row keeps its state after its end) and log probabilities."""
        p, shortest = self.at, int(length.min(initial=x.shape[1]))
        states = np.zeros((x.shape[1] + 1, len(x), p["over"].shape[0]))
        met = np.take(p["into"] + p["bias"], x.T, axis=0)
        for t in range(x.shape[1]):
            now = np.dot(states[t], p["over"], out=states[t + 1])
            now += met[t]
            np.tanh(now, out=now)
            if t >= shortest:
                now[t >= length] = states[t][t >= length]
        z = states[-1] @ p["out"] + p["last"]
        z = z - z.max(axis=1, keepdims=True)
        return states, z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def gradient(self, x: np.ndarray, length: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        """Mean loss of the rows and its gradient."""
        states, logs = self.forward(x, length)
        flat = np.zeros_like(self.flat)
        g, n = self.views(flat), len(x)
        out, back_over = (np.ascontiguousarray(self.at[k].T) for k in ("out", "over"))
        d = np.exp(logs)
        d[np.arange(n), y] -= 1
        d /= n
        g["out"][...] = states[-1].T @ d
        g["last"][...] = d.sum(axis=0)
        # The loop has what one step needs of the next; sums over rows and steps are made once.
        back, shortest = d @ out, int(length.min(initial=x.shape[1]))
        raw = np.multiply(states[1:], states[1:])
        np.subtract(1, raw, out=raw)
        for t in range(x.shape[1] - 1, -1, -1):
            raw[t] *= back
            if t < shortest:
                back = np.dot(raw[t], back_over)
            else:
                raw[t][t >= length] = 0.0
                back = np.where((t < length)[:, None], np.dot(raw[t], back_over), back)
        rows = raw.reshape(-1, raw.shape[2])
        g["over"][...] = states[:-1].reshape(rows.shape).T @ rows
        g["bias"][...] = rows.sum(axis=0)
        order = np.argsort(x.T.astype(np.uint8), axis=None, kind="stable")
        of = x.T.ravel()[order]
        begins = np.flatnonzero(np.diff(of.astype(np.int64), prepend=-1))
        g["into"][of[begins]] = np.add.reduceat(rows[order], begins, axis=0)
        return float(-logs[np.arange(n), y].mean()), flat


def windows(text: str, width: int = WIDTH) -> list[bytes]:
    """All of a text's bytes in windows of nearly equal lengths; an empty text is one empty window."""
    raw = text.encode("utf-8", "surrogatepass")
    n = max(1, -(-len(raw) // width))
    edges = [len(raw) * i // n for i in range(n + 1)]
    return [raw[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def padded(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Windows as rows of bytes, and their lengths."""
    length = np.array([len(p) for p in parts], np.int64)
    x = np.zeros((len(parts), max(1, int(length.max(initial=0)))), np.uint8)
    x[np.arange(x.shape[1]) < length[:, None]] = np.frombuffer(b"".join(parts), np.uint8)
    return x, length


def one_epoch(flat: np.ndarray, classes: int, hidden: int, parts: list[bytes], labels: list[int], rate: float, seed: int) -> np.ndarray:
    """Steps over batches of shuffled windows, each parameter's by the root of its squared gradients so far."""
    net = Network(classes, hidden, flat=flat.copy())
    seen = np.full_like(net.flat, 1e-8)
    order = np.random.Generator(np.random.PCG64(seed)).permutation(len(parts))
    y = np.array(labels)
    x, length = padded(parts)
    for i in range(0, len(order), BATCH):
        pick = order[i : i + BATCH]
        _, g = net.gradient(x[pick, : max(1, length[pick].max())], length[pick], y[pick])
        norm = np.linalg.norm(g)
        g *= min(1.0, 5.0 / max(norm, 1e-12))
        seen += g * g
        net.flat -= rate * g / np.sqrt(seen)
    return net.flat


class RecurrentClassifier:
    def __init__(self, classes: list, network: Network):
        self.classes, self.network = classes, network

    @classmethod
    def fit(cls, rows: DataFrame, text: str, label: str, epochs: int = 5, hidden: int = 32, rate: float = 0.05, parts: int | None = None, seed: int = 1) -> RecurrentClassifier:
        """Learn from rows whose label isn't null; a null text is empty.  ``parts``: learners that are averaged."""
        spark = rows.sparkSession
        parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
        known = rows.where(F.col(label).isNotNull()).select(F.coalesce(text, F.lit("")).alias("text"), F.col(label).alias("label"))
        path = scratch(spark)
        known.write.parquet(path)
        known = spark.read.schema(known.schema).parquet(path)
        classes = sorted(r.label for r in known.select("label").distinct().collect())  # a label set is small
        number = {c: i for i, c in enumerate(classes)}
        net = Network(max(1, len(classes)), hidden, seed)
        dealt = known.repartition(parts, F.xxhash64("text")).sortWithinPartitions(F.xxhash64("text"))
        for epoch in range(epochs if classes else 0):
            flat, size = net.flat, len(net.flat)

            def run(batches, flat=flat, size=size, epoch=epoch):
                from pyspark import TaskContext

                held, labels = [], []
                for b in batches:
                    for t, y in zip(*(c.to_pylist() for c in b.columns), strict=True):
                        cut = windows(t)
                        held += cut
                        labels += [number[y]] * len(cut)
                if held:
                    got = one_epoch(flat, len(classes), hidden, held, labels, rate, epoch * 100_003 + TaskContext.get().partitionId())
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(np.full(size, len(held))), pa.array(got * len(held))], ["place", "n", "w"])

            mixed = dealt.mapInArrow(run, "place long, n long, w double").groupBy("place").agg((F.sum("w") / F.sum("n")).alias("w")).orderBy("place").toArrow()  # a row a parameter
            net = Network(len(classes), hidden, flat=mixed["w"].to_numpy())
        return cls(classes, net)

    def predict(self, rows: DataFrame, text: str, label_column: str = "predicted") -> DataFrame:
        """Adds the likeliest label and ``score``, its probability by the mean over all of a text's windows."""
        sent = rows.sparkSession.sparkContext.broadcast((self.classes, self.network.flat, self.network.shapes["bias"][0]))
        kind = "string" if self.classes and isinstance(self.classes[0], str) else "long"

        def run(batches):
            classes, flat, hidden = sent.value
            net = Network(len(classes), hidden, flat=flat)
            for b in (whole.slice(i, TOLD) for whole in batches for i in range(0, max(1, whole.num_rows), TOLD)):
                labels, scores, sums = [], [], np.zeros((b.num_rows, len(classes)))
                cuts = [windows(t or "") for t in b.column(b.schema.get_field_index(text)).to_pylist()]
                all_, of = [w for cut in cuts for w in cut], np.repeat(np.arange(len(cuts)), [len(cut) for cut in cuts])
                for i in range(0, len(all_), TOLD):
                    np.add.at(sums, of[i : i + TOLD], net.forward(*padded(all_[i : i + TOLD]))[1])
                for cut, logs in zip(cuts, sums, strict=True):
                    logs = logs / len(cut)
                    p = np.exp(logs - logs.max())
                    labels.append(classes[int(p.argmax())])
                    scores.append(float(p.max() / p.sum()))
                yield b.append_column(label_column, pa.array(labels, pa.string() if kind == "string" else pa.int64())).append_column("score", pa.array(scores, pa.float64()))

        from pyspark.sql.types import DoubleType, LongType, StringType, StructType

        schema = StructType([*rows.schema.fields]).add(label_column, StringType() if kind == "string" else LongType()).add("score", DoubleType())
        return rows.mapInArrow(run, schema)

    def save(self, spark: SparkSession, folder: str) -> None:
        told = {"classes": self.classes, "hidden": self.network.shapes["bias"][0], "flat": self.network.flat.tolist()}
        spark.createDataFrame([(json.dumps(told),)], "value string").coalesce(1).write.mode("overwrite").text(folder)

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> RecurrentClassifier:
        told = json.loads(spark.read.text(folder).first()[0])
        return cls(told["classes"], Network(len(told["classes"]), told["hidden"], flat=np.array(told["flat"])))
