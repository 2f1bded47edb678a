"""Language identification by a bidirectional gated recurrent network over bytes, in numpy.

Each text is read whole, in windows of ``WINDOW`` bytes; two gated recurrent layers run over a window, one each way,
and label every position with log-odds for each language.  A document's probabilities are those of the mean log-odds
over all of its positions.  The network is trained by backpropagation through time (Adam) on windows of a bounded sample
of labelled documents: about ``SAMPLE`` a language (the share of them, by hashes of ids, that makes that many; all where
there are fewer), and ``WINDOWS_EACH`` windows of each at hashed places of the whole text.  A text that is shorter
than a window is learned as a window of its own length: positions beyond its end have no state and no error.

Cases: a null text, or one without any letter, is ``und`` with score 0; very short texts are one short window, in training too; equal
texts get equal results; with no labelled text at all every text is ``und``; with one language each text with a letter
gets it; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrays import utf8
from .common import fold, table, text_chunks

UNKNOWN = "und"
HIDDEN = 8
WINDOW = 64
#: Labelled documents for each language (expected), and windows of each.
SAMPLE = 400
#: Hashes of ids fall evenly into this range.
RANGE = 1 << 40
WINDOWS_EACH = 12
STEPS = 700
BATCH = 256
#: Rows of windows that one step of the network handles.
ROWS = 8192

Model = dict[str, np.ndarray]


def new_model(languages: list[str], hidden: int = HIDDEN, seed: int = 7) -> Model:
    rng = np.random.Generator(np.random.PCG64(seed))
    model: Model = {}
    for way in "fb":
        model[f"{way}x"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)  # a byte's share in the gates
        model[f"{way}h"] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)
        model[f"{way}o"] = rng.normal(0, 0.3, (hidden, len(languages))).astype(np.float32)
    model["o"] = np.zeros(len(languages), np.float32)
    return model


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place: half a tanh is cheaper than an exponential and a division."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


def run_way(model: Model, way: str, windows: np.ndarray, keep: list | None = None, inside: np.ndarray | None = None) -> np.ndarray:
    """The states of one direction, in the order in which they are made: (length, rows, hidden).

    ``inside`` (length, rows, 1) is 1 where a position is part of the text; elsewhere the state is 0.

    Gates: update z, reset r, candidate c; h' = h + z (c - h), with r on the recurrent part of c.
    """
    gates, recur = model[f"{way}x"], model[f"{way}h"]
    n = recur.shape[0]
    rows, length = windows.shape
    out = np.empty((length, rows, n), recur.dtype)
    h = np.zeros((rows, n), recur.dtype)
    for t in range(length) if way == "f" else range(length - 1, -1, -1):
        a = gates[windows[:, t]]
        b = h @ recur
        zr = a[:, : 2 * n] + b[:, : 2 * n]
        _sigmoid(zr)
        z, r = zr[:, :n], zr[:, n:]
        c = b[:, 2 * n :] * r
        c += a[:, 2 * n :]
        np.tanh(c, out=c)
        if keep is not None:
            keep.append((t, h, z, r, c, b[:, 2 * n :]))
        new = out[t]
        np.subtract(c, h, out=new)
        new *= z
        new += h
        if inside is not None:
            new *= inside[t]
        h = new
    return out


def log_odds(model: Model, windows: np.ndarray) -> np.ndarray:
    """For every position: (length, rows, languages)."""
    return run_way(model, "f", windows) @ model["fo"] + run_way(model, "b", windows) @ model["bo"] + model["o"]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def gradients(model: Model, x: np.ndarray, want: np.ndarray, inside: np.ndarray | None = None) -> tuple[float, Model]:
    """The loss of some windows and its gradient, by backpropagation through time.

    Half of the loss is the mean cross-entropy of a window's positions, half that of its mean log-odds.
    """
    n = model["fh"].shape[0]
    kept: dict[str, list] = {"f": [], "b": []}
    states = {w: run_way(model, w, x, kept[w], inside) for w in "fb"}
    odds = states["f"] @ model["fo"] + states["b"] @ model["bo"] + model["o"]
    length, rows, k = odds.shape
    each = np.full((rows, 1), length, odds.dtype) if inside is None else inside.sum(axis=0)
    mean = (odds if inside is None else odds * inside).sum(axis=0) / each
    p, q = softmax(odds), softmax(mean)
    error = (0.5 * (p - want) + 0.5 * (q - want)[None]) / (each * rows)
    tiny = np.finfo(odds.dtype).tiny
    losses = -np.log(np.maximum((p * want).sum(axis=-1), tiny))
    if inside is not None:
        error *= inside
        losses = losses * inside[:, :, 0]
    loss = float((0.5 * losses.sum(axis=0) / each[:, 0] - 0.5 * np.log(np.maximum((q * want).sum(axis=-1), tiny))).mean())
    grad = {"o": error.sum(axis=(0, 1))}
    for w in "fb":
        grad[f"{w}o"] = states[w].reshape(-1, n).T @ error.reshape(-1, k)
        gh, shares = np.zeros_like(model[f"{w}h"]), np.empty((length, rows, 3 * n), odds.dtype)
        back = np.zeros((rows, n), odds.dtype)
        for t, h, z, r, c, bc in reversed(kept[w]):
            d = back + error[t] @ model[f"{w}o"].T
            if inside is not None:
                d *= inside[t]
            dc = d * z * (1 - c * c)
            dz = d * (c - h) * z * (1 - z)
            dr = dc * bc * r * (1 - r)
            da = shares[t]
            da[:, :n], da[:, n : 2 * n], da[:, 2 * n :] = dz, dr, dc
            db = np.concatenate([dz, dr, dc * r], axis=1)
            gh += h.T @ db
            back = d * (1 - z) + db @ model[f"{w}h"].T
        # Each byte's shares are summed over all places at once.
        at = x.T.ravel()
        sums = [np.bincount(at, column, len(model[f"{w}x"])) for column in np.ascontiguousarray(shares.reshape(-1, 3 * n).T)]
        grad[f"{w}x"], grad[f"{w}h"] = np.stack(sums, axis=1).astype(odds.dtype), gh
    return loss, grad


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH, seed: int = 7, rate: float = 0.02, lengths: np.ndarray | None = None) -> Model:
    """Every position of a window is trained to give its document's label, and so is the window's mean.

    ``lengths`` of windows, where some are shorter than the others and filled up.
    """
    model = new_model(languages, hidden, seed)
    rng = np.random.Generator(np.random.PCG64(seed + 1))
    first = {k: np.zeros_like(v) for k, v in model.items()}
    second = {k: np.zeros_like(v) for k, v in model.items()}
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(windows), min(batch, len(windows)))
        x, want = windows[pick], np.eye(len(languages), dtype=np.float32)[labels[pick]]
        inside = None if lengths is None else (np.arange(x.shape[1])[:, None] < lengths[pick]).astype(np.float32)[:, :, None]
        _, grad = gradients(model, x, want, inside)
        norm = float(np.sqrt(sum((g.astype(np.float64) ** 2).sum() for g in grad.values())))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for k, g in grad.items():
            g = g / max(1.0, norm)
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            model[k] = (model[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def document_odds(model: Model, raw: np.ndarray, at: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The mean log-odds over all positions of each row; whole texts, in windows of about equal lengths."""
    sizes = np.diff(at)
    languages = len(model["o"])
    total = np.zeros((len(sizes), languages), np.float64)
    # A text of n bytes has ceil(n / window) windows whose lengths differ by one at most.
    count = -(-sizes // window)
    owner = np.repeat(np.arange(len(sizes)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    of = sizes[owner]
    many = count[owner]
    begin = number * of // np.maximum(many, 1)
    length = (number + 1) * of // np.maximum(many, 1) - begin
    begin += at[owner]
    order = np.argsort(length, kind="stable")
    for lo in range(0, len(order), ROWS):
        for same in np.split(part := order[lo : lo + ROWS], np.flatnonzero(np.diff(length[part])) + 1):
            m = int(length[same[0]])
            odds = log_odds(model, raw[begin[same, None] + np.arange(m)]).sum(axis=0)
            np.add.at(total, owner[same], odds)
    return total / np.maximum(sizes, 1)[:, None]


def labelled_windows(docs: DataFrame, sample: int = SAMPLE, each: int = WINDOWS_EACH, window: int = WINDOW) -> DataFrame:
    """``lang, bytes`` of training windows (shorter texts whole); ``docs`` has ``doc_id, text, lang`` of the rows that may be learned from."""
    hashed = docs.where("lang is not null and text is not null and text rlike '\\\\p{L}'").select("lang", "text", F.xxhash64("doc_id", F.lit(11)).alias("key"))
    sizes = {r.lang: r.n for r in hashed.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    # A language's share of its hashes' range; rows beyond it are dropped where they are read.
    shares = [F.lit(x) for lang, n in sizes.items() for x in (lang, min(RANGE, RANGE * sample // n))]
    near = hashed.where(F.pmod("key", F.lit(RANGE)) < F.create_map(*shares)[F.col("lang")]) if shares else hashed.where(F.lit(False))
    chosen = near.groupBy("lang", "key").agg(F.min("text").alias("text"))  # rows that repeat an id count once

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lang, out = [], []
            for name, text, key in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = text.encode("utf-8")
                rng = np.random.Generator(np.random.PCG64(key % (1 << 62)))
                for _ in range(each):
                    at = int(rng.integers(0, max(1, len(data) - window + 1)))
                    lang.append(name)
                    out.append(data[at : at + window])  # a shorter text whole
            yield pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(out, pa.binary())], names=["lang", "bytes"])

    return chosen.select("lang", "text", "key").mapInArrow(cut, "lang string, bytes binary")


def fit(docs: DataFrame, sample: int = SAMPLE, steps: int = STEPS) -> tuple[Model | None, list[str]]:
    rows = sorted((r.lang, bytes(r.bytes)) for r in labelled_windows(docs, sample).collect())  # bounded by the sample
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None, []
    lengths = np.array([len(r[1]) for r in rows])
    width = int(lengths.max())
    windows = np.frombuffer(b"".join(r[1].ljust(width, b"\0") for r in rows), np.uint8).reshape(len(rows), width)
    labels = np.array([languages.index(r[0]) for r in rows])
    # Each language has the same weight, however many of its documents were found.
    most = np.bincount(labels).max()
    even = np.concatenate([np.resize(np.flatnonzero(labels == k), most) for k in range(len(languages))])
    return train(windows[even], labels[even], languages, steps=steps, lengths=None if lengths.min() == width else lengths[even]), languages


def predict(docs: DataFrame, model: Model | None, languages: list[str], id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; with ``keep``, those columns of the input and ``lang_pred, score``."""
    held = docs.sparkSession.sparkContext.broadcast(model)  # some kilobytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in text_chunks(whole, "_text", 1 << 22):
                text = b.column(b.num_columns - 1)
                letter = pc.fill_null(pc.match_substring_regex(text, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                if held.value is None:
                    names, score = [UNKNOWN] * len(b), np.zeros(len(b))
                else:
                    p = softmax(document_odds(held.value, *utf8(text)))
                    best = p.argmax(axis=1)
                    names = [languages[k] if x else UNKNOWN for k, x in zip(best.tolist(), letter.tolist(), strict=True)]
                    score = np.where(letter, p.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(names, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names[:-1], "lang_pred", "score"])

    kept = [F.col(c) for c in keep if c not in ("lang_pred", "score")] if keep else [F.col(id_col).alias("doc_id")]
    rows = docs.select(*kept, F.col(text_col).alias("_text"))
    schema = rows.drop("_text").select("*", F.lit("").cast("string").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Learn from the rows whose fold isn't 0 and predict every row."""
    model, languages = fit(docs.where(fold(F.col("doc_id")) != 0).select("doc_id", "text", "lang"))
    return predict(docs, model, languages, keep=keep)


def op5_byte_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = identify(table(spark, sf_dir, "documents"))
    return out.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score")
