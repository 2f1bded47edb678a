"""BPE encoding and decoding with a contiguous rank array.

A text is cut by the tokenizer's pattern; each piece is a short word of bytes.  For a word the boundaries of its parts
and the rank of each part joined with its right neighbour are held side by side in one array, which is scanned for the
smallest rank; that boundary is deleted and the ranks of the two neighbours are found anew, until no joint part has a
rank.  The new words of a chunk of texts are done together, those of one length as the rows of one array; words of over
``LONGEST`` bytes one by one, and those of over ``LINKED`` bytes, for which moving an array would cost the square of
their length, with linked parts and a heap of ranks that gives the same parts.  Words that were met before are looked
up (at most ``CACHED`` of them are held, none of over ``LINKED`` bytes longer than for their chunk).

Cases: a null or empty text has no ids and decodes to the empty text; texts of any length are read whole, piece by
piece; a special token's string in a text is that token, as the tokenizers library has it by default; equal rows give
equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import importlib.util
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_chunks

CACHED = 400_000
LONGEST = 32
LINKED = 512
#: Bytes of text done together.
CHUNK = 1 << 22
NO_RANK = 1 << 30


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """The vocabulary's file: in the folder that ``OMENFLOW_TOKENIZERS`` names, else where ``public_tokenizers`` has it."""
    folder = os.environ.get("OMENFLOW_TOKENIZERS")
    if not folder and importlib.util.find_spec("public_tokenizers"):
        import public_tokenizers

        return str(public_tokenizers.path(name))
    return f"{folder or '/opt/tokenizers'}/{name}"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones themselves, others from 256 up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The parts of a word.  ``ranks``: of each joint part that may be made."""
    n = len(word)
    if n < 2:
        return [word] if word else []
    bounds = list(range(n + 1))
    get = ranks.get
    rank = [get(word[i : i + 2], NO_RANK) for i in range(n - 1)]
    while rank:
        least = min(rank)
        if least == NO_RANK:
            break
        i = rank.index(least)
        del bounds[i + 1]
        del rank[i]
        if i < len(rank):
            rank[i] = get(word[bounds[i] : bounds[i + 2]], NO_RANK)
        if i:
            rank[i - 1] = get(word[bounds[i - 1] : bounds[i + 1]], NO_RANK)
    return [word[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]


def merge_long_word(word: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """``merge_word`` in time that grows with ``n log n``: parts are linked, joints wait in a heap by rank, then place."""
    n = len(word)
    after, before = list(range(1, n + 2)), list(range(-1, n))  # a part is named by where it begins; n is the end
    get = ranks.get
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    alive = bytearray(b"\1" * n)
    while heap:
        _, i, end = heapq.heappop(heap)
        if not alive[i] or (k := after[i]) >= n or after[k] != end:  # one of the two parts has changed since
            continue
        alive[k] = 0
        after[i] = end
        if end < n:
            before[end] = i
            if (r := get(word[i : after[end]])) is not None:
                heapq.heappush(heap, (r, i, after[end]))
        if i and (r := get(word[before[i] : end])) is not None:
            heapq.heappush(heap, (r, before[i], end))
    return [word[i : after[i]] for i in range(n) if alive[i]]


class Codec(dict):
    """Maps a piece of text to its ids as little-endian 32-bit integers; ``encode`` and ``decode`` whole texts."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in self.special}
        ids = {raw(k): v for k, v in vocab.items()}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.ranks = {}
        for i, (a, b) in enumerate(pairs):
            self.ranks.setdefault(raw(a + b), i)
        self.four = {k: v.to_bytes(4, "little") for k, v in ids.items()}
        self.bytes_of = {v: k for k, v in ids.items()} | {v: k.encode() for k, v in self.special.items()}
        self.pieces = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
        self.splits = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self._pair_tables()
        super().__init__()

    def _pair_tables(self) -> None:
        """For pairs of part ids: sorted keys, ranks and the ids of the joint parts."""
        ids = {k: int.from_bytes(v, "little") for k, v in self.four.items()}
        self.first = np.array([ids[bytes([b])] for b in range(256)], np.int64)
        keys = {}
        for joint, rank in self.ranks.items():
            for cut in range(1, len(joint)):
                a, b = ids.get(joint[:cut]), ids.get(joint[cut:])
                if a is not None and b is not None:
                    keys[a << 20 | b] = (rank, ids[joint])
        order = sorted(keys)
        self.keys = np.array([*order, 1 << 62], np.int64)
        self.key_rank = np.array([*(keys[k][0] for k in order), NO_RANK], np.int64)
        self.key_id = np.array([*(keys[k][1] for k in order), 0], np.int64)

    def _ranked(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of adjacent parts, and where they stand in the tables; a part below 0 is none."""
        key = np.where((a < 0) | (b < 0), -1, a << 20 | b)
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.key_rank[at], NO_RANK), at

    def merge_rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge_word`` for words of one length, one a row of bytes: part ids, filled up with -1, and their number."""
        n, length = rows.shape
        parts = np.concatenate([self.first[rows], np.full((n, 2), -1)], axis=1)
        rank, at = self._ranked(parts[:, :-1], parts[:, 1:])
        left = np.arange(n)  # words that may still change
        columns = np.arange(length + 1)[None, :]
        out, count = parts[:, :length].copy(), np.full(n, length)
        while len(left):
            i = rank.argmin(axis=1)
            each = np.arange(len(left))
            done = rank[each, i] == NO_RANK
            if done.any():
                out[left[done]] = parts[done, :length]
                go = ~done
                left, parts, rank, at, i = left[go], parts[go], rank[go], at[go], i[go]
                each = np.arange(len(left))
                if not len(left):
                    break
            new = self.key_id[at[each, i]]
            # Delete the boundary: what stands right of it moves left by one.
            move = columns >= (i + 1)[:, None]
            parts[:, :-1] = np.where(move, parts[:, 1:], parts[:, :-1])
            rank[:, :-1] = np.where(move[:, :-1], rank[:, 1:], rank[:, :-1])
            at[:, :-1] = np.where(move[:, :-1], at[:, 1:], at[:, :-1])
            parts[each, i] = new
            # Refresh the ranks beside it.
            rank[each, i], at[each, i] = self._ranked(new, parts[each, i + 1])
            has = i > 0
            h, j = each[has], i[has] - 1
            rank[h, j], at[h, j] = self._ranked(parts[h, j], new[has])
            count[left] -= 1
        return out, count

    def learn(self, pieces) -> None:
        """Look-up entries for new pieces."""
        by_length: dict[int, list[tuple[str, bytes]]] = {}
        for p in pieces:
            raw = p.encode("utf-8")
            by_length.setdefault(len(raw), []).append((p, raw))
        for length, words in by_length.items():
            if not 2 <= length <= LONGEST:
                merge = merge_word if length <= LINKED else merge_long_word
                for p, raw in words:
                    self[p] = b"".join(map(self.four.__getitem__, merge(raw, self.ranks)))
                continue
            rows = np.frombuffer(b"".join(raw for _, raw in words), np.uint8).reshape(-1, length)
            out, count = self.merge_rows(rows)
            ids = out[out >= 0].astype("<u4").tobytes()
            ends = (np.cumsum(count) * 4).tolist()
            begin = 0
            for (p, _), end in zip(words, ends, strict=True):
                self[p] = ids[begin:end]
                begin = end

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        special = [s for s in self.special if any(s in t for t in texts)]
        cut = [[t] if not special else self.splits.split(t) for t in texts]
        found = [[None if p in self.special else self.pieces.findall(p) for p in parts] for parts in cut]
        new: set[str] = set()
        for parts in found:
            for p in parts:
                if p:
                    new.update(p)
        new.difference_update(self)
        if len(self) + len(new) > CACHED:  # those of this chunk are needed: all begin anew
            self.clear()
            new = {x for parts in found for p in parts if p for x in p}
        self.learn(new)
        get = self.__getitem__
        out = [b"".join([self.special[s].to_bytes(4, "little") if p is None else b"".join(map(get, p)) for s, p in zip(parts, ps, strict=True)]) for parts, ps in zip(cut, found, strict=True)]
        for p in [p for p in new if len(p) > LINKED]:
            del self[p]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One for each worker process, so that its words are kept from task to task."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(docs: DataFrame, text_col: str = "text", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """Adds the ids of each text as ``ids_col`` (binary: little-endian unsigned 32-bit integers) to its columns."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for whole in batches:
            for b in text_chunks(whole, text_col, CHUNK):
                texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
                ids = pa.array(c.encode_all([t or "" for t in texts]), pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns, ids], names=[*b.schema.names, ids_col])

    kept = docs.drop(ids_col)
    return kept.mapInArrow(run, kept.select("*", F.lit(None).cast("binary").alias(ids_col)).schema)


def decode(docs: DataFrame, ids_col: str = "ids", text_col: str = "decoded", path: str | None = None) -> DataFrame:
    """Adds the text of ``ids_col`` as ``text_col``; null ids give the empty text."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for whole in batches:
            for b in text_chunks(whole, ids_col, CHUNK):
                texts = pa.array([c.decode(x or b"") for x in b.column(b.schema.get_field_index(ids_col)).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([*b.columns, texts], names=[*b.schema.names, text_col])

    kept = docs.drop(text_col)
    return kept.mapInArrow(run, kept.select("*", F.lit(None).cast("string").alias(text_col)).schema)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """Encode and decode in one pass; only counts and digests leave the worker."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for whole in batches:
            for b in text_chunks(whole, "text", CHUNK):
                n, first, second = [], [], []
                for ids in c.encode_all([t or "" for t in b.column(1).to_pylist()]):
                    n.append(len(ids) // 4)
                    first.append(hashlib.sha256(ids).hexdigest())
                    second.append(hashlib.sha256(c.decode(ids).encode("utf-8")).hexdigest())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
