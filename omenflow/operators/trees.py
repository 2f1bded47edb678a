"""Trees over the tokens of sentences: the reach of subtrees, subtrees as single tokens, and graphs of what is said.

Any analyser gives the heads.  All work is by sentence, so that no task holds more than sentences.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def reaches(sentence: np.ndarray, pos: np.ndarray, head: np.ndarray, headed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last position below each token of many sentences at once; ``headed``: which tokens have a head.

    What is known of a token's nearest levels doubles with each round, so that rounds grow with the logarithm of the depth.
    """
    known, rank = np.unique(pos, return_inverse=True)
    keys, node = np.unique(sentence * len(known) + rank, return_inverse=True)
    # Of tokens that share a position the smallest head counts.
    least = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(least, node[headed], head[headed])
    at = known[keys % len(known)]
    place = np.minimum(np.searchsorted(known, least), len(known) - 1)
    asked = keys - keys % len(known) + place
    found = np.minimum(np.searchsorted(keys, asked), len(keys) - 1)
    up = np.where((known[place] == least) & (keys[found] == asked) & (least != at), found, -1)
    first, last = at.copy(), at.copy()
    longest = int(np.bincount(keys // len(known)).max())
    for _ in range(longest.bit_length() + 1):
        below = up >= 0
        if not below.any():
            break
        to, low, high = up[below], first[below], last[below]
        np.minimum.at(first, to, low)
        np.maximum.at(last, to, high)
        up = np.where(below, up[up], -1)
    if (up >= 0).any():
        raise ValueError("the heads of a sentence go round in a circle")
    return first[node], last[node]


def _reaches(pos: pa.Array, head: pa.Array) -> pa.Array:
    sizes = np.diff(pos.offsets.to_numpy())
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    p, h = pos.flatten(), head.flatten()
    there, headed = np.asarray(p.is_valid()), np.asarray(h.is_valid())
    place, up = p.fill_null(0).to_numpy(zero_copy_only=False), h.fill_null(0).to_numpy(zero_copy_only=False)
    out = [np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)]
    if there.any():
        for o, x in zip(out, reaches(sentence[there], place[there], up[there], headed[there]), strict=True):
            o[there] = x
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(offsets, pa.array(o, mask=~there)) for o in out], ["first", "last"])


def _edges(heads: pa.Array) -> pa.Array:
    sizes = np.diff(heads.offsets.to_numpy())
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    flat = heads.flatten()
    out = [np.zeros(0, np.int64)] * 2
    if len(flat):
        place = np.arange(len(flat)) - offsets[sentence]
        out = reaches(sentence, place, flat.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), np.asarray(flat.is_valid()))
    lists = offsets.astype(np.int32)
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(lists, pa.array(o.astype(np.int32))) for o in out], ["first", "last"])


def sentence_edges(sentences: DataFrame, heads: str = "heads") -> DataFrame:
    """Adds ``first_pos`` and ``last_pos``, arrays like ``heads``: for each token what ``subtree_edges`` tells.

    A row is a sentence, and ``heads`` has each token's head as a position from 0, so that no row is moved.  A null array is
    an empty one.
    """
    held = F.coalesce(F.col(heads), F.array().cast(sentences.schema[heads].dataType))
    reached = sentences.withColumn("_r", F.arrow_udf(_edges, "first array<int>, last array<int>")(held))
    return reached.withColumns({f"{n}_pos": F.col(f"_r.{n}") for n in ("first", "last")}).drop("_r")


def _units(terms: pa.Array, heads: pa.Array, first: pa.Array, last: pa.Array, chosen: pa.Array) -> pa.Array:
    sizes = np.diff(heads.offsets.to_numpy())
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    n = offsets[-1]
    begin, size, at = np.repeat(offsets[:-1], sizes), np.repeat(sizes, sizes), np.arange(n)
    flat = heads.flatten()
    head = flat.fill_null(-1).to_numpy(zero_copy_only=False)
    linked = (head >= 0) & (head < size) & (head + begin != at)
    span = chosen.flatten().fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
    # Neighbours that a chosen subtree covers are in one token.
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first.flatten().to_numpy(zero_copy_only=False)[span] + begin[span], 1)
    np.add.at(steps, last.flatten().to_numpy(zero_copy_only=False)[span] + begin[span], -1)
    opens = np.ones(n, bool)
    opens[1:] = np.cumsum(steps)[: max(n - 1, 0)] <= 0
    unit = np.cumsum(opens) - 1
    starts = np.flatnonzero(opens)
    to = np.where(linked, unit[np.where(linked, head + begin, 0)], -1) if n else at
    outer = np.flatnonzero(~linked | (to != unit))
    lead = np.full(len(starts), n)
    np.minimum.at(lead, unit[outer], outer)
    per = np.concatenate([[0], np.cumsum(opens)])[offsets]
    base = np.repeat(per[:-1], np.diff(per))
    words = terms.flatten()
    held = np.diff(terms.offsets.to_numpy())
    if not np.array_equal(held, sizes):  # a sentence without heads, or with more of them than terms
        from_ = np.repeat(np.concatenate([[0], np.cumsum(held)])[:-1], sizes) + at - begin
        words = words.take(pa.array(from_, mask=at - begin >= np.repeat(held, sizes)))
    there = np.concatenate([[0], np.cumsum(np.asarray(words.is_valid()))])
    text = pc.binary_join(pa.ListArray.from_arrays(there[np.append(starts, n)].astype(np.int32), words.drop_null()), " ")
    cols = [pa.array((np.arange(len(starts)) - base).astype(np.int32)), text, pa.array(np.diff(np.append(starts, n))), pa.array((to[lead] - base).astype(np.int32), mask=~linked[lead])]
    return pa.ListArray.from_arrays(per.astype(np.int32), pa.StructArray.from_arrays(cols, ["place", "term", "n", "head"]))


def merged_in_sentences(sentences: DataFrame, chosen: Column, terms: str = "terms", heads: str = "heads") -> DataFrame:
    """What ``merged_subtrees`` gives, as arrays of rows that are sentences: adds ``merged``, ``place, term, n, head`` of each token.

    ``sentences`` with ``first_pos`` and ``last_pos`` of ``sentence_edges``; ``chosen`` is an array of booleans.  No row is moved.
    """
    told = F.arrow_udf(_units, "array<struct<place int, term string, n bigint, head int>>")
    return sentences.withColumn("merged", told(terms, heads, "first_pos", "last_pos", chosen))


def heads_by_length(words: Column, bounds: tuple[int, ...] = (8, 12)) -> Column:
    """Heads that stand in for a parser's: words are classed by letters, and a head is the next word of a higher class."""

    def run(lengths: pa.Array) -> pa.Array:
        sizes = np.diff(lengths.offsets.to_numpy())
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        kind = np.searchsorted(bounds, lengths.flatten().to_numpy(zero_copy_only=False), side="right")
        n = len(kind)
        head = np.full(n, n)
        for c in range(len(bounds)):
            after = np.minimum.accumulate(np.where(kind > c, np.arange(n), n)[::-1])[::-1]
            head = np.where(kind == c, np.append(after[1:], n), head)
        begin, end = np.repeat(offsets[:-1], sizes), np.repeat(offsets[1:], sizes)
        return pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array((head - begin).astype(np.int32), mask=head >= end))

    return F.arrow_udf(run, "array<int>")(F.transform(F.coalesce(words, F.array().cast("array<string>")), lambda w: F.coalesce(F.length(w), F.lit(0))))


def subtree_edges(tokens: DataFrame, group: list[str], pos: str = "pos", head: str = "head") -> DataFrame:
    """Adds ``first_pos`` and ``last_pos``: the outermost positions of all tokens below each token, itself included.

    ``group`` names a sentence, which is one row while it is worked on; ``head`` is the position of a token's head.  A token
    whose head is null, its own position or no position of the sentence is a root.  Tokens are moved once.

    Cases: null sentences are one sentence; tokens without a position take no part and get nulls; of tokens that share
    a position the smallest head counts; heads that go round in a circle are an error; an empty table gives an empty result.
    """
    row = F.struct(F.col(pos).cast("long").alias("_p"), F.col(head).cast("long").alias("_h"), F.struct(*tokens.columns).alias("_row"))
    sentences = tokens.groupBy(F.struct(*group).alias("_g")).agg(F.collect_list(row).alias("_t"))
    told = F.arrow_udf(_reaches, "first array<bigint>, last array<bigint>")
    reached = sentences.select("_t", told(F.col("_t._p"), F.col("_t._h")).alias("_r"))
    each = reached.select(F.inline(F.arrays_zip(F.col("_t._row").alias("row"), F.col("_r.first").alias("first_pos"), F.col("_r.last").alias("last_pos"))))
    kind = tokens.schema[pos].dataType
    return each.select("row.*", F.col("first_pos").cast(kind).alias("first_pos"), F.col("last_pos").cast(kind).alias("last_pos"))


def merged_subtrees(tokens: DataFrame, group: list[str], chosen: Column, pos: str = "pos", head: str = "head", term: str = "term") -> DataFrame:
    """``group, place, term, n, head``: sentences in which the chosen tokens' subtrees, from first to last position, are single tokens.

    A merged token's text is its tokens' by single spaces, its head that of the first of them whose head lies outside; spans
    that overlap become one.  Places count from 0 and heads are places, null for roots.  ``tokens`` with ``first_pos`` and ``last_pos``.
    """
    rows = tokens.where(F.col(pos).isNotNull()).select(F.struct(*group).alias("_g"), F.col(pos).alias("_p"), F.col(head).alias("_up"), F.col(term).alias("_t"), chosen.alias("_c"), F.col("first_pos").alias("_lo"), F.col("last_pos").alias("_hi"))
    # Overlapping spans as one: a span begins where none before it reaches so far.
    order = Window.partitionBy("_g").orderBy("_lo", "_hi")
    spans = rows.where("_c").select("_g", "_lo", "_hi").distinct().withColumn("_before", F.max("_hi").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    opens = (F.col("_before").isNull() | (F.col("_lo") > F.col("_before"))).cast("int")
    spans = spans.withColumn("_k", F.sum(opens).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = spans.groupBy("_g", "_k").agg(F.struct(F.min("_lo").alias("lo"), F.max("_hi").alias("hi")).alias("_s"))
    # The last span that began at or before a token holds it, if it reaches so far.
    run = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)
    held = rows.join(spans.select("_g", F.col("_s.lo").alias("_p"), "_s"), ["_g", "_p"], "left").withColumn("_s", F.last("_s", ignorenulls=True).over(run))
    unit = F.when(F.col("_p") <= F.col("_s.hi"), F.col("_s.lo")).otherwise(F.col("_p"))
    placed = held.withColumn("_unit", unit).withColumn("place", F.dense_rank().over(Window.partitionBy("_g").orderBy("_unit")) - 1)
    heads = placed.select("_g", F.col("_p").alias("_up"), F.col("place").alias("_to")).distinct()
    linked = placed.join(heads, ["_g", "_up"], "left")
    outside = F.when(F.col("_to").isNull() | (F.col("_to") != F.col("place")) | (F.col("_up") == F.col("_p")), F.struct(F.col("_p"), F.when(F.col("_to") != F.col("place"), F.col("_to")).alias("to")))
    out = linked.groupBy("_g", "place").agg(F.array_sort(F.collect_list(F.struct("_p", "_t"))).alias("_ts"), F.count("*").alias("n"), F.min(outside).alias("_h"))
    return out.select("_g.*", "place", F.array_join(F.transform("_ts", lambda x: x["_t"]), " ").alias("term"), "n", F.col("_h.to").alias("head"))


#: What a sentence's edges are made of: a part of speech and which of its tokens.
ROLES = {"source": ("PROPN", 1), "relation": ("VERB", 1), "outcome": ("NOUN", 1), "target": ("PROPN", 3)}


def relation_edges(tokens: DataFrame, group: list[str], pos: str = "pos", tag: str = "tag", term: str = "term", roles: dict[str, tuple[str, int]] = ROLES) -> DataFrame:
    """``a, b, relation``: the graph's edges from a sentence's source to its outcome, and from there to its target.

    Each edge once; of several sentences' relations the last one's, in the order of ``group``.  An edge without one of its
    ends is left out; one to a target has no relation.
    """
    asked = tokens.where(F.col(tag).isin(*{t for t, _ in roles.values()}))
    n = F.row_number().over(Window.partitionBy(*group, tag).orderBy(pos))
    ranked = asked.select(*group, F.col(tag).alias("_tag"), F.col(term).alias("_term"), n.alias("_n"))
    pick = [F.max(F.when((F.col("_tag") == t) & (F.col("_n") == k), F.col("_term"))).alias(role) for role, (t, k) in roles.items()]
    wide = ranked.groupBy(*group).agg(*pick).withColumn("_at", F.struct(*group))
    first = wide.select("_at", F.lit(0).alias("_step"), F.col("source").alias("a"), F.col("outcome").alias("b"), "relation")
    second = wide.select("_at", F.lit(1).alias("_step"), F.col("outcome").alias("a"), F.col("target").alias("b"), F.lit(None).cast("string").alias("relation"))
    edges = first.unionByName(second).where("a is not null and b is not null")
    told = F.when(F.col("relation").isNotNull(), F.struct("_at", "relation"))
    return edges.groupBy("a", "b").agg(F.max(told).alias("_r")).select("a", "b", F.col("_r.relation").alias("relation"))
