"""Strings within an edit distance of each other, by an index of what is left of them after deletions."""

from __future__ import annotations

import math
import os.path
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the index that a task gets, about.
TASK_ROWS = 1 << 18
#: Stands for a character that may be another one.
MASK = "\0"


def deletions(text: Column, most: int) -> Column:
    """The distinct strings that are left of a string when up to ``most`` of its characters are deleted, itself first."""
    out = F.array(text)
    last = out
    for _ in range(most):
        fewer = lambda s: F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(s), F.lit(1))), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.char_length(s))))
        last = F.array_distinct(F.flatten(F.transform(last, fewer)))
        out = F.array_distinct(F.concat(out, last))
    return out


def masks(text: Column, most: int) -> Column:
    """A string with ``most`` of its characters masked, for each choice of places: ``left``, and ``gone``, the characters that were there."""
    out = F.array(F.struct(text.alias("left"), F.lit("").alias("gone"), F.lit(0).alias("at")))
    for _ in range(most):
        places = lambda m: F.filter(F.sequence(F.lit(1), F.greatest(F.char_length(m["left"]), F.lit(1))), lambda i: (i > m["at"]) & (i <= F.char_length(m["left"])))
        hide = lambda m, i: F.struct(F.overlay(m["left"], F.lit(MASK), i, F.lit(1)).alias("left"), F.concat(m["gone"], F.substring(m["left"], i, F.lit(1))).alias("gone"), i.alias("at"))
        out = F.flatten(F.transform(out, lambda m: F.transform(places(m), lambda i: hide(m, i))))
    return out


def near_names(df: DataFrame, name: str, most: int = 2) -> DataFrame:
    """``name_1, name_2, distance``: pairs of distinct names, the smaller first, at most ``most`` edits apart.

    Two strings are that near only if some string is left of both after that many deletions each, and only where ``most``
    characters are replaced does it take as many in both: these pairs agree in all places but those.  So strings with ``most``
    places masked are joined where all the masked characters differ, and what is left after fewer deletions is joined
    with what is left after up to ``most``; no block of names is compared pair by pair.  A name's rows, however many, are one entry.
    What all names begin with is left out of the index.  Null names take no part.
    The index has many rows a name, which Spark's estimate of its size doesn't know, so that it is merged, never sent whole, and
    dealt over as many tasks as its rows need.
    """
    names = df.select(F.col(name).alias("n")).where("n is not null").distinct()
    told = names.groupBy(F.char_length("n").alias("size")).agg(F.count("*").alias("rows"), F.min("n").alias("a"), F.max("n").alias("z")).collect()  # a row a length
    begin = os.path.commonprefix([x for r in told for x in (r.a, r.z)])
    entries = sum(r.rows * (2 * sum(math.comb(r.size - len(begin), i) for i in range(most + 1)) + math.comb(r.size - len(begin), most)) for r in told)
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-entries // TASK_ROWS))
    names = names.select(F.substr("n", F.lit(len(begin) + 1)).alias("n")).repartition(parts, "n")

    def left(deepest: int) -> DataFrame:
        each = names.select("n", F.explode(deletions(F.col("n"), deepest)).alias("x"))
        return each.select("n", (F.char_length("n") - F.char_length("x")).alias("gone"), F.xxhash64("x").alias("h")).repartition(parts, "h")

    masked = names.select("n", F.inline(masks(F.col("n"), most))).select("n", "gone", F.xxhash64("left").alias("h")).repartition(parts, "h")
    a, b = F.col("a.n"), F.col("b.n")
    differ = reduce(lambda x, i: x & (F.substring("a.gone", i, 1) != F.substring("b.gone", i, 1)), range(1, most + 1), a < b)
    replaced = masked.alias("a").join(masked.hint("merge").alias("b"), (F.col("a.h") == F.col("b.h")) & differ)
    # Pairs whose sides both lost fewer are met from either side.
    once = (a < b) | ((F.col("b.gone") == most) & (a > b))
    moved = left(most - 1).alias("a").join(left(most).hint("merge").alias("b"), (F.col("a.h") == F.col("b.h")) & once)
    pairs = [j.select(F.least(a, b).alias("name_1"), F.greatest(a, b).alias("name_2")) for j in (replaced, moved)]
    found = pairs[0].unionByName(pairs[1]).withColumn("distance", F.levenshtein("name_1", "name_2", most)).where("distance >= 0")
    found = found.repartition(parts, "name_1", "name_2").distinct()
    return found.select(*(F.concat(F.lit(begin), n).alias(n) for n in ("name_1", "name_2")), "distance")
