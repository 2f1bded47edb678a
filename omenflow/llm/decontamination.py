"""Benchmark decontamination by size-partitioned MinHash containment search.  DataFrame functions only.

Test items are partitioned by size (powers of two of their number of distinct shingles).  An item with ``n`` shingles
that must be contained to a share of 0.75 gets a bottom-k MinHash sketch of ``k = n - ceil(0.75 n) + 1`` values: any
``k`` of its shingles must then meet a document that contains enough of them, so that the search loses nothing.  Each
partition has a bound, the largest value in its sketches, and a least size of document; a document of any length is
reduced to the values below the bounds of the partitions it is large enough for, and only these are looked up.  The
candidates are verified by exact containment: the share of an item's distinct shingles that the document has.

Words: A-Z lower-cased, runs of bytes other than ASCII white space; a shingle is five consecutive words (a 64-bit hash).
An item of one to four words is a single shingle of all of them; only where there are such items, documents also have the
shingles of their lengths, so that such an item is found wherever its words stand in a row.  ``short=False`` leaves
these items out, as a filter may want, since a single common word is in most documents.

Cases: null and empty texts have no shingle and match nothing, and texts of fewer than five words only match short items; rows that repeat a
``doc_id`` count as one document, repeated item ids as one item (their shingles together); rows and items with a null id
are each on their own, told apart by hashes of their texts, and are reported with a null id; very long texts are read
whole; an empty table on either side gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import lower_ascii, stored, table

WIDTH = 5
SHARE = 75  # percent


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all shingles of a text, in text order; null or short texts have none."""
    words = F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The words are bound once; a lambda over positions then reads its neighbours.
    of = lambda ws: F.transform(F.sequence(F.lit(0), F.size(ws) - width), lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(width)]))
    return F.flatten(F.transform(F.array(words), lambda ws: F.when(F.size(ws) >= width, of(ws)).otherwise(F.array().cast("array<bigint>"))))


def item_shingles(text: Column, short: bool = True) -> Column:
    """Hashes of an item's shingles; with fewer than five words all of them are one."""
    ways = [shingles(text)]
    if short:
        ways += [F.when(_words(text) == n, shingles(text, n)) for n in range(1, WIDTH)]
    return F.flatten(F.array_compact(F.array(*ways)))


def _words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def short_lengths(items: DataFrame) -> list[int]:
    """The numbers of words below five that items have: four at most."""
    counted = items.select(_words(F.col("text")).alias("n")).where(F.col("n").between(1, WIDTH - 1)).distinct()
    return sorted(r.n for r in counted.collect())


def _copy(id_col: str) -> Column:
    """What tells rows with a null id apart; 0 where there is an id."""
    return F.when(F.col(id_col).isNull(), F.xxhash64("text")).otherwise(F.lit(0).cast("long"))


def item_sketches(items: DataFrame, share: int = SHARE, short: bool = True) -> tuple[DataFrame, DataFrame]:
    """``item_id, item_copy, h, n, part`` of all shingles, and the same of the sketches.  Items are keyed by the first two."""
    each = items.select("item_id", _copy("item_id").alias("item_copy"), F.explode(F.array_distinct(item_shingles(F.col("text"), short))).alias("h")).distinct()
    sets = each.groupBy("item_id", "item_copy").agg(F.array_sort(F.collect_list("h")).alias("hs"))  # one benchmark text each
    n = F.size("hs").cast("long")
    sets = sets.select("item_id", "item_copy", "hs", n.alias("n"), F.floor(F.log2(n.cast("double"))).cast("int").alias("part"), (n - F.floor((n * share + 99) / 100).cast("long") + 1).cast("int").alias("k"))
    sets = stored(sets)
    full = sets.select("item_id", "item_copy", "n", "part", F.explode("hs").alias("h"))
    sketch = sets.select("item_id", "item_copy", "n", "part", F.explode(F.slice("hs", F.lit(1), F.col("k"))).alias("h"))
    return full, sketch


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE, short: bool = True) -> DataFrame:
    """``doc_id, item_id, n_item, n_shared, containment`` of each pair with a containment of ``share`` percent or more.

    ``short``: items of one to four words too.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("copy", _copy("doc_id"))
    full, sketch = item_sketches(items, share, short)
    lengths = short_lengths(items) if short else []
    all_of = lambda text: F.concat(shingles(text), *[shingles(text, n) for n in lengths])
    # The partitions: one row for each power of two, 63 at most.
    bounds = sketch.groupBy("part").agg(F.max("h").alias("bound"), F.min("n").alias("least")).orderBy("part").collect()
    if not bounds:
        return docs.select("doc_id", F.lit(None).cast(dict(items.dtypes)["item_id"]).alias("item_id"), F.lit(0).cast("long").alias("n_item"), F.lit(0).cast("long").alias("n_shared"), F.lit(0.0).alias("containment")).where(F.lit(False))
    # Values that a document keeps: below the largest bound of the partitions it is large enough for.
    bound = F.lit(None).cast("long")
    for i, b in enumerate(bounds):
        bound = F.when(F.size("all") * 100 >= b.least * share, F.lit(max(x.bound for x in bounds[: i + 1]))).otherwise(bound)
    kept = docs.select("doc_id", "copy", all_of(F.col("text")).alias("all")).withColumn("bound", bound).where("bound is not null")
    values = kept.select("doc_id", "copy", F.explode(F.filter("all", lambda h: h <= F.col("bound"))).alias("h"))
    found = values.join(sketch.select("h", "item_id", "item_copy"), "h").select("doc_id", "copy", "item_id", "item_copy").distinct()
    found = stored(found)
    same = lambda a, b, *names: reduce(and_, (a[x].eqNullSafe(b[x]) for x in names))
    # Exact containment, in candidate documents only.
    candidates = found.select("doc_id", "copy").distinct()
    texts = docs.join(candidates, same(docs, candidates, "doc_id", "copy"), "left_semi")
    has = texts.select("doc_id", "copy", F.explode(F.array_distinct(all_of(F.col("text")))).alias("h"))
    met = has.join(full, "h").groupBy("doc_id", "copy", "item_id", "item_copy", "n").agg(F.count_distinct("h").alias("n_shared"))
    pairs = met.join(found, same(met, found, "doc_id", "copy", "item_id", "item_copy"), "left_semi").where(F.col("n_shared") * 100 >= F.col("n") * share)
    return pairs.select("doc_id", "item_id", F.col("n").alias("n_item"), "n_shared", (F.col("n_shared") / F.col("n")).alias("containment"))


def op9_minhash_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP9_SQL = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
w AS (SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM t),
g AS (SELECT DISTINCT len(w) AS n FROM w WHERE kind = 'i' AND len(w) BETWEEN 1 AND 4),
s AS (SELECT kind, id, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS s
      FROM (SELECT kind, id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)
      UNION SELECT kind, id, array_to_string(w, ' ') FROM w WHERE kind = 'i' AND len(w) BETWEEN 1 AND 4
      UNION SELECT kind, id, array_to_string(w[i:i + n - 1], ' ') FROM (SELECT kind, id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM w, g WHERE kind = 'd' AND len(w) >= n)),
n AS (SELECT id, count(*) AS n_item FROM s WHERE kind = 'i' GROUP BY id),
m AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM s d JOIN s i ON d.s = i.s AND d.kind = 'd' AND i.kind = 'i' GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM m JOIN n ON item_id = id WHERE n_shared * 100 >= n_item * 75
"""
