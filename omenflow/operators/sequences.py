"""Tagged sequences: counts, conditional probabilities, decoding, tense, numbered labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .skew import same, with_values

FLOOR = 1e-6


def vocabulary(words: DataFrame, word: str = "word", least: int = 3) -> DataFrame:
    """``word, n``: words seen more than ``least`` times; ``< unk >`` has the number of the other words."""
    counted = words.groupBy(F.col(word).alias("word")).agg(F.count("*").alias("n"))
    rare = counted.where(F.col("n") <= least).agg(F.count("*").alias("n")).select(F.lit("< unk >").alias("word"), "n")
    return rare.unionByName(counted.where(F.col("n") > least))


def emissions(tagged: DataFrame, tag: str = "tag", word: str = "word") -> DataFrame:
    """``tag, word, n, p``."""
    counted = tagged.groupBy(F.col(tag).alias("tag"), F.col(word).alias("word")).agg(F.count("*").alias("n"))
    total = counted.groupBy("tag").agg(F.sum("n").alias("all"))  # a row a tag
    return same(counted, total, "tag").select("tag", "word", "n", (F.col("n") / F.col("all")).alias("p"))


def decode(words: DataFrame, transitions: DataFrame, emitted: DataFrame, greedy: bool = False, floor: float = FLOOR) -> DataFrame:
    """``sequence, pos, word, tag`` of ``sequence, pos, word``: the best path (Viterbi), or the best step by step.

    ``transitions`` (``state, next_state, p``) and ``emitted`` (``tag, word, p``) are a model's probabilities; missing ones
    are ``floor``, and of equal paths that with the first states by name is taken.  Nothing of the model is collected: a
    word's log probabilities by tag are joined to its places, and the matrix of transitions is one row, of the
    square of a tag set.  A sequence is a sentence, whose words are one row while it is decoded.
    """
    known = emitted.where("tag is not null")
    tags = known.select(F.col("tag").alias("s")).distinct()
    names = tags.agg(F.array_sort(F.collect_list("s")).alias("names"))
    each = tags.select(F.col("s").alias("a")).join(F.broadcast(tags.select(F.col("s").alias("b"))))  # the square of a tag set
    step = each.join(transitions.select(F.col("state").alias("a"), F.col("next_state").alias("b"), "p"), ["a", "b"], "left")
    logged = F.log(F.coalesce("p", F.lit(floor)))
    into = step.groupBy("b").agg(F.transform(F.array_sort(F.collect_list(F.struct("a", logged.alias("l")))), lambda x: x["l"]).alias("row"))
    matrix = into.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "row"))), lambda x: x["row"]).alias("moves"))
    model = F.broadcast(names.join(matrix))  # one row
    said = known.select("word", "tag", F.log("p").alias("l")).groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("tag", "l"))).alias("_l"))  # a tag set at most
    hot = words.groupBy("word").agg(F.count("*").alias("_rows"))
    placed = with_values(words.select("sequence", "pos", "word"), hot.join(said, "word", "left"), "word", "_rows", "left")
    rows = placed.groupBy("sequence").agg(F.array_sort(F.collect_list(F.struct("pos", "word", F.map_entries("_l").alias("_l")))).alias("w")).join(model)
    least = F.log(F.lit(floor))
    says = lambda x: F.transform("names", lambda n: F.coalesce(F.try_element_at(F.map_from_entries(x["_l"]), n), least))
    scores = rows.select("sequence", "names", "moves", F.transform("w", lambda x: F.struct(x["pos"].alias("pos"), x["word"].alias("word"))).alias("w"), F.transform("w", says).alias("e"))
    first = lambda xs: F.array_position(xs, F.array_max(xs)).cast("int")
    if greedy:
        step_ = lambda path, e: F.concat(path, F.array(first(F.when(F.size(path) == 0, e).otherwise(F.zip_with(F.transform("moves", lambda row: F.get(row, F.element_at(path, -1) - 1)), e, lambda a, b: a + b)))))
        path = F.aggregate("e", F.array().cast("array<int>"), lambda p, e: F.when(F.size(p) == 0, F.array(first(e))).otherwise(step_(p, e)))
    else:
        # The state: each tag's best sum so far, and the ways back, a list of the tags before for each place.
        start = F.struct(F.get("e", F.lit(0)).alias("best"), F.array().cast("array<array<int>>").alias("back"))
        ways = lambda best: F.transform("moves", lambda row: F.zip_with(best, row, lambda a, b: a + b))

        def forward(s, e):
            reached = ways(s["best"])
            return F.struct(F.zip_with(F.transform(reached, F.array_max), e, lambda a, b: a + b).alias("best"), F.concat(s["back"], F.array(F.transform(reached, first))).alias("back"))

        scores = scores.withColumn("_v", F.aggregate(F.slice("e", F.lit(2), F.size("e")), start, forward))
        path = F.reverse(F.aggregate(F.reverse("_v.back"), F.array(first(F.col("_v.best"))), lambda p, back: F.concat(p, F.array(F.get(back, F.element_at(p, -1) - 1)))))
    told = scores.select("sequence", F.col("names"), F.inline(F.arrays_zip(F.col("w").alias("w"), path.alias("t"))))
    return told.select("sequence", "w.pos", "w.word", F.get("names", F.col("t") - 1).alias("tag"))


def path_probability(paths: DataFrame, transitions: DataFrame) -> DataFrame:
    """``path, p``: the product over neighbouring states of ``path, pos, state``; a missing transition makes it 0."""
    pairs = paths.withColumn("next_state", F.lead("state").over(Window.partitionBy("path").orderBy("pos"))).where("next_state is not null")
    known = pairs.join(transitions.select("state", "next_state", "p"), ["state", "next_state"], "left")
    return known.groupBy("path").agg(F.when(F.min(F.coalesce("p", F.lit(0.0))) > 0, F.exp(F.sum(F.log("p")))).otherwise(0.0).alias("p"))


def numbered(tokens: DataFrame, label: str, order: list[str], within: str) -> DataFrame:
    """Adds ``unique_label``: ``NOUN_1, NOUN_2, ..`` in each document."""
    n = F.row_number().over(Window.partitionBy(within, label).orderBy(*order))
    return tokens.withColumn("unique_label", F.concat_ws("_", F.col(label), n.cast("string")))


def wide_entities(entities: DataFrame, row: str, label: str, text: str, pos: str, labels: list[str]) -> DataFrame:
    """One row a document and a column a label; of several, the last is taken, and absent ones are null."""
    return entities.groupBy(row).pivot(label, labels).agg(F.max_by(text, pos))


def tense(tokens: DataFrame, sentence: str, pos: str = "pos", tag: str = "tag", wants: tuple[str, str] = ("AUX", "MD")) -> DataFrame:
    """``sentence, future``: 1 where one token has both the part of speech and the tag."""
    hit = F.coalesce((F.col(pos) == wants[0]) & (F.col(tag) == wants[1]), F.lit(False))
    return tokens.groupBy(sentence).agg(F.max(hit.cast("int")).alias("future"))


def degrees(edges: DataFrame, source: str, target: str) -> DataFrame:
    """``node, degree`` of distinct edges."""
    ends = edges.select(source, target).distinct().select(F.explode(F.array(source, target)).alias("node"))
    return ends.where("node is not null").groupBy("node").agg(F.count("*").alias("degree"))
