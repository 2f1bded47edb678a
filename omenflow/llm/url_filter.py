"""URL filter: host rules first, then a character language-model ratio.  DataFrame functions only.

Two smoothed variable-order Markov models (Witten-Bell: each order up to ``order`` is interpolated with the next
shorter one, down to a uniform distribution) learn the characters of ``host + path`` of the urls that rules accept and
reject.  Another url gets the length-normalised difference of its log-likelihoods, compared with a threshold that is
calibrated on rule-judged urls held out from the models (crc32 of ``host + path`` modulo 5 is 0, so that no copy of a
held-out url is learned): the one with the best balanced accuracy over a histogram of ``BINS`` steps.

Only distinct n-grams are looked up in the model; what a url of any length moves is in proportion to its length.

Cases: a null url or one without ``://`` has an empty host and path and is allowed, as nothing speaks against it; so is
every url where no url was rejected by a rule, and none where none was accepted; repeated rows get equal verdicts;
an empty table gives an empty result; very long urls are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, salted_join, stored, table, url_parts

#: (host, path, verdict); a rule fits its host and all subdomains where the path begins with its path.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
START, END = "\u0002", "\u0003"
BINS = 2000
#: Most n-grams that are looked up from a broadcast table.
HOT = 1024


def ruled(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (the first listed of equals) and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(reversed(rules), key=lambda r: len(r[0]) + len(r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def grams(df: DataFrame, order: int, *keep: str) -> DataFrame:
    """One row for each position of ``body``: its character after the ``order`` characters before it.

    The characters are an array that is bound once, so that a position costs the same in a body of any length.
    """
    padded = F.split(F.concat(F.lit(START * order), F.col("body"), F.lit(END)), "")
    at = lambda cs: F.transform(F.sequence(F.lit(0), F.size(cs) - order - 1), lambda i: F.concat(*[F.get(cs, i + k) for k in range(order + 1)]))
    cut = df.select(*keep, F.flatten(F.transform(F.array(padded), at)).alias("grams"))
    return cut.select(*keep, F.explode("grams").alias("gram"))


def train(labelled: DataFrame, order: int) -> DataFrame:
    """Counts of n-grams and contexts of every order for both classes.

    ``labelled``: ``body, accepted``.  ``key`` is an n-gram (``kind`` g) or a context (c): for these ``n`` is how often
    it was met and ``t`` how many different characters came after it.
    """
    counted = labelled.groupBy("body").agg(F.sum(F.col("accepted").cast("long")).alias("a"), F.sum((~F.col("accepted")).cast("long")).alias("b"))
    top = grams(counted, order, "a", "b").groupBy("gram").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    each = top.select(F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("k"), "gram", "a", "b")
    seen = each.groupBy(F.expr("right(gram, k)").alias("key")).agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    context = seen.groupBy(F.expr("left(key, length(key) - 1)").alias("key")).agg(
        F.sum("na").alias("na"), F.sum("nb").alias("nb"), F.sum((F.col("na") > 0).cast("long")).alias("ta"), F.sum((F.col("nb") > 0).cast("long")).alias("tb")
    )
    none = F.lit(None).cast("long")
    return seen.select(F.lit("g").alias("kind"), "key", "na", "nb", none.alias("ta"), none.alias("tb")).unionByName(context.select(F.lit("c").alias("kind"), "key", "na", "nb", "ta", "tb"))


def differences(model: DataFrame, wanted: DataFrame, order: int) -> DataFrame:
    """``gram, diff``: log-probability of the last character under the accepting model less that under the rejecting.

    Suffixes are worked out from the shortest to the longest, each length from the one below it: distinct suffixes that
    share a shorter one, or a context, are no more than the alphabet has characters, so that no key of a join is hot.
    """
    ends = {order: wanted.select(F.col("gram").alias("key"))}
    for k in range(order - 1, -1, -1):
        ends[k] = ends[k + 1].select(F.expr(f"right(key, {k + 1})").alias("key")).distinct()
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("double")
    below = None
    for k in range(order + 1):
        met = model.where((F.col("kind") == "g") & (F.char_length("key") == k + 1)).select("key", "na", "nb")
        context = model.where((F.col("kind") == "c") & (F.char_length("key") == k)).select(F.col("key").alias("context"), F.col("na").alias("ca"), F.col("nb").alias("cb"), "ta", "tb")
        rows = ends[k].join(met, "key", "left").withColumn("context", F.expr(f"left(key, {k})"))
        if below is None:  # one context, the empty one
            rows = rows.join(F.broadcast(context), "context", "left").withColumns({"la": F.lit(1.0 / 1024), "lb": F.lit(1.0 / 1024)})
        else:
            rows = rows.join(context, "context", "left").withColumn("lower", F.expr(f"right(key, {k})")).join(below, "lower")
        mixed = {}
        for x in "ab":
            n, t = zero(f"c{x}"), zero(f"t{x}")
            mixed[x] = F.when(n > 0, (zero(f"n{x}") + t * F.col(f"l{x}")) / (n + t)).otherwise(F.col(f"l{x}"))
        probs = rows.select("key", mixed["a"].alias("la"), mixed["b"].alias("lb"))
        below = probs.withColumnRenamed("key", "lower")
    return probs.select(F.col("key").alias("gram"), (F.log("la") - F.log("lb")).alias("diff"))


def ratios(bodies: DataFrame, model: DataFrame, order: int) -> DataFrame:
    """``body, ratio`` of distinct bodies: the mean difference over their characters and the end.

    A body travels as a 128-bit key.  N-grams with at least one in ``HOT`` of all positions, ``HOT`` at most, are
    looked up from a broadcast table, so that no other one has more positions than that in a task.
    """
    keyed = bodies.select("body", F.xxhash64("body").alias("k1"), F.xxhash64("body", F.lit(1)).alias("k2"))
    at = grams(keyed, order, "k1", "k2").groupBy("k1", "k2", "gram").agg(F.count("*").alias("n"))  # each body's n-grams once
    at = stored(at)
    wanted = stored(at.groupBy("gram").agg(F.sum("n").alias("n"), F.count("*").alias("rows")))
    total = wanted.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    found = stored(differences(model, wanted.select("gram"), order).join(wanted, "gram"))
    hot = found.where(F.col("rows") * HOT >= total).select("gram", F.col("diff").alias("hot"))  # HOT rows at most
    split = at.join(F.broadcast(hot), "gram", "left")
    known = split.where("hot is not null").select("k1", "k2", "n", F.col("hot").alias("diff"))
    rest = split.where("hot is null").drop("hot").join(found.where(F.col("rows") * HOT < total).select("gram", "diff"), "gram").select("k1", "k2", "n", "diff")
    sums = known.unionByName(rest).groupBy("k1", "k2").agg((F.sum(F.col("n") * F.col("diff")) / F.sum("n")).alias("ratio"))
    return keyed.join(sums, ["k1", "k2"]).select("body", "ratio")


def threshold(scored: DataFrame) -> float:
    """The ratio with the best balanced accuracy; ``scored``: ``ratio, accepted``.  Only a histogram is sorted."""
    step = 20.0 / BINS
    binned = F.greatest(F.lit(-BINS // 2), F.least(F.lit(BINS // 2), F.floor(F.col("ratio") / step)))
    hist = scored.groupBy(binned.cast("int").alias("bin")).agg(F.sum(F.col("accepted").cast("long")).alias("a"), F.sum((~F.col("accepted")).cast("long")).alias("b")).orderBy("bin").collect()  # at most BINS + 1 rows
    all_a, all_b = sum(r.a for r in hist), sum(r.b for r in hist)
    if not all_a or not all_b:
        return 0.0
    best, cut, a, b = -1.0, 0.0, 0, 0
    for r, after in zip(hist, [*hist[1:], None], strict=True):
        a, b = a + r.a, b + r.b
        value = (all_a - a) / all_a + b / all_b
        if value > best:
            best, cut = value, step * ((r.bin + 1 + (after.bin if after else r.bin + 1)) / 2)
    return cut


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, order: int = 5) -> DataFrame:
    """``id, host, path, rule, verdict, ratio`` of every row (``ratio`` only where no rule fits)."""
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("id", "host", "path", F.concat("host", "path").alias("body"), rule.alias("rule"), verdict.alias("ruled"), (fold(F.concat("host", "path")) == 0).alias("held"))
    rows = stored(rows)
    labelled = rows.where("ruled is not null").select("body", (F.col("ruled") == "allow").alias("accepted"), "held")
    classes = {bool(r.accepted) for r in labelled.select("accepted").distinct().collect()}
    out = lambda df, v, r: df.select("id", "host", "path", "rule", F.coalesce("ruled", v).alias("verdict"), r.alias("ratio"))
    if classes != {True, False}:
        return out(rows, F.lit("block" if classes == {False} else "allow"), F.lit(None).cast("double"))
    model = stored(train(labelled.where("not held"), order))
    bodies = rows.where("(ruled is null or held) and body <> ''").select("body").distinct()
    scores = stored(ratios(bodies, model, order))
    cut = threshold(labelled.where("held").join(scores, "body"))
    # Urls without a body have no score and meet nothing; those that repeat are dealt over salts.
    scored = rows.where("ruled is null and body <> ''")
    sizes = scored.groupBy("body").agg(F.count("*").alias("_n"))
    open_rows = salted_join(scored, scores.join(sizes, "body"), "body").unionByName(rows.where("ruled is null and body = ''").withColumn("ratio", F.lit(None).cast("double")))
    return out(open_rows, F.when(F.col("ratio") < cut, "block").otherwise("allow"), F.col("ratio")).unionByName(out(rows.where("ruled is not null"), F.lit("allow"), F.lit(None).cast("double")))


def op2_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")
