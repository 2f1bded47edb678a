"""Reading forecast sentences: templates, properties, answers of models, names.  All but one are built-in expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .text import template_number, tokens

#: The bracket templates of generated sentences, by number.
TEMPLATES = {
    1: r"On \[(.*?)\], \[(.*?)\] predicts that the \[(.*?)\] at \[(.*?)\] \[(.*?)\] \[(.*?)\] by \[(.*?)\] in \[(.*?)\].",
    2: r"In \[(.*?)\], \[(.*?)\] from \[(.*?)\], forecasts that the \[(.*?)\] \[(.*?)\] \[(.*?)\] from \[(.*?)\] in \[(.*?)\].",
    3: r"\[(.*?)\] (.*?) on \[(.*?)\] that the \[(.*?)\] in \[(.*?)\] \[(.*?)\] \[(.*?)\] by \[(.*?)\] in \[(.*?)\].",
    4: r"According to a \[(.*?)\] from \[(.*?)\], on \[(.*?)\], the \[(.*?)\] \[(.*?)\] \[(.*?)\] beyond \[(.*?)\] in the timeframe of \[(.*?)\].",
    5: r"In \[(.*?)\], the \[(.*?)\] in \[(.*?)\] \[(.*?)\] \[(.*?)\] by \[(.*?)\], as (.*?) by \[(.*?)\] on \[(.*?)\].",
}
#: The strict bracket templates, in which any words may stand for the act of forecasting.
STRICT_TEMPLATES = {
    1: r"On \[(.*?)\], \[(.*?)\] (.*?) that the \[(.*?)\] at \[(.*?)\] \[(.*?)\] \[(.*?)\] by \[(.*?)\] in \[(.*?)\].",
    2: r"In \[(.*?)\], \[(.*?)\] from \[(.*?)\], (.*?) that the \[(.*?)\] \[(.*?)\] \[(.*?)\] from \[(.*?)\] to \[(.*?)\] in \[(.*?)\].",
    3: r"\[(.*?)\] (.*?) on \[(.*?)\] that the \[(.*?)\] in \[(.*?)\] \[(.*?)\] \[(.*?)\] by \[(.*?)\] in \[(.*?)\].",
    4: r"According to a \[(.*?)\] from \[(.*?)\], on \[(.*?)\], the \[(.*?)\] \[(.*?)\] \[(.*?)\] beyond \[(.*?)\] in the timeframe of \[(.*?)\].",
    5: r"In \[(.*?)\], the \[(.*?)\] in \[(.*?)\] \[(.*?)\] \[(.*?)\] by \[(.*?)\], as (.*?) by \[(.*?)\] on \[(.*?)\].",
}
#: What each group of a strict template is; the act (``verb``) and a range's lower end (``low``) are read but aren't properties.
STRICT_FIELDS = {
    1: ("p_t", "p_p", "verb", "p_a", "p_o", "p_s", "p_m", "p_v", "p_f"),
    2: ("p_t", "p_p", "p_o", "verb", "p_a", "p_s", "p_m", "low", "p_v", "p_f"),
    3: ("p_p", "verb", "p_t", "p_a", "p_o", "p_s", "p_m", "p_v", "p_f"),
    4: ("p_p", "p_o", "p_t", "p_a", "p_s", "p_m", "p_v", "p_f"),
    5: ("p_f", "p_a", "p_o", "p_s", "p_m", "p_v", "verb", "p_p", "p_t"),
}
#: Groups of each template, and the fields of the first seven; the last group is ``p_f``.
GROUPS = {1: 8, 2: 8, 3: 9, 4: 8, 5: 9}
FIELDS = ("p_t", "p_p", "p_a", "p_o", "p_s", "p_m", "p_v")
#: Contractions and what they stand for.
CONTRACTIONS = {
    "ain't": "am not", "aren't": "are not", "can't": "cannot", "couldn't": "could not", "didn't": "did not",
    "doesn't": "does not", "don't": "do not", "hadn't": "had not", "hasn't": "has not", "haven't": "have not",
    "he'd": "he would", "he'll": "he will", "he's": "he is", "how'd": "how would", "how'll": "how will",
    "how's": "how is", "I'd": "I would", "I'll": "I will", "i'm": "I am", "I'm": "I am", "i've": "I have",
    "I've": "I have", "isn't": "is not", "it'd": "it would", "it'll": "it will", "it's": "it is", "let's": "let us",
    "mustn't": "must not", "shan't": "shall not", "she'll": "she will", "she's": "she is", "shouldn't": "should not",
    "that'd": "that would", "that'll": "that will", "that's": "that is", "there's": "there is",
    "they'd": "they would", "they'll": "they will", "they're": "they are", "they've": "they have",
    "wasn't": "was not", "we'd": "we would", "we'll": "we will", "we're": "we are", "we've": "we have",
    "weren't": "were not", "what'd": "what would", "what'll": "what will", "what's": "what is",
    "when'd": "when would", "when'll": "when will", "when's": "when is", "where'd": "where would",
    "where'll": "where will", "where's": "where is", "who'd": "who would", "who'll": "who will", "who's": "who is",
    "why'd": "why would", "why'll": "why will", "why's": "why is", "won't": "will not", "wouldn't": "would not",
    "you'd": "you would", "you'll": "you will", "you're": "you are", "you've": "you have",
}


def with_template(df: DataFrame, text: str = "text") -> DataFrame:
    """Rows that begin with ``T0:`` to ``T6:``, with ``template`` and the text after the first four characters."""
    return df.withColumn("template", template_number(F.col(text))).where("template is not null").withColumn(text, F.expr(f"substring(`{text}`, 5)"))


def template_fields(df: DataFrame, text: str = "text", template: str = "template") -> DataFrame:
    """Adds ``p_t .. p_f`` and a null ``p_l``; rows without a template or that don't match theirs go, and an unknown one is an error."""
    t = F.col(template)
    known = F.when(t.isNull() | t.isin(*TEMPLATES), t).otherwise(F.raise_error(F.concat(F.lit("unknown template "), t.cast("string"))))
    pick = lambda of: F.coalesce(*[F.when(known == n, of(n)) for n in TEMPLATES])
    hit = df.where(pick(lambda n: F.col(text).rlike(TEMPLATES[n])))
    fields = {name: pick(lambda n, i=i: F.regexp_extract(text, TEMPLATES[n], i)) for i, name in enumerate(FIELDS, 1)}
    return hit.withColumns(fields | {"p_f": pick(lambda n: F.regexp_extract(text, TEMPLATES[n], GROUPS[n])), "p_l": F.lit(None).cast("string")})


def property_flags(df: DataFrame, names: list[str]) -> DataFrame:
    """Each property as 1 (present) or 0, and their sum as ``total_properties``."""
    flags = {n: F.col(n).isNotNull().cast("int") for n in names}
    return df.withColumns(flags | {"total_properties": sum(flags.values(), F.lit(0))})


def keyword_query(text: Column, query: list[list[str]]) -> Column:
    """All of the groups, any term of a group, as whole words and case by case; null text is false."""
    from functools import reduce

    parts = [F.coalesce(text, F.lit("")).rlike(rf"\b(?:{'|'.join(group)})\b") for group in query]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def contains_pattern(text: Column, pattern: str) -> Column:
    """Case-insensitive pattern; null is false."""
    return F.coalesce(text.rlike(f"(?i){pattern}"), F.lit(False))


def without_brackets(text: Column) -> Column:
    return F.translate(text, "[]", "")


def shortened(text: Column, n: int = 30) -> Column:
    return F.when(F.length(text) > n, F.concat(F.substring(text, 1, n), F.lit("..."))).otherwise(text)


def dates_in(text: Column) -> Column:
    """Dates written as ``2024/08/21``, ``2024-08-21``, ``2027 Q3``, ``Q3 of 2027`` or ``21 August 2024``."""
    return F.regexp_extract_all(text, F.lit(r"(20\d{2}[/-]\d{2}[/-]\d{2}|20\d{2} Q[1-4]|Q[1-4] (?:of )?20\d{2}|\d{1,2} [A-Z][a-z]+ 20\d{2})"), 1)


#: Fixed value: one amount, or two after each other.
STAKES = r"\$[\d,]+(?:\s+\$[\d,]+)?"


def stakes(text: Column) -> Column:
    return F.regexp_extract(text, STAKES, 0)


def python_lists(text: Column) -> Column:
    """A printed dict of lists under the keys 0 to 4 as ``map<string,string>`` of joined items; unreadable text gives null.

    Quotes that open or close a key or an item become double ones, or are it already; apostrophes and quotes inside words stay.
    """
    plain = F.regexp_replace(text, r'(?<![{\[,:]\s{0,9})"(?!\s*[}\],:])', r'\\\\"')
    opened = F.regexp_replace(plain, r"(?<=[{\[,:])(\s*)'", '$1"')
    closed = F.regexp_replace(opened, r"'(?=\s*[}\],:])", '"')
    keyed = F.regexp_replace(closed, r'([{,]\s*)"?([0-4])"?\s*:', r'$1"$2":')
    return F.transform_values(F.from_json(keyed, "map<string,array<string>>"), lambda _, v: F.array_join(v, ", "))


def loose_lists(text: Column) -> Column:
    """The same of dicts whose items may stand without quotes: ``{0: [a, b c], 1: []}``; what has no such lists is an empty map."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"""['"]?([0-4])['"]?\s*:\s*\[([^\]]*)\]"""), 0)
    key = lambda x: F.regexp_extract(x, r"([0-4])", 1)
    items = lambda x: F.filter(F.transform(F.split(F.regexp_extract(x, r"\[([^\]]*)\]", 1), ","), lambda i: F.regexp_replace(F.trim(i), r"""^['"]|['"]$""", "")), lambda i: i != "")
    return F.map_from_entries(F.transform(found, lambda x: F.struct(key(x).alias("key"), F.array_join(items(x), ", ").alias("value"))))


def strict_fields(df: DataFrame, text: str = "text", template: str = "template") -> DataFrame:
    """Adds ``p_t .. p_f`` and a null ``p_l`` by the strict templates, each group under its own meaning.

    A sentence that doesn't begin as its template, null too, is an error, and so is an unknown template.
    """
    t, at = F.col(template), F.col(text)
    fits = F.coalesce(*[F.when(t == n, at.rlike(f"^(?:{p})")) for n, p in STRICT_TEMPLATES.items()], F.lit(False))
    told = F.raise_error(F.concat(F.lit("no match of its template: "), F.coalesce(at, F.lit("null"))))
    checked = df.withColumn(text, F.when(fits, at).otherwise(told))
    pick = lambda name: F.coalesce(*[F.when(t == n, F.regexp_extract(text, p, STRICT_FIELDS[n].index(name) + 1)) for n, p in STRICT_TEMPLATES.items() if name in STRICT_FIELDS[n]])
    return checked.withColumns({name: pick(name) for name in (*FIELDS, "p_f")} | {"p_l": F.lit(None).cast("string")})


def run_day(moment: Column | None = None) -> Column:
    """A day as runs are named by it: that of the moment, or today's."""
    return F.date_format(F.current_timestamp() if moment is None else moment, "yyyy-MM-dd")


def number_or(text: Column, default: int = -1) -> Column:
    """A whole number read from text, cut at the point; the default where it can't be read."""
    return F.coalesce(text.try_cast("double").try_cast("int"), F.lit(default))


def read_users(df: DataFrame, column: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose printed record could be read, its fields as columns, and the rows that couldn't."""
    read = df.withColumn("_u", quoted_json(F.col(column), schema))
    bad = F.col("_u").isNull() | (F.array_size(F.array_compact(F.array(*(F.col(f"_u.{f.strip().split(' ')[0]}").cast("string") for f in schema.split(","))))) == 0)
    return read.where(~bad).select(*(c for c in df.columns if c != column), "_u.*"), read.where(bad).select(*df.columns)


def nested_events(df: DataFrame, column: str, word: str = "prediction") -> DataFrame:
    """The records (``title`` and lists of lists of events) in which any value of any event has the word."""
    read = df.withColumn("_e", F.from_json(column, "title STRING, event_list_extraction ARRAY<ARRAY<MAP<STRING, STRING>>>"))
    has = lambda m: F.exists(F.map_values(m), lambda v: F.coalesce(F.lower(v).contains(word), F.lit(False)))
    return read.where(F.exists(F.flatten("_e.event_list_extraction"), has)).select(*(c for c in df.columns if c != column), "_e.*")


def flat_events(read: DataFrame, kind: str = "prediction") -> DataFrame:
    """A row for each event of a kind: ``title, time, location, subject, object``."""
    each = read.select("title", F.explode(F.flatten("event_list_extraction")).alias("e")).where(F.col("e")["Event"] == kind)
    return each.select("title", *(F.col("e")[n].alias(n.lower()) for n in ("Time", "Location", "Subject", "Object")))


def absolute(link: Column, base: Column) -> Column:
    """A link on a page with this url: as it is, from the host, or beside the page."""
    host = F.regexp_extract(base, r"^([^:/?#]+://[^/?#]*)", 1)
    beside = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"^([^:/?#]+://[^/?#]*)?(.*/)?[^/]*$", "$2")
    return F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link).when(link.startswith("/"), F.concat(host, link)).otherwise(F.concat(host, F.when(beside == "", "/").otherwise(beside), link))


def quoted_json(text: Column, schema: str) -> Column:
    """JSON printed with single quotes."""
    return F.from_json(F.regexp_replace(text, "'", '"'), schema)


def printed_vector(text: Column) -> Column:
    """``[0.1 0.2 ...]`` as floats."""
    return F.transform(tokens(F.regexp_replace(text, r"[\[\],]", " ")), lambda x: x.try_cast("float"))


def sigmoid(x: Column, base: float | None = None) -> Column:
    """With another base in place of e, if given."""
    p = F.exp(x) if base is None else F.pow(F.lit(float(base)), x)
    return p / (p + 1)


def standardized(x: Column, mean: Column, deviation: Column) -> Column:
    return (x - mean) / deviation


def restored(z: Column, mean: Column, deviation: Column) -> Column:
    """What ``standardized`` was made of."""
    return z * deviation + mean


def query_string(params: Column) -> Column:
    """A map as ``k=v&..``, by key."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(params)), lambda e: F.concat(e["key"], F.lit("="), F.url_encode(e["value"]))), "&")


@lru_cache(1)
def _bases() -> tuple[str, str]:
    """All characters that have a base among the kept ones in canonical decomposition, and those bases."""
    keep = set("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ .,;'")
    found = [(c, b) for c in map(chr, range(0x80, 0x110000)) for b in ["".join(x for x in unicodedata.normalize("NFD", c) if x in keep)] if b]
    assert all(len(b) == 1 for _, b in found)
    return "".join(c for c, _ in found), "".join(b for _, b in found)


def ascii_letters(s: Column | str) -> Column:
    """Letters without their accents; all but ASCII letters, space and ``.,;'`` vanish.  Built-in functions only."""
    return F.regexp_replace(F.translate(F.col(s) if isinstance(s, str) else s, *_bases()), r"[^A-Za-z .,;']", "")


def _jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    reach = max(0, max(len(a), len(b)) // 2 - 1)
    free, met = [True] * len(b), []
    for i, c in enumerate(a):
        j = next((j for j in range(max(0, i - reach), min(len(b), i + reach + 1)) if free[j] and b[j] == c), None)
        if j is not None:
            free[j] = False
            met.append(c)
    if not met:
        return 0.0
    swapped = sum(x != y for x, y in zip(met, [c for c, f in zip(b, free, strict=True) if not f], strict=True)) // 2
    m = len(met)
    jaro = (m / len(a) + m / len(b) + (m - swapped) / m) / 3
    same = next((k for k in range(min(4, len(a), len(b))) if a[k] != b[k]), min(4, len(a), len(b)))
    return jaro + same * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Likeness of names, 0 to 1."""
    return pd.Series([None if x is None or y is None else _jaro_winkler(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")
