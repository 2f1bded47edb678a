"""Column functions for cleaning sentences and reading parts of them.  All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Verbs that make a sentence a forecast by their mere presence.
FUTURE_MODALS = ("will", "shall", "would", "could", "should", "may", "might", "must", "can", "going")


def tokens(text: Column) -> Column:
    """White-space tokens without empty ones; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+"), lambda x: x != "")


def without_markup_and_urls(text: Column) -> Column:
    """Tags become a space, then urls vanish."""
    return F.regexp_replace(F.regexp_replace(text, r"<[^\n]*?>", " "), r"http[^ \t\n\x0B\f\r]+", "")


def letters_only(text: Column) -> Column:
    return F.regexp_replace(text, r"[^a-zA-Z \t\n\x0B\f\r]", " ")


def without_symbols(text: Column) -> Column:
    """Letters, digits, ``$`` and ``%`` stay."""
    return F.regexp_replace(text, r"[^a-zA-Z0-9$% \t\n\x0B\f\r]", " ")


def single_spaces(text: Column) -> Column:
    return F.regexp_replace(text, " +", " ")


def clean(text: Column) -> Column:
    return single_spaces(without_symbols(without_markup_and_urls(F.lower(text))))


def expand(text: Column, mapping: dict[str, str]) -> Column:
    """Whole tokens replaced by a map (contractions, say); white space becomes single spaces."""
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.array_join(F.transform(tokens(text), lambda x: F.coalesce(pairs[x], x)), " ")


def sentences(text: Column) -> Column:
    """Pieces between full stops, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(text, r"\."), lambda x: F.trim(x)), lambda x: x != "")


def shape(token: Column) -> Column:
    """``Xx`` shapes: upper case X, lower case x, digits d; runs are cut at four."""
    base = F.regexp_replace(F.regexp_replace(F.regexp_replace(token, "[a-z]", "x"), "[A-Z]", "X"), "[0-9]", "d")
    return F.regexp_replace(base, r"(x{4})x+|(X{4})X+|(d{4})d+", "$1$2$3")


def has_future_modal(text: Column) -> Column:
    return F.arrays_overlap(tokens(F.lower(text)), F.array(*map(F.lit, FUTURE_MODALS)))


#: Titles that are organisations, and the forms of temperatures, quarters and days.
ORGANISATIONS = ("Weather Underground", "The Weather Channel]")
TEMPERATURE = r"^(?:-\d+°[CF]|-\d+°[CF] to -\d+°[CF]|\d+°[CF] to \d+°[CF]|\d+°[CF])"
QUARTER = r"^(?:Q\d of \d{4}|Quarter \d|\d Q\d)"
DAY = r"^\d{1,2} [a-zA-Z]+ \d{4}"


def corrected_entity(label: Column, text: Column) -> Column:
    """Entity labels put right by what the text looks like; patterns hold at its start."""
    quarter = text.rlike(QUARTER)
    return (
        F.when((label == "LOC") | label.startswith("LOC_"), "GPE")
        .when(label == "FAC", "PERSON")
        .when((label == "WORK_OF_ART") & quarter, "DATE")
        .when((label == "WORK_OF_ART") & text.isin(*ORGANISATIONS), "ORG")
        .when((label == "CARDINAL") & text.rlike(DAY), "DATE")
        .when((label == "CARDINAL") & text.rlike(TEMPERATURE), "TEMPERATURE")
        .otherwise(label)
    )


def pieces(text: Column) -> Column:
    """Between single spaces, empty ones too."""
    return F.split(text, " ", -1)


def lines(text: Column) -> Column:
    """Trimmed lines that aren't blank."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")


def without_tags(text: Column) -> Column:
    """Tags become a space, white space one space, ends trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"<[^<>]*>", " "), r"[ \t\n\x0B\f\r]+", " "))


def version_of(name: Column) -> Column:
    """The number of ``name-vN.ext``, ``name-N.ext`` or ``name_vN``; null if there is none."""
    return F.regexp_extract(name, r"(?:-v?|_v)(\d+)(?:\.[^.]*)?$", 1).try_cast("int")


def dated(name: Column) -> Column:
    return F.coalesce(name.rlike(r"\d{4}-\d{2}-\d{2}"), F.lit(False))


def spans(text: Column, marks: Column) -> Column:
    """The pieces of a text between ``start`` and ``end`` (from 0, end not with it) of ``marks``, with their labels."""
    return F.transform(marks, lambda m: F.struct(m["label"].alias("label"), F.substring(text, m["start"] + 1, m["end"] - m["start"]).alias("piece")))


def paired_tokens(a: Column, b: Column) -> Column:
    """``[CLS] a.. [SEP] b.. [SEP]``."""
    sep = F.array(F.lit("[SEP]"))
    return F.concat(F.array(F.lit("[CLS]")), tokens(a), sep, tokens(b), sep)


def letter_places(text: Column, alphabet: str = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ .,;'") -> Column:
    """Each letter's place in an alphabet, -1 if it has none: the columns of a one-hot matrix."""
    return F.transform(F.split(text, ""), lambda c: F.instr(F.lit(alphabet), c) - 1)


def composed(template: str, **parts: Column) -> Column:
    """A prompt's template with each ``{name}`` replaced by a column."""
    out = F.lit(template)
    for name, value in parts.items():
        out = F.replace(out, F.lit("{" + name + "}"), value)
    return out


def response_fields(text: Column, schema: str = "label INT, reasoning STRING") -> Column:
    """The JSON object inside a free-form answer, or null."""
    found = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.from_json(F.when(found != "", found), schema)


def template_number(text: Column) -> Column:
    """Of a line that begins with ``T0:`` to ``T6:``; else null."""
    return F.regexp_extract(text, r"^\s*T([0-6]):(?!\S)", 1).try_cast("int")


_PERSONS = {
    "i": "Case=Nom|Number=Sing|Person=1|PronType=Prs",
    "me": "Case=Acc|Number=Sing|Person=1|PronType=Prs",
    "you": "Person=2|PronType=Prs",
    "he": "Case=Nom|Gender=Masc|Number=Sing|Person=3|PronType=Prs",
    "him": "Case=Acc|Gender=Masc|Number=Sing|Person=3|PronType=Prs",
    "she": "Case=Nom|Gender=Fem|Number=Sing|Person=3|PronType=Prs",
    "it": "Gender=Neut|Number=Sing|Person=3|PronType=Prs",
    "we": "Case=Nom|Number=Plur|Person=1|PronType=Prs",
    "us": "Case=Acc|Number=Plur|Person=1|PronType=Prs",
    "they": "Case=Nom|Number=Plur|Person=3|PronType=Prs",
    "them": "Case=Acc|Number=Plur|Person=3|PronType=Prs",
}
#: The features of words whose form doesn't show them.
MORPHS = _PERSONS | {
    "the": "Definite=Def|PronType=Art",
    "a": "Definite=Ind|PronType=Art",
    "an": "Definite=Ind|PronType=Art",
    "this": "Number=Sing|PronType=Dem",
    "that": "Number=Sing|PronType=Dem",
    "these": "Number=Plur|PronType=Dem",
    "those": "Number=Plur|PronType=Dem",
    "and": "ConjType=Cmp",
    "or": "ConjType=Cmp",
    "but": "ConjType=Cmp",
    "not": "Polarity=Neg",
    "be": "VerbForm=Inf",
    "am": "Mood=Ind|Number=Sing|Person=1|Tense=Pres|VerbForm=Fin",
    "is": "Mood=Ind|Number=Sing|Person=3|Tense=Pres|VerbForm=Fin",
    "are": "Mood=Ind|Tense=Pres|VerbForm=Fin",
    "was": "Mood=Ind|Number=Sing|Person=3|Tense=Past|VerbForm=Fin",
    "were": "Mood=Ind|Number=Plur|Tense=Past|VerbForm=Fin",
    "has": "Mood=Ind|Number=Sing|Person=3|Tense=Pres|VerbForm=Fin",
    "had": "Mood=Ind|Tense=Past|VerbForm=Fin",
} | dict.fromkeys(("will", "shall", "would", "could", "should", "may", "might", "must", "can"), "VerbForm=Fin")
#: Features by form, tried in this order; patterns match a whole lower-case word.
FORMS = (
    (r"[0-9]+(?:[.,][0-9]+)*", "NumType=Card"),
    (r"[.!?]", "PunctType=Peri"),
    (r",", "PunctType=Comm"),
    (r"[^a-z]+", ""),
    (r".*[a-z]{3}ing", "Aspect=Prog|Tense=Pres|VerbForm=Part"),
    (r".*[a-z]{2}ed", "Tense=Past|VerbForm=Fin"),
    (r".*[a-z]{2}ly", ""),
    (r".*[a-z]{3}est", "Degree=Sup"),
    (r".*[a-z](?:[^su]|ie|ee)s", "Number=Plur"),
    (r".*[a-z]{3}", "Number=Sing"),
)


def terms(text: Column) -> Column:
    """Words and single signs in text order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"([\p{L}\p{N}]+|[^\p{L}\p{N}\s])"), 1)


def morphology(term: Column) -> Column:
    """A word's features as ``Name=Value|...`` in the order of names, empty where none shows; rules of English.

    Words of the closed classes are looked up, all others go by their form.  ``operators/tagging.py`` learns such features
    from tagged tables instead, as tags like any others.
    """
    low = F.lower(term)
    closed = F.create_map(*[F.lit(x) for kv in MORPHS.items() for x in kv])
    by_form = F.coalesce(*[F.when(low.rlike(rf"\A(?:{p})\z"), v) for p, v in FORMS], F.lit(""))
    return F.when(low.isNull(), None).otherwise(F.coalesce(closed[low], by_form))
