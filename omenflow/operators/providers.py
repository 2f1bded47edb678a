"""Where a model outside Spark answers: prompts go out in batches, answers come back as rows.

A provider is any function from a list of prompts to a list of answers; it runs in tasks.  ``keyword_judge`` is one that
needs no network and always answers alike, for tests and dry runs.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx

Provider = Callable[[list[str]], list[str]]


def keyword_judge(prompts: list[str]) -> list[str]:
    """1 where the prompt's last line has a future modal."""
    found = [sorted(set(p.lower().rsplit("\n", 1)[-1].split()) & set(tx.FUTURE_MODALS)) for p in prompts]
    return [json.dumps({"label": int(bool(x)), "reasoning": ", ".join(x) or "no modal"}) for x in found]


def line_judge(prompts: list[str]) -> list[str]:
    """How a prompt's last line stands to the one before: it repeats it, it has a denial, or neither."""
    ends = [(["", ""] + p.split("\n"))[-2:] for p in prompts]
    return ["ENTAILMENT" if a in b else "CONTRADICTION" if "won't" in b else "NEUTRAL" for a, b in ends]


def prompted(text, task: str):
    return F.concat(F.lit(task + "\n"), F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))


def answered(df: DataFrame, prompt: str, provider: Provider, column: str = "answer") -> DataFrame:
    @F.pandas_udf("string")
    def ask(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(provider(part.fillna("").tolist()), index=part.index, dtype=object)

    return df.withColumn(column, ask(prompt))


def judged(df: DataFrame, id_col: str, text: str, task: str, judges: dict[str, Provider]) -> DataFrame:
    """``id, model, answer, label, reasoning``: one row for each text and judge; an unreadable answer has a null label."""
    parts = None
    asked = df.select(id_col, prompted(F.col(text), task).alias("prompt"))
    for name, provider in judges.items():
        read = answered(asked, "prompt", provider).withColumn("_r", tx.response_fields(F.col("answer")))
        rows = read.select(id_col, F.lit(name).alias("model"), "answer", F.col("_r.label").alias("label"), F.col("_r.reasoning").alias("reasoning"))
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def voted(judgements: DataFrame, id_col: str, none: str = "None as all are different labels") -> DataFrame:
    """``id, vote``: the label most judges gave; of equals that of the last model by name; where none occurs twice, ``none``."""
    counted = judgements.where("label is not null").groupBy(id_col, "label").agg(F.count("*").alias("n"), F.max("model").alias("last"))
    best = counted.groupBy(id_col).agg(F.max(F.struct("n", "last", "label")).alias("x"))
    return best.select(id_col, F.when(F.col("x.n") > 1, F.col("x.label").cast("string")).otherwise(none).alias("vote"))


def generated(keys: DataFrame, prompt: str, provider: Provider, label: int, **lineage) -> DataFrame:
    """A row for each line that isn't blank of each answer, with the keys' columns, the label and what else is named."""
    lines = answered(keys, prompt, provider).withColumn("base_sentence", F.explode(F.split("answer", "\n")))
    kept = lines.withColumn("base_sentence", F.trim("base_sentence")).where("base_sentence <> ''").drop("answer", prompt)
    return kept.withColumns({"sentence_label": F.lit(label)} | {k: F.lit(v) for k, v in lineage.items()})


def echo_writer(prompts: list[str]) -> list[str]:
    """A writer that needs no network: three lines that repeat the prompt's last line."""
    return ["\n\n".join(f"T{k}: {p.rsplit(chr(10), 1)[-1]}" for k in (1, 2, 3)) for p in prompts]


#: Providers by name; others may be added.
PROVIDERS: dict[str, Provider] = {"keywords": keyword_judge, "echo": echo_writer}


def provider(name: str) -> Provider:
    if name not in PROVIDERS:
        raise ValueError(f"unknown provider {name!r}; known: {', '.join(PROVIDERS)}")
    return PROVIDERS[name]


def patient(ask: Provider, attempts: int = 5, wait: float = 10.0, final: tuple[type[Exception], ...] = (ValueError,)) -> Provider:
    """A provider that is asked again after a failure, up to a number of attempts; ``final`` errors aren't tried again."""
    import time

    def run(prompts: list[str]) -> list[str]:
        for k in range(attempts):
            try:
                return ask(prompts)
            except final:
                raise
            except Exception:
                if k + 1 == attempts:
                    raise
                time.sleep(wait)
        return []

    return run


def batches(runs: DataFrame, providers: dict[str, Provider] | list[str], template: str, label: int) -> DataFrame:
    """Sentences of each run (``batch_id, domain``) from each provider, with their lineage, from prompts made by a template.

    ``batch_id, domain, model_name, base_sentence, sentence_label``; runs are rows, so that Spark deals them out.  Providers are
    named ones or functions by name; runs that repeat are made once.
    """
    ask = providers if isinstance(providers, dict) else {name: provider(name) for name in providers}
    each = runs.select("batch_id", "domain").distinct()
    parts = []
    for name, fn in ask.items():
        asked = each.withColumns({"model_name": F.lit(name), "prompt": tx.composed(template, domain=F.col("domain"), batch=F.col("batch_id").cast("string"))})
        parts.append(generated(asked, "prompt", fn, label))
    return reduce(DataFrame.unionByName, parts)


def rephrased(df: DataFrame, query: str, ask: Provider, column: str = "rephrased") -> DataFrame:
    """Adds the first line that isn't blank of what a provider makes of a query; the query itself where there is none."""
    out = answered(df, query, ask, "_a").withColumn(column, F.coalesce(F.get(tx.lines(F.col("_a")), F.lit(0)), F.col(query)))
    return out.drop("_a")


def extracted(df: DataFrame, id_col: str, answer: str, names: tuple[str, ...] = ("no_property", "source", "target", "date", "outcome")) -> DataFrame:
    """``id`` and a column for each property, read from an answer's lists under 0 to 4; unreadable or absent ones are empty."""
    from ..functions import forecasts as fc

    read = df.select(id_col, fc.python_lists(F.col(answer)).alias("_m"))
    return read.select(id_col, *(F.coalesce(F.col("_m")[str(k)], F.lit("")).alias(n) for k, n in enumerate(names)))
