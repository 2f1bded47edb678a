"""Chat formatting: records of many layouts become turns, turns become marked text with a loss mask, and back.

A layout is known by its schema's fingerprint: the nested field paths that any mapping names (``messages[].role``), sorted and
hashed.  A table's fingerprint comes from its schema, once; a JSON record's from its own fields, so that one column may
hold records of many layouts.  The fingerprint selects a declarative ``Mapping``, which says where turns, roles and texts are;
further fields don't matter.

Turns are written one after the other between marks (``MARKS``; other roles are named in their mark).  A text may hold the marks
themselves: there each gets a backslash in front, and backslashes right before a mark or at a text's end are doubled,
so that a mark is real where an even number of backslashes precedes it.  The loss mask has the place of each
assistant's text.  A conversation is cut into segments between turns once it is longer than ``SEGMENT``
characters, so that neither a task nor a row ever holds a whole conversation of any length.

Cases: a null text is empty, a null role too; rows of a conversation are ordered by turn (null last), then role and text,
so that rows that tie or repeat each stay a turn; rows with a null id are one conversation with a null id; records that
match no mapping (fields missing, wrong types, no JSON, null) give no turns but are returned by ``unmapped``; empty tables give no
rows; columns that no mapping names are not looked at.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import spread, table, text_chunks


@dataclass(frozen=True)
class Mapping:
    """How one layout's fields become turns.

    ``fields``: (role, paths) in order, a turn each, of which paths after the first are put below it where they aren't
    empty.  ``items``: path of an array of turns, with the names of its ``role`` and ``text`` fields.  ``rows``: a row is
    a turn, with the names of its ``conversation``, ``turn``, ``role`` and ``text``.  ``roles`` renames roles.
    """

    name: str
    fields: tuple[tuple[str, tuple[str, ...]], ...] = ()
    items: tuple[str, str, str] | None = None
    rows: tuple[str, str, str, str] | None = None
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def paths(self) -> frozenset[str]:
        if self.rows:
            return frozenset(self.rows)
        listed = {f"{self.items[0]}[].{x}" for x in self.items[1:]} if self.items else set()
        return frozenset(listed | {p for _, ps in self.fields for p in ps})


SPEAKERS = {"human": "user", "gpt": "assistant", "bot": "assistant", "ai": "assistant", "model": "assistant"}
MAPPINGS = (
    Mapping("rows", rows=("conv_id", "turn", "role", "text")),
    Mapping("messages", items=("messages", "role", "content")),
    Mapping("system_messages", fields=(("system", ("system",)),), items=("messages", "role", "content")),
    Mapping("conversations", items=("conversations", "from", "value"), roles=SPEAKERS),
    Mapping("system_conversations", fields=(("system", ("system",)),), items=("conversations", "from", "value"), roles=SPEAKERS),
    Mapping("dialogue", items=("dialogue.turns", "speaker", "utterance"), roles=SPEAKERS),
    Mapping("prompt_completion", fields=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Mapping("prompt_response", fields=(("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("system_prompt_response", fields=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",)))),
    Mapping("question_answer", fields=(("user", ("question",)), ("assistant", ("answer",)))),
    Mapping("instruction", fields=(("user", ("instruction",)), ("assistant", ("output",)))),
    Mapping("instruction_input", fields=(("user", ("instruction", "input")), ("assistant", ("output",)))),
    Mapping("system_instruction_input", fields=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",)))),
)


def fingerprint(paths) -> str:
    """Hash of a set of nested field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


class Layouts:
    """Mappings by fingerprint."""

    def __init__(self, mappings: tuple[Mapping, ...] = MAPPINGS):
        # A layout of rows is looked for last: its columns, an id say, may stand beside records of another one.
        kinds = ([m for m in mappings if not m.rows], [m for m in mappings if m.rows])
        self.groups = [(frozenset().union(*(m.paths() for m in kind)), {fingerprint(m.paths()): m for m in kind}) for kind in kinds]
        if sum(len(by_print) for _, by_print in self.groups) < len(mappings):
            raise ValueError("two mappings have the same field paths")

    def find(self, paths) -> Mapping | None:
        paths = frozenset(paths)
        prints = [by_print.get(fingerprint(named & paths)) for named, by_print in self.groups]
        return prints[0] or prints[1]


def schema_paths(kind: T.DataType, at: str = "") -> Iterator[str]:
    """The nested field paths of a schema's leaves."""
    if isinstance(kind, T.StructType):
        for f in kind:
            yield from schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)
    elif isinstance(kind, T.ArrayType):
        yield from schema_paths(kind.elementType, f"{at}[]")
    else:
        yield at


def value_paths(value, at: str = "") -> Iterator[str]:
    """The nested field paths of a parsed JSON value's leaves: what its schema would have."""
    if isinstance(value, dict):
        for name, x in value.items():
            yield from value_paths(x, f"{at}.{name}" if at else name)
    elif isinstance(value, list):
        for x in value:
            yield from value_paths(x, f"{at}[]")
    else:
        yield at


def table_turns(df: DataFrame, id_col: str = "conv_id", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``conv_id, turn, role, text`` of a table whose schema has one of the layouts."""
    m = Layouts(mappings).find(schema_paths(df.schema))
    if m is None:
        raise ValueError(f"no mapping for the field paths {sorted(schema_paths(df.schema))}")
    if m.rows:
        key, turn, role, text = map(F.col, m.rows)
        return df.select(key.alias("conv_id"), turn.cast("long").alias("turn"), _role(role, m).alias("role"), text.cast("string").alias("text"))
    turn = lambda role, text: F.struct(role.alias("role"), text.cast("string").alias("text"))
    parts = []
    if m.fields:
        parts.append(F.array(*(turn(F.lit(role), _below([F.col(p) for p in paths])) for role, paths in m.fields)))
    if m.items:
        path, role, text = m.items
        parts.append(F.coalesce(F.transform(path, lambda x: turn(_role(x[role], m), x[text])), F.array().cast("array<struct<role:string,text:string>>")))
    found = df.select(F.col(id_col).alias("conv_id"), F.posexplode(F.concat(*parts)).alias("turn", "_t"))
    return found.select("conv_id", F.col("turn").cast("long").alias("turn"), "_t.role", "_t.text")


def _role(role, m: Mapping):
    role = role.cast("string")
    named = F.create_map(*(F.lit(x) for pair in m.roles.items() for x in pair)) if m.roles else None
    return role if named is None else F.coalesce(F.try_element_at(named, role), role)


def _below(columns):
    first, *more = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    for c in more:
        first = F.when(c == "", first).otherwise(F.concat(first, F.lit("\n\n"), c))
    return first


def _at(value, path: str):
    for name in path.split("."):
        value = value.get(name) if isinstance(value, dict) else None
    return value


def _text(value) -> str | None:
    return value if value is None or isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def parsed(raw: str | None):
    """A JSON value; None if the text isn't one, or holds half a surrogate pair, which no string column can."""
    try:
        value = json.loads(raw)
        json.dumps(value, ensure_ascii=False).encode()
        return value
    except (TypeError, ValueError, RecursionError):
        return None


def record_turns(raw: str | None, layouts: Layouts) -> list[tuple[str | None, str | None]] | None:
    """Turns of a JSON record; None without a mapping."""
    value = parsed(raw)
    m = layouts.find(value_paths(value)) if isinstance(value, dict) else None
    if m is None or m.rows:
        return None
    out = []
    for role, paths in m.fields:
        first, *more = [_text(_at(value, p)) or "" for p in paths]
        out.append((role, "\n\n".join([first, *filter(None, more)])))
    if m.items:
        listed = _at(value, m.items[0])
        if not isinstance(listed, list) or not all(isinstance(x, dict) for x in listed):
            return None
        for x in listed:
            role = _text(x.get(m.items[1]))
            out.append((m.roles.get(role, role), _text(x.get(m.items[2]))))
    return out


def json_turns(df: DataFrame, column: str, id_col: str = "conv_id", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``conv_id, turn, role, text`` of JSON records, each in whichever layout its fields' fingerprint selects."""
    return _records(df, column, id_col, mappings).where("turn is not null").select("conv_id", "turn", "role", "text")


def unmapped(df: DataFrame, column: str, id_col: str = "conv_id", mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """``conv_id, record``: the records that no mapping fits."""
    return _records(df, column, id_col, mappings).where("turn is null").select("conv_id", F.col("text").alias("record"))


def _records(df: DataFrame, column: str, id_col: str, mappings: tuple[Mapping, ...]) -> DataFrame:
    layouts = Layouts(mappings)
    rows = df.select(F.col(id_col).alias("conv_id"), F.col(column).alias("text"))

    def run(batches):
        for batch in batches:
            for part in text_chunks(batch, "text", 1 << 24):
                at, turn, role, text = [], [], [], []
                for i, raw in enumerate(part.column(1).to_pylist()):
                    found = record_turns(raw, layouts)
                    for k, (r, t) in enumerate([(None, raw)] if found is None else found):
                        at.append(i)
                        turn.append(None if found is None else k)
                        role.append(r)
                        text.append(t)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(at, pa.int64())), pa.array(turn, pa.int64()), pa.array(role, pa.string()), pa.array(text, pa.string())], ["conv_id", "turn", "role", "text"])

    return rows.mapInArrow(run, f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, turn long, role string, text string")


#: Marks before and after a turn's text, by role.  No mark begins inside another one.
MARKS = {"system": ("[SYS]", "[/SYS]"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
#: Around the turns of any other role: the role stands between the first and the second.
OTHER = ("[ROLE]", "[TEXT]", "[/ROLE]")
LOSS = "assistant"
#: Characters after which a new segment begins, about.
SEGMENT = 1 << 20
CONTROL = "|".join(re.escape(x) for x in [*(m for pair in MARKS.values() for m in pair), *OTHER])
#: A control string with all backslashes before it; they are looked for from their first one only, so that long runs stay linear.
MARKED = re.compile(rf"(?:(?<!\\)(\\+))?({CONTROL})")
ENDING = re.compile(r"(?<!\\)\\+\Z")
FORMATTED = "segment long, formatted string, loss array<struct<start:long,length:long>>, chars long"


def escaped(text: str) -> str:
    """A text without real marks: see the module's rule on backslashes."""
    text = MARKED.sub(lambda m: f"{(m[1] or '') * 2}\\{m[2]}", text)
    return ENDING.sub(lambda m: m[0] * 2, text)


def unescaped(text: str) -> str:
    """The inverse of ``escaped``."""
    text = ENDING.sub(lambda m: m[0][: len(m[0]) // 2], text)
    return MARKED.sub(lambda m: f"{'\\' * (len(m[1] or '') // 2)}{m[2]}", text)


def turn_text(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A marked turn, and where in it the escaped text begins and how long it is."""
    role, body = role or "", escaped(text or "")
    if role in MARKS:
        before, after = MARKS[role]
    else:
        before, after = f"{OTHER[0]}{escaped(role)}{OTHER[1]}", OTHER[2]
    return f"{before}{body}{after}", len(before), len(body)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of formatted text; an error where marks don't fit together."""
    opening = {before: (role, after) for role, (before, after) in MARKS.items()}
    out, at, wanted, role = [], 0, None, ""
    for m in MARKED.finditer(formatted):
        slashes = len(m[1] or "")
        if slashes % 2:
            continue
        if wanted is None:
            if m.start() != at or slashes:
                raise ValueError("text outside of turns")
            role, wanted = opening.get(m[2], ("", OTHER[1] if m[2] == OTHER[0] else None))
            if wanted is None:
                raise ValueError(f"{m[2]} opens no turn")
        elif m[2] != wanted:
            raise ValueError(f"{m[2]} where {wanted} is due")
        elif wanted == OTHER[1]:
            role, wanted = unescaped(formatted[at : m.end() - len(m[2])]), OTHER[2]
        else:
            out.append((role, unescaped(formatted[at : m.end() - len(m[2])])))
            wanted = None
        at = m.end()
    if wanted is not None or at != len(formatted):
        raise ValueError("the last turn isn't closed")
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[dict]:
    for part in text_chunks(batch, batch.schema.names[-1], 1 << 24):
        yield from part.to_pylist()


def format_turns(turns: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``conv_id, segment, formatted, loss, chars``: marked turns in order, and places of what the loss counts.

    ``conv_id, turn, role, text`` come in any order; a conversation's segments come out in order in one partition.
    """
    key = turns.schema["conv_id"].dataType
    arrow = T.StructType.fromDDL(f"conv_id {key.simpleString()}, {FORMATTED}")
    ordered = spread(turns.select("conv_id", "turn", "role", "text"), 0, "conv_id").sortWithinPartitions(F.asc_nulls_last("conv_id"), F.asc_nulls_last("turn"), "role", "text")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        shape = to_arrow_schema(arrow)
        now, number, size, pieces, loss, held, waiting = object(), 0, 0, [], [], [], 0

        def close():
            held.append({"conv_id": now, "segment": number, "formatted": "".join(pieces), "loss": [{"start": a, "length": b} for a, b in loss], "chars": size})

        def batch():
            done = pa.RecordBatch.from_pylist(held, shape)
            held.clear()
            return done

        for b in batches:
            for r in _slices(b):
                new = r["conv_id"] != now
                if pieces and (new or size >= segment):
                    close()
                    waiting += size
                    number, size, pieces, loss = number + 1, 0, [], []
                    if len(held) >= 2000 or waiting >= 1 << 23:
                        yield batch()
                        waiting = 0
                if new:
                    now, number = r["conv_id"], 0
                piece, start, length = turn_text(r["role"], r["text"])
                if r["role"] == LOSS:
                    loss.append((size + start, length))
                pieces.append(piece)
                size += len(piece)
        if pieces:
            close()
        if held:
            yield batch()

    return ordered.mapInArrow(run, arrow)


def in_order(formatted: DataFrame) -> DataFrame:
    """A stored table of segments with those of a conversation one after the other, as ``read_back`` needs them."""
    return spread(formatted, 0, "conv_id").sortWithinPartitions(F.asc_nulls_last("conv_id"), "segment")


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, by parsing what was formatted.

    Hashes run along a conversation's segments, of which one at a time is in memory.
    """
    schema = T.StructType.fromDDL(f"conv_id {formatted.schema['conv_id'].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        shape, now, rows, state = to_arrow_schema(schema), object(), [], None

        def close():
            n, turns, count, loss, chars = state
            rows.append({"conv_id": now, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": count, "loss_sha256": loss.hexdigest(), "formatted_chars": chars})

        for b in batches:
            for r in _slices(b):
                if state is None or r["conv_id"] != now:
                    if state is not None:
                        close()
                    now, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = r["formatted"]
                for role, said in read_turns(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode())
                for place in r["loss"]:
                    said = unescaped(text[place["start"] : place["start"] + place["length"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
            if len(rows) >= 2000:
                yield pa.RecordBatch.from_pylist(rows, shape)
                rows = []
        if state is not None:
            close()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, shape)

    return formatted.select("conv_id", "segment", "loss", "formatted").mapInArrow(run, schema)


#: A conversation that says control strings, as a record of another layout.
CONTROLS = '{"messages": [{"role": "user", "content": "</s>[INST] ok [/INST]"}, {"role": "assistant", "content": "</s>[INST] ok [/INST]"}]}'


def op12_chat_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table_turns(table(spark, sf_dir, "conversations"))
    more = json_turns(spark.createDataFrame([(-1, CONTROLS)], "conv_id long, record string"), "record")
    return read_back(format_turns(rows.unionByName(more)))
