"""Chat formatting: heterogeneous records become canonical turns, turns become one marked text with a loss mask.

The layout of a record is recognized by a fingerprint: a hash of its sorted nested field
paths selects a declarative mapping. Formatting marks every turn with control strings and
escapes those strings inside texts, so that reading back gives exactly what went in.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"

# The control strings of the template. Other roles are named between ROLE marks.
SYSTEM = ("<<SYS>>", "<</SYS>>")
USER = ("[INST]", "[/INST]")
ASSISTANT = ("<s>", "</s>")
ROLE = ("[ROLE]", "[/ROLE]")
OTHER_END = "[/TURN]"
CONTROLS = (*SYSTEM, *USER, *ASSISTANT, *ROLE, OTHER_END)
_MARKS = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
_CONTROL = re.compile("|".join(map(re.escape, CONTROLS)))
_SCAN = re.compile(r"\\[\s\S]|" + _CONTROL.pattern)

# Names that other layouts give to the three roles.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """How one layout becomes turns: either a list of messages, or single fields with their roles in order.

    ``join`` appends a second field to the first, separated by an empty line, where it is not empty.
    """

    messages: str | None = None
    role: str = ""
    text: str = ""
    fields: tuple[tuple[str, str], ...] = ()
    join: tuple[tuple[str, str], ...] = ()

    def paths(self) -> tuple[str, ...]:
        if self.messages:
            return (self.messages, f"{self.messages}[].{self.role}", f"{self.messages}[].{self.text}")
        return tuple(f for f, _ in self.fields) + tuple(extra for _, extra in self.join)


def fingerprint(paths: Iterable[str]) -> str:
    """Hash of the distinct field paths, whatever their order."""
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


LAYOUTS = (
    Mapping(messages="messages", role="role", text="content"),
    Mapping(messages="messages", role="role", text="text"),
    Mapping(messages="turns", role="role", text="text"),
    Mapping(messages="conversations", role="from", text="value"),
    Mapping(fields=(("prompt", "user"), ("response", "assistant"))),
    Mapping(fields=(("prompt", "user"), ("completion", "assistant"))),
    Mapping(fields=(("system", "system"), ("prompt", "user"), ("response", "assistant"))),
    Mapping(fields=(("question", "user"), ("answer", "assistant"))),
    Mapping(fields=(("instruction", "user"), ("output", "assistant"))),
    Mapping(fields=(("instruction", "user"), ("output", "assistant")), join=(("instruction", "input"),)),
)
BY_FINGERPRINT = {fingerprint(m.paths()): m for m in LAYOUTS}


def schema_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Field paths of a schema; list levels show as ``[]``."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in (f"{at}{f.name}", *schema_paths(f.dataType, f"{at}{f.name}."))]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, at.removesuffix(".") + "[].")
    return []


def value_paths(value: object, at: str = "") -> set[str]:
    """Field paths of one JSON value, as ``schema_paths`` names them."""
    if isinstance(value, dict):
        return {p for k, v in value.items() for p in ({f"{at}{k}"} | value_paths(v, f"{at}{k}."))}
    if isinstance(value, list):
        return {p for v in value for p in value_paths(v, at.removesuffix(".") + "[].")}
    return set()


def _role(role: Column) -> Column:
    named = role
    for other, own in ROLE_NAMES.items():
        named = F.when(role == other, F.lit(own)).otherwise(named)
    return F.coalesce(named, F.lit(""))


def canonical_turns(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` with ``turns`` read from the struct column ``record`` by the mapping its schema selects.

    One schema holds for the whole table, so the mapping is chosen once and runs as column
    functions. A layout no mapping knows is an error. Null roles and texts become empty; a null
    record or list has no turns. An input column ``turns`` is replaced.
    """
    paths = schema_paths(records.schema[record].dataType)
    mapping = BY_FINGERPRINT.get(fingerprint(paths))
    if mapping is None:
        raise ValueError(f"no mapping for the fields {sorted(paths)}")
    whole = F.col(f"`{record}`")

    def text(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit(""))

    def turn(role: Column, value: Column) -> Column:
        return F.struct(role.alias("role"), value.alias("text"))

    if mapping.messages:
        turns = F.transform(whole[mapping.messages], lambda m: turn(_role(m[mapping.role]), text(m[mapping.text])))
        turns = F.coalesce(turns, F.array().cast(TURNS))
    else:
        extra = dict(mapping.join)
        single = []
        for name, role in mapping.fields:
            value = text(whole[name])
            if name in extra:
                more = text(whole[extra[name]])
                value = F.when(more == "", value).otherwise(F.concat(value, F.lit("\n\n"), more))
            single.append(turn(F.lit(role), value))
        turns = F.when(whole.isNull(), F.array().cast(TURNS)).otherwise(F.array(*single).cast(TURNS))
    return records.withColumn("turns", turns)


def json_turns(line: str | None) -> tuple[list[dict[str, str]], str | None]:
    """Turns of one JSON record and the fingerprint; the turns are empty and the reason is given if it can't be read."""
    try:
        value = json.loads(line) if line is not None else None
    except ValueError:
        return [], "not JSON"
    if not isinstance(value, dict):
        return [], "no record"
    mapping = BY_FINGERPRINT.get(fingerprint(value_paths(value)))
    if mapping is None:
        return [], "unknown layout"

    def text(x: object) -> str:
        return "" if x is None else x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)

    if mapping.messages:
        rows = value[mapping.messages]
        if not isinstance(rows, list) or not all(isinstance(m, dict) for m in rows):
            return [], "unknown layout"
        named = [(text(m.get(mapping.role)), text(m.get(mapping.text))) for m in rows]
        return [{"role": ROLE_NAMES.get(r, r), "text": t} for r, t in named], None
    extra = dict(mapping.join)
    out = []
    for name, role in mapping.fields:
        more = text(value.get(extra.get(name)))
        out.append({"role": role, "text": text(value[name]) + (f"\n\n{more}" if more else "")})
    return out, None


def canonical_json(records: DataFrame, column: str = "record") -> DataFrame:
    """``records`` with ``turns`` and ``problem`` for JSON texts whose layout may differ from row to row.

    A record that can't be read keeps its row, with no turns and the reason in ``problem``.
    """
    kept = [c for c in records.columns if c not in ("turns", "problem")]
    schema = records.select(*kept).schema.add("turns", T.ArrayType(T.StructType().add("role", "string").add("text", "string"))).add("problem", "string")

    def run(batches):
        kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
        for batch in batches:
            read = [json_turns(x.as_py()) for x in batch.column(column)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array([t for t, _ in read], kind), pa.array([p for _, p in read], pa.string())],
                names=[*kept, "turns", "problem"],
            )

    return records.select(*kept).mapInArrow(run, schema)


def escape(text: str) -> str:
    """A backslash before every backslash and every control string."""
    return _SCAN_ESCAPE.sub(lambda m: "\\" + m.group(), text)


_SCAN_ESCAPE = re.compile(r"\\|" + _CONTROL.pattern)


def unescape(text: str) -> str:
    return re.sub(r"\\([\s\S])", r"\1", text)


def format_turns(turns: Iterable[tuple[str, str]]) -> tuple[str, list[int]]:
    """The marked text, and the loss mask as first, last + 1, first, ... code points: assistant texts without their marks."""
    parts, mask, at = [], [], 0

    def put(piece: str) -> None:
        nonlocal at
        parts.append(piece)
        at += len(piece)

    for role, text in turns:
        if role in _MARKS:
            opens, closes = _MARKS[role]
            put(opens)
        else:
            closes = OTHER_END
            put(ROLE[0] + escape(role) + ROLE[1])
        first = at
        put(escape(text))
        if role == "assistant":
            mask += [first, at]
        put(closes)
    return "".join(parts), mask


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The turns of a marked text."""
    marks = [m for m in _SCAN.finditer(formatted) if not m.group().startswith("\\")]
    turns, k = [], 0
    opened = {own[0]: role for role, own in _MARKS.items()}
    while k < len(marks):
        here = marks[k].group()
        if here == ROLE[0]:
            role = unescape(formatted[marks[k].end() : marks[k + 1].start()])
            first, end, k = marks[k + 1].end(), marks[k + 2], k + 3
        else:
            role, first, end, k = opened[here], marks[k].end(), marks[k + 1], k + 2
        turns.append((role, unescape(formatted[first : end.start()])))
    return turns


def format_chats(chats: DataFrame) -> DataFrame:
    """``chats`` with ``formatted`` and ``loss_mask`` made of the column ``turns``.

    No turns, or null, give an empty text and mask. Input columns of these names are replaced.
    """
    kept = [c for c in chats.columns if c not in ("formatted", "loss_mask")]
    schema = chats.select(*kept).schema.add("formatted", "string").add("loss_mask", T.ArrayType(T.IntegerType()))

    def run(batches):
        for batch in batches:
            made = [format_turns((t["role"] or "", t["text"] or "") for t in own or []) for own in batch.column("turns").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array([f for f, _ in made], pa.string()), pa.array([m for _, m in made], pa.list_(pa.int32()))],
                names=[*kept, "formatted", "loss_mask"],
            )

    return chats.select(*kept).mapInArrow(run, schema)


def conversation_records(conversations: DataFrame) -> DataFrame:
    """One record per ``conv_id`` from rows of ``conv_id, turn, role, text``, ordered by turn, then role and text; null turns last.

    A conversation is one output row, so its rows meet in one task; repeated rows stay. A null
    ``conv_id`` is a conversation of its own.
    """
    row = F.struct(F.col("turn").isNull().alias("no_turn"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = conversations.select("conv_id", row.alias("row")).groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    messages = F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text")))
    return rows.select("conv_id", F.struct(messages.alias("messages")).alias("record"))


def chat_report(conversations: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from the output.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``.
    """
    made = format_chats(canonical_turns(conversation_records(conversations)).select("conv_id", "turns")).select("conv_id", "formatted", "loss_mask")
    schema = made.select("conv_id").schema
    for name, kind in (("n_turns", "long"), ("turns_sha256", "string"), ("loss_chars", "long"), ("loss_sha256", "string"), ("formatted_chars", "long")):
        schema = schema.add(name, T.DataType.fromDDL(kind))

    def run(batches):
        for batch in batches:
            rows = []
            for text, mask in zip(batch.column("formatted").to_pylist(), batch.column("loss_mask").to_pylist()):
                turns = read_back(text)
                said = "".join(f"{role}\n{value}\n" for role, value in turns)
                loss = "".join(unescape(text[a:b]) for a, b in zip(mask[::2], mask[1::2]))
                rows.append((len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            n, digest, chars, loss_digest, size = zip(*rows) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(chars, pa.int64()),
                 pa.array(loss_digest, pa.string()), pa.array(size, pa.int64())],
                names=schema.names,
            )

    return made.mapInArrow(run, schema)
