"""Chat formatting: layouts recognised by a fingerprint of their field paths, turns marked reversibly in one text.

A *fingerprint* is the hash of the sorted paths of all fields of a record, nested ones with dots and lists with
``[]``. Each known layout is a declarative ``Mapping`` from such paths to turns. Records of one table share the
table's schema; JSON records are read one by one, so that a table may hold any mixture of layouts. Records
whose fingerprint no mapping has are returned apart, never dropped in silence.

A formatted conversation is the text of its turns, each ``### role: text</turn>`` and a line end. Inside roles
and texts a backslash stands before every backslash, ``###`` and ``</turn>``, in roles before ``:`` as well, so
the text can be taken apart again exactly. The loss mask lists where the assistant's texts stand.

Defined results: null roles and texts are empty. Turns stand in order of turn number (null first), then role,
then text; repeated turns all stay. Rows with a null conversation id are one conversation. A conversation is one
text, so its turns meet in one task; conversations themselves are dealt by their id.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names that common layouts give the three roles.
ROLE_NAMES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "chatgpt": "assistant"}

FORMATTED = "conv_id long, formatted string, loss array<struct<start:long,length:long>>"
_CONTROL = re.compile(r"\\|###|</turn>")
_ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
_ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)


@dataclass(frozen=True)
class Mapping:
    """How a layout's fields become turns: rows of a table, a list of messages, or a few fields in order."""

    name: str
    conversation: str | None = None  # path of the conversation's id
    turn: str | None = None  # layout of one row per turn: its number, role and text
    role: str | None = None
    text: str | None = None
    messages: str | None = None  # layout of one list: its path, and the fields of an entry
    fields: tuple[tuple[str, str], ...] = ()  # layout of several fields: (role, path), empty ones are skipped

    def paths(self) -> frozenset[str]:
        own = {path for path in (self.conversation, self.turn) if path}
        if self.messages:
            return frozenset(own | {f"{self.messages}[].{self.role}", f"{self.messages}[].{self.text}"})
        return frozenset(own | {path for path in (self.role, self.text) if path} | {path for _, path in self.fields})


MAPPINGS = (
    Mapping("turn rows", conversation="conv_id", turn="turn", role="role", text="text"),
    Mapping("messages", messages="messages", role="role", text="content"),
    Mapping("messages with id", conversation="id", messages="messages", role="role", text="content"),
    Mapping("conversations", messages="conversations", role="from", text="value"),
    Mapping("conversations with id", conversation="id", messages="conversations", role="from", text="value"),
    Mapping("prompt and response", fields=(("user", "prompt"), ("assistant", "response"))),
    Mapping("prompt and completion", fields=(("user", "prompt"), ("assistant", "completion"))),
    Mapping("question and answer", fields=(("user", "question"), ("assistant", "answer"))),
    Mapping("instruction", fields=(("user", "instruction"), ("assistant", "output"))),
    Mapping("instruction with input", fields=(("user", "instruction"), ("user", "input"), ("assistant", "output"))),
    Mapping("instruction with context", fields=(("user", "instruction"), ("user", "context"), ("assistant", "response"))),
    Mapping("system, prompt and response", fields=(("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Mapping("nested turn", fields=(("user", "data.prompt"), ("assistant", "data.response"))),
)


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


BY_FINGERPRINT = {fingerprint(mapping.paths()): mapping for mapping in MAPPINGS}


def schema_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    if isinstance(kind, T.StructType):
        return [path for f in kind.fields for path in schema_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return schema_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def value_paths(value: object, prefix: str = "") -> set[str]:
    if isinstance(value, dict):
        return {path for key, inner in value.items() for path in value_paths(inner, f"{prefix}.{key}" if prefix else key)}
    if isinstance(value, list):
        return {path for inner in value for path in value_paths(inner, f"{prefix}[]")} or {f"{prefix}[]"}
    return {prefix}


def mapping_of(df: DataFrame, mappings: dict[str, Mapping] = BY_FINGERPRINT) -> Mapping:
    """The mapping of a table by its schema; columns that no mapping of the same core names are ignored."""
    paths = set(schema_paths(df.schema))
    exact = mappings.get(fingerprint(paths))
    if exact is not None:
        return exact
    able = [m for m in mappings.values() if m.paths() <= paths]
    if not able:
        raise ValueError(f"no mapping for fields {sorted(paths)}")
    return max(able, key=lambda m: (len(m.paths()), m.name))


def canonical_turns(df: DataFrame, mapping: Mapping | None = None) -> DataFrame:
    """(conv_id, turn, role, text) of any table with a known layout. Role names outside rows are made canonical."""
    mapping = mapping or mapping_of(df)
    conversation = F.col(mapping.conversation).cast("long") if mapping.conversation else F.monotonically_increasing_id()
    if mapping.turn:
        return df.select(
            conversation.alias("conv_id"), F.col(mapping.turn).cast("long").alias("turn"),
            F.coalesce(F.col(mapping.role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(mapping.text).cast("string"), F.lit("")).alias("text"),
        )
    if mapping.messages:
        turns = F.transform(mapping.messages, lambda m: F.struct(_canonical(m[mapping.role]).alias("role"), m[mapping.text].cast("string").alias("text")))
    else:
        turns = F.filter(
            F.array(*[F.struct(F.lit(role).alias("role"), F.col(path).cast("string").alias("text")) for role, path in mapping.fields]),
            lambda turn: F.length(turn["text"]) > 0,
        )
    rows = df.select(conversation.alias("conv_id"), turns.alias("turns")).select("conv_id", F.posexplode("turns").alias("turn", "t"))
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("t.role").alias("role"), F.coalesce("t.text", F.lit("")).alias("text"))


def _canonical(role: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair])
    plain = F.coalesce(F.lower(role.cast("string")), F.lit(""))
    return F.coalesce(names[plain], plain)


def _at(value: object, path: str) -> object:
    for key in path.split("."):
        value = value.get(key) if isinstance(value, dict) else None
    return value


def json_turns(records: DataFrame, id_col: str, json_col: str, mappings: dict[str, Mapping] = BY_FINGERPRINT) -> DataFrame:
    """(conv_id, fingerprint, layout, turn, role, text) of JSON records of any mixture of layouts.

    A record that no mapping fits, or that is no JSON object, gives one row with a null layout and its raw text.
    """

    def turns(mapping: Mapping, value: object) -> list[tuple[str, str]]:
        if mapping.messages:
            entries = _at(value, mapping.messages) or []
            pairs = [(str(m.get(mapping.role) or "").lower(), m.get(mapping.text)) for m in entries]
            return [(ROLE_NAMES.get(role, role), "" if text is None else str(text)) for role, text in pairs]
        if mapping.turn:
            return [(str(_at(value, mapping.role) or ""), str(_at(value, mapping.text) or ""))]
        return [(role, str(text)) for role, path in mapping.fields if (text := _at(value, path)) not in (None, "")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[object, ...]] = []
            for conv, raw in zip(batch.column("conv_id").to_pylist(), batch.column("raw").to_pylist()):
                try:
                    value = json.loads(raw or "")
                except ValueError:
                    value = None
                mark = fingerprint(value_paths(value)) if isinstance(value, dict) else None
                mapping = mappings.get(mark) if mark else None
                if mapping is None:
                    rows.append((conv, mark, None, None, None, raw))
                else:
                    rows += [(conv, mark, mapping.name, k, role, text) for k, (role, text) in enumerate(turns(mapping, value))]
            columns = list(zip(*rows)) if rows else [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["conv_id", "fingerprint", "layout", "turn", "role", "text"])

    source = records.select(F.col(id_col).cast("long").alias("conv_id"), F.col(json_col).alias("raw"))
    return source.mapInArrow(run, "conv_id long, fingerprint string, layout string, turn long, role string, text string")


def escape(text: str, control: re.Pattern[str] = _CONTROL) -> str:
    return control.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: m[1], text)


def write_turns(turns: Iterable[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text, and start and length of each assistant's (escaped) text in code points."""
    parts, loss, length = [], [], 0
    for role, text in turns:
        head, body = f"### {escape(role, _ROLE_CONTROL)}: ", escape(text)
        if role == "assistant":
            loss.append((length + len(head), len(body)))
        parts += [head, body, "</turn>\n"]
        length += len(head) + len(body) + 8
    return "".join(parts), loss


def read_turns(formatted: str) -> list[tuple[str, str]]:
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if found is None:
            raise ValueError(f"no turn at character {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) of canonical turns."""
    grouped = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("turns")
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                written = [write_turns((t["role"], t["text"]) for t in row) for row in part.column("turns").to_pylist()]
                loss = [[{"start": s, "length": n} for s, n in spans] for _, spans in written]
                yield pa.RecordBatch.from_arrays(
                    [part.column("conv_id"), pa.array([text for text, _ in written], pa.string()), pa.array(loss, pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))],
                    ["conv_id", "formatted", "loss"],
                )

    return grouped.mapInArrow(run, FORMATTED)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the formatted texts and their masks hold, by counts and digests of the unescaped turns."""

    def run(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for conv, text, loss in zip(frame["conv_id"], frame["formatted"], frame["loss"]):
                turns = read_turns(text)
                learned = "".join(unescape(text[span["start"] : span["start"] + span["length"]]) for span in loss)
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                rows.append((conv, len(turns), _sha(whole), len(learned), _sha(learned), len(text)))
            out = pd.DataFrame(rows, columns=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])
            yield out.astype({"conv_id": "Int64"})

    return formatted.mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
