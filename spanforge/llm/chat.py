"""Chat formatting: layouts found by a hash of their field paths, mapped to canonical turns, written with a loss mask."""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Layout:
    """How one kind of record becomes turns.

    Either ``each`` names a list whose items hold ``role`` and ``text`` paths, or ``turns`` lists
    (role, text paths) in order; the text paths of a turn that are there are joined by a blank
    line. ``optional`` paths may be missing.
    """

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str = ""
    role: str = ""
    text: str = ""
    optional: tuple[str, ...] = ()
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> set[str]:
        if self.each:
            return {f"{self.each}[].{self.role}:string", f"{self.each}[].{self.text}:string", *(f"{p}:string" for p in self.optional)}
        return {f"{p}:string" for _, texts in self.turns for p in texts}

    def fingerprints(self) -> Iterator[str]:
        """Of every form the layout may take."""
        spare = [f"{p}:string" for p in self.optional]
        for n in range(len(spare) + 1):
            for gone in itertools.combinations(spare, n):
                yield fingerprint(self.paths() - set(gone))


def fingerprint(paths: set[str]) -> str:
    """Hash of a set of nested field paths with their kinds."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


SHARED = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"), ("model", "assistant"))
LAYOUTS = (
    Layout("messages", each="messages", role="role", text="content", optional=("system",)),
    Layout("shared chat", each="conversations", role="from", text="value", optional=("system",), roles=SHARED),
    Layout("dialogue", each="dialogue", role="speaker", text="text", roles=SHARED),
    Layout("prompt and completion", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("completion",))), optional=("system",)),
    Layout("prompt and response", (("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))), optional=("system",)),
    Layout("instruction", (("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))), optional=("system", "input")),
    Layout("question and answer", (("system", ("system",)), ("user", ("context", "question")), ("assistant", ("answer",))), optional=("system", "context")),
    Layout("nested pair", (("user", ("data.question",)), ("assistant", ("data.answer",)))),
)
#: The layout of a table that holds a turn per row; its other columns are free.
ROW_PATHS = frozenset({"conv_id:number", "turn:number", "role:string", "text:string"})
ROWS = fingerprint(set(ROW_PATHS))
BY_FINGERPRINT = {f: x for x in LAYOUTS for f in x.fingerprints()}
KNOWN = set().union(*(x.paths() for x in LAYOUTS))


def paths_of(value: Any, at: str = "") -> set[str]:
    """Field paths of a parsed JSON value, ``a.b[].c:kind``; a field that is null counts as missing."""
    if isinstance(value, dict):
        return set().union(*(paths_of(v, f"{at}.{k}" if at else k) for k, v in value.items()))
    if isinstance(value, list):
        return set().union(*(paths_of(v, f"{at}[]") for v in value))
    if value is None:
        return set()
    return {f"{at}:{'string' if isinstance(value, str) else 'boolean' if isinstance(value, bool) else 'number'}"}


def paths_of_schema(kind: T.DataType, at: str = "") -> set[str]:
    """Field paths of a table's schema."""
    if isinstance(kind, T.StructType):
        return set().union(*(paths_of_schema(f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind.fields))
    if isinstance(kind, T.ArrayType):
        return paths_of_schema(kind.elementType, f"{at}[]")
    return {f"{at}:{'string' if isinstance(kind, T.StringType) else 'number' if isinstance(kind, T.NumericType) else kind.typeName()}"}


def _at(record: Any, path: str) -> Any:
    for part in path.split("."):
        record = record.get(part) if isinstance(record, dict) else None
    return record


def turns_of(record: Any) -> tuple[str | None, list[tuple[str, str]]]:
    """The name of a record's layout and its (role, text) turns; None and no turns if no layout fits."""
    layout = BY_FINGERPRINT.get(fingerprint(paths_of(record) & KNOWN))
    if layout is None:
        return None, []
    if not layout.each:
        parts = [(role, [x for p in texts if (x := _at(record, p)) is not None]) for role, texts in layout.turns]
        return layout.name, [(role, "\n\n".join(x)) for role, x in parts if x]
    names = dict(layout.roles)
    first = [("system", record["system"])] if record.get("system") is not None else []
    items = [(_at(x, layout.role) or "", _at(x, layout.text) or "") for x in _at(record, layout.each)]
    return layout.name, first + [(names.get(r, r), t) for r, t in items]


def canonical_turns(df: DataFrame, key: str = "conv_id", record: str = "record") -> DataFrame:
    """``key, turn, role, text, layout``: the turns of JSON records of any known layout.

    A null or broken record, and one whose layout isn't known, gives one row with null turn, role,
    text and layout, so that nothing goes unseen. Fields that no layout knows don't matter; a null
    field counts as missing, a null role or text inside a list as empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, rows = [], []
            for i, x in enumerate(b.column(1)):
                try:
                    name, turns = turns_of(json.loads(x.as_py() or "null"))
                except ValueError:
                    name, turns = None, []
                more = [(k, r, t, name) for k, (r, t) in enumerate(turns)] or [(None, None, None, None)]
                at += [i] * len(more)
                rows += more
            cols = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *cols], names=[key, "turn", "role", "text", "layout"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, record).mapInArrow(run, f"`{key}` {kind}, turn long, role string, text string, layout string")


def turn_rows(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """``key, turn, role, text`` of a table in any known layout, chosen by the fingerprint of its schema.

    A table with a turn per row is read as it is; any other is read record by record.
    """
    paths = paths_of_schema(df.schema)
    if fingerprint(paths & ROW_PATHS) == ROWS:
        return df.select("conv_id", "turn", "role", "text")
    if not paths & KNOWN:
        raise ValueError("no layout fits this table")
    records = df.select(F.col(key).alias("conv_id"), F.to_json(F.struct(*[c for c in df.columns if c != key])).alias("record"))
    return canonical_turns(records).select("conv_id", "turn", "role", "text")


#: Written names of the usual roles; any other is written as ``Role=name``.
NAMES = {"system": "System", "user": "User", "assistant": "Assistant", "tool": "Tool"}
_ROLES = {v: k for k, v in NAMES.items()}
_CONTROL = re.compile(r"\\|### |</turn>")
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*): ((?:[^\\<]|\\.|<(?!/turn>))*)</turn>\n", re.S)
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    """A backslash before each backslash and each control string of the template."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def write_turn(role: str, text: str) -> tuple[str, int, int]:
    """A turn as written, and start and length of its part under the loss mask (length 0: none)."""
    name = NAMES.get(role) or "Role=" + escape(role).replace(":", "\\:")
    head, body = f"### {name}: ", escape(text)
    return f"{head}{body}</turn>\n", len(head), len(body) if role == "assistant" else 0


def read_turns(written: str) -> list[tuple[str, str]]:
    """(role, text) of all turns of a written conversation; anything else in it is an error."""
    out, at = [], 0
    while at < len(written):
        m = _TURN.match(written, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        name = m[1]
        out.append((_ROLES[name] if name in _ROLES else unescape(name.removeprefix("Role=")), unescape(m[2])))
        at = m.end()
    return out


def write_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, written, mask_start, mask_length`` (in code points), a row per turn; null role and text are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [write_turn(r or "", t or "") for r, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)]
            cols = [pa.array([x[k] for x in rows], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *cols], names=["conv_id", "turn", "written", "mask_start", "mask_length"])

    kind = {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    schema = f"conv_id {kind['conv_id']}, turn {kind['turn']}, written string, mask_start long, mask_length long"
    return turns.select("conv_id", "turn", "role", "text").mapInArrow(run, schema)


class _Digest:
    def __init__(self, conv):
        self.conv, self.n, self.loss_chars, self.chars = conv, 0, 0, 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, written: str, start: int, length: int) -> None:
        for role, text in read_turns(written):
            self.n += 1
            self.turns.update(f"{role}\n{text}\n".encode())
        masked = unescape(written[start : start + length])
        self.loss.update(masked.encode())
        self.loss_chars += len(masked)
        self.chars += len(written)

    def row(self) -> tuple:
        return self.conv, self.n, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


FIELDS = (("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()))


def digests(written: DataFrame) -> DataFrame:
    """What each written conversation reads back as: turns, text under the loss mask, length.

    Turns of a conversation are taken in order of ``turn`` (nulls first, ties by the written
    form). They pass through in sorted order, so a conversation of any length needs the memory
    of one turn; its two hashes are sequential by definition. Rows with null id are one conversation.
    """
    kind = written.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Digest | None = None

        def out(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate([id_type, *(t for _, t in FIELDS)])], names=["conv_id", *(n for n, _ in FIELDS)])

        id_type = None
        for b in batches:
            done, id_type = [], b.schema.field(0).type
            for conv, text, start, length in zip(*(b.column(i).to_pylist() for i in (0, 2, 3, 4)), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(text, start, length)
            yield out(done, id_type)
        if now is not None:
            yield out([now.row()], id_type)

    n = int(written.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = written.repartition(n, "conv_id").sortWithinPartitions("conv_id", "turn", "written")
    schema = f"conv_id {kind}, " + ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in FIELDS)
    return dealt.mapInArrow(run, schema)


def conversations(written: DataFrame) -> DataFrame:
    """``conv_id, text, masks``: whole written conversations and their loss spans, for readers that want one row each.

    A conversation is one training record, so it is gathered into one row.
    """
    turns = written.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "written", "mask_start", "mask_length"))).alias("t"))
    before = F.aggregate("t", F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("m")), lambda a, x: F.struct(
        (a["at"] + F.char_length(x["written"])).alias("at"),
        F.when(x["mask_length"] > 0, F.concat(a["m"], F.array(F.struct((a["at"] + x["mask_start"]).alias("start"), x["mask_length"].alias("length"))))).otherwise(a["m"]).alias("m"),
    ))
    return turns.select("conv_id", F.concat_ws("", F.col("t.written")).alias("text"), before["m"].alias("masks"))
