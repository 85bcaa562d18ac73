"""Chat formatting by schema fingerprints (operator 13), DataFrame functions only.

Records of one table may hold conversations in many layouts: a list of messages, a
prompt and its answer, an instruction with or without input. The nested paths
of the fields that a record fills (nulls count as absent) are hashed; the hash selects
one of the declared layouts, and the layout says how its fields become turns.

Turns are written as

    <|im_start|>role\\ntext<|im_end|>\\n

In texts and roles a ``<``, any number of backslashes and a ``|`` get one backslash
more, so no text holds a control string and reading takes one backslash off again;
in roles ``%`` and line breaks become ``%25`` and ``%0A``. ``loss`` has a run for each turn:
characters (code points) to skip, to learn (the text of an assistant's turn), and
the rest of the turn; together the runs cover the formatted text.

Odd input: null roles and texts are empty ones; turns come in order of ``turn`` with
nulls last, then by role and text, and repeated rows are turns of their own; rows without
a conversation id form one conversation; a record whose fingerprint no layout has
(an empty list of messages or a record without fields among them) keeps its row with
null ``layout``, ``turns``, ``formatted`` and ``loss``; an empty table gives an empty one. A conversation is one text,
so it has to fit in a row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<role:string,text:string>>"
LEARNED_ROLE = "assistant"
OUTPUTS = ("fingerprint", "layout", "turns", "formatted", "loss")


@dataclass(frozen=True)
class Messages:
    """A list of turns: its path and the fields of role and text in an element;
    ``roles`` renames roles."""

    path: str
    role: str
    text: str
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        return [f"{self.path}[].{self.role}", f"{self.path}[].{self.text}"]

    def turns(self) -> Column:
        return F.transform(field(self.path), lambda m: turn(self._named(m[self.role].cast("string")), m[self.text]))

    def _named(self, role: Column) -> Column:
        for old, new in self.roles:
            role = F.when(role == F.lit(old), F.lit(new)).otherwise(role)
        return role


@dataclass(frozen=True)
class Says:
    """One turn of a fixed role; several fields are joined by an empty line."""

    role: str
    fields: tuple[str, ...]

    def paths(self) -> list[str]:
        return list(self.fields)

    def turns(self) -> Column:
        return F.array(turn(F.lit(self.role), F.concat_ws("\n\n", *[field(f).cast("string") for f in self.fields])))


@dataclass(frozen=True)
class Layout:
    """A declared layout: the parts that give its turns, in order."""

    name: str
    parts: tuple[Messages | Says, ...]

    def paths(self) -> list[str]:
        return sorted(p for part in self.parts for p in part.paths())

    def fingerprint(self) -> str:
        return hashlib.sha256("\n".join(self.paths()).encode()).hexdigest()

    def turns(self) -> Column:
        return F.concat(*[part.turns() for part in self.parts])


SHARED_ROLES = (("human", "user"), ("gpt", "assistant"), ("model", "assistant"), ("bot", "assistant"))
LAYOUTS = (
    Layout("turns", (Messages("turns", "role", "text"),)),
    Layout("messages", (Messages("messages", "role", "content", SHARED_ROLES),)),
    Layout("chat_messages", (Messages("chat.messages", "role", "content", SHARED_ROLES),)),
    Layout("system_and_messages", (Says("system", ("system",)), Messages("messages", "role", "content", SHARED_ROLES))),
    Layout("from_value", (Messages("conversations", "from", "value", SHARED_ROLES),)),
    Layout("prompt_completion", (Says("user", ("prompt",)), Says("assistant", ("completion",)))),
    Layout("prompt_response", (Says("user", ("prompt",)), Says("assistant", ("response",)))),
    Layout("system_prompt_response", (Says("system", ("system",)), Says("user", ("prompt",)), Says("assistant", ("response",)))),
    Layout("instruction_output", (Says("user", ("instruction",)), Says("assistant", ("output",)))),
    Layout("instruction_input_output", (Says("user", ("instruction", "input")), Says("assistant", ("output",)))),
    Layout("question_answer", (Says("user", ("question",)), Says("assistant", ("answer",)))),
)


def quoted(name: str) -> Column:
    """The column of just this name, whatever it is."""
    return F.col(f"`{name.replace('`', '``')}`")


def field(path: str) -> Column:
    """The field of a dotted path."""
    first, *rest = path.split(".")
    found = quoted(first)
    for name in rest:
        found = found.getField(name)
    return found


def turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text.cast("string"), F.lit("")).alias("text"))


Test = Callable[[Column], Column]


def _in_field(name: str, test: Test) -> Test:
    return lambda c: test(c.getField(name))


def _in_some_element(test: Test) -> Test:
    return lambda c: F.coalesce(F.exists(c, lambda e: test(e)), F.lit(False))


def _filled(kind: T.DataType) -> list[tuple[str, Test]]:
    """Paths below a field of this type, each with a test whether a value fills it."""
    if isinstance(kind, T.StructType):
        return [(f".{f.name}{rest}", _in_field(f.name, test)) for f in kind.fields for rest, test in _filled(f.dataType)]
    if isinstance(kind, T.ArrayType):
        return [(f"[]{rest}", _in_some_element(test)) for rest, test in _filled(kind.elementType)]
    return [("", lambda c: c.isNotNull())]


def _record_paths(records: DataFrame, metadata: Sequence[str]) -> list[tuple[str, Column]]:
    fields = [f for f in records.schema.fields if f.name not in metadata]
    tests = [(f.name + rest, test(quoted(f.name))) for f in fields for rest, test in _filled(f.dataType)]
    return sorted(tests, key=lambda t: t[0])


def filled_paths(records: DataFrame, metadata: Sequence[str] = ()) -> Column:
    """Sorted nested paths of the fields that a record fills, ``metadata`` columns left out."""
    tests = _record_paths(records, metadata)
    return F.array_compact(F.array(*[F.when(full, F.lit(path)) for path, full in tests])) if tests else F.array().cast("array<string>")


def _known(records: DataFrame, metadata: Sequence[str], layouts: Sequence[Layout]) -> list[Layout]:
    there = {path for path, _ in _record_paths(records, metadata)}
    return [x for x in layouts if set(x.paths()) <= there]


def survey_layouts(records: DataFrame, metadata: Sequence[str] = (), layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """One row for each fingerprint: ``fingerprint, paths, layout`` (null if no
    layout has it) and the number of ``records``: what a new layout has to cover."""
    paths = records.select(filled_paths(records, metadata).alias("paths"))
    counted = paths.groupBy("paths").agg(F.count(F.lit(1)).alias("records"))
    fingerprint = F.sha2(F.array_join("paths", "\n"), 256)
    names = F.coalesce(*[F.when(fingerprint == F.lit(x.fingerprint()), F.lit(x.name)) for x in layouts], F.lit(None).cast("string"))
    return counted.select(fingerprint.alias("fingerprint"), "paths", names.alias("layout"), "records")


def canonical_turns(records: DataFrame, metadata: Sequence[str] = (), layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """The ``metadata`` columns with ``fingerprint``, ``layout`` and ``turns``, an
    array of (role, text). No two layouts may have the same paths; a metadata column
    with the name of an output gives way to it."""
    known = _known(records, metadata, layouts)
    if len({x.fingerprint() for x in layouts}) < len(layouts):
        raise ValueError("two layouts have the same paths")
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for x in known:
        here = F.col("__fingerprint") == F.lit(x.fingerprint())
        name, turns = F.when(here, F.lit(x.name)).otherwise(name), F.when(here, x.turns()).otherwise(turns)
    keep = [quoted(m) for m in metadata if m not in OUTPUTS]
    hashed = records.withColumn("__fingerprint", F.sha2(F.array_join(filled_paths(records, metadata), "\n"), 256))
    return hashed.select(*keep, F.col("__fingerprint").alias("fingerprint"), name.alias("layout"), turns.alias("turns"))


def gather_turns(rows: DataFrame, conversation: str, order: str, role: str, text: str) -> DataFrame:
    """Rows by turn gathered to records ``conversation, turns`` (role and text)."""
    named = rows.select(
        quoted(conversation).alias("id"), quoted(order).isNull().alias("late"), quoted(order).alias("at"),
        turn(quoted(role).cast("string"), quoted(text)).alias("turn"),
    )
    gathered = named.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("late", "at", "turn.role", "turn.text"))).alias("all"))
    turns = F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return gathered.select(F.col("id").alias(conversation), turns.alias("turns"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _head(t: Column) -> Column:
    return F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"))


def _run(t: Column) -> Column:
    head, text = F.char_length(_head(t)), F.char_length(escape(t["text"]))
    learn = F.when(t["role"] == F.lit(LEARNED_ROLE), text).otherwise(F.lit(0))
    return F.struct(head.alias("skip"), learn.alias("learn"), (text - learn + F.lit(len(END))).alias("rest"))


def format_turns(canonical: DataFrame) -> DataFrame:
    """Adds ``formatted``, the template filled with ``turns``, and ``loss``, its runs."""
    written = F.transform("turns", lambda t: F.concat(_head(t), escape(t["text"]), F.lit(END)))
    return canonical.withColumns({"formatted": F.array_join(written, ""), "loss": F.transform("turns", _run)})


def format_chats(records: DataFrame, metadata: Sequence[str] = (), layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """Records of any declared layouts → ``metadata`` columns, ``fingerprint, layout, turns,
    formatted, loss``; one row for each record, row by row without a shuffle."""
    return format_turns(canonical_turns(records, metadata, layouts))


def _pieces(formatted: Column) -> Column:
    """The turns as written, without their ends."""
    pieces = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.slice(pieces, F.lit(1), F.size(pieces) - F.lit(1))


def _read(piece: Column) -> Column:
    body = F.substr(piece, F.lit(len(START) + 1))
    role = F.substring_index(body, "\n", 1)
    return turn(_unescape_role(role), unescape(F.substr(body, F.char_length(role) + F.lit(2))))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted text holds."""
    return F.transform(_pieces(formatted), _read)


def read_learned(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, unescaped, one for each turn (empty where
    nothing is learned)."""
    cut = F.zip_with(_pieces(formatted), loss, lambda p, run: F.substr(p, run["skip"] + F.lit(1), run["learn"]))
    return F.transform(cut, unescape)
