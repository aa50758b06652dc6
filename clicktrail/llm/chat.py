"""Chat formatting with schema fingerprinting.

A record's layout is recognised by hashing the sorted nested field paths that
it fills; the hash selects a declarative mapping that turns the record into
canonical turns. Turns are rendered with a template whose control strings are
escaped inside texts, and a loss mask marks the assistant texts. Everything is
DataFrame expressions.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role:string,text:string>>"

#: Control strings of the template.
CONTROL = r"</?s>|\[/?INST\]|\[/?SYS\]|\[/?ROLE\]"
#: In a text, the opener of a control string is followed by one backslash more than in the original.
ESCAPABLE = r"([<\[])(\\*)(/?s>|/?INST\]|/?SYS\]|/?ROLE\])"
ESCAPED = r"([<\[])(\\*)\\(/?s>|/?INST\]|/?SYS\]|/?ROLE\])"
BEGIN, END = "<s>", "</s>"
USER, SYSTEM = ("[INST] ", " [/INST]"), ("[SYS] ", " [/SYS]")
#: Any other role is written out.
ROLE = ("[ROLE]", "[/ROLE]")

#: Role names of other layouts in canonical form.
ALIASES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """A declarative mapping. ``turns`` are (role, field path); ``items`` is (array, role field, text field)."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()
    turns: tuple[tuple[str, str], ...] = ()
    items: tuple[str, str, str] | None = None
    aliases: bool = False

    def path_sets(self):
        for n in range(len(self.optional) + 1):
            for extra in itertools.combinations(self.optional, n):
                yield tuple(sorted({*self.required, *extra}))


LAYOUTS = (
    Layout("messages", ("messages[].role", "messages[].content"), items=("messages", "role", "content")),
    Layout(
        "conversations",
        ("conversations[].from", "conversations[].value"),
        items=("conversations", "from", "value"),
        aliases=True,
    ),
    Layout(
        "prompt",
        ("prompt", "completion"),
        ("system",),
        turns=(("system", "system"), ("user", "prompt"), ("assistant", "completion")),
    ),
    Layout(
        "instruction",
        ("instruction", "output"),
        ("input", "system"),
        turns=(("system", "system"), ("user", "instruction"), ("user", "input"), ("assistant", "output")),
    ),
)

#: A frame that holds every known layout; absent layouts are null.
RECORD = T.StructType(
    [
        T.StructField("messages", T.ArrayType(T.StructType().add("role", "string").add("content", "string"))),
        T.StructField("conversations", T.ArrayType(T.StructType().add("from", "string").add("value", "string"))),
        *[T.StructField(c, T.StringType()) for c in ("system", "prompt", "completion", "instruction", "input", "output")],
    ]
)


def leaf_paths(record: T.StructType) -> dict[str, Callable[[Column], Column]]:
    """Nested field paths of a schema, and for each how to see whether a record fills it.

    A field of an array's elements counts as filled if the array is not null:
    an element may leave it null, which is a null text and not another layout.
    """
    found = {}
    for field in record:
        name, kind = field.name, field.dataType
        present = lambda row, name=name: row[name].isNotNull()
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            found |= {f"{name}[].{inner.name}": present for inner in kind.elementType}
        elif isinstance(kind, T.StructType):
            for path, inner in leaf_paths(kind).items():
                found[f"{name}.{path}"] = lambda row, name=name, inner=inner: inner(row[name])
        else:
            found[name] = present
    return found


def fingerprint(record: Column, schema: T.StructType, layouts=LAYOUTS) -> Column:
    """Hash of the field paths a record fills, as far as any layout knows them; extra fields do not matter."""
    known = {path for layout in layouts for path in (*layout.required, *layout.optional)}
    paths = {p: see for p, see in leaf_paths(schema).items() if p in known}
    filled = F.array(*[F.when(paths[p](record), F.lit(p)) for p in sorted(paths)])
    return F.xxhash64(F.array_join(F.filter(filled, lambda p: p.isNotNull()), "\n"))


def _field(record: Column, path: str) -> Column:
    for part in path.split("."):
        record = record[part]
    return record


def _layout_turns(record: Column, layout: Layout) -> Column:
    blank = lambda c: F.coalesce(c, F.lit(""))
    if layout.items:
        array, role, text = layout.items
        name = lambda item: blank(item[role])
        if layout.aliases:
            alias = F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])
            name = lambda item: F.coalesce(alias[F.lower(item[role])], blank(item[role]))
        return F.transform(
            _field(record, array), lambda item: F.struct(name(item).alias("role"), blank(item[text]).alias("text"))
        )
    parts = [
        F.when(_field(record, path).isNotNull(), F.struct(F.lit(role).alias("role"), _field(record, path).alias("text")))
        for role, path in layout.turns
    ]
    return F.filter(F.array(*parts), lambda turn: turn.isNotNull())


def canonical_turns(record: Column, schema: T.StructType, layouts=LAYOUTS) -> tuple[Column, Column]:
    """Layout name and canonical turns of a record column; both null if no layout has its fingerprint."""
    seen, have = fingerprint(record, schema, layouts), set(leaf_paths(schema))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        for paths in layout.path_sets():
            if set(paths) <= have:
                is_it = seen == F.xxhash64(F.lit("\n".join(paths)))
                name = F.when(is_it, F.lit(layout.name)).otherwise(name)
                turns = F.when(is_it, _layout_turns(record, _restricted(layout, have)).cast(TURNS)).otherwise(turns)
    return name, turns


def _restricted(layout: Layout, have: set[str]) -> Layout:
    turns = tuple(t for t in layout.turns if t[1] in have)
    return Layout(layout.name, layout.required, layout.optional, turns, layout.items, layout.aliases)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPABLE, r"$1$2\\$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _before(turn: Column) -> Column:
    role = turn["role"]
    return (
        F.when(role == "user", BEGIN + USER[0])
        .when(role == "system", BEGIN + SYSTEM[0])
        .when(role == "assistant", BEGIN)
        .otherwise(F.concat(F.lit(BEGIN + ROLE[0]), escape(role), F.lit(ROLE[1])))
    )


def _after(turn: Column) -> Column:
    role = turn["role"]
    return F.when(role == "user", USER[1] + END).when(role == "system", SYSTEM[1] + END).otherwise(END)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often lambdas inside refer to it."""
    return F.transform(F.array(value), use)[0]


def _running(lengths: Column, start: Column) -> Column:
    """For each length the sum of ``start`` and all lengths before it. The work grows with the square of their number."""
    begin = F.struct(start.alias("at"), F.expr("cast(array() as array<bigint>)").alias("starts"))
    step = lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts"))
    return F.aggregate(lengths, begin, step, lambda s: s["starts"])


def running_starts(lengths: Column) -> Column:
    """Where each of consecutive pieces starts, by their lengths (an array of longs).

    Blocks of about the square root of their number are summed, the sums are
    added up, and each block on its own from there.
    """
    zero = F.lit(0).cast("long")

    def blockwise(all_lengths):
        n = F.greatest(F.size(all_lengths), F.lit(1))
        block = F.ceil(F.sqrt(n)).cast("int")
        numbers = F.sequence(F.lit(0), F.ceil(n / block).cast("int") - 1)
        return _let(F.transform(numbers, lambda k: F.slice(all_lengths, k * block + 1, block)), joined)

    def joined(blocks):
        sums = F.transform(blocks, lambda b: F.aggregate(b, zero, lambda total, n: total + n))
        return F.flatten(F.zip_with(blocks, _running(sums, zero), _running))

    return _let(lengths, blockwise)


def format_turns(turns: Column) -> tuple[Column, Column]:
    """The formatted text, and its loss mask: (start, length) of each escaped assistant text, in code points from 0."""
    pieces = F.transform(
        turns,
        lambda turn: F.struct(
            _before(turn).alias("before"), escape(turn["text"]).alias("text"), _after(turn).alias("after"), turn["role"].alias("role")
        ),
    )
    text = F.array_join(F.transform(pieces, lambda p: F.concat(p["before"], p["text"], p["after"])), "")

    def mask(parts):
        lengths = F.transform(parts, lambda p: (F.length(p["before"]) + F.length(p["text"]) + F.length(p["after"])).cast("long"))

        def span(p, start):
            at = (start + F.length(p["before"])).cast("long").alias("start")
            return F.when(p["role"] == "assistant", F.struct(at, F.length(p["text"]).cast("long").alias("length")))

        return F.filter(F.zip_with(parts, running_starts(lengths), span), lambda s: s.isNotNull())

    return text, _let(pieces, mask)


def format_records(records: DataFrame, schema: T.StructType = RECORD, layouts=LAYOUTS) -> DataFrame:
    """One row per record: ``record`` (all its columns), layout, turns, formatted, loss.

    ``schema`` names the layout columns to look at; columns outside it are
    carried along and never read. A record that fits no layout has null in all
    new columns. Null roles and texts are empty strings; an empty array gives
    no turns and an empty formatted text; an empty table gives no rows. Any role
    is written out and read back. The work for a conversation of n turns grows
    with n times its square root at most, in copied numbers, and with its text.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias("record")
    present = T.StructType([f for f in schema if f.name in records.columns])
    name, turns = canonical_turns(F.col("record"), present, layouts)
    shaped = records.select(row).select("record", name.alias("layout"), turns.alias("turns"))
    formatted, loss = format_turns(F.col("turns"))
    return shaped.select("record", "layout", "turns", formatted.alias("formatted"), loss.alias("loss"))


def parse_turns(formatted: Column) -> Column:
    """Canonical turns read back from a formatted text."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")

    def turn(piece):
        body = F.substring(piece, len(BEGIN) + 1, 2**31 - 1)
        inner = lambda marks: F.substring(body, F.lit(len(marks[0]) + 1), F.length(body) - sum(map(len, marks)))
        role_end = F.instr(body, ROLE[1])
        named = body.startswith(ROLE[0])
        role = (
            F.when(body.startswith(USER[0]), "user")
            .when(body.startswith(SYSTEM[0]), "system")
            .when(named, unescape(F.substring(body, F.lit(len(ROLE[0]) + 1), role_end - len(ROLE[0]) - 1)))
            .otherwise("assistant")
        )
        text = (
            F.when(body.startswith(USER[0]), inner(USER))
            .when(body.startswith(SYSTEM[0]), inner(SYSTEM))
            .when(named, F.substring(body, role_end + len(ROLE[1]), F.length(body)))
            .otherwise(body)
        )
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)


def loss_texts(formatted: Column, loss: Column) -> Column:
    """The unescaped texts under the loss mask, in order.

    Spans are cut from the text in four bytes a code point, where each starts at
    a known byte. A byte-order mark goes before each, so that one at the start
    of a text stays. A formatted text has 2**29 code points at most.
    """
    mark = F.lit(bytes([0, 0, 0xFE, 0xFF]))

    def cut(wide):
        inner = lambda span: F.substring(wide, (span["start"] * 4 + 1).cast("int"), (span["length"] * 4).cast("int"))
        return F.transform(loss, lambda span: unescape(F.decode(F.concat(mark, inner(span)), "UTF-32")))

    return _let(F.encode(formatted, "UTF-32"), cut)


def conversations_of(turn_rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) gathered to one row per conversation, its turns in order.

    Ties in ``turn`` are ordered by role and text. A row without conv_id
    belongs to no other row and is a conversation of its own.
    """
    alone = F.when(F.col("conv_id").isNull(), F.monotonically_increasing_id())
    item = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return (
        turn_rows.groupBy("conv_id", alone.alias("alone"))
        .agg(F.array_sort(F.collect_list(item)).alias("items"))
        .drop("alone")
    )
