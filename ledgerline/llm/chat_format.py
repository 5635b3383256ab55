"""Chat formatting by schema fingerprint.

Records of different layouts (one turn, message lists, prompt and completion, instruction)
arrive as JSON.  A record's nested field paths, without the types of its leaves, are hashed;
the hash selects a declared mapping that turns the record into canonical turns.  Turns are then
written by one template that marks where each begins and ends.

Everything is a DataFrame expression.  Defined results: a null or malformed record, or one of
an undeclared layout, has a null layout and no turns (it stays as one row of
``canonical_turns`` and has no text to format); a null role or text is empty; turns of one
conversation are ordered by the given columns, then position, role and text, so that ties and
repeated rows have one order; columns that are not named are ignored; an empty table gives no rows.  A
formatted conversation is one row, so a conversation must fit in one row; turns before that are rows of
their own.  Structs may hold texts of any length; of JSON records the parser takes strings of up to about
20 million characters, and a record with a longer one counts as malformed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The template.  A control string inside a text gets a backslash before its last part.
BEGIN, AFTER_ROLE, END = "### ", ": ", "</turn>\n"

#: Control strings as patterns around the run of backslashes, and how they are written.
CONTROLS = ((r"<(\\*)/turn>", r"<\\(\\*)/turn>", "<", "/turn>"), (r"###(\\*) ", r"###\\(\\*) ", "###", " "))
ROLE_CONTROL = (r":(\\*) ", r":\\(\\*) ", ":", " ")


@dataclass(frozen=True)
class Part:
    """A turn taken from a record: a role (fixed, or at a path) and the paths whose texts it joins."""

    texts: tuple[str, ...]
    role: str | None = None
    role_path: str | None = None


@dataclass(frozen=True)
class Layout:
    """A declared layout: its field paths, and its turns, fixed ones first, then one for each item of a list."""

    name: str
    paths: tuple[str, ...]
    parts: tuple[Part, ...] = ()
    each: str | None = None
    item: Part | None = None
    roles: dict[str, str] = field(default_factory=dict, hash=False)

    def shapes(self) -> list[str]:
        found = [shape_of(self.paths)]
        if self.each:  # an empty list has no inner paths
            outer = [p for p in self.paths if not p.startswith(f"{self.each}[]")]
            found.append(shape_of([*outer, f"{self.each}[]"]).replace(f"{self.each}: ARRAY<>", f"{self.each}: ARRAY<VOID>"))
        return found


_SHARED = {"human": "user", "gpt": "assistant", "bot": "assistant", "chatgpt": "assistant", "model": "assistant"}

LAYOUTS = (
    Layout("turn", ("role", "text", "turn"), (Part(("text",), role_path="role"),)),
    Layout("messages", ("messages[].content", "messages[].role"), each="messages", item=Part(("content",), role_path="role")),
    Layout("shared", ("conversations[].from", "conversations[].value"), each="conversations",
           item=Part(("value",), role_path="from"), roles=_SHARED),
    Layout("completion", ("completion", "prompt"), (Part(("prompt",), "user"), Part(("completion",), "assistant"))),
    Layout("response", ("prompt", "response"), (Part(("prompt",), "user"), Part(("response",), "assistant"))),
    Layout("system_response", ("prompt", "response", "system"),
           (Part(("system",), "system"), Part(("prompt",), "user"), Part(("response",), "assistant"))),
    Layout("instruction", ("instruction", "output"), (Part(("instruction",), "user"), Part(("output",), "assistant"))),
    Layout("instruction_input", ("input", "instruction", "output"),
           (Part(("instruction", "input"), "user"), Part(("output",), "assistant"))),
    Layout("question", ("answer", "question"), (Part(("question",), "user"), Part(("answer",), "assistant"))),
)


def shape_of(paths: list[str] | tuple[str, ...]) -> str:
    """Field paths as Spark describes the schema of a variant, without the types of leaves."""
    tree: dict[str, list[str]] = {}
    for path in paths:
        head, _, rest = path.partition(".")
        tree.setdefault(head, []).extend([rest] if rest else [])
    parts = []
    for name in sorted(tree, key=lambda n: n.removesuffix("[]")):
        inner = shape_of(tree[name]) if tree[name] else ""
        parts.append(f"{name[:-2]}: ARRAY<{inner}>" if name.endswith("[]") else f"{name}: {inner}" if inner else name)
    return f"OBJECT<{', '.join(parts)}>"


def fingerprint_of(shape: str) -> str:
    return hashlib.sha256(shape.encode()).hexdigest()[:16]


def fingerprint(variant: Column) -> Column:
    """Hash of a variant's nested field paths."""
    shape = F.regexp_replace(F.schema_of_variant(variant), r": (?!OBJECT<|ARRAY<)[A-Z_]+(\(\d+,\d+\))?(?=[,>])", "")
    return F.substring(F.sha2(shape, 256), 1, 16)


def _turn(get: Callable[[str], Column], part: Part, roles: dict[str, str]) -> Column:
    if part.role is not None:
        role = F.lit(part.role)
    else:
        role = get(part.role_path)
        if roles:
            names = F.create_map(*[F.lit(x) for pair in roles.items() for x in pair])
            role = F.coalesce(F.element_at(names, role), role)
    texts = [get(path) for path in part.texts]
    if len(texts) > 1:  # an empty part adds no line
        rest = [F.when(t != "", F.concat(F.lit("\n"), t)).otherwise(F.lit("")) for t in texts[1:]]
        texts = [F.concat(texts[0], *rest)]
    return F.struct(role.alias("role"), texts[0].alias("text"))


def _turns(record: Column, layout: Layout, get: Callable[[Column, str], Column], items: Callable[[Column, str], Column]) -> Column:
    fixed = [_turn(lambda path: get(record, path), part, layout.roles) for part in layout.parts]
    if not layout.each:
        return F.array(*fixed)
    listed = F.transform(items(record, layout.each), lambda x: _turn(lambda path: get(x, path), layout.item, layout.roles))
    return F.concat(F.array(*fixed), listed) if fixed else listed


def _of_variant(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, f"$.{path}", "string"), F.lit(""))


def _items_of_variant(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, f"$.{path}", "array<variant>"), F.array().cast("array<variant>"))


def _of_struct(record: Column, path: str) -> Column:
    for name in path.split("."):
        record = record[name]
    return F.coalesce(record.cast("string"), F.lit(""))


def _items_of_struct(record: Column, path: str) -> Column:
    return record[path]


def paths_of(schema: T.StructType) -> list[str]:
    """Nested field paths of a struct."""
    found = []
    for field_ in schema.fields:
        many = isinstance(field_.dataType, T.ArrayType)
        inner = field_.dataType.elementType if many else field_.dataType
        name = f"{field_.name}[]" if many else field_.name
        found += [f"{name}.{path}" for path in paths_of(inner)] if isinstance(inner, T.StructType) else [name]
    return found


def canonical_turns(
    records: DataFrame, id_col: str, record_col: str, order_cols: tuple[str, ...] = (), layouts: tuple[Layout, ...] = LAYOUTS,
) -> DataFrame:
    """Rows id, the order columns, fingerprint, layout, position, role, text: one for each turn.

    Records are JSON text or structs.  Structs have their field paths in the schema, so one fingerprint
    picks the mapping for all rows, and their texts may be of any length.
    """
    keep = [id_col, *order_cols]
    kind = records.schema[record_col].dataType
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast("array<struct<role:string,text:string>>")
    if isinstance(kind, T.StructType):
        record, print_ = F.col("_record"), fingerprint_of(shape_of(paths_of(kind)))
        parsed = records.select(*keep, F.col(record_col).alias("_record"), F.lit(print_).alias("fingerprint"))
        for x in layouts:
            if print_ in [fingerprint_of(s) for s in x.shapes()]:
                layout = F.when(record.isNotNull(), F.lit(x.name))
                turns = F.when(record.isNotNull(), F.coalesce(_turns(record, x, _of_struct, _items_of_struct), F.array().cast("array<struct<role:string,text:string>>")))
    else:
        parsed = records.select(*keep, F.try_parse_json(F.col(record_col)).alias("_record")).withColumn("fingerprint", fingerprint(F.col("_record")))
        for x in layouts:
            chosen = F.col("fingerprint").isin([fingerprint_of(s) for s in x.shapes()])
            layout = F.when(chosen, F.lit(x.name)).otherwise(layout)
            turns = F.when(chosen, _turns(F.col("_record"), x, _of_variant, _items_of_variant)).otherwise(turns)
    return (
        parsed.select(*keep, "fingerprint", layout.alias("layout"), turns.alias("_turns"))
        .select(*keep, "fingerprint", "layout", F.posexplode_outer("_turns").alias("position", "_turn"))
        .select(*keep, "fingerprint", "layout", "position", "_turn.role", "_turn.text")
    )


def _escape(text: Column, controls: tuple = CONTROLS) -> Column:
    for plain, _, first, last in controls:
        text = F.regexp_replace(text, plain, first + r"\\$1" + last)
    return text


def _unescape(text: Column, controls: tuple = CONTROLS) -> Column:
    for _, escaped, first, last in controls:
        text = F.regexp_replace(text, escaped, first + "$1" + last)
    return text


def format_turns(turns: DataFrame, id_col: str, order_cols: tuple[str, ...] = (), loss_role: str = "assistant") -> DataFrame:
    """One row for each conversation: id, formatted, loss_spans (code points of formatted, end exclusive)."""
    rows = turns.where(F.col("role").isNotNull())
    order = [F.col(c) for c in (*order_cols, "position", "role", "text")]
    text = _escape(F.col("text"))
    head = F.concat(F.lit(BEGIN), _escape(F.col("role"), (*CONTROLS, ROLE_CONTROL)), F.lit(AFTER_ROLE))
    marked = rows.select(
        F.col(id_col), F.struct(*order).alias("_order"), F.col("role"), head.alias("_head"), text.alias("_text"),
    ).withColumn("_segment", F.concat("_head", "_text", F.lit(END)))
    before = Window.partitionBy(id_col).orderBy("_order").rowsBetween(Window.unboundedPreceding, -1)
    placed = marked.select(
        id_col, F.row_number().over(Window.partitionBy(id_col).orderBy("_order")).alias("_n"), "_segment",
        (F.coalesce(F.sum(F.length("_segment")).over(before), F.lit(0)) + F.length("_head")).alias("_start"),
        F.length("_text").alias("_chars"), (F.col("role") == loss_role).alias("_loss"),
    )
    listed = placed.groupBy(id_col).agg(F.sort_array(F.collect_list(F.struct("_n", "_segment", "_start", "_chars", "_loss"))).alias("_all"))
    spans = F.transform(
        F.filter("_all", lambda x: x["_loss"]),
        lambda x: F.struct(x["_start"].alias("start"), (x["_start"] + x["_chars"]).alias("end")),
    )
    return listed.select(id_col, F.array_join(F.col("_all._segment"), "").alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) that a formatted conversation holds."""
    parts = F.split(formatted, f"\\Q{END}\\E")
    body = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def read(part: Column) -> Column:
        at = F.locate(AFTER_ROLE, part)
        role = F.substr(part, F.lit(len(BEGIN) + 1), at - len(BEGIN) - 1)
        text = F.substr(part, at + len(AFTER_ROLE))
        return F.struct(_unescape(role, (*CONTROLS, ROLE_CONTROL)).alias("role"), _unescape(text).alias("text"))

    return F.transform(body, read)


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    cut = lambda s: _unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return F.array_join(F.transform(spans, cut), "")
