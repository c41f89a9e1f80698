"""Chat formatting: heterogeneous layouts to canonical turns, and turns to training text with a loss mask.

DataFrame operations only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

USER, ASSISTANT, SYSTEM = "user", "assistant", "system"

TURN = "struct<role: string, text: string>"


def paths(kind: T.DataType, at: str = "") -> list[str]:
    """The nested field paths of a type, leaves with their kind; ``[]`` stands for an array's elements."""
    if isinstance(kind, T.StructType):
        return sorted(p for f in kind.fields for p in paths(f.dataType, f"{at}.{f.name.lower()}"))
    if isinstance(kind, T.ArrayType):
        return paths(kind.elementType, f"{at}[]")
    return [at.removeprefix(".")]


def fingerprint(field_paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(field_paths)).encode()).hexdigest()


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _listed(items: Column, role: str, text: str, names: dict[str, str]) -> Column:
    """Turns of an array of messages; roles by other names are renamed."""

    def one(m: Column) -> Column:
        own = F.lower(F.coalesce(m[role], F.lit("")))
        known = reduce(lambda c, kv: c.when(own == kv[0], F.lit(kv[1])), names.items(), F.when(F.lit(False), ""))
        return F.struct(
            F.coalesce(known, m[role], F.lit("")).alias("role"), F.coalesce(m[text], F.lit("")).alias("text")
        )

    return F.transform(F.coalesce(items, F.array().cast(f"array<{_kind(role, text)}>")), one)


def _kind(role: str, text: str) -> str:
    return f"struct<{role}: string, {text}: string>"


def _asked(instruction: Column, extra: Column) -> Column:
    more = F.when(F.length(F.coalesce(extra, F.lit(""))) > 0, F.concat(F.lit("\n\n"), extra))
    return F.concat(F.coalesce(instruction, F.lit("")), F.coalesce(more, F.lit("")))


ALIASES = {"human": USER, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT, "prompter": USER}

#: Layout name -> (its field paths, the record's turns). A record is a struct column.
LAYOUTS: dict[str, tuple[list[str], Callable[[Column], Column]]] = {
    "messages": (
        ["messages[].role", "messages[].content"],
        lambda r: _listed(r["messages"], "role", "content", ALIASES),
    ),
    "shared": (
        ["conversations[].from", "conversations[].value"],
        lambda r: _listed(r["conversations"], "from", "value", ALIASES),
    ),
    "prompt": (
        ["prompt", "response"],
        lambda r: F.array(_turn(USER, r["prompt"]), _turn(ASSISTANT, r["response"])),
    ),
    "completion": (
        ["prompt", "completion"],
        lambda r: F.array(_turn(USER, r["prompt"]), _turn(ASSISTANT, r["completion"])),
    ),
    "instruction": (
        ["instruction", "input", "output"],
        lambda r: F.array(_turn(USER, _asked(r["instruction"], r["input"])), _turn(ASSISTANT, r["output"])),
    ),
    "instruction_only": (
        ["instruction", "output"],
        lambda r: F.array(_turn(USER, r["instruction"]), _turn(ASSISTANT, r["output"])),
    ),
    "system_prompt": (
        ["system", "prompt", "response"],
        lambda r: F.array(
            _turn(SYSTEM, r["system"]), _turn(USER, r["prompt"]), _turn(ASSISTANT, r["response"])
        ),
    ),
}
#: A layout of one row per turn: its key, place, role and text columns.
ROWS = {
    ("conv_id", "turn", "role", "text"),
    ("conversation_id", "turn_index", "role", "content"),
    ("dialog_id", "position", "speaker", "utterance"),
}
BY_PRINT = {fingerprint(p): turns for p, turns in LAYOUTS.values()}
ROWS_BY_PRINT = {fingerprint(list(names)): names for names in ROWS}


def row_turns(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text`` of a table with a row per turn, found by its schema.

    Columns beside the layout's are passed over; a schema that holds no layout is an error.
    """
    have = {c.lower() for c in rows.columns}
    for names in ROWS_BY_PRINT.values():
        if set(names) <= have:
            own = rows.select(*names)
            key, place, role, text = ROWS_BY_PRINT[fingerprint(paths(own.schema))]
            return own.select(
                F.col(key).alias("conv_id"),
                F.col(place).alias("turn"),
                F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
            )
    raise ValueError(f"no known layout: {fingerprint(paths(rows.schema))}")


def json_turns(rows: DataFrame, id_col: str = "conv_id", json_col: str = "record") -> DataFrame:
    """Canonical turns of JSON records of mixed layouts.

    A record is parsed with the union of all layouts' fields; the paths it has, those of null values
    too, are hashed, and the hash selects the layout's mapping. Returns ``conv_id``, ``layout`` (the hash), ``turns`` (null
    for an unknown layout and for broken or null JSON, so that such rows can be set aside).
    Fields beside those of the layouts are passed over.
    """
    union = (
        "messages array<struct<role: string, content: string>>, "
        "conversations array<struct<`from`: string, value: string>>, system string, prompt string, "
        "response string, completion string, instruction string, input string, output string"
    )
    lists = {"messages": ("role", "content"), "conversations": ("from", "value")}
    record = F.col("__record")
    present = [
        F.when(F.array_contains("__keys", c), F.array(*(F.lit(f"{c}[].{x}") for x in fields)))
        for c, fields in lists.items()
    ] + [
        F.when(F.array_contains("__keys", c), F.array(F.lit(c)))
        for c in ("system", "prompt", "response", "completion", "instruction", "input", "output")
    ]
    none = F.array().cast("array<string>")
    found = F.array_sort(F.flatten(F.array(*(F.coalesce(p, none) for p in present))))
    layout = F.sha2(F.array_join(found, "\n"), 256)
    turns = reduce(
        lambda c, kv: c.when(F.col("layout") == kv[0], kv[1](record)),
        BY_PRINT.items(),
        F.when(F.lit(False), F.lit(None)),
    )
    return (
        rows.select(F.col(id_col).alias("conv_id"), F.from_json(json_col, union).alias("__record"),
                    F.json_object_keys(json_col).alias("__keys"))
        .withColumn("layout", layout)
        .select("conv_id", "layout", turns.cast(f"array<{TURN}>").alias("turns"))
    )


#: Strings with a meaning in the formatted text. In a text, each gets a backslash after its first
#: character, and backslashes are doubled first, so that both can be undone.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
WRAP = {USER: ("[INST] ", " [/INST]"), SYSTEM: ("<<SYS>>\n", "\n<</SYS>>")}
LINE = "\n"


def _marked(control: str) -> str:
    return f"{control[0]}\\{control[1:]}"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for c in CONTROL:
        out = F.replace(out, F.lit(c), F.lit(_marked(c)))
    return out


def unescape(text: Column) -> Column:
    for c in reversed(CONTROL):
        text = F.replace(text, F.lit(_marked(c)), F.lit(c))
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


def format_chat(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``formatted``, ``loss`` (start and length in code points of each assistant text).

    ``turns`` has a row per turn. Each is written as ``<s>``, its role, a line end, its text
    (a user's or system's between marks) and ``</s>``; a line end in a role becomes ``<\\n>``.
    Turns go by their number, equal numbers by role and text, null first; null roles and texts
    count as empty; repeated rows are turns of their own; rows with a null id form one conversation.
    An empty table gives no rows. A conversation is one value, so it has to fit into a row.
    """
    role = F.replace(escape(F.col("role")), F.lit(LINE), F.lit("<\\n>"))
    head, tail = F.lit(""), F.lit("")
    for name, (before, after) in WRAP.items():
        head = F.when(F.col("role") == name, F.lit(before)).otherwise(head)
        tail = F.when(F.col("role") == name, F.lit(after)).otherwise(tail)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    pieces = (
        turns.select(
            "conv_id",
            "turn",
            F.coalesce("role", F.lit("")).alias("role"),
            F.coalesce("text", F.lit("")).alias("text"),
        )
        .withColumn("lead", F.concat(F.lit("<s>"), role, F.lit(LINE), head))
        .withColumn("body", escape(F.col("text")))
        .withColumn("trail", F.concat(tail, F.lit("</s>")))
        .withColumn("nth", F.row_number().over(order))
        .withColumn("size", F.length("lead") + F.length("body") + F.length("trail"))
        .withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    )
    start = F.col("end") - F.col("size") + F.length("lead")
    span = F.struct(start.alias("start"), F.length("body").cast("long").alias("length"))
    grouped = pieces.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct("nth", F.concat("lead", "body", "trail").alias("piece")))
        ).alias("pieces"),
        F.array_sort(F.collect_list(F.when(F.col("role") == ASSISTANT, span))).alias("loss"),
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        "loss",
    )


def read_back(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of role and text."""
    parts = F.filter(F.split(formatted, "</s>"), lambda p: F.length(p) > 0)

    def turn(part: Column) -> Column:
        cut = F.instr(part, LINE)
        role = unescape(F.replace(F.substring(part, F.lit(4), cut - 4), F.lit("<\\n>"), F.lit(LINE)))
        body = F.substring(part, cut + 1, F.length(part))
        text = body
        for name, (before, after) in WRAP.items():
            inner = F.substring(body, F.lit(len(before) + 1), F.length(body) - len(before) - len(after))
            text = F.when(role == name, inner).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def under_loss(formatted: Column, loss: Column) -> Column:
    """The texts that count for the loss, as they were before formatting."""
    return F.transform(
        loss,
        lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
    )
