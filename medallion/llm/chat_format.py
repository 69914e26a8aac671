"""Chat formatting: layouts recognised by a fingerprint of their field paths.

A layout is a set of field paths and a declarative mapping to canonical turns, an
array of (role, text).  The fingerprint of a record is the hash of the known
paths it has; it selects the mapping, so records of different layouts can stand
in one column of JSON texts.  A record has a path when its key is there, whatever the value:
NULL, in any element of a list, or with an empty list.  A table's layout is read off its
schema.

Turns are written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts a backslash
goes between ``<`` and ``|`` (one more where backslashes stand there already), so no
control string can appear and unescaping is exact.  Roles are URL-encoded.

Edge cases: NULL roles and texts are empty; turns with equal numbers go by role
and text; an empty list is a record without turns; a record of no known layout, or that is
no JSON object, has NULL turns; result names that exist get underscores in front; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.llm.common import free_names, quoted

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """``turns`` is SQL giving canonical turns; ``{r}`` stands before a field of the record."""

    name: str
    paths: tuple[str, ...]
    schema: str
    turns: str


def _pair(role: str, text: str) -> str:
    return f"named_struct('role', '{role}', 'text', coalesce({text}, ''))"


_SPEAKER = ("case lower(m.from) when 'human' then 'user' when 'gpt' then 'assistant' "
            "when 'bot' then 'assistant' else coalesce(m.from, '') end")

LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"),
           "messages array<struct<role:string,content:string>>",
           "transform({r}messages, m -> named_struct('role', coalesce(m.role, ''), "
           "'text', coalesce(m.content, '')))"),
    Layout("conversations", ("conversations[].from", "conversations[].value"),
           "conversations array<struct<`from`:string,value:string>>",
           "transform({r}conversations, m -> named_struct('role', " + _SPEAKER
           + ", 'text', coalesce(m.value, '')))"),
    Layout("prompt-response", ("prompt", "response"), "prompt string, response string",
           f"array({_pair('user', '{r}prompt')}, {_pair('assistant', '{r}response')})"),
    Layout("prompt-completion", ("completion", "prompt"), "prompt string, completion string",
           f"array({_pair('user', '{r}prompt')}, {_pair('assistant', '{r}completion')})"),
    Layout("instruction", ("instruction", "output"), "instruction string, output string",
           f"array({_pair('user', '{r}instruction')}, {_pair('assistant', '{r}output')})"),
    Layout("instruction-input", ("input", "instruction", "output"),
           "instruction string, input string, output string",
           "array(named_struct('role', 'user', 'text', concat_ws('\\n\\n', "
           "nullif({r}instruction, ''), nullif({r}input, ''))), "
           f"{_pair('assistant', '{r}output')})"),
    # one row per turn: the rows of a conversation become its messages
    Layout("rows", ("role", "text", "turn"), "role string, text string, turn bigint", ""),
)
KNOWN = tuple(sorted({p for layout in LAYOUTS for p in layout.paths}))


def fingerprint(paths) -> str:
    """Hash of the known paths among ``paths``."""
    known = sorted(set(paths) & set(KNOWN))
    return hashlib.sha256("\n".join(known).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(layout.paths): layout for layout in LAYOUTS}


def field_paths(kind: T.DataType, prefix: str = "") -> list[str]:
    """The leaf paths of a schema; ``[]`` marks a list."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(
            f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, prefix + "[]")
    return [prefix]


def table_layout(df: DataFrame) -> Layout | None:
    return BY_FINGERPRINT.get(fingerprint(field_paths(df.schema)))


def canonical_table(df: DataFrame, key: str) -> DataFrame:
    """One row per record: ``key`` and its canonical ``turns``, by the table's layout."""
    layout = table_layout(df)
    if layout is None:
        raise ValueError(f"no layout has the fields {sorted(field_paths(df.schema))}")
    id_ = F.col(quoted(key)).alias(key)
    if layout.name != "rows":
        return df.select(id_, F.expr(layout.turns.format(r="")).cast(TURNS).alias("turns"))
    row = F.struct("turn", F.coalesce(F.col("role"), F.lit("")).alias("role"),
                   F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return df.groupBy(id_).agg(F.array_sort(F.collect_list(row)).alias("_rows")).select(
        F.col(quoted(key)),
        F.transform("_rows", lambda r: F.struct(r["role"], r["text"])).cast(TURNS)
        .alias("turns"))


def canonical_json(df: DataFrame, column: str, turns: str = "turns") -> DataFrame:
    """``df`` plus canonical turns of a column of JSON records, one layout per record."""
    record = F.col(quoted(column))
    turns, *parsed, listed = free_names(
        df, turns, *(f"_record{i}" for i in range(len(LAYOUTS))), "_lists")
    lists = sorted({p.split("[]")[0] for p in KNOWN if "[]" in p})
    keys = F.coalesce(F.call_function("json_object_keys", record), F.array().cast("array<string>"))

    def has(path: str) -> Column:
        if "[]." not in path:
            return F.array_contains(keys, path)
        name, leaf = path.split("[].")
        found = F.col(listed)[name]
        return F.coalesce((F.size(found) == 0) | F.exists(
            found, lambda m: F.map_contains_key(m, leaf)), F.lit(False))

    present = F.array_compact(F.array(*(F.when(has(p), F.lit(p)) for p in KNOWN)))
    mark = F.sha2(F.array_join(present, "\n").cast("binary"), 256)
    layouts = [(mark_, layout) for mark_, layout in BY_FINGERPRINT.items() if layout.turns]
    with_records = df.withColumns({
        listed: F.from_json(record, ", ".join(f"{n} array<map<string,string>>" for n in lists)),
        **{name: F.from_json(record, layout.schema)
           for name, (_, layout) in zip(parsed, layouts)}})
    chosen = F.lit(None).cast(TURNS)
    for name, (mark_, layout) in zip(parsed, layouts):
        mapped = F.expr(layout.turns.format(r=f"`{name}`.")).cast(TURNS)
        chosen = F.when(mark == mark_, mapped).otherwise(chosen)
    return with_records.withColumn(turns, chosen).drop(listed, *parsed)


# --- the template -------------------------------------------------------------------

START, END = "<|im_start|>", "<|im_end|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def format_turns(df: DataFrame, turns: str = "turns", train_on: str = "assistant") -> DataFrame:
    """``df`` plus ``formatted`` and ``loss_spans``, the [start, end) code points to train on."""
    pieces = F.transform(F.col(quoted(turns)), lambda t: F.struct(
        F.concat(F.lit(START), F.url_encode(t["role"]), F.lit("\n")).alias("head"),
        escape(t["text"]).alias("body"), (t["role"] == train_on).alias("train")))
    tail = END + "\n"
    formatted, loss_spans, parts = free_names(df, "formatted", "loss_spans", "_pieces")
    with_pieces = df.withColumn(parts, pieces)
    spans = F.aggregate(
        F.col(parts),
        F.struct(F.lit(0).cast("bigint").alias("at"),
                 F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + len(tail))
            .cast("bigint").alias("at"),
            F.when(p["train"], F.concat(acc["spans"], F.array(F.struct(
                (acc["at"] + F.length(p["head"])).cast("bigint").alias("start"),
                (acc["at"] + F.length(p["head"]) + F.length(p["body"])).cast("bigint")
                .alias("end"))))).otherwise(acc["spans"]).alias("spans")),
        lambda acc: acc["spans"])
    return with_pieces.withColumns({
        formatted: F.array_join(F.transform(
            F.col(parts), lambda p: F.concat(p["head"], p["body"], F.lit(tail))), ""),
        loss_spans: spans}).drop(parts)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text."""
    blocks = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, 2_000_000_000)
    return F.transform(blocks, lambda b: F.struct(
        F.url_decode(F.substring_index(b, "\n", 1)).alias("role"),
        unescape(F.regexp_replace(
            F.substring(b, F.instr(b, "\n") + 1, F.length(b)), r"<\|im_end\|>\n\z", ""))
        .alias("text")))


def under_loss(formatted: Column, spans: Column) -> Column:
    """The text to train on: each span unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(
        formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
