"""Operator 1, chat formatting (native): layouts are told apart by a hash of their nested field paths.

A layout is declared once: the paths of its fields, and an expression that turns a record into
turns (role, text). A table's or a JSON record's paths are hashed, and the hash selects the
layout; nothing else about the record is looked at. Turns are then written by a template that
marks them and escapes control strings inside texts, and the output can be read back.

Defined results: null text or role: empty; null conversation id: one conversation; no turns:
no row (rows by turn) or an empty array (records); equal turn numbers: by role, then text; repeated
rows stay; unknown layouts: null turns; columns that no layout names do not matter.
One conversation is one string, so one conversation must fit a task (Spark's limit for a string).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import table

# The template.
HEAD, COLON, END = "### ", ":\n", "\n</turn>\n"
PROBE_ID, PROBE_TEXT = -7, "\\### Assistant: </turn> ok"


@dataclass(frozen=True)
class Layout:
    """shape: the schema whose nested paths mark the layout; optional: top fields that may be absent; turns: None for rows by turn."""

    name: str
    shape: T.StructType
    turns: Callable[[Column], Column] | None
    optional: tuple[str, ...] = ()
    variants: tuple[T.StructType, ...] = field(init=False, default=())

    def shapes(self) -> list[T.StructType]:
        out = []
        for n in range(len(self.optional) + 1):
            for gone in combinations(self.optional, n):
                out.append(T.StructType([f for f in self.shape if f.name not in gone]))
        return out


def paths_of(kind: T.DataType) -> str:
    """The canonical text of all nested field paths: names in order, without scalar types."""
    if isinstance(kind, T.StructType):
        return "OBJECT<" + ", ".join(f"{f.name}{paths_of(f.dataType)}" for f in sorted(kind, key=lambda f: f.name)) + ">"
    return f"ARRAY<{paths_of(kind.elementType)}>" if isinstance(kind, T.ArrayType) else ""


def fingerprint(kind: T.DataType) -> str:
    return hashlib.sha256(paths_of(kind).encode()).hexdigest()


def json_fingerprint(record: Column) -> Column:
    """The same hash for one JSON record, on the JVM; null for what is not JSON."""
    shape = F.schema_of_variant(F.try_parse_json(record))
    bare = F.regexp_replace(shape, r"(: )?\b(STRING|BIGINT|DOUBLE|BOOLEAN|VOID|FLOAT|DATE|BINARY|UUID|TIMESTAMP(_NTZ)?|DECIMAL\(\d+,\s*\d+\))(?=[,>]|$)", "")
    return F.sha2(F.regexp_replace(bare, r": (?=OBJECT<|ARRAY<)", ""), 256)


def turn(role: Column | str, text: Column) -> Column:
    return F.struct((F.lit(role) if isinstance(role, str) else role).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _role(c: Column) -> Column:
    low = F.lower(F.coalesce(c, F.lit("")))
    return F.when(low.isin("human", "prompter"), "user").when(low.isin("gpt", "bot", "model"), "assistant").otherwise(low)


def _messages(array: str, role: str, text: str) -> Callable[[Column], Column]:
    return lambda r: F.transform(F.coalesce(r[array], F.array()), lambda m: turn(_role(m[role]), m[text]))


def _instruction(r: Column) -> Column:
    asked = F.concat_ws("\n\n", r["instruction"], F.when(r["input"] != "", r["input"]))
    system = F.when(r["system"].isNotNull(), F.array(turn("system", r["system"]))).otherwise(F.array().cast("array<struct<role:string,text:string>>"))
    return F.concat(system, F.array(turn("user", asked), turn("assistant", r["output"])))


def _pair(asked: str, said: str) -> Callable[[Column], Column]:
    return lambda r: F.array(turn("user", r[asked]), turn("assistant", r[said]))


def _of(*names: str, **others: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names] + [T.StructField(n, t) for n, t in others.items()])


LAYOUTS = (
    Layout("turn_rows", _of("role", "text", conv_id=T.LongType(), turn=T.LongType()), None),
    Layout("messages", _of(messages=T.ArrayType(_of("role", "content"))), _messages("messages", "role", "content")),
    Layout("from_value", _of(conversations=T.ArrayType(_of("from", "value"))), _messages("conversations", "from", "value")),
    Layout("instruction", _of("system", "instruction", "input", "output"), _instruction, ("system", "input")),
    Layout("prompt_response", _of("prompt", "response"), _pair("prompt", "response")),
    Layout("prompt_completion", _of("prompt", "completion"), _pair("prompt", "completion")),
    Layout("question_answer", _of("question", "answer"), _pair("question", "answer")),
)
BY_FINGERPRINT = {fingerprint(s): x for x in LAYOUTS for s in x.shapes()}


def alike(kind: T.DataType, wanted: T.DataType) -> bool:
    """The same nested paths; a map is no scalar."""
    return fingerprint(kind) == fingerprint(wanted) and not isinstance(kind, T.MapType)


def layout_of(df: DataFrame) -> Layout | None:
    """The first layout whose fields the table has, by the hash of those columns; all others are extra columns.

    A column that another layout names, or has another shape than the layout's, changes nothing.
    """
    for x in LAYOUTS:
        names = {f.name for f in x.shape}
        have = [f for f in df.schema if f.name in names]
        without = [f for f in have if f.name not in x.optional or alike(f.dataType, x.shape[f.name].dataType)]
        if BY_FINGERPRINT.get(fingerprint(T.StructType(without))) is x:
            return x
    return None


def turns_from_json(df: DataFrame, record: str, out: str = "turns") -> DataFrame:
    """Adds fingerprint, layout and turns to rows that each hold one JSON record of any layout."""
    df = df.withColumn("fingerprint", json_fingerprint(F.col(record)))
    turns, name = F.lit(None).cast("array<struct<role:string,text:string>>"), F.lit(None).cast("string")
    for x in LAYOUTS:
        if x.turns is not None:
            hashes = [fingerprint(s) for s in x.shapes()]
            mine = F.col("fingerprint").isin(hashes)
            turns = F.when(mine, x.turns(F.from_json(F.col(record), x.shape))).otherwise(turns)
            name = F.when(mine, x.name).otherwise(name)
    return df.withColumn("layout", name).withColumn(out, turns)


def canonical_rows(df: DataFrame) -> DataFrame:
    """Rows by turn (conv_id, turn, role, text) of a table, whatever its layout; needs conv_id."""
    layout = layout_of(df) or layout_of(df.drop("conv_id"))
    if layout is None:
        raise ValueError(f"no layout has the fields {paths_of(df.schema)}")
    if layout.turns is None:
        return df.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    have = {f.name for f in df.schema if f.name in layout.shape.names and alike(f.dataType, layout.shape[f.name].dataType)}
    record = F.struct(*[(F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in layout.shape])
    each = df.select("conv_id", F.posexplode(layout.turns(record)).alias("turn", "t"))
    return each.select("conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")


def escaped(text: Column) -> Column:
    """No control string (turn end, header mark) is left inside; unescaped() undoes it."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(F.replace(doubled, F.lit("</turn>"), F.lit("<\\/turn>")), "#(?=#)", "#\\\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def _unescaped_role(role: Column) -> Column:
    return unescaped(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))


def formatted(rows: DataFrame) -> DataFrame:
    """Per conversation: formatted string, loss_mask array<struct<start,end>> in code points (assistant texts)."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    head = F.concat(F.lit(HEAD), _escaped_role(F.col("role")), F.lit(COLON))
    parts = rows.select("conv_id", "turn", "role", "text", head.alias("head"), escaped(F.col("text")).alias("body"))
    parts = parts.withColumn("segment", F.concat("head", "body", F.lit(END)))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    before = F.sum(F.length("segment").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = parts.withColumn("start", F.coalesce(before, F.lit(0).cast("long")))
    body_at = F.col("start") + F.length("head")
    each = F.struct("start", "segment", (F.col("role") == "assistant").alias("loss"), body_at.alias("from"), (body_at + F.length("body")).alias("to"))
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(each)).alias("t"))
    spans = F.transform(F.filter("t", lambda x: x["loss"]), lambda x: F.struct(x["from"].alias("start"), x["to"].alias("end")))
    return whole.select("conv_id", F.concat_ws("", F.transform("t", lambda x: x["segment"])).alias("formatted"), spans.alias("loss_mask"))


def read_back(df: DataFrame) -> DataFrame:
    """Adds turns (role, text), parsed from the formatted string alone, and loss_text from the string and its mask."""
    def parsed(piece: Column) -> Column:
        first = F.substring_index(piece, "\n", 1)
        role = F.substring(first, F.lit(len(HEAD) + 1), F.length(first) - F.lit(len(HEAD) + 1))
        return F.struct(_unescaped_role(role).alias("role"), unescaped(F.substring(piece, F.length(first) + 2, F.length(piece))).alias("text"))

    pieces = F.split("formatted", END)
    turns = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), parsed)
    lost = F.transform("loss_mask", lambda s: F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    return df.withColumns({"turns": turns, "loss_text": F.concat_ws("", F.transform(lost, unescaped))})


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = canonical_rows(table(spark, sf_dir, "conversations"))
    probe = spark.range(2).select(
        F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"))
    back = read_back(formatted(rows.unionByName(probe)))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLE = r"""
with r as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e as (
  select *, length(role) + 4 + 2 + 9 + length(text)
    + length(text) - length(replace(text, '\', ''))
    + (length(text) - length(replace(text, '</turn>', ''))) // 7
    + len(regexp_extract_all(text, '#')) - len(regexp_extract_all(text, '#+')) as n from r)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(case when role = 'assistant' then length(text) end), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(n) as bigint) as formatted_chars
from e group by conv_id
"""
QUERIES = {"op1_chat_format": op1_chat_format}
SQL = {"op1_chat_format": ORACLE}
