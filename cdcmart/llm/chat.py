"""Chat formatting: records of any known layout become turns, turns become training text.

The layout of a record is told by its fingerprint, a hash of its nested field paths
(``messages[].content``), not by a name; each known fingerprint selects a declarative
mapping to turns. A template marks the turns, escapes control strings inside texts and
roles so that they can be read back, and states which characters carry loss.

Nulls: a null text or role counts as empty; a null conversation id is an id of its own.
Turns with equal numbers are ordered by role and text; null numbers come first. One
conversation becomes one string, so it must fit one cell (2 GB). Columns that no layout
uses are set aside before a table's fingerprint is taken, as is its key; a fingerprint that no mapping has, as that of a
table with the fields of two layouts, is an error for a table and a row without turns for a JSON record.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cdcmart.llm.common import empty_if_null, table

TURNS = "array<struct<turn: bigint, role: string, text: string>>"


# --- fingerprints -----------------------------------------------------------------------


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Sorted nested field paths; ``[]`` marks the elements of an array."""
    if isinstance(kind, T.StructType):
        inner = [field_paths(f.dataType, f"{at}.{f.name}" if at else f.name) for f in kind.fields]
        return sorted(path for paths in inner for path in paths)
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def fingerprint(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


@dataclass(frozen=True)
class Mapping:
    """A layout: its field paths and the SQL that makes turns of a record's fields."""

    name: str
    paths: tuple[str, ...]
    turns: str  # over the fields of one record, of type TURNS
    shape: str = ""  # type of a JSON record

    @property
    def fingerprint(self) -> str:
        return fingerprint(list(self.paths))


def _pairs(*fields: tuple[str, str]) -> str:
    """Turns from fixed (role, field) pairs; null fields make no turn, except the last two."""
    made = [f"IF({field} IS NULL, NULL, named_struct('role', '{role}', 'text', {field}))" for role, field in fields]
    return f"transform(filter(array({', '.join(made)}), x -> x IS NOT NULL), (x, i) -> named_struct('turn', CAST(i AS BIGINT), 'role', x.role, 'text', x.text))"


def _messages(array: str, role: str, text: str) -> str:
    as_role = f"CASE lower(m.{role}) WHEN 'human' THEN 'user' WHEN 'gpt' THEN 'assistant' WHEN 'bot' THEN 'assistant' ELSE lower(m.{role}) END"
    return f"transform({array}, (m, i) -> named_struct('turn', CAST(i AS BIGINT), 'role', {as_role}, 'text', m.{text}))"


_INPUT = "CASE WHEN coalesce(input, '') = '' THEN instruction ELSE concat(instruction, '\\n\\n', input) END"

# The known record layouts.
MAPPINGS: tuple[Mapping, ...] = (
    Mapping("messages", ("messages[].content", "messages[].role"), _messages("messages", "role", "content"),
            "struct<messages: array<struct<role: string, content: string>>>"),
    Mapping("conversations", ("conversations[].from", "conversations[].value"), _messages("conversations", "from", "value"),
            "struct<conversations: array<struct<`from`: string, value: string>>>"),
    Mapping("prompt", ("prompt", "response"), _pairs(("user", "prompt"), ("assistant", "response")),
            "struct<prompt: string, response: string>"),
    Mapping("completion", ("completion", "prompt"), _pairs(("user", "prompt"), ("assistant", "completion")),
            "struct<prompt: string, completion: string>"),
    Mapping("system_prompt", ("prompt", "response", "system"), _pairs(("system", "system"), ("user", "prompt"), ("assistant", "response")),
            "struct<system: string, prompt: string, response: string>"),
    Mapping("instruction", ("input", "instruction", "output"), _pairs(("user", _INPUT), ("assistant", "output")),
            "struct<instruction: string, input: string, output: string>"),
    Mapping("instruction_only", ("instruction", "output"), _pairs(("user", "instruction"), ("assistant", "output")),
            "struct<instruction: string, output: string>"),
    Mapping("question", ("answer", "question"), _pairs(("user", "question"), ("assistant", "answer")),
            "struct<question: string, answer: string>"),
)

#: A table with one row per turn.
ROWS = ("role", "text", "turn")
KEY = "conv_id"
#: What a fingerprint selects; None stands for rows that are gathered by their key.
BY_FINGERPRINT: dict[str, Mapping | None] = {fingerprint(list(ROWS)): None} | {m.fingerprint: m for m in MAPPINGS}
_FIELDS = {path.split("[")[0].split(".")[0] for paths in (ROWS, *(m.paths for m in MAPPINGS)) for path in paths}


def record_fingerprint(record: Column) -> Column:
    """Fingerprint of a JSON record, the same hash as that of a table of this layout.

    The variant schema lists object fields in order; names with punctuation are quoted there
    and match no known layout.
    """
    schema = F.schema_of_variant(F.try_parse_json(record))
    # OBJECT<messages: ARRAY<OBJECT<content: STRING, role: STRING>>> has one nested level here;
    # deeper records match no layout.
    body = F.regexp_extract(schema, r"^OBJECT<(.*)>$", 1)
    nested = F.regexp_extract(body, r"^(\w+): ARRAY<OBJECT<([^<>]*)>>$", 1)
    fields = F.regexp_extract(body, r"^(\w+): ARRAY<OBJECT<([^<>]*)>>$", 2)
    prefix = F.when(nested != "", F.concat(nested, F.lit("[]."))).otherwise("")
    listed = F.when(nested != "", fields).otherwise(body)
    names = F.transform(F.regexp_extract_all(listed, F.lit(r"(\w+): "), F.lit(1)), lambda x: F.concat(prefix, x))
    return F.sha2(F.array_join(F.array_sort(names), "\n"), 256)


def records_to_turns(records: DataFrame, key: str, record: str) -> DataFrame:
    """(key, layout, turns) of JSON records of mixed layouts; unknown ones have null turns."""
    known = records.select(F.col(key).alias("conv_id"), F.col(record).alias("__record"), record_fingerprint(F.col(record)).alias("__print"))
    layout = turns = None
    for mapping in MAPPINGS:
        here = F.col("__print") == mapping.fingerprint
        parsed = F.from_json("__record", mapping.shape)
        names = T._parse_datatype_string(mapping.shape).fieldNames()
        made = F.expr(_over(mapping.turns, names, mapping.name)).cast(TURNS)
        known = known.withColumn(f"__{mapping.name}", F.when(here, parsed))
        layout = F.when(here, F.lit(mapping.name)) if layout is None else layout.when(here, F.lit(mapping.name))
        turns = F.when(here, made) if turns is None else turns.when(here, made)
    return known.select("conv_id", layout.alias("layout"), turns.alias("turns"))


def _over(sql: str, names: list[str], mapping: str) -> str:
    """The mapping's SQL with its fields read from the parsed record."""
    import re

    for name in sorted(names, key=len, reverse=True):
        sql = re.sub(rf"(?<![\w.'\"]){name}(?![\w'(])", f"__{mapping}.`{name}`", sql)
    return sql


def table_to_turns(frame: DataFrame) -> DataFrame:
    """(conv_id, layout, turns) of a table; the fingerprint of its schema selects the mapping."""
    used = T.StructType([f for f in frame.schema.fields if f.name in _FIELDS])
    found = fingerprint(field_paths(used))
    if found not in BY_FINGERPRINT:
        raise ValueError(f"no mapping for a table with the fields {field_paths(used)}")
    mapping = BY_FINGERPRINT[found]
    if mapping is not None:
        made = F.expr(mapping.turns).cast(TURNS)
        return frame.select(KEY, F.lit(mapping.name).alias("layout"), made.alias("turns"))
    turn = F.struct(F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").alias("text"))
    return frame.groupBy(KEY).agg(F.lit("rows").alias("layout"), F.array_sort(F.collect_list(turn)).alias("turns"))


# --- template ---------------------------------------------------------------------------

# Control strings of the template. Escaped texts hold none of them.
OPEN, STOP, END = "[INST]", "[/INST]", "</s>"
CLOSE = f"{STOP}{END}\n"
_ESCAPES = (("%", "%25"), (OPEN, "%5BINST]"), (STOP, "%5B/INST]"), (END, "%3C/s>"))


def escape(text: Column) -> Column:
    """``%`` becomes ``%25``, and the first character of each control string its number."""
    for plain, escaped in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return text


def unescape(text: Column) -> Column:
    for plain, escaped in reversed(_ESCAPES):
        text = F.replace(text, F.lit(escaped), F.lit(plain))
    return text


def format_turns(frame: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, formatted, loss): the text, and the loss mask as (turn, start, length).

    A turn is ``[INST]role\\ntext[/INST]</s>\\n``. Mask spans count code points within their
    turn, whose place the end marks give; ``turn`` counts from 0.
    """

    def head(turn: Column) -> Column:
        # A line feed inside a role would end it early.
        role = F.replace(escape(empty_if_null(turn["role"])), F.lit("\n"), F.lit("%0A"))
        return F.concat(F.lit(OPEN), role, F.lit("\n"))

    def written(turn: Column) -> Column:
        return F.concat(head(turn), escape(empty_if_null(turn["text"])), F.lit(CLOSE))

    def span(turn: Column, i: Column) -> Column:
        return F.struct(
            i.alias("turn"),
            F.char_length(head(turn)).alias("start"),
            F.char_length(escape(empty_if_null(turn["text"]))).alias("length"),
            (F.coalesce(turn["role"], F.lit("")) == loss_role).alias("learn"),
        )

    spans = F.filter(F.transform("turns", span), lambda s: s["learn"])
    mask = F.transform(spans, lambda s: F.struct(s["turn"].alias("turn"), s["start"].alias("start"), s["length"].alias("length")))
    return frame.select("conv_id", F.array_join(F.transform("turns", written), "").alias("formatted"), mask.alias("loss"))


def read_turns(frame: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts, formatted) read from formatted text and mask alone."""
    blocks = F.split("formatted", r"\[/INST\]</s>\n")
    blocks = F.slice(blocks, 1, F.size(blocks) - 1)  # nothing follows the last mark

    def turn(block: Column) -> Column:
        at = F.instr(block, "\n")
        role = F.substring(block, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)
        return F.struct(
            unescape(F.replace(role, F.lit("%0A"), F.lit("\n"))).alias("role"),
            unescape(F.substring(block, at + 1, F.char_length(block) - at)).alias("text"),
        )

    named = frame.select("conv_id", "formatted", "loss", blocks.alias("__blocks"))
    learnt = F.transform(
        "loss", lambda s: unescape(F.substring(F.get("__blocks", s["turn"]), s["start"] + 1, s["length"]))
    )
    return named.select("conv_id", "formatted", F.transform("__blocks", turn).alias("turns"), learnt.alias("loss_texts"))


PROBE = -1  # id of the conversation whose texts are control strings


def op5_fingerprint_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the probe, formatted, then digested as read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(PROBE).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    read = read_turns(format_turns(table_to_turns(rows.unionByName(probe))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learnt = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
