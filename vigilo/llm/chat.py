"""Chat formatting: schema fingerprints choose a mapping to canonical turns, one template marks them."""

from __future__ import annotations

from collections.abc import Mapping
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from vigilo.llm.common import table

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that texts must not bring into the output (fixed values), and the sign that escapes them.
CONTROL = (START, END, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
SIGN = "␛"
_TURN = "struct<role:string,text:string>"


def field_paths(kind: DataType, at: str = "") -> list[str]:
    """Nested field paths of a type; ``[]`` stands for the elements of an array."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


def schema_fingerprint(paths) -> str:
    """Hash of the sorted nested field paths of a layout."""
    return sha256("\n".join(sorted(paths)).encode()).hexdigest()[:16]


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _both(first: Column, second: Column) -> Column:
    return F.array(_turn(F.lit("user"), first), _turn(F.lit("assistant"), second))


def _with_system(system: Column, turns: Column) -> Column:
    none = F.array().cast(f"array<{_TURN}>")
    return F.concat(F.when(F.coalesce(system, F.lit("")) != "", F.array(_turn(F.lit("system"), system))).otherwise(none), turns)


def _joined(first: str, second: str) -> Column:
    extra = F.coalesce(F.col(second), F.lit(""))
    return F.concat(F.coalesce(F.col(first), F.lit("")), F.when(extra != "", F.concat(F.lit("\n\n"), extra)).otherwise(""))


def _speakers(column: str, role: str, text: str) -> Column:
    names = F.create_map(*[F.lit(x) for pair in (("human", "user"), ("gpt", "assistant"), ("bot", "assistant")) for x in pair])
    return F.transform(F.coalesce(F.col(column), F.array()), lambda t: _turn(F.coalesce(names[t[role]], t[role]), t[text]))


#: Layout by its field paths (without the id), and the mapping to canonical turns.
LAYOUTS = {
    ("prompt", "completion"): lambda: _both(F.col("prompt"), F.col("completion")),
    ("prompt", "response"): lambda: _both(F.col("prompt"), F.col("response")),
    ("question", "answer"): lambda: _both(F.col("question"), F.col("answer")),
    ("system", "prompt", "response"): lambda: _with_system(F.col("system"), _both(F.col("prompt"), F.col("response"))),
    ("instruction", "output"): lambda: _both(F.col("instruction"), F.col("output")),
    ("instruction", "input", "output"): lambda: _both(_joined("instruction", "input"), F.col("output")),
    ("messages[].role", "messages[].content"): lambda: _speakers("messages", "role", "content"),
    ("conversations[].from", "conversations[].value"): lambda: _speakers("conversations", "from", "value"),
    ("turns[].role", "turns[].text"): lambda: _speakers("turns", "role", "text"),
}
MAPPINGS = {schema_fingerprint(paths): turns for paths, turns in LAYOUTS.items()}


def escape(text: Column) -> Column:
    """Control strings and the escape sign itself become the sign and one letter."""
    out = F.replace(text, F.lit(SIGN), F.lit(SIGN + "a"))
    for k, control in enumerate(CONTROL):
        out = F.replace(out, F.lit(control), F.lit(SIGN + chr(ord("b") + k)))
    return out


def unescape(text: Column) -> Column:
    out = text
    for k, control in enumerate(CONTROL):
        out = F.replace(out, F.lit(SIGN + chr(ord("b") + k)), F.lit(control))
    return F.replace(out, F.lit(SIGN + "a"), F.lit(SIGN))


def _role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(SIGN + "z"))


def _unrole(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(SIGN + "z"), F.lit("\n")))


def canonical(records: DataFrame, key: str, mappings: Mapping[str, object] = MAPPINGS) -> DataFrame:
    """``key`` and ``turns`` of records of any listed layout.

    The fingerprint of the nested field paths (all columns but the key) selects the mapping; fields that
    no layout has are tried away by taking the largest layout whose paths the record contains. Null
    texts are empty, a null list of messages gives no turn. Raises ValueError for an unknown layout.
    """
    have = [p for f in records.schema.fields if f.name != key for p in field_paths(f.dataType, f.name)]
    turns = mappings.get(schema_fingerprint(have))
    if turns is None:
        fitting = [p for p in LAYOUTS if set(p) <= set(have) and schema_fingerprint(p) in mappings]
        if not fitting:
            raise ValueError(f"no mapping for the fields {sorted(have)}")
        turns = mappings[schema_fingerprint(max(fitting, key=len))]
    return records.select(F.col(key), turns().cast(f"array<{_TURN}>").alias("turns"))


def gather(rows: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows of single turns as records with ``messages``, ordered by turn (null first, then role and text)."""
    each = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"),
                    F.coalesce(F.col(text), F.lit("")).alias("content"))
    return rows.select(F.col(key).alias("key"), each.alias("each")).groupBy("key").agg(
        F.array_sort(F.collect_list("each")).alias("each")).select(
        F.col("key").alias(key), F.transform("each", lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content"))).alias("messages"))


def format_turns(turns: DataFrame, key: str, learn: str = "assistant") -> DataFrame:
    """``key``, ``formatted`` and ``loss``, the spans (start from 1, length) of the texts to learn.

    Each turn is START, role, newline, text, END, newline. Control strings inside roles and texts are
    escaped reversibly, so the marks occur only where the template put them. No turn gives an empty text.
    """
    pieces = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), _role(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("text"),
        (t["role"] == learn).alias("learn")))
    rows = turns.select(F.col(key), pieces.alias("pieces"))
    tail = END + "\n"
    start = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<at:int,n:int>>").alias("spans"))
    walked = F.aggregate("pieces", start, lambda s, p: F.struct(
        (s["at"] + F.length(p["head"]) + F.length(p["text"]) + F.lit(len(tail))).alias("at"),
        F.when(p["learn"], F.concat(s["spans"], F.array(F.struct((s["at"] + F.length(p["head"])).alias("at"), F.length(p["text"]).alias("n")))))
        .otherwise(s["spans"]).alias("spans")))
    return rows.select(
        F.col(key),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["text"], F.lit(tail))), "").alias("formatted"),
        walked["spans"].alias("loss"))


def parse_turns(formatted: Column) -> Column:
    """The turns of a formatted text, unescaped."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    head = lambda p: F.instr(p, "\n")
    return F.transform(parts, lambda p: F.struct(
        _unrole(F.substr(p, F.lit(1), head(p) - 1)).alias("role"),
        unescape(F.substr(p, head(p) + 1, F.length(p) - head(p) - F.lit(len(END) + 1))).alias("text")))


def learned_text(formatted: Column, loss: Column) -> Column:
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, s["at"], s["n"]))), "")


def op6_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one more, formatted and read back."""
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    done = format_turns(canonical(gather(rows.unionByName(more), "conv_id", "turn", "role", "text"), "conv_id"), "conv_id")
    back = done.select("conv_id", "formatted", parse_turns(F.col("formatted")).alias("turns"),
                       learned_text(F.col("formatted"), F.col("loss")).alias("learned"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def _sql_escape(text: str) -> str:
    out = f"replace({text}, '{SIGN}', '{SIGN}a')"
    for k, control in enumerate(CONTROL):
        out = f"replace({out}, '{control}', '{SIGN}{chr(ord('b') + k)}')"
    return out


OP6_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS learned,
    sum(length('{START}') + length(replace({_sql_escape('role')}, chr(10), '{SIGN}z')) + 1
        + length({_sql_escape('text')}) + length('{END}') + 1) AS formatted_chars
  FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learned) AS loss_chars,
  sha256(learned) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""
