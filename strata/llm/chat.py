"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes one training example: all turns up to it are the context, and only that reply is
trainable.  A conversation that does not end with an assistant turn gets one more example without a target, so
that no turn is lost; its mask is empty.

Template.  A turn is ``<s>[INST]`` + role + line feed + text + ``[/INST]</s>``; the formatted example is the
concatenation of its turns.  Control strings inside roles and texts are escaped with backslashes (``\\`` becomes
``\\\\``, and a backslash goes behind the first character of a control string), and a line feed in a role gets a
backslash before it, so the template can be read back exactly.

Size.  The output of this method is the sum of all prefixes: quadratic in the turns of one conversation, linear in
the number of conversations.  The turns of one conversation are gathered into one row, which the last example needs
in any case: it is one string that holds the whole conversation.  Examples of one conversation are produced one
after the other, never as one array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: strings with a meaning in the template
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]"]
OPEN, CLOSE, STOP = "<s>[INST]", "[/INST]</s>", "\n"
TARGET_ROLE = "assistant"

_CONTROL_PATTERN = r"([<\[])(/?(?:s>|INST\]))"
_PROBE = "</s>[INST] ok [/INST]"


def escape(text: Column) -> Column:
    """Make control strings inside a text inert; reversed by ``unescape``."""
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL_PATTERN, r"$1\\$2")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    """Drop each escaping backslash and keep the character behind it."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), escape_role(turn["role"]), F.lit(STOP), escape(turn["text"]), F.lit(CLOSE))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Examples of each conversation: (conv_id, example_no, is_last, formatted, loss_start, loss_end).

    ``loss_start`` and ``loss_end`` (code points, end exclusive) mark the trainable reply inside ``formatted``; both
    are null in an example without a target.  Only conv_id, turn, role and text are read, so other columns may have
    any name.

    Defined cases: a null role or text is empty; turns are ordered by (turn, role, text) with null turns first, so
    equal turn numbers and repeated rows have a fixed order and are all kept; rows with a null conv_id form one
    conversation; a role other than ``assistant`` (compared exactly) is context; an empty table has no examples.
    """
    turns = conversations.select(
        "conv_id", F.struct(F.col("turn").cast("long").alias("turn"),
                            F.coalesce(F.col("role"), F.lit("")).alias("role"),
                            F.coalesce(F.col("text"), F.lit("")).alias("text")).alias("turn"))
    whole = (turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
             .select("conv_id",
                     F.transform("turns", render).alias("parts"),
                     F.transform("turns", lambda t: t["role"] == F.lit(TARGET_ROLE)).alias("is_target"))
             .withColumn("n", F.size("parts")))
    ends = F.filter(F.sequence(F.lit(1), F.col("n")),
                    lambda i: F.element_at("is_target", i) | (i == F.col("n")))
    examples = (whole.withColumn("ends", ends)
                .select("conv_id", "parts", "is_target", "n", F.posexplode("ends").alias("example_no", "end"))
                .withColumn("formatted", F.array_join(F.slice("parts", F.lit(1), F.col("end")), ""))
                .withColumn("target", F.element_at("is_target", F.col("end")))
                .withColumn("part", F.element_at("parts", F.col("end"))))
    tail = F.char_length("formatted") - F.lit(len(CLOSE))
    head = F.char_length("formatted") - F.char_length("part") + F.lit(len(OPEN) + len(TARGET_ROLE) + len(STOP))
    return examples.select(
        "conv_id", F.col("example_no").cast("long").alias("example_no"), (F.col("end") == F.col("n")).alias("is_last"),
        "formatted",
        F.when(F.col("target"), head).cast("long").alias("loss_start"),
        F.when(F.col("target"), tail).cast("long").alias("loss_end"))


def parse_turns(formatted: Column) -> Column:
    """Turns of a formatted example: array of (role, text), unescaped."""
    body = F.substring(formatted, F.lit(len(OPEN) + 1),
                       F.char_length(formatted) - F.lit(len(OPEN) + len(CLOSE)))
    parts = F.split(body, r"\[/INST\]</s><s>\[INST\]", -1)
    role = lambda p: F.regexp_extract(p, r"(?s)^((?:[^\\\n]|\\.)*+)\n", 1)
    return F.transform(parts, lambda p: F.struct(
        unescape(role(p)).alias("role"),
        unescape(F.substring(p, F.char_length(role(p)) + F.lit(2), F.char_length(p))).alias("text")))


def loss_text(formatted: Column, start: Column, end: Column) -> Column:
    """Unescaped text under the mask (empty without a target)."""
    return F.coalesce(unescape(F.substring(formatted, (start + 1).cast("int"), (end - start).cast("int"))), F.lit(""))


def conversation_digests(examples: DataFrame) -> DataFrame:
    """Read formatted examples back: one row per conversation with turn and loss digests.

    Each example is reduced to its reply (and the last one to the digest of its parsed turns) before the group, so a
    group holds each reply once, never the prefixes.
    """
    parsed = F.when(F.col("is_last"), parse_turns(F.col("formatted")))
    read = examples.select(
        "conv_id", "example_no", F.char_length("formatted").cast("long").alias("chars"),
        loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_end")).alias("reply"),
        parsed.alias("turns"))
    read = read.select(
        "conv_id", "example_no", "chars", "reply", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))),
                            ""), 256).alias("turns_sha256"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example_no", "reply"))),
                                      lambda r: r["reply"]), "")
    return (read.groupBy("conv_id")
            .agg(F.max("n_turns").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
                 joined.alias("loss"), F.sum("chars").alias("formatted_chars"), F.count("*").alias("n_examples"))
            .select("conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"),
                    F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars", "n_examples"))


def op8_prefix_target(spark, sf_dir: str) -> DataFrame:
    """All conversations plus conversation -1, whose two turns consist of control strings."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit(TARGET_ROLE)).alias("role"),
        F.lit(_PROBE).alias("text"))
    return conversation_digests(format_conversations(table.unionByName(probe)))


OP8_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    count(*) OVER (PARTITION BY conv_id) AS n,
    length(regexp_replace(replace(text, '\', '\\'), '([<\[])(/?(s>|INST\]))', '\1\\\2', 'g'))
    + length(replace(regexp_replace(replace(role, '\', '\\'), '([<\[])(/?(s>|INST\]))', '\1\\\2', 'g'),
                     chr(10), '\' || chr(10))) + length('<s>[INST]' || chr(10) || '[/INST]</s>') AS part
  FROM turns
), summed AS (
  SELECT *, sum(part) OVER (PARTITION BY conv_id ORDER BY k) AS prefix FROM sized
)
SELECT conv_id, max(n)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY k)) AS loss_sha256,
  sum(CASE WHEN role = 'assistant' OR k = n THEN prefix ELSE 0 END)::BIGINT AS formatted_chars,
  sum(CASE WHEN role = 'assistant' OR k = n THEN 1 ELSE 0 END)::BIGINT AS n_examples
FROM summed GROUP BY conv_id
"""
