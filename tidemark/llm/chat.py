"""Chat formatting by prefix-target expansion, in built-in expressions only.

Every assistant turn becomes an example of its own: all turns before it are
context, and only that reply is trainable. A conversation that does not end in
an assistant turn gets one more example without a trainable part, so that no
turn is lost. An example is one string with the marks of a template; loss_start
and loss_end say which code points are trainable.

A control string inside a text gets one more ESC after its first sign (one more,
if some stand there already), and loses it when it is read back; so every text
comes back as it was, and no text can end a turn or begin one. Nulls: a null
text or role is empty, rows without a turn come first, and rows without conv_id
are a conversation of their own. Turns that tie go by role and text; repeated
rows are turns of their own. Without rows there are no examples. Columns other
than conv_id, turn, role and text are not looked at.

Examples of a conversation grow with the square of its turns, as each holds all
turns before it. A conversation that would make more than CHUNK characters is
dealt out: each of its chunks gets all turns and makes its share of examples.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.runtime import store, table

ESC = "␛"
#: Control strings of common chat templates, as their first sign and what follows it. No tail may hold a first sign.
FIRST = r"<\["
TAILS = ("|im_start|>", "|im_end|>", "|endoftext|>", "s>", "/s>", "SYS>>", "/SYS>>", "INST]", "/INST]")
#: Characters of examples that one task makes of one conversation.
CHUNK = 64 << 20


@dataclass(frozen=True)
class Template:
    """Marks around a turn: opening, role, line break, text, closing."""

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    assistant: str = "assistant"


CHAT_ML = Template()


def _tails() -> str:
    return "|".join("".join("\\" + c if c in "|[]" else c for c in tail) for tail in TAILS)


def escaped(text):
    return F.regexp_replace(text, f"([{FIRST}])({ESC}*+(?:{_tails()}))", f"$1{ESC}$2")


def unescaped(text):
    return F.regexp_replace(text, f"([{FIRST}]){ESC}({ESC}*+(?:{_tails()}))", "$1$2")


def _escaped_role(role):
    """A role ends at the line break, so it has none: it is written as ESC and a digit, as ESC itself is."""
    return F.replace(F.replace(escaped(role), F.lit(ESC), F.lit(ESC + "0")), F.lit("\n"), F.lit(ESC + "1"))


def _unescaped_role(role):
    return unescaped(F.replace(F.replace(role, F.lit(ESC + "1"), F.lit("\n")), F.lit(ESC + "0"), F.lit(ESC)))


def _made(turns: DataFrame, template: Template, by: list[str]) -> DataFrame:
    """Examples of conversations whose turns are grouped by conv_id, or by conv_id, chunk and chunks."""
    whole = turns.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    piece = lambda t: F.concat(F.lit(template.opening), _escaped_role(t.role), F.lit("\n"), escaped(t.text), F.lit(template.closing))
    ends = F.filter(F.sequence(F.lit(1), F.size("turns")), lambda i: (F.element_at("turns", i).role == template.assistant) | (i == F.size("turns")))
    mine = F.filter(ends, lambda _, j: j % F.col("chunks") == F.col("chunk")) if "chunk" in by else ends
    cut = whole.select("conv_id", F.transform("turns", piece).alias("pieces"), F.transform(mine, lambda i: F.struct(i.alias("example"), (F.element_at("turns", i).role == template.assistant).alias("reply"))).alias("ends"))
    one = cut.select("conv_id", "pieces", F.explode("ends").alias("end")).select("conv_id", F.col("end.example").alias("example"), F.col("end.reply").alias("reply"), F.array_join(F.slice("pieces", F.lit(1), F.col("end.example")), "").alias("text"), F.char_length(F.element_at("pieces", F.col("end.example"))).alias("last"))
    header = len(template.opening) + len(template.assistant) + 1
    start = F.when(F.col("reply"), F.char_length("text") - F.col("last") + header)
    return one.select("conv_id", "example", "text", start.alias("loss_start"), F.when(F.col("reply"), F.char_length("text") - len(template.closing)).alias("loss_end"))


def parts(conversations: DataFrame, template: Template = CHAT_ML, chunk: int = CHUNK) -> list[DataFrame]:
    """The examples in one part, or in two if there are conversations to be dealt out; a conversation is wholly in one. Turns move once, by conversation, so what is then grouped by it moves no more."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    sizes = turns.groupBy(F.col("conv_id").alias("s_conv")).agg(F.count_if(F.col("role") == template.assistant).alias("replies"), F.sum(F.octet_length("text") + F.octet_length("role") + 32).alias("chars"))
    chunks = F.least(F.ceil(F.col("replies") / chunk * F.col("chars")), F.col("replies")).cast("int")
    heavy = store(sizes.withColumn("chunks", chunks).filter("chunks > 1").select("s_conv", "chunks"), "long-conversations")
    if not heavy.limit(1).count():
        return [_made(turns, template, ["conv_id"])]
    same = F.col("conv_id").eqNullSafe(F.col("s_conv"))
    dealt = turns.join(heavy, same).select("conv_id", "turn", "role", "text", "chunks", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    return [_made(turns.join(heavy, same, "left_anti"), template, ["conv_id"]), _made(dealt, template, ["conv_id", "chunk", "chunks"])]


def examples(conversations: DataFrame, template: Template = CHAT_ML, chunk: int = CHUNK) -> DataFrame:
    """conv_id, example (the ordinal of its last turn), text, loss_start, loss_end (code points from 0, the end exclusive; null if nothing is trainable)."""
    made, *more = parts(conversations, template, chunk)
    return made.union(more[0]) if more else made


def trained(text: str = "text"):
    """What an example's mask covers, as it stood in the conversation; null if nothing is trainable."""
    return unescaped(F.substring(F.col(text), F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start")))


def parsed(text, template: Template = CHAT_ML):
    """The turns of an example as an array of structs of role and text."""
    quoted = "".join(c if c.isalnum() or c in "_<>/ \n" else "\\" + c for c in template.closing)
    parts = F.split(text, quoted, -1)
    body = lambda p: F.substring(p, F.lit(len(template.opening) + 1), F.char_length(p))
    role = lambda p: F.substring_index(body(p), "\n", 1)
    return F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), lambda p: F.struct(_unescaped_role(role(p)).alias("role"), unescaped(F.substring(body(p), F.char_length(role(p)) + 2, F.char_length(p))).alias("text")))


def read_back(made: DataFrame, template: Template = CHAT_ML) -> DataFrame:
    """Per conversation, from its examples alone: turns of the longest one, all that is trainable in order, and characters in all."""
    back = made.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"), F.sort_array(F.collect_list(F.when(F.col("loss_start").isNotNull(), F.struct("example", trained().alias("reply"))))).alias("replies"),
        F.sum(F.char_length("text")).cast("long").alias("formatted_chars"),
    )
    return back.select("conv_id", parsed(F.col("longest"), template).alias("turns"), F.transform("replies", lambda r: r.reply).alias("replies"), "formatted_chars")


def op13_chat_formatting(spark, sf_dir):
    """All conversations, and one whose texts are control strings, formatted and read back."""
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    back, *more = [read_back(part) for part in parts(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe))]
    back = back.union(more[0]) if more else back
    told, loss = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), ""), F.array_join("replies", "")
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


_LONGER = f"regexp_replace({{}}, '([{FIRST}])({ESC}*(?:{_tails()}))', '\\1{ESC}\\2', 'g')"
OP13_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
  {len(CHAT_ML.opening) + 1 + len(CHAT_ML.closing)} + length(replace(replace({_LONGER.format('role')}, '{ESC}', '{ESC}0'), chr(10), '{ESC}1')) + length({_LONGER.format('text')}) AS chars FROM c),
s AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY i) AS up_to FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(up_to) FILTER (role = 'assistant' OR i = n))::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""
