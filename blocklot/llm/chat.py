r"""Chat formatting with typed content parts (operator 9), DataFrame functions only.

A turn's content is a list of parts (type, text, ref, width, height, seconds,
pages). A visitor walks the parts in order: a text part becomes its escaped text;
an image, audio or document part becomes the placeholder ``<image>``, ``<audio>`` or
``<document>``, and its reference is recorded with the number of tokens that the
placeholder stands for. The k-th placeholder of a conversation belongs to the k-th
attachment.

*Template*: ``<turn:ROLE>`` CONTENT ``</turn>`` and a line feed per turn. Control
strings all start with ``<``; in texts and roles ``&``, ``<`` and ``>`` are written as
``&amp;``, ``&lt;`` and ``&gt;``, so no text can hold a control string, and reading
back is exact. The loss mask holds one span per turn of ``LOSS_ROLE``: its content,
without the turn's marks.

Turns are ordered by (turn, role, parts). A conversation is one row of the result
by its nature; a row is gathered once, as one array, and nothing is quadratic in
its turns.

Defined results: null text, role or parts are empty; a null turn comes first. Rows
with a null conv_id are one conversation. Repeated rows are turns of their own. A
part of another type is an attachment with placeholder ``<other>`` and no tokens; a
missing size counts as 0. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, read_table

LOSS_ROLE = "assistant"
OPEN, SHUT, TURN_END = "<turn:", ">", "</turn>\n"
MEDIA = ("image", "audio", "document")
#: Tokens that a placeholder stands for: per image tile, second of audio, page.
TILE, TILE_TOKENS, SECOND_TOKENS, PAGE_TOKENS = 512, 256, 25, 1024
PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"


def escape(text: Column) -> Column:
    for raw, written in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for raw, written in ((">", "&gt;"), ("<", "&lt;"), ("&", "&amp;")):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


def text_parts(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parts) of a table whose turns are plain texts."""
    part = F.struct(F.lit("text").alias("type"), F.coalesce(col(conversations, "text"), F.lit("")).alias("text"),
                    F.lit(None).alias("ref"), F.lit(None).alias("width"), F.lit(None).alias("height"),
                    F.lit(None).alias("seconds"), F.lit(None).alias("pages")).cast(PART)
    return conversations.select(*[col(conversations, c).alias(c) for c in ("conv_id", "turn", "role")],
                                F.array(part).alias("parts"))


def _tokens(part: Column) -> Column:
    tiles = F.ceil(F.coalesce(part.width, F.lit(0)) / TILE) * F.ceil(F.coalesce(part.height, F.lit(0)) / TILE)
    return (F.when(part.type == "image", tiles * TILE_TOKENS)
            .when(part.type == "audio", F.ceil(F.coalesce(part.seconds, F.lit(0.0)) * SECOND_TOKENS))
            .when(part.type == "document", F.coalesce(part.pages, F.lit(0)) * PAGE_TOKENS)
            .otherwise(F.lit(0))).cast("bigint")


def _is_text(part: Column) -> Column:
    return F.coalesce(part.type == "text", F.lit(False))


def _render(part: Column) -> Column:
    kind = F.when(part.type.isin(*MEDIA), part.type).otherwise(F.lit("other"))
    return F.when(_is_text(part), escape(F.coalesce(part.text, F.lit("")))).otherwise(
        F.concat(F.lit("<"), kind, F.lit(">")))


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss, attachments, expanded_tokens) from (conv_id, turn, role, parts).

    loss: (turn, start, end) per trained turn: its number in the conversation and code points
    in its own marked-up text, end exclusive. attachments: (turn, type, ref, tokens) in order.
    """
    rows = turns.select(
        "conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"),
                            F.coalesce("parts", F.array().cast(f"array<{PART}>")).alias("parts")).alias("row"))
    held = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    written = held.select("conv_id", F.transform("rows", lambda r, i: F.struct(
        r.role.alias("role"),
        F.concat(F.lit(OPEN), escape(r.role), F.lit(SHUT)).alias("head"),
        F.array_join(F.transform(r.parts, _render), "").alias("content"),
        F.transform(F.filter(r.parts, lambda p: ~_is_text(p)), lambda p: F.struct(
            i.alias("turn"), p.type.alias("type"), p.ref.alias("ref"), _tokens(p).alias("tokens"))).alias("media"),
    )).alias("turns"))
    out = written.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: F.concat(t.head, t.content, F.lit(TURN_END))), "").alias("formatted"),
        F.filter(F.transform("turns", lambda t, i: F.struct(
            F.when(t.role == LOSS_ROLE, i).alias("turn"), F.length(t["head"]).alias("start"),
            (F.length(t["head"]) + F.length(t["content"])).alias("end"))),
            lambda s: s.turn.isNotNull()).alias("loss"),
        F.flatten(F.transform("turns", lambda t: t.media)).alias("attachments"))
    return out.withColumn("expanded_tokens", F.aggregate(
        F.transform("attachments", lambda a: a.tokens), F.lit(0).cast("bigint"), lambda x, y: x + y))


def read_back(formatted: Column) -> Column:
    """Turns (marked, role, content) of a formatted conversation; roles unescaped, contents as they stand."""
    pieces = F.filter(F.split(formatted, TURN_END), lambda p: p != "")
    return F.transform(pieces, lambda p: F.struct(
        p.alias("marked"), unescape(F.substring_index(p, SHUT, 1).substr(F.lit(len(OPEN) + 1), F.length(p))).alias("role"),
        p.substr(F.length(F.substring_index(p, SHUT, 1)) + 2, F.length(p)).alias("content")))


def digests(formatted: DataFrame) -> DataFrame:
    """What the query returns, from the formatted text and its loss mask alone."""
    back = formatted.select("conv_id", "formatted", "loss", read_back(F.col("formatted")).alias("turns"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t.role, F.lit("\n"), unescape(t.content), F.lit("\n"))), "")
    masked = F.array_join(F.transform("loss", lambda s: unescape(
        F.element_at(F.col("turns"), s.turn + 1).marked.substr(s.start + 1, s.end - s.start))), "")
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(masked).cast("bigint").alias("loss_chars"), F.sha2(masked.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(r"\### Assistant: </turn> ok")
    more = spark.range(2).select(F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
                                 said.alias("text"))
    return digests(format_conversations(text_parts(table.unionByName(more))))


QUERIES = {"op9_chat_format": op9_chat_format}
ORACLE_SQL = {"op9_chat_format": r"""
with rows as (
  select conv_id, turn, role, coalesce(text, '') as said from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
g as (select conv_id, count(*) as n_turns,
  string_agg(role || chr(10) || said || chr(10), '' order by turn, role, said) as turns,
  coalesce(string_agg(said, '' order by turn, role, said) filter (role = 'assistant'), '') as loss,
  cast(sum(length('<turn:' || role || '></turn>') + 1
    + length(replace(replace(replace(said, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'))) as bigint) as formatted_chars
  from rows group by conv_id)
select conv_id, n_turns, sha256(turns) as turns_sha256, length(loss) as loss_chars, sha256(loss) as loss_sha256,
  formatted_chars from g
"""}
