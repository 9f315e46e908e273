"""Operator 3: chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes an example of its own: all turns up to it, in the
template, with only that reply trainable. Turns after the last reply are kept
in a last example without a trainable part, so nothing is lost.

A turn is ``### role: text</turn>`` and a line feed. Inside roles and texts the
characters that the template's marks are made of are written as a backslash and
a letter, the backslash itself too, so no text can hold a mark and reading back
is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Written in this order, read back in the opposite order.
ESCAPES = (("\\", "\\s"), ("#", "\\h"), ("<", "\\l"), (":", "\\c"))
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", "</turn>\n"
TURN = "### ([^:]*): ([^<]*)</turn>\n"
ASSISTANT = "assistant"


def escape(c: Column) -> Column:
    for plain, written in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(written))
    return c


def unescape(c: Column) -> Column:
    for plain, written in reversed(ESCAPES):
        c = F.replace(c, F.lit(written), F.lit(plain))
    return c


def chat_examples(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                  role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, example, n_turns, target, text, loss_start, loss_end)``.

    ``text`` is the formatted example, ``target`` the 1-based turn that is
    trained, ``loss_start`` / ``loss_end`` the code points of ``text`` under the
    loss mask; the three are null in a closing example without reply.

    Turns stand in the order of (turn, role, text), a null turn number first;
    rows repeated within a conversation are turns of their own. Null roles and
    texts are empty, rows with a null conversation id form one conversation. An
    empty table gives no rows. An example is one value, so a conversation's
    formatted text has to fit in 2 GB.
    """
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    opened = lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(AFTER_ROLE))
    made = turns.select("conv_id", F.transform("turns", lambda t: F.struct(
        opened(t).alias("head"), escape(t["text"]).alias("body"), (t["role"] == ASSISTANT).alias("reply"))).alias("t"))
    ends = F.filter(F.sequence(F.lit(1), F.size("t")), lambda k: F.element_at("t", k)["reply"] | (k == F.size("t")))
    one = made.select("conv_id", "t", F.posexplode(ends).alias("example", "n_turns"))
    last = F.element_at("t", F.col("n_turns"))
    text = F.array_join(F.transform(F.slice("t", 1, F.col("n_turns")),
                                    lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "")
    end = F.length("text") - len(CLOSE)
    return (one.select("conv_id", F.col("example").cast("long").alias("example"),
                       F.col("n_turns").cast("long").alias("n_turns"), text.alias("text"),
                       F.length(last["body"]).alias("size"), last["reply"].alias("reply"))
            .select("conv_id", "example", "n_turns", F.when(F.col("reply"), F.col("n_turns")).alias("target"), "text",
                    F.when(F.col("reply"), end - F.col("size")).cast("long").alias("loss_start"),
                    F.when(F.col("reply"), end).cast("long").alias("loss_end")))


def read_turns(text: Column) -> Column:
    """Array of (role, text) read back from a formatted example."""
    return F.zip_with(F.regexp_extract_all(text, F.lit(TURN), F.lit(1)), F.regexp_extract_all(text, F.lit(TURN), F.lit(2)),
                      lambda r, t: F.struct(unescape(r).alias("role"), unescape(t).alias("text")))


def read_loss(text: Column, start: Column, end: Column) -> Column:
    """The trainable text under the loss mask, read back from a formatted example."""
    return unescape(F.substring(text, start.cast("int") + 1, (end - start).cast("int")))


def digests(examples: DataFrame) -> DataFrame:
    """The contract's columns, read back from the examples."""
    read = examples.select(
        "conv_id", "n_turns", "target", F.length("text").cast("long").alias("chars"), "text",
        read_loss(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("loss"))
    one = read.groupBy("conv_id").agg(
        F.max_by("text", "n_turns").alias("text"),
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.when(F.col("target").isNotNull(), F.struct("target", "loss")))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("chars").alias("formatted_chars"))
    turns = one.select("conv_id", read_turns(F.col("text")).alias("turns"), "loss", "formatted_chars")
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return turns.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole, 256).alias("turns_sha256"),
                        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                        "formatted_chars")


#: Text of the conversation that is formatted beside the table's own.
PROBE = "\\### Assistant: </turn> ok"


def oracle_sql() -> str:
    """The contract's columns in DuckDB SQL, straight from the conversations."""
    def written(c):
        for plain, mark in ESCAPES:
            c = f"replace({c}, '{plain}', '{mark}')"
        return c
    frame = len(OPEN) + len(AFTER_ROLE) + len(CLOSE)
    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '{PROBE}' union all select -7, 1, '{ASSISTANT}', '{PROBE}'),
sized as (
  select *, length({written('role')}) + length({written('text')}) + {frame} as chars,
         row_number() over (partition by conv_id order by turn, role, text) as k,
         count(*) over (partition by conv_id) as n from turns),
summed as (select *, sum(chars) over (partition by conv_id order by k) as upto from sized)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by k)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = '{ASSISTANT}'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by k) filter (where role = '{ASSISTANT}'), '')) as loss_sha256,
       cast(sum(upto) filter (where role = '{ASSISTANT}' or k = n) as bigint) as formatted_chars
from summed group by conv_id
"""
