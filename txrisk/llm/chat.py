"""Multi-party chat formatting by perspective rotation (operator 8), DataFrame functions only.

For every participant of a conversation the dialogue is rendered once with that
speaker as the assistant and all others as named users; only the assistant's
words are to be learnt.

The result has one row for each message of each rendered dialogue, in the
order (turn, speaker, text); the dialogue's string is the concatenation of its
rows. So no conversation is gathered in one place: a conversation that holds a
third of all rows is a hot join key, which adaptive execution splits. The
participants' side of the join has one row for each conversation and speaker,
summed up before it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import quoted

#: Roles that instruct and do not take part.
INSTRUCTION_ROLES = ("system",)
UNKNOWN = "unknown"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", instruction_roles: tuple[str, ...] = INSTRUCTION_ROLES) -> DataFrame:
    """One row for each message of each conversation, seen from each participant.

    Columns: conv_id, assistant (the participant in whose place the model is),
    turn, chat_role (assistant, user or system), name (the speaker, for users),
    rendered (the message in the chat format), mask_from and mask_to (code
    points of ``rendered`` to be learnt: text and end mark; equal where none
    are), in_loss.

    A null or empty role is the speaker "unknown"; a null text is empty; messages
    without a conversation id form one conversation. Repeated rows are rendered
    as often as they occur; equal turns stand in the order of speaker, then text.
    A conversation of instructions alone has no participant and gives no row, as
    does an empty table. Mark openers inside names and texts are broken up by a
    space, so that no text can end its own message. Other columns are ignored.
    """
    safe = lambda c: F.replace(c, F.lit("<|"), F.lit("< |"))
    said = turns.select(
        quoted(conv_col).alias("conv_id"), quoted(turn_col).alias("turn"),
        F.when(F.coalesce(quoted(role_col), F.lit("")) == "", UNKNOWN).otherwise(quoted(role_col)).alias("speaker"),
        safe(F.coalesce(quoted(text_col), F.lit(""))).alias("body"))
    seats = said.where(~F.col("speaker").isin(*instruction_roles)) \
        .select(F.col("conv_id").alias("seat_conv"), F.col("speaker").alias("assistant")).distinct()
    both = said.join(seats, F.col("conv_id").eqNullSafe(F.col("seat_conv")))
    own = F.col("speaker") == F.col("assistant")
    rule = F.col("speaker").isin(*instruction_roles)
    role = F.when(own, "assistant").when(rule, "system").otherwise("user")
    name = F.when(~own & ~rule, F.col("speaker"))
    head = F.concat(F.lit(OPEN), role, F.when(name.isNotNull(), F.concat(F.lit(" name="), safe(name)))
                    .otherwise(F.lit("")), F.lit("\n"))
    rendered = F.concat(head, "body", F.lit(CLOSE + "\n"))
    start = F.length(head).cast("long")
    return both.select(
        "conv_id", "assistant", "turn", role.alias("chat_role"), name.alias("name"), rendered.alias("rendered"),
        start.alias("mask_from"),
        F.when(own, start + F.length("body") + len(CLOSE)).otherwise(start).alias("mask_to"),
        own.alias("in_loss"))


ORACLE = """
WITH s AS (SELECT conv_id, turn, CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE role END AS speaker,
                  replace(coalesce(text, ''), '<|', '< |') AS body FROM conversations),
seat AS (SELECT DISTINCT conv_id, speaker AS assistant FROM s WHERE speaker <> 'system'),
v AS (SELECT s.*, assistant,
        CASE WHEN speaker = assistant THEN 'assistant' WHEN speaker = 'system' THEN 'system' ELSE 'user' END AS chat_role
      FROM s JOIN seat ON s.conv_id IS NOT DISTINCT FROM seat.conv_id),
h AS (SELECT *, CASE WHEN chat_role = 'user' THEN speaker END AS name,
        '<|im_start|>' || chat_role || CASE WHEN chat_role = 'user' THEN ' name=' || replace(speaker, '<|', '< |')
        ELSE '' END || chr(10) AS head FROM v)
SELECT conv_id, assistant, turn, chat_role, name, head || body || '<|im_end|>' || chr(10) AS rendered,
       CAST(length(head) AS BIGINT) AS mask_from,
       CAST(length(head) + CASE WHEN chat_role = 'assistant' THEN length(body) + 10 ELSE 0 END AS BIGINT) AS mask_to,
       chat_role = 'assistant' AS in_loss
FROM h
"""
