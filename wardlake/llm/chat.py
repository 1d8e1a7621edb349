"""Chat formatting from an event log, in DataFrame operations only.

A log holds one row per event: a streamed piece of a message (``delta``), a
new text for it (``edit``) or a fresh start of it (``regenerate``, whose own
text, if any, begins the new answer). Events are folded in the order of their sequence
number into final messages, these are rendered with turn markers, and the
characters to train on are marked.

Control strings of the template cannot come from a text: ``~ < [ |`` are
written ``~0 ~1 ~2 ~3``, which reads back without loss.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ESCAPES = [("~", "~0"), ("<", "~1"), ("[", "~2"), ("|", "~3")]
HEAD, BODY, END = "<|", "|>\n", "</s>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    for plain, safe in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def unescape(text: Column) -> Column:
    for plain, safe in reversed(ESCAPES):
        text = F.replace(text, F.lit(safe), F.lit(plain))
    return text


def as_events(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """A table of finished turns as a log: every row is one delta of a message of its own.

    Turns of a conversation go by turn (null first), then role, then text; null role and text are empty.
    """
    rows = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    nth = F.row_number().over(W.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return rows.select("conv_id", nth.alias("message"), nth.alias("seq"), F.lit("delta").alias("kind"), "role", "text")


def messages(events: DataFrame) -> DataFrame:
    """Fold a log (conv_id, message, seq, kind, role, text) to conv_id, message, role, text.

    Events of a message go by seq, ties by kind, then text. All before the last ``edit`` or ``regenerate`` is
    dropped; what is left is joined. The role is that of the message's first event. A kind other than these
    three raises. Null text and role are empty; a conversation or message of null key is a group of its own.
    """
    known = F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind")).otherwise(
        F.raise_error(F.concat(F.lit("unknown kind of event: "), F.coalesce(F.col("kind"), F.lit("null")))))
    one = F.struct(F.col("seq").alias("seq"), known.alias("kind"), F.coalesce("text", F.lit("")).alias("text"),
                   F.coalesce("role", F.lit("")).alias("role"))
    log = events.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(one)).alias("log"))
    start = F.array_max(F.transform("log", lambda e, k: F.when(e["kind"] != "delta", k).otherwise(F.lit(0))))
    text = F.array_join(F.transform(F.slice("log", start + 1, F.size("log")), lambda e: e["text"]), "")
    return log.select("conv_id", "message", F.col("log")[0]["role"].alias("role"), text.alias("text"))


def render(msgs: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """Messages (conv_id, message, role, text) to one row per conversation, in the order of ``message``.

    formatted: per message ``<|role|>``, a line feed, the escaped text, ``</s>`` and a line feed. turns: array of
    (role, start, length, loss): the code points of formatted that hold the escaped text, and whether they are
    trained on. An empty log gives no rows.
    """
    safe_role, body = escape(F.col("role")), escape(F.col("text"))
    parts = msgs.select("conv_id", "message", F.concat(F.lit(HEAD), safe_role, F.lit(BODY)).alias("head"),
                        body.alias("body"), "role")
    size = F.char_length("head") + F.char_length("body") + F.lit(len(END))
    before = W.partitionBy("conv_id").orderBy("message").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(size).over(before), F.lit(0)) + F.char_length("head")
    placed = parts.withColumn("start", start.cast("long"))
    turn = F.struct("message", F.concat("head", "body", F.lit(END)).alias("piece"), F.struct(
        "role", "start", F.char_length("body").cast("long").alias("length"),
        (F.col("role") == trained_role).alias("loss")).alias("turn"))
    got = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    return got.select("conv_id", F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
                      F.transform("t", lambda x: x["turn"]).alias("turns"))


def read_back(formatted: DataFrame) -> DataFrame:
    """What ``render`` wrote, read from ``formatted`` and the mask: conv_id, formatted_chars, turns array of (role,
    text, loss).

    A turn whose text is not as long as its mask says raises. Empty roles and texts come back empty, repeated rows are
    read each, an empty table gives no rows.
    """
    pieces = F.filter(F.split(F.col("formatted"), END), lambda p: p != "")
    cut = F.transform(pieces, lambda p: F.struct(
        F.substring_index(p, BODY, 1).alias("head"),
        F.substr(p, F.locate(BODY, p) + F.lit(len(BODY))).alias("body")))
    both = F.zip_with(cut, F.col("turns"), lambda c, t: F.struct(
        unescape(F.substr(c["head"], F.lit(len(HEAD) + 1))).alias("role"), unescape(c["body"]).alias("text"),
        F.when(F.char_length(c["body"]) == t["length"], t["loss"]).otherwise(
            F.raise_error(F.lit("the mask does not fit the text"))).alias("loss")))
    return formatted.select("conv_id", F.char_length("formatted").cast("long").alias("formatted_chars"), both.alias("turns"))


def chat_format(events: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """Log to training text: ``render(messages(events))``.

    Nulls, ties and repeated events are treated as in ``messages``; other columns are not read, whatever their names; an
    empty log gives no rows. A conversation is one row and must fit one task.
    """
    return render(messages(events), trained_role)


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(text) + length(role) + 10
           + length(regexp_replace(text, '[^~<\[|]', '', 'g')) + length(regexp_replace(role, '[^~<\[|]', '', 'g')))::BIGINT
         AS formatted_chars
FROM t GROUP BY conv_id
"""
