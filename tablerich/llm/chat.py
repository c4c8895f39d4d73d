"""Chat formatting by event sourcing: fold a log of message events into conversations and render them.

``fold`` reads a log of events and gives the final messages, ``render`` makes one text for each
conversation with the spans a training loss covers, ``parse`` reads such texts back. All three are
DataFrame expressions.

Events have ``conv_id, seq, kind, message_id, role, text``. ``kind`` is one of

- ``message``: the message begins, with this role and text;
- ``delta``: text is appended;
- ``edit``: the text becomes this one;
- ``regenerate``: the text so far is dropped (and replaced by this one, if any).

Events of a message are folded in order of ``seq``; a message stands where its first event does. A null
text is empty, a null role is an empty role, a null ``conv_id`` or ``message_id`` is a value like any other.
Events with equal ``seq`` are ordered by kind, role and text. A message without a ``message`` event has
the role of its first event that has one. Unknown kinds count as ``delta``. Empty logs give no rows, extra
columns are ignored.

A turn is written as ``### Assistant: text</turn>`` and a line feed. In texts and roles ``\\``, ``#``,
``<`` (and ``:`` in roles) are written as ``\\0``, ``\\1``, ``\\2`` and ``\\3``, so neither mark can occur inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tablerich.llm.common import query, table

END = "</turn>\n"
ESCAPES = (("\\", "\\0"), ("#", "\\1"), ("<", "\\2"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\3"))
#: Roles with a display name; any other is written as "=" and the role.
NAMED = {"system": "System", "user": "User", "assistant": "Assistant"}
KINDS = {"message": 0, "regenerate": 1, "edit": 2}


def _escape(text: Column, escapes=ESCAPES) -> Column:
    for plain, code in escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def _unescape(text: Column, escapes=ESCAPES) -> Column:
    # The backslash comes last: until then each one begins a code.
    for plain, code in reversed(escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _label(role: Column) -> Column:
    label = F.concat(F.lit("="), _escape(role, ROLE_ESCAPES))
    for name, shown in NAMED.items():
        label = F.when(role == name, F.lit(shown)).otherwise(label)
    return label


def _role(label: Column) -> Column:
    role = _unescape(F.substring(label, 2, 1 << 30), ROLE_ESCAPES)
    for name, shown in NAMED.items():
        role = F.when(label == shown, F.lit(name)).otherwise(role)
    return role


def fold(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, seq, role, text``; ``seq`` is that of the first event.

    The log is partitioned by conversation and message, so a long conversation is folded by many tasks.
    """
    rank = F.lit(len(KINDS))
    for kind, place in KINDS.items():
        rank = F.when(F.col("kind") == kind, F.lit(place)).otherwise(rank)
    text = F.coalesce(F.col("text"), F.lit(""))
    log = events.select(
        "conv_id", "message_id", "seq", rank.alias("rank"), F.col("role"), text.alias("text"),
        F.col("kind").isin(*KINDS).cast("int").alias("reset"),
    )
    message = ["conv_id", "message_id"]
    order = ["seq", "rank", "role", "text"]
    so_far = Window.partitionBy(*message).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*message).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        log.withColumns(
            {
                "resets": F.sum("reset").over(so_far),
                "place": F.row_number().over(Window.partitionBy(*message).orderBy(*order)),
                "first_seq": F.first("seq").over(whole),
                "first_role": F.first("role", ignorenulls=True).over(whole),
            }
        )
        .withColumn("last_reset", F.max("resets").over(whole))
        .filter("resets = last_reset")
        .groupBy(*message)
        .agg(
            F.first("first_seq").alias("seq"),
            F.coalesce(F.first("first_role"), F.lit("")).alias("role"),
            F.array_sort(F.collect_list(F.struct("place", "text"))).alias("parts"),
        )
        .select("conv_id", "seq", "role", F.array_join(F.col("parts.text"), "").alias("text"))
    )


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row for each conversation: ``conv_id, formatted, spans``.

    ``spans`` are ``(start, length)`` in code points, from 1, of the escaped texts of ``loss_roles``. Messages
    are ordered by ``seq``, then role and text; a conversation is one value, so it is put together in one task.
    """
    head = F.concat(F.lit("### "), _label(F.col("role")), F.lit(": "))
    pieces = messages.select("conv_id", "seq", "role", head.alias("head"), _escape(F.col("text")).alias("body")).withColumn(
        "size", F.length("head") + F.length("body") + F.lit(len(END))
    )
    before = Window.partitionBy("conv_id").orderBy("seq", "role", "body").rowsBetween(Window.unboundedPreceding, -1)
    placed = pieces.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    span = F.struct((F.col("start") + F.length("head") + 1).alias("start"), F.length("body").cast("bigint").alias("length"))
    return (
        placed.groupBy("conv_id")
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "start",
                        F.concat("head", "body", F.lit(END)).alias("piece"),
                        F.when(F.col("role").isin(*loss_roles), span).alias("span"),
                    )
                )
            ).alias("turns")
        )
        .select(
            "conv_id",
            F.array_join(F.col("turns.piece"), "").alias("formatted"),
            F.filter(F.col("turns.span"), lambda s: s.isNotNull()).alias("spans"),
        )
    )


def parse(rendered: DataFrame) -> DataFrame:
    """Read rendered conversations back: ``conv_id, turns, loss_text, formatted``; ``turns`` holds ``(role, text)``."""

    def turn(piece: Column) -> Column:
        label = F.substring_index(F.substring(piece, 5, 1 << 30), ": ", 1)
        body = F.substring(piece, F.length(label) + F.lit(7), F.lit(1 << 30))
        return F.struct(_role(label).alias("role"), _unescape(body).alias("text"))

    pieces = F.filter(F.split("formatted", END), lambda p: p != "")
    covered = F.transform("spans", lambda s: _unescape(F.substring("formatted", s["start"].cast("int"), s["length"].cast("int"))))
    return rendered.select(
        "conv_id", F.transform(pieces, turn).alias("turns"), F.array_join(covered, "").alias("loss_text"), "formatted"
    )


def turn_events(turns: DataFrame) -> DataFrame:
    """A table of turns (``conv_id, turn, role, text``) as the log of a chat service.

    Turns of assistants are streamed: a draft, which is generated anew, then the text in parts. Others arrive whole and
    are edited once. Repeated ``(conv_id, turn)`` rows are messages of their own, ordered by role and text.
    """
    same = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    text = F.col("text")
    half = F.floor(F.length(text) / 2).cast("int")

    def log(*steps: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(i).alias("step"), F.lit(kind).alias("kind"), part.alias("text")) for i, (kind, part) in enumerate(steps)])

    none, draft = F.lit(None).cast("string"), F.substring(text, 1, 8)
    streamed = log(("message", F.lit("")), ("delta", draft), ("regenerate", none), ("delta", F.left(text, half)), ("delta", F.substring(text, half + 1, F.length(text))))
    whole = log(("message", draft), ("edit", text))
    return (
        turns.select("conv_id", "turn", "role", "text")
        .withColumn("n", F.row_number().over(same))
        .withColumn("e", F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(whole)))
        .select(
            "conv_id",
            F.struct("turn", "n", "e.step").alias("seq"),
            "e.kind",
            F.struct("turn", "n").alias("message_id"),
            "role",
            "e.text",
        )
    )


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), s AS (
  SELECT *, CASE WHEN role IN ('system', 'user', 'assistant') THEN length(role)
    ELSE 1 + length(role) + length(regexp_replace(role, '[^\\#<:]', '', 'g')) END
    + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g')) + 14 AS size
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""


@query("op3_chat_formatting", SQL)
def op3_chat_formatting(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = F.lit("\\### Assistant: </turn> ok")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), hard.alias("text"),
    )
    read_back = parse(render(fold(turn_events(turns.unionByName(extra)))))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_back.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
