import pytest

from tablerich.llm import chat

EVENTS = "conv_id long, seq long, kind string, message_id long, role string, text string"


def turns_of(spark, events):
    parsed = chat.parse(chat.render(chat.fold(spark.createDataFrame(events, EVENTS).repartition(3))))
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss_text, r.formatted) for r in parsed.collect()}


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 10, "message", 1, "user", "Hi"),
        (1, 20, "message", 2, "assistant", ""),
        (1, 21, "delta", 2, None, "Wrong "),
        (1, 22, "delta", 2, None, "start"),
        (1, 23, "regenerate", 2, None, None),
        (1, 24, "delta", 2, None, "Right"),
        (1, 25, "delta", 2, None, " answer"),
        (1, 30, "edit", 1, None, "Hello"),
        (1, 40, "message", 3, "user", "Bye"),
        (2, 1, "delta", 9, "system", "late role"),
    ]
    got = turns_of(spark, events)
    assert got[1][0] == [("user", "Hello"), ("assistant", "Right answer"), ("user", "Bye")]
    assert got[1][1] == "Right answer"
    assert got[2][0] == [("system", "late role")]


HARD = [
    "", "\\", "\\0", "#", "### User: ", "</turn>\n", "\\### Assistant: </turn> ok", "\\2\\1\\0#<", "a\nb", "é漢\U0001f600 <b>",
    "x" * 200_000,
]


@pytest.mark.parametrize("role", ["user", "assistant", "User", "=user", "a: b", "", "#<\\:"])
def test_round_trip(spark, role):
    events = [(1, i, "message", i, role, t) for i, t in enumerate(HARD)]
    turns, loss, formatted = turns_of(spark, events)[1]
    assert turns == [(role, t) for t in HARD]
    assert loss == ("".join(HARD) if role == "assistant" else "")
    assert formatted.count(chat.END) == len(HARD)


def test_nulls_ties_and_empty_log(spark):
    events = [
        (None, 1, "message", None, None, None),
        (None, 1, "delta", None, "user", "b"),
        (None, 1, "delta", None, "user", "a"),
        (5, 1, "message", 1, "user", "same"),
        (5, 1, "message", 2, "user", "same"),
    ]
    got = turns_of(spark, events)
    assert got[None][0] == [("user", "ab")]
    assert got[5][0] == [("user", "same")] * 2
    assert turns_of(spark, []) == {}


def test_repeated_turns_are_messages_of_their_own(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "assistant", None)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS seq", "2 AS kind")
    (row,) = chat.parse(chat.render(chat.fold(chat.turn_events(table)))).collect()
    assert [(t.role, t.text) for t in row.turns] == [("assistant", ""), ("user", "a"), ("user", "a"), ("user", "b")]
