import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lotwise.llm import chat_format as C

TRICKY = st.lists(st.sampled_from([*"\\#<>/turn:aé\n ", "</turn>", "### ", "\\n\\"]), max_size=30).map("".join)


@given(st.lists(st.tuples(TRICKY, TRICKY), max_size=5))
@settings(max_examples=300, deadline=None)
def test_round_trip(turns):
    formatted = "".join(C.render(r, t) for r, t in turns)
    assert C.parse(formatted) == turns
    assert formatted.count("</turn>") == len(turns)


def test_bad_input_is_refused():
    with pytest.raises(ValueError):
        C.parse("### user: a</turn>\nx")


def digests(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    everything = "".join(f"{r}\n{t}\n" for r, t in turns)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(turns), sha(everything), len(loss), sha(loss), sum(len(C.render(*t)) for t in turns)


def run(spark, rows, extra=()):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns({n: F.lit("x") for n in extra})
    out = C.read_back(C.ordered_messages(C.folded_messages(C.conversation_events(df))))
    return {r["conv_id"]: tuple(r)[1:] for r in out.collect()}


def test_conversations(spark):
    rows = [(1, 1, "assistant", "b </turn> \\"), (1, 0, "user", "a ### x"), (2, 0, None, None), (2, None, "system", ""), (None, 0, "user", "n")]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "assistant", "z"), (-7, 0, "user", C.TRICKY), (-7, 1, "assistant", C.TRICKY)]
    rows += [(4, i, "assistant" if i % 2 else "user", "w" * 5000) for i in range(300)]
    got = run(spark, rows)
    assert got[1] == digests([("user", "a ### x"), ("assistant", "b </turn> \\")])
    assert got[2] == digests([("system", ""), ("", "")])
    assert got[None] == digests([("user", "n")])
    assert got[3] == digests([("assistant", "z"), ("user", "same"), ("user", "same")])
    assert got[-7] == digests([("user", C.TRICKY), ("assistant", C.TRICKY)])
    assert got[4] == digests([("assistant" if i % 2 else "user", "w" * 5000) for i in range(300)])
    assert run(spark, []) == {}
    assert run(spark, rows, extra=("seq", "op", "msg_id", "pos", "step", "e", "formatted", "n_turns")) == got


def test_log_of_turns_has_every_op_and_folds_back(spark):
    rows = [(i % 5, i, "user", None if i % 7 == 0 else f"t{i} \U0001f642é" * (i % 4)) for i in range(100)] + [(None, None, None, None)] * 2
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    events = C.conversation_events(df)
    assert {r["op"] for r in events.select("op").distinct().collect()} == {"message", "delta", "edit", "regenerate"}
    assert events.groupBy("msg_id").count().filter("count > 1").count() > 30
    got = [(r["conv_id"], r["pos"]["turn"], r["role"], r["text"]) for r in C.folded_messages(events).collect()]
    assert sorted(got, key=str) == sorted([(c, t, r or "", x or "") for c, t, r, x in rows], key=str)


def test_keys_of_other_types(spark):
    log = [("c", 0.5, "message", 1, "user", "a"), ("c", 1.5, "delta", 1, None, "b"), ("c", 0.7, "message", 2, "user", "z")]
    events = spark.createDataFrame(log, "conv_id string, seq double, op string, msg_id short, role string, text string")
    out = C.read_back(C.ordered_messages(C.folded_messages(events)))
    assert [tuple(r) for r in out.collect()] == [("c", *digests([("user", "ab"), ("user", "z")]))]


def test_fold_of_events(spark):
    log = [
        (1, 0, "message", "m1", "user", "hi"), (1, 1, "message", "m2", "assistant", "Hel"), (1, 2, "delta", "m2", None, "lo"),
        (1, 3, "regenerate", "m2", None, None), (1, 4, "delta", "m2", "assistant", "Bet"), (1, 5, "delta", "m2", None, "ter"),
        (1, 6, "edit", "m1", "user", "hello"), (1, 7, "message", "m3", "user", "bye"), (1, 8, "delta", "m3", None, None), (2, 0, None, None, None, None),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, op string, msg_id string, role string, text string").repartition(3)
    messages = C.folded_messages(events)
    got = sorted((tuple(r) for r in messages.filter("conv_id = 1").collect()), key=lambda r: r[2])
    assert got == [(1, "m1", 0, "user", "hello"), (1, "m2", 1, "assistant", "Better"), (1, "m3", 7, "user", "bye")]
    assert [tuple(r) for r in messages.filter("conv_id = 2").collect()] == [(2, None, 0, "", "")]
    whole = {r["conv_id"]: r["formatted"] for r in C.formatted_conversations(messages).collect()}
    assert C.parse(whole[1]) == [("user", "hello"), ("assistant", "Better"), ("user", "bye")]


def test_sql_says_the_same(spark):
    duckdb = pytest.importorskip("duckdb")
    rows = [(c, t, "assistant" if t % 2 else "user", x) for c in range(3) for t, x in enumerate(["a ## b", "###### \\ </turn></turn>", None, "\\#", "x\n</turn>\n"])]
    # ties of a turn, also in role and text, and null turns and roles
    rows += [(3, 1, r, x) for r, x in (("b", "z"), ("assistant", "y"), ("assistant", "x"), (None, "é"), ("assistant", None), ("Z", "Z"), ("assistant", "x"))]
    rows += [(4, None, "assistant", "n"), (4, 0, "user", "a"), (4, None, "assistant", "m"), (4, None, None, None), (None, 3, "assistant", "q")]
    con = duckdb.connect()
    con.sql("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = {r[0]: tuple(r[1:]) for r in con.sql(C.SQL["op5_event_sourced_chat"]).fetchall()}
    assert run(spark, rows + [(-7, 0, "user", C.TRICKY), (-7, 1, "assistant", C.TRICKY)]) == want
