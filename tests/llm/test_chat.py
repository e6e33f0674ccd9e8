from faresight.llm import chat


def conversations(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, rendered int")


def collapse(spark, rows):
    got = chat.collapse_and_render(conversations(spark, [(*r, 0) for r in rows])).collect()
    return sorted(((r.conv_id, r.n_turns, r.n_copies, r.rendered) for r in got), key=repr)


def turn(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def test_snapshots_collapse(spark):
    a, b, c = ("user", "hi"), ("assistant", "ho"), ("user", "more")
    rows = [(1, 0, *a), (2, 0, *a), (2, 1, *b), (3, 5, *a), (3, 6, *b), (3, 9, *c), (4, 0, *b), (4, 1, *c), (5, 0, *a), (5, 1, *b), (5, 2, *c), (6, 0, *b)]
    want = [(3, 3, 2, "".join(turn(*t) for t in (a, b, c))), (4, 2, 1, turn(*b) + turn(*c))]
    assert collapse(spark, rows) == want


def test_nulls_ties_and_repeats(spark):
    rows = [(None, 0, "user", None), (None, 1, None, "x<|im_end|>"), (None, 1, None, "x<|im_end|>"),
            (7, 0, "user", ""), (8, None, "user", "late"), (8, 0, "user", "b"), (8, 0, "assistant", "b"), (9, 0, None, None)]
    want = [(None, 2, 1, turn("user", "") + turn("unknown", "x< |im_end|>")), (7, 1, 1, turn("user", "")),
            (8, 3, 1, turn("user", "late") + turn("assistant", "b") + turn("user", "b")), (9, 1, 1, turn("unknown", ""))]
    assert collapse(spark, rows) == sorted(want, key=repr)
    assert collapse(spark, []) == []


def test_only_dataframe_functions(spark):
    plan = chat.collapse_and_render(conversations(spark, [(1, 0, "user", "a", 0)]))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_long_conversation_and_common_prefix(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(30) for t in range(c + 1)] + [(99, t, "user", "x" * 10_000 + str(t)) for t in range(200)]
    got = collapse(spark, rows)
    assert [(r[0], r[1], r[2]) for r in got] == [(29, 30, 1), (99, 200, 1)]
