from ledgerloom.operators.packed import CLOSE, OPEN, explode_packed, readings

FIELDS = {"topic_names": "topic", "subs": "track"}


def run(spark, rows):
    df = spark.createDataFrame(rows, "direction_id bigint, topic_count int, topic_names string, subs string, value string, pos int")
    cat = {"topic": spark.createDataFrame([("A,B",), ("A",), ("B",), ("C",), ('x"Y"z',)], "label string"), "track": spark.createDataFrame([("P/Q",), ("R",)], "name string")}
    out = {}
    for r in explode_packed(df, "direction_id", FIELDS, cat, "topic_count").collect():
        out.setdefault((r.direction_id, r.field_name), []).append((r.pos, r.value))
    return {k: [v for _, v in sorted(x)] for k, x in out.items()}


def test_readings(spark):
    got = run(spark, [
        (1, 2, "A,B", "P/Q | R", "x", 1),
        (2, 1, "A,B", '"P/Q"/R', "x", 1),
        (3, None, '["A,B", "\\u4e2d"]', "['P/Q', 'R']", "x", 1),
        (4, None, '"x""Y""z"；C', "R；；R", "x", 1),
        (5, None, 'x"Y"z', f"{OPEN}0{CLOSE}|R", "x", 1),
        (6, None, None, "", "x", 1),
        (7, None, "  ", "[]", "x", 1),
        (8, None, "'A,B'、C", "﻿R<br>P/Q ", "x", 1),
    ])
    assert got[1, "topic_names"] == ["A", "B"] and got[1, "subs"] == ["P/Q", "R"]
    assert got[2, "topic_names"] == ["A,B"] and got[2, "subs"] == ["P/Q", "R"]
    assert got[3, "topic_names"] == ["A,B", "中"] and got[3, "subs"] == ["P/Q", "R"]
    assert got[4, "topic_names"] == ['x"Y"z', "C"] and got[4, "subs"] == ["R", "R"]
    assert got[5, "topic_names"] == ['x"Y"z'] and got[5, "subs"] == [f"{OPEN}0{CLOSE}", "R"]
    assert (6, "topic_names") not in got and (6, "subs") not in got and (7, "topic_names") not in got and (7, "subs") not in got
    assert got[8, "topic_names"] == ["A,B", "C"] and got[8, "subs"] == ["R", "P/Q"]


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_choice_prefers_the_expected_number():
    known = {(0, 0), (1, 1), (0, 1)}
    assert readings(["A", "B"], [","], known, 2) == [(0, 0), (1, 1)]
    assert readings(["A", "B"], [","], known, 1) == [(0, 1)]


def test_long_cells(spark):
    got = run(spark, [(1, None, "C|" * 5000 + "A,B", "；".join(["R", "P/Q"] * 300), "x", 1)])
    assert got[1, "topic_names"] == ["C"] * 5000 + ["A,B"] and got[1, "subs"] == ["R", "P/Q"] * 300


def test_long_cells_are_read_as_short_ones():
    for n in (3, 150):  # values with a sign in them that no catalogue knows
        tokens, delims = ["x", "y"] * n, (["/", ";"] * n)[:-1]
        assert readings(tokens, delims, set(), n) == [(2 * i, 2 * i + 1) for i in range(n)]


def test_all_choices_among_many_kinds_of_separator():
    tokens, delims = list("abcdefgh"), [",", ";", "/", "|", "、", "；", "，"]
    assert readings(tokens, delims, set(), 3) == [(0, 0), (1, 1), (2, 7)]


def test_values_of_many_pieces_are_joined(spark):
    value, quoted = "a/b/c/d,e;f|g", 'x|"p,q"|z'
    cat = {"topic": spark.createDataFrame([(value,), (quoted,), ("A",), (None,), ("",)], "label string")}
    df = spark.createDataFrame([(1, None, f"A|{value}|A"), (2, 2, f"{quoted},{value}")], "k bigint, n int, topic_names string")
    got = {}
    for r in explode_packed(df, "k", {"topic_names": "topic"}, cat, "n").collect():
        got.setdefault(r.k, []).append((r.pos, r.value))
    assert sorted(got[1]) == [(1, "A"), (2, value), (3, "A")] and [v for _, v in sorted(got[2])][1] == value
