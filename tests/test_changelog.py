"""Expected patches, states and checks of form change logs."""

from ledgerspark.operators import changelog as cl

CELLS = "log int, field int, ordinal int, sub int, values array<string>"


def cells(spark, *rows):
    return spark.createDataFrame(list(rows), CELLS)


def table(field, *rows, log=1):
    """rows: (ordinal, {sub: [values]})"""
    return [(log, field, o, s, v) for o, cols in rows for s, v in cols.items()]


def plain(field, values, log=1):
    return [(log, field, -1, -1, values)]


def patch(spark, before, after):
    out = cl.changelog_patch(cells(spark, *before), cells(spark, *after), ["log"])
    return {(r.field, r.ordinal, r.sub): (r.op, r["values"]) for r in out.collect()}


def test_plain_fields(spark):
    before = plain(1, ["b1"]) + plain(2, ["b2"]) + plain(4, ["b1"])
    after = plain(1, ["a1"]) + plain(3, ["a3"]) + plain(4, [])
    assert patch(spark, before, before) == {(f, -1, -1): ("replace", [v]) for f, v in ((1, "b1"), (2, "b2"), (4, "b1"))}
    assert patch(spark, before, after) == {
        (1, -1, -1): ("replace", ["a1"]), (2, -1, -1): ("remove", None), (3, -1, -1): ("add", ["a3"]),
    }


def test_table_rows(spark):
    b4 = table(4, (0, {41: ["a41"], 42: []}), (1, {41: ["b41"], 42: ["b42"]}), (2, {41: ["c41"], 42: []}))
    a4 = table(4, (0, {41: ["a41"], 42: ["a42"]}), (1, {41: ["b41"], 42: ["b42"]}))
    assert set(patch(spark, b4, b4)) == {(4, 0, 41), (4, 1, 41), (4, 1, 42), (4, 2, 41)}
    out = patch(spark, b4, a4)
    assert out[(4, 0, 42)] == ("replace", ["a42"])
    assert out[(4, 2, 41)] == out[(4, 2, 42)] == ("remove", None)
    assert len(out) == 6
    a5 = table(5, (0, {41: ["a41"], 42: ["a42"]}), (1, {41: ["a41"], 42: []}))
    assert {v[0] for v in patch(spark, b4, b4 + a5).values()} == {"replace"}
    assert (5, 1, 42) not in patch(spark, b4, b4 + a5)
    b7 = table(7, (1, {41: ["a41"], 42: []}))
    a7 = table(7, (0, {41: ["a41"], 42: []}), (1, {41: ["b41"], 42: []}))
    assert patch(spark, b7, a7) == {(7, 0, 41): ("replace", ["a41"]), (7, 1, 41): ("replace", ["b41"])}
    b8, a8 = table(8, (0, {41: ["a41"], 42: ["a42"]})), table(8, (0, {41: ["a41m"], 42: []}))
    assert patch(spark, b8, a8) == {(8, 0, 41): ("replace", ["a41m"]), (8, 0, 42): ("remove", None)}
    b9 = table(9, *[(o, {41: [], 42: [v]}) for o, v in ((0, "a42"), (2, "c42"), (4, "e42"))])
    assert patch(spark, b9, b9) == {(9, o, 42): ("replace", [v]) for o, v in ((0, "a42"), (2, "c42"), (4, "e42"))}
    assert patch(spark, table(10, (0, {41: [], 42: ["a42"]})), []) == {}
    b11, a11 = table(11, (0, {41: ["a41"]})), table(11, (0, {41: ["a41"], 42: ["a42"]}))
    assert patch(spark, b11, a11) == {(11, 0, 41): ("replace", ["a41"]), (11, 0, 42): ("replace", ["a42"])}


LOG = "path string, log_id int, op string, values array<string>"


def state_after(rebuilt, t):
    rows = [r for r in rebuilt if r.valid_from <= t and (r.valid_to is None or t < r.valid_to)]
    out = {}
    for r in sorted(rows, key=lambda r: (r.path, r.valid_from, r.nth)):
        out.setdefault(r.path, []).append(r.value)
    return out


def test_rebuild_state(spark):
    log = spark.createDataFrame(
        [
            ("f0", 1, "replace", ["20"]), ("f0", 2, "replace", ["30"]),
            ("f2", 1, "replace", ["20"]), ("f2", 2, "remove", None),
            ("f3", 2, "add", ["20"]),
            ("f4", 1, "replace", ["20"]), ("f4", 2, "add", ["30"]), ("f4", 3, "add", ["40", "50"]), ("f4", 5, "replace", ["1"]),
            ("f6", 2, "remove", None),
        ],
        LOG,
    )
    for limit in (1, 5):
        rebuilt = cl.changelog_rebuild_state(log, ["path"], chunks=limit).collect()
        assert state_after(rebuilt, 1) == {"f0": ["20"], "f2": ["20"], "f4": ["20"]}
        assert state_after(rebuilt, 2) == {"f0": ["30"], "f3": ["20"], "f4": ["20", "30"]}
        assert state_after(rebuilt, 4) == {"f0": ["30"], "f3": ["20"], "f4": ["20", "30", "40", "50"]}
        assert state_after(rebuilt, 9) == {"f0": ["30"], "f3": ["20"], "f4": ["1"]}


def test_rebuild_equals_replay(spark):
    """Every state equals a plain replay of a random log."""
    import random

    rng = random.Random(7)
    rows = []
    for log_id in range(120):
        op = rng.choice(["replace", "add", "remove"])
        rows.append((rng.choice("abc"), log_id, op, None if op == "remove" else [str(log_id)] * rng.randint(1, 2)))
    log = spark.createDataFrame(rows, LOG)
    rebuilt = cl.changelog_rebuild_state(log, ["path"], chunks=6).collect()
    state = {}
    for path, t, op, values in rows:
        if op == "remove":
            state.pop(path, None)
        else:
            state[path] = (state.get(path, []) if op == "add" else []) + values
        assert state_after(rebuilt, t) == state


def test_check_before(spark):
    log = spark.createDataFrame(
        [("a", 1, None, ["1"]), ("a", 2, ["1"], ["2"]), ("a", 3, ["9"], None), ("a", 4, [], ["4"]), ("b", 1, ["x"], ["y"])],
        "path string, log_id int, before array<string>, after array<string>",
    )
    out = cl.changelog_check_before(log, ["path"]).collect()
    assert sorted((r.path, r.log_id) for r in out) == [("a", 3), ("b", 1)]


STATE = "field int, title string, values array<string>"


def problems(spark, left, right):
    l, r = (cl.state_values(spark.createDataFrame(rows, STATE), ["field"]) for rows in (left, right))
    out = cl.state_differences(l, r, ["field"])
    return {r.field: r.problem for r in out.collect()}


def test_state_differences(spark):
    v = [(0, "title", ["20"])]
    assert problems(spark, v, v) == {}
    assert problems(spark, v, []) == {0: "only left"}
    assert problems(spark, [], v) == {0: "only right"}
    assert problems(spark, [(4, "t", ["20", "30"])], [(4, "t", ["20"])]) == {4: "values"}
    assert problems(spark, [(4, "1", ["20"])], [(4, "2", ["20"])]) == {4: "title"}
    for bad in ("", None):
        assert problems(spark, [(4, bad, ["1"])], [(4, bad, ["1"])]) == {4: "no title"}
    assert problems(spark, [(1, "t", ["v1"]), (2, "t", [])], [(1, "t", ["v1"])]) == {}


def test_check_final_leaves_system_fields_out(spark):
    left = spark.createDataFrame([(2, "t", ["a"]), (9, "t", ["a"])], STATE)
    right = spark.createDataFrame([(2, "t", ["b"]), (9, "t", ["a"])], STATE)
    left, right = (cl.state_values(s, ["field"]) for s in (left, right))
    assert cl.changelog_check_final(left, right, ["field"]).count() == 0


def test_final_state_holds_added_values(spark):
    log = spark.createDataFrame([("p", 1, "replace", ["a"]), ("p", 2, "add", ["b", "c"]), ("q", 1, "add", ["x"]), ("q", 3, "remove", None)], LOG)
    final = cl.final_state(cl.changelog_rebuild_state(log, ["path"], chunks=3), ["path"], chunks=2).collect()
    assert sorted((r.path, r.place, r.value) for r in final) == [("p", 1, "a"), ("p", 2, "b"), ("p", 3, "c")]
