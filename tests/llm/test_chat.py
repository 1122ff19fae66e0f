from collections import defaultdict

from panelscope.llm import chat as C

ROWS = [(1, 0, "ann", "hi"), (1, 1, "bob", "é 𝔸"), (1, 2, "ann", None), (1, 3, None, "who"), (2, 0, "user", ""),
        (None, None, "x", "n"), (None, 1, "y", "m"), (3, 5, "a", "same"), (3, 5, "a", "same"), (3, None, "b", "first")]
SCHEMA = "conv_id long, turn long, role string, text string"


def whole(rows):
    """Rendered text and masks of every dialogue and participant, parts joined."""
    parts = defaultdict(list)
    for r in rows:
        parts[r["conv_id"], r["participant"]].append(r)
    out = {}
    for key, ps in parts.items():
        text, masks = "", []
        for p in sorted(ps, key=lambda p: p["part"]):
            masks += [p["rendered"][m["start"]:m["end"]] for m in p["masks"]]
            text += p["rendered"]
        out[key] = (text, masks)
    return out


def expected(rows):
    people = defaultdict(set)
    for c, _, r, _ in rows:
        people[c].add(r or "unknown")
    out = {}
    for c, who in people.items():
        said = sorted(((t is not None, t or 0, r or "unknown", x or "") for k, t, r, x in rows if k == c))
        for p in who:
            text = "".join(C.OPEN + ("assistant" if r == p else f"user name={r}") + "\n" + x + C.CLOSE for _, _, r, x in said)
            out[c, p] = (text, [x for _, _, r, x in said if r == p])
    return out


def test_every_perspective(spark):
    got = whole(C.rotate(spark.createDataFrame(ROWS, SCHEMA)).collect())
    assert got == expected(ROWS)


def test_parts_join_to_the_whole(spark):
    rows = [(1, i, "ab"[i % 2], f"message {i} " * (i % 5)) for i in range(700)]
    out = C.rotate(spark.createDataFrame(rows, SCHEMA).repartition(5), part_chars=2000, block=8).collect()
    assert max(len(r["rendered"]) for r in out) < 2200 and len(out) > 10
    assert whole(out) == expected(rows)


def test_ties_of_one_turn(spark):
    rows = [(1, 0, "a", f"m{i % 40}") for i in range(200)]
    out = C.rotate(spark.createDataFrame(rows, SCHEMA)).collect()
    (text, masks), = whole(out).values()
    assert sorted(masks) == sorted(x for _, _, _, x in rows)
    again = whole(C.rotate(spark.createDataFrame(rows[::-1], SCHEMA).repartition(3)).collect())
    assert again == {(1, "a"): (text, masks)}


def test_empty_and_more_columns(spark):
    rows = spark.createDataFrame([(*r, "x", 1) for r in ROWS], SCHEMA + ", participant string, part int")
    assert whole(C.rotate(rows).collect()) == expected(ROWS)
    assert C.rotate(rows.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    assert "Python" not in C.rotate(spark.createDataFrame(ROWS, SCHEMA).limit(9))._jdf.queryExecution().toString()
