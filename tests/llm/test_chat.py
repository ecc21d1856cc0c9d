import pytest

from tidemark.llm import chat


def brute(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t, r or "", x or ""))
    content = {}
    for c, turns in convs.items():
        content[c] = [(r, x) for t, r, x in sorted(turns, key=lambda v: (v[0] is not None, v[0] or 0))]
    out = {}
    for c, mine in content.items():
        if any(o != c and other[:len(mine)] == mine and (len(other) > len(mine) or o < c) for o, other in content.items()):
            continue
        out[c] = "".join(f"<|{r}|>\n{x}<|end|>\n" for r, x in mine)
    return out


ROWS = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (3, 0, "user", "hi"), (3, 1, "assistant", "hello"),
        (3, 2, "user", "more"), (4, 5, "user", "hi"), (4, 9, "assistant", "other"), (5, 0, "user", "hi"), (5, 1, "assistant", "hello"),
        (5, 2, "user", "more"), (6, 0, None, None), (6, 1, "user", ""), (7, None, "", ""), (8, 0, "assistant", "hi"), (None, 0, "user", "lost"),
        (9, 0, "user", "hi "), (10, -3, "user", "hi"), (10, 7, "assistant", "hello"), (11, 0, "user", "long " * 50000)]


@pytest.mark.parametrize("part", [1024, 2])
def test_like_brute_force(spark, part):
    rows = ROWS + [(20, i, "user", str(i)) for i in range(9)] + [(21, i, "user", str(i)) for i in range(7)]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], "conv_id bigint, turn bigint, role string, text string, part string, pos int")
    got = {}
    for r in sorted(chat.format_chats(df, part).collect(), key=lambda r: r.part):
        got[r.conv_id] = got.get(r.conv_id, "") + r.text
    assert got == brute(rows)


def test_ties_and_repeats_are_stable(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "b"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 1, "user", "c"), (3, 0, "user", "a"), (3, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r.n_turns for r in chat.format_chats(df).collect()}
    assert got == {2: 3, 3: 2}


def test_empty_and_native(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.format_chats(df).count() == 0
    plan = chat.format_chats(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Cartesian", "NestedLoop"))


def test_turns_without_numbers_in_bulk(spark, monkeypatch):
    """A conversation whose turns share a number, or have none, is split like any other."""
    nulls = [(1, None, "user", f"t{i}") for i in range(60)]
    rows = nulls + [(2, t, r, x) for _, t, r, x in nulls] + [(2, 5, "user", "last")] + [(3, 7, "a", f"s{i}") for i in range(40)] + [(4, 0, "u", "same")] * 30
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    results = []
    for crowded in (1, 10 ** 6):
        monkeypatch.setattr(chat, "CROWDED", crowded)
        cells = [r["count"] for r in chat._turns(df, 8).groupBy("conv_id", "cell").count().collect()]
        assert max(cells) <= 30 if crowded == 1 else max(cells) == 60
        results.append(sorted(map(tuple, chat.format_chats(df, 8).collect())))
    assert results[0] == results[1]
    turns = {}
    for conv, part, n, _ in results[0]:
        assert n == 8 or part == max(p for c, p, *_ in results[0] if c == conv)
        turns[conv] = turns.get(conv, 0) + n
    assert turns == {2: 61, 3: 40, 4: 30}                # 1 is the beginning of 2


def test_rows_do_not_depend_on_turn_numbers(spark):
    for first in (0, 1022, -5000):
        rows = [(1, first + 3 * i, "user", str(i)) for i in range(4)]
        df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
        assert [(r.part, r.n_turns) for r in chat.format_chats(df).collect()] == [(0, 4)]
