import random

from tiffin.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part int, copies int, place int, chunk int"


def formatted(spark, rows):
    df = spark.createDataFrame([(*r, 0, 0, 0, 0) for r in rows], SCHEMA)
    return {(r.conv_id, r.part): (r.n_turns, r.copies, r.text) for r in chat.format_chats(df).collect()}


def brute(rows):
    convs = {}
    for c, t, role, text in set(rows):
        convs.setdefault(c, []).append((t is not None, t, role, text))
    said = {c: [x[2:] for x in sorted(v, key=lambda x: x[:2])] for c, v in convs.items()}
    turns = {c: [x[1] for x in sorted(v, key=lambda x: x[:2])] for c, v in convs.items()}
    kept = [c for c, s in said.items() if not any(len(o) > len(s) and o[: len(s)] == s for o in said.values())]
    out = {}
    for c in kept:
        same = [o for o in kept if said[o] == said[c]]
        if c == min(same, key=lambda x: (x is None, x)):
            for t, (role, text) in zip(turns[c], said[c], strict=True):
                part = -1 if t is None else t // chat.CHUNK
                n, copies, line = out.get((c, part), (0, len(same), ""))
                out[c, part] = n + 1, copies, f"{line}<|im_start|>{role or ''}\n{text or ''}<|im_end|>\n"
    return out


def test_snapshots_collapse_to_the_longest(spark):
    rng = random.Random(4)
    rows, c = [], 0
    for _ in range(40):
        turns = [(rng.choice(["user", "assistant"]), rng.choice("abc")) for _ in range(rng.randint(1, 5))]
        for n in range(1, len(turns) + 1):
            if rng.random() < 0.7:
                rows += [(c, i, *turns[i]) for i in range(n)]
                c += 1
    assert formatted(spark, rows) == brute(rows)


def test_long_conversations_come_in_parts(spark):
    long = [(1, i, "user", f"t{i}") for i in range(3 * chat.CHUNK + 5)]
    prefix = [(2, i, "user", f"t{i}") for i in range(2 * chat.CHUNK + 1)]
    other = [(3, i, "user", f"t{i}" if i != 300 else "x") for i in range(2 * chat.CHUNK)]
    rows = long + prefix + other
    got = formatted(spark, rows)
    assert got == brute(rows)
    assert {c for c, _ in got} == {1, 3} and len(got) == 6


def test_nulls_repeats_and_order(spark):
    rows = [
        (1, 1, "assistant", None), (1, 0, "user", "hi"), (1, 0, "user", "hi"),
        (2, 0, "user", "hi"), (2, 1, "assistant", ""),
        (None, 0, "user", "hi"),
        (3, 5, "user", "hi"), (3, 9, "assistant", None),  # equal to 1, other turn numbers
        (4, None, "system", "first"), (4, 0, None, "second"),
        (5, None, "system", "first"),
    ]
    got = formatted(spark, rows)
    assert got == brute(rows)
    assert got[1, 0][1] == 2 and (3, 0) not in got and (5, -1) not in got
    assert formatted(spark, []) == {}


def test_a_reordered_conversation_is_no_copy(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (2, 0, "user", "b"), (2, 1, "user", "a"), (2, 2, "user", "c")]
    assert {c for c, _ in formatted(spark, rows)} == {1, 2}


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "hi", 0, 0, 0, 0)], SCHEMA)
    plan = chat.format_chats(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_groups_are_bounded_whatever_the_turn_numbers(spark):
    n = 2 * chat.CHUNK + 10
    rows = [(1, 0, "user", f"same {i}") for i in range(n)]  # one repeated turn number
    rows += [(None, None, "user", f"none {i}") for i in range(n)]  # no numbers, no conversation
    rows += [(2, 1_700_000_000_000 + 5_000 * i, "user", f"ms {i}") for i in range(20)]  # sparse ones
    got = formatted(spark, rows)
    assert max(k for k, _, _ in got.values()) == chat.CHUNK
    assert sorted(p for c, p in got if c is None) == [-3, -2, -1] and sorted(p for c, p in got if c == 1) == [0, 1, 2]
    assert {k: v for k, v in got.items() if k[0] == 2} == {
        (2, 0): (20, 1, "".join(f"<|im_start|>user\nms {i}<|im_end|>\n" for i in range(20)))
    }
    for c, lines in ((1, rows[:n]), (None, rows[n : 2 * n])):
        text = "".join(got[k][2] for k in sorted((k for k in got if k[0] == c), key=lambda k: k[1]))
        assert sorted(text.split("<|im_end|>\n")[:-1]) == sorted(f"<|im_start|>user\n{t}" for _, _, _, t in lines)


def test_sql_numbers_turns_by_place_too(spark):
    import duckdb

    from tiffin.llm.oracle import ORACLE_SQL

    rows = [(1, i, "user", f"t{i}") for i in range(1, 301)]  # from one on
    rows += [(2, 10**12 * i, "user", f"u{i}") for i in range(3)] + [(3, i - 600, None, f"v{i}") for i in range(600)]
    rows += [(4, None, "user", "w"), (4, 0, "user", "x"), (4, 7, None, None), (None, 5, "user", "y")]
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    table = con.execute(ORACLE_SQL["op3_chat_formatting"]).fetchall()
    assert {(c, part): (n, copies, text) for c, part, n, copies, text in table} == formatted(spark, rows)
    assert formatted(spark, rows)[2, 0][0] == 3
