import duckdb
import pandas as pd
from pyspark.sql import functions as F

from strataflow.llm import chat, queries

SCHEMA = f"id long, chosen {chat.TURNS}, rejected {chat.TURNS}, prompt int"


def turns(*texts):
    return [("user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


def test_common_prefix_and_masks(spark):
    rows = [(1, turns("hi", "yes", "why", "good"), turns("hi", "yes", "why", "bad<|im_end|>"), 5),
            (2, turns("a", "b"), turns("c", "b"), 5), (3, turns("a", "b"), turns("a", "b"), 5),
            (4, turns("a", "b", "c"), turns("a"), 5), (5, turns("a"), None, 5), (6, None, None, None),
            (7, [(None, None), ("assistant", None)], [(None, None), ("assistant", "")], 5), (8, [], turns("x"), 5)]
    got = {r.id: r for r in chat.format_pairs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [got[i].n_common for i in range(1, 9)] == [3, 0, 2, 1, 0, 0, 1, 0]
    for i, chosen, rejected, _ in rows:
        r, n = got[i], got[i].n_common
        assert r.prompt == chat.render([{"role": a, "text": b} for a, b in (chosen or [])[:n]])[0]
        for text, mask, all_turns in ((r.chosen_completion, r.chosen_mask, chosen), (r.rejected_completion, r.rejected_mask, rejected)):
            said = [t or "" for role, t in (all_turns or [])[n:] if role == "assistant"]
            assert [text[m.start:m.end] for m in mask] == [t.replace("<|", "< |") + chat.CLOSE for t in said]
    assert got[1].prompt.count(chat.OPEN) == 3 and got[1].rejected_completion.count(chat.CLOSE) == 1


def table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_conversations_and_pairs(spark):
    rows = [(c, t, "user" if t == 0 else "assistant", "open" if t == 0 else "x" * c) for c in range(2050) for t in range(2)]
    rows += [rows[5], rows[5], (5000, 0, "user", "alone"), (5001, None, None, None), (None, 0, "user", "open"), (None, 0, "user", "open")]
    convs = chat.conversations(table(spark, rows).withColumn("block", F.lit(1)))
    assert convs.count() == 2053  # equal rows of a null id count once
    pairs = chat.pair_by_opening(convs).collect()
    ids = [i for r in pairs for i in (r.chosen_id, r.rejected_id) if i is not None]
    assert sorted(ids) == sorted([*range(2050), 5000, 5001])
    both = [r for r in pairs if r.rejected_id is not None]
    assert len(both) == 1025 and all(r.chosen_id == r.rejected_id + 1 for r in both)
    assert chat.pair_by_opening(chat.conversations(table(spark, []))).count() == 0


def test_partners_across_the_whole_opening(spark):
    ids = [-(1 << 62), -5000, -1, 0, 1023, 1024, 5000, 5001, 10 ** 12, (1 << 62) + 7, *range(20_000, 40_000, 7), (1 << 62) + 9]  # 2,869, odd
    rows = [(c, 0, "user", "open") for c in ids] + [(None, t, "user", "open") for t in range(2)] + [(3, 0, "user", "other")]
    convs = chat.conversations(table(spark, rows)).repartition(5)
    got = {r.rank: r.conv_id for r in chat.rank_in_opening(convs).where("turns[0].text = 'open'").collect()}
    assert [got[i + 1] for i in range(len(got))] == [*sorted(ids), None, None]
    pairs = [r for r in chat.pair_by_opening(convs).collect() if r.chosen[0].text == "open"]
    both = {(r.chosen_id, r.rejected_id) for r in pairs if r.rejected is not None}
    ordered = sorted(ids)
    assert len(pairs) == len(ids) // 2 + 2 and len([r for r in pairs if r.rejected is None]) == 1  # ids and two without
    assert both == set(zip(ordered[0:-1:2], ordered[1::2], strict=True)) | {(ordered[-1], None)}


def test_answers_of_the_next_conversation(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "one"), (1, 2, "user", "thanks"), (4, 0, "user", "b"), (4, 1, "assistant", "four"),
            (9, 0, "system", "c"), (9, 1, "assistant", "nine"), (9, 2, "user", "more"), (9, 3, "assistant", "nine again"),
            (12, 0, "user", "no answer"), (None, 0, "assistant", "no id"), (20, 0, "user", "pair"), (20, 1, "assistant", "long one"),
            (21, 0, "user", "pair"), (21, 1, "assistant", "short")]
    pairs = chat.with_other_answers(chat.pair_by_opening(chat.conversations(table(spark, rows))))
    got = {r.chosen_id: (r.rejected_id, [tuple(t) for t in r.rejected] if r.rejected else None) for r in pairs.collect()}
    assert got == {1: (4, [("user", "a"), ("assistant", "four")]), 4: (9, [("user", "b"), ("assistant", "nine again")]),
                   9: (1, [("system", "c"), ("assistant", "nine"), ("user", "more"), ("assistant", "one")]),
                   12: (None, None), None: (None, None), 20: (21, [("user", "pair"), ("assistant", "short")])}
    alone = chat.pair_by_opening(chat.conversations(table(spark, rows[:3])))
    assert chat.with_other_answers(alone).first().rejected is None
    assert chat.with_other_answers(chat.pair_by_opening(chat.conversations(table(spark, [])))).count() == 0


def test_very_long_turns(spark):
    rows = [(i, t, "user" if t == 0 else "assistant", ("x" * 300_000 if t == 0 else f"{i}" * 200_000)) for i in range(2) for t in range(2)]
    made = chat.format_pairs(chat.pair_by_opening(chat.conversations(table(spark, rows)))).first()
    assert made.n_common == 1 and len(made.prompt) > 300_000 and len(made.chosen_completion) > 200_000


def test_sql_equals_the_operator_across_ids(spark, tmp_path):
    """Openings shared by conversations whose ids lie far apart, odd and even counts, and unique ones."""
    rows = []
    for i, c in enumerate([5, 2000, 4000, 4001, 9000, 10 ** 6, 10 ** 9, 7, 3_000_000, 8, 11, 12]):
        opening = "open" if i < 5 else ("two" if i < 7 else f"own {c}")
        rows += [(c, 0, "user", opening), (c, 1, "assistant", "word " * (c % 7 + 1)), (c, 2, "user", "and?")]
        rows += [(c, 3, "assistant", f"answer {c}")] if i % 3 else []
    pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).to_parquet(tmp_path / "conversations.parquet")
    got = queries.op6_chat(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet'")
    want = con.execute(queries.OP6_SQL)
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted((tuple(r[n] for n in names) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)
    assert got.where("n_common > 0").count() == got.count()
