import hashlib
import random

from pyspark.sql import functions as F

from tidemark.llm import chat

DDL = "conv_id long, turn int, role string, text string, segments string, checks int"
PARTS = ["### ", "</turn>", "</turn>\n", "\\", "\n", ": ", "#", " ", "user", "assistant", "é日", "<", "/", "a", "\U0001f600", "$1", "\x00", "\r\n"]


def talks(spark, rows):
    """Rows of (conv_id, turn, role, text) with two columns that clash with the operator's own."""
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DDL).repartition(3)


def expected(rows):
    found = {}
    for c, turn, role, text in rows:
        found.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for c, turns in found.items():
        turns.sort(key=lambda t: t[:2])
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        out.append((c, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=repr)


def digested(spark, rows):
    found = chat.digests(chat.write(talks(spark, rows))).drop("formatted_chars")
    return sorted(map(tuple, found.collect()), key=repr)


def test_any_text_and_role_comes_back(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice(PARTS) for _ in range(rng.randrange(8)))
    rows = [(c, t, rng.choice(["user", "assistant", word()]), word()) for c in range(150) for t in range(rng.randrange(1, 6))]
    assert digested(spark, rows) == expected(rows)


def test_nulls_ties_long_texts_and_one_large_conversation(spark):
    rows = [(None, 0, "user", "x"), (None, 1, "assistant", "y"), (1, None, "system", "first"), (1, 0, None, None), (1, 1, "assistant", None)]
    rows += [(2, 0, "assistant", "same")] * 3 + [(3, 0, "assistant", "\\### " * 100_000), (4, 5, "assistant", "x" * 1_000_000)]
    rows += [(5, t, ("user", "assistant")[t % 2], f"turn {t} </turn>") for t in range(3000)]
    assert digested(spark, rows) == expected(rows)
    assert digested(spark, []) == []


def test_escapes_only_what_conflicts(spark):
    texts = ["plain", "#### two marks ### ", "a </turn> b", "back\\slash", "ends with \\", "1 # 2: 3"]
    rows = spark.createDataFrame([("user", t) for t in texts] + [("a: b", "c")], "role string, text string")
    made = rows.select("text", chat.render(F.col("role"), F.col("text")).alias("m")).select("text", "m.*").collect()
    assert {r.text: r.level for r in made} == dict(zip([*texts, "c"], [0, 1, 1, 1, 0, 0, 2]))
    for r in made:
        assert "### " not in r.body and "</turn>" not in r.body and r.head.count(": ") == 1


def test_what_breaks_the_grammar_is_no_turn(spark):
    broken = ["x### a: b</turn>\n", "### a: b", "### a b</turn>\n", "### a: b</turn>", "### a: b</turn>\nx", "", "### a: b</turn>\n"]
    rows = spark.createDataFrame([(t,) for t in broken], "t string").select("t", chat.parse(F.col("t")).alias("p"))
    assert {r.t: [p and tuple(p) for p in r.p] for r in rows.collect()} == {
        broken[0]: [None, ("a", "b")], broken[1]: [None], broken[2]: [None], broken[3]: [None], broken[4]: [None], "": [], broken[6]: [("a", "b")],
    }


def test_a_changed_output_is_noticed(spark):
    import pytest

    formatted = chat.write(talks(spark, [(1, 0, "user", "hello")]))
    other = formatted.withColumn("segments", F.transform("segments", lambda s: s.withField("text", F.replace(s["text"], F.lit("hello"), F.lit("hullo")))))
    with pytest.raises(Exception, match="does not come back"):
        chat.digests(other).collect()


def test_no_python_in_the_plan(spark):
    plan = chat.digests(chat.format_turns(talks(spark, [(1, 0, "user", "hello")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
