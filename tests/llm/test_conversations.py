import pytest

from panelspark.llm.conversations import collapse
from panelspark.llm.registered import SQL
from tests.oracle import connect

SCHEMA = "conv_id long, turn int, role string, text string"


def talk(conv, *texts, start=0):
    return [(conv, start + i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


CASES = {
    "snapshots": talk(1, "a") + talk(2, "a", "b") + talk(3, "a", "b", "c") + talk(4, "a", "x") + talk(5, "b"),
    "copies": talk(7, "a", "b") + talk(3, "a", "b") + talk(9, "a"),
    "nulls": [(1, 0, None, None), (2, 0, None, None), (2, 1, "user", None), (3, None, "user", "z"), (None, 0, "user", "n"), (4, 0, "", "")],
    "repeats": talk(1, "a", "b") * 2 + talk(2, "a", "b") + [(3, 0, "user", "a")] * 2,
    "ties": [(1, 0, "user", "b"), (1, 0, "user", "a"), (2, 0, "user", "a"), (3, 0, "user", "b")],
    "long": talk(1, *map(str, range(700))) + talk(2, *map(str, range(300))) + [(3, None, "u", str(i)) for i in range(600)],
    "offset": talk(1, "a", "b", start=5) + talk(2, "a", "b", "c") + talk(3, "c", start=-3),
}


@pytest.mark.parametrize("case", CASES)
def test_against_sql(spark, case):
    con = connect("/nowhere")
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn INTEGER, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", CASES[case])
    names = ["conv_id", "part", "n_turns", "text"]
    expected = con.execute(f"SELECT {', '.join(names)} FROM ({SQL['op9_chat_snapshots']})").fetchall()
    found = collapse(spark.createDataFrame([(*r, "x") for r in CASES[case]], SCHEMA + ", part string")).select(*names)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_kept_conversations(spark):
    found = collapse(spark.createDataFrame(CASES["snapshots"], SCHEMA))
    assert sorted(r.conv_id for r in found.collect()) == [3, 4, 5]
    assert "".join(r.text for r in found.where("conv_id = 4").collect()) == "<|user|>\na<|end|>\n<|assistant|>\nx<|end|>\n"


def test_empty_and_no_python(spark):
    result = collapse(spark.createDataFrame([], SCHEMA))
    assert result.count() == 0
    assert "Python" not in result._jdf.queryExecution().executedPlan().toString()
