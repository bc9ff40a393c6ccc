import random
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from panelspark.llm.mixing import capped_targets, mix, sainte_lague


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=8), st.integers(0, 60), st.booleans())
def test_sainte_lague_against_one_seat_at_a_time(votes, seats, capped):
    most = [v // 3 for v in votes] if capped else [seats] * len(votes)
    expected = [0] * len(votes)
    for _ in range(seats):
        open_ = [i for i, v in enumerate(votes) if v and expected[i] < most[i]]
        if not open_:
            break
        expected[max(open_, key=lambda i: (Fraction(votes[i], 2 * expected[i] + 1), -i))] += 1
    assert sainte_lague(votes, seats, most).tolist() == expected


def test_caps_are_reshared():
    assert capped_targets([5, 2, 1], [1, 50, 49]) == [3.0, 97 * 2 / 3, 97 / 3]
    assert capped_targets([5, 2], [0, 0]) == [0.0, 0.0]
    found = capped_targets([5, 2, 1, 5], [1, 2, 3, 94])
    assert abs(sum(found) - 100) < 1e-9 and found[0] == 3


def test_mix(spark):
    rng = random.Random(3)
    sources = ["a", "b", "c", "d", None, "Ü", ""]
    rows = [(i, " ".join("w" * rng.randint(1, 3) for _ in range(rng.randint(0, 300))), sources[min(6, int(rng.expovariate(0.6)))], "x") for i in range(3000)]
    rows += [(5, None, "a", "x"), (None, "one two  three x\n", "a", "x"), (7, "z " * 20_000, "b", "x"), (7, "z " * 20_000, "b", "x")]
    schema = "doc_id long, text string, source string, size string"
    found = mix(spark.createDataFrame(rows, schema)).collect()
    again = mix(spark.createDataFrame(rows[::-1], schema).repartition(7)).collect()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, found)) == sorted(map(key, again))
    assert sorted((str(r.doc_id), r.size) for r in found) == sorted((str(i), len((t or "").encode().split())) for i, t, *_ in rows)
    order = sorted({r.source for r in found}, key=lambda s: (s is None, s or ""))
    size = {s: sum(r.size for r in found if r.source == s) for s in order}
    target = dict(zip(order, capped_targets([5, 2, 1, 5, 2, 1, 5], [size[s] for s in order])))
    for s in order:
        mine = [r for r in found if r.source == s]
        assert {(r.source_size, r.target) for r in mine} == {(size[s], target[s])}
        assert abs(sum(r.taken for r in mine) - target[s]) <= max(100, 0.01 * target[s])
    assert all(0 <= r.taken <= 3 * r.size for r in found)
    assert any(0 < r.taken < r.size for r in found)


def test_empty_tables_and_texts(spark):
    schema = "doc_id long, text string, source string"
    assert mix(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(r) for r in mix(spark.createDataFrame([(1, None, None)], schema)).collect()] == [(1, 0, None, 0, 0.0, 0)]
