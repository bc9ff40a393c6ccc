"""Each stage on what the stage before kept, against brute force."""

import os

import pytest

import corpus_pipeline
from panelspark.llm.registered import QUERIES, SQL
from panelspark.llm.tables import read
from panelspark.llm.toxicity import score
from tests.oracle import connect, differences

from .test_simhash import brute as fingerprint
from .test_simhash import closure
from .test_suffixes import brute as stripped

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_stages(spark):
    docs = read(spark, FOLDER, "documents")
    columns, states = docs.columns, [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, FOLDER), name)
        assert name == "mixing" or docs.columns == columns
        states.append(docs.collect())
    raw, clean, single, cut, safe, mixed = states

    scores = {r.doc_id: r.score for r in score(read(spark, FOLDER, "documents"), read(spark, FOLDER, "labels")).collect()}
    assert sorted(r.doc_id for r in clean) == sorted(r.doc_id for r in raw if scores[r.doc_id] < 0.5)

    clean.sort(key=lambda r: r.doc_id)
    label = closure([fingerprint(r.text) for r in clean], 4)
    assert sorted(single) == [r for i, r in enumerate(clean) if label[i] == i]

    expected = stripped([(r.doc_id, r.text) for r in single], corpus_pipeline.PASSAGE)
    gone = {k: removed for k, _, removed, *_ in expected}
    before = {r.doc_id: r for r in single}
    assert sorted(r.doc_id for r in cut) == sorted(before)
    for r in cut:
        if gone[r.doc_id] == 0:
            assert r == before[r.doc_id]
        else:
            assert r.n_chars == len(r.text)
            assert 0 <= len(before[r.doc_id].text.encode()) - gone[r.doc_id] - len(r.text.encode()) <= 6

    items = [r.text for r in read(spark, FOLDER, "benchmark").collect()]
    leaked = {r.doc_id for r in cut if any(t in r.text for t in items)}
    kept = {r.doc_id for r in safe}
    assert not leaked & kept and {r.doc_id for r in cut} - leaked == kept

    assert {r.doc_id for r in mixed} <= kept
    assert all(0 < r.taken <= 3 * r.size and r.size == len(r.text.encode().split()) for r in mixed)


AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, no_text int, size int, target int, code int, row_number int, component_id int"


def awkward(spark):
    long = " ".join(f"w{k * k % 9973}" for k in range(20_000))
    texts = [None, "", " \n", "one", long, long, "same words here", "same words here", None, "é" * 3000]
    rows = [(None if k % 4 == 3 else k % 6, t, None if k % 2 else "en", None if k % 3 == 0 else "s", len(t or ""), *range(6)) for k, t in enumerate(texts)]
    return spark.createDataFrame([*rows, rows[4], rows[4]], AWKWARD)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stage_on_awkward_rows(spark, name):
    """Null ids and texts, empty and very long texts, repeated rows, columns with names that operators use."""
    docs, stage = awkward(spark), dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, FOLDER)
    rows = out.collect()
    kept = [r.text for r in rows]
    if name == "mixing":
        assert all(0 < r.taken <= 3 * r.size for r in rows)
        assert len(set(out.columns)) == len(out.columns)
    else:
        assert out.columns == docs.columns
        given = [r.text for r in docs.collect()]
        if name in ("toxicity", "decontamination"):
            assert sorted(map(str, kept)) == sorted(map(str, given))
        elif name == "simhash_dedup":
            assert 0 < len(kept) <= len(given) and set(kept) <= set(given)
        else:
            assert len(kept) == len(given) and kept.count(None) == 2
    assert stage(spark, spark.createDataFrame([], AWKWARD), FOLDER).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), connect(FOLDER), SQL[name]) is None


def test_all_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
