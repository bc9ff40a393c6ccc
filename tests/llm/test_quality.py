import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from panelspark.llm import quality
from panelspark.llm.quality import COUNTS, ERROR, RULES, SPREADS, judge, measure, op13
from panelspark.llm.words import Texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counted(text):
    text = text or ""
    words, lines = WORD.findall(text), [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    times, inside = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            inside.update(range(i, i + 8))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        len(lines),
        len(lines) - len(set(lines)),
        len(inside),
    )


def texts(seed=0, n=120):
    rng = random.Random(seed)
    out = [None, "", " \n\t", "\n", "a", "a\na", "a\na\n", "\n\na\n\na \n", "x\r\nx\r\nx", "é" * 20_000, "w " * 5000, "a b\n" * 3000]
    for _ in range(n):
        words = [rng.choice(["la", "él", "#x", "ü|", "<b>", "ordinary", "日本"]) + str(rng.randrange(60)) for _ in range(rng.randrange(90))]
        if rng.random() < 0.5:
            words = words[:12] + words
        out.append("".join(w + rng.choice([" ", " ", "  ", "\n", "\t", "\n\n"]) for w in words).strip(rng.choice([" \n", ""])))
    return out


def test_counts_against_brute_force():
    given = texts()
    found = measure(Texts.of(pa.array(given, pa.string())))
    assert list(zip(*(found[c].tolist() for c in COUNTS))) == [counted(t) for t in given]


def judged(rows, least):
    """kept and failed rules of (lang, source, text), with exact quartiles, and whether a value is too near a threshold to tell."""
    counts = [dict(zip(COUNTS, counted(t))) for *_, t in rows]
    base = [c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"] for c in counts]
    out = []
    for (lang, source, _), c, bad in zip(rows, counts, base):
        for group in (lambda r: r[:2] == (lang, source), lambda r: r[0] == lang, lambda r: True):
            near = [d for r, d, b in zip(rows, counts, base) if group(r) and not b]
            if len(near) >= least:
                break
        failed, unsure = [], False
        for r in RULES if not bad else ():
            x = c[r.part] / c[r.whole] if c[r.whole] else 0
            values = sorted(d[r.part] / d[r.whole] if d[r.whole] else 0 for d in near)
            q0, q1 = (values[math.ceil(q * len(values)) - 1] for q in (0.25, 0.75))
            limit = q1 + max(SPREADS * (q1 - q0), r.margin)
            under = q0 - max(SPREADS * (q1 - q0), r.margin) if r.low else -1
            if x > limit or x < under:
                failed.append(r.name)
            unsure |= min(abs(x - limit), abs(x - under)) < 8 * ERROR * q1
        out.append((not bad and not failed, sorted(failed), unsure))
    return out


@pytest.fixture
def rows():
    rng = random.Random(5)
    out = []
    for k in range(700):
        lang = rng.choice(["en", "en", "de", None])
        source = "hot" if k % 3 == 0 else rng.choice(["a", "b", None])
        size = {"en": 5, "de": 9}.get(lang, 3)
        mark = "#" if source == "b" and rng.random() < 0.9 else "###" if rng.random() < 0.1 else ""
        words = ["".join(rng.choice("abcdefgh") for _ in range(max(1, round(rng.gauss(size, 1))))) + mark for _ in range(rng.choice([5, 60]))]
        out.append((lang, source, " ".join(words * rng.choice([1, 1, 1, 3]))))
    return out + [(None, None, None), ("en", "a", ""), ("xx", "new", out[0][2])]


@pytest.mark.parametrize("least", [40, 10_000])
def test_thresholds_follow_their_groups(spark, monkeypatch, rows, least):
    monkeypatch.setattr(quality, "LEAST_DOCS", least)
    frame = spark.createDataFrame([(k, *r, 0, "z") for k, r in enumerate(rows)], "doc_id long, lang string, source string, text string, kept int, id string")
    got = {r.doc_id: r for r in judge(frame).collect()}
    assert len(got) == len(rows)
    sure = 0
    for k, (kept, failed, unsure) in enumerate(judged(rows, least)):
        assert tuple(got[k][c] for c in COUNTS) == counted(rows[k][2])
        if not unsure:
            sure += 1
            assert (got[k].kept, sorted(got[k].failed)) == (kept, failed)
    assert sure > 600
    assert {r.level for r in got.values()} >= ({"source", "language"} if least == 40 else {"all"})


def test_a_source_of_symbols_keeps_its_documents(spark):
    word = lambda k: "".join(chr(97 + k // 26**j % 26) for j in range(5))
    docs = [(k, " ".join(word(k * 40 + j) + ("|" if k % 2 else "") for j in range(40)), "en", "code" if k % 2 else "prose") for k in range(1200)]
    docs += [(5000, docs[1][1], "en", "prose")]
    out = {r.doc_id: r.kept for r in judge(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")).collect()}
    assert sum(not kept for kept in out.values()) == 1
    assert not out[5000]


def test_sketch_quantiles_and_merging(spark, monkeypatch):
    monkeypatch.setattr(quality, "SPREADS", 0.0)
    rng = np.random.default_rng(0)
    rows = [("en", str(k % 3), int(x), 1000, *(0,) * 4) for k, x in enumerate(rng.lognormal(8, 2, 3000))]
    columns = "lang string, source string, word_chars long, n_words long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
    frame = spark.createDataFrame(rows, columns)
    merged = quality.merged(quality.sketches(frame, ["lang", "source"]), ["lang"])
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, quality.sketches(frame, ["lang"]).collect()), key=str)
    found = quality.fences(merged, ["lang"]).first()
    values = sorted(r[2] / 1000 for r in rows)
    exact = [values[math.ceil(q * 3000) - 1] for q in (0.25, 0.75)]
    assert abs(found.high_mean_word - 1.5 - exact[1]) <= 1.01 * ERROR * exact[1]
    assert abs(found.low_mean_word + 1.5 - exact[0]) <= 1.01 * ERROR * exact[0]


def test_symbol_junk_goes_and_clean_documents_stay(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = op13(spark, folder).join(labels, "doc_id").where("not base_failed").select("quality", "kept").collect()
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.99
    assert sum(bad) / len(bad) < 0.1


def test_empty_table(spark):
    assert judge(spark.createDataFrame([], "doc_id long, text string, lang string, source string")).count() == 0
