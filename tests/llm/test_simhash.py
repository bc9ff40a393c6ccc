import random

import pytest
import xxhash

from panelspark.llm.simhash import blocks_for, links, near_duplicates


def brute(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def closure(fps, radius):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


def test_documents_against_brute_force(spark):
    rng = random.Random(1)
    vocab = [f"w{i}" for i in range(300)]
    texts = [" ".join(rng.choices(vocab, k=rng.randint(1, 300))) for _ in range(60)]
    texts += [t.upper().replace(" ", " \n\t") for t in texts[:10]]
    texts += [t + " end" for t in texts[:30]] + [None, "", "  \n", "one two", "One  Two", "x" * 50_000]
    rows = [(i, t, "extra", t) for i, t in enumerate(texts)]
    found = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, fp string, component string")).collect()
    fps = [brute(t) for t in texts]
    groups = closure(fps, 4)
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == [
        (i, f"{fps[i]:016x}", groups[i]) for i in range(len(texts))
    ]


def test_null_ids_repeats_and_empty(spark):
    schema = "doc_id long, text string"
    rows = [(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (None, None)]
    found = near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in found) == [("3", "3"), ("3", "3"), ("None", "3"), ("None", "None")]
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_every_block_count_finds_all_links(spark, monkeypatch, blocks):
    rng = random.Random(blocks)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for i in range(0, 60, 2):
        near = fps[i]
        for bit in rng.sample(range(64), rng.randint(1, 6)):
            near ^= 1 << bit
        fps.append(near)
    monkeypatch.setattr("panelspark.llm.simhash.blocks_for", lambda n, r: blocks)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    edges = links(spark.createDataFrame(signed, "fp long")).collect()
    at = {s[0]: i for i, s in enumerate(signed)}
    label = list(range(len(fps)))
    for _ in fps:
        for a, b in edges:
            label[at[a]] = label[at[b]] = min(label[at[a]], label[at[b]])
    assert label == closure(fps, 4)


def test_block_counts_grow():
    assert [blocks_for(n, 4) for n in (1, 200_000, 10**7, 10**9, 10**11)] == [5, 5, 6, 7, 8]
