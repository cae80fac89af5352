import random

import numpy as np
import pytest

from trailforge.llm import meeting, neardup as nd


def as_texts(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    return data, np.cumsum([0, *(len(t.encode()) for t in texts)])


def plain_shingles(text):
    words = text.lower().split()
    found = {}
    for i in range(max(1, len(words) - 4) if words else 0):
        gram = tuple(words[i : i + 5])
        found[gram] = found.get(gram, 0) + 1
    return found


def test_shingles_count_like_plain_python():
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(0, 40))) for _ in range(200)]
    grams, of, count, high, low = nd.shingles(*as_texts(texts))
    for i, t in enumerate(texts):
        assert sorted(count[of == i].tolist()) == sorted(plain_shingles(t).values())
        assert (high[i] != 0) == bool(t.split())
    assert len({(a, b) for a, b in zip(high.tolist(), low.tolist())}) == len({tuple(t.split()) for t in texts})


def test_samples_agree_as_often_as_weighted_jaccard():
    rng = np.random.default_rng(1)
    grams = rng.integers(0, 2**63, 400).astype(np.uint64)
    a, b = np.arange(0, 300), np.arange(60, 400)
    weight = rng.gamma(2, 1, 400).astype(np.float32) + 0.1
    other = weight * rng.choice([1, 1, 1.5], 400).astype(np.float32)
    drawn = [nd.samples(grams[i], np.zeros(len(i), int), w[i], 6000)[0] for i, w in ((a, weight), (b, other))]
    both = np.arange(60, 300)
    least = np.minimum(weight[both], other[both]).sum()
    want = least / (weight[a].sum() + other[b].sum() - least)
    assert abs((drawn[0] == drawn[1]).mean() - want) < 0.025


def brute(rows, idf):
    sets = [nd.weighted_sets(*as_texts([(t or "").lower()]), idf)[:2] for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        return i if up[i] == i else root(up[i])

    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i][0]) and len(sets[j][0]) and nd.similarity(sets[i], sets[j]) >= nd.SIMILARITY:
                up[max(root(i), root(j))] = min(root(i), root(j))
    return {rows[i][0]: rows[root(i)][0] for i in range(len(rows))}


@pytest.mark.parametrize("size", [512, 4])
def test_classes_against_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(meeting, "SLICE", size)
    rng = random.Random(6)
    words = ["w%d" % i for i in range(400)]
    base = [[rng.choice(words) for _ in range(rng.randrange(3, 200))] for _ in range(12)]
    rows = []
    for i in range(150):
        text = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "One  TWO"), (205, "x " * 5000)]
    df = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, high int")
    want = brute(rows, nd.idf_table(df))
    got = nd.classes(df).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want and len(got) == len(rows)
    assert {r["doc_id"] for r in nd.deduplicate(df).collect()} == set(want.values())


def test_repeated_rows_and_null_ids(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (1, "a b c d e f"), (2, None), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = nd.deduplicate(df).collect()
    assert sorted((r["doc_id"] is None, r["text"]) for r in kept if r["text"]) == [(True, "a b c d e f")]
    assert len(kept) == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert nd.classes(df).collect() == [] and nd.deduplicate(df).collect() == []
